"""Main-text extraction by a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into blocks: runs of text between the tags that break lines. A block's
features come from the tags, classes and ids above it and from its text. The field scores
each block's label (article or not) together with its neighbour's; Viterbi picks the best
sequence of labels. It is trained on labelled pages: pages of the table whose own markup
tells what is what, and the same texts laid out anew in the many ways in which other sites
write menus, side bars, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calipers.llm.common import text_of
from calipers.runtime import ship

# Fixed values of the markup language.
BREAKING = frozenset("""
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup
    option p pre section select summary table tbody td tfoot th thead title tr ul
""".split())
RAW = frozenset("script style template noscript iframe svg math object textarea canvas video audio xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": BREAKING - {"caption", "label", "legend", "option", "optgroup", "button"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "tr": {"tr"}, "option": {"option", "optgroup"}, "head": {"body"},
}

#: The rest of a tag: names, each with a value after `=` or without; a quote opens a value only there. An open value
#: ends with the page.
_ATTRIBUTES = r"""(?>[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)?)?)*+"""
_PIECE = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    rf"|<(?:svg|math)(?=[\s/>])(?:{_ATTRIBUTES})(?<=/)>"  # closes itself
    rf"|<(?P<raw>{'|'.join(sorted(RAW))})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    rf"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>{_ATTRIBUTES})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)


@dataclass
class Block:
    text: str
    above: tuple[str, ...]  # tags from the root down
    names: frozenset[str]  # words of the classes, ids and roles above
    links: int = 0  # characters inside links
    gold: int = 0  # label of a training block


@dataclass
class _Open:
    tag: str
    names: frozenset[str]
    gold: bool | None = None


def blocks_of(source: str, marks: bool = False) -> list[Block]:
    """The blocks of a page in page order. With `marks`, data-gold attributes set the labels."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    link_depth = link_chars = 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            gold = next((o.gold for o in reversed(stack) if o.gold is not None), False)
            out.append(Block(
                text, tuple(o.tag for o in stack), frozenset().union(*(o.names for o in stack)), link_chars, int(bool(gold))
            ))
        parts.clear()
        link_chars = 0

    at = 0
    for piece in _PIECE.finditer(source):
        if piece.start() > at:
            parts.append(source[at: piece.start()])
            if link_depth:
                link_chars += piece.start() - at
        at = piece.end()
        if not piece["tag"]:
            if piece["raw"]:
                parts.append(" ")
            continue
        tag = piece["tag"].lower()
        if piece["close"]:
            if tag == "a":
                link_depth = max(0, link_depth - 1)
            elif tag in BREAKING and any(o.tag == tag for o in stack):
                flush()
                while stack.pop().tag != tag:
                    pass
            elif tag in ("p", "br"):
                parts.append(" ")
            continue
        if tag == "a":
            link_depth += 1
        if tag not in BREAKING:
            if tag in VOID:
                parts.append(" ")
            continue
        flush()
        link_depth = 0 if tag != "li" else link_depth
        while stack and tag in CLOSED_BY.get(stack[-1].tag, ()):
            stack.pop()
        if tag in VOID:
            continue
        rest = piece["rest"]
        names: frozenset[str] = frozenset()
        if rest:
            names = frozenset(
                w for m in _NAMES.finditer(rest) for w in _NAME_PARTS.findall((m[1] or m[2] or m[3] or "").lower())
            )
            if _HIDDEN.search(rest):
                names |= {"hidden"}
        gold = None
        if marks and "data-gold=" in rest:
            gold = 'data-gold="1"' in rest
        stack.append(_Open(tag, names, gold))
    parts.append(source[at:])
    flush()
    return out


# Parts of block texts that speak against an article.
_NOTICE = (
    "cookie", "consent", "privacy", "subscribe", "newsletter", "sign up", "sign in", "log in", "login", "copyright", "©",
    "all rights reserved", "advertisement", "sponsored", "share this", "share on", "read more", "related", "comment",
    "reply", "replies", "posted by", "click here", "terms of",
)
_SECTIONING = frozenset("article main nav header footer aside form dialog head".split())


_STRUCTURE = ("bias", "own=", "near=", "tag=", "name=")


def _near(block: Block) -> str:
    return next((t for t in reversed(block.above) if t in _SECTIONING), "")


def _place_features(block: Block) -> list[str]:
    near = _near(block)
    own = block.above[-1] if block.above else ""
    return ["bias", f"own={own}", f"near={near}", *(f"tag={t}" for t in set(block.above)), *(f"name={n}" for n in block.names)]


def _text_features(block: Block, place: int, near: str) -> list[str]:
    words = block.text.count(" ") + 1
    share = block.links / len(block.text)
    low = block.text.lower()
    on = [
        f"words={0 if words < 4 else 1 if words < 10 else 2 if words < 25 else 3}",
        f"links={0 if share == 0 else 1 if share < 0.5 else 2}", f"place={place}", f"end={block.text[-1] in '.!?…»”'}",
    ]
    if any(part in low for part in _NOTICE):
        on += ["notice", f"notice-words={min(3, words // 10)}", f"notice-near={near}"]
    return on


def features(blocks: list[Block]) -> list[list[str]]:
    """The names of the features that are on, for every block of a page."""
    return [_place_features(b) + _text_features(b, 10 * i // len(blocks), _near(b)) for i, b in enumerate(blocks)]


@dataclass
class Field:
    """Weights of the features for the label 1 against 0, of steps between labels, and of the first label."""

    weights: dict[str, float]
    steps: np.ndarray
    first: np.ndarray

    def scores(self, on: list[list[str]]) -> np.ndarray:
        get = self.weights.get
        return np.array([sum(get(name, 0.0) for name in names) for names in on])


    def block_scores(self, blocks: list[Block], known: dict) -> np.ndarray:
        """The same from the blocks; `known` keeps the part that place in the page decides."""
        get = self.weights.get
        out = []
        for i, b in enumerate(blocks):
            key = (b.above, b.names)
            if key not in known:
                known[key] = sum(get(name, 0.0) for name in _place_features(b))
            out.append(known[key] + sum(get(name, 0.0) for name in _text_features(b, 10 * i // len(blocks), _near(b))))
        return np.array(out)


def viterbi(scores: np.ndarray, steps: np.ndarray, first: np.ndarray) -> list[int]:
    """The labels with the greatest sum of block scores (of label 1), steps and first label."""
    if not len(scores):
        return []
    s = [(0.0, v) for v in scores.tolist()]
    (t00, t01), (t10, t11) = steps.tolist()
    a, b = float(first[0]), float(first[1]) + s[0][1]
    back = []
    for _, v in s[1:]:
        back.append((int(b + t10 > a + t00), int(b + t11 > a + t01)))
        a, b = max(a + t00, b + t10), max(a + t01, b + t11) + v
    label = int(b > a)
    labels = [label]
    for row in reversed(back):
        label = row[label]
        labels.append(label)
    return labels[::-1]


def _gradient(scores: np.ndarray, steps: np.ndarray, first: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the log likelihood of the gold labels, by block scores, steps and first label (forward-backward)."""
    n = len(scores)
    node = np.stack([np.zeros(n), scores], axis=1)
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = first + node[0]
    for i in range(1, n):
        ahead[i] = np.logaddexp(ahead[i - 1, 0] + steps[0], ahead[i - 1, 1] + steps[1]) + node[i]
    for i in range(n - 2, -1, -1):
        nxt = behind[i + 1] + node[i + 1]
        behind[i] = np.logaddexp(steps[:, 0] + nxt[0], steps[:, 1] + nxt[1])
    whole = np.logaddexp(*ahead[-1])
    p = np.exp(ahead + behind - whole)
    d_steps = np.zeros((2, 2))
    for i in range(1, n):
        d_steps[gold[i - 1], gold[i]] += 1
        d_steps -= np.exp(ahead[i - 1][:, None] + steps + (node[i] + behind[i])[None, :] - whole)
    d_first = np.eye(2)[gold[0]] - p[0]
    return gold - p[:, 1], d_steps, d_first


def train(pages: list[list[Block]], epochs: int = 12, rate: float = 0.5, decay: float = 1e-4, seed: int = 11) -> Field:
    """Stochastic gradient ascent with per-weight rates, pages in a drawn order.

    A fifth of the tag and class features and half of the text features are left out at
    random each time, so that no single name decides and markup counts for more than text.
    """
    rng = random.Random(seed)
    model = Field({}, np.zeros((2, 2)), np.zeros(2))
    seen: dict[str, float] = {}
    seen_steps, seen_first = np.full((2, 2), 1e-3), np.full(2, 1e-3)
    data = [(features(blocks), np.array([b.gold for b in blocks])) for blocks in pages if blocks]
    for _ in range(epochs):
        rng.shuffle(data)
        for on, gold in data:
            dropped = {x for x in {x for names in on for x in names} if rng.random() < (0.2 if x.startswith(_STRUCTURE) else 0.5)}
            used = [[x for x in names if x not in dropped] for names in on]
            d_node, d_steps, d_first = _gradient(model.scores(used), model.steps, model.first, gold)
            change: dict[str, float] = {}
            for names, d in zip(used, d_node.tolist(), strict=True):
                for name in names:
                    change[name] = change.get(name, 0.0) + d
            for name, d in change.items():
                d -= decay * model.weights.get(name, 0.0)
                seen[name] = seen.get(name, 1e-3) + d * d
                model.weights[name] = model.weights.get(name, 0.0) + rate * d / seen[name] ** 0.5
            seen_steps += d_steps**2
            seen_first += d_first**2
            model.steps += rate * d_steps / np.sqrt(seen_steps)
            model.first += rate * d_first / np.sqrt(seen_first)
    return model


# Layouts for training. Each entry: ways to open and close a part of a page.

_ARTICLE = ("article", "main", "div.content", "div.post", "div.entry-content", "div.article-body", "div#main-content", "div.story",
            "section.text", "div.post-body", "td.main", "div#article", "section#content", "div.page-content", "div", "section", "main article")
_MENU = ("nav ul", "div#nav ul", "ul.menu", "div.navbar", "div#navigation ul", "div.topbar", "div.breadcrumbs", "header nav ul", "div.menu ul",
         "ul.nav", "div.pagination", "div.tabs ul", "ul")
_HEADER = ("header", "div.header", "div#masthead", "div.site-header", "div#logo", "div.banner", "div.top")
_SIDE = ("aside", "div.sidebar", "div#sidebar", "div.widget", "div.related", "aside.right", "div.recent-posts ul", "section.trending ul",
         "div.tags", "td.side", "div.popular", "div.author-box", "div#secondary", "aside ul")
_NOTICES = ("div.cookie-banner", "div#consent", "div.gdpr", "div.notice", "div.alert", "div.popup", "div.newsletter", "div.modal",
            "div.subscribe-box", "section.cookies", "div.overlay", "div.warning", "dialog")
_ADS = ("div.ad", "div.ads", "div.advert", "div#advertisement", "div.sponsored", "aside.promo", "div.ad-slot", "section.banner-ad", "figure.ad")
_COMMENTS = ("div#comments", "section.comments", "div.comment-list", "ol.comments", "ul.responses", "div.discussion", "section#replies",
             "div.user-comments", "div#disqus-thread", "aside.comments")
_FORMS = ("form", "form.search", "div.contact form", "form#login", "div.signup form", "form.comment-form")
_FOOTER = ("footer", "div.footer", "div#footer", "div.copyright", "footer.site-info", "div.legal", "div.colophon", "section.footer")
# Short texts of such parts.
_PHRASES = {
    "notice": ("We use cookies to improve your experience. By using this site you accept our cookie policy.", "Accept all cookies",
               "Please read our privacy notice before you go on.", "Subscribe to our newsletter and never miss a story.", "Manage consent",
               "This site uses cookies.", "You have 3 free articles left this month.", "Sign up today for full access.", "Got it"),
    "ad": ("Advertisement", "Sponsored content", "Buy now and save 50%!", "Special offer: order today.", "Promoted"),
    "form": ("Search", "Your name", "Email", "Password", "Send", "Message", "Log in", "Submit", "Leave a reply", "Remember me"),
    "comment": ("Great article, thanks for sharing!", "I do not agree with this at all.", "Reply", "Posted by reader", "3 comments", "First!"),
    "footer": ("All rights reserved.", "Terms of use", "Contact us", "Imprint", "Back to top", "© 2024"),
    "side": ("Related articles", "Most read", "Popular tags", "About the author", "Follow us", "Recent posts"),
    "menu": ("Home", "News", "About", "Contact", "Sports", "Archive", "Blog", "Login"),
}


def _wrapped(path: str, inner: list[str], item: str, gold: bool) -> str:
    """`inner` texts, each in an `item` element, inside the elements of `path` (tag, tag.class or tag#id)."""
    opens, closes = "", ""
    for k, step in enumerate(path.split()):
        tag, mark, name = re.fullmatch(r"(\w+)(?:([.#])([\w-]+))?", step).groups()
        extra = f' {"class" if mark == "." else "id"}="{name}"' if mark else ""
        opens += f"<{tag}{extra}" + (f' data-gold="{int(gold)}"' if k == 0 else "") + ">"
        closes = f"</{tag}>" + closes
    last = path.split()[-1]
    item = "li" if re.match(r"[uo]l\b", last) else item
    body = "".join(f"<{item}>{text}</{item}>" if item else text for text in inner)
    return opens + body + closes


def laid_out(title: str, paragraphs: list[str], others: list[str], rng: random.Random) -> str:
    """A page with these texts as its article and other parts, each wrapped in one of many ways, in data-gold marks."""
    pick = rng.choice
    told = lambda kind, n: [pick(_PHRASES[kind]) for _ in range(n)]
    linked = lambda texts: [f'<a href="/x">{t}</a>' for t in texts]
    short = lambda: " ".join(pick(others).split()[: rng.randint(1, 8)])
    longer = lambda: " ".join(pick(others).split()[: rng.randint(6, 60)])
    paragraph = lambda t: f"<b>{t}<br>" if rng.random() < 0.15 else t
    kind = pick(("p", "p", "p", "div", "blockquote", "li"))
    body = [f"<{kind}>{paragraph(t)}</{kind}>" if rng.random() < 0.95 else f"<p>{t}" for t in paragraphs]
    if rng.random() < 0.35:
        body.insert(rng.randint(0, len(body)), f"<p>{pick(told(pick(('footer', 'notice', 'comment')), 1))}</p>")
    if rng.random() < 0.3 and len(body) > 2:
        body.insert(rng.randint(1, len(body)), _wrapped(pick(_ADS), [pick((longer(), *told("ad", 1)))], pick(("p", "")), False))
    if rng.random() < 0.3:
        body.insert(rng.randint(0, len(body)), "<{0}>{1}</{0}>".format(pick(("h2", "h3", "h4")), short()))
    heading = f"<h1>{title}</h1>" if rng.random() < 0.85 else f"<h2>{title}</h2>"
    if rng.random() < 0.25:
        body.append(_wrapped(pick(_COMMENTS), [longer() for _ in range(rng.randint(1, 4))] + told("comment", 2), "p", False))
    if rng.random() < 0.2:
        body.insert(rng.randint(1, len(body)), _wrapped(pick(_FORMS), told("form", 3), pick(("label", "button", "p")), False))
    if rng.random() < 0.2:
        body.insert(rng.randint(1, len(body)), _wrapped(pick(_SIDE), told("side", 1) + [longer()], pick(("p", "div")), False))
    article = _wrapped("article" if rng.random() < 0.35 else pick(_ARTICLE), [heading + "".join(body)], "", True)
    maybe = lambda share, make: [make()] if rng.random() < share else []
    before = [
        *maybe(0.5, lambda: _wrapped(pick(_HEADER), [pick((short(), *told("menu", 1)))], pick(("p", "div", "h1", "")), False)),
        *maybe(0.8, lambda: _wrapped(pick(_MENU), linked([short() for _ in range(rng.randint(2, 6))] + told("menu", 2)), pick(("", "span", "div")), False)),
        *maybe(0.4, lambda: _wrapped(pick(_NOTICES), [*told("notice", rng.randint(1, 2)), *([longer()] if rng.random() < 0.4 else [])], pick(("p", "div", "button")), False)),
        *maybe(0.5, lambda: _wrapped(pick(_ADS), [pick((longer(), *told("ad", 1)))], pick(("p", "")), False)),
        *maybe(0.25, lambda: _wrapped(pick(_FORMS), told("form", 3), pick(("label", "button", "p")), False)),
        *maybe(0.3, lambda: _wrapped(pick(_SIDE), told("side", 1) + [longer() for _ in range(2)], pick(("p", "div")), False)),
    ]
    after = [
        *maybe(0.5, lambda: _wrapped(pick(_SIDE), told("side", 1) + pick((linked, list))([pick((short, longer))() for _ in range(3)]), pick(("p", "div", "h3")), False)),
        *maybe(0.5, lambda: _wrapped(pick(_COMMENTS), told("comment", 1) + [longer() for _ in range(rng.randint(1, 5))] + told("comment", 1), pick(("p", "div")), False)),
        *maybe(0.35, lambda: _wrapped(pick(_FORMS), told("form", 3), pick(("label", "button", "p")), False)),
        *maybe(0.25, lambda: _wrapped(pick(_NOTICES), told("notice", 1), "p", False)),
        *maybe(0.8, lambda: _wrapped(pick(_FOOTER), [pick((longer(), "&copy; " + short())), *told("footer", 1)], pick(("p", "", "div")), False)),
    ]
    rng.shuffle(before)
    return f"<html><head><title>{title}</title></head><body>{''.join(before)}{article}{''.join(after)}</body></html>"


# Texts of the layouts that are learned from where a table has too few labelled pages.
_PROSE = (
    "The old harbour has been rebuilt twice since the flood, and each time the town moved a little further up the hill.",
    "In spring the council asked for new plans, but the engineers could not agree on the height of the wall.",
    "Most of the boats are small, and their owners know the currents better than any chart could show them.",
    "A good soup begins with patience: onions need half an hour before anything else goes into the pot.",
    "When the rain came at last, the fields had been dry for eleven weeks and the river was a line of stones.",
    "The method is simple enough to explain in a page, although it took the group nine years to find it.",
    "She kept the letters in a tin box under the stairs, sorted by year and tied with kitchen string.",
    "Prices rose in every district, most of all near the new station, where rents have doubled in five years.",
    "Nobody expected the second half to be any better, yet the young side scored three times before the end.",
    "The telescope sees in the infrared, so dust that hides the stars from our eyes is almost clear to it.",
    "Before you drill, check where the pipes run; a cheap detector finds them behind most kinds of plaster.",
    "His last book is a quiet one. It follows a family of bakers through a single winter and says little of the war.",
)
#: Labelled pages of a table from which on it needs no fixed ones; each has VARIANTS layouts besides itself.
ENOUGH, VARIANTS = 60, 6
_ARTICLE_TAG = r"<article[\s/>]"


#: What is no part of the article's text, wherever it stands inside the article element.
_APART = frozenset("aside form nav footer dialog menu button select".split())
_APART_NAMES = frozenset("comment comments replies respond disqus advert adverts advertisement ad ads promo sponsored newsletter cookie hidden".split())


def inside_article(block: Block) -> bool:
    """Whether a block of a page that marks its article belongs to it: below the element, and in none of its other parts."""
    if "article" not in block.above:
        return False
    below = block.above[block.above.index("article") + 1:]
    return _APART.isdisjoint(below) and _APART_NAMES.isdisjoint(block.names)


def fixed_pages(number: int, seed: int = 5) -> list[list[Block]]:
    """Labelled pages that need no table: layouts of fixed texts."""
    rng = random.Random(seed)
    pages = []
    for _ in range(number):
        texts = rng.sample(_PROSE, len(_PROSE))
        title = " ".join(texts[0].split()[: rng.randint(3, 8)])
        body = [" ".join(rng.sample(texts[1:8], rng.randint(1, 4))) for _ in range(rng.randint(1, 8))]
        pages.append(blocks_of(laid_out(title, body, texts[8:], rng), marks=True))
    return pages


def labelled_pages(sources: list[str], variants: int = VARIANTS, seed: int = 7) -> list[list[Block]]:
    """Training pages of page sources that have one article element: as they are, and laid out anew."""
    rng = random.Random(seed)
    own = [blocks_of(s) for s in sources if len(re.findall(_ARTICLE_TAG, s, re.IGNORECASE)) == 1]
    own = [blocks for blocks in own if any("article" in b.above for b in blocks)]
    pages: list[list[Block]] = []
    others = [b.text for blocks in own for b in blocks if not inside_article(b)] or ["more"]
    bodies = [b.text for blocks in own for b in blocks if inside_article(b)]
    for blocks in own:
        for b in blocks:
            b.gold = int(inside_article(b))
        pages.append(blocks)
        main = [entities.escape(b.text, quote=False) for b in blocks if b.gold]
        for _ in range(variants if main else 0):
            spare = [entities.escape(t, quote=False) for t in (*rng.sample(others, min(4, len(others))), *rng.sample(bodies, min(4, len(bodies))))]
            keep = rng.randint(1, max(1, min(len(main), 12)))
            pages.append(blocks_of(laid_out(main[0], main[1: 1 + keep] or main, spare, rng), marks=True))
    return pages


def fit(pages: DataFrame, most: int = 150) -> Field:
    """Train on about `most` pages of the table with one article element, chosen by a hash, and their layouts.

    Pages of 200,000 characters and more are not trained on.
    Where fewer than ENOUGH of them have an article with text, layouts of fixed texts stand in for the others.
    """
    usable = pages.where(
        F.col("html").isNotNull() & (F.length("html") < 200_000) & (F.size(F.split("html", "(?i)" + _ARTICLE_TAG, 3)) == 2)
    )
    share, among = min(1.0, most / max(1, usable.count())), 1 << 40
    sample = usable.where(F.pmod(F.xxhash64("page_id", "html"), F.lit(among)) < math.ceil(share * among))
    rows = sample.orderBy("page_id", "html").select("html").limit(2 * most).collect()
    learned = labelled_pages([r.html for r in rows])
    each = VARIANTS + 1
    return train(learned + fixed_pages(each * max(0, ENOUGH - len(learned) // each)))


def main_text(source: str, model: Field, known: dict | None = None) -> str:
    blocks = blocks_of(source)
    labels = viterbi(model.block_scores(blocks, {} if known is None else known), model.steps, model.first)
    return "\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages.

    Null and empty html, and pages without an article, give an empty text. Truncated markup
    ends with the page. Repeated rows get equal rows. No rows: no rows.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known: dict = {}
            texts = [main_text(source, model, known) for source in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts],
            })

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_of(F.col("html")).alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def extract_rows(pages: DataFrame) -> DataFrame:
    rows = pages.select("page_id", "url", "html")
    return extract(rows, fit(rows))
