"""Brute-force versions for small data."""

import hashlib
import re


def words(text):
    return re.findall(rb"[a-z0-9_\x80-\xff]+", (text or "").lower().encode())


def shingles(text, width=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1)))


def near_classes(rows, similarity=0.8):
    """{doc_id: (class_id, links)} of (doc_id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if both >= similarity * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                    links[i] += 1
                    links[j] += 1
                    root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, least[find(i)], links[i]) for i, (doc_id, _) in enumerate(rows)]


def trimmed(rows, span=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text)."""
    data = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in data:
        order = (i is None, i)
        for k in range(len(b) - span + 1):
            key = b[k: k + span]
            if key not in first or order < first[key]:
                first[key] = order
    out = []
    for i, b in data:
        order = (i is None, i)
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            f = first[b[k: k + span]]
            if f < order and not (f[0] and order[0]):
                gone[k: k + span] = b"\1" * span
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def edit_distance_to_part(item, text):
    """Least word edit distance of item to any part of text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        nxt = [i]
        for j, x in enumerate(text, 1):
            nxt.append(min(row[j - 1] + (w != x), row[j] + 1, nxt[j - 1] + 1))
        row = nxt
    return min(row)
