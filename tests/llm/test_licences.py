import hashlib
import textwrap

import regex
from pyspark.sql import functions as F

from calipers.llm import licences


def plain(text):
    out = []
    for line in (text or "").split("\n"):
        form = line.lower()
        for spelling, same in licences.SPELLINGS:
            form = form.replace(spelling, same)
        for pattern, instead, _ in licences.PATTERNS:
            form = regex.sub(pattern, instead, form)
        out.append(regex.sub(licences._GAPS, " ", form).strip(" "))
    return " ".join(x for x in out if x)


def joined(text):
    return plain(regex.sub(r"[\t-\r\x20]+", " ", text or ""))


def digest(form):
    return hashlib.sha256(form.encode()).hexdigest()


def known():
    out = {}
    rows = [(k, t) for k, texts in licences.TEXTS.items() for t in texts]
    rows += [(k, s.format(n)) for k, names in licences.NAMES.items() for n in names for s in licences.STATEMENTS]
    for licence, text in rows:
        for form in (plain(text), joined(text)):
            if form:
                out[digest(form)] = min(licence, out.get(digest(form), licence))
    return out


def want(rows):
    table, out = known(), []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        for k, part in enumerate([text or "", *(lines if len(lines) > 1 else [])]):
            d, other = digest(plain(part)), digest(joined(part))
            noticed = not k and any(h in (text or "").lower() for h in licences.PATTERNS[0][2])
            if d in table or (noticed and other in table):
                d = d if d in table else other
                out.append((doc_id, "line" if k else "text", k, table[d], d))
    return sorted(out, key=str)


def test_documents_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = sorted(map(tuple, licences.scan(docs).collect()), key=str)
    assert got == want(rows) and {g[3] for g in got} >= {"MIT", "GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0", "all-rights-reserved"}


def test_forms_and_odd_rows(spark):
    mit = licences.TEXTS["MIT"][0]
    rows = [
        (1, "Copyright (c) 2020 Somebody\n\n" + mit), (2, mit.upper().replace("\n", "  \n")), (3, mit.replace("copies", "copy")),
        (4, "LICENCED under the Apache Licence, version 2"), (5, "x\nReleased under the MIT License\ny"), (None, "CC BY-NC 4.0"), (6, None),
        (7, ""), (8, "..."), (9, "the MIT license is short"), (5, "x\nReleased under the MIT License\ny"), (10, "word " * 50_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as line", "2 as digest")
    got = sorted(map(tuple, licences.scan(docs).collect()), key=str)
    assert got == want(rows)
    assert [g[:4] for g in got] == [(1, "text", 0, "MIT"), (2, "text", 0, "MIT"), (4, "text", 0, "Apache-2.0"), (5, "line", 2, "MIT"),
                                    (5, "line", 2, "MIT"), (None, "text", 0, "CC-BY-NC-4.0")]
    assert licences.scan(docs.limit(0)).count() == 0
    own = spark.createDataFrame([(hashlib.sha256(b"word").hexdigest(), "mine")], "digest string, licence string")
    assert [r.licence for r in licences.scan(spark.createDataFrame([(1, "Word!")], "doc_id long, text string"), own).collect()] == ["mine"]


def test_known_texts_wrapped_anew_and_notices_in_line(spark):
    rows, want_names = [], {}
    for name, texts in licences.TEXTS.items():
        for text in texts:
            if len(text) > 5_000:  # the long texts bring notices and layouts of their own
                continue
            paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
            for width in (*range(25, 121), 10**6):
                want_names[len(rows)] = name
                rows.append((len(rows), "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs)))
            want_names[len(rows)] = name
            rows.append((len(rows), " ".join(paragraphs)))
    mit = " ".join(licences.TEXTS["MIT"][0].split())
    for notice in ("Copyright 2020 X.", "Copyright (c) 2019-2021 Some Body, Inc. All rights reserved.", "(c) 2020 X", "Copyright © Jane Doe\n", "(C) Jane Doe\n"):
        want_names[len(rows)] = "MIT"
        rows.append((len(rows), f"{notice} {mit}"))
    rows += [(len(rows), "Copyright 2020 Xena. Then a text of its own."), (len(rows) + 1, "copyright holders")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.licence for r in licences.scan(docs).where("unit = 'text'").collect()}
    assert [i for i in want_names if got.get(i) != want_names[i]] == []
    assert set(got) == set(want_names)
    last = [licences.forms(F.col("text")).alias("f")]
    assert [r.f for r in docs.where(f"doc_id >= {len(rows) - 2}").orderBy("doc_id").select(*last).collect()] == [["then a text of its own"], ["copyright holders"]]


def test_full_texts_with_and_without_title(spark):
    rows = [(k, name, text) for k, (name, text) in enumerate(licences.FULL.items())]
    rows += [(100, "MIT", "MIT License\n\nCopyright (c) 2020 Some Body\n\n" + licences.TEXTS["MIT"][0])]
    rows += [(101, "BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some Body\nAll rights reserved.\n\n" + licences.FULL["BSD-3-Clause"])]
    rows += [(102, "BSD-2-Clause", "Copyright 2021 Some Body. All rights reserved.\n" + licences.FULL["BSD-2-Clause"])]
    got = licences.scan(spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")).where("unit = 'text'").collect()
    assert {r.doc_id: r.licence for r in got} == {i: name for i, name, _ in rows}
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "Unlicense"} <= set(licences.FULL)


def test_full_texts_wrapped_anew(spark):
    """Every full text, GNU texts with their notices included, in any wrapping and in one line."""
    rows, names = [], {}
    for name, text in licences.FULL.items():
        paragraphs = [" ".join(p.split()) for p in text.split("\n\n")]
        for width in (25, 40, 60, 72, 80, 100, 120, 10**6):
            names[len(rows)] = name
            rows.append((len(rows), "\n\n".join(textwrap.fill(p, width, break_on_hyphens=False, break_long_words=False) for p in paragraphs)))
        names[len(rows)] = name
        rows.append((len(rows), " ".join(paragraphs)))
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("unit = 'text'").collect()
    assert {r.doc_id: r.licence for r in got} == names
