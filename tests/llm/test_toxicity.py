import zlib

import numpy as np
from pyspark.sql import functions as F

from calipers.llm import toxicity as t

SF = "/root/testdata/sf0.01"
MOVES, OUTPUTS = t.compiled(t.GRAMMAR, range(6))


def matches(text):
    return dict(t.clause_matches(text, t.lexicon([]), MOVES, OUTPUTS))


def test_grammar():
    assert matches("What an idiot.") == {"insult": 1}
    assert matches("You are such an idiot! You moron.") == {"aimed": 2}
    assert matches("He is not an idiot") == {"negated": 1}
    assert matches("She said that he is an idiot") == {"reported": 1}
    assert matches("I will kill you") == {"threat": 1}
    assert matches("They said I will kill you") == {"reported_threat": 1}
    assert matches("You 1d10t") == {"aimed": 1}
    assert matches("I kill time. You wait.") == {} and matches("") == {} and matches("a well behaved text") == {}


def test_the_table_does_what_the_transducers_do():
    import itertools

    for word in itertools.product(range(6), repeat=5):
        state, number = t.GRAMMAR.start, 0
        for symbol in word:
            state, match = t.GRAMMAR.step(state, symbol)
            assert OUTPUTS[number][symbol] == match
            number = MOVES[number][symbol]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = {r.doc_id: r for r in t.score_rows(docs, labels).collect()}
    assert len(got) == docs.count()
    right = total = 0
    for r in labels.collect():
        own = got[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= own.score <= 1 and own.predicted == int(own.score >= 0.5)
        if own.held_out:
            total += 1
            right += own.predicted == r.toxic
    assert total > 50 and right >= 0.97 * total


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    turned = labels.withColumn("toxic", t.F.when(t.held_out(t.F.col("doc_id")), 1 - t.F.col("toxic")).otherwise(t.F.col("toxic")))
    assert t.train(docs, labels) == t.train(docs, turned)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "idiot"), (3, "you idiot " * 20_000), (3, "you idiot " * 20_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(((r.doc_id, r.predicted, r.held_out) for r in t.score_rows(docs, none).collect()), key=str)
    assert [g[:2] for g in got] == [(1, 0), (2, 0), (3, 1), (3, 1), (None, 0)] and got[-1][2] is True
    assert t.score_rows(docs.limit(0), none).count() == 0
    extra = docs.selectExpr("*", "1 as score", "2 as row")
    assert t.drop_toxic(extra, t.train(docs, none)).columns == ["doc_id", "text", "score", "row"]


def test_learnt_insults_need_many_contexts(spark):
    rows = [(i, f"{chr(97 + i) * 4} zarg {chr(97 + i) * 5}", 1) for i in range(26)] + [(100 + i, "plain copied words stay", 1) for i in range(30)]
    rows += [(200 + i, f"nice{i} talk here", 0) for i in range(300)]
    assert t.learn_insults(spark.createDataFrame(rows, "id long, text string, toxic int").select("text", "toxic")) == ["zarg"]


def test_many_clauses_count_more(spark):
    text = lambda n: " ".join(["you are an idiot."] * n)
    docs = spark.createDataFrame([(n, text(n)) for n in (0, 1, 3, 4, 40)], "doc_id long, text string")
    model = t.Model([], -8.0, list(t.MATCHES.values()))
    rows = sorted(t.score(docs, model).collect())
    assert [r.aimed for r in rows] == [0, 1, 3, 4, 40]
    linear = [-8.0, -5.0, 1.0, -8 + 3 * (3 + np.log(2)), -8 + 3 * (3 + np.log(38))]
    assert np.allclose([r.score for r in rows], 1 / (1 + np.exp(-np.array(linear))))
    kept = {r.doc_id for r in t.drop_toxic(docs.withColumn("aimed", F.lit(1)), model).collect()}
    assert kept == {r.doc_id for r in rows if r.score < 0.5}
