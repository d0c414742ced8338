import plain

import corpus_pipeline
from calipers.llm import sharding, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    moves, outputs = toxicity.compiled(toxicity.GRAMMAR, range(6))
    known = toxicity.lexicon(model.learnt)

    def is_toxic(text):
        found = toxicity.clause_matches(text or "", known, moves, outputs)
        return model.bias + sum(w * min(found[m], 3) for m, w in zip(toxicity.MATCHES, model.weights, strict=True)) >= 0

    texts = {r.doc_id: r.text for r in docs.collect()}
    (_, toxic), (_, near), (_, leaks), (_, mixed), (_, sharded) = corpus_pipeline.STAGES
    clean = toxic(spark, docs, SF)
    left = {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and left == {i for i, t in texts.items() if not is_toxic(t)} != set(texts)
    single = near(spark, clean, SF)
    left = {r.doc_id for r in single.collect()}
    want = {c for _, c, _ in plain.near_classes([(i, texts[i]) for i in sorted({r.doc_id for r in clean.collect()})])}
    assert single.columns == columns and left == want
    bench = [plain.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    unleaked = leaks(spark, single, SF)
    kept = {r.doc_id for r in unleaked.collect()}
    for i in left:
        w = plain.words(texts[i])
        held = any(b" ".join(item) in b" ".join(w) for item in bench)
        assert not (held and i in kept)
        if i not in kept and not held:
            assert min(plain.edit_distance_to_part(item, w) / len(item) for item in bench) <= 0.2
    order = mixed(spark, unleaked, SF)
    assert order.columns == columns and {r.doc_id for r in order.collect()} <= kept
    out = sharded(spark, order, SF).collect()
    assert len(out) == order.count()
    assert all(r.shard == int(sharding.jump_hash(sharding.np.array([r.doc_id], dtype="uint64"), 8)[0]) for r in out)


def test_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
