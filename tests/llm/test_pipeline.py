import corpus_pipeline
from tests.llm.helpers import prose
from tests.llm.test_dedup import brute_classes, brute_exact
from tests.llm.test_text import brute_contamination
from tidemark.llm import toxicity


def test_stages_keep_what_brute_force_keeps(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scorer = toxicity.Scorer(model)
    left = {i: t for i, t in held.items() if scorer.score(t) < 0.5}
    left = {r[0]: left[r[0]] for r in brute_exact(list(left.items())) if r[3]}
    classes = brute_classes(list(left.items()))
    left = {i: t for i, t in left.items() if classes[i] == i}
    left = {i: t for i, t in left.items() if str(i) not in {r[0] for r in brute_contamination(list(left.items()), items) if r[5]}}
    out = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(left)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_return_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs.limit(30), sf)
        assert kept.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_null_and_repeated_ids_lose_no_text(spark, sf, tmp_path):
    """Different texts without id, and under one id, pass every stage; their copies do not."""
    texts = [prose(60, 4000 + k) for k in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(4, t) for t in texts[4:7]] + [(9, texts[7]), (None, texts[0] + " "), (12, texts[7].upper()), (4, texts[4])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
    assert sorted(" ".join(r.text.lower().split()) for r in kept.collect()) == sorted(texts)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(texts)
