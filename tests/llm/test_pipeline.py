"""The pipeline's stages on a small table: what each keeps, and that its decisions reach the next."""

from pyspark.sql import functions as F

import corpus_pipeline


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.count()
        docs = stage(spark, docs, sf_dir).persist()
        if name in ("toxicity", "near_duplicates", "decontamination"):
            assert docs.columns == columns and 0 < docs.count() <= before
            assert docs.select("doc_id").distinct().count() == docs.count()
        elif name == "mixing":
            assert docs.columns == columns and docs.where(F.length("text") == 0).isEmpty()
        else:
            assert docs.count() == before and docs.where("shard not between 0 and 7").isEmpty()
            assert docs.groupBy("doc_id").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()


def test_an_empty_corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_odd_documents_pass_every_stage(spark, sf_dir):
    """Nulls in any column, empty and long texts, repeated rows, and columns named like those that the stages add."""
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, n_words int, size int, hash string, rid int, shard int, slot bigint, digest int, _rid int"
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = [(None, "a text without an id, of some words"), (1, None), (2, ""), (3, long), (3, long), (4, "twice the same row here"), (4, "twice the same row here"), (None, None), (5, "\n \t"), (6, "Single")]
    extra = (0.5, 7, 8, "h", 9, 10, 11, 12, 13)
    docs = spark.createDataFrame([(d, t, None, ["a", None][i % 2], None, *extra) for i, (d, t) in enumerate(texts)], kind)
    sizes = []
    for _, stage in corpus_pipeline.STAGES:
        before = docs.columns
        docs = stage(spark, docs, sf_dir).persist()
        assert set(before) <= set(docs.columns)
        sizes.append(docs.count())
        assert docs.where("score <> 0.5 or n_words <> 7 or size <> 8 or hash <> 'h' or rid <> 9 or digest <> 12 or _rid <> 13").isEmpty()
    assert sizes[:3] == [10, 8, 8]
    kept = {(r.doc_id, r.text and r.text[:5]) for r in docs.select("doc_id", "text").collect()}
    assert {d for d, _ in kept} <= {None, 3, 4, 6} and docs.where("shard not between 0 and 7").isEmpty()
