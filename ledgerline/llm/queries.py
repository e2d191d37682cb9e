"""The registered queries of the operators, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, words_of
from ledgerline.llm.decontaminate import contamination
from ledgerline.llm.html_extract import extract_text
from ledgerline.llm.lexical_search import ranked_search
from ledgerline.llm.mixing import mix_counts
from ledgerline.llm.ngram_join import near_duplicates
from ledgerline.llm.oracles import ORACLES
from ledgerline.llm.periodic_runs import periodic_runs
from ledgerline.llm.quality_ranker import score_quality, train_ranker
from ledgerline.llm.quality_rules import judge_quality, train_rules
from ledgerline.llm.quotation import link_quotes
from ledgerline.llm.secret_scan import BASE, secret_spans
from ledgerline.llm.sharding import shard_documents
from ledgerline.llm.toxicity import score_toxicity, train_toxicity
from ledgerline.llm.url_filter import judge_urls


def op1_quality_ranker(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, train_ranker(docs, table(spark, sf_dir, "labels")))


def op2_quotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(table(spark, sf_dir, "conversations"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_chars")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge_quality(docs, train_rules(docs, table(spark, sf_dir, "labels")))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=85)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text")))


def secret_digests(found: DataFrame) -> DataFrame:
    """What secret_spans() found, as counts, a digest of the spans by pattern, and all spans as text."""

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint")

    base = F.filter("secrets", lambda x: x["kind"].isin(*BASE))
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE], F.sha2(told(base), 256).alias("base_sha256"), told(F.col("secrets")).alias("spans"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text), where of each tenth text, by a hash of doc_id, the words from a place on repeat those there.

    A null doc_id has no hash, so its text stays.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    told = docs.withColumns({"_g": F.floor(h / 10), "_words": F.when(h % 10 == 0, words_of(F.col("text")))}).withColumn("_n", F.size("_words").cast("bigint"))
    placed = told.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n"))).withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)))
    n, a, p, words = F.col("_n").cast("int"), F.col("_a").cast("int"), F.col("_p").cast("int"), F.col("_words")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    said = F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), again), F.lit(1), n), " ")
    return placed.select("doc_id", F.when(F.col("_n") > 0, said).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """What periodic_runs() found, as the longest run of each text and digests."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    told = found.withColumn("_longest", longest)
    length, period = F.col("_longest.length"), -F.col("_longest.period")
    return told.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_longest.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_ranker, op2_quotation, op3_decontaminate, op4_url_filter, op5_toxicity, op6_quality_rules, op7_html_extract, op8_mixing, op9_sharding, op10_ngram_join,
        op11_lexical_search, op12_secret_scan, op13_periodic_runs,
    )
}
