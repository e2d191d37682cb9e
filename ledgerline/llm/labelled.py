"""A bounded sample of labelled rows for the models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Documents with a 0/1 label that may be learnt from, with the column `_label`.

    At most `most` labels of each class, those with the smallest hash of doc_id, so that reruns agree; half of them at
    least are of the rarer class where it has as many. Labels of held-out rows, null ids and null labels are never read.
    The labels taken are bounded by 2 * `most`, so they can be sent to every executor.
    """
    spark = docs.sparkSession
    usable = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id"))
    )
    taken = []
    for value in (0, 1):
        taken += usable.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(most).collect()
    small = spark.createDataFrame([tuple(r) for r in taken], usable.schema)
    return docs.join(F.broadcast(small), F.col("doc_id") == F.col("_id"), "inner").drop("_id")


def class_shares(labels: DataFrame, label: str) -> tuple[int, int]:
    """How many labels that may be learnt from are 0, and how many 1."""
    rows = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col(label).cast("int").alias("v")).count().where(F.col("v").isin(0, 1)).collect()
    found = {r.v: r["count"] for r in rows}
    return found.get(0, 0), found.get(1, 0)


def always(value: float) -> Column:
    return F.lit(float(value))
