"""Queries over transaction-id sets, with their SQL: the SQL works on single ids, not on intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import gtid
from ledgerline.operators.delivery import deduplicated, gap_check
from ledgerline.operators.snapshot import ready_chunks
from ledgerline.sources.changelog import change_log
from ledgerline.sources.scratch import stored

CL = """cl AS (
  SELECT event_id AS seq, '00000000-0000-0000-0000-00000000000' || (user_id % 3)::VARCHAR AS source_uuid,
         row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) AS gno, user_id AS pk,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS op, ts AS commit_ts, value, event_type
  FROM events)"""
#: Two sets with gaps, by predicates on the change log.
A, B = "event_type <> 'error'", "gno % 5 <> 0 AND event_type <> 'view'"


def islands(points: str) -> str:
    """SQL for the intervals of a query of (source_uuid, gno)."""
    return f"""SELECT source_uuid, min(gno)::BIGINT AS lo, max(gno)::BIGINT AS hi
      FROM (SELECT source_uuid, gno, gno - row_number() OVER (PARTITION BY source_uuid ORDER BY gno) AS g FROM (SELECT DISTINCT source_uuid, gno FROM ({points})))
      GROUP BY source_uuid, g"""


RENDER = """SELECT source_uuid || ':' || string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ':' ORDER BY lo) AS s FROM {rows} GROUP BY source_uuid"""


def points(where: str) -> str:
    return f"SELECT source_uuid, gno FROM cl WHERE {where}"


def sets(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    log = change_log(spark, sf_dir)
    return log, gtid.from_points(log.where(A)), gtid.from_points(log.where(B))


def q01_processed_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets(spark, sf_dir)[1]


def q02_render_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gtid.render(sets(spark, sf_dir)[1])


def q03_parse_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gtid.parse(gtid.render_sources(sets(spark, sf_dir)[1]), "gtid_set")


def q04_member_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, _, b = sets(spark, sf_dir)
    return gtid.members(log, b).select("seq", "source_uuid", "gno")


def q05_member_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, _, b = sets(spark, sf_dir)
    return gtid.non_members(log, b).select("seq", "source_uuid", "gno")


def q06_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, a, b = sets(spark, sf_dir)
    return gtid.union(a, b)


def q07_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, a, b = sets(spark, sf_dir)
    return gtid.subtract(a, b)


def q08_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, a, b = sets(spark, sf_dir)
    return gtid.intersect(a, b)


def q09_subset_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = (stored(x, "compared-set") for x in sets(spark, sf_dir)[1:])  # each is looked at more than once below
    both = stored(gtid.intersect(a, b), "compared-set")
    out = gtid.is_subset(both, a).withColumnRenamed("yes", "both_in_a")
    out = out.crossJoin(gtid.is_subset(a, b).withColumnRenamed("yes", "a_in_b"))
    out = out.crossJoin(gtid.is_disjoint(gtid.subtract(a, b), b).withColumnRenamed("yes", "rest_apart"))
    out = out.crossJoin(gtid.is_equal(gtid.union(a, both), a).withColumnRenamed("yes", "union_is_a"))
    return out.crossJoin(gtid.count_points(a).withColumnRenamed("n", "n_points"))


def _cases(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(0, 100, 50, 0), (1, 50, 100, 0), (2, 100, 50, 7), (3, 0, 100, 0)], "case_id int, upto int, purged int, beyond int")


def q10_gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = _cases(spark)
    log = change_log(spark, sf_dir).select("source_uuid", "gno").crossJoin(F.broadcast(cases))  # four rows
    keys = ("case_id", "source_uuid")
    executed = gtid.from_points(log, keys=keys)
    purged = gtid.from_points(log.where("gno <= purged"), keys=keys)
    checkpoint = gtid.from_points(log.where("gno <= upto").select(*keys, "gno").union(log.where("gno <= beyond").select(*keys, (F.col("gno") + 1_000_000_000).alias("gno"))), keys=keys)
    return gap_check(executed, purged, checkpoint, cases)


def q25_advance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir)
    processed = gtid.from_points(log.where("seq % 400 <> 399"))
    chunks = spark.range(8).select(F.col("id").alias("chunk_seq"))
    upto = log.groupBy("source_uuid").agg(F.max("gno").alias("top")).crossJoin(F.broadcast(chunks))  # eight rows
    captured = upto.select("chunk_seq", "source_uuid", F.lit(1).alias("lo"), F.greatest(F.floor(F.col("top") * F.col("chunk_seq") / 40), F.lit(1)).alias("hi"))
    return ready_chunks(captured, processed)


def q31_dedup_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = change_log(spark, sf_dir)
    top = log.agg(F.max("seq").alias("top"))
    marked = log.crossJoin(F.broadcast(top))  # one row
    processed = gtid.from_points(marked.where("seq <= top * 0.8"))
    return deduplicated(marked.where("seq > top * 0.5").drop("top"), processed).select("source_uuid", "gno", "op")


QUERIES = {
    f.__name__: f
    for f in (q01_processed_set, q02_render_set, q03_parse_set, q04_member_semi, q05_member_anti, q06_union, q07_subtract, q08_intersect, q09_subset_disjoint, q10_gap_check, q25_advance_gate, q31_dedup_replay)
}

ORACLES = {
    "q01_processed_set": f"WITH {CL} {islands(points(A))}",
    "q02_render_set": f"WITH {CL}, i AS ({islands(points(A))}), r AS ({RENDER.format(rows='i')}) SELECT coalesce(string_agg(s, ',' ORDER BY s), '') AS gtid_set FROM r",
    "q03_parse_set": f"WITH {CL} {islands(points(A))}",
    "q04_member_semi": f"WITH {CL} SELECT seq, source_uuid, gno FROM cl WHERE EXISTS (SELECT 1 FROM cl AS b WHERE b.source_uuid = cl.source_uuid AND b.gno = cl.gno AND b.gno % 5 <> 0 AND b.event_type <> 'view')",
    "q05_member_anti": f"WITH {CL} SELECT seq, source_uuid, gno FROM cl WHERE NOT EXISTS (SELECT 1 FROM cl AS b WHERE b.source_uuid = cl.source_uuid AND b.gno = cl.gno AND b.gno % 5 <> 0 AND b.event_type <> 'view')",
    "q06_union": f"WITH {CL} {islands(points(A) + ' UNION ' + points(B))}",
    "q07_subtract": f"WITH {CL} {islands(points(A) + ' EXCEPT ' + points(B))}",
    "q08_intersect": f"WITH {CL} {islands(points(A) + ' INTERSECT ' + points(B))}",
    "q09_subset_disjoint": f"""WITH {CL}, a AS ({points(A)}), b AS ({points(B)}), both_ AS (SELECT * FROM a INTERSECT SELECT * FROM b), rest AS (SELECT * FROM a EXCEPT SELECT * FROM b)
      SELECT (SELECT count(*) FROM (SELECT * FROM both_ EXCEPT SELECT * FROM a)) = 0 AS both_in_a, (SELECT count(*) FROM rest) = 0 AS a_in_b,
             (SELECT count(*) FROM (SELECT * FROM rest INTERSECT SELECT * FROM b)) = 0 AS rest_apart,
             (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM both_)) = (SELECT count(*) FROM a) AS union_is_a, (SELECT count(*) FROM a)::BIGINT AS n_points""",
    "q10_gap_check": f"""WITH {CL}, cases(case_id, upto, purged, beyond) AS (VALUES (0, 100, 50, 0), (1, 50, 100, 0), (2, 100, 50, 7), (3, 0, 100, 0)),
      ck AS (SELECT case_id, source_uuid, gno FROM cl, cases WHERE gno <= upto UNION ALL SELECT case_id, source_uuid, gno + 1000000000 FROM cl, cases WHERE gno <= beyond)
      SELECT case_id, CASE WHEN NOT EXISTS (SELECT 1 FROM ck WHERE ck.case_id = cases.case_id) THEN 'ok'
        WHEN EXISTS (SELECT 1 FROM ck WHERE ck.case_id = cases.case_id AND NOT EXISTS (SELECT 1 FROM cl WHERE cl.source_uuid = ck.source_uuid AND cl.gno = ck.gno)) THEN 'source_identity_mismatch'
        WHEN EXISTS (SELECT 1 FROM cl WHERE gno <= purged AND NOT EXISTS (SELECT 1 FROM ck WHERE ck.case_id = cases.case_id AND ck.source_uuid = cl.source_uuid AND ck.gno = cl.gno)) THEN 'data_gap' ELSE 'ok' END AS verdict
      FROM cases""",
    "q25_advance_gate": f"""WITH {CL}, t AS (SELECT source_uuid, max(gno) AS top FROM cl GROUP BY 1), g AS (SELECT c AS chunk_seq, source_uuid, greatest(top * c // 40, 1) AS hi FROM t, range(8) AS r(c))
      SELECT chunk_seq::BIGINT AS chunk_seq, NOT bool_or(EXISTS (SELECT 1 FROM cl WHERE cl.source_uuid = g.source_uuid AND cl.gno <= g.hi AND cl.seq % 400 = 399)) AS ready FROM g GROUP BY 1""",
    "q31_dedup_replay": f"""WITH {CL}, t AS (SELECT max(seq) AS top FROM cl) SELECT source_uuid, gno, op FROM cl, t WHERE seq > top * 0.5
      AND NOT EXISTS (SELECT 1 FROM cl AS p WHERE p.source_uuid = cl.source_uuid AND p.gno = cl.gno AND p.seq <= t.top * 0.8)""",
}
