"""Style audits over stored messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.style import MARKERS, VAGUE
from candor.operators import style_reports as A
from candor.plans.fixtures import CAND_CTE, candidates, table
from candor.plans.registry import query
from candor.plans.report_queries import rounded
from candor.plans.text_queries import CONTRACTION_SQL, matches_sql

COUNTS = ", ".join(f"{matches_sql('style_text', p)} AS {m}" for m, p in MARKERS.items())
PRESENT = " + ".join(f"CAST({m} > 0 AS INT)" for m in MARKERS)
W = f"WITH {CAND_CTE}, marked AS (SELECT *, {PRESENT} AS markers FROM (SELECT cand.*, {COUNTS} FROM cand)), "
W += f"found AS (SELECT *, len(list) AS n FROM (SELECT *, regexp_extract_all(style_text, '{CONTRACTION_SQL}', 1) AS list FROM cand)) "


def styled(spark: SparkSession, folder: str) -> DataFrame:
    """Candidates whose stored messages hold the style texts."""
    return candidates(spark, folder).withColumn("output_messages", F.col("style_messages"))


def marked(spark: SparkSession, folder: str) -> DataFrame:
    rows = styled(spark, folder)
    rows = rows.withColumn("response", A.response_text(rows))
    return A.with_markers(rows, F.col("response"))


def contracted(spark: SparkSession, folder: str) -> DataFrame:
    rows = styled(spark, folder)
    rows = rows.withColumn("answer_text", A.answer_only(rows))
    return A.with_contractions(rows, F.col("answer_text"))


@query(
    "a13_marker_frequency",
    W + " UNION ALL ".join(
        f"SELECT '{m}' AS marker, round(count(*) FILTER (WHERE {m} > 0) * 1.0 / count(*), 6) AS frequency, CAST(sum({m}) AS BIGINT) AS total, round(sum({m}) * 1.0 / count(*), 6) AS per_response FROM marked"
        for m in MARKERS
    ),
)
def a13(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.marker_frequency(marked(spark, folder)), "frequency", "per_response")


@query("a14_marker_summary", W + "SELECT round(avg(markers), 6) AS avg_markers, round(avg(CAST(markers >= 3 AS INT)), 6) AS strong_rate FROM marked")
def a14(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.marker_summary(marked(spark, folder)), "avg_markers", "strong_rate")


@query("a15_marker_histogram", W + 'SELECT markers AS marker_count, count(*) AS "count", round(count(*) * 1.0 / (SELECT count(*) FROM marked), 6) AS share FROM marked GROUP BY markers ORDER BY markers')
def a15(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.marker_histogram(marked(spark, folder)), "share")


@query("a16_marker_splits", W + "SELECT split, count(*) AS samples, round(avg(CAST(markers >= 3 AS INT)), 6) AS strong_rate, round(avg(markers), 6) AS avg_markers FROM marked GROUP BY split")
def a16(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.marker_splits(marked(spark, folder)), "strong_rate", "avg_markers")


@query(
    "a17_contraction_summary",
    W + "SELECT count(*) AS responses, count(*) FILTER (WHERE n > 0) AS with_contractions, CAST(sum(n) AS BIGINT) AS total, round(avg(n), 6) AS per_response, "
    "round(avg(CAST(n = 0 AS INT)), 6) AS success_rate, round(avg(CAST(n > 0 AS INT)), 6) AS violation_rate FROM found",
)
def a17(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.contraction_summary(contracted(spark, folder)), "per_response", "success_rate", "violation_rate")


@query("a18_k02_common_contractions", W + 'SELECT contraction, count(*) AS "count" FROM (SELECT unnest(list) AS contraction FROM found) GROUP BY contraction ORDER BY 2 DESC, 1 LIMIT 10')
def a18(spark: SparkSession, folder: str) -> DataFrame:
    return A.common_contractions(contracted(spark, folder))


@query(
    "a19_contraction_splits",
    W + "SELECT split, count(*) AS samples, round(avg(CAST(n > 0 AS INT)), 6) AS violation_rate, CAST(sum(n) AS BIGINT) AS total, round(1 - avg(CAST(n > 0 AS INT)), 6) AS success_rate FROM found GROUP BY split",
)
def a19(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(A.contraction_splits(contracted(spark, folder)), "violation_rate", "success_rate")


NAMES = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {m} > 0 THEN '{m}' END" for m in MARKERS) + "], lambda m: m IS NOT NULL), ', ')"


@query("k04_strong_examples", W + f"SELECT query_id, {NAMES} AS markers, replace(substr(style_text, 1, 300), chr(10), ' ') AS preview FROM marked WHERE markers >= 3 ORDER BY query_id, arrival LIMIT 3")
def k04(spark: SparkSession, folder: str) -> DataFrame:
    return A.strong_examples(marked(spark, folder), "response", ["query_id", "arrival"])


@query("k04_violation_examples", W + "SELECT query_id, array_to_string(list, ', ') AS contractions, replace(substr(style_text, 1, 200), chr(10), ' ') AS preview FROM found WHERE n > 0 ORDER BY query_id, arrival LIMIT 5")
def k04_violations(spark: SparkSession, folder: str) -> DataFrame:
    return A.violation_examples(contracted(spark, folder), "answer_text", ["query_id", "arrival"])


@query(
    "o03_vague_prompts",
    f"""SELECT lang, count(*) AS prompts, count(*) FILTER (WHERE regexp_matches(t, '{VAGUE}', 'i')) AS vague
    FROM (SELECT lang, text || CASE doc_id % 4 WHEN 0 THEN ' Use Some Formula.' WHEN 1 THEN ' Take a certain number of it.' ELSE '' END AS t FROM documents) GROUP BY lang""",
)
def o03(spark: SparkSession, folder: str) -> DataFrame:
    ending = F.when(F.col("doc_id") % 4 == 0, F.lit(" Use Some Formula.")).when(F.col("doc_id") % 4 == 1, F.lit(" Take a certain number of it.")).otherwise(F.lit(""))
    docs = table(spark, folder, "documents").withColumn("prompt", F.concat("text", ending))
    return A.vague_prompts(docs, F.col("prompt"), "lang")


@query(
    "o05_transfer",
    W + """, totals AS (SELECT run_id, sum(""" + " + ".join(MARKERS) + f""") AS m, sum(len(regexp_extract_all(style_text, '{CONTRACTION_SQL}', 1))) AS c FROM marked GROUP BY run_id)
    SELECT CAST(b.m AS BIGINT) AS base_markers, CAST(t.m AS BIGINT) AS tuned_markers, CAST(b.c AS BIGINT) AS base_contractions, CAST(t.c AS BIGINT) AS tuned_contractions, round((1 - t.c * 1.0e0 / b.c) * 100, 6) AS improvement
    FROM totals b, totals t WHERE b.run_id = '0' AND t.run_id = '1'""",
)
def o05(spark: SparkSession, folder: str) -> DataFrame:
    both = A.with_contractions(marked(spark, folder), F.col("response"))
    return rounded(A.transfer(both, "run_id", "0", "1"), "improvement")
