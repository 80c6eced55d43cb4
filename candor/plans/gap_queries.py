"""Reports, filters, lookups and work lists over candidates with missing values.

The rows are those of `candidates`, with NULL or blank ids, NULL splits, indexes, flags, scores, lengths and messages at places that the keys of a row decide. Groups without a key drop
out, missing values stay out of means and counts, a missing flag is neither true nor false, and a row without an id is told apart by question and split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.messages import final_text, from_json_text
from candor.operators import joins as J
from candor.operators import regeneration as G
from candor.operators import reports as R
from candor.operators import selection as P
from candor.plans.fixtures import CANDIDATES, derived, select_sql
from candor.plans.registry import query
from candor.plans.report_queries import V, rate_sql, rounded, runs
from candor.plans.table_queries import REGENERATED, regenerated
from candor.plans.text_queries import KEY


def gap(column: str, where: str) -> str:
    return f"(CASE WHEN {where} THEN NULL ELSE {CANDIDATES[column]} END)"


GAPS = {
    **CANDIDATES,
    "query_id": f"(CASE (l_orderkey + l_linenumber) % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {CANDIDATES['query_id']} END)",
    "split": gap("split", "l_suppkey % 5 = 0"),
    "candidate_idx": gap("candidate_idx", "l_partkey % 17 = 0"),
    "run_id": gap("run_id", "l_suppkey % 12 = 1"),
    "input_messages": gap("input_messages", "l_partkey % 19 = 0"),
    "source_metadata": gap("source_metadata", "l_partkey % 13 = 0"),
    "verification_is_verified": gap("verification_is_verified", "l_partkey % 6 = 0"),
    "verification_score": gap("verification_score", "l_partkey % 4 = 1"),
    "refusal_is_refusal": gap("refusal_is_refusal", "l_suppkey % 6 = 1"),
    "refusal_type": gap("refusal_type", "l_partkey % 9 = 0"),
    "quality_answer_length": gap("quality_answer_length", "l_partkey % 8 = 0"),
    "quality_reasoning_length": gap("quality_reasoning_length", "l_partkey % 10 = 0"),
    "quality_is_short_answer": gap("quality_is_short_answer", "l_partkey % 8 = 0"),
    "quality_is_substantive": gap("quality_is_substantive", "l_partkey % 11 = 0"),
    "quality_has_reasoning": gap("quality_has_reasoning", "l_partkey % 10 = 0"),
    "quality_completeness_score": gap("quality_completeness_score", "l_partkey % 14 = 0"),
    "harmony_channels_detected": gap("harmony_channels_detected", "l_partkey % 3 = 0"),
}
W = f"WITH cand AS ({select_sql(GAPS, 'lineitem')}) "


def with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "lineitem", GAPS)


@query("a02_gaps", W + "SELECT count(DISTINCT query_id) AS queries FROM cand")
def ids(spark: SparkSession, folder: str) -> DataFrame:
    return R.query_count(with_gaps(spark, folder))


@query("a03_gaps", W + f"SELECT string_agg(DISTINCT split, ',' ORDER BY split) AS splits, {rate_sql(V)} AS verified_rate FROM cand")
def overview(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.split_overview(with_gaps(spark, folder)), "verified_rate")


@query(
    "a04_a06_gaps",
    W + f"""SELECT split, samples, verified_rate, avg_score, first_rate, any_rate FROM
      (SELECT split, count({V}) AS samples, {rate_sql(V)} AS verified_rate, round(avg(verification_score), 6) AS avg_score, {rate_sql(f"CASE WHEN candidate_idx = 0 THEN {V} END")} AS first_rate
       FROM cand WHERE split IS NOT NULL GROUP BY split)
    JOIN (SELECT split, {rate_sql('any_v')} AS any_rate FROM
      (SELECT split, query_id, bool_or({V}) AS any_v FROM cand WHERE query_id IS NOT NULL GROUP BY split, query_id) GROUP BY split) USING (split)""",
)
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.split_report(with_gaps(spark, folder)), "verified_rate", "avg_score", "first_rate", "any_rate")


@query("a05_gaps", W + f'SELECT candidate_idx, count({V}) AS "count", {rate_sql(V)} AS verified_rate FROM cand WHERE candidate_idx IS NOT NULL GROUP BY candidate_idx')
def by_candidate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.candidate_rates(with_gaps(spark, folder)), "verified_rate")


@query(
    "a06_gaps",
    W + f"SELECT (SELECT {rate_sql(V)} FROM cand WHERE candidate_idx = 0) AS first_rate, {rate_sql('any_v')} AS any_rate "
    f"FROM (SELECT query_id, bool_or({V}) AS any_v FROM cand WHERE query_id IS NOT NULL GROUP BY query_id)",
)
def first_or_any(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.first_versus_any(with_gaps(spark, folder)), "first_rate", "any_rate")


@query(
    "a07_gaps",
    W + 'SELECT refusal_type, count(*) AS "count", round(count(*) * 1.0 / (SELECT count(*) FROM cand WHERE refusal_is_refusal), 6) AS share '
    "FROM cand WHERE refusal_is_refusal AND refusal_type IS NOT NULL GROUP BY refusal_type",
)
def refusals(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.refusal_types(with_gaps(spark, folder)), "share")


@query("a07_summary_gaps", W + f"SELECT {rate_sql('refusal_is_refusal')} AS refusal_rate, count(*) FILTER (WHERE refusal_is_refusal) AS refusals FROM cand")
def refusal_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.refusal_summary(with_gaps(spark, folder)), "refusal_rate")


@query(
    "a08_gaps",
    W + "SELECT median(quality_answer_length) AS answer_median, round(avg(quality_answer_length), 6) AS answer_mean, "
    "median(quality_reasoning_length) AS reasoning_median, round(avg(quality_reasoning_length), 6) AS reasoning_mean FROM cand",
)
def lengths(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.length_summary(with_gaps(spark, folder)), "answer_mean", "reasoning_mean")


@query(
    "a09_gaps",
    W + f"SELECT {rate_sql('quality_has_reasoning')} AS has_reasoning_rate, {rate_sql('quality_is_substantive')} AS substantive_rate, "
    f"round(avg(quality_completeness_score), 6) AS completeness_mean, {rate_sql('harmony_channels_detected')} AS channel_rate FROM cand",
)
def quality(spark: SparkSession, folder: str) -> DataFrame:
    report = R.quality_rates(with_gaps(spark, folder))
    return rounded(report, *report.columns)


TERSE = "quality_is_short_answer AND quality_reasoning_length > 100"


@query("a10_gaps", W + f'SELECT count(*) FILTER (WHERE {TERSE}) AS "count", round(count(*) FILTER (WHERE {TERSE}) * 1.0 / count(*), 6) AS share FROM cand')
def terse(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.terse_but_reasoned(with_gaps(spark, folder)), "share")


@query(
    "a11_gaps",
    W + f"""SELECT run_id, count(DISTINCT query_id) AS queries, count(*) AS records, {rate_sql(V)} AS verified_rate, {rate_sql(f"CASE WHEN candidate_idx = 0 THEN {V} END")} AS first_rate,
    coalesce('model-' || run_id, 'unknown') AS model, CAST(4 + CAST(run_id AS INT) AS INT) AS num_candidates FROM cand GROUP BY run_id""",
)
def by_run(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.compare_run_files(with_gaps(spark, folder), runs(spark)), "verified_rate", "first_rate")


@query(
    "j01_gaps",
    W + f"""SELECT split, count(*) AS rows, count(DISTINCT query_id) AS queries FROM cand c
    WHERE NOT EXISTS (SELECT 1 FROM cand d WHERE d.{V} AND d.query_id = c.query_id) GROUP BY split""",
)
def open_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_gaps(spark, folder)
    left = J.skip_completed(rows, rows.where(V))
    return left.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("query_id").alias("queries"))


HAS_ID = "nullif(query_id, '') IS NOT NULL"
ASKED = "(CASE WHEN input_messages IS NULL THEN '' ELSE question END)"


@query(
    "j02_gaps",
    W + f""", met AS (SELECT c.*, o.status, coalesce(c.split = 'math', false) AND NOT o.is_empty AND coalesce(c.candidate_idx, 0) < 3
        AND coalesce(CASE WHEN o.query_id IS NULL THEN input_messages IS NOT NULL ELSE c.query_id = o.query_id END, false) AS hit, coalesce(c.candidate_idx, 0) AS place
      FROM cand c JOIN ({select_sql(REGENERATED, 'orders')}) o ON o.question = c.question)
    SELECT query_id, arrival, hit AS updated, CASE WHEN hit THEN 'raw ' || place || ' ' || status END AS raw_response,
      CASE WHEN hit THEN 'answer ' || place || ' ' || status ELSE answer END AS final_text, CASE WHEN hit AND place = 1 THEN 1 ELSE 2 END AS messages FROM met""",
)
def merged(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_gaps(spark, folder).drop("analysis")
    out = G.merge_results(rows, regenerated(spark, folder), split="math", stamp=F.lit("2024-01-01T00:00:00"), arrival=["placed"])
    messages = from_json_text(F.col("output_messages"))
    return out.select(*KEY, F.col("regenerated_at").isNotNull().alias("updated"), "raw_response", final_text(messages).alias("final_text"), F.size(messages).alias("messages"))


@query("p09_gaps", W + f"SELECT query_id, arrival FROM cand WHERE split = 'code' AND {V} = false")
def failed(spark: SparkSession, folder: str) -> DataFrame:
    return P.filter_rows(with_gaps(spark, folder), "code", failed_only=True).select(*KEY)


@query("p12_gaps", W + f"SELECT query_id, arrival FROM cand WHERE {V} AND refusal_is_refusal = false AND quality_is_substantive AND quality_completeness_score > 0.6")
def good(spark: SparkSession, folder: str) -> DataFrame:
    return P.filter_quality(with_gaps(spark, folder)).select(*KEY)


QUERY_KEY = f"CASE WHEN {HAS_ID} THEN 'i' || query_id ELSE 'q' || coalesce(split, 'unknown') || '|' || {ASKED} END"
FIRST = f"""SELECT nullif(query_id, '') AS query_id, {ASKED} AS question, ground_truth_answer AS ground_truth, coalesce(split, 'unknown') AS split, coalesce(source_metadata, '{{}}') AS metadata, arrival
  FROM (SELECT *, row_number() OVER (PARTITION BY {QUERY_KEY} ORDER BY arrival) AS n FROM cand %s) WHERE n = 1"""


@query("w01_gaps", W + FIRST % "")
def unique(spark: SparkSession, folder: str) -> DataFrame:
    found = G.unique_queries(with_gaps(spark, folder).drop("question", "ground_truth"), ["arrival"])
    return found.select("query_id", "question", "ground_truth", "split", "metadata", F.col("first_row.arrival").alias("arrival"))


@query("v19_gaps", W + f"SELECT query_id, question, ground_truth FROM ({FIRST % f'WHERE split = {chr(39)}code{chr(39)} AND {V} = false'})")
def work_list(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_gaps(spark, folder).drop("question", "ground_truth")
    return G.plan_regeneration(rows, ["arrival"], "code", True).select("query_id", "question", "ground_truth")


@query("a26_gaps", W + f"SELECT count(*) AS rows, count(DISTINCT {QUERY_KEY}) AS queries FROM cand WHERE split = 'code' AND {V} = false")
def touched(spark: SparkSession, folder: str) -> DataFrame:
    return G.dry_run(with_gaps(spark, folder).drop("question", "ground_truth"), "code", True)
