"""Reports, rankings and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.config import DEFAULTS
from candor.functions.text import is_retryable
from candor.operators import reports as R
from candor.plans.fixtures import CAND_CTE, candidates, derived, select_sql, table
from candor.plans.registry import query
from candor.sources.runs import run_rows

W = f"WITH {CAND_CTE} "
V = "verification_is_verified"


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def rate_sql(flag: str) -> str:
    return f"round(avg(CASE WHEN {flag} THEN 1.0 WHEN NOT ({flag}) THEN 0.0 END), 6)"


@query("a01_record_count", W + "SELECT count(*) AS records FROM cand")
def a01(spark: SparkSession, folder: str) -> DataFrame:
    return R.record_count(candidates(spark, folder))


@query("a02_query_count", W + "SELECT count(DISTINCT query_id) AS queries FROM cand")
def a02(spark: SparkSession, folder: str) -> DataFrame:
    return R.query_count(candidates(spark, folder))


@query("a03_split_overview", W + f"SELECT string_agg(DISTINCT split, ',' ORDER BY split) AS splits, {rate_sql(V)} AS verified_rate FROM cand")
def a03(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.split_overview(candidates(spark, folder)), "verified_rate")


@query(
    "a04_split_rates",
    W + f"SELECT split, count({V}) AS samples, {rate_sql(V)} AS verified_rate, round(avg(verification_score), 6) AS avg_score "
    "FROM cand WHERE split IS NOT NULL GROUP BY split",
)
def a04(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.split_rates(candidates(spark, folder)), "verified_rate", "avg_score")


@query("a05_candidate_rates", W + f'SELECT candidate_idx, count({V}) AS "count", {rate_sql(V)} AS verified_rate FROM cand GROUP BY candidate_idx')
def a05(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.candidate_rates(candidates(spark, folder)), "verified_rate")


@query(
    "a06_first_versus_any",
    W + f"SELECT (SELECT {rate_sql(V)} FROM cand WHERE candidate_idx = 0) AS first_rate, {rate_sql('any_v')} AS any_rate "
    f"FROM (SELECT query_id, bool_or({V}) AS any_v FROM cand GROUP BY query_id)",
)
def a06(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.first_versus_any(candidates(spark, folder)), "first_rate", "any_rate")


@query(
    "a04_a06_split_report",
    W + f"""SELECT split, count(*) AS samples, {rate_sql(V)} AS verified_rate, round(avg(verification_score), 6) AS avg_score,
    {rate_sql(f"CASE WHEN candidate_idx = 0 THEN {V} END")} AS first_rate, any_value(any_rate) AS any_rate
    FROM cand JOIN (SELECT split, {rate_sql('any_v')} AS any_rate FROM
      (SELECT split, query_id, bool_or({V}) AS any_v FROM cand GROUP BY split, query_id) GROUP BY split) USING (split) GROUP BY split""",
)
def a04_a06(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.split_report(candidates(spark, folder)), "verified_rate", "avg_score", "first_rate", "any_rate")


@query("a07_refusal_summary", W + f"SELECT {rate_sql('refusal_is_refusal')} AS refusal_rate, count(*) FILTER (WHERE refusal_is_refusal) AS refusals FROM cand")
def a07(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.refusal_summary(candidates(spark, folder)), "refusal_rate")


REFUSAL_TYPES = (
    'SELECT refusal_type, count(*) AS "count", round(count(*) * 1.0 / (SELECT count(*) FROM cand WHERE refusal_is_refusal), 6) AS share '
    "FROM cand WHERE refusal_is_refusal AND refusal_type IS NOT NULL GROUP BY refusal_type ORDER BY 2 DESC, 1"
)


@query("a07_k03_w06_refusal_types", W + REFUSAL_TYPES)
def a07_types(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.refusal_types(candidates(spark, folder)), "share")


@query(
    "a08_length_summary",
    W + "SELECT median(quality_answer_length) AS answer_median, round(avg(quality_answer_length), 6) AS answer_mean, "
    "median(quality_reasoning_length) AS reasoning_median, round(avg(quality_reasoning_length), 6) AS reasoning_mean FROM cand",
)
def a08(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.length_summary(candidates(spark, folder)), "answer_mean", "reasoning_mean")


@query(
    "a09_quality_rates",
    W + f"SELECT {rate_sql('quality_has_reasoning')} AS has_reasoning_rate, {rate_sql('quality_is_substantive')} AS substantive_rate, "
    f"round(avg(quality_completeness_score), 6) AS completeness_mean, {rate_sql('harmony_channels_detected')} AS channel_rate FROM cand",
)
def a09(spark: SparkSession, folder: str) -> DataFrame:
    report = R.quality_rates(candidates(spark, folder))
    return rounded(report, *report.columns)


@query(
    "a10_terse_but_reasoned",
    W + 'SELECT count(*) FILTER (WHERE quality_is_short_answer AND quality_reasoning_length > 100) AS "count", '
    "round(count(*) FILTER (WHERE quality_is_short_answer AND quality_reasoning_length > 100) * 1.0 / count(*), 6) AS share FROM cand",
)
def a10(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.terse_but_reasoned(candidates(spark, folder)), "share")


def runs(spark: SparkSession) -> DataFrame:
    """Descriptions of the three runs that the candidates fall into."""
    return run_rows(spark, [
        {"run_id": str(i), "generated_at": "2024-01-01T00:00:00+00:00", "model": f"model-{i}", "api": "local", "num_candidates": 4 + i,
         "temperature": 0.7, "splits": "math,code,tool_calling", "notes": None}
        for i in range(3)
    ])


@query(
    "a11_compare_runs",
    W + f"""SELECT run_id, count(DISTINCT query_id) AS queries, count(*) AS records, {rate_sql(V)} AS verified_rate,
    {rate_sql(f"CASE WHEN candidate_idx = 0 THEN {V} END")} AS first_rate, 'model-' || run_id AS model,
    CAST(4 + CAST(run_id AS INT) AS INT) AS num_candidates FROM cand GROUP BY run_id""",
)
def a11(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.compare_run_files(candidates(spark, folder), runs(spark)), "verified_rate", "first_rate")


@query("a12_first_model", W + "SELECT model, temperature FROM cand ORDER BY query_id, arrival LIMIT 1")
def a12(spark: SparkSession, folder: str) -> DataFrame:
    return R.first_model(candidates(spark, folder), ["query_id", "arrival"])


# Up to three test cases per order, and results of two of them for one candidate; other results are missing.
CASE_LISTS = {"query_id": "CAST(o_orderkey AS STRING)", "n": "CAST(o_custkey % 4 AS INT)", "status": "o_orderstatus"}
CASE_RESULTS = {
    "query_id": "CAST(o_orderkey AS STRING)", "candidate_idx": "CAST(o_custkey % 3 AS INT)", "stdout": "'out ' || o_orderstatus", "stderr": "''",
    "exit_code": "(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END)", "timed_out": "(o_totalprice > 300000)", "error": "(CASE WHEN o_orderpriority = '1-URGENT' THEN 'boom' END)",
}


@query(
    "a20_case_pass_rates",
    W + f"""SELECT query_id, candidate_idx, count(*) FILTER (WHERE passed) AS passed, count(*) AS total,
    count(*) FILTER (WHERE passed) = count(*) AS is_correct, round(count(*) FILTER (WHERE passed) * 1.0 / count(*), 6) AS confidence
    FROM (SELECT c.query_id, c.candidate_idx, coalesce(exit_code = 0 AND NOT timed_out AND error IS NULL AND contains(stdout, expected), false) AS passed
      FROM cand c JOIN (SELECT query_id, unnest(range(n)) AS case_no, unnest([status, 'F', 'out'][1:n]) AS expected FROM ({select_sql(CASE_LISTS, 'orders')})) e USING (query_id)
      LEFT JOIN (SELECT *, unnest([0, 1]) AS case_no FROM ({select_sql(CASE_RESULTS, 'orders')})) r ON r.query_id = c.query_id AND r.candidate_idx = c.candidate_idx AND r.case_no = e.case_no)
    GROUP BY query_id, candidate_idx""",
)
def a20(spark: SparkSession, folder: str) -> DataFrame:
    from candor.operators.scoring import case_scores

    lists = derived(spark, folder, "orders", CASE_LISTS)
    cases = lists.select("query_id", F.slice(F.array(F.col("status"), F.lit("F"), F.lit("out")), F.lit(1), F.col("n")).alias("cases"))
    results = derived(spark, folder, "orders", CASE_RESULTS).withColumn("case_no", F.explode(F.array(F.lit(0), F.lit(1))))
    return rounded(case_scores(candidates(spark, folder), cases, results), "confidence")


@query(
    "x04_threshold_sweep",
    W + f"""SELECT split, threshold, count(*) AS rows, count(*) FILTER (WHERE verification_score >= threshold) AS accepted, round(count(*) FILTER (WHERE verification_score >= threshold) * 1.0 / count(*), 6) AS rate,
    count(*) FILTER (WHERE verification_score >= threshold AND {V}) AS accepted_true FROM cand, (SELECT i / 20.0e0 AS threshold FROM range(20) t(i)) GROUP BY split, threshold""",
)
def x04(spark: SparkSession, folder: str) -> DataFrame:
    """Acceptance at twenty thresholds from one pass."""
    return rounded(R.threshold_sweep(candidates(spark, folder), "verification_score", [i / 20 for i in range(20)], ["split"], F.col(V)), "rate")


@query(
    "a22_run_statistics",
    W + f"SELECT run_id, count(*) AS total_records, count(DISTINCT query_id) AS total_queries, {rate_sql(V)} AS avg_verification_rate, "
    f"{rate_sql('refusal_is_refusal')} AS avg_refusal_rate, round(avg(persona_score), 6) AS avg_persona_score FROM cand GROUP BY run_id",
)
def a22(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.run_statistics(candidates(spark, folder)), "avg_verification_rate", "avg_refusal_rate", "avg_persona_score")


@query(
    "a23_failure_guard",
    "SELECT user_id, count(*) AS tasks, count(*) FILTER (WHERE event_type = 'error') AS failed, "
    "count(*) FILTER (WHERE event_type = 'error') > count(*) * 0.2e0 AS abort FROM events GROUP BY user_id",
)
def a23(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return R.failure_guard(events, F.col("event_type") == "error", DEFAULTS.max_failure_rate, ["user_id"])


QUALITY_NUMBERS = ["quality_answer_length", "quality_reasoning_length", "quality_completeness_score"]


def describe_sql(name: str) -> str:
    quartiles = ", ".join(f"round(quantile_cont(CAST({name} AS DOUBLE), {q}), 6) AS {label}" for q, label in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")))
    return (
        f"SELECT '{name}' AS \"column\", CAST(count({name}) AS DOUBLE) AS \"count\", round(avg({name}), 6) AS mean, round(stddev_samp({name}), 6) AS std, "
        f"CAST(min({name}) AS DOUBLE) AS min, {quartiles}, CAST(max({name}) AS DOUBLE) AS max FROM cand"
    )


@query("a24_describe", W + " UNION ALL ".join(describe_sql(n) for n in QUALITY_NUMBERS))
def a24(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.numeric_describe(candidates(spark, folder), QUALITY_NUMBERS), "mean", "std", "p25", "p50", "p75")


@query("k01_histogram", W + 'SELECT candidate_idx, count(*) AS "count" FROM cand GROUP BY candidate_idx ORDER BY candidate_idx')
def k01(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).groupBy("candidate_idx").agg(F.count("*").alias("count")).orderBy("candidate_idx")


@query("w05_first_candidate_flag", W + f"SELECT candidate_idx = 0 AS is_first, count(*) AS rows, {rate_sql(V)} AS verified_rate FROM cand GROUP BY 1")
def w05(spark: SparkSession, folder: str) -> DataFrame:
    flagged = candidates(spark, folder).withColumn("is_first", F.col("candidate_idx") == 0)
    grouped = flagged.groupBy("is_first").agg(F.count("*").alias("rows"), R.rate(V).alias("verified_rate"))
    return rounded(grouped, "verified_rate")


@query(
    "f29_retryable_errors",
    """SELECT retryable, count(*) AS events FROM (SELECT CASE CAST(floor(value) AS BIGINT) % 5 WHEN 0 THEN 'HTTP 429 Rate Limit' WHEN 1 THEN 'Connection reset'
    WHEN 2 THEN 'Invalid request' WHEN 3 THEN 'server_error: overloaded' ELSE event_type END AS message FROM events) e,
    LATERAL (SELECT regexp_matches(lower(message), 'rate_limit|rate limit|429|overloaded|503|502|500|connection|timeout|server_error') AS retryable) GROUP BY retryable""",
)
def f29(spark: SparkSession, folder: str) -> DataFrame:
    log = table(spark, folder, "events").selectExpr(
        "CASE CAST(floor(value) AS BIGINT) % 5 WHEN 0 THEN 'HTTP 429 Rate Limit' WHEN 1 THEN 'Connection reset' WHEN 2 THEN 'Invalid request' "
        "WHEN 3 THEN 'server_error: overloaded' ELSE event_type END AS message"
    )
    return log.groupBy(is_retryable(F.col("message")).alias("retryable")).agg(F.count("*").alias("events"))


RANKED = """SELECT query_id, candidate_idx, CAST(row_number() OVER (PARTITION BY query_id ORDER BY v DESC, s DESC, c DESC, candidate_idx, arrival) AS INT) AS rank
  FROM (SELECT query_id, candidate_idx, arrival, verification_is_verified AS v, verification_score AS s, quality_completeness_score AS c FROM cand)"""


@query("o01_ranked_candidates", W + f"SELECT query_id, candidate_idx, rank FROM ({RANKED})")
def o01(spark: SparkSession, folder: str) -> DataFrame:
    return R.rank_candidates(candidates(spark, folder)).select("query_id", "candidate_idx", "rank")


@query(
    "o02_contrast_examples",
    W + f"""SELECT query_id, max(candidate_idx) FILTER (WHERE {V} AND n = 1) AS verified_idx, max(candidate_idx) FILTER (WHERE NOT {V} AND n = 1) AS unverified_idx
    FROM (SELECT query_id, candidate_idx, {V}, row_number() OVER (PARTITION BY query_id, {V} ORDER BY verification_score DESC, candidate_idx) AS n FROM cand)
    GROUP BY query_id HAVING bool_or({V}) AND bool_or(NOT {V})""",
)
def o02(spark: SparkSession, folder: str) -> DataFrame:
    return R.contrast_examples(candidates(spark, folder))


def share(cond: str, base: str) -> str:
    return f"round(count(*) FILTER (WHERE {base} AND {cond}) * 1.0 / count(*) FILTER (WHERE {base}), 6)"


CALIBRATION = f"""SELECT model, {share('r', 'm')} AS correct_refusal_rate, {share('NOT r', 'm')} AS hallucination_rate, {share('r', 'NOT m')} AS false_refusal_rate,
  round(count(*) FILTER (WHERE m AND r) * 1.0 / count(*) FILTER (WHERE m) - count(*) FILTER (WHERE NOT m AND r) * 1.0 / count(*) FILTER (WHERE NOT m), 6) AS calibration_score
  FROM (SELECT model, refusal_is_refusal AS r, verification_score < 0.5 AS m FROM cand) GROUP BY model"""


@query("o04_calibration", W + CALIBRATION)
def o04(spark: SparkSession, folder: str) -> DataFrame:
    labelled = candidates(spark, folder).withColumn("malformed", F.col("verification_score") < 0.5)
    report = R.calibration(labelled)
    return rounded(report, *[c for c in report.columns if c != "model"])
