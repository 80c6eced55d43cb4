"""Joins, filters, windows, work lists, merging, files and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.messages import final_text, from_json_text
from candor.operators import joins as J
from candor.operators import regeneration as G
from candor.operators import reports as R
from candor.operators import scoring as S
from candor.operators import selection as P
from candor.operators.numbering import number_rows
from candor.plans.fixtures import CAND_CTE, CANDIDATES, METADATA, PROMPT_CTE, SPLIT, candidates, derived, prompts, select_sql, table
from candor.plans.message_queries import TOOL_ROWS, with_turns
from candor.plans.registry import QUERIES, query
from candor.plans.report_queries import V, rate_sql, rounded, runs
from candor.plans.scoring_queries import JUDGED, key_sql, stored_judgments
from candor.plans.text_queries import KEY, strip_sql
from candor.session import scratch_path
from candor.sources import candidates as C
from candor.sources import runs as U
from candor.streaming import incremental as T

W = f"WITH {CAND_CTE} "
WP = f"WITH {PROMPT_CTE} "

# --- joins -----------------------------------------------------------------------------------------


@query(
    "j01_u03_skip_completed",
    W + f"SELECT split, count(*) AS rows, count(DISTINCT query_id) AS queries FROM cand WHERE query_id NOT IN (SELECT query_id FROM cand WHERE {V}) GROUP BY split",
)
def j01(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder)
    open_rows = J.skip_completed(rows, rows.where(V))
    return open_rows.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("query_id").alias("queries"))


# One entry per order: three new candidates, or none; some entries only know their question.
REGENERATED = {
    "query_id": "(CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END)",
    "question": "('Order ' || CAST(o_orderkey AS STRING) || ': how many parts?')",
    "is_empty": "(o_orderpriority = '5-LOW')",
    "status": "o_orderstatus",
    "priority": "o_orderpriority",
    "placed": "CAST(o_orderdate AS STRING)",
}


def regenerated(spark: SparkSession, folder: str) -> DataFrame:
    entries = derived(spark, folder, "orders", REGENERATED)
    kind = "array<struct<raw_text:string,analysis:string,final_answer:string>>"
    new = [
        F.struct(
            F.concat(F.lit(f"raw {i} "), "status").alias("raw_text"), (F.lit("") if i == 1 else F.concat(F.lit("because "), "priority")).alias("analysis"),
            F.concat(F.lit(f"answer {i} "), "status").alias("final_answer"),
        )
        for i in range(3)
    ]
    return entries.withColumn("candidates", F.when(F.col("is_empty"), F.array().cast(kind)).otherwise(F.array(*new)))


@query(
    "j02_merge_results",
    W + f"""SELECT query_id, arrival, NOT is_empty AND candidate_idx < 3 AND split = 'math' AND o.question IS NOT NULL AS updated,
    CASE WHEN NOT is_empty AND candidate_idx < 3 AND split = 'math' THEN 'raw ' || candidate_idx || ' ' || status END AS raw_response,
    CASE WHEN NOT is_empty AND candidate_idx < 3 AND split = 'math' THEN 'answer ' || candidate_idx || ' ' || status ELSE answer END AS final_text,
    CASE WHEN NOT is_empty AND candidate_idx < 3 AND split = 'math' THEN CASE WHEN candidate_idx = 1 THEN 1 ELSE 2 END ELSE 2 END AS messages
    FROM cand JOIN (SELECT * EXCLUDE (query_id) FROM ({select_sql(REGENERATED, 'orders')})) o USING (question)""",
)
def j02(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).drop("analysis")
    merged = G.merge_results(rows, regenerated(spark, folder), split="math", stamp=F.lit("2024-01-01T00:00:00"), arrival=["placed"])
    messages = from_json_text(F.col("output_messages"))
    return merged.select(*KEY, F.col("regenerated_at").isNotNull().alias("updated"), "raw_response", final_text(messages).alias("final_text"), F.size(messages).alias("messages"))


@query("j02_merge_into", QUERIES["j02_merge_results"].sql)
def j02_into(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge into a stored table with a partition per split: the files of the other splits stay."""
    path = scratch_path(spark, "merge_into")
    unfilled = {c: F.lit(None).cast("string") for c in G.MERGED_COLUMNS}
    candidates(spark, folder).withColumns(unfilled).write.partitionBy("split").parquet(path)
    G.merge_into(spark, path, regenerated(spark, folder), "split", split="math", stamp=F.lit("2024-01-01T00:00:00"), arrival=["placed"])
    merged = spark.read.parquet(path)
    messages = from_json_text(F.col("output_messages"))
    return merged.select(*KEY, F.col("regenerated_at").isNotNull().alias("updated"), "raw_response", final_text(messages).alias("final_text"), F.size(messages).alias("messages"))


PER_QUERY = f"SELECT query_id, count(*) AS n, count(*) FILTER (WHERE {V}) AS v, avg(verification_score) AS s FROM cand WHERE run_id = '%s' GROUP BY query_id"
COMPARED = f"FROM ({PER_QUERY % 0}) b JOIN ({PER_QUERY % 1}) o USING (query_id)"


@query("j03_compare_runs", W + f"SELECT query_id, b.n AS candidates_base, b.v AS verified_base, round(b.s, 6) AS score_base, o.n AS candidates_other, o.v AS verified_other, round(o.s, 6) AS score_other, b.n * o.n AS pairs {COMPARED}")
def j03(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder)
    compared = J.compare_runs(rows.where(F.col("run_id") == "0"), rows.where(F.col("run_id") == "1"))
    return rounded(compared, "score_base", "score_other")


@query(
    "j03_compare_runs_summary",
    W + f"SELECT count(*) AS queries, CAST(sum(b.n * o.n) AS BIGINT) AS pairs, round(sum(b.v * o.n) * 1.0e0 / sum(b.n * o.n), 6) AS rate_base, round(sum(o.v * b.n) * 1.0e0 / sum(b.n * o.n), 6) AS rate_other {COMPARED}",
)
def j03_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder)
    compared = J.compare_runs(rows.where(F.col("run_id") == "0"), rows.where(F.col("run_id") == "1"))
    return rounded(J.compare_runs_summary(compared), "rate_base", "rate_other")


CALLED = {**{n: CANDIDATES[n] for n in ("query_id", "arrival")}, "tool_name": "(CASE l_suppkey % 4 WHEN 0 THEN 'f' || CAST(l_partkey AS STRING) WHEN 1 THEN 'g' WHEN 2 THEN 'h' ELSE 'unknown' END)"}
LISTED = f"""(SELECT DISTINCT query_id, unnest(['f' || regexp_extract(metadata, '"f(\\d+)"', 1), 'g', 'h']) AS tool_name FROM ({select_sql(TOOL_ROWS, 'lineitem')}) WHERE contains(metadata, '"name"'))"""


def calls_and_catalog(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    catalog = J.tool_catalog(derived(spark, folder, "lineitem", {**TOOL_ROWS, "metadata": METADATA}), F.col("metadata"))
    return derived(spark, folder, "lineitem", CALLED), catalog


@query("j04_known_tools", f"SELECT query_id, arrival, tool_name FROM ({select_sql(CALLED, 'lineitem')}) WHERE (query_id, tool_name) IN {LISTED}")
def j04(spark: SparkSession, folder: str) -> DataFrame:
    calls, catalog = calls_and_catalog(spark, folder)
    return J.known_tools(calls, catalog).select(*KEY, "tool_name")


@query("j04_unknown_tools", f"SELECT tool_name, count(*) AS calls FROM ({select_sql(CALLED, 'lineitem')}) WHERE (query_id, tool_name) NOT IN {LISTED} GROUP BY tool_name")
def j04_unknown(spark: SparkSession, folder: str) -> DataFrame:
    calls, catalog = calls_and_catalog(spark, folder)
    return J.known_tools(calls, catalog, known=False).groupBy("tool_name").agg(F.count("*").alias("calls"))


LOOKUP = f"FROM (SELECT *, {key_sql()} AS key FROM cand) c LEFT JOIN ({JUDGED % key_sql()}) j USING (key)"


def looked_up(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder)
    key = J.verdict_key(F.col("question"), F.col("answer"), F.col("ground_truth"), F.col("split"))
    return J.attach_by_key(rows, stored_judgments(rows, False), key, F.lit(True), "verdict_", ["query_id", "candidate_idx"])


@query("j05_verdict_lookup", W + f"SELECT query_id, arrival, jv AS equivalent, jc AS confidence, j.key IS NOT NULL AS found {LOOKUP}")
def j05(spark: SparkSession, folder: str) -> DataFrame:
    return looked_up(spark, folder).select(
        *KEY, F.col("verdict_equivalent").alias("equivalent"), F.col("verdict_confidence").alias("confidence"), F.col("verdict_found").alias("found")
    )


@query("a25_verdict_coverage", W + f"SELECT count(jv) AS cache_hits, count(*) - count(jv) AS cache_misses, round(count(jv) * 1.0 / count(*), 6) AS hit_rate {LOOKUP}")
def a25(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(R.verdict_coverage(looked_up(spark, folder)), "hit_rate")


@query(
    "j06_retry_pairs",
    W + f"""SELECT r.query_id, o.candidate_idx, r.candidate_idx AS retry_idx, r.{V} AS retry_verified, round(r.verification_score, 6) AS retry_score, o.v AS original_verified, round(o.s, 6) AS original_score, o.refusal_type
    FROM cand r JOIN (SELECT * FROM (SELECT query_id, candidate_idx, {V} AS v, verification_score AS s, refusal_type, row_number() OVER (PARTITION BY query_id, candidate_idx
      ORDER BY {V} DESC, verification_score DESC, refusal_type DESC NULLS LAST) AS n FROM cand WHERE NOT verification_is_retry) WHERE n = 1) o
    ON r.query_id = o.query_id AND r.verification_retry_of_candidate_idx = o.candidate_idx WHERE r.verification_is_retry""",
)
def j06(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(J.retry_pairs(candidates(spark, folder)), "retry_score", "original_score")


@query(
    "j07_match_tool_calls",
    W + """SELECT query_id, arrival, m AS matches, CASE WHEN part % 4 = 3 THEN 0.0e0 ELSE m / 2.0e0 END AS score, part % 4 <> 3 AND m / 2.0e0 >= 0.8 AS is_correct
    FROM (SELECT *, CASE WHEN part % 4 = 3 THEN 0 ELSE CAST(part % 4 <> 1 AS INT) + CAST(supplier % 3 = 0 AS INT) END AS m FROM cand)""",
)
def j07(spark: SparkSession, folder: str) -> DataFrame:
    def call(name, arguments):
        return F.struct(name.alias("name"), arguments.alias("arguments"))

    amount = F.col("quantity").cast("string")
    first = call(F.when(F.col("part") % 4 == 1, F.lit("other")).otherwise(F.lit("f")), F.concat(F.lit('{"a": 1, "b": '), amount, F.lit("}")))
    second = call(F.lit("g"), F.when(F.col("supplier") % 3 == 0, F.lit('{"x": true}')).otherwise(F.lit('{"x": false}')))
    made = F.when(F.col("part") % 4 == 3, F.array(first)).otherwise(F.array(first, second))
    expected = F.array(call(F.lit("f"), F.concat(F.lit('{"b": '), amount, F.lit(', "a": 1.0}'))), call(F.lit("g"), F.lit('{"x":true}')))
    rows = candidates(spark, folder).withColumns({"made": made, "expected": expected})
    result = rows.withColumn("m", J.match_tool_calls(F.col("made"), F.col("expected")))
    return result.select(*KEY, F.col("m.matches").alias("matches"), F.col("m.score").alias("score"), F.col("m.is_correct").alias("is_correct"))


# Execution results of one candidate per order, and of three test cases each.
RESULTS = {
    "query_id": "CAST(o_orderkey AS STRING)", "candidate_idx": "CAST(o_custkey % 4 AS INT)", "stdout": "o_orderstatus", "stderr": "''",
    "exit_code": "(CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END)", "timed_out": "(o_totalprice > 300000)", "error": "(CASE WHEN o_orderpriority = '1-URGENT' THEN 'boom' END)",
    "expected": "(CASE WHEN o_totalprice > 100000 THEN o_orderstatus ELSE 'F' END)",
}


@query(
    "j08_attach_execution",
    W + f"SELECT c.query_id, arrival, r.stdout AS exec_stdout, r.exit_code AS exec_exit_code, r.timed_out AS exec_timed_out, r.error AS exec_error FROM cand c LEFT JOIN ({select_sql(RESULTS, 'orders')}) r USING (query_id, candidate_idx)",
)
def j08(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).select(*KEY, "candidate_idx")
    joined = J.attach_execution(rows, derived(spark, folder, "orders", RESULTS))
    return joined.select(*KEY, "exec_stdout", "exec_exit_code", "exec_timed_out", "exec_error")


CASE_ROWS = f"SELECT *, CASE case_no WHEN 0 THEN stdout WHEN 1 THEN 'got ' || stdout || ' ' ELSE 'x' END AS output FROM (SELECT *, unnest([0, 1, 2]) AS case_no FROM ({select_sql(RESULTS, 'orders')}))"


@query(
    "v04_j08_code_cases",
    f"""SELECT query_id, candidate_idx, count(*) FILTER (WHERE ok) AS passed, count(*) AS total, count(*) FILTER (WHERE ok) = count(*) AS is_correct, round(count(*) FILTER (WHERE ok) * 1.0 / count(*), 6) AS confidence
    FROM (SELECT *, exit_code = 0 AND NOT timed_out AND error IS NULL AND contains(output, expected) AS ok FROM ({CASE_ROWS})) GROUP BY query_id, candidate_idx""",
)
def v04(spark: SparkSession, folder: str) -> DataFrame:
    base = derived(spark, folder, "orders", RESULTS).withColumn("case_no", F.explode(F.sequence(F.lit(0), F.lit(2))))
    output = F.when(F.col("case_no") == 0, F.col("stdout")).when(F.col("case_no") == 1, F.concat(F.lit("got "), "stdout", F.lit(" "))).otherwise(F.lit("x"))
    cases = base.select("query_id", "candidate_idx", "case_no", F.col("expected").alias("expected_output"))
    joined = J.attach_execution(cases, base.withColumn("stdout", output), ["query_id", "candidate_idx", "case_no"])
    ran = S.succeeded(F.col("exec_exit_code"), F.col("exec_timed_out"), F.col("exec_error"))
    return rounded(R.case_pass_rates(joined.withColumn("passed", S.case_passed(ran, F.col("exec_stdout"), F.col("expected_output")))), "confidence")


# --- filters ---------------------------------------------------------------------------------------


@query("p09_filter_rows", W + f"SELECT query_id, arrival FROM cand WHERE split = 'code' AND NOT {V}")
def p09(spark: SparkSession, folder: str) -> DataFrame:
    return P.filter_rows(candidates(spark, folder), "code", failed_only=True).select(*KEY)


SLICED = "SELECT split, query_id, arrival FROM (SELECT split, query_id, arrival, row_number() OVER (PARTITION BY split ORDER BY query_id, arrival) AS n FROM cand) WHERE n > {0} AND n <= {1}"


@query("p10_slice_splits", W + SLICED.format(5, 30))
def p10(spark: SparkSession, folder: str) -> DataFrame:
    return P.slice_splits(candidates(spark, folder), ["query_id", "arrival"], 5, 25).select("split", *KEY)


@query("p10_slice_splits_far", W + SLICED.format(1500, 3700))
def p10_far(spark: SparkSession, folder: str) -> DataFrame:
    return P.slice_splits(candidates(spark, folder), ["query_id", "arrival"], 1500, 2200).select("split", *KEY)


QUALITY_FILTER = f"{V} AND NOT refusal_is_refusal AND quality_is_substantive AND quality_completeness_score > 0.6"


@query("p12_filter_quality", W + f"SELECT query_id, arrival FROM cand WHERE {QUALITY_FILTER}")
def p12(spark: SparkSession, folder: str) -> DataFrame:
    return P.filter_quality(candidates(spark, folder)).select(*KEY)


@query("p13_tool_refusals", W + "SELECT query_id, arrival, refusal_type FROM cand WHERE split = 'tool_calling' AND refusal_is_refusal")
def p13(spark: SparkSession, folder: str) -> DataFrame:
    return P.tool_refusals(candidates(spark, folder)).select(*KEY, "refusal_type")


@query("p14_terse_rows", W + "SELECT query_id, arrival, quality_reasoning_length FROM cand WHERE quality_answer_length < 50 AND quality_reasoning_length > 100")
def p14(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).where(P.is_terse_but_reasoned()).select(*KEY, "quality_reasoning_length")


@query(
    "p26_clean_missing",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN '' ELSE l_returnflag END AS raw_response, CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS persona_score FROM lineitem",
)
def p26(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).alias("raw_response"),
        F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("persona_score"),
    )
    return P.clean_missing(rows)


@query("p28_in_splits", W + "SELECT split, count(*) AS rows FROM cand WHERE split IN ('math', 'tool_calling') GROUP BY split")
def p28(spark: SparkSession, folder: str) -> DataFrame:
    return P.in_splits(candidates(spark, folder), " math, ,tool_calling,").groupBy("split").agg(F.count("*").alias("rows"))


@query("p29_retry_candidates", W + "SELECT query_id, arrival FROM cand WHERE line % 2 = 0 AND refusal_is_refusal AND refusal_type = 'capability'")
def p29(spark: SparkSession, folder: str) -> DataFrame:
    return P.retry_candidates(candidates(spark, folder)).select(*KEY)


# --- windows, work lists, retries ------------------------------------------------------------------

FIRST_ROWS = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY arrival) AS n FROM cand {0}) WHERE n = 1"


@query("w01_unique_queries", W + f"SELECT query_id, question, ground_truth_answer AS ground_truth, split, source_metadata AS metadata, arrival FROM ({FIRST_ROWS.format('')})")
def w01(spark: SparkSession, folder: str) -> DataFrame:
    unique = G.unique_queries(candidates(spark, folder).drop("question", "ground_truth"), ["arrival"])
    return unique.select("query_id", "question", "ground_truth", "split", "metadata", F.col("first_row.arrival").alias("arrival"))


@query("v19_plan_regeneration", W + f"SELECT query_id, question, ground_truth_answer AS ground_truth FROM ({FIRST_ROWS.format(f'WHERE split = {chr(39)}code{chr(39)} AND NOT {V}')})")
def v19(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).drop("question", "ground_truth")
    return G.plan_regeneration(rows, ["arrival"], "code", True).select("query_id", "question", "ground_truth")


@query("a26_dry_run", W + f"SELECT count(*) AS rows, count(DISTINCT query_id) AS queries FROM cand WHERE split = 'code' AND NOT {V}")
def a26(spark: SparkSession, folder: str) -> DataFrame:
    return G.dry_run(candidates(spark, folder).drop("question", "ground_truth"), "code", True)


@query("k05_preview", W + f"SELECT query_id, split, substr(question, 1, 60) AS question FROM ({FIRST_ROWS.format('')}) ORDER BY arrival, query_id LIMIT 5")
def k05(spark: SparkSession, folder: str) -> DataFrame:
    return G.preview(G.unique_queries(candidates(spark, folder).drop("question", "ground_truth"), ["arrival"]))


FIRST_USER_SQL = strip_sql("CASE WHEN r1 = 'user' THEN c1 WHEN r2 = 'user' THEN c2 WHEN r3 = 'user' THEN c3 END")
CONTROL = f"SELECT split, n, q FROM (SELECT split, row_number() OVER (PARTITION BY split ORDER BY conv_id, turn) AS n, {FIRST_USER_SQL} AS q FROM prompt) WHERE n <= 2 AND q <> ''"


@query("w02_s15_control_samples", WP + f"SELECT split, CAST(row_number() OVER (PARTITION BY split ORDER BY n) AS INT) AS sample, '=== ' || upper(replace(split, '_', ' ')) || ' SAMPLE ' || row_number() OVER (PARTITION BY split ORDER BY n) || ' ===' || chr(10) || chr(10) || 'Query: ' || q AS value FROM ({CONTROL})")
def w02(spark: SparkSession, folder: str) -> DataFrame:
    order = ["conv_id", "turn"]
    return C.control_report(C.control_samples(prompts(spark, folder), order, F.col("messages")), order)


NUMBERED = W + "SELECT query_id, arrival, CAST(row_number() OVER (PARTITION BY query_id ORDER BY arrival) - 1 AS INT) AS enumerated FROM cand"


@query("w03_candidate_index", NUMBERED)
def w03(spark: SparkSession, folder: str) -> DataFrame:
    return number_rows(candidates(spark, folder).select(*KEY), ["query_id"], ["arrival"], "enumerated")


@query("w03_candidate_index_spread", NUMBERED)
def w03_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The same numbering by the plan for groups that can be too big for a task."""
    return number_rows(candidates(spark, folder).select(*KEY), ["query_id"], ["arrival"], "enumerated", spread=True)


RETRIED = f"""SELECT query_id, CAST(m + row_number() OVER (PARTITION BY query_id ORDER BY candidate_idx, answer) AS INT) AS candidate_idx, candidate_idx AS retry_of, answer, length(answer) AS answer_length, {V} AS verified
  FROM cand JOIN (SELECT query_id, max(candidate_idx) AS m FROM cand GROUP BY query_id) USING (query_id) WHERE refusal_is_refusal AND refusal_type = 'capability'"""


def retries(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder)
    retried = rows.where(F.col("refusal_is_refusal") & (F.col("refusal_type") == "capability")).select(
        "query_id", F.col("candidate_idx").alias("retry_of_candidate_idx"), "answer", F.col(V).alias("is_correct"), F.col("verification_score").alias("confidence"), F.lit("tool").alias("verifier_name")
    )
    return G.build_retries(rows, retried)


@query("w04_p30_build_retries", W + RETRIED)
def w04(spark: SparkSession, folder: str) -> DataFrame:
    built = retries(spark, folder)
    return built.select(
        "query_id", "candidate_idx", F.col("verification_retry_of_candidate_idx").alias("retry_of"), final_text(from_json_text(F.col("output_messages"))).alias("answer"),
        F.col("quality_answer_length").cast("long").alias("answer_length"), F.col(V).alias("verified"),
    )


@query(
    "u01_append_results",
    W + f"SELECT is_retry, count(*) AS rows, count(*) FILTER (WHERE v) AS verified FROM (SELECT coalesce(verification_is_retry, false) AS is_retry, {V} AS v FROM cand UNION ALL SELECT true, verified FROM ({RETRIED})) GROUP BY is_retry",
)
def u01(spark: SparkSession, folder: str) -> DataFrame:
    whole = G.append_results(candidates(spark, folder), retries(spark, folder))
    return whole.groupBy(F.col("verification_is_retry").alias("is_retry")).agg(F.count("*").alias("rows"), F.count_if(V).alias("verified"))


USAGE = W + """SELECT tool, count(*) AS calls, count(*) FILTER (WHERE bad) AS errors FROM (SELECT 'tool_' || part % 5 AS tool, line % 3 = 0 AS bad FROM cand UNION ALL SELECT 'tool_0', false FROM cand WHERE line % 2 = 0) GROUP BY tool"""


@query("a21_tool_usage", USAGE)
def a21(spark: SparkSession, folder: str) -> DataFrame:
    return R.tool_usage(with_turns(candidates(spark, folder)))


@query("a21_tool_iterations", W + "SELECT iterations, total_tool_calls, count(*) AS conversations FROM (SELECT 2 AS iterations, CASE WHEN line % 2 = 0 THEN 2 ELSE 1 END AS total_tool_calls FROM cand) GROUP BY 1, 2")
def a21_iterations(spark: SparkSession, folder: str) -> DataFrame:
    per_row = R.tool_iterations(with_turns(candidates(spark, folder)))
    return per_row.groupBy("iterations", "total_tool_calls").agg(F.count("*").alias("conversations"))


# --- files -----------------------------------------------------------------------------------------

SPLIT_COUNTS = W + "SELECT split, count(*) AS rows, count(DISTINCT query_id) AS queries FROM cand GROUP BY split"


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.count_distinct("query_id").alias("queries"))


@query(
    "s01_s14_load_candidates",
    "SELECT 'lineitem.parquet' AS source_file, count(*) AS rows, count(l_orderkey) AS lines, 0 AS orders FROM lineitem UNION ALL SELECT 'orders.parquet', count(*), 0, count(o_orderkey) FROM orders",
)
def s01(spark: SparkSession, folder: str) -> DataFrame:
    both = C.load_candidates(spark, f"{folder}/lineitem.parquet", f"{folder}/orders.parquet", merge_schema=True)
    return both.groupBy("source_file").agg(F.count("*").alias("rows"), F.count("l_orderkey").alias("lines"), F.count("o_orderkey").alias("orders"))


@query("s02_load_split", WP + "SELECT conv_id, turn, 'v2' AS version FROM prompt WHERE split = 'code'")
def s02(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "prompts")
    C.write_prompts(prompts(spark, folder), path)
    return C.load_split(spark, path, "code").select("conv_id", "turn", "version")


@query("s03_load_dataset", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def s03(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "events")
    table(spark, folder, "events").select("event_id", "event_type").write.json(path)
    return C.load_dataset(spark, path, kind="json", schema="event_id bigint, event_type string").groupBy("event_type").agg(F.count("*").alias("events"))


@query("s04_resume", WP + "SELECT split, count(*) FILTER (WHERE role <> 'user') AS open, count(*) FILTER (WHERE role = 'user') AS done FROM (SELECT *, r2 AS role FROM prompt) GROUP BY split")
def s04(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "finished")
    rows = prompts(spark, folder).withColumnRenamed("id", "query_id")
    rows.where(F.col("r2") == "user").select("query_id", "split").write.parquet(path)
    todo, existing = C.resume(spark, rows, path)
    marked = todo.select("split", F.lit(True).alias("open")).unionByName(existing.select("split", F.lit(False).alias("open")))
    return marked.groupBy("split").agg(F.count_if("open").alias("open"), F.count_if(~F.col("open")).alias("done"))


@query("s05_u02_write_candidates", SPLIT_COUNTS)
def s05(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "candidates")
    C.write_candidates(candidates(spark, folder).select("query_id", "candidate_idx", "split", V), path)
    return split_counts(spark.read.parquet(path))


@query(
    "s06_run_table",
    W + f"""SELECT run_id, 'model-' || run_id AS model, CAST(4 + CAST(run_id AS INT) AS INT) AS num_candidates, count(*) AS total_records, count(DISTINCT query_id) AS total_queries, {rate_sql(V)} AS avg_verification_rate,
    {rate_sql('refusal_is_refusal')} AS avg_refusal_rate, round(avg(persona_score), 6) AS avg_persona_score FROM cand GROUP BY run_id""",
)
def s06(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    U.append_runs(U.with_statistics(runs(spark), candidates(spark, folder)), path)
    chosen = U.load_runs(spark, path).select("run_id", "model", "num_candidates", "total_records", "total_queries", "avg_verification_rate", "avg_refusal_rate", "avg_persona_score")
    return rounded(chosen, "avg_verification_rate", "avg_refusal_rate", "avg_persona_score")


@query("s10_write_version", SPLIT_COUNTS)
def s10(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "versions")
    rows = candidates(spark, folder).select("query_id", "candidate_idx", "split")
    first = C.write_version(rows, root, 1)
    return split_counts(spark.read.parquet(C.write_version(spark.read.parquet(first), root, 2)))


@query("s13_training_set", W + f"SELECT split, count(*) AS rows, count(DISTINCT query_id) AS queries FROM cand WHERE {QUALITY_FILTER} GROUP BY split")
def s13(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "training")
    C.write_training_set(candidates(spark, folder), path)
    return split_counts(spark.read.parquet(path))


# --- streams ---------------------------------------------------------------------------------------


LANDED_KEYS = ["query_id", "candidate_idx", "arrival"]
# What the scorers read of a candidate.
LANDED_READS = ["split", "answer", "ground_truth", "exec_exit_code", "exec_timed_out", "exec_error", "exec_stdout"]


@query("t01_t03_s08_s09_score_landed", QUERIES["x01_x02_score_by_split"].sql.replace("cand AS MATERIALIZED (SELECT ", "cand AS MATERIALIZED (SELECT DISTINCT ", 1))
def t01(spark: SparkSession, folder: str) -> DataFrame:
    """Scores the landed file as a stream three times: the second run finds nothing new, the third one starts anew and finds that another stream has scored every key."""
    sink, checkpoint = scratch_path(spark, "scored"), scratch_path(spark, "progress")
    schema = table(spark, folder, "lineitem").schema

    def score(batch: DataFrame) -> DataFrame:
        return S.score_by_split(batch).select(*LANDED_KEYS, "split", "local_score.*")

    for progress in (checkpoint, checkpoint, f"{checkpoint}-anew"):
        stream = T.landed(spark, folder, schema, "lineitem.parquet").selectExpr(*[f"{e} AS {n}" for n, e in CANDIDATES.items()])
        T.score_landed(stream, score, sink, progress, failed=F.col("query_id").isNull(), keys=LANDED_KEYS, reads=LANDED_READS).awaitTermination()
    scored = spark.read.parquet(sink)
    return scored.groupBy("split", "verifier_name").agg(F.count("*").alias("rows"), F.count_if("is_correct").alias("correct"), F.round(F.sum("confidence"), 4).alias("confidence"))


@query("t02_without_duplicates", W + "SELECT split, count(*) AS rows FROM (SELECT DISTINCT query_id, candidate_idx, split FROM cand) GROUP BY split")
def t02(spark: SparkSession, folder: str) -> DataFrame:
    return T.without_duplicates(candidates(spark, folder)).groupBy("split").agg(F.count("*").alias("rows"))
