"""Scorers, refusals and the full verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions import jsonpaths as P
from candor.functions import jsontext as J
from candor.functions.code import javascript_syntax
from candor.functions.messages import tools_in
from candor.functions.numbers import UNITS
from candor.functions.refusal import PATTERNS, PERSONA_PHRASES
from candor.operators import cascade as K
from candor.operators import refusals as R
from candor.operators import scoring as S
from candor.operators.joins import refusal_key, verdict_key
from candor.plans.fixtures import CAND_CTE, CANDIDATES, DQ, NL, Q, SQ, candidates, case, derived, select_sql, table, text
from candor.plans.registry import query
from candor.plans.text_queries import CODE_IN, CODE_OR_TEXT, EXPRESSION, JSON_TEXT, KEY, LANGUAGE, NUMBER, boxed_sql, strip_sql

W = f"WITH {CAND_CTE} "


def opened(df: DataFrame, name: str, *fields: str) -> DataFrame:
    return df.select(*KEY, *[F.round(F.col(f"{name}.{f}"), 6).alias(f) if f == "confidence" else F.col(f"{name}.{f}").alias(f) for f in fields])


# --- maths -----------------------------------------------------------------------------------------

def read_sql(x: str, suffix: str, source: str) -> str:
    """SQL: number, normalized expression, value and unit of text column `x`."""
    return f"""SELECT * EXCLUDE (hit, tail, boxed, b, x), {NUMBER} AS n_{suffix}, regexp_replace({EXPRESSION}, '\\s+', '', 'g') AS e_{suffix},
      try_cast(nullif(regexp_extract(trim(x), '^([+-]?\\d+\\.?\\d*(?:[eE][+-]?\\d+)?)\\s*([A-Za-z]+)$', 1), '') AS DOUBLE) AS v_{suffix},
      regexp_extract(trim(x), '^([+-]?\\d+\\.?\\d*(?:[eE][+-]?\\d+)?)\\s*([A-Za-z]+)$', 2) AS u_{suffix}
      FROM (SELECT *, coalesce(nullif(boxed, ''), {x}) AS b, {x} AS x FROM ({boxed_sql(x, source)}))"""


UNIT_ROWS = ", ".join(f"('{u}', '{dim}', {factor}e0)" for u, (dim, factor) in UNITS.items())
MATH_SQL = f"""SELECT q.*, CASE WHEN ground_truth IS NULL THEN 'missing_truth' WHEN answer = '' THEN 'missing_answer' WHEN e_a = e_t THEN 'expression' WHEN same_units THEN 'units'
    WHEN n_a IS NULL OR n_t IS NULL THEN 'no_number' ELSE 'numeric' END AS method,
  CASE WHEN ground_truth IS NULL OR answer = '' THEN 0.0e0 WHEN e_a = e_t OR same_units THEN 1.0e0 WHEN abs(n_a - n_t) <= greatest(1e-6 * greatest(abs(n_a), abs(n_t)), 1e-6) THEN 0.9e0 ELSE 0.0e0 END AS confidence
  FROM (SELECT r.*, coalesce(ua.dim = ut.dim AND abs(v_a - v_t * ut.factor / ua.factor) <= greatest(1e-4 * greatest(abs(v_a), abs(v_t * ut.factor / ua.factor)), 1e-4), false) AS same_units
    FROM ({read_sql('ground_truth', 't', '(' + read_sql('answer', 'a', "(SELECT * FROM cand WHERE split = 'math')") + ')')}) r
    LEFT JOIN (VALUES {UNIT_ROWS}) ua(unit, dim, factor) ON u_a = ua.unit LEFT JOIN (VALUES {UNIT_ROWS}) ut(unit, dim, factor) ON u_t = ut.unit) q"""


@query("v01_math_score", W + f"SELECT query_id, arrival, confidence > 0 AS is_correct, confidence, method FROM ({MATH_SQL})")
def v01(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where(F.col("split") == "math")
    return opened(rows.withColumn("s", S.math_score(F.col("answer"), F.col("ground_truth"))), "s", "is_correct", "confidence", "method")


QUANTITIES = {
    "query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"],
    "a": case("l_partkey % 5", text(Q, "' km'"), text("CAST(CAST(l_quantity AS INT) * 100 AS STRING)", "' cm'"), text(Q, "' minutes'"), text(Q, "'kg'"), text("'about '", Q)),
    "t": case("l_suppkey % 4", text("CAST(CAST(l_quantity AS INT) * 1000 AS STRING)", "' meters'"), text(Q, "' m'"), text("CAST(CAST(l_quantity AS INT) * 60 AS STRING)", "' s'"), text(Q, "' hours'")),
}


@query(
    "v02_units_score",
    f"""SELECT query_id, arrival, coalesce(ua.dim = ut.dim AND abs(va - vt * ut.factor / ua.factor) <= greatest(1e-4 * greatest(va, vt * ut.factor / ua.factor), 1e-4), false) AS is_correct
    FROM (SELECT query_id, arrival, try_cast(regexp_extract(a, '^(\\d+)', 1) AS DOUBLE) AS va, regexp_extract(a, '^\\d+ *([a-z]+)$', 1) AS ua_name, try_cast(regexp_extract(t, '^(\\d+)', 1) AS DOUBLE) AS vt,
      regexp_extract(t, '([a-z]+)$', 1) AS ut_name FROM ({select_sql(QUANTITIES, 'lineitem')})) LEFT JOIN (VALUES {UNIT_ROWS}) ua(unit, dim, factor) ON ua_name = ua.unit LEFT JOIN (VALUES {UNIT_ROWS}) ut(unit, dim, factor) ON ut_name = ut.unit""",
)
def v02(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "lineitem", QUANTITIES)
    return rows.select(*KEY, S.units_score(F.col("a"), F.col("t"))["is_correct"].alias("is_correct"))


# --- code ------------------------------------------------------------------------------------------

RAN = "(exec_exit_code = 0 AND NOT exec_timed_out AND exec_error IS NULL)"
CODE_SQL = f"""SELECT *, CASE WHEN answer = '' THEN 'missing_answer' WHEN coalesce(code, '') = '' THEN 'no_code' WHEN NOT {RAN} THEN 'execution' WHEN ground_truth IS NULL THEN 'execution_only'
    WHEN o = ground_truth THEN 'output_exact' WHEN contains(o, ground_truth) THEN 'output_substring' WHEN abs(try_cast(o AS DOUBLE) - try_cast(ground_truth AS DOUBLE)) < 1e-6 THEN 'output_numeric' ELSE 'output' END AS method
  FROM (SELECT *, {CODE_IN} AS code, {strip_sql('exec_stdout')} AS o FROM ({LANGUAGE}) WHERE split = 'code')"""
CODE_CONFIDENCE = "CASE method WHEN 'execution_only' THEN 0.5e0 WHEN 'output_exact' THEN 1.0e0 WHEN 'output_substring' THEN 0.85e0 WHEN 'output_numeric' THEN 0.95e0 ELSE 0.0e0 END"


@query("v03_code_score", W + f"SELECT query_id, arrival, {CODE_CONFIDENCE} > 0 AS is_correct, {CODE_CONFIDENCE} AS confidence, method FROM ({CODE_SQL})")
def v03(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where(F.col("split") == "code")
    ran = S.succeeded(F.col("exec_exit_code"), F.col("exec_timed_out"), F.col("exec_error"))
    scored = rows.withColumn("s", S.code_score(F.col("answer"), F.col("ground_truth"), ran, F.col("exec_stdout")))
    return opened(scored, "s", "is_correct", "confidence", "method")


CODE_VALID = "CASE WHEN language = 'python' AND code <> '' THEN NOT (contains(code, 'def f(:') OR contains(code, 'I cannot')) WHEN language = 'javascript' THEN true END"


# SQL: which answers are programs. Of the maths answers one form is a Python expression; of the tool answers those that are JSON are (`true` is a name there).
ANSWER_VALID = f"""CASE WHEN split = 'math' THEN CASE WHEN {strip_sql('code')} <> '' THEN regexp_matches(code, '^[0-9]+/0$') END
    WHEN split = 'tool_calling' THEN CASE WHEN {strip_sql('code')} <> '' THEN starts_with(code, '{{') AND json_valid(code) END ELSE {CODE_VALID} END"""


@query(
    "v05_syntax_audit",
    W + f"""SELECT split, language, count(*) AS answers, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS invalid,
    count(*) FILTER (WHERE ok AND language = 'python' AND contains(code, 'def ')) AS with_function, 0 AS with_class
    FROM (SELECT *, {ANSWER_VALID} AS ok FROM (SELECT *, {CODE_OR_TEXT} AS code FROM ({LANGUAGE}))) GROUP BY split, language""",
)
def v05(spark: SparkSession, folder: str) -> DataFrame:
    return S.syntax_audit(candidates(spark, folder))


SCRIPT = case(
    "l_partkey % 11",
    text("'function f(){ return '", Q, "'; }'"),
    text("'const a = ['", Q, "', (1 + 2)];'"),
    text("'let s = '", DQ, "'a'", "chr(92)", DQ, "'b'", DQ, "'; }'"),
    text("'if (x > '", Q, "')'"),
    text("'const = '", Q),
    text("'var t = `'", Q, "';'"),
    text("'f('", SQ, "'('", SQ, "', {a: [1]})'"),
    text("'for (let i = 0; i < '", Q, "'; i++)'"),
    text("'class A { g(){ return [1, (2]) } }'"),
    text("'let s = '", SQ, "'open;'"),
    text("'x => {'", NL, "'return x;'", NL, "'}'"),
)
SCRIPTS = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "code": SCRIPT}
LITERAL = "regexp_replace(regexp_replace(code, '(?s)\\\\.', '', 'g'), '\"[^\"]*(\"|$)|''[^'']*(''|$)|`[^`]*(`|$)', '', 'g')"


def reduced(x: str, times: int = 6) -> str:
    for _ in range(times):
        x = f"replace(replace(replace({x}, '()', ''), '{{}}', ''), '[]', '')"
    return x


SCRIPT_VALID = f"""{reduced(f"regexp_replace({LITERAL}, '[^(){{}}\\[\\]]', '', 'g')")} = ''
  AND (length(regexp_replace(regexp_replace(code, '(?s)\\\\.', '', 'g'), '[^"]', '', 'g')) % 2 = 0) AND (length(regexp_replace(regexp_replace(code, '(?s)\\\\.', '', 'g'), '[^'']', '', 'g')) % 2 = 0)
  AND length(regexp_replace(code, '[^`]', '', 'g')) % 2 = 0 AND NOT regexp_matches(trim(code), 'function\\s*\\(\\s*\\)\\s*$') AND NOT regexp_matches(trim(code), '(if|for)\\s*\\([^)]*\\)\\s*$')
  AND NOT regexp_matches(code, '(const|let)\\s*=')"""
SCRIPT_PATTERNS = """CAST(regexp_matches(code, 'function\\s+\\w+|const\\s+\\w+\\s*=\\s*[\\(\\[]|=>\\s*\\{?') AS INT) + CAST(regexp_matches(code, 'class\\s+\\w+') AS INT)
  + CAST(contains(code, 'return') AS INT) + CAST(regexp_matches(code, '(const|let|var)\\s+\\w+') AS INT)"""


@query(
    "v05_javascript_syntax",
    f"SELECT query_id, arrival, is_valid, round(CASE WHEN is_valid THEN least(0.7e0, 0.4e0 + n * 0.1e0) ELSE 0.8e0 END, 6) AS confidence FROM (SELECT *, {SCRIPT_VALID} AS is_valid, {SCRIPT_PATTERNS} AS n FROM ({select_sql(SCRIPTS, 'lineitem')}))",
)
def v05_script(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "lineitem", SCRIPTS)
    return opened(rows.withColumn("s", javascript_syntax(F.col("code"))), "s", "is_valid", "confidence")


# --- tool calls ------------------------------------------------------------------------------------

# SQL: the call as one JSON text `js`, in header form or as found, plus its parts.
CALLS = f"""SELECT *, CASE WHEN js IS NULL THEN NULL ELSE coalesce(js ->> '$.tool', js ->> '$.name') END AS tool_name, coalesce(js -> '$.parameters', js -> '$.arguments') AS arguments FROM (
  SELECT *, CASE WHEN h <> '' THEN json_object('tool', regexp_extract(h, '([^.]*)$', 1), 'function', regexp_extract(h, '([^.]*)$', 1), 'recipient', h, 'namespace', regexp_extract(h, '^(.*)\\.', 1),
      'parameters', CAST(regexp_extract(answer, '(?s)\\{{.*\\}}') AS JSON)) WHEN json_valid(j) THEN CAST(j AS JSON) END AS js
  FROM (SELECT *, regexp_extract(answer, 'to=([\\w.]+)', 1) AS h, {JSON_TEXT} AS j FROM cand WHERE split = 'tool_calling'))"""
# SQL: comparison of a call with its truth, on the members the truths have.
TRUTH_METHOD = """CASE WHEN js ->> '$.tool' = g ->> '$.tool' AND js ->> '$.parameters.city' = g ->> '$.parameters.city' AND CAST(js ->> '$.parameters.days' AS DOUBLE) = CAST(g ->> '$.parameters.days' AS DOUBLE)
      AND len(json_keys(js -> '$.parameters')) = 2 THEN CASE WHEN len(json_keys(js)) = 2 THEN 'ground_truth_exact' ELSE 'ground_truth_lenient' END
    WHEN lower(coalesce(js ->> '$.tool', js ->> '$.Tool')) = lower(g ->> '$.tool')
      AND lower(coalesce(js ->> '$.parameters.city', js ->> '$.Parameters.CITY')) = lower(g ->> '$.parameters.city')
      AND CAST(coalesce(js ->> '$.parameters.days', js ->> '$.Parameters.Days') AS DOUBLE) = CAST(g ->> '$.parameters.days' AS DOUBLE) THEN 'ground_truth_fuzzy' ELSE 'ground_truth' END"""
METHOD_CONFIDENCE = "CASE method WHEN 'ground_truth_exact' THEN 1.0e0 WHEN 'ground_truth_lenient' THEN 0.9e0 WHEN 'ground_truth_fuzzy' THEN 0.85e0 WHEN 'full_validation' THEN 0.95e0 ELSE 0.0e0 END"
CATALOG = ("get_weather", "search")
TOOL_SQL = f"""SELECT *, CASE WHEN answer = '' THEN 'missing_answer' WHEN js IS NULL THEN 'no_json' WHEN coalesce(tool_name NOT IN ('get_weather', 'search'), true) THEN 'tool_exists'
    WHEN arguments IS NOT NULL AND json_type(arguments) <> 'OBJECT' THEN 'parameter_types' WHEN ground_truth IS NULL THEN 'full_validation' ELSE {TRUTH_METHOD} END AS method
  FROM (SELECT *, CAST(ground_truth AS JSON) AS g FROM ({CALLS}))"""


@query("v06_tool_score", W + f"SELECT query_id, arrival, {METHOD_CONFIDENCE} > 0 AS is_correct, {METHOD_CONFIDENCE} AS confidence, method FROM ({TOOL_SQL})")
def v06(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where(F.col("split") == "tool_calling").withColumn("catalog", F.array(*[F.lit(t) for t in CATALOG]))
    return opened(S.tool_scores(rows, catalog="catalog"), "tool_score", "is_correct", "confidence", "method")


SCHEMAS = (
    '{"type": "object", "properties": {"tool": {"type": "string"}, "parameters": {"type": "object", "properties": {"city": {"type": "string"}, "days": {"type": "integer"}}, "required": ["city"]}}, "required": ["tool", "parameters"]}',
    '{"type": "object", "properties": {"tool": {"enum": ["get_weather"]}, "parameters": {}}, "additionalProperties": false}',
    '{"type": "array"}',
)


# SQL: whether a call `js` meets the schema of its supplier.
CONFORMS_SQL = """CASE supplier % 3
      WHEN 0 THEN coalesce(json_type(js) = 'OBJECT' AND json_type(js -> '$.tool') = 'VARCHAR' AND json_type(js -> '$.parameters') = 'OBJECT' AND json_type(js -> '$.parameters.city') = 'VARCHAR'
        AND coalesce(json_type(js -> '$.parameters.days') IN ('UBIGINT', 'BIGINT'), true), false)
      WHEN 1 THEN coalesce(json_type(js) = 'OBJECT' AND coalesce(js ->> '$.tool' = 'get_weather', true) AND len(list_filter(json_keys(js), lambda k: k NOT IN ('tool', 'parameters'))) = 0, false)
      ELSE json_type(js) = 'ARRAY' END"""


def schemas(spark: SparkSession) -> DataFrame:
    """The schemas as a constraint table, read once each. Made of a range, whose size Spark knows: rows of few schemas must not be shuffled by their schema."""
    rows = spark.range(len(SCHEMAS)).select(F.col("id").cast("int").alias("schema_no"), F.get(F.array(*[F.lit(s) for s in SCHEMAS]), F.col("id").cast("int")).alias("text"))
    return S.schema_table(rows.select("schema_no", F.parse_json("text").alias("tool_schema")), "tool_schema")


@query("v07_schema_conformance", W + f"SELECT query_id, arrival, js IS NOT NULL AND {CONFORMS_SQL} AS conforms FROM ({CALLS})")
def v07(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where(F.col("split") == "tool_calling").select(*KEY, (F.col("supplier") % 3).cast("int").alias("schema_no"), S.call_in(F.col("answer")).alias("call"))
    met = P.meets(P.document(F.col("call")), F.col("tool_schema"))
    return rows.join(schemas(spark), "schema_no").select(*KEY, F.coalesce(met, F.lit(False)).alias("conforms"))


# The tools that the prompt of a candidate offers, and the fields that some candidates must have.
OFFERED = case(
    "l_suppkey % 3",
    "'{\"tools\": [{\"type\": \"function\", \"function\": {\"name\": \"get_weather\", \"parameters\": {}}}, {\"name\": \"search\", \"parameters\": {}}]}'",
    "'{\"tools\": [{\"name\": \"search\", \"parameters\": {}}]}'",
    "'{\"tools\": []}'",
)
OFFERED_SQL = "CASE supplier % 3 WHEN 0 THEN ['get_weather', 'search'] WHEN 1 THEN ['search'] ELSE [] END"
# A schema for one candidate in four; the others are checked by the later stages.
FULL_TOOL_SQL = f"""SELECT *, CASE WHEN answer = '' THEN 'missing_answer' WHEN js IS NULL THEN 'no_json' WHEN part % 4 = 0 AND NOT {CONFORMS_SQL} THEN 'schema'
    WHEN supplier % 3 <> 2 AND coalesce(NOT list_contains({OFFERED_SQL}, tool_name), true) THEN 'tool_exists'
    WHEN line % 2 = 0 AND (json_type(js) <> 'OBJECT' OR NOT list_contains(json_keys(js), 'tool') OR NOT list_contains(json_keys(js), 'parameters')) THEN 'required_fields'
    WHEN arguments IS NOT NULL AND json_type(arguments) <> 'OBJECT' THEN 'parameter_types' WHEN ground_truth IS NULL THEN 'full_validation' ELSE {TRUTH_METHOD} END AS method
  FROM (SELECT *, CAST(ground_truth AS JSON) AS g FROM ({CALLS}))"""


def with_specification(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates with the tools their prompt offers, required fields, and the constraints of their schema."""
    rows = table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in CANDIDATES.items()], f"{OFFERED} AS offered")
    rows = rows.withColumn("schema_no", F.when(F.col("part") % 4 == 0, (F.col("supplier") % 3).cast("int"))).join(schemas(spark), "schema_no", "left")
    # After the join, so that a scorer that asks for the specification of some rows has it read for these.
    return rows.withColumns({
        "tool_catalog": F.transform(tools_in(F.col("offered")), lambda t: t["name"]),
        "tool_required": F.when(F.col("line") % 2 == 0, F.array(F.lit("tool"), F.lit("parameters"))).otherwise(F.array().cast("array<string>")),
    })


@query("v06_tool_score_all_stages", W + f"SELECT query_id, arrival, {METHOD_CONFIDENCE} > 0 AS is_correct, {METHOD_CONFIDENCE} AS confidence, method FROM ({FULL_TOOL_SQL})")
def v06_all(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_specification(spark, folder).where(F.col("split") == "tool_calling")
    return opened(S.tool_scores(rows, **S.TOOL_COLUMNS), "tool_score", "is_correct", "confidence", "method")


# API descriptions, one per nation. The schema of the body is given in place, by reference, or not at all; some descriptions lack the operation.
WEATHER = '{\"type\": \"object\", \"properties\": {\"city\": {\"type\": \"string\"}, \"days\": {\"$ref\": \"#/components/schemas/Days\"}}, \"required\": [\"city\", \"days\"]}'
BODY = '\"requestBody\": {\"content\": {\"application/json\": {\"schema\": '
OPERATION = case(
    "n_nationkey % 4",
    f"'{{\"operationId\": \"get_weather\", {BODY}{WEATHER}}}}}}}}}'",
    f"'{{\"operationId\": \"get_weather\", {BODY}{{\"$ref\": \"#/components/schemas/Weather\"}}}}}}}}}}'",
    "'{\"operationId\": \"get_weather\"}'",
    "'{\"operationId\": \"other\"}'",
)
DESCRIPTION = text(
    "'{\"openapi\": \"3.0.0\", \"paths\": {\"/'", "n_name", "'\": {\"get\": {\"operationId\": \"list\"}, \"post\": '", OPERATION,
    f"'}}}}, \"components\": {{\"schemas\": {{\"Weather\": {WEATHER}, \"Days\": {{\"type\": \"integer\"}}}}}}}}'",
)


@query(
    "v06_api_operations",
    W + """SELECT query_id, arrival, CASE WHEN method = 'schema' AND ok THEN 1.0e0 WHEN method = 'openapi' THEN 0.8e0 ELSE 0.0e0 END AS confidence, method FROM (
      SELECT *, json_type(a -> '$.city') = 'VARCHAR' AND json_type(a -> '$.days') IN ('UBIGINT', 'BIGINT') AS ok FROM (
      SELECT *, CASE WHEN json_type(arguments) = 'OBJECT' THEN arguments ELSE '{}'::JSON END AS a, CASE WHEN answer = '' THEN 'missing_answer' WHEN js IS NULL THEN 'no_json' WHEN coalesce(tool_name, '') = '' THEN 'no_tool'
        WHEN tool_name <> 'get_weather' OR supplier % 25 % 4 = 3 THEN 'operation' WHEN supplier % 25 % 4 = 2 THEN 'openapi' ELSE 'schema' END AS method FROM (""" + CALLS + ")))",
)
def v06_api(spark: SparkSession, folder: str) -> DataFrame:
    descriptions = table(spark, folder, "nation").selectExpr("n_nationkey AS nation", f"{DESCRIPTION} AS description")
    operations = S.api_operations(descriptions.withColumn("description", J.parse(F.col("description"))), "nation")
    rows = candidates(spark, folder).where(F.col("split") == "tool_calling").withColumn("nation", F.col("supplier") % 25)
    return opened(S.api_scores(rows, operations, "nation"), "api_score", "confidence", "method")


@query(
    "v08_fields_and_types",
    W + f"""SELECT query_id, arrival, array_to_string(list_filter(['tool', 'parameters'], lambda k: NOT list_contains(json_keys(js), k)), ',') AS missing, arguments IS NULL OR json_type(arguments) = 'OBJECT' AS ok,
    CASE WHEN arguments IS NULL THEN 0.8e0 WHEN json_type(arguments) <> 'OBJECT' THEN 0.0e0 WHEN regexp_matches(CAST(arguments AS STRING), ': *"[0-9.-]*[0-9][0-9.-]*"') THEN 0.7e0 ELSE 0.9e0 END AS confidence FROM ({CALLS}) WHERE js IS NOT NULL""",
)
def v08(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where(F.col("split") == "tool_calling").withColumn("call", J.as_object(S.call_in(F.col("answer")))).where(F.col("call").isNotNull())
    missing = S.required_fields_missing(F.col("call"), F.array(F.lit("tool"), F.lit("parameters")))
    rows = rows.withColumn("types", S.parameter_types(F.col("call")))
    return rows.select(*KEY, F.array_join(missing, ",").alias("missing"), F.col("types.ok").alias("ok"), F.col("types.confidence").alias("confidence"))


@query(
    "v09_j09_truth_comparison",
    W + f"SELECT query_id, arrival, method, {METHOD_CONFIDENCE} AS confidence FROM (SELECT *, {TRUTH_METHOD} AS method FROM (SELECT *, CAST(ground_truth AS JSON) AS g FROM ({CALLS}) WHERE js IS NOT NULL AND ground_truth IS NOT NULL))",
)
def v09(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).where((F.col("split") == "tool_calling") & F.col("ground_truth").isNotNull()).withColumn("call", S.call_in(F.col("answer")))
    rows = rows.where(F.col("call").isNotNull()).withColumn("truth", J.parse(F.col("ground_truth")))
    scored = rows.withColumn("s", S.truth_comparison(F.col("call"), F.col("truth")))
    return opened(scored, "s", "method", "confidence")


# --- refusals --------------------------------------------------------------------------------------

SENTENCES = (
    "The result is final.", "I cannot help with that.", "I don't have access to real-time data.", "Sorry, but I am unable to do this.",
    "That is against my guidelines and not safe.", "Could you clarify the request?", "The tools aren't designed for this, they won't be able to help.",
    "I cannot feel joy. I'm not able to appreciate it.", "It is beyond my knowledge. I don't understand the unclear question.",
)
SENTENCE = case("doc_id % 9", *["'" + s.replace("'", "''") + "'" for s in SENTENCES])
# SQL: positions (from 1) of the patterns of each refusal type.
SAFETY, CAPABILITY, UNCLEAR = (6, 7, 9), (5, 8, 10, 11, 12, 13, 14, 15, 16), (18, 19, 20)


def hits_sql(x: str) -> str:
    tests = ", ".join("regexp_matches({}, '{}', 'i')".format(x, p.replace("'", "''")) for p in PATTERNS)
    return f"[{tests}]"


def type_sql(hits: str) -> str:
    branches = " ".join(
        f"WHEN {' OR '.join(f'{hits}[{i}]' for i in group)} THEN '{name}'" for name, group in (("safety", SAFETY), ("capability", CAPABILITY), ("unclear", UNCLEAR))
    )
    return f"CASE {branches} WHEN list_contains({hits}, true) THEN 'other' END"


def count_sql(hits: str) -> str:
    return f"len(list_filter({hits}, lambda m: m))"


CONFIDENCE = "CASE {n} WHEN 0 THEN 0.0e0 WHEN 1 THEN 0.6e0 WHEN 2 THEN 0.8e0 ELSE 0.95e0 END"


def documents_with_sentence(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, each followed by one of nine sentences."""
    sentence = F.lit(SENTENCES[-1])
    for i in range(len(SENTENCES) - 1):
        sentence = F.when(F.col("doc_id") % 9 == i, F.lit(SENTENCES[i])).otherwise(sentence)
    return table(spark, folder, "documents").select("doc_id", "source", F.concat_ws("\n", "text", sentence).alias("response"))


REPLIES = f"SELECT doc_id, source, text || chr(10) || {SENTENCE} AS response FROM documents"
REFUSAL_SQL = f"SELECT *, {CONFIDENCE.format(n=count_sql('h'))} AS confidence, {type_sql('h')} AS refusal_type FROM (SELECT *, {hits_sql('response')} AS h FROM ({REPLIES}))"


@query("v10_v11_refusals", f"SELECT doc_id, confidence >= 0.5 AS is_refusal, confidence, refusal_type, {count_sql('h')} AS matches FROM ({REFUSAL_SQL})")
def v10(spark: SparkSession, folder: str) -> DataFrame:
    found = R.classify_refusals(documents_with_sentence(spark, folder), F.col("response"))
    r = F.col("refusal")
    return found.select("doc_id", r["is_refusal"].alias("is_refusal"), r["confidence"].alias("confidence"), r["refusal_type"].alias("refusal_type"), F.size(r["matched_patterns"]).cast("long").alias("matches"))


WHITELIST = " OR ".join("regexp_matches(response, '{}', 'i')".format(p.replace("'", "''")) for p in PERSONA_PHRASES["marvin"])
EXTRA = r"result is final"


@query(
    "v10_x03_refusals_persona",
    f"""SELECT source, whitelisted, c >= 0.5 AS is_refusal, count(*) AS documents FROM (SELECT *, CASE WHEN whitelisted THEN greatest(0.0e0, confidence - 0.5e0) ELSE confidence END AS c
    FROM (SELECT *, {CONFIDENCE.format(n=count_sql('h') + " + CAST(contains(response, 'result is final') AS INT)")} AS confidence, {WHITELIST} AS whitelisted FROM (SELECT *, {hits_sql('response')} AS h FROM ({REPLIES})))) GROUP BY 1, 2, 3""",
)
def v10_persona(spark: SparkSession, folder: str) -> DataFrame:
    found = R.classify_refusals(documents_with_sentence(spark, folder), F.col("response"), persona="Marvin", extra=(EXTRA,))
    return found.groupBy("source", F.col("refusal_whitelisted").alias("whitelisted"), F.col("refusal.is_refusal").alias("is_refusal")).agg(F.count("*").alias("documents"))


TWO_PASS = f"""SELECT *, {CONFIDENCE.format(n=count_sql('ha'))} AS ca, {CONFIDENCE.format(n=count_sql('hf'))} AS cf, {type_sql('ha')} AS ta, {type_sql('hf')} AS tf
  FROM (SELECT *, {hits_sql('answer')} AS ha, {hits_sql('raw_text')} AS hf FROM cand)"""


@query(
    "v12_two_pass_refusals",
    W + f"""SELECT query_id, arrival, greatest(ca, CASE WHEN cf >= 0.5 AND raw_text <> '' AND ca < 0.5 THEN cf ELSE 0 END) >= 0.5 AS is_refusal,
    CASE WHEN ca < 0.5 AND raw_text <> '' AND cf >= 0.5 AND cf > ca THEN cf ELSE ca END AS confidence, CASE WHEN ca < 0.5 AND raw_text <> '' AND cf >= 0.5 AND cf > ca THEN tf ELSE ta END AS refusal_type FROM ({TWO_PASS})""",
)
def v12(spark: SparkSession, folder: str) -> DataFrame:
    checked = R.check_refusals(candidates(spark, folder), F.col("answer"), F.col("raw_text"))
    return checked.select(*KEY, F.col("refusal.is_refusal").alias("is_refusal"), F.col("refusal.confidence").alias("confidence"), F.col("refusal.refusal_type").alias("refusal_type"))


# Stored refusal judgments exist for the documents that have a label.
REFUSAL_KEY_SQL = f"left(sha256(source || '|' || {strip_sql('response')}), 16)"
REFUSAL_JUDGED = f"""SELECT key, bool_or(toxic = 1) AS jr, max(CASE WHEN quality = 1 THEN 0.9e0 ELSE 0.75e0 END) AS jc, max(CASE WHEN toxic = 1 THEN 'safety' END) AS jt
  FROM (SELECT {REFUSAL_KEY_SQL} AS key, toxic, quality FROM ({REPLIES}) JOIN labels USING (doc_id)) GROUP BY key"""


def stored_refusal_judgments(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents_with_sentence(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    toxic = F.col("toxic") == 1
    return rows.groupBy(refusal_key(F.col("source"), F.col("response")).alias("key")).agg(
        F.bool_or(toxic).alias("is_refusal"), F.max(F.when(F.col("quality") == 1, 0.9).otherwise(0.75)).alias("confidence"), F.max(F.when(toxic, F.lit("safety"))).alias("refusal_type")
    )


@query(
    "v13_hybrid_refusals",
    f"""SELECT doc_id, CASE WHEN need THEN coalesce(jr, false) ELSE confidence >= 0.5 END AS is_refusal, CASE WHEN need THEN coalesce(jc, 0.0e0) ELSE confidence END AS confidence,
    CASE WHEN need THEN coalesce(jt, refusal_type) ELSE refusal_type END AS refusal_type, need AS judge_needed, need AND jr IS NOT NULL AS judge_used
    FROM (SELECT *, (confidence > 0 AND confidence < 0.7) OR (confidence = 0 AND length(response) > 500) OR (confidence >= 0.5 AND confidence < 0.8) AS need, {REFUSAL_KEY_SQL} AS key FROM ({REFUSAL_SQL}))
    LEFT JOIN ({REFUSAL_JUDGED}) USING (key)""",
)
def v13(spark: SparkSession, folder: str) -> DataFrame:
    found = R.hybrid_refusals(documents_with_sentence(spark, folder), F.col("source"), F.col("response"), stored_refusal_judgments(spark, folder), spread=["doc_id"])
    r = F.col("refusal")
    return found.select(
        "doc_id", r["is_refusal"].alias("is_refusal"), r["confidence"].alias("confidence"), r["refusal_type"].alias("refusal_type"),
        F.col("refusal_judge_needed").alias("judge_needed"), F.col("refusal_judge_used").alias("judge_used"),
    )


# --- verdicts --------------------------------------------------------------------------------------

@query(
    "v14_should_judge",
    W + """SELECT split, ground_truth IS NOT NULL AS has_truth, ground_truth IS NOT NULL AND answer <> '' AND ((NOT verification_is_verified AND verification_score < 0.5) OR split IN ('code', 'tool_calling')) AS judge,
    count(*) AS rows FROM cand GROUP BY 1, 2, 3""",
)
def v14(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).withColumn("has_truth", F.col("ground_truth").isNotNull())
    wanted = K.should_judge(F.col("verification_is_verified"), F.col("verification_score"), F.col("split"), F.col("has_truth"), F.col("answer") == "")
    return rows.groupBy("split", "has_truth", wanted.alias("judge")).agg(F.count("*").alias("rows"))


def key_sql(truth: str = "coalesce(ground_truth, '')") -> str:
    return f"left(sha256({strip_sql('question')} || '|' || {strip_sql('answer')} || '|' || {strip_sql(truth)} || '|' || split), 16)"


# Variant a asks whether a tool answer fits, without a truth.
TRUTH_A = "CASE WHEN split = 'tool_calling' THEN '' ELSE coalesce(ground_truth, '') END"
# Stored verdicts exist for the answers of queries that were not verified earlier.
JUDGED = """SELECT key, max(part) %% 2 = 0 AS jv, (max(part) %% 11) / 10.0e0 AS jc, 'because ' || max(part) AS jr FROM (SELECT %s AS key, part FROM cand WHERE NOT verification_is_verified) GROUP BY key"""


def stored_judgments(rows: DataFrame, blank_tool_truth: bool) -> DataFrame:
    truth = F.when(F.col("split") == "tool_calling", F.lit("")).otherwise(F.col("ground_truth")) if blank_tool_truth else F.col("ground_truth")
    key = verdict_key(F.col("question"), F.col("answer"), truth, F.col("split"))
    grouped = rows.where(~F.col("verification_is_verified")).groupBy(key.alias("key")).agg(F.max("part").alias("p"))
    return grouped.select(
        "key", (F.col("p") % 2 == 0).alias("equivalent"), ((F.col("p") % 11) / 10.0).alias("confidence"), F.concat(F.lit("because "), F.col("p")).alias("reasoning"), F.lit("judge").alias("judge")
    )


@query(
    "v15_accept_verdict",
    W + f"""SELECT query_id, arrival, CASE WHEN j.key IS NOT NULL AND (split = 'tool_calling' OR jc > 0.7) THEN jv WHEN j.key IS NULL AND split = 'tool_calling' THEN false ELSE verification_is_verified END AS is_correct,
    round(CASE WHEN j.key IS NOT NULL AND (split = 'tool_calling' OR jc > 0.7) THEN jc WHEN j.key IS NULL AND split = 'tool_calling' THEN 0.3e0 ELSE verification_score END, 6) AS confidence
    FROM (SELECT *, {key_sql()} AS key FROM cand) c LEFT JOIN ({JUDGED % key_sql()}) j USING (key)""",
)
def v15(spark: SparkSession, folder: str) -> DataFrame:
    from candor.operators.joins import attach_by_key

    rows = candidates(spark, folder)
    key = verdict_key(F.col("question"), F.col("answer"), F.col("ground_truth"), F.col("split"))
    joined = attach_by_key(rows, stored_judgments(rows, False), key, F.lit(True), "_j_", ["query_id", "candidate_idx"])
    current = S.score("math", F.col("verification_is_verified"), F.col("verification_score"), "", "stored")
    final = K.accept_verdict(current, F.lit(True), F.col("_j_found"), F.col("_j_equivalent"), F.col("_j_confidence"), F.col("_j_reasoning"), F.col("split") == "tool_calling")
    return opened(joined.withColumn("s", final), "s", "is_correct", "confidence")


SYNTAX_OK = f"(NOT (contains({CODE_OR_TEXT}, 'def f(:') OR contains({CODE_OR_TEXT}, 'I cannot') OR contains({CODE_OR_TEXT}, 'SELECT ') OR contains({CODE_OR_TEXT}, 'function f()')))"


@query(
    "v16_overrides",
    W + f"""SELECT query_id, arrival, CASE WHEN {strip_sql('answer')} = '' THEN false WHEN split = 'code' AND NOT {SYNTAX_OK} THEN false ELSE verification_is_verified END AS is_correct,
    round(CASE WHEN {strip_sql('answer')} = '' THEN 0.0e0 WHEN split = 'code' AND NOT {SYNTAX_OK} THEN 1.0e0 WHEN split = 'code' THEN greatest(verification_score, 0.8e0) ELSE verification_score END, 6) AS confidence,
    CASE WHEN {strip_sql('answer')} = '' THEN 'empty_check' WHEN split = 'code' AND NOT {SYNTAX_OK} THEN 'ast_syntax' ELSE 'math' END AS verifier_name FROM cand""",
)
def v16(spark: SparkSession, folder: str) -> DataFrame:
    from candor.functions.code import code_or_text, python_syntax_of
    from candor.functions.text import is_empty_response

    rows = candidates(spark, folder).withColumn("empty", is_empty_response(F.col("answer")))
    applies = (F.col("split") == "code") & ~F.col("empty")
    rows = rows.withColumn("syntax", python_syntax_of(F.when(applies, code_or_text(F.col("answer")))))
    current = S.score("math", F.col("verification_is_verified"), F.col("verification_score"), "", "stored")
    final = K.syntax_override(K.empty_override(current, F.col("empty")), F.col("syntax"), applies)
    return opened(rows.withColumn("s", final), "s", "is_correct", "confidence", "verifier_name")


def cascade_sql(variant: str) -> str:
    """SQL: the whole cascade; the local scores of the three splits are stacked, then overridden step by step."""
    empty = f"({strip_sql('answer')} = '')"
    tool = "SELECT query_id, arrival, false AS v0, 0.5e0 AS c0 FROM cand WHERE split = 'tool_calling'"
    if variant == "b":
        sql = TOOL_SQL.replace("WHEN coalesce(tool_name NOT IN ('get_weather', 'search'), true) THEN 'tool_exists'", "")
        tool = f"SELECT query_id, arrival, {METHOD_CONFIDENCE} > 0 AS v0, {METHOD_CONFIDENCE} AS c0 FROM ({sql})"
    local = f"""SELECT query_id, arrival, confidence > 0 AS v0, confidence AS c0 FROM ({MATH_SQL}) UNION ALL
      SELECT query_id, arrival, {CODE_CONFIDENCE} > 0, {CODE_CONFIDENCE} FROM ({CODE_SQL}) UNION ALL {tool}"""
    checked = f"split = 'code' AND NOT {empty}" + (" AND NOT v0" if variant == "b" else "")
    truth = TRUTH_A if variant == "a" else "coalesce(ground_truth, '')"
    queue = (
        f"CASE WHEN split = 'tool_calling' THEN NOT {empty} ELSE coalesce(ground_truth, '') <> '' AND NOT {empty} AND ((NOT v1 AND c1 < 0.5) OR split = 'code') END"
        if variant == "a" else f"coalesce(ground_truth, '') <> '' AND NOT {empty} AND ((NOT v1 AND c1 < 0.5) OR split IN ('code', 'tool_calling'))"
    )
    always = "split = 'tool_calling'" if variant == "a" else "false"
    return f""", local AS ({local}),
    overridden AS (SELECT cand.*, CASE WHEN {empty} THEN false WHEN {checked} AND NOT {SYNTAX_OK} THEN false ELSE v0 END AS v1,
      CASE WHEN {empty} THEN 0.0e0 WHEN {checked} AND NOT {SYNTAX_OK} THEN 1.0e0 WHEN {checked} THEN greatest(c0, 0.8e0) ELSE c0 END AS c1 FROM cand JOIN local USING (query_id, arrival)),
    queued AS (SELECT *, {queue} AS judge, {key_sql(truth)} AS key, CASE WHEN raw_text <> '' THEN raw_text WHEN analysis <> '' THEN analysis || chr(10) || answer ELSE answer END AS response FROM overridden),
    judged AS (SELECT *, judge AND key2 IS NULL AS failed, CASE WHEN judge AND {always} AND key2 IS NULL THEN false WHEN judge AND key2 IS NOT NULL AND ({always} OR jc > 0.7) THEN jv ELSE v1 END AS verified,
      CASE WHEN judge AND {always} AND key2 IS NULL THEN 0.3e0 WHEN judge AND key2 IS NOT NULL AND ({always} OR jc > 0.7) THEN jc ELSE c1 END AS score
      FROM queued LEFT JOIN (SELECT key AS key2, jv, jc FROM ({JUDGED % key_sql(truth)})) ON key = key2),
    searched AS (SELECT *, {hits_sql('response')} AS h FROM judged),
    final AS (SELECT *, {CONFIDENCE.format(n=count_sql('h'))} AS rc FROM searched)
    SELECT query_id, arrival, split, verified, round(score, 6) AS score, judge AS judge_used, failed AS judge_failed, CASE WHEN verified THEN false ELSE rc >= 0.5 END AS is_refusal,
      CASE WHEN verified THEN 1.0e0 ELSE rc END AS refusal_confidence, CASE WHEN verified THEN NULL ELSE {type_sql('h')} END AS refusal_type, length({strip_sql('answer')}) AS answer_length FROM final"""


def cascade(spark: SparkSession, folder: str, variant: str) -> DataFrame:
    rows = candidates(spark, folder)
    scored = K.score_candidates(rows, variant, judgments=stored_judgments(rows, variant == "a"))
    v, r = F.col("verification"), F.col("refusal")
    return scored.select(
        *KEY, "split", v["is_verified"].alias("verified"), F.round(v["score"], 6).alias("score"), v["llm_judge_used"].alias("judge_used"), v["llm_judge_failed"].alias("judge_failed"),
        r["is_refusal"].alias("is_refusal"), r["confidence"].alias("refusal_confidence"), r["refusal_type"].alias("refusal_type"), F.col("quality.answer_length").cast("long").alias("answer_length"),
    )


W_MATERIALIZED = W.replace("cand AS (", "cand AS MATERIALIZED (", 1)


# Stored refusal judgments exist for one candidate in three.
RESPONSE_SQL = "CASE WHEN raw_text <> '' THEN raw_text WHEN analysis <> '' THEN analysis || chr(10) || answer ELSE answer END"
RESPONSE_KEY_SQL = f"left(sha256({strip_sql('question')} || '|' || {strip_sql('response')}), 16)"
RESPONSES_JUDGED = f"""SELECT {RESPONSE_KEY_SQL} AS rkey, max(part) % 2 = 0 AS jr, (max(part) % 11) / 10.0e0 AS jrc, CASE WHEN max(part) % 2 = 0 THEN 'safety' END AS jrt
  FROM (SELECT *, {RESPONSE_SQL} AS response FROM cand WHERE part % 3 = 0) GROUP BY 1"""


def stored_response_judgments(rows: DataFrame) -> DataFrame:
    joined = F.when(F.col("analysis") != "", F.concat_ws("\n", "analysis", "answer")).otherwise(F.col("answer"))
    response = F.when(F.col("raw_text") != "", F.col("raw_text")).otherwise(joined)
    grouped = rows.where(F.col("part") % 3 == 0).groupBy(refusal_key(F.col("question"), response).alias("key")).agg(F.max("part").alias("p"))
    return grouped.select("key", (F.col("p") % 2 == 0).alias("is_refusal"), ((F.col("p") % 11) / 10.0).alias("confidence"), F.when(F.col("p") % 2 == 0, F.lit("safety")).alias("refusal_type"))


def whole_cascade_sql(variant: str) -> str:
    """SQL: the cascade with the specification of tool answers and with refusal judgments."""
    sql = cascade_sql(variant)
    if variant == "b":
        plain = TOOL_SQL.replace("WHEN coalesce(tool_name NOT IN ('get_weather', 'search'), true) THEN 'tool_exists'", "")
        assert plain in sql
        sql = sql.replace(plain, FULL_TOOL_SQL)
    body, _, _ = sql.rpartition("SELECT query_id, arrival, split, verified")
    return body.rstrip() + f""",
    asked AS (SELECT *, NOT verified AND ((rc > 0 AND rc < 0.7) OR (rc = 0 AND length(response) > 500) OR (rc >= 0.5 AND rc < 0.8)) AS need, {RESPONSE_KEY_SQL} AS rkey FROM final)
    SELECT query_id, arrival, split, verified, round(score, 6) AS score, CASE WHEN verified THEN false WHEN need THEN coalesce(jr, false) ELSE rc >= 0.5 END AS is_refusal,
      CASE WHEN verified THEN 1.0e0 WHEN need THEN coalesce(jrc, 0.0e0) ELSE rc END AS refusal_confidence, CASE WHEN verified THEN NULL WHEN need THEN coalesce(jrt, {type_sql('h')}) ELSE {type_sql('h')} END AS refusal_type
    FROM asked LEFT JOIN ({RESPONSES_JUDGED}) USING (rkey)"""


def whole_cascade(spark: SparkSession, folder: str, variant: str) -> DataFrame:
    rows = candidates(spark, folder)
    scored = K.score_candidates(with_specification(spark, folder), variant, stored_judgments(rows, variant == "a"), stored_response_judgments(rows))
    v, r = F.col("verification"), F.col("refusal")
    return scored.select(
        *KEY, "split", v["is_verified"].alias("verified"), F.round(v["score"], 6).alias("score"),
        r["is_refusal"].alias("is_refusal"), r["confidence"].alias("refusal_confidence"), r["refusal_type"].alias("refusal_type"),
    )


@query("v17_v18_all_stages", W_MATERIALIZED.rstrip() + whole_cascade_sql("a"))
def v18_all(spark: SparkSession, folder: str) -> DataFrame:
    return whole_cascade(spark, folder, "a")


@query("v18_all_stages_variant_b", W_MATERIALIZED.rstrip() + whole_cascade_sql("b"))
def v18_all_b(spark: SparkSession, folder: str) -> DataFrame:
    return whole_cascade(spark, folder, "b")


@query("v17_v18_score_candidates", W_MATERIALIZED.rstrip() + cascade_sql("a"))
def v18(spark: SparkSession, folder: str) -> DataFrame:
    return cascade(spark, folder, "a")


@query("v18_score_candidates_variant_b", W_MATERIALIZED.rstrip() + cascade_sql("b"))
def v18_b(spark: SparkSession, folder: str) -> DataFrame:
    return cascade(spark, folder, "b")


@query(
    "v18_records_report",
    W_MATERIALIZED.rstrip() + cascade_sql("a").replace("SELECT query_id, arrival, split, verified, round(score, 6)", "SELECT split, count(*) AS records, count(*) FILTER (WHERE verified) AS verified, count(*) FILTER (WHERE is_refusal) AS refusals, round(avg(score), 6) AS avg_score FROM (SELECT query_id, arrival, split, verified, round(score, 6)", 1) + ") GROUP BY split",
)
def v18_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).withColumns({n: F.from_json(n, K.MESSAGES) for n in ("input_messages", "output_messages")})
    records = K.to_records(K.score_candidates(rows, "a", judgments=stored_judgments(rows, True)))
    return records.groupBy("split").agg(
        F.count("*").alias("records"), F.count_if("verification_is_verified").alias("verified"), F.count_if("refusal_is_refusal").alias("refusals"),
        F.round(F.avg(F.round("verification_score", 6)), 6).alias("avg_score"),
    )


@query(
    "x01_x02_score_by_split",
    W_MATERIALIZED.rstrip() + f""", local AS (SELECT split, 'math' AS verifier_name, confidence AS c FROM ({MATH_SQL}) UNION ALL SELECT split, 'code', {CODE_CONFIDENCE} FROM ({CODE_SQL}) UNION ALL
    SELECT split, 'tool', {METHOD_CONFIDENCE} FROM ({TOOL_SQL.replace("WHEN coalesce(tool_name NOT IN ('get_weather', 'search'), true) THEN 'tool_exists'", "")}))
    SELECT split, verifier_name, count(*) AS rows, count(*) FILTER (WHERE c > 0) AS correct, round(sum(c), 4) AS confidence FROM local GROUP BY split, verifier_name""",
)
def x01(spark: SparkSession, folder: str) -> DataFrame:
    scored = S.score_by_split(candidates(spark, folder))
    s = F.col("local_score")
    return scored.groupBy("split", s["verifier_name"].alias("verifier_name")).agg(
        F.count("*").alias("rows"), F.count_if(s["is_correct"]).alias("correct"), F.round(F.sum(s["confidence"]), 4).alias("confidence")
    )
