"""Text, number, code and JSON functions over derived answers and whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions import code as C
from candor.functions import jsontext as J
from candor.functions import numbers as N
from candor.functions import style as S
from candor.functions import text as T
from candor.functions.quality import completeness_from_fields, completeness_from_steps, quality
from candor.plans.fixtures import CAND_CTE, CANDIDATES, NL, Q, BS, DQ, SQ, candidates, case, derived, select_sql, table, text
from candor.plans.registry import query

W = f"WITH {CAND_CTE} "
KEY = ["query_id", "arrival"]
# SQL: the characters a Unicode strip removes, and the strip itself.
SPACES_SQL = " || ".join(f"chr({c})" for c in T.SPACE_CODES)


def strip_sql(x: str) -> str:
    return f"trim({x}, {SPACES_SQL})"


# SQL: balanced content of the first boxed part, by testing the brace depth at each position of the tail.
BOXED = """SELECT *, CASE WHEN hit IS NOT NULL THEN substr(tail, 1, hit - 1) END AS boxed FROM (
  SELECT *, list_filter(range(1, length(tail) + 1), lambda i: 1 + length(replace(substr(tail, 1, i), '}', '')) - length(replace(substr(tail, 1, i), '{', '')) = 0)[1] AS hit
  FROM (SELECT *, CASE WHEN contains(%(x)s, '\\boxed{') THEN substr(%(x)s, strpos(%(x)s, '\\boxed{') + 7) END AS tail FROM %(t)s))"""


def boxed_sql(x: str, source: str) -> str:
    return BOXED % {"x": x, "t": source}


NUMBER = """coalesce(
  try_cast(regexp_extract_all(b, '(-?\\d+\\.?\\d*[eE][+-]?\\d+)', 1)[-1] AS DOUBLE),
  try_cast(regexp_extract(b, '(-?\\d+)/(\\d+)', 1) AS DOUBLE) / nullif(try_cast(regexp_extract(b, '(-?\\d+)/(\\d+)', 2) AS DOUBLE), 0),
  try_cast(regexp_extract_all(b, '(-?\\d+\\.?\\d*)%', 1)[-1] AS DOUBLE),
  try_cast(replace(regexp_extract_all(b, '\\$?(-?[\\d,]+\\.?\\d*)', 1)[-1], ',', '') AS DOUBLE))"""
EXPRESSION = """coalesce(nullif(boxed, ''), nullif(trim(regexp_extract(x, '=\\s*([^=\\n]+?)(?:\\s|$|,|\\.)', 1)), ''),
  trim(regexp_extract_all(x, '(?:^|\\s)([+-]?(?:\\d+\\.?\\d*|\\d*\\.?\\d+)(?:[eE][+-]?\\d+)?(?:/\\d+)?(?:\\s*[*+\\-/^]\\s*[\\w\\d.()]+)*)', 1)[-1]), """ + strip_sql("x") + ")"


@query("f01_boxed", W + f"SELECT query_id, arrival, boxed FROM ({boxed_sql('answer', 'cand')})")
def f01(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, T.boxed(F.col("answer")).alias("boxed"))


@query("f02_boxed_flat", W + "SELECT query_id, arrival, nullif(regexp_extract(answer, '\\\\boxed\\{([^}]+)\\}', 1), '') AS boxed FROM cand")
def f02(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, T.boxed_flat(F.col("answer")).alias("boxed"))


def tag_sql(x: str, tag: str) -> str:
    closed = f"regexp_matches({x}, '(?is)<{tag}>.*?</{tag}>')"
    rest = strip_sql(f"regexp_extract({x}, '(?is)<{tag}>(.*)', 1)")
    return (
        f"CASE WHEN {closed} THEN {strip_sql(f'''regexp_extract({x}, '(?is)<{tag}>(.*?)</{tag}>', 1)''')} "
        f"WHEN {rest} <> '' AND NOT regexp_matches({rest}, '^<\\w+>') THEN {rest} ELSE '' END"
    )


TAGS = ("plan", "reasoning", "evaluation", "normalized_query")


@query("f03_tag_bodies", W + "SELECT query_id, arrival, " + ", ".join(f"{tag_sql('analysis', t)} AS {t}" for t in TAGS) + f", {tag_sql('answer', 'answer')} AS tagged FROM cand")
def f03(spark: SparkSession, folder: str) -> DataFrame:
    tags = [T.tag_body(F.col("analysis"), t).alias(t) for t in TAGS]
    return candidates(spark, folder).select(*KEY, *tags, T.tag_body(F.col("answer"), "answer").alias("tagged"))


@query("f04_score_tag", W + "SELECT query_id, arrival, CASE WHEN n IS NOT NULL THEN greatest(0.0e0, least(5.0e0, n)) END AS score FROM (SELECT *, try_cast(nullif(regexp_extract(answer, '[-+]?\\d*\\.?\\d+'), '') AS DOUBLE) AS n FROM cand)")
def f04(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, T.score_tag(F.col("answer")).alias("score"))


LINES = "list_filter(list_transform(str_split(p, chr(10)), lambda l: trim(l, ' -' || chr(9))), lambda l: l <> '')"
STEPS = f"""SELECT query_id, arrival, array_to_string(CASE WHEN p = '' THEN [] WHEN len(s) > 0 THEN list_filter(list_transform(s, lambda e: trim(e)), lambda e: e <> '') ELSE {LINES} END, '|') AS steps
  FROM (SELECT *, regexp_extract_all(p, '%s', 1) AS s FROM (SELECT query_id, arrival, {tag_sql('analysis', 'plan')} AS p FROM cand))"""


@query("f05_plan_steps", W + STEPS % "(?is)<step>(.*?)</step>")
def f05(spark: SparkSession, folder: str) -> DataFrame:
    plan = candidates(spark, folder).select(*KEY, T.tag_body(F.col("analysis"), "plan").alias("plan"))
    return plan.select(*KEY, F.array_join(T.plan_steps(F.col("plan")), "|").alias("steps"))


@query("f06_listed_steps", W + STEPS % "(?m)(?:^|\\n)\\s*(?:\\d+[\\.)]\\s*|[-•*]\\s*)(.+)")
def f06(spark: SparkSession, folder: str) -> DataFrame:
    plan = candidates(spark, folder).select(*KEY, T.tag_body(F.col("analysis"), "plan").alias("plan"))
    return plan.select(*KEY, F.array_join(T.listed_steps(F.col("plan")), "|").alias("steps"))


@query(
    "f07_self_score",
    W + f"""SELECT query_id, arrival, coalesce(try_cast(nullif(regexp_extract(e, '(?i)<score>(\\d+(?:\\.\\d+)?)</score>', 1), '') AS DOUBLE),
    try_cast(nullif(regexp_extract(e, '(?i)score[:\\s]+(\\d+(?:\\.\\d+)?)', 1), '') AS DOUBLE)) AS score
    FROM (SELECT query_id, arrival, {tag_sql('analysis', 'evaluation')} AS e FROM cand)""",
)
def f07(spark: SparkSession, folder: str) -> DataFrame:
    found = candidates(spark, folder).select(*KEY, T.tag_body(F.col("analysis"), "evaluation").alias("e"))
    return found.select(*KEY, T.self_score(F.col("e")).alias("score"))


# A limit that part of the documents exceeds.
DOC_LIMIT = 4_000


@query(
    "f08_f09_truncate",
    f"""SELECT doc_id, length(t) AS length, md5(t) AS digest, ends_with(t, chr(10) || '[TRUNCATED]') AS was_truncated
    FROM (SELECT doc_id, CASE WHEN length(text) > {DOC_LIMIT} THEN substr(text, 1, {DOC_LIMIT}) || chr(10) || '[TRUNCATED]' ELSE text END AS t FROM documents)""",
)
def f08(spark: SparkSession, folder: str) -> DataFrame:
    cut = table(spark, folder, "documents").select("doc_id", T.truncate(F.col("text"), DOC_LIMIT).alias("t"))
    return cut.select("doc_id", F.length("t").cast("long").alias("length"), F.md5("t").alias("digest"), T.was_truncated(F.col("t")).alias("was_truncated"))


@query("f10_empty_responses", W + f"SELECT split, count(*) AS empty FROM cand WHERE length({strip_sql('answer')}) = 0 GROUP BY split")
def f10(spark: SparkSession, folder: str) -> DataFrame:
    empty = candidates(spark, folder).where(T.is_empty_response(F.col("answer")))
    return empty.groupBy("split").agg(F.count("*").alias("empty"))


QUALITY = ["answer_length", "reasoning_length", "plan_length", "total_response_length", "has_reasoning", "has_plan", "is_short_answer", "is_substantive", "is_empty", "completeness_score"]
QUALITY_SQL = """SELECT {key}, a AS answer_length, r AS reasoning_length, p AS plan_length, {total} AS total_response_length, r > 0 AS has_reasoning, p > 0 AS has_plan,
  a < 50 AS is_short_answer, r > 100 OR a > 50 AS is_substantive, a = 0 AS is_empty, {complete} AS completeness_score FROM ({source})"""


def quality_sql(key: str, source: str, total: str = "a + r + p", complete: str = "CASE WHEN r > 0 AND a > 0 THEN 1.0e0 ELSE 0.5e0 END") -> str:
    return QUALITY_SQL.format(key=key, source=source, total=total, complete=complete)


def length_sql(x: str) -> str:
    return f"coalesce(length({strip_sql(x)}), 0)"


@query(
    "f11_quality_documents",
    quality_sql("doc_id", f"SELECT doc_id, {length_sql('text')} AS a, {length_sql('lang')} AS r, {length_sql('source')} AS p FROM documents"),
)
def f11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("q", quality(F.col("text"), F.col("lang"), F.col("source")))
    return docs.select("doc_id", *[F.col(f"q.{n}").alias(n) for n in QUALITY])


@query(
    "f12_completeness_from_fields",
    W + "SELECT query_id, arrival, round((" + " + ".join(f"CAST({tag_sql('analysis', t)} <> '' AS INT)" for t in TAGS)
    + " + CAST(answer <> '' AS INT)) / 5.0e0, 6) AS completeness FROM cand",
)
def f12(spark: SparkSession, folder: str) -> DataFrame:
    fields = [T.tag_body(F.col("analysis"), t) for t in TAGS]
    value = completeness_from_fields(*fields, F.col("answer"))
    return candidates(spark, folder).select(*KEY, F.round(value, 6).alias("completeness"))


@query(
    "f13_completeness_from_steps",
    W + f"SELECT query_id, arrival, CASE WHEN {tag_sql('analysis', 'plan')} <> '' THEN (1.0e0 + CAST(answer <> '' AS INT)) / 2 ELSE CAST(answer <> '' AS INT) * 0.5e0 END AS completeness FROM cand",
)
def f13(spark: SparkSession, folder: str) -> DataFrame:
    plan = candidates(spark, folder).withColumn("steps", T.plan_steps(T.tag_body(F.col("analysis"), "plan")))
    return plan.select(*KEY, completeness_from_steps(F.col("steps"), F.col("answer")).alias("completeness"))


@query(
    "f14_quality_variants",
    W + quality_sql(
        "query_id, arrival",
        f"SELECT *, {length_sql('answer')} AS a, {length_sql('analysis')} AS r, 0 AS p FROM cand",
        "length(analysis) + length(answer)", "(CAST(analysis <> '' AS INT) + CAST(answer <> '' AS INT)) / 2.0e0",
    ),
)
def f14(spark: SparkSession, folder: str) -> DataFrame:
    from candor.functions.messages import from_json_text, total_length

    rows = candidates(spark, folder).withColumn("messages", from_json_text(F.col("output_messages")))
    value = quality(
        F.col("answer"), F.col("analysis"), total=total_length(F.col("messages")),
        completeness=completeness_from_fields(F.col("analysis"), F.col("answer")),
    )
    return rows.withColumn("q", value).select(*KEY, *[F.col(f"q.{n}").alias(n) for n in QUALITY])


@query("f15_number", W + f"SELECT query_id, arrival, round({NUMBER}, 6) AS number FROM (SELECT *, coalesce(nullif(boxed, ''), answer) AS b FROM ({boxed_sql('answer', 'cand')}))")
def f15(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, F.round(N.number_in(F.col("answer")), 6).alias("number"))


@query(
    "f16_simple_number",
    W + """SELECT query_id, arrival, round(coalesce(try_cast(regexp_extract_all(b, '(-?\\d+\\.?\\d*[eE][+-]?\\d+)', 1)[-1] AS DOUBLE),
    try_cast(str_split(regexp_extract_all(b, '(-?\\d+/\\d+)', 1)[-1], '/')[1] AS DOUBLE) / nullif(try_cast(str_split(regexp_extract_all(b, '(-?\\d+/\\d+)', 1)[-1], '/')[2] AS DOUBLE), 0),
    try_cast(regexp_extract_all(b, '(-?\\d+\\.?\\d*)', 1)[-1] AS DOUBLE)), 6) AS number
    FROM (SELECT *, replace(replace(replace(coalesce(nullif(regexp_extract(answer, '\\\\boxed\\{([^}]+)\\}', 1), ''), answer), '$', ''), '%', ''), ',', '') AS b FROM cand)""",
)
def f16(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, F.round(N.simple_number_in(F.col("answer")), 6).alias("number"))


@query(
    "f17_is_close",
    "SELECT l_orderkey, l_linenumber, abs(l_discount - l_tax) <= greatest(0.1e0 * greatest(abs(l_discount), abs(l_tax)), 0.005e0) AS is_close FROM lineitem",
)
def f17(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", N.is_close(F.col("l_discount"), F.col("l_tax"), 0.1, 0.005).alias("is_close"))


@query("f18_expression", W + f"SELECT query_id, arrival, {EXPRESSION} AS expression FROM (SELECT *, answer AS x FROM ({boxed_sql('answer', 'cand')}))")
def f18(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, N.expression_in(F.col("answer")).alias("expression"))


CODE_OR_TEXT = f"""CASE WHEN regexp_matches(answer, '(?is)```python\\n.+?```') THEN {strip_sql("regexp_extract(answer, '(?is)```python\\n(.+?)```', 1)")}
  WHEN regexp_matches(answer, '(?s)```\\n.+?```') THEN {strip_sql("regexp_extract(answer, '(?s)```\\n(.+?)```', 1)")} ELSE {strip_sql('answer')} END"""


@query("f19_code_or_text", W + f"SELECT query_id, arrival, {CODE_OR_TEXT} AS code FROM cand")
def f19(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, C.code_or_text(F.col("answer")).alias("code"))


def has_sql(*parts: str) -> str:
    return " OR ".join(f"contains(answer, '{p}')" for p in parts)


def count_sql(*conditions: str) -> str:
    return "(" + " + ".join(f"CAST(({c}) AS INT)" for c in conditions) + ")"


PYTHON_COUNT = count_sql(
    *[has_sql(p) for p in ("def ", "import ", "print(", "self.", "elif ", "__init__", "return ", "range(", "len(", "None", "lambda ", ".append(")],
    f"{has_sql('class ')} AND {has_sql(':')}", f"{has_sql(' in ')} AND {has_sql('for ')}", f"{has_sql('if ')} AND {has_sql(':')}",
    "regexp_matches(answer, '\\[.+\\s+for\\s+.+\\s+in\\s+')", f"{has_sql('f' + chr(34))} OR contains(answer, 'f' || chr(39))",
    has_sql("True", "False"), has_sql(".items()", ".keys()", ".values()"),
)
JS_COUNT = count_sql(
    *[has_sql(p) for p in ("function ", "const ", "let ", "var ", "console.log(", "=>", "===", ".forEach(", ".map(", ".filter(", ".reduce(", "!== ", "typeof ", ".push(")],
    f"{has_sql('return ')} AND {has_sql('{')}", "contains(lower(answer), 'null') AND NOT contains(answer, 'None')", has_sql("async ", "await "),
)
SQL_COUNT = count_sql(*[f"contains(upper(answer), '{p}')" for p in ("SELECT ", "CREATE TABLE", "INSERT INTO", "FROM ", "WHERE ")])
BASH_COUNT = count_sql(*[has_sql(p) for p in ("#!/bin/bash", "#!/bin/sh", "echo ", "$(", "${")])
LANGUAGE = f"""SELECT *, CASE WHEN f IN ('python', 'py') THEN 'python' WHEN f IN ('javascript', 'js', 'typescript', 'ts', 'node') THEN 'javascript'
    WHEN f IN ('bash', 'sh', 'shell') THEN 'bash' WHEN f = 'sql' THEN 'sql' WHEN f <> '' THEN 'python' WHEN p = m THEN 'python' WHEN j = m THEN 'javascript' WHEN s = m THEN 'sql' ELSE 'bash' END AS language,
  CASE WHEN f IN ('python', 'py', 'javascript', 'js', 'typescript', 'ts', 'node', 'bash', 'sh', 'shell', 'sql') THEN 0.95e0 WHEN f <> '' THEN 0.3e0
    WHEN m = 0 THEN 0.2e0 WHEN m = p + j + s + b THEN least(0.9e0, 0.5e0 + m * 0.1e0) WHEN m >= 3 THEN 0.8e0 WHEN m = 2 THEN 0.6e0 ELSE 0.4e0 END AS confidence
  FROM (SELECT *, greatest(p, j, s, b) AS m FROM (SELECT *, lower(regexp_extract(answer, '```(\\w+)', 1)) AS f, {PYTHON_COUNT} AS p, {JS_COUNT} AS j, {SQL_COUNT} AS s, {BASH_COUNT} AS b FROM cand))"""
HINTS_SQL = {
    "python": has_sql("def ", "class ", "import ", "print(", "return ", "if __name__"),
    "javascript": has_sql("function ", "const ", "let ", "var ", "console.log(", "=>"),
    "bash": has_sql("#!/bin/bash", "echo ", "if [", "for ", "while "),
    "sql": has_sql("SELECT ", "INSERT ", "UPDATE ", "DELETE ", "CREATE "),
}
FENCES_SQL = {"python": "python", "javascript": "(?:javascript|js|typescript|ts|node)", "bash": "bash", "sql": "sql"}


def code_in_sql(language: str) -> str:
    pattern = f"(?is)```{FENCES_SQL[language]}\\s*\\n"
    named = strip_sql(f"regexp_extract(answer, '{pattern}(.*?)```', 1)")
    bare = strip_sql("regexp_extract(answer, '(?s)```\\s*\\n(.*?)```', 1)")
    return (
        f"CASE WHEN regexp_matches(answer, '{pattern}.*?```') THEN {named} WHEN regexp_matches(answer, '(?s)```\\s*\\n.*?```') THEN {bare} "
        f"WHEN {HINTS_SQL[language]} THEN {strip_sql('answer')} END"
    )


CODE_IN = "CASE language " + " ".join(f"WHEN '{name}' THEN {code_in_sql(name)}" for name in FENCES_SQL) + " END"


@query("f20_code_in", W + f"SELECT query_id, arrival, {CODE_IN} AS code FROM ({LANGUAGE})")
def f20(spark: SparkSession, folder: str) -> DataFrame:
    spoken = candidates(spark, folder).withColumn("language", C.language_of(F.col("answer"))["language"])
    return spoken.select(*KEY, C.code_in(F.col("answer"), F.col("language")).alias("code"))


@query("f21_language", W + f"SELECT query_id, arrival, language, round(confidence, 6) AS confidence FROM ({LANGUAGE})")
def f21(spark: SparkSession, folder: str) -> DataFrame:
    found = candidates(spark, folder).withColumn("found", C.language_of(F.col("answer")))
    return found.select(*KEY, F.col("found.language").alias("language"), F.round("found.confidence", 6).alias("confidence"))


HEADER = """SELECT query_id, arrival, r AS recipient, regexp_extract(r, '([^.]*)$', 1) AS tool, CASE WHEN contains(r, '.') THEN regexp_extract(r, '^(.*)\\.[^.]*$', 1) ELSE '' END AS namespace,
  json_extract_string(regexp_extract(answer, '(?s)\\{.*\\}'), '$.city') AS city FROM (SELECT *, regexp_extract(answer, 'to=([\\w.]+)', 1) AS r FROM cand) WHERE r <> ''"""


@query("f22_header_call", W + HEADER)
def f22(spark: SparkSession, folder: str) -> DataFrame:
    found = candidates(spark, folder).withColumn("call", J.header_call(F.col("answer"))).where(F.col("call").isNotNull())
    city = F.try_variant_get(F.col("call.parameters"), "$.city", "string")
    return found.select(*KEY, F.col("call.recipient").alias("recipient"), F.col("call.tool").alias("tool"), F.col("call.namespace").alias("namespace"), city.alias("city"))


JSON_TEXT = f"""CASE WHEN regexp_matches(answer, '(?is)```json\\s*\\n.*?```') THEN {strip_sql("regexp_extract(answer, '(?is)```json\\s*\\n(.*?)```', 1)")}
  ELSE coalesce(nullif(regexp_extract(answer, '(?s)(\\{{.*\\}}|\\[.*\\])', 1), ''), {strip_sql('answer')}) END"""


@query(
    "f23_json_in",
    W + f"""SELECT query_id, arrival, json_valid(j) AS readable, CASE WHEN json_valid(j) AND json_type(j) = 'OBJECT' THEN len(json_keys(j)) END AS members
    FROM (SELECT *, {JSON_TEXT} AS j FROM cand)""",
)
def f23(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).withColumn("found", J.json_in(F.col("answer")))
    members = F.size(J.as_object(F.col("found")))
    return rows.select(*KEY, F.col("found").isNotNull().alias("readable"), F.when(members >= 0, members).cast("long").alias("members"))


@query("f24_plain_key", W + "SELECT query_id, arrival, replace(replace(lower(harmony_encoding || '-' || model), '_', ''), '-', '') AS plain FROM cand")
def f24(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, J.plain_key(F.concat_ws("-", "harmony_encoding", "model")).alias("plain"))


LEFT_VALUE = case("l_partkey % 8", text(DQ, "'C'", Q, DQ), Q, text(DQ, Q, DQ), "'true'", text(DQ, "'Yes'", DQ), "'null'", text(Q, "'.0'"), text(DQ, "'off'", DQ))
RIGHT_VALUE = case("l_suppkey % 6", text(DQ, "'c'", Q, DQ), Q, text(DQ, "'on'", DQ), "'false'", "'null'", text(DQ, "'1'", DQ))
VALUE_PAIRS = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "a": LEFT_VALUE, "b": RIGHT_VALUE}


def word(x: str) -> str:
    """SQL: word of a JSON string or boolean."""
    return f"lower(CASE WHEN json_type({x}) IN ('VARCHAR', 'BOOLEAN') THEN json_extract_string({x}, '$') END)"


SAME = f"""SELECT query_id, arrival, coalesce(a = b, false) OR coalesce(sa = sb, false) OR coalesce(na = nb, false)
  OR coalesce(wa IN ('true', 'yes', '1', 'on') AND wb IN ('true', 'yes', '1', 'on'), false) OR coalesce(wa IN ('false', 'no', '0', 'off') AND wb IN ('false', 'no', '0', 'off'), false) AS same
  FROM (SELECT *, {word('a')} AS wa, {word('b')} AS wb,
    CASE WHEN json_type(a) = 'VARCHAR' THEN lower(json_extract_string(a, '$')) END AS sa, CASE WHEN json_type(b) = 'VARCHAR' THEN lower(json_extract_string(b, '$')) END AS sb,
    CASE WHEN json_type(a) <> 'BOOLEAN' THEN try_cast(json_extract_string(a, '$') AS DOUBLE) END AS na, CASE WHEN json_type(b) <> 'BOOLEAN' THEN try_cast(json_extract_string(b, '$') AS DOUBLE) END AS nb
    FROM ({select_sql(VALUE_PAIRS, 'lineitem')}))"""


@query("f25_same_value", SAME)
def f25(spark: SparkSession, folder: str) -> DataFrame:
    pairs = derived(spark, folder, "lineitem", VALUE_PAIRS)
    parsed = pairs.withColumns({"a": J.parse(F.col("a")), "b": J.parse(F.col("b"))})
    return parsed.select(*KEY, J.same_value(F.col("a"), F.col("b")).alias("same"))


@query("f26_looks_numeric", W + "SELECT query_id, arrival, regexp_matches(replace(replace(exec_stdout, '.', ''), '-', ''), '^[0-9]+$') AS numeric FROM cand")
def f26(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, J.looks_numeric(F.col("exec_stdout")).alias("numeric"))


JUDGE_TEXT = case(
    "l_partkey % 7",
    text("'{\"equivalent\": true, \"confidence\": 0.9, \"reasoning\": \"ok '", Q, "'\"}'"),
    text("'Sure:'", NL, "'```json'", NL, "'{\"equivalent\": false, \"confidence\": 0.8}'", NL, "'```'"),
    "'{\"equivalent\": true, \"confidence\": 0.7} and more'",
    text("'{'", SQ, "'equivalent'", SQ, "': True, '", SQ, "'confidence'", SQ, "': 0.6, '", SQ, "'reasoning'", SQ, "': None}'"),
    text("'{\"equivalent\": true, \"confidence\": 0.5, \"reasoning\": \"'", BS, "'sqrt{2} and '", BS, "'pi\"}'"),
    "'no verdict'",
    "'{\"equivalent\": false, \"detail\": {\"a\": 1}, \"confidence\": 0.4} tail }'",
)
JUDGE = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "response": JUDGE_TEXT}


@query(
    "f27_judge_json",
    f"""SELECT query_id, arrival, lower(nullif(regexp_extract(response, 'equivalent[^:]: *(\\w+)', 1), '')) = 'true' AS equivalent,
    try_cast(nullif(regexp_extract(response, 'confidence[^:]: *([0-9.]+)', 1), '') AS DOUBLE) AS confidence FROM ({select_sql(JUDGE, 'lineitem')})""",
)
def f27(spark: SparkSession, folder: str) -> DataFrame:
    responses = derived(spark, folder, "lineitem", JUDGE)
    parsed = responses.withColumn("found", J.judge_json(F.col("response")))
    return parsed.select(
        *KEY, F.try_variant_get("found", "$.equivalent", "boolean").alias("equivalent"), F.try_variant_get("found", "$.confidence", "double").alias("confidence")
    )


PERSONA_TEXT = case(
    "l_partkey % 5",
    "'<score>4.5</score>' || chr(10) || '<reasoning> Good voice </reasoning>'",
    text("'A score of '", "CAST(l_linenumber % 6 AS STRING)", "' seems right'"),
    "'No opinion'",
    "'<score>2</score>'",
    text("'<score>'", "CAST(l_linenumber % 6 AS STRING)", "'.25</score><reasoning></reasoning>'"),
)
PERSONA = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "output": PERSONA_TEXT}


@query(
    "f28_persona_judgement",
    f"""SELECT query_id, arrival, score, coalesce(round(score / 5.0, 6), 0.0e0) AS confidence, coalesce(score >= 3.0, false) AS is_correct,
    CASE WHEN tagged IS NOT NULL AND contains(output, '<reasoning>') THEN trim(regexp_extract(output, '(?s)<reasoning>(.*?)</reasoning>', 1)) WHEN tagged IS NOT NULL THEN 'No reasoning provided'
    WHEN score IS NOT NULL THEN substr(output, 1, 200) END AS reasoning
    FROM (SELECT *, coalesce(tagged, try_cast(nullif(regexp_extract(output, '\\b([0-5](?:\\.\\d+)?)\\b', 1), '') AS DOUBLE)) AS score
    FROM (SELECT *, try_cast(nullif(regexp_extract(output, '<score>(\\d+(?:\\.\\d+)?)</score>', 1), '') AS DOUBLE) AS tagged FROM ({select_sql(PERSONA, 'lineitem')})))""",
)
def f28(spark: SparkSession, folder: str) -> DataFrame:
    outputs = derived(spark, folder, "lineitem", PERSONA)
    found = outputs.withColumn("found", T.persona_judgement(F.col("output")))
    return found.select(
        *KEY, F.col("found.score").alias("score"), F.round("found.confidence", 6).alias("confidence"), F.col("found.is_correct").alias("is_correct"),
        F.col("found.reasoning").alias("reasoning"),
    )


def matches_sql(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, '(?i){pattern}'))"


@query("f30_markers", W + "SELECT query_id, arrival, " + ", ".join(f"{matches_sql('style_text', p)} AS {m}" for m, p in S.MARKERS.items()) + " FROM cand")
def f30(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, *[S.marker_count(F.col("style_text"), m).cast("long").alias(m) for m in S.MARKERS])


CONTRACTION_SQL = "(?i)" + S.CONTRACTION.replace("'", "''")


@query("f31_contractions", W + f"SELECT query_id, arrival, array_to_string(regexp_extract_all(style_text, '{CONTRACTION_SQL}', 1), '|') AS found FROM cand")
def f31(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, F.array_join(S.contractions(F.col("style_text")), "|").alias("found"))


CHANNEL_TEXT = case(
    "l_partkey % 3",
    text("'<|channel|>analysis<|message|>Plan '", Q, "'<|end|><|start|>assistant<|channel|>final<|message|>Answer '", Q, "'<|return|>'"),
    text("'<|channel|>analysis<|message|>Two'", NL, "'lines<|end|><|start|>assistant<|channel|>analysis<|message|>More<|end|><|start|>assistant<|channel|>commentary to=functions.calc<|constrain|>json<|message|>{\"n\": '", Q, "'}<|call|>'"),
    text("'Plain '", Q),
)
CHANNEL_ROWS = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "t": CHANNEL_TEXT}


def channel_sql(name: str) -> str:
    blocks = "list_filter(str_split(t, '<|channel|>')[2:], lambda b: regexp_extract(b, '^\\s*(\\w+)', 1) = '" + name + "')"
    body = "regexp_replace(regexp_extract(b, '(?s)<\\|message\\|>(.*)', 1), '(?s)<\\|(end|call|return|start)\\|>.*', '')"
    joined = f"array_to_string(list_transform({blocks}, lambda b: {body}), chr(10))"
    return f"CASE WHEN contains(t, '<|channel|>') THEN {joined} ELSE t END" if name == "final" else joined


@query("f32_channels", "SELECT query_id, arrival, " + ", ".join(f"{channel_sql(c)} AS {c}" for c in T.CHANNELS) + f" FROM ({select_sql(CHANNEL_ROWS, 'lineitem')})")
def f32(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "lineitem", CHANNEL_ROWS)
    return rows.select(*KEY, *[T.channel_text(F.col("t"), c).alias(c) for c in T.CHANNELS])


RESULT_PAIRS = {
    "query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"],
    "actual": case("l_partkey % 5", text("'{\"a\": '", Q, "', \"b\": {\"c\": 2, \"d\": 3}}'"), "'{\"a\": 1}'", "'{\"a\": 1, \"b\": {\"x\": 1}}'", Q, text(DQ, Q, DQ)),
    "expected": case("l_suppkey % 3", "'{\"a\": 1, \"b\": {\"c\": 2}}'", "CAST(l_quantity * 1.005 AS STRING)", text(DQ, Q, DQ)),
}


@query(
    "f33_same_result",
    f"""SELECT query_id, arrival, CASE WHEN actual = expected THEN true WHEN json_type(actual) = 'OBJECT' AND json_type(expected) = 'OBJECT' THEN json_exists(actual, '$.a') AND json_exists(actual, '$.b.c')
    WHEN json_type(actual) IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND json_type(expected) IN ('UBIGINT', 'BIGINT', 'DOUBLE')
    THEN abs(CAST(actual AS DOUBLE) - CAST(expected AS DOUBLE)) < 0.01 * greatest(abs(CAST(actual AS DOUBLE)), abs(CAST(expected AS DOUBLE)), 1) ELSE false END AS same
    FROM ({select_sql(RESULT_PAIRS, 'lineitem')})""",
)
def f33(spark: SparkSession, folder: str) -> DataFrame:
    pairs = derived(spark, folder, "lineitem", RESULT_PAIRS)
    parsed = pairs.withColumns({n: J.parse(F.col(n)) for n in ("actual", "expected")})
    return parsed.select(*KEY, J.same_result(F.col("actual"), F.col("expected")).alias("same"))


@query("f34_iso_timestamp", W + "SELECT query_id, arrival, CAST(epoch(CAST(replace(replace(timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP)) AS BIGINT) AS seconds FROM cand")
def f34(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, F.unix_seconds(T.iso_timestamp(F.col("timestamp"))).alias("seconds"))
