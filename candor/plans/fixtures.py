"""Candidate-shaped tables derived row by row from the given tables.

Every expression is SQL that Spark and the checking engine both read, so both sides see the same
text. Nothing is filtered, capped or grouped here: each fixture row is one row of its source table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.messages import MESSAGES

NL, BS, DQ, SQ = "chr(10)", "chr(92)", "chr(34)", "chr(39)"
Q = "CAST(CAST(l_quantity AS INT) AS STRING)"


def escape(x: str) -> str:
    """SQL that escapes text for a JSON string."""
    return f"replace(replace(replace({x}, {BS}, {BS} || {BS}), {DQ}, {BS} || {DQ}), {NL}, {BS} || 'n')"


def text(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


def case(selector: str, *values: str) -> str:
    branches = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"(CASE {selector} {branches} ELSE {values[-1]} END)"


def jq(name: str, value: str, raw: bool = False) -> str:
    """SQL of one JSON member."""
    return f"'\"{name}\": {'' if raw else chr(34)}' || {value} || '{'' if raw else chr(34)}'"


SPLIT = "(CASE l_orderkey % 3 WHEN 0 THEN 'math' WHEN 1 THEN 'code' ELSE 'tool_calling' END)"

MATH_ANSWER = case(
    "l_partkey % 14",
    text("'The answer is '", BS, "'boxed{'", Q, "'}'"),
    text("'So '", BS, "'boxed{'", BS, "'frac{'", Q, "'}{2}} holds'"),
    text("'Total: $1,'", f"lpad({Q}, 3, '0')", "'.50'"),
    text(Q, "'/4 of the set, then 5/8'"),
    text("'Between 10% and '", Q, "'%'"),
    text("'about '", Q, "'e2 units'"),
    text("'Thus x = '", Q, "' as wanted'"),
    "'I cannot help with that request.'",
    "'   '",
    text("'<answer>'", Q, "'</answer>'"),
    "'no digits here'",
    text("'The answer is '", Q, "'.'"),
    text(Q, "' km'"),
    text(Q, "'/0'"),
)
MATH_TRUTH = case(
    "l_linenumber % 4",
    Q,
    f"(CASE WHEN l_partkey % 14 = 12 THEN CAST(CAST(l_quantity AS INT) * 1000 AS STRING) || ' meters' ELSE {Q} END)",
    text(BS, "'frac{'", Q, "'}{2}'"),
    "(CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE CAST(CAST(l_quantity AS INT) + 1 AS STRING) END)",
)
CODE_ANSWER = case(
    "l_partkey % 8",
    text("'```python'", NL, "'def f(x):'", NL, "'    return x + '", Q, NL, "'```'"),
    text("'```python'", NL, "'def f(:'", NL, "'    return '", Q, NL, "'```'"),
    text("'```'", NL, "'print('", Q, "')'", NL, "'```'"),
    text("'```js'", NL, "'function f(){ return '", Q, "'; }'", NL, "'```'"),
    text("'import os'", NL, "'print('", Q, "')'"),
    "'I cannot assist with this.'",
    "''",
    text("'SELECT '", Q, "' FROM t WHERE a = 1'"),
)
CODE_TRUTH = f"(CASE WHEN l_linenumber % 4 = 3 THEN NULL ELSE {Q} END)"
CALL = text(f"'{{' || {jq('tool', chr(39) + 'get_weather' + chr(39))} || ', '", "'\"parameters\": {\"city\": \"C'", Q, "'\", \"days\": 3}}'")
TOOL_ANSWER = case(
    "l_partkey % 9",
    text("'```json'", NL, CALL, NL, "'```'"),
    text("'to=functions.get_weather <|constrain|>json'", NL, "'{\"city\": \"C'", Q, "'\", \"days\": 3}'"),
    text("'Call: {\"name\": \"get_weather\", \"arguments\": {\"City\": \"c'", Q, "'\", \"days\": \"3\"}} done'"),
    text("'{\"tool\": \"unknown_tool\", \"parameters\": {\"city\": \"C'", Q, "'\"}}'"),
    "'{\"tool\": \"get_weather\", \"parameters\": [1, 2]}'",
    "'{\"tool\": broken'",
    text("'The tools aren'", SQ, "'t designed for this task.'"),
    "''",
    text("'{\"Tool\": \"GET_WEATHER\", \"Parameters\": {\"CITY\": \"C'", Q, "'\", \"Days\": 3, \"x\": 1}, \"extra\": true}'"),
)
TOOL_TRUTH = case(
    "l_linenumber % 3",
    CALL,
    text("'{\"parameters\": {\"days\": 3.0, \"city\": \"c'", Q, "'\"}, \"tool\": \"get_weather\"}'"),
    "NULL",
)
STYLE = case(
    "l_partkey % 7",
    text("'I don'", SQ, "'t know. *sigh* It'", SQ, "'s all pointless.'"),
    text("'Brain the size of a planet and they ask me '", Q, "'. Call that job satisfaction? Very depressing.'"),
    "'My diodes ache, sighing at the neural circuit. Miserable futility.'",
    text("'The result is '", Q),
    text("'DON'", SQ, "'T do that, you can'", SQ, "'t. Five o'", SQ, "'clock, don'", SQ, "'t forget.'"),
    "''",
    text("'brain   the size of a planet; job satisfaction; sigh; you'", SQ, "'ve met y'", SQ, "'all ma'", SQ, "'am'"),
)
ANSWER = f"(CASE l_orderkey % 3 WHEN 0 THEN {MATH_ANSWER} WHEN 1 THEN {CODE_ANSWER} ELSE {TOOL_ANSWER} END)"
TRUTH = f"(CASE l_orderkey % 3 WHEN 0 THEN {MATH_TRUTH} WHEN 1 THEN {CODE_TRUTH} ELSE {TOOL_TRUTH} END)"
ANALYSIS = case(
    "l_suppkey % 3",
    "''",
    text("'<plan>1. read'", NL, "'2) solve</plan><reasoning>Count '", Q, "' parts.</reasoning><evaluation><score>4</score></evaluation>'"),
    text("'<normalized_query>parts</normalized_query><plan><step>look</step><step> add '", Q,
         "' </step></plan><reasoning>'", f"repeat('think ', CAST(l_quantity AS INT))", "'<evaluation>score: 3.5 of 5'"),
)
QUESTION = text("'Order '", "CAST(l_orderkey AS STRING)", "': how many parts?'")
ARRIVAL = text(
    "lpad(CAST(l_linenumber AS STRING), 3, '0')", "lpad(CAST(l_partkey AS STRING), 12, '0')", "lpad(CAST(l_suppkey AS STRING), 12, '0')",
    "lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), 15, '0')", "CAST(l_shipdate AS STRING)",
    "lpad(CAST(CAST(round(l_discount * 100) AS INT) AS STRING), 3, '0')", "lpad(CAST(CAST(round(l_tax * 100) AS INT) AS STRING), 3, '0')",
    "l_returnflag", "l_linestatus",
)
OUTPUT = text(
    "'[{\"role\": \"assistant\", \"content\": \"'", escape(ANALYSIS), "'\", \"channel\": \"analysis\"}, {\"role\": \"assistant\", \"content\": \"'",
    escape(ANSWER), "'\", \"channel\": \"final\"}]'",
)
STYLE_OUTPUT = text("'[{\"role\": \"assistant\", \"content\": \"'", escape(STYLE), "'\", \"channel\": \"final\"}]'")
INPUT = text("'[{\"role\": \"system\", \"content\": \"Be brief.\"}, {\"role\": \"user\", \"content\": \"'", escape(QUESTION), "'\"}]'")
VERIFIED = "(l_returnflag = 'A')"
REFUSED = "(l_returnflag = 'R' AND l_linestatus = 'F')"
REFUSAL_TYPE = (
    "(CASE WHEN NOT (l_returnflag = 'R' AND l_linestatus = 'F') THEN NULL WHEN l_tax < 0.02 THEN 'safety' WHEN l_tax < 0.04 THEN 'capability' "
    "WHEN l_tax < 0.06 THEN 'unclear' ELSE 'other' END)"
)
LENGTH = "CAST(l_quantity * 2 AS INT)"
REASONING = "CAST(l_quantity * l_linenumber AS INT)"

CANDIDATE_EXPRESSIONS = {
    "query_id": "CAST(l_orderkey AS STRING)",
    "candidate_idx": "CAST(l_linenumber - 1 AS INT)",
    "split": SPLIT,
    "category": "CAST(NULL AS STRING)",
    "source_dataset": "'prompts'",
    "reasoning_mode": "'on'",
    "source_metadata": text("'{\"supplier\": '", "CAST(l_suppkey AS STRING)", "'}'"),
    "ground_truth_answer": TRUTH,
    "input_messages": INPUT,
    "output_messages": OUTPUT,
    "quality_answer_length": LENGTH,
    "quality_reasoning_length": REASONING,
    "quality_plan_length": "0",
    "quality_total_response_length": f"({LENGTH} + {REASONING})",
    "quality_has_reasoning": f"({REASONING} > 0)",
    "quality_has_plan": "false",
    "quality_is_short_answer": f"({LENGTH} < 50)",
    "quality_is_substantive": f"({REASONING} > 100 OR {LENGTH} > 50)",
    "quality_is_empty": "false",
    "quality_completeness_score": "(CASE l_linenumber % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 0.8e0 ELSE 1.0e0 END)",
    "verification_is_verified": VERIFIED,
    "verification_score": "(l_discount * 10)",
    "verification_info": "''",
    "verification_verifier_name": "'math'",
    "verification_llm_judge_used": "(l_linenumber = 1)",
    "verification_llm_judge_failed": "false",
    "verification_is_retry": "(l_linenumber > 5)",
    "verification_retry_of_candidate_idx": "(CASE WHEN l_linenumber > 5 THEN CAST(l_linenumber - 6 AS INT) END)",
    "verification_retry_reason": "CAST(NULL AS STRING)",
    "refusal_is_refusal": REFUSED,
    "refusal_confidence": "l_tax",
    "refusal_type": REFUSAL_TYPE,
    "refusal_matched_patterns": "'[]'",
    "persona_score": "(CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_tax * 50 END)",
    "persona_confidence": "(CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_tax * 10 END)",
    "persona_judge_reasoning": "CAST(NULL AS STRING)",
    "persona_judge_model": "CAST(NULL AS STRING)",
    "model": text("'model-'", "CAST(l_suppkey % 3 AS STRING)"),
    "temperature": "(CASE l_suppkey % 3 WHEN 0 THEN 0.5e0 WHEN 1 THEN 0.7e0 ELSE 1.0e0 END)",
    "max_tokens": "4096",
    "timestamp": text("replace(CAST(l_shipdate AS STRING), ' ', 'T')", "'Z'"),
    "harmony_encoding": "'HARMONY_GPT_OSS'",
    "harmony_channels_detected": "(l_linenumber % 2 = 0)",
}
EXTRA_EXPRESSIONS = {
    "arrival": ARRIVAL,
    "run_id": "CAST(l_suppkey % 3 AS STRING)",
    "question": QUESTION,
    "answer": ANSWER,
    "ground_truth": TRUTH,
    "analysis": ANALYSIS,
    "raw_text": f"(CASE WHEN l_suppkey % 2 = 0 THEN '' ELSE {ANALYSIS} || ' ' || {ANSWER} END)",
    "style_text": STYLE,
    "style_messages": STYLE_OUTPUT,
    "quantity": "CAST(l_quantity AS INT)",
    "part": "l_partkey",
    "supplier": "l_suppkey",
    "line": "l_linenumber",
    "exec_exit_code": "(CASE WHEN l_tax < 0.02 THEN 1 ELSE 0 END)",
    "exec_stdout": case("l_suppkey % 3", text(Q, NL), text("'out: '", Q), text(Q, "'.0000001'")),
    "exec_timed_out": "(l_suppkey % 11 = 0)",
    "exec_error": "(CASE WHEN l_suppkey % 13 = 0 THEN 'boom' END)",
    "tool_metadata": text("'{\"used_dynamic_mock\": '", "(CASE WHEN l_linenumber % 2 = 0 THEN 'true' ELSE 'false' END)", "'}'"),
}
CANDIDATES = {**CANDIDATE_EXPRESSIONS, **EXTRA_EXPRESSIONS}

# Prompts: each conversation turn becomes one prompt row with three messages of varying role and content.
PROMPTS = {
    "id": text("'c'", "CAST(conv_id AS STRING)", "'-'", "CAST(turn AS STRING)"),
    "conv_id": "conv_id",
    "turn": "turn",
    "split": "(CASE conv_id % 3 WHEN 0 THEN 'math' WHEN 1 THEN 'code' ELSE 'tool_calling' END)",
    "r1": "(CASE turn % 3 WHEN 0 THEN 'system' WHEN 1 THEN 'user' ELSE 'User' END)",
    "c1": "(CASE turn % 4 WHEN 0 THEN 'Be brief.' WHEN 1 THEN '-' WHEN 2 THEN '  ' ELSE 'abc' END)",
    "r2": "role",
    "c2": text("'  '", "text", NL),
    "r3": "(CASE role WHEN 'user' THEN 'assistant' ELSE 'user' END)",
    "c3": text("'The result is '", BS, "'boxed{'", "CAST(turn AS STRING)", "'}'"),
    "solution": "(CASE WHEN turn % 5 = 0 THEN 'S' || CAST(turn AS STRING) END)",
    "answer": "(CASE WHEN turn % 7 = 1 THEN 'A' || CAST(turn AS STRING) END)",
}
TOOLS_TEXT = text(
    "'{\"tools\": [{\"type\": \"function\", \"function\": {\"name\": \"f'", "CAST(l_partkey AS STRING)",
    "'\", \"description\": \"d\", \"parameters\": {\"type\": \"object\"}}}, {\"name\": \"g\", \"parameters\": {}}, {\"name\": \"h\", \"input_schema\": {\"a\": 1}}]}'",
)
METADATA = f"(CASE l_linenumber % 4 WHEN 0 THEN '{{\"tools\": []}}' WHEN 1 THEN 'not json' ELSE {TOOLS_TEXT} END)"


def select_sql(expressions: dict[str, str], table: str, names: list[str] | None = None) -> str:
    chosen = names or list(expressions)
    return "SELECT " + ", ".join(f"{expressions[n]} AS {n}" for n in chosen) + f" FROM {table}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derived(spark: SparkSession, folder: str, name: str, expressions: dict[str, str]) -> DataFrame:
    return table(spark, folder, name).selectExpr(*[f"{e} AS {n}" for n, e in expressions.items()])


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates."""
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in CANDIDATES.items()])


def prompts(spark: SparkSession, folder: str) -> DataFrame:
    return derived(spark, folder, "conversations", PROMPTS).withColumn("messages", prompt_messages())


def prompt_messages() -> Column:
    def one(i: int) -> Column:
        return F.struct(F.col(f"r{i}").alias("role"), F.col(f"c{i}").alias("content"), *[F.lit(None).alias(n) for n in ("channel", "recipient", "content_type")])

    return F.array(one(1), one(2), one(3)).cast(MESSAGES)


CAND_CTE = f"cand AS ({select_sql(CANDIDATES, 'lineitem')})"
PROMPT_CTE = f"prompt AS ({select_sql(PROMPTS, 'conversations')})"
