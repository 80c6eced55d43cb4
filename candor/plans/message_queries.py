"""Messages, prompts, conversations and the flat layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions import jsontext as J
from candor.functions import messages as M
from candor.functions.text import plan_steps, tag_body
from candor.operators import selection as S
from candor.plans.fixtures import CAND_CTE, CANDIDATES, METADATA, NL, PROMPT_CTE, Q, candidates, case, prompts, derived, select_sql, table, text
from candor.plans.registry import query
from candor.plans.text_queries import KEY, boxed_sql, strip_sql, tag_sql
from candor.schema import FLAT_COLUMNS, flatten, unflatten

P = f"WITH {PROMPT_CTE} "
W = f"WITH {CAND_CTE} "
TURN = ["conv_id", "turn"]


def usable(i: int) -> str:
    body = strip_sql(f"c{i}")
    return f"WHEN lower(r{i}) = 'user' AND {body} <> '' AND {body} <> '-' AND length({body}) >= 5 THEN {body}"


@query("p01_p11_usable_question", P + f"SELECT conv_id, turn, CASE {usable(1)} {usable(2)} {usable(3)} END AS question FROM prompt")
def p01(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.usable_question(F.col("messages"), 5).alias("question"))


FIRST_USER = "CASE WHEN r1 = 'user' THEN c1 WHEN r2 = 'user' THEN c2 WHEN r3 = 'user' THEN c3 END"


@query("p02_first_user_question", P + f"SELECT conv_id, turn, CASE WHEN q NOT IN ('', '-') THEN q END AS question FROM (SELECT *, {strip_sql(FIRST_USER)} AS q FROM prompt)")
def p02(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.first_user_question(F.col("messages")).alias("question"))


@query("p03_first_user_text", P + f"SELECT conv_id, turn, {strip_sql(FIRST_USER)} AS question FROM prompt")
def p03(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.first_user_text(F.col("messages")).alias("question"))


@query("p04_stored_question", W + "SELECT query_id, arrival, CASE WHEN line % 2 = 0 THEN question ELSE '' END AS question FROM cand")
def p04(spark: SparkSession, folder: str) -> DataFrame:
    stored = F.when(F.col("line") % 2 == 0, F.col("input_messages")).otherwise(F.concat(F.lit("broken "), F.col("input_messages")))
    return candidates(spark, folder).select(*KEY, M.stored_question(stored).alias("question"))


@query("p05_question_of", P + f"SELECT conv_id, turn, coalesce({FIRST_USER}, '') AS question FROM prompt")
def p05(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.question_of(F.col("messages")).alias("question"))


ASSISTANT = "CASE WHEN r1 = 'assistant' AND c1 <> '' THEN c1 WHEN r2 = 'assistant' AND c2 <> '' THEN c2 WHEN r3 = 'assistant' AND c3 <> '' THEN c3 END"
ASSISTANT_TRUTH = boxed_sql("a", f"(SELECT *, {ASSISTANT} AS a FROM prompt)")


@query("p06_ground_truth", P + f"SELECT conv_id, turn, coalesce(solution, answer, nullif(boxed, ''), a) AS truth FROM ({ASSISTANT_TRUTH})")
def p06(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.ground_truth(F.col("messages"), F.col("solution"), F.col("answer")).alias("truth"))


@query("p07_assistant_truth", P + f"SELECT conv_id, turn, coalesce(nullif(boxed, ''), a) AS truth FROM ({ASSISTANT_TRUTH})")
def p07(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.assistant_truth(F.col("messages")).alias("truth"))


@query(
    "p08_query_id",
    P + "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN id WHEN turn % 3 = 1 THEN 'u' || turn ELSE split || '_' || sha256(c2) END AS query_id FROM prompt",
)
def p08(spark: SparkSession, folder: str) -> DataFrame:
    rows = prompts(spark, folder).withColumns({
        "uuid": F.when(F.col("turn") % 3 == 0, F.col("id")).otherwise(F.lit("")), "uid": F.when(F.col("turn") % 3 == 1, F.concat(F.lit("u"), F.col("turn"))),
    })
    return rows.select(*TURN, S.query_id(F.col("c2"), F.col("split"), F.col("uuid"), F.col("uid")).alias("query_id"))




@query("p15_record_answer", W + f"SELECT query_id, arrival, CASE WHEN {tag_sql('answer', 'answer')} <> '' THEN {tag_sql('answer', 'answer')} ELSE answer END AS record_answer FROM cand")
def p15(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, M.record_answer(M.from_json_text(F.col("output_messages"))).alias("record_answer"))


TAGS = ("reasoning", "plan", "evaluation", "normalized_query")


@query("p16_analysis_tags", W + "SELECT query_id, arrival, " + ", ".join(f"{tag_sql('analysis', t)} AS {t}" for t in TAGS) + " FROM cand")
def p16(spark: SparkSession, folder: str) -> DataFrame:
    rows = candidates(spark, folder).withColumn("messages", M.from_json_text(F.col("output_messages")))
    return rows.select(*KEY, *[M.analysis_tag(F.col("messages"), t).alias(t) for t in TAGS])


@query(
    "p17_answer_text",
    W + f"SELECT query_id, arrival, CASE WHEN line % 2 = 0 THEN answer ELSE coalesce(nullif({tag_sql('answer', 'answer')}, ''), answer) END AS scored FROM cand",
)
def p17(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, M.answer_text(F.col("answer"), F.col("line") % 2 == 0).alias("scored"))


@query("p18_full_text", W + "SELECT query_id, arrival, analysis || chr(10) || answer AS response FROM cand")
def p18(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, M.full_text(M.from_json_text(F.col("output_messages"))).alias("response"))


@query("p19_final_text", W + "SELECT query_id, arrival, answer AS final_text FROM cand")
def p19(spark: SparkSession, folder: str) -> DataFrame:
    return candidates(spark, folder).select(*KEY, M.final_text(M.from_json_text(F.col("output_messages"))).alias("final_text"))


TEMPLATES = {"code": "Write fast code for:\n{question}\nUse {{braces}}."}
DEFAULT_TEMPLATE = "Solve this problem:\n\n{question}\n\nPut the result in \\boxed{{result}}."


@query(
    "p20_prompts",
    P + """SELECT conv_id, turn, CASE split WHEN 'code' THEN 'Write fast code for:' || chr(10) || c2 || chr(10) || 'Use {braces}.'
    ELSE 'Solve this problem:' || chr(10) || chr(10) || c2 || chr(10) || chr(10) || 'Put the result in \\boxed{result}.' END AS prompt FROM prompt""",
)
def p20(spark: SparkSession, folder: str) -> DataFrame:
    return prompts(spark, folder).select(*TURN, M.prompt_for(F.col("split"), F.col("c2"), TEMPLATES, DEFAULT_TEMPLATE).alias("prompt"))


@query(
    "p21_input_messages",
    P + """SELECT conv_id, turn, CASE WHEN c1 <> '' THEN 'system,developer,user' ELSE 'system,user' END AS roles,
    'You are a helpful assistant.|' || CASE WHEN c1 <> '' THEN c1 || '|' ELSE '' END || c2 AS contents FROM prompt""",
)
def p21(spark: SparkSession, folder: str) -> DataFrame:
    rows = prompts(spark, folder).withColumn("messages", M.input_messages(F.col("c2"), F.col("c1"), developer=True))
    roles = F.array_join(F.transform("messages", lambda m: m["role"]), ",")
    return rows.select(*TURN, roles.alias("roles"), F.array_join(F.transform("messages", lambda m: m["content"]), "|").alias("contents"))


def steps_of(df: DataFrame) -> DataFrame:
    """Reasoning steps from the plan of each candidate."""
    found = plan_steps(tag_body(F.col("analysis"), "plan"))
    return df.withColumn("steps", F.transform(found, lambda s, i: F.struct(s.alias("explanation"), F.concat(F.lit("out "), i.cast("string")).alias("output"))))


# SQL: the plan has either <step> items or lines; both fixtures give two steps or none.
STEP_ITEMS = f"""SELECT *, CASE WHEN p = '' THEN [] WHEN contains(p, '<step>') THEN list_transform(regexp_extract_all(p, '(?is)<step>(.*?)</step>', 1), lambda e: trim(e))
  ELSE str_split(p, chr(10)) END AS items FROM (SELECT *, {tag_sql('analysis', 'plan')} AS p FROM cand)"""


@query(
    "p22_step_messages",
    W + f"""SELECT query_id, arrival, len(items) + CASE WHEN answer <> '' THEN 1 ELSE 0 END AS messages,
    array_to_string(list_transform(items, lambda e, i: 'reasoning:' || i || ':' || e || ':out ' || (i - 1)), ';') AS reasoning,
    CASE WHEN answer <> '' THEN answer ELSE '' END AS final FROM ({STEP_ITEMS})""",
)
def p22(spark: SparkSession, folder: str) -> DataFrame:
    rows = steps_of(candidates(spark, folder)).withColumn("messages", M.step_messages(F.col("steps"), F.col("answer")))
    reasoning = F.filter("messages", lambda m: m["channel"] == "reasoning")
    lines = F.transform(
        reasoning,
        lambda m: F.concat_ws(":", m["channel"], F.get_json_object(m["content"], "$.step"), F.get_json_object(m["content"], "$.explanation"), F.get_json_object(m["content"], "$.output")),
    )
    return rows.select(*KEY, F.size("messages").cast("long").alias("messages"), F.array_join(lines, ";").alias("reasoning"), M.final_text(F.col("messages")).alias("final"))


@query(
    "p23_steps_text",
    W + f"""SELECT query_id, arrival, array_to_string(list_transform(items, lambda e, i: 'Step ' || i || ': ' || e || chr(10) || 'out ' || (i - 1)), chr(10) || chr(10)) AS analysis_text,
    len(items) AS steps FROM ({STEP_ITEMS})""",
)
def p23(spark: SparkSession, folder: str) -> DataFrame:
    rows = steps_of(candidates(spark, folder)).withColumn("json", M.steps_json(F.col("steps")))
    count = F.size(F.from_json(F.get_json_object("json", "$.steps"), "array<struct<explanation:string>>"))
    return rows.select(*KEY, M.steps_text(F.col("steps")).alias("analysis_text"), count.cast("long").alias("steps"))


def with_turns(df: DataFrame) -> DataFrame:
    """Tool conversation of each candidate: prompt, one or two calls, their result, an answer."""
    nothing = F.lit(None).cast("string")

    def turn(role: str, content, calls=None, name=None):
        return F.struct(
            F.lit(role).alias("role"), content.alias("content"), F.lit("id1" if name is not None else None).alias("tool_call_id"),
            (nothing if name is None else name).alias("name"), (F.lit(None) if calls is None else calls).cast("array<struct<id:string,name:string,arguments:string>>").alias("tool_calls"),
        )

    tool = F.concat(F.lit("tool_"), (F.col("part") % 5).cast("string"))
    call = F.struct(F.lit("id1").alias("id"), tool.alias("name"), F.when(F.col("line") % 3 == 0, F.lit("{bad")).otherwise(F.lit('{"n": 1}')).alias("arguments"))
    second = F.struct(F.lit("id2").alias("id"), F.lit("tool_0").alias("name"), F.lit('{"n": 2}').alias("arguments"))
    calls = F.when(F.col("line") % 2 == 0, F.array(call, second)).otherwise(F.array(call))
    turns = F.array(turn("user", F.col("question")), turn("assistant", F.lit("thinking"), calls), turn("tool", F.col("exec_stdout"), None, tool), turn("assistant", F.col("answer")))
    return df.withColumn("turns", turns.cast(M.TURNS)).withColumn("tool_calls", calls)


@query(
    "p24_conversation_messages",
    W + "SELECT query_id, arrival, 'tools,tool_call,tool_result,final' AS channels, CASE WHEN line % 2 = 0 THEN 2 ELSE 1 END AS calls, exec_stdout AS result, answer AS final FROM cand",
)
def p24(spark: SparkSession, folder: str) -> DataFrame:
    rows = with_turns(candidates(spark, folder)).withColumn("messages", M.conversation_messages(F.col("turns"), F.lit('[{"name": "tool_0"}]')))
    content = lambda i: F.col("messages")[i]["content"]
    calls = F.size(F.from_json(F.get_json_object(content(1), "$.tool_calls"), "array<struct<name:string>>"))
    return rows.select(
        *KEY, F.array_join(F.transform("messages", lambda m: m["channel"]), ",").alias("channels"), calls.alias("calls"),
        F.get_json_object(content(2), "$.result").alias("result"), M.final_text(F.col("messages")).alias("final"),
    )


BLOCKS = text(
    "'[{\"role\": \"user\", \"content\": \"q\"}, {\"role\": \"assistant\", \"content\": [{\"type\": \"text\", \"text\": \"hm '", Q,
    "'\"}, {\"type\": \"tool_use\", \"id\": \"t1\", \"name\": \"f\", \"input\": {\"n\": '", Q, "'}}]}, {\"role\": \"user\", \"content\": [{\"type\": \"tool_result\", \"tool_use_id\": \"t1\", \"content\": \"r '",
    Q, "'\"}]}, {\"role\": \"assistant\", \"content\": '", case("l_linenumber % 2", text("'\"done '", Q, "'\"'"), text("'[{\"type\": \"text\", \"text\": \"done '", Q, "'\"}]'")), "'}]'",
)
BLOCK_ROWS = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "quantity": "CAST(l_quantity AS INT)", "turns": BLOCKS}


@query(
    "p24_block_conversation_messages",
    f"SELECT query_id, arrival, 'tool_call,tool_result,final' AS channels, 'hm ' || quantity AS thinking, CAST(quantity AS STRING) AS argument, 'r ' || quantity AS result, 'done ' || quantity AS final FROM ({select_sql(BLOCK_ROWS, 'lineitem')})",
)
def p24_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "lineitem", BLOCK_ROWS)
    rows = rows.withColumn("messages", M.block_conversation_messages(F.col("turns")))
    content = lambda i: F.col("messages")[i]["content"]
    return rows.select(
        *KEY, F.array_join(F.transform("messages", lambda m: m["channel"]), ",").alias("channels"), F.get_json_object(content(0), "$.thinking").alias("thinking"),
        F.get_json_object(content(0), "$.tool_calls[0].input.n").alias("argument"), F.get_json_object(content(1), "$.content").alias("result"), M.final_text(F.col("messages")).alias("final"),
    )


TOOL_ROWS = {"query_id": CANDIDATES["query_id"], "arrival": CANDIDATES["arrival"], "metadata": METADATA}


@query(
    "p25_tools_in",
    f"""SELECT query_id, arrival, CASE WHEN ok THEN 'f' || regexp_extract(metadata, '"f(\\d+)"', 1) || ',g,h' END AS names, CASE WHEN ok THEN 'd,,' END AS descriptions,
    CASE WHEN ok THEN '{{"type":"object"}};{{}};{{"a":1}}' END AS parameters
    FROM (SELECT *, CASE WHEN json_valid(metadata) THEN json_array_length(metadata, '$.tools') > 0 ELSE false END AS ok FROM ({select_sql(TOOL_ROWS, 'lineitem')}))""",
)
def p25(spark: SparkSession, folder: str) -> DataFrame:
    rows = derived(spark, folder, "lineitem", TOOL_ROWS)
    found = rows.withColumn("tools", M.tools_in(F.col("metadata")))
    return found.select(
        *KEY, F.array_join(F.transform("tools", lambda t: t["name"]), ",").alias("names"), F.array_join(F.transform("tools", lambda t: t["description"]), ",").alias("descriptions"),
        F.array_join(F.transform("tools", lambda t: J.canonical(t["parameters"])), ";").alias("parameters"),
    )


@query("p31_conversation", W + "SELECT query_id, arrival, 'system,user,assistant,assistant' AS roles, length('Be brief.') + length(question) + length(analysis) + length(answer) AS characters FROM cand")
def p31(spark: SparkSession, folder: str) -> DataFrame:
    whole = M.conversation(M.from_json_text(F.col("input_messages")), M.from_json_text(F.col("output_messages")))
    rows = candidates(spark, folder).withColumn("messages", whole)
    return rows.select(*KEY, F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), M.total_length(F.col("messages")).cast("long").alias("characters"))


SCALARS = [n for n in FLAT_COLUMNS if not n.endswith("_messages")]


@query("s11_s12_flat_round_trip", W + "SELECT " + ", ".join(SCALARS) + ", question AS input_question, answer AS output_final FROM cand")
def s11(spark: SparkSession, folder: str) -> DataFrame:
    flat = flatten(unflatten(candidates(spark, folder)))
    question = M.stored_question(F.col("input_messages"))
    return flat.select(*SCALARS, question.alias("input_question"), M.final_text(M.from_json_text(F.col("output_messages"))).alias("output_final"))


@query("p27_scorer_route", """SELECT source || '/' || lang AS name, CASE WHEN regexp_matches(lower(source || '/' || lang), 'math|gsm|aime|amc|algebra') THEN 'math' WHEN regexp_matches(lower(source || '/' || lang), 'code|python|humaneval|mbpp|codex') THEN 'code'
    WHEN regexp_matches(lower(source || '/' || lang), 'tool|api|function') THEN 'tool' ELSE 'math' END AS route, count(*) AS documents FROM documents GROUP BY 1, 2
    UNION ALL SELECT split, CASE split WHEN 'math' THEN 'math' WHEN 'code' THEN 'code' ELSE 'tool' END, count(*) FROM (SELECT CASE l_orderkey % 3 WHEN 0 THEN 'math' WHEN 1 THEN 'code' ELSE 'tool_calling' END AS split FROM lineitem) GROUP BY 1, 2""")
def p27(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select(F.concat_ws("/", "source", "lang").alias("name"))
    names = names.unionByName(candidates(spark, folder).select(F.col("split").alias("name")))
    return names.groupBy("name", S.scorer_for(F.col("name")).alias("route")).agg(F.count("*").alias("documents"))


