"""How often texts and values are read, next to results at the edges of the cheaper forms."""

from __future__ import annotations

import itertools
import json
import re

import pytest
from paths import FOLDER
from pyspark.sql import functions as F

from candor.functions import code as C
from candor.functions import jsontext as J
from candor.functions import messages as M
from candor.functions.refusal import GATES, PATTERNS, folded
from candor.functions.text import strip_once
from candor.operators import scoring as S
from candor.operators.joins import match_tool_calls
from candor.plans.catalog import QUERIES


def test_a_strict_parse_builds_one_value(spark):
    assert str(J.parse(F.col("x"))).count("try_parse_json") == 1


@pytest.mark.parametrize("text", [
    "1] [2", "1}, {\"b\": 2", "1, \"b\": 2", "1, 2", "{'a': 1}", "{\"a\": 'b'}", "[1] x", "{\"a\": [1]} }", "{\"a\": 1} {}", "[1] [2]", "]", "{\"a\": \"\\sqrt\"}", "", " ",
    "{\"a\": \"]\"}", "{\"a\": \"]}\"}", " [ ] ", "{ }", "{\n\"a\": [1, {\"b\": null}]}", "null", "-1.5", "\"x\"", "[[1]]", "01", "truely",
])
def test_strict_parse_accepts_what_json_accepts(spark, text):
    try:
        wanted = json.dumps(json.loads(text), separators=(",", ":"))
    except ValueError:
        wanted = None
    [row] = spark.createDataFrame([(text,)], "x string").select(F.to_json(J.parse(F.col("x"))).alias("r")).collect()
    assert row.r == wanted


def test_a_comparison_of_results_asks_for_no_schema():
    assert "schema_of_variant" not in str(J.same_result(F.col("a"), F.col("b")))


def test_calls_are_matched_once():
    assert str(match_tool_calls(F.col("a"), F.col("b"))).count("filter(") == 1


def plan(spark, name):
    return QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()


def test_blocks_are_read_without_maps(spark):
    assert "map<string,variant>" not in plan(spark, "p24_block_conversation_messages")


def test_odd_blocks(spark):
    turns = [
        {"role": "user", "content": "q"}, {"role": 5, "content": "lost"}, {"role": "assistant", "content": 7}, 3,
        {"role": "assistant", "content": [{"type": "text", "text": None}, {"type": "text"}, {"type": 1, "text": "no"}, "x", {"type": "text", "text": {"b": 1.0, "a": "k"}}]},
        {"role": "user", "content": [{"type": "tool_result", "tool_use_id": 9, "content": ["r"]}]}, {"role": "user", "content": "none"},
    ]
    df = spark.createDataFrame([(json.dumps(turns),)], "t string").select(M.block_conversation_messages(F.col("t")).alias("m"))
    [row] = df.collect()
    assert [(m.role, m.content, m.channel) for m in row.m] == [
        ("assistant", "", "final"), ("assistant", 'null\n\n{"a":"k","b":1}', "final"), ("tool", '{"tool_use_id":"9","content":"[\\"r\\"]"}', "tool_result"),
    ]


@pytest.mark.parametrize("name", ["v07_schema_conformance", "v06_tool_score_all_stages"])
def test_rows_are_not_shuffled_by_their_schema(spark, name):
    executed = QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in executed and "SortMergeJoin" not in executed



def test_only_texts_with_odd_letters_are_translated():
    assert str(folded(F.col("t"))).count("CASE WHEN") == 1


def test_queries_keep_generated_methods_small_enough_to_compile(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.unset(limit)
        QUERIES["p22_step_messages"].run(spark, FOLDER)
        assert int(spark.conf.get(limit)) <= 8000
        # A limit that the session names itself stays.
        spark.conf.set(limit, "20000")
        QUERIES["p22_step_messages"].run(spark, FOLDER)
        assert spark.conf.get(limit) == "20000"
    finally:
        spark.conf.set(limit, before)


def test_languages_are_counted_in_generated_code(spark):
    assert "transform(" not in str(C.language_of(F.col("x")))


def test_keys_are_made_once(spark):
    """A key that Spark takes for nullable is made a second time, in a filter below the lookup."""
    lines = plan(spark, "v17_v18_all_stages").splitlines()
    assert not [line for line in lines if "Filter" in line and "sha2(" in line]


def test_strip_once_is_strip(spark):
    texts = ["", " ", "a", " a", "a ", "\ta", "a\x1f", "a ", "　a", "é", "é ", "a\x7f", "\x7f", "~", "!", "\x01a", "a\x01", "a\u0085", "😀", "😀 ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip_once(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [None if r.t is None else r.t.strip() for r in rows]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_match_holds_a_gate(pattern):
    pieces = re.split(r"\(([^)]*)\)\??", pattern.replace("?", "¿"))
    for combination in itertools.product(*[piece.split("|") if i % 2 else [piece] for i, piece in enumerate(pieces)]):
        text = "".join(combination).replace(".*", " ")
        for variant in (re.sub(".¿", "", text), text.replace("¿", "")):
            assert re.search(pattern, variant, re.I) and any(gate in variant.lower() for gate in GATES), variant


def test_code_scores_of_a_table(spark):
    answers = ["", " ", None, "no code", "```python\nprint(5)\n```", "```js\nf()\n```", "```\n\n```", "def f(): return 1"]
    cases = [(a, t, o, e) for a in answers for t, o in (("5", "5\n"), ("5", "got 5"), ("5.0", "4.9999999999"), ("6", None), (None, "x"), (" ", "x")) for e in (0, 1, None)]
    df = spark.createDataFrame(cases, "answer string, ground_truth string, exec_stdout string, exec_exit_code int")
    df = df.withColumns({"exec_timed_out": F.lit(None).cast("boolean"), "exec_error": F.lit(None).cast("string")})
    ran = S.succeeded(F.col("exec_exit_code"), F.col("exec_timed_out"), F.col("exec_error"))
    both = S.code_scores(df).withColumn("plain", S.code_score(F.col("answer"), F.col("ground_truth"), ran, F.col("exec_stdout")))
    assert both.where(~F.col("code_score").eqNullSafe(F.col("plain"))).count() == 0


def test_flags_are_gathered_in_generated_code(spark):
    """What stands inside a lambda gets no generated code, and `array_compact` is one around all its flags."""
    text = F.col("x")
    assert "array_compact" not in str(C.javascript_syntax(text))
    [row] = spark.createDataFrame([(None,)], "x string").select(C.javascript_syntax(text).alias("s")).collect()
    assert (row.s.is_valid, row.s.confidence, row.s.issues, row.s.patterns) == (None, 0.8, None, 0)
