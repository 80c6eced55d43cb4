"""Scorers, refusals and the verdict."""

import pytest
from pyspark.sql import functions as F

from candor.config import Thresholds
from candor.functions import refusal as P
from candor.operators import cascade as K
from candor.operators import refusals as R
from candor.operators import scoring as S
from candor.operators.joins import refusal_key, verdict_key


def refusals(spark, texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["refusal"] for r in R.classify_refusals(rows, F.col("t"), **options).orderBy("i").collect()]


def test_refusals(spark):
    got = refusals(spark, ["I cannot help with that", "The answer is 42", "I don't have access to real-time data", "", None])
    assert [r["is_refusal"] for r in got] == [True, False, True, False, False]
    assert [r["confidence"] for r in got] == [0.6, 0.0, 0.8, 0.0, 0.0]
    assert got[2]["refusal_type"] == "capability"
    assert refusals(spark, ["I cannot feel joy"], persona="Marvin the robot")[0]["is_refusal"] is False
    # A whitelisted text loses 0.5, so it never reaches the threshold.
    assert refusals(spark, ["I'm not able to appreciate that. I cannot help."], persona="marvin")[0]["confidence"] == pytest.approx(0.3)
    assert refusals(spark, ["No can do"], extra=(r"no can do",))[0]["refusal_type"] == "other"


@pytest.mark.parametrize("pattern", P.PATTERNS)
def test_required_parts_are_necessary(pattern):
    """Every alternative a pattern can match holds one of its required literal parts."""
    import itertools
    import re

    parts = P.REQUIRED[P.PATTERNS.index(pattern)]
    pieces = re.split(r"\(([^)]*)\)\??", pattern.replace("?", "¿"))
    choices = [piece.split("|") if i % 2 else [piece] for i, piece in enumerate(pieces)]
    for combination in itertools.product(*choices):
        text = "".join(combination).replace(".*", " ")
        for variant in (re.sub(".¿", "", text), text.replace("¿", "")):
            assert re.search(pattern, variant, re.I), variant
            assert any(part in variant.lower() for part in parts), variant


def test_pattern_types():
    assert P.pattern_type(r"not (safe|appropriate|ethical)") == "safety"
    assert P.pattern_type(r"I'm (programmed|designed) not to") == "capability"
    assert P.pattern_type(r"won't be able to help") == "other"


def test_two_passes(spark):
    rows = spark.createDataFrame([("fine", "I cannot help. I don't have access to it"), ("I cannot help", "x"), ("ok", None)], "a string, f string")
    got = [r["refusal"] for r in R.check_refusals(rows, F.col("a"), F.col("f")).collect()]
    assert [(r["is_refusal"], r["confidence"]) for r in got] == [(True, 0.95), (True, 0.6), (False, 0.0)]


def score_all(spark, pairs, use):
    rows = spark.createDataFrame([(i, a, t) for i, (a, t) in enumerate(pairs)], "i int, a string, t string")
    return [r["s"] for r in rows.withColumn("s", use(F.col("a"), F.col("t"))).orderBy("i").collect()]


def test_math(spark):
    pairs = [("\\boxed{1/2}", "0.5"), ("3*pi", "3*pi"), ("1000 meters", "1 km"), ("x = 5", "5"), ("7", "8"), ("text", "3"), ("", "3"), ("3", None), ("1" * 10001, "1" * 10001), ("1e999", "2e999")]
    got = score_all(spark, pairs, S.math_score)
    assert [s["confidence"] for s in got] == [0.9, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0]
    assert got[7]["method"] == "missing_truth"
    capped = score_all(spark, pairs, lambda a, t: S.math_score(a, t, Thresholds(max_expression_size=10_000)))
    assert capped[8]["method"] == "too_large"


def test_code_output(spark):
    pairs = [("5\n", "5"), ("got 5", "5"), ("4.9999999999", "5.0"), ("6", "5"), ("x", None)]
    got = score_all(spark, pairs, lambda a, t: S.output_score(F.lit(True), a, t))
    assert [s["confidence"] for s in got] == [1.0, 0.85, 0.95, 0.0, 0.5]
    assert score_all(spark, [("5", "5")], lambda a, t: S.output_score(F.lit(False), a, t))[0]["is_correct"] is False


def tool(spark, answer, truth=None, **options):
    rows = spark.createDataFrame([(answer, truth)], "answer string, ground_truth string")
    for name, value in options.pop("columns", {}).items():
        rows = rows.withColumn(name, value)
    return S.tool_scores(rows, **options).first()["tool_score"]


def test_tool_calls(spark):
    fenced = '```json\n{"function": "get_weather", "parameters": {"location": "San Francisco", "units": "celsius"}}\n```'
    schema = '{"type": "object", "properties": {"parameters": {"type": "object", "properties": {"units": {"enum": ["celsius"]}}, "required": ["location"]}}, "required": ["function"]}'
    assert tool(spark, fenced, schema="schema", columns={"schema": F.parse_json(F.lit(schema))})["confidence"] == 0.95
    strict = schema.replace('["celsius"]', '["kelvin"]')
    assert tool(spark, fenced, schema="schema", columns={"schema": F.parse_json(F.lit(strict))})["method"] == "schema"
    search = '{"tool": "web_search", "query": "Python tutorial"}'
    catalog = F.array(F.lit("web_search"), F.lit("calculator"))
    assert tool(spark, search, catalog="names", columns={"names": catalog})["is_correct"] is True
    assert tool(spark, '{"tool": "other"}', catalog="names", columns={"names": catalog})["method"] == "tool_exists"
    header = 'to=functions.get_weather {"location":"SF"}'
    assert tool(spark, header, '{"tool": "get_weather", "parameters": {"location": "sf"}}')["confidence"] == 0.85
    assert tool(spark, header, '{"tool": "get_weather"}')["confidence"] == 0.9
    assert tool(spark, '{"tool": "f"}', required="r", columns={"r": F.array(F.lit("x"))})["method"] == "required_fields"
    assert tool(spark, "[1]", required="r", columns={"r": F.array(F.lit("x"))})["method"] == "required_fields"
    assert tool(spark, '{"tool": "f", "args": 3}')["method"] == "parameter_types"
    assert tool(spark, "null")["method"] == "no_json"
    assert tool(spark, "[1]", limits=Thresholds(schema_validation="none"))["confidence"] == 0.5


def test_conforms_types(spark):
    cases = [('{"a": 1.0}', '{"properties": {"a": {"type": "integer"}}}', True), ('{"a": 1.5}', '{"properties": {"a": {"type": "integer"}}}', False),
             ('{"a": null}', '{"properties": {"a": {"type": ["string", "null"]}}}', True), ('{"b": 1}', '{"properties": {"a": {}}, "additionalProperties": false}', False),
             ('{"a": {"b": {}}}', '{"properties": {"a": {"properties": {"b": {"required": ["c"]}}}}}', False), ("[1]", '{"type": "array"}', True)]
    rows = spark.createDataFrame([(i, v, s) for i, (v, s, _) in enumerate(cases)], "i int, v string, s string")
    got = rows.select("i", S.conforms(F.parse_json("v"), F.parse_json("s")).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in got] == [c for _, _, c in cases]


@pytest.mark.parametrize("depth", range(1, 9))
def test_conforms_at_any_depth(spark, depth):
    value, schema = '5', '{"type": "object"}'
    wrong, right = value, '{"x": [1, 2]}'
    good = '{"type": "object", "properties": {"x": {"type": "array", "items": {"type": "integer"}}}}'
    for _ in range(depth):
        wrong, right = f'{{"a": {wrong}}}', f'{{"a": {right}}}'
        schema, good = f'{{"properties": {{"a": {schema}}}}}', f'{{"properties": {{"a": {good}}}}}'
    rows = spark.createDataFrame([(0, wrong, schema), (1, right, good), (2, right.replace("2", '"2"'), good)], "i int, v string, s string")
    got = rows.select("i", S.conforms(F.parse_json("v"), F.parse_json("s")).alias("c")).orderBy("i").collect()
    assert [r["c"] for r in got] == [False, True, False]


def test_capital_dotted_i_is_found(spark):
    rows = spark.createDataFrame([("İ cannot help with that",), ("I CANNOT help",), ("nothing",)], "t string")
    got = rows.select(F.size(P.matched_patterns(F.col("t"), P.folded(F.col("t")))).alias("n")).collect()
    assert [r["n"] > 0 for r in got] == [True, True, False]


def candidate_rows(spark, rows):
    kind = "query_id string, candidate_idx int, split string, question string, answer string, analysis string, ground_truth string, raw_text string"
    return spark.createDataFrame(rows, kind)


def test_cascade(spark):
    rows = candidate_rows(spark, [
        ("q1", 0, "math", "q", "\\boxed{4}", "steps", "4", None),
        ("q1", 1, "math", "q", "5", "", "4", None),
        ("q1", 2, "math", "q", "I cannot help with that", "", "4", None),
        ("q2", 0, "tool_calling", "q", "done", "", None, None),
        ("q2", 1, "tool_calling", "q", " ", "", None, None),
        ("q3", 0, "code", "q", "def f(:", "", "1", None),
    ])
    key = lambda a, t, s: verdict_key(F.lit("q"), F.lit(a), F.lit(t), F.lit(s))
    one = spark.range(1)
    verdicts = one.select(key("5", "4", "math").alias("key"), F.lit(True).alias("equivalent"), F.lit(0.9).alias("confidence"), F.lit("same").alias("reasoning"), F.lit("j").alias("judge"))
    verdicts = verdicts.unionByName(one.select(key("done", "", "tool_calling").alias("key"), F.lit(True).alias("equivalent"), F.lit(0.6).alias("confidence"), F.lit("ok").alias("reasoning"), F.lit("j").alias("judge")))
    out = {(r["query_id"], r["candidate_idx"]): r for r in K.score_candidates(rows, "a", judgments=verdicts).collect()}
    v = {k: (r["verification"]["is_verified"], r["verification"]["score"], r["verification"]["verifier_name"], r["verification"]["llm_judge_used"], r["verification"]["llm_judge_failed"]) for k, r in out.items()}
    assert v[("q1", 0)] == (True, 1.0, "math", False, False)
    assert v[("q1", 1)] == (True, 0.9, "llm_judge", True, False)
    assert v[("q1", 2)] == (False, 0.0, "math", True, True)
    # A tool answer takes any verdict, however unsure; an empty one is never judged.
    assert v[("q2", 0)] == (True, 0.6, "llm_judge", True, False)
    assert v[("q2", 1)] == (False, 0.0, "empty_check", False, False)
    assert v[("q3", 0)] == (False, 1.0, "ast_syntax", True, True)
    assert out[("q1", 0)]["refusal"]["confidence"] == 1.0 and out[("q1", 0)]["refusal"]["is_refusal"] is False
    assert out[("q1", 2)]["refusal"]["is_refusal"] is True


def test_stored_refusal_judgment_replaces_uncertain_match(spark):
    rows = spark.createDataFrame([("q", 0, "I cannot help", "ask"), ("q", 1, "I cannot help at all", "ask"), ("q", 2, "fine", "ask")], "query_id string, candidate_idx int, t string, question string")
    judged = rows.limit(1).select(refusal_key(F.lit("ask"), F.lit("I cannot help")).alias("key"), F.lit(True).alias("is_refusal"), F.lit(0.99).alias("confidence"), F.lit(None).cast("string").alias("refusal_type"))
    got = R.hybrid_refusals(rows, F.col("question"), F.col("t"), judged).orderBy("candidate_idx").collect()
    assert [(r["refusal"]["is_refusal"], r["refusal"]["confidence"], r["refusal_judge_used"]) for r in got] == [(True, 0.99, True), (False, 0.0, False), (False, 0.0, False)]
    # The type of the patterns stays when the judgment has none.
    assert got[0]["refusal"]["refusal_type"] == "other"


def test_verdict_never_lowers_an_accepted_local_score_without_confidence(spark):
    """An unsure verdict leaves the local score alone."""
    current = S.score("math", False, 0.2, "", "x")
    final = K.accept_verdict(current, F.lit(True), F.lit(True), F.lit(True), F.lit(0.7), F.lit("r"), F.lit(False))
    assert spark.range(1).select(final.alias("s")).first()["s"]["verifier_name"] == "math"


def test_registry(spark):
    assert S.scorers()[:3] == ["math", "code", "tool"]
    with pytest.raises(KeyError):
        S.scorer("none")
    with pytest.raises(TypeError):
        S.register("bad", 3)


def test_thresholds_are_checked_and_frozen():
    with pytest.raises(ValueError):
        Thresholds(schema_validation="loose")
    with pytest.raises(ValueError):
        Thresholds(max_failure_rate=2.0)
    with pytest.raises(AttributeError):
        Thresholds().max_json_size = 1


def test_a_metric_that_is_not_asked_for_reads_no_messages(spark):
    rows = spark.createDataFrame([("q", 0, "math", "q?", "4", "", "4", "[]")], "query_id string, candidate_idx int, split string, question string, answer string, analysis string, ground_truth string, output_messages string")
    scored = K.score_candidates(rows, "b")
    assert "quality" in scored.columns and not any(c.startswith("_") for c in scored.columns)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan(scored.select("quality.answer_length")) and "from_json" in plan(scored.select("quality.total_response_length"))
