"""Rows of paths and what is decided with them, against plain walks over nested values."""

import json
import random

import plain_json
import pytest
from pyspark.sql import functions as F

from candor.functions import jsonpaths as P
from candor.functions import jsontext as J
from candor.operators import scoring as S

KEYS = ["a", "A", "a_b", "ab", "B", "items", "properties", "type", 'q"', "n\n", "c\x01"]
LEAVES = [1, 1.0, 0, -0.0, 2, 1.5, True, False, None, "x", "X", "yes", "no", "1", "1.0", " 1\n", "0", "TRUE", "nan", "1e3", 1000, "inf", "Infinity", "é", "É", 'a"b', "\\n", ""]


def value(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        return {rng.choice(KEYS): value(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if depth and kind < 0.5:
        return [value(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return rng.choice(LEAVES)


def changed(rng, x):
    if rng.random() < 0.15:
        return value(rng, 2)
    if isinstance(x, dict):
        return {(rng.choice([k.upper(), k + "_", k]) if rng.random() < 0.3 else k): changed(rng, v) for k, v in x.items() if rng.random() > 0.1}
    if isinstance(x, list):
        return [changed(rng, v) for v in x]
    return x.upper() if isinstance(x, str) and rng.random() < 0.3 else x


def schema(rng, depth):
    if rng.random() < 0.05:
        return rng.choice([True, 5, "x"])
    out = {}
    if rng.random() < 0.5:
        out["type"] = rng.choice([*P.KINDS, ["object", "null"], ["string", "integer"], [], 3])
    if rng.random() < 0.2:
        out["enum"] = [value(rng, 1) for _ in range(rng.randint(0, 4))]
    if depth and rng.random() < 0.6:
        out["properties"] = {rng.choice(KEYS): schema(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if rng.random() < 0.3:
        out["required"] = rng.choice([[rng.choice(KEYS)], [], [3], "a"])
    if rng.random() < 0.3:
        out["additionalProperties"] = rng.choice([False, True, {}])
    if depth and rng.random() < 0.4:
        out["items"] = rng.choice([schema(rng, depth - 1), [{"type": "string"}]])
    return out


def test_decisions_equal_plain_walks(spark):
    rng, rows = random.Random(7), []
    for i in range(1500):
        x = {k: value(rng, 2) for k in rng.sample(KEYS, 3)} if i % 3 == 0 else value(rng, 6 if i % 5 == 0 else 3)
        rows.append((i, json.dumps(x), json.dumps(changed(rng, x)), json.dumps(schema(rng, 3))))
    parsed = spark.createDataFrame(rows, "i int, a string, b string, s string").select(*[J.parse(F.col(c)).alias(c) for c in "abs"])
    a, b, s = F.col("a"), F.col("b"), F.col("s")
    found = parsed.select(*[F.to_json(c).alias(c) for c in "abs"], J.covers_fuzzily(a, b).alias("covers"), J.same_result(a, b).alias("same"), S.conforms(a, s).alias("conforms")).collect()
    held = {"covers": 0, "same": 0, "conforms": 0}
    for row in found:
        x, y, rules = (json.loads(row[c]) for c in "abs")
        objects = isinstance(x, dict) and isinstance(y, dict)
        want = {"covers": objects and plain_json.covers(x, y), "same": plain_json.same_result(x, y), "conforms": plain_json.conforms(x, rules)}
        assert {k: row[k] for k in want} == want, row
        held = {k: n + want[k] for k, n in held.items()}
    assert len(found) == 1500 and all(200 < n < 1300 for n in held.values())


def test_casts_and_the_fold_give_the_same_rows(spark):
    rng = random.Random(3)
    texts = [json.dumps(value(rng, 3)) for _ in range(300)] + ["{}", "[]", "7", '"x"', "null", '{"a":[[],{}]}']
    parsed = spark.createDataFrame([(t,) for t in texts], "t string").select(J.parse(F.col("t")).alias("v"))
    tokens = F.regexp_extract_all(F.to_json("v"), F.lit(P._TOKEN), F.lit(0))
    for row in parsed.select(P.document(F.col("v")).alias("d"), P._folded(tokens).alias("f")).collect():
        assert sorted(row.d) == sorted(row.f)


def test_documents_of_null_and_of_long_values(spark):
    big = json.dumps({f"k{i}": [i, {"x": "y" * 10}] for i in range(20_000)})
    deep = "[" * 500 + "]" * 500
    rows = spark.createDataFrame([(1, None), (2, big), (3, deep)], "i int, t string")
    sizes = rows.select("i", F.size(P.document(J.parse(F.col("t")))).alias("n")).orderBy("i").collect()
    assert [r.n for r in sizes] == [None, 80_001, 500]


def test_no_python_worker_in_the_tool_scores(spark):
    rows = spark.createDataFrame([("{}", "{}", "{}")], "answer string, ground_truth string, s string").withColumn("schema", F.parse_json("s"))
    plan = S.tool_scores(rows, schema="schema")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "answer, method",
    [
        ('{"name": "get", "arguments": {"n": 1, "b": {"c": [1]}}}', "schema"), ('{"name": "get", "arguments": {"n": "1"}}', "schema"), ('{"name": "get"}', "schema"),
        ('{"name": "put", "arguments": 3}', "openapi"), ('{"name": "other"}', "operation"), ('{"x": 1}', "no_tool"), ("hello", "no_json"), ("", "missing_answer"), (None, "missing_answer"),
    ],
)
def test_operations_of_a_description(spark, answer, method):
    description = {
        "paths": {"/a": {"get": {"operationId": "get"}, "post": {"operationId": "put"}}, "/b": {"get": {"operationId": "get", "requestBody": {"content": {"application/json": {"schema": {"$ref": "#/components/schemas/A"}}}}}}},
        "components": {"schemas": {"A": {"properties": {"n": {"type": "integer"}, "b": {"$ref": "#/components/schemas/B"}}, "required": ["n"]}, "B": {"properties": {"c": {"items": {"$ref": "#/components/schemas/B"}, "type": "array"}}}}},
    }
    described = spark.createDataFrame([(1, json.dumps(description))], "api int, d string").select("api", F.parse_json("d").alias("description"))
    rows = spark.createDataFrame([(1, answer)], "api int, answer string")
    found = S.api_scores(rows, S.api_operations(described, "api"), "api").first().api_score
    assert found.method == method
    # B holds itself; 1 is no object, so its rules don't apply to it.
    assert found.is_correct == (method == "openapi" or answer is not None and '"n": 1' in answer)


PLAIN_KEYS = ["a", "A", "a_b", "ab", "a-b", "B", "city", "Days", "_", "", ":c", "d,", "{", "e"]
PLAIN_LEAVES = [1, 1.0, 0, -0.0, -5, 1e-7, 1.5e300, True, False, None, "x", "X_y", "yes", "no", "1", "1.0", " 1 ", "5.", "-5", "off", "TRUE", "nan", "+inf", "inf", "a:b", "{", "}", ",", "", "a_b-c", "é", "[", 'q"']


def plain_value(rng, depth):
    if depth and rng.random() < 0.4:
        return {k: plain_value(rng, depth - 1) for k in rng.sample(PLAIN_KEYS, rng.randint(0, 3))}
    return rng.choice(PLAIN_LEAVES[:24] if rng.random() < 0.9 else PLAIN_LEAVES)


def test_staged_comparison_equals_the_comparison_of_documents(spark):
    rng, rows = random.Random(11), []
    near = lambda x: {(rng.choice([k.upper(), k + "_", k]) if rng.random() < 0.3 else k): near(v) for k, v in x.items() if rng.random() > 0.1} if isinstance(x, dict) else (
        rng.choice(PLAIN_LEAVES[:24]) if rng.random() < 0.15 else x.upper() if isinstance(x, str) and rng.random() < 0.3 else x
    )
    for i in range(3000):
        x = {k: plain_value(rng, 2) for k in rng.sample(PLAIN_KEYS, rng.randint(0, 4))}
        rows.append((i, json.dumps(x), json.dumps(near(x)) if i % 50 else rng.choice(["[1]", "not json", "", "3"])))
    texts = spark.createDataFrame(rows, "i int, x string, truth string").select("i", "truth", J.parse(F.col("x")).alias("data"))
    texts = texts.withColumn("fields", J.as_object(F.col("data")))
    whole, part = F.to_json("data"), J.canonical(J.parse(F.col("truth")))
    lows = [P.plain_text(P.simple_text(text)) for text in (whole, part)]
    quick = P.plain_covers(*[P.plain_rows(low) for low in lows])
    clear = F.lit(True)
    for low in lows:
        clear = clear & (F.size(F.array_distinct(P.plain_keys(low))) == F.size(P.plain_keys(low)))
    found = S.truth_scores(texts, "data", "fields", "truth", "staged").select(
        "*", S.truth_comparison(F.col("data"), J.parse(F.col("truth"))).alias("plain"), F.when(clear, quick).alias("quick"), J.covers_fuzzily(F.col("data"), J.parse(F.col("truth"))).alias("covers")
    ).collect()
    methods = {}
    for row in found:
        assert row.staged == row.plain, row
        assert row.quick is None or row.quick == row.covers, row
        methods[row.plain.method] = methods.get(row.plain.method, 0) + 1
    assert min(methods[m] for m in ("ground_truth_exact", "ground_truth_lenient", "ground_truth_fuzzy", "ground_truth")) > 100
    assert sum(row.quick is not None for row in found) > 1000


def test_a_table_of_calls_reads_what_one_call_reads(spark):
    answers = [
        None, "", "hello", "to=functions.get {\"a\": 1}", "to=get", "to=a.b.c {broken} {", "to= {\"a\": 1}", "<commentary>{\"b\": 2}</commentary> {\"c\": 3}", "```json\n{\"d\": [1.0]}\n```", "null", "[1, 2] x",
        "x {\"a\": 1} y", "{\"a\": 1}}", "3", "TO=x {\"a\": 1}", "to=é.f {\"to\": \"x\"}",
    ]
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, answer string")
    for row in S.calls_in(rows, "answer", "call").select("answer", F.to_json("call").alias("staged"), F.to_json(S.call_in(F.col("answer"))).alias("plain")).collect():
        assert row.staged == row.plain, row


def test_short_plain_texts_meet_what_documents_meet(spark):
    rng = random.Random(5)
    named = lambda depth: {"type": "object", "properties": {k: named(depth - 1) if depth and rng.random() < 0.4 else schema(rng, 1) for k in rng.sample(PLAIN_KEYS, 4)}, **rng.choice([
        {}, {"required": rng.sample(PLAIN_KEYS, 2)}, {"additionalProperties": False}, {"enum": [{}, 1, "x"]}])}
    rows = [(json.dumps({k: plain_value(rng, 2) for k in rng.sample(PLAIN_KEYS, rng.randint(0, 4))}), json.dumps(named(2) if rng.random() < 0.7 else schema(rng, 2))) for _ in range(2000)]
    parsed = spark.createDataFrame(rows, "x string, s string").select("*", J.parse(F.col("x")).alias("v"), P.constraints(J.parse(F.col("s"))).alias("rules"))
    text = P.simple_text(F.to_json("v"))
    found = parsed.select("x", "s", P.meets_plainly(P.plain_rows(text), F.col("rules")).alias("plain"), P.meets(P.document(F.col("v")), F.col("rules")).alias("whole")).collect()
    assert all(row.plain is None or row.plain == row.whole for row in found), [row for row in found if row.plain not in (None, row.whole)][:3]
    assert sum(row.plain is True for row in found) > 100 and sum(row.plain is False for row in found) > 100
