"""Layouts, joins, numbering, work lists, merging, reports, files and streams."""

import glob
import math
import os

import pytest
from pyspark.sql import functions as F

from candor import schema as L
from candor.functions import messages as M
from candor.operators import joins as J
from candor.operators import regeneration as G
from candor.operators import reports as R
from candor.operators import scoring as S
from candor.operators import selection as P
from candor.operators import style_reports as A
from candor.operators.numbering import number_rows, slice_per_group
from candor.session import scratch_path
from candor.sources import candidates as C
from candor.sources import runs as U
from candor.streaming import incremental as T


def table(spark, kind, rows):
    return spark.createDataFrame(rows, kind)


def values(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


# --- layouts ---


def test_flat_layout_has_43_columns():
    assert len(L.FLAT_COLUMNS) == 43


def test_flatten_undoes_unflatten(spark):
    from candor.plans.fixtures import candidates

    flat = candidates(spark, "/root/testdata/sf0.001").select(*L.FLAT_COLUMNS)
    messages = ["input_messages", "output_messages"]
    parsed = lambda df: df.withColumns({m: F.from_json(m, M.MESSAGES) for m in messages})
    again = L.flatten(L.unflatten(flat))
    assert again.columns == list(L.FLAT_COLUMNS)
    assert parsed(flat).exceptAll(parsed(again).select(*flat.columns)).count() == 0


def test_unflatten_keeps_persona_names(spark):
    row = table(spark, "query_id string, persona_score double, persona_confidence double, ground_truth_answer string", [("q", 4.0, 0.8, "t")])
    out = L.unflatten(row).first()
    assert (out["persona"]["persona_score"], out["persona"]["persona_confidence"], out["ground_truth_answer"]) == (4.0, 0.8, "t")


def test_normalize_older_layout(spark):
    old = table(
        spark, "query_id string, question string, is_correct boolean, ground_truth string, candidate_index int, analysis string, final_answer string",
        [("q", "How many?", True, "4", 2, "think", "four")],
    )
    row = L.normalize_schema(old).first()
    assert (row["candidate_idx"], row["verification_is_verified"], row["ground_truth_answer"]) == (2, True, "4")
    new = L.normalize_schema(old).select(M.stored_question(F.col("input_messages")), M.final_text(M.from_json_text(F.col("output_messages")))).first()
    assert tuple(new) == ("How many?", "four")


# --- messages ---


def test_questions(spark):
    cases = [[("user", "Hello")], [("user", "")], [("user", "-")], [("User", "-"), ("USER", " long enough ")], [("assistant", "x")], None]
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, m array<struct<role:string,content:string>>")
    got = rows.select("i", M.first_user_question(F.col("m")).alias("a"), M.usable_question(F.col("m")).alias("b")).orderBy("i").collect()
    assert [r["a"] for r in got] == ["Hello", None, None, None, None, None]
    assert [r["b"] for r in got] == ["Hello", None, None, "long enough", None, None]


def test_bad_stored_messages_give_no_question(spark):
    rows = table(spark, "t string", [("nope",), (None,), ('[{"role": "user", "content": "hi"}]',)])
    assert values(rows, M.stored_question(F.col("t"))) == [("",), ("",), ("hi",)]


def test_stored_message_text_is_parsed_before_style_counts(spark):
    row = table(spark, "output_messages string", [('[{"role": "assistant", "channel": "final", "content": "I don\'t. *sigh*"}]',)])
    marked = A.with_markers(row, A.response_text(row))
    assert marked.first()["count_sigh"] == 1
    assert A.with_contractions(row, A.answer_only(row)).first()["contractions"] == ["don't"]


# --- filters ---


def test_filter_rows_in_all_layouts(spark):
    flat = table(spark, "split string, verification_is_verified boolean", [("a", True), ("a", False), ("a", None), ("b", False)])
    assert P.filter_rows(flat, "a", True).count() == 1
    old = table(spark, "is_correct boolean", [(True,), (False,)])
    assert P.filter_rows(old, "a", True).count() == 1
    nested = table(spark, "verification_result struct<is_correct:boolean>", [((True,),), ((False,),), ((None,),), (None,)])
    assert P.filter_rows(nested, None, True).count() == 2
    assert P.filter_rows(table(spark, "x int", [(1,)]), "a", True).count() == 1


def test_routes(spark):
    names = ["math_500", "GSM8K", "humaneval", "mbpp", "tool_use", "api_code", "other", "aime_code"]
    rows = table(spark, "s string", [(n,) for n in names])
    assert [r[0] for r in rows.select(P.scorer_for(F.col("s"))).collect()] == ["math", "math", "code", "code", "tool", "code", "math", "math"]


def test_query_id_is_stable_across_runs_and_skips_blanks(spark):
    rows = table(spark, "q string, s string, a string, b string", [("x", "m", "", "id"), ("x", "m", None, None), ("x", "m", "", None), ("y", "m", None, None)])
    ids = [r[0] for r in rows.select(P.query_id(F.col("q"), F.col("s"), F.col("a"), F.col("b"))).collect()]
    assert ids[0] == "id" and ids[1] == ids[2] != ids[3]


def test_no_splits_is_an_error(spark):
    with pytest.raises(ValueError):
        P.in_splits(table(spark, "split string", [("a",)]), " , ")


# --- merging into stored tables ---


def merge_case(spark):
    rows = spark.range(400).select(
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("query_id"), F.concat(F.lit("ask "), "id").alias("question"),
        F.when(F.col("id") % 4 == 0, "math").when(F.col("id") % 4 < 3, "code").alias("split"), (F.col("id") % 3).cast("int").alias("candidate_idx"), F.lit("[]").alias("output_messages"),
        *[F.lit(None).cast("string").alias(c) for c in G.MERGED_COLUMNS], F.when(F.col("id") % 16 != 15, (F.col("id") % 16).cast("int")).alias("part"), "id",
    )
    schema = "query_id string, question string, candidates array<struct<raw_text: string, analysis: string, final_answer: string>>"
    new = [(f"raw {i}", "why", f"new {i}") for i in range(2)]
    return rows, schema, [("k3", "-", new), (None, "ask 9", new), ("", "ask 31", []), ("none", "-", new), (None, None, new)]


@pytest.mark.parametrize("split", [None, "code"])
def test_merge_into_equals_a_merge_of_all_rows(spark, split):
    rows, schema, entries = merge_case(spark)
    path = scratch_path(spark, "merge")
    rows.write.partitionBy("part").parquet(path)
    kept = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path.removeprefix('file:')}/part=*/*.parquet")}
    table_schema = spark.read.parquet(path).schema
    new = spark.createDataFrame(entries, schema)
    touched = G.merge_into(spark, path, new, "part", split, F.lit("now"))
    again = spark.read.parquet(path)
    assert again.schema == table_schema
    want = G.merge_results(rows, new, split, F.lit("now")).select(again.columns)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, want.collect()))
    # Rows of k3 are 3, 53, 103 and so on; 9 is asked by its question, 31 lies in the partition without a value.
    by_rule = {i % 16 if i % 16 != 15 else None for i in range(400) if (i % 9 and i % 50 == 3 or i in (9, 31)) and (split is None or i % 4 in (1, 2))}
    assert set(touched) == by_rule and len(touched) < 16
    untouched = [f for f in kept if (None if "HIVE_DEFAULT" in f else int(f.split("part=")[1].split("/")[0])) not in by_rule]
    assert untouched and all(os.stat(f).st_mtime_ns == kept[f] for f in untouched)
    # Once more, as after a failure: nothing changes.
    G.merge_into(spark, path, new, "part", split, F.lit("now"))
    assert sorted(map(repr, spark.read.parquet(path).collect())) == sorted(map(repr, want.collect()))


def test_merge_into_without_entries_or_columns(spark):
    rows, schema, _ = merge_case(spark)
    path = scratch_path(spark, "merge")
    rows.write.partitionBy("part").parquet(path)
    before = spark.read.parquet(path).inputFiles()
    assert G.merge_into(spark, path, spark.createDataFrame([], schema), "part") == [] and spark.read.parquet(path).inputFiles() == before
    poor = scratch_path(spark, "merge")
    rows.drop("analysis").write.partitionBy("part").parquet(poor)
    with pytest.raises(ValueError, match="analysis"):
        G.merge_into(spark, poor, spark.createDataFrame([], schema), "part")


# --- numbering under skew ---


def skewed(spark):
    """A third of the rows has one key, another part has none."""
    rows = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 != 1, F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))))
    return rows.withColumn("o", F.abs(F.hash("id")).cast("string"))


@pytest.mark.parametrize("spread", [True, False])
def test_numbering_matches_plain_python(spark, spread):
    rows = skewed(spark)
    got = number_rows(rows, ["k"], ["o", "id"], "n", 5, spread=spread).collect()
    groups = {}
    for row in sorted(got, key=lambda r: (r["o"], r["id"])):
        groups.setdefault(row["k"], []).append(row["n"])
    assert len(got) == 3000
    assert all(numbers == list(range(5, 5 + len(numbers))) for numbers in groups.values())


def test_hot_group_is_numbered_by_many_tasks(spark):
    """The spread plan leaves no partition with the whole hot group before numbers are given."""
    rows = skewed(spark).where(F.col("k") == "hot").select("k", "o", "id")
    placed = rows.repartitionByRange(8, "k", "o", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in placed.collect()) < 500


@pytest.mark.parametrize("offset, limit", [(0, 2), (3, None), (900, 200)])
def test_slices(spark, offset, limit):
    rows = skewed(spark)
    got = {r["k"]: r["count"] for r in slice_per_group(rows, ["k"], ["o", "id"], offset, limit).groupBy("k").count().collect()}
    sizes = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    expected = {k: min(n - offset, limit if limit is not None else n) for k, n in sizes.items() if n > offset}
    assert got == expected


# --- joins ---


def test_join_keeps_every_row_of_a_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("t"), F.col("id"))
    verdicts = table(spark, "key string, v int", [("hot", 1), ("hot", 2), ("5", 3), (None, 4)])
    got = J.attach_by_key(rows, verdicts, F.col("t"), F.col("id") != 0, "x_", ["id"])
    assert got.count() == 5000
    found = got.where("x_found")
    # Duplicate verdicts of one key do not multiply rows.
    assert found.count() == sum(1 for i in range(5000) if i and i % 3 == 0) + 1
    assert values(found.where("t = 'hot'").select("x_v").distinct(), "x_v") == [(2,)]


def test_skip_completed_keeps_rows_without_key(spark):
    rows = table(spark, "query_id string", [("a",), ("b",), (None,)])
    assert values(J.skip_completed(rows, table(spark, "query_id string", [("a",), ("a",)])).fillna("none"), "query_id") == [("b",), ("none",)]


def test_verdict_key_ignores_outer_space_and_missing_truth(spark):
    rows = table(spark, "q string, c string, t string, s string", [(" q ", "c", None, "math"), ("q", "c\n", "", "math")])
    keys = [r[0] for r in rows.select(J.verdict_key(F.col("q"), F.col("c"), F.col("t"), F.col("s"))).collect()]
    assert keys[0] == keys[1] and len(keys[0]) == 16


def test_compare_runs_equals_the_pairing_of_all_candidates(spark):
    kind = "query_id string, verification_is_verified boolean, verification_score double"
    base = table(spark, kind, [("a", True, 1.0), ("a", False, 0.0), ("b", True, 0.5), ("c", True, 1.0)])
    other = table(spark, kind, [("a", True, 1.0), ("b", False, 0.0), ("b", True, 1.0), ("d", True, 1.0)])
    summary = J.compare_runs_summary(J.compare_runs(base, other)).first()
    pairs = [(x, y) for q, x, _ in base.collect() for p, y, _ in other.collect() if q == p]
    assert summary["pairs"] == len(pairs)
    assert math.isclose(summary["rate_base"], sum(x for x, _ in pairs) / len(pairs))
    assert math.isclose(summary["rate_other"], sum(y for _, y in pairs) / len(pairs))


def test_tool_call_match(spark):
    def calls(*pairs):
        return [{"name": n, "arguments": a} for n, a in pairs]

    kind = "c array<struct<name:string,arguments:string>>, e array<struct<name:string,arguments:string>>"
    rows = table(spark, kind, [
        (calls(("f", '{"a":1,"b":2}')), calls(("f", '{"b":2,"a":1.0}'))), (calls(("f", "{}")), calls(("f", "{}"), ("g", "{}"))), ([], []), (calls(("f", "{}"), ("g", "{}")), calls(("f", "{}"), ("h", "{}"))),
    ])
    got = [tuple(r["m"])[:2] for r in rows.select(J.match_tool_calls(F.col("c"), F.col("e")).alias("m")).collect()]
    assert got == [(True, 1.0), (False, 0.0), (True, 1.0), (False, 0.5)]


# --- regeneration ---

ENTRY = "query_id string, question string, candidates array<struct<raw_text:string,analysis:string,final_answer:string>>, at int"
ROW = "query_id string, candidate_idx int, split string, input_messages string, output_messages string"


def question(text):
    return f'[{{"role": "user", "content": "{text}"}}]'


def merged(spark, rows, entries, **options):
    out = G.merge_results(table(spark, ROW, rows), table(spark, ENTRY, entries), stamp=F.lit("now"), arrival=["at"], **options)
    return {(r["query_id"], r["candidate_idx"]): r for r in out.collect()}


def test_merge(spark):
    new = [("raw0", "a0", "new0"), ("raw1", "", "new1")]
    rows = [("q1", 0, "math", question("one"), "[]"), ("q1", 1, "math", question("one"), "[]"), ("q1", 2, "math", question("one"), "[]"), ("q2", 0, "code", question("two"), "[]"),
            ("q3", 0, "math", question("three"), "[]"), ("q4", 0, "math", question("four"), "[]"), (None, 0, "math", question("three"), "[]")]
    entries = [("q1", "one", [("old", "", "old")], 1), ("q1", "one", new, 2), ("q2", "two", new, 1), (None, "three", new, 1), ("q4", "four", [], 1)]
    got = merged(spark, rows, entries, split="math")
    final = {k: r["final_answer"] for k, r in got.items()}
    # Own index, last entry, split, question fallback, empty entry, index out of range.
    assert final == {("q1", 0): "new0", ("q1", 1): "new1", ("q1", 2): None, ("q2", 0): None, ("q3", 0): "new0", ("q4", 0): None, (None, 0): "new0"}
    assert got[("q1", 0)]["regenerated_at"] == "now" and got[("q1", 2)]["regenerated_at"] is None
    assert '"content":"new0"' in got[("q1", 0)]["output_messages"] and '"channel":"analysis"' in got[("q1", 0)]["output_messages"]


def test_merge_twice_changes_nothing(spark):
    rows = table(spark, ROW, [("q1", 0, "math", question("one"), "[]"), ("q2", 0, "math", question("two"), "[]")])
    entries = table(spark, ENTRY, [("q1", "one", [("r", "a", "n")], 1)])
    once = G.merge_results(rows, entries, stamp=F.lit("now"), arrival=["at"])
    twice = G.merge_results(once, entries, stamp=F.lit("now"), arrival=["at"])
    assert once.exceptAll(twice.select(*once.columns)).count() == 0 and twice.count() == 2


def test_merge_rescores_only_updated_rows(spark):
    rows = [("q1", 0, "math", question("one"), "[]"), ("q2", 0, "math", question("two"), "[]")]
    got = merged(spark, rows, [("q1", "one", [("r", "a", "n")], 1)], rescore=lambda df: df.withColumn("again", F.lit(True)))
    assert {k: r["again"] for k, r in got.items()} == {("q1", 0): True, ("q2", 0): None}


def test_unique_queries_fall_back_to_question_and_split(spark):
    rows = table(spark, "query_id string, question string, split string, metadata string, o int", [
        ("q", "x", "a", "{}", 2), ("q", "y", "a", "bad", 1), (None, "x", "a", "{}", 3), ("", "x", "a", '{"k": 1}', 4), (None, "x", "b", None, 5),
    ])
    got = G.unique_queries(rows, ["o"])
    assert sorted((r["query_id"] or "", r["question"], r["split"], r["metadata"]) for r in got.collect()) == [("", "x", "a", "{}"), ("", "x", "b", "{}"), ("q", "y", "a", "{}")]


def test_retries_number_after_the_originals(spark):
    originals = table(spark, "query_id string, candidate_idx int", [("q", 0), ("q", 1), ("q", 3)])
    retried = table(spark, "query_id string, retry_of_candidate_idx int, answer string, is_correct boolean, confidence double, verifier_name string", [("q", 1, " ok", True, 1.0, "tool"), ("q", 0, "", False, 0.0, "tool")])
    got = values(G.build_retries(originals, retried), "candidate_idx", "verification_retry_of_candidate_idx", "quality_answer_length", "quality_is_empty", "quality_completeness_score")
    assert got == [(4, 0, 0, True, 0.0), (5, 1, 3, False, 1.0)]


def test_clean_missing(spark):
    rows = table(spark, "question string, score double, other string", [(None, float("nan"), None)])
    assert tuple(P.clean_missing(rows).first()) == ("", None, None)


# --- reports ---


def test_reports_drop_missing_keys_and_values(spark):
    kind = "query_id string, candidate_idx int, split string, verification_is_verified boolean, verification_score double"
    rows = table(spark, kind, [("a", 0, "m", True, 1.0), ("a", 1, "m", None, None), ("b", 0, None, False, 0.0), (None, 0, "m", True, 0.5)])
    assert values(R.split_rates(rows), "split", "samples", "verified_rate", "avg_score") == [("m", 2, 1.0, 0.75)]
    first = R.first_versus_any(rows).first()
    assert first["first_rate"] == pytest.approx(2 / 3) and first["any_rate"] == 0.5
    assert R.query_count(rows).first()["queries"] == 2


def test_guard():
    T.guard(10, 2, 0.2)
    T.guard(0, 0, 0.2)
    with pytest.raises(T.TooManyFailures):
        T.guard(10, 3, 0.2)


def test_threshold_sweep_equals_one_run_per_threshold(spark):
    rows = spark.range(500).select((F.col("id") % 3).cast("string").alias("split"), F.when(F.col("id") % 17 > 0, (F.col("id") * 7 % 101) / 100.0).alias("score"), (F.col("id") % 5 == 0).alias("refused"))
    thresholds = [i / 20 for i in range(20)] + [0.5]
    got = {(r.split, r.threshold): (r.rows, r.accepted, r.rate, r.accepted_true) for r in R.threshold_sweep(rows, "score", thresholds, ["split"], F.col("refused")).collect()}
    assert len(got) == 60
    for limit in thresholds:
        for r in rows.where("score IS NOT NULL").groupBy("split").agg(
            F.count("*").alias("n"), F.count_if(F.col("score") >= limit).alias("a"), F.count_if((F.col("score") >= limit) & F.col("refused")).alias("t")
        ).collect():
            assert got[r.split, limit] == (r.n, r.a, pytest.approx(r.a / r.n), r.t)


def test_describe_of_large_values(spark):
    rows = spark.createDataFrame([(1e9,), (1e9 + 1,), (1e9 + 2,), (None,)], "x double")
    assert R.numeric_describe(rows, ["x"]).first()["std"] == 1.0
    assert R.numeric_describe(rows.limit(1), ["x"]).first()["std"] is None


def test_run_state_grows_by_what_lands(spark):
    kind = "run_id string, query_id string, verification_is_verified boolean, refusal_is_refusal boolean, persona_score double"
    rows = table(spark, kind, [("a", "q1", True, None, 1.0), ("a", "q1", False, True, None), ("a", None, None, False, 3.0), ("b", "q1", True, True, None), (None, "q2", True, False, 2.0), ("a", "q2", True, False, 1e9)])
    parts = rows.withColumn("n", F.monotonically_increasing_id() % 3)
    state = None
    for i in range(3):
        state = R.merge_run_states(*[s for s in (state, R.run_state(parts.where(F.col("n") == i))) if s is not None])
    whole = sorted(map(tuple, R.run_statistics(rows).collect()), key=repr)
    assert sorted(map(tuple, R.statistics_of_state(state).collect()), key=repr) == whole and len(whole) == 3


def test_tool_errors_are_strict(spark):
    rows = spark.createDataFrame([("q", [("f", '{"a":1}] tail'), ("f", '{"a":1}'), ("f", None)])], "query_id string, tool_calls array<struct<name string, arguments string>>")
    assert tuple(R.tool_usage(rows).first()) == ("f", 3, 2)


def test_case_table_counts_missing_results_as_failures(spark):
    cases = spark.createDataFrame([("q", ["1", "2", "3"]), ("r", ["1"]), ("s", []), (None, ["1"])], "query_id string, cases array<string>")
    rows = spark.createDataFrame([("q", 0), ("q", 1), ("r", 0), ("s", 0), ("x", 0), (None, 0)], "query_id string, candidate_idx int")
    results = spark.createDataFrame(
        [("q", 0, i, str(i + 1), None, 0, False, None) for i in range(3)] + [("q", 1, 0, "1", None, 0, False, None), ("q", 1, 1, "2", None, 1, False, None), ("r", 0, 0, "no", None, 0, False, None)],
        "query_id string, candidate_idx int, case_no int, stdout string, stderr string, exit_code int, timed_out boolean, error string",
    )
    got = {(r.query_id, r.candidate_idx): (r.passed, r.total, r.is_correct, round(r.confidence, 6)) for r in S.case_scores(rows, cases, results).collect()}
    assert got == {("q", 0): (3, 3, True, 1.0), ("q", 1): (1, 3, False, 0.333333), ("r", 0): (0, 1, False, 0.0)}


# --- files and streams ---


def test_writers_never_overwrite(spark):
    rows = table(spark, "split string, x int", [("a", 1), ("b", 2)])
    path = scratch_path(spark, "once")
    C.write_candidates(rows, path)
    with pytest.raises(Exception, match="already exists"):
        C.write_candidates(rows, path)
    pruned = spark.read.parquet(path).where("split = 'a'")
    assert "PartitionFilters: [isnotnull(split" in pruned._jdf.queryExecution().toString() and pruned.count() == 1


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError):
        C.load_dataset(spark, "/nowhere", kind="json")


def test_control_report_file(spark):
    rows = table(spark, "split string, o int, m array<struct<role:string,content:string>>", [("tool_calling", 1, [("user", "Hi")]), ("tool_calling", 2, [("user", "")]), ("tool_calling", 3, [("user", "late")])])
    report = C.control_report(C.control_samples(rows, ["o"], F.col("m")), ["o"])
    path = scratch_path(spark, "report")
    C.write_control_report(report, path)
    assert [r["value"] for r in spark.read.text(path).collect() if r["value"]] == ["=== TOOL CALLING SAMPLE 1 ===", "Query: Hi"]


def test_stream_resumes_and_equals_one_batch(spark):
    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "sink", "progress"))
    rows = spark.range(30).select(F.col("id").cast("string").alias("query_id"), (F.col("id") % 3).cast("int").alias("candidate_idx"), F.lit("\\boxed{4}").alias("answer"))
    score = lambda df: df.withColumn("twice", F.col("candidate_idx") * 2)

    def run():
        T.score_landed(T.landed(spark, landing, rows.schema, files_per_batch=1), score, sink, progress).awaitTermination()

    rows.where(F.col("query_id").cast("int") < 10).coalesce(1).write.mode("append").parquet(landing)
    run()
    assert spark.read.parquet(sink).count() == 10
    rows.where(F.col("query_id").cast("int") >= 10).coalesce(1).write.mode("append").parquet(landing)
    run()
    run()
    whole = spark.read.parquet(sink).drop("batch", "stream")
    assert whole.exceptAll(score(rows)).count() == 0 and whole.count() == 30


def test_stream_scores_a_key_once_and_new_streams_keep_old_rows(spark):
    landing, sink = (scratch_path(spark, n) for n in ("landing", "sink"))
    rows = table(spark, "query_id string, candidate_idx int", [("a", 0), ("b", 0)])
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(landing)
    for _ in range(2):
        # The second one starts anew on the same sink.
        T.score_landed(T.landed(spark, landing, rows.schema, files_per_batch=1), lambda df: df, sink, scratch_path(spark, "progress"), keys=T.KEYS).awaitTermination()
    assert values(spark.read.parquet(sink), "query_id", "candidate_idx") == [("a", 0), ("b", 0)]


def test_two_layouts_together(spark):
    old, new = (scratch_path(spark, n) for n in ("old", "new"))
    table(spark, "query_id string, candidate_index int, is_correct boolean, question string", [("a", 1, True, "q")]).write.parquet(old)
    table(spark, "query_id string, candidate_idx int, verification_is_verified boolean", [("b", 2, False)]).write.parquet(new)
    for paths in ((old, new), (new, old)):
        assert values(C.load_normalized(spark, *paths), "query_id", "candidate_idx", "verification_is_verified") == [("a", 1, True), ("b", 2, False)]


def test_retry_of_rows_without_flag(spark):
    rows = table(spark, "query_id string, candidate_idx int, verification_is_retry boolean, verification_retry_of_candidate_idx int, verification_is_verified boolean, verification_score double, refusal_type string",
                 [("q", 0, None, None, False, 0.1, None), ("q", 3, True, 0, True, 0.9, None)])
    assert values(J.retry_pairs(rows), "candidate_idx", "retry_idx") == [(0, 3)]


def test_describe_counts_equal_values_first(spark):
    rows = table(spark, "a int, b double", [(1, None), (1, None), (4, 2.0), (None, 2.0)])
    got = {r["column"]: (r["count"], r["mean"], r["min"], r["p25"], r["p50"], r["max"]) for r in R.numeric_describe(rows, ["a", "b"]).collect()}
    assert got == {"a": (3.0, 2.0, 1.0, 1.0, 1.0, 4.0), "b": (2.0, 2.0, 2.0, 2.0, 2.0, 2.0)}
    one = R.length_summary(table(spark, "quality_answer_length int, quality_reasoning_length int", [(1, None), (2, None), (9, 4)])).first()
    assert tuple(one) == (2.0, 4.0, 4.0, 4.0)


def test_stream_stops_on_failures(spark):
    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "sink", "progress"))
    rows = spark.range(10)
    rows.write.parquet(landing)
    query = T.score_landed(T.landed(spark, landing, rows.schema), lambda df: df, sink, progress, failed=F.col("id") < 5, keys=["id"])
    with pytest.raises(Exception, match="rows failed"):
        query.awaitTermination()
    # Nothing of the batch can be seen.
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA|PATH_NOT_FOUND"):
        spark.read.parquet(sink)


def test_a_batch_reads_itself_only(spark):
    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "sink", "progress"))
    rows = spark.range(5).select(F.col("id").cast("string").alias("query_id"), F.lit(0).alias("candidate_idx"))
    for _ in range(4):
        rows.coalesce(1).write.mode("append").parquet(landing)
    plans = []

    def score(batch):
        plans.append(batch._jdf.queryExecution().toString())
        return batch

    T.score_landed(T.landed(spark, landing, rows.schema, files_per_batch=1), score, sink, progress).awaitTermination()
    # Four batches, and none of them scans the sink.
    assert len(plans) == 4 and not any(sink.rsplit("/", 1)[-1] in p for p in plans)
    assert values(spark.read.parquet(sink), "query_id") == [(str(i),) for i in range(5)]


def test_duplicates_on_a_stream_need_a_landing_time(spark):
    landing = scratch_path(spark, "dup")
    rows = spark.range(4).select(F.lit("q").alias("query_id"), (F.col("id") % 2).cast("int").alias("candidate_idx"), F.current_timestamp().alias("at"))
    rows.write.parquet(landing)
    stream = T.landed(spark, landing, rows.schema)
    with pytest.raises(ValueError):
        T.without_duplicates(stream)
    sink, progress = scratch_path(spark, "s"), scratch_path(spark, "p")
    T.score_landed(T.without_duplicates(stream, landing_time="at"), lambda df: df, sink, progress, keys=[]).awaitTermination()
    assert spark.read.parquet(sink).count() == 2
    assert T.without_duplicates(rows).count() == 2


def skew_plans(spark, make):
    """Final plans of a join over 40 000 rows of which a third has one key, with broadcasts off and low skew limits."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 40000, 1, 8).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("query_id"), F.col("id").cast("int").alias("candidate_idx"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        df = make(rows)
        count = df.count()
        plan = df.agg(F.max(F.xxhash64(*df.columns)))
        plan.collect()
        return count, plan._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["anti", "lookup", "merge", "execution"])
def test_hot_key_is_split(spark, name):
    """A third of the rows under one key must not end in one task."""
    side = table(spark, "query_id string", [("hot",), ("1",), ("2",)])
    results = side.select("query_id", *[F.lit(None).cast(k).alias(c) for c, k in zip(J.EXEC_COLUMNS, ("string", "string", "int", "boolean", "string"))])
    entries = side.select("query_id", F.lit("?").alias("question"), F.array(F.struct(F.lit("r").alias("raw_text"), F.lit("a").alias("analysis"), F.lit("f").alias("final_answer"))).alias("candidates"))
    makers = {
        "anti": lambda rows: J.skip_completed(rows, side.where("query_id = '1'")),
        "lookup": lambda rows: J.attach_by_key(rows, side.select(F.col("query_id").alias("key"), F.lit(1).alias("v")), F.col("query_id"), F.lit(True), "x_", ["candidate_idx"]),
        "merge": lambda rows: G.merge_results(rows.withColumn("question", F.lit("")), entries, stamp=F.lit("now")),
        "execution": lambda rows: J.attach_execution(rows, results, ["query_id"]),
    }
    count, plan = skew_plans(spark, makers[name])
    assert count == (39999 if name == "anti" else 40000)
    assert "skew=true" in plan, plan[:3000]


@pytest.mark.parametrize("ranks", [100, 10])
def test_far_slices_are_ranked_in_parts(spark, monkeypatch, ranks):
    """Beyond the threshold up to which Spark trims partitions no task ranks a whole group, and the rows stay the same."""
    from candor.operators import numbering

    monkeypatch.setattr(numbering, "_RANKS", ranks)
    rows = spark.range(3000).selectExpr("IF(id % 10 = 0, NULL, IF(id % 3 = 0, 'a', 'b')) AS k", "CAST(id AS STRING) AS o")
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(threshold, 20)
    try:
        sliced = slice_per_group(rows, ["k"], ["o"], 25, 30)
        plan = sliced._jdf.queryExecution().optimizedPlan().toString()
        got = sorted((r["k"] or "", r["o"]) for r in sliced.collect())
    finally:
        spark.conf.unset(threshold)
    by_key = {}
    for r in rows.collect():
        by_key.setdefault(r["k"] or "", []).append(r["o"])
    assert got == sorted((k, o) for k, all_ in by_key.items() for o in sorted(all_)[25:55])
    assert ("xxhash64" in plan) == (ranks == 100)


def test_only_columns_that_are_read_reach_the_state(spark):
    """A scored stream moves the keys and the columns that it names, not the wide rows."""
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    rows = spark.range(20).selectExpr("CAST(id % 10 AS STRING) AS query_id", "0 AS candidate_idx", "CAST(id % 10 AS STRING) AS answer", "'wide' AS text")
    rows.write.parquet(landing)
    seen = []

    def score(df):
        seen.append(df.columns)
        return df

    T.score_landed(T.landed(spark, landing, rows.schema), score, sink, scratch_path(spark, "progress"), keys=T.KEYS, reads=["answer"]).awaitTermination()
    assert seen == [["query_id", "candidate_idx", "answer"]] and spark.read.parquet(sink).count() == 10


def test_merge_moves_whole_rows_once(spark):
    """Lookups by id and by question are made on keys; the wide column is in one shuffle, and rows out of scope are in none."""
    wide = F.concat(F.lit("wide"), F.col("id").cast("string"))
    rows = spark.range(40).select(
        F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("query_id"), F.concat(F.lit("q"), F.col("id").cast("string")).alias("question"),
        F.lit(0).alias("candidate_idx"), F.when(F.col("id") % 2 == 0, F.lit("math")).otherwise(F.lit("code")).alias("split"), wide.alias("text"),
    )
    path = scratch_path(spark, "rows")
    rows.write.parquet(path)
    kind = "query_id string, question string, candidates array<struct<raw_text:string,analysis:string,final_answer:string>>"
    new = spark.createDataFrame([("2", "none", [("r", "a", "by id")]), (None, "q4", [("r", "a", "by text")]), ("1", "q1", [("r", "a", "code")])], kind)
    hinted = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = G.merge_results(spark.read.parquet(path), new, "math", F.lit("now"))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        got = {r["text"]: r["final_answer"] for r in merged.collect() if r["regenerated_at"]}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", hinted)
    assert got == {"wide2": "by id", "wide4": "by text"} and merged.count() == 40
    assert sum("FileScan parquet" in line and "text#" in line for line in plan.splitlines()) == 2


def test_landed_keys_are_kept_on_disk(spark):
    import os

    landing, sink, progress = (scratch_path(spark, n) for n in ("landing", "sink", "progress"))
    rows = table(spark, "query_id string, candidate_idx int", [("a", 0), (None, 0), ("a", 0)])
    rows.coalesce(1).write.parquet(landing)
    T.score_landed(T.landed(spark, landing, rows.schema), lambda df: df, sink, progress).awaitTermination()
    kinds = {os.path.splitext(f)[1] for _, _, files in os.walk(f"{progress.removeprefix('file:')}/state") for f in files if not f.startswith(".")}
    assert ".zip" in kinds and ".delta" not in kinds
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) is None
    assert spark.read.parquet(sink).count() == 2
