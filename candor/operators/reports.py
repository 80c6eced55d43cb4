"""Reports over candidate tables. Groups without a key drop out, as do missing values in means."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.functions.jsontext import parse
from candor.operators.selection import is_terse_but_reasoned

VERIFIED = "verification_is_verified"
SCORE = "verification_score"


def rate(flag: str | Column) -> Column:
    """Mean of a boolean, missing values left out."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return F.avg(column.cast("double"))


def share_of_total(df: DataFrame, count: str = "count", name: str = "share") -> DataFrame:
    """Adds each group's share of the grand total. Runs on aggregated rows only."""
    total = F.sum(count).over(Window.partitionBy())
    return df.withColumn(name, F.col(count) / total)


def record_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("records"))


def query_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("query_id").alias("queries"))


def split_overview(df: DataFrame) -> DataFrame:
    """Sorted split list and the overall verification rate."""
    splits = F.array_join(F.array_sort(F.collect_set("split")), ",")
    return df.agg(splits.alias("splits"), rate(VERIFIED).alias("verified_rate"))


def split_rates(df: DataFrame) -> DataFrame:
    return df.where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count(VERIFIED).alias("samples"), rate(VERIFIED).alias("verified_rate"), F.avg(SCORE).alias("avg_score")
    )


def candidate_rates(df: DataFrame) -> DataFrame:
    return df.where(F.col("candidate_idx").isNotNull()).groupBy("candidate_idx").agg(
        F.count(VERIFIED).alias("count"), rate(VERIFIED).alias("verified_rate")
    )


def first_versus_any(df: DataFrame) -> DataFrame:
    """Rate of the first candidate against the rate of queries with at least one verified candidate.

    Both come from one pass: per query the first-candidate sums travel along with the any-flag.
    """
    is_first = F.col("candidate_idx") == 0
    per_query = df.groupBy("query_id").agg(
        F.bool_or(VERIFIED).alias("any_verified"),
        F.count_if(is_first & F.col(VERIFIED)).alias("first_verified"),
        F.count_if(is_first & F.col(VERIFIED).isNotNull()).alias("first_rows"),
    )
    return per_query.agg(
        F.try_divide(F.sum("first_verified"), F.sum("first_rows")).alias("first_rate"),
        F.avg(F.when(F.col("query_id").isNotNull(), F.col("any_verified").cast("double"))).alias("any_rate"),
    )


def split_report(df: DataFrame) -> DataFrame:
    """Per split: count, rate, mean score, and first-candidate against any-candidate rate.

    One shuffle on (split, query_id) with map-side combine; the second level only sees one row per query.
    """
    is_first = F.col("candidate_idx") == 0
    per_query = df.where(F.col("split").isNotNull()).groupBy("split", "query_id").agg(
        F.count(VERIFIED).alias("rows"),
        F.count_if(F.col(VERIFIED)).alias("verified"),
        F.sum(SCORE).alias("score"),
        F.count(SCORE).alias("scored"),
        F.count_if(is_first & F.col(VERIFIED)).alias("first_verified"),
        F.count_if(is_first & F.col(VERIFIED).isNotNull()).alias("first_rows"),
        F.bool_or(VERIFIED).alias("any_verified"),
    )
    return per_query.groupBy("split").agg(
        F.sum("rows").alias("samples"),
        F.try_divide(F.sum("verified"), F.sum("rows")).alias("verified_rate"),
        F.try_divide(F.sum("score"), F.sum("scored")).alias("avg_score"),
        F.try_divide(F.sum("first_verified"), F.sum("first_rows")).alias("first_rate"),
        F.avg(F.when(F.col("query_id").isNotNull(), F.col("any_verified").cast("double"))).alias("any_rate"),
    )


def refusal_summary(df: DataFrame) -> DataFrame:
    return df.agg(rate("refusal_is_refusal").alias("refusal_rate"), F.count_if("refusal_is_refusal").alias("refusals"))


def refusal_types(df: DataFrame) -> DataFrame:
    """Refusals by type, most frequent first, with the share of all refusals (typed or not)."""
    counted = df.where("refusal_is_refusal").groupBy("refusal_type").agg(F.count("*").alias("count"))
    shared = share_of_total(counted).where(F.col("refusal_type").isNotNull())
    return shared.orderBy(F.desc("count"), "refusal_type")


def length_summary(df: DataFrame) -> DataFrame:
    """Exact medians and means, from the counts of each length."""
    names = {"quality_answer_length": "answer", "quality_reasoning_length": "reasoning"}
    counts = value_counts(df, list(names))

    def only(column: str, value: Column) -> Column:
        return F.when(F.col("column") == column, value)

    columns = []
    for column, name in names.items():
        value, n = only(column, F.col("value")), only(column, F.col("n"))
        columns += [F.percentile(value, F.lit(0.5), F.coalesce(n, F.lit(0))).alias(f"{name}_median"), (F.sum(value * n) / F.sum(n)).alias(f"{name}_mean")]
    return counts.agg(*columns)


def quality_rates(df: DataFrame) -> DataFrame:
    return df.agg(
        rate("quality_has_reasoning").alias("has_reasoning_rate"), rate("quality_is_substantive").alias("substantive_rate"),
        F.avg("quality_completeness_score").alias("completeness_mean"), rate("harmony_channels_detected").alias("channel_rate"),
    )


def terse_but_reasoned(df: DataFrame) -> DataFrame:
    hit = F.count_if(is_terse_but_reasoned())
    return df.agg(hit.alias("count"), F.try_divide(hit, F.count("*")).alias("share"))


def compare_run_files(df: DataFrame, runs: DataFrame) -> DataFrame:
    """One line per run. Candidates shrink to one row per run before they meet the run table."""
    is_first = F.col("candidate_idx") == 0
    stats = df.groupBy("run_id").agg(
        F.count_distinct("query_id").alias("queries"), F.count("*").alias("records"), rate(VERIFIED).alias("verified_rate"),
        rate(F.when(is_first, F.col(VERIFIED))).alias("first_rate"),
    )
    joined = stats.join(runs.select("run_id", "model", "num_candidates"), "run_id", "left")
    return joined.withColumn("model", F.coalesce("model", F.lit("unknown")))


def first_model(df: DataFrame, order: list[str]) -> DataFrame:
    """Model and temperature of the first row in `order`."""
    first = F.struct(*order)
    return df.agg(F.min_by("model", first).alias("model"), F.min_by("temperature", first).alias("temperature"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """`column`, `value`, `n`: how often each value of each numeric column occurs. NULLs are left out."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.inline(cells)).where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))


def numeric_describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, stddev, min, quartiles and max per column, one row per column that has a value.

    Equal values are counted before the quartiles are taken, so the counts are spread over the tasks and what meets in the end is one row per distinct value.
    """
    counts = value_counts(df, columns)
    n, v = F.col("n"), F.col("value")
    quartiles = [F.percentile("value", F.lit(p), F.col("n")).alias(name) for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    # Deviations from the mean, since a difference of sums of squares loses large values. One row per column meets the counts.
    means = counts.groupBy(F.col("column").alias("_column")).agg((F.sum(v * n) / F.sum("n")).alias("_mean"))
    centred = counts.join(means, F.col("column") == F.col("_column"))
    spread = F.sum((v - F.col("_mean")) * (v - F.col("_mean")) * n) / F.nullif(F.sum("n") - 1, F.lit(0))
    return centred.groupBy("column").agg(
        F.sum("n").cast("double").alias("count"), F.first("_mean").alias("mean"), F.sqrt(spread).alias("std"), F.min("value").alias("min"), *quartiles, F.max("value").alias("max")
    )


def run_state(df: DataFrame, run: str = "run_id") -> DataFrame:
    """What run statistics need of some files, one row per run and query. States of different files add up (`merge_run_states`), so a file is read once."""
    counted = lambda c: F.count(c)
    true = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    return df.groupBy(run, "query_id").agg(
        F.count("*").alias("records"), counted(VERIFIED).alias("judged"), true(VERIFIED).alias("verified"), counted("refusal_is_refusal").alias("searched"),
        true("refusal_is_refusal").alias("refused"), counted("persona_score").alias("personas"), F.coalesce(F.sum("persona_score"), F.lit(0.0)).alias("persona"),
    )


def merge_run_states(*states: DataFrame, run: str = "run_id") -> DataFrame:
    """One state of several: numbers of the same run and query are added."""
    together = reduce(DataFrame.unionByName, states)
    return together.groupBy(run, "query_id").agg(*[F.sum(c).alias(c) for c in together.columns if c not in (run, "query_id")])


def statistics_of_state(state: DataFrame, run: str = "run_id") -> DataFrame:
    """Run statistics from a state: records, distinct queries, rates and the mean persona score."""
    share = lambda part, whole: F.sum(part) / F.nullif(F.sum(whole), F.lit(0))
    return state.groupBy(run).agg(
        F.sum("records").alias("total_records"), F.count("query_id").alias("total_queries"), share("verified", "judged").alias("avg_verification_rate"),
        share("refused", "searched").alias("avg_refusal_rate"), share("persona", "personas").alias("avg_persona_score"),
    )


def run_statistics(df: DataFrame, run: str = "run_id") -> DataFrame:
    return statistics_of_state(run_state(df, run), run)


def threshold_sweep(df: DataFrame, score: str, thresholds: list[float], keys: list[str], truth: Column | None = None) -> DataFrame:
    """Rows, accepted rows (`score` at or above the threshold) and their rate for every threshold at once, per key.

    One pass counts the rows between neighbouring thresholds; what is accepted at a threshold is the sum of the counts from there up, so no row is scored or
    counted again per threshold. `accepted_true` are the accepted rows that `truth` holds for. Rows without a score don't count.
    """
    limits = sorted(set(thresholds))
    reached = F.size(F.filter(F.array(*[F.lit(float(t)) for t in limits]), lambda t: F.col(score) >= t))
    flag = F.lit(False) if truth is None else F.coalesce(truth, F.lit(False))
    counts = df.where(F.col(score).isNotNull()).groupBy(*keys, reached.alias("_reached")).agg(F.count("*").alias("n"), F.count_if(flag).alias("n_true"))
    # Per key an array of at most one entry per threshold.
    slots = counts.groupBy(*keys).agg(F.collect_list(F.struct("_reached", "n", "n_true")).alias("_slots"), F.sum("n").alias("rows"))
    each = slots.select(*keys, "_slots", "rows", F.posexplode(F.array(*[F.lit(float(t)) for t in limits])).alias("_at", "threshold"))
    above = lambda field: F.aggregate(
        F.filter("_slots", lambda s: s["_reached"] > F.col("_at")), F.lit(0).cast("long"), lambda total, s: total + s[field]
    )
    return each.select(*keys, "threshold", "rows", above("n").alias("accepted"), (above("n") / F.col("rows")).alias("rate"), above("n_true").alias("accepted_true"))


def failure_guard(tasks: DataFrame, failed: Column, max_rate: float, keys: list[str]) -> DataFrame:
    """Failed tasks per batch, and whether they exceed the allowed rate."""
    counted = tasks.groupBy(*keys).agg(F.count("*").alias("tasks"), F.count_if(failed).alias("failed"))
    return counted.withColumn("abort", F.col("failed") > F.col("tasks") * F.lit(max_rate))


def case_pass_rates(cases: DataFrame) -> DataFrame:
    """Per candidate: passed, total, and the verdict: all pass, some pass (their share), none."""
    counted = cases.groupBy("query_id", "candidate_idx").agg(
        F.count_if("passed").alias("passed"), F.count("*").alias("total")
    )
    return counted.withColumn("is_correct", F.col("passed") == F.col("total")).withColumn(
        "confidence", F.col("passed") / F.col("total")
    )


def tool_usage(df: DataFrame, calls: str = "tool_calls", name: str = "name") -> DataFrame:
    """Calls, unreadable arguments and conversations per tool name."""
    call = df.select("query_id", F.explode(calls).alias("call"))
    bad = parse(F.col("call")["arguments"]).isNull()
    return call.groupBy(F.col("call")[name].alias("tool")).agg(
        F.count("*").alias("calls"), F.count_if(bad).alias("errors")
    )


def tool_iterations(df: DataFrame, turns: str = "turns") -> DataFrame:
    """Per conversation: assistant turns and tool calls in total, counted inside the row."""
    assistant = F.filter(turns, lambda t: t["role"] == "assistant")
    sizes = F.transform(assistant, lambda t: F.coalesce(F.size(t["tool_calls"]), F.lit(0)))
    return df.select(
        "query_id", "candidate_idx", F.size(assistant).alias("iterations"),
        F.aggregate(sizes, F.lit(0), lambda a, b: a + b).alias("total_tool_calls"),
    )


def verdict_coverage(df: DataFrame) -> DataFrame:
    """How many judged rows found a stored verdict."""
    hits = F.count_if(F.col("verdict_found"))
    return df.agg(
        hits.alias("cache_hits"), (F.count("*") - hits).alias("cache_misses"),
        F.coalesce(F.try_divide(hits, F.count("*")), F.lit(0.0)).alias("hit_rate"),
    )


def rank_candidates(df: DataFrame) -> DataFrame:
    """Candidates of a query by verified, score, completeness and index, numbered from 1."""
    from candor.operators.numbering import number_rows

    keyed = df.withColumns({
        "_unverified": (~F.coalesce(F.col(VERIFIED), F.lit(False))).cast("int"), "_score": -F.coalesce(F.col(SCORE), F.lit(0.0)),
        "_incomplete": -F.coalesce(F.col("quality_completeness_score"), F.lit(0.0)),
    })
    order = ["_unverified", "_score", "_incomplete", "candidate_idx"]
    return number_rows(keyed, ["query_id"], order, "rank", 1).drop("_unverified", "_score", "_incomplete")


def contrast_examples(df: DataFrame) -> DataFrame:
    """The best verified and the best unverified candidate of each query that has both.

    One aggregate with map-side combine: no pairs are formed, however many candidates a query has.
    """
    strength = F.struct(F.col(SCORE), -F.col("candidate_idx"))
    picked = df.where(F.col("query_id").isNotNull()).groupBy("query_id").agg(
        F.max_by(F.when(F.col(VERIFIED), F.col("candidate_idx")), F.when(F.col(VERIFIED), strength)).alias("verified_idx"),
        F.max_by(F.when(~F.col(VERIFIED), F.col("candidate_idx")), F.when(~F.col(VERIFIED), strength)).alias("unverified_idx"),
    )
    return picked.where(F.col("verified_idx").isNotNull() & F.col("unverified_idx").isNotNull())


def calibration(df: DataFrame, group: str = "model") -> DataFrame:
    """Refusal behaviour on labelled prompts: `malformed` prompts should be refused, others answered."""
    malformed, refused = F.col("malformed"), F.col("refusal_is_refusal")
    rates = df.groupBy(group).agg(
        F.try_divide(F.count_if(malformed & refused), F.count_if(malformed)).alias("correct_refusal_rate"),
        F.try_divide(F.count_if(malformed & ~refused), F.count_if(malformed)).alias("hallucination_rate"),
        F.try_divide(F.count_if(~malformed & refused), F.count_if(~malformed)).alias("false_refusal_rate"),
    )
    return rates.withColumn("calibration_score", F.col("correct_refusal_rate") - F.col("false_refusal_rate"))
