"""Keyed joins between candidates and side tables.

No join hints: side tables grow with the data, so Spark picks broadcast or shuffle by size. Right
sides are reduced to one row per key first, so that a join never multiplies rows, and they join on a
fresh key column (see `fresh`), so that adaptive execution can split a hot key of the left side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions import jsontext as J
from candor.functions.text import bind, strip_once


def one_per_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """One row per key: the last one in `order`, or in value order when none is given."""
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.distinct()
    packed = F.struct(*values)
    picked = F.max_by(packed, F.struct(*order)) if order else F.max(packed)
    return df.groupBy(*keys).agg(picked.alias("_row")).select(*keys, "_row.*")


def fresh(key: Column) -> Column:
    """The same string as a new expression, for the reduced side of a join.

    Spark splits a hot key only between two plain shuffles. A side that was just grouped by the key
    would join in place, without a shuffle of its own, and one task would get all rows of the hot
    key. The fresh expression costs one more shuffle of the small side and makes the split possible.
    """
    return F.concat(key, F.lit(""))


def skip_completed(df: DataFrame, done: DataFrame, key: str = "query_id") -> DataFrame:
    """Rows whose key is not among the finished ones; rows without a key stay."""
    finished = done.select(key).distinct().select(fresh(F.col(key)).alias(key))
    return df.join(finished, key, "left_anti")


def compare_runs(base: DataFrame, other: DataFrame) -> DataFrame:
    """Per query found in both runs: candidates, verified counts and means on each side.

    Each side is reduced per query before the join. `pairs` weights a query as the pairing of all its
    candidates would, so pair-level means follow without forming any pair.
    """

    def reduced(df: DataFrame, suffix: str) -> DataFrame:
        return df.where(F.col("query_id").isNotNull()).groupBy("query_id").agg(
            F.count("*").alias(f"candidates_{suffix}"),
            F.count_if("verification_is_verified").alias(f"verified_{suffix}"),
            F.avg("verification_score").alias(f"score_{suffix}"),
        )

    joined = reduced(base, "base").join(reduced(other, "other"), "query_id")
    return joined.withColumn("pairs", F.col("candidates_base") * F.col("candidates_other"))


def compare_runs_summary(compared: DataFrame) -> DataFrame:
    """Rates over all candidate pairs of the common queries."""
    pairs = F.sum("pairs")
    return compared.agg(
        F.count("*").alias("queries"), pairs.alias("pairs"),
        (F.sum(F.col("verified_base") * F.col("candidates_other")) / pairs).alias("rate_base"),
        (F.sum(F.col("verified_other") * F.col("candidates_base")) / pairs).alias("rate_other"),
    )


def known_tools(calls: DataFrame, catalog: DataFrame, known: bool = True) -> DataFrame:
    """Calls whose tool is (or is not) in the catalog of their query."""
    names = catalog.select("query_id", "tool_name").distinct().withColumn("query_id", fresh(F.col("query_id")))
    return calls.join(names, ["query_id", "tool_name"], "left_semi" if known else "left_anti")


def content_key(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts, joined by '|'; missing parts count as ''."""
    texts = [F.coalesce(p, F.lit("")) for p in parts]
    # Never NULL, and Spark should know: else it makes each key twice, the first time to filter on it.
    return F.coalesce(F.left(F.sha2(F.concat_ws("|", *texts), 256), F.lit(16)), F.lit(""))


def verdict_key(question: Column, candidate: Column, truth: Column, split: Column) -> Column:
    """Key of a stored verdict: stripped question, candidate and truth, plus the split."""
    parts = [strip_once(F.coalesce(p, F.lit(""))) for p in (question, candidate, truth)]
    return content_key(*parts, split)


def refusal_key(question: Column, response: Column) -> Column:
    return content_key(strip_once(F.coalesce(question, F.lit(""))), strip_once(F.coalesce(response, F.lit(""))))


def attach_by_key(df: DataFrame, table: DataFrame, key: Column, wanted: Column, prefix: str, spread: list[str]) -> DataFrame:
    """Left join on a content key, only for rows that need it.

    Rows that need no lookup get a key of their own that matches nothing: a shared NULL key would
    send all of them to one task.
    """
    own = F.concat(F.lit("-"), F.xxhash64(*spread).cast("string"))
    values = [c for c in table.columns if c != "key"]
    side = one_per_key(table, ["key"]).select(
        fresh(F.col("key")).alias("_key"), *[F.col(c).alias(f"{prefix}{c}") for c in values], F.lit(True).alias(f"{prefix}found")
    )
    joined = df.withColumn("_key", F.when(wanted, key).otherwise(own)).join(side, "_key", "left").drop("_key")
    return joined.withColumn(f"{prefix}found", F.coalesce(F.col(f"{prefix}found"), F.lit(False)))


def retry_pairs(df: DataFrame) -> DataFrame:
    """Each retry next to the candidate it repeats. Keyed on query and index, so a hot query still spreads."""
    retries = df.where("verification_is_retry").select(
        "query_id", F.col("verification_retry_of_candidate_idx").alias("candidate_idx"), F.col("candidate_idx").alias("retry_idx"),
        F.col("verification_is_verified").alias("retry_verified"), F.col("verification_score").alias("retry_score"),
    )
    # Older files have no flag: their rows are originals.
    originals = df.where(~F.coalesce("verification_is_retry", F.lit(False))).select(
        "query_id", "candidate_idx", F.col("verification_is_verified").alias("original_verified"),
        F.col("verification_score").alias("original_score"), "refusal_type",
    )
    single = one_per_key(originals, ["query_id", "candidate_idx"]).withColumn("query_id", fresh(F.col("query_id")))
    return retries.join(single, ["query_id", "candidate_idx"])


def match_tool_calls(candidate: Column, expected: Column, accept: float = 0.8) -> Column:
    """Two arrays of struct<name, arguments> by position -> struct(is_correct, score, matches).

    Different lengths fail; otherwise the score is the share of positions with equal name and arguments.
    """
    pairs = F.arrays_zip(candidate.alias("c"), expected.alias("e"))

    def equal(pair: Column) -> Column:
        texts = [pair[side]["arguments"] for side in ("c", "e")]
        arguments = [J.canonical(J.parse(t)) for t in texts]
        # Equal texts need no reading, and calls of other names no comparison.
        same = F.when(texts[0].eqNullSafe(texts[1]), F.lit(True)).otherwise(arguments[0].eqNullSafe(arguments[1]))
        return F.when(pair["c"]["name"] == pair["e"]["name"], same).otherwise(F.lit(False))

    def judged(matches: Column) -> Column:
        score = F.when(~same_size, F.lit(0.0)).when(F.size(expected) == 0, F.lit(1.0)).otherwise(matches / F.size(expected))
        return F.struct((same_size & (score >= accept)).alias("is_correct"), score.alias("score"), matches.alias("matches"))

    same_size = F.size(candidate) == F.size(expected)
    return bind(F.when(same_size, F.size(F.filter(pairs, equal))).otherwise(F.lit(0)), judged)


EXEC_COLUMNS = ("stdout", "stderr", "exit_code", "timed_out", "error")


def attach_execution(df: DataFrame, results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Execution result of each candidate (and case) as exec_* columns."""
    keys = keys or ["query_id", "candidate_idx"]
    side = one_per_key(results.select(*keys, *EXEC_COLUMNS), keys)
    first = fresh(F.col(keys[0]).cast("string")).alias(keys[0])
    renamed = side.select(first, *keys[1:], *[F.col(c).alias(f"exec_{c}") for c in EXEC_COLUMNS])
    return df.join(renamed, keys, "left")


def tool_catalog(df: DataFrame, metadata: Column) -> DataFrame:
    """Catalog rows (query, tool, description, parameters) of prompts that carry tool definitions."""
    from candor.functions.messages import tools_in

    tools = df.select("query_id", F.explode(tools_in(metadata)).alias("tool"))
    return tools.select(
        "query_id", F.col("tool.name").alias("tool_name"), F.col("tool.description").alias("description"),
        F.col("tool.parameters").alias("parameters"),
    )
