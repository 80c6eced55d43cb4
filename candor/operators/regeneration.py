"""Work lists of queries to answer again, merging of the new answers, and retries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.functions.jsontext import parse
from candor.functions.messages import MESSAGES, message, to_json_text
from candor.functions.quality import SHORT_ANSWER
from candor.functions.text import blank_to_null, non_empty, strip
from candor.operators.joins import fresh, one_per_key
from candor.operators.numbering import number_rows
from candor.operators.selection import filter_rows
from candor.schema import first_present, optional, stored_question

RETRY_REASON = "capability_refusal_dynamic_mock"
#: Columns of a row that a merge fills.
MERGED_COLUMNS = ("raw_response", "analysis", "final_answer", "regenerated_at")
#: So many partitions are written without another shuffle of the rows: each task leaves one file per partition at most.
FEW_PARTITIONS = 8


def _query_keys(df: DataFrame) -> list[Column]:
    """What tells queries apart: the query_id, or question and split where that is missing."""
    identifier = blank_to_null(optional(df, "query_id"))
    split = F.coalesce(optional(df, "split"), F.lit("unknown"))
    return [
        identifier.alias("query_id"), F.when(identifier.isNull(), stored_question(df)).alias("_question"), F.when(identifier.isNull(), split).alias("_split"),
    ]


def unique_queries(df: DataFrame, order: list[str]) -> DataFrame:
    """The first row, in `order`, of each query: by query_id, or by question and split where that is missing.

    An aggregate with map-side combine, not a window: a query that fills a third of the table costs no
    task more than one row per input partition.
    """
    split = F.coalesce(optional(df, "split"), F.lit("unknown"))
    sources = [c for c in ("input_messages", "question", "input") if c in df.columns]
    truth = first_present(df, "ground_truth_answer", "ground_truth", "expected_answer")
    metadata = first_present(df, "source_metadata", "metadata")
    row = F.struct(
        *sources, (F.lit("") if truth is None else truth).alias("ground_truth"), split.alias("split"),
        (F.lit("{}") if metadata is None else metadata).alias("metadata"), F.struct(*order).alias("first_row"),
    )
    first = df.groupBy(*_query_keys(df)).agg(
        F.min_by(row, F.struct(*order)).alias("_row")
    )
    opened = first.select("query_id", "_row.*")
    readable = F.when(parse(F.col("metadata")).isNotNull(), F.col("metadata")).otherwise(F.lit("{}"))
    return opened.select("query_id", stored_question(opened).alias("question"), "ground_truth", "split", readable.alias("metadata"), "first_row")


def plan_regeneration(df: DataFrame, order: list[str], split: str | None = None, failed_only: bool = False) -> DataFrame:
    """Work list: filtered rows, one per query."""
    return unique_queries(filter_rows(df, split, failed_only), order)


def dry_run(df: DataFrame, split: str | None = None, failed_only: bool = False) -> DataFrame:
    """Rows and unique queries a run would touch."""
    chosen = filter_rows(df, split, failed_only)
    per_query = chosen.groupBy(*_query_keys(chosen)).agg(F.count("*").alias("rows"))
    return per_query.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("*").alias("queries"))


def preview(queries: DataFrame, count: int = 5, width: int = 60) -> DataFrame:
    """The first queries of a work list, questions shortened for display."""
    shown = queries.orderBy("first_row", "query_id").limit(count)
    return shown.select("query_id", "split", F.substring("question", 1, width).alias("question"))


def _entry_key() -> Column:
    """Key of a new entry: its query_id, or its question where that is missing."""
    return F.when(non_empty(F.col("query_id")), F.concat(F.lit("i"), "query_id")).otherwise(F.concat(F.lit("q"), "question"))


def merge_results(
    original: DataFrame, regenerated: DataFrame, split: str | None = None, stamp: Column | None = None,
    arrival: list[str] | None = None, rescore: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Original rows with the matching new candidate filled in; all other rows unchanged.

    `regenerated` has query_id, question and an array `candidates`; of several entries for one key the last
    in `arrival` wins. Rows meet entries by query_id, else by question, and take the candidate at their
    own candidate_idx. Updated rows get new messages and a time stamp; `rescore` may then score them again.
    """
    stamp = F.current_timestamp().cast("string") if stamp is None else stamp
    order = arrival or ["candidates"]
    # One lookup table for both kinds of keys, made once and read by both lookups.
    entries = one_per_key(regenerated.select(_entry_key().alias("_entry"), *dict.fromkeys(["candidates", *order])).where("_entry IS NOT NULL"), ["_entry"], order)

    def found_by(name: str) -> DataFrame:
        return entries.select(fresh(F.col("_entry")).alias(f"_{name}"), F.col("candidates").alias(f"_by_{name}"))

    in_scope = F.lit(True) if split is None else F.coalesce(F.col("split") == split, F.lit(False))
    index = first_present(original, "candidate_idx", "candidate_index")
    index = F.lit(0) if index is None else F.coalesce(index.cast("int"), F.lit(0))
    rows = original.where(in_scope).withColumn("_asked_id", F.coalesce(F.concat(F.lit("i"), "query_id"), F.lit(""))).withColumn("_asked", F.concat(F.lit("q"), stored_question(original)))
    # Both lookups are made once per query, on keys alone; whole rows then move once, to what their query found.
    asked = rows.select("_asked_id", "_asked").distinct()
    asked = asked.join(found_by("id"), F.col("_asked_id") == F.col("_id"), "left")
    rest = F.when(F.col("_id").isNull(), F.col("_asked")).otherwise(F.concat(F.lit("-"), "_asked"))
    asked = asked.withColumn("_key", rest).join(found_by("text"), F.col("_key") == F.col("_text"), "left")
    met = asked.select(
        fresh(F.col("_asked_id")).alias("_met_id"), fresh(F.col("_asked")).alias("_met"), F.coalesce(F.col("_by_id"), F.col("_by_text")).alias("_candidates"),
    ).where("_candidates IS NOT NULL")
    joined = rows.join(met, (F.col("_asked_id") == F.col("_met_id")) & (F.col("_asked") == F.col("_met")), "left")
    merged = joined.withColumn("_new", F.get(F.col("_candidates"), index)).drop("_asked_id", "_asked", "_met_id", "_met", "_candidates")
    if split is not None:
        # Rows out of scope don't move at all.
        merged = merged.unionByName(original.where(~in_scope).withColumn("_new", F.lit(None).cast(merged.schema["_new"].dataType)))

    found = F.col("_new").isNotNull()
    reasoning, answer = F.coalesce(F.col("_new.analysis"), F.lit("")), F.coalesce(F.col("_new.final_answer"), F.lit(""))
    messages = F.concat(
        F.when(reasoning != "", F.array(message("assistant", reasoning, "analysis"))).otherwise(F.array().cast(MESSAGES)),
        F.array(message("assistant", answer, "final")),
    )
    updates = {
        "raw_response": F.when(found, F.coalesce(F.col("_new.raw_text"), F.lit(""))).otherwise(optional(original, "raw_response")),
        "analysis": F.when(found, reasoning).otherwise(optional(original, "analysis")),
        "final_answer": F.when(found, answer).otherwise(optional(original, "final_answer")),
        "regenerated_at": F.when(found, stamp).otherwise(optional(original, "regenerated_at")),
    }
    if "output_messages" in original.columns:
        updates["output_messages"] = F.when(found, to_json_text(messages)).otherwise(F.col("output_messages"))
    result = merged.withColumn("_updated", found).withColumns(updates)
    result = result.drop("_new")
    if rescore is None:
        return result.drop("_updated")
    again = rescore(result.where("_updated").drop("_updated"))
    return result.where(~F.col("_updated")).drop("_updated").unionByName(again, allowMissingColumns=True)


def touched_partitions(table: DataFrame, regenerated: DataFrame, by: str, split: str | None = None) -> DataFrame:
    """Values of the partition column `by` under which some row may meet an entry. Reads ids and splits only; questions too if some entry has no id."""
    keys = regenerated.select(_entry_key().alias("_entry")).where("_entry IS NOT NULL").distinct()
    by_question = not regenerated.where(~non_empty(F.col("query_id"))).isEmpty()
    in_scope = table if split is None else table.where(F.col("split") == split)
    found = [F.concat(F.lit("i"), "query_id")] + ([F.concat(F.lit("q"), stored_question(table))] if by_question else [])
    rows = in_scope.select(by, F.explode(F.array(*found)).alias("_key"))
    return rows.join(keys.select(fresh(F.col("_entry")).alias("_key")), "_key", "left_semi").select(by).distinct()


def merge_into(
    spark: SparkSession, path: str, regenerated: DataFrame, by: str, split: str | None = None, stamp: Column | None = None,
    arrival: list[str] | None = None, rescore: Callable[[DataFrame], DataFrame] | None = None,
) -> list:
    """`merge_results` for a stored table with partitions by the column `by`: only partitions that some entry touches are read in full and written again.

    Files of other partitions stay as they are, so the rows that move are those of the touched partitions and not those of the table. Returns the touched values;
    there are no more of them than folders of the table, which the driver lists in any case. The table must have the columns that a merge fills, or partitions
    would differ in their columns. Lost executors only repeat tasks: partitions are replaced when the job commits, one after the other. A driver that dies before
    the commit leaves the table as it was, and merging the same entries once more gives the same rows; one that dies within the commit can leave a partition whose new
    files are still in Spark's staging folder.
    """
    table = spark.read.parquet(path)
    missing = [c for c in MERGED_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"the stored table lacks {', '.join(missing)}")
    touched = [row[0] for row in touched_partitions(table, regenerated, by, split).collect()]
    if not touched:
        return []
    chosen = F.col(by).isin([v for v in touched if v is not None])
    if None in touched:
        chosen = chosen | F.col(by).isNull()
    merged = merge_results(table.where(chosen), regenerated, split, stamp, arrival, rescore).select(table.columns)
    # Few files per partition, and several where one holds a third of all rows: adaptive execution evens them out. Where few partitions are touched, each task writes its share of them.
    if len(touched) > FEW_PARTITIONS:
        merged = merged.hint("rebalance", by)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return touched


def build_retries(originals: DataFrame, retried: DataFrame) -> DataFrame:
    """Retry rows in the flat layout, numbered after the original candidates of their query.

    `retried` has query_id, retry_of_candidate_idx, answer, is_correct, confidence and verifier_name.
    """
    sizes = originals.groupBy("query_id").agg((F.max("candidate_idx") + 1).alias("_next"))
    sizes = sizes.withColumn("query_id", fresh(F.col("query_id")))
    numbered = number_rows(
        retried.join(sizes, "query_id"), ["query_id"], ["retry_of_candidate_idx", "answer"], "candidate_idx", F.col("_next")
    )
    answer = F.coalesce(F.col("answer"), F.lit(""))
    length = F.length(answer)
    return numbered.select(
        "query_id", "candidate_idx",
        to_json_text(F.array(message("assistant", answer, "final"))).alias("output_messages"),
        length.alias("quality_answer_length"), F.lit(0).alias("quality_reasoning_length"), F.lit(0).alias("quality_plan_length"),
        length.alias("quality_total_response_length"), F.lit(False).alias("quality_has_reasoning"), F.lit(False).alias("quality_has_plan"),
        (length < SHORT_ANSWER).alias("quality_is_short_answer"), (length > SHORT_ANSWER).alias("quality_is_substantive"),
        (strip(answer) == "").alias("quality_is_empty"), (answer != "").cast("double").alias("quality_completeness_score"),
        F.col("is_correct").alias("verification_is_verified"), F.col("confidence").alias("verification_score"),
        F.lit("Retry after capability refusal").alias("verification_info"), F.col("verifier_name").alias("verification_verifier_name"),
        F.lit(False).alias("verification_llm_judge_used"), F.lit(False).alias("verification_llm_judge_failed"),
        F.lit(True).alias("verification_is_retry"),
        F.col("retry_of_candidate_idx").alias("verification_retry_of_candidate_idx"),
        F.lit(RETRY_REASON).alias("verification_retry_reason"),
        F.lit(False).alias("refusal_is_refusal"), F.lit(0.0).alias("refusal_confidence"),
        F.lit(None).cast("string").alias("refusal_type"), F.lit("[]").alias("refusal_matched_patterns"),
        F.lit(False).alias("harmony_channels_detected"),
    )


def append_results(existing: DataFrame, *new: DataFrame) -> DataFrame:
    """Earlier rows, new rows and retries in one table; columns a part lacks become NULL."""
    for part in new:
        existing = existing.unionByName(part, allowMissingColumns=True)
    return existing
