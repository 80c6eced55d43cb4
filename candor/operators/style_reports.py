"""Style audits: marker phrases and contractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.messages import final_text, from_json_text, full_text
from candor.functions.style import MARKERS, STRONG_MARKERS, contractions, is_vague, marker_count
from candor.functions.text import sum_flags
from candor.operators.reports import rate, share_of_total


def response_text(df: DataFrame) -> Column:
    """Whole response in either layout."""
    if "output_messages" in df.columns:
        return full_text(from_json_text(F.col("output_messages")))
    reasoning = F.col("extracted_reasoning") if "extracted_reasoning" in df.columns else F.lit("")
    return F.concat(F.col("extracted_answer"), F.lit("\n"), F.coalesce(reasoning, F.lit("")))


def answer_only(df: DataFrame) -> Column:
    """Final answer in either layout."""
    if "output_messages" in df.columns:
        return final_text(from_json_text(F.col("output_messages")))
    return F.coalesce(F.col("extracted_answer"), F.lit(""))


def with_markers(df: DataFrame, text: Column) -> DataFrame:
    """Adds count_<marker>, marker_count (markers present) and is_strong. Each pattern runs once per row."""
    counted = df.withColumns({f"count_{m}": marker_count(text, m) for m in MARKERS})
    present = sum_flags(*[F.col(f"count_{m}") > 0 for m in MARKERS])
    return counted.withColumn("marker_count", present).withColumn("is_strong", F.col("marker_count") >= STRONG_MARKERS)


def marker_frequency(marked: DataFrame) -> DataFrame:
    """Per marker: share of rows, total and mean. One aggregate over all markers, then unpivoted."""
    one = marked.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(f"count_{m}") > 0).alias(f"rows_{m}") for m in MARKERS],
        *[F.sum(f"count_{m}").alias(f"sum_{m}") for m in MARKERS],
    )
    lines = F.array(*[
        F.struct(
            F.lit(m).alias("marker"), F.try_divide(F.col(f"rows_{m}"), F.col("rows")).alias("frequency"),
            F.col(f"sum_{m}").alias("total"), F.try_divide(F.col(f"sum_{m}"), F.col("rows")).alias("per_response"),
        )
        for m in MARKERS
    ])
    return one.select(F.inline(lines))


def marker_summary(marked: DataFrame) -> DataFrame:
    return marked.agg(F.avg("marker_count").alias("avg_markers"), rate("is_strong").alias("strong_rate"))


def marker_histogram(marked: DataFrame) -> DataFrame:
    counted = marked.groupBy("marker_count").agg(F.count("*").alias("count"))
    return share_of_total(counted).orderBy("marker_count")


def marker_splits(marked: DataFrame) -> DataFrame:
    return marked.where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count("*").alias("samples"), rate("is_strong").alias("strong_rate"), F.avg("marker_count").alias("avg_markers")
    )


def _preview(text: str, length: int) -> Column:
    return F.translate(F.substring(F.col(text), 1, length), "\n", " ")


def strong_examples(marked: DataFrame, text: str, order: list[str], count: int = 3) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(F.col(f"count_{m}") > 0, F.lit(m)) for m in MARKERS]))
    shown = marked.where("is_strong").orderBy(*order).limit(count)
    return shown.select("query_id", F.array_join(found, ", ").alias("markers"), _preview(text, 300).alias("preview"))


def with_contractions(df: DataFrame, text: Column, normalize_quotes: bool = False) -> DataFrame:
    found = df.withColumn("contractions", contractions(text, normalize_quotes))
    return found.withColumn("contraction_count", F.size("contractions"))


def contraction_summary(found: DataFrame) -> DataFrame:
    hit = F.col("contraction_count") > 0
    return found.agg(
        F.count("*").alias("responses"), F.count_if(hit).alias("with_contractions"), F.sum("contraction_count").alias("total"),
        F.avg("contraction_count").alias("per_response"), rate(~hit).alias("success_rate"), rate(hit).alias("violation_rate"),
    )


def common_contractions(found: DataFrame, count: int = 10) -> DataFrame:
    """Most frequent contractions as written, ties by text."""
    words = found.select(F.explode("contractions").alias("contraction"))
    counted = words.groupBy("contraction").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "contraction").limit(count)


def contraction_splits(found: DataFrame) -> DataFrame:
    violation = rate(F.col("contraction_count") > 0)
    return found.where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count("*").alias("samples"), violation.alias("violation_rate"), F.sum("contraction_count").alias("total"),
        (F.lit(1.0) - violation).alias("success_rate"),
    )


def violation_examples(found: DataFrame, text: str, order: list[str], count: int = 5) -> DataFrame:
    shown = found.where(F.col("contraction_count") > 0).orderBy(*order).limit(count)
    return shown.select("query_id", F.array_join("contractions", ", ").alias("contractions"), _preview(text, 200).alias("preview"))


def vague_prompts(df: DataFrame, text: Column, group: str = "split") -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("prompts"), F.count_if(is_vague(text)).alias("vague"))


def transfer(marked: DataFrame, run: str, base: str, tuned: str) -> DataFrame:
    """Marker and contraction totals of a base and a tuned run, and the relative drop in contractions."""
    markers = F.lit(0)
    for name in MARKERS:
        markers = markers + F.col(f"count_{name}")

    def total(value: Column, which: str) -> Column:
        return F.sum(F.when(F.col(run) == which, value).otherwise(F.lit(0)))

    totals = marked.agg(
        total(markers, base).alias("base_markers"), total(markers, tuned).alias("tuned_markers"),
        total(F.col("contraction_count"), base).alias("base_contractions"),
        total(F.col("contraction_count"), tuned).alias("tuned_contractions"),
    )
    ratio = F.try_divide(F.col("tuned_contractions"), F.col("base_contractions"))
    return totals.withColumn("improvement", (F.lit(1.0) - ratio) * 100.0)
