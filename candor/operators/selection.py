"""Row filters, routing and identifiers."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.text import blank_to_null
from candor.operators.numbering import slice_per_group
from candor.schema import verified_flag

logger = logging.getLogger(__name__)

# Keywords in a split name that choose its scorer, in order.
ROUTES = (
    ("math", ("math", "gsm", "aime", "amc", "algebra")),
    ("code", ("code", "python", "humaneval", "mbpp", "codex")),
    ("tool", ("tool", "api", "function")),
)
DEFAULT_ROUTE = "math"
# Splits that live in the newer dataset version.
NEWER_SPLITS = ("code", "math")


def scorer_for(split: Column) -> Column:
    """Scorer name for a split name."""
    name = F.lower(split)
    route = F.lit(DEFAULT_ROUTE)
    for scorer, words in reversed(ROUTES):
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(name, F.lit(word))
        route = F.when(hit, F.lit(scorer)).otherwise(route)
    return route


def dataset_version(split: Column) -> Column:
    return F.when(split.isin(*NEWER_SPLITS), F.lit("v2")).otherwise(F.lit("v1"))


def split_names(text: str) -> list[str]:
    """Comma list -> names, trimmed, empties dropped."""
    return [name.strip() for name in text.split(",") if name.strip()]


def in_splits(df: DataFrame, names: str | list[str]) -> DataFrame:
    names = split_names(names) if isinstance(names, str) else names
    if not names:
        raise ValueError("no splits given")
    return df.where(F.col("split").isin(*names))


def query_id(question: Column, split: Column, *ids: Column) -> Column:
    """First usable id, else split plus a content hash, so equal prompts meet across runs."""
    content = F.concat(F.coalesce(split, F.lit("")), F.lit("_"), F.sha2(F.coalesce(question, F.lit("")), 256))
    return F.coalesce(*[blank_to_null(i.cast("string")) for i in ids], content)


def filter_rows(df: DataFrame, split: str | None = None, failed_only: bool = False) -> DataFrame:
    """Rows to work on again: one split, and only those whose stored flag is false.

    Unknown columns mean no filter. In the oldest layout a row without a result counts as failed.
    """
    if split:
        if "split" in df.columns:
            df = df.where(F.col("split") == split)
        else:
            logger.warning("no split column: rows are not filtered by split")
    if not failed_only:
        return df
    flag = verified_flag(df)
    if flag is None:
        logger.warning("no verification column: rows are not filtered by failure")
        return df
    if "verification_is_verified" in df.columns or "is_correct" in df.columns:
        return df.where(~flag)
    return df.where(F.col("verification_result").isNull() | ~F.coalesce(flag, F.lit(True)))


def slice_splits(df: DataFrame, order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """offset/limit within every split."""
    return slice_per_group(df, ["split"], order, offset, limit)


def filter_quality(df: DataFrame, min_completeness: float = 0.6) -> DataFrame:
    """Verified, no refusal, substantive and complete enough. All four filters reach the scan."""
    return df.where(
        F.col("verification_is_verified") & ~F.col("refusal_is_refusal")
        & F.col("quality_is_substantive") & (F.col("quality_completeness_score") > min_completeness)
    )


def tool_refusals(df: DataFrame) -> DataFrame:
    return df.where((F.col("split") == "tool_calling") & F.col("refusal_is_refusal"))


def is_terse_but_reasoned(min_reasoning: int = 100) -> Column:
    """Short answer after long reasoning."""
    return F.col("quality_is_short_answer") & (F.col("quality_reasoning_length") > min_reasoning)


def clean_missing(df: DataFrame) -> DataFrame:
    """NaN and NULL become '' in the plain text columns; NaN becomes NULL everywhere else."""
    # Text columns that must not be missing.
    texts = ("raw_response", "analysis", "final_answer", "question", "input")
    changed = {}
    for name, kind in df.dtypes:
        if name in texts:
            changed[name] = F.coalesce(F.col(name).cast("string"), F.lit(""))
        elif kind in ("double", "float"):
            changed[name] = F.when(~F.isnan(name), F.col(name))
    return df.withColumns(changed)


def retry_candidates(df: DataFrame, tool_metadata: str = "tool_metadata") -> DataFrame:
    """Refusals for lack of a capability that happened while a simulated tool answered."""
    simulated = F.coalesce(F.get_json_object(F.col(tool_metadata), "$.used_dynamic_mock") == "true", F.lit(False))
    return df.where(simulated & F.col("refusal_is_refusal") & (F.col("refusal_type") == "capability"))
