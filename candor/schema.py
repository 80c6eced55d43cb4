"""Table layouts, the flat <-> nested conversion, and tolerance for older layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.messages import MESSAGES, from_json_text, message, to_json_text
from candor.functions.text import blank_to_null, iso_timestamp

# The flat interchange layout, one row per (query_id, candidate_idx).
TOP_FIELDS = {
    "query_id": "string", "candidate_idx": "int", "split": "string", "category": "string",
    "source_dataset": "string", "reasoning_mode": "string", "source_metadata": "string", "ground_truth_answer": "string",
    "input_messages": "string", "output_messages": "string",
}
QUALITY_FIELDS = {
    "answer_length": "int", "reasoning_length": "int", "plan_length": "int", "total_response_length": "int",
    "has_reasoning": "boolean", "has_plan": "boolean", "is_short_answer": "boolean", "is_substantive": "boolean",
    "is_empty": "boolean", "completeness_score": "double",
}
VERIFICATION_FIELDS = {
    "is_verified": "boolean", "score": "double", "info": "string", "verifier_name": "string",
    "llm_judge_used": "boolean", "llm_judge_failed": "boolean",
    "is_retry": "boolean", "retry_of_candidate_idx": "int", "retry_reason": "string",
}
REFUSAL_FIELDS = {
    "is_refusal": "boolean", "confidence": "double", "refusal_type": "string", "matched_patterns": "array<string>",
}
PERSONA_FIELDS = {"persona_score": "double", "persona_confidence": "double", "judge_reasoning": "string", "judge_model": "string"}
RUN_FIELDS = {
    "model": "string", "temperature": "double", "max_tokens": "int", "timestamp": "string",
    "harmony_encoding": "string", "harmony_channels_detected": "boolean",
}
# Flat names that do not follow the `prefix_field` rule.
REFUSAL_FLAT = {name: "refusal_type" if name == "refusal_type" else f"refusal_{name}" for name in REFUSAL_FIELDS}
PERSONA_FLAT = {name: name if name.startswith("persona_") else f"persona_{name}" for name in PERSONA_FIELDS}
QUALITY_FLAT = {name: f"quality_{name}" for name in QUALITY_FIELDS}
VERIFICATION_FLAT = {name: f"verification_{name}" for name in VERIFICATION_FIELDS}

FLAT_TYPES = {
    **TOP_FIELDS,
    **{QUALITY_FLAT[n]: t for n, t in QUALITY_FIELDS.items()},
    **{VERIFICATION_FLAT[n]: t for n, t in VERIFICATION_FIELDS.items()},
    **{REFUSAL_FLAT[n]: "string" if n == "matched_patterns" else t for n, t in REFUSAL_FIELDS.items()},
    **{PERSONA_FLAT[n]: t for n, t in PERSONA_FIELDS.items()},
    **RUN_FIELDS,
}
FLAT_COLUMNS = tuple(FLAT_TYPES)
DEFAULT_ENCODING = "HARMONY_GPT_OSS"

SOURCE_ROWS = (
    "uuid string, id string, uid string, split string, messages array<struct<role:string,content:string>>, metadata string, "
    "category string, reasoning string, solution string, ground_truth string, answer string, output string"
)
JUDGMENTS = "key string, equivalent boolean, confidence double, reasoning string, judge string"
REFUSAL_JUDGMENTS = "key string, is_refusal boolean, confidence double, refusal_type string"
EXEC_RESULTS = (
    "query_id string, candidate_idx int, case_no int, stdout string, stderr string, exit_code int, timed_out boolean, error string"
)
TEST_CASES = "query_id string, case_no int, input string, expected_output string"
TOOL_CATALOG = "query_id string, tool_name string, description string, parameters variant"
REGENERATED = "query_id string, question string, candidates array<struct<raw_text:string,analysis:string,final_answer:string>>"
RUNS = (
    "run_id string, generated_at string, model string, api string, num_candidates int, temperature double, splits string, "
    "total_records bigint, config_file string, notes string, total_queries bigint, avg_verification_rate double, "
    "avg_refusal_rate double, avg_persona_score double"
)
FLAT_DDL = ", ".join(f"`{name}` {kind}" for name, kind in FLAT_TYPES.items())


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column if the table has it, else a typed NULL."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def flatten(df: DataFrame) -> DataFrame:
    """Nested records (quality, verification, refusal, persona structs; message arrays) -> flat layout."""
    nested = {
        **{QUALITY_FLAT[n]: F.col("quality")[n] for n in QUALITY_FIELDS},
        **{VERIFICATION_FLAT[n]: F.col("verification")[n] for n in VERIFICATION_FIELDS},
        **{REFUSAL_FLAT[n]: F.col("refusal")[n] for n in REFUSAL_FIELDS},
        **{PERSONA_FLAT[n]: F.col("persona")[n] if "persona" in df.columns else F.lit(None) for n in PERSONA_FIELDS},
        "input_messages": to_json_text(F.col("input_messages")),
        "output_messages": to_json_text(F.col("output_messages")),
        "refusal_matched_patterns": F.to_json(F.coalesce(F.col("refusal")["matched_patterns"], F.array().cast("array<string>"))),
        "harmony_encoding": F.coalesce(optional(df, "harmony_encoding"), F.lit(DEFAULT_ENCODING)),
    }
    return df.select(*[nested.get(name, optional(df, name, kind)).cast(kind).alias(name) for name, kind in FLAT_TYPES.items()])


def _regroup(df: DataFrame, flat: dict[str, str], kinds: dict[str, str]) -> Column:
    return F.struct(*[optional(df, flat[n], kinds[n]).cast(kinds[n]).alias(n) for n in kinds])


def unflatten(df: DataFrame) -> DataFrame:
    """Flat layout -> nested records; columns the table lacks become NULL fields."""
    patterns = F.coalesce(F.from_json(optional(df, "refusal_matched_patterns"), "array<string>"), F.array().cast("array<string>"))
    refusal = _regroup(df, REFUSAL_FLAT, {n: k for n, k in REFUSAL_FIELDS.items() if n != "matched_patterns"})
    persona = _regroup(df, PERSONA_FLAT, PERSONA_FIELDS)
    plain = [n for n in (*TOP_FIELDS, *RUN_FIELDS) if not n.endswith("_messages")]
    return df.select(
        *[optional(df, n, FLAT_TYPES[n]).cast(FLAT_TYPES[n]).alias(n) for n in plain],
        from_json_text(optional(df, "input_messages")).alias("input_messages"),
        from_json_text(optional(df, "output_messages")).alias("output_messages"),
        _regroup(df, QUALITY_FLAT, QUALITY_FIELDS).alias("quality"),
        _regroup(df, VERIFICATION_FLAT, VERIFICATION_FIELDS).alias("verification"),
        refusal.withField("matched_patterns", patterns).alias("refusal"),
        F.when(optional(df, "persona_score", "double").isNotNull(), persona).alias("persona"),
    )


def first_present(df: DataFrame, *names: str) -> Column | None:
    """The first of several alternative columns that the table has."""
    return next((F.col(n) for n in names if n in df.columns), None)


def verified_flag(df: DataFrame) -> Column | None:
    """Stored verification flag in any of its three layouts; None when the table has none."""
    flag = first_present(df, "verification_is_verified", "is_correct")
    if flag is None and "verification_result" in df.columns:
        return F.col("verification_result")["is_correct"]
    return flag


def stored_question(df: DataFrame) -> Column:
    """Question text from the stored messages, or from the older plain columns; '' if there is none."""
    from candor.functions.messages import stored_question as from_messages

    if "input_messages" in df.columns:
        return from_messages(F.col("input_messages"))
    plain = first_present(df, "question", "input")
    return F.lit("") if plain is None else F.coalesce(plain, F.lit(""))


def normalize_schema(df: DataFrame) -> DataFrame:
    """Any accepted layout -> the flat layout, by looking at the columns the table has."""
    flag = verified_flag(df)
    answer = first_present(df, "final_answer", "extracted_answer", "raw_response")
    reasoning = first_present(df, "analysis", "extracted_reasoning")
    question = stored_question(df)
    built = F.array_compact(F.array(
        F.when(blank_to_null(reasoning).isNotNull(), message("assistant", reasoning, "analysis")) if reasoning is not None else F.lit(None).cast(MESSAGES[6:-1]),
        F.when(answer.isNotNull(), message("assistant", answer, "final")) if answer is not None else F.lit(None).cast(MESSAGES[6:-1]),
    ))
    alternatives = {
        "candidate_idx": first_present(df, "candidate_idx", "candidate_index"),
        "ground_truth_answer": first_present(df, "ground_truth_answer", "ground_truth", "expected_answer"),
        "source_metadata": first_present(df, "source_metadata", "metadata"),
        "verification_is_verified": flag,
        "input_messages": F.col("input_messages") if "input_messages" in df.columns else to_json_text(F.array(message("user", question))),
        "output_messages": F.col("output_messages") if "output_messages" in df.columns else to_json_text(built),
    }
    chosen = {n: c for n, c in alternatives.items() if c is not None}
    return df.select(*[chosen.get(n, optional(df, n, k)).cast(k).alias(n) for n, k in FLAT_TYPES.items()])


def generated_at(df: DataFrame) -> Column:
    """`timestamp` text as a TIMESTAMP."""
    return iso_timestamp(F.col("timestamp"))
