"""Immutable thresholds shared by the scoring operators."""

from __future__ import annotations

from dataclasses import dataclass

SCHEMA_MODES = ("strict", "lenient", "none")


@dataclass(frozen=True)
class Thresholds:
    """Scoring limits. Frozen, so one run can never change another run's defaults."""

    # The defaults every published score was produced with.
    numeric_tolerance: float = 1e-6
    unit_tolerance: float = 1e-4
    # No limit unless a caller sets one: a limit drops what lies beyond it.
    max_expression_size: int | None = None
    max_json_size: int | None = None
    schema_validation: str = "strict"
    validate_tool_exists: bool = True
    validate_parameter_types: bool = True
    min_primary_confidence: float = 0.5
    min_judge_confidence: float = 0.7
    refusal_threshold: float = 0.5
    min_persona_score: float = 3.0
    max_failure_rate: float = 0.2
    max_answer_length: int | None = None
    max_analysis_length: int | None = None
    max_raw_text_length: int | None = None

    def __post_init__(self) -> None:
        if self.schema_validation not in SCHEMA_MODES:
            raise ValueError(f"schema_validation must be one of {SCHEMA_MODES}")
        for name in ("numeric_tolerance", "unit_tolerance", "max_expression_size", "max_json_size",
                     "max_answer_length", "max_analysis_length", "max_raw_text_length"):
            if getattr(self, name) is not None and getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("min_primary_confidence", "min_judge_confidence", "refusal_threshold", "max_failure_rate"):
            if not 0.0 <= getattr(self, name) <= 1.0:
                raise ValueError(f"{name} must be in [0, 1]")


DEFAULTS = Thresholds()
