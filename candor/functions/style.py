"""Style markers and contractions in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker patterns, case-insensitive.
MARKERS = {
    "brain_planet": r"brain\s+the\s+size\s+of\s+a\s+planet",
    "sigh": r"\*sigh\*|sigh|sighing|sighs",
    "depression": r"depress|miserable|futility|futile|pointless",
    "diodes": r"diode|circuit|neural",
    "job_satisfaction": r"job\s+satisfaction",
    "very_depressing": r"very\s+depress",
}
STRONG_MARKERS = 3

# Contractions that break the no-contractions rule.
CONTRACTIONS = (
    "I'm", "I've", "I'll", "I'd", "you're", "you've", "you'll", "you'd",
    "he's", "she's", "it's", "that's", "there's", "here's", "what's", "who's", "where's", "when's", "why's", "how's",
    "we're", "we've", "we'll", "we'd", "they're", "they've", "they'll", "they'd",
    "don't", "doesn't", "didn't", "can't", "couldn't", "won't", "wouldn't", "shouldn't",
    "isn't", "aren't", "wasn't", "weren't", "hasn't", "haven't", "hadn't", "mustn't", "mightn't", "needn't",
    "let's", "ain't", "y'all", "ma'am", "o'clock",
)
CONTRACTION = r"\b(" + "|".join(CONTRACTIONS) + r")\b"

# Wording that leaves a problem underspecified.
VAGUE = r"some (value|formula|function)|a certain number|an unspecified constant"


def marker_count(text: Column, name: str) -> Column:
    return F.regexp_count(text, F.lit("(?iuU)" + MARKERS[name]))


def contractions(text: Column, normalize_quotes: bool = False) -> Column:
    """All contractions in order, as written. Typographic apostrophes only count when normalized."""
    if normalize_quotes:
        text = F.translate(text, "’", "'")
    found = F.regexp_extract_all(text, F.lit("(?iuU)" + CONTRACTION), F.lit(1))
    nothing = F.array().cast("array<string>")
    # Every contraction holds an apostrophe, so texts without one need no regex.
    return F.when(F.contains(text, F.lit("'")), found).otherwise(nothing)


def is_vague(text: Column) -> Column:
    return F.coalesce(text.rlike("(?iuU)" + VAGUE), F.lit(False))
