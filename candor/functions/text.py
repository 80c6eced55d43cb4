"""Text functions with Python string semantics (Unicode strip, code-point length)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from candor.config import DEFAULTS

# The characters Python's str.strip() removes.
SPACE_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
SPACES = "".join(chr(code) for code in SPACE_CODES)
# Line boundaries of Python's str.splitlines().
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C\x1D\x1E\x85\u2028\u2029]"
# Suffix that marks a cut text.
TRUNCATION_MARKER = "\n[TRUNCATED]"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once per row, however often `use` mentions it.

    Without it every mention repeats the whole expression, which multiplies both work and generated code.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def present(*texts: Column) -> Column:
    """Array of the texts that are not NULL, in order; equal ones once. `array_compact` is a filter with a lambda, for which, and for all inside it, Spark generates no code."""
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match: NULL without a match, '' for an empty group. One regex pass."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def strip(text: Column) -> Column:
    """Unicode-aware strip; `btrim` with a character set needs no regex."""
    return F.btrim(text, F.lit(SPACES))


def strip_once(text: Column) -> Column:
    """`strip` of a text that is a column or shared by the whole projection: it is mentioned several times.

    `btrim` with a character set maps every character of the text first. A first and a last byte of printable ASCII say that there is nothing to strip.
    """
    low, high = F.lit(" "), F.lit("\x7f")
    last = F.substring(text.cast("binary"), -1, 1)
    bare = (text > low) & (text < high) & (F.substring(text, 1, 1) != low) & (last > low.cast("binary")) & (last < high.cast("binary"))
    return F.when(bare, text).otherwise(strip(text))


def blank_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def stripped_length(text: Column) -> Column:
    """Code points left after stripping, 0 for NULL."""
    return F.coalesce(F.length(strip_once(text)), F.lit(0))


def non_empty(text: Column) -> Column:
    """Truthiness of a Python string: not NULL and not ''."""
    return F.coalesce(text != "", F.lit(False))


def last_of(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def _closing_segment(opens: Column, open_before: int) -> Column:
    """0-based index of the '}'-terminated segment at which the brace depth returns to 0, else -1.

    `opens` counts the '{' of each segment. Folding one small struct per '}' keeps this
    linear in the text, where folding over single characters would build one string each.
    """
    start = F.struct(F.lit(open_before).alias("depth"), F.lit(0).alias("seen"), F.lit(-1).alias("hit"))

    def step(state: Column, opened: Column) -> Column:
        depth = state["depth"] + opened - 1
        hit = F.when((state["hit"] < 0) & (depth == 0), state["seen"]).otherwise(state["hit"])
        return F.struct(depth.alias("depth"), (state["seen"] + 1).alias("seen"), hit.alias("hit"))

    return F.aggregate(opens, start, step, lambda state: state["hit"])


def _balanced_head(tail: Column, open_before: int) -> Column:
    """Text up to (excluding) the '}' that closes `open_before` already opened braces."""


    def head(segments: Column) -> Column:
        # What follows the last '}' is not closed.
        closed = F.slice(segments, F.lit(1), F.size(segments) - 1)
        opens = F.transform(closed, lambda s: F.length(s) - F.length(F.replace(s, F.lit("{"), F.lit(""))))
        return bind(
            _closing_segment(opens, open_before),
            lambda hit: F.when(hit >= 0, F.array_join(F.slice(segments, F.lit(1), hit + 1), "}")),
        )

    return bind(F.split(tail, r"\}", -1), head)


def boxed(text: Column) -> Column:
    """Content of the first `\\boxed{...}` with nested braces; NULL if absent or unmatched."""
    marker = "\\boxed{"
    tail = F.substring(text, F.instr(text, marker) + len(marker), F.length(text))
    return F.when(F.contains(text, F.lit(marker)), _balanced_head(tail, 1))


def boxed_flat(text: Column) -> Column:
    """One-level variant: content of the first `\\boxed{...}` without braces inside; NULL if none."""
    return blank_to_null(F.regexp_extract(text, r"\\boxed\{([^}]+)\}", 1))


def leading_object(text: Column) -> Column:
    """The balanced `{...}` a text starts with; NULL when it starts otherwise or never closes."""
    return F.when(F.startswith(text, F.lit("{")), F.concat(_balanced_head(text, 0), F.lit("}")))


def tag_body(text: Column, tag: str) -> Column:
    """Body of `<tag>`: up to its end tag, else to the end of the text unless another tag follows; '' if none."""


    def body(parts: Column) -> Column:
        """`parts` is what follows the opening tag, cut at the end tag if there is one."""
        return bind(
            strip(F.get(parts, F.lit(0))),
            lambda b: F.when(F.size(parts) == 2, b).when(non_empty(b) & ~b.rlike(r"(?U)^<\w+>"), b).otherwise(F.lit("")),
        )

    rest = F.get(F.split(text, f"(?iu)<{tag}>", 2), F.lit(1))
    return F.coalesce(bind(F.split(rest, f"(?iu)</{tag}>", 2), body), F.lit(""))


def score_tag(text: Column) -> Column:
    """First number of the text clamped to [0, 5]; NULL if there is none."""
    value = F.regexp_extract(text, r"[-+]?\d*\.?\d+", 0).try_cast("double")
    return bind(value, lambda v: F.when(v.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(5.0), v))))


def _plain_lines(text: Column) -> Column:
    lines = F.transform(F.split(text, LINE_BREAK), lambda line: F.btrim(line, F.lit(" -\t")))
    return F.filter(lines, lambda line: line != "")


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def _items_or_lines(text: Column, pattern: str) -> Column:
    """Stripped matches of the pattern if there is any, else the plain lines."""

    def steps(items: Column) -> Column:
        kept = F.filter(F.transform(items, strip), lambda s: s != "")
        return F.when(F.size(items) > 0, kept).otherwise(_plain_lines(text))

    found = bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), steps)
    return F.when(~non_empty(text), _no_strings()).otherwise(found)


def plan_steps(text: Column) -> Column:
    """`<step>` bodies if any, else the non-empty lines without list dashes."""
    return _items_or_lines(text, r"(?ius)<step>(.*?)</step>")


def listed_steps(text: Column) -> Column:
    """Numbered or bulleted items if any, else the non-empty lines."""
    return _items_or_lines(text, r"(?mdU)(?:^|\n)\s*(?:\d+[\.)]\s*|[-•*]\s*)(.+)")


def self_score(evaluation: Column) -> Column:
    """`<score>` number, else the number after the word score; NULL if neither is present."""
    tagged = F.regexp_extract(evaluation, r"(?iu)<score>(\d+(?:\.\d+)?)</score>", 1)
    worded = F.regexp_extract(evaluation, r"(?iuU)score[:\s]+(\d+(?:\.\d+)?)", 1)
    return F.coalesce(tagged.try_cast("double"), worded.try_cast("double"))


def truncate(text: Column, limit: int) -> Column:
    """Cut at `limit` code points and append the marker; shorter texts pass unchanged."""
    cut = F.concat(F.substring(text, 1, limit), F.lit(TRUNCATION_MARKER))
    return F.when(F.length(text) > limit, cut).otherwise(text)


def was_truncated(text: Column) -> Column:
    return F.coalesce(F.endswith(text, F.lit(TRUNCATION_MARKER)), F.lit(False))


def is_empty_response(answer: Column) -> Column:
    return stripped_length(answer) == 0


def persona_judgement(output: Column, min_score: float = DEFAULTS.min_persona_score) -> Column:
    """Judge text -> struct(score, confidence, is_correct, reasoning); score NULL when unreadable."""
    tagged = F.regexp_extract(output, r"<score>(\d+(?:\.\d+)?)</score>", 1).try_cast("double")
    loose = F.regexp_extract(output, r"(?U)\b([0-5](?:\.\d+)?)\b", 1).try_cast("double")
    score = F.coalesce(tagged, loose)
    closed = F.regexp_extract(output, r"(?s)<reasoning>.*?</reasoning>", 0)
    body = strip(F.regexp_extract(output, r"(?s)<reasoning>(.*?)</reasoning>", 1))
    reasoning = (
        F.when(tagged.isNotNull() & (closed != ""), body)
        .when(tagged.isNotNull(), F.lit("No reasoning provided"))
        .when(loose.isNotNull(), F.substring(output, 1, 200))
    )
    return F.struct(
        score.alias("score"),
        F.coalesce(score / 5.0, F.lit(0.0)).alias("confidence"),
        F.coalesce(score >= min_score, F.lit(False)).alias("is_correct"),
        reasoning.alias("reasoning"),
    )


# Lower-cased fragments of errors that are worth another attempt.
RETRYABLE = ("rate_limit", "rate limit", "429", "overloaded", "503", "502", "500", "connection", "timeout", "server_error")


def is_retryable(message: Column) -> Column:
    lowered = F.lower(message)
    hits = [F.contains(lowered, F.lit(part)) for part in RETRYABLE]
    return F.coalesce(reduce(lambda a, b: a | b, hits), F.lit(False))


def iso_timestamp(text: Column) -> Column:
    """ISO text (a trailing Z means +00:00) -> TIMESTAMP; NULL when unreadable."""
    return F.try_to_timestamp(F.regexp_replace(text, r"Z$", "+00:00"))


def sum_flags(*flags: Column) -> Column:
    return reduce(add, [F.coalesce(flag.cast("int"), F.lit(0)) for flag in flags])


# Special tokens of the multi-channel text format.
CHANNEL_BLOCK = r"(?s)<\|channel\|>\s*(\w+)[^<]*(?:<\|constrain\|>[^<]*)?<\|message\|>(.*?)(?=<\|end\|>|<\|call\|>|<\|return\|>|<\|start\|>|<\|channel\|>|$)"
CHANNELS = ("analysis", "commentary", "final")


def channel_bodies(text: Column, channel: str) -> Column:
    """Bodies of one channel in order; text without any channel token counts as one `final` body."""
    names = F.regexp_extract_all(text, F.lit(CHANNEL_BLOCK), F.lit(1))
    bodies = F.regexp_extract_all(text, F.lit(CHANNEL_BLOCK), F.lit(2))
    pairs = F.filter(F.arrays_zip(names.alias("n"), bodies.alias("b")), lambda p: p["n"] == channel)
    found = F.transform(pairs, lambda p: p["b"])
    if channel != "final":
        return found
    return F.when(F.contains(text, F.lit("<|channel|>")), found).otherwise(F.array(text))


def channel_text(text: Column, channel: str) -> Column:
    """Bodies of one channel joined by newline, '' if absent."""
    return F.array_join(channel_bodies(text, channel), "\n")
