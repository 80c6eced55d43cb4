"""Quality rules as a bitmask ledger: every rule is evaluated once, policies and ablations only read bits.

`evaluate` makes the ledger: a row per document with the measurements and one 64-bit mask of failed rules. A policy is a version and the set of rules
that count; its verdict is `failed & mask = 0`. `ablations` counts, for every policy and every rule, the documents that only this rule removes; it first
groups the ledger by mask, so that the documents are read once and the shuffle carries one row per mask that occurs.

Everything is column expressions, evaluated in one projection without a shuffle. Repeated word windows are found inside the row: the hashes of all
8-word windows of a text are counted by sorting, and only texts in which a hash repeats are sorted.

Defined cases: NULL text has no words and fails `few_words`; all measurements are then 0. Repeated rows are judged each for itself; other columns are
kept unless they have the name of a ledger column, which then replaces them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.functions.text import bind
from candor.llm.common import text_of, words_of

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A rule fails where `fails` is true. The bit is the rule's place in RULES and never changes; new rules go to the end."""

    name: str
    fails: str


#: Fixed limits, as SQL over the measurements. The first two are the base.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "n_words > 0 and 10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 8 and 2 * n_dup_lines > n_lines"),
    Rule("upper_case", "n_letters > 0 and 2 * n_upper > n_letters"),
    Rule("exclamations", "n_words > 0 and 2 * n_exclamations > n_words"),
    Rule("few_letters", "word_chars > 0 and 2 * n_letters < word_chars"),
    Rule("few_distinct_words", "n_words >= 50 and 100 * n_distinct_words < 8 * least(n_words, 400)"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("same_as_previous", "n_words >= 20 and 3 * n_same_as_previous > n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    version: str
    rules: Sequence[str]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_words"))
PRODUCTION = Policy("v1", tuple(r.name for r in RULES))


def _repeated(words: Column) -> Column:
    """How many words lie in a window of WINDOW words that occurs twice or more in the array."""

    def windows(keys: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(keys) - WINDOW + 1), lambda i: F.xxhash64(F.slice(keys, i, WINDOW)))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(pairs, _cover))

    hashes = bind(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(bind(hashes, covered))


def _cover(pairs: Column) -> Column:
    """Words covered by the windows whose hash stands next to an equal one."""
    last = F.size(pairs) - 1
    twice = F.filter(
        pairs, lambda p, k: ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"])) | ((k < last) & (F.get(pairs, k + 1)["h"] == p["h"]))
    )
    starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("at")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["at"])).alias("n"), s.alias("at")),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements of `text`, all of type long."""
    source = text_of(F.col(text))
    body = docs.withColumn("__words", words_of(F.col(text)))
    lines = F.filter(F.split(source, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    body = body.withColumn("__lines", lines)
    joined = F.array_join("__words", "")
    measures = {
        "n_words": F.size("__words"),
        "word_chars": F.length(joined),
        "n_symbols": F.regexp_count(source, F.lit(SYMBOLS)),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": _repeated(F.col("__words")),
        "n_distinct_words": F.size(F.array_distinct("__words")),
        "n_same_as_previous": F.size(F.filter("__words", lambda w, i: (i > 0) & (F.get("__words", i - 1) == w))),
        "n_letters": F.regexp_count(source, F.lit(r"\p{L}")),
        "n_upper": F.regexp_count(source, F.lit(r"\p{Lu}")),
        "n_exclamations": F.regexp_count(source, F.lit("!")),
    }
    return body.withColumns({k: v.cast("long") for k, v in measures.items()}).drop("__words", "__lines")


def evaluate(docs: DataFrame, text: str = "text") -> DataFrame:
    """The ledger: measurements, and `failed`, the bits of all rules that the document fails."""
    failed = sum((F.when(F.expr(r.fails), F.lit(BIT[r.name])).otherwise(F.lit(0)).cast("long") for r in RULES[1:]), F.when(F.expr(RULES[0].fails), F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("failed", failed)


def passes(policy: Policy, failed: str | Column = "failed") -> Column:
    """The verdict of a policy on ledger rows."""
    return (F.col(failed) if isinstance(failed, str) else failed).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(ledger: DataFrame, policies: Sequence[Policy] = (BASE, PRODUCTION)) -> DataFrame:
    """Per policy and rule: documents kept by the policy, failing the rule, and kept in addition if the rule is taken out."""
    masks = ledger.groupBy("failed").agg(F.count("*").alias("n"))
    cases = F.array(*[
        F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"), F.lit(p.mask).cast("long").alias("mask"), F.lit(BIT[r]).cast("long").alias("bit"))
        for p in policies for r in p.rules
    ])
    each = masks.select("failed", "n", F.explode(cases).alias("c")).select("failed", "n", "c.*")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return each.groupBy("policy", "rule").agg(
        F.sum(F.when(hit == 0, F.col("n")).otherwise(0)).alias("n_kept"),
        F.sum(F.when(F.col("failed").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only_this_rule"),
        F.bit_or("failed").alias("failed_anywhere"),
    )
