"""Queries of the pipeline operators over the given tables, each with its SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candor.llm import (
    bin_completion,
    decontamination,
    filter_audit,
    fixed_blocks,
    language_id,
    lsh_forest,
    piece_codec,
    rule_ledger,
    secret_ledger,
    style_tree,
    token_records,
    toxic_spans,
    vector_codes,
)
from candor.llm.common import held_out, table
from candor.session import scratch_path

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[Run, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = (run, sql)
        return run

    return add


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_records")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Writes all documents as token records, reads the files back and reports what they hold."""
    out = scratch_path(spark, "token_records")
    token_records.write_records(table(spark, folder, "documents"), out, vocabulary("byte_bpe_50k.json"))
    return token_records.write_index(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32", "part", "offset", "length")


_LEDGER_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, k FROM windows GROUP BY doc_id, k HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM windows JOIN twice USING (doc_id, k)) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(list_distinct(ws)) AS n_distinct_words,
    len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_same_as_previous,
    len(regexp_extract_all(t, '\p{L}')) AS n_letters, len(regexp_extract_all(t, '\p{Lu}')) AS n_upper, length(t) - length(replace(t, '!', '')) AS n_exclamations
  FROM w LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, """ + " + ".join(f"(CASE WHEN {r.fails} THEN {rule_ledger.BIT[r.name]} ELSE 0 END)" for r in rule_ledger.RULES) + f""" AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & {rule_ledger.BASE.mask} <> 0 AS base_failed,
  failed & {rule_ledger.PRODUCTION.mask} = 0 AS kept, failed::BIGINT AS failed
FROM f
"""


@query("op2_rule_ledger", _LEDGER_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """The quality ledger of all documents with the verdicts of the base and the production policy."""
    ledger = rule_ledger.evaluate(table(spark, folder, "documents").select("doc_id", "text"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~rule_ledger.passes(rule_ledger.BASE)).alias("base_failed"), rule_ledger.passes(rule_ledger.PRODUCTION).alias("kept"), "failed",
    )


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents, learned from the labelled ones that are not held out."""
    docs = table(spark, folder, "documents")
    return language_id.predict(docs, language_id.train(docs))


def _digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op9_secret_ledger")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents by way of a stored ledger. They land in two batches, of odd and of even checksums; the second only scans what the first did not hold."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = scratch_path(spark, "secret_ledger")
    second = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    secret_ledger.advance(docs.where(~second), path)
    located = secret_ledger.locate(docs, secret_ledger.advance(docs.where(second), path))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in secret_ledger.BASE.rules]))
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return located.select("doc_id", *counts, F.sha2(_digest(base).cast("binary"), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"))


@query("op10_piece_codec")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of all documents and what they decode to."""
    coded = piece_codec.encode(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


@query("op4_toxic_spans")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from the labelled ones that are not held out."""
    docs = table(spark, folder, "documents")
    scored = toxic_spans.score(docs, toxic_spans.train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxic_spans.THRESHOLD).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


@query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold the question and the answer of a benchmark item."""
    return decontamination.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i+34], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE k IN (SELECT k FROM twice)),
removed AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed,
    array_to_string([ws[x] for x in range(1, len(ws) + 1) if ps IS NULL OR NOT list_contains(ps, x)], ' ') AS t
  FROM w LEFT JOIN removed USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(t) AS kept_sha256 FROM kept
"""


@query("op5_fixed_blocks", _REPEATS_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the passages that repeat."""
    kept = fixed_blocks.deduplicate(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op7_style_tree")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, folder, "pages")
    return style_tree.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op6_lsh_forest")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents by their runs of four words."""
    return lsh_forest.near_duplicates(table(spark, folder, "documents"), size=4).drop("text_hash")


def _codebook_rounds(rounds: int) -> str:
    """SQL of the rounds: assignment to the nearest entry, lower index first, then floored means; unused entries stay."""
    far = "list_sum(list_transform(range(1, len(x.v) + 1), lambda j: (x.v[j] - c.v[j]) * (x.v[j] - c.v[j])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, p, min(struct_pack(d := coalesce({far}, 0)::HUGEINT, e := e)) AS best FROM x JOIN c{k} c USING (p) GROUP BY r, p)")
        if k < rounds:
            steps.append(f"""s{k} AS (SELECT p, best.e AS e, j, sum(v[j])::HUGEINT AS s, count(*) AS n FROM (SELECT p, v, best, unnest(range(1, len(v) + 1)) AS j FROM a{k} JOIN x USING (r, p)) GROUP BY ALL),
m{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v FROM s{k} GROUP BY p, e),
c{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, c.v) AS v FROM c{k} c LEFT JOIN m{k} m USING (p, e))""")
    return ",\n".join(steps)


_VECTOR_CODES_SQL = f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS w
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT r, p, w[p * len(w) // 8 + 1 : (p + 1) * len(w) // 8] AS v FROM k, range(8) t(p)),
c0 AS MATERIALIZED (SELECT p, r - 1 AS e, v FROM x WHERE r <= 16),
{_codebook_rounds(6)},
coded AS (SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a6 GROUP BY r),
books AS (SELECT sha256(string_agg(n::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM (SELECT p, e, unnest(v) AS n, unnest(range(len(v))) AS j FROM c6))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT h FROM books) AS codebooks_sha256
FROM k JOIN coded USING (r)
"""


@query("op11_laesa_codes", _VECTOR_CODES_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all whole vectors with their errors, and a digest of the codebooks."""
    coded, books = vector_codes.compress(table(spark, folder, "embeddings"))
    return vector_codes.label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(vector_codes.codebooks_sha256(books)).alias("codebooks_sha256"))


@query("op12_bin_completion")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    packed = bin_completion.pack(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_AUDIT_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part, (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS m
  FROM w),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
g AS MATERIALIZED (
  SELECT part, m, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS bad FROM f LEFT JOIN l USING (doc_id) GROUP BY part, m),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS MATERIALIZED (
  SELECT filter_order, step, letters.bit AS bit, (SELECT coalesce(sum(x.bit), 0) FROM letters x WHERE contains(substr(filter_order, 1, step - 1), x.c))::BIGINT AS before
  FROM orders, range(1, 6) t(step) JOIN letters ON letters.c = substr(filter_order, step, 1)),
r AS (
  SELECT part, filter_order, step, s.bit, sum(n) FILTER (WHERE m & (before | s.bit) = 0) AS kept, sum(n) FILTER (WHERE m & before = 0 AND m & s.bit <> 0) AS removed,
    sum(n) FILTER (WHERE m & before <> 0 AND m & s.bit <> 0) AS redundant, sum(n) FILTER (WHERE m = s.bit) AS unique_fails,
    sum(good) FILTER (WHERE m & before = 0 AND m & s.bit <> 0) AS good_lost, sum(bad) FILTER (WHERE m & before = 0 AND m & s.bit <> 0) AS toxic_lost
  FROM g, steps s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r
"""


@query("op13_filter_audit", _AUDIT_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters removes in each of their 120 orders, per language."""
    failed = filter_audit.failures(table(spark, folder, "documents"))
    return filter_audit.audit(filter_audit.counted(failed, table(spark, folder, "labels")))
