"""Operators that compare documents, the pipeline, and the queries that have SQL."""

import re
from collections import Counter, defaultdict

import pytest
from fixtures_llm import FOLDER, documents, sha
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from candor.llm import fixed_blocks, language_id, lsh_forest
from candor.llm.components import components
from candor.llm.queries import QUERIES
from candor.plans.registry import Query


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_against_sql(spark, connection, name):
    message, _, _, count = compare(spark, connection, name, Query(*QUERIES[name]), FOLDER)
    assert message is None, message
    assert count > 0


# --- 5: fixed blocks -------------------------------------------------------------------------------

def without_repeats(texts, window=35):
    split = [words(t) for t in texts]
    times = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    for w in split:
        gone = {p for i in range(len(w) - window + 1) if times[tuple(w[i : i + window])] > 1 for p in range(i, i + window)}
        yield len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)


def test_repeats_with_many_chunks_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(fixed_blocks, "CHUNK_BYTES", 1 << 16)
    monkeypatch.setattr(fixed_blocks, "RANGE_HASHES", 1 << 13)
    docs = documents(spark)
    got = {r.doc_id: (r.n_words, r.n_removed, sha(r.kept)) for r in fixed_blocks.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: (n, k, sha(t)) for (i, _), (n, k, t) in zip(docs, without_repeats([t for _, t in docs]))}


def test_repeats_of_awkward_rows(spark, rows):
    data = [(r.doc_id, r.text) for r in rows.collect()]
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in fixed_blocks.deduplicate(rows).collect())
    assert got == sorted((i or 0, *x) for (i, _), x in zip(data, without_repeats([t for _, t in data])))
    assert fixed_blocks.deduplicate(rows.limit(0)).collect() == []


@pytest.mark.parametrize("n, gone", [(34, 0), (35, 35), (36, 36), (60, 60)])
def test_edge_of_the_window(spark, n, gone):
    passage = " ".join(f"p{i}" for i in range(n))
    docs = [(1, "a b c " + passage + " d"), (2, "\n" + passage.replace(" ", "\t\n") + " e f"), (3, " ".join(f"q{i}" for i in range(90)))]
    got = {r.doc_id: r.n_removed for r in fixed_blocks.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: gone, 2: gone, 3: 0}


# --- 6: near duplicates ----------------------------------------------------------------------------

def groups(docs, size):
    sets = {}
    for i, t in docs:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    inverted, smallest = defaultdict(list), {i: i for i in sets}

    def root(i):
        while smallest[i] != i:
            i = smallest[i]
        return i

    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in inverted[x]).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = sorted((root(i), root(j)))
                smallest[b] = a
        for x in s:
            inverted[x].append(i)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("limit", [1 << 25, 1 << 13])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, limit):
    monkeypatch.setattr(lsh_forest, "GROUP_BYTES", limit)
    docs = documents(spark)
    base = [f"v{i}" for i in range(120)]
    # A star: copies that are near the middle one, but not each other, and a chain.
    for k in range(12):
        star = list(base)
        for j in range(3):
            star[(5 * k + 40 * j) % 120] = f"changed{k}{j}"
        docs.append((10_000 - k, " ".join(star)))
    docs.append((20_000, " ".join(base)))
    for k in range(8):
        docs.append((30_000 + k, " ".join(f"c{i}" for i in range(6 * k, 6 * k + 130))))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == groups(docs, 4)


def test_near_duplicates_of_awkward_rows(spark, rows):
    got = lsh_forest.near_duplicates(rows).collect()
    assert len(got) == rows.count()
    assert all(r.kept and r.component_id == r.doc_id for r in got if r.n_shingles == 0 or r.doc_id is None)
    assert {(r.doc_id, r.component_id) for r in got if r.doc_id in (7, 8)} == {(7, 7), (8, 7)}
    assert lsh_forest.near_duplicates(rows.limit(0)).collect() == []


def test_components(spark):
    edges = [(9, 8), (8, 7), (7, 6), (1, 2), (5, 5), (30, 29), (29, 28), (28, 1)] + [(100, 100 + k) for k in range(50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {9: 6, 8: 6, 7: 6, 6: 6, 1: 1, 2: 1, 28: 1, 29: 1, 30: 1} | {100 + k: 100 for k in range(50)}


# --- pipeline --------------------------------------------------------------------------------------

def test_stages_keep_rows_and_columns(spark, rows):
    docs = rows.withColumn("component_id", F.lit("mine")).withColumn("text_hash", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.dtypes == docs.dtypes, name
        out.collect()
        assert stage(spark, docs.limit(0), FOLDER).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_one_of_each_group_stays(spark):
    docs = [(5, "a b c d e f"), (5, "A B c d e f"), (5, "q w e r t z u"), (6, "q w e r t z u"), (None, "q w e r t z u"), (None, "q w e r t z u"), (8, "a b c d e f"), (9, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in lsh_forest.keep_first(df.union(df.where("doc_id = 6"))).collect())
    assert got == [(0, "q w e r t z u"), (0, "q w e r t z u"), (5, "A B c d e f"), (5, "a b c d e f"), (5, "q w e r t z u"), (9, "")]


def test_pipeline_equals_a_plain_version(spark):
    from candor.llm.queries import vocabulary
    from sentencepiece import SentencePieceProcessor

    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    known = {r.doc_id for r in language_id.predict(table, language_id.train(table)).where(f"score >= {corpus_pipeline.LEAST_SCORE}").collect()}
    docs = [(i, t) for i, t in documents(spark) if i in known]
    first = groups(docs, 5)
    docs = [(i, t) for i, t in docs if first[i][1] == i]

    def norm(t):
        return f" {' '.join(re.findall(r'[^\W_]+', t.lower()))} "

    items = [norm(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if not any(x in norm(t) for x in items)]
    library = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    secret = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}""", re.A)
    want = {i: library.encode(secret.sub("[secret]", t), add_eos=True) for i, t in docs}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()} == want
