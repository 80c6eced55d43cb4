"""Vector codes, packing and the filter audit against plain versions, and their awkward rows."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from fixtures_llm import FOLDER, documents

from candor.llm import bin_completion as packing
from candor.llm import filter_audit, vector_codes
from candor.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- 11: vector codes ------------------------------------------------------------------------------

def plain_codes(rows, rounds=6, entries=16):
    """(id, code, error) and codebooks of (id, vector) rows, entry by entry with Python integers."""
    rows = sorted(rows)
    vectors = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows]
    n = len(vectors[0][1])
    cuts = [p * n // 8 for p in range(9)]
    parts = [[v[a:b] for _, v in vectors] for a, b in zip(cuts, cuts[1:])]
    books = [[list(x) for x in part[:entries]] for part in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for part, book in zip(parts, books):
            chosen = [nearest(x, book)[1] for x in part]
            for e in range(len(book)):
                own = [x for x, c in zip(part, chosen) if c == e]
                if own:
                    book[e] = [sum(column) // len(own) for column in zip(*own)]
    found = [[nearest(part[k], book) for part, book in zip(parts, books)] for k in range(len(vectors))]
    return [(i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f)) for (i, _), f in zip(vectors, found)], books


def compressed(spark, rows, kind="float", **options):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, to_pivots string, code int, part int")
    coded, books = vector_codes.compress(frame, **options)
    out = vector_codes.label_errors(coded)
    return sorted([tuple(r) for r in out.select("vec_id", "code", "error", "label_error").collect()], key=repr), books


def test_codes_equal_plain_rounds(spark):
    rng = random.Random(4)
    vectors = [[rng.gauss(0, 0.3) for _ in range(24)] for _ in range(120)]
    vectors += vectors[:20] + [[0.0] * 24] * 15
    rows = [(i, [float(np.float32(x)) for x in v], i % 3 or None, "x", 1, 2) for i, v in enumerate(vectors)]
    want, books = plain_codes([(r[0], r[1]) for r in rows])
    got, found = compressed(spark, rows)
    assert [g[:3] for g in sorted(got)] == want
    assert [[list(map(int, e)) for e in b] for b in found] == books
    sums = {label: sum(w[2] for w, r in zip(want, rows) if r[2] == label) for label in (None, 1, 2)}
    assert [g[3] for g in sorted(got)] == [sums[r[2]] for r in rows]
    text = ",".join(str(x) for b in books for e in b for x in e)
    assert vector_codes.codebooks_sha256(found) == hashlib.sha256(text.encode()).hexdigest()
    assert vector_codes.decompress(want[0][1], found) == [x for p, b in enumerate(books) for x in b[int(want[0][1][2 * p : 2 * p + 2], 16)]]


def test_codes_of_awkward_vectors(spark):
    good = [1.0, -2.0, 0.5, 0.25, 3.0, -1.0, 0.0, 8.0]
    rows = [(3, good, 1), (1, None, 1), (2, [math.nan] * 8, 1), (4, [None] + good[1:], 1), (5, [math.inf] + good[1:], 1), (6, good, None), (6, good, None), (None, [0.0] * 8, 2), (7, [1.0], 2), (8, [], 2)]
    got, books = compressed(spark, [(*r, "x", 1, 2) for r in rows])
    # The first vectors are entries themselves, so everything of that length is coded without error; of equal entries the first one counts.
    assert got == sorted([(3, "00" * 8, 0, 0), (6, "00" * 8, 0, 0), (6, "00" * 8, 0, 0), (None, "03030303030300" + "03", 0, 0), (7, None, None, 0), (8, None, None, 0)], key=repr)
    assert [len(b) for b in books] == [4] * 8


def test_codes_of_numbers_beyond_64_bits(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([1e-3, 1.0, 1e20, -1e20, 3e37]) * rng.random() for _ in range(11)]) for i in range(40)]
    want, books = plain_codes(rows, rounds=2, entries=5)
    got, found = compressed(spark, [(i, v, 1, "x", 1, 2) for i, v in rows], "double", rounds=2, entries=5)
    assert [g[1] for g in sorted(got)] == [w[1] for w in want]
    assert [g[2] for g in sorted(got)] == [w[2] if w[2] < 2**63 else None for w in want]
    assert [[list(map(int, e)) for e in b] for b in found] == books


def test_codes_of_nothing(spark):
    assert compressed(spark, []) == ([], [])
    assert compressed(spark, [(1, None, 1, "x", 1, 2)]) == ([], [])


def test_pivots_skip_evaluations_and_change_nothing():
    rng = np.random.default_rng(1)
    part, pivots = rng.integers(-900, 900, (500, 8)), rng.integers(-900, 900, (16, 8))
    book = pivots + rng.integers(-60, 60, (16, 8))
    far = vector_codes.pivot_distances([part], [pivots])
    index, distance, evaluated = vector_codes.nearest(part, far, book, pivots)
    every = ((part[:, None] - book) ** 2).sum(2)
    assert (index == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert evaluated < 0.6 * every.size


# --- 12: packing -----------------------------------------------------------------------------------

def fewest(items, capacity):
    """Exact number of bins by trying all ways."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j, room in enumerate(bins):
            if room >= items[i] and room not in bins[:j]:
                go(i + 1, [*bins[:j], room - items[i], *bins[j + 1 :]])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


def test_completion_is_optimal_where_best_fit_is_not():
    better = 0
    for seed in range(600):
        rng = random.Random(seed)
        capacity = rng.choice([10, 30, 60, 100])
        items = sorted((rng.randint(1, capacity if seed % 2 else capacity // 2) for _ in range(rng.randint(1, 11))), reverse=True)
        counts = np.bincount(items, minlength=capacity + 1)
        patterns = packing.complete(counts)
        held = np.zeros(capacity + 1, int)
        for many, filling in patterns:
            assert sum(length * k for length, k in filling) <= capacity
            for length, k in filling:
                held[length] += many * k
        assert (held == counts).all()
        want, used = fewest(items, capacity), sum(m for m, _ in patterns)
        assert used == want and packing.lower_bound(counts) <= want
        better += sum(m for m, _ in packing.best_fit_decreasing(counts)) > used
    assert better > 0


def test_completion_of_many_pieces_alike():
    # Triples of 4, 3 and 3 fill a sequence of 10; best fit pairs the fours first.
    counts = np.zeros(11, np.int64)
    counts[[3, 4]] = 2_000_000, 1_000_000
    assert sum(m for m, _ in packing.complete(counts)) == 1_000_000
    assert packing.complete(np.zeros(11, np.int64)) == []


def check_packing(rows, docs, capacity, tokenizer):
    """Every document's pieces are right, and every sequence is gapless."""
    want = []
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        first = (len(ids) - 1) % capacity + 1
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert sorted((r[:5] for r in rows), key=repr) == sorted(want, key=repr)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: r[5:7]), key=lambda r: r[5]):
        at = 0
        for *_, length, _, _, offset in group:
            assert offset == at
            at += length
        assert at <= capacity


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def test_packing_of_all_documents(spark, tokenizer):
    rows = [tuple(r) for r in QUERIES["op12_bin_completion"][0](spark, FOLDER).collect()]
    check_packing(rows, documents(spark), 2048, tokenizer)
    assert len({r[5] for r in rows}) == -(-sum(r[3] for r in rows) // 2048)


def test_packing_of_awkward_rows(spark, rows, tokenizer):
    packed = packing.pack(rows.withColumnRenamed("n_chars", "rank").repartition(3), TOKENIZER, capacity=64)
    found = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.sequence_id, r.offset) for r in packed.collect()]
    check_packing(found, [(r.doc_id, r.text) for r in rows.collect()], 64, tokenizer)
    assert packing.pack(rows.limit(0), TOKENIZER).collect() == []


def test_sequences_hold_the_ids(spark, rows):
    packed = packing.pack(rows, TOKENIZER, capacity=64)
    pieces = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    for r in packing.sequences(packed).collect():
        assert bytes(r.ids) == b"".join(bytes(pieces[k]) for k in sorted(pieces) if k[0] == r.sequence_id)
        assert len(r.doc_ids) == sum(k[0] == r.sequence_id for k in pieces)


# --- 13: filter audit ------------------------------------------------------------------------------

def plain_audit(masks, names):
    rows, removed_by = {}, dict.fromkeys(names, 0)
    for order in itertools.permutations(names):
        left = dict(masks)
        for step, name in enumerate(order, 1):
            bit = 1 << names.index(name)
            gone = [left.pop(m) for m in list(left) if m & bit]
            removed = sum(c[0] for c in gone)
            fails = sum(c[0] for m, c in masks.items() if m & bit)
            rows["".join(order), step] = [sum(c[0] for c in left.values()), removed, fails - removed, masks.get(bit, (0,))[0], sum(c[1] for c in gone), sum(c[2] for c in gone), name]
            removed_by[name] += removed
    return {key: (*row[:-1], removed_by[row[-1]]) for key, row in rows.items()}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_diagram_equals_replaying_the_orders(n):
    names = "ABCDE"[:n]
    for seed in range(8):
        rng = random.Random(seed)
        masks = {m: (rng.randint(1, 9), rng.randint(0, 3), rng.randint(0, 3)) for m in range(2**n) if rng.random() < (0.1, 0.3, 0.6, 1.0)[seed % 4]}
        rows = filter_audit.audit_part(masks or {0: (1, 0, 0)}, names)
        assert {(order, step): tuple(rest) for order, step, *rest in rows} == plain_audit(masks or {0: (1, 0, 0)}, names)
        assert len(rows) == n * math.factorial(n)


def test_swaps_keep_the_diagram_reduced():
    rng = random.Random(5)
    masks = {m: (rng.randint(1, 9),) for m in rng.sample(range(32), 20)}
    diagram = filter_audit.Diagram(masks, 5)
    seen = {tuple(diagram.order)}
    for level in filter_audit.neighbour_swaps(5):
        diagram.swap(level)
        seen.add(tuple(diagram.order))
        fresh = filter_audit.Diagram(masks, 5)
        fresh.order = list(diagram.order)
        fresh.known, fresh.nodes, fresh.counts = [{} for _ in range(5)], [None], [fresh.zero]
        fresh._build(masks, 0)
        assert [len(t) for t in diagram.known] == [len(t) for t in fresh.known]
    assert len(seen) == 120


def test_failures_of_awkward_rows(spark, rows):
    got = sorted(((r.doc_id, r.part, r["mask"]) for r in filter_audit.failures(rows).collect()), key=repr)
    source = [(r.doc_id, r.lang or "", r.text or "") for r in rows.collect()]
    want = []
    for doc_id, part, text in source:
        words = text.encode().split()
        fails = (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text), any(c in "#$%&*|" for c in text),
            doc_id is not None and any(i is not None and i < doc_id and t == text for i, _, t in source),
        )
        want.append((doc_id, part, sum(1 << k for k, f in enumerate(fails) if f)))
    assert got == sorted(want, key=repr)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 0, 1, "x"), (2, None, None, None), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, mask string")
    counts = filter_audit.counted(filter_audit.failures(rows), labels)
    assert tuple(counts.groupBy().sum("n", "good", "toxic").first()) == (len(source), 1, 1)
    assert filter_audit.audit(filter_audit.counted(filter_audit.failures(rows.limit(0)), labels)).collect() == []


def test_words_of_long_texts_are_counted_across_runs():
    text = b" ".join(b"w%d" % (i % 1000) for i in range(2_000_000)) + b"\x85x\xa0y"
    assert len(text) > 2 * (4 << 20)
    assert filter_audit._words(text) == (2_000_000, 1001)
