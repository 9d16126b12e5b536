"""Hard negatives, source mixing and whitening against brute force on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hard_negatives, mixing, whitening

EMBEDDINGS = "vec_id long, embedding array<float>, label int, rank int, x string, row long"


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def scaled(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


@pytest.fixture(scope="module")
def vectors():
    """vec_id, embedding, label: null and non-finite parts, copies, ties, repeated and null ids, a label with half of all rows."""
    rng = random.Random(11)
    base = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(420):
        v = [c + rng.choice([0, 0, 0.01, 0.1]) for c in rng.choice(base)]
        rows.append((i, v, 3 if rng.random() < 0.5 else rng.randrange(10)))
    rows += [(500, None, 1), (600, [0.1, None, 0.2], 2), (601, [float("nan")] * 6, 2), (602, [float("inf")] + [0.0] * 5, 2), (700, base[0], None)]
    rows += [(None, base[0], 3), (None, base[0], 4), (None, None, None), (100, base[1], 3), (100, base[1], 5), (7, base[1], 9), (900, [], 3), (901, [0.5], 3), (800, base[2] + [0.3], 8)]
    rows += [(1000 + i, base[3], 77) for i in range(150)]
    return rows


def frame(spark, rows, schema=EMBEDDINGS, parts=3):
    return spark.createDataFrame([(*r, 1, "x", 5) for r in rows], schema).repartition(parts)


def brute_negatives(rows, every=100, k=5):
    kept = []
    for i, v, label in rows:
        if label is not None and usable(v):
            kept.append((i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, scaled(v)))
    score = lambda a, b: sum(p * q for p, q in zip(a, b, strict=False))
    order = lambda c: (-c[0], c[1] is None, c[1] or 0)
    out = []
    for n, (i, label, x) in enumerate(kept):
        if i is None or i % every:
            continue
        others = [(score(x, y), j, other, m) for m, (j, other, y) in enumerate(kept) if m != n]
        for p, j, _, _ in sorted((c for c in others if c[2] == label), key=order)[:k]:
            hard = sorted((c for c in others if c[2] != label and 80 * p <= 100 * c[0] <= 100 * p), key=order)[:k]
            out += [(i, j, rank, h[1], p, h[0]) for rank, h in enumerate(hard, 1)]
    return out


def keyed(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is None, v or 0) for v in r])


@pytest.mark.parametrize("tile_values", [1 << 18, 200])
def test_negatives_equal_brute_force(spark, vectors, tile_values):
    df = hard_negatives.scaled(frame(spark, vectors))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(df, F.col("vec_id") % 100 == 0, label=label, tile_values=tile_values)
    assert keyed(got.collect()) == keyed(brute_negatives(vectors))


def test_negatives_of_nothing(spark):
    assert hard_negatives.mine_embeddings(frame(spark, [])).collect() == []
    assert hard_negatives.mine_embeddings(frame(spark, [(100, [0.5], 1)])).collect() == []
    same = [(i, [0.5], 1) for i in range(1, 7)] + [(100, [0.5], 1)]
    assert hard_negatives.mine_embeddings(frame(spark, same)).collect() == []


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 9), (33, 65, 47), (64, 64, 64), (100, 7, 250)])
def test_strassen_is_exact(shape):
    n, d, m = shape
    rng = np.random.default_rng(3)
    a, b = rng.integers(-1 << 28, 1 << 28, (n, d)), rng.integers(-1 << 28, 1 << 28, (m, d))
    for leaf in (1, 2, 16):
        assert (hard_negatives.strassen(a, b, leaf) == a @ b.T).all()


def test_heaps_merge_to_the_heap_of_all():
    rng = np.random.default_rng(5)
    heap = tuple(rng.integers(0, 6, 300) for _ in range(3))
    heap = (heap[0], np.arange(300), heap[2])
    halves = [hard_negatives.ranked(tuple(c[i::2] for c in heap), 4) for i in (0, 1)]
    for one, two in zip(hard_negatives.merged(*halves, 4), hard_negatives.ranked(heap, 4), strict=True):
        assert (one == two).all()


# -------------------------------------------------------------------- mixing
WORDS = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(12)
    rows = []
    for i in range(400):
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "é", "\U0001f600", "￿", None, "tiny"])
        if source == "tiny" and rng.random() < 0.9:
            source = "a"
        rows.append((i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([0, 1, 7, 40, 300]))), source))
    rows += [(i, "one two\tthree", "few") for i in range(2)] + [(None, None, None), (5, rows[5][1], rows[5][2]), (None, "x y", "blank"), (900, "  ", "void"), (901, "", None)]
    rows += [(902, " ".join(str(i) for i in range(20_000)), "long")] + [(None, "same words here", "copies")] * 60
    return rows


def brute_targets(rows, weights=(1, 2, 3), most=3):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len(WORDS.findall(text or ""))
    names = sorted(size, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(size.values()))
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if share * weight[s] > most * size[s]]
        if not above:
            target |= {s: share * weight[s] for s in open_}
            break
        for s in above:
            target[s] = most * size[s]
            left -= target[s]
            open_.remove(s)
    return size, target


def mixed(spark, rows, parts, **options):
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, source string, target string, row int").repartition(parts)
    return mixing.mix(df, **options)


@pytest.mark.parametrize("block", [1, 16, 256])
def test_mixture_meets_its_targets(spark, sourced, block):
    rows = mixed(spark, sourced, 3, block=block, shard_slots=32).documents.collect()
    size, target = brute_targets(sourced)
    assert Counter((r.doc_id, r.size, r.source) for r in rows) == Counter((i, len(WORDS.findall(t or "")), s) for i, t, s in sourced)
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def test_mixture_does_not_depend_on_partitions(spark, sourced):
    one, two = (Counter(map(tuple, mixed(spark, sourced, n, block=16, shard_slots=8).documents.drop("row").collect())) for n in (1, 7))
    assert one == two


def test_shards_hold_the_words_of_their_spans(spark, sourced):
    m = mixed(spark, sourced, 3, block=16, shard_slots=8, carry=("text",))
    spans, docs = m.spans.collect(), {r.row: r for r in m.documents.collect()}
    want = defaultdict(list)
    for s in sorted(spans, key=lambda s: s.at):
        want[s.shard, s.slot] += WORDS.findall(docs[s.row].text)[s.from_word:s.to_word]
    assert {(r.shard, r.slot): r.text for r in mixing.shard_texts(m).collect()} == {k: " ".join(v) for k, v in want.items()}
    slots = Counter(shard for shard, _ in want)
    assert all(n == 8 for shard, n in slots.items() if shard != max(slots)) and all(len(v) <= 16 for v in want.values())
    assert len({(r.shard, r.slot, r.row) for r in spans}) == len(spans)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97])
def test_permutation_is_a_bijection_with_an_inverse(spark, n):
    size, source, epoch = F.lit(n).cast("long"), F.lit(4).cast("long"), F.lit(1).cast("long")
    to = mixing.permuted(F.col("id"), size, source, epoch, 12)
    back = mixing.permuted(F.col("to"), size, source, epoch, 12, inverse=True)
    rows = spark.range(n).withColumn("to", to).withColumn("back", back).collect()
    assert sorted(r.to for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)
    assert n < 10 or [r.to for r in rows] != list(range(n))


def test_draws_vary_between_shards(spark):
    rows = [(i, "w " * 50, "ab"[i % 2]) for i in range(400)]
    m = mixed(spark, rows, 3, block=10, shard_slots=50)
    own = {r.row: r.source for r in m.documents.collect()}
    counts = defaultdict(Counter)
    for s in m.spans.collect():
        counts[s.shard][own[s.row]] += 1
    shares = [c["a"] for c in counts.values()]
    assert len(set(shares)) > 3 and abs(np.mean(shares) - 50 / 3) < 2 and np.std(shares) < 2 * math.sqrt(50 * 2 / 9)


def test_mixture_of_nothing(spark):
    assert mixed(spark, [], 1).documents.collect() == []
    rows = mixed(spark, [(1, None, None), (2, " ", "a")], 1).documents.collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 2


# ----------------------------------------------------------------- whitening
def test_whitening_equals_a_dense_solver(spark, vectors):
    rows = [(i, v, n) for i, v, n in vectors if v is None or len(v) != 7]
    got = whitening.whiten(frame(spark, rows)).collect()
    kept = [(i, scaled(v) + [0] * (6 - len(v))) for i, v, _ in rows if usable(v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, total = len(fit), fit.sum(axis=0)
    c = fit - total / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n}
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter((i, int(((n * np.array(x) - total) ** 2).sum())) for i, x in kept)
    for k in range(4):
        want = sorted((i is None, i or 0, round(abs(float((np.array(x) - total / n) @ u[:, k] / math.sqrt(e[k]))), 6)) for i, x in kept)
        have = sorted((r.vec_id is None, r.vec_id or 0, round(abs(r.whitened), 6)) for r in got if r.component == k + 1)
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 3e-6 for a, b in zip(want, have, strict=True))
        assert all(r.explained == pytest.approx(e[k] / np.trace(c.T @ c / n), rel=1e-9) for r in got if r.component == k + 1)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_of_little(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [0.5, 0.25], 1), (2, [0.5, 0.25], 1)])).collect() == []
    line = whitening.whiten(frame(spark, [(i, [i / 256, 2 * i / 256], 1) for i in range(5)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 5 and line[0].explained == pytest.approx(1.0)


@pytest.mark.parametrize("seed", range(4))
def test_eigen_solver(seed):
    rng = np.random.RandomState(seed)
    x = rng.randn(200, 5 + 9 * seed)
    cases = [np.cov(x.T), np.eye(6), np.diag([5.0, 5, 5, 1, 0]), np.ones((6, 6)), np.kron(np.eye(2), np.cov(rng.randn(30, 4).T)), np.cov(rng.randn(3, 20).T), np.array([[2.0, 1], [1, 2]])]
    for v in cases:
        k = min(4, len(v))
        e, u = whitening.leading_components(v, k)
        assert np.allclose(e, np.linalg.eigvalsh(v)[::-1][:k], rtol=0, atol=1e-13 * np.abs(v).sum())
        assert np.allclose(u @ u.T, np.eye(k), atol=1e-12) and np.allclose(v @ u.T, u.T * e, atol=1e-12 * np.abs(v).sum())


def test_deviation_beyond_a_long_is_null():
    big = 1 << 40
    assert whitening.deviations(np.array([[big], [0]]), 3, [big]) == [None, None]
    assert whitening.deviations(np.array([[2, 1]]), 3, [3, 3]) == [9]
