"""Operator 11: hard-negative mining with Strassen products of int64 tiles and mergeable heaps.

Every row is an integer vector with a label. An anchor's positives are its best rows of the same label; the negatives
of an anchor and one of its positives are the best rows of another label whose score lies in the window from four
fifths of the positive's score to the positive's score. A score is the integer inner product with the anchor, and
equal scores are ordered by the smaller id.

Rows are numbered in the order of their label and cut into groups of a bounded number of values, anchors likewise into
bands. A tile is one band against one group: a task multiplies it by Strassen's recursion (seven products of half the
size, odd sizes padded with zeros, sums exact in int64) and keeps a heap of the best entries of each anchor. Heaps of
tiles are merged by rank. The first pass multiplies only rows of equal labels and finds the positives; the second
finds, for each window, the best rows of other labels. Label order keeps the first pass to the few groups that hold a
label, and a hot label is simply many groups.

Rows with a null label, a null vector or a null or non-finite component take no part. Repeated rows and repeated ids
are rows of their own. A row without an id is never an anchor and comes last among equal scores; remaining ties are
identical in the result. Vectors of different lengths are compared as if the shorter went on with zeros. Scores are
64-bit integers (they wrap beyond). Other columns of the input are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ordering import numbered

from .common import stage

#: Values (rows times dimension) of one side of a tile.
TILE_VALUES = 1 << 18
#: Sizes up to which a product is taken directly.
LEAF = 32
_LEAST = np.iinfo(np.int64).min


# ------------------------------------------------------------------- tiles
def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b.T`` of int64 matrices by Strassen's recursion; sizes that are odd are padded with a row or column of zeros."""
    (n, d), m = a.shape, b.shape[0]
    if min(n, d, m) <= leaf:
        return a @ b.T
    odd = [(n & 1, d & 1), (m & 1, d & 1)]
    if any(odd[0]) or any(odd[1]):
        a, b = (np.pad(x, ((0, r), (0, c))) for x, (r, c) in zip((a, b), odd, strict=True))
        return strassen(a, b, leaf)[:n, :m]
    h, k, w = n // 2, d // 2, m // 2
    a11, a12, a21, a22 = a[:h, :k], a[:h, k:], a[h:, :k], a[h:, k:]
    b11, b21, b12, b22 = b[:w, :k], b[:w, k:], b[w:, :k], b[w:, k:]  # quarters of b.T, each kept transposed
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((n, m), np.int64)
    out[:h, :w] = p1 + p4 - p5 + p7
    out[:h, w:] = p3 + p5
    out[h:, :w] = p2 + p4
    out[h:, w:] = p1 - p2 + p3 + p6
    return out


def ranked(heap: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    """The first ``k`` entries of each owner of a heap (owner, place, score): higher scores, then smaller places."""
    owner, place, score = heap
    order = np.lexsort((place, ~score, owner))
    owner, place, score = owner[order], place[order], score[order]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    return owner[rank < k], place[rank < k], score[rank < k]


def merged(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    return ranked(tuple(np.concatenate(x) for x in zip(one, two, strict=True)), k)


def leading(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Heap of the best ``k`` allowed entries of each row of a tile, the column being the place."""
    if scores.shape[1] > k:
        masked = np.where(allowed, scores, _LEAST)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, -k]
        allowed = allowed & (masked >= least[:, None])
    owner, place = np.nonzero(allowed)
    return ranked((owner, place, scores[owner, place]), k)


def matrix(column: pa.Array, d: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column as an int64 matrix, shorter lists padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    d = max(int(sizes.max(initial=0)), d or 0)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == d).all():
        return flat.reshape(len(sizes), d)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d)[None, :] < sizes[:, None]] = flat
    return out


def _both(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Matrices of both sides, and the rows in the order of their ids (rows without one last)."""
    ids = rows["vec_id"].combine_chunks() if isinstance(rows["vec_id"], pa.ChunkedArray) else rows["vec_id"]
    none = ids.is_null().to_numpy(zero_copy_only=False)
    order = np.lexsort((rows["row"].to_numpy(), ids.fill_null(0).to_numpy(), none))
    rows = rows.take(pa.array(order))
    x, y = matrix(anchors["x"]), matrix(rows["x"])
    d = max(x.shape[1], y.shape[1])
    return matrix(anchors["x"], d), matrix(rows["x"], d), rows


_NO_HEAP = (np.zeros(0, np.int64),) * 3


def tile_positives(k: int, step: int = 256):
    """Cogrouped function: the best ``k`` other rows of its label for each anchor of a tile."""
    def tile(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        x, y, rows = _both(anchors, rows)
        own, theirs = anchors["row"].to_numpy(), rows["row"].to_numpy()
        label, other = anchors["label"].to_numpy(), rows["label"].to_numpy()
        heap = _NO_HEAP
        for value in np.intersect1d(label, other):
            columns = np.flatnonzero(other == value)
            mine = np.flatnonzero(label == value)
            for i in range(0, len(mine), step):
                part = mine[i:i + step]
                scores = strassen(x[part], y[columns])
                found = leading(scores, own[part][:, None] != theirs[columns][None, :], k)
                heap = merged(heap, (part[found[0]], columns[found[1]], found[2]), k)
        owner, place, score = heap
        return pa.table({"anchor": own[owner], "other": theirs[place], "other_id": rows["vec_id"].take(pa.array(place)), "score": score})

    return tile


def tile_negatives(k: int, step: int = 256):
    """Cogrouped function: the best ``k`` rows of other labels inside each window of each anchor of a tile."""
    def tile(key: tuple, anchors: pa.Table, rows: pa.Table) -> pa.Table:
        x, y, rows = _both(anchors, rows)
        own, theirs = anchors["row"].to_numpy(), rows["row"].to_numpy()
        label, other = anchors["label"].to_numpy(), rows["label"].to_numpy()
        windows = [np.asarray(w, np.int64) for w in anchors["windows"].to_pylist()]
        most = max((len(w) for w in windows), default=0)
        parts = []
        for i in range(0, len(own), step):
            scores = strassen(x[i:i + step], y)
            apart = label[i:i + step][:, None] != other[None, :]
            for number in range(most):
                having = np.array([j for j in range(len(scores)) if number < len(windows[i + j])], np.int64)
                if not len(having):
                    continue
                high = np.array([windows[i + j][number] for j in having])[:, None]
                inside = scores[having]
                allowed = apart[having] & (inside <= high) & (inside >= high - high // 5)  # 80 high <= 100 score <= 100 high
                owner, place, score = leading(inside, allowed, k)
                parts.append((own[i + having[owner]], np.full(len(owner), number), theirs[place], place, score))
        anchor, number, row, place, score = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 5
        return pa.table({"anchor": anchor, "number": pa.array(number, pa.int32()), "other": row,
                         "other_id": rows["vec_id"].take(pa.array(place)), "score": score})

    return tile


# ------------------------------------------------------------------- tables
def finite(vector: Column) -> Column:
    """Is the vector there, without null or non-finite components?"""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _bounds(df: DataFrame, of: str) -> DataFrame:
    """First and last ``of`` of each label."""
    return df.groupBy("label").agg(F.min(of).alias(f"{of}_first"), F.max(of).alias(f"{of}_last"))


def _by_label(df: DataFrame, bounds: DataFrame, salts: int = 32) -> DataFrame:
    """Join with one row per label; a hot label is spread over ``salts`` keys."""
    spread = bounds.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("salt", F.pmod("row", F.lit(salts)).cast("int")).join(spread, ["label", "salt"]).drop("salt")


def _first(df: DataFrame, by: list[str], k: int) -> DataFrame:
    """Merge the heaps of all tiles: the first ``k`` of each key."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, vec_id: str = "vec_id", vector: str = "embedding",
         label: str | Column = "label", tile_values: int = TILE_VALUES) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vector`` holds the integer components (see :func:`scaled`). ``is_anchor`` picks the anchors among the rows.
    """
    spark = vectors.sparkSession
    name = label if isinstance(label, Column) else F.col(label)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), name.cast("long").alias("label"), F.col(vector).alias("x"),
                          F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull())
    rows = rows.withColumns({"h": F.xxhash64("x"), "tie": F.monotonically_increasing_id()})
    rows = numbered(rows, ["label", "vec_id", "h", "tie"], "row").drop("h", "tie")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d"), F.count_if("is_anchor").alias("anchors")).first()
    side = max(16, tile_values // max(1, size["d"] or 1))
    rows = stage(rows.withColumn("group", F.expr(f"row div {side}")), "negatives-rows")
    anchors = numbered(rows.where("is_anchor").select("row", "vec_id", "label", "x"), ["label", "row"], "place")
    anchors = anchors.withColumn("band", F.expr(f"place div {side}")).drop("place")
    n_groups, n_bands = -(-size["n"] // side), -(-size["anchors"] // side)

    groups, bands = _bounds(rows, "group"), _bounds(anchors, "band")
    anchors = stage(_by_label(anchors, groups), "negatives-anchors")
    to_groups = anchors.withColumn("group", F.explode(F.sequence("group_first", "group_last"))).select("band", "group", "row", "label", "x")
    to_bands = _by_label(rows, bands).withColumn("band", F.explode(F.sequence("band_first", "band_last"))).select("band", "group", "row", "vec_id", "label", "x")
    found = to_groups.groupBy("band", "group").cogroup(to_bands.groupBy("band", "group")).applyInArrow(
        tile_positives(positives), "anchor long, other long, other_id long, score long")
    best = stage(_first(found, ["anchor"], positives), "negatives-positives")

    windows = best.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("w"))
    asking = anchors.join(windows.select("row", F.col("w.score").alias("windows")), "row")
    to_groups = asking.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_groups - 1)).cast("long"))))
    to_groups = to_groups.where((F.col("group") <= F.col("group_first")) | (F.col("group") >= F.col("group_last"))).select("band", "group", "row", "label", "x", "windows")
    to_bands = rows.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(max(0, n_bands - 1)).cast("long")))).select("band", "group", "row", "vec_id", "label", "x")
    found = to_groups.groupBy("band", "group").cogroup(to_bands.groupBy("band", "group")).applyInArrow(
        tile_negatives(negatives), "anchor long, number int, other long, other_id long, score long")
    hard = _first(found, ["anchor", "number"], negatives)
    hard = hard.select("anchor", (F.col("number") + 1).alias("of"), "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    chosen = best.select("anchor", F.col("rank").alias("of"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return hard.join(chosen, ["anchor", "of"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def scaled(vectors: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """Rows with a usable vector, each component x (as a double) as the integer floor(scale * x)."""
    kept = vectors.where(finite(F.col(vector)))
    return kept.withColumn(vector, F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def mine_embeddings(embeddings: DataFrame, relabel_every: int = 7, anchor_every: int = 100) -> DataFrame:
    """The benchmark's setting: every seventh id gets the next label as noise, every hundredth id is an anchor."""
    label = F.col("label").cast("long")
    noisy = F.when(F.col("vec_id") % relabel_every == 0, (label + 1) % 10).otherwise(label)
    return mine(scaled(embeddings.select("vec_id", "label", "embedding")), F.col("vec_id") % anchor_every == 0, label=noisy)
