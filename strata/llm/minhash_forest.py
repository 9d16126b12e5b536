"""Operator 2: near-duplicate documents by an LSH forest over MinHash signatures.

A document's set is its distinct ``SHINGLE``-word shingles (all words as one if it has
fewer). Documents with equal sets are one node. Each node's signature of
``ORDERS * DEPTH`` minima is sorted in ``ORDERS`` ways, each beginning with other
components. In a sorted order, nodes that share the first ``DEPTH`` components form a
region; neighbours in it, the ones with the longest common prefix, are candidates.

Candidates are confirmed on the full sets, in four passes, so that a large group of
copies never becomes all its pairs:

1. each node's neighbour with the longest common prefix;
2. the other neighbours that are still in different components;
3. in regions that still hold several components, all members whose signatures agree
   often enough with one of another component, against each other, inside the region's
   task;
4. the nodes of mixed regions of more than ``region`` nodes, by a prefix-filter join of their
   full sets: whatever shares one of its rarest shingles with another component is
   compared with all that such shingles join it to, block by block.

Components are found by contracting edges towards the node of smaller rank. Ranks are
hashes drawn anew each round (neighbours are sorted by id, so ids would make long chains in
order), so the graph shrinks by a constant factor a round whatever its shape. The last
``REST`` edges, a bounded rest, are joined by one task instead of a tail of small rounds.

Documents without words (null, empty or blank text) have no set and link with
nothing. Rows that repeat a doc_id are documents of their own. A null doc_id counts as
no smallest id: a component of null ids only has a null component_id and kept is false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, U64, chunks, mix, stage, text_bytes, tidy, words

SHINGLE = 5
PERCENT = 75
ORDERS = 24
DEPTH = 3
SIZE = 96
#: Components beyond the region prefix that a forest row keeps.
FURTHER = 4
#: Signature agreement from which a pair is confirmed in the later passes: 4.5 standard deviations below PERCENT.
AGREE = 53
#: Edges between components from which on one task finishes a contraction.
REST = 50_000
#: Nodes for each task that writes an intermediate table, so that a small input is not cut into hundreds of tiny files.
NODES_PER_TASK = 2_000
#: Hash ranges whose counts order the shingles of over-full regions by frequency.
RANKS = 1 << 18
_RNG = np.random.default_rng(20240229)
_FACTORS = _RNG.integers(1, 1 << 63, SIZE, dtype=np.uint64) * U64(2) + U64(1)
_TERMS = _RNG.integers(0, 1 << 63, SIZE, dtype=np.uint64)
_PLACES = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64))


def shingle_sets(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each of several texts."""
    hashes, _, _, bounds = words(raw, offsets, SPACE_WORD, lower=True)
    n = len(hashes)
    total = np.zeros(n, U64)
    for j in range(min(SHINGLE, n)):
        total[:n - j] += mix(hashes[j:] + _PLACES[j])
    grams = mix(total)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        size = b - a
        if size >= SHINGLE:
            out.append(np.unique(grams[a:b - SHINGLE + 1]))
        elif size:
            out.append(mix(np.array([sum(int(mix(hashes[a + j:a + j + 1] + _PLACES[j])[0]) for j in range(size)) & (2**64 - 1)], U64) + U64(size)))
        else:
            out.append(grams[:0])
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """SIZE minima of the set, 16 bits of each."""
    least = np.full(SIZE, np.iinfo(np.uint64).max, U64)
    for i in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[i:i + 2048, None] * _FACTORS + _TERMS).min(axis=0))
    return (mix(least) >> U64(48)).astype(np.uint16)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    import xxhash

    return xxhash.xxh3_128_digest(shingles.tobytes())


def describe(docs: DataFrame, text: str = "text", doc: str = "doc_id", row: str | None = None) -> DataFrame:
    """doc_id, row (the binary column of that name, or null), n_shingles, node (null without words) and signature of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            sizes, keys, marks = [], [], []
            for i, j in chunks(offsets):
                for s in shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]):
                    sizes.append(len(s))
                    keys.append(set_key(s) if len(s) else None)
                    marks.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())],
                                             ["doc_id", "row", "n_shingles", "node", "signature"])

    key = (F.col(row) if row else F.lit(None)).cast("binary").alias("row")
    slim = docs.select(F.col(doc).cast("long").alias("doc_id"), key, F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(tidy(run), "doc_id long, row binary, n_shingles long, node binary, signature binary")


def forest_rows(nodes: DataFrame) -> DataFrame:
    """One row per node and order: ``region`` (order and first components), ``rest`` (the next ones), node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = np.stack([(np.arange(DEPTH + FURTHER) + t * SIZE // ORDERS) % SIZE for t in range(ORDERS)])
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                marks = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, SIZE)[:, columns].astype(np.int64)
                region = np.broadcast_to(np.arange(ORDERS)[None, :], marks.shape[:2])
                for d in range(DEPTH):
                    region = (region << 16) | marks[:, :, d]
                rest = np.zeros(marks.shape[:2], np.int64)
                for d in range(DEPTH, DEPTH + FURTHER):
                    rest = (rest << 16) | marks[:, :, d]
                node = part.column("node").take(pa.array(np.repeat(np.arange(len(marks)), ORDERS)))
                yield pa.RecordBatch.from_arrays([pa.array(region.ravel()), pa.array(rest.ravel()), node], ["region", "rest", "node"])

    return nodes.select("node", "signature").mapInArrow(tidy(run), "region long, rest long, node binary")


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the FURTHER components agree from the first on."""
    differ = (a ^ b).view(np.uint64)
    out = np.zeros(len(a), np.int32)
    for d in range(1, FURTHER + 1):
        out += (differ >> U64(16 * (FURTHER - d))) == 0
    return out


def sorted_neighbours(rows: DataFrame, partitions: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of neighbours in the sorted orders (a, b, depth) and the members of regions with two or more nodes.

    The orders are one range-partitioned sort, so a large region is cut over several tasks; the rows at
    the cuts are compared afterwards.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, first = TaskContext.get().partitionId(), None, True
        names = ["kind", "part", "region", "rest", "node", "other", "depth"]

        def made(kind: str, table: pa.RecordBatch, other=None, depth=None) -> pa.RecordBatch:
            n = table.num_rows
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.string()), pa.array([part] * n, pa.int32()), table.column(0), table.column(1), table.column(2),
                 other if other is not None else pa.nulls(n, pa.binary()), pa.array(depth, pa.int32()) if depth is not None else pa.nulls(n, pa.int32())], names)

        def cleared(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            """Emit all rows but the last one, which may have a neighbour in the next batch."""
            nonlocal first
            batch = table.combine_chunks().to_batches()[0]
            region, rest, n = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.num_rows
            same = region[1:] == region[:-1]
            pairs = np.flatnonzero(same)
            if len(pairs):
                yield made("pair", batch.take(pa.array(pairs)), batch.column(2).take(pa.array(pairs + 1)), DEPTH + common_prefix(rest[pairs], rest[pairs + 1]))
            member = np.zeros(n, bool)
            member[:-1] |= same
            member[1:] |= same
            member[0] |= not first and held_member
            out = np.flatnonzero(member[:n if last else n - 1])
            if len(out):
                yield made("member", batch.take(pa.array(out)))
            if first:
                yield made("first", batch.slice(0, 1))
                first = False
            if last:
                yield made("last", batch.slice(n - 1, 1))

        held_member = False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            yield from cleared(table, False)
            region = table.column(0)
            held_member = table.num_rows > 1 and region[-1].as_py() == region[-2].as_py() or (table.num_rows == 1 and held_member)
            held = batch.slice(batch.num_rows - 1, 1)
        if held is not None:
            yield from cleared(pa.Table.from_batches([held]), True)

    ordered = rows.repartitionByRange(partitions, "region", "rest", "node").sortWithinPartitions("region", "rest", "node")
    found = stage(ordered.mapInArrow(tidy(run), "kind string, part int, region long, rest long, node binary, other binary, depth int"), "forest")
    ends = found.where("kind in ('first', 'last')")
    firsts, lasts = ends.where("kind = 'first'"), ends.where("kind = 'last'")
    after = firsts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next_part"))  # one row per partition
    cut = (lasts.select("part", "region", "rest", F.col("node").alias("a")).join(after, "part")
           .join(firsts.select(F.col("part").alias("next_part"), "region", F.col("rest").alias("next_rest"), F.col("node").alias("b")), ["next_part", "region"]))
    agree = sum(F.when(F.shiftright(F.col("rest").bitwiseXOR(F.col("next_rest")), 16 * (FURTHER - d)) == 0, 1).otherwise(0) for d in range(1, FURTHER + 1))
    pairs = found.where("kind = 'pair'").select(F.col("node").alias("a"), F.col("other").alias("b"), "depth").unionByName(
        cut.select("a", "b", (F.lit(DEPTH) + agree).cast("int").alias("depth")))
    members = found.where("kind = 'member'").select("region", "rest", "node").unionByName(
        cut.select("region", "rest", F.col("a").alias("node"))).unionByName(cut.select("region", F.col("next_rest").alias("rest"), F.col("b").alias("node")))
    ordered_pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "depth")
    return ordered_pairs.groupBy("a", "b").agg(F.max("depth").alias("depth")), members.dropDuplicates(["region", "node"])


def sets_of(docs: DataFrame, needed: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """node and its full set, for the nodes in ``needed`` (doc, node): their documents are read again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_bytes(batch.column("text"))
            for i, j in chunks(offsets, 1 << 20):
                found = [s for s in shingle_sets(raw[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in found], pa.binary()), pa.array([s.tobytes() for s in found], pa.binary())],
                                                 ["node", "shingles"])

    slim = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = needed.select("doc").distinct()
    return slim.join(wanted, slim["doc_id"].eqNullSafe(wanted["doc"]), "left_semi").select("text").mapInArrow(tidy(run), "node binary, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are alike: 100 * intersection >= PERCENT * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
                both = np.concatenate([p, q])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= PERCENT * (len(p) + len(q) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    full = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))
    return full.select("a", "b", "x", "y").mapInArrow(tidy(run), "a binary, b binary")


def stage_in(df: DataFrame, name: str, tasks: int | None) -> DataFrame:
    """:func:`stage` written by ``tasks`` tasks at most (None: by as many as there are partitions)."""
    return stage(df.coalesce(tasks) if tasks else df, name)


def joined(edges: DataFrame) -> DataFrame:
    """a and one node m of its component, for all nodes of a bounded number of edges, in one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("a", pa.binary()), ("b", pa.binary())]))
        ends = pa.chunked_array([*table.column("a").chunks, *table.column("b").chunks], pa.binary()).combine_chunks().dictionary_encode()
        at = ends.indices.to_numpy(zero_copy_only=False)
        a, b, root = at[:len(at) // 2], at[len(at) // 2:], np.arange(len(ends.dictionary))
        while True:
            low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(root, high[open_], low[open_])
            while (root[root] != root).any():
                root = root[root]
        yield pa.RecordBatch.from_arrays([ends.dictionary, ends.dictionary.take(pa.array(root))], ["a", "m"])

    return edges.coalesce(1).mapInArrow(tidy(run), "a binary, m binary")


def contract(edges: DataFrame, labels: DataFrame | None, tasks: int | None = None, rest: int = REST) -> DataFrame:
    """Node and the component it belongs to after ``edges`` (a, b) between earlier components are joined.

    ``labels`` (node, label) holds earlier contractions; nodes in neither are components of their own.
    ``edges`` is worked out once. Rounds go on until at most ``rest`` edges are left.
    """
    edges = stage_in(edges.select("a", "b"), "edges", tasks)
    left = edges.count()
    if not left and labels is not None:
        return labels
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    fresh = nodes.select("node", F.col("node").alias("label"))
    if labels is not None:
        fresh = labels.unionByName(fresh.join(labels.select(F.col("label").alias("node")).distinct(), "node", "left_anti"))
    labels, turn = fresh, 0
    while left:
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("rank"), F.col(c).alias("id"))
        whole = left <= rest
        step = joined(edges) if whole else both.groupBy("a").agg(F.min(rank("b")).alias("m")).select("a", F.least(rank("a"), "m")["id"].alias("m"))
        step = stage_in(step, "step", tasks)
        turn += 1
        labels = stage_in(labels.join(step, labels["label"] == step["a"], "left").select("node", F.coalesce("m", "label").alias("label")), "labels", tasks)
        if whole:
            break
        one = edges.join(step.withColumnRenamed("m", "ma"), "a")
        two = one.join(step.select(F.col("a").alias("b"), F.col("m").alias("mb")), "b")
        edges = stage_in(two.where("ma != mb").select(F.least("ma", "mb").alias("a"), F.greatest("ma", "mb").alias("b")).distinct(), "edges", tasks)
        left = edges.count()
    return labels


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components, with both labels."""
    left = pairs.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
    both = left.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    out = both.withColumns({"la": F.coalesce("la", "a"), "lb": F.coalesce("lb", "b")})
    return out.where("la != lb")


def alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree in AGREE components or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SIZE) for c in ("p", "q"))
                yield batch.drop_columns(["p", "q"]).filter(pa.array((p == q).sum(axis=1) >= AGREE))

    marked = (pairs.select("a", "b").join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("p")), "a")
              .join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("q")), "b"))
    return marked.select("a", "b", "p", "q").mapInArrow(tidy(run), "a binary, b binary")


def mixed_regions(members: DataFrame, labels: DataFrame, region: int, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Members (region, node, label) of regions that still hold several components, and the nodes (node, label) of
    those among them that have more than ``region`` nodes."""
    named = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = stage_in(named.select("region", "node", "label"), "members", tasks)
    sizes = named.groupBy("region").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").drop("lo", "hi")
    mixed = named.join(sizes, "region")
    return mixed.where(F.col("n") <= region).drop("n"), stage_in(mixed.where(F.col("n") > region).select("node", "label").distinct(), "overfull", tasks)


def rarest_first(full: DataFrame) -> np.ndarray:
    """How often the shingles of each of RANKS hash ranges occur in the sets: a bounded stand-in for their frequency."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(RANKS, np.int64)
        for batch in batches:
            for v in batch.column("shingles"):
                at, n = np.unique(np.frombuffer(v.as_buffer(), U64) % U64(RANKS), return_counts=True)
                seen[at.astype(np.int64)] += n
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "n"])

    seen = full.select("shingles").mapInArrow(tidy(run), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(RANKS, np.int64)
    out[seen.column("at").to_numpy()] = seen.column("n").to_numpy()
    return out


def prefixes(full: DataFrame) -> DataFrame:
    """shingle, node, label: of each set so many of its rarest shingles that two alike sets share one of them."""
    counts = full.sparkSession.sparkContext.broadcast(rarest_first(full))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counts.value
        for batch in batches:
            for i in range(batch.num_rows):
                s = np.frombuffer(batch.column("shingles")[i].as_buffer(), U64)
                order = np.lexsort((s, seen[(s % U64(RANKS)).astype(np.int64)]))
                rare = s[order[:len(s) - (len(s) * PERCENT + 99) // 100 + 1]]
                at = pa.array(np.zeros(len(rare), np.int64))
                row = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([pa.array(rare.view(np.int64)), row.column("node").take(at), row.column("label").take(at)], ["shingle", "node", "label"])

    return full.select("node", "label", "shingles").mapInArrow(tidy(run), "shingle long, node binary, label binary")


def overfull_blocks(over: DataFrame, sets: DataFrame, region: int, tasks: int | None = None) -> DataFrame:
    """Members (cluster, one, two, node, label) of block pairs in which all alike nodes of different components meet.

    Alike sets share one of their rarest shingles (a prefix-filter join). Nodes that shingles found in several
    components join form a cluster; a node without such a shingle is like none of another component. A cluster is
    dealt into blocks, the large components each into blocks of their own, and every two blocks meet, unless
    they are of one component.
    """
    full = stage_in(over.join(sets, "node"), "overfull-sets", tasks)
    found = stage_in(prefixes(full), "prefixes", tasks)
    hubs = found.groupBy("shingle").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("node").alias("hub")).where("lo != hi").select("shingle", "hub")
    edges = found.join(hubs, "shingle").where("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    clusters = contract(edges, None, tasks).select("node", F.col("label").alias("cluster"))
    named = stage_in(clusters.join(over, "node"), "clusters", tasks)
    half = max(1, region // 2)
    of_label = named.groupBy("cluster", "label").agg(F.count("*").alias("n"))
    large = of_label.where(F.col("n") > half).select("cluster", "label", F.ceil(F.col("n") / half).alias("own"))
    small = of_label.where(F.col("n") <= half).groupBy("cluster").agg(F.ceil(F.sum("n") / half).alias("pooled"))
    dealt = named.join(large, ["cluster", "label"], "left").join(small, "cluster", "left")
    share = F.pmod(F.xxhash64("node"), F.coalesce("own", "pooled"))
    # a block is named by its component if that is large (else empty) and its share
    whose = F.when(F.col("own").isNotNull(), F.col("label")).otherwise(F.lit(b"")).alias("whose")
    dealt = stage_in(dealt.select("cluster", "node", "label", whose, share.alias("share")), "blocks", tasks)
    block = F.struct("whose", "share")
    blocks = dealt.select("cluster", block.alias("one")).distinct()
    pairs = blocks.join(blocks.select("cluster", F.col("one").alias("two")), "cluster").where("one <= two and (one.whose != two.whose or one.whose = X'')")
    ends = pairs.select("cluster", "one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    return dealt.withColumn("block", block).join(ends, ["cluster", "block"]).select(
        F.xxhash64("cluster").alias("cluster"), F.xxhash64("one").alias("one"), F.xxhash64("two").alias("two"), "node", "label")


def labels_of(table: pa.Table) -> np.ndarray:
    return table.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def promising(members: DataFrame, nodes: DataFrame, partitions: int) -> DataFrame:
    """The members of mixed regions whose signatures tell of a partner in another component worth a look."""
    def run(table: pa.Table) -> pa.Table:
        marks = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, SIZE)
        label, keep = labels_of(table), np.zeros(len(marks), bool)
        for i in range(len(marks) - 1):
            hit = np.flatnonzero(label[i + 1:] != label[i]) + i + 1
            hit = hit[(marks[hit] == marks[i]).sum(axis=1) >= AGREE]
            keep[hit] = True
            keep[i] |= len(hit) > 0
        return table.drop_columns(["signature"]).filter(pa.array(keep))

    marked = members.join(nodes.select("node", "signature"), "node").select("region", "node", "label", "signature")
    return stage(marked.repartition(partitions, "region").groupBy("region").applyInArrow(run, "region long, node binary, label binary"), "promising")


def group_links(picked: DataFrame, sets: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """Confirmed links (a, b) that join the components within each group ``keys`` of ``picked`` (keys, node, label).

    The full sets meet in the group's task, where all intersections across components are one matrix product.
    Only a spanning set of the links leaves the task.
    """
    def links(table: pa.Table) -> pa.Table:
        label, found = labels_of(table), [np.frombuffer(v.as_buffer(), U64) for v in table.column("shingles").combine_chunks()]
        sizes = np.array([len(f) for f in found], np.int64)
        values, column, seen = np.unique(np.concatenate(found), return_inverse=True, return_counts=True)
        shared = seen[column] > 1  # a shingle of one member only is in no intersection
        row = np.repeat(np.arange(len(sizes)), sizes)[shared]
        column = (np.cumsum(seen > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        same = np.zeros((len(sizes), len(sizes)), np.float32)
        width = 4096
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            a, b = np.searchsorted(column, [first, first + width])
            block = np.zeros((len(sizes), width), np.float32)
            block[row[a:b], column[a:b] - first] = 1
            same += block @ block.T
        linked = (100 * same >= PERCENT * (sizes[:, None] + sizes[None, :] - same)) | (label[:, None] == label[None, :])
        root = np.arange(len(sizes))
        while True:
            least = np.where(linked, root[None, :], len(sizes)).min(axis=1)
            if (least == root).all():
                break
            root = least
        node = table.column("node").combine_chunks()
        moved = np.flatnonzero(label != label[root])
        return pa.table({"a": node.take(pa.array(moved)), "b": node.take(pa.array(root[moved]))})

    full = picked.join(sets, "node").select(*keys, "node", "label", "shingles")
    return full.repartition(partitions, *keys).groupBy(*keys).applyInArrow(links, "a binary, b binary").distinct()


def components(docs: DataFrame, text: str = "text", doc: str = "doc_id", region: int = 1000, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document; with ``row`` also that column and the component's label (null without words)."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    described = stage(describe(docs, text, doc, row), "described")
    nodes = stage(described.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc"), F.first("signature").alias("signature")), "nodes")
    tasks = min(partitions, max(12, -(-nodes.count() // NODES_PER_TASK)))
    pairs, members = sorted_neighbours(forest_rows(nodes), partitions)
    pairs, members = stage_in(pairs, "pairs", tasks), stage_in(members, "members", tasks)
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other"), "depth").unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other"), "depth"))
    best = ends.groupBy("node").agg(F.max(F.struct("depth", "other")).alias("best"))
    first = stage_in(best.select(F.least("node", "best.other").alias("a"), F.greatest("node", "best.other").alias("b")).distinct(), "first", tasks)
    needed = members.select("node").distinct().join(nodes.select("node", "doc"), "node")
    sets = stage_in(sets_of(docs, needed, text, doc).dropDuplicates(["node"]), "sets", tasks)
    labels = contract(confirm(first, sets), None, tasks)
    rest = across(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), labels)
    second = stage_in(alike(rest, nodes), "second", tasks)
    labels = _merge(confirm(second, sets), labels, tasks)
    mixed, over = mixed_regions(members, labels, region, tasks)
    labels = _merge(group_links(promising(mixed, nodes, partitions), sets, ["region"], partitions), labels, tasks)
    if over.limit(1).count():
        over = over.select("node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        labels = _merge(group_links(overfull_blocks(over, sets, region, tasks), sets, ["cluster", "one", "two"], partitions), labels, tasks)
    named = nodes.select("node", "doc").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    of_node = named.join(least, "label").select("node", "label", "component_id")
    out = described.drop("signature").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
                      *([F.col("row").alias(row), "label"] if row else []))


def _merge(links: DataFrame, labels: DataFrame, tasks: int | None = None) -> DataFrame:
    """Labels after confirmed links between nodes of different components."""
    crossing = across(links, labels).select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
    return contract(crossing, labels, tasks)
