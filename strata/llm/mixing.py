"""Operator 12: mixing sources to target weights [native].

The words of each source, document after document, are packed into blocks of a fixed number of words. An output shard
has a fixed number of slots and draws how many of them each source gets: a multinomial draw, one uniform hash per slot
against the sources' shares. Over all shards a source then holds exactly the slots its target asks for: slots drawn
beyond that go, in hashed order, to the sources that were drawn too seldom. The slots of a source are numbered over
the shards, and slot k takes the block that the source's pseudorandom permutation for epoch ``k div blocks`` names
(swap-or-not rounds, a bijection for every number of blocks, computed row by row). Slots and blocks meet in a join by
(source, block). The last slot of a source is cut where its target is reached.

Sources in the order of their code points, null last, weigh 1, 2, 3, 1, ... and share the words of all documents. A
target stops at ``most`` times its source's words; what is left over goes to the other sources by weight, until no
target is above its bound. The epochs in which all blocks are taken are at most ``most``, so no document is taken
more often.

A word is ``[^\\x20\\x09-\\x0D]+`` of the whole text; null, empty and blank texts have none, are returned and never
taken. Documents are ordered by id, text hash and size: repeated rows and ids are documents of their own, and equal
rows may swap their counts. Reruns agree, whatever the partitions. A long document is many blocks. An empty table
gives an empty result. Other columns are only read where ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.ordering import numbered

from .common import stage

WORD = r"[^\x20\x09-\x0D]+"
#: Rounds of the permutation.
ROUNDS = 24
#: Width of the pieces in which slots look up their source.
PIECE = 64


@dataclass
class Mixture:
    """``documents``: row, doc_id, size, source, source_size, target, taken and the carried columns, one row per document.
    ``spans``: what each slot holds: shard, slot, row (of the document), from_word, to_word, at (place in the slot)."""

    documents: DataFrame
    spans: DataFrame


def _draw(*of: Column | str) -> Column:
    return F.xxhash64(*of)


def permuted(x: Column, n: Column, source: Column, epoch: Column, seed: int, inverse: bool = False, rounds: int = ROUNDS) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0 .. n-1: in each round x and (offset - x) mod n may swap."""
    order = F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(rounds - 1))

    def turn(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(_draw(F.lit(seed), source, epoch, r), n) - at, n)
        heads = _draw(F.lit(seed), source, epoch, r, F.greatest(at, partner)).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, partner).otherwise(at)

    return F.aggregate(order, x.cast("long"), turn)


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Sources (source, source_size) with their number, weight and target.

    ``level`` words per unit of weight, less where a source's bound is reached, use up all words. The level rises until
    the set of bounded sources stays the same; each step is one sum over the sources.
    """
    ordered = numbered(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"], "no").drop("none")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("no") % len(weights) + 1).cast("int"))
    ordered = stage(ordered.withColumns({"weight": weight, "bound": F.col("source_size") * most}), "mix-sources")
    bounded, level = -1, 0.0
    while True:
        above = F.lit(level) * F.col("weight") > F.col("bound")
        now = ordered.agg(F.count_if(above).alias("bounded"), F.sum("source_size").alias("all"), F.sum(F.when(above, F.col("bound"))).alias("held"),
                          F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if now["bounded"] == bounded or not now["weight"]:
            break
        bounded, level = now["bounded"], ((now["all"] or 0) - (now["held"] or 0)) / now["weight"]
    return ordered.withColumn("target", F.least(F.lit(level) * F.col("weight"), F.col("bound").cast("double")))


def _in_order(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with their own number ``row`` and the words of their source before them, ``before``.

    A range-partitioned sort is stored once; sums run inside its parts, and per source over the parts.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    d = stage(d.withColumns({"row": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), "mix-documents")
    inside = Window.partitionBy("part", "source").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    start = d.groupBy("part", "source").agg(F.sum("size").alias("s")).select("part", F.col("source").alias("of"), F.coalesce(F.sum("s").over(ahead), F.lit(0)).alias("start"))
    d = d.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    here = (d["part"] == start["part"]) & d["source"].eqNullSafe(start["of"])
    return d.join(start, here).drop(start["part"]).withColumn("before", F.col("before") + F.col("start")).drop("start", "of")


def _slots_of(sources: DataFrame, block: int, seed: int) -> DataFrame:
    """Sources with words to take, their blocks and the slots that these words need."""
    n, no, size = F.col("blocks"), F.col("no"), F.col("source_size")
    s = sources.withColumns({"words": F.round("target").cast("long"), "blocks": F.expr(f"(source_size + {block - 1}) div {block}")}).where("words > 0")
    s = s.withColumns({"epochs": F.expr("words div source_size"), "rest": F.expr("words % source_size"), "last": size - (n - 1) * block})
    # the short last block comes up somewhere in every epoch
    s = s.withColumn("short", F.transform(F.sequence(F.lit(0).cast("long"), F.col("epochs")), lambda e: permuted(n - 1, n, no, e, seed, inverse=True)))
    whole = F.expr(f"(rest + {block - 1}) div {block}")
    early = F.element_at("short", (F.col("epochs") + 1).cast("int")) < whole
    more = F.when(early & (whole * block - (block - F.col("last")) < F.col("rest")), 1).otherwise(0)
    return s.withColumn("slots", F.col("epochs") * n + whole + more)


def _drawn(sources: DataFrame, total: int, shard_slots: int, seed: int) -> DataFrame:
    """Multinomial draws of all shards, settled to each source's slots: rows of (shard, source's columns, k)."""
    spark = sources.sparkSession
    own = ["no", "source_size", "blocks", "words", "last", "short", "slots"]
    ends = Window.orderBy("top").rowsBetween(Window.unboundedPreceding, -1)
    # sources stand side by side in 0 .. total-1; first sums of 1,000 sources each, then inside them
    ranged = sources.withColumn("top", F.expr("no div 1000"))
    tops = ranged.groupBy("top").agg(F.sum("slots").alias("s")).select("top", F.coalesce(F.sum("s").over(ends), F.lit(0)).alias("start"))
    inside = Window.partitionBy("top").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    ranged = ranged.withColumn("low", F.coalesce(F.sum("slots").over(inside), F.lit(0))).join(tops, "top").withColumn("low", F.col("low") + F.col("start"))
    coarse = 1 << 12  # pieces are made in two steps, so that one source is not one task
    pieces = ranged.withColumn("wide", F.explode(F.expr(f"sequence(low div {PIECE * coarse}, (low + slots - 1) div {PIECE * coarse})"))).where("slots > 0")
    pieces = pieces.repartition("wide").withColumn("piece", F.explode(F.expr(
        f"sequence(greatest(low div {PIECE}, wide * {coarse}), least((low + slots - 1) div {PIECE}, wide * {coarse} + {coarse - 1}))")))
    pieces = pieces.select("piece", "low", *own)
    slots = spark.range(total).select(F.expr(f"id div {shard_slots}").alias("shard"), F.pmod(_draw(F.lit(seed), F.lit("slot"), "id"), F.lit(max(total, 1))).alias("at"))
    hits = slots.withColumn("piece", F.expr(f"at div {PIECE}")).join(pieces, "piece").where((F.col("at") >= F.col("low")) & (F.col("at") < F.col("low") + F.col("slots")))
    counts = hits.groupBy("shard", *own).agg(F.count("*").alias("drawn"))
    sofar = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    counts = stage(counts.withColumn("first", F.coalesce(F.sum("drawn").over(sofar), F.lit(0))), "mix-draws")

    kept = F.least(F.greatest(F.col("slots") - F.col("first"), F.lit(0)), F.col("drawn"))
    granted = counts.withColumn("kept", kept).where("kept > 0").withColumn("k", F.explode(F.expr("sequence(first, first + kept - 1)"))).select("shard", *own, "k")
    spare = counts.withColumn("over", F.col("drawn") - kept).where("over > 0").withColumn("i", F.explode(F.expr("sequence(1, over)")))
    spare = numbered(spare.select("shard", _draw(F.lit(seed), "shard", "no", "i").alias("h"), "no", "i"), ["h", "shard", "no", "i"], "turn").select("turn", "shard")
    have = counts.groupBy(F.col("no").alias("of")).agg(F.sum("drawn").alias("have"))
    short = sources.join(have, F.col("no") == F.col("of"), "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < slots")
    short = short.withColumn("k", F.explode(F.expr("sequence(have, slots - 1)"))).select(*own, "k")
    refilled = spare.join(numbered(short, ["no", "k"], "turn"), "turn").select("shard", *own, "k")
    return granted.unionByName(refilled)


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[int] = (1, 2, 3), most: int = 3,
        block: int = 256, shard_slots: int = 256, seed: int = 12, carry: Sequence[str] = ()) -> Mixture:
    """Mix a table's sources to their target weights; see the module's docstring."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
                       F.xxhash64(body).alias("h"), F.monotonically_increasing_id().alias("tie"), *[F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)])
    rows = rows.withColumn("none", F.col("source").isNull())
    rows = stage(_in_order(rows, ["none", "source", "doc_id", "h", "size", "tie"]).drop("none", "h", "tie", "part"), "mix-offsets")
    every = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    sources = stage(_slots_of(every, block, seed), "mix-slots")
    total = sources.agg(F.sum("slots")).first()[0] or 0

    slots = _drawn(sources, total, shard_slots, seed)
    slots = slots.withColumn("slot", F.row_number().over(Window.partitionBy("shard").orderBy(_draw(F.lit(seed), "no", "k"), "no", "k")) - 1)
    slots = slots.withColumns({"epoch": F.expr("k div blocks"), "place": F.expr("k % blocks")})
    slots = slots.withColumn("b", permuted(F.col("place"), F.col("blocks"), F.col("no"), F.col("epoch"), seed))
    late = F.col("place") > F.element_at("short", (F.col("epoch") + 1).cast("int"))
    start = F.col("epoch") * F.col("source_size") + F.col("place") * block - F.when(late, block - F.col("last")).otherwise(0)
    length = F.when(F.col("b") == F.col("blocks") - 1, F.col("last")).otherwise(block)
    slots = slots.withColumn("length", F.least(length, F.col("words") - start)).select("shard", "slot", "no", "b", "length")

    names = every.select("source", "no", "source_size", "target")
    rows = rows.withColumnRenamed("source", "of")
    rows = rows.join(names, F.col("of").eqNullSafe(F.col("source"))).drop("of")
    held = rows.where("size > 0").select("row", "no", "before", "size").withColumn("b", F.explode(F.expr(f"sequence(before div {block}, (before + size - 1) div {block})")))
    held = held.withColumns({"low": F.greatest(F.col("b") * block, "before"), "high": F.least((F.col("b") + 1) * block, F.col("before") + F.col("size"))})
    spans = slots.join(held, ["no", "b"]).withColumn("end", F.least("high", F.col("b") * block + F.col("length"))).where("end > low")
    spans = stage(spans.select("shard", "slot", "row", (F.col("low") - F.col("before")).alias("from_word"), (F.col("end") - F.col("before")).alias("to_word"),
                               (F.col("low") - F.col("b") * block).alias("at")), "mix-spans")
    taken = spans.groupBy("row").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    documents = rows.join(taken, "row", "left").select("row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                                                       *[F.col(f"carried_{i}").alias(c) for i, c in enumerate(carry)])
    return Mixture(documents, spans)


def shard_texts(mixture: Mixture, text: str = "text") -> DataFrame:
    """The words of every slot, joined by one space: shard, slot, text. ``text`` must be carried by the mixture.

    A slot gathers at most one block of words.
    """
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    parts = mixture.spans.join(mixture.documents.select("row", text), "row").withColumn(
        "part", F.array_join(F.slice(words, (F.col("from_word") + 1).cast("int"), (F.col("to_word") - F.col("from_word")).cast("int")), " "))
    return parts.groupBy("shard", "slot").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "part"))), lambda p: p["part"]), " ").alias("text"))


def mix_documents(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    return mix(documents.select("doc_id", "text", "source")).documents.select("doc_id", "size", "source_size", "target", "taken")
