"""Training-corpus pipeline over ``documents``: five stages, each an operator of strata.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All stages but the last return the
columns of their input (``n_chars``, where present, follows the text); other columns
pass through whatever their names.

1. language_id: documents without a letter, or whose best language is less likely than ``MIN_SCORE``, go.
2. near_dedup: of each component of near-duplicates one row stays, the one with the smallest doc_id (ties by a digest of the text).
3. suffix_dedup: bytes of 200-byte strings that occur more than once are removed from the texts; rows stay.
4. decontaminate: documents that the contamination rule marks go.
5. byte_bpe: the texts' token ids, with digests of the ids and of the decoded bytes.

Null text has no letter, so such rows go in the first stage. In near_dedup
a null doc_id comes after all others: of a component of null ids only, one row stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, decontaminate, language_id, minhash_forest, suffix_dedup
from strata.llm.common import delete_folders, made_folders, stage, stage_path, table

#: A document stays if its best language has at least this probability.
MIN_SCORE = 0.3
#: Language identification and its language labels cannot be put in SQL.
ORACLE_SQL = None

_STAGED: list[str] = []


def _plain(docs: DataFrame, named: tuple[str, ...] = ("doc_id", "text")) -> tuple[DataFrame, dict[str, str]]:
    """The columns that operators read under their names, all others under neutral ones."""
    back = {f"_column_{i}": c for i, c in enumerate(docs.columns) if c not in named}
    return docs.select(*[c for c in docs.columns if c in named], *[F.col(f"`{c}`").alias(k) for k, c in back.items()]), back


def _restored(df: DataFrame, docs: DataFrame, back: dict[str, str]) -> DataFrame:
    """Columns of ``docs`` in their order and under their names."""
    under = {c: k for k, c in back.items()}
    out = df.select(*[F.col(under.get(c, c)).alias(c) for c in docs.columns])
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def _own_stage(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Delete what earlier stages left in the shared folder (their results are written by now), and note what this one makes."""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        delete_folders(spark, _STAGED)
        before = set(made_folders())
        out = stage(spark, docs, sf_dir)
        _STAGED[:] = [f for f in made_folders() if f not in before]
        return out

    run.__doc__ = stage.__doc__
    return run


@_own_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: keep documents with an identified language."""
    plain, back = _plain(docs)
    model = language_id.fit_on_rest(docs)
    judged = language_id.predict(plain, model)
    return _restored(judged.where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= MIN_SCORE)), docs, back)


@_own_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: keep one document of each component."""
    plain, back = _plain(docs)
    keyed = plain.withColumn("_key", F.unhex(F.md5(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))))
    judged = minhash_forest.components(keyed, row="_key").select(F.col("doc_id").alias("_id"), F.col("_key").alias("_row"), "label")
    rows = judged.groupBy("label", "_id", "_row").agg(F.count("*").alias("n"))
    least = F.min(F.struct(F.col("_id").isNull().alias("last"), "_id", "_row", "n"))
    stays = stage(rows.where("label is not null").groupBy("label").agg(least.alias("r")).select("r._id", "r._row", "r.n")
                  .unionByName(rows.where("label is null").select("_id", "_row", F.lit(1).cast("long").alias("n"))), "near-dedup-rows")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_row"))
    out = keyed.join(stays.where("n = 1"), same, "left_semi")
    repeated = stays.where("n > 1")
    if repeated.limit(1).count():
        out = out.unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "_key"]))
    under = {c: k for k, c in back.items()}
    return out.select(*[F.col(under.get(c, c)).alias(c) for c in docs.columns])


@_own_stage
def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: remove repeated byte strings from the texts."""
    plain, back = _plain(docs)
    return _restored(suffix_dedup.dedup(plain, kept="text"), docs, back)


@_own_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: drop documents that hold benchmark passages."""
    plain, back = _plain(docs)
    judged = decontaminate.judge(plain, table(spark, sf_dir, "benchmark"))
    return _restored(judged.where(~F.col("contaminated")), docs, back)


@_own_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: token ids (little-endian unsigned 32-bit) and the digests of ids and decoded text."""
    return bpe.round_trip(docs, ids="ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language), ("near_dedup", near_dedup), ("suffix_dedup", remove_repeats),
    ("decontaminate", drop_contaminated), ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    A stage's copy is deleted once the next one's is written; the last one stays, the returned rows are read from it.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = stage_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        delete_folders(spark, [*before, *_STAGED])
        before, _STAGED[:] = [path], []
    return docs
