"""Repeatable uniform samples: the k rows of smallest seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: below this spread the tags are too close to be sampled one by one.
STRATIFY_FROM_SPREAD = 500

DEFAULT_SEED = 42


def seeded_hash(row_id: str, seed: int) -> Column:
    """A hash of the row's id that any SQL engine can recompute."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))


def uniform_sample(
    rows: DataFrame, k: int, row_id: str, seed: int = DEFAULT_SEED
) -> DataFrame:
    """``k`` rows, each as likely as any other; each task offers only its own best ``k``."""
    return (
        rows.withColumn("_hash", seeded_hash(row_id, seed))
        .orderBy("_hash", row_id)
        .limit(k)
        .drop("_hash")
    )


def stratified_sample(
    rows: DataFrame,
    stratum: str,
    k: int,
    row_id: str,
    seed: int = DEFAULT_SEED,
    salts: int = 64,
) -> DataFrame:
    """``k`` rows per stratum, uniform within it.

    Taken in two rounds: first per stratum and salt, which spreads a stratum that
    holds most of the rows over many tasks, then among the at most ``k * salts``
    survivors of each stratum. Spark drops losers before both shuffles.
    """
    salt = F.pmod(F.xxhash64(F.col(row_id)), F.lit(salts))
    order = ["_hash", row_id]
    first = Window.partitionBy(stratum, "_salt").orderBy(*order)
    second = Window.partitionBy(stratum).orderBy(*order)
    return (
        rows.withColumn("_hash", seeded_hash(row_id, seed))
        .withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(second))
        .where(F.col("_rank") <= k)
        .drop("_hash", "_salt", "_rank")
    )


def sample_centers(
    vectors: DataFrame,
    k: int,
    vocabulary: list[str],
    spread: int,
    row_id: str = "qid",
    seed: int = DEFAULT_SEED,
) -> list[tuple[int, int]]:
    """Start centers for clustering, an equal share per tag when the spread is wide.

    Fails unless ``k`` is a multiple of the vocabulary and each tag has enough
    vectors. The result is ``k`` pairs, so it may come to the driver.
    """
    if k % len(vocabulary):
        raise ValueError("k must be a multiple of the number of tags")
    if spread < STRATIFY_FROM_SPREAD:
        picked = uniform_sample(vectors, k, row_id, seed)
    else:
        picked = stratified_sample(vectors, "lx", k // len(vocabulary), row_id, seed)
    rows = picked.orderBy("lx", seeded_hash(row_id, seed), row_id).select("lx", "hs").collect()
    if len(rows) != k:
        raise ValueError(f"sampled {len(rows)} vectors, but {k} are needed")
    return [(row["lx"], row["hs"]) for row in rows]
