"""Repeatable splits and stratified samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.values import hash_fraction, seeded
from postlens.session import materialise

# Draws of a stratum that one row stands for before they are dealt out.
DRAWS_PER_ROW = 10_000


def hash_split(df: DataFrame, key: str, train_percent: int = 80, seed: int | str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: no shuffle, the same for every partitioning."""
    bucket = hash_fraction(F.col(key), 100, seed)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def random_split(df: DataFrame, shares: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's own random split; its parts change with the partitioning of the input."""
    return df.randomSplit(list(shares), seed=seed)


def fold_number(key: Column, folds: int, seed: int | str = "folds") -> Column:
    return hash_fraction(key, folds, seed).cast("int")


def strata_quotas(df: DataFrame, strata: Sequence[str], n: int) -> DataFrame:
    """Rows per stratum and its share of n, rounded down: ``floor(n * size / total)``.

    Strata are aggregated before the total is taken, so the total is a sum over strata.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("size"))
    total = df.agg(F.count("*")).scalar()
    return sizes.withColumn("quota", F.floor(F.lit(n) * F.col("size") / total).cast("long"))


def stratum_positions(
    df: DataFrame, strata: Sequence[str], key: str, seed: int | str = "", part_digits: int = 3
) -> DataFrame:
    """Each key's place, from 0, in its stratum in hash order: ``(strata…, key, position)``.

    Numbering a whole stratum in one window would put a third of all rows into one task. The first
    digits of the digest cut a stratum into even parts; parts are numbered on their own and shifted
    by the sizes of the parts before them. Only keys are shuffled, never texts. ``part_digits`` hex digits
    give 16 times as many parts each: choose it so that a part of the largest stratum is a few million
    keys (3 digits: strata up to some ten thousand million rows).
    """
    digest = F.md5(seeded(F.col(key), seed))
    narrow = df.select(*strata, key, digest.alias("_digest"), F.substring(digest, 1, part_digits).alias("_part"))
    by = [*strata, "_part"]
    sizes = narrow.groupBy(*by).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*strata).orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.withColumn("_before", F.sum("_size").over(earlier) - F.col("_size")).drop("_size")
    place = F.row_number().over(Window.partitionBy(*by).orderBy("_digest", key))
    numbered = narrow.withColumn("_place", place)
    same = [numbered[name].eqNullSafe(offsets[name]) for name in by]
    joined = numbered.join(offsets, same, "inner")
    return joined.select(
        *[numbered[name] for name in strata], numbered[key], (F.col("_before") + F.col("_place") - 1).alias("position")
    )


def bottom_k(
    df: DataFrame, strata: Sequence[str], key: str, quotas: DataFrame, seed: int | str = "", part_digits: int = 3
) -> DataFrame:
    """The keys with the least digests of each stratum, as many as its ``quota``: ``(strata…, key, position)``.

    The positions are those of ``stratum_positions``, but only sampled rows are numbered. Map tasks count rows
    by the first digits of their digest; these counts tell, for each stratum, the last part that the quota
    reaches. Rows beyond it stay in the scan, so what is shuffled is the sample and at most one part of each
    stratum (with 3 digits a 4096th of it).
    """
    digest = F.md5(seeded(F.col(key), seed))
    narrow = df.select(*strata, key, digest.alias("_digest"), F.substring(digest, 1, part_digits).alias("_part"))
    sizes = narrow.groupBy(*strata, "_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*strata).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    same = [placed[name].eqNullSafe(quotas[name]) for name in strata]
    reached = placed.join(quotas, [*same, placed["_before"] < quotas["quota"]], "inner").select(
        *[placed[name].alias(f"_of_{name}") for name in strata], "_part", "_before", "quota"
    )
    # Few rows: the parts that hold sampled rows, and of each stratum the last of them.
    reached = materialise(reached, "bottom-k-parts")
    ends = reached.groupBy(*[f"_of_{name}" for name in strata]).agg(F.max("_part").alias("_end"))
    within = [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in strata]
    rows = narrow.join(ends, [*within, F.col("_part") <= F.col("_end")], "inner").select(*narrow.columns)
    place = F.row_number().over(Window.partitionBy(*strata, "_part").orderBy("_digest", key))
    numbered = rows.withColumn("_place", place).withColumnRenamed("_part", "_in")
    joined = numbered.join(reached, [*within, F.col("_in") == F.col("_part")], "inner")
    position = F.col("_before") + F.col("_place") - 1
    return joined.filter(position < F.col("quota")).select(*strata, key, position.alias("position"))


def _draws(quotas: DataFrame, strata: Sequence[str], seed: int | str) -> DataFrame:
    """One row per draw with the position it hits. Two steps keep every array short."""
    chunks = quotas.filter(F.col("quota") > 0).withColumn(
        "_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"), F.lit(DRAWS_PER_ROW).cast("long")))
    )
    # The draws of one stratum are made by many tasks.
    chunks = chunks.repartition(*strata, "_from")
    upto = F.least(F.col("_from") + DRAWS_PER_ROW - 1, F.col("quota"))
    draws = chunks.withColumn("draw", F.explode(F.sequence(F.col("_from"), upto))).drop("_from")
    name = F.concat_ws(":", *[F.col(s).cast("string") for s in strata], F.col("draw").cast("string"))
    number = F.conv(F.substring(F.md5(seeded(name, seed)), 1, 15), 16, 10).cast("long")
    return draws.withColumn("position", number % F.col("size")).select(*strata, "draw", "position")


def stratified_sample(
    df: DataFrame, strata: Sequence[str], key: str, n: int, replace: bool = True, seed: int | str = ""
) -> DataFrame:
    """Keys of a proportional sample: the floor of each stratum's share of n.

    With replacement a key may come more than once; ``draw`` numbers the draws of a stratum.
    Join the result to the table by key for the full rows.
    """
    quotas = strata_quotas(df, strata, n)
    if replace:
        positions = stratum_positions(df, strata, key, seed)
        picks = _draws(quotas, strata, seed)
        same = [positions[name].eqNullSafe(picks[name]) for name in strata]
        joined = positions.join(picks, [*same, positions["position"] == picks["position"]], "inner")
        return joined.select(*[positions[name] for name in strata], positions[key], picks["draw"])
    lowest = bottom_k(df, strata, key, quotas, seed)
    return lowest.select(*strata, key, (F.col("position") + 1).alias("draw"))


def sampled_rows(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Full rows of a sample, repeated as often as they were drawn."""
    return df.join(sample.select(key, "draw"), key, "inner")
