"""Seeded order, quotas and review selection as window functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import hash_key


def stratified_order(df: DataFrame, strata: list[str], key: Column) -> DataFrame:
    """df with order_key and position: (i + 0.5) / n of the row in its stratum by the seeded key."""
    w = Window.partitionBy(*strata)
    df = df.withColumn("order_key", key)
    place = F.row_number().over(w.orderBy("order_key"))
    return df.withColumn("position", (place - 0.5) / F.count(F.lit(1)).over(w))


def draw(df: DataFrame, strata: list[str], key: Column, size: int) -> DataFrame:
    """The first size rows of the stratified order. A stratum gives at most size rows, cut before the shuffle; sizes are counted apart."""
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    own = df.withColumn("order_key", key)
    own = own.withColumn("_place", F.row_number().over(Window.partitionBy(*strata).orderBy("order_key"))).filter(F.col("_place") <= size).alias("x")
    same = [F.equal_null(F.col(f"x.{s}"), F.col(f"y.{s}")) for s in strata]
    own = own.join(sizes.alias("y"), same).select("x.*", ((F.col("x._place") - 0.5) / F.col("y._n")).alias("position"))
    return own.drop("_place").orderBy("position", "order_key").limit(size)


def inspected(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """df with inspected: whether its key is among seen's; a null key never is."""
    known = seen.select(key).distinct().withColumn("inspected", F.lit(True))
    return df.join(known, key, "left").withColumn("inspected", F.coalesce("inspected", F.lit(False)))


def quota(df: DataFrame, strata: list[str], seed: str, id_col: str, size: int) -> DataFrame:
    """The first size rows of each stratum by seeded hash, with their place."""
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(hash_key(seed, F.col(id_col))))
    return df.withColumn("place", place).filter(F.col("place") <= size)


def risk(flags: dict[str, tuple[Column, int]]) -> tuple[Column, Column]:
    """(weight, reasons): the sum of the weights of the flags that hold, and their sorted names joined by |."""
    hold = {name: F.coalesce(c, F.lit(False)) for name, (c, _) in flags.items()}
    total = sum((F.when(hold[name], w).otherwise(0) for name, (_, w) in flags.items()), F.lit(0))
    named = F.array_compact(F.array(*[F.when(hold[n], F.lit(n)) for n in sorted(flags)]))
    return total, F.array_join(named, "|")
