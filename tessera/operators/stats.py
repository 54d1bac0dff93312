"""Agreement, precision and recall, intervals and summaries; a null is not measured, never zero."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: Column, b: Column) -> Column:
    return F.round(a / F.nullif(b, F.lit(0)), 6)


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count(F.lit(1)).alias("n"))


def precision_recall(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """One row for each class of truth or guess: tp, fp, fn, precision, recall, f1."""
    both = df.select(F.explode(F.array_distinct(F.array(truth, guess))).alias("class"), truth, guess)
    hit = lambda a, b: F.sum(F.when(a & b, 1).otherwise(0))
    is_t, is_g = F.col(truth) == F.col("class"), F.col(guess) == F.col("class")
    out = both.groupBy("class").agg(hit(is_t, is_g).alias("tp"), hit(~is_t, is_g).alias("fp"), hit(is_t, ~is_g).alias("fn"))
    return out.select(
        "class", "tp", "fp", "fn", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def class_summary(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """One row: n, accuracy, macro_f1 over the classes that truth has; rows with a null on either side take no part."""
    both = df.filter(F.col(truth).isNotNull() & F.col(guess).isNotNull())
    macro = precision_recall(both, truth, guess).filter("tp + fn > 0").agg(F.round(F.avg(F.coalesce("f1", F.lit(0.0))), 6).alias("macro_f1"))
    return both.agg(F.count(F.lit(1)).alias("n"), ratio(F.sum((F.col(truth) == F.col(guess)).cast("int")), F.count(F.lit(1))).alias("accuracy")).join(F.broadcast(macro))


def cohen_kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, observed, expected, kappa) of two raters, any number of classes of any type; kappa null where chance agreement is full.

    Rows that a rater left null take no part.
    """
    own = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    each = own.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.lit(1).alias("x"), F.lit(0).alias("y")), F.struct(F.col("b").alias("c"), F.lit(0).alias("x"), F.lit(1).alias("y")))).alias("e"))
    chance = each.groupBy("e.c").agg(F.sum("e.x").cast("double").alias("x"), F.sum("e.y").cast("double").alias("y")).agg(F.sum(F.col("x") * F.col("y")).alias("chance"))
    s = own.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("a") == F.col("b")).cast("int")).alias("same")).join(F.broadcast(chance))
    n = F.nullif(F.col("n").cast("double"), F.lit(0.0))
    expected, observed = F.col("chance") / n / n, F.col("same") / n
    kappa = (observed - expected) / F.nullif(1 - expected, F.lit(0.0))
    return s.select("n", F.round(observed, 6).alias("observed"), F.round(expected, 6).alias("expected"), F.round(kappa, 6).alias("kappa"))


def quantiles(df: DataFrame, by: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Per group n, least, most and the named shares' quantiles, linear between neighbours; nulls take no part.

    Values are counted first, then ranked by running counts: exact, and a group's sort can spill.
    """
    seen = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(by)
    seen = seen.withColumn("upto", F.sum("k").over(w.orderBy(value))).withColumn("n", F.sum("k").over(w))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col(value)))
    columns = [F.max("n").alias("n"), F.min(value).alias("least"), F.max(value).alias("most")]
    for name, share in shares.items():
        place = (F.col("n") - 1) * share
        columns += [at(F.floor(place)).alias(f"_low_{name}"), at(F.ceil(place)).alias(f"_high_{name}")]
    out = seen.groupBy(by).agg(*columns)
    for name, share in shares.items():
        place = (F.col("n") - 1) * share
        between = F.col(f"_low_{name}") + (F.col(f"_high_{name}") - F.col(f"_low_{name}")) * (place - F.floor(place))
        out = out.withColumn(name, F.round(between, 6)).drop(f"_low_{name}", f"_high_{name}")
    return out


def null_rate(column: str) -> Column:
    """The share of rows whose column is null, empty or {}; null of no rows."""
    missing = F.col(column).isNull() | F.coalesce(F.col(column).cast("string").isin("", "{}"), F.lit(False))
    return ratio(F.sum(missing.cast("int")), F.count(F.lit(1)))


def jaccard(df: DataFrame, group: str, item: str) -> DataFrame:
    """(left, right, shared, jaccard) of every two groups that share an item; an item's groups meet, not all pairs of rows."""
    own = df.select(F.col(group).alias("g"), F.col(item).alias("i")).filter("g IS NOT NULL AND i IS NOT NULL").distinct()
    sizes = own.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    of = own.groupBy("i").agg(F.array_sort(F.collect_set("g")).alias("gs"))
    pair = of.select(F.explode("gs").alias("left"), "gs").select("left", F.explode("gs").alias("right")).filter("left < right")
    both = pair.groupBy("left", "right").agg(F.count(F.lit(1)).alias("shared"))
    out = both.join(sizes.toDF("left", "n_left"), "left").join(sizes.toDF("right", "n_right"), "right")
    return out.select("left", "right", "shared", ratio(F.col("shared"), F.col("n_left") + F.col("n_right") - F.col("shared")).alias("jaccard"))


def reserve_estimate(df: DataFrame, by: str, cost: str, ceiling: float, least: int = 5) -> DataFrame:
    """(by, n, reserved): the ceiling until so many costs are known, then the larger of their 95th nearest rank and twice their mean, at most the ceiling."""
    seen = df.filter(F.col(cost).isNotNull()).groupBy(by, cost).agg(F.count(F.lit(1)).alias("k"))
    w = Window.partitionBy(by)
    seen = seen.withColumn("upto", F.sum("k").over(w.orderBy(cost))).withColumn("n", F.sum("k").over(w))
    rank = F.least(F.col("n"), F.floor(F.col("n") * 0.95) + 1)
    out = seen.groupBy(by).agg(F.max("n").alias("n"), F.min(F.when(F.col("upto") >= rank, F.col(cost))).alias("p95"), (F.sum(F.col(cost) * F.col("k")) / F.max("n")).alias("mean"))
    known = F.least(F.lit(ceiling), F.greatest(F.col("p95"), 2 * F.col("mean")))
    return out.select(by, "n", F.when(F.col("n") < least, F.lit(ceiling)).otherwise(known).alias("reserved"))


def _beta(a: float, b: float, x: float) -> float:
    """The regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f = c = 1.0
    d = 1 - (a + b) * x / (a + 1) or 1e-300
    f = d = 1 / d
    for m in range(1, 300):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + step * d or 1e-300)
            c = 1 + step / c or 1e-300
            f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * f


def clopper_pearson(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """The exact interval of a binomial share, by bisection."""
    if n <= 0 or not 0 <= k <= n:
        raise ValueError("an interval needs 0 <= k <= n and n > 0")
    tail = (1 - level) / 2

    def solve(a: float, b: float, goal: float) -> float:
        low, high = 0.0, 1.0
        for _ in range(100):
            mid = (low + high) / 2
            low, high = (mid, high) if _beta(a, b, mid) < goal else (low, mid)
        return low

    return (0.0 if k == 0 else solve(k, n - k + 1, tail)), (1.0 if k == n else solve(k + 1, n - k, 1 - tail))


def binomial_interval(df: DataFrame, k: str, n: str, level: float = 0.95) -> DataFrame:
    """df, a few aggregate rows, with lower and upper: the exact interval of k of n, in whole batches; null counts give null."""

    def run(batches):
        for b in batches:
            pairs = zip(b.column(k).to_pylist(), b.column(n).to_pylist(), strict=True)
            found = [clopper_pearson(int(x), int(y), level) if x is not None and y is not None else (None, None) for x, y in pairs]
            arrays = [pa.array([f[i] for f in found], pa.float64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], names=[*b.schema.names, "lower", "upper"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("lower", T.DoubleType()), T.StructField("upper", T.DoubleType())]))
