"""Exact ranks, running totals and quantiles that never sort a whole group in one task.

A global or per-group window would send a group to a single task. Here the order column is first cut
into ranges of about equal size, totals per range give each range its offset, and only the rows inside
a range are sorted together. A group that holds a third of all rows is thereby spread over a third of
the ranges. The cuts only decide how work is spread; the results are exact whatever they are.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of a range, about: what one task sorts.
ROWS_PER_RANGE = 250_000
LEAST_RANGES = 16
# Of a quantile sketch: it is off by at most one rank in so many.
ACCURACY = 10_000


def balanced_cuts(df: DataFrame, columns: list[str], ranges: int | None = None) -> list[list[float]]:
    """Per column, cut points that leave about as many rows in every range; as many ranges as the rows need."""
    ranges = ranges or max(LEAST_RANGES, -(-df.count() // ROWS_PER_RANGE))
    shares = [i / ranges for i in range(1, ranges)]
    found = df.approxQuantile(columns, shares, 1 / (4 * ranges))
    return [[-math.inf, *(sorted({c for c in cuts if math.isfinite(c)}) or [0.0]), math.inf] for cuts in found]


def with_range(df: DataFrame, column: str, cuts: list[float], name: str = "_range") -> DataFrame:
    return Bucketizer(splits=cuts, inputCol=column, outputCol=name, handleInvalid="keep").transform(df)


def running_totals(df: DataFrame, keys, order: str, measures, descending: bool = False) -> DataFrame:
    """Adds `<measure>_run`: the total of the measure over all rows of the keys up to this one.

    The rows carry the range of their order value in `_range`. Rows with the same order value share one
    result. The keys must not be NULL. Callers merge rows with equal keys and order value beforehand.
    """
    way = F.desc if descending else F.asc
    totals = df.groupBy(*keys, "_range").agg(*[F.sum(m).alias(m) for m in measures])
    # One row per key and range, so a window holds at most as many rows as there are ranges.
    before = Window.partitionBy(*keys).orderBy(way("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "_range", *[F.coalesce(F.sum(m).over(before), F.lit(0)).alias(f"_{m}_base") for m in measures])
    inside = Window.partitionBy(*keys, "_range").orderBy(way(order)).rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (
        df.join(offsets, [*keys, "_range"])
        .withColumns({f"{m}_run": F.sum(m).over(inside) + F.col(f"_{m}_base") for m in measures})
        .drop(*[f"_{m}_base" for m in measures])
    )


def hash_rank(df: DataFrame, keys, digest: str, tie: str, name: str = "rank", size: str = "size") -> DataFrame:
    """Adds the position of each row within its keys, by a hex digest and then the tie column, from 1, and
    the number of rows that share the keys.

    A digest is uniform, so its first three digits are the ranges: 4096 of them, equally filled even when
    one key holds most of the rows.
    """
    ranged = df.withColumn("_slice", F.substring(digest, 1, 3))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias(size))
    inside = Window.partitionBy(*keys, "_slice").orderBy(digest, tie)
    return (
        ranged.join(offsets, [*keys, "_slice"])
        .withColumn(name, F.row_number().over(inside) + F.col("_base"))
        .drop("_slice", "_base")
    )


def group_quantiles(df: DataFrame, keys, value: str, shares) -> DataFrame:
    """Exact interpolated quantiles per key: columns keys, `share`, `n`, `quantile`.

    A quantile sketch gives each wanted rank a bracket of values that is sure to hold it. One pass then counts the
    rows below the bracket and merges equal values inside it, and only the values inside, about a thousandth of the
    rows, are put in order. Nothing is written and no job runs before the result is asked for. Rows with a NULL
    key or value are left out, as in a data frame's groupby. With an empty key list the result is one row per
    share, and none for an empty table.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).dropna()
    shares = [float(s) for s in shares]
    # The sketch is off by at most n / ACCURACY ranks: twice that on either side is a bracket. Where it would be
    # wider than the group, or the group is too small for the rank error to mean much, it is open.
    edges = sorted({min(1.0, max(0.0, s + d)) for s in shares for d in (-2 / ACCURACY, 2 / ACCURACY)})
    sketch = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", edges, ACCURACY).alias("_q"))
    open_ = F.col("n") < 4 * ACCURACY

    def edge(share: float, far: float, beyond: float):
        at = share + far
        if not 0.0 < at < 1.0:
            return F.lit(beyond)
        return F.when(open_, F.lit(beyond)).otherwise(F.col("_q")[edges.index(at)])

    wanted = F.array(*[F.struct(
        F.lit(s).alias("share"), (F.lit(s) * (F.col("n") - 1)).alias("at"),
        edge(s, -2 / ACCURACY, -math.inf).alias("from"), edge(s, 2 / ACCURACY, math.inf).alias("to")) for s in shares])
    brackets = sketch.filter("n > 0").select(*keys, "n", wanted.alias("_wanted"))
    if keys:
        # A join by key would sort all rows of a group in one task. Only large groups have a bracket, a row for each
        # 4 * ACCURACY rows at most: these few go to the rows. A small group is open, and its rows are counted below.
        every = F.array(*[F.struct(F.lit(s).alias("share"), F.lit(None).cast("double").alias("at"),
                                   F.lit(-math.inf).alias("from"), F.lit(math.inf).alias("to")) for s in shares])
        met = rows.join(F.broadcast(brackets.filter(~open_)), list(keys), "left").withColumn(
            "_wanted", F.coalesce("_wanted", every))
    else:
        one = brackets.select(F.struct("n", "_wanted")).scalar()
        met = rows.select("_v", one.alias("_one")).select("_v", "_one.n", "_one._wanted").filter("n IS NOT NULL")
    met = met.select(*keys, "n", "_v", F.explode("_wanted").alias("w")).select(
        *keys, "n", "w.share", "w.at", "w.to", F.col("_v"), F.when(F.col("_v") >= F.col("w.from"), F.col("_v")).alias("_in"))
    merged = met.filter(F.col("_v") <= F.col("to")).groupBy(*keys, "n", "share", "at", "_in").agg(
        F.count(F.lit(1)).alias("_n"))
    # The rows below the bracket are one merged row without a value; it comes first.
    whole = Window.partitionBy(*keys, "share")
    upto = whole.orderBy(F.asc_nulls_first("_in")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumns({"_cum": F.sum("_n").over(upto), "n": F.coalesce("n", F.sum("_n").over(whole))}).filter(
        "_in IS NOT NULL").withColumn("at", F.coalesce("at", F.col("share") * (F.col("n") - 1)))
    # A wanted rank is a position on 0 .. n-1; it lies between the whole positions below and above.
    return (
        ranked.groupBy(*keys, "share", "n", "at")
        .agg(F.expr("min(CASE WHEN _cum > floor(at) THEN _in END) AS low"),
             F.expr("min(CASE WHEN _cum > ceil(at) THEN _in END) AS high"))
        .selectExpr(*keys, "share", "n", "low + (high - low) * (at - floor(at)) AS quantile")
    )


def group_medians(df: DataFrame, keys, value: str, name: str = "median") -> DataFrame:
    return group_quantiles(df, keys, value, [0.5]).select(*keys, "n", F.col("quantile").alias(name))


def overall_median(df: DataFrame, value: str):
    """The exact median of a column as a scalar that other queries can use; NULL for no rows."""
    return group_quantiles(df, [], value, [0.5]).select("quantile").scalar()
