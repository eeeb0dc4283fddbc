"""The nearest known listings of every request, exactly, without pairing every request with every listing.

Per request: a filter (mileage and years, relaxed when it leaves too few rows), a candidate group inside
the filter (same model, else same brand, else all), a scale per dimension from the filtered rows, and the
listings with the smallest scaled distance.

1. Counts and moments of every filter come from running totals over mileage, one lookup per request.
2. The listings of each group are divided at their medians, again and again, until no cell holds more than LEAF of
   them. Requests go down this tree together, a level at a time; at each level the cells give a distance within
   which enough listings are certain, and so the cells that can hold a neighbour.
   What is divided is the different numbers with their counts; listings get their cell by their numbers.
3. Only listings of those leaves meet the request, joined on group and cell, and of listings with the same
   numbers only as many as can be among the nearest. So a request meets about as many listings in a large table as in
   a small one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forecourt.config import Scope
from forecourt.functions.columns import euro, title_label
from forecourt.operators.ordering import balanced_cuts, running_totals, with_range
from forecourt.sources.storage import written

LEAF = 16  # listings of a cell, unless they are alike in all numbers
DIMS = ("mileage_in_km", "year", "power_ps")
SUMS = ("n", "m1", "m2", "y1", "y2", "p1", "p2")


def _groups(df: DataFrame, keep=()) -> DataFrame:
    """Every row once per group it belongs to: its model, its brand, all."""
    group = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    groups = F.array(group("model", F.col("model")), group("brand", F.col("brand")), group("all", F.lit("")))
    rest = [c for c in df.columns if c in keep or c not in ("brand", "model")]
    return df.select(F.explode(groups).alias("g"), *rest).select("g.kind", "g.name", *rest).filter(
        F.col("name").isNotNull())


def _filter_counts(requests: DataFrame, sample: DataFrame) -> DataFrame:
    """Adds to every request what its model, its brand and all rows hold up to its mileage, per year."""
    mean = sample.agg(F.struct(*[F.avg(c).alias(c) for c in DIMS])).scalar()
    # Deviations from the overall mean keep the sums of squares small.
    m, y, p = (F.col(c) - mean[c] for c in DIMS)
    cells = written(
        sample.withColumn("_p", p)
        .groupBy("brand", "model", "year", "mileage_in_km")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("_p").alias("p1"), F.sum(F.col("_p") * F.col("_p")).alias("p2"))
        .withColumns({"m1": m * F.col("n"), "m2": m * m * F.col("n"), "y1": y * F.col("n"), "y2": y * y * F.col("n")}),
        "year-mileage")
    grouped = _groups(cells).groupBy("kind", "name", "year", "mileage_in_km").agg(
        *[F.sum(s).alias(s) for s in SUMS]).withColumn("asked", F.lit(False))
    years = cells.select("year").distinct().agg(F.collect_list("year")).scalar()
    # Requests that ask for the same group and mileage share one point.
    asked = (
        _groups(requests.select("brand", "model", "mileage_in_km")).distinct()
        .withColumn("year", F.explode(years))
        .withColumns({s: F.lit(0).cast("bigint" if s == "n" else "double") for s in SUMS})
        .withColumn("asked", F.lit(True))
    )
    events = with_range(grouped.unionByName(asked), "mileage_in_km", balanced_cuts(cells, ["mileage_in_km"])[0])
    points = (
        running_totals(events, ["kind", "name", "year"], "mileage_in_km", SUMS)
        .filter("asked")
        .groupBy("kind", "name", "mileage_in_km")
        .agg(F.collect_list(F.struct("year", *[F.col(f"{s}_run").alias(s) for s in SUMS])).alias("per_year"))
    )
    totals = grouped.groupBy("kind", "name").agg(F.sum("n").alias("rows"))
    found = requests
    for kind, name in (("model", "model"), ("brand", "brand")):
        found = found.join(
            points.filter(F.col("kind") == kind).select(
                F.col("name").alias(name), "mileage_in_km", F.col("per_year").alias(f"_{kind}_years")),
            [name, "mileage_in_km"], "left",
        ).join(
            totals.filter(F.col("kind") == kind).select(F.col("name").alias(name), F.col("rows").alias(f"_{kind}_rows")),
            [name], "left")
    return found.join(
        points.filter(F.col("kind") == "all").select("mileage_in_km", F.col("per_year").alias("_all_years")),
        ["mileage_in_km"], "left")


def _targets(requests: DataFrame, sample: DataFrame, least: int) -> DataFrame:
    """Per request: the candidate group, the bounds of its filter and the scale of each dimension."""
    whole = sample.agg(F.struct(*[F.stddev_samp(c).alias(c) for c in DIMS])).scalar()

    def totals(kind: str, condition: str) -> str:
        """Sums over the years of a request's group, as a struct."""
        zero = ", ".join(f"'{s}', {'0L' if s == 'n' else '0D'}" for s in SUMS)
        added = ", ".join(f"'{s}', acc.{s} + t.{s}" for s in SUMS)
        return (f"aggregate(filter(_{kind}_years, t -> {condition}), named_struct({zero}), "
                f"(acc, t) -> named_struct({added}))")

    in_range, any_year = "t.year BETWEEN min_year AND max_year", "true"
    # Level 1 filters by mileage and years, level 2 by mileage, level 3 not at all.
    level = f"CASE WHEN _all_1.n >= {least} THEN 1 WHEN _all_2.n >= {least} THEN 2 ELSE 3 END"
    rows_of = lambda kind: (
        f"coalesce(CASE level WHEN 1 THEN _{kind}_1.n WHEN 2 THEN _{kind}_2.n ELSE _{kind}_rows END, 0L)")
    scale = lambda d, dim: (
        f"greatest(coalesce(CASE WHEN level = 3 THEN _whole.{dim} "
        f"ELSE sqrt(greatest(try_divide(_at.{d}2 - try_divide(_at.{d}1 * _at.{d}1, _at.n), _at.n - 1), 0D)) END, "
        f"1D), 1D) AS scale_{dim}")
    return (
        _filter_counts(requests, sample)
        .withColumn("_whole", whole)
        .selectExpr("*", *[f"{totals(kind, condition)} AS _{kind}_{i}" for kind in ("model", "brand", "all")
                           for i, condition in ((1, in_range), (2, any_year))])
        .selectExpr("*", f"{level} AS level")
        .selectExpr("*", "CASE level WHEN 1 THEN _all_1 ELSE _all_2 END AS _at",
                    f"CASE WHEN {rows_of('model')} >= {least} THEN 'model' WHEN {rows_of('brand')} >= {least} "
                    "THEN 'brand' ELSE 'all' END AS kind")
        .selectExpr(
            "request_id", "kind", "CASE kind WHEN 'model' THEN model WHEN 'brand' THEN brand ELSE '' END AS name",
            "level",
            "CASE WHEN level < 3 THEN mileage_in_km ELSE double('Infinity') END AS most_km",
            "CASE WHEN level = 1 THEN double(min_year) ELSE double('-Infinity') END AS first_year",
            "CASE WHEN level = 1 THEN double(max_year) ELSE double('Infinity') END AS last_year",
            *[f"{c} AS at_{c}" for c in DIMS],
            *[scale(d, dim) for d, dim in zip("myp", DIMS)],
        )
    )


PLACE = ("kind", "name", "cell")


def _tree(listed: DataFrame, leaf: int) -> list[tuple[DataFrame, DataFrame]]:
    """The listings of every group in cells, level by level: (rows still in question, the cells they lie in).

    A cell with more than `leaf` rows is cut at the medians of its rows in all dimensions at once, which gives up to eight
    cells of the next level; a digit is added to its name for each cut. Only rows of cells that are too large go on, so a
    level costs one count and one pass over them, and there are as many levels as the largest group needs. Cells
    whose rows are alike in all numbers are not cut. A row stands for as many listings as its column `held` says, if it has one.
    """
    size = F.sum("held") if "held" in listed.columns else F.count(F.lit(1))
    open_, levels = written(listed.withColumn("cell", F.lit("r")), "rows"), []
    while True:
        cells = written(open_.groupBy(*PLACE).agg(
            size.alias("rows"),
            *[e for c in DIMS for e in (F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"),
                                        F.percentile_approx(c, 0.5, 1000).alias(f"cut_{c}"))]), "cells")
        alike = " AND ".join(f"lo_{c} = hi_{c}" for c in DIMS)
        cells = cells.withColumn("leaf", F.expr(f"rows <= {leaf} OR ({alike})"))
        levels.append((open_, cells))
        wide = cells.where("NOT leaf").select(*PLACE, *[f"{e}_{c}" for c in DIMS for e in ("cut", "hi")])
        if wide.isEmpty():
            return levels
        # A cut at the largest value puts that value on the far side: both sides hold rows.
        sides = " + ".join(f"CASE WHEN {c} > cut_{c} OR ({c} = cut_{c} AND cut_{c} = hi_{c}) THEN {2 ** i} ELSE 0 END"
                           for i, c in enumerate(DIMS))
        open_ = written(open_.join(wide, list(PLACE)).withColumn("cell", F.expr(f"concat(cell, {sides})")).select(open_.columns), "rows")


def _search_plan(targets: DataFrame, levels: list[tuple[DataFrame, DataFrame]], n: int) -> DataFrame:
    """Per request, the leaves that can hold one of its n nearest listings.

    A request goes down from the one cell of its group. At every level the far ends of the cells that lie wholly inside
    its filter give a distance within which n listings are certain, and only cells that begin within it are opened:
    some tens of them at a level, however many there are.
    """
    near = " + ".join(f"greatest(lo_{d} - at_{d}, at_{d} - hi_{d}, 0D) / scale_{d}" for d in DIMS)
    far = " + ".join(f"greatest(abs(at_{d} - lo_{d}), abs(at_{d} - hi_{d})) / scale_{d}" for d in DIMS)
    km, year = DIMS[0], DIMS[1]
    touches = f"lo_{km} <= most_km AND hi_{year} >= first_year AND lo_{year} <= last_year"
    inside = f"hi_{km} <= most_km AND lo_{year} >= first_year AND hi_{year} <= last_year"
    judged = targets.columns + ["cell", "leaf", "near", "far", "sure"]
    upto = Window.partitionBy("request_id").orderBy("far", "cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy("request_id")
    frontier, rest = None, targets.withColumn("parent", F.lit(""))
    for _, cells in levels:
        children = cells.withColumn("parent", F.expr("substr(cell, 1, length(cell) - 1)")).drop(*[f"cut_{c}" for c in DIMS])
        met = rest.join(children, ["kind", "name", "parent"]).where(touches).withColumns(
            {"near": F.expr(near), "far": F.expr(far), "sure": F.expr(f"CASE WHEN {inside} THEN rows ELSE 0L END")}).select(*judged)
        # The slack covers the rounding of the bounds.
        reach = F.coalesce(F.min(F.when(F.col("have") >= n, F.col("far"))).over(every), F.lit(float("inf")))
        frontier = met if frontier is None else frontier.unionByName(met)
        frontier = written(frontier.withColumn("have", F.sum("sure").over(upto)).withColumn("reach", reach)
                           .where(F.col("near") <= F.col("reach") * (1 + 1e-9) + 1e-9).select(*judged), "frontier")
        rest = frontier.where("NOT leaf").drop("leaf", "near", "far", "sure").withColumnRenamed("cell", "parent")
        frontier = frontier.where("leaf")
    return frontier.drop("leaf", "near", "far", "sure")


def similar_listings(requests: DataFrame, sample: DataFrame, n: int = 8, least: int = 5,
                     key: str = "listing_id") -> DataFrame:
    """The n nearest listings of each request, `rank` 1 first; equal distances by listing key.

    Requests: request_id, brand, model, year, min_year, max_year, power_ps, mileage_in_km, none of the
    numbers NULL. Sample: cleaned listings with a key that no two of them share.
    """
    pairs = met_listings(requests, sample, n, least, key)
    score = sum((F.abs(F.col(c) - F.col(f"at_{c}")) / F.col(f"scale_{c}") for c in DIMS[1:]),
                F.abs(F.col(DIMS[0]) - F.col(f"at_{DIMS[0]}")) / F.col(f"scale_{DIMS[0]}"))
    # The limit on the rank is applied in every task before the shuffle.
    nearest = Window.partitionBy("request_id").orderBy("score", key)
    found = (
        pairs.filter((F.col("mileage_in_km") <= F.col("most_km"))
                     & F.col("year").between(F.col("first_year"), F.col("last_year")))
        .withColumn("score", score)
        .withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= n)
        .select("request_id", "rank", "score", F.col("kind").alias("matched_on"), key)
    )
    return found.join(sample.withColumns({c: F.col(c).cast("double") for c in DIMS}), key).select(
        "request_id", "rank", "score", "matched_on", *sample.columns)


def met_listings(requests: DataFrame, sample: DataFrame, n: int = 8, least: int = 5, key: str = "listing_id") -> DataFrame:
    """The pairs that are compared: every request beside the listings of the cells that can hold a nearest one."""
    numbers = {c: F.col(c).cast("double") for c in DIMS}
    sample, requests = sample.withColumns(numbers), requests.withColumns(numbers)
    # Written, so that the size of the plan is known when the listings are joined: Spark broadcasts it
    # while it is small and shuffles both sides when it is not.
    targets = written(_targets(requests, sample, least), "targets")
    # Of listings alike in all three numbers only the n first keys can be among the n nearest of any request,
    # so a crowd of copies shrinks to n rows in every task, before the shuffle.
    copies = Window.partitionBy("brand", "model", *DIMS).orderBy(key)
    listed = sample.select("brand", "model", *DIMS, key).withColumn("_copy", F.row_number().over(copies)).filter(F.col("_copy") <= n)
    listed = written(listed.drop("_copy"), "listed")
    # What is cut, level by level, is the numbers that listings have, each once and without keys: a level writes little.
    points = _groups(listed.groupBy("brand", "model", *DIMS).agg(F.count(F.lit(1)).alias("held"))).groupBy(
        "kind", "name", *DIMS).agg(F.least(F.sum("held"), F.lit(n)).alias("held"))
    levels = _tree(points, LEAF)
    plan = written(_search_plan(targets, levels, n), "search-plan")
    leaves = plan.select(*PLACE).distinct()
    point = F.struct(*DIMS).alias("point")
    places = reduce(DataFrame.unionByName, [
        rows.join(leaves, list(PLACE), "left_semi").select(*PLACE, point) for rows, _ in levels])
    alike = Window.partitionBy("kind", "name", "point").orderBy(key)
    held = _groups(listed.select("brand", "model", point, key)).join(places, ["kind", "name", "point"])
    held = held.withColumn("_copy", F.row_number().over(alike)).filter(F.col("_copy") <= n).select(*PLACE, "point.*", key)
    return plan.join(held, list(PLACE))


def display_labels(similar: DataFrame) -> DataFrame:
    """Similar listings as shown to a person."""
    return similar.select(
        title_label(F.col("brand")).alias("Brand"),
        F.col("model").alias("Model"),
        F.col("year").cast("int").alias("Year"),
        F.col("mileage_in_km").cast("int").alias("Mileage (km)"),
        F.col("fuel_type").alias("Fuel"),
        F.col("transmission_type").alias("Transmission"),
        F.col("power_ps").cast("int").alias("HP (PS)"),
        euro(F.col("price_in_euro")).alias("Price (€)"),
    )
