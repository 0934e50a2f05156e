"""Interval, band and as-of joins on equi-join keys.

Spark plans a range predicate as a nested loop. Here intervals are dealt into
bins of a fixed width and joined to points on (group, bin), so the join is a
shuffle on that key, with the range as the residual predicate. The bin should be near the
intervals' usual length; a long interval is in several bins, never a point.

What runs along a group (maxima, ranks, sums, the latest event) is computed bin by bin of STRETCH places, and what the bins
before bring is carried in: a bin is reduced to its last state, and only these run along the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Places of a bin of what runs along a group. A task sorts one bin, and a group has a state for each bin.
STRETCH = 1 << 18


def carried(rows: DataFrame, group: list[str], at: str, states: dict[str, Column], run: dict[str, Column], width: int = STRETCH) -> DataFrame:
    """rows with a column ``name`` for each of states: what it comes to over all earlier bins of its group (null in the first), and ``__bin``.

    states: aggregates of a bin. run: for each an aggregate over the column of its name that merges the states of several bins, in their order.
    """
    dealt = rows.withColumn("__bin", F.floor(F.col(at) / width))
    each = dealt.groupBy(*group, "__bin").agg(*[c.alias(n) for n, c in states.items()])
    before = Window.partitionBy(*group).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    base = each.select(*group, "__bin", *[run[n].over(before).alias(n) for n in states])
    return dealt.join(base, [*group, "__bin"], "left")


def running_end(intervals: DataFrame, out: str, group: str = "chrom", start: str = "start", end: str = "end", inclusive: bool = True, width: int = STRETCH) -> DataFrame:
    """intervals with ``out``: the greatest end of those up to (or, not inclusive, before) each in order of start and end."""
    rows = carried(intervals, [group], start, {"__high": F.max(end)}, {"__high": F.max("__high")}, width)
    order = Window.partitionBy(group, "__bin").orderBy(start, end).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    return rows.withColumn(out, F.greatest(F.max(end).over(order), "__high")).drop("__bin", "__high")


def bins(start: Column, end: Column, width: int) -> Column:
    """Bins that the half-open interval [start, end) touches."""
    return F.when(end > start, F.sequence(F.floor(start / width), F.floor((end - 1) / width)))


def points_in_intervals(points: DataFrame, intervals: DataFrame, pos: str, group: str = "chrom", start: str = "start", end: str = "end", width: int = 1 << 14) -> DataFrame:
    """Inner join of points and the intervals that hold them: a row for each pair."""
    dealt = intervals.withColumn("__bin", F.explode(bins(F.col(start), F.col(end), width)))
    at = points.withColumn("__bin", F.floor(F.col(pos) / width))
    return at.join(dealt, [group, "__bin"]).filter((F.col(pos) >= F.col(start)) & (F.col(pos) < F.col(end))).drop("__bin")


def merged(intervals: DataFrame, group: str = "chrom", start: str = "start", end: str = "end") -> DataFrame:
    """Union of the intervals of each group as disjoint intervals, by running maximum of ends."""
    rows = running_end(intervals.select(group, start, end).filter(F.col(end) > F.col(start)), "__before", group, start, end, inclusive=False)
    # an island begins where nothing before reaches; its number is the count of such beginnings up to it
    rows = rows.withColumn("__new", F.when(F.col(start) > F.coalesce("__before", F.lit(-(1 << 62))), 1).otherwise(0)).drop("__before")
    rows = carried(rows, [group], start, {"__n": F.sum("__new")}, {"__n": F.sum("__n")})
    # of equal intervals the one that begins the island comes first
    order = Window.partitionBy(group, "__bin").orderBy(start, end, F.desc("__new")).rowsBetween(Window.unboundedPreceding, 0)
    island = F.coalesce("__n", F.lit(0)) + F.sum("__new").over(order)
    return rows.withColumn("__i", island).groupBy(group, "__i").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__i")


def contained(points: DataFrame, intervals: DataFrame, pos: str, flag: str = "inside", group: str = "chrom", start: str = "start", end: str = "end", width: int = 1 << 14) -> DataFrame:
    """points with a boolean: some interval holds the point. Any overlaps; a row for each point."""
    disjoint = merged(intervals, group, start, end)
    dealt = disjoint.withColumn("__bin", F.explode(bins(F.col(start), F.col(end), width))).select(group, "__bin", F.col(start).alias("__s"), F.col(end).alias("__e"))
    # disjoint intervals: at most one pair a bin and point survives, but a bin may hold several
    spans = dealt.groupBy(group, "__bin").agg(F.collect_list(F.struct("__s", "__e")).alias("__spans"))
    at = points.withColumn("__bin", F.floor(F.col(pos) / width)).join(spans, [group, "__bin"], "left")
    hit = F.exists("__spans", lambda x: (x["__s"] <= F.col(pos)) & (F.col(pos) < x["__e"]))
    return at.withColumn(flag, F.coalesce(hit, F.lit(False))).drop("__bin", "__spans")


def band(left: DataFrame, right: DataFrame, left_pos: str, right_pos: str, radius: int, group: str = "chrom") -> DataFrame:
    """Pairs within radius of each other: left is dealt to the bins around it, right is not copied."""
    width = max(1, radius)
    near = F.sequence(F.floor((F.col(left_pos) - radius) / width), F.floor((F.col(left_pos) + radius) / width))
    a = left.withColumn("__bin", F.explode(near))
    b = right.withColumn("__bin", F.floor(F.col(right_pos) / width))
    return a.join(b, [group, "__bin"]).filter(F.abs(F.col(left_pos) - F.col(right_pos)) <= radius).drop("__bin")


def latest_before(points: DataFrame, events: DataFrame, pos: str, event_pos: str, payload: list[str], group: str = "chrom", width: int = STRETCH) -> DataFrame:
    """As-of join: with each point the last event at or before it (by event_pos, then payload order). A sort a bin; earlier bins' last event is carried in."""
    p = points.select("*", F.col(pos).cast("long").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(f"struct<{', '.join(f'{n}:{t}' for n, t in events.select(*payload).dtypes)}>").alias("__e"))
    e = events.select(group, F.col(event_pos).cast("long").alias("__at"), F.lit(0).alias("__kind"), F.struct(*payload).alias("__e"))
    both = p.unionByName(e, allowMissingColumns=True)
    last = F.max(F.when(F.col("__kind") == 0, F.struct("__at", "__e")))
    both = carried(both, [group], "__at", {"__carry": last}, {"__carry": F.max("__carry")}, width)
    order = Window.partitionBy(group, "__bin").orderBy("__at", "__kind", "__e").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__l", F.coalesce(F.last("__e", ignorenulls=True).over(order), F.col("__carry")["__e"])).filter("__kind = 1")
    return found.select(*points.columns, *[F.col(f"__l.{c}").alias(c) for c in payload])


def first_containing(points: DataFrame, intervals: DataFrame, pos: str, order: list[str], group: str = "chrom", start: str = "start", end: str = "end", key: str = "ord", width: int = 1 << 14, horizon: int | None = None) -> DataFrame:
    """points LEFT JOIN the first interval, in the given order, that holds each.

    horizon: only the last so many intervals that start at or before the point are looked
    at (by rank of start), as a walk-back of bounded length does. key: unique per point.
    """
    ranked = intervals
    if horizon is not None:
        ranked = carried(intervals, [group], start, {"__n": F.count("*")}, {"__n": F.sum("__n")})
        ranked = ranked.withColumn("__rank", F.coalesce("__n", F.lit(0)) + F.row_number().over(Window.partitionBy(group, "__bin").orderBy(start, *order))).drop("__n", "__bin")
        points_at = latest_before(points, ranked, pos, start, ["__rank"], group)
        pairs = points_in_intervals(points_at.withColumnRenamed("__rank", "__last"), ranked, pos, group, start, end, width)
        pairs = pairs.filter(F.col("__rank") > F.col("__last") - horizon).drop("__last", "__rank")
    else:
        pairs = points_in_intervals(points, ranked, pos, group, start, end, width)
    first = Window.partitionBy(key).orderBy(*order)
    best = pairs.withColumn("__k", F.row_number().over(first)).filter("__k = 1")
    extra = [c for c in intervals.columns if c != group]
    return points.join(best.select(key, *extra), key, "left")
