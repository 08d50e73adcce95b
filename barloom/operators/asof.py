"""Backward as-of joins: each left row meets the latest earlier right row.

`asof_calendar` serves daily reference series: they are spread to one row per calendar
day, and the join becomes an equality on the day. `asof_keyed` serves two large keyed
tables at any time grain: both sides are merged in time order and the right row is
carried forward.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _spans(macro: DataFrame, columns: Mapping[str, str], lag_days: int) -> DataFrame:
    """Each observation with the first and last day on which it is the visible one, one row
    per year of that span.

    A year is `marked` when some observation begins or ends to be visible in it. The input
    has one row per series and day, so the chosen series fit one partition at any data
    volume, and every later step stays in it.
    """
    spans = (
        macro.where(F.col("series_id").isin(list(columns))).repartition(1)
        .selectExpr("series_id", "date", "value",
                    "lead(date) OVER (PARTITION BY series_id ORDER BY date) AS next_date")
        .where("next_date IS NULL OR next_date > date")
        .selectExpr("series_id", "value", f"date_add(date, {lag_days}) AS since",
                    f"coalesce(date_add(next_date, {lag_days - 1}), DATE '9999-12-31') AS until")
        .where("since <= until")
    )
    marked = spans.selectExpr("explode(array(year(since), year(until))) AS year").distinct()
    return (
        spans.selectExpr("*", "explode(sequence(year(since), year(until))) AS year")
        # One row per calendar year at most.
        .join(F.broadcast(marked.selectExpr("year", "true AS marked")), "year", "left")
    )


def _pivoted(spans: DataFrame, key: str, columns: Mapping[str, str]) -> DataFrame:
    """One row per key with a struct of all series' values; keys some series lacks go.

    The spans of a series do not overlap, so each gives a key one row; counting rows
    apart from values lets a NULL observation count as present.
    """
    per_series = [F.expr(f"max(CASE WHEN series_id = '{series_id}' THEN value END) AS {name}")
                  for series_id, name in columns.items()]
    return (
        spans.groupBy(key).agg(*per_series, F.count("*").alias("_series"))
        .where(f"_series = {len(columns)}")
        .selectExpr(key, f"struct({', '.join(columns.values())}) AS _at_{key}")
    )


def calendar(macro: DataFrame, columns: Mapping[str, str],
             lag_days: int = 1) -> tuple[DataFrame, DataFrame]:
    """The values visible on each day, as two lookup tables: by day and by whole year.

    A value dated d is visible from d + lag_days until the series' next one is. Years in
    which nothing changes are one row each, to 9999, so a date far from the others costs its
    own year and no more. A NULL observation shows as NULL, not as the older value.
    """
    spans = _spans(macro, columns, lag_days)
    days = spans.where("marked").selectExpr("series_id", "value", """
        explode(sequence(greatest(since, make_date(year, 1, 1)),
                         least(until, make_date(year, 12, 31)))) AS day""")
    years = spans.where("marked IS NULL").select("series_id", "value", "year")
    return _pivoted(days, "day", columns), _pivoted(years, "year", columns)


def asof_calendar(left: DataFrame, macro: DataFrame, columns: Mapping[str, str],
                  lag_days: int = 1) -> DataFrame:
    """Inner as-of join of `left` (by its date) with every series named in `columns`.

    Both lookups are broadcast. Their size depends on the calendar, not on the data: one
    row per day of the years with observations (ten years are 3,653 rows) and one per other
    year to 9999.
    """
    days, years = calendar(macro, columns, lag_days)
    return (
        left.join(F.broadcast(days), F.expr("date = day"), "left")
        .join(F.broadcast(years), F.expr("year(date) = year"), "left")
        .withColumn("_found", F.expr("coalesce(_at_day, _at_year)")).where("_found IS NOT NULL")
        .select(*left.columns, "_found.*")
    )


def by_day(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def asof_keyed(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str,
               values: Mapping[str, str], strict: bool = True,
               unit: Callable[[Column], Column] = by_day, tie: str | None = None) -> DataFrame:
    """Left as-of join of two keyed tables, both free to be large.

    `values` maps right columns to their names in the result; they are NULL where no
    right row is early enough. `strict` asks for right.ts < left.ts, else <=. NULL keys and
    times match nothing. Of several right rows at one moment the one with the greatest
    `tie`, then the greatest values, is taken.

    Both sides shrink to one row per key and moment before the shuffle. Every key is cut by
    the calendar (`unit`, a function of the time that keeps its order), so a window group
    holds the moments of one unit; the last right row of each unit is carried on through a
    table with one row per key and unit. Rows that share a moment meet its answer in an equi
    join, which AQE splits where one moment is hot. NULL keys and times take no part in it.
    """
    keys = list(keys)
    names = list(values.values())
    whole = F.lit(True)
    for c in (*keys, ts):
        whole = whole & F.col(c).isNotNull()
    found = F.struct(*([F.col(tie).alias("_tie")] if tie else []),
                     *(F.col(c).alias(n) for c, n in values.items()))
    moments = right.where(whole).groupBy(*keys, ts).agg(F.max(found).alias("_right"))
    left_first, right_first = (0, 1) if strict else (1, 0)
    asked = left.where(whole).select(*keys, ts).distinct()
    merged = (
        asked.select(*keys, ts, F.lit(left_first).alias("_side"), F.lit(None).alias("_right"))
        .unionByName(moments.select(*keys, ts, F.lit(right_first).alias("_side"), "_right"))
        .withColumn("_unit", unit(F.col(ts)))
    )
    so_far = (Window.partitionBy(*keys, "_unit").orderBy(ts, "_side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = merged.withColumn("_right", F.last("_right", ignorenulls=True).over(so_far)).where(
        F.col("_side") == left_first)
    earlier = (Window.partitionBy(*keys).orderBy("_unit")
               .rowsBetween(Window.unboundedPreceding, -1))
    units = (
        merged.groupBy(*keys, "_unit")
        .agg(F.max_by("_right", F.when(F.col("_right").isNotNull(), F.col(ts))).alias("_last"))
        .withColumn("_carry", F.last("_last", ignorenulls=True).over(earlier))
        .where(F.col("_carry").isNotNull()).drop("_last")
    )
    answers = inside.join(units, [*keys, "_unit"], "left").select(
        *keys, ts, F.coalesce("_right", "_carry").alias("_right"))
    rest = [c for c in left.columns if c not in (*keys, ts)]
    joined = left.where(whole).join(answers, [*keys, ts], "left").select(
        *keys, ts, *rest, *(F.col(f"_right.{n}").alias(n) for n in names))
    kinds = {n: right.schema[c].dataType for c, n in values.items()}
    alone = left.where(~whole).select(
        *keys, ts, *rest, *(F.lit(None).cast(kinds[n]).alias(n) for n in names))
    return joined.unionAll(alone)
