"""Column expressions over one ordered series per key.

A window `w` is the text of a partition and order clause, from `ordered`. Frames look
back only: the current row and the n-1 rows before it. The expressions are SQL text
because a feature plan has many of them, and each text is one call into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered(*keys: str, by: str = "date") -> str:
    return f"PARTITION BY {', '.join(keys)} ORDER BY {by}"


def trailing(w: str, n: int) -> str:
    return f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def previous(value: str, w: str) -> Column:
    return F.expr(f"lag({value}) OVER ({w})")


def following(value: str, w: str) -> Column:
    return F.expr(f"lead({value}) OVER ({w})")


def place(w: str) -> Column:
    return F.expr(f"row_number() OVER ({w})")


def change_from(earlier: str, current: str) -> Column:
    """(current - earlier) / earlier; NULL without an earlier value or after a zero."""
    return F.expr(f"try_divide({current} - {earlier}, {earlier})")


def rolling_mean(value: str, w: str, n: int, place: str) -> Column:
    """Mean of the last n rows, NULL until n rows exist.

    `place` is the row's number in its series. It answers "do n rows exist" once for all
    frames; a count(*) per frame would be walked again for every row.
    """
    return F.expr(f"CASE WHEN {place} >= {n} THEN avg({value}) OVER {trailing(w, n)} END")


def rolling_stddev(value: str, w: str, n: int) -> Column:
    """Sample standard deviation of the last n rows, NULL unless all n are non-null."""
    frame = trailing(w, n)
    return F.expr(f"CASE WHEN count({value}) OVER {frame} >= {n} "
                  f"THEN stddev_samp({value}) OVER {frame} END")


def rolling_zscore(value: str, w: str, n: int) -> Column:
    """Distance of the current value from its n-row mean in n-row standard deviations.

    NULL unless all n values are non-null, which also makes the mean sum / n, and NULL
    when they are all equal.
    """
    frame, number = trailing(w, n), f"double({value})"
    return F.expr(f"CASE WHEN count({value}) OVER {frame} >= {n} THEN try_divide("
                  f"{number} - sum({number}) OVER {frame} / {n}, "
                  f"nullif(stddev_samp({number}) OVER {frame}, 0D)) END")


def is_higher(following: str, current: str) -> Column:
    """1 if the next row's value is higher, 0 if not, NULL without a next row."""
    return F.expr(f"CASE WHEN {following} IS NULL THEN NULL "
                  f"WHEN {following} > {current} THEN 1 ELSE 0 END")


def clip_below(value: str, floor: float = 0.0) -> str:
    """max(value, floor); a NULL stays NULL (greatest alone would return the floor)."""
    return f"CASE WHEN {value} IS NOT NULL THEN greatest({value}, {floor}D) END"


def with_rsi(df: DataFrame, source: str, w: str, n: int = 14, name: str = "rsi_14") -> DataFrame:
    """Relative strength of the differences of `source`, from simple n-row means.

    NULL until n differences exist, and NULL (not 100) when the mean loss is zero. The
    two means have the same divisor, so their ratio is that of the sums.
    """
    frame = trailing(w, n)
    return (
        df.withColumn("_step", F.expr(f"{source} - lag({source}) OVER ({w})"))
        .withColumn("_strength", F.expr(
            f"CASE WHEN count(_step) OVER {frame} = {n} THEN try_divide("
            f"sum({clip_below('_step')}) OVER {frame}, "
            f"nullif(sum({clip_below('-_step')}) OVER {frame}, 0D)) END"))
        .withColumn(name, F.expr("100 - 100 / (1 + _strength)"))
        .drop("_step", "_strength")
    )
