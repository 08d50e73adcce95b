"""As-of joins against brute force."""

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators.asof import asof_calendar, asof_keyed, calendar

START = date(1999, 12, 20)
COLUMNS = {"X": "x", "Y": "y"}
FEW = settings(max_examples=8, deadline=None,
               suppress_health_check=[HealthCheck.function_scoped_fixture])

days = st.integers(0, 40)
values = st.one_of(st.none(), st.floats(-5, 5, allow_nan=False).map(lambda v: round(v, 2)))


def day(n):
    return START + timedelta(days=n)


def latest(series, before):
    """(found, value) of the newest observation dated before `before`."""
    earlier = [(d, v) for d, v in series.items() if d < before]
    return (True, max(earlier, key=lambda p: p[0])[1]) if earlier else (False, None)


def calendar_frames(spark, left, x, y):
    bars = spark.createDataFrame([("A", d) for d in left], "ticker string, date date")
    macro = spark.createDataFrame(
        [(s, d, v) for s, obs in (("X", x), ("Y", y), ("Z", {day(0): 1.0})) for d, v in obs.items()],
        "series_id string, date date, value double")
    return bars, macro


def check_calendar(spark, left, x, y, lag=1):
    bars, macro = calendar_frames(spark, left, x, y)
    want = []
    for d in left:
        (has_x, vx), (has_y, vy) = (latest(s, d - timedelta(days=lag - 1)) for s in (x, y))
        if has_x and has_y:
            want.append(("A", d, vx, vy))
    got = rows(asof_calendar(bars, macro, COLUMNS, lag))
    assert got == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])


@FEW
@given(left=st.sets(days, min_size=1), x=st.dictionaries(days, values, min_size=1),
       y=st.dictionaries(days, values, min_size=1), lag=st.integers(1, 3))
def test_calendar_equals_brute_force(spark, left, x, y, lag):
    check_calendar(spark, [day(n) for n in left], {day(n): v for n, v in x.items()},
                   {day(n): v for n, v in y.items()}, lag)


def test_bars_long_after_the_last_observation(spark):
    x, y = {day(3): 1.0}, {day(5): 2.0, day(8): None}
    left = [day(6), day(9), date(1999, 12, 31), date(2000, 1, 1), date(2000, 12, 31),
            date(2001, 1, 1), date(2031, 7, 4)]
    check_calendar(spark, left, x, y)


def test_same_day_observation_is_not_seen(spark):
    bars, macro = calendar_frames(spark, [day(5)], {day(5): 1.0}, {day(1): 1.0})
    assert asof_calendar(bars, macro, COLUMNS).count() == 0


def test_null_observation_hides_the_older_value(spark):
    bars, macro = calendar_frames(spark, [day(5)], {day(1): 1.0, day(3): None}, {day(1): 2.0})
    assert rows(asof_calendar(bars, macro, COLUMNS)) == [("A", day(5), None, 2.0)]


def test_missing_series_leaves_nothing(spark):
    bars, macro = calendar_frames(spark, [day(5)], {day(1): 1.0}, {})
    assert asof_calendar(bars, macro, COLUMNS).count() == 0


def test_a_far_date_costs_its_own_year(spark):
    _, macro = calendar_frames(spark, [day(5)], {day(1): 1.0, date(9999, 12, 30): 2.0}, {day(1): 1.0})
    days, years = calendar(macro, COLUMNS)
    assert days.count() < 4 * 366 and years.count() < 8100
    check_calendar(spark, [day(5), date(5000, 1, 1), date(9999, 12, 31)],
                   {day(1): 1.0, date(9999, 12, 30): 2.0}, {day(1): 1.0})


def moment(n):
    return datetime(2020, 1, 1) + timedelta(minutes=n)


def keyed_frames(spark, left, right):
    lf = spark.createDataFrame([(k, moment(t), i) for i, (k, t) in enumerate(left)],
                               "k string, ts timestamp, left_id int")
    rf = spark.createDataFrame([(k, moment(t), v) for (k, t), v in right.items()],
                               "k string, ts timestamp, v double")
    return lf, rf


def check_keyed(spark, left, right, strict, **options):
    lf, rf = keyed_frames(spark, left, right)
    want = []
    for i, (k, t) in enumerate(left):
        found = [(rt, v) for (rk, rt), v in right.items()
                 if rk == k and (rt < t if strict else rt <= t)]
        want.append((k, moment(t), i, max(found, key=lambda p: p[0])[1] if found else None))
    got = rows(asof_keyed(lf, rf, ["k"], "ts", {"v": "seen"}, strict, **options))
    assert got == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])


keyed = st.tuples(st.sampled_from("aab"), st.integers(0, 30))


@pytest.mark.parametrize("options", [{}, {"unit": lambda t: F.date_trunc("minute", t)},
                                     {"unit": lambda t: F.floor(F.minute(t) / 7)}])
@FEW
@given(left=st.lists(keyed, min_size=1, max_size=25),
       right=st.dictionaries(keyed, values, min_size=1, max_size=25), strict=st.booleans())
def test_keyed_equals_brute_force(spark, options, left, right, strict):
    check_keyed(spark, left, right, strict, **options)


@pytest.mark.parametrize("unit", ["minute", "hour", "year"])
def test_one_key_holding_most_rows(spark, unit):
    left = [("hot", t) for t in range(1, 400, 3)] + [("cold", 50)]
    right = {("hot", t): float(t) for t in range(0, 400, 40)} | {("cold", 10): 1.0}
    check_keyed(spark, left, right, True, unit=lambda t: F.date_trunc(unit, t))


def test_many_rows_at_one_moment(spark):
    left = [("hot", 5)] * 60 + [("hot", 9)] * 60
    check_keyed(spark, left, {("hot", 5): 1.0, ("hot", 4): 2.0}, True)


def test_ties_do_not_depend_on_the_layout(spark):
    lf, _ = keyed_frames(spark, [("a", 9)], {("a", 1): 0.0})
    rf = spark.createDataFrame([("a", moment(3), float(i % 37), i) for i in range(50)],
                               "k string, ts timestamp, v double, n int")
    for parts in (1, 3, 7):
        got = asof_keyed(lf, rf.repartition(parts), ["k"], "ts", {"v": "seen"}, tie="n").first()
        assert got.seen == 12.0


@pytest.mark.parametrize("key,when", [(None, "2020-01-01 00:05:00"), ("hot", None)])
def test_rows_without_key_or_time_are_not_shuffled(spark, key, when):
    left = spark.range(0, 20_000, 1, 8).select(
        F.lit(key).cast("string").alias("k"), F.lit(when).cast("timestamp").alias("ts"), "id")
    _, right = keyed_frames(spark, [("a", 9)], {("hot", 1): 1.0})
    got = asof_keyed(left, right, ["k"], "ts", {"v": "seen"})
    per_task = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(per_task) == 20_000 and max(per_task) <= 2 * sum(per_task) / len(per_task)
    assert got.where("seen IS NOT NULL").count() == 0


def test_null_keys_and_times_match_nothing(spark):
    lf = spark.createDataFrame([(None, moment(5), 1), ("a", None, 2), ("a", moment(5), 3)],
                               "k string, ts timestamp, left_id int")
    rf = spark.createDataFrame([(None, moment(1), 1.0), ("a", None, 2.0), ("b", moment(1), 3.0)],
                               "k string, ts timestamp, v double")
    got = asof_keyed(lf, rf, ["k"], "ts", {"v": "seen"})
    assert {(r.left_id, r.seen) for r in got.collect()} == {(1, None), (2, None), (3, None)}
