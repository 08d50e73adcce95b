"""Loads, audit, quality checks, landing folders and stored tables."""

from dataclasses import replace
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from barloom.operators import insert as I
from barloom.operators import quality as Q
from barloom.operators.audit import LoadError
from barloom.plans import ingest as G
from barloom.schemas import BAR_COLS, BASE_TABLES, FEATURES
from barloom.settings import MACRO_SERIES, Settings, parse_list
from barloom.sources import landing as L
from barloom.sources.commits import CommitConflict
from barloom.sources.store import Commit, ConstraintError, Store
from barloom.streaming.arrivals import load_arrivals

SETTINGS = Settings(as_of=date(2021, 1, 31), cutoff=date(2020, 6, 1), tickers=("A", "B", "C"))
BATCH = "ticker string, date date, open double, high double, low double, close double, " \
        "adj_close double, volume long, ingest_seq long, _bad string"


def bar(ticker, day, price, seq=1, bad="", volume=10):
    return (ticker, day, price, price, price, price, price, volume, seq, bad)


def batch(spark, *items):
    return spark.createDataFrame(list(items), BATCH)


def macro_batch(spark, *items):
    return spark.createDataFrame(
        list(items), "series_id string, date date, value double, ingest_seq long, _bad string")


def stored(store):
    return rows(store.read("raw_prices").select("ticker", "date", "adj_close"))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def test_tables_are_created_once(spark, store):
    store.create_missing()
    for name, schema in BASE_TABLES.items():
        read = store.read(name)
        assert read.count() == 0
        assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in schema]
    store.append("raw_prices", batch(spark, bar("A", date(2021, 1, 4), 1.0)))
    store.create_missing()
    assert store.read("raw_prices").where("ingested_at IS NOT NULL").count() == 1


def test_stored_row_and_first_copy_win(spark, store):
    d1, d2 = date(2021, 1, 4), date(2021, 1, 5)
    G.run_load(store, G.PRICES, batch(spark, bar("A", d1, 1.0)), SETTINGS, "r1", False)
    second = batch(spark, bar("A", d1, 9.0), bar("A", d2, 3.0, 2), bar("A", d2, 2.0, 1))
    G.run_load(store, G.PRICES, second, SETTINGS, "r2", False)
    assert stored(store) == [("A", d1, 1.0), ("A", d2, 2.0)]


def test_an_append_writes_few_files(spark, store):
    days = [bar(t, date(2021, 1, d), 1.0) for t in "AB" for d in range(1, 15)]
    store.append("raw_prices", batch(spark, *days).repartition(14))
    files = store.read("raw_prices").select(F.input_file_name()).distinct().count()
    assert files == 1 and len(stored(store)) == 28


def test_load_twice_equals_load_once(spark, store):
    items = batch(spark, bar("A", date(2021, 1, 4), 1.0), bar("B", date(2020, 12, 30), 2.0))
    for run in ("r1", "r2"):
        G.run_load(store, G.PRICES, items, SETTINGS, run, False)
    assert len(stored(store)) == 2
    assert store.read("ingestion_log").count() == 6


def test_watermark_and_its_fallback(spark, store):
    store.create_missing()
    store.append("raw_prices", batch(spark, bar("A", date(2021, 1, 4), 1.0)))
    got = rows(I.load_watermark(store.high_water("raw_prices"),
                                G.entity_frame(spark, "ticker", ["A", "B"]), "ticker",
                                SETTINGS.as_of, 5))
    first = date(2016, 2, 2)      # 1,825 days before 31 January 2021
    assert got == [("A", date(2021, 1, 4), date(2021, 1, 5)), ("B", first, date(2016, 2, 3))]


def test_late_rows_stay_behind_the_watermark(spark, store):
    G.run_load(store, G.PRICES, batch(spark, bar("A", date(2021, 1, 4), 1.0)), SETTINGS, "r1")
    late = batch(spark, bar("A", date(2021, 1, 2), 5.0), bar("A", date(2021, 1, 5), 6.0),
                 bar("Z", date(2021, 1, 5), 7.0))
    G.run_load(store, G.PRICES, late, SETTINGS, "r2")
    assert stored(store) == [("A", date(2021, 1, 4), 1.0), ("A", date(2021, 1, 5), 6.0)]


def test_one_bad_entity_does_not_stop_the_others(spark, store):
    d = date(2021, 1, 4)
    prices = batch(spark, bar("A", d, 1.0), bar("B", d, 2.0), bar("B", None, 2.0, 2, "date"),
                   bar("A", date(2021, 1, 5), None))
    macro = macro_batch(spark, ("FEDFUNDS", d, 1.0, 1, ""), ("FEDFUNDS", date(2021, 1, 5), None, 1, ""))
    with pytest.raises(LoadError, match="tickers: B$"):
        G.daily_load(store, prices, macro, SETTINGS, "r1")
    assert stored(store) == [("A", d, 1.0)]
    log = {r.ticker: r for r in store.read("ingestion_log").collect()}
    assert (log["A"].rows_loaded, log["A"].status, log["A"].error_msg) == (1, "success", None)
    assert (log["B"].rows_loaded, log["B"].status) == (0, "failed")
    assert "1 row(s)" in log["B"].error_msg
    assert (log["C"].rows_loaded, log["C"].status) == (0, "success")
    assert log["FEDFUNDS"].rows_loaded == 1 and log["FEDFUNDS"].source != log["A"].source
    assert all(r.started_at and r.finished_at for r in log.values())


def test_one_key_repeated_many_times(spark):
    copies = spark.range(20_000).select(
        F.lit("A").alias("ticker"), F.lit(date(2021, 1, 4)).alias("date"),
        F.col("id").cast("double").alias("adj_close"), (F.lit(20_000) - F.col("id")).alias("seq"))
    assert I.first_per_key(copies, ["ticker", "date"], "seq").first().adj_close == 19_999.0


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_text_landing_keeps_rows_that_do_not_parse(spark, tmp_path, fmt):
    path = str(tmp_path / "in")
    text = spark.createDataFrame(
        [("A", "2021-01-04", "1", "2", "0.5", "1.5", "1.5", "10"),
         ("B", "2021-01-04", "1", "2", "0.5", "1.5", "n/a", "10"),
         ("B", "someday", "1", "2", "0.5", "1.5", "1.5", "x")], list(BAR_COLS))
    text.write.partitionBy("ticker").option("header", "true").format(fmt).save(path)
    options = {"header": "true"} if fmt == "csv" else {}
    got = L.read_landing(spark, path, fmt, L.BARS, **options)
    assert rows(got.select("ticker", "date", "adj_close", "_bad")) == [
        ("A", date(2021, 1, 4), 1.5, ""), ("B", None, 1.5, "date,volume"),
        ("B", date(2021, 1, 4), None, "adj_close")]


def test_stream_loads_each_file_once(spark, store, tmp_path):
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")

    def arrive(*items):
        batch(spark, *items).select(*BAR_COLS).write.mode("append").partitionBy("ticker").json(landing)
        load_arrivals(spark, landing, "json", store, SETTINGS, log).awaitTermination()

    arrive(bar("A", date(2021, 1, 4), 1.0))
    arrive(bar("A", date(2021, 1, 4), 5.0), bar("A", date(2021, 1, 5), 2.0))
    assert stored(store) == [("A", date(2021, 1, 4), 1.0), ("A", date(2021, 1, 5), 2.0)]
    load_arrivals(spark, landing, "json", store, SETTINGS, log).awaitTermination()
    load_arrivals(spark, landing, "json", store, SETTINGS, str(tmp_path / "new")).awaitTermination()
    assert len(stored(store)) == 2


def test_streams_into_one_store_are_runs_of_their_own(spark, store, tmp_path):
    for ticker, day in (("A", 4), ("B", 5)):
        landing = str(tmp_path / ticker)
        batch(spark, bar(ticker, date(2021, 1, day), 1.0)).select(*BAR_COLS).write.partitionBy("ticker").json(landing)
        load_arrivals(spark, landing, "json", store, SETTINGS, f"{landing}_log").awaitTermination()
    assert [r[0] for r in stored(store)] == ["A", "B"]
    runs = [r.run_id for r in store.read("ingestion_log").select("run_id").distinct().collect()]
    assert len(runs) == 2 and not any("None" in r for r in runs)


def test_lines_that_are_no_record_are_reported(spark, store, tmp_path):
    folder = tmp_path / "in" / "ticker=A"
    folder.mkdir(parents=True)
    good = '{"date":"2021-01-04","open":"1","high":"1","low":"1","close":"1","adj_close":"1.5","volume":"3"}'
    (folder / "a.json").write_text(good + "\n" + '{"date":"2021-01-05","adj_close": 1.\n')
    got = L.read_landing(spark, str(tmp_path / "in"), "json", L.BARS)
    assert rows(got.select("ticker", "adj_close", "_bad")) == [
        ("A", None, L.UNREADABLE), ("A", 1.5, "")]
    G.run_load(store, G.PRICES, got.withColumn("ingest_seq", F.lit(1)), SETTINGS, "r1", False)
    assert stored(store) == []
    log = {r.ticker: r for r in store.read("ingestion_log").collect()}
    assert log["A"].status == "failed"
    kept = store.read("rejected").collect()
    assert [(r.entity, r.reason, r.raw) for r in kept] == [
        ("A", L.UNREADABLE, '{"date":"2021-01-05","adj_close": 1.')]


def test_csv_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,adj_close,open,high,low,close,volume,ticker\n"
                                    "2021-01-04,4,1,2,0.5,1.5,10,A\n2021-01-05,1,2\n")
    got = L.read_landing(spark, str(tmp_path), "csv", L.BARS, header="true")
    assert rows(got.select("ticker", "open", "adj_close", "_bad", "_raw")) == [
        (None, 2.0, 1.0, L.UNREADABLE, "2021-01-05,1,2"), ("A", 1.0, 4.0, "", None)]


def test_every_row_is_accounted_for(spark, store):
    d = date(2021, 1, 4)
    items = batch(spark, bar("A", d, 1.0), bar("A", None, 2.0), bar("B", d, 1.0), bar("Z", d, 3.0),
                  bar("B", SETTINGS.as_of, 9.0), bar("B", date(2021, 2, 20), 9.0), bar(None, d, 4.0))
    for incremental in (True, False):
        one = Store(spark, f"{store.root}/{incremental}")
        kept_out = F.col("date") < F.lit(SETTINGS.as_of)
        taken = items if incremental else items.where(F.col("date").isNull() | kept_out)
        G.run_load(one, G.PRICES, taken, SETTINGS, "r1", incremental)
        assert stored(one) == [("B", d, 1.0)]
        log = {r.ticker: (r.rows_loaded, r.status) for r in one.read("ingestion_log").collect()}
        assert log == {"A": (0, "failed"), "B": (1, "success"), "C": (0, "success"), "(unknown)": (0, "failed")}
        reasons = one.read("rejected").select("entity", "reason")
        assert rows(reasons) == [(None, "not configured"), ("A", "no date"), ("Z", "not configured")]


def test_a_repeated_run_logs_once(spark, store):
    items = batch(spark, bar("A", date(2021, 1, 4), 1.0))
    for _ in range(2):
        G.run_load(store, G.PRICES, items, SETTINGS, "same", False)
    assert store.read("ingestion_log").count() == 3


def test_stream_recovers_rows_of_a_failed_entity(spark, store, tmp_path):
    landing, log = tmp_path / "in", str(tmp_path / "log")

    def arrive(name, *lines):
        folder = landing / "ticker=A"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(lines) + "\n")
        load_arrivals(spark, str(landing), "json", store, SETTINGS, log).awaitTermination()

    line = '{"date":"2021-01-0%d","adj_close":"1.5","volume":"3"}'
    arrive("a.json", line % 4, "{broken")
    assert stored(store) == []
    arrive("b.json", line % 5)
    assert stored(store) == [("A", date(2021, 1, 4), 1.5), ("A", date(2021, 1, 5), 1.5)]


def everything(store):
    """The visible rows of every table that a load writes, without the times."""
    return {name: rows(store.read(name).drop("ingested_at", "started_at", "finished_at"))
            for name in ("raw_prices", "ingestion_log", "rejected", "high_water")}


@pytest.mark.parametrize("table", ["high_water", "ingestion_log"])
def test_a_load_that_breaks_off_leaves_nothing_and_can_run_again(spark, tmp_path, monkeypatch, table):
    d = date(2021, 1, 4)
    first, second = (batch(spark, bar("A", d, 1.0), bar("Z", d, 1.0)),
                     batch(spark, bar("A", d, 5.0), bar("B", d, 2.0), bar("B", None, 2.0), bar("C", d, 3.0)))
    smooth, broken = Store(spark, str(tmp_path / "smooth")), Store(spark, str(tmp_path / "broken"))
    for store in (smooth, broken):
        G.run_load(store, G.PRICES, first, SETTINGS, "r1", False)
    G.run_load(smooth, G.PRICES, second, SETTINGS, "r2", False)

    before, files = everything(broken), sorted(p.name for p in (tmp_path / "broken" / table).iterdir())
    add = Commit.add

    def breaks(self, name, *args, **kwargs):
        out = add(self, name, *args, **kwargs)
        if name == table:
            raise OSError("lost")
        return out
    with monkeypatch.context() as patched:
        patched.setattr(Commit, "add", breaks)
        with pytest.raises(OSError):
            G.run_load(broken, G.PRICES, second, SETTINGS, "r2", False)
    assert everything(broken) == before
    assert sorted(p.name for p in (tmp_path / "broken" / table).iterdir()) == files
    G.run_load(broken, G.PRICES, second, SETTINGS, "r2", False)
    assert everything(broken) == everything(smooth)


def test_of_two_writers_the_second_fails(spark, store):
    store.append("raw_prices", batch(spark, bar("A", date(2021, 1, 4), 1.0)))
    slow = store.begin()
    slow.add("raw_prices", batch(spark, bar("B", date(2021, 1, 4), 2.0)))
    store.append("raw_prices", batch(spark, bar("B", date(2021, 1, 4), 3.0)))
    with pytest.raises(CommitConflict):
        slow.publish()
    assert stored(store) == [("A", date(2021, 1, 4), 1.0), ("B", date(2021, 1, 4), 3.0)]
    with pytest.raises(CommitConflict, match="committed already"):
        with store.begin("r1"):
            pass
        store.begin("r1")


@pytest.mark.parametrize("items, message", [
    ([bar("A", date(2021, 1, 5), None)], "NULL in adj_close"),
    ([bar(None, date(2021, 1, 5), 1.0)], "NULL in ticker"),
    ([bar("B", date(2021, 1, 5), 1.0), bar("B", date(2021, 1, 5), 2.0)], "repeated"),
    ([bar("A", date(2021, 1, 4), 9.0), bar("C", date(2021, 1, 4), 9.0)], "stored already")])
def test_the_sink_refuses_broken_constraints(spark, store, items, message):
    store.append("raw_prices", batch(spark, bar("A", date(2021, 1, 4), 1.0)))
    with pytest.raises(ConstraintError, match=message):
        store.append("raw_prices", batch(spark, *items))
    assert stored(store) == [("A", date(2021, 1, 4), 1.0)]
    assert rows(store.high_water("raw_prices")) == [("A", date(2021, 1, 4))]


def test_a_count_beyond_the_log_column_fails(spark, store):
    long = spark.createDataFrame([("r", "s", "A", 2 ** 31, "success", None)],
                                 "run_id string, source string, ticker string, rows_loaded long, status string, "
                                 "error_msg string").withColumns({"started_at": F.current_timestamp(),
                                                                  "finished_at": F.current_timestamp()})
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        store.append("ingestion_log", long)
    assert store.read("ingestion_log").count() == 0


def test_the_watermark_does_not_read_the_table(spark, store):
    G.run_load(store, G.PRICES, batch(spark, bar("A", date(2021, 1, 4), 1.0)), SETTINGS, "r1")
    marks = I.load_watermark(store.high_water("raw_prices"), G.entity_frame(spark, "ticker", ["A"]),
                             "ticker", SETTINGS.as_of, 5)
    files = marks.inputFiles()
    assert files and all("/high_water/" in f for f in files)


def test_marks_of_every_table_are_kept(spark, store):
    G.run_load(store, G.PRICES, batch(spark, bar("A", date(2021, 1, 4), 1.0), bar("B", date(2021, 1, 6), 1.0)),
               SETTINGS, "r1", False)
    G.run_load(store, G.MACRO, macro_batch(spark, ("FEDFUNDS", date(2021, 1, 1), 1.0, 1, "")), SETTINGS, "r1", False)
    G.run_load(store, G.PRICES, batch(spark, bar("A", date(2021, 1, 8), 1.0), bar("B", date(2021, 1, 2), 1.0)),
               SETTINGS, "r2", False)
    assert rows(store.read("high_water")) == [
        ("raw_macro", "FEDFUNDS", date(2021, 1, 1)), ("raw_prices", "A", date(2021, 1, 8)),
        ("raw_prices", "B", date(2021, 1, 6))]


def test_a_rebuild_that_fails_leaves_the_old_table(spark, store, sf_dir):
    from barloom.plans import catalog
    built = catalog._features(spark, sf_dir).where("ticker = '5-LOW'")
    store.replace_features(built)
    was = built.count()
    broken = built.withColumn("ma_5", F.raise_error(F.lit("half-way")).cast("double"))
    with pytest.raises(Exception, match="half-way"):
        store.replace_features(broken)
    assert store.read("features").count() == was
    old = store.read("features")
    store.replace_features(built.limit(7))
    assert store.read("features").count() == 7 and old.count() == was       # a reader under way
    gone = store.sweep(older_than_hours=0)
    assert any(g.startswith("features/") for g in gone) and store.read("features").count() == 7


def test_folders_of_a_table_are_compacted(spark, store):
    for d in (4, 5, 6):
        store.append("raw_prices", batch(spark, bar("A", date(2021, 1, d), float(d))))
    was = rows(store.read("raw_prices"))
    store.compact("raw_prices")
    assert rows(store.read("raw_prices")) == was and len(store.log.latest().tables["raw_prices"]) == 1
    assert rows(store.high_water("raw_prices")) == [("A", date(2021, 1, 6))]


def test_a_damaged_parquet_file_fails_its_entity(spark, store, tmp_path):
    landing = str(tmp_path / "in")
    d = date(2021, 1, 4)
    items = batch(spark, bar("A", d, 1.0), bar("B", d, 2.0), bar("C", d, 3.0)).select(*BAR_COLS)
    items.write.partitionBy("ticker").parquet(landing)
    items.where("false").drop("ticker").write.mode("append").parquet(f"{landing}/ticker=A")    # empty, but sound
    assert L.read_landing(spark, landing, "parquet", L.BARS).where("_bad <> ''").count() == 0
    L.plant_damaged_file(spark, f"{landing}/ticker=B")
    (tmp_path / "in" / "ticker=D+E%3A").mkdir()
    (tmp_path / "in" / "ticker=D+E%3A" / "x.parquet").write_bytes(b"no parquet")
    got = L.read_landing(spark, landing, "parquet", L.BARS)
    assert rows(got.select("ticker", "adj_close", "_bad")) == [
        ("A", 1.0, ""), ("B", None, L.DAMAGED), ("B", 2.0, ""), ("C", 3.0, ""), ("D+E:", None, L.DAMAGED)]
    G.run_load(store, G.PRICES, got.withColumn("ingest_seq", F.lit(1)), SETTINGS, "r1", False)
    assert stored(store) == [("A", d, 1.0), ("C", d, 3.0)]
    log = {r.ticker: r.status for r in store.read("ingestion_log").collect()}
    assert log == {"A": "success", "B": "failed", "C": "success", "(unknown)": "failed"}
    assert "cut.parquet" in store.read("rejected").where("entity = 'B'").first().raw


def test_only_damaged_files(spark, tmp_path):
    folder = tmp_path / "in" / "ticker=A"
    folder.mkdir(parents=True)
    (folder / "x.parquet").write_bytes(b"PAR1")
    got = L.read_landing(spark, str(tmp_path / "in"), "parquet", L.BARS)
    assert rows(got.select("ticker", "date", "_bad")) == [("A", None, L.DAMAGED)]


def test_the_gate_stops_between_load_and_build(spark, store):
    days = [date(2021, 1, d) for d in range(1, 31)]
    macro = macro_batch(spark, *[(s, date(2020, 12, 1), 1.0, 1, "") for s in MACRO_SERIES])
    settings = replace(SETTINGS, tickers=("A", "B"))
    old = batch(spark, *[bar("A", d, 1.0 + d.day) for d in days], bar("B", days[0], 1.0))
    with pytest.raises(Q.QualityError):
        G.daily_run(store, old, macro, settings, "r1")
    assert rows(store.read("quality_report").select("run_id", "ticker")) == [("r1", "B")]
    assert store.read("features").count() == 0 and store.read("raw_prices").count() == 31
    more = batch(spark, *[bar("B", d, 1.0) for d in days[1:]])
    assert G.daily_run(store, more, macro, settings, "r2").count() == 60
    assert rows(store.read("quality_report").select("run_id", "ticker")) == [("r1", "B")]


def test_quality_report_and_error(spark):
    bars = spark.createDataFrame(
        [("A", date(2021, 1, 30), 1.0), ("A", date(2021, 1, 29), None),
         ("B", date(2021, 1, 20), 1.0), ("X", date(2021, 1, 1), None)],
        "ticker string, date date, adj_close double")
    expected = G.entity_frame(spark, "ticker", SETTINGS.tickers)
    report = Q.quality_report(bars, expected, SETTINGS.as_of, 5)
    assert rows(report) == [
        ("A", 1, "Ticker A has 1 row(s) with NULL adj_close"),
        ("B", 1, "Ticker B data is stale: latest date is 2021-01-20 (11 days ago)"),
        ("C", 1, "No rows found for ticker C"),
        ("X", 1, "Ticker X has 1 row(s) with NULL adj_close")]
    with pytest.raises(Q.QualityError, match=r"4 finding\(s\) for 4 ticker\(s\).*reports/x"):
        Q.raise_on_findings(report, "reports/x")
    Q.raise_on_findings(report.where("false"), "reports/x")


def test_exactly_five_days_is_not_stale(spark):
    bars = spark.createDataFrame([("A", date(2021, 1, 26), 1.0)], "ticker string, date date, adj_close double")
    assert Q.stale_keys(bars, G.entity_frame(spark, "ticker", ["A"]), SETTINGS.as_of, 5).count() == 0


def test_features_table_is_replaced(spark, store, sf_dir):
    from barloom.plans import catalog
    built = catalog._features(spark, sf_dir)
    store.replace_features(built)
    store.replace_features(built)
    read = store.read("features")
    assert read.columns == FEATURES.names and read.count() == built.count()


def test_drift_reports_are_kept_by_date(spark, store):
    for day in (1, 2, 2):
        store.write_drift(spark.range(day), date(2021, 1, day))
    assert rows(store.read_drift().groupBy("run_date").count()) == [
        (date(2021, 1, 1), 1), (date(2021, 1, 2), 2)]


def test_setting_list():
    assert parse_list("A,B") == ("A", "B") and parse_list("") == ()
