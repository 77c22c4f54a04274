"""Stored tables: files of several kinds, statistics, versions of several writers, evidence; on small folders."""

import dataclasses
import datetime as dt
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerlake.operators import audit, checks, derive, evidence, load, quality, snapshots, stats
from ledgerlake.registry import DATASETS
from ledgerlake.sources import lake, versions

from .test_behaviour import BARS, D, bars

DAILY = dataclasses.replace(BARS, period="day")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def days(spark, tmp_path):
    """Bars of eight days, two names each, in a folder a day."""
    rows = bars(spark, [(s, D(2024, 1, d), 2.0, d, "vendor_a", 9) for d in range(1, 9) for s in ("600001.SH", "600002.SH")])
    lake.write(rows, DAILY, f"{tmp_path}/days")
    return f"{tmp_path}/days"


def put(rows, path):
    lake.by_period(rows, DAILY).coalesce(1).write.mode("append").partitionBy(lake.PERIOD).parquet(path)


def test_folders_outside_the_window_are_not_opened(spark, days, tmp_path):
    bars(spark, [("600001.SH", D(2024, 1, 4), 1.0, 1, "x", 9)]).coalesce(1).write.mode("append").parquet(days)  # a loose file is never left out
    for f in (tmp_path / "days" / "__period=2024-01-07").glob("*.parquet"):
        f.write_bytes(b"no parquet")  # would fail if its footer were read
    some = lake.open_table(spark, days, DAILY, "2024-01-03", "2024-01-05")
    told = [f.split("/")[-2] for f in some.inputFiles()]
    assert sorted(told) == ["__period=2024-01-03", "__period=2024-01-04", "__period=2024-01-05", "days"]
    assert lake.scan(some, DAILY, "2024-01-03", "2024-01-05").count() == 7
    with pytest.raises(Exception, match="__period=2024-01-07"):
        lake.open_table(spark, days, DAILY).count()
    assert lake.open_table(spark, days, DAILY, lenient=True).count() == 15


def test_two_types_of_a_column_in_one_folder(spark, tmp_path):
    path = f"{tmp_path}/mixed"
    rows = bars(spark, [("600001.SH", D(2024, 1, 2), 2.5, k, "x", 9) for k in range(4)])
    put(rows.where("volume = 0"), path)
    put(rows.where("volume = 1").withColumn("close", F.lit("3.5")), path)
    put(rows.where("volume = 2").withColumn("close", F.lit("none")).withColumn("volume", F.lit("2")), path)
    put(rows.where("volume = 3").drop("amount").withColumn("volume", F.col("volume").cast("int")), path)
    put(rows.where("volume = 3").withColumns({"more": F.lit(1), "volume": F.lit(4).cast("bigint")}), path)
    got = {r.volume: r for r in lake.open_table(spark, path, BARS).collect()}
    assert {k: r.close for k, r in got.items()} == {0: 2.5, 1: 3.5, 2: None, 3: 2.5, 4: 2.5}
    assert got[3].amount is None and got[0].amount == 0 and set(got) == {0, 1, 2, 3, 4}
    types = {r.volume: r._types for r in lake.open_table(spark, path, BARS, origin=True).collect()}
    assert types == {0: "", 1: "close", 2: "close,volume", 3: "", 4: ""}


def test_files_that_break_the_contract(spark, days, tmp_path):
    def broken():
        return sorted((r.file.split("/")[-2][-2:], r.check, r.n) for r in audit.schema_contract(spark, days, DAILY).collect())

    assert broken() == []
    rows = lake.open_table(spark, days, DAILY).drop(lake.PERIOD)
    folder = tmp_path / "days" / "__period=2024-01-03"
    good = next(folder.glob("*.parquet")).read_bytes()
    (folder / "cut.parquet").write_bytes(good[: len(good) // 2])
    put(rows.where("dayofmonth(trade_date) = 4").drop("source"), days)
    put(rows.where("dayofmonth(trade_date) = 5").withColumn("close", F.lit("?")), days)
    rows.where("false").coalesce(1).write.mode("append").parquet(f"{days}/__period=2024-01-06")  # an empty file is sound
    assert broken() == [("03", "unreadable", 0), ("04", "required_missing", 2), ("05", "required_missing", 2), ("05", "types_differ", 2)]
    told = {(r.check, r.severity): (r.n, r.details) for r in audit.table_audit(spark, days, DAILY).collect()}
    assert {k[0]: n for k, (n, _) in told.items()} == {"schema_contract:unreadable": 1, "schema_contract:required_missing": 2, "schema_contract:types_differ": 1, "required_missing": 4, "duplicate_keys": 4}
    assert told["schema_contract:unreadable", "error"][1].endswith("cut.parquet")
    assert [r.check for r in audit.table_audit(spark, f"{days}-none", DAILY).collect()] == ["exists"]


def test_an_audit_sees_lost_rows(spark):
    rows = bars(spark, [(f"{k}.SH", D(2024, 1, d), 2.0, 1, "mock" if k == 0 else "a", 9) for d in (2, 3) for k in range(60 if d == 2 else 20)])
    got = {r.check: (r.severity, r.n, r.details) for r in audit.row_audit(rows, DAILY).collect()}
    assert got == {"mock_rows": ("warning", 2, None), "row_mutation": ("warning", 1, "2024-01-03")}


def test_statistics_of_files(spark, days, tmp_path):
    got = {r.period: r for r in stats.partition_stats(spark, [days]).collect()}
    for d in range(1, 9):
        files = list((tmp_path / "days" / f"__period=2024-01-0{d}").glob("*.parquet"))
        r = got[f"2024-01-0{d}"]
        assert (r.n_rows, r.n_files, r.n_bytes, r.period_start) == (2, len(files), sum(f.stat().st_size for f in files), D(2024, 1, d))
    plan = plan_of(stats.partition_stats(spark, [days]))
    assert "ReadSchema: struct<>" in plan.replace("struct<_none:boolean>", "struct<>") and "symbol" not in plan
    assert stats.partition_stats(spark, []).count() == 0 and stats.partition_stats(spark, [f"{days}-none"]).count() == 0


def test_distinct_sketches_and_a_refresh(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    many = spark.range(60_000).select(F.concat("id", F.lit(".SH")).alias("symbol"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("trade_date"), *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("bigint").alias("volume"), F.lit(1.0).alias("amount"), F.lit("a").alias("source"), F.lit("v1").alias("data_version"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("fetched_at"))
    versions.commit(root, DAILY, many.where("dayofmonth(trade_date) < 6"))
    first = versions.folders(spark, root, DAILY)
    told, sketches = stats.partition_stats(spark, first), stats.distinct_sketches(spark, first)
    versions.commit_merge(root, DAILY, many.where("dayofmonth(trade_date) = 6").unionByName(many.where("dayofmonth(trade_date) = 2").limit(5)))
    told, sketches = stats.refresh_version(spark, root, DAILY, 2, told, sketches)
    assert {r.period: r.n_rows for r in told.collect()} == {f"2024-01-0{d}": 10_000 for d in range(1, 7)}
    assert abs(stats.n_unique_approx(sketches).first().n / 60_000 - 1) < 0.03
    fresh = stats.distinct_sketches(spark, versions.folders(spark, root, DAILY, 2, ["2024-01-06"]))
    assert fresh.count() == 1 and "symbol:string>" in plan_of(fresh)
    changed = [r.period for r in versions.receipt(spark, root, DAILY, 2).collect()]
    assert changed == ["2024-01-06"]  # five rows that were there already change nothing
    assert stats.n_unique_approx(stats.distinct_sketches(spark, [])).first().n == 0


@pytest.mark.parametrize("attempt", range(4))
def test_one_of_several_writers_publishes(spark, tmp_path, attempt):
    """Five writers, four times: each time one version, of one writer's rows, and an error for the others."""
    root, said = f"file://{tmp_path}", []
    rows = [bars(spark, [("600001.SH", D(2024, 1, 2), float(k), 1, "x", 9)]) for k in range(5)]

    def write(k):
        try:
            said.append(versions.commit(root, BARS, rows[k]))
        except versions.Conflict:
            said.append(None)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(5)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(said, key=str) == [1, None, None, None, None] and versions.current(spark, root, BARS) == 1
    assert versions.read(spark, root, BARS).count() == 1 and versions.state(spark, root, BARS).count() == 1


def test_a_lost_writers_number_is_passed_over(spark, tmp_path, monkeypatch):
    root, one = f"file://{tmp_path}", bars(spark, [("600001.SH", D(2024, 1, 2), 1.0, 1, "x", 9)])
    versions.commit(root, BARS, one, tag="first")
    (tmp_path / "daily_bars" / "_versions" / "v000000000002").write_text("")  # taken, and nothing said
    with pytest.raises(versions.Conflict):
        versions.commit(root, BARS, one, 1)  # its writer may still be at work
    monkeypatch.setattr(versions, "LOST_AFTER", -1)
    assert versions.commit(root, BARS, one.withColumn("close", F.lit(5.0)), 1) == 3
    assert versions.read(spark, root, BARS).first().close == 5.0 and versions.receipt(spark, root, BARS, 3).count() == 1
    assert versions.committed(spark, root, BARS, "first") and not versions.committed(spark, root, BARS, "second")
    own = versions.version_rows(spark, root, BARS, 1).first()["id"]
    assert versions.read(spark, root, BARS, own).first().close == 1.0
    for missing in (2, 9, "no such id"):
        with pytest.raises(ValueError):
            versions.read(spark, root, BARS, missing)


def test_a_read_is_one_scan(spark, days):
    rows = spark.read.parquet(days).drop(lake.PERIOD)
    plan = plan_of(load.load(rows, BARS, "2024-01-02", "2024-01-05"))
    assert plan.count("FileScan parquet") == 1 and "raise_error" in plan
    with pytest.raises(PySparkException, match="no exact factor of 600001.SH on 2024-01-0"):
        load.load(rows.where("symbol = '600001.SH'"), BARS, adjust="hfq", factors=spark.createDataFrame([], "symbol string, trade_date date, factor double"), strict_adj=True).collect()


def test_kinds_of_delistings(spark):
    names = ["missing", "later", "mismatch", "nonprinting", "nomaster", "baddate", "fine", "before"]
    ended = spark.createDataFrame([(n, {"later": D(2024, 9, 1), "before": D(2023, 1, 5)}.get(n, D(2024, 3, 8))) for n in names], "symbol string, last_date date")
    last = {"mismatch": 1, "nonprinting": 6, "nomaster": 8, "baddate": 8, "fine": 8, "alone": 8}
    rows = bars(spark, [(n, D(2024, 3, d), 1.0, 1, "x", 9) for n, d in last.items()] + [("fine", D(2024, 5, 1), 1.0, 0, "x", 9)])
    gone = {"nomaster": None, "baddate": D(2024, 3, 1), "nonprinting": D(2024, 3, 9), "alone": D(2024, 4, 1), "unseen": D(2024, 4, 1), "before": D(2024, 2, 1)}
    listed = [n for n in [*names, "alone", "unseen", "lately"] if n != "nomaster"]
    master = spark.createDataFrame([(n, gone.get(n, None if n == "lately" else D(2024, 3, 20))) for n in listed], "symbol string, delist_date date")
    recent = spark.createDataFrame([("lately", D(2024, 3, 3)), ("elsewhen", D(2025, 3, 3))], "symbol string, last_date date")
    pending = spark.createDataFrame([("who",)], "symbol string")
    found = evidence.delisting_coverage(ended, rows, master, "2024-01-01", "2024-06-30", recent, pending)
    assert sorted(map(tuple, found.collect())) == sorted([
        ("missing", "missing_bars"), ("later", "unknown_overlap"), ("mismatch", "terminal_mismatch"), ("nonprinting", "terminal_nonprinting"), ("nomaster", "missing_instrument"),
        ("baddate", "invalid_delist_date"), ("fine", "verified"), ("before", "formal_no_overlap"), ("alone", "verified"), ("unseen", "formal_unresolved"), ("lately", "recent_quarantined"), ("who", "pending_probe"),
    ])
    assert tuple(evidence.delisting_verdict(found).first()) == (False, 8)
    sound = rows.where("symbol = 'fine'")
    with pytest.raises(ValueError, match="1 unresolved"):
        load.load(sound, BARS, "2024-01-01", "2024-06-30", master=master.where("symbol = 'fine'"), delistings={"catalog": ended.where("symbol IN ('fine', 'later')")})
    kept = load.load(sound, BARS, "2024-01-01", "2024-06-30", master=master.where("symbol = 'fine'"), delistings={"catalog": ended.where("symbol = 'fine'")})
    assert kept.count() == 2
    ready = evidence.historical_validity(rows, spark.createDataFrame([], "trade_date date, is_trading boolean"), spark.createDataFrame([], "trade_date date, risk_warning boolean"), "2024-03-01", "2024-04-30", delistings=found)
    assert {r.blocker: r.n for r in ready.collect()} == {"no_label_evidence": 1, "delistings_unverified": 8}


def test_chains_of_receipts(spark):
    day = lambda d: D(2024, 1, d)
    status = spark.createDataFrame([("s", n, day(d)) for n, a in (("a", 1), ("b", 1), ("c", 12)) for d in range(a, 29)], "source string, symbol string, trade_date date")
    first = spark.createDataFrame([("a", day(1)), ("b", day(1)), ("c", day(12))], "symbol string, first_date date")
    links = [("r1", 1, 10, ["a", "b"], 20), ("r2", 8, 18, ["a", "b"], 22), ("r3", 12, 28, ["a", "b", "c"], 51)]
    schema = "receipt string, source string, start date, end date, symbols array<string>, n_rows long"

    def chain(rows):
        made = spark.createDataFrame([(r, "s", day(a), day(z), n, k) for r, a, z, n, k in rows], schema)
        return [(r.start.day, r.end.day, r.n_links, r.n_added) for r in evidence.compose_receipts(made, status, first).collect()]

    assert chain(links) == [(1, 28, 3, 1)]
    assert chain([(*links[0][:4], 19), *links[1:]]) == [(8, 28, 2, 1)]  # the first one's total has changed
    assert chain([links[0], (*links[1][:4], 23), links[2]]) == []  # without the second there is a hole
    assert chain([links[0], links[1], ("r3", 13, 28, ["a", "b", "c"], 48)]) == [(1, 18, 2, 0)]  # c traded before it
    assert chain([links[0], ("r2", 8, 18, ["a"], 11)]) == []  # b is lost on the way
    assert chain([*links, ("in", 2, 9, ["a", "b"], 16)]) == [(1, 28, 3, 1)]


def test_heatmap_meets_by_equality(spark):
    iv = spark.createDataFrame([("x", D(2024, 1, 1), D(2024, 1, 3)), ("x", D(2024, 1, 2), D(2024, 1, 2)), ("x", D(2024, 1, 4), D(2024, 1, 5)), ("x", D(2024, 1, 9), D(2024, 1, 9)), ("y", D(2024, 1, 7), D(2024, 1, 6))], "dataset string, start date, end date")
    islands = stats.coalesced(iv, ["dataset"])
    assert sorted((r.dataset, r.start.day, r.end.day) for r in islands.collect()) == [("x", 1, 5), ("x", 9, 9)]
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 5, 6, 9, 10)], "trade_date date")
    told = stats.coverage_heatmap(iv, days)
    assert {r.trade_date.day: r.state for r in told.collect()} == {1: "covered", 5: "covered", 6: "gap", 9: "covered", 10: "outside"}
    assert "NestedLoop" not in plan_of(told) and "Cartesian" not in plan_of(told)


def test_folders_of_two_grains(spark, tmp_path):
    path = f"{tmp_path}/grains"
    rows = bars(spark, [("600001.SH", D(2024, m, d), 1.0, d, "x", 9) for m in (1, 2) for d in (2, 3)])
    lake.write(rows, BARS, path)
    assert lake.mixed_granularity(spark, path, BARS).count() == 0
    lake.write(rows.where("volume = 2 AND month(trade_date) = 1"), DAILY, path)
    lake.write(bars(spark, [("600001.SH", D(2024, 1, 9), 1.0, 1, "x", 9)]), DAILY, path)
    lake.write(bars(spark, [("600001.SH", D(2030, 1, 9), 1.0, 1, "x", 9)]), DAILY, path)
    got = {r.period: (r.overlaps, r.n_repeated) for r in lake.mixed_granularity(spark, path, BARS).collect()}
    assert got == {"2024-01-02": (True, 1), "2024-01-09": (True, 0), "2030-01-09": (False, 0)}


def test_a_bad_factor_fails_the_query(spark):
    good = spark.createDataFrame([("a", D(2024, 1, 2), 2.0)], "symbol string, trade_date date, factor double")
    assert snapshots.invert_factors(good).first().factor == 0.5
    for bad in (0.0, -1.0, float("nan"), float("inf"), None):
        with pytest.raises(PySparkException, match="no factor of a on 2024-01-02"):
            snapshots.invert_factors(good.withColumn("factor", F.lit(bad).cast("double"))).collect()


def test_only_touched_days_are_derived_anew(spark):
    calendar = spark.createDataFrame([(D(2024, 1, d), d not in (6, 7)) for d in range(1, 12)], "trade_date date, is_trading boolean")
    changed = spark.createDataFrame([(D(2024, 1, 3),), (D(2024, 1, 5),), (D(2024, 1, 11),)], "trade_date date")
    assert sorted(r.trade_date.day for r in derive.touched_days(changed, calendar).collect()) == [3, 4, 5, 8, 11]


def test_a_large_period_is_dealt_to_several_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        lake.write(bars(spark, [(f"{k}.SH", D(2024, 1 + (k % 400 == 0), 2), float(k), k, "x", 9) for k in range(20_000)]), BARS, f"{tmp_path}/t")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {p: len(list((tmp_path / "t" / f"__period={p}").glob("*.parquet"))) for p in ("2024-01", "2024-02")}
    assert files["2024-01"] > 1 and files["2024-02"] == 1


def test_known_gaps_and_findings(spark):
    rows = bars(spark, [("a", D(2024, 1, d), 1.0, 1, "x", 9) for d in (1, 5)])
    calendar = spark.createDataFrame([(D(2024, 1, d), True) for d in range(1, 6)], "trade_date date, is_trading boolean")
    known = spark.createDataFrame([("a", D(2024, 1, 2))], "symbol string, trade_date date")
    assert tuple(quality.coverage_by_series(rows, calendar, known).first()) == ("a", 2, 1, D(2024, 1, 3))
    assert tuple(quality.coverage_by_series(rows, calendar).first()) == ("a", 3, 0, D(2024, 1, 2))
    marks = spark.createDataFrame([("x", D(2024, 1, 1), 3, 5, False), ("y", None, 3, 0, False), ("z", D(2023, 1, 1), 3, 5, True)], "dataset string, watermark date, tolerance_days int, n_rows long, retired boolean")
    none = quality.finding(rows.where("false"), "d", "error", "c")
    told = quality.lake_health(none, marks, "2024-01-09").first()
    assert (told.healthy, told.stale, told.empty) == (True, ["x"], ["y"])


def test_checks_run_where_their_datasets_are(spark):
    rows = bars(spark, [("600001.SH", D(2024, 1, d), 1.0, 1, "x", 9) for d in (2, 4)])
    calendar = spark.createDataFrame([(D(2024, 1, d), d != 4) for d in (2, 3, 4)], "trade_date date, is_trading boolean")
    got = {(r.dataset, r.severity, r.check): (r.n, r.details) for r in checks.findings({"daily_bars": rows, "trading_calendar": calendar}, "2024-01-03").collect()}
    assert got == {("daily_bars", "warning", "not_a_session"): (1, "2024-01-04"), ("daily_bars", "error", "session_without_bar"): (1, "2024-01-03"), ("trading_calendar", "error", "calendar_ends"): (1, None)}
    with pytest.raises(ValueError):
        checks.findings({"nothing": rows}, "2024-01-03")


def test_exact_symbols_of_stored_periods(spark, days):
    told = stats.with_symbols(spark, stats.partition_stats(spark, [days]), [days])
    assert {(r.n_rows, r.n_symbols) for r in told.collect()} == {(2, lake.open_table(spark, days, DAILY).where("dayofmonth(trade_date) = 1").select("symbol").distinct().count())}
    put(lake.open_table(spark, days, DAILY).drop(lake.PERIOD).where("dayofmonth(trade_date) = 1"), days)  # the same symbols again
    r = stats.with_symbols(spark, stats.partition_stats(spark, [days]), [days]).where("period = '2024-01-01'").first()
    assert (r.n_rows, r.n_symbols) == (4, 2)
    assert "symbol:string>" in plan_of(told)
    assert stats.with_symbols(spark, stats.partition_stats(spark, []), []).count() == 0
