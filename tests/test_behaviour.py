"""Traps of the semantics, on small rows; versions, merges and streams."""

import dataclasses
import datetime as dt
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlake.functions import periods
from ledgerlake.functions import symbols as S
from ledgerlake.operators import asof, canonical, derive, load, quality, reconcile, research
from ledgerlake.registry import DATASETS
from ledgerlake.sources import lake, versions
from ledgerlake.streaming import incremental

BARS = DATASETS["daily_bars"]
D = dt.date


def bars(spark, rows):
    """rows: symbol, date, close, volume, source, fetched hour or None."""
    made = [(s, d, c, c, c, c, v, c * (v or 0), src, "v1", None if h is None else dt.datetime(d.year, d.month, d.day, h)) for s, d, c, v, src, h in rows]
    return spark.createDataFrame(made, "symbol string, trade_date date, open double, high double, low double, close double, volume bigint, amount double, source string, data_version string, fetched_at timestamp")


def test_newer_placeholder_replaces_before_the_volume_filter(spark):
    rows = bars(spark, [("600000.SH", D(2024, 1, 2), 10.0, 5, "vendor_a", 9), ("600000.SH", D(2024, 1, 2), 10.0, 0, "vendor_b", 20)])
    assert canonical.traded(canonical.dedupe(rows, BARS)).count() == 0


def test_null_fetch_loses_and_rank_breaks_ties(spark):
    rows = bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "vendor_b", 9), ("a", D(2024, 1, 2), 2.0, 1, "vendor_a", 9), ("a", D(2024, 1, 2), 3.0, 1, "vendor_a", None)])
    assert [r.close for r in canonical.dedupe(rows, BARS).collect()] == [2.0]


def test_full_ties_are_settled_by_all_columns(spark):
    rows = bars(spark, [("a", D(2024, 1, 2), c, 1, "x", 9) for c in (1.0, 3.0, 2.0)])
    assert {canonical.dedupe(rows.repartition(k), BARS).first().close for k in (1, 2, 3)} == {3.0}


def test_qfq_anchor_is_the_latest_factor_up_to_the_last_bar(spark):
    rows = bars(spark, [("a", D(2024, 1, d), 10.0, 1, "x", 9) for d in (2, 3, 5)])
    f = spark.createDataFrame([("a", D(2024, 1, 2), 1.0), ("a", D(2024, 1, 3), 2.0), ("a", D(2024, 1, 4), 4.0), ("a", D(2024, 1, 9), 8.0)], "symbol string, trade_date date, factor double")
    got = {r.trade_date.day: (r.adj_close, r.adj_is_exact) for r in research.adjust_qfq(rows, f).collect()}
    assert got == {2: (2.5, True), 3: (5.0, True), 5: (10.0, False)}


def test_event_on_the_bars_date_counts_and_one_before_the_first(spark):
    rows = bars(spark, [("a", D(2024, 1, d), 10.0, 1, "x", 9) for d in (1, 2, 3)])
    ev = spark.createDataFrame([("a", D(2024, 1, 2), 1.5)], "symbol string, trade_date date, factor double")
    assert {r.trade_date.day: r.factor for r in derive.align_factors(rows, ev).collect()} == {1: 1.0, 2: 1.5, 3: 1.5}


def test_asof_keeps_left_rows_without_a_match(spark):
    left = spark.createDataFrame([("a", 1), ("b", 5)], "k string, t int")
    right = spark.createDataFrame([("b", 5, 7.0), ("b", 6, 8.0)], "k string, t int, v double")
    assert {r.k: r.v for r in asof.backward(left, right, ["k"], "t", "v").collect()} == {"a": None, "b": 7.0}


def test_a_return_needs_adjacent_sessions(spark):
    rows = research.adjust_hfq(bars(spark, [("a", D(2024, 1, d), 10.0 + d, 1, "x", 9) for d in (2, 3, 5)]), spark.createDataFrame([("a", D(2024, 1, d), 1.0) for d in (2, 3, 5)], "symbol string, trade_date date, factor double"))
    cal = spark.createDataFrame([(D(2024, 1, d), True) for d in (2, 3, 4, 5)], "trade_date date, is_trading boolean")
    assert [r.trade_date.day for r in derive.hfq_returns(rows, cal).collect()] == [3]


def test_watermark_stops_before_the_first_hole(spark):
    cal = spark.createDataFrame([(D(2024, 1, d), True) for d in range(1, 6)], "trade_date date, is_trading boolean")
    have = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 4, 5)], "trade_date date")
    assert quality.contiguous_watermark(have, cal).first().watermark == D(2024, 1, 2)


def test_missing_status_keeps_the_bar_and_delisting_day_is_tradable(spark):
    rows = bars(spark, [("600000.SH", D(2024, 1, d), 1.0, 1, "x", 9) for d in (2, 3, 4)])
    master = spark.createDataFrame([("600000.SH", None, D(2024, 1, 3))], "symbol string, list_date date, delist_date date")
    status = spark.createDataFrame([("600000.SH", D(2024, 1, 2), True, "normal", None)], "symbol string, trade_date date, is_trading boolean, status string, risk_warning boolean")
    assert sorted(r.trade_date.day for r in research.universe(rows, master, status).collect()) == [2, 3]
    assert research.missing_status(rows, status).count() == 2


def test_restatement_and_pit(spark):
    rows = [("a", "2023Q4", "income", "eps", 1.0, D(2024, 4, 20), "live", dt.datetime(2024, 4, 20)), ("a", "2023Q4", "income", "eps", 2.0, D(2025, 3, 15), "live", dt.datetime(2025, 3, 15)), ("b", "2023Q4", "income", "eps", 3.0, D(2024, 4, 1), "reconstructed", dt.datetime(2024, 4, 1))]
    facts = spark.createDataFrame(rows, "symbol string, report_period string, statement_type string, item_code string, item_value double, announce_date date, source string, fetched_at timestamp")
    d = DATASETS["financial_statement_items"]
    read = lambda as_of, **kw: {r.symbol: r.item_value for r in load.load(facts, d, as_of=as_of, **kw).collect()}
    assert read("2024-12-31") == {"a": 1.0, "b": 3.0} and read("2025-12-31") == {"a": 2.0, "b": 3.0}
    assert read("2025-12-31", pit_mode="strict") == {"a": 2.0} and read("2024-01-01") == {}
    with pytest.raises(ValueError):
        load.load(facts, d)
    with pytest.raises(ValueError):
        load.load(facts, BARS, as_of="2024-01-01")


def test_validate_makes_bad_scalars_null_and_wants_its_columns(spark):
    rows = bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "x", 9)]).withColumn("volume", F.lit("many"))
    assert canonical.validate(rows, BARS).first().volume is None
    with pytest.raises(ValueError):
        canonical.validate(rows.drop("close"), BARS, allow_missing=True)
    assert lake.empty(spark, BARS).columns == list(BARS.schema)


def test_period_labels(spark):
    one = spark.createDataFrame([("2024",), ("2024Q2",), ("2024-02",), ("2024-02-29",), ("x",)], "p string").select("p", periods.start(F.col("p")).alias("a"), periods.end(F.col("p")).alias("z"))
    got = {r.p: (r.a, r.z) for r in one.collect()}
    assert got["2024"] == (D(2024, 1, 1), D(2024, 12, 31)) and got["2024Q2"] == (D(2024, 4, 1), D(2024, 6, 30)) and got["2024-02"] == (D(2024, 2, 1), D(2024, 2, 29))
    assert got["2024-02-29"] == (D(2024, 2, 29),) * 2 and got["x"] == (None, None)


def test_placeholder_names(spark):
    names = {"good": False, "  ": False, "": False, None: False, "认购款": True, "认购款\0\0": True, "某某申购款 ": True, " 申购款\0 ": True, "认购款A": False, "abc退": False}
    rows = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r.n: r.b for r in rows.select("n", S.placeholder_name(F.col("n")).alias("b")).collect()} == names


def test_receipts_and_funds_have_six_digits_and_an_exchange(spark):
    cases = [("689009", "SH", True, False), ("689009", "SZ", False, False), ("6891", "SH", False, False), ("689009", None, False, False), ("510300", "SH", False, True), ("51030", "SH", False, False), ("159915", "SZ", False, True), ("159915", "SH", False, False), (None, "SH", False, False), ("68900x", "SH", False, False), ("510300", "sh", False, True)]
    rows = spark.createDataFrame([(c, e) for c, e, _, _ in cases], "c string, e string")
    got = rows.select("c", "e", S.is_cdr(F.col("c"), F.col("e")).alias("cdr"), S.is_etf(F.col("c"), F.col("e")).alias("etf")).collect()
    assert [tuple(r) for r in got] == cases
    symbols = {"600000.SH": True, "60000.SH": False, "689009.SH": False, "810000.SZ": False, "920001.BJ": True, "000001.SH": False}
    rows = spark.createDataFrame([(x,) for x in symbols], "s string")
    assert {r.s: r.b for r in rows.select("s", S.in_class(F.col("s")).alias("b")).collect()} == symbols


STATUS = DATASETS["trading_status"]


def statuses(spark, rows):
    """rows: source, is_trading, fetched (UTC); all of one symbol and day."""
    made = [("600519.SH", D(2024, 6, 28), ok, "normal" if ok else "suspended", None, src, "v1", at) for src, ok, at in rows]
    return spark.createDataFrame(made, "symbol string, trade_date date, is_trading boolean, status string, risk_warning boolean, source string, data_version string, fetched_at timestamp")


@pytest.mark.parametrize(
    ("rows", "stays"),
    [
        ([("snapshot", True, dt.datetime(2024, 7, 1, 8)), ("gap", False, dt.datetime(2024, 6, 28, 7))], "gap"),  # of a later day
        ([("snapshot", True, dt.datetime(2024, 6, 28, 6, 59)), ("gap", False, dt.datetime(2024, 6, 28, 5))], "gap"),  # before the close
        ([("snapshot", True, dt.datetime(2024, 6, 28, 7, 30)), ("gap", False, dt.datetime(2024, 6, 28, 9))], "snapshot"),  # after it
        ([("history", True, dt.datetime(2024, 6, 28, 7)), ("gap", False, dt.datetime(2024, 7, 2, 7))], "history"),
        ([("snapshot", True, None), ("gap", False, None)], "gap"),
        ([("unknown", True, dt.datetime(2020, 1, 1)), ("gap", False, dt.datetime(2024, 7, 2))], "unknown"),
    ],
)
def test_evidence_ranks_before_freshness_on_every_way_in(spark, tmp_path, rows, stays):
    made = statuses(spark, rows)
    assert [r.source for r in canonical.dedupe(made, STATUS).collect()] == [stays]
    assert [r.source for r in lake.merge(made.limit(1), made.exceptAll(made.limit(1)), STATUS).collect()] == [stays]
    if all(at for _, _, at in rows):
        assert [r.source for r in load.load(made, STATUS).collect()] == [stays]
    load.views(spark, {"trading_status": made}, DATASETS)
    assert [r.source for r in spark.table("trading_status").collect()] == [stays]
    root = f"file://{tmp_path}"
    for r in made.collect():
        versions.commit_merge(root, STATUS, spark.createDataFrame([r], made.schema))
    assert [r.source for r in versions.read(spark, root, STATUS).collect()] == [stays]


def test_unknown_trading_is_not_trading(spark):
    rows = spark.createDataFrame([(None, "normal", True), (True, "normal", False), (True, "suspended", True), (False, None, True)], "is_trading boolean, status string, want boolean")
    assert all(r.got == r.want for r in rows.select("want", canonical.not_trading().alias("got")).collect())


def series(spark, closes, gap_after=None, gap=0):
    days, d = [], D(2024, 1, 1)
    for k in range(len(closes)):
        days.append(d)
        d += dt.timedelta(days=gap if k == gap_after else 1)
    return spark.createDataFrame([("s", d, float(c)) for d, c in zip(days, closes, strict=True)], "symbol string, trade_date date, close double")


@pytest.mark.parametrize(
    ("closes", "gap", "want"),
    [
        ([5.0] * 29, 1, "insufficient"),
        ([5.0] * 40 + [2.0] * 20, 30, "consolidation"),  # a halt, then a fall on resumption
        ([5.0] * 40 + [4.9] * 20, 30, "abrupt_stable"),  # a halt alone
        ([5.0 * 0.97**k for k in range(60)], 1, "abrupt_decline"),  # a steady slide to below 2
        ([50.0 * 0.97**k for k in range(60)], 1, "abrupt_stable"),  # a slide that ends at an ordinary price
        ([5.0] * 60, 1, "abrupt_stable"),
    ],
)
def test_endings(spark, closes, gap, want):
    assert derive.ending_pattern(series(spark, closes, 39, gap)).first().pattern == want


def test_digests_tell_separators_and_nulls_apart(spark):
    pairs = [(("x|y", "z"), ("x", "y|z")), ((None, "a"), ("~", "a")), (("1:x", None), ("1:x", "-")), (("", "a"), (None, "a")), (("a", ""), ("", "a"))]
    for one, two in pairs:
        frames = [spark.createDataFrame([t], "a string, b string") for t in (one, two)]
        assert len({canonical.digest(f, []).first()["hash"] for f in frames}) == 2
        assert len({f.select(research.revision_id(f, ["a", "b"])).first()[0] for f in frames}) == 2


def test_an_update_between_null_and_tilde_is_not_lost(spark, tmp_path):
    d, root = DATASETS["announcement_index"], f"file://{tmp_path}"
    for hour, title in ((9, None), (10, "~")):
        row = {"announcement_id": "1", "symbol": "s", "title": title, "announce_date": D(2024, 1, 2), "category": "a|b", "url": "u", "source": "x", "data_version": "v1", "fetched_at": dt.datetime(2024, 1, 2, hour)}
        versions.commit_merge(root, d, spark.createDataFrame([tuple(row[c] for c in d.schema)], ", ".join(f"{c} {t}" for c, t in d.schema.items())))
    assert versions.read(spark, root, d).first().title == "~"


def test_second_identical_merge_changes_nothing(spark):
    old = bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "vendor_a", 9), ("a", D(2024, 2, 2), 1.0, 1, "vendor_a", 9)])
    new = bars(spark, [("a", D(2024, 1, 2), 2.0, 1, "vendor_a", 10), ("a", D(2024, 3, 1), 5.0, 1, "vendor_a", 9)])
    merged = lake.merge(old, new, BARS)
    assert {(r.period, r.kind) for r in lake.changed_periods(old, merged, BARS).collect()} == {("2024-01", "replace"), ("2024-03", "add")}
    assert lake.changed_periods(merged, lake.merge(merged, new, BARS), BARS).count() == 0


def test_merge_into_its_own_table_reads_only_touched_folders(spark, tmp_path):
    path = f"{tmp_path}/table"
    lake.write(bars(spark, [("a", D(2024, m, 2), 1.0, 1, "vendor_a", 9) for m in range(1, 7)]), BARS, path)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    batch = bars(spark, [("a", D(2024, 2, 2), 2.0, 1, "vendor_a", 10), ("b", D(2024, 8, 1), 5.0, 1, "vendor_a", 9), ("a", D(2024, 3, 2), 9.0, 1, "vendor_a", 8)])
    told = lake.compact_merge(spark, BARS, path, batch, f"{tmp_path}/one")
    assert sorted(map(tuple, told.collect())) == [("2024-02", "replace", 1), ("2024-08", "add", 1)]  # the older row of March changes nothing
    assert lake.compact_merge(spark, BARS, path, batch, f"{tmp_path}/two").count() == 0
    assert {(r.symbol, r.trade_date.month): r.close for r in spark.read.parquet(path).collect()} == {**{("a", m): 1.0 for m in (1, 3, 4, 5, 6)}, ("a", 2): 2.0, ("b", 8): 5.0}
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "table").rglob("*.parquet")}
    assert sum(f in after and after[f] == t for f, t in before.items()) == 5
    plan = lake.stored_periods(spark, path, ["2024-02"])._jdf.queryExecution().executedPlan().toString()
    assert "__period" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_versions(spark, tmp_path):
    root = f"file://{tmp_path}"
    one = bars(spark, [("a", D(2024, m, 2), 1.0, 1, "x", 9) for m in (1, 2, 3)])
    assert versions.current(spark, root, BARS) == 0 and versions.read(spark, root, BARS).count() == 0
    versions.commit(root, BARS, one)
    versions.commit(root, BARS, one.withColumn("close", F.when(F.month("trade_date") == 2, 7.0).otherwise(F.col("close"))), 1)
    assert sorted(r.close for r in versions.read(spark, root, BARS).collect()) == [1.0, 1.0, 7.0]
    assert {r.close for r in versions.read(spark, root, BARS, 1).collect()} == {1.0}
    assert versions.read(spark, root, BARS, periods=["2024-02"]).first().close == 7.0
    now = versions.state(spark, root, BARS).first()
    assert (now.version, now.parent, now.n_periods, now.n_rows) == (2, 1, 3, 3)
    folders = {r.period: r.folder for r in versions.manifest(spark, root, BARS).where("version = 2").collect()}
    first = {r.period: r.folder for r in versions.manifest(spark, root, BARS).where("version = 1").collect()}
    assert [p for p in folders if folders[p] != first[p]] == ["2024-02"]  # the others are shared
    with pytest.raises(versions.Conflict):
        versions.commit(root, BARS, one, 1)
    versions.commit(root, BARS, one.limit(0), 2)
    assert versions.read(spark, root, BARS).count() == 0 and versions.current(spark, root, BARS) == 3


def test_a_replayed_batch_is_published_once(spark, tmp_path):
    """A crash after the commit and before the stream's own checkpoint: the first batch comes again."""
    root, rows = f"file://{tmp_path}/lake", bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "vendor_a", 9)])
    rows.write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        incremental.merge_stream(spark, stream, BARS, root, f"{tmp_path}/state").awaitTermination(60)
        shutil.rmtree(tmp_path / "state")
    assert versions.current(spark, root, BARS) == 1


def test_a_read_keeps_its_contract(spark):
    good = bars(spark, [("600001.SH", D(2024, 1, d), 2.0, 1, "vendor_a", 9) for d in (3, 2)])
    broken = {
        "required_missing": good.withColumn("fetched_at", F.lit(None).cast("timestamp")),
        "not_finite": good.withColumn("amount", F.lit(float("nan"))),
        "high_below_close": good.withColumn("high", F.lit(1.0)),
        "price_not_positive": good.withColumn("open", F.lit(0.0)),
        "volume_negative": good.withColumn("volume", F.lit(-1)),
    }
    for rule, rows in broken.items():
        with pytest.raises(PySparkException, match=rf"daily_bars: .*{rule}.* at 600001.SH 2024-01-0"):
            load.load(rows, BARS).collect()  # as it is delivered
        told = Observation()
        assert load.load(rows, BARS, observation=told).count() == 2
        with pytest.raises(canonical.ContractError) as observed:
            canonical.confirm(told, BARS)
        with pytest.raises(canonical.ContractError) as counted:
            canonical.check(rows, BARS)
        assert str(observed.value) == str(counted.value) and f"{rule} 2" in str(counted.value)
    assert [r.trade_date.day for r in load.load(good, BARS).collect()] == [2, 3]
    status = spark.createDataFrame([("600001.SH", D(2024, 1, 2), True, "normal", None)], "symbol string, trade_date date, is_trading boolean, status string, risk_warning boolean")
    master = spark.createDataFrame([("600001.SH", None, None)], "symbol string, list_date date, delist_date date")
    outside = good.unionByName(bars(spark, [("810000.SZ", D(2024, 1, 2), -1.0, 1, "vendor_a", 9)]))
    assert load.load(outside, BARS, master=master, status=status).count() == 2  # gone before validation
    with pytest.raises(ValueError, match="universe"):
        load.load(good, BARS, master=master, status=status, strict_universe=True)
    with pytest.raises(ValueError, match="no prices"):
        load.load(good, DATASETS["index_bars"], adjust="hfq", factors=good)
    for name in ("daily_bars", "financial_statement_items", "trade_ticks"):
        with pytest.raises(ValueError, match="read of its own"):
            load.query_dataset(good, DATASETS[name])


def test_ticks_take_their_days_factor_and_keep_their_sequence(spark):
    d = DATASETS["trade_ticks"]
    made = [("600001.SH", D(2024, 1, 2), k, dt.datetime(2024, 1, 2, 9, 30), 10.0, 1, "buy", "x", "v1", dt.datetime(2024, 1, 2, 16)) for k in (2, 0, 1)]
    rows = spark.createDataFrame(made, ", ".join(f"{c} {t}" for c, t in d.schema.items()))
    f = spark.createDataFrame([("600001.SH", D(2024, 1, 2), 1.5)], "symbol string, trade_date date, factor double")
    assert [(r.tick_seq, r.adj_price) for r in load.load(rows, d, adjust="hfq", factors=f).collect()] == [(0, 15.0), (1, 15.0), (2, 15.0)]


def test_facts_are_windowed_by_report_period(spark):
    d = DATASETS["financial_statement_items"]
    rows = [("a", p, "income", "eps", at, 1.0, "live", "v1", dt.datetime(2024, 4, 20)) for p, at in (("2023Q3", D(2023, 10, 30)), ("2023Q4", D(2024, 4, 20)), ("2022Q4", D(2023, 4, 20)))]
    facts = spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in d.schema.items()))
    got = [r.report_period for r in load.load(facts, d, "2023-08-01", "2023-12-31", as_of="2024-12-31").collect()]
    assert got == ["2023Q3", "2023Q4"]  # the second was announced after the window


def test_a_delta_knows_its_base(spark):
    a = bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "x", 9), ("a", D(2024, 2, 2), 1.0, 1, "x", 9)])
    b = bars(spark, [("a", D(2024, 2, 2), 2.0, 1, "x", 9), ("a", D(2024, 3, 2), 1.0, 1, "x", 9)])
    changes = lake.delta(a, b, BARS, bound=True)
    assert {(r.period, r.kind) for r in changes.collect()} == {("2024-01", "delete"), ("2024-02", "replace"), ("2024-03", "add")}
    assert sorted((r.trade_date.month, r.close) for r in lake.delta_apply(a, b, changes, BARS).collect()) == [(2, 2.0), (3, 1.0)]
    with pytest.raises(ValueError, match="another base"):
        lake.delta_apply(b, a, changes, BARS)


def test_tables_of_folders_and_loose_files(spark, tmp_path):
    path, day = f"{tmp_path}/table", DATASETS["trade_ticks"]
    assert lake.open_table(spark, path, BARS).count() == 0 and lake.folders(spark, path).count() == 0
    rows = bars(spark, [("a", D(2024, 1, d), 1.0, d, "x", 9) for d in range(1, 9)])
    lake.write(rows.where("volume < 5"), day, path)
    rows.where("volume >= 5").drop("amount").write.mode("append").parquet(path)
    (tmp_path / "table" / "__period=odd").mkdir()
    assert [r.period for r in lake.folders(spark, path).collect()] == [f"2024-01-0{k}" for k in range(1, 5)]
    read = lake.open_table(spark, path, BARS)
    assert read.count() == 8 and read.where("amount IS NULL").count() == 4 and read.columns == [*BARS.schema, lake.PERIOD]
    daily = dataclasses.replace(BARS, period="day")
    some = lake.scan(read, daily, "2024-01-03", "2024-01-06")
    assert sorted(r.trade_date.day for r in some.collect()) == [3, 4, 5, 6]


def test_a_stock_that_fell_silent(spark):
    master = spark.createDataFrame([("a", "stock", None), ("b", "stock", None), ("c", "stock", D(2023, 1, 1)), ("f", "fund", None)], "symbol string, asset_type string, delist_date date")
    rows = [("a", D(2021, 1, 4), 1.0, 1, "x", 9), ("a", D(2024, 1, 4), 1.0, 1, "x", 9), ("b", D(2023, 5, 4), 1.0, 1, "x", 9), ("c", D(2022, 5, 4), 1.0, 1, "x", 9), ("f", D(2021, 5, 4), 1.0, 1, "x", 9)]
    got = lambda kept, **how: [(r.symbol, r.severity) for r in quality.survivorship_check(bars(spark, kept), master, **how).collect()]
    assert got(rows) == [("b", "warning")]
    assert got(rows[:2] + rows[4:]) == [(None, "error")]  # three years of survivors only
    assert got(rows[:2] + rows[4:], least_span=2000) == []


def test_gaps(spark):
    cal = spark.createDataFrame([(D(2024, 1, k), k not in (6, 7)) for k in range(1, 13)], "trade_date date, is_trading boolean")
    have = spark.createDataFrame([("d", D(2024, 1, k)) for k in (2, 3, 8, 10, 11)], "dataset string, trade_date date")
    want = spark.createDataFrame([("d",), ("none",)], "dataset string")
    got = sorted((r.dataset, r.kind, r.start.day, r.end.day) for r in reconcile.verify_gaps(have, cal, "2024-01-12", 0, "2024-01-01", want).collect())
    assert got == [("d", "interior", 4, 5), ("d", "interior", 9, 9), ("d", "shallow", 1, 1), ("d", "stale", 12, 12), ("none", "empty", 1, 12)]


def test_a_calendar_does_not_guess_the_future(spark):
    rows = bars(spark, [("a", D(2024, 1, d), 1.0, 1, "x", 9) for d in (2, 3, 4)])
    seed = spark.createDataFrame([(D(2024, 1, 8), True)], "trade_date date, is_trading boolean")
    none = spark.createDataFrame([], "trade_date date")
    made = lambda end: {r.trade_date.day: r.is_trading for r in derive.trading_calendar("2024-01-01", end, spark, seed, none, rows).collect()}
    assert made("2024-01-04") == {1: True, 2: True, 3: True, 4: True}
    with pytest.raises(Exception, match="2024-01-05"):
        made("2024-01-08")
    known = spark.createDataFrame([(D(2024, 1, 5),)], "trade_date date")
    assert {r.trade_date.day for r in derive.trading_calendar("2024-01-01", "2024-01-08", spark, seed, known, rows).where("is_trading").collect()} == {1, 2, 3, 4, 8}


def test_pages_tell_how_much_there_is(spark):
    rows = bars(spark, [("a", D(2024, 1, d), 1.0, 1, "xyz"[d % 2], 9) for d in range(1, 11)])
    told = lambda limit, offset: tuple(research.page_info(rows, limit, offset).first())
    assert told(4, 0) == (10, 4, True, ["x", "y"]) and told(4, 6) == (10, 4, False, ["x", "y"]) and told(4, 20) == (10, 0, False, ["x", "y"]) and told(4, 8) == (10, 2, False, ["x", "y"])
    assert [(r.trade_date.day, r.total, r.truncated) for r in research.paged(rows, ["trade_date"], 2, 3).collect()] == [(4, 10, True), (5, 10, True)]


def test_orphans_and_marks(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("z", 3)], "symbol string, v int")
    rows = bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "x", 9), ("b", D(2024, 1, 2), 1.0, 0, "x", 9)])
    assert [r.symbol for r in reconcile.purge_orphans(facts, rows, BARS).collect()] == ["a"]
    assert reconcile.purge_orphans(facts, rows.limit(0), BARS).count() == 3
    marks = spark.createDataFrame([("valuation_metrics", D(2024, 1, 9)), ("daily_bars", D(2024, 1, 3)), ("fund_flow", D(2024, 1, 9)), ("hot_rank", D(2024, 1, 9))], "dataset string, watermark date")
    days = spark.createDataFrame([("valuation_metrics", D(2024, 1, 5), 0.7), ("valuation_metrics", D(2024, 1, 6), 0.69), ("daily_bars", D(2024, 1, 8), 1.0), ("fund_flow", D(2024, 1, 4), 0.1)], "dataset string, trade_date date, ratio double")
    got = {r.dataset: r.watermark and r.watermark.day for r in reconcile.watermark_reconcile(marks, days).collect()}
    assert got == {"valuation_metrics": 5, "daily_bars": 3, "fund_flow": 4, "hot_rank": None}
    assert {r.dataset: r.watermark for r in reconcile.watermark_reconcile(marks, days, 0.71).collect()}["valuation_metrics"] is None


def test_stream_merges_like_a_batch(spark, tmp_path):
    batches = [bars(spark, [("a", D(2024, 1, 2), 1.0, 1, "vendor_a", 9)]), bars(spark, [("a", D(2024, 1, 2), 2.0, 1, "vendor_a", 10), ("b", D(2024, 1, 2), 3.0, 1, "vendor_a", 9)]), bars(spark, [("a", D(2024, 1, 2), 9.0, 1, "vendor_a", 8)])]
    for k, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(b.schema).parquet(f"{tmp_path}/in")
        q = incremental.merge_stream(spark, stream, BARS, f"file://{tmp_path}/lake", f"{tmp_path}/state")
        q.awaitTermination(60)
        assert versions.state(spark, f"file://{tmp_path}/lake", BARS).first().version == k + 1
    got = {r.symbol: r.close for r in versions.read(spark, f"file://{tmp_path}/lake", BARS).collect()}
    assert got == {"a": 2.0, "b": 3.0}


def test_stream_resamples_like_a_batch(spark, tmp_path):
    rows = spark.createDataFrame([("a", D(2024, 1, 2), dt.datetime(2024, 1, 2, 9, m), m - 1.0, m + 1.0, m - 2.0, float(m), 10, 5.0 * m) for m in range(31, 60)], "symbol string, trade_date date, bar_time timestamp_ntz, open double, high double, low double, close double, volume bigint, amount double")
    rows.write.parquet(f"{tmp_path}/bars")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/bars")
    q = incremental.resample_stream(stream, 15).writeStream.format("memory").queryName("resampled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    told = lambda found: {(str(r.bar_time)[:16], r.open, r.high, r.low, r.close, r.volume, r.amount, r.n) for r in found}
    batch = told(derive.resample(rows, 15).collect())
    assert told(spark.table("resampled").collect()) == batch and len(batch) == 2
    assert ("2024-01-02 09:45", 30.0, 46.0, 29.0, 45.0, 150, 5.0 * sum(range(31, 46)), 15) in batch
