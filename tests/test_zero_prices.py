"""Queries give their SQL's rows on ticks with prices of 0, which sf0.001 lacks and larger tables hold."""

import datetime

import duckdb
import pytest

from ledgerlake.operators import audit
from ledgerlake.plans import catalog
from ledgerlake.registry import DATASETS
from tests.test_oracles import SF, TABLES, rows

ZEROS = "CASE WHEN event_id % 13 = 0 OR CAST(ts AS DATE) = DATE '2024-01-02' AND user_id % 5 = 1 THEN 0.0 ELSE value END"


@pytest.fixture(scope="module")
def zeros(tmp_path_factory):
    """A folder as sf0.001 in which some ticks cost nothing, among them all of some names' first day."""
    path, con = tmp_path_factory.mktemp("zeros"), duckdb.connect()
    for t in TABLES:
        con.sql(f"COPY (SELECT * {f'REPLACE ({ZEROS} AS value)' if t == 'events' else ''} FROM '{SF}/{t}.parquet') TO '{path}/{t}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return str(path), con


@pytest.mark.parametrize("name", ["load_qfq", "query_bars", "read_validated", "load", "diff_gate", "diff_fields", "survivorship_return", "row_audit", "lake_audit", "schema_contract", "dataset_audit"])
def test_zero_prices(spark, zeros, name):
    path, con = zeros
    ours, theirs = catalog.QUERIES[name](spark, path), con.sql(catalog.ORACLES[name])
    assert str(rows(ours.columns, ours.collect())) == str(rows(theirs.columns, theirs.fetchall()))  # as text: NaN equals itself


def test_a_gate_that_no_day_reaches(spark, tmp_path):
    """watermark_reconcile where the other source has no close on any day, so no day reaches the gate."""
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * FROM '{SF}/orders.parquet') TO '{tmp_path}/orders.parquet' (FORMAT parquet)")
    con.sql(f"COPY (SELECT i * 100 AS event_id, TIMESTAMP '2024-01-01 10:00:00' + INTERVAL (i // 15) DAY AS ts, i % 15 AS user_id, 'view' AS event_type, 5.0::DOUBLE AS value, '' AS props FROM range(450) r(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    for t in ("orders", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    ours, theirs = catalog.QUERIES["watermark_reconcile"](spark, str(tmp_path)), con.sql(catalog.ORACLES["watermark_reconcile"])
    found = rows(theirs.columns, theirs.fetchall())
    assert rows(ours.columns, ours.collect()) == found and ("1-URGENT", datetime.date(2024, 1, 25)) in found


def test_audits_still_hold_bar_rules(spark, zeros):
    """The operators' default: the queries above leave the bar rules out, as their SQL does."""
    shapes = catalog.Shapes(spark, zeros[0])
    audits = audit.row_audit(shapes.bars_raw, catalog.BARS), audit.lake_audit({"daily_bars": shapes.bars_raw}, DATASETS)
    assert all("price_not_positive" in {r.check for r in told.collect()} for told in audits)


def test_kept_shapes_are_not_made_again(spark):
    shapes = catalog.Shapes(spark, SF)
    made = sorted(map(tuple, shapes.status.collect()), key=str)
    shapes.keep("ticks", "bars")
    assert sorted(map(tuple, shapes.status.collect()), key=str) == made
    assert all("events.parquet" not in part.inputFiles()[0] for part in (shapes.status, shapes.calendar))
