import gzip
import hashlib
import random
import zlib

import duckdb
import pytest

from ledgerlake.llm import queries, scratch, warc


def pages(spark):
    same = "<html>" + "same " * 40 + "</html>"
    rows = [(5, "http://a.example/x y\r\n", same), (3, None, same), (9, "http://b.example", same), (None, "http://n.example", same), (4, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (11, "u", "é\r\n\r\nWARC/1.1 中" * 30), (12, "u", "z" * 3_000_000), (3, None, same)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload_bytes string")


def test_round_trip(spark):
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(pages(spark)).collect())
    want = []
    for r in pages(spark).collect():
        raw = (r.html or "").encode()
        again = len(raw) >= 100 and "same" in r.html and r.page_id != 3
        want.append((str(r.page_id), len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want)
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def plain(rows):
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("most", [1, 1500, warc.MOST])
def test_members_and_index(spark, most):
    target = scratch.new_path(spark, "warc-test")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "2")
    try:
        warc.archive(pages(spark).coalesce(1), target, most)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    entries = warc.index(spark, target).collect()
    files = {r.archive: bytes(r.content) for r in warc.archives(spark, target).collect()}
    assert len(entries) == 11 and len(files) == {1: 11, 1500: len(files), warc.MOST: 1}[most] and len(files) >= (most < warc.MOST) + 1
    by_file = {}
    for e in entries:
        by_file.setdefault(e.archive, []).append(e)
    for name, found in by_file.items():
        data, at = files[name], 0
        whole = gzip.decompress(data)  # any gzip reader takes the file as one
        assert len(found) == 1 or len(data) <= most
        for e in sorted(found, key=lambda e: e.offset):
            assert e.offset == at
            record = zlib.decompress(data[at : at + e.length], 31)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(warc.END) and record in whole
            fields, _ = warc.read_member(data, e.offset, e.length)
            assert fields["warc-type"] == e.type
            at += e.length
        assert at == len(data)
    every = warc.read(spark, target).collect()
    some = warc.fetch(spark, target, spark.createDataFrame([(5,), (12,), (12,), (None,), (999,)], "page_id long"))
    assert len(every) == 11 and plain(some.collect()) == plain(r for r in every if r.page_id in (5, 12))


def test_a_stream_of_many_pieces_and_a_large_record(spark):
    rng = random.Random(3)
    rows = [(k, "u", "".join(chr(rng.randrange(32, 0x250)) for _ in range(2_000_000 if k == 3 else 5000))) for k in range(40)]
    made = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    want = plain((k, len(t.encode()), hashlib.sha256(t.encode()).hexdigest(), "response", None, "u") for k, _, t in rows)
    assert plain(warc.round_trip(made, most=100_000).collect()) == want
    assert plain(warc.round_trip(made).collect()) == want


def test_query_against_its_sql(spark, tmp_path):
    made = pages(spark).where("page_id IS NOT NULL")
    made.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    told = con.sql(queries.ORACLES["op2_warc"])
    got = queries.op2_warc(spark, str(tmp_path))
    assert got.columns == told.columns and plain(got.collect()) == plain(told.fetchall())


def test_monolithic_files_are_inflated_once_in_any_pieces():
    records = [b"WARC/1.1\r\nContent-Length: %d\r\n\r\n" % n + bytes(k % 251 for k in range(n)) for n in (0, 1, 5000, 70_000)]
    whole = b"".join(r + warc.END for r in records)
    members = b"".join(gzip.compress(r + warc.END) + b"\0" * k for k, r in enumerate(records))
    for data in (gzip.compress(whole), members, gzip.compress(whole[:9000]) + gzip.compress(whole[9000:])):
        for step in (1, 7, 1 << 20):
            assert list(warc.split_records(warc.inflated(data, step))) == records
    with pytest.raises(ValueError):
        list(warc.inflated(gzip.compress(whole)[:-9]))
    with pytest.raises(ValueError):
        list(warc.split_records([whole[:-1]]))
    with pytest.raises(ValueError):
        list(warc.split_records([b"HTTP/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"]))
