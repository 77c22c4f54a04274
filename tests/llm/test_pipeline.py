import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerlake.llm.scratch import cut

from .conftest import SF
from .test_bpe import check_packing
from .test_dedup import plain_shingles
from .test_filters import plain_counts


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = cut(stage(spark, docs, SF), name.replace(" ", "-"))
        after = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and after <= set(before) and after
        if name == "quality rules":
            assert not any(plain_counts(before[k].text)[5] for k in after)
        if name.startswith("simhash"):
            sets = {k: plain_shingles(r.text) for k, r in before.items()}
            near = lambda a, b: 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])  # noqa: B023, E731
            assert not any(near(a, b) for a in after for b in after if a < b)
            assert all(any(near(k, j) for j in before if j != k) for k in set(before) - after)
    rows = corpus_pipeline.pack(spark, docs, SF).collect()
    check_packing(rows, 1024)
    assert {r.doc_id for r in rows} == after


def test_odd_rows_and_empty_table(spark, docs):
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF), "odd")
    assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = cut(stage(spark, empty, SF), "empty")
        assert empty.count() == 0


@pytest.mark.parametrize("where", ["true", "doc_id < 0"])
def test_run(spark, tmp_path, where):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{t}.parquet").where(F.expr(where)).write.parquet(f"{tmp_path}/{t}.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(rows) == (where == "true")
