"""Audits of stored tables and of a whole lake: every check's outcome as rows of one schema of findings.

``dataset, severity, check, n, details``: how many rows, files, days or names a check found, and the first of them.
"""

from __future__ import annotations

import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import Dataset
from ..sources import lake
from . import canonical, quality, stats

def _unreadable(spark: SparkSession, files: list[str]) -> DataFrame:
    """Which of some files hold no Parquet: files that gave no row, which may be sound and empty. Tasks look at their bytes."""
    if not files:
        return spark.createDataFrame([], "file string")
    content = spark.read.format("binaryFile").load(files).select(F.col("_metadata.file_path").alias("file"), "content")

    def probe(frames):
        import pandas as pd
        import pyarrow.parquet as pq

        for frame in frames:
            bad = []
            for file, data in zip(frame["file"], frame["content"], strict=True):
                try:
                    pq.ParquetFile(io.BytesIO(data))
                except Exception:  # whatever a reader says of broken bytes
                    bad.append(file)
            yield pd.DataFrame({"file": bad}, dtype=str)

    return content.mapInPandas(probe, "file string")


def per_file(spark: SparkSession, path: str, dataset: Dataset, start: str | None = None, end: str | None = None, bar_rules: bool = True) -> DataFrame:
    """Each readable file of a table with its rows and how many of them break each rule of the contract: one pass over the table."""
    rows = lake.open_table(spark, path, dataset, start, end, lenient=True, origin=True)
    rules = canonical.rules(rows, dataset, bar_rules)
    return rows.groupBy("_file", "_types").agg(F.count("*").alias("n_rows"), *[F.count_if(v).alias(k) for k, v in rules.items()])


def schema_contract(spark: SparkSession, path: str, dataset: Dataset, start: str | None = None, end: str | None = None, told: DataFrame | None = None, bar_rules: bool = True) -> DataFrame:
    """``file, check, n``: files of a table that break its contract.

    unreadable: no Parquet, or rows that a reader could not reach (n: how many, 0 if unknown). required_missing, not_finite and the
    bar rules: rows that break them, values that do not cast to the contract's type among them; a file without a required column breaks
    it with every row. types_differ: readable, but a column is stored in another type. told: per_file() if it is there already. bar_rules: False
    where the bar rules have a check of their own (canonical.bar_invariants()).
    """
    told = per_file(spark, path, dataset, start, end, bar_rules) if told is None else told
    rules = [c for c in told.columns if c not in ("_file", "_types", "n_rows")]
    broken = told.unpivot(["_file"], rules, "check", "n").where("n > 0").select(F.col("_file").alias("file"), "check", "n")
    typed = told.where("_types <> ''").select(F.col("_file").alias("file"), F.lit("types_differ").alias("check"), F.col("n_rows").alias("n"))
    folders = [p for paths in lake._layouts(spark, path, start, end) for p in paths]
    listed = lake.files(spark, folders)
    if not folders:
        return broken.unionByName(typed)
    stored = spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").schema("_none boolean").parquet(*folders).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("stored"))
    j = listed.join(stored, "file", "left").join(told.select(F.col("_file").alias("file"), "n_rows"), "file", "left")
    short = j.where("stored > coalesce(n_rows, 0)").select("file", F.lit("unreadable").alias("check"), (F.col("stored") - F.coalesce("n_rows", F.lit(0))).alias("n"))
    silent = [r["file"] for r in j.where("stored IS NULL").select("file").collect()]  # files without a row: empty or broken ones
    gone = _unreadable(spark, silent).select("file", F.lit("unreadable").alias("check"), F.lit(0).cast("long").alias("n"))
    return broken.unionByName(typed).unionByName(short).unionByName(gone)


def _one(rows: DataFrame, dataset: str, severity: Column | str, check: Column | str, n: Column, details: Column | None = None) -> DataFrame:
    as_col = lambda c: F.lit(c) if isinstance(c, str) else c
    return rows.select(F.lit(dataset).alias("dataset"), as_col(severity).alias("severity"), as_col(check).alias("check"), n.cast("long").alias("n"), (details if details is not None else F.lit(None)).cast("string").alias("details"))


def table_audit(spark: SparkSession, path: str, dataset: Dataset, start: str | None = None, end: str | None = None, mock: str = "mock", today: str | None = None, bar_rules: bool = True) -> DataFrame:
    """Findings of a stored table, or of the folders of a window: absent or empty, files that break the contract, duplicate keys, rows
    of a stand-in source, and periods that lost half of their rows or symbols. Files that cannot be read are reported and left out of the rest.

    Two passes: counts per file and source, and keys. The files' counts are written to no place: they are some rows a file.
    """
    layout = lake._layouts(spark, path, start, end)
    if not any(layout):
        return spark.createDataFrame([(dataset.name, "error", "exists", 1, f"no data of {dataset.name}")], "dataset string, severity string, check string, n long, details string")
    told = per_file(spark, path, dataset, start, end, bar_rules)
    contract = schema_contract(spark, path, dataset, start, end, told)
    name = F.regexp_extract("file", "([^/]+/[^/]+)$", 1)
    files = contract.groupBy("check").agg(F.count("*").alias("n"), F.min(name).alias("first"))
    severity = F.when(F.col("check") == "types_differ", "warning").otherwise("error")
    out = [_one(files, dataset.name, severity, F.concat(F.lit("schema_contract:"), "check"), F.col("n"), F.col("first"))]
    rows = lake.open_table(spark, path, dataset, start, end, lenient=True).drop(lake.PERIOD)
    out += [_one(told.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")).where("n = 0"), dataset.name, "error", "non_empty", F.lit(1))]
    return quality.audit_union(out + [row_audit(rows, dataset, mock, today, bar_rules)])


def row_audit(rows: DataFrame, dataset: Dataset, mock: str = "mock", today: str | None = None, bar_rules: bool = True) -> DataFrame:
    """Findings of a dataset's rows, in two passes: no row at all, rules of the contract, rows of a stand-in source; and duplicate keys.
    With a date axis also periods that lost half of their rows or symbols.
    """
    rules = canonical.rules(rows, dataset, bar_rules)
    counts = rows.agg(F.count("*").alias("_n"), F.count_if(F.col("source") == mock).alias("mock_rows"), *[F.count_if(v).alias(k) for k, v in rules.items()])
    names = ["empty", "mock_rows", *rules]
    one = counts.withColumn("empty", (F.col("_n") == 0).cast("long")).unpivot([], names, "check", "n").where("n > 0")
    out = [_one(one, dataset.name, F.when(F.col("check") == "mock_rows", "warning").otherwise("error"), F.col("check"), F.col("n"))]
    out.append(_one(quality.pk_duplicates(rows, list(dataset.key)).where("n_duplicates > 0"), dataset.name, "error", "duplicate_keys", F.col("n_duplicates")))
    if dataset.period and dataset.date_col and "symbol" in rows.columns:
        lost = quality.row_mutation(rows, dataset.date_col, dataset.period, today=today)
        out.append(quality.finding(lost, dataset.name, "warning", "row_mutation", F.col("period")))
    return quality.audit_union(out)


def lake_audit(frames: dict[str, DataFrame], registry: dict[str, Dataset], mock: str = "mock", bar_rules: bool = True) -> DataFrame:
    """row_audit() of many datasets."""
    return quality.audit_union([row_audit(rows, registry[name], mock, bar_rules=bar_rules) for name, rows in frames.items()])
