"""Reading registered datasets from Parquet folders laid out by period, and writing them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import periods
from ..operators.canonical import dedupe, digest
from ..registry import Dataset

PERIOD = "__period"


def empty(spark: SparkSession, dataset: Dataset) -> DataFrame:
    """A typed frame without rows, for a dataset that is absent."""
    return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in dataset.schema.items()))


def scan(rows: DataFrame, dataset: Dataset, start: str | None = None, end: str | None = None, symbols: list[str] | DataFrame | None = None) -> DataFrame:
    """Rows of a window (ends included) and of some symbols. A period column is filtered as well, which prunes folders;
    the row's own date decides at the edges. Facts are windowed by the quarters of their report periods.
    """
    if dataset.label_col:
        axis = [dataset.label_col] + [PERIOD] * (PERIOD in rows.columns)
        for c in axis:
            loose = F.col(c).isNull() if c == PERIOD else F.lit(False)
            rows = rows.where((F.col(c) >= periods.label(F.lit(start).cast("date"), dataset.period)) | loose) if start else rows
            rows = rows.where((F.col(c) <= periods.label(F.lit(end).cast("date"), dataset.period)) | loose) if end else rows
    elif dataset.date_col:
        for bound, value in (("a", start), ("z", end)):
            if value:
                d = F.lit(value).cast("date")
                rows = rows.where(F.col(dataset.date_col) >= d if bound == "a" else F.col(dataset.date_col) <= d)
                if PERIOD in rows.columns:
                    p = periods.label(d, dataset.period)
                    in_folder = F.col(PERIOD) >= p if bound == "a" else F.col(PERIOD) <= p
                    rows = rows.where(in_folder | F.col(PERIOD).isNull())  # loose rows have no period
    if symbols is not None and "symbol" in rows.columns:
        rows = rows.join(symbols.select("symbol"), "symbol", "left_semi") if isinstance(symbols, DataFrame) else rows.where(F.col("symbol").isin(symbols))
    return rows.drop(PERIOD)


def union_by_name(parts: list[DataFrame]) -> DataFrame:
    """Old and new layouts together: columns by name, missing ones null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def _where(spark: SparkSession, path: str):
    """A path and its file system, of Hadoop's API: names are listed and folders moved through it, no file is read."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[tuple[str, str, bool]]:
    """Name, full path and whether it is a folder, of what lies in a folder; nothing if it is absent."""
    where, fs = _where(spark, path)
    return [(f.getPath().getName(), f.getPath().toString(), f.isDirectory()) for f in fs.listStatus(where)] if fs.exists(where) else []


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of some folders that are there."""
    return [p for p in paths for where, fs in [_where(spark, p)] if fs.exists(where)]


def folders(spark: SparkSession, path: str) -> DataFrame:
    """``period, start, end`` of a table's period folders, by their names alone; no file is opened and odd names are skipped."""
    found = [(name.split("=", 1)[1],) for name, _, is_dir in _children(spark, path) if is_dir and "=" in name]
    return list_partitions(spark.createDataFrame(found, f"{PERIOD} string"))


def files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file, period, n_bytes`` of the Parquet files below some folders (period: null for loose ones). They are listed, none is opened.

    Folders that are absent have none.
    """
    paths = present(spark, paths)
    if not paths:
        return spark.createDataFrame([], "file string, period string, n_bytes long")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("n_bytes")).select("file", period_of(F.col("file")).alias("period"), "n_bytes")


def period_of(file: Column) -> Column:
    """The period of the folder that a file lies in; null if it lies in none."""
    return F.nullif(F.regexp_extract(file, f"/{PERIOD}=([^/]+)/", 1), F.lit(""))


def _layouts(spark: SparkSession, path: str, start: str | None, end: str | None) -> tuple[list[str], list[str]]:
    """A table's period folders that may hold days of a window, and its loose files. Folders are told by their names."""
    found = _children(spark, path)
    inside = {name: p for name, p, is_dir in found if is_dir and name.startswith(f"{PERIOD}=")}
    if (start or end) and inside:
        known = folders(spark, path)
        a, z = (F.lit(d).cast("date") for d in (start, end))
        out = known.where((F.lit(False) if start is None else F.col("end") < a) | (F.lit(False) if end is None else F.col("start") > z))
        for r in out.collect():  # one row a period
            inside.pop(f"{PERIOD}={r['period']}", None)
    return list(inside.values()), [p for name, p, is_dir in found if not is_dir and name.endswith(".parquet")]


def _alike(spark: SparkSession, base: str, paths: list[str], wanted: dict[str, str], lenient: bool) -> list[tuple[dict[str, str], list[str]]]:
    """paths in groups whose files agree on the types of the wanted columns: ``(types by column, paths)``.

    Footers are read by Spark's own job over all paths at once. Where two types of a column meet, the paths are halved until
    each part merges, down to single files; parts that agree are put together again. So a table of one kind costs one job, and a file
    that differs some more of its own part.
    """

    def merged(some: list[str]) -> list[tuple[dict[str, str], list[str]]]:
        reader = spark.read.option("basePath", base).option("mergeSchema", "true").option("ignoreCorruptFiles", lenient)
        try:
            return [({c: t for c, t in reader.parquet(*some).dtypes if c in wanted}, some)]
        except Exception as e:
            if lenient and "UNABLE_TO_INFER_SCHEMA" in str(e):  # none of them can be opened
                return []
            if "CANNOT_MERGE" not in str(e):
                raise
        if len(some) == 1:
            inner = [p for name, p, is_dir in _children(spark, some[0]) if is_dir or name.endswith(".parquet")]
            if not inner:
                raise ValueError(f"{some[0]} cannot be merged with itself")
            return merged(inner)
        return merged(some[: len(some) // 2]) + merged(some[len(some) // 2 :])

    groups: list[tuple[dict[str, str], list[str]]] = []
    for types, some in merged(paths):
        for known, taken in groups:
            if all(known.get(c, t) == t for c, t in types.items()):
                known.update(types)
                taken += some
                break
        else:
            groups.append((dict(types), list(some)))
    return groups


def open_table(spark: SparkSession, path: str, dataset: Dataset, start: str | None = None, end: str | None = None, lenient: bool = False, origin: bool = False) -> DataFrame:
    """A table's rows as its contract types them, out of period folders and of loose files beside them.

    start, end: folders that hold no day of this window are left out by their names, before any file is opened; rows are not
    filtered, scan() does that. Files may lack columns, or hold them in other types, within one folder too: those whose schemas agree
    are read together, and values are cast without raising. Rows of folders carry their period, so a scan prunes;
    loose rows carry none, and their dates decide. A table that is absent is empty.

    lenient: files that cannot be read give no rows instead of an error. origin: with ``_file`` and ``_types`` (columns that the
    file holds in another type than the contract).
    """
    parts = []
    for k, paths in enumerate(_layouts(spark, path, start, end)):
        for types, some in _alike(spark, path, paths, dataset.schema, lenient) if paths else []:
            stored = types | ({} if k else {PERIOD: "string"})
            rows = spark.read.option("basePath", path).option("ignoreCorruptFiles", lenient).schema(", ".join(f"`{c}` {t}" for c, t in (stored or {PERIOD: "string"}).items())).parquet(*some)
            typed = [(F.col(c).try_cast(t) if c in types else F.lit(None).cast(t)).alias(c) for c, t in dataset.schema.items()]
            odd = ",".join(c for c, t in dataset.schema.items() if c in types and not _widens(types[c], t))
            told = [F.col("_metadata.file_path").alias("_file"), F.lit(odd).alias("_types")] if origin else []
            parts.append(rows.select(*typed, (F.lit(None) if k else F.col(PERIOD)).cast("string").alias(PERIOD), *told))
    if parts:
        return union_by_name(parts)
    more = {"_file": "string", "_types": "string"} if origin else {}
    return empty(spark, dataset).withColumns({c: F.lit(None).cast(t) for c, t in ({PERIOD: "string"} | more).items()})


def _widens(stored: str, wanted: str) -> bool:
    """Whether every value of one type is one of another."""
    numbers = ("tinyint", "smallint", "int", "bigint", "double")
    if stored in numbers and wanted in numbers:
        return numbers.index(stored) <= numbers.index(wanted)
    return stored == wanted or (stored == "float" and wanted == "double") or {stored, wanted} == {"timestamp", "timestamp_ntz"}


def repartition(spark: SparkSession, source: str, dataset: Dataset, target: str, dry_run: bool = False) -> DataFrame:
    """Lay a table out anew by the registered period: one row per key where old folders overlap.

    Returns ``period, n`` as written, or as it would be with dry_run. Raises if the table that was written lacks a key.
    """
    rows = dedupe(open_table(spark, source, dataset).drop(PERIOD), dataset)
    plan = by_period(rows, dataset).groupBy(F.col(PERIOD).alias("period")).agg(F.count("*").alias("n"))
    if dry_run:
        return plan
    want = rows.count()
    write(rows, dataset, target)
    have = open_table(spark, target, dataset)
    if have.count() != want:
        raise RuntimeError(f"{dataset.name}: {want} rows were to be written")
    return have.groupBy(F.col(PERIOD).alias("period")).agg(F.count("*").alias("n"))


def mixed_folders(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """``period, start, end, overlaps``: folders of another period than the registered one, and whether each shares days with another folder.

    A sweep over the folders' bounds in order: one overlaps if it starts before an earlier one ends, or ends after a later one starts.
    """
    order = Window.partitionBy(F.lit(1)).orderBy("start", "end", "period")  # one row a folder
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min("start").over(order.rowsBetween(1, Window.unboundedFollowing))
    swept = folders(spark, path).withColumn("overlaps", F.coalesce(before >= F.col("start"), F.lit(False)) | F.coalesce(after <= F.col("end"), F.lit(False)))
    return swept.where(F.col("period") != F.coalesce(periods.label(F.col("start"), dataset.period), F.lit("")))


def mixed_granularity(spark: SparkSession, path: str, dataset: Dataset) -> DataFrame:
    """``period, overlaps, n_repeated``: folders of another period than the registered one, with how many of their keys lie in another folder too.

    Keys are compared in the folders that overlap alone; the rest of the table is not opened.
    """
    odd = mixed_folders(spark, path, dataset)
    bounds = odd.where("overlaps").agg(F.min("start").cast("string").alias("a"), F.max("end").cast("string").alias("z")).first()
    if bounds["a"] is None:
        return odd.select("period", "overlaps", F.lit(0).cast("long").alias("n_repeated"))
    rows = open_table(spark, path, dataset, bounds["a"], bounds["z"]).where(F.col(PERIOD).isNotNull())
    spread = rows.groupBy(*dataset.key).agg(F.collect_set(PERIOD).alias("_in")).where(F.size("_in") > 1)  # a key lies in as many folders as there are grains
    n = spread.select(F.explode("_in").alias("period")).groupBy("period").agg(F.count("*").alias("n_repeated"))
    return odd.join(n, "period", "left").select("period", "overlaps", F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"))


def repartition_candidates(spark: SparkSession, tables: dict[str, str], registry: dict[str, Dataset]) -> DataFrame:
    """``dataset, wanted, n_folders, n_overlapping``: tables (name: path) with folders of another period than the registry says."""
    out = [mixed_folders(spark, path, registry[name]).agg(F.count("*").alias("n_folders"), F.count_if("overlaps").alias("n_overlapping")).select(F.lit(name).alias("dataset"), F.lit(registry[name].period).alias("wanted"), "n_folders", "n_overlapping") for name, path in tables.items() if registry[name].period]
    return union_by_name(out).where("n_folders > 0")


def by_period(rows: DataFrame, dataset: Dataset) -> DataFrame:
    """rows with the label of the period that each belongs to: of its date, or the label that is its axis."""
    return rows.withColumn(PERIOD, F.col(dataset.label_col) if dataset.label_col else periods.label(F.col(dataset.date_col), dataset.period))


def labels_of(rows: DataFrame, dataset: Dataset) -> list[str]:
    """The periods that some rows touch: a batch touches few, a whole dataset some thousand."""
    return sorted(r[0] for r in by_period(rows, dataset).select(PERIOD).distinct().collect())


def stored_periods(spark: SparkSession, path: str, labels: list[str]) -> DataFrame:
    """The rows of some periods of a table; only their folders are read."""
    return spark.read.parquet(path).where(F.col(PERIOD).cast("string").isin(labels)).drop(PERIOD)


def write(rows: DataFrame, dataset: Dataset, path: str) -> None:
    """Replace the periods that occur in rows; others stay. zstd Parquet, one folder per period.

    Rows are rebalanced by period: a small one is one file, a large one is dealt to tasks by its bytes.
    """
    by_period(rows, dataset).hint("rebalance", F.col(PERIOD)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(PERIOD).parquet(path)


def list_partitions(rows: DataFrame) -> DataFrame:
    """Periods in order of their first day; unreadable labels are skipped."""
    p = rows.select(F.col(PERIOD).cast("string").alias("period")).distinct()
    return p.select("period", periods.start(F.col("period")).alias("start"), periods.end(F.col("period")).alias("end")).where("start IS NOT NULL").orderBy("start", "period")


def merge(stored: DataFrame, staged: DataFrame, dataset: Dataset) -> DataFrame:
    """The merged rows of the periods that a batch touches: stored and staged rows, one per key.

    A stored table with a period column is pruned to those periods' folders.
    """
    labels = labels_of(staged, dataset)
    old = stored.where(F.col(PERIOD).cast("string").isin(labels)) if PERIOD in stored.columns else by_period(stored, dataset).where(F.col(PERIOD).isin(labels))
    return dedupe(old.drop(PERIOD).unionByName(staged, allowMissingColumns=True), dataset)


def changed_periods(stored: DataFrame, merged: DataFrame, dataset: Dataset) -> DataFrame:
    """Periods of merged whose content differs from the stored one: add or replace, with their rows."""
    old, new = (digest(by_period(r, dataset), [PERIOD]) for r in (stored, merged))
    j = new.join(old.select(PERIOD, F.col("hash").alias("_h"), F.col("n").alias("_n")), PERIOD, "left")
    kind = F.when(F.col("_h").isNull(), "add").when((F.col("_h") != F.col("hash")) | (F.col("_n") != F.col("n")), "replace")
    return j.select(F.col(PERIOD).alias("period"), kind.alias("kind"), "n").where("kind IS NOT NULL")


def compact_merge(spark: SparkSession, dataset: Dataset, path: str, staged: DataFrame, scratch: str) -> DataFrame:
    """Merge a batch into the table at path: periods whose content changes are replaced, others stay untouched.

    The batch is stored below ``scratch`` once, by period, so its periods are told by folders' names. Only their folders of the table
    are read and digested. Merged rows are written once, beside the table; folders that changed are moved into it, the old ones out of
    it, so the table may be its own source. Returns the changed periods as a receipt: ``period, kind, n``; a second merge of the same
    batch changes nothing.
    """
    write(staged, dataset, f"{scratch}/batch")
    labels = [name.split("=", 1)[1] for name, _, is_dir in _children(spark, f"{scratch}/batch") if is_dir and name.startswith(f"{PERIOD}=")]
    stored = stored_periods(spark, path, labels)
    batch = spark.read.schema(staged.schema).parquet(f"{scratch}/batch").select(*staged.columns)
    write(dedupe(stored.unionByName(batch, allowMissingColumns=True), dataset), dataset, f"{scratch}/merged")
    merged = stored_periods(spark, f"{scratch}/merged", labels)
    changed = changed_periods(stored, merged, dataset).collect()  # at most one row a touched period
    for r in changed:
        replace_folder(spark, f"{scratch}/merged/{PERIOD}={r['period']}", f"{path}/{PERIOD}={r['period']}", f"{scratch}/old/{PERIOD}={r['period']}")
    return spark.createDataFrame(changed, "period string, kind string, n long")


def replace_folder(spark: SparkSession, new: str, target: str, aside: str) -> None:
    """Move a folder to where another one is, and that one aside."""
    (source, fs), (to, _), (old, _) = (_where(spark, p) for p in (new, target, aside))
    if fs.exists(to):
        fs.mkdirs(old.getParent())
        if not fs.rename(to, old):
            raise OSError(f"{target} could not be moved")
    if not fs.rename(source, to):
        raise OSError(f"{new} could not be moved")


def fingerprint(rows: DataFrame) -> str:
    """Count and content of a state, as text."""
    now = digest(rows, []).first()
    return f"{now['n']}-{now['hash']}"


def delta(base: DataFrame, target: DataFrame, dataset: Dataset, bound: bool = False) -> DataFrame:
    """Difference of two states by period: add, replace or delete. bound: with the fingerprint of the base that it is for."""
    a, b = (digest(by_period(r, dataset), [PERIOD]) for r in (base, target))
    j = a.select(PERIOD, F.struct("n", "hash").alias("a")).join(b.select(PERIOD, F.struct("n", "hash").alias("b")), PERIOD, "full_outer")
    kind = F.when(F.col("a").isNull(), "add").when(F.col("b").isNull(), "delete").when(F.col("a") != F.col("b"), "replace")
    out = j.select(F.col(PERIOD).alias("period"), kind.alias("kind")).where("kind IS NOT NULL")
    return out.withColumn("base", F.lit(fingerprint(base))) if bound else out


def delta_apply(base: DataFrame, target: DataFrame, changes: DataFrame, dataset: Dataset) -> DataFrame:
    """base with a delta's periods taken from target; applying it again changes nothing."""
    names = F.broadcast(changes.select(F.col("period").alias(PERIOD), "kind"))
    if "base" in changes.columns:  # made for this very state?
        if not changes.where(F.col("base") != fingerprint(base)).isEmpty():
            raise ValueError("the delta was made for another base")
    kept = by_period(base, dataset).join(names, PERIOD, "left_anti")
    new = by_period(target, dataset).join(names.where("kind <> 'delete'"), PERIOD, "left_semi")
    return kept.unionByName(new).drop(PERIOD)


def master_merge(old: DataFrame, new: DataFrame, day: str, patience: int, most_absent: float) -> DataFrame:
    """A slowly changing master: names missing from the snapshot stay; dates stick; a name absent ``patience`` times is taken
    as delisted on that day, unless more than ``most_absent`` of all names are absent at once.
    """
    o = old.select("symbol", *[F.col(c).alias(f"o_{c}") for c in ("name", "list_date", "delist_date", "absences")])
    j = o.withColumn("_o", F.lit(True)).join(new.select("symbol", "name", "list_date", "delist_date").withColumn("_n", F.lit(True)), "symbol", "full_outer")
    guard = j.agg((F.count_if(F.col("_n").isNull() & F.col("o_delist_date").isNull()) <= most_absent * F.count_if(F.col("_o"))).alias("_ok"))
    j = j.join(F.broadcast(guard))  # one row
    absences = F.when(F.col("_n"), 0).otherwise(F.coalesce("o_absences", F.lit(0)) + 1)
    gone = F.when(F.col("_ok") & (absences >= patience), F.lit(day).cast("date"))
    return j.select("symbol", F.coalesce("name", "o_name").alias("name"), F.coalesce("list_date", "o_list_date").alias("list_date"), F.coalesce("delist_date", "o_delist_date", gone).alias("delist_date"), absences.cast("int").alias("absences"))
