"""Immutable versions of a dataset: a version is a list of period folders, and a commit writes only the periods that change.

``<root>/<dataset>/data/<id>`` holds the folders of a commit, ``_manifests/<id>`` its manifest: one row per period with the folder of its
rows, their count and digest. Both are written before ``_versions/<number>``, one small file whose exclusive creation is the lock that
lets one writer publish a number; it names the manifest. Versions are told by the names of these files: a read or commit opens
the newest of them and one manifest, however many came before. A manifest without such a file was never published.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import time
import uuid
from functools import lru_cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.canonical import dedupe, digest
from ..registry import Dataset
from .lake import PERIOD, _children, _where, by_period, write

MANIFEST = "dataset string, version long, parent long, tag string, id string, period string, folder string, n_rows long, hash string"
#: Seconds after which a number that was taken but never filled in counts as lost, with its writer.
LOST_AFTER = 60


class Conflict(RuntimeError):
    """The version that a commit was made for is no longer the current one."""


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share; one of this process where that is unset on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = _own()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(1)
def _own() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-lake-")


def _exists(spark: SparkSession, path: str) -> bool:
    where, fs = _where(spark, path)
    return fs.exists(where)


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that must not be there yet; False if it is. Of several writers one succeeds.

    A file system of a cluster decides that itself. Hadoop's own local one only looks first, so there the operating system does.
    """
    where, fs = _where(spark, path)
    fs.mkdirs(where.getParent())
    if fs.getUri().getScheme() == "file":
        try:
            with open(where.toUri().getPath(), "x") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(where, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception) or fs.exists(where):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _text(spark: SparkSession, path: str) -> str:
    where, fs = _where(spark, path)
    source = fs.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def _numbers(spark: SparkSession, root: str, dataset: Dataset) -> list[int]:
    """Numbers that were taken, in order, by names alone."""
    return sorted(int(name[1:]) for name, _, is_dir in _children(spark, f"{root}/{dataset.name}/_versions") if not is_dir and name[:1] == "v" and name[1:].isdigit())


def _entry(spark: SparkSession, root: str, dataset: Dataset, number: int) -> dict | None:
    """What a number was published for; None if its writer was lost before it said so."""
    path = f"{root}/{dataset.name}/_versions/v{number:012d}"
    text = _text(spark, path)
    return json.loads(text) | {"version": number} if text.endswith("}") else None


def newest(spark: SparkSession, root: str, dataset: Dataset) -> dict:
    """The current version's ``version, parent, tag, id``; version 0 without an id before the first commit."""
    for number in reversed(_numbers(spark, root, dataset)):
        found = _entry(spark, root, dataset, number)
        if found:
            return found
    return {"version": 0, "parent": None, "tag": None, "id": None}


def current(spark: SparkSession, root: str, dataset: Dataset) -> int:
    return newest(spark, root, dataset)["version"]


def _manifest_of(spark: SparkSession, root: str, dataset: Dataset, own: str | None) -> DataFrame:
    if own is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/{dataset.name}/_manifests/{own}")


def version_rows(spark: SparkSession, root: str, dataset: Dataset, version: int | str | None = None) -> DataFrame:
    """The manifest rows of one version, by number or id (none: the current one); one manifest is read."""
    if isinstance(version, str):
        if not _exists(spark, f"{root}/{dataset.name}/_manifests/{version}"):
            raise ValueError(f"{dataset.name} has no version {version}")
        rows = _manifest_of(spark, root, dataset, version)
        found = rows.select("version").first()
        entry = found and _entry(spark, root, dataset, found["version"])
        if not entry or entry["id"] != version:
            raise ValueError(f"{dataset.name}: {version} was never published")
        return rows
    entry = newest(spark, root, dataset) if version is None else {"id": None} if version == 0 else _published(spark, root, dataset, version)
    return _manifest_of(spark, root, dataset, entry["id"])


def _published(spark: SparkSession, root: str, dataset: Dataset, version: int) -> dict:
    entry = _entry(spark, root, dataset, version) if version in _numbers(spark, root, dataset) else None
    if not entry:
        raise ValueError(f"{dataset.name} has no version {version}")
    return entry


def manifest(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """All published versions' manifest rows, for a look at the history: reads and commits do without."""
    ids = [e["id"] for e in (_entry(spark, root, dataset, n) for n in _numbers(spark, root, dataset)) if e]
    if not ids:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(*[f"{root}/{dataset.name}/_manifests/{i}" for i in ids])


def state(spark: SparkSession, root: str, dataset: Dataset) -> DataFrame:
    """The current version: ``dataset, version, parent, tag, id, n_periods, n_rows``; no row before the first commit."""
    rows = version_rows(spark, root, dataset)
    return rows.groupBy("dataset", "version", "parent", "tag", "id").agg(F.count("period").alias("n_periods"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


def _tag_file(root: str, dataset: Dataset, tag: str) -> str:
    return f"{root}/{dataset.name}/_tags/{hashlib.sha256(tag.encode()).hexdigest()}"


def committed(spark: SparkSession, root: str, dataset: Dataset, tag: str) -> bool:
    """Whether a commit of this tag has been published: it is the newest one's, or has left its mark."""
    return newest(spark, root, dataset)["tag"] == tag or _exists(spark, _tag_file(root, dataset, tag))


def commit(root: str, dataset: Dataset, rows: DataFrame, parent: int = 0, tag: str | None = None, periods: list[str] | None = None) -> int:
    """Publish rows as the version after ``parent``; returns its number.

    rows are the whole dataset, or the whole of the given periods (others stay as they are in parent). They are computed and
    written once, and digested as stored; periods whose content is that of parent keep their folder, and the new one goes. Raises
    Conflict if parent is not the current version, or another writer publishes first.
    """
    spark, own = rows.sparkSession, uuid.uuid4().hex
    before = newest(spark, root, dataset)
    if before["version"] != parent:
        raise Conflict(f"{dataset.name} is no longer at version {parent}")
    folder = f"{root}/{dataset.name}/data/{own}"
    write(rows, dataset, folder)
    old = {r["period"]: r for r in _manifest_of(spark, root, dataset, before["id"]).where("period IS NOT NULL").collect()}  # one row a period
    entries = [] if periods is None else [(r["period"], r["folder"], r["n_rows"], r["hash"]) for p, r in old.items() if p not in periods]
    made = [name.split("=", 1)[1] for name, _, is_dir in _children(spark, folder) if is_dir and name.startswith(f"{PERIOD}=")]
    if made:
        stored = spark.read.schema(rows.schema).option("basePath", folder).parquet(folder)
        for r in digest(by_period(stored.select(*rows.columns), dataset), [PERIOD]).collect():
            same = r[PERIOD] in old and old[r[PERIOD]]["hash"] == r["hash"]
            target = f"{folder}/{PERIOD}={r[PERIOD]}"
            if same:
                where, fs = _where(spark, target)
                fs.delete(where, True)
            entries.append((r[PERIOD], old[r[PERIOD]]["folder"] if same else target, r["n"], r["hash"]))
    version = max([parent, *_numbers(spark, root, dataset)]) + 1
    table = spark.createDataFrame([(dataset.name, version, parent, tag, own, *e) for e in entries or [(None, None, 0, None)]], MANIFEST)
    table.coalesce(1).write.mode("errorifexists").parquet(f"{root}/{dataset.name}/_manifests/{own}")
    if before["tag"] is not None:  # every published tag but the newest has its mark before the next one is published
        _create(spark, _tag_file(root, dataset, before["tag"]), "")
    _publish(spark, root, dataset, version, {"id": own, "parent": parent, "tag": tag})
    return version


def _publish(spark: SparkSession, root: str, dataset: Dataset, version: int, entry: dict) -> None:
    """Take a number, if nobody else has taken it or a later one than the parent."""
    for n in _numbers(spark, root, dataset):
        if n > entry["parent"] and (_entry(spark, root, dataset, n) or _young(spark, f"{root}/{dataset.name}/_versions/v{n:012d}")):
            raise Conflict(f"{dataset.name} version {n} is published already")
    if not _create(spark, f"{root}/{dataset.name}/_versions/v{version:012d}", json.dumps(entry)):
        raise Conflict(f"{dataset.name} version {version} is published already")


def _young(spark: SparkSession, path: str) -> bool:
    where, fs = _where(spark, path)
    return time.time() - fs.getFileStatus(where).getModificationTime() / 1000 < LOST_AFTER


def commit_merge(root: str, dataset: Dataset, batch: DataFrame, tag: str | None = None) -> int:
    """Merge a batch into the current version and publish the result; reads and writes only the periods that it touches.

    The batch is computed once, stored by period: its periods are told by the names of those folders.
    """
    spark, staged = batch.sparkSession, f"{root}/{dataset.name}/_staged/{uuid.uuid4().hex}"
    write(batch, dataset, staged)
    labels = [name.split("=", 1)[1] for name, _, is_dir in _children(spark, staged) if is_dir and name.startswith(f"{PERIOD}=")]
    parent, rows = current(spark, root, dataset), spark.read.schema(batch.schema).parquet(staged).select(*batch.columns)
    stored = folders(spark, root, dataset, parent, labels)
    if stored:
        rows = spark.read.option("mergeSchema", "true").parquet(*stored).unionByName(rows, allowMissingColumns=True)
    version = commit(root, dataset, dedupe(rows, dataset), parent, tag, labels)
    where, fs = _where(spark, staged)
    fs.delete(where, True)
    return version


def commit_replace(root: str, dataset: Dataset, fresh: DataFrame, keys: DataFrame, tag: str | None = None) -> int:
    """Publish the current version with its rows of some keys replaced by fresh ones; only the periods of either are read and written.

    keys: some of the dataset's key columns, its date among them (the days, or days and symbols, that were derived anew). Stored rows of
    these keys go, whether or not fresh rows come for them.
    """
    spark = fresh.sparkSession
    parent = current(spark, root, dataset)
    labels = sorted(r[0] for r in by_period(keys.select(dataset.date_col), dataset).select(PERIOD).distinct().collect())  # periods that a batch touches
    kept = read(spark, root, dataset, parent, labels).join(keys.distinct(), keys.columns, "left_anti")
    return commit(root, dataset, kept.unionByName(fresh, allowMissingColumns=True), parent, tag, labels)


def receipt(spark: SparkSession, root: str, dataset: Dataset, version: int) -> DataFrame:
    """What a version changed: ``period, kind, n_rows`` (add, replace or delete) against its parent."""
    entry = _published(spark, root, dataset, version)
    side = lambda v, name: version_rows(spark, root, dataset, v).where("period IS NOT NULL").select("period", F.struct("hash", "n_rows").alias(name))
    j = side(version, "new").join(side(entry["parent"], "old"), "period", "full_outer")
    kind = F.when(F.col("old").isNull(), "add").when(F.col("new").isNull(), "delete").when(F.col("old.hash") != F.col("new.hash"), "replace")
    return j.select("period", kind.alias("kind"), F.coalesce("new.n_rows", F.lit(0)).alias("n_rows")).where("kind IS NOT NULL")


def folders(spark: SparkSession, root: str, dataset: Dataset, version: int | str | None = None, periods: list[str] | None = None) -> list[str]:
    """The folders that hold a version's rows, of all or of some periods."""
    rows = version_rows(spark, root, dataset, version).where("period IS NOT NULL")
    rows = rows if periods is None else rows.where(F.col("period").isin(periods))
    return sorted(r["folder"] for r in rows.select("folder").collect())


def read(spark: SparkSession, root: str, dataset: Dataset, version: int | str | None = None, periods: list[str] | None = None) -> DataFrame:
    """The rows of a version, by number or id (by default the current one), of all or of some periods; only their folders are read."""
    found = folders(spark, root, dataset, version, periods)
    if not found:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in dataset.schema.items()))
    return spark.read.option("mergeSchema", "true").parquet(*found)
