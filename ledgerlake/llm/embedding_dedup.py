"""Embedding near-duplicates by an epsilon grid order join.

Vectors of one label are compared by cosine: at cosine >= t unit vectors are at most eps = sqrt(2 - 2t) apart.

1. Copies collapse to one representative (an aggregate that combines before the shuffle).
2. Two rounds of subspace iteration over the unit vectors give the leading principal directions, in memory of some columns
   a component; a vector's grid cell has side eps in those. Rows are range-partitioned and sorted by label and cell: the epsilon grid order.
3. Each run of ``block`` vectors in that order is a sequence interval, stored as one row with the bounding box of
   its projections. Intervals of intervals form a tree. Pairs of intervals are joined from the root
   down; a pair whose boxes are more than eps apart is dropped with everything below it.
4. Neighbouring blocks form tiles of some MB. Surviving pairs of blocks are dealt out by their pair of tiles, so a tile
   travels once for each tile that it meets and not once for each pair of blocks. A pair of blocks is compared by one
   matrix product. A task returns link counts per vector and a spanning forest of its links, never all pairs.
5. Components over the forest, then a join back to the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .scratch import cut, tasks_for
from .simhash import merge_labels

_FANOUT_BITS = 3
#: Bytes of vectors that a tile may hold (or one block), and blocks.
TILE_BYTES, TILE_BLOCKS = 4 << 20, 32


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1, whatever their size: scaled by their largest component first, so that squares stay in range."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch):
    """(dim, row numbers, unit vectors as doubles) for each vector length of a batch with columns dim and v."""
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        yield int(d), at, _unit(_matrix(batch.column("v").take(pa.array(at)), int(d)))


def _times_covariance(reps: DataFrame, width: int, basis: dict[int, np.ndarray] | None) -> dict[int, np.ndarray]:
    """C B by vector length, where C is the covariance of all unit vectors and B a basis of ``width`` columns (none: seeded noise).

    A task keeps, and the driver gets, dim * (width + 1) sums a length, not dim * dim.
    """

    def columns(d: int) -> np.ndarray:
        return np.random.default_rng(d).standard_normal((d, min(d, width))) if basis is None else basis[d]

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for d, _, x in _by_dim(b):
                x1 = np.column_stack([x @ columns(d), np.ones(len(x))])
                total[d] = total.get(d, 0) + np.append((x.T @ x1).ravel(), len(x))
        for d, s in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d, np.int32)), pa.array(np.arange(s.size, dtype=np.int32)), pa.array(s)], ["dim", "cell", "s"])

    got = reps.select("dim", "v").mapInArrow(sums, "dim int, cell int, s double").groupBy("dim", "cell").agg(F.sum("s").alias("s")).toArrow()
    dim, cell, value = (got.column(c).to_numpy() for c in ("dim", "cell", "s"))
    out = {}
    for d in np.unique(dim).tolist():
        own = dim == d
        s = np.zeros(int(own.sum()))
        s[cell[own]] = value[own]
        part, n = s[:-1].reshape(d, -1), s[-1]
        mean = part[:, -1] / n
        out[d] = part[:, :-1] / n - np.outer(mean, mean @ columns(d))
    return out


def _axes(reps: DataFrame, many: int) -> dict[int, np.ndarray]:
    """Leading principal directions by vector length, by two rounds of subspace iteration with some columns to spare.

    They need not be exact: boxes along any orthonormal directions bound distances, better ones prune more.
    """
    basis = {d: np.linalg.qr(y)[0] for d, y in _times_covariance(reps, many + 4, None).items()}
    axes = {}
    for d, y in _times_covariance(reps, many + 4, basis).items():
        t = basis[d].T @ y
        _, vecs = np.linalg.eigh((t + t.T) / 2)
        axes[d] = np.pad(basis[d] @ vecs[:, ::-1][:, :many], ((0, 0), (0, max(0, many - d))))
    return axes


def _blocks(reps: DataFrame, eps: float, block: int, leading: int, n: int) -> DataFrame:
    """Sequence intervals of the grid order: block, label, dim, ids, copies, vectors, low and high corner."""
    axes = _axes(reps, leading)
    cells = [f"c{k}" for k in range(leading)]

    def project(batches):
        for b in batches:
            y = np.zeros((b.num_rows, leading))
            for d, at, x in _by_dim(b):
                y[at] = x @ axes[d]
            grid = np.floor(y / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c) for c in grid.T), pa.array(y.tolist(), pa.list_(pa.float64()))], [*b.schema.names, *cells, "y"])

    base = f"rep long, copies long, label string, dim int, v {dict(reps.dtypes)['v']}"
    order = ["label", "dim", *cells, "rep"]
    placed = reps.select("rep", "copies", "label", "dim", "v").mapInArrow(project, base + "".join(f", {c} int" for c in cells) + ", y array<double>")
    placed = cut(placed, "grid", n).repartitionByRange(tasks_for(reps.sparkSession), *order).sortWithinPartitions(*order)

    def gather(batches):
        from pyspark import TaskContext

        number, held, key = TaskContext.get().partitionId() << 32, [], None

        def out():
            t = pa.Table.from_batches(held).combine_chunks()
            y = _matrix(t.column("y").combine_chunks(), leading)
            v = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)  # float or double, as the rows have it
            row = {"block": number, "label": key[0], "dim": key[1], "ids": t.column("rep").to_pylist(), "copies": t.column("copies").to_pylist(), "v": v.tobytes(), "low": y.min(0).tolist(), "high": y.max(0).tolist()}
            return pa.RecordBatch.from_pylist([row], schema)

        for b in batches:
            label, dim = b.column("label").to_numpy(zero_copy_only=False), b.column("dim").to_numpy()
            ends = np.append(np.flatnonzero((label[1:] != label[:-1]) | (dim[1:] != dim[:-1])) + 1, len(label))
            at = 0
            for end in ends.tolist():
                while at < end:
                    now = (label[at], int(dim[at]))
                    if held and (now != key or sum(h.num_rows for h in held) >= block):
                        yield out()
                        number, held = number + 1, []
                    key = now
                    take = min(end - at, block - sum(h.num_rows for h in held))
                    held.append(b.slice(at, take))
                    at += take
        if held:
            yield out()

    schema = pa.schema([("block", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())), ("v", pa.binary()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))])
    return cut(placed.mapInArrow(gather, "block long, label string, dim int, ids array<long>, copies array<long>, v binary, low array<double>, high array<double>"), "blocks")


def _numbered(blocks: DataFrame, n: int) -> DataFrame:
    """blocks without vectors, with ``node``: 0, 1, ... along each label and length.

    A task's blocks of a label are numbered in a row already, so only the tasks' counts are summed up: one row a task and label.
    """
    rows = blocks.select("label", "dim", "block", "low", "high", F.size("ids").alias("held"), F.shiftright("block", 32).alias("task"))
    rows = cut(rows, "placed", n)
    tasks = rows.groupBy("label", "dim", "task").agg(F.min("block").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("label", "dim").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = tasks.select("label", "dim", "task", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(shift, ["label", "dim", "task"]).select("label", "dim", "block", "low", "high", "held", (F.col("block") + F.col("shift")).cast("int").alias("node"))


def _interval_pairs(leaf: DataFrame, eps: float, leading: int, n: int) -> DataFrame:
    """``label, dim, a, b``: pairs of nodes (a not after b in the order) that the recursive interval join could not part."""
    top = leaf.agg(F.max("node")).first()[0]
    if top is None:
        return leaf.select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    levels = [leaf]
    while top:
        top >>= _FANOUT_BITS
        corners = [F.min(F.col("low")[k]).alias(f"l{k}") for k in range(leading)] + [F.max(F.col("high")[k]).alias(f"h{k}") for k in range(leading)]
        up = levels[-1].groupBy("label", "dim", F.shiftright("node", _FANOUT_BITS).alias("node")).agg(*corners)
        levels.append(cut(up.select("label", "dim", "node", F.array(*[f"l{k}" for k in range(leading)]).alias("low"), F.array(*[f"h{k}" for k in range(leading)]).alias("high")), "level", n))
    gap = lambda k: F.greatest(F.lit(0.0), F.col("b_low")[k] - F.col("a_high")[k], F.col("a_low")[k] - F.col("b_high")[k])
    apart = sum((gap(k) * gap(k) for k in range(leading)), F.lit(0.0))
    pairs = levels[-1].select("label", "dim", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        child = level.select("label", "dim", "node", F.shiftright("node", _FANOUT_BITS).alias("up"), "low", "high")
        side = lambda s: child.select("label", "dim", F.col("up").alias(s), F.col("node").alias(f"{s}_node"), F.col("low").alias(f"{s}_low"), F.col("high").alias(f"{s}_high"))  # noqa: B023, E731
        down = pairs.join(side("a"), ["label", "dim", "a"]).join(side("b"), ["label", "dim", "b"])
        down = down.where((F.col("a_node") <= F.col("b_node")) & (apart <= eps * eps + 1e-9))
        pairs = cut(down.select("label", "dim", F.col("a_node").alias("a"), F.col("b_node").alias("b")), "pairs")
    return pairs


def _compared(blocks: DataFrame, eps: float, leading: int, cosine: float, itemsize: int, tile_bytes: int) -> DataFrame:
    """``a, b, n``: what _compare() finds in all pairs of blocks that the interval join leaves."""
    n = blocks.count()
    leaf = cut(_numbered(blocks, n), "intervals", n)
    pairs = _interval_pairs(leaf.select("label", "dim", "node", "low", "high"), eps, leading, n)
    most = leaf.groupBy("label", "dim").agg(F.max(F.col("held") * F.col("dim") * itemsize).alias("bytes"))
    size = most.select("label", "dim", F.greatest(F.lit(1), F.least(F.lit(TILE_BLOCKS), (tile_bytes / F.col("bytes")).cast("int"))).alias("per"))  # one row a label
    tile = lambda node: F.floor(F.col(node) / F.col("per")).cast("int")
    meets = pairs.join(size, ["label", "dim"]).groupBy("label", "dim", tile("a").alias("ta"), tile("b").alias("tb")).agg(F.collect_list(F.struct("a", "b")).alias("pairs"))  # at most TILE_BLOCKS ** 2
    meets = cut(meets, "tile-pairs")
    where = leaf.join(size, ["label", "dim"]).select("block", "node", tile("node").alias("tile"))
    row = F.struct("node", "ids", "copies", "v")
    tiles = blocks.select("label", "dim", "block", "ids", "copies", "v").join(where, "block").groupBy("label", "dim", "tile").agg(F.collect_list(row).alias("blocks"))  # some MB
    side = lambda s, name: tiles.select("label", "dim", F.col("tile").alias(s), F.col("blocks").alias(name))
    within = meets.where("ta = tb").join(side("ta", "x"), ["label", "dim", "ta"]).select("dim", "pairs", "x", F.lit(None).cast(tiles.schema["blocks"].dataType).alias("y"))
    across = meets.where("ta <> tb").join(side("ta", "x"), ["label", "dim", "ta"]).join(side("tb", "y"), ["label", "dim", "tb"]).select("dim", "pairs", "x", "y")
    return within.unionByName(across).mapInArrow(_compare(cosine, "f4" if itemsize == 4 else "f8"), "a long, b long, n long")


def _compare(cosine: float, kind: str):
    """mapInArrow body: tiles and their pairs of blocks -> rows (a, b, n): forest edges with n 0, link counts of a with b null."""

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                r = {name: c[row] for name, c in zip(batch.schema.names, batch.columns, strict=True)}
                d, found = r["dim"].as_py(), {}
                for block in (*r["x"], *(r["y"] if r["y"].is_valid else ())):
                    ids, copies = (block[c].values.to_numpy() for c in ("ids", "copies"))
                    found[block["node"].as_py()] = ids, copies, _unit(np.frombuffer(block["v"].as_buffer(), kind).astype(np.float64).reshape(-1, d))
                for pair in r["pairs"].as_py():
                    yield pa.RecordBatch.from_arrays(_links(cosine, pair["a"] == pair["b"], *found[pair["a"]], *found[pair["b"]]), ["a", "b", "n"])

    return run


def _links(cosine: float, same: bool, ida, ca, x, idb, cb, y) -> list[pa.Array]:
    near = x @ y.T >= cosine
    if same:
        np.fill_diagonal(near, False)
        ids, counts = ida, near @ cb
        i, j = np.nonzero(np.triu(near))
    else:
        ids, counts = np.concatenate([ida, idb]), np.concatenate([near @ cb, near.T @ ca])
        i, j = np.nonzero(near)
        j = j + len(ida)
    labels = merge_labels(np.arange(len(ids)), i, j)
    linked, some = np.flatnonzero(labels != np.arange(len(ids))), np.flatnonzero(counts)
    a = np.concatenate([ids[linked], ids[some]])
    b = pa.array(np.concatenate([ids[labels[linked]], ids[some]]), mask=np.arange(len(a)) >= len(linked))
    return [pa.array(a), b, pa.array(np.concatenate([np.zeros(len(linked), np.int64), counts[some]]))]


def near_duplicates(rows: DataFrame, cosine: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", block: int = 1024, leading: int = 6, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per row of ``rows``: id, ``n_links, component_id, kept``.

    Rows link when their labels (of any type; compared as text) are equal and not null and the cosine of their vectors,
    in double precision, is at least ``cosine`` (above 0). Components are floats where the column holds floats, else
    doubles. Vectors that are null, zero, or hold null or non-finite components, vectors of another length, and rows
    with a null id link with nothing: n_links 0, component_id the own id. Repeated rows are vectors of their own; rows
    that share an id are one vertex. Other columns are not read.
    """
    eps = math.sqrt(2 - 2 * cosine)
    kind = "float" if dict(rows.dtypes)[vec_col] == "array<float>" else "double"
    v = F.col(vec_col).cast(f"array<{kind}>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    sound = F.coalesce(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & finite, F.lit(False))
    keyed = rows.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"), sound.alias("sound"), *[F.when(sound, F.xxhash64(F.lit(k), v)).alias(f"h{k}") for k in (1, 2)])
    reps = keyed.where("sound").groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
    n = rows.count()
    reps = cut(reps.withColumn("dim", F.size("v")), "vectors", n)
    blocks = _blocks(reps, eps, block, leading, n)
    found = cut(_compared(blocks, eps, leading, cosine, 4 if kind == "float" else 8, tile_bytes), "links")
    comp = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("vertex", "rep")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    told = reps.select("label", "h1", "h2", "rep", "copies").join(counts, "rep", "left").join(comp, "rep", "left")
    told = cut(told.select("label", "h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "told", n)
    out = keyed.select("id", "label", "h1", "h2").join(told, ["label", "h1", "h2"], "left")
    mine = F.coalesce("root", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).alias("n_links"), mine.alias("component_id"), F.col("id").eqNullSafe(mine).alias("kept"))
