import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import embedding_dedup, graph, queries, simhash, textvec

from .conftest import SF


def classes(n, pairs):
    label = list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in pairs:
        a, b = find(i), find(j)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(spark, docs):
    got = sorted((r.id, r.fp & (1 << 64) - 1) for r in simhash.fingerprints(docs.where("doc_id IS NOT NULL")).collect())
    assert got == sorted((r.doc_id, plain_fingerprint(r.text)) for r in docs.where("doc_id IS NOT NULL").collect())


def test_near_duplicates(spark, docs):
    rows = simhash.near_duplicates(docs).collect()
    texts = docs.collect()
    assert len(rows) == len(texts)
    fp = [plain_fingerprint(r.text) for r in texts]
    own = classes(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 4])
    low = {c: min((r.doc_id for r, o in zip(texts, own, strict=True) if o == c and r.doc_id is not None), default=None) for c in own}
    want = sorted((str(r.doc_id), f"{f:016x}", str(low[o])) for r, f, o in zip(texts, fp, own, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in rows) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_lose_nothing_in_any_scheme(spark):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = {int(c) for c in centres}
    for c in centres.tolist():
        for _ in range(20):  # random walks of few bits: chains that only links hold together
            for b in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                c ^= 1 << b
            fps.add(c)
    fps = sorted(fps)
    own = classes(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4])
    want = sorted(np.unique(own, return_counts=True)[1].tolist())
    reps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    for scheme in range(len(simhash.SCHEMES)):
        comp = graph.components(simhash.links(reps, chunk=8, scheme=scheme)).groupBy("root").count().collect()
        sizes = sorted([r["count"] for r in comp] + [1] * (len(fps) - sum(r["count"] for r in comp)))
        assert sizes == want


def test_a_hot_bucket_is_copied_a_few_times_only(spark):
    """Rows of one key go to one group up to CHUNK of them; beyond it each row meets every chunk, and every pair of rows some group."""
    rows = spark.range(20_000).select(F.lit(0).alias("band"), F.lit(1).alias("key"), F.col("id").alias("fp"))
    dealt = simhash._dealt(rows, ["band", "key"], "fp", simhash.CHUNK)
    assert dealt.count() == 60_000
    few = rows.where("fp < 60")
    dealt = simhash._dealt(few, ["band", "key"], "fp", 16).groupBy("c", "d").agg(F.collect_set("fp").alias("fps")).collect()
    met = {(a, b) for r in dealt for a in r.fps for b in r.fps}
    assert len(met) == 60 * 60 and len(dealt) > 1


def test_counters_hold_exact_distances():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fp[1::2] = fp[::2] ^ np.array([(1 << int(k)) - 1 for k in rng.integers(0, 9, 150)], np.uint64)
    group = np.repeat([0, 1], [130, 170])
    for radius in (0, 1, 3, 4, 6, 8, 30):
        got = {(int(i), int(j)) for a, b in simhash.sliced_links(group, fp, radius, slab=50) for i, j in zip(a, b, strict=True)}
        assert got == {(i, j) for i in range(300) for j in range(i + 1, 300) if group[i] == group[j] and bin(int(fp[i] ^ fp[j])).count("1") <= radius}
        wide = np.stack([fp, fp ^ np.uint64(5)], axis=1)  # every distance twice
        assert {(int(i), int(j)) for a, b in simhash.sliced_links(group, wide, 2 * radius) for i, j in zip(a, b, strict=True)} == got


def plain_shingles(text, width=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()


def edited_documents(spark):
    """Documents of the tables and copies of some with words changed: similarities on both sides of 0.8."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rng = random.Random(5)
    made = []
    for r in docs.where(F.size(F.split("text", " ")) >= 50).orderBy("doc_id").limit(60).collect():
        words = r.text.split(" ")
        for k, share in enumerate((0.01, 0.02, 0.03, 0.05)):
            made.append((10_000 * (k + 1) + r.doc_id, " ".join(f"edit{rng.random()}" if rng.random() < share else w for w in words)))
    hot = made[0][1].split(" ")
    made += [(90_000 + k, " ".join([*hot[:k], "x", *hot[k + 1 :]])) for k in range(min(150, len(hot)))]  # one large group
    return docs.unionByName(spark.createDataFrame(made, docs.schema))


@pytest.mark.parametrize("chunk", [7, 512])
def test_similar_against_all_pairs(spark, docs, chunk):
    rows = edited_documents(spark).unionByName(docs.select("doc_id", "text"))
    texts = rows.collect()
    sets = [plain_shingles(r.text) for r in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] == sets[j] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]) > 0]
    own = classes(len(sets), links)
    low = {c: min((r.doc_id for r, o in zip(texts, own, strict=True) if o == c and r.doc_id is not None), default=None) for c in own}
    got = simhash.similar(rows, chunk=chunk, exact_chunk=chunk).collect()
    assert len(links) > 500
    assert sorted(str((r.id, r.component_id)) for r in got) == sorted(str((r.doc_id, low[o])) for r, o in zip(texts, own, strict=True))


def test_keep_first_of_odd_rows(spark, docs):
    rows = docs.withColumnRenamed("fp", "id").withColumnRenamed("component_id", "set")
    kept = simhash.keep_first(rows)
    assert kept.columns == rows.columns
    # 3 and 8 are as empty as 2; 6 is as 5, twice; 10 and the row without id share 19 of 21 shingles with 5
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "4", "5", "9"]
    clash = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "A b c  d e f g"), (1, "quite another text"), (2, "quite another text"), (0, "a b c d e f g")], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_first(clash).collect())) == [(0, "a b c d e f g"), (1, "quite another text")]
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_majority_bits():
    rng = np.random.default_rng(9)
    size = [0, 1, 2, 3, 255, 256, 700, 0, 20_000, 5]
    doc = np.repeat(np.arange(len(size)), size)
    h = rng.integers(0, 1 << 63, len(doc), dtype=np.uint64)
    got = simhash.majority(doc, h, len(size), 2)
    words = [textvec.mixed((h + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (1 << 64) - 1)) for k in range(2)]
    bits = np.concatenate([np.unpackbits(w.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") for w in words], axis=1)
    for k, n in enumerate(size):
        assert (got[k] == (2 * bits[doc == k].sum(0, np.int64) > n)).all()
    again = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    assert abs(simhash.majority(np.arange(5000), again, 5000, 3).mean() - 0.5) < 0.01


def test_shingles_of_odd_texts():
    texts = ["", None, "one", "One TWO", "a b c d e", "a b c d e f", "b c d e f g", "a  b\tc\nd e", "x" * 100_000, "é ß 中 d e f"]
    doc, h = textvec.shingles(pa.array(texts), 5)
    sets = [set(h[doc == k].tolist()) for k in range(len(texts))]
    assert [len(s) for s in sets] == [len(plain_shingles(t)) for t in texts]
    assert sets[4] == sets[7] and len(sets[5] & sets[6]) == 1 and sets[4] < sets[5]


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 50), (100, 101), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.vertex: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 50, 50: 50, 101: 50, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vector_rows():
    rng = np.random.default_rng(11)
    v = rng.normal(size=(60, 8))
    v = np.concatenate([v, v[:40] + 0.15 * rng.normal(size=(40, 8)), v[:10], v[:10]]).astype(np.float32)
    rows = [(k, [float(x) for x in r], k % 3 if k % 17 else None, "x") for k, r in enumerate(v)]
    return [*rows, (500, None, 1, "x"), (501, [0.0] * 8, 1, "x"), (502, [float("nan")] * 8, 1, "x"), (503, [1.0, None] + [0.0] * 6, 1, "x"), (504, [1.0, 2.0], 1, "x"), (505, [2.0, 4.0], 1, "x"), (None, [1.0] * 8, 1, "x"), (506, [], 1, "x")]


@pytest.mark.parametrize("kind, tile_bytes", [("float", 64), ("float", embedding_dedup.TILE_BYTES), ("double", 500)])
def test_embedding_join_against_all_pairs(spark, kind, tile_bytes):
    rows = vector_rows()
    if kind == "double":  # beyond the range of floats, and whose squares are beyond that of doubles
        rows += [(600 + k, [float(x) for x in v], 1, "x") for k, v in enumerate([(1e-60, 0), (1e-60, 1e-70), (1e200, 1e190), (3e200, 0), (1e-200, 1e-200), (2e-300, 2e-300)])]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int, n_links string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame, 0.93, block=4, leading=3, tile_bytes=tile_bytes).collect()}

    def sound(r):
        return r[0] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])

    def linked(a, b):
        if not (sound(a) and sound(b)) or a[2] != b[2] or len(a[1]) != len(b[1]):
            return False
        x, y = (np.array(v, np.float32 if kind == "float" else np.float64).astype(np.longdouble) for v in (a[1], b[1]))
        return x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93

    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and linked(rows[i], rows[j])]
    own = classes(len(rows), [(max(p), min(p)) for p in pairs])
    for i, r in enumerate(rows):
        assert got[r[0]] == (sum(p[0] == i for p in pairs), rows[own[i]][0], rows[own[i]][0] == r[0])
    assert len(pairs) > 50
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_blocks_are_numbered_along_each_label(spark):
    """Numbers without gaps in the order of the blocks, whatever tasks hold them, and no window over the blocks themselves."""
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for task in range(12):
        number = task << 32
        for label, dim in ((("a", 8),) if task < 4 else (("a", 8), ("b", 4), ("b", 8)) if task == 4 else (("b", 8),)):
            for _ in range(int(rng.integers(1, 5))):
                want.setdefault((label, dim), []).append(number)
                rows.append((number, label, dim, [1, 2], [0.0], [1.0]))
                number += 1
    blocks = spark.createDataFrame(rows, "block long, label string, dim int, ids array<long>, low array<double>, high array<double>").repartition(5)
    got = {(r.label, r.dim, r.block): (r.node, r.held) for r in embedding_dedup._numbered(blocks, len(rows)).collect()}
    assert got == {(*k, b): (n, 2) for k, v in want.items() for n, b in enumerate(v)}


def test_labels_of_any_type(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [1.0, 2.1], "a"), (3, [1.0, 2.0], "b"), (4, [1.0, 2.0], None)]
    for kind, label in (("string", str), ("double", lambda x: {"a": 1.5, "b": 1.0}[x])):
        frame = spark.createDataFrame([(k, v, None if x is None else label(x)) for k, v, x in rows], f"vec_id int, embedding array<double>, label {kind}")
        assert {r.vec_id: r.component_id for r in embedding_dedup.near_duplicates(frame).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_query_against_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    told, got = con.sql(queries.ORACLES["op4_embedding_dedup"]), queries.op4_embedding_dedup(spark, SF)
    assert got.columns == told.columns and sorted(map(tuple, got.collect())) == sorted(told.fetchall())


def test_principal_directions_by_subspace_iteration(spark):
    """Nearly the variance of the exact leading directions, orthonormal, from sums of some columns a component."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 48)) * (0.7 ** np.arange(48))
    x = (x @ np.linalg.qr(rng.normal(size=(48, 48)))[0]) + 0.3
    rows = spark.createDataFrame([(48, v.tolist()) for v in x] + [(3, [1.0, 0.0, float(k)]) for k in range(5)], "dim int, v array<double>")
    axes = embedding_dedup._axes(rows, 6)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    exact = np.sort(np.linalg.eigvalsh(np.cov(unit.T, bias=True)))[::-1][:6].sum()
    assert np.allclose(axes[48].T @ axes[48], np.eye(6), atol=1e-9)
    assert np.var(unit @ axes[48], axis=0).sum() > 0.97 * exact
    assert axes[3].shape == (3, 6) and (axes[3][:, 3:] == 0).all()
