"""Conversation repair, sharding and periodic runs against plain versions, SQL and odd rows."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import conversation, periodic, queries, sharding, suffixtree

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name, table", [("op11_conversation_repair", "conversations"), ("op12_sharding", "documents")])
def test_against_its_sql(spark, name, table):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    told, got = con.sql(queries.ORACLES[name]), queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(told.columns)
    assert sorted(map(str, map(tuple, got.select(*told.columns).collect()))) == sorted(map(str, told.fetchall()))


def faults(turns):
    seen, out = set(), []
    for role, text in turns:
        solid = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def all_edits(turns, most=2):
    """Every edit sequence with at most ``most`` insertions in a row: the least (cost, audit, lines)."""
    told, best = faults(turns), None
    gaps = [list(range(most + 1))] * (len(turns) + 1)
    for acts in itertools.product("KRD", repeat=len(turns)):
        if any(f in ("blank", "duplicate") and a != "D" for a, f in zip(acts, told, strict=True)):
            continue
        for inserted in itertools.product(*gaps):
            audit, lines, cost, initials = "", [], 0, ""
            for k in range(len(turns) + 1):
                for _ in range(inserted[k]):
                    role = "assistant" if initials.endswith("u") else "user"
                    audit, cost, initials = audit + "I", cost + 5, initials + role[0]
                    lines.append(f"{role}:")
                if k < len(turns):
                    role, text = turns[k]
                    audit += acts[k]
                    cost += {"K": 0, "R": 1, "D": 2}[acts[k]] + 5 * (told[k] == "truncated" and acts[k] != "D")
                    if acts[k] == "R":
                        role = "assistant" if initials.endswith("u") else "user"
                    if acts[k] != "D":
                        initials += role[:1] or "?"
                        lines.append(f"{role}:{text}")
            if re.fullmatch("(s?(ua)+)?", initials):
                best = min(best or (cost, audit, lines), (cost, audit, lines))
    return best


def test_edits_against_all_sequences(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for conv in range(60):
        turns = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["Fine.", "And then", "", "So what?", " \n", "Yes! "])) for _ in range(rng.randint(0, 4))]
        rows += [(conv, 2 * k, *t, 1) for k, t in enumerate(turns)] or [(conv, 0, "user", "x", 0)]
        want[conv] = (turns, all_edits(turns))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int")
    got = {r.conv_id: r for r in conversation.repair(frame, copies=F.col("n")).collect()}
    left = defaultdict(list)
    for r in conversation.repaired(frame, copies=F.col("n")).orderBy("conv_id", "turn").collect():
        left[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, (turns, (cost, audit, lines)) in want.items():
        r = got[conv]
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert left[conv] == lines
        n = Counter(faults(turns))
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        assert (r.blank, r.duplicate, r.truncated, r.illegal) == (n["blank"], n["duplicate"], n["truncated"], illegal)
        assert r.gaps == max(0, len(turns) - 1)


def turn_by_turn(turns):
    """The edit program by one step a turn, without runs or powers."""
    best, told = {0: (0, "")}, faults(turns)

    def inserted(states):
        states = dict(states)
        for _ in range(2):
            for q, (c, a) in list(states.items()):
                to = conversation.FOLLOWS[q]
                states[to] = min(states.get(to, (1 << 60, "")), (c + 5, a + "I"))
        return states

    for (role, _), fault in zip(turns, told, strict=True):
        after = {}
        for q, (c, a) in inserted(best).items():
            late, kind = 5 * (fault == "truncated"), {"s": 1, "u": 2, "a": 3}.get(role[:1])
            moves = [(q, c + 2, "D")]
            if fault not in ("blank", "duplicate"):
                moves.append((conversation.FOLLOWS[q], c + 1 + late, "R"))
                if (kind == 1 and q == 0) or (kind in (2, 3) and conversation.FOLLOWS[q] == kind):
                    moves.append((kind, c + late, "K"))
            for to, cost, letter in moves:
                after[to] = min(after.get(to, (1 << 60, "")), (cost, a + letter))
        best = after
    last = inserted(best)
    return min(last[q] for q in (0, 3) if q in last)


def test_long_conversation_in_pieces(spark, monkeypatch):
    """Thousands of turns of one conversation, parted among tasks and cut into pieces, come to what one pass gives."""
    rng = random.Random(9)
    kinds = [("system", "Go."), *[("user", f"u{k}.") for k in range(3000)], *[("assistant", f"a{k}" + "." * (k % 3 > 0)) for k in range(3000)]]
    turns = [kinds[0]] + [rng.choice(kinds[1:]) for _ in range(2500)] + [("user", "Same.")] * 700 + kinds[1:120]
    want = turn_by_turn(turns)
    monkeypatch.setattr(conversation, "PIECE_TURNS", 64)
    rows = [(7, k, r, t) for k, (r, t) in enumerate(turns)] + [(8, None, "user", "Hi."), (8, None, "assistant", "Hi."), (None, 3, None, None), (None, 3, None, None), (9, 5, "user", "Hello?"), (9, 9, "assistant", "Yes.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"id": F.lit("x"), "n": F.lit(4), "phase": F.lit(True)})
    got = {r.conv_id: r for r in conversation.repair(frame).collect()}
    assert (got[7].cost, got[7].audit) == want and got[7].gaps == 0
    told = Counter(faults(turns))
    assert (got[7].blank, got[7].duplicate, got[7].truncated) == (told["blank"], told["duplicate"], told["truncated"])
    assert got[7].illegal == sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
    # by role where there is no number; repeated null rows are blank; a gap of three
    assert (got[8].audit, got[8].cost, got[8].gaps) == ("RR", 2, 0)
    assert (got[None].blank, got[None].duplicate, got[None].audit, got[None].cost) == (2, 0, "DD", 4)
    assert (got[9].gaps, got[9].audit, got[9].cost) == (3, "KK", 0)
    assert conversation.repair(frame.limit(0)).count() == 0 and conversation.repaired(frame.limit(0)).count() == 0


def test_powers_of_runs():
    """A run advanced by powers of two costs what its turns cost one by one; a million equal turns are unrolled whole."""
    for symbol, n in itertools.product(range(9), (1, 2, 3, 7, 20)):
        togo = conversation.END
        for _ in range(n):
            togo = conversation.before_run(symbol, 1, togo)
        assert conversation.before_run(symbol, n, conversation.END) == togo
        for q in range(4):
            letters, state = conversation.unroll([(symbol, n)], q, conversation.END)
            end, cost = conversation.ended(state)
            spent = sum({"K": 5 * (symbol > 4), "R": 1 + 5 * (symbol > 4), "D": 2, "I": 5}[c] for c in letters)
            assert spent + cost == togo[q] and len(letters.replace("I", "")) == n
    assert conversation.unroll([(2, 1), (0, 1_000_000), (3, 1)], 0, conversation.END)[0] == "K" + "D" * 1_000_000 + "K"


def published_jump(key, n):
    """Jump consistent hashing as it was published."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_shards_against_the_published_function(spark, docs):
    got = sharding.shard(docs, 7).collect()
    assert len(got) == docs.count()
    key = lambda d: int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16)
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == texts
    slots = defaultdict(list)
    for r in got:
        assert (r.shard, r.grown_shard) == (published_jump(key(r.doc_id), 7), published_jump(key(r.doc_id), 8))
        slots[r.shard].append((r.slot, -1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32))
    for s in slots.values():
        assert [x[0] for x in sorted(s)] == list(range(len(s))) and [x[1:] for x in sorted(s)] == sorted(x[1:] for x in s)
    assert sharding.shard(docs.limit(0), 7).count() == 0
    ids = spark.range(3000).select(F.col("id").alias("key"))
    walked = {n: {r.key: r.s for r in ids.select("key", sharding.jump(sharding.stable_key(F.col("key")), n)["shard"].alias("s")).collect()} for n in (1, 2, 40, 41, 300)}
    for n, found in walked.items():
        assert all(found[k] == published_jump(key(k), n) for k in range(3000))
    moved = [k for k in range(3000) if walked[40][k] != walked[41][k]]
    assert 30 < len(moved) < 130 and all(walked[41][k] == 40 for k in moved)


def test_a_hot_id_and_many_tasks(spark):
    """A third of all rows under one id and text: slots stay gapless over the partitions that they are spread to."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text")).repartition(6)
    got = sharding.shard(rows, 3)
    told = got.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("z"), F.min("slot").alias("a")).collect()
    assert all(r.n == r.d == r.z + 1 and r.a == 0 for r in told) and sum(r.n for r in told) == 6000


def all_runs(w):
    """Maximal repetitions by definition: each period's maximal stretches, those of a smaller period aside."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            if i - s >= q:
                found.setdefault((s, i + q), q)  # the smallest period comes first
            i += i == s
    return sorted((s, e, q) for (s, e), q in found.items())


def test_runs_against_their_definition():
    rng = random.Random(1)
    for _ in range(400):
        w = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 40))]
        assert list(map(tuple, periodic.runs_of(w).tolist())) == all_runs(w)
    for _ in range(100):
        w = []
        for _ in range(rng.randint(1, 6)):
            root = [b"%d" % rng.randint(0, rng.choice([2, 5, 50])) for _ in range(rng.randint(1, 8))]
            w += (root * rng.randint(1, 6))[: rng.randint(1, 30)]
        assert list(map(tuple, periodic.runs(w).tolist())) == [(s, e - s, q) for s, e, q in all_runs(w) if e - s >= max(12, 2 * q)]


def test_suffix_tree_orders_and_extends():
    rng = random.Random(4)
    for n in (1, 2, 17, 300, 900):
        w = [rng.randint(1, 3) for _ in range(n)]
        tree = suffixtree.SuffixTree(w)
        tour, depth = tree.tour()
        leaves = {int(v): k for k, v in enumerate(tree.leaf)}
        assert [leaves[v] for v in tour.tolist() if v in leaves] == sorted(range(n + 1), key=lambda k: [*w[k:], 0])
        falling = [leaves[v] for v in tree.tour(falling=True)[0].tolist() if v in leaves]
        assert falling == sorted(range(n + 1), key=lambda k: [*(4 - x for x in w[k:]), 0])
        lce = suffixtree.Extensions(tree, tour, depth)
        pairs = [(i, j) for i, j in ((rng.randint(0, n), rng.randint(0, n)) for _ in range(200)) if i != j]
        plain = lambda i, j: next((k for k in range(n) if i + k >= n or j + k >= n or w[i + k] != w[j + k]), n)
        if pairs:
            i, j = map(list, zip(*pairs, strict=True))
            assert lce(periodic.np.array(i), periodic.np.array(j)).tolist() == [plain(*p) for p in pairs]


def plain_report(words):
    found = [(s, e - s, q) for s, e, q in all_runs(words) if e - s >= max(12, 2 * q)]
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return (len(found), *top, 1000 * top[1] // top[2] if found else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(" ".join(w for k, w in enumerate(words) if k not in gone).encode()).hexdigest())


def test_periodic_query_against_plain_version(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000").select("doc_id", "text")
    odd = docs.where("length(text) < 4000 OR text IS NULL").select("doc_id", "text")
    more = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(["a " * 11, "a " * 12, "x y " * 13, "a b\x0bc\x1cd " * 6, ("p q r s t u v " * 2).strip(), "b " * 5 + "a " * 30 + "b " * 9])], "doc_id long, text string")
    rows = rows.unionByName(odd).unionByName(more)
    want, damaged = [], 0
    for r in rows.collect():
        words = WORD.findall(r.text or "")
        h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            damaged += 1
        want.append((r.doc_id, *plain_report(words)))
    got = periodic.find(rows.withColumns({"key": F.lit(1), "n_runs": F.lit("x")}), damage=periodic.planted)
    assert damaged > 10 and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert any(w[1] > 1 for w in want)
    assert periodic.find(rows.limit(0)).count() == 0


def test_long_periodic_texts(spark):
    """Texts of very many words: all equal, a long root three times, and without any repetition."""
    root = [f"r{k}" for k in range(20_000)]
    rows = [(1, "w " * 60_000), (2, " ".join(root * 3)), (3, " ".join(f"z{k}" for k in range(200_000)))]
    got = {r.doc_id: r for r in periodic.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period, got[1].exponent_milli) == (1, 0, 60_000, 1, 60_000_000)
    assert (got[2].n_runs, got[2].length, got[2].period) == (1, 60_000, 20_000) and got[3].n_runs == 0
    assert got[1].collapsed_sha256 == hashlib.sha256(b"w").hexdigest() and got[2].collapsed_sha256 == hashlib.sha256(" ".join(root).encode()).hexdigest()
