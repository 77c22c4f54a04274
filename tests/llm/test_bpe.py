import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlake.llm import bpe, packing, pretokens, token_counts

RANKS = P.path("byte_bpe_50k.tiktoken")
CODEC = bpe.codec_of(open(RANKS, "rb").read())
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(open(RANKS, "rb").read()), special_tokens={})
ALPHABET = st.sampled_from(["'", "'s", "'re", "'ll", "'v", "s", "r", "e", "l", "abc", " ", "  ", "\n", "\t", "1", "!?", "é", "中", "😀", "the", " ", " ", "<|endoftext|>"])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.lists(ALPHABET, max_size=25).map("".join)), max_size=12))
def test_encode_as_the_library(texts):
    e = CODEC.encode(pa.array(texts, pa.string()))
    for k, t in enumerate(texts):
        ids = e.ids[e.docs[k] : e.docs[k + 1]]
        assert ids.tolist() == REFERENCE.encode_ordinary(t or "")
        assert bytes(CODEC.decode(ids)[0]) == (t or "").encode()


def test_long_runs_and_overlapping_pairs():
    texts = ["a" * n for n in range(1, 40)] + [" " * n for n in range(40)] + ["ab" * 500, "x" * 100_000]
    e = CODEC.encode(pa.array(texts))
    for k, t in enumerate(texts[:-1]):
        assert e.ids[e.docs[k] : e.docs[k + 1]].tolist() == REFERENCE.encode_ordinary(t)


def test_transition_functions_compose():
    of_class, compose, apply, _ = pretokens._tables()
    rng = np.random.default_rng(1)
    classes = rng.integers(0, 2 * len(pretokens.CLASSES), 5000)
    scanned = pretokens._scan(of_class[classes])
    state = pretokens.START
    for c, f in zip(classes, scanned, strict=True):
        state = pretokens._step(pretokens.START if c >= len(pretokens.CLASSES) else state, int(c) % len(pretokens.CLASSES))[0]
        assert apply[int(f) << 4 | pretokens.START] == state


def test_round_trip_and_offsets(spark, docs):
    rows = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(docs, RANKS).collect()}
    want = set()
    for r in docs.collect():
        ids = REFERENCE.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert rows == want
    assert bpe.round_trip(docs.limit(0), RANKS).count() == 0
    encoded = bpe.encode(docs, RANKS)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in encoded.collect():
        raw = texts[r.id].encode()
        for a, z, i, j in zip(r.slice_bytes, r.slice_bytes[1:], r.slice_ids, r.slice_ids[1:], strict=False):
            assert b"".join(CODEC.tokens[k] for k in r.ids[i:j]) == raw[a:z]
    assert {r.id: bytes(r.bytes).decode() for r in bpe.decode(encoded, RANKS).collect()} == texts


JSON = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
ADDED = packing.added_tokens(P.path("byte_bpe_50k.json"))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40), st.lists(ALPHABET, max_size=25).map("".join)), max_size=8))
def test_same_ids_as_the_json_vocabulary(texts):
    for x, ids in zip(texts, packing.ids_of(CODEC, pa.array(texts, pa.string()), ADDED), strict=True):
        assert ids.tolist() == JSON.encode(x or "", add_special_tokens=False).ids


def test_packed_ids_hold_the_added_tokens(spark):
    t, end = Tokenizer.from_file(P.path("byte_bpe_50k.json")), "<|endoftext|>"
    texts = [f"one {end} two", end, f"{end}{end} x", f"a{end}", f"  {end}  's", f"<|endof{end}text|>", "<|endoftext|", "plain", None]
    added = packing.added_tokens(P.path("byte_bpe_50k.json"))
    want = {k: t.encode(x or "", add_special_tokens=False).ids for k, x in enumerate(texts)}
    assert {k: x.tolist() for k, x in enumerate(packing.ids_of(CODEC, pa.array(texts), added))} == want
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), RANKS, added=added).collect()
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in rows} == {k: (len(x) + 1, zlib.crc32(np.array([*x, 0], "<u4").tobytes())) for k, x in want.items()}


def check_packing(rows, width):
    """Pieces cover each document without a gap, and fill each sequence without one; returns pieces by document and by sequence."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for found in by_sequence.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= width
    for (_, n), found in by_doc.items():
        first = [p for p in found if p[0] == 0]
        assert sum(length for _, length, _ in found) == n * len(first) and max(a + length for a, length, _ in found) == n
        starts = sorted({p[0] for p in found})
        assert all(sum(p[0] == a for p in found) == len(first) for a in starts)
        assert all({p[0] + p[1] for p in found if p[0] == a} == {z} for a, z in zip(starts, [*starts[1:], n], strict=True))
    return by_doc, by_sequence


def test_packing(spark, docs):
    rows = packing.pack(docs, RANKS, 64).collect()
    by_doc, by_sequence = check_packing(rows, 64)
    want = sorted((str(r.doc_id), [*REFERENCE.encode_ordinary(r.text or ""), 0]) for r in docs.collect())
    assert sorted((str(k), n) for (k, n), found in by_doc.items() for p in found if p[0] == 0) == sorted((k, len(ids)) for k, ids in want)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    pieces = sorted((k, a, crc(ids[a : a + 64])) for k, ids in want for a in range(0, len(ids), 64))
    assert sorted((str(r.doc_id), r.start, r.ids_crc32) for r in rows) == pieces
    used = sum(r.length for r in rows)
    assert used / (64 * len(by_sequence)) > 0.9
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert packing.pack(docs.limit(0), RANKS).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=20))
def test_histogram_places_every_piece_once(counts):
    patterns = packing.pack_histogram(counts, 50)
    placed: dict[int, int] = {}
    for many, lengths in patterns:
        assert sum(lengths) <= 50
        for n in lengths:
            placed[n] = placed.get(n, 0) + many
    assert placed == counts


EDIT = st.fixed_dictionaries({"start": st.integers(0, 80), "length": st.integers(0, 9), "insert": st.lists(ALPHABET, max_size=12).map("".join)})


def leaves_of(text, size):
    e = CODEC.encode(pa.array([text], pa.string()))
    s, z = e.doc_slices.tolist()
    at = np.arange(s, z, size)
    return e.slice_points[at] - e.slice_points[s], token_counts.make_tree(np.diff(np.append(e.slice_ids[at], e.slice_ids[z])))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(ALPHABET, max_size=50).map("".join), st.lists(st.lists(EDIT, max_size=4), min_size=1, max_size=4)), min_size=1, max_size=5))
def test_recount_follows_batch_after_batch_of_edits(cases):
    leaf = 2
    texts = [t for t, _ in cases]
    starts, sums = map(list, zip(*(leaves_of(t, leaf) for t in texts), strict=True))
    for turn in range(max(len(b) for _, b in cases)):
        edits = [token_counts.tidy(b[turn] if turn < len(b) else [], len(t)) for t, (_, b) in zip(texts, cases, strict=True)]
        want = [token_counts.edited(t, x, 0, len(t)) for t, x in zip(texts, edits, strict=True)]
        regions = [token_counts._regions(d, x, s) for d, (x, s) in enumerate(zip(edits, starts, strict=True))]
        token_counts._settle(CODEC, texts, starts, regions, leaf)
        new = [token_counts._renewed(*row) for row in zip(texts, starts, sums, regions, strict=True)]
        texts, starts, sums = map(list, zip(*new, strict=True))
        assert texts == want
        for t, first, tree in zip(texts, starts, sums, strict=True):
            counts = tree[len(tree) // 2 :][: len(first)]
            assert tree[1] == len(REFERENCE.encode_ordinary(t)) == tree[len(tree) // 2 :].sum() == counts.sum()
            whole = CODEC.encode(pa.array([t], pa.string()))
            ids_before = dict(zip(whole.slice_points.tolist(), whole.slice_ids.tolist(), strict=True))  # leaves begin where pre-tokens do
            ends = [*first.tolist(), len(t)]
            assert all(n == ids_before[z] - ids_before[a] for a, z, n in zip(ends, ends[1:], counts.tolist(), strict=False))
            assert (np.diff(ends) >= 0).all() and (not len(first) or first[0] == 0)


def test_recount_query_against_full_counts(spark, docs):
    trees = token_counts.build(docs, RANKS)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    insert = "new words " * 90  # more than a leaf
    edit = lambda at: f"array(struct({at}L AS start, 2L AS length, '{insert}' AS insert), null)"
    put = lambda found, at: {k: t[:at] + insert + t[at + 2 :] for k, t in found.items()}
    count = lambda t: len(REFERENCE.encode_ordinary(t))
    for turn in range(3):
        before, texts = texts, put(texts, 3 + 40 * turn)
        trees = token_counts.recount(trees.selectExpr("id", "text", "starts", "tree", f"{edit(3 + 40 * turn)} AS edits"), "edits", RANKS)
        for r in trees.collect():
            assert r.text == texts[r.id] and r.n_chars_edited == len(r.text)
            assert r.n_tokens == count(before[r.id]) and r.n_tokens_edited == count(r.text) == r.tree[1]
            assert r.n_chars_encoded < 3000 and len(r.starts) <= len(texts[r.id]) / 15 + 40
    before, texts = texts, put(put(texts, 5), 2000)
    batches = trees.selectExpr("id", "text", "starts", "tree", f"{edit(5)} AS one", "null AS none", f"{edit(2000)} AS two")
    for r in token_counts.recount(batches, ["one", "none", "two"], RANKS, state=False).collect():
        assert r.n_tokens == count(before[r.id]) and r.n_tokens_edited == count(texts[r.id]) and r.n_chars_edited == len(texts[r.id])
    none = token_counts.recount(trees.limit(0).selectExpr("id", "text", "starts", "tree", "null AS edits"), "edits", RANKS)
    assert none.count() == 0 and none.columns[-3:] == ["text", "starts", "tree"]


def test_long_texts_in_pieces_are_encoded_alike(monkeypatch):
    """Parts at safe blanks, or the whole: the same ids, slices and places."""
    import random

    import public_tokenizers

    rng = random.Random(6)
    words = ["it's", "we'll", "they'r", "'", "a", "straße", "中文", "😀", "12", "\n", "\n\n", "  ", "\t", "x.", "'s", "\u00a0", "don't", "long" * 9, "\u3000y"]
    texts = ["", None, "short", "no-blank" * 40, "中 " * 50, *("".join(rng.choice(words) + rng.choice([" ", " ", "", "  "]) for _ in range(200)) for _ in range(40))]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        codec = bpe.codec_of(f.read())
    for some in (texts, texts[5:6], texts[:1]):
        whole, parts = codec.encode(pa.array(some, pa.string())), codec.encode(pa.array(some, pa.string()), most=48)
        for name in ("ids", "docs", "slice_bytes", "slice_points", "slice_ids", "doc_slices"):
            assert np.array_equal(getattr(whole, name), getattr(parts, name)), name
    monkeypatch.setattr(bpe, "RUN_BYTES", 48)
    for text in texts:
        one = pa.array([text], pa.string())
        assert bpe._one_digest(codec, one[0]) == bpe._digests(codec, one)[0]
        assert np.array_equal(next(packing.ids_of(codec, one, {})), codec.encode(one).ids)
    raw = np.frombuffer((" a b" * 300).encode(), np.uint8)
    assert all(raw[k] == 32 for k in bpe.safe_ends(raw, 100)) and len(list(bpe.safe_ends(raw, 100))) == 11
