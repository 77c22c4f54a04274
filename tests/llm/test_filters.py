import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import langid, quality_classifier, quality_rules, queries, toxicity

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    n = Counter(windows)
    cover = {k + d for k, x in enumerate(windows) if n[x] > 1 for d in range(3)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover), len(w) < 50 or 100 * len(cover) > 50 * len(w)


def test_rule_counts(spark, docs):
    odd = [("a a a a a", 101), ("x y z q x y z", 102), ("l1\nl1\n \nl1 \nl2\nl2", 103), ("<a> #b | c\x0bd\x0ce", 104), (" ".join(f"w{k % 90} v{k % 45}" for k in range(200)), 105), ("a b c a b c a b", 106)]
    more = spark.createDataFrame(odd, "text string, doc_id long").selectExpr("doc_id", "text", "'en' AS lang", "'a' AS source")
    rows = docs.select("doc_id", "text", "lang", "source").unionByName(more)
    for few in (24, 0):  # both ways to find windows that repeat
        quality_rules.FEW = few
        got = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in quality_rules.counts(rows).collect())
        assert got == sorted(str((r.doc_id, *plain_counts(r.text))) for r in rows.collect())
    quality_rules.FEW = 24
    assert quality_rules.counts(rows.limit(0)).count() == 0
    assert quality_rules.keep(docs).columns == docs.columns


def test_verdicts_against_exact_quantiles(spark):
    """Every document that lies clear of its fence, by exact quantiles of its group, language and the corpus; no floor is needed."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured = quality_rules.cut(quality_rules.measures(docs), "measured")
    m = F.col("_m")
    cols = [F.col("_m.c.n_words").alias("words"), F.col("_m.c.word_chars").alias("chars"), F.col("_m.n_symbols").alias("symbols"), F.col("_m.n_marks").alias("marks"), F.col("_m.n_dup_lines").alias("dup_lines"), F.col("_m.c.n_spread_words").alias("spread_words")]
    table = measured.select("doc_id", "lang", "source", quality_rules.base_failed(m).alias("failed"), *cols).toPandas()
    kept = {r.doc_id: r.kept for r in quality_rules.counts(docs).collect()}
    live = table[table.words > 0]
    quantile = lambda rows, q: np.quantile(rows, q, method="inverted_cdf")
    clear, fences = 0, set()
    for row in table.to_dict("records"):
        group, lang = live[(live.lang == row["lang"]) & (live.source == row["source"])], live[live.lang == row["lang"]]
        want, sure = not row["failed"], True
        for c in ("symbols", "marks", "dup_lines", "spread_words", "chars"):
            value = (lambda d, c=c: d.chars / d.words) if c == "chars" else (lambda d, c=c: np.log((d[c] + 1) / (d.words + 1)))
            blend = lambda q, v=value: (len(group) * quantile(v(group), q) + 50 * (len(lang) * quantile(v(lang), q) + 50 * quantile(v(live), q)) / (len(lang) + 50)) / (len(group) + 50)  # noqa: B023, E731
            mid, spread = blend(0.5), blend(0.5) - blend(0.1)
            assert spread > 0.1
            reach = spread * (6 if c == "chars" else 2)
            fences.add((c, round(mid + reach, 6)))
            if row["words"]:
                x = row["chars"] / row["words"] if c == "chars" else math.log((row[c] - 1) / row["words"]) if row[c] > 1 else -math.inf
                want &= x <= mid + reach and (c != "chars" or x >= mid - reach)
                sure &= abs(x - mid - reach) > 0.1 * reach and (c != "chars" or abs(x - mid + reach) > 0.1 * reach)
        if sure or row["failed"]:
            clear += 1
            assert kept[row["doc_id"]] == want
    assert clear > 0.95 * len(table) and 0 < sum(kept.values()) < len(kept) and len(fences) > 100


def test_two_sources_get_two_thresholds(spark):
    """What is usual in a source of code is an outlier in one of prose, and the other way round for long words."""
    rng = np.random.default_rng(7)
    prose = lambda k: " ".join([*(f"{'abcdefg'[j % 7]}w{k}x{j}" for j in range(int(rng.integers(60, 300))))])
    code = lambda k: " ".join(f"v{k}_{j} <{j}>" if rng.random() < 0.4 else f"v{k}_{j}" for j in range(int(rng.integers(60, 300))))
    rows = [(k, code(k) if k % 2 else prose(k), "en", "code" if k % 2 else "prose") for k in range(600)]
    docs = spark.createDataFrame([*rows, (1000, code(1000), "en", "prose"), (1001, code(1001), "en", "code"), (1002, code(1002), None, None)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_rules.counts(docs).collect()}
    assert not got[1000] and got[1001] and sum(got[k] for k in range(600)) > 590
    fence = {(r.lang, r.source): r for r in quality_rules.fences(quality_rules.cut(quality_rules.measures(docs), "measured")).collect()}
    assert math.exp(fence["en", "code"].symbols_high) > 5 * math.exp(fence["en", "prose"].symbols_high)


def test_clashing_names(spark, docs):
    rows = docs.withColumnsRenamed({"fp": "_m", "component_id": "_f", "score": "_kept"})
    assert quality_rules.keep(rows).columns == rows.columns and quality_rules.counts(rows).count() == rows.count()


def test_counts_against_their_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    told, got = con.sql(queries.ORACLES["quality_rule_counts"]), queries.quality_rule_counts(spark, SF)
    assert got.columns == told.columns and sorted(map(tuple, got.collect())) == sorted(told.fetchall())


def test_rules_part_low_from_good(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    told = quality_rules.counts(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    share = {r.quality: r.kept for r in told.collect()}
    assert share[1] > 0.97 and share.get(0, 0) < 0.1


def test_spread_repetition_goes_and_one_passage_stays(spark):
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(100)), "en", "a") for k in range(300)]
    word = iter(f"v{j}" for j in range(1000))
    phrases = [f"p{k} q{k} r{k}" for k in range(8)]
    spread = " ".join(f"{p} {next(word)} {next(word)} {next(word)} {next(word)}" for _ in range(2) for p in phrases)  # 48 of 112 words, in scattered windows
    buys = " ".join(["buy it now"] * 15 + [f"u{j}" for j in range(60)])  # 45 of 105, in one run
    passage = " ".join([*(f"s{j}" for j in range(22)), *(f"t{j}" for j in range(60)), *(f"s{j}" for j in range(22))])  # 44 of 104
    docs = spark.createDataFrame([*rows, (1000, spread, "en", "a"), (1001, buys, "en", "a"), (1002, passage, "en", "a")], "doc_id long, text string, lang string, source string")
    for few in (24, 0):
        quality_rules.FEW = few
        got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.counts(docs).where("doc_id >= 1000").collect()}
        assert got == {1000: (False, False), 1001: (False, False), 1002: (False, True)}
    quality_rules.FEW = 24


def dense_cosines(texts, labels, queries, leave=False):
    """TF-IDF cosines of all queries to all examples by dictionaries of whole words, those that no example holds included.

    leave: the queries are the examples, each weighed without its own count and label.
    """
    count = lambda t: Counter(w for w in re.findall(r"[^\W_]+", (t or "").lower()))
    bags, n, toxic = [count(t) for t in texts], len(texts), sum(labels)
    df = Counter(w for b in bags for w in b)
    both = Counter(w for b, y in zip(bags, labels, strict=True) if y for w in b)

    def weight(w, y=None):
        less = y is not None
        a, d, m, t = both[w] - (y or 0), df[w] - less, n - less, toxic - (y or 0)
        ratio = max(a - 2, 0) * max(m - t, 1) / max(t, 1) / max(d - a, 1)
        return (math.log((1 + m) / (1 + d)) + 1) * math.log2(2 + ratio) ** 1.5

    norm = lambda v: math.sqrt(sum(x * x for x in v.values())) or 1.0
    known = [{w: (1 + math.log(m)) * weight(w) for w, m in b.items()} for b in bags]
    out = np.zeros((len(queries), n))
    for i, t in enumerate(queries):
        y = labels[i] if leave else None
        q = {w: (1 + math.log(m)) * weight(w, y) for w, m in count(t).items()}
        for j, e in enumerate(known):
            out[i, j] = min(1.0, sum(x * e[w] * (weight(w, y) / weight(w) if leave else 1) for w, x in q.items() if w in e) / norm(q) / norm(e))
    return out


def test_unknown_words_count_in_a_texts_length():
    """A word that stands alone is nearer to an example than the same word among five hundred others."""
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice([f"w{k}" for k in range(80)], 10)) + (" vile" if k % 3 == 0 else "") for k in range(60)]
    doc, term, tf = toxicity.terms(pa.array(texts))
    model = toxicity.Scorer(doc, term, tf, np.array([int(k % 3 == 0) for k in range(60)]), pa.array(range(60)), 0.3)
    _, _, cosine = model.score(pa.array(["vile", "vile " + " ".join(f"unknown{k}" for k in range(500)), "unknown alone"]))
    assert cosine[0, 0] > 0.3 and 0 < cosine[1, 0] < 0.25 * cosine[0, 0] and (cosine[2] == 0).all()


def test_neighbours_and_scores_against_dense_cosines(spark, docs):
    corpus = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(corpus, labels)
    text = {r.doc_id: r.text for r in corpus.collect()}
    own = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    ids = model.ids.to_pylist()
    assert sorted(ids) == sorted(k for k in own if k in text) and [own[k] for k in ids] == model.labels.tolist()
    rows = docs.where("doc_id IN (1, 2, 3, 4, 9)").select("doc_id", "text").unionByName(corpus.where("doc_id < 40").selectExpr("doc_id + 1000 AS doc_id", "text")).collect()
    cosines = dense_cosines([text[k] for k in ids], [own[k] for k in ids], [r.text for r in rows])
    votes = dense_cosines([text[k] for k in ids], [own[k] for k in ids], [text[k] for k in ids], leave=True)
    np.fill_diagonal(votes, -1)
    y, share = np.array([own[k] for k in ids], float), sum(own[k] for k in ids) / len(ids)

    def vote(row):
        top = np.argsort(-row, kind="stable")[: model.k]
        w = np.maximum(row[top], 0) ** 2
        return (w @ y[top] + 1e-4 * share) / (w.sum() + 1e-4)

    slope, cut = toxicity.logistic(np.array([vote(v) for v in votes]), y, np.ones(len(y)))
    assert np.allclose([slope, cut], [model.slope, model.intercept], rtol=1e-6)
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows), model, evidence=model.k).collect()}
    for r, row in zip(rows, cosines, strict=True):
        want = np.sort(row[row > 0])[::-1][: model.k]
        assert np.allclose(got[r.doc_id].cosines, want, atol=1e-9)
        assert np.allclose([row[ids.index(k)] for k in got[r.doc_id].neighbours], got[r.doc_id].cosines, atol=1e-9)
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-(slope * vote(row) + cut)))) < 1e-6


def test_block_products_and_postings_agree(monkeypatch):
    rng = np.random.default_rng(5)
    vocabulary = [f"word{k}" for k in range(60)] + ["vile", "foul"]
    texts = [" ".join(rng.choice(vocabulary[:60], 12)) + (" vile foul" * int(k % 3 + 1) if k % 4 == 0 else "") for k in range(300)]
    texts[7] = texts[8]  # a tie
    found = []
    for most in (0, 60, 10_000):  # all terms in blocks, some, none
        monkeypatch.setattr(toxicity, "FREQUENT", most)
        doc, term, tf = toxicity.terms(pa.array(texts))
        model = toxicity.Scorer(doc, term, tf, np.array([int(k % 4 == 0) for k in range(300)]), pa.array(range(300)), 0.25)
        found.append(model.score(pa.array([*texts, "", None, "nothing known"])))
    for score, _, cosine in found[1:]:
        assert np.allclose(score, found[0][0]) and np.allclose(cosine, found[0][2])
    assert np.allclose(found[0][2][:300, 0], 1) and (found[0][2][300:] == 0).all()


def test_whole_words_count():
    long = ["a" * 30 + "bad", "a" * 30 + "god", "一二三四五六七八九十" * 4 + "坏", "x" + "一二三四五六七八九十" * 4]
    doc, term, _ = toxicity.terms(pa.array([*long, *long]))
    sets = [set(term[doc == k].tolist()) for k in range(8)]
    assert sets[:4] == sets[4:] and sets[0] != sets[1] and len(sets[2] & sets[3]) >= 10


def test_toxicity_held_out(spark, docs):
    rng = np.random.default_rng(2)
    common, vile = [f"plain{k}" for k in range(300)], ["zukar", "zukel", "zukom", "brakk"]
    rows = [(k, " ".join([*rng.choice(common, 80), *(rng.choice(vile, 3) if k % 5 == 0 else [])]), int(k % 5 == 0)) for k in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    odd_labels = spark.createDataFrame([(1, None), (10_000, 1), (None, 1), (2, 1), (2, 0), (3, 0), (3, 0), (4, 7)], "doc_id long, toxic int")
    again = frame.unionByName(frame.where("doc_id = 6")).unionByName(frame.where("doc_id = 6"))
    model = toxicity.fit(again, frame.where("doc_id < 400").select("doc_id", "toxic").unionByName(odd_labels))
    assert sorted(model.ids.to_pylist()) == [k for k in range(400) if k != 2]  # labelled both ways: left out; repeated rows: once
    got = toxicity.score(frame, model).join(frame.select("doc_id", "toxic"), "doc_id").where("doc_id >= 400").collect()
    assert sum((r.score >= 0.7) == r.toxic for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 and len(r.neighbours) == len(r.cosines) == 3 for r in got)
    odd = toxicity.score(docs, model)
    assert odd.count() == docs.count() and odd.where("score IS NULL OR score >= 0.7").count() == 0
    assert toxicity.keep(docs, model).columns == docs.columns and toxicity.keep(docs.limit(0), model).count() == 0
    nothing = toxicity.fit(frame, frame.limit(0).select("doc_id", "toxic"))
    assert toxicity.score(docs, nothing).count() == docs.count()
    named = frame.selectExpr("concat('d', doc_id) AS doc_id", "text", "toxic")
    model = toxicity.fit(named, named.select("doc_id", "toxic"), examples=50)
    assert len(model.labels) == 100
    assert all(n.startswith("d") for r in toxicity.score(named.limit(20), model).collect() for n in r.neighbours)


def test_language_held_out(spark, docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(rows.where("doc_id % 4 <> 2"))
    got = langid.identify(rows.where("doc_id % 4 = 2"), model).join(rows.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert {odd[k] for k in (2, 3, 8)} == {"und"} and odd[1] != "und"
    assert langid.identify(docs.limit(0), model).count() == 0
    empty = langid.fit(rows.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}


def plain_grams(text):
    """Hashed n-gram counts of one text, character by character."""
    points = [ord(c) if c.isalpha() else 0 for c in (text or "").lower()]
    out, mask = Counter(), (1 << 64) - 1
    for k in range(1, 4):
        for at in range(len(points) - k + 1):
            part = points[at : at + k]
            if any(part):
                h = 0
                for j, p in enumerate(part):
                    h = (h + p + j + 1) * 0x9E3779B97F4A7C15 & mask
                h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask
                out[(h ^ h >> 27) >> 52] += 1
    return out


def test_languages_against_plain_nearest_centroids(spark, docs):
    corpus = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(corpus)
    bags = [plain_grams(r.text) for r in corpus.where("lang IS NOT NULL AND text IS NOT NULL").collect()]
    df = Counter(b for bag in bags for b in bag)
    idf = [math.log((1 + len(bags)) / (1 + df[b])) + 1 for b in range(langid.DIMS)]
    assert np.allclose(model.idf, idf)
    rows = corpus.select("doc_id", "text").limit(60).unionByName(docs.select("doc_id", "text").where("doc_id IN (1, 2, 3, 8, 9)").selectExpr("doc_id + 100000 AS doc_id", "text")).collect()
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows), model).collect()}
    for r in rows:
        v = {b: math.log1p(n) * idf[b] for b, n in plain_grams(r.text).items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        near = [sum(x * float(c[b]) for b, x in v.items()) / norm for c in model.centroids]
        best = int(np.argmax(near))
        letter = any(c.isalpha() for c in r.text or "")
        assert abs(got[r.doc_id].score - (near[best] if letter else 0)) < 1e-4
        ties = {model.langs[k] for k in range(len(near)) if near[k] > near[best] - 1e-5}
        assert got[r.doc_id].lang_pred in (ties if letter else {"und"})
        assert got[r.doc_id].rejected == (not letter or near[best] < model.floor[best]) or abs(near[best] - model.floor[best]) < 1e-4


def test_small_clusters_stay_unless_they_are_anothers(spark):
    e = np.eye(6, dtype=np.float32)
    near = (e[3] + 0.1 * e[5]) / np.linalg.norm(e[3] + 0.1 * e[5])
    c = np.stack([e[0], (e[0] + e[1]) / 2**0.5, e[2], near, e[3]])  # a: main, kin, another script, texts of b under a's name; b: main
    stay = langid.sound_clusters(["a", "a", "a", "a", "b"], c, np.full(5, 0.5), np.array([0.9, 0.04, 0.03, 0.03, 1.0]), 0.08)
    assert stay.tolist() == [0, 1, 2, 4]
    assert len(langid.sound_clusters(["a", "a", "a", "a", "b"], c, np.full(5, 0.5), np.array([0.9, 0.04, 0.03, 0.03, 1.0]), 0.0)) == 5
    rows = spark.createDataFrame([(1, "wort und satz", "de")] * 500 + [(2, "word and text", "en"), (3, "words or texts", "en")], "doc_id long, text string, lang string")
    got = langid.identify(rows.distinct(), langid.fit(rows)).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "de", 2: "en", 3: "en"}


def test_kmeans_and_grams():
    counts, letters = langid.grams(pa.array(["ab", None, "12 !", "aB"]))
    assert letters.tolist() == [True, False, False, True] and counts[0].sum() == 3 and (counts[0] == counts[3]).all() and not counts[1:3].any()
    x = np.eye(4, dtype=np.float32)[[0, 0, 1, 1, 2]]
    assert len(langid.spherical_kmeans(x, 3)) == 3


def test_ordinal_regression_orders_grades(spark, docs):
    rng = np.random.default_rng(4)
    words = [["bad###", "junk$$$"], ["fair", "fine"], ["great", "splendid"]]
    rows = [(k, " ".join(rng.choice(words[k % 3] + ["the", "of", "and"], 60)), k % 3) for k in range(450)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    model = quality_classifier.fit(frame, frame.where("doc_id < 300").select("doc_id", "grade"), 3, examples=80)
    assert (np.diff(model.thresholds) > 0).all()
    got = quality_classifier.score(frame.where("doc_id >= 300"), model).join(frame.select("doc_id", "grade"), "doc_id").collect()
    assert sum(round(r.expected_grade) == r.grade for r in got) / len(got) > 0.9
    assert sum((r.tail_probability > 0.5) == (r.grade == 2) for r in got) / len(got) > 0.9
    assert quality_classifier.score(docs, model).where("expected_grade BETWEEN 0 AND 2").count() == docs.count()
    assert quality_classifier.score(docs.limit(0), model).count() == 0
    blank = quality_classifier.score(docs.where("text IS NULL OR trim(text) = ''"), model).collect()
    assert blank and all(r.expected_grade == r.tail_probability == 0 for r in blank)
    nothing = quality_classifier.fit(frame, frame.limit(0).select("doc_id", "grade"), 3)
    assert quality_classifier.score(docs, nothing).count() == docs.count()


def test_gradient_and_likelihood_of_cumulative_link():
    rng = np.random.default_rng(8)
    rows = [np.unique(rng.integers(0, 20, 6)) for _ in range(90)]
    grade = np.array([int(r.mean() > 8) + int(r.mean() > 11) for r in rows])
    doc, at = np.repeat(np.arange(90), [len(r) for r in rows]), np.concatenate(rows)
    val = rng.uniform(0.5, 1.5, len(at))
    theta = np.zeros(quality_classifier.DIMS + 2)
    theta[:20], theta[-2:] = rng.normal(size=20), (-0.4, 0.3)
    ridge = 0.01

    def plain(theta):  # the likelihood, document by document
        cuts, total = [theta[-2], theta[-2] + math.exp(theta[-1])], 0.0
        for d in range(90):
            score = sum(v * theta[k] for k, v, o in zip(at, val, doc, strict=True) if o == d)
            above = [1.0, *(1 / (1 + math.exp(c - score)) for c in cuts), 0.0]
            total -= math.log(above[grade[d]] - above[grade[d] + 1]) / (grade == grade[d]).sum() / 3
        return total + ridge * float(theta[:-2] @ theta[:-2]) / 2

    value, gradient = quality_classifier.loss(theta, doc, at, val, grade, 3, ridge)
    assert abs(value - plain(theta)) < 1e-9
    for k in (0, 7, 19, 500, len(theta) - 2, len(theta) - 1):
        step = np.zeros_like(theta)
        step[k] = 1e-5
        assert abs((plain(theta + step) - plain(theta - step)) / 2e-5 - gradient[k]) < 1e-6
    model = quality_classifier.fit_ordinal(rows, [np.ones(len(r), np.float32) for r in rows], grade, 3)
    score = np.array([model.weights[r].sum() for r in rows])
    assert np.corrcoef(score, grade)[0, 1] > 0.8
    above = quality_classifier.Model(model.weights, model.thresholds).above(pa.array(["some text", None]))
    assert above[0, 0] > above[0, 1] and (above[1] == 0).all()


def test_ratings_of_repeated_and_contradicted_ids(spark, monkeypatch):
    frame = spark.createDataFrame([(k, f"text {k} " * 5) for k in range(30)] + [(3, "text 3 " * 5)] * 40 + [(4, "another")], "doc_id long, text string")
    ratings = spark.createDataFrame([(k, k % 3) for k in range(30)] + [(5, 2), (5, 1), (None, 1), (6, None), (7, 9), (99, 1)], "doc_id long, grade int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit_ordinal", lambda rows, cols, grade, grades: seen.append((len(rows), grade.tolist())))
    quality_classifier.fit(frame, ratings, 3)
    assert seen == [(29, [0] * 10 + [1] * 10 + [2] * 9)]  # 5 is rated in two ways


@pytest.mark.parametrize("text", ["", None, "x" * 50_000, "1 2 3"])
def test_features_of_odd_texts(text):
    assert np.isfinite(quality_classifier.features(pa.array([text], pa.string()))).all()


def test_grams_of_long_texts_in_pieces():
    texts = ["", "a", "Ein Satz, noch einer; 中文 und mehr! " * 30, "x" * 500, "12 34 " * 50]
    for text in texts:
        whole, letter = langid.grams(pa.array([text]))
        for most in (1, 2, 3, 7, 100):
            got, found = langid.grams(pa.array([text]), most)
            assert np.array_equal(got, whole) and np.array_equal(found, letter)
