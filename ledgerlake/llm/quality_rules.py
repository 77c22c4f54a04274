"""Quality rules with adaptive thresholds, in DataFrame operations only.

Each document gets word, symbol, line and repetition counts. Fixed base rules reject documents that are
too short or too repetitive. Beyond them there are no fixed cutoffs: per language and source the measures
go into quantile sketches (KLL). Sketches of salted shares of a group are merged into the group's, those of
the groups into their language's, and those into the corpus's. A measure is rejected beyond a fence that lies some times the lower spread
(median less lower decile) from the median: junk lies above and moves neither much. Counts are sketched as logarithms of their
rates, one more of count and words each, so that a group whose documents mostly have none still has a spread: how sure its documents are of
having none. A document is held against its fence with one occurrence less, the benefit of the doubt. Median and decile of a group
are drawn towards its language's, and those towards the corpus's, by the weight of ``prior`` documents. The rate
of repeated words leaves out one passage that a text holds twice.
Fences are joined back by a key of few distinct values and applied as a filter or a verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import cut, fresh

#: The base rules' bounds, and the characters that count as symbols.
MIN_WORDS, REPEAT_PERCENT, SYMBOLS = 50, 50, "#*$%&|<>"
#: Windows that occur twice, up to which a scan for each is quicker than a sort; either gives the same.
FEW = 24
#: measure -> (how many lower spreads its fences lie from the median, whether it is a logarithm of a rate)
MEASURES = {"symbols": (2.0, True), "marks": (2.0, True), "dup_lines": (2.0, True), "spread_words": (2.0, True), "chars_per_word": (6.0, False)}
#: A spread of less counts as this much: documents of one length without any occurrence have none.
LEAST_SPREAD = 0.01


def _let(value: Column, body) -> Column:
    """body(value) with value computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without(text: Column, chars: str) -> Column:
    for ch in chars:
        text = F.replace(text, F.lit(ch), F.lit(""))
    return text


def _repeat_words(words: Column) -> Column:
    """Struct ``n``: words inside windows of three words that occur at least twice; ``spread``: those without one passage held twice.

    Windows are compared by a 64-bit hash of their three words. Sorted hashes show which occur twice; where
    those are few, every window is held against them, else hashes are sorted with their places. Either
    way the starts of such windows, in order, cover min(3, distance to the next start) words each. The passage is the
    longest run of such starts; it and its copy are taken off unless a window occurs twice within the run itself.
    """
    n = F.greatest(F.size(words) - 2, F.lit(0))
    hashed = F.zip_with(
        F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b)),
        F.slice(words, 3, n),
        lambda ab, c: F.xxhash64(ab, c),
    )

    def among(windows: Column, twice: Column) -> Column:
        return F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())

    def by_place(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twin = lambda s, x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        twins = _let(placed, lambda s: F.filter(s, lambda x, k: twin(s, x, k - 1) | twin(s, x, k + 1)))
        return F.sort_array(F.transform(twins, lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        reach = F.transform(starts, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(starts, k + 1) - x, F.lit(3))))
        return F.aggregate(reach, F.lit(0), lambda a, b: a + b)

    def told(windows: Column, starts: Column) -> Column:
        def step(run: Column, x: Column) -> Column:
            n = F.when(x == run["last"] + 1, run["n"] + 1).otherwise(F.lit(1))
            longer = n > run["best"]
            return F.struct(x.alias("last"), n.alias("n"), F.when(longer, n).otherwise(run["best"]).alias("best"), F.when(longer, x - n + 1).otherwise(run["at"]).alias("at"))

        none = F.struct(F.lit(-2).alias("last"), F.lit(0).alias("n"), F.lit(0).alias("best"), F.lit(0).alias("at"))
        passage = _let(F.aggregate(starts, none, step), lambda run: F.when(F.size(F.array_distinct(F.slice(windows, run["at"] + 1, run["best"]))) == run["best"], 2 * (run["best"] + 2)).otherwise(F.lit(0)))
        return _let(covered(starts), lambda n: F.struct(n.alias("n"), F.greatest(n - passage, F.lit(0)).alias("spread")))

    def of(windows: Column) -> Column:
        equal_next = _let(F.sort_array(windows), lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k + 1) == x, F.lit(False))))
        return _let(
            F.array_distinct(equal_next),
            lambda twice: F.when(F.size(twice) == 0, F.struct(F.lit(0).alias("n"), F.lit(0).alias("spread")))
            .when(F.size(twice) <= FEW, _let(among(windows, twice), lambda s: told(windows, s)))
            .otherwise(_let(by_place(windows), lambda s: told(windows, s))),
        )

    return _let(hashed, of)


def measures(docs: DataFrame, text_col: str = "text", name: str = "_m") -> DataFrame:
    """docs plus one struct column of counts for the whole text (null: no words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w).alias("r"),
        ),
    )
    counts = _let(counts, lambda c: F.struct(c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"), c["r"]["n"].cast("long").alias("n_repeat_words"), c["r"]["spread"].cast("long").alias("n_spread_words")))
    dup = _let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s)))
    symbols = F.octet_length(text) - F.octet_length(_without(text, SYMBOLS))
    marks = F.octet_length(text) - F.octet_length(_without(text, "!?"))
    return docs.withColumn(
        name,
        F.struct(counts.alias("c"), symbols.cast("long").alias("n_symbols"), dup.cast("long").alias("n_dup_lines"), marks.cast("long").alias("n_marks")),
    )


def _counted(m: Column) -> dict[str, Column]:
    c = m["c"]
    return {"symbols": m["n_symbols"], "marks": m["n_marks"], "dup_lines": m["n_dup_lines"], "spread_words": c["n_spread_words"]}


def sketched(m: Column) -> dict[str, Column]:
    """What of a document goes into its group's sketches."""
    words = m["c"]["n_words"]
    return {r: F.log((n + 1) / (words + 1)) for r, n in _counted(m).items()} | {"chars_per_word": F.try_divide(m["c"]["word_chars"], words)}


def judged(m: Column) -> dict[str, Column]:
    """What of a document is held against the fences; null where nothing speaks against it."""
    words = m["c"]["n_words"]
    return {r: F.when(n > 1, F.log((n - 1) / words)) for r, n in _counted(m).items()} | {"chars_per_word": F.try_divide(m["c"]["word_chars"], words)}


def base_failed(m: Column) -> Column:
    c = m["c"]
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])


def fences(measured: DataFrame, lang_col: str = "lang", source_col: str = "source", k: int = 1024, prior: int = 50, salts: int = 16, name: str = "_m") -> DataFrame:
    """``lang, source`` and per measure ``<measure>_low, <measure>_high``: one row per language and source seen.

    Documents without a word are not sketched. Null languages and sources are groups like any other.
    """
    own = sketched(F.col(name))
    rows = measured.where(F.col(name)["c"]["n_words"] > 0).select(
        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.pmod(F.xxhash64(name), F.lit(salts)).alias("salt"), *[e.cast("double").alias(r) for r, e in own.items()]
    )
    salted = rows.groupBy("lang", "source", "salt").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(r, k).alias(r) for r in own])
    groups = cut(salted.groupBy("lang", "source").agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(r, k).alias(r) for r in own]), "sketches")
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), *[F.kll_merge_agg_double(r, k).alias(f"lang_{r}") for r in own])
    whole = groups.agg(*[F.kll_merge_agg_double(r, k).alias(f"all_{r}") for r in own])
    one = groups.join(langs, groups["lang"].eqNullSafe(langs["lang"])).drop(langs["lang"]).join(F.broadcast(whole))  # one row
    drawn = lambda n, x, towards: (n * x + prior * towards) / (n + prior)

    def quantile(r: str, q: float) -> Column:
        group, lang, corpus = (F.kll_sketch_get_quantile_double(F.col(f"{level}{r}"), F.lit(q)) for level in ("", "lang_", "all_"))
        return drawn(F.col("n"), group, drawn(F.col("lang_n"), lang, corpus))

    out = []
    for r, (reach, rate) in MEASURES.items():
        mid = quantile(r, 0.5)
        spread = reach * F.greatest(mid - quantile(r, 0.1), F.lit(LEAST_SPREAD))
        out += [(mid + spread).alias(f"{r}_high"), (F.lit(float("-inf")) if rate else mid - spread).alias(f"{r}_low")]
    return cut(one.select("lang", "source", *out), "fences")


def judge(measured: DataFrame, lang_col: str = "lang", source_col: str = "source", name: str = "_m", **how) -> tuple[DataFrame, Column, Column]:
    """Rows of measures() beside their group's fences, and two conditions on them: whether the base rules fail, and the verdict.

    A document is kept if it passes the base rules and every measure lies within its group's fences. Null and empty texts have
    no words and fail the base rules. measured must be stored: it is read twice, for the sketches and for the verdict.
    """
    mark = fresh(measured, "_f")
    fence = fences(measured, lang_col, source_col, name=name, **how).select(F.struct("*").alias(mark))
    f, m = F.col(mark), F.col(name)
    joined = measured.join(fence, F.col(lang_col).eqNullSafe(f["lang"]) & F.col(source_col).eqNullSafe(f["source"]), "left")
    inside = F.lit(True)
    for r, e in judged(m).items():
        inside &= F.coalesce((e >= f[f"{r}_low"]) & (e <= f[f"{r}_high"]), F.lit(True))
    failed = base_failed(m)
    return joined, failed, ~failed & inside


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **how) -> DataFrame:
    """One row per document: id, ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Rows repeat as given; only counts are stored, not texts. Other columns are not read, so names may clash.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    measured = cut(measures(rows).drop("text"), "measured")
    told, failed, kept = judge(measured, **how)
    m = F.col("_m")
    c = m["c"]
    return told.select(F.col("id").alias(id_col), c["n_words"].alias("n_words"), c["word_chars"].alias("word_chars"), m["n_symbols"].alias("n_symbols"), m["n_dup_lines"].alias("n_dup_lines"), c["n_repeat_words"].alias("n_repeat_words"), failed.alias("base_failed"), kept.alias("kept"))


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs, whatever their names."""
    name = fresh(docs, "_m")
    told, _, kept = judge(cut(measures(docs, text_col, name), "measured"), lang_col, source_col, name, **how)
    return told.where(kept).select(*docs.columns)
