"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import bpe, conversation, embedding_dedup, langid, packing, periodic, quality_classifier, quality_rules, sharding, simhash, token_counts, toxicity, warc
from .scratch import cut


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name):
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


def op2_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def _part(id_col: str, of: int):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def op3_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_part("doc_id", 3) == 1, F.lit(False))
    labels = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "neighbours", "cosines")


def op4_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_langid(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_part("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_quality_rules(spark, sf_dir):
    return quality_rules.counts(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    """Two batches of edits per document, made from its own text, the second on what the first one left: a span near its
    first third gives way to the text's first words and one near its second third is dropped; then its beginning comes
    again in its middle.
    """
    docs = _table(spark, sf_dir, "documents")
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    trees = cut(token_counts.build(docs, ranks), "trees")
    n, h = F.length("text"), F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary"))
    edit = lambda start, length, insert: F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), insert.alias("insert"))
    first = F.array(edit(n / 3 + h % 7, h % 11, F.substring("text", 1, 24)), edit(2 * n / 3, 1 + h % 29, F.lit("")))
    second = F.array(edit(n / 2, h % 5, F.substring("text", 1, 200)))
    told = token_counts.recount(trees.withColumns({"first": first, "second": second}), ["first", "second"], ranks, state=False)
    return told.select(F.col("id").alias("doc_id"), "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded")


def op8_quality_classifier(spark, sf_dir):
    """Grades: 0 low quality, 1 good but toxic, 2 good. Learned where crc32(doc_id as text) mod 5 is not 3."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_part("doc_id", 5) == 3, F.lit(False))
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    ratings = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", grade.alias("grade"))
    told = quality_classifier.score(docs, quality_classifier.fit(docs, ratings, 3), tail=1)
    return told.select("doc_id", held_out.alias("held_out"), "expected_grade", "tail_probability", (F.col("tail_probability") >= 0.5).alias("selected"))


def op9_packing(spark, sf_dir):
    """The json file holds these ranks and added tokens; tests hold the ids against its library."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), added=packing.added_tokens(vocabulary("byte_bpe_50k.json")))


def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def damaged(turns):
    """The turns of op11 as a faulty export leaves them, ``n`` copies of each: some gone, emptied, without their stops, twice or of another role."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(h == 1, "").when(h == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    return turns.select("conv_id", "turn", F.when(h == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"), F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("n"))


def op11_conversation_repair(spark, sf_dir):
    return conversation.repair(damaged(_table(spark, sf_dir, "conversations")), copies=F.col("n"))


def op12_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"), 40)


def op13_periodic_runs(spark, sf_dir):
    return periodic.find(_table(spark, sf_dir, "documents"), damage=periodic.planted)


def quality_rule_counts(spark, sf_dir):
    """The counts of op6_quality_rules without the verdict, which SQL cannot say."""
    return op6_quality_rules(spark, sf_dir).drop("kept")


#: CRC-32 in SQL: its table of 256 entries from the polynomial, and the checksum of a list of bytes by it.
CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))"""


def crc_sql(data: str) -> str:
    return f"xor(list_reduce([4294967295] || {data}, lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295)"


def _repair_sql() -> str:
    """The edit program turn by turn: the cheapest (cost, audit, lines) of each state of the pattern."""
    far = "{'c': 1000000000, 'a': '', 't': ''}"
    put = lambda x, cost, letter, line: f"{{'c': {x}.c + {cost}, 'a': {x}.a || '{letter}', 't': {x}.t || {line}}}"
    line = lambda role: f"chr(10) || {role} || ':'"
    user, helper = line("'user'"), line("'assistant'")
    ins = lambda x: put(x, 5, "I", user)
    both = lambda x: put(x, 10, "II", f"{user} || {helper}")
    least = lambda *xs: f"list_min([{', '.join(xs)}])"
    only = lambda when, x: f"CASE WHEN {when} THEN {x} ELSE {far} END"
    drop = lambda x: put(x, 2, "D", "''")
    keep = lambda x, initial: only(f"NOT must AND initial = '{initial}'", put(x, "late", "K", f"{line('role')} || text"))
    other = lambda x, role: only("NOT must", put(x, "late + 1", "R", f"{line(role)} || text"))
    return f"""
        WITH RECURSIVE {CRC_TABLE},
        key AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT)) AS b FROM conversations),
        hit AS (SELECT *, {crc_sql('b')} % 20 AS h FROM key, crc_table),
        row0 AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hit WHERE h <> 0),
        row1 AS (SELECT *, row_number() OVER w AS i, lag(role) OVER w AS prior FROM row0 WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
        row2 AS (SELECT *, left(role, 1) AS initial, i = min(i) OVER (PARTITION BY conv_id, role, text) AS fresh FROM row1),
        row3 AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN NOT fresh THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' END AS fault FROM row2),
        turns AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), FALSE) AS must, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS late FROM row3),
        go AS (
            SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS e, {far} AS s, {far} AS u, {far} AS a FROM (SELECT DISTINCT conv_id FROM conversations)
            UNION ALL
            SELECT conv_id, i, {drop('e')}, {least(drop('s'), keep('e', 's'))},
                {least(drop('u'), *[keep(x, 'u') for x in 'esa'], *[other(x, "'user'") for x in 'esa'])},
                {least(drop('a'), keep('u', 'a'), other('u', "'assistant'"))}
            FROM (SELECT t.conv_id, t.i, must, late, initial, role, text, e, s, {least('u', ins('e'), ins('s'), ins('a'))} AS u, {least('a', put('u', 5, 'I', helper), both('e'), both('s'))} AS a
                FROM go JOIN turns t ON t.conv_id IS NOT DISTINCT FROM go.conv_id AND t.i = go.i + 1)
        ),
        last AS (SELECT conv_id, {least('e', 'a', put('u', 5, 'I', helper), both('s'))} AS r FROM go QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
        told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (left(prior, 1) || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id)
        SELECT last.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
            CAST(r.c AS BIGINT) AS cost, r.a AS audit, sha256(substr(r.t, 2)) AS repaired_sha256
        FROM last LEFT JOIN told ON told.conv_id IS NOT DISTINCT FROM last.conv_id"""


QUERIES = {"quality_rule_counts": quality_rule_counts, "op1_bpe": op1_bpe, "op2_warc": op2_warc, "op3_toxicity": op3_toxicity, "op4_embedding_dedup": op4_embedding_dedup, "op5_langid": op5_langid, "op6_quality_rules": op6_quality_rules, "op7_token_counts": op7_token_counts, "op8_quality_classifier": op8_quality_classifier, "op9_packing": op9_packing, "op10_simhash": op10_simhash, "op11_conversation_repair": op11_conversation_repair, "op12_sharding": op12_sharding, "op13_periodic_runs": op13_periodic_runs}
ORACLES: dict[str, str] = {
    "op2_warc": """
        WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        told AS (SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM page),
        seen AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM told),
        kind AS (SELECT *, payload_bytes >= 100 AND page_id <> first_id AS again FROM seen)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN again THEN first_id END AS refers_to
        FROM kind""",
    "quality_rule_counts": r"""
        WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        word AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM doc),
        place AS (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM word),
        triple AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS times FROM place),
        cover AS (SELECT r, count(DISTINCT i + k) AS n FROM triple CROSS JOIN (VALUES (0), (1), (2)) step(k) WHERE times > 1 GROUP BY r),
        line AS (SELECT r, unnest(string_split(t, chr(10))) AS s FROM doc),
        again AS (SELECT r, count(*) - count(DISTINCT s) AS n FROM line WHERE regexp_matches(s, '[^\x20\x09-\x0D]') GROUP BY r)
        SELECT doc_id, len(w) AS n_words, length(list_aggregate(w, 'string_agg', '')) AS word_chars,
            length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(again.n, 0) AS n_dup_lines,
            coalesce(cover.n, 0) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(cover.n, 0) > 50 * len(w) AS base_failed
        FROM word LEFT JOIN cover USING (r) LEFT JOIN again USING (r)""",
    "op4_embedding_dedup": """
        WITH RECURSIVE vec AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
        sound AS (
            SELECT * FROM vec
            WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(v, lambda x: x <> 0)) > 0
        ),
        link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.93
        ),
        reach AS (SELECT vec_id, vec_id AS root FROM vec UNION SELECT reach.vec_id, link.b FROM reach JOIN link ON link.a = reach.root),
        low AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
        many AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
        SELECT low.vec_id, coalesce(n_links, 0) AS n_links, component_id, low.vec_id = component_id AS kept
        FROM low LEFT JOIN many ON many.a = low.vec_id""",
    "op11_conversation_repair": _repair_sql(),
    "op12_sharding": f"""
        WITH RECURSIVE {CRC_TABLE},
        doc AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS HUGEINT) AS k FROM documents),
        told AS (SELECT r, doc_id, octet_length(b) + 16 AS size, {crc_sql("list_transform(regexp_extract_all(hex(b), '..'), lambda x: CAST('0x' || x AS BIGINT))")} AS text_crc32 FROM doc, crc_table),
        walk AS (
            SELECT r, k, CAST(-1 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS onward FROM doc
            UNION ALL
            SELECT r, k, onward, CAST(floor((onward + 1) * (2147483648::DOUBLE / CAST((k >> 33) + 1 AS DOUBLE))) AS BIGINT)
            FROM (SELECT r, onward, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k FROM walk WHERE onward < 40)
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INT) AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
            CAST(CASE WHEN onward = 40 THEN 40 ELSE shard END AS INT) AS grown_shard
        FROM told JOIN walk USING (r) WHERE onward >= 40""",
}
