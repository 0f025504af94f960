"""Queries of the llm operators: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandlake.llm import chat_format, exact_dedup, license_scan, lm_scoring, mixing, ngram_join, packing, pii, prefix_trie, quality_rules, spelling, suffix_dedup, url_filter
from demandlake.llm.tables import read


def op1_ngram_join(spark, sf_dir):
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op2_url_filter(spark, sf_dir):
    return url_filter.judge(read(spark, sf_dir, "pages"))


def op3_license_scan(spark, sf_dir):
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"))


def op5_pii(spark, sf_dir):
    return pii.find(read(spark, sf_dir, "documents"))


def op6_lm_scoring(spark, sf_dir):
    return lm_scoring.score(read(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_best_fit_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_source_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_chat_format(spark, sf_dir):
    conv = read(spark, sf_dir, "conversations")
    # the query's own conversation -1, full of control strings
    own = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    own = own.withColumn("turn", F.col("turn").cast(conv.schema["turn"].dataType))
    pieces = chat_format.format_conversations(conv.select("conv_id", "turn", "role", "text").unionByName(own))
    return chat_format.digests(pieces)


QUERIES = {f.__name__: f for f in (
    op1_ngram_join, op2_url_filter, op3_license_scan, op4_suffix_dedup, op5_pii, op6_lm_scoring, op7_quality_rules, op8_best_fit_packing,
    op9_source_mixing, op10_exact_dedup, op11_spelling_variants, op12_prefix_trie, op13_chat_format,
)}

_STEP = "xor(x >> 1, (x & 1) * 3988292384)"


def _crc32(text: str) -> str:
    """Unsigned crc32 of a string's UTF-8 bytes, bit by bit."""
    byte = f"CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT)"
    bits = f"list_reduce(list_concat([xor(h, k)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: {_STEP})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(strlen({text})), lambda i: {byte})), lambda h, k: {bits}), 4294967295)"


_TEMPLATE = chat_format.TEMPLATE


def _escaped_length(text: str) -> str:
    marks = " + ".join(f"(length({text}) - length(replace({text}, '{m}', ''))) // {len(m)}" for m in ("\\", *_TEMPLATE.marks))
    return f"(length({text}) + {marks})"


_MARKS = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, a, b in _TEMPLATE.roles)

ORACLES = {
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS n FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, CAST(g.n AS BIGINT) AS group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
        FROM d JOIN g ON d.t = g.t
    """,
    "op11_spelling_variants": f"""
        WITH RECURSIVE docs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        runs AS (SELECT id, unnest(regexp_extract_all(t, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM docs),
        counted AS (SELECT run, id || ':' || run AS tag, count(*) AS k FROM runs GROUP BY ALL),
        hashed AS (SELECT run, k, {_crc32("tag")} AS h FROM counted),
        words AS (
          SELECT CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n
          FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3),
        cuts AS (SELECT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
        near AS (
          SELECT DISTINCT a.word, b.word AS near FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND length(a.word) = length(b.word) AND a.word <> b.word
          UNION SELECT c.word, w.word FROM cuts c JOIN words w ON c.rest = w.word
          UNION SELECT w.word, c.word FROM cuts c JOIN words w ON c.rest = w.word),
        best AS (
          SELECT r.word, count(*) AS n_near, max(w.n) AS m, arg_min(r.near, (-w.n, encode(r.near))) AS near
          FROM near r JOIN words w ON r.near = w.word GROUP BY r.word),
        judged AS (
          SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 2 * w.n THEN b.near END AS form, CASE WHEN b.m >= 2 * w.n THEN b.m END AS form_n
          FROM words w LEFT JOIN best b USING (word)),
        walk AS (
          SELECT word, word AS at, form AS next FROM judged
          UNION ALL SELECT k.word, k.next, j.form FROM walk k JOIN judged j ON k.next = j.word)
        SELECT j.word, j.form, k.at AS root, j.n, j.n_near, j.form_n FROM judged j JOIN walk k ON j.word = k.word WHERE k.next IS NULL
    """,
    "op12_prefix_trie": f"""
        WITH raw AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        marked AS (SELECT conv_id, turn, role, md5(length(role) || ':' || role || text) AS digest, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM raw),
        t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, digest) AS p FROM marked),
        convs AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
        rebuilt AS (
          SELECT v.conv_id, 0 AS part, t.p, t.digest, t.words FROM convs v JOIN t ON t.conv_id = v.base AND t.p <= v.h
          UNION ALL SELECT v.conv_id, 1, t.p, t.digest, t.words FROM convs v JOIN t ON t.conv_id = v.conv_id AND t.p > v.h),
        seqs AS (
          SELECT v.conv_id, coalesce(list(r.digest ORDER BY r.part, r.p) FILTER (r.digest IS NOT NULL), []) AS seq,
                 coalesce(list(r.words ORDER BY r.part, r.p) FILTER (r.digest IS NOT NULL), []) AS words
          FROM convs v LEFT JOIN rebuilt r ON v.conv_id = r.conv_id GROUP BY v.conv_id),
        members AS (SELECT conv_id, seq, words, unnest(range(len(seq) + 1)) AS depth FROM seqs),
        nodes AS (
          SELECT seq[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(words[depth]), 0) AS w,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = len(seq)), '')) AS ends_sha256
          FROM members GROUP BY ALL),
        kids AS (SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
        own AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.prefix = k.prefix),
        up AS (SELECT prefix, unnest(range(depth + 1)) AS d, CAST(n_children = 0 AS BIGINT) AS leaf, (n_convs - 1) * w AS saved FROM own),
        sums AS (SELECT prefix[1:d] AS prefix, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY ALL)
        SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, s.n_leaves, s.saved_tokens, o.ends_sha256
        FROM own o JOIN sums s ON o.prefix = s.prefix LEFT JOIN nodes p ON o.depth > 0 AND p.prefix = o.prefix[1:o.depth - 1]
    """,
    "op13_chat_format": f"""
        WITH t AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL SELECT -1, u.turn, u.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) u(turn, role))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum({_escaped_length("text")} + CASE role {_MARKS} ELSE {sum(map(len, _TEMPLATE.other))} + {_escaped_length("role")} END) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id
    """,
}
