"""One query per operator over its whole table, and the SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.llm import (
    decontaminate,
    hard_negatives,
    html_text,
    hyper_minhash,
    jaccard_join,
    language_id,
    mixing,
    order_minhash,
    prefix_trie,
    quality,
    substring_dedup,
    token_binary,
    warc_fixity,
)
from rangeloom.llm.common import table
from rangeloom.plans.session import scratch_path

#: Vocabulary for the token-id output; the file is on every machine at the same place.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return add


_MIX_SQL = r"""
WITH units AS (
  SELECT doc_id, source, size, count(*) AS copies FROM (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents) GROUP BY ALL
), ranked AS (
  SELECT source, CAST(sum(size * copies) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM units GROUP BY source
), weighed AS (
  SELECT *, 1 + (source_rank - 1) % 3 AS weight, 3 * source_size AS stop FROM ranked
), levels AS (
  SELECT *, row_number() OVER o AS place,
         CAST(sum(source_size) OVER () - coalesce(sum(stop) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS level
  FROM weighed WINDOW o AS (ORDER BY stop / weight, source_rank)
), targets AS (
  SELECT source, source_rank, source_size,
         CASE WHEN level * weight > stop THEN CAST(stop AS DOUBLE)
              ELSE arg_min(CASE WHEN level * weight <= stop THEN level END,
                           CASE WHEN level * weight <= stop THEN place END) OVER () * weight END AS target
  FROM levels
), queued AS (
  SELECT u.*, t.source_rank, t.source_size, t.target,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key,
         CAST(sum(size * copies) OVER (PARTITION BY t.source_rank ORDER BY
              md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), doc_id, size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
), turns AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(turn * source_size + upto AS DOUBLE) / target ELSE 0.0 END AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS turn)
), line AS (
  SELECT *, sum(size * copies) OVER (ORDER BY finish, source_rank, key, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mixed,
         (SELECT sum(size * copies) FROM units) AS budget
  FROM turns WHERE turn * source_size + upto - size * copies < target
)
SELECT doc_id, size, source_size, target, CAST(size * (
         SELECT count(*) FROM line l WHERE l.mixed <= budget AND l.doc_id IS NOT DISTINCT FROM q.doc_id
         AND l.source_rank = q.source_rank AND l.size = q.size) AS BIGINT) AS taken
FROM (SELECT *, unnest(range(copies)) AS copy FROM queued) q
"""


@_register(_MIX_SQL)
def op6_mixing(spark, folder):
    return mixing.taken_words(table(spark, folder, "documents"))


_LEAKS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), phrases AS (
  SELECT DISTINCT item, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), windows AS (
  SELECT r, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM phrases))
), hits AS (
  SELECT r, i, w.n, item FROM windows w JOIN phrases p ON p.n = w.n AND p.phrase = w.phrase
), hit AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON hit.r = docs.r LEFT JOIN found ON found.r = docs.r
"""


@_register(_LEAKS_SQL)
def op2_decontaminate(spark, folder):
    found = decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def tokens(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write ``docs`` as a token store in the shared folder and read it back."""
    store = scratch_path(spark, "tokens")
    token_binary.write_tokens(docs, store, TOKENIZER)
    return token_binary.token_digests(spark, store)


@_register()
def op1_token_binary(spark, folder):
    return tokens(spark, table(spark, folder, "documents"))


@_register()
def op3_language_id(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))


_REPEATS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT r, doc_id, i, list_aggregate(w[i:i + 12], 'string_agg', ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM docs WHERE doc_id IS NOT NULL)
), least AS (
  SELECT win, min(doc_id) AS least FROM windows GROUP BY win
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM windows JOIN least ON least.win = windows.win WHERE doc_id > least
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs
), kept AS (
  SELECT words.r, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY words.p) AS text
  FROM words LEFT JOIN gone ON gone.r = words.r AND gone.p = words.p GROUP BY words.r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON kept.r = docs.r
"""


@_register(_REPEATS_SQL)
def op9_substring_dedup(spark, folder):
    return substring_dedup.remove_repeats(table(spark, folder, "documents")).drop("kept_text")


def _near_sql(size: int, columns: str) -> str:
    """Components of documents whose sets of word runs share 80% of their union."""
    return rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^ 	-
]+') AS words FROM documents
), runs AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {size} THEN [list_aggregate(words, 'string_agg', ' ')]
    ELSE list_distinct([list_aggregate(words[i:i + {size - 1}], 'string_agg', ' ') FOR i IN range(1, len(words) - {size - 2})]) END) AS run
  FROM docs
), sizes AS (
  SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS s FROM runs a JOIN runs b ON a.run = b.run AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * s >= 80 * (x.n + y.n - s)
), sides AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a AS node, a AS other FROM sides UNION SELECT r.node, b.b FROM reached r JOIN sides b ON b.a = r.other
), least AS (
  SELECT node, min(other) AS component FROM reached GROUP BY node
)
SELECT {columns} FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.node = d.doc_id
"""


@_register(_near_sql(5, "d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id"))
def op7_jaccard_join(spark, folder):
    return jaccard_join.near_duplicates(table(spark, folder, "documents"))


@_register()
def op8_order_minhash(spark, folder):
    return order_minhash.edit_report(table(spark, folder, "documents"))


@_register()
def op5_html_text(spark, folder):
    return html_text.extract_text(table(spark, folder, "pages"))


@_register()
def op4_co_training(spark, folder):
    return quality.score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


_FIXITY_SQL = """
SELECT page_id, 'differs' AS status, sha256(html) AS ours_payload, sha256('?' || substr(html, 2)) AS theirs_payload,
       true AS ours_sound, false AS theirs_sound FROM pages WHERE page_id % 61 = 7 AND html LIKE '<%'
UNION ALL SELECT page_id, 'differs', sha256(html), sha256(left(html, length(html) // 2)), true, false
FROM pages WHERE page_id % 61 = 8 AND length(html) > 1
UNION ALL SELECT page_id, 'missing', sha256(html), NULL, true, NULL FROM pages WHERE page_id % 61 = 9
UNION ALL SELECT -1 - page_id, 'extra', NULL, sha256('added ' || CAST(page_id AS VARCHAR)), NULL, true FROM pages WHERE page_id % 61 = 10
"""


@_register(_FIXITY_SQL)
def op10_warc_fixity(spark, folder):
    """Archive all pages; of a replica with changed, cut, lost and added records, locate the damage."""
    target = scratch_path(spark, "warc")
    pages, part = table(spark, folder, "pages"), F.col("page_id") % 61
    warc_fixity.write_archive(pages, f"{target}/ours", "pages")
    own = F.struct(*[F.col(c) for c in pages.columns])
    new = F.struct(
        *[{"page_id": F.lit(-1).cast("bigint") - F.col(c), "html": F.concat(F.lit("added "), F.col("page_id").cast("string"))}.get(c, F.col(c)).alias(c) for c in pages.columns]
    )
    # In its place, so that all other records stay in their files.
    replica = pages.where(part.isNull() | (part != 9)).select(F.inline(F.when(part == 10, F.array(own, new)).otherwise(F.array(own))))
    html, size = F.col("html"), F.length("html")
    damaged = F.when((part == 7) & html.startswith("<"), F.concat(F.lit("?"), html.substr(F.lit(2), size)))
    damaged = damaged.when((part == 8) & (size > 1), html.substr(F.lit(1), (size / 2).cast("int")))
    warc_fixity.write_archive(replica, f"{target}/theirs", "pages", stored=damaged)
    replicas = [warc_fixity.read_archive(spark, f"{target}/{side}") for side in ("ours", "theirs")]
    return warc_fixity.audit(*replicas).drop("file", "offset")


_NEGATIVES_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS place, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.place AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, c.place, c.vec_id, c.label,
         CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) AS score
  FROM rows a JOIN rows c ON a.place <> c.place WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS n
                 FROM scored WHERE label = anchor_label) WHERE n <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND s.label <> s.anchor_label
   AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@_register(_NEGATIVES_SQL)
def op11_hard_negatives(spark, folder):
    vectors, vec_id = table(spark, folder, "embeddings"), F.col("vec_id")
    label = F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), vec_id % 100 == 0)


@_register(
    _near_sql(2, "d.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id, "
                 "coalesce(l.component, d.doc_id) = d.doc_id AS kept")
)
def op12_hyper_minhash(spark, folder):
    return hyper_minhash.near_duplicates(table(spark, folder, "documents"))


_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS place,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], [CAST(ord(x) AS BIGINT) FOR x IN string_split(CAST(c AS VARCHAR), '')]),
           lambda done, byte: list_reduce(list_concat([xor(done, byte)], [CAST(0 AS BIGINT) FOR i IN range(8)]),
             lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT v.c, 0 AS late, t.place, t.id, t.words FROM convs v JOIN turns t ON t.c = v.c - v.c % 20 AND t.place <= v.h
  UNION ALL SELECT v.c, 1, t.place, t.id, t.words FROM convs v JOIN turns t ON t.c = v.c AND t.place > v.h
), starts AS (
  SELECT c, words, string_agg(id, '') OVER o AS start, row_number() OVER o AS depth
  FROM rebuilt WINDOW o AS (PARTITION BY c ORDER BY late, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL SELECT c, 0, '', 0 FROM convs
), lasts AS (
  SELECT c, max(depth) AS depth FROM starts GROUP BY c
), nodes AS (
  SELECT s.start, s.depth, min(s.c) AS conv_id, count(*) AS n_convs, any_value(s.words) AS words,
         coalesce(string_agg(CASE WHEN s.depth = l.depth THEN CAST(s.c AS VARCHAR) END, ',' ORDER BY s.c), '') AS ends
  FROM starts s JOIN lasts l ON l.c = s.c GROUP BY s.start, s.depth
), children AS (
  SELECT left(start, 32 * (depth - 1)) AS start, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), below AS (
  SELECT a.start, count(*) FILTER (k.n IS NULL) AS n_leaves, CAST(sum((b.n_convs - 1) * b.words) AS BIGINT) AS saved_tokens
  FROM nodes a JOIN nodes b ON left(b.start, length(a.start)) = a.start LEFT JOIN children k ON k.start = b.start GROUP BY a.start
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children, b.n_leaves, b.saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.start = n.start LEFT JOIN children k ON k.start = n.start
LEFT JOIN nodes p ON n.depth > 0 AND p.start = left(n.start, 32 * (n.depth - 1))
"""


@_register(_TRIE_SQL)
def op13_prefix_trie(spark, folder):
    """The trie of conversations that begin as the first of their twenty does."""
    own, conv = prefix_trie.turn_sequences(table(spark, folder, "conversations")), F.col("conv_id")
    h = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(prefix_trie.with_first_turns(own, conv - conv % 20, h, 3))
