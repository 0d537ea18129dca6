"""The registered queries opN_<name>, thin layers over the operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import bpe, chosen_path, decontaminate, html, language, lexical, mtree, packing, prefix_trie, quality, suffix, toxicity, warc
from pluvio.llm.common import col, held_out, staged, table
from pluvio.session import fresh_path

RANKS = "byte_bpe_multi_50k.tiktoken"
#: The ranks of byte_bpe_50k.json, and its added token.
PACKING_RANKS, PACKING_SPECIAL = "byte_bpe_50k.tiktoken", {"<|endoftext|>": 50256}


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(RANKS))
    coded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    both = bpe.decode(coded, ranks, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    trusted = quality.trusted_ids(table(spark, folder, "labels"), F.col("quality") == 1)
    made = col("quality")
    return quality.judge(docs, trusted).select("doc_id", made["nats"].alias("nats"), made["perplexity"].alias("perplexity"), made["threshold"].alias("threshold"), made["keep"].alias("keep"))


def op3_similar(spark: SparkSession, folder: str) -> DataFrame:
    found = chosen_path.join(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links")


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = warc.planned(table(spark, folder, "pages"))
    index = staged(warc.write(rows, fresh_path(spark, "warc")), "warc-index")
    tasks = index.select("bundle").distinct().count()
    return warc.read(index, tasks).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, octet_length(encode(h)) AS n, max(page_id) OVER (PARTITION BY h) AS kept FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id < kept THEN kept END AS refers_to
FROM q
"""


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.summary(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"), ~held_out(F.col("doc_id")))
    made = col("toxicity")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        made["score"].alias("score"),
        (made["score"] >= 0.5).cast("int").alias("predicted"),
        made["evidence"].alias("evidence"),
    )


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    network = language.fit(docs, ~held_out(F.col("doc_id")))
    found = language.predict(docs.select("doc_id", "text"), network)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return mtree.top_k(table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.v AS qv, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON len(q.v) = len(c.v) AND (q.vec_id <> c.vec_id OR q.v <> c.v)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10
"""


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html.extract(pages, html.fit(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, folder, "benchmark"))
    made = col("contamination")
    return found.select(
        "doc_id",
        made["n_words"].alias("n_words"),
        decontaminate.n_hit(made).alias("n_hit"),
        F.size(made["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(made["items"], ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated(made).alias("contaminated"),
    )


OP10_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0
), items AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM starts
), places AS (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM items) WHERE len(w) >= k
), hits AS (
  SELECT r, i, places.k AS k, item_id
  FROM places JOIN items ON places.k = items.k AND array_to_string(w[i : i + places.k - 1], ' ') = s
), hit_words AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM hits) GROUP BY r
), hit_items AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit_words.n, 0) AS n_hit, coalesce(hit_items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(hit_words.n, 0) > 0 AND 20 * coalesce(hit_words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    conv = F.col("conv_id")
    turns = staged(prefix_trie.ordered_turns(table(spark, folder, "conversations")), "trie-turns")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns, head, conv - conv % 20, 3))


OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({'k': k, 'words': words} ORDER BY turn NULLS FIRST, k) AS l, CAST(conv_id AS VARCHAR) AS s FROM t GROUP BY conv_id
), heads AS (
  SELECT conv_id, l, xor(list_reduce(list_transform(range(1, length(s) + 1), lambda i: CAST(ascii(s[i]) AS BIGINT)),
    lambda x, b: list_reduce(range(0, 8), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)), xor(x, b)), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.l[1 : a.h], []), a.l[a.h + 1 : ]) AS l
  FROM heads AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 20
), steps AS (
  SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt
), nodes AS (
  SELECT l[1 : d] AS p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(l) = d), '')) AS ends_sha256
  FROM steps GROUP BY p, d
), kids AS (
  SELECT p[1 : depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT nodes.p, depth, CAST(kids.n IS NULL AS BIGINT) AS leaf, CASE WHEN depth > 0 THEN (n_convs - 1) * nodes.p[depth].words ELSE 0 END AS saved
  FROM nodes LEFT JOIN kids USING (p)
), sums AS (
  SELECT p[1 : a] AS p, sum(leaf) AS leaves, sum(saved) AS saved
  FROM (SELECT p, leaf, saved, unnest(range(0, depth + 1)) AS a FROM valued) GROUP BY 1
)
SELECT nodes.conv_id, depth, up.conv_id AS parent_conv_id, n_convs, coalesce(kids.n, 0) AS n_children,
       CAST(sums.leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums USING (p) LEFT JOIN kids USING (p)
LEFT JOIN (SELECT p AS up_p, conv_id FROM nodes) AS up ON depth > 0 AND up_p = nodes.p[1 : depth - 1]
"""


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path(PACKING_RANKS), public_tokenizers.PATTERN, PACKING_SPECIAL)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), tf AS (
  SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals
), scored AS (
  SELECT item_id, r, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM b JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (r), totals
  GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS n FROM scored WHERE score > 0
)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 10
"""


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_quality": op2_quality,
    "op3_similar": op3_similar,
    "op4_warc": op4_warc,
    "op5_repeats": op5_repeats,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_top_k": op8_top_k,
    "op9_main_text": op9_main_text,
    "op10_decontamination": op10_decontamination,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_packing": op12_packing,
    "op13_lexical_search": op13_lexical_search,
}
SQL: dict[str, str] = {
    "op4_warc": OP4_SQL,
    "op8_top_k": OP8_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_lexical_search": OP13_SQL,
}
