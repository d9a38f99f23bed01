"""The operators over the test tables, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, merkle, packing, quality, repair, rules, sharding, simhash, toxicity, vectors, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page."""
    return language.identify_pages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents").select("text", "lang"))


@_query
def op3_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in 24 shards, by permuted row number."""
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=24)


@_query
def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op4_fm_index"] = f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, dw.i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@_query
def op5_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as read back from their archives."""
    found = warc.round_trip(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op5_warc_archives"] = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
g AS (SELECT payload_digest, max(page_id) AS head FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN head IS NULL OR head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@_query
def op6_simhash_byte_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op7_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


@_query
def op8_random_indexing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op9_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query
def op10_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from Re-Pair files."""
    return repair.token_files(_table(spark, sf_dir, "documents"))


@_query
def op11_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document, and whether it is kept by the base rules and the thresholds of its language and source."""
    found = rules.adaptive_rules(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _share(part: str, whole: str, unit: int) -> str:
    return f"CASE WHEN {whole} > 0 THEN {unit} * {part} // {whole} ELSE 0 END"


def _rules_sql() -> str:
    """Measures in one row per document, sketches as bucket counts at three levels, quartiles from running counts."""
    spread = lambda m: f"greatest({m}_q75 - {m}_q25, {rules.LEAST_SPREAD[m]})"
    ends = [f"{m}_q75 + {rules.FENCE} * {spread(m)} AS {m}_high" for m in rules.LEAST_SPREAD]
    ends += [f"{m}_q25 - {rules.FENCE} * {spread(m)} AS {m}_low" for m in rules.TWO_SIDED]
    names = [e.rpartition(" AS ")[2] for e in ends]
    quarters = [f"max(CASE WHEN m = '{m}' THEN q{q} END) AS {m}_q{q}" for m in rules.LEAST_SPREAD for q in (25, 75)]
    pairs = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS m, {m} AS v FROM measured WHERE NOT base_failed" for m in rules.LEAST_SPREAD)
    level = lambda k, lang, source: f"SELECT {k} AS lv, {lang} AS lang, {source} AS source, m, bucket, count(*) AS n FROM buckets GROUP BY ALL"
    pick = [f"coalesce(a.{c}, b.{c}, o.{c}) AS {c}" for c in names]
    fits = [f"{m} <= {m}_high" for m in rules.LEAST_SPREAD] + [f"{m} >= {m}_low" for m in rules.TWO_SIDED]
    some = f"n_rows >= {rules.MIN_ROWS}"
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS words,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^ 	-
]')) AS filled FROM t),
windows AS (SELECT doc_id, i, array_to_string(words[i : i + 7], ' ') AS g
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 7)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
counts AS (SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
                  CAST(length(regexp_replace(text, '[ 	-
]+', '', 'g')) AS BIGINT) AS word_chars,
                  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines,
                  CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(string_split(text, chr(10))) AS n_lines
           FROM w LEFT JOIN covered USING (doc_id)),
measured AS (SELECT *, n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MOST_REPEATED} * n_words AS base_failed,
                    {_share('n_symbols', 'word_chars', 10000)} AS symbol_share, {_share('word_chars', 'n_words', 100)} AS word_length,
                    {_share('n_dup_lines', 'n_lines', 10000)} AS dup_line_share FROM counts),
buckets AS (SELECT lang, source, m, (v >> greatest(length(bin(v)) - {rules.BITS}, 0)) << greatest(length(bin(v)) - {rules.BITS}, 0) AS bucket
            FROM ({pairs})),
sketches AS ({level(0, 'lang', 'source')} UNION ALL {level(1, 'lang', 'NULL')} UNION ALL {level(2, 'NULL', 'NULL')}),
running AS (SELECT *, sum(n) OVER (PARTITION BY lv, lang, source, m ORDER BY bucket) AS upto,
                   sum(n) OVER (PARTITION BY lv, lang, source, m) AS n_rows FROM sketches),
quarters AS (SELECT lv, lang, source, m, n_rows, min(CASE WHEN 100 * upto >= 25 * n_rows THEN bucket END) AS q25,
                    min(CASE WHEN 100 * upto >= 75 * n_rows THEN bucket END) AS q75 FROM running GROUP BY ALL),
fences AS (SELECT lv, lang, source, n_rows, {', '.join(ends)}
           FROM (SELECT lv, lang, source, n_rows, {', '.join(quarters)} FROM quarters GROUP BY ALL)),
chosen AS (SELECT measured.*, {', '.join(pick)} FROM measured
           LEFT JOIN fences a ON a.lv = 0 AND a.{some} AND a.lang IS NOT DISTINCT FROM measured.lang AND a.source IS NOT DISTINCT FROM measured.source
           LEFT JOIN fences b ON b.lv = 1 AND b.{some} AND b.lang IS NOT DISTINCT FROM measured.lang
           LEFT JOIN fences o ON o.lv = 2)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {' AND '.join(fits)}, FALSE) AS kept
FROM chosen
"""


SQL["op11_adaptive_rules"] = _rules_sql()


@_query
def op12_merkle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a copy that lost line breaks is found out."""
    found = merkle.document_manifest(_table(spark, sf_dir, "documents"), merkle.without_breaks)
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def _leaf(text: str) -> str:
    part = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    return f"sha256({' || '.join(map(part, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, list_extract(crc, CAST(xor(c & 255, b) + 1 AS BIGINT)))))"""

SQL["op12_merkle_windows"] = f"""
WITH RECURSIVE bytes AS (
    SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS crc),
copies AS (SELECT *, CASE WHEN {_CRC32} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS copy FROM documents CROSS JOIN bytes),
hashed AS (SELECT doc_id, coalesce('=' || source, '') AS g, {_leaf('text')} AS leaf, {_leaf('copy')} AS copy_leaf FROM copies),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS total FROM hashed),
nodes AS (SELECT g, 0 AS lv, pos, leaf AS h, total FROM leaves
    UNION ALL
    SELECT g, lv + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (total + 2) // 3 FROM nodes WHERE total > 1 GROUP BY g, lv, pos // 3, total),
subroots AS (SELECT g, lv AS depth, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS total FROM nodes WHERE total = 1),
tops AS (SELECT 0 AS lv, pos, subroot AS h, total FROM subroots
    UNION ALL
    SELECT lv + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (total + 2) // 3 FROM tops WHERE total > 1 GROUP BY lv, pos // 3, total),
folds AS (
    SELECT leaves.g, leaves.pos AS leaf_pos, 0 AS lv, leaves.pos AS own, copy_leaf AS h, '' AS proof, depth, subroots.pos AS top FROM leaves JOIN subroots USING (g)
    UNION ALL
    SELECT f.g, f.leaf_pos, f.lv + 1, f.own // 3, sha256(string_agg(CASE WHEN n.pos = f.own THEN f.h ELSE n.h END, '' ORDER BY n.pos)),
           f.proof || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> f.own), ''), f.depth, f.top
    FROM folds f JOIN nodes n ON n.g = f.g AND n.lv = f.lv AND n.pos // 3 = f.own // 3
    WHERE f.lv < f.depth GROUP BY f.g, f.leaf_pos, f.lv, f.own, f.h, f.proof, f.depth, f.top),
crowns AS (
    SELECT g, leaf_pos, 0 AS lv, top AS own, h, proof FROM folds WHERE lv = depth
    UNION ALL
    SELECT f.g, f.leaf_pos, f.lv + 1, f.own // 3, sha256(string_agg(CASE WHEN n.pos = f.own THEN f.h ELSE n.h END, '' ORDER BY n.pos)),
           f.proof || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> f.own), '')
    FROM crowns f JOIN tops n ON n.lv = f.lv AND n.pos // 3 = f.own // 3
    WHERE n.total > 1 GROUP BY f.g, f.leaf_pos, f.lv, f.own, f.h, f.proof),
root AS (SELECT lv, h FROM tops WHERE total = 1)
SELECT doc_id, leaf, subroot, root.h AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = root.h AS verified
FROM leaves JOIN subroots USING (g) JOIN crowns c ON c.g = leaves.g AND c.leaf_pos = leaves.pos JOIN root ON root.lv = c.lv
"""


@_query
def op13_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the 16 components of the largest variance, whitened."""
    found = whitening.whiten(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
