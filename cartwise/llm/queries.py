"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import (
    burst_trie, compression, decontaminate, html_text, langid, lattice, license_scan, packing, passages, periodic,
    sharding, simhash, token_store,
)
from cartwise.llm.common import training_row
from cartwise.session import ensure_checkpoint_dir, stage

SHARD_BYTES = 1 << 20


def _vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), "doc_id", "text", SHARD_BYTES)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_table(spark, sf_dir, "documents"), "doc_id", "text").drop("matches")


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pack_documents(_table(spark, sf_dir, "documents"), "doc_id", "text", _vocabulary())
    return found.drop("ids")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.word_rows(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return decontaminate.decontaminate(rows, _table(spark, sf_dir, "benchmark"), "item_id", "text").drop("_row")


def op5_simhash_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rows = stage(docs.select("doc_id", simhash.fingerprints(F.col("text")).alias("fp")))
    found = simhash.simhash_components(rows)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_lattice_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op7_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.learn(docs.where(training_row(F.col("doc_id"))), "doc_id", "text", "lang")
    found = docs.select(
        "doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), langid.predictions(model, F.col("text")).alias("p")
    )
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op8_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"), ("page_id", "url"), "html")


def op9_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = compression.learn(docs, labels.where(training_row(F.col("doc_id"))), "doc_id", "text", "quality")
    found = docs.select(
        "doc_id", (~training_row(F.col("doc_id"))).alias("held_out"), compression.scores(model, F.col("text")).alias("score")
    )
    return found.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op10_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.document_passages(_table(spark, sf_dir, "documents"), "doc_id", "text")


def op11_elias_fano_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    docs = _table(spark, sf_dir, "documents")
    token_store.write_token_shards(docs, "doc_id", "text", _vocabulary("byte_bpe_50k.json"), path)
    read = token_store.read_token_shards(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    convs = burst_trie.with_shared_heads(burst_trie.conversations(turns, "conv_id", "turn", "role", "text"))
    return burst_trie.with_hashes(burst_trie.prefix_trie(convs))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic.with_repeats(F.col("doc_id"), F.coalesce("text", F.lit(""))).alias("text"))
    found = periodic.find_runs(texts, "doc_id", "text")
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("b", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("b.start").alias("start"),
        F.col("b.length").alias("length"),
        F.col("b.period").alias("period"),
        F.floor(F.col("b.length") * 1000 / F.col("b.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_extendible_sharding, op2_license_scan, op3_vector_packing, op4_benchmark_decontamination,
        op5_simhash_pigeonring, op6_lattice_hashing, op7_language_bitmask, op8_tag_path_text,
        op9_compression_quality, op10_compact_windows, op11_elias_fano_tokens, op12_burst_trie, op13_periodic_runs,
        pipeline,
    )
}

_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM documents
), bucket AS (
  SELECT 0 AS depth, 0::BIGINT AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM docs HAVING count(*) > 0
  UNION ALL
  SELECT * FROM (
    SELECT b.depth + 1 AS depth, d.h >> (31 - b.depth) AS prefix, sum(d.bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
    FROM bucket b JOIN docs d ON d.h >> (32 - b.depth) = b.prefix
    WHERE b.shard_bytes > {SHARD_BYTES} AND b.shard_rows > 1 AND b.depth < 32 GROUP BY ALL)
), leaf AS (SELECT * FROM bucket WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE right(prefix::BIT::VARCHAR, depth) END AS shard,
  depth::BIGINT AS depth, shard_bytes, shard_rows
FROM docs JOIN leaf ON h >> (32 - depth) = prefix
"""


def _list(texts) -> str:
    return "[" + ", ".join(f"'{t}'" for t in texts) + "]"


def _op2() -> str:
    templates = ", ".join(f"('{name}', {_list(sorted(set(s.split())))})" for name, s in sorted(license_scan.TEMPLATES.items()))
    phrases = ", ".join(f"('{label}', {_list(p.split())})" for p, label in sorted(license_scan.BASE.items()))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w FROM documents),
t(name, words) AS (VALUES {templates}),
p(label, words) AS (VALUES {phrases}),
places AS (
  SELECT r, label, i FROM (SELECT r, w, unnest(range(len(w))) AS i FROM d WHERE list_contains(w, 'license')) x, p
  WHERE x.w[i + 1 : i + len(p.words)] = p.words),
base AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY r),
lines AS (SELECT r, list_distinct({_WORDS.format('line')}) AS b FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
hits AS (
  SELECT r, name, len(list_intersect(b, words)) / len(words)::DOUBLE AS share FROM lines, t
  WHERE len(list_intersect(b, words)) >= ceil(0.8 * len(words) - 1e-9)),
marks AS (SELECT r, list(DISTINCT name) AS labels, max(share) AS share FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_concat(coalesce(base.labels, []), coalesce(marks.labels, []))), ','), '') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN marks USING (r)
"""


_OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format('text')} AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS.format('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, array_to_string(w[s + 1 : s + 10], ' ') AS key, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (
  SELECT r, i, n, array_to_string(w[i + 1 : i + n], ' ') AS key
  FROM (SELECT r, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM d, lens)),
hit AS (SELECT g.r, g.i, g.n, item FROM grams g JOIN win USING (key, n)),
n_hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit USING (r) LEFT JOIN items USING (r)
"""

_OP6 = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(id, root) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = e.vec_id) AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings e JOIN (SELECT id, min(root) AS c FROM reach GROUP BY id) ON id = vec_id
"""

# CRC-32 of a text of ASCII characters: the byte table follows from the polynomial.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n)
  FROM range(256) r(n))"""


def _crc32(text: str, table: str) -> str:
    bytes_ = f"list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda b: ascii(b)::BIGINT))"
    return f"xor(list_reduce({bytes_}, lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295)"


_OP12 = f"""
WITH crc(bytes) AS (SELECT {_CRC_TABLE}),
own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, role, text) AS w
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, w, ({_crc32('conv_id::VARCHAR', 'bytes')} % 6)::INTEGER AS h FROM own, crc),
conv AS (
  SELECT a.conv_id, list_concat(coalesce(b.w[1:h], []), a.w[h + 1:]) AS w
  FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
member AS (SELECT conv_id, w[1:depth] AS path, depth, depth = len(w) AS here FROM (SELECT conv_id, w, unnest(range(len(w) + 1)) AS depth FROM conv)),
node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (here), '')) AS ends_sha256
  FROM member GROUP BY path, depth),
child AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(n, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].t) END AS saved
  FROM node LEFT JOIN child USING (path)),
below AS (
  SELECT path[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT path, saved, n_children, unnest(range(depth + 1)) AS d FROM full_node) GROUP BY 1)
SELECT a.conv_id, a.depth, p.conv_id AS parent_conv_id, a.n_convs, a.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, a.ends_sha256
FROM full_node a JOIN below USING (path) LEFT JOIN full_node p ON a.depth > 0 AND p.path = a.path[1:a.depth - 1]
"""

STATEMENTS = {
    "op1_extendible_sharding": _OP1,
    "op2_license_scan": _op2(),
    "op4_benchmark_decontamination": _OP4,
    "op6_lattice_hashing": _OP6,
    "op12_burst_trie": _OP12,
}
