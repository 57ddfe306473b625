"""The operators as registered queries, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import (
    conversation_trie,
    decontaminate,
    line_dedup,
    minhash,
    mixing,
    packing,
    quality,
    resampling,
    secret_scan,
    sharding,
    suffix_dedup,
    token_counts,
    warc,
)
from sluice.llm.common import prepare, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
SHARD_BYTES = 1 << 20


def query(sql: str | None = None):
    def add(run: Query) -> Query:
        def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return run(spark, sf_dir)

        QUERIES[run.__name__] = prepared
        if sql:
            ORACLE_SQL[run.__name__] = sql
        return run

    return add


@query(
    f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
    ('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents),
p AS (SELECT d.*, r.depth, h >> ({sharding.BITS} - r.depth) AS prefix
  FROM d, (SELECT CAST(range AS INTEGER) AS depth FROM range({sharding.BITS + 1})) r),
b AS (SELECT depth, prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY ALL
  HAVING sum(n_bytes) <= {SHARD_BYTES} OR min(h) = max(h)),
f AS (SELECT p.*, shard_bytes, shard_rows, row_number() OVER (PARTITION BY doc_id, h ORDER BY depth) AS i
  FROM p JOIN b USING (depth, prefix))
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes,
  CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard,
  depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
FROM f WHERE i = 1"""
)
def op3_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of the documents of at most 1 MiB each."""
    docs = table(spark, sf_dir, "documents")
    return sharding.shard(docs, SHARD_BYTES).select(
        "doc_id", sharding.text_bytes().alias("n_bytes"), "shard", "depth", "shard_bytes", "shard_rows"
    )


@query()
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.taken(mixing.draw(table(spark, sf_dir, "documents")))


_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@query(
    f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS first_id FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', CAST(1 + (
    ((strpos('0123456789abcdef', substr(hex, CAST(1 + (5 * i) // 4 AS BIGINT), 1)) - 1) * 16
     + strpos('0123456789abcdef', substr(hex, CAST(2 + (5 * i) // 4 AS BIGINT), 1)) - 1)
    // CAST(power(2, 3 - (5 * i) % 4) AS BIGINT)) % 32 AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM q"""
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    back = warc.archive_pages(spark, table(spark, sf_dir, "pages"), min_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of whole texts, from their prefix counts."""
    import public_tokenizers

    counted = token_counts.prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counted.select(
        "doc_id",
        "n_bytes",
        token_counts.total_tokens(F.col("tokens")).alias("n_tokens"),
        token_counts.over_budget(F.col("tokens"), TOKEN_LIMIT).alias("over_limit"),
    )


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the learned list's verdict."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates on word pairs, as the contract has it."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.MinHash(words=2))


@query()
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark questions, as they are or with other values."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: base spans, and those the Markov models add."""
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


@query()
def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that repeat, nearly or exactly, an earlier one."""
    return line_dedup.counted(line_dedup.duplicate_lines(table(spark, sf_dir, "documents")))


@query()
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of each document without 50-byte strings of smaller ones."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


SEQUENCE = 4096
END_ID = 2


@query()
def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 4,096 tokens."""
    import public_tokenizers

    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), SEQUENCE, END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


_BYTES = "list_transform(range(strlen(f)), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))"
_CHECKSUM = f"""xor(list_reduce(list_prepend(4294967295, {_BYTES}),
    lambda c, b: xor(c >> 8, list_extract(steps, 1 + (xor(c, b) & 255)))), 4294967295)"""
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"


@query(
    f"""
WITH RECURSIVE bits AS (SELECT range AS b, 0 AS k, range AS c FROM range(256)
  UNION ALL SELECT b, k + 1, {_STEP} FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY b) AS steps FROM bits WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (SELECT side, id, len(w) AS n_words,
  list_concat(w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2])) AS fs FROM words),
each AS (SELECT side, id, unnest(fs) AS f FROM runs),
hashed AS (SELECT f, {_CHECKSUM} % 10000 AS bucket FROM (SELECT DISTINCT f FROM each), steps),
counted AS (SELECT side, id, bucket, count(*) AS n FROM each JOIN hashed USING (f) GROUP BY ALL),
totals AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t
  FROM counted GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS ss, coalesce(sum(t), 0)::DOUBLE AS tt FROM totals),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) / ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
  FROM totals, sums),
means AS (SELECT id, sum(n * gain) AS g, sum(n) AS n FROM counted JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (SELECT id AS doc_id, n_words, coalesce(n, 0)::BIGINT AS n_features,
  coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise
  FROM runs LEFT JOIN means USING (id) WHERE side = 'd'),
placed AS (SELECT *, weight + noise AS score, n_words >= 20 AS able,
  row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) AS r,
  count(*) OVER (PARTITION BY n_words >= 20) AS n_able FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND r <= 25 * n_able // 100 THEN r END AS rank FROM placed"""
)
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn by how much they resemble the benchmark's texts."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(
    f"""
WITH RECURSIVE bits AS (SELECT range AS b, 0 AS k, range AS c FROM range(256)
  UNION ALL SELECT b, k + 1, {_STEP} FROM bits WHERE k < 8),
steps AS (SELECT list(c ORDER BY b) AS steps FROM bits WHERE k = 8),
raw AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL),
keyed AS (SELECT c, turn, md5(concat(length(role), ':', role, text)) AS k,
  len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM raw),
turns AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, k, w) AS p FROM keyed),
sizes AS (SELECT c, CAST(c AS VARCHAR) AS f, c - c % 20 AS b, count(*) AS n FROM turns GROUP BY c),
ids AS (SELECT c, b, n, {_CHECKSUM} % 4 AS h FROM sizes, steps),
parts AS (SELECT i.c, 0 AS half, t.p, t.k, t.w FROM ids i JOIN turns t ON t.c = i.b AND t.p <= i.h
  UNION ALL SELECT i.c, 1, t.p, t.k, t.w FROM ids i JOIN turns t ON t.c = i.c AND t.p > i.h),
seqs AS (SELECT i.c, coalesce(list(p.k ORDER BY half, p) FILTER (p.k IS NOT NULL), []) AS ks,
  coalesce(list(p.w ORDER BY half, p) FILTER (p.k IS NOT NULL), []) AS ws FROM ids i LEFT JOIN parts p ON p.c = i.c GROUP BY i.c),
paths AS (SELECT c, len(ks) AS n, d, array_to_string(ks[1:d], ',') AS node, CASE WHEN d = 0 THEN 0 ELSE ws[d] END AS w,
  CASE WHEN d > 0 THEN array_to_string(ks[1:d - 1], ',') END AS up
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM seqs)),
nodes AS (SELECT node, any_value(up) AS up, d, min(c) AS conv_id, count(*) AS n_convs, max(w) AS w,
  sha256(coalesce(string_agg(c, ',' ORDER BY c) FILTER (n = d), '')) AS ends FROM paths GROUP BY node, d),
tree AS (SELECT n.*, (SELECT count(*) FROM nodes k WHERE k.up = n.node AND k.d = n.d + 1) AS n_children FROM nodes n),
sums AS (SELECT p.node, p.d, sum(CAST(t.n_children = 0 AS BIGINT)) AS n_leaves, sum((t.n_convs - 1) * t.w) AS saved
  FROM tree t JOIN paths p ON p.c = t.conv_id AND p.d <= t.d GROUP BY p.node, p.d)
SELECT t.conv_id, t.d AS depth, u.conv_id AS parent_conv_id, t.n_convs, t.n_children, CAST(s.n_leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, t.ends AS ends_sha256
FROM tree t JOIN sums s ON s.node = t.node AND s.d = t.d LEFT JOIN nodes u ON u.node = t.up AND u.d = t.d - 1"""
)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))
