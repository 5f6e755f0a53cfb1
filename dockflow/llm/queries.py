"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.llm import (
    bpe, chat, embeddings, importance, lexical, licenses, mixing, secret_scan, sharding, simhash, syncmers, toxicity,
    warc,
)
from dockflow.llm.base import table
from dockflow.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, bits=3)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@query
def op2_embedding_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def byte_bpe() -> tuple[dict[bytes, int], str]:
    """Ranks and pattern of the tokenizer that the query and the pipeline use."""
    import public_tokenizers

    return bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def bpe_digests(documents: DataFrame) -> DataFrame:
    """Numbers of tokens and digests of the ids and of the decoded bytes."""
    ranks, pattern = byte_bpe()
    coded = bpe.decode(bpe.encode(documents.select("doc_id", "text"), ranks, pattern), ranks)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


@query
def op3_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    own = syncmers.anchors(rows.withColumn("_h", syncmers.token_hashes(F.col("text"))), "_h", "_a")
    own = own.select("doc_id", "text", F.col("_a.hash").alias("own"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = syncmers.with_next(own, "doc_id", ["text", "own"], buckets)
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    near = near.select(
        "doc_id", n.cast("long").alias("n_chars"), "own", "next_own",
        F.concat(F.substring("text", 1, n - cut), F.substring("next_text", 1, cut)).alias("edited"),
    )
    near = syncmers.anchors(near.withColumn("_h", syncmers.token_hashes(F.col("edited"))), "_h", "_e")
    edited = F.col("_e.hash")
    return near.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.shown("own").alias("fingerprint"), syncmers.shown(edited).alias("edited_fingerprint"),
        syncmers.likeness(F.col("own"), edited).alias("near_edited"),
        syncmers.likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return found.select("doc_id", "size", "source_size", "target", "taken")


@query
def op7_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    read = warc.reassemble(warc.read_segments(spark, path))
    return read.select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"), "complete",
    )


@query
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), tricky.alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    turns = chat.canonical_turns(chat.records(rows)).drop("record")
    read = chat.parse_formatted(chat.format_turns(turns).select("conv_id", "formatted", "loss_spans"))
    read = read.withColumn("loss", chat.loss_text())
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read_turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query
def op8_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"))
    scored = toxicity.score(documents.withColumn("held_out", toxicity.held_out("doc_id")), model)
    return scored.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


@query
def op6_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(documents, secret_scan.fit(documents))
    count = lambda k: F.size(F.filter("secrets", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.listed(base), 256).alias("base_sha256"),
        secret_scan.listed(F.col("secrets")).alias("spans"),
    )


@query
def op1_license_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.detect(documents)
    columns = licenses.summary()
    return found.select("doc_id", "n_words", *[c.alias(k) for k, c in columns.items()])


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=5, least_words=20, seed=42
    )


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query
def op13_kk_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_slots(table(spark, sf_dir, "documents"), shards=16)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# ---- the same results in SQL, where SQL can express them --------------------------------------

ORACLE["op2_embedding_rp_forest"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, m.component_id,
  e.vec_id = m.component_id AS kept
FROM embeddings e JOIN least m ON m.a = e.vec_id"""

ORACLE["op7_warc_segments"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, CASE WHEN strlen(coalesce(html, '')) >= 100
    THEN min(page_id) OVER (PARTITION BY coalesce(html, '')) ELSE page_id END AS first
  FROM pages)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS complete
FROM p"""

ORACLE["op9_chat_formatting"] = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), f AS (
  SELECT *, '### ' || upper(role[1]) || role[2:] || ': '
    || replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e') || '</turn>' || chr(10) AS shown
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss, sum(length(shown)) AS n
  FROM f GROUP BY 1)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g"""

ORACLE["op11_importance_resampling"] = r"""
WITH table_of AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))
), words AS (
  SELECT doc_id AS id, true AS own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT item_id, false, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), runs AS (
  SELECT id, own, unnest(w) AS f FROM words
  UNION ALL SELECT id, own, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT id, own, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  FROM words
), features AS MATERIALIZED (SELECT id, own, f, count(*) AS n FROM runs GROUP BY ALL
), coded AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(f) + 1),
    lambda i: CAST('0x' || substr(h, CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f, hex(f) AS h FROM features), table_of
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t
  FROM features JOIN coded USING (f) GROUP BY 1
), gains AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE)))
    AS gain
  FROM counts, (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts)
), weights AS (
  SELECT id, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM features JOIN coded USING (f) JOIN gains USING (bucket) WHERE own GROUP BY 1
), scored AS (
  SELECT id AS doc_id, CASE WHEN len(w) >= 3 THEN 3 * len(w) - 3 WHEN len(w) = 2 THEN 3 ELSE len(w) END AS n_features,
    len(w) >= 20 AS fit, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (CAST('0x' || sha256('42:' || id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (id) WHERE words.own
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS place FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score,
  CASE WHEN fit AND place <= 5 * (SELECT count(*) FROM scored WHERE fit) // 100 THEN place END AS rank
FROM placed"""

ORACLE["op12_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), corpus AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0
), tf AS (SELECT row, doc_id, len(w) AS n, term, count(*) AS tf FROM (SELECT row, doc_id, w, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL
), df AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, n_docs
), scored AS (
  SELECT item_id, row, doc_id,
    CAST(sum(df.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM items JOIN tf USING (term) JOIN df USING (term), corpus GROUP BY 1, 2, 3
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 50"""
