"""The registered queries of the operators: each takes (spark, folder) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, embed_dedup, language_id, lm_scoring, packing, prefix_trie, quality, repair, sharding, simhash, token_output, topk, url_filters
from .shared import staged


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_table(spark, folder, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "lang_mix"
    )


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality.classify(docs, labels).select("doc_id", "lang", "n_bytes", "perplexity", "threshold_low", "threshold", "keep")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def word_bpe_path() -> str:
    """The tokenizer file that the token queries use, as installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.encode(_table(spark, folder, "documents").select("doc_id", "text"), word_bpe_path(), decoded=True)
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), word_bpe_path())


def op6_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, folder, "embeddings"))


SHARD_BYTES = 1 << 20


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return sharding.assign(docs, SHARD_BYTES).select("doc_id", "bytes", "depth", "prefix", "part")


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(_table(spark, folder, "embeddings"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", language_id.held_out(F.col("doc_id"), 7, 2))
    model = lm_scoring.train(docs.where(~F.col("held_out")))
    return lm_scoring.score(docs, model)


ORDER_KEY = 20_240_229


def op10_token_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_output.materialise(docs, word_bpe_path(), ORDER_KEY).drop("file")


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op11_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge(_table(spark, folder, "pages"), url_filters.rule_table(spark, URL_RULES))


def op12_rebuilt(rows: DataFrame) -> DataFrame:
    """The contract's rebuilt conversations, as turns for ``prefix_trie.build``."""
    turns = staged(prefix_trie.numbered(prefix_trie.digested(rows)), "turns")
    convs = rows.where("conv_id is not null").select("conv_id").distinct()
    convs = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h"))
    heads = turns.where("pos <= 8 and conv_id % 5 = 0").select(F.col("conv_id").alias("from"), "digest", "n_bytes", "pos")
    # At most nine conversations share a base, and eight turns of it.
    taken = convs.join(heads, (F.col("base") == F.col("from")) & (F.col("pos") <= F.col("h"))).select("conv_id", "digest", "n_bytes", "pos")
    length = heads.groupBy("from").agg(F.count("*").alias("n_base"))
    convs = convs.join(length, F.col("base") == F.col("from"), "left").select("conv_id", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("n_taken"))
    rest = turns.join(convs, "conv_id").where("pos > h").select("conv_id", "digest", "n_bytes", (F.col("pos") - F.col("h") + F.col("n_taken")).alias("pos"))
    roots = convs.select("conv_id", F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("pos"))
    return roots.union(taken).union(rest)


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    nodes, ends = prefix_trie.build(op12_rebuilt(_table(spark, folder, "conversations")))
    digests = prefix_trie.ends_digests(ends).withColumnRenamed("depth", "end_depth")
    joined = nodes.join(digests, (F.col("conv_id") == F.col("node")) & (F.col("depth") == F.col("end_depth")), "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def op13_damaged(rows: DataFrame) -> DataFrame:
    """The rows with the contract's damage; a dropped row stays as one that is not ``present``."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.select("conv_id", "turn", "role", "text", (F.crc32(key.cast("binary")) % 20).alias("kind"))
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def op13_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = op13_damaged(_table(spark, folder, "conversations"))
    audits, turns = repair.repair(damaged, F.col("present"))
    digests = repair.digests(turns).withColumnRenamed("conv_id", "id")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return audits.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select("conv_id", *names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe,
    "op5_packing": op5_packing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sharding": op7_sharding,
    "op8_top_k": op8_top_k,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_token_output": op10_token_output,
    "op11_url_filters": op11_url_filters,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_repair": op13_repair,
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op8_top_k": """
        WITH whole AS (
            SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id, c.row,
                   CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.row <> c.row AND len(q.v) = len(c.v)
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, row) AS rank FROM scored
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_url_filters": """
        WITH rules(host, path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
        ), rest AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages
        ), parts AS (
            SELECT page_id,
                   translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
            FROM rest
        ), found AS (
            SELECT p.host, p.path, max(ROW(length(u.host) + length(u.path), length(u.host), u.host || u.path, u.verdict)) AS best
            FROM (SELECT DISTINCT host, path FROM parts) p JOIN rules u
              ON (p.host = u.host OR ends_with(p.host, '.' || u.host)) AND starts_with(p.path, u.path)
            GROUP BY p.host, p.path
        )
        SELECT page_id, p.host, p.path, best[3] AS rule, coalesce(best[4], 'allow') AS verdict
        FROM parts p LEFT JOIN found f ON p.host = f.host AND p.path = f.path
    """,
    "op7_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
                   CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS bits
            FROM documents
        ), keys AS (
            SELECT bits, count(*) AS n, sum(bytes) AS bytes FROM hashed GROUP BY bits
        ), nodes AS (
            SELECT d, bits >> (60 - d) AS p, sum(n) AS n, sum(bytes) AS bytes
            FROM keys, range(0, 61) AS depths(d) GROUP BY d, bits >> (60 - d)
        ), depths AS (
            SELECT k.bits, count(*) FILTER (WHERE o.bytes > {SHARD_BYTES} AND o.n > 1) AS depth
            FROM keys k, range(0, 61) AS depths(d), nodes o
            WHERE o.d = depths.d AND o.p = k.bits >> (60 - depths.d) GROUP BY k.bits
        ), ranked AS (
            SELECT h.*, depth, row_number() OVER (PARTITION BY h.bits) - 1 AS copy
            FROM hashed h JOIN depths USING (bits)
        )
        SELECT doc_id, CAST(bytes AS BIGINT) AS bytes, CAST(least(depth, 60) AS INTEGER) AS depth,
               bits >> CAST(60 - least(depth, 60) AS BIGINT) AS prefix,
               CASE WHEN depth > 60 THEN copy // greatest(1, {SHARD_BYTES} // greatest(bytes, 1)) ELSE 0 END AS part
        FROM ranked
    """,
}
