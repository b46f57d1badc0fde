"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import audio, bpe, html_crf, kneser_ney, lang_id, mixing, pii, simhash, token_files, topk
from docweave.llm.common import crc_mod, shared_folder, table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    about = kneser_ney.train(docs.filter(crc_mod(F.col("doc_id"), 7) != 2))
    out = kneser_ney.score(docs, about)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "tokens")
    shards = token_files.write_token_files(table(spark, sf_dir, "documents"), folder, _vocabulary("byte_bpe_50k.json"))
    return token_files.read_digests(spark, folder, shards)


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    model = lang_id.train(docs.filter(~held_out))
    return lang_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_crf.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = bpe.encode_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.audio_features(table(spark, sf_dir, "documents"), folder=shared_folder(spark, "patches"))
    return out.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),  # bytes; right() would take characters
        F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(":", "n_frames", F.crc32("patches"), F.size("segments"), F.round(F.coalesce(F.aggregate("segments", F.lit(0.0), lambda a, s: a + s.end_ms - s.start_ms), F.lit(0.0)), 1)).alias("feature"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)
    of_kind = lambda k: lambda s: s.kind == k
    count = [F.size(F.filter(base, of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return out.select("doc_id", *count, F.sha2(pii.joined(base).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {"op10_exact_top_k": op10_exact_top_k, "op1_kneser_ney": op1_kneser_ney, "op2_token_files": op2_token_files, "op3_lang_id": op3_lang_id, "op4_html_crf": op4_html_crf, "op5_mix_sources": op5_mix_sources, "op6_byte_bpe": op6_byte_bpe, "op7_simhash": op7_simhash, "op8_audio_features": op8_audio_features, "op9_pii": op9_pii}

ORACLE_SQL: dict[str, str] = {
    "op10_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = len(embedding)
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * c.vec[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
}
