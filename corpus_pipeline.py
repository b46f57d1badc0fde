"""A corpus pipeline: documents in, token ids of a clean, deduplicated, mixed corpus out.

Each stage is a function of (spark, docs, sf_dir). All but the last return the
columns of ``documents``. Between stages the rows are written as Parquet to the
shared folder and read again.
"""

from __future__ import annotations

import re

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import bpe, lang_id, mixing, near_copies, pii
from docweave.llm.common import by_position, cut_lineage, drop_written, row_hash, table

#: SQL can express none of language kernels, shingle classes, votes or merges.
ORACLE_SQL = None


def _column(docs: DataFrame, name: str) -> Column:
    """A column of ``by_position(docs)`` by its name in docs."""
    return F.col(f"_{docs.columns.index(name)}")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that have a language: only those without a letter (``und``) go.

    The score doesn't decide: it falls with the length of a text, very short or very long.
    Labelled rows of docs train the classifier; where no row is labelled, documents with letters stay.
    """
    model = lang_id.train(docs)
    out = lang_id.predict(docs, model, whole_rows=True)
    good = F.col("lang_pred") != "und" if model[0] else F.col("score") < 1
    return out.filter(good).select("row.*").toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id.

    Near-duplicates are joined by pairs whose five-word shingles have a Jaccard
    similarity of at least 0.8 (``near_copies``). Candidates are op7's balls of fingerprints
    and, since these can't reach that far, MinHash bands.
    Groups are of texts, not ids: unlike texts that share an id all stay. Where like
    texts share the smallest id, the one with the smallest digest stays. Rows without
    an id can't be ranked by it and stay.
    """
    base = by_position(docs)
    row, id_, text = F.struct("*").alias("row"), _column(docs, "doc_id"), _column(docs, "text")
    named = base.filter(id_.isNotNull()).select(row, id_.alias("id"), near_copies.text_digest(text).alias("digest"), row_hash(base).alias("h"))
    found = near_copies.near_copies(base.filter(id_.isNotNull()).select(id_.alias("doc_id"), text.alias("text")))
    first = named.select("id", "digest").join(found, "digest").groupBy("component").agg(F.min(F.struct("id", "digest")).alias("first"))
    kept = named.join(first.select("first.*"), ["id", "digest"], "left_semi")
    one = kept.groupBy("id", "digest").agg(F.min_by("row", "h").alias("row"))  # rows with the same id and text are one
    return one.select("row").unionByName(base.filter(id_.isNull()).select(row)).select("row.*").toDF(*docs.columns)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; n_chars follows. No document goes."""
    out = by_position(pii.redact(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn(f"_{docs.columns.index('n_chars')}", F.char_length(_column(docs, "text")).cast("long"))
    return out.toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the order of the mixing schedule: files, and rows in files, follow it. No document goes."""
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, digests of ids and decoded bytes, and its place in the mixed order.

    mix_position counts rows in the order of files and rows in files, which the
    stage before has laid out; null if docs don't come from files.
    """
    wanted = [F.col("doc_id"), F.col("text")]
    try:
        rows = docs.select(*wanted, F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("_metadata.row_index").alias("at"))
        rows.schema  # noqa: B018  files or not is known once the columns are resolved
    except AnalysisException:
        rows = docs.select(*wanted, F.lit(None).cast("string").alias("file"), F.lit(None).cast("long").alias("at"))
    files = [(r.file, r.n) for r in rows.groupBy("file").agg(F.count("*").alias("n")).collect() if r.file]  # a row for each file
    offsets, start = [], 0
    for name, n in sorted(files, key=lambda f: (int(re.match(r"(?:part-)?(\d*)", f[0])[1] or 0), f[0])):  # by number of the part: names of many parts don't sort
        offsets.append((name, start))
        start += n
    out = bpe.encode_documents(rows.select(F.struct("doc_id", "file", "at").alias("key"), "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, id_col="key", memo=bpe.SMALL_MEMO, matches=bpe.SMALL_MATCHES)
    out = out.select("key.*", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    first = F.broadcast(spark.createDataFrame(offsets, "file string, start long"))  # a row for each file
    return out.join(first, "file", "left").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", (F.col("start") + F.col("at")).alias("mix_position"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("redact_pii", redact_pii), ("mix_sources", mix_sources), ("tokenize", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, cut_lineage(stage(spark, docs, sf_dir), name)
        drop_written(before)
    return STAGES[-1][1](spark, docs, sf_dir)
