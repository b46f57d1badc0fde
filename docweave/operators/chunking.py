"""Splitting documents into token-budgeted chunks.

Splitting is a recursion over separators with overlapping merges, which column
expressions can't give; it runs in Arrow batches, one document at a time, and so
do the choice of route and the numbering, which need the same counts. Quality and
the checks of chunk tables are column expressions.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docweave.functions import text
from docweave.operators.common import spread

#: From coarse to fine; the last cuts between characters.
SEPARATORS = ("\n\n", "\n", ". ", "; ", ", ", " ", "")
SIZE, OVERLAP, LIMIT = 400, 80, 512
_TOKEN = re.compile(text.APPROX_TOKEN)


def approx_len(s: str) -> int:
    return len(_TOKEN.findall(s or ""))


def tokenizer_length(path: str, special: bool = True) -> Callable[[str], int]:
    """Token length by a tokenizer file, special tokens included; blank texts have 0. The file must be readable on every worker."""
    loaded: list = []

    def length(s: str | None) -> int:
        if not s or not s.strip():
            return 0
        if not loaded:
            from tokenizers import Tokenizer

            loaded.append(Tokenizer.from_file(path))
        return len(loaded[0].encode(s, add_special_tokens=special).ids)

    return length


def _cut(s: str, sep: str) -> list[str]:
    """Parts of s; a separator opens the part after it."""
    if not sep:
        return list(s)
    head, *rest = s.split(sep)
    return [p for p in (head, *(sep + r for r in rest)) if p]


def _pack(parts: list[tuple[str, int]], size: int, overlap: int) -> list[str]:
    """Runs of parts (text, length) within size, each starting with the parts that end the run before, within overlap."""
    out: list[str] = []
    run: deque[tuple[str, int]] = deque()
    total = 0
    for p, n in parts:
        if run and total + n > size:
            out.append("".join(x for x, _ in run).strip())
            while run and (total > overlap or total + n > size):
                total -= run.popleft()[1]
        run.append((p, n))
        total += n
    out.append("".join(x for x, _ in run).strip())
    return [x for x in out if x]


def split_text(s: str, size: int = SIZE, overlap: int = OVERLAP, length: Callable[[str], int] = approx_len, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Pieces of s of at most size where separators allow it, the coarsest separator that occurs first."""
    if overlap >= size:
        raise ValueError("the overlap must be smaller than the size")
    k = next((i for i, sep in enumerate(separators) if not sep or sep in s), len(separators) - 1)
    finer = separators[k + 1 :]
    out: list[str] = []
    fitting: list[tuple[str, int]] = []
    for part in _cut(s, separators[k]):
        n = length(part)
        if n < size:
            fitting.append((part, n))
            continue
        if fitting:
            out += _pack(fitting, size, overlap)
            fitting = []
        out += split_text(part, size, overlap, length, finer) if finer else [part]
    return out + (_pack(fitting, size, overlap) if fitting else [])


def prefix(title: str, section: str) -> str:
    """What stands before a chunk's own text."""
    return "Title: %s\nSection: %s\nText:\n" % (title, section)


#: What the budget of a piece leaves free and its least size; the share of a piece that repeats; finer sizes, as shares of the budget, and their least.
SPARE, LEAST, LAP_SHARE, FINER = 8, 32, 5, ((1, 0), (2, 24), (3, 16), (4, 12))


def pieces_within(body: str, title: str, section: str, size: int = SIZE, overlap: int = OVERLAP, limit: int = LIMIT, length: Callable[[str], int] = approx_len) -> list[tuple[str, int]]:
    """Pieces of body that stay within limit with their prefix, each with the length of both.

    The prefix is measured once and what it leaves of the limit is the room of each
    piece. A body without room is split at a budget somewhat below the room; a piece
    that still has none is split alone, at finer and finer sizes.
    """
    taken = length(prefix(title, section).strip())
    room, budget = limit - taken, min(size, max(LEAST, limit - taken - SPARE))
    lap = min(overlap, budget // LAP_SHARE)
    sizes = [budget, *(max(budget // part, least) for part, least in FINER)]
    out: list[tuple[str, int]] = []
    waiting = [(" ".join((body or "").split()), 0)]  # the next piece last
    while waiting:
        piece, level = waiting.pop()
        if not piece:
            continue
        n = length(piece)
        if n <= room or level == len(sizes):
            out.append((piece, taken + n))
            continue
        step = sizes[level]
        parts = split_text(piece, step, min(lap, step // LAP_SHARE), length)
        waiting += [(" ".join(p.split()), level + 1) for p in reversed(parts or [piece])]
    return out


def split_to_limit(body: str, title: str, section: str, size: int = SIZE, overlap: int = OVERLAP, limit: int = LIMIT, length: Callable[[str], int] = approx_len) -> list[str]:
    return [p for p, _ in pieces_within(body, title, section, size, overlap, limit, length)]


def splitter(size: int = SIZE, overlap: int = OVERLAP, length: Callable[[str], int] = approx_len, keep_under: int = 0):
    """UDF text -> pieces; texts of at most keep_under tokens stay whole (0: none do)."""

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        def one(s: str | None) -> list[str]:
            if not s or not s.strip():
                return []
            return [s] if keep_under and length(s) <= keep_under else split_text(s, size, overlap, length)

        return texts.map(one)

    return split.asNondeterministic()  # else it runs once more in a filter that explode adds


def split_or_keep(size: int = SIZE, overlap: int = OVERLAP, keep_under: int = LIMIT, length: Callable[[str], int] = approx_len):
    """UDF text -> (pieces, how): whole if it is within keep_under tokens, else split."""

    @F.pandas_udf("struct<pieces:array<string>,how:string>")
    def split(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for s in texts:
            if not s or not s.strip():
                rows.append(([], "empty"))
            elif length(s) <= keep_under:
                rows.append(([s], "section_whole_under_512"))
            else:
                rows.append((split_text(s, size, overlap, length), "section_recursive_over_512"))
        return pd.DataFrame(rows, columns=["pieces", "how"])

    return split


_SECTION = "array<struct<section_index:int,section_title:string,section_title_norm:string,section_text:string>>"


#: What a chunk has besides its document's columns.
_CHUNK = "chunk_id string, text string, chunk_index int, total_chunks int, token_count int, section_title string, section_title_norm string, split_strategy string, title_missing boolean, body_missing boolean, chunk_char_len int, section_index int, section_chunk_index int"
#: Chunks of an output batch.
_ROWS = 4096


def chunks_of(doc_id: str, title: str | None, body: str | None, sections: list[dict] | None, size: int = SIZE, overlap: int = OVERLAP, limit: int = LIMIT, length: Callable[[str], int] = approx_len) -> list[tuple]:
    """The chunks of a document in order, each with the values of _CHUNK."""
    own, whole = (title or "").strip(), (body or "").strip()
    named = title if own else f"[Missing title: {doc_id}]"
    full = "\n\n".join(filter(None, (own, whole)))
    some = [s for s in sections or () if (s["section_text"] or "").strip()]
    if length(full) <= limit:
        route, parts = "whole_document_under_512", [{"section_index": 0, "section_title": "whole_document", "section_title_norm": "whole_document", "section_text": body}]
    elif some:
        route, parts = "semantic_section", some
    else:
        route, parts = "recursive_fallback_no_section", [{"section_index": 0, "section_title": "full_text", "section_title_norm": "full_text", "section_text": full}]
    found = [(s, k, p, n) for s in parts for k, (p, n) in enumerate(pieces_within(s["section_text"] or "", named, s["section_title"] or "", size, overlap, limit, length))]
    return [
        (f"{doc_id}::chunk_{i:05d}", prefix(named, s["section_title"] or "") + p, i, len(found), n, s["section_title"], s["section_title_norm"], route, not own, not whole, len(p), s["section_index"], k)
        for i, (s, k, p, n) in enumerate(found)
    ]


def chunk_documents(docs: DataFrame, size: int = SIZE, overlap: int = OVERLAP, limit: int = LIMIT, length: Callable[[str], int] = approx_len) -> DataFrame:
    """One row for each chunk.

    docs: doc_id, title, abstract, body, sections (array of section_index,
    section_title, section_title_norm, section_text), pmid, and any more columns,
    which are carried. A document within the limit is one section of its body; one
    with sections is split section by section; any other is split as a whole, and
    so is one whose sections give nothing.

    All chunks of a row are made together and numbered as they come, so there is no
    shuffle, and neither body nor sections are carried beyond the split. A document
    without text has no chunk.
    """
    kept = [c for c in docs.columns if c not in ("body", "sections", "abstract")]
    names = [n.split()[0] for n in _CHUNK.split(", ")]
    asked = docs.select(*kept, F.col("doc_id").cast("string").alias("_id"), F.col("title").alias("_title"), "body", F.col("sections").cast(_SECTION).alias("sections"))
    carried = docs.select(*kept).schema
    schema = T.StructType([*carried.fields, *T.StructType.fromDDL(_CHUNK).fields])
    made = to_arrow_schema(T.StructType.fromDDL(_CHUNK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            for i, (doc_id, title, body, sections) in enumerate(zip(*(c.to_pylist() for c in batch.columns[len(kept) :]), strict=True)):
                found = chunks_of(doc_id, title, body, sections, size, overlap, limit, length)
                at += [i] * len(found)
                rows += found
                if rows and (len(rows) >= _ROWS or i == batch.num_rows - 1):
                    yield _with_chunks(batch, len(kept), at, rows, made)
                    at, rows = [], []
            if rows:
                yield _with_chunks(batch, len(kept), at, rows, made)

    out = spread(asked).mapInArrow(run, schema)
    return out.select("chunk_id", "text", *[c for c in kept if c not in names], *[n for n in names if n not in ("chunk_id", "text")])


def _with_chunks(batch: pa.RecordBatch, kept: int, at: list[int], rows: list[tuple], made: pa.Schema) -> pa.RecordBatch:
    """Chunk rows beside the carried columns of their documents."""
    index = pa.array(at, pa.int64())
    columns = [c.take(index) for c in batch.columns[:kept]] + [pa.array(values, f.type) for values, f in zip(zip(*rows, strict=True), made, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:kept], *made.names])


def with_front_section(docs: DataFrame) -> DataFrame:
    """docs with title and abstract as a first section, before the others."""
    body = text.join_parts(F.col("title"), F.col("abstract"))
    front = F.array(F.struct(F.lit(-1).alias("section_index"), F.lit("Title and abstract").alias("section_title"), F.lit("title and abstract").alias("section_title_norm"), body.alias("section_text"))).cast(_SECTION)
    rest = F.coalesce(F.col("sections").cast(_SECTION), F.array().cast(_SECTION))
    return docs.withColumn("sections", F.when(body == "", rest).otherwise(F.concat(front, rest)))


def chunk_abstracts(docs: DataFrame, text_col: str = "text_title_abstract", id_col: str = "doc_id", size: int = SIZE, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """(id, chunk_index, text) of short texts: whole within the limit, else split; blank ones give none."""
    pieces = docs.filter(~text.is_empty(text_col)).select(id_col, splitter(size, overlap, keep_under=limit)(F.col(text_col)).alias("p"))
    return pieces.select(id_col, F.posexplode("p").alias("chunk_index", "text"))


def exclusion_reason(parse_error: Column, duplicate: Column, title: Column, abstract: Column, body: Column, note: Column, tokens: Column) -> Column:
    """Why a document isn't chunked, the first reason that holds; null if it is."""
    t, a, b = (text.is_empty(c) for c in (title, abstract, body))
    return (
        F.when(parse_error, "xml_parse_error").when(duplicate, "duplicate_pmcid").when(t & a & b, "drop_no_text").when(b, "no_body_for_fulltext")
        .when(note.startswith("severe") & (tokens <= 0), "severe_encoding_issue")
    )


def compare_strategies(docs: DataFrame, text_col: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Chunks and tokens of three ways to split: whole, sliding, and by paragraph."""
    split, docs = splitter(size, overlap), spread(docs.select(text_col))
    whole = docs.select(F.lit("whole").alias("strategy"), F.col(text_col).alias("chunk"))
    sliding = docs.select(F.lit("sliding").alias("strategy"), F.explode(split(F.col(text_col))).alias("chunk"))
    parts = docs.select(F.explode(F.filter(F.split(text.text_of(text_col), "\n"), lambda p: F.btrim(p) != "")).alias("p"))
    section = parts.select(F.lit("section").alias("strategy"), F.explode(split("p")).alias("chunk"))
    n = text.approx_token_len("chunk")
    return whole.unionByName(sliding).unionByName(section).groupBy("strategy").agg(F.count("*").alias("chunks"), F.sum(n).alias("tokens"), F.max(n).alias("max_tokens"))


def integrity(chunks: DataFrame) -> DataFrame:
    """One row of counts that should be zero in a sound chunk table, and its size; two levels of grouping, no pass over documents one by one."""
    docs = chunks.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("chunk_index").alias("top"), F.min("chunk_index").alias("low"), F.count_distinct("chunk_index").alias("d"), F.min("total_chunks").alias("t0"), F.max("total_chunks").alias("t1"), F.count_if(F.col("split_strategy") == "recursive_fallback_no_section").alias("fallback"))
    per_doc = docs.agg(
        F.count("*").alias("documents"), F.count_if((F.col("top") != F.col("n") - 1) | (F.col("low") != 0) | (F.col("d") != F.col("n"))).alias("index_gaps"),
        F.count_if((F.col("t0") != F.col("n")) | (F.col("t1") != F.col("n"))).alias("wrong_totals"), F.count_if((F.col("n") > 1) & (F.col("fallback") > 0)).alias("multi_chunk_fallback_documents"),
    )
    body = F.btrim(text.text_of("text"))
    rows = chunks.agg(
        F.count("*").alias("chunks"), F.count_if(F.col("token_count") > LIMIT).alias("over_limit"), F.count_if(F.col("token_count") <= 0).alias("no_tokens"),
        F.count_if(body == "").alias("empty"), F.count_if(F.length(body) < 20).alias("short"), F.count_if(F.contains("text", F.lit("\ufffd"))).alias("garbled"),
        F.count_if(text.is_empty("chunk_id") | text.is_empty("doc_id")).alias("missing_ids"), F.count_if(text.is_empty("section_title")).alias("section_title_missing"),
    )
    twice = chunks.groupBy("chunk_id").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_chunk_ids"))
    return rows.crossJoin(per_doc).crossJoin(twice)  # one row each
