"""Article markup: files to records, sections and exclusions."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import text
from docweave.operators.common import row_index

FIELDS = ("title", "abstract", "body", "journal", "pub_date", "pub_year", "pmid", "pmcid", "article_type")
_SECTIONS = "array<struct<section_index:int,section_title:string,section_title_norm:string,section_text:string>>"
_SHAPE = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + f",sections:{_SECTIONS},section_titles:array<string>,parse_error:string>"


def list_files(spark: SparkSession, folder: str, glob: str = "*.xml", limit: int | None = None) -> DataFrame:
    """(path, source_file, content) of all files below folder, or of the first ``limit`` by path; nothing is read until content is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    root = folder.rstrip("/") + "/"
    out = files.select("path", F.regexp_replace("path", "^.*?" + _quoted(root), "").alias("source_file"), "content")
    if limit is None:
        return out
    first = out.select("path").orderBy("path").limit(limit)
    return out.join(first, "path", "left_semi")


def _quoted(s: str) -> str:
    return "\\Q" + s.split("://")[-1] + "\\E"


def require_files(files: DataFrame, expected: int | None = None) -> int:
    n = files.select("path").count()
    if not n or (expected is not None and n != expected):
        raise ValueError(f"{n} files found, {'some' if expected is None else expected} expected")
    return n


def _name(e: ET.Element) -> str:
    return e.tag.rsplit("}", 1)[-1] if isinstance(e.tag, str) else ""


def _text(e: ET.Element | None) -> str:
    """Text nodes joined by spaces, white space collapsed."""
    return "" if e is None else " ".join(" ".join(e.itertext()).split())


def _all(root: ET.Element | None, name: str, **attributes: str) -> list[ET.Element]:
    if root is None:
        return []
    return [e for e in root.iter() if e is not root and _name(e) == name and all(e.get(k.replace("_", "-")) == v for k, v in attributes.items())]


def _first(root: ET.Element | None, name: str, **attributes: str) -> ET.Element | None:
    return next(iter(_all(root, name, **attributes)), None)


def _date(root: ET.Element) -> tuple[str, str]:
    dates = [_first(root, "pub-date", **({"pub_type": k} if k else {})) for k in ("epub", "ppub", "collection", None)]
    for d in (x for x in dates if x is not None):
        y, m, day = (_text(_first(d, n)) for n in ("year", "month", "day"))
        if y:
            pad = lambda x: x.zfill(2) if x.isdigit() else x
            return "-".join([y, *map(pad, filter(None, (m, day)))]), y
    y = _text(_first(root, "year"))
    return y, y


def top_sections(markup: str, whole_body: bool = True) -> list[dict]:
    """The direct sections of an article's body, untitled ones named by number; without any, the whole body as one (if whole_body)."""
    try:
        root = ET.fromstring(markup)
    except ET.ParseError:
        return []
    body = root if _name(root) == "body" else _first(root, "body")
    out = []
    for k, section in enumerate(c for c in (body if body is not None else ()) if _name(c) == "sec"):
        title = next((c for c in section if _name(c) == "title"), None)
        inner = [section.text, *(t for c in section for t in ((c.tail,) if c is title else (*c.itertext(), c.tail)))]
        words = " ".join(" ".join(filter(None, inner)).split())
        if words:
            out.append({"section_index": k, "section_title": _text(title) or f"Body section {k + 1}", "section_text": words, "section_source": "xml_top_level_sec"})
    if not out and whole_body and (words := _text(body)):
        out.append({"section_index": 0, "section_title": "Body", "section_text": words, "section_source": "xml_body_fallback"})
    return out


def parse_top_sections(df: DataFrame, content: str = "content", whole_body: bool = True) -> DataFrame:
    """df with an array ``sections`` of :func:`top_sections`; malformed bytes are left out."""

    @F.pandas_udf("array<struct<section_index:int,section_title:string,section_text:string,section_source:string>>")
    def parse(data: pd.Series) -> pd.Series:
        return data.map(lambda b: top_sections(b if isinstance(b, str) else bytes(b or b"").decode("utf-8", errors="ignore"), whole_body))

    return df.withColumn("sections", parse(content))


def _sections(body: ET.Element | None) -> tuple[list[dict], list[str]]:
    if body is None:
        return [], []
    every = _all(body, "sec")
    direct = [e for e in body if _name(e) == "sec"] or every
    out = []
    for k, sec in enumerate(direct):
        own = next((c for c in sec if _name(c) == "title"), None)
        name = _text(own)
        if not name:
            continue
        rest = " ".join(" ".join(t for c in sec if c is not own for t in (*c.itertext(), c.tail or "")).split())
        lead = " ".join((sec.text or "").split())
        tail = " ".join((own.tail or "").split())
        whole = " ".join(filter(None, (lead, tail, rest)))
        if whole:
            out.append({"section_index": k, "section_title": name, "section_title_norm": name.lower(), "section_text": whole})
    titles = [t for s in every if (t := _text(next((c for c in s if _name(c) == "title"), None)))]
    return out, titles


def parse_article(markup: str) -> dict:
    """Fields, sections and section titles of one article; parse_error says why there are none."""
    empty = dict.fromkeys(FIELDS, "") | {"sections": [], "section_titles": [], "parse_error": None}
    try:
        top = ET.fromstring(markup)
    except ET.ParseError as e:
        return empty | {"parse_error": str(e)}
    root = ET.Element("root")
    root.append(top)
    article, body = _first(root, "article"), _first(root, "body")
    date, year = _date(root)
    ident = lambda k: _text(_first(root, "article-id", pub_id_type=k))
    sections, titles = _sections(body)
    return {
        "title": _text(_first(root, "article-title")),
        "abstract": _text(_first(root, "abstract")),
        "body": _text(body),
        "journal": _text(_first(root, "journal-title")) or _text(_first(root, "journal-id")),
        "pub_date": date,
        "pub_year": year,
        "pmid": ident("pmid"),
        "pmcid": ident("pmc") or ident("pmcid").replace("PMC", ""),
        "article_type": "" if article is None else article.get("article-type", ""),
        "sections": sections,
        "section_titles": titles,
        "parse_error": None,
    }


def parse_markup(df: DataFrame, content: str = "content") -> DataFrame:
    """df with parsed fields in place of its content; malformed bytes become replacement characters."""

    @F.pandas_udf(_SHAPE)
    def parse(data: pd.Series) -> pd.DataFrame:
        rows = [parse_article((b if isinstance(b, str) else bytes(b or b"").decode("utf-8", errors="replace"))) for b in data]
        return pd.DataFrame(rows, columns=[*FIELDS, "sections", "section_titles", "parse_error"])

    return df.withColumn("_p", parse(content)).select(*[c for c in df.columns if c != content], "_p.*")


def records(files: DataFrame) -> DataFrame:
    """Records with ids ``pmc_000001`` and on in the order of paths, and joined texts."""
    numbered = row_index(files, "path", name="_n")
    out = parse_markup(numbered)
    pmcid = F.when(F.col("pmcid") == "", "").when(F.upper("pmcid").startswith("PMC"), F.col("pmcid")).otherwise(F.concat(F.lit("PMC"), F.col("pmcid")))
    return out.select(
        F.format_string("pmc_%06d", F.col("_n") + 1).alias("record_id"), "source_file", *[F.col(f) if f != "pmcid" else pmcid.alias("pmcid") for f in FIELDS],
        text.join_parts(F.col("title"), F.col("abstract")).alias("text_title_abstract"), text.join_parts(F.col("title"), F.col("abstract"), F.col("body")).alias("text_full"),
        "sections", "section_titles", "parse_error",
    )


def light_records(records_: DataFrame) -> DataFrame:
    """Records without texts: flags, lengths, estimates, section kinds, route, quality."""
    flags = text.section_flags(F.col("section_titles"))
    n_abs, n_full = text.approx_token_len("text_title_abstract"), text.approx_token_len("text_full")
    bad = F.contains("text_full", F.lit("\ufffd"))
    has = F.size("section_titles") > 0
    return records_.select(
        text.analysis_doc_id("pmid", "pmcid", "record_id").alias("doc_id"), "record_id", "source_file", "title", "journal", "pub_date", "pub_year", "pmid", "pmcid", "article_type",
        *[text.is_empty(f).alias(f"{f}_missing") for f in ("title", "abstract", "body")], bad.alias("encoding_issue"),
        ((F.length(F.btrim("abstract")) < 50) | (text.word_count("abstract") < 20)).alias("too_short_abstract"),
        n_abs.alias("title_abstract_token_len"), n_full.alias("full_token_len"), text.chunk_estimate(n_abs).alias("estimated_chunks_title_abstract"), text.chunk_estimate(n_full).alias("estimated_chunks_full"),
        F.size("section_titles").alias("section_title_count"), has.alias("has_any_section_title"), *[c.alias(f"has_{k}") for k, c in flags.items()],
        (flags["introduction"] & flags["methods"] & flags["results"] & flags["discussion"]).alias("imrad_core"), text.section_label(*(flags[k] for k in text.SECTION_PATTERNS)).alias("section_label"),
        text.route(n_full, has).alias("route"), text.quality_of_record("title", "abstract", "body", bad).alias("quality_decision"), text.text_hash("text_title_abstract").alias("text_hash"),
    )


def base_documents(records_: DataFrame, length: Column | None = None) -> DataFrame:
    """What chunking needs of records: ids, texts, token lengths, what is missing and a note on encoding.

    length: the token length of title and body, if it isn't the default.
    """
    both = text.join_parts(F.col("title"), F.col("body"))
    return records_.select(
        text.chunk_doc_id("pmcid", "pmid", "source_file").alias("doc_id"), "source_file", "title", "abstract", "body", "journal", "pub_date", "pub_year", "pmid", "pmcid", "article_type", "sections",
        (text.approx_token_len(both) if length is None else length).alias("token_len"), text.approx_token_len("body").alias("body_token_len"),
        text.is_empty("title").alias("title_missing"), text.is_empty("abstract").alias("abstract_missing"), text.is_empty("body").alias("body_missing"),
        text.encoding_note(F.concat_ws("\n", "title", "abstract", "body")).alias("encoding_note"), "parse_error",
    )


def preview(files: DataFrame, most: int = 300) -> DataFrame:
    """Fields of the first article by path and the first characters of its texts: one row."""
    one = parse_markup(files.orderBy("path").limit(1))
    return one.select("source_file", "title", "journal", "pub_date", "pmid", "pmcid", "article_type", *[text.preview(c, most).alias(c) for c in ("abstract", "body")], F.size("section_titles").alias("section_titles"))
