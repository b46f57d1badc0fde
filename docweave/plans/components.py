"""Queries over single components (sources, sinks, text rules, builds), each with the same in SQL where SQL can say it.

What a query writes goes to a folder of its own in the shared folder and is read back from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave import embed
from docweave.functions import numeric, text, udf
from docweave.operators import bm25, chunking, evaluation, filters, profile, reporting, understanding, vectors
from docweave.operators.common import dedupe_ci
from docweave.operators.vector_index import VectorIndex
from docweave.plans.queries import _BM25, _FINAL, _JUDGED, _KNN, _final, _judged, _r, query, records, table
from docweave.plans.retrieval import Retrieval, smoke
from docweave.sources import articles, environment, tables
from docweave.storage import checkpoint_dir
from docweave.streaming import ingest


def _folder(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/query-{name}-{uuid.uuid4().hex}"


# sources and sinks


@query("SELECT doc_id::VARCHAR AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents")
def csv_text(spark, sf_dir):
    path = _folder(spark, "csv")
    tables.write_csv(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return tables.read_csv(spark, path, columns=["doc_id", "text", "lang"], required=("doc_id",))


@query("SELECT event_id, user_id, event_type, value FROM events")
def csv_typed(spark, sf_dir):
    path = _folder(spark, "csv")
    tables.write_csv(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"), path)
    return tables.read_csv(spark, path, "event_id long, user_id long, event_type string, value double")


@query("SELECT n_regionkey AS region, 2 * count(*) AS rows FROM nation GROUP BY 1")
def csv_append(spark, sf_dir):
    path, n = _folder(spark, "csv"), table(spark, sf_dir, "nation")
    for _ in range(2):
        tables.write_csv(n, path, mode="append")
    return tables.read_csv(spark, path, n.schema).groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("rows"))


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_text(spark, sf_dir):
    path = _folder(spark, "jsonl")
    tables.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), path)
    return tables.read_jsonl(spark, path, "doc_id long, text string, lang string")


@query("SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 100")
def jsonl_sample(spark, sf_dir):
    path = _folder(spark, "jsonl")
    tables.sample_jsonl(table(spark, sf_dir, "documents").select("doc_id", "source"), path, ["source", "doc_id"], 100)
    return tables.read_jsonl(spark, path, "doc_id long, source string")


def _parts(spark, sf_dir, n: int = 5) -> tuple[str, str]:
    """(manifest, folder) of documents in n parts by number."""
    path, d = _folder(spark, "parts"), table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    for i in range(n):
        tables.write_parquet(d.filter(F.col("doc_id") % n == i), f"{path}/chunks/docs_part_{i:03d}.parquet")
    rows = d.groupBy((F.col("doc_id") % n).alias("part_id")).agg(F.count("*").alias("chunk_count"))
    named = rows.select("part_id", F.format_string("some/where/docs_part_%03d.parquet", "part_id").alias("part_file"), "chunk_count")
    tables.write_csv(named, f"{path}/manifest", single=True)
    return f"{path}/manifest", f"{path}/chunks"


@query("SELECT CAST(doc_id % 5 AS INTEGER) AS part_id, doc_id, lang FROM documents WHERE doc_id % 5 IN (0, 2, 3)")
def manifest_parts(spark, sf_dir):
    manifest, folder = _parts(spark, sf_dir)
    return tables.read_parts(spark, manifest, folder, filters.part_ids("0,2-3")).select("part_id", "doc_id", "lang")


@query("SELECT CAST(doc_id % 5 AS INTEGER) AS part_id, doc_id FROM documents ORDER BY 1, 2 LIMIT 250")
def budgeted_scan(spark, sf_dir):
    manifest, folder = _parts(spark, sf_dir)
    return tables.read_budgeted(spark, manifest, folder, ["doc_id"], ["doc_id"], 250)


@query("SELECT least((SELECT count(*) FROM documents WHERE doc_id % 5 IN (1, 4)), 150) AS expected, (SELECT count(*) FROM documents) AS unlimited")
def row_budgets(spark, sf_dir):
    manifest, _ = _parts(spark, sf_dir)
    rows = [(tables.row_budget(spark, manifest, {1, 4}, 150), tables.row_budget(spark, manifest))]
    return spark.createDataFrame(rows, "expected long, unlimited long")


@query("SELECT 0::BIGINT AS empty, (SELECT count(*) FROM region) AS replaced, true AS refused")
def part_policies(spark, sf_dir):
    """An empty part can be read; a second write is refused, or replaces what was there."""
    path, nations = _folder(spark, "policy"), table(spark, sf_dir, "nation")
    tables.write_parquet(nations.limit(0), f"{path}/empty")
    tables.write_parquet(nations, f"{path}/full")
    refused = False
    try:
        tables.write_parquet(nations, f"{path}/full")
    except Exception:
        refused = True
    tables.write_parquet(table(spark, sf_dir, "region"), f"{path}/full", mode="overwrite")
    return spark.createDataFrame([(spark.read.parquet(f"{path}/empty").count(), spark.read.parquet(f"{path}/full").count(), refused)], "empty long, replaced long, refused boolean")


@query("SELECT count(*) AS documents, 'run/manifest.csv' AS source_manifest, 'index.parquet' AS index_path, '' AS chunk_store_path FROM documents")
def stats_document(spark, sf_dir):
    path = _folder(spark, "stats")
    stats = table(spark, sf_dir, "documents").agg(F.count("*").alias("documents")).select("documents", F.lit("/project/run/manifest.csv").alias("source_manifest"), F.lit("/else/where/index.parquet").alias("index_path"), F.lit("").alias("chunk_store_path"))
    tables.write_stats(reporting.public_paths(stats, "/project", ("source_manifest", "index_path", "chunk_store_path")), path)
    return tables.read_jsonl(spark, path, "documents long, source_manifest string, index_path string, chunk_store_path string")


@query("SELECT '| r_regionkey | r_name |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || r_regionkey || ' | ' || r_name || ' |', chr(10) ORDER BY r_regionkey) AS report FROM region")
def markdown_report(spark, sf_dir):
    rows = table(spark, sf_dir, "region").select("r_regionkey", "r_name").orderBy("r_regionkey")
    return spark.createDataFrame([(tables.markdown(rows),)], "report string")


_CHUNKLIKE = "WITH c AS (SELECT conv_id::VARCHAR AS doc_id, CAST(turn AS INTEGER) AS chunk_index, CAST(count(*) OVER (PARTITION BY conv_id) AS INTEGER) AS total_chunks, role AS split_strategy, contains(text, '?') AS title_missing, text FROM conversations)"


def _chunklike(spark, sf_dir) -> DataFrame:
    """Conversations as a chunk table."""
    c = table(spark, sf_dir, "conversations")
    n = c.groupBy("conv_id").agg(F.count("*").cast("int").alias("total_chunks"))
    return c.join(n, "conv_id").select(F.col("conv_id").cast("string").alias("doc_id"), F.col("turn").cast("int").alias("chunk_index"), "total_chunks", F.col("role").alias("split_strategy"), F.contains("text", F.lit("?")).alias("title_missing"), "text")


@query(_CHUNKLIKE + """, e AS (SELECT 'strategy:' || split_strategy AS why, *, row_number() OVER (PARTITION BY split_strategy ORDER BY doc_id, chunk_index) AS k FROM c),
t AS (SELECT 'title_missing' AS why, * FROM c WHERE title_missing ORDER BY doc_id, chunk_index LIMIT 1), m AS (SELECT 'multi_chunk' AS why, * FROM c WHERE total_chunks > 1 ORDER BY doc_id, chunk_index LIMIT 4)
SELECT why, doc_id, chunk_index, split_strategy FROM e WHERE k = 1 UNION ALL SELECT why, doc_id, chunk_index, split_strategy FROM t UNION ALL SELECT why, doc_id, chunk_index, split_strategy FROM m""")
def preview_rows(spark, sf_dir):
    return tables.previews(_chunklike(spark, sf_dir)).select("why", "doc_id", "chunk_index", "split_strategy")


@query("""WITH q AS (SELECT quantile_cont(n_chars, 0.25) AS q1, median(n_chars) AS median, quantile_cont(n_chars, 0.75) AS q3 FROM documents)
SELECT q1, median, q3, min(n_chars) FILTER (WHERE n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS low, max(n_chars) FILTER (WHERE n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))::DOUBLE AS high,
 count(*) FILTER (WHERE NOT n_chars BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers FROM documents, q GROUP BY 1, 2, 3""")
def box_summary(spark, sf_dir):
    return profile.box(table(spark, sf_dir, "documents"), "n_chars")


@query()
def environment_probe(spark, sf_dir):
    return environment.probe(spark, sf_dir, "*.parquet").select("item", "status")


@query()
def embedding_worker(spark, sf_dir):
    made = embed.embed_texts(spark, ["metformin", "", "lung cancer"], dim=16)
    return spark.createDataFrame([(made["model"], i, v) for i, v in enumerate(made["embeddings"])], "model string, i int, embedding array<double>")


# articles: one file for each nation

_ARTICLE = """<?xml version="1.0"?><pmc><article article-type="{kind}"><front><journal-meta><journal-title>{journal}</journal-title></journal-meta><article-meta><article-id pub-id-type="pmid">{pmid}</article-id><article-id pub-id-type="pmc">{pmc}</article-id><title-group><article-title>On <b>{name}</b></article-title></title-group><pub-date pub-type="ppub"><year>{year}</year><month>{month}</month></pub-date><abstract><p>{name} lies in {region}.</p></abstract></article-meta></front><body><sec><title>Introduction</title><p>{name}  came first.</p></sec><sec><p>No title in {region}.</p></sec><sec><title>Methods</title><p>Measured.</p><sec><title>Results</title><p>Nested {name}.</p></sec></sec></body></article></pmc>"""
_NATIONS = """WITH a AS (SELECT n_nationkey AS k, n_name AS name, r_name AS region, CASE WHEN n_nationkey % 2 = 0 THEN 'research-article' ELSE 'review-article' END AS article_type, CASE WHEN n_nationkey % 3 = 0 THEN 'PLoS ONE' ELSE 'BMC ' || r_name END AS journal,
 CASE WHEN n_nationkey % 5 = 4 THEN '' ELSE (1000 + n_nationkey)::VARCHAR END AS pmid, (2000 + n_nationkey)::VARCHAR AS pmc, (1990 + n_nationkey)::VARCHAR AS pub_year, (n_nationkey % 12 + 1)::VARCHAR AS month FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _article_files(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("n_nationkey")
    fill = {
        "kind": F.when(k % 2 == 0, "research-article").otherwise("review-article"), "journal": F.when(k % 3 == 0, "PLoS ONE").otherwise(F.concat(F.lit("BMC "), "r_name")), "pmid": F.when(k % 5 == 4, "").otherwise((1000 + k).cast("string")),
        "pmc": (2000 + k).cast("string"), "name": F.col("n_name"), "region": F.col("r_name"), "year": (1990 + k).cast("string"), "month": (k % 12 + 1).cast("string"),
    }
    markup = F.lit(_ARTICLE)
    for name, c in fill.items():
        markup = F.replace(markup, F.lit("{" + name + "}"), c)
    path = _folder(spark, "articles")
    n.select(F.format_string("%03d", k).alias("n"), markup.alias("value")).repartition("n").write.partitionBy("n").text(path)
    return articles.list_files(spark, path, "*.txt")


@query(_NATIONS + """SELECT 'pmc_' || lpad((row_number() OVER (ORDER BY k))::VARCHAR, 6, '0') AS record_id, 'On ' || name AS title, name || ' lies in ' || region || '.' AS abstract, journal, pub_year || '-' || lpad(month, 2, '0') AS pub_date, pub_year, pmid, 'PMC' || pmc AS pmcid, article_type,
 'On ' || name || chr(10) || chr(10) || name || ' lies in ' || region || '.' AS text_title_abstract, 'Introduction ' || name || ' came first. No title in ' || region || '. Methods Measured. Results Nested ' || name || '.' AS body FROM a""")
def article_records(spark, sf_dir):
    return articles.records(_article_files(spark, sf_dir)).select("record_id", "title", "abstract", "journal", "pub_date", "pub_year", "pmid", "pmcid", "article_type", "text_title_abstract", "body")


@query(_NATIONS + """SELECT 'PMC' || pmc AS pmcid, s.i AS section_index, s.t AS section_title, lower(s.t) AS section_title_norm, s.x AS section_text FROM a, LATERAL (VALUES (0, 'Introduction', name || ' came first.'), (2, 'Methods', 'Measured. Results Nested ' || name || '.')) s(i, t, x)""")
def article_sections(spark, sf_dir):
    return articles.records(_article_files(spark, sf_dir)).select("pmcid", F.inline("sections"))


@query(_NATIONS + """SELECT k, s.i AS section_index, s.t AS section_title, s.x AS section_text, 'xml_top_level_sec' AS section_source FROM a, LATERAL (VALUES (0, 'Introduction', name || ' came first.'), (1, 'Body section 2', 'No title in ' || region || '.'), (2, 'Methods', 'Measured. Results Nested ' || name || '.')) s(i, t, x)""")
def article_top_sections(spark, sf_dir):
    f = articles.parse_top_sections(_article_files(spark, sf_dir))
    return f.select(F.regexp_extract("path", "n=([0-9]+)", 1).cast("int").alias("k"), F.inline("sections"))


@query("SELECT 'introduction' AS section_title, count(*) AS count FROM nation UNION ALL SELECT 'methods', count(*) FROM nation UNION ALL SELECT 'results', count(*) FROM nation")
def section_title_counts(spark, sf_dir):
    return profile.section_titles(articles.records(_article_files(spark, sf_dir)), "section_titles")


@query("SELECT count(*) AS files, 10::BIGINT AS first_ten FROM nation")
def article_files(spark, sf_dir):
    files = _article_files(spark, sf_dir)
    n = articles.require_files(files)
    root = files.first().path.rsplit("/n=", 1)[0]
    return spark.createDataFrame([(n, articles.list_files(spark, root, "*.txt", 10).count())], "files long, first_ten long")


@query(_NATIONS + """SELECT CASE WHEN pmid <> '' THEN 'PMID:' || pmid ELSE 'PMC' || pmc END AS doc_id, 3::INTEGER AS section_title_count, true AS has_introduction, true AS has_methods, true AS has_results, false AS has_discussion, false AS imrad_core, 'B/I+M+R' AS section_label, 'whole_document_under_512' AS route, 'keep' AS quality_decision, true AS too_short_abstract FROM a""")
def light_articles(spark, sf_dir):
    out = articles.light_records(articles.records(_article_files(spark, sf_dir)))
    return out.select("doc_id", F.col("section_title_count").cast("int").alias("section_title_count"), "has_introduction", "has_methods", "has_results", "has_discussion", "imrad_core", "section_label", "route", "quality_decision", "too_short_abstract")


@query(_NATIONS + """SELECT 'PMCID:PMC' || pmc AS doc_id, false AS body_missing, '' AS encoding_note, CAST(len(regexp_extract_all('On ' || name || ' Introduction ' || name || ' came first. No title in ' || region || '. Methods Measured. Results Nested ' || name || '.', '[A-Za-z][A-Za-z0-9_+-]*|[0-9]+(?:\\.[0-9]+)?')) AS INTEGER) AS token_len FROM a""")
def article_base_documents(spark, sf_dir):
    out = articles.base_documents(articles.records(_article_files(spark, sf_dir)))
    return out.select("doc_id", "body_missing", "encoding_note", F.col("token_len").cast("int").alias("token_len"))


@query("SELECT count(*) AS documents, 1.0::DOUBLE AS any_section_rate, 0.0::DOUBLE AS imrad_rate, 0.0::DOUBLE AS imrad_conclusion_rate FROM nation")
def section_rates(spark, sf_dir):
    return reporting.section_rates(articles.light_records(articles.records(_article_files(spark, sf_dir))))


@query(_NATIONS + "SELECT 'On ' || name AS title, journal, article_type FROM a WHERE k = 0")
def article_preview(spark, sf_dir):
    return articles.preview(_article_files(spark, sf_dir)).select("title", "journal", "article_type")


# terminology: a record for each part


def _terminology(spark, sf_dir) -> DataFrame:
    """Concepts from XML files of three kinds that are written for it."""
    k = F.col("p_partkey")
    name = F.when(k % 50 == 0, "").otherwise(F.col("p_name"))
    words = F.array(*[F.struct(c.alias("String")) for c in (name, F.upper(name), F.col("p_type"), k.cast("string"))])
    concepts = F.struct(F.array(F.struct(F.struct(words.alias("Term")).alias("TermList"))).alias("Concept"))
    path, paths = _folder(spark, "terms"), {}
    for rest, (kind, (tag, ui, named)) in enumerate(tables.KINDS.items()):
        paths[kind] = f"{path}/{kind}"
        ident = F.when(k % 70 == 0, "").otherwise(F.concat(F.lit("D"), k.cast("string")))
        rows = table(spark, sf_dir, "part").filter(k % 3 == rest).select(ident.alias(ui), F.struct(name.alias("String")).alias(named), concepts.alias("ConceptList"))
        rows.write.format("xml").options(rowTag=tag, rootTag=f"{tag}Set", compression="gzip").save(paths[kind])
    return tables.concepts(tables.read_terminology(spark, paths))


_TERMS_SQL = """WITH t AS (SELECT CASE WHEN p_partkey % 70 = 0 THEN '' ELSE 'D' || p_partkey END AS concept_id, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE p_name END AS name, p_type, ['descriptor', 'supplemental', 'qualifier'][p_partkey % 3 + 1] AS record_type FROM part),
u AS (SELECT *, CASE WHEN concept_id = '' THEN 'missing_id' WHEN name = '' THEN 'missing_preferred_term' END AS skip_reason, CASE WHEN name = '' OR lower(name) = lower(p_type) THEN 1 ELSE 2 END AS term_count FROM t)
"""


@query(_TERMS_SQL + "SELECT concept_id, name AS preferred_term, record_type, CAST(term_count AS INTEGER) AS term_count FROM u WHERE skip_reason IS NULL")
def terminology_concepts(spark, sf_dir):
    return _terminology(spark, sf_dir).filter("skip_reason is null").select("concept_id", "preferred_term", "record_type", "term_count")


@query(_TERMS_SQL + """SELECT count(*) AS seen, count(*) FILTER (WHERE skip_reason IS NULL) AS kept, count(*) FILTER (WHERE skip_reason = 'missing_id') AS skipped_missing_id, count(*) FILTER (WHERE skip_reason = 'missing_preferred_term') AS skipped_missing_preferred_term,
 0::BIGINT AS skipped_no_valid_terms, sum(term_count) FILTER (WHERE skip_reason IS NULL)::BIGINT AS terms, (SELECT count(DISTINCT x) FROM (SELECT lower(name) AS x FROM u WHERE skip_reason IS NULL UNION ALL SELECT lower(p_type) FROM u WHERE skip_reason IS NULL)) AS unique_terms FROM u""")
def terminology_counts(spark, sf_dir):
    return tables.terminology_stats(_terminology(spark, sf_dir))


@query(_TERMS_SQL + """SELECT name AS query, concept_id, 'mesh_' || record_type AS entity_type, 0 AS start, CAST(length(name) AS INTEGER) AS "end" FROM (SELECT *, min(concept_id) OVER (PARTITION BY lower(name)) AS first FROM u WHERE skip_reason IS NULL) WHERE concept_id = first""")
def terminology_matches(spark, sf_dir):
    """Names of concepts as queries: each finds the concept of that name with the smallest id, over its whole length."""
    path = _folder(spark, "concepts")
    kept = _terminology(spark, sf_dir).filter("skip_reason is null")
    tables.write_jsonl(kept.select("concept_id", "preferred_term", "terms", "record_type"), path)
    known = tables.load_terminology(spark, path)
    assert tables.load_terminology(spark, None) is None and tables.load_terminology(spark, path + "-none") is None
    asked = known.groupBy(F.lower("preferred_term").alias("k")).agg(F.min_by("preferred_term", "concept_id").alias("query")).select("query")
    e = understanding.entities(asked, known).select("query", F.inline("entities"))
    return e.select("query", "concept_id", "entity_type", "start", "end").filter(F.col("start") == 0)


# filters, joins and shaping


@query("SELECT event_id FROM events WHERE event_type = 'click' AND user_id <> 7")
def merged_filter(spark, sf_dir):
    where = filters.merge_where(filters.parse_where('{"event_type": "click"}'), {"user_id": {"$ne": 7}})
    return table(spark, sf_dir, "events").filter(filters.compile_where(where)).select("event_id")


@query(_KNN.replace("FROM u q JOIN u c ON q.vec_id % 20 = 0", "FROM u q JOIN u c ON q.vec_id % 20 = 0 AND c.label IN (1, 3)") + "SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM vector")
def knn_filtered(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return _r(vectors.knn(e.withColumnRenamed("vec_id", "chunk_id"), q, 20, {"label": {"$in": [1, 3]}}, id_col="chunk_id").select("query_id", "rank", "chunk_id", "score"), "score")


_SUITE = """WITH f AS (SELECT * FROM (VALUES ('english', 'lang', 'en'), ('german', 'lang', 'de'), ('no_result_filter', 'lang', '__NONE__')) v(filter_name, c, x)), n AS (SELECT filter_name, (SELECT count(*) FROM documents WHERE lang = x) AS n FROM f)
"""


@query(_SUITE + "SELECT filter_name, least(n, 5) AS hit_count, 'ok' AS status, CASE WHEN filter_name = 'no_result_filter' THEN 'empty result expected' WHEN n > 0 THEN 'matched' ELSE 'no matching rows' END AS note FROM n UNION ALL SELECT 'nothing', 0, 'error', 'no column pmcid'")
def filter_suite(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    named = {"english": {"lang": "en"}, "german": {"lang": "de"}, "nothing": {"pmcid": "x"}}
    return filters.check_filters(d, {}, 5, named, {"lang": "__NONE__"}).select("filter_name", "hit_count", "status", "note")


@query("SELECT x AS filter_name, count(*) FILTER (WHERE lang = x) AS hit_count, round(count(*) FILTER (WHERE lang = x) / count(*), 6) AS hit_rate FROM documents, (VALUES ('en'), ('fr')) v(x) GROUP BY 1")
def filter_rates(spark, sf_dir):
    return _r(filters.hit_rates(table(spark, sf_dir, "documents"), {x: {"lang": x} for x in ("en", "fr")}), "hit_rate")


@query("SELECT doc_id, coalesce(text, '') AS text, coalesce(n_chars::VARCHAR, '') AS n_chars, n_chars > 1000 AS long, '[\"' || lang || '\",\"' || source || '\"]' AS tags FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def flat_metadata(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("lang is not null and source is not null").withColumns({"tags": F.array("lang", "source"), "long": F.col("n_chars") > 1000})
    return reporting.clean_metadata(d, ["text", "n_chars", "long", "tags", "absent"], ("doc_id",))


@query("SELECT doc_id, CASE WHEN trim(body) <> '' THEN 'abstract_available' WHEN trim(title) <> '' THEN 'title_available' ELSE 'none' END AS fallback, translate(substr(text, 1, 800), chr(10), ' ') AS line, replace(substr(text, 1, 120), chr(10), ' ') AS snippet FROM (SELECT *, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body FROM documents)")
def shown_texts(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", text.fallback_available("title", "body").alias("fallback"), reporting.one_line("text").alias("line"), text.snippet("text", 120).alias("snippet"))


@query("SELECT query_id::VARCHAR AS query_id, final_rank, chunk_id, fusion_strategy, fusion_score, NULL::VARCHAR AS pmid FROM (" + _FINAL + "SELECT query_id, final_rank, chunk_id, fusion_strategy, round(fusion_score, 6) AS fusion_score FROM final WHERE final_rank <= 3)")
def shaped_results(spark, sf_dir):
    f = _final(spark, sf_dir).filter("final_rank <= 3").withColumn("query_id", F.col("query_id").cast("string"))
    return _r(reporting.result_rows(f).select("query_id", "final_rank", "chunk_id", "fusion_strategy", "fusion_score", "pmid"), "fusion_score")


@query("SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, coalesce(e.label, -1) AS label FROM documents d LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON d.doc_id = e.vec_id")
def chained_joins(spark, sf_dir):
    d, q = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    return d.join(q, "doc_id", "left").join(e, "doc_id", "left").na.fill(-1)


@query("SELECT d.doc_id, d.source, l.quality, coalesce(s.n, 0) AS n FROM documents d JOIN labels l USING (doc_id) LEFT JOIN (SELECT lang, source, count(*) AS n FROM documents WHERE doc_id % 3 = 0 GROUP BY ALL) s ON d.lang = s.lang AND d.source = s.source")
def inner_then_composite(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    s = d.filter("doc_id % 3 = 0").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").join(s, ["lang", "source"], "left").select("doc_id", "source", "quality", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM documents WHERE n_chars > 20000)")
def sampled_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return d.join(d.filter("n_chars > 20000").select("source"), "source", "left_semi").select("doc_id", "source")


@query("SELECT 'corpus' AS scope, lang, count(*) AS documents FROM documents GROUP BY ALL UNION ALL SELECT 'sample', lang, count(*) FROM documents WHERE doc_id % 10 = 0 GROUP BY ALL")
def tagged_scopes(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    count = lambda x: x.groupBy("lang").agg(F.count("*").alias("documents"))
    return reporting.tagged_union({"corpus": count(d), "sample": count(d.filter("doc_id % 10 = 0"))})


_GROUPS = """WITH q AS (SELECT quantile_cont(n_chars, 1/3) AS a, quantile_cont(n_chars, 2/3) AS b FROM documents), g AS (SELECT doc_id, n_chars, CASE WHEN n_chars <= a THEN 'short' WHEN n_chars <= b THEN 'medium' ELSE 'long' END AS length_group FROM documents, q),
s AS (SELECT *, row_number() OVER (PARTITION BY length_group ORDER BY md5(doc_id || ':42'), doc_id) AS r FROM g)
"""


@query(_GROUPS + "SELECT doc_id, n_chars, length_group, row_number() OVER (ORDER BY list_position(['short', 'medium', 'long'], length_group), n_chars, doc_id) AS place FROM s WHERE r <= 5")
def reviewed_sample(spark, sf_dir):
    from docweave.operators.common import row_index

    d = profile.with_length_group(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars")
    s = reporting.by_group_and_length(profile.stratified_sample(d, "length_group", 5, "doc_id"), "length_group", "n_chars", "doc_id")
    s = s.withColumn("g", F.array_position(F.array(*map(F.lit, ("short", "medium", "long"))), "length_group"))
    return row_index(s, "g", "n_chars", "doc_id", name="place").select("doc_id", "n_chars", "length_group", (F.col("place") + 1).alias("place"))


@query("SELECT source, list_sort(list_distinct(list(lang))) AS langs FROM documents GROUP BY source")
def source_languages(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(reporting.distinct_values("lang").alias("langs"))


@query("SELECT conv_id, CASE WHEN count(DISTINCT lower(role)) = 3 THEN ['User', 'assistant', 'system'] ELSE list_sort(list_distinct(list(CASE WHEN role = 'user' THEN 'User' ELSE role END))) END AS roles FROM conversations GROUP BY 1")
def distinct_any_case(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.when(F.col("role") == "user", F.lit(" User")).otherwise(F.col("role")))).alias("r"))
    return c.select("conv_id", F.array_sort(dedupe_ci(F.concat("r", F.array(F.lit("  ")), F.transform("r", F.upper)))).alias("roles"))


@query("SELECT item_id AS query_id FROM benchmark ORDER BY lpad(item_id::VARCHAR, 9, '0') LIMIT 7")
def selected_queries(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.lpad(F.col("item_id").cast("string"), 9, "0").alias("query_id"))
    ids = [r[0] for r in b.collect()]  # the benchmark's queries
    return evaluation.select_queries(b, ids, 7).select(F.col("query_id").cast("long").alias("query_id"))


# text rules

_ODD = """WITH x AS (SELECT doc_id, n_chars, CASE doc_id % 4 WHEN 0 THEN text || repeat(chr(65533), CAST(doc_id % 30 AS INTEGER)) WHEN 1 THEN '  ' || text || '  p < 0.05, 95% CI and 12.5% ' ELSE text END AS t FROM documents)
"""


def _odd(spark, sf_dir) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    bad = F.repeat(F.lit("�"), (i % 30).cast("int"))
    return d.select("doc_id", "n_chars", F.when(i % 4 == 0, F.concat("text", bad)).when(i % 4 == 1, F.concat(F.lit("  "), "text", F.lit("  p < 0.05, 95% CI and 12.5% "))).otherwise(F.col("text")).alias("t"))


@query(_ODD + r""", y AS (SELECT doc_id, t, len(regexp_extract_all(t, '[\x{FFFD}\x00-\x08\x0b\x0c\x0e-\x1f]')) AS bad, length(t) AS n FROM x)
SELECT doc_id, CASE WHEN bad = 0 THEN '' ELSE CASE WHEN bad / greatest(1, n) > 0.01 OR bad >= 20 THEN 'severe_encoding_issue' ELSE 'encoding_warning' END || ' bad_chars=' || bad || ' density=' || format('{:.4f}', bad / greatest(1, n)) END AS note FROM y""")
def encoding_notes(spark, sf_dir):
    return _odd(spark, sf_dir).select("doc_id", text.encoding_note("t").alias("note"))


@query(_ODD + r"SELECT doc_id, len(regexp_extract_all(t, '(?i)\bp\s*[<=>]\s*0?\.\d+|\b95%\s*CI\b|\bconfidence intervals?\b|\bodds ratios?\b|\brelative risks?\b|\d+(?:\.\d+)?%'))::INTEGER AS statistics, substr(trim(regexp_replace(t, '\s+', ' ', 'g')), 1, 90) AS truncated FROM x")
def statistic_counts(spark, sf_dir):
    return _odd(spark, sf_dir).select("doc_id", text.statistic_markers("t").cast("int").alias("statistics"), text.truncate_query("t", 90).alias("truncated"))


@query("SELECT doc_id, array_to_string(list_filter([trim(split_part(text, chr(10), 1)), trim(coalesce(source, '')), trim(lang)], lambda p: p IS NOT NULL AND p <> ''), chr(10) || chr(10)) AS joined FROM documents")
def joined_parts(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", text.join_parts(F.col("title"), F.lit(" "), F.col("source"), F.col("lang")).alias("joined"))


@query(r"SELECT p_partkey, lower(trim(regexp_replace(p_name, '\s+', ' ', 'g'))) AS term, length(p_name) BETWEEN 2 AND 256 AND NOT regexp_matches(p_name, '^[0-9]+$') AS ok FROM part")
def normalized_terms(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_term("p_name").alias("term"), text.term_ok(F.col("p_name")).alias("ok"))


@query(r"""WITH w AS (SELECT p_partkey, lower(p_type) AS q, regexp_extract_all(lower(p_type), '[a-z0-9]+') AS t FROM part), g AS (SELECT p_partkey, q AS g FROM w UNION SELECT p_partkey, array_to_string(t[i:i + n - 1], ' ') FROM w, range(1, 9) a(n), range(1, 9) b(i) WHERE i + n - 1 <= len(t))
SELECT p_partkey, list_sort(list(g)) AS ngrams FROM g GROUP BY 1""")
def query_runs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.array_sort(text.query_ngrams("p_type")).alias("ngrams"))


_ASKED = """WITH a AS (SELECT event_id, 1990 + event_id % 30 AS y, event_id % 6 AS k FROM events), q AS (SELECT *, CASE k WHEN 0 THEN 'PCR papers after ' || y WHEN 1 THEN 'studies from ' || y || ' to ' || (y + 2) WHEN 2 THEN 'PLoS ONE review ' || y WHEN 3 THEN 'research article in Nature' WHEN 4 THEN '关于肺癌的研究 ' || y || '年' ELSE 'results and methods before ' || y END AS query FROM a)
"""


def _asked(spark, sf_dir) -> DataFrame:
    i = F.col("event_id")
    y, k = (1990 + i % 30).cast("string"), i % 6
    q = (
        F.when(k == 0, F.concat(F.lit("PCR papers after "), y)).when(k == 1, F.concat(F.lit("studies from "), y, F.lit(" to "), (1992 + i % 30).cast("string"))).when(k == 2, F.concat(F.lit("PLoS ONE review "), y))
        .when(k == 3, "research article in Nature").when(k == 4, F.concat(F.lit("关于肺癌的研究 "), y, F.lit("年"))).otherwise(F.concat(F.lit("results and methods before "), y))
    )
    return table(spark, sf_dir, "events").select("event_id", q.alias("query"))


@query(_ASKED + """SELECT event_id, CASE k WHEN 2 THEN '{"$and":[{"pub_year":"' || y || '"},{"journal":"PLoS ONE"}]}' WHEN 3 THEN '{"$and":[{"journal":"Nature"},{"article_type":"research-article"}]}' WHEN 4 THEN '{"pub_year":"' || y || '"}' END AS where_filter,
CASE WHEN k IN (2, 4) THEN y::VARCHAR END AS year, CASE WHEN k IN (0, 1) THEN y::VARCHAR END AS first, CASE k WHEN 1 THEN (y + 2)::VARCHAR WHEN 5 THEN y::VARCHAR END AS last, CASE k WHEN 2 THEN 'review-article' WHEN 3 THEN 'research-article' END AS article_type, CASE k WHEN 5 THEN ['methods', 'results'] ELSE CAST([] AS VARCHAR[]) END AS sections FROM q""")
def stated_filters(spark, sf_dir):
    parts = understanding.filter_columns(F.col("query"))
    found = _asked(spark, sf_dir).select("event_id", *[c.alias(n) for n, c in parts.items()])
    return found.select("event_id", understanding.where_json({n: F.col(n) for n in parts}).alias("where_filter"), F.col("pub_year_eq").alias("year"), F.col("pub_year_gte").alias("first"), F.col("pub_year_lte").alias("last"), "article_type", F.col("section_title_norm").alias("sections"))


_PHRASES = [p for p in understanding.ENTITIES if p[0] not in ("diabetes", "糖尿病")]
_VALUES = ", ".join(f"({i}, '{p}', '{n}', '{k}')" for i, (p, n, k) in enumerate(_PHRASES))
_ENTITIES_SQL = f"""WITH e AS (SELECT * FROM (VALUES {_VALUES}) v(i, phrase, normalized, kind)), q AS (SELECT o_orderkey, a.phrase AS p, a.normalized AS n, a.kind AS k, b.phrase AS p2, b.normalized AS n2, b.kind AS k2, a.phrase || ' versus ' || b.phrase AS query FROM orders JOIN e a ON a.i = o_orderkey % {len(_PHRASES)} JOIN e b ON b.i = (o_orderkey // 7) % {len(_PHRASES)}),
m AS (SELECT *, n = n2 AND k = k2 AS same FROM q)
"""


@query(_ENTITIES_SQL + """SELECT o_orderkey, query AS clean_query, CASE WHEN same THEN [n] ELSE [n, n2] END AS normalized, CASE WHEN same THEN [p] ELSE [p, p2] END AS found, 'ok' AS status FROM m""")
def known_entities(spark, sf_dir):
    """Two known phrases in each query: both are found unless they name the same thing."""
    e = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(_PHRASES)], "i long, phrase string")
    n, k = len(_PHRASES), F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", (k % n).alias("i"), (F.floor(k / 7) % n).alias("j"))
    asked = o.join(e, "i").join(e.toDF("j", "other"), "j").select("o_orderkey", F.concat("phrase", F.lit(" versus "), "other").alias("query"))
    out = understanding.understand(asked)
    return out.select("o_orderkey", "clean_query", F.transform("entities", lambda x: x["normalized"]).alias("normalized"), F.transform("entities", lambda x: x["text"]).alias("found"), "status")


@query(_ENTITIES_SQL + """, r AS (SELECT o_orderkey, CASE WHEN same THEN [n] ELSE [n, n2] END AS ns, CASE WHEN same THEN [k] ELSE [k, k2] END AS ks FROM m), t AS (SELECT o_orderkey, unnest(ns) AS n, unnest(ks) AS k, generate_subscripts(ns, 1) AS pos FROM r)
SELECT o_orderkey, list_filter(list(CASE WHEN k IN ('drug', 'disease', 'gene/protein') THEN n END ORDER BY list_position(['drug', 'disease', 'gene/protein'], k), pos), lambda x: x IS NOT NULL) AS required_terms FROM t GROUP BY 1""")
def required_terms(spark, sf_dir):
    e = spark.createDataFrame([(i, p) for i, (p, _, _) in enumerate(_PHRASES)], "i long, phrase string")
    n, k = len(_PHRASES), F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", (k % n).alias("i"), (F.floor(k / 7) % n).alias("j"))
    asked = o.join(e, "i").join(e.toDF("j", "other"), "j").select("o_orderkey", F.concat("phrase", F.lit(" versus "), "other").alias("query"))
    return understanding.understand(asked).select("o_orderkey", "required_terms")


@query("SELECT item_id, CASE WHEN lower(item_id::VARCHAR || ' x') <> '' THEN item_id::VARCHAR || ' alpha Beta' END AS words FROM benchmark")
def keyword_texts(spark, sf_dir):
    i = F.col("item_id").cast("string")
    return table(spark, sf_dir, "benchmark").select("item_id", understanding.keyword_text(F.array(i, F.lit(" alpha ")), F.array(F.lit("Beta"), F.lit("ALPHA"), F.lit("")), F.lit("fallback")).alias("words"))


@query("SELECT c_custkey, round(1 / (1 + exp(-greatest(-60, least(60, c_acctbal / 1000)))), 9) AS sigmoid, TRY_CAST(CASE WHEN c_custkey % 3 = 0 THEN 'x' ELSE c_acctbal::VARCHAR END AS DOUBLE) AS number FROM customer")
def safe_numbers(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = F.when(F.col("c_custkey") % 3 == 0, "x").otherwise(F.col("c_acctbal").cast("string"))
    return _r(c.select("c_custkey", numeric.sigmoid(F.col("c_acctbal") / 1000).alias("sigmoid"), numeric.to_float(raw).alias("number")), "sigmoid", digits=9)


@query("SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value FROM events")
def json_values(spark, sf_dir):
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.element_at(F.map_values(m), 1).alias("first_value"))


@query("""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'need_review' WHEN 2 THEN 'keep_with_warning' ELSE 'need_review' END AS of_chunk, CASE WHEN role = 'user' THEN '整体不分割' WHEN role = 'system' THEN '按语义章节分割' ELSE '重叠滑动窗口' END AS label FROM conversations""")
def chunk_quality(spark, sf_dir):
    c, k = table(spark, sf_dir, "conversations"), F.col("turn") % 4
    body = F.repeat(F.lit("word "), F.when(k == 2, 10).otherwise(60))
    q = text.quality_of_chunk(F.lit("t"), F.lit("a"), body, text.approx_token_len(body), F.when(k == 1, "severe_encoding_issue").otherwise(""), F.when(k == 3, 2).otherwise(1))
    route = F.when(F.col("role") == "user", "whole_document_under_512").when(F.col("role") == "system", "semantic_section").otherwise("recursive_fallback_no_section")
    return c.select("conv_id", "turn", q.alias("of_chunk"), text.route_label(route).alias("label"))


@query("""SELECT conv_id, turn, CASE turn % 7 WHEN 0 THEN 'xml_parse_error' WHEN 1 THEN 'duplicate_pmcid' WHEN 2 THEN 'drop_no_text' WHEN 3 THEN 'no_body_for_fulltext' WHEN 4 THEN 'severe_encoding_issue' END AS reason FROM conversations""")
def exclusion_reasons(spark, sf_dir):
    k = F.col("turn") % 7
    empty = lambda *n: F.when(k.isin(*n), "").otherwise("text")
    reason = chunking.exclusion_reason(k == 0, k == 1, empty(2), empty(2), empty(2, 3), F.when(k == 4, "severe_encoding_issue").otherwise(""), F.when(k == 4, 0).otherwise(9))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", reason.alias("reason"))


# builds

_BODY = "WITH d AS (SELECT doc_id, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body FROM documents), n AS (SELECT doc_id, title, trim(regexp_replace(body, '\\s+', ' ', 'g')) AS b, len(regexp_extract_all(title || ' ' || body, '[A-Za-z][A-Za-z0-9_+-]*|[0-9]+(?:\\.[0-9]+)?')) AS whole FROM d)"
_N = "len(regexp_extract_all({}, '[A-Za-z][A-Za-z0-9_+-]*|[0-9]+(?:\\.[0-9]+)?'))"


@query(_BODY + ", c AS (SELECT doc_id, whole, b, 'Title: ' || CASE WHEN trim(title) = '' THEN '[Missing title: ' || doc_id || ']' ELSE title END || chr(10) || 'Section: whole_document' || chr(10) || 'Text:' || chr(10) || b AS t FROM n WHERE whole <= 512 AND b <> '') SELECT doc_id::VARCHAR || '::chunk_00000' AS chunk_id, trim(t) AS text, CAST(" + _N.format("t") + " AS INTEGER) AS token_count FROM c WHERE " + _N.format("t") + " <= 512")
def whole_chunks(spark, sf_dir):
    """Chunks of documents that stay whole."""
    d = records(spark, sf_dir)
    none = F.array().cast("array<struct<section_index:int,section_title:string,section_title_norm:string,section_text:string>>")
    out = chunking.chunk_documents(d.select(F.col("doc_id").cast("string").alias("doc_id"), "title", F.lit("").alias("abstract"), "body", none.alias("sections")))
    return out.filter("split_strategy = 'whole_document_under_512' and total_chunks = 1").select("chunk_id", "text", F.col("token_count").cast("int").alias("token_count"))


_NUMBERED = "WITH c AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations), e AS (SELECT * REPLACE (CASE WHEN conv_id % 9 = 0 THEN i + 1 ELSE i END AS i, CASE WHEN conv_id % 11 = 0 THEN n + 1 ELSE n END AS n) FROM c)"


@query(_NUMBERED + """, p AS (SELECT conv_id, count(*) AS k, min(i) AS lo, max(i) AS hi, min(n) AS n0 FROM e GROUP BY 1)
SELECT (SELECT count(*) FROM e) AS chunks, count(*) AS documents, count(*) FILTER (WHERE lo <> 0 OR hi <> k - 1) AS index_gaps, count(*) FILTER (WHERE n0 <> k) AS wrong_totals, (SELECT count(*) FILTER (WHERE length(trim(text)) < 20) FROM e) AS short, 0::BIGINT AS duplicate_chunk_ids, (SELECT count(*) FILTER (WHERE trim(text) = '') FROM e) AS empty FROM p""")
def chunk_faults(spark, sf_dir):
    """The integrity checks on a chunk table with faults put in."""
    c = table(spark, sf_dir, "conversations")
    totals = c.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("turn")).alias("turns"))
    i = F.array_position("turns", F.col("turn")) - 1
    bad = c.join(totals, "conv_id").select(
        F.concat_ws("::", "conv_id", "turn").alias("chunk_id"), F.col("conv_id").cast("string").alias("doc_id"), "text", (i + F.when(F.col("conv_id") % 9 == 0, 1).otherwise(0)).alias("chunk_index"),
        (F.col("n") + F.when(F.col("conv_id") % 11 == 0, 1).otherwise(0)).alias("total_chunks"), F.lit("semantic_section").alias("split_strategy"), F.lit(5).alias("token_count"), F.lit("s").alias("section_title"),
    )
    return chunking.integrity(bad).select("chunks", "documents", "index_gaps", "wrong_totals", "short", "duplicate_chunk_ids", "empty")


@query("SELECT CAST(vec_id % 4 AS INTEGER) AS part_id, count(*) AS chunk_count, 'complete' AS status, min(lpad(vec_id::VARCHAR, 9, '0')) AS start_chunk_id, max(lpad(vec_id::VARCHAR, 9, '0')) AS end_chunk_id, (SELECT count(*) FROM embeddings) AS entries, 0::BIGINT AS added_again FROM embeddings GROUP BY 1")
def vector_index_build(spark, sf_dir):
    """Parts in three runs: two, the rest, and nothing more; then all rows once more."""
    e = table(spark, sf_dir, "embeddings").select(F.lpad(F.col("vec_id").cast("string"), 9, "0").alias("chunk_id"), "embedding", "label", (F.col("vec_id") % 4).cast("int").alias("part_id"), F.concat(F.lit("part_"), (F.col("vec_id") % 4).cast("string")).alias("part_file"))
    index = VectorIndex(spark, _folder(spark, "index"))
    index.build(e, most=2)
    for _ in range(2):
        index.build(e)
    again = index.upsert(e)
    return index.progress.select("part_id", "chunk_count", "status", "start_chunk_id", "end_chunk_id", F.lit(index.count()).cast("long").alias("entries"), F.lit(again).cast("long").alias("added_again"))


@query(_KNN + "SELECT query_id, rank, chunk_id, round(score, 4) AS score, label FROM vector JOIN embeddings ON chunk_id = vec_id WHERE rank <= 3")
def vector_index_query(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding", "label")
    index = VectorIndex(spark, _folder(spark, "index"))
    index.upsert(e)
    asked = e.filter("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), "embedding")
    hits = VectorIndex.open(spark, index.path).query(asked, 3)
    return _r(hits.select("query_id", "rank", "chunk_id", "score", "label"), "score", digits=4)


@query("SELECT vec_id AS chunk_id, label FROM embeddings WHERE label = 3 ORDER BY vec_id LIMIT 10")
def vector_index_get(spark, sf_dir):
    index = VectorIndex(spark, _folder(spark, "index"))
    index.upsert(table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "chunk_id"))
    return index.get(where={"label": {"$eq": 3}}, limit=10, include=("label",))


@query(_BM25 + "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_idx) AS INTEGER) AS rank FROM sc) WHERE rank <= 5")
def bm25_saved(spark, sf_dir):
    path = _folder(spark, "bm25")
    made = bm25.build(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    made.write(path)
    made.drop()
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return _r(bm25.search(bm25.Bm25Index.read(spark, path), q, 5).select("query_id", "rank", "doc_id", "score"), "score")


@query("SELECT doc_id, i AS doc_idx FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents) WHERE i IN (0, 5, 77, 900)")
def stored_documents(spark, sf_dir):
    made = bm25.build(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    return made.documents([0, 5, 77, 900, 10**9]).select("doc_id", "doc_idx")


@query("SELECT CAST(part AS INTEGER) AS part, count(*) AS rows FROM (SELECT source, min(doc_id % 3) AS part FROM documents WHERE source IS NOT NULL GROUP BY 1) GROUP BY 1")
def resumed_parts(spark, sf_dir):
    """Parts with the first row of each source; the run stops after two parts and goes on."""
    path = _folder(spark, "resume")
    d = table(spark, sf_dir, "documents").filter("source is not null").select("doc_id", "source", (F.col("doc_id") % 3).cast("int").alias("part"))
    ingest.write_missing_parts(d.filter("part < 2"), path, "source", "part")
    ingest.write_missing_parts(d, path, "source", "part")
    parts = spark.read.parquet(path)
    return parts.groupBy("part").agg(F.count("*").alias("rows"))


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i FROM documents) WHERE i > 120")
def resumed_rows(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return ingest.rest_after(d, d.filter("doc_id >= 0").orderBy("doc_id").limit(120), "doc_id")


@query("SELECT k AS elapsed, CASE WHEN k < 60 THEN format('{:.1f}', k::DOUBLE) || 's' WHEN k < 3600 THEN (k // 60) || 'm ' || (k % 60) || 's' ELSE (k // 3600) || 'h ' || (k // 60 % 60) || 'm' END AS shown, round(least(1, k / 5000), 6) AS share FROM (SELECT n_nationkey * 400 AS k FROM nation)")
def elapsed_times(spark, sf_dir):
    k = table(spark, sf_dir, "nation").select((F.col("n_nationkey") * 400).alias("elapsed"))
    shares = reporting.progress(F.col("elapsed"), F.lit(5000), F.lit(10.0))
    return _r(k.select("elapsed", reporting.human_seconds("elapsed").alias("shown"), shares["share"].cast("double").alias("share")), "share")


# vocabulary


_NOISE = ", ".join(f"'{w}'" for w in text.NOISE)
_PLAIN_WORDS = r"regexp_extract_all(regexp_replace(lower(text), '[^a-z\x00-\x7F]', '_', 'g'), '\b[a-z][a-z\-]{2,}\b')"
_WORDS_SQL = f"list_filter({_PLAIN_WORDS}, lambda w: w NOT IN ({_NOISE}))"


@query("SELECT term, count(*) AS count FROM (SELECT unnest(" + _WORDS_SQL + ") AS term FROM documents) GROUP BY 1 ORDER BY count DESC, term LIMIT 40")
def top_unigrams(spark, sf_dir):
    return profile.top_terms(table(spark, sf_dir, "documents"), text.filtered_words("text", text.NOISE), 40)


@query("WITH w AS (SELECT " + _PLAIN_WORDS + " AS t FROM documents), g AS (SELECT t[i] AS a, t[i + 1] AS b, t[i + 2] AS c FROM (SELECT t, unnest(range(1, len(t) - 1)) AS i FROM w WHERE len(t) > 2)) SELECT a || ' ' || b || ' ' || c AS term, count(*) AS count FROM g WHERE a NOT IN (" + _NOISE + ") AND b NOT IN (" + _NOISE + ") AND c NOT IN (" + _NOISE + ") GROUP BY 1 ORDER BY count DESC, term LIMIT 40")
def top_trigrams(spark, sf_dir):
    return profile.top_ngrams(table(spark, sf_dir, "documents"), text.words("text"), 3, 40, text.NOISE, text.NOISY_PHRASES)


# evaluation


@query(_JUDGED + "SELECT arg_max(fusion_strategy, [round(ndcg, 9), round(mrr, 9), round(rec, 9)]) AS fusion_strategy FROM (SELECT fusion_strategy, avg(ndcg) AS ndcg, avg(mrr) AS mrr, avg(rec) AS rec FROM metrics GROUP BY 1)")
def best_strategy(spark, sf_dir):
    r, j = _judged(spark, sf_dir)
    return evaluation.winner(evaluation.summary(evaluation.metrics(r, j)))


@query(_FINAL + """, t AS (SELECT query_id // 40 AS pair_id, fusion_strategy, query_id, document_key FROM final WHERE final_rank <= 10), n AS (SELECT pair_id, fusion_strategy, query_id, count(*) AS n FROM t GROUP BY ALL),
x AS (SELECT a.pair_id, a.fusion_strategy, count(*) AS i FROM t a JOIN t b ON a.pair_id = b.pair_id AND a.fusion_strategy = b.fusion_strategy AND a.query_id < b.query_id AND a.document_key = b.document_key GROUP BY 1, 2)
SELECT a.pair_id, a.fusion_strategy, a.query_id AS "left", b.query_id AS "right", CAST(coalesce(i, 0) AS INTEGER) AS intersection, round(coalesce(i, 0) / least(a.n, b.n), 6) AS overlap_rate FROM n a JOIN n b ON a.pair_id = b.pair_id AND a.fusion_strategy = b.fusion_strategy AND a.query_id < b.query_id LEFT JOIN x ON x.pair_id = a.pair_id AND x.fusion_strategy = a.fusion_strategy""")
def paired_queries(spark, sf_dir):
    r = _final(spark, sf_dir)
    pairs = r.select("query_id").distinct().withColumn("pair_id", F.floor(F.col("query_id") / 40).cast("string"))
    return _r(evaluation.pair_overlaps(r, pairs, "document_key").withColumn("pair_id", F.col("pair_id").cast("long")), "overlap_rate")


@query(_FINAL + "SELECT fusion_strategy, count(DISTINCT document_key) AS documents, round(avg(final_score), 6) AS mean_score FROM final GROUP BY 1")
def documents_per_strategy(spark, sf_dir):
    return _r(_final(spark, sf_dir).groupBy("fusion_strategy").agg(F.count_distinct("document_key").alias("documents"), F.avg("final_score").alias("mean_score")), "mean_score")


def _retrieval(spark, sf_dir) -> Retrieval:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("source").alias("journal"), F.lit("2020").alias("pub_year"))
    return Retrieval(vectors.embed(d, "text", "hash", dim=64), bm25.build(d, ["doc_id"]), 2025, embedding_options={"dim": 64})


@query("SELECT 10::BIGINT AS queries, 10::BIGINT AS valid, true AS fallback_warned")
def smoke_benchmark(spark, sf_dir):
    """The smoke queries through the whole pipeline, with a reranker that isn't there."""
    _, summary, warnings = smoke(_retrieval(spark, sf_dir), reranker="none such")
    return summary.agg(F.count("*").alias("queries"), F.count_if(F.col("status") == "ok").alias("valid"), F.lit(any("reranker unavailable" in w for w in warnings)).alias("fallback_warned"))


@query(_BM25 + ", found AS (SELECT query_id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_idx) AS rank FROM sc) WHERE rank <= 20) SELECT query_id::VARCHAR AS query_id, count(*) AS candidates, true AS warned FROM found GROUP BY 1")
def one_path_down(spark, sf_dir):
    """The vector path fails while it runs; the keyword path answers alone, with a warning. Queries without known entities are searched as they are."""
    p = _retrieval(spark, sf_dir)

    @F.pandas_udf("array<float>")
    def broken(texts):
        raise RuntimeError("no model")

    udf.register_embedding("broken", lambda **_: broken)
    p.embedding = "broken"
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    understood = q.select("query_id", F.col("query").alias("clean_query"), F.col("query").alias("vector_query"), F.array().cast("array<string>").alias("required_terms"), F.array().cast("array<string>").alias("optional_terms"))
    found = p.retrieve(understood, top_k_keyword=20)
    return found.results.groupBy("query_id").agg(F.count("*").alias("candidates")).withColumn("warned", F.lit(any(w.startswith("vector path failed") for w in found.warnings)))


@query()
def strategies_compared(spark, sf_dir):
    """All strategies over the same candidates of the real pipeline, before and after ranking."""
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    out, _ = _retrieval(spark, sf_dir).compare(q, top_k=20, reranker="overlap")
    both = out.filter("stage = 'final'").withColumnRenamed("rank", "final_rank")
    return evaluation.overlaps(both, "document_key", ("simple", "rrf", "weighted"), 5)
