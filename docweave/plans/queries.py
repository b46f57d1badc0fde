"""Queries over the driver tables, each through the library's operators, and the same in SQL where SQL can say it."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import numeric, text, udf
from docweave.operators import bm25, chunking, evaluation, filters, fusion, profile, ranking, reporting, understanding, vectors
from docweave.operators.common import row_index, tall, top_per_group
from docweave.plans.retrieval import Retrieval
from docweave.session import ship
from docweave.storage import cut_lineage

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: the first line is the title, the rest the body."""
    d = table(spark, sf_dir, "documents")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return d.select("doc_id", "lang", "source", "text", title.alias("title"), F.expr("substring(text, length(split_part(text, '\n', 1)) + 2)").alias("body"))


_RECORDS = "WITH records AS (SELECT doc_id, lang, source, text, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body FROM documents)"
_TOKENS = r"len(regexp_extract_all({}, '[A-Za-z][A-Za-z0-9_+-]*|[0-9]+(?:\.[0-9]+)?'))"


def _r(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query(_RECORDS + """
, c AS (SELECT count(*) AS total, count(*) FILTER (WHERE trim(coalesce(title, '')) <> '') AS title, count(*) FILTER (WHERE trim(coalesce(body, '')) <> '') AS body,
  count(*) FILTER (WHERE trim(coalesce(lang, '')) <> '') AS lang, count(*) FILTER (WHERE trim(coalesce(source, '')) <> '') AS source FROM records)
SELECT field, total, non_empty, total - non_empty AS missing, CASE WHEN total = 0 THEN 0.0 ELSE (total - non_empty) / total END AS missing_rate
FROM c UNPIVOT (non_empty FOR field IN (title, body, lang, source))""")
def missing_rates(spark, sf_dir):
    return profile.missing_rates(records(spark, sf_dir), ["title", "body", "lang", "source"])


@query("""SELECT 'text' AS field, count(*) AS total, count(*) FILTER (WHERE trim(coalesce(text, '')) <> '') AS available,
 CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER (WHERE trim(coalesce(text, '')) <> '') / count(*) END AS available_rate FROM documents""")
def availability(spark, sf_dir):
    return profile.availability(table(spark, sf_dir, "documents"), ["text"])


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "documents"), "lang")


@query(f"""SELECT 'text' AS label, count(n) AS count, round(avg(n), 6) AS mean, quantile_cont(n, 0.5) AS median, min(n)::DOUBLE AS min, max(n)::DOUBLE AS max,
 round(quantile_cont(n, 0.5), 6) AS p50, round(quantile_cont(n, 0.75), 6) AS p75, round(quantile_cont(n, 0.9), 6) AS p90, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99,
 count(*) FILTER (WHERE n > 512) AS over_512, round(count(*) FILTER (WHERE n > 512) / count(n), 6) AS over_512_rate,
 count(*) FILTER (WHERE n > 1024) AS over_1024, round(count(*) FILTER (WHERE n > 1024) / count(n), 6) AS over_1024_rate
FROM (SELECT {_TOKENS.format('text')} AS n FROM documents)""")
def length_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(text.approx_token_len("text").alias("n"))
    return _r(profile.length_stats(d, "n", "text"), "mean", "p50", "p75", "p90", "p95", "p99", "over_512_rate", "over_1024_rate")


@query("""WITH q AS (SELECT quantile_cont(n_chars, 1/3.0) AS low, quantile_cont(n_chars, 2/3.0) AS high FROM documents),
g AS (SELECT CASE WHEN n_chars <= low THEN 'short' WHEN n_chars <= high THEN 'medium' ELSE 'long' END AS length_group, n_chars FROM documents, q)
SELECT length_group, count(*) AS count, min(n_chars) AS min, max(n_chars) AS max, round(avg(n_chars), 6) AS mean FROM g GROUP BY 1""")
def length_groups(spark, sf_dir):
    d = profile.with_length_group(table(spark, sf_dir, "documents"), "n_chars")
    return _r(profile.group_summary(d, "length_group", "n_chars", ["short", "medium", "long"]), "mean")


@query(r"""WITH k AS (SELECT sha1(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS k FROM documents WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> ''),
c AS (SELECT k, count(*) AS n FROM k GROUP BY k)
SELECT coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_rows, count(*) FILTER (WHERE n > 1) AS duplicate_keys FROM c""")
def duplicate_rows(spark, sf_dir):
    return profile.duplicate_rows(table(spark, sf_dir, "documents"), text.text_hash("text"))


@query(r"""SELECT doc_id, CASE WHEN k = '' THEN 0 ELSE count(*) OVER (PARTITION BY k) END AS occurrences FROM
 (SELECT doc_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS k FROM documents)""")
def with_duplicates(spark, sf_dir):
    return profile.with_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), text.text_hash("text")).select("doc_id", "occurrences")


@query(r"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def first_of_key(spark, sf_dir):
    return profile.first_of_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


_WORDS = r"list_filter(regexp_extract_all(regexp_replace(lower(text), '[^a-z\x00-\x7F]', '_', 'g'), '\b[a-z][a-z\-]{2,}\b'), lambda w: NOT list_contains([" + ",".join(f"'{w}'" for w in text.STOPWORDS) + "], w))"


@query(f"SELECT term, count(*) AS count FROM (SELECT unnest({_WORDS}) AS term FROM documents) GROUP BY term ORDER BY count DESC, term LIMIT 80")
def top_terms(spark, sf_dir):
    return profile.top_terms(table(spark, sf_dir, "documents"), text.filtered_words("text"))


@query(r"""WITH w AS (SELECT regexp_extract_all(regexp_replace(lower(text), '[^a-z\x00-\x7F]', '_', 'g'), '\b[a-z][a-z\-]{2,}\b') AS w FROM documents),
g AS (SELECT unnest(list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]])) AS g FROM w WHERE len(w) >= 2)
SELECT g[1] || ' ' || g[2] AS term, count(*) AS count FROM g WHERE NOT list_has_any(g, [""" + ",".join(f"'{w}'" for w in text.STOPWORDS) + "]) GROUP BY 1 ORDER BY count DESC, term LIMIT 50")
def top_bigrams(spark, sf_dir):
    return profile.top_ngrams(table(spark, sf_dir, "documents"), text.words("text"), 2, 50)


@query(r"""SELECT term, count(*) AS count FROM (SELECT unnest(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '_', 'g'), '\b[A-Z][A-Z0-9\-]{1,12}\b')) AS term FROM documents)
WHERE term NOT IN (""" + ",".join(f"'{w}'" for w in text.NOISY_ABBREVIATIONS) + ") GROUP BY term ORDER BY count DESC, term LIMIT 80")
def top_abbreviations(spark, sf_dir):
    return profile.top_terms(table(spark, sf_dir, "documents"), text.abbreviations("text"))


_MARKERS = ("THE", "AND", "DER", "LICENSE")


@query("SELECT marker, count, round(count / n, 6) AS rate FROM (SELECT count(*) AS n, " + ", ".join("count(*) FILTER (WHERE regexp_matches(regexp_replace(upper(text), '[^\\x00-\\x7F]', '_', 'g'), '\\b" + m + "\\b')) AS \"" + m + '"' for m in _MARKERS) + " FROM documents) UNPIVOT (count FOR marker IN (" + ", ".join(f'"{m}"' for m in _MARKERS) + "))")
def marker_counts(spark, sf_dir):
    return _r(profile.marker_counts(table(spark, sf_dir, "documents"), "text", _MARKERS), "rate")


_CONCEPTS = {"licence": [r"\bLicensed\b", r"\blicense\b"], "article": [r"\bthe\b", r"\bder\b", r"\bles\b"], "none": [r"\bpolymerase chain reaction\b"]}


def _mentions(p: str, sensitive: bool) -> str:
    flag = "" if sensitive else "(?i)"
    return rf"coalesce(sum(len(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '_', 'g'), '{flag}{p}'))), 0)"


@query("WITH f AS (" + " UNION ALL ".join(f"SELECT '{c}' AS concept, {_mentions(p, p == _CONCEPTS['licence'][0])} AS n FROM documents" for c, ps in _CONCEPTS.items() for p in ps) + ") SELECT concept, count(*) FILTER (WHERE n > 0) AS variant_forms_found, sum(n)::BIGINT AS total_mentions FROM f GROUP BY concept")
def variant_mentions(spark, sf_dir):
    return profile.variant_mentions(table(spark, sf_dir, "documents"), "text", _CONCEPTS, {_CONCEPTS["licence"][0]})


@query(_RECORDS + f""", t AS (SELECT {_TOKENS.format('text')} AS n, contains(body, chr(10)) AS s FROM records)
SELECT CASE WHEN n <= 512 THEN 'whole_document_under_512' WHEN s THEN 'semantic_section' ELSE 'recursive_fallback_no_section' END AS route, count(*) AS documents,
 sum(CASE WHEN n <= 0 THEN 0 WHEN n <= 400 THEN 1 ELSE 1 + CAST(ceil((n - 400) / 320) AS BIGINT) END)::BIGINT AS estimated_chunks FROM t GROUP BY 1""")
def routes(spark, sf_dir):
    n = text.approx_token_len("text")
    d = records(spark, sf_dir).select(n.alias("n"), text.route(n, F.contains("body", F.lit("\n"))).alias("route"))
    return d.groupBy("route").agg(F.count("*").alias("documents"), F.sum(text.chunk_estimate(F.col("n"))).alias("estimated_chunks"))


@query(_RECORDS + r""", d AS (SELECT *, count(*) OVER (PARTITION BY lower(trim(title))) > 1 AS dup FROM records)
SELECT CASE WHEN trim(title) = '' AND trim(body) = '' THEN 'drop_no_text' WHEN contains(text, chr(65533)) OR dup OR trim(body) = '' THEN 'need_review' WHEN trim(title) = '' THEN 'keep_with_warning' ELSE 'keep' END AS quality_decision, count(*) AS count FROM d GROUP BY 1""")
def quality_decisions(spark, sf_dir):
    d = profile.with_duplicates(records(spark, sf_dir), F.lower(F.btrim("title")))
    q = text.quality_of_record("title", "body", "body", F.contains("text", F.lit("�")), F.col("occurrences") > 1)
    return d.select(q.alias("quality_decision")).groupBy("quality_decision").agg(F.count("*").alias("count"))


@query(r"""WITH p AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN length(t) <= 200 THEN t ELSE regexp_replace(substr(t, 1, 200), ' [^ ]*$', '') || ' ...' END AS preview FROM p""")
def previews(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.preview("text", 200).alias("preview"))


@query(r"""WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(trim(x)) >= 20) AS s FROM documents)
SELECT doc_id, len(s) AS sentences, CASE WHEN len(s) = 0 THEN 0.0 ELSE round(list_sum(list_transform(s, lambda x: len(regexp_extract_all(x, '[A-Za-z]+')))) / len(s), 6) END AS mean_words FROM s""")
def sentence_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", text.sentence_stats("text").alias("s"))
    return d.select("doc_id", F.col("s.sentences").cast("long").alias("sentences"), F.round("s.mean_words", 6).alias("mean_words"))


@query(r"""SELECT doc_id, 'SOURCE:' || substr(sha1(source), 1, 16) AS chunk_doc_id, CASE WHEN doc_id % 3 = 0 THEN 'PMID:' || doc_id WHEN doc_id % 3 = 1 THEN 'PMC' || doc_id ELSE source END AS analysis_doc_id, sha1(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS text_hash FROM documents""")
def identifiers(spark, sf_dir):
    i = F.col("doc_id")
    key = lambda k: F.when(i % 3 == k, i.cast("string")).otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", text.chunk_doc_id(F.lit(""), F.lit(None), "source").alias("chunk_doc_id"), text.analysis_doc_id(key(0), key(1), "source").alias("analysis_doc_id"), text.text_hash("text").alias("text_hash"))


def _squeeze(x: str) -> str:
    for c in "?!,.;:":
        x = f"regexp_replace({x}, '[{c}]+', '{c}', 'g')"
    return x


@query(r"SELECT conv_id, turn, trim(substr(trim(regexp_replace(" + _squeeze(r"trim(regexp_replace(translate(text, '，。？！；：（）、', ',.?!;:(),'), '\s+', ' ', 'g'))") + ", '[?.!,;:]+$', '')), 1, 1000)) AS clean_query FROM conversations")
def clean_queries(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.clean_query("text").alias("clean_query"))


@query(f"""WITH x AS (SELECT n_chars::DOUBLE AS v FROM documents), e AS (SELECT min(v) AS a, max(v) AS b FROM x)
SELECT CAST(least(floor((v - a) / ((b - a) / 20)), 19) AS INTEGER) AS bin, count(*) AS count FROM x, e GROUP BY 1""")
def histogram(spark, sf_dir):
    return profile.histogram(table(spark, sf_dir, "documents"), "n_chars", 20).select("bin", "count")


@query("SELECT metric, value FROM (SELECT count(*)::DOUBLE AS documents, sum(n_chars)::DOUBLE AS characters, count(DISTINCT source)::DOUBLE AS sources FROM documents) UNPIVOT (value FOR metric IN (documents, characters, sources))")
def metric_table(spark, sf_dir):
    d = table(spark, sf_dir, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").alias("characters"), F.count_distinct("source").alias("sources"))
    return tall(d, ["documents", "characters", "sources"])


@query("SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS doc_idx FROM documents")
def row_numbers(spark, sf_dir):
    return row_index(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id").select("doc_id", "doc_idx")


@query("""SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND (o_orderstatus = 'F' OR o_custkey <> 5) AND o_orderstatus NOT IN ('P')""")
def where_filter(spark, sf_dir):
    where = {"$and": [{"o_orderpriority": {"$in": ["1-URGENT", "2-HIGH"]}}, {"$or": [{"o_orderstatus": "F"}, {"o_custkey": {"$ne": 5}}]}, {"o_orderstatus": {"$nin": ["P"]}}]}
    return table(spark, sf_dir, "orders").filter(filters.compile_where(where)).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query("""SELECT c.c_custkey, count(o.o_orderkey) AS orders, coalesce(round(sum(o.o_totalprice), 2), 0.0) AS total FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1""")
def left_join_counts(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("orders"), F.sum("o_totalprice").alias("total"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", F.coalesce("orders", F.lit(0)).alias("orders"), F.coalesce(F.round("total", 2), F.lit(0.0)).alias("total"))


@query("""SELECT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def unlabelled(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti")


_TERMS = r"""list_concat({0}, list_filter(flatten(list_transform({0}, lambda t: CASE WHEN regexp_matches(t, '[-./]') THEN string_split_regex(t, '[-./]') ELSE CAST([] AS VARCHAR[]) END)), lambda p: p <> ''))"""
_LIST = _TERMS.format(r"regexp_extract_all(replace(lower({0}), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+(?:[-./][\p{{L}}\p{{N}}]+)*')")
_BM25 = f"""WITH t AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx, {_LIST.format('text')} AS t FROM documents),
p AS (SELECT term, doc_id, doc_idx, dl, count(*) AS tf FROM (SELECT doc_id, doc_idx, len(t) AS dl, unnest(t) AS term FROM t) GROUP BY ALL),
s AS (SELECT count(*) AS n, sum(len(t)) / count(*) AS avgdl FROM t), df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, unnest({_LIST.format('text')}) AS term FROM benchmark) GROUP BY ALL),
sc AS (SELECT query_id, doc_id, doc_idx, sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score FROM q JOIN df USING (term) JOIN p USING (term), s GROUP BY ALL)
"""


def _index(spark, sf_dir):
    return bm25.build(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), ["doc_id"])


@query(_BM25 + "SELECT n, round(avgdl, 6) AS avgdl, (SELECT sum(len(t)) FROM t)::BIGINT AS tokens, (SELECT count(*) FROM df) AS vocabulary FROM s")
def bm25_stats(spark, sf_dir):
    return _r(_index(spark, sf_dir).stats, "avgdl")


@query(_BM25 + "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_idx) AS INTEGER) AS rank FROM sc) WHERE rank <= 10")
def bm25_search(spark, sf_dir):
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return _r(bm25.search(_index(spark, sf_dir), q, 10).select("query_id", "rank", "doc_id", "score"), "score")


@query(_BM25 + """, f AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_idx) AS r FROM sc)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM (SELECT f.*, CAST(row_number() OVER (PARTITION BY query_id ORDER BY r) AS INTEGER) AS rank FROM f JOIN documents USING (doc_id) WHERE r <= 25 AND lang = 'en') WHERE rank <= 5""")
def bm25_filtered(spark, sf_dir):
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return _r(bm25.search(_index(spark, sf_dir), q, 5, {"lang": "en"}).select("query_id", "rank", "doc_id", "score"), "score")


_KNN = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
u AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM e),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) / (q.n * c.n) AS score FROM u q JOIN u c ON q.vec_id % 20 = 0),
vector AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) AS INTEGER) AS rank FROM s) WHERE rank <= 20)
"""
_LISTS = _KNN + """, k AS (SELECT q.vec_id AS query_id, c.vec_id AS chunk_id, 1.0::DOUBLE / (1 + abs(q.vec_id - c.vec_id)) AS score FROM embeddings q JOIN embeddings c ON q.label = c.label AND q.vec_id % 20 = 0),
keyword AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS INTEGER) AS rank FROM k) WHERE rank <= 20),
m AS (SELECT coalesce(v.query_id, k.query_id) AS query_id, coalesce(v.chunk_id, k.chunk_id) AS chunk_id, v.rank AS vr, k.rank AS kr, v.score AS vs, k.score AS ks FROM vector v FULL JOIN keyword k ON v.query_id = k.query_id AND v.chunk_id = k.chunk_id),
rrf AS (SELECT query_id, chunk_id, coalesce(1.0::DOUBLE / (60 + vr), 0) + coalesce(1.0::DOUBLE / (60 + kr), 0) AS fusion_score, vr, kr, 'rrf' AS fusion_strategy FROM m),
w AS (SELECT *, min(round(vs, 9)) OVER q AS a, max(round(vs, 9)) OVER q AS b, min(ks) OVER q AS c, max(ks) OVER q AS d FROM m WINDOW q AS (PARTITION BY query_id)),
weighted AS (SELECT query_id, chunk_id, round(0.65 * (CASE WHEN vs IS NULL THEN 0 WHEN b > a THEN (round(vs, 9) - a) / (b - a) ELSE 1 END) + 0.35 * (CASE WHEN ks IS NULL THEN 0 WHEN d > c THEN (ks - c) / (d - c) ELSE 1 END), 12) AS fusion_score, vr, kr, 'weighted' AS fusion_strategy FROM w),
two AS (SELECT *, CAST(row_number() OVER (PARTITION BY fusion_strategy, query_id ORDER BY fusion_score DESC, coalesce(vr, 1000000000), coalesce(kr, 1000000000), chunk_id) AS INTEGER) AS fusion_rank FROM (SELECT * FROM rrf UNION ALL SELECT * FROM weighted)),
simple AS (SELECT query_id, chunk_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY least(coalesce(vr, 1000000000) * 2, coalesce(kr, 1000000000) * 2 + 1), chunk_id) AS INTEGER) AS fusion_rank FROM m),
fused AS (SELECT query_id, chunk_id, fusion_strategy, fusion_rank, fusion_score FROM two UNION ALL SELECT query_id, chunk_id, 'simple', fusion_rank, 1.0::DOUBLE / fusion_rank FROM simple)
"""


def _vector(spark, sf_dir, k=20):
    e = table(spark, sf_dir, "embeddings")
    q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.knn(e.select(F.col("vec_id").alias("chunk_id"), "embedding"), q, k, id_col="chunk_id").select("query_id", "chunk_id", "rank", "score")


def _keyword(spark, sf_dir, k=20):
    """A second path: rows of the same label, near in number.

    Rows are numbered by label and id, so the nearest of a label are among the k
    places before and after; no label's rows are paired with each other.
    """
    e = row_index(table(spark, sf_dir, "embeddings").select("vec_id", "label"), "label", "vec_id", name="at")
    q = e.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "label", F.explode(F.sequence(F.col("at") - k, F.col("at") + k)).alias("at"))
    s = q.join(e, ["at", "label"]).select("query_id", F.col("vec_id").alias("chunk_id"), (1.0 / (1 + F.abs(F.col("query_id") - F.col("vec_id")))).alias("score"))
    return top_per_group(s, ["query_id"], [F.desc("score"), F.col("chunk_id")], k).select("query_id", "chunk_id", "rank", "score")


def _fused(spark, sf_dir, k=None):
    vector = _vector(spark, sf_dir).withColumn("score", F.round("score", 9))
    m = cut_lineage(fusion.merge(vector, _keyword(spark, sf_dir)), "candidates")  # for all strategies
    out = None
    for s in ("simple", "rrf", "weighted"):
        f = fusion.fuse(m, s, k).select("query_id", "chunk_id", "fusion_strategy", "fusion_rank", "fusion_score")
        out = f if out is None else out.unionByName(f)
    return out


@query(_KNN + "SELECT query_id, rank, chunk_id, round(score, 6) AS score FROM vector")
def knn(spark, sf_dir):
    return _r(_vector(spark, sf_dir), "score")


@query(_KNN + "SELECT count(*) AS probes, avg(s) AS top1_self_rate, round(avg(d), 6) AS topk_same_doc_rate FROM (SELECT query_id, max(CASE WHEN rank = 1 AND chunk_id = query_id THEN 1 ELSE 0 END) AS s, max(CASE WHEN c.label = q.label THEN 1 ELSE 0 END) AS d FROM vector JOIN embeddings c ON c.vec_id = chunk_id JOIN embeddings q ON q.vec_id = query_id WHERE rank <= 3 GROUP BY 1)")
def self_similarity(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return _r(vectors.self_similarity(e, e.filter("vec_id % 20 = 0").select("vec_id", "embedding"), "vec_id", "label"), "topk_same_doc_rate")


@query(_LISTS + "SELECT query_id, chunk_id, fusion_strategy, fusion_rank, round(fusion_score, 6) AS fusion_score FROM fused WHERE fusion_rank <= 15")
def fusion_strategies(spark, sf_dir):
    return _r(_fused(spark, sf_dir, 15), "fusion_score")


_FINAL = _LISTS + """, f AS (SELECT *, min(fusion_score) OVER q AS lo, max(fusion_score) OVER q AS hi, 2000 + chunk_id % 30 AS y, CASE chunk_id % 3 WHEN 0 THEN 0.75 WHEN 1 THEN 0.9 ELSE 0.5 END AS authority FROM fused WHERE fusion_rank <= 15 WINDOW q AS (PARTITION BY fusion_strategy, query_id)),
g AS (SELECT *, round(CASE WHEN hi > lo THEN (fusion_score - lo) / (hi - lo) WHEN hi > 0 THEN 1 ELSE 0 END, 9) AS relevance, greatest(0, least(1, 1 - greatest(2025 - y, 0) / 20.0::DOUBLE)) AS recency FROM f),
h AS (SELECT *, round(0.6 * relevance + 0.25 * recency + 0.15 * authority, 9) AS final_score, chunk_id // 3 AS document_key FROM g),
i AS (SELECT *, row_number() OVER (PARTITION BY fusion_strategy, query_id ORDER BY final_score DESC, relevance DESC, chunk_id) AS r FROM h),
j AS (SELECT *, row_number() OVER (PARTITION BY fusion_strategy, query_id, document_key ORDER BY r) AS d, count(*) OVER (PARTITION BY fusion_strategy, query_id, document_key) AS same_doc_candidate_count FROM i),
final AS (SELECT *, CAST(row_number() OVER (PARTITION BY fusion_strategy, query_id ORDER BY r) AS INTEGER) AS final_rank FROM j WHERE d = 1)
"""


def _final(spark, sf_dir):
    from pyspark.sql.window import Window

    i = F.col("chunk_id")
    f = _fused(spark, sf_dir, 15).withColumn("run", F.concat_ws("|", "fusion_strategy", "query_id"))
    f = ranking.fallback_relevance(f, "run").withColumn("relevance_score", F.round("relevance_score", 9))
    f = f.withColumns({"journal": F.when(i % 3 == 0, "PLoS  ONE").when(i % 3 == 1, "PLoS Biology").otherwise("Other"), "pub_year": (2000 + i % 30).cast("string")})
    s = ranking.score(f, 2025, query_id="run").withColumn("final_score", F.round("final_score", 9))
    s = s.withColumn("final_rank", F.row_number().over(Window.partitionBy("run").orderBy(F.desc("final_score"), F.desc("relevance_score"), "chunk_id")))
    return ranking.dedupe_documents(s, ranking.document_key(F.floor(i / 3).cast("string")), query_id="run").withColumn("document_key", F.col("document_key").cast("long"))


@query(_FINAL + "SELECT query_id, fusion_strategy, final_rank, document_key, chunk_id, round(final_score, 6) AS final_score, same_doc_candidate_count FROM final WHERE final_rank <= 10")
def final_ranking(spark, sf_dir):
    return _r(_final(spark, sf_dir).filter("final_rank <= 10").select("query_id", "fusion_strategy", "final_rank", "document_key", "chunk_id", "final_score", "same_doc_candidate_count"), "final_score")


_JUDGED = _FINAL + """, jd AS (SELECT DISTINCT query_id, document_key, CAST((document_key * 7 + query_id) % 3 AS INTEGER) AS label FROM final),
top AS (SELECT f.query_id, fusion_strategy, f.document_key, final_rank, label FROM final f JOIN jd USING (query_id, document_key) WHERE final_rank <= 10),
per AS (SELECT query_id, fusion_strategy, count(*) FILTER (WHERE label >= 1) AS got, min(final_rank) FILTER (WHERE label >= 1) AS fst, sum((2 ** label - 1) / log2(final_rank + 1)) AS dcg FROM top GROUP BY ALL),
ideal AS (SELECT query_id, count(*) FILTER (WHERE label >= 1) AS pool, sum(CASE WHEN r <= 10 THEN (2 ** label - 1) / log2(r + 1) ELSE 0 END) AS idcg FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY label DESC, document_key) AS r FROM jd) GROUP BY 1),
metrics AS (SELECT query_id, fusion_strategy, coalesce(pool, 0) AS pool, got, CASE WHEN pool > 0 THEN got / pool ELSE 0 END AS rec, coalesce(1.0::DOUBLE / fst, 0) AS mrr, CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0 END AS ndcg FROM per LEFT JOIN ideal USING (query_id))
"""


def _judged(spark, sf_dir):
    r = cut_lineage(_final(spark, sf_dir), "final")
    j = r.select("query_id", "document_key").distinct().withColumn("relevance_label", ((F.col("document_key") * 7 + F.col("query_id")) % 3).cast("int"))
    return r, j


@query(_JUDGED + "SELECT query_id, fusion_strategy, pool AS pooled_relevant_document_count, got AS retrieved_relevant_count_at_10, round(rec, 6) AS pooled_recall_at_10, round(mrr, 6) AS mrr_at_10, round(ndcg, 6) AS ndcg_at_10 FROM metrics")
def evaluation_metrics(spark, sf_dir):
    r, j = _judged(spark, sf_dir)
    return _r(evaluation.metrics(r, j), "pooled_recall_at_10", "mrr_at_10", "ndcg_at_10")


@query(_JUDGED + "SELECT fusion_strategy, round(avg(rec), 6) AS pooled_recall_at_10, round(avg(mrr), 6) AS mrr_at_10, round(avg(ndcg), 6) AS ndcg_at_10 FROM metrics GROUP BY 1")
def evaluation_summary(spark, sf_dir):
    r, j = _judged(spark, sf_dir)
    return _r(evaluation.summary(evaluation.metrics(r, j)), "pooled_recall_at_10", "mrr_at_10", "ndcg_at_10")


_SYSTEMS = ("simple", "rrf", "weighted")


@query(_FINAL + """, sets AS (SELECT query_id, fusion_strategy, list_position(['simple', 'rrf', 'weighted'], fusion_strategy) AS pos, document_key AS k FROM final WHERE final_rank <= 5),
n AS (SELECT query_id, fusion_strategy, pos, count(*) AS n FROM sets GROUP BY ALL),
x AS (SELECT a.query_id, a.fusion_strategy AS "left", b.fusion_strategy AS "right", count(c.k) AS i, any_value(a.n) AS na, any_value(b.n) AS nb FROM n a JOIN n b ON a.query_id = b.query_id AND a.pos < b.pos
 LEFT JOIN (SELECT s.query_id, s.fusion_strategy AS l, t.fusion_strategy AS r, s.k FROM sets s JOIN sets t ON s.query_id = t.query_id AND s.k = t.k) c ON c.query_id = a.query_id AND c.l = a.fusion_strategy AND c.r = b.fusion_strategy GROUP BY 1, 2, 3)
SELECT query_id, "left", "right", i AS intersection, round(i / least(na, nb), 6) AS overlap_rate, round(i / (na + nb - i), 6) AS jaccard FROM x""")
def strategy_overlaps(spark, sf_dir):
    o = evaluation.overlaps(_final(spark, sf_dir), "document_key", _SYSTEMS, 5)
    return _r(o.withColumn("intersection", F.col("intersection").cast("long")), "overlap_rate", "jaccard")


@query(_FINAL + """SELECT query_id, document_key, coalesce(min(final_rank) FILTER (WHERE fusion_strategy = 'simple'), 0) AS simple_rank, coalesce(min(final_rank) FILTER (WHERE fusion_strategy = 'rrf'), 0) AS rrf_rank, coalesce(min(final_rank) FILTER (WHERE fusion_strategy = 'weighted'), 0) AS weighted_rank FROM final GROUP BY 1, 2""")
def annotation_pool(spark, sf_dir):
    return evaluation.annotation_pool(_final(spark, sf_dir), _SYSTEMS).na.fill(0)


@query(_FINAL + """, a AS (SELECT query_id, final_rank, max(document_key) FILTER (WHERE fusion_strategy = 'simple') AS x, max(document_key) FILTER (WHERE fusion_strategy = 'rrf') AS y FROM final GROUP BY 1, 2)
SELECT query_id, bool_and(x IS NOT DISTINCT FROM y) AS same FROM a WHERE x IS NOT NULL OR y IS NOT NULL GROUP BY 1""")
def exact_match(spark, sf_dir):
    return evaluation.exact_match(_final(spark, sf_dir), "simple", "rrf", "document_key")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMP AS window_start, event_type, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY 1, 2""")
def event_windows(spark, sf_dir):
    w = F.window("ts", "1 hour")
    d = table(spark, sf_dir, "events").groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return _r(d.select(F.col("w.start").alias("window_start"), "event_type", "n", "total"), "total")


@query(f"""WITH t AS (SELECT n, CASE WHEN n <= 0 THEN 0 WHEN n <= 400 THEN 1 ELSE 1 + CAST(ceil((n - 400) / 320) AS BIGINT) END AS e FROM (SELECT {_TOKENS.format('text')} AS n FROM documents)),
r AS (SELECT count(*)::DOUBLE AS documents, round(avg(n), 6) AS mean, round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, count(*) FILTER (WHERE n > 512)::DOUBLE AS over_512,
 round(count(*) FILTER (WHERE n > 512) / count(*), 6) AS over_512_rate, sum(e)::DOUBLE AS estimated_chunks, round(quantile_cont(e, 0.95), 6) AS estimated_chunks_p95 FROM t)
SELECT metric, value FROM r UNPIVOT (value FOR metric IN (documents, mean, median, p95, p99, over_512, over_512_rate, estimated_chunks, estimated_chunks_p95))""")
def split_summary(spark, sf_dir):
    n = text.approx_token_len("text")
    d = table(spark, sf_dir, "documents").select(n.alias("n"), text.chunk_estimate(n).alias("e"))
    return _r(reporting.split_summary(d, "n", "e"), "value")


@query("SELECT source, string_agg(lang || '=' || n, '; ' ORDER BY lang || '=' || n) AS breakdown FROM (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL) GROUP BY source")
def source_breakdown(spark, sf_dir):
    return reporting.breakdown(table(spark, sf_dir, "documents"), "source", "lang")


@query("SELECT role AS route, count(*) AS documents, sum(n)::BIGINT AS chunks, round(avg(n), 6) AS mean, quantile_cont(n, 0.5) AS median, round(quantile_cont(n, 0.95), 6) AS p95 FROM (SELECT role, conv_id, count(*) AS n FROM conversations GROUP BY ALL) GROUP BY role")
def rows_per_document(spark, sf_dir):
    out = reporting.chunks_per_document(table(spark, sf_dir, "conversations"), "role", "conv_id")
    return _r(out.withColumnRenamed("role", "route"), "mean", "p95")


@query("SELECT count(*) AS rows, bool_and(props IS NOT NULL AND value IS NOT NULL) AS all_complete, round(count(*) FILTER (WHERE props IS NOT NULL AND value IS NOT NULL) / count(*), 6) AS complete_rate FROM events")
def completeness(spark, sf_dir):
    return _r(reporting.completeness(table(spark, sf_dir, "events"), ["props", "value"]), "complete_rate")


@query("SELECT round(avg(n_chars), 3) AS mean, min(n_chars)::DOUBLE AS min, max(n_chars)::DOUBLE AS max, round(quantile_cont(n_chars, 0.95), 6) AS p95 FROM documents")
def token_stats(spark, sf_dir):
    return _r(reporting.token_stats(table(spark, sf_dir, "documents"), "n_chars"), "p95")


@query()
def chunks(spark, sf_dir):
    """All documents as chunks: paragraphs are sections."""
    d = records(spark, sf_dir)
    parts = F.filter(F.transform(F.split("body", "\n"), lambda p, i: F.struct(i.alias("section_index"), F.concat(F.lit("Part "), (i + 1).cast("string")).alias("section_title"), F.concat(F.lit("part "), (i + 1).cast("string")).alias("section_title_norm"), p.alias("section_text"))), lambda s: F.btrim(s.section_text) != "")
    docs = d.select(F.col("doc_id").cast("string").alias("doc_id"), "title", F.lit("").alias("abstract"), "body", parts.alias("sections"), "lang")
    return chunking.chunk_documents(docs)


@query()
def chunk_integrity(spark, sf_dir):
    return chunking.integrity(chunks(spark, sf_dir))


@query()
def split_strategies(spark, sf_dir):
    return chunking.compare_strategies(table(spark, sf_dir, "documents"), "text")


@query("""WITH q AS (SELECT quantile_cont(n_chars, 1/3) AS a, quantile_cont(n_chars, 2/3) AS b FROM documents), g AS (SELECT doc_id, CASE WHEN n_chars <= a THEN 'short' WHEN n_chars <= b THEN 'medium' ELSE 'long' END AS length_group FROM documents, q)
SELECT doc_id, length_group FROM (SELECT *, row_number() OVER (PARTITION BY length_group ORDER BY md5(doc_id || ':42'), doc_id) AS r FROM g) WHERE r <= 5""")
def stratified_sample(spark, sf_dir):
    d = profile.with_length_group(table(spark, sf_dir, "documents"), "n_chars")
    return profile.stratified_sample(d, "length_group", 5, "doc_id").select("doc_id", "length_group")


@query(r"""WITH b AS (SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS words, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: length(trim(x)) >= 20) AS s,
 len(regexp_extract_all(text, '(?i)\bp\s*[<=>]\s*0?\.\d+|\b95%\s*CI\b|\bconfidence intervals?\b|\bodds ratios?\b|\brelative risks?\b|\d+(?:\.\d+)?%')) AS statistic_mentions,
 list_filter(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '_', 'g'), '\b[A-Z][A-Z0-9\-]{1,12}\b'), lambda w: NOT list_contains([""" + ",".join(f"'{w}'" for w in text.NOISY_ABBREVIATIONS) + r"""], w)) AS terms FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(terms) AS term FROM b) GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, term) AS r FROM c),
t AS (SELECT doc_id, sum(n)::BIGINT AS mentions, string_agg(term || '(' || n || ')', '; ' ORDER BY r) AS listed FROM r WHERE r <= 10 GROUP BY 1)
SELECT b.doc_id, CAST(words AS INTEGER) AS words, CAST(len(s) AS INTEGER) AS sentences, CASE WHEN len(s) = 0 THEN 0.0 ELSE round(list_sum(list_transform(s, lambda x: len(regexp_extract_all(x, '[A-Za-z]+')))) / len(s), 2) END AS mean_sentence_words, coalesce(mentions, 0) AS mentions,
 round(coalesce(mentions, 0) / greatest(1, words) * 1000, 2) AS per_1000_words, CAST(statistic_mentions AS INTEGER) AS statistic_mentions, coalesce(listed, '') AS top_abbreviations FROM b LEFT JOIN t USING (doc_id)""")
def text_density(spark, sf_dir):
    return profile.density(table(spark, sf_dir, "documents"), "text", "doc_id")


@query()
def query_understanding(spark, sf_dir):
    q = table(spark, sf_dir, "conversations").filter("role = 'user'").select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), F.col("text").alias("query"))
    return understanding.understand(q).select("query_id", "clean_query", F.size("entities").alias("entities"), "vector_query", "where_filter", "filter_plan", "status")


@query()
def hashed_embeddings(spark, sf_dir):
    return vectors.embed(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", "hash", dim=64).select("doc_id", "embedding")


@query()
def retrieval(spark, sf_dir):
    """The whole pipeline for the benchmark's queries over all documents."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("source").alias("journal"), F.lit("2020").alias("pub_year"))
    made = vectors.embed(d, "text", "hash", dim=64)
    q = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))
    p = Retrieval(made, bm25.build(d, ["doc_id"]), 2025, embedding_options={"dim": 64})
    out = p.run(q, reranker="overlap")
    return out.select("query_id", "final_rank", "document_key", "fusion_score", "relevance_score", "final_score")


__all__ = ["ORACLE_SQL", "QUERIES", "numeric", "udf"]
