import math
import random
import re
from dataclasses import dataclass

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Row
from pyspark.sql import functions as F

from docweave.functions import udf
from docweave.operators import bm25, chunking, evaluation, filters, fusion, profile, ranking, understanding, vectors
from docweave.operators.common import row_index
from docweave.operators.vector_index import VectorIndex
from docweave.plans.retrieval import Retrieval, smoke

ROWS = [("a", "insulin and glucose in diabetes", "x"), ("b", "insulin insulin therapy", "x"), ("c", "lung cancer", "y"), ("d", "", "y"), ("e", None, "z")]


@pytest.fixture(scope="module")
def chunks(spark):
    return spark.createDataFrame(ROWS, "chunk_id string, text string, journal string")


def test_bm25_by_hand(spark, chunks):
    index = bm25.build(chunks, ["chunk_id"])
    s = index.stats.first()
    assert (s.n, s.tokens, s.vocabulary, s.avgdl) == (5, 10, 8, 2.0)
    q = spark.createDataFrame([("q1", "Insulin therapy"), ("q2", ""), ("q3", "absent"), ("q4", None)], "query_id string, query string")
    got = {(r.query_id, r.chunk_id): (r.rank, r.score) for r in bm25.search(index, q).collect()}
    idf = lambda df: math.log(1 + (5 - df + 0.5) / (df + 0.5))
    part = lambda tf, dl: tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / 2))
    assert got == {("q1", "b"): (1, pytest.approx(idf(2) * part(2, 3) + idf(1) * part(1, 3))), ("q1", "a"): (2, pytest.approx(idf(2) * part(1, 5)))}
    assert bm25.search(index, q, 0).count() == 0
    with pytest.raises(ValueError):
        bm25.Bm25Index(None, None, None, None, k1=0)


def test_bm25_files_and_filters(spark, chunks, tmp_path):
    bm25.build(chunks, ["chunk_id"]).write(str(tmp_path / "i"))
    index = bm25.Bm25Index.read(spark, str(tmp_path / "i"))
    q = spark.createDataFrame([("q", "insulin cancer")], "query_id string, query string")
    top = lambda **o: [(r.rank, r.chunk_id) for r in bm25.search(index, q, 1, **o).orderBy("rank").collect()]
    assert top(where={"journal": "x"}, over_fetch=1) in ([], [(1, "b")]) and top(where={"journal": "x"}, prefilter=True) == [(1, "b")]
    with pytest.raises(Exception, match="(?i)exist"):
        index.write(str(tmp_path / "i"))


def test_an_empty_index_finds_nothing(spark, chunks):
    index = bm25.build(chunks.limit(0), ["chunk_id"])
    q = spark.createDataFrame([("q", "insulin")], "query_id string, query string")
    assert bm25.search(index, q).count() == 0 and index.stats.first().avgdl == 0


@pytest.mark.parametrize(
    "where,keep",
    [(None, "1234"), ({"a": "x"}, "1"), ({"a": 5}, "3"), ({"a": {"$ne": "x"}}, "234"), ({"a": {"$in": ["x", "y"]}}, "12"), ({"a": {"$nin": ["x"]}}, "234"), ({"$or": [{"a": "x"}, {"b": "2"}], "a": "ignored"}, "12"), ({"$and": [{"a": "x"}, {"b": "1"}]}, "1"), ({"a": {"$gt": 3}}, "1234"), ({"a": {"$eq": "y"}}, "2")],
)
def test_where(spark, where, keep):
    df = spark.createDataFrame([("x", "1"), ("y", "2"), ("5", "3"), (None, "4")], "a string, b string")
    assert "".join(sorted(r.b for r in df.filter(filters.compile_where(where)).collect())) == keep


def test_filter_helpers():
    assert filters.merge_where({"a": 1}, None) == {"a": 1} and filters.merge_where({"a": 1}, {"b": 2}) == {"$and": [{"a": 1}, {"b": 2}]}
    assert filters.part_ids("0,2-4") == {0, 2, 3, 4} and filters.part_ids(" ") is None
    with pytest.raises(ValueError):
        filters.parse_where("[1]")
    with pytest.raises(ValueError):
        filters.part_ids("4-2")


def lists(spark):
    v = spark.createDataFrame([("q", "a", 1, 0.9, {"k": "v"}), ("q", "b", 2, 0.5, {}), ("q", "c", 3, 0.1, None)], "query_id string, chunk_id string, rank int, score double, metadata map<string,string>")
    k = spark.createDataFrame([("q", "b", 1, 7.0, {"k": "w", "j": "x"}), ("q", "d", 2, 7.0, {"z": "1"})], "query_id string, chunk_id string, rank int, score double, metadata map<string,string>")
    return fusion.merge(v, k)


def test_merge(spark):
    rows = {r.chunk_id: r for r in lists(spark).collect()}
    assert rows["b"].retrieval_sources == ["vector", "bm25"] and rows["d"].retrieval_sources == ["bm25"]
    assert rows["b"].metadata == {"k": "w", "j": "x"} and rows["a"].metadata == {"k": "v"} and rows["d"].vector_score is None


def test_fusion_strategies(spark):
    order = lambda s, **o: [(r.chunk_id, round(r.fusion_score, 6)) for r in fusion.fuse(lists(spark), s, **o).orderBy("fusion_rank").collect()]
    assert [c for c, _ in order("simple")] == ["a", "b", "d", "c"] and order("simple")[1][1] == 0.5
    assert order("rrf") == [("b", round(1 / 62 + 1 / 61, 6)), ("a", round(1 / 61, 6)), ("d", round(1 / 62, 6)), ("c", round(1 / 63, 6))]
    assert order("weighted") == [("b", 0.675), ("a", 0.65), ("d", 0.35), ("c", 0.0)]
    assert len(order("rrf", top_k=2)) == 2
    with pytest.raises(ValueError):
        fusion.fuse(lists(spark), "other")


def test_golden_final_score(spark):
    df = spark.createDataFrame([("q", "c1", 1, 1 / 61, "PLoS Medicine", "2004")], "query_id string, chunk_id string, fusion_rank int, fusion_score double, journal string, pub_year string")
    r = ranking.score(ranking.fallback_relevance(df), 2026).first()
    assert (r.relevance_score, r.recency_score, r.authority_score, r.final_rank) == (1.0, 0.0, 0.9, 1) and r.final_score == pytest.approx(0.735)


def test_dedupe_documents(spark):
    df = spark.createDataFrame([("q", "a", 1, "D", 0.9), ("q", "b", 2, "D", 0.8), ("q", "c", 3, " ", 0.7)], "query_id string, chunk_id string, final_rank int, doc string, final_score double")
    rows = ranking.dedupe_documents(df, ranking.document_key("doc", "chunk_id")).orderBy("final_rank").collect()
    assert [(r.document_key, r.final_rank, r.same_doc_candidate_count) for r in rows] == [("D", 1, 2), ("c", 2, 1)]


def test_metrics_by_hand(spark):
    res = spark.createDataFrame([("q", "s", "a", 1), ("q", "s", "b", 2), ("q", "s", "c", 3)], "query_id string, fusion_strategy string, document_key string, final_rank int")
    lab = spark.createDataFrame([("q", "a", 0), ("q", "b", 2), ("q", "c", 1), ("q", "z", 2)], "query_id string, document_key string, relevance_label int")
    r = evaluation.metrics(res, lab).first()
    dcg = 3 / math.log2(3) + 1 / math.log2(4)
    ideal = 3 + 3 / math.log2(3) + 1 / math.log2(4)
    assert (r.pooled_relevant_document_count, r.retrieved_relevant_count_at_10) == (3, 2)
    assert r.pooled_recall_at_10 == pytest.approx(2 / 3) and r.mrr_at_10 == 0.5 and r.ndcg_at_10 == pytest.approx(dcg / ideal)
    evaluation.require_judged(res, lab)
    with pytest.raises(ValueError):
        evaluation.require_judged(res, lab.limit(0))
    assert evaluation.winner(evaluation.summary(evaluation.metrics(res, lab))).first()[0] == "s"


def test_select_queries(spark):
    q = spark.createDataFrame([("Q1",), ("Q2",), ("Q3",)], "query_id string")
    assert [r[0] for r in evaluation.select_queries(q, ["q3", "q1"], 1).collect()] == ["Q1"]
    with pytest.raises(ValueError):
        evaluation.select_queries(q, ["q9"])


def test_row_index(spark):
    df = spark.range(1000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(10**9)))
    rows = row_index(df, "k").orderBy("doc_idx").collect()
    assert [r.doc_idx for r in rows] == list(range(1000)) and [r.k for r in rows] == sorted(r.k for r in rows)


@pytest.mark.parametrize("adaptive,advised", [("true", "1k"), ("true", "64m"), ("false", "1k")])
def test_row_index_is_the_same_whatever_reads_it(spark, adaptive, advised):
    keys = {"spark.sql.adaptive.enabled": adaptive, "spark.sql.adaptive.advisoryPartitionSizeInBytes": advised, "spark.sql.adaptive.coalescePartitions.minPartitionSize": advised}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = spark.range(20000).select((F.pmod(F.xxhash64("id"), F.lit(500))).alias("k"), "id", F.repeat(F.lit("text "), F.col("id").cast("int") % 40).alias("text"), F.lit(1).alias("part"))
        made = row_index(df, "k")  # the order has ties
        narrow, wide = made.select("id", "doc_idx").collect(), made.collect()
        assert len(narrow) == 20000 and {r.doc_idx for r in narrow} == set(range(20000))
        assert {(r.id, r.doc_idx) for r in narrow} == {(r.id, r.doc_idx) for r in wide}
        assert [r.k for r in sorted(wide, key=lambda r: r.doc_idx)] == sorted(r.k for r in wide)
        index = bm25.build(df.select("id", "text"), ["id"])
        assert index.stats.first().n == 20000 and index.postings.join(index.store, "doc_idx").filter("tf <> (length(text) / 5)").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_row_index_refuses_a_name_that_is_taken(spark):
    with pytest.raises(ValueError):
        row_index(spark.range(3).withColumn("doc_idx", F.lit(1)), "id")


def test_knn_equals_a_full_sort_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SCORES", 50)
    monkeypatch.setattr(vectors, "QUERY_VALUES", 12)
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    q = df.filter("id % 30 = 0").select(F.col("id").alias("query_id"), "embedding")
    got = {(r.query_id, r["rank"]): r.id for r in vectors.knn(df, q, 7).collect()}
    unit = lambda v: [x / (sum(y * y for y in v) ** 0.5 or 1) for x in v]
    for a, v in rows[::30]:
        best = sorted((-round(sum(x * y for x, y in zip(unit(v), unit(w), strict=True)), 9), b) for b, w in rows)[:7]
        assert [got[a, k] for k in range(1, 8)] == [b for _, b in best]


def test_knn(spark):
    rows = [(f"v{i}", [math.cos(i / 10), math.sin(i / 10)]) for i in range(30)] + [("null", None), ("zero", [0.0, 0.0]), ("longer", [1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "id string, embedding array<float>").withColumn("lang", F.lit("en"))
    q = df.filter("id in ('v3', 'v20', 'null')").select(F.col("id").alias("query_id"), "embedding")
    got = {(r.query_id, r["rank"]): r.id for r in vectors.knn(df, q, 3).collect()}
    assert got["v3", 1] == "v3" and got["v20", 1] == "v20" and len(got) == 6
    assert {got["v3", 2], got["v3", 3]} == {"v2", "v4"} and {got["v20", 2], got["v20", 3]} == {"v19", "v21"}
    assert vectors.knn(df, q, 3, {"lang": "fr"}).count() == 0 and vectors.knn(df, q.limit(0), 3).count() == 0 and vectors.knn(df, q, 0).count() == 0


def test_tfidf(spark):
    df = spark.createDataFrame([("insulin therapy works",), ("lung cancer therapy",)], "text string")
    v = vectors.tfidf(df, "text", 16).transform(df).first().embedding
    assert v.norm(2) == pytest.approx(1)
    idf = vectors.bucket_idf(df, "text", 32)
    assert min(idf.values()) == pytest.approx(1.0) or min(idf.values()) >= 1.0


def test_splitting_keeps_sizes_and_words():
    body = " ".join(f"word{i}" + ("." if i % 9 == 0 else "") for i in range(1500))
    pieces = chunking.split_text(body, 100, 20)
    assert all(0 < chunking.approx_len(p) <= 100 for p in pieces)
    assert {w for p in pieces for w in p.replace(".", "").split()} == set(body.replace(".", "").split())
    assert chunking.split_text("short", 100, 20) == ["short"]
    assert all(chunking.approx_len(chunking.prefix("T", "S") + p) <= 60 for p in chunking.split_to_limit(body, "T", "S", 50, 10, 60))
    with pytest.raises(ValueError):
        chunking.split_text("x", 5, 5)


def test_chunking_routes(spark):
    long = " ".join(f"w{i}" for i in range(900))
    section = "array<struct<section_index:int,section_title:string,section_title_norm:string,section_text:string>>"
    rows = [("a", "T", "", "short body", []), ("b", "", "", long, [(0, "Methods", "methods", long), (1, "Results", "results", "few words")]), ("c", "T", "", long, []), ("d", "T", "", long, [(0, "X", "x", " ")])]
    df = spark.createDataFrame(rows, f"doc_id string, title string, abstract string, body string, sections {section}")
    out = chunking.chunk_documents(df)
    got = {r.doc_id: r for r in out.groupBy("doc_id").agg(F.count("*").alias("n"), F.first("split_strategy").alias("s"), F.max("token_count").alias("t")).collect()}
    assert got["a"].n == 1 and got["a"].s == "whole_document_under_512" and got["b"].s == "semantic_section" and got["d"].s == got["c"].s == "recursive_fallback_no_section"
    assert all(r.t <= 512 for r in got.values())
    bad = chunking.integrity(out).first().asDict()
    assert all(bad[k] == 0 for k in ("duplicate_chunk_ids", "index_gaps", "wrong_totals", "over_limit", "no_tokens", "empty", "garbled", "missing_ids")) and bad["documents"] == 4
    assert out.filter("doc_id = 'b'").first().text.startswith("Title: [Missing title: b]\nSection: Methods\nText:\n")


def test_exclusions(spark):
    df = spark.createDataFrame([(True, False, "", "", "", "", 0), (False, True, "t", "a", "b", "", 9), (False, False, "", " ", "", "", 0), (False, False, "t", "", "", "", 0), (False, False, "t", "a", "b", "severe_x", 0), (False, False, "t", "a", "b", "", 9)], "e boolean, d boolean, t string, a string, b string, n string, k int")
    got = [r[0] for r in df.select(chunking.exclusion_reason(*(F.col(c) for c in "edtabnk"))).collect()]
    assert got == ["xml_parse_error", "duplicate_pmcid", "drop_no_text", "no_body_for_fulltext", "severe_encoding_issue", None]


def entities_of(spark, queries, concepts=None):
    rows = understanding.entities(spark.createDataFrame([(q,) for q in queries], "query string"), concepts).collect()
    return {r["query"]: r.entities for r in rows}


def test_entities(spark):
    q = "MI treatment with metformin, heart attack and EGFRvIII"
    found = entities_of(spark, [q, q, "", "nothing"])
    assert [(e.text, e.normalized, q[e.start : e.end]) for e in found[q]] == [("MI", "myocardial infarction", "MI"), ("treatment", "treatment", "treatment"), ("metformin", "metformin", "metformin")]
    assert set(found) == {q}
    shape = "concept_id string, preferred_term string, terms array<string>, record_type string"
    known = spark.createDataFrame([("D1", "Diabetes Mellitus, Type 2", ["Diabetes Mellitus, Type 2", "type 2 diabetes", "T2D"], "descriptor"), ("D0", "COVID-19", ["covid-19", "x"], "descriptor"), ("D9", "Other", ["Type 2  Diabetes"], "descriptor")], shape)
    both = entities_of(spark, ["type 2 diabetes and insulin", "covid-19", "the covid-19 virus"], known)
    assert [(e.concept_id, e.text) for e in both["type 2 diabetes and insulin"]] == [("D1", "type 2 diabetes"), (None, "insulin")]
    assert both["type 2 diabetes and insulin"][0].synonyms == ["Diabetes Mellitus, Type 2", "T2D"]
    assert [e.concept_id for e in both["covid-19"]] == ["D0"] and "the covid-19 virus" not in both  # a term with a hyphen is found only as a whole query


def brute_entities(query):
    """Every phrase at every place, then the first that clashes with none before, by start and length."""
    found = []
    for phrase, normal, kind in understanding.ENTITIES:
        for a in range(len(query)):
            b = a + len(phrase)
            near = query[max(0, a - 1) : a] + query[b : b + 1]
            if query[a:b].lower() == phrase.lower() and not (re.search("[A-Za-z0-9]", phrase) and re.search("[A-Za-z0-9]", near)):
                found.append((a, -b, b, normal, kind))
    out = []
    for a, _, b, normal, kind in sorted(found):
        if all((b <= x or y <= a) and (kind, normal.lower()) != k for x, y, k in out):
            out.append((a, b, (kind, normal.lower())))
    return [(a, b, n) for a, b, (_, n) in out]


def test_entities_equal_a_scan_of_all_places(spark):
    rng = random.Random(4)
    parts = [p for p, _, _ in understanding.ENTITIES] + ["of", "and", "x", "2", "型", "的", ",", "-", "type", "A"]
    queries = {"".join(rng.choice(parts) + rng.choice([" ", " ", "", ", "]) for _ in range(rng.randint(1, 9))).strip() for _ in range(150)}
    got = entities_of(spark, queries)
    for q in queries:
        assert [(e.start, e.end, e.normalized.lower()) for e in got.get(q, [])] == brute_entities(q), q


def test_query_columns():
    @dataclass
    class Asked:
        clean_query: str

    assert understanding.query_columns({"a": 1}) == {"a": 1} and understanding.query_columns(Asked("x")) == {"clean_query": "x"} and understanding.query_columns(Row(a=1)) == {"a": 1}
    with pytest.raises(TypeError):
        understanding.query_columns("a query")


def test_spans_are_not_the_side_that_is_broadcast(spark, tmp_path):
    spark.createDataFrame([(f"aspirin and {w} " * 40,) for w in "abcdef"], "query string").write.parquet(str(tmp_path / "q"))
    concepts = spark.createDataFrame([("D1", "Aspirin", ["aspirin"], "d")], "concept_id string, preferred_term string, terms array<string>, record_type string")
    for terms, joins in ((None, ["BroadcastHashJoin"]), (concepts, ["BroadcastHashJoin", "SortMergeJoin"])):
        found = understanding.entities(spark.read.parquet(str(tmp_path / "q")), terms)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(re.findall(r"\w+Join(?= \[key)", plan)) == joins and "BuildLeft" not in plan
        assert {tuple((e.normalized, e.start) for e in r.entities) for r in found.collect()} == {(("aspirin" if terms is None else "Aspirin", 0),)}


def test_whole_queries_are_spans_once(spark):
    for q, n in (("a b", 3), ("a b c d e f g h", 36), ("a b c d e f g h i", 45), ("a-", 2), ("-", 1), ("+a", 2), ("糖尿", 3)):
        got = [(r.start, r.end) for r in understanding.spans(spark.createDataFrame([(q,)], "query string")).collect()]
        assert len(got) == len(set(got)) == n and (0, len(q)) in got


def test_understanding(spark):
    rows = [("1", "Does metformin reduce cardiovascular disease?"), ("2", ""), ("3", "2010年关于肺癌EGFR突变的研究"), ("4", "PLoS ONE papers on PCR after 2010"), ("5", "nothing known here"), ("6", "research article in Nature 2015"), ("7", None), ("8", "EGFR mutation " * 200)]
    got = {r.query_id: r for r in understanding.understand(spark.createDataFrame(rows, "query_id string, query string")).collect()}
    assert got["1"].required_terms == ["metformin", "cardiovascular disease"] and "CVD" in got["1"].optional_terms
    assert got["1"].bge_query.startswith(understanding.INSTRUCTION) and got["2"].status == got["7"].status == "invalid_query"
    assert got["3"].where_filter == '{"pub_year":"2010"}' and got["4"].where_filter == '{"journal":"PLoS ONE"}' and '"pub_year_gte":"2010"' in got["4"].filter_plan
    assert got["5"].vector_query == "nothing known here" and got["5"].warnings and len(got["8"].clean_query) <= 1000 and got["8"].warnings
    assert filters.parse_where(got["6"].where_filter) == {"$and": [{"pub_year": "2015"}, {"journal": "Nature"}, {"article_type": "research-article"}]}


def test_profile_helpers(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, ""), ("d", 10, None)], "id string, n int, k string")
    s = profile.length_stats(df, "n", "n", (2,)).first()
    assert s.p95 == pytest.approx(8.95) and s.mean == 4 and s.over_2 == 2
    empty = profile.length_stats(df.limit(0), "n", "n").first()
    assert empty["count"] == 0 and empty.p95 == 0.0
    assert tuple(profile.duplicate_rows(df, F.col("k")).first()) == (2, 1)
    assert sorted((r.id, r.occurrences) for r in profile.with_duplicates(df, F.col("k")).collect()) == [("a", 2), ("b", 2), ("c", 0), ("d", 0)]
    assert sorted(r.id for r in profile.first_of_key(df, "k", "id").collect()) == ["a", "c", "d"]
    assert profile.stratified_sample(df, "k", 1, "id").count() == 3
    got = profile.group_summary(df.na.fill(""), "k", "n", ["x", "none", ""]).collect()
    assert [(r.k, r["count"]) for r in got] == [("x", 2), ("none", 0), ("", 2)]
    v = {r.concept: r.total_mentions for r in profile.variant_mentions(spark.createDataFrame([("HIV hiv PCR pcr heart attack",)], "t string"), "t", profile.CONCEPT_VARIANTS, profile.CASE_SENSITIVE).collect()}
    assert (v["HIV/AIDS"], v["PCR"], v["myocardial infarction"]) == (1, 1, 1)


def test_the_whole_pipeline(spark):
    rows = [(f"c{i}", f"d{i // 2}", t, "PLoS ONE", str(2000 + i)) for i, t in enumerate(["metformin lowers glucose", "metformin trial", "aspirin and bleeding", "insulin therapy", "lung cancer survival", "heart attack mortality"])]
    df = vectors.embed(spark.createDataFrame(rows, "chunk_id string, doc_id string, text string, journal string, pub_year string"), "text", dim=64)
    p = Retrieval(df, bm25.build(df.drop("embedding"), ["chunk_id"]), 2025, embedding_options={"dim": 64})
    q = spark.createDataFrame([("q1", "metformin?"), ("q2", " ")], "query_id string, query string")
    for how in (None, "overlap"):
        out = p.run(q, reranker=how, final_top_k=3).orderBy("final_rank").collect()
        assert out[0].document_key == "d0" and {r.query_id for r in out} == {"q1"} and [r.final_rank for r in out] == list(range(1, len(out) + 1))
    with pytest.raises(ValueError):
        p.run(q, final_top_k=60)


def small_retrieval(spark):
    rows = [(f"c{i}", f"d{i // 2}", t, "PLoS ONE", str(2000 + i)) for i, t in enumerate(["metformin lowers glucose", "metformin trial", "aspirin and bleeding", "insulin therapy"])]
    df = vectors.embed(spark.createDataFrame(rows, "chunk_id string, doc_id string, text string, journal string, pub_year string"), "text", dim=64)
    return Retrieval(df, bm25.build(df.drop("embedding"), ["chunk_id"]), 2025, embedding_options={"dim": 64}), spark.createDataFrame([("q1", "metformin?"), ("q2", " ")], "query_id string, query string")


def test_a_path_that_fails_is_left_out_with_a_warning(spark):
    p, q = small_retrieval(spark)
    p.embedding = "no such back end"
    found = p.answer(q)
    assert found.retrieved.vector_result_count == 0 < found.retrieved.keyword_result_count and found.warnings[0].startswith("vector path failed: KeyError")
    assert {r.document_key for r in found.documents.collect()} == {"d0"} and found.retrieved.weights == {"vector": 0.65, "keyword": 0.35}
    with pytest.raises(KeyError):
        p.answer(q, strict=True)


def test_the_contract_of_rerankers(spark):
    p, q = small_retrieval(spark)

    @F.pandas_udf("double")
    def some(query: pd.Series, passage: pd.Series) -> pd.Series:
        return passage.map(lambda t: None if "trial" in t else 1.0)

    udf.register_reranker("some", lambda: some)
    for how, said in (("none such", "KeyError"), ("some", "have no score")):
        found = p.answer(q, reranker=how)
        assert not found.reranker_used and said in found.warnings[-1] and found.documents.count() > 0
        with pytest.raises((KeyError, RuntimeError)):
            p.answer(q, reranker=how, strict_reranker=True)
    assert p.answer(q, reranker="overlap").reranker_used
    off = p.answer(q, reranker="overlap", disable_reranker=True)
    assert not off.reranker_used and "disabled" in off.warnings[-1]
    with pytest.raises(ValueError):
        p.answer(q, reranker="overlap", strict_reranker=True, disable_reranker=True)


def test_an_instruction_comes_before_queries_only(spark):
    udf.register_embedding("asked", udf.hash_embedding, "find ")
    df = spark.createDataFrame([("a",), (" ",)], "t string")
    plain = [list(r.embedding) for r in vectors.embed(spark.createDataFrame([("find a",), (" ",)], "t string"), "t", "asked", dim=32).collect()]
    asked = [list(r.embedding) for r in vectors.embed_queries(df, "t", "asked", dim=32).collect()]
    assert sorted(plain) == sorted(asked)


def test_vector_index(spark, tmp_path):
    index = VectorIndex(spark, str(tmp_path / "index"))
    with pytest.raises(AnalysisException):
        VectorIndex.open(spark, index.path)
    rows = [(f"c{i}", [float(i), 1.0], "x" if i % 2 else "y", i % 3, f"p{i % 3}") for i in range(9)] + [(None, [1.0, 1.0], "x", 0, "p0"), ("null", None, "x", 0, "p0")]
    df = spark.createDataFrame(rows, "chunk_id string, embedding array<float>, kind string, part_id int, part_file string")
    assert index.upsert(df.filter("part_id = 1")) == 3 and index.upsert(df.filter("part_id = 1")) == 0
    index.build(df, only={0, 1})
    assert index.count() == 6 and sorted(r.part_id for r in index.progress.collect()) == [0, 1]
    index.build(df)
    assert index.count() == 9 and {r.part_id: r.chunk_count for r in index.progress.collect()} == {0: 5, 1: 3, 2: 3}
    assert [r.chunk_id for r in index.get(["c8", "c1", "zz"], include=("kind",)).collect()] == ["c1", "c8"]
    assert all(abs(sum(x * x for x in r.embedding) - 1) < 1e-6 for r in index.entries.collect())
    hit = index.query(df.filter("chunk_id = 'c4'").select(F.col("chunk_id").alias("query_id"), "embedding"), 1, {"kind": "y"}, preview="part_file").first()
    assert (hit.chunk_id, hit.preview) == ("c4", "p1")
    assert {r.filter_name: r.status for r in index.check().collect()}["no_result_filter"] == "error"  # the index has no pmcid


def test_compare_and_smoke(spark):
    p, q = small_retrieval(spark)
    out, warnings = p.compare(q, top_k=4, final_top_k=2)
    rows = out.groupBy("fusion_strategy", "stage").count().collect()
    assert len(rows) == 6 and {r.stage for r in rows} == {"final", "fused"} and any("disabled" in w for w in warnings)
    documents, summary, _ = smoke(p, ("metformin", "nothing at all"), final_top_k=2)
    got = {r["query"]: r for r in summary.collect()}
    assert got["metformin"].first_document == "d0" and got["metformin"].from_keyword > 0 and documents.count() == sum(r.results for r in got.values())
