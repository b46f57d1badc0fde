from pyspark.sql import functions as F

from docweave.operators import chunking, reporting


def test_clean_metadata(spark):
    df = spark.createDataFrame([("a", None, [1, 2], float("nan"), True), (None, 3, None, 1.5, None)], "t string, i int, l array<int>, d double, b boolean")
    rows = reporting.clean_metadata(df, ["t", "i", "l", "d", "b", "absent"]).collect()
    assert [tuple(r) for r in rows] == [("a", "", "[1,2]", "", True), ("", "3", "", "1.5", False)]


def test_result_rows(spark):
    df = spark.createDataFrame([("q", 1, ["vector", "bm25"], "one\ntwo three")], "query_id string, final_rank int, retrieval_sources array<string>, text string")
    r = reporting.result_rows(df, 7).first()
    assert r.retrieval_sources == "vector,bm25" and r.text == "one two" and r.pmid is None and list(r.asDict()) == list(reporting.RESULT_COLUMNS)


def test_rates_of_nothing(spark):
    names = ("has_any_section_title", "has_introduction", "has_methods", "has_results", "has_discussion", "has_conclusion")
    df = spark.createDataFrame([(True,) * 6, (None,) * 6, (True, True, True, True, True, False)], ", ".join(f"{n} boolean" for n in names))
    r = reporting.section_rates(df).first()
    assert (round(r.any_section_rate, 3), round(r.imrad_rate, 3), round(r.imrad_conclusion_rate, 3)) == (0.667, 0.667, 0.333)
    assert reporting.section_rates(df.limit(0)).first().imrad_rate == 0.0
    assert reporting.token_stats(spark.range(0), "id").first().p95 == 0.0
    assert reporting.completeness(df, ["has_methods"]).first().all_complete is False


def test_front_sections_and_abstracts(spark):
    df = spark.createDataFrame([("a", "T", "Abstract.", "body text"), ("b", "", "", "x")], "doc_id string, title string, abstract string, body string").withColumn("sections", F.array().cast("array<struct<section_index:int,section_title:string,section_title_norm:string,section_text:string>>"))
    got = {r.doc_id: r.sections for r in chunking.with_front_section(df).collect()}
    assert got["a"][0].section_text == "T\n\nAbstract." and got["b"] == []
    long = " ".join(f"w{i}" for i in range(900))
    docs = spark.createDataFrame([("a", "short"), ("b", long), ("c", " ")], "doc_id string, text_title_abstract string")
    n = {r.doc_id: r["count"] for r in chunking.chunk_abstracts(docs).groupBy("doc_id").count().collect()}
    assert n["a"] == 1 and n["b"] > 2 and "c" not in n
    how = [r.x.how for r in docs.select(chunking.split_or_keep()("text_title_abstract").alias("x")).collect()]
    assert how == ["section_whole_under_512", "section_recursive_over_512", "empty"]
