import gzip

import pytest
from pyspark.sql import functions as F

from docweave.sources import articles, tables
from docweave.streaming import ingest

ARTICLE = """<?xml version="1.0"?><!DOCTYPE article><article article-type="research-article"><front><journal-meta><journal-title>PLoS ONE</journal-title></journal-meta>
<article-meta><article-id pub-id-type="pmid">11</article-id><article-id pub-id-type="pmc">22</article-id><title-group><article-title>A <i>title</i></article-title></title-group>
<pub-date pub-type="ppub"><year>2009</year></pub-date><pub-date pub-type="epub"><day>3</day><month>4</month><year>2010</year></pub-date><abstract><p>Some</p><p>abstract</p></abstract></article-meta></front>
<body><p>loose</p><sec><title>Methods</title><p>We did.</p><sec><title>Inner</title><p>Deep.</p></sec></sec><sec><p>untitled</p></sec><sec><title>Results</title></sec></body></article>"""


def test_parse_article():
    a = articles.parse_article(ARTICLE)
    assert (a["title"], a["abstract"], a["journal"], a["pub_date"], a["pub_year"], a["pmid"], a["pmcid"], a["article_type"]) == ("A title", "Some abstract", "PLoS ONE", "2010-04-03", "2010", "11", "22", "research-article")
    assert a["body"] == "loose Methods We did. Inner Deep. untitled Results"
    assert a["sections"] == [{"section_index": 0, "section_title": "Methods", "section_title_norm": "methods", "section_text": "We did. Inner Deep."}]
    assert a["section_titles"] == ["Methods", "Inner", "Results"]
    assert articles.parse_article("<a>")["parse_error"] and articles.parse_article("")["title"] == ""


def test_records_from_files(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "b.xml").write_text(ARTICLE)
    (tmp_path / "x" / "y" / "a.xml").write_bytes(b"<article><body><p>bad \xff byte</p></body></article>")
    (tmp_path / "x" / "c.xml").write_text("<broken")
    files = articles.list_files(spark, str(tmp_path / "x"))
    assert articles.require_files(files, 3) == 3
    with pytest.raises(ValueError):
        articles.require_files(files, 4)
    rows = {r.source_file: r for r in articles.records(files).collect()}
    assert {k: r.record_id for k, r in rows.items()} == {"b.xml": "pmc_000001", "c.xml": "pmc_000002", "y/a.xml": "pmc_000003"}
    assert rows["b.xml"].pmcid == "PMC22" and rows["b.xml"].text_title_abstract == "A title\n\nSome abstract"
    assert "�" in rows["y/a.xml"].body and rows["c.xml"].parse_error
    light = {r.source_file: r for r in articles.light_records(articles.records(files)).collect()}
    assert light["b.xml"].doc_id == "PMID:11" and light["b.xml"].has_methods and not light["b.xml"].imrad_core and light["y/a.xml"].quality_decision == "need_review" and light["c.xml"].quality_decision == "drop_no_text"


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nline', None), (2, "é", "x")], "i int, t string, u string")
    tables.write_csv(df, str(tmp_path / "c"), single=True)
    back = tables.read_csv(spark, str(tmp_path / "c"), required=("t",))
    assert [(r.i, r.t, r.u) for r in back.orderBy("i").collect()] == [("1", 'a "q"\nline', ""), ("2", "é", "x")]
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "c"), required=("none",))
    tables.write_jsonl(df, str(tmp_path / "j"))
    assert tables.read_jsonl(spark, str(tmp_path / "j"), df.schema).count() == 2
    tables.write_parquet(df.limit(0), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == df.columns
    assert tables.markdown(df).splitlines()[0] == "| i | t | u |"
    with pytest.raises(ValueError):
        tables.output_prefix("../x")


def test_parts(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for k in range(3):
        pq.write_table(pa.table({"x": [k] * (k + 1)}), tmp_path / f"part_{k:03d}.parquet")
    (tmp_path / "m.csv").write_text("part_id,part_file,chunk_count\n" + "".join(f"{k},part_{k:03d}.parquet,{k + 1}\n" for k in range(3)))
    read = lambda **o: sorted((r.part_id, r.x) for r in tables.read_parts(spark, str(tmp_path / "m.csv"), str(tmp_path), **o).collect())
    assert read(parts={0, 2}) == [(0, 0), (2, 2), (2, 2), (2, 2)] and read(max_parts=1) == [(0, 0)]
    assert tables.row_budget(spark, str(tmp_path / "m.csv"), {1, 2}) == 5 and tables.row_budget(spark, str(tmp_path / "m.csv"), None, 4) == 4


def test_terminology(spark, tmp_path):
    xml = """<S><DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>Heart Attack</String></DescriptorName><TreeNumberList><TreeNumber>C1</TreeNumber></TreeNumberList>
    <ConceptList><Concept><ScopeNote> note </ScopeNote><TermList><Term><String>heart  attack</String></Term><Term><String>MI</String></Term><Term><String>12</String></Term></TermList></Concept></ConceptList></DescriptorRecord>
    <DescriptorRecord><DescriptorUI>D2</DescriptorUI><DescriptorName><String>7</String></DescriptorName></DescriptorRecord></S>"""
    with gzip.open(tmp_path / "d.xml.gz", "wt") as f:
        f.write(xml)
    found = tables.concepts(tables.read_terminology(spark, {"descriptor": str(tmp_path / "d.xml.gz")}))
    rows = {r.concept_id: r for r in found.collect()}
    assert rows["D1"].terms == ["Heart Attack", "MI"] and rows["D1"].tree_numbers == ["C1"] and rows["D2"].skip_reason == "no_valid_terms"
    assert {r.term_key for r in tables.term_index(found.filter("skip_reason is null")).collect()} == {"heart attack", "mi"}
    s = tables.terminology_stats(found).first()
    assert (s.seen, s.kept, s.terms, s.unique_terms) == (2, 1, 2, 2)


def test_incremental_ingest(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    df = spark.range(5).withColumn("v", F.lit("a"))
    df.write.parquet(src)
    go = lambda: ingest.upsert(ingest.stream_table(spark, src, df.schema, 1), out, "id", mark).awaitTermination()
    go()
    spark.range(3, 8).withColumn("v", F.lit("b")).write.mode("append").parquet(src)
    go()
    go()
    rows = sorted((r.id, r.v) for r in spark.read.parquet(out).collect())
    assert rows == [(i, "a") for i in range(5)] + [(i, "b") for i in range(5, 8)]


def test_windowed_counts(spark, tmp_path):
    df = spark.sql("SELECT timestamp'2024-01-01 00:10:00' AS ts, 'a' AS k, 1.0D AS v UNION ALL SELECT timestamp'2024-01-01 00:50:00', 'a', 2.0D UNION ALL SELECT timestamp'2024-01-01 01:10:00', 'b', 4.0D")
    df.write.parquet(str(tmp_path / "e"))
    q = ingest.windowed_counts(ingest.stream_table(spark, str(tmp_path / "e"), df.schema), "ts", "k", "v").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.k, r.n, r.total) for r in spark.table("w").collect()} == {("a", 2, 3.0), ("b", 1, 4.0)}
