import math

import pytest
from pyspark.sql import functions as F

from docweave.functions import numeric, text, udf
from docweave.operators.common import dedupe_ci


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("value,empty", [(None, True), ("", True), (" \t\n", True), ("　 ", True), ("a", False)])
def test_is_empty(spark, value, empty):
    assert one(spark, text.is_empty("t"), t=value) is empty


def test_collapse_join_and_titles(spark):
    assert one(spark, text.collapse("t"), t="  a\n\n b　c ") == "a b c"
    assert one(spark, text.join_parts(F.col("a"), F.col("b"), F.col("c")), a=" x ", b="  ", c="y") == "x\n\ny"
    assert one(spark, text.section_title_norm("t"), t=" Materials  AND Methods ") == "materials and methods"


def test_words_and_abbreviations(spark):
    assert one(spark, text.words("t"), t="The well-known DNA, of it été") == ["the", "well-known", "dna"]
    assert one(spark, text.filtered_words("t"), t="The results show tumour growth") == ["show", "tumour", "growth"]
    assert one(spark, text.abbreviations("t"), t="DNA and PCR in PDF, IL-6 U") == ["DNA", "PCR", "IL-6"]
    assert one(spark, text.approx_token_len("t"), t="a1 2.5 x-y") == 3


@pytest.mark.parametrize("n,chunks", [(0, 0), (1, 1), (400, 1), (401, 2), (454, 2), (720, 2), (721, 3), (17219, 54)])
def test_chunk_estimate(spark, n, chunks):
    assert one(spark, text.chunk_estimate(F.lit(n))) == chunks


def test_ngrams(spark):
    assert one(spark, text.ngrams(F.split("t", " "), 2), t="a b c") == ["a b", "b c"]
    assert one(spark, text.ngrams(F.split("t", " "), 4), t="a b c") == []
    assert set(one(spark, text.query_ngrams("t"), t="MI care?")) == {"mi care?", "mi", "care", "mi care"}
    assert one(spark, text.topic_ngrams(F.split("t", " "), 2), t="tumour growth and decay") == ["tumour growth"]


def test_sentences_encoding_preview(spark):
    s = one(spark, text.sentence_stats("t"), t="This is a first sentence. Short. And here is the second one!")
    assert (s.sentences, s.mean_words) == (2, 5.5)
    assert one(spark, text.encoding_note("t"), t="fine") == ""
    assert one(spark, text.encoding_note("t"), t="x" * 500 + "�") == "encoding_warning bad_chars=1 density=0.0020"
    assert one(spark, text.encoding_note("t"), t="ab\x01").startswith("severe_encoding_issue bad_chars=1")
    assert one(spark, text.preview("t", 12), t="one two three four") == "one two ..."


def test_shares_are_written_as_doubles_are(spark):
    assert one(spark, text.encoding_note("t"), t="�" + "x" * 31) == "severe_encoding_issue bad_chars=1 density=0.0312"
    pairs = [(k, 20000) for k in range(20001)] + [(b, n) for n in range(1, 400) for b in range(n + 1)] + [(b, 32 * k) for k in range(1, 3000, 7) for b in (k, 3 * k, 5 * k + 1, 32 * k - 1)] + [(1, 2**31 - 1), (2**31 - 2, 2**31 - 1), (2**31 - 1, 2**31 - 1)]
    got = spark.createDataFrame(pairs, "b int, n int").select("b", "n", text.share_4(F.col("b"), F.col("n")).alias("s")).collect()
    assert [(r.b, r.n, r.s) for r in got if r.s != f"{r.b / r.n:.4f}"] == []


@pytest.mark.parametrize(
    "raw,clean",
    [(None, ""), ("   ", ""), ("什么是糖尿病？", "什么是糖尿病"), ("MI  treatment??!!", "MI treatment"), ("a，，b。c", "a,b.c"), ("EGFR mutation " * 200, ("EGFR mutation " * 200)[:1000].strip())],
)
def test_clean_query(spark, raw, clean):
    assert one(spark, text.clean_query("t"), t=raw) == clean


def test_search_tokens(spark):
    for t in ("COVID-19 and TNF-α/β", "糖尿病 MI", "a.b.c", "", "x_y"):
        assert one(spark, text.search_tokens("t"), t=t) == udf.tokenize_exact(t)
    assert udf.tokenize_exact("ﬁne Straße") == ["fine", "strasse"]


def test_identifiers(spark):
    assert one(spark, text.chunk_doc_id("a", "b", "c"), a="12", b="3", c="f") == "PMCID:PMC12"
    assert one(spark, text.chunk_doc_id("a", "b", "c"), a=" ", b="3", c="f") == "PMID:3"
    assert one(spark, text.chunk_doc_id("a", "b", "c"), a=None, b=None, c="f").startswith("SOURCE:")
    assert one(spark, text.analysis_doc_id("a", "b", "c"), a="", b="7", c="f") == "PMC7"
    assert one(spark, text.text_hash("a"), a=" A  b ") == one(spark, text.text_hash("a"), a="a b") != ""
    assert one(spark, text.text_hash("a"), a=" ") == ""


def test_quality_and_route(spark):
    q = text.quality_of_record("a", "b", "c", F.lit(False), F.lit(False))
    assert [one(spark, q, a=a, b=b, c=c) for a, b, c in (("", "", ""), ("t", "", ""), ("", "x", "y"), ("t", "x", "y"))] == ["drop_no_text", "need_review", "keep_with_warning", "keep"]
    assert one(spark, text.route(F.lit(512), F.lit(True))) == "whole_document_under_512"
    assert one(spark, text.route(F.lit(513), F.lit(False))) == "recursive_fallback_no_section"
    assert one(spark, text.section_label(*(F.lit(x).cast("boolean") for x in (True, True, False, None, True)))) == "B/I+M+C"


def test_scores(spark):
    assert one(spark, numeric.recency("y", None, 2025), y="2015") == 0.5
    assert one(spark, numeric.recency("y", "d", 2025), y="", d="1999-Mar") == 0.0
    assert one(spark, numeric.recency("y", "d", 2025), y=None, d=None) == 0.5
    assert one(spark, numeric.authority("j"), j=" PLoS  ONE ") == 0.75 and one(spark, numeric.authority("j"), j="x") == 0.5
    assert one(spark, numeric.final_score(F.lit(1.0), F.lit(0.0), F.lit(0.9))) == pytest.approx(0.735)
    assert one(spark, numeric.sigmoid(F.lit(-1000.0))) == pytest.approx(1 / (1 + math.exp(60)))
    with pytest.raises(ValueError):
        numeric.final_score(F.lit(1.0), F.lit(1.0), F.lit(1.0), {"relevance": 1})
    assert one(spark, numeric.cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(4.0), F.lit(3.0)))) == pytest.approx(0.96)
    assert one(spark, numeric.to_int("a"), a="x") == 0 and one(spark, numeric.to_float("a"), a="1.5") == 1.5


def test_dedupe_ci(spark):
    assert one(spark, dedupe_ci(F.split("t", ",")), t=" a,B,A,,b ,c") == ["a", "B", "c"]


def test_hash_embedding_is_of_unit_length(spark):
    v = spark.createDataFrame([("insulin insulin glucose",), ("",), (None,)], "t string").select(udf.hash_embedding(16)("t").alias("v")).collect()
    assert sum(x * x for x in v[0].v) == pytest.approx(1) and set(v[1].v) == set(v[2].v) == {0.0}
