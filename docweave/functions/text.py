"""Column functions over text: all built from Spark's own expressions, so they stay inside code generation.

Null and blank text count as missing throughout (``is_empty``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"(?U)\s+"
#: White space of any kind, for trimming.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_of(c: Column | str) -> Column:
    """Null as the empty text."""
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def collapse(c: Column | str) -> Column:
    """White space of any kind as single spaces, none at the ends."""
    return F.btrim(F.regexp_replace(text_of(c), WS, " "))


def is_empty(c: Column | str) -> Column:
    """No character but white space: looks no further than the first one."""
    return ~text_of(c).rlike(r"(?U)\S")


def strip(c: Column | str) -> Column:
    return F.btrim(text_of(c), F.lit(SPACES))


def join_parts(*parts: Column, sep: str = "\n\n") -> Column:
    """Stripped parts that aren't empty, joined."""
    return F.array_join(F.filter(F.array(*map(strip, parts)), lambda x: x != ""), sep)


def section_title_norm(c: Column | str) -> Column:
    return F.lower(collapse(c))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(text_of(c), F.lit("[A-Za-z]+"))


#: Words that carry no topic, and abbreviations that are noise.
STOPWORDS = tuple(
    """the and for with that this from were was are has have had not but can may been their these those into using used
    between among also than then there such which when where during after before our all one two more most other over under
    within without each we they its study studies results methods background conclusion conclusions objective objectives
    article articles figure figures table tables supplementary additional file files copyright license published journal
    author authors contribution contributions competing interest interests available availability result method discussion
    introduction however shown number including respectively therefore although reported observed""".split()
)
NOISY_ABBREVIATIONS = tuple("PDF XML HTML FIG TABLE REF SUPPL PMC PMID DOI BMC PLOS USA UK WHO CDC".split())
STRUCTURED_MARKERS = ("BACKGROUND", "OBJECTIVE", "METHODS", "RESULTS", "CONCLUSIONS", "INTRODUCTION", "DISCUSSION")
#: Section kinds by title pattern.
SECTION_PATTERNS = {
    "introduction": r"(?i)\b(introduction|background)\b",
    "methods": r"(?i)\b(methods?|materials and methods|methodology|patients and methods)\b",
    "results": r"(?i)\b(results?)\b",
    "discussion": r"(?i)\bdiscussion\b",
    "conclusion": r"(?i)\b(conclusions?|summary)\b",
}
#: Further words that say nothing in the full texts of articles, and phrases of them.
NOISE = STOPWORDS + tuple(
    """http https www com org result method background discussion conclusion introduction both only however shown number first
    including respectively therefore although according described reported observed whether because while could would should
    might must well same click here pre-publication history read approved final manuscript participated design carried""".split()
)
NOISY_PHRASES = ("data shown", "click here", "pre-publication history", "approved final", "final manuscript", "read approved", "participated design", "carried out", "here data")
WORD = r"\b[A-Za-z][A-Za-z\-]{2,}\b"
ABBREVIATION = r"\b[A-Z][A-Z0-9\-]{1,12}\b"
APPROX_TOKEN = r"[A-Za-z][A-Za-z0-9_+-]*|\d+(?:\.\d+)?"


def words(c: Column | str) -> Column:
    """Lower-cased words of three letters or more."""
    return F.regexp_extract_all(F.lower(text_of(c)), F.lit(WORD), F.lit(0))


def filtered_words(c: Column | str, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    return F.filter(words(c), lambda w: ~w.isin(*stopwords) & (F.length(w) >= 3))


def abbreviations(c: Column | str) -> Column:
    found = F.regexp_extract_all(text_of(c), F.lit(ABBREVIATION), F.lit(0))
    return F.filter(found, lambda w: ~w.isin(*NOISY_ABBREVIATIONS) & ~w.rlike("^[0-9]+$"))


def approx_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(text_of(c), F.lit(APPROX_TOKEN), F.lit(0))


def approx_token_len(c: Column | str) -> Column:
    """The default token length; other tokenizers come as UDFs."""
    return F.regexp_count(text_of(c), F.lit(APPROX_TOKEN))


def chunk_estimate(length: Column, size: int = 400, overlap: int = 80) -> Column:
    step = max(1, size - overlap)
    return F.when(length <= 0, 0).when(length <= size, 1).otherwise(1 + F.ceil((length - size) / step)).cast("long")


def ngrams(tokens: Column, n: int) -> Column:
    """Space-joined runs of n tokens; none if there are fewer."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def query_ngrams(c: Column | str, most: int = 8) -> Column:
    """Runs of 1 to ``most`` alphanumeric words and the whole text, lower-cased and distinct."""
    t = F.regexp_extract_all(F.lower(text_of(c)), F.lit("[A-Za-z0-9]+"), F.lit(0))
    return F.array_distinct(F.concat(F.array(F.lower(text_of(c))), *[ngrams(t, n) for n in range(1, most + 1)]))


def topic_ngrams(tokens: Column, n: int, stopwords: tuple[str, ...] = STOPWORDS) -> Column:
    """n-grams without those that hold a stop word."""
    runs = F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.slice(tokens, i, n)))
    good = F.filter(F.coalesce(runs, F.array().cast("array<array<string>>")), lambda g: ~F.exists(g, lambda w: w.isin(*stopwords)))
    return F.transform(good, lambda g: F.array_join(g, " "))


def sentence_stats(c: Column | str, least: int = 20) -> Column:
    """struct(sentences, mean_words): sentences of at least ``least`` characters."""
    parts = F.filter(F.split(text_of(c), r"(?<=[.!?])\s+"), lambda s: F.length(F.btrim(s)) >= least)
    total = F.aggregate(parts, F.lit(0), lambda a, s: a + word_count(s))
    n = F.size(parts)
    return F.struct(n.alias("sentences"), F.when(n == 0, 0.0).otherwise(total / n).alias("mean_words"))


STATISTIC = r"(?i)\bp\s*[<=>]\s*0?\.\d+|\b95%\s*CI\b|\bconfidence intervals?\b|\bodds ratios?\b|\brelative risks?\b|\d+(?:\.\d+)?%"


def statistic_markers(c: Column | str) -> Column:
    return F.regexp_count(text_of(c), F.lit(STATISTIC))


def share_4(part: Column, whole: Column) -> Column:
    """part / whole (0 to 1) with four digits, as C and Python write a double.

    The double's exact value decides; right in the middle goes to the even digit.
    Java's formats round its shortest decimal half up instead (1/32: 0.0313, not 0.0312).
    """
    part, whole = part.cast("long"), whole.cast("long")
    rest = part * 10000 % whole
    below = ((part * 10000 - rest) / whole).cast("long")
    middle = rest * 2 == whole
    # only in the middle does it matter on which side the double of part / whole is: its 67 bits after the point, in two numbers
    scaled = part / whole * 2**33
    high = F.floor(scaled)
    low = ((scaled - high) * 2**34).cast("long")
    side = F.when(middle, high * 20000 - (below * 2 + 1) * 2**33).otherwise(0) * 2**34 + low * 20000
    up = (rest * 2 > whole) | (middle & ((side > 0) | ((side == 0) & (below % 2 == 1))))
    digits = below + up.cast("long")
    return F.concat((digits >= 10000).cast("int").cast("string"), F.lit("."), F.lpad((digits % 10000).cast("string"), 4, "0"))


def encoding_note(*parts: Column | str) -> Column:
    """Empty, ``encoding_warning ...`` or ``severe_encoding_issue ...`` (over 1 % or 20 and more bad characters)."""
    whole = F.concat_ws(" ", *map(text_of, parts))
    bad = F.regexp_count(whole, F.lit("[\\x{FFFD}\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]"))
    length = F.greatest(F.lit(1), F.length(whole))
    kind = F.when((bad / length > 0.01) | (bad >= 20), "severe_encoding_issue").otherwise("encoding_warning")
    return F.when(bad == 0, "").otherwise(F.format_string("%s bad_chars=%d density=%s", kind, bad, share_4(bad, length)))


def preview(c: Column | str, most: int = 1300) -> Column:
    """At most ``most`` characters, ending before a partial word."""
    t = collapse(c)
    return F.when(F.length(t) <= most, t).otherwise(F.concat(F.regexp_replace(F.substring(t, 1, most), " [^ ]*$", ""), F.lit(" ...")))


def snippet(c: Column | str, most: int = 800) -> Column:
    return F.replace(F.substring(text_of(c), 1, most), F.lit("\n"), F.lit(" "))


def section_flags(titles: Column) -> dict[str, Column]:
    joined = F.array_join(titles, "\n")
    return {name: joined.rlike(p) for name, p in SECTION_PATTERNS.items()}


def section_label(introduction: Column, methods: Column, results: Column, discussion: Column, conclusion: Column) -> Column:
    parts = [(introduction, "B/I"), (methods, "M"), (results, "R"), (discussion, "D"), (conclusion, "C")]
    return F.array_join(F.filter(F.array(*[F.when(flag, name) for flag, name in parts]), lambda x: x.isNotNull()), "+")


def clean_query(c: Column | str, most: int = 1000) -> Column:
    """Full-width punctuation as ASCII, white space and repeated punctuation collapsed, none at the end."""
    t = collapse(F.translate(text_of(c), "，。？！；：（）、　", ",.?!;:(), "))
    t = F.regexp_replace(F.regexp_replace(t, r"([?!,.;:])\1+", "$1"), r"[?.!,;:]+$", "")
    return F.btrim(F.substring(F.btrim(t), 1, most))


def truncate_query(c: Column | str, most: int = 4000) -> Column:
    return F.substring(collapse(c), 1, most)


def normalize_term(c: Column | str) -> Column:
    return F.lower(collapse(c))


def term_ok(c: Column, least: int = 2, most: int = 256) -> Column:
    return F.length(c).between(least, most) & ~c.rlike("^[0-9]+$")


TERM = r"([\p{L}\p{N}]+(?:[-./][\p{L}\p{N}]+)*)"


def search_tokens(c: Column | str) -> Column:
    """Tokens for retrieval: words with inner ``-./``; all-ideograph words also as pairs and triples, compounds also as parts.

    Lower-casing stands for case folding, and compatibility forms aren't normalised:
    for plain texts (``functions.udf.search_tokens`` sees to the others).
    """
    whole = F.lower(text_of(c))
    base = F.regexp_extract_all(whole, F.lit(TERM), F.lit(1))
    none = F.array().cast("array<string>")

    def spread(t: Column) -> Column:
        size = F.length(t)

        def runs(n: int) -> Column:
            return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(t, i, F.lit(n)))).otherwise(none)

        ideographs = (t >= "\u3400") & t.rlike(r"^[\x{3400}-\x{9FFF}]+$")  # few words get as far as the pattern
        compound = F.contains(t, F.lit("-")) | F.contains(t, F.lit(".")) | F.contains(t, F.lit("/"))
        return F.when(ideographs, F.concat(F.array(t), runs(2), runs(3))).when(compound, F.concat(F.array(t), F.split(t, "[-./]"))).otherwise(F.array(t))

    # most texts have words only
    some = whole.rlike(r"[\p{L}\p{N}][-./][\p{L}\p{N}]|[\x{3400}-\x{9FFF}]")
    return F.when(some, F.flatten(F.transform(base, spread))).otherwise(base)


def short_hash(c: Column | str) -> Column:
    return F.substring(F.sha1(text_of(c).cast("binary")), 1, 16)


def text_hash(c: Column | str) -> Column:
    """SHA-1 of the lower-cased, collapsed text; empty for empty text."""
    return F.when(is_empty(c), "").otherwise(F.sha1(F.lower(collapse(c)).cast("binary")))


def chunk_doc_id(pmcid: Column | str, pmid: Column | str, source: Column | str) -> Column:
    """Id for chunking: PMC id, else PubMed id, else a hash of the source."""
    a, b = F.btrim(text_of(pmcid)), F.btrim(text_of(pmid))
    pmc = F.when(F.upper(a).startswith("PMC"), a).otherwise(F.concat(F.lit("PMC"), a))
    return F.when(a != "", F.concat(F.lit("PMCID:"), pmc)).when(b != "", F.concat(F.lit("PMID:"), b)).otherwise(F.concat(F.lit("SOURCE:"), short_hash(source)))


def analysis_doc_id(pmid: Column | str, pmcid: Column | str, fallback: Column | str) -> Column:
    """Id for analysis: PubMed id, else the bare PMC id, else the record's."""
    a, b = text_of(pmid), text_of(pmcid)
    return F.when(a != "", F.concat(F.lit("PMID:"), a)).when(b != "", F.when(b.startswith("PMC"), b).otherwise(F.concat(F.lit("PMC"), b))).otherwise(text_of(fallback))


def fallback_available(title: Column | str, abstract: Column | str) -> Column:
    return F.when(~is_empty(abstract), "abstract_available").when(~is_empty(title), "title_available").otherwise("none")


def quality_of_record(title, abstract, body, encoding: Column, duplicate: Column | None = None) -> Column:
    """drop_no_text, need_review, keep_with_warning or keep; without ``duplicate`` it plays no part."""
    t, a, b = is_empty(title), is_empty(abstract), is_empty(body)
    review = encoding | (a & b)
    if duplicate is not None:
        review = review | duplicate
    return F.when(t & a & b, "drop_no_text").when(review, "need_review").when(t | a | b, "keep_with_warning").otherwise("keep")


def quality_of_chunk(title, abstract, body, body_tokens: Column, note: Column, pmid_rows: Column) -> Column:
    warn = is_empty(title) | is_empty(abstract) | (body_tokens < 50) | (F.length(text_of(body)) < 200)
    return F.when(note.startswith("severe") | (pmid_rows > 1), "need_review").when(warn, "keep_with_warning").otherwise("keep")


def route(tokens: Column, has_sections: Column, limit: int = 512) -> Column:
    return F.when(tokens <= limit, "whole_document_under_512").when(has_sections, "semantic_section").otherwise("recursive_fallback_no_section")


def route_label(route_: Column) -> Column:
    return F.when(route_ == "whole_document_under_512", "整体不分割").when(route_ == "semantic_section", "按语义章节分割").otherwise("重叠滑动窗口")


def length_group(length: Column, low: Column, high: Column) -> Column:
    return F.when(length <= low, "short").when(length <= high, "medium").otherwise("long")


def chunk_text(title: Column | str, section: Column | str, body: Column | str) -> Column:
    return F.btrim(F.concat(F.lit("Title: "), text_of(title), F.lit("\nSection: "), text_of(section), F.lit("\nText:\n"), F.btrim(text_of(body))))
