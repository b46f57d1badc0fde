"""Profiling a corpus: completeness, duplicates, lengths, vocabulary, markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docweave.functions import numeric, text
from docweave.operators.common import spread, top_per_group


def missing_rates(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, total, non_empty, missing, missing_rate): one pass over the table, whatever the number of fields."""
    counts = df.agg(F.count("*").alias("total"), *[F.count_if(~text.is_empty(f)).alias(f) for f in fields])
    out = counts.unpivot(["total"], fields, "field", "non_empty")
    missing = F.col("total") - F.col("non_empty")
    return out.select("field", "total", "non_empty", missing.alias("missing"), numeric.safe_rate(missing, F.col("total")).alias("missing_rate"))


def availability(df: DataFrame, fields: list[str]) -> DataFrame:
    out = missing_rates(df, fields)
    return out.select("field", "total", F.col("non_empty").alias("available"), numeric.safe_rate(F.col("non_empty"), F.col("total")).alias("available_rate"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def length_stats(df: DataFrame, column: str, label: str, limits: tuple[int, ...] = (512, 1024)) -> DataFrame:
    """One row: count, mean, exact linear-interpolated percentiles, and how many are over the limits. Zeros if empty."""
    c = F.col(column)
    p = F.percentile(c, F.array(*[F.lit(x) for x in (0.5, 0.75, 0.9, 0.95, 0.99)])).alias("p")
    over = [F.count_if(c > n).alias(f"over_{n}") for n in limits]
    row = df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.min(c).alias("min"), F.max(c).alias("max"), p, *over)
    zero = lambda x, name: F.coalesce(x.cast("double"), F.lit(0.0)).alias(name)
    names = ("p50", "p75", "p90", "p95", "p99")
    return row.select(
        F.lit(label).alias("label"), "count", zero(F.col("mean"), "mean"), zero(F.col("p")[0], "median"), zero(F.col("min"), "min"), zero(F.col("max"), "max"),
        *[zero(F.col("p")[i], n) for i, n in enumerate(names)],
        *[x for n in limits for x in (F.col(f"over_{n}"), numeric.safe_rate(F.col(f"over_{n}"), F.col("count")).alias(f"over_{n}_rate"))],
    )


def tertiles(df: DataFrame, column: str) -> DataFrame:
    """One row: the cut points at a third and two thirds."""
    q = F.percentile(F.col(column), F.array(F.lit(1 / 3), F.lit(2 / 3)))
    return df.agg(q.alias("q")).select(F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))


def with_length_group(df: DataFrame, column: str) -> DataFrame:
    """df with its tertile label in length_group."""
    return df.crossJoin(F.broadcast(tertiles(df, column))).withColumn("length_group", text.length_group(F.col(column), F.col("low"), F.col("high"))).drop("low", "high")


def stratified_sample(df: DataFrame, group: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows of each group, the ones with the smallest digest of key and seed; the same on every run."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(seed)).cast("binary"))
    return top_per_group(df, [group], [digest, F.col(key)], n, "_rank").drop("_rank")


def group_summary(df: DataFrame, group: str, column: str, order: list[str]) -> DataFrame:
    """count, min, max and mean of each group, groups in the given order, empty ones included."""
    names = df.sparkSession.createDataFrame([(g, i) for i, g in enumerate(order)], f"`{group}` string, _at int")
    found = df.groupBy(group).agg(F.count("*").alias("count"), F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"))
    return names.join(found, group, "left").orderBy("_at").select(group, F.coalesce("count", F.lit(0)).alias("count"), "min", "max", "mean")


def duplicate_rows(df: DataFrame, key: Column) -> DataFrame:
    """One row: rows whose key occurs more than once, and keys that do; empty keys don't count."""
    counts = spread(df).select(key.alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    twice = (F.col("n") > 1) & (F.coalesce("k", F.lit("")) != "")  # a filter would work the key out a second time
    return counts.agg(F.coalesce(F.sum(F.when(twice, F.col("n"))), F.lit(0)).alias("duplicate_rows"), F.count_if(twice).alias("duplicate_keys"))


def with_duplicates(df: DataFrame, key: Column, name: str = "occurrences") -> DataFrame:
    """df with how often its key occurs (0 for an empty key): joined to grouped counts, so a hot key is pre-aggregated."""
    keyed = df.withColumn("_k", key)
    counts = keyed.filter(F.coalesce("_k", F.lit("")) != "").groupBy("_k").agg(F.count("*").alias(name))
    return keyed.join(counts, "_k", "left").drop("_k").withColumn(name, F.coalesce(name, F.lit(0)))


def first_of_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each non-empty key in the given order, and all rows with an empty key."""
    named = df.filter(~text.is_empty(key))
    rest = [c for c in df.columns if c not in (key, order)]
    first = named.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("_r")).select(key, "_r.*").select(df.columns)
    return first.unionByName(df.filter(text.is_empty(key)))


def top_terms(df: DataFrame, terms: Column, limit: int = 80, term: str = "term") -> DataFrame:
    """The most frequent terms; equal counts in the order of the terms. Counts are combined before the shuffle."""
    return spread(df).select(F.explode(terms).alias(term)).groupBy(term).agg(F.count("*").alias("count")).orderBy(F.desc("count"), term).limit(limit)


def top_ngrams(df: DataFrame, tokens: Column, n: int, limit: int = 80, stopwords: tuple[str, ...] = text.STOPWORDS, phrases: tuple[str, ...] = ()) -> DataFrame:
    """The most frequent runs of n tokens without stop words, noisy phrases left out. Stop words are marked once for each token, not for each run."""
    marked = F.transform(tokens, lambda w: F.when(w.isin(*stopwords), F.lit(None)).otherwise(w))
    rows = spread(df).select(marked.alias("t")).filter(F.size("t") >= n).select("t", F.explode(F.sequence(F.lit(1), F.size("t") - (n - 1))).alias("i"))
    words = [F.element_at("t", F.col("i") + k) for k in range(n)]
    grams = rows.select(*[w.alias(f"w{k}") for k, w in enumerate(words)]).dropna()
    counts = grams.groupBy(F.concat_ws(" ", *grams.columns).alias("term")).agg(F.count("*").alias("count"))
    counts = counts.filter(~F.col("term").isin(*phrases)) if phrases else counts
    return counts.orderBy(F.desc("count"), "term").limit(limit)


def marker_counts(df: DataFrame, column: str, markers: tuple[str, ...] = text.STRUCTURED_MARKERS) -> DataFrame:
    """(marker, count, rate): rows whose text has the marker as a word, in capitals or not."""
    upper = F.upper(text.text_of(column))
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(upper.rlike(rf"\b{m}\b")).alias(m) for m in markers])
    out = row.unpivot(["_n"], list(markers), "marker", "count")
    return out.select("marker", "count", numeric.safe_rate(F.col("count"), F.col("_n")).alias("rate"))


def variant_mentions(df: DataFrame, column: str, concepts: dict[str, list[str]], case_sensitive: set[str]) -> DataFrame:
    """(concept, variant_forms_found, total_mentions): matches of each concept's patterns, one pass over the table."""
    pats = [(c, p) for c, ps in concepts.items() for p in ps]
    sums = [F.coalesce(F.sum(F.regexp_count(text.text_of(column), F.lit(p if p in case_sensitive else f"(?i){p}"))), F.lit(0)).alias(f"m{i}") for i, (_, p) in enumerate(pats)]
    row = df.agg(*sums)
    rows = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("concept"), F.lit(p).alias("form"), F.col(f"m{i}").alias("n")) for i, (c, p) in enumerate(pats)])).alias("r")).select("r.*")
    return rows.groupBy("concept").agg(F.count_if(F.col("n") > 0).alias("variant_forms_found"), F.sum("n").alias("total_mentions"))


def density(df: DataFrame, column: str, key: str, top: int = 10) -> DataFrame:
    """For each row: words, sentences, mean sentence words, mentions of its ``top`` abbreviations, their density, statistics, ``term(count)`` list."""
    base = df.select(key, text.word_count(column).alias("words"), text.sentence_stats(column).alias("s"), text.statistic_markers(column).alias("statistic_mentions"), text.abbreviations(column).alias("terms"))
    base = base.select(key, "words", F.col("s.sentences").alias("sentences"), F.col("s.mean_words").alias("mean_words"), "statistic_mentions", F.explode_outer("terms").alias("term"))
    counts = base.groupBy(key, "words", "sentences", "mean_words", "statistic_mentions", "term").agg(F.count("term").alias("n"))
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), "term"))).filter(F.col("r") <= top)
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n") > 0, F.struct("r", "term", "n")))), lambda x: F.concat(x.term, F.lit("("), x.n.cast("string"), F.lit(")"))), "; ")
    out = ranked.groupBy(key, "words", "sentences", "mean_words", "statistic_mentions").agg(F.sum("n").alias("mentions"), listed.alias("top_abbreviations"))
    return out.select(key, "words", "sentences", F.round("mean_words", 2).alias("mean_sentence_words"), "mentions", F.round(F.col("mentions") / F.greatest(F.lit(1), F.col("words")) * 1000, 2).alias("per_1000_words"), "statistic_mentions", "top_abbreviations")


def histogram(df: DataFrame, column: str, bins: int = 40) -> DataFrame:
    """(bin, low, high, count) of equal widths from the least to the greatest value; empty bins are left out."""
    c = F.col(column).cast("double")
    ends = df.agg(F.min(c).alias("a"), F.max(c).alias("b"))
    width = (F.col("b") - F.col("a")) / bins
    at = F.when(F.col("b") > F.col("a"), F.least(F.floor((c - F.col("a")) / width), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    found = df.filter(c.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(at.alias("bin"), "a", width.alias("w")).agg(F.count("*").alias("count"))
    return found.select("bin", (F.col("a") + F.col("bin") * F.col("w")).alias("low"), (F.col("a") + (F.col("bin") + 1) * F.col("w")).alias("high"), "count")


#: Forms of concepts, and the forms that are told apart by case.
CONCEPT_VARIANTS = {
    "HIV/AIDS": [r"\bHIV(?:-1)?\b", r"\bAIDS\b", r"\bhuman immunodeficiency virus(?: type 1)?\b", r"\bacquired immunodeficiency syndrome\b"],
    "PCR": [r"\bPCR\b", r"\bpolymerase chain reaction\b", r"\breverse transcription PCR\b", r"\bRT-PCR\b"],
    "confidence interval": [r"\bCI\b", r"\bconfidence intervals?\b", r"\b95%\s*CI\b"],
    "odds ratio": [r"\bOR\b", r"\bodds ratios?\b"],
    "cerebrospinal fluid": [r"\bCSF\b", r"\bcerebrospinal fluid\b"],
    "myocardial infarction": [r"\bMI\b", r"\bmyocardial infarction\b", r"\bheart attack\b"],
    "Pneumocystis pneumonia": [r"\bPCP\b", r"\bPneumocystis pneumonia\b", r"\bPneumocystis jiroveci\b", r"\bPneumocystis carinii\b"],
    "non-small cell lung cancer": [r"\bNSCLC\b", r"\bnon-small cell lung cancer\b", r"\bnon-small-cell lung cancer\b"],
    "ulcerative colitis": [r"\bUC\b", r"\bulcerative colitis\b", r"\binflammatory bowel disease\b", r"\bIBD\b"],
}
CASE_SENSITIVE = {r"\bHIV(?:-1)?\b", r"\bAIDS\b", r"\bPCR\b", r"\bRT-PCR\b", r"\bCI\b", r"\bOR\b"}


def section_titles(df: DataFrame, titles: str, limit: int = 50) -> DataFrame:
    """The most frequent section titles in lower case; equal counts in the order of the titles."""
    named = F.filter(F.transform(F.coalesce(F.col(titles), F.array().cast("array<string>")), text.section_title_norm), lambda t: t != "")
    return top_terms(df, named, limit, "section_title")


def box(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """What a box plot shows: quartiles, the furthest values within ``reach`` times the range between the quartiles, and how many lie beyond."""
    c = F.col(column).cast("double")
    q = df.agg(*[F.percentile(c, p).alias(n) for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    low, high = F.col("q1") - reach * (F.col("q3") - F.col("q1")), F.col("q3") + reach * (F.col("q3") - F.col("q1"))
    inside = c.between(low, high)
    rows = df.crossJoin(F.broadcast(q))  # one row
    return rows.groupBy("q1", "median", "q3").agg(F.min(F.when(inside, c)).alias("low"), F.max(F.when(inside, c)).alias("high"), F.count_if(~inside).alias("outliers"))
