"""Column functions over numbers, dates and vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docweave.functions.text import _c, collapse, text_of

#: Prior of journals (lower-cased), and the share of each criterion in the final score.
AUTHORITY = {
    "plos biology": 0.90,
    "plos medicine": 0.90,
    "british journal of cancer": 0.85,
    "emerging infectious diseases": 0.85,
    "environmental health perspectives": 0.85,
    "bmc medicine": 0.80,
    "bmc biology": 0.80,
    "bmc bioinformatics": 0.75,
    "bmc genomics": 0.75,
    "bmc cancer": 0.75,
    "plos one": 0.75,
}
CRITERIA = {"relevance": 0.60, "recency": 0.25, "authority": 0.15}


def safe_rate(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def clamp(x: Column) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))


def sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-60.0)), F.lit(60.0))))


def to_int(c: Column | str) -> Column:
    """Numeric text as an integer, anything else 0."""
    return F.coalesce(_c(c).try_cast("double").cast("long"), F.lit(0))


def to_float(c: Column | str) -> Column:
    return _c(c).try_cast("double")


def year(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(text_of(c), r"(?:19|20)\d{2}", 0), F.lit("")).cast("int")


def recency(pub_year: Column | str, pub_date: Column | str | None, current_year: int, decay_years: int = 20, missing: float = 0.5) -> Column:
    """1 for this year, falling evenly to 0 after decay_years; ``missing`` without a year."""
    if decay_years <= 0:
        raise ValueError("decay_years must be positive")
    y = year(pub_year if pub_date is None else F.when(text_of(pub_year) != "", text_of(pub_year)).otherwise(text_of(pub_date)))
    age = F.greatest(F.lit(current_year) - y, F.lit(0))
    return F.when(y.isNull(), F.lit(float(missing))).otherwise(clamp(1 - age / decay_years))


def authority(journal: Column | str, default: float = 0.5) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in AUTHORITY.items() for x in kv])
    return clamp(F.coalesce(pairs[F.lower(collapse(journal))], F.lit(default)))


def final_score(relevance: Column, recency_: Column, authority_: Column, weights: dict[str, float] | None = None) -> Column:
    w = CRITERIA if weights is None else dict(weights)
    if set(w) != set(CRITERIA) or any(x < 0 for x in w.values()) or sum(w.values()) <= 0:
        raise ValueError("weights need relevance, recency and authority, none negative, not all zero")
    total = sum(w.values())
    return clamp(sum((F.lit(w[k] / total) * clamp(x) for k, x in (("relevance", relevance), ("recency", recency_), ("authority", authority_))), F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalized(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a)


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n).otherwise(0.0)


def min_max(x: Column, low: Column, high: Column, constant: Column) -> Column:
    return F.when(high > low, (x - low) / (high - low)).otherwise(constant)
