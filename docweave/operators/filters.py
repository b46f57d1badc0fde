"""Metadata filters as nested dictionaries, compiled to column predicates that Spark pushes down."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_where(raw: str | None) -> dict | None:
    if not raw:
        return None
    value = json.loads(raw)
    if not isinstance(value, dict):
        raise ValueError("a filter must be a JSON object")
    return value


def merge_where(first: dict | None, second: dict | None) -> dict | None:
    return {"$and": [first, second]} if first and second else first or second


def compile_where(where: dict | None, column=F.col) -> Column:
    """A predicate for ``filter``, in the forms that sources can evaluate themselves.

    ``$and`` or ``$or`` excludes its siblings; plain equality compares texts;
    ``$eq``, ``$ne``, ``$in`` and ``$nin`` compare values; unknown operators pass.
    A missing value equals nothing (so ``$ne`` and ``$nin`` hold for it).
    """
    if not where:
        return F.lit(True)
    for key, join in (("$and", lambda a, b: a & b), ("$or", lambda a, b: a | b)):
        if key in where:
            parts = [compile_where(w, column) for w in where[key]]
            return reduce(join, parts) if parts else F.lit(key == "$and")
    out = F.lit(True)
    for name, wanted in where.items():
        c = column(name)
        if isinstance(wanted, dict):
            for op, value in wanted.items():
                if op == "$eq":
                    out = out & (c == F.lit(value))
                elif op == "$ne":
                    out = out & ((c != F.lit(value)) | c.isNull())
                elif op == "$in":
                    out = out & c.isin(list(value))
                elif op == "$nin":
                    out = out & (~c.isin(list(value)) | c.isNull())
        else:
            out = out & (c.cast("string") == F.lit(str(wanted)))
    return out


def part_ids(raw: str | None) -> set[int] | None:
    """``0,2-4`` as a set of part numbers; None is no filter."""
    if not raw or not raw.strip():
        return None
    out: set[int] = set()
    for item in raw.split(","):
        low, _, high = item.strip().partition("-")
        a, b = int(low), int(high or low)
        if b < a:
            raise ValueError(f"bad range {item!r}")
        out.update(range(a, b + 1))
    return out


#: Filters of the validation suite, by name, and a value that nothing has.
FILTERS = {
    "split_strategy_semantic_section": {"split_strategy": "semantic_section"},
    "article_type_research_article": {"article_type": "research-article"},
    "pub_year_2010_string": {"pub_year": "2010"},
    "journal_plos_one": {"journal": "PLoS ONE"},
}
NOWHERE = {"pmcid": "__NO_SUCH_PMCID__"}


def check_filters(df: DataFrame, sample: dict, n: int = 5, named: dict[str, dict] | None = None, nowhere: dict | None = None, sampled: dict[str, str] | None = None) -> DataFrame:
    """(filter_name, where, hit_count, status, note): how many rows of df each filter finds, n at most.

    named: filters by name; sampled: filter name -> column, of which the sample row
    gives the value (blank ones are left out); nowhere: a filter that should find
    nothing. A filter on a column that df lacks has status ``error``. All counts
    come from one pass over df.
    """
    suite = dict(FILTERS if named is None else named)
    suite |= {name: {c: sample[c]} for name, c in (sampled or {"sample_pub_year": "pub_year", "real_pmcid": "pmcid"}).items() if sample.get(c) not in (None, "")}
    suite["no_result_filter"] = NOWHERE if nowhere is None else nowhere
    lacking = {name: sorted(c for c in where if not c.startswith("$") and c not in df.columns) for name, where in suite.items()}
    good = [name for name in suite if not lacking[name]]
    counts = df.agg(F.lit(0).alias("_"), *[F.least(F.count_if(compile_where(suite[name])), F.lit(n)).alias(name) for name in good]).first()
    rows = []
    for name, where in suite.items():
        hits = 0 if lacking[name] else counts[name]
        note = f"no column {', '.join(lacking[name])}" if lacking[name] else "empty result expected" if name == "no_result_filter" else "matched" if hits else "no matching rows"
        rows.append((name, json.dumps(where, ensure_ascii=False, default=str), hits, "error" if lacking[name] else "ok", note))
    return df.sparkSession.createDataFrame(rows, "filter_name string, where string, hit_count bigint, status string, note string")


def hit_rates(df: DataFrame, wheres: dict[str, dict]) -> DataFrame:
    """(filter_name, hit_count, hit_rate) of each filter over df, in one pass; rates of an empty table are 0."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(compile_where(w)).alias(name) for name, w in wheres.items()])
    tall = counts.unpivot(["_n"], list(wheres), "filter_name", "hit_count")
    return tall.select("filter_name", "hit_count", F.when(F.col("_n") > 0, F.col("hit_count") / F.col("_n")).otherwise(0.0).alias("hit_rate"))
