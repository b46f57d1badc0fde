"""Personal data (operator 9): weak supervision over candidate spans.

Candidates are found by wide patterns for each kind (email, ip, card, phone):
what the base patterns match, whether or not it passes their checks, written-out
addresses, other separators and groupings. Labelers vote on a candidate, yes, no
or nothing:

* pattern: the strict form of the kind, and checks of its parts (Luhn, ranges);
* gazetteer: known mail domain endings, issuer prefixes, dialling codes, private
  and reserved networks;
* context: words around that announce the kind, or that announce other numbers,
  and what the span touches.

The candidates are counted by their votes and their form (length, share of
digits, separators, groups, neighbours, first character), each a small code, so
what reaches the driver is bounded by the number of codes whatever the corpus. On
the counts of votes expectation-maximisation estimates each labeler's reliability
and each candidate's probability. A logistic span classifier is trained on these
probabilities with the form and the votes as features, and it alone decides on
candidates: there is no vote among labelers.

Spans of the base patterns always stay; the classifier adds others that don't
overlap them, the leftmost first. Offsets are code points, ends exclusive. Null
and empty texts have no spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.common import bounded_batches, by_position, cut_lineage, release_memory

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Wide forms: written-out addresses, other separators and groupings, no plus.
_AT, _DOT = r"(?:\s?[\[({<]\s?at\s?[\])}>]\s?|\sat\s)", r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)"
_WORDED = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)+", re.ASCII | re.IGNORECASE)
_WORDED_HINT = re.compile(r"[\[({<\s]at[\])}>\s]|[\[({<]\sat", re.ASCII | re.IGNORECASE)
_WIDE_CARD = re.compile(r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:(?:\.|/|_|  | )[0-9]{4}){3}|3[0-9]{3}(?:[ -]?[0-9]{6}[ -]?[0-9]{4,5}))(?![0-9A-Za-z])")
_WIDE_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)|00?[0-9]{1,4}|[0-9]{2,4})(?:[ ./-]{1,2}[0-9]{2,5}){2,4}(?![0-9A-Za-z])")
_WIDE_IP = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)| \. )[0-9]{1,3}){3}(?![0-9A-Za-z])")
#: Forms that strict labelers know: national phone numbers, and dates, which are no phone numbers.
_NATIONAL = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}")
_DATE = re.compile(r"(?:[0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4})(?:[ .-].*)?")

#: Gazetteers.
MAIL_ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu us ca au jp ch at be pt pl se no dk fi ru br mx in cn".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "6011", "65", "35", "36", "38")
DIALLING = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 358 380 420".split())
ANNOUNCES = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write to|reach|correo|courriel|kontakt)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|client|login|from)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|tarjeta|carte|karte)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|cell|fax|whatsapp|tel[eé]fono|t[eé]l[eé]phone|telefon|anruf)\b"),
}
DENIES = re.compile(r"(?i)\b(?:version|isbn|order|invoice|serial|section|page|figure|table|example|rfc|release|build|chapter)\b")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", done)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


_ANY_DIGIT = re.compile(r"[0-9]")


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, whether its checks hold) of what the base patterns match: leftmost, non-overlapping by kind."""
    if "@" in text:
        for a, b in _emails(text):
            yield 0, a, b, True
    if _ANY_DIGIT.search(text):
        for m in _IP.finditer(text):
            yield 1, *m.span(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
        for m in _CARD.finditer(text):
            if len(m[0]) >= 13:
                d = _digits(m[0])
                yield 2, *m.span(), 16 <= len(d) <= 19 and luhn(d)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield 3, *m.span(), 8 <= len(_digits(m[0])) <= 15


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of the base patterns for each kind: leftmost, non-overlapping, failing matches dropped without another try."""
    out: list[list[tuple[int, int]]] = [[], [], [], []]
    for kind, a, b, good in _matches(text):
        if good:
            out[kind].append((a, b))
    return out


#: Digits that a failing match has, at most, to be a candidate: longer runs are no card or phone number.
_MOST_DIGITS = 24


def _wide(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates besides the base spans, of any kind, in no order; they may overlap."""
    if _WORDED_HINT.search(text):
        for m in _WORDED.finditer(text):
            yield 0, *m.span()
    if _ANY_DIGIT.search(text):
        for pattern, kind in ((_WIDE_IP, 1), (_WIDE_CARD, 2), (_WIDE_PHONE, 3)):
            for m in pattern.finditer(text):
                yield kind, *m.span()


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, other candidates that overlap neither a base span nor, of the same kind, one before)."""
    base, other = [], list(_wide(text))
    for kind, a, b, good in _matches(text):
        if good:
            base.append((kind, a, b))
        elif kind and b - a <= 2 * _MOST_DIGITS and (4 if kind == 1 else 7) <= len(_digits(text[a:b])) <= _MOST_DIGITS:
            other.append((kind, a, b))
    taken = sorted((a, b) for _, a, b in base)
    starts, reach = [a for a, _ in taken], 0
    ends = [reach := max(reach, b) for _, b in taken]  # the furthest end so far
    extra, last = [], [0] * len(KINDS)
    for kind, a, b in sorted(other, key=lambda s: (s[1], -s[2], s[0])):
        k = bisect_left(starts, b)
        if a >= last[kind] and (not k or ends[k - 1] <= a):
            extra.append((kind, a, b))
            last[kind] = b
    return base, extra


#: Characters before and after a span that context labelers read.
AROUND = 48
#: Votes of a candidate, each 0 (no), 1 (nothing) or 2 (yes), in this order, and whether a base pattern found it.
LABELERS = ("strict form", "part check", "gazetteer", "announced", "denied", "border")
#: Features of a span's form and how many values each has.
FORM = {"length": 4, "digits": 4, "separators": 3, "groups": 6, "before": 3, "after": 3, "first": 3}
_FORMS = int(np.prod(list(FORM.values())))


def votes(kind: int, text: str, start: int, end: int, base: bool) -> list[int]:
    span = text[start:end]
    digits = _digits(span)
    before, after = text[max(0, start - AROUND) : start], text[end : end + AROUND]
    strict, denied = 2 if base else 0, bool(DENIES.search(before[-24:]))
    if kind == 0:
        strict = 2 if base else 1 if re.search(r"[\[({<]", span) else 0
        ending = re.split(r"[^A-Za-z0-9-]", span.lower())
        last = next((x for x in reversed(ending) if x), "")
        check, gaz = (2 if last.isalpha() and len(last) > 1 else 0), (2 if last in MAIL_ENDINGS else 0)
    elif kind == 1:
        parts = [int(p) for p in re.findall("[0-9]+", span) if len(p) < 9]
        strict = 2 if base else 1 if "[" in span or "(" in span else 0
        check = 2 if len(parts) == 4 and all(p <= 255 for p in parts) and parts[0] else 0
        gaz = 0 if parts and parts[0] in (0, 127) or parts and parts[0] >= 224 else 1
    elif kind == 2:
        strict = 2 if base else 0 if len(digits) > 15 and _CARD.fullmatch(span) else 1
        check, gaz = (2 if luhn(digits) else 0), (2 if digits.startswith(ISSUERS) else 0)
    else:
        strict = 2 if base or _NATIONAL.fullmatch(span) else 0
        check = (2 if base else 1) if 8 <= len(digits) <= 15 else 0
        gaz = (2 if any(digits[:k] in DIALLING for k in (1, 2, 3)) else 0) if span[0] == "+" or digits[:2] == "00" else 1
        denied = denied or bool(_DATE.fullmatch(span))
    edge = (before[-1:] + after[:1]).strip()
    return [strict, check, gaz, 2 if ANNOUNCES[KINDS[kind]].search(before) else 1, 0 if denied else 1, 0 if any(c.isalnum() for c in edge) else 1]


def _side(c: str) -> int:
    return 0 if not c.strip() else 2 if c.isalnum() else 1


def form(text: str, start: int, end: int) -> list[int]:
    """The span's form, a value for each of FORM: what it looks like, whatever kind it may be."""
    span = text[start:end]
    digits = sum("0" <= c <= "9" for c in span)
    share = digits / len(span)
    other = {c for c in span if not c.isalnum()}
    groups = len(re.findall("[0-9]+", span))
    return [
        int(len(span) > 9) + int(len(span) > 13) + int(len(span) > 18), int(share > 0.3) + int(share > 0.75) + int(share == 1), min(len(other), 2),
        min(groups, 5), _side(text[start - 1 : start]) if start else 0, _side(text[end : end + 1]), 1 if span[0] in "+(" else 2 if span[0] == "0" else 0,
    ]


def code_of(kind: int, text: str, start: int, end: int, base: bool) -> int:
    """Kind, base, votes and form as a number."""
    code = kind * 2 + base
    for v in votes(kind, text, start, end, base):
        code = code * 3 + v
    for v, n in zip(form(text, start, end), FORM.values(), strict=True):
        code = code * n + v
    return code


def _decode(code: int) -> tuple[int, bool, list[int], list[int]]:
    """(kind, base, votes, form) of a code."""
    shape, vote = [], []
    for n in reversed(FORM.values()):
        code, v = divmod(code, n)
        shape.insert(0, v)
    for _ in LABELERS:
        code, v = divmod(code, 3)
        vote.insert(0, v)
    return code // 2, bool(code % 2), vote, shape


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans array<struct<kind, start, end, code>>): base spans and other candidates that don't overlap them."""
    bounded_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("code", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                rows.append([{"kind": k, "start": a, "end": b, "code": code_of(k, text, a, b, base)} for found, base in zip(spans_of(text), (True, False), strict=True) for k, a, b in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(item))], names=[id_col, "spans"])

    return df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:int,start:int,end:int,code:int>>")


def reliabilities(patterns: list[list[int]], n: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of a model where labelers err independently given the truth, and saying nothing tells nothing.

    patterns: votes, of which n[i] candidates have the i-th. Returns (probability of
    each pattern, P(vote | truth, a vote) by labeler, truth and vote). The start is the
    share of yes among yes and no votes.
    """
    v = np.array(patterns)
    yes, no = v == 2, v == 0
    p = (yes.sum(1) + 0.5) / (yes.sum(1) + no.sum(1) + 1)
    theta = np.zeros((v.shape[1], 2, 3))
    for _ in range(rounds):
        for t, w in enumerate(((1 - p) * n, p * n)):
            for_yes, against = w @ yes + 0.5, w @ no + 0.5
            theta[:, t, 2], theta[:, t, 0] = for_yes / (for_yes + against), against / (for_yes + against)
        prior = float((p * n).sum() + 1) / (n.sum() + 2)
        odds = np.log(prior) - np.log(1 - prior) + yes @ np.log(theta[:, 1, 2] / theta[:, 0, 2]) + no @ np.log(theta[:, 1, 0] / theta[:, 0, 0])
        p = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
    return p, theta


def _features(code: int) -> list[float]:
    """Of the classifier: 1, yes and no of each labeler, and each value of the form but the first."""
    _, _, vote, shape = _decode(code)
    out = [1.0, *(float(v == 2) for v in vote), *(float(v == 0) for v in vote)]
    for v, n in zip(shape, FORM.values(), strict=True):
        out += [float(v == x) for x in range(1, n)]
    return out


def logistic(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels p of rows that count n times; the first column is not penalised. Newton steps, halved while the loss rises."""
    weight, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * (np.logaddexp(0, z) - p * z)).sum() + (pull * w * w).sum() / 2)

    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ weight, -500, 500)))
        step = np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + np.diag(pull), x.T @ (n * (q - p)) + pull * weight)
        size, now = 1.0, loss(weight)
        while size > 1e-6 and loss(weight - size * step) > now + 1e-12:
            size /= 2
        weight = weight - size * step
        if np.abs(size * step).max() < 1e-9:
            break
    return weight


def train(counts: dict[int, int]) -> dict[int, float]:
    """The classifier's probability, for each code that was seen, that it is personal data; kind by kind."""
    score: dict[int, float] = {}
    for kind in range(len(KINDS)):
        codes = [c for c in sorted(counts) if _decode(c)[0] == kind]
        if not codes:
            continue
        n = np.array([counts[c] for c in codes], float)
        patterns = [tuple(_decode(c)[2]) for c in codes]
        distinct = sorted(set(patterns))
        at = np.array([distinct.index(v) for v in patterns]) if len(distinct) < 50 else np.searchsorted(_number(distinct), _number(patterns))
        p, _ = reliabilities([list(v) for v in distinct], np.bincount(at, n, len(distinct)))
        x = np.array([_features(c) for c in codes])
        z = x @ logistic(x, p[at], n)
        score |= dict(zip(codes, (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist(), strict=True))
    return score


def _number(patterns: list[tuple[int, ...]]) -> np.ndarray:
    return np.array(patterns) @ 3 ** np.arange(len(LABELERS))[::-1]


def _accepted(found: DataFrame) -> list[int]:
    """Codes of candidates besides base spans that the classifier, trained on the candidates, takes for personal data."""
    counts = {r.code: r.n for r in found.select(F.explode("spans.code").alias("code")).groupBy("code").agg(F.count("*").alias("n")).collect()}
    return [c for c, p in train(counts).items() if p > 0.5 and not _decode(c)[1]]


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind:int, start:int, end:int, base:boolean>>) by kind and start; a row in, a row out.

    The texts are read once; what is counted and decided afterwards are spans.
    """
    found = cut_lineage(candidates(df, id_col, text_col), "candidates")
    good = _accepted(found)
    base = F.lit(3 ** len(LABELERS) * _FORMS)
    is_base = lambda s: F.floor(s.code / base) % 2 == 1
    kept = F.filter("spans", lambda s: is_base(s) | s.code.isin(good)) if good else F.filter("spans", is_base)
    shaped = F.transform(kept, lambda s: F.struct(s.kind.alias("kind"), s.start.alias("start"), s.end.alias("end"), is_base(s).alias("base")))
    return found.select(id_col, F.array_sort(shaped).alias("spans"))


def decisions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[int]:
    """Codes of candidates besides base spans that the classifier trained on df takes for personal data."""
    return _accepted(candidates(df, id_col, text_col))


def redacted(text: str, good: frozenset[int]) -> str:
    """text with each base span and each other candidate of a good code replaced by its kind in brackets; overlapping spans become one."""
    base, other = spans_of(text)
    spans = [(a, b, k) for k, a, b in base] + [(a, b, k) for k, a, b in other if good and code_of(k, text, a, b, False) in good]
    if not spans:
        return text
    out, at = [], 0
    for a, b, k in sorted(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with personal data in text_col replaced; trained on df. All columns stay, null texts stay null; no shuffle."""
    bounded_batches(df.sparkSession)
    good = frozenset(decisions(df, id_col, text_col))
    rows, at = by_position(df), df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if v is None else redacted(v, good) for v in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([texts if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)
        release_memory()

    return rows.mapInArrow(run, rows.schema).toDF(*df.columns)


def joined(spans):
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s.kind + 1), s.start.cast("string"), s.end.cast("string"))), ",")
