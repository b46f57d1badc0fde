"""Every registered query against its contract, on a small table with the odd cases."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docweave.llm import queries

from .helpers import DOCS, documents

TEXTS = [(d[0], d[1] or "") for d in DOCS]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark).write.parquet(f"{path}/documents.parquet")
    pages = [(1, "u", "<html><body><nav><a href=/>Home</a></nav><article><h1>A title</h1><p>Some words &amp; more, and then a few words that make this a sentence.</p></article></body></html>"), (2, None, None)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    vectors = [(i, [math.cos(i), math.sin(i), 0.1]) for i in range(45)] + [(None, [1.0, 0.0, 0.0]), (46, None)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(f"{path}/embeddings.parquet")
    return path


def run(spark, folder, name, schema):
    out = queries.QUERIES[name](spark, folder)
    assert dict(out.dtypes).items() >= dict(x.split() for x in schema.split(", ")).items()
    return out.collect()


def in_rows(rows, *names):
    return sorted((tuple(r[n] for n in names) for r in rows), key=str)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def remainder(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def test_op1(spark, folder):
    rows = run(spark, folder, "op1_kneser_ney", "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    counts = Counter(w for i, t in TEXTS if remainder(i, 7) != 2 for w in [*words(t), None])
    total, v = sum(counts.values()), len(counts)
    want = []
    for i, t in TEXTS:
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (total + 1 * (v + 1))) for w in tokens)
        want.append((i, remainder(i, 7) == 2, len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 4)))
    assert in_rows([r.asDict() | {"base_score": round(r.base_score, 4)} for r in rows], "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score") == sorted(want, key=str)
    assert all(r.score < 0 for r in rows)


def test_op2(spark, folder):
    rows = run(spark, folder, "op2_token_files", "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    tok, at, want = Tokenizer.from_file(P.path("byte_bpe_50k.json")), 0, []
    for i, t in sorted(TEXTS, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert in_rows(rows, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)


def test_op3(spark, folder):
    rows = run(spark, folder, "op3_lang_id", "doc_id bigint, held_out boolean, lang_pred string, score double")
    learned = {d[2] for d in DOCS if d[2] is not None and remainder(d[0], 3) != 1}
    texts = dict(TEXTS)
    assert len(rows) == len(DOCS)
    for r in rows:
        assert r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in texts[r.doc_id])) and r.lang_pred in learned | {"und"}


def test_op4(spark, folder):
    rows = run(spark, folder, "op4_html_crf", "page_id bigint, url string, text string, n_chars bigint")
    text = "A title\nSome words & more, and then a few words that make this a sentence."
    assert in_rows(rows, "page_id", "url", "text", "n_chars") == sorted([(1, "u", text, len(text)), (2, None, "", 0)], key=str)


def test_op5(spark, folder):
    rows = run(spark, folder, "op5_mix_sources", "doc_id bigint, source string, block bigint, release bigint, deadline bigint, slot bigint, place int")
    assert in_rows(rows, "doc_id", "source") == sorted(((d[0], d[3]) for d in DOCS), key=str)
    assert all(r.release <= r.slot < r.deadline for r in rows) and len({(r.slot, r.place) for r in rows}) == len(rows)


def test_op6(spark, folder):
    rows = run(spark, folder, "op6_byte_bpe", "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in TEXTS:
        ids = coder.encode_ordinary(t)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    assert in_rows(rows, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def test_op7(spark, folder):
    rows = run(spark, folder, "op7_simhash", "doc_id bigint, fingerprint string, component_id bigint")

    def fingerprint(text):
        w = words(text)
        shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0

    prints = [(i, fingerprint(t)) for i, t in TEXTS]
    label = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a][1] ^ prints[b][1]).count("1") <= 3:
                label = [label[b] if x == label[a] else x for x in label]
    least = {x: min((prints[k][0] for k in range(len(prints)) if label[k] == x and prints[k][0] is not None), default=None) for x in label}
    assert in_rows(rows, "doc_id", "fingerprint", "component_id") == sorted(((i, f"{p:016x}", least[label[k]]) for k, (i, p) in enumerate(prints)), key=str)


def test_op8(spark, folder):
    rows = run(spark, folder, "op8_audio_features", "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string")
    texts, feature = dict(TEXTS), {}
    assert len(rows) == len(DOCS)
    for r in rows:
        data = texts[r.doc_id].encode()
        payload = data + b" " * (-len(data) % 192 if data else 192)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r.media_bytes > r.payload_bytes and feature.setdefault(data, (r.feature, r.media_sha256)) == (r.feature, r.media_sha256)


def test_op8_tail_is_the_last_bytes(spark, tmp_path):
    texts = ["a" * 190 + "é", "a" * 191 + "é", "漢" * 64, "🙂" * 48, "é" * 95, "a" * 184 + "é" * 4]
    documents(spark, [(k, t, None, None, None) for k, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    payloads = [t.encode() + b" " * (-len(t.encode()) % 192) for t in texts]
    rows = queries.op8_audio_features(spark, str(tmp_path)).collect()
    assert in_rows(rows, "doc_id", "tail_crc32") == [(k, zlib.crc32(p[-16:])) for k, p in enumerate(payloads)]
    assert in_rows(rows, "doc_id", "payload_sha256") == [(k, hashlib.sha256(p).hexdigest()) for k, p in enumerate(payloads)]


def test_op9(spark, folder):
    rows = run(spark, folder, "op9_pii", "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
    text = dict(TEXTS)[8]
    found = [("email", "ann.lee@example.com"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (415) 555-0100")]
    spans = ",".join(f"{k}:{text.index(s)}:{text.index(s) + len(s)}" for k, s in found)
    for r in rows:
        counts = (r.n_email, r.n_ip, r.n_card, r.n_phone)
        base = spans if r.doc_id == 8 else ""
        assert counts == ((1, 1, 1, 1) if r.doc_id == 8 else (0, 0, 0, 0)) and r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert len(rows) == len(DOCS)


def test_op10(spark, folder):
    rows = run(spark, folder, "op10_exact_top_k", "query_id bigint, rank int, vec_id bigint, score bigint")
    v = {r.vec_id: [math.floor(64 * x) for x in r.embedding] for r in spark.read.parquet(f"{folder}/embeddings.parquet").filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).collect()}
    want = []
    for q in (0, 20, 40):
        best = sorted((-sum(a * b for a, b in zip(v[q], v[c], strict=True)), c) for c in v if c != q)[:20]
        want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert in_rows(rows, "query_id", "rank", "vec_id", "score") == sorted(want, key=str)
