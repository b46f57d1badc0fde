import random
import tracemalloc
from array import array

import numpy as np
import public_tokenizers
import pyarrow as pa

import corpus_pipeline as cp
from docweave.llm import bpe, lang_id, mixing, simhash
from docweave.llm.common import cut_lineage

from .helpers import DOCS, SCHEMA, documents


def test_stages_return_the_columns_of_documents_and_take_effect(spark):
    docs = documents(spark)
    one = cut_lineage(cp.language_id(spark, docs, ""), "t")
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == {1, 5, 6, 7, 8, None}
    two = cut_lineage(cp.near_dedup(spark, one, ""), "t")
    assert sorted(r.doc_id or 0 for r in two.collect()) == [0, 1, 6, 7, 8] and two.columns == docs.columns
    three = cut_lineage(cp.redact_pii(spark, two, ""), "t")
    texts = {r.doc_id: (r.text, r.n_chars) for r in three.collect()}
    assert "[EMAIL]" in texts[8][0] and texts[8][1] == len(texts[8][0]) and texts[1][0] == DOCS[0][1]
    four = cut_lineage(cp.mix_sources(spark, three, ""), "t")
    assert four.count() == three.count() and four.columns == docs.columns
    five = cp.tokenize(spark, four, "").collect()
    assert sorted(r.mix_position for r in five) == list(range(len(five)))
    order = [r.doc_id for r in sorted(mixing.mix(three).collect(), key=lambda r: (r.slot, r.place))]
    assert [r.doc_id for r in sorted(five, key=lambda r: r.mix_position)] == order


def test_dedup_keeps_one_of_each_component(spark):
    rows = [(i, f"alpha beta gamma delta {i // 4} epsilon " * 9, "en", "s", 1) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert {r.doc_id for r in cp.near_dedup(spark, docs, "").collect()} == want


def test_dedup_keeps_unlike_texts_of_one_id(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abcd"}
    rows = [(1, text["a"]), (1, text["b"]), (2, text["a"]), (3, text["c"]), (3, text["c"]), (4, text["c"]), (4, text["d"])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = sorted((r.doc_id, r.text) for r in cp.near_dedup(spark, docs, "").collect())
    assert got == [(1, text["a"]), (1, text["b"]), (3, text["c"]), (4, text["d"])]


def test_stages_take_columns_of_any_name_and_type(spark):
    extra = ["block", "slot", "score", "lang_pred", "key", "row", "_file", "id", "digest", "component", "h", "_0", "a.b"]
    docs = documents(spark).selectExpr("*", *[f"'{c}' as `{c}`" for c in extra], "map('k', doc_id) as m", "array(map('x', 1)) as n")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.schema.names == docs.schema.names, name
        docs = cut_lineage(out, name)
        assert docs.count() >= 5 and [tuple(r) for r in docs.select(*[f"`{c}`" for c in extra]).distinct().collect()] == [tuple(extra)]
    out = cp.tokenize(spark, docs, "").collect()
    assert len(out) == docs.count() and all(r.mix_position is not None for r in out)


def brute_force(texts):
    """Component of each text: pairs whose five-word shingle sets have a similarity of at least 0.8, joined."""
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t).split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    sets, label = [shingles(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both, union = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if both >= 0.8 * union and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    return label


def test_the_pipeline_equals_a_brute_force_version(spark, tmp_path):
    """On documents whose languages are plain to see: which rows stay, how they read, and their ids."""
    import base64
    import hashlib
    import re

    import public_tokenizers as P
    import tiktoken

    rng = random.Random(8)
    words = {"en": "the and of to with from this that were which house water".split(), "de": "der und die das nicht mit von auch wurde welche haus wasser".split()}
    rows, i = [], 0
    for k in range(30):
        lang = "en" if k % 2 else "de"
        w = rng.choices(words[lang], k=rng.randint(30, 60)) + [f"{lang}{k}x{j}" for j in range(40)]
        rng.shuffle(w)
        base = " ".join(w)
        for copy in range(rng.choice([1, 1, 2, 3])):
            v = base.split()
            for _ in range(copy):
                v[rng.randrange(len(v))] = f"new{i}"
            rows.append((i, " ".join(v) + (f" mail a.b{k}@example.com, 10.0.0.{k}" if k % 5 == 0 else ""), lang, f"s{k % 3}", None))
            i += 1
    rows += [(900, "123 456", None, "s0", None), (901, None, None, "s1", None), (902, "", "en", "s1", None)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in cp.run(spark, str(tmp_path)).collect()}
    letters = [r for r in rows if re.search(r"[^\W\d_]", r[1] or "")]
    label = brute_force([r[1] for r in letters])
    first = {}
    for r, x in zip(letters, label, strict=True):
        first.setdefault(x, r)
    assert 1 < len(first) < len(letters) and set(got) == {r[0] for r in first.values()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in first.values():
        text = re.sub(r"10\.0\.0\.\d+", "[IP]", re.sub(r"\S+@[a-z.]+", "[EMAIL]", r[1]))
        ids = coder.encode_ordinary(text)
        assert (got[r[0]].n_tokens, got[r[0]].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[r[0]].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert sorted(r.mix_position for r in got.values()) == list(range(len(got)))


def test_empty_documents_pass_through(spark):
    docs = documents(spark, [])
    for _, stage in cp.STAGES:
        out = stage(spark, docs, "")
        assert out.count() == 0


def test_language_stage_keeps_clean_texts_of_any_length(spark):
    words = {"en": "the and of to with from this that were which", "de": "der und die das nicht mit von auch wurde welche", "fr": "le et les des dans avec pour cette mais leur", "es": "el y los las con para esta pero sus desde"}
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=rng.randint(3, 60))), lang, "s", 1) for i, lang in enumerate(sorted(words) * 60)]
    alphabet = "abcdefghijklmnopqrstuvwxyzäöüßéè"
    long = " ".join("".join(rng.choices(alphabet, k=rng.randint(2, 9))) for _ in range(400_000))
    rows += [(1000 + k, t, None, "s", len(t)) for k, t in enumerate(["Guten Tag", "Avec.", "Hi", "a", "Oui", long])]
    docs = spark.createDataFrame([*rows, (2000, "12 34", None, "s", 5), (2001, None, None, "s", 0)], SCHEMA)
    assert len(long) > 2 << 20
    assert {r.doc_id for r in cp.language_id(spark, docs, "").select("doc_id").collect()} == {r[0] for r in rows}


def test_tokenize_remembers_less_and_encodes_the_same(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(f"{rng.choice('abcd')}{rng.randrange(3000)}-x,y" for _ in range(200)) for _ in range(30)] + ["", None, "  a\n b "]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    asked, encode = [], bpe.encode_documents
    monkeypatch.setattr(bpe, "encode_documents", lambda *a, **k: asked.append(k) or encode(*a, **{**k, "memo": 200, "matches": 50}))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in cp.tokenize(spark, docs, "").collect()}
    assert asked[0]["memo"] < bpe.MEMO and asked[0]["matches"] < bpe.MATCHES
    whole = {r.doc_id: r for r in bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()}
    assert {i: x[0] for i, x in got.items()} == {i: len(r.ids) for i, r in whole.items()}
    assert {i: x[1:] for i, x in got.items()} == {i: (bpe.sha256_hex(" ".join(map(str, r.ids)).encode()), bpe.sha256_hex(bytes(r.decoded))) for i, r in whole.items()}


def test_an_encoder_forgets_matches_over_its_bound():
    enc = bpe.Encoder(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    enc.most_matches = 50
    for k in range(500):
        assert enc.decode(array("i", enc.encode_packed(f" w{k} v{k}"))) == f" w{k} v{k}".encode()
        assert len(enc._matches) < 60


def test_an_encoder_forgets_pairs_over_its_bound(monkeypatch):
    rng = random.Random(7)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(40)) for _ in range(20)]
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    whole = bpe.Encoder(bpe.read_ranks(path), public_tokenizers.PATTERN)
    want = [whole.encode(t) for t in texts]
    assert len(whole._fits) > 400
    monkeypatch.setattr(bpe, "FITS", 40)
    enc = bpe.Encoder(whole.ranks, public_tokenizers.PATTERN)
    for text, ids in zip(texts, want, strict=True):
        assert enc.encode(text) == ids and len(enc._fits) <= 40


def test_language_of_a_large_batch_takes_little_memory():
    texts = ["1 2", "", "ab" * (1 << 21), "", "12" * (1 << 18), "\u00e9", "7", "", "z"]
    column = pa.array(texts, pa.large_string())
    data, offsets = lang_id.texts_of(column)
    tracemalloc.start()
    letters = lang_id.has_letter(column, data, offsets)
    bits = lang_id.presence(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20 < 4 * len(data)
    assert letters.tolist() == [False, False, True, False, False, True, False, False, True]
    assert bits.sum(axis=1).tolist() == [6, 0, 6, 0, 6, 3, 1, 0, 1]


def test_presence_does_not_depend_on_pieces(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices("aB \u00fc\u4e2d", k=rng.choice([0, 0, 1, 2, 3, 9, 40]))) for _ in range(60)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    want, column = lang_id.presence(data, offsets), pa.array(texts)
    letters = [any(c.isalpha() for c in t) for t in texts]
    for piece in (1, 2, 3, 7, 64):
        monkeypatch.setattr(lang_id, "_PIECE", piece)
        assert np.array_equal(lang_id.presence(data, offsets), want)
        assert lang_id.has_letter(column, data, offsets).tolist() == letters
