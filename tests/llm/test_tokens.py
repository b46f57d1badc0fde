import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docweave.llm import bpe, token_files

from .helpers import DOCS, documents

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
OWN = bpe.Encoder(RANKS, P.PATTERN)
REFERENCE = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


CODER = token_files.BatchEncoder(token_files._tokenizer(P.path("byte_bpe_50k.json")), 0)


def whole(text):
    return [i for k, p in enumerate(bpe.pieces(text)) for i in OWN.encode((" " if k else "") + p)]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="aab \n\té's.1,", max_size=200)))
def test_encoding_equals_the_rank_merging_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert OWN.encode(text) == REFERENCE.encode_ordinary(text) == whole(text)
    assert OWN.decode(OWN.encode(text)) == text.encode()


def test_pieces_join_again():
    for t in ("", " ", "a", " a", "a  b", "a \n b ", "\n\n x", "a\n b"):
        assert " ".join(bpe.pieces(t)) == t


def test_a_full_memo_keeps_its_older_half():
    calls = []
    memo = bpe.PieceMemo(lambda new: calls.append(list(new)) or [x.upper() for x in new], limit=4)
    for batch in (["a", "b"], ["c", "d"], ["e"], ["a", "e"]):
        known = memo.add(batch)
        assert all(known[x] == x.upper() for x in batch)
    assert calls == [["a", "b"], ["c", "d"], ["e"]] and len(memo.known) <= 4


def test_documents_keep_every_row(spark):
    df = documents(spark).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    rows = bpe.encode_documents(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()
    assert len(rows) == len(DOCS)
    texts = {d[0]: d[1] or "" for d in DOCS}
    for r in rows:
        assert r.ids == REFERENCE.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded) == texts[r.doc_id].encode()
    assert bpe.encode_documents(documents(spark, []), P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_token_files_round_trip(spark, tmp_path):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    folder = str(tmp_path)
    shards = token_files.write_token_files(documents(spark).withColumn("start", F.lit(0)), folder, P.path("byte_bpe_50k.json"), seq_len=64)
    rows = token_files.read_token_files(spark, folder, shards).collect()
    want, at = [], 0
    for d in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = [*tok.encode(d[1] or "", add_special_tokens=False).ids, 0]
        want.append((d[0], at, len(ids), ids))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.read_digests(spark, folder, shards).collect()}
    assert all(digest[d, s] == zlib.crc32(np.array(i, "<u4").tobytes()) for d, s, _, i in want)
    reader = token_files.TokenShard(f"{folder}/{shards[0][0]}.arrow")
    first, mask = reader.sequence(0)
    assert len(first) == 64 and first.base is not None and len(mask) == 64
    assert pa.types.is_fixed_size_list(reader.file.schema.field("ids").type)


UNTOUCHED = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_in_texts_get_their_ids(name):
    tok = Tokenizer.from_file(P.path(name))
    texts = ["plain words", None, ""]
    for added in tok.get_added_tokens_decoder().values():
        c = added.content
        texts += [f"hello {c} world", c, c + c, f"a{c}b plain words", f"{c[:-1]} not whole", f" {c}", f"{c} "]
    for batches in ([texts], [[t] for t in texts]):
        coder, got = token_files.BatchEncoder(token_files._tokenizer(P.path(name)), 0), []
        for batch in batches:
            ids, sizes = coder.encode(pa.array(batch, pa.string()))
            got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def test_pieces_of_white_space_keep_their_own_ids():
    tok = UNTOUCHED
    texts = [" \xa0", "foo", "bar", " x\xa0", "y", " \x1f", "z ", " q", "ab", "cd", " \u3000"]
    for batches in ([texts], [texts[::-1]], [[t] for t in texts]):
        coder = token_files.BatchEncoder(tok, 0)
        for batch in batches:
            ids, sizes = coder.encode(pa.array(batch, pa.string()))
            assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in batch]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="ab \n\u3000\xa0é's.1\x1f", max_size=60)), max_size=6))
def test_batches_equal_whole_texts(texts):
    tok = UNTOUCHED
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, sizes = CODER.encode(pa.array(texts, pa.string()))
    want = [[*tok.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_a_coder_keeps_its_memo_bounded():
    small = token_files.BatchEncoder(token_files._tokenizer(P.path("byte_bpe_50k.json")), 0, limit=6)
    for k in range(5):
        texts = [f"word{k} word{k + 1} some more words", "word0"]
        assert small.encode(pa.array(texts))[0].tolist() == CODER.encode(pa.array(texts))[0].tolist()
        assert len(small.known) <= 9


def test_an_empty_table_has_no_shards(spark, tmp_path):
    shards = token_files.write_token_files(documents(spark, []), str(tmp_path), P.path("byte_bpe_50k.json"))
    assert shards == [] and token_files.read_token_files(spark, str(tmp_path), shards).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_joined_pieces_equal_single_ones(name):
    tok = Tokenizer.from_file(P.path(name))
    lengths = np.zeros(tok.get_vocab_size() + 1, np.int64)
    for entry, i in tok.get_vocab().items():
        lengths[i] = len(entry)
    texts = [" a", " bé", " 漢字", " x1,y", " word"] * 3
    got = token_files.encode_pieces(tok, lengths, [t.encode() for t in texts], [True] * len(texts), "uint16", group=4)
    assert [np.frombuffer(g, np.uint16).tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_pieces_of_equal_hash_keep_their_own_ids():
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    data = np.frombuffer((one + two).encode(), np.uint8)
    h = token_files.span_hashes(data, np.array([0, 2048]), np.array([2048, 4096]), token_files._CODE)
    assert h[0] == h[1] and one != two
    texts = ["x", one, "", two, "a b", f"go {two} on"]
    tok = token_files._tokenizer(P.path("byte_bpe_50k.json"))
    want = [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    for batches in ([texts], [[t] for t in texts]):
        coder, got = token_files.BatchEncoder(tok, 0), []
        for batch in batches:
            ids, sizes = coder.encode(pa.array(batch))
            got += [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == want
