"""Byte-level BPE encoding and decoding (operator 6).

Method: the vocabulary's byte strings, mapped to Latin-1 text, form an
Aho-Corasick automaton. One scan gives the longest vocabulary entry that starts
at each byte. Encoding walks from the left with the longest entry and backtracks
to shorter ones (or drops the last token) until every adjacent pair of tokens is
*compatible*: merging their joined bytes by rank gives back just those two
tokens. A sequence whose adjacent pairs are all compatible is the one that rank
merging gives, and each (position, entry) is tried at most once, so the time is
linear. Compatibility is memoised, as are whole pieces of text.

Nulls count as empty texts (no ids); text of any length is encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from docweave.llm.common import SMALL_BATCH_BYTES, bounded_batches, release_memory

#: Entries that a task's memos of pieces and of pattern matches may hold, and those of a worker that stages before have filled.
MEMO, MATCHES = 500_000, 300_000
SMALL_MEMO, SMALL_MATCHES = 150_000, 60_000
#: Pairs of adjacent tokens that an encoder remembers.
FITS = 200_000
_SPACED = re.compile(r"\s ")
_PIECES = re.compile(r"\s*\S+|\s+")


def pieces(text: str) -> list[str]:
    """Cut text before single spaces that follow other characters, where no match of the split pattern goes on.

    A match never runs from a non-space character into white space, so pieces
    can be encoded one by one. The first piece is as it stands; the others lack
    their leading space, which :func:`encode_pieces` puts back.
    """
    if not text:
        return []
    if _SPACED.search(text) is None:
        return text.split(" ")
    found = _PIECES.findall(text)
    out = found[:1] if not found[0].startswith(" ") else ["", found[0][1:]]
    for piece in found[1:]:
        if piece[0] == " ":
            out.append(piece[1:])
        else:  # other white space: it stays with the piece before, which is then longer
            out[-1] += piece
    return out


class PieceMemo:
    """Maps pieces to values; new pieces of a batch are computed together.

    A full memo keeps its older half: what is frequent was met early.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = MEMO):
        self.compute, self.limit, self.known = compute, limit, {}

    def add(self, found: Iterable[str]) -> dict:
        known = self.known
        new = [p for p in found if p not in known]
        if new:
            if len(known) + len(new) > self.limit:
                known = self.known = dict(islice(known.items(), self.limit // 2))
                new = [p for p in found if p not in known]
            known.update(zip(new, self.compute(new), strict=True))
        return known


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary file: a base64 byte string and a rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Rank-merging BPE for the byte strings of single pattern matches."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.text_of = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for t, r in ranks.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), r))
        self.automaton.make_automaton()
        self._shorter: dict[int, int] = {}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[tuple[int, int], bool] = {}
        self._matches: dict[str, bytes] = {}
        self.most_matches = MATCHES
        self.lengths = {r: len(t) for t, r in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")

    def shorter(self, token: int) -> int:
        """The longest vocabulary entry that is a proper prefix; -1 for single bytes."""
        found = self._shorter.get(token)
        if found is None:
            t = self.text_of[token]
            found = next((self.ranks[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.ranks), -1)
            self._shorter[token] = found
        return found

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two entries whose merge makes this one; None for entries that no merge makes."""
        if token not in self._parts:
            t = self.text_of[token]
            found = None
            # the last merge has the greatest rank below the entry's own, so it is the compatible cut
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None and max(a, b) < token and self.fits(a, b, token):
                    found = (a, b)
                    break
            self._parts[token] = found
        return self._parts[token]

    def fits(self, left: int, right: int, below: int = 1 << 60) -> bool:
        """Whether merging the joined bytes by ranks under ``below`` ends at (left, right).

        Undo the later of the two tokens' last merges again and again: had some
        merge across the border a lower rank than the merges already undone, it
        would have come first.
        """
        key = (left, right)
        if below == 1 << 60 and key in self._fits:
            return self._fits[key]
        a, b, limit, answer = left, right, below, True
        while True:
            joined = self.ranks.get(self.text_of[a] + self.text_of[b])
            if joined is not None and joined < limit:
                answer = False
                break
            pa_, pb_ = self.parts(a), self.parts(b)
            if pa_ is None and pb_ is None:
                break
            # a border merge of equal rank wins over a right-hand merge (it is further left) but not over a left-hand one
            if pb_ is None or (pa_ is not None and a > b):
                a, limit = pa_[1], min(limit, a)
            elif pa_ is None or b > a:
                b, limit = pb_[0], min(limit, b + 1)
            else:  # the same token on both sides: the right one's last merge is the later
                b, limit = pb_[0], min(limit, b + 1)
        if below == 1 << 60:
            if len(self._fits) >= FITS:  # emptied in place, since a caller may hold it; the older half stays
                older = list(islice(self._fits.items(), FITS // 2))
                self._fits.clear()
                self._fits.update(older)
            self._fits[key] = answer
        return answer

    def encode_bytes(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:  # an entry stands for itself, whatever merges would make it
            return [whole]
        n = len(data)
        longest = [0] * n
        size = [0] * n
        for end, (length, rank) in self.automaton.iter(data.decode("latin-1")):
            at = end - length + 1
            if length > size[at]:
                size[at], longest[at] = length, rank
        lengths, known, shorter = self.lengths, self._fits, self.shorter
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            if not dead[end]:
                fits = last < 0 or known.get((last, token))
                if fits is None:
                    fits = self.fits(last, token)
                if fits:
                    out.append(token)
                    if end == n:
                        return out
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter(token)
            while token < 0:  # nothing starts here: take back the last token and try a shorter one
                dead[at] = 1
                token = out.pop()
                at -= lengths[token]
                token = shorter(token)
            last = out[-1] if out else -1

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.split.findall(text):
            out += self.encode_bytes(match.encode())
        return out

    def encode_packed(self, text: str) -> bytes:
        """Ids as 32-bit integers; the matches' ids are memoised."""
        known = self._matches
        found = self.split.findall(text)
        if len(known) > self.most_matches:
            known = self._matches = dict(islice(known.items(), self.most_matches // 2))
        out = []
        for match in found:
            ids = known.get(match)
            if ids is None:
                ids = known[match] = array("i", self.encode_bytes(match.encode())).tobytes()
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.text_of.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and worker."""
    key = (ranks_path, pattern)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(read_ranks(ranks_path), pattern)
    return _ENCODERS[key]


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO, matches: int = MATCHES) -> DataFrame:
    """(id, ids array<int>, decoded binary): the token ids of each whole text and the bytes they decode to.

    No shuffle; a row in gives a row out, duplicates and null ids included. A
    null or empty text has no ids. Other columns are not carried. memo and
    matches bound what a task remembers, not what it encodes.
    """
    bounded_batches(df.sparkSession, SMALL_BATCH_BYTES)
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        enc = encoder(ranks_path, pattern)
        enc.most_matches = matches
        pieces_of = PieceMemo(lambda new: [enc.encode_packed(" " + p) for p in new], memo)
        table = np.array([enc.text_of.get(i, b"") for i in range(max(enc.text_of) + 1)], dtype=object)
        try:
            for batch in batches:
                ids, decoded = [], []
                for text in _texts(batch.column(1)):
                    parts = pieces(text)
                    head = enc.encode_packed(parts[0]) if parts else b""
                    rest = parts[1:]
                    known = pieces_of.add(set(rest))
                    ids.append(head + b"".join(map(known.__getitem__, rest)))
                    decoded.append(b"".join(table[np.frombuffer(ids[-1], dtype=np.int32)].tolist()))
                flat = np.frombuffer(b"".join(ids), dtype=np.int32)
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(decoded, pa.binary())], names=[id_col, "ids", "decoded"])
        finally:  # memos are a task's own
            pieces_of.known = enc._matches = {}
            enc._fits.clear()
            release_memory()

    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, ids array<int>, decoded binary")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
