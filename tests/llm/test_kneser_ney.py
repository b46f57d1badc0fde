import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import kneser_ney as kn

from .helpers import DOCS, documents


def words(text):
    low = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low)) + ["</s>"]


class Brute:
    def __init__(self, texts):
        self.one, self.two = Counter(), Counter()
        for t in texts:
            w = words(t)
            self.one.update(w)
            self.two.update(zip(["</s>", *w], w, strict=False))
        times = lambda c: [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        self.before = Counter(b for _, b in self.two)
        self.d2, self.d1 = [0, *kn.discounts(times(self.two))], [0, *kn.discounts(times(self.before))]
        self.n, self.v, self.pairs = sum(self.one.values()), len(self.one), max(1, len(self.two))
        self.left = sum(self.d1[min(c, 3)] for c in self.before.values()) / self.pairs if self.two else 1.0
        self.total, self.back = Counter(), defaultdict(float)
        for (a, _), c in self.two.items():
            self.total[a] += c
            self.back[a] += self.d2[min(c, 3)]

    def p(self, a, w):
        low = max(self.before[w] - self.d1[min(self.before[w], 3)], 0) / self.pairs + self.left / (self.v + 1)
        if not self.total[a]:
            return low
        c = self.two[a, w]
        return max(c - self.d2[min(c, 3)], 0) / self.total[a] + self.back[a] / self.total[a] * low

    def score(self, text):
        w = words(text)
        base = sum(math.log10((self.one[x] + 1) / (self.n + self.v + 1)) for x in w)
        return len(w), sum(self.one[x] > 0 for x in w), base, sum(math.log10(self.p(a, x)) for a, x in zip(["</s>", *w], w, strict=False))


@pytest.mark.parametrize("flush,dense", [(7, kn.DENSE_BITS), (7, 3), (kn.FLUSH, 2), (kn.FLUSH, kn.DENSE_BITS)])
def test_scores_equal_brute_force(spark, monkeypatch, flush, dense):
    monkeypatch.setattr(kn, "FLUSH", flush)
    monkeypatch.setattr(kn, "DENSE_BITS", dense)
    train = [d for d in DOCS if d[0] is None or d[0] not in (3, 6)]
    about = kn.train(documents(spark, train))
    brute = Brute([d[1] for d in train])
    assert about["tokens"] == brute.n and about["words"] == brute.v
    rows = kn.score(documents(spark).withColumn("score", F.lit("clash")), about).collect()
    texts = {d[0]: d[1] for d in DOCS}
    assert len(rows) == len(DOCS)
    for r in rows:
        n, known, base, score = brute.score(texts[r.doc_id])
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, brute.n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_probabilities_of_a_context_add_up_to_one():
    brute = Brute(["a b a c", "a b b", "c a d a b"])
    for context in ("a", "b", "</s>", "never seen"):
        rest = brute.p(context, "an unknown word")
        assert sum(brute.p(context, w) for w in brute.one) + rest == pytest.approx(1)


def test_an_empty_corpus_knows_nothing(spark):
    about = kn.train(documents(spark, []))
    rows = kn.score(documents(spark), about).collect()
    assert len(rows) == len(DOCS) and all(r.n_known == 0 and r.base_score == 0 and r.score == 0 for r in rows)


def test_hot_contexts_are_spread_and_still_right(spark):
    docs = [(i, " ".join(f"the w{i * 40 + k}" for k in range(40)), None, None, None) for i in range(30)]
    about = kn.train(documents(spark, docs))
    assert about["hot"]
    brute = Brute([d[1] for d in docs])
    for r in kn.score(documents(spark, docs[:3]), about).collect():
        assert r.score == pytest.approx(brute.score(docs[r.doc_id][1])[3])


def test_hashing_ignores_batches_and_case():
    data = "Ab cd\n\x0bEF é AB".encode()
    a, cuts = kn.tokens(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert len(a) == 6 and a[0] == a[4] and a[5] == kn.END and cuts.tolist() == [0, 6]
    two = np.frombuffer(data + data, np.uint8)
    b, cuts = kn.tokens(two, np.array([0, len(data), len(data), 2 * len(data)]))
    assert cuts.tolist() == [0, 6, 7, 13] and np.array_equal(b, np.concatenate([a, [kn.END], a]))
