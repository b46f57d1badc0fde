import random
from itertools import combinations

import corpus_pipeline as cp
from docweave.llm import near_copies as N
from docweave.llm.simhash import fingerprint

from .helpers import SCHEMA


def shingles(text, size=5):
    w = text.lower().split()
    size = min(size, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b)


def edited(rng, words, n):
    words = list(words)
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10**6)}"
    return words


def test_stage_finds_planted_copies_and_leaves_the_rest(spark):
    rng = random.Random(5)
    rows, near, far = [], set(), set()
    for k in range(120):
        words = [f"w{rng.randrange(20000)}" for _ in range(rng.randint(80, 400))]
        copy = edited(rng, words, max(1, len(words) * rng.randint(1, 40) // 1000))
        rows += [(2 * k, " ".join(words), "en", "s", 1), (2 * k + 1, " ".join(copy), "en", "s", 1)]
        (near if jaccard(shingles(rows[-1][1]), shingles(rows[-2][1])) >= 0.8 else far).add(2 * k + 1)
    assert len(near) > 60 and len(far) > 15
    kept = {r.doc_id for r in cp.near_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert kept == {r[0] for r in rows} - near


def test_balls_find_what_no_band_finds(spark):
    rng = random.Random(66538)
    words = [f"w{rng.randrange(20000)}" for _ in range(140)]
    texts = [" ".join(words), " ".join(edited(rng, words, 3)), " ".join(words[:70] + [f"v{i}" for i in range(70)])]
    keys = [N.band_keys(N.shingle_set(t)) for t in texts]
    assert not (keys[0] == keys[1]).any() and jaccard(shingles(texts[0]), shingles(texts[1])) >= 0.8 and (fingerprint(texts[0], 5) ^ fingerprint(texts[1], 5)).bit_count() <= 3
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    assert {r.doc_id for r in cp.near_dedup(spark, docs, "").collect()} == {0, 2}


def test_members_of_a_ball_are_compared_in_pairs(spark, monkeypatch):
    rng = random.Random(8)  # no band is shared; all texts are in one ball
    monkeypatch.setattr(N, "balls", lambda nodes: nodes.selectExpr("fp", "1L AS component"))
    monkeypatch.setattr(N, "band_keys", lambda s: s.sum() + N.np.arange(N.BANDS, dtype=N.np.uint64))
    texts = []
    for k in range(6):
        words = [f"{k}x{i}" for i in range(100)]
        texts += [" ".join(words), " ".join(edited(rng, words, 1))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {bytes(r.digest): r.component for r in N.near_copies(docs).collect()}
    got = [found[bytes(r.d)] for r in docs.select("doc_id", N.text_digest(docs.text).alias("d")).orderBy("doc_id").collect()]
    assert got[::2] == got[1::2] and len(set(got)) == 6


def test_components_of_one_large_mixed_group(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(edited(rng, base, rng.randint(0, 6))) for _ in range(90)] + ["", None, " \n", "One two", "one TWO", "one"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {bytes(r.digest): r.component for r in N.near_copies(docs).collect()}
    got = {r.doc_id: found[bytes(r.d)] for r in docs.select("doc_id", N.text_digest(docs.text).alias("d")).collect()}
    sets = [shingles(t or "") for t in texts]
    label = list(range(len(texts)))
    for a, b in combinations(label[:], 2):
        if (not sets[a] and not sets[b]) or (sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8):
            old, new = label[b], label[a]
            label = [new if x == old else x for x in label]
    groups = lambda of: {frozenset(i for i in range(len(texts)) if of[i] == c) for c in set(of.values())}
    assert groups(got) == groups(dict(enumerate(label)))
    assert N.near_copies(docs.limit(0)).count() == 0
