import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from docweave.llm import simhash as S
from docweave.llm.components import components

from .helpers import DOCS, documents


def brute_fingerprint(text):
    w = text.encode().lower().split()
    if not w:
        return 0
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((sum(x >> b & 1 for x in h) * 2 > len(h)) << b for b in range(64))


def brute_components(ids, fps, radius=3):
    label = {i: i for i in ids}
    fps = np.array(fps, dtype=np.uint64)
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius)
    changed = True
    while changed:
        changed = False
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            low = min(label[ids[x]], label[ids[y]])
            for z in (ids[x], ids[y]):
                if label[z] != low:
                    label[z], changed = low, True
    return label


def test_fingerprints(spark):
    for t in ("", " \n", "One", "one two", "One two THREE four é", "a b c " * 700):
        assert S.fingerprint(t) == brute_fingerprint(t)
    rows = S.fingerprints(documents(spark).withColumn("fp", F.lit("clash"))).collect()
    assert len(rows) == len(DOCS)


def test_hash_is_the_engines_own(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def near_points(n=12, seed=1):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 2**63, n, dtype=np.uint64).tolist():
        for _ in range(15):
            x = base
            for k in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                x ^= 1 << k
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("group,split", [(None, S.SPLIT), (3, 20)])
def test_links_have_the_components_of_all_pairs(spark, group, split):
    fps = near_points()
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fps)], "fp long, node long")
    found = {r.node: r.label for r in components(S.links(nodes, group, split), "a", "b").collect()}
    want = brute_components(list(range(len(fps))), fps)
    assert {i: found.get(i, i) for i in want} == want


def test_near_duplicates(spark):
    rows = S.near_duplicates(documents(spark)).collect()
    assert len(rows) == len(DOCS)
    got = {r.doc_id: r.component_id for r in rows}
    named = [d for d in {d[0]: d for d in DOCS if d[0] is not None}.values()]
    want = brute_components([d[0] for d in named], [brute_fingerprint(d[1] or "") for d in named])
    assert {k: v for k, v in got.items() if k is not None} == want
    assert got[5] == 1 and got[3] == 2 and got[None] is None
    assert S.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 620)] + [(7, 7), (None, 3)]
    rows = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()}
    assert set(rows) == set(range(100, 161)) | set(range(500, 620))
    assert all(v == (100 if k < 200 else 500) for k, v in rows.items())
