import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docweave.llm import audio, html_crf, lang_id, mixing, pii, queries, topk
from docweave.llm.common import checkpoint_dir

from .helpers import DOCS, documents

# audio


def test_media_round_trip_and_equal_texts(spark):
    rows = audio.audio_features(documents(spark).withColumn("media", F.lit("clash"))).collect()
    texts = {d[0]: d[1] or "" for d in DOCS}
    assert len(rows) == len(DOCS)
    for r in rows:
        data = texts[r.doc_id].encode()
        payload = bytes(r.payload)
        assert r.n_bytes == len(data) and payload == audio.pad(data) and len(payload) % 192 == 0 and payload
        assert audio.read_wav(bytes(r.media)) == (audio.RATE, payload)
        assert len(r.patches) == -(-r.n_frames // audio.PATCH) * audio.PATCH * audio.MELS
        assert all(0 <= s.start_ms < s.end_ms for s in r.segments)
    same = {(bytes(r.patches), str(r.segments)) for r in rows if r.doc_id in (1, 5)}
    assert len(same) == 1
    assert audio.audio_features(documents(spark, [])).count() == 0


def test_slabs_do_not_show(monkeypatch):
    x = np.random.default_rng(0).integers(0, 256, audio.UNIT * 37).astype(np.uint8)
    want, energy = audio.log_mel(x)
    monkeypatch.setattr(audio, "SLAB", 5)
    got, energy2 = audio.log_mel(x)
    assert np.abs(want.astype(int) - got).max() <= 1 and np.allclose(energy, energy2, atol=1e-3)


def test_a_tone_is_in_its_band_after_resampling():
    t = np.arange(audio.UNIT * 100) / audio.RATE
    x = (128 + 100 * np.sin(2 * np.pi * 1000 * t)).astype(np.uint8)
    levels, _ = audio.log_mel(x)
    centre = np.argmax(audio._MEL[np.argmin(np.abs(np.fft.rfftfreq(audio.WINDOW, 1 / 16000) - 1000))])
    assert abs(int(np.argmax(levels[50])) - centre) <= 1


def plain_log_mel(samples):
    """Levels and energies from the definitions: a sum for each sample, frequency and band."""
    x = [(int(v) - 128) / 128 for v in samples]
    half = audio.TAPS // 2
    kernel = []
    for k in range(audio.UP):
        at = [i - half - k * audio.DOWN / audio.UP for i in range(audio.TAPS)]
        window = [np.i0(8 * max(0.0, 1 - (t / (half + 1)) ** 2) ** 0.5) / np.i0(8) for t in at]
        low = [1.0 if t == 0 else np.sin(np.pi * t * audio.UP / audio.DOWN) / (np.pi * t * audio.UP / audio.DOWN) for t in at]
        g = [a * b for a, b in zip(window, low, strict=True)]
        kernel.append([v / sum(g) for v in g])
    y = []
    for n in range(len(x) * audio.UP // audio.DOWN):
        first = n // audio.UP * audio.DOWN - half
        y.append(sum(kernel[n % audio.UP][i] * x[first + i] for i in range(audio.TAPS) if 0 <= first + i < len(x)))
    frames = len(samples) // audio.UNIT
    y += [0.0] * audio.WINDOW
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    rate = audio.RATE * audio.UP / audio.DOWN
    edges = [700 * (10 ** (m / 2595) - 1) for m in np.linspace(mel(20), mel(rate / 2), audio.MELS + 2)]
    turn = np.exp(-2j * np.pi * np.outer(np.arange(audio.WINDOW // 2 + 1), np.arange(audio.WINDOW)) / audio.WINDOW)
    levels, energy = [], []
    for f in range(frames):
        cut = np.array(y[f * audio.HOP : f * audio.HOP + audio.WINDOW])
        energy.append(10 * np.log10(np.mean(cut * cut) + 1e-9))
        power = np.abs(turn @ (cut * [0.5 - 0.5 * np.cos(2 * np.pi * n / audio.WINDOW) for n in range(audio.WINDOW)])) ** 2
        row = []
        for b in range(audio.MELS):
            low, centre, high = edges[b : b + 3]
            total = 0.0
            for k, p in enumerate(power):
                hz = k * rate / audio.WINDOW
                total += p * max(0.0, min((hz - low) / (centre - low), (high - hz) / (high - centre)))
            row.append(min(255, max(0, round(20 * np.log10(total + 1e-6) + 120))))
        levels.append(row)
    return np.array(levels), np.array(energy)


@pytest.mark.parametrize("text", ["A" * 400, "The quick brown fox jumps over the lazy dog. " * 20, "\x00\x7f" * 500, "é漢 " * 150])
def test_log_mel_equals_the_definitions(text):
    samples = np.frombuffer(audio.pad(text.encode()), np.uint8)
    levels, energy = audio.log_mel(samples)
    want, loud = plain_log_mel(samples)
    assert levels.shape == want.shape and np.abs(levels.astype(int) - want).max() <= 1 and (levels == want).mean() > 0.98
    assert np.allclose(energy, loud, atol=2e-3)


def plain_segments(energy):
    """A switch that goes on at one threshold and off at the other."""
    mean, on, out = np.float32(np.mean(energy)), None, []
    for k, e in enumerate(energy):
        if on is None and e >= mean + audio.ON_DB:
            on = k
        elif on is not None and e < mean + audio.OFF_DB:
            out.append((on, k))
            on = None
    return out + ([(on, len(energy))] if on is not None else [])


def test_segments_have_hysteresis():
    mean_four = np.array([0, 0, 9, 4.5, 4.2, 9, 0, 0, 4.5, 8.8], np.float32)  # stays on between the thresholds, and doesn't go on there
    assert audio.segments(mean_four) == [(2, 6), (9, 10)]
    assert audio.segments(np.zeros(5, np.float32)) == []
    rng = np.random.default_rng(1)
    for _ in range(300):
        e = (rng.normal(size=rng.integers(1, 40)) * rng.choice([0.3, 2, 6])).astype(np.float32)
        assert audio.segments(e) == plain_segments(e)


def test_patches_are_tensors(spark, tmp_path):
    out = audio.write_patches(audio.audio_features(documents(spark)), str(tmp_path)).collect()
    tables = [pa.ipc.open_file(pa.memory_map(r.file)).read_all() for r in out]
    assert sum(t.num_rows for t in tables) == sum(r.n_patches for r in out) > 0
    assert tables[0].schema.field("patch").type == pa.fixed_shape_tensor(pa.uint8(), (audio.PATCH, audio.MELS))


def test_query_stores_the_tensors_it_describes(spark, tmp_path):
    documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    shared = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(shared.glob("patches-*/*.arrow"))
    rows = queries.op8_audio_features(spark, str(tmp_path)).collect()
    stored = {}
    for file in set(shared.glob("patches-*/*.arrow")) - before:
        for r in pa.ipc.open_file(pa.memory_map(str(file))).read_all().select(["doc_id", "start_ms", "patch"]).to_pylist():
            stored.setdefault(r["doc_id"], []).append((r["start_ms"], np.asarray(r["patch"], np.uint8).tobytes()))
    for r in rows:
        frames, crc, *_ = r.feature.split(":")
        copies = sum(x.doc_id == r.doc_id for x in rows)
        patches = [x for _, x in sorted(stored[r.doc_id])][::copies]
        assert len(patches) == -(-int(frames) // audio.PATCH) and zlib.crc32(b"".join(patches)) == int(crc)


# personal data

E_, I_, C_, P_ = (re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"))


def brute_spans(t):
    d = lambda s: re.sub("[^0-9]", "", s)
    return [
        [m.span() for m in E_.finditer(t)],
        [m.span() for m in I_.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))],
        [m.span() for m in C_.finditer(t) if 16 <= len(d(m[0])) <= 19 and pii.luhn(d(m[0]))],
        [m.span() for m in P_.finditer(t) if 8 <= len(d(m[0])) <= 15],
    ]


def test_base_spans_equal_the_patterns():
    rng = random.Random(0)
    parts = ["1", "22", "4", ".", ".", "-", " ", "+", "(", ")", "@", "a", ".b", "_", "é", "4444", "\n", "4111 1111 1111 1111", "a@b.c"]
    for _ in range(4000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == brute_spans(t), t


@pytest.mark.parametrize("t", ["1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "(" * 100_000 + "at", "+1" + " " * 200_000, "a at " * 60_000, "12 " * 100_000, "1-" * 150_000])
def test_long_runs_take_linear_time(t):
    pii.base_spans(t)
    pii.spans_of(t)


def test_found_spans_and_redaction(spark):
    rows = {r.doc_id: r.spans for r in pii.find(documents(spark)).collect()}
    assert [(s.kind, s.base) for s in rows[8] if s.base] == [(0, True), (1, True), (2, True), (3, True)]
    assert rows[2] == [] and rows[1] == []
    out = pii.redact(documents(spark))
    texts = {r.doc_id: r.text for r in out.collect()}
    assert out.columns == documents(spark).columns and out.count() == len(DOCS)
    assert texts[8] == "mail me at [EMAIL] or [PHONE], card [CARD], host [IP]" and texts[2] is None and texts[1] == DOCS[0][1]
    assert pii.find(documents(spark, [])).count() == 0 and pii.redact(documents(spark, [])).count() == 0


def test_expectation_maximisation_finds_reliable_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    vote = lambda q: np.where(rng.random(4000) < q, truth, ~truth) * 2
    v = np.stack([vote(0.95), vote(0.9), vote(0.6)], 1)
    p, theta = pii.reliabilities(v.tolist(), np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.93
    assert theta[0, 1, 2] > theta[1, 1, 2] > theta[2, 1, 2]


def plain_em(rows, rounds=50):
    """The same model on single rows, in plain loops."""
    p = [(sum(v == 2 for v in r) + 0.5) / (sum(v != 1 for v in r) + 1) for r in rows]
    for _ in range(rounds):
        theta = []
        for j in range(len(rows[0])):
            theta.append([])
            for t in (0, 1):
                c = [0.5, 0, 0.5]
                for r, q in zip(rows, p, strict=True):
                    if r[j] != 1:
                        c[r[j]] += q if t else 1 - q
                theta[-1].append([c[0] / sum(c), 1, c[2] / sum(c)])
        prior = (sum(p) + 1) / (len(p) + 2)
        new = []
        for r in rows:
            yes, no = prior, 1 - prior
            for j, v in enumerate(r):
                yes, no = yes * theta[j][1][v], no * theta[j][0][v]
            new.append(yes / (yes + no))
        p = new
    return p


def test_expectation_maximisation_equals_plain_loops():
    rng = random.Random(1)
    rows = [[rng.choice([2, 2, 1, 0]) if rng.random() < 0.7 else rng.randint(0, 2) for _ in range(4)] for _ in range(150)]
    patterns = sorted(map(list, {tuple(r) for r in rows}))
    p, _ = pii.reliabilities(patterns, np.array([rows.count(x) for x in patterns], float))
    want = dict(zip(map(tuple, rows), plain_em(rows), strict=True))
    assert [want[tuple(x)] for x in patterns] == pytest.approx(p.tolist(), abs=1e-6)


def test_logistic_regression_is_at_its_minimum():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(30), rng.integers(0, 2, (30, 4))])
    p, n = rng.random(30), rng.integers(1, 50, 30).astype(float)
    w = pii.logistic(x, p, n)
    q = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (n * (q - p)) + np.array([1e-6, 1, 1, 1, 1]) * w).max() < 1e-6


def codes(kind, base, *texts):
    """Codes of the spans between angle marks."""
    out = []
    for t in texts:
        a, e = t.index("<"), t.index(">") - 1
        out.append(pii.code_of(kind, t.replace("<", "").replace(">", ""), a, e, base))
    return out


def test_codes_can_be_read_again():
    for base, t in ((True, "phone <+1 415 555 0100>"), (False, "x(<415) 555.0100>a"), (False, "<0044 20 7946 0958>")):
        (code,) = codes(3, base, t)
        text, a, e = t.replace("<", "").replace(">", ""), t.index("<"), t.index(">") - 1
        assert pii._decode(code) == (3, base, pii.votes(3, text, a, e, base), pii.form(text, a, e)) and code < 1 << 31


def test_the_classifier_adds_and_refuses():
    (good,), (bad,), (base,) = codes(3, False, "call <415-555-0100> now"), codes(3, False, "dated <2024-01-02 10.30> serial"), codes(3, True, "phone <+1 415 555 0100>")
    score = pii.train({good: 50, bad: 50, base: 500})
    assert score[base] > 0.5 and score[good] > 0.5 and score[bad] < 0.5


def test_the_classifier_differs_from_a_majority_of_votes():
    base = codes(2, True, "card <4111 1111 1111 1111> ok", "x <5500000000000004> y")
    wrong = codes(2, False, "x <4111111111111112> y", "card <4111.1111.1111.1112> y", "x <9807915762804490> y")
    dotted = codes(2, False, "card <4111.1111.1111.1111> y")
    score = pii.train({base[0]: 200, base[1]: 200, wrong[0]: 150, wrong[1]: 5, wrong[2]: 400, dotted[0]: 10})
    majority = {c: (v := pii._decode(c)[2]).count(2) > v.count(0) for c in score}
    assert majority[wrong[1]] and score[wrong[1]] < 0.5  # announced, of an issuer: two votes to one, and yet no card
    assert score[dotted[0]] > 0.5 and all(score[c] > 0.5 for c in base)
    # the same votes and another form: another probability
    one, other = codes(2, False, "x <9807.9157.6280.4490> y", "(<9807.9157.6280.4490>) y")
    assert pii._decode(one)[2] == pii._decode(other)[2] and pii._decode(one)[3] != pii._decode(other)[3]
    score = pii.train({base[0]: 200, base[1]: 20, one: 100, other: 100})
    assert score[one] != score[other]


def test_found_candidates_of_all_kinds():
    text = "ann at example dot com, bob [at] x.org; 10[.]0[.]0[.]1 and 300.1.2.3; 4111.1111.1111.1111; 378282246310005; (415) 555-0100; 0044 20 7946 0958; +1 23 45 678 9"
    base, other = pii.spans_of(text)
    assert {(k, text[a:b]) for k, a, b in base} == {(3, "+1 23 45 678 9")}
    found = {(k, text[a:b]) for k, a, b in other}
    assert {(0, "ann at example dot com"), (0, "bob [at] x.org"), (1, "10[.]0[.]0[.]1"), (1, "300.1.2.3"), (2, "4111.1111.1111.1111"), (2, "378282246310005"), (3, "(415) 555-0100"), (3, "0044 20 7946 0958")} <= found
    long = "a" * 500 + " [at] " + "b" * 500 + " [dot] com"
    assert pii.spans_of(long)[1] == [(0, 0, len(long))]  # no length is left out


def test_extra_columns_stay(spark):
    df = documents(spark).selectExpr("*", "'a' as id", "1 as spans", "map('k', 1) as code", "'t' as `a.b`")
    assert pii.find(df).count() == len(DOCS)
    out = pii.redact(df)
    assert out.columns == df.columns and out.count() == len(DOCS) and {r["a.b"] for r in out.collect()} == {"t"}


# language


def synthetic(spark, n=240):
    rng = random.Random(2)
    letters = {"aa": "aeioubcd", "bb": "xyzwqkvj", "cc": "mnprstlg"}
    rows = []
    for i in range(n):
        lang = sorted(letters)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(3, 60))), lang, "s", None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language_of_held_out_rows(spark):
    df = synthetic(spark)
    model = lang_id.train(df.filter("doc_id % 5 <> 0"))
    rows = lang_id.predict(df.filter("doc_id % 5 = 0").withColumn("score", F.lit("x")).withColumn("lang_pred", F.lit(1)), model).join(df.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.95 and all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark):
    model = lang_id.train(documents(spark))
    rows = {r.doc_id: r for r in lang_id.predict(documents(spark), model).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {2, 3, 4, 9} and rows[6].lang_pred in ("en", "fr", "de")
    kept = lang_id.predict(documents(spark), model, whole_rows=True).select("row.*").toDF(*documents(spark).columns)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and kept.count() == len(DOCS)
    none = lang_id.train(documents(spark, []))
    assert {r.lang_pred for r in lang_id.predict(documents(spark), none).collect()} == {"und"}
    assert lang_id.predict(documents(spark, []), model).count() == 0


def plain_ridge(train, test, landmarks):
    """Scores of one-versus-rest ridge regression on Nystroem features, from sets of n-gram buckets and with no folded weights."""
    def grams(t):
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
        out = set()
        for p in range(1, lang_id.LENGTHS + 1):
            for k in range(len(b) - p + 1):
                code = int.from_bytes(b[k : k + p], "big") + (p << 24)
                out.add((code * 2654435761 % 2**32) >> 18)
        return out

    sets = [grams(t) for t, _ in train]
    kernel = lambda x, y: len(x & y) / max(1, len(x)) ** 0.5 / max(1, len(y)) ** 0.5
    marks = sets[:: max(1, len(sets) // landmarks)][:landmarks]
    inner = np.array([[kernel(x, y) for y in marks] for x in marks])
    values, vectors = np.linalg.eigh(inner)
    root = vectors / np.sqrt(values)  # all of the spectrum
    phi = np.array([[kernel(x, y) for y in marks] for x in sets]) @ root
    names = sorted({lang for _, lang in train})
    y = np.array([[1.0 if lang == n else -1.0 for n in names] for _, lang in train])
    weight = np.linalg.solve(phi.T @ phi + lang_id.RIDGE * len(train) * np.eye(phi.shape[1]), phi.T @ y)
    return names, np.array([[kernel(grams(t), m) for m in marks] for t in test]) @ root @ weight


def test_scores_equal_plain_kernel_ridge_regression():
    rng = random.Random(5)
    letters = {"aa": "aeioubcd", "bb": "xyzwqkvj", "cc": "mnpréstlg"}
    text = lambda lang: " ".join("".join(rng.choice(letters[lang] + "ou") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(1, 30)))
    train = [(text(lang), lang) for lang in sorted(letters) * 30]
    test = [text(lang).title() for lang in sorted(letters) * 20] + ["", "a"]

    def rows(texts):
        data = "".join(texts).encode()
        return lang_id.presence(np.frombuffer(data, np.uint8), np.cumsum([0, *(len(t.encode()) for t in texts)]))

    names, weight = lang_id.fit(np.packbits(rows([t for t, _ in train]), axis=1), [lang for _, lang in train], landmarks=20)
    x = rows(test)
    got = (x.astype(np.float32) @ weight) / np.sqrt(np.maximum(1, x.sum(1)))[:, None]
    want_names, want = plain_ridge(train, test, 20)
    assert names == want_names and got == pytest.approx(want, abs=1e-4)
    assert (got.argmax(1) == want.argmax(1))[:-2].all()


def test_languages_of_any_number_and_rows_in_any_layout(spark):
    df = synthetic(spark)
    one, other = lang_id.train(df.repartition(1)), lang_id.train(df.repartition(7, "text").union(df))  # copies count once
    assert one[0] == other[0] and np.allclose(one[1], other[1])
    model = (["aa", "bb"], np.zeros((lang_id.DIM, 2), np.float32))  # all scores tie
    assert {r.lang_pred for r in lang_id.predict(df, model).collect()} == {"aa"}


def test_presence_equals_sets():
    data = "abcab é".encode()
    x = lang_id.presence(np.frombuffer(data + b"zz", np.uint8), np.array([0, len(data), len(data) + 2, len(data) + 2]))
    bucket = lambda g: (int.from_bytes(g, "big") + (len(g) << 24)) * 2654435761 % 2**32 >> 18
    for row, text in zip(x, (data, b"zz", b""), strict=True):
        assert set(np.flatnonzero(row).tolist()) == {bucket(text[i : i + p]) for p in (1, 2, 3) for i in range(len(text) - p + 1)}


# pages


def test_crf_on_held_out_pages():
    crf = html_crf.train()
    pages = html_crf.labelled_pages(150, seed=77)
    right = sum(crf.decode(html_crf.features(html_crf.blocks(h))) == y for h, y in pages)
    assert right / len(pages) >= 0.95


def test_viterbi_equals_brute_force():
    import itertools

    rng = np.random.default_rng(0)
    crf = html_crf.Crf(rng.normal(size=len(html_crf._NAMES)), rng.normal(size=(2, 2)))
    for n in (0, 1, 5):
        rows = [sorted(rng.choice(len(html_crf._NAMES), 4, replace=False).tolist()) for _ in range(n)]
        value = lambda y, rows=rows: sum(sum(crf.weights[i] for i in f) for f, k in zip(rows, y, strict=True) if k) + sum(crf.moves[a][b] for a, b in itertools.pairwise(y))
        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert value(crf.decode(rows)) == pytest.approx(value(best))


def test_main_text(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a></li></ul></nav>
    <!-- ad --><div class="ad">Buy now.</div><article><h1>Head &amp; line</h1><p><b>One  two
    three.<br><p>Caf&eacute; &lt;3 a<i>b</i>c.</p></article><section id="comments"><p>First!</p></section><form><p>Mail</p><input></form><footer>&copy; me</footer>"""
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", "<"), (5, "u", "<article><p>" + "word " * 50000), (1, "u", page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_crf.extract(df).collect()
    texts = {r.page_id: r.text for r in got}
    assert len(got) == 6 and texts[1] == "Head & line\nOne two three.\nCafé <3 abc." and texts[2] == texts[3] == ""
    assert len(texts[5]) == 50000 * 5 - 1
    assert html_crf.extract(df.limit(0)).count() == 0


#: Pages written by hand in the manner of sites that the training pages don't know, with what a reader takes for the article.
PAGES = [
    (
        """<html><head><title>City Herald</title><link rel=stylesheet href=a.css></head><body><div id="top"><a href="/">Home</a> | <a href="/w">World</a> | <a href="/s">Sport</a></div>
        <div class="content"><h1>Bridge reopens after two years</h1><p>The old bridge over the river was reopened on Monday, two years after a flood had damaged its pillars and closed the road to the north.</p>
        <p>The mayor said that the work had cost less than planned, and that the second half of the repairs would begin in spring when the water is low.</p></div>
        <div class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten walks</a></li><li><a href="/2">Weather</a></li></ul></div><div id="footer">&copy; 2024 City Herald. <a href="/p">Privacy</a></div></body></html>""",
        ["Bridge reopens after two years", "The old bridge over the river was reopened on Monday, two years after a flood had damaged its pillars and closed the road to the north.", "The mayor said that the work had cost less than planned, and that the second half of the repairs would begin in spring when the water is low."],
    ),
    (
        """<!doctype html><body><header><nav><a href=/>Blog</a> <a href=/about>About</a></nav></header><main><article><h2>How I bake bread</h2><p>Mix the flour with water and let it rest for an hour before you add the salt &amp; the yeast; this makes the dough easier to fold.</p>
        <blockquote>Good bread takes its time, as my grandmother used to say whenever we stood hungry in her kitchen.</blockquote><ul><li>500 g flour, 350 g water, 10 g salt and a little yeast for the dough</li></ul></article></main>
        <section class="comments"><h3>3 comments</h3><p>Anna: Lovely, thanks!</p></section><aside><p>Subscribe to our newsletter</p></aside><script>track("x")</script><footer><p>Contact | Imprint</p></footer></body>""",
        ["How I bake bread", "Mix the flour with water and let it rest for an hour before you add the salt & the yeast; this makes the dough easier to fold.", "Good bread takes its time, as my grandmother used to say whenever we stood hungry in her kitchen.", "500 g flour, 350 g water, 10 g salt and a little yeast for the dough"],
    ),
    (
        """<html><body><div class="cookie-notice">We use cookies. <button>Accept</button></div><ul class="menu"><li><a href="/a">Products</a></li><li><a href="/b">Support</a></li></ul>
        <div class="post"><h1>Release notes</h1><p>This release mends the import of large tables, which could stop when a column held more than two billion characters in a single file.</p><p>It also makes the search faster for short words, since the index no longer reads segments that cannot change the result.</p></div>
        <div class="advert"><a href="/buy">Buy now and save 20%</a></div><form><label>Search</label><input name=q></form><div class="footer-links"><a href="/t">Terms</a></div></body></html>""",
        ["Release notes", "This release mends the import of large tables, which could stop when a column held more than two billion characters in a single file.", "It also makes the search faster for short words, since the index no longer reads segments that cannot change the result."],
    ),
]


def test_blocks_of_pages_labelled_by_hand(spark):
    df = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r.page_id: r.text.split("\n") for r in html_crf.extract(df).collect()}
    kept = wanted = right = 0
    for i, (_, want) in enumerate(PAGES):
        kept, wanted, right = kept + len(got[i]), wanted + len(want), right + len(set(want) & set(got[i]))
    assert right / wanted >= 0.9 and right / kept >= 0.9, got


# exact search


def brute_top(rows, k=20):
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for a, (i, q) in enumerate(good):
        if i % 20 == 0:
            found = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j) for b, (j, v) in enumerate(good) if b != a and len(v) == len(q))[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(found, 1)}
    return out


@pytest.mark.parametrize("block", [topk.BLOCK, 16])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "GROUP", 2)
    monkeypatch.setattr(topk, "RANGE", 3)
    rng = np.random.default_rng(0)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(90)]
    rows += [(i, rows[0][1]) for i in range(100, 140)] + [(200, None), (220, []), (240, [1.0, None] + [0.0] * 6), (260, [float("nan")] * 8), (None, rows[1][1]), (280, [1.0, 2.0]), (281, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash")).withColumn("id", F.lit(1))
    got = {tuple(r) for r in topk.exact_top_k(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == brute_top(rows)


def block_of(kind, n=6000, dim=24, seed=3):
    rng = np.random.default_rng(seed)
    if kind == "one":
        return np.full((n, dim), 3)
    x = rng.normal(size=(n, dim)) * 9
    if kind == "clustered":
        x += (rng.normal(size=(40, dim)) * 30)[rng.integers(0, 40, n)]
    if kind == "skewed":
        x = rng.standard_t(2, size=(n, dim)) * 5
    return np.floor(x * (1 << 23 if kind == "huge" else 1)).astype(np.int64)


@pytest.mark.parametrize("kind", ["plain", "clustered", "skewed", "huge", "one"])
def test_an_index_gives_the_exact_top(kind):
    vectors = block_of(kind)
    index, queries, k = topk.ImpactIndex.build(vectors), block_of(kind, 40, seed=4), 7
    exact = [[sum(int(a) * int(b) for a, b in zip(q, v, strict=True)) for v in vectors] for q in queries[:3]] if kind == "huge" else (queries @ vectors.T).tolist()
    queries = queries[: len(exact)]
    order = np.abs(index.impacts)
    assert (np.diff(order) <= 0).all() and index.checks[-1] == len(order)  # descending impact
    if kind == "huge":
        assert 1 << 55 < max(abs(x) for e in exact for x in e) < 1 << 63
    for floor in (None, np.array([sorted(e)[-k] for e in exact], float)):
        row, col, score = index.search(queries, np.array([5, *[-1] * (len(queries) - 1)]), k, floor)
        for j, e in enumerate(exact):
            best = sorted((-s, c) for c, s in enumerate(e) if j or c != 5)[:k]
            assert [(c, s) for c, s in zip(col[row == j].tolist(), score[row == j].tolist(), strict=True)][: len(best)] == [(c, -s) for s, c in best]


def test_processing_stops_on_proof_before_all_postings():
    vectors = block_of("clustered")
    index = topk.ImpactIndex.build(vectors)
    index.search(vectors[:64], np.arange(64), 10)
    assert 0 < index.read < 0.75 * index.postings
    # equal vectors: nothing can be ruled out, so nothing stops
    same = topk.ImpactIndex.build(block_of("one"))
    same.search(block_of("one", 4), np.full(4, -1), 10)
    assert same.read == same.postings
    # the proof holds at a check point: no vector outside its bounds
    for check, left in zip(index.checks, index.left, strict=True):
        acc = np.zeros(len(vectors))
        for s in range(check):
            ids = index.ids[index.ends[s - 1] if s else 0 : index.ends[s]]
            acc[ids] += index.impacts[s] * vectors[0, index.dims[s]]
        assert (np.abs(vectors @ vectors[0] - acc) <= left * np.linalg.norm(vectors[0]) + 1e-6).all()


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    some = spark.createDataFrame([(1, [1.0]), (2, [2.0])], df.schema)
    assert topk.exact_top_k(some, F.col("vec_id") % 20 == 0).count() == 0 and topk.exact_top_k(some, F.lit(True), k=0).count() == 0
    assert sorted(map(tuple, topk.exact_top_k(some, F.lit(True)).collect())) == [(1, 1, 2, 64 * 128), (2, 1, 1, 64 * 128)]


# mixing


def test_mixing_takes_columns_of_any_name_and_type(spark):
    df = documents(spark).selectExpr("*", "1 as slot", "2 as block", "'x' as place", "3 as _s", "4 as `a.b`", "map('k', doc_id) as m", "5 as s", "6 as row", "7 as Release")
    out = mixing.mix(df, block_rows=2)
    assert out.columns == [*df.columns, "block_", "release_", "deadline", "slot_", "place_"] and out.count() == len(DOCS)
    assert len({(r.slot_, r.place_) for r in out.select("slot_", "place_").collect()}) == len(DOCS)
    rows = mixing.mixed_rows(df)
    assert rows.schema == df.schema and rows.count() == len(DOCS)


def test_rows_of_one_id_or_none_are_dealt_out(spark):
    rows = [(None if i % 2 else 7, f"text {i}", None, "s", None) for i in range(400)]
    out = mixing.mix(documents(spark, rows), block_rows=4).collect()
    assert len(out) == 400 and sorted({r.block for r in out}) == list(range(100)) and len({r.text for r in out}) == 400


def test_lag_stays_under_one_block():
    share = mixing.shares({"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05, "e": 1e-9}, 512)
    total = sum(share.values())
    plan = mixing.period(share)
    assert len(plan) == total and all(r <= t < d for _, _, r, d, t in plan)
    got = dict.fromkeys(share, 0)
    for s, i, _, _, t in plan:
        assert i == got[s]
        got[s] += 1
        assert all(abs(got[x] - share[x] * (t + 1) / total) < 1 for x in share)
    assert got == share


def test_mixing_keeps_rows_and_blocks(spark):
    rows = [(i, None, None, "hot" if i % 3 else None if i % 2 else f"s{i % 4}", None) for i in range(900)] + [(5, None, None, "hot", None)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mix(df, block_rows=7).collect()
    assert sorted((r.doc_id for r in out)) == sorted(r[0] for r in rows)
    sizes = {}
    for r in out:
        assert r.release <= r.slot < r.deadline
        sizes.setdefault((r.source, r.block), []).append(r.place)
    assert all(sorted(p) == list(range(len(p))) and len(p) <= 7 for p in sizes.values())
    assert len({r.slot for r in out}) == len(sizes)
    for s in {r.source for r in out}:
        blocks = sorted(b for x, b in sizes if x == s)
        assert blocks == list(range(len(blocks))) and all(len(sizes[s, b]) == 7 for b in blocks[:-1])
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark), {"a": 1.0, "b": 2.0}).count() == len(DOCS)



@pytest.mark.parametrize("n,blocks", [(20, 130_000), (2100, 30_000)])
def test_lag_to_exact_weights_stays_under_one_block(n, blocks):
    sizes = [blocks // 3] + [2 * blocks // 3 // (n - 1)] * (n - 1)
    weights = mixing.whole([(32.0 * x) ** 0.7 for x in sizes])
    got, total, first = np.zeros(n), sum(weights), 0
    exact = np.array([w / total for w in weights])
    for t, (k, i, release, due, slot) in enumerate(mixing.Schedule(weights, sizes)):
        if got[k] == sizes[k] or slot != t:
            break  # a source has run out
        assert i == got[k] and release <= slot < due
        got[k] += 1
        first = t + 1
        if t % 97 == 0:
            assert np.abs(got - exact * first).max() < 1 + 1e-6
    assert first > blocks // 2


def test_mixing_follows_the_weights_and_not_a_rounded_period(spark):
    rows = [(i, "abc"[i % 3]) for i in range(900)]
    weights = {"a": 0.6180339, "b": 0.3, "c": 0.0819661}
    a, b, c = mixing.whole(list(weights.values()))
    share = {"a": a, "b": b, "c": c}
    total = a + b + c
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights, block_rows=2, slots=16).collect()
    assert len(out) == 900 and len({r.slot for r in out}) == 450
    for r in out:
        assert r.release == r.block * total // share[r.source] and r.deadline == -(-(r.block + 1) * total // share[r.source]) and r.release <= r.slot < r.deadline
    few = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), {"a": 1.0, "b": 1e-9, "c": 0.0}, block_rows=2).collect()
    assert len(few) == 900 and all(r.release <= r.slot < r.deadline for r in few)
