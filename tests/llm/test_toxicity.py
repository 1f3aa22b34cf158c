import random
import zlib

import numpy as np

from spanledger.llm.toxicity import BINS, LEAST_GAIN, Gains, ToxicityParams, compressor, score_toxicity, train_toxicity, window_features, windows

FAST = ToxicityParams(sample_docs=200, least_z=3.0, ordinary_bytes=4096, toxic_bytes=1024)
SLURS = ["blorgface", "snarlwitted", "grubbersome", "mudbrained"]


def corpus(n=400):
    rng = random.Random(4)
    syllables = ["ka", "to", "mi", "re", "su", "lan", "dor", "ve", "ish", "un"]
    rows, labels = [], []
    for k in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(20, 120))]
        bad = k % 4 == 0
        for _ in range(4 * bad):
            words[rng.randrange(len(words))] = rng.choice(SLURS)
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 1, int(bad)))
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, predicted int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_catches_held_out_toxic_texts(spark):
    rows, labels = corpus()
    long_text = "Kato mire " * 30000
    odd = [(900, None, "x", "s", 1), (901, "", "x", "s", 1), (None, rows[0][1], "x", "s", 1), (902, long_text, "x", "s", 1), (902, long_text, "x", "s", 1)]
    docs, known = frames(spark, rows + odd, labels + [(900, None, None), (None, 1, 1), (5, 1, 0), (7, 1, 3)])
    got = score_toxicity(docs, known, FAST).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = [r for r in got if r.held_out and r.doc_id < 400]
    bad = [r.predicted for r in held if r.doc_id % 4 == 0]
    good = [r.predicted for r in held if r.doc_id % 4]
    assert len(bad) > 10 and sum(bad) / len(bad) >= 0.9 and sum(good) / len(good) <= 0.05
    # equal texts, equal scores; empty ones too
    assert len({r.score for r in got if r.doc_id in (0, None)}) == 1
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1

    # labels of the held-out fold change nothing
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, q, t in labels]
    again = score_toxicity(docs, frames(spark, rows, flipped)[1], FAST).collect()
    first = score_toxicity(docs, frames(spark, rows, labels)[1], FAST).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, first))


def test_gains_against_plain_compression(spark):
    docs, known = frames(spark, *corpus())
    model = train_toxicity(docs, known, FAST)
    assert model.toxic.endswith(model.ordinary)
    ordinary, toxic = compressor(model.ordinary), compressor(model.toxic)
    text = "Kato blorgface mire " * 50 + "lan"
    want = [0] * BINS
    cut = [" ".join(text.lower().split()[at : at + 16]) for at in range(0, 151, 16)]
    assert list(windows(text, 16)) == [f" {w} ".encode() for w in cut]
    for w in cut:
        gain = len(ordinary(f" {w} ".encode())) - len(toxic(f" {w} ".encode()))
        want[min(max(gain, LEAST_GAIN), LEAST_GAIN + BINS - 1) - LEAST_GAIN] += 1
    assert Gains(model)(text) == want and sum(want) == 10


def test_features_of_bins():
    counts = np.zeros((2, BINS))
    counts[0, [0 - LEAST_GAIN, 3 - LEAST_GAIN, 5 - LEAST_GAIN]] = [7, 2, 2]
    ratio = np.arange(BINS) / 10
    x = window_features(counts, ratio)
    listed = [0] * 7 + [3] * 2 + [5] * 2
    assert np.isclose(x[0, 0], sum(ratio[g - LEAST_GAIN] for g in listed))
    assert np.isclose(x[0, 2], 5 + 5 + 3) and np.isclose(x[0, 1], ratio[[13, 13, 11]].sum())
    assert np.isclose(x[0, 3], sum(listed) / 11) and np.isclose(x[0, 4], np.log(12))
    assert np.allclose(x[0, 5:8], np.log1p([4, 2, 0])) and np.allclose(x[0, 8:], [4 / 11, 2 / 11, 0])
    assert np.allclose(x[1], 0)


def test_nothing_to_learn_from(spark):
    rows, labels = corpus(12)
    docs, none = frames(spark, rows, [])
    assert {(r.score, r.predicted) for r in score_toxicity(docs, none, FAST).collect()} == {(0.5, 1)}
    assert score_toxicity(docs.limit(0), none, FAST).count() == 0
    clean = frames(spark, rows, [(k, 1, 0) for k in range(12)])[1]
    assert {(r.score, r.predicted) for r in score_toxicity(docs, clean, FAST).collect()} == {(0.0, 0)}
    # one labelled document of each class: too few samples to train a dictionary on
    few = frames(spark, rows, [(0, 1, 1), (1, 1, 0)])[1]
    assert all(0 <= r.score <= 1 for r in score_toxicity(docs, few, FAST).collect())
