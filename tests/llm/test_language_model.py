import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spanledger.llm import language_model
from spanledger.llm.language_model import ClassModel, LmParams, Vocabulary, score_texts, train_classes

SMALL = LmParams(head_words=25, model_words=12, neighbours=6, clusters=2, bins=2, buckets=256, batch=64)


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def base(rows):
    counts = Counter()
    for doc_id, text in rows:
        if not held(doc_id):
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for doc_id, text in rows:
        own = tokens(text)
        score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        yield doc_id, held(doc_id), len(own), sum(counts[t] > 0 for t in own), total, score


def documents():
    rng = random.Random(6)
    rows = []
    for k in range(120):  # two languages, each word followed by one of few
        own = [f"{'ab'[k % 2]}{n}" for n in range(20)]
        at, words = 0, []
        for _ in range(60):
            at = (at * 3 + rng.choice([1, 1, 1, 7])) % 20
            words.append(own[at])
        rows.append((k, " ".join(words)))
    rows += [(200, None), (201, ""), (None, "A0 a1\tb2"), (203, "unseen1 unseen2 unseen1"), (204, "É é a0"), (205, "a0 " * 30000)]
    return rows + rows[:2]


@pytest.mark.parametrize("params", [SMALL, LmParams(buckets=1024)])
def test_base_counts_and_gain(spark, params):
    rows = documents()
    docs = spark.createDataFrame([(a, b, 1.0) for a, b in rows], "doc_id long, text string, score double")
    got = sorted((tuple(r) for r in score_texts(docs, params).collect()), key=repr)
    want = sorted(base(rows), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0
    plain = [g for g in got if g[1] and g[0] is not None and g[0] < 120]
    assert len(plain) > 10
    assert sum(g[6] for g in plain) > sum(g[5] for g in plain) + 0.1 * sum(g[2] for g in plain)


def test_chances_sum_to_one():
    rng = np.random.default_rng(1)
    params = SMALL
    counts = np.sort(rng.integers(1, 50, 10))[::-1].astype(np.int64)
    vocabulary = Vocabulary({}, counts, 8, int(counts.sum()) + 30, 15)
    classes = rng.integers(0, 4, 8)
    classes[0] = 4
    shares = np.bincount(classes, counts[:8], minlength=6)
    within = np.log10(counts[:8] / shares[classes])
    model = ClassModel(params, classes, rng.normal(0, 1, (256, 6)).astype(np.float32), rng.normal(0, 1, 6).astype(np.float32), within)
    used = np.flatnonzero(shares > 0)
    for history in ([], [3], [7, 65535], [1, 2]):
        found = 0.0
        for word in [*range(8), 65535]:
            ids = np.array([*history, word], np.int64)
            found += 10 ** model.scores(ids, np.array([0]))[-1]
        # classes without a word keep their share
        empty = [k for k in range(5) if k not in used]
        assert found <= 1 + 1e-6 and (empty or found == pytest.approx(1, abs=1e-5))
    rare = sum(10 ** vocabulary.rare(np.array([n])) for n in [counts[8], counts[9], *[0] * 0])
    others = vocabulary.rare_distinct - 2
    left = vocabulary.rare_tokens - counts[8] - counts[9]
    rest = (left + 0.5 * others + 0.5) / (vocabulary.rare_tokens + 0.5 * (vocabulary.rare_distinct + 1))
    assert float(rare[0]) + rest == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert score_texts(docs, SMALL).count() == 0
    only_held = [k for k in range(100) if held(k)][:3]
    rows = [(k, "a b") for k in only_held]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in got)


def test_every_round_is_a_pass_over_all_tokens(spark):
    assert (LmParams().clusters * LmParams().bins + 2, LmParams().rounds) == (66, 3)
    params = LmParams(head_words=25, model_words=12, neighbours=6, clusters=2, bins=2, buckets=256, batch=64)
    ids = np.random.default_rng(3).integers(0, 12, 300)
    counts = np.sort(np.bincount(ids, minlength=12))[::-1].astype(np.int64)
    vocabulary = Vocabulary({}, counts, 12, int(counts.sum()), 12)
    encoded = spark.createDataFrame([(0, ids.astype("<u2").tobytes())], "row long, ids binary")
    got = train_classes(encoded, vocabulary, params, 1)
    want = ClassModel(params, got.classes, np.zeros_like(got.weights), got.bias, got.within)
    for _ in range(params.rounds):
        weights = want.weights.copy()
        language_model._update(want, weights, np.ones(len(weights), np.float32), ids, np.array([0]))
        want.weights = weights
    assert np.abs(got.weights).max() > 0 and np.allclose(got.weights, want.weights, atol=1e-5)


def test_sums_of_groups():
    rng = np.random.default_rng(2)
    for keys in (rng.integers(0, 40, 3000), rng.zipf(1.3, 2000) % 500, np.zeros(100, int), np.arange(50), np.array([7])):
        values = rng.normal(0, 1, (len(keys), 5)).astype(np.float32)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.r_[True, keys[order][1:] != keys[order][:-1]])
        by, sums = language_model._group_sums(values, order, first)
        assert sorted(by) == list(range(len(first)))
        for k, total in zip(keys[order][first[by]], sums):
            assert np.allclose(total, values[keys == k].sum(axis=0), atol=1e-3)


def test_odds_once_for_equal_histories_and_steps_for_all_tokens(monkeypatch):
    params = LmParams(clusters=2, bins=2, buckets=64, batch=500)
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 5, 1700)
    starts = np.array([0, 3, 4, 900])
    model = ClassModel(
        params, rng.integers(0, 4, 5), rng.normal(0, 1, (64, 6)).astype(np.float32), rng.normal(0, 1, 6).astype(np.float32), np.zeros(5)
    )
    want, past = model.weights.astype(np.float64), np.ones(64)
    features, wanted, worked = language_model._features(ids, starts, 64), model.class_of(ids), []
    for at in range(0, len(ids), params.batch):
        cut = slice(at, at + params.batch)
        odds = sum(want[f[cut]] for f in features) + model.bias
        slopes = np.exp(odds) / np.exp(odds).sum(axis=1, keepdims=True)
        slopes[np.arange(len(slopes)), wanted[cut]] -= 1
        for f in features:
            step = np.zeros_like(want)
            np.add.at(step, f[cut], slopes)
            past += (step**2).sum(axis=1)
            want -= step * (params.rate / np.sqrt(past))[:, None]
    plain = language_model._odds

    def counted(weights, bias, used, *rooms):
        worked.append(len(used[0]))
        return plain(weights, bias, used, *rooms)

    monkeypatch.setattr(language_model, "_odds", counted)
    got, squares = model.weights.copy(), np.ones(64, np.float32)
    language_model._update(model, got, squares, ids, starts)
    assert np.allclose(got, want, atol=1e-3) and np.allclose(squares, past, rtol=1e-3)
    assert sum(worked) <= 4 * 40  # at most 36 histories in each of 4 batches, not 1,700 tokens


def test_scores_of_more_histories_than_a_part():
    params = LmParams(clusters=2, bins=2, buckets=1024, batch=5000)
    rng = np.random.default_rng(7)
    ids, starts = rng.integers(0, 60, 12_000), np.array([0, 1, 7000])
    shape = (1024, 6)
    model = ClassModel(params, rng.integers(0, 4, 60), rng.normal(0, 1, shape).astype(np.float32), np.zeros(6, np.float32), -rng.random(60))
    odds = sum(model.weights[f].astype(np.float64) for f in language_model._features(ids, starts, 1024))
    want = odds[np.arange(len(ids)), model.classes[ids]] - np.log(np.exp(odds).sum(axis=1))
    assert np.allclose(model.scores(ids, starts), want / np.log(10) + model.within[ids], atol=1e-4)


def test_tokens_of_odd_texts(monkeypatch):
    texts = ["", " ", "\t a  B\n", "b", "A\x0bÉ\x1cx\x85 É\x0c\r", "a " * 50, "İ\xa0z"]
    for column in (pa.array(texts), pa.array(["cut", *texts, "off"]).slice(1, len(texts)), pa.array(["a b", "c"]), pa.array([], pa.string())):
        found, places, sizes = language_model.distinct_tokens(column)
        assert len(set(found.to_pylist())) == len(found)
        want = [tokens(text) for text in column.to_pylist()]
        assert [found[k].as_py() for k in places] == [t for own in want for t in own] and sizes.tolist() == [len(own) for own in want]
    monkeypatch.setattr(language_model, "_SLICE_BYTES", 4)
    batches = [pa.record_batch([pa.array(texts)], names=["text"]), pa.record_batch([pa.array([], pa.string())], names=["text"])]
    cut = [batch.column(0).to_pylist() for batch in language_model._sliced(batches, 0)]
    assert [text for own in cut for text in own] == texts and len(cut) > 3
