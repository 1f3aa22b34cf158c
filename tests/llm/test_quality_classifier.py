import random
import zlib

from spanledger.llm.quality import QualityParams, keep_quality, score_quality

FAST = QualityParams(buckets=1 << 12, sample_docs=300, rounds=3, workers=2)


def corpus(n=240):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = [f"w{rng.randint(0, 60)}" + rng.choice(["###", "$$$", "!!"]) * bad for _ in range(60)]
        rows.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, int(not bad), 0))
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, predicted int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_and_holds_out(spark):
    rows, labels = corpus()
    odd = [(900, None, "x", "s", 1), (901, "", "x", "s", 1), (None, "w1 w2", "x", "s", 1), (902, "w1 " * 60000, "x", "s", 1), (902, "w1 " * 60000, "x", "s", 1)]
    docs, known = frames(spark, rows + odd, labels + [(900, None, 0), (None, 1, 0), (5, 1, 0), (7, 3, 0)])
    got = score_quality(docs, known, FAST).collect()
    assert len(got) == len(rows) + len(odd)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    right = [r.predicted == int(r.doc_id % 4 != 0) for r in got if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert len(right) > 20 and sum(right) / len(right) > 0.95
    assert len({r.score for r in got if r.doc_id in (900, 901)}) == 1

    # repeated labelled rows are learned from once
    twice, _ = frames(spark, rows + rows[:50] * 3, [])
    once = {r.doc_id: r.score for r in score_quality(frames(spark, rows, [])[0], known, FAST).collect()}
    assert {r.doc_id: r.score for r in score_quality(twice, known, FAST).collect()} == once

    # labels of the held-out fold change nothing
    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q, 0) for k, q, _ in labels]
    again = score_quality(docs, frames(spark, rows, flipped)[1], FAST).collect()
    first = score_quality(docs, frames(spark, rows, labels)[1], FAST).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, first))

    kept = keep_quality(docs, known, FAST)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(r.doc_id) for r in got if r.predicted)


def test_nothing_to_learn_from(spark):
    docs, known = frames(spark, corpus(8)[0], [])
    assert {(r.score, r.predicted) for r in score_quality(docs, known, FAST).collect()} == {(0.5, 1)}
    assert score_quality(docs.limit(0), known, FAST).count() == 0
