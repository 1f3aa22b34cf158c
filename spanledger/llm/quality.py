"""Quality of texts by supervised subword embeddings."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import WordCache, map_rows, texts
from spanledger.session import scratch_path


@dataclass(frozen=True)
class QualityParams:
    """``sample_docs``: the most labelled documents to learn from, those with the smallest hash of their id.
    ``folds``/``held_fold``: rows whose crc32(doc_id) mod ``folds`` is ``held_fold`` are never learned from."""

    buckets: int = 1 << 16
    dimensions: int = 8
    grams: tuple[int, ...] = (3, 4)
    sample_docs: int = 6000
    rounds: int = 8
    workers: int = 6
    rate: float = 0.08
    folds: int = 5
    held_fold: int = 0
    threshold: float = 0.3


@dataclass
class QualityModel:
    """``weights``: what each hashed feature adds to the log odds of label 1, before averaging."""

    params: QualityParams
    weights: np.ndarray
    bias: float


#: Parts of the weights that are averaged apart.
_CHUNKS = 16
#: Stands for a word pair of twice the same word.
REPEAT = "\x01again\x01"


def repeats(words: list[str]) -> int:
    return sum(map(eq, words, islice(words, 1, None)))


def word_features(word: str, params: QualityParams) -> list[int]:
    """Buckets of a word and of its character n-grams, with marks at both ends."""
    marked = f"<{word}>".encode()
    found = [zlib.crc32(marked)]
    for size in params.grams:
        found += [zlib.crc32(marked[at : at + size], size) for at in range(len(marked) - size + 1)]
    mask = params.buckets - 1
    return [f & mask for f in found]


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """crc32 of the id as text falls into ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def _featured(docs: DataFrame, labels: DataFrame, params: QualityParams) -> DataFrame:
    """Distinct features of each sampled labelled document (once, however often its rows repeat; of several texts the smallest) and
    how often they occur."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .filter(~held_out("doc_id", params.folds, params.held_fold))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(params.sample_docs)
    )
    # at most sample_docs pairs of numbers
    found = texts(docs).join(F.broadcast(known), "doc_id")
    sampled = found.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def rows(batches):
        for batch in batches:
            features = WordCache(lambda w: word_features(w, params))
            for doc_id, quality, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts: Counter = Counter()
                words = text.split()
                for word, times in [*Counter(words).items(), (REPEAT, repeats(words))]:
                    for f in features[word]:
                        counts[f] += times
                counts = +counts
                ids = np.fromiter(counts.keys(), "<u4", len(counts))
                times = np.fromiter(counts.values(), "<u4", len(counts))
                yield doc_id, quality, ids.tobytes(), times.tobytes()

    return map_rows(sampled, rows, "doc_id bigint, quality bigint, ids binary, times binary")


def _dealt(featured: DataFrame, workers: int) -> list[DataFrame]:
    """The shares of the sample, each stored apart and read as one partition, so that rounds shuffle no documents."""
    spark, path = featured.sparkSession, scratch_path(featured.sparkSession, "featured")
    shares = featured.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(workers)).cast("int"))
    shares.repartition(workers, "share").write.partitionBy("share").parquet(path)
    stored = spark.read.schema(shares.schema).parquet(path)
    return [stored.filter(F.col("share") == k).coalesce(1) for k in range(workers)]


def _train_part(docs: list[tuple[int, np.ndarray, np.ndarray]], start, params: QualityParams, seed: int):
    """One pass of stochastic gradient steps over a worker's documents, in a seeded order."""
    vectors, squares, out, bias = (x.copy() for x in start)
    out_squares, bias_square = np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    for k in np.random.default_rng(seed).permutation(len(docs)):
        label, ids, shares = docs[k]
        mean = shares @ vectors[ids] if len(ids) else np.zeros(params.dimensions, np.float32)
        scores = mean @ out + bias
        chances = np.exp(scores - scores.max())
        chances /= chances.sum()
        chances[label] -= 1
        if len(ids):
            step = shares[:, None] * (out @ chances)[None, :]
            squares[ids] += step * step
            vectors[ids] -= params.rate * step / np.sqrt(squares[ids])
        step = np.outer(mean, chances)
        out_squares += step * step
        out -= params.rate * step / np.sqrt(out_squares)
        bias_square += chances * chances
        bias -= params.rate * chances / np.sqrt(bias_square)
    return vectors, squares, out, bias


def _learner(sent, params: QualityParams, turn: int, share: int):
    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs = []
        for frame in frames:
            for doc_id, quality, ids, times in zip(frame.doc_id, frame.quality, frame.ids, frame.times):
                counts = np.frombuffer(times, "<u4").astype(np.float32)
                docs.append((int(doc_id), int(quality), np.frombuffer(ids, "<u4"), counts / max(1.0, counts.sum())))
        if docs:
            docs.sort(key=lambda d: d[0])
            new = _train_part([d[1:] for d in docs], sent.value, params, turn)
            parts = np.array_split(np.concatenate([x.ravel() for x in new]), _CHUNKS)
            yield pd.DataFrame({"chunk": range(_CHUNKS), "share": share, "n": len(docs), "state": [x.tobytes() for x in parts]})

    return learn


def _averaged(frame: pd.DataFrame) -> pd.DataFrame:
    """The mean of the workers' states of one chunk, by numbers of documents."""
    frame = frame.sort_values("share")
    total = frame.n.sum()
    mean = sum(np.frombuffer(x, np.float32).astype(np.float64) * (n / total) for x, n in zip(frame.state, frame.n))
    return pd.DataFrame({"chunk": [frame.chunk.iloc[0]], "state": [mean.astype(np.float32).tobytes()]})


def train_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> QualityModel:
    """Hashed vectors of words, their character n-grams and repeated-word pairs, averaged per document, softmax output.

    Each round, every worker takes stochastic gradient steps over its share of the sample from the same start, and the
    results are averaged chunk by chunk on the executors, with the numbers of documents as weights; one model of fixed size comes to
    the driver.
    Without labelled documents the model scores every text 0.5.
    """
    spark = docs.sparkSession
    dealt = _dealt(_featured(docs, labels, params), params.workers)
    rng = np.random.default_rng(7)
    shape = (params.buckets, params.dimensions)
    state = (
        rng.normal(0, 0.1, shape).astype(np.float32), np.full(shape, 1e-10, np.float32),
        rng.normal(0, 0.1, (params.dimensions, 2)).astype(np.float32), np.zeros(2, np.float32),
    )
    for turn in range(params.rounds):
        sent = spark.sparkContext.broadcast(state)
        learned = [
            own.mapInPandas(_learner(sent, params, turn, share), "chunk long, share long, n long, state binary")
            for share, own in enumerate(dealt)
        ]
        parts = reduce(DataFrame.unionAll, learned)
        found = parts.groupBy("chunk").applyInPandas(_averaged, "chunk long, state binary").collect()
        sent.destroy()
        if not found:
            return QualityModel(params, np.zeros(params.buckets), 0.0)
        mean = np.concatenate([np.frombuffer(r.state, np.float32) for r in sorted(found, key=lambda r: r.chunk)])
        cuts = np.cumsum([x.size for x in state])[:-1]
        state = tuple(x.reshape(s.shape) for x, s in zip(np.split(mean, cuts), state))
    vectors, _, out, bias = state
    return QualityModel(params, (vectors @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def quality_score(model: QualityModel, text: Column) -> Column:
    """Chance of label 1, from 0 to 1, of whole texts. A null or empty text gets the chance without evidence."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, params = model.weights.tolist(), model.params

        def value(word: str) -> complex:
            found = word_features(word, params)
            return complex(sum(weights[f] for f in found), len(found))

        cached = WordCache(value).__getitem__
        for part in parts:
            odds = []
            for text in part:
                words = text.split()
                both = sum(map(cached, words), 0j) + repeats(words) * cached(REPEAT)
                odds.append(model.bias + (both.real / both.imag if both.imag else 0.0))
            yield pd.Series(1.0 / (1.0 + np.exp(-np.clip(np.array(odds, float), -500, 500))))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def score_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Labels, language, source and ids are no inputs of the score: equal texts get equal scores. Null and empty texts get the
    score without evidence; a null id is never held out; repeated rows give repeated rows; several labels of one document count as
    the lowest, repeated rows are learned from once; labels other than 0 and 1 are ignored; an empty table gives an empty one.
    """
    model = train_quality(docs, labels, params)
    return (
        texts(docs)
        .select("doc_id", held_out("doc_id", params.folds, params.held_fold).alias("held_out"),
                quality_score(model, F.col("text")).alias("score"))
        .withColumn("predicted", F.when(F.col("score") >= params.threshold, 1).otherwise(0))
    )


def keep_quality(docs: DataFrame, labels: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns, which are not touched. Null and empty texts score
    as a text without evidence; repeated rows are kept or dropped alike; an empty table gives an empty one."""
    model = train_quality(docs, labels, params)
    return docs.filter(quality_score(model, F.col("text")) >= params.threshold)
