"""Toxicity of texts by compression distance to two zstandard dictionaries."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import map_rows, texts
from spanledger.llm.quality import held_out
from spanledger.session import materialize


@dataclass(frozen=True)
class ToxicityParams:
    """``sample_docs``: the most labelled documents of each class to learn from, those with the smallest hash of their id.
    ``dictionary_share``: percent of them that make the dictionaries; the others calibrate. ``window_words``: words of a window.
    ``least_z``: how far (standard scores of document counts) the start of a word must lean to toxic texts for its words to be
    samples of the toxic dictionary; ``most_stems`` and ``doc_words`` bound these samples. ``doc_windows``: windows of one ordinary
    text that are samples of the ordinary dictionary. ``folds``/``held_fold``: rows whose crc32(doc_id) mod ``folds`` is
    ``held_fold`` are never learned from."""

    sample_docs: int = 3000
    dictionary_share: int = 60
    window_words: int = 16
    least_z: float = 7.0
    most_stems: int = 4000
    doc_words: int = 200
    doc_windows: int = 24
    ordinary_bytes: int = 32 << 10
    toxic_bytes: int = 2 << 10
    folds: int = 4
    held_fold: int = 2
    threshold: float = 0.3


#: Bins of the bytes a window gains by the toxic dictionary: from -8 to 15, beyond that the outermost.
LEAST_GAIN, BINS = -8, 24


@dataclass
class ToxicityModel:
    """``ordinary``/``toxic``: contents of the two dictionaries, the latter ending with the former, so that ordinary words cost the
    same in both. ``ratio``: log likelihood ratio of each bin of gains. ``mean``/``spread``/``weights``: logistic calibration of
    ``window_features``; ``prior`` is the score where there is nothing to calibrate with."""

    params: ToxicityParams
    ordinary: bytes
    toxic: bytes
    ratio: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None
    prior: float


def windows(text: str, words: int) -> Iterable[bytes]:
    """The whole text in lower case, cut into runs of ``words`` words."""
    found = text.lower().split()
    for at in range(0, len(found), words):
        yield f" {' '.join(found[at : at + words])} ".encode()


def stems(word: str) -> set[str]:
    """The word and its starts, with a blank where the word begins or ends."""
    marked = f" {word} "
    return {marked[:size] for size in range(4, min(len(marked), 9) + 1)} | {marked}


def compressor(content: bytes):
    """Compresses a window with a dictionary of this content; frames carry no sizes or sums."""
    settings = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=4, target_length=64,
        strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
    )
    if not content:
        return zstandard.ZstdCompressor(compression_params=settings).compress
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings).compress


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; too few samples to train on are the dictionary themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=24, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].rjust(8) if samples else b""


class Gains:
    """For a text, how many windows gain how many bytes by the toxic dictionary: one count for each bin."""

    def __init__(self, model: ToxicityModel):
        self.words = model.params.window_words
        self.ordinary, self.toxic = compressor(model.ordinary), compressor(model.toxic)

    def __call__(self, text: str) -> list[int]:
        counts = [0] * BINS
        for window in windows(text, self.words):
            gain = len(self.ordinary(window)) - len(self.toxic(window)) - LEAST_GAIN
            counts[min(max(gain, 0), BINS - 1)] += 1
        return counts


def window_features(counts: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """What the calibration sees of each row of bin counts: sums and means of gains and their likelihood ratios, the three best
    windows, and windows above three limits as counts and shares."""
    gains = np.arange(BINS) + LEAST_GAIN
    total = counts.sum(axis=1)
    least = np.maximum(total, 1)
    # of the bins in falling order, what the three best windows take
    above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
    best = np.minimum(above, 3) - np.minimum(above - counts, 3)
    over = np.stack([counts[:, gains >= limit].sum(axis=1) for limit in (2, 4, 6)], axis=1)
    return np.column_stack([
        np.clip(counts @ ratio, -50, 50), best @ ratio, best @ gains, (counts @ gains) / least, np.log1p(total),
        np.log1p(over), over / least[:, None],
    ])


def _labelled(docs: DataFrame, labels: DataFrame, params: ToxicityParams) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text, toxic, trains of the sampled documents, and the number of labelled documents of each class."""
    known = materialize(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .filter(~held_out("doc_id", params.folds, params.held_fold))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic")),
        "toxic-labels",
    )
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    parts = [known.filter(F.col("toxic") == c).orderBy(order, "doc_id").limit(params.sample_docs) for c in (0, 1)]
    trains = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(100)) < params.dictionary_share
    # at most 2 * sample_docs pairs of numbers
    chosen = F.broadcast(parts[0].unionAll(parts[1]).withColumn("trains", trains))
    found = texts(docs).join(chosen, "doc_id").groupBy("doc_id", "toxic", "trains").agg(F.min("text").alias("text"))
    return materialize(found, "toxic-sample"), sizes


def _telling_stems(sample: DataFrame, params: ToxicityParams) -> set[str]:
    """Starts of words that lean to toxic documents by a two-sample test of shares, the strongest ``most_stems``."""
    trains = sample.filter("trains")
    # two rows
    sizes = {r.toxic: r["count"] for r in trains.groupBy("toxic").count().collect()}
    na, nb = sizes.get(1, 0), sizes.get(0, 0)
    if not na or not nb:
        return set()

    def rows(batches):
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                yield from ((s, toxic, 1 - toxic) for s in set().union(*map(stems, set(text.lower().split()))))

    counts = (
        map_rows(trains.select("toxic", "text"), rows, "stem string, toxic bigint, ordinary bigint")
        .groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum("ordinary").alias("b")).filter("a >= 3")
    )
    share = (F.col("a") + F.col("b")) / (na + nb)
    z = (F.col("a") - na * share) / F.sqrt(share * (1 - share) * (na * nb / (na + nb)) + 1e-9)
    strong = counts.withColumn("z", z).filter(F.col("z") >= params.least_z).orderBy(F.desc("z"), "stem").limit(params.most_stems)
    return {r.stem for r in strong.select("stem").collect()}


def _samples(sample: DataFrame, telling: set[str], params: ToxicityParams) -> tuple[list[bytes], list[bytes]]:
    """Dictionary samples: windows of ordinary texts, spread over each text; of each toxic text its telling words."""

    def rows(batches):
        for batch in batches:
            for doc_id, toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                if toxic:
                    words = (w for w in dict.fromkeys(text.lower().split()) if not telling.isdisjoint(stems(w)))
                    kept = [f" {' '.join(islice(words, params.doc_words))} ".encode()]
                else:
                    found = list(windows(text, params.window_words))
                    kept = found[:: max(1, -(-len(found) // params.doc_windows))]
                yield from ((doc_id, toxic, w[:2048]) for w in kept if w.strip())

    columns = sample.filter("trains").select("doc_id", "toxic", "text")
    # bounded by the parameters: sample_docs * doc_windows windows and sample_docs lists of doc_words words
    found = map_rows(columns, rows, "doc_id bigint, toxic bigint, sample binary").collect()
    found.sort()
    return [bytes(r.sample) for r in found if not r.toxic], [bytes(r.sample) for r in found if r.toxic]


def bin_counts(docs: DataFrame, model: ToxicityModel, keep: str) -> DataFrame:
    """Column ``keep`` and the bin counts of ``text``."""

    def rows(batches):
        gains = Gains(model)
        for batch in batches:
            for kept, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                yield kept, gains(text.as_py())

    kind = docs.schema[keep].dataType.simpleString()
    return map_rows(docs.select(keep, "text"), rows, f"{keep} {kind}, counts array<bigint>")


def _calibrated(model: ToxicityModel, toxic: np.ndarray, counts: np.ndarray, sizes: dict[int, int]) -> None:
    """Sets likelihood ratios and the logistic weights; classes weigh as they are among all labelled documents."""
    shares = [counts[toxic == c].sum(axis=0) + 0.5 for c in (0, 1)]
    model.ratio = np.log(shares[1] / shares[1].sum()) - np.log(shares[0] / shares[0].sum())
    x = window_features(counts, model.ratio)
    model.mean, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.column_stack([(x - model.mean) / model.spread, np.ones(len(x))])
    weigh = np.where(toxic == 1, sizes[1] / (toxic == 1).sum(), sizes[0] / (toxic == 0).sum())
    weigh = weigh * len(x) / weigh.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (weigh * (toxic - chance)) - weights
        curve = (x * (weigh * chance * (1 - chance))[:, None]).T @ x + np.eye(len(weights))
        weights = weights + np.linalg.solve(curve, slope)
    model.weights = weights


def train_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """One dictionary trained on ordinary texts, one on toxic texts, and the calibration of what windows gain by the latter.

    The dictionaries come from one part of the sampled documents, the calibration from the other. The samples of the toxic
    dictionary are the words of toxic texts whose starts lean to toxic texts; the rest of a toxic text is ordinary. With labelled
    documents of one class only, every text scores the share of label 1; without any, 0.5.
    """
    sample, sizes = _labelled(docs, labels, params)
    total = sum(sizes.values())
    ordinary, toxic = _samples(sample, _telling_stems(sample, params), params)
    trained = _dictionary(ordinary, params.ordinary_bytes)
    none = np.zeros(0)
    model = ToxicityModel(params, trained, _dictionary(toxic, params.toxic_bytes) + trained, none, none, none, None,
                          sizes.get(1, 0) / total if total else 0.5)
    # at most 2 * sample_docs rows of BINS numbers
    found = sorted((r.toxic, r.counts) for r in bin_counts(sample.filter("NOT trains"), model, "toxic").collect())
    of_class = np.array([c for c, _ in found], np.int64)
    if 0 < of_class.sum() < len(of_class):
        _calibrated(model, of_class, np.array([c for _, c in found], np.float64), sizes)
    return model


def toxic_chance(model: ToxicityModel, counts: np.ndarray) -> np.ndarray:
    if model.weights is None:
        return np.full(len(counts), model.prior)
    x = (window_features(counts, model.ratio) - model.mean) / model.spread
    return 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Chance that a whole text is toxic, from 0 to 1. A null or empty text has no windows."""

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        gains = Gains(model)
        for part in parts:
            counts = np.array([gains(t) for t in part], np.float64).reshape(-1, BINS)
            yield pd.Series(toxic_chance(model, counts))

    return score(F.coalesce(text.cast("string"), F.lit("")))


def score_toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    Whole texts are read in windows, without a shuffle. Equal texts get equal scores, whatever their labels, language, source and
    id. Null and empty texts get the score of a text without windows; a null id is never held out; repeated rows give repeated
    rows; of several labels of one document the highest counts, of several texts the smallest is learned from; labels other than 0 and 1 are ignored;
    an empty table gives an empty one; other columns are not read.
    """
    model = train_toxicity(docs, labels, params)
    return (
        texts(docs)
        .select("doc_id", held_out("doc_id", params.folds, params.held_fold).alias("held_out"),
                toxicity_score(model, F.col("text")).alias("score"))
        .withColumn("predicted", F.when(F.col("score") >= params.threshold, 1).otherwise(0))
    )
