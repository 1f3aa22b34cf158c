"""Language-model scores of texts by a hashed maximum-entropy model with a class-factored softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.llm.common import arrow_schema, map_rows, texts
from spanledger.llm.quality import held_out
from spanledger.session import materialize


@dataclass(frozen=True)
class LmParams:
    """``head_words``: most frequent words whose counts every task holds; the rest is joined. ``model_words``: of these, words with a
    class of their own choosing; all others share the class of rare words. ``neighbours``: most frequent words that tell word
    clusters apart. ``buckets``: hashed features, at most 65536. ``rounds``: passes of distributed updates over all training tokens,
    each followed by an average of the workers' weights."""

    folds: int = 5
    held_fold: int = 1
    head_words: int = 200_000
    model_words: int = 32_768
    neighbours: int = 32
    clusters: int = 8
    bins: int = 8
    buckets: int = 1 << 14
    rounds: int = 3
    rate: float = 0.3
    batch: int = 8192


END = b""  # no word is empty
_RARE, _START = 65535, 65534
_CHUNKS = 16
_FLUSH = 800_000
_LEVELS = 16
_SLICE_BYTES = 8_000_000
#: Rows of odds worked on at a time, so that they stay in the processor's cache.
_PART = 1024


def distinct_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct tokens, place among them of every token, tokens of each text): words between ASCII blanks, A-Z lower-cased, then
    the end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.list_value_length(split).to_numpy()
    coded = split.flatten().cast(pa.large_binary()).dictionary_encode()
    tokens, places = coded.dictionary, coded.indices.to_numpy()
    end = pc.index(tokens, pa.scalar(END, pa.large_binary())).as_py()
    if end >= 0:  # an empty word stands beside blanks at either end of a text
        kept = places != end
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[kept], minlength=len(sizes))
        places = places[kept]
    else:
        end = len(tokens)
        tokens = pa.concat_arrays([tokens, pa.array([END], pa.large_binary())])
    return tokens, np.insert(places, np.cumsum(sizes), end), sizes + 1


def _sliced(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Rows of the batches in order, about ``_SLICE_BYTES`` of text at a time, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE_BYTES, "right")))
            yield batch.slice(at, stop - at)
            at = stop


def token_counts(docs: DataFrame) -> DataFrame:
    """token (UTF-8), n over all texts; counted within each task first, ``_FLUSH`` rows and a slice at a time."""

    schema = pa.schema([("token", pa.binary()), ("n", pa.int64())])

    def summed(held):
        every = pa.Table.from_batches(held, schema).group_by("token", use_threads=False).aggregate([("n", "sum")])
        return every.rename_columns({"n_sum": "n"}).to_batches(max_chunksize=_FLUSH // 8)

    def run(batches):
        held, rows = [], 0
        for batch in _sliced(batches, 0):
            tokens, places, _ = distinct_tokens(batch.column(0))
            counts = np.bincount(places, minlength=len(tokens))
            held.append(pa.record_batch([tokens.cast(pa.binary()), pa.array(counts, pa.int64())], schema=schema))
            rows += len(tokens)
            if rows > _FLUSH:
                yield from summed(held)
                held, rows = [], 0
        yield from summed(held)

    return docs.select("text").mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """``rank`` by head word; ``counts`` by rank; the first ``modelled`` ranks have classes. ``rare_*``: all other words."""

    rank: dict[bytes, int]
    counts: np.ndarray
    modelled: int
    tokens: int
    distinct: int

    @property
    def rare_tokens(self) -> int:
        return self.tokens - int(self.counts[: self.modelled].sum())

    @property
    def rare_distinct(self) -> int:
        return self.distinct - self.modelled

    def base(self, counts):
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def rare(self, counts):
        """Within the class of rare words, which also holds one share for unknown words."""
        return np.log10((counts + 0.5) / (self.rare_tokens + 0.5 * (self.rare_distinct + 1)))


def build_vocabulary(counts: DataFrame, params: LmParams) -> Vocabulary:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    # words by size of count, some thousand classes at most: the head is as many whole classes as fit
    size = F.floor(F.log2("n") * 64).cast("long")
    sizes = sorted(((r.size, r.words) for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("words")).collect()), reverse=True)
    least, held = 1 << 62, 0
    for value, words in sizes:
        held += words
        if held > params.head_words:
            break
        least = value
    # at most head_words rows
    head = sorted(counts.filter(size >= least).collect(), key=lambda r: (-r.n, bytes(r.token)))
    rank = {bytes(r.token): k for k, r in enumerate(head)}
    return Vocabulary(rank, np.array([r.n for r in head], np.int64), min(len(head), params.model_words), total, distinct)


def encode_words(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """row, doc_id, held_out, n_tokens, n_known, base and rare (sums over head words), ids (16-bit model words, end included), tail
    (other words)."""

    ddl = (
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, rare double, ids binary, "
        "tail array<binary>"
    )
    schema = arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches):
        base = vocabulary.base(vocabulary.counts) if vocabulary.tokens else np.zeros(0)
        rare = vocabulary.rare(vocabulary.counts) if vocabulary.tokens else np.zeros(0)
        rare[: vocabulary.modelled] = 0.0
        # of a word beyond the head: nothing, added when its count is joined
        base, rare = np.r_[base, 0.0], np.r_[rare, 0.0]
        head = pa.array(sorted(vocabulary.rank, key=vocabulary.rank.get), pa.large_binary())
        for batch in _sliced(batches, 3):
            tokens, places, sizes = distinct_tokens(batch.column(3))
            ranks = pc.index_in(tokens, value_set=head).fill_null(-1).to_numpy()
            ids = np.where((ranks >= 0) & (ranks < vocabulary.modelled), ranks, _RARE).astype("<u2")[places]
            starts = np.cumsum(sizes) - sizes
            beyond = (ranks < 0)[places]
            tails = np.add.reduceat(beyond, starts, dtype=np.int64)
            sums = [np.add.reduceat(x[ranks][places], starts) for x in (base, rare)]
            ends = pa.array(np.r_[0, 2 * np.cumsum(sizes)], pa.int32())
            tail = tokens.take(pa.array(places[beyond])).cast(pa.binary())
            columns = [
                *batch.columns[:3], sizes, sizes - tails, *sums,
                pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends.buffers()[1], pa.py_buffer(ids)]),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(tails)], pa.int32()), tail),
            ]
            yield pa.record_batch(columns, schema=schema)

    return docs.select("row", "doc_id", "held_out", "text").mapInArrow(run, ddl)


def _flat(batches: Iterator[pa.RecordBatch], column: int, least: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(ids of several documents, where each starts, their first columns), about ``least`` ids at a time."""
    parts, firsts, size = [], [], 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        for name, ids in zip(names, batch.column(column)):
            parts.append(np.frombuffer(ids.as_buffer(), "<u2"))
            firsts.append(name)
            size += len(parts[-1])
            if size >= least:
                yield _concatenated(parts, firsts)
                parts, firsts, size = [], [], 0
    if parts:
        yield _concatenated(parts, firsts)


def _concatenated(parts, firsts):
    starts = np.cumsum([0, *map(len, parts[:-1])])
    return np.concatenate(parts).astype(np.int64), starts, firsts


def _history(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each and the one before that; every document holds at least its end."""
    one, two = np.r_[_START, ids[:-1]], np.r_[_START, _START, ids[:-2]][: len(ids)]
    one[starts] = _START
    two[starts] = _START
    seconds = starts + 1
    two[seconds[seconds < len(ids)]] = _START
    return one, two


def _features(ids: np.ndarray, starts: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Hashed buckets of the word before, of the two words before, and of the second word before (skip)."""
    one, two = _history(ids, starts)
    mask = buckets - 1

    def mixed(x, salt):
        x = (x.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        return (((x ^ (x >> np.uint64(29))) >> np.uint64(17)) & np.uint64(mask)).astype(np.uint16)

    return mixed(one, 1 << 40), mixed(one * 65536 + two, 2 << 40), mixed(two, 3 << 40)


def word_classes(encoded: DataFrame, vocabulary: Vocabulary, params: LmParams, workers: int) -> np.ndarray:
    """Class of every model word: clusters by frequent neighbours, cut into bins of equal frequency. The last two classes are the
    end and rare words."""
    size, near = vocabulary.modelled, params.neighbours

    def rows(batches):
        seen = np.zeros(size * near, np.int64)
        for ids, starts, _ in _flat(batches, 0):
            one, _two = _history(ids, starts)
            for word, other in ((ids, one), (one, ids)):
                good = (word < size) & (other < near)
                seen += np.bincount(word[good] * near + other[good], minlength=size * near)
        seen = seen.reshape(size, near).astype("<u4")
        for chunk, part in enumerate(np.array_split(seen, _CHUNKS)):
            yield chunk, part.tobytes()

    def summed(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<u4").astype(np.int64) for x in frame.seen)
        return pd.DataFrame({"chunk": [frame.chunk.iloc[0]], "seen": [total.tobytes()]})

    parts = map_rows(encoded.select("ids").coalesce(workers), rows, "chunk bigint, seen binary")
    # a table of fixed size
    sums = parts.groupBy("chunk").applyInPandas(summed, "chunk long, seen binary").orderBy("chunk").collect()
    seen = np.concatenate([np.frombuffer(r.seen, np.int64) for r in sums] or [np.zeros(0, np.int64)]).reshape(-1, near)
    classes = np.zeros(size, np.int64)
    if not len(seen):
        return classes
    profile = np.sqrt(seen / np.maximum(seen.sum(axis=1, keepdims=True), 1))
    cluster = _clusters(profile, vocabulary.counts[:size], params.clusters)
    for k in range(params.clusters):
        own = np.flatnonzero(cluster == k)  # by falling frequency
        mass = np.cumsum(np.sqrt(vocabulary.counts[own]))
        bins = np.minimum(params.bins - 1, (mass / max(mass[-1:], default=1) * params.bins).astype(np.int64)) if len(own) else mass
        classes[own] = k * params.bins + bins
    if END in vocabulary.rank and vocabulary.rank[END] < size:
        classes[vocabulary.rank[END]] = params.clusters * params.bins
    return classes


def _clusters(profile: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """k-means from farthest-first seeds among the most frequent words."""
    seeds = [0]
    gap = ((profile[:2000] - profile[0]) ** 2).sum(axis=1)
    while len(seeds) < min(count, len(profile)):
        seeds.append(int(gap.argmax()))
        gap = np.minimum(gap, ((profile[:2000] - profile[seeds[-1]]) ** 2).sum(axis=1))
    centres = profile[seeds]
    for _ in range(15):
        cluster = (profile @ centres.T * 2 - (centres**2).sum(axis=1)).argmax(axis=1)
        for k in range(len(centres)):
            own = cluster == k
            if own.any():
                centres[k] = np.average(profile[own], axis=0, weights=np.sqrt(weights[own]))
    return cluster


@dataclass
class ClassModel:
    """``weights``: added by a feature to the log odds of each class; ``bias``: log share of each class; ``within``: log10 share of a
    model word in its class."""

    params: LmParams
    classes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    within: np.ndarray

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        rare = self.params.clusters * self.params.bins + 1
        return np.where(ids < len(self.classes), self.classes[np.minimum(ids, len(self.classes) - 1)] if len(self.classes) else rare, rare)

    def scores(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 chance of each token, for rare words of their class."""
        out, wanted, params = np.empty(len(ids)), self.class_of(ids), self.params
        features, pasts = _features(ids, starts, params.buckets), _pasts(ids, starts)
        bias, (odds, room) = np.tile(self.bias, (_PART, 1)), np.empty((2, _PART, len(self.bias)), np.float32)
        for at in range(0, len(ids), params.batch):
            cut = slice(at, at + params.batch)
            order, first, place = _groups(pasts[cut])
            used, own = [f[cut][order[first]] for f in features], wanted[cut]
            edges, found = np.r_[first, len(order)], np.empty(len(order))
            for low in range(0, len(first), _PART):
                part = slice(low, low + _PART)
                some = _odds(self.weights, bias, [f[part] for f in used], odds, room)
                tokens = order[edges[low] : edges[low + len(some)]]
                rows = place[tokens] - low
                found[tokens] = some[rows, own[tokens]] - np.log(np.exp(some, out=room[: len(some)]).sum(axis=1, dtype=np.float64))[rows]
            out[cut] = found
        out /= np.log(10)
        inside = ids < len(self.within)
        out[inside] += self.within[ids[inside]]
        return out


def _pasts(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One number for the two words before each; tokens with the same have the same features and the same odds."""
    one, two = _history(ids, starts)
    return one.astype(np.uint32) << np.uint32(16) | two.astype(np.uint32)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, where each group of equal keys starts in it, group of every key)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), place


def _odds(weights: np.ndarray, bias: np.ndarray, used: list[np.ndarray], out: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Log odds of all classes, kept where exponentials fit single precision, in the first rows of ``out``. ``bias``: the same in
    every row, as rows are added faster than one row to each; ``room``: for as many rows."""
    out, room = out[: len(used[0])], room[: len(used[0])]
    # buckets are within the table, so a mode that does not check each changes nothing and is faster
    np.take(weights, used[0], axis=0, mode="clip", out=out)
    out += np.take(weights, used[1], axis=0, mode="clip", out=room)
    out += np.take(weights, used[2], axis=0, mode="clip", out=room)
    out += bias[: len(out)]
    return np.clip(out, -60, 60, out=out)


def _group_sums(values: np.ndarray, order: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(groups by falling size, sums of their rows) for the groups of rows ``values[order]`` that start at ``first``: one row of every
    group at a time for the first few, then what is left of each large group."""
    sizes = np.diff(np.r_[first, len(order)])
    by = np.argsort(-sizes, kind="stable")
    at, sizes = first[by], sizes[by]
    sums = np.take(values, order[at], axis=0, mode="clip")
    room = np.empty_like(sums)
    for k in range(1, _LEVELS):
        more = int(np.searchsorted(-sizes, -k))
        if not more:
            return by, sums
        sums[:more] += np.take(values, order[at[:more] + k], axis=0, mode="clip", out=room[:more])
    for k in range(int(np.searchsorted(-sizes, -_LEVELS))):
        sums[k] += np.take(values, order[at[k] + _LEVELS : at[k] + sizes[k]], axis=0, mode="clip").sum(axis=0)
    return by, sums


def _update(model: ClassModel, weights: np.ndarray, squares: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> None:
    """Gradient steps over the tokens in batches; the step of a bucket shrinks with its past gradients. The gradient of a batch is
    that of all its tokens; those after the same two words share their odds, which are worked out once."""
    wanted, features, params = model.class_of(ids), _features(ids, starts, model.params.buckets), model.params
    pasts, count = _pasts(ids, starts), weights.shape[1]
    bias, room = np.tile(model.bias, (_PART, 1)), np.empty((_PART, count), np.float32)
    every = np.empty((min(params.batch, len(ids)), count), np.float32)
    for at in range(0, len(ids), params.batch):
        cut = slice(at, at + params.batch)
        order, first, place = _groups(pasts[cut])
        times = np.diff(np.r_[first, len(order)]).astype(np.float32)
        used = [f[cut][order[first]] for f in features]
        slopes = every[: len(first)]
        for low in range(0, len(first), _PART):
            part = slice(low, low + _PART)
            odds = _odds(weights, bias, [f[part] for f in used], slopes[part], room)
            np.exp(odds, out=odds)
            odds *= (times[part] / np.einsum("ij->i", odds))[:, None]
        np.subtract.at(slopes.reshape(-1), place * count + wanted[cut], np.float32(1))
        for f in used:
            order = np.argsort(f, kind="stable")
            ranked = f[order]
            first = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            by, step = _group_sums(slopes, order, first)
            bucket = ranked[first[by]]
            past = squares[bucket] + np.einsum("ij,ij->i", step, step)
            squares[bucket] = past
            step *= (np.float32(params.rate) / np.sqrt(past))[:, None]
            now = np.take(weights, bucket, axis=0, mode="clip")
            now -= step
            weights[bucket] = now


def train_classes(encoded: DataFrame, vocabulary: Vocabulary, params: LmParams, workers: int) -> ClassModel:
    """Each round every worker updates a copy of the weights over its share of all training tokens; copies are averaged by
    tokens, in pieces over the cluster."""
    classes = word_classes(encoded, vocabulary, params, workers)
    count, size = params.clusters * params.bins + 2, vocabulary.modelled
    tokens = np.bincount(classes, vocabulary.counts[:size], minlength=count)
    within = np.log10(vocabulary.counts[:size] / np.maximum(tokens[classes], 1))
    tokens[-1] = vocabulary.rare_tokens
    # one unseen token of every class, so that no chance is zero
    bias = np.log((tokens + 1.0) / (tokens.sum() + count)).astype(np.float32)
    model = ClassModel(params, classes, np.zeros((params.buckets, count), np.float32), bias, within)
    spark = encoded.sparkSession
    for _ in range(params.rounds):
        sent = spark.sparkContext.broadcast(model)
        parts = map_rows(encoded.select("ids").coalesce(workers), _worker(sent), "chunk bigint, n bigint, weights binary")
        rows = parts.groupBy("chunk").applyInPandas(_averaged, "chunk long, weights binary").orderBy("chunk").collect()
        sent.unpersist()
        if rows:
            model.weights = np.concatenate([np.frombuffer(r.weights, np.float32) for r in rows]).reshape(params.buckets, count)
    return model


def _worker(sent):
    def rows(batches):
        model = sent.value
        weights, squares, seen = model.weights.copy(), np.full(len(model.weights), 1.0, np.float32), 0
        for ids, starts, _ in _flat(batches, 0):
            _update(model, weights, squares, ids, starts)
            seen += len(ids)
        if seen:
            for chunk, part in enumerate(np.array_split(weights, _CHUNKS)):
                yield chunk, seen, part.tobytes()

    return rows


def _averaged(frame: pd.DataFrame) -> pd.DataFrame:
    share = frame.n / frame.n.sum()
    mean = sum(np.frombuffer(w, np.float32) * np.float32(s) for w, s in zip(frame.weights, share))
    return pd.DataFrame({"chunk": [frame.chunk.iloc[0]], "weights": [mean.astype(np.float32).tobytes()]})


def score_texts(docs: DataFrame, params: LmParams = LmParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every whole text.

    A text is its words and one end. ``base_score`` is the smoothed unigram score; ``score`` the log10 chance under the model: the
    class of the next word given hashed features of the two before, times the word's share of its class; rare and unknown words share a
    class, smoothed like the base. Learned are all rows outside the held fold. Null and empty texts are one end; a null id is never held
    out; repeated rows are rows of their own; with nothing to learn from, every score is that of one unknown token at
    even odds (0 and the class shares); other columns are not read. Counts of words beyond the head are joined by word, so the
    vocabulary may outgrow any task.
    """
    keyed = texts(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", held_out("doc_id", params.folds, params.held_fold).alias("held_out"), "text"
    )
    counts = materialize(token_counts(keyed.filter(~F.col("held_out"))), "token-counts")
    vocabulary = build_vocabulary(counts, params)
    encoded = materialize(encode_words(keyed, vocabulary), "encoded")
    workers = max(2, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    model = train_classes(encoded.filter(~F.col("held_out")), vocabulary, params, workers)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for ids, starts, names in _flat(batches, 1):
            chances = sent.value.scores(ids, starts)
            yield from zip(names, np.add.reduceat(chances, starts).tolist())

    scored = map_rows(encoded.select("row", "ids"), rows, "row bigint, classes double")
    tail = encoded.select("row", F.explode("tail").alias("token")).join(counts, "token", "left")
    n = F.coalesce("n", F.lit(0))
    base = F.log10((n + 0.5) / (vocabulary.tokens + 0.5 * (vocabulary.distinct + 1)))
    rare = F.log10((n + 0.5) / (vocabulary.rare_tokens + 0.5 * (vocabulary.rare_distinct + 1)))
    tails = tail.groupBy("row").agg(F.sum(base).alias("tail_base"), F.sum(rare).alias("tail_rare"), F.count("n").alias("tail_known"))
    zero = F.lit(0.0)
    return (
        encoded.select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare")
        .join(scored, "row").join(tails, "row", "left")
        .select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
            F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("tail_base", zero)).alias("base_score"),
            (F.col("classes") + F.col("rare") + F.coalesce("tail_rare", zero)).alias("score"),
        )
    )
