"""Near-duplicate texts by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import map_rows, texts, whole_row
from spanledger.llm.components import connected_components
from spanledger.session import materialize

#: Bits of the fingerprint segments. At most 4 differing bits leave at most one in some segment of three.
SEGMENTS = (22, 21, 21)
RADIUS = 1
MAX_BITS = 4
#: About how many rows of one table entry, and how many that probe it, meet in one task; beyond it either side is cut.
SPLIT_ROWS = 1 << 18
_DENSE = 64
_TILE = 2_000_000
_CHUNK = 1 << 16


def fingerprint(text: str, words_each: int = 4, seed: int = 42) -> int:
    """Bit i is set if it is in over half of the XXH64 of the shingles of ``words_each`` words; no words: 0."""
    words = text.encode().lower().split()  # bytes: only ASCII letters and blanks count
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) < words_each:
        return int.from_bytes(digest(b" ".join(words), seed), "big")
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    counts = np.zeros(64, np.int64)
    shingles = len(words) - words_each + 1
    for at in range(0, shingles, _CHUNK):
        stop = min(shingles, at + _CHUNK)
        spans = zip(starts[at:stop], ends[at + words_each - 1 : stop + words_each - 1])
        raw = b"".join([digest(joined[a : b - 1], seed) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > shingles).tobytes(), "big")


def fingerprints(docs: DataFrame, keep_row: bool = False) -> DataFrame:
    """doc_id, fp (the unsigned fingerprint as a signed long), with ``keep_row`` the column row as well."""

    def rows(batches):
        for batch in batches:
            others = [batch.column(k).to_pylist() for k in range(batch.num_columns - 1)]
            for *names, text in zip(*others, batch.column(batch.num_columns - 1)):
                value = fingerprint(text.as_py())
                yield (names[0], value - (1 << 64) if value >> 63 else value, *names[1:])

    if keep_row:
        return map_rows(docs.select("doc_id", "row", "text"), rows, "doc_id bigint, fp bigint, row bigint")
    return map_rows(texts(docs), rows, "doc_id bigint, fp bigint")


def _probes(fps: DataFrame) -> DataFrame:
    """Table rows (home) and probes of each fingerprint: per segment its value and all values in the Hamming ball of radius 1.

    ``key`` holds segment number and value.
    """
    balls, shift = [], 0
    for number, bits in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND((1 << bits) - 1)
        for flip in (0, *(1 << b for b in range(bits))):
            key = value.bitwiseXOR(F.lit(flip).cast("long")).bitwiseOR(F.lit(number << 24).cast("long"))
            balls.append(F.struct(key.alias("key"), F.lit(flip == 0).alias("home")))
        shift += bits
    return fps.select("fp", F.explode(F.array(*balls)).alias("p")).select("p.key", "p.home", "fp")


def _forest(homes: np.ndarray, others: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that connect whatever the links between homes, and between homes and others, connect.

    A search by breadth over the rows not reached yet: in a dense group the first steps reach nearly all, so neither
    the links nor the comparisons grow with the square of the group.
    """
    homes, others = np.unique(homes), np.unique(others)
    others = others[~np.isin(others, homes)]
    while len(homes):
        seed, homes = homes[0], homes[1:]
        queue = [(seed, True)]
        while queue and (len(homes) or len(others)):
            at, is_home = queue.pop()
            near = np.bitwise_count(homes ^ at) <= MAX_BITS
            if near.any():
                for x in homes[near]:
                    yield at, x
                    queue.append((x, True))
                homes = homes[~near]
            if is_home and len(others):
                near = np.bitwise_count(others ^ at) <= MAX_BITS
                if near.any():
                    for x in others[near]:
                        yield at, x
                        queue.append((x, False))
                    others = others[~near]


def _tiles_in(fp, places, first, homes) -> Iterator[np.ndarray]:
    """Links between the rows at ``places`` and the homes of their groups; ``first``, ``homes``: where these start, how many."""
    cuts = np.searchsorted(np.cumsum(homes), np.arange(_TILE, homes.sum() + 1, _TILE)).tolist()
    for low, high in zip([0, *cuts], [*cuts, len(places)]):
        if high <= low:
            continue
        times = homes[low:high]
        a = np.repeat(places[low:high], times)
        b = np.repeat(first[low:high] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= MAX_BITS) & (fp[a] != fp[b])
        yield np.stack([fp[a[near]], fp[b[near]]])


def _links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, home last to first); a group may go over several batches."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held: list[tuple] = []

    def out(a, b):
        return pa.record_batch([pa.array(np.asarray(x).astype(np.uint64).view(np.int64)) for x in (a, b)], schema=schema)

    def solve(key, piece, home, fp):
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])])
        sizes = np.diff(np.r_[starts, len(key)])
        homes = np.add.reduceat(home.astype(np.int64), starts)
        dense = homes >= _DENSE
        for start, size, n in zip(starts[dense], sizes[dense], homes[dense]):
            found = list(_forest(fp[start : start + n], fp[start + n : start + size]))
            if found:
                yield out(*zip(*found))
        rare = np.repeat(~dense & (homes > 0) & (sizes > 1), sizes)
        first, each = np.repeat(starts, sizes), np.repeat(homes, sizes)
        if rare.any():
            places = np.flatnonzero(rare)
            # homes keep their places, so links are looked up in the whole array
            for pairs in _tiles_in(fp, places, first[places], each[places]):
                if pairs.shape[1]:
                    yield out(pairs.max(axis=0), pairs.min(axis=0))

    def columns(batch):
        key, piece, home, fp = (batch.column(k) for k in range(4))
        return (key.to_numpy(), piece.to_numpy(), home.to_numpy(zero_copy_only=False), fp.to_numpy().view(np.uint64))

    for batch in batches:
        if not batch.num_rows:
            continue
        new = columns(batch)
        if held and (held[0][0][0], held[0][1][0]) == (new[0][-1], new[1][-1]):
            held.append(new)
            continue
        every = tuple(np.concatenate(x) for x in zip(*held, new))
        last = np.flatnonzero((every[0] != every[0][-1]) | (every[1] != every[1][-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield from solve(*(x[:cut] for x in every))
        held = [tuple(x[cut:] for x in every)]
    if held:
        yield from solve(*(np.concatenate(x) for x in zip(*held)))


def hamming_links(fps: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """a, b: links between distinct values ``fp`` at no more than 4 differing bits, enough to connect what all links connect.

    Multi-index hashing: every value is a table row in three segment tables and probes each with a Hamming ball of radius 1;
    full distances are then compared. Of a table entry of many rows, and of those that probe it, each piece of the one side meets each
    piece of the other in a group of its own, so that no task holds more than a few times ``split_rows``.
    """
    ordered = _entries(_probes(fps), split_rows).repartition("key", "piece").sortWithinPartitions("key", "piece", F.desc("home"))
    return ordered.mapInArrow(_links_of, "a long, b long")


def _hot_entries(probes: DataFrame, split_rows: int) -> DataFrame:
    """key, home_pieces, probe_pieces of the entries to cut. Counts are by segment value, at most 2**23 whatever the corpus.

    The rows that probe an entry are the table rows of the values in its ball. Values of few rows cannot make an entry hot
    together, so only the others are spread over their balls; a count is short by less than ``split_rows``.
    """
    few = split_rows / (max(SEGMENTS) + 1)
    counts = probes.filter("home").groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > few)
    bits = F.get(F.array(*map(F.lit, SEGMENTS)), F.shiftright("key", 24).cast("int"))
    flips = F.array(*[F.lit(x).cast("long") for x in (0, *(1 << b for b in range(max(SEGMENTS))))])
    around = counts.select("key", "n", F.explode(F.slice(flips, F.lit(1), bits + 1)).alias("flip"))
    sized = around.groupBy(F.col("key").bitwiseXOR(F.col("flip")).alias("key")).agg(
        F.greatest(F.lit(1), F.ceil(F.max(F.when(F.col("flip") == 0, F.col("n"))) / split_rows)).cast("int").alias("home_pieces"),
        F.ceil(F.sum("n") / split_rows).cast("int").alias("probe_pieces"),
    )
    return sized.filter("home_pieces > 1 OR probe_pieces > 1")


def _entries(probes: DataFrame, split_rows: int, broadcast_rows: int = 200_000) -> DataFrame:
    """key, piece, home, fp: the groups in which table rows (home) and probing rows meet. In a cut entry a table row is home in all groups of
    its own piece of the homes, and probes the other pieces of them."""
    hot = materialize(_hot_entries(probes, split_rows), "hot-entries")
    cut = probes.join(F.broadcast(hot) if hot.count() <= broadcast_rows else hot, "key", "left")
    homes, others = F.col("home_pieces"), F.col("probe_pieces")
    own_home = F.pmod(F.xxhash64("fp"), homes).cast("int")
    own_other = F.pmod(F.xxhash64("fp", F.lit(1)), others).cast("int")

    def group(h, p, home):
        return F.struct((h * others + p).cast("int").alias("piece"), F.lit(home).alias("home"))

    as_home = F.transform(F.sequence(F.lit(0), others - 1), lambda p: group(own_home, p, True))
    pieces = F.sequence(F.lit(0), homes - 1)
    rest = F.when(F.col("home"), F.array_except(pieces, F.array(own_home))).otherwise(pieces)
    as_other = F.transform(rest, lambda h: group(h, own_other, False))
    whole = F.array(F.struct(F.lit(0).alias("piece"), F.col("home").alias("home")))
    met = F.when(homes.isNull(), whole).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    return cut.select("key", "fp", F.explode(met).alias("g")).select("key", "g.piece", "g.home", "fp")


def _classes(marked: DataFrame) -> DataFrame:
    """fp, root (one fingerprint of its group) for every distinct fingerprint."""
    fps = materialize(marked.select("fp").distinct(), "distinct-fingerprints")
    roots = connected_components(hamming_links(fps))
    return fps.join(roots, fps.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every row of ``docs``.

    Null and empty texts have fingerprint zero and are linked like any other; a null doc_id gets its component but is never
    its smallest id (all null: null); repeated rows give repeated rows; an empty table gives an empty one; other
    columns are not read. Copies are one fingerprint; only distinct fingerprints are compared.
    """
    marked = materialize(fingerprints(docs), "fingerprints")
    classes = materialize(_classes(marked), "classes")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("first")).join(classes, "fp")
    smallest = least.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(classes.join(smallest, "root").select("fp", "component_id"), "named-classes")
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the smallest doc_id, nulls last, of repeated ids the first row.

    ``docs`` holds doc_id, text and any other columns, which keep their values. Its rows are numbered once and stored with their
    numbers, so that reads dealt differently over tasks cannot change them. Null and empty texts are near duplicates of each other; of
    repeated rows one stays; an empty table gives an empty one.
    """
    numbered = materialize(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("row")), "numbered-documents")
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit("")).alias("text")
    keyed = numbered.select(F.col("doc.doc_id").cast("long").alias("doc_id"), "row", text)
    marked = materialize(fingerprints(keyed, keep_row=True), "fingerprints")
    classes = materialize(_classes(marked), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    first = marked.groupBy("fp").agg(F.min(order).alias("first")).join(classes, "fp")
    kept = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    gone = materialize(marked.select("row").join(kept, "row", "left_anti"), "duplicates")
    small = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    return numbered.join(small, "row", "left_anti").select("doc.*")
