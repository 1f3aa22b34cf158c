"""Token ids of a corpus in ordered binary shards (see ``packed_blocks``)."""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.common import map_rows, texts, vocabulary_path
from spanledger.llm.packed_blocks import ShardReader, ShardWriter
from spanledger.session import materialize, scratch_path

WORD_BPE = "word_bpe_49k.json"
END_ID = 2
SHARD_BYTES = 16_000_000
#: Of a large corpus, this many shards, as long as one stays below ``LARGEST_SHARD``.
SHARDS = 20_000
LARGEST_SHARD = 512_000_000
#: What a document weighs beside its text, so that empty texts fill shards too.
ROW_BYTES = 64
_GROUP_BYTES = 4_000_000


#: How the vocabulary prepares texts: letters in runs, digits alone, other signs in runs, after composing and lower-casing.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_BLANK, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _kinds() -> np.ndarray:
    """Kind of every byte; bytes of no ASCII character are settled in ``split_pieces``."""
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[0x21:0x7F] = _SIGN
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    for first in b"aA":
        kinds[first : first + 26] = _LETTER
    kinds[list(b" \t\n\x0b\x0c\r")] = _BLANK
    kinds[ord("'")] = _OTHER  # may begin a piece of letters
    return kinds


_KINDS = _kinds()
_BLANKS = re.compile(rb"[ \t\n\r\x0b\x0c]")


def split_pieces(raw: bytes, cut: bool = True) -> tuple[pa.Array, np.ndarray]:
    """(lower-cased pieces without blanks, their first bytes in ``raw``) of the words between ASCII blanks: runs of letters (ASCII and
    Latin-1), single digits, runs of other signs. A word with any other character, an apostrophe or ``<|``, or any
    word without ``cut``, is one piece as it stands, told apart by a null byte before it."""
    data = np.frombuffer(raw, np.uint8)
    kinds = _KINDS[data]
    lead = np.flatnonzero(data == 0xC3)
    lead = lead[lead + 1 < len(data)]
    second = data[lead + 1]
    lead = lead[(second >> 6 == 2) & (second != 0x97) & (second != 0xB7)]  # not the signs of multiplication and division
    kinds[lead] = kinds[lead + 1] = _LETTER
    mark = np.flatnonzero(data == ord("<"))
    mark = mark[mark + 1 < len(data)]
    kinds[mark[data[mark + 1] == ord("|")]] = _OTHER
    solid = kinds != _BLANK
    if not cut:
        kinds[solid] = _OTHER
    edges = np.diff(np.r_[False, solid, False].astype(np.int8))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    odd = np.unique(np.searchsorted(begins, np.flatnonzero(kinds == _OTHER), "right") - 1)
    new = np.r_[True, kinds[1:] != kinds[:-1]][: len(data)] | (kinds == _DIGIT)
    lower = np.frombuffer(raw.lower(), np.uint8).copy()
    high = lead[(data[lead + 1] < 0x9F)] + 1
    lower[high] += 0x20
    inside = np.zeros(len(data) + 1, np.int8)
    inside[begins[odd]], inside[ends[odd]] = 1, -1
    inside = np.cumsum(inside[:-1], dtype=np.int8).view(bool)
    new[inside] = False
    new[begins[odd]] = True
    lower[inside] = data[inside]
    firsts = np.flatnonzero(new & solid)
    # where pieces begin among the bytes that are no blanks
    offsets = np.r_[(np.cumsum(solid) - 1)[firsts], np.count_nonzero(solid)].astype(np.int64)
    kept = lower[solid]
    if len(odd):
        whole = offsets[np.searchsorted(firsts, begins[odd])]
        kept = np.insert(kept, whole, 0)
        offsets = offsets + np.searchsorted(whole, offsets, "left")
    return pa.Array.from_buffers(pa.large_binary(), len(firsts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]), firsts


class WordIds:
    """Ids of the words of a group of texts.

    Words are what stands between ASCII blanks, which this vocabulary's tokenizer drops and across which it keeps no context, and it
    encodes the pieces of a word one by one. Pieces of plain letters, digits and signs are cut here, other words are left whole; the
    library encodes the new ones of a group in a few calls. Two generations of at most ``limit`` pieces and a group's are held.
    """

    def __init__(self, vocabulary: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        vocabulary = vocabulary_path(vocabulary)

        self.tokenizer, self.letters = Tokenizer.from_file(vocabulary), Tokenizer.from_file(vocabulary)
        for each in (self.tokenizer, self.letters):
            each.no_truncation()
            each.no_padding()
        normal, pieces = (json.loads(x.__getstate__()) if x else {} for x in (self.tokenizer.normalizer, self.tokenizer.pre_tokenizer))
        added = [str(token.content) for token in self.tokenizer.get_added_tokens_decoder().values()]
        # of a vocabulary that prepares texts otherwise, all words are left to the library
        self.cut = normal.get("normalizers") == _NORMALIZERS and pieces.get("pretokenizers") == _PIECES and all("<|" in x for x in added)
        # pieces come lower-cased, each byte as the sign that stands for it
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith("</w>")]] = True
        self.one = vocab["1</w>"]
        self.limit, self.now, self.old = limit, {}, {}

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        raw, parts, at = b" ".join(texts), [], 0
        # a text begins one blank after the one before
        bounds = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        until = np.zeros(len(texts), np.int64)
        while at < len(raw):
            blank = _BLANKS.search(raw, at + 2 * _GROUP_BYTES)
            end = blank.start() if blank else len(raw)
            ids, firsts, stops = self._ids(raw[at:end])
            until += np.r_[0, stops][np.searchsorted(firsts, np.clip(bounds - at, 0, end - at), "left")]
            parts.append(ids)
            at = end
        return np.concatenate(parts) if parts else np.empty(0, "<u4"), np.diff(np.r_[0, until])

    def _ids(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all words, where each piece begins, number of ids up to its end)."""
        pieces, firsts = split_pieces(raw, self.cut)
        coded = pieces.dictionary_encode()
        distinct, places = coded.dictionary, coded.indices.to_numpy()
        # no piece holds a blank
        names = pc.binary_join(pa.scalar(distinct, pa.large_list(pa.large_binary())), pa.scalar(b" ", pa.large_binary()))
        found = self.of(names.as_buffer().to_pybytes().split(b" ")) if len(distinct) else []
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, starts = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes
        each = sizes[places]
        stops = np.cumsum(each)
        of_each = np.repeat(starts[places] - (stops - each), each)
        of_each += np.arange(len(of_each))
        return np.take(flat, of_each), firsts, stops

    def of(self, words: list[bytes]) -> list[bytes]:
        """Ids, as unsigned 32-bit little-endian bytes, of each piece; a null byte stands before words left whole."""
        found = list(map(self.now.get, words))
        missing = [word for word, ids in zip(words, found) if ids is None]
        if not missing:
            return found
        new = {word: ids for word in missing if (ids := self.old.get(word)) is not None}
        fresh = [word for word in missing if word not in new]
        pieces = [w for w in fresh if w[0]]
        others = [w for w in fresh if not w[0] and b"1" not in w]
        rest = [w for w in fresh if not w[0] and b"1" in w]
        for group, encode in ((pieces, self._pieces), (others, self._divided)):
            known = encode(group)
            if known is None:
                rest += group
            else:
                new.update(zip(group, known))
        encodings = self.tokenizer.encode_batch_fast([_word(w).decode() for w in rest], add_special_tokens=False)
        new.update((w, array("I", e.ids).tobytes()) for w, e in zip(rest, encodings))
        if len(self.now) + len(new) > self.limit:
            self.old, self.now = self.now, {}
        self.now.update(new)
        return [new[word] if ids is None else ids for word, ids in zip(words, found)]

    def _pieces(self, pieces: list[bytes]) -> list[bytes] | None:
        """Pieces in one text: the last id of each ends a word. None if that doesn't hold."""
        text = _SIGNS[np.frombuffer(b" ".join(pieces), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.letters.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return _cut(ids, (np.flatnonzero(self.ends[ids]) + 1).tolist(), 0, len(pieces))

    def _divided(self, words: list[bytes]) -> list[bytes] | None:
        """Words without the digit 1 in one text, each followed by this digit, which is always one id of its own."""
        text = (b" 1 ".join(map(_word, words)) + b" 1").decode() if words else ""
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        return _cut(ids, (np.flatnonzero(ids == self.one) + 1).tolist(), 1, len(words))


def _signs() -> np.ndarray:
    """Sign that stands for every byte: printable ones in Latin-1 for themselves, others counted up from U+0100; a blank stays."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = np.setdiff1d(np.arange(256), printed)
    signs = np.arange(256, dtype="<u2")
    signs[others] = 0x100 + np.arange(len(others))
    signs[ord(" ")] = ord(" ")
    return signs


_SIGNS = _signs()


def _word(piece: bytes) -> bytes:
    return piece if piece[0] else piece[1:]


def _cut(ids: np.ndarray, stops: list[int], drop: int, count: int) -> list[bytes] | None:
    """The bytes between stops without the last ``drop`` ids of each; None if there are not ``count``."""
    if len(stops) != count:
        return None
    raw = ids.tobytes()
    return [raw[4 * start : 4 * (stop - drop)] for start, stop in zip([0, *stops], stops)]


@lru_cache(maxsize=2)
def word_ids(vocabulary: str) -> WordIds:
    """One for all tasks of a Python process."""
    return WordIds(vocabulary)


def _grouped(batches) -> Iterator[list[tuple[int | None, bytes]]]:
    group, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = text.as_buffer().to_pybytes()
            group.append((doc_id, raw))
            size += len(raw)
            if size >= _GROUP_BYTES:
                yield group
                group, size = [], 0
    if group:
        yield group


def shard_count(total: int, shard_bytes: int = SHARD_BYTES) -> int:
    """Shards of ``shard_bytes`` up to ``SHARDS`` of them, then larger ones, then as many of the largest as it takes."""
    return max(1, -(-total // max(shard_bytes, min(LARGEST_SHARD, -(-total // SHARDS)))))


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str = WORD_BPE, end_id: int = END_ID, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write their ids in ascending doc_id order into shards under ``folder``.

    Returns the stored manifest: shard, path, n_docs, n_ids, start (ids in all shards before). Texts are range-partitioned by
    (doc_id, row), so one repeated doc_id is spread as well, and encoded where they are written. A shard is written under a name
    of its task attempt and counts only if the manifest lists it, so retries and lost executors leave at most an unlisted
    file. ``folder`` is any URI that Arrow opens. Null and empty texts hold only the end id and count towards a shard's size; repeated
    rows are documents of their own; an empty table gives no shard.
    """
    numbered = texts(docs).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    total = numbered.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    shards = shard_count(total, shard_bytes)

    def rows(batches):
        context = TaskContext.get()
        path = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.pfb"
        known, writer = word_ids(vocabulary), None
        for group in _grouped(batches):
            ids, counts = known.encode([raw for _, raw in group])
            stops = np.cumsum(counts)
            ids = np.insert(ids, stops, end_id)
            writer = writer or ShardWriter(path)
            at = 0
            for (doc_id, _), stop in zip(group, (stops + np.arange(1, len(stops) + 1)).tolist()):
                writer.add(doc_id, ids[at:stop])
                at = stop
        if writer:
            writer.close()
            yield context.partitionId(), path, len(writer.docs), writer.ids

    ordered = (
        numbered.repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    )
    written = materialize(map_rows(ordered, rows, "shard bigint, path string, n_docs bigint, n_ids bigint"), "shards")
    # one row per shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(written.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), "manifest")


def read_token_files(manifest: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Read shards back: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (unsigned CRC-32 of the ids as
    little-endian unsigned 32-bit integers); with ``keep_ids`` also ids."""
    ddl = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if keep_ids:
        ddl += ", ids array<bigint>"

    def rows(batches):
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns)):
                shard = ShardReader(path)
                for doc_id, at, ids in shard.documents():
                    row = (doc_id, start + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    yield (*row, ids.tolist()) if keep_ids else row
                shard.close()

    shards = max(1, manifest.count())
    each = manifest.repartitionByRange(shards, "shard").select("path", "start")
    return map_rows(each, rows, ddl)


def token_files(docs: DataFrame, folder: str | None = None, vocabulary: str = WORD_BPE) -> DataFrame:
    """Write the token files of ``docs`` and read them back.

    Null and empty texts hold only the end id. A null doc_id sorts first and stays null; rows with one doc_id follow
    each other; an empty table gives no shard and no row; other columns are not read.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return read_token_files(write_token_files(docs, folder, vocabulary))
