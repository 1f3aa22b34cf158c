"""Byte-level BPE: encoding by a priority queue of merge ranks, decoding by joining vocabulary strings."""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache
from itertools import chain

import regex
from pyspark.sql import DataFrame

from spanledger.llm.common import WordCache, map_rows, texts, vocabulary_path

BYTE_BPE = "byte_bpe_50k.json"
# fixed values: the split pattern of byte-level BPE vocabularies
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_SHIFT = 20


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class ByteBpe:
    """A byte-level BPE vocabulary, given by its file or its public name. ``encode`` gives ids, ``decode`` the text of ids.

    Strings of special tokens in a text become their ids. Ids without an entry raise ``KeyError``.
    """

    def __init__(self, path: str, cache_words: int = 150_000):
        with open(vocabulary_path(path), encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
        first = {self.bytes_of[i]: i for i in vocab.values()}
        self.byte_ids = [first.get(bytes([b]), -1) for b in range(256)]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[left] << _SHIFT) | vocab[right], (rank, vocab[left + right]))
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.bytes_of |= {i: s.encode() for s, i in special.items()}
        self._at_special = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
            if special else None
        )
        self._pieces = regex.compile(SPLIT).findall
        self._cache = WordCache(self.merge, cache_words)

    def merge(self, piece: str) -> tuple[int, ...]:
        """Merge one piece: the queue holds (rank, position) of neighbours in a doubly linked list of symbols; an
        entry whose two symbols have changed since is stale and skipped."""
        ids = [self.byte_ids[b] for b in piece.encode()]
        size = len(ids)
        if size == 1:
            return tuple(ids)
        merges = self.merges
        queue = []
        for at in range(size - 1):
            found = merges.get((ids[at] << _SHIFT) | ids[at + 1])
            if found:
                queue.append((found[0], at, found[1], ids[at], ids[at + 1]))
        if not queue:
            return tuple(ids)
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        while queue:
            _, at, merged, left, right = pop(queue)
            other = after[at]
            if ids[at] != left or other >= size or ids[other] != right:
                continue
            ids[at], ids[other] = merged, -1
            beyond = after[at] = after[other]
            if beyond < size:
                before[beyond] = at
                found = merges.get((merged << _SHIFT) | ids[beyond])
                if found:
                    push(queue, (found[0], at, found[1], merged, ids[beyond]))
            ahead = before[at]
            if ahead >= 0:
                found = merges.get((ids[ahead] << _SHIFT) | merged)
                if found:
                    push(queue, (found[0], ahead, found[1], ids[ahead], merged))
        return tuple(i for i in ids if i >= 0)

    def encode(self, text: str) -> list[int]:
        cached = self._cache.__getitem__
        if self._at_special is None or not self._at_special.search(text):
            return list(chain.from_iterable(map(cached, self._pieces(text))))
        ids: list[int] = []
        for part in self._at_special.split(text):
            if part in self.special:
                ids.append(self.special[part])
            else:
                ids.extend(chain.from_iterable(map(cached, self._pieces(part))))
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def byte_bpe(vocabulary: str) -> ByteBpe:
    """One for all tasks of a Python process, with its cache of pieces."""
    return ByteBpe(vocabulary)


def bpe_round_trip(docs: DataFrame, vocabulary: str = BYTE_BPE, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = False) -> DataFrame:
    """Encode every text and decode its ids again: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``keep_text``
    also ids (array) and decoded.

    One map without a shuffle. Null and empty texts have no ids (digests of the empty string); a null id stays null;
    repeated rows give repeated rows; an empty table gives an empty one; other columns of ``docs`` are not read.
    Merged pieces are cached per Python process up to a fixed number of pieces.
    """
    ddl = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if keep_text:
        ddl += ", ids array<bigint>, decoded string"

    def rows(batches):
        bpe = byte_bpe(vocabulary)
        names = {i: str(i) for i in bpe.bytes_of}.__getitem__
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = bpe.encode(text.as_py())
                decoded = bpe.decode(ids)
                digest = hashlib.sha256(",".join(map(names, ids)).encode()).hexdigest()
                row = (doc_id, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest())
                yield (*row, ids, decoded) if keep_text else row

    return map_rows(texts(docs, id_col, text_col), rows, ddl)

