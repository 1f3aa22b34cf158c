"""Shard files of token ids in patched frame-of-reference blocks.

File: ``PFB1``; blocks; per document its id, a null flag and its number of ids; the byte offset of every block; a footer
with the section offsets and counts. Block: minimum (u32), number of ids (u32), packed width (u8), number of outliers
(u32), the low ``width`` bits of id - minimum packed most significant bit first, then positions (u32) and full values
(u32) of the outliers. The width is the smallest that holds the ``percentile`` of the differences.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow.fs as pafs

MAGIC = b"PFB1"
_HEAD = struct.Struct("<IIBI")
_FOOT = struct.Struct("<QQQQQ4s")
BLOCK_IDS = 8192


def pack_block(ids: np.ndarray, percentile: float = 0.95) -> bytes:
    """One block of unsigned 32-bit ids; any values, also none."""
    if not len(ids):
        return _HEAD.pack(0, 0, 0, 0)
    low = int(ids.min())
    rest = ids - np.uint32(low)
    at = min(len(rest) - 1, int(percentile * len(rest)))
    width = int(np.partition(rest, at)[at]).bit_length()
    far = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    bits = np.unpackbits(rest.astype(">u4").view(np.uint8)).reshape(-1, 32)[:, 32 - width :]
    return b"".join(
        (_HEAD.pack(low, len(ids), width, len(far)), np.packbits(bits).tobytes(),
         far.astype("<u4").tobytes(), ids[far].astype("<u4").tobytes())
    )


def unpack_block(data: bytes) -> np.ndarray:
    low, count, width, outliers = _HEAD.unpack_from(data)
    packed = (count * width + 7) // 8
    raw = np.frombuffer(data, np.uint8, packed, _HEAD.size)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - width :] = np.unpackbits(raw, count=count * width).reshape(count, width)
    ids = np.packbits(wide).view(">u4").astype(np.uint32) + np.uint32(low)
    at = _HEAD.size + packed
    if outliers:
        ids[np.frombuffer(data, "<u4", outliers, at)] = np.frombuffer(data, "<u4", outliers, at + 4 * outliers)
    return ids


class ShardWriter:
    """Documents are appended; full blocks go to the file at once, so memory holds one block and one document."""

    def __init__(self, uri: str, percentile: float = 0.95):
        files, path = pafs.FileSystem.from_uri(uri)
        files.create_dir(path.rpartition("/")[0], recursive=True)
        self.file, self.percentile = files.open_output_stream(path), percentile
        self.file.write(MAGIC)
        self.size, self.held, self.held_ids = len(MAGIC), [], 0
        self.blocks: list[int] = []
        self.docs: list[tuple[int, bool, int]] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.ids += len(ids)
        self.held.append(ids)
        self.held_ids += len(ids)
        if self.held_ids >= BLOCK_IDS:
            every = np.concatenate(self.held)
            full = len(every) // BLOCK_IDS * BLOCK_IDS
            for at in range(0, full, BLOCK_IDS):
                self._block(every[at : at + BLOCK_IDS])
            self.held, self.held_ids = [every[full:].copy()], len(every) - full

    def _block(self, ids: np.ndarray) -> None:
        data = pack_block(ids, self.percentile)
        self.blocks.append(self.size)
        self.file.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.held_ids:
            self._block(np.concatenate(self.held))
        docs_at = self.size
        for column, kind in zip(zip(*self.docs) if self.docs else ((), (), ()), ("<i8", "<u1", "<u8")):
            data = np.array(column, kind).tobytes()
            self.file.write(data)
            self.size += len(data)
        self.file.write(np.array(self.blocks, "<u8").tobytes())
        self.file.write(_FOOT.pack(docs_at, self.size, len(self.blocks), len(self.docs), self.ids, MAGIC))
        self.file.close()


class ShardReader:
    """``documents`` streams all; ``ids(start, stop)`` reads only the blocks that hold the range."""

    def __init__(self, uri: str):
        files, path = pafs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        docs_at, index_at, n_blocks, n_docs, self.n_ids, magic = _FOOT.unpack(
            self.file.read_at(_FOOT.size, size - _FOOT.size)
        )
        if magic != MAGIC or self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a shard of packed blocks: {uri}")
        self.bounds = [*np.frombuffer(self.file.read_at(8 * n_blocks, index_at), "<u8").tolist(), docs_at]
        raw = self.file.read_at(17 * n_docs, docs_at)
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs)
        self.nulls = np.frombuffer(raw, "<u1", n_docs, 8 * n_docs)
        self.lengths = np.frombuffer(raw, "<u8", n_docs, 9 * n_docs)

    def block(self, k: int) -> np.ndarray:
        return unpack_block(self.file.read_at(self.bounds[k + 1] - self.bounds[k], self.bounds[k]))

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK_IDS, (stop - 1) // BLOCK_IDS
        parts = [self.block(k) for k in range(first, last + 1)]
        return np.concatenate(parts)[start - first * BLOCK_IDS : stop - first * BLOCK_IDS]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, position of its first id, ids), one block of read-ahead."""
        at, block, buffered = 0, 0, np.empty(0, np.uint32)
        for doc_id, null, length in zip(self.doc_ids.tolist(), self.nulls.tolist(), self.lengths.tolist()):
            parts = [buffered]
            have = len(buffered)
            while have < length:
                parts.append(self.block(block))
                have += len(parts[-1])
                block += 1
            every = np.concatenate(parts) if len(parts) > 1 else buffered
            yield (None if null else doc_id), at, every[:length]
            buffered = every[length:]
            at += length

    def close(self) -> None:
        self.file.close()
