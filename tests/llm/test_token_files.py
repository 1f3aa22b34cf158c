import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from spanledger.llm.packed_blocks import BLOCK_IDS, ShardReader, ShardWriter, pack_block, unpack_block
from pyspark.sql import functions as F

from spanledger.llm import token_files as token_files_module
from spanledger.llm.common import vocabulary_path
from spanledger.llm.token_files import (
    END_ID,
    LARGEST_SHARD,
    SHARDS,
    WORD_BPE,
    read_token_files,
    shard_count,
    token_files,
    write_token_files,
)


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    cases = [np.array([], np.uint32), np.array([7], np.uint32), np.full(100, 2**32 - 1, np.uint32)]
    for size in (1, 2, 17, 1000, BLOCK_IDS):
        for top in (1, 2, 50_000, 2**32 - 1):
            ids = rng.integers(0, top, size, dtype=np.uint32)
            ids[rng.random(size) < 0.03] = 2**32 - 1
            cases.append(ids)
    for ids in cases:
        for percentile in (0.0, 0.5, 0.95, 1.0):
            assert np.array_equal(unpack_block(pack_block(ids, percentile)), ids)
    small = np.where(rng.random(BLOCK_IDS) < 0.02, 2**31, rng.integers(0, 16, BLOCK_IDS)).astype(np.uint32)
    assert len(pack_block(small)) < BLOCK_IDS  # 4 bits an id and exceptions, not 32 bits


def test_shard_random_access(tmp_path):
    rng = np.random.default_rng(2)
    docs = [(k if k % 7 else None, rng.integers(0, 49_000, n, dtype=np.uint32)) for k, n in enumerate([0, 5, 30_000, 1, 9000])]
    writer = ShardWriter(str(tmp_path / "a" / "x.pfb"))
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = ShardReader(str(tmp_path / "a" / "x.pfb"))
    got = list(reader.documents())
    assert [(d, len(i)) for d, _, i in got] == [(d, len(i)) for d, i in docs]
    assert all(np.array_equal(a[2], b[1]) for a, b in zip(got, docs))
    every = np.concatenate([i for _, i in docs])
    for a, b in ((0, 0), (3, 9), (BLOCK_IDS - 1, 2 * BLOCK_IDS + 5), (0, len(every))):
        assert np.array_equal(reader.ids(a, b), every[a:b])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(WORD_BPE))


def test_table_of_odd_rows(spark, library, tmp_path):
    rng = random.Random(3)
    alphabet = "aB 'é\x1c\x85\xa0　\t\n\x0bİς日١²😀́.,<|endoftext|>"
    rows = [(5, None), (4, ""), (None, "The end"), (3, "THE 'll end"), (3, "THE 'll end"), (9, "word " * 30000), (8, "x" * 3000)]
    rows += [(100 + k, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))) for k in range(400)]
    rows += [(700, "a<|endoftext|>b <|startoftext|>")]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, start int")
    manifest = write_token_files(docs, str(tmp_path / "out"), shard_bytes=20_000)
    assert manifest.count() > 3
    got = read_token_files(manifest, keep_ids=True).orderBy("start").collect()
    want = {}
    at = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    for row, (_, text) in zip(got, order):
        ids = library.encode(text or "", add_special_tokens=False).ids + [END_ID]
        assert row.ids == ids, repr(text)
        assert (row.start, row.n_tokens) == (at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert not want
    assert token_files(docs.limit(0)).count() == 0


def test_shards_follow_rows_and_bytes(spark, tmp_path):
    assert [shard_count(n) for n in (0, 1, 16_000_000, 16_000_001)] == [1, 1, 1, 2]
    assert shard_count(10**12) == SHARDS and shard_count(10**15) == -(-(10**15) // LARGEST_SHARD)
    empty = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "").alias("text"))
    manifest = write_token_files(empty, str(tmp_path), shard_bytes=20_000)
    sizes = [r.n_docs for r in manifest.collect()]
    assert sum(sizes) == 3000 and len(sizes) >= 8 and max(sizes) < 1000
    assert [(r.start, r.n_tokens) for r in read_token_files(manifest).orderBy("doc_id").collect()] == [(k, 1) for k in range(3000)]


ODD_LETTERS = "aBzZéÉßÿ×÷ÑþÞ'’\"<|>1279²½ªºµ.,!-_/\\&$#😀日İΣςéǄ\x00\x1c\x85\xa0\x7f́\t\n\x0b\x0c\r    "


@pytest.mark.parametrize("cut, group_bytes", [(True, 4_000_000), (True, 20), (False, 4_000_000)])
def test_pieces_of_odd_words(library, monkeypatch, cut, group_bytes):
    rng = random.Random(4)
    texts = ["".join(rng.choice(ODD_LETTERS) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["<|endoftext|>", "a<|endoftext|>b", "<|", "< |", "don't 'll ÀÈ's", "Ã", "x" * 700, "é" * 300 + "." * 300, " ", ""]
    monkeypatch.setattr(token_files_module, "_GROUP_BYTES", group_bytes)
    words = token_files_module.WordIds(WORD_BPE, limit=500)
    assert words.cut
    words.cut = cut
    for at in range(0, len(texts), 97):
        own = texts[at : at + 97]
        ids, counts = words.encode([text.encode() for text in own])
        assert len(counts) == len(own) and counts.sum() == len(ids)
        for text, got in zip(own, np.split(ids, np.cumsum(counts)[:-1])):
            assert got.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert words.encode([])[0].tolist() == words.encode([b""])[0].tolist() == []


def test_library_sees_each_piece_once():
    words = token_files_module.WordIds(WORD_BPE)
    names = [b"tree", b"TREE", "Été".encode(), "étÉ".encode()]
    words.encode([b" ".join(name + sign for name in names for sign in (b"", b",", b".", b"!!", b"7", b"77"))])
    # two words, three runs of signs, one digit
    assert len(words.now) == 6
