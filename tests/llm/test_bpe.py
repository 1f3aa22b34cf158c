import hashlib
import random

import pytest
from tokenizers import Tokenizer

from spanledger.llm.bpe import BYTE_BPE, ByteBpe, bpe_round_trip
from spanledger.llm.common import vocabulary_path

ALPHABET = "ab '\x1c\x1f\x85\xa0  　᠎​\t\n\r\x0bé١²Ⅷ日本😀sl.,!_-$"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path(BYTE_BPE))


def test_ids_and_text_as_the_library(library):
    bpe = ByteBpe(BYTE_BPE, cache_words=50)
    rng = random.Random(1)
    cases = ["", " ", "<|endoftext|>", "a<|endoftext|> b", "x" * 5000, " " * 300, "the and " * 40]
    for _ in range(1500):
        cases.append("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 14))) + rng.choice(["", "<|endoftext|>"]))
    for text in cases:
        ids = bpe.encode(text)
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_table_of_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (None, "The end", "x"), (3, "The end", "x"), (3, "The end", "x"), (4, "ab" * 60000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(bpe_round_trip(docs).collect(), key=repr)
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text or "")]
        want.append((doc_id, len(ids), *sha))
    assert [tuple(r) for r in got] == sorted(want, key=lambda r: repr(got[0].__class__(doc_id=r[0], n_tokens=r[1], ids_sha256=r[2], decoded_sha256=r[3])))
    assert bpe_round_trip(docs.limit(0)).count() == 0
    kept = bpe_round_trip(docs, keep_text=True).filter("doc_id = 4").first()
    assert kept.decoded == "ab" * 60000 and len(kept.ids) == kept.n_tokens
