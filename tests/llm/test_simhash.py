import random

import numpy as np
import pytest
import xxhash

from spanledger.llm.simhash import _entries, _probes, fingerprint, hamming_links, near_duplicates


def slow_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lower).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def reach(values):
    """Smallest index reachable by links of at most 4 bits."""
    values = np.array(values, np.uint64)
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 4):
            a, b = sorted((find(int(j)), find(i)))
            root[b] = a
    return [find(k) for k in range(len(values))]


def test_fingerprint():
    for text in ("", " \t\n", "One", "one two", "É É\x1cx one TWO three", "a b c d", "a b c d e a b c d", "w " * 70000, "ÀB\x0bc\x0cd e f"):
        assert fingerprint(text) == slow_fingerprint(text), text[:20]


@pytest.mark.parametrize("split_rows", [3, 40, 1_000_000])
def test_links_connect_what_all_links_connect(spark, split_rows):
    rng = random.Random(5)
    values = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(60):  # chains of neighbours at 4 and 5 bits
        value = rng.choice(values)
        for bit in rng.sample(range(64), rng.choice([1, 3, 4, 4, 5])):
            value ^= 1 << bit
        values.append(value)
    middle = rng.getrandbits(64)
    for _ in range(400):  # a dense group, larger than what is compared in pairs
        value = middle
        for bit in rng.sample(range(40), rng.randint(0, 3)):
            value ^= 1 << bit
        values.append(value)
    values = sorted(set(values))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    links = hamming_links(spark.createDataFrame(signed, "fp long"), split_rows).collect()
    pairs = {(r.a % (1 << 64), r.b % (1 << 64)) for r in links}
    assert all(0 < bin(a ^ b).count("1") <= 4 for a, b in pairs)
    place = {v: k for k, v in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        x, y = sorted((find(place[a]), find(place[b])))
        root[y] = x
    assert [find(k) for k in range(len(values))] == reach(values)


def test_table_of_odd_rows(spark):
    text = " ".join(f"word{k}" for k in range(80))
    rows = [(7, None), (5, ""), (None, text), (9, text), (9, text), (3, text + " more"), (11, "x y"), (12, "long " * 60000), (None, "alone here")]
    docs = spark.createDataFrame([(a, b, "f") for a, b in rows], "doc_id long, text string, fingerprint string")
    got = near_duplicates(docs).collect()
    marks = [slow_fingerprint(t or "") for _, t in rows]
    roots = reach(marks)
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    want = [(doc_id, f"{m:016x}", least.get(root)) for (doc_id, _), m, root in zip(rows, marks, roots)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_both_sides_of_a_hot_entry_are_cut(spark):
    rng = random.Random(8)
    hot = 12345
    values = {rng.getrandbits(41) << 22 | hot for _ in range(300)}  # table rows of one entry
    values |= {rng.getrandbits(41) << 22 | (hot ^ 1 << rng.randrange(22)) for _ in range(900)}  # that probe it
    split = 50
    probes = _probes(spark.createDataFrame([(v,) for v in values], "fp long"))
    groups = {}
    for r in _entries(probes, split).collect():
        groups.setdefault((r.key, r.piece), []).append((r.fp, r.home))
    assert max(len(g) for g in groups.values()) <= 4 * split
    # every table row of the entry meets every other row of it, as home on one side at least
    met = set()
    for (key, _), rows in groups.items():
        if key == hot:
            homes = [fp for fp, home in rows if home]
            met |= {(a, fp) for a in homes for fp, _ in rows if a != fp}
    inside = [v for v in values if v & (1 << 22) - 1 == hot]
    assert all((a, b) in met for a in inside for b in values - {a} if bin((a ^ b) & (1 << 22) - 1).count("1") <= 1)
