import hashlib
import math
import random
import re

from spanledger.llm.disclosure import KINDS, DisclosureParams, private_digest, sanitised

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int("0" + x.lstrip("0")) <= 255 for x in value.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), KINDS.index(k), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if good(k, m[0])]
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in private_digest(docs).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        want = brute(text or "")
        assert got[k].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (text[:200], got[k], want[:200])
        assert [got[k][f"n_{x}"] for x in KINDS[:4]] == [want.count(f"{x}:") for x in KINDS[:4]]
    return got


def test_base_spans(spark):
    rng = random.Random(3)
    alphabet = ["a", "Z", "0", "1", "4", "25", "255", "256", ".", ".", "@", "-", " ", "+", "(", ")", "_", "%", "é", "😀", "a@b.c", "1.2.3.4", "+1 23", "4111 1111 1111 1111", "\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += [
        "", None, "a@b.c_d@e.f x@y", "a@b..c a@b.-", "1.2.3 1.2.3.4.5.6.7.8", "000255.0.0.1 256.1.1.1", "4111-1111-1111-1111",
        "79927398713 4111  1111 1111 1111", "+1 (017) 555-7713 +12", "😀 x@y.zz 😀 +441234567890", "5" * 3000, "1 " * 4000,
        "a" * 50000 + "@", "a." * 20000 + "@b.c", "1." * 20000, "+" + "1 " * 9000, "0" * 9000 + ".1.1.1",
    ]
    check(spark, texts)


def corpus():
    """A name stands near one address in many texts and is used alone in few; common words stand everywhere."""
    rng = random.Random(4)
    words = [*[f"word{k}" for k in range(30)], "from"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(k, text(40)) for k in range(300)]
    rows += [(400 + k, f"{text(12)} Quillon wrote from quill@mail.example.com to {text(12)}") for k in range(8)]
    rows += [(500, f"{text(10)} quillon alone {text(5)}"), (None, f"{text(3)} again QUILLON."), (501, "xquillon and quillonx")]
    rows += [(600 + k, f"{text(10)} once{k} u{k}@host.example.com {text(10)}") for k in range(20)]
    return rows


def test_terms_that_reveal_a_value(spark):
    rows = corpus()
    docs = spark.createDataFrame([(a, b, "s") for a, b in rows], "doc_id long, text string, spans string")
    got = {(r.doc_id): r for r in private_digest(docs).collect()}
    for doc_id, text in rows:
        row = got[doc_id]
        spans = [s.split(":") for s in row.spans.split(",") if s]
        added = [text[int(a) : int(b)].lower() for k, a, b in spans if k in KINDS[4:]]
        marked = [m for m in re.findall(r"[^\W_]+", text.lower()) if m in ("quillon", "wrote")]
        assert added == marked, (text, row.spans)
        assert row.base_sha256 == hashlib.sha256(brute(text).encode()).hexdigest()
        assert row.n_terms == len(added)
    clean = {r.doc_id: r.text for r in sanitised(docs).collect()}
    assert "quill" not in clean[400].lower() and "[email]" in clean[400]
    assert "quillon" not in clean[500].lower() and clean[501] == "xquillon and quillonx"
    assert clean[0] == rows[0][1] and len(clean) == len(rows)


def test_joins_beyond_the_broadcast_bound_give_the_same(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    one, other = (sorted(map(repr, private_digest(docs, DisclosureParams(broadcast_rows=n)).collect())) for n in (0, 10**6))
    assert one == other
    assert private_digest(docs.limit(0)).count() == 0 and sanitised(docs.limit(0)).count() == 0


def terms_of(text):
    return [t for t in re.findall(r"[^\W_]+", text.lower()) if len(t) >= 3 and re.search(r"[^\W\d_]", t)]


def naive_terms(texts, params):
    """Disclosure of each term by its definition: all terms beside all values, documents counted one by one."""
    values, near = [], set()
    for text in texts:
        held = set()
        for k, p in PATTERNS.items():
            for m in re.finditer(p, text):
                if not good(k, m[0]):
                    continue
                entity = (k, m[0].lower() if k == "email" else m[0] if k == "ip" else re.sub("[^0-9]", "", m[0]))
                held.add(entity)
                low = max(0, m.start() - params.reach)
                left, right = terms_of(text[low : m.start()]), terms_of(text[m.end() : m.end() + params.reach])
                left = left[1:] if low else left
                right = right[:-1] if len(text) > m.end() + params.reach else right
                near |= {(entity, t) for t in left[-params.window :] + right[: params.window]}
        values.append(held)
    words, z, out = [set(terms_of(t)) for t in texts], params.deviations, {}
    for entity, term in near:
        docs = [k for k in range(len(texts)) if entity in values[k]]
        both = [k for k in docs if term in words[k]]
        if len(docs) == len(texts):
            continue
        p = len(both) / sum(term in w for w in words)
        n = len({texts[k] for k in both}) / p
        low = (p + z * z / 2 / n - z * math.sqrt(max(0, p * (1 - p) / n) + z * z / 4 / n / n)) / (1 + z * z / n)
        bits = math.log2(len(texts) / len(docs))
        out[term] = max(out.get(term, -9), (math.log2(low) + bits) / bits)
        assert low <= p + 1e-12
    return {t: x for t, x in out.items() if x >= params.generalise}


def added_terms(rows, texts):
    """{lower-case term: kinds} of the added spans."""
    out = {}
    for row, text in zip(rows, texts):
        for kind, a, b in (s.split(":") for s in row.spans.split(",") if s):
            if kind in KINDS[4:]:
                out.setdefault(text[int(a) : int(b)].lower(), set()).add(kind)
    return out


def test_terms_equal_a_naive_count(spark):
    rng = random.Random(9)
    common = [f"w{k:03d}x" for k in range(60)]
    texts = [" ".join(rng.choice(common) for _ in range(rng.randint(5, 60))) for _ in range(500)]
    for k in range(60):  # values in one to six texts, beside words of their own, of a few, and of all
        value = rng.choice([f"p{k}@host.example.org", f"10.0.{k}.7", f"+1 555 {k:03d} 4567"])
        for _ in range(rng.choice([1, 1, 2, 3, 6])):
            parts = rng.choices(common, k=30)
            parts[rng.randint(3, 26)] = f"{value}"
            for word in (f"own{k}", f"few{k % 7}", f"away{k}"):
                parts.insert(rng.randint(0, len(parts)), word)
            texts.append(" ".join(parts))
    texts += [texts[-1]] * 40  # copies add no confidence
    texts += [f"{rng.choice(common)} own{k} alone" for k in range(0, 60, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for params in (DisclosureParams(), DisclosureParams(generalise=0.5, remove=0.7, broadcast_rows=0)):
        want = naive_terms(texts, params)
        got = added_terms(sorted(private_digest(docs, params).collect(), key=lambda r: r.doc_id), texts)
        assert {t: {KINDS[5] if x >= params.remove else KINDS[4]} for t, x in want.items()} == got
        assert any(t.startswith("own") for t in got) and not any(t.startswith("w0") for t in got)


def test_whole_table_gains_terms_that_a_naive_count_confirms(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(private_digest(docs).collect(), key=lambda r: r.doc_id)
    text_of = {r.doc_id: r.text or "" for r in docs.collect()}
    texts = [text_of[r.doc_id] for r in rows]
    want = naive_terms(texts, DisclosureParams())
    assert sum(r.n_terms for r in rows) > 0 and set(added_terms(rows, texts)) == set(want)
