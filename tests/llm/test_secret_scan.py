import base64
import hashlib
import json
import re

from spanledger.llm.secret_scan import base_spans, is_der_key, is_key, redact_secrets, scan_secrets, structural_spans


def der(tag, *parts):
    body = b"".join(parts)
    size = len(body)
    head = bytes([size]) if size < 128 else bytes([0x80 | 2]) + size.to_bytes(2, "big")
    return bytes([tag]) + head + body


RSA = der(0x30, der(2, b"\0"), *[der(2, b"\x01" + bytes(range(60)))] * 8)
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, RSA))
PACK = lambda s: len(s).to_bytes(4, "big") + s
SSH = b"openssh-key-v1\0" + PACK(b"none") + PACK(b"none") + PACK(b"") + (1).to_bytes(4, "big") + PACK(b"pub") + PACK(b"priv")


def b64(raw):
    return base64.b64encode(raw).decode()


def part(value):
    return base64.urlsafe_b64encode(json.dumps(value).encode()).decode().rstrip("=")


TOKEN = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1'})}.c2lnbmF0dXJl"


def naive(text):
    """The base rules word by word."""
    spans = []
    for m in re.finditer(r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?(?P<v>[A-Za-z0-9+/_.=-]+)""", text):
        if len(m["v"]) >= 12:
            spans.append((m.start(), "assign", m.end()))
    spans += [(m.start(), "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def test_base_rules():
    texts = [
        "", "password: abcdefghijkl", "PassWd='x'", "api-key = 123456789012", 'API_KEY = "abc/def+ghi=jkl"', "paſsword=abcdefghijklmn",
        "password: token: abcdefghijkl", "token=secret=abcdefghijklmnop", "AKIA" + "A" * 14, "AKIA" + "B" * 13, "xAKIAAKIA" + "Z" * 20,
        "0123456789abcdef 0123456789abcde fff0123456789ABCDEF", "é😀token : 0123456789abcdef0123", "secret" + " " * 5000 + ":x",
    ]
    for text in texts:
        assert sorted(base_spans(text)) == naive(text), text


def test_structure():
    assert is_key(RSA) and is_key(PKCS8) and is_key(SSH)
    assert not is_der_key(RSA[:-1]) and not is_der_key(RSA + b"\0") and not is_key(b"") and not is_key(SSH[:20])
    assert [k for _, k, _ in structural_spans(f"see {TOKEN} here")] == ["signed_token"]
    for clean in ("eyJhbGciOi.abc.def", f"{part({'typ': 'x'})}.{part({})}.aa", "M" + "A" * 80, "3.14.15 money.com.au"):
        assert structural_spans(clean) == []
    armoured = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(RSA)[:64]}\n{b64(RSA)[64:]}\n-----END RSA PRIVATE KEY-----"
    text = f"a {armoured} b {b64(PKCS8)} c {b64(SSH)} d {RSA.hex()}"
    got = structural_spans(text)
    assert [k for _, k, _ in sorted(got)] == ["private_key", "encoded_key", "encoded_key", "encoded_key"]
    assert text[sorted(got)[0][0] : sorted(got)[0][2]] == armoured


def test_table_of_odd_rows(spark):
    long = "ab " * 50000 + "token = 0123456789abcdef"
    rows = [(1, None, 3), (2, "", 0), (None, TOKEN, 1), (3, TOKEN, 1), (3, TOKEN, 1), (4, long, 9), (5, "clean text", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in scan_secrets(docs.withColumnRenamed("n_chars", "spans")).collect()}
    assert got[1].spans == got[2].spans == got[5].spans == ""
    assert got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[3].spans == got[None].spans == f"signed_token:0:{len(TOKEN)}" and got[3].n_structural == 1
    assert (got[4].n_assign, got[4].n_access, got[4].n_hex) == (1, 0, 1)
    assert got[4].spans == f"assign:150000:{len(long)},hex:150008:{len(long)}"
    assert scan_secrets(docs.limit(0)).count() == 0
    clean = sorted((tuple(r) for r in redact_secrets(docs).collect()), key=repr)
    assert (1, None, 3) in clean and (5, "clean text", 10) in clean and (3, "[signed_token]", 14) in clean and len(clean) == 7
    assert (4, "ab " * 50000 + "[assign]", 150008) in clean


def lines(text, width=64):
    return [text[k : k + width] for k in range(0, len(text), width)]


def test_keys_in_other_forms():
    pem = "\n".join(["-----BEGIN PRIVATE KEY-----", *lines(b64(PKCS8)), "-----END PRIVATE KEY-----", ""])
    ssh = "\n".join(["-----BEGIN OPENSSH PRIVATE KEY-----", *lines(b64(SSH), 70), "-----END OPENSSH PRIVATE KEY-----"])
    bare = "\n".join(lines(b64(PKCS8), 76))
    twice = b64(pem.encode())
    for kind, secret in [
        ("private_key", json.dumps(pem)[1:-1].removesuffix("\\n")),
        ("private_key", pem.replace("\n", "\\r\\n").removesuffix("\\r\\n")),
        ("private_key", json.dumps(json.dumps(ssh)[1:-1])[1:-1]),
        ("private_key", pem.split("\n-----END")[0]),
        ("private_key", ssh.split("\n-----END")[0]),
        ("encoded_key", twice), ("encoded_key", "\n".join(lines(twice, 76))), ("encoded_key", pem.encode().hex()),
        ("encoded_key", bare), ("encoded_key", bare.replace("\n", "\r\n")), ("encoded_key", json.dumps(bare)[1:-1]),
        ("encoded_key", b64(PKCS8).replace("/", "\\/")), ("encoded_key", "\n".join(lines(RSA.hex()))),
    ]:
        for before, after in (('{"key": "', '", "id": 1}'), ("see\n", "\nmore words here\n"), ("x" * 41 + "\n", ""), ("a\\n", "\\nend")):
            text = f"{before}{secret}{after}"
            at = len(before)
            assert (at, kind, at + len(secret)) in structural_spans(text), (kind, before, secret[:40], structural_spans(text))
            assert len(structural_spans(text)) == 1
    for clean in (b64(b"plain text of some length, no key in it at all"), "word/" * 2000, "ab" * 5000, "\n".join(["M" * 64] * 300),
                  "-----BEGIN PRIVATE KEY-----\nnot a key\n", "C:\\new\\table\\run", b64(b"-----BEGIN CERTIFICATE-----" * 3)):
        assert structural_spans(clean) == []


def test_redaction_keeps_columns_of_any_name(spark):
    rows = [(1, "password=abcdefghijkl1 x", "mine", "row", 3), (2, None, "mine", "row", 4), (3, "", "mine", "row", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _cleaned string, doc string, n_chars long")
    got = {r.doc_id: r for r in redact_secrets(docs).collect()}
    assert redact_secrets(docs).columns == docs.columns
    assert {(r._cleaned, r.doc) for r in got.values()} == {("mine", "row")}
    assert "abcdefghijkl1" not in got[1].text and got[1].n_chars == len(got[1].text)
    assert (got[2].text, got[2].n_chars, got[3].text, got[3].n_chars) == (None, 4, "", 0)
