"""Secrets in texts: patterns, and structural confirmation of encoded keys and signed tokens."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import map_rows, texts, whole_row

# fixed values: the base patterns
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run of 16 or more is the same as a run that is dropped when shorter
_HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "signed_token", "private_key", "encoded_key")

_SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])ey[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
_PLAIN = re.compile(r"[A-Za-z0-9+/=\s,:\x01-]*")
_REST = re.compile(r"(?:\s*+[A-Za-z0-9-]++:[^\n]*+\n)*+[A-Za-z0-9+/=\s\x01]*+")
_LINE = re.compile(r"[A-Za-z0-9+/\x01]+={0,2}")
# base64 of 32 or more on the first line, with the lines that follow it; hex as well
_RUNS = re.compile(r"[A-Za-z0-9+/_\x01-]{32,}+(?:[\x20\t\r]*+\n\s*+[A-Za-z0-9+/_\x01-]++)*+={0,2}")
_HEX_RUNS = re.compile(r"[0-9a-fA-F]{64,}+(?:[\x20\t\r]*+\n\s*+[0-9a-fA-F]++(?![A-Za-z0-9+/_-]))*+")
_WORD = re.compile(r"[^\s=]+")
_ESCAPE = re.compile(r"\\+(?:[rnt/]|u00[0-9a-fA-F]{2})")
_OPENSSH = b"openssh-key-v1\0"


def _decode(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def _claims(text: str) -> dict | None:
    raw = _decode(text)
    try:
        value = json.loads(raw.decode()) if raw else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    """Header and payload decode to JSON objects, the header names an algorithm; only ``none`` may be unsigned."""
    header, payload, signature = text.split(".")
    claims = _claims(header)
    if not claims or not isinstance(claims.get("alg"), str) or _claims(payload) is None:
        return False
    return _decode(signature) is not None and (bool(signature) or claims["alg"].lower() == "none")


def _der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of values whose lengths fill the range exactly, else None."""
    items, at = [], start
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            count = size & 0x7F
            if not 1 <= count <= 4 or at + count > end:
                return None
            size = int.from_bytes(data[at : at + count], "big")
            at += count
        if at + size > end:
            return None
        items.append((tag, at, at + size))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """One sequence that fills the bytes, with a small version number first and at least two more values (numbers, octets,
    or an algorithm sequence holding an object identifier) whose nested lengths all agree."""
    outer = _der_items(data, 0, len(data))
    if outer is None or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    items = _der_items(data, *outer[0][1:])
    if items is None or len(items) < 3:
        return False
    tag, start, end = items[0]
    if tag != 0x02 or end - start != 1 or data[start] > 3:
        return False
    for tag, start, end in items[1:]:
        if tag & 0x20:
            inner = _der_items(data, start, end)
            if not inner:
                return False
        elif tag not in (0x02, 0x03, 0x04, 0x05, 0x06) or (end == start and tag != 0x05):
            return False
    return all(t == 0x02 for t, _, _ in items) or any(t in (0x04, 0x30) for t, _, _ in items[1:])


def is_openssh_key(data: bytes) -> bool:
    """Magic, then three length-prefixed strings (cipher, derivation, options), a key count, and a public key."""
    if not data.startswith(_OPENSSH):
        return False
    at = len(_OPENSSH)
    for k in range(3):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or (k < 2 and not 1 <= size <= 64):
            return False
        at += 4 + size
    keys = int.from_bytes(data[at : at + 4], "big")
    size = int.from_bytes(data[at + 4 : at + 8], "big")
    return 1 <= keys <= 16 and size > 0 and at + 8 + size <= len(data)


def is_key(data: bytes | None) -> bool:
    return bool(data) and (is_openssh_key(data) or is_der_key(data))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base patterns; a failing match is dropped and not searched again."""
    spans = [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return spans


def _unescaped(text: str) -> str:
    """The text with written escapes (of line breaks, tabs, slashes, base64 characters) as what they stand for, every character at its
    place: \x01 fills."""

    def plain(m):
        what = m[0].lstrip("\\")
        if what in "rt":
            return " " * len(m[0])
        char = "\n" if what == "n" else "/" if what == "/" else chr(int(what[1:], 16))
        return char.rjust(len(m[0]), " " if char == "\n" else "\x01") if char in "\n/+=-" else m[0]

    return _ESCAPE.sub(plain, text) if "\\" in text else text


def _size(data: bytes) -> int:
    """Bytes of the DER value or OpenSSH key that ``data`` begins with, as its lengths say; 0 if it begins with neither."""
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        for k in range(3):
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        at += 4
        for _ in range(int.from_bytes(data[at - 4 : at], "big") % 17 + 1):  # the public keys and the private part
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return at if at <= len(data) else len(data)
    if len(data) < 2 or data[0] != 0x30:
        return 0
    count = data[1] & 0x7F if data[1] & 0x80 else 0
    if count > 4 or data[1] == 0x80:
        return 0
    return 2 + count + (int.from_bytes(data[2 : 2 + count], "big") if count else data[1])


def _begins_key(head: bytes) -> bool:
    """An OpenSSH key, or a DER sequence that begins with a number of one byte."""
    at = 2 + (head[1] & 0x7F if len(head) > 1 and head[1] & 0x80 else 0)
    return head.startswith(_OPENSSH) or (_size(head) > 0 and head[at : at + 2] == b"\x02\x01")


def _base64_part(chars: str) -> tuple[bytes, int, int]:
    """(decoded bytes, characters, bytes that they stand for) of base64 that may go on with other words."""
    chars = chars.split("=")[0]
    return _decode(chars[: len(chars) - (len(chars) % 4 == 1)]) or b"", 4, 3


def _hex_part(chars: str) -> tuple[bytes, int, int]:
    return bytes.fromhex(chars[: len(chars) // 2 * 2]), 2, 1


def _armoured(view: str) -> list[tuple[int, int]]:
    """Keys in armour; the end line may be missing, then the key's own lengths tell its end."""
    found = []
    marks = list(_MARK.finditer(view)) if "-----BEGIN " in view else []
    for m, after in zip(marks, [*marks[1:], None]):
        if m[1] != "BEGIN":
            continue
        closed = after is not None and after[1] == "END" and after[2] == m[2]
        stop = after.start() if after is not None else len(view)
        body = view[m.end() : stop] if closed else _REST.match(view, m.end(), stop)[0]
        legacy = "ENCRYPTED" in body
        places, at = [], m.end()
        for line in body.split("\n"):
            if ":" not in line:
                places += [at + k for k, c in enumerate(line) if c.isascii() and (c.isalnum() or c in "+/=")]
            at += len(line) + 1
        chars = "".join([view[k] for k in places])
        data, _, _ = _base64_part(chars)
        size = _size(data)
        part = data[:size] if size else data
        whole = bool(size) and size <= len(data) and _der_items(part, 0, len(part)) is not None
        if closed:
            if is_key(part) or (_PLAIN.fullmatch(body) and data and (legacy or (whole and "ENCRYPTED" in m[2]))):
                found.append((m.start(), after.end()))
        elif is_key(part) or (whole and "ENCRYPTED" in m[2]):
            end = places[-(-len(part) * 4 // 3) - 1] + 1
            found.append((m.start(), end + len(re.match("={0,2}", view[end : end + 2])[0])))
        elif legacy:
            # nothing tells its end but the first line that is not base64
            end = at = m.end()
            for line in body.split("\n"):
                if _LINE.fullmatch(line.strip()) and (len(line.strip()) >= 32 or end > m.end()):
                    end = at + len(line.rstrip())
                elif end > m.end():
                    break
                at += len(line) + 1
            if end > m.end():
                found.append((m.start(), end))
    return found


def _encoded(view: str, pattern: re.Pattern, decoded, nested: bool):
    """(start, end) of keys in the encoded runs, and of runs that hold a text with keys; any line of a run may be the first of a key."""
    for run in pattern.finditer(view):
        words = [(w.start(), w.end()) for w in _WORD.finditer(view, run.start(), run.end())]
        done = 0
        for k, (start, end) in enumerate(words):
            if start < done or end - start < 32:
                continue
            head, each, bytes_each = decoded(view[start : min(end, start + 64)].replace("\x01", ""))
            pem = head.startswith(b"-----BEGIN ") or (k == 0 and not nested)
            if not _begins_key(head) and not pem:
                continue
            # as many lines as the lengths ask for
            need = None if pem or head.startswith(_OPENSSH) else -(-_size(head) * each // bytes_each)
            places: list[int] = []
            for a, b in words[k:]:
                places += [x for x in range(a, b) if view[x] != "\x01"]
                if need is not None and len(places) >= need:
                    break
            data, _, _ = decoded("".join([view[x] for x in places]))
            size = _size(data)
            if size and is_key(data[:size]):
                last = places[-(-size * each // bytes_each) - 1] + 1
            elif pem and not nested and b"PRIVATE KEY-----" in data:
                inner = [e for _, kind, e in structural_spans(data.decode("latin-1"), True) if kind == "private_key"]
                if not inner:
                    continue
                at = places[-(-max(inner) * each // bytes_each) - 1]
                last = next(b for a, b in words if a <= at < b)
            else:
                continue
            done = last + len(re.match("={0,2}", view[last : last + 2])[0])
            yield start, done


def structural_spans(text: str, nested: bool = False) -> list[tuple[int, str, int]]:
    """Spans whose decoded form parses as a key or a signed token, or is a text that holds an armoured key (``nested``: the text is
    such a decoded one)."""
    spans = []
    if "ey" in text and "." in text:
        spans += [(m.start(), "signed_token", m.end()) for m in _SIGNED.finditer(text) if is_signed_token(m[0])]
    view = _unescaped(text)
    armoured = _armoured(view)
    spans += [(a, "private_key", b) for a, b in armoured]
    starts = [a for a, _ in armoured]
    keys = sorted({*_encoded(view, _RUNS, _base64_part, nested), *_encoded(view, _HEX_RUNS, _hex_part, nested)})
    for start, end in keys:
        k = bisect_right(starts, start) - 1
        if k < 0 or start >= armoured[k][1]:
            spans.append((start, "encoded_key", end))
    return spans


def _joined(spans: list[tuple[int, str, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in sorted(spans, key=lambda s: (s[0], order[s[1]], s[2])))


def redact(text: str, spans: list[tuple[int, str, int]]) -> str:
    """Replace the union of the spans; overlapping spans give one mark with the kind of the first."""
    out, at = [], 0
    merged: list[list] = []
    for start, kind, end in sorted(spans):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, kind, end])
    for start, kind, end in merged:
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_structural, base_sha256, spans of every whole text.

    Spans are kind:start:end in code points, end exclusive. Null and empty texts have none (digest of the empty string); a
    null id stays null; repeated rows give repeated rows; other columns are not read. One map, no shuffle.
    """
    ddl = (
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
        "n_structural bigint"
    )

    def rows(batches):
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                base = base_spans(text)
                added = structural_spans(text)
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                counts = [kinds.count(k) for k in KINDS[:3]]
                yield doc_id, *counts, digest, _joined(base + added), len(added)

    return map_rows(texts(docs, id_col, text_col), rows, ddl)


def redact_secrets(docs: DataFrame, text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets, all rows and columns kept; a null text stays null, an
    empty one empty; repeated rows are redacted alike; an empty table gives an empty one. ``count_col``, if present, becomes the new
    number of characters where the text changed."""

    @F.pandas_udf("string")
    def cleaned(column):
        return column.map(lambda t: t if t is None else redact(t, base_spans(t) + structural_spans(t)))

    pairs = docs.select(whole_row(docs), cleaned(F.col(text_col).cast("string")).alias("cleaned"))
    old, new = F.col(f"doc.`{text_col}`"), F.col("cleaned")
    columns = {c: F.col(f"doc.`{c}`") for c in docs.columns} | {text_col: new.alias(text_col)}
    if count_col in columns:
        counted = F.when(~new.eqNullSafe(old), F.length(new).cast("long")).otherwise(columns[count_col])
        columns[count_col] = counted.alias(count_col)
    return pairs.select(*columns.values())
