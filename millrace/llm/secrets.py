"""Secret scan: patterns find candidates, structure confirms them.

Three base kinds are matched as stated patterns. Further kinds are reported only if what they encode can be parsed:
``jwt`` (the first part decodes to JSON that names an algorithm), ``key`` (base64 or hex of nested DER: a sequence whose
lengths fit and that starts with a version or an algorithm, or the length-prefixed fields of an SSH key) and ``pem``
(such a body between the lines that begin and end a private key). Searching takes time in proportion to the text.

Defined results: a null or empty text has no spans; repeated rows and null ids stay; other columns are ignored; an empty
table gives an empty one. Places are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keyed, per_text

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
# Every assignment holds one of these in some case.
NAMES = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "jwt", "key", "pem")

# Parts and dots in a row; a token is three parts of at least so many characters.
DOTTED = re.compile(r"[A-Za-z0-9_.-]{16,}")
HEADER_LEAST, PAYLOAD_LEAST = 10, 4
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
LONG_HEX = re.compile(r"(?:[0-9a-fA-F]{2}){32,}")
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
# No candidate of the structural kinds or of hex has a shorter stretch without blanks.
STRETCH = 24


def unbase64(text: str) -> bytes:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


def der_length(data: bytes, at: int) -> tuple[int, int]:
    """Length of the value whose length field stands at ``at``, and where the value starts; -1 if there is none."""
    if at >= len(data):
        return -1, at
    first = data[at]
    if first < 0x80:
        return first, at + 1
    n = first & 0x7F
    if not 1 <= n <= 4 or at + 1 + n > len(data):
        return -1, at
    return int.from_bytes(data[at + 1:at + 1 + n], "big"), at + 1 + n


def der_fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """The fields of a run of DER values, None unless they fill it exactly."""
    out, at = [], 0
    while at < len(data):
        length, start = der_length(data, at + 1)
        if length < 0 or start + length > len(data):
            return None
        out.append((data[at], data[start:start + length]))
        at = start + length
    return out


def is_der_key(data: bytes) -> bool:
    """A DER sequence, filled exactly, of a small version or a nested sequence and at least one integer, octet or bit string."""
    outer = der_fields(data) if len(data) >= 16 and data[0] == 0x30 else None
    if not outer or len(outer) != 1:
        return False
    inner = der_fields(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    (kind, value), rest = inner[0], inner[1:]
    versioned = kind == 0x02 and len(value) == 1 and value[0] <= 3
    named = kind == 0x30 and bool(fields := der_fields(value)) and fields[0][0] == 0x06
    return (versioned or named) and any(k in (0x02, 0x03, 0x04) and len(v) >= 8 for k, v in rest)


def prefixed_fields(data: bytes, at: int, count: int | None = None) -> tuple[list[bytes], int] | None:
    """``count`` length-prefixed fields (all up to the end if None) and where they end; None if they do not fit."""
    fields = []
    while len(fields) < count if count is not None else at < len(data):
        n = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + n > len(data):
            return None
        fields.append(data[at + 4:at + 4 + n])
        at += 4 + n
    return fields, at


def is_ssh_fields(data: bytes) -> bool:
    """Length-prefixed fields of which the first names an algorithm."""
    found = prefixed_fields(data, 0)
    return found is not None and len(found[0]) >= 2 and re.match(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+$", found[0][0]) is not None


def is_ssh_key(data: bytes) -> bool:
    """The fields of a key, or an OpenSSH private key: cipher, derivation and its options, public keys, private part."""
    if not data.startswith(b"openssh-key-v1\0"):
        return is_ssh_fields(data)
    head = prefixed_fields(data, 15, 3)
    if head is None or not all(re.match(rb"[a-z0-9@.-]+$", name) for name in head[0][:2]):
        return False
    keys = int.from_bytes(data[head[1]:head[1] + 4], "big")
    body = prefixed_fields(data, head[1] + 4, keys + 1) if 1 <= keys <= len(data) // 8 else None
    return body is not None and body[1] == len(data) and all(map(is_ssh_fields, body[0][:-1])) and len(body[0][-1]) >= 8


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_ssh_key(data)


def is_jwt(header: str) -> bool:
    """The header of a signed token: an object that names an algorithm."""
    try:
        head = json.loads(unbase64(header))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str)


def jwts(text: str) -> list[tuple[int, int]]:
    """Spans of tokens. Each part is tried as a header once, so the search is linear whatever the text."""
    out = []
    for run in DOTTED.finditer(text):
        parts = run[0].split(".")
        starts = [run.start(), *(run.start() + k for k in accumulate(len(p) + 1 for p in parts))]
        k = 0
        while k + 2 < len(parts):
            if len(parts[k]) >= HEADER_LEAST and len(parts[k + 1]) >= PAYLOAD_LEAST and is_jwt(parts[k]):
                out.append((starts[k], starts[k + 2] + len(parts[k + 2])))
                k += 3
            else:
                k += 1
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) by start, then kind as listed in KINDS."""
    spans = []
    lower = text.lower()
    if any(x in lower for x in NAMES):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if len(max(text.split(), key=len, default="")) >= STRETCH:
        spans += [("hex", *m.span()) for m in HEX.finditer(text) if m.end() - m.start() >= HEX_LEAST]
        spans += [("jwt", *s) for s in jwts(text)]
        keys = {m.span() for m in BASE64.finditer(text) if is_key(unbase64(m[0]))}
        keys |= {m.span() for m in LONG_HEX.finditer(text) if is_key(bytes.fromhex(m[0]))}
        spans += [("key", *s) for s in keys]
    if "PRIVATE KEY-----" in text:
        spans += [("pem", *m.span()) for m in PEM.finditer(text) if is_key(unbase64("".join(m[2].split())))]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind: string, start: long, end: long>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the spans of each document."""
    return per_text(keyed(docs, id_col, text_col), lambda t: ([{"kind": k, "start": a, "end": b} for k, a, b in find(t)],), f"spans {SPANS}")


def redacted(text: str) -> str:
    """The text with every secret, overlapping ones as one, replaced by the name of its kind."""
    out, at = [], 0
    for kind, start, end in find(text):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found, base = scan_secrets(docs), KINDS[:3]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(written(F.filter("spans", lambda s: s["kind"].isin(*base))).cast("binary"), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"))
