r"""Secret scan with structural confirmation.

Three base patterns report by shape alone. Beyond them, long base64 and hex
candidates are decoded and reported only if what they hold parses:

* ``signed``: a three-part token whose header decodes to a JSON object naming
  an algorithm and whose payload decodes to a JSON object, also behind a dotted word;
* ``key``: base64 or hex (bare or between BEGIN/END key lines) that decodes
  to DER whose nested lengths add up and whose fields are those of a private
  key (version first; then integers, an octet string, or an algorithm); base64
  may be broken into lines, by line breaks or by escapes such as \n;
* ``ssh``: base64 that decodes to the OpenSSH key magic followed by fields
  whose length prefixes fit.

A secret has no context beyond its own text, so the scan is one map over
rows without a shuffle.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import table
from llm.words import slices

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "signed", "key", "ssh")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")  # whole runs: what [0-9a-f]+ finds, of 16 and more
_SIGNED = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]*)")
_ARMOUR = re.compile(r"""-----BEGIN ([A-Z0-9 ]{0,40})KEY-----((?:[A-Za-z0-9+/=\s"',]|\\+(?:[nrt/\s]|u000[aAdD]))+)-----END \1KEY-----""")
_ESCAPED = re.compile(r"""\\+(?:[nrt\s]|u000[aAdD]|(?=/))|[\s"',]""")
# the first line of a DER sequence or of the OpenSSH magic, also right after an escaped line break
_BASE64 = re.compile(r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nr])|(?<=\\u000[aAdD]))(?:M|b3BlbnNzaC1rZXktdjE)[A-Za-z0-9+/_-]{31,}={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_BREAK = re.compile(r"""(?:[ \t"',]*(?:\\*\r?\n|\\+[nr]|\\+u000[aAdD]))+[ \t"',]*""")
_HEXDER = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")


def _decoded(text: str) -> bytes | None:
    text = re.sub(r"\s+", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    raw = _decoded(part)
    try:
        found = json.loads(raw.decode("utf-8")) if raw else None
    except (UnicodeDecodeError, ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _fields(raw: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """DER elements (tag, from, to) that fill raw[at:end] exactly, or None."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, n, at = raw[at], raw[at + 1], at + 2
        if n & 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or at + size > end:
                return None
            n, at = int.from_bytes(raw[at:at + size], "big"), at + size
        if at + n > end:
            return None
        out.append((tag, at, at + n))
        at += n
    return out


def is_private_der(raw: bytes | None) -> bool:
    """A DER sequence, lengths exact, with the fields of a private key."""
    if not raw or raw[0] != 0x30:
        return False
    top = _fields(raw, 0, len(raw))
    if not top or len(top) != 1:
        return False
    inner = _fields(raw, *top[0][1:])
    if not inner or len(inner) < 3 or inner[0][0] != 2 or inner[0][2] - inner[0][1] != 1:
        return False
    tags = [t for t, _, _ in inner]
    if len(tags) >= 6 and all(t == 2 for t in tags):  # integers only: RSA, DSA
        return True
    if tags[1] == 0x30 and tags[2] == 4:  # algorithm and octets
        algorithm = _fields(raw, *inner[1][1:])
        return bool(algorithm) and algorithm[0][0] == 6
    return tags[1] == 4 and all(t in (0xA0, 0xA1) for t in tags[2:])  # elliptic curve


def is_ssh_private(raw: bytes | None) -> bool:
    """The OpenSSH magic, then cipher, key derivation, options, one key or more."""
    magic = b"openssh-key-v1\0"
    if not raw or not raw.startswith(magic):
        return False
    at, left = len(magic), 3
    while left:
        if at + 4 > len(raw):
            return False
        n = int.from_bytes(raw[at:at + 4], "big")
        at, left = at + 4 + n, left - 1
    return at + 4 <= len(raw) and int.from_bytes(raw[at:at + 4], "big") >= 1


def _key_at(text: str, m: re.Match) -> tuple[int, int] | None:
    """(place of the kind in KINDS, end) of the key whose first line is ``m``, over
    as many lines as its lengths ask for."""
    head = _decoded(m[0][:8])
    lines, n, end, need = [m[0]], len(m[0].rstrip("=")), m.end(), None
    if m[0][0] == "M":
        size = head[1] & 0x7F if head and head[0] == 0x30 and head[1] & 0x80 else 0
        if not head or head[0] != 0x30 or size > 4:
            return None
        total = 2 + size + int.from_bytes(head[2:2 + size], "big") if size else 2 + head[1]
        need = -(-total * 4 // 3)
        if need < 64:
            return None
    while not lines[-1].endswith("=") and (n < need if need else len(lines[-1]) == len(lines[0])):
        gap = _BREAK.match(text, end)
        run = _RUN.match(text, gap.end()) if gap else None
        if not run or (not need and (len(run[0]) > len(lines[0]) or (n + len(run[0])) % 4)):
            break
        lines.append(run[0])
        n, end = n + len(run[0].rstrip("=")), run.end()
    if n < 64 or (need and n != need):
        return None
    raw = _decoded("".join(lines))
    kind = 4 if is_private_der(raw) else 5 if is_ssh_private(raw) else None
    return (kind, end) if kind else None


def scan_text(text: str | None) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of every span, sorted; code points."""
    text = text or ""
    found = {(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12}
    found |= {(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18}
    found |= {(m.start(), 2, m.end()) for m in _HEX.finditer(text)}
    m = _SIGNED.search(text)
    while m:
        header = _json_object(m[1])
        token = header and isinstance(header.get("alg"), str) and _json_object(m[2]) is not None
        if token:
            found.add((m.start(), 3, m.end()))
        m = _SIGNED.search(text, m.end() if token else m.start(2))  # a word before the token may have taken its header's place
    armoured = []
    for m in _ARMOUR.finditer(text):
        raw = _decoded(_ESCAPED.sub("", m[2]))
        kind = 4 if is_private_der(raw) else 5 if is_ssh_private(raw) else None
        if kind:
            found.add((m.start(), kind, m.end()))
            armoured.append(m.span())
    for m in _BASE64.finditer(text):
        key = _key_at(text, m)
        if key and (key[1] == m.end() or not any(s <= m.start() < e for s, e in armoured)):
            found.add((m.start(), *key))
    for m in _HEXDER.finditer(text):
        if len(m[0]) % 2 == 0 and is_private_der(bytes.fromhex(m[0])):
            found.add((m.start(), 4, m.end()))
    return sorted(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>), one row per input row.

    Spans are in order of start, then kind as listed in ``KINDS``; ends are
    exclusive and count code points. Null and empty texts have no spans,
    null ids and repeated rows are kept as they are, other columns ignored.
    """
    def run(batches):
        for b in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan_text(t)] for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(spans, _SPANS)], names=["doc_id", "spans"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def redacted(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span, or run of overlapping spans, replaced by
    ``mark``; all other columns and texts are unchanged, null stays null."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in (part for whole in batches for part in slices(whole, at)):
            out = []
            for text in b.column(at).to_pylist():
                spans = scan_text(text)
                if spans:
                    parts, end = [], 0
                    for s, _, e in spans:
                        if s >= end:
                            parts += [text[end:s], mark]
                        end = max(end, e)
                    text = "".join([*parts, text[end:]])
                out.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op5_secrets(spark, sf_dir):
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def said(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
