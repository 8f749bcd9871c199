"""Secret scanning: pattern matches, plus encoded keys and tokens confirmed by their structure.

Long base64 and hex runs, PEM blocks and dotted tokens are only candidates. They are decoded, and reported only if what
they hold parses: nested DER lengths that add up exactly, SSH wire strings that start with a key type, JSON headers of
signed tokens that name an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import carried_id

#: The base patterns, and kinds in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "jwt", "pem", "der", "ssh")
SSH_TYPES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521")

ASSIGN_WORDS = ("passw", "secret", "token", "api")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(?=([A-Za-z0-9_-]{14,})\.([A-Za-z0-9_-]{3,})\.([A-Za-z0-9_-]*))")  # {"alg":""} has 14 digits, {} has 3
PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----((?:\s*[A-Za-z][A-Za-z0-9-]*:[^\n]*\n)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
ENCRYPTED = re.compile(r"Proc-Type:\s*4,\s*ENCRYPTED\s+DEK-Info:\s*[A-Z0-9-]+,\s*((?:[0-9A-Fa-f]{2}){8,})\s")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
NEXT_LINE = re.compile(r"[\x20\t]*\r?\n[\x20\t]*([A-Za-z0-9+/_-]+)(={0,2})")
LONG_HEX = re.compile(r"(?:[0-9A-Fa-f]{2}){24,}")
SPACED_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{2}(?:[:\x20-][0-9A-Fa-f]{2}|[:\x20]?\r?\n[\x20\t]*[0-9A-Fa-f]{2}){23,}(?![0-9A-Fa-f])")


def decoded(run: str) -> bytes | None:
    """The bytes of a base64 run of either alphabet, padded or not; None if it is none."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, start: int = 0, end: int | None = None, depth: int = 0) -> int | None:
    """The number of DER values that fill data[start:end] exactly, nested ones included; None if the lengths disagree."""
    end, count = len(data) if end is None else end, 0
    while start < end:
        if end - start < 2 or depth > 12:
            return None
        tag, size, start = data[start], data[start + 1], start + 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or start + width > end:
                return None
            size, start = int.from_bytes(data[start : start + width]), start + width
        if start + size > end:
            return None
        count += 1
        if tag & 0x20:
            inner = der_items(data, start, start + size, depth + 1)
            if inner is None:
                return None
            count += inner
        start += size
    return count


def key_kind(data: bytes) -> str | None:
    """'der' or 'ssh' if the bytes are one whole key encoding."""
    if data[:1] == b"\x30" and len(data) >= 24 and (der_items(data) or 0) >= 3 and data[:2] != b"\x30\x00":
        return "der"
    if data.startswith(b"openssh-key-v1\x00"):
        return "ssh"
    if len(data) > 8 and (size := int.from_bytes(data[:4])) <= 32 and data[4 : 4 + size] in SSH_TYPES:
        at = 0
        while at + 4 <= len(data):  # length-prefixed fields must fill the blob
            at += 4 + int.from_bytes(data[at : at + 4])
        return "ssh" if at == len(data) else None
    return None


def is_signed_token(header: str, payload: str) -> bool:
    try:
        head, body = (json.loads(decoded(part) or b"") for part in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def starts_object(run: str, at: int) -> bool:
    """Whether the first digits from `at` on may be those of a JSON object."""
    head = (decoded(run[at : at + 400]) or b"{\"").lstrip(b"\t\n\r ")
    return not head or (head[:1] == b"{" and head[1:].lstrip(b"\t\n\r ")[:1] in (b"", b'"', b"}"))


def starts(run: str, least: int, first: tuple[str, ...]) -> Iterator[int]:
    """0, and places after a '_', '-' or '/' from which `least` digits are left and the digits start like `first`."""
    yield 0
    for m in re.finditer("[_/-]", run):
        if len(run) - m.end() >= least and run.startswith(first, m.end()):
            yield m.end()


#: How base64 of what `key_kind` takes starts, and of a JSON object, which may begin with white space.
KEY_STARTS, JSON_STARTS = ("M", "AAAA", "b3BlbnNz"), ("e", "I", "C", "D")


def key_in(digits: str, at: int, end: int) -> str | None:
    """What `key_kind` says of base64 digits[at:end], without padding. The outermost lengths are followed first, each from a
    few digits; only if they add up is the rest decoded. So what is no key costs little, however long it is."""
    size = (end - at) * 3 // 4
    if (end - at) % 4 == 1:
        return None

    def read(place: int, n: int) -> bytes:
        first = at + place // 3 * 4
        return (decoded(digits[first : min(end, first + 4 * (n // 3 + 2))]) or b"")[place % 3 : place % 3 + n]

    head, place = read(0, 40), 0
    if head[:1] == b"\x30":
        while place < size:
            value = read(place, 6)
            if len(value) < 2:
                return None
            length, width = value[1], 0
            if length >= 0x80:
                width = length & 0x7F
                if not 1 <= width <= 4 or len(value) < 2 + width:
                    return None
                length = int.from_bytes(value[2 : 2 + width])
            place += 2 + width + length
    elif head.startswith(b"openssh-key-v1\x00"):
        place = size
    elif int.from_bytes(head[:4]) <= 32 and head[4 : 4 + int.from_bytes(head[:4])] in SSH_TYPES:
        while place + 4 <= size:
            place += 4 + int.from_bytes(read(place, 4))
    return key_kind(decoded(digits[at:end]) or b"") if place == size else None


class Lines:
    """Base64 lines that follow one another up to a padded one: their digits, joined once, and where each begins and ends."""

    def __init__(self, text: str, m: re.Match) -> None:
        parts, self.ends, starts_, padded = [m[0].rstrip("=")], [m.end()], [m.start()], m[0].endswith("=")
        while not padded and (n := NEXT_LINE.match(text, self.ends[-1])):
            parts.append(n[1])
            self.ends.append(n.end())
            starts_.append(n.start(1))
            padded = bool(n[2])
        self.line = {start: i for i, start in enumerate(starts_)}
        self.digits, self.at = "".join(parts), [0, *accumulate(map(len, parts))]
        self.width = [e - s for s, e in zip(starts_, self.ends, strict=True)]  # with padding
        self.width[-1] = len(parts[-1])
        # from each line on, the first that is of another width
        self.other = [len(parts)] * len(parts)
        for i in range(len(parts) - 2, -1, -1):
            self.other[i] = self.other[i + 1] if self.width[i] == self.width[i + 1] else i + 1

    def wrapped(self, i: int) -> Iterator[int]:
        """How many lines a run from line i on may have: lines of one width, then one that may be shorter; or one less."""
        if i + 1 == len(self.width):
            return
        last = self.other[i + 1]
        if last < len(self.width) and self.width[last] < self.width[i + 1]:
            last += 1
        for end in range(last, max(i + 1, last - 2), -1):
            yield end - i


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the pattern matches, in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]  # runs are maximal, so 16 can be asked at once
    return found


def structural_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of candidates whose decoded structure confirms a key or a signed token."""
    found = []
    if text.count(".") > 1:
        for m in JWT.finditer(text):
            header, payload = m[1], m[2]
            at = next((at for at in starts(header, 14, JSON_STARTS) if starts_object(header, at) and is_signed_token(header[at:], payload)), None)
            if at is not None:
                found.append((m.start() + at, "jwt", m.end(3)))
    starts_, ends = [], []  # of what is found, in order; no two overlap

    def covered(at: int) -> bool:
        before = bisect_right(starts_, at) - 1
        return before >= 0 and at < ends[before]

    def cover(start: int, end: int) -> None:
        at = bisect_right(starts_, start)
        starts_.insert(at, start)
        ends.insert(at, end)

    if "-----BEGIN" in text:
        for m in PEM.finditer(text):
            data = decoded(re.sub(r"\s+", "", m[3]))
            if data and (key_kind(data) or (data[:1] == b"\x30" and der_items(data)) or (ENCRYPTED.search(m[2]) and len(data) >= 32 and len(data) % 8 == 0)):
                found.append((m.start(), "pem", m.end()))
                cover(*m.span())
    lines = None
    for m in BASE64.finditer(text):
        if covered(m.start()):
            continue
        if lines is None or m.start() not in lines.line:
            lines = Lines(text, m)
        i = lines.line[m.start()]
        tries = ((at, key_in(lines.digits, lines.at[i] + at, lines.at[i + n]), lines.ends[i + n - 1]) for n in lines.wrapped(i) for at in starts(m[0], 4, KEY_STARTS))
        if hit := next((t for t in tries if t[1]), None):
            found.append((m.start() + hit[0], hit[1], hit[2]))
            cover(m.start(), hit[2])
    for m in BASE64.finditer(text):
        if covered(m.start()):
            continue
        run, end = m[0], len(m[0].rstrip("="))
        if hit := next(((at, kind) for at in starts(run, 40, KEY_STARTS) if (kind := key_in(run, at, end))), None):
            found.append((m.start() + hit[0], hit[1], m.end()))
    plain_hex = lambda run: bytes.fromhex(re.sub(r"[^0-9A-Fa-f]", "", run))
    for pattern, decode in ((LONG_HEX, bytes.fromhex), (SPACED_HEX, plain_hex)):
        for m in pattern.finditer(text):
            if not covered(m.start()) and (kind := key_kind(decode(m[0]))):
                found.append((m.start(), kind, m.end()))
    return found


def _ordered(spans: list[tuple[int, str, int]]) -> list[tuple[int, str, int]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def scan_text(text: str | None) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, int]]]:
    """(base spans, all spans), each by start and then kind."""
    text = text or ""
    base = base_spans(text)
    return _ordered(base), _ordered(base + structural_spans(text))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>, base array of the same) for each row of `docs`.

    Whole texts are read. A null text is an empty one and has no spans; repeated rows are scanned each on their own; an
    empty table gives an empty result; other columns are not looked at. Narrow: no shuffle.
    """
    doc_id, kind = carried_id(docs, id_col)
    span = "array<struct<kind: string, start: int, end: int>>"

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [scan_text(text) for text in batch["text"]]
            as_rows = [[[{"kind": k, "start": a, "end": b} for a, k, b in spans] for spans in pair] for pair in rows]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": [r[1] for r in as_rows], "base": [r[0] for r in as_rows]})

    found = docs.select(doc_id.alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(scan, f"doc_id {kind}, spans {span}, base {span}")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))


def span_digests(found: DataFrame) -> DataFrame:
    """The counts and digest columns of `scan_secrets`' result."""

    def text_of(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text_of("base"), 256).alias("base_sha256"), text_of("spans").alias("spans"))


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each confirmed stretch replaced; overlapping spans become one mark."""
    if not text:
        return text
    out, at = [], 0
    for start, _, end in scan_text(text)[1]:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]]) if at else text


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs`, all rows and columns, with secrets in the text replaced by `mark`; null and clean texts are unchanged."""

    @F.pandas_udf("string")
    def redact(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(text, mark) for text in texts], dtype=object)

    return docs.withColumn(text_col, redact(F.col(text_col)))
