"""Secret scans: keyword prefilter, anchored expressions near the hits, checksum validation.

One Aho-Corasick pass over the folded text finds keywords; an expression is tried only at a hit, anchored there.
Hexadecimal runs have no keyword of their own, so the text is mapped to two letters (hexadecimal digit or not) and
the keyword is a run of 24 of the first. Kinds whose format embeds a checksum are kept only if it agrees.

Nulls and empty texts have no spans. Positions are code points, the end is exclusive. A text of any length is scanned
whole, and rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import binascii
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base expressions, by kind.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# Tokens that end in a checksum of their own body, and the header of a private key.
CHECKED = r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"
PEM = r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*?-----END (?:[A-Z0-9]+ )*PRIVATE KEY-----"
KINDS = ("assign", "access", "hex", "checked", "pem")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_PATTERNS = {
    "assign": re.compile(ASSIGN, re.IGNORECASE | re.ASCII),
    "access": re.compile(ACCESS),
    "hex": re.compile(HEX),
    "checked": re.compile(CHECKED),
    "pem": re.compile(PEM),
}
_KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "pem": ("-----begin ",),
}
_HEX_RUN = b"h" * LEAST_HEX
_HEX_CLASS = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(" ") for c in range(256))

Span = tuple[str, int, int]


def _automaton(words: dict[str, str]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for word, kind in words.items():
        built.add_word(word, (kind, len(word)))
    built.make_automaton()
    return built


def checksum_agrees(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the body in base 62, most significant digit first."""
    value, digits = binascii.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == check


def _valid(kind: str, match: re.Match) -> bool:
    if kind == "assign":
        return len(match[2]) >= LEAST_ASSIGN
    if kind == "access":
        return len(match[0]) >= LEAST_ACCESS
    if kind == "hex":
        return len(match[0]) >= LEAST_HEX
    if kind == "checked":
        return checksum_agrees(match[1], match[2])
    return True


class Scanner:
    """Finds the spans of a text, leftmost and without overlap within a kind."""

    def __init__(self) -> None:
        self.words = _automaton({word: kind for kind, words in _KEYWORDS.items() for word in words})
        self.runs = _automaton({_HEX_RUN.decode(): "hex"})

    def _hits(self, text: str) -> Iterator[tuple[str, int]]:
        # One byte a code point, so that positions stay; what does not fit becomes '?', which no keyword holds.
        narrow = text.encode("latin-1", "replace")
        for end, (kind, length) in self.words.iter(narrow.lower().decode("latin-1")):
            yield kind, end - length + 1
        runs = narrow.translate(_HEX_CLASS)
        if _HEX_RUN in runs:
            for end, (kind, length) in self.runs.iter(runs.decode("latin-1")):
                yield kind, end - length + 1

    def spans(self, text: str | None) -> list[Span]:
        """All spans, by start, then kind as listed."""
        found: list[Span] = []
        if not text:
            return found
        over = dict.fromkeys(KINDS, 0)
        # Keywords that start a match of one kind are never prefixes of each other, so hits come by start.
        for kind, start in self._hits(text):
            if start < over[kind]:
                continue
            if match := _PATTERNS[kind].match(text, start):
                over[kind] = match.end()  # a match that fails its test still uses up its characters
                if _valid(kind, match):
                    found.append((kind, start, match.end()))
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span, overlaps merged, replaced by the kind of its first."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind} removed]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


_FIELDS = "array<struct<kind:string,start:int,end:int>>"


def scan(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per row: the carried columns, ``spans``, and ``clean``: the text without its secrets."""
    fields = [f for f in docs.select(*carry).schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"spans {_FIELDS}", "clean string"])
    kept = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            texts = batch.column(len(fields)).to_pylist()
            spans = [scanner.spans(x) for x in texts]
            rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in found] for found in spans]
            clean = [redacted(x, s) for x, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(fields)], pa.array(rows, kept), pa.array(clean, pa.string())],
                names=[*(f.name for f in fields), "spans", "clean"],
            )

    return docs.select(*carry, F.col(text).cast("string")).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """Counts and hashes of the spans of each document, as registered."""

    def run(batches):
        scanner = Scanner()
        for batch in batches:
            found = [scanner.spans(x) for x in batch.column(1).to_pylist()]
            base = [[s for s in spans if s[0] in KINDS[:3]] for spans in found]
            count = lambda kind: pa.array([sum(s[0] == kind for s in b) for b in base], pa.int64())
            hashes = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(count(k) for k in KINDS[:3]),
                    pa.array(hashes, pa.string()),
                    pa.array([joined(s) for s in found], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)
