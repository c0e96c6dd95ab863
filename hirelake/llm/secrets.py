"""Secrets in texts: keywords first, anchored patterns at the hits, checksums last.

One Aho-Corasick pass over the lower-cased bytes finds every place where a keyword
starts; a kind's pattern is tried there and nowhere else. Kinds whose tokens carry a checksum count only
if it holds. Runs of hex digits have no keyword; they are looked for in one pass of their own.
"""

import functools
import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from hirelake.llm import common

BASE_KINDS = ("assign", "access", "hex")
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Kind:
    """A kind of secret: where it can start, what it looks like from there, and a last test."""

    name: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern
    holds: object


def _crc_in_base62(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the 30 before them, written with 62 digits."""
    body, check = match.group(1), match.group(2).decode()
    value = 0
    for c in check:
        value = value * 62 + _DIGITS.index(c)
    return value == zlib.crc32(body)


KINDS = (
    Kind(
        "assign", (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-])+)""", re.I),
        lambda m: len(m.group(2)) >= 8,
    ),
    Kind("access", (b"akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 16),
    Kind("hex", (), re.compile(rb"[0-9a-f]{32,}"), lambda m: True),
    Kind("code_host", (b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_"), re.compile(rb"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"), _crc_in_base62),
    Kind("package_host", (b"npm_",), re.compile(rb"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])"), _crc_in_base62),
)
ORDER = {k.name: i for i, k in enumerate(KINDS)}


@functools.lru_cache(maxsize=1)
def _keywords():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for i, kind in enumerate(KINDS):
        for word in kind.keywords:
            machine.add_word(word.decode(), (i, len(word)))
    machine.make_automaton()
    return machine


def scan_bytes(data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes, by start, then kind. Spans of one kind do not overlap, the leftmost wins.

    A match too short or with a wrong checksum still takes its place, so nothing within it counts.
    """
    found = [(m.start(), m.end(), "hex") for m in KINDS[ORDER["hex"]].pattern.finditer(data)]
    hits = sorted((end + 1 - size, i) for end, (i, size) in _keywords().iter(data.lower().decode("latin-1")))
    taken = [0] * len(KINDS)
    for start, i in hits:
        if start < taken[i]:
            continue
        kind = KINDS[i]
        match = kind.pattern.match(data, start)
        if match:
            taken[i] = match.end()
            if kind.holds(match):
                found.append((start, match.end(), kind.name))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


def scan_text(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points."""
    data = text.encode()
    spans = scan_bytes(data)
    if not spans or len(data) == len(text):
        return spans
    edges, at, points = {}, 0, 0
    for edge in sorted({e for s in spans for e in s[:2]}):
        points += len(data[at:edge].decode())
        edges[edge], at = points, edge
    return [(edges[a], edges[b], kind) for a, b, kind in spans]


def redact(text: str, spans: list[tuple[int, int, str]], mark: str = "[{kind}]") -> str:
    """The text with every span (overlapping ones as one) replaced by a mark that names its first kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = "array<struct<start:int,end:int,kind:string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, end, kind; code points, end exclusive) of each document of `docs` (doc_id, text).

    A row for each row: null and empty texts have no spans, repeated rows are scanned each, other columns are ignored.
    """

    def run(batch: pa.RecordBatch) -> dict:
        spans = [[{"start": a, "end": b, "kind": k} for a, b, k in scan_text(t)] for t in common.texts_of(batch)]
        return {"doc_id": batch.column("doc_id"), "spans": pa.array(spans, _SPANS)}

    return common.per_batch(docs.select("doc_id", "text"), run, f"doc_id bigint, spans {SPANS}")


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with every secret in `text` replaced by a mark of its kind; texts without secrets, and null ones, stay as they are.

    All columns stay; repeated rows are treated each.
    """

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column("text").to_pylist()
        return {"text": pa.array([redact(t, scan_text(t)) if t else t for t in texts], pa.string())}

    made = common.per_batch(docs, run, "text string", tuple(docs.columns))
    return made.select(*docs.columns)
