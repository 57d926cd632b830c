"""Secret scan: Aho-Corasick keyword hits, anchored patterns at the hits, checksums of self-checking tokens."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The pattern, keywords and least length of each base kind.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 12, "access": 18, "hex": 16}
# Prefixes of public token formats whose last six characters are a base-62 CRC-32 of the thirty before.
CHECKED_PREFIXES = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z_])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "github", "npm")


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` as six base-62 digits."""
    left, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        left, digit = divmod(left, 62)
        digits = BASE62[digit] + digits
    return digits


@cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for word in ASSIGN_KEYWORDS:
        found.add_word(word, ("assign", len(word)))
    found.add_word("akia", ("access", 4))
    for prefix, kind in CHECKED_PREFIXES.items():
        found.add_word(prefix, (kind, len(prefix)))
    found.make_automaton()
    return found


def _folded(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """``start, end, kind`` of every secret, in order of start, then kind.

    Keyword hits come from one pass of the automaton over the folded text. At a
    hit not inside the previous match of its kind the pattern is tried at exactly
    that place, which gives the same leftmost non-overlapping matches as a search
    through the whole text; matches that are too short still take their place.
    Hexadecimal runs have no keyword and are found by their length.
    """
    text = text or ""
    kept = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    ends = {"assign": 0, "access": 0}
    for last, (kind, width) in _automaton().iter(_folded(text)):
        start = last + 1 - width
        if kind in ends:
            if start >= ends[kind] and (m := (ASSIGN if kind == "assign" else ACCESS).match(text, start)):
                ends[kind] = m.end()
                size = len(m[2]) if kind == "assign" else m.end() - start
                if size >= LEAST[kind]:
                    kept.append((start, m.end(), kind))
        elif (start == 0 or not text[start - 1].isalnum()) and (m := CHECKED.match(text, start)) and checksum62(m[1]) == m[2]:
            kept.append((start, m.end(), kind))
    return sorted(kept, key=lambda s: (s[0], KINDS.index(s[2])))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, counts by base kind, the digest of the base spans and all spans, for every row.

    ``spans`` joins ``kind:start:end`` by commas, in code points, end exclusive;
    tokens with a valid embedded checksum add spans of kind github and npm. A null
    text is empty and has no span. Rows with null or repeated identifiers are
    returned as they come; extra columns are not carried.
    """
    table = documents.select(F.col(id_col), F.col(text_col).alias("__text"))
    kind_of_id = table.schema[0].dataType.simpleString()
    names = [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                found = spans(text)
                base = [s for s in found if s[2] in LEAST]
                for values, kind in zip(rows, LEAST):
                    values.append(sum(s[2] == kind for s in base))
                rows[3].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                rows[4].append(_joined(found))
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows, types)], names)

    return table.mapInArrow(run, f"`{id_col}` {kind_of_id}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)
