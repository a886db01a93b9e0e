"""Secret scans: an Aho-Corasick prefilter, anchored expressions at its hits, embedded checksums.

The automaton holds the words and prefixes that secrets begin with and, for hexadecimal keys,
all runs of four hexadecimal digits. Only where it hits is an expression tried, anchored at
the hit. Beyond the base kinds, tokens that carry a CRC-32 of their own body in base 62 are
found when the checksum is right; they count as ``access`` spans.

Defined cases: null texts are empty; a text without hits has no spans; repeated rows give
repeated results; an empty table gives an empty result; other columns are ignored by ``scan``
and kept by ``redact``.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import ship, text_udf

KINDS = ("assign", "access", "hex")

#: The words before an assigned secret, and the prefixes of keys.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = "AKIA"
CHECKED = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")

MIN_ASSIGNED = 8
MIN_ACCESS = 16
MIN_HEX = 32
HEX_DIGITS = "0123456789abcdef"
HEX_KEY = 4

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CHECKED = re.compile(r"(?:gh[pousr]|npm)_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

REDACTED = "[SECRET]"


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for key in WORDS:
        automaton.add_word(key, (0, len(key)))
    automaton.add_word(ACCESS.lower(), (1, len(ACCESS)))
    for digits in itertools.product(HEX_DIGITS, repeat=HEX_KEY):
        automaton.add_word("".join(digits), (2, HEX_KEY))
    for key in CHECKED:
        automaton.add_word(key, (3, len(key)))
    automaton.make_automaton()
    return automaton


def _lower(text: str) -> str:
    """ASCII letters lowered, every other character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


def checksum_holds(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the body in base 62."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = _BASE62[digit] + digits
    return digits.rjust(6, "0") == check


def spans_of(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and added ones, as (start, kind, end)."""
    base, added, done = [], [], [0, 0, 0, 0]
    for last, (kind, size) in _automaton().iter(_lower(text)):
        start = last - size + 1
        if start < done[kind]:
            continue
        if kind == 2:
            if match := _HEX.match(text, start):
                done[2] = match.end()
                if match.end() - start >= MIN_HEX:
                    base.append((start, 2, match.end()))
        elif kind == 0:
            if match := _ASSIGN.match(text, start):
                done[0] = match.end()
                if len(match[2]) >= MIN_ASSIGNED:
                    base.append((start, 0, match.end()))
        elif kind == 1:
            if match := _ACCESS.match(text, start):
                done[1] = match.end()
                if match.end() - start >= MIN_ACCESS:
                    base.append((start, 1, match.end()))
        elif (match := _CHECKED.match(text, start)) and checksum_holds(match[1], match[2]):
            done[3] = match.end()
            added.append((start, 1, match.end()))
    return sorted(base), sorted(set(added) - set(base))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def _scanned(texts: list[str]) -> dict[str, list]:
    out: dict[str, list] = {"n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
    for text in texts:
        base, added = spans_of(text)
        kinds = [kind for _, kind, _ in base]
        for k, name in enumerate(KINDS):
            out[f"n_{name}"].append(kinds.count(k))
        out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
        out["spans"].append(written(sorted(base + added)))
    return out


def _redacted(texts: list[str]) -> dict[str, list]:
    out = []
    for text in texts:
        base, added = spans_of(text)
        pieces, at = [], 0
        for start, _, end in sorted(base + added):
            if end > at:
                pieces += [text[at:start], REDACTED] if start >= at else []
                at = end
        out.append("".join([*pieces, text[at:]]))
    return {"text": out}


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every whole text."""
    ship(docs.sparkSession)
    found = text_udf(_scanned, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return docs.select("doc_id", found("text").alias("found")).select("doc_id", "found.*")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced; null texts stay null."""
    ship(docs.sparkSession)
    clean = text_udf(_redacted, "text string")
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), clean("text")["text"]))
