"""Secret scan: fixed patterns, and high-entropy windows of candidate strings.

The patterns run on the UTF-8 bytes of whole texts.  Candidate strings are runs
of key characters; a window slides over each, and both the Shannon entropy of the
window and its character class follow from counts that change by one character a
step.  Windows that come near the mean entropy of random keys of their class and
length join into spans; spans that an allow-list entry matches, and spans that
touch a pattern's span, are suppressed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import blocks
from docweave.llm.carry import CARRIED, carried, extended
from docweave.ship import shipped

#: The kinds in order, and their patterns over ASCII-lowered or raw bytes.
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base36", "entropy_letters", "entropy_letters2", "entropy_base64")
ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18
#: Candidate strings, and the characters of a window; a shorter candidate is one window.
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
WINDOW = 20
#: Character classes: how many characters a random key of the class draws from, and how
#: far below the mean entropy of such keys a window may be.  Strings of letters alone are
#: closer to words, so they must come nearer.
CLASSES = {"entropy_hex": (16, 0.4), "entropy_base36": (36, 0.35), "entropy_letters": (26, 0.1), "entropy_letters2": (52, 0.2), "entropy_base64": (64, 0.35)}
#: Allow-list: slugs and paths of plain words, identifiers that are no secrets, and keys printed as examples in manuals.
ALLOW = (
    rb"[a-z]+(?:[-_/=+]+[a-z]+)+", rb"[A-Z]+(?:[-_/=+]+[A-Z]+)+", rb"(?:[A-Za-z]?[a-z]+[-_/=+]+)+[A-Za-z]?[a-z]+",
    rb"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", rb".*EXAMPLE.*", rb".*(?:0123456789|abcdefghij|ABCDEFGHIJ).*",
)

_SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"
_XLOGX = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 2)]
#: Groups of characters whose counts tell the class of a window: a-f, g-z, A-F, G-Z, digits, others.
_GROUP = bytes(0 if 97 <= c <= 102 else 1 if 103 <= c <= 122 else 2 if 65 <= c <= 70 else 3 if 71 <= c <= 90 else 4 if 48 <= c <= 57 else 5 for c in range(256))


def class_of(groups: int) -> str | None:
    """The class of a window with characters of these groups (a bit for each); None where it can't be a key."""
    lower, upper, digits, other = groups & 3, groups & 12, groups & 16, groups & 32
    if not lower and not upper:
        return None
    if other or (lower and upper and digits):
        return "entropy_base64" if (lower and upper) or digits else None
    if not groups & 10 and not (lower and upper) and digits:
        return "entropy_hex"
    if digits:
        return "entropy_base36"
    return "entropy_letters2" if lower and upper else "entropy_letters"


def mean_entropy(n: int, kinds: int) -> float:
    """The mean Shannon entropy of ``n`` characters drawn from ``kinds`` equally likely ones."""
    p = 1 / kinds
    return math.log2(n) - kinds / n * sum(math.comb(n, x) * p**x * (1 - p) ** (n - x) * x * math.log2(x) for x in range(2, n + 1))


_limits: dict[int, list[float]] = {}


def limits(window: int) -> list[float]:
    """By groups of characters: the sum of n * log2(n) that a window may have at most; -1 where none may."""
    if window not in _limits:
        by_class = {name: (math.log2(window) - mean_entropy(window, kinds) + margin) * window + 1e-9 for name, (kinds, margin) in CLASSES.items()}
        _limits[window] = [by_class.get(class_of(g) or "", -1.0) for g in range(64)]
    return _limits[window]


def window_spans(run: bytes, window: int = WINDOW) -> list[tuple[int, int, str]]:
    """Merged spans of the windows of ``run`` that reach the entropy of their class; of the class of the span's first window."""
    window = min(window, len(run))
    table, limit = _XLOGX, limits(window)
    counts, groups = [0] * 256, [0] * 6
    total, mask = 0.0, 0
    spans: list[tuple[int, int, str]] = []
    for at, c in enumerate(run):
        if at >= window:
            old = run[at - window]
            n = counts[old]
            total += table[n - 1] - table[n]
            counts[old] = n - 1
            g = _GROUP[old]
            groups[g] -= 1
            if not groups[g]:
                mask &= ~(1 << g)
        n = counts[c]
        total += table[n + 1] - table[n]
        counts[c] = n + 1
        g = _GROUP[c]
        groups[g] += 1
        mask |= 1 << g
        if at >= window - 1 and total <= limit[mask]:
            start = at - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], at + 1, spans[-1][2])
            else:
                spans.append((start, at + 1, class_of(mask) or ""))
    return spans


def scan_bytes(raw: bytes, allow: re.Pattern[bytes]) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of all findings, in bytes, by start and kind; linear in the text and its findings."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(raw.lower()) if m.end(1) - m.start(1) >= ASSIGN_CHARS]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(raw) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(raw)]
    found.sort()
    base, passed, reach = list(found), 0, -1
    for m in CANDIDATE.finditer(raw):
        run = m.group()
        for a, b, kind in window_spans(run):
            if allow.fullmatch(run[a:b]):
                continue
            a, b = a + m.start(), b + m.start()
            # Spans come in order, so base spans that begin before this one's end are looked at once.
            while passed < len(base) and base[passed][0] < b:
                reach = max(reach, base[passed][1])
                passed += 1
            if reach <= a:
                found.append((a, b, KINDS.index(kind)))
    return sorted(found)


def code_points(raw: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same findings with offsets in code points."""
    if not found or raw.isascii():
        return found
    at, passed, place = 0, 0, {}
    for offset in sorted({x for a, b, _ in found for x in (a, b)}):
        passed += len(raw[at:offset].decode("utf-8", "replace"))
        at = offset
        place[offset] = passed
    return [(place[a], place[b], k) for a, b, k in found]


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None, allow: tuple[bytes, ...] = ALLOW) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus ``secrets``: array of (kind, start, end).

    Offsets are code points, ends exclusive, in order of start and then kind.
    A null or empty text has no findings; rows that repeat have the same ones
    each; an empty table gives no rows.  Texts of any length are scanned whole, in
    time linear in their length and findings.  A column named secrets is
    replaced; others may have any name.
    """
    shipped(docs.sparkSession)
    source = docs.select(carried(docs, keep, ["secrets"]), F.col(text).alias("_text"))
    patterns = b"|".join(b"(?:" + a + b")" for a in allow) or b"(?!)"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = re.compile(patterns)
        for batch in batches:
            for part in blocks(batch, "_text"):
                out = []
                for raw in part.column("_text").cast(pa.binary()):
                    raw = raw.as_py() or b""
                    out.append([{"kind": KINDS[k], "start": a, "end": b} for a, b, k in code_points(raw, scan_bytes(raw, allowed))])
                spans = pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))
                yield pa.RecordBatch.from_arrays([part.column(CARRIED), spans], names=[CARRIED, "_secrets"])

    return source.mapInArrow(run, extended(source, [CARRIED], f"_secrets {_SPAN}")).select(f"{CARRIED}.*", F.col("_secrets").alias("secrets"))


def redacted(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of its ``secrets`` column replaced by ``mark``; overlapping spans are one."""
    step = F.aggregate(
        "secrets",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.when(s["end"] <= a["at"], a).otherwise(
            F.struct(
                F.concat(a["out"], F.when(s["start"] < a["at"], "").otherwise(F.concat(F.substring(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)))).alias("out"),
                s["end"].alias("at"),
            )
        ),
    )
    return docs.withColumn("_done", step).withColumn(text, F.concat("_done.out", F.substring(F.col(text), (F.col("_done.at") + 1).cast("int"), F.length(text)))).drop("_done")
