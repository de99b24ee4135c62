"""Byte-level BPE by backtracking over longest matches.

The encoder walks an Aho-Corasick automaton of all tokens over a word, takes
the longest token that ends at each place, and backs off to shorter prefixes
where the pair of neighbours could not stand together after the merges.  For a
word that gives the very ids that applying the merges by rank gives, in linear
time.  Ids of words are kept in a bounded table, as words repeat.  Decoding
reads each id's bytes off one byte string by an offset table.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import kept
from docweave.llm.carry import CARRIED, carried, extended
from docweave.ship import shipped

#: The pre-tokenizer's pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Most words whose ids a Python worker keeps: in two halves, of which the one that isn't asked for goes.
KEPT_WORDS = 400_000
#: Most pairs in the compatibility table.
KEPT_PAIRS = 500_000
#: Texts of characters below this one take the standard library's faster engine.
LATIN_END = 0x250


def latin_pattern() -> str:
    """PATTERN with its classes written out for the characters below LATIN_END."""

    def ranges(kind: str) -> str:
        members = [c for c in range(LATIN_END) if unicodedata.category(chr(c))[0] == kind]
        firsts = [c for c in members if c - 1 not in members]
        lasts = [c for c in members if c + 1 not in members]
        return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(firsts, lasts, strict=True))

    letter, number, space = ranges("L"), ranges("N"), r"\t-\r\x20\x85\xa0"
    return rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: character -> byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    return table | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Exact BPE encoder and decoder of one byte-level tokenizer file."""

    def __init__(self, path: str, text: str | None = None):
        spec = json.loads(text if text is not None else open(path, encoding="utf-8").read())
        to_byte = byte_alphabet()
        raw = {token: bytes(map(to_byte.__getitem__, token)) for token in spec["model"]["vocab"]}
        self.vocab = {raw[token]: i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        tokens = {i: b for b, i in self.vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        for s in self.special:
            self.vocab.pop(s.encode(), None)
        size = max(tokens) + 1
        self.pieces = [tokens.get(i, b"") for i in range(size)]
        #: The offset table: id i is blob[offsets[i] : offsets[i + 1]].
        self.blob = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        self.sizes = np.array([len(p) for p in self.pieces])
        self.offsets = np.concatenate([[0], np.cumsum([len(p) for p in self.pieces])])
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b = self.vocab[raw[left]], self.vocab[raw[right]]
            made = self.vocab[raw[left] + raw[right]]
            self.merges[a, b] = (rank, made)
            if made not in self.parts:
                self.parts[made], self.rank[made] = (a, b), rank
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for piece, i in self.vocab.items():
            if len(piece) == 1 or i in self.parts:
                self.automaton.add_word(piece.decode("latin-1"), i)
        self.automaton.make_automaton()
        #: Longest proper prefix of a token that is a token, for backing off.
        self.shorter = {}
        for piece, i in self.vocab.items():
            cut = next((n for n in range(len(piece) - 1, 0, -1) if self._usable(piece[:n])), 0)
            self.shorter[i] = self.vocab[piece[:cut]] if cut else -1
        self.split = regex.compile(PATTERN).findall
        self.split_latin = re.compile(latin_pattern()).findall
        self.foreign = re.compile(rf"[^\x00-\u{LATIN_END - 1:04x}]").search
        self.stop = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.lengths = self.sizes.tolist()
        self.usable = {piece: i for piece, i in self.vocab.items() if self._usable(piece)}
        self.reach = [0] * 256
        for piece in self.usable:
            self.reach[piece[0]] = max(self.reach[piece[0]], len(piece))

    def _usable(self, piece: bytes) -> bool:
        return piece in self.vocab and (len(piece) == 1 or self.vocab[piece] in self.parts)

    def _fits(self, left: int, right: int) -> bool:
        """Whether the merges can leave these two tokens side by side."""
        limit = len(self.merges)
        while True:
            found = self.merges.get((left, right))
            if found is not None and found[0] < limit:
                return False
            # Undo the later of the two outer merges and look at the seam below it.
            rank_left, rank_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                limit, left = rank_left, self.parts[left][1]
            else:
                limit, right = rank_right + 1, self.parts[right][0]

    def word(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.vocab.get(piece)
        n = len(piece)
        if whole is not None and (n == 1 or self.encodes_itself(whole)):
            return [whole]
        fits = self.fits
        greedy = [i for _, i in self.automaton.iter_long(piece.decode("latin-1"))]
        # Everything before the first pair that can't stand stays as it is.
        good = 1
        while good < len(greedy) and fits(greedy[good - 1], greedy[good]):
            good += 1
        if good == len(greedy):
            return greedy
        out, token = greedy[:good], greedy[good]
        lengths, shorter = self.lengths, self.shorter
        at = sum([lengths[i] for i in out])
        dead: set[int] = set()
        while True:
            end = at + lengths[token]
            if end not in dead and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = self.longest(piece, at)
                continue
            token = shorter[token]
            while token < 0:
                # No token fits here: nothing that ends at this place is right.
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                token = shorter[token]

    def longest(self, piece: bytes, at: int) -> int:
        """The longest token that starts at a place; asked for only after backing off."""
        usable = self.usable
        for end in range(min(len(piece), at + self.reach[piece[at]]), at, -1):
            found = usable.get(piece[at:end])
            if found is not None:
                return found
        raise ValueError("a byte without a token")

    def fits(self, left: int, right: int) -> bool:
        """The pair-compatibility table, filled as pairs occur."""
        known = self.pairs.get((left << 20) | right)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[(left << 20) | right] = self._fits(left, right)
        return known

    @lru_cache(1 << 16)
    def encodes_itself(self, token: int) -> bool:
        """Whether the merges turn the token's own bytes into it."""
        if len(self.pieces[token]) == 1:
            return True
        if token not in self.parts:
            return False
        left, right = self.parts[token]
        return self.encodes_itself(left) and self.encodes_itself(right) and self._seam(left, right, self.rank[token])

    def _seam(self, left: int, right: int, rank: int) -> bool:
        while True:
            rank_left, rank_right = self.rank.get(left, -1), self.rank.get(right, -1)
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                limit, left = rank_left, self.parts[left][1]
            else:
                limit, right = rank_right + 1, self.parts[right][0]
            found = self.merges.get((left, right))
            if found is not None and found[0] < limit:
                return False

    def encode_bytes(self, text: str) -> bytes:
        """All ids as little-endian unsigned 32-bit integers."""
        known, out = self.known, []
        parts = self.stop.split(text) if self.stop is not None else [text]
        for n, part in enumerate(parts):
            if n % 2:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            words = self.split(part) if self.foreign(part) else self.split_latin(part)
            try:
                out.extend([known[w] for w in words])
            except KeyError:
                for w in words:
                    ids = known.get(w)
                    if ids is None:
                        ids = self.older.get(w)
                        if ids is None:
                            ids = np.array(self.word(w.encode()), dtype="<u4").tobytes()
                        if len(w) <= 64:
                            if len(known) >= KEPT_WORDS // 2:
                                self.older, self.known = known, {}
                                known = self.known
                            known[w] = ids
                    out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), dtype="<u4").tolist()

    def decode(self, ids: np.ndarray) -> str:
        starts, sizes = self.offsets[ids], self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ids):
            return ""
        take = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        return self.blob[take].tobytes().decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}
kept(_encoders.clear)
kept(Encoder.encodes_itself.cache_clear)


def encoder(path: str) -> Encoder:
    """One encoder for each file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenized(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, want: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus what ``want`` names.

    ids: array<bigint>; ids_sha256, n_tokens; decoded, decoded_sha256.  ``path``
    must name the tokenizer file on every executor.  A null text is an empty
    one; rows that repeat are encoded each; an empty table gives no rows.  Texts of
    any length are encoded whole, in time linear in their length.  Columns of
    ``docs`` with a wanted name are replaced; others may have any name.
    """
    types = {"ids": "array<bigint>", "n_tokens": "bigint", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}
    shipped(docs.sparkSession)
    source = docs.select(carried(docs, keep, want), F.col(text).alias("_text"))
    schema = extended(source, [CARRIED], ", ".join(f"{c} {types[c]}" for c in want))
    return source.mapInArrow(_runner(path, want), schema).select(f"{CARRIED}.*", *want)


def _runner(path: str, want: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: dict[str, list] = {c: [] for c in want}
                for value in part.column("_text").to_pylist():
                    packed = codec.encode_bytes(value or "")
                    ids = np.frombuffer(packed, dtype="<u4")
                    if "n_tokens" in out:
                        out["n_tokens"].append(len(ids))
                    if "ids" in out:
                        out["ids"].append(ids.astype(np.int64))
                    if "ids_sha256" in out:
                        out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                    if "decoded" in out or "decoded_sha256" in out:
                        back = codec.decode(ids)
                        if "decoded" in out:
                            out["decoded"].append(back)
                        if "decoded_sha256" in out:
                            out["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
                arrays = [part.column(CARRIED)] + [pa.array(out[c], pa.list_(pa.int64()) if c == "ids" else None) for c in want]
                yield pa.RecordBatch.from_arrays(arrays, names=[CARRIED, *want])

    return run
