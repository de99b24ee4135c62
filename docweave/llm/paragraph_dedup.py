"""Substring deduplication by MinHash banding of paragraphs.

A paragraph is a sentence of enough words, or a run of shorter ones, within a
line; passages that repeat inside different lines thus share whole paragraphs.
1. Paragraphs with the same words are one from the start.  Others meet where
   all hashes of a MinHash band agree: six bands of two rows bring pairs at
   Jaccard 0.75 together with probability 0.993, nearer ones almost surely.
2. Bands travel packed to buckets, which return the bands that different
   paragraphs share: the groups in which they collide.
3. Within groups an exact Jaccard search (``overlap``) finds the links, and
   components of links are classes.
4. Beside them stand windows of a fixed number of words, which begin where the
   hash of three words is the least of its surroundings, whatever lines and
   sentences are; windows with the same words are one.  Of a passage, all words
   but REACH - 1 at either end are in windows that its other copies have too.
5. A paragraph or window whose class has an earlier document goes if it stands
   near others with enough words together; only words of such paragraphs and
   windows go, never those between them.  The first document keeps all its own.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import IS_WORD, LOWER, STEP, U64, blocks, column_bytes, mix, prefix_sums, shingle_hashes, span_hash, word_spans
from docweave.llm.carry import CARRIED, carried, numbered
from docweave.llm.components import connected_components
from docweave.llm.jaccard_join import pack, unpack
from docweave.llm.overlap import in_groups, linked
from docweave.llm.store import written
from docweave.ship import shipped

BANDS, ROWS = 6, 2
SHINGLE = 5
#: Words of a paragraph, of the paragraphs that go together, and at most between these.
LEAST_WORDS, LEAST_RUN, GAP = 8, 24, 8
#: Words of a window, and places of which one at least begins a window.
WINDOW, REACH = 12, 11
#: Band entries in one packing, and in one bucket on average.
PACK, BUCKET = 2_000_000, 1_000_000
#: Bytes of text whose windows go to one bucket on average, and windows of one packing that make one frequent.
BUCKET_BYTES, FREQUENT = 24 << 20, 64
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True


class Paragraphs:
    """The paragraphs of a block of documents."""

    def __init__(self, part: pa.RecordBatch, text: str):
        raw, offsets = column_bytes(part.column(text))
        data = LOWER[raw]
        starts, ends, rows = word_spans(data, offsets, IS_WORD)
        n = len(starts)
        self.hashes = span_hash(prefix_sums(data), starts, ends)
        base = np.searchsorted(rows, np.arange(len(offsets)))
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        closes = np.ones(n, dtype=bool)  # a word that ends its sentence
        hard = np.ones(n, dtype=bool)  # ... and its line
        if n > 1:
            hard[:-1] = (rows[1:] != rows[:-1]) | (lines[starts[1:]] != lines[ends[:-1]])
            closes[:-1] = hard[:-1] | _ENDS[data[ends[:-1] - 1]]
        first, many = [], []
        begin, at = 0, 0
        last = np.flatnonzero(closes)
        for end, stop in zip((last + 1).tolist(), hard[last].tolist(), strict=True):
            if end - at >= LEAST_WORDS:
                first.append(at)
                many.append(end - at)
                begin = end
            elif end - begin >= LEAST_WORDS:
                first.append(begin)
                many.append(end - begin)
                begin = end
            at = end
            if stop:
                begin = end
        self.first, self.many = np.array(first, dtype=np.int64), np.array(many, dtype=np.int64)
        self.word_rows, self.base = rows, base
        self.rows = rows[self.first] if n else np.zeros(0, np.int64)
        self.word = self.first - base[self.rows] if n else self.first
        self.number = np.arange(len(first)) - np.searchsorted(self.rows, self.rows)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(self.hashes * _place_powers(n), out=self.sums[1:])
        self.names = mix(self._whole(self.first, self.many) + self.many.astype(U64)).view(np.int64)

    def _whole(self, first: np.ndarray, many: np.ndarray | int) -> np.ndarray:
        """Hashes of the words from ``first`` on, whatever stands before them."""
        inverse = _place_powers(len(self.hashes), pow(STEP, -1, 1 << 64))
        return (self.sums[first + many] - self.sums[first]) * inverse[first]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """First words and names of the windows."""
        rows, n = self.word_rows, len(self.word_rows)
        if n < max(WINDOW, REACH + 2):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        three = mix(self._whole(np.arange(n - 2), 3))
        within = rows[: n - REACH - 1] == rows[REACH + 1 :]
        # The last of equal ones, so that the choice depends on the surroundings alone.
        least = np.lib.stride_tricks.sliding_window_view(three, REACH)[:, ::-1].argmin(axis=1)
        first = np.unique((np.arange(len(least)) + REACH - 1 - least)[within])
        first = first[first + WINDOW <= n]
        first = first[rows[first + WINDOW - 1] == rows[first]]
        return first, mix(self._whole(first, WINDOW) ^ U64(STEP)).view(np.int64)

    def shingles(self, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes of (some) paragraphs, and where each paragraph's begin, with the end."""
        first = self.first if some is None else self.first[some]
        many = self.many if some is None else self.many[some]
        bounds = np.concatenate([[0], np.cumsum(many)])
        take = np.arange(bounds[-1]) + np.repeat(first - bounds[:-1], many)
        hashes, owner = shingle_hashes(self.hashes[take], bounds, SHINGLE)
        return hashes, np.searchsorted(owner, np.arange(len(first) + 1))

    def bands(self, some: np.ndarray) -> np.ndarray:
        """Band keys of some paragraphs, one column a band."""
        hashes, begin = self.shingles(some)
        out = np.zeros((len(some), BANDS), dtype=U64)
        if not len(some):
            return out
        for b in range(BANDS):
            for r in range(ROWS):
                turn = mix(hashes * U64(2 * (b * ROWS + r) + 3) + U64(b * ROWS + r))
                out[:, b] = mix(out[:, b] * U64(STEP) + np.minimum.reduceat(turn, begin[:-1]) + U64(b))
        return out


_places: dict[int, np.ndarray] = {}


def _place_powers(n: int, base: int = STEP) -> np.ndarray:
    have = _places.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, dtype=U64)
        have[0] = 1
        have = _places[base] = np.cumprod(have, dtype=U64)
    return have[:n]


def _paragraph_rows(source: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                p = Paragraphs(part, "_text")
                ids, rows = (part.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_row"))
                arrays = [ids[p.rows], rows[p.rows], p.number.astype(np.int32), p.word.astype(np.int32), p.many.astype(np.int32), p.names]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["_id", "_row", "number", "word", "many", "name"])

    return source.mapInArrow(run, "_id bigint, _row bigint, number int, word int, many int, name bigint")


_SENT = [("bucket", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("places", pa.binary()), ("words", pa.binary()), ("owners", pa.binary())]


def _shared_windows(source: DataFrame, buckets: int) -> DataFrame:
    """_id, _row, word, name of the windows that may stand in two documents.

    Windows travel packed to the buckets of their names.  Those that are frequent
    in one packing are shared for certain: they travel spread over other buckets,
    and only their names go to their own, so that no bucket outgrows a task.
    """
    edges = np.array([min((b << 64) // buckets, (1 << 64) - 1) for b in range(buckets + 1)], dtype=U64)

    def row(bucket: int, kind: int, keys: np.ndarray, place: np.ndarray, word: np.ndarray, owners: np.ndarray) -> tuple:
        used, local = np.unique(place, return_inverse=True)
        return bucket, kind, len(keys), pack(keys), local.reshape(-1).astype("<u4").tobytes(), word.astype("<u4").tobytes(), owners[used].tobytes()

    def flush(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        sizes = np.cumsum([0, *[len(p[3]) for p in parts]])
        keys, word = (np.concatenate([p[k] for p in parts]) for k in (0, 2))
        place = np.concatenate([p[1] + at for p, at in zip(parts, sizes[:-1].tolist(), strict=True)])
        owners = np.concatenate([p[3] for p in parts])
        order = np.argsort(keys, kind="stable")
        keys, place, word = keys[order], place[order], word[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        count = np.diff(np.append(first, len(keys)))
        often = np.repeat(count >= FREQUENT, count)
        marks, out = keys[first[count >= FREQUENT]], []
        some, none = (keys[~often], place[~often], word[~often]), np.zeros(0, np.int64)
        cut, mark = np.searchsorted(some[0], edges), np.searchsorted(marks, edges)
        cut[-1], mark[-1] = len(some[0]), len(marks)
        for b in range(buckets):
            if cut[b] < cut[b + 1]:
                out.append(row(b, 0, *[a[cut[b] : cut[b + 1]] for a in some], owners))
            if mark[b] < mark[b + 1]:
                out.append(row(b, 1, marks[mark[b] : mark[b + 1]], none, none, owners))
        if len(marks):
            spread = (mix(owners[:, 1].view(U64)) % U64(buckets)).astype(np.int64)[place[often]]
            for b in np.unique(spread).tolist():
                out.append(row(buckets + b, 2, *[a[often][spread == b] for a in (keys, place, word)], owners))
        for at in range(0, len(out), 16):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*out[at : at + 16], strict=True), _SENT, strict=True)], names=[c for c, _ in _SENT])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in blocks(batch, "_text"):
                p = Paragraphs(part, "_text")
                first, names = p.windows()
                own = p.word_rows[first]
                owners = np.stack([part.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_row")], axis=1)
                parts.append((names.view(U64), own, first - p.base[own], owners))
                held += len(first)
                if held >= PACK // 2:
                    yield from flush(parts)
                    parts, held = [], 0
        if held:
            yield from flush(parts)

    def meet(rows: list[tuple]) -> pa.RecordBatch:
        marks = [unpack(r[3], r[2]) for r in rows if r[1] == 1]
        rows = [r for r in rows if r[1] != 1]
        key = np.concatenate([unpack(r[3], r[2]) for r in rows] or [np.zeros(0, U64)])
        owner = np.concatenate([np.frombuffer(r[6], "<i8").reshape(-1, 2)[np.frombuffer(r[4], "<u4")] for r in rows] or [np.zeros((0, 2), np.int64)])
        word = np.concatenate([np.frombuffer(r[5], "<u4") for r in rows] or [np.zeros(0, "<u4")])
        if rows and rows[0][1] == 0:
            order = np.argsort(key, kind="stable")
            key, owner, word = key[order], owner[order], word[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            mixed = mix(owner[:, 0].view(U64) * U64(STEP) + owner[:, 1].view(U64))
            several = np.maximum.reduceat(mixed, first) != np.minimum.reduceat(mixed, first)
            several |= np.isin(key[first], np.concatenate(marks)) if marks else False
            take = np.repeat(several, np.diff(np.append(first, len(key))))
            key, owner, word = key[take], owner[take], word[take]
        arrays = [owner[:, 0], owner[:, 1], word.astype(np.int32), key.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["_id", "_row", "word", "name"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and rows[0][0] != row[0]:
                    yield meet(rows)
                    rows = []
                rows.append(row)
                if row[1] == 2:  # shared for certain, whatever else there is
                    yield meet(rows)
                    rows = []
        if rows:
            yield meet(rows)

    sent = source.mapInArrow(send, "bucket bigint, kind int, n int, keys binary, places binary, words binary, owners binary")
    return sent.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(receive, "_id bigint, _row bigint, word int, name bigint")


def _band_groups(source: DataFrame, bits: int, buckets: int) -> DataFrame:
    """(group, short): bands that different paragraphs share, and the cut names of these."""
    edges = np.array([min((b << bits) // buckets, (1 << 64) - 1) for b in range(buckets + 1)], dtype=U64)

    def flush(keys: np.ndarray, owners: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        cut = np.searchsorted(keys, edges)
        cut[-1] = len(keys)
        for b in range(buckets):
            own = slice(cut[b], cut[b + 1])
            if cut[b] < cut[b + 1]:
                planes = np.ascontiguousarray(owners[own].astype("<u8").view(np.uint8).reshape(-1, 8).T[: -(-bits // 8)])
                arrays = [pa.array([b], pa.int64()), pa.array([len(keys[own])], pa.int32()), pa.array([pack(keys[own])], pa.binary()), pa.array([planes.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "n", "keys", "owners"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held, seen = [], [], 0, np.zeros(0, np.int64)
        for batch in batches:
            for part in blocks(batch, "_text"):
                p = Paragraphs(part, "_text")
                _, some = np.unique(p.names, return_index=True)
                some = some[~np.isin(p.names[some], seen)]
                seen = np.concatenate([seen, p.names[some]])
                keys.append((p.bands(some) >> U64(64 - bits)).reshape(-1))
                owners.append(np.repeat(p.names[some].view(U64) >> U64(64 - bits), BANDS))
                held += len(some) * BANDS
                if held >= PACK:
                    yield from flush(np.concatenate(keys), np.concatenate(owners))
                    keys, owners, held, seen = [], [], 0, np.zeros(0, np.int64)
        if held:
            yield from flush(np.concatenate(keys), np.concatenate(owners))

    def meet(rows: list[tuple]) -> pa.RecordBatch:
        keys, owners = [], []
        for _, n, packed, planes in rows:
            keys.append(unpack(packed, n))
            whole = np.zeros((8, n), dtype=np.uint8)
            have = np.frombuffer(planes, np.uint8).reshape(-1, n)
            whole[: len(have)] = have
            owners.append(np.ascontiguousarray(whole.T).view("<u8").reshape(-1))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        once = np.ones(len(key), dtype=bool)
        once[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        key, owner = key[once], owner[once]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(first, len(key)))
        take = np.repeat(count > 1, count)
        return pa.RecordBatch.from_arrays([pa.array(a[take].astype(np.int64)) for a in (key, owner)], names=["group", "short"])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if rows and rows[0][0] != row[0]:
                    yield meet(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield meet(rows)

    sent = source.mapInArrow(send, "bucket bigint, n int, keys binary, owners binary")
    return sent.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(receive, "`group` bigint, short bigint")


def _shingle_sets(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """name, size and keys of the paragraphs at the wanted places."""
    asked = wanted.groupBy("_id", "_row").agg(F.collect_set("number").alias("_wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                p = Paragraphs(part, "_text")
                begin = np.searchsorted(p.rows, np.arange(part.num_rows))
                some = np.sort(np.concatenate([begin[i] + np.array(w, dtype=np.int64) for i, w in enumerate(part.column("_wanted").to_pylist())]))
                hashes, bounds = p.shingles(some)
                sets = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                arrays = [pa.array(p.names[some]), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", "size", "keys"])

    joined = source.join(asked, ["_id", "_row"]).select("_text", "_wanted")
    return joined.mapInArrow(run, "name bigint, size bigint, keys array<bigint>").dropDuplicates(["name"])


def paragraph_classes(source: DataFrame, paragraphs: DataFrame, percent: int) -> DataFrame:
    """(name, root) of the paragraphs that link with a different one."""
    spark = source.sparkSession
    total = paragraphs.count() * BANDS
    bits = min(64, max(2, total).bit_length() + 20)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, -(-total // BUCKET), 1)
    groups = written(_band_groups(source.select("_text"), bits, buckets), "paragraph-bands")
    places = paragraphs.withColumn("short", F.shiftrightunsigned("name", 64 - bits)).join(groups.select("short").distinct(), "short")
    places = written(places.groupBy("name", "short").agg(F.min(F.struct("_id", "_row", "number")).alias("at")), "paragraph-places")
    sets = _shingle_sets(source, places.select("at._id", "at._row", "at.number")).select(F.col("name").alias("id"), F.lit(1).cast("long").alias("copies"), "size", "keys")
    members = groups.join(places.select("short", F.col("name").alias("id")), "short").select("group", "id")
    links = written(linked(in_groups(written(sets, "paragraph-sets"), members), percent).where("b is not null").select("a", "b"), "paragraph-links")
    return connected_components(links).select(F.col("node").alias("name"), "root")


def verified_passages(places: list[tuple[int, int]], least_run: int, gap: int = GAP) -> list[tuple[int, int]]:
    """The merged ranges of words of ``places``, of those runs that have ``least_run`` words in them.

    Ranges at most ``gap`` words apart are one run; the words between are no part of it.
    """
    ranges: list[list[int]] = []
    for a, b in sorted(places):
        if ranges and a <= ranges[-1][1]:
            ranges[-1][1] = max(ranges[-1][1], b)
        else:
            ranges.append([a, b])
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    for a, b in [*ranges, (1 << 62, 1 << 62)]:
        if run and a - run[-1][1] > gap:
            if sum(y - x for x, y in run) >= least_run:
                out += run
            run = []
        run.append((a, b))
    return out


def paragraph_dedup(docs: DataFrame, percent: int = 75, least_run: int = LEAST_RUN, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default), n_paragraphs, n_removed, n_removed_words, passages, first_docs.

    n_paragraphs counts paragraphs, n_removed the removed paragraphs and windows.
    passages: removed ranges of words (numbers of white-space words in the whole
    text, ends exclusive), each of verified paragraphs and windows alone; with
    ``least_run`` 1 every repeated one goes.  first_docs: doc_ids that hold the
    first copies, sorted.  Documents are ordered by doc_id, of any type that
    sorts, null last; rows that share a doc_id are ordered by a hash of the text,
    and rows that repeat wholly are one document.  Texts that are null, empty or
    without a paragraph lose nothing; an empty table gives no rows.  Columns of
    ``keep`` may have any name but the five made here, which replace them.
    """
    shipped(docs.sparkSession)
    made = ["n_paragraphs", "n_removed", "n_removed_words", "passages", "first_docs"]
    whole = docs.select(carried(docs, keep or [doc_id], made), F.col(doc_id).alias("_own"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    whole = numbered(whole, "_own").withColumnRenamed("_order", "_id").withColumn("_row", F.xxhash64("_text"))
    source = whole.select("_id", "_row", "_text")
    paragraphs = written(_paragraph_rows(source), "paragraphs")
    total = source.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2, -(-int(total) // BUCKET_BYTES), 1)
    windows = _shared_windows(source, buckets).select("_id", "_row", F.lit(-1).alias("number"), "word", F.lit(WINDOW).alias("many"), "name")
    found = paragraphs.unionByName(written(windows, "paragraph-windows"))
    roots = written(paragraph_classes(source, paragraphs, percent), "paragraph-classes")
    # Names that documents share, and names that link with another one.
    place = F.struct("_id", "_row")
    named = found.groupBy("name").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    named = named.join(roots, "name", "left").where("root is not null or lo <> hi").withColumn("class", F.coalesce("root", "name"))
    named = written(named.select("name", "class", "lo", "hi"), "paragraph-names")
    firsts = named.groupBy("class").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first <> last").select("class", "first")
    repeated = named.join(firsts, "class").select("name", "first")
    later = found.join(repeated, "name").where((F.col("_id") != F.col("first._id")) | (F.col("_row") != F.col("first._row")))
    per_row = later.groupBy("_id", "_row").agg(F.collect_set(F.struct("word", "many", F.col("first._id").alias("first"))).alias("_found"))
    counts = paragraphs.select("_id", "_row", "number").groupBy("_id", "_row").agg((F.max("number") + 1).cast("long").alias("n_paragraphs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column("_found").to_pylist():
                passages = verified_passages([(p["word"], p["word"] + p["many"]) for p in found], least_run)
                starts = [a for a, _ in passages]
                gone = [p for p in found if (at := bisect_right(starts, p["word"])) and p["word"] < passages[at - 1][1]]
                out.append((len(gone), sum(b - a for a, b in passages), [{"start": a, "end": b} for a, b in passages], sorted({p["first"] for p in gone})))
            types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.list_(pa.int64())]
            arrays = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_row"), *arrays], names=["_id", "_row", "n_removed", "n_removed_words", "passages", "first_docs"])

    removed = per_row.mapInArrow(run, "_id bigint, _row bigint, n_removed bigint, n_removed_words bigint, passages array<struct<start:bigint,end:bigint>>, first_docs array<bigint>")
    zero = F.lit(0).cast("long")
    rows = whole.select(CARRIED, "_id", "_row").join(counts, ["_id", "_row"], "left").join(_named_firsts(removed, whole), ["_id", "_row"], "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return rows.select(
        f"{CARRIED}.*", F.coalesce("n_paragraphs", zero).alias("n_paragraphs"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_removed_words", zero).alias("n_removed_words"), F.coalesce("passages", none).alias("passages"),
        F.coalesce("first_docs", F.array().cast(f"array<{dict(docs.dtypes)[doc_id]}>")).alias("first_docs"),
    )


def _named_firsts(removed: DataFrame, whole: DataFrame) -> DataFrame:
    """``removed`` with the doc_ids themselves in first_docs in place of their order."""
    kind = dict(whole.dtypes)["_own"]
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return removed.withColumn("first_docs", F.transform("first_docs", lambda x: F.when(x < (1 << 63) - 1, x).cast(kind)))
    ids = whole.select(F.col("_id").alias("_first"), "_own").distinct()
    named = removed.select("_id", "_row", F.explode("first_docs").alias("_first")).join(ids, "_first").groupBy("_id", "_row").agg(F.array_sort(F.collect_set("_own")).alias("first_docs"))
    return removed.drop("first_docs").join(named, ["_id", "_row"], "left")


def without_passages(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` (with a passages column) whose text lacks the words of the passages."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    shipped(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, text):
                data, offsets = column_bytes(part.column(text))
                starts, ends, rows = word_spans(data, offsets, IS_WORD)
                base = np.searchsorted(rows, np.arange(len(offsets)))
                raw, out = data.tobytes(), []
                for i, passages in enumerate(part.column("passages").to_pylist()):
                    at, pieces = int(offsets[i]), []
                    for p in passages or ():
                        pieces.append(raw[at : int(starts[base[i] + p["start"]])])
                        at = int(ends[base[i] + p["end"] - 1])
                    out.append(b"".join([*pieces, raw[at : int(offsets[i + 1])]]).decode())
                new = pa.array(out, part.column(text).type)
                yield pa.RecordBatch.from_arrays([new if c == text else part.column(c) for c in part.schema.names], names=part.schema.names)

    return docs.mapInArrow(run, schema)
