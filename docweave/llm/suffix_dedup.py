"""Exact substring deduplication with longest-previous-factor arrays.

A byte goes if a string of ``least`` bytes over it also starts earlier in the
corpus.  Comparing all suffixes of a corpus needs no single suffix array: each
window of ``least`` bytes names its anchor, the 32-byte string in it with the
smallest hash, so equal windows have equal anchors.

1. Consecutive windows of a document with one anchor are a block, about 35
   bytes apart.  Blocks travel packed to the buckets of their anchors; copies of
   a block within a task's documents are settled before, so a passage that very
   many documents hold is a few entries.
2. Of equal blocks all but the first are repeats as a whole.  Blocks that share
   an anchor but differ are fetched as bytes.
3. Those are laid out in corpus order and sorted as suffixes; previous and next
   smaller positions in suffix order give each window's earlier match.
4. An anchor with very many surroundings (the end of a line that a third of all
   documents have) would make a group that no task can hold.  The windows of its
   blocks are told by 128-bit hashes instead, in an aggregate with map-side
   combine; such blocks travel spread and only their anchor's name goes to its
   bucket.
5. The repeats of a document are merged and cut out; the first copy stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import STEP, U64, blocks, column_bytes, give_back, mix, prefix_sums, span_hash
from docweave.llm.carry import CARRIED, carried, extended, numbered
from docweave.llm.jaccard_join import pack, unpack
from docweave.llm.store import written
from docweave.ship import shipped

ANCHOR = 32
#: Blocks in one packing, in one bucket on average, and bytes of one suffix array.
PACK = 300_000
BUCKET, SUFFIX_BYTES = 400_000, 1 << 20
#: Different blocks of one anchor, in a packing and in a bucket, from which the anchor is a hot one.
HOT, HOT_BUCKET = 256, 20_000
_ENTRY = [("key", U64), ("content", np.int64), ("id", np.int64), ("row", np.int64), ("start", np.int64), ("many", np.int64)]


def anchor_blocks(data: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(document, first start, last start, anchor hash, content hash) of the blocks of a run of documents."""
    n, width = len(data), least - ANCHOR + 1
    none = np.zeros(0, np.int64)
    long = np.diff(offsets) >= least
    if n < least or not long.any():
        return none, none, none, none.view(U64), none
    sums = prefix_sums(data)
    m = n - ANCHOR + 1
    at = np.arange(m)
    hashes = span_hash(sums, at, at + ANCHOR)
    # Smallest hash, then leftmost: the place stands in for the low bits.
    ranked = (hashes & U64(0xFFFFFFFF00000000)) | at.astype(U64)
    padded = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, dtype=U64)
    padded[:m] = ranked
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts_at = np.zeros(n + 1, dtype=np.int64)
    np.add.at(starts_at, offsets[:-1][long], 1)
    np.add.at(starts_at, offsets[1:][long] - least + 1, -1)
    start = np.flatnonzero(np.cumsum(starts_at[:-1]))
    least_rank = np.minimum(behind[start], ahead[start + width - 1])
    anchor = (least_rank & U64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    s1, s2, place = start[first], start[last], anchor[first]
    # Anchors are minima, so their hashes crowd at the low end; mixed again they spread over the buckets.
    content = mix(span_hash(sums, s1, s2 + least) + (place - s1).astype(U64) * U64(STEP))
    return np.searchsorted(offsets, s1, side="right") - 1, s1, s2, mix(hashes[place]), content.view(np.int64)


def _ordered(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """All entries by key, content and place; entries of rows that repeat wholly are one."""
    e = {c: np.concatenate([p[c] for p in parts]) for c, _ in _ENTRY}
    order = np.lexsort((e["start"], e["row"], e["id"], e["content"], e["key"]))
    e = {c: a[order] for c, a in e.items()}
    same = np.zeros(len(order), dtype=bool)
    same[1:] = np.logical_and.reduce([e[c][1:] == e[c][:-1] for c in ("start", "row", "id", "content", "key")])
    return {c: a[~same] for c, a in e.items()} if same.any() else e


def _merged(ids: np.ndarray, rows: np.ndarray, start: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of starts, joined where one goes on with the next; input in (id, row, start) order."""
    if not len(ids):
        return ids, rows, start, many
    joins = (ids[1:] == ids[:-1]) & (rows[1:] == rows[:-1]) & (start[1:] <= start[:-1] + many[:-1])
    first = np.flatnonzero(np.concatenate([[True], ~joins]))
    ends = np.maximum.reduceat(start + many, first)
    return ids[first], rows[first], start[first], ends - start[first]


_SENT = "bucket bigint, kind int, n int, keys binary, contents binary, places binary, starts binary, counts binary, owners binary"


def _send(docs: DataFrame, least: int, bits: int, buckets: int) -> DataFrame:
    """Packed blocks by bucket of their anchors (kind 0), and runs settled in place (kind 1).

    Blocks of hot anchors (kind 2) go anywhere, the anchors themselves (kind 3) to their buckets.
    """
    names = [c.split()[0] for c in _SENT.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6]

    def row(bucket: int, kind: int, e: dict[str, np.ndarray]) -> tuple:
        owners, local = np.unique(np.stack([e["id"], e["row"]], axis=1), axis=0, return_inverse=True)
        return (
            bucket, kind, len(e["id"]), pack(e["key"]), e["content"].tobytes() if kind == 0 else b"",
            local.reshape(-1).astype("<u4").tobytes(), e["start"].astype("<u4").tobytes(), e["many"].astype("<u4").tobytes(), owners.astype("<i8").tobytes(),
        )

    def flush(parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        e = _ordered(parts)
        new = np.ones(len(e["key"]), dtype=bool)
        new[1:] = (e["key"][1:] != e["key"][:-1]) | (e["content"][1:] != e["content"][:-1])
        later = ~new
        out = []
        if later.any():
            i = np.flatnonzero(later)
            i = i[np.lexsort((e["start"][i], e["row"][i], e["id"][i]))]
            ids, rows, start, many = _merged(e["id"][i], e["row"][i], e["start"][i], e["many"][i])
            whole = {"key": np.zeros(len(ids), U64), "id": ids, "row": rows, "start": start, "many": many}
            for at in range(0, len(ids), 20_000):
                cut = slice(at, at + 20_000)
                part = {c: a[cut] for c, a in whole.items()} | {"content": ids[cut]}
                out.append(row(int(ids[at]) % buckets, 1, part))
        own = {c: a[new] for c, a in e.items()}
        first = np.flatnonzero(np.concatenate([[True], own["key"][1:] != own["key"][:-1]]))
        count = np.diff(np.append(first, len(own["key"])))
        often = np.repeat(count >= HOT, count)
        marks = {c: a[first[count >= HOT]] for c, a in own.items()}
        if often.any():
            hot = {c: a[often] for c, a in own.items()}
            spread = (mix(hot["row"].view(U64)) % U64(buckets)).astype(np.int64)
            out += [row(buckets + b, 2, {c: a[spread == b] for c, a in hot.items()}) for b in np.unique(spread).tolist()]
        own = {c: a[~often] for c, a in own.items()}
        edges = np.array([min((b << bits) // buckets, (1 << 64) - 1) for b in range(buckets + 1)], dtype=U64)
        cut = np.searchsorted(own["key"], edges)
        cut[-1] = len(own["key"])
        out += [row(b, 0, {c: a[cut[b] : cut[b + 1]] for c, a in own.items()}) for b in range(buckets) if cut[b] < cut[b + 1]]
        cut = np.searchsorted(marks["key"], edges)
        cut[-1] = len(marks["key"])
        out += [row(b, 3, {c: a[cut[b] : cut[b + 1]] for c, a in marks.items()}) for b in range(buckets) if cut[b] < cut[b + 1]]
        for at in range(0, len(out), 16):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out[at : at + 16], strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for part in blocks(batch, "_text", 1 << 18):
                data, offsets = column_bytes(part.column("_text"))
                doc, s1, s2, key, content = anchor_blocks(data, offsets, least)
                ids, rows = (part.column(c).to_numpy(zero_copy_only=False) for c in ("_id", "_row"))
                parts.append({"key": key >> U64(64 - bits), "content": content, "id": ids[doc], "row": rows[doc], "start": s1 - offsets[doc], "many": s2 - s1 + 1})
                held += len(doc)
                if held >= PACK:
                    yield from flush(parts)
                    parts, held = [], 0
                    give_back()
        if held:
            yield from flush(parts)
        parts.clear()
        give_back()

    return docs.mapInArrow(run, _SENT)


_FOUND = "_id bigint, _row bigint, start bigint, many bigint, `group` bigint, hot boolean"


def _settle(sent: DataFrame, buckets: int) -> DataFrame:
    """Runs of repeated starts (group null), and blocks that must be compared, by group, or as windows where hot."""

    def bucket_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        parts, runs, marks = [], [], [np.zeros(0, U64)]
        for _, kind, n, keys, contents, places, starts, counts, owners in rows:
            owner = np.frombuffer(owners, "<i8").reshape(-1, 2)[np.frombuffer(places, "<u4")]
            e = {"id": owner[:, 0], "row": owner[:, 1], "start": np.frombuffer(starts, "<u4").astype(np.int64), "many": np.frombuffer(counts, "<u4").astype(np.int64)}
            if kind == 1:
                runs.append(e)
            elif kind == 2:
                yield out(*e.values(), np.zeros(n, np.int64), True)
            elif kind == 3:
                marks.append(unpack(keys, n))
            else:
                parts.append(e | {"key": unpack(keys, n), "content": np.frombuffer(contents, "<i8")})
        if parts:
            e = _ordered(parts)
            new_key = np.ones(len(e["key"]), dtype=bool)
            new_key[1:] = e["key"][1:] != e["key"][:-1]
            new = new_key.copy()
            new[1:] |= e["content"][1:] != e["content"][:-1]
            runs.append({c: e[c][~new] for c in ("id", "row", "start", "many")})
            group = np.cumsum(new_key) - 1
            kinds = np.bincount(group, weights=new).astype(np.int64)
            hot = (kinds >= HOT_BUCKET) | np.isin(e["key"][new_key], np.concatenate(marks))
            for some, told in ((new & (kinds[group] > 1) & ~hot[group], False), (new & hot[group], True)):
                if some.any():
                    yield out(*[e[c][some] for c in ("id", "row", "start", "many")], e["key"][some].view(np.int64), told)
        ids, rows_, start, many = (np.concatenate([r[c] for r in runs]) if runs else np.zeros(0, np.int64) for c in ("id", "row", "start", "many"))
        if len(ids):
            i = np.lexsort((start, rows_, ids))
            yield out(*_merged(ids[i], rows_[i], start[i], many[i]), None, False)

    def out(ids: np.ndarray, rows: np.ndarray, start: np.ndarray, many: np.ndarray, group: np.ndarray | None, hot: bool) -> pa.RecordBatch:
        last = pa.nulls(len(ids), pa.int64()) if group is None else pa.array(group)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(rows), pa.array(start), pa.array(many), last, pa.array([hot] * len(ids), pa.bool_())], names=["_id", "_row", "start", "many", "group", "hot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = tuple(c[i].as_py() for c in batch.columns)
                if rows and rows[0][0] != row[0]:
                    yield from bucket_rows(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from bucket_rows(rows)
        rows.clear()
        give_back()

    return sent.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, _FOUND)


def suffix_order(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``least`` symbols at least, and the class of each by just these symbols."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].reshape(-1).astype(np.int64)
    width, done = 1, 0
    classes = np.zeros(n, dtype=np.int64)

    def paired(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
        shifted = np.zeros(n, dtype=np.int64)
        if by < n:
            shifted[: n - by] = b[by:] + 1
        return np.unique(a * (n + 1) + shifted, return_inverse=True)[1].reshape(-1).astype(np.int64)

    while width <= least:
        if least & width:  # put the prefix together from powers of two
            classes = paired(classes, rank, done) if done else rank
            done += width
        if width * 2 > least:
            break
        rank = paired(rank, rank, width)
        width *= 2
    order = np.argsort(paired(classes, rank, least) if width < least else classes, kind="stable")
    return order, classes


def smaller_neighbours(order: np.ndarray) -> tuple[list[int], list[int]]:
    """For each position: the previous and the next smaller position in suffix order; -1 where none."""
    n = len(order)
    before, after, stack = [-1] * n, [-1] * n, []
    for p in order.tolist():
        while stack and stack[-1] > p:
            after[stack.pop()] = p
        if stack:
            before[p] = stack[-1]
        stack.append(p)
    return before, after


def earlier_match(symbols: np.ndarray, least: int) -> np.ndarray:
    """Whether the longest previous factor of each position reaches ``least``."""
    order, classes = suffix_order(symbols, least)
    # Positions alone in their class have no match of that length; the others keep their order.
    counts = np.bincount(classes)
    order = order[counts[classes[order]] > 1]
    kept = np.sort(order)
    place = np.searchsorted(kept, order)
    before, after = (np.array(a, dtype=np.int64) for a in smaller_neighbours(place))
    own = classes[kept]
    out = np.zeros(len(symbols), dtype=bool)
    if len(kept):
        out[kept] = ((before >= 0) & (own[before] == own)) | ((after >= 0) & (own[after] == own))
    return out


def _compare(blocks_: DataFrame, least: int) -> DataFrame:
    """Repeated starts of the blocks that differ though they share an anchor."""

    def compared(rows: list[tuple]) -> pa.RecordBatch:
        rows = sorted({r[1:4]: r for r in rows}.values(), key=lambda r: (r[1], r[2], r[3]))
        symbols, places = [], []
        at = 0
        for number, (_, _, _, _, raw) in enumerate(rows):
            symbols += [np.frombuffer(raw, np.uint8).astype(np.int64), np.array([256 + number])]  # ends differ
            places.append(at)
            at += len(raw) + 1
        again = earlier_match(np.concatenate(symbols), least)
        found = [(rows[i][1], rows[i][2], rows[i][3] + np.flatnonzero(again[places[i] : places[i] + len(rows[i][4]) - least + 1])) for i in range(len(rows))]
        n = [len(f[2]) for f in found]
        start = np.concatenate([f[2] for f in found]).astype(np.int64)
        ids, owners = np.repeat([f[0] for f in found], n).astype(np.int64), np.repeat([f[1] for f in found], n).astype(np.int64)
        i = np.lexsort((start, owners, ids))
        merged = _merged(ids[i], owners[i], start[i], np.ones(len(i), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(a) for a in merged], names=["_id", "_row", "start", "many"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held >= SUFFIX_BYTES and row[0] != rows[-1][0]:
                    yield compared(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[4])
        if rows:
            yield compared(rows)

    return blocks_.repartition("group").sortWithinPartitions("group").mapInArrow(run, "_id bigint, _row bigint, start bigint, many bigint")


_BYTES = "`group` bigint, _id bigint, _row bigint, start bigint, bytes binary, h1 bigint, h2 bigint"


def _fetched(source: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """Of the wanted blocks the bytes, by group; of hot ones the hashes of their windows, one row each, without a group."""
    asked = wanted.groupBy("_id", "_row").agg(F.collect_set(F.struct("group", "start", "many", "hot")).alias("_wanted"))
    names = [c.split()[0].strip("`") for c in _BYTES.split(", ")]

    def windows(raw: bytes, starts: list[np.ndarray], own: int, row: int) -> pa.RecordBatch:
        data, at = np.frombuffer(raw, np.uint8), np.unique(np.concatenate(starts))
        hashes = [pa.array(span_hash(prefix_sums(d), at, at + least).view(np.int64)) for d in (data, data ^ 0xA5)]
        none = [pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary())]
        return pa.RecordBatch.from_arrays([none[0], *[pa.array(np.full(len(at), x, np.int64)) for x in (own, row)], pa.array(at), none[1], *hashes], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                out: list[tuple] = []
                part = batch.slice(at, 64)
                texts = part.column("_text").cast(pa.binary()).to_pylist()
                for own, row, raw, asked_ in zip(part.column("_id").to_pylist(), part.column("_row").to_pylist(), texts, part.column("_wanted").to_pylist(), strict=True):
                    out += [(w["group"], own, row, w["start"], raw[w["start"] : w["start"] + w["many"] - 1 + least], None, None) for w in asked_ if not w["hot"]]
                    hot = [np.arange(w["start"], w["start"] + w["many"]) for w in asked_ if w["hot"]]
                    if hot:
                        yield windows(raw, hot, own, row)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return source.join(asked, ["_id", "_row"]).select("_id", "_row", "_text", "_wanted").mapInArrow(run, _BYTES)


def _again(windows: DataFrame) -> DataFrame:
    """Repeated starts among windows: all but the first place of each 128-bit hash."""
    place = F.struct("_id", "_row", "start")
    firsts = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("h1", "h2", "first")
    return windows.join(firsts, ["h1", "h2"]).where(place != F.col("first")).select("_id", "_row", "start", F.lit(1).cast("long").alias("many"))


def suffix_dedup(docs: DataFrame, least: int = 100, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default) plus n_bytes, n_removed, n_spans, spans, kept (binary), kept_sha256.

    Documents are ordered by doc_id, of any type that sorts; null ids come last.
    Rows that share a doc_id are ordered by a hash of the text, and rows that
    repeat wholly are one document.  spans: removed byte ranges, ends exclusive.
    Null is empty; texts under ``least`` bytes lose nothing, longer ones are
    compared whole; an empty table gives no rows.  Columns of ``keep`` may have
    any name but the six made here, which replace them.
    """
    spark = shipped(docs.sparkSession)
    if least <= ANCHOR:
        raise ValueError(f"least must be over {ANCHOR}")
    made = ["n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"]
    every = docs.select(carried(docs, keep or [doc_id], made), F.col(doc_id).alias("_own"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    every = numbered(every, "_own").withColumnRenamed("_order", "_id").withColumn("_row", F.xxhash64("_text"))
    source = every.select("_id", "_row", "_text")
    total = source.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    expected = max(1, int(total) * 2 // (least - ANCHOR + 2))
    bits = min(64, expected.bit_length() + 20)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, -(-expected // BUCKET), 1)
    found = written(_settle(_send(source.where(F.octet_length("_text") >= least), least, bits, buckets), buckets), "suffix-blocks")
    unique = source.where(F.octet_length("_text") >= least)
    fetched = written(_fetched(unique, found.where("`group` is not null"), least), "suffix-bytes")
    compared = _compare(fetched.where("`group` is not null").select("group", "_id", "_row", "start", "bytes"), least)
    windows = _again(fetched.where("`group` is null").select("h1", "h2", "_id", "_row", "start"))
    runs = found.where("`group` is null").select("_id", "_row", "start", "many").unionAll(compared).unionAll(windows)
    per_row = runs.groupBy("_id", "_row").agg(F.collect_list(F.struct("start", "many")).alias("_runs"))
    rows = every.select(CARRIED, "_id", "_row", "_text").join(per_row, ["_id", "_row"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[tuple] = []
                for raw, own in zip(part.column("_text").cast(pa.binary()).to_pylist(), part.column("_runs").to_pylist(), strict=True):
                    merged: list[list[int]] = []
                    for start, end in sorted((r["start"], r["start"] + r["many"] - 1 + least) for r in own or ()):
                        if merged and start <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], end)
                        else:
                            merged.append([start, end])
                    ends = [0, *[e for _, e in merged]]
                    kept = b"".join(raw[a:b] for a, b in zip(ends, [*[s for s, _ in merged], len(raw)], strict=True))
                    out.append((len(raw), len(raw) - len(kept), len(merged), [{"start": a, "end": b} for a, b in merged], kept, hashlib.sha256(kept).hexdigest()))
                types = [pa.int64(), pa.int64(), pa.int64(), span, pa.binary(), pa.string()]
                arrays = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(CARRIED), *arrays], names=[CARRIED, *made])

    schema = extended(rows, [CARRIED], "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string")
    return rows.select(CARRIED, "_text", "_runs").mapInArrow(run, schema).select(f"{CARRIED}.*", *made)
