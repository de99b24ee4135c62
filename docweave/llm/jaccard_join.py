"""Exact Jaccard self-join on word shingles.

1. Each text becomes the set of its shingle hashes; equal sets share a
   signature and are one set from there on.
2. The pairs (shingle, signature) travel packed, as sorted differences, to the
   buckets of the shingles; a bucket returns those that two sets at least hold,
   with their frequency.  Shingles that are frequent in one task's documents
   travel spread over buckets, so that no bucket has more of them than others.
3. A set can link only if enough of its shingles are shared.  The sets left
   meet over the rarest shingles of each (prefix filter in order of frequency),
   which are the groups of an inverted index.
4. Within groups a T-occurrence search finds and counts each link once
   (``overlap``), and components of links are the classes.  Copies count by
   number; no step emits all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import U64, blocks, column_bytes, give_back, mix, shingle_hashes, word_hashes
from docweave.llm.carry import CARRIED, carried, extended
from docweave.llm.components import connected_components
from docweave.llm.overlap import in_groups, linked
from docweave.llm.store import written
from docweave.ship import shipped

#: Pairs in one packing, in one bucket on average, and compared at once.
PACK, BUCKET, PART = 1_500_000, 6_000_000, 1_000_000
#: Sets of one packing that make a shingle frequent, and the frequency it then has.
FREQUENT, MANY = 64, 1 << 30


def shingle_sets(batch: pa.RecordBatch, text: str, k: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, shingles, row numbers, set sizes, signatures) for blocks of a batch."""
    for part in blocks(batch, text):
        words, bounds = word_hashes(*column_bytes(part.column(text)))
        shingles, rows = shingle_hashes(words, bounds, k)
        order = np.lexsort((shingles, rows))
        shingles, rows = shingles[order], rows[order]
        if len(shingles):
            first = np.ones(len(shingles), dtype=bool)
            first[1:] = (shingles[1:] != shingles[:-1]) | (rows[1:] != rows[:-1])
            shingles, rows = shingles[first], rows[first]
        sizes = np.bincount(rows, minlength=part.num_rows)
        sums = np.zeros(len(shingles) + 1, dtype=U64)
        np.cumsum(mix(shingles), out=sums[1:])
        ends = np.cumsum(sizes)
        signature = mix(sums[ends] - sums[ends - sizes] + sizes.astype(U64)).view(np.int64)
        yield part, shingles, rows, sizes, signature


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """The columns but _text, n_shingles and the name of the set (_set, null without shingles) of each row."""
    keep = [c for c in docs.columns if c != "_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for part, _, _, sizes, signature in shingle_sets(batch, "_text", k):
                arrays = [part.column(c) for c in keep]
                arrays += [pa.array(sizes, pa.int64()), pa.array(signature, pa.int64(), mask=sizes == 0)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_shingles", "_set"])

    return docs.mapInArrow(run, extended(docs, keep, "n_shingles bigint, _set bigint"))


def pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers as differences, least bytes first, so that high zero bytes compress away."""
    differences = np.diff(numbers, prepend=U64(0)).astype("<u8")
    planes = differences.view(np.uint8).reshape(-1, 8).T
    used = max(1, int(np.flatnonzero(planes.any(axis=1)).max(initial=0)) + 1)
    return np.ascontiguousarray(planes[:used]).tobytes()


def unpack(packed: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), dtype=np.uint8)
    if n:
        used = np.frombuffer(packed, dtype=np.uint8).reshape(-1, n)
        planes[: len(used)] = used
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(-1), dtype=U64)


_PACKED = "bucket bigint, n int, frequent boolean, keys binary, places binary, owners binary"


def packed_pairs(docs: DataFrame, k: int, bits: int, buckets: int) -> DataFrame:
    """Packed (shingle, signature) pairs by bucket; shingles are cut to ``bits`` bits."""

    def rows(bucket: int, frequent: bool, keys: np.ndarray, places: np.ndarray, owners: np.ndarray) -> dict:
        used, local = np.unique(places, return_inverse=True)
        local = local.reshape(-1)
        return {
            "bucket": bucket, "n": len(keys), "frequent": frequent, "keys": pack(keys),
            "places": local.astype("<u2" if len(used) <= 1 << 16 else "<u4").tobytes(), "owners": owners[used].tobytes(),
        }

    def flush(keys: np.ndarray, places: np.ndarray, owners: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(first, len(keys)))
        often = np.repeat(counts >= FREQUENT, counts)
        marks = keys[first[counts >= FREQUENT]]
        out = []
        rare_keys, rare_places = keys[~often], places[~often]
        edges = [(b << bits) // buckets for b in range(buckets + 1)]
        cut = np.searchsorted(rare_keys, np.array([min(e, (1 << 64) - 1) for e in edges], dtype=U64))
        mark_cut = np.searchsorted(marks, np.array([min(e, (1 << 64) - 1) for e in edges], dtype=U64))
        for b in range(buckets):
            if cut[b] < cut[b + 1]:
                out.append(rows(b, False, rare_keys[cut[b] : cut[b + 1]], rare_places[cut[b] : cut[b + 1]], owners))
            if mark_cut[b] < mark_cut[b + 1]:
                own = marks[mark_cut[b] : mark_cut[b + 1]]
                out.append({"bucket": b, "n": len(own), "frequent": True, "keys": pack(own), "places": b"", "owners": b""})
        if often.any():
            spread = (mix(owners.view(U64)) % U64(buckets)).astype(np.int64)[places[often]]
            some_keys, some_places = keys[often], places[often]
            for b in np.unique(spread).tolist():
                out.append(rows(buckets + b, True, some_keys[spread == b], some_places[spread == b], owners))
        for at in range(0, len(out), 64):
            part = out[at : at + 64]
            types = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            names = ["bucket", "n", "frequent", "keys", "places", "owners"]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in part], t) for c, t in zip(names, types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        keys: list[np.ndarray] = []
        places: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        held, sets, seen = 0, 0, set()
        for batch in batches:
            for _, shingles, row_numbers, sizes, signature in shingle_sets(batch, "_text", k):
                new = sizes > 0
                for i in np.flatnonzero(new).tolist():
                    own = int(signature[i])
                    if own in seen:
                        new[i] = False
                    seen.add(own)
                number = np.cumsum(new) - 1 + sets
                take = new[row_numbers]
                keys.append(shingles[take] >> U64(64 - bits))
                places.append(number[row_numbers[take]])
                owners.append(signature[new])
                held, sets = held + int(take.sum()), sets + int(new.sum())
                if held >= PACK:
                    yield from flush(np.concatenate(keys), np.concatenate(places), np.concatenate(owners))
                    keys, places, owners, held, sets, seen = [], [], [], 0, 0, set()
        if held:
            yield from flush(np.concatenate(keys), np.concatenate(places), np.concatenate(owners))

    return docs.mapInArrow(run, _PACKED)


def shared_shingles(packed: DataFrame, buckets: int) -> DataFrame:
    """(signature, frequency, shingle) of the shingles that two sets at least hold."""

    def bucket_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        # A few wide buckets share each packing's list of owners; shingles are compared in ranges.
        far, marks, held = rows[0][0] >= buckets, [], []
        for _, n, frequent, packed_keys, places, owner_bytes in rows:
            own = unpack(packed_keys, n)
            if frequent and not far:
                marks.append(own)
                continue
            names = np.frombuffer(owner_bytes, dtype=np.int64)
            held.append((own, np.frombuffer(places, dtype="<u2" if len(names) <= 1 << 16 else "<u4"), names))
        total = sum(len(own) for own, _, _ in held)
        if not total:
            return
        marked = np.concatenate(marks) if marks else np.zeros(0, U64)
        low = min(int(own[0]) for own, _, _ in held if len(own))
        high = max(int(own[-1]) for own, _, _ in held if len(own))
        parts = -(-total // PART)
        for i in range(parts):
            a, b = low + (high + 1 - low) * i // parts, low + (high + 1 - low) * (i + 1) // parts
            keys, owners = [], []
            for own, places, names in held:
                cut = slice(int(np.searchsorted(own, U64(a))), len(own) if b > high else int(np.searchsorted(own, U64(b))))
                keys.append(own[cut])
                owners.append(names[places[cut]])
            made = compared(keys, owners, marked, far)
            if made is not None:
                yield made

    def compared(keys: list[np.ndarray], owners: list[np.ndarray], marks: np.ndarray, far: bool) -> pa.RecordBatch | None:
        if not sum(map(len, keys)):
            return None
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        once = np.ones(len(key), dtype=bool)
        once[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
        key, owner = key[once], owner[once]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(np.append(first, len(key)))
        if far:
            counts[:] = MANY
        elif len(marks):
            counts[np.isin(key[first], marks)] = MANY
        often = np.repeat(counts, np.diff(np.append(first, len(key))))
        take = often >= 2
        arrays = [pa.array(owner[take]), pa.array(often[take].astype(np.int32)), pa.array(key[take].astype(np.int64))]
        return pa.RecordBatch.from_arrays(arrays, names=["signature", "frequency", "shingle"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("bucket", "n", "frequent", "keys", "places", "owners")], strict=True):
                if rows and rows[0][0] != row[0]:
                    yield from bucket_rows(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from bucket_rows(rows)

    dealt = packed.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "signature bigint, frequency int, shingle bigint")


def candidate_sets(shared: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """id, size, keys (rarest first) and prefix of the sets with enough shared shingles."""

    def groups(table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> pa.RecordBatch:
        owner, often, key = table
        once = np.ones(len(owner), dtype=bool)
        once[1:] = (owner[1:] != owner[:-1]) | (often[1:] != often[:-1]) | (key[1:] != key[:-1])
        owner, often, key = owner[once], often[once], key[once]
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ends = np.append(first[1:], len(owner))
        size = np.where(often[first] < 0, key[first], 0)  # the row of the size sorts first
        held = ends - first - 1
        least = -(-percent * size // 100)
        good = np.flatnonzero((size > 0) & (held >= least))
        lists = [key[first[g] + 1 : ends[g]] for g in good.tolist()]
        offsets = np.concatenate([[0], np.cumsum(held[good])]).astype(np.int32)
        values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
        arrays = [pa.array(owner[first[good]]), pa.array(size[good]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array((held - least + 1)[good].astype(np.int32))]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "size", "keys", "prefix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        rest = tuple(np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            now = tuple(np.concatenate([r, batch.column(i).to_numpy(zero_copy_only=False)]) for i, r in enumerate(rest))
            if not len(now[0]):
                continue
            cut = int(np.searchsorted(now[0], now[0][-1], side="left"))
            if cut:
                yield groups(tuple(a[:cut] for a in now))
            rest = tuple(a[cut:] for a in now)
        if len(rest[0]):
            yield groups(rest)

    rows = shared.unionAll(sizes.select(F.col("id").alias("signature"), F.lit(-1).alias("frequency"), F.col("n").alias("shingle")))
    rows = rows.repartition("signature").sortWithinPartitions("signature", "frequency", "shingle")
    return rows.mapInArrow(run, "id bigint, size bigint, keys array<bigint>, prefix int")


def prefix_places(sets: DataFrame) -> DataFrame:
    """(group, id): the prefix keys of each set, which are its rarest."""
    return sets.select("id", F.explode(F.slice("keys", F.lit(1), F.col("prefix"))).alias("group"))


def jaccard_join(docs: DataFrame, percent: int = 75, k: int = 5, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default), n_shingles, n_links and component_id of every row.

    Rows link when their shingle sets reach ``percent``; n_links counts the
    other rows that a row links with, component_id is the smallest doc_id that
    links reach.  Rows without words link with nothing and are their own
    component.  Rows that repeat, or share a doc_id, are rows of their own; null
    doc_ids are never the smallest unless alone.  Columns of ``keep`` may have any
    name but the three made here, which replace them.  An empty table gives no
    rows.  A copy of the shingles is cut to enough bits that chance meetings are
    one in 2**20.
    """
    spark = shipped(docs.sparkSession)
    made = ["n_shingles", "n_links", "component_id"]
    whole = docs.select(carried(docs, keep or [doc_id], made), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = written(signatures(whole, k), "jaccard-rows")
    sizes = rows.where("_set is not null").groupBy(F.col("_set").alias("id")).agg(F.first("n_shingles").alias("n"), F.count("*").alias("copies"))
    total = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    bits = min(64, max(2, int(total)).bit_length() + 20)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")) // 2, -(-int(total) // BUCKET), 1)
    shared = shared_shingles(packed_pairs(whole.select("_text"), k, bits, buckets), buckets)
    sets = written(candidate_sets(shared, sizes, percent), "jaccard-sets")
    postings = in_groups(sets.join(sizes.select("id", "copies"), "id").select("id", "copies", "size", "keys"), prefix_places(sets))
    links = written(linked(postings, percent), "jaccard-links")
    roots = connected_components(links.where("b is not null")).select(F.col("node").alias("id"), "root")
    counts = links.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("_links"))
    # One row a distinct set: its class, and the rows it links with beside its own copies.
    named = sizes.join(roots, "id", "left").join(counts, "id", "left").select(
        F.col("id").alias("_set"), F.coalesce("root", "id").alias("_class"), (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    classed = rows.join(named, "_set", "left")
    least = classed.where("_class is not null").groupBy("_class").agg(F.min("_id").alias("_least"))
    return classed.join(least, "_class", "left").select(
        f"{CARRIED}.*", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_least", "_id").alias("component_id")
    )
