"""Benchmark decontamination with a stored positional inverted index of the documents.

The index is one row for each block of documents: its terms, of each the number
of documents that hold it, and their positions, written to the shared folder.
So postings are spread as the documents are, a passage that a third of all
documents hold too, and neither postings nor texts are shuffled; any number of
query sets reads the index, not the texts.

A window of item words is searched by intersecting the posting lists of its
terms, each shifted by the term's offset, from the rarest in the block.  A
proximity search takes the terms of an item that the fewest documents of the
whole corpus hold: most of them must stand within the item's length of a place
of one of the rarest, so an edited passage is found though some of them are
changed.  All items are searched in a block at once.  The items are the query
set: they are sent to the blocks in parts of a bounded size, one part at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructType

from docweave.llm.blocks import IS_ALNUM, LOWER, U64, blocks, column_bytes, prefix_sums, span_hash, word_hashes, word_spans
from docweave.llm.carry import CARRIED, carried
from docweave.llm.jaccard_join import pack, unpack
from docweave.llm.store import written
from docweave.ship import shipped

#: Bytes of item text in one part of the query set: a part has less than this and its last item.
PART_BYTES = 16 << 20
_HITS = "array<struct<start:bigint,end:bigint>>"
#: Rarest terms of an item that a proximity search takes, how many of each eight of them must stand together, and how many at least.
RAREST, OF_EIGHT, LEAST_TERMS = 8, 5, 4
#: Places around which a search looks at once.
PLACES = 1 << 17


@dataclass
class QuerySet:
    """Item windows as numbers of a sorted vocabulary of word hashes."""

    vocabulary: np.ndarray
    #: The place of each word in the order of the words themselves.
    rank: np.ndarray
    windows: np.ndarray
    sizes: np.ndarray
    items: list[list[Any]]
    terms: dict[Any, np.ndarray]
    #: Words of each item's longest text.
    lengths: dict[Any, int]

    @classmethod
    def of(cls, items: list[tuple[Any, str]], width: int) -> QuerySet:
        raw, offsets = column_bytes(pa.array([t or "" for _, t in items], pa.string()))
        data = LOWER[raw]
        starts, ends, rows = word_spans(data, offsets, IS_ALNUM)
        vocabulary, first, numbers = np.unique(span_hash(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
        numbers, bounds = numbers.reshape(-1), np.searchsorted(rows, np.arange(len(offsets)), side="left")
        text = data.tobytes()
        words = [text[starts[i] : ends[i]] for i in first.tolist()]
        rank = np.empty(len(words), dtype=np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        holders: dict[tuple[int, ...], set] = {}
        terms: dict[Any, set[int]] = {}
        lengths: dict[Any, int] = {}
        for (item, _), a, b in zip(items, bounds[:-1], bounds[1:], strict=True):
            own = numbers[a:b].tolist()
            terms.setdefault(item, set()).update(own)
            lengths[item] = max(lengths.get(item, 0), len(own))
            for i in range(max(1, len(own) - width + 1) if own else 0):
                holders.setdefault(tuple(own[i : i + width]), set()).add(item)
        table = np.full((len(holders), width), -1, dtype=np.int64)
        for i, w in enumerate(holders):
            table[i, : len(w)] = w
        sizes = np.array([len(w) for w in holders], dtype=np.int64)
        return cls(vocabulary, rank, table, sizes, [sorted(x) for x in holders.values()], {i: np.array(sorted(t), dtype=np.int64) for i, t in terms.items() if t}, lengths)


def query_sets(items: DataFrame, width: int, part_bytes: int) -> Iterator[QuerySet]:
    """The items (item, text) in parts; the driver holds one part at a time."""
    size = F.octet_length("text") + 64
    total = items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    held, room = list[tuple[Any, str]](), 0
    # Rows of one item are neighbours, so that they come into one part.
    for item, text in items.repartition(max(1, -(-int(total) // part_bytes)), "item").sortWithinPartitions("item").select("item", "text").toLocalIterator():
        if room >= part_bytes and item != held[-1][0]:
            yield QuerySet.of(held, width)
            held, room = [], 0
        held.append((item, text))
        room += len(text.encode()) + 64
    if held:
        yield QuerySet.of(held, width)


#: One row a block; the last column but two says how many documents it has, these have their columns and words.
_INDEX = "block bigint, words bigint, terms binary, counts binary, holders binary, postings binary, bounds binary, documents bigint"


def positional_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs`` (_carried, _text), and of each block its documents in order (_docs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                words, bounds = word_hashes(*column_bytes(part.column("_text")), IS_ALNUM)
                n = len(words)
                terms, number, counts = np.unique(words, return_inverse=True, return_counts=True)
                order = np.argsort(number.reshape(-1), kind="stable")
                rows = np.repeat(np.arange(part.num_rows), np.diff(bounds))[order]
                term = number.reshape(-1)[order]
                new = np.ones(n, dtype=bool)
                new[1:] = (term[1:] != term[:-1]) | (rows[1:] != rows[:-1])
                values = [uuid.uuid4().int >> 65, n, pack(terms), counts.astype("<u4").tobytes(), np.bincount(term[new], minlength=len(terms)).astype("<u4").tobytes(), pack(term.astype(U64) * U64(n) + order.astype(U64)), pack(bounds.astype(U64)), part.num_rows]
                lists = [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), c) for c in (part.column(CARRIED), pa.array(np.diff(bounds), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*[pa.array([v]) for v in values], *lists], names=schema.names)

    schema = StructType.fromDDL(_INDEX).add("_docs", ArrayType(docs.schema[CARRIED].dataType)).add("_words", ArrayType(LongType()))
    return docs.mapInArrow(run, schema)


class Block:
    """A block of the index, as far as a query set asks."""

    def __init__(self, row: dict[str, Any], vocabulary: np.ndarray):
        self.n = row["words"]
        counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
        terms = unpack(row["terms"], len(counts))
        place = np.searchsorted(terms, vocabulary)
        place[place == len(terms)] = 0
        known = terms[place] == vocabulary if len(terms) else np.zeros(len(vocabulary), bool)
        starts = np.cumsum(counts) - counts
        self.counts = np.where(known, counts[place], 0) if len(terms) else np.zeros(len(vocabulary), np.int64)
        self.starts = starts[place] if len(terms) else self.counts
        #: Term of the block times words, plus position, in order; and the block's number of each vocabulary term.
        self.keys, self.places = unpack(row["postings"], self.n).astype(np.int64), place
        self.positions = self.keys % max(self.n, 1)
        self.bounds = unpack(row["bounds"], row["documents"] + 1).astype(np.int64)
        self.rows = np.repeat(np.arange(row["documents"]), np.diff(self.bounds))

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.starts[term] : self.starts[term] + self.counts[term]]

    def phrase(self, terms: np.ndarray) -> np.ndarray:
        """First positions of the places where the terms stand in a row, within one document."""
        offsets = np.argsort(self.counts[terms], kind="stable")
        found = None
        for j in offsets.tolist():
            shifted = self.postings(terms[j]) - j
            if found is None:
                found = shifted[(shifted >= 0) & (shifted + len(terms) <= self.n)]
            else:
                at = np.searchsorted(shifted, found)
                at[at == len(shifted)] = 0
                found = found[shifted[at] == found]
            if not len(found):
                return found
        return found[self.rows[found] == self.rows[found + len(terms) - 1]]

    def near(self, terms: np.ndarray, needed: np.ndarray, reach: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, row, start, end) of the places where enough of an item's terms stand together.

        terms: a row of vocabulary numbers for each item, rarest first, -1 behind
        them.  Around each place of one of the rarest, of which one must be in any
        such passage, the terms within ``reach`` words in the same document are
        counted.  Spans hold these terms; those of an item that meet are one.
        """
        known = (terms >= 0) & (self.counts[terms] > 0)
        starting = np.arange(terms.shape[1]) < ((terms >= 0).sum(axis=1) - needed + 1)[:, None]
        item, column = np.nonzero(known & starting & ((known.sum(axis=1) >= needed) & (needed > 0))[:, None])
        sizes = self.counts[terms[item, column]]
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(item):
            # As many lists as give so many places, at least one.
            end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PLACES, side="right")))
            yield from self._around(terms, needed, reach, np.repeat(item[begin:end], sizes[begin:end]), np.concatenate([self.postings(t) for t in terms[item[begin:end], column[begin:end]].tolist()]))
            begin = end

    def _around(self, terms: np.ndarray, needed: np.ndarray, reach: np.ndarray, item: np.ndarray, centre: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        row = self.rows[centre]
        low, high = np.maximum(centre - reach[item], self.bounds[row]), np.minimum(centre + reach[item], self.bounds[row + 1] - 1)
        first, last, found = centre.copy(), centre.copy(), np.zeros(len(centre), np.int64)
        for j in range(terms.shape[1]):
            term = terms[item, j]
            have = np.flatnonzero((term >= 0) & (self.counts[term] > 0))
            base = self.places[term[have]].astype(np.int64) * self.n
            a = np.searchsorted(self.keys, base + low[have])
            b = np.searchsorted(self.keys, base + high[have], side="right")
            some = a < b
            have, a, b, base = have[some], a[some], b[some], base[some]
            found[have] += 1
            first[have] = np.minimum(first[have], self.keys[a] - base)
            last[have] = np.maximum(last[have], self.keys[b - 1] - base)
        good = np.flatnonzero(found >= needed[item])
        good = good[np.lexsort((first[good], row[good], item[good]))]
        now: list[int] | None = None
        for i, r, x, y in zip(item[good].tolist(), row[good].tolist(), first[good].tolist(), (last[good] + 1).tolist(), strict=True):
            x, y = x - int(self.bounds[r]), y - int(self.bounds[r])
            if now is not None and now[:2] == [i, r] and x <= now[3]:
                now[3] = max(now[3], y)
            else:
                if now is not None:
                    yield now[0], now[1], now[2], now[3]
                now = [i, r, x, y]
        if now is not None:
            yield now[0], now[1], now[2], now[3]


def rare_terms(index: DataFrame, query: QuerySet, rarest: int) -> dict[Any, np.ndarray]:
    """Of each item the terms that the fewest documents hold, of those that any holds; words in order on ties."""
    vocabulary = index.sparkSession.sparkContext.broadcast(query.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary.value), dtype=np.int64)
        for batch in batches:
            for packed, held in zip(batch.column("terms"), batch.column("holders"), strict=True):
                holders = np.frombuffer(held.as_py(), "<u4")
                terms = unpack(packed.as_py(), len(holders))
                if len(terms):
                    place = np.searchsorted(terms, vocabulary.value)
                    place[place == len(terms)] = 0
                    total += np.where(terms[place] == vocabulary.value, holders[place], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["term", "n"])

    counts = np.zeros(len(query.vocabulary), dtype=np.int64)
    # At most one row a term of this part of the query set.
    for term, n in index.select("terms", "holders").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        counts[term] = n
    vocabulary.destroy()
    held = {item: terms[counts[terms] > 0] for item, terms in query.terms.items()}
    return {item: terms[np.lexsort((query.rank[terms], counts[terms]))][:rarest] for item, terms in held.items()}


def proximity(query: QuerySet) -> tuple[list[Any], np.ndarray, np.ndarray, np.ndarray]:
    """Items, their rare terms (a row each, -1 behind), how many must stand together, and within how many words.

    Items with fewer than LEAST_TERMS known terms take no part: none is needed of them.
    """
    items = list(query.terms)
    width = max([1, *[len(t) for t in query.terms.values()]])
    terms = np.full((len(items), width), -1, dtype=np.int64)
    for i, item in enumerate(items):
        terms[i, : len(query.terms[item])] = query.terms[item]
    many = (terms >= 0).sum(axis=1)
    needed = np.where(many >= LEAST_TERMS, np.maximum(LEAST_TERMS, (OF_EIGHT * many + 7) // 8), 0)
    return items, terms, needed, np.array([query.lengths[i] for i in items], dtype=np.int64)


def _search(index: Block, query: QuerySet) -> dict[int, tuple[list[dict], list, list[dict]]]:
    """Of each document with findings: spans of hits, items, proximity matches."""
    items: dict[int, set] = {}
    cover = np.zeros(index.n + 1, dtype=np.int64)
    if len(query.windows):
        present = np.where(query.windows >= 0, index.counts[query.windows], 1 << 60).min(axis=1) > 0
        for w in np.flatnonzero(present).tolist():
            size = int(query.sizes[w])
            found = index.phrase(query.windows[w, :size])
            np.add.at(cover, found, 1)
            np.add.at(cover, found + size, -1)
            for row in set(index.rows[found].tolist()):
                items.setdefault(row, set()).update(query.items[w])
    covered = np.cumsum(cover[:-1]) > 0
    edge = np.zeros(index.n + 1, dtype=bool)
    edge[index.bounds] = True  # a span doesn't run on into the next document
    before, after = np.zeros(index.n, bool), np.zeros(index.n, bool)
    if index.n:
        before[1:] = covered[:-1]
        before[edge[:-1]] = False
        after[:-1] = covered[1:]
        after[edge[1:]] = False
    spans: dict[int, list[dict]] = {}
    for a, b in zip(np.flatnonzero(covered & ~before).tolist(), (np.flatnonzero(covered & ~after) + 1).tolist(), strict=True):
        row = int(index.rows[a])
        spans.setdefault(row, []).append({"start": a - int(index.bounds[row]), "end": b - int(index.bounds[row])})
    close: dict[int, list[dict]] = {}
    names, terms, needed, reach = proximity(query)
    for i, row, start, end in index.near(terms, needed, reach) if names else ():
        if names[i] not in items.get(row, ()):
            close.setdefault(row, []).append({"item": names[i], "start": start, "end": end})
    return {row: (spans.get(row, []), sorted(items.get(row, ())), close.get(row, [])) for row in sorted({*spans, *items, *close})}


def _findings(index: DataFrame, shared: Broadcast, schema: StructType) -> DataFrame:
    """One row for each document of the index with findings of the query set."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found = _search(Block(row, query.vocabulary), query)
                out = [{"block": row["block"], "at": at, "hits": hits, "items": items, "near": near} for at, (hits, items, near) in found.items()]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return index.drop("_docs", "_words", "holders").mapInArrow(run, schema)


def _merged(spans: Column) -> Column:
    """Sorted spans, those that meet joined."""
    return F.aggregate(
        spans,
        F.array().cast(_HITS),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["end"] >= s["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["start"].alias("start"), F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(a, F.array(s))),
    )


def decontaminate(docs: DataFrame, items: DataFrame, width: int = 10, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text", rarest: int = RAREST, part_bytes: int = PART_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus n_words, bench_hits, bench_items, n_near, near.

    bench_hits: merged spans of document words inside occurrences of item
    windows; bench_items: ids of the items with such windows, sorted; n_near:
    further items of whose ``rarest`` terms (those of the fewest documents in the
    whole corpus, ties by word; terms that no document holds are skipped) five of
    eight, four at least, stand within the item's length of a place of one of the
    rarest; items with fewer than four such terms are left out; near: item and
    span of each such passage.  Ids may be of
    any type that sorts.  Null or empty texts have no words; items without words
    or without id match nothing; items that share an id are one item; rows that
    repeat have the same findings each; texts of any length are indexed whole; an
    empty table gives no rows.  Columns of the names made here are replaced;
    others may have any name.
    """
    spark = shipped(docs.sparkSession)
    made = ["n_words", "bench_hits", "bench_items", "n_near", "near"]
    index = written(positional_index(docs.select(carried(docs, keep, made), F.col(text).alias("_text"))), "bench-index")
    used = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("text")).where("item is not null and text is not null")
    id_type = used.schema["item"].dataType
    near_type = f"array<struct<item:{id_type.simpleString()},start:bigint,end:bigint>>"
    schema = StructType.fromDDL(f"block bigint, at int, hits {_HITS}, items array<{id_type.simpleString()}>, near {near_type}")
    found = spark.createDataFrame([], schema)
    for query in query_sets(used, width, part_bytes):
        query.terms = rare_terms(index, query, rarest)
        shared = spark.sparkContext.broadcast(query)
        found = found.unionByName(written(_findings(index, shared, schema), "bench-findings"))
        shared.destroy()
    # A document's findings in the parts of the query set, which are one part nearly always.
    merged = found.groupBy("block", "at").agg(
        _merged(F.array_sort(F.flatten(F.collect_list("hits")))).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("_items"),
        F.array_sort(F.flatten(F.collect_list("near"))).alias("_near"),
    )
    each = index.select("block", F.posexplode(F.arrays_zip("_docs", "_words")).alias("at", "_doc"))
    joined = each.select("block", "at", F.col("_doc._docs").alias(CARRIED), "_doc._words").join(merged, ["block", "at"], "left")
    near = F.coalesce("_near", F.array().cast(near_type))
    return joined.select(
        f"{CARRIED}.*", F.col("_words").alias("n_words"), F.coalesce("_hits", F.array().cast(_HITS)).alias("bench_hits"),
        F.coalesce("_items", F.array().cast(f"array<{id_type.simpleString()}>")).alias("bench_items"),
        F.size(F.array_distinct(F.transform(near, lambda m: m["item"]))).cast("long").alias("n_near"), near.alias("near"),
    )
