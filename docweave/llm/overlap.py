"""Exact Jaccard links by T-occurrence search, in groups of an inverted index.

Every set stands in the groups of some of its keys (its rarest ones, or the
bands it agrees in).  Sets that can link share a group at least.  ``linked``
deals the sets to their groups; within one, each set searches the inverted lists
of the others with DivideSkip: the short lists are merged, the long ones probed
by binary search, and sets that reach the needed overlap are links.

Sets that groups connect go to one unit of work where they fit.  Larger connected
parts are worked on group by group.  There a pair that shares several groups
belongs to the first of them, so each link is found and counted once.  Most pairs
of a large group share an earlier group, and need not even be looked at:
``layers`` peels off the sets that have the most common earlier group; within a
layer there is nothing to search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.blocks import give_back
from docweave.llm.components import connected_components
from docweave.llm.store import written
from docweave.ship import shipped

#: Cost of probing a list against that of merging an entry: the tuning constant of DivideSkip.
MU = 0.5
#: Keys of the sets in one block of a group.
BLOCK_KEYS = 500_000
#: Sets up to which a group is preferred the larger it is.
HANDY = 256


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least intersection with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class Lists:
    """Inverted lists of numbered sets: ascending numbers, list after list."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        keys, number, count = np.unique(flat, return_inverse=True, return_counts=True)
        number = number.reshape(-1)
        shared = count[number] > 1  # a key that one set alone has is in no intersection
        order = np.argsort(number[shared], kind="stable")
        self.n = max(len(sets), 1)
        self.members = owner[shared][order]
        self.ends = np.cumsum(np.where(count > 1, count, 0))
        self.starts = self.ends - np.where(count > 1, count, 0)
        self.codes = np.repeat(np.arange(len(count)), self.ends - self.starts) * self.n + self.members
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(owner[shared], minlength=len(sets)))])
        self.own = number[shared]

    def of(self, x: int) -> np.ndarray:
        """The lists that set ``x`` stands in."""
        return self.own[self.bounds[x] : self.bounds[x + 1]]

    def entries(self, lists: np.ndarray) -> np.ndarray:
        """All numbers of some lists, list after list."""
        size = self.ends[lists] - self.starts[lists]
        total = np.cumsum(size)
        if not len(total):
            return np.zeros(0, np.int64)
        return self.members[np.arange(total[-1]) + np.repeat(self.starts[lists] - (total - size), size)]

    def divide_skip(self, lists: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers that stand in at least ``least`` of the lists, and in how many."""
        none = np.zeros(0, np.int64)
        least = max(1, least)
        if len(lists) < least:
            return none, none
        size = self.ends[lists] - self.starts[lists]
        order = np.argsort(size, kind="stable")
        lists = lists[order]
        # The longest lists are probed; fewer than ``least`` of them, so the rest must have each answer.
        probed = min(least - 1, int(least / (MU * np.log2(max(2, size[order[-1]])) + 1)))
        short, long = lists[: len(lists) - probed], lists[len(lists) - probed :]
        merged = np.sort(self.entries(short), kind="stable")  # a merge of ascending runs
        if not len(merged):
            return none, none
        first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        count = np.diff(np.append(first, len(merged)))
        good = count >= least - probed
        found, count = merged[first[good]], count[good]
        if probed and len(found):
            wanted = (long[:, None] * self.n + found[None, :]).reshape(-1)
            at = np.searchsorted(self.codes, wanted)
            at[at == len(self.codes)] = 0
            count = count + (self.codes[at] == wanted).reshape(probed, -1).sum(axis=0)
            good = count >= least
            found, count = found[good], count[good]
        return found, count


def layers(earlier: list[np.ndarray]) -> np.ndarray:
    """A number for each set; sets of one number above 0 share an earlier group, number 0 has the others."""
    n = len(earlier)
    out = np.zeros(n, dtype=np.int64)
    sizes = np.array([len(e) for e in earlier], dtype=np.int64)
    if not sizes.any():
        return out
    number = np.unique(np.concatenate(earlier), return_inverse=True)[1].reshape(-1)
    owner = np.repeat(np.arange(n), sizes)
    layer = 0
    while len(number):
        count = np.bincount(number)
        most = int(count.argmax())
        if count[most] < 2:
            break
        layer += 1
        taken = np.zeros(n, dtype=bool)
        taken[owner[number == most]] = True
        out[taken] = layer
        left = ~taken[owner]
        owner, number = owner[left], number[left]
    return out


def group_links(sizes: np.ndarray, sets: list[np.ndarray], percent: int, earlier: list[np.ndarray] | None = None, side: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(set, the others it links with) for a group; each link that the group owns comes once.

    ``sizes`` counts all elements; ``sets`` may leave out elements that no other
    set has.  Pairs that share a number of ``earlier``, or are of one ``side``,
    are left out.
    """
    earlier = earlier if earlier is not None else [np.zeros(0, np.int64)] * len(sets)
    layer = layers(earlier)
    # A layer has nothing to search in itself; so the largest come first and search nothing.
    weight = np.bincount(layer)
    order = np.lexsort((-sizes, layer, -weight[layer] * (layer > 0), layer == 0))
    sizes, sets, earlier, layer = sizes[order], [sets[i] for i in order], [earlier[i] for i in order], layer[order]
    side = side[order] if side is not None else None
    keys, before = Lists(sets), Lists(earlier)
    begin = np.arange(len(sets))
    if len(sets):
        new = np.concatenate([[True], (layer[1:] != layer[:-1]) | (layer[1:] == 0)])
        begin = np.flatnonzero(new)[np.cumsum(new) - 1]
    for x in range(len(sets)):
        if begin[x] == 0:
            continue
        found, overlap = keys.divide_skip(keys.of(x), -(-percent * int(sizes[x]) // 100))
        good = (found < begin[x]) & (overlap >= needed(sizes[found], sizes[x], percent))
        if side is not None:
            good &= side[found] != side[x]
        found = found[good]
        if len(found):
            own = before.of(x)
            if len(own):
                other = np.zeros(len(sets), dtype=bool)
                other[before.entries(own)] = True
                found = found[~other[found]]
            if len(found):
                yield int(order[x]), order[found]


def linked(postings: DataFrame, percent: int) -> DataFrame:
    """Links of the sets in each group; postings: whole, group, id, copies, size, keys, earlier.

    Rows with a ``b`` are links (a, b) that span what links in the group; rows
    without are partial sums: ``n`` copies link with set ``a``.  A group of more
    than BLOCK_KEYS keys is dealt into blocks, and each pair of blocks is a task's
    unit of its own, so that no group outgrows a task.
    """
    shipped(postings.sparkSession)
    sizes = postings.groupBy("whole", "group").agg(F.ceil(F.sum(F.size("keys")) / BLOCK_KEYS).cast("int").alias("_blocks"))
    large = sizes.where("_blocks > 1")
    dealt = (
        postings.join(large, ["whole", "group"], "left")
        .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
        .withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select("whole", "group", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own", "id", "copies", "size", "keys", "earlier")
    )

    def unit(rows: pa.RecordBatch) -> pa.RecordBatch:
        ids, copies, sizes, own, i, j = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "copies", "size", "_own", "_i", "_j"))
        sets, earlier = _arrays(rows.column("keys")), _arrays(rows.column("earlier"))
        total = np.zeros(len(ids), dtype=np.int64)
        root = np.arange(len(ids))
        links: list[tuple[int, int]] = []
        for x, found in group_links(sizes, sets, percent, earlier, own if i[0] != j[0] else None):
            total[x] += copies[found].sum()
            total[found] += copies[x]
            for other in np.unique(root[found]).tolist():
                if other != root[x]:
                    links.append((x, int(found[root[found] == other][0])))
                    root[root == other] = root[x]
        some = np.flatnonzero(total)
        a, b = (np.array([link[k] for link in links], dtype=np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids[some], ids[a]])), pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(ids[b], pa.int64())]), pa.array(np.concatenate([total[some], np.zeros(len(a), np.int64)]))],
            names=["a", "b", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.concat_batches([rest, batch]) if rest is not None else batch
            marks = [now.column(c).to_numpy(zero_copy_only=False) for c in ("whole", "group", "_i", "_j")]
            first = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
            edges = [0, *first.tolist()]
            out = [unit(now.slice(a, b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1]
            if out:
                yield pa.concat_batches(out)
            rest = now.slice(edges[-1])
        if rest is not None and rest.num_rows > 1:
            yield unit(rest)

    placed = dealt.repartition("whole", "group", "_i", "_j").sortWithinPartitions("whole", "group", "_i", "_j", "id")
    return placed.mapInArrow(run, "a bigint, b bigint, n bigint")


def _arrays(column: pa.Array) -> list[np.ndarray]:
    """The values of a list column, one array a row."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def in_groups(sets: DataFrame, places: DataFrame) -> DataFrame:
    """Postings for ``linked``: the sets (id, copies, size, keys) in the groups that matter.

    ``places`` has (group, id).  Sets that groups connect are a group of their
    own where they fit into one block, which nearly all do; there each set is
    sent once.  The sets of larger connected parts are sent to their groups.
    """
    told = [F.count("*").alias("_n"), F.min("id").alias("_low"), F.max("id").alias("_high"), F.bit_xor(F.xxhash64("id")).alias("_xor")]
    placed = written(places.join(places.groupBy("group").agg(*told).where("_n > 1"), "group"), "overlap-places")
    meetings = placed.select(F.col("_low").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()
    parts = written(connected_components(meetings).select(F.col("node").alias("id"), F.col("root").alias("_part")), "overlap-parts")
    grouped = sets.join(parts, "id")
    weight = grouped.groupBy("_part").agg(F.sum(F.size("keys")).alias("_keys"))
    small = grouped.join(weight.where(F.col("_keys") <= BLOCK_KEYS).select("_part"), "_part")
    none = F.array().cast("array<bigint>")
    out = small.select(F.lit(True).alias("whole"), F.col("_part").alias("group"), "id", "copies", "size", "keys", none.alias("earlier"))
    large = parts.join(weight.where(F.col("_keys") > BLOCK_KEYS).select("_part"), "_part").select("id")
    if large.isEmpty():
        return out
    return out.unionByName(_by_group(sets, placed.join(large, "id")))


def _by_group(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """Postings by group.

    Of groups with the same sets one is enough: they are told by number,
    smallest, largest and hashes.  The groups of a set are ordered by preference:
    the largest of a handy size, smaller ones, then larger ones.  A group whose
    sets all prefer one and the same other group has no pair that isn't there
    too, and goes.
    """
    named = placed.groupBy("id", "_n", "_low", "_high", "_xor").agg(F.min("group").alias("group"))
    preferred = Window.partitionBy("id").orderBy(F.col("_n") > HANDY, F.when(F.col("_n") > HANDY, F.col("_n")).otherwise(-F.col("_n")), "group")
    ranked = named.withColumn("_at", F.row_number().over(preferred)).withColumn("_first", F.first("group").over(preferred))
    ranked = written(ranked.select("id", "group", "_at", "_first"), "overlap-groups")
    kept = ranked.groupBy("group").agg(F.min("_first").alias("_a"), F.max("_first").alias("_b")).where("_a <> _b or _a = group").select("group")
    own = ranked.join(kept, "group").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_at", "group")))["group"].alias("_groups"))
    joined = sets.join(own, "id").select("*", F.posexplode("_groups").alias("_at", "group"))
    return joined.select(F.lit(False).alias("whole"), "group", "id", "copies", "size", "keys", F.slice("_groups", F.lit(1), F.col("_at")).alias("earlier"))
