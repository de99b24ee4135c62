"""Hard negatives by bit-sliced integer products.

Vectors are integers.  Rows lie in blocks; a block holds its components as
bit-planes, one 64-bit word for 64 components of a row.  An anchor meets a block
plane by plane, the most significant (sign) plane first: a plane's part of all
products is a weighted sum of population counts of the row's word and the
anchor's words.  What the planes below can still add bounds each score from
both sides; a row goes as soon as its interval lies outside of all wanted bands,
or below as many rows as are wanted.  The last plane leaves exact scores.

The anchors are a stated query set against all rows: an anchor is sent to blocks,
never rows to rows.  Blocks hold rows of few labels, so the search for positives
sends an anchor to the blocks of its own label alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.carry import quoted
from docweave.llm.store import written
from docweave.ship import shipped

#: Rows of a block; a hot label has as many blocks as its rows need.
BLOCK_ROWS = 4096
#: Labels fall in so many groups, whose sizes the driver reads: so many numbers at most.
LABEL_GROUPS = 64
#: The components of a vector sum, without signs, to so much at most: all scores and their bounds then fit in 64 bits.
LARGEST_SUM = 1 << 30
#: Each component becomes floor(SCALE * x).
SCALE = 256

_FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of integers; a shorter vector ends in zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max(initial=0))
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def bit_planes(vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words (plane, 64 components, row) from the sign plane down, and the weight of each plane in two's complement."""
    n, have = vectors.shape
    words = max(1, -(-max(width, have) // 64))
    depth = max(int(vectors.max(initial=0)), -int(vectors.min(initial=0)) - 1).bit_length() + 1
    padded = np.zeros((n, words * 64), np.int64)
    padded[:, :have] = vectors
    planes = np.empty((depth, words, n), np.uint64)
    for i in range(depth):
        bits = ((padded >> (depth - 1 - i)) & 1).astype(np.uint8)
        planes[i] = np.packbits(bits, axis=1, bitorder="little").view("<u8").T
    weights = 1 << np.arange(depth - 1, -1, -1, dtype=np.int64)
    weights[0] = -weights[0]
    return planes, weights


class Block:
    """Rows of a block as bit-planes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.width = ids, labels, vectors.shape[1]
        self.planes, self.weights = bit_planes(vectors, self.width)

    def products(self, plane: int, alive: np.ndarray, anchor: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The products of one plane of the rows ``alive`` and an anchor's planes."""
        words = self.planes[plane][:, alive]
        total = np.zeros(len(alive), np.int64)
        for bits, weight in zip(anchor, weights.tolist(), strict=True):
            if bits.any():
                total += weight * np.bitwise_count(words & bits[:, None]).sum(axis=0, dtype=np.int64)
        return total

    def best(self, vector: np.ndarray, allowed: np.ndarray, bands: list[tuple[int, int]], wanted: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each band of scores, ends included, (ids, scores) of the first ``wanted`` allowed rows by score, then id."""
        anchor, weights = bit_planes(vector[None, :], self.width)
        anchor = anchor[:, : self.planes.shape[1], 0]  # components that no row has add nothing
        cut = vector[: self.planes.shape[1] * 64]
        least, most = int(cut[cut < 0].sum()), int(cut[cut > 0].sum())
        alive, known = allowed, np.zeros(len(allowed), np.int64)
        for plane, weight in enumerate(self.weights.tolist()):
            if not len(alive):
                break
            known = known + weight * self.products(plane, alive, anchor, weights)
            rest = abs(weight) - 1  # what the planes below can add to a component
            low, high = known + rest * least, known + rest * most
            keep = np.zeros(len(alive), bool)
            for first, last in bands:
                fits = (high >= first) & (low <= last)
                sure = low[(low >= first) & (high <= last)]
                if len(sure) > wanted:
                    fits &= high >= np.partition(sure, len(sure) - wanted)[len(sure) - wanted]
                keep |= fits
            alive, known = alive[keep], known[keep]
        out = []
        for first, last in bands:
            inside = (known >= first) & (known <= last)
            ids, scores = self.ids[alive[inside]], known[inside]
            order = np.lexsort((ids, -scores))[:wanted]
            out.append((ids[order], scores[order]))
        return out


def _bands(positives: list[dict] | None, percent: int) -> list[tuple[int | None, int | None, tuple[int, int]]]:
    """(positive, its score, wanted scores); all scores where there are no positives yet."""
    if positives is None:
        return [(None, None, (-(1 << 62), 1 << 62))]
    return [(p["id"], p["score"], (-(-percent * p["score"] // 100), p["score"])) for p in positives if p["score"] >= 0]


def _searched(same_label: bool, wanted: int, percent: int):
    """Rows and then anchors, block by block, to what the anchors find in their block."""

    def found(block: Block, anchors: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        vectors, labels, ids = matrix(anchors.column("q")), anchors.column("label").to_pylist(), anchors.column("id").to_pylist()
        for vector, label, own, positives in zip(vectors, labels, ids, anchors.column("positives").to_pylist(), strict=True):
            bands = _bands(positives, percent)
            allowed = np.flatnonzero((block.labels == label) & (block.ids != own) if same_label else block.labels != label)
            for (positive, score, _), (near, scores) in zip(bands, block.best(vector, allowed, [b[2] for b in bands], wanted), strict=True):
                n = len(near)
                for column, values in zip(out, ([own] * n, [positive] * n, [score] * n, near.tolist(), scores.tolist()), strict=True):
                    column.extend(values)
        names = ["anchor_id", "positive_id", "positive_score", "id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            at, kind = (batch.column(c).to_numpy() for c in ("block", "kind"))
            edges = [0, *(np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1).tolist(), len(at)]
            for start, end in zip(edges, edges[1:], strict=False):
                piece = batch.slice(start, end - start)
                if at[start] != current:
                    current, parts, block = at[start], [], None
                if kind[start] == 0:
                    parts.append(piece.select(["id", "label", "q"]))
                elif parts:
                    if block is None:
                        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                        block = Block(rows.column("id").to_numpy(), rows.column("label").to_numpy(), matrix(rows.column("q")))
                    yield found(block, piece)

    return run


def _met(rows: DataFrame, anchors: DataFrame, blocks: int, same_label: bool, wanted: int, percent: int) -> DataFrame:
    """What each anchor finds in the blocks that its column ``blocks`` names; a block's rows come to it once."""
    positives = "array<struct<id: bigint, score: bigint>>"
    sent = anchors.select(F.explode("blocks").alias("block"), F.lit(1).alias("kind"), "id", "label", "q", F.col("positives").cast(positives).alias("positives"))
    lying = rows.select("block", F.lit(0).alias("kind"), "id", "label", "q", F.lit(None).cast(positives).alias("positives"))
    # A partition for each block: rows that take long aren't merged into few tasks.
    dealt = lying.unionByName(sent).repartitionById(max(1, blocks), F.col("block")).sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(_searched(same_label, wanted, percent), _FOUND)


def quantized(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(id, label, q): integer components of the rows that take part, one row of each id."""
    x = F.transform(F.col(quoted(vector)), lambda v: F.floor(v.cast("double") * SCALE))
    taken = rows.where(
        F.col(quoted(vec_id)).isNotNull() & F.col(quoted(label)).isNotNull() & F.col(quoted(vector)).isNotNull()
        & F.forall(F.col(quoted(vector)), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    ).select(F.col(quoted(vec_id)).cast("long").alias("id"), F.col(quoted(label)).cast("long").alias("label"), x.alias("q"))
    whole = F.aggregate("q", F.lit(0.0), lambda total, v: total + F.abs(v.cast("double")))
    kept = taken.where(whole <= float(LARGEST_SUM)).withColumn("q", F.col("q").cast("array<int>"))
    return kept.groupBy("id").agg(F.min(F.struct("label", "q")).alias("row")).select("id", "row.*")


def hard_negatives(
    rows: DataFrame, anchors: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 5, percent: int = 80,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are integer inner products of floor(256 * x).  Of each row that the
    condition ``anchors`` (on the id as column ``id``) takes, the ``positives``
    best other rows of its label; of each of these the ``negatives`` best rows of
    other labels that score between ``percent`` of the positive's score and that
    score.  Ties go to the smaller id.  Where a score is negative no such row exists.

    Rows with a null id, label, vector or component, with a component that isn't
    finite, or whose integer components sum, without signs, above 2**30 take no
    part.  Rows that share an id are one: that of the smallest label, then vector.
    A vector that is shorter than another ends in zeros.  An empty table gives
    no rows; so does an anchor without positives.  Other columns may have any name.
    """
    shipped(rows.sparkSession)
    table = written(quantized(rows, vec_id, vector, label).withColumn("group", F.pmod(F.xxhash64("label"), F.lit(LABEL_GROUPS)).cast("int")), "vectors")
    counts = {r["group"]: r["n"] for r in table.groupBy("group").agg(F.count("*").alias("n")).collect()}  # LABEL_GROUPS rows at most
    sizes = [-(-counts.get(g, 0) // BLOCK_ROWS) for g in range(LABEL_GROUPS)]
    firsts, total = np.cumsum([0, *sizes])[:-1].tolist(), sum(sizes)

    def of_group(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("group") + 1)

    table = table.select("id", "label", "q", of_group(firsts).alias("first"), of_group(sizes).alias("many"))
    blocked = table.withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("many"))).cast("int"))
    queries = table.where(anchors)
    own = queries.withColumn("blocks", F.sequence("first", F.col("first") + F.col("many") - 1)).withColumn("positives", F.lit(None))
    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    first = _met(blocked, own, total, True, positives, percent).withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= positives)
    first = first.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("id", "score"))).alias("positives"))  # ``positives`` entries at most
    everywhere = queries.join(written(first, "positives"), F.col("id") == F.col("anchor_id")).withColumn("blocks", F.sequence(F.lit(0), F.lit(max(0, total - 1))))
    by_score = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    second = _met(blocked, everywhere, total, False, negatives, percent).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    return second.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
