"""K-d tree sharding by distributed weighted medians, with DataFrame functions only.

Rows become points of their metadata; a row weighs its bytes.  Each level cuts
every node along its widest dimension at the weighted median, until leaves reach
the target bytes.  A median comes from a few aggregates over all nodes at once:
each narrows the place of the cut to one of 1024 intervals, first by the value,
then, where one value weighs too much, by the hash of the text, then by the hash
of doc_id and text; so equal texts stay together unless their weight alone tilts
the cut.  These keys are the rows' own, so the shards don't depend on how the
table is dealt.  Nodes and cuts are tables too: the driver holds none of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.store import discard, written

INTERVALS = 1024
#: Hashes as keys: 62 bits, so that differences and successors are longs too.
HASH_BITS = 62
_POINT = ["_id", "_size", "_crc", "_group", "_own", "_point", "_node"]


def _hash(*columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - HASH_BITS)


def _pick(value: Column, at: Column, many: int) -> Column:
    """Element ``at`` of an array that has ``many``."""
    return F.coalesce(*[F.when(at == k, F.get(value, F.lit(k))) for k in range(many)])


def _opened(boxes: DataFrame, nodes: DataFrame, extents: list[str], many: int) -> DataFrame:
    """A cut to find for each node that is to be divided: along its widest dimension, share of its weight to the left."""
    widths = F.array(*[F.struct(((F.col(f"b{k}") - F.col(f"a{k}")) / F.col(extents[k])).alias("w"), F.lit(-k).alias("k")) for k in range(many)])
    joined = boxes.join(nodes.where("_many > 1"), "_node").withColumn("_dim", -F.array_max(widths)["k"])
    return joined.select(
        "_node", "_dim", "_total", (F.col("_total") * F.floor(F.col("_many") / 2) / F.col("_many")).alias("_goal"), F.lit(0).alias("_level"),
        _pick(F.array(*[f"a{k}" for k in range(many)]), F.col("_dim"), many).alias("_low"), _pick(F.array(*[f"b{k}" for k in range(many)]), F.col("_dim"), many).alias("_high"),
        *[F.lit(0).cast("long").alias(c) for c in ("_left", "_p0", "_p1")],
        *[F.lit(None).cast("long").alias(c) for c in ("_c0", "_c1", "_c2")],
    )


def _narrowed(points: DataFrame, cuts: DataFrame, tolerance: float, many: int) -> DataFrame:
    """One round: each open cut to one of its intervals, to its next key, or to its place (_c0, _c1, _c2)."""
    now = cuts.where("_c0 is null")
    value = _pick(F.col("_point"), F.col("_dim"), many)
    joined = points.join(now, "_node").withColumn("_v", value)
    joined = joined.withColumn("_k", F.when(F.col("_level") == 0, F.col("_v")).when(F.col("_level") == 1, F.col("_group")).otherwise(F.col("_own")))
    inside = joined.where("(_level = 0 or _v = _p0) and (_level < 2 or _group = _p1) and _k between _low and _high")
    slots = inside.groupBy("_node", F.expr(f"(_k - _low) div ((_high - _low) div {INTERVALS} + 1)").alias("_slot")).agg(F.sum("_size").alias("_weight"), F.min("_k").alias("_first"), F.max("_k").alias("_last"))
    # The slot that the goal falls into; at most INTERVALS rows a node.
    before = Window.partitionBy("_node").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = slots.withColumn("_before", F.coalesce(F.sum("_weight").over(before), F.lit(0))).join(now.select("_node", "_goal", "_left"), "_node")
    row = F.struct("_weight", "_first", "_last", "_before")
    reached = F.col("_left") + F.col("_before") + F.col("_weight") >= F.col("_goal")
    chosen = placed.groupBy("_node").agg(F.coalesce(F.min_by(row, F.when(reached, F.col("_slot"))), F.max_by(row, "_slot")).alias("_hit"))
    found = cuts.join(chosen, "_node", "left").withColumns({"_w": F.col("_hit._weight"), "_f": F.col("_hit._first"), "_l": F.col("_hit._last"), "_passed": F.col("_left") + F.col("_hit._before")})
    off_before, off_after = F.abs(F.col("_goal") - F.col("_passed")), F.abs(F.col("_passed") + F.col("_w") - F.col("_goal"))
    level, here = F.col("_level"), F.col("_hit").isNotNull()
    done = here & ((F.least(off_before, off_after) <= F.lit(tolerance) * F.col("_total")) | ((level == 2) & (F.col("_f") == F.col("_l"))))
    at = F.when(off_before <= off_after, F.col("_f")).otherwise(F.col("_l") + 1)
    deeper = here & ~done & (F.col("_f") == F.col("_l"))
    closer = here & ~done & (F.col("_f") < F.col("_l"))
    zero = F.lit(0).cast("long")
    return found.select(
        "_node", "_dim", "_total", "_goal", F.when(deeper, level + 1).otherwise(level).alias("_level"),
        F.when(closer, F.col("_f")).when(deeper, zero).otherwise(F.col("_low")).alias("_low"),
        F.when(closer, F.col("_l")).when(deeper, F.lit((1 << HASH_BITS) - 1)).otherwise(F.col("_high")).alias("_high"),
        F.when(closer | deeper, F.col("_passed")).otherwise(F.col("_left")).alias("_left"),
        F.when(deeper & (level == 0), F.col("_f")).otherwise(F.col("_p0")).alias("_p0"),
        F.when(deeper & (level == 1), F.col("_f")).otherwise(F.col("_p1")).alias("_p1"),
        F.when(done, F.when(level == 0, at).otherwise(F.col("_p0"))).otherwise(F.col("_c0")).alias("_c0"),
        F.when(done, F.when(level == 0, zero).when(level == 1, at).otherwise(F.col("_p1"))).otherwise(F.col("_c1")).alias("_c1"),
        F.when(done, F.when(level == 2, at).otherwise(zero)).otherwise(F.col("_c2")).alias("_c2"),
    )


def kd_shards(docs: DataFrame, target_bytes: int | None = None, leaves: int | None = None, dimensions: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"), doc_id: str = "doc_id", text: str = "text", tolerance: float = 0.0005) -> DataFrame:
    """doc_id, size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) of every row.

    Leaves are as many as the total needs at ``target_bytes``, or ``leaves``; any
    number.  Each cut is within ``tolerance`` of its node's weight from the
    weighted median (0: the nearest place between rows), unless rows that agree in
    doc_id and text weigh more.  Sizes are UTF-8 bytes plus 1; a null text counts
    1.  Strings in dimensions are placed by their CRC, nulls at 0; copies of a text
    stand where the one with the smallest doc_id stands (null last), so they share
    a shard unless a cut must pass through them.  Rows may repeat; each has a slot
    of its own.  Shards and slots follow from the rows alone, not from their order
    or partitions; rows that agree in doc_id and text may swap slots.  Long texts
    count whole; an empty table gives no rows.  Other columns, whatever their names,
    are not used.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(text), F.lit(""))
    types, many = dict(docs.dtypes), len(dimensions)

    def place(c: str) -> Column:
        value = F.crc32(F.col(c).cast("string")) if types[c] == "string" else F.col(c).cast("bigint")
        return F.coalesce(value, F.lit(0))

    narrow = docs.select(
        F.col(doc_id).alias("_id"), (F.octet_length(whole) + 1).cast("long").alias("_size"), F.crc32(whole).alias("_crc"),
        _hash(whole).alias("_group"), _hash(F.col(doc_id), whole).alias("_own"), F.array(*[place(c) for c in dimensions]).alias("_place"),
    )
    narrow = written(narrow, "kd-rows")
    first = narrow.groupBy("_group").agg(F.min_by("_place", F.struct(F.col("_id").isNull(), "_id", "_place")).alias("_point"))
    points = written(narrow.join(first, "_group").withColumn("_node", F.lit(1).cast("long")).select(*_POINT), "kd-points")
    dims = range(many)
    bounds = [x for k in dims for x in (F.min(F.get("_point", F.lit(k))).alias(f"a{k}"), F.max(F.get("_point", F.lit(k))).alias(f"b{k}"))]
    space = points.agg(F.sum("_size").alias("total"), F.count("*").alias("n"), *bounds).first()
    total, n = space["total"] or 0, space["n"]
    wanted = (leaves or max(1, -(-total // target_bytes))) if total else 1
    extents = [f"{max(1, (space[f'b{k}'] or 0) - (space[f'a{k}'] or 0))}" for k in dims]
    nodes = spark.range(1).select(F.lit(1).cast("long").alias("_node"), F.lit(0).cast("long").alias("_leaf"), F.lit(wanted).cast("long").alias("_many"))
    for _ in range((wanted - 1).bit_length()):
        boxes = points.groupBy("_node").agg(F.sum("_size").alias("_total"), *bounds).withColumns({f"e{k}": F.lit(float(extents[k])) for k in dims})
        cuts = written(_opened(boxes, nodes, [f"e{k}" for k in dims], many), "kd-cuts")
        while not cuts.where("_c0 is null").isEmpty():
            after = written(_narrowed(points, cuts, tolerance, many), "kd-cuts")
            discard(cuts)
            cuts = after
        keys = [_pick(F.col("_point"), F.col("_dim"), many), F.col("_group"), F.col("_own")]
        x, y, z = (F.col(c) for c in ("_c0", "_c1", "_c2"))
        left = (keys[0] < x) | ((keys[0] == x) & ((keys[1] < y) | ((keys[1] == y) & (keys[2] < z))))
        goes = F.when(F.col("_dim").isNull(), F.col("_node")).when(left, F.col("_node") * 2).otherwise(F.col("_node") * 2 + 1)
        moved = written(points.join(cuts.select("_node", "_dim", "_c0", "_c1", "_c2"), "_node", "left").withColumn("_node", goes).select(*_POINT), "kd-points")
        discard(points)
        points = moved
        half = F.floor(F.col("_many") / 2)
        divided, single = nodes.where("_many > 1"), nodes.where("_many = 1")
        nodes = written(
            single.unionAll(divided.select(F.col("_node") * 2, "_leaf", half)).unionAll(divided.select(F.col("_node") * 2 + 1, F.col("_leaf") + half, F.col("_many") - half)),
            "kd-nodes",
        )
    return _with_slots(points.join(nodes, "_node").withColumn("_shard", F.col("_leaf").cast("int")), n).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def _with_slots(rows: DataFrame, n: int, chunk: int = 50_000) -> DataFrame:
    """Gapless numbers from 0 in each shard: numbers within chunks plus the chunks' offsets."""
    chunks = max(1, -(-n // chunk))
    dealt = rows.withColumn("_chunk", F.pmod(F.col("_own"), F.lit(chunks)))
    within = Window.partitionBy("_shard", "_chunk").orderBy("_own", "_id")
    over = Window.partitionBy("_shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_shard", "_chunk").agg(F.count("*").alias("_n")).withColumn("_offset", F.coalesce(F.sum("_n").over(over), F.lit(0))).drop("_n")
    numbered = dealt.withColumn("_at", F.row_number().over(within))
    return numbered.join(offsets, ["_shard", "_chunk"]).withColumn("slot", (F.col("_offset") + F.col("_at") - 1).cast("long"))
