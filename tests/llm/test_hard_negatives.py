"""Hard negatives against plain products of all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import hard_negatives as module
from docweave.llm.hard_negatives import Block, bit_planes, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, block string, score string, `a b` string"


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def plain(rows, every=100, positives=5, negatives=5, percent=80):
    """The contract, pair by pair; of rows with one id that of the smallest label and vector counts."""
    taken = {}
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(map(abs, q)) <= 1 << 30:
            taken[i] = min(taken.get(i, (label, q)), (label, q))
    product = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, q) in taken.items():
        if a % every:
            continue
        scored = sorted((-product(q, p), i) for i, (own, p) in taken.items() if i != a and own == label)
        others = sorted((-product(q, p), i) for i, (own, p) in taken.items() if own != label)
        for s, i in scored[:positives]:
            found = [(n, j) for n, j in others if percent * -s <= 100 * -n <= 100 * -s]
            out += [(a, i, rank + 1, j, -s, -n) for rank, (n, j) in enumerate(found[:negatives])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(seed, n, width, labels, scale=0.3, steps=None):
    random.seed(seed)
    draw = (lambda: random.choice(steps)) if steps else (lambda: random.gauss(0, scale))
    return [(i, [draw() for _ in range(width)], random.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("usual", vectors(1, 900, 64, 4)),
        ("wide", vectors(2, 300, 130, 3)),
        ("narrow, with ties", vectors(3, 700, 3, 3, steps=[-0.25, 0.0, 0.25, 0.5])),
        ("large and small", [(i, [x * 10 ** (i % 7) for x in v], c) for i, v, c in vectors(4, 300, 5, 2)]),
        ("one label", vectors(5, 250, 8, 1)),
        ("hot label", [(i, v, 0 if i % 3 else c) for i, v, c in vectors(6, 600, 16, 5)]),
    ],
)
def test_against_all_pairs(spark, monkeypatch, name, rows):
    monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    random.shuffle(rows)
    assert found(hard_negatives(table(spark, rows), F.col("id") % 100 == 0)) == plain(rows)


def test_rows_that_take_no_part_and_rows_that_repeat(spark):
    rows = vectors(7, 220, 6, 3)
    rows[100] = (100, None, 1)
    rows += [(None, [1.0] * 6, 1), (301, [1.0, None] * 3, 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (304, [1.0] * 6, None), (305, [], 1), (306, [0.5, 0.5], 2), (307, [1e30] * 6, 0)]
    rows += [rows[0], rows[0], (7, [9.0] * 6, 2), (7, [-9.0] * 6, 0), (-100, [0.3] * 6, 1), (-3, [0.2] * 7, 2)]
    assert found(hard_negatives(table(spark, rows), F.col("id") % 100 == 0)) == plain(rows)


def test_parameters(spark):
    rows = vectors(8, 300, 4, 3)
    out = hard_negatives(table(spark, rows), F.col("id") % 50 == 0, positives=2, negatives=3, percent=50)
    assert found(out) == plain(rows, 50, 2, 3, 50)


def test_empty_and_lonely(spark):
    assert hard_negatives(table(spark, []), F.col("id") % 100 == 0).collect() == []
    assert hard_negatives(table(spark, [(0, [1.0], 1)]), F.col("id") % 100 == 0).collect() == []
    assert hard_negatives(table(spark, [(0, [1.0], 1), (1, [1.0], 1)]), F.col("id") % 100 == 0).collect() == []


def test_planes_give_the_vectors_back():
    q = np.array([[0, 1, -1, 5], [-8, 7, 3, -(1 << 20)], [0, 0, 0, 0]])
    planes, weights = bit_planes(q, 4)
    bits = np.unpackbits(planes.transpose(0, 2, 1).copy().view(np.uint8).reshape(len(planes), 3, -1), axis=2, bitorder="little")
    assert (np.tensordot(weights, bits.astype(np.int64), 1)[:, :4] == q).all()


def test_rows_go_before_the_last_plane(monkeypatch):
    rng = np.random.default_rng(9)
    q = np.floor(rng.normal(0, 32, (4096, 64))).astype(np.int64)
    block = Block(np.arange(4096), np.zeros(4096, np.int64), q)
    left = []
    products = Block.products
    monkeypatch.setattr(Block, "products", lambda self, plane, alive, *more: left.append(len(alive)) or products(self, plane, alive, *more))
    anchor = q[0]
    (ids, scores), = block.best(anchor, np.arange(1, 4096), [(-(1 << 62), 1 << 62)], 5)
    exact = q[1:] @ anchor
    best = np.lexsort((np.arange(1, 4096), -exact))[:5]
    assert (ids == best + 1).all() and (scores == exact[best]).all()
    assert left[0] == 4095 and left[-1] < 50 and left == sorted(left, reverse=True)
