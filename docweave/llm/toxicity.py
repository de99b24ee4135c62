"""Toxicity by class-conditional Kneser-Ney models of characters within words.

Two models, toxic and ordinary, give each character of a word a probability
after the five before it, from counts by class on a bounded sample of labelled
documents, with modified Kneser-Ney discounts estimated from these counts.  What they discount goes to one shared model of the next lower order,
whose counts come from all documents: in each order from four characters down to
none a character counts as often as there are different characters before its
context (where a context begins its word: as often as it stands), and what is
discounted goes one order down.  So an expression that is rare in either class
has no more than its discounted share.  A text's score compares the two
log-likelihoods, divided by the number of words: once of all words, once of what
each word has beyond FAR, so that a few plain insults tell in a text of any
length.  A logistic function of these two, fitted on labelled documents that the
models haven't counted, makes it a probability.

An event (a character after its context) is one number: the five bytes before
it, how many of them there are, and the byte itself or the word's end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (makes pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.blocks import IS_ALNUM, LOWER, blocks, column_bytes, prefix_sums, span_hash, word_spans
from docweave.llm.carry import CARRIED, carried, extended
from docweave.llm.store import written
from docweave.ship import shipped

#: Labelled documents that are counted or calibrated on, at most, by label.
SAMPLE = {1: 6000, 0: 9000}
#: Characters of context of the class models.
CONTEXT = 5
#: Discount of the shared orders, and of a class whose counts are too few to tell.
SHARED_DISCOUNT = 0.75
#: Events that a task holds before it adds them up.
HELD = 2_000_000
END = 256
#: Where the number of context bytes and the symbol stand in an event.
LENGTH_AT, SYMBOL_AT = 8 * CONTEXT, 8 * CONTEXT + 3


class Words:
    """The distinct words of a block and the events of their characters."""

    def __init__(self, part: pa.RecordBatch, text: str):
        raw, offsets = column_bytes(part.column(text))
        data = LOWER[raw]
        starts, ends, rows = word_spans(data, offsets, IS_ALNUM)
        self.rows, self.n_rows = rows, len(offsets) - 1
        names, first, self.number = np.unique(span_hash(prefix_sums(data), starts, ends), return_index=True, return_inverse=True)
        self.number = self.number.reshape(-1)
        self.times = np.bincount(self.number, minlength=len(names))
        starts, ends = starts[first], ends[first]
        lengths = ends - starts + 1
        self.word = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(len(self.word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = starts[self.word] + place
        symbol = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.int64) if len(data) else at
        symbol[at == ends[self.word]] = END
        self.context = np.minimum(place, CONTEXT) << LENGTH_AT
        for k in range(1, CONTEXT + 1):
            self.context |= np.where(place >= k, data[np.maximum(at - k, 0)] if len(data) else 0, 0).astype(np.int64) << (8 * (k - 1))
        self.gram = self.context | symbol << SYMBOL_AT


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, sample: dict[int, int]) -> DataFrame:
    """doc_id, text, label, fold (1 to 4) of the sample: rows with crc32(doc_id) mod 5 other than 0."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    known = known.withColumn("fold", F.crc32(F.col("doc_id").cast("string")) % 5).where("fold <> 0")
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in sample.items()]
    chosen = parts[0].unionAll(parts[1]).select(F.col("doc_id").alias("_id"), "label", "fold")
    # The sample's size is bounded by its parameter; of rows that share a doc_id one is in it.
    named = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text"))
    found = named.join(F.broadcast(chosen), "_id")
    return found.groupBy("_id", "label", "fold").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def _summed(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams, number = np.unique(gram, return_inverse=True)
    return grams, np.bincount(number.reshape(-1), weights=n, minlength=len(grams)).astype(np.int64)


def class_counts(sample: DataFrame) -> DataFrame:
    """gram, n0, n1 of the events of the sample, partial sums first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label in (0, 1):
                own = batch.filter(pa.compute.equal(batch.column("label"), label))
                for part in blocks(own, "text"):
                    words = Words(part, "text")
                    grams, counts = _summed(words.gram, words.times[words.word])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(grams), label, np.int32)), pa.array(grams), pa.array(counts)], names=["label", "gram", "n"])

    made = sample.select("text", "label").mapInArrow(run, "label int, gram bigint, n bigint")
    sums = [F.coalesce(F.sum(F.when(F.col("label") == c, F.col("n"))), F.lit(0)).alias(f"n{c}") for c in (0, 1)]
    return made.groupBy("gram").agg(*sums)


def corpus_counts(docs: DataFrame, text: str) -> DataFrame:
    """gram, n of every event in all documents, partial sums first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*[np.concatenate(c) for c in zip(*held, strict=True)])

        for batch in batches:
            for part in blocks(batch, text):
                words = Words(part, text)
                held.append((words.gram, words.times[words.word]))
                rows += len(words.gram)
                if rows >= HELD:
                    held = [merged()]
                    rows = len(held[0][0])
                    if rows >= HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=["gram", "n"])
                        held, rows = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged()], names=["gram", "n"])

    made = docs.select(text).mapInArrow(run, "gram bigint, n bigint")
    return made.groupBy("gram").agg(F.sum("n").alias("n"))


def _shortened(gram: Column, k: int) -> Column:
    """An event with the last ``k`` bytes of its context alone."""
    bits = F.call_function("shiftright", gram, F.lit(LENGTH_AT))
    length, symbol = bits.bitwiseAND(F.lit(7)), F.call_function("shiftright", gram, F.lit(SYMBOL_AT))
    kept = gram.bitwiseAND(F.lit((1 << 8 * k) - 1))
    return kept + F.least(length, F.lit(k)) * F.lit(1 << LENGTH_AT) + symbol * F.lit(1 << SYMBOL_AT)


def _context(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit((1 << SYMBOL_AT) - 1))


def continuations(above: DataFrame, k: int) -> DataFrame:
    """gram, n, a of the order with ``k`` characters of context, from that with one more (gram, n).

    a: the number of different characters before the event; where the context
    begins its word, nothing can stand before it and the event's own number counts.
    """
    begins = F.call_function("shiftright", F.col("gram"), F.lit(LENGTH_AT)).bitwiseAND(F.lit(7)) < k
    each = above.select(_shortened(F.col("gram"), k).alias("gram"), "n", F.when(begins, F.col("n")).otherwise(F.lit(1)).alias("a"))
    return each.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("a").alias("a"))


def shared_model(events: DataFrame, counts: DataFrame) -> DataFrame:
    """gram and backoff of events: the shared model's probability of their symbol after the last CONTEXT - 1 characters.

    Continuations, totals and kinds are formed from all of ``counts``.  Only the
    grams of class events are needed: at any other event the shared probability is
    a factor of both classes and cancels.
    """
    found, level, orders = events.select("gram"), counts, []
    for k in range(CONTEXT - 1, -1, -1):
        level = written(continuations(level, k), f"toxicity-order-{k}")
        contexts = level.groupBy(_context(F.col("gram")).alias("context")).agg(F.sum("a").alias(f"total{k}"), F.count("*").alias(f"kinds{k}"))
        own = found.withColumn("at", _shortened(F.col("gram"), k)).withColumn("context", _context(F.col("at")))
        found = own.join(level.select(F.col("gram").alias("at"), F.col("a").alias(f"a{k}")), "at").join(contexts, "context").drop("at", "context")
        orders.append(k)
    chance = F.col("a0") / F.col("total0")
    for k in reversed(orders[:-1]):
        chance = (F.col(f"a{k}") - SHARED_DISCOUNT) / F.col(f"total{k}") + SHARED_DISCOUNT * F.col(f"kinds{k}") / F.col(f"total{k}") * chance
    return found.select("gram", chance.alias("backoff"))


def discounts(n: np.ndarray) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and of 3 and more: modified Kneser-Ney estimates from the numbers of such counts."""
    seen = [int((n == i).sum()) for i in (1, 2, 3, 4)]
    if not all(seen):
        return np.array([0.0, *[SHARED_DISCOUNT] * 3])
    ones, twos, threes, fours = seen
    share = ones / (ones + 2 * twos)
    found = (1 - 2 * share * twos / ones, 2 - 3 * share * threes / twos, 3 - 4 * share * fours / threes)
    return np.array([0.0, *[min(max(d, 0.05), i - 0.05) for i, d in enumerate(found, 1)]])


class Model:
    """Log-likelihood ratios of events: of known ones, and of others after a known context."""

    def __init__(self, table: dict[str, np.ndarray]):
        gram, backoff = table["gram"], table["backoff"]
        tops, top = np.unique(gram & ((1 << SYMBOL_AT) - 1), return_inverse=True)
        logs, weights = [], []
        for c in (1, 0):
            n = table[f"n{c}"].astype(float)
            off = discounts(n)[np.minimum(n, 3).astype(np.int64)]
            total = np.bincount(top, weights=n, minlength=len(tops))
            weight = np.where(total > 0, np.bincount(top, weights=off, minlength=len(tops)) / np.maximum(total, 1), 1.0)
            seen = (n - off) / np.maximum(total[top], 1)
            logs.append(np.log(seen + weight[top] * backoff))
            weights.append(np.log(weight))
        order = np.argsort(gram)
        self.grams, self.ratio = gram[order], (logs[0] - logs[1])[order].astype(np.float32)
        self.contexts, self.other = tops, (weights[0] - weights[1]).astype(np.float32)
        self.curve = np.zeros(3)

    def features(self, words: Words) -> np.ndarray:
        """Of each row: log-likelihood ratio a word, and the root of its part beyond FAR."""

        def look(known: np.ndarray, value: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(known):
                return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
            place = np.searchsorted(known, wanted)
            place[place == len(known)] = 0
            hit = known[place] == wanted
            return np.where(hit, value[place], 0.0), hit

        ratio, hit = look(self.grams, self.ratio, words.gram)
        ratio[~hit] = look(self.contexts, self.other, words.context[~hit])[0]
        each = np.bincount(words.word, weights=ratio, minlength=len(words.times))[words.number] if len(words.number) else np.zeros(0)
        n = np.maximum(np.bincount(words.rows, minlength=words.n_rows), 1)
        mean = np.bincount(words.rows, weights=each, minlength=words.n_rows) / n
        far = np.bincount(words.rows, weights=np.maximum(each - FAR, 0), minlength=words.n_rows)
        return np.stack([mean, np.sqrt(far / n)], axis=1)

    def score(self, words: Words) -> np.ndarray:
        line = self.features(words) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(line, -40, 40)))


#: Log-likelihood ratio from which a word counts as far on the toxic side.
FAR = 3.0


def fit_curve(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps on scaled features."""
    if not len(y) or y.min() == y.max():
        return np.array([1.0, 0.0, float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0])
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    z = np.column_stack([(x - centre) / scale, np.ones(len(y))])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.diag([1.0] * x.shape[1] + [0.0]) * len(y) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge + 1e-9 * np.eye(len(w)), z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    slope = w[:-1] / scale
    return np.append(slope, w[-1] - slope @ centre)


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {c: table.column(c).to_numpy() for c in table.column_names}


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: dict[int, int] | None = None) -> Model:
    """The calibrated model; what the driver gets is bounded by the sample."""
    shipped(docs.sparkSession)
    chosen = labelled_sample(docs, labels, doc_id, text, sample or SAMPLE)
    events = written(class_counts(chosen.where("fold <> 4")), "toxicity-events")
    shared = shared_model(events, written(corpus_counts(docs, text), "toxicity-counts"))
    model = Model(_columns(events.join(shared, "gram")))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "text"):
                x = held.value.features(Words(part, "text"))
                yield pa.RecordBatch.from_arrays([part.column("label"), *[pa.array(c) for c in x.T]], names=["label", "a", "b"])

    rows = chosen.where("fold = 4").select("text", "label").mapInArrow(run, "label int, a double, b double").toArrow()
    x = np.column_stack([rows.column(c).to_numpy() for c in "ab"]) if rows.num_rows else np.zeros((0, 2))
    model.curve = fit_curve(x, rows.column("label").to_numpy().astype(float) if rows.num_rows else np.zeros(0))
    return model


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, model: Model | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default) plus score (0 to 1).

    ``labels`` has doc_id and toxic (0 or 1; others are left out; of rows that
    share a doc_id the highest counts).  Null and empty texts get the score of
    a text without words.  Without any labels each score is 0.5.  Rows that
    repeat get the same score each, and of rows of ``docs`` that share a doc_id
    one is learned from.  Whole texts are scored, of any length; an empty table
    gives no rows.  A column named score is replaced; others may have any name.
    """
    fitted = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels, doc_id, text))
    source = docs.select(carried(docs, keep, ["score"]), F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "_text"):
                score = fitted.value.score(Words(part, "_text"))
                yield pa.RecordBatch.from_arrays([part.column(CARRIED), pa.array(score)], names=[CARRIED, "_score"])

    return source.mapInArrow(run, extended(source, [CARRIED], "_score double")).select(f"{CARRIED}.*", F.col("_score").alias("score"))
