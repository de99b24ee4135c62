"""Spelling variants of words by bands of letter-parity masks.

A word's mask tells of each letter whether it stands an odd number of times.  One
edit changes the count of one letter (insertion, deletion) or of two (replacement),
so it flips two bits at most, and of three bands of the mask one is equal.  Words
meet where a band and the length are equal; the length of the longer of two is
looked for as one less.  An edit also leaves one half of the word as it is, so the
parity mask of that half must be equal too: bands alone are few values (46 letters
give some thousand), and would pair each word with all that share one.  What
meets is verified by edit distance.

Hot words are counted by a partial aggregate; joins are of two shuffled sides,
so that a key with very many words can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.carry import quoted
from docweave.llm.store import discard, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS = 7
LEAST_COUNT = 2
#: A form stands so many times as often as its variant, at least.
RATIO = 10
BANDS = 3


def words_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, damage: int = 31) -> DataFrame:
    """Column word: a row for each run of letters with at least ``least_chars`` code points, A-Z lower-cased.

    Where ``damage`` divides the crc32 h of ``<doc_id>:<run>``, the run loses its code
    point h % length; 0 leaves all runs.  A null text has none; a null id is empty.
    """
    runs = F.regexp_extract_all(F.col(quoted(text)), F.lit(rf"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(quoted(doc_id)).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    lower = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    each = each.select("id", lower.alias("run"))
    if not damage:
        return each.select(F.col("run").alias("word"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    cut = each.select("run", h.alias("h")).select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("run")).alias("word"))
    return cut.where(F.length("word") >= least_chars)


def vocabulary(words: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that stand at least ``least_count`` times."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def parity(codes: Column, letters: int, band: int | None = None) -> Column:
    """The parities of the letters (numbered by code point, in ``letters`` bits), or of every third of them."""
    if band is None:
        return F.aggregate(codes, F.lit(0).cast("bigint"), lambda m, c: m.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), c % letters)))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda m, c: F.when(c % BANDS == band, m.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.floor(c / BANDS).cast("int") % letters))).otherwise(m))


def _keys(words: DataFrame, longer: bool) -> DataFrame:
    """(word, n, key): a key for each band and half of the word; ``longer`` as that of words one code point shorter."""
    size = F.size("codes") - int(longer)
    half = F.floor(size / 2).cast("int")
    rest = F.size("codes") - half - int(longer)  # of the end, where an insertion has moved it
    halves = [F.slice("codes", 1, half), F.slice("codes", F.size("codes") - rest + 1, rest)]
    keys = [F.xxhash64(F.lit(b), F.lit(s), size, f"band{b}", parity(part, 64)) for s, part in enumerate(halves) for b in range(BANDS)]
    return words.select("word", "n", F.explode(F.array(*keys)).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all pairs of words of (word, n) that differ by one inserted, deleted or replaced code point, both ways."""
    letters = F.transform(F.split("word", ""), lambda c: F.ascii(c))
    masked = words.select("word", "n", letters.alias("codes")).select("*", *[parity(F.col("codes"), 64, b).alias(f"band{b}") for b in range(BANDS)])
    same, other = _keys(masked, False), _keys(masked, True)
    left = same.select("key", "word", "n")
    right = same.unionAll(other).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    longer = F.length("near") > F.length("word")
    met = left.join(right, "key").where((longer | (F.col("word") < F.col("near"))) & (F.levenshtein("word", "near", 1) == 1))
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return met.select(both.alias("p")).select("p.*").repartition("word").distinct()


def with_roots(forms: DataFrame) -> DataFrame:
    """Column root for (word, form): the last of the forms that follow each other, by doubling the steps each round.

    A form stands ``ratio`` times as often as its variant, so no chain returns, and
    one of d steps takes log2(d) rounds.
    """
    root = written(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = root.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = written(root.join(ahead, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        discard(root)
        moved = after.where("moved").limit(1).count()
        root = after.select("word", "root")
        if not moved:
            return forms.join(root, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for a vocabulary of (word, n).

    form: the near word with the largest n (ties: the first in code-point order), if
    it stands at least ``ratio`` times as often; root: the last of the forms
    from there on, the word itself without one.  Rows of ``words`` must differ in
    word; null words take no part; an empty vocabulary gives no rows.  Words of any
    length are compared whole.
    """
    words = written(words.where(F.col("word").isNotNull()).select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    found = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left")
    takes = -F.col("best.less") >= ratio * F.col("n")
    forms = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.less")).alias("form_n"),
    )
    return with_roots(written(forms, "forms")).select("word", "form", "root", "n", "n_near", "form_n")
