"""Each operator on nulls, empty and long texts, repeated rows, empty tables and clashing extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from docweave.llm.bpe import tokenized
from docweave.llm.decontaminate import decontaminate
from docweave.llm.jaccard_join import jaccard_join
from docweave.llm.kd_shard import kd_shards
from docweave.llm.line_dedup import line_dedup
from docweave.llm.paragraph_dedup import paragraph_dedup
from docweave.llm.quality_rules import quality_rules
from docweave.llm.queries import tokenizer_path
from docweave.llm.secret_scan import redacted, scan_secrets
from docweave.llm.suffix_dedup import suffix_dedup
from docweave.llm.toxicity import toxicity

#: Extra columns with the names that the operators use inside, and some that they make.
EXTRA = ["_text", "_id", "_row", "_parts", "_drop", "_runs", "_rid", "_host", "_stats", "_lines", "_key", "_own", "_point", "_node", "_root", "_least", "_class", "_set", "_order", "_words", "_docs", "signature", "block", "at", "text_", "a b", "x.y", "size", "group", "item"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept string, " + ", ".join(f"`{c}` string" for c in EXTRA)
LONG = " ".join(f"word{i} and more" for i in range(8000))
SENTENCE = "The same sentence of more than ten words stands in both of these documents. "


def table(spark, texts):
    rows = [(i, t, None if i == 2 else "en", None if i == 3 else "s", None, 7, "x", *[f"{c} {i}" for c in EXTRA]) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, [(0, SENTENCE * 3), (1, None), (2, ""), (3, LONG), (4, LONG), (5, SENTENCE * 3), (5, SENTENCE * 3), (None, SENTENCE * 3), (7, "short"), (8, "é" * 300)]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(9)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, SENTENCE), (2, None), (3, ""), (None, SENTENCE), (4, "short"), (1, "other words")], "item_id long, text string")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


OPERATORS = {
    "lines": lambda d, x, b: line_dedup(d),
    "suffix": lambda d, x, b: suffix_dedup(d),
    "secrets": lambda d, x, b: scan_secrets(d),
    "shards": lambda d, x, b: kd_shards(d, leaves=4),
    "benchmark": lambda d, x, b: decontaminate(d, b),
    "quality": lambda d, x, b: quality_rules(d),
    "jaccard": lambda d, x, b: jaccard_join(d),
    "bpe": lambda d, x, b: tokenized(d, tokenizer_path()),
    "toxicity": lambda d, x, b: toxicity(d, x),
    "paragraphs": lambda d, x, b: paragraph_dedup(d),
}


@pytest.mark.parametrize("name", ["shards", "jaccard"])
def test_every_row_has_one_result(docs, labels, bench, name):
    """By default; the others are asked for all columns below."""
    out = OPERATORS[name](docs, labels, bench)
    assert len(set(out.columns)) == len(out.columns)
    assert out.count() == docs.count()


#: Those that pass columns on: all of the table's, asked for where an operator keeps the id alone by default.
PASSING = OPERATORS | {
    "suffix": lambda d, x, b: suffix_dedup(d, keep=d.columns),
    "jaccard": lambda d, x, b: jaccard_join(d, keep=d.columns),
    "paragraphs": lambda d, x, b: paragraph_dedup(d, keep=d.columns),
}


@pytest.mark.parametrize("name", [n for n in PASSING if n != "shards"])
def test_columns_of_any_name_pass_unchanged(docs, labels, bench, name):
    out = PASSING[name](docs, labels, bench)
    assert len(set(out.columns)) == len(out.columns)
    columns = [f"`{c}`" for c in ["doc_id", *EXTRA, "lang", "source"]]
    assert by_id(out.select(*columns)) == by_id(docs.select(*columns))


#: What each operator makes, in other letters; Spark tells no names apart by case.
MADE = {
    "lines": ["N_LINES", "N_Dropped"], "suffix": ["N_Bytes", "KEPT", "Spans"], "secrets": ["SECRETS"], "benchmark": ["N_Words", "NEAR", "Bench_Hits"], "quality": ["Kept_", "KEPT", "Base_Failed"],
    "jaccard": ["N_Links", "Component_ID"], "bpe": ["IDS", "Decoded"], "toxicity": ["Score"], "paragraphs": ["Passages", "N_REMOVED"],
}


@pytest.mark.parametrize("name", MADE)
def test_names_that_differ_by_case_alone(docs, labels, bench, name):
    few = docs.select("doc_id", "text", "source").where("doc_id in (0, 1, 5)").select("*", *[F.lit("x").alias(c) for c in MADE[name]])
    out = PASSING[name](few, labels, bench)
    names = [c.lower() for c in out.columns]
    assert len(set(names)) == len(names)
    kept = [c for c in MADE[name] if c in out.columns]
    assert kept == [c for c in MADE[name] if c == "Kept_"]
    assert out.count() == few.count() and len(out.select(*[c.lower() for c in MADE[name]]).columns) == len(MADE[name])


@pytest.mark.parametrize("name", ["lines", "suffix", "shards", "benchmark", "quality", "jaccard", "paragraphs", "toxicity"])
def test_ids_that_are_strings(docs, labels, bench, name):
    # Ids that sort as the numbers do: the findings are the same.
    text = F.concat(F.lit("n"), F.lpad(F.col("doc_id").cast("string"), 5, "0"))
    plain, other = OPERATORS[name](docs, labels, bench), OPERATORS[name](docs.withColumn("doc_id", text), labels.withColumn("doc_id", text), bench.withColumn("item_id", F.concat(F.lit("i"), F.col("item_id").cast("string"))))
    made = {"lines": ["text", "n_dropped"], "suffix": ["n_removed", "kept_sha256"], "shards": ["size"], "benchmark": ["bench_hits", "n_near"], "quality": ["kept", "n_words"], "jaccard": ["n_links"], "paragraphs": ["n_removed", "passages"], "toxicity": ["n_words"]}
    assert by_id(other.select("doc_id", *made[name])) == by_id(plain.withColumn("doc_id", text).select("doc_id", *made[name]))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, bench, name):
    out = OPERATORS[name](docs.limit(0), labels.limit(0), bench.limit(0))
    assert out.collect() == []


def test_lines_of_repeated_rows(spark):
    line = "a line that is long enough"
    docs = table(spark, [(1, f"{line}\nown"), (2, f" {line.upper()}\t\n\nx"), (2, f" {line.upper()}\t\n\nx"), (None, line), (3, None)])
    rows = by_id(line_dedup(docs).select("doc_id", "text", "n_lines", "n_dropped"))
    assert rows == sorted([(1, f"{line}\nown", 2, 0), (2, "\nx", 3, 1), (2, "\nx", 3, 1), (None, line, 1, 0), (3, "", 1, 0)], key=repr)


def test_suffixes_of_repeated_rows(docs):
    rows = {(r.doc_id, r.n_bytes): r for r in suffix_dedup(docs).collect()}
    size = len(SENTENCE) * 3
    first = rows[0, size]
    # The sentence stands three times: of its period of length p, what starts at p or later also starts p earlier, and a match of
    # 100 bytes fits where it starts at 2 * len - 100 + p at most; so all from the second copy on goes.
    assert first.n_removed == size - len(SENTENCE) and first.n_spans == 1
    assert rows[5, size].n_removed == size and rows[None, size].n_removed == size
    assert rows[4, len(LONG)].n_removed == len(LONG) and rows[1, 0].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_shards_are_even_and_gapless(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97 * F.when(F.col("id") % 3 == 0, 0).otherwise(7)).cast("int")).alias("text"), F.lit("hot").alias("source"), F.lit("en").alias("lang"), (F.col("id") % 97).alias("n_chars"))
    rows = kd_shards(docs, leaves=8).collect()
    sizes, slots, groups = {}, {}, {}
    for r in rows:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
        groups.setdefault(r.text_crc32, set()).add(r.shard)
    assert sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values()) / 8 + 700
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in groups.values()) <= 7  # a cut divides one group at most
    by_bytes = kd_shards(docs, target_bytes=-(-sum(sizes.values()) // 3)).select("shard").distinct().count()
    assert by_bytes == 3


def keys(docs):
    """The keys of each row that the tree may cut by, in the module's own terms."""
    from docweave.llm.kd_shard import _hash

    whole = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", "lang", "n_chars", F.crc32(F.coalesce("source", F.lit(""))).alias("s"), F.crc32("lang").alias("l"), _hash(whole).alias("g"), _hash(F.col("doc_id"), whole).alias("o"), (F.octet_length(whole) + 1).alias("size")).collect()
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(r.g, (r.s if r.source is not None else 0, r.l or 0, r.n_chars or 0, r.doc_id))
    return {r.doc_id: (first[r.g], r.g, r.o, r.size) for r in rows}


@pytest.mark.parametrize("leaves", [8, 5])
def test_every_cut_is_a_median_of_the_widest_dimension(spark, leaves):
    """The tree again, from the shards found: each node's two sides are apart in its widest dimension, and weigh what they should."""
    docs = spark.range(1200).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 7 != 0, F.repeat(F.concat(F.lit("t"), (F.col("id") % 150).cast("string")), (F.col("id") % 150 % 31).cast("int"))).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 11).cast("string"))).alias("source"), F.when(F.col("id") % 5 > 0, "en").alias("lang"), (F.col("id") * 7919 % 1000).alias("n_chars"),
    ).cache()
    shard = {r.doc_id: r.shard for r in kd_shards(docs, leaves=leaves).collect()}
    again = {r.doc_id: r.shard for r in kd_shards(docs.repartition(7, "text"), leaves=leaves).collect()}
    assert again == shard
    own = keys(docs)
    extent = [max(1, max(k[0][d] for k in own.values()) - min(k[0][d] for k in own.values())) for d in range(4)]

    def check(ids, low, many):
        if many == 1:
            assert {shard[i] for i in ids} == {low}
            return
        left = [i for i in ids if shard[i] < low + many // 2]
        right = [i for i in ids if shard[i] >= low + many // 2]
        spread = [(max(own[i][0][d] for i in ids) - min(own[i][0][d] for i in ids)) / extent[d] for d in range(4)]
        widest = max(range(4), key=lambda d: (spread[d], -d))
        place = lambda i: (own[i][0][widest], own[i][1], own[i][2])
        assert max(map(place, left)) < min(map(place, right))
        total, weight = sum(own[i][3] for i in ids), sum(own[i][3] for i in left)
        assert abs(weight - total * (many // 2) / many) <= max(0.0005 * total, max(own[i][3] for i in ids))
        check(left, low, many // 2)
        check(right, low + many // 2, many - many // 2)

    check(list(own), 0, leaves)


def test_more_leaves_than_a_driver_would_hold_cuts_for(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"), F.col("id").alias("n_chars"))
    sizes = [r["n"] for r in kd_shards(docs, leaves=600).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 600 and max(sizes) <= 6


def test_larger_query_sets_go_in_parts(docs, bench):
    whole = decontaminate(docs, bench, keep=["doc_id"])
    parts = decontaminate(docs, bench, keep=["doc_id"], part_bytes=100)
    key = lambda d: sorted(((r.doc_id, r.n_words, [tuple(h) for h in r.bench_hits], r.bench_items) for r in d.collect()), key=repr)
    assert key(whole) == key(parts)
    found = {r.doc_id: r for r in whole.collect()}
    assert found[0].bench_items == [1] and found[7].bench_items == [4] and found[3].bench_items == []


def test_quality_of_boilerplate(spark):
    boiler = "this very line stands on all the pages of that host every time"
    texts = [(i, f"{boiler}\n{' '.join(f'own{i}x{j}' for j in range(12 if i % 2 else 3))}") for i in range(40)]
    rows = {r.doc_id: r for r in quality_rules(table(spark, texts)).collect()}
    assert rows[1].kept and rows[1].n_boilerplate_words == 13 and not rows[0].kept and not rows[2].kept
    # Rows that share a doc_id are one document: 20 of them hold the line, which isn't above the limit.
    assert all(r.kept for r in quality_rules(table(spark, [(i // 2, t) for i, t in texts])).collect())


def test_a_very_large_host(spark):
    # 300 of 5,000 documents are no tenth of the host, but more than any line may stand in.
    docs = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.lit("hot").alias("source"),
        F.concat(F.when(F.col("id") % 16 == 0, "a notice that rather many of the pages of the host have\n").otherwise(""), F.lit("ten words of its own for each: "), F.concat_ws(" ", *[F.concat(F.lit(c), "id") for c in "abcdef"])).alias("text"),
    )
    assert quality_rules(docs).where("n_boilerplate_words > 0").count() == 0
    assert quality_rules(docs, max_line_docs=300).where("n_boilerplate_words = 12").count() == 313


def test_redaction(spark):
    docs = table(spark, [(1, "é password: abcdefghijkl! token=0123456789abcdef0123"), (2, None), (3, "nothing")])
    rows = {r.doc_id: r.text for r in redacted(scan_secrets(docs)).collect()}
    assert rows == {1: "é [SECRET]! [SECRET]", 2: None, 3: "nothing"}


def test_tables_are_cleared(spark, docs):
    from pathlib import Path

    from docweave.llm import store

    folder = Path(store._own_folder(spark).removeprefix("file://"))
    assert line_dedup(docs).count() and list(folder.iterdir())
    store.clear(spark)
    assert not folder.exists()


@pytest.fixture
def corpus(spark, tmp_path):
    """A folder with a small benchmark, and documents with every odd case and columns of clashing names."""
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    near = own(1).replace("w1x39", "changed")
    passage = " ".join(f"bench{j}" for j in range(14))
    extra = ["_keyed", "_id", "_h1", "_carried", "block", "a.b", "N_Lines", "KEPT", "Bench_Hits", "IDS", "_own"]
    rows = [(1, own(1)), (2, near), (None, near), (3, None), (4, ""), (5, own(5)), (5, own(5)), (6, own(6) + "\n" + own(5)), (7, f"{own(7)} {passage} {own(8)}"), (8, own(9) + " " + own(10) * 50), (None, own(11))]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in extra)
    docs = spark.createDataFrame([(i, t, None, None if k % 2 else "s", None, *[f"{c}{k}" for c in extra]) for k, (i, t) in enumerate(rows)], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage), (2, None), (None, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_pipeline_stages_on_odd_rows(spark, corpus):
    import corpus_pipeline

    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    kept = {"quality_rules": {1, 2, 5, 6, 7, None}, "line_dedup": {1, 2, 5, 6, 7, None}, "ngram_jaccard_join": {1, 5, 6, 7, None}, "benchmark_decontamination": {1, 5, 6, None}}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = by_id(docs)
        docs = stage(spark, docs, corpus)
        rows = docs.collect()
        assert {r.doc_id for r in rows} == kept[name], name
        if name != "line_dedup":
            assert {tuple(r) for r in rows} <= set(before)  # every column as it was
        docs = spark.createDataFrame(rows, docs.schema)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    assert [r.doc_id for r in rows].count(5) == 2 and [r.doc_id for r in rows].count(None) == 1 and all(r.exact for r in rows)


def test_pipeline_of_an_empty_table(spark, corpus, tmp_path):
    import corpus_pipeline

    empty = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, corpus)
        assert out.collect() == [], name
        empty = out if name == "bpe" else spark.createDataFrame([], out.schema)
