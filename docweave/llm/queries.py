"""Queries of the training-data operators: callables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm.bpe import tokenized
from docweave.llm.decontaminate import decontaminate
from docweave.llm.hard_negatives import hard_negatives
from docweave.llm.jaccard_join import jaccard_join
from docweave.llm.kd_shard import kd_shards
from docweave.llm.line_dedup import line_dedup
from docweave.llm.paragraph_dedup import paragraph_dedup
from docweave.llm.quality_rules import quality_rules
from docweave.llm.secret_scan import scan_secrets
from docweave.llm.spelling_variants import spelling_variants, vocabulary, words_of
from docweave.llm.suffix_dedup import suffix_dedup
from docweave.llm.toxicity import toxicity
from docweave.llm.transport_stream import demuxed, muxed

#: The tokenizer file that op8 and the pipeline read, by name; it must be on every executor.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (
  SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(s.first <> k.doc_id, false) AS dropped
  FROM k LEFT JOIN s ON k.key = s.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"].isin("assign", "access", "hex"))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
    )


def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"), leaves=8)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = F.aggregate("bench_hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    ids = F.array_sort(F.transform("bench_items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "n_near",
    )


OP5_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)
), hit AS (SELECT o.doc_id, o.i, o.n, win.item_id FROM occ o JOIN win ON o.n = win.n AND o.phrase = win.phrase),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
exact AS (SELECT DISTINCT doc_id, item_id FROM hit),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM exact GROUP BY doc_id
), place AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM dw),
df AS (SELECT word, count(DISTINCT doc_id) AS n FROM place GROUP BY word),
ranked AS (
  SELECT item_id, word, r, max(r) OVER (PARTITION BY item_id) AS many FROM (
    SELECT item_id, word, row_number() OVER (PARTITION BY item_id ORDER BY df.n, word) AS r
    FROM (SELECT DISTINCT item_id, unnest(w) AS word FROM iw) JOIN df USING (word)) WHERE r <= 8
), lengths AS (SELECT item_id, max(len(w)) AS reach FROM iw GROUP BY item_id),
term AS (SELECT *, greatest(4, (5 * many + 7) // 8) AS needed FROM ranked JOIN lengths USING (item_id) WHERE many >= 4),
centre AS (SELECT item_id, doc_id, p, needed, reach FROM term JOIN place USING (word) WHERE r <= many - needed + 1),
near AS (
  SELECT DISTINCT item_id, doc_id FROM (
    SELECT c.item_id, c.doc_id, c.p, c.needed, count(DISTINCT t.word) AS n
    FROM centre c JOIN term t USING (item_id) JOIN place q ON q.doc_id = c.doc_id AND q.word = t.word AND abs(q.p - c.p) <= c.reach
    GROUP BY 1, 2, 3, 4) WHERE n >= needed
), close AS (SELECT doc_id, count(*) AS n_near FROM near ANTI JOIN exact USING (doc_id, item_id) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN close USING (doc_id)
"""


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality_rules(docs).drop("source")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, text FROM d),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS phrase
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, phrase) AS c FROM win) WHERE c >= 2) GROUP BY doc_id
), stats AS (
  SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
            - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)
), l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (
  SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), hosts AS (SELECT coalesce(source, '') AS source, count(DISTINCT doc_id) AS total FROM d GROUP BY 1),
f AS (
  SELECT source, key FROM (
    SELECT source, key, count(DISTINCT doc_id) AS docs FROM k WHERE length(key) >= 10 GROUP BY source, key)
  JOIN hosts USING (source) WHERE docs > 10000 OR (docs > 20 AND docs * 100 > total * 10)
), gone AS (
  SELECT k.doc_id, sum(n) AS n FROM k JOIN f ON k.source = f.source AND k.key = f.key GROUP BY k.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       CAST(coalesce(gone.n, 0) AS BIGINT) AS n_boilerplate_words,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - coalesce(gone.n, 0) >= 10 AS kept
FROM stats LEFT JOIN gone USING (doc_id)
"""


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 75 * (x.n + y.n - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, CAST(coalesce(c.n_links, 0) AS BIGINT) AS n_links
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM link GROUP BY a) c USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)
"""


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenized(docs, tokenizer_path(), keep=["doc_id"], want=("n_tokens", "ids_sha256", "decoded_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), keep=["doc_id"])
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, CAST(list_dot_product(a.q, r.q) AS BIGINT) AS score
  FROM r a JOIN r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score FROM s WHERE own = label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), f AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND s.own <> s.label AND 80 * p.score <= 100 * s.score AND s.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM f WHERE rank <= 5
"""


def op12_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    payload = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    unit = 576
    short = unit - F.length("payload") % unit
    more = F.when(F.length("payload") == 0, unit).when(short == unit, 0).otherwise(short)
    filled = F.concat("payload", F.unhex(F.repeat(F.lit("FF"), more)))
    sources = docs.select("doc_id", payload.alias("payload")).select("doc_id", F.length("payload").cast("long").alias("n_bytes"), filled.alias("payload"))
    streams = demuxed(muxed(sources, unit=unit, keep=["doc_id", "n_bytes"])).withColumn("data", F.col("streams")[0]["data"])
    units = F.col("streams")[0]["units"]
    feature = F.concat_ws(
        ";", F.concat(F.lit("programs="), F.size("programs")), F.concat(F.lit("streams="), F.size("streams")),
        F.concat(F.lit("type="), F.col("streams")[0]["stream_type"]), F.concat(F.lit("packets="), "packets"), F.concat(F.lit("faults="), F.size("faults")),
        F.concat(F.lit("units="), F.size(units)), F.concat(F.lit("random_access="), F.size(F.filter(units, lambda u: u["random_access"]))),
        F.concat(F.lit("first_pts="), units[0]["pts"]), F.concat(F.lit("last_pts="), F.element_at(units, -1)["pts"]),
    )
    return streams.select(
        "doc_id", "n_bytes", F.length("data").cast("long").alias("payload_bytes"), F.sha2("data", 256).alias("payload_sha256"),
        F.crc32(F.substring("data", -32, 32)).alias("tail_crc32"), F.length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(words_of(table(spark, sf_dir, "documents").select("doc_id", "text"))))


#: The crc32 table is built from its polynomial; accented letters become single bytes for the pair search.
OP13_SQL = r"""
WITH t AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(0, 256) r(i))
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7
), counted AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS salted, run, count(*) AS n FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT run, n, list_transform(range(0, CAST(length(hex(encode(salted))) / 2 AS BIGINT)),
         lambda k: CAST('0x' || substr(hex(encode(salted)), 2 * k + 1, 2) AS BIGINT)) AS b FROM counted
), h AS (
  SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) AS h FROM bytes, t
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), d AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), pair AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
  UNION
  SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word
), best AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pair GROUP BY word
), f AS (
  SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
         CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM v LEFT JOIN best USING (word)
), chain AS (
  SELECT f.word, a.form AS f1, b.form AS f2, c.form AS f3, d.form AS f4, e.form AS f5, f.form AS f0, f.n, f.n_near, f.form_n
  FROM f LEFT JOIN f a ON a.word = f.form LEFT JOIN f b ON b.word = a.form LEFT JOIN f c ON c.word = b.form
  LEFT JOIN f d ON d.word = c.form LEFT JOIN f e ON e.word = d.form
)
SELECT word, f0 AS form, coalesce(f5, f4, f3, f2, f1, f0, word) AS root, n, n_near, form_n FROM chain
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_secret_scan": op3_secret_scan,
        "op4_kd_shards": op4_kd_shards,
        "op5_decontaminate": op5_decontaminate,
        "op6_quality_rules": op6_quality_rules,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_bpe": op8_bpe,
        "op9_toxicity": op9_toxicity,
        "op10_paragraph_dedup": op10_paragraph_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_transport_stream": op12_transport_stream,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1_SQL, "op5_decontaminate": OP5_SQL, "op6_quality_rules": OP6_SQL, "op7_jaccard_join": OP7_SQL, "op11_hard_negatives": OP11_SQL, "op13_spelling_variants": OP13_SQL}
