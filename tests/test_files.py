"""The file sink with parts, and exports on disk."""

import hashlib
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from docweave.functions import urls
from docweave.operators import checks, export
from docweave.plans import export as plans
from docweave.sources import filetree, readers

DATA = "/root/testdata/sf0.001"


def files_of(root):
    return {str(f.relative_to(root)): f.read_bytes() for f in Path(root).rglob("*") if f.is_file() and f.name != "_SUCCESS" and not f.name.startswith(".")}


def test_large_files_are_streamed(spark, tmp_path):
    # Three files of parts in any order; the large one has 40 MB in 20,000 parts, of which a task holds some Arrow batches.
    big = spark.range(20_000).select(F.lit("a/big.txt").alias("path"), (20_000 - F.col("id")).alias("ord"), F.concat(F.lit("é"), F.lpad("id", 1_999, "x")).alias("part"))
    small = spark.range(6).select(F.concat(F.lit("b"), (F.col("id") % 2).cast("string")).alias("path"), F.col("id").alias("ord"), F.concat(F.col("id").cast("string"), F.lit("\n")).alias("part"))
    parts = big.unionAll(small)
    plan = filetree._in_order(parts)._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "collect_list" not in plan
    filetree.write_parts(parts, str(tmp_path / "out"))
    found = files_of(tmp_path / "out")
    want = hashlib.md5()
    for i in reversed(range(20_000)):
        want.update(("é" + str(i).rjust(1_999, "x")).encode())
    assert hashlib.md5(found["a/big.txt"]).hexdigest() == want.hexdigest() and len(found["a/big.txt"]) == 20_000 * 2001
    assert (found["b0"], found["b1"]) == (b"0\n2\n4\n", b"1\n3\n5\n") and len(found) == 3
    assert filetree.files_written(str(tmp_path / "out")) == 3
    digests = {r.path: (r.n_bytes, r.content_md5) for r in filetree.digested(parts).collect()}
    assert digests == {p: (len(b), hashlib.md5(b).hexdigest()) for p, b in found.items()}
    assert {r.path: r.content.encode() for r in filetree.gathered(small).collect()} == {p: b for p, b in found.items() if p.startswith("b")}


def test_nothing_is_left_by_a_task_that_fails(spark, tmp_path):
    bad = spark.createDataFrame([("ok.txt", "x"), ("../out.txt", "y")], "path string, content string").coalesce(1)
    with pytest.raises(Exception, match="not below the target"):
        filetree.write_tree(bad, str(tmp_path / "out"))
    assert not (tmp_path / "out/_SUCCESS").exists() and not [f for f in (tmp_path / "out").iterdir() if f.name.startswith("_passing")]
    assert not (tmp_path / "out.txt").exists()


def test_empty_parts(spark, tmp_path):
    none = spark.createDataFrame([], "path string, ord int, part string")
    filetree.write_parts(none, str(tmp_path / "out"))
    assert files_of(tmp_path / "out") == {} and filetree.files_written(str(tmp_path / "out")) == 0
    assert filetree.digested(none).collect() == [] and filetree.gathered(none).collect() == []


def test_xml_docs_on_disk(spark, tmp_path):
    fragments = spark.createDataFrame([("B", 2, "<member name='b'/>"), ("A&A", 1, "<member name='x'/>"), ("B", 1, "<member name='a'/>")], "assembly string, ord int, fragment string")
    filetree.write_parts(export.assembly_doc_parts(fragments), str(tmp_path / "docs"))
    found = files_of(tmp_path / "docs")
    assert found["B.xml"].decode() == "<?xml version=\"1.0\" ?>\n<doc>\n  <assembly>\n    <name>B</name>\n  </assembly>\n  <members>\n    <member name='a'/>\n    <member name='b'/>\n  </members>\n</doc>\n"
    assert ET.fromstring(found["A&A.xml"]).findtext("assembly/name") == "A&A" and len(found) == 2


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_a_whole_export_on_disk(spark, tmp_path):
    made = plans.whole_export(spark, DATA)
    n = made.write(str(tmp_path / "out"))
    found = files_of(tmp_path / "out")
    listing = {r.path: (r.n_bytes, r.content_md5) for r in made.listing().collect()}
    assert listing == {p: (len(b), hashlib.md5(b).hexdigest()) for p, b in found.items()} and n == len(found)
    assert f"({n - 1:,} files)" in found["README.md"].decode()


def test_statistics_are_read_back(spark, tmp_path):
    (tmp_path / "stats.json").write_text('{\n "total": 3,\n "by": {"x": 1},\n "name": "é"\n}')
    read = readers.read_stats(spark, str(tmp_path / "stats.json"), "total bigint, name string, missing bigint")
    assert [tuple(r) for r in read.collect()] == [(3, "é", None)]
    counted = spark.createDataFrame([(4, 0)], "total bigint, missing bigint")
    rows = {r.name: (r.passed, r.detail) for r in checks.stated_counts(read, counted).collect()}
    assert rows == {"total": (False, "3 stated, 4 counted"), "missing": (False, "nothing stated, 0 counted")}


def test_keys_of_examples(spark):
    rows = spark.createDataFrame([("file:/data/output/html/a/b.htm",), ("/data/output/html/c.htm",), ("C:\\data\\output\\html/d\\e.htm",)], "path string")
    assert [r.k for r in rows.select(readers.relative_key(F.col("path"), "/data/output/html/").alias("k")).collect()] == ["a/b.htm", "c.htm", "d/e.htm"]


def test_manifests_of_crawls():
    site = urls.Site("https://h.example.com", "/help/", "ref/")
    plain, listed = export.crawl_manifest(site), export.crawl_manifest(site, source="members.xml", delay=0.5)
    assert plain == {"base_url": "https://h.example.com", "boundary": "/help/", "obey_robots": "true", "download_delay": "0.1"}
    assert listed == plain | {"obey_robots": "false", "download_delay": "0.5", "source": "members.xml"}
