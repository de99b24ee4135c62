import json
import xml.etree.ElementTree as ET
import zipfile

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from docweave.sources import filetree, readers, release, walk, xml_rows
from docweave.sources.json_tree import json_urls
from docweave.streaming import resume


def test_filetree_keeps_the_last_of_a_path(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.md", "old", 1), ("a/x.md", "new", 2), ("b.md", "b", 3)], "path string, content string, ord int")
    filetree.write_tree(rows, str(tmp_path / "out"), order="ord")
    assert (tmp_path / "out/a/x.md").read_text() == "new" and (tmp_path / "out/b.md").read_text() == "b"
    filetree.write_tree(rows.where("ord = 3"), str(tmp_path / "out"), mode="overwrite")
    assert [p.name for p in (tmp_path / "out").rglob("*.md")] == ["b.md"]
    assert (tmp_path / "out/_SUCCESS").read_text() == "1" and not [p for p in (tmp_path / "out").rglob(".*")]


def test_filetree_refuses_paths_outside(spark, tmp_path):
    rows = spark.createDataFrame([("../x.md", "no")], "path string, content string")
    with pytest.raises(Exception, match="not below the target"):
        filetree.write_tree(rows, (tmp_path / "out").as_uri())
    assert not (tmp_path / "x.md").exists() and not (tmp_path / "out/_SUCCESS").exists()


def test_normalised_scans(spark, tmp_path):
    def scanned(kind, root, body):
        (tmp_path / f"{kind}.xml").write_text(f"<{root}>{body}</{root}>")
        return readers.read_xml(spark, str(tmp_path / f"{kind}.xml"), kind)

    details = scanned("details", "Members", "<Member><Type>N.T</Type><Name> M </Name><Signature> M( int a ) </Signature><Description><![CDATA[ About <see cref=\"N.U\">U</see> ]]></Description><Parameters><Parameter><Name>a</Name><Description>first</Description></Parameter><Parameter><Description>lost</Description></Parameter></Parameters></Member><Member><Type>T</Type><Name>x</Name></Member><Member><Type>N.T</Type></Member>")
    (row,) = readers.details_rows(details).collect()
    assert (row.fqn, row.member, row.signature, row.description, row.returns) == ("N.T", "M", "M( int a )", 'About <see cref="N.U">U</see>', "")
    assert [tuple(p) for p in row.params] == [("a", "first")]
    enums = scanned("enums", "EnumMembers", "<Enum><Name>e</Name><Assembly>A</Assembly><Namespace>N</Namespace><Members><Member><Name>one</Name><Description>1</Description></Member><Member><Name>two</Name></Member></Members></Enum><Enum><Name>f</Name><Assembly>A</Assembly><Namespace>N</Namespace></Enum><Enum><Name>g</Name></Enum>")
    assert [(r.fqn, r.pos, r.member, r.description) for r in readers.enums_rows(enums).collect()] == [("N.e", 0, "one", "1"), ("N.e", 1, "two", ""), ("N.f", None, None, None)]
    examples = scanned("examples", "Examples", "<Example><Url>/u.htm</Url><Content>old</Content></Example><Example><Url> /u.htm </Url><Content>new</Content></Example><Example><Url>/v.htm</Url></Example>")
    assert [tuple(r) for r in readers.examples_rows(examples.withColumn("ord", F.monotonically_increasing_id())).collect()] == [("/u.htm", "new")]
    types = scanned("types", "Types", "<Type><Name>T</Name><Assembly>A</Assembly><Namespace>N</Namespace><Remarks> r </Remarks><Examples><Example><Name>n</Name><Language>C#</Language><Url>/u</Url></Example><Example><Name>no</Name></Example></Examples></Type>")
    (row,) = readers.types_rows(types).collect()
    assert (row.fqn, row.remarks, [e.Url for e in row.examples]) == ("N.T", "r", ["/u"])


def test_written_rows_are_read_again(spark, tmp_path):
    pair = "array<struct<name:string,url:string>>"
    members = spark.createDataFrame([("T", "A", "N", [("P", "/p.html")], [])], f"name string, assembly string, namespace string, properties {pair}, methods {pair}")
    details = spark.createDataFrame([("A", "N.T", "M", "M( a ]]> b )", "text ]]> with <b>", [("a", "x & y")], "r", "")], "assembly string, type_name string, name string, signature string, description string, parameters array<struct<name:string,description:string>>, returns string, remarks string")
    enums = spark.createDataFrame([("e", "A", "N", [("one", "1 < 2")])], "name string, assembly string, namespace string, members array<struct<name:string,description:string>>")
    examples = spark.createDataFrame([("/u.htm", "T\n\n<code>\nif (a < b && c) x[y[0]]>1;\n</code>")], "url string, content string")
    for kind, root, df, row in (("members", "Types", members, xml_rows.members_row), ("details", "Members", details, xml_rows.member_row), ("enums", "EnumMembers", enums, xml_rows.enum_row), ("examples", "Examples", examples, xml_rows.example_row)):
        file = df.agg(xml_rows.xml_file(root, F.collect_list(row(*[F.col(c) for c in df.columns]))).alias("x")).first().x
        (tmp_path / f"{kind}.xml").write_text(file)
        ET.fromstring(file)
    read = lambda kind: readers.read_xml(spark, str(tmp_path / f"{kind}.xml"), kind)
    assert [(r.fqn, r.kind, r.member, r.url) for r in readers.members_rows(read("members")).collect()] == [("N.T", "property", "P", "/p.html")]
    assert "PublicMethods" not in (tmp_path / "members.xml").read_text()
    (row,) = readers.details_rows(read("details")).collect()
    assert (row.signature, row.description, [tuple(p) for p in row.params]) == ("M( a ]]> b )", "text  with <b>", [("a", "x & y")])  # the normaliser takes CDATA marks out
    assert read("details").first().Description == "text ]]> with <b>"
    assert readers.enums_rows(read("enums")).first().description == "1 < 2"
    assert read("examples").first().Content == examples.first().content


def test_row_xml_round_trip(spark, tmp_path):
    types = spark.createDataFrame([("IT", "A", "N", "About <b>", [("Use", "C#", "/u.htm")], "")], "name string, assembly string, namespace string, description string, examples array<struct<name:string,language:string,url:string>>, remarks string")
    row = xml_rows.type_row(*[F.col(c) for c in types.columns])
    text = types.agg(xml_rows.xml_file("Types", F.collect_list(row)).alias("x")).first().x
    (tmp_path / "types.xml").write_text(text)
    back = readers.read_xml(spark, str(tmp_path / "types.xml"), "types").first()
    assert (back.Name, back.Description, back.Remarks) == ("IT", "About <b>", None)
    assert "Remarks" not in text and back.Examples.Example[0].Url == "/u.htm"
    assert [r.url for r in readers.example_urls(readers.read_xml(spark, str(tmp_path / "types.xml"), "types")).collect()] == ["/u.htm"]


def test_page_scans(spark, tmp_path):
    for name in ("d/A~A.T.html", "d/e/A~A.T_members_0a1b2c3d.html", "d/x.htm"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("<p>é</p>")
    assert {r.file_name for r in readers.read_pages(spark, str(tmp_path)).collect()} == {"A~A.T.html", "A~A.T_members_0a1b2c3d.html"}
    assert [r.file_name for r in readers.read_members_pages(spark, str(tmp_path)).collect()] == ["A~A.T_members_0a1b2c3d.html"]
    assert [r.file_name for r in readers.read_one_level(spark, str(tmp_path)).collect()] == ["A~A.T.html"]
    assert [r.file_name for r in readers.read_example_pages(spark, str(tmp_path)).collect()] == ["x.htm"]


def test_page_scans_by_tasks(spark, tmp_path):
    names = ["top.html", "a b/x%20y+z#[1]{2}.html", "é/ü\u00a0ß.htm", "d/e/f/_members_.html", "d/_hidden.html", "d/.dot.html", "_passing/x.html", "d/.x/y.html", "k=1/_k=2.html", "d/x.html._COPYING_", "d/x.HTML", "d/empty.html", "'~(!)*&;,@:$^`|/p_members_1.html"]
    names += [f"many/{i}/{j}/{i}.html" for i in range(walk.SPREAD + 6) for j in range(2)]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if "empty" in name else b"\xef\xbb\xbf<p>\xff\r\n" + name.encode())
    (tmp_path / "link.html").symlink_to(tmp_path / "gone")
    (tmp_path / "linked").symlink_to(tmp_path / "é")

    def rows(pages):
        return sorted((r.path, r.file_name, bytes(r.html)) for r in pages.withColumn("html", F.col("html").cast("binary")).collect())

    def by_spark(pattern, path=str(tmp_path), recursive=True):
        files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).text(path, wholetext=True)
        return rows(files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("html")))

    for pattern in ("*.html", "*_members_*.html", "*.{htm,html}", "?[!x]*.htm*", "[a-z]?html"):
        pages = readers.read_pages(spark, str(tmp_path), pattern)
        assert rows(pages) == by_spark(pattern)
        assert not pages.inputFiles()  # what the driver would hold of Spark's own scan: all names
    assert rows(readers.read_pages(spark, f"file://{tmp_path}/", recursive=False)) == [r for r in by_spark("*.html") if r[1] == "top.html"]
    assert rows(readers.read_pages(spark, f"{tmp_path}/many/1*/")) == by_spark("*.html", f"{tmp_path}/many/1*/")
    one = rows(readers.read_one_level(spark, str(tmp_path)))
    assert {r[1] for r in one} == {"x%2520y+z%23%5B1%5D%7B2%7D.html", "_k=2.html", "p_members_1.html"}
    assert one == [r for r in by_spark("*.html") if r[0].removeprefix(f"file:{tmp_path}/").count("/") == 1]
    assert rows(readers.read_pages(spark, str(tmp_path / "top.html"))) == [r for r in by_spark("*.html") if r[1] == "top.html"]
    (tmp_path / "none").mkdir()
    assert rows(readers.read_pages(spark, str(tmp_path / "none"))) == []
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        readers.read_pages(spark, str(tmp_path / "absent"))


def test_pages_that_are_not_kept_are_not_read(spark, tmp_path):
    for name in ("kept.html", "other.html"):
        (tmp_path / name).write_text("<p>x</p>")
    pages = readers.read_pages(spark, str(tmp_path))
    assert "BatchEvalPython" not in pages.select("path", "file_name")._jdf.queryExecution().executedPlan().toString()
    plan = pages.where(F.col("file_name") == "kept.html")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("BatchEvalPython") < plan.index("Filter")


def test_toc_files(spark, tmp_path):
    node = {"id": "1", "parentId": "-1", "name": "Root", "url": "", "isLeaf": False, "children": [{"id": "1.0", "parentId": "1", "name": "Leaf", "url": "/l.htm", "isLeaf": True}]}
    (tmp_path / "expandToc_id_1.json").write_text(json.dumps(node))
    from docweave.operators.toc import toc_nodes

    assert {(r.id, r.name, r.is_leaf) for r in toc_nodes(readers.read_toc(spark, str(tmp_path))).collect()} == {("1", "Root", False), ("1.0", "Leaf", True)}
    deep = json.dumps({"url": "/a", "children": [{"children": [{"url": "/b"}]}, {"url": "/c"}]})
    assert {r.url for r in json_urls(spark.createDataFrame([(deep,)], "json string")).collect()} == {"/a", "/b", "/c"}


def test_snapshot_source(spark, tmp_path):
    (tmp_path / "p.html").write_text("<p>x</p>")
    spark.dataSource.register(readers.SnapshotSource)
    from docweave.ship import shipped

    shipped(spark)
    urls = "https://docs.example.com/p.html\nhttps://docs.example.com/none.html"
    rows = {r.url[-6:]: r for r in spark.read.format("page_snapshot").options(path=str(tmp_path), urls=urls).load().collect()}
    assert rows["p.html"].content == "<p>x</p>" and rows["e.html"].error == "FileNotFoundError"
    options = {"path": str(tmp_path), "urls": "https://docs.example.com/p.html\nhttps://example.org/p.html\nhttps://docs.example.com/p.pdf", "domain": "example.com", "html_only": "true"}
    found = spark.read.format("page_snapshot").options(**options).load().collect()
    assert {r.error for r in found} == {None, "domain not allowed", "not HTML"} and {r.content_type for r in found} == {"text/html", None, "application/pdf"}


def test_release(spark, tmp_path):
    (tmp_path / "t/api").mkdir(parents=True)
    (tmp_path / "t/api/a.md").write_text("a")
    made = release.zip_tree({"docs": str(tmp_path / "t")}, str(tmp_path / "x.zip"))
    assert made["file_count"] == 1 and zipfile.ZipFile(tmp_path / "x.zip").namelist() == ["docs/api/a.md"]
    assert release.write_manifest([made], "v1", str(tmp_path / "m.json"))["total_size_bytes"] == made["size_bytes"]
    check = release.package_checks(release.archive_entries(spark, str(tmp_path / "x.zip")), ["docs", "api"], 1).first()
    assert (check.files, check.enough, check.missing_dirs) == (1, True, "api")
    assert release.latest_version(str(tmp_path)) == "v0.0.0"
    passed = lambda *packages: {r.name: r.passed for r in release.manifest_checks(spark, str(tmp_path / "m.json"), list(packages)).collect()}
    assert passed("x.zip") == {"version": False, "packages": True, "total size": True} and not passed("y.zip")["packages"]


PAGE = ("url", "status_code", "content", "error")
SITE_URL = "https://docs.example.com/help/api/"


@pytest.fixture
def crawl(spark, tmp_path):
    """Lands rows of pages in a file and runs the log over what is there; keeps the folders as attributes."""

    def land(name, *rows, state="state"):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / name).write_text("\n".join(json.dumps(dict(zip(PAGE, r, strict=True))) for r in rows))
        for query in resume.start_log(resume.landed_pages(spark, str(tmp_path / "landing")), land.log, str(tmp_path / state), land.errors, land.tree):
            query.awaitTermination()
        return {r.url[len(SITE_URL) :]: r for r in readers.read_crawl_log(spark, land.log).collect()}

    land.log, land.errors, land.tree = (str(tmp_path / n) for n in ("log", "errors", "tree"))
    return land


def page(name, content):
    return SITE_URL + name, 200, content, None


def test_stream_resumes_without_duplicates(spark, tmp_path, crawl):
    crawl("1.json", page("a.html", "<title>A</title>"), (SITE_URL + "b.html", 404, None, "HTTP 404"))
    rows = crawl("2.json", page("a.html", "<title>again</title>"), page("c.html", "x"))
    assert {u: r.title for u, r in rows.items()} == {"a.html": "A", "c.html": "Untitled"}
    assert rows["a.html"].file_path == "a.html" and rows["a.html"].content_length == 16
    assert [(r.url[-6:], r.error) for r in spark.read.schema(readers.CRAWL_ERRORS).json(crawl.errors).collect()] == [("b.html", "HTTP 404")]
    assert (tmp_path / "tree/a.html").read_text() == "<title>A</title>"


def test_stream_keeps_the_first_page_of_a_url(spark, crawl):
    pages = [page(f"p{i % 5}.html", f"<title>{i}</title>") for i in range(40)]
    rows = crawl("1.json", *pages)
    assert {u: r.title for u, r in rows.items()} == {f"p{i}.html": str(i) for i in range(5)}
    assert readers.read_crawl_log(spark, crawl.log).count() == 5


def test_stream_goes_on_from_the_log_without_its_checkpoint(spark, tmp_path, crawl):
    crawl("1.json", page("a.html", "<title>A</title>"), page("b.html", "<title>B</title>"))
    # A new checkpoint sees all that has landed again; the log's URLs are known to it, and its rows stay.
    rows = crawl("2.json", page("b.html", "<title>other</title>"), page("c.html", "<title>C</title>"), state="new")
    assert {u: r.title for u, r in rows.items()} == {"a.html": "A", "b.html": "B", "c.html": "C"}
    crawl("3.json", page("c.html", "<title>other</title>"), page("d.html", "<title>D</title>"), state="new")
    assert readers.read_crawl_log(spark, crawl.log).count() == 4
    assert (tmp_path / "tree/b.html").read_text() == "<title>B</title>"


def test_stream_replays_a_batch_that_failed(spark, monkeypatch, crawl):
    write = resume.write_tree

    def failing(*args):
        write(*args)
        raise OSError("the driver is lost")

    monkeypatch.setattr(resume, "write_tree", failing)
    with pytest.raises(Exception, match="the driver is lost"):
        crawl("1.json", page("a.html", "<title>A</title>"))
    monkeypatch.setattr(resume, "write_tree", write)
    rows = crawl("2.json", page("a.html", "<title>late</title>"), page("b.html", "<title>B</title>"))
    assert {u: r.title for u, r in rows.items()} == {"a.html": "A", "b.html": "B"}
    assert readers.read_crawl_log(spark, crawl.log).count() == 2
