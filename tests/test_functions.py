import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docweave.functions import dotnet, names, render, text, urls
from docweave.sources import links

c = F.col


@pytest.mark.parametrize(
    ("href", "name", "url"),
    [
        ("Asm.X~Asm.X.IThing~Do.html", "Asm.X.IThing.Do", "https://docs.example.com/help/api/reference/Asm.X~Asm.X.IThing~Do.html"),
        ("../reference/Asm~Asm.IThing.html", "Asm.IThing", "https://docs.example.com/help/api/reference/Asm~Asm.IThing.html"),
        ("https://other.example.org/Asm~Asm.IThing.html", "Asm.IThing", "https://other.example.org/Asm~Asm.IThing.html"),
        ("../guide//Overview/Start_Page.htm", None, "https://docs.example.com/help/api/guide//Overview/Start_Page.htm"),
        ("Asm.IThing.htm", "Asm.IThing", "https://docs.example.com/help/api/reference/Asm.IThing.htm"),
    ],
)
def test_links(one, href, name, url):
    assert one(urls.href_to_cref(c("h")), h=href) == links.cref(href) == name
    assert one(urls.href_to_url(c("h")), h=href) == links.full_url(href) == url


def test_links_to_see_keeps_outer_space_and_drops_tags():
    html = 'use <a class="x" href="A~N.T~M.html"> T::M </a>, &amp; <p>see</p> <a href="../g/P.htm">P</a>'
    assert links.links_to_see(html) == 'use  <see cref="N.T.M">T::M</see> , & see <see href="https://docs.example.com/help/api/g/P.htm">P</see>'
    assert links.links_to_see("List&lt;T&gt; x") == "List x"
    assert links.links_to_see("List&lt;T&gt; x", keep_generics=True) == "List<T> x"


@pytest.mark.parametrize(
    ("name", "kind"),
    [
        ("A~A.T.html", "type"), ("A~A.T~M.html", "member"), ("A~A.T_members_0a1b2c3d.html", None), ("A~A_namespace_0a1b2c3d.html", None),
        ("A~A.swKind_e_0a1b2c3d.html", "enum"), ("ReleaseNotes~x.html", None), ("help_list~x.html", None), ("plain.html", None),
    ],
)
def test_file_kinds(one, name, kind):
    assert one(names.is_member_file(c("n")), n=name) == (kind == "member")
    assert one(names.is_type_file(c("n")), n=name) == (kind in ("type", "enum"))
    assert one(names.is_enum_file(c("n")), n=name) == (kind == "enum")


def test_identities(one):
    assert one(names.file_identity(c("n")), n="Asm~Asm.Core.IThing_0a1b2c3d.html") == ("Asm", "Asm.Core", "IThing")
    assert one(names.file_identity(c("n")), n="Asm~IThing.html") == ("Asm", "Asm", "IThing")
    assert one(names.file_identity(c("n")), n="plain.html") is None
    assert one(names.members_file_identity(c("n")), n="Asm~Asm.Core.IThing_members_0a1b2c3d.html") == ("Asm", "Asm.Core", "IThing")
    assert one(names.enum_file_identity(c("n")), n="Asm~Asm.Core.kind_e_0a1b2c3d_0a1b2c3d.htmll.html") == ("Asm", "Asm.Core", "kind_e")


@pytest.mark.parametrize(("name", "language"), [("X_Example_VBNET.htm", "VB.NET"), ("X_Example_VB.htm", "VBA"), ("X_CSharp.htm", "C#"), ("X_CPP_COM.htm", "C++"), ("X.htm", "Unknown")])
def test_languages(one, name, language):
    assert one(names.infer_language(c("n")), n=name) == language


def test_saved_paths(one):
    base = "https://docs.example.com/help/api/a/"
    import hashlib

    mark = hashlib.md5(b"id=1").hexdigest()[:8]
    page, example = urls.page_file_path(c("u")), urls.example_file_path(c("u"))
    assert one(page, u=base + "X.html") == "a/X.html"
    assert one(page, u=base + "X.htm") == "a/X.htm.html"
    assert one(page, u=base + "X.htm?id=1") == f"a/X_{mark}_{mark}.html"
    assert one(page, u=base + "X.html?id=1") == f"a/X_{mark}_{mark}.htmll.html"
    assert one(page, u="https://docs.example.com/expandToc?version=1&queryParam=%3Fid%3D2.1") == "expandToc_id_2.1.json"
    assert one(example, u=base + "X.htm") == "a/X.htm"
    assert one(example, u=base + "X.htm?id=1") == f"a/X_{mark}.html"
    assert one(page, u="https://docs.example.com/help/api/a b|c") == "a b_c.html"


def test_dotnet(one):
    assert one(dotnet.signature_params(c("s")), s="Do()") is None
    assert one(dotnet.signature_params(c("s")), s="Do( System.string a, out System.int b, A.List<B.C<D,E>,F> c )") == ["System.String", "System.Int32@", "A.List<B.C<D,E>,F>"]
    assert one(dotnet.clean_signature(c("s")), s="System.bool  Do(\n System.int a )") == "Do( System.int a )"
    for given_, wanted in [("int", "System.Int32"), ("ref int", "System.Int32@"), ("int[]", "System.Int32[]"), ("byte*[,]", "System.Byte*[,]"), ("Own", "Own")]:
        assert one(dotnet.encoded_param_type(c("t")), t=given_) == wanted
    assert one(dotnet.doc_id("M", c("n"), c("t"), F.lit("Do"), F.array(F.lit("A"), F.lit("B"))), n="N", t="T") == "M:N.T.Do(A,B)"


def test_text(one):
    assert one(text.utrim(c("x")), x=" \t a  ") == "a"
    assert one(text.simplify_see(c("x")), x='<see cref="A.B">B</see> <see cref="A.B.C"/>') == "[[B]] [[C]]"
    assert one(text.guide_file_name(c("x")), x=" .a:b/c. ") == "a_b_c"
    assert len(one(text.guide_file_name(c("x")), x="a" * 250)) == 200
    content = "Title\n about \n\n<CODE>\nx = 1\n</CODE>\nafter"
    assert one(text.example_title(c("x")), x=content) == "Title"
    assert one(text.example_description(c("x")), x=content) == "about"
    assert one(text.first_code(c("x")), x=content) == "x = 1"
    assert [tuple(p) for p in one(text.example_segments(c("x")), x=content)] == [("text", "Title\n about"), ("code", "\nx = 1\n"), ("text", "after")]


def test_render_omits_what_is_empty(one):
    none = F.array().cast("array<struct<name:string,description:string>>")
    page = one(render.member_page(F.lit("method"), c("t"), c("m"), c("a"), c("a"), c("e"), c("e"), c("e"), none, c("e"), c("e")), t="IT", m="Do", a="A", e="")
    assert page == "---\ntype: IT\nmember: Do\nkind: method\nassembly: A\nnamespace: A\n---\n\n# IT.Do\n"


_part = st.text("abc", min_size=1, max_size=2)


def test_relative_paths_lead_back(spark):
    found = []

    @settings(max_examples=60, deadline=None)
    @given(st.lists(_part, min_size=1, max_size=4), st.lists(_part, min_size=1, max_size=4))
    def gather(a, b):
        found.append(("/".join(a), "/".join(b)))

    gather()
    for a, b, r in spark.createDataFrame(found, "a string, b string").select("a", "b", urls.relative_path(c("a"), c("b"))).collect():
        here = a.split("/")[:-1]
        for step in filter(None, r.split("/")):
            here = here[:-1] if step == ".." else [*here, step]
        assert "/".join(here) == b


FRAGMENTS = [
    "plain", "a < b", "a & b", "a &amp; b &#65; &#x41;", '<see cref="A.B">B</see> and <see cref="C" />', "<b>open", "</b>", "<b><i>crossed</b></i>", "<b><i>nested</i></b>", "x <T> y", "List<int> of <T></T></int>",
    "a ]]> b", "<a b=c>x</a>", "<a b='c'/>", "<a><!-- c --></a>", "&nbsp;", "1 << 2", "<a>\n</a>\n", "é <b>ü</b>", "<a></a><a></a>", "<a/><b>", "",
    "</r><r>", "<!-- a -- b -->", "<![CDATA[ <x> & ]]>", "<![CDATA[ open", "<a x='1' x='2'/>", "<p:a/>", "<p:a xmlns:p='u'/>", "<a p:x='1'/>", "<a xmlns:p='u' xmlns:q='u' p:x='1' q:x='2'/>", "<?pi x?>", "<?xml version='1.0'?>",
    "<a b='<'/>", "<a b='&lt;'/>", "&#0;", "&#x1F600;", "\x01", "a\ufffeb", "\ufffe", "<!DOCTYPE x>", "<a b='1'c='2'/>", "<1/>", "< a/>", "<a/ >", "<xml:b/>", "]]", "<a>]]></a>", "<a\tb='\n'/>", "&#xD;", "<é ü='1'/>",
]
PIECES = ["<a>", "</a>", "<b x='1'>", "</b>", "<c/>", "<p:a>", "</p:a>", "<p:a xmlns:p='u'>", "<a x='1' x='1'/>", "<a x='1' y=\"2\"/>", "<!-- c -->", "<!--", "-->", "<![CDATA[", "]]>", "&amp;", "&", "&#65;", "&x;", "<", ">", "text ", "é", "<?t d?>", "\x02", "'", '"']


def parsed(text):
    import xml.etree.ElementTree as ET

    try:
        return ET.fromstring(f"<r>{text}</r>")
    except ET.ParseError:
        return None


def test_fragments_as_a_parser_takes_them(spark):
    random.seed(8)
    texts = FRAGMENTS + ["".join(random.choices(PIECES, k=random.randint(1, 6))) for _ in range(10_000)]
    rows = spark.createDataFrame([(f,) for f in texts], "f string").select("f", render.well_formed(c("f")).alias("ok"), render.xml_content(c("f")).alias("x"), render.well_formed_each(F.array("f", F.lit("<a/>"))).alias("each")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        known = parsed(r.f)
        assert r.ok == (known is not None), r.f
        assert r.each == [r.ok, True]
        if "\x01" not in r.f and "\x02" not in r.f and "\ufffe" not in r.f:
            assert "".join(parsed(r.x).itertext()) == ("".join(known.itertext()) if known is not None else r.f)
    assert 1000 < sum(r.ok for r in rows) < 9000


def test_nothing_is_sent_to_the_parser_without_markup(spark):
    frame = spark.createDataFrame([("plain ]]> text",), (None,)], "f string")
    assert [r.ok for r in frame.select(render.well_formed(c("f")).alias("ok")).collect()] == [False, None]
    assert frame.select(render._marked(c("f")).alias("m")).where("m is not null").count() == 0


def test_parameters_in_xml(spark):
    params = [("a", "see <see cref='T'/>"), ("b<T>", "1 < 2"), ("c", None)]
    frame = spark.createDataFrame([(params,), ([],)], "p array<struct<name:string,description:string>>")
    none = F.lit("")
    made = [r.x for r in frame.select(render.xml_member(F.lit("M:T.M"), F.lit("method"), F.lit("M"), F.lit("Does."), c("p"), none, none).alias("x")).collect()]
    assert made[0] == """<member name="M:T.M"><summary>Does.</summary><param name="a">see <see cref='T'/></param><param name="b&lt;T&gt;">1 &lt; 2</param><param name="c"></param></member>"""
    assert made[1] == '<member name="M:T.M"><summary>Does.</summary></member>'


def test_examples_in_xml(one):
    import xml.etree.ElementTree as ET

    content = "Title & <more>\n<code>\nif (a < b && x[y[0]]>1)\n</code>\nthen\n<CODE>z</CODE>end"
    element = ET.fromstring(one(render.xml_example(F.col("x")), x=content))
    assert [c.tag for c in element] == ["code", "code"] and element.text == "Title & <more>\n"
    assert (element[0].text, element[0].tail, element[1].tail) == ("\nif (a < b && x[y[0]]>1)\n", "\nthen\n", "end")
    assert one(render.xml_example(F.col("x")), x="") is None
    member = one(render.xml_member(F.lit("P:N.T.M"), F.lit("property"), F.lit("M"), F.lit(""), F.array().cast("array<struct<name:string,description:string>>"), F.lit("v"), F.col("x"), F.lit("Rev < 3")), x='<see cref="A">A</see>')
    assert member == '<member name="P:N.T.M"><summary>Gets or sets M.</summary><value>v</value><remarks>\n<see cref="A">A</see>\n</remarks><availability>Rev &lt; 3</availability></member>'


def test_urls_are_joined_as_the_library_does(spark):
    from urllib.parse import urljoin

    bases = ["https://h.example.com/a/b/c.htm?x=1#f", "http://h/a/", "https://h.example.com", "https://h/a/b"]
    forms = ["", "d.htm", "./d", "../d", "../../d/e", "../../../d", "/d/../e", "/", "?q", "#t", "//o/p", "mailto:x@y", "http://o/p?q", "d/./e/..", "d?x/../y", "..", ".", "d#a/../b"]
    rows = spark.createDataFrame([(b, f) for b in bases for f in forms], "b string, f string").select("b", "f", urls.joined_url(F.col("b"), F.col("f")).alias("u")).collect()
    assert {(r.b, r.f): r.u for r in rows} == {(b, f): urljoin(b, f) for b in bases for f in forms}


def test_responses(one):
    assert one(urls.is_html(F.col("x")), x="Text/HTML; charset=x") and not one(urls.is_html(F.col("x")), x="image/png")
