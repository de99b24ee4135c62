"""Tokens and links by patterns against the standard library's parser."""

import random
from html.parser import HTMLParser

import pytest

from docweave.sources import links, tokens
from docweave.sources.html import _member_title, _signature
from docweave.sources.tree import Node, tree

TIDY = ["<p>", "</p>", "<P CLASS='x y'>", '<a href="A~N.T.html">', "</a>", "<a class=k href='p?x=1&amp;y=2&copy=3.htm'>", "<br/>", "<br>", "<img src=a.png alt=\"1 > 0\" />", "text", " ", "a &amp; b", "&lt;T&gt;", "&nbsp;", "é\n", "<!-- c -->", "<!DOCTYPE html>", "<td nowrap>", "<h1 id = 'x'>", "</h1 >", "<script>if (a) b()</script>", "<style></style>", "&copy", "</td>"]
ODD = ["<", ">", "<!--", "<p", "</", "<a href=x/y>", "<a href='x\">", "<1>", "<!x>", "<?pi?>", "</ p>", "<a b==c>", "<p//>", "<script>", "&#", "<![CDATA[x]]>", "<x y z='<a>'>", "\x00", "</p x>"]


def library(html):
    return tokens._Library(html).tokens


def merged(found):
    """Tokens with neighbouring texts as one: the library may hand them on in pieces."""
    out = []
    for t in found:
        if out and not t.balance and not out[-1].balance:
            out[-1] = out[-1]._replace(text=out[-1].text + t.text)
        else:
            out.append(t)
    return out


@pytest.mark.parametrize("pieces", [TIDY, TIDY * 4 + ODD])
def test_tokens_like_the_library(pieces):
    random.seed(len(pieces))
    regular = 0
    for _ in range(4000):
        html = "".join(random.choices(pieces, k=random.randint(0, 12)))
        found = tokens._regular(html)
        regular += found is not None
        assert merged(tokens.tokens(html)) == merged(library(html)), html
    assert regular > (3900 if pieces is TIDY else 1000)


class Tags(HTMLParser):
    """Tags with places, as the library tells them."""

    def __init__(self, html):
        super().__init__(convert_charrefs=False)
        self.found = []
        self.lines = [0, *[i + 1 for i, c in enumerate(html) if c == "\n"]]
        self.feed(html)
        self.close()

    def place(self):
        return self.lines[self.getpos()[0] - 1] + self.getpos()[1]

    def handle_starttag(self, tag, attrs):
        self.found.append((tag, True, self.place(), self.place() + len(self.get_starttag_text())))

    def handle_endtag(self, tag):
        self.found.append((tag, False, self.place(), 0))


@pytest.mark.parametrize("pieces", [TIDY, TIDY * 4 + ODD])
def test_anchors_like_the_library(pieces):
    random.seed(9)
    seen = 0
    for _ in range(3000):
        html = "".join(random.choices([*pieces, '<a href="A~N.T.html">T</a>', "<a href='x.htm'> two\nlines </a>", '<a href="x.htm"></a>', '<a href="x.htm"/>'], k=random.randint(1, 9)))
        if "&#" in html:  # at an open reference the library takes all the rest for text, unless it resolves references
            continue
        tags = Tags(html).found
        want = [h[2] for h, f in zip(tags, tags[1:], strict=False) if h[0] == f[0] == "a" and h[1] and not f[1] and h[3] < f[2] and "<" not in html[h[3] : f[2]]]
        assert [a[0] for a in links._anchors(html)] == want, html
        seen += len(want)
    assert seen > 200


def test_text_without_tags():
    assert links.links_to_see(" plain ") == "plain"
    assert links.links_to_see("a &amp;lt; b") == "a < b"
    assert links.links_to_see("List&lt;T&gt; of") == "List of"
    assert links.without_tags("<see cref='x'>a</see><b>c</b><></seek><see\n>") == "<see cref='x'>a</see>c<><see\n>"


def test_titles_and_signatures():
    assert _member_title("Do Method (IThing)") == ("Do", "IThing")
    assert _member_title("Set (x) Property ( I Thing ) Method (B)") == ("Set (x)", "I Thing")
    assert [_member_title(t) for t in ("Do Method IThing", "Method (T)", "Do Event (T)", "Do Method ()", "Do Method(T)", "Do Method (T", "")] == [None] * 7
    assert _signature("System.int  Do(\n a )") == "Do( a )"
    assert _signature("Do( a )") == "Do( a )" and _signature("Name") == "Name" and _signature("") == ""
    assert _signature("List<A,B>[] Do( a )") == "Do( a )"


def test_tree_nests_like_the_tokens():
    def shape(node):
        return [c if not isinstance(c, Node) else (c.tag, shape(c)) for c in node.children]

    assert shape(tree("<p>a<br>b<img/><i/>c<p>d</p>e</x></p>f")) == [("p", ["a", ("br", []), "b", ("img", []), ("i", []), "c", ("p", ["d"]), "e"]), "f"]
