"""A small element tree over the tokens of a page, and what reads it.

Unclosed tags stay open until an enclosing end tag closes them, so what follows
an unclosed paragraph is inside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from docweave.sources.tokens import tokens

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class Node:
    """An element: tag, attributes, children (nodes and strings)."""

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, list["Node | str"]()

    def elements(self, *tags: str) -> list[Node]:
        """Direct children of these tags."""
        return [c for c in self.children if isinstance(c, Node) and (not tags or c.tag in tags)]

    def walk(self) -> Iterator[Node]:
        for c in self.elements():
            yield c
            yield from c.walk()

    def find(self, *tags: str) -> list[Node]:
        return [n for n in self.walk() if n.tag in tags]

    def text(self, line_break: str = "") -> str:
        return "".join(c if isinstance(c, str) else line_break if c.tag == "br" else c.text(line_break) for c in self.children)


def tree(html: str) -> Node:
    top = Node("", {})
    opened = [top]
    for balance, tag, text, attrs, empty in tokens(html):
        if not balance:
            opened[-1].children.append(text)
        elif balance > 0:
            node = Node(tag, attrs)
            opened[-1].children.append(node)
            if not empty and tag not in VOID:
                opened.append(node)
        elif not empty:
            at = next((i for i in range(len(opened) - 1, 0, -1) if opened[i].tag == tag), 0)
            if at:
                del opened[at:]
    return top


def _code_lines(node: Node) -> str:
    """Code of a paragraph: line breaks from br, indentation kept, other white space runs one space."""
    out = []
    for line in node.text("\x00").split("\x00"):
        indent = re.match(r"[ \t\xa0\r\n]*", line)[0].replace("\r", "").replace("\n", "")
        body = re.sub(r" +", " ", re.sub(r"[\r\n\t]+", " ", line)).strip()
        out.append(indent + body if body else indent.rstrip())
    return _tidy("\n".join(out))


def _pre_lines(node: Node) -> str:
    """Code of a pre element: its own lines and breaks, inner runs of white space one space."""
    lines = []
    for line in node.text("\n").split("\n"):
        indent = re.match(r"[ \t]*", line)[0]
        lines.append(indent + re.sub(r"[ \t]+", " ", line[len(indent) :]).rstrip())
    return _tidy("\n".join(lines))


def _tidy(text: str) -> str:
    text = re.sub(r" +\n", "\n", text)
    lines = [re.match(r"[ \t]*", x)[0] + re.sub(r" {2,}", " ", x.lstrip(" \t")) for x in text.split("\n")]
    return "\n".join(lines).replace("\xa0", " ").rstrip().lstrip("\n")


def _is_code(node: Node) -> bool:
    return node.tag == "p" and node.attrs.get("class", "").split() == ["APICODE"]


def example_text(html: str) -> str | None:
    """Prose and code of an example page; neighbouring code elements are one <code> run."""
    parts, in_code = list[str](), False
    for node in tree(html).elements("h1", "h2", "h3", "p", "pre", "div"):
        inner = [p for p in node.find("p") if "APICODE" in p.attrs.get("class", "").split()] if node.tag == "div" else []
        code = None
        if _is_code(node):
            code = [_code_lines(node)]
        elif node.tag == "div" and (inner or "Monospace" in node.attrs.get("style", "")):
            code = [_code_lines(p) for p in inner]
        elif node.tag == "pre":
            code = [_pre_lines(node)]
        if (code is not None) != in_code:
            parts.append("</code>" if in_code else "<code>")
            in_code = not in_code
        if code is not None:
            parts += [c for c in code if c]
        elif words := node.text().strip():
            # A source file's name stands off from what comes before.
            parts.append(("\n" if re.search(r"\.(vb|cs|cpp|h|js|py|java)$", words) else "") + words)
    if in_code:
        parts.append("</code>")
    joined = re.sub(r"\n{3,}", "\n\n", "\n".join(parts))
    return "\n".join(line.rstrip() for line in joined.split("\n")).strip() or None


def _type_of(href: str) -> str | None:
    parts = href.rsplit("/", 1)[-1].replace(".html", "").split("~")
    return parts[1] if len(parts) > 1 and parts[1] else None


def _listed(ul: Node, path: str) -> list[tuple[str, str]]:
    out = list[tuple[str, str]]()
    for li in ul.elements("li"):
        nested, div = next(iter(li.elements("ul")), None), next(iter(li.elements("div")), None)
        if nested is None:
            links = div.find("a") if div else li.elements("a")
            out += [(name, path) for a in links if (name := _type_of(a.attrs.get("href", "")))]
            continue
        before = li.children[: li.children.index(nested)]
        own = next((c for c in before if isinstance(c, Node) and c.tag == "a" and c.attrs.get("href")), None)
        if own is not None and (name := _type_of(own.attrs["href"])):
            out.append((name, path))
        link = next((a for a in div.find("a") if a.attrs.get("href")), None) if div else None
        if link is not None and "~" in link.attrs["href"]:
            if name := _type_of(link.attrs["href"]):
                out.append((name, path))
            out += _listed(nested, path)
            continue
        if div is not None:
            words = div.text().strip()
        else:
            words = " ".join(t for c in li.children if c is not nested and (t := (c if isinstance(c, str) else c.text()).strip()))
        out += _listed(nested, f"{path}/{words}" if path else words)
    return out


def category_rows(html: str) -> list[dict]:
    """(ord, category, type_name) of a category page, by heading and then by category."""
    out = list[dict]()

    def visit(node: Node) -> None:
        children = node.elements()
        for i, head in enumerate(children):
            anchor = next(iter(head.find("a")), None) if head.tag == "h4" else None
            if head.tag != "h4" or (anchor is not None and not anchor.attrs.get("name")):
                visit(head)
                continue
            found = list[tuple[str, str]]()
            for after in children[i + 1 :]:
                if after.tag == "h4":
                    break
                if after.tag == "ul":
                    found += _listed(after, head.text().strip())
            grouped: dict[str, list[str]] = {}
            for name, path in found:
                grouped.setdefault(path, []).append(name)
            out.extend({"category": path, "type_name": name} for path, names in grouped.items() for name in names)

    visit(tree(html))
    return [{"ord": i, **row} for i, row in enumerate(out)]


def to_markdown(html: str) -> str:
    """Markdown of a page: headings, paragraphs, lists, links, images, emphasis, code, tables as text."""

    def inline(node: Node | str) -> str:
        if isinstance(node, str):
            return re.sub(r"\s+", " ", node)
        inner = "".join(inline(c) for c in node.children)
        words = inner.strip()
        if node.tag in ("script", "style", "head"):
            return ""
        if node.tag == "br":
            return "  \n"
        if node.tag == "img":
            return f"![{node.attrs.get('alt', '')}]({node.attrs.get('src', '')})"
        if node.tag == "a" and node.attrs.get("href") and words:
            return f"[{words}]({node.attrs['href']})"
        if node.tag in ("b", "strong") and words:
            return f"**{words}**"
        if node.tag in ("i", "em") and words:
            return f"_{words}_"
        if node.tag in ("code", "tt") and words:
            return f"`{words}`"
        return inner

    block = frozenset("html body div section article main header footer nav aside h1 h2 h3 h4 h5 h6 p ul ol li pre blockquote table thead tbody tr hr".split())
    out = list[str]()

    def items(node: Node, depth: int) -> None:
        for i, li in enumerate(node.elements("li"), 1):
            nested = li.elements("ul", "ol")
            words = "".join(inline(c) for c in li.children if c not in nested).strip()
            mark = f"{i}." if node.tag == "ol" else "*"
            out.append(f"{'  ' * depth}{mark} {words}")
            for n in nested:
                items(n, depth + 1)

    def blocks(node: Node) -> None:
        run = list[str]()

        def close() -> None:
            words = "".join(run).strip()
            run.clear()
            if words:
                out.extend([words, ""])

        for child in node.children:
            if isinstance(child, str) or child.tag not in block:
                run.append(inline(child))
                continue
            close()
            if re.fullmatch("h[1-6]", child.tag):
                words = "".join(inline(c) for c in child.children).strip()
                if words:
                    out.extend(["#" * int(child.tag[1]) + " " + words, ""])
            elif child.tag in ("ul", "ol"):
                items(child, 0)
                out.append("")
            elif child.tag == "pre":
                out.extend(["```", child.text("\n").strip("\n"), "```", ""])
            elif child.tag == "hr":
                out.extend(["---", ""])
            elif child.tag == "tr":
                out.extend([" | ".join("".join(inline(c) for c in cell.children).strip() for cell in child.elements("td", "th")), ""])
            else:
                blocks(child)
        close()

    blocks(tree(html))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip() + "\n"
