"""Row helper for page extraction: HTML text to an element tree, selectors to elements.

Used inside the extraction tasks only. Pages are parsed by the standard library; the
selectors are those posting sites need. What is not supported fails when rules are loaded.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin
from xml.etree import ElementTree

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset("address article dd div dl dt footer form h1 h2 h3 h4 h5 h6 header li nav ol p section table tr ul".split())
CLOSED_BY = {
    "p": BLOCK - {"li", "dd", "dt", "tr"},
    "li": {"li"},
    "td": {"td", "th", "tr", "tbody"},
    "th": {"td", "th", "tr", "tbody"},
    "tr": {"tr", "tbody"},
    "option": {"option"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
}


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ElementTree.Element("document")
        self.open = [self.root]
        self.count: Counter[str] = Counter()  # open elements by tag

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # as browsers read it: a comment up to the next ">"

    def _close(self, depth: int) -> None:
        self.count.subtract(e.tag for e in self.open[depth:])
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        while tag in CLOSED_BY.get(self.open[-1].tag, ()):
            self._close(len(self.open) - 1)
        if tag == "p":
            self.handle_endtag("p")
        if tag == "tr" and self.open[-1].tag == "table":
            self.handle_starttag("tbody", [])
        element = ElementTree.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in VOID:
            self.open.append(element)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.count[tag] > 0:
            depth = len(self.open) - 1
            while self.open[depth].tag != tag:
                depth -= 1
            self._close(depth)

    def handle_data(self, data):
        parent = self.open[-1]
        if len(parent):
            parent[-1].tail = (parent[-1].tail or "") + data
        else:
            parent.text = (parent.text or "") + data


def read_page(html: str | None) -> ElementTree.Element:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return reader.root


def _walk(element: ElementTree.Element) -> Iterator[tuple[ElementTree.Element, bool]]:
    """Every element twice, when it begins (True) and when it ends, without recursion."""
    stack = [(element, True)]
    while stack:
        e, begins = stack.pop()
        yield e, begins
        if begins:
            stack.append((e, False))
            stack += [(child, True) for child in reversed(e)]


def inner_html(element: ElementTree.Element) -> str:
    parts: list[str] = []
    for e, begins in _walk(element):
        raw = e.tag in ("script", "style")
        if begins:
            if e is not element:
                parts.append(f"<{e.tag}" + "".join(f' {k}="{_escape(v, quote=True)}"' for k, v in e.items()) + ">")
            parts.append((e.text or "") if raw else _escape(e.text))
        elif e is not element:
            parts.append(("" if e.tag in VOID else f"</{e.tag}>") + _escape(e.tail))
    return "".join(parts)


def _escape(text: str | None, quote: bool = False) -> str:
    text = (text or "").replace("&", "&amp;").replace(">", "&gt;")
    return text.replace('"', "&quot;") if quote else text.replace("<", "&lt;")


def visible_text(element: ElementTree.Element) -> str:
    parts: list[str] = []
    hidden = 0
    for e, begins in _walk(element):
        edge = "\n" if e.tag in BLOCK or e.tag == "br" else " " if e.tag in ("td", "th") else ""
        if e.tag in ("script", "style"):
            hidden += 1 if begins else -1
        elif not hidden and (begins or e.tag != "br"):
            parts.append(edge)
        if not hidden and begins:
            parts.append(re.sub(r"\s+", " ", e.text or ""))
        elif not hidden and e is not element:
            parts.append(re.sub(r"\s+", " ", e.tail or ""))
    text = re.sub(r" *\n[ \n]*", "\n", "".join(parts))
    return re.sub(r" +", " ", text).strip()


# --- selectors ---------------------------------------------------------------

_STEP = re.compile(r"""(/{0,2})((?:[^/\[\]]|\[(?:[^\]"']|'[^']*'|"[^"]*")*\])+)""")
_PREDICATE = re.compile(r"""\[((?:[^\]"']|'[^']*'|"[^"]*")*)\]""")
_TEST = re.compile(
    r"""^(?:(?P<not>not\()?(?P<fn>contains|starts-with)\((?P<a1>@[\w-]+|text\(\)|\.),\s*(['"])(?P<v1>.*?)\4\)\)?"""
    r"""|(?P<a2>@[\w-]+|text\(\)|\.)\s*=\s*(['"])(?P<v2>.*?)\7"""
    r"""|(?P<has>@[\w-]+)|not\((?P<hasnot>@[\w*-]+)\))$"""
)
_AXES = ("child", "descendant", "descendant-or-self", "following-sibling", "preceding-sibling", "parent", "self")


def _subjects(name: str) -> Callable[[ElementTree.Element], list[str]]:
    """The texts a test looks at: an attribute, the element's own text nodes, or all its text."""
    if name.startswith("@"):
        return lambda e: [e.get(name[1:])] if name[1:] in e.attrib else []
    if name == "text()":
        return lambda e: [t for t in (e.text, *(child.tail for child in e)) if t]
    return lambda e: ["".join(e.itertext())]


def _condition(text: str) -> Callable:
    for word, combine in ((" or ", any), (" and ", all)):
        parts = re.split(word + r"""(?=(?:[^'"]|'[^']*'|"[^"]*")*$)""", text)
        if len(parts) > 1:
            tests = [_condition(p) for p in parts]
            return lambda e: combine(t(e) for t in tests)
    found = _TEST.match(text.strip())
    if not found:
        raise ValueError(f"unsupported predicate [{text}]")
    if found["has"]:
        return lambda e: found["has"][1:] in e.attrib
    if found["hasnot"]:
        name = found["hasnot"][1:]
        return lambda e: not e.attrib if name == "*" else name not in e.attrib
    read = _subjects(found["a1"] or found["a2"])
    if found["a2"]:
        return lambda e: found["v2"] in read(e)
    check = (lambda v: found["v1"] in v) if found["fn"] == "contains" else (lambda v: v.startswith(found["v1"]))
    return lambda e: any(map(check, read(e)[:1])) != bool(found["not"])


def _predicate(text: str) -> Callable[[list], list]:
    text = text.strip()
    if text == "*":
        return lambda found: [e for e in found if len(e)]
    if text.isdigit():
        return lambda found: found[int(text) - 1:int(text)] if int(text) else []
    last = re.match(r"^last\(\)\s*(?:-\s*(\d+))?$", text)
    if last:
        back = int(last[1] or 0) + 1
        return lambda found: found[-back:len(found) - back + 1] if len(found) >= back else []
    test = _condition(text)
    return lambda found: [e for e in found if test(e)]


def _step(slashes: str, text: str) -> Callable:
    tests = _PREDICATE.findall(text)
    predicates = [_predicate(p) for p in tests]
    by_position = any(p.strip().isdigit() or p.strip().startswith("last()") for p in tests)
    name = _PREDICATE.sub("", text).strip()
    axis, _, node = name.rpartition("::")
    axis = axis or {".": "self", "..": "parent"}.get(node, "child")
    node = None if node in (".", "..", "node()", "*") else node.lower()
    if axis not in _AXES or not re.match(r"^[\w-]+$", node or "any"):
        raise ValueError(f"unsupported step {text!r}")

    def candidates(e, page):
        if axis == "child":
            return e
        if axis.startswith("descendant"):
            return (d for d in e.iter(node) if axis == "descendant-or-self" or d is not e)
        if axis == "self":
            return [e]
        parent = page.parents.get(e)
        if axis == "parent":
            return [] if parent is None else [parent]
        row = [] if parent is None else list(parent)
        at = row.index(e) if row else 0
        return row[at + 1:] if axis == "following-sibling" else row[:at][::-1]

    def groups(context, page):
        """What predicates number through: the hits of one element, or of one parent for ``//``."""
        if slashes == "//" and axis == "child":
            for e in context:
                hits = [d for d in e.iter(node) if d is not e]
                yield from _by_parent(hits, page) if by_position else [hits]
            return
        if slashes == "//":
            context = _ordered(d for e in context for d in e.iter())
        for e in context:
            yield [c for c in candidates(e, page) if node in (None, c.tag)]

    def apply(context, page):
        found = []
        for hits in groups(context, page):
            for predicate in predicates:
                hits = predicate(hits)
            found += hits
        return _ordered(found)

    apply.scatters = slashes == "//" and by_position
    return apply


def _by_parent(elements: list, page) -> list[list]:
    rows: dict = {}
    for e in elements:
        rows.setdefault(page.parents[e], []).append(e)
    return list(rows.values())


def _ordered(elements) -> list:
    return list(dict.fromkeys(elements))


class Selector:
    """One selector; ``find`` gives its elements in page order."""

    def __init__(self, text: str, how: str = "XPATH"):
        if not text or how not in _BY:
            raise ValueError(f"unsupported selector {how} {text!r}")
        self.match = _BY[how](text)
        self.paths = []
        if how == "XPATH":
            for part in re.split(r"""\|(?=(?:[^'"]|'[^']*'|"[^"]*")*$)""", text.replace("%d", "0")):
                part = part.strip()
                steps = _STEP.findall(part)
                if not steps or "".join(a + b for a, b in steps) != part:
                    raise ValueError(f"unsupported selector {text!r}")
                self.paths.append((part.startswith("/"), [_step(*s) for s in steps]))
        # Several paths, and steps that walk backwards or go parent by parent, lose page order.
        backwards = "preceding" in text or "parent" in text or ".." in text
        self.unordered = len(self.paths) > 1 or backwards or any(s.scatters for _, steps in self.paths for s in steps)

    def find(self, page: Page, scope=None) -> list:
        if self.match:
            return [e for e in page.root.iter() if self.match(e)]
        found = []
        for absolute, steps in self.paths:
            context = [page.root if absolute or scope is None else scope]
            for step in steps:
                context = step(context, page)
            found += context
        if self.unordered and len(found) > 1:
            wanted = set(found)
            found = [e for e in page.root.iter() if e in wanted]
        return found


def _css(text: str) -> Callable:
    found = re.match(r"^([\w-]+|\*)?(?:#([\w-]+))?((?:\.[\w-]+)*)$", text)
    if not found:
        raise ValueError(f"unsupported CSS selector {text!r}")
    tag, name, classes = found[1], found[2], set(found[3].split(".")) - {""}
    return lambda e: (
        tag in (None, "*", e.tag) and name in (None, e.get("id")) and classes <= set(e.get("class", "").split())
    )


def _link(test: Callable) -> Callable:
    return lambda text: lambda e: e.tag == "a" and test(text, visible_text(e))


_BY: dict[str, Callable] = {
    "XPATH": lambda text: None,
    "ID": lambda text: lambda e: e.get("id") == text,
    "NAME": lambda text: lambda e: e.get("name") == text,
    "CLASS_NAME": lambda text: lambda e: text in e.get("class", "").split(),
    "TAG_NAME": lambda text: lambda e: e.tag == text.lower(),
    "LINK_TEXT": _link(lambda text, shown: shown == text),
    "PARTIAL_LINK_TEXT": _link(lambda text, shown: text in shown),
    "CSS": _css,
}


@lru_cache(maxsize=4096)
def selector(text: str, how: str = "XPATH") -> Selector:
    return Selector(text, how)


class Page:
    """A parsed page with the lookups that selectors need."""

    def __init__(self, html: str | None):
        self.root = read_page(html)

    def address(self, link: str, url: str | None) -> str:
        """A link as a browser gives it: absolute, seen from the page's address or its base element."""
        try:
            return urljoin(urljoin(url or "", self.base), link.strip())
        except ValueError:  # no address at all
            return link

    @cached_property
    def base(self) -> str:
        return next((e.get("href", "").strip() for e in self.root.iter("base")), "")

    @cached_property
    def parents(self) -> dict:
        return {child: parent for parent in self.root.iter() for child in parent}

    def find(self, text: str, how: str = "XPATH", scope=None, index: int = 0) -> list:
        if how == "XPATH" and index and text.startswith("//") and "%d" in text:
            text = text.replace("%d", str(index))
        return selector(text, how).find(self, scope)
