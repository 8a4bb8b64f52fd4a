"""XML parts as plain trees: no document types, no entities, no network, namespaces and canonical paths kept."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from xml.parsers import expat

#: Namespaces of document packages, and the prefixes that canonical paths write for them.
W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
A = "http://schemas.openxmlformats.org/drawingml/2006/main"
C = "http://schemas.openxmlformats.org/drawingml/2006/chart"
M = "http://schemas.openxmlformats.org/officeDocument/2006/math"
V = "urn:schemas-microsoft-com:vml"
WP = "http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing"
DGM = "http://schemas.openxmlformats.org/drawingml/2006/diagram"
MC = "http://schemas.openxmlformats.org/markup-compatibility/2006"
WPS = "http://schemas.microsoft.com/office/word/2010/wordprocessingShape"
PIC = "http://schemas.openxmlformats.org/drawingml/2006/picture"
RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
PREFIX = {W: "w", R: "r", A: "a", C: "c", M: "m", V: "v", WP: "wp", DGM: "dgm", MC: "mc", WPS: "wps", PIC: "pic"}


#: Fixed value: the element that holds what a tracked change has deleted.
DELETED = (W, "del")


class BadXml(ValueError):
    pass


class Element:
    """An element knows what its parent is called, not its parent: a tree without circles is freed as soon as it is done with."""

    __slots__ = ("uri", "name", "key", "attributes", "text", "tail", "children", "inside", "deleted", "prefixes", "path")

    def __init__(self, key: tuple[str, str], attributes: dict, parent: Element | None, prefixes: dict, path: str):
        self.key = key
        self.uri, self.name = key
        self.attributes, self.prefixes, self.path = attributes, prefixes, path
        self.text = self.tail = ""
        self.children = []
        if parent is None:
            self.inside, self.deleted = None, False
        else:
            self.inside, self.deleted = parent.key, parent.deleted or parent.key == DELETED

    def get(self, name: str, uri: str = "") -> str | None:
        return self.attributes.get((uri, name))

    def val(self, uri: str = W) -> str | None:
        return self.get("val", uri)

    def down(self, *names: str, uri: str = W) -> Element | None:
        """The first element along a path of child names."""
        here = self
        for name in names:
            for c in here.children:
                if c.name == name and c.uri == uri:
                    here = c
                    break
            else:
                return None
        return here

    def all(self, name: str, uri: str = W) -> list[Element]:
        return [c for c in self.children if c.uri == uri and c.name == name]

    def iter(self) -> Iterator[Element]:
        """This element and all below it, in document order."""
        pending = [self]
        while pending:
            e = pending.pop()
            yield e
            pending.extend(reversed(e.children))

    def texts(self) -> Iterator[str]:
        """Pieces of text inside, in document order."""
        if self.text:
            yield self.text
        for c in self.children:
            yield from c.texts()
            if c.tail:
                yield c.tail

    def xml(self) -> str:
        """As XML with the usual prefixes."""

        def escaped(s: str) -> str:
            return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")

        def named(uri: str, name: str) -> str:
            return f"{PREFIX.get(uri, 'ns')}:{name}" if uri else name

        def written(e: Element, known: frozenset) -> str:
            used = {e.uri, *(u for u, _ in e.attributes)} - {""} - known
            spaces = "".join(f' xmlns:{PREFIX.get(u, "ns")}="{escaped(u)}"' for u in sorted(used))
            head = named(e.uri, e.name) + spaces + "".join(f' {named(u, n)}="{escaped(v)}"' for (u, n), v in e.attributes.items())
            inner = escaped(e.text) + "".join(written(c, known | used) + escaped(c.tail) for c in e.children)
            return f"<{head}>{inner}</{named(e.uri, e.name)}>" if inner else f"<{head}/>"

        return written(self, frozenset())


@lru_cache(4096)
def _named(name: str) -> tuple[tuple[str, str], str]:
    """Namespace and local name of what the parser calls an element or attribute, and how canonical paths write it."""
    uri, _, local = name.rpartition(" ")
    return (uri, local), f"{PREFIX.get(uri, 'ns')}:{local}" if uri else local


def parse(data: bytes) -> Element:
    """The root of a well-formed part; anything else, or a document type, is BadXml.

    Canonical paths: an element counts among its siblings of the same written name; the root has no number.
    """
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = parser.ordered_attributes = True
    stack: list[Element] = []
    seen: list[dict] = []  # of each open element, how many children of each written name it has
    root: list[Element] = []
    declared: dict = {}

    def namespace(prefix, uri):
        declared[prefix or ""] = uri or ""

    def start(name, attributes):
        key, written = _named(name)
        facts = {_named(attributes[k])[0]: attributes[k + 1] for k in range(0, len(attributes), 2)} if attributes else {}
        if stack:
            above, counts = stack[-1], seen[-1]
            prefixes = above.prefixes
            if declared:
                prefixes = {**prefixes, **declared}
                declared.clear()
            counts[written] = count = counts.get(written, 0) + 1
            e = Element(key, facts, above, prefixes, f"{above.path}/{written}[{count}]")
            above.children.append(e)
        else:
            e = Element(key, facts, None, {**declared}, "/" + written)
            declared.clear()
            root.append(e)
        stack.append(e)
        seen.append({})

    def end(_):
        stack.pop()
        seen.pop()

    def text(data):
        if stack:
            e = stack[-1]
            if e.children:
                e.children[-1].tail += data
            else:
                e.text += data

    def doctype(*_):
        raise BadXml("a document type is not allowed")

    parser.StartNamespaceDeclHandler, parser.StartElementHandler, parser.EndElementHandler = namespace, start, end
    parser.CharacterDataHandler, parser.StartDoctypeDeclHandler = text, doctype
    try:
        parser.Parse(data, True)
    except expat.ExpatError as e:
        raise BadXml(str(e)) from None
    return root[0]


def branch(alternate: Element) -> Element | None:
    """The choice that can be shown, else the last fallback: all it requires must be text box shapes."""
    back = None
    for c in alternate.children:
        if c.uri == MC and c.name == "Choice":
            needs = (c.get("Requires") or "").split()
            if needs and all(c.prefixes.get(p) == WPS for p in needs):
                return c
        elif c.uri == MC and c.name == "Fallback":
            back = c
    return back


def is_alternate(e: Element) -> bool:
    return e.uri == MC and e.name == "AlternateContent"


def effective(root: Element) -> Iterator[Element]:
    """Elements that are shown: of alternate content only what its branch holds."""
    pending = [root]
    while pending:
        e = pending.pop()
        if is_alternate(e):
            chosen = branch(e)
            pending.extend(reversed(chosen.children if chosen else []))
        else:
            yield e
            pending.extend(reversed(e.children))
