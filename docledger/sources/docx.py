"""A document package as rows: the ledger of its nodes, its assets, what it holds, and what went wrong.

The ledger lists nodes in pre-order over all parts. Rules are tables from element names to methods: BLOCKS for what
stands in a body, a cell or a note, INLINE for what stands in a paragraph. What no rule names is kept as an unsupported
node if it shows text; nothing that shows text is passed over in silence.

Where a package would give the same node twice, as an image inside a text box does, it is given once.
"""

from __future__ import annotations

import hashlib
import mimetypes
from pathlib import PurePosixPath

from docledger import ids
from docledger.functions.media import EXTENSIONS
from docledger.sources import messages, omml
from docledger.sources.opc import Finding, Package
from docledger.sources.xmltree import DGM, MC, WP, A, C, Element, M, R, V, W, branch, effective, is_alternate, parse


def integer(text: str | None) -> int | None:
    try:
        return int(text)
    except (TypeError, ValueError):
        return None


class Styles:
    """Facts of paragraph styles, each from the nearest style that states it."""

    FACTS = ("name", "outline_level", "num_id", "list_level")

    def __init__(self, package: Package):
        self.own: dict[str, dict] = {}
        root = _optional(package, "word/styles.xml")
        for s in (e for e in root.iter() if e.uri == W and e.name == "style") if root is not None else ():
            if s.get("type", W) != "paragraph" or not s.get("styleId", W):
                continue
            self.own[s.get("styleId", W)] = {
                "name": _value(s.down("name")) or None,
                "based_on": _value(s.down("basedOn")),
                "outline_level": integer(_value(s.down("pPr", "outlineLvl"))),
                "num_id": _value(s.down("pPr", "numPr", "numId")),
                "list_level": integer(_value(s.down("pPr", "numPr", "ilvl"))),
            }

    def facts(self, style_id: str | None) -> dict:
        out, seen = dict.fromkeys(self.FACTS), set()
        while style_id in self.own and style_id not in seen:
            seen.add(style_id)
            for fact in self.FACTS:
                if out[fact] is None:
                    out[fact] = self.own[style_id][fact]
            style_id = self.own[style_id]["based_on"]
        return out


class Numbering:
    """Facts of list levels by number and level, with what numbers override."""

    def __init__(self, package: Package):
        self.levels: dict[str, dict[int, dict]] = {}
        root = _optional(package, "word/numbering.xml")
        if root is None:
            return
        abstract = {a.get("abstractNumId", W): {integer(x.get("ilvl", W)): self._level(x) for x in a.all("lvl")} for a in root.all("abstractNum")}
        for n in root.all("num"):
            base = _value(n.down("abstractNumId"))
            if n.get("numId", W) is None or base is None:
                continue
            levels = {k: dict(v) for k, v in abstract.get(base, {}).items() if k is not None}
            for o in n.all("lvlOverride"):
                at, start = integer(o.get("ilvl", W)), o.down("startOverride")
                if at is not None and start is not None:
                    levels.setdefault(at, {})["start"] = integer(start.val())
            self.levels[n.get("numId", W)] = levels

    @staticmethod
    def _level(x: Element) -> dict:
        form, start = _value(x.down("numFmt")), x.down("start")
        return {"num_fmt": form, "ordered": form not in (None, "bullet", "none"), "marker_template": _value(x.down("lvlText")), "start": 1 if start is None else integer(start.val())}

    def facts(self, num_id: str | None, level: int | None) -> dict | None:
        """None if there is no number, or number 0, which takes a paragraph out of lists."""
        if num_id is None or num_id == "0":
            return None
        return {"num_id": num_id, "ilvl": level or 0, **self.levels.get(num_id, {}).get(level or 0, {})}


def _value(e: Element | None) -> str | None:
    return None if e is None else e.val()


def _optional(package: Package, name: str) -> Element | None:
    try:
        return package.xml(name) if package.has(name) else None
    except ValueError:
        return None


#: File endings of spreadsheets.
WORKBOOKS = (".xls", ".xlsb", ".xlsm", ".xlsx")


def chart_facts(package: Package, part: str, rid: str) -> tuple[dict, list[Finding]]:
    """What a chart's part says of it; its workbook is named, never opened, and nothing is fetched."""
    found: list[Finding] = []
    out = {"owning_part_name": part, "relationship_id": rid, "chart_part_name": None, "raw_xml_sha256": None, "chart_types": [], "title": None, "series": [], "embedded_workbook_parts": []}

    def note(code, message, where=part, r=rid):
        found.append(Finding(code, "warning", message, where, r))

    relation = _rels(package, part).get(rid)
    if relation is None:
        note("MISSING_CHART_RELATIONSHIP", messages.CHART_UNDECLARED)
        return out, found
    if not relation.type.endswith("/chart"):
        note("NON_CHART_RELATIONSHIP", messages.CHART_TYPE)
    at, outside = package.resolve(part, rid)
    if outside:
        note("EXTERNAL_CHART_NOT_FETCHED", messages.CHART_EXTERNAL)
    elif not at:
        note("UNRESOLVED_CHART_RELATIONSHIP", messages.CHART_UNRESOLVED)
    if not at:
        return out, found
    data = package.read(at)
    out |= {"chart_part_name": at, "raw_xml_sha256": hashlib.sha256(data).hexdigest()}
    try:
        root = parse(data)
    except ValueError as e:
        note("INVALID_CHART_XML", str(e), at, None)
        return out, found
    if (root.uri, root.name) != (C, "chartSpace"):
        note("UNEXPECTED_CHART_ROOT", messages.CHART_ROOT, at, None)

    def inner(e: Element | None, name: str) -> Element | None:
        return None if e is None else next((x for x in e.iter() if x is not e and (x.uri, x.name) == (C, name)), None)

    def text(e: Element | None) -> str | None:
        return None if e is None else "".join(s.strip() for s in e.texts()) or None

    def formula(e: Element | None) -> str | None:
        f = inner(e, "f")
        return (f.text.strip() if f.text else None) if f is not None else None

    def number(e: Element | None) -> int | None:
        return None if e is None else integer(e.get("val"))

    area = inner(root, "plotArea")
    kinds = [e for e in area.children if e.uri == C and e.name.endswith("Chart")] if area is not None else []
    out["chart_types"], out["title"] = [e.name for e in kinds], text(inner(root, "title"))
    out["series"] = [
        {
            "index": number(s.down("idx", uri=C)), "order": number(s.down("order", uri=C)), "name": text(s.down("tx", uri=C)),
            "category_formula": formula(s.down("cat", uri=C)), "value_formula": formula(s.down("val", uri=C)),
        }
        for k in kinds for s in k.all("ser", C)
    ]
    books = set()
    for e in (x for x in root.iter() if x is not root and (x.uri, x.name) == (C, "externalData")):
        r = e.get("id", R)
        if not r:
            note("WORKBOOK_WITHOUT_RELATIONSHIP", messages.BOOK_UNNAMED, at, None)
            continue
        book, outside = package.resolve(at, r)
        if outside:
            note("EXTERNAL_WORKBOOK_NOT_FETCHED", messages.BOOK_EXTERNAL, at, r)
        elif not book:
            note("UNRESOLVED_WORKBOOK_RELATIONSHIP", messages.BOOK_UNRESOLVED, at, r)
        elif "spreadsheetml" in (package.content_type(book) or "") or book.lower().endswith(WORKBOOKS):
            books.add(book)
        else:
            note("UNEXPECTED_WORKBOOK_TARGET", messages.BOOK_TYPE, at, r)
    out["embedded_workbook_parts"] = sorted(books)
    return out, found


class Reader:
    """Reads parts into nodes, assets and diagnostics."""

    def __init__(self, package: Package):
        self.package, self.doc_id = package, ids.doc_id_py(package.data)
        self.styles, self.numbering = Styles(package), Numbering(package)
        self.nodes: list[dict] = []
        self.assets: dict[str, dict] = {}
        self.diagnostics: list[dict] = []
        self._siblings: dict[str | None, int] = {}
        self._known: set[str] = set()
        self._facts: dict[str | None, dict] = {}
        self.part = ""

    # output

    def emit(self, kind: str, e: Element, parent: dict | None, payload: dict, status: str = "extracted", rid: str | None = None) -> dict | None:
        """A node, or None if there is one of this kind at this place."""
        node_id = self._named(e.path, kind)
        if node_id in self._known:
            return None
        self._known.add(node_id)
        above = parent["node_id"] if parent else None
        node = {
            "node_id": node_id, "sequence": len(self.nodes), "parent_id": above, "sibling_index": self._siblings.get(above, 0), "kind": kind, "part_name": self.part,
            "xml_path": e.path, "relationship_id": rid, "payload": payload, "status": status, "ancestors": [*parent["ancestors"], parent["sequence"]] if parent else [],
        }
        self._siblings[above] = node["sibling_index"] + 1
        self.nodes.append(node)
        return node

    def note(self, code: str, severity: str, message: str, node: dict | None = None, part: str | None = None) -> None:
        self.diagnostics.append({"code": code, "severity": severity, "message": message, "part_name": part or self.part, "xml_path": node["xml_path"] if node else None, "relationship_id": None, "source_node_id": node["node_id"] if node else None})

    def unsupported(self, e: Element, parent: dict, payload: dict, code: str, message: str, severity: str = "warning") -> None:
        if node := self.emit("unsupported", e, parent, payload, "unsupported"):
            self.note(code, severity, message, node)

    # parts

    #: Kinds of the roots of parts, by how their names begin.
    ROOTS = (("document.xml", "document_body"), ("header", "header"), ("footer", "footer"), ("footnotes.xml", "footnote"), ("endnotes.xml", "endnote"), ("comments.xml", "comment"))

    def read(self, parts: list[str]) -> None:
        for self.part in parts:
            self._named = ids.node_ids_py(self.doc_id, self.part)
            if not self.package.has(self.part):
                self.note("MISSING_CONFIGURED_PART", "warning", messages.ABSENT_PART.format(self.part))
                continue
            try:
                root = self.package.xml(self.part)
            except Exception as e:  # a broken member is a finding, not the end of the document
                self.note("INVALID_XML_PART", "error", messages.UNPARSED.format(self.part, e))
                continue
            name = PurePosixPath(self.part).name
            kind = next((k for start, k in self.ROOTS if name == start or (not start.endswith(".xml") and name.startswith(start))), "part")
            node = self.emit(kind, root, None, {"part_name": self.part})
            if kind == "document_body":
                body = root.down("body") if (root.uri, root.name) == (W, "document") else None
                if body is None:
                    self.note("MISSING_DOCUMENT_BODY", "error", messages.NO_BODY, node)
                    continue
                root = body
            self.blocks(root.children, node)

    # blocks

    def blocks(self, elements: list[Element], parent: dict) -> None:
        for e in elements:
            if is_alternate(e):
                self.alternate(e, parent, self.blocks)
            elif rule := self.BLOCKS.get(e.name):
                rule(self, e, parent)
            elif e.name not in ("proofErr", "permStart", "permEnd"):
                shown = sum(1 for x in e.iter() if x is not e and (x.uri, x.name) == (W, "t"))
                self.unsupported(e, parent, {"feature_type": e.name, "visible_text_nodes": shown}, "UNSUPPORTED_BLOCK_ELEMENT", messages.BLOCK.format(e.name), "warning" if shown else "info")

    def alternate(self, e: Element, parent: dict, go_on) -> None:
        chosen = branch(e)
        if chosen is None:
            self.unsupported(e, parent, {"feature_type": "markup_compatibility_alternate_content"}, "UNSUPPORTED_MARKUP_COMPATIBILITY_BRANCH", messages.ALTERNATE)
        else:
            go_on(chosen.children, parent)

    def paragraph(self, e: Element, parent: dict) -> None:
        style = _value(e.down("pPr", "pStyle"))
        facts = self._facts.get(style)
        if facts is None:
            facts = self._facts[style] = self.styles.facts(style)
        number, level = e.down("pPr", "numPr", "numId"), e.down("pPr", "numPr", "ilvl")
        num_id = facts["num_id"] if number is None else number.val()
        at = facts["list_level"] if level is None else integer(level.val())
        outline = integer(_value(e.down("pPr", "outlineLvl")))
        node = self.emit("paragraph", e, parent, {
            "style_id": style, "style_name": facts["name"], "num_id": num_id, "list_level": at, "outline_level": facts["outline_level"] if outline is None else outline, "numbering": self.numbering.facts(num_id, at),
        })
        for c in e.children if node else ():
            if c.name == "pPr":
                if (end := c.down("sectPr")) is not None:
                    self.emit("section_break", end, node, {})
            else:
                self.inline([c], node, {})

    def table(self, e: Element, parent: dict) -> None:
        grid = e.down("tblGrid")
        table = self.emit("table", e, parent, {"grid_column_count": len(grid.all("gridCol")) if grid is not None else 0})
        for r, row in enumerate(c for c in e.children if c.name == "tr") if table else ():
            line = self.emit("table_row", row, table, {"row_index": r, "is_header": row.down("trPr", "tblHeader") is not None})
            column = 0
            for cell in (c for c in row.children if c.name == "tc"):
                span = integer(_value(cell.down("tcPr", "gridSpan"))) or 1
                merge = cell.down("tcPr", "vMerge")
                box = self.emit("table_cell", cell, line, {"row_index": r, "column_index": column, "column_span": span, "vertical_merge": (merge.val() or "continue") if merge is not None else None})
                self.blocks([c for c in cell.children if c.name != "tcPr"], box)
                column += span

    def control(self, e: Element, parent: dict, inline: bool = False) -> None:
        gallery = _value(e.down("sdtPr", "docPartObj", "docPartGallery")) or ""
        node = self.emit("content_control", e, parent, {"alias": _value(e.down("sdtPr", "alias")), "tag": _value(e.down("sdtPr", "tag")), "is_toc": "table of contents" in gallery.lower(), "inline": inline})
        for content in e.all("sdtContent") if node else ():
            if inline:
                self.inline(content.children, node, {})
            else:
                self.blocks(content.children, node)

    def note_item(self, e: Element, parent: dict) -> None:
        node = self.emit(e.name, e, parent, {"reference_id": e.get("id", W)})
        self.blocks(e.children if node else [], node)

    def bookmark(self, e: Element, parent: dict, *_) -> None:
        self.emit("bookmark", e, parent, {"marker": e.name, "bookmark_id": e.get("id", W), "name": e.get("name", W)})

    def section_end(self, e: Element, parent: dict) -> None:
        self.emit("section_break", e, parent, {})

    # inline

    def inline(self, elements: list[Element], parent: dict, look: dict) -> None:
        for e in elements:
            if is_alternate(e):
                self.alternate(e, parent, lambda found, above: self.inline(found, above, look))
            elif rule := self.INLINE.get(e.name):
                rule(self, e, parent, look)
            elif e.name.endswith("Pr") or e.name in ("noBreakHyphen", "softHyphen", "sym"):
                continue
            elif e.children:  # wrappers such as tracked changes and smart tags
                self.inline(e.children, parent, look)
            elif e.text.strip() and e.name not in ("smartTag", "customXml", "ins", "del", "moveFrom", "moveTo"):
                self.unsupported(e, parent, {"feature_type": e.name, "text": e.text}, "UNSUPPORTED_INLINE_ELEMENT", messages.INLINE.format(e.name))

    def run(self, e: Element, parent: dict, _) -> None:
        p = e.down("rPr")
        look = {}
        if p is not None:
            look = {name: p.down(tag) is not None for name, tag in (("bold", "b"), ("italic", "i"), ("underline", "u"), ("strikethrough", "strike"))}
            look |= {"vertical_align": _value(p.down("vertAlign")), "color": _value(p.down("color")), "size_half_points": integer(_value(p.down("sz"))), "language": _value(p.down("lang"))}
        self.inline([c for c in e.children if c.name != "rPr"], parent, look)

    def text(self, e: Element, parent: dict, look: dict) -> None:
        self.emit("text_run", e, parent, {"text": e.text, "formatting": look, "deleted": e.name == "delText"})

    def link(self, e: Element, parent: dict, _) -> None:
        rid = e.get("id", R)
        inside, outside = self.package.resolve(self.part, rid)
        node = self.emit("hyperlink", e, parent, {"relationship_id": rid, "url": outside, "target_part": inside, "anchor": e.get("anchor", W)})
        self.inline(e.children if node else [], node, {})

    def equation(self, e: Element, parent: dict, _) -> None:
        display, error = e.name == "oMathPara", None
        found = []
        try:
            found = [x for x in (omml.latex(c).strip() for c in (e.all("oMath", M) if display else [e])) if x]
        except (RecursionError, ValueError) as x:
            error = str(x)
        written = " ".join(found) or None
        node = self.emit("equation", e, parent, {"latex": written, "display": display, "raw_omml": e.xml()}, "extracted" if written else "failed")
        if node and written is None:
            self.note("EQUATION_CONVERSION_FAILED", "error", error or messages.NO_LATEX, node)

    def line_end(self, e: Element, parent: dict, _) -> None:
        kind = e.get("type", W) or "line"
        self.emit("page_break" if kind == "page" else "line_break", e, parent, {"break_type": kind})

    def rendered(self, e: Element, parent: dict, _) -> None:
        self.emit("page_break", e, parent, {"rendered": True})

    def tab(self, e: Element, parent: dict, _) -> None:
        self.emit("tab", e, parent, {})

    def field(self, e: Element, parent: dict, look: dict) -> None:
        node = self.emit("field", e, parent, {"field_type": e.name, "instruction": e.text.strip() or e.get("instr", W), "marker": e.get("fldCharType", W)})
        if node and e.name == "fldSimple":
            self.inline(e.children, node, look)

    def reference(self, e: Element, parent: dict, _) -> None:
        self.emit("field", e, parent, {"field_type": e.name, "reference_id": e.get("id", W)})

    def inline_control(self, e: Element, parent: dict, _) -> None:
        self.control(e, parent, inline=True)

    # drawings

    def text_box(self, e: Element, parent: dict, facts: dict) -> bool:
        node = self.emit("text_box", e, parent, facts)
        if node:
            self.blocks(e.children, node)
        return node is not None

    def bare_text_box(self, e: Element, parent: dict, _) -> None:
        self.text_box(e, parent, {"placement": "drawingml"})

    def image(self, e: Element, parent: dict, rid: str | None, linked: bool, facts: dict) -> None:
        inside, outside = self.package.resolve(self.part, rid)
        asset, status = None, "extracted"
        if inside:
            asset = self.asset(inside)
        else:
            status = "unsupported" if linked or outside else "failed"
        node = self.emit("image", e, parent, {"relationship_id": rid, "target_part": inside, "external_url": outside, "linked": linked, "asset_id": asset, **facts}, status, rid)
        if node and asset is None:
            self.note("UNRESOLVED_IMAGE_RELATIONSHIP", "warning" if linked else "error", messages.IMAGE.format(rid), node)

    def asset(self, part: str) -> str:
        data = self.package.read(part)
        asset_id = ids.asset_id_py(data)
        name = PurePosixPath(part).name
        kind = self.package.content_type(part) or mimetypes.guess_type(name)[0] or "application/octet-stream"
        found = self.assets.setdefault(asset_id, {"asset_id": asset_id, "sha256": asset_id[6:], "mime_type": kind, "original_name": name, "byte_size": len(data), "source_parts": [], "extension": EXTENSIONS.get(kind) or PurePosixPath(name).suffix or mimetypes.guess_extension(kind) or ".bin", "data": data})
        if part not in found["source_parts"]:
            found["source_parts"] = sorted([*found["source_parts"], part])
        return asset_id

    def drawing(self, e: Element, parent: dict, _) -> None:
        shown = list(effective(e))
        facts: dict = {"placement": "anchor" if any((x.uri, x.name) == (WP, "anchor") for x in shown) else "inline"}
        size = next((x for x in shown if (x.uri, x.name) == (WP, "extent")), None)
        told = next((x for x in shown if (x.uri, x.name) == (WP, "docPr")), None)
        if size is not None:
            facts |= {"width_emu": integer(size.get("cx")), "height_emu": integer(size.get("cy"))}
        if told is not None:
            facts |= {"name": told.get("name"), "title": told.get("title"), "alt_text": told.get("descr")}
        count = 0
        for x in (x for x in shown if (x.uri, x.name) == (A, "blip")):
            self.image(x, parent, x.get("embed", R) or x.get("link", R), x.get("link", R) is not None, facts)
            count += 1
        for x in (x for x in shown if (x.uri, x.name) == (C, "chart")):
            self.chart(x, parent, facts)
            count += 1
        for x in (x for x in shown if (x.uri, x.name) == (W, "txbxContent")):
            count += self.text_box(x, parent, facts)
        if not count:
            self.unsupported(e, parent, {"feature_type": "drawing", **facts}, "UNSUPPORTED_DRAWING", messages.DRAWING)

    def chart(self, e: Element, parent: dict, facts: dict) -> None:
        rid = e.get("id", R)
        inside, outside = self.package.resolve(self.part, rid)
        more, found = chart_facts(self.package, self.part, rid) if rid else ({}, [])
        node = self.emit("chart", e, parent, {"relationship_id": rid, "target_part": inside, "external_url": outside, **facts, **more})
        for f in found if node else ():
            self.note(f.code, f.severity, f.message, node, f.part_name)

    def picture(self, e: Element, parent: dict, _) -> None:
        count = 0
        for x in e.iter():
            if (x.uri, x.name) == (V, "imagedata"):
                self.image(x, parent, x.get("id", R), False, {"placement": "vml"})
                count += 1
            elif (x.uri, x.name) == (W, "txbxContent"):
                count += self.text_box(x, parent, {"placement": "vml"})
        if not count:
            self.unsupported(e, parent, {"feature_type": "vml_picture"}, "UNSUPPORTED_VML_CONTENT", messages.VML)

    BLOCKS = {"p": paragraph, "tbl": table, "sdt": control, "footnote": note_item, "endnote": note_item, "comment": note_item, "sectPr": section_end, "bookmarkStart": bookmark, "bookmarkEnd": bookmark}
    INLINE = {
        "r": run, "t": text, "delText": text, "hyperlink": link, "oMath": equation, "oMathPara": equation, "drawing": drawing, "pict": picture, "txbxContent": bare_text_box, "br": line_end, "cr": line_end,
        "tab": tab, "instrText": field, "fldChar": field, "fldSimple": field, "sdt": inline_control, "bookmarkStart": bookmark, "bookmarkEnd": bookmark, "lastRenderedPageBreak": rendered,
        "commentReference": reference, "footnoteReference": reference, "endnoteReference": reference,
    }


#: Features counted by element, apart from text, images, charts and links, which carry more.
COUNTED = {
    (W, "p"): "paragraphs",
    (W, "tbl"): "tables",
    (W, "drawing"): "drawings",
    (M, "oMath"): "equations",
    (W, "txbxContent"): "textboxes",
    (W, "sdt"): "structured_document_tags",
}
#: Elements of the word namespace that are known but not read, and those that a body may hold.
UNREAD = ("altChunk", "smartTag", "customXml", "object", "pict")
IN_BODY = ("p", "tbl", "sdt", "sectPr", "customXml", "altChunk")


def inventory(package: Package, parts: list[str]) -> tuple[list[dict], list[Finding]]:
    """What the parts hold, counted apart from the reading of them: feature, part_name, xml_path, value, relationship_id, target_part."""
    rows: list[dict] = []
    found: list[Finding] = []
    for part in sorted(set(parts)):
        try:
            root = package.xml(part)
        except (KeyError, ValueError) as e:
            found.append(Finding("UNREADABLE_XML_PART", "warning", str(e), part))
            continue

        def row(feature, e, value=None, rid=None, target=None, part=part):
            rows.append({"feature": feature, "part_name": part, "xml_path": e.path, "value": value, "relationship_id": rid, "target_part": target})

        for e in effective(root):
            key = e.key
            if key == (W, "t") and not e.deleted:
                row("visible_text_nodes", e, e.text)
                row("visible_text_chars", e, len(e.text))
            elif key in COUNTED:
                row(COUNTED[key], e)
            elif key in ((A, "blip"), (V, "imagedata")):
                rid = e.get("embed", R) or e.get("link", R) or e.get("id", R)
                inside, outside = package.resolve(part, rid)
                row("image_blips", e, None, rid, inside)
                if not rid:
                    found.append(Finding("IMAGE_WITHOUT_RELATIONSHIP", "warning", messages.NO_IMAGE_RELATIONSHIP, part))
                elif inside is None and not outside:
                    found.append(Finding("UNRESOLVED_IMAGE_RELATIONSHIP", "warning", messages.UNRESOLVED.format(rid), part, rid))
            elif key == (W, "hyperlink"):
                row("hyperlinks", e, None, e.get("id", R))
            elif key == (C, "chart"):
                row("charts", e, None, e.get("id", R), package.resolve(part, e.get("id", R))[0])
            elif e.uri == DGM or (e.uri == W and e.name in UNREAD):
                row("unsupported_features", e, e.path.rsplit("/", 1)[1].split("[")[0])
            elif e.inside == (W, "body") and (e.uri != W or e.name not in IN_BODY):
                row("unknown_features", e, e.path.rsplit("/", 1)[1].split("[")[0])
            if key in ((W, "instrText"), (W, "fldSimple")):
                told = e.text if e.name == "instrText" else e.get("instr", W) or ""
                if "HYPERLINK" in told.upper():
                    row("field_hyperlinks", e)
    rows.sort(key=lambda r: (r["part_name"], r["xml_path"], r["feature"], r["relationship_id"] or ""))
    return rows, sorted(found, key=lambda f: (f.part_name or "", f.code, f.relationship_id or ""))


def read_package(data: bytes, filename: str, *, headers: bool = True, notes: bool = True, comments: bool = True) -> dict:
    """Everything about one package as plain rows. ValueError if it is none."""
    package = Package(data, filename)
    early = package.preflight()
    parts = package.part_names(headers=headers, notes=notes, comments=comments)
    held, noted = inventory(package, parts)
    reader = Reader(package)
    reader.read(parts)
    told = [{"code": f.code, "severity": f.severity, "message": f.message, "part_name": f.part_name, "xml_path": None, "relationship_id": f.relationship_id, "source_node_id": None} for f in [*early, *noted]]
    first = {}
    for d in [*told, *reader.diagnostics]:
        first.setdefault((d["code"], d["message"], d["part_name"], d["relationship_id"]), d)
    ends = [n["sequence"] for n in reader.nodes]
    for n in reversed(reader.nodes):
        if n["ancestors"]:
            ends[n["ancestors"][-1]] = max(ends[n["ancestors"][-1]], ends[n["sequence"]])
    for n, end in zip(reader.nodes, ends, strict=True):
        n["subtree_end"] = end
    try:
        kinds = package.content_types
    except (KeyError, ValueError):
        kinds = {}
    return {
        "doc_id": reader.doc_id, "filename": filename, "sha256": package.sha256, "nodes": reader.nodes, "assets": [reader.assets[k] for k in sorted(reader.assets)],
        "inventory": held, "diagnostics": list(first.values()), "parts": [{"part_name": p, "content_type": kinds.get(p) or None, "relationship_count": len(_rels(package, p))} for p in parts],
        "relationships": [{"source_part": p, "relationship_id": r.relationship_id, "type": r.type, "target": r.target, "mode": r.mode, "target_part": r.target_part, "external_url": r.external_url, "error": r.error} for p in parts for r in _rels(package, p).values()],
    }


def _rels(package: Package, part: str) -> dict:
    try:
        return package.relationships(part)
    except ValueError:
        return {}


__all__ = ["MC", "Numbering", "Reader", "Styles", "chart_facts", "inventory", "read_package"]
