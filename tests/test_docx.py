"""Packages read into ledgers."""

import io
import zipfile

import pytest
from docledger.sources import opc, xmltree
from docledger.sources.docx import read_package
from docledger.sources.xmltree import R

from tests.docx_factory import IMAGE, NUMBERS, PNG, STYLES, blip, box, drawing, image, numbered, p, package, part, rels, t, tbl

PICTURE = [("rId1", *IMAGE, "")]


def read(data, **policy):
    return read_package(data, "x.docx", **policy)


def kinds(found):
    return [n["kind"] for n in found["nodes"]]


def codes(found):
    return [d["code"] for d in found["diagnostics"]]


def shown(found):
    return "".join(n["payload"]["text"] for n in found["nodes"] if n["kind"] == "text_run" and not n["payload"]["deleted"])


def counted(found, feature):
    return sum(1 for o in found["inventory"] if o["feature"] == feature)


def test_order_of_text_images_and_equations_and_one_asset_for_two_occurrences():
    body = p(t("alpha ") + image() + t(" beta ") + image() + "<m:oMath><m:r><m:t>x</m:t></m:r></m:oMath>" + t(" gamma"))
    found = read(package(body, {"word/media/a.png": PNG}, PICTURE))
    assert kinds(found) == ["document_body", "paragraph", "text_run", "image", "text_run", "image", "equation", "text_run"]
    assert len(found["assets"]) == 1 and found["assets"][0]["source_parts"] == ["word/media/a.png"] and found["assets"][0]["extension"] == ".png"
    picture = found["nodes"][3]["payload"]
    assert (picture["width_emu"], picture["height_emu"], picture["alt_text"], picture["placement"]) == (10, 20, "alt", "inline")
    assert found["nodes"][6]["payload"]["latex"] == "x" and not codes(found)
    assert read(package(body, {"word/media/a.png": PNG}, PICTURE)) == found


def test_ledger_is_dense_and_paths_are_canonical():
    found = read(package(p(t("a")) + tbl(["c"]) + p(t("b"))))
    nodes = found["nodes"]
    assert [n["sequence"] for n in nodes] == list(range(len(nodes)))
    by_parent = {}
    for n in nodes:
        by_parent.setdefault(n["parent_id"], []).append(n["sibling_index"])
    assert all(v == list(range(len(v))) for v in by_parent.values())
    assert nodes[0]["xml_path"] == "/w:document" and nodes[-1]["xml_path"] == "/w:document/w:body[1]/w:p[2]/w:r[1]/w:t[1]"
    table = next(n for n in nodes if n["kind"] == "table")
    assert nodes[table["subtree_end"]]["payload"]["text"] == "c" and kinds(found)[3:8] == ["table", "table_row", "table_cell", "paragraph", "text_run"]


def test_styles_numbering_and_circles():
    body = p(t("One"), '<w:pStyle w:val="Heading1"/>') + p(t("Three"), '<w:pStyle w:val="Heading3"/>') + numbered("i", 5, 0) + numbered("ii", 5, 1) + numbered("none", 0, 0)
    found = read(package(body, {"word/styles.xml": STYLES, "word/numbering.xml": NUMBERS}))
    facts = [n["payload"] for n in found["nodes"] if n["kind"] == "paragraph"]
    assert (facts[0]["style_name"], facts[0]["outline_level"], facts[1]["style_name"], facts[1]["outline_level"]) == ("heading 1", 0, "heading 3", 2)
    assert facts[2]["numbering"] == {"num_id": "5", "ilvl": 0, "num_fmt": "decimal", "ordered": True, "marker_template": "%1.", "start": 9}
    assert facts[3]["numbering"]["ordered"] is False and facts[4]["numbering"] is None and facts[4]["num_id"] == "0"


def test_links_fields_breaks_and_tracked_changes():
    body = p(
        f'<w:hyperlink r:id="rId9" w:anchor="z">{t("link")}</w:hyperlink><w:fldSimple w:instr=" HYPERLINK x ">{t("f")}</w:fldSimple><w:r><w:br/><w:br w:type="page"/><w:tab/><w:lastRenderedPageBreak/></w:r>'
        f'<w:ins>{t("new")}</w:ins><w:del><w:r><w:delText>old</w:delText></w:r></w:del><w:bookmarkStart w:id="1" w:name="b"/><w:r><w:footnoteReference w:id="2"/><w:instrText>HYPERLINK y</w:instrText><w:sym/></w:r>'
    )
    found = read(package(body, relationships=[("rId9", f"{R}/hyperlink", "http://example.org/", ' TargetMode="External"')]))
    assert kinds(found)[2:] == ["hyperlink", "text_run", "field", "text_run", "line_break", "page_break", "tab", "page_break", "text_run", "text_run", "bookmark", "field", "field"]
    assert found["nodes"][2]["payload"]["url"] == "http://example.org/" and shown(found) == "linkfnew"
    assert counted(found, "field_hyperlinks") == 2 and counted(found, "visible_text_nodes") == 3


def test_controls_boxes_and_alternate_content():
    sdt = "<w:sdt><w:sdtPr><w:alias w:val='A'/><w:docPartObj><w:docPartGallery w:val='Table of Contents'/></w:docPartObj></w:sdtPr><w:sdtContent>{}</w:sdtContent></w:sdt>"
    choice = "<mc:AlternateContent><mc:Choice Requires='{}'>{}</mc:Choice>{}</mc:AlternateContent>"
    found = read(package(p(t("before ") + sdt.format(t("inside")) + t(" after")) + sdt.format(p(t("toc")))))
    assert shown(found) == "before inside aftertoc" and [n["payload"]["is_toc"] for n in found["nodes"] if n["kind"] == "content_control"] == [True, True]
    found = read(package(choice.format("wps", p(t("new")), f"<mc:Fallback>{p(t('old'))}</mc:Fallback>") + choice.format("zz", p(t("no")), "")))
    assert shown(found) == "new" and codes(found) == ["UNSUPPORTED_MARKUP_COMPATIBILITY_BRANCH"]
    found = read(package(p("<w:r>" + choice.format("wps", "<w:drawing><wp:anchor>" + box(p(t("box"))) + "</wp:anchor></w:drawing>", "<mc:Fallback><w:pict><v:shape><v:textbox><w:txbxContent>" + p(t("old")) + "</w:txbxContent></v:textbox></v:shape></w:pict></mc:Fallback>") + "</w:r>")))
    assert kinds(found).count("text_box") == 1 and shown(found) == "box"
    found = read(package(p("<w:r><w:pict><v:shape><v:imagedata r:id='rId1'/></v:shape></w:pict></w:r>"), {"word/media/a.png": PNG}, PICTURE))
    assert [n["payload"]["placement"] for n in found["nodes"] if n["kind"] == "image"] == ["vml"]
    inside = read(package(p(drawing(box(p(image())))), {"word/media/a.png": PNG}, PICTURE))
    assert len({n["node_id"] for n in inside["nodes"]}) == len(inside["nodes"])


def test_unsupported_things_are_kept_and_told():
    found = read(package("<w:altChunk/>" + p("<w:r><w:weird>seen</w:weird><w:drawing/><w:pict/></w:r>") + "<w:proofErr/><w:sectPr/>" + f"<w:customXml>{p(t('x'))}</w:customXml>"))
    assert codes(found) == ["UNSUPPORTED_BLOCK_ELEMENT", "UNSUPPORTED_INLINE_ELEMENT", "UNSUPPORTED_DRAWING", "UNSUPPORTED_VML_CONTENT", "UNSUPPORTED_BLOCK_ELEMENT"]
    assert [d["severity"] for d in found["diagnostics"]] == ["info", "warning", "warning", "warning", "warning"]
    assert counted(found, "unsupported_features") == 3
    assert codes(read(package(p(image("rId7"))))) == ["UNRESOLVED_IMAGE_RELATIONSHIP", "UNRESOLVED_IMAGE_RELATIONSHIP"]
    assert codes(read(package(p("<m:oMath/>")))) == ["EQUATION_CONVERSION_FAILED"]


def test_other_parts_and_policy():
    members = {
        "word/header1.xml": part("hdr", p(t("H"))), "word/footer1.xml": part("ftr", p(t("F"))), "word/footnotes.xml": part("footnotes", f'<w:footnote w:id="2">{p(t("N"))}</w:footnote>'),
        "word/comments.xml": part("comments", f'<w:comment w:id="1">{p(t("C"))}</w:comment>'), "word/commentsExtended.xml": "<broken",
    }
    found = read(package(p(t("B")), members))
    assert [n["kind"] for n in found["nodes"] if n["parent_id"] is None] == ["document_body", "header", "footer", "footnote", "comment"] and shown(found) == "BHFNC"
    assert "INVALID_XML_PART" in codes(found) and "UNREADABLE_XML_PART" in codes(found)
    assert shown(read(package(p(t("B")), members), headers=False, notes=False, comments=False)) == "B"
    assert codes(read(package(None, {"word/document.xml": part("document", "")}))) == ["MISSING_DOCUMENT_BODY"]


def test_charts_name_their_workbooks_without_opening_them():
    chart = f'<c:chartSpace xmlns:c="{xmltree.C}" xmlns:a="{xmltree.A}" xmlns:r="{R}"><c:chart><c:title><c:tx><c:rich><a:p><a:r><a:t>Sales</a:t></a:r></a:p></c:rich></c:tx></c:title><c:plotArea><c:barChart><c:ser><c:idx val="0"/><c:order val="1"/><c:tx><c:strRef><c:f>S!B1</c:f></c:strRef></c:tx><c:cat><c:strRef><c:f>S!A2</c:f></c:strRef></c:cat><c:val><c:numRef><c:f>S!B2</c:f></c:numRef></c:val></c:ser></c:barChart></c:plotArea></c:chart><c:externalData r:id="rId1"/></c:chartSpace>'
    members = {"word/charts/chart1.xml": chart, "word/charts/_rels/chart1.xml.rels": rels(("rId1", f"{R}/package", "../embeddings/b.xlsx", "")), "word/embeddings/b.xlsx": b"no workbook"}
    found = read(package(p(drawing('<c:chart r:id="rId2"/>')), members, [("rId2", f"{R}/chart", "charts/chart1.xml", "")]))
    facts = next(n["payload"] for n in found["nodes"] if n["kind"] == "chart")
    assert (facts["chart_types"], facts["title"], facts["embedded_workbook_parts"]) == (["barChart"], "Sales", ["word/embeddings/b.xlsx"])
    assert facts["series"] == [{"index": 0, "order": 1, "name": "S!B1", "category_formula": "S!A2", "value_formula": "S!B2"}] and not codes(found)
    assert codes(read(package(p(drawing('<c:chart r:id="rId3"/>'))))) == ["MISSING_CHART_RELATIONSHIP"]


def test_preflight_tells_and_changes_nothing():
    data = package(p(t("x")), relationships=[("rId1", "t", "../../outside.xml", ""), ("rId2", "t", "gone.xml", ""), ("", "t", "document.xml", "")])
    pack = opc.Package(data)
    assert [f.code for f in pack.preflight(sanitize=True)] == ["UNSAFE_RELATIONSHIP_TARGET", "MISSING_RELATIONSHIP_TARGET", "SANITIZATION_NOT_APPLIED"] and pack.data == data
    assert "__missing_id_3" in pack.relationships("word/document.xml")
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z, pytest.warns(UserWarning):
        z.writestr("a.xml", "1")
        z.writestr("a.xml", "2")
    assert [f.code for f in opc.Package(out.getvalue()).preflight()] == ["DUPLICATE_ZIP_MEMBER", "MISSING_CONTENT_TYPES"]
    broken = bytearray(package(p(t("crc crc crc"))))
    at = bytes(broken).index(b"crc crc")
    broken[at] ^= 1
    assert "CORRUPT_ZIP_MEMBER" in [f.code for f in opc.Package(bytes(broken)).preflight()]
    with pytest.raises(ValueError):
        opc.Package(b"no zip")


@pytest.mark.parametrize(
    ("source", "target", "want"),
    [
        ("word/document.xml", "media/a.png", "word/media/a.png"), ("word/document.xml", "./a/../b.xml", "word/b.xml"), (None, "word/document.xml", "word/document.xml"), ("word/document.xml", "../x.xml#f", "x.xml"),
        ("word/document.xml", "../../x", None), ("word/document.xml", "/x", None), ("word/document.xml", "http://x/y", None), ("word/document.xml", "//h/y", None), ("word/document.xml", "", None),
        ("word/document.xml", "a\\b", None), ("word/document.xml", "a\0b", None), ("word/document.xml", "#f", None), ("word/document.xml", "..", None),
    ],
)
def test_targets_in_python_and_in_columns(spark, source, target, want):
    from docledger.functions import values
    from pyspark.sql import functions as F

    if want is None:
        with pytest.raises(ValueError):
            opc.resolve_target(source, target)
    else:
        assert opc.resolve_target(source, target) == want
    frame = spark.createDataFrame([(source or "", target)], "s string, t string")
    assert frame.select(values.target(F.col("s"), F.col("t")).alias("x"), values.relationship_part(F.col("s")).alias("r")).first() == (want, opc.relationships_part(source))


def test_document_types_are_refused():
    with pytest.raises(xmltree.BadXml):
        xmltree.parse(b'<!DOCTYPE a [<!ENTITY x "y">]><a>&x;</a>')
    found = read(package(None, {"word/document.xml": '<!DOCTYPE a [<!ENTITY x "y">]>' + part("document", "<w:body/>").split("?>")[1]}))
    assert codes(found) == ["UNREADABLE_XML_PART", "INVALID_XML_PART"]


@pytest.mark.parametrize(
    ("omml", "want"),
    [
        ("<m:f><m:num><m:r><m:t>a</m:t></m:r></m:num><m:den><m:r><m:t>b</m:t></m:r></m:den></m:f>", r"\frac{a}{b}"),
        ("<m:sSup><m:e><m:r><m:t>x</m:t></m:r></m:e><m:sup><m:r><m:t>2</m:t></m:r></m:sup></m:sSup>", "x^{2}"),
        ("<m:rad><m:deg/><m:e><m:r><m:t>α</m:t></m:r></m:e></m:rad>", r"\sqrt{\alpha }"),
        ("<m:d><m:e><m:r><m:t>x</m:t></m:r></m:e></m:d>", r"\left(x\right)"),
        ("<m:nary><m:naryPr><m:chr m:val='∑'/></m:naryPr><m:sub><m:r><m:t>i</m:t></m:r></m:sub><m:sup/><m:e><m:r><m:t>x</m:t></m:r></m:e></m:nary>", r"\sum_{i}{x}"),
        ("<m:func><m:fName><m:r><m:t>sin</m:t></m:r></m:fName><m:e><m:r><m:t>x</m:t></m:r></m:e></m:func>", r"\sin{x}"),
        ("<m:m><m:mr><m:e><m:r><m:t>a</m:t></m:r></m:e><m:e><m:r><m:t>b</m:t></m:r></m:e></m:mr></m:m>", r"\begin{matrix}a & b\end{matrix}"),
    ],
)
def test_equations(omml, want):
    found = read(package(p(f"<m:oMathPara><m:oMath>{omml}</m:oMath></m:oMathPara>")))
    facts = found["nodes"][2]["payload"]
    assert facts["latex"] == want and facts["display"] and facts["raw_omml"].startswith("<m:oMathPara")


def test_pieces_of_a_run_keep_their_look():
    found = read(package(p('<w:r><w:rPr><w:b w:val="0"/><w:color w:val="FF0000"/><w:sz w:val="24"/></w:rPr><w:t>x</w:t></w:r>' + t("y"))))
    looks = [n["payload"]["formatting"] for n in found["nodes"] if n["kind"] == "text_run"]
    assert (looks[0]["bold"], looks[0]["color"], looks[0]["size_half_points"], looks[1]) == (True, "FF0000", 24, {})
    assert blip() in image()
