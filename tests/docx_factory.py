"""Document packages made in code."""

import base64
import io
import zipfile

from docledger.sources.xmltree import MC, RELS, TYPES, WP, WPS, A, C, M, R, V, W

PNG = base64.b64decode("iVBORw0KGgoAAAANSUhEUgAAAAEAAAABCAYAAAAfFcSJAAAADUlEQVR42mNkYPhfDwAChwGA60e6kgAAAABJRU5ErkJggg==")
SPACES = f'xmlns:w="{W}" xmlns:r="{R}" xmlns:a="{A}" xmlns:c="{C}" xmlns:m="{M}" xmlns:v="{V}" xmlns:wp="{WP}" xmlns:mc="{MC}" xmlns:wps="{WPS}"'
DEFAULTS = '<Default Extension="xml" ContentType="application/xml"/><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="png" ContentType="image/png"/>'


def part(root, inner):
    return f'<?xml version="1.0" encoding="UTF-8"?><w:{root} {SPACES}>{inner}</w:{root}>'


def rels(*rows):
    return f'<Relationships xmlns="{RELS}">' + "".join(f'<Relationship Id="{i}" Type="{t}" Target="{to}"{mode}/>' for i, t, to, mode in rows) + "</Relationships>"


IMAGE = (f"{R}/image", "media/a.png")


def package(body, members=None, relationships=(), overrides="", types=True):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        def put(name, data):
            z.writestr(zipfile.ZipInfo(name), data)

        if types:
            put("[Content_Types].xml", f'<Types xmlns="{TYPES}">{DEFAULTS}{overrides}</Types>')
        if body is not None:
            put("word/document.xml", part("document", f"<w:body>{body}</w:body>"))
        if relationships:
            put("word/_rels/document.xml.rels", rels(*relationships))
        for name, data in (members or {}).items():
            put(name, data)
    return out.getvalue()


def t(text):
    return f'<w:r><w:t xml:space="preserve">{text}</w:t></w:r>'


def p(inner, props=""):
    return f"<w:p>{f'<w:pPr>{props}</w:pPr>' if props else ''}{inner}</w:p>"


def numbered(text, num, level):
    return p(t(text), f'<w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{num}"/></w:numPr>')


def tbl(*rows, grid=True):
    n = max(len(r) for r in rows)
    cells = "".join("<w:tr>" + "".join(f"<w:tc>{p(t(c))}</w:tc>" for c in r) + "</w:tr>" for r in rows)
    return "<w:tbl>" + ("<w:tblGrid>" + "<w:gridCol/>" * n + "</w:tblGrid>" if grid else "") + cells + "</w:tbl>"


def drawing(inner):
    return f'<w:r><w:drawing><wp:inline><wp:extent cx="10" cy="20"/><wp:docPr id="1" name="n" descr="alt"/>{inner}</wp:inline></w:drawing></w:r>'


def blip(rid="rId1"):
    return f'<a:graphic><a:blip r:embed="{rid}"/></a:graphic>'


def image(rid="rId1"):
    return drawing(blip(rid))


def box(inner):
    return f"<wps:txbx><w:txbxContent>{inner}</w:txbxContent></wps:txbx>"


STYLES = part(
    "styles",
    '<w:style w:type="paragraph" w:styleId="Heading1"><w:name w:val="heading 1"/><w:pPr><w:outlineLvl w:val="0"/></w:pPr></w:style>'
    '<w:style w:type="paragraph" w:styleId="Heading3"><w:name w:val="heading 3"/><w:basedOn w:val="H2"/></w:style>'
    '<w:style w:type="paragraph" w:styleId="H2"><w:basedOn w:val="Heading3"/><w:pPr><w:outlineLvl w:val="2"/></w:pPr></w:style>'
    '<w:style w:type="paragraph" w:styleId="Caption"><w:name w:val="caption"/></w:style>',
)
NUMBERS = part(
    "numbering",
    '<w:abstractNum w:abstractNumId="7"><w:lvl w:ilvl="0"><w:start w:val="3"/><w:numFmt w:val="decimal"/><w:lvlText w:val="%1."/></w:lvl><w:lvl w:ilvl="1"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum>'
    '<w:num w:numId="5"><w:abstractNumId w:val="7"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="9"/></w:lvlOverride></w:num>',
)
