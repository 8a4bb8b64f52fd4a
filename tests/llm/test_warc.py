import gzip
from collections import Counter
from html.parser import HTMLParser
from pathlib import Path

import pytest
from docledger.llm import warc


class Plain(HTMLParser):
    """The same rules on the standard parser."""

    def __init__(self, text):
        super().__init__(convert_charrefs=True)
        self.pieces, self.hidden, self.title, self.links = [], [], "", []
        self.feed(text)
        self.close()
        self.text = "\n".join(x for x in (" ".join(line.split()) for line in "".join(self.pieces).split("\n")) if x)

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title"):
            self.hidden.append(tag)
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])
        if tag in warc.BLOCKS:
            self.pieces.append("\n")

    def handle_endtag(self, tag):
        if self.hidden and self.hidden[-1] == tag:
            self.hidden.pop()
        if tag in warc.BLOCKS:
            self.pieces.append("\n")

    def handle_data(self, data):
        if self.hidden:
            self.title += data * (self.hidden[-1] == "title")
        else:
            self.pieces.append(data.replace("\n", " "))


def test_pages_equal_the_standard_parser(spark):
    n = 0
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        mine, want = warc.Page(r.html), Plain(r.html)
        assert (mine.text, mine.title, mine.links) == (want.text, " ".join(want.title.split()), want.links), r.page_id
        n += bool(mine.text)
    assert n > 200


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("", ""), ("a<b>c</b>d", "acd"), ("a<br>b<p>c", "a\nb\nc"), ("1 < 2 &lt; 3 &amp;amp; &#233;&nbsp;x", "1 < 2 < 3 &amp; \xe9 x"), ("a<!-- x > --> b", "a b"), ("a<!-- x", "a"),
        ("a<script>if (a<b) '</p>'</SCRIPT >b", "ab"), ("a<style>x", "a"), ('<a title="x>y" href=u>t</a>', "t"), ("a<p title='x", "a"), ("İ<script>x</script>y", "İy"), ("<title>t</title>b", "b"),
    ],
)
def test_markup(text, want):
    assert warc.Page(text).text == want


def test_hostile_pages_take_linear_time():
    for piece in ("<", "<a", "<a '", '<a "x', "<!--", "<script>", "<title>", "&", "<p>", "</", "<a href=x "):
        warc.Page(piece * (400_000 // len(piece)))


def test_records_are_linked_and_read_back(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r.page_id: r for r in warc.responses(pages).collect()}
    records = warc.responses(pages).unionByName(warc.derive(warc.responses(pages)))
    rows = records.collect()
    assert len({r.record_id for r in rows}) == len(rows) == 3 * pages.count()
    for r in rows:
        assert r.block_digest == warc.digest_of(bytes(r.block))
        if r.kind != "response":
            s = sources[r.page_id]
            assert (r.refers_to, r.target_uri, r.date, r.source_digest, r.headers) == (s.record_id, s.target_uri, s.date, s.source_digest, s.headers)
            assert s.source_digest == warc.digest_of(warc.split_response(bytes(s.block))[2])
    warc.write(records, str(tmp_path / "out"))
    found = [x for f in Path(tmp_path / "out").glob("*.gz") for x in warc.parse(gzip.decompress(f.read_bytes()))]
    assert Counter((f["WARC-Record-ID"], f["WARC-Type"], f.get("WARC-Refers-To"), b) for f, b in found) == Counter((r.record_id, r.kind, r.refers_to, bytes(r.block)) for r in rows)


def test_edge_rows(spark):
    rows = [(1, "http://a", "<p>x", 1), (1, "http://a", "<p>x", 1), (None, None, None, 2), (2, "", "", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, kind int")
    got = warc.digest(pages).collect()
    assert Counter((r.page_id, r.kind) for r in got) == Counter({(1, "metadata"): 2, (1, "conversion"): 2, (None, "metadata"): 1, (None, "conversion"): 1, (2, "metadata"): 1, (2, "conversion"): 1})
    assert [r.n_bytes for r in got if r.kind == "conversion"] == [1, 1, 0, 0]
    assert warc.digest(pages.limit(0)).count() == 0


def test_each_record_is_a_member(spark, tmp_path):
    import zlib

    pages = spark.createDataFrame([(1, "http://a", "<p>x"), (2, "http://b", "y" * (17 << 20)), (3, None, None)], "page_id long, url string, html string")
    warc.write(warc.responses(pages).coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.warc.gz")
    data, kinds = file.read_bytes(), []
    while data:
        one = zlib.decompressobj(31)
        text = one.decompress(data)
        assert one.eof
        kinds.append(len(list(warc.parse(text))))
        data = one.unused_data
    assert sum(kinds) == 3 and max(kinds) == 1


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<head>stray<title>t</title>more</head>body", "body"), ("<head>a<meta x=y>b<p>c", "c"), ("<html><head><body>x", "x"), ("a<script>x</scripty>'; yz</script>b", "ab"), ("<title>t</titles></title >b", "b"),
        ("<head></head>a<title>t</title>b", "ab"),
    ],
)
def test_heads_and_ends_of_scripts(text, want):
    assert warc.Page(text).text == want
