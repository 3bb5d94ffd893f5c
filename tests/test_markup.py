"""Markup events, path filter and coalescing on small documents."""

import pyarrow as pa
import pytest

from flowtables.functions import intervals
from flowtables.operators.markup import coalesce_text, markup_events, subslice, subslice_text, well_formed


def events(spark, text, **options):
    df = spark.createDataFrame([(1, text)], "doc_id int, xml string")
    return markup_events(df, "doc_id", "xml", **options)


def short(df):
    return [
        (r["kind"], *(v for v in (r["name"], r["text"]) if v is not None), *([r["attrs"]] if r["attrs"] else []))
        for r in df.orderBy("seq").collect()
    ]


def start(name, attrs=None):
    return ("start_element", name, attrs) if attrs else ("start_element", name)


def end(name):
    return ("end_element", name)


def text(value):
    return ("characters", value)


OPEN, CLOSE = ("start_document",), ("end_document",)


def test_simple_document(spark):
    got = short(events(spark, "<doc><elem>elem1</elem><elem>elem2</elem></doc>", documents=True))
    assert got == [
        OPEN, start("doc"), start("elem"), text("elem1"), end("elem"),
        start("elem"), text("elem2"), end("elem"), end("doc"), CLOSE,
    ]


def test_several_documents_in_one_text(spark):
    one = [OPEN, start("doc"), start("elem"), text("elem1"), end("elem"), end("doc"), CLOSE]
    got = short(events(spark, "<doc><elem>elem1</elem></doc>" * 2, documents=True))
    assert got == one * 2


def test_comment_instruction_attributes_cdata(spark):
    assert short(events(spark, "<doc><!--comment--></doc>", documents=True))[2] == ("comment", "comment")
    got = short(events(spark, "<?target content?><doc></doc>", documents=True))
    assert got == [OPEN, ("processing_instruction", "target", "content"), start("doc"), end("doc"), CLOSE]
    got = short(events(spark, '<doc good="yes"><elem nice="yes" very="true">elem1</elem></doc>'))
    assert got[:2] == [start("doc", {"good": "yes"}), start("elem", {"nice": "yes", "very": "true"})]
    got = short(events(spark, "<doc><![CDATA[<not>even</valid>]]></doc>"))
    assert got[1] == ("cdata", "<not>even</valid>")


def test_names_entities_and_empty_elements(spark):
    got = short(events(spark, """<a:doc x:y='1&lt;2' z=">">&#65;&#x20AC;&amp;lt;<b/> </a:doc>"""))
    assert got == [start("doc", {"y": "1<2", "z": ">"}), text("A€&lt;"), start("b"), end("b"), end("doc")]


def test_comment_does_not_open_a_document(spark):
    got = short(events(spark, "<!--c--><a/><?p d?><b/>", documents=True))
    pi = ("processing_instruction", "p", "d")
    assert got == [("comment", "c"), OPEN, start("a"), end("a"), CLOSE, OPEN, pi, start("b"), end("b"), CLOSE]


def test_html(spark):
    page = "<!DOCTYPE html><html><script>if (a<b) x('</p>');</script><style></style><br><p>one<img src=x></p></html>"
    assert short(events(spark, page, html=True)) == [
        start("html"), start("script"), text("if (a<b) x('</p>');"), end("script"),
        start("style"), end("style"), start("br"), end("br"),
        start("p"), text("one"), start("img", {"src": "x"}), end("img"), end("p"), end("html"),
    ]


#: Orders of a shop: parcels of two orders, one cancelled, and a parcel elsewhere.
SHOP = """<shop><!-- open -->
  <order no="1"><parcel>tea</parcel><parcel weight="2"><label>cups</label> x4</parcel></order>
  <cancelled><parcel>salt</parcel></cancelled>
  <order no="2">on hold<parcel/><parcel><parcel>inner</parcel></parcel></order>
  <parcel>stray</parcel>
</shop>"""


def test_subslice(spark):
    inside = subslice(events(spark, SHOP), ["shop", "order", "parcel"])
    assert short(inside) == [
        text("tea"), start("label"), text("cups"), end("label"), text(" x4"),
        start("parcel"), text("inner"), end("parcel"),
    ]
    everything = events(spark, SHOP)
    assert short(subslice(everything, [])) == short(everything)
    assert short(subslice(everything, ["shop", "label"])) == []


PAGES = [
    SHOP, "", None, " ", "no tags", "<a>", "</a></a><a><b>x</b></a>", "<a><b>never <c>closed", "<a><b/><b>1</b></b><b>2</b></a>",
    "<a><x:b y='>'>p<![CDATA[<b>]]>&amp;q<!--c-->r</x:b><b> <?do it?> s</b></a>", "<a><b>u<!DOCTYPE z> <?xml version='1'?>v</b>w</a>",
    "<html><BODY><p>one<br>two<script>if (a<b) {}</script>three</p><style></style></BODY></html>",
    "<html><script>x<y</script><p>z</p><script>last</script></html>", "<a><b>" + "<i>k</i>" * 300 + "</b></a>", "<a><b>open <!-- end", "<a><b>< 1</b></a>",
]


@pytest.mark.parametrize(
    "path,html",
    [([], True), (["a", "b"], False), (["shop", "order", "parcel"], False), (["html", "script"], True), (["html", "BODY"], True)],
)
def test_slices_of_rows_are_slices_of_events(spark, path, html):
    df = spark.createDataFrame([*enumerate(PAGES)], "doc_id int, xml string").repartition(2)
    rows = lambda d: sorted((r.doc_id, r.seq, r.kind, r.name, r.text, sorted((r.attrs or {}).items())) for r in d.collect())
    every = markup_events(df, "doc_id", "xml", html=html)
    assert rows(subslice_text(df, "doc_id", "xml", path, html=html)) == rows(subslice(every, path))
    flagged = lambda d: sorted((r.doc_id, r.seq, r.kind, r.name or "", r.text or "", r.error or "") for r in d.collect())
    merged = subslice(coalesce_text(every, 12, on_error=None), path)
    assert flagged(subslice_text(df, "doc_id", "xml", path, html=html, max_text=12, on_error=None)) == flagged(merged)


@pytest.mark.parametrize("path,html", [([], True), ([], False), (["a", "b"], False), (["html", "script"], True)])
def test_slices_of_kinds(spark, path, html):
    """Tokens of other kinds are left out in the slice, and no event of these kinds is lost."""
    df = spark.createDataFrame([*enumerate(PAGES)], "doc_id int, xml string").coalesce(1)
    rows = lambda d: sorted((r.doc_id, r.seq, r.kind, r.name or "", r.text or "") for r in d.collect())
    every = rows(subslice_text(df, "doc_id", "xml", path, html=html))
    some = [["characters"], ["start_element"], ["end_element"], ["comment", "error"], ["cdata", "processing_instruction", "start_element"], []]
    for kinds in some:
        assert rows(subslice_text(df, "doc_id", "xml", path, html=html, kinds=kinds)) == [r for r in every if r[2] in kinds]
    merged = lambda **more: rows(subslice_text(df, "doc_id", "xml", path, html=html, max_text=1_000, **more))
    assert merged(kinds=["characters"]) == [r for r in merged() if r[2] == "characters"]
    tokens = pa.array([["<a>", "x", "</a>", "<!--c-->", "<", "<b/>"]])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), tokens], ["id", "tokens"])
    kept = lambda kinds: [p["token"] for b in intervals.slices([batch], [], False, False, kinds) for r in b["pieces"].to_pylist() for p in r]
    assert kept(["characters"]) == ["x", "<"] and kept(["end_element"]) == ["</a>", "<b/>"]


def test_slices_shuffle_nothing(spark, capsys):
    df = spark.createDataFrame([*enumerate(PAGES)], "doc_id int, xml string")
    subslice_text(df, "doc_id", "xml", ["a", "b"], max_text=100).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_coalesce(spark):
    chunks = "".join(f"<![CDATA[{i}]]>" for i in range(10))
    merged = coalesce_text(events(spark, f"<doc>{chunks}</doc>"), 10)
    assert short(merged) == [start("doc"), text("0123456789"), end("doc")]
    longer = events(spark, f"<doc>{chunks}<![CDATA[x]]></doc>")
    with pytest.raises(Exception, match="text_too_long"):
        coalesce_text(longer, 10).collect()
    flagged = coalesce_text(longer, 10, on_error=None).where("error is not null").collect()
    assert [(r["error"], r["text"]) for r in flagged] == [("text_too_long", None)]
    apart = short(coalesce_text(events(spark, "<a>x<b/>y<![CDATA[z]]></a>"), 10))
    assert apart == [start("a"), text("x"), start("b"), end("b"), text("yz"), end("a")]


@pytest.mark.parametrize(
    "doc,good",
    [("<a><b/></a>", True), ("<a><b></a></b>", False), ("<a>", False), ("</a>", False), ("<a></a><b></b>", True), ("x", True)],
)
def test_well_formed(spark, doc, good):
    assert well_formed(events(spark, doc)).first()["well_formed"] is good
