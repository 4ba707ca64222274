import pytest

from reportweave.llm.html_text import extract_text, op7_html_text, render

CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("  a \n b  ", "a b"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("a<b> b</b><i>c</i> d", "a bc d"), ("<ul><li>x<li>y<ul><li>z</ul></ul>", "- x\n- y\n  - z"),
    ("<ol start=3><li>c<li value=9>d<li>e</ol>", "3. c\n9. d\n10. e"), ("<li>loose", "- loose"),
    ("<table><tr><th>A<th>Bee<tr><td>long cell<td>1<tr><td><td>2</table>", "A          Bee\nlong cell  1\n           2"),
    ("<table><tr><td rowspan=2>x<td>y<tr><td>z</table>", "x  y\n   z"),
    ("<table><tr><td colspan=2>wide one<td>c<tr><td>a<td>b<td>d</table>", "wide one  c\na  b  d"),
    ("<table><td>a<br>b<td>c</table>", "a  c\nb"), ("<td>x</td><td>y</td>", "x y"),
    ("<table><caption>Cap</caption><tbody><td>v</table>", "Cap\nv"),
    ("<p hidden>a</p>b<p style='DISPLAY : none'>c</p><p style='visibility:hidden'>d", "b"),
    ("<head><title>t</title><style>p{}</style></head><body>x<script>'</p>'</script>y<!-- z -->", "xy"),
    ("<noscript>a</noscript><template>b</template>c", "c"), ("<pre>\n a\n  b</pre>x", " a\n  b\n\nx"),
    ("<dl><dt>T<dd>D<dd>E</dl>", "T\n  D\n  E"), ("<blockquote>q</blockquote>r", "  q\n\nr"),
    ("<details><summary>S</summary>hid</details><details open>seen</details>", "S\nseen"),
    ("<select><option>A<option>B</select>", "A\nB"), ("<input type=submit value=Go><input value=typed><input type=hidden value=no>", "Go typed"),
    ("<textarea> a &lt; b\n c</textarea>", " a < b\n c"), ("a < b <3 <", "a < b <3 <"), ("<p title='a>b'>x", "x"),
    ("<a href=\"x", ""), ("x</div></p>y", "x\n\ny"), ("<TABLE><TR><TD>u</TABLE>", "u"),
    ("<div hidden><p>a<div>b</div></div>c", "c"), ("<script>x", ""), ("<!doctype html><html lang=e><body>k</body></html>", "k"),
    ("İ<script>a</script>b", "İb"), ("&#0;&nbsp;x&shy;y", "� xy"), ("<h1>T</h1>text", "T\n\ntext"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_rendering(page, text):
    assert render(page) == text


WHOLE = [
    ("<table><tr><form><td>A</td></form></tr><tr><td>B</table>", "A\nB"), ("<table><form><tr><td>A</form></table>", "A"),
    ("<table><tbody>note<tr><td>a</table>", "note\na"), ("<table><tr>note<td>a</table>", "note\na"),
    ("<table><tr><td>a</td><p>b</p></tr></table>", "b\n\na"), ("<table><tr><b>n<td>a<td>b</table>", "n\na  b"),
    ("<table><caption>C</caption><tbody><tr><td>a</td><i>n</i></tr></table>", "n\nC\na"),
    ("<table><tr hidden>x<td>a</tr><tr><td>b</table>", "b"), ("<table><form hidden><tr><td>a</table>", "a"),
    ("<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math>", "x=1"),
    ("<svg>no<title>t</title><g>no<text>A<tspan>B</tspan></text></g><text>C</text></svg>d", "AB\nC\nd"),
    ("<svg><defs><text>no</text></defs><style/><title/><path d=x /><text><![CDATA[a<b]]></text></svg>c", "a<b\nc"),
    ("<svg><foreignObject>f<p>g</p></foreignObject></svg>", "f\n\ng"), ("<svg><path><p>out</svg>", "out"),
    ("<svg><text display=none>no</text><text>x", "x"), ("<![CDATA[a>b", "b"),
    ("<head><title>t</title>Hello <b>you</b>", "Hello you"), ("<head><script>1</script> x", "x"), ("<head>a</head>b", "ab"),
]


WHOLE += [
    ("<!-->visible<p>x", "visible\n\nx"), ("<!--->visible", "visible"), ("<!-- a > b -->c", "c"), ("<!--x", ""),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>d", "b\nd"),
    ("<ul style='visibility:hidden'><li>a<li style='visibility: visible'>b</ul>", "- b"),
    ("<p style='display:none;display:block'>a", "a"), ("<td>a</p>b", "a\n\nb"),
    ("<select><optgroup label=Fruit><option>apple</optgroup></select>", "Fruit\napple"),
    ("<input type=password value=x><input type=Checkbox value=y>z", "z"),
    ("<table><tr><td>日本<td>x<tr><td>abcd<td>y</table>", "日本  x\nabcd  y"),
    ("<svg><g visibility=hidden><text>a<tspan visibility=visible>b</tspan></text></g></svg>", "b"),
]
SHEETS = [
    (".h{display:none}", "<p class='a h'>no</p><p class=a>yes"), ("#h, .x { visibility: hidden }", "<p id=h>no</p>yes"),
    ("b{display:none}", "<b>no</b>yes"), ("p.h{display:none}", "<p class=h>no</p><b class=h>yes"),
    ("@media print{.h{display:none}}", "<p class=h>yes"), ("@media screen{.h{display:none}}", "<p class=h>no</p>yes"),
    ("@import 'a;{b'; .h{display:none}", "<p class=h>no</p>yes"), ("div .h{display:none}", "<p class=h>yes"),
    (".h{display:none}", "<p class=h style='display:block'>yes"), (".h{display:none!important}", "<p class=h style='display:block'>no</p>yes"),
    (".h{display:none} .h{display:block}", "<p class=h>yes"), ("#i{display:block} .h{display:none}", "<p class=h id=i>yes"),
    ("/* .h{display:none} */ .g{color:red}", "<p class='h g'>yes"), (".h{display:none", "<p class=h>yes"),
    (".h:hover{display:none}", "<p class=h>yes"), (".h{visibility:hidden}", "<p class=h>no<b style='visibility:visible'>yes"),
]


@pytest.mark.parametrize(("sheet", "page"), SHEETS)
def test_simple_rules_of_sheets(sheet, page):
    assert render(f"<style>{sheet}</style>{page}") == render(f"{page}<style>{sheet}</style>") == "yes"


@pytest.mark.parametrize("depth", [*range(90, 110), 300])
def test_deep_hidden_elements_stay_hidden(depth):
    page = "<div>" * depth + "<div hidden><p>secret<table><tr><td>secret" + "<div>secret" * depth
    assert render(page) == ""
    closed = "<div>" * depth + "<div hidden><p>secret</div>open"
    assert render(closed) == "open"


@pytest.mark.parametrize(("page", "text"), WHOLE)
def test_all_visible_text(page, text):
    assert render(page) == text


@pytest.mark.parametrize("depth", [*range(90, 106), 150])
def test_deep_tables_keep_their_cells(depth):
    rows = "<tr><td>a1<td><p>b<b>2</b></p><tr><th>c3<td>d4"
    found = render(f"{'<div>' * depth}<table><tbody>{rows}</table>")
    assert found.split() == ["a1", "b2", "c3", "d4"] or found.split() == ["a1", "b", "2", "c3", "d4"]
    inner = render("<table><td>" + "<div>" * depth + f"<table>{rows}</table>")
    assert sorted("".join(inner.split())) == list("1234abcd")
    nested = render("<table><tr><td>x<td>y" * depth)
    assert nested.count("x") == nested.count("y") == depth


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "x", "<a \"" * 50_000, "<ul><li>" * 5_000 + "x", "<table><td>" * 3_000 + "x", "<b><p>" * 20_000, "x" * 3_000_000])
def test_hard_pages(page):
    assert len(render(page)) <= 20 * len(page)  # items keep their indent


def test_spark(spark, small):
    schema = "page_id bigint, html string, text string, _page string"
    rows = [(1, "<p>a", "clash", "c"), (1, "<p>a", "clash", "c"), (None, None, "clash", "c"), (3, "", "clash", "c")]
    pages = spark.createDataFrame(rows, schema)
    assert [tuple(r) for r in extract_text(pages).collect()] == [(1, "a"), (1, "a"), (None, ""), (3, "")]
    assert extract_text(pages.where("false")).count() == 0
    got = op7_html_text(spark, small).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert len(got) == len(source)
    for r in got:
        assert r.text == render(source[r.page_id]) and r.n_chars == len(r.text) > 0
        assert "track(" not in r.text and "<" not in r.text
