import html
import re

from corpusmill.llm.catalog import op3_html_extraction
from corpusmill.llm.html_text import extract_text, page_text


def test_blocks_lists_and_tables():
    page = """<html><head><title>T</title><style>x</style></head><body><h1>Head</h1>
    <p>One <b>two</b>
      three<p>Four<br>five<script>no()</script>
    <ul><li>a<li>b<ol start=3><li>c</li><li>d</ol></ul>
    <table><tr><th>n<th>name<tr><td>1<td>long name<tr><td>100<td>x</table>
    <pre>  keep
   this</pre><div>p</div><div>q</div></body></html>"""
    assert page_text(page) == (
        "Head\n\nOne two three\n\nFour\nfive\n\n- a\n- b\n  3. c\n  4. d\n\n"
        "n    name\n1    long name\n100  x\n\n  keep\n   this\n\np\nq"
    )


def test_invisible_parts():
    page = '<p hidden>a</p><p style="color:red; display : none">b</p><p style="visibility:hidden">c</p><input type=hidden value=d><!-- e --><template>f</template><noscript>g</noscript><p>h'
    assert page_text(page) == "h"


def test_entities_and_strays():
    assert page_text("a &amp; b&nbsp;c &lt;x&gt; &#233;</b></p></div>") == "a & b\xa0c <x> é"
    assert page_text("") == ""
    assert page_text("plain text") == "plain text"
    assert page_text("<td>x</td><li>y") == "x\n- y"
    assert page_text("a < b <!DOCTYPE <![if x]> c") .startswith("a < b")


def test_colspan_and_nested_tables():
    assert page_text("<table><tr><td colspan=2>ab<td>c<tr><td>1<td>2<td><table><tr><td>x<td>y</table></table>") == "ab     c\n1   2  x  y"


def test_deep_and_long_pages():
    assert page_text("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert page_text("<table><tr><td>" * 300 + "x").strip() == "x"
    assert len(page_text("<p>word</p>" * 20000).split()) == 20000


def test_query_has_every_visible_word(spark):
    """Against another way: hidden parts cut out by patterns, tags taken as spaces."""
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op3_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        rest = re.sub(r"(?s)<!--.*?-->|<(script|style|head|template|noscript|svg)\b.*?</\1>", "", pages[r.page_id])
        rest = re.sub(r"(?i)</?(b|i|a|em|strong|span|u|code|small|sup|sub)\b[^>]*>", "", rest)
        want = html.unescape(re.sub(r"<[^>]*>", " ", rest)).split()
        have = [w for w in r.page_text.split() if w != "-" and not re.fullmatch(r"\d+\.", w)]
        want = [w for w in want if w != "-" and not re.fullmatch(r"\d+\.", w)]
        assert have == want


def test_rows(spark):
    df = spark.createDataFrame([(1, "<p>a", "x"), (1, "<p>a", "x"), (2, None, None), (None, "", "y")], "page_id long, html string, page_text string")
    out = extract_text(df)
    assert out.columns == ["page_id", "html", "page_text"]
    assert sorted(((r.page_id, r.page_text) for r in out.collect()), key=repr) == sorted([(1, "a"), (1, "a"), (2, None), (None, "")], key=repr)
    assert extract_text(df.limit(0)).count() == 0


def test_open_head_ends_at_content():
    assert page_text("<html><head><title>t</title><p>text<p>more") == "text\n\nmore"
    assert page_text("<head><meta charset=x><style>s</style>\n<script>no()</script> bare <b>words</b>") == "bare words"
    assert page_text("<head><title>t</title><noscript><img alt=n></noscript><link></head><p>a") == "a"


def test_drawings_formulas_and_options():
    svg = "<svg> x <title>t</title><defs><text>d</text></defs><g><text x=1>Jan<tspan>uary</tspan></text><text display=none>n</text><text>May</text></g><path/></svg>"
    assert page_text(f"a{svg}b") == "a January May b"
    assert page_text("<p>1<svg><path><p>2</svg>3") == "1\n\n23"  # a paragraph cannot stand in a drawing
    assert page_text("<svg><foreignObject><p>in</p></foreignObject></svg>") == "in"
    assert page_text("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation>tex</annotation></semantics></math>") == "x=1"
    assert page_text("<p>Pick <select><option>a<option selected>b<optgroup label=G><option label=c>d</select> now") == "Pick\na\nb\nG\nc\nnow"
    assert page_text("<datalist><option>a</datalist>b") == "b"


def test_hidden_parts_past_the_depth_limit():
    deep = "<div>" * 200
    assert page_text(deep + "<script>no()</script><style>s</style><div hidden>n<div>o</div></div><i style='display:none'>n<b>z</b></i>yes") == "yes"
    assert page_text(deep + "<ul><li hidden>a<li>b</ul><svg>n<text>c</text></svg>") == "b c"
    # the end tags of deep elements are their own
    assert page_text("<div hidden>" + "<b>" * 200 + "<div>x</div><div>y</div>" + "</b>" * 200 + "z</div>seen") == "seen"
    assert page_text("<font>" * 20000 + "<p>x</p></b>" * 20000).split() == ["x"] * 20000
