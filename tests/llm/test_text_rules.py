"""Line rules, licence scan and HTML layout."""

import re
from collections import Counter
from html.parser import HTMLParser

import duckdb
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import TEXTS, empty_docs, odd_docs

from strata.llm import html_layout, license_scan, line_rules
from strata.llm.common import read_table

PROSE = "\n".join(" ".join(f"{w}{k}" for w in "this line has plain and honest words that end as they should".split()) + "." for k in range(12))


def test_line_rules_equal_their_sql(spark):
    rows = TEXTS + [
        (20, PROSE),
        (21, PROSE + "\nHome | About | Contact | Help\nShop\nAll rights reserved.\nREAD MORE"),
        (22, "\n".join(["BUY!! NOW!! THIS!! IS!! GOOD!!"] * 9)),
        (23, "a b c d e f g h " * 5),
        (24, "a b c d e f g h x a b c d e f g h i a b c d e f g h i"),
        (25, "\n".join(f"w{k}### v{k}$$$" for k in range(30))),
        (26, "same line here.\n\nsame line here.\n same line here.\n" + PROSE),
        (27, "one two three four five six seven eight"),
    ]
    got = line_rules.judged(odd_docs(spark, rows))
    columns = [c for c in got.columns if c != "clean_text"]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": object}))
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = sorted((tuple(r) for r in con.sql(f"SELECT {', '.join(columns)} FROM ({line_rules.oracle()})").fetchall()), key=key)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == want
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[20]["kept"] and by_id[20]["clean_text"] == PROSE
    assert by_id[21]["kept"] and by_id[21]["clean_text"] == PROSE
    assert by_id[24]["n_repeat_words"] == 26
    assert not any(by_id[k]["kept"] for k in (2, 3, 4, 22, 23, 25, 27))
    assert line_rules.judged(empty_docs(spark)).count() == 0


def test_line_rules_run_without_python(spark):
    plan = line_rules.judged(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# -- licences ----------------------------------------------------------------------------------------------------
def pairs(text):
    # ASCII case only, as the operator lowers bytes
    w = [x.lower() for x in re.sub(rb"[^0-9A-Za-z\x80-\xff]+", b" ", text.encode()).split()]
    return Counter(zip(w, w[1:]))


def best_licence(text, least=0.8):
    lines = text.split("\n")
    blank = [-1, *(k for k, x in enumerate(lines) if not x.strip()), len(lines)]
    segments = {(0, len(lines) - 1), *((k, k) for k in range(len(lines))), *((a + 1, b - 1) for a, b in zip(blank, blank[1:]) if b - a > 1)}
    best = 0.0
    for a, b in segments:
        own = pairs("\n".join(lines[a : b + 1]))
        for t in license_scan.TEMPLATES.values():
            other = pairs(t)
            if own and (d := 2 * sum((own & other).values()) / (sum(own.values()) + sum(other.values()))) >= least:
                best = max(best, d)
    return best


def test_licences_equal_brute_force(spark):
    mit = license_scan.TEMPLATES["MIT"]
    rows = TEXTS + [
        (30, f"Copyright 2020 Someone\n\n{mit}\n\nNext part."),
        (31, mit.upper().replace("\n", " ")),
        (32, "Some words first.\nReleased under the MIT License."),
        (33, "Some words first.\nReleased under the new MIT License, friends of all.\nLicensed under CC BY 4.0."),
        (34, "\n".join([PROSE, license_scan.TEMPLATES["GPL-3.0-notice"], PROSE])),
        (35, mit.replace("Software", "Program")),
        (36, "This work is licensed under the GNU General Public License, version 2.\nThis work is licensed under the GNU General Public License, version 3."),
    ]
    got = license_scan.licences(odd_docs(spark, rows)).collect()
    assert sorted(round(r["dice"], 12) for r in got) == sorted(round(best_licence(t or ""), 12) for _, t in rows)
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[30]["licence"], by_id[30]["dice"], by_id[31]["licence"]) == ("MIT", 1.0, "MIT")
    assert (by_id[32]["licence"], by_id[32]["line_start"], by_id[32]["line_end"]) == ("MIT-notice", 1, 1)
    assert by_id[34]["licence"] == "GPL-3.0-notice" and by_id[36]["licence"] == "GPL-2.0-notice"
    assert by_id[2]["licence"] is None and by_id[2]["n_matches"] == 0
    assert license_scan.licences(empty_docs(spark)).count() == 0


def test_a_text_in_pieces_gives_the_same():
    text = "\n\n".join(PROSE + "\n" + t for t in license_scan.TEMPLATES.values())
    t = license_scan.Templates(license_scan.Params())
    whole = license_scan.scan(text.encode(), t, 1 << 20)
    assert whole and license_scan.scan(text.encode(), t, 100) == whole


def best_window(text, templates, least=0.8):
    w = [x.lower() for x in re.sub(rb"[^0-9A-Za-z\x80-\xff]+", b" ", text.encode()).split()]
    own, best = list(zip(w, w[1:])), 0.0
    for t in templates.values():
        other = pairs(t)
        size = sum(other.values())
        for i in range(len(own)):
            seen, common = Counter(), 0
            for j in range(i, min(len(own), i + int(size * (2 - least) / least) + 1)):
                seen[own[j]] += 1
                common += seen[own[j]] <= other[own[j]]
                best = max(best, 2 * common / (j - i + 1 + size))
    return best if best >= least else 0.0


GPL = license_scan.TEMPLATES["GPL-3.0"]
MIT = license_scan.TEMPLATES["MIT"].replace("conditions:\n", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")


def test_licences_are_found_in_all_windows():
    t = license_scan.Templates(license_scan.Params())
    for text, name, lines in [
        (f"{PROSE}\n{PROSE}\n\n{MIT}\n\n{PROSE}", "MIT", (25, 37)),
        (f"{PROSE}\n\n{GPL.replace('version. This', 'version.' + chr(10) * 2 + 'This')}\n\n{PROSE}", "GPL-3.0", (13, 19)),
        ("Copyright 2019 Example Corp. All rights reserved.", "Copyright-notice", (0, 0)),
        ("One.\nThis project is released under the\nMIT License.", "MIT-notice", (1, 2)),
    ]:
        found = license_scan.scan(text.encode(), t, 1 << 20)
        assert found == license_scan.scan(text.encode(), t, 100)
        assert [(n, (a, b)) for _, n, a, b in found] == [(name, lines)], text
        assert found[0][0] == best_window(text, license_scan.TEMPLATES)
    two = [(n, a) for _, n, a, _ in license_scan.scan(f"{MIT}\n\n{MIT}".encode(), t, 1 << 20)]
    assert two == [("MIT", 0), ("MIT", 14)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f . \n \n\n".split(" ")), max_size=60), st.lists(st.lists(st.sampled_from("a b c d".split()), min_size=2, max_size=9), min_size=1, max_size=3), st.sampled_from([0.5, 0.8, 1.0]))
def test_the_best_window_is_found(words, templates, least):
    p = license_scan.Params(least=least, templates={str(k): " ".join(x) for k, x in enumerate(templates)})
    text = " ".join(words)
    got = license_scan.scan(text.encode(), license_scan.Templates(p), 1 << 20)
    assert max((x[0] for x in got), default=0.0) == best_window(text, p.templates, least)


# -- HTML --------------------------------------------------------------------------------------------------------
PAGES = {
    "": "",
    "plain &amp; simple": "plain & simple",
    "<p>a<p>b": "a\n\nb",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<h1>T</h1>x <b>y</b>\n z": "T\n\nx y z",
    "<ul><li>a<li>b<ol start=3><li>c</li><li>d</ol></ul>e": "- a\n- b\n  3. c\n  4. d\n\ne",
    "<table><tr><td>a<td>bbb<tr><td>cccc</td><td>d</table>": "a     bbb\ncccc  d",
    "<table><tr><th>x</th><th>y</th></tr><tr><td colspan=2>wide cell here</td></tr></table>": "x  y\nwide cell here",
    "<table><tr><td>a<table><tr><td>in</table></td><td>b</table>": "a   b\n\nin",
    "<pre> a\n  b</pre>": " a\n  b",
    "<head><title>t</title></head><script>var x='</p>'</script><style>p{}</style>v": "v",
    "a<span hidden>no</span><i style='display: none'>no<b>no</b></i><!-- no -->b": "ab",
    "a<select><option>one<option>two</select><template>no</template>z": "a one two z",
    "<label>pick<select><optgroup label='big ones'><option selected>x</option><option hidden>y</option></select></label> <datalist><option>no</datalist>end": "pick big ones x end",
    "<dl><dt>T<dd>D<dt>U<dd>V</dl>": "T\n  D\nU\n  V",
    "x</p></div></b>y": "x\n\ny",
    "1 < 2 & 3 > 2": "1 < 2 & 3 > 2",
    "<a href=x>l</a> <img alt='pic'> <input type=hidden value=no><input value=yes>": "l pic yes",
    "<p>open <b>to the end": "open to the end",
}


def test_pages_look_as_laid_out(spark):
    schema = "page_id long, html string, text string, url string"
    rows = [(k, h, "clash", None) for k, h in enumerate(PAGES)] + [(None, None, None, None), (99, "<div>" * 3000 + "deep", None, None), (98, "word " * 40000, None, None)]
    got = {r["page_id"]: r["text"] for r in html_layout.extracted(spark.createDataFrame(rows, schema)).collect()}
    for k, (page, text) in enumerate(PAGES.items()):
        assert got[k] == text, page
    assert got[None] == "" and got[99] == "deep" and len(got[98]) == 40000 * 5 - 1
    assert html_layout.extracted(spark.createDataFrame([], schema)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <div> </div> <b> </b> <ul> <li> </ul> <table> <tr> <td> </td> </tr> </table> <br> <pre> </pre> <ol> </ol> <dd> <a> </a> <h2> </h2> w1 w2 w3 &lt;".split()), max_size=40))
def test_no_visible_word_is_lost(parts):
    words = [x for x in parts if x[0] == "w"]
    out = html_layout.render(" ".join(parts))
    assert sorted(re.findall(r"w\d", out)) == sorted(words)


def test_a_head_ends_where_it_must():
    for page, text in {
        "<head><title>t</title><body><p>Hello": "Hello",
        "<html><head><meta charset=x><title>t</title><p>Hello</p>": "Hello",
        "<head><style>a</style>\n Hello <b>all</b>": "Hello all",
        "<head><noscript><link href=x></noscript><script>s</script><div>Hello": "Hello",
        "<head><noscript><img alt=pic></noscript><title>t</title> Hello": "pic Hello",
        "<head><template><p>no</template><head><html><title>t</title></p>Hello": "Hello",
        "<head> <title>t</title> </head> <body>Hello": "Hello",
        "<div hidden>no</p></br></div>Hello": "Hello",
    }.items():
        assert html_layout.render(page) == text, page


def test_formulas_and_drawings_are_rendered():
    for page, text in {
        "so <math><mfrac><mi>a</mi><mn>12</mn></mfrac><mo>=</mo><mi>b</mi><annotation>no</annotation></math>.": "so a 12 = b.",
        "a <svg/> b <math/> c": "a b c",
        "<p>a <svg><path d='m'/><g><title>Sales</title><text x=1>one</text><text>t<tspan>wo</tspan></text>no</g></svg> b": "a Sales one two b",
        "<svg><style/><desc>no</desc><metadata>no</metadata><script>no</script><text><![CDATA[1 > 0]]></text></svg>": "1 > 0",
        "<p>a<svg><foreignObject><div>in</div><p>deep</foreignObject></svg>b": "a\nin\n\ndeep\n\nb",
        "<div><svg><g><path></div>a<svg><g><p>b": "a\n\nb",
        "<svg><g display=none><text>no</text></g><text visibility=hidden>no</text><text>a</text></svg>": "a",
        "<svg width=10/><text>a</text></svg>b": "a b",
        "<p><svg><rect></p>a <math><mphantom><mi>no</mi></mphantom><mtext>x <b>y</b></mtext></math>": "a x y",
    }.items():
        assert html_layout.render(page) == text, (page, html_layout.render(page))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("<p> </p> <div> </div> <b> </b> <math> </math> <mi> </mi> <mrow> </mrow> <math/> <svg/> <table> <td> </table> <br> </br> w1 w2 w3".split()), max_size=40))
def test_no_word_is_lost_in_formulas(parts):
    out = html_layout.render(" ".join(parts))
    assert sorted(re.findall(r"w\d", out)) == sorted(x for x in parts if x[0] == "w")


def test_a_tag_ends_at_its_own_end():
    for page, text in {
        "<p title=it's>first</p> <p>they don't</p> end": "first\n\nthey don't\n\nend",
        "<a href=\"x\"\">text</a>": "text",
        "<a href=\"x\"\"y' title='a > b' z = \"<b>\">text</a> \"more\"": "text \"more\"",
        "<img alt=\"a 'b' > c\" \"><p don't>it's": "a 'b' > c\n\nit's",
        "<a href=\"x>text</a> end": "text end",
        "<img =x alt='pic'/><input value=a/>": "pica/",
        "</p title='>'>x<input value = 'y'>": "xy",
        "<a b=>x</a> <input value=\"\">y": "x y",
        "<a href='x": "<a href='x",
    }.items():
        assert html_layout.render(page) == text, (page, html_layout.render(page))


def test_a_stock_phrase_in_prose_does_not_cost_the_line(spark):
    """A phrase fails a line that it makes up a stated share of, not a long line of prose that holds it once."""
    prose = " ".join(f"word{k} of a long paragraph" for k in range(60))
    texts = [prose + " where javascript and a cookie are named once.", "Please accept our cookie policy.", prose + ".\nThis site uses cookies, see our privacy policy and the terms of use."]
    rows = line_rules.judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["clean_text"] for r in rows] == [texts[0], "", prose + "."]
    assert [r["kept"] for r in rows] == [True, False, True]


class PlainReader(HTMLParser):
    """The visible words of a page, without any layout: a second way to read the pages of the table."""

    def __init__(self):
        super().__init__()
        self.out, self.unseen, self.lists = [], [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style", "title", "template"):
            self.unseen.append(tag)
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
        if not self.unseen and tag in html_layout.BLOCKS | {"br", "td", "th", "tr"}:
            self.out.append(" ")
        if tag == "li" and not self.unseen:
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append(f"{kind[1]}. " if kind[0] == "ol" else "- ")

    def handle_endtag(self, tag):
        if tag in self.unseen:
            del self.unseen[self.unseen.index(tag) :]
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        if not self.unseen and tag in html_layout.BLOCKS | {"td", "th", "tr"}:
            self.out.append(" ")

    def handle_data(self, data):
        if not self.unseen:
            self.out.append(data)


def test_words_of_all_pages_equal_a_plain_reader(spark):
    pages = read_table(spark, "/root/testdata/sf0.01", "pages")
    got = {r["page_id"]: r["text"] for r in html_layout.extracted(pages).collect()}
    rows = pages.select("page_id", "html").collect()
    assert len(got) == len(rows) > 100
    for r in rows:
        reader = PlainReader()
        reader.feed(r["html"] or "")
        reader.close()
        assert got[r["page_id"]].split() == "".join(reader.out).split(), r["page_id"]
