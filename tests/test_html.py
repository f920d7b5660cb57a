import html as html_lib
import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from pressloom.functions import html
from pressloom.functions import select as S
from pressloom.functions.text import let

ODD_PAGES = [
    "", "plain", "a < b and c > d", "<p>one<p>two</b></p></div>x", "<br/><br>t</br>",
    "<!-- a <b> --><!DOCTYPE x><?pi?>t", "<script>if (a < b) '</p>'</script><p>x</p>",
    "<script src='a>b'>x</script>y", "<style>p{}", "<a href=/foo/>x</a>", "<div/>y<div>z",
    "<p title='a > b' class=\"x  y\" CLASS='z'>t</p>", "<td>1<td>2</tr></table>",
    "<template>in</template>out<ruby>a<rt>b</rt></ruby>", "<pre>  \n </pre> \n <p>  </p>",
    "<a\nhref = 'u' checked>k</a>", "tail <a href=", "<![CDATA[raw <b>]]>x", "<<b>>x</b>", "</ p>x</>",
    "a < b \ufdd0 \x02 < c", "\ufdd01 \ufdd00 <p>\ufdd0</p>", "x <" * 3000, "<p a=1 < b>t</p> \x02<b>",
]


class Model(HTMLParser):
    """Spans and depths by the rule: an end tag closes up to its nearest open tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.stack = [], []

    def add(self, tag):
        self.nodes.append([tag, len(self.stack), None])
        return len(self.nodes) - 1

    def handle_starttag(self, tag, attrs):
        node = self.add(tag)
        if tag in html.VOID_TAGS:
            self.nodes[node][2] = node + 1
        else:
            self.stack.append((tag, node))

    def handle_startendtag(self, tag, attrs):
        node = self.add(tag)
        self.nodes[node][2] = node + 1

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while True:
                name, node = self.stack.pop()
                self.nodes[node][2] = len(self.nodes)
                if name == tag:
                    break

    def leaf(self, data):
        node = self.add(None)
        self.nodes[node][2] = node + 1

    handle_data = handle_comment = handle_decl = leaf

    def finish(self):
        self.close()
        for _, node in self.stack:
            self.nodes[node][2] = len(self.nodes)
        return [tuple(n) for n in self.nodes]


def spans(one_column, pages):
    picked = F.transform(
        html.nodes(F.col("v")),
        lambda n: F.struct(n.tag.alias("tag"), n.depth.alias("depth"), (n.end_id - 1).alias("end")),
    )
    return [[(n.tag, n.depth, n.end) for n in row] for row in one_column(pages, picked)]


def test_tokens_are_lossless(one_column):
    joined = F.array_join(F.transform(html.tokens(F.col("v")), lambda t: t.raw), "")
    assert one_column(ODD_PAGES, joined) == ODD_PAGES


def test_tree_agrees_with_the_standard_parser(spark, one_column):
    rng = random.Random(11)
    parts = ["<p>", "</p>", "<b>", "</b>", "<div>", "</div>", "<br>", "<img/>", "t", "<ul>", "<li>", "</ul>", "<!--c-->"]
    pages = []
    for _ in range(150):
        chosen = [rng.choice(parts) for _ in range(rng.randint(1, 60))]
        # Neighbouring texts are one node.
        pages.append("".join(p for i, p in enumerate(chosen) if not (p == "t" and i and chosen[i - 1] == "t")))
    given = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    pages += given

    def model(page):
        parser = Model()
        parser.feed(page)
        return parser.finish()

    got = spans(one_column, pages)
    for page, nodes in zip(pages, got):
        assert nodes == model(page), page[:200]


def test_spans_nest(one_column):
    for nodes in spans(one_column, ODD_PAGES):
        for i, (_, depth, end) in enumerate(nodes):
            assert end > i
            assert all(d > depth for _, d, _ in nodes[i + 1 : end])


def test_long_page_crosses_chunks(one_column):
    page = "<div>" * 3 + "<p>a<b>b</b>" * (html.CHUNK * 2) + "</div></div></div>x"
    parser = Model()
    parser.feed(page)
    assert spans(one_column, [page]) == [parser.finish()]


def test_attributes(one_column):
    tags = [
        "<a href='x' HREF=\"y\" checked data-k=v/w>", "<p>", "<p class=' a\tb ' id=q>", "<a title='it&amp;s &quot;x&quot;'>",
    ]
    assert one_column(tags, html.attributes(F.col("v"))) == [
        {"href": "y", "checked": "", "data-k": "v/w"}, {}, {"class": " a\tb ", "id": "q"}, {"title": 'it&s "x"'},
    ]
    assert one_column(tags, html.class_list(html.attributes(F.col("v"))))[2] == ["a", "b"]


def test_entities(one_column):
    values = ["&amp;&lt;&eacute;&#233;&#xE9;&#8364;&hellip;", "&nosuch; & AT&T", "&#128512;", "&#147;q&#148;", "plain"]
    assert one_column(values, html.unescape(F.col("v"))) == [html_lib.unescape(v) for v in values]


def test_long_numbers(one_column):
    values = ["&#0000000169;", "&#x00000000A9;", "&#99999999999;", "&#xFFFFFFFFFF;", "&#0;", "&#00000000000065"]
    assert one_column(values, html.unescape(F.col("v"))) == [html_lib.unescape(v) for v in values]


def test_entities_in_attributes(one_column):
    values = [
        "/r?id=1&lang=en&num=5&order=asc", "&copy=1", "&notit;&notit&not", "&lang;&num;", "&amp;lt=1&ampx", "&#0000000169;&#x41",
        "a&b&;&nosuch;", "&eacute&eacutex=&gt", "plain", "&part=2&top&sub=1&image&target&int&real", "&notin;", "&" + "a" * 40 + ";",
    ]
    assert one_column(values, html.unescape_attribute(F.col("v"))) == [html_lib.unescape(v) for v in values]
    tags = [f'<a href="{v}">' for v in values]
    assert [m["href"] for m in one_column(tags, html.attributes(F.col("v")))] == [html_lib.unescape(v) for v in values]


def test_kinds(one_column):
    page = ["<!doctype html><p>a<!--c--><script>s</script></p>"]
    kinds = one_column(page, F.transform(html.nodes(F.col("v")), lambda n: n.kind))
    assert kinds == [["D", "E", "T", "C", "E", "S"]]


class ImpliedModel(Model):
    """The same with implied ends, sought in the stack for each rule in turn."""

    def handle_starttag(self, tag, attrs):
        for starts, ended, limits in html.IMPLIED_ENDS:
            if tag in starts:
                names = [t for t, _ in self.stack]
                low = max((i + 1 for i, t in enumerate(names) if t in limits), default=0)
                within = [i for i in range(low, len(names)) if names[i] in ended]
                while within and len(self.stack) > within[0]:
                    self.nodes[self.stack.pop()[1]][2] = len(self.nodes)
        super().handle_starttag(tag, attrs)


def test_implied_ends(one_column):
    rng = random.Random(12)
    names = ["p", "p", "b", "div", "ul", "ol", "li", "li", "dl", "dt", "dd", "table", "tbody", "tr", "td", "th", "button", "select",
             "optgroup", "option", "span", "h1", "ruby", "rb", "rt"]
    pages = ["<p>a<p>b<div>c<p>d</div>e", "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "<table><tr><td><p>x<td>y<tr><td>z</table>",
             "<p><button><p>in</button><p>out", "<dl><dt>a<dd>b<dt>c</dl>", "<p>a<hr>b", "<p><span><div>x"]
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 90)):
            name = rng.choice(names)
            parts.append(rng.choice((f"<{name}>", f"<{name}>", f"</{name}>", "<br>", "<!--c-->")))
        pages.append("".join(parts))
    picked = F.transform(
        html.nodes(F.col("v"), F.lit(True)),
        lambda n: F.struct(n.tag.alias("tag"), n.depth.alias("depth"), (n.end_id - 1).alias("end")),
    )
    for page, row in zip(pages, one_column(pages, picked)):
        model = ImpliedModel()
        model.feed(page)
        assert [(n.tag, n.depth, n.end) for n in row] == model.finish(), page


def test_deep_pages(one_column):
    """Elements beyond those at hand: nested, closed from far above, closed one by one."""
    rng = random.Random(13)
    names = [f"t{i}" for i in range(40)]
    pages = ["<div>" * 500 + "x" + "</div>" * 500 + "y", "<a>" + "<b>" * 300 + "</a>x<b>y", "".join(f"<{n}>" for n in names * 5) + "</t3>x</t0>y</t1>"]
    for _ in range(15):
        parts, opened = [], []
        for _ in range(600):
            if rng.random() < 0.7 or not opened:
                opened.append(rng.choice(names))
                parts.append(f"<{opened[-1]}>")
            elif rng.random() < 0.1:
                parts.append(f"</{rng.choice(opened)}>")
            else:
                parts.append(f"</{opened.pop()}>")
        pages.append("".join(parts))
    for page, nodes in zip(pages, spans(one_column, pages)):
        model = Model()
        model.feed(page)
        assert nodes == model.finish(), page[:100]


def test_siblings(one_column):
    pages = [p for p in ODD_PAGES if len(p) < 500] + ["<p>a<b>c</b>d<p>e</p>f</p>g<i>" + "<u>x</u>" * 300, "<div>" * 100 + "x</div>y" * 100]
    picked = let(html.nodes(F.col("v")), lambda d: F.zip_with(
        d, html.sibling_numbers(d), lambda n, no: F.struct(n.parent_id.alias("parent"), no.alias("no"))))
    for row in one_column(pages, picked):
        seen = {}
        for n in row:
            seen[n.parent] = seen.get(n.parent, 0) + 1
            assert n.no == seen[n.parent]


def _seconds(one_column, pages, expression):
    """The least time of three runs for each page."""
    for page in pages:
        one_column([page], expression)
    times = [[] for _ in pages]
    for _ in range(3):
        for i, page in enumerate(pages):
            started = time.perf_counter()
            one_column([page], expression)
            times[i].append(time.perf_counter() - started)
    return [min(t) for t in times]


def test_unclosed_tags_cost_no_more_than_others(one_column):
    sizes = F.transform(html.nodes(F.col("v")), lambda n: n.end_id)
    short, long = _seconds(one_column, ["<p>t" * 8_000, "<p>t" * 16_000], sizes)
    assert long < 2.6 * short, (short, long)


def test_text_of_nested_elements_costs_no_more_than_its_length(one_column):
    def lengths(doc):
        return F.transform(S.find_all(doc.nodes, S.is_element), lambda e: F.length(F.concat(S.text_stripped(doc, e), S.text_raw(doc, e), S.text_lines(doc, e), F.coalesce(S.single_string(doc, e), F.lit("")))))

    expression = let(html.page(F.col("v")), lengths)
    short, long = _seconds(one_column, ["<div>" * n + "text" + "</div>" * n for n in (2_500, 5_000)], expression)
    assert one_column(["<div>" * 5_000 + "text" + "</div>" * 5_000], expression)[0] == [16] * 5_000
    assert long < 3 * short, (short, long)
