from pyspark.sql import functions as F

from pressloom.functions import content, html, text
from pressloom.functions import select as S


def read(one_column, page, mode):
    expression = text.let(
        html.page(F.col("v")),
        lambda d: text.let(S.find_first(d.nodes, S.has_tag("main")), lambda e: mode(d, e)),
    )
    return one_column([f"<main>{page}</main>"], expression)[0]


def test_inline_tags_fuse_words(one_column):
    assert read(one_column, "<p>one <b>two</b> three</p>", content.paragraphs) == "onetwothree"


def test_blank_paragraphs(one_column):
    page = "<p>a</p><p> </p><p>b</p>"
    assert read(one_column, page, content.paragraphs_all) == "a\n\n\n\nb"
    assert read(one_column, page, content.paragraphs) == "a\n\nb"


def test_unclosed_paragraph_repeats_text(one_column):
    assert read(one_column, "<p>a<p>b</p>", content.paragraphs) == "ab\n\nb"


def test_break_inside_a_paragraph_comes_after_it(one_column):
    assert read(one_column, "<p>a<br>b</p><br><p>c</p>", content.paragraphs_and_breaks) == "ab\n\n\n\nc"


def test_every_string_repeats_paragraph_text(one_column):
    got = read(one_column, "<p>a <b>x</b></p>bare", content.all_strings)
    assert got == "ax\n\na\nx\nx\nbare"


def test_blocks(one_column):
    page = (
        "lead<p>p</p><ul><li>a</li><li>b<ul><li>c</li></ul></li></ul><ol><li>x</li></ol><br>"
        "<div class='a media-item'>v</div><div>kept</div><div>lo<b>st</b></div><!-- note -->"
    )
    assert read(one_column, page, content.blocks) == (
        "lead\np\n\n• a\n• bc\n• c\n\n1. x\n\n[Embedded media content]\n\nkept\nnote"
    )


def test_lines(one_column):
    assert read(one_column, " a <i> b </i><p> </p>c", content.lines) == "a\nb\nc"


def test_page_fallback(one_column):
    nested = "<div id=newscontent><div class=article><div id=press>{}</div></div></div>"
    assert read(one_column, "<p> a  b </p><p></p>", content.page_fallback) == "a  b"
    assert read(one_column, nested.format("<div>x</div><div>y</div>z"), content.page_fallback) == "x\n\ny"
    assert read(one_column, nested.format(" only "), content.page_fallback) == "only"
    assert read(one_column, "nothing", content.page_fallback) is None


def once(doc, element):
    return content.all_strings(doc, element, F.lit(True))


def test_each_string_once(one_column):
    assert read(one_column, "<p>a <b>x</b></p>bare", once) == "ax\n\nbare"
    assert read(one_column, "<p> </p><i>x</i><b><u>y</u></b><div><p>q</p>r</div>", once) == "x\ny\nq\n\nr"
    assert read(one_column, "<p>a<br>b<p>c</p>d", once) == "abcd\n\n\n".strip()
    assert read(one_column, "<p><br></p>a" * 300, once).count("a") == 300


def test_texts_beside_each_other(one_column):
    """Every text form of every element against strings joined node by node."""
    pages = ["", "x", "<p> a <b>b </b>\n c</p><script>s</script>é<i>\u2003</i>", "<div><p>a\n\nb </p><!--c--> 日本 </div>t", "<p>" * 50 + " x " + "</p>y" * 50]
    forms = (lambda d, n: S.text_raw(d, n), lambda d, n: S.text_stripped(d, n), lambda d, n: S.text_lines(d, n))
    expression = text.let(html.page(F.col("v")), lambda d: F.transform(d.nodes, lambda n: F.struct(
        n.node_id.alias("id"), n.end_id.alias("end"), n.kind.alias("kind"), n.text.alias("text"),
        F.array(*(form(d, n) for form in forms)).alias("forms"))))
    for nodes in one_column(pages, expression):
        for n in nodes:
            own = [m.text for m in nodes if n.id <= m.id < n.end and m.kind == "T"]
            shown = [t.strip() for t in own]
            assert list(n.forms) == ["".join(own).strip(), "".join(shown), "\n".join(t for t in shown if t)]
