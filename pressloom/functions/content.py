"""Content modes: how a container's nodes become release text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import select as S
from pressloom.functions.text import collapse_newlines, let, scan, strip

NO_CONTENT = "No content found"


def _paragraphs(doc: Column, element: Column) -> Column:
    found = S.find_all(S.descendants(doc, element), S.has_tag("p"))
    return F.transform(found, lambda p: S.text_stripped(doc, p))


def paragraphs_all(doc: Column, element: Column) -> Column:
    """Every paragraph, blank ones included, a blank line between."""
    return strip(F.array_join(_paragraphs(doc, element), "\n\n"))


def paragraphs(doc: Column, element: Column) -> Column:
    """Non-blank paragraphs, a blank line between."""
    return F.array_join(F.filter(_paragraphs(doc, element), lambda t: t != ""), "\n\n")


def _paragraph_block(doc: Column, node: Column) -> Column:
    return let(
        S.text_stripped(doc, node), lambda t: F.when(t != "", F.concat(t, F.lit("\n\n"))).otherwise("")
    )


def paragraphs_and_breaks(doc: Column, element: Column) -> Column:
    """Paragraph blocks and line breaks in document order."""
    emitted = F.transform(
        S.find_all(S.descendants(doc, element), S.has_tag("p", "br")),
        lambda n: F.when(n.tag == "br", "\n").otherwise(_paragraph_block(doc, n)),
    )
    return strip(F.array_join(emitted, ""))


def _string_line(doc: Column, node: Column) -> Column:
    return let(
        strip(S.single_string(doc, node)),
        lambda t: F.when(t != "", F.concat(t, F.lit("\n"))).otherwise(""),
    )


def all_strings(doc: Column, element: Column, dedupe: Column | None = None) -> Column:
    """Paragraph blocks, breaks, and a line for every other node with one string.

    Text inside a paragraph thus comes again from its own string nodes, and
    once more from each inline element around it.  Where ``dedupe`` is true, a
    node says nothing if one around it gave its text already.
    """

    def pieces(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda p: p.text), "")

    emitted = F.transform(
        S.descendants(doc, element),
        lambda n: F.struct(
            n.node_id.alias("node_id"), n.end_id.alias("end_id"),
            F.when(n.tag == "p", _paragraph_block(doc, n))
            .when(n.tag == "br", "\n")
            .otherwise(_string_line(doc, n)).alias("text"),
            F.coalesce(n.tag == "br", F.lit(False)).alias("is_break"),
        ),
    )
    whole = pieces(emitted) if dedupe is None else let(
        emitted, lambda all_of: F.when(dedupe, F.array_join(_once(all_of), "")).otherwise(pieces(all_of)))
    return strip(collapse_newlines(whole))


def _once(emitted: Column) -> Column:
    """Texts that no node around theirs gave before.

    Nodes come in document order, so a node lies inside an earlier one that
    gave its text just if it begins before the last of those ends.
    """

    def step(covered: Column, node: Column) -> Column:
        gives = (node.text != "") & ~node.is_break & (node.node_id >= covered)
        return F.struct(
            F.when(gives, F.greatest(covered, node.end_id)).otherwise(covered).alias("state"),
            F.when(gives | node.is_break, node.text).otherwise("").alias("out"),
        )

    return scan(F.filter(emitted, lambda n: n.text != ""), F.lit(0), step, "string")


def blocks(doc: Column, element: Column) -> Column:
    """Direct children only: paragraphs, lists, breaks, embeds, single strings."""

    def items(node: Column, mark) -> Column:
        lines = F.transform(
            S.find_all(S.descendants(doc, node), S.has_tag("li")),
            lambda li, i: F.concat(mark(i), S.text_stripped(doc, li), F.lit("\n")),
        )
        return F.concat(F.array_join(lines, ""), F.lit("\n"))

    emitted = F.transform(
        S.children(doc, element),
        lambda n: F.when(n.tag == "p", F.concat(S.text_stripped(doc, n), F.lit("\n\n")))
        .when(n.tag == "ul", items(n, lambda i: F.lit("• ")))
        .when(n.tag == "ol", items(n, lambda i: F.concat((i + 1).cast("string"), F.lit(". "))))
        .when(n.tag == "br", "\n")
        .when(
            (n.tag == "div") & F.array_contains(n.classes, "media-item"),
            "[Embedded media content]\n\n",
        )
        .otherwise(_string_line(doc, n)),
    )
    return strip(collapse_newlines(F.array_join(emitted, "")))


def lines(doc: Column, element: Column) -> Column:
    """All readable strings below, one per line."""
    return S.text_lines(doc, element)


def page_fallback(doc: Column, element: Column | None = None) -> Column:
    """Whole page: its paragraphs, else the press block's divisions, else its text."""
    whole = S.drop_blank(
        F.transform(S.find_all(doc.nodes, S.has_tag("p")), lambda p: S.text_raw(doc, p))
    )
    press = S.attr_is("id", "press")
    nested = S.first(
        S.find_chain(doc, S.attr_is("id", "newscontent"), S.has_class("article"), press)
    )
    divisions = let(
        nested,
        lambda e: S.drop_blank(
            F.transform(
                F.filter(S.children(doc, e), S.has_tag("div")), lambda d: S.text_raw(doc, d)
            )
        ),
    )

    def joined(texts: Column) -> Column:
        return let(texts, lambda t: F.when(F.size(t) > 0, F.array_join(t, "\n\n")))

    any_press = let(S.find_first(doc.nodes, press), lambda e: S.text_raw(doc, e))
    return F.coalesce(joined(whole), joined(divisions), any_press)


MODES = {
    "paragraphs_all": paragraphs_all,
    "paragraphs": paragraphs,
    "paragraphs_and_breaks": paragraphs_and_breaks,
    "all_strings": all_strings,
    "blocks": blocks,
    "lines": lines,
    "page_fallback": page_fallback,
}


def by_mode(mode: Column, doc: Column, element: Column, dedupe: Column | None = None) -> Column:
    """The text under the mode named in a column; only that branch runs."""
    result = None
    for name, build in MODES.items():
        text = build(doc, element, dedupe) if build is all_strings else build(doc, element)
        result = F.when(mode == name, text) if result is None else result.when(mode == name, text)
    return result
