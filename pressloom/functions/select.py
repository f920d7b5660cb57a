"""Selection over a page's nodes.

``doc`` is always one page (see ``html.page``), a scope an array of its nodes.
Elements found are node structs, so a scope is a slice of the array, an
element's text a piece of the page's, and no selection needs a join or a
shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import is_blank, let, strip

Test = Callable[[Column], Column]


# -- tests on one node ------------------------------------------------------


def is_element(node: Column) -> Column:
    return node.kind == "E"


def has_tag(*tags: str) -> Test:
    return lambda node: F.coalesce(node.tag.isin(*tags), F.lit(False))


def has_class(token: str) -> Test:
    return lambda node: F.coalesce(F.array_contains(node.classes, token), F.lit(False))


def class_is(value: str) -> Test:
    """The whole class attribute, its tokens joined by one space."""
    return lambda node: F.coalesce(F.array_join(node.classes, " ") == value, F.lit(False))


def attr_is(name: str, value: str) -> Test:
    return lambda node: F.coalesce(node.attrs[name] == value, F.lit(False))


def has_attr(name: str) -> Test:
    return lambda node: F.coalesce(F.map_contains_key(node.attrs, name), F.lit(False))


def attr_contains(name: str, part: str) -> Test:
    return lambda node: F.coalesce(F.contains(node.attrs[name], F.lit(part)), F.lit(False))


def string_is(doc: Column, value: str) -> Test:
    return lambda node: F.coalesce(single_string(doc, node) == value, F.lit(False))


def string_matches(pattern: str) -> Test:
    """A string node of any kind whose text the pattern finds."""
    return lambda node: (node.kind != "E") & F.rlike(node.text, F.lit(f"(?U){pattern}"))


def every(*tests: Test) -> Test:
    def combined(node: Column) -> Column:
        result = tests[0](node)
        for test in tests[1:]:
            result = result & test(node)
        return result

    return combined


# -- axes -------------------------------------------------------------------


def find_all(scope: Column, test: Test) -> Column:
    return F.filter(scope, test)


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def nth(found: Column, position: int) -> Column:
    return F.get(found, F.lit(position - 1))


def find_first(scope: Column, test: Test) -> Column:
    return first(find_all(scope, test))


def descendants(doc: Column, element: Column) -> Column:
    return F.slice(doc.nodes, element.node_id + 1, element.end_id - element.node_id - 1)


def children(doc: Column, element: Column) -> Column:
    return F.filter(descendants(doc, element), lambda n: n.parent_id == element.node_id)


def following(doc: Column, element: Column) -> Column:
    """Every node after the element's start, also beyond its end."""
    return F.slice(doc.nodes, element.node_id + 1, F.size(doc.nodes))


def is_inside(node: Column, element: Column) -> Column:
    return (node.node_id > element.node_id) & (node.node_id < element.end_id)


def find_chain(doc: Column, *tests: Test) -> Column:
    """Elements passing the last test under ancestors that pass the earlier ones in turn."""

    def narrow(outer: Column, rest: tuple[Test, ...]) -> Column:
        inner = F.filter(
            doc.nodes,
            lambda n: rest[0](n) & F.exists(outer, lambda a: is_inside(n, a)),
        )
        return inner if len(rest) == 1 else let(inner, lambda found: narrow(found, rest[1:]))

    outermost = find_all(doc.nodes, tests[0])
    return outermost if len(tests) == 1 else let(outermost, lambda o: narrow(o, tests[1:]))


# -- text -------------------------------------------------------------------


def _text(doc: Column, node: Column, form: str) -> Column:
    """The node's part of the page's joined text of that form; nothing for what is not readable."""

    def cut(start: Column) -> Column:
        return F.substring(doc[form], start + 1, F.get(doc["at"], node.end_id - 1)[form] - start).cast("string")

    return let(F.when(node.node_id > 0, F.get(doc["at"], node.node_id - 1)[form]).otherwise(0), cut)


def text_raw(doc: Column, node: Column) -> Column:
    """All readable text below, untouched inside, trimmed outside."""
    return strip(_text(doc, node, "raw"))


def text_stripped(doc: Column, node: Column) -> Column:
    """Readable strings below, each trimmed, one after the other."""
    return _text(doc, node, "glued")


def text_lines(doc: Column, node: Column) -> Column:
    """Readable strings below, each trimmed, blank ones dropped, one a line."""
    return F.regexp_replace(_text(doc, node, "lined"), "\n\\z", "")


def single_string(doc: Column, node: Column) -> Column:
    """The node's only string: its own, or the one at the end of an only-child chain."""

    def end_of_chain(last: Column) -> Column:
        # A chain has one node per level and ends in a string.
        chain = (node.end_id - node.node_id - 1 == last.depth - node.depth) & (last.kind != "E")
        return F.when((node.end_id > node.node_id + 1) & chain, last.text)

    return F.when(node.kind != "E", node.text).otherwise(let(F.get(doc.nodes, node.end_id - 2), end_of_chain))


def drop_blank(texts: Column) -> Column:
    return F.filter(texts, lambda t: ~is_blank(t))
