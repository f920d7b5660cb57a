"""Selectors that come from profile columns instead of code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions import select as S
from pressloom.functions.html import NODE
from pressloom.functions.text import let


def matches(doc: Column, node: Column, step: Column) -> Column:
    """Whether a node passes every test the step gives."""

    def unless_given(value: Column, test: Column) -> Column:
        return value.isNull() | F.coalesce(test, F.lit(False))

    element = (
        unless_given(step.tag, node.tag == step.tag)
        & unless_given(step.class_token, F.array_contains(node.classes, step.class_token))
        & unless_given(step.class_exact, F.array_join(node.classes, " ") == step.class_exact)
        & unless_given(step.id, node.attrs["id"] == step.id)
        & unless_given(step.style, node.attrs["style"] == step.style)
        & unless_given(step.href_part, F.contains(node.attrs["href"], step.href_part))
        & (
            step.text_eq.isNull()
            | F.coalesce(S.single_string(doc, node) == step.text_eq, F.lit(False))
        )
    )
    string = F.rlike(node.text, F.concat(F.lit("(?U)"), step.text_re))
    return F.when(step.text_re.isNull(), (node.kind == "E") & element).otherwise(
        (node.kind != "E") & string
    )


def root_of(doc: Column) -> Column:
    """A node around the whole page, to start a path from."""
    return F.struct(
        F.lit(0).alias("node_id"), (F.size(doc.nodes) + 1).alias("end_id"), F.lit(-1).alias("parent_id"),
        F.lit(-1).alias("depth"), F.lit("E").alias("kind"),
        *(F.lit(None).alias(n) for n in ("tag", "attrs", "classes", "text")),
    ).cast(NODE)


def follow(doc: Column, start: Column, steps: Column) -> Column:
    """The node at the end of the path; null where a hop finds nothing."""

    def hop(node: Column, step: Column) -> Column:
        scope = F.when(step.axis == "following", S.following(doc, node)).otherwise(
            S.descendants(doc, node)
        )
        return F.get(F.filter(scope, lambda n: matches(doc, n, step)), step.nth - 1)

    return F.aggregate(steps, start, hop)


def locate(doc: Column, selectors: Column, field: str) -> Column:
    """First selector of ``field`` that finds a node, as struct(node, text_mode)."""
    found = F.transform(
        F.filter(selectors, lambda s: s.field == field),
        lambda s: F.struct(
            let(root_of(doc), lambda root: follow(doc, root, s.steps)).alias("node"),
            s.text_mode.alias("text_mode"),
        ),
    )
    return F.get(F.filter(found, lambda f: f.node.isNotNull()), F.lit(0))


def field_text(doc: Column, selectors: Column, field: str) -> Column:
    """Text of the field's element; null when no selector finds one."""

    def read(hit: Column) -> Column:
        node = hit.node
        links = S.find_all(S.descendants(doc, node), S.has_tag("a"))
        listed = F.array_join(F.transform(links, lambda a: S.text_stripped(doc, a)), ", ")
        return F.when(
            node.isNotNull(),
            F.when(hit.text_mode == "list", listed)
            .when(hit.text_mode == "stripped", S.text_stripped(doc, node))
            .otherwise(S.text_raw(doc, node)),
        )

    return let(locate(doc, selectors, field), read)


def broken_path(doc: Column, selectors: Column) -> Column:
    """Whether a strict selector's path starts on this page but does not end."""

    def broken(selector: Column) -> Column:
        start = let(
            root_of(doc),
            lambda root: follow(doc, root, F.slice(selector.steps, F.lit(1), F.lit(1))),
        )
        end = let(start, lambda n: follow(doc, n, F.slice(selector.steps, F.lit(2), F.size(selector.steps))))
        return selector.strict & start.isNotNull() & end.isNull()

    return F.exists(selectors, broken)
