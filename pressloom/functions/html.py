"""Markup to an ordered node array, one page row at a time.

Everything here is a Column expression over the ``html`` string, so a page is
parsed where its row lies: no shuffle and no Python worker.  The result is an
array of nodes in document order with interval numbering: node ``d`` lies
inside element ``a`` iff ``a.node_id < d.node_id < a.end_id``.  Because ids are
positions in the array, a subtree is a ``slice``.  Beside the nodes stand the
page's readable texts, joined once, and where each node's begin in them, so
the text of an element is a piece of a string.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.text import NON_SPACE, let, scan, strip
from pressloom.session import built_once

# Elements that never have content.
VOID_TAGS = (
    "area", "base", "basefont", "bgsound", "br", "col", "command", "embed",
    "frame", "hr", "image", "img", "input", "isindex", "keygen", "link",
    "menuitem", "meta", "nextid", "param", "source", "spacer", "track", "wbr",
)

# Elements whose text is not part of the page's readable text.
SPECIAL_TEXT_TAGS = ("script", "style", "template", "rt", "rp")

# Elements in which blank text is kept as it is.
PREFORMATTED_TAGS = ("pre", "textarea")

_LIMITS = ("applet", "button", "caption", "html", "marquee", "object", "table", "td", "template", "th")

# The end tags that HTML implies.  A start tag of the first list
# closes open elements of the second, unless one of the third lies between.
IMPLIED_ENDS = (
    (("address", "article", "aside", "blockquote", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
      "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup",
      "hr", "li", "listing", "main", "menu", "nav", "ol", "p", "plaintext", "pre", "search", "section", "summary",
      "table", "ul", "xmp"), ("p",), _LIMITS),
    (("li",), ("li",), (*_LIMITS, "dir", "menu", "ol", "ul")),
    (("dd", "dt"), ("dd", "dt"), (*_LIMITS, "dl")),
    (("option", "optgroup"), ("option",), ("optgroup", "select", "datalist", "template")),
    (("optgroup",), ("optgroup",), ("select", "template")),
    (("td", "th"), ("td", "th"), ("html", "table", "template", "tr")),
    (("tr",), ("td", "th", "tr"), ("html", "table", "tbody", "template", "tfoot", "thead")),
    (("tbody", "tfoot", "thead"), ("caption", "colgroup", "tbody", "td", "tfoot", "th", "thead", "tr"), ("html", "table", "template")),
    (("rb", "rp", "rt", "rtc"), ("rb", "rp", "rt"), ("ruby", "rtc")),
)

# Begins the stand-in for a "<" that opens no markup, and that for itself, while
# the page is cut into tokens.
MARK = "\ufdd0"

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_OPAQUE = "|".join(
    rf"<{tag}(?:[\s/]{_ATTRIBUTES})?>.*?(?:</\s*{tag}\s*>|\z)" for tag in ("script", "style")
)
TOKEN_PATTERN = (
    r"(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
    rf"|{_OPAQUE}"
    rf"|</[^>]*>|<[!?][^>]*>|<[a-z]{_ATTRIBUTES}>|<[a-z][^>]*>|[^<]+|<[^<]*"
)
TAG_NAME = r"^</?([A-Za-z][^\s/>]*)"
ATTRIBUTE_PATTERN = r"""([^\s/=][^\s/=]*)(\s*=+\s*("[^"]*"|'[^']*'|[^\s]*))?"""

# Tags per inner step of the tree fold; see ``_walk``.
CHUNK = 64

NODE = (
    "struct<node_id:int,end_id:int,parent_id:int,depth:int,kind:string,tag:string,"
    "attrs:map<string,string>,classes:array<string>,text:string>"
)


# -- entities ---------------------------------------------------------------

_COMMON_ENTITIES = ("amp", "lt", "gt", "quot", "nbsp", "copy", "middot")


def _entity_tables() -> tuple[Column, Column]:
    """Short and full name maps, taken from the standard HTML entity list."""
    names = {name.rstrip(";"): value for name, value in html5.items()}

    def as_map(keys) -> Column:
        keys = list(keys)
        return F.map_from_arrays(
            F.split(F.lit(" ".join(keys)), " "),
            F.split(F.lit("\x00".join(names[k] for k in keys)), "\x00"),
        )

    return as_map(_COMMON_ENTITIES), as_map(sorted(names))


# 128-159 are read as windows-1252, as browsers do; its five gaps stay.
_CONTROLS = "".join(map(chr, range(128, 160)))
_LEGACY = "".join(bytes([c]).decode("cp1252", errors="ignore") or chr(c) for c in range(128, 160))


def _from_code_point(number: Column) -> Column:
    """The character with this number; numbers outside Unicode give U+FFFD."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    encoded = F.unhex(F.lpad(F.hex(F.when(valid, number).otherwise(F.lit(0xFFFD))), 8, "0"))
    return F.translate(F.decode(encoded, "UTF-32"), _CONTROLS, _LEGACY)


def _numeric(piece: Column) -> Column:
    """A decimal or hexadecimal reference; leading zeros say nothing, and more digits than any character has are too many."""
    hexits = F.regexp_extract(piece, "^&#[xX]0*([0-9a-fA-F]*);?$", 1)
    digits = F.regexp_extract(piece, "^&#0*([0-9]*);?$", 1)

    def number(found: Column, base: int) -> Column:
        return F.when(F.length(found) > 8, -1).when(found == "", 0).otherwise(F.conv(found, base, 10).cast("long"))

    is_hex = F.rlike(piece, F.lit("^&#[xX]"))
    return _from_code_point(F.when(is_hex, number(hexits, 16)).otherwise(number(digits, 10)))


_NUMBERS = "&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?"


def _decoded(text: Column, names: str, named: Callable[[Column], Column]) -> Column:
    """The text with its references replaced; ``named`` gives null for what is none."""

    def decode(piece: Column) -> Column:
        is_number = F.rlike(piece, F.lit(f"^(?:{_NUMBERS})$"))
        return (
            F.when(~F.startswith(piece, F.lit("&")) | (F.length(piece) == 1), piece)
            .when(is_number, _numeric(piece))
            .otherwise(F.coalesce(named(F.substr(piece, F.lit(2))), piece))
        )

    pieces = F.regexp_extract_all(text, F.lit(f"{_NUMBERS}|{names}|[^&]+|&"), F.lit(0))
    decoded = F.array_join(F.transform(pieces, decode), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def unescape(text: Column) -> Column:
    """Decode named and numeric character references of text."""
    common, full = _entity_tables()

    def named(reference: Column) -> Column:
        name = F.rtrim(reference, F.lit(";"))
        return F.coalesce(common[name], full[name])

    return _decoded(text, "&[A-Za-z][A-Za-z0-9]*;?", named)


def unescape_attribute(text: Column) -> Column:
    """Decode the references of an attribute value.

    A name that ends with a semicolon may be any; without one only the old
    names count, the longest that fits, and the rest of the word stays.
    """
    with_end = {name: value for name, value in html5.items() if name.endswith(";")}
    old = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)

    def as_map(entries: dict[str, str]) -> Column:
        return F.map_from_arrays(
            F.split(F.lit(" ".join(entries)), " "), F.split(F.lit("\x00".join(entries.values())), "\x00"))

    def named(reference: Column) -> Column:
        prefix = F.regexp_extract(reference, "^(" + "|".join(old) + ")", 1)
        rest = F.substring(reference, F.length(prefix) + 1, F.length(reference))
        return F.coalesce(
            as_map(with_end)[reference],
            F.when(prefix != "", F.concat(as_map({n: html5[n] for n in old})[prefix], rest)),
        )

    return _decoded(text, r"&[^\t\n\f <&#;]{1,32};?", named)


# -- tokens -----------------------------------------------------------------


STRAY_PATTERN = "<(?![A-Za-z/!?])"


def _mask_stray(html: Column) -> Column:
    """The page with every stray ``<`` as mark and 1, and every mark of its own as mark and 0."""
    kept = F.replace(html, F.lit(MARK), F.lit(f"{MARK}0"))
    masked = F.regexp_replace(kept, STRAY_PATTERN, f"{MARK}1")
    needed = F.contains(html, F.lit(MARK)) | F.rlike(html, F.lit(STRAY_PATTERN))
    return F.when(needed, masked).otherwise(html)


def _unmask(raw: Column) -> Column:
    back = F.replace(F.replace(raw, F.lit(f"{MARK}1"), F.lit("<")), F.lit(f"{MARK}0"), F.lit(MARK))
    return F.when(F.contains(raw, F.lit(MARK)), back).otherwise(raw)


def _token(op: Column | str, tag: Column, raw: Column) -> Column:
    op = F.lit(op) if isinstance(op, str) else op
    return F.struct(op.alias("op"), tag.alias("tag"), raw.alias("raw"))


def _classify_tag(raw: Column) -> Column:
    """A start or end tag; script and style elements come as one piece."""

    def typed(tag: Column) -> Column:
        # "/>" closes the element at once, unless the slash ends a bare value.
        self_closing = F.endswith(raw, F.lit("/>")) & ~F.rlike(
            raw, F.lit(r"""=\s*[^\s"'>][^\s"'>]*/>$""")
        )
        head = F.regexp_extract(raw, rf"(?is)^<[a-z]+(?:[\s/]{_ATTRIBUTES})?>", 0)
        tail = F.regexp_extract(raw, r"(?is)</\s*(?:script|style)\s*>$", 0)
        body = F.substring(
            raw, F.length(head) + 1, F.length(raw) - F.length(head) - F.length(tail)
        )
        parts = F.array(
            _token("open", tag, head), _token("raw", F.lit(""), body), _token("close", tag, tail)
        )
        opaque = tag.isin("script", "style") & ~F.endswith(raw, F.lit("/>"))
        return (
            F.when(F.startswith(raw, F.lit("</")), F.array(_token("close", tag, raw)))
            .when(opaque, F.filter(parts, lambda t: t.raw != ""))
            .when(tag.isin(*VOID_TAGS) | self_closing, F.array(_token("void", tag, raw)))
            .otherwise(F.array(_token("open", tag, raw)))
        )

    return let(F.lower(F.regexp_extract(raw, TAG_NAME, 1)), typed)


def _classify(raw: Column) -> Column:
    """One raw token to its one or (script, style) three typed tokens."""
    second = F.substring(raw, 2, 1)
    mark = F.startswith(raw, F.lit("<"))
    closed = F.endswith(raw, F.lit(">"))
    other = (
        F.when(~(mark & second.isin("/", "!", "?")) | ~closed, "text")
        .when(second == "/", "comment")
        .when(F.startswith(raw, F.lit("<!--")), "comment")
        .when(F.rlike(raw, F.lit(r"(?i)^<!\[CDATA\[")), "cdata")
        .otherwise("decl")
    )
    is_tag = mark & closed & F.rlike(raw, F.lit("^</?[A-Za-z]"))
    return F.when(is_tag, _classify_tag(raw)).otherwise(
        F.array(_token(other, F.lit(""), raw))
    )


def tokens(html: Column) -> Column:
    """Lossless cut of the page into typed tokens, in order.

    ``op`` is one of open, close, void, text, raw (script or style body),
    comment, cdata, decl; the ``raw`` parts joined give the page back.
    """
    pieces = F.regexp_extract_all(_mask_stray(html), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.flatten(F.transform(pieces, lambda t: let(_unmask(t), _classify)))


# -- tree -------------------------------------------------------------------

_OPEN = "struct<id:int,special:boolean,pre:boolean,depths:array<int>>"
_PLACE = "struct<n:int,parent_id:int,depth:int,ordinal:int,within:int,depth_within:int,special:boolean,pre:boolean>"
_SPAN = "struct<node_id:int,end_id:int>"


def _rules_by_tag(which: int) -> Column:
    """For each tag the numbers of the rules that name it in that place."""
    tags = sorted({tag for rule in IMPLIED_ENDS for tag in rule[which]})
    numbers = [[i for i, rule in enumerate(IMPLIED_ENDS) if tag in rule[which]] for tag in tags]
    return F.map_from_arrays(F.array(*map(F.lit, tags)), F.array(*(F.array(*map(F.lit, n)) for n in numbers)))


def _depths_within(outer: Column, tag: Column, depth: Column) -> Column:
    """For each rule the depth of the outermost element it would end, inside a new element."""
    limits, targets = (F.coalesce(_rules_by_tag(i)[tag], F.array().cast("array<int>")) for i in (2, 1))
    before = F.coalesce(outer, F.array(*(F.lit(0) for _ in IMPLIED_ENDS)))
    return F.transform(
        before,
        lambda d, rule: F.when(F.array_contains(targets, rule), F.when(d == 0, depth).otherwise(d))
        .when(F.array_contains(limits, rule), 0)
        .otherwise(d),
    )


class _Stack:
    """Open elements inside a chunk: those it opened, innermost first, and those left of what was open before.

    What was open before is only read, and ``gone`` counts how many of them
    were closed: the state that a fold hands on is copied at each step, so it
    must not hold what does not change.
    """

    def __init__(self, state: Column, before: Column):
        self.state, self.before = state, before
        self.own = F.size(state.tags)
        self.depth = self.own + F.size(before.tags) - state.gone
        self.top = F.coalesce(F.get(state.open, F.lit(0)), F.get(before.open, state.gone))

    def up_to(self, tag: Column) -> Column:
        """How many levels up the nearest element of that name is, itself counted; 0 if there is none."""
        state, before = self.state, self.before

        def further() -> Column:
            rest = F.slice(before.tags, state.gone + 1, F.size(before.tags))
            return let(F.array_position(rest, tag).cast("int"), lambda at: F.when(at > 0, self.own + at).otherwise(0))

        return let(
            F.array_position(state.tags, tag).cast("int"),
            lambda near: F.when(near > 0, near)
            .when(F.get(before.tags, state.gone) == tag, self.own + 1)
            .when(F.array_contains(before.tags, tag), further())
            .otherwise(0),
        )

    def ended_by(self, tag: Column) -> Column:
        """How many levels a start tag ends, by the outermost element that a rule of its finds."""
        found = F.filter(F.transform(_rules_by_tag(0)[tag], lambda rule: F.get(self.top.depths, rule)), lambda d: d > 0)
        return F.coalesce(self.depth - F.array_min(found) + 1, F.lit(0))


def _without(state: Column, before: Column, up: Column) -> Column:
    """The state without its so many innermost elements."""
    own = F.size(state.tags)

    def ends(ids: Column) -> Column:
        return F.concat(state.spans, F.transform(ids, lambda i: F.struct(i.alias("node_id"), (state.n + 1).alias("end_id"))))

    def left(gone: Column, ids: Column) -> Column:
        near = up < own
        return F.struct(
            F.when(near, F.slice(state.tags, up + 1, own)).otherwise(F.array().cast("array<string>")).alias("tags"),
            F.when(near, F.slice(state.open, up + 1, own)).otherwise(F.array().cast(f"array<{_OPEN}>")).alias("open"),
            gone.alias("gone"), state.n.alias("n"), state.opened.alias("opened"), state.places.alias("places"),
            ends(ids).alias("spans"),
        )

    ids = F.transform(F.slice(state.open, F.lit(1), up), lambda e: e.id)
    older = F.transform(
        F.sequence(state.gone, state.gone + up - own - 1), lambda i: F.get(before.open, i).id)
    return (
        F.when(up <= 0, state)
        .when(up <= own, left(state.gone, ids))
        .otherwise(left(state.gone + up - own, F.concat(F.transform(state.open, lambda e: e.id), older)))
    )


def _step(state: Column, item: Column, before: Column, implied: Column) -> Column:
    """A tag: it closes what it ends, may open an element, and places the leaves up to the next tag."""
    is_open = item.op == "open"

    def up(stack: _Stack) -> Column:
        ended = F.when(item.op == "close", stack.up_to(item.tag))
        return F.coalesce(ended.when(implied & item.op.isin("open", "void"), stack.ended_by(item.tag)), F.lit(0))

    def placed(now: Column) -> Column:
        stack = _Stack(now, before)
        top = stack.top
        parent = F.coalesce(top.id, F.lit(0))
        entry = F.struct(
            (now.n + 1).alias("id"),
            (F.coalesce(top.special, F.lit(False)) | item.tag.isin(*SPECIAL_TEXT_TAGS)).alias("special"),
            (F.coalesce(top.pre, F.lit(False)) | item.tag.isin(*PREFORMATTED_TAGS)).alias("pre"),
            F.when(implied, _depths_within(top.depths, item.tag, stack.depth + 1)).alias("depths"),
        ).cast(_OPEN)
        inner = F.when(is_open, entry).otherwise(top)
        place = F.struct(
            now.n.alias("n"), parent.alias("parent_id"), stack.depth.alias("depth"),
            F.when(is_open, now.opened + 1).otherwise(0).alias("ordinal"),
            F.coalesce(inner.id, F.lit(0)).alias("within"),
            (stack.depth + F.when(is_open, 1).otherwise(0)).alias("depth_within"),
            F.coalesce(inner.special, F.lit(False)).alias("special"), F.coalesce(inner.pre, F.lit(False)).alias("pre"),
        )
        return F.struct(
            F.when(is_open, F.concat(F.array(item.tag), now.tags)).otherwise(now.tags).alias("tags"),
            F.when(is_open, F.concat(F.array(entry), now.open)).otherwise(now.open).alias("open"),
            now.gone.alias("gone"),
            (now.n + F.when(item.op.isin("open", "void"), 1).otherwise(0) + item.leaves).alias("n"),
            F.when(is_open, now.opened + 1).otherwise(now.opened).alias("opened"),
            F.concat(now.places, F.array(place)).alias("places"),
            now.spans.alias("spans"),
        )

    return let(let(up(_Stack(state, before)), lambda levels: _without(state, before, levels)), placed)


def _walk(items: Column, implied: Column) -> Column:
    """Places of all tags, and spans of the elements they open.

    A fold hands its state on by copying it, and appending copies an array, so
    one flat fold would cost the square of the number of tags.  It therefore
    runs over chunks: the inner fold keeps what a chunk made, the outer one
    collects it, with the elements that are open between two chunks.
    """
    count = F.size(items)
    starts = F.when(
        count > 0, F.sequence(F.lit(1), count, F.lit(CHUNK))
    ).otherwise(F.array().cast("array<int>"))
    no_tags, no_open = F.array().cast("array<string>"), F.array().cast(f"array<{_OPEN}>")
    no_places, no_spans = F.array().cast(f"array<{_PLACE}>"), F.array().cast(f"array<{_SPAN}>")

    def outer_step(outer: Column, start: Column) -> Column:
        fresh = F.struct(
            no_tags.alias("tags"), no_open.alias("open"), F.lit(0).alias("gone"), outer.n.alias("n"),
            outer.opened.alias("opened"), no_places.alias("places"), no_spans.alias("spans"),
        )
        made = F.aggregate(
            F.slice(items, start, F.lit(CHUNK)), fresh, lambda state, item: _step(state, item, outer, implied))

        def left(own: Column, before: Column, gone: Column) -> Column:
            return F.concat(own, F.when(gone > 0, F.slice(before, gone + 1, F.size(before))).otherwise(before))

        return let(made, lambda last: F.struct(
            left(last.tags, outer.tags, last.gone).alias("tags"), left(last.open, outer.open, last.gone).alias("open"),
            last.n.alias("n"), last.opened.alias("opened"),
            F.concat(outer.places, F.array(last.places)).alias("places"),
            F.concat(outer.spans, F.array(last.spans)).alias("spans"),
        ))

    start = F.struct(
        no_tags.alias("tags"), no_open.alias("open"), F.lit(0).alias("n"), F.lit(0).alias("opened"),
        F.array().cast(f"array<array<{_PLACE}>>").alias("places"), F.array().cast(f"array<array<{_SPAN}>>").alias("spans"),
    )

    def finish(outer: Column) -> Column:
        left_open = F.transform(outer.open, lambda e: F.struct(e.id.alias("node_id"), (outer.n + 1).alias("end_id")))
        # Every element has one span; sorted by id they stand in open order.
        return F.struct(
            F.flatten(outer.places).alias("places"),
            F.sort_array(F.concat(F.flatten(outer.spans), left_open)).alias("spans"),
        )

    return F.aggregate(starts, start, outer_step, finish)


def attributes(raw_tag: Column) -> Column:
    """Attribute map of a start tag; the last of duplicate names wins."""
    inner = F.regexp_replace(raw_tag, r"(?s)^<[^\s/>]+|/?>$", "")
    names = F.regexp_extract_all(inner, F.lit(ATTRIBUTE_PATTERN), F.lit(1))
    values = F.regexp_extract_all(inner, F.lit(ATTRIBUTE_PATTERN), F.lit(3))

    def entry(name: Column, value: Column) -> Column:
        quoted = F.rlike(value, F.lit("(?s)^(\".*\"|'.*')$"))
        bare = F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
        return F.struct(F.lower(name).alias("key"), unescape_attribute(bare).alias("value"))

    entries = F.zip_with(names, values, entry)

    def unique(all_entries: Column) -> Column:
        keys = F.transform(all_entries, lambda e: e.key)
        kept = F.filter(
            all_entries,
            lambda e, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), e.key),
        )
        return F.map_from_entries(kept)

    has_any = F.rlike(raw_tag, F.lit(r"^<[^\s/>]+[\s/]"))
    return F.when(has_any, let(entries, unique)).otherwise(
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    )


def class_list(attrs: Column) -> Column:
    value = attrs["class"]
    found = F.regexp_extract_all(value, F.lit(f"{NON_SPACE}+"), F.lit(0))
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(found)


def _node_text(token: Column, pre: Column) -> Column:
    raw = token.raw
    blank = F.rlike(raw, F.lit(r"^[ \n\t\f\r]+$")) & ~pre
    squeezed = F.when(F.contains(raw, F.lit("\n")), "\n").otherwise(" ")
    comment = F.regexp_replace(raw, "(?s)^<!--(.*)-->$|^</(.*)>$", "$1$2")
    return (
        F.when(token.op == "text", F.when(blank, squeezed).otherwise(unescape(raw)))
        .when(token.op == "raw", raw)
        .when(token.op == "comment", comment)
        .when(token.op == "cdata", F.substring(raw, F.lit(10), F.length(raw) - 12))
        .when(token.op == "decl", F.regexp_replace(raw, "(?s)^<[!?]|>$", ""))
    )


def _leaf_kind(op: Column, special: Column) -> Column:
    return (
        F.when(op == "void", "E")
        .when(op == "raw", "S")
        .when(op.isin("text", "cdata"), F.when(special & (op == "text"), "S").otherwise("T"))
        .when(op == "comment", "C")
        .otherwise("D")
    )


def _node(token: Column, node_id: Column, end_id: Column, parent: Column, depth: Column, kind: Column, pre: Column) -> Column:
    is_element = kind == "E"
    return let(
        F.when(is_element, attributes(token.raw)),
        lambda a: F.struct(
            node_id.alias("node_id"), end_id.alias("end_id"), parent.alias("parent_id"), depth.alias("depth"),
            kind.alias("kind"), F.when(is_element, token.tag).alias("tag"), a.alias("attrs"),
            F.when(is_element, class_list(a)).alias("classes"),
            _node_text(token, pre & (token.op == "text")).alias("text"),
        ),
    )


def nodes(html: Column, implied: Column | None = None) -> Column:
    """The page's nodes in document order.

    ``kind`` is E (element), T (readable text), S (text of script, style and
    the like), C (comment) or D (declaration).  An end tag closes everything up
    to the nearest open element of its name; one without a match is ignored.
    No end tag is implied, unless ``implied`` is true: then start tags end what
    HTML lets them end (see ``IMPLIED_ENDS``).
    """
    implied = F.lit(False) if implied is None else F.coalesce(implied, F.lit(False))
    enders = sorted(_rules_starts().intersection(VOID_TAGS))

    def is_tag(token: Column) -> Column:
        return token.op.isin("open", "close") | (implied & (token.op == "void") & token.tag.isin(*enders))

    def build(token_array: Column) -> Column:
        # A tag with the leaves up to the next one; the first stands for the page's begin.
        at = F.concat(
            F.array(F.lit(-1)),
            F.filter(F.transform(token_array, lambda t, i: F.when(is_tag(t), i)), lambda i: i.isNotNull()),
        )

        def walk(places_of: Column) -> Column:
            items = F.transform(
                places_of,
                lambda i, j: let(F.get(token_array, i), lambda t: F.struct(
                    F.coalesce(t.op, F.lit("begin")).alias("op"), F.coalesce(t.tag, F.lit("")).alias("tag"),
                    (F.coalesce(F.get(places_of, j + 1), F.size(token_array)) - i - 1).alias("leaves"),
                )),
            )
            return let(items, lambda all_of: let(_walk(all_of, implied), lambda walked: assemble(places_of, all_of, walked)))

        def assemble(places_of: Column, items: Column, walked: Column) -> Column:
            def run(item: Column, j: Column) -> Column:
                place, i = F.get(walked.places, j), F.get(places_of, j)
                has_head = item.op.isin("open", "void")
                end_id = F.when(place.ordinal > 0, F.get(walked.spans, place.ordinal - 1).end_id).otherwise(place.n + 2)
                head = F.when(has_head, F.array(let(F.get(token_array, i), lambda t: _node(
                    t, place.n + 1, end_id, place.parent_id, place.depth, F.lit("E"), F.lit(False)))))
                before = place.n + F.when(has_head, 1).otherwise(0)

                def leaf(k: Column) -> Column:
                    return let(F.get(token_array, i + k), lambda t: _node(
                        t, before + k, before + k + 1, place.within, place.depth_within, _leaf_kind(t.op, place.special), place.pre))

                leaves = F.when(item.leaves > 0, F.transform(F.sequence(F.lit(1), item.leaves), leaf))
                none = F.array().cast(f"array<{NODE}>")
                return F.concat(F.coalesce(head, none), F.coalesce(leaves, none))

            return F.flatten(F.transform(items, run))

        return let(at, walk)

    return let(tokens(html), build)


def _rules_starts() -> set[str]:
    return {tag for starts, _, _ in IMPLIED_ENDS for tag in starts}


def page(html: Column, implied: Column | None = None) -> Column:
    """Struct of the page's ``nodes`` and its readable texts.

    ``raw`` has the texts as they are, ``glued`` without white space around
    them, ``lined`` those that are left with a newline after each, as bytes;
    ``at`` says for each node, and at last for the page's end, where in them
    its own begin.
    """

    def with_texts(all_nodes: Column) -> Column:
        raw = F.transform(all_nodes, lambda n: F.when(n.kind == "T", n.text).otherwise(""))
        return let(raw, lambda texts: let(F.transform(texts, strip), lambda shown: joined(all_nodes, texts, shown)))

    def joined(all_nodes: Column, texts: Column, shown: Column) -> Column:
        sizes = F.zip_with(texts, shown, lambda t, s: F.struct(
            F.octet_length(t).alias("raw"), F.octet_length(s).alias("glued"),
            F.when(s == "", 0).otherwise(F.octet_length(s) + 1).alias("lined")))
        start = F.struct(*(F.lit(0).alias(form) for form in ("raw", "glued", "lined")))

        def step(before: Column, size: Column) -> Column:
            after = F.struct(*((before[form] + size[form]).alias(form) for form in ("raw", "glued", "lined")))
            return F.struct(after.alias("state"), before.alias("out"))

        end = F.struct(F.lit(0).alias("raw"), F.lit(0).alias("glued"), F.lit(0).alias("lined"))
        lines = F.transform(F.filter(shown, lambda s: s != ""), lambda s: F.concat(s, F.lit("\n")))
        return F.struct(
            all_nodes.alias("nodes"), F.array_join(texts, "").cast("binary").alias("raw"),
            F.array_join(shown, "").cast("binary").alias("glued"), F.array_join(lines, "").cast("binary").alias("lined"),
            scan(F.concat(sizes, F.array(end)), start, step, "struct<raw:int,glued:int,lined:int>").alias("at"),
        )

    return let(nodes(html, implied), with_texts)


@built_once
def page_of(column: str = "html", p_mode: str | None = None) -> Column:
    """A markup column as a page; a column may hold ``html5`` where end tags are implied."""
    return page(F.col(column), None if p_mode is None else F.col(p_mode) == "html5")


@built_once
def nodes_of(column: str = "html") -> Column:
    """The node array of a markup column."""
    return nodes(F.col(column))


def sibling_numbers(all_nodes: Column) -> Column:
    """For each node its position among its parent's children, from 1.

    Sorted by parent, children stand together in document order.
    """
    by_parent = F.sort_array(F.transform(all_nodes, lambda n: F.struct(n.parent_id.alias("parent"), n.node_id.alias("id"))))

    def step(last: Column, child: Column) -> Column:
        no = F.when(child.parent == last.parent, last.no + 1).otherwise(1)
        return F.struct(
            F.struct(child.parent.alias("parent"), no.alias("no")).alias("state"),
            F.struct(child.id.alias("id"), no.alias("no")).alias("out"))

    start = F.struct(F.lit(-1).alias("parent"), F.lit(0).alias("no"))
    numbered = scan(by_parent, start, step, "struct<id:int,no:int>")
    return F.transform(F.sort_array(numbered), lambda n: n.no)


def node_table(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per node; ``sibling_no`` is its position among its parent's children, from 1."""
    numbered = let(nodes_of(), lambda all_of: F.arrays_zip(all_of.alias("node"), sibling_numbers(all_of).alias("sibling_no")))
    rows = pages.select(key, F.inline(numbered).alias("node", "sibling_no"))
    return rows.select(key, "node.*", "sibling_no")
