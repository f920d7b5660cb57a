"""URL handling as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import let

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"


def _parts(url: Column) -> Column:
    """Scheme, authority, path, query and fragment, with their marks kept."""
    rest = F.regexp_replace(url, _SCHEME, "")
    authority = F.regexp_extract(rest, "^(//[^/?#]*)", 1)
    after = F.substring(rest, F.length(authority) + 1, F.length(rest))
    return F.struct(
        F.regexp_extract(url, _SCHEME, 1).alias("scheme"),
        authority.alias("authority"),
        F.regexp_extract(after, "^([^?#]*)", 1).alias("path"),
        F.regexp_extract(after, r"^[^?#]*(\?[^#]*)", 1).alias("query"),
        F.regexp_extract(after, "(#.*)$", 1).alias("fragment"),
    )


def _resolve_dots(segments: Column) -> Column:
    """Drop "." segments and let each ".." take the segment before it."""
    nothing = F.array().cast("array<string>")
    kept = F.aggregate(
        segments,
        nothing,
        lambda path, s: F.when(s == ".", path)
        .when((s == "..") & (F.size(path) == 0), path)
        .when(s == "..", F.slice(path, F.lit(1), F.size(path) - 1))
        .otherwise(F.concat(path, F.array(s))),
    )
    ends_in_dots = F.element_at(segments, -1).isin(".", "..")
    return F.when(ends_in_dots, F.concat(kept, F.array(F.lit("")))).otherwise(kept)


def _merged_path(base_path: Column, path: Column) -> Column:
    parts = F.split(path, "/")

    def relative(parents: Column) -> Column:
        # An empty last part means the base is a folder.
        kept = F.when(F.element_at(parents, -1) == "", parents).otherwise(
            F.slice(parents, F.lit(1), F.size(parents) - 1)
        )
        joined = F.concat(kept, parts)
        inner = F.filter(
            joined, lambda s, i: (s != "") | (i == 0) | (i == F.size(kept) + F.size(parts) - 1)
        )
        return _resolve_dots(inner)

    segments = F.when(F.startswith(path, F.lit("/")), _resolve_dots(parts)).otherwise(
        let(F.split(base_path, "/"), relative)
    )
    return let(
        F.array_join(segments, "/"),
        lambda p: F.when(F.startswith(p, F.lit("/")), p).otherwise(F.concat(F.lit("/"), p)),
    )


def join_url(base: Column, href: Column) -> Column:
    """The absolute URL a link on page ``base`` points to."""

    def resolve(b: Column) -> Column:
        def against(h: Column) -> Column:
            origin = F.concat(b.scheme, F.lit(":"), b.authority)
            return (
                F.when(h.authority != "", F.concat(b.scheme, F.lit(":"), href))
                .when(
                    h.path == "",
                    F.concat(
                        origin, b.path,
                        F.when(h.query == "", b.query).otherwise(h.query), h.fragment,
                    ),
                )
                .otherwise(F.concat(origin, _merged_path(b.path, h.path), h.query, h.fragment))
            )

        return let(_parts(href), against)

    return (
        F.when(href == "", base)
        .when(F.rlike(href, F.lit(_SCHEME)), href)
        .otherwise(let(_parts(base), resolve))
    )


def robots_url(url: Column) -> Column:
    """Where the site of ``url`` keeps its robots file."""
    return let(
        _parts(url), lambda p: F.concat(p.scheme, F.lit(":"), p.authority, F.lit("/robots.txt"))
    )


def _unquote(text: Column) -> Column:
    decoded = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), F.coalesce(decoded, text)).otherwise(text)


def robots_path(url_or_path: Column) -> Column:
    """Decoded path with query and fragment, as robots rules compare it."""
    plain = _unquote(url_or_path)
    rest = F.regexp_replace(plain, r"^([A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)?", "")
    return F.regexp_replace(rest, "[?#]+$", "")
