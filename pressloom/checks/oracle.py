"""The queries again, as SQL for DuckDB on the same tables."""

from __future__ import annotations

from pressloom.checks import derived
from pressloom.functions.html import IMPLIED_ENDS
from pressloom.profiles import SITES, Step

ORACLE: dict[str, str] = {}

# White space spelled out for an engine without Unicode classes.
WS = r"\t\n\x0b\x0c\r \x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
STRAY = "chr(64976)"
_ATTR = r"""(?:[^>=]|=\s*(?:"[^"]*"|''[^'']*'')?)*"""
_TOKEN = (
    r"(?is)<!--.*?-->|<!\[CDATA\[.*?\]\]>"
    + "".join(rf"|<{t}(?:[\s/]{_ATTR})?>.*?(?:</\s*{t}\s*>|\z)" for t in ("script", "style"))
    + rf"|</[^>]*>|<[!?][^>]*>|<[a-z]{_ATTR}>|<[a-z][^>]*>|[^<]+|<[^<]*"
)
_VOID = (
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr"
)


def _list(words: str) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


def strip(value: str) -> str:
    return f"regexp_replace({value}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def squeeze(value: str) -> str:
    return rf"regexp_replace({value}, '\n\n\n+', chr(10) || chr(10), 'g')"


def unescape(value: str) -> str:
    pieces = f"regexp_extract_all({value}, '&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;?|[^&]+|&')"
    named = "".join(
        f" WHEN '{name}' THEN {char}"
        for name, char in (
            ("amp", "'&'"), ("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("copy", "'©'"),
            ("middot", "'·'"), ("nbsp", "chr(160)"),
        )
    )
    return (
        f"array_to_string(list_transform({pieces}, lambda p: CASE "
        "WHEN p LIKE '&#x%' OR p LIKE '&#X%' THEN chr(CAST('0x' || rtrim(substr(p, 4), ';') AS INTEGER)) "
        "WHEN p LIKE '&#%' THEN chr(CAST(rtrim(substr(p, 3), ';') AS INTEGER)) "
        f"WHEN p LIKE '&%' THEN CASE rtrim(substr(p, 2), ';'){named} ELSE p END ELSE p END), '')"
    )


def tokens_cte(source: str) -> str:
    return rf"""
src AS MATERIALIZED ({source}),
masked AS (
  SELECT page_id, replace(replace(regexp_replace(html, '<([A-Za-z/!?])', chr(2) || '\1', 'g'),
                                  '<', {STRAY}), chr(2), '<') AS m FROM src
),
listed AS (SELECT page_id, regexp_extract_all(m, '{_TOKEN}') AS ps FROM masked),
pieces AS (
  SELECT page_id, unnest(range(len(ps))) AS k, replace(unnest(ps), {STRAY}, '<') AS p FROM listed
),
named AS (
  SELECT *, lower(regexp_extract(p, '^</?([A-Za-z][^\s/>]*)', 1)) AS name,
         p LIKE '%/>' AND NOT regexp_matches(p, '=\s*[^\s"''>][^\s"''>]*/>$') AS closing
  FROM pieces
),
marked AS (
  SELECT *, regexp_matches(p, '(?is)^<(?:script|style)[\s/>]') AND p NOT LIKE '%/>' AS opaque,
         regexp_extract(p, '(?is)^<[a-z]+(?:[\s/]{_ATTR})?>') AS head,
         regexp_extract(p, '(?is)</\s*(?:script|style)\s*>$') AS tail
  FROM named
),
parts AS (
  SELECT page_id, k * 3 AS k, 'open' AS op, name AS tag, head AS raw FROM marked WHERE opaque
  UNION ALL
  SELECT page_id, k * 3 + 1, 'raw', '', substr(p, length(head) + 1, length(p) - length(head) - length(tail))
  FROM marked WHERE opaque AND length(p) > length(head) + length(tail)
  UNION ALL
  SELECT page_id, k * 3 + 2, 'close', name, tail FROM marked WHERE opaque AND tail <> ''
  UNION ALL
  SELECT page_id, k * 3, op, CASE WHEN op IN ('open', 'void', 'close') THEN name ELSE '' END, p
  FROM (
    SELECT *, CASE
      WHEN p NOT LIKE '<%' THEN 'text'
      WHEN p LIKE '<!--%' THEN 'comment'
      WHEN regexp_matches(p, '(?i)^<!\[CDATA\[') THEN 'cdata'
      WHEN regexp_matches(p, '^<[!?]') THEN 'decl'
      WHEN regexp_matches(p, '^</[A-Za-z]') THEN 'close'
      WHEN p LIKE '</%' THEN 'comment'
      WHEN NOT regexp_matches(p, '(?s)^<[A-Za-z].*>$') THEN 'text'
      WHEN name IN {_list(_VOID)} OR closing THEN 'void'
      ELSE 'open' END AS op
    FROM marked WHERE NOT opaque
  ) plain
),
toks AS MATERIALIZED (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS pos, op, tag, raw FROM parts
)"""


def _kept(tag: str, tags: str) -> str:
    """How many of the open elements a start tag leaves open, each rule sought in the whole list."""
    places = f"range(1, len({tags}) + 1)"

    def rule(starts, ended, limits) -> str:
        low = f"coalesce(list_max(list_filter({places}, lambda i: {tags}[i] IN {_list(' '.join(limits))})), 0)"
        first = f"list_min(list_filter({places}, lambda i: i > {low} AND {tags}[i] IN {_list(' '.join(ended))}))"
        return f"CASE WHEN {tag} IN {_list(' '.join(starts))} THEN coalesce({first} - 1, len({tags})) ELSE len({tags}) END"

    return "least(" + ", ".join(rule(*r) for r in IMPLIED_ENDS) + ")"


_NODES = rf"""
fold AS (
  SELECT DISTINCT page_id, CAST(-1 AS BIGINT) AS pos, CAST([] AS BIGINT[]) AS ids,
         CAST([] AS VARCHAR[]) AS tags, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS closed, CAST(0 AS BIGINT) AS closed_at,
         CAST(0 AS BIGINT) AS parent_id, CAST(0 AS BIGINT) AS depth, false AS special, false AS pre
  FROM toks
  UNION ALL
  SELECT page_id, pos + 1,
         CASE WHEN op = 'open' THEN list_append(ids[:kept], n + 1) WHEN hit > 0 THEN ids[:hit - 1] ELSE ids[:kept] END,
         CASE WHEN op = 'open' THEN list_append(tags[:kept], tag) WHEN hit > 0 THEN tags[:hit - 1] ELSE tags[:kept] END,
         CASE WHEN op = 'close' THEN n ELSE n + 1 END,
         CASE WHEN hit > 0 THEN ids[hit:] ELSE ids[kept + 1:] END, n + 1,
         CAST(CASE WHEN kept > 0 THEN ids[kept] ELSE 0 END AS BIGINT), CAST(kept AS BIGINT),
         op = 'text' AND list_has_any(tags, ['script', 'style', 'template', 'rt', 'rp']),
         op = 'text' AND list_has_any(tags, ['pre', 'textarea'])
  FROM (
    SELECT f.*, t.op, t.tag,
           CASE WHEN t.op = 'close' AND list_contains(f.tags, t.tag)
                THEN len(f.tags) - list_position(list_reverse(f.tags), t.tag) + 1 ELSE 0 END AS hit,
           {{KEPT}} AS kept
    FROM fold f JOIN toks t ON t.page_id = f.page_id AND t.pos = f.pos + 1
  ) s
),
totals AS (SELECT page_id, max(n) AS total FROM fold GROUP BY page_id),
ends AS (SELECT page_id, unnest(closed) AS node_id, closed_at AS end_id FROM fold WHERE len(closed) > 0),
bare AS MATERIALIZED (
  SELECT f.page_id, f.n AS node_id,
         CASE WHEN t.op = 'open' THEN coalesce(e.end_id, x.total + 1) ELSE f.n + 1 END AS end_id,
         f.parent_id, f.depth, f.pre, t.op, t.raw,
         CASE WHEN t.op IN ('open', 'void') THEN 'E' WHEN t.op = 'raw' THEN 'S'
              WHEN t.op IN ('text', 'cdata') THEN CASE WHEN f.special THEN 'S' ELSE 'T' END
              WHEN t.op = 'comment' THEN 'C' ELSE 'D' END AS kind,
         CASE WHEN t.op IN ('open', 'void') THEN t.tag END AS tag
  FROM fold f
  JOIN toks t ON t.page_id = f.page_id AND t.pos = f.pos
  JOIN totals x ON x.page_id = f.page_id
  LEFT JOIN ends e ON e.page_id = f.page_id AND e.node_id = f.n AND t.op = 'open'
  WHERE t.op <> 'close'
),
inner_tags AS (
  SELECT page_id, node_id, regexp_replace(raw, '(?s)^<[^\s/>]+|/?>$', '', 'g') AS body FROM bare WHERE kind = 'E'
),
raw_attrs AS (
  SELECT page_id, node_id, unnest(range(len(names))) AS ord, lower(unnest(names)) AS name, unnest(vals) AS v
  FROM (SELECT page_id, node_id, regexp_extract_all(body, '{{P}}', 1) AS names, regexp_extract_all(body, '{{P}}', 3) AS vals
        FROM inner_tags) a
),
attrs AS MATERIALIZED (
  SELECT page_id, node_id, name, {{UNQUOTED}} AS value
  FROM (SELECT page_id, node_id, name, arg_max(coalesce(v, ''), ord) AS v FROM raw_attrs GROUP BY ALL) last
),
nodes AS MATERIALIZED (
  SELECT b.page_id, b.node_id, b.end_id, b.parent_id, b.depth, b.kind, b.tag,
         regexp_extract_all(coalesce(c.value, ''), '[^{WS}]+') AS cls,
         i.value AS id, s.value AS style, h.value AS href,
         CASE b.op
           WHEN 'text' THEN CASE WHEN NOT b.pre AND regexp_matches(b.raw, '^[ \n\t\f\r]+$')
                                 THEN CASE WHEN contains(b.raw, chr(10)) THEN chr(10) ELSE ' ' END
                                 ELSE {unescape('b.raw')} END
           WHEN 'raw' THEN b.raw
           WHEN 'comment' THEN regexp_replace(b.raw, '(?s)^<!--(.*)-->$|^</(.*)>$', '\1\2')
           WHEN 'cdata' THEN substr(b.raw, 10, length(b.raw) - 12)
           WHEN 'decl' THEN regexp_replace(b.raw, '(?s)^<[!?]|>$', '', 'g') END AS text
  FROM bare b
  LEFT JOIN attrs c ON c.page_id = b.page_id AND c.node_id = b.node_id AND c.name = 'class'
  LEFT JOIN attrs i ON i.page_id = b.page_id AND i.node_id = b.node_id AND i.name = 'id'
  LEFT JOIN attrs s ON s.page_id = b.page_id AND s.node_id = b.node_id AND s.name = 'style'
  LEFT JOIN attrs h ON h.page_id = b.page_id AND h.node_id = b.node_id AND h.name = 'href'
)""".replace("{P}", r"""([^\s/=][^\s/=]*)(\s*=+\s*("[^"]*"|''[^'']*''|[^\s]*))?""").replace(
    "{UNQUOTED}",
    unescape(r"""(CASE WHEN regexp_matches(v, '(?s)^(".*"|''.*'')$') THEN substr(v, 2, length(v) - 2) ELSE v END)"""),
)

_TEXTS = f"""
below AS (
  SELECT e.page_id, e.node_id, string_agg(t.text, '' ORDER BY t.node_id) AS raw_text,
         string_agg({strip('t.text')}, '' ORDER BY t.node_id) AS glued,
         string_agg({strip('t.text')}, chr(10) ORDER BY t.node_id) FILTER (WHERE {strip('t.text')} <> '') AS lined
  FROM nodes e JOIN nodes t ON t.page_id = e.page_id AND t.node_id > e.node_id AND t.node_id < e.end_id
  WHERE e.kind = 'E' AND t.kind = 'T'
  GROUP BY e.page_id, e.node_id
),
chains AS (
  SELECT e.page_id, e.node_id, arg_max(d.text, d.node_id) AS single
  FROM nodes e JOIN nodes d ON d.page_id = e.page_id AND d.node_id > e.node_id AND d.node_id < e.end_id
  WHERE e.kind = 'E'
  GROUP BY e.page_id, e.node_id, e.depth
  HAVING count(*) = max(d.depth) - e.depth AND arg_max(d.kind, d.node_id) <> 'E'
     AND count(DISTINCT d.depth) = count(*)
),
el AS MATERIALIZED (
  SELECT n.*,
         CASE WHEN n.kind = 'E' THEN coalesce({strip('b.raw_text')}, '')
              WHEN n.kind = 'T' THEN {strip('n.text')} ELSE '' END AS raw_text,
         coalesce(b.glued, '') AS glued, coalesce(b.lined, '') AS lined,
         CASE WHEN n.kind = 'E' THEN c.single ELSE n.text END AS single
  FROM nodes n
  LEFT JOIN below b ON b.page_id = n.page_id AND b.node_id = n.node_id
  LEFT JOIN chains c ON c.page_id = n.page_id AND c.node_id = n.node_id
)"""

GIVEN = "SELECT page_id, html FROM pages"
SITE = "SELECT page_id, html FROM (" + derived.SITE_PAGES + ") site_pages"


def with_tokens(source: str, query: str) -> str:
    return f"WITH {tokens_cte(source)} {query}"


def with_nodes(source: str, query: str, *more: str, implied: bool = False) -> str:
    kept = f"CASE WHEN t.op IN ('open', 'void') THEN {_kept('t.tag', 'f.tags')} ELSE len(f.tags) END" if implied else "len(f.tags)"
    ctes = ", ".join((tokens_cte(source), _NODES.replace("{KEPT}", kept), *more))
    return f"WITH RECURSIVE {ctes} {query}"


def with_texts(source: str, query: str, *more: str, implied: bool = False) -> str:
    return with_nodes(source, query, _TEXTS, *more, implied=implied)


def cls(token: str, alias: str = "") -> str:
    return f"list_contains({alias}cls, '{token}')"


def inside(inner: str, outer: str) -> str:
    return (
        f"{inner}.page_id = {outer}.page_id AND {inner}.node_id > {outer}.node_id "
        f"AND {inner}.node_id < {outer}.end_id"
    )


def first(cond: str) -> str:
    """First node of each page that meets a condition."""
    return f"SELECT page_id, min(node_id) AS node_id FROM el WHERE {cond} GROUP BY page_id"


# -- sources, sinks, formats ------------------------------------------------

ORACLE["src_pages"] = "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages"


def _url(profile) -> str:
    numbered = f"'{profile.base_url}{profile.page_prefix}' || page_no || '{profile.page_suffix}'"
    if profile.first_is_base:
        return f"CASE WHEN page_no > 1 THEN {numbered} ELSE '{profile.base_url}' END"
    return numbered


_URL = "CASE site " + " ".join(f"WHEN '{p.site}' THEN {_url(p)}" for p in SITES) + " END"
_FIRST = "CASE site " + " ".join(f"WHEN '{p.site}' THEN {p.first_page}" for p in SITES) + " END"
_CAP = "CASE site " + " ".join(f"WHEN '{p.site}' THEN {p.page_cap or 'NULL'}" for p in SITES) + " END"
_STOP = "CASE site " + " ".join(f"WHEN '{p.site}' THEN {p.stop_after}" for p in SITES) + " END"

ORACLE["src_page_urls"] = f"""
SELECT site, page_no, {_URL} AS url
FROM (SELECT site, unnest(range({_FIRST}, least(coalesce({_CAP}, max(page_no)), max(page_no)) + 1)) AS page_no
      FROM ({derived.PAGE_STATS}) s GROUP BY site) pages
"""

ORACLE["src_release_split"] = r"""
WITH whole AS (
  SELECT doc_id, text || E'\n\n==\nTitle: a' || E'\n\n==\n\n' || source || E'\n\n==\n' AS text FROM documents
),
cut AS (
  SELECT doc_id, 'strict' AS mode, string_split(text, E'\n\n==\n\n') AS parts FROM whole
  UNION ALL
  SELECT doc_id, 'tolerant', list_filter(string_split_regex(text, '\n\n==\n\n?'), lambda r: r <> '') FROM whole
)
SELECT doc_id, mode, CAST(unnest(range(len(parts))) AS BIGINT) AS pos, unnest(parts) AS release FROM cut
"""

ORACLE["src_member_from_file"] = """
SELECT doc_id, source AS member, source || '_formatted.txt' AS formatted FROM documents
"""

ORACLE["src_site_of_page"] = """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'hawley' END AS site,
       CASE page_id % 4 WHEN 1 THEN 'malformed' WHEN 2 THEN 'unknown host' WHEN 3 THEN 'no address' END AS reason
FROM pages
"""

ORACLE["src_release_files"] = f"""
SELECT strict, member, text FROM ({derived.RELEASES}) r, (VALUES (TRUE), (FALSE)) modes(strict)
"""

ORACLE["sink_append"] = f"SELECT doc_id, member AS site, text FROM ({derived.RELEASES}) r"

ORACLE["sink_chunks"] = """
SELECT lang, CAST(floor((no - 1) / 100) AS BIGINT) AS chunk_no, count(*) AS n_releases,
       min(no) AS first_no, max(doc_id) AS last_doc
FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS no FROM documents) d
GROUP BY 1, 2
"""

ORACLE["sink_resume"] = f"SELECT * FROM ({derived.PAGE_STATS}) s"

ORACLE["fmt_stamp"] = "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events"

# -- node table -------------------------------------------------------------

ORACLE["html_tokens"] = with_tokens(GIVEN, "SELECT page_id, pos, op, tag, raw FROM toks")

ORACLE["html_nodes"] = with_nodes(
    SITE,
    """SELECT page_id, node_id, end_id, parent_id, depth, kind, tag, text,
       row_number() OVER (PARTITION BY page_id, parent_id ORDER BY node_id) AS sibling_no FROM nodes""",
)

ORACLE["html_nodes_whole"] = with_nodes(
    GIVEN, "SELECT page_id, node_id, end_id, parent_id, depth, kind, tag, text FROM nodes")
ORACLE["html_nodes_html5"] = with_nodes(
    GIVEN, "SELECT page_id, node_id, end_id, parent_id, depth, kind, tag, text FROM nodes", implied=True)
ORACLE["html_attrs_whole"] = with_nodes(GIVEN, "SELECT page_id, node_id, name, value FROM attrs")
ORACLE["html_attrs"] = with_nodes(
    SITE,
    """SELECT n.page_id, n.node_id, a.name, a.value, array_to_string(n.cls, '|') AS classes
       FROM attrs a JOIN nodes n ON n.page_id = a.page_id AND n.node_id = a.node_id""",
)

ORACLE["html_unescape"] = f"""
SELECT page_id, {unescape('raw')} AS decoded
FROM (SELECT page_id, '&lt;&#169;&#xe9;&nosuch;&#8220;&nbsp;AT&T'
             || html AS raw FROM pages) r
"""

for _name, _column in (
    ("text_stripped", "glued"), ("text_newline", "lined"), ("text_raw", "raw_text"), ("text_single", "single"),
):
    ORACLE[_name] = with_texts(
        SITE, f"SELECT page_id, node_id, tag, {_column} AS value FROM el WHERE kind = 'E'"
    )

# -- selectors --------------------------------------------------------------


def _all_of(name: str, cond: str, source: str = GIVEN) -> None:
    ORACLE[name] = with_texts(source, f"SELECT page_id, node_id, raw_text AS value FROM el WHERE {cond}")


def _first_of(name: str, cond: str, source: str = GIVEN) -> None:
    ORACLE[name] = with_texts(
        source,
        "SELECT e.page_id, e.node_id, e.raw_text AS value FROM el e JOIN hit USING (page_id, node_id)",
        f"hit AS ({first(cond)})",
    )


def _from_first(name: str, start: str, join: str, keep: str) -> None:
    """Nodes standing in a relation to the first node of a kind."""
    ORACLE[name] = with_texts(
        GIVEN,
        f"SELECT d.page_id, {keep} FROM a JOIN el d ON d.page_id = a.page_id AND {join}",
        f"a AS (SELECT e.* FROM el e JOIN ({first(start)}) f USING (page_id, node_id))",
    )


_NTH = "min(d.node_id) AS node_id, arg_min(d.raw_text, d.node_id) AS value"

_first_of("sel_first_class", f"tag = 'div' AND {cls('ad')}")
_all_of(
    "sel_class_exact",
    "tag IN ('h1', 'span') AND array_to_string(cls, ' ') IN ('Heading Heading--h2', 'date black')", SITE,
)
_all_of("sel_attr_eq", "id = 'ctl00_ctl21_CatTags' OR style = 'text-align: center;'", SITE)
_all_of("sel_text_eq", f"tag = 'span' AND {cls('field__label')} AND single = 'Issues:'", SITE)
_first_of("sel_text_regex", r"kind <> 'E' AND regexp_matches(text, '[\p{L}\p{N}_\p{M}]{6,}\s+[\p{L}\p{N}_\p{M}]+,')")
_all_of("sel_tag", "tag = 'p'")
ORACLE["sel_descendant"] = with_texts(
    GIVEN,
    f"""SELECT p.page_id, p.node_id, p.raw_text AS value FROM el p
        WHERE p.tag = 'p' AND EXISTS (
          SELECT 1 FROM el a JOIN el b ON {inside('a', 'b')}
          WHERE a.tag = 'article' AND b.tag = 'body' AND {inside('p', 'a')})""",
)
_all_of("sel_has_attr", "tag = 'a' AND href IS NOT NULL")
_all_of("sel_href_contains", "tag = 'a' AND contains(href, '/th')")
ORACLE["sel_nth"] = with_texts(
    GIVEN,
    """SELECT page_id, node_id, raw_text AS value FROM el WHERE tag = 'p'
       QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY node_id) = 2""",
)
_from_first(
    "sel_scoped", "tag = 'nav'", "d.node_id > a.node_id AND d.node_id < a.end_id AND d.tag = 'a'",
    _NTH + "",
)
ORACLE["sel_scoped"] += " GROUP BY d.page_id"
_from_first("sel_children", "tag = 'article'", "d.parent_id = a.node_id", "d.node_id, d.raw_text AS value")
_from_first("sel_following", "tag = 'h1'", "d.node_id > a.node_id AND d.tag = 'p'", _NTH)
ORACLE["sel_following"] += " GROUP BY d.page_id"
_all_of("flt_nonblank", "tag = 'p' AND raw_text <> ''", SITE)

ORACLE["prj_fallback"] = with_texts(
    SITE,
    f"""SELECT s.page_id, coalesce(
          min_by(e.raw_text, e.node_id) FILTER (WHERE e.tag = 'h1' AND {cls('elementor-heading-title', 'e.')}),
          min_by(e.raw_text, e.node_id) FILTER (WHERE e.tag = 'h1' AND {cls('display-4', 'e.')}),
          min_by(e.raw_text, e.node_id) FILTER (WHERE e.tag = 'h2')) AS title
        FROM src s JOIN el e ON e.page_id = s.page_id GROUP BY s.page_id""",
)
ORACLE["prj_sentinel"] = with_texts(
    SITE,
    f"""SELECT s.page_id, coalesce(min_by(e.raw_text, e.node_id)
          FILTER (WHERE e.tag = 'span' AND {cls('published', 'e.')}), 'No date found') AS date
        FROM src s JOIN el e ON e.page_id = s.page_id GROUP BY s.page_id""",
)

# -- content ----------------------------------------------------------------

# Each mode is a query over ``box`` (page_id, node_id, end_id: the containers).
_IN_BOX = f"FROM box JOIN el d ON {inside('d', 'box')}"
_NL2 = "chr(10) || chr(10)"
_P_BLOCK = f"CASE WHEN d.glued <> '' THEN d.glued || {_NL2} ELSE '' END"
_LINE = f"CASE WHEN coalesce({strip('d.single')}, '') <> '' THEN {strip('d.single')} || chr(10) ELSE '' END"


def _mode(aggregate: str, where: str = "true", rows: str = _IN_BOX) -> str:
    return (
        f"SELECT box.page_id, coalesce(made.content, '') AS content FROM box LEFT JOIN "
        f"(SELECT box.page_id, {aggregate} AS content {rows} WHERE {where} GROUP BY box.page_id) made USING (page_id)"
    )


def _items(tag: str, mark: str) -> str:
    return f"""(SELECT string_agg({mark} || li.glued || chr(10), '' ORDER BY li.node_id)
        FROM (SELECT l.page_id, l.node_id, l.glued, o.node_id AS list_id,
                     row_number() OVER (PARTITION BY o.page_id, o.node_id ORDER BY l.node_id) AS no
              FROM el o JOIN el l ON {inside('l', 'o')} WHERE o.tag = '{tag}' AND l.tag = 'li') li
        WHERE li.page_id = d.page_id AND li.list_id = d.node_id)"""


MODES = {
    "paragraphs_all": _mode(strip(f"string_agg(d.glued, {_NL2} ORDER BY d.node_id)"), "d.tag = 'p'"),
    "paragraphs": _mode(f"string_agg(d.glued, {_NL2} ORDER BY d.node_id)", "d.tag = 'p' AND d.glued <> ''"),
    "paragraphs_and_breaks": _mode(
        strip(f"string_agg(CASE d.tag WHEN 'br' THEN chr(10) ELSE {_P_BLOCK} END, '' ORDER BY d.node_id)"),
        "d.tag IN ('p', 'br')",
    ),
    "all_strings": _mode(
        strip(squeeze(
            f"string_agg(CASE WHEN d.tag = 'p' THEN {_P_BLOCK} WHEN d.tag = 'br' THEN chr(10) ELSE {_LINE} END, '' ORDER BY d.node_id)"
        ))
    ),
    "strings_once": _mode(
        strip(squeeze(
            f"string_agg(CASE WHEN d.tag = 'p' THEN {_P_BLOCK} WHEN d.tag = 'br' THEN chr(10) ELSE {_LINE} END, '' ORDER BY d.node_id)"
        )),
        f"""(d.tag = 'br' AND d.kind = 'E') OR NOT EXISTS (
          SELECT 1 FROM el a WHERE {inside('d', 'a')} AND {inside('a', 'box')} AND a.tag <> 'br'
            AND CASE WHEN a.tag = 'p' THEN a.glued ELSE coalesce({strip('a.single')}, '') END <> '')""",
    ),
    "blocks": _mode(
        strip(squeeze(
            f"""string_agg(CASE WHEN d.tag = 'p' THEN d.glued || {_NL2}
              WHEN d.tag = 'ul' THEN coalesce({_items('ul', "'• '")}, '') || chr(10)
              WHEN d.tag = 'ol' THEN coalesce({_items('ol', "li.no || '. '")}, '') || chr(10)
              WHEN d.tag = 'br' THEN chr(10)
              WHEN d.tag = 'div' AND {cls('media-item', 'd.')} THEN '[Embedded media content]' || {_NL2}
              ELSE {_LINE} END, '' ORDER BY d.node_id)"""
        )),
        "d.parent_id = box.node_id",
    ),
    "lines": "SELECT box.page_id, d.lined AS content FROM box JOIN el d ON d.page_id = box.page_id AND d.node_id = box.node_id",
    "page_fallback": f"""
      SELECT box.page_id, coalesce(
        (SELECT string_agg(p.raw_text, {_NL2} ORDER BY p.node_id) FROM el p
          WHERE p.page_id = box.page_id AND p.tag = 'p' AND p.raw_text <> ''),
        (SELECT string_agg(d.raw_text, {_NL2} ORDER BY d.node_id) FROM el d
          WHERE d.page_id = box.page_id AND d.tag = 'div' AND d.raw_text <> '' AND d.parent_id =
            (SELECT min(z.node_id) FROM el z JOIN el y ON {inside('z', 'y')} JOIN el x ON {inside('y', 'x')}
              WHERE z.page_id = box.page_id AND z.id = 'press' AND {cls('article', 'y.')} AND x.id = 'newscontent')),
        (SELECT arg_min(e.raw_text, e.node_id) FROM el e WHERE e.page_id = box.page_id AND e.id = 'press')
      ) AS content FROM box""",
}


def _box(start: str) -> str:
    return f"box AS MATERIALIZED (SELECT e.page_id, e.node_id, e.end_id FROM el e JOIN ({first(start)}) f USING (page_id, node_id))"


def _content(name: str, mode: str, source: str, start: str) -> None:
    ORACLE[name] = with_texts(
        source,
        "SELECT s.page_id, m.content FROM src s LEFT JOIN made_content m ON m.page_id = s.page_id",
        _box(start), f"made_content AS ({MODES[mode]})",
    )


_content("content_paras_all", "paragraphs_all", GIVEN, "tag = 'article'")
_content("content_paras", "paragraphs", GIVEN, "tag = 'article'")
_content("content_p_br", "paragraphs_and_breaks", GIVEN, "tag = 'article'")
_content("content_all_strings", "all_strings", SITE, "tag = 'body'")
_content("content_blocks", "blocks", SITE, cls("evo-press-release__body"))
_content("content_newline", "lines", GIVEN, "tag = 'article'")
_content("content_fallback", "page_fallback", SITE, "tag = 'body'")


# -- cleaning ---------------------------------------------------------------


def _sub(value: str, pattern: str, new: str) -> str:
    return f"regexp_replace({value}, '{pattern}', '{new}', 'g')"


def whitespace(v: str) -> str:
    return _sub(v, f"[{WS}]+", " ")


def sentence_gaps(v: str) -> str:
    for mark in (".", ",", "!", "?"):
        v = _sub(v, f"[{mark}]([A-Z])", rf"{mark} \1")
    return v


def camel(v: str) -> str:
    return _sub(v, "([a-z])([A-Z])", r"\1 \2")


def quotes(v: str) -> str:
    v = _sub(v, f"""([^{WS}])(["''”’])""", r"\1 \2")
    return _sub(v, f"""(["''“‘])([^{WS}])""", r"\1 \2")


def colons(v: str) -> str:
    return _sub(_sub(v, f"([^{WS}])([:;])", r"\1 \2"), f"([:;])([^{WS}])", r"\1 \2")


def clean(v: str) -> str:
    return strip(colons(quotes(camel(sentence_gaps(whitespace(v))))))


for _name, _step in (
    ("clean_whitespace", whitespace), ("clean_sentence_gap", sentence_gaps), ("clean_camel", camel),
    ("clean_quotes", quotes), ("clean_colons", colons), ("clean_text", clean),
):
    ORACLE[_name] = f"SELECT doc_id, {_step('text')} AS cleaned FROM ({derived.CLEANER_TEXT}) t"

ORACLE["fmt_collapse_newlines"] = f"""
SELECT doc_id, {squeeze("replace(text, chr(10), repeat(chr(10), 5))")} AS collapsed FROM documents
"""

_SECTIONS = f"""
sections AS (
  SELECT doc_id, member, unnest(range(len(parts))) AS pos, {clean('unnest(parts)')} AS section
  FROM (SELECT doc_id, member, string_split(text, chr(10) || chr(10)) AS parts FROM ({derived.RELEASES}) r) s
)"""
ORACLE["norm_sections"] = f"WITH {_SECTIONS} SELECT doc_id, pos, section FROM sections"
ORACLE["norm_release"] = f"""
WITH {_SECTIONS} SELECT doc_id, string_agg(section, {_NL2} ORDER BY pos) AS release FROM sections GROUP BY doc_id
"""
ORACLE["norm_words"] = f"""
SELECT doc_id, CAST(unnest(range(len(ws))) AS BIGINT) AS pos, unnest(ws) AS word
FROM (SELECT doc_id, regexp_extract_all(text, '[^{WS}]+') AS ws FROM ({derived.CLEANER_TEXT}) t) d
"""

# -- extraction -------------------------------------------------------------

ORACLE["extract_releases"] = with_texts(
    GIVEN,
    f"""SELECT p.page_id, p.url, t.title, 'No date found' AS date, {clean('m.content')} AS content
        FROM pages p LEFT JOIN titles t ON t.page_id = p.page_id LEFT JOIN made_content m ON m.page_id = p.page_id""",
    _box("tag = 'article'"), f"made_content AS ({MODES['paragraphs']})",
    "titles AS (SELECT page_id, arg_min(raw_text, node_id) AS title FROM el WHERE tag = 'h1' GROUP BY page_id)",
)


def _test(step: Step, alias: str) -> str:
    tests = ["true"]
    if step.tag:
        tests.append(f"{alias}.tag = '{step.tag}'")
    if step.class_token:
        tests.append(cls(step.class_token, alias + "."))
    if step.class_exact:
        tests.append(f"array_to_string({alias}.cls, ' ') = '{step.class_exact}'")
    if step.id:
        tests.append(f"{alias}.id = '{step.id}'")
    if step.style:
        tests.append(f"{alias}.style = '{step.style}'")
    if step.text_eq:
        tests.append(f"{alias}.single = '{step.text_eq}'")
    if step.href_part:
        tests.append(f"contains({alias}.href, '{step.href_part}')")
    if step.text_re:
        pattern = step.text_re.replace(r"\w", r"[\p{L}\p{N}_]")
        tests.append(f"{alias}.kind <> 'E' AND regexp_matches({alias}.text, '{pattern}')")
    return " AND ".join(tests)


def _hop(scope: str, step: Step) -> str:
    """Page and node reached from each page's node in ``scope``."""
    reach = "d.node_id > a.node_id" + ("" if step.axis == "following" else " AND d.node_id < a.end_id")
    return f"""SELECT h.* EXCLUDE (no) FROM (
        SELECT d.*, row_number() OVER (PARTITION BY d.page_id ORDER BY d.node_id) AS no
        FROM ({scope}) a JOIN el d ON d.page_id = a.page_id AND {reach} WHERE {_test(step, 'd')}) h
        WHERE no = {step.nth}"""


def _site_sql() -> tuple[list[str], str]:
    """CTEs and rows of the nine sites' releases, one site after the other."""
    ctes, selects = [], []
    for p in SITES:
        root = f"SELECT page_id, 0 AS node_id, 1000000000 AS end_id FROM pg WHERE site = '{p.site}'"
        names: dict[str, list[str]] = {}
        broken = ["false"]
        for number, s in enumerate(p.selectors):
            scope, hops = root, []
            for hop_no, step in enumerate(s.steps):
                name = f"{p.site}_{number}_{hop_no}"
                ctes.append(f"{name} AS MATERIALIZED ({_hop(scope, step)})")
                scope = f"SELECT * FROM {name}"
                hops.append(name)
            names.setdefault(s.field, []).append(hops[-1])
            if s.strict:
                broken.append(
                    f"(EXISTS (SELECT 1 FROM {hops[0]} h WHERE h.page_id = pg.page_id) AND NOT EXISTS "
                    f"(SELECT 1 FROM {hops[-1]} h WHERE h.page_id = pg.page_id))"
                )

        def value(field: str) -> str:
            options = []
            for number, s in enumerate(p.selectors):
                if s.field != field:
                    continue
                hit = f"{p.site}_{number}_{len(s.steps) - 1}"
                column = {"raw": "h.raw_text", "stripped": "h.glued"}.get(s.text_mode)
                if column is None:
                    column = f"""coalesce((SELECT string_agg(a.glued, ', ' ORDER BY a.node_id)
                        FROM el a WHERE a.tag = 'a' AND {inside('a', 'h')}), '')"""
                options.append(f"(SELECT {column} FROM {hit} h WHERE h.page_id = pg.page_id)")
            return "coalesce(" + ", ".join(options + ["NULL"]) + ")" if options else "CAST(NULL AS VARCHAR)"

        if p.content_mode == "page_fallback":
            box = "SELECT page_id, 0 AS node_id, 1000000000 AS end_id FROM pg WHERE site = '%s'" % p.site
        else:
            hits = names["content"]
            box = " UNION ALL ".join(
                f"SELECT page_id, node_id, end_id FROM {h} WHERE page_id NOT IN "
                + "(" + (" UNION ALL ".join(f"SELECT page_id FROM {e}" for e in hits[:k]) or "SELECT -1") + ")"
                for k, h in enumerate(hits)
            )
        mode = MODES[p.content_mode].replace("FROM box", f"FROM {p.site}_box box")
        ctes.append(f"{p.site}_box AS MATERIALIZED ({box})")
        ctes.append(f"{p.site}_content AS MATERIALIZED ({mode})")
        ctes.append(
            f"""{p.site}_rows AS (SELECT pg.page_id, pg.site, pg.url, {value('title')} AS title,
                {value('date')} AS date, {value('extra')} AS extra,
                (SELECT c.content FROM {p.site}_content c WHERE c.page_id = pg.page_id) AS content,
                ({' OR '.join(broken)}) AS broken FROM pg WHERE pg.site = '{p.site}')"""
        )
        selects.append(f"SELECT * FROM {p.site}_rows")
    return ctes, " UNION ALL ".join(selects)


_SITE_CTES, _SITE_ROWS = _site_sql()
_SOUND = """
sound AS (
  SELECT page_id, site, url, CASE WHEN NOT broken THEN title END AS title,
         CASE WHEN NOT broken THEN date END AS date, CASE WHEN NOT broken THEN extra END AS extra,
         CASE WHEN NOT broken THEN content END AS content,
         CASE WHEN broken THEN 'Error: An error occurred while scraping ' || url END AS error
  FROM site_rows
)"""


def with_sites(query: str, source: str = derived.SITE_PAGES) -> str:
    return with_texts(
        f"SELECT page_id, html FROM ({source}) sources", query, f"pg AS MATERIALIZED ({source})", *_SITE_CTES,
        f"site_rows AS ({_SITE_ROWS})", _SOUND)


ORACLE["extract_sites"] = with_sites("SELECT page_id, site, title, date, extra, content, error FROM sound")
ORACLE["stream_extract"] = with_sites("SELECT page_id, site, title, date, content, error FROM sound")
ORACLE["stream_resume"] = ORACLE["stream_extract"]
ORACLE["agg_tags"] = with_sites(
    "SELECT page_id, coalesce(extra, 'No tags found') AS tags FROM sound WHERE site = 'mtg'"
)
_EXTRA = "CASE site " + " ".join(
    f"WHEN '{p.site}' THEN chr(10) || '{p.extra_label}: ' || coalesce(extra, '{p.extra_default}')"
    for p in SITES if p.extra_label
) + " ELSE '' END"
ORACLE["fmt_release"] = with_sites(
    f"""SELECT page_id, site, coalesce(error, 'Title: ' || coalesce(title, 'No title found') || chr(10) || 'Date: '
        || coalesce(date, 'No date found') || {_EXTRA} || {_NL2} || 'Content:' || chr(10)
        || coalesce(content, 'No content found')) || {_NL2} || '==' || chr(10) AS record FROM sound"""
)

# -- links ------------------------------------------------------------------

def _listing_sql() -> str:
    rows = []
    for p in SITES:
        scope = f"""(SELECT e.*, row_number() OVER (PARTITION BY e.page_id ORDER BY e.node_id) AS item_no
            FROM el e JOIN pg ON pg.page_id = e.page_id AND pg.site = '{p.site}' WHERE {_test(p.link_item, 'e')})"""
        for step in p.link_steps:
            scope = f"""(SELECT d.*, a.item_no FROM {scope} a JOIN el d ON {inside('d', 'a')} WHERE {_test(step, 'd')}
                QUALIFY row_number() OVER (PARTITION BY a.page_id, a.item_no ORDER BY d.node_id) = 1)"""
        sql = f"SELECT page_id, item_no, href FROM {scope} t"
        if p.href_required:
            sql += " QUALIFY bool_and(href IS NOT NULL) OVER (PARTITION BY page_id)"
        sql = f"SELECT page_id, item_no, href FROM ({sql}) w WHERE href IS NOT NULL"
        if p.links_distinct:
            sql = f"SELECT page_id, min(item_no) AS item_no, href FROM ({sql}) u GROUP BY page_id, href"
        rows.append(sql)
    return " UNION ALL ".join(f"({r})" for r in rows)


_BASE = "CASE site " + " ".join(f"WHEN '{p.site}' THEN '{p.base_url}'" for p in SITES) + " END"


def joined_url(base: str, href: str) -> str:
    """RFC 3986 resolution; ``base`` is absolute."""
    origin = f"regexp_extract({base}, '^[a-z]+://[^/?#]*')"
    rest = f"substr({base}, length({origin}) + 1)"
    base_path = f"regexp_extract({rest}, '^[^?#]*')"
    base_query = rf"regexp_extract({rest}, '^[^?#]*(\?[^#]*)', 1)"
    path = f"regexp_extract({href}, '^[^?#]*')"
    tail = f"substr({href}, length({path}) + 1)"
    folder = f"regexp_replace({base_path}, '[^/]*$', '')"
    whole = (
        f"CASE WHEN {path} LIKE '/%' THEN {path} ELSE "
        f"regexp_replace(CASE WHEN {folder} = '' THEN '/' ELSE {folder} END, '//+', '/', 'g') || {path} END"
    )
    segments = f"list_transform(string_split({whole}, '/'), lambda s: [s])"
    kept = (
        f"list_reduce({segments}, lambda acc, s: CASE WHEN s[1] = '.' THEN acc WHEN s[1] = '..' "
        f"THEN acc[:-2] ELSE list_concat(acc, s) END, CAST([] AS VARCHAR[]))"
    )
    dotted = f"regexp_matches({whole}, '(^|/)[.][.]?$')"
    final = f"array_to_string(CASE WHEN {dotted} THEN list_append({kept}, '') ELSE {kept} END, '/')"
    return f"""CASE WHEN {href} = '' THEN {base}
        WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {href}
        WHEN {href} LIKE '//%' THEN regexp_extract({base}, '^[a-z]+:') || {href}
        WHEN {href} LIKE '?%' THEN {origin} || {base_path} || {href}
        WHEN {href} LIKE '#%' THEN {origin} || {base_path} || {base_query} || {href}
        ELSE {origin} || '/' || ltrim({final}, '/') || {tail} END"""


def with_links(query: str, *more: str, listings: str = derived.LISTINGS) -> str:
    return with_texts(
        f"SELECT page_id, html FROM ({listings}) l", query,
        f"pg AS MATERIALIZED ({listings})",
        f"found AS MATERIALIZED ({_listing_sql()})",
        f"""links AS MATERIALIZED (
          SELECT site, page_no, row_number() OVER (PARTITION BY page_id ORDER BY item_no) AS link_pos, href,
                 {joined_url('base', 'href')} AS url
          FROM (SELECT pg.site, pg.page_no, f.*, {_BASE} AS base FROM found f JOIN pg USING (page_id)) x)""", *more,
    )


ORACLE["links_discover"] = with_links("SELECT site, page_no, link_pos, href, url FROM links")
ORACLE["order_releases"] = with_links("SELECT site, page_no, link_pos, url FROM links ORDER BY ALL")
ORACLE["agg_links_per_page"] = with_links("SELECT site, page_no, count(*) AS n_links FROM links GROUP BY ALL")

_NAV = f"""nav AS MATERIALIZED (
  SELECT d.page_id, d.href, row_number() OVER (PARTITION BY d.page_id ORDER BY d.node_id) - 1 AS pos
  FROM nodes d WHERE d.tag = 'a' AND d.href IS NOT NULL
   AND EXISTS (SELECT 1 FROM nodes v WHERE v.tag = 'nav' AND {inside('d', 'v')})
)"""
ORACLE["links_top5"] = with_nodes(GIVEN, "SELECT page_id, CAST(unnest(range(len(five))) AS BIGINT) AS pos, unnest(five) AS href FROM (SELECT page_id, list(href ORDER BY pos)[1:5] AS five FROM nav GROUP BY page_id) t", _NAV)
ORACLE["links_distinct"] = with_nodes(
    GIVEN,
    """SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS pos, href
       FROM (SELECT page_id, href, min(pos) AS place FROM nav GROUP BY page_id, href) u""",
    _NAV,
)
_SHAPES = """CASE (page_id + pos) % 10 WHEN 0 THEN href WHEN 1 THEN word WHEN 2 THEN '../' || word
  WHEN 3 THEN './' || word WHEN 4 THEN '?q=' || word WHEN 5 THEN '#' || word WHEN 6 THEN '//h.example/' || word
  WHEN 7 THEN 'https://x.example/a/../' || word WHEN 8 THEN '/a/./b/../../../' || word || '/..?z=1#f' ELSE '' END"""
ORACLE["links_absolute"] = with_nodes(
    GIVEN,
    f"""SELECT page_id, pos, shaped AS href, {joined_url('url', 'shaped')} AS full_url
        FROM (SELECT page_id, pos, url, {_SHAPES} AS shaped
              FROM (SELECT n.*, p.url, substr(n.href, 2) AS word FROM nav n JOIN pages p USING (page_id)) w) s""",
    _NAV,
)
ORACLE["join_link_page"] = with_texts(
    GIVEN,
    """SELECT l.page_id, l.url, t.title, m.content
       FROM (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN url || '/gone' ELSE url END AS url FROM pages) l
       LEFT JOIN pages p ON p.url = l.url LEFT JOIN titles t ON t.page_id = p.page_id
       LEFT JOIN made_content m ON m.page_id = p.page_id""",
    _box("tag = 'article'"), f"made_content AS ({MODES['paragraphs']})",
    "titles AS (SELECT page_id, arg_min(raw_text, node_id) AS title FROM el WHERE tag = 'h1' GROUP BY page_id)",
)
ORACLE["errors_missing"] = """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '/gone' ELSE url END AS url,
       CASE WHEN page_id % 3 = 0 THEN 'Error: Timeout occurred while loading ' || url || '/gone' END AS error
FROM pages
"""

# -- cuts -------------------------------------------------------------------

_STATS = f"stats AS MATERIALIZED ({derived.PAGE_STATS})"
ORACLE["union_sites"] = f"WITH {_STATS} SELECT site, page_no FROM stats"
ORACLE["cut_first_empty"] = f"""
WITH {_STATS} SELECT s.* FROM stats s
WHERE NOT EXISTS (SELECT 1 FROM stats e WHERE e.site = s.site AND e.n_releases = 0 AND e.page_no <= s.page_no)
"""
_THREE = """
SELECT site, page_no, n_releases FROM (
  SELECT *, max(run) OVER (PARTITION BY site ORDER BY page_no) AS worst FROM (
    SELECT *, sum(CASE WHEN n_releases = 0 THEN 1 ELSE 0 END) OVER (
      PARTITION BY site ORDER BY page_no ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS run FROM stats) r) w
WHERE worst < 3
"""
ORACLE["cut_three_empty"] = f"WITH {_STATS} {_THREE}"
ORACLE["cut_range"] = f"""
WITH {_STATS} SELECT site, page_no, n_releases FROM stats
WHERE page_no >= {_FIRST} AND page_no <= coalesce({_CAP}, page_no)
"""
ORACLE["agg_release_count"] = f"""
WITH {_STATS} SELECT site, CAST(sum(n_releases) AS BIGINT) AS n_releases FROM stats GROUP BY site HAVING sum(n_releases) > 0
"""
ORACLE["agg_progress"] = """
SELECT source AS member, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_no,
       count(*) OVER (PARTITION BY source) AS total FROM documents
"""
ORACLE["url_robots"] = """
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || '/robots.txt' AS robots_url FROM pages
"""

_TITLED = "titles AS (SELECT page_id, arg_min(raw_text, node_id) AS title FROM el WHERE tag = 'h1' GROUP BY page_id)"
ORACLE["content_paras_html5"] = with_texts(
    GIVEN,
    """SELECT p.page_id, t.title, m.content
       FROM pages p LEFT JOIN titles t ON t.page_id = p.page_id LEFT JOIN made_content m ON m.page_id = p.page_id""",
    _box("tag = 'article'"), f"made_content AS ({MODES['paragraphs']})", _TITLED, implied=True,
)
ORACLE["content_strings_once"] = with_texts(
    GIVEN,
    "SELECT p.page_id, m.content FROM pages p LEFT JOIN made_content m ON m.page_id = p.page_id",
    _box("tag = 'article'"), f"made_content AS ({MODES['strings_once']})",
)

# Links, and the pages that a crawl reaches, its stop rules told from running
# counts of empties.  ``open`` says which listings and links may be read.
_REACHED = """
counts AS (
  SELECT p.site, p.page_no, count(k.url) AS n FROM pg p LEFT JOIN kept k ON k.site = p.site AND k.page_no = p.page_no GROUP BY ALL
),
ranged AS (SELECT * FROM counts WHERE page_no >= {_FIRST} AND page_no <= coalesce({_CAP}, page_no)),
marks AS (
  SELECT *, max(CASE WHEN n > 0 THEN page_no END) OVER (PARTITION BY site ORDER BY page_no) AS last_full FROM ranged
),
stops AS (
  SELECT site, min(page_no) AS stop FROM marks
  WHERE page_no - coalesce(last_full, {_FIRST} - 1) >= {_STOP} GROUP BY site
),
reached AS (
  SELECT r.site, r.page_no, r.n FROM ranged r LEFT JOIN stops s ON s.site = r.site
  WHERE r.page_no < coalesce(s.stop, r.page_no + 1)
)""".replace("{_FIRST}", _FIRST).replace("{_CAP}", _CAP).replace("{_STOP}", _STOP)

ORACLE["stream_cut"] = with_links(
    "SELECT site, page_no, n AS n_releases FROM reached", "kept AS (SELECT * FROM links)", _REACHED)

_BLOCKED = f"""
ruled AS MATERIALIZED (
  SELECT regexp_extract(line, 'Disallow: (.*)', 1) AS path
  FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM ({{derived_robots}}) r) l WHERE line LIKE 'Disallow: %'
),
kept AS MATERIALIZED (
  SELECT k.* FROM links k
  WHERE k.site <> 'markey' OR NOT (
    EXISTS (SELECT 1 FROM ruled WHERE starts_with('/news/press-releases?pagenum_rs=' || k.page_no, path))
    OR EXISTS (SELECT 1 FROM ruled WHERE starts_with(regexp_replace(k.url, '^[a-z]+://[^/?#]*', ''), path)))
)""".replace("{derived_robots}", derived.CRAWL_ROBOTS)


def _joined_pages(links: str, captures: str, condition: str) -> str:
    """Links with what their pages hold; the captures' rows come from a query of their own."""
    return f"""
      SELECT l.site, l.page_no, l.link_pos, l.url, c.title, c.date, c.content,
             CASE WHEN c.url IS NULL THEN 'Error: Timeout occurred while loading ' || l.url ELSE c.error END AS error
      FROM ({links}) l LEFT JOIN ({captures}) c ON c.site = l.site AND c.url = l.url AND {condition}"""


_AGAIN = f"SELECT page_id, site, page_no, CASE WHEN page_no % 7 = 0 AND md5(html || '<p>again</p>') > md5(html) THEN html || '<p>again</p>' ELSE html END AS html FROM ({derived.LISTINGS}) twice"
_ONE_CAPTURE = f"""SELECT page_id, site, url, html FROM ({derived.CAPTURES}) every_capture
    QUALIFY row_number() OVER (PARTITION BY site, url ORDER BY md5(html) DESC) = 1"""
ORACLE["crawl_releases"] = _joined_pages(
    with_links(
        "SELECT k.site, k.page_no, k.link_pos, k.url FROM kept k JOIN reached r ON r.site = k.site AND r.page_no = k.page_no",
        _BLOCKED, _REACHED, listings=_AGAIN),
    with_sites("SELECT site, url, title, date, content, error FROM sound", _ONE_CAPTURE), "true",
)
ORACLE["stream_crawl"] = "SELECT site, page_no, link_pos, url, title, content, error FROM (" + _joined_pages(
    with_links("SELECT site, page_no, link_pos, url FROM links"),
    with_sites(
        "SELECT s.site, s.url, s.title, s.date, s.content, s.error, pg.page_no, pg.shift FROM sound s JOIN pg USING (page_id)",
        derived.SINGLE_CAPTURES),
    "abs(c.page_no % 720 + c.shift - l.page_no % 720) <= 120",
) + ") met"

# -- robots -----------------------------------------------------------------

_ROBOT_LINES = rf"""
files AS ({{FILES}}),
lines AS (
  SELECT site, unnest(range(len(ls))) AS no, unnest(ls) AS line
  FROM (SELECT site, string_split(text, chr(10)) AS ls FROM files) f
),
fields AS (
  SELECT site, no, line = '' AS blank,
         lower(trim(regexp_extract(regexp_replace(line, '#.*', ''), '^([^:]*):', 1))) AS name,
         trim(regexp_extract(regexp_replace(line, '#.*', ''), '^[^:]*:(.*)$', 1)) AS value
  FROM lines
),
typed AS (
  SELECT *, name = 'user-agent' AS agent, name IN ('allow', 'disallow', 'crawl-delay') AS rule FROM fields
  WHERE blank OR name IN ('user-agent', 'allow', 'disallow', 'crawl-delay')
),
starts AS (
  SELECT *, blank OR (agent AND coalesce(lag(rule) OVER (PARTITION BY site ORDER BY no), false)) AS new FROM typed
),
grouped AS (
  SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY site ORDER BY no) AS grp FROM starts
),
agents AS (
  SELECT site, grp, list(value ORDER BY no) AS agents, min(no) AS first_agent FROM grouped WHERE agent GROUP BY site, grp
),
all_rules AS (
  SELECT g.site, g.grp, a.agents, g.no, g.name,
         g.name = 'allow' OR g.value = '' AS allow, g.value AS path,
         row_number() OVER (PARTITION BY g.site, g.grp ORDER BY g.no) AS rule_no,
         dense_rank() OVER (PARTITION BY g.site ORDER BY g.grp) AS entry_no
  FROM grouped g JOIN agents a ON a.site = g.site AND a.grp = g.grp
  WHERE g.rule AND g.no > a.first_agent
),
rules AS MATERIALIZED (
  SELECT site, entry_no, array_to_string(agents, '|') AS agents, rule_no, allow, path
  FROM all_rules WHERE name <> 'crawl-delay'
)"""


def with_robots(query: str, *more: str, files: str = derived.ROBOTS) -> str:
    return "WITH " + ", ".join((_ROBOT_LINES.replace("{FILES}", files), *more)) + " " + query


ORACLE["robots_rules"] = with_robots("SELECT * FROM rules")
_VERDICTS = rf"""
entries AS (
  SELECT site, entry_no, list_contains(agents, '*') AS star,
         list_bool_or(list_transform(agents, lambda a: contains('press release reader', lower(a)))) AS hit
  FROM all_rules GROUP BY ALL
),
chosen AS (
  SELECT site, coalesce(min(entry_no) FILTER (WHERE hit AND NOT star), min(entry_no) FILTER (WHERE star)) AS entry_no
  FROM entries GROUP BY site
),
targets AS (
  SELECT page_id, url, regexp_extract(url, '//([^/?#]*)', 1) AS site,
         regexp_replace(url, '^[a-z]+://[^/?#]*', '') AS path FROM pages
),
verdicts AS (
  SELECT t.page_id, t.site, t.url, coalesce(
    (SELECT arg_min(r.allow, r.rule_no) FROM rules r JOIN chosen c ON c.site = r.site AND c.entry_no = r.entry_no
      WHERE r.site = t.site AND starts_with(CASE WHEN t.path = '' THEN '/' ELSE t.path END, r.path)), true) AS allowed
  FROM targets t
)"""
ORACLE["robots_filter"] = with_robots("SELECT page_id, site, allowed FROM verdicts", _VERDICTS)
ORACLE["robots_links"] = with_robots("SELECT page_id, site, url FROM verdicts WHERE allowed", _VERDICTS)
ORACLE["robots_many_rules"] = with_robots(
    "SELECT page_id, site, allowed FROM verdicts",
    _VERDICTS.replace("regexp_extract(url, '//([^/?#]*)', 1)", derived.site_name("page_id % 9")), files=derived.MANY_RULES)

# -- spelling ---------------------------------------------------------------

# The distance function counts bytes, so letters beyond ASCII stand in as
# capitals, which lower-case words leave free.
_ONE_BYTE = "translate({w}, 'äöüßéèêàâçîïôûùëñóíáúœæ', 'ABCDEFGHIJKLMNOPQRSTUVW')"
_NUMBER = r"^[+-]?([0-9][0-9_]*[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?$|^[+-]?inf(inity)?$"


def _deleted(word: str) -> str:
    return f"list_transform(range(1, length({word}) + 1), lambda i: {word}[:i - 1] || {word}[i + 1:])"


def _keys(word: str) -> str:
    ones = _deleted(word)
    twos = f"flatten(list_transform({ones}, lambda o: list_transform(range(1, length(o) + 1), lambda j: o[:j - 1] || o[j + 1:])))"
    return f"list_distinct(list_concat([{word}], list_concat({ones}, {twos})))"


def spelling(used: str) -> str:
    """CTEs ending in ``fixes`` (w, correction) for the words of ``used`` (word)."""
    return rf"""
corpus AS (SELECT unnest(regexp_extract_all(lower(text), '[^{WS}]+')) AS w FROM benchmark),
dict AS MATERIALIZED (
  SELECT w, count(*) AS freq, {_ONE_BYTE.format(w='w')} AS b FROM corpus
  WHERE regexp_matches(w, '\p{{L}}') AND NOT regexp_matches(w, '{_NUMBER}') GROUP BY w
),
missing AS MATERIALIZED (
  SELECT DISTINCT lower(word) AS w, {_ONE_BYTE.format(w='lower(word)')} AS b FROM ({used}) u
  WHERE regexp_matches(word, '\p{{L}}') AND NOT regexp_matches(lower(word), '{_NUMBER}')
    AND lower(word) NOT IN (SELECT w FROM dict)
),
pairs AS (
  SELECT DISTINCT m.w, m.b, d.w AS cand, d.b AS db, d.freq
  FROM (SELECT w, b, unnest({_keys('b')}) AS k FROM missing) m
  JOIN (SELECT w, b, freq, unnest({_keys('b')}) AS k FROM dict) d ON d.k = m.k
),
graded AS (SELECT w, cand, freq, damerau_levenshtein(b, db) AS dist FROM pairs),
fixes AS MATERIALIZED (
  SELECT w, cand AS correction FROM graded WHERE dist <= 2
  QUALIFY row_number() OVER (PARTITION BY w ORDER BY dist, freq DESC, cand) = 1
)"""


_USED = f"SELECT unnest(regexp_extract_all(text, '[^{WS}]+')) AS word FROM documents"
ORACLE["spell_correct"] = f"""
WITH {spelling(_USED)}
SELECT u.word, coalesce(f.correction, u.word) AS correction
FROM (SELECT DISTINCT word FROM ({_USED}) a) u LEFT JOIN fixes f ON f.w = lower(u.word)
  AND regexp_matches(u.word, '\\p{{L}}')
""".replace("\\\\p", "\\p")
ORACLE["norm_corpus"] = f"""
WITH {_SECTIONS},
cut AS MATERIALIZED (
  SELECT doc_id, member, pos, unnest(range(len(ws))) AS k, unnest(ws) AS word
  FROM (SELECT doc_id, member, pos, list_filter(string_split(section, ' '), lambda w: w <> '') AS ws FROM sections) s
),
{spelling('SELECT word FROM cut')},
fixed AS (
  SELECT c.doc_id, c.pos, string_agg(coalesce(f.correction, c.word), ' ' ORDER BY c.k) AS section
  FROM cut c LEFT JOIN fixes f ON f.w = lower(c.word) GROUP BY ALL
)
SELECT s.doc_id, s.member, string_agg(coalesce(f.section, ''), {_NL2} ORDER BY s.pos) AS text
FROM sections s LEFT JOIN fixed f ON f.doc_id = s.doc_id AND f.pos = s.pos GROUP BY s.doc_id, s.member
"""
ORACLE["corpus_files"] = f"SELECT member, text FROM ({ORACLE['norm_corpus']}) whole"
