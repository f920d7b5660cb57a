"""Inputs the given tables lack, derived from them.

Each is one SQL text that Spark and DuckDB both read, so the two sides of a
comparison start from the same rows and grow with the given tables.
"""

from __future__ import annotations

import re

from pressloom.profiles import SITES

SITE_NAMES = tuple(p.site for p in SITES)


def _case(cases: dict[str, str], subject: str) -> str:
    return "CASE " + subject + " " + " ".join(f"WHEN {k} THEN {v}" for k, v in cases.items()) + " END"


def site_name(number: str) -> str:
    """Site by a number from 0 to 8, as SQL."""
    return _case({str(i): f"'{s}'" for i, s in enumerate(SITE_NAMES)}, number)


# Release pages in every site's markup around a whole given page.  Three
# variants take turns: complete, with fallbacks, with fields missing.  What a
# variant does not put in a container stands after it.  ``plain`` is the page
# with its paragraphs turned into divisions.
_VARIANTS = {
    "aoc": (
        """'<h1 class="big display-4"> ' || head || ' </h1><div class="evo-create-type"><div class="row"><div class="col-auto"> May 1, 2024 </div><div class="col-auto">News</div></div></div><span class="field__label">Issues:</span> <i>x</i><span class="field__items"><a>Health</a>, <a> Labor </a></span><div class="evo-press-release__body">' || body || '<p> </p><p>Last <b>words</b></p></div>'""",
        """'<h1 class="display-4">' || head || '</h1><span class="field__label"> Issues:</span><div class="evo-press-release__body">' || body || '</div>'""",
        """'<h1 class="display-4">' || head || '</h1><div class="evo-create-type">none</div>' || body""",
    ),
    "hawley": (
        """'<h1 class="entry-title">' || head || '</h1><span class="published">May 2, 2024</span><div class="et_pb_post_content">' || body || '<p> &nbsp; </p><ul><li>one</li><li>two <em>and</em> three</li></ul></div>'""",
        """'<h1>' || head || '</h1><span class="published">' || head || '</span><div class="et_pb_post_content"><p></p></div>'""",
        """'<h1 class="title">' || head || '</h1>' || body""",
    ),
    "lee": (
        """'<h1 class="element-title">' || head || '</h1><h3 class="element-date">May 3, 2024</h3><div class="element-content">' || body || '</div>'""",
        """'<h1 class="element-title"><!-- t --></h1><div class="element-content wide">bare ' || head || '<br>text</div>'""",
        """'<h2 class="element-title">' || head || '</h2>' || body""",
    ),
    "manchin": (
        """'<h1 class="main_page_title">' || head || '</h1><span class="date   black">May 4, 2024</span>' || body""",
        """'<title>Press Release ' || head || '</title><span class="black date">on June 14, 2024 here</span><div id="newscontent"><div class="article"><div id="press"><div>' || head || '</div><div> </div><div>second <b>part</b></div>tail</div></div></div>' || plain""",
        """'<!-- Press Release --><div id="press"> only ' || head || ' text </div>' || plain""",
    ),
    "markey": (
        """'<h1 class="Heading Heading--h2">' || head || '</h1><div class="ArticleBlock__date"> May 5, 2024</div><div class="RawHTML">' || body || '<br/>x<p>a<br>b</p></div>'""",
        """'<h1 class="Heading--h2 Heading">' || head || '</h1><div class="RawHTML">no paragraph</div>'""",
        """'<p>' || head || '</p>' || body""",
    ),
    "mtg": (
        """'<h2 class="newsie-titler"> ' || head || ' <a href="/x">more</a></h2><b> May 6, 2024 </b><div id="ctl00_ctl21_CatTags"><a>Tax</a> <a> Trade <i>law</i></a><a></a></div><div class="newsbody">' || body || '</div>'""",
        """'<h2 class="newsie-titler">' || head || '</h2><div id="ctl00_ctl21_CatTags"></div><div class="newsbody"><p>' || head || '</p><p> </p><p>end</p></div>'""",
        """'<h2>' || head || '</h2>' || body""",
    ),
    "pocan": (
        """'<div class="block--pocan-evo-custom-62-page-title"><h1 class="display-4">' || head || '</h1></div><div class="evo-create-type"><div class="col-auto">May 7, 2024</div><div class="col-auto"> Press Release </div></div><div class="evo-press-release__body">lead ' || body || '<ul><li>one</li><li>two<ul><li>deep</li></ul></li></ul><ol><li>first</li><li> second </li></ol><br><div class="wide media-item">clip</div><div>kept</div><div>drop<b>ped</b></div><!-- note --><p></p></div>'""",
        """'<h1 class="display-4">' || head || '</h1><div class="evo-create-type"><div class="col-auto">May 8, 2024</div></div><div class="evo-press-release__body"><span><b>' || head || '</b></span></div>'""",
        """'<div class="block--pocan-evo-custom-62-page-title">' || head || '</div>' || body""",
    ),
    "sanders": (
        """'<h1 class="elementor-heading-title">' || head || '</h1><span class="elementor-icon-list-text elementor-post-info__item--type-date">May 9, 2024</span><h4 style="text-align: center;">Sub ' || head || '</h4><div class="elementor-text-editor">' || body || '<p>in <b>bold</b> out</p><br>bare<em><i>nest</i></em></div>'""",
        """'<h1 class="display-4">' || head || '</h1><div class="evo-create-type"><div class="col-auto">May 10, 2024</div></div><div class="evo-press-release__body">' || head || '</div><div class="elementor-widget-container">other</div>'""",
        """'<h4 style="text-align:center;">' || head || '</h4><div class="elementor-widget-container"><p>' || head || '</p></div>'""",
    ),
    "stefanik": (
        """'<h2 class="title">' || head || ' <i> now </i></h2><span class="year">2024</span><div class="content">' || body || '</div>'""",
        """'<h2 class="title news">' || head || '</h2><div class="content">' || head || '</div>'""",
        """'<div class="contents">' || body || '</div>'""",
    ),
}


def _variant_case(site: str) -> str:
    whole = (v if "|| body" in v or "|| plain" in v else f"{v} || body" for v in _VARIANTS[site])
    return _case({str(i): v for i, v in enumerate(whole)}, "variant")


_BODY = _case({f"'{s}'": _variant_case(s) for s in SITE_NAMES}, "site")

_PARTS = f"""
  SELECT page_id, url, {site_name('page_id % 9')} AS site,
         CAST(floor(page_id / 9) AS BIGINT) % 3 AS variant, html AS body,
         replace(replace(html, '<p>', '<div>'), '</p>', '</div>') AS plain,
         regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS head,
         regexp_extract(html, '<li><a href="([^"]*)"', 1) AS link
  FROM pages
"""

SITE_PAGES = f"""
SELECT page_id, site, url,
       '<html><body><nav><a href="/n">n</a></nav>' || ({_BODY}) || '</body></html>' AS html
FROM ({_PARTS}) parts
"""

# Listing pages: whole given pages, the items of their navigation turned into
# each site's markup.  What stands before and after a link, and an odd item.
_ITEMS = {
    "aoc": ('<div class="h3"><a href="', '</a><a href="/no">u</a></div>', '<div class="h3"><a>none</a></div>'),
    "hawley": ('<article class="et_pb_post x"><h2 class="entry-title"><a href="', '</a></h2></article>',
               '<article class="et_pb_post"><h2 class="entry-title"><a>none</a></h2></article>'),
    "lee": ('<div class="element"><h2 class="element-title"><b><a href="', '</a></b></h2></div>',
            '<div class="element"><h2 class="element-title">none</h2></div>'),
    "manchin": ('<a href="/newsroom/press-releases', '</a>', '<a href="/newsroom/x">t</a>'),
    "markey": ('<a class="ArticleBlock__title__link" href="', '</a>', '<a class="ArticleBlock__title__link">t</a>'),
    "mtg": ('<h2 class="newsie-titler"><a href="', '</a></h2>', '<h2 class="newsie-titler">t</h2>'),
    "pocan": ('<a class="btn btn-primary" href="', '</a>', '<a class="btn-primary">Read More</a>'),
    "sanders": ('<h2 class="elementor-post__title"><a href="', '</a></h2>',
                '<h2 class="elementor-post__title"><a name="x">t</a></h2>'),
    "stefanik": ('<table><tr><td class="recordListTitle"><a href="', '</a></td></tr></table>', '<td class="recordListTitle"></td>'),
}


def _listing(site: str) -> str:
    before, after, odd = _ITEMS[site]
    items = f"replace(replace(html, '<li><a href=\"', '<li>{before}'), '</a></li>', '{after}</li>')"
    if site == "pocan":  # the text of a link says what it is
        items = f"regexp_replace({items}, '>[^<>]*</a></li>', '>Read More</a></li>', 'g')"
    more = f"'<ul><li>{before}/' || slug || '/../' || slug || '?a=1\">Read More{after}</li></ul>'"
    # Every thirteenth page keeps its own navigation, which holds no item of the site's.
    return _case({"3": "html", "2": f"html || '{odd}'", "1": f"{items} || {more}"}, "variant").removesuffix("END") + f"ELSE {items} END"


_LISTING = _case({f"'{s}'": _listing(s) for s in SITE_NAMES}, "site")

# Page numbers run without a gap within each site.
LISTINGS = f"""
SELECT page_id, site, page_no, {_LISTING} AS html
FROM (
  SELECT page_id, html, {site_name('page_id % 9')} AS site,
         CAST(floor(page_id / 9) AS BIGINT) AS page_no,
         CAST(length(html) % 13 AS BIGINT) AS variant,
         regexp_extract(url, '//([a-z]*)', 1) AS slug
  FROM pages
) parts
"""

_ORIGIN = _case(
    {f"'{p.site}'": f"'{re.match('https?://[^/]*', p.base_url)[0]}{'/newsroom/press-releases' if p.site == 'manchin' else ''}'" for p in SITES},
    "site")

# Release pages captured at the address their own first link has on their site;
# several of a site may share one.
CAPTURES = f"""
SELECT page_id, site, {_ORIGIN} || link AS url,
       '<html><body><nav><a href="/n">n</a></nav>' || ({_BODY}) || '</body></html>' AS html
FROM ({_PARTS}) parts
"""

# One of them for each address, with the page's place on its site and minutes between.
SINGLE_CAPTURES = f"""
SELECT page_id, site, url, html, CAST(floor(page_id / 9) AS BIGINT) AS page_no, CASE WHEN page_id % 2 = 0 THEN 30 ELSE -30 END AS shift
FROM ({CAPTURES}) every
JOIN (SELECT min(page_id) AS page_id FROM ({CAPTURES}) each_one GROUP BY url) first USING (page_id)
"""

# Rules for the one site that heeds them: one listing page, and some of the links.
CRAWL_ROBOTS = """
SELECT 'markey' AS site, 'User-agent: *' || chr(10) || 'Disallow: /news/press-releases?pagenum_rs='
       || CAST(CAST(floor(count(*) / 18) AS BIGINT) AS STRING) || chr(10)
       || string_agg(CASE WHEN page_id % 45 = 4 THEN 'Disallow: ' || regexp_extract(html, '<li><a href="([^"]*)"', 1) ELSE '# no rule' END, chr(10)) AS text
FROM pages
"""

# Listing page results: page numbers without a gap, about a third of them empty.
PAGE_STATS = f"""
SELECT {site_name('event_id % 9')} AS site,
       CAST(floor(event_id / 9) AS BIGINT) AS page_no,
       CASE WHEN user_id % 3 = 0 AND event_id >= 270 THEN CAST(0 AS BIGINT)
            ELSE CAST(floor(value) AS BIGINT) % 7 + CASE WHEN user_id % 5 = 0 THEN 0 ELSE 1 END
       END AS n_releases
FROM events
"""

# Release text with the mistakes the cleaner repairs.
CLEANER_TEXT = """
SELECT doc_id,
       replace(replace(replace(replace(replace(text, '. ', '.'), ', ', ','), ' d', 'D'),
               ' a', ' "a'), 'e ', 'e:') || chr(10) || '  it' || chr(39) || 's “x”;y' || chr(160) || 'Go!Yes?No ‘a’' || chr(39) || chr(39) AS text
FROM documents
"""

# Release text in several sections.
RELEASES = """
SELECT doc_id, source AS member,
       'Title: ' || substr(text, 1, 40) || chr(10) || 'Date: May 1, 2024' || chr(10) || chr(10)
       || 'Content:' || chr(10) || replace(text, chr(10), chr(10) || chr(10)) AS text
FROM documents
"""

#: Name of the agent whose rules are looked up.
AGENT = "Press Release Reader/1.0"

# A robots file per host of the given pages, in one of several shapes.
ROBOTS = """
SELECT site, CASE CAST(min(page_id) AS BIGINT) % 5
   WHEN 0 THEN NULL
   WHEN 1 THEN 'User-agent: *' || chr(10) || 'Disallow:' || chr(10)
   WHEN 2 THEN '# rules' || chr(10) || 'User-Agent: *' || chr(10) || 'Allow: /en/1 # some' || chr(10) || 'Disallow: /en' || chr(10) || 'Disallow: /fr/2'
   WHEN 3 THEN 'User-agent: *' || chr(10) || 'Disallow: /' || chr(10) || chr(10) || 'User-agent: other' || chr(10) || 'User-agent: Press Release' || chr(10) || 'Disallow: /de' || chr(10) || 'Allow: /' || chr(10)
   ELSE 'Disallow: /es' || chr(10) || 'User-agent: nobody' || chr(10) || 'Disallow: /' || chr(10) || chr(10) || chr(10) || 'User-agent: *' || chr(10) || 'Crawl-delay: 5' || chr(10) || 'Disallow: /e' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /f'
 END AS text
FROM (SELECT page_id, regexp_extract(url, '//([^/?#]*)', 1) AS site FROM pages) hosts
GROUP BY site
"""

# A robots file per site of some hundred rules a page: some block single pages or
# their beginnings, most fit none, and one that allows comes before all.
MANY_RULES = f"""
SELECT site, 'User-agent: *' || chr(10) || 'Allow: /en/1' || chr(10) || string_agg(rule, chr(10)) AS text
FROM (
  SELECT {site_name('page_id % 9')} AS site,
         CASE page_id % 3 WHEN 0 THEN 'Disallow: /en/' || CAST(page_id AS STRING)
              WHEN 1 THEN 'Disallow: ' || substr(regexp_extract(url, '//[^/]*(/[^?#]*)', 1), 1, 5) ELSE '# none' END AS rule
  FROM pages
  UNION ALL
  SELECT {site_name('page_id % 9')} AS site, 'Disallow: /none/' || CAST(page_id * 400 + k AS STRING) || repeat('x', CAST(k % 40 AS INT)) AS rule
  FROM pages CROSS JOIN (SELECT DISTINCT doc_id % 400 AS k FROM documents) steps
) rules GROUP BY site
"""

# The same lines one by one, numbered in a file's order; a site's file grows with
# the pages, and past some size no value holds it.
MANY_RULE_LINES = f"""
SELECT {site_name('page_id % 9')} AS site, CAST(floor(page_id / 9) AS BIGINT) * 401 AS no,
       CASE page_id % 3 WHEN 0 THEN 'Disallow: /en/' || CAST(page_id AS STRING)
            WHEN 1 THEN 'Disallow: ' || substr(regexp_extract(url, '//[^/]*(/[^?#]*)', 1), 1, 5) ELSE '# none' END AS raw
FROM pages
UNION ALL
SELECT {site_name('page_id % 9')} AS site, CAST(floor(page_id / 9) AS BIGINT) * 401 + 1 + k AS no,
       'Disallow: /none/' || CAST(page_id * 400 + k AS STRING) || repeat('x', CAST(k % 40 AS INT)) AS raw
FROM pages CROSS JOIN (SELECT DISTINCT doc_id % 400 AS k FROM documents) steps
UNION ALL
SELECT site, n AS no, CASE n WHEN -2 THEN 'User-agent: *' ELSE 'Allow: /en/1' END AS raw
FROM (SELECT DISTINCT {site_name('page_id % 9')} AS site FROM pages) sites
CROSS JOIN (SELECT CAST(-2 AS BIGINT) AS n UNION ALL SELECT CAST(-1 AS BIGINT)) heads
"""
