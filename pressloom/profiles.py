"""Site profiles: where each site keeps its links and release fields.

A site is a row of data.  Adding one means adding a row here or passing a
profile table of the same schema; the jobs stay as they are.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEP = (
    "struct<tag:string,class_token:string,class_exact:string,id:string,style:string,"
    "text_eq:string,text_re:string,href_part:string,axis:string,nth:int>"
)
SELECTOR = f"struct<field:string,steps:array<{STEP}>,text_mode:string,strict:boolean>"
PROFILE_SCHEMA = (
    "array<struct<site:string,base_url:string,page_prefix:string,page_suffix:string,"
    "first_is_base:boolean,first_page:int,page_cap:int,stop_after:int,robots:boolean,"
    f"link_item:{STEP},link_steps:array<{STEP}>,links_distinct:boolean,href_required:boolean,"
    f"selectors:array<{SELECTOR}>,content_mode:string,p_mode:string,dedupe_text:boolean,extra_label:string,extra_default:string>>"
)


@dataclass(frozen=True)
class Step:
    """One hop: every given test must hold; ``nth`` counts matches from 1."""

    tag: str | None = None
    class_token: str | None = None
    class_exact: str | None = None
    id: str | None = None
    style: str | None = None
    text_eq: str | None = None
    text_re: str | None = None
    href_part: str | None = None
    axis: str = "descendant"
    nth: int = 1


@dataclass(frozen=True)
class Selector:
    """A path to one field's element.  Selectors of a field are tried in order.

    ``text_mode``: raw (inner white space kept), stripped, or list (texts of all
    links inside, joined by a comma).  ``strict``: a path that starts but does
    not end is an error, not a missing value.
    """

    field: str
    steps: tuple[Step, ...]
    text_mode: str = "raw"
    strict: bool = False


@dataclass(frozen=True)
class SiteProfile:
    """``p_mode``: ``parser`` (no end tag is implied) or ``html5``.  ``dedupe_text``: a text comes once from ``all_strings``."""

    site: str
    base_url: str
    page_prefix: str
    link_item: Step
    selectors: tuple[Selector, ...]
    content_mode: str
    page_suffix: str = ""
    first_is_base: bool = False
    first_page: int = 1
    page_cap: int | None = None
    stop_after: int = 1
    robots: bool = False
    link_steps: tuple[Step, ...] = field(default=())
    links_distinct: bool = False
    href_required: bool = False
    p_mode: str = "parser"
    dedupe_text: bool = False
    extra_label: str | None = None
    extra_default: str | None = None


def _one(field_name: str, *steps: Step, mode: str = "raw", strict: bool = False) -> Selector:
    return Selector(field_name, steps, mode, strict)


_FIRST_LINK = (Step("a"),)

# Addresses, page limits and selectors of the sites covered.
SITES = (
    SiteProfile(
        site="aoc",
        base_url="https://ocasio-cortez.house.gov/media/press-releases",
        page_prefix="?page=", first_page=0,
        link_item=Step("div", class_token="h3"), link_steps=_FIRST_LINK,
        selectors=(
            _one("title", Step("h1", class_token="display-4")),
            _one("date", Step("div", class_token="evo-create-type"),
                 Step("div", class_token="col-auto"), strict=True),
            _one("extra", Step("span", class_token="field__label", text_eq="Issues:"),
                 Step("span", class_token="field__items", axis="following"),
                 mode="stripped", strict=True),
            _one("content", Step("div", class_token="evo-press-release__body")),
        ),
        content_mode="paragraphs_all",
        extra_label="Issues", extra_default="No issues found",
    ),
    SiteProfile(
        site="hawley",
        base_url="https://www.hawley.senate.gov/press-releases",
        page_prefix="/page/", page_suffix="/?et_blog", first_is_base=True,
        page_cap=92, stop_after=3,
        link_item=Step("article", class_token="et_pb_post"),
        link_steps=(Step("h2", class_token="entry-title"), Step("a")), href_required=True,
        selectors=(
            _one("title", Step("h1", class_token="entry-title")),
            _one("date", Step("span", class_token="published")),
            _one("content", Step("div", class_token="et_pb_post_content")),
        ),
        content_mode="lines",
    ),
    SiteProfile(
        site="lee",
        base_url="https://www.lee.senate.gov/press-releases",
        page_prefix="?page=", first_is_base=True, page_cap=119, stop_after=3,
        link_item=Step("div", class_token="element"),
        link_steps=(Step("h2", class_token="element-title"), Step("a")), href_required=True,
        selectors=(
            _one("title", Step("h1", class_token="element-title")),
            _one("date", Step("h3", class_token="element-date")),
            _one("content", Step("div", class_token="element-content")),
        ),
        content_mode="lines",
    ),
    SiteProfile(
        site="manchin",
        base_url="https://www.manchin.senate.gov/newsroom/press-releases",
        page_prefix="?PageNum_rs=", page_cap=298, stop_after=3,
        link_item=Step("a", href_part="/newsroom/press-releases/"), links_distinct=True,
        selectors=(
            _one("title", Step("h1", class_token="main_page_title")),
            _one("title", Step(text_re="Press Release")),
            _one("date", Step("span", class_exact="date black")),
            _one("date", Step(text_re=r"\w+\s+\d{1,2},\s+\d{4}")),
        ),
        content_mode="page_fallback",
    ),
    SiteProfile(
        site="markey",
        base_url="https://www.markey.senate.gov/news/press-releases?pagenum_rs=",
        page_prefix="", first_page=0, robots=True,
        link_item=Step("a", class_token="ArticleBlock__title__link"),
        selectors=(
            _one("title", Step("h1", class_exact="Heading Heading--h2")),
            _one("date", Step("div", class_token="ArticleBlock__date")),
            _one("content", Step("div", class_token="RawHTML")),
        ),
        content_mode="paragraphs_and_breaks",
    ),
    SiteProfile(
        site="mtg",
        base_url="https://greene.house.gov/news/documentquery.aspx?DocumentTypeID=27",
        page_prefix="&Page=",
        link_item=Step("h2", class_token="newsie-titler"), link_steps=_FIRST_LINK,
        selectors=(
            _one("title", Step("h2", class_token="newsie-titler"), mode="stripped"),
            _one("date", Step("b"), mode="stripped"),
            _one("extra", Step("div", id="ctl00_ctl21_CatTags"), mode="list"),
            _one("content", Step("div", class_token="newsbody")),
        ),
        content_mode="paragraphs",
        extra_label="Tags", extra_default="No tags found",
    ),
    SiteProfile(
        site="pocan",
        base_url="https://pocan.house.gov/media-center",
        page_prefix="?page=", first_page=0,
        link_item=Step("a", class_token="btn-primary", text_eq="Read More"), href_required=True,
        selectors=(
            _one("title", Step("div", class_token="block--pocan-evo-custom-62-page-title"),
                 Step("h1", class_token="display-4")),
            _one("date", Step("div", class_token="evo-create-type"),
                 Step("div", class_token="col-auto")),
            _one("extra", Step("div", class_token="evo-create-type"),
                 Step("div", class_token="col-auto", nth=2)),
            _one("content", Step("div", class_token="evo-press-release__body")),
        ),
        content_mode="blocks",
        extra_label="PR Tag", extra_default="No PR tag found",
    ),
    SiteProfile(
        site="sanders",
        base_url="https://www.sanders.senate.gov/media/press-releases",
        page_prefix="/", page_suffix="/", first_is_base=True, page_cap=425,
        link_item=Step("h2", class_token="elementor-post__title"), link_steps=_FIRST_LINK,
        selectors=(
            _one("title", Step("h1", class_token="elementor-heading-title")),
            _one("title", Step("h1", class_token="display-4")),
            _one("date", Step("span", class_token="elementor-icon-list-text")),
            _one("date", Step("span", class_token="elementor-post-info__item--type-date")),
            _one("date", Step("div", class_token="evo-create-type"),
                 Step("div", class_token="col-auto")),
            _one("extra", Step("h4", style="text-align: center;")),
            _one("content", Step("div", class_token="elementor-text-editor")),
            _one("content", Step("div", class_token="evo-press-release__body")),
            _one("content", Step("div", class_token="elementor-widget-container")),
        ),
        content_mode="all_strings",
        extra_label="Subtitle", extra_default="",
    ),
    SiteProfile(
        site="stefanik",
        base_url="https://stefanik.house.gov/press-releases",
        page_prefix="?page=",
        link_item=Step("td", class_token="recordListTitle"), link_steps=_FIRST_LINK,
        selectors=(
            _one("title", Step("h2", class_token="title"), mode="stripped"),
            _one("date", Step("span", class_token="year"), mode="stripped"),
            _one("content", Step("div", class_token="content")),
        ),
        content_mode="paragraphs",
    ),
)


def generic(content_mode: str = "paragraphs") -> SiteProfile:
    """Plain article pages: heading, article body, navigation links."""
    return SiteProfile(
        site="generic", base_url="", page_prefix="?page=",
        link_item=Step("nav"), link_steps=(Step("a"),),
        selectors=(_one("title", Step("h1")), _one("content", Step("article"))),
        content_mode=content_mode,
    )


def profile_rows(profiles: tuple[SiteProfile, ...]) -> Column:
    """The profiles as an array literal."""
    return F.from_json(F.lit(json.dumps([asdict(p) for p in profiles])), PROFILE_SCHEMA)


def site_profiles(spark: SparkSession, profiles: tuple[SiteProfile, ...] = SITES) -> DataFrame:
    """The profiles as a table.

    It is a literal in the plan, so Catalyst knows its few kilobytes and picks
    a broadcast join by itself; no hint that a larger table would inherit.
    """
    return spark.range(1).select(F.inline(profile_rows(profiles)))
