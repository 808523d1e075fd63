"""Result-sheet links from stored HTML pages.

The reference drives a browser over a live results site.  Here pages are
rows ``(page_id, url, html)``: a page is cut at its ``div`` tags, a running
depth over them finds each row block with all that is nested in it, and every test is a column
expression over the row's HTML.  Per-competition choices are partial
aggregates (``max_by``/``min_by``), so no group is gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline.functions.text import SKIP_COMPETITION_WORDS, last_path_element, py_squash, upper_contains

# The page structure and the event test of the reference.
ROW_CLASS, ROUND_CLASS, TWO_CLASS, DETAIL_CLASS = "row", "round", "two", "detail"


def _open_tag(tag: str, css_class: str) -> str:
    """An opening tag whose class list contains ``css_class`` (any other attributes, either quote)."""
    return (rf"<{tag}\b[^>]*?\bclass\s*=\s*[\"'](?:[^\"']*\s)?{css_class}(?:\s[^\"']*)?[\"'][^>]*>")


ROW_TAG = _open_tag("div", ROW_CLASS)
ROUND_TEXT = "(?s)" + _open_tag("p", ROUND_CLASS) + r"(.*?)</p>"
TWO_LINK = _open_tag("p", TWO_CLASS) + r"""\s*<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
DETAIL_LINK = ("(?s)" + _open_tag("h3", DETAIL_CLASS)
               + r"""\s*<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>""")
ANCHOR_HREF = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
SPORT_WORD = "SWIMMING"
EVENT_WORDS = ("FREESTYLE", "400")
EVENT_EXCLUDE = "25"
DEFAULT_BASE_URL = "https://results.example.org"


# Character references decoded in visible text (``&amp;`` last).
ENTITIES = [("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&#x27;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def html_unescape(c: Column) -> Column:
    """Decode the common character references, as a browser's text does."""
    for ref, ch in ENTITIES:
        c = F.replace(c, F.lit(ref), F.lit(ch))
    return c


def visible_text(html: Column) -> Column:
    """Text of an HTML fragment: tags dropped, references decoded, blanks collapsed."""
    return py_squash(html_unescape(F.regexp_replace(html, "<[^>]*>", " ")))


def row_blocks(html: Column) -> Column:
    """The content of each outermost row block, in page order.

    The page is cut before every ``<div`` and ``</div>``; one pass over the pieces keeps the depth, the depth at which
    the open row began (-1: none), its content so far and the rows done.  A row nested in another belongs to it;
    a row that is never closed runs to the page's end; a closing tag without an opening one counts as none.
    """
    # what a piece is, is told once, before the pass: in the step every use of an expression is evaluated again
    pieces = F.transform(F.split(html, r"(?i)(?=<(?:div\b|/div\s*>))", -1), lambda p: F.struct(
        p.alias("html"), F.when(p.rlike(r"(?i)^<div\b"), 1).when(p.rlike(r"(?i)^</div"), -1).otherwise(0).alias("step"),
        p.rlike("^" + ROW_TAG).alias("row")))
    state = F.struct(F.lit(0).alias("depth"), F.lit(-1).alias("row"), F.lit("").alias("text"), F.array().cast("array<string>").alias("rows"))

    def step(a: Column, piece: Column) -> Column:
        depth = F.greatest(a["depth"] + piece["step"], F.lit(0))
        starts = (piece["step"] > 0) & (a["row"] < 0) & piece["row"]
        ends = (piece["step"] < 0) & (a["row"] >= 0) & (depth <= a["row"])
        row = F.when(starts, a["depth"]).when(ends, -1).otherwise(a["row"])
        text = (F.when(starts, F.regexp_replace(piece["html"], "^" + ROW_TAG, "")).when(ends | (a["row"] < 0), F.lit(""))
                .otherwise(F.concat(a["text"], piece["html"])))
        return F.struct(depth.alias("depth"), row.alias("row"), text.alias("text"),
                        F.when(ends, F.array_append(a["rows"], a["text"])).otherwise(a["rows"]).alias("rows"))

    return F.aggregate(pieces, state, step, lambda a: F.when(a["row"] >= 0, F.array_append(a["rows"], a["text"])).otherwise(a["rows"]))


def page_rows(pages: DataFrame, keep: list[str] | None = None, html_col: str = "html") -> DataFrame:
    """The row blocks of each page in page order ``(…keep, row_pos, row_html)``, numbered from 1."""
    keep = keep if keep is not None else [c for c in pages.columns if c != html_col]
    found = pages.select(*keep, F.posexplode(row_blocks(F.col(html_col))).alias("row_pos", "row_html"))
    return found.withColumn("row_pos", F.col("row_pos") + 1)


def _once(rows: DataFrame, keep: list[str], *values: Column) -> DataFrame:
    """``keep`` and the values, which pass through a generator of their own: conditions on them are not pushed beneath it,
    where each condition would search the HTML again."""
    return rows.select(*keep, F.inline(F.array(F.struct(*values))))


def absolute_url(href: Column, base: Column | str) -> Column:
    """A path starting with '/' is joined to the base."""
    base_col = F.lit(base) if isinstance(base, str) else base
    return F.when(href.startswith("/"), F.concat(base_col, href)).otherwise(href)


def page_origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def anchor_links(pages: DataFrame) -> DataFrame:
    """L03/L05/F10 on any page: every ``<a href>`` in order, made absolute, with its file name."""
    hrefs = F.regexp_extract_all(F.col("html"), F.lit(ANCHOR_HREF), 1)
    rows = pages.select("page_id", "url", F.posexplode(hrefs).alias("pos", "href"))
    absolute = absolute_url(F.col("href"), page_origin(F.col("url")))
    return rows.select("page_id", "pos", "href", absolute.alias("abs_url"),
                       last_path_element(absolute).alias("file_name"))


# --------------------------------------------------------------------------- competition list

def competition_rows(list_pages: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Swimming competitions of each year page ``(year, page_id, row_pos, competition, href)``.

    Rows whose visible text lacks SWIMMING, rows without a detail link and
    links not under ``/{year}/`` are dropped.
    """
    rows = page_rows(list_pages, keep=["page_id", "year"])
    found = _once(rows, ["year", "page_id", "row_pos"], F.regexp_extract("row_html", DETAIL_LINK, 1).alias("link"),
                  visible_text(F.regexp_extract("row_html", DETAIL_LINK, 2)).alias("competition"),
                  upper_contains(visible_text(F.col("row_html")), SPORT_WORD).alias("swimming"))
    out = found.select("year", "page_id", "row_pos", "competition", absolute_url(F.col("link"), base_url).alias("href"),
                       "swimming", (F.col("link") != "").alias("has_link"))
    in_year = F.col("href").contains(F.concat(F.lit("/"), F.col("year").cast("string"), F.lit("/")))
    return out.filter(F.col("swimming") & F.col("has_link") & in_year).drop("swimming", "has_link")


def dedupe_first_seen(rows: DataFrame) -> DataFrame:
    """One row per (year, href), the first seen in page order (a partial aggregate)."""
    first = F.min_by(F.struct("page_id", "row_pos", "competition"), F.struct("page_id", "row_pos"))
    return (rows.groupBy("year", "href").agg(first.alias("f"))
            .select("year", F.col("f.page_id").alias("page_id"), F.col("f.row_pos").alias("row_pos"),
                    F.col("f.competition").alias("competition"), "href"))


def drop_skipped_names(rows: DataFrame, words=tuple(SKIP_COMPETITION_WORDS)) -> DataFrame:
    """Competitions whose upper-cased name holds 25M or SHORT COURSE are not visited."""
    up = F.upper(F.col("competition"))
    cond = F.lit(False)
    for w in words:
        cond = cond | up.contains(w)
    return rows.filter(~cond)


def year_range(rows: DataFrame, start: int, end: int) -> DataFrame:
    """Years from start to end, both included."""
    return rows.filter(F.col("year").between(start, end))


# --------------------------------------------------------------------------- competition pages

def event_links(portal_pages: DataFrame, base_url: str = DEFAULT_BASE_URL, exclude_25: bool = True) -> DataFrame:
    """400 m freestyle events of each page with their result link and sex.

    ``exclude_25=False`` is the older event test, which lets texts with 25 pass.
    """
    rows = page_rows(portal_pages, keep=["url", "page_id"])
    found = _once(rows, ["url", "page_id", "row_pos"], visible_text(F.regexp_extract("row_html", ROUND_TEXT, 1)).alias("text"),
                  F.regexp_extract_all(F.col("row_html"), F.lit(TWO_LINK), 1).alias("links"))
    text, links = F.col("text"), F.col("links")
    is_event = upper_contains(text, EVENT_WORDS[0]) & upper_contains(text, EVENT_WORDS[1])
    if exclude_25:
        is_event = is_event & ~upper_contains(text, EVENT_EXCLUDE)
    second = F.when(F.size(links) >= 2, F.get(links, 1))
    sex = F.when(upper_contains(text, "WOMEN"), "F").when(upper_contains(text, "MEN"), "M")
    return (found.select("url", "page_id", "row_pos", is_event.alias("is_event"),
                        absolute_url(second, base_url).alias("link"), sex.alias("sex"))
            .filter(F.col("is_event") & F.col("link").isNotNull() & F.col("sex").isNotNull())
            .drop("is_event"))


def links_per_competition(events: DataFrame) -> DataFrame:
    """Last men's and last women's link per competition url (pages in page order,
    rows in page order); competitions with neither are dropped."""
    order = F.struct("page_id", "row_pos")
    pick = lambda s: F.max_by(F.when(F.col("sex") == s, F.col("link")),
                              F.when(F.col("sex") == s, order))
    out = events.groupBy("url").agg(pick("M").alias("mens_400_free_pdf"),
                                     pick("F").alias("womens_400_free_pdf"))
    return out.filter(F.col("mens_400_free_pdf").isNotNull() | F.col("womens_400_free_pdf").isNotNull())


# --------------------------------------------------------------------------- whole job (S06 shape) and counters

def link_table(list_pages: DataFrame, portal_pages: DataFrame, start: int, end: int,
               base_url: str = DEFAULT_BASE_URL, dedupe: bool = True) -> DataFrame:
    """Competitions of the chosen years joined to their pages: ``(year, competition, mens…, womens…)``."""
    comps = year_range(competition_rows(list_pages, base_url), start, end)
    if dedupe:
        comps = dedupe_first_seen(comps)
    visited = drop_skipped_names(comps)
    per_page = links_per_competition(event_links(portal_pages, base_url))
    joined = visited.join(per_page, visited["href"] == per_page["url"], "inner")
    return joined.select(F.col("year").cast("int").alias("year"), "competition",
                         "mens_400_free_pdf", "womens_400_free_pdf")


def year_counters(spark: SparkSession, list_pages: DataFrame, links: DataFrame, start: int, end: int,
                  base_url: str = DEFAULT_BASE_URL, dedupe: bool = True) -> DataFrame:
    """Per year, competitions found (before the name filter) and link rows saved; zero years kept."""
    comps = year_range(competition_rows(list_pages, base_url), start, end)
    if dedupe:
        comps = dedupe_first_seen(comps)
    found = comps.groupBy("year").agg(F.count(F.lit(1)).alias("found"))
    saved = links.groupBy("year").agg(F.count(F.lit(1)).alias("saved"))
    years = spark.range(start, end + 1).select(F.col("id").cast("int").alias("year"))
    return (years.join(found, "year", "left").join(saved, "year", "left")
            .select("year", F.coalesce("found", F.lit(0)).cast("bigint").alias("found"),
                    F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved")))
