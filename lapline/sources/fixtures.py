"""Race data derived from the driver tables, so every job grows with them.

* ``canonical_results``: one swimmer row per ``lineitem`` row; a race is an
  order, the rank is the line number (lines that share one are tied).  Every
  value is made from the row's own keys, so this is a scan and a projection.
* ``raw_results``: the same rows as the parser emits them (times as text).
* ``render_sheets``: result-sheet texts, one per race and session, in the layout
  the parser reads.  A session holds the swimmers of ``SESSION_SUPPLIERS``
  suppliers, so a race with many rows has many sheets.  Parsing them must
  give back ``raw_results`` (rows with a final time; the others are DSQ lines).
* ``render_mixed_sheets``: the same swimmers in a dozen messy layouts.
* ``portal_pages`` / ``competition_list_pages``: HTML rendered from ``orders``:
  a competition is one customer's orders in one year, an event is one order;
  a page holds the orders of one block of ``PAGE_KEYS`` order keys.

The exact same definitions exist as DuckDB SQL in ``lapline.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.functions.times import small_idiv as idiv
from lapline.sources.tables import read_table

# Fixed values of the fixture layout (shared with the SQL oracle).
BASE_URL = "https://results.example.org"
EVENT_NO = "105"
SESSION_SUPPLIERS = 25    # suppliers whose swimmers share a sheet of a race
PAGE_KEYS = 64            # order keys whose events share a page


def race_link(orderkey: F.Column) -> F.Column:
    return F.concat(F.lit(BASE_URL + "/File/R"), orderkey.cast("string"), F.lit(".pdf"))


def _div(a: F.Column, b: int) -> F.Column:
    """Integer division of non-negative numbers."""
    return F.call_function("div", a, F.lit(b))


def _two(c: F.Column) -> F.Column:
    """A number from 0 to 99 as two digits, looked up in a constant: little code for a value that stands in many columns."""
    return F.get(F.split(F.lit(" ".join(f"{i:02d}" for i in range(100))), " "), c.cast("int"))


def _time_text(cs: F.Column) -> F.Column:
    """Hundredths to ``SS.cc`` or ``M:SS.cc``."""
    minutes = F.when(cs >= 6000, F.concat(_div(cs, 6000).cast("string"), F.lit(":"))).otherwise("")
    return F.concat(minutes, _two(_div(cs, 100) % 60), F.lit("."), _two(cs % 100))


def _with_texts(cs: DataFrame) -> DataFrame:
    """Adds ``times``: the texts of the time columns, made by one expression for all of them (a generated method over
    8,000 bytes is not compiled by the JVM)."""
    return cs.withColumn("times", F.transform(F.array(*[F.col(f"{c}_cs") for c in S.TIME_COLS]), _time_text))


def _time(column: str) -> F.Column:
    return F.get("times", S.TIME_COLS.index(column))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def results_cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical swimmer rows with every time as integer hundredths (``*_cs``)."""
    return _swimmers(_lines(spark, sf_dir))


def _swimmers(r: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The swimmer row of each line; ``keep``: further columns of the lines that it carries."""
    f_cs = F.lit(22000) + F.pmod(F.col("l_partkey") * 37 + F.col("l_suppkey") * 11
                                 + F.col("l_linenumber") * 13, F.lit(6000))
    r = r.withColumn("f_cs", f_cs)
    cols = [
        race_link(F.col("l_orderkey")).alias("Link"),
        F.when(F.pmod("l_orderkey", F.lit(2)) == 0, "M").otherwise("F").alias("sex"),
        F.when(F.col("l_linenumber") <= 3, "Final A").when(F.col("l_linenumber") <= 6, "Final B")
         .otherwise("Final C").alias("heat"),
        F.col("l_linenumber").cast("int").alias("rank"),
        F.col("l_linenumber").cast("int").alias("lane"),
        F.concat(F.lit("SWIM"), F.expr("chr(CAST(65 + pmod(l_suppkey, 26) AS INT))")).alias("last_name"),
        F.concat(F.lit("Ann"), F.expr("chr(CAST(97 + pmod(l_partkey, 26) AS INT))"),
                 F.when(F.pmod("l_partkey", F.lit(29)) == 0, " S9").otherwise("")).alias("first_name"),
        F.when(F.pmod("l_linenumber", F.lit(5)) == 0, F.lit(None).cast("bigint"))
         .otherwise(55 + F.pmod("l_partkey", F.lit(40))).alias("reaction_cs"),
    ]
    for k, c in enumerate(S.TIME_SPLITS, start=1):
        v = _div(F.col("f_cs") * k, 8) + F.pmod(F.col("l_linenumber") * 7 + k * 3, F.lit(40))
        if k >= 6:
            v = F.when(F.pmod("l_linenumber", F.lit(3)) == 0, F.lit(None).cast("bigint")).otherwise(v)
        cols.append(v.alias(f"{c}_cs"))
    cols.append(F.when(F.pmod("l_suppkey", F.lit(23)) == 0, F.lit(None).cast("bigint"))
                .otherwise(F.col("f_cs")).alias("final_time_cs"))
    cols += [idiv(F.col("l_suppkey"), F.lit(SESSION_SUPPLIERS)).alias("session"),
             F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("line_order")]
    return r.select(*keep, *cols)


def canonical_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed results table (C01/C03 output shape): times as DOUBLE seconds."""
    cs = results_cs(spark, sf_dir)
    out = [F.col(c) for c in ("Link", "heat", "rank", "lane", "last_name", "first_name")]
    out.append((F.col("reaction_cs") / F.lit(100.0)).alias("reaction_time"))
    out += [(F.col(f"{c}_cs") / F.lit(100.0)).alias(c) for c in S.TIME_COLS]
    out.append(F.col("sex"))
    return cs.select(*out)


def raw_results(spark: SparkSession, sf_dir: str, with_sex: bool = True) -> DataFrame:
    """The parser's output shape: reaction as DOUBLE, splits and final as text."""
    cs = _with_texts(results_cs(spark, sf_dir))
    out = [F.col(c) for c in ("Link", "heat", "rank", "lane", "last_name", "first_name")]
    out.append((F.col("reaction_cs") / F.lit(100.0)).alias("reaction_time"))
    out += [_time(c).alias(c) for c in S.TIME_COLS]
    if with_sex:
        out.append(F.col("sex"))
    return cs.select(*out)


def _splits_text(sep: str = " ") -> F.Column:
    """``50m (1) {t} 100m (1) {t} ...`` with missing parts left out."""
    labels = F.array(*[F.lit(f"{d}m (1) ") for d in S.SPLIT_DISTANCES])
    return F.array_join(F.zip_with(labels, F.slice("times", 1, len(S.TIME_SPLITS)), lambda d, t: F.concat(d, t)), sep)


def _reaction_text() -> F.Column:
    return F.when(F.col("reaction_cs").isNotNull(),
                  F.concat(F.lit("0."), _two(F.col("reaction_cs")), F.lit(" "))).otherwise("")


def _entry() -> F.Column:
    """A swimmer's lines: ``{rank} {lane} {last} {first} USA [0.rr] {final}`` and the splits line;
    without a final time one ``DSQ`` line, which the parser drops."""
    name = F.concat(F.col("lane").cast("string"), F.lit(" "), F.col("last_name"), F.lit(" "), F.col("first_name"), F.lit(" USA"))
    swimmer = F.concat(F.col("rank").cast("string"), F.lit(" "), name, F.lit(" "), _reaction_text(),
                       _time("final_time"), F.lit("\n"), _splits_text())
    return F.when(F.col("final_time_cs").isNull(), F.concat(F.lit("DSQ "), name)).otherwise(swimmer)


def _shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _sheet_texts(rows: DataFrame, dealt_by: tuple[str, ...] = ()) -> DataFrame:
    """``(Link, sex, session, header, line_order, entry)`` to one text per Link and session.

    Layout: ``Results``; per heat its ``header`` and ``Rank Lane Name``; the entries in line order.
    ``dealt_by``: columns the rows are already dealt by that are the same within a sheet, so it is gathered where it lies.
    """
    per_sheet = rows.groupBy(*dealt_by, "Link", "sex", "session").agg(
        F.array_sort(F.collect_list(F.struct("line_order", "header", "entry"))).alias("rows"))
    body = F.transform(
        "rows",
        lambda x, i: F.concat(
            F.when((i == 0) | (F.get(F.col("rows"), i - 1)["header"] != x["header"]),
                   F.concat(x["header"], F.lit("\nRank Lane Name\n"))).otherwise(F.lit("")),
            x["entry"], F.lit("\n")))
    return per_sheet.select("Link", "sex", "session", F.concat(F.lit("Results\n"), F.array_join(body, "")).alias("text"))


def render_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result-sheet texts ``(Link, sex, session, text)``, one per race and session.

    The lines are dealt by sheet as the numbers they are and their texts are made where they are gathered, so the shuffle
    holds no text; a race (a Link) is one order, a session one block of suppliers.
    """
    block = idiv(F.col("l_suppkey"), F.lit(SESSION_SUPPLIERS)).alias("block")
    dealt = _lines(spark, sf_dir).select("*", block).repartition(_shuffle_partitions(spark), "l_orderkey", "block")
    cs = _with_texts(_swimmers(dealt, ("l_orderkey", "block")))
    header = F.concat(F.col("heat"), F.lit(f" Event {EVENT_NO}"))
    return _sheet_texts(cs.select("l_orderkey", "block", "Link", "sex", "session", header.alias("header"), "line_order", _entry().alias("entry")),
                        ("l_orderkey", "block"))


MIXED_LAYOUTS = 12


def mixed_layout(rows: DataFrame) -> F.Column:
    """Which layout a swimmer of a mixed sheet has, from the row's keys."""
    o = F.col("line_order")
    return F.pmod(o["l_partkey"] * 7 + o["l_suppkey"] * 3 + o["l_linenumber"], F.lit(MIXED_LAYOUTS))


def render_mixed_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy sheets ``(Link, text)``: one layout per swimmer, lower-case headers in every fourth race.

    Layouts: 0 plain; 1 ``=n`` rank; 2 ``Tn`` rank; 3 no splits line; 4 a decoy split on the swimmer line
    itself; 5 a distance given twice; 6 a soft hyphen in the last name; 7 names of several words; 8 a
    country code with a region; 9 noise lines before the splits; 10 wide brackets; 11 blanks and tabs
    around the line.  Rows without a final time are DSQ lines.
    """
    cs = _with_texts(results_cs(spark, sf_dir))
    k = mixed_layout(cs)
    rank = F.concat(F.when(k == 1, "=").when(k == 2, "T").otherwise(""), F.col("rank").cast("string"))
    last = (F.when(k == 6, F.concat(F.lit("O\u00ad"), F.col("last_name")))
            .when(k == 7, F.concat(F.lit("VAN DE "), F.col("last_name"))).otherwise(F.col("last_name")))
    first = F.when(k == 7, F.concat(F.col("first_name"), F.lit(" Lea"))).otherwise(F.col("first_name"))
    code = F.when(k == 8, " GBR-ENG").otherwise(" USA")
    name = F.concat(F.col("lane").cast("string"), F.lit(" "), last, F.lit(" "), first, code)
    swimmer = F.concat(rank, F.lit(" "), name, F.lit(" "), _reaction_text(), _time("final_time"))
    cs = cs.select("Link", "sex", "session", "heat", "line_order", "final_time_cs", k.alias("k"), name.alias("name"),
                   swimmer.alias("swimmer"), _splits_text().alias("splits"))
    k, swimmer, splits = F.col("k"), F.col("swimmer"), F.col("splits")
    plain = F.concat(swimmer, F.lit("\n"), splits)
    entry = (F.when(k == 3, swimmer)
             .when(k == 4, F.concat(swimmer, F.lit(" 50m 11.11\n"), splits))
             .when(k == 5, F.concat(swimmer, F.lit("\n50m (1) 10.00 "), splits))
             .when(k == 9, F.concat(swimmer, F.lit("\nPage 3 of 9\n\nLegend: DSQ disqualified\n"), splits))
             .when(k == 10, F.translate(plain, "()", "\uff08\uff09"))
             .when(k == 11, F.concat(F.lit(" \t"), F.replace(plain, F.lit("\n"), F.lit("\u00a0\r\n  ")), F.lit("\t")))
             .otherwise(plain))
    entry = F.when(F.col("final_time_cs").isNull(), F.concat(F.lit("DSQ "), F.col("name"))).otherwise(entry)
    number = F.regexp_extract("Link", r"R([0-9]+)\.pdf$", 1).cast("bigint")
    heat = F.when(F.pmod(number, F.lit(4)) == 1, F.lower("heat")).otherwise(F.col("heat"))
    rows = cs.select("Link", "sex", "session", F.concat(heat, F.lit(f" Event {EVENT_NO}")).alias("header"), "line_order", entry.alias("entry"))
    return _sheet_texts(rows).select("Link", "text")


# --------------------------------------------------------------------------- web pages

def _competitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events (orders) with their competition (customer, year) and page fields."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    year = F.year("o_orderdate")
    key = F.col("o_orderkey")
    sex_word = (F.when(F.pmod(key, F.lit(7)) == 0, "Mixed")
                .when(F.pmod(key, F.lit(2)) == 0, "Men's").otherwise("Women's"))
    dist = F.when(F.pmod(key, F.lit(5)) == 0, "200m").otherwise("400m")
    pool = F.when(F.pmod(key, F.lit(11)) == 0, " (25m pool)").otherwise("")
    rnd = F.when(F.col("o_orderstatus") == "F", "   Final").otherwise("   Heats")
    name = F.concat(F.lit("COMPETITION "), F.col("o_custkey").cast("string"),
                    F.when(F.pmod("o_custkey", F.lit(6)) == 0, " WORLD CUP").otherwise(""),
                    F.when(F.pmod("o_custkey", F.lit(9)) == 0, " 25M").otherwise(""),
                    F.when(F.pmod("o_custkey", F.lit(10)) == 0, " Short Course").otherwise(""))
    return o.select(
        key, F.col("o_custkey"), F.col("o_orderdate"), year.alias("year"),
        F.concat(sex_word, F.lit(" Freestyle "), dist, pool, rnd).alias("event_text"),
        name.alias("competition"),
        F.concat(F.lit(BASE_URL + "/"), year.cast("string"), F.lit("/comp-"),
                 F.col("o_custkey").cast("string")).alias("comp_url"))


def portal_pages(spark: SparkSession, sf_dir: str, nested: bool = False) -> DataFrame:
    """Competition pages ``(page_id, url, html)``; ``nested``: an event's links stand in a row block within its own, beside a
    row block of another event that is not its own.  Otherwise: a (customer, year)'s events in order of key; the next block of
    keys continues on another page with the same url.  ``page_id`` is the first order key on the page."""
    ev = _competitions(spark, sf_dir)
    key = F.col("o_orderkey").cast("string")
    first = F.concat(F.lit('<p class="two"><a href="/File/S'), key, F.lit('.pdf" target="_blank">x</a></p>'))
    second = F.concat(F.lit('<p class="two"><a href="/File/R'), key, F.lit('.pdf" target="_blank">x</a></p>'))
    links = F.when(F.pmod("o_orderkey", F.lit(13)) == 0, first).otherwise(F.concat(first, second))
    row = F.concat(F.lit('<div class="row"><p class="round">'), F.col("event_text"),
                   F.lit('</p><div class="other">'), links, F.lit("</div></div>"))
    if nested:
        row = F.concat(F.lit('<div class="list"><div class="row"><div class="head"><p class="round">'), F.col("event_text"),
                       F.lit('</p></div><DIV class="row other">'), links, F.lit('</DIV><div class="row"><p class="round">Women\'s Freestyle 400m</p></div></div></div>'))
    rows = ev.select("comp_url", "o_orderkey", row.alias("row"), idiv(F.col("o_orderkey"), F.lit(PAGE_KEYS)).alias("keys"))
    page = rows.groupBy("comp_url", "keys").agg(
        F.min("o_orderkey").alias("page_id"), F.array_sort(F.collect_list(F.struct("o_orderkey", "row"))).alias("rows"))
    html = F.concat(F.lit('<html><div class="page-wrapper"><div class="block-table">\n'),
                    F.array_join(F.transform("rows", lambda x: x["row"]), "\n"),
                    F.lit("\n</div></div></html>"))
    return page.select("page_id", F.col("comp_url").alias("url"), html.alias("html"))


def competition_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year result-list pages ``(page_id, year, url, html)``, one row per order.

    A year's list runs in order of key over pages of ``PAGE_KEYS`` order keys.  Mixed in:
    other sports, links to the wrong year, repeated links (one row per order
    of a competition), relative and absolute links, 25M / Short Course names.
    """
    ev = _competitions(spark, sf_dir)
    key = F.col("o_orderkey")
    sport = F.when(F.pmod(key, F.lit(8)) == 3, "DIVING").otherwise("Swimming")
    link_year = F.when(F.pmod(key, F.lit(19)) == 0, F.col("year") - 1).otherwise(F.col("year"))
    rel = F.concat(F.lit("/"), link_year.cast("string"), F.lit("/comp-"), F.col("o_custkey").cast("string"))
    href = F.when(F.pmod(key, F.lit(2)) == 0, F.concat(F.lit(BASE_URL), rel)).otherwise(rel)
    row = F.concat(F.lit('<div class="row"><h3 class="detail"><a href="'), href, F.lit('">'),
                   F.col("competition"), F.lit("</a></h3><p>"), sport, F.lit("</p></div>"))
    rows = ev.select("year", "o_orderkey", row.alias("row"), idiv(F.col("o_orderkey"), F.lit(PAGE_KEYS)).alias("keys"))
    page = rows.groupBy("year", "keys").agg(
        F.min("o_orderkey").alias("page_id"), F.array_sort(F.collect_list(F.struct("o_orderkey", "row"))).alias("rows"))
    html = F.concat(F.lit('<html><div class="results-page"><div class="page-wrapper"><div class="block-table">\n'),
                    F.array_join(F.transform("rows", lambda x: x["row"]), "\n"),
                    F.lit("\n</div></div></div></html>"))
    return page.select("page_id", F.col("year").cast("int").alias("year"),
                       F.concat(F.lit(BASE_URL + "/results?year="), F.col("year").cast("string")).alias("url"),
                       html.alias("html"))


def render_sheet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sheets as pages ``(Link, session, page, text)``: a title page, one page per heat.

    Joining a sheet's pages with newlines (S12, page form) gives a text that
    parses to the same rows as ``render_sheets``.  Every third race also has
    an empty trailing page, which the page join must skip.
    """
    cs = _with_texts(results_cs(spark, sf_dir))
    per_heat = (cs.select("Link", "session", "heat", "line_order", _entry().alias("entry"))
                .groupBy("Link", "session", "heat")
                .agg(F.array_sort(F.collect_list(F.struct("line_order", "entry"))).alias("rows")))
    heat_pages = per_heat.select(
        "Link", "session", (F.ascii(F.substring("heat", 7, 1)) - 64).cast("int").alias("page"),
        F.concat(F.col("heat"), F.lit(f" Event {EVENT_NO}\nRank Lane Name\n"),
                 F.array_join(F.transform("rows", lambda x: x["entry"]), "\n")).alias("text"))
    sheets = cs.select("Link", "session", F.regexp_extract("Link", r"R([0-9]+)\.pdf$", 1).cast("bigint").alias("k")).distinct()
    title = sheets.select("Link", "session", F.lit(0).alias("page"), F.lit("Results").alias("text"))
    blank = sheets.filter(F.pmod("k", F.lit(3)) == 0).select(
        "Link", "session", F.lit(99).alias("page"), F.lit(None).cast("string").alias("text"))
    return title.unionByName(heat_pages).unionByName(blank)
