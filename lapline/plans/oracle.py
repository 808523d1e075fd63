"""DuckDB SQL used as the independent oracle for the registered queries.

The fixture definitions of ``lapline.sources.fixtures`` are restated here in
SQL over the driver's views; each query's oracle builds on these CTEs.
"""

from __future__ import annotations

# Stated here anew, so that a wrong pattern in the engine shows.
_SPACE = r"[\t-\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_EOL = r"\r\n|[\n-\r\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_NOISE = ("(?i)^(?:Legend|R\\.T\\.|Timing|SWM\\d|Record\\s+Splits|(?:WR|WC|CR|AR|US)\\s|\\d+:\\d{2}\\.\\d{2}\\s+\\d+:\\d{2}|Rank|NOC|Code|Points|"
          "Behind|Results|R.sultats|Name\\s+(?:Club|NOC)|Page\\s+\\d|Report\\s+Created|FINA/|Event\\s+\\d|Final\\s*[ABC]?\\s*(?:Event|$))")
_HREF = r"""<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""

BASE_URL = "https://results.example.org"

_SPLITS = ["split_50m", "split_100m", "split_150m", "split_200m", "split_250m",
           "split_300m", "split_350m"]


def _split_cs_sql() -> str:
    out = []
    for k, c in enumerate(_SPLITS, start=1):
        v = f"(f_cs * {k}) // 8 + (l_linenumber * 7 + {k * 3}) % 40"
        if k >= 6:
            v = f"CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE {v} END"
        out.append(f"  {v} AS {c}_cs")
    return ",\n".join(out)


RESULTS_CS = f"""
rc_t AS (SELECT *, 22000 + (l_partkey * 37 + l_suppkey * 11 + l_linenumber * 13) % 6000 AS f_cs FROM lineitem),
rc AS (
  SELECT '{BASE_URL}/File/R' || CAST(l_orderkey AS VARCHAR) || '.pdf' AS Link,
  CASE WHEN l_orderkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
  CASE WHEN l_linenumber <= 3 THEN 'Final A' WHEN l_linenumber <= 6 THEN 'Final B' ELSE 'Final C' END AS heat,
  CAST(l_linenumber AS INTEGER) AS "rank", CAST(l_linenumber AS INTEGER) AS lane,
  'SWIM' || chr(CAST(65 + l_suppkey % 26 AS INTEGER)) AS last_name,
  'Ann' || chr(CAST(97 + l_partkey % 26 AS INTEGER))
        || CASE WHEN l_partkey % 29 = 0 THEN ' S9' ELSE '' END AS first_name,
  CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE 55 + l_partkey % 40 END AS reaction_cs,
{_split_cs_sql()},
  CASE WHEN l_suppkey % 23 = 0 THEN NULL ELSE f_cs END AS final_time_cs,
  CAST(l_suppkey // 25 AS BIGINT) AS session, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM rc_t)"""


def secs(cs: str) -> str:
    return f"CAST({cs} AS DOUBLE) / 100"


def time_text(cs: str) -> str:
    return (f"CASE WHEN {cs} IS NULL THEN NULL WHEN {cs} >= 6000 THEN "
            f"printf('%d:%02d.%02d', {cs} // 6000, ({cs} % 6000) // 100, {cs} % 100) "
            f"ELSE printf('%02d.%02d', {cs} // 100, {cs} % 100) END")


_TIME_COLS = _SPLITS + ["final_time"]

TYPED = RESULTS_CS + """,
typed AS (
  SELECT Link, heat, "rank", lane, last_name, first_name, """ + secs("reaction_cs") + """ AS reaction_time,
  """ + ",\n  ".join(f"{secs(c + '_cs')} AS {c}" for c in _TIME_COLS) + """, sex
  FROM rc)"""

RAW = RESULTS_CS + """,
raw AS (
  SELECT Link, heat, "rank", lane, last_name, first_name, """ + secs("reaction_cs") + """ AS reaction_time,
  """ + ",\n  ".join(f"{time_text(c + '_cs')} AS {c}" for c in _TIME_COLS) + """, sex
  FROM rc)"""


def with_typed(body: str) -> str:
    return "WITH " + TYPED + "\n" + body


def with_raw(body: str) -> str:
    return "WITH " + RAW + "\n" + body


def half_up(sum_sql: str, n_sql: str, digits: int) -> str:
    k = 10 ** (digits - 2)
    return f"CAST((({sum_sql}) * {2 * k} + ({n_sql})) // (2 * ({n_sql})) AS DOUBLE) / {100 * k}"


QUERY_SQL = {
    "canonical_results": with_typed("SELECT * FROM typed"),
    "fastest_men": with_typed(
        "SELECT first_name, last_name, final_time FROM typed WHERE sex = 'M' AND final_time IS NOT NULL "
        "ORDER BY final_time, last_name, first_name LIMIT 10"),
    "fastest_women": with_typed(
        "SELECT first_name, last_name, final_time FROM typed WHERE sex = 'F' AND final_time IS NOT NULL "
        "ORDER BY final_time, last_name, first_name LIMIT 10"),
    "avg_final_by_sex": "WITH " + RESULTS_CS + "\n"
        "SELECT sex, " + half_up("s", "n", 2) + " AS avg_final_time FROM ("
        "SELECT sex, sum(final_time_cs) AS s, count(*) AS n FROM rc WHERE final_time_cs IS NOT NULL GROUP BY sex)",
    "avg_reaction_by_sex": "WITH " + RESULTS_CS + "\n"
        "SELECT sex, " + half_up("s", "n", 3) + " AS avg_reaction_time FROM ("
        "SELECT sex, sum(reaction_cs) AS s, count(*) AS n FROM rc WHERE reaction_cs IS NOT NULL GROUP BY sex)",
    "missing_late_splits": with_typed(
        "SELECT CAST(count(*) AS BIGINT) AS missing_late_splits FROM typed "
        "WHERE split_300m IS NULL OR split_350m IS NULL"),
    "swimmers_per_race_top10": with_typed(
        "SELECT Link, count(*) AS swimmer_count FROM typed GROUP BY Link "
        "ORDER BY swimmer_count DESC, Link LIMIT 10"),
    "fastest_per_race_top10": with_typed(
        "SELECT Link, min(final_time) AS fastest_time FROM typed WHERE final_time IS NOT NULL "
        "GROUP BY Link ORDER BY fastest_time, Link LIMIT 10"),
    "swimmers_per_race": with_typed(
        "SELECT Link, count(*) AS swimmer_count FROM typed GROUP BY Link"),
    "fastest_per_race": with_typed(
        "SELECT Link, min(final_time) AS fastest_time FROM typed WHERE final_time IS NOT NULL GROUP BY Link"),
    "avg_final_per_race": "WITH " + RESULTS_CS + "\n"
        "SELECT Link, " + half_up("s", "n", 2) + " AS avg_final_time FROM ("
        "SELECT Link, sum(final_time_cs) AS s, count(*) AS n FROM rc WHERE final_time_cs IS NOT NULL GROUP BY Link)",
    "distinct_races_by_sex": with_typed(
        "SELECT sex, count(DISTINCT Link) AS races FROM typed GROUP BY sex"),
    "total_races": with_typed(
        "SELECT CAST(sum(races) AS BIGINT) AS total_races FROM "
        "(SELECT sex, count(DISTINCT Link) AS races FROM typed GROUP BY sex)"),
    "shape_by_sex": with_typed(
        "SELECT sex, count(*) AS \"rows\", 16 AS \"columns\" FROM typed GROUP BY sex"),
    "final_time_range": with_typed(
        "SELECT sex, min(final_time) AS min_final_time, max(final_time) AS max_final_time FROM typed GROUP BY sex"),
    "final_time_range_text": with_raw(
        "SELECT sex, min(final_time) AS min_final_time, max(final_time) AS max_final_time FROM raw GROUP BY sex"),
    "slowest_women": with_typed(
        "SELECT first_name, last_name, final_time, Link FROM typed WHERE sex = 'F' "
        "ORDER BY final_time DESC NULLS LAST, first_name, last_name, Link LIMIT 10"),
    "preview": with_typed(
        "SELECT * FROM typed ORDER BY " + ", ".join(
            f"{c} ASC NULLS FIRST" for c in ["Link", "heat", '"rank"', "lane", "last_name", "first_name",
                                              "reaction_time", *_TIME_COLS, "sex"]) + " LIMIT 5"),
    "results_row_count": with_typed("SELECT count(*) AS row_count FROM typed"),
}


# --------------------------------------------------------------------------- sheets and documents

_RAW_COLS = ['Link', 'heat', '"rank"', 'lane', 'last_name', 'first_name', 'reaction_time',
             *_SPLITS, 'final_time']
_STRIP = f"'^{_SPACE}+|{_SPACE}+$'"
LINE_SEARCH_PATTERN = r"[A-Z][a-z]+ (?:the|de|la|der|und|el) "

_DOC_LINES = f"""
dl_parts AS (SELECT doc_id, text, regexp_split_to_array(text, '{_EOL}') AS parts
             FROM documents WHERE text IS NOT NULL),
dl_arr AS (SELECT doc_id, CASE WHEN text = '' THEN []::VARCHAR[]
                  WHEN regexp_matches(text, '(?:{_EOL})\\z') THEN parts[1:len(parts) - 1]
                  ELSE parts END AS arr FROM dl_parts),
dl_raw AS (SELECT doc_id, unnest(range(0, len(arr))) AS line_no, unnest(arr) AS raw_line FROM dl_arr),
dl AS (SELECT doc_id, CAST(line_no AS INTEGER) AS line_no,
              regexp_replace(raw_line, {_STRIP}, '', 'g') AS line FROM dl_raw)"""

_NL_LINES = """
nl_arr AS (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents WHERE text IS NOT NULL),
nl AS (SELECT doc_id, CAST(unnest(range(0, len(arr))) AS INTEGER) AS line_no, unnest(arr) AS line FROM nl_arr)"""

QUERY_SQL.update({
    "parse_sheets": with_raw("SELECT " + ", ".join(_RAW_COLS) + " FROM raw WHERE final_time IS NOT NULL"),
    "sheet_sections": "WITH " + RESULTS_CS + """
SELECT Link, session, CAST(row_number() OVER (PARTITION BY Link, session ORDER BY heat) AS INTEGER) AS section, heat,
       CAST(2 + sum(CASE WHEN final_time_cs IS NULL THEN 1 ELSE 2 END) AS BIGINT) AS n_lines
FROM rc GROUP BY Link, session, heat""",
    "sheet_head": with_raw("SELECT " + ", ".join(_RAW_COLS) + """ FROM (
  SELECT *, row_number() OVER (PARTITION BY Link ORDER BY heat, "rank", lane, last_name, first_name,
    reaction_time NULLS FIRST, """ + ", ".join(f"{c} NULLS FIRST" for c in _SPLITS) + """, final_time) AS i
  FROM raw WHERE final_time IS NOT NULL) WHERE i <= 2"""),
    "document_lines": "WITH " + _DOC_LINES + "\nSELECT doc_id, line_no, line FROM dl",
    "document_noise": "WITH " + _DOC_LINES + f"""
SELECT a.doc_id, CAST(len(a.arr) AS BIGINT) AS lines, CAST(coalesce(c.n, 0) AS BIGINT) AS noise_lines
FROM dl_arr a LEFT JOIN (
  SELECT doc_id, count(*) AS n FROM dl WHERE line = '' OR regexp_matches(line, '{_NOISE}')
  GROUP BY doc_id) c ON a.doc_id = c.doc_id""",
    "document_peek": "SELECT doc_id, substring(replace(text, chr(173), '-'), 1, 1200) "
                     "AS head FROM documents",
    "document_inspect_lines": "WITH " + _NL_LINES + "\nSELECT doc_id, line_no, line FROM nl WHERE line_no < 80",
    "document_line_search": "WITH " + _NL_LINES + "\nSELECT doc_id, line_no, line FROM nl "
                            f"WHERE regexp_matches(line, '^(?:{LINE_SEARCH_PATTERN})')",
})


# --------------------------------------------------------------------------- pages
_EVENTS = f"""
ev AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderdate AS dt, CAST(year(o_orderdate) AS INTEGER) AS y
       FROM orders),
evt AS (SELECT *, '{BASE_URL}/' || CAST(y AS VARCHAR) || '/comp-' || CAST(c AS VARCHAR) AS comp_url,
          'COMPETITION ' || CAST(c AS VARCHAR) || CASE WHEN c % 6 = 0 THEN ' WORLD CUP' ELSE '' END
            || CASE WHEN c % 9 = 0 THEN ' 25M' ELSE '' END
            || CASE WHEN c % 10 = 0 THEN ' Short Course' ELSE '' END AS competition,
          CASE WHEN k % 7 = 0 THEN 'X' WHEN k % 2 = 0 THEN 'M' ELSE 'F' END AS sx,
          (k % 5 <> 0 AND k % 11 <> 0 AND k % 13 <> 0) AS listed,
          (k % 5 <> 0 AND k % 13 <> 0) AS listed_with_25,
          '{BASE_URL}/File/R' || CAST(k AS VARCHAR) || '.pdf' AS link,
          k AS pos
        FROM ev),
portal AS (SELECT comp_url AS url,
          max_by(link, pos) FILTER (WHERE sx = 'M' AND listed) AS mens_400_free_pdf,
          max_by(link, pos) FILTER (WHERE sx = 'F' AND listed) AS womens_400_free_pdf
        FROM evt GROUP BY comp_url
        HAVING count(*) FILTER (WHERE sx IN ('M', 'F') AND listed) > 0),
comps AS (SELECT DISTINCT y AS year, competition, comp_url AS href FROM evt
          WHERE k % 8 <> 3 AND k % 19 <> 0 AND y BETWEEN 1996 AND 2000),
linktab AS (SELECT year, competition, mens_400_free_pdf, womens_400_free_pdf
          FROM comps JOIN portal ON comps.href = portal.url
          WHERE NOT (upper(competition) LIKE '%25M%' OR upper(competition) LIKE '%SHORT COURSE%'))"""

QUERY_SQL.update({
    "page_anchor_links": r"""
WITH pa AS (SELECT page_id, url, regexp_extract_all(html, '""" + _HREF.replace("'", "''") + r"""', 1) AS arr FROM pages),
pr AS (SELECT page_id, url, unnest(range(0, len(arr))) AS pos, unnest(arr) AS href FROM pa),
pb AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, href,
         CASE WHEN starts_with(href, '/')
              THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || href
              ELSE href END AS abs_url FROM pr)
SELECT page_id, pos, href, abs_url, string_split(abs_url, '/')[-1] AS file_name FROM pb""",
    "portal_links": "WITH " + _EVENTS + "\nSELECT * FROM portal",
    "competition_list": "WITH " + _EVENTS + "\nSELECT * FROM comps",
    "link_table": "WITH " + _EVENTS + "\nSELECT * FROM linktab",
    "link_year_counters": "WITH " + _EVENTS + """
SELECT CAST(r.range AS INTEGER) AS year,
       CAST(coalesce(f.n, 0) AS BIGINT) AS found, CAST(coalesce(s.n, 0) AS BIGINT) AS saved
FROM range(1996, 2001) r
LEFT JOIN (SELECT year, count(*) AS n FROM comps GROUP BY year) f ON f.year = r.range
LEFT JOIN (SELECT year, count(*) AS n FROM linktab GROUP BY year) s ON s.year = r.range""",
})


# --------------------------------------------------------------------------- cleaning
def secs_table(cs: str) -> str:
    """The table converter's arithmetic on the text form: int(m)*60 + float(ss.cc)."""
    return (f"CASE WHEN {cs} IS NULL THEN NULL WHEN {cs} >= 6000 THEN "
            f"CAST(({cs} // 6000) * 60 AS DOUBLE) + CAST({cs} % 6000 AS DOUBLE) / 100 "
            f"ELSE CAST({cs} AS DOUBLE) / 100 END")


_TYPED_FROM_TEXT = ("SELECT Link, heat, \"rank\", lane, last_name, first_name, " + secs("reaction_cs")
                    + " AS reaction_time, " + ", ".join(f"{secs_table(c + '_cs')} AS {c}" for c in _TIME_COLS)
                    + ", sex FROM rc WHERE final_time_cs IS NOT NULL")

_PREPARED = RESULTS_CS + """,
p0 AS (SELECT Link, heat, "rank", lane, last_name, first_name, """ + secs("reaction_cs") + """ AS reaction_time,
       """ + ", ".join(f"{secs(c + '_cs')} AS {c}" for c in _TIME_COLS) + """
       FROM rc WHERE final_time_cs IS NOT NULL
         AND split_50m_cs IS NOT NULL AND split_100m_cs IS NOT NULL AND split_150m_cs IS NOT NULL
         AND split_200m_cs IS NOT NULL AND split_250m_cs IS NOT NULL),
prepared AS (SELECT Link, heat, "rank", lane, last_name, first_name,
       coalesce(reaction_time, (SELECT quantile_cont(reaction_time, 0.5) FROM p0)) AS reaction_time,
       split_50m, split_100m, split_150m, split_200m, split_250m, split_300m, split_350m, final_time,
       split_100m - split_50m AS interval_split_100m, split_150m - split_100m AS interval_split_150m,
       split_200m - split_150m AS interval_split_200m, split_250m - split_200m AS interval_split_250m
       FROM p0)"""

_SHORT = "regexp_matches(competition, '(?i)WORLD CUP|SHORT COURSE|25M')"

QUERY_SQL.update({
    "results_table": "WITH " + RESULTS_CS + "\n" + _TYPED_FROM_TEXT,
    "para_filtered": with_typed(
        "SELECT * FROM typed WHERE first_name IS NULL OR NOT regexp_matches(first_name, 'S\\d|SB|SM')"),
    "short_course_filtered": "WITH " + TYPED + "," + _EVENTS + """
SELECT * FROM typed WHERE Link IS NULL OR Link NOT IN (
  SELECT mens_400_free_pdf FROM linktab WHERE """ + _SHORT + """ AND mens_400_free_pdf IS NOT NULL
  UNION SELECT womens_400_free_pdf FROM linktab WHERE """ + _SHORT + """ AND womens_400_free_pdf IS NOT NULL)""",
    "dropped_competitions": "WITH " + _EVENTS + "\nSELECT DISTINCT year, competition FROM linktab WHERE " + _SHORT,
    "prepared": "WITH " + _PREPARED + "\nSELECT * FROM prepared",
})


# --------------------------------------------------------------------------- statistics
_CORR = ["reaction_time", "split_50m", "split_100m", "split_150m", "split_200m", "split_250m", "final_time"]

QUERY_SQL.update({
    "correlation_matrix": "WITH " + _PREPARED + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{a}' AS row, '{b}' AS col, round(corr({a}, {b}), 6) AS r FROM prepared"
        for a in _CORR for b in _CORR),
    "final_time_histogram": "WITH " + TYPED + """,
v AS (SELECT final_time AS v FROM typed WHERE final_time IS NOT NULL AND NOT isnan(final_time)),
r0 AS (SELECT min(v) AS lo0, max(v) AS hi0 FROM v),
r AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM r0),
c AS (SELECT CAST(least(floor((v - lo) * (CAST(40 AS DOUBLE) / (hi - lo))), 39) + 1 AS INTEGER) AS bin,
             count(*) AS n FROM v, r GROUP BY 1),
g AS (SELECT CAST(b.range AS INTEGER) AS bin, lo + (b.range - 1) * ((hi - lo) / 40) AS lo_edge,
             lo + b.range * ((hi - lo) / 40) AS hi_edge FROM range(1, 41) b, r)
SELECT g.bin, lo_edge, hi_edge, CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM g LEFT JOIN c ON g.bin = c.bin""",
    "ols_split250": "WITH " + _PREPARED + """,
fit AS (SELECT regr_slope(final_time, split_250m) AS b, regr_intercept(final_time, split_250m) AS a FROM prepared),
e AS (SELECT (a + b * split_250m) - final_time AS e, final_time FROM prepared, fit)
SELECT 'split_250m' AS feature, round((SELECT b FROM fit), 4) AS slope, round((SELECT a FROM fit), 4) AS intercept,
       round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
       round(1 - sum(e * e) / (var_pop(final_time) * count(*)), 4) AS r2 FROM e""",
})


# --------------------------------------------------------------------------- ingest
_LISTS = """,
lists AS (SELECT 'M' AS sex, mens_400_free_pdf AS Link FROM linktab WHERE mens_400_free_pdf IS NOT NULL
          UNION ALL
          SELECT 'F' AS sex, womens_400_free_pdf AS Link FROM linktab WHERE womens_400_free_pdf IS NOT NULL)"""

QUERY_SQL.update({
    "link_lists": "WITH " + _EVENTS + _LISTS + "\nSELECT sex, Link FROM lists",
    "ingest_resumed": "WITH " + RAW + "," + _EVENTS + _LISTS + "\nSELECT " + ", ".join(_RAW_COLS)
                      + " FROM raw WHERE final_time IS NOT NULL AND Link IN (SELECT Link FROM lists)",
    "ingest_report": "WITH " + RAW + "," + _EVENTS + _LISTS + """
SELECT l.Link, CAST(coalesce(c.n, 0) AS BIGINT) AS rows FROM (SELECT DISTINCT Link FROM lists) l
LEFT JOIN (SELECT Link, count(*) AS n FROM raw WHERE final_time IS NOT NULL GROUP BY Link) c ON l.Link = c.Link""",
})


QUERY_SQL.update({
    "ingest_second_run_rows": "WITH " + RAW + "," + _EVENTS + _LISTS + """
SELECT Link, count(*) AS count FROM raw
WHERE final_time IS NOT NULL AND substring(md5(Link), 1, 1) >= '8' AND Link IN (SELECT Link FROM lists)
GROUP BY Link""",
    "parse_sheet_pages": QUERY_SQL["parse_sheets"],
    "seed_list": "WITH " + _EVENTS + _LISTS + "\nSELECT Link AS url, string_split(Link, '/')[-1] AS file_name FROM lists",
    "formatted_final_times": with_typed(
        "SELECT Link, \"rank\", lane, printf('%.2fs (%d:%05.2f)', final_time, CAST(floor(final_time / 60) AS BIGINT), "
        "final_time - 60 * floor(final_time / 60)) AS formatted FROM typed WHERE final_time IS NOT NULL"),
})

QUERY_SQL["slowest_women_text"] = with_raw(
    "SELECT first_name, last_name, final_time, Link FROM raw WHERE sex = 'F' "
    "ORDER BY final_time DESC NULLS LAST, first_name, last_name, Link LIMIT 10")

# two-feature least squares from covariances (a 2x2 solve)
QUERY_SQL["ols_split250_reaction"] = "WITH " + _PREPARED + """,
m AS (SELECT var_pop(split_250m) AS s11, var_pop(reaction_time) AS s22,
             covar_pop(split_250m, reaction_time) AS s12,
             covar_pop(split_250m, final_time) AS c1, covar_pop(reaction_time, final_time) AS c2,
             avg(split_250m) AS m1, avg(reaction_time) AS m2, avg(final_time) AS my FROM prepared),
fit AS (SELECT (s22 * c1 - s12 * c2) / (s11 * s22 - s12 * s12) AS b1,
               (s11 * c2 - s12 * c1) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM m),
coef AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS a FROM fit),
e AS (SELECT (a + b1 * split_250m + b2 * reaction_time) - final_time AS e, final_time FROM prepared, coef)
SELECT round((SELECT b1 FROM coef), 4) AS b_split_250m, round((SELECT b2 FROM coef), 4) AS b_reaction_time,
       round((SELECT a FROM coef), 4) AS intercept, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
       round(1 - sum(e * e) / (var_pop(final_time) * count(*)), 4) AS r2 FROM e"""

# hold-out and folds: md5 of the seed and the row's identifying columns (see operators.model)
_ROW_TEXT = ('concat_ws(chr(31), \'{seed}\', Link, heat, CAST("rank" AS VARCHAR), CAST(lane AS VARCHAR), '
             'last_name, first_name)')


def _row_hash_sql(seed: int) -> str:
    return f"CAST(('0x' || substr(md5({_ROW_TEXT.format(seed=seed)}), 1, 15)) AS BIGINT)"


QUERY_SQL["holdout_sizes"] = "WITH " + _PREPARED + f"""
SELECT ({_row_hash_sql(42)} % 10000) < 2000 AS is_test, count(*) AS count FROM prepared GROUP BY 1"""
QUERY_SQL["fold_sizes"] = "WITH " + _PREPARED + f"""
SELECT CAST({_row_hash_sql(43)} % 5 AS INTEGER) AS fold, count(*) AS count FROM prepared GROUP BY 1"""


# --------------------------------------------------------------------------- mixed sheets: known by construction
# The layouts of ``render_mixed_sheets``.  A swimmer without a splits line (3) that is followed, in its heat, by one
# whose own line holds a split (4) takes that line as its splits, and the other is no swimmer.
_MIXED = RAW + """,
mx0 AS (SELECT rc.*, (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 12 AS k FROM rc WHERE final_time_cs IS NOT NULL),
mx AS (SELECT *, lag(k) OVER w AS before, lead(k) OVER w AS after FROM mx0
       WINDOW w AS (PARTITION BY Link, session, heat ORDER BY l_linenumber, l_partkey, l_suppkey))"""


def _mixed_split(c: str) -> str:
    taken = "'11.11'" if c == "split_50m" else "NULL"
    return f"CASE WHEN k = 3 AND after = 4 THEN {taken} WHEN k = 3 THEN NULL ELSE {time_text(c + '_cs')} END AS {c}"


QUERY_SQL["parse_sheets_mixed"] = "WITH " + _MIXED + """
SELECT Link, CASE WHEN l_orderkey % 4 = 1 THEN lower(heat) ELSE heat END AS heat, "rank", lane,
       CASE k WHEN 6 THEN 'O-' || last_name WHEN 7 THEN 'VAN DE ' || last_name ELSE last_name END AS last_name,
       CASE k WHEN 7 THEN first_name || ' Lea' ELSE first_name END AS first_name, """ + secs("reaction_cs") + """ AS reaction_time,
       """ + ",\n".join(_mixed_split(c) for c in _SPLITS) + ", " + time_text("final_time_cs") + """ AS final_time
FROM mx WHERE NOT (k = 4 AND before IS NOT DISTINCT FROM 3)"""

# --------------------------------------------------------------------------- models checked by their normal equations
_TEST = f"({_row_hash_sql(42)} % 10000) < 2000"
_FOLD = f"CAST({_row_hash_sql(43)} % 5 AS INTEGER)"
_LINEAR = ("split_50m", "split_150m", "split_250m", "reaction_time")


def _holdout_sql(feature: str) -> str:
    return f"""
SELECT 'Linear {feature}' AS model_name, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse,
       round(1 - sum(e * e) / (var_pop(final_time) * count(*)), 4) AS r2
FROM (SELECT final_time, (SELECT regr_intercept(final_time, {feature}) FROM tagged WHERE NOT is_test)
        + (SELECT regr_slope(final_time, {feature}) FROM tagged WHERE NOT is_test) * {feature} - final_time AS e
      FROM tagged WHERE is_test)"""


_TAGGED = _PREPARED + f""",
tagged AS (SELECT *, {_TEST} AS is_test, {_FOLD} AS fold FROM prepared)"""

_SCORED = _TAGGED + """,
lin AS (SELECT regr_slope(final_time, split_250m) AS b, regr_intercept(final_time, split_250m) AS a FROM tagged WHERE NOT is_test),
scored AS (SELECT prepared.*, a + b * split_250m AS predicted_time, a + b * split_250m - final_time AS residual FROM prepared, lin)"""

_PAIR_FIT = """,
pm AS (SELECT var_pop(split_250m) AS s11, var_pop(reaction_time) AS s22, covar_pop(split_250m, reaction_time) AS s12,
       covar_pop(split_250m, final_time) AS c1, covar_pop(reaction_time, final_time) AS c2,
       avg(split_250m) AS m1, avg(reaction_time) AS m2, avg(final_time) AS my FROM prepared),
pb AS (SELECT (s22 * c1 - s12 * c2) / (s11 * s22 - s12 * s12) AS b1, (s11 * c2 - s12 * c1) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM pm),
pair AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS a FROM pb)"""
_FORMAT = ("printf('%.2fs (%d:%05.2f)', p, CAST(floor(p / 60) AS BIGINT), p - 60 * floor(p / 60))")

QUERY_SQL.update({
    "linear_holdout": "WITH " + _TAGGED + "\nSELECT *, printf('%.3fs', mae) AS label FROM (" + "\nUNION ALL".join(_holdout_sql(c) for c in _LINEAR) + ")",
    "polynomial_holdout": "WITH " + _TAGGED + """,
z AS (SELECT final_time, is_test, split_250m - (SELECT avg(split_250m) FROM tagged WHERE NOT is_test) AS x FROM tagged),
m AS (SELECT var_pop(x) AS s11, var_pop(x * x) AS s22, covar_pop(x, x * x) AS s12, covar_pop(x, final_time) AS c1,
      covar_pop(x * x, final_time) AS c2, avg(x) AS m1, avg(x * x) AS m2, avg(final_time) AS my FROM z WHERE NOT is_test),
b AS (SELECT (s22 * c1 - s12 * c2) / (s11 * s22 - s12 * s12) AS b1, (s11 * c2 - s12 * c1) / (s11 * s22 - s12 * s12) AS b2, m1, m2, my FROM m),
e AS (SELECT final_time, my + b1 * (x - m1) + b2 * (x * x - m2) - final_time AS e FROM z, b WHERE is_test)
SELECT 'Polynomial split_250m' AS model_name, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse,
       round(1 - sum(e * e) / (var_pop(final_time) * count(*)), 4) AS r2 FROM e""",
    "linear_cv": "WITH " + _TAGGED + "\n" + "\nUNION ALL\n".join(f"""
SELECT 'Linear {c}' AS model_name, round(avg(mae), 3) AS mae FROM (
  SELECT t.fold, avg(abs(a + b * {c} - final_time)) AS mae FROM tagged t JOIN (
    SELECT f.fold, regr_slope(final_time, {c}) AS b, regr_intercept(final_time, {c}) AS a
    FROM tagged t JOIN (SELECT DISTINCT fold FROM tagged) f ON t.fold <> f.fold GROUP BY f.fold) m ON t.fold = m.fold
  GROUP BY t.fold)""" for c in _LINEAR),
    "linear_by_distance": "WITH " + _TAGGED + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS splits_used, CAST({2 * i + 2} AS INTEGER) AS n_features, mae, CAST({50 * i + 50} AS INTEGER) AS distance_m FROM ({_holdout_sql(c)})"
        for i, c in enumerate(_SPLITS[:5])),
    "linear_scored": "WITH " + _SCORED + """
SELECT Link, heat, "rank", lane, last_name, first_name, round(predicted_time, 6) AS predicted_time, round(residual, 6) AS residual FROM scored""",
    "linear_surprises": "WITH " + _SCORED + """
SELECT last_name, first_name, final_time, round(predicted_time, 4) AS predicted_time, round(residual, 4) AS residual FROM scored
ORDER BY residual DESC NULLS LAST, last_name NULLS FIRST, first_name NULLS FIRST, final_time NULLS FIRST, predicted_time NULLS FIRST LIMIT 5""",
    "linear_residual_histogram": "WITH " + _SCORED + """,
v AS (SELECT round(residual, 4) AS v FROM scored),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
c AS (SELECT CAST(least(floor((v - lo) * (CAST(40 AS DOUBLE) / (hi - lo))), 39) + 1 AS INTEGER) AS bin, count(*) AS n FROM v, r GROUP BY 1)
SELECT CAST(b.range AS INTEGER) AS bin, round(lo + (b.range - 1) * ((hi - lo) / 40), 6) AS lo_edge, round(lo + b.range * ((hi - lo) / 40), 6) AS hi_edge,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n FROM range(1, 41) b CROSS JOIN r LEFT JOIN c ON c.bin = b.range""",
    "predict_from_text": "WITH " + _PREPARED + _PAIR_FIT + """
SELECT Link, heat, "rank", lane, """ + ", ".join(f"{secs(c + '_cs')} AS {c}" for c in _SPLITS[:5]) + """,
       coalesce(""" + secs("reaction_cs") + """, 0.72) AS reaction_time,
       round(a + b1 * """ + secs("split_250m_cs") + " + b2 * coalesce(" + secs("reaction_cs") + """, 0.72), 2) AS predicted_time FROM rc, pair""",
    "prediction_example": "WITH " + _PREPARED + _PAIR_FIT + f"""
SELECT p AS predicted_time, {_FORMAT} AS formatted FROM (SELECT round(a + b1 * 140.97 + b2 * 0.73, 2) AS p FROM pair)""",
    "strict_times": "WITH " + RESULTS_CS + """
SELECT Link, "rank", lane, last_name, first_name, """ + ", ".join(f"{secs_table(c + '_cs')} AS {c}" for c in _TIME_COLS) + " FROM rc",
    "labelled_results": with_raw("SELECT " + ", ".join(_RAW_COLS) + ", CASE sex WHEN 'M' THEN 'Men' ELSE 'Women' END AS sex FROM raw"),
    "portal_links_with_25": "WITH " + _EVENTS.replace("AND listed)", "AND listed_with_25)") + "\nSELECT * FROM portal",
    "ingest_in_batches": QUERY_SQL["parse_sheets"],
})


def _named_sql(title: str, name: str, columns: list[str]) -> str:
    shown = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    body = QUERY_SQL[name]
    return f"SELECT '{title.replace(chr(39), chr(39) * 2)}' AS title, concat_ws('|', {shown}) AS row FROM ({body})"


QUERY_SQL["named_queries"] = "\nUNION ALL\n".join(_named_sql(*x) for x in (
    ("Top 10 fastest men's swims", "fastest_men", ["first_name", "last_name", "final_time"]),
    ("Top 10 fastest women's swims", "fastest_women", ["first_name", "last_name", "final_time"]),
    ("Average final time by sex", "avg_final_by_sex", ["sex", "avg_final_time"]),
    ("Average reaction time by sex", "avg_reaction_by_sex", ["sex", "avg_reaction_time"]),
    ("Rows missing late splits", "missing_late_splits", ["missing_late_splits"]),
    ("Swimmers parsed per race", "swimmers_per_race_top10", ["Link", "swimmer_count"]),
    ("Fastest swim per race", "fastest_per_race_top10", ["Link", "fastest_time"])))


# --------------------------------------------------------------------------- every year, medians, six features, stumps

for _name in ("link_lists", "ingest_resumed", "ingest_second_run_rows", "ingest_report", "short_course_filtered", "dropped_competitions", "seed_list"):
    QUERY_SQL[_name] = QUERY_SQL[_name].replace("y BETWEEN 1996 AND 2000", "y IS NOT NULL")

_SIX = _SPLITS[:5] + ["reaction_time"]


def _terms(degree: int) -> list[str]:
    """Products of the six features, centred and scaled as ``c0`` ... ``c5``."""
    one = [f"c{i}" for i in range(6)]
    return ["CAST(1 AS DOUBLE)", *one, *([f"c{i} * c{j}" for i in range(6) for j in range(i, 6)] if degree == 2 else [])]


def _solved_sql(degree: int, groups: str, own: str, left_out: str) -> str:
    """Normal equations of the rows outside each group, by Gauss-Jordan with the largest pivot left; a column whose pivot is
    next to nothing is left out (weight 0).  Gives ``e_<degree>``: group, label, error of the group's rows."""
    n = len(_terms(degree))
    z = f"z_{degree}"
    return f"""
{z} AS MATERIALIZED (SELECT {own} AS g, final_time AS y, [{', '.join(_terms(degree))}] AS t FROM scaled),
m_{degree} AS MATERIALIZED (SELECT g, i, j, sum(t[i] * CASE WHEN j = {n + 1} THEN y ELSE t[j] END) AS x FROM (SELECT g, y, t, i, unnest(range(1, {n + 2})) AS j
  FROM (SELECT g, y, t, unnest(range(1, {n + 1})) AS i FROM {z})) GROUP BY ALL),
a_{degree} AS MATERIALIZED (SELECT g, i, list(x ORDER BY j) AS r FROM (SELECT h.g, m.i, m.j, sum(m.x) AS x FROM m_{degree} m JOIN ({groups}) h ON {left_out} GROUP BY ALL) GROUP BY g, i),
s_{degree}(g, k, m, used) AS (
  SELECT g, 0, list(r ORDER BY i), CAST([] AS BIGINT[]) FROM a_{degree} GROUP BY g
  UNION ALL
  SELECT g, k + 1, CASE WHEN abs(m[p][p]) < 1e-7 THEN m ELSE [CASE WHEN i = p THEN [x / m[p][p] FOR x IN m[p]]
      ELSE [m[i][j] - m[i][p] * m[p][j] / m[p][p] FOR j IN range(1, {n + 2})] END FOR i IN range(1, {n + 1})] END,
    CASE WHEN abs(m[p][p]) < 1e-7 THEN used ELSE list_append(used, p) END
  FROM (SELECT *, list_sort([struct_pack(x := -abs(m[i][i]), i := i) FOR i IN range(1, {n + 1}) IF NOT list_contains(used, i)])[1].i AS p FROM s_{degree} WHERE k < {n} AND len(used) = k)),
w_{degree} AS (SELECT g, [CASE WHEN list_contains(used, i) THEN m[i][{n + 1}] ELSE 0 END FOR i IN range(1, {n + 1})] AS w
  FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY k DESC) AS last FROM s_{degree}) WHERE last = 1),
e_{degree} AS (SELECT g, y, list_sum([t[i] * w[i] FOR i IN range(1, {n + 1})]) - y AS e FROM {z} JOIN w_{degree} USING (g))"""


# the later splits less their trend on the first, so that the equations are well posed
_SCALED = _TAGGED + """,
trend AS (SELECT """ + ", ".join(f"regr_slope({c}, split_50m) AS b{i}" for i, c in enumerate(_SIX)) + """ FROM tagged),
bent AS (SELECT is_test, fold, final_time, """ + ", ".join(
    f"{c} - {'b%d * split_50m' % i if i else '0'} AS v{i}" for i, c in enumerate(_SIX)) + """ FROM tagged, trend),
scaled AS (SELECT is_test, fold, final_time, """ + ", ".join(
    f"(v{i} - avg(v{i}) OVER ()) / stddev_pop(v{i}) OVER () AS c{i}" for i in range(6)) + """ FROM bent)"""
_MODELS = {1: "Linear Regression", 2: "Polynomial Regression"}

QUERY_SQL.update({
    "imputed_prices": """
WITH p AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 <> 0 THEN l_extendedprice END AS price FROM lineitem)
SELECT l_orderkey, l_linenumber, round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM p)), 6) AS price FROM p""",
    "six_feature_cv": "WITH RECURSIVE " + _SCALED + ","
    + ",".join(_solved_sql(d, "SELECT DISTINCT fold AS g FROM scaled", "fold", "m.g <> h.g") for d in (1, 2)) + "\n"
    + "\nUNION ALL\n".join(f"SELECT '{_MODELS[d]}' AS model_name, round(avg(mae), 3) AS mae FROM (SELECT g, avg(abs(e)) AS mae FROM e_{d} GROUP BY g)" for d in (1, 2)),
    "six_feature_holdout": "WITH RECURSIVE " + _SCALED + ","
    + ",".join(_solved_sql(d, "SELECT true AS g", "is_test", "NOT m.g") for d in (1, 2)) + "\n"
    + "\nUNION ALL\n".join(f"SELECT '{_MODELS[d]}' AS model_name, round(avg(abs(e)), 3) AS mae, round(sqrt(avg(e * e)), 3) AS rmse, "
                            f"round(1 - sum(e * e) / (var_pop(y) * count(*)), 4) AS r2 FROM e_{d}" for d in (1, 2)),
})

_FEATURES = _SPLITS[:5] + [f"interval_{c}" for c in _SPLITS[1:5]] + ["reaction_time"]
_STUMP = _TAGGED + """,
f AS (SELECT unnest([""" + ", ".join(f"struct_pack(f := {i}, x := {c})" for i, c in enumerate(_FEATURES)) + """], recursive := true), final_time - (SELECT avg(final_time) FROM tagged WHERE NOT is_test) AS y
  FROM tagged WHERE NOT is_test),
v AS (SELECT f, x, count(*) AS n, sum(y) AS s FROM f GROUP BY f, x),
c AS (SELECT f, x, lead(x) OVER w AS higher, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS n, sum(s) OVER (w ROWS UNBOUNDED PRECEDING) AS s,
      sum(n) OVER (PARTITION BY f) AS every, sum(s) OVER (PARTITION BY f) AS whole FROM v WINDOW w AS (PARTITION BY f ORDER BY x)),
best AS MATERIALIZED (SELECT f, x + (higher - x) / 2 AS cut FROM c WHERE higher IS NOT NULL
      ORDER BY round(s * s / n + (whole - s) * (whole - s) / (every - n), 4) DESC, f, x LIMIT 1),
named AS (SELECT *, CASE (SELECT f FROM best) """ + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_FEATURES)) + """ END <= (SELECT cut FROM best) AS low FROM tagged),
leaf AS (SELECT low, avg(final_time) AS p FROM named WHERE NOT is_test GROUP BY low),
scored AS (SELECT named.*, p FROM named JOIN leaf USING (low))"""

QUERY_SQL.update({
    "stump_holdout": "WITH " + _STUMP + """
SELECT 'Stump' AS model_name, round(avg(abs(p - final_time)), 3) AS mae, round(sqrt(avg((p - final_time) * (p - final_time))), 3) AS rmse,
       round(1 - sum((p - final_time) * (p - final_time)) / (var_pop(final_time) * count(*)), 4) AS r2 FROM scored WHERE is_test""",
    "stump_importances": "WITH " + _STUMP + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST((SELECT count(*) FROM best WHERE f = {i}) AS DOUBLE) AS importance" for i, c in enumerate(_FEATURES)),
    "stump_scored": "WITH " + _STUMP + """
SELECT Link, heat, "rank", lane, last_name, first_name, round(p, 6) AS predicted_time, round(p - final_time, 6) AS residual FROM scored""",
})

QUERY_SQL["portal_links_nested"] = QUERY_SQL["portal_links"]  # nesting changes no link


# --------------------------------------------------------------------------- sinks read back, races by batch, buckets

QUERY_SQL["races_by_batch"] = "WITH " + RESULTS_CS + "\n" + """
SELECT Link, swimmer_count, fastest_time, """ + half_up("s", "n", 2) + """ AS avg_final_time FROM (
  SELECT Link, count(*) AS swimmer_count, min(CAST(final_time_cs AS DOUBLE) / 100) AS fastest_time,
         sum(final_time_cs) AS s, count(final_time_cs) AS n FROM rc GROUP BY Link)"""
QUERY_SQL["ingest_bucketed"] = QUERY_SQL["ingest_resumed"]
QUERY_SQL["links_file"] = QUERY_SQL["link_table"].replace("y BETWEEN 1996 AND 2000", "y IS NOT NULL")
QUERY_SQL["results_file"] = "WITH " + RAW + "\nSELECT " + ", ".join(_RAW_COLS) + " FROM raw"
QUERY_SQL["typed_file"] = QUERY_SQL["canonical_results"]
QUERY_SQL["stored_table"] = with_typed(
    "SELECT sex, count(*) AS swims, count(DISTINCT Link) AS races, min(final_time) AS fastest, max(final_time) AS slowest "
    "FROM typed GROUP BY sex")
QUERY_SQL["ingest_nothing_left"] = QUERY_SQL["ingest_in_batches"]
