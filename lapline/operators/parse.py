"""Result-sheet text to swimmer rows.

Input: one row per document ``(Link, text)``.  The reference walks each
document's lines in a loop; here the same meaning is computed inside the row
with Spark's array functions, so parsing is one map-only stage: no shuffle,
no Python worker, every document handled by the task that read it.

Pairing rule (P13).  Within a section, a line is S (swimmer only), P (splits
only), B (both) or ignored.  The reference tests the line after a swimmer for
splits before testing it for a swimmer, and a splits line taken by a swimmer
is not itself tried as a swimmer.  Cut the S/P/B sequence into runs that
start at an S or a P (a leading run may start with B).  In a run ``S B…B``
the S and every second B (2nd, 4th, …) are swimmers; in ``P B…B`` or a
leading ``B…B`` the 1st, 3rd, … B are swimmers.  A swimmer's splits come from
the next S/P/B line when that line is P or B, else it has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline import schema as S
from lapline.functions.text import (
    CODE_SUFFIX, HEAT_HEADER, HEAT_HEADER_PLAIN, NAME_PARTS, NAME_PARTS_PLAIN, NOISE_LINE, SECTION_MARK, SOFT_HYPHEN, SPLIT_ENTRY, SPLIT_ENTRY_PLAIN,
    SWIMMER_LINE, SWIMMER_LINE_PLAIN, is_ascii, is_plain, java_regex, py_squash, py_strip, soft_hyphen_to_dash, splitlines,
)


FIELD_SEP = "\u0002"
MATCH_MARK = "\u0003"
MATCH_TEMPLATE = MATCH_MARK + FIELD_SEP.join(f"${i}" for i in range(1, 6))


def clean_text(c: Column) -> Column:
    """P01, and removal of the three control characters the parser uses as markers
    (U+0001 between sections, U+0002 between captured fields, U+0003 before a match)."""
    return F.translate(c, SOFT_HYPHEN + SECTION_MARK + FIELD_SEP + MATCH_MARK, "-")


def sections(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``(…keep, section, heat, section_text)``, one row per heat section.

    The header pattern runs over the whole text (``\\s`` may cross a line end),
    each section runs from one header to the next, text before the first
    header is dropped, and a document without a header is one section "Final".
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    text = F.col(text_col)
    marked = (F.when(is_plain(text), F.regexp_replace(text, HEAT_HEADER_PLAIN, SECTION_MARK + "$0"))
              .otherwise(F.regexp_replace(clean_text(text), HEAT_HEADER, SECTION_MARK + "$0")))
    pieces = F.split(marked, SECTION_MARK, -1)
    # the pieces pass through a generator of their own, so the text is searched once, not once for each use of them
    cut = docs.select(*keep, F.explode(F.array(pieces)).alias("_pieces"))
    secs = (F.when(F.size("_pieces") == 1, F.col("_pieces"))
            .otherwise(F.slice("_pieces", F.lit(2), F.size("_pieces") - 1)))
    exploded = cut.select(*keep, F.posexplode(secs).alias("section", "section_text"))
    label = F.coalesce(F.nullif(F.regexp_extract("section_text", HEAT_HEADER, 1), F.lit("")),
                       F.lit("Final"))
    return exploded.select(*keep, (F.col("section") + 1).alias("section"), label.alias("heat"),
                           "section_text")


def _run_flags(run: Column) -> Column:
    """Swimmer flags ('1'/'0') for one run of kinds (see the module doc)."""
    n = F.length(run)
    head = F.substr(run, F.lit(1), F.lit(1))
    after_s = F.concat(F.lit("1"), F.substr(F.repeat(F.lit("01"), n), F.lit(1), n - 1))
    after_p = F.concat(F.lit("0"), F.substr(F.repeat(F.lit("10"), n), F.lit(1), n - 1))
    leading_b = F.substr(F.repeat(F.lit("10"), n), F.lit(1), n)
    return F.when(head == "S", after_s).when(head == "P", after_p).otherwise(leading_b)


def swimmer_lines(secs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P04 + P13: ``(…keep, heat, line, splits_line)`` for every swimmer line."""
    keep = keep if keep is not None else [c for c in secs.columns if c not in ("section_text",)]
    plain = F.col("_plain")
    secs = secs.select(*keep, "section_text", is_plain(F.col("section_text")).alias("_plain"))
    stripped = F.transform(splitlines(F.col("section_text"), plain), lambda l: F.when(plain, F.trim(l)).otherwise(py_strip(l)))
    # one pass of the swimmer pattern both detects a swimmer line and captures its
    # groups: a match is rewritten to MATCH_MARK + the groups, anything else is unchanged
    classified = F.filter(
        F.transform(stripped, lambda l: F.struct(
            l.alias("line"),
            F.when(plain, F.regexp_replace(l, SWIMMER_LINE_PLAIN, MATCH_TEMPLATE))
             .otherwise(F.regexp_replace(l, SWIMMER_LINE, MATCH_TEMPLATE)).alias("g"),
            F.when(plain, l.rlike(SPLIT_ENTRY_PLAIN)).otherwise(l.rlike(SPLIT_ENTRY)).alias("sp"))),
        lambda x: x["g"].startswith(MATCH_MARK) | x["sp"])
    classified = F.transform(classified, lambda x: F.struct(
        x["line"].alias("line"), x["g"].startswith(MATCH_MARK).alias("sw"), x["sp"].alias("sp"),
        x["g"].alias("g")))
    step1 = secs.select(*keep, classified.alias("cls"))
    kinds = F.array_join(F.transform("cls", lambda x: F.when(x["sw"] & x["sp"], "B")
                                     .when(x["sw"], "S").otherwise("P")), "")
    runs = F.regexp_extract_all(kinds, F.lit("[SP]B*|B+"), 0)
    step2 = step1.select(*keep, "cls",
                         F.array_join(F.transform(runs, _run_flags), "").alias("flags"))
    paired = F.transform("cls", lambda x, i: F.struct(
        x["line"].alias("line"), x["g"].alias("g"),
        (F.substr(F.col("flags"), i + 1, F.lit(1)) == "1").alias("swimmer"),
        F.when(F.get(F.col("cls"), i + 1)["sp"], F.get(F.col("cls"), i + 1)["line"]).alias("splits_line")))
    chosen = F.filter(paired, lambda p: p["swimmer"])
    return (step2.select(*keep, F.explode(chosen).alias("p"))
            .select(*keep, F.col("p.line").alias("line"), F.col("p.splits_line").alias("splits_line"),
                    F.split(F.substr(F.col("p.g"), F.lit(2)), FIELD_SEP, -1).alias("groups")))


def split_entries(splits_line: Column) -> tuple[Column, Column]:
    """The distances and the times of a splits line, from the last to the first."""
    return tuple(F.reverse(F.when(is_ascii(splits_line), F.regexp_extract_all(splits_line, F.lit(SPLIT_ENTRY_PLAIN), i))
                           .otherwise(F.regexp_extract_all(splits_line, F.lit(SPLIT_ENTRY), i))) for i in (1, 2))


def split_time(distances: Column, times: Column, distance: str) -> Column:
    """The time given for one distance; the last entry of a repeated distance wins."""
    return F.get(times, (F.array_position(distances, distance) - 1).cast("int"))


def _groups(c: Column, pattern: str, n: int) -> Column:
    """All n groups of a pattern that matches the whole string, from one regex pass."""
    template = FIELD_SEP.join(f"${i}" for i in range(1, n + 1))
    return F.split(F.regexp_replace(c, pattern, template), FIELD_SEP, -1)


def split_name(name: Column) -> tuple[Column, Column]:
    """P10: leading all-capital tokens are the last name, the rest the first name.

    When no token leads, the last name is the whole raw string (and the first
    name is every token), as in the reference.
    """
    g = F.when(is_ascii(name), _groups(name, NAME_PARTS_PLAIN, 2)).otherwise(_groups(name, NAME_PARTS, 2))
    last = py_squash(F.get(g, 0))
    first = py_squash(F.get(g, 1))
    return F.when(last == "", name).otherwise(last), first


def swimmer_fields(lines: DataFrame, keep: list[str]) -> DataFrame:
    """Typed fields from a swimmer line and its splits line.

    The five groups were captured when the line was classified; the split
    entries are found once per row.
    """
    distances, times = split_entries(F.col("splits_line"))
    staged = lines.select(*keep, F.col("groups").alias("g"), distances.alias("distances"), times.alias("times"))
    g = lambda i: F.get(F.col("g"), i - 1)
    name_clean = py_strip(F.regexp_replace(py_strip(g(3)), CODE_SUFFIX, ""))
    named = staged.select(*keep, "g", "distances", "times", name_clean.alias("name_clean"))
    last, first = split_name(F.col("name_clean"))
    cols = [*[F.col(c) for c in keep],
            F.regexp_replace(g(1), "[^0-9]", "").try_cast("int").alias("rank"),
            g(2).try_cast("int").alias("lane"),
            last.alias("last_name"), first.alias("first_name"),
            F.nullif(g(4), F.lit("")).try_cast("double").alias("reaction_time")]
    cols += [split_time(F.col("distances"), F.col("times"), d).alias(c) for c, d in zip(S.TIME_SPLITS, S.SPLIT_DISTANCES)]
    cols.append(g(5).alias("final_time"))
    return named.select(*cols)


def parse_sheets(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Documents to swimmer rows ``(Link, heat, rank, lane, …, final_time)``.

    Extra columns named in ``keep`` (default: every column but the text) are
    carried to each row; ``Link`` comes first as in the reference.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    secs = sections(docs, text_col, keep)
    lines = swimmer_lines(secs, keep + ["heat"])
    out = swimmer_fields(lines, keep + ["heat"])
    order = [c for c in keep] + S.RAW_COLUMNS
    return out.select(*order)


# --------------------------------------------------------------------------- inspection helpers

def lines_of(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None,
             strip: bool = True, python_lines: bool = True) -> DataFrame:
    """One row per line ``(…keep, line_no, line)``, 0-based.

    ``python_lines`` cuts like ``str.splitlines()``; otherwise on ``\\n`` only
    (blank and trailing lines kept), as the inspection helpers do.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c != text_col]
    arr = splitlines(F.col(text_col)) if python_lines else F.split(F.col(text_col), "\n", -1)
    out = docs.select(*keep, F.posexplode(arr).alias("line_no", "line"))
    if strip:
        out = out.withColumn("line", py_strip(F.col("line")))
    return out


def is_noise(line: Column) -> Column:
    """A blank stripped line or one starting with a known header/footer prefix."""
    s = py_strip(line)
    return (s == "") | s.rlike(NOISE_LINE)


def noise_summary(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """P17 per document: line count and noise-line count, computed inside the row.

    A document without text has no lines and gives no row, as in ``lines_of``.
    """
    arr = splitlines(F.col(text_col))
    return docs.filter(F.col(text_col).isNotNull()).select(
        key, F.size(arr).cast("bigint").alias("lines"),
        F.size(F.filter(arr, lambda l: is_noise(l))).cast("bigint").alias("noise_lines"))


def peek(docs: DataFrame, n: int = 1200, text_col: str = "text") -> DataFrame:
    """The first n characters of each document (an inspection view)."""
    keep = [c for c in docs.columns if c != text_col]
    return docs.select(*keep, F.substring(soft_hyphen_to_dash(F.col(text_col)), 1, n).alias("head"))


def inspect_lines(docs: DataFrame, n: int = 80, text_col: str = "text") -> DataFrame:
    """Numbered lines, first n per document, cut on ``\\n`` and not stripped."""
    lines = lines_of(docs, text_col, strip=False, python_lines=False)
    return lines.filter(F.col("line_no") < n)


def regex_line_search(docs: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """P20: lines (cut on ``\\n``) that a user pattern matches at their start."""
    lines = lines_of(docs, text_col, strip=False, python_lines=False)
    return lines.filter(F.col("line").rlike(java_regex(f"^(?:{pattern})")))


def rows_per_document(parsed: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Parsed rows per Link; with ``links``, documents without rows show 0."""
    counts = parsed.groupBy("Link").agg(F.count(F.lit(1)).alias("rows"))
    if links is None:
        return counts
    listed = links.select("Link").distinct()
    return (listed.join(counts, "Link", "left")
            .select("Link", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")))


def head_per_document(parsed: DataFrame, n: int = 2) -> DataFrame:
    """The first n rows of each document by (heat, rank, lane, name); equal ones by their other columns."""
    from pyspark.sql import Window
    order = ["heat", "rank", "lane", "last_name", "first_name"]
    order += [c for c in parsed.columns if c not in (*order, "Link")]
    w = Window.partitionBy("Link").orderBy(*order)
    return parsed.withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= n).drop("_i")
