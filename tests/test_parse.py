from pyspark.sql import functions as F

from lapline.functions.text import splitlines
from lapline.operators import parse as P
from lapline.sources import fixtures as FX

GOLDEN = (
    "SWIMMING RESULTS\n"
    "1 1 BEFORE Header USA 0.70 3:50.00\n"
    "FINAL A Event 105\n"
    "Rank Lane Name NOC R.T. Time\n"
    "1 4 SUN Yang CHN 0.73 3:40.29 WR\n"
    "50m (1) 26.22 100m 54.52 150m 1:22.60\n"
    "\n"
    "  200m 1:50.70 250m 2:18.00\n"
    "=2 3 McKEON Emma AUS 3:59.10\n"
    "T3 5 DE LA CRUZ Maria-Jose ESP 1.02 4:01.00\n"
    "4 6 SUN YANG 0.71 4:02.00 50m 27.00\n"
    "5 7 DOE Jane SYS­FL 0.66 4:03.10\n"
    "50m 27.10 50m 27.20 400m 4:03.10\n"
    "DSQ 8 LEE Kim KOR\n"
    "6 8 GÖBEL Jan GER 0.70 4:05.00Q\n"
    "Final\n"
    "Event 105\n"
    "1 2 ROE Ann USA 59.99 1.20\n"
    "final b\n"
    "2T 1 O'NEIL Sam IRL 0.69 4:10.00\n"
)

EXPECTED = [
    ("FINAL A", 1, 4, "SUN", "Yang", 0.73, "3:40.29", "26.22", "54.52", "1:22.60"),
    ("FINAL A", 2, 3, "McKEON Emma", "McKEON Emma", None, "3:59.10", None, None, None),
    ("FINAL A", 3, 5, "DE LA CRUZ", "Maria-Jose ESP 1.02", None, "4:01.00", "27.00", None, None),
    ("FINAL A", 5, 7, "DOE", "Jane", 0.66, "4:03.10", "27.20", None, None),
    ("Final", 1, 2, "ROE", "Ann", None, "59.99", None, None, None),
    ("final b", 2, 1, "O'NEIL", "Sam", 0.69, "4:10.00", None, None, None),
]


def test_golden_sheet(spark):
    docs = spark.createDataFrame([("g", GOLDEN)], "Link string, text string")
    out = P.parse_sheets(docs).orderBy("heat", "rank").collect()
    got = sorted((r.heat, r.rank, r.lane, r.last_name, r.first_name, r.reaction_time, r.final_time,
                  r.split_50m, r.split_100m, r.split_150m) for r in out)
    assert got == sorted(EXPECTED)
    assert all(r.split_200m is None and r.split_350m is None for r in out)


def test_no_header_and_empty(spark):
    docs = spark.createDataFrame(
        [("a", "1 4 SUN Yang CHN 0.73 3:40.29\n"), ("b", ""), ("c", None)], "Link string, text string")
    out = P.parse_sheets(docs).collect()
    assert [(r.Link, r.heat, r.rank) for r in out] == [("a", "Final", 1)]
    empty = P.parse_sheets(docs.filter("false"))
    assert empty.columns == ["Link"] + [
        "heat", "rank", "lane", "last_name", "first_name", "reaction_time", "split_50m", "split_100m",
        "split_150m", "split_200m", "split_250m", "split_300m", "split_350m", "final_time"]


def test_header_across_line_end(spark):
    docs = spark.createDataFrame([("x", "Final\nEvent 7\n1 1 A B 25.00\nFinal A notes\n2 2 C D 26.00\n")],
                                 "Link string, text string")
    out = P.parse_sheets(docs).collect()
    # "Final A notes" is not a header: both rows are in the one "Final" section
    assert sorted((r.heat, r.rank) for r in out) == [("Final", 1), ("Final", 2)]


def test_round_trip_rendered_sheets(spark):
    from tests.conftest import SF_SMALL
    sheets = FX.render_sheets(spark, SF_SMALL)
    parsed = P.parse_sheets(sheets.select("Link", "text"))
    expected = FX.raw_results(spark, SF_SMALL, with_sex=False).filter(F.col("final_time").isNotNull())
    assert parsed.exceptAll(expected).count() == 0
    assert expected.exceptAll(parsed).count() == 0


def test_parse_plan_has_no_shuffle(spark):
    from tests.conftest import SF_SMALL
    sheets = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").cast("string").alias("Link"), "text")
    plan = P.parse_sheets(sheets)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_marker_characters_in_text(spark):
    docs = spark.createDataFrame([("m", "1 4 SU\u0001N Ya\u0002ng CHN 0.73 3:40.29\n")], "Link string, text string")
    r = P.parse_sheets(docs).first()
    assert (r.last_name, r.first_name, r.final_time) == ("SUN", "Yang", "3:40.29")


def test_inspection_helpers(spark):
    docs = spark.createDataFrame([("d", "Alpha SYS­FL\n\n  beta 12\r\ngamma")], "Link string, text string")
    assert P.peek(docs, 9).first().head == "Alpha SYS"
    lines = [(r.line_no, r.line) for r in P.inspect_lines(docs, 3).orderBy("line_no").collect()]
    assert lines == [(0, "Alpha SYS­FL"), (1, ""), (2, "  beta 12\r")]      # cut on \\n only, kept as is
    hits = [r.line_no for r in P.regex_line_search(docs, r"\s*beta \d+").collect()]
    assert hits == [2] and P.regex_line_search(docs, "beta").count() == 0     # anchored at the line start
    stripped = [r.line for r in P.lines_of(docs).orderBy("line_no").collect()]
    assert stripped == ["Alpha SYS­FL", "", "beta 12", "gamma"]            # splitlines + strip


def test_head_breaks_ties_by_the_other_columns(spark):
    rows = [("L", "Final A", 1, 1, "A", "B", t) for t in ("23.00", "22.00", "24.00")]
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "Link string, heat string, rank int, lane int, last_name string, first_name string, final_time string")
        found = P.head_per_document(df.repartition(parts), 2).select("final_time").collect()
        assert sorted(r[0] for r in found) == ["22.00", "23.00"]


def test_plain_patterns_read_ascii_text_as_the_general_ones_do(spark):
    """The cheap path of plain text gives what the Unicode path gives: the same sheet with one foreign letter in its title."""
    body = ("Final A Event 105\nRank Lane Name\n1 4 VAN DE SWIM Anna  Lea GBR-ENG 0.71 3:44.10\n50m (1) 26.01 100m 54.20 50m (1) 27.00\n"
            "2 5 O'NEIL Bo USA 3:45.00\nfinal b event 105\n  =3 6 LEE\tAnn USA 0.80 3:46.10  \n\n50m(1)26.50\nFinal\nFINAL  C\n4 1 ROE Al FRA 59.90")
    rows = []
    for title in ("Results\n", "Résultats\n"):
        docs = spark.createDataFrame([("a", title + t) for t in (body, body + "\n", body.replace("\n", "\r\n"), body.replace("Lea", "\x1cLea"), "")], "Link string, text string")
        rows.append(sorted(map(repr, P.parse_sheets(docs).collect())))
    assert rows[0] == rows[1] and len(rows[0]) >= 12


def test_plain_lines_cut_as_python_does(spark):
    texts = ["", "\n", "a", "a\n", "a\n\n", "\na b\n c", "a\rb", "a\x1cb\n", "é\n\n", "a b"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", splitlines(F.col("t")).alias("l")).collect()
    assert {r.i: list(r.l) for r in got} == {i: t.splitlines() for i, t in enumerate(texts)}
