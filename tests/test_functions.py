import math

from pyspark.sql import functions as F

from lapline.functions.text import last_path_element, py_strip, regex_contains, splitlines
from lapline.functions.times import convert_time_columns, format_seconds, time_to_seconds, to_double


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_ingest_converter(spark):
    got = _one(spark, lambda c: time_to_seconds(c, "ingest"),
               ["3:46.88", "26.39", None, "", "abc", "1:02:03", "0.00", " 26.39 ", "1.5:30.00"])
    assert got == [226.88, 26.39, None, None, None, None, 0.0, 26.39, None]
    nums = _one(spark, lambda c: time_to_seconds(c, "ingest", numeric=True), [0.0, 26.391, float("nan")], "double")
    assert nums == [None, 26.39, None]


def test_table_converter(spark):
    got = _one(spark, lambda c: time_to_seconds(c, "table"), [" 26.39 ", "abc", "a:b", "3:46.88", None])
    assert got[0] == 26.39 and got[1] is None and got[2] is None and got[4] is None
    assert got[3] == 3 * 60 + 46.88
    nums = _one(spark, lambda c: time_to_seconds(c, "table", numeric=True), [0.0, 12.5], "double")
    assert nums == [0.0, 12.5]


def test_strict_converter_raises(spark):
    import pytest
    good = spark.createDataFrame([("1.5:30.00",)], "v string")
    assert good.select(time_to_seconds(F.col("v"), "strict")).first()[0] == 120.0
    bad = spark.createDataFrame([("oops",)], "v string")
    with pytest.raises(Exception):
        bad.select(time_to_seconds(F.col("v"), "strict")).collect()


def test_to_double_guards(spark):
    assert _one(spark, to_double, ["1d", "nan", "inf", "1e3", " 2.5 ", ".5"]) == [None, None, None, 1000.0, 2.5, 0.5]


def test_format_seconds(spark):
    assert _one(spark, format_seconds, [226.88, 59.999, 61.0], "double") == [
        "226.88s (3:46.88)", "60.00s (0:60.00)", "61.00s (1:01.00)"]


def test_text_helpers(spark):
    assert _one(spark, py_strip, ["　 x\t "]) == ["x"]
    assert _one(spark, splitlines, ["a\r\nb\x0bc\n", "", "x"]) == [["a", "b", "c"], [], ["x"]]
    assert _one(spark, lambda c: regex_contains(c, r"S\d|SB|SM"), ["Ann S9", "SMith", "smith", None]) == [
        True, True, False, False]
    assert _one(spark, last_path_element, ["https://h/File/R1.pdf", "plain"]) == ["R1.pdf", "plain"]


def test_half_up_mean(spark):
    from lapline.functions.times import half_up_mean
    df = spark.createDataFrame([(22689, 2), (5, 2), (1, 3)], "s long, n long")
    got = [r[0] for r in df.select(half_up_mean(F.col("s"), F.col("n"), 2)).collect()]
    assert got == [113.45, 0.03, 0.0]
    assert not any(math.isnan(x) for x in got)


def test_bad_time_counts(spark):
    from lapline.functions.times import bad_time_counts
    df = spark.createDataFrame([("3:46.88", "a:b"), ("abc", None), ("", "26.00")], "x string, y string")
    r = bad_time_counts(df, ["x", "y"]).first()
    assert (r.x, r.y) == (1, 1)


def test_simple_times_read_as_by_the_general_patterns(spark):
    """The cheap path of ``12.34`` and ``1:23.45`` gives what the general patterns give (text with a blank takes those)."""
    texts = ["27.05", "3:46.88", "0:00.00", "5.", "5", "1:5", "007:08.", "99999999999999999999:1", "1:2:3", ".5", "1e3", "nan", "12d", ":3", "3:", "27.05\n", "", None]
    rows = spark.createDataFrame([(i, t, None if t is None else t + " ") for i, t in enumerate(texts)], "i int, t string, spaced string")
    for mode in ("ingest", "table"):
        got = rows.filter("t <> ''").select("t", time_to_seconds(F.col("t"), mode).alias("a"), time_to_seconds(F.col("spaced"), mode).alias("b")).collect()
        assert all(r.a == r.b for r in got), mode
        known = {r.t: r.a for r in got}
        assert known["27.05"] == 27.05 and known["3:46.88"] == 226.88 and known["1:2:3"] is None and known["12d"] is None


def test_converting_columns_is_one_expression(spark):
    """Conversion must not write one block of generated code a column: the JVM does not compile methods over 8,000 bytes."""
    df = spark.createDataFrame([("1:00.50", "59.10", 3.0)], "a string, b string, c double")
    out = convert_time_columns(df, ["a", "b", "c"], "ingest")
    assert out.columns == ["a", "b", "c"] and tuple(out.first()) == (60.5, 59.1, 3.0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "transform(" in plan and plan.count("RLIKE") <= 1


def test_generated_code_of_rendered_rows_is_compiled(spark, capsys):
    """No generated method of the rows' texts is over the 8,000 bytes up to which the JVM compiles."""
    import re
    from lapline.plans.registry import REGISTRY
    from tests.conftest import SF_SMALL
    REGISTRY["labelled_results"](spark, SF_SMALL).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8_000
