import os
import tempfile

from pyspark.sql import functions as F

from lapline import schema as S
from lapline.sources import tables as T


def _tmp(name):
    return os.path.join(tempfile.mkdtemp(prefix="lapline-src-"), name)


def test_link_csv_round_trip_with_crlf_and_blanks(spark):
    path = _tmp("links.csv")
    with open(path, "w", newline="") as fh:
        fh.write("year,competition,mens_400_free_pdf,womens_400_free_pdf\r\n")
        fh.write("2010,NATIONALS,https://h/File/A.pdf,https://h/File/B.pdf\r\n")
        fh.write("2011,CUP,,https://h/File/C.pdf\r\n")
    df = T.read_links_csv(spark, path)
    rows = {r.year: r for r in df.collect()}
    assert rows[2011].mens_400_free_pdf is None and rows[2010].womens_400_free_pdf.endswith("B.pdf")
    out = _tmp("links_out")
    T.write_links(df, out)
    again = T.read_links_csv(spark, out)
    assert again.exceptAll(df).count() == 0 and df.exceptAll(again).count() == 0


def test_earlier_output_absent_empty_and_present(spark):
    missing = _tmp("nothing")
    assert T.read_earlier_output(spark, missing).count() == 0
    assert T.read_earlier_output(spark, missing).columns == [f.name for f in S.RAW_RESULTS.fields]
    path = _tmp("results")
    rows = spark.createDataFrame([("l1", "Final", 1, 4, "SUN", "Yang", 0.73) + (None,) * 7 + ("3:40.29",)],
                                 S.RAW_RESULTS)
    T.write_results(rows, path)
    T.write_results(rows, path, mode="append")
    assert T.read_earlier_output(spark, path).count() == 2
    assert T.normalize_input(spark, path).count() == 2
    assert T.normalize_input(spark, rows) is rows


def test_documents_pages_and_seeds(spark):
    folder = _tmp("docs")
    os.makedirs(folder)
    for i in range(3):
        with open(os.path.join(folder, f"d{i}.txt"), "w") as fh:
            fh.write(f"line a{i}\nline b{i}\n")
    docs = T.read_documents(spark, folder)
    assert docs.count() == 3 and all(r.text.startswith("line a") for r in docs.collect())
    pages = spark.createDataFrame([("x", 2, "two"), ("x", 1, "one"), ("x", 3, None), ("y", 1, "")],
                                  "Link string, page int, text string")
    assert [tuple(r) for r in T.join_pages(pages).collect()] == [("x", "one\ntwo")]
    seeds = spark.createDataFrame([(" https://h/f/a.pdf ",), ("  ",), (None,)], "pdf_url string")
    assert [tuple(r) for r in T.read_seed_list(seeds).collect()] == [("https://h/f/a.pdf", "a.pdf")]


def test_table_sink_schema_and_count(spark):
    df = spark.createDataFrame([("M", 1.0), ("F", 2.0)], "sex string, final_time double")
    name = "lapline_test_results"
    T.save_table(df, name, partition_by=["sex"], sort_within=["final_time"])
    assert T.count_rows(spark.table(name)) == 2
    assert T.sql(spark, f"SELECT count(*) AS n FROM {name} WHERE sex = 'M'").first().n == 1
    sch = {r.name: r.type for r in T.table_schema(spark, df).collect()}
    assert sch == {"sex": "STRING", "final_time": "DOUBLE"}
    spark.sql(f"DROP TABLE {name}")


def test_results_csv_round_trip(spark):
    path = _tmp("results_csv")
    rows = spark.createDataFrame([("l1", "Final", 1, 4, "SUN", "", None) + (None,) * 7 + ("3:40.29",)],
                                 S.RAW_RESULTS)
    T.write_results(rows, path, fmt="csv")
    back = T.read_results_csv(spark, path)
    r = back.first()
    assert back.count() == 1 and r.rank == 1 and r.final_time == "3:40.29" and r.split_50m is None
