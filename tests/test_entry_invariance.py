import __spark_entry__ as E
from lapline.operators.parse import parse_sheets
from lapline.plans import queries as Q
from lapline.sources import fixtures as FX
from tests.conftest import SF_SMALL


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["Link", "fastest_time"] and df.count() > 0
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs) and len(qs) >= 50


def test_same_result_for_one_and_many_partitions(spark):
    sheets = FX.render_sheets(spark, SF_SMALL).select("Link", "text")
    one, many = parse_sheets(sheets.coalesce(1)), parse_sheets(sheets.repartition(13))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    typed = FX.canonical_results(spark, SF_SMALL)
    a = Q.avg_final_per_race(typed.coalesce(1)).collect()
    b = Q.avg_final_per_race(typed.repartition(11)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_named_queries_are_the_same_queries(spark):
    typed = FX.canonical_results(spark, SF_SMALL)
    res, forms = Q.run_named_queries(typed), Q.all_queries(typed)
    assert len(res) == 7
    for title, name in Q.NAMED.items():
        assert res[title].collect() == forms[name].collect()


def test_sql_over_a_stored_table(spark):
    from lapline.sources import tables as T

    FX.canonical_results(spark, SF_SMALL).createOrReplaceTempView("swims")
    best = T.sql(spark, "SELECT Link, MIN(final_time) AS t FROM swims WHERE final_time IS NOT NULL GROUP BY Link")
    want = {r.Link: r.fastest_time for r in Q.fastest_per_race(FX.canonical_results(spark, SF_SMALL)).collect()}
    assert {r.Link: r.t for r in best.collect()} == want


def test_all_queries_dict(spark):
    typed = FX.canonical_results(spark, SF_SMALL)
    qs = Q.all_queries(typed)
    assert len(qs) == 10 and qs["missing_late_splits"].count() == 1


def test_cluster_conf_sizes_partitions():
    from lapline.session import cluster_conf
    big = cluster_conf(1000, 8, input_tb=100)
    small = cluster_conf(4, 4, input_tb=0.001)
    assert big["spark.sql.adaptive.enabled"] == "true" and int(big["spark.sql.shuffle.partitions"]) >= 24_000
    assert int(small["spark.sql.shuffle.partitions"]) == 48
