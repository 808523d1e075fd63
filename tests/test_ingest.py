import os
import tempfile

from pyspark.sql import functions as F

from lapline.operators import ingest as K
from lapline.operators.parse import parse_sheets
from lapline.streaming.sheets import start_ingest
from lapline.sources import fixtures as FX
from tests.conftest import SF_SMALL


def _docs(spark):
    return FX.render_sheets(spark, SF_SMALL).select("Link", "text")


def test_resume_skips_done_links(spark):
    docs = _docs(spark)
    links = docs.select("Link")
    out = os.path.join(tempfile.mkdtemp(prefix="lapline-ingest-"), "results")
    first = links.filter(F.pmod(F.xxhash64("Link"), F.lit(2)) == 0)
    K.ingest_to_path(spark, first, docs, out)
    n_first = spark.read.parquet(out).count()
    stored = K.ingest_to_path(spark, links, docs, out, batches=4)
    full = parse_sheets(docs)
    assert stored.count() == full.count() > n_first
    assert stored.exceptAll(full).count() == 0
    again = K.ingest_to_path(spark, links, docs, out)        # nothing left: no new rows
    assert again.count() == full.count()


def test_missing_output_and_link_lists(spark):
    links = spark.createDataFrame([(2020, "A", "m1", None), (2021, "B", "m1", "w1")],
                                  "year int, competition string, mens_400_free_pdf string, womens_400_free_pdf string")
    lists = K.link_lists(links).collect()
    assert sorted((r.sex, r.Link) for r in lists) == [("F", "w1"), ("M", "m1"), ("M", "m1")]
    docs = spark.createDataFrame([("m1", "1 4 SUN Yang CHN 0.73 3:40.29\n")], "Link string, text string")
    empty = spark.createDataFrame([], "Link string")
    allrows, new = K.ingest(K.link_lists(links), docs, empty)
    assert new.count() == 2          # m1 is listed twice (two competitions): parsed twice
    rep = {r.Link: r.rows for r in K.report(K.link_lists(links), allrows).collect()}
    assert rep == {"m1": 2, "w1": 0}


def test_streaming_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="lapline-stream-")
    folder = os.path.join(base, "in")
    os.makedirs(folder)
    docs = _docs(spark).orderBy("Link").limit(30).collect()
    for i, r in enumerate(docs):
        with open(os.path.join(folder, f"sheet{i:03d}.txt"), "w") as fh:
            fh.write(r.text)
    out, ckpt, typed_out = os.path.join(base, "out"), os.path.join(base, "ckpt"), os.path.join(base, "typed")
    q = start_ingest(spark, folder, out, ckpt, max_files=10, typed_output=typed_out, sex="M")
    q.awaitTermination(300)
    typed = spark.read.parquet(typed_out)
    assert dict(typed.dtypes)["final_time"] == "double" and typed.filter("sex = 'M'").count() == typed.count()
    streamed = spark.read.parquet(out).drop("Link", "batch_id")
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3   # 30 files, 10 per batch
    batch = parse_sheets(spark.createDataFrame([(r.Link, r.text) for r in docs], "Link string, text string")).drop("Link")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
    q2 = start_ingest(spark, folder, out, ckpt, max_files=10)   # rerun on the same checkpoint: no new batch
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == batch.count()


def test_duplicate_listed_link_is_processed_twice(spark):
    docs = spark.createDataFrame([("m1", "1 4 SUN Yang CHN 0.73 3:40.29\n")], "Link string, text string")
    links = spark.createDataFrame([("m1",), ("m1",)], "Link string")
    _, new = K.ingest(links, docs, spark.createDataFrame([], "Link string"))
    assert new.count() == 2


def test_link_lists_rejects_non_frames():
    import pytest
    with pytest.raises(TypeError):
        K.link_lists([("2020", "A", "m", "w")])


def test_earlier_output_without_link_skips_nothing(spark):
    earlier = spark.createDataFrame([("Final", 1)], "heat string, rank int")
    docs = spark.createDataFrame([("m1", "1 4 SUN Yang CHN 0.73 3:40.29\n")], "Link string, text string")
    links = spark.createDataFrame([("m1",)], "Link string")
    assert K.processed_links(earlier) is None
    allrows, new = K.ingest(links, docs, earlier)
    assert new.count() == 1 and allrows.count() == 2            # earlier rows kept, nothing skipped


def test_both_forms_keep_list_duplicates(spark, tmp_path):
    docs = spark.createDataFrame([("m1", "1 4 SUN Yang CHN 0.73 3:40.29\n")], "Link string, text string")
    links = spark.createDataFrame([("m1",), ("m1",)], "Link string")
    for batches in (None, 3):
        out = str(tmp_path / f"out{batches}")
        assert K.ingest_to_path(spark, links, docs, out, batches=batches, work=str(tmp_path / "work")).count() == 2
        assert not (tmp_path / "work").exists()


def test_resume_after_a_batch_that_failed(spark, tmp_path, monkeypatch):
    docs, out = _docs(spark), str(tmp_path / "out")
    full, write, done = parse_sheets(docs), K.write_results, []

    def failing(df, path, mode):
        if len(done) == 2:
            raise RuntimeError("an executor went")
        done.append(path)
        write(df, path, mode=mode)

    monkeypatch.setattr(K, "write_results", failing)
    try:
        K.ingest_to_path(spark, docs.select("Link").distinct(), docs, out, batches=4, work=str(tmp_path / "work"))
    except RuntimeError:
        pass
    assert 0 < spark.read.parquet(out).count() < full.count() and not (tmp_path / "work").exists()
    monkeypatch.setattr(K, "write_results", write)
    stored = K.ingest_to_path(spark, docs.select("Link").distinct(), docs, out, batches=4, work=str(tmp_path / "work2"))
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0


def test_batches_do_not_read_the_documents_again(spark, tmp_path):
    """The documents are scanned for one write; a batch reads its own directory."""
    seen = []
    docs = _docs(spark)
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    real = K.parse_sheets

    def watched(df):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    K.parse_sheets = watched
    try:
        K.ingest_to_path(spark, stored.select("Link").distinct(), stored, str(tmp_path / "out"), batches=5, work=str(tmp_path / "work"))
    finally:
        K.parse_sheets = real
    assert len(seen) == 5 and all("PartitionFilters: [isnotnull(batch" in p and str(tmp_path / "docs") not in p for p in seen)


def test_off_local_mode_a_shared_folder_is_required():
    import pytest

    from lapline.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_sheets_are_shuffled_as_numbers(spark):
    plan = FX.render_sheets(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    above, _, below = plan.partition("Exchange hashpartitioning")
    assert "collect_list" in above and "collect_list" not in below and "Exchange hashpartitioning" not in below


def test_resumed_runs_render_the_sheets_once(spark):
    from lapline.plans import registry as R
    queries = ("ingest_resumed", "ingest_second_run_rows", "ingest_report")
    frames = {q: R.REGISTRY[q](spark, SF_SMALL) for q in queries}
    for q, frame in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" not in plan and "o_orderkey" not in plan, q     # only stored lists, sheets and rows are read
    links, docs = K.link_lists(R._links(spark, SF_SMALL)), _docs(spark)
    rows = parse_sheets(docs.join(links.select("Link"), "Link", "inner"))
    got = frames["ingest_resumed"]
    assert got.count() == rows.count() and got.exceptAll(rows).count() == rows.exceptAll(got).count() == 0
    new = rows.filter(F.substring(F.md5("Link"), 1, 1) >= "8").groupBy("Link").count()
    second = frames["ingest_second_run_rows"]
    assert second.count() == new.count() and second.exceptAll(new).count() == 0
    report = frames["ingest_report"].select("Link", "rows")
    assert report.exceptAll(K.report(links, rows)).count() == 0 and report.count() == links.select("Link").distinct().count()


def test_runs_to_a_path_render_the_sheets_once(spark, monkeypatch):
    from lapline.plans import registry as R
    read = []
    run = K.ingest_to_path

    def noted(spark, links, documents, *rest, **more):
        read.append(documents._jdf.queryExecution().executedPlan().toString())
        return run(spark, links, documents, *rest, **more)

    monkeypatch.setattr(K, "ingest_to_path", noted)
    full = parse_sheets(_docs(spark))
    for q in ("ingest_nothing_left", "ingest_in_batches"):
        got = R.REGISTRY[q](spark, SF_SMALL)
        assert got.count() == full.count() and got.exceptAll(full).count() == 0
    assert len(read) == 3 and not any("l_orderkey" in plan for plan in read)
