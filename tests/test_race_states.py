"""Per-race answers kept by batch, and the ingest in buckets."""

import uuid

from pyspark.sql import functions as F

from lapline.operators import ingest as K
from lapline.operators import race_states as R
from lapline.operators.parse import parse_sheets
from lapline.plans import queries as Q
from lapline.sources import fixtures as FX
from lapline.sources import tables as T
from lapline.streaming.sheets import start_ingest
from tests.conftest import SF_SMALL

ROWS = "Link string, final_time double"


def _same(a, b):
    assert a.collect() == b.collect()


def _holds(spark, store, rows):
    """The stored states answer as the questions asked of all rows do, order included."""
    states = R.current(spark, store)
    _same(R.swimmers_per_race(states), Q.swimmers_per_race(rows))
    _same(R.swimmers_per_race(states, 3), Q.swimmers_per_race(rows, 3))
    _same(R.fastest_per_race(states), Q.fastest_per_race(rows))
    _same(R.avg_final_per_race(states), Q.avg_final_per_race(rows))


def test_every_batch_leaves_the_full_answer(spark, tmp_path):
    store = str(tmp_path / "races")
    rows = FX.canonical_results(spark, SF_SMALL).select("Link", "final_time", "rank").persist()
    assert R.current(spark, store).count() == 0
    for batch in range(7):
        assert R.add_batch(spark, rows.filter(F.col("rank") == batch + 1), store, batch)
        if batch == 3:
            R.merge(spark, store, 3)
        _holds(spark, store, rows.filter(F.col("rank") <= batch + 1))
    assert not R.add_batch(spark, rows.filter("rank = 2"), store, 1)      # merged already: counted once
    assert R.add_batch(spark, rows.filter("rank = 6"), store, 5)          # comes again: replaces itself
    R.merge(spark, store, 6)
    _holds(spark, store, rows)
    rows.unpersist()


def test_odd_rows_and_unfinished_folders(spark, tmp_path):
    store = str(tmp_path / "races")
    first = spark.createDataFrame([(None, 225.11), ("a", None), ("a", None), ("b", 230.0)], ROWS)
    second = spark.createDataFrame([(None, 224.0), ("a", 240.5), ("b", 230.0), ("", None)], ROWS)
    R.add_batch(spark, spark.createDataFrame([], ROWS), store, 0)
    assert R.current(spark, store).count() == 0
    R.add_batch(spark, first, store, 1)
    R.add_batch(spark, second, store, 2)
    _holds(spark, store, first.unionByName(second))
    R.merge(spark, store, 2)
    R.merge(spark, store, 2)
    _holds(spark, store, first.unionByName(second))
    # a batch and a merge that did not commit do not count
    R.states_of(first).write.parquet(f"{store}/batches/batch_id=3")
    R.states_of(first).write.parquet(f"{store}/merged/upto=9")
    for folder in ("batches/batch_id=3", "merged/upto=9"):
        (tmp_path / "races" / folder / "_SUCCESS").unlink()
    _holds(spark, store, first.unionByName(second))


def test_the_older_rows_are_not_read(spark, tmp_path):
    """A batch's plan scans its own rows alone; an answer scans states alone."""
    store, base = str(tmp_path / "races"), str(tmp_path / "rows")
    rows = FX.canonical_results(spark, SF_SMALL).select("Link", "final_time", "rank")
    rows.write.partitionBy("rank").parquet(base)
    for batch in (1, 2):
        R.add_batch(spark, spark.read.parquet(f"{base}/rank={batch}"), store, batch)
    read = R.avg_final_per_race(R.current(spark, store)).inputFiles()
    assert {name.split("/")[-2] for name in read} == {"batch_id=1", "batch_id=2"} and not any(base in name for name in read)


def test_stream_keeps_the_states(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, r in enumerate(FX.render_sheets(spark, SF_SMALL).orderBy("Link", "session").limit(12).collect()):
        (folder / f"sheet{i:02d}.txt").write_text(r.text)
    out, store = str(tmp_path / "out"), str(tmp_path / "races")
    for _ in range(2):                                                    # the second run finds nothing new
        start_ingest(spark, str(folder), out, str(tmp_path / "ckpt"), max_files=5, typed_output=str(tmp_path / "typed"),
                     sex="M", race_states=store).awaitTermination(300)
        _holds(spark, store, spark.read.parquet(str(tmp_path / "typed")))


def _stored_sheets(spark, tmp_path, docs, buckets=4):
    name = f"sheets_{uuid.uuid4().hex}"
    T.save_bucketed(docs, name, str(tmp_path / "sheets"), buckets)
    return name, f"results_{uuid.uuid4().hex}"


def _exchanges_above(plan: str, table: str) -> list[str]:
    """Exchange lines that stand above the scan of ``table`` (a deeper line belongs to the last shallower one)."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    def depth(line):
        return len(line) - len(line.lstrip(" :|+-"))
    found, now = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < now:
            now = depth(line)
            if "Exchange" in line:
                found.append(line)
    return found


def test_buckets_resume_without_a_shuffle_of_texts(spark, tmp_path, monkeypatch):
    docs = FX.render_sheets(spark, SF_SMALL).select("Link", "text")
    documents, results = _stored_sheets(spark, tmp_path, docs)
    plans, real = [], K.parse_sheets

    def watched(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return real(frame)

    monkeypatch.setattr(K, "parse_sheets", watched)
    links = docs.select("Link").distinct()
    half = links.filter(F.pmod(F.xxhash64("Link"), F.lit(2)) == 0)
    path = str(tmp_path / "results")
    n_half = K.ingest_bucketed(spark, half, documents, results, path, 4).count()
    stored = K.ingest_bucketed(spark, links, documents, results, path, 4)
    full = parse_sheets(docs)
    assert 0 < n_half < stored.count() == full.count()
    assert stored.exceptAll(full).count() == 0 and full.exceptAll(stored).count() == 0
    assert K.ingest_bucketed(spark, links, documents, results, path, 4).count() == full.count()   # nothing left
    assert len(plans) == 3
    for plan in plans:
        assert _exchanges_above(plan, documents) == []
    for plan in plans[1:]:
        assert _exchanges_above(plan, results) == []


def test_buckets_of_odd_lists(spark, tmp_path):
    """Listed twice: processed twice.  Null and unknown links and sheets without rows add nothing; no list, no row."""
    docs = spark.createDataFrame([("m1", "1 4 SUN Yang CHN 0.73 3:40.29\n"), ("m2", ""), ("m3", None)], "Link string, text string")
    documents, results = _stored_sheets(spark, tmp_path, docs)
    path = str(tmp_path / "results")
    none = spark.createDataFrame([], "Link string")
    assert K.ingest_bucketed(spark, none, documents, results, path, 4).count() == 0
    links = spark.createDataFrame([("m1",), ("m1",), ("m2",), ("m3",), ("m4",), (None,)], "Link string")
    assert [r.Link for r in K.ingest_bucketed(spark, links, documents, results, path, 4).collect()] == ["m1", "m1"]
    assert K.ingest_bucketed(spark, links, documents, results, path, 4).count() == 2
