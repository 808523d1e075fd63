"""The registered queries against brute force over the small tables, and the pipeline stage by stage."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from helpers import no_docs, odd_docs, with_clashes, words
from test_dedup import _components, _fingerprint, _repeats
from test_quality_mixing import _counts, _mixture
from tests.conftest import SF_SMALL
from tokenizers import Tokenizer

import corpus_pipeline
from lapline.llm import mixing
from lapline.llm.registry import QUERIES


def _docs(spark):
    return sorted((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in QUERIES if q != "pipeline"] == [f"op{n}" for n in range(1, 14)]
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "substring dedup", "source mixing", "packing"]


def test_mixing_query(spark):
    got = Counter()
    for r in QUERIES["op1_mixing"](spark, SF_SMALL).collect():
        got[(r["doc_id"], r["source"], r["epoch"])] += r["times"]
    want = Counter()
    for (i, _, s, e), n in _mixture(_docs(spark), mixing.ENTROPY, mixing.REPEATS, None, mixing.BLOCK_TOKENS).items():
        want[(i, s, e)] += n
    assert got == want


def test_simhash_query(spark):
    docs = _docs(spark)
    fps = [_fingerprint(d[1]) for d in docs]
    want = {d[0]: (f"{f:016x}", docs[root][0]) for d, f, root in zip(docs, fps, _components(fps))}
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op5_simhash"](spark, SF_SMALL).collect()} == want


def test_token_queries(spark):
    docs = _docs(spark)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = [e.ids + [1] for e in t.encode_batch([d[1] for d in docs], add_special_tokens=False)]
    at, want = 0, {}
    for d, x in zip(docs, ids):
        want[d[0]] = (at, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op9_token_files"](spark, SF_SMALL).collect()} == want


def test_quality_query_counts(spark):
    got = {r["doc_id"]: tuple(r)[1:6] for r in QUERIES["op10_quality"](spark, SF_SMALL).collect()}
    assert got == {d[0]: _counts(d[1]) for d in _docs(spark)}


def test_pipeline_stages(spark, tmp_path):
    """Each stage on what its predecessor kept, held against brute force."""
    docs = with_clashes(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    columns, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        assert name == "packing" or docs.columns == columns
        rows[name] = (before.collect(), docs.collect())
    before, after = rows["quality rules"]
    good = {r["doc_id"] for r in QUERIES["op10_quality"](spark, SF_SMALL).filter("kept").collect()}
    assert Counter(after) == Counter(r for r in before if r["doc_id"] in good)
    before, after = rows["near duplicates"]
    before = sorted(before, key=lambda r: r["doc_id"])
    roots = _components([_fingerprint(r["text"]) for r in before])
    assert Counter(after) == Counter(r for i, (r, root) in enumerate(zip(before, roots)) if i == root)
    before, after = rows["substring dedup"]
    before = sorted(before, key=lambda r: r["doc_id"])
    got = {r["doc_id"]: r["text"] for r in after}
    assert len(got) == len(before)
    for r, (_, gone) in zip(before, _repeats([(r["doc_id"], r["text"]) for r in before], 20)):
        assert words(got[r["doc_id"]]) == [w for i, w in enumerate(words(r["text"])) if i not in gone]
        assert gone or got[r["doc_id"]] == r["text"]
    before, after = rows["source mixing"]
    want = Counter()
    for (i, k, s, _), n in _mixture([(r["doc_id"], r["text"], None, r["source"]) for r in before], mixing.ENTROPY, mixing.REPEATS, None, mixing.BLOCK_TOKENS).items():
        want[(i, k, s)] += n
    assert Counter((r["doc_id"], hashlib.md5(r["text"].encode()).hexdigest(), r["source"]) for r in after) == want
    before, after = rows["packing"]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = [len(e.ids) + 1 for e in t.encode_batch([r["text"] for r in before], add_special_tokens=False)]
    assert sum(r["length"] for r in after) == sum(sizes)
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in after if r["start"] == 0) == Counter(zip([r["doc_id"] for r in before], sizes))


def test_pipeline_of_odd_and_no_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark), odd_docs(spark).filter("text IS NULL")):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_SMALL)
        assert docs.count() >= 0


def test_run_is_the_stages(spark):
    assert QUERIES["pipeline"](spark, SF_SMALL).count() > 0
