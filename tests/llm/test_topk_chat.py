"""Exact top-k (operator 3) and chat formatting (operator 8) against plain Python."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lapline.llm import chat, topk


def _brute(rows, asked, k):
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in whole if asked(i)}):
        mine = min(v for i, v in whole if i == q)
        scores = sorted((-sum(a * b for a, b in zip(mine, v)), i) for i, v in whole if i != q)
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("small", [False, True])
def test_top_k_against_brute_force(spark, monkeypatch, small):
    if small:  # many cells, steep and flat buckets
        for name, value in (("BUCKET_ROWS", 16), ("CHUNK_ROWS", 64), ("QUERY_ROWS", 8), ("SEED_ROWS", 30)):
            monkeypatch.setattr(topk, name, value)
    rng = random.Random(4)
    rows = []
    for i in range(400):
        scale = math.exp(rng.gauss(0, 1.5))
        rows.append((i, [rng.gauss(0, 1) * scale for _ in range(6)]))
    rows += [(400 + i, [3.0, 1.0, 0.5, 0.0, 0.0, 0.0]) for i in range(60)]  # one frequent vector
    rows += [(500 + i, [40.0 + i, 0.1, 0.0, 0.2, 0.0, 0.0]) for i in range(20)]  # nearly one direction: steep cosines
    rows += [(600, None), (620, [1.0, None]), (640, [float("nan")] * 6), (660, [float("inf"), 0.0]), (680, []), (700, [1.0, 2.0]), (720, [0.0] * 6),
             (None, [1.0] * 6), (740, [5.0] * 6), (740, [-5.0] * 6), (741, [-5.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("id", "v", "length", "side", "part", "chunk", "c")})
    got = topk.top_k(df.repartition(4), F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == _brute(rows, lambda i: i % 20 == 0, 20)


def test_fewer_candidates_than_k_and_no_query(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-2.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") == 0).collect())) == [(0, 1, 1, 8192), (0, 2, 2, -8192)]
    assert topk.top_k(df, F.lit(False)).count() == 0
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


def test_pruned_before_the_shuffle(spark, monkeypatch):
    """Cells get less than half of what pruning inside them would need sent; every pair that reaches a floor still meets in one cell."""
    for name, value in (("BUCKET_ROWS", 16), ("CHUNK_ROWS", 64), ("QUERY_ROWS", 8), ("SEED_ROWS", 40)):
        monkeypatch.setattr(topk, name, value)
    sent = []
    for spread in (0.0, 1.0, 3.0):
        rng = random.Random(7)
        rows = [(i, [abs(rng.gauss(0, 1)) * math.exp(rng.gauss(0, spread)) for _ in range(4)]) for i in range(600)]
        rows += [(600 + 10 * i, [-1.0 - i, 0.0, 0.0, 0.0]) for i in range(6)] + [(700, [0.0] * 4), (710, [])]  # scores of zero and below
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        asked = F.col("vec_id") % 10 == 0
        assert sorted(map(tuple, topk.top_k(df, asked).collect())) == _brute(rows, lambda i: i % 10 == 0, 20)
        dealt, _ = topk.cells(df, asked, 20, "vec_id", "embedding", topk.SCALE)
        got = dealt.collect()
        queries, candidates = [r for r in got if r["side"] == 0], [r for r in got if r["side"] == 1]
        sent.append((len(got), (1 + max(r["part"] for r in got)) * len(rows) + len({r["id"] for r in queries}) * (1 + max(r["chunk"] for r in got))))
        held = {}
        for r in candidates:
            held.setdefault((r["part"], r["chunk"]), []).append(r)
        for i in {r["id"] for r in queries}:
            mine = [r for r in queries if r["id"] == i]
            met = {p["id"] for r in mine for p in held.get((r["part"], r["chunk"]), [])}
            reach = {v for v, x in rows if sum(a * math.floor(64 * b) for a, b in zip(mine[0]["v"], x)) >= mine[0]["floor"]}
            assert reach - {i} <= met
    assert all(few < whole / 2 for few, whole in sent), sent  # whole: every row to every block, every query to every chunk


def test_products_past_doubles_are_exact():
    q, p = np.array([[float(2 ** 30), 1.0]]), np.array([[float(2 ** 30), 1.0], [3.0, 1.0]])
    assert topk.products(q, p).tolist() == [[2 ** 60 + 1, 3 * 2 ** 30 + 1]]


TEXT = st.lists(st.sampled_from([*"ab\\<>/turn\n é😀|# ", "</turn>", "<turn>", "\\<", "\\\\"]), max_size=20).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=6))
def test_assembly_reads_back(turns):
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    out, ends, a, b = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    found = chat.read_turns(out.tobytes())
    assert [(r, t) for r, t, _, _ in found] == turns
    assert [(s, e) for _, _, s, e in found] == list(zip(a.tolist(), b.tolist()))
    assert [chat.unescape(out[x:y].tobytes().decode()) for x, y in zip(a, b)] == texts
    assert len(out) == (ends[-1] if len(ends) else 0)


def test_bad_bytes_raise():
    for bad in (b"<turn>user\nx", b"<turm>user\nx</turn>\n", b"<turn>user\nx</turm>\n"):
        with pytest.raises(ValueError):
            chat.read_turns(bad)


def _rows():
    tricky = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky), (1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, None, "user", "first"),
            (2, 0, None, "x"), (2, 1, "assistant\n<", "role with marks"), (2, 2, "assistant", "é😀\\"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
            (None, 0, "user", "nobody"), (None, 1, "assistant", "answer")]
    rng = random.Random(1)
    return rows + [(50, i, rng.choice(("user", "assistant")), f"turn {i} " * rng.randint(0, 30)) for i in range(700)] + [(51, 0, "assistant", "<" * 20_000)]


def _digests(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        loss = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        out[conv] = (len(mine), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("chunk_bytes", [300, 3000, 32 << 20])
def test_formatting_reads_back(spark, chunk_bytes):
    rows = _rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("conv", "chunk", "formatted", "loss")})
    formatted = chat.format_conversations(df.repartition(3), chunk_bytes=chunk_bytes).cache()
    assert formatted.filter("chunk > 0").count() > 0 or chunk_bytes > 1 << 20
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest(formatted).collect()}
    assert got == _digests(rows)
    chars = {r["conv"]: r["n"] for r in formatted.groupBy("conv").agg(F.sum(F.length("formatted")).alias("n")).collect()}
    assert {r["conv_id"]: r["formatted_chars"] for r in chat.digest(formatted).collect()} == chars


def test_a_long_conversation_is_dealt_to_several_tasks(spark):
    rng = random.Random(3)
    rows = [(1, rng.choice((None, i // 3)), rng.choice((None, "", "user", "assistant", "r" * 32, "r" * 33 + str(i % 5))),
             rng.choice((None, "", "t" * 40, f"{i % 7} <turn> " * 5))) for i in range(4000)] + [(2, 0, "assistant", "other")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    formatted = chat.format_conversations(df, chunk_bytes=3000).cache()
    assert formatted.filter("conv = 1").select("part").distinct().count() > 1
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digest(formatted).collect()}
    assert got == _digests(rows)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(chat.format_conversations(df)).count() == 0
