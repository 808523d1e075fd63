"""Cached encoding, packed token files (operator 9) and packing (operator 6) against whole-text encoding."""

import random
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import no_docs, odd_docs, odd_rows, with_clashes
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lapline.llm import packing, token_files
from lapline.llm.tokens import Encoder

FILES = {n: public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")}


def whole(name, texts):
    t = Tokenizer.from_file(FILES[name])
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name", FILES)
def test_cached_encoding_equals_whole_texts(name):
    enc = Encoder(FILES[name])

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from(list("ab AZ'st.,!1\n\t\r   ́İΣéßñ日<|>_-\x1c\x85")), max_size=40))
    def check(text):
        assert np.frombuffer(enc.ids([text])[0], "<u4").tolist() == whole(name, [text])[0]

    check()


@pytest.mark.parametrize("name", FILES)
def test_capitals_with_marks_and_odd_characters(name):
    """Every ASCII letter with every combining mark of the first block, and random code points."""
    rng = random.Random(6)
    texts = [f"{a}{chr(m)}{b}" for a in string.ascii_letters for m in range(0x300, 0x370) for b in ("", "b C")]
    plane = [*range(0x20, 0x7F), *range(0x300, 0x370), *range(0x80, 0x590), *range(0x1E00, 0x2100), *range(0x1100, 0x1200), *range(0xAC00, 0xAC80)]
    texts += ["".join(chr(rng.choice(plane)) if rng.random() < 0.6 else rng.choice("AHJTWY aefi.,\n'") for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    got = Encoder(FILES[name]).ids(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == whole(name, texts)


@pytest.mark.parametrize("bits", [1, 7, 15, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_bits_round_trip(bits, n):
    rng = np.random.default_rng(bits * 100 + n)
    ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
    assert (token_files.unpack_bits(token_files.pack_bits(ids, bits), bits, n) == ids).all()
    shard = token_files.Shard(token_files.pack_shard(ids, np.array([0] * bool(n)), bits, 128))
    for _ in range(20):
        a = random.Random(n).randint(0, n)
        b = random.Random(n + 1).randint(a, n)
        assert (shard.read_ids(a, b - a) == ids[a:b]).all()


def test_ids_too_large_and_bad_ranges_raise():
    with pytest.raises(ValueError):
        token_files.pack_bits(np.array([4], np.uint32), 2)
    shard = token_files.Shard(token_files.pack_shard(np.arange(10, dtype=np.uint32), np.array([0]), 4))
    with pytest.raises(IndexError):
        shard.read_ids(5, 6)
    assert token_files.vocabulary_bits(49408) == 16 and token_files.vocabulary_bits(1) == 1 and token_files.vocabulary_bits(32000) == 15


def test_token_files_against_whole_encoding(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 2000)
    name = "word_bpe_49k.json"
    token_files.write_token_files(with_clashes(odd_docs(spark)), str(tmp_path / "t"), FILES[name])
    got = token_files.read_token_files(spark, str(tmp_path / "t"), with_ids=True).orderBy("start").collect()
    rows = odd_rows()
    ids = [x + [1] for x in whole(name, [r[1] for r in rows])]
    want = Counter((r[0], tuple(x)) for r, x in zip(rows, ids))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    keys = [r["doc_id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_token_files(no_docs(spark), str(tmp_path / "t"), FILES["word_bpe_49k.json"])
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0


def _one_at_a_time(lengths, most):
    """Shortest pack first, item by item."""
    packs = []
    for x in sorted(lengths, reverse=True):
        packs.sort()
        if packs and packs[0] + x <= most:
            packs[0] += x
        else:
            packs.append(x)
    return sorted(packs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_shortest_pack_first_places_every_length(lengths):
    patterns = packing.shortest_pack_first(Counter(lengths), 32)
    placed = Counter()
    for count, parts in patterns:
        assert count > 0 and sum(length * times for length, times in parts) <= 32
        for length, times in parts:
            placed[length] += count * times
    assert placed == Counter(lengths)
    assert sum(c for c, _ in patterns) <= len(_one_at_a_time(lengths, 32)) + 1
    # ranks cover each length without gaps
    for length, rows in packing.places(patterns).items():
        assert rows[0][0] == 0 and len({r[0] for r in rows}) == len(rows) and placed[length]


def test_plan_size_follows_the_histogram_only():
    rng = random.Random(3)
    small = Counter(rng.randint(1, 2048) for _ in range(20_000))
    large = Counter({k: 1000 * v for k, v in small.items()})
    a, b = packing.shortest_pack_first(small), packing.shortest_pack_first(large)
    assert len(a) <= 2 * 2048 and len(b) <= 2 * 2048
    tokens = sum(k * v for k, v in large.items())
    assert 1 - tokens / (2048 * sum(c for c, _ in b)) < 0.01


def test_a_length_out_of_range_raises():
    with pytest.raises(ValueError):
        packing.shortest_pack_first({9: 1}, 8)


def test_packing_against_whole_encoding(spark):
    name = "byte_bpe_50k.json"
    got = packing.pack_documents(with_clashes(odd_docs(spark)), FILES[name], max_tokens=64, with_ids=True).collect()
    want = Counter((r[0], tuple(x + [1])) for r, x in zip(odd_rows(), whole(name, [r[1] for r in odd_rows()])))
    assert {(r["doc_id"], r["doc_tokens"]) for r in got} == {(k, len(x)) for k, x in want}
    assert sum(r["length"] for r in got) == sum(len(x) * n for (_, x), n in want.items())
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(ids) == r["length"] and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        assert any(k == r["doc_id"] and list(x[r["start"]:r["start"] + r["length"]]) == ids.tolist() for k, x in want)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by) == list(range(len(by)))
    for rows in by.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 64 and {r["padded_to"] for r in rows} == {at if at & (at - 1) == 0 else 64}
    assert packing.pack_documents(no_docs(spark), FILES[name]).count() == 0


def test_ranks_of_a_hot_group_have_no_gaps(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7))
    rows = packing.ranked(df, F.col("g"), [F.col("id")]).collect()
    by = {}
    for r in rows:
        by.setdefault(r["g"], []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and len(rows) == 3000
