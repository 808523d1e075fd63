"""SimHash near duplicates (operator 5), substring dedup (operator 7) and components against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from helpers import no_docs, odd_docs, odd_rows, prose, with_clashes, words
from pyspark.sql import functions as F

from lapline.llm import simhash, substrings
from lapline.llm.graph import components


def _fingerprint(text):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_fingerprints():
    for text in [r[1] for r in odd_rows() if r[1] is None or len(r[1]) < 5000]:
        assert simhash.fingerprint(text) == _fingerprint(text)


def test_golay_code_is_perfect():
    rng = np.random.default_rng(0)
    code = np.unique([int(m) << 11 | int(simhash.UPPER[m]) for m in range(4096)])
    assert len(code) == 4096 and min(bin(int(c)).count("1") for c in code[1:]) == 7
    for c in rng.choice(code, 50):
        errors = rng.choice(23, 3, replace=False)
        word = int(c) ^ sum(1 << int(e) for e in errors)
        assert simhash.decode(np.array([word]))[0] == int(c) >> 11


def test_every_pair_within_four_bits_shares_a_key():
    rng = np.random.default_rng(1)
    for flips in range(5):
        for _ in range(400):
            f = rng.integers(0, 1 << 64, dtype=np.uint64)
            g = f ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, flips, replace=False)))
            (ra, ka), (rb, kb) = (simhash.keys_of(np.array([x], np.uint64)) for x in (f, g))
            assert set(ka) & set(kb)


def _components(fps):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("tile", [4, 2048])
def test_links_join_what_pairs_join(spark, monkeypatch, tile):
    """Balls of many near fingerprints, chains and strangers; small tiles take the way of hot keys."""
    import pyarrow as pa

    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(5):
        centre = rng.getrandbits(64)
        fps |= {centre ^ sum(1 << rng.randrange(64) for _ in range(2)) for _ in range(60)}
        chain = centre
        for _ in range(10):
            chain ^= sum(1 << b for b in rng.sample(range(64), 4))
            fps.add(chain)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    rows, keys = simhash.keys_of(np.array(fps, np.uint64))
    order = np.lexsort((np.array(signed)[rows], keys))
    monkeypatch.setattr(simhash, "TILE", tile)
    batch = pa.RecordBatch.from_arrays([pa.array(keys[order]), pa.array(np.array(signed)[rows][order])], names=["key", "f"])
    found, hot = [], {}
    for out in simhash._compare(iter([batch.slice(i, 97) for i in range(0, len(rows), 97)])):
        for kind, a, b, key, tile_no in zip(*(c.to_pylist() for c in out.columns)):
            if kind == 0:
                found.append((a, b))
            else:
                hot.setdefault(key, {}).setdefault(tile_no, []).append(a)
    for tiles in hot.values():
        for i in tiles:
            for j in tiles:
                if i <= j:
                    x = np.array(tiles[i], np.int64)
                    a, b = simhash.forest(x) if i == j else simhash.forest(x, np.array(tiles[j], np.int64))
                    found += list(zip(a.tolist(), b.tolist()))
    assert bool(hot) == (tile == 4)
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 4 for a, b in found)
    place = {f: i for i, f in enumerate(signed)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in found:
        x, y = find(place[a]), find(place[b])
        parent[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == _components(fps)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200), (300, 150)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {x: 100 for x in [*range(100, 160), 300]} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    rows = odd_rows()
    got = simhash.near_duplicates(with_clashes(odd_docs(spark)).drop("f")).collect()
    fps = [_fingerprint(r[1]) if r[1] is None or len(r[1]) < 5000 else simhash.fingerprint(r[1]) for r in rows]
    roots = _components(fps)
    want = []
    for r, f, root in zip(rows, fps, roots):
        ids = [x[0] for x, k in zip(rows, roots) if k == root and x[0] is not None]
        want.append((r[0], f, min(ids) if ids else None))
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["id"], r["f"] % (1 << 64), r["component_id"]) for r in got), key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    docs = with_clashes(odd_docs(spark))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    rows = odd_rows()
    roots = _components([simhash.fingerprint(r[1]) for r in rows])
    assert len(got) == len(set(roots))
    texts = {r: i for r, i in zip([x[1] for x in rows], roots)}
    assert len({texts[t] for _, t in got}) == len(got)
    assert simhash.keep_first(no_docs(spark)).count() == 0
    twice = odd_docs(spark).filter("doc_id = 2")
    assert simhash.keep_first(twice).count() == 1


def _repeats(rows, window):
    """Brute force over (id, text) rows in order: n_words, removed word numbers."""
    seen, out = set(), []
    for _, text in rows:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            k = tuple(w[i:i + window])
            gone |= set(range(i, i + window)) if k in seen else set()
            seen.add(k)
        out.append((len(w), gone))
    return out


@pytest.mark.parametrize("block_words", [50, 2_000_000])
def test_repeats_against_brute_force(spark, block_words):
    rng = random.Random(9)
    shared = [prose(100 + i, rng.randint(15, 60)) for i in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(i, rng.randint(0, 50))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(1000 + i, rng.randint(0, 10))]
        rows.append((i * 3 % 61, "\n ".join(parts)))
    rows += [(70, None), (71, ""), (72, "x " * 200), (73, shared[0]), (74, "\x1c ".join(["a"] * 40))]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = {r["row"]["doc_id"]: r for r in substrings.repeats(docs, block_words=block_words).collect()}
    rows = sorted(rows)
    assert len(got) == len(rows)
    for (key, text), (n, gone) in zip(rows, _repeats(rows, 20)):
        r = got[key]
        assert r["n_words"] == n and {i for s in r["spans"] for i in range(s["start"], s["end"])} == gone
        assert r["kept"] == " ".join(w for i, w in enumerate(words(text)) if i not in gone)
        assert r["row"]["text"] == text


def test_repeats_of_odd_rows(spark):
    rows = [r for r in odd_rows()]
    got = substrings.repeats(odd_docs(spark)).collect()
    assert len(got) == len(rows)
    by_text = {}
    for r in got:
        by_text.setdefault(r["row"]["text"], []).append(len(r["spans"]))
    base = rows[0][1]
    assert sorted(by_text[base]) == [0, 1, 1]  # one of three equal texts stays whole
    none = no_docs(spark)
    assert substrings.repeats(none).count() == 0
    assert substrings.repeats(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).first()["kept"] == "a b c"
    with pytest.raises(ValueError):
        substrings.repeats(none, window=21)


def test_removed_passages_leave_the_rest_as_it_was(spark):
    passage = prose(50, 25)
    docs = spark.createDataFrame([(1, "start\n" + passage), (2, "one\ttwo\n" + passage + "  three\n\nfour "), (3, passage), (4, " as  it\nis "), (5, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substrings.remove_repeats(with_clashes(docs)).collect()}
    assert got == {1: "start\n" + passage, 2: "one\ttwo three\n\nfour", 3: "", 4: " as  it\nis ", 5: None}
    assert substrings.remove_repeats(with_clashes(docs)).columns == with_clashes(docs).columns


def test_query_digests(spark):
    from tests.conftest import SF_SMALL

    from lapline.llm.registry import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op7_substrings"](spark, SF_SMALL).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    for (key, text), (n, gone) in zip(rows, _repeats(rows, 20)):
        kept = " ".join(w for i, w in enumerate(words(text)) if i not in gone)
        r = got[key]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (n, len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert F is not None
