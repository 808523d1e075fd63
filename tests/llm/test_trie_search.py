"""Conversation trie (operator 11), lexical search (12) and decontamination (13) against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import no_docs, odd_docs, odd_rows, with_clashes, words
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

from lapline.llm import contamination, lexical, terms, trie
from lapline.llm.registry import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


# ---- operator 11


def _trie(rows, graft):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(t)] for c, t in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4 if graft else 0
        rebuilt[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(set)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(words(p[-1][1])) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if rebuilt[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _conversations():
    rng = random.Random(3)
    rows = []
    for c in range(60):  # much shared, many lengths
        rows += [(c, t, rng.choice(("user", "assistant")), rng.choice(("a b", "a", "", "c  d\te"))) for t in range(rng.randint(1, 6))]
    for c in range(100, 160):  # one opening, then a common conversation, then others
        rows += [(c, t, "user", f"same opening {t}") for t in range(9)]
        rows += [(c, 9 + t, "assistant", f"then {rng.randint(0, 2)}") for t in range(c % 3)]
    rows += [(200, t, "user", f"long {t % 7}") for t in range(700)] + [(201, t, "user", f"long {t % 7}") for t in range(650)]
    rows += [(13, None, None, None), (14, 0, None, "x"), (14, 0, None, "x"), (14, 0, "user", None), (None, 0, "user", "nobody"), (219, 0, "user", "alone"), (239, 0, "u", "a\x1cb é\n")]
    return rows


@pytest.mark.parametrize(("container", "graft", "segment"), [(1 << 14, True, 1 << 16), (40, True, 3), (1, False, 100)])
def test_trie_against_brute_force(spark, monkeypatch, container, graft, segment):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "PIECE", 30)
    rows = _conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("conv", "ids", "counts", "key", "up", "start", "depth", "sid")})
    got = trie.conversation_trie(df.repartition(3), graft=graft, container=container)
    assert sorted(map(tuple, got.collect()), key=str) == _trie(rows, graft)


def test_no_conversations_and_unknown_ones(spark):
    none = spark.createDataFrame([(None, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    assert trie.conversation_trie(none.filter("false"), graft=True).count() == 0
    assert trie.conversation_trie(none, graft=True).count() == 0


def test_trie_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, QUERIES["op11_trie"](spark, SF_SMALL).collect()), key=str) == _trie(rows, True)


# ---- operator 12


def _ranked(docs, items, k):
    texts = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in texts), sum(n for _, _, n in texts)
    df = Counter(t for _, c, _ in texts for t in c)
    out = []
    for item in sorted({i for i, _ in items if i is not None}):
        asked = {t for i, x in items if i == item for t in _terms(x)}
        scores = []
        for i, c, n in texts:
            score = 0
            for t in asked & set(c):
                m = 100 - 50 + (50 * n * n_docs) // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k])]
    return out


ITEMS = [(1, "a b c words"), (2, "Two WORDS\x1c don't ý \U0001f600"), (3, None), (4, ""), (5, "nowhere zzzz"), (6, "one"), (6, "endoftext one"), (None, "a b"), (7, "janto85 bri7 a")]


@pytest.mark.parametrize(("shard", "visit", "k"), [(2_000_000, 8, 50), (100, 1, 3), (3000, 2, 5)])
def test_lexical_against_brute_force(spark, monkeypatch, shard, visit, k):
    monkeypatch.setattr(lexical, "SHARD_TERMS", shard)
    monkeypatch.setattr(lexical, "VISIT", visit)
    monkeypatch.setattr(terms, "BLOCK_BYTES", 150)
    rows = [(r[0], r[1]) for r in odd_rows()]
    rng = random.Random(9)
    rows += [(1000 + i, " ".join(rng.choice("a b c words one two endoftext x y z".split()) for _ in range(rng.choice((1, 1, 4, 9, 40))))) for i in range(300)]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(map(tuple, lexical.rank_documents(docs.repartition(4), items, k).collect()))
    assert got == _ranked(rows, ITEMS, k)


def test_strata_are_passed_over():
    """A stratum whose bound is below the k-th best score is not visited."""
    rng = random.Random(1)
    docs = [f"rare rare common{j}" if j < 60 else " ".join(["common0"] + ["other"] * rng.randint(1, 200)) for j in range(2000)]
    numbers = {}
    found = [np.array([numbers.setdefault(t, len(numbers)) for t in terms.terms_of(d.encode())]) for d in docs]
    n_terms = sum(map(len, found))
    names = [f.split()[0] for f in lexical.SHARD.split(", ")] + ["cells"]
    shard = dict(zip(names, lexical.build_shard(list(range(len(docs))), found, list(numbers), len(docs), n_terms)))
    strata = len({50 + 50 * len(f) * len(docs) // n_terms for f in found})
    best = [lexical.Best(5)]
    visits = lexical.search_shard(shard, {b"rare": 0, b"common0": 1}, np.array([5000, 10]), [np.array([0, 1])], best)
    assert len(best[0].ids) == 5 and strata > 100 and visits <= lexical.VISIT


def test_lexical_of_nothing(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.rank_documents(no_docs(spark), items).count() == 0
    assert lexical.rank_documents(odd_docs(spark), items.limit(0)).count() == 0
    assert lexical.rank_documents(odd_docs(spark).filter("text IS NULL"), items).count() == 0


def test_lexical_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(map(tuple, QUERIES["op12_lexical"](spark, SF_SMALL).collect())) == _ranked(docs, items, 50)


# ---- operator 13


def _hits(docs, items, window):
    """Of each document: words, hit words, items (as sorted strings)."""
    found = defaultdict(set)
    for i, t in items:
        x = _terms(t)
        m = min(window, len(x))
        for j in range(len(x) - m + 1 if x and i is not None else 0):
            found[tuple(x[j:j + m])].add(str(i))
    sizes = {len(w) for w in found}
    out = []
    for i, t in docs:
        x, hit, of = _terms(t), set(), set()
        for m in sizes:
            for j in range(len(x) - m + 1):
                if tuple(x[j:j + m]) in found:
                    hit.update(range(j, j + m))
                    of |= found[tuple(x[j:j + m])]
        out.append((i, len(x), tuple(sorted(hit)), tuple(sorted(of))))
    return out


def _leaky():
    rng = random.Random(5)
    word = lambda: rng.choice("red green blue black Été WHITE grey".split())
    items = [(i, " ".join(word() for _ in range(rng.choice((0, 1, 2, 5, 10, 11, 40))))) for i in range(12)] + [(50, None), (51, ", ; -"), (None, "one two"), (3, "Two words x"), (60, "one")]
    docs = [(r[0], r[1]) for r in odd_rows()]
    for i in range(80):
        text = " ".join(word() for _ in range(rng.choice((0, 3, 30, 200))))
        docs.append((100 + i, text + ", " + (rng.choice(items)[1] or "").upper() + "\n" + text[:50] if i % 3 else text))
    return docs, items


@pytest.mark.parametrize(("shard", "block", "window"), [(4_000_000, 4 << 20, 10), (200, 100, 10), (1, 1, 3), (1000, 1 << 20, 1)])
def test_contamination_against_brute_force(spark, monkeypatch, shard, block, window):
    monkeypatch.setattr(contamination, "SHARD_WORDS", shard)
    monkeypatch.setattr(terms, "BLOCK_BYTES", block)
    docs, items = _leaky()
    items = items[:6] + items[12:] if block < 1000 else items  # a pass each
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("mine"))).repartition(3)
    of = spark.createDataFrame(items, "item_id long, text string")
    got = contamination.contaminated(df, of, window=window)
    rows = [(r["row"]["doc_id"], r["n_words"], tuple(p for s in r["spans"] for p in range(s["start"], s["end"])), tuple(r["items"])) for r in got.collect()]
    want = _hits(docs, items, window)
    assert Counter(rows) == Counter(want)
    clean = contamination.remove_contaminated(df, of, window=window)
    assert clean.columns == df.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, _, hit, _ in want if not hit)


def test_longest_matches(spark, monkeypatch):
    monkeypatch.setattr(contamination, "SHARD_WORDS", 300)
    docs, items = _leaky()
    df, of = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["item_id"], r["item_start"]): (r["n_words"], r["doc_id"], r["doc_start"]) for r in contamination.longest_matches(df.repartition(3), of, window=10).collect() if r["item_id"] != "3"}
    want, texts = {}, [(i, _terms(t)) for i, t in docs if i is not None]
    for i, t in items:
        x = _terms(t)
        need = min(10, len(x))
        for j in range(len(x) - need + 1 if x and i is not None and i != 3 else 0):
            best = []
            for d, y in texts:
                for p in [p for p, w in enumerate(y) if w == x[j]]:
                    n = 0
                    while j + n < len(x) and p + n < len(y) and x[j + n] == y[p + n]:
                        n += 1
                    best.append((-n, d, p))
            if best and -min(best)[0] >= need:
                want[(str(i), j)] = (-min(best)[0], *min(best)[1:])
    assert got == want


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(1)
    for _ in range(50):
        text = np.r_[rng.integers(0, 3, rng.integers(0, 200)), 0].astype(np.int32)

        def tail(p, text=text):
            return text[p:p + 1 + int(np.argmax(text[p:] == 0))][:8].tolist()

        order = contamination.suffix_array(text, 8)
        assert sorted(order.tolist()) == np.flatnonzero(text > 0).tolist()
        tails = [tail(p) for p in order]
        assert tails == sorted(tails)


def test_nothing_to_decontaminate(spark):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert contamination.contaminated(no_docs(spark), items).count() == 0
    assert {(len(r["spans"]), len(r["items"])) for r in contamination.contaminated(odd_docs(spark), items.limit(0)).collect()} <= {(0, 0)}
    assert contamination.longest_matches(odd_docs(spark), items.limit(0)).count() == 0


def test_decontamination_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(i, n, len(hit), len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), bool(hit)) for i, n, hit, of in _hits(docs, items, 10)]
    assert Counter(map(tuple, QUERIES["op13_decontamination"](spark, SF_SMALL).collect())) == Counter(want)


def test_terms_are_the_contract_s_words():
    text = "Ab9-é\x00ß_Z[\x7fx`{日本 Ünderİ\x1f"
    assert [t.decode() for t in terms.terms_of(text.encode())] == _terms(text)
    assert terms.texts(pa.array(["é", None, ""])) == ["é".encode(), None, b""]
