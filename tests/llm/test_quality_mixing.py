"""Quality rules (operator 10) and mixing (operator 1) against plain Python."""

import hashlib
import math
import re
from collections import Counter

import pytest
from helpers import no_docs, odd_docs, odd_rows, prose, with_clashes, words
from pyspark.sql import functions as F

from lapline.llm import mixing, quality


RARE = {"symbols": lambda i: " ".join(w + "$%" for w in prose(i, 80).split()), "duplicate_lines": lambda i: (prose(i, 90) + "\n") + (prose(i + 1, 2) + "\n") * 4,
        "repeated_windows": lambda i: prose(i, 57) + (" " + prose(i + 1, 7)) * 6, "shouting": lambda i: prose(i, 80).upper(), "word_length": lambda i: prose(i, 80).replace(" ", "longerword ")}


def _counts(text):
    w = words(text)
    tri = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


EXTRA = ["a b c a b c", "a a a a", "x y x y x y z", "l1 a\nl1 a\n\n \nl1 a", "a\x0bb\x0cc", "A!! B!! C", "a b", "😀 é"]


def test_counts(spark):
    rows = odd_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(EXTRA)]
    docs = with_clashes(spark.createDataFrame(rows, odd_docs(spark).schema))
    got = quality.assess(docs).collect()
    assert len(got) == len(rows)
    want = Counter((r[0], *_counts(r[1])) for r in rows)
    assert Counter((r["row"]["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_plan_is_native(spark):
    plan = quality.votes(quality.features(odd_docs(spark)))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Generate", plan)


def _em(patterns):
    """The same estimate with plain loops. patterns: votes -> distinct texts. Gives P(good) of each."""
    n_rules, every = len(quality.RULES), sum(patterns.values())
    prior = [[dict(zip((-1, 0, 1), quality.ON_GOOD if k == 0 else quality.ON_OWN if j == k - 1 else quality.ON_OTHER)) for j in range(n_rules)] for k in range(n_rules + 1)]
    weight = [quality.GOOD] + [(1 - quality.GOOD) / n_rules] * n_rules
    rates = prior

    def posterior(votes):
        of = [w * math.prod(r[v] for r, v in zip(rates[k], votes)) for k, w in enumerate(weight)]
        return [x / sum(of) for x in of]

    for _ in range(quality.EM_ROUNDS):
        told = {votes: posterior(votes) for votes in patterns}
        rates = [[{v: (sum(c * told[p][k] for p, c in patterns.items() if p[j] == v) + quality.STRENGTH * weight[k] * every * prior[k][j][v])
                   / (sum(c * told[p][k] for p, c in patterns.items()) + quality.STRENGTH * weight[k] * every) for v in (-1, 0, 1)}
                  for j in range(n_rules)] for k in range(n_rules + 1)]
    return {votes: posterior(votes)[0] for votes in patterns}


def test_posterior_against_plain_python(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(9000 + i, RARE[k](9000 + 7 * i)) for i, k in enumerate(list(RARE) * 3)], "doc_id long, text string")
    docs = docs.unionByName(more).unionByName(more)  # copies count once
    voted = quality.votes(quality.features(docs))
    rows = {r["row"]["doc_id"]: (bytes(r["text_key"]), tuple(r[f"v_{x.name}"] for x in quality.RULES)) for r in voted.collect()}
    want = _em(Counter(v for _, v in set(rows.values())))
    got = quality.assess(docs).collect()
    assert len(want) > 5 and len(got) == docs.count()
    for r in got:
        assert r["probability"] == pytest.approx(want[rows[r["row"]["doc_id"]][1]], abs=1e-9)
        assert r["kept"] == (not r["base_failed"] and want[rows[r["row"]["doc_id"]][1]] >= 0.5)


def test_good_and_bad_documents(spark):
    rows = [(i, prose(i, 150), "good") for i in range(60)]
    rows += [(100 + i, " ".join(w + "$%" for w in prose(100 + i, 150).split()), "symbols") for i in range(10)]
    rows += [(200 + i, prose(200 + i, 30).upper() * 1 + " " + " ".join(w + "!!" for w in prose(300 + i, 120).upper().split()), "shouting") for i in range(10)]
    rows += [(400 + i, (prose(400 + i, 3) + " ") * 60, "repeats") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = Counter(r["kind"] for r in quality.keep_good(docs).collect())
    assert got == {"good": 60}
    assert quality.keep_good(with_clashes(no_docs(spark))).count() == 0
    assert quality.keep_good(with_clashes(docs)).columns == with_clashes(docs).columns


@pytest.mark.parametrize("kind", [*RARE, "all"])
@pytest.mark.parametrize("permille", [5, 10, 30])
def test_rare_bad_documents_of_one_rule(spark, kind, permille):
    clean = spark.createDataFrame([(i, "good", prose(i, 80)) for i in range(1000 - permille)], "id long, kind string, text string")
    clean = clean.union(spark.range(5000).select("id", F.lit("good"), F.lit(prose(1, 80))))  # copies change nothing
    kinds = list(RARE) if kind == "all" else [kind]
    bad = [(10_000 + 10 * i, kinds[i % len(kinds)], RARE[kinds[i % len(kinds)]](10_000 + 10 * i)) for i in range(permille)]
    got = quality.assess(clean.union(spark.createDataFrame(bad, "id long, kind string, text string")))
    rows = got.select("row.kind", "base_failed", "kept").distinct().collect()
    assert {(r["kind"], r["base_failed"], r["kept"]) for r in rows} == {("good", False, True)} | {(k, False, False) for k in kinds}


def _good_share(counts, votes):
    kinds = quality.Kinds.start()
    for _ in range(quality.EM_ROUNDS):
        kinds = kinds.update(counts)
    return kinds.shares(votes)[0]


CLEAN = (1,) * len(quality.RULES)
ALONE = [tuple(-1 if i == j else 1 for i in range(len(CLEAN))) for j in range(len(CLEAN))]


@pytest.mark.parametrize("n", [10_000, 10_000_000])
def test_a_rule_is_believed_as_far_as_it_can_be_trusted(n):
    for lone in ALONE:
        for permille, bad in ((0.5, True), (5, True), (10, True), (30, True), (50, False), (100, False)):
            m = round(n * permille / 1000)
            share = _good_share({CLEAN: n - m, lone: m}, lone)
            assert (share < 0.5) == bad, (lone, permille, share)
            assert _good_share({CLEAN: n - m, lone: m}, CLEAN) > 0.95
    rare = {lone: n // 100 for lone in ALONE}
    assert all(_good_share({CLEAN: n - sum(rare.values())} | rare, lone) < 0.5 for lone in ALONE)


@pytest.mark.parametrize("permille", [5, 50, 200])
def test_two_bad_votes_and_abstentions_stand(permille):
    n = 100_000
    m = n * permille // 1000
    for votes in ((-1, -1, *CLEAN[2:]), (1, -1, -1, *CLEAN[3:]), (-1, 0, 0, *CLEAN[3:])):
        assert _good_share({CLEAN: n - m, votes: m}, votes) < 0.5
    mild = (0, *CLEAN[1:])  # nobody minds it
    assert _good_share({CLEAN: n - m, mild: m}, mild) > 0.9


def test_false_alarms_are_outvoted(spark):
    """One rule minds 5 % of the documents, which every other rule calls good: they stay; 1 % of documents that two rules mind go."""
    rows = [(i, "good", prose(i, 80)) for i in range(940)]
    rows += [(2000 + i, "alarm", " ".join(w + "!" * (j % 9 == 0) for j, w in enumerate(prose(2000 + i, 80).split()))) for i in range(50)]
    rows += [(3000 + i, "bad", RARE["symbols"](3000 + i)) for i in range(10)]
    got = quality.assess(spark.createDataFrame(rows, "id long, kind string, text string"))
    assert {(r["kind"], r["kept"]) for r in got.select("row.kind", "kept").distinct().collect()} == {("good", True), ("alarm", True), ("bad", False)}


def _digest(*parts):
    return int(hashlib.md5("|".join("" if p is None else str(p) for p in parts).encode()).hexdigest()[:15], 16)


def _mixture(rows, entropy, repeats, budget, block_tokens, seed=mixing.SEED):
    """Brute force: (id, text_key, source, epoch) -> times."""
    docs = Counter((r[0], hashlib.md5((r[1] or "").encode()).hexdigest(), r[3], len(words(r[1]))) for r in rows)
    t = Counter()
    for (_, _, s, n), have in docs.items():
        t[s] += n * have
    t = {s: v for s, v in t.items() if v}
    total = sum(t.values())
    wanted = total if budget is None else budget
    p = {s: v / total for s, v in t.items()}

    def weights(a):
        z = sum(x ** a for x in p.values())
        return {s: x ** a / z for s, x in p.items()}

    def halve(below):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if below(mid) else (lo, mid)
        return lo

    ent = lambda a: -sum(w * math.log(w) for w in weights(a).values())
    most = lambda a: max(wanted * w / t[s] for s, w in weights(a).items())
    a = 1.0
    if len(p) > 1:
        if ent(1.0) < entropy * math.log(len(p)):
            a = halve(lambda x: ent(x) >= entropy * math.log(len(p)))
        if most(a) > repeats:
            a = max(a, halve(lambda x: most(x) > repeats))
    out = Counter()
    for s, w in weights(a).items():
        b = round(wanted * w)
        n_blocks = -(-t[s] // block_tokens)
        mine = [(i, k, n, have) for (i, k, x, n), have in docs.items() if x == s]
        blocks = {}
        for d in mine:
            blocks.setdefault(_digest("block", seed, d[0], d[1]) % n_blocks, []).append(d)
        left, epoch = b, 0
        while left > 0:
            order = sorted(blocks, key=lambda k: (_digest("pass", seed, epoch, s, k), k))
            for k in order:
                size = sum(n * have for _, _, n, have in blocks[k])
                if size <= left:
                    take = [(d, d[3]) for d in blocks[k]] if left > 0 else []
                    left_after = left - size
                else:
                    take, room = [], left
                    for d in sorted(blocks[k], key=lambda d: (_digest("turn", seed, epoch, d[0], d[1]), d[1])):
                        if room > 0:
                            take.append((d, d[3] if not d[2] else min(d[3], -(-room // d[2]))))
                            room -= d[2] * d[3]
                    left_after = 0
                for d, times in take:
                    out[(d[0], d[1], s, epoch)] += times
                left = left_after
                if left <= 0:
                    break
            epoch += 1
    return out


CASES = [(0.98, 4.0, None, 100), (0.999, 1.5, None, 40), (0.5, 4.0, None, 100_000), (0.98, 4.0, 700, 30), (0.999, 50.0, 9000, 60)]


def _sources():
    rows = [(i, prose(i, 5 + i % 40), "en", "big" if i % 3 else ("s1", "s2", None)[i // 3 % 3], 0) for i in range(150)]
    return rows + [(7, prose(7, 12), "en", "big", 0)] * 3 + [(900, None, "en", "big", 0), (901, "", "en", "empty", 0), (None, "a b c", "en", "s1", 0)]


@pytest.mark.parametrize("entropy,repeats,budget,block", CASES)
def test_schedule_against_brute_force(spark, entropy, repeats, budget, block):
    rows = _sources()
    docs = with_clashes(spark.createDataFrame(rows, odd_docs(spark).schema))
    got = mixing.schedule(docs, entropy=entropy, repeats=repeats, budget=budget, block_tokens=block).collect()
    assert Counter({(r["id"], r["text_key"], r["source"], r["epoch"]): r["times"] for r in got}) == _mixture(rows, entropy, repeats, budget, block)
    assert all(0 <= r["place"] <= 1 for r in got)


def test_salted_plan_gives_the_same_schedule(spark, monkeypatch):
    docs = odd_docs(spark)
    want = sorted(map(str, mixing.schedule(docs, block_tokens=50).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert sorted(map(str, mixing.schedule(docs, block_tokens=50).collect())) == want


def test_budgets_are_met_within_a_document(spark):
    from tests.conftest import SF_SMALL

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = mixing.schedule(docs, entropy=0.9999, block_tokens=500).groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("times")).alias("n"), F.max("n_tokens").alias("most")).collect()
    total = docs.select(F.sum(mixing.count_tokens(F.col("text")))).first()[0]
    mean = total / len(got)
    shares = [r["n"] / total for r in got]
    assert -sum(x * math.log(x) for x in shares) > 0.995 * math.log(len(got))
    assert abs(sum(r["n"] for r in got) - total) <= sum(r["most"] for r in got) and mean


def test_mixed_rows(spark):
    rows = _sources()
    docs = with_clashes(spark.createDataFrame(rows, odd_docs(spark).schema))
    got = mixing.mixed(docs, entropy=0.999, repeats=1.5, block_tokens=40)
    assert got.columns == docs.columns
    want = Counter()
    for (i, k, s, _), n in _mixture(rows, 0.999, 1.5, None, 40).items():
        want[(i, k, s)] += n
    found = Counter((r["doc_id"], hashlib.md5((r["text"] or "").encode()).hexdigest(), r["source"]) for r in got.collect())
    assert found == want
    assert mixing.mixed(no_docs(spark)).count() == 0
    assert mixing.schedule(spark.createDataFrame([(1, "", "en", "a", 0)], odd_docs(spark).schema)).count() == 0
