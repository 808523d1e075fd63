"""Quality rules by weak supervision: rules vote or abstain, EM estimates their accuracies, the posterior decides.

A document is good, or bad of one kind per rule (the one that minds it most).  Each class has for each rule the rates at
which it votes bad, abstains or votes good; EM re-estimates all of them from the patterns of votes, with
pseudo-documents in proportion to the table as priors, so that results do not depend on its size.  What a rule's
bad vote is worth follows from its rates: a rule that minds few of the documents that all others call good keeps
its word against them, one that minds many of them (the priors set that at about a twenty-fifth) is outvoted,
until they are so many (a fifth) that they are a kind of their own; two bad votes, or one where others abstain, stand.

Everything that reads documents is DataFrame expressions.  Features are array functions inside the row (no
explode, no shuffle of words); EM runs over the table of vote patterns with their counts of distinct texts, at most
``3 ** len(RULES)`` rows however many documents there are.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.llm._common import scratch_path

BASE_WORDS = 50  # base rule: fewer words fail
BASE_REPEATED = 50  # base rule: more than so many hundredths of the words in repeated windows fail
EM_ROUNDS = 30
GOOD = 0.75  # prior probability of a good document; the kinds share the rest
STRENGTH = 3.0  # pseudo-documents of all classes together for each distinct text
VOTES = (-1, 0, 1)
#: Prior rates of a bad vote, an abstention and a good vote: of any rule on good documents, of a rule on its own kind, and on another.
ON_GOOD, ON_OWN, ON_OTHER = (0.001, 0.299, 0.7), (0.9, 0.05, 0.05), (0.1, 0.4, 0.5)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, abstains otherwise (or where either is null)."""

    name: str
    bad: str
    good: str


#: Ratios are of long counts; texts without words leave the rules without a good vote.
RULES = (
    Rule("symbols", "20 * n_symbols > n_words", "50 * n_symbols <= n_words AND n_words > 0"),
    Rule("symbol_share", "100 * n_symbols > 15 * word_chars", "100 * n_symbols <= 2 * word_chars AND n_words > 0"),
    Rule("duplicate_lines", "2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines AND n_lines > 0"),
    Rule("repeated_windows", "100 * n_repeat_words > 40 * n_words", "20 * n_repeat_words <= n_words AND n_words > 0"),
    Rule("capitals", "10 * n_capitals > 3 * word_chars", "100 * n_capitals <= 15 * word_chars AND n_words > 0"),
    Rule("exclamations", "10 * n_exclamations > n_words", "100 * n_exclamations <= 3 * n_words AND n_words > 0"),
    Rule("word_length", "2 * word_chars < 5 * n_words OR word_chars > 14 * n_words",
         "word_chars BETWEEN 3 * n_words AND 12 * n_words AND n_words > 0"),
)

SPACE = "[ \\t-\\r]"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: str, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def features(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its columns ``keep``), ``text_key`` (md5) and the counts of its text; a null text counts as empty.

    n_words, word_chars (code points in words), n_symbols (``[#*$%&|<>]``), n_lines (lines with a word),
    n_dup_lines (of these, equal to an earlier one), n_repeat_words (words in 3-word windows found twice or more
    in the text; windows are compared by 64-bit hashes), n_capitals (A-Z), n_exclamations.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), text.alias("t"))
    d = d.select("row", "t", F.array_remove(F.split("t", SPACE + "+"), "").alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"))
    hashes = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3),
                                                  lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))))
    d = d.select(
        "row", F.unhex(F.md5("t")).alias("text_key"), F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _without("t", "[#*$%&|<>]+").alias("n_symbols"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _without("t", "[A-Z]+").alias("n_capitals"), _without("t", "!+").alias("n_exclamations"), hashes.alias("h"))
    # windows with their places in order of the hash; only for texts in which some window is found again
    d = d.withColumn("p", F.when(F.size(F.array_distinct("h")) < F.size("h"),
                                 F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("p", lambda x, i: (F.get("p", i - 1)["h"] == x["h"]) | F.coalesce(F.get("p", i + 1)["h"] == x["h"], F.lit(False)))
    d = d.drop("h").withColumn("at", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("p")
    # a window covers three words, fewer where the next one starts inside it
    cover = F.transform("at", lambda g, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - g, F.lit(3))).cast("long"))
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long"))).drop("at")


def votes(counted: DataFrame) -> DataFrame:
    """Adds ``v_<rule>``: 1 good, -1 bad, 0 abstains."""
    return counted.withColumns({f"v_{r.name}": F.when(F.expr(r.bad), -1).when(F.expr(r.good), 1).otherwise(0) for r in RULES})


Pattern = tuple[int, ...]  # the votes of the rules, in order


class Kinds:
    """Good documents (class 0) and one kind of bad documents per rule, with the rates of each rule's votes in each class.

    ``rates[class][rule]``: of a bad vote, an abstention, a good vote.  The classes' own probabilities are settings
    (``GOOD``); what EM learns is how far each rule can be trusted.
    """

    def __init__(self, rates: list[list[tuple[float, ...]]]):
        self.rates = rates

    @staticmethod
    def weight(k: int) -> float:
        return (1 - GOOD) / len(RULES) if k else GOOD

    @classmethod
    def start(cls) -> Kinds:
        n = len(RULES)
        return cls([[ON_GOOD] * n] + [[ON_OWN if j == k else ON_OTHER for j in range(n)] for k in range(n)])

    def shares(self, votes: Pattern) -> list[float]:
        """P(class | votes), the good one first."""
        odds = [math.log(self.weight(k)) + sum(math.log(r[v + 1]) for r, v in zip(rates, votes)) for k, rates in enumerate(self.rates)]
        most = max(odds)
        of = [math.exp(x - most) for x in odds]
        return [x / sum(of) for x in of]

    def update(self, counts: dict[Pattern, int]) -> Kinds:
        """One round of EM: each class's rates over the documents it is given and its pseudo-documents, which vote as at the start."""
        first, n = Kinds.start(), sum(counts.values())
        of = {votes: self.shares(votes) for votes in counts}
        out = []
        for k, prior in enumerate(first.rates):
            pseudo = STRENGTH * self.weight(k) * n
            size = math.fsum(c * of[v][k] for v, c in counts.items())
            out.append([tuple((math.fsum(c * of[v][k] for v, c in counts.items() if v[j] == vote) + pseudo * p) / (size + pseudo)
                              for vote, p in zip(VOTES, rates)) for j, rates in enumerate(prior)])
        return Kinds(out)

    def probability(self) -> Column:
        """P(good | votes): looked up, one value for each of the 3 ** len(RULES) patterns."""
        table = F.array(*[F.lit(self.shares(v[::-1])[0]) for v in itertools.product(VOTES, repeat=len(RULES))])
        return F.get(table, sum(((F.col(f"v_{r.name}") + 1) * 3 ** j for j, r in enumerate(RULES)), F.lit(0)))


def estimate(voted: DataFrame, rounds: int = EM_ROUNDS) -> Kinds:
    """EM over the vote patterns of distinct texts (two aggregations; at most 3 ** len(RULES) rows come to the driver), so
    copies move no verdict."""
    names = [f"v_{r.name}" for r in RULES]
    patterns = voted.groupBy("text_key").agg(*[F.min(name).alias(name) for name in names]).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    counts = {tuple(r[name] for name in names): r["n"] for r in patterns.collect()}
    kinds = Kinds.start()
    for _ in range(rounds if counts else 0):
        kinds = kinds.update(counts)
    return kinds


def assess(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input row as a struct, or its columns ``keep``, whatever they are called), the counts, ``probability``
    that the document is good, ``base_failed`` and ``kept``.

    The counted rows are written once to a scratch table in the shared folder; EM reads only its votes.  Rows
    that repeat are judged alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "quality")
    votes(features(docs, text_col, keep)).write.parquet(path)
    voted = spark.read.parquet(path)
    kinds = estimate(voted)
    failed = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_REPEATED * F.col("n_words"))
    out = voted.select("row", *COUNTS, failed.alias("base_failed"), kinds.probability().alias("probability"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= 0.5))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, as they were."""
    return assess(docs, text_col).filter("kept").select("row.*")
