"""Mixing sources to target weights by temperature.

Token shares ``p`` of the sources are raised to an exponent, ``w ~ p ** a``.  ``a`` is bisected in [0, 1] to the
largest value whose weights reach the target entropy, then raised, if need be, to the smallest that repeats no
source more often than the limit allows.  The weights become token budgets, and each budget is met by passes
over permuted blocks of its source: whole passes, then a last one that stops within one document of the budget.

Everything is DataFrame work.  Only two sums over the sources come to the driver, ten times; the table of
sources itself stays distributed.  Hashes are md5, so that any SQL engine can repeat the permutations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm._common import cut, native_words

BUDGET = None  # tokens to deal out; None: as many as the documents have
ENTROPY = 0.98  # target entropy as a share of the entropy of equal weights
REPEATS = 4.0  # no source is dealt more than so many times its tokens (unless the budget alone asks for more)
BLOCK_TOKENS = 100_000  # tokens of a block, about
SEED = 17
GRID_BITS, GRIDS = 5, 10  # bisection steps settled by one job, and jobs
BROADCAST_BYTES = 8 << 20  # a table of sources up to this measured size is broadcast
SALTS = 64
ORDER_BUCKETS = 256  # a permutation is cut into so many runs for its running sums


def md5_long(*parts: Column) -> Column:
    """The first 15 hex digits of the md5 of the parts joined by ``|`` (null: empty), as a long."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def count_tokens(text: Column) -> Column:
    """Words of a text: the token count where no tokenizer is asked for."""
    return F.size(native_words(text)).cast("long")


def _exponent(sources: DataFrame, entropy: float, repeats: float, scale: float) -> float:
    """``sources``: column p. ``scale``: budget by tokens there are."""
    p = F.col("p")
    stats = sources.agg(F.count(F.lit(1)).alias("n"), F.min("p").alias("least")).first()
    if stats["n"] < 2:
        return 1.0
    target = entropy * math.log(stats["n"])

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        cols = []
        for i, a in enumerate(exponents):
            power = F.pow(p, F.lit(a))
            cols += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(p)).alias(f"l{i}")]
        got = sources.agg(*cols).first()
        return [(got[f"z{i}"], got[f"l{i}"]) for i in range(len(exponents))]

    def bisect(low_side) -> float:
        """The end of [0, 1] halved 50 times; ``low_side(a, z, l)``: the sought exponent is above ``a``."""
        lo, hi = 0.0, 1.0
        for _ in range(GRIDS):
            step = (hi - lo) / (1 << GRID_BITS)
            grid = [lo + step * k for k in range(1, 1 << GRID_BITS)]
            above = [low_side(a, z, l) for a, (z, l) in zip(grid, sums(grid))]
            k = above.index(False) if False in above else len(above)
            lo, hi = lo + step * k, lo + step * (k + 1)
        return lo

    (z, l), = sums([1.0])
    exponent = 1.0
    if math.log(z) - l / z < target:  # entropy falls as the exponent grows
        exponent = bisect(lambda a, z, l: math.log(z) - a * l / z >= target)
    least = stats["least"]
    (z, _), = sums([exponent])
    if scale * least ** (exponent - 1) / z > repeats:  # the smallest source is repeated most
        exponent = max(exponent, bisect(lambda a, z, l: scale * least ** (a - 1) / z > repeats))
    return exponent


def _running(df: DataFrame, group: list[str], key: str, tie: str, value: str, to: str) -> DataFrame:
    """``to``: the sum of ``value`` over the rows of the group before this one in order of ``key``, ``tie``.

    ``key`` is a 60-bit hash; its upper part deals the group over ORDER_BUCKETS runs, whose sums come first, so
    that no task holds the rows of a whole group.
    """
    dealt = df.withColumn("_run", F.shiftright(key, 60 - int(math.log2(ORDER_BUCKETS))).cast("int"))
    before = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, "_run").orderBy(key, tie).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = dealt.groupBy(*group, "_run").agg(F.sum(value).alias("_sum"))
    runs = runs.withColumn("_before", F.coalesce(F.sum("_sum").over(before), zero)).drop("_sum")
    inner = dealt.withColumn("_inside", F.coalesce(F.sum(value).over(inside), zero))
    return inner.join(runs, [*group, "_run"]).withColumn(to, F.col("_before") + F.col("_inside")).drop("_run", "_before", "_inside")


def _with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with their source's row of ``plan``.  The plan is broadcast if its measured size allows; else both sides are
    salted, so that a source that holds a third of the rows is met by SALTS tasks."""
    n, chars = plan.agg(F.count(F.lit(1)), F.sum(F.coalesce(F.length("s.source"), F.lit(0)))).first()
    if 64 * n + 4 * (chars or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(plan), "s")
    salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("id", "text_key"), F.lit(SALTS)).cast("int")).join(salted, ["s", "_salt"]).drop("_salt")


def schedule(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             tokens: Column | None = None, budget: int | None = BUDGET, entropy: float = ENTROPY, repeats: float = REPEATS,
             block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per document and pass that the mixture holds.

    ``id``, ``text_key`` (md5 of the text), ``source``, ``n_tokens``, ``epoch`` (pass, from 0), ``block``,
    ``place`` (0 to 1: where the block starts in its source's share of the stream; sorting by it interleaves the
    sources), ``turn`` (order within the block), ``have`` (rows of that id, text and source in the input) and
    ``times`` (rows in this pass).  Rows that repeat an id, text and source are one document with a
    multiplicity.  Null sources are a source; null and empty texts have no tokens and cost nothing.  An empty
    table, or one without any token, gives no rows.
    """
    n = count_tokens(F.col(text_col).cast("string")) if tokens is None else tokens.cast("long")
    rows = docs.select(F.struct(F.col(source_col).alias("source")).alias("s"), F.col(id_col).alias("id"),
                       F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"), n.alias("n"))
    rows = cut(rows.groupBy("s", "id", "text_key", "n").agg(F.count(F.lit(1)).alias("have")))
    sources = cut(rows.groupBy("s").agg(F.sum(F.col("n") * F.col("have")).alias("t")).filter("t > 0"))
    total = sources.agg(F.sum("t")).first()[0]
    if not total:
        return rows.select("id", "text_key", "s.source", F.col("n").alias("n_tokens"), F.lit(0).cast("long").alias("epoch"),
                           F.lit(0).cast("long").alias("block"), F.lit(0.0).alias("place"), F.lit(0).cast("long").alias("turn"),
                           "have", "have").toDF("id", "text_key", "source", "n_tokens", "epoch", "block", "place", "turn", "have", "times").filter("false")
    wanted = total if budget is None else int(budget)
    shares = sources.withColumn("p", F.col("t") / F.lit(total))
    exponent = _exponent(shares, entropy, repeats, wanted / total)
    z = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0]
    plan = shares.select("s", "t", F.round(F.lit(wanted) * F.pow("p", F.lit(exponent)) / F.lit(z)).cast("long").alias("b"),
                         F.ceil(F.col("t") / F.lit(block_tokens)).cast("long").alias("n_blocks"))
    plan = plan.withColumn("whole", F.floor(F.col("b") / F.col("t")).cast("long")).withColumn("rest", F.col("b") - F.col("whole") * F.col("t"))
    plan = cut(plan)

    dealt = _with_plan(rows, plan.select("s", "n_blocks")).withColumn(
        "block", F.pmod(md5_long(F.lit("block"), F.lit(seed), F.col("id"), F.col("text_key")), F.col("n_blocks"))).drop("n_blocks")
    blocks = cut(dealt.groupBy("s", "block").agg(F.sum(F.col("n") * F.col("have")).alias("size")))
    passes = blocks.join(plan.select("s", "t", "b", "whole", "rest"), "s").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    passes = passes.withColumn("key", md5_long(F.lit("pass"), F.lit(seed), F.col("epoch"), F.col("s.source"), F.col("block")))
    passes = _running(passes, ["s", "epoch"], "key", "block", "size", "before")
    room = F.when(F.col("epoch") < F.col("whole"), F.col("t")).otherwise(F.col("rest")) - F.col("before")
    place = F.round((F.col("epoch") * F.col("t") + F.col("before")) / F.col("b"), 9)
    passes = cut(passes.withColumn("room", room).filter("room > 0").select(
        "s", "block", "epoch", "room", (F.col("size") > F.col("room")).alias("last"), place.alias("place")))

    turn = md5_long(F.lit("turn"), F.lit(seed), F.col("epoch"), F.col("id"), F.col("text_key"))
    all_rows = dealt.join(passes, ["s", "block"]).withColumn("turn", turn)
    full = all_rows.filter("NOT last").withColumn("times", F.col("have"))
    # the block in which a budget ends: documents in turn until it is met, the last one partly over
    ends = _running(all_rows.filter("last").withColumn("all", F.col("n") * F.col("have")), ["s", "block", "epoch"], "turn", "text_key", "all", "start")
    left = F.col("room") - F.col("start")
    ends = ends.filter(left > 0).withColumn("times", F.when(F.col("n") == 0, F.col("have")).otherwise(
        F.least(F.col("have"), F.ceil(left / F.col("n")).cast("long")))).drop("all", "start")
    out = full.unionByName(ends)
    return out.select("id", "text_key", "s.source", F.col("n").alias("n_tokens"), "epoch", "block", "place", "turn", "have", "times")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings) -> DataFrame:
    """The rows of ``docs`` as often as the schedule holds them; rows it does not hold are absent."""
    planned = schedule(docs, id_col, text_col, source_col, **settings)
    counts = planned.groupBy("id", "text_key", "source", "have").agg(F.sum("times").cast("int").alias("times"))
    counts = cut(counts.select(F.col("id").alias("_id"), F.col("text_key").alias("_k"), F.col("source").alias("_s"), F.col("have").alias("_have"), "times"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"),
                       F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key"), F.col(f"`{source_col}`").alias("source"))

    def on(some: DataFrame):
        return rows["id"].eqNullSafe(some["_id"]) & (rows["key"] == some["_k"]) & rows["source"].eqNullSafe(some["_s"])

    once = counts.filter("_have = 1")
    one = rows.join(once, on(once)).select("row", "times")
    # rows that repeat wholly are one document: one of them stands for all, as often as the schedule says
    more = counts.filter("_have > 1")
    same = rows.join(more, on(more)).dropDuplicates(["id", "key", "source"]).select("row", "times")
    out = one.union(same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns])
