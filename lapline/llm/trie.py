"""Prefix trie of conversations, built as burst tries.

A turn is 16 bytes of a hash of its role and text; a conversation is the string of its turns.  Equal conversations are one
*suffix* with a count.  All suffixes start in one container under the root.  A container with more than ``CONTAINER``
turns bursts: its head runs down the turns that all its suffixes share, and there each next turn id gets a container of its
own.  Only what has burst is looked at again, so a first turn that a third of all conversations have is split
further while the rest is done.  The remaining containers, sorted, are swept into nodes shard by shard; the heads
then take their sums from the containers below them, the last burst first.

Conversations are cut into turns by a range sort, so neither the numbering of turns nor their texts meet in one task;
from then on a conversation is one row of 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapline.llm import tokens
from lapline.llm._common import arrow_batches, cut, shuffle_partitions

CONTAINER = 1 << 14  # turns of a container; larger ones burst if they hold more than one suffix
SEGMENT = 1 << 16  # turns of a row while conversations are put together
PIECE = 1 << 16  # bytes of a piece of a list of conversations
GRAFT, FAMILY = 4, 20  # a conversation takes fewer than GRAFT turns of the first one of its FAMILY ids
ID, COUNT = 16, 4  # bytes of a turn's id and of its word count

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, sid binary, up binary"
NAMES = [f.split()[0] for f in NODE.split(", ")]


def turn_id(role: bytes, text: bytes) -> bytes:
    return hashlib.sha256(b"%d:" % len(role) + role + text).digest()[:ID]


def _turns(binary: Column, width: int = ID) -> Column:
    return (F.length(binary) / width).cast("long")


def _part(binary: Column, first, n=None, width: int = ID) -> Column:
    """``n`` turns (all others, if none is given) of packed turns from the ``first`` on."""
    first = F.lit(first) if isinstance(first, int) else first
    length = F.length(binary) if n is None else (F.lit(n) if isinstance(n, int) else n) * width
    return F.substring(binary, (first * width + 1).cast("int"), length.cast("int"))


def _joined(pieces: Column, field: str) -> Column:
    return F.aggregate(pieces, F.lit(bytearray()), lambda a, x: F.concat(a, x[field]))


def packed(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv``, ``start``, ``ids``, ``counts``: runs of turns of each conversation in order, packed; ``start`` counts turns.

    Turns go by turn (null first), then role and text; null roles and texts are empty.  Rows without a
    conversation id take no part.
    """
    spark = conversations.sparkSession
    arrow_batches(spark)
    c = {name: F.col(f"`{name}`") for name in (conv_col, turn_col, role_col, text_col)}
    rows = conversations.select(c[conv_col].cast("long").alias("conv"), c[turn_col].cast("long").alias("turn"), *[
        F.coalesce(c[x].cast("string"), F.lit("")).alias(y) for x, y in ((role_col, "role"), (text_col, "text"))]).filter("conv IS NOT NULL")
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        part, done, now, ids, counts = TaskContext.get().partitionId(), 0, None, [], []
        out: list[tuple] = []

        def close():
            nonlocal done, ids, counts
            if ids:
                out.append((now, part, done, b"".join(ids), np.array(counts, "<i4").tobytes()))
                done, ids, counts = done + 1, [], []

        def rows_out():
            made = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                                              names=["conv", "part", "run", "ids", "counts"])
            out.clear()
            return made

        for batch in batches:
            convs, roles, said = batch.column(0).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist()
            for conv, role, text in zip(convs, roles, said):
                if conv != now or len(ids) >= SEGMENT:
                    close()
                    now = conv
                ids.append(turn_id(role, text))
                counts.append(len(text.split()))
            if len(out) >= 1000:
                yield rows_out()
        close()
        if out:
            yield rows_out()

    runs = cut(rows.mapInArrow(pack, "conv long, part int, run long, ids binary, counts binary"))
    before = Window.partitionBy("conv").orderBy("part", "run").rowsBetween(Window.unboundedPreceding, -1)
    sizes = runs.select("conv", "part", "run", _turns(F.col("ids")).alias("k"))
    starts = sizes.withColumn("start", F.coalesce(F.sum("k").over(before), F.lit(0).cast("long"))).drop("k")
    return runs.join(starts, ["conv", "part", "run"]).select("conv", "start", "ids", "counts")


def grafted(runs: DataFrame) -> DataFrame:
    """``conv``, ``ids``, ``counts``: each conversation c rebuilt from the first h turns of conversation c - c % FAMILY (all if fewer,
    none if it is absent) and its own turns after its first h; h = crc32 of c in decimals % GRAFT."""
    first = runs.filter((F.col("start") < GRAFT - 1) & (F.col("conv") % FAMILY == 0))
    first = first.select(F.col("conv").alias("family"), F.explode(F.sequence(F.lit(0), F.lit(GRAFT - 2))).alias("i"), "start", "ids", "counts")
    first = first.filter((F.col("i") < _turns(F.col("ids"))) & (F.col("start") + F.col("i") < GRAFT - 1)).select(
        "family", (F.col("start") + F.col("i")).alias("at"), _part(F.col("ids"), F.col("i"), 1).alias("ids"),
        _part(F.col("counts"), F.col("i"), 1, COUNT).alias("counts"))
    first = first.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("at", "ids", "counts"))).alias("lent"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % GRAFT).cast("int")
    skip = F.greatest(h - F.col("start"), F.lit(0))
    own = runs.select("conv", "start", _part(F.col("ids"), skip).alias("ids"), _part(F.col("counts"), skip, None, COUNT).alias("counts"))
    own = own.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("start", "ids", "counts"))).alias("own"))
    both = own.join(first.withColumnRenamed("family", "lender"), F.col("conv") - F.col("conv") % FAMILY == F.col("lender"), "left")
    lent = F.filter(F.coalesce("lent", F.array().cast(first.schema["lent"].dataType)), lambda x: x["at"] < h)

    return both.select("conv", *[F.concat(_joined(lent, f), _joined(F.col("own"), f)).alias(f) for f in ("ids", "counts")])


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv``, ``ids``, ``counts`` of the conversations as they are (a column frame as :func:`packed` returns)."""
    whole = conversations.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("start", "ids", "counts"))).alias("own"))
    return whole.select("conv", *[_joined(F.col("own"), f).alias(f) for f in ("ids", "counts")])


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two strings of turns begin with alike."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // ID
    other = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(other.argmax()) // ID


def swept(depth: int, above: int | None, up: bytes | None, suffixes: list[tuple[bytes, bytes, bytes, int, int]]) -> list[tuple]:
    """The nodes of a container: ``suffixes`` sorted (ids, counts, sid, conversations, smallest conversation), below a node at
    ``depth`` whose smallest conversation is ``above``; nodes without a parent here get ``up``."""
    parent, words, n, low, children, leaves, saved, sids, level = [], [], [], [], [], [], [], [], []
    path: list[int] = []
    last = b""
    for ids, counts, sid, many, conv in suffixes:
        same = _shared(last, ids)
        del path[same:]
        for w in np.frombuffer(counts, "<i4")[same:].tolist():
            parent.append(path[-1] if path else -1)
            path.append(len(words))
            level.append(depth + len(path))
            words.append(w)
        more = len(words) - len(n)
        for kept, zero in ((n, 0), (low, None), (children, 0), (leaves, 0), (saved, 0), (sids, None)):
            kept.extend([zero] * more)
        end = path[-1]
        n[end], low[end], sids[end] = many, conv, sid
        last = ids
    for i in range(len(words) - 1, -1, -1):  # children stand after their parents
        if not children[i]:
            leaves[i] = 1
        saved[i] += (n[i] - 1) * words[i]
        p = parent[i]
        if p >= 0:
            n[p] += n[i]
            low[p] = low[i] if low[p] is None else min(low[p], low[i])
            children[p] += 1
            leaves[p] += leaves[i]
            saved[p] += saved[i]
    return [(low[i], level[i], above if (p := parent[i]) < 0 else low[p], n[i], children[i], leaves[i], saved[i], sids[i], up if p < 0 else None)
            for i in range(len(words))]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary() if f.endswith("binary") else pa.int64() for f in NODE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=NAMES)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of container and suffix; holds one container at a time."""
    tokens.forget()
    now, held, out = None, [], []
    for batch in batches:
        for key, up, above, depth, ids, counts, sid, n, low in zip(*[c.to_pylist() for c in batch.columns]):
            if now is None or key != now[0]:
                if held:
                    out += swept(now[3], now[2], now[1], held)
                now, held = (key, up, above, depth), []
            held.append((ids, counts, sid, n, low))
            if len(out) >= 20_000:
                yield _batch(out)
                out = []
    if held:
        out += swept(now[3], now[2], now[1], held)
    for x in range(0, len(out), 20_000):
        yield _batch(out[x:x + 20_000])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of heads: the turns that all suffixes of a burst container share."""
    for batch in batches:
        out = []
        for up, above, depth, counts, low, n, sid, children, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
            words = np.frombuffer(counts, "<i4").tolist()
            for i in range(len(words) - 1, -1, -1):
                saved += (n - 1) * words[i]
                end, top = i == len(words) - 1, i == 0
                out.append((low, depth + i + 1, above if top else low, n, children if end else 1, leaves, saved, sid if end else None, up if top else None))
        if out:
            yield _batch(out)


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.schema.names.index("least"), batch.schema.names.index("most")
        shared = [_shared(x, y) for x, y in zip(batch.column(a).to_pylist(), batch.column(b).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared, pa.int64()), *batch.columns[3:]], names=["key", "shared", *batch.schema.names[3:]])


def prefix_trie(rebuilt: DataFrame, container: int = CONTAINER) -> DataFrame:
    """Nodes of the trie of ``rebuilt`` (``conv``, ``ids``, ``counts``): ``conv_id`` (smallest conversation through the node), ``depth``,
    ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``sid`` (of the
    conversations that end here, else null).

    Conversations without turns are members of the root.  An empty table gives no rows.
    """
    spark = rebuilt.sparkSession
    parts = shuffle_partitions(spark)
    sid = F.unhex(F.substring(F.sha2("ids", 256), 1, 2 * ID)).alias("sid")
    rows = rebuilt.select("conv", "ids", "counts", sid)
    rows = rows.groupBy("sid").agg(F.first("ids").alias("ids"), F.first("counts").alias("counts"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"))
    # the root is the node of a turn that all conversations have, at depth 0
    rows = cut(rows.select(F.lit(bytearray(ID)).alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(None).cast("long").alias("above"),
                           F.lit(-1).cast("long").alias("depth"), F.concat(F.lit(bytearray(ID)), "ids").alias("ids"),
                           F.concat(F.lit(bytearray(COUNT)), "counts").alias("counts"), "sid", "n", "low"))
    columns, done, heads, pending = rows.columns, [], [], rows
    while True:
        sizes = pending.groupBy("key").agg(F.sum(_turns(F.col("ids"))).alias("turns"), F.count(F.lit(1)).alias("suffixes"))
        over = cut(sizes.filter((F.col("turns") > container) & (F.col("suffixes") > 1)).select("key"))
        if over.isEmpty():
            done.append(pending)
            break
        done.append(pending.join(over, "key", "left_anti").select(*columns))
        large = pending.join(over, "key").select(*columns)
        facts = large.groupBy("key").agg(F.min("ids").alias("least"), F.max("ids").alias("most"), F.sum("n").alias("all"), F.min("low").alias("lowest"))
        facts = cut(facts.mapInArrow(_lengths, "key binary, shared long, all long, lowest long"))
        large = cut(large.join(facts, "key"))
        lead = large.groupBy("key").agg(F.min(F.struct("up", "above", "depth", "shared", "all", "lowest", _part(F.col("counts"), 0, F.col("shared"), COUNT).alias("path"))).alias("h"),
                                        F.max(F.when(_turns(F.col("ids")) == F.col("shared"), F.col("sid"))).alias("sid"))
        heads.append(cut(lead.select("key", "h.*", "sid")))
        longer = large.filter(_turns(F.col("ids")) > F.col("shared"))
        to = F.unhex(F.substring(F.sha2(F.concat("key", _part(F.col("ids"), 0, F.col("shared") + 1)), 256), 1, 2 * ID))
        pending = cut(longer.select(to.alias("key"), F.col("key").alias("up"), F.col("lowest").alias("above"), (F.col("depth") + F.col("shared")).alias("depth"),
                                    _part(F.col("ids"), F.col("shared")).alias("ids"), _part(F.col("counts"), F.col("shared"), None, COUNT).alias("counts"), "sid", "n", "low"))
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    nodes = cut(every.repartition(parts, "key").sortWithinPartitions("key", "ids").mapInArrow(_sweep, NODE))
    tops = nodes.filter("up IS NOT NULL").select("up", "n_leaves", "saved_tokens")
    for head in reversed(heads):
        below = tops.groupBy("up").agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")).withColumnRenamed("up", "key")
        made = cut(head.join(below, "key").select("up", "above", "depth", "path", "lowest", "all", "sid", "children", "leaves", "saved").mapInArrow(_paths, NODE))
        nodes = nodes.unionByName(made)
        tops = tops.unionByName(made.filter("up IS NOT NULL").select("up", "n_leaves", "saved_tokens"))
    return nodes.drop("up")


def ends(rebuilt: DataFrame) -> DataFrame:
    """``sid``, ``ends_sha256``: the digest of the ids of the conversations that are the same, ascending, joined by commas.

    Lists are cut into pieces where they lie after a range sort; the digest reads the pieces in order, so no list is held.
    """
    spark = rebuilt.sparkSession
    rows = rebuilt.select(F.unhex(F.substring(F.sha2("ids", 256), 1, 2 * ID)).alias("sid"), "conv")
    rows = rows.repartitionByRange(shuffle_partitions(spark), "sid", "conv").sortWithinPartitions("sid", "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, now, held, size = TaskContext.get().partitionId(), 0, None, [], 0
        out: list[tuple] = []

        def made():
            got = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int32(), pa.int64(), pa.string()))], names=["sid", "part", "run", "piece"])
            out.clear()
            return got

        for batch in batches:
            for sid, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (sid != now or size > PIECE):
                    out.append((now, part, run, ",".join(held)))
                    run, held, size = run + 1, [], 0
                now = sid
                held.append(str(conv))
                size += len(held[-1]) + 1
            if len(out) >= 1000:
                yield made()
        if held:
            out.append((now, part, run, ",".join(held)))
        if out:
            yield made()

    dealt = rows.mapInArrow(pieces, "sid binary, part int, run long, piece string")
    dealt = dealt.repartition(shuffle_partitions(spark), "sid").sortWithinPartitions("sid", "part", "run")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            out = []
            for sid, piece in zip(batch.column(0).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist()):
                if sid != now:
                    if sha is not None:
                        out.append((now, sha.hexdigest()))
                    now, sha = sid, hashlib.sha256(piece)
                else:
                    sha.update(b"," + piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.binary()), pa.array([d for _, d in out])], names=["sid", "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([sha.hexdigest()])], names=["sid", "ends_sha256"])

    return dealt.mapInArrow(digests, "sid binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                      graft: bool = False, container: int = CONTAINER) -> DataFrame:
    """The prefix trie of ``conversations``, a row a node: those of :func:`prefix_trie`, and ``ends_sha256`` (see :func:`ends`).

    With ``graft`` conversations are rebuilt first (:func:`grafted`).  See :func:`packed` for nulls and ties; rows that repeat are
    turns of their own; other columns play no part.
    """
    runs = packed(conversations, conv_col, turn_col, role_col, text_col)
    rebuilt = cut(grafted(runs) if graft else sequences(runs))
    nodes = prefix_trie(rebuilt, container).join(ends(rebuilt), "sid", "left")
    return nodes.select(*NAMES[:-2], F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
