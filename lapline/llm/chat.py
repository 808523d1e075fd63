"""Chat formatting by columnar byte assembly.

A conversation becomes one string of turns::

    <turn>ROLE
    TEXT</turn>

Control strings begin with ``<``.  In roles and texts every ``<`` and every backslash gets a backslash before it (in
roles the line feed too), so no text can open or close a turn, and removing one backslash before
each such character gives the text back.

The bytes of a batch are laid out by numpy: segment lengths, their running sums as offsets, and scatter
indices; headers and contents are copied into one preallocated buffer, which is the Arrow column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapline.llm._common import arrow_batches

OPEN, CLOSE = b"<turn>", b"</turn>\n"
SLASH, LESS, LINE = 0x5C, 0x3C, 0x0A
LOSS_ROLE = "assistant"
KEY_CHARS = 32  # code points of a role or text in a range key
CHUNK_BYTES = 32 << 20  # a longer conversation goes on in further rows (chunk 1, 2, ...)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, special: np.ndarray, starts: np.ndarray) -> None:
    """Copy escaped rows to ``starts``: a byte goes to its place plus the specials before it, itself included."""
    if not len(data):
        return
    extra = np.cumsum(special)
    before = np.concatenate([[0], extra])[offsets[:-1]]
    sizes = np.diff(offsets)
    shift = np.repeat(starts - offsets[:-1] - before, sizes)
    to = np.arange(len(data)) + shift + extra
    out[to] = data
    out[to[special] - 1] = SLASH


def _is_special(data: np.ndarray, line: bool) -> np.ndarray:
    found = (data == SLASH) | (data == LESS)
    return found | (data == LINE) if line else found


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The formatted bytes of all turns in one buffer; per turn its end, and start and end of its text."""
    n = len(texts)
    role, role_at = _bytes_of(roles)
    text, text_at = _bytes_of(texts)
    role_special, text_special = _is_special(role, True), _is_special(text, False)
    many = lambda special, at: np.diff(np.concatenate([[0], np.cumsum(special)])[at])
    role_size = np.diff(role_at) + many(role_special, role_at)
    text_size = np.diff(text_at) + many(text_special, text_at)
    ends = np.cumsum(len(OPEN) + role_size + 1 + text_size + len(CLOSE))
    starts = np.concatenate([[0], ends[:-1]]) if n else np.zeros(0, np.int64)
    role_start = starts + len(OPEN)
    text_start = role_start + role_size + 1
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for i, b in enumerate(OPEN):
        out[starts + i] = b
    out[text_start - 1] = LINE
    for i, b in enumerate(CLOSE):
        out[text_start + text_size + i] = b
    _scatter(out, role, role_at, role_special, role_start)
    _scatter(out, text, text_at, text_special, text_start)
    return out, ends, text_start, text_start + text_size


def read_turns(data: bytes) -> list[tuple[str, str, int, int]]:
    """Turns (role, text, start and end of the escaped text in bytes) of formatted bytes."""
    raw = np.frombuffer(data, np.uint8)
    slash = raw == SLASH
    # a byte is escaped if an odd run of backslashes ends just before it
    at = np.arange(len(raw))
    last_other = np.maximum.accumulate(np.where(slash, -1, at)) if len(raw) else at
    run = np.where(slash, at - last_other, 0)
    escaped = np.concatenate([[False], run[:-1] % 2 == 1]) if len(raw) else slash
    keep = ~(slash & ~escaped)
    marks = np.flatnonzero((raw == LESS) & ~escaped)
    lines = np.flatnonzero((raw == LINE) & ~escaped)
    if len(marks) % 2:
        raise ValueError("a turn is not closed")
    out = []
    clean = lambda a, b: raw[a:b][keep[a:b]].tobytes().decode("utf-8", "surrogatepass")
    for a, b in zip(marks[::2].tolist(), marks[1::2].tolist()):
        if data[a:a + len(OPEN)] != OPEN or data[b:b + len(CLOSE)] != CLOSE:
            raise ValueError("not a turn")
        line = int(lines[np.searchsorted(lines, a)])
        out.append((clean(a + len(OPEN), line), clean(line + 1, b), line + 1, b))
    return out


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``conv``, ``part``, ``chunk``, ``formatted`` and ``loss`` (array of [start, end) code points of assistant texts as
    they stand in ``formatted``, escapes included).

    Turns are dealt by range over (conversation, turn, role, text), so a conversation of very many turns is formatted by
    several tasks: it goes on in rows of the next ``part``, and within a part in rows ``chunk`` 0, 1, ... once longer
    than ``chunk_bytes``, cut between turns; (part, chunk) puts its rows in order.  No task ever holds more than
    ``chunk_bytes`` and a batch.  Turns follow ``turn_col`` (null first), then role and text;
    repeated rows are turns of their own.  Null roles and texts are empty; null conversation ids are one
    conversation; other columns are not read; an empty table gives no rows.
    """
    arrow_batches(turns.sparkSession)
    kind = turns.schema[conv_col].dataType.simpleString()
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                        F.col(text_col).cast("string").alias("text"))
    rows = (rows.repartitionByRange(*_range_keys()).sortWithinPartitions("conv", "turn", "role", "text")
            .select("conv", "role", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: list[pa.RecordBatch] = []
        size, chunk, open_conv, part = 0, 0, None, TaskContext.get().partitionId()

        def closed(some: pa.Table, first_chunk: int) -> pa.RecordBatch:
            """Every conversation of ``some``, whole or up to here, as a row; the first one as ``first_chunk``."""
            conv = some.column("conv").combine_chunks()
            role, text = (some.column(c).combine_chunks() for c in ("role", "text"))
            out, ends, a, b = assemble(role, text)
            points = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])  # code points before each byte
            code, _ = _codes(conv)
            edge = np.flatnonzero(np.diff(code, prepend=code[0] - 1))
            upto = np.append(edge[1:], len(code)) - 1
            offsets = np.concatenate([[0], ends[upto]])
            formatted = pa.LargeStringArray.from_buffers(len(edge), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
            loss = np.flatnonzero(_equals(role, LOSS_ROLE))
            row = np.searchsorted(edge, loss, side="right") - 1
            base = points[offsets[row]]
            spans = pa.StructArray.from_arrays([pa.array(points[a[loss]] - base), pa.array(points[b[loss]] - base)], ["start", "end"])
            counts = np.bincount(row, minlength=len(edge)) if len(edge) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), spans)
            chunks = np.zeros(len(edge), np.int32)
            chunks[0] = first_chunk
            return pa.RecordBatch.from_arrays([conv.take(pa.array(edge)), pa.array(np.full(len(edge), part, np.int32)), pa.array(chunks), formatted, lists],
                                              names=["conv", "part", "chunk", "formatted", "loss"])

        for batch in batches:
            for one in _slices(batch, chunk_bytes):
                if not held and chunk and one.column("conv")[0].as_py() != open_conv:
                    chunk = 0  # the long conversation ended with its last row
                held.append(one)
                size += one.nbytes
                if size < min(chunk_bytes, 4 << 20):
                    continue
                some = pa.Table.from_batches(held)
                code, _ = _codes(some.column("conv").combine_chunks())
                tail = int(np.searchsorted(code, code[-1]))  # the last conversation may go on
                if tail:
                    yield closed(some.slice(0, tail), chunk)
                    chunk = 0
                rest = some.slice(tail)
                if rest.nbytes >= chunk_bytes:
                    yield closed(rest, chunk)
                    chunk, open_conv = chunk + 1, rest.column("conv")[len(rest) - 1].as_py()
                    held, size = [], 0
                else:
                    held, size = rest.combine_chunks().to_batches(), rest.nbytes
        if held:
            some = pa.Table.from_batches(held)
            if some.num_rows:
                yield closed(some, chunk)

    return rows.mapInArrow(write, f"conv {kind}, part int, chunk int, formatted string, loss array<struct<start:long,end:long>>")


def _range_keys() -> list:
    """Keys in the order of (conv, turn, role, text) that hold no long value: range bounds are sampled by the driver.

    A text's beginning counts only beside a role that stands whole in its key; longer roles of one beginning come
    after it (null last) and keep together.
    """
    role, text = F.col("role"), F.coalesce("text", F.lit(""))
    whole = role.isNull() | (F.length(role) <= KEY_CHARS)
    return [F.asc("conv"), F.asc("turn"), F.substring(role, 1, KEY_CHARS).asc(),
            F.when(whole, F.substring(text, 1, KEY_CHARS)).asc_nulls_last()]


def _codes(column: pa.Array) -> tuple[np.ndarray, int]:
    """Running number of each run of equal values (null equals null)."""
    if not len(column):
        return np.zeros(0, np.int64), 0
    codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    runs = np.cumsum(np.diff(codes, prepend=codes[0]) != 0)
    return runs, int(runs[-1]) + 1


def _equals(column: pa.Array, value: str) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.equal(column, value), False).to_numpy(zero_copy_only=False)


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most about ``most`` bytes."""
    if batch.num_rows <= 1 or batch.nbytes <= most:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from _slices(batch.slice(0, half), most)
        yield from _slices(batch.slice(half), most)


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the formatted text alone: its turns, their hash, and what the loss mask covers.

    Every chunk is read where it was written; only the running hashes of a conversation follow its chunks one after another.
    """
    kind = formatted.schema["conv"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in _slices(batch, 4 << 20):
                cols: list[list] = [[], [], [], [], []]
                for text, spans in zip(one.column("formatted"), one.column("loss")):
                    text = text.as_py()
                    found = read_turns(text.encode("utf-8", "surrogatepass"))
                    loss = [unescape(text[span["start"]:span["end"]]) for span in spans.as_py()]
                    said = "".join(f"{role}\n{words}\n" for role, words, _, _ in found)
                    for col, value in zip(cols, (len(found), said.encode("utf-8", "surrogatepass"), sum(map(len, loss)),
                                                 "".join(loss).encode("utf-8", "surrogatepass"), len(text))):
                        col.append(value)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [one.column("conv"), one.column("part"), one.column("chunk"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                    names=["conv", "part", "chunk", "n", "said", "loss_n", "loss", "total"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def done():
            conv, n, turns, chars, loss, total = state
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], conv_type), pa.array([n], pa.int64()), pa.array([turns.hexdigest()]), pa.array([chars], pa.int64()),
                 pa.array([loss.hexdigest()]), pa.array([total], pa.int64())],
                names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            conv_type = batch.schema.field("conv").type
            ready = []
            for i in range(batch.num_rows):
                conv, n, said, loss_n, loss, total = (batch.column(c)[i].as_py() for c in ("conv", "n", "said", "loss_n", "loss", "total"))
                if state is None or not (conv == state[0] or (conv != conv and state[0] != state[0])):
                    if state is not None:
                        ready.append(done())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(said)
                state[3] += loss_n
                state[4].update(loss)
                state[5] += total
            if ready:
                yield pa.Table.from_batches(ready).combine_chunks().to_batches()[0]
        if state is not None:
            yield done()

    plain = formatted.select("conv", "part", "chunk", "formatted", "loss").mapInArrow(
        read, f"conv {kind}, part int, chunk int, n long, said binary, loss_n long, loss binary, total long")
    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return (plain.repartition("conv").sortWithinPartitions("conv", "part", "chunk")
            .select("conv", "n", "said", "loss_n", "loss", "total").mapInArrow(hashes, schema).withColumnRenamed("conv", conv_col))


def unescape(text: str) -> str:
    """Takes one backslash from before each escaped character."""
    parts = text.split("\\\\")
    return "\\".join(p.replace("\\", "") for p in parts)
