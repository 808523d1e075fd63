"""Terms of a text (runs of ASCII letters and digits and of all characters past ASCII, A-Z lower-cased) and query sets in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20  # text of a block of items (one longer item is a block)

#: Every ASCII byte but digits and letters becomes a space, capitals become small; bytes of longer characters stay.
_KEPT = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a text in UTF-8, in order; null: none."""
    return text.translate(_KEPT).split() if text else []


def texts(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as UTF-8, without decoding them."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The query set as blocks of (id, texts), ids ascending, at most about ``BLOCK_BYTES`` of text in each.

    Rows that repeat an id are one item; rows without an id are left out.  The driver holds one block at a time.
    """
    rows = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    block: list[tuple[object, list[bytes]]] = []
    size = 0
    for r in rows.filter("id IS NOT NULL").orderBy("id", "t").toLocalIterator():
        text = (r["t"] or "").encode("utf-8", "surrogatepass")
        if block and block[-1][0] == r["id"]:
            block[-1][1].append(text)
        else:
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((r["id"], [text]))
        size += len(text) + 64
    if block:
        yield block
