"""What the operators share: landed tables, word splitting, bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.session import shared_folder

# Fixed values of the word contract: ASCII white space, and what is left of ASCII in words of letters and digits.
SPACE = " \t\n\x0b\x0c\r"
FIRST_ID = -(1 << 63)


def fresh_path(spark, label: str) -> str:
    """A new folder under the one that the driver and all executors share."""
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def land(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Cuts the lineage where a result is read more than once: a lost executor costs its
    unfinished tasks, never the work before the table.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, as UTF-8."""
    return text.encode().split()


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `most` bytes of text, or a single row."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        size = np.cumsum(np.array(pa.compute.fill_null(pa.compute.binary_length(text), 0), dtype=np.int64))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def spans_union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as disjoint spans in ascending order."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.r_[True, starts[1:] > reach[:-1]]
    last = np.r_[first[1:], True]
    return starts[first], reach[last]


class Filter:
    """A bitmap of fixed size in which hashes are looked up: what was put in is always found, little else is.

    It has `bits` bits (8 MiB by default) however many hashes go in, so it may be sent to every task. Whoever uses it must
    be right with any false hit; a full bitmap costs work, never results.
    """

    BITS = 1 << 26

    def __init__(self, hashes: DataFrame, column: str, bits: int = BITS):
        place = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
        parts = (
            hashes.select(place.alias("at"))
            .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("set"))
        )
        content = np.zeros(bits // 8, dtype=np.uint8)
        for bucket, part in parts.collect():  # at most `bits` / 32768 rows of 4 KiB
            content[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(part, dtype=np.uint8)[: len(content)]
        self.shared = hashes.sparkSession.sparkContext.broadcast(content)
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """For unsigned 64-bit hashes, whether they may be in."""
        at = (hashes & np.uint64(self.bits - 1)).astype(np.int64)
        return (self.shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def lower_az(column: str) -> Column:
    """A text column with A-Z alone in lower case."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
