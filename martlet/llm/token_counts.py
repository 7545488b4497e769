"""Token counts by scanning flat, unindexed token files for the end-of-document id.

A flat file is a run of little-endian ids with the end id after each document, stored in blocks of
fixed length that know nothing of documents. Each block is searched on its own, vectorised; what
a document has in earlier blocks is stitched on from a prefix scan over the blocks' summaries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import fresh_path, slices
from martlet.llm.tokens import encoder

# A row is a block of ids, or a list of the ids of the documents in the file (block is null).
FLAT = "file long, block int, ids binary, nth int, names array<long>"
WIDTH = "<u2"


def write_flat(
    docs: DataFrame,
    tokenizer: str,
    spaced: bool,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    block_tokens: int = 1 << 18,
) -> str:
    """Encode texts into flat files of 16-bit ids, one per input partition, in the order of the input; returns the folder.

    Null and empty texts are the end id alone. Repeated rows are written as often as they come. A special
    token spelled in a text is ordinary text, so the end id stands at ends alone. Beside the blocks lie lists of
    the documents' ids, which say nothing of places. An empty table gives an empty folder.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file, block, left = encoder(tokenizer, spaced, literal=True), None, 0, np.zeros(0, dtype=WIDTH)

        def row(block: int | None, ids: bytes | None, nth: int | None, names: pa.Array | None) -> pa.RecordBatch:
            kinds = {"file": pa.int64(), "block": pa.int32(), "ids": pa.binary(), "nth": pa.int32(), "names": pa.list_(pa.int64())}
            values = zip((file, block, ids, nth, names), kinds.values())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in values], names=list(kinds))

        lists = 0
        for batch in slices(batches, "text"):
            file = batch.column(0)[0].as_py()
            flat, counts = encode.encode(batch.column(2))
            if len(flat) and int(flat.max()) > np.iinfo(WIDTH).max:
                raise ValueError("ids beyond 16 bits need a wider file")
            left = np.concatenate([left, np.insert(flat, np.cumsum(counts), end_id).astype(WIDTH)])
            yield row(None, None, lists, batch.column(1))
            lists += 1
            while len(left) >= block_tokens:
                yield row(block, left[:block_tokens].tobytes(), None, None)
                left, block = left[block_tokens:], block + 1
        if len(left):
            yield row(block, left.tobytes(), None, None)

    held = docs.select(
        F.spark_partition_id().cast("long").alias("file"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    path = path or fresh_path(docs.sparkSession, "flat")
    held.mapInArrow(run, FLAT).write.option("compression", "zstd").parquet(path)
    return path


def scan_separators(blocks: DataFrame, end_id: int) -> DataFrame:
    """Documents of flat files: (file, place, start, n_tokens, ended), place and start counting from 0 in the file.

    blocks: (file, block, ids). n_tokens leaves the end id out. What follows the last end id of a file is a
    document with `ended` false; a file that ends with one has none. Blocks of any length, empty ones too, fit
    together in the order of their numbers; a document may span any number of them. No blocks give no rows.
    """
    found = "file long, block int, nth int, earlier long, at long, n_ids long, ends long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[row].as_buffer(), dtype=WIDTH)
                at = np.flatnonzero(ids == end_id)
                n = len(at) + 1  # the last row sums up the block
                last = int(at[-1]) if len(at) else -1
                arrays = [
                    pa.array(np.full(n, batch.column(0)[row].as_py()), pa.int64()),
                    pa.array(np.full(n, batch.column(1)[row].as_py()), pa.int32()),
                    pa.array(np.r_[np.arange(len(at)), -1], pa.int32()),
                    pa.array(np.r_[-1, at[:-1], last] if len(at) else np.array([last]), pa.int64()),
                    pa.array(np.r_[at, -1], pa.int64()),
                    pa.array(np.full(n, len(ids)), pa.int64()),
                    pa.array(np.full(n, len(at)), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["file", "block", "nth", "earlier", "at", "n_ids", "ends"])

    seen = blocks.select("file", "block", "ids").mapInArrow(run, found)
    # All rows of a block carry its sums, so the scan over blocks needs the last row of each alone.
    order = Window.partitionBy("file").orderBy("block")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = seen.filter("nth = -1").select(
        "file", "block", "ends", "n_ids", F.col("earlier").alias("last"), F.coalesce(F.sum("n_ids").over(past), F.lit(0)).alias("base")
    )
    scanned = whole.select(
        "file", "block", "base", (F.col("base") + F.col("n_ids")).alias("upto"),
        F.coalesce(F.sum("ends").over(past), F.lit(0)).alias("docs_before"),
        F.coalesce(F.max(F.when(F.col("last") >= 0, F.col("base") + F.col("last"))).over(past), F.lit(-1)).alias("last_before"),
        F.max(F.when(F.col("last") >= 0, F.col("base") + F.col("last"))).over(order).alias("last_here"),
        F.lead("block").over(order).isNull().alias("final"),
        F.sum("ends").over(order).alias("docs_upto"),
    )
    ended = seen.filter("nth >= 0").join(scanned, ["file", "block"]).select(
        "file",
        (F.col("docs_before") + F.col("nth")).alias("place"),
        (F.when(F.col("earlier") >= 0, F.col("base") + F.col("earlier")).otherwise(F.col("last_before")) + 1).alias("start"),
        (F.col("base") + F.col("at")).alias("end"),
        F.lit(True).alias("ended"),
    )
    tail_start = F.coalesce("last_here", F.lit(-1)) + 1
    tail = scanned.filter(F.col("final") & (tail_start < F.col("upto"))).select(
        "file", F.col("docs_upto").alias("place"), tail_start.alias("start"), F.col("upto").alias("end"), F.lit(False).alias("ended")
    )
    return ended.unionByName(tail).select("file", "place", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "ended")


def count_tokens(
    docs: DataFrame, tokenizer: str, spaced: bool, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, file, place, start, n_tokens) of every document, counted in flat files written from the texts.

    The k-th document of a file is the k-th id of its list; the lists are numbered by their order in the file.
    """
    spark = docs.sparkSession
    path = write_flat(docs, tokenizer, spaced, end_id, id_col, text_col)
    flat = spark.read.schema(FLAT).parquet(path)
    counted = scan_separators(flat.filter("block is not null"), end_id)
    return _named(flat, counted)


def _named(flat: DataFrame, counted: DataFrame) -> DataFrame:
    lists = flat.filter("block is null").select("file", "names", "nth")
    past = Window.partitionBy("file").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = lists.select("file", "names", F.coalesce(F.sum(F.size("names")).over(past), F.lit(0)).alias("first"))
    names = placed.select("file", "first", F.posexplode("names").alias("k", "doc_id")).select(
        "file", (F.col("first") + F.col("k")).alias("place"), "doc_id"
    )
    return names.join(counted, ["file", "place"]).select("doc_id", "file", "place", "start", "n_tokens")


def count_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    return count_tokens(docs, tokenizer, spaced=True, end_id=50256)
