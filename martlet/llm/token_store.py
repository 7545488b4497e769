"""Token-id files as directly addressable codes (DAC).

An id is cut into chunks of 8 bits, lowest first. Level k holds the k-th chunks of all ids that
have one, and a bitmap saying which of them go on in level k + 1; a rank directory gives the
number of set bits before every 512th. Token i is read by following its rank from level to
level, without decoding any other token.

A file is a Parquet part whose rows are segments of whole documents in ascending id order; Spark's
commit protocol makes the files of a task appear once or not at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import fresh_path, slices
from martlet.llm.tokens import encoder, per_text

RANK_STEP = 512
MAGIC = b"DAC1"
SEGMENT = "part int, segment int, n_tokens long, doc_ids array<long>, counts array<long>, codes binary"


class Codes:
    """Random access to a sequence of ids in DAC form."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels  # chunks, bitmap bytes (little bit order), set bits before each step

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], np.asarray(ids, dtype=np.uint32)
        while True:
            more = rest > 0xFF
            bits = np.packbits(more, bitorder="little")
            steps = np.add.reduceat(more, np.arange(0, len(more), RANK_STEP), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
            levels.append(((rest & 0xFF).astype(np.uint8), bits, (np.cumsum(steps) - steps).astype("<u4")))
            if not more.any():
                return cls(levels)
            rest = rest[more] >> 8

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def _rank(self, level: int, at: int) -> int:
        """Set bits of the level's bitmap before place `at`."""
        chunks, bits, directory = self.levels[level]
        if at >= len(chunks):
            return len(self.levels[level + 1][0]) if level + 1 < len(self.levels) else 0
        step = at // RANK_STEP
        inner = np.unpackbits(bits[step * RANK_STEP // 8 : at // 8 + 1], bitorder="little")[: at - step * RANK_STEP]
        return int(directory[step]) + int(inner.sum())

    def token(self, i: int) -> int:
        """Id at place i; touches one chunk and one bitmap step per level."""
        value, level = 0, 0
        while True:
            chunks, bits, _ = self.levels[level]
            value |= int(chunks[i]) << (8 * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            i, level = self._rank(level, i), level + 1

    def run(self, start: int, end: int) -> np.ndarray:
        """Ids at start..end-1; their chunks are one run in every level, found by rank."""
        chunks, bits, _ = self.levels[0]
        values = chunks[start:end].astype("<u4")
        place = np.arange(end - start)
        for level in range(len(self.levels) - 1):
            more = np.unpackbits(bits[start >> 3 : (end + 7) >> 3], bitorder="little")[start & 7 : (start & 7) + end - start]
            place = place[more.astype(bool)]
            start, end = self._rank(level, start), self._rank(level, end)
            chunks, bits, _ = self.levels[level + 1]
            values[place] |= chunks[start:end].astype("<u4") << np.uint32(8 * (level + 1))
        return values

    def to_bytes(self) -> bytes:
        """Magic, number of levels, then per level: chunks, rank steps (counts, then contents), all little-endian."""
        out = [MAGIC, np.uint32(len(self.levels)).tobytes()]
        for chunks, bits, directory in self.levels:
            out += [np.array([len(chunks), len(directory)], dtype="<u8").tobytes()]
            out += [chunks.tobytes(), bits.tobytes(), directory.astype("<u4").tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> Codes:
        if data[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        at, levels = 8, []
        for _ in range(int(np.frombuffer(data, "<u4", 1, 4)[0])):
            n, steps = map(int, np.frombuffer(data, "<u8", 2, at))
            at += 16
            chunks = np.frombuffer(data, np.uint8, n, at)
            bits = np.frombuffer(data, np.uint8, (n + 7) // 8, at + n)
            directory = np.frombuffer(data, "<u4", steps, at + n + (n + 7) // 8)
            at += n + (n + 7) // 8 + 4 * steps
            levels.append((chunks, bits, directory))
        return cls(levels)


def in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, id, text) with ascending ids over ascending parts; equal ids follow the hash of their texts."""
    held = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    keyed = held.withColumn("h", F.xxhash64("text"))
    ranged = keyed.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    return ranged.select(F.spark_partition_id().alias("part"), "id", "text")


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    spaced: bool,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    segment_tokens: int = 1 << 20,
) -> str:
    """Encode every text, append `end_id`, and write the ids as DAC segments; returns the folder.

    Null and empty texts have the end id alone. Ids ascend, null first; rows with equal ids or repeated
    rows are all kept, side by side. An empty table gives a folder without segments. A segment holds whole
    documents: `segment_tokens` or a little more, or one longer document. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, spaced)
        part, number, held = None, 0, []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate([f for f, _, _ in held])
            counts = np.concatenate([c for _, c, _ in held])
            names = pa.concat_arrays([d for _, _, d in held])
            row = [[part], [number], [len(ids)], [names], [counts], [Codes.of(ids).to_bytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            arrays = [pa.array(v, k) for v, k in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "segment", "n_tokens", "doc_ids", "counts", "codes"])

        waiting = 0
        for batch in slices(batches, "text"):
            part = batch.column(0)[0].as_py()
            flat, counts = encode.encode(batch.column(2))
            flat = np.insert(flat, np.cumsum(counts), end_id)
            counts = counts + 1
            at, first = 0, 0
            ends = np.cumsum(counts)
            while first < len(counts):
                last = max(first + 1, int(np.searchsorted(ends, at + segment_tokens - waiting, side="right")))
                upto = int(ends[last - 1])
                held.append((flat[at:upto], counts[first:last], batch.column(1).slice(first, last - first)))
                waiting += upto - at
                at, first = upto, last
                if waiting >= segment_tokens or first < len(counts):
                    yield segment()
                    number, held, waiting = number + 1, [], 0
        if held:
            yield segment()

    path = path or fresh_path(docs.sparkSession, "tokens")
    in_id_order(docs, id_col, text_col).mapInArrow(run, SEGMENT).write.parquet(path)
    return path


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, segment, base): how many ids lie before each segment."""
    # Ids before a segment: those of earlier parts, a row for each of Spark's partitions, and of earlier segments of its part.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.sum("n").over(before).alias("earlier"))
    return (
        files.select("part", "segment", F.sum("n_tokens").over(inside).alias("inner"))
        .join(parts, "part")
        .select("part", "segment", (F.coalesce("earlier", F.lit(0)) + F.coalesce("inner", F.lit(0))).alias("base"))
    )


def read_tokens(spark, path: str) -> DataFrame:
    """Read token files back: (doc_id, start, n_tokens, ids_crc32) per document, start counting all ids before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                codes = Codes.from_bytes(batch.column(5)[row].as_py())
                counts = batch.column(4)[row].values.to_numpy()
                ids = codes.run(0, len(codes))
                sums = [zlib.crc32(x) for x in per_text(ids, counts)]
                arrays = [
                    pa.array(np.full(len(counts), batch.column(0)[row].as_py()), pa.int32()),
                    pa.array(np.full(len(counts), batch.column(1)[row].as_py()), pa.int32()),
                    pa.array(np.cumsum(counts) - counts, pa.int64()),
                    batch.column(3)[row].values,
                    pa.array(counts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "segment", "within", "doc_id", "n_tokens", "ids_crc32"])

    files = spark.read.schema(SEGMENT).parquet(path)
    kind = "part int, segment int, within long, doc_id long, n_tokens long, ids_crc32 long"
    documents = files.mapInArrow(run, kind)
    starts = segment_starts(files)
    return documents.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokens_at(places: DataFrame, path: str, place_col: str = "place", block: int = 1 << 20) -> DataFrame:
    """(place, token) per row of `places`: the ids at these places of the whole sequence in the token files at `path`.

    Each id is addressed in its segment's codes: a chunk and one rank step per level, no other id is decoded. The list of
    segments says where a place lies; it is joined on blocks of `block` places, as no table of all places exists. A segment is
    opened once, with all the places asked of it (at most one per id). The scan still passes over the segments that nobody
    asks for; they are dropped by the join, unopened.

    A null place, or one before the first or behind the last id, gives a null token. Repeated places are answered each. Other
    columns are ignored.
    """
    spark = places.sparkSession
    asked = places.select(F.col(f"`{place_col}`").cast("long").alias("place"))
    files = spark.read.schema(SEGMENT).parquet(path)
    sizes = files.select("part", "segment", "n_tokens")
    spans = sizes.join(segment_starts(files), ["part", "segment"]).filter("n_tokens > 0")
    ends = F.col("base") + F.col("n_tokens")
    first, last = F.floor(F.col("base") / block), F.floor((ends - 1) / block)
    blocks = spans.select("part", "segment", "base", ends.alias("end"), F.explode(F.sequence(first, last)).alias("block"))
    found = (
        asked.filter("place >= 0")
        .distinct()
        .withColumn("block", F.floor(F.col("place") / block))
        .join(blocks, "block")
        .filter("place >= base AND place < end")
        .groupBy("part", "segment", "base")
        .agg(F.collect_list("place").alias("places"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                codes = Codes.from_bytes(batch.column(0)[row].as_py())
                base, wanted = batch.column(1)[row].as_py(), batch.column(2)[row].values
                ids = [codes.token(i) for i in (wanted.to_numpy() - base).tolist()]
                yield pa.RecordBatch.from_arrays([wanted, pa.array(ids, pa.int64())], names=["place", "token"])

    opened = files.select("part", "segment", "codes").join(found, ["part", "segment"]).select("codes", "base", "places")
    return asked.join(opened.mapInArrow(run, "place long, token long"), "place", "left")


def token_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_tokens(docs.sparkSession, write_tokens(docs, tokenizer, spaced=False, end_id=2))
