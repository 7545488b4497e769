"""Order-preserving packing of documents into sequences, by dynamic programming over cuts.

Documents stand one after another in id order. A sequence is a stretch between two cuts of at most
`length` tokens. Cuts at document ends are free, cuts at sentence ends cost a penalty in tokens of padding; a
sentence is cut inside, for a higher one, only if it is longer than a sequence. With g(j) = cost(j) + j the best way to end at cut i is

    cost(i) = penalty(i) + length - i + min g(j) over cuts j in [i - length, i)

and the minimum of the sliding window comes from a monotone queue, so the work is linear in the cuts.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import slices
from martlet.llm.token_store import in_id_order
from martlet.llm.tokens import encoder

PIECE = "struct<doc_id:long,start:long,length:long,doc_tokens:long,offset:long>"
PIECE_ARROW = pa.struct([(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "offset")])


def best_cuts(places: np.ndarray, penalties: np.ndarray, length: int) -> np.ndarray:
    """Chosen cuts among ascending `places` (first 0, last the end), with the least padding plus penalties.

    Neighbouring places must lie at most `length` apart. Of equal costs the earliest window start wins,
    that is, the longest sequence.
    """
    at, cost, came = places.tolist(), [0.0] * len(places), [0] * len(places)
    penalty = penalties.tolist()
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])  # (g, index) with g ascending
    for i in range(1, len(at)):
        here = at[i]
        while at[queue[0][1]] < here - length:
            queue.popleft()
        g, j = queue[0]
        came[i] = j
        value = g + length - here + penalty[i]
        g = value + here
        while queue and queue[-1][0] > g:
            queue.pop()
        queue.append((g, i))
    chosen, i = [], len(at) - 1
    while i:
        chosen.append(i)
        i = came[i]
    return places[np.array([0, *chosen[::-1]], dtype=np.int64)]


def candidate_cuts(ids: np.ndarray, doc_ends: np.ndarray, ends_sentence: np.ndarray, length: int, sentence: float, inside: float):
    """Places to cut and their penalties: document ends, sentence ends, and places inside sentences that are longer than a sequence.

    Such a sentence has to be cut somewhere; places `length` / 64 tokens apart bound the padding that it can force.
    """
    cost = np.full(len(ids) + 1, np.inf)
    cost[1:][ends_sentence[ids]] = sentence
    cost[doc_ends] = cost[0] = cost[len(ids)] = 0.0
    whole = np.flatnonzero(cost < np.inf)
    for i in np.flatnonzero(np.diff(whole) > length).tolist():
        cost[whole[i] + 1 : whole[i + 1]][:: max(1, length // 64)] = inside
    places = np.flatnonzero(cost < np.inf)
    return places, cost[places]


class Packer:
    """Packs a stream of documents; holds at most about `hold` tokens before it decides on cuts.

    After each decision all sequences but the last are final; the last one's tokens wait for what follows.
    """

    def __init__(self, length: int, sentence: float, inside: float, ends_sentence: np.ndarray, hold: int):
        self.length, self.sentence, self.inside, self.hold = length, sentence, inside, hold
        self.ends_sentence = ends_sentence
        self.ids: list[np.ndarray] = []
        self.waiting = 0
        # Of the documents that reach into the held tokens: id, tokens, and tokens already given out.
        self.docs: list[list] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """Take a document; gives what became final as (token ids, pieces) per sequence."""
        self.ids.append(ids)
        self.docs.append([doc_id, len(ids), 0])
        self.waiting += len(ids)
        if self.waiting >= self.hold:
            yield from self.decide(final=False)

    def decide(self, final: bool) -> Iterator[tuple]:
        if not self.waiting:
            return
        stream = np.concatenate(self.ids)
        ends = np.cumsum([n - given for _, n, given in self.docs])
        cuts = best_cuts(*candidate_cuts(stream, ends, self.ends_sentence, self.length, self.sentence, self.inside), self.length)
        if not final:
            cuts = cuts[:-1]
        doc, at = 0, 0
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            pieces = []
            while at < b:
                doc_id, n, given = self.docs[doc]
                take = min(n - given, b - at)
                pieces.append((doc_id, given, take, n, at - a))
                self.docs[doc][2] += take
                at += take
                if self.docs[doc][2] == n:
                    doc += 1
            yield stream[a:b], pieces
        self.docs = self.docs[doc:]
        self.ids = [stream[at:]]
        self.waiting = len(stream) - at


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    length: int = 1024,
    sentence: float = 2.0,
    inside: float = 8.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    hold: int = 1 << 20,
) -> DataFrame:
    """Sequences of at most `length` tokens: (sequence_id, ids, pieces), `ids` as little-endian 32-bit numbers, unpadded.

    Each token of each document lies in exactly one piece (doc_id, start in the document, length,
    doc_tokens, offset in the sequence). Documents keep the order of their ids, null first, ties by text;
    Spark's range partitions are packed side by side, each with one last sequence that may be short. Null and empty
    texts are the end id alone. Repeated rows are packed as often as they come. An empty table gives no rows.
    Sequence ids are unique, not gapless. Other columns are ignored.
    """
    kind = f"part int, place long, ids binary, pieces array<{PIECE}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True)
        vocabulary = encode.library.get_vocab()
        ends_sentence = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        ends_sentence[[i for s, i in vocabulary.items() if s.endswith((".", "!", "?", "Ċ"))]] = True
        packer, part, place = Packer(length, sentence, inside, ends_sentence, hold), 0, 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            flat = [p for _, pieces in found for p in pieces]
            columns = [pa.array([p[k] for p in flat], pa.int64()) for k in range(5)]
            items = pa.StructArray.from_arrays(columns, names=[f.name for f in PIECE_ARROW])
            offsets = pa.array(np.r_[0, np.cumsum([len(p) for _, p in found])], pa.int32())
            arrays = [
                pa.array(np.full(len(found), part), pa.int32()),
                pa.array(np.arange(place, place + len(found)), pa.int64()),
                pa.array([ids.astype("<u4").tobytes() for ids, _ in found], pa.binary()),
                pa.ListArray.from_arrays(offsets, items),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "place", "ids", "pieces"])

        for batch in slices(batches, "text"):
            part = batch.column(0)[0].as_py()
            flat, counts = encode.encode(batch.column(2))
            ends = np.cumsum(counts)
            flat = np.insert(flat, ends, end_id)
            ends = (ends + np.arange(1, len(ends) + 1)).tolist()
            at = 0
            for doc_id, end in zip(batch.column(1).to_pylist(), ends):
                found = list(packer.add(doc_id, flat[at:end]))
                at = end
                if found:
                    yield rows(found)
                    place += len(found)
        if found := list(packer.decide(final=True)):
            yield rows(found)

    packed = in_id_order(docs, id_col, text_col).mapInArrow(run, kind)
    number = F.col("part").cast("long") * F.lit(1 << 40) + F.col("place")
    return packed.select(number.alias("sequence_id"), "ids", "pieces")


def packing_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece, its checksum taken from the sequence it lies in."""
    pieces = pack(docs, tokenizer).select("sequence_id", "ids", F.explode("pieces").alias("p"))
    own = F.expr("substring(ids, CAST(p.offset * 4 + 1 AS INT), CAST(p.length * 4 AS INT))")
    return pieces.select(
        F.col("p.doc_id").alias("doc_id"),
        F.col("p.start").alias("start"),
        F.col("p.length").alias("length"),
        F.crc32(own).alias("ids_crc32"),
        F.col("p.doc_tokens").alias("doc_tokens"),
        "sequence_id",
        F.col("p.offset").alias("offset"),
    )
