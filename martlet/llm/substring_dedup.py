"""Substring dedup by relative Lempel-Ziv parsing against reference blocks.

A window is `width` words in a row; it is a repeat if the same words start in a document with a smaller
id. Windows are dealt to reference blocks by their minimiser, the least hash among the short word runs in
them: equal windows have equal minimisers, so each meets all its earlier copies in one block. Neighbouring
windows with the same minimiser travel as one stretch of text. Runs that occur once in the corpus cannot be in
a repeat, so their stretches stay at home. A text that a smaller document has as a whole is one factor.

In a block, stretches come in ascending order of document. The block's index holds the windows of all earlier
documents. A stretch is factored greedily: the longest match with the reference at a place is a factor, found by
extending from an indexed window; the next factor starts where windows reach over the last one's end, and each of
those windows is looked up on its own. Factors of at least a window become duplicate spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from martlet.llm.common import land, slices, spans_union
from martlet.llm.tokens import ranges

GRAM = 5
ODD = np.uint64(0x9E3779B97F4A7C15)


def _hash(text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.coalesce(text, F.lit("")))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, dictionary-coded, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = lists.offsets.to_numpy()
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    some = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False))
    counts = np.diff(np.r_[0, np.cumsum(some)][offsets - offsets[0]])
    return flat.filter(pa.array(some)).dictionary_encode(), counts


def leftmost_least(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of every `size` values in a row and the leftmost place it has, from windows that double in length."""
    least, place, length = values, np.arange(len(values)), 1
    while length < size:
        step = min(length, size - length)
        front, back = least[:-step], least[step:]
        place = np.where(back < front, place[step:], place[:-step])
        least, length = np.minimum(front, back), length + step
    return least, place


def minimisers(coded: pa.Array, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of windows with one minimiser: (hash, text number, first word in the text, number of windows)."""
    names = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), dtype=np.uint64, count=len(names))
    words = hashes[coded.indices.to_numpy()]
    n = len(words) - width + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    grams = np.zeros(len(words) - GRAM + 1, dtype=np.uint64)
    for j in range(GRAM):
        grams = grams * ODD + words[j : j + len(grams)]
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(0xBF58476D1CE4E5B9)
    grams ^= grams >> np.uint64(32)
    least, place = leftmost_least(grams, width - GRAM + 1)
    owner = np.repeat(np.arange(len(counts)), counts)
    valid = owner[:n] == owner[width - 1 :]
    starts = np.flatnonzero(valid)
    new = np.r_[True, (place[starts][1:] != place[starts][:-1]) | (owner[starts][1:] != owner[starts][:-1])][: len(starts)]
    first = starts[new]
    sizes = np.diff(np.r_[np.flatnonzero(new), len(starts)])
    text = owner[first]
    begin = np.cumsum(counts) - counts
    return least[first], text, first - begin[text], sizes


def _runs(docs: DataFrame, width: int) -> DataFrame:
    """(m, h, start): every stretch of every document by its minimiser."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            least, text, start, _ = minimisers(*split_words(part.column(1)), width)
            arrays = [pa.array(least.view(np.int64)), part.column(0).take(pa.array(text)), pa.array(start, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["m", "h", "start"])

    return docs.select("h", "text").mapInArrow(run, "m long, h long, start int")


def _stretches(hinted: DataFrame, width: int) -> DataFrame:
    """Rows that documents (id, h, text, hints) send to blocks: (block, id, h, start, n, words).

    Within a slice, equal stretches go out once, for their smallest document: they are repeats in all others
    there, which is said at once by a row without words. A frequent minimiser's stretches go out window by window, each
    to a block of its own text, so no block gathers all contexts of a frequent run, nor all copies of a window.
    """
    id_type, id_arrow = hinted.schema["id"].dataType.simpleString(), to_arrow_type(hinted.schema["id"].dataType)
    kinds = [pa.int64(), id_arrow, pa.int64(), pa.int32(), pa.int32(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            coded, counts = split_words(part.column(2))
            least, text, start, sizes = minimisers(coded, counts, width)
            # Stretches with a hint, in ascending order of document.
            lists = part.column(3)
            owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            hints = lists.flatten()
            place = owner << 32 | hints.field("start").to_numpy()
            order = np.argsort(place)
            place, hot = place[order], hints.field("hot").to_numpy(zero_copy_only=False)[order]
            own = text << 32 | start
            at = np.minimum(np.searchsorted(place, own), max(0, len(place) - 1))
            rows = np.flatnonzero(place[at] == own) if len(place) else np.zeros(0, dtype=np.int64)
            ids, keys = part.column(0).to_pylist(), part.column(1).to_pylist()
            by_id = sorted(range(len(ids)), key=lambda t: (ids[t] is None, 0 if ids[t] is None else ids[t]))
            rank = np.empty(len(ids), dtype=np.int64)
            rank[by_id] = np.arange(len(ids))
            rows = rows[np.argsort(rank[text[rows]], kind="stable")]
            # The words of the slice as one string, and where each starts in it.
            names = coded.dictionary.to_pylist()
            words = " ".join([names[i] for i in coded.indices.to_pylist()])
            size = pc.utf8_length(coded.dictionary).to_numpy()[coded.indices.to_numpy()]
            ends = np.cumsum(size + 1) - 1
            first = (np.cumsum(counts) - counts)[text[rows]] + start[rows]
            is_hot, many, source = hot[at[rows]], sizes[rows], rows
            if is_hot.any():  # a row per window
                times = np.where(is_hot, many, 1)
                source, step = np.repeat(rows, times), ranges(np.zeros(len(times), dtype=np.int64), times)
                first, many, is_hot = np.repeat(first, times) + step, np.repeat(np.where(is_hot, 1, many), times), np.repeat(is_hot, times)
            else:
                step = np.zeros(len(rows), dtype=np.int64)
            begin, end = (ends[first] - size[first]).tolist(), ends[first + many + width - 2].tolist()
            firsts: dict[str, object] = {}
            blocks, texts = least[source].view(np.int64).tolist(), []
            owners = text[source].tolist()
            for row, (a, b, t) in enumerate(zip(begin, end, owners)):
                stretch = words[a:b]
                texts.append(stretch if firsts.setdefault(stretch, ids[t]) == ids[t] else None)
            for row, stretch in enumerate(texts):
                if stretch is None:  # needs no block, so it must not crowd a frequent one
                    blocks[row] = keys[owners[row]]
            for row in np.flatnonzero(is_hot).tolist():
                if texts[row] is not None:
                    blocks[row] = xxhash.xxh64_intdigest(texts[row]) - (1 << 63)
            which = pa.array(text[source])
            columns = [blocks, None, None, (start[source] + step).astype(np.int32), many.astype(np.int32), texts]
            arrays = [pa.array(c, k) if c is not None else None for c, k in zip(columns, kinds)]
            arrays[1], arrays[2] = part.column(0).take(which), part.column(1).take(which)
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "id", "h", "start", "n", "words"])

    return hinted.mapInArrow(run, f"block long, id {id_type}, h long, start int, n int, words string")


class Reference:
    """Index of a reference block: the windows of earlier documents, with the place to extend a match from."""

    def __init__(self, width: int):
        self.width = width
        self.stretches: list[list[str]] = []
        self.index: dict[tuple, tuple[int, int, object]] = {}

    def factors(self, words: list[str], doc_id) -> list[tuple[int, int]]:
        """Spans of words whose windows all occur in documents before `doc_id`, by greedy parsing."""
        width, index, spans, i = self.width, self.index, [], 0
        last = len(words) - width
        while i <= last:
            hit = index.get(tuple(words[i : i + width]))
            if hit is None or hit[2] == doc_id:
                i += 1
                continue
            source, at = self.stretches[hit[0]], hit[1] + width
            end = i + width
            while end < len(words) and at < len(source) and words[end] == source[at]:
                end, at = end + 1, at + 1
            spans.append((i, end))
            i = end - width + 1  # windows over the factor's end are looked up one by one
        return spans

    def add(self, words: list[str], doc_id) -> None:
        number, width = len(self.stretches), self.width
        self.stretches.append(words)
        for i in range(len(words) - width + 1):
            self.index.setdefault(tuple(words[i : i + width]), (number, i, doc_id))


def _parse(stretches: DataFrame, width: int) -> DataFrame:
    """Duplicate spans (h, start, end) of words; blocks are parsed one after another in each task."""
    by_block = stretches.withColumn("last", F.col("id").isNull()).repartition("block")
    sorted_blocks = by_block.sortWithinPartitions("block", "last", "id").drop("last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, reference = None, Reference(width)
        for batch in batches:
            rows, starts, ends = [], [], []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            for row, (b, doc_id, start, n, words) in enumerate(zip(*columns)):
                if words is None:
                    found = [(0, n + width - 1)]
                else:
                    if b != block:
                        block, reference = b, Reference(width)
                    split = words.split(" ")
                    found = reference.factors(split, doc_id)
                    reference.add(split, doc_id)
                for s, e in found:
                    rows.append(row)
                    starts.append(start + s)
                    ends.append(start + e)
            which = pa.array(rows, pa.int64())
            arrays = [batch.column(2).take(which), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "start", "end"])

    return sorted_blocks.mapInArrow(run, "h long, start int, end int")


def _texts(docs: DataFrame, width: int, hot: int) -> DataFrame:
    """(h, firsts, hints) of every text: who has it first, and which of its stretches have a run that occurs again.

    `h` alone names a text here: hints of two texts with one hash are looked up in both, which finds no more and no less.
    For the rest `firsts` tells such texts apart by the second hash `g`.
    """
    runs = _runs(docs, width)
    # Landed, so that the join shuffles both sides itself: only then does Spark split a frequent run's rows.
    counts = land(runs.groupBy("m").agg(F.count("*").alias("n")).filter("n > 1"), "runs")
    shared = runs.join(counts, "m").select("h", F.struct("start", (F.col("n") > hot).alias("hot")).alias("hint"))
    hints = shared.groupBy("h").agg(F.collect_set("hint").alias("hints"))
    first = docs.groupBy("h", "g").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id")).alias("first"))
    firsts = first.groupBy("h").agg(F.collect_list(F.struct("g", F.col("first.id").alias("id"))).alias("firsts"))
    return land(firsts.join(hints, "h", "left"), "texts")


def _is_copy() -> Column:
    """Whether the document's whole text is in a document with a smaller id."""
    own = F.filter("firsts", lambda x: x["g"] == F.col("g"))[0]["id"]
    return ~own.eqNullSafe(F.col("id"))


def dedup_substrings(
    docs: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text", hot: int = 10_000
) -> DataFrame:
    """(id, n_words, n_removed, kept_text, removed) per row of `docs`.

    Every word covered by a window of `width` words that also starts in a document with a smaller id goes;
    windows are judged on the input. `removed` holds disjoint spans (start, end) of words, `kept_text` the other words, joined
    by one blank. Words are what ASCII white space separates, compared as they are. A null id comes after all others and is
    smaller than none. Rows with equal ids are one document for this: their windows do not count against each other.
    Repeated rows come out alike. Null and empty texts have no words. An empty table gives no rows. Other columns are ignored.

    hot: a minimiser with more stretches than this is dealt window by window; results do not depend on it.
    """
    text = F.col(f"`{text_col}`").cast("string")
    held = docs.select(F.col(f"`{id_col}`").alias("id"), _hash(text, 0).alias("h"), _hash(text, 1).alias("g"), text.alias("text"))
    texts = _texts(held, width, hot)
    # Both joins need the documents by their hash; Spark deals them out once and uses that twice.
    hinted = held.join(texts.filter("hints IS NOT NULL"), "h").filter(~_is_copy()).select("id", "h", "text", "hints")
    spans = _parse(_stretches(hinted, width), width).groupBy("h").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    known = texts.select("h", "firsts").join(spans, "h", "left")
    found = held.join(known, "h").select("id", "text", "spans", _is_copy().alias("copy"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n_words, n_removed, kept_texts, removed = [], [], [], []
            for text, spans, copy in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                words = text.encode().split() if text else []
                cut = [(s["start"], s["end"]) for s in spans or ()]
                if copy:
                    cut = [(0, len(words))] if len(words) >= width else []
                cut = np.array(cut, dtype=np.int64).reshape(-1, 2)
                starts, ends = spans_union(cut[:, 0], cut[:, 1])
                edges = np.r_[0, np.stack([starts, ends], axis=1).reshape(-1), len(words)].tolist()
                kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                kept_texts.append(b" ".join(kept).decode())
                removed.append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())])
            spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            arrays = [
                part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(kept_texts, pa.string()), pa.array(removed, spans_kind),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_words", "n_removed", "kept_text", "removed"])

    id_type = held.schema["id"].dataType.simpleString()
    kind = f"id {id_type}, n_words long, n_removed long, kept_text string, removed array<struct<start:long,end:long>>"
    return found.mapInArrow(run, kind)


def substring_digest(docs: DataFrame) -> DataFrame:
    found = dedup_substrings(docs)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
