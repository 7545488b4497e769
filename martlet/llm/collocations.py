"""Phrase collocation mining: mergeable Misra-Gries summaries per hash partition, then an exact second pass.

A phrase can only be frequent if its parts are, so the summaries are taken in rounds: words, pairs of surviving words,
and longer phrases whose pairs all survive. In each round tasks count the phrases of a slice of text, deal the
counts out by the phrase's hash, and each hash partition folds them into one Misra-Gries summary. A summary of k counters over a
mass of m occurrences is at most m / (k + 1) short on any phrase; k is more than m divided by the threshold, so whatever
reaches the threshold survives. The second pass counts the survivors exactly, by their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import Filter, land, slices

# What ends a piece, and what stands between the words of one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
NO_LANG = "und"
LONGEST = 5
# Counters of one summary that a hash partition is laid out for (16 bytes each).
COUNTERS = 1 << 20
SLICE_BYTES = 4 << 20
# Counts that a task holds to add up before it gives them out.
HELD = 1 << 20
# Bytes of a phrase's hash that its counts go out with. Phrases that share them are counted as one, so more may survive, never fewer.
SENT = 5

ENDS = np.isin(np.arange(256), np.frombuffer(PIECE_ENDS, dtype=np.uint8))
IN_WORD = ~(ENDS | np.isin(np.arange(256), np.frombuffer(BLANKS, dtype=np.uint8)))


# ------------------------------------------------------------------ phrases of a slice
def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its front and of its last element."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Phrases:
    """The phrases of some texts, length by length: distinct ones with count and hash.

    Words are told apart by their bytes and longer phrases by their front and last word, so equal numbers mean equal phrases;
    the hash only deals them out and looks them up.
    """

    def __init__(self, langs: list[str], texts: list[str]):
        data = "\n".join(texts).encode().lower()  # a line end is the end of a piece; bytes lower only A-Z
        raw = np.frombuffer(data, dtype=np.uint8)
        inside = IN_WORD[raw]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(ENDS[raw], dtype=np.int32)[starts]
        offsets = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[inside]))]
        )
        coded = words.dictionary_encode()
        self.word = coded.indices.to_numpy().astype(np.int64)
        self.names = coded.dictionary
        self.word_hash = np.fromiter(map(xxhash.xxh64_intdigest, self.names.to_pylist()), dtype=np.uint64, count=len(self.names))
        sizes = np.fromiter((len(t.encode()) + 1 for t in texts), dtype=np.int64, count=len(texts))
        text_of = np.searchsorted(np.cumsum(sizes), starts, side="right")
        lang_of, self.langs = pd.factorize(np.array(langs, dtype=object))
        self.lang_of_text, self.text_of = lang_of, text_of
        self.length = 1
        lang_hash = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs], dtype=np.uint64)
        lang = lang_of[text_of] if len(text_of) else np.zeros(0, dtype=np.int64)
        self._count(np.arange(len(starts)), (lang.astype(np.int64) << 32) | self.word)
        self.hash = _mix(lang_hash[lang[self.first]], self.word_hash[self.word[self.first]])

    def _count(self, at: np.ndarray, key: np.ndarray) -> None:
        """Phrases of the present length start at the words `at`; equal keys are equal phrases."""
        number, distinct = pd.factorize(key)
        self.of = np.full(len(self.word), -1, dtype=np.int64)  # word -> number of the phrase that starts there
        self.of[at] = number
        self.count = np.bincount(number, minlength=len(distinct))
        self.first = np.empty(len(distinct), dtype=np.int64)
        self.first[number[::-1]] = at[::-1]

    def keep(self, chosen: np.ndarray) -> None:
        """Let only the chosen of the distinct phrases be parts of longer ones."""
        self.of = np.where(chosen[self.of] & (self.of >= 0), self.of, -1) if len(chosen) else self.of

    def extend(self) -> None:
        """Go on to phrases a word longer, whose front and back are both kept."""
        front, back = self.of[:-1], self.of[1:]
        at = np.flatnonzero((front >= 0) & (back >= 0) & (self.piece[:-1] == self.piece[1:]))
        before, last = self.hash, at + self.length
        key = (self.of[at] << 32) | self.word[last]
        of = self.of
        self.length += 1
        self._count(at, key)
        self.hash = _mix(before[of[self.first]], self.word_hash[self.word[self.first + self.length - 1]])

    def texts(self, chosen: np.ndarray) -> tuple[list[str], list[str]]:
        """Language and words of the chosen distinct phrases."""
        at = self.first[chosen]
        parts = [self.names.take(pa.array(self.word[at + k])) for k in range(self.length)]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if self.length > 1 else parts[0]
        return self.langs[self.lang_of_text[self.text_of[at]]].tolist(), joined.cast(pa.large_string()).to_pylist()


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[Phrases]:
    for some in slices(batches, "text", SLICE_BYTES):
        yield Phrases(some.column("lang").to_pylist(), some.column("text").to_pylist())


def _of_lengths(found: Phrases, longest: int, filters: list[Filter]) -> Iterator[Phrases]:
    """The phrases at each length whose parts pass the filters of the rounds before (the last filter serves all longer ones)."""
    while True:
        yield found
        if found.length >= longest:
            return
        if found.length <= len(filters):
            found.keep(filters[found.length - 1].has(found.hash))
        found.extend()


# ----------------------------------------------------------------- Misra-Gries summaries
def _added_up(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with the sums of their counts."""
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, dtype=np.int64)
    return h[first], np.add.reduceat(c, first) if len(first) else c


class MisraGries:
    """Counts that are at most `short` too low, in at most `capacity` counters. Adding counts and merging are the same."""

    def __init__(self, capacity: int):
        self.capacity, self.short = capacity, 0
        self.hashes, self.counts = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.n_waiting += len(hashes)
        if self.n_waiting > self.capacity:
            self.merge()

    def merge(self) -> None:
        if not self.waiting:
            return
        hashes, counts = _added_up([self.hashes, *(h for h, _ in self.waiting)], [self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.n_waiting = [], 0
        if len(counts) > self.capacity:
            less = int(np.partition(counts, -self.capacity - 1)[-self.capacity - 1])
            self.short += less
            hashes, counts = hashes[counts > less], counts[counts > less] - less
        self.hashes, self.counts = hashes, counts

    def reaching(self, threshold: int) -> np.ndarray:
        """Hashes that may have been counted `threshold` times."""
        self.merge()
        return self.hashes[self.counts + self.short >= threshold]


def _packed(hashes: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """The lowest `SENT` bytes of each hash, and the counts (at least one) in as few bytes as the highest needs."""
    low = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT]
    return low.tobytes(), counts.astype(np.min_scalar_type(int(counts.max()))).tobytes()


def _unpacked(hashes: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    low = np.frombuffer(hashes, dtype=np.uint8).reshape(-1, SENT)
    wide = np.zeros((len(low), 8), dtype=np.uint8)
    wide[:, :SENT] = low
    return wide.view("<u8").ravel(), np.frombuffer(counts, dtype=f"<u{len(counts) // len(low)}").astype(np.int64)


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Hash partition of a phrase."""
    return ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _survivors(texts: DataFrame, threshold: int, shortest: int, longest: int, filters: list[Filter], parts: int) -> DataFrame:
    """Hashes (h, their lowest `SENT` bytes) of the phrases of some lengths that may reach the threshold; none that does is missing."""

    def rows(summed: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        h, c = summed
        part = _part(h, parts)
        order = np.argsort(part, kind="stable")
        h, c, part = h[order], c[order], part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else np.zeros(0, dtype=np.int64)
        ends = np.r_[cuts[1:], len(part)]
        packed = [_packed(h[a:b], c[a:b]) for a, b in zip(cuts, ends)]
        return pa.RecordBatch.from_pydict({
            "part": pa.array(part[cuts], pa.int64()),
            "mass": pa.array([int(c[a:b].sum()) for a, b in zip(cuts, ends)], pa.int64()),
            "hashes": pa.array([x for x, _ in packed], pa.binary()),
            "counts": pa.array([x for _, x in packed], pa.binary()),
        })

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A task's counts are added up over its slices before they go out, as far as a bounded buffer reaches."""
        hashes, counts, held = [], [], 0
        for some in _phrases(batches):
            for found in _of_lengths(some, longest, filters):
                if found.length >= shortest:  # only phrases whose own parts passed get here; of single words, all
                    hashes.append(found.hash)
                    counts.append(found.count)
                    held += len(found.hash)
            if held > HELD:
                summed = _added_up(hashes, counts)
                if len(summed[0]) > HELD // 2:
                    yield rows(summed)
                    summed = summed[0][:0], summed[1][:0]
                hashes, counts, held = [summed[0]], [summed[1]], len(summed[0])
        if held:
            yield rows(_added_up(hashes, counts))

    counted = texts.mapInArrow(count, "part long, mass long, hashes binary, counts binary")
    # Each row gets the mass of its whole partition, as it says how many counters are needed.
    whole = F.sum("mass").over(Window.partitionBy("part"))
    dealt = counted.repartition(parts, "part").select("part", whole.alias("mass"), "hashes", "counts")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a partition follow each other."""
        summary, at = None, None
        for batch in batches:
            for part, mass, hashes, counts in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if part != at:
                    if summary is not None:
                        yield _as_batch(summary.reaching(threshold))
                    summary, at = MisraGries(mass // threshold + 1), part
                summary.add(*_unpacked(hashes, counts))
        if summary is not None:
            yield _as_batch(summary.reaching(threshold))

    return dealt.mapInArrow(fold, "h long")


def _as_batch(hashes: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"h": pa.array(hashes.view(np.int64), pa.int64())})


# ------------------------------------------------------------------------------ operator
def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", threshold: int = 100, longest: int = LONGEST) -> DataFrame:
    """(lang, n_words, phrase, f) of every phrase of 1 to `longest` words that occurs `threshold` times or more in a language.

    A-Z is lowered, texts are cut into pieces at `.,;:!?` and line ends, and pieces into words at spaces and tabs; phrases lie
    within a piece, and overlapping occurrences all count. A null text is empty, a null language `und`.
    Repeated rows count again; empty tables give no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word takes two bytes at least, so this many partitions hold all occurrences of one length with the counters laid out.
    tasks, least = int(spark.conf.get("spark.sql.shuffle.partitions")), size // 2 // (threshold * COUNTERS) + 1
    parts = max(4 * tasks, least)
    filters: list[Filter] = []
    for shortest, upto in ((1, 1), (2, 2), (3, longest)):
        if shortest <= longest:
            filters.append(Filter(_survivors(texts, threshold, shortest, min(upto, longest), filters, parts), "h"))

    parts = max(tasks, least)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0
        for some in _phrases(batches):
            for found in _of_lengths(some, longest, [*filters, *filters[-1:] * longest]):
                chosen = np.flatnonzero(filters[min(found.length, len(filters)) - 1].has(found.hash))
                langs, phrases = found.texts(chosen)
                columns = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(found.hash[chosen]), pa.array(found.count[chosen], pa.int64())]
                held.append(pa.Table.from_arrays(columns, names=["lang", "phrase", "h", "f"]))
                n_held += len(chosen)
            if n_held > HELD // 2:
                summed = _added_up_rows(held)
                if summed.num_rows > HELD // 4:
                    yield _packed_rows(summed, parts)
                    summed = summed.slice(0, 0)
                held, n_held = [summed], summed.num_rows
        if n_held:
            yield _packed_rows(_added_up_rows(held), parts)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All counts of a phrase meet here. Where the distinct phrases are more than a task holds, some go on in several counts."""
        held, n_held = [], 0
        for some in slices(batches, "phrases", SLICE_BYTES):
            held.append(_unpacked_rows(some))
            n_held += held[-1].num_rows
            if n_held > HELD:
                summed = _added_up_rows(held)
                if summed.num_rows > HELD // 2:
                    yield from _as_counts(summed)
                    summed = summed.slice(0, 0)
                held, n_held = [summed], summed.num_rows
        if n_held:
            yield from _as_counts(_added_up_rows(held))

    dealt = texts.mapInArrow(exact, "part long, lang string, phrases string, counts binary").repartition(parts, "part")
    counted = dealt.mapInArrow(add_up, "lang string, n_words int, phrase string, f long")
    return counted.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f")).filter(F.col("f") >= threshold)


def _added_up_rows(tables: list[pa.Table]) -> pa.Table:
    """Distinct phrases (lang, phrase) with the sums of their counts f, and the hash h where the tables have it."""
    keys, others = ["lang", "phrase"], tables[0].column_names[2:]
    summed = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([(c, "sum" if c == "f" else "min") for c in others])
    return summed.select([*keys, *(f"{c}_{'sum' if c == 'f' else 'min'}" for c in others)]).rename_columns([*keys, *others])


def _packed_rows(summed: pa.Table, parts: int) -> pa.RecordBatch:
    """A row per hash partition and language, with all its phrases, a line each, and their counts. No word holds a line end."""
    part = _part(summed["h"].to_numpy(), parts)
    lang = pc.dictionary_encode(summed["lang"].combine_chunks())
    of = lang.indices.to_numpy()
    order = np.lexsort((of, part))
    part, of, f = part[order], of[order], summed["f"].to_numpy()[order].astype("<i8")
    phrases = summed["phrase"].take(pa.array(order)).to_pylist()
    cuts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (of[1:] != of[:-1])])
    ends = np.r_[cuts[1:], len(part)]
    return pa.RecordBatch.from_pydict({
        "part": pa.array(part[cuts], pa.int64()),
        "lang": lang.dictionary.take(pa.array(of[cuts])),
        "phrases": pa.array(["\n".join(phrases[a:b]) for a, b in zip(cuts, ends)], pa.string()),
        "counts": pa.array([f[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
    })


def _unpacked_rows(packed: pa.RecordBatch) -> pa.Table:
    lists = pc.split_pattern(packed.column("phrases"), "\n")
    langs = packed.column("lang").take(pc.list_parent_indices(lists))
    counts = np.frombuffer(b"".join(packed.column("counts").to_pylist()), dtype="<i8")
    return pa.Table.from_arrays([langs, pc.list_flatten(lists), pa.array(counts, pa.int64())], names=["lang", "phrase", "f"])


def _as_counts(summed: pa.Table) -> list[pa.RecordBatch]:
    n_words = pc.add(pc.count_substring(summed["phrase"], " "), 1).cast(pa.int32())
    return summed.add_column(1, "n_words", n_words).to_batches(HELD // 16)


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n): all word occurrences of each language; the languages without a word are left out."""
    words = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    lang = F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang")
    return docs.select(lang, words.cast("long").alias("words")).groupBy("lang").agg(F.sum("words").alias("n")).filter("n > 0")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    threshold: int = 100,
    longest: int = LONGEST,
    share: int = 100,
    best: int | None = 2000,
) -> DataFrame:
    """The phrases of two words and more whose words belong together, per language, best first.

    A phrase that occurs a times is cut in two where that scores lowest, `floor(1000 * a * n / (l * r))` with l and r
    occurrences of the parts and n words in the language; equal scores are cut at the first place. Dropped are phrases that lie
    inside a longer frequent one with at least `share` percent of their occurrences. Ranks go by score and
    a, both falling, then by the phrase's bytes; `best` ends each language's list (None: never). Products are exact up to 38 digits.
    Inputs are treated as in `frequent_phrases`.
    """
    counts = land(frequent_phrases(docs, text_col, lang_col, threshold, longest), "phrases")
    totals = word_totals(docs, text_col, lang_col)
    candidates = counts.filter("n_words > 1")
    part = counts.select("lang", F.col("phrase").alias("part"), "f")
    k = F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), "n_words", k).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - n_words)").alias("rest"),
    )
    scored = (
        cut.join(part.toDF("lang", "first", "l"), ["lang", "first"])
        .join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
        .join(totals, "lang")
        .selectExpr(
            "lang", "phrase", "a", "n", "k", "l", "r",
            "(1000 * CAST(a AS DECIMAL(20, 0)) * CAST(n AS DECIMAL(15, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0))) AS score",
        )
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    )
    # Each step to a longer phrase can only lose occurrences, so a phrase inside a longer one is inside one a word longer.
    fronts = candidates.filter("n_words > 2")
    front, back = "substring_index(phrase, ' ', n_words - 1)", "substring_index(phrase, ' ', 1 - n_words)"
    inside = fronts.selectExpr("lang", f"explode(array({front}, {back})) AS phrase", "f")
    longer = inside.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(
        f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(30, 0)) < {share} * CAST(a AS DECIMAL(30, 0))"
    )
    row = left.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = row.withColumn("rank", F.row_number().over(order))
    ranked = ranked if best is None else ranked.filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
