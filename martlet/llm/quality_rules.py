"""Quality rules of a text, among them repetition found with a suffix array.

The words of a text are a sequence of numbers. Prefix doubling sorts its suffixes: ranks by the first
word, then by pairs of ranks 1, 2, 4, ... places apart, until every suffix stands alone. Longest
common prefixes of neighbours come from the ranks kept of each round. A suffix's longest prefix
that occurs elsewhere is the larger of the two beside it: the LCP intervals of these lengths are the
maximal repeated substrings, and the union of their spans is what repetition covers.
Many texts are sorted at once; the number of the text is part of the first rank.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.llm.common import slices

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Rules:
    """Limits. A text fails the base rules by too few words or too many in repeated windows, and the
    repetition rule if repeats of at least `min_repeat` words cover more than `most_covered_percent` of it, or one repeat is
    longer than `longest_percent` of its words (and than `longest_words`). Both lie well below what the base rules let pass. A line of a
    site's frame at the top and the bottom of a text is shorter than `min_repeat` and no fault."""

    min_words: int = 10
    window: int = 5
    most_repeat_percent: int = 20
    min_repeat: int = 10
    most_covered_percent: int = 10
    longest_percent: int = 3
    longest_words: int = 10


def longest_repeats(words: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each place the length of the longest run of words from there that occurs at another place of its text.

    words: numbers of the words of all texts, one text after another; text: number of the text of each, ascending.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    key = text.astype(np.int64) * (int(words.max()) + 1) + words
    order = np.argsort(key, kind="stable")
    ranks = np.empty(n, dtype=np.int64)
    first = np.r_[True, np.diff(key[order]) != 0]
    ranks[order] = np.flatnonzero(first)[np.cumsum(first) - 1]  # rank: place of the class's first suffix in the array
    levels, length = [ranks.astype(np.int32)], 1
    suffixes = np.empty(n, dtype=np.int64)
    suffixes[:] = order
    alone = first & np.r_[first[1:], True]
    active = order[~alone]  # in the order of the array, class by class
    while len(active):
        ahead = active + length
        inside = ahead < n
        next_rank = np.full(len(active), -1, dtype=np.int64)
        next_rank[inside] = ranks[ahead[inside]]
        next_rank[inside] = np.where(text[ahead[inside]] == text[active[inside]], next_rank[inside], -1)
        old = ranks[active]
        key = old * (n + 1) + next_rank + 1
        order = np.argsort(key, kind="stable")
        active, key, old = active[order], key[order], old[order]
        first = np.r_[True, np.diff(key) != 0]
        class_first = np.r_[True, np.diff(old) != 0]
        in_class = np.arange(len(active)) - np.flatnonzero(class_first)[np.cumsum(class_first) - 1]
        places = old + in_class  # places in the suffix array
        ranks = ranks.copy()
        ranks[active] = places[first][np.cumsum(first) - 1]
        suffixes[places] = active
        levels.append(ranks.astype(np.int32))
        length *= 2
        alone = first & np.r_[first[1:], True]
        active = active[~alone]
    # Neighbours' common prefix: the highest level on which both still share a rank, then what follows it, and so on down.
    left, right = suffixes[:-1].copy(), suffixes[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    pairs = np.flatnonzero(levels[0][left] == levels[0][right])
    for k in range(len(levels) - 1, -1, -1):
        a, b = left[pairs], right[pairs]
        ok = (a < n) & (b < n)
        ok[ok] = levels[k][a[ok]] == levels[k][b[ok]]
        hit = pairs[ok]
        left[hit] += 1 << k
        right[hit] += 1 << k
        common[hit] += 1 << k
    longest = np.zeros(n, dtype=np.int64)
    longest[suffixes[1:]] = common
    longest[suffixes[:-1]] = np.maximum(longest[suffixes[:-1]], common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Places inside the span of some repeat of at least `least` words."""
    starts = np.flatnonzero(longest >= least)
    steps = np.zeros(len(longest) + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + longest[starts], -1)
    return np.cumsum(steps)[:-1] > 0


def measure(texts: list[str | None], rules: Rules) -> dict[str, np.ndarray]:
    """Columns of measures, one value per text."""
    seen: dict[bytes, int] = {}
    numbers, counts = [], np.zeros(len(texts), dtype=np.int64)
    out = {k: np.zeros(len(texts), dtype=np.int64) for k in ("word_chars", "n_symbols", "n_dup_lines")}
    for i, text in enumerate(texts):
        if not text:
            continue
        raw = text.encode()
        words = raw.split()
        counts[i] = len(words)
        numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words)))
        out["word_chars"][i] = len(text) - (len(raw) - len(raw.translate(None, BLANKS)))
        out["n_symbols"][i] = len(raw) - len(raw.translate(None, SYMBOLS))
        lines = [x for x in raw.split(b"\n") if x.strip()]
        out["n_dup_lines"][i] = len(lines) - len(set(lines))
    owner = np.repeat(np.arange(len(texts)), counts)
    longest = longest_repeats(np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64), owner)
    per_text = lambda flags: np.bincount(owner, weights=flags, minlength=len(texts)).astype(np.int64)
    out["n_words"] = counts
    out["n_repeat_words"] = per_text(covered(longest, rules.window))
    out["n_covered_words"] = per_text(covered(longest, rules.min_repeat))
    out["longest_repeat"] = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(out["longest_repeat"], owner, longest)
    out["base_failed"] = (counts < rules.min_words) | (100 * out["n_repeat_words"] > rules.most_repeat_percent * counts)
    repetitive = (100 * out["n_covered_words"] > rules.most_covered_percent * counts) | (
        (100 * out["longest_repeat"] > rules.longest_percent * counts) & (out["longest_repeat"] > rules.longest_words)
    )
    out["kept"] = ~out["base_failed"] & ~repetitive
    return out


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered_words long,"
    " longest_repeat long, base_failed boolean, kept boolean"
)


def rate(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """`record` (the columns `keep` of `docs`, all by default) and `measures` of the whole text, per row.

    A null or empty text has no words and fails. Repeated rows are rated alike. A text is sorted in one task,
    as it is one value; memory follows the longest text. An empty table gives no rows. Names cannot clash, as the
    columns of `docs` stay in `record`.
    """
    keep = docs.columns if keep is None else keep
    record = F.struct(*[F.col(f"`{c}`") for c in keep])
    held = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), record.alias("record"))
    kinds = StructType.fromDDL(MEASURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", 4 << 20):
            found = measure(part.column(0).to_pylist(), rules)
            fields = [pa.array(found[f.name], pa.bool_() if f.dataType.typeName() == "boolean" else pa.int64()) for f in kinds]
            measures = pa.StructArray.from_arrays(fields, names=kinds.fieldNames())
            yield pa.RecordBatch.from_arrays([part.column(1), measures], names=["record", "measures"])

    return held.mapInArrow(run, held.select("record").schema.add("measures", kinds))


def keep_good(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """`docs` without the rows whose text fails the rules; cases as in `rate`."""
    return rate(docs, None, text_col, rules).filter("measures.kept").select("record.*")


def quality_digest(docs: DataFrame) -> DataFrame:
    return rate(docs, ["doc_id"]).select("record.doc_id", "measures.*").drop("longest_repeat")
