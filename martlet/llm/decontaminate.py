"""Benchmark decontamination by Wu-Manber search for many patterns at once.

Texts become lower-case words, one blank around each. The patterns are the benchmark's windows of words
in the same form. A pattern is known by its first m bytes, m being the shortest length in its class.
The search looks at the block of B bytes that ends at a place: the shift table says how far the
place can move on without missing a pattern, zero where some pattern's m bytes end with that block.
There the block's bucket names the patterns, and comparing them with the text confirms.
All texts of a slice are searched side by side, cut into lanes that advance together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from martlet.llm.common import land, slices, spans_union

# Words are runs of ASCII letters and digits and of all that is not ASCII; the rest separates. A-Z become a-z.
NORMAL = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
LANE = 4096
HASH_BITS = 20
FOUND = pa.struct(
    [("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.string()))]
)


def normal(text: str | None) -> bytes:
    """Words of a text, a blank before, between and after them; a single blank if there are none."""
    return b" " + b"".join(w + b" " for w in text.encode().translate(NORMAL).split()) if text else b" "


def windows(text: str | None, width: int) -> list[bytes]:
    """Windows of `width` words, each with blanks around it; the whole text if it has fewer words but some."""
    words = normal(text).split()
    if not words:
        return []
    last = max(1, len(words) - width + 1)
    return [b" " + b" ".join(words[i : i + width]) + b" " for i in range(last)]


class WuManber:
    """Search for byte strings; those of very different lengths are searched for in classes, so short ones slow no other."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = sorted(set(patterns))
        self.classes = []
        by_class: dict[int, list[int]] = {}
        for i, p in enumerate(self.patterns):
            by_class.setdefault(min(len(p).bit_length(), 6), []).append(i)
        for members in by_class.values():
            self.classes.append(self._tables(members))

    @staticmethod
    def _hash(blocks: np.ndarray, block: int) -> np.ndarray:
        """Hash of the last `block` bytes of 64-bit words that end at a place."""
        kept = blocks >> np.uint64(64 - 8 * block) if block < 8 else blocks
        return (kept * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - HASH_BITS)

    def _tables(self, members: list[int]):
        m = min(min(len(self.patterns[i]) for i in members), 256)
        block = min(8, max(1, m // 2))
        heads = np.frombuffer(b"".join(b"\0" * 8 + self.patterns[i][:m] for i in members), dtype=np.uint8).reshape(-1, m + 8)
        shift = np.full(1 << HASH_BITS, m - block + 1, dtype=np.uint16)
        for end in range(block, m + 1):
            blocks = np.ascontiguousarray(heads[:, end : end + 8]).view("<u8")[:, 0]
            np.minimum.at(shift, self._hash(blocks, block), m - end)
            if end == m:
                last = blocks
        buckets: dict[int, list[int]] = {}
        for i, suffix in zip(members, (last >> np.uint64(64 - 8 * block) if block < 8 else last).tolist()):
            buckets.setdefault(suffix, []).append(i)
        return m, block, shift, buckets

    def search(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(place of the first byte, pattern number) of every occurrence, in no order."""
        data = np.frombuffer(b"\0" * 8 + text, dtype=np.uint8)
        words = np.lib.stride_tricks.as_strided(
            np.frombuffer(data.tobytes() + b"\0" * 8, dtype="<u8", count=1), shape=(len(text) + 1,), strides=(1,)
        )  # words[e]: the 8 bytes of the text that end before place e
        for m, block, shift, buckets in self.classes:
            # A lane looks at ends in its own stretch; a place near its start reads back into the one before.
            at = np.arange(m, len(text) + 1, LANE)
            stop = np.minimum(at + LANE, len(text) + 1)
            found = []
            while len(at):
                seen = words[at]
                step = shift[self._hash(seen, block)]
                if (step == 0).any():
                    found.append(at[step == 0])
                at = at + np.maximum(step, 1)
                live = at < stop
                if not live.all():
                    at, stop = at[live], stop[live]
            if not found:
                continue
            ends = np.concatenate(found)
            kept = words[ends] >> np.uint64(64 - 8 * block) if block < 8 else words[ends]
            for end, suffix in zip(ends.tolist(), kept.tolist()):
                for i in buckets.get(suffix, ()):
                    if text.startswith(self.patterns[i], end - m):
                        yield end - m, i


def find_hits(docs: DataFrame, items: list[tuple], width: int, text_col: str) -> DataFrame:
    """Add to rows of `record` and `found` what one block of benchmark items hits in the record's text.

    found: n_words, spans of hit words (start, end) as disjoint ascending lists, and the ids of the items hit.
    """
    position = docs.schema["record"].dataType.fieldNames().index(text_col)
    schema = docs.select("record").schema.add("found", from_arrow_type(FOUND))
    owners: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for w in windows(text, width):
            owners.setdefault(w, set()).add("" if item_id is None else str(item_id))
    shared = docs.sparkSession.sparkContext.broadcast(owners) if owners else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owned = shared.value if shared else {}
        matcher = WuManber(list(owned))
        n_in = [len(p.split()) for p in matcher.patterns]
        item_of = [owned[p] for p in matcher.patterns]
        for batch in batches:
            record = batch.column(0)
            texts = record.field(position)
            named = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), texts], names=["row", "text"])
            rows = [None] * len(texts)
            for part in slices(iter([named]), "text"):
                bodies = [normal(t) for t in part.column(1).to_pylist()]
                for row, one in zip(part.column(0).to_pylist(), _hits(matcher, n_in, item_of, bodies)):
                    rows[row] = one
            if batch.schema.get_field_index("found") >= 0:
                rows = [_merged(old, new) for old, new in zip(batch.column(1).to_pylist(), rows)]
            yield pa.RecordBatch.from_arrays([record, pa.array(rows, FOUND)], names=["record", "found"])

    return docs.mapInArrow(run, schema)


def _hits(matcher: WuManber, n_in: list[int], item_of: list[set], bodies: list[bytes]) -> Iterator[dict]:
    """Search texts that each start and end with a blank, all in one string."""
    text = b"".join(bodies)
    bounds = np.cumsum([0] + [len(b) for b in bodies])
    at, which = [], []
    for place, pattern in matcher.search(text):
        at.append(place)
        which.append(pattern)
    at, which = np.array(at, dtype=np.int64), np.array(which, dtype=np.int64)
    owner = np.searchsorted(bounds, at, side="right") - 1
    # A match across two texts would hold two blanks in a row, which no pattern does.
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(len(bodies) + 1))
    for i, body in enumerate(bodies):
        mine = order[cuts[i] : cuts[i + 1]]
        n_words = body.count(b" ") - 1
        if not len(mine):
            yield {"n_words": n_words, "starts": [], "ends": [], "item_ids": []}
            continue
        blanks = np.cumsum(np.frombuffer(body, dtype=np.uint8) == 0x20)
        starts = blanks[at[mine] - bounds[i]] - 1
        starts, ends = spans_union(starts, starts + np.array([n_in[p] for p in which[mine].tolist()]))
        items = set().union(*(item_of[p] for p in set(which[mine].tolist())))
        yield {"n_words": n_words, "starts": starts.tolist(), "ends": ends.tolist(), "item_ids": sorted(items)}


def _merged(old: dict, new: dict) -> dict:
    starts, ends = spans_union(np.array(old["starts"] + new["starts"], dtype=np.int64), np.array(old["ends"] + new["ends"], dtype=np.int64))
    items = sorted({*old["item_ids"], *new["item_ids"]})
    return {"n_words": new["n_words"], "starts": starts.tolist(), "ends": ends.tolist(), "item_ids": items}


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The benchmark's items in blocks of about `most` bytes of text, streamed to the driver one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(f"`{id_col}`", f"`{text_col}`").toLocalIterator():
        block.append((row[0], row[1]))
        size += len((row[1] or "").encode())
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """Per document `record` and `found`: n_words, hit spans of words (starts, ends), and ids of the items found.

    The benchmark is a stated set of queries: all its windows are searched for in all documents, in blocks of items of
    at most `block_bytes` of text (or one longer item), which bounds what is broadcast; each further block is another
    pass over the landed result of the one before. An item of fewer than `width` words, but not none, is one window.
    Null or empty texts have no words and no windows. An item without an id is named by the empty string; repeated items
    and rows are handled each as it comes. An empty benchmark gives no hits, an empty table no rows. `keep`: the columns
    of `docs` to carry besides the text (all by default); they stay in `record`, so names cannot clash.
    """
    names = docs.columns if keep is None else [*dict.fromkeys([*keep, text_col])]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("record"))
    blocks = item_blocks(benchmark, item_id_col, item_text_col, block_bytes)
    found = find_hits(found, next(blocks, []), width, text_col)
    for block in blocks:
        found = find_hits(land(found, "decontamination"), block, width, text_col)
    return found


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """`docs` without the rows in which a window of the benchmark occurs; cases as in `decontaminate`."""
    return decontaminate(docs, benchmark, width).filter(F.size("found.starts") == 0).select("record.*")


def decontamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = decontaminate(docs, benchmark, keep=["doc_id"])
    hit = F.aggregate(F.zip_with("found.ends", "found.starts", lambda e, s: e - s), F.lit(0).cast("long"), lambda a, n: a + n)
    return found.select(
        "record.doc_id",
        "found.n_words",
        hit.alias("n_hit"),
        F.size("found.item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.item_ids"), 256).alias("items_sha256"),
        (F.size("found.starts") > 0).alias("contaminated"),
    )
