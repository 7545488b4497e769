"""SimHash near-dedup: fingerprints, a binary trie self-join for near pairs, components.

Fingerprints of equal texts are equal, so the join works on distinct fingerprints. They form a
binary trie; the join walks pairs of nodes together from the root, adds up differing bits, and
drops a pair once it has more than the allowed distance. The first levels of the walk are
done by routing: a fingerprint goes to every pair of subtrees that its own subtree is in and
that differ in at most `distance` bits. Each task walks on below its pairs of subtrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import land, slices
from martlet.llm.components import components

SEED = 42
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of word shingles: a bit is set if it is set in over half of their XXH64 hashes."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    hash_of = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_of(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    cuts = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([hash_of(line[a:b], SEED) for a, b in cuts], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), ROWS_AT_ONCE):
        some = hashes[at : at + ROWS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text_col: str, shingle: int, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of `docs` as one struct `record`, and the text's fingerprint `fp` as a signed number."""
    record = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)])
    held = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), record.alias("record"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [fingerprint(t, shingle) for t in part.column(0).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(signed)], names=["record", "fp"])

    return held.mapInArrow(run, held.select("record").schema.add("fp", "long"))


# ----------------------------------------------------------------------- trie self-join
def _subtree_depth(distinct: int, per_subtree: int = 2000) -> int:
    """Levels routed before tasks walk on: the subtrees grow in number with the fingerprints, not in size."""
    return min(24, max(0, (max(1, distinct) // per_subtree).bit_length()))


def _near_masks(depth: int, distance: int) -> list[int]:
    """Every number of `depth` bits with at most `distance` of them set."""
    masks = {0}
    for _ in range(distance):
        masks |= {m ^ (1 << b) for m in masks for b in range(depth)}
    return sorted(masks)


def walk(a: np.ndarray, b: np.ndarray, depth: int, distance: int, same: bool, most: int = 1 << 18) -> Iterator[tuple]:
    """Pairs of indexes into sorted `a` and `b` whose numbers differ in at most `distance` bits.

    Each of `a` and `b` is a trie node at `depth`: its numbers share their first `depth` bits. A frontier
    holds node pairs of one level as index ranges; long frontiers are halved, so memory stays bounded.
    same: both are the same node, and only pairs (i, j) with i < j are wanted.
    """
    first = np.array([[0, len(a), 0, len(b)]], dtype=np.int64)
    todo = [(depth, first)] if len(a) and len(b) else []
    while todo:
        depth, nodes = todo.pop()
        if len(nodes) > most:
            half = len(nodes) // 2
            todo += [(depth, nodes[half:]), (depth, nodes[:half])]
            continue
        # Prune: bits seen so far that differ. Nodes of up to 4 x 4 numbers are compared directly.
        prefix = np.uint64(0) if depth == 0 else ~np.uint64(0) << np.uint64(64 - depth)
        differ = np.bitwise_count((a[nodes[:, 0]] ^ b[nodes[:, 2]]) & prefix)
        nodes = nodes[differ <= distance]
        sizes_a, sizes_b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
        small = ((sizes_a <= 4) & (sizes_b <= 4)) | (depth == 64)
        if small.any():
            yield from _compare(a, b, nodes[small], distance, same, most)
        nodes = nodes[~small]
        if not len(nodes):
            continue
        bit = np.uint64(1) << np.uint64(63 - depth)
        cut = ~np.uint64(0) << np.uint64(63 - depth)
        mid_a = np.searchsorted(a, (a[nodes[:, 0]] & cut) | bit)
        mid_b = np.searchsorted(b, (b[nodes[:, 2]] & cut) | bit)
        mid_a, mid_b = np.clip(mid_a, nodes[:, 0], nodes[:, 1]), np.clip(mid_b, nodes[:, 2], nodes[:, 3])
        halves_a = ((nodes[:, 0], mid_a), (mid_a, nodes[:, 1]))
        halves_b = ((nodes[:, 2], mid_b), (mid_b, nodes[:, 3]))
        below = np.concatenate([np.stack([*x, *y], axis=1) for x in halves_a for y in halves_b])
        below = below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3])]
        if same:
            below = below[below[:, 0] <= below[:, 2]]
        todo.append((depth + 1, below))


def _compare(a, b, nodes, distance, same, most) -> Iterator[tuple]:
    """All pairs below small node pairs (or below pairs of single full-depth nodes), by direct comparison."""
    sizes_a, sizes_b = nodes[:, 1] - nodes[:, 0], nodes[:, 3] - nodes[:, 2]
    work = np.cumsum(sizes_a * sizes_b)
    at = 0
    while at < len(nodes):
        end = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + most, side="right")))
        n, sb = nodes[at:end], sizes_b[at:end]
        count = sizes_a[at:end] * sb
        which = np.repeat(np.arange(len(n)), count)
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        i, j = n[which, 0] + inner // sb[which], n[which, 2] + inner % sb[which]
        near = np.bitwise_count(a[i] ^ b[j]) <= distance
        if same:
            near &= i < j
        yield i[near], j[near]
        at = end


class Forest:
    """Union-find over 0..n-1 that keeps only the links that join two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))
        self.links: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def add(self, xs: list[int], ys: list[int]) -> None:
        for x, y in zip(xs, ys):
            r, s = self.root(x), self.root(y)
            if r != s:
                self.parent[max(r, s)] = min(r, s)
                self.links.append((x, y))


def near_links(fps: DataFrame, distance: int, per_chunk: int = 20_000) -> DataFrame:
    """Links (a, b) between distinct 64-bit numbers of column `fp` that connect whatever differs in few bits.

    Of all pairs within the distance, each task gives a spanning forest: the components are those
    of all pairs, and a dense group gives as many links as it has members, not as many as pairs.
    """
    depth = _subtree_depth(fps.count())
    masks = _near_masks(depth, distance)
    top = F.shiftrightunsigned("fp", 64 - depth) if depth else F.lit(0).cast("long")
    keyed = fps.select("fp", top.alias("p"))
    # A subtree of very many fingerprints is split into chunks; every chunk meets every chunk of its partners.
    chunks = keyed.groupBy("p").agg(F.ceil(F.count("*") / per_chunk).cast("int").alias("chunks"))
    own = keyed.join(chunks, "p").withColumn("c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    partners = F.array(*[F.lit(m).cast("long") for m in masks])
    other = chunks.select(F.col("p").alias("q"), F.col("chunks").alias("q_chunks"))
    met = (
        own.select("fp", "p", "c", F.explode(partners).alias("mask"))
        .withColumn("q", F.col("p").bitwiseXOR(F.col("mask")))
        .join(other, "q")
        .select("fp", "p", "c", "q", F.explode(F.sequence(F.lit(0), F.col("q_chunks") - 1)).alias("d"))
    )
    here, there = F.struct(F.col("p").alias("p"), F.col("c").alias("c")), F.struct(F.col("q").alias("p"), F.col("d").alias("c"))
    blocks = met.select("fp", F.least(here, there).alias("lo"), F.greatest(here, there).alias("hi"), (here <= there).alias("is_lo"))

    def join(block: pd.DataFrame) -> pd.DataFrame:
        values = block["fp"].to_numpy().astype(np.int64).view(np.uint64)
        lo = block["is_lo"].to_numpy()
        same = bool(lo.all()) and block["same"].iloc[0]
        a = np.sort(values[lo])
        b = a if same else np.sort(values[~lo])
        if same:
            everything, of_a, of_b = a, np.arange(len(a)), np.arange(len(a))
        else:
            everything = np.concatenate([a, b])
            of_a, of_b = np.arange(len(a)), len(a) + np.arange(len(b))
        forest = Forest(len(everything))
        for i, j in walk(a, b, depth, distance, same):
            forest.add(of_a[i].tolist(), of_b[j].tolist())
        links = np.array(forest.links, dtype=np.int64).reshape(-1, 2)
        signed = everything.view(np.int64)
        return pd.DataFrame({"a": signed[links[:, 0]], "b": signed[links[:, 1]]})

    labelled = blocks.select(
        "fp", "is_lo", (F.col("lo") == F.col("hi")).alias("same"),
        F.col("lo.p").alias("p"), F.col("lo.c").alias("c"), F.col("hi.p").alias("q"), F.col("hi.c").alias("d"),
    )
    return labelled.groupBy("p", "c", "q", "d").applyInPandas(join, "a long, b long")


# ------------------------------------------------------------------------------ operator
def cluster(fps: DataFrame, distance: int, id_col: str) -> DataFrame:
    """(fp, component_id) for every distinct fingerprint; the component's id is the smallest document id in it."""
    reps = land(fps.groupBy("fp").agg(F.min(id_col).alias("rep")), "simhash-distinct")
    roots = components(near_links(reps.select("fp"), distance))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 2,
    keep: list[str] | None = None,
) -> DataFrame:
    """Per document its fingerprint (`fp`, signed) and `component_id`; `record` holds its columns `keep`, or all.

    Fingerprints at `distance` or fewer differing bits are linked; components are those of the links.
    Texts are lower-cased in A-Z and cut into words at ASCII white space; fewer words than a shingle give
    one shingle, none (null or empty text) fingerprint zero, which is linked like any other. A null id takes
    part, but never names its component unless there is no other; then that name is null. Repeated rows are
    all returned. An empty table gives no rows. Clashing names cannot arise, as the columns stay in `record`.
    """
    held = with_fingerprints(docs, text_col, shingle, [*dict.fromkeys([id_col, *(docs.columns if keep is None else keep)])])
    held = land(held, "simhash")
    ids = held.select("fp", F.col(f"record.`{id_col}`").alias("id"))
    return held.join(cluster(ids, distance, "id"), "fp").select("record", "fp", "root", "component_id")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 2
) -> DataFrame:
    """`docs` with one row of each component: the one with the smallest id, null last, ties by the whole row.

    Other cases are as in `simhash_components`. Of repeated rows one stays.
    """
    held = land(with_fingerprints(docs, text_col, shingle).withColumn("row", F.monotonically_increasing_id()), "simhash")
    ids = held.select("fp", "row", F.col(f"record.`{id_col}`").alias("id"), F.xxhash64("record").alias("h"))
    place = F.struct(F.col("id").isNull().alias("last"), "id", "h", "row")
    roots = cluster(ids, distance, "id").select("fp", "root")
    # One candidate per fingerprint crosses the join, one per component is kept.
    best = ids.groupBy("fp").agg(F.min(place).alias("place")).join(roots, "fp")
    kept = best.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias("row"))
    return held.join(kept, "row", "left_semi").select("record.*")


def simhash_digest(docs: DataFrame) -> DataFrame:
    found = simhash_components(docs, keep=["doc_id"])
    return found.select(
        F.col("record.doc_id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
