"""Spelling variant grouping: words one edit apart, found by walking a relational trie level by level.

The words are kept as tries in tables, one read forwards and one backwards, without the nodes that neither branch nor end a word
nor start a walk. A state (word, position, node, edits) says that the word up to the position leads to the node with so many edits.
Each level joins the states with the edges below their nodes; a state with one edit goes on along equal characters only, and
a state whose word is used up at the end of another word is a neighbour.

An edit lies in a word's second half or, read backwards, in the second half again. So a walk starts at the node of the word's
own first half, with no edit made: the bushy top of the trie, which all words would meet in, is never walked.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import land

# Fixed values of the word contract: letters of Latin-1 (which are one byte each there), and how words are altered.
RUN = re.compile(rb"[a-z\xC0-\xFF]+")
ALTERED_EVERY = 97
WORDS_AT_ONCE = 1 << 18


# ------------------------------------------------------------------------------- words
def _altered(doc_id: object, runs: Counter) -> Iterator[tuple[bytes, int]]:
    """Runs of a document with their counts; one character is missing where the run's checksum says so."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        checksum = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), head)
        if checksum % ALTERED_EVERY == 0:
            at = checksum % len(run)
            run = run[:at] + run[at + 1 :]
        yield run, n


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the words of `shortest` characters and more that occur `least` times or more in all texts together.

    Words are the maximal runs of letters `A-Za-z\\u00C0-\\u00FF`, A-Z lowered, and spelling slips are planted into them: where 97 divides
    the checksum of document and run, that document's run misses a character. A null id counts as an empty one, a null or empty text has
    no words, repeated rows count again.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Whatever Latin-1 does not have becomes "?", which no word has either.
                runs = RUN.findall((text.as_py() or "").encode("latin-1", "replace").lower())
                for word, n in _altered(doc_id, Counter(runs)):
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) > WORDS_AT_ONCE:
                    yield _counted(total)
                    total = Counter()
        yield _counted(total)

    parts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _counted(total: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in total], pa.string())
    return pa.RecordBatch.from_pydict({"word": words, "n": pa.array(list(total.values()), pa.int64())})


# -------------------------------------------------------------------------------- trie
def _nodes_of_words(words: DataFrame) -> DataFrame:
    """(way, word, pos, node, next) for both ways of reading: the nodes of a word from its middle on, and the character after each.

    Backwards, `word` is reversed. A node is known by a hash of its way and characters; should two share one, walks
    find too much, which the last check of every pair takes out again.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in range(0, batch.num_rows, 20_000):
                out: tuple[list, ...] = ([], [], [], [], [])
                for word in batch.column(0)[some : some + 20_000].to_pylist():
                    for way, read, start in ((0, word, len(word) // 2), (1, word[::-1], len(word) - len(word) // 2)):
                        state = xxhash.xxh64(seed=way)
                        for pos, char in enumerate(read):
                            if pos >= start:
                                _add(out, way, read, pos, state.intdigest(), char)
                            state.update(char.encode())
                        _add(out, way, read, len(read), state.intdigest(), None)
                kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], ["way", "word", "pos", "node", "next"])

    return words.select("word").mapInArrow(spell, "way int, word string, pos int, node long, next string")


def _add(out: tuple[list, ...], way: int, word: str, pos: int, node: int, char: str | None) -> None:
    for column, value in zip(out, (way, word, pos, node - (1 << 64) if node >> 63 else node, char)):
        column.append(value)


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(starts, edges, ends) of the tries over `words`, which are distinct.

    starts: (way, word, pos, node), where each word's walk begins. edges: (node, child, label), one or more characters long. ends: (node, other),
    the word that ends at a node.
    """
    nodes = land(_nodes_of_words(words), "trie-nodes")
    length = F.length("word")
    start = F.when(F.col("way") == 0, F.floor(length / 2)).otherwise(length - F.floor(length / 2)).cast("int")
    is_start = F.col("pos") == start
    kinds = nodes.groupBy("node").agg(
        F.min("next").alias("least"), F.max("next").alias("most"), F.bool_or(F.col("next").isNull() | is_start).alias("fixed")
    )
    kept = kinds.filter("fixed OR least < most").select("node")
    on_path = nodes.join(land(kept, "trie-kept"), "node").groupBy("way", "word").agg(
        F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("path")
    )
    step = F.explode(F.sequence(F.lit(0), F.size("path") - 2)).alias("i")
    steps = on_path.filter(F.size("path") > 1).select("word", "path", step)
    edges = steps.selectExpr(
        "path[i].node AS node", "path[i + 1].node AS child", "substring(word, path[i].pos + 1, path[i + 1].pos - path[i].pos) AS label"
    ).distinct()
    starts = nodes.filter(is_start).select("way", "word", "pos", "node")
    ends = nodes.filter(F.col("next").isNull()).select("node", F.col("word").alias("other"))
    return starts, land(edges, "trie-edges"), land(ends, "trie-ends")


# -------------------------------------------------------------------------------- walk
# What an edge makes of a state, where `rest` is what is left of the word and m the length of the label. An edit is a
# replacement by a character that comes later, or a missing character, so each pair of words is found from one side.
_OUTCOMES = """
    CASE
        WHEN startswith(rest, label) THEN named_struct('pos', pos + m, 'edits', edits)
        WHEN edits = 0 AND length(rest) >= m AND levenshtein(left(rest, m), label, 1) = 1 AND left(rest, m) < label
            THEN named_struct('pos', pos + m, 'edits', 1)
    END
"""
_SHORTER = """
    CASE
        WHEN edits = 0 AND NOT startswith(rest, label) AND length(rest) > m AND levenshtein(left(rest, m + 1), label, 1) = 1
            THEN named_struct('pos', pos + m + 1, 'edits', 1)
    END
"""


def _next_level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one edge further down. A node has at most one edge per letter, so a state meets a bounded number of them."""
    met = states.join(edges, "node").selectExpr(
        "way", "word", "pos", "child AS node", "edits", "label", "length(label) AS m", "substring(word, pos + 1) AS rest"
    )
    both = met.selectExpr("way", "word", "node", f"explode(array({_OUTCOMES}, {_SHORTER})) AS s")
    return both.filter("s IS NOT NULL").select("way", "word", "s.pos", "node", "s.edits")


def _arrived(states: DataFrame, ends: DataFrame) -> DataFrame:
    """(way, word, other) of the states whose words are used up, or but for one character that is then the edit."""
    done = states.filter(F.length("word") + F.col("edits") - F.col("pos") == 1)
    return done.join(ends, "node").select("way", "word", "other")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near) both ways for all of `words` (distinct, two characters or more) that are one edit apart.

    A level is landed before the next: a lost executor costs part of one level. There are as many levels as nodes that
    branch or end a word follow each other below a word's middle. The arrivals of all levels are looked up together in the
    end, from the landed levels, so the ends of words are shuffled once.
    """
    starts, edges, ends = trie(words)
    states = land(starts.withColumn("edits", F.lit(0)), "trie-states")
    found = []
    while states.limit(1).count():
        found.append(_arrived(states, ends))
        states = land(_next_level(states, edges), "trie-states")
    pairs = found[0] if found else states.join(ends, "node").select("way", "word", "other")
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    read = [F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "other")]
    exact = land(pairs.select(*read).filter(F.levenshtein("word", "other", 1) == 1).distinct(), "near-words")
    there = exact.select("word", F.col("other").alias("near"))
    return there.unionByName(exact.select(F.col("other").alias("word"), F.col("word").alias("near")))


# ------------------------------------------------------------------------------ operator
def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms are followed to the last. A form is more frequent than its word, so there are no circles."""
    jump = land(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = jump.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        last, moved = F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        further = land(jump.join(ahead, "root", "left").select("word", last, moved), "roots")
        jump = further.select("word", "root")
        if not further.filter("moved").limit(1).count():
            return jump


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5, least: int = 3, ratio: int = 2
) -> DataFrame:
    """Per word of the corpus: form, root, n, n_near, form_n.

    Words are those of `corpus_words`. Near words differ by one character that is inserted, deleted or replaced. A word's form is the near
    word with the most occurrences (ties: the first in code-point order) if it has `ratio` times the word's or more; the root is
    where forms lead in the end. A word without a form has null there and is its own root. An empty table gives no rows.
    """
    words = land(corpus_words(docs, id_col, text_col, shortest, least), "words")
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "best.form", (-F.col("best.less")).alias("form_n")
    )
    is_form = F.col("form_n") >= ratio * F.col("n")
    formed = land(joined.withColumns({c: F.when(is_form, F.col(c)) for c in ("form", "form_n")}), "forms")
    roots = with_roots(formed.filter("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
