"""Line dedup over line-id sequences, in DataFrame functions only.

Every line start is a suffix of the sequence of line ids. Prefix doubling gives each suffix a rank by its
first line, then by its first 2, 4, ... lines, each from the ranks of the two halves. Ranks need
only tell equal prefixes from unequal ones here, so the rank of a class of suffixes is the first
place where it occurs. A class with two or more members at length h is an LCP interval of at least h
lines; a suffix alone in its class is settled and drops out, which leaves few after the first round.
The maximal repeated runs of at least `min_lines` lines are the unions of the intervals at that length,
so doubling stops there. A single line of many words counts as a run too, if asked for: the first round
already tells its class. Of each run the first copy stays and later copies go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import land

PLACE = ("last", "id", "h", "pos")


def _place() -> Column:
    """A line's place: documents by id, null last, then by text; lines by number."""
    return F.struct(*PLACE)


def _ranked(suffixes: DataFrame, *key: str) -> DataFrame:
    """Rank suffixes by `key`: the first place of their class. Suffixes alone in their class drop out.

    A frequent line is one key of an aggregate, done before the shuffle, and of an inner join. The classes are landed, so
    that the join shuffles both sides itself: only then does Spark split a skewed one.
    """
    classes = suffixes.groupBy(*key).agg(F.min(_place()).alias("rank"), F.count("*").alias("n")).filter("n > 1")
    return suffixes.join(land(classes.drop("n"), "classes"), list(key))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _long(line: Column, words: int) -> Column:
    """Whether a line has at least `words` words; possessive, so it never goes back over a line."""
    return F.rlike(line, F.lit(rf"^\s*+(?:\S++\s++){{{words - 1}}}\S"))


def repeated_runs(docs: DataFrame, min_lines: int, id_col: str, text_col: str, line_words: int | None = None) -> DataFrame:
    """Starts of runs that occur at an earlier place too: (id, h, pos, n), h being the text's hash, n the run's lines.

    Runs have `min_lines` lines, or one line of at least `line_words` words.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    held = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    hashed = F.transform(
        _lines(F.col("text")),
        lambda x: F.struct(
            F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), F.rlike(x, F.lit(r"[^ \t\n\x0B\f\r]")).alias("said"),
            (F.lit(False) if line_words is None else _long(x, line_words)).alias("long"),
        ),
    )
    lines = held.select("id", F.col("id").isNull().alias("last"), F.xxhash64("text").alias("h"), F.posexplode(hashed).alias("pos", "line"))
    # Rows with the same id and text are one document that is given repeatedly.
    suffixes = lines.groupBy(*PLACE).agg(*[F.first(f"line.{c}").alias(c) for c in ("a", "b", "said", "long")])
    level = land(_ranked(suffixes, "a", "b").select(*PLACE, "said", "long", "rank"), "lines")
    later = F.col("rank") < _place()
    single = level.filter(F.col("long") & later).select("id", "h", "pos", F.lit(1).alias("n"))
    length = 1
    while length < min_lines:
        step = min(length, min_lines - length)  # the last round may overlap its halves
        ahead = level.select(
            "last", "id", "h", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"), F.col("said").alias("said_next")
        )
        same = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in PLACE]
        pairs = level.alias("x").join(ahead.alias("y"), same).select(
            *[f"x.{c}" for c in PLACE], (F.col("said") | F.col("said_next")).alias("said"), F.col("rank").alias("own"), "next"
        )
        level = land(_ranked(pairs, "own", "next").select(*PLACE, "said", "rank"), "lines")
        length += step
    runs = level.filter(F.col("said") & later).select("id", "h", "pos", F.lit(min_lines).alias("n"))
    return runs if line_words is None else runs.unionByName(single)


def dedup_lines(
    docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text", line_words: int | None = None
) -> DataFrame:
    """`docs` as `record`, with `lines` (of the text), `kept` (numbers of the lines that stay) and `kept_text`.

    Lines are split at "\\n" and compared as they are, by a 128-bit hash. A run of at least `min_lines` lines, not all of them
    blank, that occurs at an earlier place of the corpus is deleted, and with `line_words` also a single line of at least so many
    words (between ASCII white space) that does, whatever its neighbours; a place comes by document id, null last, then
    by the text's hash, then by line. Runs may overlap: of a line repeated n times in a row the first stays. Repeated
    rows (same id and text) count as one document and come out alike. A null text stays null, an empty one
    has one blank line. An empty table gives no rows. Names cannot clash, as the columns stay in `record`.
    """
    starts = repeated_runs(docs, min_lines, id_col, text_col, line_words)
    gone = starts.groupBy("id", "h").agg(F.collect_list(F.struct("pos", "n")).alias("starts"))
    text = F.col(f"record.`{text_col}`").cast("string")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")).select(
        "record", F.col(f"record.`{id_col}`").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h")
    )
    on = [F.col("d.h") == F.col("g.h"), F.col("d.id").eqNullSafe(F.col("g.id"))]
    found = held.alias("d").join(gone.alias("g"), on, "left").select("record", "starts")
    deleted = F.flatten(F.transform("starts", lambda s: F.sequence(s["pos"], s["pos"] + s["n"] - 1)))
    lines = _lines(text)
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce(deleted, F.array().cast("array<int>")))
    kept_lines = F.transform("kept", lambda i: F.col("lines")[i])
    return (
        found.withColumn("lines", lines)
        .withColumn("kept", F.when(F.col("lines").isNotNull(), kept))
        .withColumn(
            "kept_text",
            F.when(F.col("starts").isNull(), text).when(F.col("lines").isNotNull(), F.array_join(kept_lines, "\n")),
        )
        .drop("starts")
    )


def without_repeats(
    docs: DataFrame, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text", line_words: int | None = None
) -> DataFrame:
    """`docs` with the kept lines as text, and `n_chars`, where there is such a column, counting them. No row is lost."""
    found = dedup_lines(docs, min_lines, id_col, text_col, line_words)
    new = {text_col: F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return found.select(*[(new[c] if c in new else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])


def line_digest(docs: DataFrame) -> DataFrame:
    """Runs of two lines and more count, and single lines of 20 words and more."""
    found = dedup_lines(docs.select("doc_id", "text"), line_words=20)
    text = F.coalesce("kept_text", F.lit(""))
    return found.select(
        "record.doc_id",
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2(text, 256).alias("kept_sha256"),
    )
