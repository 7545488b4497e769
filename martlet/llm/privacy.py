"""Personal data: patterns for emails, IPs, cards and phones, and information-theoretic sanitisation of what gives them away.

A pattern's match is a protected entity. A term near it discloses it as far as the corpus ties the two together: with N documents,
of which c hold the entity, t the term and b the term near the entity, the term carries log2(N b / (c t)) bits about the
entity (their pointwise mutual information) of the log2(N / c) bits that the entity itself is worth. Terms that carry a large share are
generalised to their kind (a name, a number, a word) in documents with the entity, and those that carry nearly all are removed.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import Filter, land, slices

# Fixed values of the contract: the kinds in their order, and their patterns. Where a pattern could be tried from every place of a long
# run, it starts at the run's first character only, which finds the same matches in linear time.
KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
# Words that terms are made of: letters and digits of any script.
TERM = re.compile(r"[^\W_]+")
TERM_KIND = "term"


@dataclass(frozen=True)
class Limits:
    """reach: terms to either side of an entity that count as near. support: documents in which a term must be near an entity.
    generalise, remove: shares of the entity's information from which a term is generalised, or removed. shortest: characters of a term.
    """

    reach: int = 8
    support: int = 3
    generalise: float = 0.8
    remove: float = 0.95
    shortest: int = 3


# ---------------------------------------------------------------------------- patterns
def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        # The local part is the run of its characters that ends at the sign, as far back as the last match.
        start = at
        while start > end and LOCAL.match(text, start - 1, start):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    own, doubled = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, own)) + sum(sum(divmod(2 * int(d), 10)) for d in doubled)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of personal data: per kind leftmost matches that do not overlap, in code points, by kind and start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def entity(kind: str, value: str) -> str:
    """What makes two matches the same entity: their digits, or the address in lower case."""
    return f"{kind}:{NOT_DIGIT.sub('', value) if kind in ('card', 'phone') else value.lower()}"


def near_terms(text: str, spans: list[tuple[str, int, int]], limits: Limits) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the terms within reach of each span that no span overlaps."""
    if not spans:
        return []
    covered = sorted((a, b) for _, a, b in spans)
    words, reach = [], 0
    which = 0
    for m in TERM.finditer(text):
        a, b = m.span()
        while which < len(covered) and covered[which][0] < b:
            reach = max(reach, covered[which][1])
            which += 1
        if a >= reach and b - a >= limits.shortest:
            words.append((a, b))
    starts = [a for a, _ in words]
    out = []
    for kind, a, b in spans:
        at = bisect.bisect_left(starts, a)
        for s, e in words[max(0, at - limits.reach) : at + limits.reach]:
            out.append((entity(kind, text[a:b]), text[s:e].lower(), s, e))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# ------------------------------------------------------------------------------ corpus
NEAR = "array<struct<entity: string, term: string, start: int, end: int>>"


def found_data(docs: DataFrame, key: list[str], text_col: str, limits: Limits) -> DataFrame:
    """Per row: `record` (the columns `key`), counts per kind, spans as text, and the terms near them. A null text is empty."""
    record = F.struct(*[F.col(f"`{c}`") for c in key]).alias("record")
    schema = docs.select(record).schema["record"].dataType.simpleString()
    out = f"record {schema}, n array<bigint>, base string, near {NEAR}"
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts, base, near = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                kinds = [k for k, _, _ in spans]
                counts.append([kinds.count(k) for k in KINDS])
                base.append(joined(spans))
                near.append([dict(zip(("entity", "term", "start", "end"), x)) for x in near_terms(text, spans, limits)])
            columns = [batch.column(0), pa.array(counts, pa.list_(pa.int64())), pa.array(base, pa.string()), pa.array(near, near_type)]
            yield pa.RecordBatch.from_arrays(columns, ["record", "n", "base", "near"])

    return docs.select(record, F.col(text_col).alias("text")).mapInArrow(find, out)


def _documents_with(texts: DataFrame, terms: Filter) -> DataFrame:
    """(term, t) for the terms in the filter: in how many rows of `texts` they occur. The filter may let some others through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [{w.lower() for w in set(TERM.findall(t or ""))} for t in batch.column(0).to_pylist()]
            words = list(set().union(*sets))
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))
            wanted = {words[i]: 0 for i in np.flatnonzero(terms.has(hashes)).tolist()}
            for one in sets:
                for w in wanted.keys() & one if len(wanted) < len(one) else (w for w in one if w in wanted):
                    wanted[w] += 1
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(wanted), pa.string()), "t": pa.array(list(wanted.values()), pa.int64())})

    return texts.mapInArrow(count, "term string, t long").groupBy("term").agg(F.sum("t").alias("t"))


def _hash64(df: DataFrame, column: str) -> DataFrame:
    """Hashes (h) of a text column, as `Filter` is asked for them."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [xxhash.xxh64_intdigest(w) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"h": pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())})

    return df.select(column).mapInArrow(hashes, "h long")


def disclosing_terms(found: DataFrame, docs: DataFrame, text_col: str, limits: Limits) -> DataFrame:
    """(entity, term, share, action) of the terms that carry a share of an entity's information over the limits.

    `found` is a landed `found_data` of `docs`. Rows count as documents, copies included. An entity that is in all documents carries no
    information, so nothing discloses it.
    """
    # Each row counts once however often it has the pair.
    once = F.array_distinct(F.transform("near", lambda x: F.struct(x["entity"].alias("entity"), x["term"].alias("term"))))
    pairs = found.select(F.explode(once).alias("p")).groupBy("p.entity", "p.term").agg(F.count("*").alias("b"))
    pairs = land(pairs.filter(F.col("b") >= limits.support), "privacy-pairs")
    wanted = Filter(_hash64(pairs.select("term").distinct(), "term"), "h")
    with_term = land(_documents_with(docs.select(F.col(text_col).alias("text")), wanted), "privacy-terms")
    own = F.array_distinct(F.transform("near", lambda x: x["entity"]))
    with_entity = land(found.select(F.explode(own).alias("entity")).groupBy("entity").agg(F.count("*").alias("c")), "privacy-entities")
    n = F.lit(float(found.count()))
    carried = F.log2(n * F.col("b") / (F.col("c") * F.col("t")))
    worth = F.log2(n / F.col("c"))
    share = F.when(worth > 0, carried / worth)
    scored = pairs.join(with_entity, "entity").join(with_term, "term").withColumn("share", F.round(share, 9))
    action = F.when(F.col("share") >= limits.remove, "remove").otherwise("generalise")
    return scored.filter(F.col("share") >= limits.generalise).select("entity", "term", "share", action.alias("action"))


def _with_term_spans(found: DataFrame, docs: DataFrame, text_col: str, limits: Limits) -> DataFrame:
    """`found` (with a column `row` of its own) and `terms`: (start, end, action) of the disclosing terms, in order."""
    disclosing = land(disclosing_terms(found, docs, text_col, limits), "privacy-disclosing")
    each = found.select("row", F.explode("near").alias("x")).select("row", "x.entity", "x.term", "x.start", "x.end")
    # A term near two entities goes by the stronger action, of which "remove" is the last in the alphabet.
    hits = each.join(disclosing, ["entity", "term"]).groupBy("row", "start", "end").agg(F.max("action").alias("action"))
    spans = hits.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "action"))).alias("terms"))
    return found.join(spans, "row", "left")


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    return land(docs.withColumn("row", F.monotonically_increasing_id()), label)


def personal_spans(docs: DataFrame, key: list[str], text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Per row of `docs`: the columns `key`, n (matches per kind, as in KINDS), base (their spans) and spans (with the disclosing terms').

    Spans are written kind:start:end in code points and joined by commas, by kind as in KINDS with `term` last, then by start. A null text
    is empty, repeated rows are all returned and count as documents, an empty table gives no rows; other columns are not looked at.
    """
    found = _numbered(found_data(docs, key, text_col, limits), "privacy")
    every = _with_term_spans(found, docs, text_col, limits)
    terms = F.array_join(F.transform("terms", lambda x: F.concat_ws(":", F.lit(TERM_KIND), x["start"], x["end"])), ",")
    spans = F.concat_ws(",", F.nullif("base", F.lit("")), terms)
    return every.select(*[F.col(f"record.`{c}`").alias(c) for c in key], "n", "base", spans.alias("spans"))


def _generalised(term: str) -> str:
    return "<number>" if term.isnumeric() else "<name>" if term[:1].isupper() else "<word>"


def _clean(text: str, base: str, terms: list[dict]) -> str:
    marks = [(int(a), int(b), f"<{k}>") for k, a, b in (x.split(":") for x in base.split(",") if x)]
    marks += [(x["start"], x["end"], "" if x["action"] == "remove" else _generalised(text[x["start"] : x["end"]])) for x in terms]
    out, at = [], 0
    for a, b, put in sorted(marks):
        if a >= at:  # of spans that overlap the first stands for all
            out += [text[at:a], put]
        at = max(at, b)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, text_col: str = "text", limits: Limits = Limits()) -> DataFrame:
    """`docs` with personal data replaced by its kind (`<email>`), and disclosing terms generalised or removed.

    Null texts stay null; rows come back one for one, with all their columns.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    held = _numbered(docs.select(record, F.col(text_col).alias("text")), "privacy-docs")
    found = found_data(held, ["row"], "text", limits).select(F.col("record.row").alias("row"), "n", "base", "near")
    spans = _with_term_spans(land(found, "privacy"), held, "text", limits).filter("base <> ''").select("row", "base", "terms")

    @F.pandas_udf("string")
    def clean(text, base, terms):
        return pd.Series([None if t is None else _clean(t, b or "", [] if x is None else list(x)) for t, b, x in zip(text, base, terms)])

    new = held.join(spans, "row", "left").withColumn("text", clean("text", "base", "terms"))
    columns: list[Column] = [F.col("text").alias(c) if c == text_col else F.col(f"record.`{c}`").alias(c) for c in docs.columns]
    return new.select(*columns)


def privacy_digest(docs: DataFrame) -> DataFrame:
    found = personal_spans(docs, ["doc_id"])
    counts = [F.col("n")[i].alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")
