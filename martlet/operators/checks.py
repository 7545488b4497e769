"""Helpers shared by all checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Worst first.
SEVERITY = {"CRITICAL": 1, "FAIL": 1, "WARNING": 2, "ERROR": 3, "PASS": 4, "SKIPPED": 5}


def above(value: Column, warn: float, crit: float, bad: str = "CRITICAL") -> Column:
    """PASS up to `warn`, WARNING above it, `bad` above `crit`."""
    return F.when(value > crit, bad).when(value > warn, "WARNING").otherwise("PASS")


def union(parts: Iterable[DataFrame]) -> DataFrame:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def severity(status: Column) -> Column:
    rank = F.lit(9)
    for name, n in SEVERITY.items():
        rank = F.when(status == name, n).otherwise(rank)
    return rank


# What is behind a finding, what it does to the reports, and what to do. Keyed by check.
ADVICE = {
    "Price Format": ("amounts arrive in cents, or single orders are very large", "revenue and ratios are inflated", "compare a few orders with the shop and correct the unit"),
    "Duplicate Detection": ("an extract was sent again, or versions were not merged", "sums count rows twice", "merge versions by key and load the table again"),
    "Null Rate": ("the source stopped sending a field, or it was renamed", "joins on the field lose rows", "look at the schema of the source and fill the field again"),
    "Data Freshness": ("the sync is late or has stopped", "recent days are missing from reports", "look at the last sync job and start it again"),
    "Record Count": ("the extract is empty", "the source is missing from reports", "look at the range and the credentials of the extract"),
}


def with_advice(findings: DataFrame) -> DataFrame:
    """Add cause, impact and action to findings; unknown checks get none."""
    known = F.create_map(*[x for name, texts in ADVICE.items() for x in (F.lit(name), F.array(*map(F.lit, texts)))])
    texts = F.try_element_at(known, F.col("check_name"))
    return findings.withColumns({name: F.try_element_at(texts, F.lit(i + 1)) for i, name in enumerate(("cause", "impact", "action"))})
