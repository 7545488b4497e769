from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: SHA-256 of the empty string, found where an empty value was hashed by mistake.
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Strip every kind of white space at both ends, not only blanks."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def has_text(c: Column | str) -> Column:
    """True where a value is present; never NULL."""
    return F.coalesce(_c(c) != "", F.lit(False))


def hash_pii(c: Column | str) -> Column:
    """SHA-256 hex of the normalised value. NULL and '' mean "not given" and stay NULL."""
    return F.when(has_text(c), F.sha2(F.lower(trim_ws(c)), 256))


def hash_json(c: Column | str) -> Column:
    """SHA-256 hex of a serialised value (JSON text as it stands); NULL stays NULL."""
    return F.sha2(_c(c), 256)


def packed(c: Column | str) -> Column:
    """A text in binary, hex digests (any text of a-f and 0-9 in pairs) in half their length; equal texts, and only these, are equal packed.

    For the way through a shuffle: digests are the widest part of many rows there, and do not compress. NULL stays NULL.
    """
    text = _c(c).cast("string")
    digits_of = F.unhex(text)
    as_hex = F.lower(F.hex(digits_of)) == text
    return F.when(as_hex, F.concat(F.lit(b"\x01"), digits_of)).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpacked(c: Column | str) -> Column:
    """The text that `packed` was given."""
    rest = F.substring(_c(c), 2, (1 << 31) - 1)
    return F.when(F.substring(_c(c), 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def mask_name(c: Column | str) -> Column:
    """First letter and three stars; NULL stays NULL."""
    return F.concat(F.substring(_c(c), 1, 1), F.lit("***"))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Captured group, or NULL where the pattern does not match."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def digits(c: Column | str) -> Column:
    """First run of digits as a BIGINT: the numeric part of a global id."""
    return first_match(c, r"(\d+)").cast("bigint")


def order_number(name: Column | str) -> Column:
    """'#12' and 'X-12-1' both give '12'; any other name is kept."""
    n = _c(name)
    return (
        F.when(n.startswith("#"), first_match(n, r"#(\d+)"))
        .when(n.startswith("X-"), first_match(n, r"X-(\d+)"))
        .otherwise(n)
    )


def query_param(c: Column | str, name: str) -> Column:
    """Value of one parameter in a query string; NULL if absent."""
    return first_match(c, name + "=([^&]+)")


def json_text(c: Column | str, path: str) -> Column:
    return F.get_json_object(_c(c), path)


def json_long(c: Column | str, path: str) -> Column:
    return json_text(c, path).cast("bigint")


def json_decimal(c: Column | str, path: str, kind: str = "decimal(18,2)") -> Column:
    return json_text(c, path).cast(kind)
