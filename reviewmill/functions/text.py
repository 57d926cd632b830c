"""String expressions of the cleaning jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.schemas import KEY_SEPARATOR, MODEL_VERSION_PATTERN
from reviewmill.settings import UNKNOWN_NAME

_EDGE_SPACE = r"(?U)^\s+|\s+$"
_NOT_SPACE = r"(?U)\S"
# Runs of whitespace, and single whitespace other than a blank, which would only
# be replaced by itself.
_WIDE_SPACE = r"\s{2,}|[\t\n\x0B\f\r]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove every kind of whitespace at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def is_blank(c: Column | str) -> Column:
    """Null, or nothing but blanks."""
    return F.coalesce(F.trim(_col(c)), F.lit("")) == ""


def missing_or_blank(c: Column | str) -> Column:
    """Null, or nothing but whitespace of any kind."""
    return F.coalesce(~_col(c).rlike(_NOT_SPACE), F.lit(True))


def sanitize(c: Column | str) -> Column:
    """One space for each field delimiter, carriage return, line feed or tab."""
    return F.translate(_col(c), "\u0001\r\n\t", "    ")


def clean_text(c: Column | str) -> Column:
    """Trim blanks, then fold line breaks and every run of whitespace into one space."""
    return F.regexp_replace(F.trim(_col(c)), _WIDE_SPACE, " ")


def text_length(c: Column | str) -> Column:
    return F.length(_col(c)).cast("bigint")


def preview(c: Column | str, characters: int) -> Column:
    return F.substring(_col(c), 1, characters)


def review_key(user_id="user_id", asin="asin", parent_asin="parent_asin",
               review_timestamp="review_timestamp", title="title", review_text="review_text") -> Column:
    """SHA-256 of the identifying columns; a null part counts as empty text."""
    parts = [
        F.coalesce(_col(c).cast("string"), F.lit(""))
        for c in (user_id, asin, parent_asin, review_timestamp, title, review_text)
    ]
    joined = reduce(lambda left, right: left + [F.lit(KEY_SEPARATOR), right], parts[1:], [parts[0]])
    return F.sha2(F.concat(*joined), 256)


def base64_text(c: Column | str) -> Column:
    """Base64 of the UTF-8 bytes on one line, whatever line length the session chunks to."""
    return F.translate(F.base64(F.encode(_col(c), "UTF-8")), "\r\n", "")


def equals_ignore_case(c: Column | str, value: str) -> Column:
    return F.lower(_col(c)) == value.strip().lower()


def looks_like_smoke_model(c: Column | str) -> Column:
    """Model versions that announce a trial run rather than a real model."""
    name = F.lower(_col(c))
    return name.like("%smoke%") | name.like("%synthetic%") | name.like("%contract%not%a%model%")


def model_partition(c: Column | str) -> Column:
    """Directory-safe form of a model version, made unique by a short hash.

    Null when the version itself is not acceptable as a name.
    """
    c = _col(c)
    folded = F.regexp_replace(F.lower(c), "[^a-z0-9_-]+", "_")
    bare = F.regexp_replace(folded, "^_+|_+$", "")
    named = F.when(bare == "", F.lit("model")).otherwise(bare)
    name = F.concat(F.substring(named, 1, 80), F.lit("_"), F.substring(F.sha2(c, 256), 1, 12))
    return F.when(c.rlike(MODEL_VERSION_PATTERN), name)


def folded_name(c: Column | str) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(_col(c))), F.lit("")), F.lit(UNKNOWN_NAME))


def packed_key(c: Column | str) -> Column:
    """The key as bytes, one value for each key: a hash of 64 digits as its 32 bytes behind a 1, anything else as it is behind a 0; null stays null.

    A shuffle compresses digits of a hash hardly at all, so keys travel in half the room.
    """
    key = F.col(c) if isinstance(c, str) else c
    return F.when(key.rlike(r"\A[0-9a-f]{64}\z"), F.concat(F.lit(b"\x01"), F.unhex(key))).otherwise(F.concat(F.lit(b"\x00"), key.cast("binary")))


def unpacked_key(c: Column | str) -> Column:
    """The key of :func:`packed_key`."""
    packed = F.col(c) if isinstance(c, str) else c
    rest = F.substring(packed, 2, 2**31 - 1)
    return F.when(F.substring(packed, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
