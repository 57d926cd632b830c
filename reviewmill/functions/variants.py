"""Typed reads of the fields of a JSON line.

A line is parsed once into a VARIANT. The type of every field that is read is
taken once too, as a column of its own (:func:`open_fields`), because the typed
reads below look at it several times. Where the VARIANT has normalised the spelling
away (``5.0`` against ``5``, key order), the text of the field is read, which one
more parse of the line gives for all fields. A repeated field has its last value
in both.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewmill.functions.numbers import finite, text_to_integer, text_to_number, whole_or_null
from reviewmill.functions.text import sanitize

# An escaped line break, tab or field delimiter that is not itself escaped.
_ESCAPED_CONTROL = r"(?<!\\)((?:\\\\)*)\\(?:[rnt]|u0001)"
_TEXTS = "_texts"


def sanitize_json(c: Column) -> Column:
    """Apply :func:`sanitize` to every string inside compact JSON text."""
    return sanitize(F.regexp_replace(c, _ESCAPED_CONTROL, "$1 "))


def kind_of(schema: Column, raw: Column) -> Column:
    """JSON kind of a VARIANT with this schema text: null, boolean, integer,
    number, string, array or object.

    ``raw`` is the number as written; it is read for decimals without a
    fraction only, which may be ``5.0`` or an integer too long for 64 bits.
    """
    return (
        F.when(schema == "VOID", F.lit("null"))
        .when(schema == "BOOLEAN", F.lit("boolean"))
        .when(schema == "BIGINT", F.lit("integer"))
        .when(schema == "STRING", F.lit("string"))
        .when(schema.startswith("ARRAY"), F.lit("array"))
        .when(schema.startswith("OBJECT"), F.lit("object"))
        .when(schema.rlike(r"^DECIMAL\(\d+,0\)$") & ~raw.rlike("[.eE]"), F.lit("integer"))
        .when(schema.isNotNull(), F.lit("number"))
    )


def _schema_column(name: str) -> str:
    return f"_type_{name}"


def open_fields(objects: DataFrame, *names: str, variant: str = "v", line: str = "value") -> DataFrame:
    """Add, for :class:`JsonField`, the type of each named field (null where it is absent) and its text.

    All texts come from one parse, which is left out where none of them is read.
    """
    texts = F.from_json(F.col(line), StructType([StructField(name, StringType()) for name in names]))
    return objects.withColumns({
        _TEXTS: texts,
        **{_schema_column(name): F.schema_of_variant(F.try_variant_get(F.col(variant), f"$.{name}", "variant")) for name in names},
    })


@dataclass(frozen=True)
class JsonField:
    """One top-level field of a parsed line that went through :func:`open_fields`."""

    name: str
    variant: str = "v"

    @property
    def schema(self) -> Column:
        return F.col(_schema_column(self.name))

    @property
    def raw(self) -> Column:
        """Text of the field; strings lose their quotes, numbers beyond a double have some."""
        return F.col(_TEXTS).getField(self.name)

    @property
    def kind(self) -> Column:
        return kind_of(self.schema, self.raw)

    def _get(self, data_type: str) -> Column:
        return F.try_variant_get(F.col(self.variant), f"$.{self.name}", data_type)

    def _is_string(self) -> Column:
        return self.schema == "STRING"

    def _is_number(self) -> Column:
        return self.schema.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")

    def _is_not_finite(self) -> Column:
        """NaN, an infinity, or a number too large for a double."""
        return (self.schema == "DOUBLE") & ~(F.abs(self._get("double")) < float("inf"))

    def _bare(self) -> Column:
        """Text of a number that is not finite: NaN, Infinity or -Infinity."""
        return F.replace(self.raw, F.lit('"'), F.lit(""))

    def _has_value(self) -> Column:
        """Present and not null."""
        return self.schema != "VOID"

    def as_string(self) -> Column:
        """Strings sanitised, nested values as compact JSON, numbers as text (nan, inf and -inf beyond a double)."""
        return (
            F.when(self._is_string(), sanitize(self._get("string")))
            .when(self._is_not_finite(), F.lower(F.replace(self._bare(), F.lit("inity"), F.lit(""))))
            .when(self._has_value(), sanitize_json(self.raw))
        )

    def as_json(self) -> Column:
        """Compact JSON text of any value; strings keep their quotes."""
        quoted = F.when(self._is_string(), F.to_json(self._get("variant"))).when(self._is_not_finite(), self._bare()) \
            .when(self._has_value(), self.raw)
        return sanitize_json(quoted)

    def as_raw_price(self) -> Column:
        """As :meth:`as_string`; numbers in JSON spelling."""
        return F.when(self._is_not_finite(), self._bare()).otherwise(self.as_string())

    def as_number(self) -> Column:
        return (
            F.when(self._is_number(), finite(self._get("double")))
            .when(self._is_string(), text_to_number(self._get("string")))
        )

    def as_integer(self) -> Column:
        return (
            F.when(self.schema == "BIGINT", self._get("bigint"))
            .when(self._is_number(), whole_or_null(self._get("double")))
            .when(self._is_string(), text_to_integer(self._get("string")))
        )

    def as_boolean(self) -> Column:
        return F.when(self.schema == "BOOLEAN", self._get("boolean"))

    def as_text(self) -> Column:
        """Strings only, unchanged; null for every other kind."""
        return F.when(self._is_string(), self._get("string"))

    def number_text(self) -> Column:
        """Numbers and strings as text, for the lenient parsers."""
        return F.when(self._is_string() | self._is_number(), self.raw)
