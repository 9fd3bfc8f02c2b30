"""Strict JSON access on VARIANT values, all JVM-side Column expressions.

``from_json`` is permissive (missing fields become NULL, numbers are coerced
to strings), so a strict decoder checks the JSON type of each field first.
``kind`` maps ``schema_of_variant`` to: string, number, null, bool, object,
array -- or SQL NULL when the field is absent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")


def parse(text: Column | str) -> Column:
    """JSON text -> VARIANT; malformed text (or duplicate keys) -> NULL."""
    return F.try_parse_json(text)


def once(df: DataFrame, *cols: Column) -> DataFrame:
    """``df`` with computed columns that are evaluated once per row, whatever is filtered
    on them: Catalyst pushes a filter below a projection and writes the column's
    whole expression into it, with one parse of the message for every time that
    names a member (20 and more in a decoder).  It does not look into a generated row."""
    return df.select("*", F.inline(F.array(F.struct(*cols))))


def field(v: Column, name: str) -> Column:
    """Raw VARIANT of member ``name`` (SQL NULL when absent)."""
    return F.variant_get(v, f"$.{name}", "variant")


# First three letters of each ``schema_of_variant`` type name -> kind.
_KIND_OF = {"STR": "string", "BIG": "number", "INT": "number", "SMA": "number", "TIN": "number",
            "DOU": "number", "FLO": "number", "DEC": "number", "VOI": "null", "BOO": "bool",
            "OBJ": "object", "ARR": "array"}


def scalar_kind(x: Column) -> Column:
    """Kind of a VARIANT: one ``schema_of_variant`` call, its first three
    letters looked up in a literal map (keeps the generated code small)."""
    m = F.create_map(*[F.lit(v) for kv in _KIND_OF.items() for v in kv])
    return F.try_element_at(m, F.substring(F.schema_of_variant(x), 1, 3))


def is_object(x: Column) -> Column:
    return F.coalesce(F.try_variant_get(x, "$", "map<string,variant>").isNotNull(), F.lit(False))


def as_array(x: Column) -> Column:
    """ARRAY<VARIANT> if ``x`` is a JSON array, else NULL."""
    return F.try_variant_get(x, "$", "array<variant>")


def is_string(x: Column) -> Column:
    return F.coalesce(scalar_kind(x) == "string", F.lit(False))


def is_number(x: Column) -> Column:
    return F.coalesce(scalar_kind(x) == "number", F.lit(False))


def is_number_or_null(x: Column) -> Column:
    """A Double field: JSON null is accepted and read as a missing number."""
    return F.coalesce(scalar_kind(x).isin("number", "null"), F.lit(False))


def get_string(x: Column) -> Column:
    return F.when(is_string(x), F.try_variant_get(x, "$", "string"))


def get_double(x: Column) -> Column:
    return F.when(is_number(x), F.try_variant_get(x, "$", "double"))
