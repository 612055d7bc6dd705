"""Work on JSON texts without a declared schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakelayers.functions.columns import ColumnOrName, as_column

OBJECT_SCHEMA = "array<struct<data:array<string>>>"


# Writer options that keep the microseconds of timestamps; by default Spark cuts them to milliseconds.
EXACT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# White space between JSON tokens.
BLANKS = " \t\r\n"


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _inside_array(text: Column) -> Column:
    """``text`` as sole element of a JSON array, so that text after its end is an error."""
    return F.concat(F.lit("["), text, F.lit("]"))


def _elements(variant: Column, path: str) -> Column:
    """JSON texts of the elements of the array at ``path``, null where there is none."""
    return F.transform(F.try_variant_get(variant, path, "array<variant>"), lambda item: F.to_json(item))


def response_records(body: ColumnOrName) -> Column:
    """Records of a response body as array of compact JSON texts.

    An array gives its elements, an object with a ``data`` array the elements of that array,
    any other object itself. Everything else gives null: scalars, invalid JSON and a ``data``
    that is no array. Elements that are no objects are left out.

    A plain object keeps its own text. Elements of arrays are written anew: keys in order of
    name, decimals of up to 38 digits in full without closing zeros, longer ones as doubles.
    Bodies that repeat a key within an object keep its order and doubles only.
    """
    text = as_column(body)
    trimmed = _trimmed(text)
    wrapped = _inside_array(text)

    def records(parsed: Column) -> Column:
        by_text = _text_records(wrapped, trimmed, text)  # for what a variant cannot hold
        return F.when(parsed.isNotNull(), _variant_records(parsed, trimmed)).otherwise(by_text)

    # A lambda's variable is computed once, where an expression named several times is not.
    return F.get(F.transform(F.array(F.try_parse_json(wrapped)), records), F.lit(0))


def _variant_records(parsed: Column, trimmed: Column) -> Column:
    data = F.try_variant_get(parsed, "$[0].data", "variant")
    alone = F.try_variant_get(parsed, "$[1]", "variant").isNull()
    is_object = trimmed.startswith("{")
    found = (
        F.when(trimmed.startswith("["), _elements(parsed, "$[0]"))
        .when(is_object & data.isNotNull(), _elements(parsed, "$[0].data"))
        .when(is_object, F.array(trimmed))
    )
    return F.when(alone, F.filter(found, _is_object))


def _text_records(wrapped: Column, trimmed: Column, text: Column) -> Column:
    arrays, objects = F.from_json(wrapped, "array<array<string>>"), F.from_json(wrapped, "array<string>")
    has_data = F.array_contains(F.json_object_keys(text), "data")
    found = (
        F.when(trimmed.startswith("["), F.when(F.size(arrays) == 1, arrays[0]))
        .when(trimmed.startswith("{") & has_data, F.from_json(wrapped, OBJECT_SCHEMA)[0]["data"])
        .when(trimmed.startswith("{"), F.when(F.size(objects) == 1, F.array(trimmed)))
    )
    return F.filter(found, _is_object)


def _is_object(record: Column) -> Column:
    return record.startswith("{")


def fill_absent_keys(record: ColumnOrName, defaults: Mapping[str, object]) -> Column:
    """Append those keys of ``defaults`` the JSON object lacks; a present null is kept.

    Values are literals or columns. Text that is no JSON object comes back unchanged.
    """
    text = as_column(record)
    # Used below only where it is always evaluated, so that Spark parses each text once.
    keys = F.json_object_keys(text)
    trimmed = _trimmed(text)
    inner = _trimmed(F.substr(trimmed, F.lit(2), F.length(trimmed) - 2))
    members = [F.nullif(inner, F.lit(""))]
    for name, value in defaults.items():
        column = value if isinstance(value, Column) else F.lit(value)
        member = F.to_json(F.struct(column.alias(name)), {"ignoreNullFields": "false"})
        member = F.substr(member, F.lit(2), F.length(member) - 2)
        members.append(F.when(~F.array_contains(keys, name), member))
    null_unless_object = F.when(keys.isNotNull(), F.lit(""))
    filled = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"), null_unless_object)
    return F.coalesce(filled, text)
