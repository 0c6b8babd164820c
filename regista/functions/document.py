"""JSON documents, flat arrays, records and paths."""

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Spark type -> the JSON types (of ``schema_of_variant``) it may be read from
_JSON_TYPES = {
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "int": ("BIGINT",),
    "bigint": ("BIGINT",),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
}


def json_path(c: Column, path: str, as_type: str = "string") -> Column:
    """The value at ``path`` of a JSON text column.

    A missing value and JSON null are NULL. A value of another JSON type than ``as_type`` (a quoted
    number for instance) and text that is no JSON fail the job, in any ANSI mode.
    """
    found = F.variant_get(F.parse_json(c), path, "variant")
    kind = F.schema_of_variant(found)
    plain = [k for k in _JSON_TYPES[as_type] if k != "DECIMAL"]
    fits = kind.isin(*plain) | kind.startswith("DECIMAL(") if "DECIMAL" in _JSON_TYPES[as_type] else kind.isin(*plain)
    wrong = F.raise_error(F.concat(F.lit(f"{path} is no {as_type}: "), c)).cast(as_type)
    # the same expression everywhere, so a row is parsed once
    return F.when(found.isNull() | F.is_variant_null(found), F.lit(None).cast(as_type)).when(
        fits, found.cast(as_type)
    ).otherwise(wrong)


def member_codes(index: Column) -> Column:
    """Member codes of a cube dimension in position order.

    ``index`` is raw JSON text, either an array of codes or an object code -> position.
    """
    as_list = F.from_json(index, "array<string>")
    by_code = F.map_entries(F.from_json(index, "map<string,bigint>"))
    ordered = F.array_sort(F.transform(by_code, lambda e: F.struct(e["value"], e["key"])))
    as_map = F.transform(ordered, lambda e: e["key"])
    return F.when(F.ltrim(index).startswith("["), as_list).otherwise(as_map)


def array_product(c: Column) -> Column:
    """Product of the entries of an array of integers."""
    return F.aggregate(c, F.lit(1).cast("bigint"), lambda acc, x: acc * x.cast("bigint"))


def stride_pick(values: Column, stride: int, offset: int) -> Column:
    """Every ``stride``-th entry of ``values`` from ``offset`` on."""
    return F.filter(values, lambda _, i: F.pmod(i, F.lit(stride)) == offset)


def zip_fields(names: Column, values: Column) -> Column:
    """A record as a map from field name to value."""
    return F.map_from_arrays(names, values)


def switch_layer(path: Column, source: str, target: str) -> Column:
    """The same path in another layer, e.g. ``landing/`` to ``staging/``."""
    return F.replace(path, F.lit(f"{source}/"), F.lit(f"{target}/"))


def page_file_name(offset: Column, digits: int = 8) -> Column:
    """File name of the landing page that starts at ``offset``: zero-padded, never cut."""
    return F.format_string(f"%0{digits}d.json", offset.cast("bigint"))
