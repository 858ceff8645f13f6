"""Pages of JSON records in the shapes report services return them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIST, _OBJECT = "array<variant>", "map<string,variant>"


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``page``, the whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("page"))


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", _OBJECT).isNotNull()


def _is_list(value: Column) -> Column:
    return F.try_variant_get(value, "$", _LIST).isNotNull()


def page_items(root: Column, keep: str = "objects") -> Column:
    """Records of a parsed page as an array of variants.

    A list is taken as it is. An object gives its ``data``: a list as it is, an object by its values, of which lists
    are flattened and objects taken. An object without ``data`` is itself the only record. ``keep`` leaves only
    ``objects``, only ``lists`` (positional records) or ``all`` items.
    """
    fields = F.try_variant_get(root, "$", _OBJECT)
    nested = F.transform(
        F.map_values(F.try_variant_get(root, "$.data", _OBJECT)),
        lambda value: F.when(_is_list(value), F.try_variant_get(value, "$", _LIST)).when(
            _is_object(value), F.array(value)
        ),
    )
    flattened = F.flatten(F.array_compact(nested))
    in_data = F.coalesce(F.try_variant_get(root, "$.data", _LIST), flattened)
    items = (
        F.when(_is_list(root), F.try_variant_get(root, "$", _LIST))
        .when(F.map_contains_key(fields, F.lit("data")), in_data)
        .when(_is_object(root), F.array(root))
    )
    tests = {"objects": _is_object, "lists": _is_list}
    return F.filter(items, tests[keep]) if keep in tests else items


def flatten_pages(pages: DataFrame, page: str = "page", keep: str = "objects", carry: list[str] | None = None) -> DataFrame:
    """One row per record: the ``carry`` columns of its page and ``item``.

    Broken or truncated JSON gives no rows; text behind a complete first value is not looked at. The parsed page leaves
    a generator, so that each page is parsed once.
    """
    carry = carry or []
    parsed = pages.select(*carry, F.explode(F.array(F.try_parse_json(page))).alias("_root"))
    return parsed.select(*carry, F.explode(page_items(F.col("_root"), keep)).alias("item"))


def item_field(name: str, dtype: str = "string", item: str = "item") -> Column:
    """Field of an object record; the name may hold dots, blanks and one kind of quote."""
    quote = '"' if "'" in name else "'"
    return F.try_variant_get(F.col(item), f"$[{quote}{name}{quote}]", dtype).alias(name)


def object_rows(items: DataFrame, names: list[str], item: str = "item") -> DataFrame:
    """Object records to text columns; an absent field is NULL."""
    rest = [name for name in items.columns if name != item]
    return items.select(*rest, *[item_field(name, item=item) for name in names])


def positional_rows(items: DataFrame, names: list[str], item: str = "item") -> DataFrame:
    """List records to text columns by a fixed field list; missing trailing values are NULL."""
    rest = [name for name in items.columns if name != item]
    cells = [F.try_variant_get(F.col(item), f"$[{i}]", "string").alias(name) for i, name in enumerate(names)]
    return items.select(*rest, *cells)


def name_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Positional columns to the names of a layout."""
    return df.toDF(*schema.names[: len(df.columns)])


# Field order of positional price records.
PRICE_FIELDS = [
    "deliveryDate",
    "deliveryHour",
    "deliveryInterval",
    "settlementPointName",
    "settlementPointType",
    "settlementPointPrice",
    "dstFlag",
]
