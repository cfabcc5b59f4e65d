"""Work on JSON objects held as MAP<STRING, VARIANT>, without UDFs."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tidegate.schemas import PAYLOAD


def is_single_json_value(text: Column) -> Column:
    """False for text behind the first JSON value, which ``from_json`` would ignore."""
    return F.coalesce(
        F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1, F.lit(False)
    )


def has_duplicate_keys(obj: Column) -> Column:
    keys = F.map_keys(obj)
    return F.size(F.array_distinct(keys)) < F.size(keys)


def keep_if_distinct_keys(obj: Column) -> Column:
    """NULL for an object that names a key twice; the object is evaluated once."""
    return F.get(F.filter(F.array(obj), lambda o: ~has_duplicate_keys(o)), F.lit(0))


def parse_object(text: Column) -> Column:
    """JSON text to a payload; NULL for NULL, malformed, ambiguous and non-object text."""
    return F.when(is_single_json_value(text), keep_if_distinct_keys(F.from_json(text, PAYLOAD)))


def empty_object() -> Column:
    return F.create_map().cast(PAYLOAD)


def as_json_value(value: Column) -> Column:
    """A SQL value as a JSON value; SQL NULL becomes JSON null."""
    return F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))


def value_string(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def get_string(obj: Column, key: str) -> Column:
    return value_string(obj[key])


def get_int(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj[key], "$", "int")


def holds_text(obj: Column, key: str) -> Column:
    """The key holds something that should have been readable."""
    text = get_string(obj, key)
    return text.isNotNull() & ~text.isin("", "null")


def is_bad_int(obj: Column, key: str) -> Column:
    """The key holds text or a number that is no INT. Most rows are settled by the first test."""
    return get_int(obj, key).isNull() & holds_text(obj, key)


def get_long_or_zero(obj: Column, key: str) -> Column:
    return F.coalesce(F.try_variant_get(obj[key], "$", "bigint"), F.lit(0).cast("bigint"))


def get_int_or_zero(obj: Column, key: str) -> Column:
    return F.coalesce(get_int(obj, key), F.lit(0))


def get_object(obj: Column, key: str) -> Column:
    return F.try_variant_get(obj[key], "$", PAYLOAD)


def has_key(obj: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(obj, key), F.lit(False))


def is_empty(obj: Column) -> Column:
    """NULL for no object, whatever the session takes the size of NULL to be."""
    return F.when(obj.isNotNull(), F.cardinality(obj) == 0)


def is_non_empty(obj: Column) -> Column:
    return F.coalesce(F.cardinality(obj) > 0, F.lit(False))


def drop_key(obj: Column, key: str) -> Column:
    return F.map_filter(obj, lambda k, _: k != key)


def keep_key(obj: Column, key: str) -> Column:
    """The object with this key alone."""
    return F.map_filter(obj, lambda k, _: k == key)


def put(obj: Column, key: str, value: Column) -> Column:
    """Add or replace one key."""
    return F.map_concat(drop_key(obj, key), F.create_map(F.lit(key), as_json_value(value)))


def overlay(base: Column, *patches: Column) -> Column:
    """All objects in one; where a key is in several, the last wins.

    Clashes are rare, so the keys are filtered only when two objects share one.
    """
    objects = [base, *patches]
    later = [
        (first, second) for i, first in enumerate(objects) for second in objects[i + 1 :]
    ]
    clash = reduce(
        or_, (F.arrays_overlap(F.map_keys(a), F.map_keys(b)) for a, b in later), F.lit(False)
    )

    def without(obj: Column, i: int) -> Column:
        kept = lambda k, _: ~reduce(or_, (F.map_contains_key(o, k) for o in objects[i + 1 :]))
        return F.map_filter(obj, kept) if i + 1 < len(objects) else obj

    apart = F.map_concat(*(without(obj, i) for i, obj in enumerate(objects)))
    return F.when(clash, apart).otherwise(F.map_concat(*objects))


def to_text(obj: Column) -> Column:
    return F.to_json(obj)
