"""Text functions with the blank, split and number rules that the pipelines rely on."""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable

from pyspark.sql import Column, functions as F


def is_not_blank(text: Column) -> Column:
    """True when the text holds a character that is not whitespace; NULL counts as blank."""
    return F.coalesce(text.rlike(r"\P{javaWhitespace}"), F.lit(False))


def starts_with_any(text: Column, prefixes: Iterable[str]) -> Column:
    return reduce(or_, (text.startswith(p) for p in prefixes))


def before_last_dot(text: Column) -> Column:
    return F.regexp_extract(text, r"^(?s)(.*)\.[^.]*$", 1)


def after_last_dot(text: Column) -> Column:
    return F.regexp_extract(text, r"^(?s).*\.([^.]*)$", 1)


def before_first_dot(text: Column) -> Column:
    return F.substring_index(text, ".", 1)


def after_first_dot(text: Column) -> Column:
    return F.substr(text, F.locate(".", text) + 1)


def to_int(text: Column) -> Column:
    """Strict decimal text to INT; anything else, and overflow, is NULL."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def code_label(code: Column, labels: dict[int, str]) -> Column:
    """Label of a code; an unknown or NULL code has none."""
    pairs = iter(labels.items())
    first_code, first_label = next(pairs)
    labelled = F.when(code == first_code, first_label)
    for value, label in pairs:
        labelled = labelled.when(code == value, label)
    return labelled


def hex_id(raw: Column) -> Column:
    return F.lower(F.hex(raw))
