"""Strict JSON handling on top of VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


MARK = "918273645546372819"


def strict_variant(col: Column) -> Column:
    """The parsed value, or null where the text is not exactly one JSON value.

    ``try_parse_json`` alone accepts trailing text. A scan of the text inside an array, with a mark
    behind it, finds the mark in the second place only if nothing is left over. A text that holds the
    mark itself is parsed by ``_boxed_twice`` instead.
    """
    second = F.get_json_object(F.concat(F.lit("["), col, F.lit(f",{MARK}]")), "$[1]")
    return F.when(col.contains(MARK), _boxed_twice(col)).when(second == MARK, F.try_parse_json(col))


def _boxed_twice(col: Column) -> Column:
    """The text once inside an array and once inside an object: anything left over breaks one of the two or adds a second element."""
    boxed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), col, F.lit("]"))), "$", "array<variant>")
    keyed = F.try_parse_json(F.concat(F.lit('{"v":'), col, F.lit("}")))
    keys = F.size(F.map_keys(F.try_variant_get(keyed, "$", "map<string,variant>")))
    return F.when((F.size(boxed) == 1) & (keys == 1), F.try_element_at(boxed, F.lit(1)))


def kind(value: Column, path: str) -> Column:
    """JSON kind at ``path``: VOID for a JSON null, null for an absent key."""
    return F.schema_of_variant(F.variant_get(value, path, "variant"))


def is_present(value: Column, path: str) -> Column:
    return F.variant_get(value, path, "variant").isNotNull()


def text_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def other_fields(value: Column, declared: list[str]) -> Column:
    """Fields of an object that nobody declared, as a map from name to JSON text."""
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    return F.transform_values(F.map_filter(fields, lambda k, _: ~k.isin(declared)), lambda _, v: F.to_json(v))
