"""Column expressions for JSON objects held in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON_OBJECT = "map<string,variant>"
# the text "null" or "None" as a value (not a key), at any depth of compact JSON
_UNSET = r'^"(null|None)"$|[:\[,]"(null|None)"[,}\]]'


def booleans_unquoted(text: Column) -> Column:
    """Quoted Python booleans as JSON booleans."""
    for quoted, plain in (("'True'", "true"), ("'False'", "false"), ('"True"', "true"), ('"False"', "false")):
        text = F.replace(text, F.lit(quoted), F.lit(plain))
    return text


def parsed(text: Column) -> Column:
    """A JSON object as a map of variants; null for any other text."""
    return F.from_json(text, JSON_OBJECT)


def set_inputs_sorted(text: Column, obj: Column) -> Column:
    """A JSON object, given as text and ``parsed``, without the keys that hold 'null' or 'None' at
    any depth, keys sorted. Real nulls stay.

    The entries are looked at one by one only where the text holds such a word, or an escape that
    could spell one.
    """
    may_be_unset = F.contains(text, F.lit('"null"')) | F.contains(text, F.lit('"None"')) | F.contains(text, F.lit("\\u"))
    is_set = lambda _, v: ~F.coalesce(F.to_json(v).rlike(_UNSET), F.lit(False))
    kept = F.when(may_be_unset, F.map_filter(obj, is_set)).otherwise(obj)
    by_key = lambda a, b: F.when(a["key"] < b["key"], -1).otherwise(1)  # keys are unique
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(kept), by_key)))


def with_entry(obj: Column, key: str, value: Column) -> Column:
    """A ``parsed`` object with ``key`` set to a variant, as text; it becomes the last entry."""
    others = F.map_filter(obj, lambda k, _: k != key)
    return F.to_json(F.map_concat(others, F.create_map(F.lit(key), value)))


def entry(obj: Column, key: str, default: str) -> Column:
    """One entry of a ``parsed`` object, the JSON text ``default`` where the object lacks the key."""
    found = F.coalesce(F.try_element_at(obj, F.lit(key)), F.parse_json(F.lit("null")))
    return F.when(F.map_contains_key(obj, key), found).when(obj.isNotNull(), F.parse_json(F.lit(default)))
