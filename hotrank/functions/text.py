"""Text handling: packed lists, strict numbers, JSON objects, sorted-set names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything above the control and space range counts as content.
_HAS_CONTENT = r"[^\x00-\x20]"


def has_content(text: Column) -> Column:
    return F.coalesce(text.rlike(_HAS_CONTENT), F.lit(False))


def split_list(text: Column) -> Column:
    """Elements of a comma list. Trailing empties vanish; NULL or blank gives no element."""
    body = F.rtrim(text, F.lit(","))
    return F.when(
        has_content(text) & (body != ""), F.split(body, ",", -1)
    ).otherwise(F.array().cast("array<string>"))


def strict_int(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def strict_long(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def json_object(text: Column) -> Column:
    """JSON object as a map of texts; NULL when the text is not one JSON object."""
    # As a list of one, since a reader of single objects overlooks what follows the first.
    found = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>")
    # Filtered rather than tested by a condition, which would name, hence parse, it twice.
    single = F.filter(F.array(found), lambda records: F.size(records) == 1)
    return F.get(F.get(single, F.lit(0)), F.lit(0))


def plain_names(obj: Column) -> Column:
    """Keys of a JSON map without case, ``_`` and ``-``, in document order."""
    return F.transform(F.map_keys(obj), lambda k: F.lower(F.translate(k, "_-", "")))


def field(names: Column, obj: Column, name: str) -> Column:
    """Value of the first key that reads as ``name`` once case, ``_`` and ``-`` are dropped."""
    wanted = name.replace("_", "").lower()
    place = F.array_position(names, F.lit(wanted)).cast("int")
    return F.get(F.map_values(obj), place - 1)


def ranking_key(category: Column) -> Column:
    return F.concat(F.lit("hot:"), category)


def member_text(creation_id: Column) -> Column:
    return creation_id.cast("string")


def once(value: Column) -> Column:
    """``value``, computed a single time per row; for use as a column of its own in a select.

    A filter over a computed column is moved below it and computes it again, as often as the
    condition names it. It is not moved below a generator, so what is costly goes through one.
    """
    return F.explode(F.array(value))
