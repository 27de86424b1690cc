"""JSON records as text, none of them lost.

Spark's parser stops at the end of the first value and says nothing about what stands behind it.
A text is therefore also parsed inside an array whose last element is the text's own hash: only
where exactly one value stands before that hash has everything been read. And since the parser
passes numbers through a double, they are marked and put in quotes before the values are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN = "broken JSON"
FOLLOWED = "text after the record"
NO_OBJECT = "not an object"
NO_ARRAY = "not an array"
REPEATED = "repeated field"

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
# Possessive, so that a long literal takes no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_NUMBER = r"-?[0-9][0-9.eE+-]*+"
# Control characters cannot stand in a JSON text as they are, only escaped.
_OPEN, _CLOSE = "\u0001", "\u0002"
_MARK = _OPEN + _CLOSE + _OPEN
_MARK_ESCAPED = r"\u0001\u0002\u0001"


def _parsed(text: Column, kind: str) -> Column:
    return F.from_json(text, kind, _STRICT)


def values_before_end(text: Column) -> Column:
    """The JSON values a text consists of; NULL where it cannot be read to its end."""
    end = F.xxhash64(text).cast("string")
    values = _parsed(F.concat(F.lit("["), text, F.lit(',"'), end, F.lit('"]')), "array<string>")
    complete = (F.size(values) > 0) & F.get(values, F.size(values) - 1).eqNullSafe(end)
    return F.when(complete, F.slice(values, 1, F.size(values) - 1))


def mark_numbers(text: Column) -> Column:
    """Every number outside of strings as a marked string of the same characters."""
    found = F.regexp_replace(text, f"(?s)({_STRING})|({_NUMBER})", f"$1{_OPEN}$2{_CLOSE}")
    numbers = F.replace(found, F.lit(_OPEN + _CLOSE), F.lit(""))
    opened = F.replace(numbers, F.lit(_OPEN), F.lit(f'"{_MARK_ESCAPED}'))
    return F.replace(opened, F.lit(_CLOSE), F.lit('"'))


def unmark_numbers(value: Column) -> Column:
    """Back to the text as it was, for a number by itself and for JSON with numbers in it."""
    inside = '"' + _MARK_ESCAPED.replace("\\", "\\\\") + '([0-9.eE+-]+)"'
    return F.when(F.startswith(value, F.lit(_MARK)), F.substring(value, 4, 2**31 - 1)).otherwise(
        F.regexp_replace(value, inside, "$1")
    )


def _mark_strings(text: Column) -> Column:
    """Every string with a character before its first one, so that none looks like an object."""
    return F.regexp_replace(text, f'(?s)"({_STRING[1:]})', '"~$1')


def _object_flaw(marked: Column) -> Column:
    """Why the marked text of one object is no record; NULL for a sound one."""
    keys = F.map_keys(_parsed(marked, "map<string,string>"))
    return F.when(keys.isNull(), NO_OBJECT).when(
        F.size(keys) > F.size(F.array_distinct(keys)), REPEATED
    )


def _fields(marked: Column) -> Column:
    """The fields of one object as text; objects and arrays in them as compact JSON."""
    record = _parsed(marked, "map<string,string>")
    return F.transform_values(record, lambda _, value: unmark_numbers(value))


def _unread(text: Column, kind: str) -> Column:
    return F.when(_parsed(text, kind).isNotNull(), FOLLOWED).otherwise(BROKEN)


def line_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """``lines`` with ``record``, ``flaw`` and ``flawed_text``: one JSON object a line.

    ``record`` maps the fields of a sound line to their text, a number digit by digit. A line
    that is broken, goes on behind its record, is no object or names a field twice has no
    record, but a ``flaw`` and its whole text. Blank lines are dropped.
    """
    value = F.col(text)
    found = lines.where(value.rlike(r"\S")).withColumn("_marked", mark_numbers(value))
    values = values_before_end(value)
    flaw = (
        F.when(values.isNull(), _unread(value, "map<string,string>"))
        .when(F.size(values) != 1, FOLLOWED)
        .when(~value.rlike(r"^\s*\{"), NO_OBJECT)
        .otherwise(_object_flaw(F.col("_marked")))
    )
    return _judged(found.withColumn("flaw", flaw), value)


def array_records(documents: DataFrame, text: str = "value") -> DataFrame:
    """As ``line_records`` for texts that each hold one JSON array of objects.

    A document that cannot be read to its end, or is no array, is one flawed row with its whole
    text. Of a sound one every element is a row of its own: NULLs and other elements that are no
    objects are flawed, with the element as their text.
    """
    value = F.col(text)
    values = values_before_end(value)
    whole = (
        F.when(values.isNull(), _unread(value, "array<string>"))
        .when(F.size(values) != 1, FOLLOWED)
        .when(~value.rlike(r"^\s*\["), NO_ARRAY)
    )
    elements = F.arrays_zip(
        _parsed(mark_numbers(value), "array<string>").alias("marked"),
        _parsed(_mark_strings(value), "array<string>").alias("kind"),
    )
    told = documents.where(value.rlike(r"\S")).withColumn("_whole", whole)
    # A document with a flaw of its own is one row; an empty array is none.
    alone = F.array(
        F.struct(F.lit(None).cast("string").alias("marked"), F.lit(None).cast("string").alias("kind"))
    )
    told = told.withColumn(
        "_element", F.explode(F.when(F.col("_whole").isNotNull(), alone).otherwise(elements))
    )
    marked, kind = F.col("_element.marked"), F.col("_element.kind")
    flaw = (
        F.when(F.col("_whole").isNotNull(), F.col("_whole"))
        .when(marked.isNull() | ~F.startswith(kind, F.lit("{")), NO_OBJECT)
        .otherwise(_object_flaw(F.col("_marked")))
    )
    element = F.coalesce(unmark_numbers(marked), F.lit("null"))
    shown = F.when(F.col("_whole").isNotNull(), value).otherwise(element)
    found = told.withColumn("_marked", marked).withColumn("flaw", flaw)
    return _judged(found, shown).drop("_whole", "_element")


def _judged(found: DataFrame, shown: Column) -> DataFrame:
    sound = F.col("flaw").isNull()
    return found.withColumns(
        {
            "record": F.when(sound, _fields(F.col("_marked"))),
            "flawed_text": F.when(~sound, shown),
        }
    ).drop("_marked")
