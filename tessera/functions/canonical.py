"""The one text of a payload: JSON in the order of its fields, two blanks a level, non-ASCII characters as they are, a line feed at the end."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scalars import let

_SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _quoted(text: Column) -> Column:
    """Quotes, the backslash and control characters are escaped, nothing else; texts without any, most of them, are looked at once."""

    def escaped(value: Column) -> Column:
        for plain, short in _SHORT.items():
            value = F.replace(value, F.lit(plain), F.lit(short))
        return let(value, lambda v: F.when(v.rlike(r"[\x00-\x1f]"), rare(v)).otherwise(v))

    def rare(value: Column) -> Column:
        for code in range(32):
            if chr(code) not in _SHORT:
                value = F.replace(value, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
        return value

    return F.concat(F.lit('"'), F.when(text.rlike(r'["\\\x00-\x1f]'), escaped(text)).otherwise(text), F.lit('"'))


def _wrapped(parts: Column, none: Column, ends: str, level: int) -> Column:
    """Parts one to a line between the ends, which stand alone if there are none.  ``none`` tells that without the parts, whose text would
    else be made twice on each level."""
    inner, outer = "\n" + "  " * (level + 1), "\n" + "  " * level
    some = F.concat(F.lit(ends[0] + inner), F.array_join(parts, "," + inner), F.lit(outer + ends[1]))
    return F.when(none, F.lit(ends)).otherwise(some)


def _text(value: Column, kind: T.DataType, level: int) -> Column:
    if isinstance(kind, T.StructType):
        none, fields = F.lit(True), []
        for f in kind.fields:
            none = none & value[f.name].isNull()
            fields.append(F.when(value[f.name].isNotNull(), F.concat(F.lit(json.dumps(f.name, ensure_ascii=False) + ": "), _text(value[f.name], f.dataType, level + 1))))
        # array_join leaves nulls out
        return _wrapped(F.array(*fields) if fields else F.array().cast("array<string>"), none, "{}", level)
    if isinstance(kind, T.ArrayType):
        return _wrapped(F.transform(value, lambda x: F.coalesce(_text(x, kind.elementType, level + 1), F.lit("null"))), F.size(value) == 0, "[]", level)
    if isinstance(kind, T.StringType):
        return _quoted(value)
    if isinstance(kind, (T.BooleanType, T.IntegralType)):
        return value.cast("string")
    raise TypeError(f"payloads have no {kind.simpleString()}")


def payload_text(value: Column, kind: T.StructType) -> Column:
    """The text of a struct: fields that are null are left out, null elements of arrays are ``null``."""
    return F.concat(_text(value, kind, 0), F.lit("\n"))


def payload_bytes(value: Column, kind: T.StructType) -> Column:
    return F.encode(payload_text(value, kind), "UTF-8")
