"""Types and paths as VARIANT functions take them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import types as T


def as_text(kind: T.DataType) -> T.DataType:
    """The same shape with every leaf read as the text it is in the file."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    return T.StringType()


def ddl(kind: T.DataType) -> str:
    """A type in SQL, with every name quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {ddl(f.dataType)}" for f in kind.fields) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{ddl(kind.elementType)}>"
    return kind.simpleString()


def variant_path(path: Sequence[str]) -> str:
    """The path of a field below a VARIANT, whatever its name."""
    return "$" + "".join(f"[{json.dumps(name, ensure_ascii=False)}]" for name in path)
