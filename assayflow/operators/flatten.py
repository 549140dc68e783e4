"""Nested records to flat columns, driven by the schema and built of native columns.

A leaf becomes a column named after the leaf key alone. When two leaves share a
name the later one in document order wins, also from inside a list, whose last
element counts. An absent object and an empty list contribute nothing, so an
earlier value stays.

Records are columns of structs, or VARIANTs under a schema. A VARIANT knows an absent
leaf, which contributes nothing, from an explicit null, which replaces an earlier value;
inside a struct that is present, NULL always replaces.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayflow.operators.variants import as_text, ddl, variant_path

VARIANT = "variant"
COLLISION_RULES = ("last_wins", "error", "prefix")
ARRAY_RULES = ("last_element", "keep")


@dataclass(frozen=True)
class _Leaf:
    path: tuple[str, ...]
    value: Column
    present: Column | None  # None: present in every record

    @property
    def name(self) -> str:
        return self.path[-1]


def _both(a: Column | None, b: Column) -> Column:
    return b if a is None else a & b


def _list_leaves(path: tuple[str, ...], items: Column, element: T.DataType, present) -> Iterator[_Leaf]:
    """Leaves below a list. ``items`` holds every element in visiting order."""
    if isinstance(element, T.StructType):
        objects = F.filter(items, lambda x: x.isNotNull())
        for field in element.fields:
            # A field of a list of objects is the list of that field's values.
            yield from _list_leaves((*path, field.name), objects.getField(field.name), field.dataType, present)
    elif isinstance(element, T.ArrayType):
        inner = F.flatten(F.filter(items, lambda x: x.isNotNull()))
        yield from _list_leaves(path, inner, element.elementType, present)
    else:
        yield _Leaf(path, F.try_element_at(items, F.lit(-1)), _both(present, F.size(items) > 0))


def _leaves(
    schema: T.StructType, arrays: str, parent: Column | None = None, path: tuple[str, ...] = (), present=None
) -> Iterator[_Leaf]:
    for field in schema.fields:
        here = (*path, field.name)
        value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        kind = field.dataType
        if isinstance(kind, T.StructType):
            yield from _leaves(kind, arrays, value, here, _both(present, value.isNotNull()))
        elif isinstance(kind, T.ArrayType) and arrays == "last_element":
            yield from _list_leaves(here, value, kind.elementType, _both(present, value.isNotNull()))
        else:
            yield _Leaf(here, value, present)


def flatten(
    df: DataFrame,
    on_collision: str = "last_wins",
    arrays: str = "last_element",
) -> DataFrame:
    """One column per leaf of the schema, without a UDF or a shuffle.

    ``on_collision``: ``last_wins``, ``error``, or ``prefix`` (a later leaf of a
    taken name is called by its full path, joined with ``_``).
    ``arrays``: ``last_element``, or ``keep`` to leave lists as array columns.
    """
    _known(on_collision, arrays)
    return df.select(*_columns(_leaves(df.schema, arrays), on_collision))


def _known(on_collision: str, arrays: str) -> None:
    if on_collision not in COLLISION_RULES or arrays not in ARRAY_RULES:
        raise ValueError(f"on_collision in {COLLISION_RULES}, arrays in {ARRAY_RULES}")


def _columns(leaves: Iterable[_Leaf], on_collision: str) -> list[Column]:
    """One column per leaf name; on a collision the rule decides."""
    out: dict[str, Column] = {}
    for leaf in leaves:
        if leaf.name not in out:
            # A leaf of an absent object is NULL anyway; an empty list needs no guard either.
            out[leaf.name] = leaf.value
        elif on_collision == "error":
            raise ValueError(f"two leaves are named {leaf.name!r}, the later one at {'.'.join(leaf.path)}")
        elif on_collision == "prefix":
            out["_".join(leaf.path)] = leaf.value
        elif leaf.present is None:
            out[leaf.name] = leaf.value
        else:
            out[leaf.name] = F.when(leaf.present, leaf.value).otherwise(out[leaf.name])
    return [value.alias(name) for name, value in out.items()]


def _text_cast(value: Column, kind: T.DataType) -> Column:
    """A VARIANT in a declared type, by way of its text: text that is no such value fails (ANSI mode)."""
    text = F.variant_get(value, "$", "string")
    return text if isinstance(kind, T.StringType) else text.cast(kind)


def _taking(path: str, kind: str) -> Callable[[Column], Column]:
    """What an element of a list has at a path."""
    return lambda x: F.try_variant_get(x, path, kind)


def _present(items: Column) -> Column:
    return F.filter(items, lambda x: x.isNotNull())


def _visited(path: tuple[str, ...], items: Column, element: T.DataType) -> Iterator[_Leaf]:
    """Leaves below a list. ``items`` holds every element in visiting order, as VARIANTs."""
    if isinstance(element, T.StructType):
        for field in element.fields:
            values = _present(F.transform(items, _taking(variant_path((field.name,)), VARIANT)))
            yield from _visited((*path, field.name), values, field.dataType)
    elif isinstance(element, T.ArrayType):
        lists = F.transform(items, _taking("$", f"array<{VARIANT}>"))
        yield from _visited(path, F.flatten(_present(lists)), element.elementType)
    else:
        yield _Leaf(path, _text_cast(F.try_element_at(items, F.lit(-1)), element), F.size(items) > 0)


def _variant_leaves(record: str, schema: T.StructType, arrays: str, path: tuple[str, ...] = ()) -> Iterator[_Leaf]:
    for field in schema.fields:
        here, kind = (*path, field.name), field.dataType
        if isinstance(kind, T.StructType):
            yield from _variant_leaves(record, kind, arrays, here)
            continue
        value = F.try_variant_get(record, variant_path(here), VARIANT)
        if not isinstance(kind, T.ArrayType):
            yield _Leaf(here, _text_cast(value, kind), value.isNotNull())
        elif arrays == "last_element":
            items = F.try_variant_get(record, variant_path(here), f"array<{VARIANT}>")
            yield from _visited(here, F.coalesce(items, F.array().cast(f"array<{VARIANT}>")), kind.elementType)
        else:
            yield _Leaf(here, F.variant_get(value, "$", ddl(as_text(kind))).cast(kind), value.isNotNull())


def flatten_variant(
    df: DataFrame, record: str, schema: T.StructType, on_collision: str = "last_wins", arrays: str = "last_element"
) -> DataFrame:
    """The same from the VARIANT column ``record`` under a schema; the other columns follow.

    An absent leaf keeps the value of an earlier one of its name, an explicit null replaces it.
    A leaf that is a list of objects is taken from the last object that has it.
    """
    _known(on_collision, arrays)
    leaves = _columns(_variant_leaves(record, schema, arrays), on_collision)
    return df.select(*leaves, *(c for c in df.columns if c != record))
