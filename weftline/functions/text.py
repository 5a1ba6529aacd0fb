"""Scalar expressions that readers, passes and lowering share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"(?U)^\s+|\s+$"


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(text, _SPACE, "")


def is_blank(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit("")) == ""


def number(form: str, n: Column) -> Column:
    """``form % n``; never cuts long numbers."""
    return F.format_string(form, n)


def xml_escaped(text: Column) -> Column:
    return F.replace(
        F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")
    )


def content_text(content: Column) -> Column:
    """The texts (or JSON values) of content blocks, one a line."""
    return F.array_join(
        F.filter(F.transform(content, lambda b: F.coalesce(b["text"], b["json"])), lambda x: x.isNotNull()), "\n"
    )


def observation_parts(o: Column) -> Column:
    given = lambda x: F.nullif(x, F.lit(""))
    parts = F.concat(
        F.array(given(o["stdout"]), given(o["stderr"])),
        F.transform(
            F.coalesce(o["content"], F.array().cast("array<struct<type:string,text:string,json:string>>")),
            lambda b: F.coalesce(b["text"], b["json"])
        )
    )
    return F.filter(parts, lambda x: x.isNotNull())


def observation_text(o: Column) -> Column:
    """stdout, stderr and content, one a line; null if there is none."""
    parts = observation_parts(o)
    return F.when(F.size(parts) > 0, F.array_join(parts, "\n"))


# -- JSON text and variants ------------------------------------------------------------


def get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def kind_of(v: Column) -> Column:
    """STRING, ARRAY<..>, OBJECT<..>, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, VOID; null if there is no value."""
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return F.coalesce(kind_of(v) == "STRING", F.lit(False))


def is_list(v: Column) -> Column:
    return F.coalesce(kind_of(v).startswith("ARRAY"), F.lit(False))


def is_object(v: Column) -> Column:
    return F.coalesce(kind_of(v).startswith("OBJECT"), F.lit(False))


def is_bool(v: Column) -> Column:
    return F.coalesce(kind_of(v) == "BOOLEAN", F.lit(False))


def exists(v: Column) -> Column:
    """There is a value and it is not null."""
    return F.coalesce(kind_of(v) != "VOID", F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value written, and computed, once: keeps nested expressions small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at(v: Column, path: str) -> Column:
    return v if path == "$" else get(v, path)


def string(v: Column, path: str = "$") -> Column:
    """The value if it is a string."""
    return let(_at(v, path), lambda x: F.when(is_string(x), F.try_variant_get(x, "$", "string")))


def said(v: Column, path: str = "$") -> Column:
    """The value as text: strings as they are, others as JSON; null for null."""
    return let(
        _at(v, path), lambda x: F.when(is_string(x), F.try_variant_get(x, "$", "string")).when(exists(x), F.to_json(x))
    )


def items(v: Column, path: str = "$") -> Column:
    """The elements if the value is a list."""
    return let(_at(v, path), lambda x: F.when(is_list(x), F.try_variant_get(x, "$", "array<variant>")))


def filled_items(v: Column, path: str) -> Column:
    """The elements of a list that has some."""
    return let(items(v, path), lambda x: F.when(F.size(x) > 0, x))
