"""Deterministic masking of e-mail addresses and phone numbers."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskwright import fixed
from deskwright.functions import sql
from deskwright.functions.text import strip


def mask_email(c: Column) -> Column:
    """Stable alias of an address."""
    return sql.bind(strip(c), sql.email_alias("x"))


def mask_text(c: Column) -> Column:
    """Replace e-mail addresses by aliases, then phone-like runs by a mark."""
    return sql.bind(c, sql.mask_text("x"))


def mask_value(c: Column, dtype: T.DataType, key: str = "", mask_lists: bool = True) -> Column:
    """Mask one payload value by its key and type. Nulls stay null, numbers and booleans too."""
    if key.casefold() in fixed.SENSITIVE_KEYS:
        text = c.cast("string") if isinstance(dtype, T.AtomicType) else F.to_json(c)
        hidden = F.when(text.contains("@"), mask_email(text)).otherwise(fixed.REDACTED_MARK)
        return F.when(c.isNotNull(), hidden)
    if isinstance(dtype, T.StringType):
        return mask_text(c)
    if isinstance(dtype, T.StructType):
        return F.when(c.isNotNull(), mask_struct(c.getField, dtype, mask_lists))
    if isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
        # Hidden values are text, whatever the others are: both become variants.
        def variant(v: Column, kind: T.DataType) -> Column:
            return v.cast("variant") if isinstance(kind, T.AtomicType) else F.to_variant_object(v)

        def entry(k: Column, v: Column) -> Column:
            hidden = mask_value(v, dtype.valueType, fixed.SENSITIVE_KEYS[0])
            open_value = mask_value(v, dtype.valueType, "", mask_lists)
            if isinstance(dtype.valueType, T.StringType):
                return F.when(F.lower(k).isin(fixed.SENSITIVE_KEYS), hidden).otherwise(open_value)
            return F.when(F.lower(k).isin(fixed.SENSITIVE_KEYS), hidden.cast("variant")).otherwise(
                variant(open_value, dtype.valueType)
            )

        return F.transform_values(c, entry)
    if isinstance(dtype, T.ArrayType) and mask_lists:
        return F.transform(c, lambda v: mask_value(v, dtype.elementType, "", mask_lists))
    return c


def mask_struct(
    field: Callable[[str], Column], schema: T.StructType, mask_lists: bool = True
) -> Column:
    """Mask every field of a record; ``field`` gives the column for a field name."""
    plain = [
        f.name
        for f in schema.fields
        if isinstance(f.dataType, T.StringType) and f.name.casefold() not in fixed.SENSITIVE_KEYS
    ]

    def record(masked: dict[str, Column]) -> Column:
        return F.struct(
            *[
                (
                    masked[f.name]
                    if f.name in masked
                    else mask_value(field(f.name), f.dataType, f.name, mask_lists)
                ).alias(f.name)
                for f in schema.fields
            ]
        )

    if not plain:
        return record({})
    # The masked texts are bound to a name: inside a condition Spark would mask all of them again for
    # each field that is taken from them.
    masked = F.call_function(
        "transform", F.array(*[field(name) for name in plain]), F.expr(f"x -> {sql.mask_text('x')}")
    )
    records = F.transform(
        F.array(masked), lambda m: record({name: F.get(m, F.lit(i)) for i, name in enumerate(plain)})
    )
    return F.get(records, F.lit(0))


def to_payload(record: Column) -> Column:
    """JSON text that keeps null fields."""
    return F.to_json(record, {"ignoreNullFields": "false"})


def mask_json(mask_lists: bool = True):
    """Column function that masks JSON objects of unknown shape, whatever their depth.

    Arrow-batched, and used only on the rejected lines of JSON exports. Nulls stay null.
    """
    # Plain local values, so that workers need neither this package nor its path.
    email = re.compile(fixed.EMAIL_PATTERN_PYTHON, re.IGNORECASE)
    phone = re.compile(fixed.PHONE_PATTERN_PYTHON)
    sensitive, phone_mark, redacted = fixed.SENSITIVE_KEYS, fixed.PHONE_MARK, fixed.REDACTED_MARK
    digits, domain, raw_chars = fixed.ALIAS_HEX_DIGITS, fixed.ALIAS_DOMAIN, fixed.RAW_LINE_CHARS

    def alias(text: str) -> str:
        folded = text.strip().casefold().encode("utf-8", "replace")
        return hashlib.sha256(folded).hexdigest()[:digits] + domain

    def compact(value) -> str:
        return json.dumps(value, ensure_ascii=False, separators=(",", ":"))

    def hide(value, key: str = ""):
        if value is None:
            return None
        if key.casefold() in sensitive:
            text = value if isinstance(value, str) else compact(value)
            return alias(text) if "@" in text else redacted
        if isinstance(value, str):
            return phone.sub(phone_mark, email.sub(lambda m: alias(m.group()), value))
        if isinstance(value, dict):
            return {k: hide(v, k) for k, v in value.items()}
        if isinstance(value, list) and mask_lists:
            return [hide(v) for v in value]
        return value

    def hide_line(line: str | None) -> str | None:
        if line is None:
            return None
        try:
            text = compact(hide(json.loads(line)))
        except (ValueError, RecursionError):
            text = json.dumps({"raw": hide(line[:raw_chars])})
        return text.encode("utf-8", "replace").decode()

    @F.pandas_udf("string")
    def mask(lines: pd.Series) -> pd.Series:
        return lines.map(hide_line)

    return mask
