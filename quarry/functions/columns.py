"""Columns over parsed documents (VARIANT) and strings: safe access, truthiness, names, keys, cleaning, signatures."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cell texts that count as missing when a CSV file is read.
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

#: JSON forms of values that count as missing.
FALSY = ["null", "false", "0", "-0", "0.0", "-0.0", '""', "{}", "[]"]


def path_of(*keys: str) -> str:
    return "$" + "".join(f".{k}" for k in keys)


def safe_get(doc: Column, *keys: str, kind: str = "string") -> Column:
    """The value at a path, or null where a step is missing, no object, or not of the kind asked for."""
    return F.try_variant_get(doc, path_of(*keys), kind)


def type_of(doc: Column, *keys: str) -> Column:
    """The variant type at a path: null if absent, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(doc, path_of(*keys), "variant"))


def is_array(doc: Column, *keys: str) -> Column:
    """whether the value at a path is a list; false if absent or null."""
    return F.coalesce(type_of(doc, *keys).startswith("ARRAY"), F.lit(False))


def is_object(doc: Column, *keys: str) -> Column:
    found = F.schema_of_variant(doc) if not keys else type_of(doc, *keys)
    return F.coalesce(found.startswith("OBJECT"), F.lit(False))


def truthy(doc: Column, *keys: str) -> Column:
    """Present and neither null, false, zero, nor an empty string, list or object. A string "0" is present. Never null."""
    text = F.to_json(F.try_variant_get(doc, path_of(*keys), "variant"))
    return F.coalesce(~text.isin(FALSY), F.lit(False))


def is_filled(text: Column) -> Column:
    """Neither null nor empty; never null."""
    return F.coalesce(text != "", F.lit(False))


def full_name(first: Column, last: Column) -> Column:
    """P10: both names with one space between, empty for a missing one; a single space if both are."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def quote_key(doc: Column) -> Column:
    """quote_number unless empty, else number; as a string."""
    return F.coalesce(F.nullif(safe_get(doc, "quote_number"), F.lit("")), F.nullif(safe_get(doc, "number"), F.lit("")))


def root_component(components: Column) -> Column:
    """The first component flagged as root, or null."""
    return F.get(F.filter(components, lambda c: F.coalesce(~c["is_root_component"].isin("false", "0", ""), F.lit(False))), F.lit(0))


def root_attributes(root: Column) -> dict[str, Column]:
    """Attributes of a root component; empty where there is none."""
    plain = {n: F.coalesce(root[n], F.lit("")) for n in ("part_number", "part_uuid", "description", "revision", "type")}
    return plain | {n: F.coalesce(root[n]["name"], F.lit("")) for n in ("material", "process")}


def is_fully_configured(part_number: Column, description: Column, material: Column, process: Column) -> Column:
    """all four filled; never null."""
    return is_filled(part_number) & is_filled(description) & is_filled(material) & is_filled(process)


def stripped(text: Column) -> Column:
    """U4: without white space (of any script) at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def na_to_null(text: Column) -> Column:
    """U8: null for the texts that count as missing."""
    return F.when(~text.isin(NA_STRINGS), text)


def hmac_pads(secret: str) -> tuple[str, str]:
    """Inner and outer pad of HMAC-SHA256 as hex."""
    key = secret.encode()
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256(body: Column, secret: str) -> Column:
    """hex HMAC-SHA256 of a body, by built-in functions."""
    inner, outer = hmac_pads(secret)
    digest = F.sha2(F.concat(F.unhex(F.lit(inner)), F.encode(body, "UTF-8")), 256)
    return F.sha2(F.concat(F.unhex(F.lit(outer)), F.unhex(digest)), 256)


def rows_where(df: DataFrame, condition: Column) -> DataFrame:
    """df filtered, with the condition and the columns it needs computed once.

    A plain filter moves below the projections that it refers to, and each parse in them would run again for every reference; a generator keeps it above.
    """
    row = F.when(condition, F.struct(*(F.col(c) for c in df.columns)))
    return df.select(F.explode_outer(F.array(row)).alias("row")).filter("row IS NOT NULL").select("row.*")
