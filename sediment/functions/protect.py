"""Column protection: one-way digests, and reversible encryption where it is asked for."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.config import SpecError
from sediment.functions.registry import register


@register("sha256")
def sha256(c: Column) -> Column:
    return F.sha2(c.cast("string"), 256)


def encrypt(c: Column, key: Column) -> Column:
    """AES-GCM with a random vector, as base64 text."""
    return F.base64(F.aes_encrypt(c.cast("string"), key))


def decrypt(c: Column, key: Column) -> Column:
    return F.aes_decrypt(F.unbase64(c), key).cast("string")


def protect_columns(
    df: DataFrame, columns: Iterable[str] | Mapping[str, str], key: Column | None = None
) -> DataFrame:
    """Replace the named columns; a mapping gives the protection per column (``sha256`` or ``aes``),
    a plain list means ``sha256``. A name that is not there is an error: it would stay readable
    under another name."""
    wanted = dict(columns) if isinstance(columns, Mapping) else dict.fromkeys(columns, "sha256")
    changed = {}
    for name, kind in wanted.items():
        if name not in df.columns:
            raise SpecError(f"no column {name} to protect")
        if kind == "sha256":
            changed[name] = sha256(F.col(name))
        elif kind == "aes":
            if key is None:
                raise SpecError(f"column {name} asks for aes but no key was given")
            changed[name] = encrypt(F.col(name), key)
        else:
            raise SpecError(f"unknown protection {kind!r} for column {name}")
    return df.withColumns(changed) if changed else df
