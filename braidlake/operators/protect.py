"""Pseudonymised, encrypted and masked copies of tables with personal data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions.text import document_mask


def protect(
    df: DataFrame,
    hashes: Mapping[str, tuple[str, int]] | None = None,
    written_form: Sequence[str] = (),
    encrypt: Mapping[str, Column] | None = None,
    masks: Sequence[str] = (),
    drop: Sequence[str] = (),
) -> DataFrame:
    """Hide personal columns.

    * ``hashes``: output column -> (input column, sha2 bits); inputs named in ``written_form`` are
      hashed as 000.000.000-00, which keeps keys equal to systems that store documents that way;
    * ``encrypt``: column -> key, AES in place, base64 text;
    * ``masks``: letters and digits replaced, shape kept;
    * ``drop``: removed at the end.
    """
    out = {}
    for name, (source, bits) in (hashes or {}).items():
        text = document_mask(source) if source in written_form else F.col(source).cast("string")
        out[name] = F.sha2(text, bits)
    for name, key in (encrypt or {}).items():
        out[name] = F.base64(F.aes_encrypt(F.col(name).cast("string"), key))
    for name in masks:
        out[name] = F.mask(F.col(name).cast("string"))
    return (df.withColumns(out) if out else df).drop(*drop)


def decrypt(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Clear text of columns encrypted by ``protect``; a wrong key gives NULL."""
    return df.withColumns(
        {
            c: F.try_aes_decrypt(F.unbase64(F.col(c)), key).cast("string")
            for c, key in columns.items()
        }
    )


def secure_view(df: DataFrame, name: str, personal: Sequence[str], masked: bool = False) -> DataFrame:
    """Register a temporary view without the personal columns, or with them masked."""
    safe = (
        df.withColumns({c: F.mask(F.col(c).cast("string")) for c in personal if c in df.columns})
        if masked
        else df.drop(*personal)
    )
    safe.createOrReplaceTempView(name)
    return safe
