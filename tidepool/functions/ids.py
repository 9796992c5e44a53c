"""Identifier expressions: chunk ids and RFC 4122 version-5 UUIDs in SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 4122 URL namespace (Python's uuid.NAMESPACE_URL).
NAMESPACE_URL_HEX = "6ba7b8119dad11d180b400c04fd430c8"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chunk_id(doc_id, start) -> Column:
    """``f"{doc_id}_chunk_{start:04d}"`` (more digits are kept, never cut)."""
    return F.format_string("%s_chunk_%04d", _col(doc_id).cast("string"), _col(start))


def uuid5(name, namespace_hex: str = NAMESPACE_URL_HEX) -> Column:
    """``str(uuid.uuid5(namespace, name))`` computed on executors.

    SHA-1 over namespace bytes + UTF-8 name, first 128 bits, version nibble
    set to 5 and the variant bits to 10xx.
    """
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(_col(name), "UTF-8")))
    variant_nibble = F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4
    variant = F.substring(F.lit("89ab"), variant_nibble + 1, 1)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
