"""Text expressions: Unicode strip, whitespace collapse, sentence split, tokenise.

All but ``split_tokens`` are JVM-side regular-expression functions, so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (what ``\s``,
# ``str.strip()`` and ``str.split()`` use in the contract and the chunker).
# Written with \x{..} escapes so Java regex and RE2 read the same class.
WS_CLASS = (r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set spelled for Java's regex engine, where it runs ~2x faster:
# Character.isWhitespace plus the four characters it leaves out.  (Checked
# against str.isspace over every code point in tests/test_text.py.)
JAVA_WS_CLASS = r"[\p{javaWhitespace}\x{85}\x{A0}\x{2007}\x{202F}]"
# The same set as plain characters, for the character-set form of TRIM.
WS_CHARS = "".join(chr(c) for c in [0x09, 0x0A, 0x0B, 0x0C, 0x0D, *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                                    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """``str.strip()``: drop Unicode whitespace at both ends.

    ``TRIM(BOTH <set> FROM c)`` with the whole whitespace set (plain ``trim``
    drops only spaces): a character scan, no regex.
    """
    return F.trim(_col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """``re.sub(r"\\s+", " ", t).strip()``."""
    return F.trim(F.regexp_replace(_col(c), f"{JAVA_WS_CLASS}+", " "))


def sentence_split(c) -> Column:
    """Sentences of a text: collapse whitespace, split after ``. ! ?``, drop blanks.

    Returns ``array<string>``; an empty or blank text gives an empty array.
    """
    clean = collapse_ws(c)
    parts = F.split(clean, r"(?<=[.!?]) ")
    return F.filter(parts, lambda s: s != "")


def tokenize(c) -> Column:
    """``text.lower().split()``: lower case, split on whitespace runs, no empty tokens."""
    clean = collapse_ws(F.lower(_col(c)))
    return F.filter(F.split(clean, " "), lambda s: s != "")


def tokenize_collapsed(c) -> Column:
    """``tokenize`` for text already in collapsed form (single spaces, no outer
    whitespace), such as chunk text: one split, no regex pass."""
    return F.filter(F.split(F.lower(_col(c)), " "), lambda s: s != "")


def split_tokens(lowered: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``tokenize_collapsed`` over an Arrow column of texts that are in lower case already: the row and the code of
    every token, and the distinct tokens by code.  A null has no tokens."""
    parts = pc.split_pattern(lowered, " ")
    row, words = pc.list_parent_indices(parts), pc.list_flatten(parts)
    filled = pc.not_equal(words, "")
    coded = words.filter(filled).dictionary_encode()
    return row.filter(filled).to_numpy().astype(np.int64), coded.indices.to_numpy().astype(np.int64), coded.dictionary
