"""Packing by a space-filling curve: neighbouring documents share sequences.

Each document's token ids are counted into a hashed vector, projected to a few
dimensions by a fixed Gaussian matrix and numbered along a Hilbert curve.  All
documents are range-sorted by that number, their token counts summed along the
curve, and the one long run of ids is cut every ``LENGTH`` ids.  A document may
so begin in one sequence and end in another; only the last sequence of all has
padding.

The ids are written once (two bytes each while the vocabulary allows) and the sort
moves narrow rows only: order key, row number, count.  The start of each document
then comes back to its ids by one join on the row number.
"""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import map_slices, mix64, model, running_start
from tidepool.llm.rank_bpe import WordRanks
from tidepool.session import files_for, materialize

LENGTH, END_ID = 2048, 1
FILE_ROWS = 8192  # documents of a file of pieces
BUCKETS, DIMENSIONS, BITS, SPREAD = 512, 3, 16, 4.0  # hashed vector, projection, bits and half width of an axis


# Fixed value: the split of lower-cased text into pieces that the word tokenizer never joins, in classes for ASCII and Latin letters.
LATIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zA-ZÀ-ÖØ-öø-ɏ]+|[0-9]|[^\sa-zA-ZÀ-ÖØ-öø-ɏ0-9]+")
# Letters that those classes do not cover: beyond the range, or with a lower-case form beyond it.
_COVERED = "".join(c for c in map(chr, range(0xC0, 0x250)) if re.fullmatch("[a-zÀ-ɏ]", c.lower()))
OTHER_LETTERS = re.compile(rf"[^\t\n\r -~{_COVERED}]")


class WordTokenizer:
    """Ids of whole texts from the word tokenizer, which lower-cases and never joins characters over white space.

    Texts of ASCII and Latin letters are cut into letter runs, digits and sign runs, and
    these are merged by rank, each text on its own.  What lies between spaces of other
    texts goes to the tokenizers library, distinct strings once; their ids are kept as bytes.
    """

    def __init__(self, path: str, limit: int = 300_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranks = WordRanks(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def _latin(self, text: str) -> bytes | None:
        """Ids of a text of ASCII and Latin letters; of any other None."""
        if OTHER_LETTERS.search(text) or any(s in text for s in self.special):
            return None
        return self.ranks.encode(LATIN_PIECES.findall(text.lower())).astype(self.dtype).tobytes()

    def _others(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known.clear()
        split = [t.replace("\n", " ").split(" ") for t in texts]
        fresh = list({p for chunks in split for p in chunks if p not in self.known})
        for p, e in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)):
            self.known[p] = np.array(e.ids, self.dtype).tobytes()
        return [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        coded = [self._latin(t or "") for t in texts]
        rest = [t for t, ids in zip(texts, coded) if ids is None]
        others = iter(self._others(rest) if rest else ())
        return [next(others) if ids is None else ids for ids in coded]


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of ``path``, loaded once per Python worker and kept while its tasks take it."""
    return model(("words", path), lambda: WordTokenizer(path))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Distance along the Hilbert curve of integer points (n, d), by Skilling's transposition; d * bits <= 63."""
    x = points.astype(np.uint64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        q, p = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] >> np.uint64(level)) & np.uint64(1), np.uint64((1 << level) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(level)) & np.uint64(1))
    return key.astype(np.int64)


class CurveKey:
    """Hilbert numbers of token id sequences: hashed counts, projected, scaled to the grid."""

    def __init__(self, vocabulary: int, seed: int = 7):
        h = mix64(np.arange(vocabulary, dtype=np.uint64) + np.uint64(0x51ED))
        self.bucket = (h % np.uint64(BUCKETS)).astype(np.int32)
        self.plane = np.random.default_rng(seed).standard_normal((BUCKETS, DIMENSIONS))

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        v = np.stack([np.bincount(self.bucket[ids], minlength=BUCKETS) for ids in documents]).astype(np.float64)
        v = np.log1p(v)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        cells = ((v @ self.plane / SPREAD + 1) / 2 * (1 << BITS)).clip(0, (1 << BITS) - 1)
        return hilbert(cells.astype(np.uint64), BITS)


def _tokenizing(path: str):
    def make():
        tokenizer = word_tokenizer(path)
        curve = CurveKey(tokenizer.size)

        def step(cols):
            ids = tokenizer.encode(cols["text"])
            arrays = [np.frombuffer(b, tokenizer.dtype) for b in ids]
            return {"row": cols["row"], "doc_id": cols["doc_id"], "key": curve.keys(arrays),
                    "tokens": [len(a) + 1 for a in arrays], "ids": ids}
        return step
    return make


def _cutting(length: int, end_id: int):
    def make():
        def step(cols):
            out = {k: [] for k in ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")}
            for doc, raw, at, tokens in zip(cols["doc_id"], cols["ids"], cols["start"], cols["tokens"]):
                ids = np.append(np.frombuffer(raw, "<u2" if len(raw) == 2 * (tokens - 1) else "<u4"), end_id).astype("<u4")
                begin = 0
                while begin < len(ids):
                    sequence, offset = divmod(at + begin, length)
                    size = min(length - offset, len(ids) - begin)
                    for k, v in zip(out, (doc, begin, size, ids[begin:begin + size].tobytes(), len(ids), sequence, offset)):
                        out[k].append(v)
                    begin += size
            return out
        return step
    return make


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pack ``docs`` (doc_id, text; other columns are not read) into sequences of ``length`` ids.

    One row per piece: doc_id, start (ids of its document before it), length, ids
    (binary, little-endian unsigned 32-bit), doc_tokens (with the end id), sequence_id
    and offset.  Sequences are full but for the last.  A null or empty text is the
    end id alone; a null doc_id stays null; repeated rows are packed each; equal curve
    keys are ordered by row; a text longer than a sequence is cut into several pieces;
    an empty table gives no rows.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    coded = materialize(map_slices(rows, _tokenizing(path), "row long, doc_id long, key long, tokens long, ids binary"), "token-ids")
    files = files_for(docs.sparkSession, coded.count(), FILE_ROWS)
    starts = running_start(coded.select("key", "row", "tokens"), ["key", "row"], "tokens", "curve", files)
    placed = coded.select("row", "doc_id", "ids", "tokens").join(starts.select("row", "start"), "row")
    return map_slices(placed.select("doc_id", "ids", "start", "tokens"), _cutting(length, end_id),
                      "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long").coalesce(files)
