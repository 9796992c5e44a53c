"""Byte-level BPE by backtracking: longest token matches, checked pair by pair.

A token sequence is what merging by rank gives exactly if every two neighbours are
compatible: merging their joined bytes gives these two tokens again.  So the encoder
takes the longest token at each place, found for all places in one scan of the piece
by an Aho-Corasick automaton.  Where two neighbours are not compatible it tries the
next shorter token of that place, and steps back over a place from which no way on is
left.  A place given up is never tried again, so the time is linear in the text (the
scan meets, at each place, the tokens that end there).  Decoding joins byte strings
through an offset table.
"""

from __future__ import annotations

import json
import re
from array import array
from hashlib import sha256

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from tidepool.llm.common import Memo, gather, map_slices, offset_table

# Fixed value: the split of a text into pieces that byte-level BPE never merges across.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The same split for texts of ASCII and Latin letters only, in classes that the faster engine of the standard library has.
LATIN_PIECES = PIECES.replace(r"\p{L}", "A-Za-zÀ-ÖØ-öø-ɏ").replace(r"\p{N}", "0-9").replace(" ?A-Za-zÀ-ÖØ-öø-ɏ+", " ?[A-Za-zÀ-ÖØ-öø-ɏ]+").replace(" ?0-9+", " ?[0-9]+")

_LONGEST_KEPT = 64  # longer pieces of text are encoded each time, which bounds the memory of what is kept


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Encoder and decoder of one tokenizer file (JSON, byte-level BPE without normaliser)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocabulary: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocabulary.values(), *self.special.values()])
        self.bytes = [b""] * size
        for word, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in word)
        for word, i in self.special.items():
            self.bytes[i] = word.encode("utf-8")
        self.rank: dict[int, int] = {}  # by the two tokens in one number
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[int, int] = {}  # rank at which a token comes to be
        for r, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (vocabulary[left], vocabulary[right]), vocabulary[left + right]
            self.rank.setdefault(pair[0] << 32 | pair[1], r)
            if whole not in self.parts:
                self.parts[whole], self.made[whole] = pair, r
        self.spines = (Memo(lambda t: self._spine(t, 0), size), Memo(lambda t: self._spine(t, 1), size))
        self.compatible = Memo(self._compatible, 500_000)
        self.token_of = {raw.decode("latin-1"): i for i, raw in enumerate(self.bytes)
                         if len(raw) == 1 or i in self.parts and self._whole(i)}
        self.matches = ahocorasick.Automaton()
        for letters_, i in self.token_of.items():
            self.matches.add_word(letters_, i)
        self.matches.make_automaton()
        self.size_of = [len(raw) for raw in self.bytes]
        self.shorter = [-1] * size  # the next shorter token that begins alike
        for letters_, i in self.token_of.items():
            for n in range(len(letters_) - 1, 0, -1):
                if letters_[:n] in self.token_of:
                    self.shorter[i] = self.token_of[letters_[:n]]
                    break
        self.pieces = regex.compile(PIECES)
        self.latin_pieces, self.other_letters = re.compile(LATIN_PIECES), re.compile(r"[^\t\n\r -~À-ɏ]")
        self.split = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.known = Memo(self._encode_piece, 500_000)
        self.blob, self.offsets = offset_table(self.bytes)
        self.decimal, self.decimal_offsets = offset_table([b"%d," % i for i in range(size)])

    def _spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens at one edge of a token's merge tree, each with the rank at which it is merged away."""
        out, gone = [(token, float("inf"))], float("inf")
        while token in self.parts:
            gone, token = self.made[token], self.parts[token][side]
            out.append((token, gone))
        return out

    def _crossing(self, left: int, right: int) -> float:
        """The least rank of a merge over the seam of two tokens that comes before its ends are merged away."""
        never = least = float("inf")
        ends, rank = self.spines[0][right], self.rank.get
        for x, x_gone in self.spines[1][left]:
            x <<= 32
            for y, y_gone in ends:
                r = rank(x | y, never)
                if r < x_gone and r <= y_gone and r < least:  # of two equal merges the one further left comes first
                    least = r
        return least

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self._crossing(*pair) == float("inf")

    def _whole(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        return self._crossing(*self.parts[token]) == self.made[token]

    def longest_matches(self, letters: str) -> array:
        """The longest token that begins at each place, by one scan; every single byte is a token."""
        found, size = array("i", bytes(4 * len(letters))), self.size_of
        for end, token in self.matches.iter(letters):
            found[end + 1 - size[token]] = token  # of matches that begin alike the longest ends last
        return found

    def encode_bytes(self, raw: bytes) -> list[int]:
        """Ids of one piece."""
        if not raw:
            return []
        longest, size, shorter, compatible = self.longest_matches(raw.decode("latin-1")), self.size_of, self.shorter, self.compatible
        blocked, tokens, at, token = set(), [], 0, longest[0]
        while True:
            after = at + size[token]
            if after not in blocked and (not tokens or compatible[tokens[-1], token]):
                tokens.append(token)
                at = after
                if at == len(raw):
                    return tokens
                token = longest[at]
                continue
            token = shorter[token]
            while token < 0:  # no way on from here
                blocked.add(at)
                token = tokens.pop()
                at -= size[token]
                token = shorter[token]

    def _encode_piece(self, piece: str) -> bytes:
        return np.array(self.encode_bytes(piece.encode("utf-8")), self.dtype).tobytes()

    def _plain(self, text: str) -> bytes:
        pieces = (self.pieces if self.other_letters.search(text) else self.latin_pieces).findall(text)
        keep = self.known
        return b"".join([keep[p] if len(p) < _LONGEST_KEPT else self._encode_piece(p) for p in pieces])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; special tokens' strings in it stand for themselves."""
        self.known.room()
        self.compatible.room()
        text = text or ""
        if self.split is None or not self.split.search(text):
            return np.frombuffer(self._plain(text), self.dtype)
        parts = [np.array([self.special[p]], self.dtype).tobytes() if p in self.special else self._plain(p)
                 for p in self.split.split(text)]
        return np.frombuffer(b"".join(parts), self.dtype)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 bytes of a sequence of ids; bytes that are no UTF-8 come out as the replacement character."""
        raw = gather(self.blob, self.offsets, ids)
        return raw.decode("utf-8", "replace").encode("utf-8")

    def listed(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return gather(self.decimal, self.decimal_offsets, ids)[:-1]


_LOADED: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    """The tokenizer of ``path``, loaded once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteBPE(path)
    return _LOADED[path]


def _encoding(path: str):
    def make():
        bpe = byte_bpe(path)
        return lambda cols: {"doc_id": cols["doc_id"], "ids": [bpe.encode(t).astype(np.int32) for t in cols["text"]]}
    return make


def _decoding(path: str):
    def make():
        bpe = byte_bpe(path)
        return lambda cols: {"doc_id": cols["doc_id"],
                             "text": [None if i is None else bpe.decode(np.array(i, np.int64)).decode("utf-8") for i in cols["ids"]]}
    return make


def _checking(path: str):
    def make():
        bpe = byte_bpe(path)

        def step(cols):
            ids = [bpe.encode(t) for t in cols["text"]]
            return {"doc_id": cols["doc_id"], "n_tokens": [len(i) for i in ids],
                    "ids_sha256": [sha256(bpe.listed(i)).hexdigest() for i in ids],
                    "decoded_sha256": [sha256(bpe.decode(i)).hexdigest() for i in ids]}
        return step
    return make


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text; other columns are not read).

    A null or empty text has no ids; null ids and repeated rows are encoded like any
    other; an empty table gives an empty result.
    """
    return map_slices(docs.select("doc_id", "text"), _encoding(path), "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of every row of ``coded`` (doc_id, ids); null ids give a null text, no ids an empty one."""
    return map_slices(coded.select("doc_id", "ids"), _decoding(path), "doc_id long, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every row in one pass: doc_id, n_tokens, ids_sha256 (decimal ids joined by
    commas), decoded_sha256 (the decoded text in UTF-8).  Rows are treated as in ``encode``."""
    return map_slices(docs.select("doc_id", "text"), _checking(path),
                      "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
