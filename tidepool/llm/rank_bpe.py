"""Ids of whole texts or of their words from a byte-level BPE file, by merging byte pairs in order of rank (the tiktoken library)."""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import tiktoken

from tidepool.llm.bpe import byte_bpe, byte_letters


class RankEncoder:
    """Encoder of one tokenizer file (JSON, byte-level BPE without normaliser): its merges become ranks.

    ``special`` says whether the strings of special tokens in a text stand for
    themselves, as in the tokenizers library, or are ordinary text.
    """

    def __init__(self, path: str, special: bool):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        raw = lambda word: bytes(letters[c] for c in word)
        words = [w for w in vocabulary if len(w) == 1]
        words += dict.fromkeys("".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"])
        ranks = {raw(w): r for r, w in enumerate(words)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of = np.array([vocabulary[w] for w in words] + list(added.values()), dtype=np.uint32)
        self.size = int(self.id_of.max()) + 1
        self.bytes = [b""] * self.size
        for word, i in vocabulary.items():
            self.bytes[i] = word.encode("utf-8") if word in added else raw(word)
        self.in_order = bool((self.id_of == np.arange(len(self.id_of))).all())
        self.path, self.allowed = path, set(added) if special else set()
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={s: len(words) + i for i, s in enumerate(added)})

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit numbers."""
        try:
            ranks = self.encoding.encode_to_numpy(text, allowed_special=self.allowed, disallowed_special=())
        except ValueError:  # the library's splitter has no room for a run of a million blanks
            slow = byte_bpe(self.path)
            return (slow.encode(text) if self.allowed else np.frombuffer(slow._plain(text), slow.dtype)).astype(np.uint32)
        return ranks if self.in_order else self.id_of[ranks]


class WordRanks:
    """Ids of words from one tokenizer file (JSON, byte-level BPE whose last symbol of a word has the suffix ``</w>``).

    The suffix becomes the byte 0 after each word.  Its merges with single bytes come
    first, as the library sets it before it merges; the file's merges follow.  A merge
    is told by the bytes it makes, which is right as each token is made by one merge of
    the file and merging its own bytes gives it (a test checks the file for both).
    """

    SUFFIX = "</w>"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocabulary = byte_letters(), spec["model"]["vocab"]
        words = [*letters, *(c + self.SUFFIX for c in letters)]
        words += ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ranks = {bytes(letters[c] for c in w.removesuffix(self.SUFFIX)) + b"\0" * w.endswith(self.SUFFIX): r for r, w in enumerate(words)}
        self.id_of = np.array([vocabulary[w] for w in words], dtype=np.uint32)
        # two bytes 0 never meet; without a special token the library would look for one at every character
        self.encoding = tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks=ranks, special_tokens={"\0\0": len(words)})

    def encode(self, words: list[str]) -> np.ndarray:
        """The words' ids, one after the other; no word is empty or holds the character 0."""
        if not words:
            return self.id_of[:0]
        return self.id_of[self.encoding.encode_to_numpy("\0".join(words) + "\0", disallowed_special=())]


_LOADED: dict[tuple, RankEncoder] = {}


def rank_encoder(path: str, special: bool) -> RankEncoder:
    """The encoder of ``path``, loaded once per Python worker."""
    if (path, special) not in _LOADED:
        _LOADED[path, special] = RankEncoder(path, special)
    return _LOADED[path, special]
