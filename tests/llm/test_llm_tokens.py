"""Packing and BPE against the tokenizers library, Hilbert numbers by their defining property."""

import json
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import bpe, packing, rank_bpe

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def test_hilbert_visits_every_cell_in_steps_of_one():
    for d, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = packing.hilbert(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_id_once(spark, documents, awkward):
    rows = documents(awkward).withColumnRenamed("lang", "row").withColumnRenamed("source", "key")
    got = packing.pack(rows, WORDS).collect()
    library = Tokenizer.from_file(WORDS)
    want = sorted(tuple(library.encode(t or "", add_special_tokens=False).ids + [1]) for _, t in awkward)
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    assert [r.sequence_id * packing.LENGTH + r.offset for r in got] == list(np.cumsum([0, *[r.length for r in got]])[:-1])
    whole, parts = [], []
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= packing.LENGTH and r.start == len(parts)
        parts += ids.tolist()
        if len(parts) == r.doc_tokens:
            whole.append(tuple(parts))
            parts = []
    assert sorted(whole) == want and not parts
    assert packing.pack(documents([]), WORDS).collect() == []


def test_neighbours_share_sequences(spark, documents):
    topics = [["alpha beta gamma delta", "red green blue yellow", "ship boat sail harbour"][i % 3] for i in range(90)]
    got = packing.pack(documents([(i, " ".join([t] * 40)) for i, t in enumerate(topics)]), WORDS).collect()
    order = [r.doc_id % 3 for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)) if r.start == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) == 2  # like texts lie together along the curve


LIBRARY = Tokenizer.from_file(BYTES)
letters = st.lists(st.sampled_from([*"abcdeth ing'sr.,=-0127\n\t", "  ", "é", "ß", "日本", "🙂", "\x1c", "\x85", "\xa0", "'ll", "<|endoftext|>"]), max_size=40).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.one_of(letters, st.text(max_size=30)))
def test_bpe_equals_the_library(text):
    ours = bpe.byte_bpe(BYTES)
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ours.encode(text).tolist() == ids
    assert ours.decode(np.array(ids, np.int64)).decode("utf-8") == LIBRARY.decode(ids, skip_special_tokens=False)


def test_bpe_long_runs():
    ours = bpe.byte_bpe(BYTES)
    for text in ("a" * 20000, "=" * 7001, "abc" * 5000, " " * 3000 + "x", "\n" * 2000, "1" * 4000):
        assert ours.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_one_scan_finds_the_longest_token_of_every_place():
    ours = bpe.byte_bpe(BYTES)
    for raw in ("the theatre's  1234 ====----~~ \u00e9\u4e2d\U0001f600".encode(), bytes(range(256)), b"-" * 200, b"a"):
        letters = raw.decode("latin-1")
        want = [max((ours.token_of[letters[i:j]] for j in range(i + 1, len(letters) + 1) if letters[i:j] in ours.token_of),
                    key=lambda t: ours.size_of[t]) for i in range(len(letters))]
        assert ours.longest_matches(letters).tolist() == want


def test_bpe_pairs_by_merging():
    """The pair table against merging by rank, for the tokens of some words and random pairs."""
    ours = bpe.byte_bpe(BYTES)
    rng = np.random.default_rng(0)
    for a, b in rng.integers(0, 50000, (400, 2)).tolist():
        try:
            text = (ours.bytes[a] + ours.bytes[b]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if len(ours.pieces.findall(text)) == 1:
            assert ours.compatible[a, b] == (LIBRARY.encode(text, add_special_tokens=False).ids == [a, b])


def test_bpe_rows(spark, documents, awkward):
    docs = documents(awkward).withColumnRenamed("lang", "ids")
    got = sorted(map(tuple, bpe.round_trip(docs, BYTES).collect()), key=str)
    want = []
    for i, t in awkward:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.decode(bpe.encode(docs, BYTES), BYTES)
    assert sorted((r.text for r in back.collect())) == sorted(t or "" for _, t in awkward)
    assert bpe.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), BYTES).collect()[0].text is None
    assert bpe.round_trip(documents([]), BYTES).collect() == []


def test_crc_matches_spark(spark, documents):
    from pyspark.sql import functions as F
    row = packing.pack(documents([(1, "some words")]), WORDS).select("ids", F.crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))


WORD_LIBRARY = Tokenizer.from_file(WORDS)
word_letters = st.lists(st.sampled_from([*"abcdethns'sr.,=-01279\n\t  XÉéß×÷ñ", "'ll", "don't", "''re", "!!", "\x1c", "日本", "’", "\0", "<|endoftext|>"]), max_size=40).map("".join)


def _ids(raw):
    return np.frombuffer(raw, "<u2").tolist()


def test_latin_texts_are_merged_by_rank_whatever_their_words():
    """once the library encoded each distinct piece, with all it knows of a token, and the pieces were kept."""
    ours = packing.WordTokenizer(WORDS)
    ours.tokenizer = None  # for other texts only
    rng = np.random.default_rng(5)
    texts = ["".join(chr(97 + c) if c < 26 else " " for c in rng.integers(0, 30, 3000)) for _ in range(20)]
    texts += ["", "Don't SHOUT!! it''s 1234,5 x", "ñandú ÉTÉ a×b", "x" * 20000, "=" * 7001, "ab" * 9000, "1" * 3000]
    want = [WORD_LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [_ids(b) for b in ours.encode(texts)] == want and not ours.known


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(word_letters, st.text(max_size=30)), min_size=1, max_size=4))
def test_words_equal_the_library(texts):
    got = packing.word_tokenizer(WORDS).encode(texts)
    assert [_ids(b) for b in got] == [WORD_LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_each_word_token_is_made_by_one_merge_and_by_its_own_bytes():
    """What merging by rank rests on, for the file."""
    with open(WORDS, encoding="utf-8") as f:
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in json.load(f)["model"]["merges"]]
    rank, never = {m: r for r, m in enumerate(merges)}, len(merges)
    assert len({a + b for a, b in merges}) == len(merges) == len(rank)
    for a, b in merges:
        word = a + b
        parts = [*word.removesuffix("</w>")]
        parts[-1] += "</w>" * word.endswith("</w>")
        while len(parts) > 1:
            r, at = min((rank.get(pair, never), i) for i, pair in enumerate(zip(parts, parts[1:])))
            assert r < never, word
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
    ours = rank_bpe.WordRanks(WORDS)
    assert sorted(ours.id_of.tolist()) == list(range(len(merges) + 512))
