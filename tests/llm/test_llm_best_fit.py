"""Best-fit packing: the bin that fits best by brute force, whole documents, gapless sequences, few of them."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF01
from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import best_fit, rank_bpe

BYTES = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTES)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=80), st.integers(1, 6))
def test_open_bins_by_brute_force(sizes, limit):
    bins, plain, closed, want = best_fit.OpenBins(20, limit), [], [], []
    for i, size in enumerate(sizes):
        closed += [[p for _, p in held] for held in bins.put(size, i)]
        fits = [b for b in plain if b[0] >= size]
        chosen = min(b[0] for b in fits) if fits else None
        # of bins with equal room the one that came to it last is taken
        held = next(b for b in reversed(plain) if b[0] == chosen) if fits else [20, []]
        plain = [b for b in plain if b is not held]
        held = [held[0] - size, [*held[1], i]]
        if held[0] == 0:
            want.append(held[1])
            continue
        plain.append(held)
        if len(plain) > limit:
            fullest = next(b for b in reversed(plain) if b[0] == min(b[0] for b in plain))
            plain = [b for b in plain if b is not fullest]
            want.append(fullest[1])
    assert closed == want and len(bins.rest()) == len(plain) <= limit
    assert sorted([p for _, p in held] for held in bins.rest()) == sorted(b[1] for b in plain)


def test_cut():
    assert best_fit.cut(5, 10) == [(0, 5)] and best_fit.cut(20, 10) == [(0, 10), (10, 10)]
    assert best_fit.cut(23, 10) == [(0, 3), (3, 10), (13, 10)]


def check(got, want, length, end_id=2):
    """Every document once, in pieces that follow one another; sequences without gaps."""
    by_sequence, documents = {}, {}
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= length and r.doc_tokens >= r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        documents.setdefault((r.doc_id, r.doc_tokens, r.piece), []).append((r.start, tuple(ids.tolist())))
    for places in by_sequence.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    expected = {}
    for doc, ids in want:
        ids = [*ids, end_id]
        for k, (start, size) in enumerate(best_fit.cut(len(ids), length)):
            expected.setdefault((doc, len(ids), k), []).append((start, tuple(ids[start:start + size])))
    assert {k: sorted(v) for k, v in documents.items()} == {k: sorted(v) for k, v in expected.items()}
    return len(by_sequence)


@pytest.mark.parametrize("open_bins", [1, 3, 512])
def test_awkward_rows(spark, documents, awkward, open_bins):
    docs = documents(awkward).withColumnRenamed("lang", "row").withColumnRenamed("source", "piece").repartition(3)
    want = [(i, LIBRARY.encode(t or "", add_special_tokens=False).ids) for i, t in awkward]
    check(best_fit.pack(docs, BYTES, open_bins=open_bins).collect(), want, 1024)
    assert best_fit.pack(documents([]), BYTES).collect() == []


@pytest.mark.parametrize("tasks", [1, 16])
def test_few_sequences(spark, tasks):
    """Within two in a hundred of the least number that any packing needs, from one task or from many."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = [(r.doc_id, LIBRARY.encode(r.text or "", add_special_tokens=False).ids) for r in docs.select("doc_id", "text").collect()]
    n = check(best_fit.pack(docs.repartition(tasks), BYTES, open_bins=32).collect(), want, 1024)
    assert n <= 1.02 * math.ceil(sum(len(ids) + 1 for _, ids in want) / 1024) + 2


def test_same_again(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(200)
    first, second = ([tuple(r) for r in best_fit.pack(docs, BYTES, open_bins=4).collect()] for _ in range(2))
    assert sorted(first) == sorted(second)


def test_ids_equal_the_library():
    """Random tokens in a row, and long runs, as the library encodes them."""
    ours = rank_bpe.rank_encoder(BYTES, True)
    rng = random.Random(1)
    for _ in range(3000):
        text = b"".join(ours.bytes[rng.randrange(50257)] for _ in range(rng.randint(1, 6))).decode("utf-8", "ignore")
        assert ours.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    plain = rank_bpe.rank_encoder(BYTES, False)
    assert 50256 not in plain.encode("a<|endoftext|>b") and 50256 in ours.encode("a<|endoftext|>b")
    for text in ("a" * 30000, "\n" * 9000, " " * 9000 + "x", "é" * 9000):
        assert ours.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    blanks = ours.encode(" " * 1_500_000 + "x")  # beyond the splitter's stack: encoded by the slow way
    assert len(blanks) == 1_500_000 and blanks[-1] == LIBRARY.encode(" x", add_special_tokens=False).ids[-1]
