"""MinHash and embedding near-duplicates against all-pairs brute force."""

import random
import re

import numpy as np
import pytest

from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import components, embedding, minhash
from tidepool.llm.common import Memo


def word_sets(pairs):
    out = {}
    for i, text in pairs:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x20\x09-\x0D]+", low)
        out.setdefault(i, []).append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    return out


def groups(nodes, linked):
    """Smallest node reachable from each, by repeated relaxation."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def brute(pairs):
    sets = word_sets(pairs)
    ids = sorted(i for i in sets if i is not None)
    linked = [(a, b) for a in ids for b in ids if a < b
              if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b])]
    return groups(ids, linked)


def family(seed, size, words=60, changes=3):
    """A base text and copies with a few words replaced; some copies of copies."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = [list(base)]
    for _ in range(size):
        copy = list(rng.choice(out))
        for _ in range(rng.randrange(changes + 1)):
            copy[rng.randrange(words)] = f"n{rng.randrange(10 ** 6)}"
        out.append(copy)
    return [" ".join(c) for c in out]


def test_minhash_equals_all_pairs(spark, documents):
    texts = [t for seed in range(4) for t in family(seed, 25)] + ["UPPER case Words here now", "upper CASE words here NOW", "short one"]
    pairs = list(enumerate(texts))
    want = brute(pairs)
    got = minhash.near_duplicates(documents(pairs)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {i: len(s[0]) for i, s in word_sets(pairs).items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("share", [1, 7])
def test_minhash_of_buckets_in_parts(spark, documents, share):
    """Buckets dealt in parts of a few members: a large family, one whose members only resemble each other, and copies."""
    alike = [" ".join(f"c{i}" for i in range(40)) + " " + " ".join(f"x{k}y{i}" for i in range(6, 22)) for k in range(30)]
    texts = family(9, 60) + alike + alike[:3] * 2
    pairs = [(5 * i % 997, t) for i, t in enumerate(texts)]
    got = minhash.near_duplicates(documents(pairs), share=share).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(pairs)


def test_minhash_awkward_rows(spark, documents, awkward):
    docs = documents(awkward).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "bands")  # clashing names
    got = minhash.near_duplicates(docs).collect()
    assert len(got) == len(awkward)
    want = brute(awkward)
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert all(r.component_id in (None, 1) and r.kept for r in got if r.doc_id is None and r.n_shingles == 0)
    assert {r.n_shingles for r in got if r.doc_id in (2, 3, 4)} == {0}
    kept = minhash.kept_rows(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(r.doc_id for r in got if r.kept and r.doc_id is not None)


def test_minhash_empty_table(documents):
    assert minhash.near_duplicates(documents([])).collect() == []


def test_densified_bins_estimate_similarity():
    sign, seen = minhash.Signature(), Memo(lambda w: hash(w) & (2 ** 64 - 1))
    a = np.unique(np.random.default_rng(1).integers(0, 2 ** 63, 400, dtype=np.uint64))
    b = np.concatenate((a[:300], np.random.default_rng(2).integers(0, 2 ** 63, 100, dtype=np.uint64)))
    b.sort()
    same = (sign.bin_values(a) == sign.bin_values(b)).mean()
    assert same == pytest.approx(300 / 500, abs=0.12)
    one = sign.bin_values(a[:1])
    assert (one == a[0]).all() and seen == {}


def test_components(spark, monkeypatch):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(80)] + [(7, 7)]
    want = groups({n for e in edges for n in e}, edges)
    df = spark.createDataFrame(edges, "a long, b long")
    for block in (10 ** 6, 60):  # one block, and several with passes between them
        monkeypatch.setattr(components, "BLOCK", block)
        got = {r.node: r.component for r in components.components(df, "a", "b").collect()}
        assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert components.components(df.limit(0), "a", "b").collect() == []


VECTORS = "vec_id long, label int, embedding array<float>, unit string"


def test_embedding_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((12, 16))
    rows = [(i, int(rng.integers(0, 3)), [float(np.float32(x)) for x in base[i % 12] + rng.standard_normal(16) * 0.22], "clash") for i in range(240)]
    rows += [(500 + i, 1, rows[0][2], "copy") for i in range(30)]
    want, count = {}, {}
    unit = {r[0]: np.array(r[2]) / np.linalg.norm(r[2]) for r in rows}
    label = {r[0]: r[1] for r in rows}
    linked = [(a, b) for a in unit for b in unit if a < b and label[a] == label[b] and unit[a] @ unit[b] >= 0.93]
    want = groups(unit, linked)
    for a, b in linked:
        count[a], count[b] = count.get(a, 0) + 1, count.get(b, 0) + 1
    df = spark.createDataFrame(rows, VECTORS)
    for block in (1024, 7):  # whole buckets, and buckets cut into blocks
        got = embedding.near_duplicates(df, block=block).collect()
        assert {r.vec_id: r.component_id for r in got} == want
        assert {r.vec_id: r.n_links for r in got} == {i: count.get(i, 0) for i in unit}


def test_embedding_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 0, [1.0, 0.0], ""), (2, 0, [2.0, 0.0], ""), (3, 1, [1.0, 0.0], ""), (4, None, [1.0, 0.0], ""), (5, 0, None, ""), (6, 0, [], ""),
            (7, 0, [0.0, 0.0], ""), (8, 0, [nan, 1.0], ""), (9, 0, [inf, 1.0], ""), (10, 0, [None, 1.0], ""), (None, 0, [1.0, 0.0], ""),
            (11, 0, [1.0, 0.0, 0.0], ""), (12, 0, [1e-30, 0.0], ""), (13, 0, [3e38, 0.0], "")]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()}
    assert {i: got[i] for i in (1, 2, 12, 13)} == {1: (3, 1, True), 2: (3, 1, False), 12: (3, 1, False), 13: (3, 1, False)}
    assert all(got[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11))
    assert got[None] == (0, None, True)
    assert embedding.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
