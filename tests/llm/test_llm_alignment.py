"""Alignment against plain loops over tokens and their byte ranges."""

from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF001
from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY_A = Tokenizer.from_file(A)
LIBRARY_A.encode_special_tokens = True
LIBRARY_B = sentencepiece.SentencePieceProcessor(model_file=B)


def byte_letters():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


LETTERS = byte_letters()


def bytes_b(i):
    piece = LIBRARY_B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if LIBRARY_B.is_byte(i) else piece.replace("▁", " ").encode()


def ranges(pieces):
    out, at = [], 0
    for i, raw in pieces:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out, b"".join(raw for _, raw in pieces)


def links_groups(text):
    if not text:
        return [], [], [], []
    a, raw_a = ranges([(i, bytes(LETTERS[c] for c in LIBRARY_A.id_to_token(i))) for i in LIBRARY_A.encode(" " + text, add_special_tokens=False).ids])
    b, raw_b = ranges([(i, bytes_b(i)) for i in LIBRARY_B.encode(text)])
    if raw_a != (" " + text).encode() or raw_b != raw_a:
        return [], [], [], []
    links = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e] if len(a) < 400 else []
    if not links:  # long texts by walking both
        i = j = 0
        while i < len(a) and j < len(b):
            links.append((a[i][0], b[j][0]))
            end_a, end_b = a[i][2], b[j][2]
            i, j = i + (end_a <= end_b), j + (end_b <= end_a)
    both = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, start = [], 0
    for end in both:
        groups.append(([x for x, s, e in a if start <= s and e <= end], [y for y, s, e in b if start <= s and e <= end]) if len(a) < 4000 else None)
        start = end
    return a, b, links, groups


def plain(docs):
    coded = [(i, *links_groups(t)) for i, t in docs]
    counts = Counter(link for *_, links, _ in coded for link in links)
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for i, a, b, links, groups in coded:
        said = None if None in groups else ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    None if said is None else sha256(said.encode()).hexdigest() if said else ""))
    return out, {(x, y, n, n == most[y]) for (x, y), n in counts.items()}


@pytest.mark.parametrize("block_links,parts", [(1, 1), (40, 3), (1_000_000, 1)])
def test_awkward_rows(spark, documents, awkward, monkeypatch, block_links, parts):
    docs = awkward + [(20, "plain ▁ sign"), (21, "<s> </s> <unk> <0x41> <|endoftext|>"), (22, "nul \x00 and ​﻿"), (23, "  two  spaces  "),
                      (24, "\n\n\t x\r\ny"), (25, " "), (26, "ｆｕｌｌ ﬁ Å é"), (27, "🙂🙂 क्षि ال"), (28, "aaaa aaa aa a" * 9)]
    table = documents(docs).withColumnRenamed("lang", "block").withColumnRenamed("source", "a").repartition(parts)
    rows, pairs = alignment.align(table, A, B, block_links)
    want, want_pairs = plain(docs)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted(map(tuple, rows.collect()), key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])
    assert {tuple(r) for r in pairs.collect()} == want_pairs
    assert alignment.align(documents([]), A, B)[0].collect() == []
    assert sum(r[1] == 0 for r in got) == 4  # null, empty, and a sign that B changes


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in docs][:120]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    want, want_pairs = plain(docs)
    rows, pairs = alignment.align(frame, A, B, 500)
    assert sorted(map(tuple, rows.collect())) == sorted(want)
    assert {tuple(r) for r in pairs.collect()} == want_pairs


def test_one_to_one_map():
    """Ids with the same bytes, and most links of running text go through the map."""
    both = alignment.aligner(A, B)
    mapped = [(i, j) for i, j in enumerate(both.same.tolist()) if j >= 0]
    assert all(both.a.bytes[i] == bytes_b(j) and not LIBRARY_B.is_byte(j) for i, j in mapped) and len(mapped) > 10_000
    found = both.align(["The quick brown fox jumps over the lazy dog and the river."])
    assert found["one"].mean() > 0.5
