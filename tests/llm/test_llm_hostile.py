"""Rows that once stopped a query: long runs, letters whose case changes its range, record starts inside pages, settings in other spellings."""

import re
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm_rows import documents  # noqa: F401
from tidepool.llm import common, minhash, packing, pii, quotes, warc
from tidepool.session import checkpoint_root

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_long_lines_of_signs(spark):
    rows = [(1, 0, "hello there\nmore"), (1, 1, "> hello there\nyes"), (1, 2, ">" * 10_000_000), (1, 3, "> \t" * 200_000 + "hello there"),
            (1, 4, " " * 300_000 + "> more"), (2, 0, "no\n" + "\t" * 100_000)]
    df = spark.createDataFrame([(c, t, "r", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    by = {(r.conv_id, r.turn): r for r in quotes.link(df).select("conv_id", "turn", "parent_turn", "n_quoted", "max_depth", "n_linked").collect()}
    assert by[1, 2].max_depth == 10_000_000 and by[1, 2].n_quoted == 1 and by[1, 2].n_linked == 0
    assert by[1, 3].max_depth == 200_000 and by[1, 3].n_linked == 1 and by[1, 1].parent_turn == 0 and by[1, 4].parent_turn == 0
    assert by[2, 0].n_quoted == 0


@pytest.mark.parametrize("line", ["> a", ">> a", " > \t> a", "a > b", ">", "> >x>", "", "  ", "\t>\t", "\u00a0> a", ">\u00a0> a"])
def test_signs_and_text_by_pattern(spark, line):
    """The string functions against the pattern they stand for, run by another engine."""
    signs = re.match(r"[ \t]*>(?:[ \t]*>)*", line)
    row = spark.createDataFrame([(line,)], "line string").select(quotes._depth(F.col("line")).alias("d"), quotes._plain(F.col("line")).alias("p")).first()
    rest = line[signs.end():] if signs else line
    assert (row.d, row.p) == (signs.group().count(">") if signs else 0, re.sub(r"[ \t]+", " ", rest).strip(" ").lower())


def test_addresses_with_many_zeros():
    zeros = "0" * 100_000
    assert pii.base_spans(f"x {zeros}.1.2.3 y") == [(2, "ip", 100_008)]
    assert pii.base_spans(f"{zeros}7.{zeros}255.2.3")[0][1] == "ip"
    assert pii.base_spans(f"1.2.3.{zeros}256") == [] and pii.base_spans(f"1.2.3.{'9' * 5000}") == []


def test_every_letter_as_the_library_encodes_it():
    """Each code point of the basic plane at a word's start, inside it and between signs."""
    ours, library = packing.word_tokenizer(WORDS), Tokenizer.from_file(WORDS)
    texts = [t for c in range(0x10000) if not 0xD800 <= c < 0xE000 for t in (f"{chr(c)}ab c", f"a{chr(c)}b c", f"12{chr(c)}x!{chr(c)}")]
    for at in range(0, len(texts), 4096):
        some = texts[at:at + 4096]
        want = [e.ids for e in library.encode_batch_fast(some, add_special_tokens=False)]
        got = [list(memoryview(b).cast("H")) for b in ours.encode(some)]
        assert got == want, next(t for t, g, w in zip(some, got, want) if g != w)


def test_batch_setting_in_any_spelling(spark, documents):
    for value in ("32m", "67108864", "64MB", None):
        spark.conf.unset(common.BATCH_BYTES) if value is None else spark.conf.set(common.BATCH_BYTES, value)
        try:
            assert packing.pack(documents([(1, "a b c")]), WORDS).count() == 1
            assert spark.conf.get(common.BATCH_BYTES) == (value or "16777216b")  # a choice of the user's stays
        finally:
            spark.conf.unset(common.BATCH_BYTES)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_pages_that_hold_record_starts(spark, tmp_path, compression):
    start = "\r\n\r\nWARC/1.1\r\n"
    inner = f"<p>a{start}WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc{start}b"
    pages = [(1, "http://a.org/", f"<p>before{start}after"), (2, "http://b.org/", "plain"), (3, "http://c.org/", inner), (4, "http://d.org/", start * 3),
             (5, "http://e.org/", f"é{start}Content-Length: x\r\n\r\n"), (6, "http://f.org/", f"end{start}WARC/1.1\r\n")]
    made = warc.responses(spark.createDataFrame(pages, "page_id long, url string, html string"), "2024-01-01T00:00:00Z")
    both = made.unionByName(warc.derivatives(made))
    for parts in (1, 4):
        path = f"{tmp_path}/warc{parts}"
        warc.write(both.repartition(parts), path, compression)
        back = warc.read(spark, path)
        assert back.where("not whole").count() == 0
        assert sorted(map(str, back.drop("whole", "page_id").collect())) == sorted(map(str, both.drop("page_id").collect()))


def test_damaged_files_are_read(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "cut").write_bytes((good + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 900\r\n\r\nshort").encode())
    (tmp_path / "wrong").write_bytes(("WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n" + good).encode())
    (tmp_path / "none").write_bytes(b"WARC/1.1\r\nWARC-Type: response\r\n\r\nno length\r\n\r\n")
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sorted((r.whole, r.block) for r in rows if r.whole) == [(True, "ok"), (True, "ok")]
    assert len(rows) == 5


def test_pipeline_over_such_rows(spark, documents, tmp_path):
    """Every stage over all of them, whatever the stages before would keep, and the whole pipeline."""
    words = " ".join(f"word{i} text{i} more{i}" for i in range(60))
    texts = [words + "\n" + ">" * 100_000, words.replace("word", "term") + " " + "0" * 5000 + ".1.2.3", words.replace("word", "aƁb12Ɓx!Ɓ"),
             words.replace("word", "x") + "\r\n\r\nWARC/1.1\r\n", None, "", words]
    docs = documents(list(enumerate(texts)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, str(tmp_path))
        assert {r.doc_id for r in rows.collect()} <= set(range(7)) and (name in ("quality", "near_duplicates") or rows.count() >= 7)
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} <= set(range(7))


def _held(kind):
    """A step that counts the objects of a class that its Python worker holds."""
    def make():
        import gc

        return lambda cols: {"id": cols["id"], "held": [sum(type(x).__name__ == kind for x in gc.get_objects())] * len(cols["id"])}
    return make


def test_workers_let_go_of_the_tokenizers_of_other_steps(spark, documents):  # noqa: F811
    """an executor's Python workers serve all stages; what one has loaded goes when another step begins."""
    docs = documents([(i, f"some words of text {i}") for i in range(64)]).repartition(4)
    assert packing.pack(docs, WORDS).count() == 64
    rows = common.map_slices(spark.range(0, 64, 1, 4), _held("WordTokenizer"), "id long, held long").collect()
    assert len(rows) == 64 and {r.held for r in rows} == {0}


def test_a_model_stays_while_tasks_take_it():
    first = common.begin(lambda: common.model("a test", object))
    assert common.begin(lambda: common.model("a test", object)) is first
    common.begin(object)
    assert common.begin(lambda: common.model("a test", object)) is not first
    common.begin(object)


def test_links_need_no_rows_from_python(documents, monkeypatch):  # noqa: F811
    """rows made in the driver's Python start another Python daemon, with workers of its own, on every executor."""
    from pyspark.sql import SparkSession

    words = " ".join(f"word{i}" for i in range(60))
    docs = documents([(1, words), (2, words + " more"), (3, words + " less"), (4, "something else altogether, and not like it")])
    monkeypatch.setattr(SparkSession, "createDataFrame", None)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_scratch_tables_have_files_by_rows_not_by_shuffle_partitions(spark, documents, tmp_path):  # noqa: F811
    """for every file an executor starts a process that counts its whole memory once more until it runs."""
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) + (f" end{copy}" if copy else "") for i in range(60) for copy in range(3)]
    docs = documents(list(enumerate(texts)))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    root, cores = Path(checkpoint_root(spark).removeprefix("file:")), spark.sparkContext.defaultParallelism
    held = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, old = set(root.iterdir()), {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        groups = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs).collect()}
        minhash.kept_rows(docs).write.parquet(f"{tmp_path}/kept")
        packing.pack(docs, WORDS, 64).write.parquet(f"{tmp_path}/pieces")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert groups == {i: i - i % 3 for i in range(180)}
    pieces = sorted((r.sequence_id, r.offset, r.length) for r in spark.read.parquet(f"{tmp_path}/pieces").collect())
    at = 0
    for sequence, offset, length in pieces:
        assert sequence * 64 + offset == at
        at += length
    tables = [*(set(root.iterdir()) - before), tmp_path / "kept", tmp_path / "pieces"]
    assert {t.name.rsplit("-", 1)[0] for t in tables} >= {"buckets", "shingles", "hubs", "pairs", "edges", "classes", "curve"}
    assert {t.name: n for t in tables if (n := len(list(t.glob("part-*")))) > cores} == {}
