"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped candidates.

Documents are sets of distinct five-word shingles.  Equal sets are one class, held
by the smallest doc_id, so copies never meet in a bucket.  One hash per shingle is
cut into ``BANDS * ROWS`` bins (one permutation); an empty bin borrows from the bin
that a fixed probe sequence names first among those filled (optimal densification),
the same for every document.  ``ROWS`` bins make a band, a band's hash a bucket.

Candidates are stars: in each bucket a hub is compared with the members of other
components, and then leaves the bucket.  Links are confirmed on the full sets.
Rounds go on until no bucket holds members of two components, so no link between
members of one bucket is lost, and there is no cap on buckets or partners.  The
first rounds take hubs from a bucket's largest component: what belongs to a family
of similar documents soon joins it, at a few pairs per member.  Later rounds take
the few that are left as hubs, more of them each round.  A pair goes on to the full
sets only if 1024-bit sketches allow the similarity: each bit that one document has
and the other lacks is a shingle not shared, so this loses nothing.  A family of
similar documents so costs pairs in proportion to its size, not its square.

A bucket of any size is dealt in parts of about ``SHARE`` members: the part is a hash of the
id, and what is known of the whole bucket (its hubs, whether it is mixed) is copied to each
part, so copies stay below one for each ``SHARE`` members.  Hubs are found by aggregating
twice, per component and then per bucket, before anything is sent by the bucket alone.

Probability that two documents at similarity 0.75 share none of the 64 buckets of
six bins: (1 - 0.75 ** 6) ** 64, below 4 in a million.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidepool.llm.common import Memo, map_slices, mix64
from tidepool.llm.components import components
from tidepool.session import files_for, materialize

WORDS, SIMILARITY = 5, 75  # words of a shingle; least similarity in hundredths
BANDS, ROWS = 64, 6
PROBES = 1024
FROM_LARGEST = (1, 8)  # hubs of a bucket in the first rounds; afterwards 1024, 1024 squared and so on
WIDTH = 16  # 64-bit words of a sketch
FILE_ROWS, TEXT_ROWS = 65536, 8192  # rows of a file: of members of buckets and narrower tables, of texts and their shingles
SHARE = 1024  # members of a bucket that are dealt to one task; a larger bucket is dealt in parts, its hubs copied to each

_MUL = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, seen: Memo, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles (empty for no words)."""
    found = (text or "").encode("utf-8").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    seen.room()
    h = np.fromiter(map(seen.__getitem__, found), dtype=np.uint64, count=len(found))
    if len(h) < words:
        out = np.full(1, len(h), np.uint64)
        for i in range(len(h)):
            out = mix64(out * _MUL + h[i:i + 1])
        return out
    n = len(h) - words + 1
    out = np.full(n, words, np.uint64)
    for i in range(words):
        out = mix64(out * _MUL + h[i:i + n])
    return np.unique(out)


class Signature:
    """One-permutation MinHash with optimal densification, folded into band keys."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        edges = [(i << 64) // self.bins for i in range(self.bins)]
        self.edges = np.array(edges, dtype=np.uint64)
        at = np.arange(self.bins, dtype=np.uint64)[:, None] * np.uint64(PROBES) + np.arange(PROBES, dtype=np.uint64)[None, :]
        self.probes = (mix64(at * _MUL + np.uint64(1)) % np.uint64(self.bins)).astype(np.int32)
        self.salt = mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def bin_values(self, hashes: np.ndarray) -> np.ndarray:
        """The least hash of each bin, empty bins filled."""
        starts = np.searchsorted(hashes, self.edges)
        ends = np.append(starts[1:], len(hashes))
        full = ends > starts
        values = np.zeros(self.bins, np.uint64)
        values[full] = hashes[starts[full]]
        empty = np.flatnonzero(~full)
        width, done = 16, 0
        while len(empty) and done < PROBES:
            hits = full[self.probes[empty, done:width]]
            some = hits.any(axis=1)
            source = self.probes[empty[some], done + hits[some].argmax(axis=1)]
            values[empty[some]] = values[source]
            empty, done, width = empty[~some], width, min(PROBES, width * 8)
        if len(empty):  # no probe met a filled bin: the next filled bin, in a circle
            filled = np.flatnonzero(full)
            values[empty] = values[filled[np.searchsorted(filled, empty) % len(filled)]]
        return values

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        grid = self.bin_values(hashes).reshape(self.bands, self.rows)
        out = self.salt.copy()
        for j in range(self.rows):
            out = mix64(out * _MUL + mix64(grid[:, j]))
        return out.view(np.int64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of the hashes, as ``WIDTH`` words."""
    bits = np.zeros(WIDTH * 64, np.uint8)
    bits[hashes % np.uint64(WIDTH * 64)] = 1
    return np.packbits(bits).view(np.int64)


def _signing(bands: int, rows: int, words: int):
    def make():
        seen, sign = Memo(xxhash.xxh3_64_intdigest), Signature(bands, rows)

        def step(cols):
            out = {"doc_id": cols["doc_id"], "text_hash": cols["text_hash"], "n_shingles": [], "set_hash": [], "bands": [], "sketch": []}
            for text in cols["text"]:
                sh = shingles(text, seen, words)
                out["n_shingles"].append(len(sh))
                out["set_hash"].append(blake2b(sh.tobytes(), digest_size=16).digest() if len(sh) else None)
                out["bands"].append(sign.keys(sh) if len(sh) else None)
                out["sketch"].append(sketch(sh))
            return out
        return step
    return make


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_hash, bands, sketch) of every row."""
    return map_slices(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), _signing(bands, rows, words),
                      "doc_id long, text_hash long, n_shingles long, set_hash binary, bands array<long>, sketch array<long>")


def _shingling(words: int):
    def make():
        seen = Memo(xxhash.xxh3_64_intdigest)
        return lambda cols: {"id": cols["doc_id"], "shingles": [shingles(t, seen, words).tobytes() for t in cols["text"]]}
    return make


def _confirming(similarity: int):
    def make():
        def step(cols):
            out = []
            for x, y in zip(cols["sa"], cols["sb"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
                out.append(100 * both >= similarity * (len(x) + len(y) - both))
            return {"a": cols["a"], "b": cols["b"], "linked": out}
        return step
    return make


def confirm(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """(a, b, linked) of pairs (a, b), by the full sets (id, shingles)."""
    joined = (pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
              .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a"))
    return map_slices(joined.select("a", "b", "sa", "sb"), _confirming(similarity), "a long, b long, linked boolean", rows=128)


def only(words: list[str], here: str, there: str) -> Column:
    """Bits of one sketch that the other lacks."""
    return F.expr(" + ".join(f"bit_count({here}{w} & ~{there}{w})" for w in words))


def to_parts(buckets: DataFrame) -> DataFrame:
    """Rows per bucket (key, parts, ...) copied to each of its parts."""
    return buckets.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")


def near_links(docs: DataFrame, signed: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS,
               similarity: int = SIMILARITY, share: int = SHARE) -> DataFrame:
    """(node, component) over class representatives that are linked with another one; ``share``: see ``SHARE``."""
    classes = signed.where("set_hash is not null and doc_id is not null").groupBy("set_hash").agg(F.min("doc_id").alias("doc_id"))
    heads = signed.join(classes, ["set_hash", "doc_id"], "left_semi")
    rows_ = heads.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    parts = F.ceil(F.count("*") / share).cast("int").alias("parts")
    shared = (rows_.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), parts)
              .where("low <> high").select("key", "parts"))
    spark, dealt = docs.sparkSession, signed.count()
    members = materialize(rows_.join(shared, "key").repartition("key", "id").distinct(), "buckets", files_for(spark, dealt, TEXT_ROWS))
    files, texts = files_for(spark, members.count(), FILE_ROWS), files_for(spark, dealt, TEXT_ROWS)
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    sets = materialize(map_slices(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), _shingling(words),
                                  "id long, shingles binary"), "shingles", texts)
    sketch = [F.col("sketch")[i].alias(f"s{i}") for i in range(WIDTH)]
    members = materialize(members.join(heads.select(F.col("doc_id").alias("id"), *sketch).dropDuplicates(["id"]), "id")
                          .withColumn("component", F.col("id")), "buckets", files)
    nothing = spark.range(0)  # not from Python rows, which would start a second Python daemon on every executor
    failed, found, turn = None, nothing.select(F.col("id").alias("node"), F.col("id").alias("component")), 0
    words = [f"s{i}" for i in range(WIDTH)]
    common = F.least(F.col("n") - only(words, "", "hub_"), F.col("hub_n") - only(words, "hub_", ""))
    possible = (100 + similarity) * common >= similarity * (F.col("n") + F.col("hub_n"))
    part = F.pmod(F.xxhash64("id", F.lit(-1)), F.col("parts")).cast("int")
    while not members.isEmpty():
        largest = turn < len(FROM_LARGEST)
        slots = FROM_LARGEST[turn] if largest else 1024 ** (turn - len(FROM_LARGEST) + 1)
        slot = F.pmod(F.xxhash64("id"), F.lit(slots)).alias("slot")
        best = F.max(F.struct(F.xxhash64("id", F.lit(turn)), "id", "component", "n", *words)).alias("best")
        if turn:  # the best member of each component, then that of the component that comes first
            own = members.groupBy("key", "parts", "component", slot).agg(best, F.count("*").alias("held"))
            many = F.sum("held").over(W.partitionBy("key", "component"))
            ranked = own.withColumn("many", many if largest else -many).groupBy("key", "parts", "slot").agg(
                F.max(F.struct("many", "best"))["best"].alias("best"))
        else:  # nothing is linked yet
            ranked = members.groupBy("key", "parts", slot).agg(best)
        hubs = materialize(ranked.select("key", "parts", F.col("best.id").alias("hub"), F.col("best.component").alias("hub_component"),
                                         F.col("best.n").alias("hub_n"), *[F.col(f"best.{w}").alias(f"hub_{w}") for w in words]), "hubs", files)
        pairs = (members.withColumn("part", part).join(to_parts(hubs), ["key", "part"])
                 .where((F.col("component") != F.col("hub_component")) & possible)
                 .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct())
        if failed is not None:
            pairs = pairs.join(failed, ["a", "b"], "left_anti")
        tested = materialize(confirm(pairs, sets, similarity), "pairs", max(files, texts))
        fresh, missed = tested.where("linked").select("a", "b"), tested.where("not linked").select("a", "b")
        failed = missed if failed is None else failed.union(missed)
        if not fresh.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(fresh), "a", "b", files)
        members = (members.drop("component").join(hubs.select("key", F.col("hub").alias("id")), ["key", "id"], "left_anti")
                   .join(found.select(F.col("node").alias("id"), "component"), "id", "left")
                   .withColumn("component", F.coalesce("component", "id")))
        mixed = (members.groupBy("key", "parts").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .where("low <> high").select("key", "parts"))
        members = materialize(members.withColumn("part", part).join(to_parts(mixed), ["key", "part"], "left_semi").drop("part"), "buckets", files)
        turn += 1
    return found


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS,
                    similarity: int = SIMILARITY, share: int = SHARE) -> DataFrame:
    """Near-duplicate groups of ``docs`` (doc_id, text; other columns are not read).

    Returns one row per input row: doc_id, n_shingles (size of the set), component_id
    (smallest doc_id reachable by links, itself included), kept (doc_id = component_id)
    and text_hash.  Empty, blank and null texts have no shingles and link with nothing.
    A doc_id found on several rows is one document carrying all their texts.  A null
    doc_id cannot be linked: its component_id is null and it is kept.  An empty table
    gives an empty result.
    """
    return _grouped(docs, materialize(signatures(docs, bands, rows, words), "signatures"), bands, rows, words, similarity, share)


def _grouped(docs: DataFrame, signed: DataFrame, bands: int = BANDS, rows: int = ROWS, words: int = WORDS,
             similarity: int = SIMILARITY, share: int = SHARE) -> DataFrame:
    """``near_duplicates`` of documents whose signatures are written."""
    files = files_for(docs.sparkSession, signed.count(), FILE_ROWS)
    found = near_links(docs, signed, bands, rows, words, similarity, share)
    whole = signed.where("set_hash is not null and doc_id is not null")
    classes = whole.groupBy("set_hash").agg(F.min("doc_id").alias("node"))
    # a doc_id with several texts ties their classes together, as copies do
    several = whole.groupBy("doc_id").agg(F.min("set_hash").alias("x"), F.max("set_hash").alias("y")).where("x <> y")
    ties = materialize(whole.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, "set_hash")
                       .select("node", F.col("doc_id").alias("component")), "ties", files)
    if not ties.isEmpty():
        found = components(found.union(ties), "node", "component", files)
    # written, so that a class of very many copies can be split in the join below
    by_class = materialize(classes.join(found, "node", "left")
                           .select("set_hash", F.coalesce("component", "node").alias("class_component")), "classes", files)
    return (signed.join(by_class, "set_hash", "left")
            .select("doc_id", "n_shingles", F.coalesce("class_component", "doc_id").alias("component_id"), "text_hash")
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
            .select("doc_id", "n_shingles", "component_id", "kept", "text_hash"))


def kept_rows(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document ``near_duplicates`` keeps, with all their columns: one document of each
    group.  Rows that repeat a doc_id with the same text stay or go together."""
    signed = materialize(signatures(docs), "signatures")
    kept = _grouped(docs, signed).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = docs["doc_id"].eqNullSafe(kept["_id"]) & (F.xxhash64(docs["text"]) == kept["_hash"])
    return docs.join(kept, same, "left_semi").coalesce(files_for(docs.sparkSession, signed.count(), TEXT_ROWS))
