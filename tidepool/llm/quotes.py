"""Quotation linking: quoted lines find the message that wrote them, and messages are ordered by reply.

A line that begins with ``>`` signs is quoted, at a depth of as many signs.  Its text,
lower-cased and with runs of blanks as one, is hashed and joined to the lines that
messages of the same conversation wrote themselves; the earliest message that wrote
a line is its origin, so the join has one partner per quoted line however often the
line is written.

Quoted lines that equal no whole line (wrapped anew by the mail program, or parts of
a line) are looked up as passages: consecutive lines of one depth are one row of
words, whatever white space and line ends are between them, and every window of
``WINDOW`` of its words, taken at every word, is joined to the windows of what
messages wrote themselves.  A line or passage of fewer words is one unit of its own,
joined to own windows of that length.  A word is from the origin of the longest unit
that holds it (the earliest of equal ones), and a line is linked if a word of it is.

A message answers the origin of most of its depth-one text (the later one of two
equal ones).  Threads are found by pointer doubling.

DataFrame functions only.  Lines are counted per key before they are joined; nothing
is collected per conversation, so a conversation of any size is only many rows.
Windows are made only in conversations with a quoted line that equals no whole line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.session import materialize

WINDOW = 5  # words of a unit of a passage
# Lines that mail programs put before a quotation, in four languages.
ATTRIBUTION = r"^[ \t]*(?:On .* wrote:|Am .* schrieb .*:|Le .* a écrit ?:|El .* escribió:)[ \t]*$"


def _signs(line: Column) -> Column:
    """The blanks and ``>`` signs that begin a line, up to the last sign.  One run of a class, cut by a string function:
    a repeated group would take the regular expression engine a stack frame for each sign."""
    return F.rtrim(F.regexp_extract(line, r"^[ \t>]*", 0), F.lit(" \t"))


def _depth(line: Column) -> Column:
    return F.length(F.translate(_signs(line), " \t", ""))


def _plain(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(F.substring(line, F.length(_signs(line)) + 1, F.length(line)), r"[ \t]+", " ")))


def _lines(messages: DataFrame) -> DataFrame:
    """One row per non-blank line: conv_id, turn, depth, passage (hash) and size (characters of the normalised text)."""
    line = messages.select("conv_id", "turn", F.explode(F.split("text", "\r?\n")).alias("line"))
    return (line.select("conv_id", "turn", _depth(F.col("line")).alias("depth"), _plain(F.col("line")).alias("plain"))
            .where("plain <> ''").select("conv_id", "turn", "depth", F.md5("plain").alias("passage"), F.length("plain").alias("size")))


def _worded(messages: DataFrame) -> DataFrame:
    """Messages with ``words``, one struct per word of their non-blank lines: word, depth, line (its number),
    passage (hash of the line), nth (place in the line, from 0) and of (words of the line)."""
    lines = F.filter(F.transform(F.split("text", "\r?\n"), lambda x: F.struct(_depth(x).alias("depth"), _plain(x).alias("plain"))),
                     lambda x: x.plain != "")
    split = F.transform(lines, lambda x: F.struct(x.depth.alias("depth"), F.md5(x.plain).alias("passage"),
                                                  F.filter(F.split(x.plain, r"\s+"), lambda w: w != "").alias("words")))
    worded = lambda x, i: F.transform(x.words, lambda w, n: F.struct(
        w.alias("word"), x.depth.alias("depth"), i.alias("line"), x.passage.alias("passage"), n.alias("nth"), F.size(x.words).alias("of")))
    return messages.withColumn("words", F.flatten(F.transform(split, worded))).drop("text")


def _unit(start: Column, size: int) -> Column:
    """(start, size, unit) of so many words from the one numbered ``start`` on: their hash, null if they are not of one depth."""
    words = [F.get("words", start + k) for k in range(size)]
    even = F.lit(True)
    for w in words:
        even = even & (w.depth == words[0].depth)
    return F.struct(start.alias("start"), F.lit(size).alias("size"), F.when(even, F.md5(F.concat_ws(" ", *[w.word for w in words]))).alias("unit"))


def _units(worded: DataFrame, wanted: Callable[[Column, Column, int], Column], sizes: Sequence[int], *columns: str) -> DataFrame:
    """One row (columns, start, size, unit) per unit of words of one depth; ``wanted(word, start, size)`` picks."""
    at_word = lambda x, i: F.array(*[F.when(wanted(x, i, n), _unit(i, n)) for n in sizes])
    return (worded.select(*columns, F.explode(F.flatten(F.transform("words", at_word))).alias("_u"))
            .where("_u.unit is not null").select(*columns, "_u.*"))


def _quoted_unit(word: Column, start: Column, size: int) -> Column:
    """Every window; of fewer words only a whole line and a whole passage."""
    if size == WINDOW:
        return word.depth > 0
    before, after = F.get("words", start - 1).depth, F.get("words", start + size).depth
    line = (word.nth == 0) & (word.of == size)
    passage = ((start == 0) | (before != word.depth)) & F.coalesce(after != word.depth, F.lit(True))
    return (word.depth > 0) & (line | passage)


def _windows(messages: DataFrame, unlinked: DataFrame) -> DataFrame:
    """Occurrences of unlinked quoted lines found by the words they share with earlier messages:
    conv_id, turn, depth, id and line (the occurrence), origin and weight (characters of words from it)."""
    here = messages.where("conv_id is not null and turn is not null")
    quoting = (here.join(unlinked.select("conv_id", "turn").distinct(), ["conv_id", "turn"], "left_semi")
               .withColumn("id", F.monotonically_increasing_id()))
    quoting = materialize(_worded(quoting), "quoting")
    units = materialize(_units(quoting, _quoted_unit, range(1, WINDOW + 1), "id", "conv_id", "turn"), "units")
    sizes = sorted(r["size"] for r in units.select("size").distinct().collect())  # at most WINDOW numbers
    own = _worded(here.join(unlinked.select("conv_id").distinct(), "conv_id", "left_semi"))
    wrote = (_units(own, lambda x, i, n: x.depth == 0, sizes, "conv_id", "turn")
             .groupBy("conv_id", "size", "unit").agg(F.min("turn").alias("origin")))
    hits = units.join(wrote, ["conv_id", "size", "unit"]).where("origin < turn")
    covered = (hits.select("id", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("at"), "size", "origin")
               .groupBy("id", "at").agg(F.max(F.struct("size", (-F.col("origin")).alias("early"))).alias("best")))
    words = (quoting.select("id", "conv_id", "turn", F.posexplode("words").alias("at", "w"))
             .select("id", "conv_id", "turn", "at", "w.line", "w.depth", "w.passage", F.length("w.word").alias("chars"))
             .join(unlinked.select("conv_id", "turn", "depth", "passage"), ["conv_id", "turn", "depth", "passage"], "left_semi"))
    return (words.join(covered, ["id", "at"]).groupBy("id", "conv_id", "turn", "line", "depth", (-F.col("best.early")).alias("origin"))
            .agg(F.sum(F.col("chars") + 1).alias("weight")))


def link(messages: DataFrame) -> DataFrame:
    """Messages with their place in the conversation, and without quotations.

    ``messages`` has conv_id, turn, role and text (other columns are not read).  Returns,
    for every input row, conv_id, turn, role, parent_turn (the message answered, or
    null), thread_root (the first message of its chain of answers), reply_depth (its
    place in the chain, from 0), n_quoted (quoted lines), max_depth (of quotation),
    n_linked (quoted lines of which an earlier message wrote the whole or a part) and body (the text without
    quoted lines and the lines that announce them).  Sorting by conv_id, thread_root,
    turn gives the conversations in reply order (see ``reply_ordered``).

    A null text has a null body and no quotations; a null conv_id or turn links with
    nothing; rows that repeat a conv_id and turn count as one message with the lines of
    all; blank quoted lines have no origin; an empty table gives an empty result.
    """
    lines = _lines(messages.select("conv_id", "turn", "text"))
    quoted = lines.where("depth > 0").groupBy("conv_id", "turn", "depth", "passage", "size").agg(F.count("*").alias("times"))
    wrote = lines.where("depth = 0").groupBy("conv_id", "passage").agg(F.min("turn").alias("origin"))
    looked = materialize(quoted.join(wrote, ["conv_id", "passage"], "left").withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin"))),
                         "quotations")
    found = looked.where("origin is not null")
    unlinked = looked.where("origin is null and conv_id is not null and turn is not null")
    linked = found.select("conv_id", "turn", F.col("times").alias("n"))
    weights = found.where("depth = 1").select("conv_id", "turn", "origin", (F.col("size") * F.col("times")).cast("long").alias("weight"))
    if not unlinked.isEmpty():
        parts = materialize(_windows(messages.select("conv_id", "turn", "text"), unlinked), "parts")
        linked = linked.unionByName(parts.groupBy("conv_id", "turn", "id", "line").agg(F.lit(1).cast("long").alias("n")).select("conv_id", "turn", "n"))
        weights = weights.unionByName(parts.where("depth = 1").select("conv_id", "turn", "origin", "weight"))
    linked = linked.groupBy("conv_id", "turn").agg(F.sum("n").alias("n_linked"))
    answers = (weights.groupBy("conv_id", "turn", "origin").agg(F.sum("weight").alias("weight"))
               .groupBy("conv_id", "turn").agg(F.max(F.struct("weight", "origin")).alias("best"))
               .select("conv_id", "turn", F.col("best.origin").alias("parent_turn")))
    answers = materialize(answers, "answers")
    chain = threads(answers)
    here = F.expr(r"split(text, '\r?\n')")
    is_quoted = lambda x: x.rlike(r"^[ \t]*>")
    announced = lambda x, i: x.rlike(ATTRIBUTION) & F.coalesce(is_quoted(F.get("_lines", i + 1)), F.lit(False))
    body = F.array_join(F.filter("_lines", lambda x, i: ~is_quoted(x) & ~announced(x, i)), "\n")
    return (messages.select("conv_id", "turn", "role", here.alias("_lines"))
            .join(answers, ["conv_id", "turn"], "left").join(chain, ["conv_id", "turn"], "left").join(linked, ["conv_id", "turn"], "left")
            .select("conv_id", "turn", "role", "parent_turn", F.coalesce("thread_root", "turn").alias("thread_root"),
                    F.coalesce("reply_depth", F.lit(0)).cast("long").alias("reply_depth"),
                    F.coalesce(F.size(F.filter("_lines", is_quoted)), F.lit(0)).cast("long").alias("n_quoted"),
                    F.coalesce(F.array_max(F.transform("_lines", _depth)), F.lit(0)).cast("long").alias("max_depth"),
                    F.coalesce("n_linked", F.lit(0)).alias("n_linked"), body.alias("body"))
            .withColumn("n_quoted", F.greatest("n_quoted", F.lit(0))))


def threads(answers: DataFrame) -> DataFrame:
    """(conv_id, turn, thread_root, reply_depth) of every message that answers one, by pointer doubling over
    (conv_id, turn, parent_turn): the number of passes grows with the logarithm of the longest chain."""
    chain = answers.select("conv_id", "turn", F.col("parent_turn").alias("thread_root"), F.lit(1).cast("long").alias("reply_depth"))
    while True:
        up = chain.select("conv_id", F.col("turn").alias("thread_root"), F.col("thread_root").alias("above"), F.col("reply_depth").alias("more"))
        joined = chain.join(up, ["conv_id", "thread_root"], "left")
        if joined.where("above is not null").isEmpty():
            return chain
        chain = materialize(joined.select("conv_id", "turn", F.coalesce("above", "thread_root").alias("thread_root"),
                                          (F.col("reply_depth") + F.coalesce("more", F.lit(0))).alias("reply_depth")), "threads")


def reply_ordered(linked: DataFrame) -> DataFrame:
    """Linked messages range-sorted: conversations one after the other, each thread from its root on."""
    order = ["conv_id", "thread_root", "turn"]
    return linked.repartitionByRange(*order).sortWithinPartitions(*order)
