"""Whitespace, sentence and token expressions against Python's own string methods."""

from pyspark.sql import functions as F

from tidepool.functions.text import (JAVA_WS_CLASS, collapse_ws, sentence_split, strip_ws, tokenize,
                                     tokenize_collapsed)


def test_whitespace_class_is_str_isspace(spark):
    chars = [chr(c) for c in range(0x110000) if not (0xD800 <= c <= 0xDFFF)]
    rows = [("".join(chars[i:i + 5000]),) for i in range(0, len(chars), 5000)]
    df = spark.createDataFrame(rows, "s string")
    keep_ws = df.select(F.regexp_replace("s", f"[^{JAVA_WS_CLASS[1:-1]}]", "").alias("w")).collect()
    assert "".join(r.w for r in keep_ws) == "".join(c for c in chars if c.isspace())


# text, stripped, blanks as one, sentences, tokens
EXAMPLES = [
    ("  a b\t\tc. D! E?  f ", "a b\t\tc. D! E?  f", "a b c. D! E? f", ["a b c.", "D!", "E?", "f"], ["a", "b", "c.", "d!", "e?", "f"]),
    ("", "", "", [], []), ("   ", "", "", [], []), ("x\u3000y. z", "x\u3000y. z", "x y. z", ["x y.", "z"], ["x", "y.", "z"]),
    ("Ünï ÇA. bß", "Ünï ÇA. bß", "Ünï ÇA. bß", ["Ünï ÇA.", "bß"], ["ünï", "ça.", "bß"]),
    ("v1.2 is out... Get it!Now", "v1.2 is out... Get it!Now", "v1.2 is out... Get it!Now", ["v1.2 is out...", "Get it!Now"], ["v1.2", "is", "out...", "get", "it!now"]),
]


def test_worked_examples(spark):
    df = spark.createDataFrame([(i, e[0]) for i, e in enumerate(EXAMPLES)], "i int, t string")
    for r in df.select("i", strip_ws("t").alias("s"), collapse_ws("t").alias("c"), sentence_split("t").alias("p"), tokenize("t").alias("k")).collect():
        assert (r.s, r.c, r.p, r.k) == EXAMPLES[r.i][1:]
    collapsed = df.select(collapse_ws("t").alias("c"))
    assert all(r.a == r.b for r in collapsed.select(tokenize("c").alias("a"), tokenize_collapsed("c").alias("b")).collect())


def test_sentences_have_no_end_inside_and_join_to_the_text(spark):
    import random
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["a", "B", ".", "!", "?", " ", "  ", "\n", "\t", "é"]) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(collapse_ws("t").alias("c"), sentence_split("t").alias("p")).collect():
        assert " ".join(r.p) == r.c and "" not in r.p
        for sentence in r.p:
            assert not any(end + " " in sentence for end in ".!?")
        assert all(sentence[-1] in ".!?" for sentence in r.p[:-1])


def test_strip_is_str_strip_on_every_whitespace(spark):
    import random
    ws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    rnd = random.Random(5)
    pool = list(ws) + list("ab é中​")
    cases = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 8))) for _ in range(500)] + [ws, "x" + ws + "y"]
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert [r[0] for r in df.select(strip_ws("s")).collect()] == [c.strip() for c in cases]
