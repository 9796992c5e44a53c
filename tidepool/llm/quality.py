"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every rule looks at one measure of a text and votes good (1), bad (-1) or abstains
(0).  Rows with the same votes are alike to the model, so its input is the count of
each vote pattern: at most ``3 ** len(RULES)`` rows however many documents there are.
EM over these counts estimates the share of good documents and each rule's accuracy;
the posterior of a document is then a sum of one weight per vote, a plain column
expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm.common import WORD_SPACE, map_slices
from tidepool.session import materialize

SYMBOLS = b"#*$%&|<>"
ENDINGS = (".", "!", "?", ":", '"', "'", "”", "»", "…", ")")
ROUNDS, PRIOR, CERTAIN = 50, 0.8, 0.5  # EM rounds, first share of good rows, posterior from which a text is kept
ON_GOOD, ON_BAD = 0.97, 0.3  # first accuracies: a rule seldom accuses good text, and catches some of the kinds of bad text

_NOT_LETTER = bytes(b for b in range(128) if not chr(b).isalpha())
_NOT_DIGIT = bytes(b for b in range(256) if not 48 <= b <= 57)

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_bytes", "n_letters", "n_digits", "n_lone_symbols")


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains."""

    name: str
    good: str
    bad: str

    def vote(self) -> Column:
        return (F.when(F.expr(self.good), 1).when(F.expr(self.bad), -1).otherwise(0)).cast("int").alias(self.name)


RULES = (
    Rule("length", "n_words >= 80", "n_words < 50"),
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 14 * n_words"),
    Rule("symbols", "50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    Rule("lone_symbols", "100 * n_lone_symbols <= n_words", "10 * n_lone_symbols > n_words"),
    Rule("lines", "20 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("repetition", "100 * n_repeat_words <= 15 * n_words", "100 * n_repeat_words > 35 * n_words"),
    Rule("letters", "100 * n_letters >= 85 * n_bytes", "100 * n_letters < 65 * n_bytes"),
    Rule("digits", "100 * n_digits <= 4 * n_bytes", "100 * n_digits > 15 * n_bytes"),
    Rule("endings", "n_lines > 0 and 2 * n_ended >= n_lines", "20 * n_ended < n_lines"),
)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in a window of ``window`` words which the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    c = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    keys, size = c[:n], len(codes)
    for i in range(1, window):
        if size * len(codes) >= 1 << 62:
            _, keys = np.unique(keys, return_inverse=True)
            size = n
        keys, size = keys * len(codes) + c[i:i + n], size * len(codes)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(keys, twice))
    covered = np.zeros(len(words), bool)
    for i in range(window):
        covered[at + i] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple:
    """The values of ``METRICS`` of a text."""
    text = text or ""
    raw = text.encode("utf-8")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    solid = raw.translate(None, WORD_SPACE)
    endings = tuple(e.encode("utf-8") for e in ENDINGS)
    return (len(words), len(text) - (len(raw) - len(solid)), len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(lines),
            sum(line.rstrip().endswith(endings) for line in lines), len(solid),
            len(solid.translate(None, _NOT_LETTER)), len(raw.translate(None, _NOT_DIGIT)),
            sum(words.count(bytes((b,))) for b in SYMBOLS))


def _measuring():
    def step(cols):
        rows = [measure(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "text_hash": cols["text_hash"]} | {k: [r[i] for r in rows] for i, k in enumerate(METRICS)}
    return step


def metrics(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and ``METRICS`` of every row."""
    return map_slices(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), _measuring,
                      "doc_id long, text_hash long, " + ", ".join(f"{k} long" for k in METRICS))


@dataclass(frozen=True)
class Model:
    """Share of good rows, and each rule's accuracy on good rows and on bad ones."""

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    @property
    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds of good: of any row, added by a good vote, added by a bad vote (never against the vote)."""
        return (float(np.log(self.share / (1 - self.share))),
                np.maximum(0, np.log(self.on_good / (1 - self.on_bad))),
                np.minimum(0, np.log((1 - self.on_good) / self.on_bad)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        base, plus, minus = self.weights
        return 1 / (1 + np.exp(-(base + (votes > 0) @ plus + (votes < 0) @ minus)))


def expectation_maximisation(votes: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> Model:
    """The model of vote patterns (m, rules) and their counts.

    Rules are taken as independent given the class; an abstention says nothing.  A
    rule has one accuracy on good rows and one on bad rows, for a rule may catch one
    kind of bad text and wave the others through.  Ten votes of the first accuracies are
    added to each and ten rows at ``PRIOR``, so a rule that never votes keeps its first
    values and an empty table the first model.
    """
    rules = votes.shape[1]
    model = Model(PRIOR, np.full(rules, ON_GOOD), np.full(rules, ON_BAD))
    for _ in range(rounds):
        good = model.posterior(votes)
        for_good, for_bad = counts * good, counts * (1 - good)
        on_good = (for_good @ (votes > 0) + 10 * ON_GOOD) / (for_good @ (votes != 0) + 10)
        on_bad = (for_bad @ (votes < 0) + 10 * ON_BAD) / (for_bad @ (votes != 0) + 10)
        share = float((for_good.sum() + 10 * PRIOR) / (counts.sum() + 10))
        model = Model(min(max(share, 0.01), 0.99), on_good.clip(0.01, 0.99), on_bad.clip(0.01, 0.99))
    return model


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS, certain: float = CERTAIN) -> DataFrame:
    """Quality of every row of ``docs`` (doc_id, text; other columns are not read).

    Returns doc_id, text_hash, ``METRICS``, one vote column per rule, posterior
    (probability of good quality), base_failed (fewer than 50 words, or more than half
    of the words in repeated windows) and kept (not base_failed and posterior at least
    ``certain``).  A null text counts as empty: no words, base_failed.  Null ids and
    repeated rows are judged like any other; ties in the posterior are kept; an
    empty table gives an empty result.
    """
    voted = materialize(metrics(docs).select("*", *[r.vote() for r in rules]), "votes")
    return _scored(voted, rules, rounds, certain)


def _scored(voted: DataFrame, rules: tuple[Rule, ...], rounds: int, certain: float) -> DataFrame:
    """Add posterior, base_failed and kept to rows with ``METRICS`` and votes."""
    names = [r.name for r in rules]
    patterns = voted.groupBy(*names).agg(F.count("*").alias("n")).orderBy(*names).collect()  # 3 ** len(rules) rows at most
    table = np.array([list(p) for p in patterns], np.float64).reshape(len(patterns), len(names) + 1)
    base, plus, minus = expectation_maximisation(table[:, :-1], table[:, -1], rounds).weights
    odds = F.lit(base)
    for name, p, m in zip(names, plus, minus):
        odds = odds + F.when(F.col(name) > 0, float(p)).when(F.col(name) < 0, float(m)).otherwise(0.0)
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return (voted.withColumn("posterior", 1 / (1 + F.exp(-odds))).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= certain)))


def _measuring_rows(text: str):
    def make():
        def step(cols):
            rows = [measure(t) for t in cols[text]]
            return cols | {k: [r[i] for r in rows] for i, k in enumerate(METRICS)}
        return step
    return make


def kept_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = ROUNDS, certain: float = CERTAIN) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    The rows are written once beside their measures and filtered when read again, so no
    text is shuffled.  Columns are numbered meanwhile: names that a measure or rule also
    has do no harm.
    """
    numbered = docs.toDF(*[f"_column_{i}" for i in range(len(docs.columns))])
    text = numbered.columns[docs.columns.index("text")]
    fields = T.StructType([*numbered.schema.fields, *[T.StructField(k, T.LongType()) for k in METRICS]])
    voted = materialize(map_slices(numbered, _measuring_rows(text), fields).select("*", *[r.vote() for r in rules]), "votes")
    return _scored(voted, rules, rounds, certain).where("kept").select(*[F.col(n).alias(c) for n, c in zip(numbered.columns, docs.columns)])
