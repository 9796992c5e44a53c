"""Quality rules and personal data against plain counts, brute-force patterns and labelled rows."""

import itertools
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np

from conftest import SF01
from llm_rows import awkward, documents  # noqa: F401
from tidepool.llm import pii, quality

SPACE = "[^\x20\x09-\x0D]"


def plain_counts(text):
    text = text or ""
    w = re.findall(SPACE + "+", text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


def test_measures(awkward):
    texts = [t for _, t in awkward if t is None or len(t) < 1000]
    texts += ["a b c a b c", "a a a a", "x\n x\nx\n\n", "#*$%&|<> # |", "one two three four one two three four one two"]
    for t in texts:
        assert quality.measure(t)[:5] == plain_counts(t)
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice(["a", "b", "c ", " ", "\n", "\x0b", "\x1c", "\xa0", "é", "|"]) for _ in range(rng.randrange(40)))
        assert quality.measure(t)[:5] == plain_counts(t)


def test_expectation_maximisation_finds_accuracies():
    """Votes drawn from known accuracies: the estimate comes near them and beats every single rule."""
    rng = np.random.default_rng(8)
    on_good, on_bad = np.array([0.95, 0.9, 0.85, 0.9, 0.8]), np.array([0.9, 0.6, 0.8, 0.7, 0.9])
    good = rng.random(20000) < 0.75
    right = np.where(good[:, None], rng.random((20000, 5)) < on_good, rng.random((20000, 5)) < on_bad)
    votes = np.where(right == good[:, None], 1, -1) * (rng.random((20000, 5)) < 0.8)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.expectation_maximisation(patterns.astype(float), counts.astype(float))
    assert abs(model.share - 0.75) < 0.05
    assert np.abs(model.on_good - on_good).max() < 0.06 and np.abs(model.on_bad - on_bad).max() < 0.1
    said = model.posterior(votes.astype(float)) >= 0.5
    single = max(((votes[:, j] > 0) == good)[votes[:, j] != 0].mean() for j in range(5))
    assert (said == good).mean() > single


def test_expectation_maximisation_of_nothing():
    model = quality.expectation_maximisation(np.zeros((0, 3)), np.zeros(0))
    assert model.share == quality.PRIOR and np.allclose(model.on_good, quality.ON_GOOD) and np.allclose(model.on_bad, quality.ON_BAD)


def test_judge_against_the_model(spark, documents, awkward):
    """Posterior and verdict of every row, worked out again from the rows' own votes."""
    docs = documents(awkward).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "kept")
    rows = quality.judge(docs).collect()
    names = [r.name for r in quality.RULES]
    votes = np.array([[r[n] for n in names] for r in rows], float)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    want = quality.expectation_maximisation(patterns, counts.astype(float)).posterior(votes)
    assert np.allclose([r.posterior for r in rows], want)
    for r, p in zip(rows, want):
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and p >= 0.5)
    kept = quality.kept_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)
    assert quality.judge(documents([])).collect() == [] and quality.kept_rows(documents([])).collect() == []


def test_judge_against_labels(spark):
    """On the labelled documents: nothing of good quality that passes the base is rejected, most of the bad is."""
    judged = quality.judge(spark.read.parquet(f"{SF01}/documents.parquet")).join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id")
    good = judged.where("quality = 1 and not base_failed")
    assert good.where("kept").count() == good.count()
    bad = judged.where("quality = 0")
    assert bad.where("not kept").count() >= 0.95 * bad.count()


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            twice = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
            good = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                    "card": 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in twice) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), k, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(out)]


def test_patterns_equal_plain_search():
    rng = random.Random(1)
    parts = ["a", "b.", "@", "@x.y", "1", "22", ".", "-", " ", "+", "+1 ", "(", ")", "4", "4111111111111111", "1.2.3.4", "é", "_", "\n", "0300"]
    for _ in range(30000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(13)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_viterbi_equals_all_labellings():
    model = pii.field()
    for words in ("call 555-201-3344 (743) 555-3824 now", "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" 12 3", "x 1 2 3"):
        words = words.split()
        for at in range(len(words)):
            run = np.array([model.scores(w) for w in words[at:]])
            got = model.decode([(run, at == 0)])[0]

            def score(labels):
                s = (model.first if at == 0 else model.moves[0])[labels[0]] + sum(run[i, y] for i, y in enumerate(labels))
                return s + sum(model.moves[a, b] for a, b in zip(labels, labels[1:])) + model.moves[labels[-1], 0]
            assert np.isclose(score(got), max(map(score, itertools.product(range(len(pii.LABELS)), repeat=len(run)))))


def test_field_learns_and_generalises():
    """Held out: the field of three quarters of the labelled lines, tried on the rest."""
    lines = pii.labelled_lines()
    right = total = 0
    for fold in range(4):
        model = pii.train([x for i, x in enumerate(lines) if i % 4 != fold])
        for words, labels in lines[fold::4]:
            run = np.array([model.scores(w) if pii._OPEN.search(w) else np.array([0, -1e9, -1e9, -1e9]) for w in words])
            got = model.decode([(run, True)])[0]
            right, total = right + int((got == labels).sum()), total + len(labels)
    assert right / total > 0.95


def test_added_spans():
    model = pii.field()
    text = 'Write to anna.b[at]example.org or call (212) 555-0199. password=b7db7aa4a5fcc78305 and token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"### the end 2004'
    base, spans = pii.all_spans([text], model)[0]
    assert base == []
    assert [(k, text[s:e]) for s, k, e in spans] == [("email", "anna.b[at]example.org"), ("phone", "(212) 555-0199"), ("secret", "b7db7aa4a5fcc78305"),
                                                     ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff")]
    assert pii.mask(text, spans).count("<secret>") == 2
    plain = "The house of 1999 has 12 rooms, 3 doors and 45% of the light (see 7) on page 12-14."
    assert pii.all_spans([plain], model)[0] == ([], [])


def test_added_spans_without_digits():
    """Words of letters only can be labelled, and other spellings of the at sign are found."""
    model = pii.field()
    for text, want in (("the password: CorrectHorseBattery is old", [("secret", "CorrectHorseBattery")]), ("token = \"QXKZJWVLMNBPTRDGHFSC\" then", [("secret", "QXKZJWVLMNBPTRDGHFSC")]),
                       ("write to anna {at} mail.org today", [("email", "anna {at} mail.org")]), ("write to anna at mail dot org today", [("email", "anna at mail dot org")]),
                       ("write to bob{at}mail.example.org today", [("email", "bob{at}mail.example.org")]),
                       ("the password is old and he was at home. The key: first of all, a dot on the map", [])):
        spans = pii.all_spans([text], model)[0][1]
        assert [(k, text[s:e]) for s, k, e in spans] == want, text


def test_skipped_words_change_nothing():
    """Decoding the open words only gives the labels of decoding every word."""
    model = pii.field()
    for words, _ in pii.labelled_lines():
        text = " ".join(words)
        around = pii.contexts(words, {i: k for i, w in enumerate(words) if (k := pii.kind_of(w))})
        labels = model.decode([(np.array([model.scores(w, around.get(i, ())) for i, w in enumerate(words)]), True)])[0]
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        runs = [list(g) for y, g in itertools.groupby(range(len(words)), key=lambda i: labels[i]) if y]
        assert pii.added_spans([text], model)[0] == [(spans[r[0]][0], pii.LABELS[labels[r[0]]], spans[r[-1]][1]) for r in runs]


def test_plain_words_have_the_scores_of_their_class():
    model = pii.field()
    for w in ("the", "The", "Haus.", "(house)", "éa", "token", "Key:", "at", "[at]", "dot", "A", "Verantwortungsgemeins", "JavaScript", "word,", '"x"', "***the", "the###", "ab|", "=abc", "Secret!", "ABC"):
        want, got = model._word(w), model.of_word[w][0]
        assert (want is None) == (got is None) and (want is None or np.allclose(want, got)) and model.of_word[w][1] == pii.kind_of(w), w


def test_added_spans_over_base_spans():
    """A secret with a card number in it is masked whole, and so are the words beside one that touches a pattern."""
    model = pii.field()
    key = "ab3f4111111111111111f0c97de2a45b6c8d9e0f"
    text = f'token = "{key}" and more'
    base, spans = pii.all_spans([text], model)[0]
    assert [k for _, k, _ in base] == ["card"] and ("secret", key) in [(k, text[s:e]) for s, k, e in spans]
    assert set(base) < set(spans) and pii.mask(text, spans) == 'token = "<secret>" and more'
    beside = f'token = "{key}"### that.92@mail2.example.com### end'
    spans = pii.all_spans([beside], model)[0][1]
    assert {(k, beside[s:e]) for s, k, e in spans} == {("secret", key), ("card", "4111111111111111"), ("email", "that.92@mail2.example.com")}
    inside = "call +1 (555) 201-3344 after six"
    base, spans = pii.all_spans([inside], model)[0]
    assert spans == base and pii.mask(inside, spans) == "call <phone> after six"


def test_pii_rows(spark, documents, awkward):
    rows = awkward + [(20, "mail a.b@c.de, ip 10.0.0.1, card 4111 1111 1111 1111, +1 (555) 201-3344"), (21, None)]
    docs = documents(rows).withColumnRenamed("lang", "spans")
    got = {(r.doc_id, r.spans): r for r in pii.find(docs).collect()}
    one = next(r for r in got.values() if r.doc_id == 20)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 1)
    base = ",".join(f"{k}:{s}:{e}" for s, k, e in plain_spans(rows[-2][1]))
    assert one.base_sha256 == sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(one.spans.split(","))
    masked = pii.masked(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert {r.doc_id: r.text for r in masked.collect()}[20] == "mail <email>, ip <ip>, card <card>, <phone>"
    assert pii.find(documents([])).collect() == []
