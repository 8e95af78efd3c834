"""Operators that look at one document at a time, against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from velorisk.llm import decontaminate, language, lines, quality, toxicity
from velorisk.llm.common import LOWER, UPPER

FOLD = str.maketrans(UPPER, LOWER)


# Lines


def plain_lines(texts, min_docs):
    split = [(t or "").split("\n") for t in texts]
    key = lambda line: line.strip(" \t\n\v\f\r").translate(FOLD)
    seen = Counter(k for part in split for k in {key(x) for x in part} if k)
    return [(len(p), sum(seen[key(x)] >= min_docs for x in p), "\n".join(x for x in p if seen[key(x)] < min_docs)) for p in split]


def test_common_lines_go(docs_of):
    texts = [f"own {i}\n  Shared Line\t\n\nshared line\nown {i % 4}" for i in range(12)] + [None, "", "SHARED LINE", " Shared Line"]
    for least in (2, 3, 12, 13):
        got = lines.drop_common_lines(docs_of(texts), least).orderBy("doc_id").collect()
        assert [(r.n_lines, r.n_dropped, r.kept) for r in got] == plain_lines(texts, least)


def test_awkward_lines(awkward, nothing):
    got = lines.drop_common_lines(awkward, 4).collect()
    assert len(got) == awkward.count()
    assert {(r.doc_id, r.n_lines, r.n_dropped) for r in got} >= {(1, 1, 1), (None, 1, 1), (3, 1, 0), (4, 1, 0), (9, 301, 0)}
    assert lines.drop_common_lines(nothing).count() == 0


def test_lines_use_no_python(awkward):
    plan = lines.drop_common_lines(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Decontamination


def plain_leaks(text, items, n):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    words, hit, owners = cut(text), set(), set()
    for item, t in items:
        own = cut(t)
        for window in {tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))} if own else ():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    owners.add(item)
    return len(words), sorted(hit), sorted(x for x in owners if x is not None)


def test_leaks_equal_plain_search(spark, docs_of):
    rng = np.random.default_rng(1)
    word = lambda: rng.choice(["a", "B", "ç", "dd", "7", "é é", "x\x85y", "a-b"])
    texts = [" ".join(word() for _ in range(rng.integers(0, 80))) for _ in range(60)] + [None, "", "...", "dd"]
    items = [(i, " ".join(word() for _ in range(rng.integers(0, 7)))) for i in range(25)] + [(90, None), (91, "dd"), (None, "7 dd"), (92, "dd")]
    table = spark.createDataFrame(items, "item_id bigint, text string")
    for n, size in ((3, 1 << 20), (2, 40)):
        for r in decontaminate.find_leaks(docs_of(texts), table, n, automaton_bytes=size).collect():
            count, hit, owners = plain_leaks(r.row.text, items, n)
            assert (r.hits.n_words, r.hits.words_hit, r.hits.n_hit) == (count, hit, len(hit))
            assert r.hits["items"] == owners
            whole = (r.row.text or "").encode()
            in_spans = sum(len(decontaminate.folded(whole[a:b]).split()) for a, b in r.hits.spans)
            assert in_spans == len(hit)


def test_awkward_leaks(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "one two three")], "item_id bigint, text string")
    got = decontaminate.find_leaks(awkward, items, 3)
    assert got.count() == awkward.count() and got.where("hits.n_hit > 0").count() == 4
    assert got.where("row.text IS NULL AND hits.n_words = 0").count() == 2
    assert decontaminate.find_leaks(nothing, items).count() == 0
    assert decontaminate.find_leaks(awkward, items.limit(0)).where("hits.n_hit > 0").count() == 0


# Language


WORDS = {"en": "the of and to in that is was he for", "de": "der die und das nicht für ein über mit sich", "fr": "le la les été être où avec pour une dans"}


def spoken(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))


def test_language_by_full_hypervectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, spoken(rng, lang := list(WORDS)[i % 3], 30), lang) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    profiles = language.learn(docs.where("doc_id < 60"), dimensions=256)
    got = {r.row.doc_id: r.language for r in language.identify(docs, profiles).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    # The same by vectors of every document, built gram by gram.
    letters = language.letter_vectors(256)
    a = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters
    side = language.SYMBOLS

    def vector(text):
        found, _ = language.grams([text])
        return sum((a[0][g // side**2] * a[1][g // side % side] * a[2][g % side] for g in found), np.zeros(256))

    bundles = np.array([sum(vector(t) for i, t, x in rows if x == lang and i < 60) for lang in profiles.languages])
    counts = [sum(len(language.grams([t])[0]) for i, t, x in rows if x == lang and i < 60) for lang in profiles.languages]
    bundles /= np.array(counts)[:, None]
    bundles -= bundles.mean(axis=0)
    bundles /= np.linalg.norm(bundles, axis=1, keepdims=True)
    for i, text, _ in rows[60:]:
        v = vector(text)
        cosines = bundles @ v / np.linalg.norm(v)
        assert profiles.languages[cosines.argmax()] == got[i].lang_pred
        assert got[i].score == pytest.approx(cosines.max() / np.maximum(cosines, 0).sum(), rel=1e-3)


def test_awkward_languages(spark, awkward, nothing):
    taught = language.learn(spark.createDataFrame([("en", "the of and"), ("de", "der die das"), (None, "x"), ("fr", None)], "lang string, text string"))
    assert taught.languages == ["de", "en"]
    got = {(r.row.doc_id, r.language.lang_pred) for r in language.identify(awkward, taught).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (7, "und")} <= got and (1, "und") not in got
    assert language.identify(nothing, taught).count() == 0
    untaught = language.identify(awkward, language.learn(nothing))
    assert untaught.where("language.lang_pred <> 'und' OR language.score <> 0").count() == 0


# Quality


def plain_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[ \t\n\v\f\r]+", text) if w]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), copies, len(again)


def test_counts_equal_plain_counts(docs_of, awkward):
    rng = np.random.default_rng(5)
    parts = ["a", "b", "é#", "\n", "\n\n", "x y z", "<b>", "\t", "\v", "你"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.integers(0, 60))) for _ in range(80)] + ["x x x x", "a\na\n a"]
    blank = quality.Field(np.zeros((quality.FEATURES, 2)), np.zeros((2, 2)), np.zeros(2))
    for docs in (docs_of(texts), awkward):
        got = quality.judge(docs, blank)
        assert got.count() == docs.count()
        for r in got.collect():
            assert tuple(r.measures)[:5] == plain_counts(r.row.text)
            assert r.measures.content_words == r.measures.n_words


def test_viterbi_finds_the_best_marks():
    rng = np.random.default_rng(6)
    field = quality.Field(rng.normal(size=(quality.FEATURES, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    rows = np.repeat([0, 1, 2, 5], [1, 4, 7, 2])
    features = rng.normal(size=(len(rows), quality.FEATURES))
    got = quality.viterbi(field, features, rows)
    for row in set(rows):
        scores = features[rows == row] @ field.unary
        n = len(scores)

        def value(marks):
            steps = sum(field.steps[a, b] for a, b in zip(marks, marks[1:], strict=False))
            return field.start[marks[0]] + steps + sum(scores[i, m] for i, m in enumerate(marks))

        best = max((tuple(k >> i & 1 for i in range(n)) for k in range(1 << n)), key=value)
        assert tuple(got[rows == row]) == best


def test_field_learns_boilerplate(spark, no_labels, awkward, nothing):
    rng = np.random.default_rng(8)
    good = lambda: " ".join(rng.choice(["quiet", "river", "under", "stone", "walks"]) for _ in range(60)) + "."
    poor = lambda: " | ".join(rng.choice(["HOME", "ABOUT", "LOGIN", "***"]) for _ in range(60))
    rows = [(i, good() if i % 2 else poor()) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)] + [(None, 1, 1), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    field = quality.learn_field(docs, labels)
    got = {r.row.doc_id: r.measures.content_words / r.measures.n_words for r in quality.judge(docs, field).collect()}
    assert all((got[i] > 0.5) == bool(i % 2) for i in range(60, 80))
    assert quality.judge(nothing, field).count() == 0
    assert not quality.learn_field(awkward, no_labels).unary.any()


# Toxicity


def labelled(spark, texts, toxic):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, 1, y) for i, y in enumerate(toxic)], "doc_id bigint, quality int, toxic int")


def test_swapped_terms_keep_the_score(spark):
    rng = np.random.default_rng(9)
    filler = lambda: " ".join(rng.choice([f"w{k}" for k in range(200)]) for _ in range(12))
    texts, toxic = [], []
    for i in range(600):
        bad = i % 4 == 0
        # One group is mentioned mostly in toxic texts: a plain classifier learns the mention.
        term = "muslims" if rng.random() < (0.8 if bad else 0.1) else "christians"
        texts.append(f"{filler()} {term} {rng.choice(['scumword', 'vileword']) if bad and rng.random() < 0.9 else ''} {filler()}")
        toxic.append(int(bad))
    docs, labels = labelled(spark, texts, toxic)
    probe = spark.createDataFrame([(0, "the muslims met today"), (1, "the christians met today"), (2, "scumword christians")], "doc_id bigint, text string")
    gap = {}
    for fairness in (0.0, 20.0):
        fitted = toxicity.learn_toxicity(docs, labels, fairness=fairness)
        got = {r.row.doc_id: r.score for r in toxicity.score_toxicity(probe, fitted).collect()}
        gap[fairness] = abs(got[0] - got[1])
    assert gap[0.0] > 0.1 and gap[20.0] < gap[0.0] / 3
    assert got[2] > 0.5 > max(got[0], got[1])


def test_held_out_toxicity(spark):
    rng = np.random.default_rng(10)
    make = lambda bad: " ".join([*(f"w{k}" for k in rng.integers(0, 500, 40)), *(["nastily" if rng.random() < 0.5 else "nastier"] if bad else [])])
    toxic = [int(i % 5 == 0) for i in range(500)]
    docs, labels = labelled(spark, [make(y) for y in toxic], toxic)
    fitted = toxicity.learn_toxicity(docs, labels.where("doc_id < 400"))
    got = {r.row.doc_id: r.score >= 0.5 for r in toxicity.score_toxicity(docs, fitted).collect()}
    assert sum(got[i] == bool(toxic[i]) for i in range(400, 500)) >= 98


def test_awkward_toxicity(spark, awkward, nothing, no_labels):
    fitted = toxicity.learn_toxicity(awkward, no_labels)
    got = toxicity.score_toxicity(awkward, fitted)
    assert got.count() == awkward.count() and got.where("score >= 0.5").count() == 0
    assert toxicity.score_toxicity(nothing, fitted).count() == 0
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (8, 1, 0), (None, 0, 1), (9, 0, None), (77, 1, 1)], "doc_id bigint, quality int, toxic int")
    scores = [r.score for r in toxicity.score_toxicity(awkward, toxicity.learn_toxicity(awkward, labels)).collect()]
    assert all(0 <= s <= 1 for s in scores)
