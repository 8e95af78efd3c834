"""Spelling variants, kernel quality and pivot clusters against plain versions."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velorisk.llm import kernel, pivots, queries, spelling

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- spelling


def edits_one(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_words(rows, least=7, every=31):
    counts = {}
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if n >= 2}


def plain_variants(words, ratio=10):
    near = {w: [v for v in words if edits_one(w, v)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v.encode()), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def found_variants(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def noisy_words(n=150, letters="abcé", seed=5):
    """Words of few letters with many near ones, and counts that make chains of forms."""
    pick = random.Random(seed)
    words = {}
    for _ in range(n):
        word = "".join(pick.choice(letters) for _ in range(pick.randint(7, 11)))
        n_word = 20_000
        while n_word >= 2:
            words[word] = n_word
            at = pick.randrange(len(word))
            word = pick.choice([word[:at] + word[at + 1 :], word[:at] + pick.choice(letters) + word[at:], word[:at] + pick.choice(letters) + word[at + 1 :]])
            n_word //= pick.choice([3, 10, 12])
            if len(word) < 7:
                break
    return words


@pytest.mark.parametrize("parts", [3, 5, 6])
def test_variants_equal_brute_force(spark, parts):
    words = noisy_words()
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = found_variants(spelling.variants(df, parts=parts))
    want = plain_variants(words)
    assert got == want
    assert len({w for w, form, root, *_ in want if form and form != root}) > 5  # chains of forms are among them


def test_words_of_whole_texts_lose_the_letters_that_their_hash_names(spark, awkward):
    rows = [(i, f"Thénonly word{i} thénonly THÉNONLY Straßenbahn {'wider' * 3} short" * 40) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.word: r.n for r in spelling.vocabulary(spelling.damaged_words(df)).collect()}
    assert got == plain_words(rows)
    odd = {r.word: r.n for r in spelling.vocabulary(spelling.damaged_words(awkward)).collect()}
    assert odd == plain_words([(r.doc_id, r.text) for r in awkward.collect()])


def test_variants_of_awkward_inputs(spark, nothing):
    assert spelling.variants(spelling.vocabulary(spelling.damaged_words(nothing))).count() == 0
    long = "ab" * 20_000
    df = spark.createDataFrame([(1, f"{long} {long} {long}x {long}x ÀÀÀÀÀÀÀ ÀÀÀÀÀÀÀ ×÷×÷×÷×÷")], "doc_id bigint, text string")
    words = plain_words([(1, df.first().text)], every=10**9)
    got = found_variants(spelling.variants(spelling.vocabulary(spelling.damaged_words(df, every=10**9))))
    assert got == plain_variants(words) and len(got) == 3


def test_word_with_all_neighbours(spark):
    """A word that each of the others is near to: the others' signatures meet in crowded groups."""
    core = "interest"
    others = [core[:i] + c + core[i:] for i in range(9) for c in "bcdfgh"] + [core[:i] + c + core[i + 1 :] for i in range(8) for c in "bcdfgh"]
    words = {core: 5000} | {w: 2 + i % 7 for i, w in enumerate(others)}
    got = found_variants(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n bigint")))
    assert got == plain_variants(words)


# ---------------------------------------------------------------- kernel


def test_features_approximate_the_kernel():
    x = np.random.default_rng(1).normal(0, 1, (40, len(kernel.STATISTICS)))
    k = kernel.Kernel(np.zeros(x.shape[1]), np.ones(x.shape[1]), size=20_000, width=4.0)
    z = k.features(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * 4.0**2))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_normal_equations_are_sums_over_all_rows(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(0, 1, (500, len(kernel.STATISTICS))).astype(np.float32), rng.integers(0, 2, 500)
    df = spark.createDataFrame([(r.tolist(), int(t)) for r, t in zip(x, y)], "statistics array<float>, label int").repartition(7)
    k = kernel.Kernel(np.zeros(x.shape[1]), np.ones(x.shape[1]), size=20)
    gram, products, n = kernel.normal_equations(df, k)
    z = k.features(x.astype(float))
    assert n == 500
    np.testing.assert_allclose(gram, z.T @ z, rtol=1e-9, atol=1e-9)
    np.testing.assert_allclose(products, z.T @ y, rtol=1e-9, atol=1e-9)


def test_isotonic_equals_the_min_max_formula():
    pick = np.random.default_rng(3)
    for n in (1, 2, 17, 60):
        counts, ones = pick.integers(1, 9, n), None
        ones = np.array([pick.integers(0, c + 1) for c in counts])
        mean = lambda j, k: ones[j : k + 1].sum() / counts[j : k + 1].sum()
        want = [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
        np.testing.assert_allclose(kernel.isotonic(np.arange(n), ones, counts), want)


def test_statistics_do_not_depend_on_what_else_is_in_the_batch():
    texts = ["", "one two two two\nTHREE!!\nTHREE!!", "ä", "\n\n \t", "a b c a b c a b c 123 ###"]
    def of(batch):
        raw = [t.encode() for t in batch]
        return kernel.measure(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    together = of(texts)
    np.testing.assert_allclose(together, np.concatenate([of([t]) for t in texts]))
    at = {n: i for i, n in enumerate(kernel.STATISTICS)}
    assert together[1, at["copied_lines"]] == pytest.approx(1 / 3) and together[1, at["echoes"]] == pytest.approx(3 / 6)
    assert together[4, at["copied_words"]] == pytest.approx(4 / 11) and not together[[0, 3]].any()


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op12_kernel_quality(spark, sf).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    held = got[got.held_out].merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_of_awkward_rows(awkward, nothing, no_labels, spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (7, 0, 0), (9, 0, 1), (4, None, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    measured = kernel.with_statistics(awkward)
    flat = measured.select("row.doc_id", "statistics")
    for model, want in ((kernel.learn(flat, labels), None), (kernel.learn(flat, no_labels), 0.5), (kernel.learn(flat, labels.where("quality = 1")), 1.0)):
        got = kernel.with_score(measured, model).collect()
        assert len(got) == awkward.count() and all(0 <= r.score <= 1 for r in got)
        assert want is None or {r.score for r in got} == {want}
    assert {(r.row.doc_id, r.row.text, r.row.score) for r in got} == {(r.doc_id, r.text, r.score) for r in awkward.collect()}
    empty = kernel.with_statistics(nothing)
    assert kernel.with_score(empty, kernel.learn(empty.select("row.doc_id", "statistics"), labels)).count() == 0


# ---------------------------------------------------------------- pivots


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda r: hashlib.sha256(f"3:{r[0]}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (name(r), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centroids)]
    return sorted((i, n, d) for (i, v) in kept for d, n in [nearest(v)]), centroids


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 0.2, 64) + (i % 5)).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(60)]  # a third of the rows is one vector
    rows += [(2000, None, 0), (2001, [1.0] * 63, 0), (2002, [None] + [1.0] * 63, 0), (2003, [float("nan")] * 64, 0), (2004, [float("inf")] * 64, 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want, centroids = plain_clusters([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows])
    assigned, got = pivots.cluster(df)
    assert got.tolist() == centroids
    assert sorted((r["key"], r.cluster, r.distance) for r in assigned.collect()) == want
    sums = pivots.with_inertia(assigned).select("cluster", "cluster_inertia", "inertia").distinct().collect()
    assert {r.inertia for r in sums} == {sum(d for *_, d in want)}
    assert {(r.cluster, r.cluster_inertia) for r in sums} == {(c, sum(d for _, n, d in want if n == c)) for c in {n for _, n, _ in want}}


def test_bounds_rule_centroids_out_and_never_the_nearest():
    rng = np.random.default_rng(6)
    centroids = rng.integers(-300, 300, (8, 64))
    v = np.concatenate([centroids[rng.integers(0, 8, 400)] + rng.integers(-30, 30, (400, 64)), (centroids[:1] + centroids[1:2]) // 2, centroids])
    every = np.stack([pivots.squared(v, c) for c in centroids], 1)
    for known in (v[:12], v[:1]):
        best, least, computed = pivots.nearest(v, pivots._pivot_distances(v, known), centroids, pivots._pivot_distances(centroids, known))
        assert (best == every.argmin(1)).all() and (least == every.min(1)).all()
        assert computed < (0.6 if len(known) > 1 else 1) * every.size


def test_equal_distances_go_to_the_smaller_number(spark):
    line = [[float(x)] + [0.0] * 63 for x in (0, 2, 1, 1, 0, 2)]
    df = spark.createDataFrame([(i, v, 0) for i, v in enumerate(line)], VECTORS)
    want, _ = plain_clusters(list(enumerate(line)), k=3)
    assert sorted((r["key"], r.cluster, r.distance) for r in pivots.cluster(df, pivots.Clustering(clusters=3))[0].collect()) == want


def test_clusters_of_awkward_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assigned, centroids = pivots.cluster(empty)
    assert pivots.with_inertia(assigned).count() == 0 and len(centroids) == 0
    few = spark.createDataFrame([(None, [0.5] * 64, 1), (3, [0.25] * 64, 2), (3, [1e30] * 64, 2), (3, [-1e30] * 64, 2)], VECTORS).withColumn("cluster", F.lit("x"))
    got = pivots.with_inertia(pivots.cluster(few)[0]).collect()
    assert len(got) == 4 and all(r.distance == 0 for r in got) and sorted(r.cluster for r in got) == [0, 1, 2, 3]


def test_every_pair_of_near_words_shares_a_signature():
    """By the argument of the module: two differing elements touch two sets at most."""
    for parts in (3, 5):
        for touched in itertools.combinations_with_replacement(range(parts), 2):
            assert any(set(touched) <= set(out) for out in itertools.combinations(range(parts), 2))
