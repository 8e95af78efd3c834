"""Operators that compare documents or write files, against brute force and round trips."""

import hashlib
import io
import re
import warnings
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

import corpus_pipeline
from velorisk.llm import graph, mixing, neardup, repeats, shards, warc
from velorisk.llm.common import LOWER, UPPER, materialise

FOLD = str.maketrans(UPPER, LOWER)


# Components


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(200, 260)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {k: 100 for k in [100, *range(200, 260)]} | {300: 300, 301: 300}


# Near duplicates


def plain_classes(rows, percent=85, n=5):
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(FOLD))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()
    above = {i: i for i in sets}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                above[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def near_copies(rng, groups=12, copies=9, words=120):
    texts = []
    for _ in range(groups):
        base = [f"w{k}" for k in rng.integers(0, 5000, words)]
        for _ in range(copies):
            own = list(base)
            for at in rng.integers(0, words, rng.integers(0, 5)):
                own[at] = f"v{rng.integers(0, 10**6)}"
            texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("leaf", [256, 6])
def test_classes_equal_brute_force(docs_of, leaf):
    rng = np.random.default_rng(2)
    texts = near_copies(rng) + ["One two", "one TWO", "", None, " ", "a b c d e", "a b c d e f"]
    rows = list(enumerate(texts))
    got = neardup.near_duplicates(docs_of(texts), neardup.Search(leaf=leaf, group=leaf)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_classes(rows)


def test_crowd_of_copies_is_one_class(docs_of):
    rng = np.random.default_rng(4)
    texts = near_copies(rng, groups=1, copies=150, words=400) + ["same text of a few words here"] * 120
    got = neardup.near_duplicates(docs_of(texts), neardup.Search(leaf=16, group=16)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_classes(list(enumerate(texts)))


def test_sparse_chains_in_blocks_of_many_groups(docs_of):
    rng = np.random.default_rng(5)
    texts = []
    for c in range(40):
        words = [f"c{c}w{k}" for k in range(100)]
        for step in range(12):
            words[4 + 8 * step] = f"c{c}v{step}"
            texts.append(" ".join(words))
    texts = [texts[k] for k in rng.permutation(len(texts))]
    got = neardup.near_duplicates(docs_of(texts), neardup.Search(group=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == plain_classes(list(enumerate(texts)))


def test_awkward_near_duplicates(awkward, nothing):
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(awkward).collect())
    assert got[(1, 3, 1, True)] == 2 and got[(2, 3, 1, False)] == 1 and got[(None, 3, None, True)] == 1
    assert got[(3, 0, 3, True)] == 1 and got[(5, 0, 5, True)] == 1 and sum(got.values()) == awkward.count()
    assert neardup.near_duplicates(nothing).count() == 0


# Repeats


def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate(([False], gone[:-1], [False])).astype(int)))
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((len(b), int(gone.sum()), len(edges) // 2, kept))
    return out


@pytest.mark.parametrize("together", [2000, 3])
def test_repeats_equal_brute_force(monkeypatch, docs_of, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rng = np.random.default_rng(12)
    noise = lambda n: "".join(rng.choice(list("abcdé \n"), n))
    shared = [noise(n) for n in (90, 100, 101, 150, 400)]
    texts = [noise(rng.integers(0, 150)) + shared[rng.integers(5)] + noise(rng.integers(0, 150)) for _ in range(70)]
    texts += ["ab" * 200, "x" * 500, "xyz" * 60, None, "", shared[3], shared[3][:99], shared[4], shared[4]]
    got = repeats.drop_repeats(docs_of(texts), length=100).orderBy("doc_id").collect()
    want = plain_repeats(texts, 100)
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want
    assert [r.kept_sha256 for r in got] == [hashlib.sha256(w[3]).hexdigest() for w in want]


def test_awkward_repeats(awkward, nothing):
    got = repeats.drop_repeats(awkward).collect()
    assert len(got) == awkward.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].n_removed == by_id[8].n_bytes - 3 and by_id[1].n_removed == 0 and by_id[3].n_bytes == 0
    assert repeats.drop_repeats(nothing).count() == 0


def test_column_order_by_sorting():
    rng = np.random.default_rng(13)
    symbols = rng.integers(0, 2, (60, 14)).astype(np.uint16)
    groups = np.sort(rng.integers(0, 4, 60))
    again, first = repeats.column_order(symbols, groups, 5)
    for c in range(10):
        strings = [(groups[i], *symbols[i, c : c + 5]) for i in range(60)]
        seen = Counter(strings)
        assert [seen[s] > 1 for s in strings] == again[:, c].tolist()
        assert sum(first[:, c]) == len(seen)


# WARC


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)


PAGES = [
    (1, "http://a/1", "x" * 2000),
    (2, "http://a/2", "x" * 2000),
    (9, None, "x" * 2000),
    (3, "http://a/3", "small"),
    (4, "http://a/4\nInjected: yes", "small"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://a/ü", "é\r\n\r\nWARC/1.1\r\n" * 300),
    (None, "http://a/8", "y" * 1500),
    (8, "http://a/9", "y" * 1500),
    (8, "http://a/9", "y" * 1500),
]


@pytest.mark.parametrize("compress", ["true", "false"])
def test_archive_round_trip(spark, tmp_path, compress):
    path = f"file://{tmp_path}/archive"
    spark.dataSource.register(warc.WarcSource)
    records = warc.page_records(pages_of(spark, PAGES))
    records.write.format("warc").mode("append").option("path", path).option("compress", compress).option("maxFileBytes", 3000).save()
    back = warc.read_archive(spark, path).select("*", warc.page_id_of(F.col("record_id")).alias("page_id")).collect()
    assert len(back) == len(PAGES)
    by_id = {r.page_id: r for r in back}
    for page, _, html in PAGES:
        data = (html or "").encode()
        assert (by_id[page].payload_bytes, by_id[page].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        if by_id[page].record_type == "response":
            assert bytes(by_id[page].payload) == data
    assert {k: (r.record_type, r.refers_to) for k, r in by_id.items() if r.record_type == "revisit"} == {
        1: ("revisit", "<urn:page:9>"),
        2: ("revisit", "<urn:page:9>"),
        None: ("revisit", "<urn:page:8>"),
    }
    only = warc.read_archive(spark, path).where("record_type = 'revisit' AND payload_bytes > 1500")
    assert sorted(r.target_uri for r in only.collect()) == ["http://a/1", "http://a/2"]
    heads = warc.read_archive(spark, path, payload=False)
    assert heads.where("payload IS NOT NULL").count() == 0 and heads.count() == len(PAGES)


def test_unwanted_payloads_are_jumped_over():
    row = {"record_id": "<urn:page:1>", "target_uri": "http://a", "warc_date": "2024-01-01T00:00:00Z", "refers_to": None}
    rows = [row | {"record_type": t, "payload": np.random.default_rng(1).bytes(10**6), "payload_digest": None, "payload_bytes": None} for t in ("metadata", "response")]
    packed = b"".join(warc.member(warc.record(r)) for r in rows)
    damaged = bytearray(packed)
    damaged[600:700] = bytes(100)  # within the first payload
    got = list(warc.records(io.BufferedReader(io.BytesIO(bytes(damaged))), [EqualTo(("record_type",), "response")]))
    assert [r["record_type"] for r in got] == ["response"] and len(got[0]["payload"]) == 10**6
    with pytest.raises((ValueError, zlib.error)):
        list(warc.records(io.BufferedReader(io.BytesIO(bytes(damaged)))))


def test_empty_archive(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    warc.write_archive(warc.page_records(pages_of(spark, [])), path)
    assert warc.read_archive(spark, path).count() == 0


# Mixing


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(14)
    good = lambda n: " ".join(rng.choice(["quiet", "river", "under", "stone"]) for _ in range(n)) + "."
    poor = lambda n: " | ".join(rng.choice(["HOME", "ABOUT", "***"]) for _ in range(n))
    rows = [(i, good(rng.integers(20, 200)) if i % 3 else poor(rng.integers(20, 200))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)], "doc_id bigint, quality int, toxic int")
    got = mixing.mix(docs, labels, {0: 0.1, 1: 0.9}).collect()
    total = sum(r.tokens for r in got)
    reached = [sum(r.tokens * r.posterior[k] * r.rate for r in got) for k in (0, 1)]
    assert reached == pytest.approx([0.1 * total, 0.9 * total], rel=1e-3)
    assert min(r.rate for r in got) >= 0 and all(abs(r.copies - r.rate) < 1 for r in got)
    assert abs(sum(r.copies * r.tokens for r in got) / total - 1) < 0.15
    # More of the rare domain than there is of the other: rates stop at 0 and the totals still fit.
    got = mixing.mix(docs, labels, {0: 1.0, 1: 0.0}).collect()
    assert min(r.rate for r in got) == 0.0
    assert sum(r.tokens * r.posterior[0] * r.rate for r in got) == pytest.approx(total, rel=0.02)


@pytest.fixture(scope="module")
def few_poor(spark):
    rng = np.random.default_rng(16)
    good = lambda n: " ".join(rng.choice(["quiet", "river", "under", "stone"]) for _ in range(n)) + "."
    poor = lambda n: " | ".join(rng.choice(["HOME", "ABOUT", "***"]) for _ in range(n))
    docs = spark.createDataFrame([(i, poor(60) if i < 10 else good(60)) for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i >= 10), 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("targets", [{0: 0.3, 1: 0.7}, {0: 1.0, 1: 0.0}])
def test_targets_beyond_four_times_a_domain_are_met(few_poor, targets):
    got = mixing.mix(*few_poor, targets).collect()
    total = sum(r.tokens for r in got)
    reached = [sum(r.tokens * r.posterior[k] * r.rate for r in got) for k in (0, 1)]
    assert reached == pytest.approx([targets[0] * total, targets[1] * total], abs=0.02 * total)
    assert got[0].targets == pytest.approx([targets[0] * total, targets[1] * total])
    assert got[0].reached == pytest.approx(reached, abs=1e-3 * total)


def test_a_domain_without_labels_is_told(few_poor):
    docs, labels = few_poor
    with pytest.warns(UserWarning, match="aimed at"):
        got = mixing.mix(docs, labels.where("quality = 1"), {0: 0.1, 1: 0.9}).collect()
    total = sum(r.tokens for r in got)
    assert got[0].reached == pytest.approx([0, 0.9 * total], abs=1e-3 * total)


def test_rare_domain_reaches_its_target(spark):
    rare = "w double, t double, p0 double, p1 double"
    narrow = spark.createDataFrame([(1.0, 1 / 5000, float(i < 4), float(i >= 4)) for i in range(5000)], rare)
    fit = mixing.fit_rates(narrow, np.array([0.02, 0.98]))
    assert fit.reached == pytest.approx([0.02, 0.98], abs=1e-5) and np.abs(fit.residual).max() < 1e-5


def soft_members(k, n=300):
    rng = np.random.default_rng(17)
    p = rng.dirichlet([0.6] * k, n)
    p[:, 0] = np.minimum(p[:, 0], 0.6)  # a mixture of nearly all tokens from the first domain is out of reach
    t = rng.exponential(1, n)
    return p / p.sum(1, keepdims=True), t / t.sum()


def plain_totals(p, t, target, rounds=50_000):
    """Plain projected gradient over all rates at once, with the safe step of the whole matrix."""
    a = (np.sqrt(t)[:, None] * p).T
    bound, u = np.linalg.eigvalsh(a @ a.T)[-1], np.sqrt(t)
    for _ in range(rounds):
        u = np.maximum(0, u - a.T @ (a @ u - target) / bound)
    return a @ u


@pytest.mark.parametrize(
    "target,rounds,within",
    [((0.25, 0.25, 0.25, 0.25), 60, 1e-4), ((0.4, 0.6), 60, 1e-4), ((0.97, 0.01, 0.01, 0.01), 30, 0.12), ((0.999, 0.001), 30, 0.08)],
)
def test_rates_approach_those_of_a_plain_solver(spark, target, rounds, within):
    k, target = len(target), np.array(target)
    p, t = soft_members(k)
    rows = spark.createDataFrame([(float(x), *map(float, y)) for x, y in zip(t, p)], "t double, " + ", ".join(f"p{i} double" for i in range(k)))
    fit = mixing.fit_rates(rows, target, rounds=rounds)
    lists = rows.withColumn("posterior", F.array(*[f"p{i}" for i in range(k)]))
    w = np.array([r.rate for r in lists.select(mixing.rate_of(F.col("posterior"), fit).alias("rate")).collect()])
    assert w.min() >= 0
    np.testing.assert_allclose(np.sort(fit.reached), np.sort((w * t) @ p), atol=1e-9)  # what is told is what the rates give
    np.testing.assert_allclose(fit.residual, fit.reached - target)
    np.testing.assert_allclose(fit.reached, plain_totals(p, t, target), atol=within)
    assert np.square(fit.residual).sum() < np.square(t @ p - target).sum()


def test_awkward_mixing(awkward, nothing, no_labels):
    got = mixing.mix(awkward, no_labels).collect()
    assert len(got) == awkward.count() and all(r.rate >= 0 for r in got)
    assert all(r.rate == 1 and r.copies == 1 for r in got if r.tokens == 0)
    assert mixing.mix(nothing, no_labels).count() == 0


# Shards


@pytest.mark.parametrize("size", [1, 2, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(size):
    out = shards.feistel(np.arange(size), size, 99)
    assert sorted(out) == list(range(size))
    assert (shards.feistel(out, size, 99, inverse=True) == np.arange(size)).all()
    assert size < 64 or (out != shards.feistel(np.arange(size), size, 98)).any()


def test_shards_hold_every_token_once(spark, awkward, nothing, tmp_path):
    docs = materialise(awkward.drop("row"), "awkward")
    layout = shards.Layout(length=64, shard_bytes=64 * 2 * 100)
    path = f"file://{tmp_path}/shards"
    rows = shards.write_shards(docs, path, layout).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    tokens = list(shards.read_slots(spark, path, 0, len(rows)))
    assert [hashlib.sha256(t.tobytes()).hexdigest() for t in tokens] == [r.tokens_sha256 for r in rows]
    some = list(shards.read_slots(spark, path, 5, 7))
    assert all((x == y).all() for x, y in zip(some, tokens[5:12], strict=True))
    ranks = shards.vocabulary(shards.VOCABULARY)
    coder = tiktoken.Encoding("own", pat_str=shards.PATTERN, mergeable_ranks=ranks, special_tokens={})
    end = len(ranks)
    streams = np.concatenate([t[: r.n_tokens] for r, t in sorted(zip(rows, tokens, strict=True), key=lambda x: x[0].seq)])
    texts = Counter(coder.decode(list(p)) for p in np.split(streams, np.flatnonzero(streams == end) + 1) for p in [p[p != end]])
    want = Counter((r.text or "") for r in awkward.collect())
    texts[""] -= 1  # after the last end mark
    assert +texts == want
    assert {i for r in rows for i in r.doc_ids} == {r.doc_id for r in awkward.collect()}
    assert shards.write_shards(materialise(nothing, "nothing"), f"file://{tmp_path}/none").count() == 0


# Pipeline


def test_stages_keep_clean_documents(spark, tmp_path):
    rng = np.random.default_rng(15)
    text = lambda k: " ".join(f"{rng.choice(['river', 'stone', 'walk', 'under', 'light'])}{chr(97 + k % 20)}{x}" for x in rng.choice(list("abcdefgh"), 60)) + "."
    rows = [(i, text(i), "en", "s", 0) for i in range(40)]
    rows += [(50, rows[3][1], "en", "s", 0), (51, None, None, None, None), (52, "123", "en", "s", 0)]
    question = " ".join(f"question{k}" for k in "abcdefghijklm")
    rows.append((53, text(9) + " " + question, "en", "s", 0))
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, question)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, str(tmp_path)), name)
        if name != "token_shards":
            assert out.columns == docs.columns
            left[name] = {r.doc_id for r in out.collect()}
        docs = out
    assert left["language_id"] == {*range(40), 50, 53}
    assert left["near_duplicates"] == {*range(40), 53}
    assert left["decontamination"] == set(range(40))
    assert left["mixing"] == set(range(40))
    assert {i for r in docs.collect() for i in r.doc_ids} == set(range(40))


def test_near_copies_from_four_fifths_on_go(spark, docs_of):
    words = [f"w{k}" for k in range(104)]
    changed = lambda *at: " ".join(f"v{k}" if k in at else w for k, w in enumerate(words))
    texts = [" ".join(words), changed(20, 60), changed(20, 40, 60, 80), "another text of several words"]
    # Of 100 shingles, 90 are shared by the first two: 90 / 110 = 0.82; the third has 80 / 120 with the first, 90 / 110 with the second.
    assert [x[1] for x in plain_classes(list(enumerate(texts))).values()] == [0, 1, 2, 3]
    assert [x[1] for x in plain_classes(list(enumerate(texts)), percent=80).values()] == [0, 0, 0, 3]
    left = corpus_pipeline.without_near_copies(spark, docs_of(texts), "")
    assert {r.doc_id for r in left.collect()} == {0, 3}


def test_rows_that_repeat_an_id_are_documents_of_their_own(spark):
    a, b = "one two three four five six seven eight nine ten", "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(5, a), (5, b), (2, a + " "), (3, b), (5, a), (7, "something else in the end of it"), (7, "something else in the end of it"), (None, a), (None, a)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, kept string").repartition(3)
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept, r.sole) for r in neardup.near_duplicates(df).collect())
    assert got == sorted([(5, 2, False, False), (5, 3, False, False), (2, 2, True, True), (3, 3, True, True), (5, 2, False, False), (7, 7, True, True), (7, 7, True, True), (0, 0, True, True), (0, 0, True, True)])
    left = corpus_pipeline.without_near_copies(spark, df, "")
    assert left.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(2, a + " "), (3, b), (7, rows[5][1]), (0, a), (0, a)])


def test_one_of_two_texts_with_the_same_id_stays(spark):
    words = [f"w{k}" for k in range(200)]
    rows = [(4, " ".join(words)), (4, " ".join([*words[:-1], "other"])), (4, "a unique text under the same id")]
    left = corpus_pipeline.without_near_copies(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert len(left) == 2 and rows[2][1] in {r.text for r in left}


def test_stages_of_tables_without_rows(spark, nothing, no_labels, tmp_path):
    """Without benchmark items nothing is contaminated; without labels everything stays."""
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    no_labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, f"text number {i} of a small table", "en", "s", 20) for i in range(5)], nothing.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name
    for name, stage in corpus_pipeline.STAGES[2:4]:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            assert stage(spark, docs, str(tmp_path)).count() == 5, name
