"""Near-duplicates against brute force, on random, chained and odd documents."""

import random

import numpy as np

from corpus_pipeline import drop_near_duplicates
from cohortry.llm.near_duplicates import connected, near_duplicates, odd_sketch, one_of_each

DOCS = "doc_id bigint, text string, n bigint, component_id string"


def brute(rows, size, num, den):
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randint(0, 60))
    rows, texts = [], [[word() for _ in range(rng.randint(2, 120))] for _ in range(30)]
    for i in range(240):
        w = list(rng.choice(texts))
        for _ in range(rng.choice((0, 1, 1, 2, 4))):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            texts.append(w)
        rows.append((i, " ".join(w).upper() if rng.random() < 0.2 else "\t".join(w)))
    return rows + [(1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE "), (1005, "one two"), (1006, "z" * 30_000)]


def test_components_equal_brute_force(spark):
    for seed, size, num in ((1, 3, 85), (2, 5, 80)):
        rows = corpus(seed)
        docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], DOCS)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, shingle=size, num=num).collect()}
        assert got == brute(rows, size, num, 100)


def test_nulls_repeats_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c", 1, "x"), (7, "a b c", 1, "x"), (7, "a b c", 1, "x"), (9, "a b c", 1, "x")], DOCS)
    got = sorted([tuple(r) for r in near_duplicates(docs, shingle=3).collect()], key=repr)
    assert got == sorted([(None, 1, None, True), (7, 1, 7, True), (7, 1, 7, True), (9, 1, 7, False)], key=repr)
    assert near_duplicates(docs.limit(0)).count() == 0


def test_long_chains_are_connected(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501), (300, 300)], "a bigint, b bigint")
    got = {r.id: r.label for r in connected(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_sketches_never_show_more_than_the_sets_differ():
    rng = np.random.default_rng(5)
    for n in (0, 1, 40, 5000):
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64) << np.uint64(2))
        b = np.union1d(a[: len(a) * 3 // 4], rng.integers(0, 1 << 62, n // 5, dtype=np.uint64) << np.uint64(2))
        bits = np.bitwise_count(odd_sketch(a) ^ odd_sketch(b)).sum()
        assert bits <= len(np.setxor1d(a, b))


def test_repeated_and_null_ids_do_not_mix_or_keep_copies(spark):
    w = [f"w{i}" for i in range(60)]
    a, near, b = " ".join(w), " ".join(w[:-1] + ["other"]), " ".join(reversed(w))
    rows = [(3, a), (7, near), (7, b), (20, b), (None, "n " * 30), (None, "n " * 30), (9, "same text of nine"), (9, "same text of nine"), (8, None), (8, None)]
    docs = spark.createDataFrame([(i, t, 1, str(k)) for k, (i, t) in enumerate(rows)], DOCS)
    got = {(r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).filter("n_shingles > 20").collect()}
    assert got == {(3, 3, True), (7, 3, False), (7, 7, True), (20, 7, False)}
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(
        [(3, a), (7, b), (None, "n " * 30), (9, "same text of nine"), (8, None), (8, None)], key=repr
    )
    stage = drop_near_duplicates(spark, docs.selectExpr("doc_id", "text", "'en' lang", "'s' source", "n n_chars"), "")
    assert stage.filter("text IS NOT NULL").count() == 4
