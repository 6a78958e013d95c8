"""Tokenisation and near-duplicate detection against plain Python."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrasift.llm import common, minhash, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts, first=0):
    rows = [(first + k, t, "en", "s", len(t or "")) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def split(text):
    return (text or "").encode().lower().split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbB \n\té\x00,", max_size=40)), max_size=8))
def test_hashes_tell_words_apart(texts):
    h, at = words.hashes(pa.array(texts, pa.string()))
    known = {}
    for k, t in enumerate(texts):
        own = split(t)
        assert at[k + 1] - at[k] == len(own)
        for w, x in zip(own, h[at[k] : at[k + 1]]):
            assert known.setdefault(w, int(x)) == int(x)
    assert len(set(known.values())) == len(known)


def test_texts_longer_than_a_chunk():
    r = random.Random(1)
    vocabulary = ["w%d" % k for k in range(50)] + ["x" * (words.CHUNK + 10)]
    texts = [" ".join(r.choice(vocabulary[:50]) for _ in range(120_000)), "", "a b", " ".join([vocabulary[50], "b", vocabulary[50]])]
    h, at = words.hashes(pa.array(texts))
    assert list(np.diff(at)) == [120_000, 0, 2, 3]
    assert h[at[3]] == h[at[3] + 2] and h[at[3] + 1] == h[at[2] + 1]
    one = {w: words.one_hash(w.encode()) for w in vocabulary[:50]}
    assert [int(x) for x in h[:2000]] == [one[w] for w in texts[0].split()[:2000]]


def test_lookup():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(3))
    find = words.Lookup(keys)
    assert (find(keys) == np.arange(len(keys))).all() and (find(keys + np.uint64(1)) == -1).sum() >= len(keys) - 2
    assert (words.Lookup(keys[:0])(keys) == -1).all()


def brute(texts, k, percent=80):
    sets = []
    for t in texts:
        w = split(t)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            p, q = sorted((find(a), find(b)))
            parent[q] = p
    return [len(s) for s in sets], [find(x) for x in range(len(texts))]


def edited(r, text, n, vocabulary):
    w = text.split()
    for _ in range(n):
        kind, at = r.randrange(3), r.randrange(len(w))
        if kind == 0:
            w[at] = r.choice(vocabulary)
        elif kind == 1 and len(w) > 8:
            del w[at]
        else:
            w.insert(at, r.choice(vocabulary))
    return " ".join(w)


@pytest.mark.parametrize("k", [4, 5])
def test_components_of_a_large_near_group_equal_brute_force(spark, k):
    r = random.Random(k)
    vocabulary = ["v%d" % j for j in range(3000)]
    base = " ".join(r.choice(vocabulary) for _ in range(150))
    texts = [None, "", " \n", "one", "One", "one two", base, base.upper()]
    texts += [edited(r, base, r.choice([1, 2, 3, 4, 6, 8]), vocabulary) for _ in range(160)]
    texts += [" ".join(base.split()[: r.randrange(60, 150)]) for _ in range(40)]
    texts += [" ".join(r.choice(vocabulary) for _ in range(r.randrange(5, 60))) + " " + " ".join(base.split()[20:50]) for _ in range(60)]
    r.shuffle(texts)
    sizes, want = brute(texts, k)
    got = {x.doc_id: x for x in minhash.near_duplicates(table(spark, texts), k, 80).collect()}
    assert [got[d].n_shingles for d in range(len(texts))] == sizes
    assert [got[d].component_id for d in range(len(texts))] == want
    assert all(x.kept == (x.doc_id == x.component_id) for x in got.values())
    assert max(Counter(want).values()) > 50


def test_repeated_rows_and_empty_tables(spark):
    df = table(spark, ["a b c d e f"]).union(table(spark, ["a b c d e f"])).union(table(spark, ["a b c d e f"], 7))
    rows = minhash.near_duplicates(df, 4, 80).collect()
    assert sorted((x.doc_id, x.component_id) for x in rows) == [(0, 0), (0, 0), (7, 0)]
    assert minhash.near_duplicates(df.limit(0), 4, 80).collect() == []
    assert minhash.one_of_each(df.limit(0)).columns == df.columns


def test_one_of_each_drops_repeated_rows(spark):
    text = "one two three four five six seven eight nine ten"
    docs = table(spark, [text, text, "quite another text that has nothing in common with it"])
    rows = minhash.one_of_each(docs.union(docs)).collect()
    assert sorted(x.doc_id for x in rows) == [0, 2]


def test_components_and_class_min(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(90, 80), (80, 85), (3, 3)], "a long, b long")
    assert {x.node: x.comp for x in common.components(edges).collect()} == {**{k: 0 for k in range(41)}, 80: 80, 85: 80, 90: 80}
    df = spark.createDataFrame([(1, None), (2, None), (3, "x"), (4, "x"), (5, "y")], "id long, k string")
    assert {x.id: x.m for x in common.class_min(df, ["k"], "id", "m").collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 5}


@pytest.mark.parametrize("k", [4, 5])
def test_sets_of_a_batch_with_fewer_words_than_a_shingle(k):
    """A batch whose texts have one to k words in all is read as any other."""
    for n in range(k + 1):
        own = np.arange(1, n + 1, dtype=np.uint64)
        found, at = minhash.sets(own, np.array([0, n], dtype=np.int64), k)
        assert len(found) == (n > 0) and list(at) == [0, int(n > 0)]
        more, where = minhash.sets(np.concatenate((own, np.arange(50, 60, dtype=np.uint64))), np.array([0, n, n + 10], dtype=np.int64), k)
        assert list(more[: where[1]]) == list(found)
