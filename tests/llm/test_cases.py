"""The cases that every operator must take, and models against plain versions of themselves."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from terrasift.llm import decontaminate, language_id, language_model, line_dedup, minhash, mixing, quality_model, rules, toxicity
from tests.llm.test_words_and_minhash import SCHEMA

CLASHING = ("score", "h", "n", "at", "key", "gone", "rep", "place", "slot", "size", "y", "o", "terms", "times", "_h", "_part", "count")


def awkward(spark):
    r = random.Random(21)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows = [(k, text(r.randrange(1, 80)), "en" if k % 2 else "de", f"s{k % 3}", 5) for k in range(60)]
    rows += [(70, None, None, None, None), (71, "", "en", "s1", 0), (72, " \n\t ", "en", None, 3), (73, "é" * 30_000, "de", "s1", 0), (74, text(120_000), "en", "s2", 0)]
    rows += [rows[5], rows[5], (80, text(30), "en", "s0", 1), (80, text(31), "de", "s0", 1), (None, text(20), "en", "s0", 1), (None, None, None, None, None)]
    rows += [(90 + k, rows[k][1], "en", "s0", 1) for k in range(6)]  # ties
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, int(k % 3 == 0)) for k in range(60)] + [(5, 1, 0), (None, 1, 1), (3, None, None), (4, 7, 7)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, rows[0][1]), (2, None), (None, text(40)), (1, rows[0][1])], "item_id long, text string")
    return docs, labels, items


def operators(labels, items):
    return {
        "mixing": mixing.mix, "lines": line_dedup.report, "model": language_model.held_out_scores, "quality": lambda d: quality_model.held_out_scores(d, labels), "toxicity": lambda d: toxicity.held_out_scores(d, labels),
        "language": language_id.held_out_predictions, "index": lambda d: decontaminate.contamination(d, items, slop=2), "near": lambda d: minhash.near_duplicates(d, 4, 80), "rules": rules.judge,
    }


@pytest.mark.parametrize("name", ["mixing", "lines", "model", "quality", "toxicity", "language", "index", "near", "rules"])
def test_awkward_tables(spark, monkeypatch, name):
    monkeypatch.setattr(toxicity, "STEPS", 30)
    docs, labels, items = awkward(spark)
    f = operators(labels, items)[name]
    rows = f(docs.withColumns({c: F.lit("x") for c in CLASHING})).collect()
    count = {None: 2, 5: 3, 80: 2}
    assert sorted(str(x.doc_id) for x in rows) == sorted(str(x.doc_id) for x in docs.collect())
    by_id = {}
    for x in rows:
        by_id.setdefault(x.doc_id, []).append(x)
    assert all(len(by_id[k]) == count.get(k, 1) for k in by_id)
    if name != "mixing":  # there each row has its own place
        assert len({repr(x) for x in by_id[5]}) == 1
    if name not in ("model", "mixing"):
        again = f(docs.repartition(3)).collect()
        assert sorted(map(repr, again)) == sorted(map(repr, rows))
    assert f(docs.limit(0)).collect() == []


def test_the_least_of_unlike_texts_stands(spark):
    same = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(3, "zz " * 9, "", "", 0), (3, same, "", "", 0), (1, same, "", "", 0), (None, same, "", "", 0)], SCHEMA)
    rows = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(docs, 4, 80).collect()), key=str)
    assert rows == [(1, 7, 1, True), (3, 7, 1, False), (3, 7, 1, False), (None, 7, None, True)]
    kept = minhash.one_of_each(docs.where("doc_id = 3 or doc_id is null"), 4, 80).collect()
    assert sorted((x.doc_id or 0, x.text) for x in kept) == [(0, same), (3, same)]


def test_recall_of_near_duplicates_at_the_threshold(spark):
    """Pairs of similarity 0.80 to 0.85, exactly counted: all are found."""
    r = random.Random(22)
    vocabulary = ["".join(r.choice("abcdefghijkl") for _ in range(6)) for _ in range(4000)]
    texts, want = [], 0
    while want < 300:
        base = [r.choice(vocabulary) for _ in range(r.randrange(60, 250))]
        other, edits = list(base), 0
        while True:
            a, b = ({tuple(x[i : i + 4]) for i in range(len(x) - 3)} for x in (base, other))
            similar = len(a & b) / len(a | b)
            if similar <= 0.85 or edits > 30:
                break
            other[r.randrange(len(other))] = r.choice(vocabulary)
            edits += 1
        if similar >= 0.8:
            texts += [" ".join(base), " ".join(other)]
            want += 1
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(spark.createDataFrame([(k, t, "", "", 0) for k, t in enumerate(texts)], SCHEMA), 4, 80).collect()}
    assert all(got[2 * k + 1] == 2 * k for k in range(want))


def test_quality_equals_a_plain_discriminant(spark):
    docs, labels, _ = awkward(spark)
    docs = docs.where("doc_id < 74")
    rows = docs.collect()
    x = {i: quality_model.statistics(pa.array([t.text], pa.string()))[0] for i, t in enumerate(rows)}
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 0
    known = [(l.doc_id, l.quality) for l in labels.collect() if l.quality in (0, 1) and l.doc_id is not None and not held(l.doc_id)]
    data = {k: np.array([x[i] for i, t in enumerate(rows) for d, q in known if t.doc_id == d and q == k]) for k in (0, 1)}
    n = {k: len(v) for k, v in data.items()}
    cov = {k: np.cov(v.T, bias=True) for k, v in data.items()}
    pooled = (cov[0] * n[0] + cov[1] * n[1]) / (n[0] + n[1])

    def log_density(v, k):
        s = (1 - quality_model.TO_POOLED) * cov[k] + quality_model.TO_POOLED * pooled
        d = np.diag(np.maximum(np.diag(s), 1e-3))
        s = (1 - quality_model.TO_DIAGONAL) * s + quality_model.TO_DIAGONAL * d + 1e-4 * np.eye(len(s))
        u = v - data[k].mean(axis=0)
        return -0.5 * u @ np.linalg.solve(s, u) - 0.5 * np.linalg.slogdet(s)[1] + math.log((n[k] + 0.5) / (n[0] + n[1] + 1))

    got = {}
    for y in quality_model.held_out_scores(docs, labels).collect():
        got.setdefault(y.doc_id, y)
    for i, t in enumerate(rows):
        if t.doc_id in (80,):
            continue
        want = 1 / (1 + math.exp(-max(-40, min(40, log_density(x[i], 1) - log_density(x[i], 0)))))
        assert abs(got[t.doc_id].score - want) < 1e-6 and got[t.doc_id].predicted == (got[t.doc_id].score >= 0.3)


def test_language_equals_plain_compression(spark):
    docs, _, _ = awkward(spark)
    raw = language_id.dictionaries(docs.where("doc_id is not null"))
    assert sorted(raw) == ["de", "en"]

    def cost(text, lang):
        content = zstandard.ZstdCompressionDict(raw[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)
        data = language_id.letters(text)
        return sum(len(coder.compress(data[j : j + language_id.BLOCK])) for j in range(0, len(data), language_id.BLOCK))

    some = docs.where("doc_id < 30 or doc_id in (70, 71, 72, 73)")
    for x, t in zip(language_id.predict(some, raw).collect(), some.collect()):
        assert x.doc_id == t.doc_id
        if not t.text or not t.text.strip():
            assert (x.lang_pred, x.score, x.rejected) == ("und", 0.0, True)
        else:
            de, en = cost(t.text, "de"), cost(t.text, "en")
            assert x.lang_pred == ("de" if de <= en else "en") and x.rejected == (abs(de - en) * 8 / len(language_id.letters(t.text)) < language_id.MARGIN)
    tie = language_id.predict(some, {"b": raw["en"], "a": raw["en"]}).where("lang_pred != 'und'").collect()
    assert {x.lang_pred for x in tie} == {"a"} and all(x.rejected for x in tie)


def test_toxicity_equals_a_plain_network():
    r = random.Random(23)
    words = ["w%s" % "".join(r.choice("abcdef") for _ in range(4)) for _ in range(60)]
    texts = [" ".join(r.choice(words) for _ in range(n)) for n in (1, 5, 31, 32, 33, 57, 90)] + ["", "!!!"]
    net = toxicity.Network(np.unique(np.concatenate([toxicity.read_words(pa.array(texts))[0][:40]])), np.zeros(40, dtype=np.float32))
    rng = np.random.default_rng(1)
    net.p = {k: rng.normal(size=v.shape).astype(np.float32) * 0.4 for k, v in net.p.items()}
    got, count = net.best(pa.array(texts))
    p, sig = net.p, lambda v: 1 / (1 + np.exp(-v))

    def gru(xs, x, b, u):
        h, out = np.zeros(toxicity.HIDDEN), []
        for v in xs:
            a, g = v @ x + b, h @ u
            z, s = (sig(a[k : k + toxicity.HIDDEN] + g[k : k + toxicity.HIDDEN]) for k in (0, toxicity.HIDDEN))
            new = np.tanh(a[2 * toxicity.HIDDEN :] + s * g[2 * toxicity.HIDDEN :])
            h = (1 - z) * new + z * h
            out.append(h)
        return out

    for t, z, n in zip(texts, got, count):
        key, grams, starts, number, _ = toxicity.read_words(pa.array([t]))
        place = net.lookup(key)
        vec = [np.concatenate([p["word"][place[j]], p["char"][grams[starts[j] : starts[j + 1]]].mean(axis=0)]) for j in number]
        step, best, windows = toxicity.WINDOW - toxicity.OVERLAP, -np.inf, max(1, -(-(len(vec) - toxicity.OVERLAP) // (toxicity.WINDOW - toxicity.OVERLAP)))
        for k in range(windows):
            first = min(k * step, max(0, len(vec) - toxicity.WINDOW))
            part = vec[first : first + toxicity.WINDOW]
            if part:
                h = np.concatenate([gru(part, p["xf"], p["bf"], p["uf"]), gru(part[::-1], p["xb"], p["bb"], p["ub"])[::-1]], axis=1)
                s = np.tanh(h @ p["v"]) @ p["a"][:, 0]
                w = np.exp(s - s.max())
                best = max(best, float((w / w.sum()) @ h @ p["o"][:, 0] + p["ob"][0]))
        assert n == windows and (not vec or abs(z - best) < 1e-3)
