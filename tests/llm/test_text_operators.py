"""Decontamination, line dedup, rules, mixing, language and model operators on small fixtures."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrasift.llm import common, decontaminate, language_id, language_model, line_dedup, mixing, quality_model, rules, toxicity
from tests.llm.test_words_and_minhash import SCHEMA, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(text, items, size=13):
    w, hit, found = WORD.findall(lower(text)), set(), set()
    for item, body in items:
        v = WORD.findall(lower(body))
        for a in range(max(1, len(v) - size + 1) if v else 0):
            win = v[a : a + size]
            for s in range(len(w) - len(win) + 1):
                if w[s : s + len(win)] == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(item)
    return len(w), len(hit), found


@pytest.mark.parametrize("slice_words", [2_000_000, 30])
def test_contamination_equals_brute_force(spark, monkeypatch, slice_words):
    monkeypatch.setattr(decontaminate, "SLICE_WORDS", slice_words)
    r = random.Random(2)
    vocabulary = ["w%d" % k for k in range(60)] + ["é", "the", "9"]
    passage = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, passage(r.choice([3, 12, 13, 14, 20]))) for k in range(12)] + [(50, None), (51, "!!"), (52, "the the the"), (53, "The, THE the")]
    texts = [None, "", "...", "the the the the", passage(5)]
    for _ in range(60):
        parts = [passage(r.randrange(0, 30))]
        for _ in range(r.randrange(0, 3)):
            parts += [r.choice(items)[1] or "", passage(r.randrange(0, 10))]
        texts.append(r.choice([", ", " ", "\n"]).join(parts).replace("w1 ", "W1-"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = {x.doc_id: x for x in decontaminate.contamination(table(spark, texts), bench, slop=2).collect()}
    for d, text in enumerate(texts):
        n, hit, found = brute_hits(text, items)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        assert (rows[d].n_words, rows[d].n_hit, rows[d].n_items, rows[d].items_sha256, rows[d].contaminated) == (n, hit, len(found), sha, hit > 0 and 20 * hit >= n)
        assert rows[d].n_near >= rows[d].n_items


def test_proximity_takes_any_order(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = table(spark, ["x delta gamma y beta alpha x", "alpha one two three four five beta gamma delta", "alpha beta gamma"])
    near = {x.doc_id: x.near for x in decontaminate.matches(docs, bench, slop=1).collect()}
    assert near == {0: ["1"], 1: [], 2: []}


def test_no_benchmark_and_no_documents(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = table(spark, ["a b"])
    row = decontaminate.contamination(docs, bench).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)
    assert decontaminate.contamination(docs.limit(0), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_lines_keep_one_of_each_group(spark):
    long = "the quick brown fox jumps over the lazy dog near the old river bank while seven grey herons watch in silence from the far shore of the lake today"
    close = long.replace("silence", "quiet")
    texts = [None, "", f"{long}\nshort line", f"A, {long}!".replace("A, ", "") + "\nshort line", f"own words that nobody else has written here\n{close}", "own words, that nobody else has written HERE\n\nother"]
    rows = {x.doc_id: x for x in line_dedup.report(table(spark, texts)).collect()}
    assert rows[0].n_lines == 0 and rows[1].gone == [] and rows[2].gone == []
    assert rows[3].gone == [0, 1]  # equal once normalised, short lines too
    assert rows[5].gone == [0]
    out = {x.doc_id: x for x in line_dedup.without_repeats(table(spark, texts)).collect()}
    assert 3 not in out and out[5].text == "\nother" and out[5].n_chars == 6 and out[2].text == texts[2]
    assert set(out) == {0, 1, 2, 4, 5}
    assert line_dedup.report(table(spark, ["a"]).limit(0)).collect() == []


def word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def edited_line(r, words, edits, vocabulary):
    w = list(words)
    for _ in range(edits):
        at, what = r.randrange(len(w)), r.randrange(3)
        w[at : at + (what != 1)] = [r.choice(vocabulary)] if what else []
    return w


def line_groups(words):
    """The least member of each line's group, by all pairs."""
    least = list(range(len(words)))
    for b in range(len(words)):
        for a in range(b):
            n = max(len(words[a]), len(words[b]))
            if least[a] != least[b] and 5 * abs(len(words[a]) - len(words[b])) <= n and word_edits(words[a], words[b]) * 5 <= n:
                old, new = max(least[a], least[b]), min(least[a], least[b])
                least = [new if x == old else x for x in least]
    return least


def test_lines_equal_brute_force_over_word_edits(spark):
    r = random.Random(8)
    vocabulary = ["v%s" % "".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(60)] + ["the"] * 30
    words = []
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(r.choice([1, 3, 4, 5, 6, 7, 8, 10]))]  # all runs are keys, so none may be missed
        words += [edited_line(r, base, r.randrange(0, len(base) // 5 + 2), vocabulary) or ["a"] for _ in range(r.randrange(1, 4))]
    r.shuffle(words)
    least = line_groups(words)
    want = {k for k in range(len(words)) if least[k] != k}
    assert len(want) > 30
    assert {x.doc_id for x in line_dedup.report(table(spark, [" ".join(w) for w in words])).collect() if x.gone} == want


def letters(r, n):
    """Words without digits, which normalising would make alike."""
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)]


def test_recall_of_lines_at_the_least_similarity(spark):
    """Pairs at similarity 0.8 (as many edits as there may be) and 0.9, of lines of 8 to 60 words."""
    r = random.Random(10)
    vocabulary = letters(r, 5000)
    pairs = []
    for n in (8, 10, 15, 20, 30, 40, 60):
        for share in (0.2, 0.1):
            for _ in range(40):
                base = [r.choice(vocabulary) for _ in range(n)]
                pairs.append((base, edited_line(r, base, int(share * n), vocabulary)))
    pairs = [(a, b) for a, b in pairs if word_edits(a, b) * 5 <= max(len(a), len(b))]
    rows = {x.doc_id: x.gone for x in line_dedup.report(table(spark, [" ".join(w) for p in pairs for w in p])).collect()}
    found = sum(rows[2 * k + 1] == [0] for k in range(len(pairs)))
    assert len(pairs) > 400 and found >= 0.97 * len(pairs) and all(rows[2 * k] == [] for k in range(len(pairs)))


def test_lines_with_a_common_passage(spark, monkeypatch):
    """Hot keys: unlike lines around one passage stay, near copies among them are found."""
    monkeypatch.setattr(line_dedup, "HOT", 8)
    r = random.Random(11)
    vocabulary = letters(r, 3000)
    passage = [r.choice(vocabulary) for _ in range(20)]
    words = []
    for _ in range(120):
        own = [r.choice(vocabulary) for _ in range(20)]
        words.append(own[:10] + passage + own[10:])
    words += [edited_line(r, w, 4, vocabulary) for w in words[:30]]
    least = line_groups(words)
    assert sum(least[k] != k for k in range(len(words))) == 30
    got = {x.doc_id for x in line_dedup.report(table(spark, [" ".join(w) for w in words])).collect() if x.gone}
    assert got <= {k for k in range(len(words)) if least[k] != k} and len(got) >= 28


def test_line_cases(spark):
    long = " ".join(letters(random.Random(1), 30_000))
    same = "one line that stands here again"
    rows = [(1, f"{long}\n{same}", "a"), (2, f"{same}\n{long} more", "b"), (2, f"{same}\n{long} more", "b"), (None, same, None), (4, None, "c"), (5, f"{same}\n{same}\n..\n", "d"), (6, "q q q q q q q q q q q q", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone0 string").withColumns({"h": F.lit(1), "comp": F.lit(2), "_id0": F.lit(3)})
    got = sorted((x.doc_id, x.n_lines, x.n_kept, x.gone) for x in line_dedup.report(docs.where("doc_id is not null")).collect())
    assert got == [(1, 2, 2, []), (2, 2, 0, [0, 1]), (2, 2, 0, [0, 1]), (4, 0, 0, []), (5, 4, 2, [0, 1]), (6, 1, 1, [])]
    out = line_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    kept = {x.doc_id: (x.text, x._gone0) for x in out.collect()}
    assert kept == {1: (rows[0][1], "a"), None: (same, None), 4: (None, "c"), 5: ("..\n", "d"), 6: (rows[6][1], "e")}


def brute_rules(text):
    text = text or ""
    w = SPACED.findall(text)
    c = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rules_equal_brute_force(spark):
    r = random.Random(4)
    texts = [None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "é é é é", "x|y # $\nx|y # $\n\n \nx|y # $"]
    texts += [r.choice([" ", "\n", "\t"]).join(r.choice(["a", "b", "cé", "#d", "the"]) for _ in range(r.randrange(1, 200))) for _ in range(60)]
    texts.append(" ".join("w%d" % r.randrange(3000) for _ in range(30_000)))
    for x in rules.judge(table(spark, texts)).collect():
        want = brute_rules(texts[x.doc_id])
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == want
        assert x.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (x.base_failed and x.kept)


def sources(spark, spec):
    rows, k = [], 0
    for source, sizes in spec.items():
        for n in sizes:
            rows.append((k, " ".join(["w"] * n) if n is not None else None, "en", source or None, 0))
            k += 1
    return spark.createDataFrame(rows, SCHEMA)


def test_mix_reaches_its_targets(spark):
    r = random.Random(5)
    spec = {"a": [r.randrange(1, 900) for _ in range(200)], "b": [5, None, 0], "c": [20_000, 3], "": [40] * 50}
    docs = sources(spark, spec)
    rows = mixing.mix(docs, block=64).collect()
    assert len(rows) == docs.count()
    for source in spec:
        own = [x for x in rows if (x.source or "") == source]
        assert sum(x.size for x in own) == own[0].source_size
        assert abs(sum(x.taken for x in own) - own[0].target) <= 1 and own[0].target <= 2 * own[0].source_size + 1e-6
    assert all(0 <= x.taken <= 2 * x.size for x in rows)
    goals = {x.source: x.target for x in rows}
    assert abs(sum(goals.values()) - 1.5 * sum(x.size for x in rows)) < 1e-3
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(docs, block=64).collect()), key=repr)
    assert mixing.mix(docs.limit(0)).collect() == [] and all(x.taken == 0 for x in mixing.mix(docs.where("text is null")).collect())


def test_schedule_keeps_sources_near_their_share(spark):
    goals = spark.createDataFrame([("a", 64_000, 60_000.0, 0), ("b", 64_000, 20_000.0, 1), ("c", 64_000, 40_000.0, 2)], "source string, source_size long, target double, place long")
    rows = sorted(mixing.schedule(goals, 64).collect(), key=lambda x: x.slot)
    assert Counter(x.source for x in rows)["a"] == math.ceil(60_000 / 64)
    for n in (100, 500, 1000):
        c = Counter(x.source for x in rows if x.slot < n)
        assert abs(c["a"] - n / 2) <= 6 and abs(c["b"] - n / 6) <= 6 and abs(c["c"] - n / 3) <= 6


def test_schedule_is_bounded_by_blocks_and_decides_the_order(spark, monkeypatch):
    goals = spark.createDataFrame([("huge", 50_000_000, 75_000_000.0, 0), ("tiny", 10, 20.0, 1), (None, 4096, 4096.0, 2)], "source string, source_size long, target double, place long")
    rows = mixing.schedule(goals).collect()
    need = math.ceil(50_000_000 / 4096) + math.ceil(25_000_000 / 4096) + 2 + 1
    assert len(rows) == need and max(x.slot for x in rows) < need + 24 and sum(x.words for x in rows) == 75_000_000 + 20 + 4096
    assert sorted((x.rank, x.words) for x in rows if x.source == "tiny") == [(0, 10), (1, 10)]
    docs = sources(spark, {"a": [300] * 40, "b": [200] * 30, "c": [100] * 20})
    first = {x.doc_id: (x.taken, x.first_slot) for x in mixing.mix(docs, block=64).collect()}
    monkeypatch.setattr(mixing, "GOLDEN", math.sqrt(2) - 1)
    other = {x.doc_id: (x.taken, x.first_slot) for x in mixing.mix(docs, block=64).collect()}
    assert {k: v[0] for k, v in first.items()} == {k: v[0] for k, v in other.items()} and first != other


def test_many_sources(spark):
    docs = spark.range(3000).select("id", F.lit("a b c").alias("text"), F.lit("en").alias("lang"), F.concat(F.lit("s"), F.col("id") % 1500).alias("source"), F.lit(5).alias("n_chars")).withColumnRenamed("id", "doc_id")
    rows = mixing.mix(docs.withColumns({"place": F.lit(1), "at": F.lit("x"), "slot": F.lit(None)}), block=2).collect()
    assert len(rows) == 3000 and all(x.taken <= 2 * x.size == 6 and x.source_size == 6 for x in rows)
    goals = {x.source: x.target for x in rows}
    assert abs(sum(goals.values()) - 1.5 * 9000) < 1e-3 and abs(sum(x.taken for x in rows) - 1.5 * 9000) <= 1500


def test_language_model_counts_and_scores(spark):
    r = random.Random(6)
    vocabulary = ["w%d" % k for k in range(300)]
    texts = [None, "", "A a"] + [" ".join(r.choice(vocabulary) for _ in range(r.randrange(1, 60))) for _ in range(150)]
    n = Counter()
    for d, t in enumerate(texts):
        if zlib.crc32(str(d).encode()) % 7 != 2:
            n.update((t or "").encode().lower().split())
            n["END"] += 1
    total, distinct = sum(n.values()), len(n)
    rows = language_model.held_out_scores(table(spark, texts)).collect()
    for x in rows:
        w = (texts[x.doc_id] or "").encode().lower().split() + ["END"]
        assert (x.n_tokens, x.n_known, x.train_tokens) == (len(w), sum(n[t] > 0 for t in w), total)
        assert abs(x.base_score - sum(math.log10((n[t] + 1) / (total + distinct + 1)) for t in w)) < 1e-5
        assert x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 7 == 2) and x.score < 0


def test_language_model_trains_on_every_text(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(language_model, "START_DOCS", 2)
    read, run = [], language_model.trained
    monkeypatch.setattr(language_model, "trained", lambda texts, model, keys: read.append(run(texts, model, keys)))
    texts = [" ".join("w%d" % ((k + j) % 20) for j in range(40)) for k in range(300)] + [None, ""]
    row = language_model.score(table(spark, texts), table(spark, texts)).first()
    assert sum(read) == row.train_tokens == 300 * 41 + 2
    model, ids = language_model.Model(3), np.tile([1, 2, 0], 1000)
    before = model.score(ids, np.array([0, 3000]))
    keys = language_model.hashes(language_model.pa.array(["a b"]))[0]
    assert run(spark.createDataFrame([("a b",)] * 1000, "text string"), model, keys) == 3000
    assert model.score(ids, np.array([0, 3000])) > before


def test_language_model_is_a_distribution():
    import numpy as np

    model = language_model.Model(130)
    h = np.random.default_rng(1).standard_normal((1, language_model.HIDDEN)).astype(np.float32)
    ids = np.arange(131)
    assert abs(np.exp(model.output(np.repeat(h, 131, axis=0), ids)).sum() - 1) < 1e-5


def test_language_model_output_gradients():
    import numpy as np

    rng = np.random.default_rng(3)
    model = language_model.Model(30)
    model.p = {k: rng.standard_normal(v.shape) * 0.5 for k, v in model.p.items()}
    h, y = rng.standard_normal((40, language_model.HIDDEN)), rng.integers(0, 31, 40)
    grads = {k: np.zeros_like(v) for k, v in model.p.items()}
    _, dh = model.output(h, y, grads)
    for target, grad, at in [(h, dh, (3, 5)), (h, dh, (20, 0))] + [(model.p[k], grads[k], at) for k, at in (("c", (2, 3)), ("c", (1, 6)), ("cb", (4,)), ("w", (17, 2)), ("w", (2, 1)), ("wb", (10,)))]:
        old, value = target[at], []
        for e in (1e-5, -1e-5):
            target[at] = old + e
            value.append(model.output(h, y).sum())
        target[at] = old
        assert abs((value[0] - value[1]) / 2e-5 - grad[at]) < 1e-4


def test_commonest_tokens_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(language_model, "COUNTED", 500)
    counts = spark.range(3000).select(F.col("id").alias("token"), F.when(F.col("id") < 100, 50 + F.col("id")).otherwise(1).alias("n"))
    rows = language_model._commonest(counts).collect()
    assert {x.token for x in rows} >= set(range(100)) and 430 <= len(rows) <= 570
    monkeypatch.setattr(language_model, "START_CHARS", 50)
    text = " ".join("word%03d" % k for k in range(200))
    docs = table(spark, [text] * 20 + ["short one", None, ""])
    got = [x.text for x in language_model._pieces(docs, "doc_id", "text").collect()]
    assert len(got) == 21 and len(set(got)) > 10 and all(x in text or x == "short one" for x in got) and all(len(w) == 7 for x in got if x != "short one" for w in x.split())


def test_language_model_gradients():
    import numpy as np

    from terrasift.llm.gru import backward, forward

    rng = np.random.default_rng(2)
    x, u, h = rng.standard_normal((4, 3, 6)), rng.standard_normal((2, 6)), np.zeros((3, 2))
    mask = rng.random((4, 3)) < 0.7
    g = rng.standard_normal((4, 3, 2))
    states, tape = forward(x, u, h, mask, keep=True)
    dx, du = backward(g, tape, u, mask)
    for target, grad, at in ((x, dx, (1, 2, 3)), (u, du, (1, 4)), (x, dx, (0, 0, 0)), (u, du, (0, 1))):
        old = target[at]
        value = []
        for e in (1e-3, -1e-3):
            target[at] = old + e
            value.append(float((forward(x, u, h, mask) * g).sum()))
        target[at] = old
        assert abs((value[0] - value[1]) / 2e-3 - grad[at]) < 2e-2


def test_quality_toxicity_and_language_on_marked_texts(spark):
    r = random.Random(7)
    en, de = ["the", "and", "thing", "house", "water", "light"], ["der", "und", "nicht", "licht", "wasser", "haus"]
    texts, quality, toxic, lang = [None, ""], [1, 1], [0, 0], [None, "en"]
    for k in range(240):
        w = [r.choice(en if k % 2 else de) + r.choice(["", "s", "er", "en"]) for _ in range(r.randrange(30, 120))]
        bad, rude = k % 5 == 0, k % 4 == 0
        if rude:
            w[r.randrange(len(w))] = r.choice(["idiot", "scum!"])
        texts.append(" ".join(x + "***" if bad else x for x in w))
        quality.append(0 if bad else 1)
        toxic.append(1 if rude else 0)
        lang.append("en" if k % 2 else "de")
    docs = spark.createDataFrame([(d, t, g, "s", 0) for d, (t, g) in enumerate(zip(texts, lang))], SCHEMA)
    labels = spark.createDataFrame([(d, q, x) for d, (q, x) in enumerate(zip(quality, toxic))] + [(5, None, None)], "doc_id long, quality int, toxic int")
    q = {x.doc_id: x for x in quality_model.held_out_scores(docs, labels).collect()}
    t = {x.doc_id: x for x in toxicity.held_out_scores(docs, labels).collect()}
    g = {x.doc_id: x for x in language_id.held_out_predictions(docs).collect()}
    assert len(q) == len(t) == len(g) == len(texts)
    held = [d for d in range(2, len(texts)) if q[d].held_out]
    assert sum(q[d].predicted == quality[d] for d in held) >= 0.9 * len(held)
    assert sum(t[d].predicted == toxic[d] for d in held) >= 0.85 * len(held)
    assert sum(g[d].lang_pred == lang[d] for d in range(2, len(texts))) >= 0.95 * (len(texts) - 2)
    assert g[0].lang_pred == g[1].lang_pred == "und" and all(0 <= x.score <= 1 for m in (q, t, g) for x in m.values())


def test_languages_are_learned_from_whole_texts(spark):
    r, head = random.Random(9), "shared boilerplate at the head of any document " * 10
    words = {x: ["".join(r.choice(x) for _ in range(6)) for _ in range(40)] for x in ("abcdef", "uvwxyz")}
    body = lambda x, n: " ".join(r.choice(words[x]) for _ in range(n))
    rows = [(k, head + body(x, 400), x) for k, x in enumerate(sorted(words) * 20)]
    raw = language_id.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert all(len(v) <= language_id.DICTIONARY for v in raw.values())
    docs = spark.createDataFrame([(k, body(x, 50), x) for k, x in enumerate(sorted(words) * 5)], "doc_id long, text string, lang string")
    want = {x.doc_id: x.lang for x in docs.collect()}
    assert {x.doc_id: x.lang_pred for x in language_id.predict(docs, raw).collect()} == want


def test_scores_without_labels(spark):
    docs, none = table(spark, ["a b", None]), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {x.score for x in quality_model.held_out_scores(docs, none).collect()} == {0.5}
    assert {x.score for x in toxicity.held_out_scores(docs, none).collect()} == {0.0}
    assert {x.lang_pred for x in language_id.held_out_predictions(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    for f in (quality_model, toxicity):
        assert f.held_out_scores(docs.limit(0), none).collect() == []


def test_duplicate_free_statistics_of_nothing():
    import pyarrow as pa

    x = quality_model.statistics(pa.array([None, "", "a"], pa.string()))
    assert x.shape == (3, len(quality_model.NAMES)) and (x[0] == x[1]).all()


def test_lines_of_a_common_phrase_meet_by_rare_words(spark):
    """400 lines share thirty words, pairs of them every second of the next ten: the only runs in common are hot, and all pairs are found."""
    from terrasift.llm import line_dedup

    phrase = " ".join("common" + chr(97 + k // 6) + chr(97 + k % 6) for k in range(30))
    name = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(4))
    own = lambda d, j: name((d // 2 * 10 + j if j % 2 else 200_000 + d * 10 + j) * 7)
    docs = spark.createDataFrame([(d, phrase + " " + " ".join(own(d, j) for j in range(10))) for d in range(400)], "doc_id long, text string")
    lost = {r.doc_id for r in line_dedup.dropped(docs).collect()}
    assert lost == set(range(1, 400, 2))


def test_toxicity_deals_no_texts_to_choose_its_sample(spark, monkeypatch):
    """The sample is the first rows in the order of the hash, repeated rows too, and no text is shuffled by a join, however many labels there are."""
    import pyarrow as pa
    from pyspark.sql.classic.dataframe import DataFrame

    plans, real, before = [], DataFrame.toArrow, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: (plans.append(self._jdf.queryExecution().executedPlan().toString()), real(self))[1])
    monkeypatch.setattr(toxicity, "TRAIN_CLEAN", 20)
    monkeypatch.setattr(toxicity, "TRAIN_TOXIC", 7)
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 30)
    rows = [(k // 2 if k < 40 else k, "x" * 40 if k % 9 == 0 else None if k % 7 == 0 else f"text {k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 3 % 2) for k in range(200)] + [(3, None), (5, 0), (5, 1), (7, 4)], "doc_id long, toxic int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts, y = toxicity.sample(docs, labels, "toxic")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    order = {r.k: r.o for r in spark.range(200).select(F.col("id").alias("k"), F.xxhash64("id").alias("o")).collect()}
    known = {(k, k % 3 % 2) for k in range(200)} | {(5, 0), (5, 1)}
    want = []
    for kind, n in ((0, 20), (1, 7)):
        own = sorted(((order[d], d, t or "", t) for d, t in rows if (d, kind) in known and len(t or "") <= 30), key=lambda x: x[:3])[:n]
        want += sorted(own, key=lambda x: (x[0], x[1], x[3] is None, x[2]))  # nulls are chosen first and stand last
    assert texts.to_pylist() == [x[3] for x in want] and list(y) == [0] * 20 + [1] * 7 and isinstance(texts, pa.Array)
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)


def test_lines_that_met_are_not_paired_again(spark, monkeypatch):
    """Unlike lines that share a run in twos and threes are done once compared to the least and greatest of a key; near copies in larger groups are found."""
    rests, real = [], line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda df, label: (made := real(df, label), rests.append(made.groupBy("bucket").count().collect()) if label == "line-rest" else None)[0])
    r = random.Random(12)
    vocabulary, texts, lost = letters(r, 20_000), [], set()
    own = lambda n: r.sample(vocabulary, n)
    for size in [2] * 20 + [3] * 20 + [6] * 10:
        run = own(6)
        group = [own(5) + run + own(5) for _ in range(size)]
        if size == 6:
            group.append(edited_line(r, group[3], 2, vocabulary))
        texts += [" ".join(w) for w in group]
        lost |= {len(texts) - 1} if size == 6 else set()
    assert {x.doc_id for x in line_dedup.dropped(table(spark, texts)).collect()} == lost
    assert rests and all(x["count"] > 3 for found in rests for x in found)


def test_keys_of_some_hundred_lines_are_compared_in_pairs(spark, monkeypatch):
    """300 unlike lines around one run are compared in its bucket: dealing each by its words costs many times that. Only lines of pairs are coded."""
    made, real = {}, line_dedup.cut
    monkeypatch.setattr(line_dedup, "cut", lambda df, label: (out := real(df, label), made.setdefault(label, []).append(out.count()))[0])
    r = random.Random(21)
    vocabulary = letters(r, 20_000)
    own = lambda n: r.sample(vocabulary, n)
    run = own(6)
    words = [own(10) + run + own(10) for _ in range(300)]
    words += [edited_line(r, words[k], 2, vocabulary) for k in (7, 150)]
    assert {x.doc_id for x in line_dedup.dropped(table(spark, [" ".join(w) for w in words])).collect()} == {300, 301}
    assert "line-hot-words" not in made and made["line-texts"] == [302] and sum(made["line-coded"]) <= 8


def test_unlike_lines_of_a_key_make_no_pairs(spark, monkeypatch):
    """Lines that share a run by chance leave where their bucket is read: pairs are joined to components and compared only if sizes and parities allow a link."""
    pairs, real = {}, line_dedup.cut

    def counted(df, label):
        made = real(df, label)
        if label in ("line-least", "line-near", "line-sized"):
            pairs.setdefault(label, []).append(made.count())
        return made

    monkeypatch.setattr(line_dedup, "cut", counted)
    monkeypatch.setattr(common, "cut", counted)
    r = random.Random(15)
    vocabulary, texts = letters(r, 20_000), []
    own = lambda n: r.sample(vocabulary, n)
    for size in (10, 40):  # alike in size, and not
        for _ in range(30):
            run = own(6)
            texts += [" ".join(own(10) + run + own(10)), " ".join(own(size) + run + own(10))]
    base = own(30)
    texts += [" ".join(base), " ".join(edited_line(r, base, 2, vocabulary))]
    assert {x.doc_id for x in line_dedup.dropped(table(spark, texts)).collect()} == {len(texts) - 1}
    assert pairs["line-least"] == [1] and max(pairs["line-near"]) == 1
    assert 0 < pairs["line-sized"][0] <= 30 * 3 + 30  # keys of the thirty pairs of like size and of the linked one


def test_likely_rows_hold_all_that_match(spark):
    """A bitmap leaves out no row whose hash is among the keys, negative ones and a bounded bitmap included, and few of the others."""
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("h"))
    keys = rows.where("id % 10 = 3").select("h")
    got = {x.id for x in common.likely(rows, keys, "h").collect()}
    assert {x for x in range(20_000) if x % 10 == 3} <= got and len(got) < 2000 + 0.15 * 18_000
    assert {x for x in range(20_000) if x % 10 == 3} <= {x.id for x in common.likely(rows, keys, "h", most=1 << 15).collect()}
    assert common.likely(rows, keys.limit(0), "h").collect() == []
