"""The corpus pipeline against a brute-force version, and tool-call linking."""

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from terrasift.llm import quality_model, tool_calls
from tests.llm.test_text_operators import brute_hits
from tests.llm.test_words_and_minhash import SCHEMA, brute


def normal(line):
    return " ".join(re.findall(r"[^\W_]+", re.sub("[0-9]", "0", line.lower())))


def fixture(spark, folder):
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    line = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, line(20)) for k in range(6)]
    shared = [line(60) for _ in range(4)]
    rows, quality = [], []
    for k in range(160):
        body = [line(r.randrange(12, 40)) for _ in range(r.randrange(2, 5))]
        if k % 6 == 0:
            body.insert(1, r.choice(shared))
        if k % 11 == 0:
            body.append(items[k % 6][1])
        if k % 13 == 5:
            body = rows[k - 3][1].split("\n")
        bad = k % 8 == 3
        text = "\n".join(body)
        rows.append((k, " ".join(w + "***" for w in text.split()) if bad else text, "en", f"s{k % 5}", 0))
        quality.append((k, 0 if bad else 1, 0))
    rows += [(900, None, None, None, None), (901, "", "en", None, 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(quality, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def test_run_equals_brute_force(spark, tmp_path):
    rows, items = fixture(spark, str(tmp_path))
    scores = quality_model.held_out_scores(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    good = {x.doc_id for x in scores.where("predicted = 1").collect()}
    assert len([k for k in good if k < 160]) >= 135
    texts = {d: t for d, t, *_ in rows if d in good}
    seen, out = set(), {}
    for d in sorted(texts):
        kept, lost = [], False
        for x in (texts[d].split("\n") if texts[d] is not None else []):
            n = normal(x)
            if n and n in seen:
                lost = True
            else:
                seen.add(n)
                kept.append(x)
        if not lost or "".join(kept).strip():
            out[d] = "\n".join(kept) if lost else texts[d]
    ids = sorted(out)
    _, comp = brute([out[d] for d in ids], 5)
    out = {d: out[d] for k, d in enumerate(ids) if comp[k] == k}
    clean = {d for d, t in out.items() if not (brute_hits(t, items)[1] and 20 * brute_hits(t, items)[1] >= brute_hits(t, items)[0])}
    assert len(clean) < len(out) < len(texts)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x.doc_id for x in got} == clean
    assert all(x["size"] == len((out[x.doc_id] or "").split()) for x in got)
    assert all(x.taken <= 2 * x["size"] for x in got) and abs(sum(x.taken for x in got) - 1.5 * sum(x["size"] for x in got)) <= 6


def test_stages_keep_the_columns(spark, tmp_path):
    fixture(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("gone", F.lit(1)).withColumn("comp", F.lit("x"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []


CALLS = "conv_id long, call_id string, turn long, index int, name string, arguments string, depends_on array<string>"
SCHEMAS = {"f": {"type": "object", "required": ["x"], "additionalProperties": False, "properties": {"x": {"type": "integer", "minimum": 0}, "tags": {"type": "array", "items": {"enum": ["a", "b"]}}}}}


def test_links_validation_and_canonical_json(spark):
    calls = spark.createDataFrame([
        (1, "a", 0, 0, "f", '{"tags":["b","a"], "x": 1}', []), (1, "b", 2, 0, "f", '{"x":-1}', ["a"]), (1, "c", 4, 0, "f", "not json", []), (1, "d", 4, 1, "f", '{"x":1,"y":2}', []),
        (1, "e", 6, 0, "g", "{}", []), (1, None, 8, 0, "f", None, None), (2, "a", 0, 0, "f", '{"x":true,"tags":["z"]}', []),
    ], CALLS)
    results = spark.createDataFrame([(1, "a", 1, "é"), (1, "a", 1, "later"), (1, "zz", 9, "orphan")], "conv_id long, call_id string, turn long, content string")
    rows = {(x.conv_id, x.call_id): x for x in tool_calls.link(calls, results, SCHEMAS).collect()}
    a = rows[1, "a"]
    assert (a.status, a.valid, a.json) == ("linked", True, '{"arguments":{"tags":["b","a"],"x":1},"id":"a","name":"f","result":"later"}')
    assert rows[1, "b"].error == "$.x: too small" and rows[1, "c"].error == "arguments are not JSON" and rows[1, "d"].error == "$.y: not allowed"
    assert rows[1, "e"].error == "no schema for g" and rows[1, "zz"].status == "no_call" and rows[1, None].valid is False
    assert rows[2, "a"].status == "no_result" and rows[2, "a"].error == "$.tags[0]: not in enum"


def test_calls_move_behind_what_they_wait_for(spark):
    calls = spark.createDataFrame([
        (1, "a", 0, 0, "f", "{}", ["c"]), (1, "b", 1, 0, "f", "{}", ["a"]), (1, "c", 5, 0, "f", "{}", []), (1, "d", 6, 0, "f", "{}", ["b", "nobody"]),
        (2, "x", 0, 0, "f", "{}", ["y"]), (2, "y", 1, 0, "f", "{}", ["z"]), (2, "z", 2, 0, "f", "{}", ["x"]), (2, "w", 3, 0, "f", "{}", ["w"]),
    ], CALLS)
    rows = {(x.conv_id, x.call_id): x for x in tool_calls.placed(calls).collect()}
    order = sorted("abcd", key=lambda k: (rows[1, k].place_turn, rows[1, k].place_index, rows[1, k].hops, rows[1, k].turn))
    assert order == ["c", "a", "b", "d"] and not any(rows[1, k].cycle for k in "abcd")
    assert all(rows[2, k].cycle and (rows[2, k].place_turn, rows[2, k].hops) == (t, 0) for t, k in enumerate("xyz")) and rows[2, "w"].cycle


def brute_places(own, edges):
    """Places by relaxation, cycles by reachability."""
    reach = {x: set(edges.get(x, ())) for x in own}
    for _ in own:
        reach = {x: r.union(*(reach[y] for y in r)) for x, r in reach.items()}
    ring = {x for x in own if x in reach[x]}
    place = {x: (*own[x], 0) for x in own}
    for _ in own:
        place = {x: max([(*own[x], 0)] + [(*place[y][:2], place[y][2] + 1) for y in (edges.get(x, ()) if x not in ring else ())]) for x in own}
    return {x: (*place[x], x in ring) for x in own}


@pytest.mark.parametrize("alone", [200_000, 0])
def test_orders_of_random_graphs_equal_brute_force(spark, monkeypatch, alone):
    monkeypatch.setattr(tool_calls, "ALONE", alone)
    r, rows, want = random.Random(12), [], {}
    fed = {0: [1, 2], 1: [0], 2: []}  # a cycle that also waits for a later call outside it
    chain = {k: [k + 1] for k in range(12)} | {12: []}
    for conv in range(6 if alone == 0 else 40):
        n = r.randrange(2, 9)
        edges = fed if conv == 0 else chain if conv == 1 else {k: [r.randrange(n) for _ in range(r.choice([0, 1, 1, 2]))] for k in range(n)}
        own = {k: (r.randrange(6) if conv else k + 1, k) for k in edges}
        rows += [(conv, f"c{k}", own[k][0], own[k][1], "f", "{}", [f"c{d}" for d in edges[k]] + [None, "nobody"]) for k in edges]
        want |= {(conv, f"c{k}"): v for k, v in brute_places(own, edges).items()}
    got = {(x.conv_id, x.call_id): (x.place_turn, x.place_index, x.hops, x.cycle) for x in tool_calls.placed(spark.createDataFrame(rows, CALLS).withColumn("_call", F.lit("x"))).collect()}
    assert got == want and sum(v[3] for v in want.values()) > 2


def test_arguments_that_break_parsers(spark):
    arguments = ['{"x": NaN}', '{"x": 1e999}', '{"x": ' + "[" * 200_000 + "]" * 200_000 + "}", '{"x": "\\\\ud800"}'.replace("\\\\", "\\"), '{"x": 1, "x": 2}', "[1]", None, ""]
    calls = spark.createDataFrame([(1, f"c{k}", k, 0, "h" if k == 3 else "f", a, None) for k, a in enumerate(arguments)], CALLS)
    rows = {x.call_id: x for x in tool_calls.link(calls, calls.select("conv_id", "call_id", "turn", F.lit("r").alias("content")).limit(0), SCHEMAS | {"h": {"properties": {"x": {"type": "odd"}}}}).collect()}
    assert [rows[f"c{k}"].valid for k in range(8)] == [False, False, False, False, True, False, False, False]
    assert rows["c2"].error == "arguments are nested too deeply" and '"x":"\\ud800"' in rows["c3"].json and rows["c0"].error == "arguments are not JSON"


def test_the_order_query_equals_its_sql(spark):
    import duckdb

    from terrasift.llm import registry

    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    df = registry.queries()["op1_tool_calls"](spark, "/root/testdata/sf0.001")
    rows = df.collect()
    sql = con.sql(registry.oracle_sql()["op1_tool_calls"]).project(", ".join(df.columns)).fetchall()
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, sql)) and any(x.hops for x in rows) and any(x.cycle for x in rows)


@pytest.mark.parametrize("name", ["op2_golden_mix", "op10_rule_projection"])
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from terrasift.llm import registry

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    df = registry.queries()[name](spark, "/root/testdata/sf0.001")
    sql = con.sql(registry.oracle_sql()[name]).project(", ".join(df.columns)).fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, sql)) and len(sql) >= 100


def test_null_identifiers_stay_beside_a_late_dependency(spark):
    calls = spark.createDataFrame([(1, "a", 0, 0, "f", "{}", ["c"]), (1, "c", 5, 0, "f", "{}", []), (1, None, 3, 1, "f", "{}", ["a"]), (None, "n", 4, 0, "f", "{}", None)], CALLS)
    rows = {(x.conv_id, x.call_id): x for x in tool_calls.placed(calls).collect()}
    assert len(rows) == 4 and rows[1, "a"].place_turn == 5
    for k, at in (((1, None), (3, 1)), ((None, "n"), (4, 0))):
        assert (rows[k].place_turn, rows[k].place_index, rows[k].hops, rows[k].cycle) == (*at, 0, False)


def test_tool_calls_of_nothing(spark):
    calls, results = tool_calls.conversation_calls(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    assert tool_calls.link(calls, results, {"reply": tool_calls.REPLY}).collect() == []
