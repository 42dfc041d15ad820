import re

import pytest

from compare import connect, difference
from millrace.llm import mixing
from millrace.llm.queries import oracles, queries

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    assert difference(queries()["op1_pareto_mix"](spark, SF), connect(SF), oracles()["op1_pareto_mix"]) is None


def fill(sizes):
    """Weights dealt out and excess shared anew until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = dict(zip(order, [3, 1, 2] * len(order)))
    total, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return share | stopped
        stopped |= {s: 2.0 * sizes[s] for s in over}


def test_targets_and_sample(docs_of, words):
    rows = [(i, words(5 + i % 90, i), f"s{i % 5}") for i in range(400)]
    rows += [(1000 + i, words(300, i), None) for i in range(3)] + [(2000, None, "s0"), (2001, "  ", "empty")]
    got = mixing.mix(docs_of(rows)).collect()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = fill(sizes)
    assert len(got) == len(rows)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["source_size"] == sizes[r["source"]]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    for source in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == source)
        assert abs(taken - want[source]) <= max(r["size"] for r in got if r["source"] == source) / 2


def test_reruns_and_partitionings_agree(docs_of, words):
    docs = docs_of([(i, words(20 + i % 7, i), f"s{i % 3}") for i in range(200)])
    one = sorted(map(tuple, mixing.mix(docs).collect()))
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(13)).collect()))


def test_short_documents_are_drawn_less_often(docs_of, words):
    rows = [(i, words(200 if i % 2 else 4, i), "a") for i in range(600)]
    got = mixing.mix(docs_of(rows), total_percent=50).collect()
    drawn = {n: sum(r["taken"] > 0 for r in got if r["size"] == n) for n in (4, 200)}
    assert drawn[4] < 0.6 * drawn[200]


def test_edges(docs_of, words):
    assert mixing.mix(docs_of([])).collect() == []
    lone = mixing.mix(docs_of([(None, None, None)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in lone] == [(0, 0.0, 0)]
    twice = mixing.mix(docs_of([(1, "a b", "s"), (1, "a b", "s"), (None, "a b", "s")])).collect()
    assert len(twice) == 3 and twice[0]["source_size"] == 6


def test_mixed_documents_keep_columns_and_repeat(docs_of, words):
    docs = docs_of([(i, words(30 + i % 5, i), f"s{i % 2}") for i in range(100)])
    mixed = mixing.mixed_documents(docs)
    assert mixed.schema.simpleString() == docs.schema.simpleString()
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    got = {}
    for r in mixed.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: c for d, c in want.items() if c}
