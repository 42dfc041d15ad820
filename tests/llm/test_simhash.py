import re

import xxhash

from millrace.llm import simhash
from millrace.llm.queries import queries
from millrace.llm.shared import components, table

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    """Smallest reachable id, by comparing all pairs."""
    ids = sorted(prints)
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    for k, a in enumerate(ids):
        for b in ids[:k]:
            if bin(prints[a] ^ prints[b]).count("1") <= distance:
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def compare(rows, texts):
    prints = {d: fingerprint(t) for d, t in texts.items()}
    want = groups(prints, 2)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {d: (f"{prints[d]:016x}", want[d]) for d in prints}


def test_query_against_brute_force(spark):
    compare(queries()["op9_simhash"](spark, SF).collect(), {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()})


def test_odd_texts(docs_of, words):
    base = words(400, 1)
    texts = [None, "", " \t\n", "One", "one", "one two", "Ä ä", "x\x0by z", base, base.upper(), base + " more", words(70_000, 5), "one two\x1cthree four", "a b c"]
    compare(simhash.near_duplicates(docs_of(texts)).collect(), dict(enumerate(texts)))


def test_chains_are_one_component(spark):
    """Fingerprints two bits apart from the next, far from the rest, linked end to end."""
    chain = [sum(3 << 2 * k for k in range(n)) for n in range(30)]
    signed = [c - (1 << 64) if c >> 63 else c for c in chain]
    prints = spark.createDataFrame([(c,) for c in signed] + [(0x5555 << 40,)], "print long")
    member = {r["node"]: r["component"] for r in components(simhash.links(prints), "test").collect()}
    assert set(member) == set(signed) and len(set(member.values())) == 1


def test_links_against_all_pairs(spark):
    import random

    rng = random.Random(4)
    near = [rng.getrandbits(63) for _ in range(20)]
    near += [n ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) ^ (rng.random() < 0.5) << rng.randrange(63) for n in near for _ in range(8)]
    prints = spark.createDataFrame([(n,) for n in near], "print long")
    member = {r["node"]: r["component"] for r in components(simhash.links(prints), "test").collect()}
    want = groups({n: n for n in set(near)}, 2)
    assert all(member.get(n, n) == c for n, c in want.items())


def test_components_of_a_star_and_a_path(spark):
    edges = [(7, i) for i in range(100, 400)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5), (399, 3), (3, 399)]
    member = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(member[i] == 3 for i in (3, 7, *range(100, 400)))
    assert all(member[i] == 1000 for i in range(1000, 1201)) and 5 not in member


def test_one_per_group(docs_of, words):
    base, other = words(300, 1), words(300, 2)
    rows = [(5, base, "a"), (3, base, "b"), (3, base, "b"), (9, other, "a"), (None, base, "a"), (None, "lone text", "a"), (None, "lone text", "a"), (1, None, "a"), (2, "", None)]
    docs = docs_of(rows)
    kept = simhash.one_per_group(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in kept.collect()), key=str) == sorted([(3, base), (9, other), (0, "lone text"), (1, None)], key=str)


def test_empty_table(docs_of):
    assert simhash.near_duplicates(docs_of([])).collect() == []
    assert simhash.one_per_group(docs_of([])).collect() == []
