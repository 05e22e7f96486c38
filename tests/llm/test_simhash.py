import numpy as np
import pytest
from plain import groups, near_groups, signed, simhash

from regline.llm import simhash as op
from regline.llm.graph import components


def dense(seed=5, clusters=4, members=120, alone=200):
    """Fingerprints in tight clusters, and some on their own."""
    rng = np.random.default_rng(seed)
    out = [int(x) for x in rng.integers(0, 1 << 63, alone)]
    for base in rng.integers(0, 1 << 63, clusters):
        for _ in range(members):
            x = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(bit)
            out.append(x)
    return sorted(set(out))


def test_fingerprints():
    texts = ["", " \t\n", "one", "One TWO three", "a b c d", "a b c d e " * 30, "É é x y\x0bz w", "a\x1cb c d e f", "x " * 70_000]
    assert [op.fingerprint_of(t) for t in texts] == [signed(simhash(t)) for t in texts]
    assert op.fingerprint_of("") == 0


def test_own_bit_is_one_of_the_shared_keys():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x = 0
        for bit in rng.integers(0, 64, rng.integers(1, 5)):
            x |= 1 << int(bit)
        own = int(op.own_bit(np.array([x], np.uint64))[0])
        first, width = next((f, w) for f, w in op.SEGMENTS if f <= own < f + w)
        assert (x >> first & (1 << width) - 1) & ~(1 << own - first) == 0


@pytest.mark.parametrize("neighbours,chunk", [(op.NEIGHBOURS, op.CHUNK), (2, 300)])
def test_components_equal_brute_force(spark, neighbours, chunk):
    fps = dense()
    found = op.linked_components(spark.createDataFrame([(signed(x),) for x in fps], "fp bigint"), neighbours, chunk).collect()
    comp = {r.fp: r.comp for r in found}
    want = near_groups(fps)
    assert len(found) == len(fps) > len(set(want))
    pairs = {(comp[signed(x)], want[i]) for i, x in enumerate(fps)}
    assert len(pairs) == len(set(want)) == len({c for c, _ in pairs})


TEXTS = [
    (4, "the quick brown fox jumps over the lazy dog again and again " * 8), (9, "The quick brown fox jumps over the lazy dog again and again " * 8),
    (2, None), (7, ""), (5, "\n"), (1, "entirely different words stand in this text"), (1, "entirely different words stand in this text"),
    (None, "someone without an id wrote this one"), (None, None), (3, "w" + " x" * 30_000),
]


def test_documents_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in TEXTS], "doc_id bigint, text string, fp int, component_id string")
    found = op.near_duplicates(docs).collect()
    fps = [simhash(t) for _, t in TEXTS]
    roots = near_groups(fps)
    least = {r: min((i for (i, _), q in zip(TEXTS, roots) if q == r and i is not None), default=None) for r in roots}
    want = sorted((str(i), signed(fp), str(least[r])) for (i, _), fp, r in zip(TEXTS, fps, roots))
    assert sorted((str(r.id), r.fp, str(r.component_id)) for r in found) == want
    kept = op.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least.values()))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.near_duplicates(docs).count() == op.keep_one_each(docs).count() == 0


def test_components_of_chains_stars_and_loops(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 160)] + [(500, 500), (None, 3)]
    edges += [(int(a), int(b)) for a, b in rng.integers(1000, 1100, (70, 2))] + [(1000, 1001)] * 5
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    near = [(a, b) for a, b in edges if None not in (a, b)]
    nodes = sorted({x for e in near for x in e})
    place = {x: i for i, x in enumerate(nodes)}
    beside = {i: [] for i in range(len(nodes))}
    for a, b in near:
        beside[min(place[a], place[b])].append(max(place[a], place[b]))
    roots = groups(len(nodes), beside.get)
    assert found == {x: nodes[r] for x, r in zip(nodes, roots) if nodes[r] != x}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
