"""SimHash groups, near-duplicate and nearest vectors, components: against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.llm import collisions, graph, pivots, simhash


def _components(count, linked):
    parent = list(range(count))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(count):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(count)]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
def test_close_fingerprints_share_an_anchor(fp, flips):
    other = fp
    for bit in flips:
        other ^= 1 << bit
    rows, anchors = simhash.anchors(np.array([fp, other], np.uint64), 4)
    assert set(anchors[rows == 0]) & set(anchors[rows == 1])


@pytest.mark.parametrize("block", [4096, 3])
def test_fingerprints_link_exactly(spark, block, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_ITEMS", block)
    random = np.random.default_rng(3)
    fps = random.integers(0, 2**63, 40, dtype=np.uint64)
    for _ in range(160):
        flipped = fps[random.integers(len(fps))]
        for bit in random.integers(0, 64, random.integers(1, 7)):
            flipped ^= np.uint64(1) << np.uint64(bit)
        fps = np.append(fps, flipped)
    fps = np.unique(fps)
    signed = fps.view(np.int64).tolist()
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.component for r in graph.components(simhash.linked_fingerprints(frame)).collect()}
    roots = _components(len(fps), lambda i, j: int(fps[i] ^ fps[j]).bit_count() <= 4)
    for i in range(len(fps)):
        for j in range(i):
            same = found.get(signed[i], signed[i]) == found.get(signed[j], signed[j])
            assert same == (roots[i] == roots[j])


def test_simhash_of_odd_documents(odd_docs):
    docs, rows = odd_docs
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert {c for i in (2, 4, 9) for _, c in by_id[i]} == {2}
    assert {f for i in (2, 4, 9) for f, _ in by_id[i]} == {"0" * 16}
    assert {c for i in (5, 6) for _, c in by_id[i]} == {5}
    assert {c for _, c in by_id[7]} == {7}


def test_simhash_of_nothing(make_docs):
    assert simhash.near_duplicates(make_docs([])).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 499), (7, 7), (500, 499)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), 499: 499, 500: 499}


def _near_rows(count=240):
    random = np.random.default_rng(5)
    rows = []
    for i in range(count):
        if i % 3 and rows:
            base = np.array(rows[random.integers(len(rows))][1])
            vector = base + random.normal(0, 0.02 * (i % 5), 16) if i % 4 else base
        else:
            vector = random.normal(0, 1, 16)
        rows.append((i, np.float32(vector).tolist(), int(i % 7 == 0)))
    return rows


@pytest.mark.parametrize("block", [4096, 20])
def test_near_vectors(vectors, block, monkeypatch):
    monkeypatch.setattr(graph, "BLOCK_ITEMS", block)
    rows = _near_rows()
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, rows[0][1], None), (904, [1.0, None], 0), (905, [1.0], 0)]
    found = {r.vec_id: r for r in pivots.near_vectors(vectors(rows + odd)).collect()}
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & np.equal.outer([r[2] for r in rows], [r[2] for r in rows])
    roots = _components(len(rows), lambda i, j: near[i, j])
    total = sum(near[i].sum() - 1 for i in range(len(rows)))
    assert sum(r.n_links for r in found.values()) >= 0.98 * total
    for i in range(len(rows)):
        assert found[i].n_links <= near[i].sum() - 1
        assert found[i].component_id == roots[i] and found[i].kept == (roots[i] == i)
    for i, _, _ in odd:
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


def test_pivots_grow_with_the_square_root():
    assert [pivots.pivots_for(n) for n in (0, 10_000, 40_000, 160_000, 10**12)] == [256, 256, 500, 1000, pivots.MOST_PIVOTS]


def test_bits_of_shared_pivots():
    random = np.random.default_rng(3)
    prefix = np.stack([random.choice(300, 8, replace=False) for _ in range(150)]).astype(np.uint16)
    bits = pivots._bits(prefix, prefix > 90)
    common = np.bitwise_count(bits[:, None] & bits[None]).sum(axis=2)
    sets = [set(p[p > 90].tolist()) for p in prefix]
    assert all(common[i, j] == len(sets[i] & sets[j]) for i in range(150) for j in range(150) if i != j)
    assert not pivots._bits(prefix, prefix > 300).any()


@pytest.mark.parametrize(("count", "chosen"), [(500, 16), (2000, None), (2000, 700)])
def test_links_of_near_vectors_by_brute_force(vectors, count, chosen):
    rows = _near_rows(count)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & np.equal.outer([r[2] for r in rows], [r[2] for r in rows])
    n_links = near.sum(axis=1) - 1
    found = {r.vec_id: r.n_links for r in pivots.near_vectors(vectors(rows), pivots=chosen).collect()}
    assert len(found) == count and all(found[i] <= n for i, n in enumerate(n_links))
    assert sum(found.values()) >= 0.95 * n_links.sum() > 0


def test_vector_operators_of_nothing(vectors):
    assert pivots.near_vectors(vectors([])).count() == 0
    assert collisions.nearest(vectors([]), F.col("vec_id") % 20 == 0).count() == 0


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nearest_vectors_in_many_partitions(vectors, many_partitions):
    test_nearest_vectors(vectors, 60)


def test_nearest_of_repeated_rows(vectors, many_partitions):
    rows = [(0, [1.0, 0.0], 0)] * 3 + [(20, [0.0, 2.0], 0), (20, [0.0, 1.0], 0)] + [(i, [1.0, float(i)], 0) for i in (1, 1, 2)]
    found = collisions.nearest(vectors(rows), F.col("vec_id") % 20 == 0, k=4, shard_vectors=2).collect()
    of = {q: [(r.rank, r.vec_id, r.score) for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in (0, 20)}
    assert of[0] == [(1, 1, 1.0), (2, 1, 1.0), (3, 2, 1.0), (4, 20, 0.0)]
    assert of[20] == [(1, 2, 2.0), (2, 1, 1.0), (3, 1, 1.0), (4, 0, 0.0)]


@pytest.mark.parametrize("shard", [12_000, 60])
def test_nearest_vectors(vectors, shard):
    random = np.random.default_rng(9)
    x = np.float32(random.normal(0, 1, (400, 24)) * random.uniform(0.2, 3, (400, 1))).astype(float)
    x[5] = x[20]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(1000, None, 0), (1020, [0.0] * 24, 0), (1040, [float("inf")] * 24, 0), (None, x[0].tolist(), 0)]
    found = {}
    table = collisions.nearest(vectors(rows + odd), F.col("vec_id") % 20 == 0, shard_vectors=shard)
    for r in table.collect():
        found.setdefault(r.query_id, {})[r.rank] = r
    hits = 0
    assert set(found) == set(range(0, 400, 20))
    for q, ranked in found.items():
        assert sorted(ranked) == list(range(1, 21))
        scores = x @ x[q]
        keys = [(-ranked[k].score, ranked[k].vec_id) for k in range(1, 21)]
        assert keys == sorted(keys) and all(np.isclose(-s, scores[v]) for s, v in keys)
        best = [int(v) for v in np.lexsort((np.arange(400), -scores)) if v != q][:20]
        hits += len(set(best) & {r.vec_id for r in ranked.values()})
    assert hits >= 0.9 * 20 * len(found)


def test_fewer_candidates_than_asked_for(vectors):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.5, 0.0], 0), (3, [1.0], 0)]
    found = collisions.nearest(vectors(rows), F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]
