import numpy as np
import pytest

from admitflow.llm import neighbours

KIND = "vec_id long, embedding array<float>, vector string, list string, score string"


def brute(ids, vectors, every, k):
    found = {}
    for query, x in zip(ids, vectors):
        if query % every == 0:
            far = np.sqrt(((vectors - x) ** 2).sum(axis=1))
            order = [i for i in np.lexsort((ids, far)) if ids[i] != query][:k]
            found[query] = [(int(ids[i]), float(far[i])) for i in order]
    return found


def asked(spark, rows, **more):
    frame = spark.createDataFrame([(i, v, "c", "c", "c") for i, v in rows], KIND)
    found = {}
    for r in sorted(neighbours.search(spark, frame, **more).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    return found


def test_recall_on_hard_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 60)
    monkeypatch.setattr(neighbours, "PART_ROWS", 40)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(4000, 24)).astype(np.float32)
    ids = rng.permutation(4000)
    found = asked(spark, list(zip(ids.tolist(), vectors.tolist())), every=40)
    expected = brute(ids, vectors.astype(float), 40, 10)
    assert found.keys() == expected.keys()
    recalls = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 10 for q in expected]
    assert np.mean(recalls) >= 0.95 and np.mean(np.array(recalls) < 0.5) <= 0.05
    for q, rows in found.items():
        assert all(s == pytest.approx(dict(expected[q]).get(i, s), abs=1e-12) for i, s in rows)


def test_equal_vectors_bad_vectors_and_few_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300, [1.0, 2.5]), (400, [0.0, 0.0]), (500, None)]
    rows += [(600, [1.0, None]), (700, [1.0, float("nan")]), (800, [float("inf"), 1.0]), (None, [1.0, 2.0])]
    rows += [(900, [1.0, 2.0, 3.0]), (100, [1.0, 2.0])]
    found = asked(spark, rows)
    assert found.keys() == {0, 100, 200, 300}
    assert found[0] == [(i, 0.0) for i in range(1, 11)]
    assert found[100] == found[200] == [(i, 0.0) for i in range(10)]
    assert found[300] == [(i, 0.5) for i in range(10)]
    assert asked(spark, [(0, [1.0]), (1, [2.0]), (2, [4.0])]) == {0: [(1, 1.0), (2, 3.0)]}
    assert asked(spark, [(0, [1.0])]) == {}
    assert asked(spark, []) == {}


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(6000, 8))
    graph = neighbours.CentroidGraph.build(sample, 6000 * 40)
    assert len(graph.centroids) > 400
    x = rng.normal(size=(200, 8))
    exact = np.sqrt(neighbours._squares(x, graph.centroids))
    hits = [len(set(f) & set(np.flatnonzero(e <= 1.2 * e.min()))) / (e <= 1.2 * e.min()).sum() for f, e in zip(graph.lists(x, 1.2), exact)]
    assert np.mean(hits) > 0.95


def test_an_outlier_gets_all_it_asked_for(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 60)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1501, 8))
    vectors[700] *= 1000
    ids = np.arange(1501)
    found = asked(spark, list(zip(ids.tolist(), vectors.astype(np.float32).tolist())))
    expected = brute(ids, vectors.astype(np.float32).astype(float), 100, 10)
    assert found.keys() == expected.keys() and all(len(r) == 10 for r in found.values())
    assert [i for i, _ in found[700]] == [i for i, _ in expected[700]]


def test_recall_on_clustered_vectors_in_many_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 60)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(150, 16)) * 3
    vectors = (centres[rng.integers(0, 150, 12_000)] + rng.normal(size=(12_000, 16))).astype(np.float32)
    ids = np.arange(12_000)
    found = asked(spark, list(zip(ids.tolist(), vectors.tolist())))
    expected = brute(ids, vectors.astype(float), 100, 10)
    recalls = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 10 for q in expected]
    assert np.mean(recalls) >= 0.95 and np.mean(np.array(recalls) < 0.5) <= 0.05


def test_the_ratio_follows_the_vectors():
    rng = np.random.default_rng(9)
    loose = rng.normal(size=(4000, 24))
    tight = rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)] * 20 + rng.normal(size=(4000, 24))
    ratios = [neighbours.measured_ratio(neighbours.CentroidGraph.build(x, 20_000), x, 10)[0] for x in (loose, tight)]
    assert ratios[0] > 1.1 and all(r >= 1 for r in ratios)


def test_many_queries_of_a_list_are_cut_as_well(spark, monkeypatch):
    rng = np.random.default_rng(10)
    vectors, ids = rng.normal(size=(600, 4)).astype(np.float32), np.arange(600)
    monkeypatch.setattr(neighbours, "PART_ROWS", 50)
    found = asked(spark, list(zip(ids.tolist(), vectors.tolist())), every=1, ratio=100.0)
    expected = brute(ids, vectors.astype(float), 1, 10)
    assert {q: [i for i, _ in r] for q, r in found.items()} == {q: [i for i, _ in r] for q, r in expected.items()}
