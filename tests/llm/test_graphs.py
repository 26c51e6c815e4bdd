import math

import numpy as np

from tallyroom.llm import graphs


def slow(vectors, queries, k=5):
    ids, data = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for q, v in queries:
        score = graphs.cosine(np.array(v, float)[None, :], data)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_recall_and_exact_scores(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    queries = [x for x in vectors if x[0] % 50 == 0]
    expected = slow(vectors, queries)
    index = graphs.build_index(frame, shard_rows=700)
    rows = graphs.search(index, frame.where("vec_id % 50 = 0")).collect()
    assert len(rows) == 5 * len(queries)
    hits = 0
    for r in rows:
        truth = dict(expected[r["query_id"]])
        hits += r["vec_id"] in truth
        if r["vec_id"] in truth:
            assert math.isclose(r["score"], truth[r["vec_id"]], rel_tol=1e-12)
        assert r["vec_id"] != r["query_id"]
    assert hits >= 0.9 * len(rows)
    by_query = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert all(v == sorted(v) for v in by_query.values())


def test_ties_hot_vectors_and_unusable_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(200)] + [(300 + i, [float(i), 1.0, -2.0]) for i in range(40)]
    rows += [(500, None), (501, [0.0, 0.0, 0.0]), (502, [1.0, None, 2.0]), (503, [float("nan"), 1.0, 1.0]), (504, [float("inf"), 1.0, 1.0]),
             (None, same), (505, []), (506, [1.0, 2.0]), (507, [2.0, 4.0]), (508, [1e-30, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as shard", "2 as rank")
    index = graphs.build_index(frame, shard_rows=60)
    asked = frame.where("vec_id in (0, 5, 199, 500, 501, 506) or vec_id is null")
    out = {}
    for r in graphs.search(index, asked).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 12)))
    out = {q: sorted(v) for q, v in out.items()}
    assert set(out) == {0, 5, 199, 506}
    assert [v for _, v, _ in out[0]] == [1, 2, 3, 4, 5]
    assert [v for _, v, _ in out[5]] == [0, 1, 2, 3, 4]
    assert out[506] == [(1, 507, 1.0)]
    assert graphs.search(index, frame.limit(0)).count() == 0
    assert graphs.search(graphs.build_index(frame.limit(0)), asked).count() == 0


def test_pruning_keeps_diverse_edges():
    unit = graphs._unit(np.array([[1, 0], [1, 0.1], [1, 0.11], [1, -0.3], [0, 1]], float))
    graph = graphs.Graph(unit, 3)
    kept = graph.prune(np.array([0]), np.array([[1, 2, 3, 4, 0, 1]]), 1.2)[0]
    assert kept.tolist()[:2] == [1, 3] and 2 not in kept and 0 not in kept
