"""Near-duplicate vectors against brute force."""

import time

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import vectors


def rows_of(seed=1, n=700, dims=24):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((n, dims))
    near = base[:200] + draw.standard_normal((200, dims)) * 0.09
    hot = base[0] + draw.standard_normal((120, dims)) * 0.05
    same = np.repeat(base[5:6], 40, axis=0)
    every = np.concatenate([base, near, hot, same, base[9:10] * 3]).astype(np.float32)
    labels = [*(i % 4 for i in range(n)), *(i % 4 for i in range(200)), *[0] * 120, *[1] * 40, 9 % 4]
    rows = [(i, list(map(float, v)), l) for i, (v, l) in enumerate(zip(every, labels))]
    odd = [None, [0.0] * dims, [], [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    rows += [(2000 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(3000, rows[0][1], None), (3001, rows[0][1], 0)]
    return rows


def expected(rows):
    good = {}
    for i, v, l in rows:
        if v and l is not None and None not in v and np.isfinite(v).all() and np.any(v):
            good.setdefault((l, len(v)), []).append((i, np.array(v, np.float32).astype(float)))
    links, counts = [], {i: 0 for i, *_ in rows}
    for group in good.values():
        ids = [i for i, _ in group]
        x = np.stack([v / np.sqrt(v @ v) for _, v in group])
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1))):
            links.append((ids[a], ids[b]))
            counts[ids[a]] += 1
            counts[ids[b]] += 1
    return counts, brute.roots(counts, links)


def test_near_duplicate_vectors(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, rep string").repartition(6)
    found = {r.vec_id: r for r in vectors.group_vectors(df).collect()}
    counts, roots = expected(rows)
    assert set(found) == set(counts)
    total = sum(counts.values())
    hit = sum(min(counts[i], found[i].n_links) for i in counts)
    assert all(found[i].n_links <= counts[i] for i in counts)
    assert hit >= 0.95 * total
    agree = np.mean([found[i].component_id == roots[i] for i in counts])
    assert agree >= 0.97
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
    assert vectors.group_vectors(df.limit(0)).collect() == []


def test_blocks_of_a_crowded_shard(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 100)
    rows = rows_of(seed=2, n=300)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {r.vec_id: r for r in vectors.group_vectors(df).collect()}
    counts, _ = expected(rows)
    assert all(found[i].n_links <= counts[i] for i in counts)
    assert sum(found[i].n_links for i in counts) >= 0.95 * sum(counts.values())


def test_search_finds_what_is_in_range():
    draw = np.random.default_rng(3)
    x = vectors._unit(draw.standard_normal((600, 16)))
    x[300:] = vectors._unit(x[:300] + 0.03 * draw.standard_normal((300, 16)))
    graph = vectors.build_graph(x)
    assert graph.shape == (600, vectors.DEGREE) and (graph.max(1) >= 0).all()
    q, v = vectors.range_search(x, graph, np.arange(600), vectors.BEAM, 0.98)
    true = {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.98)) if a != b}
    got = {(a, b) for a, b in zip(q, v) if a != b}
    assert len(got & true) >= 0.95 * len(true)


def losing(lost):
    """``_linked`` without the numbers of links of the ``lost`` ids."""
    whole = vectors._linked

    def run(*given):
        return whole(*given).filter(~F.col("a").isin([int(i) for i in lost]))

    return run


def test_audit_sees_lost_pairs_beside_a_hot_vector(spark, monkeypatch):
    rows = rows_of()
    pairs = [i for i in range(1, 200) if i != 5 and i != 9 and i % 4 != 0]
    lost = pairs[: 2 * len(pairs) // 3]
    lost += [700 + i for i in lost]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(vectors, "_linked", losing(lost))
    monkeypatch.setattr(vectors, "AUDIT_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="recall"):
        vectors.group_vectors(df)


def test_audit_measures_where_few_vectors_have_near_copies(spark, monkeypatch):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((3000, 24))
    x[2990:] = x[:10] + 0.01 * draw.standard_normal((10, 24))
    rows = [(i, list(map(float, v)), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(vectors, "_linked", losing(range(10)))
    monkeypatch.setattr(vectors, "AUDIT_ROUNDS", 1)
    with pytest.raises(RuntimeError, match="recall"):
        vectors.group_vectors(df)


def test_audit_asks_every_twentieth_of_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(vectors, "AUDIT_ALL", 100)
    monkeypatch.setattr(vectors, "AUDIT_BYTES", 4000)
    rows = [(i, [float(i // 2), 1.0, float((i // 2) ** 2 % 7)], 0) for i in range(0, 4000, 2)]
    rows += [(i + 1, [v[0], v[1] + 1e-4, v[2]], 0) for i, v, _ in rows]
    df = spark.createDataFrame(rows, "id long, vector array<double>, label long")
    packed = df.selectExpr("id", "label", "size(vector) dims", "vector").mapInArrow(
        vectors._packed, "id long, label long, dims int, vector binary"
    )
    classes = packed.withColumnRenamed("id", "rep").withColumn("size", F.lit(1))
    truth = {r.rep: r.true for r in vectors._audited(classes, 0.98).collect()}
    assert set(truth) == set(range(0, 4000, 20))
    x = vectors._unit(np.array([v for _, v, _ in rows]))
    near = (x @ x.T >= 0.98).sum(1) - 1
    assert truth == {i: near[k] for k, (i, *_) in enumerate(rows) if i % 20 == 0}


def test_search_through_a_dense_group_takes_few_steps_and_finds_all():
    draw = np.random.default_rng(3)
    hot = draw.standard_normal(24) + draw.standard_normal((1500, 24)) * 0.05
    x = np.concatenate([hot, draw.standard_normal((1000, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = vectors.build_graph(x)
    began = time.monotonic()
    q, v = vectors.range_search(x, graph, np.arange(0, 2500, 5), vectors.BEAM, 0.98)
    assert time.monotonic() - began < 20
    true = (x[::5] @ x.T >= 0.98).sum()
    assert (np.einsum("nd,nd->n", x[q], x[v]) >= 0.98).sum() >= 0.98 * true


def test_links_are_counted_in_the_first_shard_of_both():
    shards = vectors._padded(pa.array([[3, 5], [5], [3, 5, 9], [9]], pa.list_(pa.int64())))
    low, high = np.array([0, 0, 1, 2, 0]), np.array([1, 2, 2, 3, 3])
    assert vectors._first_common(shards, low, high).tolist() == [5, 3, 5, 9, np.iinfo(np.int64).max]
    a, b = vectors._forest(np.array([4, 1, 2]), np.array([5, 2, 4]), 7)
    assert sorted(zip(a.tolist(), b.tolist())) == [(1, 2), (1, 4), (1, 5)]


def test_rare_near_copies_are_audited_where_the_search_met_them(spark, monkeypatch, caplog):
    monkeypatch.setattr(vectors, "AUDIT_ALL", 10)
    draw = np.random.default_rng(4)
    x = draw.standard_normal((300, 16))
    x[7] = x[3] + 1e-3  # ids that the audit does not ask
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    with caplog.at_level("INFO", logger=vectors.__name__):
        found = {r.vec_id: r.n_links for r in vectors.group_vectors(df).collect()}
    assert {i for i, n in found.items() if n} == {3, 7}
    assert "recall per link" in caplog.text and "1.0" in caplog.text
