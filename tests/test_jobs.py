from pathlib import Path

import numpy as np
import pytest

from fieldloom.operators.parse import parse_numeric_points
from fieldloom.plans import jobs
from fieldloom.sources import read_lines
from fieldloom.storage import new_path, released


def table(df):
    return {(row.model, row.split): row.value for row in df.collect()}


def test_words(spark, tmp_path):
    (tmp_path / "text").write_text("a fox and 'fox'\nthe dog\n")
    rows = jobs.words(spark, str(tmp_path / "text")).collect()
    assert [tuple(row) for row in rows] == [("fox", 2), ("dog", 1)]


def test_regression(spark, tmp_path):
    draw = np.random.default_rng(4)
    x = draw.random((1500, 3))
    y = 1950 + 40 * x[:, 0] - 20 * x[:, 1] + 30 * x[:, 0] * x[:, 2] + draw.standard_normal(1500)
    lines = [",".join(map(repr, map(float, [label, *row]))) for label, row in zip(y, x)]
    (tmp_path / "songs").write_text("\n".join(lines))
    found = table(jobs.regression(spark, str(tmp_path / "songs")))
    models = ["baseline", "descent", "elastic_net", "grid", "interactions", "pipeline"]
    assert set(found) == {(m, s) for m in models for s in ("train", "validation", "test")}
    for split in ("validation", "test"):
        assert found["interactions", split] == pytest.approx(1.0, rel=0.3)
        assert found["pipeline", split] == pytest.approx(found["interactions", split], rel=0.05)
        assert found["interactions", split] < found["elastic_net", split] < found["baseline", split]
    assert found["grid", "validation"] <= found["elastic_net", "validation"]


def test_split_does_not_depend_on_how_files_are_cut(spark, tmp_path):
    lines = [f"{i % 700}.0,{i % 30}.5,2.0" for i in range(3000)]
    (tmp_path / "lines").write_text("\n".join(lines))
    parts = []
    for size in ("128m", "4k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = jobs._numbered(read_lines(spark, str(tmp_path / "lines")), parse_numeric_points, "points")
        parts.append(sorted((r.label, tuple(r.features), r.split) for r in rows.collect()))
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert parts[0] == parts[1] and len(parts[0]) == 3000


def test_components(spark, tmp_path):
    rows = np.random.default_rng(2).standard_normal((50, 3)) * [1.0, 5.0, 2.0]
    (tmp_path / "points").write_text("\n".join(",".join(map(repr, map(float, row))) for row in rows))
    found = jobs.components(spark, str(tmp_path / "points")).collect()
    values = np.linalg.eigvalsh(np.cov(rows.T, bias=True))[::-1]
    assert np.allclose([r.eigenvalue for r in found], values[:2])
    assert found[1].share == pytest.approx(values[:2].sum() / values.sum())


def test_released_tables_are_deleted(spark):
    with released(spark):
        path = new_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert Path(path).exists()
    assert not Path(path).exists()


def test_clicks(spark, tmp_path):
    draw = np.random.default_rng(6)
    lines = []
    for i in range(2000):
        colour, shape = draw.integers(4), draw.integers(3)
        label = int(draw.random() < 0.15 + 0.2 * colour)
        lines.append(f"{label}\tc{colour}\ts{shape}\t{'' if i % 3 else 'x'}")
    (tmp_path / "clicks").write_text("\n".join(lines))
    found = table(jobs.clicks(spark, str(tmp_path / "clicks")))
    assert set(found) == {
        (m, s) for m in ("baseline", "one_hot", "hashed") for s in ("train", "validation", "test")
    }
    for split in ("train", "validation", "test"):
        assert found["one_hot", split] < found["baseline", split]
        assert found["hashed", split] < found["baseline", split]
