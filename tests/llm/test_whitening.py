"""Whitening against numpy, and on odd tables."""

import numpy as np
import pytest

from roadpulse.llm import whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n long, component string, x string, row string")


def table(rows):
    return [(id, v and [c if c is None else float(c) for c in v], 7, "c", "x", "r") for id, v in rows]


def expected(rows, most):
    """Ids with their whole numbers, deviations and whitened values, by plain numpy."""
    usable = [(id, v) for id, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(64 * np.array([np.float32(v) for _, v in usable], dtype=np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1][:most], directions[:, ::-1][:, :most]
    return [id for id, _ in usable], ((n * x - sums) ** 2).sum(1), centred @ directions / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_against_numpy(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(2500, 6)) @ draw.normal(size=(6, 6)) * np.array([3, 1, 0.5, 0.2, 1, 2])
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(base)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (9000, None), (9001, [1.0, None, 0, 0, 0, 0]), (9002, [float("nan")] * 6),
             (9003, [float("inf"), 0, 0, 0, 0, 0]), (9004, []), (9005, [1.0, 2.0]), (9006, [1e30, 0, 0, 0, 0, 0])]
    got = whitening.whiten(vectors(spark, table(rows)).repartition(3), most=4).collect()
    usable = [r for r in rows if r[0] not in (9005, 9006)]
    ids, deviations, whitened, explained = expected(usable, 4)
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {len(ids)}
    assert {r.identity_error for r in got}.pop() < 1e-9 and len({r.identity_error for r in got}) == 1
    signs = {}
    by_id = {}
    for r in got:
        by_id.setdefault((r.id, r.component), []).append(r)
    assert len(by_id[7, 1]) == 2 and len(by_id[None, 1]) == 1
    for k, id in enumerate(ids):
        for c in range(4):
            r = by_id[id, c + 1][0]
            assert r.deviation == deviations[k] and r.explained == pytest.approx(explained[c], rel=1e-9)
            signs.setdefault(c, np.sign(r.whitened * whitened[k, c]))
            assert r.whitened * signs[c] == pytest.approx(whitened[k, c], abs=1e-8)


def test_no_variance_and_no_rows(spark):
    empty = vectors(spark, [])
    assert whitening.whiten(empty).count() == 0 and "whitened" in whitening.whiten(empty).columns
    assert whitening.whiten(vectors(spark, table([(1, None), (2, [float("nan")])]))).count() == 0
    assert whitening.whiten(vectors(spark, table([(1, [1.0, 2.0])]))).count() == 0
    assert whitening.whiten(vectors(spark, table([(k, [1.0, 2.0]) for k in range(5)]))).count() == 0
    flat = whitening.whiten(vectors(spark, table([(k, [float(k), 2.0, 0.5]) for k in range(5)]))).collect()
    assert len(flat) == 5 and {r.component for r in flat} == {1} and flat[0].explained == pytest.approx(1)


def test_a_tie_of_lengths_goes_to_the_shorter(spark):
    got = whitening.whiten(vectors(spark, table([(1, [1.0]), (2, [3.0]), (3, [1.0, 2.0]), (4, [2.0, 1.0])]))).collect()
    assert {r.id for r in got} == {1, 2}


def test_query(spark, tmp_path):
    draw = np.random.default_rng(5)
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(draw.normal(size=(300, 40)))]
    vectors(spark, table(rows)).select("vec_id", "embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = whitening.op11_embedding_whitening(spark, str(tmp_path)).collect()
    ids, deviations, whitened, explained = expected(rows, 32)
    assert len(got) == 300 * 32
    mine = np.zeros((300, 32))
    for r in got:
        mine[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviations[r.vec_id]
    assert np.allclose(np.abs(mine), np.abs(whitened), atol=1e-8)
