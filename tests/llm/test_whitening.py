import numpy as np
import pytest

from pactframe.llm import whitening
from pactframe.llm.bidiagonal import right_singular

VECTORS = "vec_id long, embedding array<float>, label int"


def table(spark, rows, extra=False):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    if extra:
        for name in ("n", "component", "d", "factor", "place", "total", "value", "at"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def brute(rows, components=32):
    """By the definition: exact integers, covariance, dense eigenvectors."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for _, v in kept]
    n = len(x)
    total = [sum(c) for c in zip(*x, strict=True)]
    far = [[n * c - s for c, s in zip(v, total, strict=True)] for v in x]
    centred = np.array([[f / n for f in v] for v in far])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1][:components], vectors.T[::-1][:components]
    white = centred @ (vectors / np.sqrt(e)[:, None]).T
    return [i for i, _ in kept], n, [sum(f * f for f in v) for v in far], e / np.trace(centred.T @ centred / n), white


def sample(n, d, seed=5):
    dice = np.random.default_rng(seed)
    mixed = dice.normal(size=(n, d)) @ (dice.normal(size=(d, d)) * np.linspace(3, 0.2, d))
    return [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(mixed)]


@pytest.mark.parametrize(("n", "d", "components"), [(300, 12, 5), (700, 40, 32), (60, 3, 32)])
def test_against_dense_eigenvectors(spark, n, d, components):
    rows = sample(n, d)
    odd = [(900, None), (901, []), (902, [1.0] * (d - 1)), (903, [None] + [1.0] * (d - 1)), (904, [float("nan")] * d), (905, [float("inf")] + [0.0] * (d - 1))]
    rows += [(7, rows[7][1]), (None, rows[3][1])]  # a repeated row, a null id
    ids, n, deviation, share, white = brute(rows, components)
    got = whitening.whiten(table(spark, rows + odd, extra=True).repartition(5), components).collect()
    k = len(share)
    assert len(got) == n * k and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    assert sorted(repr((r.vec_id, r.deviation)) for r in got if r.component == 1) == sorted(map(repr, zip(ids, deviation, strict=True)))
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(k):
        assert by[ids[0], c + 1].explained == pytest.approx(share[c], rel=1e-9)
        mine = np.array([by[i, c + 1].whitened for i in ids])
        assert np.abs(mine - np.sign(mine @ white[:, c]) * white[:, c]).max() < 1e-7


def test_many_factors_are_reduced_in_rounds(spark, monkeypatch):
    rows = sample(400, 6)
    want = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(table(spark, rows).coalesce(1)).collect()}
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    got = {(r.vec_id, r.component): r.whitened for r in whitening.whiten(table(spark, rows).repartition(11)).collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in got) < 1e-9


def test_equal_values_and_flat_directions(spark):
    corners = [(2 * k + s, [float(4 * (1 - 2 * s) * (j == k)) for j in range(6)] + [2.0]) for k in range(6) for s in (0, 1)]
    got = whitening.whiten(table(spark, corners)).collect()
    assert len(got) == 12 * 6  # the seventh dimension has no spread
    assert got[0].identity_error < 1e-12
    assert {round(r.explained, 12) for r in got} == {round(1 / 6, 12)}


def test_one_row_equal_rows_and_no_rows(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).collect() == []
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 50)).collect() == []


def test_entries_and_deviations_that_do_not_fit_are_errors(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(table(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0])])).collect()
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(table(spark, [(1, [3e12, 0.0]), (2, [0.0, 1.0])])).collect()


@pytest.mark.parametrize("gap", [0.0, 1e-14, 1e-9, 1e-5, 1e-2])
def test_vectors_of_close_values_stay_orthogonal(gap):
    dice = np.random.default_rng(3)
    u, v = np.linalg.qr(dice.normal(size=(90, 30)))[0], np.linalg.qr(dice.normal(size=(30, 30)))[0]
    values = 1 + gap * np.arange(30)
    values[:4] = 5
    r = np.linalg.qr(u * values @ v.T, mode="r")
    found, rows = right_singular(r, 30)
    assert found == pytest.approx(np.sort(values)[::-1] ** 2, rel=1e-12)
    assert np.abs(rows @ rows.T - np.eye(30)).max() < 1e-12
    assert np.abs(r.T @ (r @ rows.T) - rows.T * found).max() < 1e-11


def test_small_values_keep_their_accuracy():
    graded = np.triu(np.random.default_rng(2).normal(size=(12, 12)) * 0.1, 1) * np.logspace(0, -9, 12)[:, None] + np.diag(np.logspace(0, -9, 12))
    found, _ = right_singular(graded, 12)
    assert np.sqrt(found) == pytest.approx(np.linalg.svd(graded, compute_uv=False), rel=1e-6)
