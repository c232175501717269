import math
from fractions import Fraction

import numpy as np
import pytest

from lodestar.llm import whitening
from lodestar.llm.queries import op12_whitening


def brute_force(rows):
    """Kept rows, n, deviations and eigenvalues, from exact whole numbers."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    whole = [(i, [math.floor(float(c) * 64) + 1_000_000 for c in v]) for i, v in good if len(v) == width]
    fit = sorted({tuple(x) for _, x in whole})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit)]
    centred = [[n * a - s for a, s in zip(x, sums)] for x in fit]
    exact = [
        [float(Fraction(sum(r[a] * r[b] for r in centred), n**3)) for b in range(width)] for a in range(width)
    ]
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in whole]
    return whole, n, sums, deviation, np.array(exact)


def check(got, rows, most=16, rank=None):
    whole, n, sums, deviation, covariance = brute_force(rows)
    frame = got.toPandas()
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    rank = min(most, len(sums)) if rank is None else rank
    assert len(frame) == len(whole) * rank and (frame.n == n).all()
    assert sorted(set(frame.component)) == list(range(1, rank + 1))
    one = frame[frame.component == 1]
    assert sorted(zip(one.vec_id, one.deviation)) == sorted(deviation)
    assert frame.identity_error.nunique() == 1 and frame.identity_error[0] < 1e-6
    by_row = {i: x for i, x in whole}
    for j in range(rank):
        part = frame[frame.component == j + 1]
        assert part.explained.iloc[0] == pytest.approx(values[j] / values.sum(), rel=1e-6)
        centred = np.array([by_row[i] for i in part.vec_id], dtype=float) - np.array(sums) / n
        expected = centred @ axes[:, j] / math.sqrt(values[j])
        sign = np.sign(expected @ part.whitened.to_numpy())
        assert np.allclose(part.whitened, sign * expected, atol=1e-5)
    return frame


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def test_against_exact_sums(spark):
    rnd = np.random.default_rng(3)
    data = rnd.normal(size=(300, 20)) * np.geomspace(5, 0.2, 20)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(i + 1000, v) for i, v in rows[:40]] + [(5000, rows[3][1])] * 3  # repeated vectors and rows
    rows += [(2000, None), (2001, []), (2002, [1.0] * 19), (2003, [None] + [0.0] * 19)]
    rows += [(2004, [math.nan] * 20), (2005, [math.inf] + [0.0] * 19), (2006, [0.0] * 19 + [-math.inf])]
    check(whitening.whiten(frame_of(spark, rows).repartition(5)), rows)


def test_badly_conditioned(spark):
    """Directions whose variance is 10^-14 of the largest keep their digits."""
    rnd = np.random.default_rng(4)
    data = rnd.normal(size=(200, 4)) * [3e7, 2e4, 30, 3]
    data[:, 3] += data[:, 0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    frame = frame_of(spark, rows)
    got = whitening.whiten(frame).toPandas()
    whole, n, sums, _, _ = brute_force(rows)
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in whole])
    lengths = np.linalg.svd(centred, compute_uv=False)
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, lengths**2 / (lengths**2).sum(), rtol=1e-6)
    assert explained[-1] < 1e-13 and got.identity_error[0] < 1e-6


def test_dependent_and_constant_dimensions(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(90, 3)) * 4
    data = np.c_[base, base[:, 0], np.full(90, 0.5), np.round(base[:, 1] * 64) / 64]
    data[:, 1] = data[:, 5]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    check(whitening.whiten(frame_of(spark, rows)), rows, rank=3)


def test_fewer_rows_than_dimensions(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, (rnd.normal(size=12) * 3).tolist()) for i in range(5)]
    check(whitening.whiten(frame_of(spark, rows)), rows, rank=4)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(frame_of(spark, rows))
    assert got.count() == 0 and got.columns[:2] == ["vec_id", "component"]


def test_clashing_names_and_large_deviations(spark):
    docs = spark.range(50).selectExpr(
        "cast(id AS string) AS `x.id`", "array(id * 1000000.0D, id * id * 1.0D) AS `a.b`", "1 AS x", "2 AS n", "3 AS i"
    )
    got = whitening.whiten(docs, "x.id", "a.b").toPandas()
    assert len(got) == 100 and got["x.id"].nunique() == 50
    centre = whitening.Centre(1 << 40, np.zeros(1, dtype=np.int64))
    assert whitening.squared_deviations(centre, np.array([[1 << 20], [1]])).null_count == 2


def test_entries_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(frame_of(spark, [(1, [1e300]), (2, [0.0])]))


def test_whole_table(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    whole, n, _, deviation, covariance = brute_force(rows)
    got = op12_whitening(spark, sf).toPandas()
    assert sorted(zip(got.vec_id[got.component == 1], got.deviation[got.component == 1])) == sorted(deviation)
    values = np.linalg.eigvalsh(covariance)[::-1]
    explained = got.groupby("component").explained.first().to_numpy()
    assert np.allclose(explained, values[:16] / values.sum(), rtol=1e-9)
    assert len(got) == 16 * len(whole) and got.identity_error[0] < 1e-9 and (got.n == n).all()
