import numpy as np
import pytest

from skyloom.imaging import frames
from skyloom.imaging import kernels as k

BEAM = k.Beam(2.5, 2.0, 0.3)


def sky(sources, seed=0, n=128, noise=1.0):
    image = np.random.default_rng(seed).normal(0, noise, (n, n)) if noise else np.zeros((n, n))
    x, y = np.indices(image.shape)
    for peak, a, b in sources:
        image += k.gaussian(k.Shape(peak, a, b, BEAM.major, BEAM.minor, BEAM.theta), x, y)
    return image


def test_finds_planted_sources_within_errors():
    truth = [(40, 30.3, 39.8), (25, 90.4, 80.1), (60, 64.0, 100.5)]
    found = sorted((f.shape for f in k.Finder(sky(truth), BEAM).extract(8, 3)), key=lambda s: s.y)
    assert len(found) == 3
    for s, (peak, x, y) in zip(found, truth, strict=True):
        assert abs(s.peak - peak) < 5 * s.errors["peak"] and abs(s.x - x) < 5 * s.errors["x"] and abs(s.y - y) < 5 * s.errors["y"]
        assert s.major == pytest.approx(2.5, rel=0.2) and s.fitted


def test_nothing_in_noise_flat_or_masked_images():
    assert k.Finder(sky([]), BEAM).extract(8, 3) == []
    assert k.Finder(np.zeros((64, 64)), BEAM).extract() == []
    assert k.Finder(np.full((64, 64), np.nan), BEAM).extract() == []
    with pytest.raises(ValueError):
        k.Finder(sky([]), BEAM).extract(3, 8)


def test_deblends_two_peaks():
    image = sky([(50, 60, 60), (45, 60, 67)])
    assert len(k.Finder(image, BEAM).extract(8, 3)) == 1 and len(k.Finder(image, BEAM).extract(8, 3, blend=True)) == 2


def test_reversed_and_false_discovery():
    f = k.Finder(sky([(40, 30, 40)]), BEAM)
    assert f.reversed(8, 3) == [] and len(f.false_discovery(0.01)) == 1


def test_forced_fits():
    f = k.Finder(sky([(40, 30.3, 39.8)]), BEAM, margin=5)
    s = f.fit_at(30.3, 39.8, 10).shape
    assert abs(s.peak - 40) < 5 * s.errors["peak"] and (s.x, s.y, s.major) == (30.3, 39.8, 2.5)
    assert f.fit_at(-3, 10, 10) is None and f.fit_at(2, 60, 10) is None
    model, residual = f.maps(f.extract(8, 3))
    assert model.max() == pytest.approx(40, rel=0.15) and abs(residual[25:36, 35:46]).max() < 6


def test_labels_match_flood_fill():
    rng = np.random.default_rng(3)
    for _ in range(20):
        mask = rng.random((15, 17)) < 0.5
        names, n = k.label(mask)
        seen, count = np.zeros_like(mask), 0
        for start in zip(*np.nonzero(mask), strict=True):
            if seen[start]:
                continue
            count += 1
            todo, own = [start], set()
            while todo:
                i, j = todo.pop()
                if 0 <= i < 15 and 0 <= j < 17 and mask[i, j] and not seen[i, j]:
                    seen[i, j] = True
                    own.add(int(names[i, j]))
                    todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
            assert len(own) == 1 and 0 not in own
        assert n == count and (names[~mask] == 0).all()


def test_clipping_recovers_sigma():
    x = np.random.default_rng(1).normal(5, 2, 200_000)
    assert k.kappa_sigma(x).sigma == pytest.approx(2, rel=0.02)
    keep, _ = k.weighted_clip(np.r_[np.zeros(50), 1.0, 100.0])
    assert not keep[-1] and keep[:50].all()
    assert k.clipped_rms(np.random.default_rng(2).normal(0, 3, (200, 200))) == pytest.approx(3, rel=0.03)


def test_deconvolution_undoes_convolution():
    assert k.deconvolved(5, 4, 30, (3, 2, 30))[:3] == pytest.approx((4, 12**0.5, 30))
    assert k.deconvolved(3, 2, 30, (3, 2, 30)) == (0, 0, 0, 0)
    assert k.deconvolved(3, 2, 30, (4, 3, 30))[3] == 2


def test_deconvolution_errors_follow_the_measured_ones():
    along, across = k.deconvolution_errors(5.0, 4.0, 0.0, (3.0, 3.0, 0.0), (0.01, 0.02, 0.0))
    assert abs(along - 0.01 * 5 / 4) < 1e-4 and abs(across - 0.02 * 4 / 7**0.5) < 1e-3
    assert k.deconvolution_errors(5.0, 4.0, 0.0, (3.0, 3.0, 0.0), (float("inf"), 0.0, 0.0)) == (float("inf"), float("inf"))


def test_background_and_interpolation():
    image = sky([], noise=1.0) + np.linspace(0, 50, 128)[:, None]
    f = k.Finder(image, BEAM, (16, 16))
    assert abs(f.background[20:108, 20:108] - np.linspace(0, 50, 128)[20:108, None]).mean() < 1.5
    assert k.peak_bias(BEAM)[0] > 1


def test_images_as_rows(spark):
    rows = [(i, 128, 128, sky([(40, 30, 40)], i).ravel().tolist()) for i in range(3)]
    images = spark.createDataFrame(rows, "image long, nx int, ny int, pixels array<double>")
    found = frames.extract(images, (2.5, 2.0, 0.3)).collect()
    assert sorted(r.image for r in found) == [0, 1, 2] and all(abs(r.x - 30) < 1 for r in found)
    wanted = spark.createDataFrame([(0, 7, 30.0, 40.0), (1, 8, -5.0, 0.0)], "image long, n int, x double, y double")
    assert [(r.image, r.n) for r in frames.forced(images, wanted, (2.5, 2.0, 0.3)).collect()] == [(0, 7)]
    both = frames.combined(spark.createDataFrame([("g", 1.0, [1.0, 2.0]), ("g", 3.0, [3.0, 4.0])], "key string, freq_eff double, pixels array<double>"), "key").first()
    assert (both.freq_low, both.freq_high, both.pixels) == (1.0, 3.0, [2.0, 3.0])


def test_extracted_sources_of_every_vector(spark):
    from skyloom.plans import queries

    every = {r.vec_id for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id").collect()}
    assert {r.image for r in queries.extracted_sources(spark, "/root/testdata/sf0.001").collect()} == every
