import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.operators import images


def table(spark, n=12, h=8, w=6, d=3, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, h, w, d, int(i % 3), rng.integers(0, 256, h * w * d).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "example_id long, height int, width int, depth int, label int, pixels array<int>")


def arrays(df):
    return {r.example_id: np.array(r.pixels).reshape(r.height, r.width, r.depth) for r in df.collect()}


def test_channel_last(spark):
    df = table(spark).withColumns({"height": F.lit(0)})
    src = {r.example_id: np.array(r.pixels).reshape(3, 8, 6).transpose(1, 2, 0) for r in df.collect()}
    out = arrays(images.to_channel_last(df, (3, 8, 6)))
    assert all(np.array_equal(out[i], src[i]) for i in src)


def test_crop_is_a_window_and_repeatable(spark):
    src, out = arrays(table(spark)), arrays(images.random_crop(table(spark), 4, 4, 1, 2))
    again = arrays(images.random_crop(table(spark).repartition(7), 4, 4, 1, 2))
    for i, x in out.items():
        assert np.array_equal(x, again[i])
        assert any(np.array_equal(x, src[i][y:y + 4, z:z + 4]) for y in range(5) for z in range(3))
    with pytest.raises(Exception, match="larger than the image"):
        images.random_crop(table(spark), 9, 9).collect()


def test_flip_brightness_contrast(spark):
    src = arrays(table(spark))
    for i, x in arrays(images.random_flip_lr(table(spark), 3)).items():
        assert np.array_equal(x, src[i]) or np.array_equal(x, src[i][:, ::-1])
    for i, x in arrays(images.random_brightness(table(spark), 63, 3)).items():
        assert np.ptp(x - src[i]) < 1e-9 and abs((x - src[i]).flat[0]) <= 63
    for i, x in arrays(images.random_contrast(table(spark), 0.2, 1.8, 3)).items():
        m = src[i].mean(axis=(0, 1))
        factor = (x - m) / (src[i] - m)
        assert np.ptp(factor) < 1e-9 and 0.2 <= factor.flat[0] < 1.8


def test_standardize_floor(spark):
    flat = table(spark, 1).withColumn("pixels", F.transform("pixels", lambda x: F.lit(7)))
    assert set(images.standardize_image(flat).first().pixels) == {0.0}
    x = arrays(images.standardize_image(table(spark)))[3]
    assert abs(x.mean()) < 1e-12 and abs(x.std() - 1) < 1e-12


@pytest.mark.parametrize("h,w", [(4, 4), (5, 3), (11, 9), (4, 9)])
def test_center(spark, h, w):
    src, out = arrays(table(spark)), arrays(images.center_crop_or_pad(table(spark), h, w))
    for i, x in out.items():
        want = np.zeros((h, w, 3))
        ys, xs = max((8 - h) // 2, 0), max((6 - w) // 2, 0)
        yd, xd = max((h - 8) // 2, 0), max((w - 6) // 2, 0)
        part = src[i][ys:ys + h, xs:xs + w]
        want[yd:yd + part.shape[0], xd:xd + part.shape[1]] = part
        assert np.array_equal(x, want)


def test_chain_equals_single_steps(spark):
    one = arrays(images.distorted_inputs(table(spark), 5, 1, 4, 4))
    df = images.random_crop(table(spark), 4, 4, 5, 1)
    df = images.random_contrast(images.random_brightness(images.random_flip_lr(df, 5, 1), 63, 5, 1), seed=5, epoch=1)
    steps = arrays(images.standardize_image(df))
    assert all(np.allclose(one[i], steps[i]) for i in one)


def test_mixed_shapes_in_one_table(spark):
    df = table(spark, 5, 8, 6, 3).unionByName(
        table(spark, 5, 10, 10, 1, 4).withColumn("example_id", F.col("example_id") + 100)).coalesce(1)
    out = arrays(images.eval_inputs(df, 4, 4))
    assert {x.shape for x in out.values()} == {(4, 4, 3), (4, 4, 1)} and len(out) == 10
    with pytest.raises(Exception, match="does not match shape"):
        images.standardize_image(df.withColumn("depth", F.lit(2))).collect()


def test_small_operators(spark):
    df = table(spark, 4, 2, 2, 1)
    assert max(images.rescale_pixels(df).first().pixels) <= 1
    assert images.rescale_pixels(df, "uint8").first().pixels == df.first().pixels
    with pytest.raises(TypeError):
        images.rescale_pixels(df, "int64")
    assert images.one_hot(df, "label", 3).filter("example_id = 2").first().target == [0.0, 0.0, 1.0]
    with pytest.raises(Exception, match="out of range"):
        images.one_hot(df, "label", 2).collect()
    nested = df.withColumn("pixels", F.array(F.slice("pixels", 1, 2), F.slice("pixels", 3, 2)))
    assert images.flatten_images(nested).first().pixels == df.first().pixels
    with pytest.raises(Exception, match="depth must be 1"):
        images.flatten_images(nested.withColumn("depth", F.lit(3))).collect()


def test_empty_table(spark):
    assert images.distorted_inputs(table(spark).filter("example_id < 0"), 1, 1, 4, 4).count() == 0
