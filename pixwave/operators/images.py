"""Image preparation: one Arrow pass per call, all draws computed by Spark as columns.

Images are flat row-major (height, width, depth) arrays with their shape in
columns. The numpy kernels see one batch of equally shaped images at a time;
only the pixel, shape and draw columns go to Python.
"""

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..functions.hashing import hash_uniform
from ..functions.vectors import one_hot_vector

DOUBLES = T.ArrayType(T.DoubleType())
# Pixels a kernel works on at a time: an Arrow batch is limited by rows, not by bytes.
KERNEL_VALUES = 4 << 20
Kernel = Callable[[np.ndarray, np.ndarray], np.ndarray]


def list_array(rows: Sequence[np.ndarray]) -> pa.Array:
    """Arrow list<double> array with one entry per numpy row."""
    offsets = np.concatenate([[0], np.cumsum([r.size for r in rows])]).astype(np.int32)
    values = np.concatenate([r.ravel() for r in rows]) if len(rows) else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.float64)))


def block_array(block: np.ndarray) -> pa.Array:
    """Arrow list<double> array of equally long rows."""
    flat = np.ascontiguousarray(block, dtype=np.float64).reshape(len(block), -1)
    offsets = (np.arange(len(flat) + 1) * flat.shape[1]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))


def apply_kernel(kernel: Kernel, pixels: pa.Array, shapes: np.ndarray, draws: np.ndarray) -> pa.Array:
    """Run `kernel(images [n,h,w,c], draws [n,k])` once per distinct shape in the batch."""
    values = np.asarray(pixels.flatten()).astype(np.float64)
    sizes = np.asarray(pixels.value_lengths())
    wrong = np.flatnonzero(sizes != shapes.prod(axis=1))
    if len(wrong):
        raise ValueError(f"pixel count {sizes[wrong[0]]} does not match shape {tuple(shapes[wrong[0]].tolist())}")
    if (shapes == shapes[0]).all():
        return block_array(kernel(values.reshape(len(pixels), *shapes[0]), draws))
    begins = np.cumsum(sizes) - sizes
    out: list[np.ndarray | None] = [None] * len(pixels)
    for shape in np.unique(shapes, axis=0):
        rows = np.flatnonzero((shapes == shape).all(axis=1))
        take = begins[rows][:, None] + np.arange(int(shape.prod()))
        done = kernel(values[take].reshape(len(rows), *shape), draws[rows])
        for row, image in zip(rows, done):
            out[row] = image
    return list_array(out)


def image_column(kernel: Kernel, draws: Sequence[Column] = ()) -> Column:
    """Column of new pixels from `pixels, height, width, depth` and uniform draws."""

    @arrow_udf(DOUBLES)
    def run(pixels: pa.Array, shape: pa.Array, uniform: pa.Array) -> pa.Array:
        shapes = np.stack([np.asarray(shape.field(i)) for i in range(3)], axis=1)
        if not len(pixels):
            return pa.array([], pa.list_(pa.float64()))
        u = np.asarray(uniform.flatten(), dtype=np.float64).reshape(len(pixels), -1)
        rows = max(1, KERNEL_VALUES // max(1, int(shapes.prod(axis=1).max())))
        return pa.concat_arrays([
            apply_kernel(kernel, pixels.slice(i, rows), shapes[i:i + rows], u[i:i + rows])
            for i in range(0, len(pixels), rows)])

    packed = F.array(*draws) if draws else F.array().cast("array<double>")
    return run("pixels", F.struct("height", "width", "depth"), packed)


def _replace(df: DataFrame, kernel: Kernel, draws: Sequence[Column] = (), size=None) -> DataFrame:
    out = df.withColumn("pixels", image_column(kernel, draws))
    if size:
        out = out.withColumns({"height": F.lit(size[0]), "width": F.lit(size[1])})
    return out


# ---- kernels -------------------------------------------------------------

def crop_kernel(h: int, w: int, first: int = 0) -> Kernel:
    def run(x, u):
        n, height, width, _ = x.shape
        if h > height or w > width:
            raise ValueError(f"crop {h}x{w} is larger than the image {height}x{width}")
        top = np.floor(u[:, first] * (height - h + 1)).astype(int)
        left = np.floor(u[:, first + 1] * (width - w + 1)).astype(int)
        rows = top[:, None, None] + np.arange(h)[None, :, None]
        cols = left[:, None, None] + np.arange(w)[None, None, :]
        return x[np.arange(n)[:, None, None], rows, cols]
    return run


def flip_kernel(draw: int = 0) -> Kernel:
    def run(x, u):
        return np.where((u[:, draw] < 0.5)[:, None, None, None], x[:, :, ::-1], x)
    return run


def brightness_kernel(max_delta: float, draw: int = 0) -> Kernel:
    def run(x, u):
        return x + ((2 * u[:, draw] - 1) * max_delta)[:, None, None, None]
    return run


def contrast_kernel(lower: float, upper: float, draw: int = 0) -> Kernel:
    def run(x, u):
        mean = x.mean(axis=(1, 2), keepdims=True)
        return (x - mean) * (lower + u[:, draw] * (upper - lower))[:, None, None, None] + mean
    return run


def standardize_kernel(x, u=None):
    flat = x.reshape(len(x), -1)
    mean, std = flat.mean(axis=1), flat.std(axis=1)
    floor = 1.0 / np.sqrt(flat.shape[1])
    return (x - mean[:, None, None, None]) / np.maximum(std, floor)[:, None, None, None]


def center_kernel(h: int, w: int) -> Kernel:
    def run(x, u=None):
        n, height, width, depth = x.shape
        out = np.zeros((n, h, w, depth))
        ys, yd = max((height - h) // 2, 0), max((h - height) // 2, 0)
        xs, xd = max((width - w) // 2, 0), max((w - width) // 2, 0)
        rows, cols = min(h, height), min(w, width)
        out[:, yd:yd + rows, xd:xd + cols] = x[:, ys:ys + rows, xs:xs + cols]
        return out
    return run


def chain(*kernels: Kernel) -> Kernel:
    def run(x, u):
        for kernel in kernels:
            x = kernel(x, u)
        return x
    return run


# ---- operators -----------------------------------------------------------

def split_record(df: DataFrame, record: str = "record") -> DataFrame:
    """First element of a record -> `label`, the rest -> `pixels`."""
    rec = F.col(record)
    return df.withColumns({
        "label": F.element_at(rec, 1).cast("int"),
        "pixels": F.slice(rec, F.lit(2), F.size(rec) - 1),
    }).drop(record)


def to_channel_last(df: DataFrame, shape: tuple[int, int, int] = (3, 32, 32)) -> DataFrame:
    """Depth-major pixels [D,H,W] -> [H,W,D], shape written to columns."""
    depth, height, width = shape
    shaped = df.withColumns({"height": F.lit(height), "width": F.lit(width), "depth": F.lit(depth)})
    return _replace(shaped, lambda x, u: x.reshape(len(x), depth, height, width).transpose(0, 2, 3, 1))


def flatten_images(df: DataFrame) -> DataFrame:
    """[H][W] nested pixels of depth 1 -> one flat array; another depth is an error."""
    bad = F.raise_error(F.concat(F.lit("depth must be 1, got "), F.col("depth").cast("string")))
    flat = F.flatten("pixels")
    kind = df.schema["pixels"].dataType.elementType.simpleString()
    return df.withColumn("pixels", F.when(F.col("depth") == 1, flat).otherwise(bad.cast(kind)))


def rescale_pixels(df: DataFrame, dtype: str = "float32") -> DataFrame:
    """[0,255] -> [0,1]; `uint8` leaves the pixels as they are."""
    if dtype == "uint8":
        return df
    if dtype != "float32":
        raise TypeError(f"dtype must be uint8 or float32, got {dtype}")
    return df.withColumn("pixels", F.transform("pixels", lambda x: x / F.lit(255.0)))


def one_hot(df: DataFrame, column: str = "label", classes: int = 10, name: str = "target") -> DataFrame:
    return df.withColumn(name, one_hot_vector(column, classes))


def _draw(tag: str, seed: int, epoch, ident: str) -> Column:
    return hash_uniform(seed, epoch, tag, ident)


def random_crop(df, h: int = 24, w: int = 24, seed: int = 0, epoch=0, ident: str = "example_id") -> DataFrame:
    draws = [_draw(t, seed, epoch, ident) for t in ("crop_y", "crop_x")]
    return _replace(df, crop_kernel(h, w), draws, (h, w))


def random_flip_lr(df, seed: int = 0, epoch=0, ident: str = "example_id") -> DataFrame:
    return _replace(df, flip_kernel(), [_draw("flip", seed, epoch, ident)])


def random_brightness(df, max_delta: float = 63, seed: int = 0, epoch=0, ident: str = "example_id") -> DataFrame:
    return _replace(df, brightness_kernel(max_delta), [_draw("brightness", seed, epoch, ident)])


def random_contrast(df, lower: float = 0.2, upper: float = 1.8, seed: int = 0, epoch=0,
                    ident: str = "example_id") -> DataFrame:
    return _replace(df, contrast_kernel(lower, upper), [_draw("contrast", seed, epoch, ident)])


def standardize_image(df: DataFrame) -> DataFrame:
    """(x - mean) / max(population std, 1/sqrt(n)) per image."""
    return _replace(df, standardize_kernel)


def center_crop_or_pad(df: DataFrame, h: int = 24, w: int = 24) -> DataFrame:
    """Central window of h x w, zeros where the image is smaller."""
    return _replace(df, center_kernel(h, w), size=(h, w))


def distorted_inputs(df, seed: int = 0, epoch=0, h: int = 24, w: int = 24, ident: str = "example_id") -> DataFrame:
    """Training chain crop, flip, brightness, contrast, standardise in one pass.

    `epoch` may be a column, so one call prepares several epochs.
    """
    tags = ("crop_y", "crop_x", "flip", "brightness", "contrast")
    steps = chain(crop_kernel(h, w, 0), flip_kernel(2), brightness_kernel(63, 3),
                  contrast_kernel(0.2, 1.8, 4), standardize_kernel)
    return _replace(df, steps, [_draw(t, seed, epoch, ident) for t in tags], (h, w))


def eval_inputs(df: DataFrame, h: int = 24, w: int = 24) -> DataFrame:
    """Evaluation chain central crop, standardise in one pass."""
    return _replace(df, chain(center_kernel(h, w), standardize_kernel), size=(h, w))
