"""Model state as a written table of blocks of values, which tasks read themselves.

A version of a state is a folder of Parquet rows (tensor, shape, chunk, values). Training, scoring, saving and resuming
hand its path around; only rows whose tensor begins with `#`, a few numbers each, ever reach the driver.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import filesystem, qualified
from .layers import Params, init_params

CHUNK_VALUES = 1 << 12  # values of a row; Spark's Parquet reader holds 4,096 rows at a time
DIGIT = 1 << 16  # numbers in notes are stored as digits, which single precision holds exactly


def value_type(dtype) -> str:
    return "double" if np.dtype(dtype) == np.float64 else "float"


def state_schema(dtype) -> str:
    return f"tensor string, shape array<int>, chunk int, values array<{value_type(dtype)}>"


def weight_chunks(state: Params) -> Iterator[tuple[str, list[int], int, np.ndarray]]:
    """(tensor, shape, chunk, values) pieces of at most CHUNK_VALUES values."""
    for name, value in sorted(state.items()):
        flat = value.ravel()
        for i in range(0, max(1, value.size), CHUNK_VALUES):
            yield name, list(value.shape), i // CHUNK_VALUES, flat[i:i + CHUNK_VALUES]


def state_batches(state: Params, dtype, each: int = 256) -> Iterator[pa.RecordBatch]:
    """A state as rows of `state_schema`, a few blocks at a time."""
    held = []
    for piece in weight_chunks(state):
        held.append(piece)
        if len(held) == each:
            yield _batch(held, dtype)
            held = []
    if held:
        yield _batch(held, dtype)


def _batch(pieces, dtype) -> pa.RecordBatch:
    names, shapes, chunks, values = zip(*pieces)
    return pa.RecordBatch.from_pydict({
        "tensor": pa.array(names), "shape": pa.array(shapes, pa.list_(pa.int32())), "chunk": pa.array(chunks, pa.int32()),
        "values": pa.array([v.astype(dtype) for v in values], pa.list_(pa.from_numpy_dtype(np.dtype(dtype))))})


def assemble(found: dict[str, tuple[list[int], list[tuple[int, np.ndarray]]]], dtype) -> Params:
    """Tensors from their shapes and numbered chunks; chunks may come in any order."""
    out = {}
    for name, (shape, chunks) in found.items():
        flat, at = np.empty(sum(len(v) for _, v in chunks), dtype), 0
        for _, values in sorted(chunks, key=lambda c: c[0]):
            flat[at:at + len(values)] = values
            at += len(values)
        out[name] = flat.reshape(tuple(shape))
    return out


def read_folder(path: str, dtype) -> Params:
    """All tensors of a version but its notes, read from its files by whoever asks: a task, or the driver for a caller that wants arrays."""
    system, inner = filesystem(path)
    found: dict = {}
    for info in system.get_file_info(fs.FileSelector(inner)):
        if not info.is_file or info.base_name[0] in "._":
            continue
        with system.open_input_file(info.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(256, columns=["tensor", "shape", "chunk", "values"]):
                names, shapes, chunks, values = (batch.column(i) for i in range(4))
                for i, name in enumerate(names.to_pylist()):
                    if name[0] != "#":
                        found.setdefault(name, (shapes[i].as_py(), []))[1].append((chunks[i].as_py(), np.asarray(values[i].values)))
    return assemble(found, dtype)


_HELD: dict[tuple[str, str], Params] = {}


@dataclass(frozen=True)
class StateTable:
    """A written version of a state: the folder of its rows and the precision it is used in. A path, whatever the model's size."""

    path: str
    dtype: str = "float32"

    def read(self) -> Params:
        """The tensors; a worker keeps those of one version, which are not to be changed."""
        key = (self.path, self.dtype)
        if key not in _HELD:
            _HELD.clear()
            _HELD[key] = read_folder(self.path, self.dtype)
        return _HELD[key]

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(state_schema(self.dtype)).parquet(self.path)

    def size(self, spark: SparkSession) -> int:
        """Bytes of the tensors, counted by Spark."""
        values = self.rows(spark).where(~F.col("tensor").startswith("#")).agg(F.sum(F.size("values"))).first()[0] or 0
        return int(values) * np.dtype(self.dtype).itemsize


@dataclass(frozen=True)
class Weights:
    """The model's tensors of a written state, or their moving averages, for tasks: `value` reads them where it is asked for."""

    table: StateTable
    averaged: bool = False

    @property
    def value(self) -> Params:
        return averages(self.table.read()) if self.averaged else model_tensors(self.table.read())

    def unpersist(self) -> None:
        """Nothing was broadcast."""


def model_tensors(state: Params) -> Params:
    """The tensors alone, without optimizer state, averages and notes."""
    return {k: v for k, v in state.items() if "/" not in k and k[0] != "#"}


def averages(state: Params) -> Params:
    return {k[4:]: v for k, v in state.items() if k.startswith("ema/")}


def initial_state(model: dict, optimizer: str, seed: int, ema: float | None, dtype=np.float32) -> Params:
    if optimizer not in ("sgd", "adam"):
        raise ValueError(f"unknown optimizer: {optimizer}")
    params = init_params(model, seed, dtype)
    state = dict(params)
    if optimizer == "adam":
        state |= {f"{m}/{k}": np.zeros_like(v) for k, v in params.items() for m in "mv"}
    if ema:
        state |= {f"ema/{k}": v.copy() for k, v in params.items()}
    return state


def write_table(spark: SparkSession, path: str, dtype, make: Callable[[], Params]) -> StateTable:
    """Write what `make` gives, called in one task."""
    def draw(batches):
        for batch in batches:
            if batch.num_rows:
                yield from state_batches(make(), dtype)

    spark.range(0, 1, 1, 1).mapInArrow(draw, state_schema(dtype)).write.parquet(path)
    return StateTable(qualified(spark, path), np.dtype(dtype).name)


def digits(number: int) -> list[float]:
    """A number from 0 on as four digits that single precision holds exactly."""
    return [float(number // DIGIT ** i % DIGIT) for i in range(4)]


def number(values) -> int:
    return sum(int(v) * DIGIT ** i for i, v in enumerate(values))


def notes_frame(spark: SparkSession, notes: dict[str, list[int]], dtype) -> DataFrame:
    """Notes as rows of a state: each a list of numbers."""
    rows = [(f"#{name}", [len(numbers), 4], 0, [d for n in numbers for d in digits(n)]) for name, numbers in sorted(notes.items())]
    return spark.createDataFrame(rows, state_schema(dtype))


def read_notes(rows: DataFrame) -> dict[str, list[int]]:
    """The notes among the rows of a state."""
    found = rows.where(F.col("tensor").startswith("#") & (F.col("tensor") != "#shard")).select("tensor", "values").collect()
    return {r.tensor[1:]: [number(r["values"][i:i + 4]) for i in range(0, len(r["values"]), 4)] for r in found}


class Fold:
    """Sums of numbered values in the order of a fixed binary tree over the numbers, whatever groups they come in.

    Values are pushed in ascending order; a value that stands for an aligned block of numbers is pushed by any of them.
    """

    def __init__(self, add: Callable):
        self.add, self.items = add, []

    def push(self, place: int, value) -> None:
        while len(self.items) > 1 and self._link(-2) < (self.items[-1][0] ^ place).bit_length():
            self._join()
        self.items.append((place, value))

    def _link(self, i: int) -> int:
        """Height of the block that first holds both the item and the next one."""
        return (self.items[i][0] ^ self.items[i + 1][0]).bit_length()

    def _join(self) -> None:
        _, right = self.items.pop()
        place, left = self.items.pop()
        self.items.append((place, self.add(left, right)))

    def total(self):
        while len(self.items) > 1:
            self._join()
        return self.items.pop()[1]
