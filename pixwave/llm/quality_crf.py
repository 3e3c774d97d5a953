"""Document quality from a linear-chain conditional random field over its lines.

Every line with a word is a position of a chain with the states bad and good. Its
score for good is linear in its own features and those of the lines before and
after it; neighbouring states have weights too. Forward and backward sums give each
line's probability of being good, and their mean, weighted by the lines' lengths,
is mapped to a document score by a logistic curve.

Labels are known per document only, so in training all lines of a document carry
its label. The field is fitted by Adam on a bounded sample of labelled documents;
scoring is one pass over whole texts.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .blocks import texts_of

SAMPLE_DOCS = 4000  # labelled documents of the fit
OWN = 12  # features of a line
FEATURES = 3 * OWN + 1
_CLASS = np.zeros((4, 256), np.uint8)
_CLASS[0, ord("A"):ord("Z") + 1] = 1
_CLASS[1, ord("0"):ord("9") + 1] = 1
_CLASS[2, [b for b in range(33, 127) if not chr(b).isalnum()]] = 1
_CLASS[3, 128:] = 1
EDGE = 1e-6


@dataclass(frozen=True)
class QualityModel:
    """Weights of the field (emission, 2 x 2 transition), the scaling of features, and the curve to a document score."""

    mean: np.ndarray
    scale: np.ndarray
    emission: np.ndarray
    transition: np.ndarray
    slope: float
    shift: float
    empty: float


def _few_lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, byte lengths and ends of the lines with a word of a byte array."""
    starts, ends = W.spans(data)
    if not len(starts):
        return np.zeros((0, OWN), np.float32), np.zeros(0), np.zeros(0, np.int64)
    breaks = np.concatenate([np.flatnonzero(data == 10), [len(data)]])
    line_of = np.searchsorted(breaks, starts)
    first = np.flatnonzero(np.diff(line_of, prepend=-1))
    line = line_of[first]
    n_words = np.diff(np.append(first, len(starts)))
    begin, end = starts[first], ends[np.append(first[1:], len(starts)) - 1]
    size = (end - begin).astype(np.float64)
    cuts = np.stack([begin, end], axis=1).ravel()
    tail = np.append(data, np.uint8(32))
    counts = [np.add.reduceat(c[tail], cuts, dtype=np.int64)[::2] for c in _CLASS]
    word_size = (ends - starts).astype(np.float64)
    hashes = W.span_hashes(data, starts, ends)
    pure = _CLASS[2][data[starts]] & _CLASS[2][data[ends - 1]]
    double = _CLASS[2][data[ends - 1]] & _CLASS[2][data[np.maximum(ends - 2, starts)]]
    near = np.searchsorted(first, np.arange(len(starts)), side="right") - 1

    def per_line(x):
        return np.add.reduceat(x.astype(np.float64), first)

    again = np.zeros(len(starts))
    again[1:] = (hashes[1:] == hashes[:-1]) & (near[1:] == near[:-1])
    order = np.lexsort((hashes, near))
    new = np.ones(len(starts))
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (near[order][1:] != near[order][:-1])
    distinct = np.add.reduceat(new, first)
    short = word_size <= 3
    f = np.stack([
        np.log1p(size), np.log1p(n_words), per_line(word_size) / n_words, counts[0] / size, counts[1] / size, counts[2] / size,
        counts[3] / size, per_line(again) / n_words, distinct / n_words, per_line(pure) / n_words, per_line(double) / n_words,
        per_line(short) / n_words], axis=1)
    return f.astype(np.float32), size, breaks[line]


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and byte lengths of the lines of some texts, and where each text's lines begin (n + 1 entries)."""
    feats, sizes, counts = [], [], []
    for few in W.batches(texts):
        joined = few if max(map(len, few)) <= W.SEGMENT else None
        if joined:
            f, s, end = _few_lines(np.frombuffer(b"\n".join(few), np.uint8))
            begin = np.cumsum([0] + [len(t) + 1 for t in few])
            counts.extend(np.diff(np.searchsorted(end, begin)).tolist())
            feats.append(f)
            sizes.append(s)
            continue
        for t in few:
            n = 0
            for part in _line_parts(t):
                f, s, _ = _few_lines(np.frombuffer(part, np.uint8))
                feats.append(f)
                sizes.append(s)
                n += len(s)
            counts.append(n)
    return (np.concatenate([np.zeros((0, OWN), np.float32), *feats]), np.concatenate([np.zeros(0), *sizes]), np.cumsum([0] + counts))


def _line_parts(text: bytes) -> Iterator[bytes]:
    """A long text cut at ends of lines into parts of about a segment."""
    at = 0
    while at < len(text):
        end = text.find(b"\n", at + W.SEGMENT)
        end = len(text) if end < 0 else end + 1
        yield text[at:end]
        at = end


def with_neighbours(own: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Own features of each line, those of the line before and after it in its text (0 at the ends), and a constant."""
    n = len(own)
    out = np.zeros((n, FEATURES))
    out[:, :OWN] = own
    out[1:, OWN:2 * OWN] = own[:-1]
    out[:-1, 2 * OWN:3 * OWN] = own[1:]
    starts, ends = begin[:-1][begin[:-1] < begin[1:]], begin[1:][begin[:-1] < begin[1:]]
    out[starts, OWN:2 * OWN] = 0
    out[ends - 1, 2 * OWN:3 * OWN] = 0
    out[:, -1] = 1
    return out


def marginals(good: np.ndarray, transition: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of good for every line (chains given by `begin`), and the expected pairs of neighbouring states."""
    n = np.diff(begin)
    order = np.argsort(-n, kind="stable")  # chains that are still going on come first
    length = n[order]
    longest = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(longest), side="left")
    place = begin[:-1][order]
    ahead = np.zeros((len(good), 2))
    behind = np.zeros((len(good), 2))
    for t in range(longest):
        at = place[:active[t]] + t
        if t:
            before = ahead[at - 1]
            a0 = np.logaddexp(before[:, 0] + transition[0, 0], before[:, 1] + transition[1, 0])
            a1 = np.logaddexp(before[:, 0] + transition[0, 1], before[:, 1] + transition[1, 1])
            ahead[at, 0], ahead[at, 1] = a0, a1 + good[at]
        else:
            ahead[at, 1] = good[at]
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = place[:active[t + 1]] + t
        after = behind[at + 1].copy()
        after[:, 1] += good[at + 1]
        behind[at, 0] = np.logaddexp(after[:, 0] + transition[0, 0], after[:, 1] + transition[0, 1])
        behind[at, 1] = np.logaddexp(after[:, 0] + transition[1, 0], after[:, 1] + transition[1, 1])
        total = np.logaddexp(ahead[at, 0] + behind[at, 0], ahead[at, 1] + behind[at, 1])
        for i in (0, 1):
            for j in (0, 1):
                pairs[i, j] += np.exp(ahead[at, i] + transition[i, j] + after[:, j] - total).sum()
    both = ahead + behind
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -700, 700))), pairs


def _weighted(p: np.ndarray, sizes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Log odds of the length-weighted mean of each text; 0 for a text without lines."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    parts = np.concatenate([[0], np.cumsum(p * sizes)])
    weight = sums[begin[1:]] - sums[begin[:-1]]
    mean = np.clip((parts[begin[1:]] - parts[begin[:-1]]) / np.maximum(weight, 1), EDGE, 1 - EDGE)
    return np.where(weight > 0, np.log(mean / (1 - mean)), 0.0)


def fit(own: np.ndarray, sizes: np.ndarray, begin: np.ndarray, labels: np.ndarray, *, steps: int = 150, rate: float = 0.1,
        penalty: float = 1e-3) -> QualityModel:
    """Maximum of the penalised likelihood of the labels (one 0/1 per text)."""
    share = float((labels.sum() + 1) / (len(labels) + 2))
    mean = own.mean(axis=0) if len(own) else np.zeros(OWN)
    scale = np.maximum(own.std(axis=0), 1e-3) if len(own) else np.ones(OWN)
    x = with_neighbours((own - mean) / scale, begin)
    y = np.repeat(labels, np.diff(begin)).astype(float)
    inner = np.ones(len(y), bool)
    inner[begin[1:][begin[1:] > begin[:-1]] - 1] = False
    seen = np.zeros((2, 2))
    for state in (0, 1):
        seen[state, state] = (inner & (y == state)).sum()
    w, a = np.zeros(FEATURES), np.zeros((2, 2))
    moments = [np.zeros(FEATURES), np.zeros((2, 2)), np.zeros(FEATURES), np.zeros((2, 2))]
    n = max(len(y), 1)
    for step in range(1, steps + 1):
        p, pairs = marginals(x @ w, a, begin)
        grads = (x.T @ (y - p) / n - penalty * w, (seen - pairs) / n - penalty * a)
        for k, g in enumerate(grads):
            moments[k] = 0.9 * moments[k] + 0.1 * g
            moments[2 + k] = 0.999 * moments[2 + k] + 0.001 * g * g
            move = rate * (moments[k] / (1 - 0.9 ** step)) / (np.sqrt(moments[2 + k] / (1 - 0.999 ** step)) + 1e-8)
            if k:
                a = a + move
            else:
                w = w + move
    z = _weighted(marginals(x @ w, a, begin)[0], sizes, begin)
    slope, shift = 1.0, 0.0
    some = np.diff(begin) > 0
    for _ in range(50):  # Newton's method, with a weak pull to the plain log odds
        q = 1 / (1 + np.exp(-np.clip(slope * z[some] + shift, -500, 500)))
        g = np.array([((labels[some] - q) * z[some]).sum() - (slope - 1), (labels[some] - q).sum() - shift])
        v = q * (1 - q)
        h = np.array([[(v * z[some] ** 2).sum() + 1, (v * z[some]).sum()], [(v * z[some]).sum(), v.sum() + 1]])
        d = np.linalg.solve(h, g)
        slope, shift = slope + d[0], shift + d[1]
    return QualityModel(mean, scale, w, a, float(max(slope, 0.0)), float(shift), share)


def score_texts(model: QualityModel, texts: list[bytes]) -> np.ndarray:
    own, sizes, begin = line_features(texts)
    x = with_neighbours((own - model.mean) / model.scale, begin)
    z = _weighted(marginals(x @ model.emission, model.transition, begin)[0], sizes, begin)
    score = 1 / (1 + np.exp(-np.clip(model.slope * z + model.shift, -500, 500)))
    return np.where(np.diff(begin) > 0, score, model.empty)


def held_out(ident: Column) -> Column:
    """Whether the id's crc32 is 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(ident.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", label: str = "quality", *,
          sample_docs: int = SAMPLE_DOCS) -> QualityModel:
    """Fit on at most `sample_docs` labelled documents that are not held out, chosen by hash of the id, their whole texts.

    Only features come to the driver, 56 bytes for each of their lines. Ids labelled more than once take their mean label, 0.5 counting as good. Rows without id, label or text are left
    out. Without any labelled row, every score is 0.5.
    """
    chosen = (labels.where(F.col(ident).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(ident)))
              .groupBy(F.col(ident).alias("i")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
              .orderBy(F.xxhash64("i"), "i").limit(sample_docs))
    rows = docs.select(F.col(ident).alias("i"), F.col(text).alias("t")).where("t is not null").join(F.broadcast(chosen), "i")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sizes, begin = line_features(texts_of(batch, "t"))
            cut = list(zip(begin, begin[1:]))
            yield pa.RecordBatch.from_arrays([
                batch.column("i"), batch.column("y"), pa.array([own[b:e].astype(np.float32).tobytes() for b, e in cut], pa.binary()),
                pa.array([sizes[b:e].tobytes() for b, e in cut], pa.binary())], names=["i", "y", "own", "sizes"])

    schema = f"i {docs.schema[ident].dataType.simpleString()}, y int, own binary, sizes binary"
    # ids may repeat in the documents; one text of each is enough
    got = rows.select("i", "y", "t").mapInArrow(features, schema).groupBy("i").agg(F.min(F.struct("own", "sizes", "y")).alias("s")).select("i", "s.*").toArrow()
    got = got.sort_by("i")
    own = [np.frombuffer(b, np.float32).reshape(-1, OWN) for b in got.column("own").to_pylist()]
    sizes = [np.frombuffer(b) for b in got.column("sizes").to_pylist()]
    begin = np.cumsum([0] + [len(s) for s in sizes])
    return fit(np.concatenate([np.zeros((0, OWN), np.float32), *own]).astype(np.float64), np.concatenate([np.zeros(0), *sizes]), begin,
               np.array(got.column("y").to_pylist(), float))


def quality(model: QualityModel, text: Column | str) -> Column:
    """Score of a text in [0, 1]; null and empty texts get the share of good labels."""
    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        texts = texts_of(pa.RecordBatch.from_arrays([column], names=["t"]), "t")
        return pa.array(score_texts(model, texts))

    return run(text)


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", *, threshold: float = 0.3, **options) -> DataFrame:
    """All rows and columns of `docs` with held_out, score and predicted (1 if score >= threshold); such columns are replaced.

    Only the text enters a score. Null, empty and blank texts get the share of good labels. Repeated rows: equal scores.
    Empty table: no rows. Long texts are read in parts that end with a line.
    """
    model = train(docs, labels, text, ident, **options)
    return docs.withColumns({"held_out": held_out(F.col(ident)), "score": quality(model, F.col(text))}).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def op4_query(spark, sf_dir: str) -> DataFrame:
    """Quality of every document of the table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scored(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select("doc_id", "held_out", "score", "predicted")


def pipeline_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, does not reject."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality(model, F.col("text")) >= 0.3)
