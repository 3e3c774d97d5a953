"""Column functions on short numeric arrays (class vectors, logits, text forms)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import col


def one_hot_vector(label, classes: int) -> Column:
    """Class index -> vector of `classes` doubles; an index out of range is an error."""
    label = col(label)
    bad = F.raise_error(F.concat(F.lit("label out of range: "), F.coalesce(label.cast("string"), F.lit("null"))))
    hot = F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda j: F.when(j == label, 1.0).otherwise(0.0))
    return F.when(label.between(0, classes - 1), hot).otherwise(bad.cast("array<double>"))


def argmax(vector) -> Column:
    """Index of the largest entry, the first one on ties."""
    vector = col(vector)
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def vector_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def with_value(vector: Column, value: Column | None, body) -> Column:
    """`body(vector, value)` with both computed once per row.

    A lambda over the elements would compute a column it refers to for every element; a variable it takes as it is.
    """
    bound = F.struct(vector.alias("v"), (F.lit(0) if value is None else value).alias("x"))
    return F.get(F.transform(F.array(bound), lambda b: body(b["v"], b["x"])), F.lit(0))


def softmax(logits) -> Column:
    """Probabilities; the largest logit is subtracted first, so large logits stay finite."""
    shifted = with_value(col(logits), F.array_max(col(logits)), lambda z, top: F.transform(z, lambda x: F.exp(x - top)))
    return with_value(shifted, None, lambda e, _: with_value(e, vector_sum(e), lambda v, total: F.transform(v, lambda x: x / total)))


def log_sum_exp(logits) -> Column:
    logits = col(logits)
    return with_value(logits, F.array_max(logits), lambda z, top: top + F.log(
        F.aggregate(z, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))))


def sparse_cross_entropy(logits, label) -> Column:
    """-log softmax(logits)[label] for a class index."""
    return log_sum_exp(logits) - F.element_at(col(logits), col(label).cast("int") + 1)


def onehot_cross_entropy(logits, target) -> Column:
    """-sum(target * log softmax(logits)) for a class vector."""
    dot = F.aggregate(F.arrays_zip(col(logits).alias("z"), col(target).alias("t")), F.lit(0.0),
                      lambda acc, p: acc + p["z"] * p["t"])
    return log_sum_exp(logits) * vector_sum(col(target)) - dot


def to_csv(vector) -> Column:
    """Array -> comma-joined text."""
    return F.array_join(F.transform(col(vector), lambda x: x.cast("string")), ",")


def from_csv(text, dtype: str = "double") -> Column:
    """Comma-joined text -> array; an empty line is an empty array, an empty element an error."""
    text = col(text)
    empty = F.array().cast(f"array<{dtype}>")
    return F.when(text == "", empty).otherwise(F.transform(F.split(text, ","), lambda x: x.cast(dtype)))


def class_index(target) -> Column:
    """Class vector -> class index; a vector that is not one-hot is an error."""
    target = col(target)
    hot = (F.array_max(target) == 1) & (vector_sum(F.transform(target, lambda x: F.abs(x.cast("double")))) == 1)
    error = F.raise_error(F.concat(F.lit("not a one-hot label: "), to_csv(target))).cast("int")
    return F.when(hot, argmax(target)).otherwise(error)
