"""Column functions on subtitle fields, clip names, paths, tags and log lines."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import col


# Fixed value: the part of a metric tag that names a worker.
TOWER = "tower_[0-9]*/"


def subtitle_fields(line) -> dict[str, Column]:
    """Dialogue, start and end of one event line.

    The line is cut at `,,`: the third part is the text, and the second and
    third comma fields of the first part are the two timecodes.
    """
    parts = F.split(col(line), ",,")
    head = F.split(F.get(parts, F.lit(0)), ",")
    return {
        "dialogue": F.regexp_replace(F.get(parts, F.lit(2)), "[\r\n]", ""),
        "start_tc": F.get(head, F.lit(1)),
        "end_tc": F.get(head, F.lit(2)),
    }


def timecode_sample(timecode, fs, mode: str = "correct") -> Column:
    """`H:MM:SS.cc` -> sample number; `mode='reference'` leaves the hours out."""
    if mode not in ("correct", "reference"):
        raise ValueError(f"unknown mode: {mode}")
    fs = col(fs)
    hms = F.split(col(timecode), ":")
    minutes = F.get(hms, F.lit(1)).cast("long")
    if mode == "correct":
        minutes = minutes + F.trim(F.get(hms, F.lit(0))).cast("long") * 60
    return (F.get(hms, F.lit(2)).cast("double") * fs).cast("long") + minutes * 60 * fs.cast("long")


def clip_name(num, dialogue) -> Column:
    """`NNNN - dialogue.wav`, at least four digits, backslashes removed."""
    number = col(num).cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    return F.concat(padded, F.lit(" - "), F.replace(col(dialogue), F.lit("\\"), F.lit("")), F.lit(".wav"))


def plain_path(path) -> Column:
    """File path as Spark's metadata column reports it, without percent escapes."""
    return F.url_decode(F.replace(col(path), F.lit("+"), F.lit("%2B")))


def file_stem(path) -> Column:
    """File name without folder and last extension."""
    return F.regexp_extract(F.element_at(F.split(col(path), "/"), -1), r"^(.*?)(\.[^.]*)?$", 1)


def parent_directory(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -2)


def prediction_line(ts, label, prediction) -> Column:
    # The words of the line.
    return F.concat(col(ts).cast("string"), F.lit(" Label: "), col(label).cast("string"),
                    F.lit(", Prediction: "), col(prediction).cast("string"))


def strip_tower(tag) -> Column:
    """Metric tag without `tower_N/` parts."""
    return F.regexp_replace(col(tag), TOWER, "")


def learning_rate(step, lr0: float = 0.1, factor: float = 0.1, decay_steps: int = 136_718) -> Column:
    """Staircase decay: lr0 * factor ^ floor(step / decay_steps)."""
    return F.lit(lr0) * F.pow(F.lit(factor), F.floor(col(step) / F.lit(decay_steps)))
