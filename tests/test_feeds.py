import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.operators import images, layers, scoring, training
from pixwave.plans.fixtures import img8
from pixwave.sources import records, sinks, tfrecord
from pixwave.streaming import feeds, learning

MODEL = layers.softmax_model(64)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return img8(spark, sf_dir).where("example_id < 300").cache()


def all_of(spark, feed, tmp_path, name):
    """What a feed gives until its files are done."""
    out = str(tmp_path / f"out-{name}")
    feed.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / f"state-{name}")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def contents(df):
    return sorted((r.label, tuple(int(x) for x in r.pixels)) for r in df.select("label", "pixels").collect())


def test_scoring_a_tfrecord_feed_equals_the_batch_after_a_failure(spark, rows, tmp_path):
    """Five files, two a micro-batch; the third is damaged at first, and the query is started again when it is whole."""
    examples = rows.select(F.col("pixels").alias("image"), F.array("label").alias("label"), F.array("example_id").alias("id"))
    tfrecord.write_tfrecords(examples.repartition(5), str(tmp_path / "all"), ["image", "label", "id"])
    files = sorted(f for f in os.listdir(tmp_path / "all") if f.endswith(".tfrecord"))
    assert len(files) == 5
    (tmp_path / "in").mkdir()
    for i, name in enumerate(files):
        shutil.copy(tmp_path / "all" / name, tmp_path / "in" / name)
        os.utime(tmp_path / "in" / name, (1_700_000_000 + i, 1_700_000_000 + i))
    raw = (tmp_path / "in" / files[2]).read_bytes()
    (tmp_path / "in" / files[2]).write_bytes(raw[:-5])
    os.utime(tmp_path / "in" / files[2], (1_700_000_002, 1_700_000_002))
    params = {"w0": np.arange(640.0).reshape(64, 10) % 7 - 3, "b0": np.arange(10) / 10}

    def score():
        feed = feeds.tfrecord_feed(spark, str(tmp_path / "in"), (8, 8, 1), ident="id", files_per_trigger=2)
        learning.stream_score(spark, "", str(tmp_path / "out"), MODEL, params, checkpoint=str(tmp_path / "state"), feed=feed)

    with pytest.raises(Exception, match="ends early"):
        score()
    done = spark.read.parquet(str(tmp_path / "out")).count()
    assert 0 < done < rows.count()
    (tmp_path / "in" / files[2]).write_bytes(raw)
    os.utime(tmp_path / "in" / files[2], (1_700_000_002, 1_700_000_002))
    score()
    score()  # nothing new
    got = sorted((r.example_id, r.label, r.prediction) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.example_id, r.label, r.prediction) for r in scoring.predict_batches(rows.withColumn("pixels", F.col("pixels").cast("array<double>")), MODEL, params).collect())
    assert got == want


def test_training_on_a_tfrecord_feed_equals_a_round(spark, rows, tmp_path):
    examples = rows.select(F.col("pixels").alias("image"), F.array("label").alias("label"), F.array("example_id").alias("id"))
    tfrecord.write_tfrecords(examples.repartition(3), str(tmp_path / "in"), ["image", "label", "id"])
    feed = images.rescale_pixels(feeds.tfrecord_feed(spark, str(tmp_path / "in"), (8, 8, 1), ident="id", files_per_trigger=10))
    options = dict(size=30, shards=3, lr=0.1, seed=2)
    learning.stream_train(spark, "", MODEL, None, str(tmp_path / "w"), checkpoint=str(tmp_path / "state"), feed=feed, **options)
    state = training.saved_state(spark, str(tmp_path / "w"), "softmax")[0].state
    one = training.train_parallel(images.rescale_pixels(rows), MODEL, "sgd", 30, 1, 3, 2, lr=0.1)
    assert state.keys() == one.state.keys() and all((state[k] == one.state[k]).all() for k in state)


def test_record_and_csv_feeds(spark, rows, tmp_path):
    data = [(r.label, list(r.pixels)) for r in rows.orderBy("example_id").collect()]
    (tmp_path / "rec").mkdir()
    for i in range(3):
        part = data[i * 100:(i + 1) * 100]
        (tmp_path / "rec" / f"data_{i}.bin").write_bytes(b"".join(bytes([label, *map(int, pixels)]) for label, pixels in part))
    feed = feeds.record_feed(spark, str(tmp_path / "rec"), (1, 8, 8), files_per_trigger=2, target_bytes=1000)
    got = all_of(spark, feed, tmp_path, "rec")
    batch = records.read_fixed_records(spark, str(tmp_path / "rec"), (1, 8, 8))
    assert contents(got) == contents(batch) == sorted((label, tuple(map(int, p))) for label, p in data)
    assert got.select("example_id").distinct().count() == 300 and {(r.height, r.width, r.depth) for r in got.collect()} == {(8, 8, 1)}
    sinks.write_labelled_csv(images.one_hot(rows), str(tmp_path / "csv"))
    lines = all_of(spark, feeds.csv_feed(spark, str(tmp_path / "csv"), (8, 8, 1)), tmp_path, "csv")
    assert contents(lines) == contents(batch)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.bin").write_bytes(b"x" * 66)
    with pytest.raises(Exception, match="whole records"):
        all_of(spark, feeds.record_feed(spark, str(tmp_path / "bad"), (1, 8, 8)), tmp_path, "bad")


@pytest.mark.parametrize("zipped", [False, True])
def test_idx_feed(spark, rows, tmp_path, zipped):
    import gzip
    data = [(r.label, list(r.pixels)) for r in rows.orderBy("example_id").collect()]
    folder, end = tmp_path / "idx", ".gz" if zipped else ""
    folder.mkdir()
    pack = gzip.compress if zipped else bytes
    for name, part in (("train", data[:170]), ("t10k", data[170:])):
        head = lambda *words: b"".join(int(w).to_bytes(4, "big") for w in words)
        (folder / f"{name}-labels-idx1-ubyte{end}").write_bytes(pack(head(2049, len(part)) + bytes(label for label, _ in part)))
        (folder / f"{name}-images-idx3-ubyte{end}").write_bytes(pack(head(2051, len(part), 8, 8) + b"".join(bytes(map(int, p)) for _, p in part)))
    got = all_of(spark, feeds.idx_feed(spark, str(folder), files_per_trigger=1, target_bytes=777), tmp_path, "idx")
    assert contents(got) == sorted((label, tuple(map(int, p))) for label, p in data)
    assert got.select("example_id").distinct().count() == 300
