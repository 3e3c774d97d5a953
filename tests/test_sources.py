import gzip
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.sources import files, records, sinks, text, tfrecord, wav


@pytest.fixture
def rng():
    return np.random.default_rng(5)


def test_fixed_records_over_files_and_ranges(spark, tmp_path, rng):
    data = rng.integers(0, 256, (100, 13), dtype=np.uint8)
    data[:60].tofile(tmp_path / "a.bin")
    data[60:].tofile(tmp_path / "b.bin")
    df = records.read_fixed_records(spark, str(tmp_path), (3, 2, 2), target_bytes=13 * 7)
    assert df.rdd.getNumPartitions() == 15
    rows = df.orderBy("example_id").collect()
    want = data[:, 1:].reshape(100, 3, 2, 2).transpose(0, 2, 3, 1).reshape(100, 12)
    assert [r.example_id for r in rows] == list(range(100)) and [r.label for r in rows] == data[:, 0].tolist()
    assert np.array_equal([r.pixels for r in rows], want) and rows[61].key.endswith("b.bin:1")


def test_fixed_records_columns(spark, tmp_path, rng):
    data = rng.integers(0, 256, (20, 13), dtype=np.uint8)
    data.tofile(tmp_path / "a.bin")
    df = records.read_fixed_records(spark, str(tmp_path), (3, 2, 2), columns=["label", "example_id"])
    assert df.columns == ["example_id", "label"]
    assert [r.label for r in df.orderBy("example_id").collect()] == data[:, 0].tolist()
    with pytest.raises(ValueError):
        records.read_fixed_records(spark, str(tmp_path), (3, 2, 2), columns=["other"])


def test_fixed_records_errors(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFound|nothing"):
        records.read_fixed_records(spark, str(tmp_path / "nothing")).count()
    (tmp_path / "x.bin").write_bytes(b"123")
    with pytest.raises(Exception, match="not whole records"):
        records.read_fixed_records(spark, str(tmp_path)).count()


def write_idx(path, images, labels, opener=open, image_magic=2051, count=None):
    n, h, w = images.shape
    with opener(path / "images", "wb") as f:
        f.write(struct.pack(">4I", image_magic, n, h, w) + images.tobytes())
    with opener(path / "labels", "wb") as f:
        f.write(struct.pack(">2I", 2049, count or n) + labels.tobytes())


@pytest.mark.parametrize("zipped", [False, True])
def test_idx(spark, tmp_path, rng, zipped):
    images, labels = rng.integers(0, 256, (50, 4, 3), dtype=np.uint8), rng.integers(0, 10, 50, dtype=np.uint8)
    write_idx(tmp_path, images, labels, gzip.open if zipped else open)
    paths = [str(tmp_path / n) for n in ("images", "labels")]
    if zipped:
        for p in paths:
            (tmp_path / (p + ".gz")).write_bytes(open(p, "rb").read())
        paths = [p + ".gz" for p in paths]
    rows = records.read_idx(spark, *paths, target_bytes=100).orderBy("idx").collect()
    assert np.array_equal([r.pixels for r in rows], images.reshape(50, -1))
    assert [r.label for r in rows] == labels.tolist() and (rows[0].height, rows[0].width) == (4, 3)
    assert records.read_idx(spark, paths[0]).count() == 50


def test_small_idx_files_share_a_task(spark, tmp_path, rng):
    for k in range(30):
        folder = tmp_path / f"f{k:02d}"
        folder.mkdir()
        write_idx(folder, rng.integers(0, 256, (3, 2, 4), dtype=np.uint8), rng.integers(0, 10, 3, dtype=np.uint8))
        (folder / "images").rename(tmp_path / f"images-{k:02d}")
        (folder / "labels").rename(folder / "unused")
        folder.rename(tmp_path / f"_{k}")
    out = records.read_idx(spark, str(tmp_path))
    assert out.rdd.getNumPartitions() == 1 and [r.example_id for r in out.orderBy("example_id").collect()] == list(range(90))


def test_idx_errors(spark, tmp_path, rng):
    images, labels = rng.integers(0, 256, (5, 2, 2), dtype=np.uint8), np.zeros(5, np.uint8)
    write_idx(tmp_path, images, labels, image_magic=2050)
    with pytest.raises(Exception, match="invalid magic number.*images"):
        records.read_idx(spark, str(tmp_path / "images"), str(tmp_path / "labels")).count()
    write_idx(tmp_path, images, labels, count=4)
    with pytest.raises(Exception, match="5 images but 4 labels"):
        records.read_idx(spark, str(tmp_path / "images"), str(tmp_path / "labels")).count()


def test_wav_chunks(spark, tmp_path, rng):
    samples = rng.integers(-3000, 3000, (1000, 2)).astype("<i2")
    for name, data in (("x", samples), ("empty", samples[:0])):
        with wave.open(str(tmp_path / f"{name}.wav"), "wb") as w:
            w.setnchannels(2)
            w.setsampwidth(2)
            w.setframerate(8000)
            w.writeframes(data.tobytes())
    df = wav.read_wav_chunks(spark, str(tmp_path), chunk=64, target_bytes=600)
    assert df.rdd.getNumPartitions() > 4
    one = df.filter("channel = 1 and n_frames > 0").orderBy("start_sample").collect()
    assert np.array_equal(np.concatenate([r.samples for r in one]), samples[:, 1])
    assert [r.chunk_no for r in one] == list(range(16)) and one[0].fs == 8000
    left = wav.read_wav_chunks(spark, str(tmp_path), chunk=64, channel=0)
    assert left.filter("n_frames > 0").count() == 16 and left.filter("n_frames = 0").count() == 1


def test_wav_rejects_other_widths(spark, tmp_path):
    with wave.open(str(tmp_path / "x.wav"), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(8000)
        w.writeframes(b"abc")
    with pytest.raises(Exception, match="16-bit"):
        wav.read_wav_chunks(spark, str(tmp_path)).count()


def test_tfrecords_round_trip(spark, tmp_path):
    big = 1 << 62
    df = spark.range(300).select(
        F.array(F.col("id"), F.col("id") * -1000, F.lit(300), F.lit(big)).alias("image"),
        F.when(F.col("id") > 0, F.array("id")).otherwise(F.array().cast("array<long>")).alias("label"))
    tfrecord.write_tfrecords(df, str(tmp_path / "t"))
    back = tfrecord.read_tfrecords(spark, str(tmp_path / "t"))
    rows = {r.image[0]: r for r in back.collect()}
    assert len(rows) == 300 and rows[7].image == [7, -7000, 300, big] and rows[7].label == [7] and rows[0].label == []
    assert not [p for p in (tmp_path / "t").iterdir() if p.name.startswith("_")]
    tfrecord.write_tfrecords(df.limit(2), str(tmp_path / "t"), mode="overwrite")
    assert tfrecord.read_tfrecords(spark, str(tmp_path / "t")).count() == 2


def test_tfrecord_checksums(spark, tmp_path):
    # published check value of CRC-32C over "123456789", masked
    crc = 0xE3069283
    masked = (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF
    assert tfrecord.masked_crcs([b"123456789", b"", b"1"])[0] == masked
    tfrecord.write_tfrecords(spark.range(3).select(F.array("id").alias("image"), F.array("id").alias("label")),
                             str(tmp_path / "t"))
    part = next((tmp_path / "t").iterdir())
    raw = bytearray(part.read_bytes())
    raw[14] ^= 1
    part.write_bytes(raw)
    with pytest.raises(Exception, match="checksum"):
        tfrecord.read_tfrecords(spark, str(tmp_path / "t")).collect()


def test_varints_and_unpacked_lists():
    values = np.array([0, 1, 127, 128, 300, 2**63 - 1, -1, -2**63])
    lists = tfrecord.encode_lists(values, np.array([3, 0, 4, 1]))
    assert [len(x) for x in lists] == [3, 0, 2 + 2 + 9 + 10, 10]
    assert np.array_equal(tfrecord.decode_varints(b"".join(lists)), values)
    assert tfrecord.decode_column([*lists, None]).to_pylist() == [[0, 1, 127], [], values[3:7].tolist(), [-2**63], None]
    assert tfrecord.varint(300) == tfrecord.encode_lists(np.array([300]), np.array([1]))[0]
    unpacked = b"".join(bytes([1 << 3]) + tfrecord.varint(v) for v in (5, 700))
    field = tfrecord._field
    message = field(1, field(1, field(1, b"label") + field(2, field(3, unpacked))))
    assert tfrecord.decode_varints(tfrecord.packed_lists(message)["label"]).tolist() == [5, 700]


def test_csv_vectors(spark, tmp_path):
    (tmp_path / "v").mkdir()
    (tmp_path / "v" / "a.txt").write_text("1,2,3\n\n4.5\n")
    rows = text.read_csv_vectors(spark, str(tmp_path / "v")).orderBy("file", "block", "line").collect()
    assert [r["values"] for r in rows] == [[1.0, 2.0, 3.0], [], [4.5]]
    (tmp_path / "v" / "a.txt").write_text("1,,3\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cast"):
        text.read_csv_vectors(spark, str(tmp_path / "v")).collect()


def test_csv_splits_go_to_their_own_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], [0.0, 1.0], "train"), (2, [3, 4], [1.0, 0.0], "test")],
                               "example_id long, pixels array<int>, target array<double>, split string")
    sinks.write_csv_vectors(df, str(tmp_path / "c"))
    back = {(r.example_id, r.split): r["values"]
            for r in text.read_csv_vectors(spark, str(tmp_path / "c" / "images"), "int", with_id=True).collect()}
    assert back == {(1, "train"): [1, 2], (2, "test"): [3, 4]}
    sinks.write_labelled_csv(df, str(tmp_path / "l"))
    rows = text.read_labelled_csv(spark, str(tmp_path / "l")).orderBy("target").collect()
    assert [(r.target, r.pixels) for r in rows] == [([0.0, 1.0], [1, 2]), ([1.0, 0.0], [3, 4])]


def test_subtitles(spark, tmp_path):
    (tmp_path / "ep1.Jap.ass").write_text(
        "before Sub-Jap,,a,,b\n; ---Sub-JP----\r\nDialogue: 0,0:01:02.50,0:01:04.00,Sub-Jap,,0,0,0,,hello\nfoo\n"
        "Dialogue: 0,1:01:02.50,1:01:04.00,Sub-Jap,,0,0,0,,he,,y\r\n", encoding="utf-8")
    (tmp_path / "none.ass").write_text("no marker Sub-Jap,,x,,y\n")
    rows = text.read_subtitles(spark, str(tmp_path)).orderBy("num").collect()
    assert [(r.episode, r.num, r.dialogue, r.start_tc) for r in rows] == [
        ("ep1.Jap", 0, "hello", "0:01:02.50"), ("ep1.Jap", 1, "he", "1:01:02.50")]


def test_checksums_of_short_and_long_records():
    from pixwave.sources.tfrecord import _crcs_together, masked_crcs
    messages = [bytes([i % 251]) * (100 + i % 7) for i in range(20_000)] + [b"x" * (2 << 20), b""]
    out = masked_crcs(messages)
    for i in (0, 5, 19_999, 20_000, 20_001):
        assert out[i] == _crcs_together([messages[i]])[0]
    assert masked_crcs([]).shape == (0,)


def weights(spark, step, chunks, parts):
    rows = [("m", step, "w", [2], c, parts, [float(step), float(c)]) for c in range(chunks)]
    return spark.createDataFrame(rows, sinks.WEIGHTS_SCHEMA)


def test_restore_takes_the_latest_complete_step(spark, tmp_path):
    path = str(tmp_path / "w")
    for step, chunks in ((1, 3), (2, 3), (3, 2)):
        sinks.checkpoint_weights(weights(spark, step, chunks, 3), path)
    sinks.checkpoint_weights(weights(spark, 2, 3, 3), path)
    rows = sinks.restore_weights(spark, path, "m").collect()
    assert {r.step for r in rows} == {2} and len(rows) == 3


def test_verify_and_predictions(spark, tmp_path):
    df = spark.createDataFrame([(i, [i], i % 3) for i in range(20)], "example_id long, pixels array<int>, label int")
    first = sinks.verify_examples(df).collect()
    assert len(first) == 10 and first[0].num_images == first[0].num_labels == 20
    with pytest.raises(Exception, match="differ in number"):
        sinks.verify_examples(df.withColumn("label", F.when(F.col("label") > 0, F.col("label")))).collect()
    sinks.write_predictions(df.select("example_id", F.lit("now").alias("ts"), "label", F.lit(1).alias("prediction")),
                            str(tmp_path / "p"))
    assert "now Label: 2, Prediction: 1" in {r.value for r in spark.read.text(str(tmp_path / "p/text")).collect()}


def test_pack_groups_small_and_cuts_large():
    tasks = files.pack([files.Slice("a", 0, 3, 0), files.Slice("b", 0, 10, 3)], 1, 5)
    assert [[(s.path, s.first, s.count, s.base) for s in t.slices] for t in tasks] == [
        [("a", 0, 3, 0), ("b", 0, 2, 3)], [("b", 2, 5, 5)], [("b", 7, 3, 10)]]


def test_paths_follow_the_default_file_system(spark):
    from types import SimpleNamespace

    def session(default):
        conf = SimpleNamespace(get=lambda key: default)
        return SimpleNamespace(sparkContext=SimpleNamespace(_jsc=SimpleNamespace(hadoopConfiguration=lambda: conf)))

    assert files.qualified(session("hdfs://nn:8020/"), "/a/b") == "hdfs://nn:8020/a/b"
    assert files.qualified(session("hdfs://nn:8020"), "s3a://x/y") == "s3a://x/y"
    assert files.qualified(spark, "/a/b") == "/a/b"
    assert files.filesystem("file:/tmp/x")[1] == "/tmp/x"


def _framed(messages):
    sizes = [len(m).to_bytes(8, "little") for m in messages]
    return [a + int(b).to_bytes(4, "little") + m + int(c).to_bytes(4, "little")
            for a, b, m, c in zip(sizes, tfrecord.masked_crcs(sizes), messages, tfrecord.masked_crcs(messages))]


def _examples(values):
    return [tfrecord.encode_example({"image": p, "label": p}) for p in
            tfrecord.encode_lists(np.concatenate([np.asarray(v) for v in values]), np.array([len(v) for v in values]))]


@pytest.mark.parametrize("target", [64, 1000, 5000, 70_000, 1 << 27])
def test_a_large_tfrecord_file_is_read_in_ranges(spark, tmp_path, target):
    r = np.random.default_rng(4)
    values = [r.integers(0, 1 << int(r.integers(1, 40)), int(r.integers(1, 60))) for _ in range(700)]
    (tmp_path / "a.tfrecord").write_bytes(b"".join(_framed(_examples(values[:600]))))
    (tmp_path / "b.tfrecord").write_bytes(b"".join(_framed(_examples(values[600:]))))
    (tmp_path / "c.tfrecord").write_bytes(b"")
    back = tfrecord.read_tfrecords(spark, str(tmp_path), target_bytes=target)
    got = [(x.file_no, x.record_no, x.image) for x in back.orderBy("file_no", "record_no").collect()]
    assert got == [(i >= 600, i - 600 * (i >= 600), v.tolist()) for i, v in enumerate(values)]
    size = (tmp_path / "a.tfrecord").stat().st_size
    assert back.rdd.getNumPartitions() >= min(500, size // target)
    few = back.where("file_no = 0 and record_no between 30 and 40")
    assert [x.record_no for x in few.orderBy("record_no").collect()] == list(range(30, 41)) and back.count() == 700


def test_records_that_hold_records_are_told_apart(spark, tmp_path):
    """Payloads that are whole record files themselves: looking for a boundary meets theirs first."""
    inner = b"".join(_framed(_examples([[i, i + 1] for i in range(200)])))
    inside = np.frombuffer(inner, np.uint8).astype(np.int64) % 128  # small varints are single bytes
    plain = _examples([[1, 2, 3]] * 5)
    hidden = [tfrecord.encode_example({"label": tfrecord.varint(7), "image": tfrecord.varint(9)}) + tfrecord._field(15, inner) for _ in range(6)]
    (tmp_path / "a.tfrecord").write_bytes(b"".join(_framed([*plain, *hidden, *plain])))
    rows = tfrecord.read_tfrecords(spark, str(tmp_path), target_bytes=1500).orderBy("record_no").collect()
    assert [x.record_no for x in rows] == list(range(16)) and len(inside)
    assert [x.label for x in rows] == [[1, 2, 3]] * 5 + [[7]] * 6 + [[1, 2, 3]] * 5


@pytest.mark.parametrize("place", ["length", "payload", "end", "cut"])
def test_damaged_ranges_fail(spark, tmp_path, place):
    parts = _framed(_examples([[i] * 20 for i in range(400)]))
    raw = bytearray(b"".join(parts))
    at = sum(map(len, parts[:250]))
    if place in ("length", "payload"):
        raw[at + (1 if place == "length" else 20)] ^= 1
    (tmp_path / "a.tfrecord").write_bytes(bytes(raw[:-3] if place == "end" else raw[:at + 5] if place == "cut" else raw))
    with pytest.raises(Exception, match="ends early|wrong|mismatch"):
        tfrecord.read_tfrecords(spark, str(tmp_path), target_bytes=2000).collect()


def test_idx_columns_and_filters_of_one_frame(spark, tmp_path):
    """Columns leave out the pixels; a frame gives all its rows also after a filtered one was made from it."""
    (tmp_path / "img").mkdir()
    (tmp_path / "lab").mkdir()
    word = lambda *n: b"".join(x.to_bytes(4, "big") for x in n)
    for name, count in (("a", 40), ("b", 20)):
        (tmp_path / "img" / name).write_bytes(word(2051, count, 2, 2) + bytes(range(count)) * 4)
        (tmp_path / "lab" / name).write_bytes(word(2049, count) + bytes(i % 10 for i in range(count)))
    idx = records.read_idx(spark, str(tmp_path / "img"), str(tmp_path / "lab"), target_bytes=40)
    assert idx.where(F.col("file") == f"{tmp_path}/img/b").count() == 20 and idx.count() == 60
    labels = records.read_idx(spark, str(tmp_path / "img"), str(tmp_path / "lab"), columns=["example_id", "label"])
    assert labels.columns == ["example_id", "label"]
    assert sorted(tuple(r) for r in labels.collect()) == sorted((r.example_id, r.label) for r in idx.collect())
    (tmp_path / "wav").mkdir()
    for name in ("x.wav", "y.wav"):
        with wave.open(str(tmp_path / "wav" / name), "wb") as f:
            f.setnchannels(3)
            f.setsampwidth(2)
            f.setframerate(100)
            f.writeframes(np.arange(300, dtype="<i2").tobytes())
    sound = wav.read_wav_chunks(spark, str(tmp_path / "wav"), chunk=10, target_bytes=200)
    assert sound.where(F.col("file").endswith("y.wav") & (F.col("channel") == 1)).count() == 10 and sound.count() == 60
