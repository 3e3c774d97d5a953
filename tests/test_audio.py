import numpy as np
import pytest
from pyspark.sql import functions as F

from pixwave.functions import text
from pixwave.operators import audio


def chunks(spark, waves: dict, chunk: int, fs: int = 160):
    rows = []
    for name, x in waves.items():
        for k in range(0, max(1, len(x)), chunk):
            rows.append((name, fs, 0, len(x), k // chunk, k, [float(v) for v in x[k:k + chunk]]))
    return spark.createDataFrame(
        rows, "file string, fs int, channel int, n_frames long, chunk_no long, start_sample long, samples array<double>")


def frames_of(x, fs, tres=100):
    """Brute force: one frame after the other with an explicit transform."""
    length = int(np.floor(tres / 1000 * fs))
    hop = length - length // 2
    w = np.hanning(length)
    out = []
    for k in range(max(0, (len(x) - length // 2) // hop)):
        f = x[k * hop:k * hop + length]
        spec = np.array([((f - f.mean()) * w * np.exp(-2j * np.pi * b * np.arange(length) / length)).sum()
                         for b in range(length // 2 + 1)])
        p = np.abs(spec) ** 2 / (fs * (w ** 2).sum())
        p[1:(length + 1) // 2] *= 2
        out.append(p)
    return out


@pytest.mark.parametrize("chunk", [5, 16, 23, 64, 1000])
@pytest.mark.parametrize("fs", [160, 150])
def test_spectrogram_does_not_depend_on_chunks(spark, chunk, fs):
    rng = np.random.default_rng(chunk)
    waves = {f"f{n}": rng.normal(size=n) for n in (0, 7, 15, 16, 23, 24, 100, 131)}
    out = {}
    for r in audio.spectrogram(chunks(spark, waves, chunk, fs)).collect():
        assert (r.file, r.frame) not in out
        out[r.file, r.frame] = r.psd
    want = {(n, k): p for n, x in waves.items() for k, p in enumerate(frames_of(x, fs))}
    assert out.keys() == want.keys() and all(np.allclose(out[k], want[k]) for k in want)


def pieces(spark, total, m, tail):
    rows = [("f", total, k, [float(10 * k), float(10 * k + 1)]) for k in range(total)]
    df = spark.createDataFrame(rows, "file string, frame_count long, frame long, psd array<double>")
    out = {r.piece_no: np.array(r["values"]).reshape(r.n_freq, r.n_time)
           for r in audio.spectrogram_pieces(df, m, tail).collect()}
    return [out[k][0] / 10 for k in sorted(out)]


def test_pieces(spark):
    assert len(pieces(spark, 28, 28, "correct")) == 1
    two = pieces(spark, 28, 28, "reference")
    assert len(two) == 2 and np.array_equal(two[0], two[1])
    two = pieces(spark, 30, 28, "correct")
    assert two[0].tolist() == list(range(28)) and two[1].tolist() == list(range(2, 30))
    assert pieces(spark, 27, 28, "correct") == []
    assert len(pieces(spark, 30, 5, "reference")) == 6  # 6 * 6 >= 30
    with pytest.raises(ValueError):
        pieces(spark, 30, 5, "other")


def test_crop_and_short_files(spark):
    df = spark.createDataFrame([("a", 55, 160), ("b", 56, 160), ("c", 57, 160)], "file string, n_frames long, fs int")
    # 56 / 160 lies just below (6 + 1) * 0.05 in double arithmetic
    assert [r.file for r in audio.filter_short_audio(df, 6).collect()] == ["c"]
    assert audio.count_short_audio(df, 6).first().dropped == 2
    row = spark.createDataFrame([([1.0] * 9,)], "psd array<double>")
    assert len(audio.crop_frequencies(row, 50).first().psd) == 5


@pytest.mark.parametrize("chunk", [4, 7, 100])
def test_clips_match_slices(spark, chunk):
    waves = {"a": np.arange(50.0), "b": np.arange(100.0, 123.0)}
    spans = [("a", 0, 0, 5), ("a", 1, 3, 49), ("a", 2, 10, 10), ("a", 3, 20, 10), ("a", 4, 45, 10**12),
             ("a", 5, 60, 70), ("b", 6, 0, 23), ("b", 7, 22, 24), ("c", 8, 0, 5), ("a", 9, -10, 45), ("a", 10, 40, -2)]
    df = spark.createDataFrame([(f, n, f"line\\{n}", s, e) for f, n, s, e in spans],
                               "file string, num long, dialogue string, start_sample long, end_sample long")
    out = {}
    for r in audio.extract_clips(df, chunks(spark, waves, chunk), chunk).orderBy("num", "part_no").collect():
        out.setdefault(r.num, []).extend(r.samples)
        assert r.name == f"{r.num:04d} - line{r.num}.wav"
    for f, n, s, e in spans:
        want = waves.get(f, np.zeros(0))[s:e].tolist()
        assert out[n] == want, (n, s, e)


def test_timecodes_and_names(spark):
    df = spark.createDataFrame([("0:01:02.50", "1:01:04.00", 12345)], "start_tc string, end_tc string, num int")
    right = audio.timecode_to_sample(df, 100).first()
    old = audio.timecode_to_sample(df, 100, "reference").first()
    assert (right.start_sample, right.end_sample) == (6250, 366400) and old.end_sample == 6400
    names = df.select(text.clip_name("num", F.lit("a\\b")).alias("a"), text.clip_name(F.lit(7), F.lit("x")).alias("b")).first()
    assert tuple(names) == ("12345 - ab.wav", "0007 - x.wav")
    with pytest.raises(ValueError):
        audio.timecode_to_sample(df, 100, "other")


def test_pack_and_channel(spark):
    df = spark.range(10).select(F.lit("f").alias("file"), F.col("id").alias("pos"), (F.col("id") * 2.0).alias("v"),
                                F.lit(10).alias("n_frames"))
    rows = audio.pack_samples(df, "file", "pos", "v", 160, 4).orderBy("chunk_no").collect()
    assert [r.samples for r in rows] == [[0.0, 2.0, 4.0, 6.0], [8.0, 10.0, 12.0, 14.0], [16.0, 18.0]]
    assert {r.n_frames for r in rows} == {10} and audio.select_channel(spark.createDataFrame(rows), 1).count() == 0
