import wave

import numpy as np
import pytest

from pixwave.jobs import audio, prepare, train
from pixwave.sources import sinks


@pytest.fixture(scope="module")
def dataset(tmp_path_factory):
    folder = tmp_path_factory.mktemp("data")
    rng = np.random.default_rng(0)
    for name, n in (("data_batch_1.bin", 40), ("data_batch_2.bin", 20), ("test_batch.bin", 15)):
        data = rng.integers(0, 256, (n, 1 + 8 * 8 * 3), dtype=np.uint8)
        data[:, 0] %= 10
        data.tofile(folder / name)
    return str(folder)


@pytest.mark.parametrize("fmt", ["csv", "csv2", "parquet", "tfr"])
def test_prepare_train_and_infer(spark, dataset, tmp_path, capsys, fmt):
    out, model = str(tmp_path / "examples"), str(tmp_path / "model")
    prepare.main(["-i", dataset, "-o", out, "-f", fmt, "--shape", "3,8,8", "-n", "3", "-v"], spark)
    assert "num_images: 60" in capsys.readouterr().out
    common = ["-i", out, "-f", fmt, "-m", model, "--net", "softmax", "--shape", "8,8,3"]
    trained = train.main([*common, "-b", "10", "-e", "2", "--shards", "2", "--lr", "0.01", "--metrics",
                          str(tmp_path / "metrics")], spark)
    assert trained.round == 2
    assert spark.read.parquet(str(tmp_path / "metrics")).filter("tag not like '%/%'").count() == 6
    train.main([*common, "-X", "inference", "--split", "test", "-o", str(tmp_path / "pred")], spark)
    lines = spark.read.text(str(tmp_path / "pred/text")).collect()
    assert len(lines) == 15 and all(" Label: " in r.value and ", Prediction: " in r.value for r in lines)
    assert train.main([*common, "-X", "evaluate"], spark).n == 60


def test_splits_hold_their_own_rows(spark, dataset, tmp_path):
    out = str(tmp_path / "examples")
    prepare.main(["-i", dataset, "-o", out, "-f", "parquet", "--shape", "3,8,8"], spark)
    counts = {r.split: r["count"] for r in spark.read.parquet(out).groupBy("split").count().collect()}
    assert counts == {"train": 60, "test": 15}


def test_train_on_vectors_paired_by_position(spark, tmp_path):
    for name, lines in (("images", [f"{i},{i + 1},0,0" for i in range(12)]),
                        ("labels", ["1.0,0.0" if i % 2 else "0.0,1.0" for i in range(12)])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-0").write_text("\n".join(lines[:7]) + "\n")
        (tmp_path / name / "part-1").write_text("\n".join(lines[7:]) + "\n")
    args = train.arguments(["-i", str(tmp_path / "images"), "-l", str(tmp_path / "labels"), "-m", str(tmp_path / "m"),
                            "--net", "mlp", "--shape", "2,2,1", "--classes", "2", "-b", "4", "--shards", "2"])
    rows = train.examples(spark, args).collect()
    assert sorted((r.pixels[0], r.label) for r in rows) == [(float(i), 0 if i % 2 else 1) for i in range(12)]


def test_distorted_training(spark, dataset, tmp_path, capsys):
    out, model = str(tmp_path / "examples"), str(tmp_path / "model")
    prepare.main(["-i", dataset, "-o", out, "-f", "parquet", "--shape", "3,8,8"], spark)
    common = ["-i", out, "-f", "parquet", "-m", model, "--net", "cifar", "--shape", "8,8,3", "--distort", "--crop", "6"]
    assert train.main([*common, "-b", "10", "--shards", "2", "-s", "2", "--decay-steps", "1", "--ema", "0.9"], spark).step == 2
    assert train.main([*common, "-X", "evaluate", "--split", "test", "--ema", "0.9"], spark).n == 15
    capsys.readouterr()
    train.main([*common[:4], "-m", model + "2", *common[6:], "-b", "50", "--shards", "2", "-e", "2", "--evaluate-every", "1"], spark)
    assert capsys.readouterr().out.count("test accuracy") == 2
    assert sinks.restore_weights(spark, model, "cifar").first().step == 2


def write_wav(path, seconds, fs=400, channels=2, seed=0):
    samples = np.random.default_rng(seed).integers(-9000, 9000, (int(seconds * fs), channels)).astype("<i2")
    path.parent.mkdir(parents=True, exist_ok=True)
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(fs)
        w.writeframes(samples.tobytes())
    return samples


def test_audio_jobs_read_the_samples_once(spark, tmp_path):
    write_wav(tmp_path / "wav" / "a" / "x.wav", 5)
    (tmp_path / "s.ass").write_text("---Sub-JP----\nDialogue: 0,0:00:01.50,0:00:04.00,Sub-Jap,,0,0,0,,a\n")
    args = audio.arguments(["clip", "-i", str(tmp_path / "wav"), "--subtitles", str(tmp_path / "s.ass"), "-o", "x"])
    plan = audio.clips(spark, args)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan pixwave_wav[") == 1 and plan.count("BatchScan pixwave_wav_files[") >= 1


def test_clips_by_subtitles(spark, tmp_path):
    samples = write_wav(tmp_path / "wav" / "ep 1.wav", 10)
    (tmp_path / "subs").mkdir()
    (tmp_path / "subs" / "ep 1.ass").write_text(
        "---Sub-JP----\nDialogue: 0,0:00:01.50,0:00:04.00,Sub-Jap,,0,0,0,,a\\Nb\n"
        "Dialogue: 0,0:00:09.00,0:00:20.00,Sub-Jap,,0,0,0,,end\n")
    audio.main(["clip", "-i", str(tmp_path / "wav"), "--subtitles", str(tmp_path / "subs"), "-o", str(tmp_path / "out"),
                "--chunk", "333"], spark)
    got = {}
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("num", "part_no").collect():
        got.setdefault(r.name, []).extend(r.samples)
        assert r.episode == "ep 1"
    assert got == {"0000 - aNb.wav": samples[600:1600, 0].tolist(), "0001 - end.wav": samples[3600:, 0].tolist()}


def test_audio_tree_to_trained_classifier(spark, tmp_path):
    for k, name in enumerate(["anna", "ben", "other"]):
        for n in range(3):
            write_wav(tmp_path / "tree" / name / f"{n}.wav", 1.0 + n * 0.7, seed=k * 10 + n)
    write_wav(tmp_path / "tree" / "anna" / "short.wav", 0.2)
    out = str(tmp_path / "pieces")
    audio.main(["pieces", "-i", str(tmp_path / "tree"), "--classes", "ben,anna", "-o", out, "--mintime", "8",
                "--max-frequency", "200", "--chunk", "111"], spark)
    rows = spark.read.parquet(out).collect()
    # frames of 40 samples, 20 apart: 400, 680, 960 samples give 19, 33, 47 frames
    assert len(rows) == 2 * (3 + 5 + 6) and sorted(r.example_id for r in rows) == list(range(28))
    assert {(r.label, "anna" in r.file) for r in rows} == {(0, False), (1, True)}
    assert all(len(r.pixels) == 20 * 8 and (r.height, r.width) == (20, 8) for r in rows)
    trained = train.main(["-i", out, "-f", "parquet", "-m", str(tmp_path / "m"), "--net", "audio-mlp", "--shape", "20,8,1",
                          "--classes", "2", "--bootstrap", "-b", "5", "-s", "6", "--shards", "2"], spark)
    assert 1 <= trained.step <= 6
