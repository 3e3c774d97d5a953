"""spark-submit job: train a classifier on prepared examples, or apply it.

    spark-submit --py-files pixwave.zip pixwave/jobs/train.py -i out/ -f tfr -m model/ --net cifar -e 10
    spark-submit --py-files pixwave.zip pixwave/jobs/train.py -i out/ -f tfr -m model/ --net cifar -X inference -o predictions/
"""

import argparse
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pixwave.functions.vectors import class_index
from pixwave.jobs.prepare import read_back
from pixwave.operators import images as prep
from pixwave.operators import batching, layers, pairing, scoring, training
from pixwave.session import build_session
from pixwave.sources import sinks, text


def arguments(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("-b", "--batch_size", type=int, default=100)
    p.add_argument("-e", "--epochs", type=int, default=1)
    p.add_argument("-f", "--format", choices=["csv", "csv2", "parquet", "tfr"], default="csv")
    p.add_argument("-i", "--images", required=True, help="examples from the prepare job, or a folder of CSV vectors")
    p.add_argument("-l", "--labels", help="folder of CSV label vectors, matched to the images by position")
    p.add_argument("-m", "--model", required=True, help="folder of the weights")
    p.add_argument("-o", "--output", default="predictions")
    p.add_argument("-s", "--steps", type=int, default=1000, help="maximum number of steps")
    p.add_argument("-X", "--mode", choices=["train", "inference", "evaluate"], default="train")
    p.add_argument("--net", choices=["softmax", "mlp", "cifar", "mnist-cnn", "audio", "audio-mlp"], default="cifar")
    p.add_argument("--shape", default="32,32,3", help="height, width, depth of the images")
    p.add_argument("--classes", type=int, default=10)
    p.add_argument("--optimizer", choices=["sgd", "adam"], default="adam")
    p.add_argument("--lr", type=float, default=1e-4)
    p.add_argument("--decay-steps", type=int, help="steps after which the rate falls by --decay-factor")
    p.add_argument("--decay-factor", type=float, default=0.1)
    p.add_argument("--ema", type=float, help="decay of the moving averages of the weights; they are then used to predict")
    p.add_argument("--shards", type=int, default=None, help="parts of the rows that learn by themselves in a round; the default grows with the rows")
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--distort", action="store_true", help="crop, flip and change the images each epoch")
    p.add_argument("--crop", type=int, default=24)
    p.add_argument("--bootstrap", action="store_true", help="draw `steps` batches with replacement")
    p.add_argument("--split", default="train")
    p.add_argument("--metrics", help="folder for the metric rows")
    p.add_argument("--evaluate-every", type=int, default=0, metavar="ROUNDS", help="evaluate the test split every so many rounds")
    p.add_argument("--test-split", default="test")
    return p.parse_args(argv)


def examples(spark: SparkSession, args, split: str | None = None) -> DataFrame:
    """example_id, height, width, depth, label, pixels of the chosen split."""
    split = split or args.split
    height, width, depth = (int(x) for x in args.shape.split(","))
    if args.labels:
        x, y = (text.read_csv_vectors(spark, folder, "double") for folder in (args.images, args.labels))
        if "split" in x.columns:
            x, y = (side.where(F.col("split") == split).drop("split") for side in (x, y))
        x, y = x.toDF("file", "block", "line", "pixels"), y.toDF("lfile", "lblock", "lline", "target")
        rows = pairing.zip_by_position(x, y, ["file", "block", "line"], ["lfile", "lblock", "lline"],
                                       bucket_a=F.struct("file", "block"), bucket_b=F.struct("lfile", "lblock"))
        rows = rows.select(F.col("idx").alias("example_id"), "pixels", class_index("target").alias("label"))
    else:
        rows = read_back(spark, args.images, args.format, split)
    return rows.withColumns({"height": F.lit(height), "width": F.lit(width), "depth": F.lit(depth)})


def network(args) -> dict:
    height, width, depth = (int(x) for x in args.shape.split(","))
    if args.net in ("softmax", "mlp"):
        build = layers.softmax_model if args.net == "softmax" else layers.mlp_model
        return build(height * width * depth, classes=args.classes)
    if args.net == "audio":
        return layers.audio_model(height, width, args.classes)
    if args.net == "audio-mlp":
        return layers.audio_mlp_model(height * width * depth, args.classes)
    if args.net == "mnist-cnn":
        return layers.mnist_cnn_model(height, width, args.classes)
    side = (args.crop, args.crop) if args.distort else (height, width)
    return layers.cifar_model(*side, depth, args.classes)


def main(argv=None, spark: SparkSession | None = None):
    args = arguments(argv)
    spark = spark or build_session("train")
    rows, model = examples(spark, args), network(args)
    sound = args.net.startswith("audio")
    if args.mode == "train":
        epochs = args.epochs
        if args.bootstrap:
            drawn = batching.bootstrap_batches(rows, args.batch_size, args.steps, args.seed)
            rows, epochs = drawn.withColumn("example_id", F.col("step") * args.batch_size + F.col("slot")), 1
        prepare = (lambda df, epoch: prep.distorted_inputs(df, args.seed, epoch, args.crop, args.crop)) \
            if args.distort else (lambda df, epoch: df if sound else prep.rescale_pixels(df))
        lr = training.decayed_rate(args.lr, args.decay_factor, args.decay_steps) if args.decay_steps else args.lr
        callbacks = [training.save_each_round(spark, args.model, model["name"])]
        if args.metrics:
            callbacks.append(training.metrics_each_round(spark, args.metrics, model["name"]))
        if args.evaluate_every:
            tested = examples(spark, args, args.test_split)
            ready = prep.eval_inputs(tested, args.crop, args.crop) if args.distort else tested if sound else prep.rescale_pixels(tested)
            results: list = []
            evaluate = training.evaluate_each_round(ready, model, results)

            def evaluated(trained):
                if trained.round % args.evaluate_every == 0:
                    evaluate(trained)
                    print("round: %d step: %d test accuracy: %.6f test loss: %.6f" % results[-1])

            callbacks.append(evaluated)
        trained = training.train_parallel(
            rows, model, args.optimizer, args.batch_size, epochs,
            args.shards, args.seed,
            callbacks, lr=lr, steps=args.steps, ema=args.ema, prepare=prepare)
        for round_no, step, tag, value in trained.metrics:
            print(f"{datetime.now().isoformat()} round: {round_no} step: {step} {tag}: {value:.6f}")
        if trained.round < epochs:
            print(f"stopped in epoch {trained.round} of {epochs} after {trained.step} steps (--steps {args.steps})")
        return trained
    trained = training.resume(spark, args.model, model["name"])
    params = trained.weights(averaged=bool(args.ema))
    if args.distort:
        ready = prep.eval_inputs(rows, args.crop, args.crop)
    else:
        ready = rows if sound else prep.rescale_pixels(rows)
    if args.mode == "evaluate":
        out = scoring.evaluate_model(ready, model, params, trained.step).first()
        print(out)
        return out
    predicted = scoring.predict_batches(ready, model, params)
    stamped = predicted.withColumn("ts", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    sinks.write_predictions(stamped.select("example_id", "ts", "label", "prediction"), args.output)
    return None


if __name__ == "__main__":
    main()
