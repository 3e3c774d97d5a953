import pytest
from pyspark.sql import functions as F

from pixwave.functions.hashing import hash_uniform
from pixwave.operators import batching, index, pairing


def ids(spark, n, parts=4):
    return spark.range(n).repartition(parts).select(F.col("id").alias("example_id"))


@pytest.mark.parametrize("parts", [1, 4, 13])
def test_index_does_not_depend_on_partitions(spark, parts):
    df = ids(spark, 1000, parts).select((F.col("example_id") * 7 - 900).alias("k"))
    out = index.global_index(df, "k", block=50, total="n")
    assert out.filter((F.col("idx") * 7 - 900 != F.col("k")) | (F.col("n") != 1000)).count() == 0


def test_index_within_a_hot_group(spark):
    df = ids(spark, 3000).withColumn("g", F.when(F.col("example_id") % 3 == 0, 0).otherwise(F.col("example_id") % 50))
    rows = index.global_index(df, "example_id", by=["g"], block=100).collect()
    seen = {}
    for r in sorted(rows, key=lambda r: r.example_id):
        assert r.idx == seen.get(r.g, 0)
        seen[r.g] = r.idx + 1
    assert len(rows) == 3000


def test_index_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    assert index.global_index(df, "k").count() == 3


def test_shuffle_is_a_repeatable_permutation(spark):
    a = {r.example_id: r["rank"] for r in batching.shuffle_epoch(ids(spark, 500, 1), seed=1, buckets=7).collect()}
    b = {r.example_id: r["rank"] for r in batching.shuffle_epoch(ids(spark, 500, 9), seed=1, buckets=64).collect()}
    c = {r.example_id: r["rank"] for r in batching.shuffle_epoch(ids(spark, 500), seed=1, epoch=1).collect()}
    assert a == b and a != c and sorted(a.values()) == list(range(500)) == sorted(c.values())


def test_batches_wrap_over_the_epoch_border(spark):
    rows = batching.assign_batches(ids(spark, 10), 4, 2).collect()
    sizes, second = {}, []
    for r in rows:
        sizes[r.step] = sizes.get(r.step, 0) + 1
        if r.step == 2:
            second.append((r.slot, r.epoch))
    assert sizes == {0: 4, 1: 4, 2: 4, 3: 4, 4: 4}
    assert sorted(second) == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_partial_batches(spark):
    rows = batching.assign_batches(ids(spark, 10), 4, 1, policy="partial", shuffle=False).collect()
    assert sorted((r.step, r.slot) for r in rows) == [(i // 4, i % 4) for i in range(10)]
    assert all(r.example_id == r.step * 4 + r.slot for r in rows)
    with pytest.raises(ValueError):
        batching.assign_batches(ids(spark, 10), 4, policy="drop")


def test_bootstrap_draws_with_replacement(spark):
    rows = batching.bootstrap_batches(ids(spark, 40), 25, 8, seed=3).collect()
    assert len(rows) == 200 and {(r.step, r.slot) for r in rows} == {(s, k) for s in range(8) for k in range(25)}
    assert len({r.example_id for r in rows}) <= 40


def test_epochs_and_preview(spark):
    assert batching.repeat_epochs(ids(spark, 5), 3).count() == 15
    assert batching.repeat_epochs(ids(spark, 5), 0).count() == 0
    assert [r.example_id for r in batching.preview(ids(spark, 50)).collect()] == list(range(10))


def test_zip_pairs_by_position_and_rejects_unequal_sides(spark):
    a = ids(spark, 10).withColumnRenamed("example_id", "a")
    b = ids(spark, 10).select((F.col("example_id") * 5).alias("b"))
    assert [(r.a, r.b) for r in pairing.zip_by_position(a, b, "a", "b", block=3).orderBy("idx").collect()] == [
        (i, 5 * i) for i in range(10)]
    for left, right in ((a, b.filter("b < 45")), (a.filter("a > 0"), b), (a, b.limit(0))):
        with pytest.raises(Exception, match="no partner at position"):
            pairing.zip_by_position(left, right, "a", "b").count()
    with pytest.raises(ValueError):
        pairing.zip_by_position(a, a, "a", "a")


def test_split_sizes(spark):
    assert pairing.split_validation(ids(spark, 10), 0).filter("split = 'train'").count() == 10
    assert pairing.split_validation(ids(spark, 10), 10).filter("split = 'validation'").count() == 10
    with pytest.raises(Exception, match="exceeds the number of rows"):
        pairing.split_validation(ids(spark, 10), 11).collect()
    with pytest.raises(ValueError):
        pairing.split_validation(ids(spark, 10), -1)


def test_labels(spark):
    df = spark.createDataFrame([("/a/x/1.wav",), ("/a/y/2.wav",), ("/a/z/3.wav",)], "p string")
    out = {r.p: r.label for r in pairing.label_from_path(df, "p", ["y", "x"]).collect()}
    assert out == {"/a/x/1.wav": 1, "/a/y/2.wav": 0}


def test_union_keeps_the_source(spark):
    out = pairing.union_batches(ids(spark, 3), ids(spark, 2), source="batch")
    assert sorted((r.batch, r.example_id) for r in out.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]


def test_explode_batches_checks_lengths(spark):
    df = spark.createDataFrame([(0, [[1, 2], [3, 4]], [5, 6])], "batch int, data array<array<int>>, labels array<int>")
    assert [tuple(r) for r in batching.explode_batches(df).collect()] == [(0, 0, [1, 2], 5), (0, 1, [3, 4], 6)]
    with pytest.raises(Exception, match="differ in number"):
        batching.explode_batches(df.withColumn("labels", F.array(F.lit(1)))).collect()


def test_uniform_draws(spark):
    u = [r.u for r in spark.range(2000).select(hash_uniform(0, 0, "t", "id").alias("u")).collect()]
    assert 0 <= min(u) and max(u) < 1 and abs(sum(u) / 2000 - 0.5) < 0.03


def test_index_counts_null_groups_and_keys_like_a_window(spark):
    rows = [(g, k) for g in (None, 1, 2) for k in (None, 5, 3, 400, -7)]
    df = spark.createDataFrame(rows, "g int, k long").repartition(3)
    df.createOrReplaceTempView("grouped")
    want = spark.sql("""SELECT g, k, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n
                        FROM grouped""").collect()
    got = index.global_index(df, "k", by=["g"], block=2, total="n").collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("gap", [1, 1 << 20, 1 << 47])
def test_sparse_keys_are_no_window_over_all_buckets(spark, gap):
    df = spark.range(5000).select(((F.col("id") - 2500) * gap).alias("k")).repartition(4)
    out = index.global_index(df, "k", total="n")
    assert out.filter((F.col("idx") != F.col("k") / gap + 2500) | (F.col("n") != 5000)).count() == 0
    # the top level has one bucket per 2^49 values, so at most 2^15 rows
    assert out.select(F.shiftright(F.floor(F.col("k") / (1 << 17)), 32)).distinct().count() <= 1 << 15


def test_draws_reach_every_row_of_a_large_table(spark):
    u = spark.range(5000).select((hash_uniform(0, 0, "t", "id") * (1 << 40)).alias("u")).collect()
    assert len({int(r.u) % 1024 for r in u}) > 1000 and any(r.u != int(r.u) for r in u)


def test_scratch_goes_to_the_folder_the_cluster_names():
    from types import SimpleNamespace

    from pixwave.session import shared_dir

    def session(folder, master):
        context = SimpleNamespace(master=master, getConf=lambda: {}, getCheckpointDir=lambda: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder or default))

    assert shared_dir(session("hdfs:///shared/", "yarn"), "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"), "x")
