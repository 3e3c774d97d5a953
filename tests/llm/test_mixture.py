import math
from collections import Counter, defaultdict

import pytest

from check_oracle import compare
from llm_helpers import brute
from pyspark.sql import functions as F
from pixwave.llm import mixture as M


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare the excess by weight until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        part = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if part[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return {**part, **{s: most * sizes[s] for s in capped}}
        capped |= over


def many(spark):
    texts = [" ".join(f"w{j}" for j in range(5 + i * 7 % 200)) for i in range(120)]
    return brute.messy(spark, texts)


def test_targets_and_takes(spark):
    df = many(spark)
    rows = M.mix(df, block=16)[1].collect()
    assert len(rows) == df.count()
    given = df.select("doc_id", "source", "text").collect()
    sizes = defaultdict(int)
    for r in given:
        sizes[r.source] += len(brute.words(r.text))
    want = plain_targets(sizes)
    by_size = {v: k for k, v in sizes.items()}
    assert len(by_size) == len(sizes)
    taken = defaultdict(int)
    for r in rows:
        source = by_size[r.source_size]
        assert math.isclose(r.target, want[source], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 32
    assert sorted(map(str, M.mix(df, block=16)[1].collect())) == sorted(map(str, rows))


def test_spans_are_the_takes(spark):
    df = many(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    spans, rows = M.mix(df, block=16, shards=4)
    spans = spans.cache()
    texts = {r.doc_id: brute.words(r.text) for r in df.select("doc_id", "text").collect()}
    total = defaultdict(int)
    for r in M.mixed_texts(spans, df).collect():
        assert r.text.encode() == b" ".join(texts[r.ident][r["first"]:r["first"] + r.words])
        assert 0 <= r.shard < 4
        total[r.ident] += r.words
    assert dict(total) == {r.doc_id: r.taken for r in rows.collect() if r.taken}
    slots = spans.select("shard", "source", "pass", "index").distinct().groupBy("shard").count().collect()
    n = sum(r["count"] for r in slots)
    assert all(abs(r["count"] - n / 4) < 5 * math.sqrt(n / 4) for r in slots)
    spans.unpersist()


def test_texts_of_null_and_repeated_ids(spark):
    """The words of the texts are those taken, no more and no fewer, whatever the ids."""
    rows = [(None, "one two three four five", "a"), (7, "six seven", "a"), (7, "six seven", "a"), (7, "other words here", "b"), (None, None, "b"), (8, "", None),
            (9, " nine  ten ", None), (None, "one two three four five", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    spans, taken = M.mix(df, block=2, shards=3)
    texts = M.mixed_texts(spans, df).collect()
    assert all(len(r.text.split()) == r.words for r in texts)
    own = sum((Counter((r.source, w) for w in r.text.split()) for r in texts), Counter())
    assert sum(own.values()) == taken.agg(F.sum("taken")).first()[0] == sum(r.words for r in spans.collect())
    assert own["a", "six"] == own["a", "seven"] or abs(own["a", "six"] - own["a", "seven"]) <= 2
    assert set(own) <= {(s, w) for _, t, s in rows for w in (t or "").split()}


def test_one_source_and_no_words(spark):
    df = spark.createDataFrame([(1, "a b c", "s"), (2, None, "t"), (3, "", None)], "doc_id long, text string, source string")
    got = {r.doc_id: tuple(r)[1:] for r in M.mix(df)[1].collect()}
    assert got == {1: (3, 3, 4.5, 3), 2: (0, 0, 0.0, 0), 3: (0, 0, 0.0, 0)}
    assert M.mix(df.where("doc_id > 1"))[1].where("taken > 0 or target > 0").count() == 0


def test_empty_table(spark):
    spans, rows = M.mix(brute.empty(spark))
    assert rows.count() == 0 and spans.count() == 0


@pytest.mark.parametrize("block", [7, 64])
def test_sql(spark, block):
    import duckdb
    df = many(spark).select("doc_id", "text", "source")
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    cur = con.execute(M.mix_sql(block=block))
    out = M.mix(df, block=block)[1]
    assert not compare(out.columns, [tuple(r) for r in out.collect()], [d[0] for d in cur.description], cur.fetchall())


def test_no_python_in_the_plan(spark):
    plan = M.mix(many(spark))[1]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
