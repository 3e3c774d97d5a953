import datetime as dt
import random

import duckdb
import pytest

from check_oracle import compare
from llm_helpers import brute
from pixwave.llm import license_scan as L
from pixwave.llm import url_filter as U
from pyspark.sql import functions as F


def day(n, s=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, seconds=s)


def keys(url, depth=9):
    import re
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^?#]*)", url or "")
    if not m or not m[1]:
        return set()
    host = re.sub(r"^www\.|\.$", "", m[1].lower())
    labels, steps = host.split("."), [s for s in m[2].split("/") if s]
    return {".".join(labels[i:]) for i in range(len(labels))} | {"/".join([host, *steps[:i + 1]]) for i in range(len(steps))}


def test_lists_as_of_the_fetch(spark):
    r = random.Random(6)
    patterns = ["example.com", "a.example.com", "www.b.org", "b.org/x", "b.org/x/y/", "C.net", "a.example.com/en"]
    entries = [(r.choice("pq"), r.choice(patterns), r.choice(["add", "remove"]), day(r.randint(0, 200), r.choice([0, 0, 5])), "z") for _ in range(150)]
    entries += [(None, "c.net", "add", day(0), "z"), ("p", None, "add", day(0), "z"), ("p", "c.net", None, day(0), "z"),
                ("p", "c.net", "other", day(0), "z"), ("p", "c.net", "add", None, "z"), ("p", "", "add", day(0), "z"), entries[0], entries[0]]
    urls = ["http://example.com/", "HTTPS://www.A.example.com:8080/en/1?q#f", "http://u@b.org/x", "http://b.org/x/y/z", "http://b.org/xy", "http://c.net.",
            "ftp://x.c.net/a", "not a url", "", None, "http://", "http://notexample.com", "http://b.org/" + "x/" * 3000]
    captures = [(i, r.choice(urls), day(r.randint(-5, 260), r.choice([0, 5, 9])), "l", "k", 1) for i in range(200)]
    captures += [(None, urls[0], None, None, None, None), captures[0], captures[0], (7, None, day(3), None, None, None)]
    c = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp, lists string, key string, active int")
    e = spark.createDataFrame(entries, "list string, pattern string, action string, at timestamp, url string")
    out = U.judged(c, e, salts=3)
    assert set(out.columns) == set(c.columns)

    def active(url, at):
        state = {}
        for name, p, action, when, _ in sorted((x for x in entries if None not in x and x[1]), key=lambda x: (x[3], x[2] == "add")):
            k = next(iter({k for k in keys("http://" + p) if "/" in k and len(k) == max(map(len, keys("http://" + p)))} or {max(keys("http://" + p), key=len)}))
            if action in ("add", "remove") and at is not None and when <= at:
                state[name, k] = action == "add"
        return sorted({n for (n, k), on in state.items() if on and k in keys(url)})

    got = sorted((str(x.page_id), str(x.url), str(x.fetched_at), x.lists) for x in out.collect())
    assert got == sorted((str(i), str(u), str(t), active(u, t)) for i, u, t, *_ in captures)
    assert any(x[3] for x in got) and any(not x[3] for x in got)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_lists_of_empty_tables(spark):
    c = spark.createDataFrame([(1, "http://a.b", day(1))], "page_id long, url string, fetched_at timestamp")
    e = spark.createDataFrame([("p", "a.b", "add", day(0))], "list string, pattern string, action string, at timestamp")
    assert U.judged(c.limit(0), e).count() == 0
    assert [r.lists for r in U.judged(c, e.limit(0)).collect()] == [[]]
    assert [r.lists for r in U.judged(c, e).collect()] == [["p"]]


def test_a_far_date_adds_no_months(spark):
    e = spark.createDataFrame([("p", f"h{i}.b", "add", day(i)) for i in range(10)] + [("p", "h3.b", "remove", day(400))], "list string, pattern string, action string, at timestamp")
    near = [("http://h1.b/x", day(40)), ("http://h3.b/", day(399)), ("http://h3.b/", day(400)), ("http://h3.b/", day(5000)), ("http://h9.b/", day(3)), ("http://h9.b/", day(9))]
    far = dt.datetime(9999, 12, 30)
    c = spark.createDataFrame([*near, ("http://h1.b/x", far), ("http://h3.b/x", far)], "url string, fetched_at timestamp")
    got = [r.lists for r in U.judged(c, e).collect()]
    rows = {(r.url, r.fetched_at): r.lists for r in U.judged(c, e).collect()}
    assert [rows[k] for k in [*near, ("http://h1.b/x", far), ("http://h3.b/x", far)]] == [["p"], ["p"], [], [], [], ["p"], ["p"], []] and len(got) == 8
    known = U.changes(e)
    months = lambda *days: spark.createDataFrame([("p", "h1.b", d) for d in days], "list string, key string, month timestamp")
    one = U.states(known, months(dt.datetime(2026, 1, 1))).collect()
    two = U.states(known, months(dt.datetime(9999, 1, 1))).collect()
    assert len(one) == len(two) == 1 and two[0].active and two[0].carried


def test_salts_do_not_change_the_result(spark):
    e = spark.createDataFrame([("p", "a.b", "add", day(0)), ("q", "a.b", "add", day(3)), ("q", "a.b", "remove", day(9))], "list string, pattern string, action string, at timestamp")
    c = spark.createDataFrame([(f"http://a.b/{i}", day(i % 13)) for i in range(60)], "url string, fetched_at timestamp")
    a, b = ({(r.url, tuple(r.lists)) for r in U.judged(c, e, salts=n).collect()} for n in (1, 500))
    assert a == b == {(f"http://a.b/{i}", ("p", "q") if 3 <= i % 13 < 9 else ("p",)) for i in range(60)}


def licence_texts():
    mit = L.LICENSES["MIT"]
    return [
        "Copyright (c) 2020 Somebody\n\n" + mit, mit.upper().replace("SUBLICENSE", "SUBLICENCE").replace('"', "''"),
        "© 1999-2003 A, B\n" + mit.replace(". ", ".\n"), mit + " And more.", "x\nReleased under the MIT Licence\nReleased under the  MIT license!\ny",
        "Licensed under the Apache License, Version 2.0.", "this license is not known", "licence", L.LICENSES["0BSD"], "word " * 300_000 + "\n" + mit[:300]]


def test_licences(spark):
    df = brute.messy(spark, licence_texts())
    got = {(r.doc_id, r.license_id): (r.whole, r.lines) for r in L.scan(df, L.known_licenses(spark)).collect()}
    assert got == {(0, "MIT"): (True, 0), (1, "MIT"): (True, 0), (2, "MIT"): (True, 0), (4, "MIT"): (False, 2),
                   (5, "Apache-2.0"): (True, 1), (8, "0BSD"): (True, 0)}
    same = {(r.doc_id, r.license_id): (r.whole, r.lines) for r in L.scan(df, L.known_licenses(spark), small=0).collect()}
    assert same == got


def test_licences_against_sql(spark):
    df = brute.messy(spark, licence_texts())
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text").toArrow())
    cur = con.execute(L.OP8_SQL)
    out = L.scan(df, L.known_licenses(spark))
    assert not compare(out.columns, [tuple(r) for r in out.collect()], [d[0] for d in cur.description], cur.fetchall())


def test_licences_of_empty_tables(spark):
    known = L.known_licenses(spark)
    assert L.scan(brute.empty(spark), known).count() == 0
    assert L.scan(brute.messy(spark, ["Released under the MIT License."]), known.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "MIT text of license"), ("X", None), ("Y", " ... ")], "license_id string, text string")
    assert L.scan(brute.messy(spark, ["MIT text of license", "..."]), odd).count() == 0


def test_every_known_text_has_the_mark():
    import re
    assert all(re.search(L.MARK, t) for _, t in L.known_texts())


def test_full_licences_and_the_rights_notice(spark):
    texts = {i: "Copyright (c) 2020 A\n\n" + t.replace("\n", " \n ") for i, t in L.LICENSES.items()}
    more = [("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + L.LICENSES["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")),
            ("Apache-2.0", L.LICENSES["Apache-2.0"].split("APPENDIX")[0]), ("MIT", "The MIT License (MIT)\n\n" + L.LICENSES["MIT"]),
            (L.RIGHTS_ID, "ALL RIGHTS RESERVED")]
    rows = [*texts.items(), *more]
    got = {(r.doc_id, r.license_id) for r in L.scan(brute.messy(spark, ["none", *(t for _, t in rows)]), L.known_licenses(spark)).where("whole").collect()}
    assert got == {(k, i) for k, (i, _) in enumerate(rows, 1)}
    line = L.scan(brute.messy(spark, ["none", "words\nAll rights  reserved.\nmore words"]), L.known_licenses(spark)).collect()
    assert [(r.doc_id, r.license_id, r.whole, r.lines) for r in line] == [(1, L.RIGHTS_ID, False, 1)]


def test_the_mark_loses_nothing(spark):
    texts = ["none", "Released  under CC BY 4.0", "x\nReleased\tunder\u00a0CC BY 4.0", "Distributed, under CC0 1.0", "Released\n(c) 2020 A\nunder CC BY 4.0"]
    df = brute.messy(spark, texts)
    for mark in (None, L.MARK):
        assert {r.doc_id for r in L.scan(df, L.known_licenses(spark), mark=mark).collect()} == {1, 2, 3, 4}
    known = spark.createDataFrame(L.known_texts(), "license_id string, text string")
    assert known.where(~L.canonical(known.text).rlike(L.MARK)).count() == 0
    own = spark.createDataFrame([("X", "for internal use")], "license_id string, text string")
    assert [r.license_id for r in L.scan(brute.messy(spark, ["For internal use."]), own).collect()] == ["X"]
