import random
import re

import numpy as np

from llm_helpers import brute
from pixwave.llm import decontaminate as D

BENCH = "item_id int, text string, doc_id string"


def test_planted_passages_of_the_given_tables(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    token = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    index = {}
    for r in items:
        w = token(r.text)
        for k in range(len(w) - 12):
            index.setdefault(tuple(w[k:k + 13]), set()).add(r.item_id)
    want = set()
    for r in docs:
        w = token(r.text or "")
        want |= {(r.doc_id, i) for k in range(len(w) - 12) for i in index.get(tuple(w[k:k + 13]), ())}
    got = D.op6_query(spark, folder).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and want
    kept = D.pipeline_stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert kept.count() == len(docs) - len({d for d, _ in want})


def bench(spark):
    return spark.createDataFrame([
        (7, "When John has 5 apples and 5 pears in the big box while Mary has 12 kg of them.", None),
        (3, "When Tim has 3 apples and 3 pears in the big box while Ann has 1.5 g of them.", "x"),
        (9, "He has 3 apples and 4 pears in the big box while Ann has 1.5 g of them.", "x"),
        (4, "too short", "x"), (5, None, None), (6, "", None), (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", None),
        (10, "only six words stand in here", None), (None, "an item that has no name of its own but words enough to be found", None)], BENCH)


TEXTS = [
    "So when Bob has 7 apples and 7 pears in the big box while Sue Ann has 3,5 mg of them. More.",  # other values
    "Then he has 7 apples and 8 pears in the big box while Sue has 3 mg of them",  # fits item 9 alone as a whole
    "ÉTÉ. TOM HAS 5 APPLES AND 5 PEARS IN THE BIG BOX WHILE",  # words in capitals
    "nothing of the kind is said here, not even 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15",
    "well, only six words stand in here, or more",
    "an item that has no name of its own but words enough to be found",
    ("filler words. " * 90_000) + "\nWhen Bob has 7 apples and 7 pears in the big box while Sue has 3 mg of them",
]


def test_other_values(spark):
    df = brute.messy(spark, TEXTS)
    for rows in (0, 10**6):  # with and without the filter in the tasks
        got = {(r.doc_id, r.item_id): r for r in D.contaminated(df, bench(spark), filter_rows=rows).collect()}
        assert got[0, 3].n_items == 2 and got[0, 3].share > 0.8  # items 3 and 7 are one class
        assert got[1, 9].share == 1.0
        assert [k for k in got if k[0] == 3] == [(3, 8)]  # numbers alone, as they stand
        assert (4, 10) in got and (5, None) in got and got[6, 3].share > 0.8


def test_slots_must_be_consistent(spark):
    items = spark.createDataFrame([(1, "take 4 of these and put 4 of those into the other box with 4 more", None)], BENCH)
    df = brute.messy(spark, ["take 9 of these and put 9 of those into the other box with 9 more",
                             "take 9 of these and put 8 of those into the other box with 7 more"])
    assert {r.doc_id for r in D.contaminated(df, items).collect()} == {0}


def test_units_numbers_and_names():
    import numpy as np
    kinds = lambda t: D.template(np.frombuffer(t.encode() + b"\n", np.uint8)).kind.tolist()
    L, N, A, U = D.LITERAL, D.NUMBER, D.NAME, D.UNIT
    assert kinds("The man Ann Lee ate 3.5kg or 1,000 g") == [L, L, A, L, N, U, L, N, U]
    assert kinds("g of it. Then Émile ran") == [L, L, L, L, A, L]
    assert kinds("ALL CAPS ÉÉ") == [L, L, L] and kinds("") == [] and kinds(" .,") == []


def test_clean_keeps_columns_and_rows(spark):
    df = brute.messy(spark, TEXTS[:4])
    out = D.clean(df, bench(spark))
    assert out.columns == df.columns
    kept = sorted(str(r.doc_id) for r in out.collect())
    rows = [str(r.doc_id) for r in df.collect()]
    for gone in ("0", "1", "3"):
        rows = [r for r in rows if r != gone]
    assert "3" not in kept and "4" in kept and "None" in kept  # clean, null text, null id
    assert kept.count("0") == 1  # another text under the id of a contaminated one


def test_empty_tables(spark):
    df, items = brute.messy(spark, TEXTS[:2]), bench(spark)
    assert D.contaminated(brute.empty(spark), items).count() == 0
    assert D.contaminated(df, items.limit(0)).count() == 0
    assert D.clean(df, items.limit(0)).count() == df.count()


def test_items_of_slots_and_short_items(spark):
    items = spark.createDataFrame([
        (1, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", None), (2, "meet Anna Bob Carla Dave Emil Frida Gustav", None), (3, "vexillology", None),
        (4, "Convert 12 kg, 13 lb and 14 g, 15 kg, 16 lb, 17 g", None)], BENCH)
    df = brute.messy(spark, ["as in 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15, it is", "Then meet Anna, Bob, Carla, Dave, Emil, Frida, Gustav.",
                             "it is Vexillology, or", "so convert 12 kg, 13 lb and 14 g, 15 kg, 16 lb, 17 g", "convert 12 kg, 13 lb and 14 g, 15 kg, 16 lb, 18 g",
                             "2 3 4 5 6 7 8 9 10 11 12 13 14 16"])
    for rows in (0, 10**6):
        got = {(r.doc_id, r.item_id): r.share for r in D.contaminated(df, items, filter_rows=rows).collect()}
        assert got[0, 1] == got[1, 2] == got[2, 3] == got[3, 4] == 1.0
        assert {k for k in got if k[0] in (4, 5)} <= {(4, 4), (5, 1)} and got.get((5, 1), 0) < 1
        assert got[4, 4] == 1.0  # another number in the same place
    assert D.clean(df.where("doc_id = 0"), items).where("text like 'as in%'").count() == 0


def test_one_changed_value_keeps_the_other_windows(spark):
    def sentence(values):
        values = iter(values)
        return " ".join(str(next(values)) if k % 6 == 1 else "w" + "abcdefghij"[k // 10] + "abcdefghij"[k % 10] for k in range(40))

    items = spark.createDataFrame([(1, sentence([4, 10, 11, 12, 13, 14, 4]), None)], BENCH)
    df = brute.messy(spark, ["none", sentence([5, 20, 21, 22, 23, 24, 6]), sentence([5, 20, 21, 22, 23, 24, 5])])
    got = {r.doc_id: (r.windows, r.share) for r in D.contaminated(df, items).collect()}
    assert got == {1: (26, 26 / 28), 2: (28, 1.0)}  # two of 28 windows disagree with three about what stands for 4


def test_passages_that_differ_in_case_or_line_breaks(spark):
    items = spark.createDataFrame([
        (1, "we saw that Anna and Carla met Dave near the old bridge while Emil and Frida stayed", None),
        (2, "a first short line\nAnother line of it\nThird one of some more\nlast words here", None)], BENCH)
    texts = ["none", *(r.text for r in items.collect())]
    df = brute.messy(spark, [texts[0], texts[1].lower(), texts[1].upper(), texts[2].replace("\n", " "), texts[1].replace(" ", "\n")])
    got = {(r.doc_id, r.item_id): r.share for r in D.contaminated(df, items).collect()}
    assert got == {(1, 1): 1.0, (2, 1): 1.0, (3, 2): 1.0, (4, 1): 1.0}


def test_items_of_mostly_slots_with_other_values(spark):
    items = spark.createDataFrame([
        (1, "Anna buys 4 kg for 3 USD", None), (2, "What is 12 + 7 * 5?", None), (3, "Convert 12 kg, 13 lb and 14 g, 15 kg, 16 lb and 17 g to the other unit of 18 oz", None),
        (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15", None), (5, "Total: 5", None), (6, "What is 3 + 3 * 3?", None)], BENCH)
    texts = ["none", "then Bob buys 9 kg for 8 USD today", "Bob buys 9 kg for 8 USD.", "What is 35 + 9 * 2?", "so tell me: what is 35 + 9 * 2, please",
             "Convert 1 kg, 2 lb and 3 g, 4 kg, 5 lb and 6 g to the other unit of 7 oz",
             # what must not be found: another unit, sign or pattern, a part of the item, tables of numbers
             "then Bob buys 9 lb for 8 USD today", "What is 35 + 9 + 2?", "What is 35 - 9 * 2?", "what is 1 + 1 * 2", "Convert 1 kg, 2 lb and 3 g, 4 kg, 5 lb",
             "\n".join(" ".join(str(100 + 7 * i + j) for j in range(20)) for i in range(30)), "Total: 7", "What is 35, 9 and 2?", "what is 8 + 8 * 8"]
    df = brute.messy(spark, texts)
    for rows in (0, 10**6):
        got = {(r.doc_id, r.item_id): r.share for r in D.contaminated(df, items, filter_rows=rows).collect()}
        assert got == {(1, 1): 1.0, (2, 1): 1.0, (3, 2): 1.0, (4, 2): 1.0, (5, 3): 1.0, (14, 6): 1.0}


def brute_template_pairs(items, docs, window=13):
    """Template path over token lists: windows of at most half slots whose slots each meet one value."""
    def tokens(text):
        t = D.template(np.frombuffer(text.encode() + b"\n", np.uint8))
        return [(int(h), int(k), int(v)) for h, k, v in zip(t.hash, t.kind, t.value)]

    found = set()
    for i, item in enumerate(items):
        a = tokens(item)
        size = min(window, len(a))
        for p in range(len(a) - size + 1) if size >= D.SHORTEST else ():
            for as_name in ((False, True) if p == 0 and a[0][1] == D.LITERAL else (False,)):
                w = a[p:p + size]
                if 2 * sum(k == D.LITERAL for _, k, _ in w) < size:
                    continue
                for d, doc in enumerate(docs):
                    b = tokens(doc)
                    for q in range(len(b) - size + 1):
                        x = b[q:q + size]
                        want = [h for h, _, _ in w]
                        if as_name:
                            want[0] = int(D._PLACE[D.NAME])
                        if want != [h for h, _, _ in x]:
                            continue
                        meets = {}
                        for (_, k, v), (_, _, y) in zip(w, x):
                            if k != D.LITERAL:
                                meets.setdefault((k, v), set()).add(y)
                        if all(len(m) == 1 for m in meets.values()):
                            found.add((d, i))
    return found


def test_templates_against_brute_force(spark):
    r = random.Random(9)
    names, units, words = ["Anna", "Bob", "Carla"], ["kg", "lb", "USD"], ["takes", "box", "the", "then", "from", "every"]

    def phrase(n):
        out = []
        for _ in range(n):
            x = r.random()
            out.append(r.choice(words) if x < 0.7 else r.choice(names) if x < 0.8 else f"{r.randint(1, 9)} {r.choice(units)}" if x < 0.9 else str(r.randint(1, 9)))
        return out

    items = [phrase(r.randint(6, 18)) for _ in range(12)]
    docs = []
    for k in range(40):  # items with other values, now and then with one word more or less
        copy = [str(r.randint(1, 9)) if w.isdigit() and r.random() < 0.6 else r.choice(names) if w in names and r.random() < 0.6 else w for w in items[k % 12]]
        if r.random() < 0.4:
            copy.insert(r.randrange(len(copy)), r.choice(words))
        docs.append("we saw " + " ".join([*phrase(r.randint(0, 4)), *copy, *phrase(r.randint(0, 4))]))
    items = [" ".join(i) for i in items]
    want = brute_template_pairs(items, docs)
    given = spark.createDataFrame([(i, t, None) for i, t in enumerate(items)], BENCH)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in D.contaminated(df, given).where("n_items = 1").collect()}
    assert len(want) > 20 and want <= got
    # what is found besides stands there word by word, or is an item without a template window
    plain = lambda t: re.findall(r"[^\W_]+", t.lower())
    for d, i in got - want:
        a, b = plain(items[i]), plain(docs[d])
        n = min(13, len(a))
        windows = {tuple(a[k:k + n]) for k in range(len(a) - n + 1)}
        assert any(tuple(b[k:k + n]) in windows for k in range(len(b) - n + 1)) or D._item_windows(D.template(np.frombuffer(items[i].encode() + b"\n", np.uint8)), 13)[1]
