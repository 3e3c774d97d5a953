"""Plain reimplementations that the operators are compared with, and messy tables."""

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def kept_words(texts, length):
    """Per text: its words, and which of them windows that start anywhere else cover."""
    all_words = [words(t) for t in texts]
    seen = {}
    for d, w in enumerate(all_words):
        for p in range(len(w) - length + 1):
            seen.setdefault(tuple(w[p:p + length]), []).append((d, p))
    gone = [[False] * len(w) for w in all_words]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d][p:p + length] = [True] * length
    return [(w, g) for w, g in zip(all_words, gone)]


def components(values, linked):
    """Smallest index connected with each index."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, block int, bucket string, key string, fp long, "
          "score string, size int, taken int, ident string, hash long, rank int, `odd name` string")


def messy(spark, texts):
    """Documents with these texts, then null, empty, blank, repeated and unnamed ones; every other column is null in some row."""
    rows = [(i, t, "en", f"s{i % 3}", len(t), 1, 2, "b", "k", 3, "s", 4, 5, "i", 6, 7, "o") for i, t in enumerate(texts)]
    none = [None] * 12
    n = len(rows)
    rows += [(n, None, None, None, None, *none), (n + 1, "", None, "s0", 0, *none), (n + 2, " \t\n", "fr", None, 3, *none),
             (None, "no name here", None, None, None, *none), rows[0], rows[0], (0, "same id, other text", *([None] * 15))]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
