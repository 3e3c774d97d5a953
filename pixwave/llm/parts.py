"""Texts as parts that tokenizers treat one by one, and a bounded store of what is known about a part.

A space between two characters that are no white space begins a pre-token of byte-level vocabularies, and a piece of
vocabularies whose pieces have a space only in front. So a text may be cut there, and a part is worked on once.
"""

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# white space beyond ASCII, and what some engines count as such: texts that have it stay whole
_ODD = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
_WHITE = "\t\n\x0b\x0c\r "
_MIXED = ["  ", *(a for w in "\t\n\x0b\x0c\r" for a in (" " + w, w + " "))]
_BETWEEN = re.compile("(?<=[^ \t-\r]) (?=[^ \t-\r])")

# No byte-level pre-token goes on after a run of letters, nor over a line break between two characters that are no white
# space. The letters here are a subset of those of the libraries, which have their own versions of Unicode.
LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_SIMPLE = rf"^[!-~{LETTER}]+(\n[!-~{LETTER}]+)*$"
_CUTS = (rf"([{LETTER}])([^{LETTER}])", rf"(\n)([{LETTER}])")
_SOLID = re.compile(r"\S+")

LONGEST = 64  # characters of a part that is worth keeping
KEPT = 200_000  # parts of a generation


def is_plain(text: str) -> bool:
    """Whether every space of a text is a cut."""
    return not (text[:1] in _WHITE or text[-1:] in _WHITE or any(m in text for m in _MIXED) or _ODD.search(text))


def split_parts(text: str) -> list[str]:
    """The parts of a text; joined by single spaces they are the text. An empty text has none."""
    if not text or _ODD.search(text):
        return [text] if text else []
    return _BETWEEN.split(text)


def numbered(texts: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct parts of some texts, the number of each part in order, and where each text's parts begin (n + 1 entries)."""
    plain = np.fromiter(map(is_plain, texts), bool, len(texts))
    order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]), kind="stable")
    lists = pa.concat_arrays([
        pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], pa.large_string()), " ").cast(pa.large_list(pa.large_string())),
        pa.array([split_parts(t) for t, p in zip(texts, plain) if not p], pa.large_list(pa.large_string()))]).take(pa.array(order))
    coded = lists.flatten().dictionary_encode()
    begin = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), begin


def units(names: pa.Array) -> pa.LargeListArray:
    """Units of each part, the first with the space in front; what comes after a zero byte can only be taken by itself."""
    simple = pc.match_substring_regex(names, _SIMPLE)
    cut = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), names.filter(simple), pa.scalar("", pa.large_string()))
    for pattern in _CUTS:
        cut = pc.replace_substring_regex(cut, pattern, "\\1\0\\2")
    kind = pa.large_list(pa.large_string())
    others = [[" " + n] if _SOLID.fullmatch(n) and "\0" not in n and not _ODD.search(n) else ["\0 " + n] for n in names.filter(pc.invert(simple)).to_pylist()]
    simple = simple.to_numpy(zero_copy_only=False)
    order = np.argsort(np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)]), kind="stable")
    return pa.concat_arrays([pc.split_pattern(cut, "\0").cast(kind), pa.array(others, kind)]).take(pa.array(order))


class Store(dict):
    """What was made of strings, kept for those met of late.

    Two generations of `kept` keys each bound the memory; a key that is asked for again moves to the young one. Only
    the time of an answer depends on what is kept.
    """

    def __init__(self, kept: int = KEPT, longest: int = LONGEST):
        super().__init__()
        self.kept, self.longest, self.old = kept, longest, {}

    def fetch(self, keys: list[str], make_many: Callable[[list[str]], list]) -> list:
        """Values of distinct keys; those that are not kept are made together."""
        out = [self.get(k) for k in keys]
        late = [i for i, v in enumerate(out) if v is None]
        for i in late:
            out[i] = self.old.get(keys[i])
        new = [i for i in late if out[i] is None]
        for i, value in zip(new, make_many([keys[i] for i in new])):
            out[i] = value
        for i in late:
            self.keep(keys[i], out[i])
        return out

    def keep(self, key: str, value) -> None:
        if len(key) <= self.longest:
            if len(self) >= self.kept:
                self.old = dict(self)
                self.clear()
            self[key] = value
