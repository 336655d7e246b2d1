"""Runs of words with a period, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a
length of at least ``max(min_length, times * q)`` that no neighbouring word extends keeping the
period. Each run's first q words stay, the rest of it can be dropped.

The words of a slice of texts are numbered exactly (dictionary encoding of their bytes). The basic
factors of level k are the stretches of 2**k words; two of them are equal if their halves have equal
numbers, so a level is one sort of the pairs of numbers of the level below. Only factors that occur
again in their text go on, so a level costs what still repeats, and texts without repeats end early.

Occurrences of a factor within a window of twice its length form an arithmetic progression whose
difference is the period of what they cover. So of each factor the next occurrence at most its length
further on proposes a period p; a maximal stretch of neighbouring factors with the same p is a run's
progression, and extends to the end of its last factor's next occurrence. That is the whole run: a run
with period q of at least 3q words has, at the first level with 2**k >= q, the next occurrence of
every factor but the last ones at distance q, as its root is primitive, and no factor outside has. The
levels above propose the same run again; equal (start, length, period) are taken once.

Defined cases: words are separated by space and the ASCII characters 9 to 13 and compared by their
bytes; null text counts as empty and has no runs; a null id stays null; equal rows each get their
result; no rows give no rows. Runs may overlap. Only the id and the text are read; texts are
processed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graustein.llm import base
from graustein.llm.base import map_arrow

MIN_LENGTH, TIMES = 6, 4


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words (byte spans)."""
    if not len(starts):
        return np.zeros(0, np.int64)
    spelled = gathered(data, starts, ends - starts)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(spelled)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def gathered(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The spans one after the other."""
    first = np.cumsum(lens) - lens
    return data[np.arange(int(lens.sum())) + np.repeat(starts - first, lens)]


def runs(number: np.ndarray, text: np.ndarray, min_length: int = MIN_LENGTH, times: int = TIMES) -> np.ndarray:
    """(runs, 3): first word, length, period of every run, ordered; ``number`` and ``text`` are the
    number and the text of each word, and no run crosses texts."""
    n = len(number)
    place = np.arange(n)
    key = text * (int(number.max()) + 1 if n else 1) + number  # no factor equals one of another text
    found, size = [], 1
    while len(place):
        order = np.argsort(key, kind="stable")  # equal factors together, by place
        sorted_place, same = place[order], key[order][1:] == key[order][:-1]
        gap = np.zeros(len(place), np.int64)  # to the next occurrence; 0 without one
        gap[order[:-1][same]] = (sorted_place[1:] - sorted_place[:-1])[same]
        found.append(_stretches(place, np.where(gap <= size, gap, 0), size))
        again = np.zeros(len(place), bool)
        again[:-1] |= same
        again[1:] |= same
        new = np.ones(len(place), bool)
        new[1:] = ~same
        level = np.empty(len(place), np.int64)
        level[order] = np.cumsum(new) - 1
        stay = np.empty(len(place), bool)
        stay[order] = again
        place, level = place[stay], level[stay]
        # pairs of a factor and the one right behind it, where both occur again
        right = np.searchsorted(place, place + size)
        right[right == len(place)] = 0
        both = place[right] == place + size if len(place) else np.zeros(0, bool)
        key = level[both] * (int(level.max()) + 1 if len(level) else 1) + level[right[both]]
        place, size = place[both], 2 * size
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    every = every[every[:, 1] >= np.maximum(min_length, times * every[:, 2])]
    return np.unique(every, axis=0)


def _stretches(place: np.ndarray, gap: np.ndarray, size: int) -> np.ndarray:
    """(first word, length, period) of the maximal stretches of neighbouring factors with one gap."""
    place, gap = place[gap > 0], gap[gap > 0]
    if not len(place):
        return np.zeros((0, 3), np.int64)
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1] + 1) | (gap[1:] != gap[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return np.stack([place[first], place[last] - place[first] + size + gap[first], gap[first]], axis=1)


def _find(min_length: int, times: int):
    def run(batches):
        for batch in batches:
            for i, j, data, offsets in base.slices(batch.column(1)):
                starts, ends, text = base.word_spans(data, offsets)
                found = runs(numbered(data, starts, ends), text, min_length, times)
                # words that a run covers behind its first period
                edge = np.zeros(len(starts) + 1, np.int64)
                np.add.at(edge, found[:, 0] + found[:, 2], 1)
                np.add.at(edge, found[:, 0] + found[:, 1], -1)
                kept = np.cumsum(edge[:-1]) == 0
                n_words = np.bincount(text, minlength=j - i)
                of = text[found[:, 0]]
                first_word = np.cumsum(n_words) - n_words
                cut = pa.array(np.searchsorted(of, np.arange(j - i + 1)).astype(np.int32))
                parts = pa.StructArray.from_arrays([pa.array(found[:, 0] - first_word[of]), pa.array(found[:, 1]), pa.array(found[:, 2])],
                                                   ["start", "length", "period"])
                yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(n_words), pa.ListArray.from_arrays(cut, parts),
                                       joined(data, starts[kept], ends[kept], text[kept], j - i)], ["id", "n_words", "runs", "collapsed"])
    return run


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, n: int) -> pa.Array:
    """The words of each of ``n`` texts, joined by one space."""
    last = np.ones(len(text), bool)
    last[:-1] = text[1:] != text[:-1]
    sizes = ends - starts + ~last  # with the space behind, but for a text's last word
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    lens = ends - starts
    spelled = gathered(data, starts, lens)
    out[np.arange(len(spelled)) + np.repeat((np.cumsum(sizes) - sizes) - (np.cumsum(lens) - lens), lens)] = spelled
    offsets = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(text, weights=sizes, minlength=n).astype(np.int64), out=offsets[1:])
    return pa.StringArray.from_buffers(n, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out))


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, times: int = TIMES) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row: ``runs`` is an array of (start, length, period) by
    start, then period, counted in words; ``collapsed`` the words that stay, joined by one space."""
    if times < 3:
        raise ValueError("runs of fewer than three periods need not show in the dictionary")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(texts, _find(min_length, times), f"id {texts.schema['id'].dataType.simpleString()}, n_words long, "
                     "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def greatest(found: Column) -> Column:
    """The run with the greatest length (ties: smallest start, then period); null without runs."""
    ranked = F.transform(found, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r.alias("run")))
    return F.array_max(ranked)["run"]


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts of some ids made periodic from a word on, a workload for tests and
    queries: h = crc32 of the decimal id, g = h div 10; where h mod 10 is 0 and the text has n > 0 words,
    every word from a = g mod n on becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8).
    Other texts, and those of null ids, stay as they are. Built-in expressions only."""
    names = ["_h", "_words"]
    for i, name in enumerate(names):
        while name in docs.columns:
            name += "_"
        names[i] = name
    h, words = names
    picked = docs.withColumn(h, F.crc32(F.col(id_col).cast("string").cast("binary")))
    picked = picked.withColumn(words, F.when(F.col(h) % 10 == 0, F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))
    g, w = F.floor(F.col(h) / 10), F.col(words)
    n = F.size(w)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    periodic = F.array_join(F.concat(F.slice(w, F.lit(1), a), tail), " ")
    return picked.withColumn(text_col, F.when(F.coalesce(n > 0, F.lit(False)), periodic).otherwise(F.col(text_col))).drop(*names)
