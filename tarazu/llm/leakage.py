"""Evaluation passages inside a corpus, by greedy string tiling.

A document and an item are compared as words in one plain form. Seeds are the pairs of neighbouring
words they share: an item whose words in shared pairs are not more than the threshold cannot be covered
beyond it, so this bound loses none. The others are tiled: Karp-Rabin hashes of the words not yet marked
are run at falling lengths, and the longest common runs are marked first, no word twice. The share of
the item under tiles is its coverage in any order; the tiles that stand in the item's order in the
document, chained by dynamic programming, give its coverage in order. Passages made from one mould share
most of their words with an item but have other words where the item has its own, so between its first and
last word the tiles must cover a share of the item's specific words: those that few items have. What the
document breaks off doesn't count against it.

Items go to the workers in blocks of bounded size, each against the whole corpus; a usual evaluation set
is one block.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarazu.llm.plain_text import plain
from tarazu.session import cut, spread

THRESHOLD = 0.5  # share of the item's words, to be exceeded
MIN_RUN = 2  # least words of a tile; an item of one word is its own tile
FIRST_RUN = 16  # length at which the search for runs begins
SPECIFIC = 0.25  # share of the specific words of the stretch of the item that the tiles span, to be reached
RARE_ITEMS = 0.03  # a word is specific if it stands in one item, or in no larger share of the items' texts
BLOCK_BYTES = 8 << 20  # bytes of item texts that go to the workers at a time

_BASE, _MOD = 1_000_003, (1 << 61) - 1
_WORD = re.compile(r"(?:[^\W_]|[ऀ-ःऺ-ॏ॑-ॣॱ-ॿ])+")
_DROP = [(c, "") for c in "‌‍़"] + [(d, str(i)) for i, d in enumerate("०१२३४५६७८९")]
_NUMBER = re.compile(r"(?<=\d)[,.](?=\d)")


def words(text: str | None) -> list[str]:
    """The words compared: plain form, lower case, western digits, no joiners, no nukta, no punctuation."""
    if not text:
        return []
    text = (plain(text) or "").lower()
    if not text.isascii():
        for old, new in _DROP:
            text = text.replace(old, new)
    return _WORD.findall(_NUMBER.sub("", text))


def _runs(item: list[int], doc: list[int], used_i: bytearray, used_j: bytearray, size: int) -> list[tuple[int, int, int]]:
    """The longest common runs of unmarked words, of size words or more: Karp-Rabin hashes roll over both texts."""

    def hashes(seq: list[int], used: bytearray) -> list[tuple[int, int]]:
        """(place, hash) of each window of size words without a mark or a word (-1) the item lacks."""
        out, h, n, top = [], 0, 0, pow(_BASE, size - 1, _MOD)
        for k, x in enumerate(seq):
            if x < 0 or used[k]:
                h = n = 0
                continue
            if n >= size:
                h = (h - (seq[k - size] + 2) * top) % _MOD
            h = (h * _BASE + x + 2) % _MOD
            n += 1
            if n >= size:
                out.append((k - size + 1, h))
        return out

    at: dict[int, list[int]] = defaultdict(list)
    for i, h in hashes(item, used_i):
        at[h].append(i)
    runs = []
    for j, h in hashes(doc, used_j):
        for i in at.get(h, ()):
            if i and j and item[i - 1] == doc[j - 1] and not used_i[i - 1] and not used_j[j - 1] or item[i : i + size] != doc[j : j + size]:
                continue  # begins earlier, or a chance collision
            n = size
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_i[i + n] and not used_j[j + n]:
                n += 1
            runs.append((i, j, n))
    return runs


def tiles(item: list[int], doc: list[int], least: int = MIN_RUN) -> list[tuple[int, int, int]]:
    """(place in item, place in document, words) of the greedy tiling; ties go to the earlier place in the item, then in the document.

    Words of the document that the item lacks are negative and match nothing.
    """
    used_i, used_j, out = bytearray(len(item)), bytearray(len(doc)), []
    size = max(least, min(FIRST_RUN, len(item), len(doc)))
    while True:
        by_size: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, j, n in _runs(item, doc, used_i, used_j, size):
            by_size[n].append((i, j))
        while by_size:
            n = max(by_size)
            for i, j in sorted(by_size.pop(n)):
                start = None
                for k in range(n + 1):  # what earlier tiles left of the run comes up again at its own length
                    if k < n and not used_i[i + k] and not used_j[j + k]:
                        start = k if start is None else start
                        continue
                    if start is not None and k - start == n:
                        out.append((i, j, n))
                        used_i[i : i + n] = used_j[j : j + n] = b"\1" * n
                    elif start is not None and k - start >= size:
                        by_size[k - start].append((i + start, j + start))
                    start = None
        if size == least:
            return out
        size = max(least, size // 2)


def chain(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The tiles, of most words together, that stand in the same order in both texts."""
    found = sorted(found)
    best, before = [0] * len(found), [-1] * len(found)
    for a, (i, j, n) in enumerate(found):
        for b in range(a):
            if best[b] > best[a] and found[b][0] + found[b][2] <= i and found[b][1] + found[b][2] <= j:
                best[a], before[a] = best[b], b
        best[a] += n
    out, at = [], max(range(len(found)), key=best.__getitem__, default=-1)
    while at >= 0:
        out.append(found[at])
        at = before[at]
    return out[::-1]


def rare_limit(n_texts: int) -> int:
    return max(1, int(RARE_ITEMS * n_texts))


class Items:
    """Evaluation items as word ids, with the places of their pairs of words."""

    def __init__(self, rows: list[tuple[list[str], list[str]]]):
        """rows: the words of each item, at least one, and its specific words."""
        self.vocab: dict[str, int] = {}
        self.seqs = [[self.vocab.setdefault(w, len(self.vocab)) for w in ws] for ws, _ in rows]
        self.own = [{self.vocab[w] for w in own if w in self.vocab} for _, own in rows]
        self.sizes = np.array([len(s) for s in self.seqs], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        flat = np.array([x for s in self.seqs for x in s], np.int64)
        within = np.ones(len(flat), bool)
        within[(self.starts + self.sizes - 1)[self.sizes > 0]] = False
        at = np.flatnonzero(within)
        pairs = flat[at] * len(self.vocab) + flat[at + 1]
        order = np.argsort(pairs, kind="stable")
        self.places = at[order]  # of the pairs, in the order of their numbers
        self.pairs, self.first = np.unique(pairs[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        self.single = np.flatnonzero(self.sizes == 1)
        self.n_words = len(flat)

    def found(self, text: str | None, threshold: float = THRESHOLD) -> list[tuple[int, float, float, bool]]:
        """(row, coverage in order, coverage in any order, whether the one in order holds) of the items of which the text holds more than threshold."""
        get = self.vocab.get
        doc = [get(w, -1) for w in words(text)]
        ids = np.array(doc, np.int64)
        known = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        able = []
        if len(known) and len(self.pairs):
            seen = np.unique(ids[known] * len(self.vocab) + ids[known + 1])
            k = np.searchsorted(self.pairs, seen)
            k = k[(k < len(self.pairs)) & (self.pairs[np.minimum(k, len(self.pairs) - 1)] == seen)]
            if len(k):
                held = np.zeros(self.n_words, bool)
                for a, b in zip(self.first[k], self.last[k]):
                    at = self.places[a:b]
                    held[at] = held[at + 1] = True
                able = np.flatnonzero(np.add.reduceat(held, self.starts, dtype=np.int64) > threshold * self.sizes).tolist()
        if len(self.single):
            there = set(doc)
            able += [k for k in self.single.tolist() if self.seqs[k][0] in there]
        out = []
        for k in sorted(able):
            seq = self.seqs[k]
            inside = set(seq)
            tiled = tiles(seq, [x if x in inside else -1 for x in doc], min(MIN_RUN, len(seq)))
            ordered, anyhow = self._judge(k, chain(tiled)), self._judge(k, tiled)
            in_order = ordered[0] > threshold and ordered[1]
            if in_order or anyhow[0] > threshold and anyhow[1]:
                out.append((k, ordered[0], anyhow[0], in_order))
        return out

    def _judge(self, k: int, some: list[tuple[int, int, int]]) -> tuple[float, bool]:
        """Coverage by some tiles, and whether enough specific words of the stretch they span are under them."""
        seq = self.seqs[k]
        at = sorted(p for i, _, n in some for p in range(i, i + n))
        if not at:
            return 0.0, False
        spanned = sum(w in self.own[k] for w in seq[at[0] : at[-1] + 1])
        return len(at) / len(seq), sum(seq[p] in self.own[k] for p in at) >= SPECIFIC * spanned


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words_udf(text: pd.Series) -> pd.Series:
    return text.map(words)


def read_items(items: DataFrame) -> tuple[DataFrame, int]:
    """(item_id, n, ws, own of each distinct item with words: how often it stands there, its words and its specific ones; bytes of all words)."""
    each = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("n"))
    each = cut(each.select("item_id", "n", _words_udf("text").alias("ws")).where(F.size("ws") > 0).withColumn("h", F.xxhash64(F.array_join("ws", " "))))
    sums = each.agg(F.count_distinct("h").alias("texts"), F.coalesce(F.sum(F.octet_length(F.array_join("ws", " "))), F.lit(0)).alias("size")).first()
    told = each.select("item_id", "h", F.explode(F.array_distinct("ws")).alias("w"))
    rare = told.groupBy("w").agg(F.count_distinct("h").alias("k")).where(F.col("k") <= rare_limit(sums.texts)).select("w")
    own = told.select("h", "w").distinct().join(rare, "w").groupBy("h").agg(F.collect_list("w").alias("own"))
    return each.join(own, "h", "left").select("item_id", "n", "ws", F.coalesce("own", F.array().cast("array<string>")).alias("own")), sums.size


_BUILT: dict[str, Items] = {}  # the worker's index of the block at hand


def _index(shared) -> Items:
    if shared.value[0] not in _BUILT:
        _BUILT.clear()
        _BUILT[shared.value[0]] = Items(shared.value[1])
    return _BUILT[shared.value[0]]


def find_leaks(documents: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, coverage, tiled, in_order: documents (doc_id, text) holding more than threshold of an item (item_id, text).

    coverage is the share of the item's words held in its order, tiled that in any order (a passage moved
    about), in_order whether the first one fulfils the threshold. Null, empty and wordless texts on either
    side yield no row; repeated documents and items yield theirs each time, null ids come out null. Empty
    tables give no row. The evaluation set is taken in as many blocks of about block_bytes as it needs.
    """
    docs = documents.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text").where(F.length("text") > 0)
    held, size = read_items(items)
    n_blocks = max(1, -(-size // block_bytes))
    blocked = (cut(held) if n_blocks > 1 else held).withColumn("block", F.pmod(F.xxhash64("item_id", "ws"), F.lit(n_blocks)))
    sc = documents.sparkSession.sparkContext
    out = None
    for block in range(n_blocks):
        rows = blocked.where(F.col("block") == block).orderBy("item_id", "ws").collect()  # block_bytes, or the one text that is longer
        if not rows:
            continue
        shared = sc.broadcast((uuid.uuid4().hex, [(list(r.ws), list(r.own)) for r in rows]))
        ids = [(r.item_id, r.n) for r in rows]
        found = spread(docs, "doc_id").mapInPandas(_scan(shared, threshold), "doc_id string, k int, coverage double, tiled double, in_order boolean")
        named = documents.sparkSession.createDataFrame([(k, *x) for k, x in enumerate(ids)], "k int, item_id long, n long")
        done = cut(found.join(F.broadcast(named), "k").select(F.col("doc_id").cast("long").alias("doc_id"), "item_id", "coverage", "tiled", "in_order", F.explode(F.array_repeat(F.lit(0), F.col("n").cast("int")))).drop("col"))
        shared.unpersist()
        out = done if out is None else out.unionByName(done)
    return out if out is not None else documents.sparkSession.createDataFrame([], "doc_id long, item_id long, coverage double, tiled double, in_order boolean")


def _scan(shared, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = _index(shared)
        for batch in batches:
            hits = [(d, *hit) for d, t in zip(batch["doc_id"], batch["text"]) for hit in index.found(t, threshold)]
            yield pd.DataFrame(hits, columns=["doc_id", "k", "coverage", "tiled", "in_order"]).astype({"k": "int32", "coverage": "float64", "tiled": "float64", "in_order": "bool"})

    return run
