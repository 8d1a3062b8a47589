"""Encoding of a corpus with a public byte-level BPE vocabulary, by batched numpy merge rounds.

The distinct words of a batch lie as byte symbols in one flat array. Every round looks up the keys of
all adjacent pairs by binary search over the sorted pair keys, takes the lowest rank of each word,
and merges all its places at once. Each text is cut and encoded where it lies: no shuffle.
"""

from __future__ import annotations

import json
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the pattern that cuts a text into words before merging, as the vocabulary's makers published it.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 200_000  # words kept by a worker between batches
ROUND_SYMBOLS = 4_000_000  # symbols merged at once, besides those of the last word

_NONE = np.iinfo(np.int64).max


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in the vocabulary file: itself if printable, else the next free code from 256."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.first = np.zeros(256, np.int64)
        for letter, b in _byte_letters().items():
            self.first[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.base = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)  # by rank
        self.cut = regex.compile(WORDS)
        self.cache: dict[str, np.ndarray] = {}

    def _ranks(self, sym: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each symbol; _NONE where there is none."""
        out = np.full(len(sym), _NONE)
        key = sym[:-1] * self.base + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (word[:-1] == word[1:])
        out[:-1][hit] = self.rank[at[hit]]
        return out

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        sym = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        word = np.repeat(np.arange(len(raw)), sizes)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(raw)
        while len(sym):
            ranks = self._ranks(sym, word)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(ranks, starts)
            spread = np.repeat(least, counts)
            over = spread == _NONE
            if over.any():  # words without a pair are done
                for s, n in zip(starts[least == _NONE], counts[least == _NONE]):
                    out[word[s]] = sym[s : s + n].astype(np.int32)
                sym, word, ranks, spread = sym[~over], word[~over], ranks[~over], spread[~over]
                if not len(sym):
                    break
            mark = ranks == spread
            # 'aaa' holds the pair twice with one symbol shared: of a run of places, every second is taken
            index = np.arange(len(sym))
            begin = mark & ~np.r_[False, mark[:-1] & (word[:-1] == word[1:])]
            since = np.maximum.accumulate(np.where(begin, index, 0))
            mark &= (index - since) % 2 == 0
            at = np.flatnonzero(mark)
            sym[at] = self.merged[ranks[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        return out

    def learn(self, words: list[str]) -> None:
        """Encode the words that are not in the cache yet, in rounds of a bounded size."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        new = [w for w in dict.fromkeys(words) if w not in self.cache]
        chunk, n = [], 0
        for w in new:
            chunk.append(w)
            n += len(w)
            if n > ROUND_SYMBOLS // 4:
                self.cache.update(zip(chunk, self.merge(chunk)))
                chunk, n = [], 0
        if chunk:
            self.cache.update(zip(chunk, self.merge(chunk)))

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets of the texts; null and empty texts have no ids."""
        cut = [self.cut.findall(t) if t else [] for t in texts]
        flat = [w for ws in cut for w in ws]
        self.learn(flat)
        offsets = np.zeros(len(texts) + 1, np.int64)
        if not flat:
            return np.zeros(0, np.int32), offsets
        ids = [self.cache[w] for w in flat]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = np.r_[0, np.cumsum(lengths)]
        offsets[1:] = ends[np.cumsum([len(ws) for ws in cut])]
        return np.concatenate(ids), offsets


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker process; the file is read there, its path is all that is shipped."""
    return Encoder(path)


def encode(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """key, ids (array of int) of each row of df; null and empty texts give an empty list. Whole texts, no special tokens."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lo, size = 0, 0
            for hi in range(1, len(texts) + 1):  # very long texts: no more than some MB of ids at once
                size += len(texts[hi - 1] or "")
                if size > 2_000_000 or hi == len(texts):
                    flat, offsets = enc.encode_batch(texts[lo:hi])
                    ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), ids], names=[key, "ids"])
                    lo, size = hi, 0

    return df.select(F.col(key), F.col(text)).mapInArrow(run, schema)
