"""Fuzzy similarity of texts: normalised Indel distance, best window, token sets. Arrow UDFs on pairs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & at.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - bin(s).count("1")


def ratio(a: str, b: str) -> float:
    """1 less the Indel distance as a share of both lengths; two empty texts are equal."""
    return 1.0 if not a and not b else 2 * lcs(a, b) / (len(a) + len(b))


def partial_ratio(a: str, b: str, floor: float = 0.0) -> float:
    """Best ratio of the shorter text with a window of the longer one, windows running over its ends included; floor if it is no more.

    Stretches of two window lengths are bounded first: no window in one can share more with the short
    text than the whole stretch does. They are searched from the best bound down, as long as it can win.
    """
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if not short:
        return 1.0 if not long else 0.0
    if short in long:
        return 1.0
    n, letters = len(short), set(short)
    best = floor
    for head in (True, False):  # windows over either end share no more than the longest of them
        end = long[: n - 1] if head else long[max(0, len(long) - n + 1) :]
        most = lcs(short, end)
        for k in range(1, n):
            if 2 * min(k, most) / (n + k) > best:
                best = max(best, ratio(short, end[:k] if head else end[len(end) - k :]))
    stretches = []
    for start in range(0, max(1, len(long) - n + 1), n):
        shared = lcs(short, long[start : start + 2 * n - 1])
        stretches.append((-shared, start))
    for shared, start in sorted(stretches):
        if -shared / n <= best:
            break
        for i in range(start, min(start + n, len(long) - n + 1)):
            if long[i] in letters or i == start:
                best = max(best, ratio(short, long[i : i + n]))
    return best


def token_set_ratio(a: str, b: str) -> float:
    """Best ratio among the shared tokens and the shared tokens with either rest; 0 if either is blank."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    one, two = (" ".join(sorted(d)) for d in (x - y, y - x))
    if both and (not one or not two):
        return 1.0
    left, right = f"{both} {one}".strip(), f"{both} {two}".strip()
    return max(ratio(left, right), *((ratio(both, left), ratio(both, right)) if both else (0.0,)))


LONG_TEXT = 100  # texts beyond it are searched for the name, others compared by tokens
LEAST, FIRST, LAST, ALONE = 0.5, 0.7, 0.7, 0.7  # least score told; least score of first and last word; factor of one-word names
FAINT = 0.4  # factor for a name whose first or last word is missing


def name_in_text(name: str, text: str, raw: str) -> float:
    """How surely a normalised text names somebody: the score of the name, less for words of it that are missing."""
    words = raw.split()
    if len(name) < 4 or (len(words) == 1 and len(name) < 8) or not text:
        return 0.0
    if len(text) > LONG_TEXT:
        score = partial_ratio(name, text, LEAST)
        parts = name.split()
        if len(words) >= 2 and len(parts) >= 2:
            for part, least in ((parts[0], FIRST), (parts[-1], LAST)):
                if len(part) >= 3 and partial_ratio(part, text, least - 1e-9) < least:
                    score *= FAINT
    else:
        score = token_set_ratio(name, text)
    return score * (ALONE if len(words) == 1 else 1.0)


def _stretch_ratios(name: str, text: str, starts: np.ndarray, size: int) -> np.ndarray:
    """partial_ratio() of a name with each stretch of a text, of a size of at least the name's. The bit vectors of lcs() for all windows at once, in words of 64."""
    n = len(name)
    number = {c: i for i, c in enumerate(dict.fromkeys(name))}
    bits = [sum(1 << k for k, x in enumerate(name) if x == c) for c in number] + [0]
    words = [(64 * j, min(64, n - 64 * j)) for j in range((n + 63) // 64)]
    seen = np.array([[b >> at & (1 << w) - 1 for b in bits] for at, w in words], dtype=np.uint64)
    full = np.array([(1 << w) - 1 for _, w in words], dtype=np.uint64)[:, None]
    seen = seen[:, np.array([number.get(c, len(number)) for c in text] + [len(number)] * n)]
    state = np.repeat(full, len(text), axis=1)
    missing = lambda s: np.bitwise_count(s & full).sum(axis=0, dtype=np.int64)
    best = np.zeros(len(starts))
    for k in range(1, n + 1):
        carry = None
        for j in range(len(words)):
            s = state[j]
            u = s & seen[j, k - 1 : k - 1 + len(text)]
            rest, total = s - u, s + u
            if len(words) > 1:
                over = total < s
                if carry is not None:
                    total += carry
                    over |= total < carry
                carry = over.astype(np.uint64)
            state[j] = total | rest
        if k < n:
            ends = n - np.minimum(missing(state[:, starts]), missing(state[:, starts + size - k]))
            best = np.maximum(best, 2 * ends / (n + k))
    whole = np.lib.stride_tricks.sliding_window_view(n - missing(state[:, : len(text) - n + 1]), size - n + 1)[starts]
    return np.maximum(best, 2 * whole.max(axis=1) / (2 * n))


SHORTEST = 20  # a passage shorter than this names nobody for sure


def matched_passage(name: str, text: str, title: str, long: bool) -> str:
    """Where a text names somebody: the window most like the name, the first of equals; of a short text its title."""
    if not long:
        return title
    size, step = max(3 * len(name), 50), max(5, len(name) // 2)
    starts = np.arange(0, max(1, len(text) - size + 1), step)
    if len(starts) == 1 or not name:
        return text[:size].strip()
    i = int(starts[np.argmax(_stretch_ratios(name, text, starts, size))])
    return text[i : i + size].strip()


WIDEST = 64  # letters of a word or name in the bit vectors of many at once; longer ones are compared one by one


class Searched:
    """Words to be searched in many texts: best_ratios() gives partial_ratio() of several of them and one text at once.

    The bit vectors of lcs() for every window of the text are one array, a row a word; a window over the end of the text
    is cut by letters that no word has.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.lengths = np.array([len(w) for w in words], dtype=np.int64)
        letters = sorted({ord(c) for w in words for c in w if len(w) <= WIDEST})
        self.letters = np.array(letters or [0], dtype=np.uint32)
        at = {c: i for i, c in enumerate(letters)}
        self.masks = {}
        self.row = np.zeros(len(words), dtype=np.int64)  # of a word in the masks of its width
        self.width = np.zeros(len(words), dtype=np.int64)
        for width, least, most in ((16, 1, 16), (32, 17, 32), (64, 33, WIDEST)):
            some = np.flatnonzero((self.lengths >= least) & (self.lengths <= most))
            masks = np.zeros((len(some), len(letters) + 1), dtype=f"uint{width}")
            for r, i in enumerate(some):
                for k, c in enumerate(words[i]):
                    masks[r, at[ord(c)]] |= masks.dtype.type(1 << k)
            self.masks[width], self.row[some], self.width[some] = masks, np.arange(len(some)), width

    def encoded(self, text: str) -> np.ndarray:
        """The text as places in the letters, those of no word as one more."""
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        at = np.searchsorted(self.letters, raw)
        at[at == len(self.letters)] = 0
        return np.where(self.letters[at] == raw, at, len(self.letters)) if self.masks[16].shape[1] > 1 else np.zeros(len(raw), dtype=np.int64)

    def best_ratios(self, which: np.ndarray, text: str, ids: np.ndarray, floor: float = 0.0) -> np.ndarray:
        """partial_ratio(word, text) of the words at which, of those under floor anything up to it; ids: encoded(text)."""
        out = np.zeros(len(which))
        lengths = self.lengths[which]
        wide = (lengths > 0) & (lengths <= min(WIDEST, len(text)))
        for i in np.flatnonzero(~wide):
            w = self.words[which[i]]
            out[i] = partial_ratio(w, text, floor) if not w or len(w) > len(text) else _stretch_ratios(w, text, np.zeros(1, dtype=np.int64), len(text))[0]
        for width, masks in self.masks.items():
            some = np.flatnonzero(wide & (self.width[which] == width))
            if len(some):
                some = some[np.argsort(-lengths[some], kind="stable")]
                out[some] = _window_ratios(masks[self.row[which[some]]], lengths[some], ids)
        return out


def _window_ratios(masks: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The best ratio of each word with a window of the text. masks: a row a word, the longest word first, a column a letter."""
    long, size = int(lengths[0]), len(ids)
    other = np.full(long, masks.shape[1] - 1, dtype=ids.dtype)
    seen = masks.take(np.concatenate([ids, other]), axis=1)
    full = (np.uint64(0xFFFFFFFFFFFFFFFF) >> (64 - lengths).astype(np.uint64)).astype(masks.dtype)
    state = np.repeat(full[:, None], size, axis=1)
    rows = np.searchsorted(-lengths, -np.arange(1, long + 1), side="right")  # words of that many letters or more
    ends = np.zeros((2, len(lengths), long), dtype=masks.dtype)
    most = np.zeros(len(lengths))
    for k in range(1, long + 1):
        r = rows[k - 1]
        s = state[:r]
        u = s & seen[:r, k - 1 : k - 1 + size]
        rest = s - u
        s += u
        s |= rest
        ends[0, :r, k - 1], ends[1, :r, k - 1] = s[:, 0], s[:, size - k]
        low = rows[k] if k < long else 0
        if low < r:
            missing = np.bitwise_count(s[low:r, : size - k + 1] & full[low:r, None]).min(axis=1)
            most[low:r] = 2 * (k - missing.astype(np.int64)) / (2 * k)
    steps = np.arange(1, long + 1)
    shared = lengths[:, None] - np.bitwise_count(ends & full[:, None]).min(axis=0).astype(np.int64)
    over = np.where(steps < lengths[:, None], 2 * shared / (lengths[:, None] + steps), 0.0)
    return np.maximum(most, over.max(axis=1))


def _token_set_from(name: set[str], text: set[str], least: float) -> float:
    """token_set_ratio() where it is least or more; else something less than least."""
    if not name or not text:
        return 0.0
    both, one, two = " ".join(sorted(name & text)), name - text, text - name
    if both and (not one or not two):
        return 1.0
    size = lambda d: sum(map(len, d)) + len(d) - 1
    n, x, y = len(both), size(one), size(two)
    a, b = (n + 1 + x, n + 1 + y) if n else (x, y)
    sure = max(2 * n / (n + a), 2 * n / (n + b)) if n else 0.0
    if 2 * min(a, b) / (a + b) <= max(sure, least - 1e-9):
        return sure
    left, right = (f"{both} {' '.join(sorted(d))}".strip() for d in (one, two))
    return max(sure, ratio(left, right))


class Names:
    """Normalised names, each with its raw form, to be scored in many texts as name_in_text() does."""

    def __init__(self, forms: list[str], raws: list[str]):
        words, parts = [r.split() for r in raws], [f.split() for f in forms]
        self.alone = np.array([len(w) == 1 for w in words], dtype=bool)
        self.none = np.array([len(f) < 4 or (len(w) == 1 and len(f) < 8) for f, w in zip(forms, words)], dtype=bool)
        self.sets = [set(p) for p in parts]
        self.names = Searched(forms)
        number: dict[str, int] = {}
        ends = [[number.setdefault(p[i], len(number)) if len(w) >= 2 and len(p) >= 2 and len(p[i]) >= 3 else -1 for i in (0, -1)] for w, p in zip(words, parts)]
        self.ends = np.array(ends, dtype=np.int64).reshape(len(forms), 2)  # of a name's first and last word, -1 where they don't matter
        self.parts = Searched(list(number))

    def scores(self, which: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Those of the names at which that score LEAST or more in a text, and their scores."""
        which = which[~self.none[which]]
        if not text or not len(which):
            return which[:0], np.zeros(0)
        if len(text) <= LONG_TEXT:
            tokens = set(text.split())
            found = np.array([_token_set_from(self.sets[i], tokens, LEAST) for i in which])
        else:
            ids = self.parts.encoded(text)
            for side, least in ((1, LAST), (0, FIRST)):  # last words are fewer
                asked = self.ends[which, side]
                words = np.unique(asked[asked >= 0])
                if len(words):
                    there = np.zeros(len(self.parts.words) + 1, dtype=bool)
                    there[words] = self.parts.best_ratios(words, text, ids) >= least
                    there[-1] = True  # asked is -1
                    which = which[there[asked]]
            if not len(which):
                return which, np.zeros(0)
            found = np.maximum(self.names.best_ratios(which, text, self.names.encoded(text), LEAST), LEAST)
        found = found * np.where(self.alone[which], ALONE, 1.0)
        kept = found >= LEAST
        return which[kept], found[kept]


def _pairs(f):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x, y) if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b)], dtype="float64")

    return run


def indel_ratio():
    return _pairs(ratio)


def best_window_ratio():
    return _pairs(partial_ratio)


def token_set():
    return _pairs(token_set_ratio)


def name_score():
    @F.pandas_udf("score double, passage string")
    def run(name: pd.Series, text: pd.Series, raw: pd.Series, full: pd.Series, title: pd.Series) -> pd.DataFrame:
        rows = []
        for n, t, r, f, h in zip(name, text, raw, full, title):
            n, t, r = n or "", t or "", r or ""
            score = name_in_text(n, t, r)
            rows.append((score, matched_passage(r, f or "", h or "", len(t) > LONG_TEXT) if score >= LEAST else None))
        return pd.DataFrame(rows, columns=["score", "passage"])

    return run


def found_passage():
    @F.pandas_udf("string")
    def run(name: pd.Series, full: pd.Series, title: pd.Series, long: pd.Series) -> pd.Series:
        return pd.Series([matched_passage(n or "", f or "", h or "", bool(x)) for n, f, h, x in zip(name, full, title, long)], dtype=object)

    return run
