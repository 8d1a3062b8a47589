"""Language of documents and of their segments, by hierarchical discrimination.

A sentence's family (Devanagari or Latin letters) is predicted from the counts of its letters; within the family,
one-versus-one linear support vector machines over hashed character n-grams separate the languages.
Runs of sentences are then found by a shortest path that pays for every change of language, so that
single foreign words, headings and page marks make no segment.
"""

from __future__ import annotations

import re
from itertools import combinations
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarazu.llm.plain_text import fold
from tarazu.session import spread

#: languages of each family, in the order of the model's scores
FAMILIES = {"devanagari": ("ne", "hi", "mai"), "latin": ("en", "ne")}
LANGUAGES = ("ne", "en", "hi", "mai")
SAMPLE = 500  # documents per label and family the machines are fitted on, at most
POOL = 200_000  # documents, picked by the hash of their ids, from which they are taken, about
SAMPLE_CHARS = 20_000  # longest text taken into the sample
BITS = 17  # log2 of the hashed features
ORDERS = (1, 2, 3, 4, 5)  # lengths of the n-grams
LEAST_STEPS = 2_000  # of a pass
EPOCHS, SIEVE_EPOCHS, ROUNDS = 4, 1, 3  # passes of the last fit, of those before it; fits, each without the sentences the last one placed elsewhere
REGULAR = 1e-4
SWITCH = 1.6  # cost of a change of language
LEAST_WORDS = 4  # words of a piece that speaks for a language
BATCH_CHARS = 1_000_000

_END = re.compile(r"(?<=[।॥!?])[\"'”’)\]]*\s*|[\n\r\x0b\x0c\x85  ]+|(?<=[^\s.]\.)\s+(?=[\"'“‘(]*[A-ZÀ-Þऀ-ॿ№])")
_ABBREVIATED = re.compile(r"(?:^|[\s(])(?:Rs|Nos?|nos?|Mrs?|Ms|Dr|St|vs|Ltd|Pvt|P|Co|Art|Sec|[A-Z]|रु|नं|न|डा|मा|न्या|वि|सं|प्रा|लि|श्री|पं|ई|क्र|[ऀ-ॿ]{1,2})\.$")
_FOREIGN = re.compile(r"\([^()]{0,60}\)|\[[^\[\]]{0,40}\]|<[^<>]{0,40}>")
_WORDS = re.compile(r"(?:[^\W\d_]|[ऀ-ःऺ-ॏ॑-ॣॱ-ॿ‍])+")


def sentences(text: str) -> list[str]:
    """Pieces of the text in order, each a sentence, a line or a part of one."""
    out, start = [], 0
    for m in _END.finditer(text):
        if m.end() == start:
            continue
        piece = text[start : m.start()]
        if piece.endswith(".") and _ABBREVIATED.search(piece[-8:]) and "\n" not in m.group() and "\r" not in m.group():
            continue
        out.append(text[start : m.end()])
        start = m.end()
    out.append(text[start:])
    return [p for p in out if p.strip()]


_LETTER = np.zeros(0x110000, bool)  # letters and the signs of Devanagari, by code
_LETTER[[c for c in range(0x32400) if chr(c).isalpha() or 0x900 <= c < 0x904 or 0x93A <= c < 0x950 or 0x951 <= c < 0x964 or 0x971 <= c < 0x980]] = True
_LETTER[0x200D] = True


class Pieces:
    """Pieces of texts as the machines see them: words in lower case with single spaces around; no digits, marks or bracketed words.

    codes: all pieces in one array, each ended by 0; starts: where they begin; n_words and the letters of both families, per piece.
    """

    def __init__(self, texts: list[str]):
        shown = [_FOREIGN.sub(" ", t) if "(" in t or "[" in t or "<" in t else t for t in texts]
        joined = " " + "\0 ".join([*[t.replace("\0", " ") for t in shown], ""]).lower()
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)[:-1]
        ends = codes == 0
        codes = np.where(_LETTER[codes] | ends, codes, 32).astype(np.uint32)
        # a space before every end, and no two spaces in a row
        codes = np.insert(codes, np.flatnonzero(ends), 32)
        blank = codes == 32
        codes = codes[~(blank & np.append(False, blank[:-1]))]
        stops = np.flatnonzero(codes == 0)
        self.codes, self.starts, self.sizes = codes, np.append(0, stops[:-1] + 1)[: len(stops)], np.diff(np.append(-1, stops)) - 1
        signs = (codes >= 0x900) & (codes < 0x904) | (codes >= 0x93A) & (codes < 0x950) & (codes != 0x93D) | (codes >= 0x951) & (codes < 0x958) | (codes == 0x962) | (codes == 0x963)
        own = (codes >= 0x900) & (codes < 0x980) & ~signs
        other = (codes > 32) & ~own & ~signs & (codes != 0x200D)
        count = lambda x: np.add.reduceat(x, self.starts, dtype=np.int64) if len(stops) else np.zeros(0, np.int64)
        self.n_words = np.maximum(count(codes == 32) - 1, 0)
        self.own, self.other = count(own), count(other)

    def family(self) -> np.ndarray:
        """The family of each piece: 0 Devanagari, 1 Latin, -1 without letters."""
        return np.where(self.own + self.other == 0, -1, np.where(self.own > self.other, 0, 1))

    def some(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of some pieces, each with its end, and their sizes."""
        sizes = self.sizes[at] + 1
        flat = np.repeat(self.starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return self.codes[flat], self.sizes[at]


def _grams(codes: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """For each order, the hashed n-gram at every place; 1 << BITS where it would pass the end of its piece."""
    codes = codes.astype(np.uint64)
    ends = np.cumsum(sizes + 1) - 1
    room = np.repeat(ends, sizes + 1) - np.arange(len(codes))  # symbols left in the piece
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h[: len(codes) - n + 1] += codes[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            x = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            yield np.where(room >= n, (x >> np.uint64(64 - BITS)).astype(np.int32), 1 << BITS)


def _n_grams(sizes: np.ndarray) -> np.ndarray:
    return sum(np.maximum(sizes - n + 1, 0) for n in ORDERS)


def _mean_scores(codes: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Mean weight of each piece's n-grams, per machine."""
    table = np.append(weights, np.zeros((len(weights), 1), weights.dtype), axis=1).T.copy()  # what passes the end weighs nothing
    total = np.zeros((len(codes), len(weights)), np.float32)
    for grams in _grams(codes, sizes):
        total += table[grams]
    sums = np.add.reduceat(total, np.cumsum(sizes + 1) - sizes - 1, axis=0, dtype=np.float64)
    return sums / np.maximum(_n_grams(sizes), 1)[:, None]


def _fit_pair(feats: list[np.ndarray], y: np.ndarray, epochs: int) -> np.ndarray:
    """Averaged Pegasos: hinge loss on the mean of the n-grams' weights."""
    w, total, scale, rng = np.zeros(1 << BITS), np.zeros(1 << BITS), 1.0, np.random.default_rng(7)
    steps, kept = 0, 0
    first, second = np.flatnonzero(y > 0), np.flatnonzero(y < 0)
    if not len(first) or not len(second):
        return total.astype(np.float32)
    n = max(2 * max(len(first), len(second)), LEAST_STEPS)  # both languages in equal shares, however rare one is
    for _ in range(epochs):
        order = np.concatenate([rng.permutation(np.resize(rng.permutation(part), n // 2)) for part in (first, second)])
        for k in order.reshape(2, -1).T.ravel():
            steps += 1
            rate = 1.0 / (REGULAR * (steps + 1000))
            f = feats[k]
            margin = y[k] * scale * w[f].mean() if len(f) else 1.0
            scale *= 1 - rate * REGULAR
            if margin < 1:
                np.add.at(w, f, rate * y[k] / len(f) / scale)
        total += scale * w
        kept += 1
    return (total / kept).astype(np.float32)


class Model:
    """Pairwise machines per family."""

    def __init__(self, machines: dict[str, np.ndarray]):
        self.machines = machines

    def votes(self, codes: np.ndarray, sizes: np.ndarray, fam: str) -> np.ndarray:
        """Score per language of the family: mean of its machines' clipped margins."""
        langs, pairs = FAMILIES[fam], list(combinations(range(len(FAMILIES[fam])), 2))
        margins = np.clip(_mean_scores(codes, sizes, self.machines[fam]), -2, 2)
        out = np.zeros((len(sizes), len(langs)))
        for m, (a, b) in enumerate(pairs):
            out[:, a] += margins[:, m]
            out[:, b] -= margins[:, m]
        return out / max(1, len(langs) - 1)


def fit(rows: list[tuple[str, str]]) -> Model:
    """Machines from (label, text) rows; wrong labels are sieved out by fitting again without what they misplace."""
    machines = {}
    cut = [(label, s) for label, text in rows for s in sentences(fold(text, lines=True))]
    pieces = Pieces([s for _, s in cut])
    family = pieces.family() if cut else np.zeros(0, int)
    for f, (fam, langs) in enumerate(FAMILIES.items()):
        at = np.array([k for k, (label, _) in enumerate(cut) if label in langs and family[k] == f and pieces.n_words[k] >= LEAST_WORDS], np.int64)
        pairs = list(combinations(range(len(langs)), 2))
        if not len(at):
            machines[fam] = np.zeros((len(pairs), 1 << BITS), np.float32)
            continue
        labels = np.array([langs.index(cut[k][0]) for k in at], np.int64)
        codes, sizes = pieces.some(at)
        begins = np.cumsum(sizes + 1) - sizes - 1
        grams = list(_grams(codes, sizes))
        feats = [np.concatenate([g[b : b + max(n - k + 1, 0)] for k, g in zip(ORDERS, grams)]) for b, n in zip(begins, sizes)]
        keep = np.ones(len(at), bool)
        for turn in range(1, ROUNDS + 1):
            ws = []
            for a, b in pairs:
                some = np.flatnonzero(keep & ((labels == a) | (labels == b)))
                ws.append(_fit_pair([feats[k] for k in some], np.where(labels[some] == a, 1, -1), EPOCHS if turn == ROUNDS else SIEVE_EPOCHS))
            machines[fam] = np.stack(ws)
            keep = Model(machines).votes(codes, sizes, fam).argmax(1) == labels
    return Model(machines)


def _path(emit: np.ndarray) -> np.ndarray:
    """States of the best path: most evidence less SWITCH per change."""
    n, k = emit.shape
    tops = emit.argmax(1)[emit.any(1)]
    if len(tops) and (tops == tops[0]).all():  # all that speaks says the same
        return np.full(n, tops[0])
    best, back = emit[0].copy(), np.zeros((n, k), np.int64)
    for t in range(1, n):
        jump = best.argmax()
        stay = best >= best[jump] - SWITCH
        back[t] = np.where(stay, np.arange(k), jump)
        best = np.maximum(best, best[jump] - SWITCH) + emit[t]
    out = np.zeros(n, np.int64)
    out[-1] = best.argmax()
    for t in range(n - 1, 0, -1):
        out[t - 1] = back[t][out[t]]
    return out


def _judge(scores: np.ndarray) -> float:
    """Confidence: the logistic of the lead over the next language."""
    top = np.sort(scores)[::-1]
    return float(1 / (1 + np.exp(-2 * (top[0] - top[1]))))


def label_texts(model: Model, texts: list[str | None]) -> list[list[tuple[int, str, float, int]]]:
    """(seg_no, lang, confidence, letters) of each text: 0 for the document, 1.. for its segments; [] without letters."""
    cut = [sentences(fold(t, lines=True)) if t else [] for t in texts]
    flat = [s for ss in cut for s in ss]
    if not flat:
        return [[] for _ in texts]
    pieces = Pieces(flat)
    emit, weight = np.zeros((len(flat), len(LANGUAGES))), np.zeros(len(flat))
    family, size_of, sizes = pieces.family(), pieces.own + pieces.other, pieces.n_words
    for f, (fam, langs) in enumerate(FAMILIES.items()):
        at = np.flatnonzero((family == f) & (sizes > 0))
        if len(at):
            votes = model.votes(*pieces.some(at), fam)
            w = np.sqrt(sizes[at])
            emit[at] = -2.0 * w[:, None]  # a language of another family
            for j, lang in enumerate(langs):
                emit[at, LANGUAGES.index(lang)] = votes[:, j] * w
            weight[at] = w
    out, lo = [], 0
    for ss in cut:
        hi = lo + len(ss)
        e, n, size, wt = emit[lo:hi], size_of[lo:hi], sizes[lo:hi], weight[lo:hi]
        lo = hi
        if not n.any():
            out.append([])
            continue
        strong = size >= LEAST_WORDS
        states = _path(np.where(strong[:, None], e, 0.0) if strong.any() else e)
        if strong.any():  # what speaks for no language goes with the piece before it
            last = states[np.flatnonzero(strong)[0]]
            for k in range(len(states)):
                last = states[k] = states[k] if strong[k] else last
        runs, chars = [], np.zeros(len(LANGUAGES), np.int64)
        for k, s in enumerate(states):
            chars[s] += n[k]
            if runs and runs[-1][0] == s:
                runs[-1][1].append(k)
            else:
                runs.append((s, [k]))
        total = chars.argmax()
        mean = lambda ks: e[ks].sum(0) / max(wt[ks].sum(), 1e-9)
        own = [k for k, s in enumerate(states) if s == total]
        if len(runs) == 1:
            sure = _judge(mean(own))
            out.append([(k, LANGUAGES[total], sure, int(n.sum())) for k in (0, 1)])
            continue
        rows = [(0, LANGUAGES[total], _judge(mean(own)), int(n.sum()))]
        out.append(rows + [(i + 1, LANGUAGES[s], _judge(mean(ks)), int(n[ks].sum())) for i, (s, ks) in enumerate(runs)])
    return out


def training_rows(documents: DataFrame, per_stratum: int = SAMPLE, pool: int = POOL) -> list[tuple[str, str]]:
    """(label, text) of at most per_stratum labelled documents for each label and family, picked by the hash of their ids.

    They are taken from about pool documents under a threshold of that hash, so that the scan that reads the texts
    brings no more to the ranking, however large the corpus; texts of SAMPLE_CHARS or more are left out.
    """
    label = F.lower(F.trim("lang"))
    latin = F.octet_length("text") < 1.6 * F.length("text")  # Devanagari letters take three bytes
    steps = 1 << 20
    share = min(steps, -(-pool * steps // max(documents.count(), 1)))  # the count is in the files' footers
    some = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(steps)) < share).select("doc_id", label.alias("label"), "text", latin.alias("latin")).where(label.isin(*LANGUAGES) & F.length("text").between(40, SAMPLE_CHARS))
    order = [F.xxhash64("doc_id", F.lit(1)), F.col("doc_id"), F.col("text")]
    picked = some.withColumn("rank", F.row_number().over(Window.partitionBy("label", "latin").orderBy(*order))).where(F.col("rank") <= per_stratum)
    rows = picked.select("label", "text", "doc_id").collect()  # bounded: labels x families x per_stratum
    return [(r.label, r.text) for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.text))]


SCHEMA = "doc_id string, seg_no int, lang string, confidence double, n_letters long, n_segments int, label string"


def identify(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, seg_no, lang, confidence, n_letters, n_segments, label: row 0 for each document, and one for each of its segments.

    Null, empty and letterless texts yield no row; repeated documents theirs. label is the document's
    own, as stored. Every text is read whole.
    """
    model = model or fit(training_rows(documents))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 4 machines of 2**BITS weights

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch["text"]]
            lo, size = 0, 0
            for hi in range(1, len(texts) + 1):
                size += len(texts[hi - 1] or "")
                if size > BATCH_CHARS or hi == len(texts):
                    part = batch.iloc[lo:hi]
                    found = label_texts(shared.value, texts[lo:hi])
                    rows = [(d, *r, len(rs) - 1, x if isinstance(x, str) else None) for d, x, rs in zip(part["doc_id"], part["lang"], found) for r in rs]
                    yield pd.DataFrame(rows, columns=["doc_id", "seg_no", "lang", "confidence", "n_letters", "n_segments", "label"]).astype({"seg_no": "int32", "n_letters": "int64", "n_segments": "int32", "confidence": "float64"})
                    lo, size = hi, 0

    docs = documents.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), "text", "lang").where(F.length("text") > 0)
    return spread(docs, "doc_id").mapInPandas(run, SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))


def cases(labelled: DataFrame) -> DataFrame:
    """doc_id, seg_no, lang: documents with a missing or other label, and the segments of documents with several languages."""
    wrong = (F.col("seg_no") == 0) & ~F.lower(F.trim("label")).eqNullSafe(F.col("lang"))
    return labelled.where(wrong | (F.col("seg_no") > 0) & (F.col("n_segments") > 1)).select("doc_id", "seg_no", "lang")
