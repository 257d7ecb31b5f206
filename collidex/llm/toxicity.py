"""Operator 7: toxicity by a subsequence string kernel and Nystrom landmarks.

The kernel compares two words by their common subsequences of three and four signs,
gaps allowed within a span of ``SPAN`` signs; a subsequence spanning s signs weighs
``DECAY`` ^ s. An insult with inserted or missing signs keeps most of its subsequences.

A support vector machine is trained on Nystrom features, the kernel to landmark words
whitened by the landmarks' own kernel matrix. A sentence, and so a text, is as toxic
as its worst word, so training alternates between choosing each toxic sentence's worst
words and refitting (labels name documents, not words). A word of clean texts can be
one if its share of toxic texts is high: labels err, and words have plain uses. Weights on landmarks are
weights on their subsequences: the decision for a word is one table lookup per
subsequence, the same number as the sum over landmarks, in time linear in its length.

Single signs set apart ("i d i o t") are read as one word as well.
"""

from __future__ import annotations

import math
import pickle
import re
import unicodedata
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import table
from collidex.llm.quality import learnable, sample_of

SIGNS, SPAN, DECAY = 40, 7, 0.7
#: Most labelled rows that training uses.
MAX_TRAIN_ROWS = 3_000
LANDMARKS, NEGATIVES, HARD = 240, 2_500, 400
CACHE_WORDS = 400_000
OFFSETS = [c for size in (2, 3) for c in combinations(range(1, SPAN), size)]     # of the signs after the first
#: Signs often put for letters.
LOOKALIKES = dict(zip("@$013457!", "asoieasti"))
_APART = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]{1,2}[^\W_](?![^\W_])){2,}")


class _Signs(dict):
    """Sign of each character, worked out when first met: 2-27 a-z, 28-37 other letters by hash, 38 other signs; none for punctuation."""

    def __missing__(self, at: int):
        c = LOOKALIKES.get(chr(at), chr(at))
        if "a" <= c <= "z":
            self[at] = ord(c) - 95
        elif c.isalpha():
            self[at] = 28 + ord(c) % 10
        else:
            self[at] = None if unicodedata.category(c)[0] in "PSZC" else 38
        return self[at]


_SIGNS = _Signs()


def codes(words: list[str], gap: int = 0) -> np.ndarray:
    """Signs of words in one row: 1 starts a word, 39 ends it, and ``gap`` zeros follow."""
    tail = chr(39) + chr(0) * gap
    return np.frombuffer("".join([chr(1) + w.translate(_SIGNS) + tail for w in words]).encode("latin-1"), np.uint8).astype(np.int64)


def code(word: str) -> np.ndarray:
    return codes([word])


def units(text: str | None) -> set[str]:
    """Distinct lower-case words of the whole text, and runs of single signs joined."""
    low = text.lower() if isinstance(text, str) else ""
    found = set(low.split())
    found.update("".join(re.findall(r"[^\W_]", m[0])) for m in _APART.finditer(low))
    return {w.strip(".,;:!?()\"'&#%|*$<>[]{}=") for w in found} - {""}


def size_of(n: int) -> float:
    """Norm of a word of ``n`` signs: the root of its subsequences' squared weights."""
    return math.sqrt(sum(DECAY ** (2 * (o[-1] + 1)) * max(0, n - o[-1]) for o in OFFSETS)) or 1.0


_SIZES = [size_of(n) for n in range(64)]


def norm(n: int) -> float:
    return _SIZES[n] if n < 64 else size_of(n)


def subsequences(signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and weight of each subsequence of a word."""
    at, weight = [], []
    for o in OFFSETS:
        m = len(signs) - o[-1]
        if m > 0:
            i = signs[:m].copy()
            for x in o:
                i = i * SIGNS + signs[x:x + m]
            at.append(i)
            weight.append(np.full(m, DECAY ** (o[-1] + 1)))
    return (np.concatenate(at), np.concatenate(weight)) if at else (np.empty(0, np.int64), np.empty(0))


class Kernel:
    """Kernel of words to fixed landmark words."""

    def __init__(self, landmarks: list[str]):
        index, col, val = [], [], []
        for j, w in enumerate(landmarks):
            s = code(w)
            i, x = subsequences(s)
            index.append(i)
            col.append(np.full(len(i), j))
            val.append(x / norm(len(s)))
        index, col, val = map(np.concatenate, (index, col, val))
        self.keys, inverse = np.unique(index, return_inverse=True)
        self.m = len(landmarks)
        self.dense = np.zeros((len(self.keys), self.m), np.float32)
        np.add.at(self.dense, (inverse, col), val)

    def __call__(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.m), np.float32)
        for r, w in enumerate(words):
            s = code(w)
            i, x = subsequences(s)
            p = np.minimum(np.searchsorted(self.keys, i), len(self.keys) - 1)
            hit = self.keys[p] == i
            out[r] = (self.dense[p[hit]] * x[hit, None]).sum(0) / norm(len(s))
        return out

    def table(self, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.keys, (self.dense @ beta).astype(np.float32)


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient descent."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w, z, t = np.zeros(x1.shape[1]), np.zeros(x1.shape[1]), 1.0
    lip = 1 + 2 * c * float(np.linalg.eigvalsh((x1 * weight[:, None]).T @ x1)[-1])
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x1 @ z)) * weight
        new = z - (np.append(z[:-1], 0) - 2 * c * x1.T @ (y * slack)) / lip
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        w, z, t = new, new + (t - 1) / t2 * (new - w), t2
    return w[:-1], w[-1]


def _grams(word: str) -> set[str]:
    s = "^" + word
    return {s[i:i + k] for k in (4, 5, 6) for i in range(len(s) - k + 1)}


def _train(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["h", "doc_id"])
    docs, y = [units(t) for t in pdf["text"]], pdf["y"].to_numpy()
    rng = np.random.default_rng(5)
    # first guess of the worst words: pieces of words far more frequent in toxic texts
    seen = (Counter(), Counter())
    held = (Counter(), Counter())                   # texts by word
    for u, toxic in zip(docs, y):
        held[toxic].update(u)
    for words, grams in zip(held, seen):
        for w, c in words.items():
            for g in _grams(w):
                grams[g] += c
    n = [max(1, int((y == k).sum())) for k in (0, 1)]
    gram = {}
    for g, c in seen[1].items():
        if c >= max(3, n[1] // 400):
            c, c0 = min(c, n[1]), min(seen[0][g], n[0])
            share = (c + c0) / (n[0] + n[1])
            gram[g] = (c / n[1] - c0 / n[0]) / math.sqrt(share * (1 - share) * (1 / n[0] + 1 / n[1]) + 1e-12)
    base = n[1] / (n[0] + n[1])

    def leans(w: str) -> bool:
        """Whether a word is found in toxic texts alone, or in far more of them than chance has it (their smoothed share)."""
        toxic, clean = held[1][w], held[0][w]
        return toxic > 0 and (not clean or (toxic + base) / (toxic + clean + 1) >= base + 0.75 * (1 - base))

    guess = {w: max((gram.get(g, 0.0) for g in _grams(w)), default=0.0) for w in held[1]}
    worst: Counter = Counter()
    for u, toxic in zip(docs, y):
        if toxic and u:
            top = max(guess[w] for w in u)
            worst.update(w for w in u if top > 3 and guess[w] >= 0.5 * top and leans(w))
    if not worst:
        return pd.DataFrame({"model": [pickle.dumps(None)]})
    common = sorted(w for w in held[0] if len(w) > 2 and not leans(w))
    negatives = [common[i] for i in rng.permutation(len(common))[:NEGATIVES]]
    toxic_docs = [sorted(u) for u, t in zip(docs, y) if t and u]
    model, hard = None, []
    for _ in range(3):
        positives = [w for w, _ in worst.most_common(NEGATIVES)]
        marks = [positives[i] for i in rng.permutation(len(positives))[:LANDMARKS // 2]]
        marks += [hard[i] for i in rng.permutation(len(hard))[:LANDMARKS // 4]]
        marks += [negatives[i] for i in rng.permutation(len(negatives))[:LANDMARKS - len(marks)]]
        kernel = Kernel(marks)
        value, vector = np.linalg.eigh(kernel(marks).astype(float))
        white = vector / np.sqrt(np.maximum(value, 1e-3)) @ vector.T
        train = positives + negatives + hard
        sign = np.array([1.0] * len(positives) + [-1.0] * (len(negatives) + len(hard)))
        weight = np.concatenate([np.full(len(x), 1000 / max(1, len(x))) for x in (positives, negatives, hard)])
        w, bias = support_vectors(kernel(train) @ white, sign, weight)
        model = Model(*kernel.table(white @ w), bias)
        # hardest clean words join the negatives; each toxic text names its worst words anew
        value = model.words(common)
        hard = sorted(set(hard) | {common[i] for i in np.argsort(-value)[:HARD] if value[i] > -0.5})
        worst = Counter()
        known = dict(zip(held[1], model.words(list(held[1]))))
        for u in toxic_docs:
            f = np.array([known[w] for w in u])
            worst.update(u[i] for i in np.flatnonzero((f >= 0.5 * f.max()) & (f > 0)) if leans(u[i]))
        if not worst:
            break
    top = np.array([model.text(None, u) for u in docs])
    model.fit_scale(top, y)
    return pd.DataFrame({"model": [zlib.compress(pickle.dumps((model.keys, model.value, model.bias, model.scale)), 1)]})


class Model:
    def __init__(self, keys, value, bias, scale=(1.0, 0.0)):
        self.keys, self.value, self.bias, self.scale = keys, value, bias, scale
        self.weights = np.zeros(SIGNS ** 4, np.float32)
        self.weights[keys] = value
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.keys, self.value, self.bias, self.scale

    def __setstate__(self, state):
        self.__init__(*state)

    def words(self, words: list[str]) -> np.ndarray:
        """Decision value of each word: all words in one row of signs, one lookup per subsequence."""
        if not words:
            return np.empty(0)
        row = codes(words, SPAN)
        start = np.flatnonzero(row == 1)
        inside = row > 0
        length = np.add.reduceat(inside.astype(np.int64), start)
        row = np.concatenate([row, np.zeros(SPAN, np.int64)])
        total = np.zeros(len(inside))
        for o in OFFSETS:
            i = row[:len(inside)]
            for x in o:
                i = i * SIGNS + row[x:x + len(inside)]
            total += np.where(inside & (row[o[-1]:o[-1] + len(inside)] > 0), self.weights[i], 0) * DECAY ** (o[-1] + 1)
        return np.add.reduceat(total, start) / np.array([norm(n) for n in length]) + self.bias

    def text(self, text: str | None, found: set[str] | None = None) -> float:
        """Decision value of the worst word; the bias alone for a text without words."""
        found = units(text) if found is None else found
        fresh = [w for w in found if w not in self.cache]
        if fresh:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
                fresh = list(found)
            for i in range(0, len(fresh), 4096):
                part = fresh[i:i + 4096]
                self.cache.update(zip(part, self.words(part).tolist()))
        return max((self.cache[w] for w in found), default=self.bias)

    def fit_scale(self, f: np.ndarray, y: np.ndarray):
        """Logistic scale and shift that turn the decision value into a probability."""
        a, b = 2.0, 0.0
        for _ in range(500):
            p = 1 / (1 + np.exp(-np.clip(a * f + b, -30, 30)))
            g, s = p - y, np.maximum(p * (1 - p), 1e-6)
            h = np.array([[(s * f * f).sum() + 1e-3, (s * f).sum()], [(s * f).sum(), s.sum() + 1e-3]])
            d = np.linalg.solve(h, [(g * f).sum() + 1e-3 * a, g.sum()])
            a, b = a - 0.5 * d[0], b - 0.5 * d[1]
        self.scale = (float(a), float(b))

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.scale[0] * self.text(text) + self.scale[1]))))


def train(sample: DataFrame) -> Model | None:
    """The model fitted on the bounded sample, in one task; None where nothing tells toxic texts apart."""
    if sample.select("y").distinct().count() < 2:
        return None
    row = sample.groupBy(F.lit(1).alias("one")).applyInPandas(_train, "model binary").first()
    raw = bytes(row["model"])
    state = pickle.loads(zlib.decompress(raw)) if raw[:1] == b"x" else None
    return Model(*state) if state else None


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn=None, threshold: float = 0.7,
                    max_train_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, score, predicted``.

    ``score`` is the probability of label 1, by the text's worst word. Null and empty texts
    score as texts without any word; null ids and repeated rows each get a row; other columns
    are not read; an empty table gives an empty result. Without labels of both kinds every
    score is 0. Labels given twice count as their larger one.
    """
    model = train(sample_of(docs, labels, "toxic", learn or (lambda _: F.lit(True)), max_train_rows))
    if model is None:
        scored = docs.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def score(texts: pd.Series) -> pd.Series:
            return pd.Series([shared.value.score(t) for t in texts], dtype=float)

        scored = docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = learnable(3, 1)
    out = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), learn)
    return out.select("doc_id", F.coalesce(~learn(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted")
