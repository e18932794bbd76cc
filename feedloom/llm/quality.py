"""Quality classifier: weak labels joined by expectation-maximisation, and a hashed scorer.

Overlapping heuristic labellers vote good (+1), bad (-1) or abstain (0) on each whole text. The
votes of all documents are counted per pattern (at most 3 ** labellers rows). Expectation-
maximisation estimates each labeller's vote distribution on good and on bad documents and the
share of bad ones, without any given label. The posterior of each pattern labels a bounded
sample of documents, on which a logistic regression over hashed features of word shapes is
trained. The sample is drawn from the good and from the bad patterns separately, and its rows
stand for as many texts as they were drawn from, a class for LEAST_SHARE at least: a class too
rare to move the regression would never be found. The score, the probability of bad quality, is
then computed for every whole text.

Defined results: null and empty texts, and texts of fewer than LEAST_WORDS words, have no
evidence: they score the share of bad documents, at most half the rejection limit, and are
kept; so is every document if the posteriors of all documents agree. Repeated rows score alike; an empty table
gives an empty result; columns named quality_score and rejected are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, drop_saved, give_back_memory, saved
from .shingles import _SPACE, mix64, raw_bytes, words

#: The scorer is fitted on at most this many rows, those of least hash of their text in each class;
#: a class gets its share of them, and a quarter at least if it has as many texts.
TRAIN_ROWS = 4000
#: Least share of the training weight of the good and of the bad class.
LEAST_SHARE = 0.1
#: Hashed feature space.
BINS = 1024
#: A document is rejected from this probability of bad quality on.
REJECT = 0.6
#: Texts with fewer words give no votes.
LEAST_WORDS = 8
#: Labellers that see one defect vote bad or abstain; prose and flow see several and vote both ways.
LABELLERS = ("symbols", "stutter", "capitals", "bare marks", "repetition", "sentences", "prose", "flow")

_UPPER, _DIGIT, _MARK, _SYMBOL, _LETTER = (np.zeros(256, bool) for _ in range(5))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[list(b".,;:?!'\"()-")] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_SYMBOL[33:127] = True
_SYMBOL &= ~(_LETTER | _DIGIT | _MARK)


class Shapes:
    """Per word of a batch: its row, hash, length and counts of byte classes."""

    def __init__(self, texts: pa.Array):
        body, at = raw_bytes(texts)
        self.rows = len(texts)
        self.row, self.hash = words(texts)
        n = len(self.row)
        inside = ~_SPACE[body]
        start, end = inside.copy(), inside.copy()
        if len(body):
            start[1:] &= ~inside[:-1]
            end[:-1] &= ~inside[1:]
            cuts = at[(at > 0) & (at < len(body))]
            start[cuts], end[cuts - 1] = inside[cuts], inside[cuts - 1]
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.length = e - s
        count = lambda kind: np.add.reduceat(kind[body].astype(np.int32), s) if n else np.zeros(0, np.int32)
        # bytes between two words are white space, which is of no class
        self.upper, self.digit, self.mark, self.symbol, self.letter = map(count, (_UPPER, _DIGIT, _MARK, _SYMBOL, _LETTER))
        self.last = body[e - 1] if n else np.zeros(0, np.uint8)
        self.same = np.zeros(n, bool)
        if n:
            self.same[1:] = (self.hash[1:] == self.hash[:-1]) & (self.row[1:] == self.row[:-1])
        self.n = np.bincount(self.row, minlength=self.rows).astype(float)

    def total(self, per_word: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=per_word, minlength=self.rows)

    def votes(self) -> np.ndarray:
        """(rows, labellers) of -1, 0, 1."""
        n = np.maximum(self.n, 1)
        size = np.maximum(self.total(self.length), 1)
        order = np.lexsort((self.hash, self.row))
        r, h = self.row[order], self.hash[order]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
        distinct = np.bincount(r[new], minlength=self.rows)
        per_word = lambda x: self.total(x) / n
        symbols, stutter = self.total(self.symbol) / size, per_word(self.same)
        capitals = self.total(self.upper) / np.maximum(self.total(self.letter), 1)
        rich = distinct / np.sqrt(n)
        plain = per_word((self.symbol == 0) & (self.letter > 0) & (self.mark <= 1) & (2 * self.upper <= self.letter + 2))
        stops = per_word(np.isin(self.last, list(b".?!,;:")))
        bare = per_word((self.letter == 0) & (self.digit == 0))
        out = np.zeros((self.rows, len(LABELLERS)), np.int8)
        many = n >= 30
        for k, bad in enumerate((symbols >= 0.08, stutter >= 0.25, capitals >= 0.5, bare >= 0.2,
                                 many & (rich <= 1.5), many & ((stops == 0) | (stops > 0.6)))):
            out[bad, k] = -1
        even = (stutter <= 0.05) & ~(many & (rich <= 1.5))
        out[:, 6] = np.where((plain >= 0.85) & even, 1, np.where(plain < 0.65, -1, 0))
        calm = (symbols <= 0.03) & (bare <= 0.05) & (capitals <= 0.2) & (stops <= 0.4)
        out[:, 7] = np.where(calm & (rich >= 2.5) & (stutter <= 0.05), 1, np.where((stutter >= 0.2) | (many & (rich <= 2)), -1, 0))
        out[self.n < LEAST_WORDS] = 0
        return out

    def features(self) -> np.ndarray:
        """(rows, BINS): square roots of the shares of hashed word shapes and shape pairs."""
        level = lambda x, top: np.minimum(x, top).astype(np.uint64)
        case = np.where(self.upper == 0, 0, np.where(self.upper * 2 > self.letter, 2, 1)).astype(np.uint64)
        shape = (level(self.length, 15) + (case << np.uint64(4)) + (level(self.symbol, 3) << np.uint64(6))
                 + (level(self.mark, 3) << np.uint64(8)) + (level(self.digit, 3) << np.uint64(10))
                 + (self.same.astype(np.uint64) << np.uint64(12)))
        coarse = shape >> np.uint64(4)
        pair = coarse.copy()
        if len(pair):
            pair[1:] = np.where(self.row[1:] == self.row[:-1], coarse[1:] * np.uint64(4096) + coarse[:-1], coarse[1:])
        out = np.zeros(self.rows * BINS)
        for salt, code in enumerate((shape, coarse, pair)):
            bins = (mix64(code + np.uint64(salt << 40)) % np.uint64(BINS)).astype(np.int64)
            out += np.bincount(self.row * BINS + bins, minlength=len(out))
        # few words are little evidence: short texts stay near the bias
        return np.sqrt(out.reshape(self.rows, BINS) / (self.n + 8)[:, None])


def _pieces(texts: pa.Array, rows: int = 512):
    yield from (texts.slice(i, rows) for i in range(0, len(texts), rows))
    give_back_memory()


def _pattern(texts: pa.Array) -> pa.Array:
    """The votes as one number in base 3; null without a word."""
    out = []
    for piece in _pieces(texts):
        s = Shapes(piece)
        code = ((s.votes() + 1) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)
        out.append(pa.array(code.astype(np.int32), mask=s.n == 0))
    return pa.concat_arrays(out) if out else pa.array([], pa.int32())


def votes_of(code: np.ndarray) -> np.ndarray:
    return (code[:, None] // 3 ** np.arange(len(LABELLERS))) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> tuple[float, np.ndarray]:
    """(share of bad documents, posterior of bad per pattern) by expectation-maximisation.

    patterns: (n, labellers) of 0 bad, 1 abstain, 2 good. Each labeller has one accuracy of its
    votes; an abstention says nothing. Accuracies start at 0.8 and carry a weak prior of it, so
    a labeller that rarely votes stays near it; none may fall to chance, which fixes which of
    the two classes is the bad one."""
    n = counts.sum()
    if not n:
        return 0.0, np.zeros(0)
    bad, good = (patterns == 0).astype(float), (patterns == 2).astype(float)
    accuracy, share, post = np.full(patterns.shape[1], 0.8), 0.2, np.zeros(len(counts))
    for _ in range(rounds):
        odds = (bad - good) @ np.log(accuracy / (1 - accuracy)) + np.log(share / (1 - share))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        right = (counts * new) @ bad + (counts * (1 - new)) @ good
        accuracy = np.clip((right + 8) / (counts @ (bad + good) + 10), 0.55, 0.99)
        share = float(np.clip((counts @ new + 1) / (n + 2), 0.01, 0.99))
        moved, post = np.abs(new - post).max(), new
        if moved < 1e-6:
            break
    return share, post


def fit_scorer(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Logistic regression on soft labels by accelerated descent; the last weight is the bias."""
    weight = weight / weight.sum()
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float32)
    w, speed = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    rate = 4.0 / max((x * x).sum(axis=1).mean(), 1e-9)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -50, 50)))
        g = x.T @ ((p - y) * weight).astype(np.float32) + l2 * np.r_[w[:-1], 0]
        speed = 0.9 * speed - 0.3 * rate * g
        w = w + speed
    return w


def _packed(texts: pa.Array) -> pa.Array:
    out = [f.astype(np.float16).tobytes() for piece in _pieces(texts) for f in Shapes(piece).features()]
    return pa.array(out, pa.binary())


def fit(docs: DataFrame, text: str = "text") -> dict:
    """The fitted model: share of bad documents, posterior per vote pattern, scorer weights."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text).alias("t")).where(F.col("t").isNotNull())
    pattern, packed = F.arrow_udf(_pattern, "int"), F.arrow_udf(_packed, "binary")
    marks = saved(texts.select(F.xxhash64("t").alias("h"), pattern("t").alias("code")).where(F.col("code").isNotNull())
                       .groupBy("h", "code").agg(F.count(F.lit(1)).alias("n")), "votes")
    counted = marks.groupBy("code").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts")).collect()  # at most 3 ** 8 rows
    code = np.array([r["code"] for r in counted], np.int64)
    share, post = estimate(votes_of(code), np.array([r["n"] for r in counted], float))
    model = {"share": share, "posterior": dict(zip(code.tolist(), post.tolist(), strict=True)), "weights": None}
    bad = post > 0.5
    distinct = np.array([r["texts"] for r in counted], np.int64)
    texts_of = {True: int(distinct[bad].sum()), False: int(distinct[~bad].sum())}
    if not min(texts_of.values()):
        drop_saved(marks)
        return model
    # the sample: distinct texts of least hash, so copies cannot fill it
    weight_of: dict[int, float] = {}
    rows_of = sample_sizes(texts_of[True], texts_of[False])
    for kind, rows in zip((True, False), rows_of, strict=True):
        of_kind = F.col("code").isin(code[bad].tolist()) == F.lit(kind)
        top = -2**63 + min(2 * rows * 2**64 // texts_of[kind], 2**64 - 1)  # holds about twice as many rows
        least = sorted(r["h"] for r in marks.where(of_kind & (F.col("h") <= F.lit(top))).select("h").collect())[:rows]
        part = max(texts_of[kind] / sum(texts_of.values()), LEAST_SHARE)
        part = min(part, 1 - LEAST_SHARE)
        weight_of |= dict.fromkeys(least, part / max(len(least), 1))
    drop_saved(marks)
    picked = F.broadcast(docs.sparkSession.createDataFrame([(h,) for h in weight_of], "h long"))  # at most TRAIN_ROWS rows
    rows = (texts.withColumn("h", F.xxhash64("t")).join(picked, "h").dropDuplicates(["h"])
                 .select("h", pattern("t").alias("code"), packed("t").alias("x")).collect())  # 2 KB each
    rows = sorted(rows, key=lambda r: r["h"])
    y = np.array([model["posterior"][r["code"]] for r in rows])
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    model["weights"] = fit_scorer(x, y, np.array([weight_of[r["h"]] for r in rows]))
    return model


def sample_sizes(bad: int, good: int) -> tuple[int, int]:
    """Rows of the sample from so many bad and good texts."""
    if bad + good <= TRAIN_ROWS:
        return bad, good
    few = min(bad, good)
    few = min(few, max(TRAIN_ROWS // 4, round(TRAIN_ROWS * few / (bad + good))))
    return (few, TRAIN_ROWS - few) if bad <= good else (TRAIN_ROWS - few, few)


def score(text: Column, model: dict) -> Column:
    """Probability of bad quality of a whole text."""
    weights, share = model["weights"], model["share"]

    def run(texts: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for piece in _pieces(texts):
            s = Shapes(piece)
            if weights is None:
                out.append(np.full(len(piece), min(share, REJECT / 2)))
                continue
            p = 1 / (1 + np.exp(-np.clip(s.features() @ weights[:-1] + weights[-1], -50, 50)))
            out.append(np.where(s.n < LEAST_WORDS, min(share, REJECT / 2), p))
        return pa.array(np.concatenate(out))

    return F.arrow_udf(run, "double")(text)


def classify(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with quality_score (probability of bad quality) and rejected (boolean)."""
    docs = docs.drop(*(c for c in docs.columns if c.lower() in ("quality_score", "rejected")))
    scored = docs.withColumn("quality_score", score(F.col(text), fit(docs, text)))
    return scored.withColumn("rejected", F.col("quality_score") >= REJECT)
