"""Ordinal cumulative-link regression on graded ratings over hashed text.

A document is a set of hashed features: its distinct words (A-Z lowered, outer punctuation stripped) and coarse shape
marks (share of symbols, of repeated 3-word windows, of lone symbols, size). One weight per hash gives a score, ordered
thresholds cut it into grades: P(grade <= k) = logistic(threshold_k - score). The fit takes a bounded, documented sample
of rated documents (`sample_docs`, those of smallest hash), a fifth of it held out first to choose the weight penalty; scoring reads
every text whole.

Grades: 0 toxic, 1 low quality, 2 good. A document is selected when P(grade >= 2) is at least `cut`.

Edge cases: a null or empty text has only shape marks; null ratings are left out of the fit; documents rated twice count
twice; rows that repeat a doc_id are scored each; without ratings every score is 0 and the thresholds stay at their
start, which selects everything; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, keyed, slices, sort_within, text_chunks, word_codes
from .rules import _measure

GRADES = 3
_OUTER = b".,;:!?\"'()[]"


def _shape(m: dict[str, np.ndarray]) -> list[list[bytes]]:
    """Marks with a level each; a higher level keeps the lower ones, so weights add up along an ordered scale."""
    n = np.maximum(m["n_words"], 1)
    levels = {
        b"sym": np.minimum(10, 50 * m["n_symbols"] // np.maximum(m["word_chars"], 1)), b"rep": np.minimum(10, 10 * m["n_repeat_words"] // n),
        b"lone": np.minimum(10, 20 * m["n_lone_symbols"] // n), b"dup": np.minimum(5, 5 * m["n_dup_lines"] // np.maximum(m["n_lines"], 1)),
        b"small": np.where(m["n_words"] < 20, 2, np.where(m["n_words"] < 50, 1, 0)), b"all": np.ones(len(n), np.int64),
    }
    return [[b"\x00%s%d" % (k, i) for k, v in levels.items() for i in range(1, int(v[d]) + 1)] for d in range(len(n))]


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number per text): distinct feature hashes of each text."""
    codes, counts, uniq = word_codes(texts, lower=True)
    h = hash_words([w.strip(_OUTER) or w for w in uniq])
    marks = _shape(_measure(texts))
    n_marks = np.fromiter(map(len, marks), np.int64, len(marks))
    total = counts + n_marks
    doc, first = np.repeat(np.arange(len(texts)), total), np.cumsum(total) - total
    all_h = np.empty(len(doc), np.uint64)
    all_h[slices(first, counts)] = h[codes] if len(codes) else 0
    all_h[slices(first + counts, n_marks)] = hash_words([x for d in marks for x in d])
    all_h = sort_within(all_h, total)
    keep = np.ones(len(doc), bool)
    keep[1:] = (all_h[1:] != all_h[:-1]) | (doc[1:] != doc[:-1])
    return all_h[keep], np.bincount(doc[keep], minlength=len(texts))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Ordinal:
    """hashes: sorted feature hashes that have a weight; thresholds: ascending."""

    hashes: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([-4.0, -3.0]))

    def scores(self, h: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(counts))
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        w = np.where(self.hashes[at] == h, self.weights[at], 0.0)
        return np.bincount(np.repeat(np.arange(len(counts)), counts), weights=w, minlength=len(counts))

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2 as columns."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _nll(model: Ordinal, h: np.ndarray, counts: np.ndarray, grade: np.ndarray) -> float:
    """Mean negative log likelihood of the grades."""
    p = model.at_least(model.scores(h, counts))
    p = np.c_[np.ones(len(p)), p, np.zeros(len(p))]
    at = np.arange(len(grade))
    return float(-np.log(np.maximum(p[at, grade] - p[at, grade + 1], 1e-9)).mean())


def fit_penalised(h: np.ndarray, counts: np.ndarray, grade: np.ndarray, strengths: tuple[float, ...] = (0.1, 0.25, 0.5, 1.0, 2.0)) -> Ordinal:
    """Fit with the strength of the penalty on weights' sizes that does best on every fifth document, held out of the first fits."""
    if not len(grade):
        return Ordinal()
    held = np.arange(len(grade)) % 5 == 0
    row = np.repeat(held, counts)
    loss = [_nll(fit(h[~row], counts[~held], grade[~held], l1=x), h[row], counts[held], grade[held]) for x in strengths]
    return fit(h, counts, grade, l1=strengths[int(np.argmin(loss))])


def fit(h: np.ndarray, counts: np.ndarray, grade: np.ndarray, min_docs: int = 4, rounds: int = 250, rate: float = 0.05, l2: float = 1e-3, l1: float = 1.0, check: int = 25) -> Ordinal:
    """Weights of the features that at least `min_docs` documents hold, by Adam on the mean negative log likelihood, with penalties on the weights' squares and sizes. The penalty on sizes is
    in proportion to the chance spread of a weight's gradient, so a feature that varies with the grade no more than
    chance would have it stays at exactly 0, be it frequent or rare. Every `check` rounds the gradients of all
    features say which weights may leave 0; the rounds between move only those. Thresholds are a first one and positive gaps, so they stay ordered."""
    if not len(grade):
        return Ordinal()
    doc = np.repeat(np.arange(len(counts)), counts)
    hashes, code, df = np.unique(h, return_inverse=True, return_counts=True)
    use = df >= min_docs
    hashes, new = hashes[use], np.cumsum(use) - 1
    keep = use[code]
    code, doc = new[code[keep]], doc[keep]
    w, th = np.zeros(len(hashes)), np.array([-1.0, 0.0])  # first threshold, log of the gap
    state = [np.zeros(len(w)), np.zeros(len(w)), np.zeros(2), np.zeros(2)]
    n = len(grade)
    df = np.bincount(code, minlength=len(w)) / n
    size = 0.5 * l1 * np.sqrt(df * (1 - df) / n)
    live, own, at = np.zeros(len(w), bool), code[:0], doc[:0]
    for step in range(1, rounds + 1):
        s = np.bincount(at, weights=w[live][own], minlength=n)  # all other weights are 0
        t = np.array([th[0], th[0] + np.exp(th[1])])
        lo = np.where(grade > 0, _sigmoid(t[np.maximum(grade - 1, 0)] - s), 0.0)
        hi = np.where(grade < GRADES - 1, _sigmoid(t[np.minimum(grade, GRADES - 2)] - s), 1.0)
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        ds = (dhi - dlo) / n  # the loss grows with the score where the upper bound falls
        dt = np.array([(-(dhi * (grade == k)) + dlo * (grade == k + 1)).sum() / n for k in range(GRADES - 1)])
        if step % check == 1:
            live = (w != 0) | (np.abs(np.bincount(code, weights=ds[doc], minlength=len(w))) > size)
            in_use = live[code]
            own, at = (np.cumsum(live) - 1)[code[in_use]], doc[in_use]
        wl, ml, vl = w[live], state[0][live], state[1][live]
        gw, gt = np.bincount(own, weights=ds[at], minlength=len(wl)) + l2 * wl, np.array([dt.sum(), dt[1] * np.exp(th[1])])
        r = rate * (1 - step / (rounds + 1))
        for x, g, m, v in ((wl, gw, ml, vl), (th, gt, state[2], state[3])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            x -= r * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        scale = r / (np.sqrt(vl / (1 - 0.999**step)) + 1e-8)  # of this step's move, by weight
        w[live] = np.sign(wl) * np.maximum(np.abs(wl) - scale * size[live], 0.0)
        state[0][live], state[1][live] = ml, vl
    return Ordinal(hashes, w.astype(np.float32), np.array([th[0], th[0] + np.exp(th[1])]))


def grades(labels: DataFrame) -> DataFrame:
    """doc_id and grade from quality and toxic; rows with a null in any of the three are left out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("toxic") == 1, 0).when(F.col("toxic") == 0, F.when(F.col("quality") == 1, 2).when(F.col("quality") == 0, 1)).alias("grade"))
    return rows.dropna()


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = 8000) -> Ordinal:
    """Fit on at most `sample_docs` rated documents. Features are made in tasks; only hashes reach the driver."""
    chosen = grades(labels).orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_docs)
    rows = keyed(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")  # at most sample_docs rows of two numbers

    def run(batches):
        for b, texts in text_chunks(batches):
            h, counts = features(texts)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([h[e - k : e].tobytes() for e, k in zip(ends, counts)], pa.binary())], names=["doc_id", "grade", "h"])

    got = rows.mapInArrow(run, "doc_id long, grade int, h binary").collect()
    got.sort(key=lambda r: (r["doc_id"], r["grade"], bytes(r["h"])))
    parts = [np.frombuffer(r["h"], np.uint64) for r in got]
    return fit_penalised(np.concatenate(parts) if parts else np.empty(0, np.uint64), np.array([len(p) for p in parts], np.int64), np.array([r["grade"] for r in got], np.int64))


def score(docs: DataFrame, model: Ordinal, cut: float = 0.5) -> DataFrame:
    """doc_id, th, expected_grade, p_good (P(grade >= 2)), p_safe (P(grade >= 1)), selected; one row per document."""

    def run(batches):
        for b, texts in text_chunks(batches):
            p = model.at_least(model.scores(*features(texts)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p.sum(1)), pa.array(p[:, 1]), pa.array(p[:, 0]), pa.array(p[:, 1] >= cut)], names=["doc_id", "th", "expected_grade", "p_good", "p_safe", "selected"])

    return keyed(docs).mapInArrow(run, "doc_id long, th long, expected_grade double, p_good double, p_safe double, selected boolean")


def select(docs: DataFrame, model: Ordinal, cut: float = 0.5) -> DataFrame:
    """The documents that are selected, with all their columns; one pass, no join."""
    at = docs.schema.names.index("text")

    def run(batches):
        for b, texts in text_chunks(batches):
            yield b.filter(pa.array(model.at_least(model.scores(*features(texts)))[:, 1] >= cut))

    return docs.mapInArrow(run, docs.schema) if at >= 0 else docs
