"""Quality classification by co-training.

A document is good if it is labelled of quality and not toxic. Two views of a
document have a logistic classifier each: its text (binned style measures,
and the presence of the ``WORDS`` most telling word buckets) and its page
metadata (source, language, length column). Both start from the labelled
sample. In each of ``ROUNDS`` rounds each classifier labels every document
without a label that it is sure of (calibrated probability beyond ``SURE``)
for the other one, all over the table; what a document was labelled in an
earlier round stays. These labels need no storage, they follow from the
classifiers of the rounds before. Together the pseudo-labels of a class weigh
at most as much as its labels.

A classifier is fitted to labels and pseudo-labels in ``PASSES`` steps a
round: a pass over all rows sums the gradient of the pseudo-labelled ones at
the present weights, and the driver minimises the loss of the labelled sample
with that gradient in it as a linear term (a surrogate likelihood), so one
vector per task travels, and no row. Each view is
calibrated (Platt) on labelled documents kept out of training, a logistic
over the two calibrated logits combines them, and all documents are scored.

Texts are read twice: those of the labelled sample to choose features, and all
to find them, which are written once; rounds and scores read these.

Bounded sample, lowest hash of id first: ``LABELLED`` labelled documents, one
row an id. By crc32 of the id, seven in ten train, two calibrate, one is held
out of both (``held_out``).

Edge cases: null text is empty; null metadata is a value of its own; labels
of absent documents are ignored, several labels of one document count at
their worst, a null label says nothing; of rows that repeat a labelled id the
smallest one trains; repeated rows without a label count and are scored each;
without labels of both classes every score is 0.5 and everything is kept; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import materialise
from canvass.llm.decontaminate import words_of
from canvass.operators import join_dimension

LABELLED = 6000
WORDS, BUCKETS = 512, 1 << 20
BINS = 8
ROUNDS, SURE = 4, 0.95
META = 1 << 10
PASSES = 2
KEEP = 0.5

_CLASSES = [
    range(65, 91), range(97, 123), range(48, 58), [124], [33, 63], [35, 36, 37, 38, 42],
    [10], [32], [46, 44], range(128, 256),
]


def style(text: str) -> np.ndarray:
    """Shape of a text: sizes, shares of kinds of characters, repetition."""
    raw = np.frombuffer(text.encode(), np.uint8)
    n = max(len(raw), 1)
    counts = np.bincount(raw, minlength=256)
    words, lines = text.split(), text.split("\n")
    k = max(len(words), 1)
    seen = Counter(words)
    top = seen.most_common(1)[0][1] if seen else 0
    return np.array(
        [
            np.log1p(len(words)),
            len(text) / k,
            len(seen) / k,
            top / k,
            1 - len(set(lines)) / len(lines),
            *(counts[list(c)].sum() / n for c in _CLASSES),
        ]
    )


def buckets(text: str) -> list[int]:
    return sorted({zlib.crc32(w) % BUCKETS for w in set(words_of(text))})


def meta_ids(source, lang, n_chars) -> list[int]:
    size = "none" if n_chars is None or pd.isna(n_chars) else str(int(2 * np.log2(max(float(n_chars), 0) + 1)))
    return [zlib.crc32(f"{k} {v}".encode()) % META for k, v in (("source", source), ("lang", lang), ("size", size))] + [META]


@dataclass
class Model:
    words: dict[int, int]
    edges: np.ndarray  # style measure x inner bin edges
    text: np.ndarray = field(default_factory=lambda: np.zeros(0))
    meta: np.ndarray = field(default_factory=lambda: np.zeros(0))
    mix: np.ndarray = field(default_factory=lambda: np.zeros(3))  # offset, weight of the text logit, of the metadata logit
    scale: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # per view: offset, slope

    def text_ids(self, measures: np.ndarray, hashes) -> list[int]:
        bins = [i * BINS + int(np.searchsorted(e, x, "right")) for i, (e, x) in enumerate(zip(self.edges, measures))]
        first = len(self.edges) * BINS
        return [*bins, *(first + self.words[h] for h in hashes if h in self.words), first + len(self.words)]


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Ones:
    """Rows of 0 and 1 by the places of their ones (each row has one)."""

    def __init__(self, rows: list, size: int):
        self.size, self.width = size, np.array([len(r) for r in rows])
        self.flat = np.concatenate([np.empty(0, np.int64), *rows]).astype(np.int64)
        self.first = np.cumsum(self.width) - self.width

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.flat], self.first)

    def sums(self, r: np.ndarray) -> np.ndarray:
        """Sum of ``r`` over the rows that hold each place."""
        return np.bincount(self.flat, np.repeat(r, self.width), self.size)


def logistic(x: Ones, y: np.ndarray, shift=0.0, scale: float = 1.0, decay: float = 1.0, steps: int = 250, rate: float = 0.3) -> np.ndarray:
    """Weights that maximise ``scale`` times the likelihood of the rows, plus
    ``shift`` times the weights, less the decay."""
    w, seen = np.zeros(x.size), np.full(x.size, 1e-8)
    for _ in range(steps):
        g = scale * x.sums(y - sigmoid(x.dot(w))) + shift - decay * w
        seen += g**2
        w += rate * g / np.sqrt(seen)
    return w


def feature_sums(ids: list, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features."""
    if not len(ids):
        return np.zeros(0)
    width = np.array([len(x) for x in ids])
    total = np.concatenate([[0.0], np.cumsum(weights[np.concatenate(ids).astype(np.int64)])])
    to = np.cumsum(width)
    return total[to] - total[to - width]


def platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Offset and slopes of a logistic in the columns of ``z``, with the
    smoothed targets of Platt."""
    x = np.column_stack((np.ones(len(z)), z))
    good, bad = y.sum(), (1 - y).sum()
    t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    w = np.zeros(x.shape[1])
    ridge = 1e-3 * np.eye(x.shape[1])
    for _ in range(60):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - t) + ridge @ w)
        w -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-9))
    return w


def fold(doc_id: Column) -> Column:
    return F.pmod(F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)), F.lit(10))


def known_labels(labels: DataFrame) -> DataFrame:
    """``id, y``: one row per labelled document."""
    known = labels.where(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull())).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    y = (F.coalesce("q", F.lit(1)) == 1) & (F.coalesce("t", F.lit(0)) == 0)
    return known.select(F.col("doc_id").alias("id"), y.cast("double").alias("y"))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``y, fold, style, buckets, source, lang, n_chars`` of the labelled
    sample, one row an id."""
    known = known_labels(labels)
    ids = docs.select(F.col("doc_id").alias("id")).where(F.col("id").isNotNull()).distinct()
    taken = known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id", F.lit("quality")), "id").limit(LABELLED)
    chosen = F.broadcast(materialise(taken, "chosen"))  # LABELLED rows at most
    rows = docs.select("doc_id", "text", "source", "lang", "n_chars").join(chosen, F.col("doc_id") == F.col("id"))
    rows = rows.groupBy("id", "y").agg(F.min(F.struct("text", "source", "lang", "n_chars")).alias("r")).select("id", "y", "r.*")

    @F.pandas_udf("style array<double>, buckets array<int>")
    def measured(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"style": [style(t) for t in s], "buckets": [buckets(t) for t in s]})

    rows = rows.withColumn("m", measured(F.coalesce("text", F.lit(""))))
    return rows.select("y", fold(F.col("id")).alias("fold"), "m.style", "m.buckets", "source", "lang", "n_chars")


def telling_words(rows: DataFrame, most: int = WORDS) -> list[int]:
    """Buckets whose presence differs most between the classes, by the z
    score of the difference of two shares."""
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good")).first()
    n, good = total.n, total.good or 0.0
    bad = n - good
    if not good or not bad:
        return []
    c = rows.select("y", F.explode("buckets").alias("b")).groupBy("b")
    c = c.agg(F.count(F.lit(1)).alias("k"), F.sum("y").alias("g")).where(F.col("k") >= 3)
    p = F.col("k") / n
    z = F.abs(F.col("g") / good - (F.col("k") - F.col("g")) / bad) / F.sqrt(p * (1 - p) * (1 / good + 1 / bad) + 1e-12)
    return [r.b for r in c.withColumn("z", z).orderBy(F.desc("z"), "b").limit(most).collect()]


def features(docs: DataFrame, m: Model) -> DataFrame:
    """``doc_id, text_ids, meta_ids`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((m.words, m.edges))

    @F.pandas_udf("text_ids array<int>, meta_ids array<int>")
    def found(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        own = Model(*shared.value)
        for text, source, lang, n_chars in batches:
            t = [own.text_ids(style(x), buckets(x)) for x in text]
            yield pd.DataFrame({"text_ids": t, "meta_ids": [meta_ids(*x) for x in zip(source, lang, n_chars)]})

    return docs.select("doc_id", found(F.coalesce("text", F.lit("")), "source", "lang", "n_chars").alias("f")).select("doc_id", "f.*")


Round = tuple[np.ndarray, tuple[float, float]]  # weights of a view and its calibration


def given(ids: str, rounds: list[Round]) -> Column:
    """The label (0, 1; null: none yet) that a view's classifiers of the
    rounds so far give a document: the first one that is sure decides."""

    @F.pandas_udf("double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            out = np.full(len(s), np.nan)
            for w, (offset, slope) in rounds:
                p = sigmoid(offset + slope * feature_sums(list(s), w))
                out = np.where(~np.isnan(out), out, np.where(p >= SURE, 1.0, np.where(p <= 1 - SURE, 0.0, np.nan)))
            yield pd.Series(out)

    got = label(F.col(ids))
    return F.when(~F.isnan(got), got)


def pool_gradient(pool: DataFrame, ids: str, label: Column, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over all rows of the pool with a label, by class: the gradient of the
    likelihood at ``w``, and the number of rows. A task sums its rows to one
    vector per class; the last feature is in every row."""
    size = len(w)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, size + 1))
        for pdf in batches:
            rows, y = list(pdf["ids"]), pdf["label"].to_numpy(float).astype(int)
            if not len(rows):
                continue
            residual = y - sigmoid(feature_sums(rows, w))
            width = np.array([len(r) for r in rows])
            at = np.repeat(y, width) * (size + 1) + np.concatenate(rows).astype(np.int64)
            total += np.bincount(at, np.repeat(residual, width), total.size).reshape(total.shape)
            total[:, -1] += np.bincount(y, minlength=2)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "v": total.ravel()[at]})

    rows = pool.select(F.col(ids).alias("ids"), label.alias("label")).where("label IS NOT NULL")
    got = rows.mapInPandas(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    total = np.zeros(2 * (size + 1))
    for r in got:
        total[r["at"]] = r.v
    total = total.reshape(2, size + 1)
    return total[:, :-1], total[:, -1]


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model | None, DataFrame | None]:
    """The model and the stored features of all rows (None, None without
    labels of both classes)."""
    rows = materialise(sample(docs, labels), "quality-sample")
    words = telling_words(rows.where(F.col("fold") < 7))
    kept = F.filter("buckets", lambda b: b.isin(words) if words else F.lit(False))
    got = rows.select("y", "fold", "style", kept.alias("buckets"), "source", "lang", "n_chars").where("fold < 9").toPandas()
    y, part = got["y"].to_numpy(float), got["fold"].to_numpy(int)
    teach, tune = part < 7, part >= 7
    if len(set(y[teach])) < 2 or len(set(y[tune])) < 2:
        return None, None
    measures = np.stack(got["style"])
    m = Model({b: i for i, b in enumerate(words)}, np.quantile(measures[teach], np.arange(1, BINS) / BINS, axis=0).T)
    views = [
        [m.text_ids(a, b) for a, b in zip(measures, got["buckets"])],
        [meta_ids(a, b, c) for a, b, c in zip(got["source"], got["lang"], got["n_chars"])],
    ]
    names, sizes = ("text_ids", "meta_ids"), (len(m.edges) * BINS + len(words) + 1, META + 1)
    known = [(Ones([v[i] for i in np.flatnonzero(teach)], size), y[teach]) for v, size in zip(views, sizes)]
    stored = materialise(features(docs, m), "quality-features")
    pool = join_dimension(stored, known_labels(labels), "doc_id", "id").where("y IS NULL").select(*names)
    pool = materialise(pool, "quality-pool")
    held_back = [[v[i] for i in np.flatnonzero(tune)] for v in views]

    def calibrated(v: int, w: np.ndarray) -> Round:
        return w, tuple(platt(feature_sums(held_back[v], w), y[tune]))

    rounds: list[list[Round]] = [[calibrated(v, logistic(*known[v]))] for v in (0, 1)]
    for _ in range(ROUNDS):
        # both views label for each other before either learns
        label = [given(names[1 - v], list(rounds[1 - v])) for v in (0, 1)]
        for v in (0, 1):
            w = rounds[v][-1][0]
            for _ in range(PASSES):
                w = taught(*known[v], w, *pool_gradient(pool, names[v], label[v], w))
            rounds[v].append(calibrated(v, w))
    m.text, m.meta = (rounds[v][-1][0] for v in (0, 1))
    m.scale = np.array([rounds[v][-1][1] for v in (0, 1)])
    z = [feature_sums(held_back[v], w) for v, w in ((0, m.text), (1, m.meta))]
    m.mix = platt(np.column_stack([s[0] + s[1] * x for s, x in zip(m.scale, z)]), y[tune])
    return m, stored


def taught(x: Ones, y: np.ndarray, w: np.ndarray, gradient: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Weights for labelled rows and pseudo-labels, of which ``gradient`` at
    ``w`` and ``docs`` are known by class. The labelled rows stand for the
    shape of both losses, and the linear term makes the sum right at ``w``."""
    own = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.minimum(1.0, own / np.maximum(docs, 1))
    scale = 1.0 + (docs * weight).sum() / own.sum()
    here = x.sums(y - sigmoid(x.dot(w)))
    return logistic(x, y, weight @ gradient - (scale - 1.0) * here, scale)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text_score, meta_score, score, keep, held_out`` of every row:
    calibrated probabilities that a document is good, by its text, by its
    metadata, and combined; ``keep`` is score >= ``KEEP``."""
    m, stored = train(docs, labels)
    if m is None:
        half = [F.lit(0.5).alias(c) for c in ("text_score", "meta_score", "score")]
        return docs.select("doc_id", *half, F.lit(True).alias("keep"), (fold(F.col("doc_id")) == 9).alias("held_out"))

    @F.pandas_udf("text_score double, meta_score double, score double")
    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for ids in batches:
            a, b = (s[0] + s[1] * feature_sums(list(x), w) for s, x, w in zip(m.scale, ids, (m.text, m.meta)))
            both = m.mix[0] + m.mix[1] * a + m.mix[2] * b
            yield pd.DataFrame({"text_score": sigmoid(a), "meta_score": sigmoid(b), "score": sigmoid(both)})

    got = stored.select("doc_id", scores("text_ids", "meta_ids").alias("s"))
    return got.select("doc_id", "s.*", (F.col("s.score") >= KEEP).alias("keep"), (fold(F.col("doc_id")) == 9).alias("held_out"))
