"""Language identification with interpolated Kneser-Ney character models.

One model of order ``ORDER`` per language over the characters of words
(runs of letters, lower-cased, with a start and an end sign; contexts do not
cross words). Counts of the highest order are taken from all training texts
and summed in Spark; continuation counts, discounts n1 / (n1 + 2 n2) and
interpolation weights follow from them. Per order the model is a sorted array
of n-gram hashes with the interpolated log-probability in every language,
and a sorted array of context hashes with the back-off weights.

Size: no n-gram is dropped, so that totals, context types, continuation counts
and discounts of every order are those of all training texts. The driver
assembles and broadcasts one row per distinct n-gram, however often it occurs;
it grows with the distinct strings of ``ORDER`` characters, not with the rows.

A text goes to the language with the lowest cross-entropy per character. Its
margin is the gap to the next language, or to a uniform choice among the
known characters if that is closer, times the square root of the length.
Platt scaling of the margin on a calibration fold of the training documents
(never used for counts) gives the score. ``rejected`` is true if there is no
letter, no language beats the uniform choice, or the score is under
``min_score``.

Folds by crc32 of the id (null id: remainder 0): remainder 2 of 4 is held
out and never learned from; of the others, one in ``CALIBRATION`` calibrates.

Edge cases: null or letterless text is ``und`` with score 0; rows without a
language are not learned from but predicted; without any labelled row every
text is ``und``; ties go to the first language in alphabetical order; without
calibration rows the score is the logistic of the margin; repeated rows each
count; an empty table gives no rows.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import free_name, hold_alone, materialise

ORDER = 5
CALIBRATION = 8
MIN_SCORE = 0.5
WORDS_BYTES = 40 << 20  # of remembered words and their scores, about
PIECE = 1 << 19  # characters of a long text that are split into words at once
WORDS_AT_ONCE = 10_000
FLUSH_WORDS = 100_000
START, STOP = "^", "$"
UND = "und"
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_runs = re.compile(r"[^\W\d_]+").findall
_space = re.compile(r"\s").search


def words_of(text: str) -> list[str]:
    return _runs(text.lower())


def pieces_of(text: str) -> Iterator[str]:
    """A text in pieces of ``PIECE`` characters, cut before white space."""
    start = 0
    while len(text) - start > PIECE and (m := _space(text, start + PIECE)):
        yield text[start : m.start()]
        start = m.start()
    yield text[start:]


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k characters that end at each place (first k-1: unused)."""
    h = np.zeros(len(codes), np.uint64)
    for j in range(k - 1, -1, -1):
        c = codes if not j else np.concatenate((np.zeros(j, np.uint64), codes[:-j]))
        h = (h + c + np.uint64(1)) * _MUL
    return (h ^ (h >> np.uint64(29))) * _MIX


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le"), "<u4").astype(np.uint64)


def _gram_hashes(grams: np.ndarray, k: int) -> np.ndarray:
    return _hashes(_codes("".join(grams)), k)[k - 1 :: k] if k else np.zeros(len(grams), np.uint64)


@dataclass
class LanguageModel:
    languages: list[str]
    keys: list[np.ndarray] = field(default_factory=list)  # by order 1..ORDER
    logp: list[np.ndarray] = field(default_factory=list)
    context_keys: list[np.ndarray] = field(default_factory=list)
    log_gamma: list[np.ndarray] = field(default_factory=list)
    uniform: float = 0.0  # log-probability of a character when all are alike
    slope: float = 1.0
    offset: float = 0.0
    name: str = ""

    def log_probs(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability, in each language, of the characters at ``at``
        given those before."""
        if not self.languages:
            return np.zeros((len(at), 0))
        return self._of_order(ORDER, [None] + [_hashes(codes, k) for k in range(1, ORDER + 1)], at)

    def _of_order(self, k: int, hashes: list, at: np.ndarray) -> np.ndarray:
        if not k:
            return np.full((len(at), len(self.languages)), self.uniform)
        h = hashes[k][at]
        i = np.searchsorted(self.keys[k - 1], h)
        i[i == len(self.keys[k - 1])] = 0
        out = self.logp[k - 1][i].astype(np.float64)
        new = np.flatnonzero(self.keys[k - 1][i] != h)
        if len(new):
            below = self._of_order(k - 1, hashes, at[new])
            c = hashes[k - 1][at[new] - 1] if k > 1 else np.zeros(len(new), np.uint64)
            j = np.searchsorted(self.context_keys[k - 1], c)
            j[j == len(self.context_keys[k - 1])] = 0
            known = self.context_keys[k - 1][j] == c
            out[new] = below + np.where(known[:, None], self.log_gamma[k - 1][j], 0.0)
        return out

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed log-probabilities of each word in each language, and the
        number of characters predicted (its letters and the end sign)."""
        pad = START * (ORDER - 1)
        clean = [letters(w) for w in words]
        size = np.array([len(w) + 1 if w else 0 for w in clean])
        codes = _codes("".join(pad + w + STOP for w in clean if w))
        total = np.zeros((len(words), len(self.languages)))
        some = size > 0
        if some.any():
            ends = np.cumsum(size[some] + ORDER - 1)
            first = ends - size[some]
            mask = np.zeros(len(codes) + 1, np.int64)
            mask[first] += 1
            mask[ends] -= 1
            at = np.flatnonzero(np.cumsum(mask[:-1]))
            lp = self.log_probs(codes, at)
            total[some] = np.add.reduceat(lp, np.concatenate(([0], np.cumsum(size[some])[:-1])), axis=0)
        return total, size

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.offset + self.slope * margin, -30, 30)))


def build_model(grams: pd.DataFrame, languages: list[str]) -> LanguageModel:
    """Model from all highest-order counts (columns lang, gram, n)."""
    m = LanguageModel(languages, name=uuid.uuid4().hex)
    if not languages or not len(grams):
        m.languages = []
        return m
    number = {x: i for i, x in enumerate(languages)}
    code, g = pd.factorize(grams["gram"])
    g = np.asarray(g, object)
    c = np.zeros((len(g), len(languages)))
    c[code, grams["lang"].map(number).to_numpy()] = grams["n"].to_numpy()
    levels = []
    for k in range(ORDER, 0, -1):
        n1, n2 = (c == 1).sum(0), (c == 2).sum(0)
        d = np.clip(n1 / np.maximum(n1 + 2 * n2, 1), 0.1, 0.9)
        ctx, contexts = pd.factorize(np.array([x[:-1] for x in g], object))
        total, types = (np.zeros((len(contexts), len(languages))) for _ in range(2))
        np.add.at(total, ctx, c)
        np.add.at(types, ctx, c > 0)
        gamma = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
        own = np.where(c > 0, (c - d) / np.maximum(total[ctx], 1), 0.0)
        suffix, below = pd.factorize(np.array([x[1:] for x in g], object))
        levels.append((k, g, np.asarray(contexts, object), ctx, gamma, own, suffix))
        c2 = np.zeros((len(below), len(languages)))
        np.add.at(c2, suffix, c > 0)
        g, c = np.asarray(below, object), c2
    p = np.full((1, len(languages)), 1.0 / (len(levels[-1][1]) + 1))
    m.uniform = float(np.log(p[0, 0]))
    for k, g, contexts, ctx, gamma, own, suffix in reversed(levels):
        p = own + gamma[ctx] * p[suffix]
        h, hc = _gram_hashes(g, k), _gram_hashes(contexts, k - 1)
        order, by = np.argsort(h), np.argsort(hc)
        m.keys.append(h[order])
        m.logp.append(np.log(p[order]).astype(np.float32))
        m.context_keys.append(hc[by])
        m.log_gamma.append(np.log(gamma[by]).astype(np.float32))
    return m


_seen: dict = {}  # per worker: the words scored with one model


class Scorer:
    """Scores whole texts; each distinct word is looked up once and kept."""

    def __init__(self, model: LanguageModel):
        self.model, self.index, self.held = model, {}, 0
        self.total, self.size = np.zeros((0, len(model.languages))), np.zeros(0, np.int64)

    def add(self, texts: list[list[str]]) -> None:
        if self.held > WORDS_BYTES:
            self.__init__(self.model)
        new = [w for w in set().union(*texts) if w not in self.index] if texts else []
        if new:
            parts = [self.model.word_scores(new[i : i + WORDS_AT_ONCE]) for i in range(0, len(new), WORDS_AT_ONCE)]
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.total = np.concatenate((self.total, *(t for t, _ in parts)))
            self.size = np.concatenate((self.size, *(n for _, n in parts)))
            self.held += sum(map(len, new)) * 4 + len(new) * (160 + 8 * self.total.shape[1])

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character by language, characters) of each text."""
        n = np.zeros(len(texts), np.int64)
        h = np.zeros((len(texts), len(self.model.languages)))
        short = [i for i, t in enumerate(texts) if len(t) <= PIECE]
        self._sum([words_of(texts[i]) for i in short], short, h, n)
        for i, t in enumerate(texts):
            if len(t) > PIECE:
                for piece in pieces_of(t):
                    self._sum([words_of(piece)], [i], h, n)
        return -h / np.maximum(n, 1)[:, None], n

    def _sum(self, split: list[list[str]], rows: list[int], h: np.ndarray, n: np.ndarray) -> None:
        self.add(split)
        get = self.index.__getitem__
        for i, words in zip(rows, split):
            if words:
                at = np.fromiter(map(get, words), np.int64, len(words))
                n[i] += self.size[at].sum()
                h[i] += self.total[at].sum(axis=0)


def _predict(model: LanguageModel, texts: list[str]) -> pd.DataFrame:
    hold_alone("language", _seen.clear)
    scorer = _seen.get(model.name)
    if scorer is None:
        _seen.clear()
        scorer = _seen[model.name] = Scorer(model)
    h, n = scorer.entropies(texts)
    out = pd.DataFrame({"lang_pred": UND, "margin": 0.0, "entropy": 0.0, "letters": n}, index=range(len(texts)))
    if model.languages:
        some = n > 0
        best = h.argmin(1)
        low = h[np.arange(len(h)), best]
        others = np.concatenate((h, np.full((len(h), 1), -model.uniform)), 1)
        others[np.arange(len(h)), best] = np.inf
        gap = np.where(some, (others.min(1) - low) * np.sqrt(n), 0.0)
        out["lang_pred"] = np.where(some, np.array(model.languages, object)[best], UND)
        out["margin"], out["entropy"] = gap, np.where(some, low, 0.0)
    return out


def _batched(texts: list[str], chars: int = 1 << 19) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def raw_prediction(text: Column, shared) -> Column:
    """Struct (lang_pred, margin, entropy, letters) of a text column under
    the broadcast model ``shared``."""

    @F.pandas_udf("lang_pred string, margin double, entropy double, letters long")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            texts = s.tolist()
            parts = [_predict(shared.value, texts[a:b]) for a, b in _batched(texts)]
            yield pd.concat(parts, ignore_index=True) if parts else _predict(shared.value, [])

    # else a filter on the result would be pushed below and predict again
    return predict.asNondeterministic()(F.coalesce(text, F.lit("")))


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pad = START * (ORDER - 1)
    words: dict[str, Counter] = {}

    def flush() -> Iterator[pd.DataFrame]:
        for lang, seen in words.items():
            grams: Counter = Counter()
            for w, n in seen.items():
                if w := letters(w):
                    s = pad + w + STOP
                    for i in range(len(s) - ORDER + 1):
                        grams[s[i : i + ORDER]] += n
            if grams:
                yield pd.DataFrame({"lang": lang, "gram": list(grams), "n": list(grams.values())})
        words.clear()

    for pdf in batches:
        for text, lang in zip(pdf["text"], pdf["lang"]):
            words.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, words.values())) > FLUSH_WORDS:
                yield from flush()
    yield from flush()


def fold(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0))


def held_out(doc_id: Column) -> Column:
    return F.pmod(fold(doc_id), F.lit(4)) == 2


def _calibrates(doc_id: Column) -> Column:
    return F.pmod(F.floor(fold(doc_id) / 4), F.lit(CALIBRATION)) == 0


def train(docs: DataFrame) -> LanguageModel:
    """Counts, model and calibration from the labelled rows of ``docs``
    (doc_id, text, lang) that are not held out."""
    rows = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.where(~held_out(F.col("doc_id")))
    counted = rows.where(~_calibrates(F.col("doc_id"))).select("text", "lang")
    grams = counted.mapInPandas(_count_grams, "lang string, gram string, n long")
    grams = materialise(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    kept = grams.toArrow().to_pandas()  # a row per language and distinct gram
    model = build_model(kept.sort_values(["lang", "gram"]), sorted(kept["lang"].unique()))
    if model.languages:
        calibrate(model, rows.where(_calibrates(F.col("doc_id"))))
    return model


def calibrate(model: LanguageModel, rows: DataFrame) -> None:
    """Platt scaling: a logistic in the margin, fitted to a histogram of all
    calibration rows (a bin per tenth of the margin up to 60)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    p = rows.select("lang", raw_prediction(F.col("text"), shared).alias("p")).where(F.col("p.letters") > 0)
    bin_ = F.floor(F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.col("p.margin"))) * 10)
    hist = p.groupBy(bin_.alias("b")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("lang") == F.col("p.lang_pred")).alias("right")
    )
    hist = hist.toPandas()
    if not len(hist):
        return
    x, n, right = (hist["b"].to_numpy(float) + 0.5) / 10, hist["n"].to_numpy(float), hist["right"].to_numpy(float)
    hits, misses = right.sum(), (n - right).sum()
    good, bad = (hits + 1) / (hits + 2), 1 / (misses + 2)  # Platt's targets
    target = right * good + (n - right) * bad
    w = np.zeros(2)
    design = np.stack((np.ones_like(x), x), 1)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(100):
        p_ = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (n * p_ - target) + ridge @ w
        hess = (design * (n * p_ * (1 - p_))[:, None]).T @ design + ridge
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
    if w[1] > 0:
        model.offset, model.slope = float(w[0]), float(w[1])


def identify(docs: DataFrame, model: LanguageModel | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` with ``language``: a struct of lang_pred, score (0 to 1),
    entropy (bits per character), letters and rejected. A column ``language``
    of ``docs`` is replaced; any other name may occur."""
    model = model or train(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    raw, scored = free_name("_p", docs), free_name("_score", docs)
    p = F.col(raw)
    some = p["letters"] > 0
    z = F.lit(model.offset) + F.lit(model.slope) * p["margin"]
    score = F.when(some & F.lit(bool(model.languages)), 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))).otherwise(0.0)
    found = docs.withColumn(raw, raw_prediction(F.col("text"), shared)).withColumn(scored, score)
    return found.withColumn(
        "language",
        F.struct(
            p["lang_pred"].alias("lang_pred"),
            F.col(scored).alias("score"),
            (p["entropy"] / float(np.log(2))).alias("entropy"),
            p["letters"].alias("letters"),
            (~some | (p["margin"] <= 0) & (p["entropy"] >= -model.uniform) | (F.col(scored) < min_score)).alias("rejected"),
        ),
    ).drop(raw, scored)


def predict_languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row."""
    rows = docs.select("doc_id", "text", "lang")
    out = identify(rows)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score", "language.rejected")
