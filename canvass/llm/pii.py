"""Personal data in text: base patterns, and a skip-chain conditional random
field that adds what the patterns miss.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches
of fixed patterns per kind; matches that fail their check are dropped. They
always stay.

The field labels the tokens that hold a digit or ``@``. Tokens are runs of
the characters that the kinds are made of (and Latin letters), so that items
in comma lists, in JSON or between characters of other scripts are tokens of
their own without a space between them; runs of other characters are tokens
too. Words without digits are fixed to "no entity", which cuts the
chain between them (signs alone do not), so inference over the labelled runs equals inference over
the whole document. Factors: token features (shapes, counts of digits,
letters and signs, the token's own checksum, the shapes of both neighbours;
not the base matches), chain
potentials between neighbouring tokens, and skip potentials that every token
shares with the repeated or similar tokens of its document (same digits, from
six digits on, or the same characters; each is tied to one of them, a base
match if there is one, so the number of ties grows with the tokens). Tokens
under a base span are observed. Loopy sum-product passes messages over both
kinds of ties until they settle, and a token takes a kind if its marginal is
over one half. Runs of one kind with white space between them that touch no
base span become added spans.

Training is by pseudo-likelihood with the base spans as labels, on all tokens
of all rows. What the likelihood of a token depends on (its features, its label
and those of the tokens it is tied to) is its pattern; Spark counts the
patterns in one scan, and gradients are sums over the distinct ones: in the
driver up to ``IN_DRIVER`` of them, in Spark tasks beyond that. Every text is
then labelled whole.

Edge cases: null is the empty text, without spans; a table without candidate
tokens trains nothing and adds nothing; spans are code points, end exclusive;
repeated rows count and are labelled each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import by_bytes, hold_alone, materialise

KINDS = ["email", "ip", "card", "phone"]
SAMPLE_DOCS, SAMPLE_TOKENS = 2000, 200  # for callers that look at a part of the rows; training takes all
FEATURES, WIDTH = 1 << 12, 14  # feature numbers, and features of a token
IN_DRIVER = 1 << 15  # distinct patterns whose gradient the driver adds up itself
LEAST_SHARE, LEAST_TOKENS = 1e-4, 10  # a feature is learned in full from such a share of the tokens, or from so many
ROUNDS, SETTLED, DAMPING = 30, 1e-4, 0.3
SAME = 2.0  # prior skip potential of equal labels
LABELS = len(KINDS) + 1  # 0: no entity
PATTERN = np.dtype([("features", "<u2", WIDTH), ("left", "i1"), ("right", "i1"), ("label", "i1"), ("skip", "<i4", LABELS)])

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_domain = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_digit = re.compile(r"[0-9]").search
_candidate = re.compile(r"[0-9@]").search
_KIND_CHARS = "A-Za-z\u00c0-\u024f0-9._%+()@-"  # characters that the kinds are made of, and Latin letters
_token = re.compile(rf"[{_KIND_CHARS}]+|[^\s{_KIND_CHARS}]+").finditer
_nondigit = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # start, number of the kind, stop


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches found from their ``@``: the local part is the run of its
    characters before it, back to the end of the match before."""
    end, at = 0, text.find("@")
    while at >= 0:
        head = text[end:at]
        start = end + len(head.rstrip(_LOCAL))
        if start < at and (m := _domain(text, at + 1)):
            yield start, m.end()
            end = m.end()
        else:
            end = at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _digit(text):
        for m in _ip(text):
            if all(len(p := g.lstrip("0")) < 4 and int(p or 0) <= 255 for g in m.groups()):
                out.append((m.start(), 1, m.end()))
        for m in _card(text):
            digits = _nondigit.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _phone(text):
                if 10 <= len(_nondigit.sub("", m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(token: str) -> str:
    """Runs of digits as 9, of letters as a; other characters as they are."""
    out: list[str] = []
    for c in token:
        k = "9" if c in "0123456789" else "a" if c.isalpha() else c
        if not out or out[-1] != k or k not in "9a":
            out.append(k)
    return "".join(out)


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def _features(token: str, before: str, after: str) -> list[int]:
    digits = sum(c in "0123456789" for c in token)
    alpha = sum(c.isalpha() for c in token)
    around = [shape(x) if _candidate(x) or not any(c.isalnum() for c in x) else "w" for x in (before, after)]
    names = (
        "bias",
        f"shape {shape(token)}",
        f"digits {_bucket(digits, (1, 2, 4, 6, 10, 14, 20))}",
        f"letters {_bucket(alpha, (1, 4))}",
        f"at {token.count('@')}",
        f"dots {min(token.rstrip('.').count('.'), 4)}",
        f"dashes {min(token.count('-'), 2)}",
        f"plus {token[:1] == '+'}",
        f"mixed {digits > 3 and alpha > 3 and '@' not in token}",
        f"quoted {token[:1] in '\"(<['}",
        f"before {around[0]}",
        f"after {around[1]}",
        f"checksum {14 <= digits <= 19 and luhn(_nondigit.sub('', token))}",
        f"digits and before {_bucket(digits, (1, 2, 4, 6, 10, 14, 20))} {around[0]}",
    )
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


def _key(token: str) -> str | None:
    """What repeated or similar tokens have in common; none for tokens with
    too little of their own (under four digits and no ``@``)."""
    digits = _nondigit.sub("", token)
    if len(digits) < 4 and "@" not in token:
        return None
    return digits if len(digits) >= 6 else token.strip(".,;:!?()[]\"'").casefold()


@dataclass
class Graph:
    """Labelled tokens of some documents. ``label`` is the observed one, -1
    where there is none; ties are (one, other) token numbers."""

    doc: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    features: np.ndarray
    label: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def graph(texts: list[str], spans: list[list[Span]], most: int | None = None) -> Graph:
    doc, start, stop, feats, label, chain, skip = ([] for _ in range(7))
    for d, (text, base) in enumerate(zip(texts, spans)):
        if not _candidate(text):
            continue
        toks = [(m.start(), m.end()) for m in _token(text)]
        words = [text[a:b] for a, b in toks]
        hub: dict[str, int] = {}
        mine: list[tuple[str, int]] = []
        linked, left = False, 0
        for i, w in enumerate(words):
            if not _candidate(w):
                linked = linked and not any(c.isalnum() for c in w)
                continue
            a, b = toks[i]
            while left < len(base) and base[left][2] <= a:
                left += 1
            upto = itertools.takewhile(lambda x: x[0] < b, itertools.islice(base, left, None))
            kind = next((k for _, k, end in upto if end > a), None)
            n = len(doc)
            doc.append(d), start.append(a), stop.append(b)
            label.append(-1 if kind is None else kind + 1)
            feats.append(_features(w, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
            if linked:
                chain.append((n - 1, n))
            linked = True
            if (key := _key(w)) is None:
                continue
            if key not in hub or (label[hub[key]] < 0 <= label[n]):
                hub[key] = n
            mine.append((key, n))
        skip += [(hub[k], n) for k, n in mine if hub[k] != n]
    as_int = lambda x, *shape_: np.array(x, np.int64).reshape(len(x), *shape_)
    g = Graph(as_int(doc), as_int(start), as_int(stop), as_int(feats, WIDTH), as_int(label), as_int(chain, 2), as_int(skip, 2))
    return g if most is None else _part(g, most)


def _part(g: Graph, most: int) -> Graph:
    """At most ``most`` tokens of each document, with the ties among them."""
    keep = np.zeros(len(g.label), bool)
    tied: dict[int, list[int]] = {}
    for a, b in np.concatenate((g.chain, g.skip[:, ::-1])).tolist():
        tied.setdefault(a, []).append(b)  # the token after, and the one a repeat is tied to
    for a, b in g.chain.tolist():
        tied.setdefault(b, []).append(a)
    for d in np.unique(g.doc):
        mine = np.flatnonzero(g.doc == d)
        if len(mine) <= most:
            keep[mine] = True
            continue
        mine = mine[np.argsort(pd.util.hash_array(g.start[mine]), kind="stable")]
        kinds = [mine[g.label[mine] == k].tolist() for k in range(1, LABELS)]
        turns = [x for t in itertools.zip_longest(*kinds) for x in t if x is not None]
        rest = mine[g.label[mine] < 0].tolist()
        taken: set[int] = set()
        for order, room in ((turns, most // 2), (rest, most), (turns, most)):
            for i in order:
                new = {i, *tied.get(i, ())} - taken
                if len(taken) + len(new) <= room:
                    taken |= new
        keep[list(taken)] = True
    number = np.cumsum(keep) - 1
    among = lambda ties: number[ties[keep[ties].all(1)]]
    return Graph(g.doc[keep], g.start[keep], g.stop[keep], g.features[keep], g.label[keep], among(g.chain), among(g.skip))


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x LABELS
    chain: np.ndarray  # LABELS x LABELS, left then right
    skip: np.ndarray  # LABELS x LABELS, symmetric


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def patterns(g: Graph) -> np.ndarray:
    """The pattern of each token: features, own label, the labels before and
    after in the chain (-1: no tie), and how many skip ties lead to each
    label. A token without a base span has the label of the base match it
    repeats, else none."""
    hub, other = g.skip.T
    y = np.maximum(g.label, 0)
    y[other] = np.where(g.label[other] < 0, y[hub], y[other])
    a, b = g.chain.T
    out = np.zeros(len(y), PATTERN)
    out["features"], out["label"], out["left"], out["right"] = g.features, y, -1, -1
    out["right"][a], out["left"][b] = y[b], y[a]
    np.add.at(out["skip"], (hub, y[other]), 1)
    np.add.at(out["skip"], (other, y[hub]), 1)
    return out


def _field(x: np.ndarray) -> Field:
    unary, chain, skip = np.split(x, (FEATURES * LABELS, FEATURES * LABELS + LABELS**2))
    return Field(unary.reshape(-1, LABELS), chain.reshape(LABELS, LABELS), skip.reshape(LABELS, LABELS))


def gradient(p: np.ndarray, n: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Gradient of the log pseudo-likelihood of patterns that occur ``n``
    times each, by the weights ``x`` (those of a :class:`Field` in a row)."""
    w = _field(x)
    f = p["features"].astype(np.int64)
    left, right = (np.eye(LABELS + 1)[p[side]][:, :LABELS] for side in ("left", "right"))  # -1: all zero
    s = sum(w.unary[c] for c in f.T) + right @ w.chain.T + left @ w.chain + p["skip"] @ w.skip
    err = (np.eye(LABELS)[p["label"]] - _softmax(s)) * n[:, None]
    unary = [np.bincount(f.ravel(), np.repeat(e, WIDTH), FEATURES) for e in err.T]
    skip = p["skip"].T @ err
    return np.concatenate((np.stack(unary, 1).ravel(), (err.T @ right + left.T @ err).ravel(), ((skip + skip.T) / 2).ravel()))


def fit(gradient_at: Callable[[np.ndarray], np.ndarray], n: int, steps: int = 300, rate: float = 0.2, decay: float = 1e-3) -> Field:
    """Pseudo-likelihood of ``n`` tokens: each given its features and the
    labels of the tokens it is tied to; ``gradient_at`` takes weights as
    :func:`gradient` does. Skip potentials start from, and decay to, a
    preference for equal labels, so that texts without repeats still tie
    them."""
    prior = np.concatenate((np.zeros(FEATURES * LABELS + LABELS**2), SAME * np.eye(LABELS).ravel()))
    x = prior.copy()
    sq = np.full_like(x, min(LEAST_SHARE, LEAST_TOKENS / n) ** 2)
    for _ in range(steps):
        grad = gradient_at(x) / n - decay * (x - prior) / n**0.5
        sq += grad**2
        x += rate * grad / np.sqrt(sq)
    return _field(x)


def marginals(g: Graph, w: Field) -> np.ndarray:
    """Label marginals of all tokens by loopy sum-product."""
    u = w.unary[g.features].sum(1)
    seen = g.label >= 0
    u[seen] = np.where(np.eye(LABELS, dtype=bool)[g.label[seen]], 0.0, -1e3)
    src = np.concatenate((g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]))
    dst = np.concatenate((g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]))
    c, s = len(g.chain), len(g.skip)
    back = np.concatenate((np.arange(c) + c, np.arange(c), np.arange(s) + 2 * c + s, np.arange(s) + 2 * c))
    tie = np.concatenate((np.tile(w.chain, (c, 1, 1)), np.tile(w.chain.T, (c, 1, 1)), np.tile(w.skip, (2 * s, 1, 1))))
    msg = np.zeros((len(src), LABELS))
    belief = u
    for _ in range(ROUNDS):
        if not len(src):
            break
        out = (belief[src] - msg[back])[:, :, None] + tie
        top = out.max(1)
        new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        new = DAMPING * msg + (1 - DAMPING) * new
        moved = np.abs(new - msg).max()
        msg = new
        belief = u.copy()
        np.add.at(belief, dst, msg)
        if moved < SETTLED:
            break
    return _softmax(belief)


def added_spans(texts: list[str], base: list[list[Span]], w: Field | None) -> list[list[Span]]:
    out: list[list[Span]] = [[] for _ in texts]
    g = graph(texts, base)
    if w is None or not len(g.label):
        return out
    m = marginals(g, w)
    best = np.where(m.max(1) > 0.5, m.argmax(1), 0)
    joined = set(map(tuple, g.chain.tolist()))
    i, n = 0, len(best)
    while i < n:
        j = i
        if best[i] and g.label[i] < 0:
            while (j, j + 1) in joined and best[j + 1] == best[i] and g.label[j + 1] < 0 and texts[g.doc[i]][g.stop[j] : g.start[j + 1]].isspace():
                j += 1
            d, a, b = g.doc[i], int(g.start[i]), int(g.stop[j])
            text = texts[d]
            a = b - len(text[a:b].lstrip(".,;:!?\"'<>[]|"))
            b = a + len(text[a:b].rstrip(".,;:!?\"'<>[]|"))
            if a < b:
                out[d].append((a, int(best[i]) - 1, b))
        i = j + 1
    return out


def find_spans(texts: list[str], w: Field | None) -> list[tuple[list[Span], list[Span]]]:
    """(base, all) spans of each text, both sorted by start, then kind."""
    base = [base_spans(t) for t in texts]
    return [(b, sorted(b + a)) for b, a in zip(base, added_spans(texts, base, w))]


def count_patterns(docs: DataFrame) -> DataFrame:
    """``pattern`` (bytes of a ``PATTERN``), ``label`` and ``n`` of all tokens
    of all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in by_bytes(batch.column(0).to_pylist(), 1 << 20):
                p = patterns(graph(texts, [base_spans(t) for t in texts]))
                some, n = np.unique(p.view(np.dtype((np.void, PATTERN.itemsize))), return_counts=True)
                label = some.view(PATTERN)["label"].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(some.tolist(), pa.binary()), pa.array(label), pa.array(n, pa.int64())], ["pattern", "label", "n"])

    texts = docs.select("text").where(F.col("text").rlike("[0-9@]"))
    counted = texts.mapInArrow(count, "pattern binary, label int, n long")
    return counted.groupBy("pattern", "label").agg(F.sum("n").alias("n"))


def _added_up(counted: DataFrame, x: np.ndarray) -> np.ndarray:
    """:func:`gradient` over all patterns, summed in tasks."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(x)
        for batch in batches:
            total += gradient(*_counts(batch), x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    few = counted.coalesce(max(8, counted.sparkSession.sparkContext.defaultParallelism))
    return sum(np.frombuffer(r["m"]) for r in few.mapInArrow(part, "m binary").collect())  # a row per task


def _counts(some: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(some.column("pattern").to_pylist()), PATTERN), some.column("n").to_numpy()


def train(docs: DataFrame) -> Field | None:
    counted = materialise(count_patterns(docs), "pii-patterns")
    size, n, kinds = counted.agg(F.count(F.lit(1)), F.sum("n"), F.max("label")).first()
    if not kinds:
        return None
    if size > IN_DRIVER:
        return fit(lambda x: _added_up(counted, x), n)
    p, times = _counts(counted.toArrow().sort_by("pattern"))
    return fit(lambda x: gradient(p, times, x), n)


def _each(s: pd.Series, w: Field | None, chars: int = 1 << 20) -> Iterator[tuple[str, list[Span], list[Span]]]:
    part: list[str] = []
    size = 0
    for t in [*s, None]:
        if t is not None:
            part.append(t)
            size += len(t)
        if part and (t is None or size > chars):
            yield from ((x, b, a) for x, (b, a) in zip(part, find_spans(part, w)))
            part, size = [], 0


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def span_report(docs: DataFrame, w: Field | None = None) -> DataFrame:
    """``doc_id``, counts of base spans by kind, digest of the base spans,
    and all spans as kind:start:end."""
    w = w or train(docs)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")
    def report(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            rows = []
            for _, base, every in _each(s, w):
                n = [0] * len(KINDS)
                for _, k, _ in base:
                    n[k] += 1
                rows.append((*n, hashlib.sha256(_written(base).encode()).hexdigest(), _written(every)))
            yield pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", report(F.coalesce(F.col("text"), F.lit(""))).alias("r")).select("doc_id", "r.*")


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind in capitals in brackets;
    overlapping spans are replaced together under the first one's kind."""
    out, end = [], 0
    for a, k, b in spans:
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def masked(text: Column, w: Field | None) -> Column:
    """Text column with all personal data masked (null stays null)."""

    @F.pandas_udf("string")
    def hide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hold_alone("none", int)
        for s in batches:
            yield pd.Series([mask(t, every) for t, _, every in _each(s, w)], dtype=object)

    return F.when(text.isNotNull(), hide(F.coalesce(text, F.lit(""))))
