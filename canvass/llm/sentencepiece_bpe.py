"""SentencePiece BPE encoding by a prefix table, and decoding.

The encoding of a text is the result of merging adjacent symbols, best score
first and leftmost among equals. It has two properties that make it local:
every prefix of a symbol string has one encoding, hence one last token, and
a token sequence is the encoding of its string exactly if each neighbouring
pair (a, b) is itself the encoding of the string a + b. So the encoder
never merges a text. For each prefix it stores the unique last token: of the
vocabulary entries that end there (an Aho-Corasick automaton yields them)
the one whose left neighbour, the last token of the prefix before it, passes
the pair test. The ids are then read off the table from the end backwards.
Pair tests are remembered; only a new pair is merged, on a string of two
tokens.

Words are independent: no vocabulary entry has a word mark after another
character, so text is cut before each run of marks and the table is built
once per distinct word (words are remembered per worker, up to a number of
bytes). Runs
of marks tie in score, so a run in front of a word is merged directly, after
the word has taken its own mark (all word entries score higher; checked when
the model is loaded). A character outside the vocabulary becomes its UTF-8
byte ids.

Edge cases: null or empty text has no ids and decodes to the empty string;
very long texts are processed whole, word by word; equal pieces that could be
merged next go leftmost first, as in the library; repeated rows are encoded
each; an empty table gives no rows; other columns stay, but for one that has
the name of the column added, which is replaced. A model that normalises
text, is not BPE, or breaks one of the checks above is refused (ValueError).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canvass.llm.common import hold_alone
from canvass.llm.token_count import DEFAULT_MODEL, MARK, tokenizer_path

WORDS_BYTES = 64 << 20  # of remembered words, about; a longer word than a 64th is not kept
PAIRS_KEPT = 200_000
ROWS_AT_ONCE = 500


class PrefixTableEncoder:
    def __init__(self, model: str = DEFAULT_MODEL):
        import ahocorasick
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb2

        self.sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(model))
        proto = pb2.ModelProto()
        proto.ParseFromString(self.sp.serialized_model_proto())
        norm, trainer = proto.normalizer_spec, proto.trainer_spec
        if (
            norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or trainer.treat_whitespace_as_suffix
            or trainer.model_type != trainer.BPE
        ):
            raise ValueError("needs a BPE model that keeps text as it is and marks word starts")
        kind = pb2.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [0] * 256
        self.unknown = self.sp.unk_id()
        self.byte_fallback = trainer.byte_fallback
        for i, p in enumerate(proto.pieces):
            if p.type == kind.NORMAL:
                self.score[p.piece], self.id[p.piece] = p.score, i
            elif p.type == kind.BYTE:
                self.byte[int(p.piece[1:-1], 16)] = i
            elif p.type == kind.USER_DEFINED:
                raise ValueError("user-defined entries are not supported")
        runs = [p for p in self.id if len(p) > 1 and not p.strip(MARK)]
        words = [p for p in self.id if p.strip(MARK)]
        if any(MARK in p[1:] for p in words):
            raise ValueError("an entry has a word mark after another character")
        if runs and max(self.score[p] for p in runs) >= min(self.score[p] for p in words if len(p) > 1):
            raise ValueError("runs of marks must merge last")
        self.automaton = ahocorasick.Automaton()
        for p in words:
            if len(p) > 1:
                self.automaton.add_word(p, p)
        self.automaton.make_automaton()
        self.chunks = re.compile(self._chunk_pattern()).findall
        self.pairs: dict[str, dict[str, bool]] = {}
        self.pairs_kept = 0
        self.words: dict[str, tuple[int, ...]] = {}
        self.words_held = 0
        self.decimal = [str(i) for i in range(len(proto.pieces))]

    def _chunk_pattern(self) -> str:
        """Where text may be cut: before a run of marks, around a line end,
        and between a Latin letter and a sign, where no entry joins the two."""
        letter = "[A-Za-z\u00c0-\u024f]"
        joined = {b for p in self.id for a, b in zip(p, p[1:]) if re.match(letter, a)}
        cut = "" if any("\n" in p for p in self.id) else "\\n"
        signs = "".join(re.escape(c) for c in ".,;:!?|#$%&*" if c not in joined)
        word = f"{MARK}?{letter}+(?=[{MARK}{signs}{cut}]|\\Z)"
        return f"{word}|{cut}{'|' * bool(cut)}{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+"

    def merge(self, s: str) -> list[str]:
        """Merging by definition: best score first, leftmost among equals."""
        sym: list[str | None] = list(s)
        n = len(sym)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < n and (sc := self.score.get(sym[i] + sym[j])) is not None:
                heapq.heappush(heap, (-sc, i, len(sym[i]) + len(sym[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, size = heapq.heappop(heap)
            if sym[i] is None or (j := nxt[i]) >= n or len(sym[i]) + len(sym[j]) != size:
                continue
            sym[i] += sym[j]
            sym[j] = None
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prv[nxt[j]] = i
            offer(i)
            if prv[i] >= 0:
                offer(prv[i])
        return [x for x in sym if x is not None]

    def fits(self, a: str, b: str) -> bool:
        """``a`` then ``b`` is the encoding of ``a + b`` (``a`` may be empty)."""
        if self.pairs_kept >= PAIRS_KEPT:
            self.pairs.clear()
            self.pairs_kept = 0
        got = self.pairs.setdefault(a, {})[b] = self.merge(a + b) == ([a, b] if a else [b])
        self.pairs_kept += 1
        return got

    def tokens(self, s: str) -> list[str]:
        """Tokens of one word by the prefix table. The automaton gives the
        entries in order of their ends; where none of them fits, the last
        token of a prefix is its last character (there is always one)."""
        n = len(s)
        last = [""] * (n + 1)
        pairs, none = self.pairs, {}
        done = 0  # prefixes up to here have their last token
        for end, tok in self.automaton.iter(s):
            while done < end:
                last[done + 1] = s[done]
                done += 1
            if done > end:
                continue
            before = last[end + 1 - len(tok)]
            ok = pairs.get(before, none).get(tok)
            if ok or (ok is None and self.fits(before, tok)):
                last[end + 1] = tok
                done = end + 1
        while done < n:
            last[done + 1] = s[done]
            done += 1
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def _ids(self, tokens: list[str]) -> list[int]:
        out: list[int] = []
        for t in tokens:
            if (i := self.id.get(t)) is not None:
                out.append(i)
            elif self.byte_fallback:
                out.extend(self.byte[b] for b in t.encode("utf-8"))
            else:
                out.append(self.unknown)
        return out

    def _word(self, chunk: str) -> tuple[int, ...]:
        word = chunk.lstrip(MARK)
        run = len(chunk) - len(word)
        if run > 1 or not word:
            head = self.tokens(MARK + word) if word else [MARK]
            rest = head[1:] if head[0] == MARK else head
            left = run if head[0] == MARK else run - 1
            toks = [*self.merge(MARK * left), *rest]
        else:
            toks = self.tokens(chunk)
        got = tuple(self._ids(toks))
        size = 200 + 4 * len(chunk) + 8 * len(got)
        if size <= WORDS_BYTES // 64:
            if self.words_held + size > WORDS_BYTES:
                self.words.clear()
                self.words_held = 0
            self.words[chunk] = got
            self.words_held += size
        return got

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        words, new = self.words.get, self._word
        out: list[int] = []
        for c in self.chunks(MARK + text.replace(" ", MARK)):
            out.extend(words(c) or new(c))
        return out

    def written(self, ids: list[int]) -> str:
        """Decimal ids joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.sp.decode(ids)


_kept = lru_cache(maxsize=1)(PrefixTableEncoder)


def encoder(model: str = DEFAULT_MODEL) -> PrefixTableEncoder:
    """One encoder per Python worker and model."""
    hold_alone("pieces", _kept.cache_clear)
    return _kept(model)


def encode_documents(docs: DataFrame, model: str = DEFAULT_MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` (array<int>) added."""

    @F.pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(model)
        for s in batches:
            for i in range(0, len(s), ROWS_AT_ONCE):
                yield pd.Series([np.array(enc.encode(t), np.int32) for t in s.iloc[i : i + ROWS_AT_ONCE]], dtype=object)

    return docs.withColumn("token_ids", ids(F.coalesce(F.col(text), F.lit(""))))


def decode_documents(docs: DataFrame, model: str = DEFAULT_MODEL, ids: str = "token_ids") -> DataFrame:
    """``docs`` with ``decoded`` (text of the ids in column ``ids``) added."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(model)
        for s in batches:
            yield pd.Series([enc.decode([int(i) for i in x]) for x in s], dtype=object)

    empty = F.array().cast("array<int>")
    return docs.withColumn("decoded", texts(F.coalesce(F.col(ids), empty)))


def encode_checked(docs: DataFrame, model: str = DEFAULT_MODEL, text: str = "text") -> DataFrame:
    """``docs`` with ``encoding`` added: a struct of token_ids, n_tokens, and
    whether decoding gives the text back (a word mark in a text decodes to a
    space)."""

    @F.pandas_udf("token_ids array<int>, n_tokens long, round_trip boolean")
    def checked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(model)
        for s in batches:
            for i in range(0, len(s), ROWS_AT_ONCE):
                rows = []
                for t in s.iloc[i : i + ROWS_AT_ONCE]:
                    ids = enc.encode(t)
                    rows.append((np.array(ids, np.int32), len(ids), enc.decode(ids) == t))
                yield pd.DataFrame(rows, columns=["token_ids", "n_tokens", "round_trip"])

    return docs.withColumn("encoding", checked(F.coalesce(F.col(text), F.lit(""))))


def digests(docs: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text: both
    directions in one pass over the rows, ids not sent back to the JVM."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(model)
        for s in batches:
            rows = []
            for t in s:
                ids = enc.encode(t)
                rows.append(
                    (
                        len(ids),
                        hashlib.sha256(enc.written(ids).encode()).hexdigest(),
                        hashlib.sha256(enc.decode(ids).encode("utf-8")).hexdigest(),
                    )
                )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", hashed(F.coalesce(F.col("text"), F.lit(""))).alias("d")).select("doc_id", "d.*")
