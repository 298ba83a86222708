"""SentencePiece encoding and decoding of merge-type (BPE) models, exactly, by backtracking.

An encoding is the model's own if, and only if, every two neighbouring tokens are what merging
their joined characters gives. So a text is covered from the left with the longest token at each
place (found for all places by one Aho-Corasick pass); a token that does not agree with its left
neighbour is replaced by its next shorter prefix token, and a place from which nothing agrees is
marked in a bitfield and never tried again. Agreement is checked by re-merging the two tokens
and remembered.

Texts are cut into chunks where no token of the vocabulary can span (before a run of space
marks, before punctuation that no token joins with a word; checked against the vocabulary), so that results for recurring chunks
can be remembered; the memory's size is bounded and only saves time. Chunks in which several
merges have one and the same score are merged directly: their order decides there.

The vocabulary's file is read on the driver and sent to the executors; its size is that of the
tokenizer, whatever the data. Defined results: a null text is encoded as an empty one (no ids).
"""

from __future__ import annotations

import hashlib
import heapq
import re
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import pick

SPACE = "▁"
#: Chunks (in each of two generations) and pairs remembered by a Python worker.
REMEMBERED = 200_000
PAIRS = 1_000_000
#: More than any token number: ids and code points.
CODES = 1 << 24
#: Chunks of one text digested at a time.
BLOCK = 65_536


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a merge-type model with byte fallback: text, id and score; and the byte ids."""

    pieces: tuple[tuple[str, int, float], ...]
    byte_ids: tuple[int, ...]

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a model file with the sentencepiece library."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        if any(model.is_unused(i) for i in every):
            raise ValueError("models with unused pieces are not supported")
        byte_ids = tuple(i for i in every if model.is_byte(i))
        if len(byte_ids) != 256:
            raise ValueError("the model must have byte fallback")
        named = [i for i in every if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        found = Vocabulary(tuple((model.id_to_piece(i), i, model.get_score(i)) for i in named), byte_ids)
        probe = " a  b ▁c"
        if model.encode(probe) != found.codec.encode(probe) or model.encode("") or model.decode(model.encode(probe)) != probe.replace(SPACE, " "):
            raise ValueError("the model's normalisation differs: a space mark in front, white space kept, is supported")
        return found

    @cached_property
    def codec(self) -> Codec:
        return Codec(self)


class Codec:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.ids = {piece: i for piece, i, _ in vocabulary.pieces}
        self.scores = {piece: s for piece, _, s in vocabulary.pieces}
        self.byte_ids = vocabulary.byte_ids
        self.pieces = {i: piece for piece, i, _ in vocabulary.pieces}
        self.byte_of = {i: b for b, i in enumerate(vocabulary.byte_ids)}
        long = [p for p in self.ids if len(p) > 1]
        self.joins = {a + b for p in long for a, b in zip(p, p[1:])}
        seen = sorted(self.scores[p] for p in long)
        ties = {a for a, b in zip(seen, seen[1:]) if a == b}
        self.tied = {p for p in long if self.scores[p] in ties}
        tied_pairs = sorted({p[:2] for p in self.tied})
        self.has_tie = re.compile("|".join(map(re.escape, tied_pairs))).search if tied_pairs else lambda _: None
        # tokens that merging never yields whole are no candidates; a token is known by its id,
        # a character outside the vocabulary by the ids from ``self.size`` on
        self.size = max(self.ids.values()) + 1
        whole = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merge(p) == [p]}
        self.length, self.shorter = [1] * self.size, [-1] * self.size
        for p, i in whole.items():
            self.length[i] = len(p)
            self.shorter[i] = next((whole[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in whole), -1)
        self.numerals = [str(i) for i in range(self.size)]
        self.finder = ahocorasick.Automaton()
        for p, i in whole.items():
            self.finder.add_word(p[::-1], (len(p), i))
        self.finder.make_automaton()
        self.chunks = re.compile(self._chunk_pattern()).findall
        self.agrees: dict[int, bool] = {}
        self.recent: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def _chunk_pattern(self) -> str:
        """A pattern that cuts a text where no token can span.

        Chunks begin at a run of space marks (if no token has a space mark inside) and end before
        the next; a run of word characters also ends before an ASCII mark, if its last character
        is joined with no mark by any token.
        """
        if any(b == SPACE and a != SPACE for a, b in self.joins):
            return r"(?s).+"
        word = re.compile(r"\w").match
        marks = {chr(c) for c in range(128) if not word(chr(c))}
        joined = "".join(map(re.escape, sorted({a for a, b in self.joins if b in marks and word(a)})))
        unless = f"(?<![{joined}])" if joined else ""
        return rf"{SPACE}*\w+{unless}(?=[{''.join(map(re.escape, sorted(marks)))}])|{SPACE}*[^{SPACE}]+|{SPACE}+"

    def merge(self, text: str) -> list[str]:
        """Join neighbours as the model does: highest score first, then leftmost."""
        symbols: list[str | None] = list(text)
        after, before = list(range(1, len(text) + 1)), list(range(-1, len(text) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(symbols) and (score := self.scores.get(both := symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-score, i, j, both))

        for i in range(len(text)):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if symbols[i] is None or after[i] != j or symbols[j] is None or symbols[i] + symbols[j] != both:
                continue
            symbols[i], symbols[j], after[i] = both, None, after[j]
            if after[i] < len(symbols):
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def text_of(self, token: int) -> str:
        return self.pieces[token] if token < self.size else chr(token - self.size)

    def agree(self, left: int, right: int) -> bool:
        """Whether two tokens may stand side by side: merging their characters gives them back."""
        if len(self.agrees) >= PAIRS:
            self.agrees.clear()
        a, b = self.text_of(left), self.text_of(right)
        known = self.agrees[left * CODES + right] = a[-1] + b[0] not in self.joins or self.merge(a + b) == [a, b]
        return known

    def backtrack(self, text: str) -> list[int]:
        """Tokens of a chunk; characters outside the vocabulary are tokens of their own."""
        n, size, length, shorter, agrees = len(text), self.size, self.length, self.shorter, self.agrees
        longest, last = [-1] * n, n - 1
        reach = [0] * n
        for end, (k, token) in self.finder.iter(text[::-1]):
            if k > reach[last - end]:
                reach[last - end], longest[last - end] = k, token
        if reach[0] == n:
            return [longest[0]]
        if 0 in reach:
            longest = [t if k else size + ord(c) for t, k, c in zip(longest, reach, text)]
        failed, tokens, at = bytearray(n + 1), [], 0
        left, token = -1, longest[0]
        while True:
            while token >= 0:
                end = at + (length[token] if token < size else 1)
                if not failed[end]:
                    if left < 0:
                        break
                    fits = agrees.get(left * CODES + token)
                    if fits or (fits is None and self.agree(left, token)):
                        break
                token = shorter[token] if token < size else -1
            else:
                failed[at] = 1
                token = tokens.pop()
                at -= length[token] if token < size else 1
                left = tokens[-1] if tokens else -1
                token = shorter[token] if token < size else -1
                continue
            tokens.append(token)
            if end == n:
                return tokens
            at, left, token = end, token, longest[end]

    def ids_of(self, chunk: str) -> list[int]:
        """The ids of a chunk."""
        if self.has_tie(chunk):
            tokens = [self.ids.get(t, self.size + ord(t[0])) for t in self.merge(chunk)]
        else:
            tokens = self.backtrack(chunk)
        if max(tokens) < self.size:
            return tokens
        found: list[int] = []
        for t in tokens:
            found += [t] if t < self.size else [self.byte_ids[b] for b in chr(t - self.size).encode()]
        return found

    def split(self, text: str) -> list[str]:
        return self.chunks(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        return [i for chunk in self.split(text) for i in self.ids_of(chunk)]

    def decode(self, ids: list[int], first: bool = True) -> str:
        """The text of ids: one leading space mark dropped, byte runs read as UTF-8.

        ``first`` is false for ids that continue a text.
        """
        try:
            text = "".join([self.pieces[i] for i in ids])
            return (text[1:] if first and text[:1] == SPACE else text).replace(SPACE, " ")
        except KeyError:  # byte or control ids
            pass
        found, run = [], bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                run.append(b)
                continue
            if run:
                found.append(run.decode("utf-8", "replace"))
                run.clear()
            found.append(self.pieces.get(i, ""))
        if run:
            found.append(run.decode("utf-8", "replace"))
        text = "".join(found)
        if first and text[:1] == SPACE and ids and ids[0] not in self.byte_of:
            text = text[1:]
        return text.replace(SPACE, " ")

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids and of the text decoded from them.

        Chunks never share a character, so a byte run ends where its chunk ends or goes on with
        whole characters: chunks may be decoded one by one.
        """
        count, ids_text, decoded, first = 0, hashlib.sha256(), hashlib.sha256(), True
        chunks = self.split(text)
        for at in range(0, len(chunks), BLOCK):
            pending = [self.recent.get(c) or self._remember(c) for c in chunks[at : at + BLOCK]]
            first = self._flush(pending, ids_text, decoded, first)
            count += sum([x[0] for x in pending])
        return count, ids_text.hexdigest(), decoded.hexdigest()

    def _remember(self, chunk: str) -> tuple[int, str, str]:
        """What digest needs of a chunk; the memory has two generations, the older one is dropped."""
        known = self.older.get(chunk)
        if known is None:
            ids = self.ids_of(chunk)
            known = (len(ids), ",".join([self.numerals[i] for i in ids]), self.decode(ids, False))
        if len(chunk) <= 64:
            if len(self.recent) >= REMEMBERED:
                self.older, self.recent = self.recent, {}
            self.recent[chunk] = known
        return known

    @staticmethod
    def _flush(pending: list[tuple[int, str, str]], ids_text, decoded, first: bool) -> bool:
        ids_text.update(((("" if first else ",") + ",".join([x[1] for x in pending]))).encode())
        text = "".join([x[2] for x in pending])
        decoded.update((text[1:] if first and text[:1] == " " else text).encode())
        return False


def encoder(spark: SparkSession, path: str):
    """Column functions (encode, decode, digest) for the model at ``path``.

    encode: text to array<int>; decode: array<int> to text; digest: text to a struct of n_tokens,
    ids_sha256 and decoded_sha256.
    """
    loaded = Vocabulary.load(path)
    shared = spark.sparkContext.broadcast(Vocabulary(loaded.pieces, loaded.byte_ids))  # without the codec built for the probe

    @pandas_udf("array<int>")
    def encode(texts: pd.Series) -> pd.Series:
        codec = shared.value.codec
        return pd.Series([codec.encode(t or "") for t in texts], dtype=object)

    @pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        codec = shared.value.codec
        return pd.Series([codec.decode([] if x is None else [int(i) for i in x]) for x in ids], dtype=object)

    @pandas_udf("struct<n_tokens: long, ids_sha256: string, decoded_sha256: string>")
    def digest(texts: pd.Series) -> pd.DataFrame:
        codec = shared.value.codec
        rows = [codec.digest(t or "") for t in texts]
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return encode, decode, digest


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``ids``, one row per document."""
    encode, _, _ = encoder(docs.sparkSession, path)
    return pick(docs, "doc_id", "text").select("doc_id", encode("text").alias("ids"))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, one row per document."""
    _, _, digest = encoder(docs.sparkSession, path)
    return pick(docs, "doc_id", "text").select("doc_id", digest("text").alias("d")).select(
        "doc_id", F.col("d.n_tokens").alias("n_tokens"), F.col("d.ids_sha256").alias("ids_sha256"), F.col("d.decoded_sha256").alias("decoded_sha256")
    )
