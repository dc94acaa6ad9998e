"""Token counts by the whole-token shortcut, for a SentencePiece BPE model.

Offline, once for each vocabulary: prove where merges can't reach across, and which pieces encode alone as one token.
A text is cut at those places into pre-tokens; one that is such a piece counts 1 directly, the rest are merged by the
library, each on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import chunks, tidy

META = "▁"  # what the library puts for a space
PIECES = re.compile(r"\n| *[^ \n]+| +")


class Counter(dict):
    """Tokens of a pre-token. Keys: 'x' stands for the space before it and x; '\\nx' for the line end and x after it."""

    def __init__(self, path: str, most: int = 150_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        self.vocabulary = [m.id_to_piece(i) for i in range(m.vocab_size())]
        self.ordinary = [not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i)) for i in range(m.vocab_size())]
        self._prove()
        self.whole = self._whole()
        self.most = most + len(self.whole)
        self.update(self.whole)
        self.runs: dict[int, int] = {}

    def _prove(self) -> None:
        """No piece has a space after another character or holds a line end, the text is taken as it is, and a space is put before it."""
        m = self.model
        for p, own in zip(self.vocabulary, self.ordinary):
            if own and ("\n" in p or META in p.lstrip(META)):
                raise ValueError(f"merges of {p!r} cross the cuts of the shortcut")
        probe = " a  ﬁ \n b "
        if m.decode(m.encode(probe)) != probe or m.encode("") or m.encode("a", out_type=str)[0][0] != META:
            raise ValueError("the model changes the text before it encodes it")

    def _whole(self) -> dict[str, int]:
        """The pieces that encode alone as one token."""
        m, out = self.model, {}
        for i, (p, own) in enumerate(zip(self.vocabulary, self.ordinary)):
            if own and p.startswith(META) and META not in p[1:] and m.encode(p[1:]) == [i]:
                out[p[1:]] = 1
            elif own and META not in p and m.encode("\n" + p)[2:] == [i]:
                out["\n" + p] = 2
        return out

    def __missing__(self, key: str) -> int:
        n = len(self.model.encode(key)) - (key[:1] == "\n") if key else 1
        if len(self) < self.most and len(key) <= 64:
            self[key] = n
        return n

    def _run(self, k: int) -> int:
        """Tokens of k spaces that nothing follows on their line."""
        if k not in self.runs:
            self.runs[k] = 1 if k == 1 else len(self.model.encode(" " * (k - 1)))
        return self.runs[k]

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(META, " ")
        if "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            n = 0
            for p in PIECES.findall(" " + text):
                if p == "\n":
                    n += 1
                elif p[0] != " ":
                    n += self["\n" + p] - 1
                elif p[-1] == " ":
                    n += self._run(len(p))
                else:
                    n += self[p[1:]]
            return n
        return sum(map(self.__getitem__, text.replace("\n", " \n").split(" ")))


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of docs by the SentencePiece model at `path`, which every
    executor must have. Null and empty texts: 0 bytes, 0 tokens. Whole texts, one pass, no shuffle; what is remembered
    of pre-tokens is bounded. Special strings are ordinary text. Other columns are ignored; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for part, texts in chunks(batches, "text"):
            n = np.array([c.count(t.decode()) for t in texts], np.int64)
            yield pa.record_batch([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(tidy(run), "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
