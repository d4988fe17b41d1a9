"""Token counts of a unigram tokenizer, without the tokens.

The pieces of a vocabulary with their scores are matched by an Aho-Corasick automaton; for each
end of a match the dynamic programme keeps the best score and the number of pieces of its path.
Tie rules are the tokenizer's: at one end the candidates come by ascending start, and only a
strictly better score replaces an earlier one; a character without a piece of its own also has an
unknown candidate, 10 below the least score, tried last.  Unknown characters become their UTF-8
bytes if the vocabulary has all byte pieces, else each run of them is one piece.

A text is encoded as a space mark before it and for each of its spaces.  If no piece has a mark
after another character (so in all vocabularies that keep words apart), the best path of a text is
made of those of its words, each with the marks before it; words are counted once per worker while
they are remembered.  Otherwise a text is one word.

Defined cases: a null text has no tokens (0), an empty one too; other columns are ignored; repeated
rows give a row each; an empty table gives an empty result.  Lone surrogates can't occur in Arrow
strings.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxelspark.llm import textscan as ts
from voxelspark.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SETTING = "spark.voxelspark.tokenizer"  # the path, where it is another one
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 64 << 20  # bytes of words and counts
LONG_WORD = 4096  # characters; longer words are not remembered
MOST_PIECES = 1_000_000  # a vocabulary is sent to every worker


@dataclass
class Vocabulary:
    pieces: dict[str, float]
    bytes_too: bool

    def __post_init__(self):
        if len(self.pieces) > MOST_PIECES:
            raise ValueError(f"more than {MOST_PIECES} pieces")


def read_model(path: str = MODEL) -> Vocabulary:
    """Normal and user-defined pieces of a SentencePiece file, with their scores as unigram's."""
    import sentencepiece

    if not os.path.isfile(path):
        raise FileNotFoundError(f"no vocabulary at {path}; name one in {SETTING}")
    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = m.get_piece_size()
    plain = {m.id_to_piece(i): m.get_score(i) for i in range(n) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}
    return Vocabulary(plain, sum(m.is_byte(i) for i in range(n)) == 256)


class Counter(dict):
    """Word (with its marks) -> number of pieces; remembers words of up to ``LONG_WORD``
    characters, ``REMEMBERED`` bytes of them."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        super().__init__()
        self.held = 0
        self.bytes_too = vocabulary.bytes_too
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self.unknown = min(vocabulary.pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.machine = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            if piece:
                self.machine.add_word(piece, (len(piece), score))
        self.machine.make_automaton()
        apart = not any(MARK in p.lstrip(MARK) for p in vocabulary.pieces)
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if apart else re.compile(r"(?s).+")

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best path."""
        n = len(word)
        found: list[list] = [[] for _ in range(n + 1)]
        for last, match in self.machine.iter(word) if len(self.machine) else ():
            found[last + 1].append(match)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for end in range(1, n + 1):
            top = None
            for size, value in sorted(found[end], reverse=True):  # the longest starts first
                start = end - size
                new = score[start] + value
                if top is None or new > top:
                    top, pieces, odd = new, count[start] + 1, False
            c = word[end - 1]
            if c not in self.single:
                new = score[end - 1] + self.unknown
                if top is None or new > top:
                    cost = len(c.encode("utf-8")) if self.bytes_too else int(not unknown[end - 1])
                    top, pieces, odd = new, count[end - 1] + cost, True
            score[end], count[end], unknown[end] = top, pieces, odd
        return score[n], count[n]

    def __missing__(self, word: str) -> int:
        count = self.best(word)[1]
        if len(word) <= LONG_WORD:
            if self.held >= REMEMBERED:
                self.clear()
                self.held = 0
            self.held += sys.getsizeof(word) + 100  # the entry
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.words.findall(MARK + text.replace(" ", MARK))))


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens)."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value)
        for part in ts.blocks(batches, "text"):
            counts = np.fromiter((counter.count(t) for t in part.column("text").to_pylist()), dtype=np.int64, count=part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts)], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), read_model(spark.conf.get(SETTING, MODEL)))
