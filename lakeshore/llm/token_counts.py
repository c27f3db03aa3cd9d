"""Token counts of a unigram tokenizer by a count-only Viterbi search.

A text is cut as the metaspace pre-tokenizer does: blanks become the word mark, one
is put in front, and every mark starts a piece. In a piece an Aho-Corasick machine
lists all vocabulary entries that end at each character, longest first; dynamic
programming over the characters carries the best score and, instead of a path back,
the number of tokens on it. Ties and unknown characters follow the tokenizer: a
path replaces another only if its score is strictly greater, longer entries come
first, a character that is no entry costs the least score minus 10, and
neighbouring unknowns count as one token. Scores are added left to right in double
precision, as the tokenizer adds them. Counts of pieces are remembered per worker.

Defined cases: a null or empty text has no tokens; very long texts and pieces take
time in proportion to their length; rows that repeat count each; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import table

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_MEMO = 1_000_000
_UNKNOWNS = 1 << 40  # a count of tokens and one of unknowns share an integer
_COUNTERS: dict[str, "UnigramCounter"] = {}


def vocabulary(path: str) -> tuple[list[tuple[str, float]], int]:
    """Pieces with scores in id order, and the id of the unknown piece."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class UnigramCounter(dict):
    """Tokens and unknowns of a piece, packed into one integer; the first ``_MEMO`` are remembered."""

    def __init__(self, vocab: list[tuple[str, float]], unknown: int):
        super().__init__()
        self.machine = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(vocab):
            self.machine.add_word(piece, (len(piece), score, i == unknown))
        self.machine.make_automaton()
        self.unknown_score = min(s for _, s in vocab) - UNKNOWN_PENALTY

    def __missing__(self, piece: str) -> int:
        found = self.count(piece)
        if len(self) < _MEMO:
            self[piece] = found
        return found

    def count(self, piece: str) -> int:
        size = len(piece)
        best: list[float | None] = [None] * (size + 1)
        tokens, unknowns, open_unknown = [0] * (size + 1), [0] * (size + 1), [False] * (size + 1)
        best[0] = 0.0
        done = 0

        def close(end: int, single: bool) -> None:
            """The unknown character that ends here, after all entries that do."""
            start = end - 1
            if not single:
                score = best[start] + self.unknown_score
                if best[end] is None or score > best[end]:
                    step(end, start, score, True)

        def step(end: int, start: int, score: float, unknown: bool) -> None:
            fused = unknown and open_unknown[start]
            best[end] = score
            tokens[end] = tokens[start] + (not fused)
            unknowns[end] = unknowns[start] + (unknown and not fused)
            open_unknown[end] = unknown

        single = False
        for last, (length, score, is_unknown) in self.machine.iter(piece):
            end = last + 1
            while done < last:  # ends before this match are settled first
                done += 1
                close(done, single)
                single = False
            start = end - length
            total = score + best[start]
            if best[end] is None or total > best[end]:
                step(end, start, total, is_unknown)
            single |= length == 1
        while done < size:
            done += 1
            close(done, single)
            single = False
        return tokens[size] + unknowns[size] * _UNKNOWNS

    def totals(self, text: str) -> tuple[int, int]:
        """Tokens and unknown tokens of a whole text."""
        if not text:
            return 0, 0
        marked = text.replace(" ", MARK)
        pieces = marked.split(MARK)
        # the part before the first mark has the mark put in front of it, unless there is one already
        first = [MARK + pieces[0]] if pieces[0] else []
        packed = sum(map(self.__getitem__, first)) + sum(map(self.__getitem__, [MARK + p for p in pieces[1:]]))
        return packed % _UNKNOWNS, packed // _UNKNOWNS


def counter(path: str) -> UnigramCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = UnigramCounter(*vocabulary(path))
    return _COUNTERS[path]


def token_counts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, n_unknown of each row of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counter(model).totals(t or "") for t in batch.column("text").to_pylist()]
            columns = [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "n_unknown"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id bigint, n_tokens bigint, n_unknown bigint")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
