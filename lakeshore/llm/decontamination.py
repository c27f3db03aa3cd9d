"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into passages of at most ``PASSAGE`` words, the last of
which ends with its item, so every word of a longer item is in a full passage. They
are weighed by TF-IDF over hashed terms (document frequencies from all documents),
and a distributed randomised SVD of the passages gives a latent space of ``RANK``
dimensions: each task multiplies its passages with the current basis, products are
summed in a tree, and the driver only orthogonalises a matrix whose size is a
parameter. Documents are read once more: blocks of ``BLOCK`` words are folded into
the space, windows are sums of neighbouring blocks just long enough to hold a
passage at any place, and windows whose cosine with a passage reaches ``COSINE``
are candidates. Passages of ``BLOCK`` words at most are small beside their window and
do not depend on the space: of their rarest words, one more than a paraphrase may
lack, each names its windows as candidates. A candidate is confirmed on words: the longest common subsequence
must cover ``COPY`` of the passage, or ``PARAPHRASE`` of it when ``RUN`` words of it
are there in one piece or the answer (the item's ``answer``, else its last sentence)
is there too: in the window, or in one of its length where the whole item is to be
expected around it. Passages start every ``STRIDE`` words, so ``RUN`` words from any
place of an item lie whole in one of its passages.

The words of short passages, and a run of ``RUN`` words as a proof, supplement the
latent search; a match with a cosine below ``COSINE`` was found by the supplement alone.

The benchmark is the stated query set. Its passages go through in sets of
``QUERIES``, and ``SETS`` of these are broadcast for one pass over the documents; a
longer benchmark takes more passes, whose results meet by a digest of the text. So
neither the driver nor a task ever holds more than ``QUERIES * SETS`` passages.

Defined cases: null and empty texts of documents have no leaks; null or blank
items are no passages; ``item_id`` keeps its type, and a null one is reported as
null; items are told apart by id and text, so each distinct (item_id, text) is
reported once; an empty table on either side gives no leaks; extra columns of
documents are kept by ``with_leaks`` and its own column replaces one of the same name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeshore.llm.common import free_name, table, written
from lakeshore.llm.words import hash_words, text_buffer, word_spans

PASSAGE, STRIDE = 64, 12  # words of a passage, and between the starts of two; (1 - COPY) * PASSAGE at most
BLOCK = 16
RANK, EXTRA, TURNS = 128, 8, 2  # of the randomised SVD
TERMS = 1 << 16  # hashed terms
COSINE = 0.35
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
ANSWER_WORDS = 5
RUN = 39  # words in one piece that are a copy by themselves: PARAPHRASE of a full passage
QUERIES = 4096
SKETCH = 1024  # places of the hashed word set of a passage
PAIRS = 1 << 14  # windows and passages whose words are laid beside each other at a time

SETS = 8  # sets of queries that are broadcast at a time


def _leak_type(item_id: T.DataType) -> T.ArrayType:
    fields = [("item", T.LongType()), ("item_id", item_id), ("lcs", T.DoubleType()), ("answer", T.DoubleType()), ("cosine", T.DoubleType())]
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in [*fields, ("first_word", T.LongType())]]))


def _hashes(text: str) -> np.ndarray:
    data, offsets = text_buffer(pa.array([text]))
    starts, ends, _ = word_spans(data, offsets)
    return hash_words(data, starts, ends, lower=True)


def answer_of(text: str, answer: str | None) -> np.ndarray:
    """Word hashes of the answer: the one given, else the last sentence, of some words at least."""
    if answer and answer.strip():
        return _hashes(answer)
    last = _hashes(re.split(r"(?<=[.!?])\s+", text.strip())[-1])
    return last if len(last) >= ANSWER_WORDS else _hashes(text)[-ANSWER_WORDS:]


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one machine-word row at a time."""
    at: dict[int, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        m = at.get(y)
        if m is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


@dataclass
class Passages:
    """A set of queries: fixed-size pieces of benchmark items."""

    items: list[int]  # number of the passage's item, one for each distinct id and text
    item_ids: list
    words: list[np.ndarray]
    answers: list[np.ndarray]
    vectors: np.ndarray  # latent, of length 1
    starts: list[int]  # first word of the passage in its item
    item_words: list[int]  # of the whole item
    keys: np.ndarray  # rarest words of the short passages, in order
    key_of: np.ndarray  # passage of each key

    @cached_property
    def sketch(self) -> np.ndarray:
        """The places of each passage's words in a small table."""
        out = np.zeros((len(self.words), SKETCH), bool)
        for p, w in enumerate(self.words):
            out[p, _terms(w) % SKETCH] = True
        return out

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(w) for w in self.words])


@dataclass
class LatentIndex:
    slots: np.ndarray  # term -> row of basis, or -1
    basis: np.ndarray  # idf-weighted rows
    queries: list[Passages]


def passage_starts(n_words: int) -> list[int]:
    """First words of the passages of an item; the last passage of a long one ends where the item does."""
    if n_words <= PASSAGE:
        return [0] if n_words else []
    return [*range(0, n_words - PASSAGE, STRIDE), n_words - PASSAGE]


def benchmark_passages(benchmark: DataFrame) -> DataFrame:
    """item (a hash of id and text), item_id, words (hashes), answer (hashes), start in the
    item and the item's length of every passage."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    items = (
        benchmark.select("item_id", "text", answer.alias("answer"))
        .where(F.col("text").isNotNull())
        .distinct()
        .withColumn("item", F.xxhash64("item_id", "text"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, words, answers, starts, lengths = [], [], [], [], []
            for i, (text, given) in enumerate(zip(batch["text"].to_pylist(), batch["answer"].to_pylist(), strict=True)):
                h = _hashes(text)
                a = answer_of(text, given).view(np.int64).tolist() if len(h) else []
                for s in passage_starts(len(h)):
                    of.append(i)
                    words.append(h[s : s + PASSAGE].view(np.int64).tolist())
                    answers.append(a)
                    starts.append(s)
                    lengths.append(len(h))
            at = pa.array(of, pa.int64())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["item"].take(at), batch["item_id"].take(at), pa.array(words, longs), pa.array(answers, longs),
                    pa.array(starts, pa.int32()), pa.array(lengths, pa.int32()),
                ],
                ["item", "item_id", "words", "answer", "start", "item_words"],
            )

    longs = T.ArrayType(T.LongType())
    fields = [("item", T.LongType()), ("item_id", items.schema["item_id"].dataType), ("words", longs), ("answer", longs)]
    schema = T.StructType([T.StructField(n, t) for n, t in [*fields, ("start", T.IntegerType()), ("item_words", T.IntegerType())]])
    return items.select("item", "item_id", "text", "answer").mapInArrow(cut, schema)


def _terms(words: np.ndarray) -> np.ndarray:
    return (words.view(np.uint64) & np.uint64(TERMS - 1)).astype(np.int64)


def _document_frequency(docs: DataFrame, slots: np.ndarray, used: int) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(used, np.int64), 0
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            starts, ends, first = word_spans(data, offsets)
            at = slots[_terms(hash_words(data, starts, ends, lower=True))]
            doc = np.repeat(np.arange(batch.num_rows), np.diff(first))[at >= 0]
            for a in range(0, batch.num_rows, 256):
                part = slice(*np.searchsorted(doc, [a, a + 256]))
                flags = np.zeros((256, used), bool)
                flags[doc[part] - a, at[at >= 0][part]] = True
                seen += flags.sum(axis=0)
            rows += batch.num_rows
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(seen[found], rows))], ["slot", "n"]
        )

    sums = docs.select("text").mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    df, total = np.zeros(used, np.int64), 0
    for r in sums.collect():  # at most TERMS + 1 rows
        if r["slot"] < 0:
            total = r["n"]
        else:
            df[r["slot"]] = r["n"]
    return df, total


def _tf_idf(words, slots: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and weights (of length 1) of a passage, and its product with a basis."""
    at, tf = np.unique(slots[_terms(np.asarray(words, np.int64))], return_counts=True)
    weight = tf * idf[at]
    norm = np.linalg.norm(weight)
    weight = weight / norm if norm else weight
    return at, weight, weight @ basis[at]


def _randomised_svd(passages: DataFrame, slots: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The leading right singular vectors of the TF-IDF matrix of the passages (terms x rank)."""
    used, width = len(idf), min(RANK + EXTRA, len(idf))
    basis = np.random.default_rng(23).normal(size=(used, width))

    def summed(q: np.ndarray, small: bool) -> np.ndarray:
        shared = passages.sparkSession.sparkContext.broadcast(q.astype(np.float32))

        def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((width, width) if small else (used, width), np.float64)
            for batch in batches:
                for words in batch["words"]:
                    at, weight, y = _tf_idf(words, slots, idf, shared.value)
                    if small:
                        total += np.outer(y, y)
                    else:
                        total[at] += np.outer(weight, y)
            yield pd.DataFrame({"total": [total.tobytes()]})

        parts = passages.select("words").mapInPandas(products, "total binary").rdd
        out = parts.map(lambda r: np.frombuffer(r["total"])).treeReduce(np.add, depth=2)
        return out.reshape((width, width) if small else (used, width))

    for _ in range(TURNS):
        basis, _ = np.linalg.qr(summed(basis, small=False))
    values, vectors = np.linalg.eigh(summed(basis, small=True))
    best = np.argsort(values)[::-1][:RANK]
    best = best[values[best] > 1e-9]
    return basis @ vectors[:, best]


def fit_index(docs: DataFrame, benchmark: DataFrame) -> Iterator[LatentIndex]:
    """The latent space of the benchmark's passages with ``SETS`` sets of them at a time."""
    passages = written(benchmark_passages(benchmark), "passages")
    term = F.explode("words").alias("word")
    terms = passages.select(term).select(F.col("word").bitwiseAND(F.lit(TERMS - 1)).alias("term")).distinct()
    found = sorted(r["term"] for r in terms.collect())  # at most TERMS rows
    if not found:
        return
    slots = np.full(TERMS, -1, np.int64)
    slots[found] = np.arange(len(found))
    df, total = _document_frequency(docs, slots, len(found))
    idf = np.log((1 + total) / (1 + df)) + 0.1
    basis = _randomised_svd(passages, slots, idf)
    weighted = (basis * idf[:, None]).astype(np.float32)
    rows = iter(passages.toLocalIterator())  # the query set, never more of it than one index holds
    while part := list(islice(rows, QUERIES * SETS)):
        sets = [part[a : a + QUERIES] for a in range(0, len(part), QUERIES)]
        yield LatentIndex(slots, weighted, [_query_set(x, slots, idf, basis) for x in sets])


def _query_set(rows: list, slots: np.ndarray, idf: np.ndarray, basis: np.ndarray) -> Passages:
    vectors = np.array([_tf_idf(r["words"], slots, idf, basis)[2] for r in rows])
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    keys = set()
    for p, r in enumerate(rows):
        if len(r["words"]) <= BLOCK:
            w = np.array(r["words"], np.int64)
            lacking = len(w) - math.ceil(PARAPHRASE * len(w) - 1e-9)
            rarest = np.argsort(-idf[slots[_terms(w)]], kind="stable")[: lacking + 1]
            keys.update((k, p) for k in w[rarest].tolist())
    keys = np.array(sorted(keys), np.int64).reshape(-1, 2)
    return Passages(
        [r["item"] for r in rows],
        [r["item_id"] for r in rows],
        [np.array(r["words"], np.int64) for r in rows],
        [np.array(r["answer"], np.int64) for r in rows],
        vectors.astype(np.float32),
        [r["start"] for r in rows],
        [r["item_words"] for r in rows],
        keys[:, 0].copy(),
        keys[:, 1].copy(),
    )


def _blocks_for(n_words: int) -> int:
    """Blocks of a window that holds a run of so many words wherever it starts."""
    return -(-n_words // BLOCK) + 1


_MOST = _blocks_for(PASSAGE)


def _block_vectors(words: np.ndarray, first: np.ndarray, index: LatentIndex) -> tuple[np.ndarray, np.ndarray]:
    """Latent sums of all blocks, with empty blocks after each row; the first block of each row."""
    n = np.diff(first)
    per_row = -(-n // BLOCK) + _MOST - 1
    row_block = np.concatenate([[0], np.cumsum(per_row)])
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    block = np.repeat(row_block[:-1], n) + at // BLOCK
    slot = index.slots[_terms(words)]
    block, slot = block[slot >= 0], slot[slot >= 0]
    out = np.zeros((int(row_block[-1]) + _MOST, index.basis.shape[1]), np.float32)
    step = 2048  # words whose rows stay in the processor's cache
    for a in range(0, len(slot), step):
        b = block[a : a + step]
        heads = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        out[b[heads]] += np.add.reduceat(index.basis[slot[a : a + step]], heads, axis=0)
    return out, row_block


def _candidates(blocks: np.ndarray, passages: Passages) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """First block, blocks, passage and cosine of the windows close to a passage, many at a time."""
    need = np.array([_blocks_for(len(w)) for w in passages.words])
    sizes = [(size, np.flatnonzero(need == size)) for size in range(1, _MOST + 1)]
    sizes = [(size, pick, passages.vectors[pick].T) for size, pick in sizes if len(pick)]
    step, total = 1024, len(blocks) - _MOST  # blocks whose sums stay in the processor's cache
    for a in range(0, total, step):
        n = min(step, total - a)
        part = blocks[a : a + n + _MOST]
        sums, held = part[:n].copy(), 1
        for size, pick, queries in sizes:
            while held < size:
                sums += part[held : held + n]
                held += 1
            norms = np.maximum(np.sqrt(np.einsum("ij,ij->i", sums, sums)), 1e-9)
            close = sums @ queries
            i, j = np.nonzero(close >= COSINE * norms[:, None])
            if len(i):
                yield a + i, size, pick[j], close[i, j] / norms[i]


def _short_candidates(
    words: np.ndarray, first: np.ndarray, blocks: np.ndarray, row_block: np.ndarray, passages: Passages
) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """The same for short passages: the windows around their rarest words."""
    if not len(passages.keys):
        return
    known = np.zeros(TERMS, bool)
    known[_terms(passages.keys)] = True
    hits = np.flatnonzero(known[_terms(words)])
    left, right = (np.searchsorted(passages.keys, words[hits], side=side) for side in ("left", "right"))
    hits, left, n = hits[right > left], left[right > left], (right - left)[right > left]
    row = np.searchsorted(first, hits, side="right") - 1
    block = row_block[row] + (hits - first[row]) // BLOCK
    ends, size, step = np.cumsum(n), _blocks_for(BLOCK), 1 << 14
    for a in range(0, int(ends[-1]) if len(ends) else 0, step):
        pair = np.arange(a, min(a + step, int(ends[-1])))
        h = np.searchsorted(ends, pair, side="right")
        which = passages.key_of[left[h] + pair - (ends[h] - n[h])]
        for back in range(size):  # the windows that hold the word
            inside = block[h] - back >= row_block[row[h]]
            at, p = np.unique(np.stack([block[h][inside] - back, which[inside]]), axis=1)
            if len(at):
                sums = sum(blocks[at + k] for k in range(size))
                norms = np.maximum(np.linalg.norm(sums, axis=1), 1e-9)
                yield at, size, p, np.einsum("ij,ij->i", sums, passages.vectors[p]) / norms


def _sliced(found: Iterator[tuple]) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """The candidates, ``PAIRS`` of them at a time."""
    for block, size, which, cosines in found:
        for a in range(0, len(block), PAIRS):
            yield block[a : a + PAIRS], size, which[a : a + PAIRS], cosines[a : a + PAIRS]


def _leaks(texts: pa.Array, index: LatentIndex) -> list[list[dict]]:
    out: list[dict[int, dict]] = [{} for _ in range(len(texts))]
    data, offsets = text_buffer(texts)
    starts, ends, first = word_spans(data, offsets)
    words = hash_words(data, starts, ends, lower=True).view(np.int64)
    if not len(words):
        return [[] for _ in out]
    blocks, row_block = _block_vectors(words, first, index)
    sketch_at = _terms(words) % SKETCH
    for passages in index.queries:
        short = _short_candidates(words, first, blocks, row_block, passages)
        for block, size, which, cosines in _sliced(chain(_candidates(blocks, passages), short)):
            row = np.searchsorted(row_block, block, side="right") - 1
            begin = first[row] + (block - row_block[row]) * BLOCK
            end = np.minimum(begin + size * BLOCK, first[row + 1])
            # no subsequence is longer than the words in common, and a sketch never has fewer of them
            at = begin[:, None] + np.arange(size * BLOCK)
            common = passages.sketch[which[:, None], sketch_at[np.minimum(at, len(words) - 1)]] & (at < end[:, None])
            for c in np.flatnonzero(common.sum(axis=1) >= PARAPHRASE * passages.lengths[which]):
                r, text = row[c], words[first[row[c]] : first[row[c] + 1]]
                _confirm(out[r], text, int(begin[c] - first[r]), int(end[c] - first[r]), passages, int(which[c]), float(cosines[c]))
    return [list(x.values()) for x in out]


def _has_run(wanted: list[int], region: list[int]) -> bool:
    """Whether ``RUN`` words of the passage stand in the region in one piece."""
    runs = {tuple(wanted[i : i + RUN]) for i in range(len(wanted) - RUN + 1)}
    return bool(runs) and any(tuple(region[i : i + RUN]) in runs for i in range(len(region) - RUN + 1))


def _answer_share(answer: list[int], text: np.ndarray, begin: int, end: int, passages: Passages, p: int) -> float:
    """The largest share of the answer in the window, or in one at least as long around the whole item."""
    if not answer:
        return 0.0
    best = lcs(answer, text[begin:end].tolist())
    if best >= ANSWER * len(answer):
        return best / len(answer)
    start, n, held = passages.starts[p], passages.item_words[p], len(passages.words[p])
    margin = BLOCK + n // 4 + len(answer)  # other words between, an answer after the item
    size = max(end - begin, _blocks_for(len(answer)) * BLOCK)
    first, last = max(begin - start - margin, 0), min(end + n - start - held + margin, len(text))
    at = np.append(0, np.cumsum(np.isin(text[first:last], answer)))
    for a in range(0, max(last - first - size + BLOCK, 1), BLOCK):
        b = min(a + size, last - first)
        if at[b] - at[a] > best:  # no subsequence is longer than the words in common
            best = max(best, lcs(answer, text[first + a : first + b].tolist()))
    return best / len(answer)


def _confirm(
    found: dict, text: np.ndarray, begin: int, end: int, passages: Passages, p: int, cosine: float
) -> None:
    """Add the passage's item to those found in a text if the words of the window, and around it, bear it out."""
    item, wanted = passages.items[p], passages.words[p].tolist()
    wanted_set, region = set(wanted), text[begin:end].tolist()
    if sum(w in wanted_set for w in region) < PARAPHRASE * len(wanted):
        return
    share = lcs(wanted, region) / len(wanted)
    if share < PARAPHRASE or (item in found and share <= found[item]["lcs"]):
        return
    has = _answer_share(passages.answers[p].tolist(), text, begin, end, passages, p)
    if share >= COPY or has >= ANSWER or _has_run(wanted, region):
        item_id = passages.item_ids[p]
        found[item] = {"item": item, "item_id": item_id, "lcs": share, "answer": has, "cosine": cosine, "first_word": begin}


def with_leaks(docs: DataFrame, benchmark: DataFrame, column: str = "leaks") -> DataFrame:
    """``docs`` with an array of the benchmark items that each text holds."""
    docs = docs.drop(column)
    leak = _leak_type(benchmark.schema["item_id"].dataType)
    indexes = fit_index(docs, benchmark)
    one, more = next(indexes, None), next(indexes, None)
    if one is None:
        return docs.withColumn(column, _shown(F.array().cast(leak)))
    if more is None:
        found = _searched(docs, one, column, leak)
        return found.withColumn(column, _shown(F.col(column)))
    # more than one pass: what the passes find for a text meets by its digest
    key, own = free_name(docs, "text_digest"), free_name(docs, "found")
    texts = docs.select(F.unhex(F.md5("text")).alias(key), "text")
    parts = []
    for index in chain([one, more], indexes):
        found = _searched(texts, index, own, leak).where(F.size(own) > 0)
        parts.append(written(found.select(key, own).dropDuplicates([key]), "leaks"))
    found = reduce(DataFrame.unionByName, parts).select(key, F.explode(own).alias("x"))
    # of an item whose passages went through in several passes the best one counts
    best = found.groupBy(key, "x.item").agg(F.max_by("x", "x.lcs").alias("x"))
    best = best.groupBy(key).agg(F.collect_list("x").alias(own))
    joined = docs.withColumn(key, F.unhex(F.md5("text"))).join(best, key, "left")
    return joined.withColumn(column, _shown(F.coalesce(own, F.array().cast(leak)))).select(*docs.columns, column)


def _shown(leaks: Column) -> Column:
    """Leaks without the number that tells items apart."""
    return F.transform(leaks, lambda x: F.struct(*[x[n].alias(n) for n in ("item_id", "lcs", "answer", "cosine", "first_word")]))


def _searched(docs: DataFrame, index: LatentIndex, column: str, leak: T.ArrayType) -> DataFrame:
    """``docs`` with what one pass finds."""
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by TERMS, RANK, QUERIES and SETS
    arrow = to_arrow_type(leak)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaks = pa.array(_leaks(batch.column("text"), shared.value), arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns, leaks], [*batch.schema.names, column])

    return docs.mapInArrow(search, T.StructType([*docs.schema.fields, T.StructField(column, leak)]))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that it holds a copy or a paraphrase of."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.inline("leaks"))
