"""Substring deduplication with difference-cover anchors.

A window of ``WINDOW`` words is a repeat if the same words start earlier (smaller
``doc_id``, or same document and earlier start); every word of a repeat goes.

``COVER`` is a difference cover modulo ``PERIOD``: for any two positions there is a
shift below the period that takes both to cover positions. A run of ``ANCHOR``
words after such a shift still lies inside the window, because
``PERIOD - 1 + ANCHOR <= WINDOW``. So only runs at cover positions (4 of 13) are
hashed and shuffled, and any two equal windows have an equal anchor at the same
shift. Then:

1. anchors that occur once are dropped; the others mark their places;
2. every window that holds a marked anchor is extended to its full length and
   hashed with 96 bits; of equal windows all but the first are repeats. A later
   copy of a whole text needs no windows: the first copy has them all;
3. texts with repeats are cut; all others pass untouched and are never shuffled.

A task sends one row for each anchor hash and for each window, the first it has,
and settles by itself what repeats within it, so a line that half of all documents
share reaches a task at most once from each other task. It does so whenever it has
gathered ``FLUSH`` of them, which bounds what it holds.

Defined cases: a null, empty or short text loses nothing; a null ``doc_id`` counts
as larger than any other; rows that share a ``doc_id`` are ordered by a hash of
their text, and rows that repeat both get one common answer, as one document; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import shuffle_partitions, table, written
from lakeshore.llm.words import hash_words, text_buffer, window_hashes, word_spans

WINDOW = 20
ANCHOR = 8
PERIOD, COVER = 13, (0, 1, 3, 9)
BITS = 1 << 23  # of the map of rows that may change
FLUSH = 1_000_000  # anchors or windows that a task gathers before it sends them
_SEND = 50_000  # rows of a batch that is sent
_PLACE_BITS = 22
_PLACES = 1 << _PLACE_BITS
_LAST = (1 << 63) - 1  # order of a null doc_id


def _positions(first: np.ndarray, length: int) -> np.ndarray:
    """Position within its row of each word that starts a run of ``length`` words; -1 for the others."""
    n = np.diff(first)
    at = np.arange(first[-1]) - np.repeat(first[:-1], n)
    at[at > np.repeat(n, n) - length] = -1
    return at


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[pa.RecordBatch]:
    """One row for each anchor hash of the task (repeated: whether it occurs twice in it),
    and the places of those that do.

    Every ``flush`` anchors what was gathered is sent, as if another task began.
    """
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        starts, ends, first = word_spans(data, offsets)
        runs = window_hashes(hash_words(data, starts, ends), ANCHOR)
        at = _positions(first, ANCHOR)[: len(runs)]
        pick = np.flatnonzero((at >= 0) & np.isin(at % PERIOD, COVER))
        keys = np.asarray(batch.column("row_key"))
        held.append((runs[pick], keys[np.searchsorted(first, pick, side="right") - 1], at[pick].astype(np.int32)))
        size += len(pick)
        if size >= flush:
            yield from _sent_anchors(held)
            held, size = [], 0
    if size:
        yield from _sent_anchors(held)


def _sent_anchors(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    h, row, place = (np.concatenate(c) for c in zip(*held, strict=True))
    order = np.argsort(h, kind="stable")
    h, row, place = h[order], row[order], place[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    heads = np.flatnonzero(new)
    count = np.diff(np.append(heads, len(h)))
    known = np.flatnonzero(np.repeat(count > 1, count))
    for a in range(0, len(heads), _SEND):
        k = heads[a : a + _SEND]
        yield _anchor_rows(h[k], row[k], place[k], count[a : a + _SEND] > 1, False)
    for a in range(0, len(known), _SEND):
        k = known[a : a + _SEND]
        yield _anchor_rows(row[k] * np.int64(31) + place[k], row[k], place[k], np.ones(len(k), bool), True)


def _anchor_rows(h, row, place, repeated, known) -> pa.RecordBatch:
    """``info`` packs the row, the place and two flags, which keeps the shuffled rows small. Row and
    place are cut to the bits there are: a row or place that shares them is a candidate in vain."""
    info = (row << _PLACE_BITS + 2) | (place.astype(np.int64) % _PLACES) * 4 + repeated * 2 + known
    return pa.RecordBatch.from_arrays([_signed(h), pa.array(info)], ["anchor", "info"])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the anchors that occur twice, of rows in the order of the anchors."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h = np.asarray(batch.column("anchor"))
        cut = int(np.searchsorted(h, h[-1], side="left"))  # the last anchor may go on in the next batch
        held = batch.slice(cut)
        yield _repeated(batch.slice(0, cut))
    if held is not None:
        yield _repeated(held)


def _repeated(batch: pa.RecordBatch) -> pa.RecordBatch:
    h, info = np.asarray(batch.column("anchor")), np.asarray(batch.column("info"))
    known, in_task = info & 1 == 1, info & 2 == 2
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    group = np.cumsum(new) - 1
    tasks = np.bincount(group[~known], minlength=len(h))
    # an anchor that its own task found twice is among the known places
    keep = known | (~in_task & (tasks[group] > 1))
    columns = [pa.array(info >> _PLACE_BITS + 2), pa.array((info >> 2 & _PLACES - 1).astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["row", "place"]).filter(pa.array(keep))


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    raw = data[starts[0] : ends[-1]].tobytes() if len(starts) else b""
    return hashlib.sha256(b" ".join(raw.split())).hexdigest()


def _suspect(row_keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether a row may have a mark."""
    slot = (row_keys & (BITS - 1)).astype(np.int64)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1


def _suspects(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows that may have a mark."""
    for batch in batches:
        yield batch.filter(pa.array(_suspect(np.asarray(batch.column("row_key")), bits)))


def _untouched(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The other rows, done."""
    for batch in batches:
        batch = batch.filter(pa.array(~_suspect(np.asarray(batch.column("row_key")), bits)))
        data, offsets = text_buffer(batch.column("text"))
        starts, ends, first = word_spans(data, offsets)
        digests = [
            _joined(data, starts[x:y], ends[x:y]) for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)
        ]
        none = pa.nulls(batch.num_rows, pa.string())
        zero = pa.array(np.zeros(batch.num_rows, np.int64))
        columns = [batch.column("doc_id"), pa.array(np.diff(first)), zero, pa.array(digests, pa.string()), none]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def _lists(column: pa.Array) -> tuple[np.ndarray | dict[str, np.ndarray], np.ndarray]:
    """Values (by field, if they are structs) and offsets of a list column; a null list is empty."""
    sizes = np.where(np.asarray(column.is_null()), 0, np.diff(np.asarray(column.offsets, np.int64)))
    values = column.flatten()
    if pa.types.is_struct(values.type):
        values = {f.name: np.asarray(x) for f, x in zip(values.type, values.flatten(), strict=True)}
    else:
        values = np.asarray(values)
    return values, np.append(0, np.cumsum(sizes))


def _windows(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[pa.RecordBatch]:
    """Windows that hold a marked anchor: the first of equal ones in the task, and the
    places of the later ones, which are repeats whatever other tasks hold.

    Every ``flush`` windows what was gathered is sent, as if another task began.
    """
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        starts, ends, first = word_spans(data, offsets)
        words = [hash_words(data, starts, ends, base=k) for k in (0, 1)]
        docs, keys = np.asarray(batch.column("doc")), np.asarray(batch.column("row_key"))
        marks, cuts = _lists(batch.column("places"))
        for i in range(batch.num_rows):
            x, y = int(first[i]), int(first[i + 1])
            if y - x < WINDOW:
                continue
            p = marks[cuts[i] : cuts[i + 1]].astype(np.int64)
            if y - x > _PLACES:
                p = (p[:, None] + np.arange(0, y - x, _PLACES)).ravel()
            p = p[p < y - x]
            edge = np.zeros(y - x + 2, np.int64)
            np.add.at(edge, np.maximum(p - PERIOD + 1, 0), 1)
            np.add.at(edge, p + 1, -1)
            at = np.flatnonzero(np.cumsum(edge)[: y - x - WINDOW + 1] > 0)
            hashes = [window_hashes(words[k][x:y], WINDOW)[at].view(np.int64) for k in (0, 1)]
            held.append((*hashes, np.full(len(at), docs[i]), np.full(len(at), keys[i]), at))
            size += len(at)
            if size >= flush:
                yield from _sent_windows(held)
                held, size = [], 0
    if size:
        yield from _sent_windows(held)


def _sent_windows(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    h1, h2, doc, key, at = (np.concatenate(c) for c in zip(*held, strict=True))
    h2 = h2 >> 32 << 32
    order = np.lexsort((at, key, doc, h2, h1))
    h1, h2, doc, key, at = (c[order] for c in (h1, h2, doc, key, at))
    new = np.ones(len(h1), bool)  # a repeated row has the same places as the row itself
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])
    h1, h2, doc, key, at = (c[new] for c in (h1, h2, doc, key, at))
    later = np.zeros(len(h1), bool)
    later[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    # 96 bits of the hashes are kept, half of the second beside the start
    h1, high = np.where(later, key * 31 + at, h1), np.where(later, 0, h2 >> 32)
    info = (high << 32) | (at * 2 + later)
    for a in range(0, len(h1), _SEND):
        cut = slice(a, a + _SEND)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[cut]) for c in (h1, doc, key, info)], ["h1", "doc", "row_key", "info"]
        )


def _later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All but the first of equal windows, of rows in the order of hashes and places."""
    last = None
    for batch in batches:
        info = np.asarray(batch.column("info"))
        repeat = info & 1 == 1  # known to its task
        sent = np.flatnonzero(~repeat)
        if len(sent):
            rows = np.stack([np.asarray(batch.column(c)) for c in ("h1", "row_key", "info")] + [info >> 32], axis=1)[sent]
            before = np.concatenate([rows[:1] if last is None else last, rows[:-1]])
            same = (rows == before).all(axis=1)  # of a repeated row, or the very first
            repeat[sent] = (rows[:, [0, 3]] == before[:, [0, 3]]).all(axis=1) & ~same
            last = rows[-1:].copy()
        columns = [batch.column("row_key"), batch.column("doc"), pa.array((info & 0xFFFFFFFF) >> 1)]
        yield pa.RecordBatch.from_arrays(columns, ["row_key", "doc", "start"]).filter(pa.array(repeat))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their repeats."""
    for batch in batches:
        data, offsets = text_buffer(batch.column("text"))
        starts, ends, first = word_spans(data, offsets)
        found, cuts = _lists(batch.column("repeats"))
        edge = np.zeros(len(starts) + 1, np.int64)
        size = np.diff(first)
        row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
        mine = np.ones(len(row), bool)
        for c in ("doc", "row_key"):  # rows that only share the bits of ``row`` are among them
            mine &= found[c] == np.asarray(batch.column(c))[row]
        at = (first[:-1][row] + found["start"])[mine]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        copies = np.flatnonzero(np.asarray(batch.column("is_copy")) & (size >= WINDOW))
        np.add.at(edge, first[copies], 1)
        np.add.at(edge, first[copies + 1], -1)
        gone = np.cumsum(edge)[: len(starts)] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])[first]
        raw, kept_texts = memoryview(data), []
        for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            stay = np.flatnonzero(~gone[x:y]) + x
            words = [raw[a:b] for a, b in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]
            kept_texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(size, pa.int64()),
                pa.array(np.diff(removed), pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in kept_texts], pa.string()),
                pa.array([t.decode() for t in kept_texts], pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def _marked_rows(keyed: DataFrame, flush: int) -> DataFrame:
    """row, places, copies (row keys of later copies) of the rows that may lose words."""
    n = shuffle_partitions(keyed.sparkSession)
    anchors = keyed.select("text", "row_key").mapInArrow(
        lambda batches: _anchors(batches, flush), "anchor bigint, info bigint"
    )
    places = (
        anchors.repartition(n, "anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_marked, "row bigint, place int")
        .groupBy("row")
        .agg(F.collect_set("place").alias("places"))
    )
    # a later copy of a whole text: every window of it starts earlier, in the first copy
    rows = written(keyed.select("doc", "row_key", F.unhex(F.md5("text")).alias("digest")), "substring-digests")
    place = F.struct("doc", "row_key")
    groups = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = rows.join(groups, "digest").where(place != F.col("first")).select("row_key").distinct()
    row = _row(F.col("row_key")).alias("row")
    both = places.unionByName(
        copies.groupBy(row).agg(F.collect_set("row_key").alias("copies")), allowMissingColumns=True
    )
    return both.groupBy("row").agg(
        F.first("places", ignorenulls=True).alias("places"), F.first("copies", ignorenulls=True).alias("copies")
    )


def _row(row_key: Column) -> Column:
    """The bits of a row key that go with an anchor."""
    return F.shiftright(F.shiftleft(row_key, _PLACE_BITS + 2), _PLACE_BITS + 2)


def remove_repeats(docs: DataFrame, flush: int = FLUSH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept_text for each row of ``docs`` (doc_id, text).

    ``kept_text`` is null where nothing can be removed: the words of the text itself stay.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LAST)).alias("doc"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.xxhash64("doc_id", "text").alias("row_key"),
    )
    marks = written(_marked_rows(keyed, flush), "substring-marks")
    # a bit for each marked row, in a map of fixed size: texts of rows without it are not shuffled
    slot = F.col("row").bitwiseAND(F.lit(BITS - 1))
    words = marks.groupBy(F.shiftright(slot, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((row & {BITS - 1}) & 63 as int))")).alias("bits")
    )
    bits = np.zeros(BITS // 64, np.uint64)
    for r in words.toLocalIterator():  # at most BITS / 64 rows
        bits[r["word"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    shared = spark.sparkContext.broadcast(bits)

    # read again instead of written: a pass over the texts costs less than a copy of them
    rows = keyed.select("doc_id", "row_key", "text")
    suspects = rows.mapInArrow(
        lambda batches: _suspects(batches, shared.value), "doc_id bigint, row_key bigint, text string"
    ).select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), "row_key", "text")
    joined = suspects.withColumn("row", _row(F.col("row_key"))).join(marks, "row", "left")
    is_copy = F.coalesce(F.array_contains("copies", F.col("row_key")), F.lit(False))
    repeats = (
        joined.where(F.col("places").isNotNull() & ~is_copy)
        .select("doc", "row_key", "text", "places")
        .mapInArrow(lambda batches: _windows(batches, flush), "h1 bigint, doc bigint, row_key bigint, info bigint")
        .repartition(shuffle_partitions(spark), "h1")
        .sortWithinPartitions("h1", F.shiftright("info", 32), "doc", "row_key", "info")
        .mapInArrow(_later, "row_key bigint, doc bigint, start bigint")
        .groupBy(_row(F.col("row_key")).alias("row"))
        .agg(F.collect_set(F.struct("row_key", "doc", "start")).alias("repeats"))  # no more than the text has words
    )
    cut = joined.join(repeats, "row", "left").select(
        "doc_id", "doc", "row_key", "text", is_copy.alias("is_copy"), "repeats"
    )
    result = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    return rows.mapInArrow(lambda batches: _untouched(batches, shared.value), result).unionByName(
        cut.mapInArrow(_cut, result)
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of it."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")
