"""Codes of vectors from trained codebooks, with LAESA pivots in the search.

Components become integers, vectors are cut into ``PARTS`` parts, and each part
position has a codebook: the parts of the vectors with the smallest ids, moved in
``ROUNDS`` rounds to the mean (rounded down) of the parts assigned to them.

The search for the nearest entry uses fixed pivots, far apart among the first
entries. The distances of every part to them are computed once and stored beside the
part. Entries move, so a round computes the few distances between pivots and entries
anew; by the triangle inequality the difference of the two distances is a lower bound
of the distance between part and entry. The entry of the least bound is evaluated
first; then those whose bound does not exceed the distance found, one by one where few
are left and block by block where many are. Bounds are lowered by more than floating
point can err and squared distances are whole numbers, so results are exact.

A round reads the stored table once. A task sums the parts of each entry and sends
one row an entry; at most ``PARTS * ENTRIES`` rows with the new entries reach the
driver, and as many are broadcast, whatever the number of vectors.

Defined cases: a vector that is null or holds a null, NaN or infinite component is
dropped, and so is one whose length is no positive multiple of ``PARTS`` or differs
from that of the first kept one; a null ``vec_id`` counts as larger than any other;
vectors that share a ``vec_id`` are ordered by their integers, and rows that repeat are
rows each; ties go to the entry of lower index; with fewer vectors than entries the
codebooks are smaller; null labels are one group; an empty table gives an empty
result; extra columns are ignored. Components so large that a squared distance could
pass 2^52 raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import table, written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
SCALE = 1024
PIVOTS = 8
_ROWS = 500  # vectors searched at a time
_DENSE = 8  # pairs go one by one where less than this share of them is left
_SALTS = 16
_WIDEST = 1 << 52


def integers(embedding: Column) -> Column:
    """The components as integers."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label, ints of the vectors that can be coded."""
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    even = (F.size("embedding") > 0) & (F.size("embedding") % PARTS == 0)
    return vectors.where(F.col("embedding").isNotNull() & usable & even).select(
        "vec_id", "label", integers(F.col("embedding")).alias("ints")
    )


@dataclass(frozen=True)
class Codebooks:
    """Entries by part position, and the pivots of each position."""

    entries: np.ndarray  # part, entry, position within the part
    pivots: np.ndarray  # part, pivot, position within the part

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """``count`` of the points, each the farthest from those before it (of equal ones the first)."""
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(points)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


def first_codebooks(kept: DataFrame, pivots: int = PIVOTS) -> Codebooks | None:
    """The parts of the ``ENTRIES`` vectors of the smallest ids; no more than these reach the driver."""
    order = (F.col("vec_id").asc_nulls_last(), F.col("ints"))
    one = kept.orderBy(*order).select(F.size("ints")).first()
    if one is None:
        return None
    rows = kept.where(F.size("ints") == one[0]).orderBy(*order).limit(ENTRIES).select("ints").collect()
    entries = np.array([r["ints"] for r in rows], np.int64).reshape(len(rows), PARTS, -1).transpose(1, 0, 2)
    return Codebooks(entries, np.stack([far_apart(part, pivots) for part in entries]))


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distance of each point to each pivot."""
    gap = points[:, None, :] - pivots[None, :, :]
    return np.sqrt((gap * gap).sum(axis=2).astype(np.float64)).astype(np.float32)


def _parts(column: pa.Array) -> np.ndarray:
    """part, row, position within the part."""
    flat = np.asarray(column.flatten()).astype(np.int64)
    parts = flat.reshape(len(column), PARTS, -1)
    largest = max(int(np.abs(flat).max(initial=0)), 1)
    if 4 * largest * largest * parts.shape[2] > _WIDEST:
        raise ValueError("components are too large for exact distances")
    return parts.transpose(1, 0, 2)


class NearestEntries:
    """Nearest entry of each part of one position, by pivots."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.values = entries, entries.astype(np.float64)
        self.norms = (self.values**2).sum(axis=1)
        self.reach = distances(entries, pivots).T.copy()  # pivot, entry

    def _pairs(self, points: np.ndarray, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Squared distances of single pairs."""
        gap = points[rows] - self.entries[entries]
        return np.einsum("ij,ij->i", gap, gap)

    def _block(self, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Squared distances of all points to some entries; whole numbers below 2^53 are exact."""
        values = points.astype(np.float64)
        return (values**2).sum(axis=1)[:, None] + self.norms[entries] - 2 * (values @ self.values[entries].T)

    def bounds(self, to_pivots: np.ndarray) -> np.ndarray:
        """A lower bound of the distance of each point to each entry."""
        bound = np.zeros((len(to_pivots), len(self.entries)), np.float32)
        for j, reach in enumerate(self.reach):
            gap = to_pivots[:, j, None] - reach[None, :]
            np.maximum(bound, np.abs(gap, out=gap), out=bound)
        # what 32-bit numbers can err in the distances, and more
        return bound - np.float32(1e-6) * (to_pivots.max(initial=0) + self.reach.max(initial=0))

    def find(self, points: np.ndarray, to_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point and the squared distance to it."""
        bound = self.bounds(to_pivots)
        n, k = bound.shape
        best = self._pairs(points, np.arange(n), bound.argmin(axis=1))
        limit = np.sqrt(best.astype(np.float64)) * (1 + 1e-6)
        left = bound <= limit[:, None].astype(np.float32)  # the nearest is always among them
        if np.count_nonzero(left) * _DENSE < left.size:
            rows, entries = np.nonzero(left)
            found = np.full((n, k), np.iinfo(np.int64).max)
            found[rows, entries] = self._pairs(points, rows, entries)
            entries = np.arange(k)
        else:
            entries = np.flatnonzero(left.any(axis=0))
            found = np.where(left[:, entries], self._block(points, entries), np.inf)
        nearest = found.argmin(axis=1)
        return entries[nearest], found[np.arange(n), nearest].astype(np.int64)


def with_pivot_distances(kept: DataFrame, books: Codebooks) -> DataFrame:
    """``kept`` with ``to_pivots``: the distances of all parts to the pivots of their position."""
    shared = kept.sparkSession.sparkContext.broadcast(books.pivots)
    length = books.entries.shape[0] * books.entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(a, _ROWS)
                near = [distances(p, q) for p, q in zip(_parts(rows.column("ints")), shared.value, strict=True)]
                flat = np.stack(near, axis=1).reshape(rows.num_rows, -1)
                offsets = np.arange(rows.num_rows + 1, dtype=np.int32) * flat.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], ["vec_id", "label", "ints", "to_pivots"])

    schema = kept.schema.simpleString().removeprefix("struct<").removesuffix(">")
    return kept.where(F.size("ints") == length).mapInArrow(run, schema + ",to_pivots:array<float>")


def _search(batch: pa.RecordBatch, finders: list[NearestEntries]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of a batch; for each part position the parts, their entries and squared distances."""
    for a in range(0, batch.num_rows, _ROWS):
        rows = batch.slice(a, _ROWS)
        parts = _parts(rows.column("ints"))
        near = np.asarray(rows.column("to_pivots").flatten()).reshape(rows.num_rows, PARTS, -1)
        yield rows, [(p, *f.find(p, near[:, i])) for i, (p, f) in enumerate(zip(parts, finders, strict=True))]


def _finders(books: Codebooks) -> list[NearestEntries]:
    return [NearestEntries(e, p) for e, p in zip(books.entries, books.pivots, strict=True)]


def moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over the stored ``vectors``."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    _, k, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = _finders(shared.value)
        sums, counts = np.zeros((PARTS, k, width), np.int64), np.zeros((PARTS, k), np.int64)
        for batch in batches:
            for _, found in _search(batch, finders):
                for i, (parts, entry, _) in enumerate(found):
                    np.add.at(sums[i], entry, parts)
                    counts[i] += np.bincount(entry, minlength=k)
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(part, pa.int32()),
                "entry": pa.array(entry, pa.int32()),
                "n": pa.array(counts[part, entry], pa.int64()),
                "sums": pa.array(sums[part, entry].tolist(), pa.list_(pa.int64())),
            }
        )

    partial = vectors.select("ints", "to_pivots").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    entries = books.entries.copy()
    for r in totals.collect():  # at most a row an entry
        entries[r["part"], r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return Codebooks(entries, books.pivots)


def coded(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error of the stored ``vectors``."""
    shared = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = _finders(shared.value)
        for batch in batches:
            for rows, found in _search(batch, finders):
                code = np.stack([entry for _, entry, _ in found], axis=1).astype(np.uint8)
                error = sum(distance for _, _, distance in found)
                texts = [c.tobytes().hex() for c in code]
                columns = [rows.column("vec_id"), rows.column("label"), pa.array(texts, pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    schema = vectors.select("vec_id", "label").schema.simpleString().removeprefix("struct<").removesuffix(">")
    return vectors.mapInArrow(run, schema + ",code:string,error:bigint")


def trained(kept: DataFrame, rounds: int = ROUNDS, pivots: int = PIVOTS) -> tuple[DataFrame, Codebooks] | None:
    """The stored vectors and their codebooks; None without a vector."""
    books = first_codebooks(kept, pivots)
    if books is None:
        return None
    vectors = written(with_pivot_distances(kept, books), "vector-parts")
    for _ in range(rounds):
        books = moved(vectors, books)
    return vectors, books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``. A label's sum is sent to each of ``_SALTS`` shares of its rows."""
    codes = written(codes, "vector-codes")
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.select(
        F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("_salt")
    )
    share = F.pmod(F.monotonically_increasing_id(), F.lit(_SALTS)).cast("int")
    joined = codes.withColumn("_share", share).join(
        totals, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_share") == F.col("_salt"))
    )
    return joined.drop("_label", "_salt", "_share")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector of ``embeddings``, its error and that of its label."""
    kept = kept_vectors(table(spark, sf_dir, "embeddings"))
    found = trained(kept)
    if found is None:
        empty = "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return spark.createDataFrame([], empty)
    vectors, books = found
    codes = with_label_errors(coded(vectors, books))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _round_sql(i: int) -> str:
    return f"""
near{i} AS MATERIALIZED (
    SELECT p.row, p.part, arg_min(b.entry, d.dist * {ENTRIES} + b.entry) AS entry, min(d.dist) AS dist
    FROM parts p JOIN book{i} b USING (part),
        LATERAL (SELECT list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist) d
    GROUP BY p.row, p.part)"""


def _book_sql(i: int) -> str:
    return f"""
book{i + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{i} b LEFT JOIN (
        SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM (
            SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS n FROM (
                SELECT p.part, a.entry, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS pos
                FROM parts p JOIN near{i} a USING (row, part))
            GROUP BY part, entry, pos)
        GROUP BY part, entry) m USING (part, entry))"""


OP11_SQL = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, ints) - 1 AS row, vec_id, label, ints FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS ints
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (
    SELECT row, part, ints[part * (len(ints) // {PARTS}) + 1 : (part + 1) * (len(ints) // {PARTS})] AS v
    FROM kept, range({PARTS}) AS r(part)),
book0 AS MATERIALIZED (SELECT part, row AS entry, v FROM parts WHERE row < {ENTRIES}),
{",".join(_round_sql(i) + "," + _book_sql(i) for i in range(ROUNDS))},
{_round_sql(ROUNDS)},
codes AS (
    SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
    FROM near{ROUNDS} GROUP BY row),
books AS (
    SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM book{ROUNDS}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN codes USING (row), books
"""
