"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document's words are its runs outside white space with A-Z lower-cased; its set
is the distinct shingles of consecutive words (the whole sequence as one when it
is shorter). Two permutations make the whole signature: one deals shingles onto a
circle, the other gives ranks, and coordinate ``k`` is the least rank after the
ranks were shifted by ``k``. Shifted ranks of a shingle are neighbours in memory,
so a signature is one sliding view and a minimum.

Documents with equal sets are one node. Nodes that share a band of the signature
are candidates. Groups can be large, so pairs are not listed group by group:

1. every node is compared with ``LEADER_ROUNDS`` leaders of each of its groups, a number
   of pairs linear in the nodes, and components are formed;
2. in groups that still hold more than one component, the nodes outside the
   group's largest component are compared with all nodes of other components, in
   blocks of bounded size inside tasks. Two nodes of one component need no
   comparison: a link between them would change nothing. What is found links
   components, and only these are joined further;
3. nodes of groups beyond ``CROWD`` meet by their rarest shingles instead, of which
   two sets that can be linked share one for certain, so a passage that thousands
   of documents share does not send their sets to each other.

Together that decides every candidate pair that can matter; every link is
confirmed on full sets. With ``BANDS`` bands of ``ROWS`` coordinates two documents
of similarity 0.85 share a band with probability 0.999997 (with four coordinates a
band, two of similarity 0.8 with 0.99999).

Defined cases: a null, empty or blank text has the empty set, links with nothing
and is its own component; a row with a null ``doc_id`` can not be the smallest
reachable one unless all of its component are null, and is kept when they are;
rows that repeat a ``doc_id`` are documents of their own with equal ids; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshore.llm.common import table, written
from lakeshore.llm.components import connected_components
from lakeshore.llm.words import hash_words, mix, text_buffer, window_hashes, word_spans

BANDS, ROWS = 22, 5
CIRCLE = 1 << 22  # places the shingles are dealt onto
LEADER_ROUNDS = 3  # nodes of a band that all of its nodes are compared with
MINORS, MEMBERS = 256, 1024  # nodes of the two sides of a block
HITS = 1 << 20  # shingles met in the members of a block that are counted at a time
CROWD = 1024  # nodes of a band that are compared in blocks
FEW = 64  # nodes that share a rare shingle and are compared pair by pair
COUNTERS = 1 << 20  # for the counts that tell which shingles are rare
_VIEWS: dict[int, np.ndarray] = {}


def _ranks(width: int) -> np.ndarray:
    """For each place of the circle the ranks at it and at the next places."""
    if width not in _VIEWS:
        ranks = np.random.default_rng(11).permutation(CIRCLE).astype(np.uint32)
        _VIEWS[width] = np.lib.stride_tricks.sliding_window_view(np.concatenate([ranks, ranks[: width - 1]]), width)
    return _VIEWS[width]


def signature(shingles: np.ndarray, width: int) -> np.ndarray:
    """The circulant MinHash of a set of hashed shingles."""
    places = (mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(CIRCLE - 1)).astype(np.int64)
    view = _ranks(width)
    out = view[places[:4096]].min(axis=0)
    for a in range(4096, len(places), 4096):
        np.minimum(out, view[places[a : a + 4096]].min(axis=0), out=out)
    return out


def shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_buffer(texts)
    starts, ends, first = word_spans(data, offsets)
    words = hash_words(data, starts, ends, lower=True)
    windows = window_hashes(words, shingle)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            yield np.unique(windows[a : b - shingle + 1])
        elif b > a:  # hashed with its length, so it meets no longer sequence
            yield mix(window_hashes(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield words[:0]


def _features(shingle: int, per_band: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands = [], [], []
            for s in shingle_sets(batch.column("text"), shingle):
                sizes.append(len(s))
                if not len(s):
                    nodes.append(None)
                    bands.append(None)
                    continue
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()))
                rows = signature(s, BANDS * per_band).reshape(BANDS, per_band)
                bands.append([xxhash.xxh3_64_intdigest(r.tobytes(), seed=k) - (1 << 63) for k, r in enumerate(rows)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "bands"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            wanted = batch.column("node").to_pylist()
            for node, s in zip(wanted, shingle_sets(batch.column("text"), shingle), strict=True):
                if xxhash.xxh3_128_digest(s.tobytes()) == node:
                    nodes.append(node)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _verified(percent: int, ends: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(ends).rename_columns(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block(percent: int):
    """Links between the components of a block's minors and of its members."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        minors, members = rows[rows.minor], rows[~rows.minor]
        sets = [np.frombuffer(x, np.uint64) for x in members.shingles]
        if not len(minors) or not sets:
            return pd.DataFrame([], columns=["a", "b"])
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(sets), dtype=np.int32), sizes)[order]
        del order
        parts = members.component.to_numpy()
        out = set()
        for component, shingles in zip(minors.component, minors.shingles, strict=True):
            s = np.frombuffer(shingles, np.uint64)
            lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
            n = hi - lo
            both = np.zeros(len(sets), np.int64)
            step = max(1, HITS // len(sets))  # a shingle has one hit in a member at most
            for k in range(0, len(s), step):
                first, m = lo[k : k + step], n[k : k + step]
                at = np.repeat(first - np.cumsum(m) + m, m) + np.arange(m.sum())
                both += np.bincount(owner[at], minlength=len(sets))
            near = 100 * both >= percent * (sizes + len(s) - both)
            out.update((component, other) for other in parts[near] if other != component)
        return pd.DataFrame(list(out), columns=["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85, per_band: int = ROWS) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept, component for each row of ``docs`` (doc_id, text).

    ``component`` tells components apart also where rows share ids; it is null for the empty set.
    """
    feats = written(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        )
        .withColumn("text_key", F.xxhash64("text"))
        .mapInArrow(
            _features(shingle, per_band),
            "doc_id bigint, text_key bigint, n_shingles bigint, node binary, bands array<bigint>",
        ),
        "near-features",
    )
    nodes = (
        feats.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_key")).alias("sample"),
            F.any_value("bands").alias("bands"),
        )
    )
    nodes = written(nodes, "near-nodes")
    member = nodes.select("node", F.explode("bands").alias("band"))
    crowded = member.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    member = written(member.join(crowded, "band"), "near-members")
    wanted = nodes.join(member.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("sample.doc_id").alias("_id"), F.col("sample.text_key").alias("_key")
    )
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    texts = keyed.join(
        wanted, (keyed["text_key"] == wanted["_key"]) & keyed["doc_id"].eqNullSafe(wanted["_id"])
    ).select("node", "text")
    sets = written(
        texts.mapInArrow(_sets(shingle), "node binary, shingles binary").dropDuplicates(["node"]), "near-sets"
    )
    led = connected_components(_confirm(_led_pairs(member), sets, percent))
    joined = connected_components(_rest(_placed(member, led), sets, percent))
    found = _placed(nodes.select("node", "least_id"), led).withColumnRenamed("component", "part")
    found = found.join(joined.withColumnRenamed("node", "part"), "part", "left")
    found = found.select("node", "least_id", F.coalesce("component", "part").alias("component"))
    found = written(found, "near-found")
    ids = found.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_node = found.join(ids, "component").select("node", "component", "component_id")
    out = feats.join(by_node, "node", "left").withColumn(
        "component_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    )
    return out.select(
        "doc_id",
        "text_key",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
        "component",
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, per_band: int = 4) -> DataFrame:
    """One document of each group of near-duplicates, with the columns of ``docs``.

    It is the one of the least ``doc_id`` (null last), of several texts under that id the one of
    the least hash. Documents of the empty set stay; of rows that repeat id and text one stays.
    """
    near = near_duplicates(docs, shingle, percent, per_band)
    place = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "text_key")
    one = near.where(F.col("component").isNotNull()).groupBy("component").agg(F.min(place).alias("one"))
    empty = near.where(F.col("component").isNull()).select("doc_id", "text_key").distinct()
    staying = one.select("one.doc_id", "one.text_key").unionByName(empty)
    staying = staying.select(F.col("doc_id").alias("near_id"), F.col("text_key").alias("near_key"))
    # the caller's columns travel as one value, so none of them meets a name used here
    text_key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("id"), text_key.alias("key"))
    kept = rows.join(staying, (F.col("key") == F.col("near_key")) & F.col("id").eqNullSafe(F.col("near_id")))
    return kept.dropDuplicates(["near_id", "near_key"]).select("row.*")


def _led_pairs(member: DataFrame) -> DataFrame:
    """Each node with the leaders of its bands, all leaders at once: a round for each would form
    components again and again, and its many small stages cost more than the pairs it spares."""
    leaders = [F.min_by("node", F.xxhash64("node", F.lit(turn))) for turn in range(LEADER_ROUNDS)]
    led = member.join(member.groupBy("band").agg(F.array_distinct(F.array(*leaders)).alias("leads")), "band")
    pairs = led.select("node", F.explode("leads").alias("lead")).where("node <> lead")
    return pairs.select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b")).distinct()


def _placed(member: DataFrame, component: DataFrame) -> DataFrame:
    """The rows of ``member`` with the component of each node, itself where it has no link."""
    return member.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int, ends: tuple[str, str] = ("a", "b")) -> DataFrame:
    """The pairs of nodes (a, b) that are similar enough, or those two columns of theirs that ``ends`` names."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    near = F.least(F.length("left"), F.length("right")) * 100 >= F.greatest(F.length("left"), F.length("right")) * percent
    return pairs.join(left, "a").join(right, "b").where(near).mapInArrow(_verified(percent, ends), "a binary, b binary")


def _rest(placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a band. Two nodes alone in one were compared as leaders."""
    placed = written(placed.select("band", "node", "component"), "near-placed")
    groups = written(_mixed_groups(placed, "band").where("n_all > 2"), "near-groups")
    spread = _spread(placed, "band", groups.where(F.col("n_all") <= CROWD))
    crowds = groups.where(F.col("n_all") > CROWD).select("band")
    if crowds.isEmpty():
        return _blocks(spread, sets, percent)
    crowded = written(placed.join(crowds, "band", "left_semi").select("node", "component").distinct(), "near-crowded")
    return _crowded_links(crowded, sets, percent, spread)


def _crowded_links(crowded: DataFrame, sets: DataFrame, percent: int, spread: DataFrame | None = None) -> DataFrame:
    """Links between the components of nodes (node, component) of crowded bands, and of the blocks of ``spread``.

    Two sets as similar as a link needs share one of their rarest shingles, so many of each
    as the other may lack and one more. So crowded nodes meet by these instead of by band:
    a passage that all of them hold is no longer what brings them together. Any order of
    shingles will do, so counts in a table of fixed size tell which are rare.
    """
    held = written(sets.join(crowded, "node").select("node", "component", "shingles"), "near-crowded-sets")
    rare = written(_rare_shingles(held, percent), "near-rare")
    groups = written(_mixed_groups(rare, "token"), "near-rare-groups")
    few = rare.join(groups.where(F.col("n_all") <= FEW).select("token"), "token")
    one, other = few.alias("one"), few.alias("other")
    size, other_size = F.col("one.size"), F.col("other.size")
    pairs = (
        one.join(other, "token")
        .where((F.col("one.node") < F.col("other.node")) & (F.col("one.component") != F.col("other.component")))
        .where(F.least(size, other_size) * 100 >= F.greatest(size, other_size) * percent)
        .select(
            F.col("one.node").alias("a"), F.col("other.node").alias("b"),
            F.col("one.component").alias("part"), F.col("other.component").alias("other_part"),
        )
        .distinct()
    )
    links = _confirm(pairs, held.select("node", "shingles"), percent, ("part", "other_part"))
    many = _spread(rare, "token", groups.where(F.col("n_all") > FEW))
    return links.unionByName(_blocks(many if spread is None else spread.unionByName(many), sets, percent))


def _rare_shingles(held: DataFrame, percent: int) -> DataFrame:
    """node, component, size, token for the rarest shingles of each set (node, component, shingles)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            flat = np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)
            total += np.bincount(flat & np.uint64(COUNTERS - 1), minlength=COUNTERS).astype(np.uint32)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    parts = held.select("shingles").mapInArrow(count, "total binary").rdd
    counts = parts.map(lambda r: np.frombuffer(r["total"], np.uint32)).treeReduce(np.add, depth=2)
    shared = held.sparkSession.sparkContext.broadcast(counts)  # COUNTERS numbers

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, tokens = [], [], []
            for i, raw in enumerate(batch.column("shingles").to_pylist()):
                s = np.frombuffer(raw, np.uint64)
                spare = len(s) - -(-percent * len(s) // 100) + 1
                rarest = s[np.lexsort((s, shared.value[s & np.uint64(COUNTERS - 1)]))[:spare]]
                at += [i] * len(rarest)
                sizes += [len(s)] * len(rarest)
                tokens.append(rarest.view(np.int64))
            rows = pa.array(at, pa.int64())
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(rows), batch.column("component").take(rows), pa.array(sizes, pa.int64()), pa.array(flat)],
                ["node", "component", "size", "token"],
            )

    return held.mapInArrow(pick, "node binary, component binary, size bigint, token bigint")


def _mixed_groups(members: DataFrame, key: str) -> DataFrame:
    """The groups of ``members`` (key, node, component) with several components: the largest one,
    the number of nodes outside it and of all."""
    shares = members.groupBy(key, "component").agg(F.count(F.lit(1)).alias("n"))
    groups = shares.groupBy(key).agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        (F.sum("n") - F.max("n")).alias("n_minor"),
        F.sum("n").alias("n_all"),
        F.count(F.lit(1)).alias("parts"),
    )
    return groups.where("parts > 1")


def _spread(members: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """kind, key, i, j, node, component, minor: the blocks (i, j) of a group that a node comes to, with
    every block of its column as a member and, outside the largest component, of its row as a minor."""

    def block(count: Column, size: int) -> Column:
        return F.ceil(count / size).cast("int")

    def places(number: Column, place) -> Column:
        return F.transform(F.sequence(F.lit(0), number - 1), place)

    def at(i: Column, j: Column, minor: bool) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(minor).alias("minor"))

    rows, cols = block(F.col("n_minor"), MINORS), block(F.col("n_all"), MEMBERS)
    h = F.xxhash64("node", F.lit("block"))
    row, col = F.pmod(h, rows).cast("int"), F.pmod(h, cols).cast("int")
    as_member = places(rows, lambda i: at(i, col, False))
    as_minor = F.when(F.col("component") != F.col("main"), places(cols, lambda j: at(row, j, True)))
    held = F.concat(as_member, F.coalesce(as_minor, F.slice(as_member, 1, 0)))
    spread = members.join(groups, key).select(
        F.lit(key).alias("kind"), F.col(key).alias("key"), "node", "component", F.explode(held).alias("at")
    )
    return spread.select("kind", "key", "node", "component", "at.*")


def _blocks(spread: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the components of a group, block by block."""
    return (
        spread.join(sets, "node").groupBy("kind", "key", "i", "j").applyInPandas(_block(percent), "a binary, b binary")
    )


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near-duplicates it belongs to."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key", "component")
