"""A Merkle manifest of a table, its proofs by pointer jumping.

Each row is a leaf, the hash of its fields. Per ``lang`` the leaves form a tree in
the order of ``doc_id``, and the roots of these trees form one in the order of
``lang``: two consecutive nodes become the hash of their digests, a last one left
over the hash of its own.

Leaves are numbered without a single sorted task: a range partitioning gives parts,
parts are counted, and a running sum over the counts places them. Aligned runs of
``RUN`` leaves are folded to the top of their subtree at once, and so on with the
tops, so a tree of a billion leaves takes three shuffles.

Proofs: every node holds its sibling, the segment of the path from itself to its
parent. A self-join of the nodes then puts the segment of the ancestor reached
behind a node's own, which doubles the distance, until every leaf reaches the root;
nodes at levels that no later jump can reach are left out. A node high in the tree
is the ancestor of many; it is sent once for each run of its descendants, so no key
of a join has more than ``RUN`` rows.

Defined cases: null fields are hashed as ``-``; null ``lang`` comes first, as a group
of its own, and null ``doc_id`` first within its group; rows that share ``doc_id`` go
by their leaf, and rows that repeat are leaves each; one row or one group is its own
tree; an empty table gives an empty manifest; extra columns are not hashed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshore.llm.common import shuffle_partitions, table, written

RUN_LEVELS = 10  # levels folded by one task
RUN = 1 << RUN_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field as text that no other field can look like."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(row: dict[str, Column]) -> Column:
    return digest(F.concat(*[field(row[c]) for c in FIELDS]))


def tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, the place within the group, and ``n``, its size.

    Rows that are equal in ``group`` and ``order`` are dealt out by a random number.
    """
    n = shuffle_partitions(rows.sparkSession)
    keys = [*group, *order, "_deal"]
    ordered = rows.withColumn("_deal", F.rand(7)).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id()
    placed = ordered.drop("_deal").withColumn("_at", at)
    placed = placed.select("*", F.shiftright("_at", 33).alias("_part"))
    placed = written(placed, "merkle-placed")
    counts = placed.groupBy("_part", *group).agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("_part").alias("_p"),
        *[F.col(g).alias(f"_{g}") for g in group],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
        F.sum("_n").over(whole).alias("n"),
    )
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = placed.join(counts, same)
    return joined.withColumn("idx", F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_p", "_shift", *[f"_{g}" for g in group]
    )


def _halved(digests: Column) -> Column:
    """The next level over an array of digests."""
    pairs = F.sequence(F.lit(0), F.shiftright(F.size(digests) - 1, 1))
    return F.transform(
        pairs, lambda i: digest(F.concat(F.get(digests, i * 2), F.coalesce(F.get(digests, i * 2 + 1), F.lit(""))))
    )


def depth(n: Column) -> Column:
    """Levels above the leaves of a tree of ``n`` leaves."""
    return F.when(n <= 1, F.lit(0)).otherwise(F.length(F.bin(n - 1)))


def _nodes(digests: str, level: int, levels_above: int) -> Column:
    """The nodes of one level of a run."""

    def node(found: Column, i: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"),
            (F.shiftleft("run", levels_above) + i).alias("idx"),
            found.alias("digest"),
            F.get(F.col(digests), i.bitwiseXOR(F.lit(1))).alias("sibling"),
        )

    return F.transform(digests, node)


def tree(leaves: DataFrame, group: list[str]) -> DataFrame:
    """Nodes (group, n, level, idx, digest, sibling) over ``leaves`` (group, n, idx, digest).

    ``sibling`` is the other node of the same run, null where there is none; the root of a
    group is its node at level ``depth(n)``.
    """
    nodes, base, level = [], leaves.select(*group, "n", "idx", "digest"), 0
    while level == 0 or not base.isEmpty():
        runs = base.groupBy(*group, "n", F.shiftright("idx", RUN_LEVELS).alias("run")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"]).alias("l0")
        )
        for k in range(RUN_LEVELS):
            runs = runs.withColumn(f"l{k + 1}", _halved(F.col(f"l{k}")))
        runs = written(runs, "merkle-runs")
        here = [_nodes(f"l{k}", level + k, RUN_LEVELS - k) for k in range(RUN_LEVELS)]
        found = runs.select(*group, "n", F.explode(F.flatten(F.array(*here))).alias("node"))
        nodes.append(found.select(*group, "n", "node.*").where(F.col("level") <= depth(F.col("n"))))
        level += RUN_LEVELS
        base = runs.where(depth(F.col("n")) >= level).select(
            *group, "n", F.col("run").alias("idx"), F.get(f"l{RUN_LEVELS}", F.lit(0)).alias("digest")
        )
    return reduce(DataFrame.unionByName, nodes)


def _step(sibling: Column, idx: Column) -> Column:
    """A step of a path as bytes: where the sibling stands (L, R, or N for none) and its digest."""
    mark = F.when(sibling.isNull(), "N").when(idx.bitwiseAND(F.lit(1)) == 1, "L").otherwise("R")
    return F.concat(mark.cast("binary"), F.unhex(F.coalesce(sibling, F.lit(""))))


def paths(nodes: DataFrame, group: list[str]) -> DataFrame:
    """(group, n, idx, path) of every leaf; ``path`` has a step for each level below the root."""
    steps = nodes.where(F.col("level") <= depth(F.col("n"))).select(
        *group,
        "n",
        "level",
        "idx",
        F.when(F.col("level") < depth(F.col("n")), F.array(_step(F.col("sibling"), F.col("idx"))))
        .otherwise(F.array().cast("array<binary>"))
        .alias("path"),
    )
    steps = written(steps, "merkle-steps")
    deepest = steps.agg(F.max("level")).first()[0] or 0  # one number
    distance = 1
    while distance < deepest:
        steps = written(_jump(steps, group, distance), "merkle-steps")
        distance *= 2
    return steps.where("level = 0").select(*group, "n", "idx", "path")


def _jump(steps: DataFrame, group: list[str], distance: int) -> DataFrame:
    """Paths of twice the ``distance``, of the nodes that later jumps start from or reach.

    An ancestor is sent once for each run of ``RUN`` nodes below it.
    """
    level, idx = F.col("level"), F.col("idx")
    near = steps.where(level % (2 * distance) == 0).withColumn("_run", F.shiftright("idx", RUN_LEVELS))
    far = steps.where(level % (2 * distance) == distance)
    first = F.shiftright(F.shiftleft("idx", distance), RUN_LEVELS)
    last = F.shiftright(F.shiftleft(idx + 1, distance) - 1, RUN_LEVELS)
    end = F.call_function("shiftright", F.col("n") - 1, (level - distance + RUN_LEVELS).cast("int"))
    far = far.select(
        *[F.col(g).alias(f"_{g}") for g in group],
        (level - distance).alias("_level"),
        idx.alias("_idx"),
        F.col("path").alias("_path"),
        F.explode(F.sequence(first, F.least(last, end))).alias("_below"),
    )
    same = (level == F.col("_level")) & (F.shiftright("idx", distance) == F.col("_idx")) & (F.col("_run") == F.col("_below"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    path = F.when(F.col("_path").isNull(), F.col("path")).otherwise(F.concat("path", "_path"))
    return near.join(far, same, "left").select(*group, "n", "level", "idx", path.alias("path"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""

    def up(node: Column, step: Column) -> Column:
        mark, sibling = F.substring(step, 1, 1).cast("string"), F.lower(F.hex(F.substring(step, 2, 32)))
        joined = F.when(mark == "L", F.concat(sibling, node)).when(mark == "R", F.concat(node, sibling)).otherwise(node)
        return digest(joined)

    return F.aggregate(path, leaf, up)


def siblings(path: Column) -> Column:
    """The digests of a path as one text."""
    return F.array_join(F.transform(path, lambda step: F.lower(F.hex(F.substring(step, 2, 32)))), "")


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, digest, tampered_digest of each row; the last is null where nothing is tampered with."""
    row = {c: F.col(c) for c in FIELDS}
    changed = row | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return docs.select(
        "doc_id",
        "lang",
        leaf(row).alias("digest"),
        F.when(tampered(F.col("doc_id")), leaf(changed)).alias("tampered_digest"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, lang, digest, tampered_digest, subroot, root, path of each row of ``docs``.

    ``path`` leads from the leaf over its group's root to the root.
    """
    rows = numbered(written(leaves(docs), "merkle-leaves"), ["lang"], ["doc_id", "digest"])
    rows = written(rows, "merkle-leaves")
    nodes = tree(rows, ["lang"])
    tops = nodes.where(F.col("level") == depth(F.col("n"))).select("lang", F.col("n").alias("size"), "digest")
    tops = written(numbered(written(tops, "merkle-tops"), [], ["lang"]), "merkle-tops")
    top_nodes = tree(tops, [])
    root = top_nodes.where(F.col("level") == depth(F.col("n"))).select(F.col("n").alias("_n"), F.col("digest").alias("root"))
    top_paths = paths(top_nodes, []).select("n", F.col("idx").alias("_idx"), F.col("path").alias("top_path"))
    run = F.explode(F.sequence(F.lit(0), F.shiftright(F.col("size") - 1, RUN_LEVELS)))
    tops = (
        tops.join(top_paths.drop("n"), F.col("idx") == F.col("_idx"))
        .join(root, F.col("n") == F.col("_n"))
        .select(F.col("lang").alias("_lang"), F.col("digest").alias("subroot"), "root", "top_path", run.alias("_run"))
    )
    ways = paths(nodes, ["lang"]).select(F.col("lang").alias("_l"), F.col("idx").alias("_i"), "path")
    return (
        rows.join(ways, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("idx") == F.col("_i")))
        .join(tops, F.col("lang").eqNullSafe(F.col("_lang")) & (F.shiftright("idx", RUN_LEVELS) == F.col("_run")))
        .select(
            "doc_id", "lang", "digest", "tampered_digest", "subroot", "root",
            F.concat("path", "top_path").alias("path"),
        )
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and check after tampering."""
    whole = manifest(table(spark, sf_dir, "documents"))
    folded = fold(F.coalesce("tampered_digest", "digest"), F.col("path"))
    return whole.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        digest(siblings(F.col("path"))).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _leaf_sql(n_chars: str) -> str:
    def text(value: str) -> str:
        return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"

    return "sha256(" + " || ".join(text(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


_CRC_SQL = """xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, x: list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"""

OP13_SQL = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf_sql("n_chars")} AS leaf,
        CASE WHEN {_CRC_SQL} % 7 = 0 THEN {_leaf_sql("(n_chars + 1)")} ELSE {_leaf_sql("n_chars")} END AS shown
    FROM documents),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
        count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
    SELECT lang, 0 AS level, idx, n, leaf AS h FROM placed
    UNION ALL
    SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY lang, level, idx // 2, n),
tops AS (
    SELECT lang, level AS height, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
    FROM nodes WHERE n = 1),
high AS (
    SELECT 0 AS level, idx, n, subroot AS h FROM tops
    UNION ALL
    SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx))
    FROM high WHERE n > 1 GROUP BY level, idx // 2, n),
steps AS (
    SELECT p.doc_id, p.lang, p.idx AS leaf_idx, k.level, (p.idx >> k.level) & 1 AS bit, s.h AS sibling
    FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang
    JOIN (SELECT DISTINCT level FROM nodes) k ON k.level < t.height
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = k.level AND s.idx = xor(p.idx >> k.level, 1)
    UNION ALL
    SELECT p.doc_id, p.lang, p.idx, t.height + k.level, (t.idx >> k.level) & 1, s.h
    FROM placed p JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang
    JOIN (SELECT level FROM high WHERE n > 1 GROUP BY level) k ON true
    LEFT JOIN high s ON s.level = k.level AND s.idx = xor(t.idx >> k.level, 1)),
ways AS (
    SELECT lang, leaf_idx, list({{'bit': bit, 'sibling': sibling}} ORDER BY level) AS way,
        sha256(coalesce(string_agg(sibling, '' ORDER BY level), '')) AS proof_sha256
    FROM steps GROUP BY lang, leaf_idx),
folded AS (
    SELECT p.lang, p.idx, p.shown AS h, coalesce(w.way, []) AS way, 1 AS pos
    FROM placed p LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM p.lang AND w.leaf_idx = p.idx
    UNION ALL
    SELECT lang, idx,
        sha256(CASE WHEN way[pos].sibling IS NULL THEN h WHEN way[pos].bit = 1 THEN way[pos].sibling || h ELSE h || way[pos].sibling END),
        way, pos + 1
    FROM folded WHERE pos <= len(way))
SELECT p.doc_id, p.leaf, t.subroot, r.h AS root, coalesce(w.proof_sha256, sha256('')) AS proof_sha256,
    f.h AS folded_root, f.h = r.h AS verified
FROM placed p
JOIN tops t ON t.lang IS NOT DISTINCT FROM p.lang
JOIN folded f ON f.lang IS NOT DISTINCT FROM p.lang AND f.idx = p.idx AND f.pos = len(f.way) + 1
LEFT JOIN ways w ON w.lang IS NOT DISTINCT FROM p.lang AND w.leaf_idx = p.idx
JOIN (SELECT h FROM high WHERE n = 1) r ON true
"""
