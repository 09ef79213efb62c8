"""K-d tree sharding: weighted-median cuts along the widest metadata dimension.

Documents are points in four metadata dimensions (size, characters, source, language),
weighted by size (UTF-8 bytes of the text plus 8).  A node that must become k leaves is
cut where its weight reaches floor(k/2)/k, along the dimension in which it is widest, until
every leaf holds the target bytes (the total divided by the number of shards).

All nodes of a level are cut together.  A cut is found by refining histograms: each pass
counts the weight per node in ``BINS`` intervals of the interval found before, until that
interval holds under ``tolerance`` of a leaf, or one key.  Only the counts reach the
driver: at most ``shards * BINS`` rows a pass, whatever the number of documents.  Rows with
equal coordinates are ordered by text and then by document, so that a hot value or a large
group of copies can be cut anywhere.

Null text: 8 bytes.  Null source, language or doc_id: ordinary values.  Identical rows
share a shard.  Empty table: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulseweave.llm.columns import text_or_empty, written

DIMENSIONS = ("size", "chars", "source", "lang")
BINS = 4096
#: Bits of a sort key: coordinate, text, document.
COORDINATE, TEXT, ROW = 24, 18, 20


@dataclass
class Node:
    leaves: int
    first_shard: int
    dimension: str = ""
    cut: int = 0
    children: list[Node] = field(default_factory=list)


def metadata(docs: DataFrame) -> DataFrame:
    """What sharding needs of a document, with the coordinates as non-negative longs."""
    text = text_or_empty()
    size = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.octet_length("text")) + 8
    category = lambda c: F.shiftrightunsigned(F.xxhash64(c), 40)
    return docs.select(
        "doc_id", size.cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.length(text).cast("long").alias("chars"),
        category("source").alias("source"), category("lang").alias("lang"),
        F.xxhash64("doc_id", text).alias("row_hash"))


def with_keys(rows: DataFrame) -> tuple[DataFrame, dict[str, int], int]:
    """Rows with a sort key per dimension (``key_<dimension>``), the keys' ranges, and the
    total weight.  A key is coordinate, text, document from high to low bits; a range
    beyond the coordinate's bits is scaled down."""
    bounds = rows.agg(F.sum("size").alias("total"), *[
        f(d).alias(f"{d}_{n}") for d in DIMENSIONS
        for n, f in (("min", F.min), ("max", F.max))]).first()
    low = {d: bounds[f"{d}_min"] or 0 for d in DIMENSIONS}
    span = {d: (bounds[f"{d}_max"] or 0) - low[d] + 1 for d in DIMENSIONS}
    step = {d: -(-span[d] >> COORDINATE) if span[d] >> COORDINATE else 1 for d in DIMENSIONS}
    text = F.shiftrightunsigned(F.xxhash64("text_crc32"), 64 - TEXT)
    row = F.shiftrightunsigned("row_hash", 64 - ROW)
    tie = F.shiftleft(text, ROW).bitwiseOR(row)
    keyed = rows.select("*", *[
        F.shiftleft(F.call_function("div", F.col(d) - low[d], F.lit(step[d])), TEXT + ROW)
        .bitwiseOR(tie).alias(f"key_{d}") for d in DIMENSIONS])
    ranges = {d: (span[d] // step[d] + 1) << (TEXT + ROW) for d in DIMENSIONS}
    return keyed, ranges, bounds.total or 0


def _node_of(nodes: list[Node], top: Node) -> Column:
    """The index in ``nodes`` of the node that a row has come to, or -1."""
    index = {id(n): i for i, n in enumerate(nodes)}

    def walk(node: Node) -> Column:
        if not node.children:
            return F.lit(index.get(id(node), -1))
        left, right = node.children
        return F.when(F.col(f"key_{node.dimension}") < F.lit(node.cut), walk(left)) \
            .otherwise(walk(right))

    return walk(top)


def build_tree(keyed: DataFrame, ranges: dict[str, int], total: int, shards: int,
               tolerance: float = 0.001) -> Node:
    top = Node(shards, 0)
    while open_nodes := [n for n in _leaves(top) if n.leaves > 1]:
        inside = keyed.withColumn("node", _node_of(open_nodes, top)).filter("node >= 0")
        spread = {r.node: r for r in inside.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[
                (F.max(f"key_{d}") - F.min(f"key_{d}")).alias(d) for d in DIMENSIONS]).collect()}
        for i, node in enumerate(open_nodes):
            # Width is the share of the whole table's range; an empty node keeps any.
            node.dimension = max(DIMENSIONS, key=lambda d: (
                spread[i][d] / ranges[d] if i in spread else 0))
        _find_cuts(inside, open_nodes, ranges, spread, total / shards * tolerance)
        for node in open_nodes:
            k = node.leaves // 2
            node.children = [Node(k, node.first_shard),
                             Node(node.leaves - k, node.first_shard + k)]
    return top


def _find_cuts(inside: DataFrame, nodes: list[Node], ranges: dict[str, int], spread: dict,
               enough: float) -> None:
    """Set the cut of every node by refined histograms of its weight."""
    low = [0] * len(nodes)
    width = [ranges[n.dimension] for n in nodes]
    before = [0] * len(nodes)
    goal = [spread[i].bytes * (n.leaves // 2) / n.leaves if i in spread else 0
            for i, n in enumerate(nodes)]
    of_node = lambda values: F.get(F.array(*[F.lit(v).cast("long") for v in values]),
                                   F.col("node"))
    key = F.get(F.array(*[F.col(f"key_{d}") for d in DIMENSIONS]),
                of_node([DIMENSIONS.index(n.dimension) for n in nodes]).cast("int"))
    keyed = inside.select("node", "size", key.alias("key"))
    left = [i for i in range(len(nodes)) if i in spread]
    while left:
        step = [-(-w // BINS) for w in width]
        ahead = F.col("key") - of_node(low)
        bins: dict[int, list] = {i: [] for i in left}
        for r in (keyed.filter(F.col("node").isin(left) & (ahead >= 0) & (ahead < of_node(width)))
                  .select("node", "size", F.call_function("div", ahead, of_node(step)).alias("bin"))
                  .groupBy("node", "bin").agg(F.sum("size").alias("w"), F.count("*").alias("n"))
                  .collect()):
            bins[r.node].append((r.bin, r.w, r.n))
        again = []
        for i in left:
            total = before[i]
            for b, w, n in sorted(bins[i]):
                if total + w >= goal[i]:
                    break
                total += w
            start = low[i] + b * step[i]
            if step[i] == 1 or n == 1 or w <= enough:
                nearer = goal[i] - total <= total + w - goal[i]
                nodes[i].cut = start if nearer else start + step[i]
            else:
                low[i], width[i], before[i] = start, step[i], total
                again.append(i)
        left = again


def _leaves(top: Node) -> list[Node]:
    return [x for c in top.children for x in _leaves(c)] if top.children else [top]


def shard(spark: SparkSession, docs: DataFrame, shards: int = 24,
          rows_per_block: int = 200_000) -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, shard and its slot in the shard.

    Slots are gapless from 0.  They are numbered in blocks of about ``rows_per_block``
    rows: counts per (shard, block) give each block its first slot, and rows are ordered
    within their block only.
    """
    rows, ranges, total = with_keys(written(spark, metadata(docs), "kd-metadata"))
    rows = written(spark, rows, "kd-keys")
    top = build_tree(rows, ranges, total, shards)
    leaves = _leaves(top)
    index = _node_of(leaves, top)
    blocks = max(8, -(-rows.count() // rows_per_block))
    placed = rows.select(
        "doc_id", "size", "text_crc32", "row_hash", index.alias("leaf"),
        F.pmod(F.col("row_hash"), F.lit(blocks)).alias("block"))
    shard_of = F.element_at(F.array(*[F.lit(n.first_shard) for n in leaves]),
                            F.col("leaf") + 1)
    placed = placed.withColumn("shard", shard_of).drop("leaf")
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    first = counts.select("shard", "block", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("first_slot"))
    inner = F.row_number().over(
        Window.partitionBy("shard", "block").orderBy("row_hash", "doc_id")) - 1
    return (placed.withColumn("inner", inner).join(first, ["shard", "block"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("first_slot") + F.col("inner")).alias("slot")))
