"""A Merkle manifest of a table: one tree per language, and one over the languages' roots.

Each node is the sha256 of the (up to) ``FAN`` nodes below it, as lowercase hex text.  Nodes
are kept in aligned blocks of ``FAN ** LEVELS``: a level of a block is one string of
concatenated digests, parents are digests of its substrings of fixed width, and the
siblings of a node are the substrings on its left and right within its run.  The tops of
the blocks are the nodes of the next round, until a group has one node; the languages'
roots go through the same rounds as one group.  A block has 512 leaves, so that no task
depends on how many rows a language has; rounds grow with the logarithm of the rows.

On the way back every block hands the siblings of its top's path to its nodes, so that a leaf is
joined with its block once and folds its whole path.  No Python worker is used.

Nulls are marked in the leaf; a null language comes first.  Rows with equal doc_id are
ordered by leaf; equal rows have equal leaves, so their order does not show.  A null
doc_id comes first and is not tampered with.  An empty table has no rows and no root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseweave.llm.columns import written
from pulseweave.llm.positions import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN, LEVELS, HEX = 8, 3, 64
BLOCK = FAN ** LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def leaf_of(fields: list[Column]) -> Column:
    """Digest of the fields, each with its length in front, or '-' for null."""
    def marked(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                          F.lit("-"))
    return digest(F.concat(*[marked(f) for f in fields]))


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, leaf, tampered) of every row; ``tampered`` is null where nothing changed.
    ``grp`` names the language and sorts as the language does, null first."""
    plain = [F.col(name) for name in FIELDS]
    changed = plain[:-1] + [F.translate("text", UPPER, LOWER)]
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return docs.select(
        F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("="), "lang")).alias("grp"),
        "doc_id", leaf_of(plain).alias("leaf"), F.when(hit, leaf_of(changed)).alias("tampered"))


def _whole(value: Column, by: int) -> Column:
    """``value`` divided by ``by``, rounded down; both are not negative."""
    return F.floor(value / by).cast("int")


# --- up -------------------------------------------------------------------------------

def _parents(level: Column) -> Column:
    """The next level's string: a digest of every run of ``FAN`` nodes."""
    width = FAN * HEX
    runs = F.ceil(F.length(level) / width).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), runs - 1),
        lambda i: digest(F.substring(level, i * width + 1, F.lit(width)))), "")


def _blocks(nodes: DataFrame, kept: Column) -> DataFrame:
    """Blocks of (grp, position, members, node) with their level strings, their top, and
    ``kept`` of every node in order.  A group of several blocks goes up all levels in
    each, also in the last; a group of one block stops at one node."""
    rows = nodes.groupBy("grp", F.floor(F.col("position") / BLOCK).alias("block")).agg(
        F.first("members").alias("members"),
        F.array_sort(F.collect_list(F.struct("position", "node", kept.alias("kept"))))
        .alias("nodes"))
    rows = rows.select("grp", "block", "members",
                       F.array_join(F.col("nodes.node"), "").alias("l0"),
                       F.col("nodes.kept").alias("kept"))
    for n in range(1, LEVELS + 1):
        below = F.col(f"l{n - 1}")
        # Level n exists if the group has more than FAN ** (n - 1) nodes.
        rows = rows.withColumn(f"l{n}", F.when(F.col("members") > FAN ** (n - 1),
                                               _parents(below)))
    top = F.coalesce(*[F.col(f"l{n}") for n in range(LEVELS, -1, -1)])
    return rows.withColumn("top", top)


def _rounds(spark: SparkSession, nodes: DataFrame, kept: Column, purpose: str) -> list[DataFrame]:
    """The blocks of every round, lowest first, each a written table."""
    rounds = []
    while True:
        blocks = written(spark, _blocks(nodes, kept), f"{purpose}-{len(rounds)}")
        rounds.append(blocks)
        most = blocks.agg(F.max("members")).first()[0] or 0
        if most <= BLOCK:
            return rounds
        kept = F.lit(None).cast("int")
        nodes = blocks.filter(F.col("members") > BLOCK).select(
            "grp", F.col("block").alias("position"),
            F.ceil(F.col("members") / BLOCK).alias("members"), F.col("top").alias("node"))


# --- down -----------------------------------------------------------------------------

def _siblings(slot: Column) -> Column:
    """(left, right) of the node at ``slot`` of its block on each level that has a parent."""
    out = []
    for n in range(LEVELS):
        node = _whole(slot, FAN ** n)
        place = node % FAN
        start = (node - place) * HEX
        flank = F.struct(
            F.substring(F.col(f"l{n}"), start + 1, place * HEX).alias("left"),
            F.substring(F.col(f"l{n}"), start + (place + 1) * HEX + 1,
                        (FAN - 1 - place) * HEX).alias("right"))
        out.append(F.when(F.col(f"l{n + 1}").isNotNull(), flank))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def _nodes(blocks: DataFrame) -> DataFrame:
    """(grp, position, path) of every node of blocks with a ``path``."""
    slots = F.sequence(F.lit(0), _whole(F.length("l0"), HEX) - 1)
    made = F.transform(slots, lambda s: F.struct(
        (F.col("block") * BLOCK + s).alias("position"),
        F.concat(_siblings(s), "path").alias("path")))
    return blocks.select("grp", F.explode(made).alias("x")).select(
        "grp", F.col("x.position").alias("position"), F.col("x.path").alias("path"))


def _fold(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda acc, p: digest(F.concat(p["left"], acc, p["right"])))


PATH = "array<struct<left:string,right:string>>"


def _down(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest blocks with their paths; ``tops`` has the ``path`` of every group's top."""
    above = None
    for n in range(len(rounds) - 1, -1, -1):
        # Groups whose last round this is, and nodes that the round above has handed down.
        ended = rounds[n].filter(F.col("members") <= BLOCK).select("grp", "block").join(
            tops, "grp")
        above = ended if above is None else ended.unionByName(
            above.withColumnRenamed("position", "block"))
        found = rounds[n].join(above, ["grp", "block"])
        if n == 0:
            return found
        above = _nodes(found)


def manifest(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, the siblings' digest, the root folded from the
    (possibly tampered) leaf, and whether it is the root."""
    rows = numbered(spark, leaves(docs), "grp", ["doc_id", "leaf"], "merkle-leaves")
    low = _rounds(spark, rows.withColumnRenamed("leaf", "node"),
                  F.struct("doc_id", "tampered"), "merkle-blocks")
    roots = [r.filter(F.col("members") <= BLOCK).select("grp", F.col("top").alias("node"))
             for r in low]
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.union(more)
    named = written(spark, numbered(spark, subroots.select(F.lit("").alias("all"), "grp", "node"),
                                    "all", ["grp"], "merkle-subroots"), "merkle-numbered")
    high = _rounds(spark, named.select(F.col("all").alias("grp"), "position", "members", "node",
                                       F.col("grp").alias("name")),
                   F.col("name"), "merkle-top")
    last = high[-1].select("top").first()
    root = F.lit(last[0] if last else None).cast("string")
    tree = high[-1].select("grp").distinct().select("grp", F.array().cast(PATH).alias("path"))
    top_paths = _nodes(_down(high, tree)).select("position", "path")
    tops = named.join(top_paths, "position").select("grp", "path", F.col("node").alias("subroot"))
    tops = written(spark, tops, "merkle-paths")
    blocks = _down(low, tops.select("grp", "path")).join(tops.select("grp", "subroot"), "grp")

    slots = F.sequence(F.lit(0), F.size("kept") - 1)

    def result(slot: Column, path: Column) -> Column:
        leaf = F.substring("l0", slot * HEX + 1, F.lit(HEX))
        who = F.get("kept", slot)
        return F.struct(
            who["doc_id"].alias("doc_id"), leaf.alias("leaf"),
            digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))
            .alias("proof_sha256"),
            _fold(F.coalesce(who["tampered"], leaf), path).alias("folded_root"))

    made = F.transform(slots, lambda s: F.get(F.transform(
        F.array(F.concat(_siblings(s), "path")), lambda path: result(s, path)), F.lit(0)))
    return blocks.select("subroot", F.explode(made).alias("x")).select(
        F.col("x.doc_id").alias("doc_id"), F.col("x.leaf").alias("leaf"), "subroot",
        root.alias("root"), F.col("x.proof_sha256").alias("proof_sha256"),
        F.col("x.folded_root").alias("folded_root"),
        (F.col("x.folded_root") == root).alias("verified"))
