"""An inverted index from fragments of three characters to patient ids.

A posting list is (gram, part, ids): the ids of one part that contain the gram.  Ids are
dealt to parts by hash, about ``PART_IDS`` each, so that no list grows with the table even
if every id contains the gram.  Lists are sorted by gram over few files whose row groups are
small: a lookup prunes all row groups but those of its grams by their statistics.

A lookup intersects the lists of all grams of the fragment part by part, and only ids that
contain every gram are compared with the fragment itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pulseweave.functions.text import ngrams

GRAM = 3
PART_IDS = 10_000
ROW_GROUP_BYTES = 1 << 20
#: Pages inside a row group are pruned too, by the file's column index.
PAGE_ROWS = 200
POSTINGS = "gram string, part int, ids array<string>"


def postings(patient_ids: DataFrame, parts: int) -> DataFrame:
    """(gram, part, ids) of distinct ids; a gram as the id has it in lower case."""
    part = F.pmod(F.xxhash64("patient_id"), F.lit(parts)).cast("int").alias("part")
    return (patient_ids.select("patient_id").distinct()
            .select("patient_id", part, F.explode(ngrams(F.col("patient_id"), GRAM, GRAM))
                    .alias("gram"))
            .groupBy("gram", "part").agg(F.sort_array(F.collect_list("patient_id")).alias("ids")))


def build_gram_index(patient_ids: DataFrame, root: str, part_ids: int = PART_IDS,
                     files: int | None = None) -> str:
    """Write the index of a table of ids; returns where.

    ``files`` follows the number of parts by default: a part has some 4,000 grams at most."""
    ids = patient_ids.select("patient_id").distinct()
    parts = max(1, -(-ids.count() // part_ids))
    files = files or max(1, parts // 16)
    path = f"{root.rstrip('/')}/gram_index"
    rows = postings(ids, parts)
    placed = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, "gram", "part")
    (placed.sortWithinPartitions("gram", "part").write
     .option("parquet.block.size", ROW_GROUP_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(path))
    return path


def read_gram_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(path)


def grams_of(fragment: str) -> list[str]:
    return sorted({fragment[i:i + GRAM] for i in range(len(fragment) - GRAM + 1)})


def lookup(index: DataFrame, fragment: str) -> DataFrame:
    """Ids that contain a fragment of three characters or more, taken literally.

    Ids are lower case, so a fragment in upper case finds nothing."""
    wanted = grams_of(fragment)
    if not wanted or fragment != fragment.lower():
        return index.select(F.explode("ids").alias("patient_id")).filter(F.lit(False))
    lists = index.filter(F.col("gram").isin(*wanted))
    if len(wanted) == 1:
        ids = F.col("ids")
        both = lists
    else:
        both = (lists.groupBy("part").agg(F.collect_list("ids").alias("lists"))
                .filter(F.size("lists") == len(wanted)))
        ids = F.aggregate(F.slice("lists", 2, len(wanted)), F.get("lists", F.lit(0)),
                          lambda left, right: F.array_intersect(left, right))
    found = F.filter(ids, lambda x: x.contains(F.lit(fragment)))
    return both.select(F.explode(found).alias("patient_id"))
