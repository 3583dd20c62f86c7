"""Documents into shards by a tree of weighted hash draws, written as one folder a shard.

A document descends region, rack and shard. At each level every child draws a number from
the md5 digest of its name and the document's key, uniform in (0, 1); the child with the
smallest -ln(draw) / weight wins, so a child wins in proportion to its weight. A child's
draws do not depend on its siblings: a larger weight only pulls documents in, a smaller
one only lets them go. So documents move only from or into subtrees whose weights change.

``grown`` adds a shard in a region of its own. All other weights stay, hence the new shard
takes documents into itself and nothing else moves; shards that join an older rack would
also move documents between that rack and its neighbours.

Slots number the documents of a shard from 0 in the order of key, size and checksum of the
text. Rows are range-partitioned in that order, written, and numbered by the counted rows
of earlier files plus their place in the file: no task ever holds a whole shard, and a
lost task is written again without a change of numbers.

Defined cases: a null key is the empty key, so all its rows share a shard; a null text is
empty; repeated rows get slots of their own, spread over ranges by their place in the
input; an empty table gives no rows; of columns that clash with ``shard``, ``slot`` or
``part`` the operator's stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl.llm.common import only_null_free, parts_of
from trawl.operators.keyed import BROADCAST_ROWS, is_small

# region -> rack -> shard number -> weight
Tree = dict[str, dict[str, dict[int, float]]]

ROWS_PER_PART = 20_000
# Bytes a document takes beside its text.
OVERHEAD = 16
# Hexadecimal digits of the digest that make one draw.
DIGITS = 12


def even_tree(shards: int, regions: int = 5, racks: int = 4) -> Tree:
    """``shards`` of weight 1, numbered from 0, dealt out over racks in turn."""
    tree: Tree = {}
    for shard in range(shards):
        rack = shard % (regions * racks)
        tree.setdefault(f"region{rack % regions}", {}).setdefault(f"rack{rack // regions}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and rack of its own."""
    shard = 1 + max(s for racks in tree.values() for shards in racks.values() for s in shards)
    return tree | {f"region of {shard}": {"rack0": {shard: weight}}}


def levels_of(tree: Tree) -> list[dict[str, list[tuple[str, int, float]]]]:
    """Per level: name of the parent -> (name, shard or -1, weight) of its children."""
    levels: list[dict] = [{"": []}, {}, {}]
    for region, racks in tree.items():
        for rack, shards in racks.items():
            path = f"{region}/{rack}"
            if any(w < 0 for w in shards.values()):
                raise ValueError("weights must not be negative")
            held = [(f"{path}/{s}", s, float(w)) for s, w in shards.items() if w > 0]
            if held:
                levels[2][path] = held
                levels[1].setdefault(region, []).append((path, -1, sum(w for _, _, w in held)))
        if region in levels[1]:
            levels[0][""].append((region, -1, sum(w for _, _, w in levels[1][region])))
    if not levels[0][""]:
        raise ValueError("the tree has no weight")
    return levels


def place(key: Column, tree: Tree) -> Column:
    """The shard of a key. The tree is part of the expression: nothing is joined."""
    key = F.coalesce(key.cast("string"), F.lit(""))

    def drawn(child: Column) -> Column:
        digest = F.md5(F.concat(child["name"], F.lit(":"), key).cast("binary"))
        number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint").cast("double")
        uniform = (number + F.lit(0.5)) / F.lit(float(16**DIGITS))
        return F.struct((-F.ln(uniform) / child["weight"]).alias("draw"), child["name"].alias("name"), child["shard"].alias("shard"))

    parent: Column = F.lit("")
    won = None
    for level in levels_of(tree):
        kids = F.create_map(*[x for name, children in level.items() for x in (F.lit(name), F.array(*[
            F.struct(F.lit(n).alias("name"), F.lit(s).alias("shard"), F.lit(w).alias("weight")) for n, s, w in children
        ]))])
        won = F.array_min(F.transform(F.element_at(kids, parent), drawn))
        parent = won["name"]
    return won["shard"]


def size_of(text: Column) -> Column:
    return F.octet_length(only_null_free(text)).cast("bigint") + OVERHEAD


def checksum_of(text: Column) -> Column:
    return F.crc32(only_null_free(text).cast("binary"))


def write_shards(docs: DataFrame, folder: str, tree: Tree, key: str = "doc_id", text: str = "text") -> T.StructType:
    """Write ``docs`` under ``folder``, one subfolder a shard; the schema to read it by."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("shard", "slot", "part") or c in (key, text)]
    order = ["shard", key, "__size", "__checksum"]
    rows = docs.select(
        *own, place(F.col(key), tree).alias("shard"),
        size_of(F.col(text)).alias("__size"), checksum_of(F.col(text)).alias("__checksum"),
        F.monotonically_increasing_id().alias("__place"),  # only tells equal rows apart
    )
    parts = parts_of(spark, docs.count(), ROWS_PER_PART)
    ranged = rows.repartitionByRange(parts, *order, "__place").sortWithinPartitions(*order)
    out = ranged.select(*own, F.spark_partition_id().alias("part"), "shard")
    out.write.option("compression", "zstd").partitionBy("shard").parquet(folder)
    return out.schema


def read_shards(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The written documents with ``shard`` and ``slot``."""
    files = spark.read.schema(schema).parquet(folder)
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        files.groupBy("shard", "part").agg(F.count("*").alias("rows"))
        .select("shard", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    )
    if is_small(shifts, BROADCAST_ROWS):
        shifts = F.broadcast(shifts)
    rows = files.select("*", F.col("_metadata.row_index").alias("__row"))
    return rows.join(shifts, ["shard", "part"]).withColumn("slot", F.col("__row") + F.col("shift")).drop("part", "shift", "__row")
