"""Shards of near equal size by best-fit-decreasing bin packing.

Documents with equal texts form an indivisible group. Groups sorted by size enter the shard whose
remaining capacity fits them most tightly, found in a balanced tree.

Groups grow in number with the corpus, the packing must not: a group of at least 1/``items`` of all
bytes is an item of its own (there can be no more than ``items`` of them), smaller groups are first
dealt by hash into ``items`` parcels. There are ``PARCELS`` items for each shard that the bytes need, so
a parcel is a small part of a shard, and ``items`` at least. A parcel that comes out larger than the
capacity all the same is not packed as one, its groups are. So about 2 x ``items`` sizes reach the
driver, in proportion to the shards and whatever the number of texts. Everything else is a shuffle of a
narrow table without texts.

Nulls and ties: a null text has no bytes and counts as the empty text (size 1, crc32 0). Repeated
rows are rows like others and stay in their text's group. A null id is an id like another. Equal
sizes are packed in the order of their group keys. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellmart.session import written

ITEMS = 2048
PARCELS = 16  # for each shard, at least
SLOT_ROWS = 4096  # rows numbered in one group of a window


@dataclass
class _Node:
    key: tuple[int, int]  # remaining capacity, shard
    level: int = 1
    left: _Node | None = None
    right: _Node | None = None


class CapacityTree:
    """A balanced (AA) tree of (remaining capacity, shard)."""

    def __init__(self):
        self.root: _Node | None = None

    @staticmethod
    def _skew(node: _Node | None) -> _Node | None:
        if node and node.left and node.left.level == node.level:
            up = node.left
            node.left, up.right = up.right, node
            return up
        return node

    @staticmethod
    def _split(node: _Node | None) -> _Node | None:
        if node and node.right and node.right.right and node.right.right.level == node.level:
            up = node.right
            node.right, up.left = up.left, node
            up.level += 1
            return up
        return node

    def insert(self, key: tuple[int, int]) -> None:
        def into(node):
            if node is None:
                return _Node(key)
            if key < node.key:
                node.left = into(node.left)
            else:
                node.right = into(node.right)
            return self._split(self._skew(node))

        self.root = into(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def out_of(node, key):
            if node is None:
                return None
            if key < node.key:
                node.left = out_of(node.left, key)
            elif key > node.key:
                node.right = out_of(node.right, key)
            elif node.left is None or node.right is None:
                return node.left or node.right
            else:
                least = node.right
                while least.left:
                    least = least.left
                node.key = least.key
                node.right = out_of(node.right, least.key)
            low = min(node.left.level if node.left else 0, node.right.level if node.right else 0) + 1
            if low < node.level:
                node.level = low
                if node.right and node.right.level > low:
                    node.right.level = low
            node = self._skew(node)
            node.right = self._skew(node.right)
            if node.right:
                node.right.right = self._skew(node.right.right)
            node = self._split(node)
            node.right = self._split(node.right)
            return node

        self.root = out_of(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest remaining capacity of at least ``size``."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                best, node = node.key, node.left
            else:
                node = node.right
        return best


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The shard of each size. Shards are opened when nothing fits; larger sizes get one alone."""
    tree, shards, opened = CapacityTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[i])
        if found:
            tree.remove(found)
            room, shard = found
        else:
            room, shard = max(capacity, sizes[i]), opened
            opened += 1
        shards[i] = shard
        tree.insert((room - sizes[i], shard))
    return shards


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """Best-fit-decreasing with the least capacity that needs no more than ``shards`` shards."""
    if not sizes:
        return []
    low, high = max(max(sizes), -(-sum(sizes) // shards)) - 1, max(sizes) + -(-sum(sizes) // shards)
    best = best_fit_decreasing(sizes, high)
    while high - low > max(1, high // 100_000):
        middle = (low + high) // 2
        packed = best_fit_decreasing(sizes, middle)
        if max(packed) < shards:
            best, high = packed, middle
        else:
            low = middle
    return best


def assign(
    docs: DataFrame,
    shards: int | None = 16,
    capacity: int | None = None,
    items: int = ITEMS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in each shard, by id) of every row.

    With ``capacity`` the number of shards of that many bytes is kept small instead of ``shards``
    being filled evenly; a single group beyond the capacity gets a shard alone.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("group"),
    )
    rows = written(rows, "shard-rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    items = max(items, PARCELS * (-(-total // capacity) if capacity else shards))
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    parcel = F.pmod(F.xxhash64("group"), F.lit(items))

    def sizes_with(alone: list[int]):
        """Bytes of each large group and each parcel; groups of the parcels ``alone`` count as large."""
        large = F.col("bytes") * items >= total
        if alone:
            large = large | parcel.isin(alone)
        sized = groups.select(
            "bytes", F.when(large, F.col("group")).alias("large"), F.when(~large, parcel).alias("parcel")
        )
        found = sized.groupBy("large", "parcel").agg(F.sum("bytes").alias("bytes")).collect()
        return sorted(found, key=lambda r: (r.large or b"", -1 if r.parcel is None else r.parcel))

    packing = sizes_with([])
    beyond = [r.parcel for r in packing if capacity and r.large is None and r.bytes > capacity]
    if beyond:
        packing = sizes_with(beyond)
    sizes = [r.bytes for r in packing]
    placed = best_fit_decreasing(sizes, capacity) if capacity else pack_into(sizes, shards)
    large = [(bytes(r.large), s) for r, s in zip(packing, placed, strict=True) if r.large is not None]
    small = [(r.parcel, s) for r, s in zip(packing, placed, strict=True) if r.large is None]
    # Both have about `items` rows at most.
    large = F.broadcast(spark.createDataFrame(large, "`group` BINARY, large_shard INT"))
    small = F.broadcast(spark.createDataFrame(small, "parcel BIGINT, small_shard INT"))
    bucket_count = max(1, -(-count // (SLOT_ROWS * max(1, len(set(placed))))))
    bucketed = (
        rows.withColumn("parcel", parcel)
        .join(large, "group", "left")
        .join(small, "parcel", "left")
        .select(
            "doc_id", "size", "text_crc32", "group",
            F.coalesce("large_shard", "small_shard").alias("shard"),
            F.pmod(F.xxhash64("doc_id"), F.lit(bucket_count)).alias("bucket"),
        )
    )
    counted = bucketed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select(
        "shard", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "group")
    numbered = bucketed.withColumn("number", F.row_number().over(order) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("number")).alias("slot")
    )
