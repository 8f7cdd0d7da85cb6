"""What changed between consecutive full snapshots, by Merkle trees over hash ranges of the keys.

Each snapshot's rows fall into 2**LEAF_BITS leaves by the hash of their key. A leaf's digest covers its
rows, a node's digest its children, the root's the whole snapshot. A snapshot and the one before it are
compared from the root down; rows meet only in leaves whose digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scale import cut

FAN_BITS = 4  # each node has 16 children
LEVELS = 3  # 16 ** 3 leaves
LEAVES = 1 << (FAN_BITS * LEVELS)


def squeezed(text: Column) -> Column:
    """``text`` trimmed with each run of blanks one space; null if nothing is left."""
    t = F.trim(F.regexp_replace(text.cast("string"), r"(?U)[\s ​﻿]+", " "))
    return F.when(t != "", t)


def _digest(*parts: Column) -> list[Column]:
    """Two independent 64-bit digests of a set of rows that are distinct in ``parts``."""
    return [F.bit_xor(F.xxhash64(*parts)).alias("__tm_x"), F.bit_xor(F.xxhash64(F.lit(7919), *parts)).alias("__tm_y")]


def diff_snapshots(rows: DataFrame, pairs: DataFrame, snapshot: str, previous: str, keys: list[str], values: list[str], order: str) -> DataFrame:
    """One row per key that differs: ``snapshot``, the ``keys`` and ``change`` ('added', 'removed', 'changed').

    ``rows`` holds all snapshots: the snapshot's id, keys, values and ``order``; of rows that share a key in
    one snapshot the one lowest in ``order`` counts, of several lowest ones the one whose values hash lowest.
    ``pairs`` has each snapshot to be reported with the one before it (``previous``); each id stands at most
    once on either side. A snapshot in ``pairs`` without rows is an empty one: all rows before it were
    removed. Rows of snapshots that stand on neither side are ignored; a null key is no record; a value
    that is null on either side isn't compared. Other columns of ``rows`` play no part. Values are compared
    by 64-bit hashes.
    """
    k = [f"__tm_k{i}" for i in range(len(keys))]
    named = [F.col(c).alias(a) for c, a in zip(keys, k, strict=True)]
    hashed = [F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c))).alias(f"v{i}") for i, c in enumerate(values)]
    slim = rows.select(F.col(snapshot).alias("__tm_s"), *named, F.struct(F.col(order).alias("o"), *hashed).alias("__tm_r")).dropna(subset=["__tm_s", *k])
    one = slim.groupBy("__tm_s", *k).agg(F.min("__tm_r").alias("__tm_r"))
    leaf = F.pmod(F.xxhash64(*[F.col(c) for c in k]), F.lit(LEAVES)).cast("int")
    one = one.select("__tm_s", *k, leaf.alias("__tm_leaf"), *[F.col(f"__tm_r.v{i}").alias(f"__tm_v{i}") for i in range(len(values))])
    one = cut(one)

    v = [F.col(f"__tm_v{i}") for i in range(len(values))]
    level = one.groupBy("__tm_s", F.col("__tm_leaf").alias("__tm_node")).agg(*_digest(*[F.col(c) for c in k], *v))
    tree = [cut(level)]
    for _ in range(LEVELS):
        child = tree[-1]
        up = child.groupBy("__tm_s", F.shiftright("__tm_node", FAN_BITS).alias("__tm_up")).agg(*_digest(F.col("__tm_node"), F.col("__tm_x"), F.col("__tm_y")))
        tree.append(up.withColumnRenamed("__tm_up", "__tm_node"))

    links = pairs.select(F.col(snapshot).alias("__tm_s"), F.col(previous).alias("__tm_b")).dropna()
    open_nodes = links.withColumn("__tm_node", F.lit(0))
    for depth, nodes in enumerate(reversed(tree)):
        if depth:  # children of the nodes that differ
            fan = F.array(*[F.lit(i) for i in range(1 << FAN_BITS)])
            open_nodes = open_nodes.select("__tm_s", "__tm_b", F.explode(fan).alias("__tm_i"), F.shiftleft("__tm_node", FAN_BITS).alias("__tm_up")).select("__tm_s", "__tm_b", (F.col("__tm_up") + F.col("__tm_i")).alias("__tm_node"))
        new = nodes.select("__tm_s", "__tm_node", F.col("__tm_x").alias("__tm_nx"), F.col("__tm_y").alias("__tm_ny"))
        old = nodes.select(F.col("__tm_s").alias("__tm_b"), "__tm_node", F.col("__tm_x").alias("__tm_ox"), F.col("__tm_y").alias("__tm_oy"))
        met = open_nodes.join(new, ["__tm_s", "__tm_node"], "left").join(old, ["__tm_b", "__tm_node"], "left")
        same = F.col("__tm_nx").eqNullSafe(F.col("__tm_ox")) & F.col("__tm_ny").eqNullSafe(F.col("__tm_oy"))
        open_nodes = met.where(~same).select("__tm_s", "__tm_b", "__tm_node")
    differ = cut(open_nodes.withColumnRenamed("__tm_node", "__tm_leaf"))

    newer = one.join(differ, ["__tm_s", "__tm_leaf"]).withColumn("__tm_new", F.lit(True))
    older = one.withColumnRenamed("__tm_s", "__tm_b").join(differ, ["__tm_b", "__tm_leaf"]).withColumn("__tm_new", F.lit(False))
    both = newer.unionByName(older)
    side = lambda want, c: F.max(F.when(F.col("__tm_new") == F.lit(want), c))
    met = both.groupBy("__tm_s", *k).agg(
        F.max("__tm_new").alias("__tm_in_new"),
        F.min("__tm_new").alias("__tm_not_old"),
        *[side(True, c).alias(f"__tm_n{i}") for i, c in enumerate(v)],
        *[side(False, c).alias(f"__tm_o{i}") for i, c in enumerate(v)],
    )
    changed = F.lit(False)
    for i in range(len(values)):
        changed = changed | F.coalesce(F.col(f"__tm_n{i}") != F.col(f"__tm_o{i}"), F.lit(False))
    what = F.when(~F.col("__tm_in_new"), "removed").when(F.col("__tm_not_old"), "added").when(changed, "changed")
    out = met.withColumn("__tm_what", what).where("__tm_what IS NOT NULL")
    return out.select(F.col("__tm_s").alias(snapshot), *[F.col(a).alias(c) for c, a in zip(keys, k, strict=True)], F.col("__tm_what").alias("change"))
