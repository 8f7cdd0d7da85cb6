"""Helpers that keep plans safe at any size: guarded broadcast, salted joins, cut lineage, table access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only if a count proves that it has no more rows than this.
BROADCAST_ROWS = 100_000
#: Nor if its rows, written as JSON, have more bytes than this.
BROADCAST_BYTES = 64 << 20
#: Copies of the small side, and parts of each key of the large side, in a salted join.
SALT = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counted(df: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """True if ``df`` has at most ``limit`` rows and BROADCAST_BYTES bytes. Reads no more rows than it must to know."""
    size = F.octet_length(F.to_json(F.struct("*")))
    got = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("bigint")).alias("bytes")).first()
    return got["n"] <= limit and (got["bytes"] or 0) <= BROADCAST_BYTES


def guarded_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", salt_by: str | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join a large side with one that is unique in ``on`` and usually small.

    The small side is counted and weighed. Up to ``limit`` rows and BROADCAST_BYTES it is broadcast, so a hot key of the large side costs
    nothing. Beyond it, each key of the large side is split by a hash of ``salt_by`` (all columns if not
    given) into SALT parts and the small side is repeated SALT times, so no key goes to one task.
    Null keys match nothing (a left join keeps their rows).
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"guarded_join can't do {how}")
    if counted(small, limit):
        return big.join(F.broadcast(small), on, how)
    salt = "__tm_salt"
    by = [F.col(salt_by)] if salt_by else [F.col(c) for c, kind in big.dtypes if not kind.startswith("map")]
    left = big.withColumn(salt, F.pmod(F.xxhash64(*by), F.lit(SALT)).cast("int"))
    right = small.withColumn(salt, F.explode(F.array(*[F.lit(i) for i in range(SALT)])))
    return left.join(right, [*on, salt], how).drop(salt)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names, or one of our own where none is set."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return context._jsc.sc().getCheckpointDir().get()
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        got = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(got)
    return got


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, for a table that several later steps read."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
