"""Stores on disk: versioned tables that are replaced as a whole, appended reports, recorded answers."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class VersionedTable:
    """A table below ``root``: each write makes new version folders, then a numbered pointer file that names them.

    A pointer is written aside and renamed into place, which is one step; none is ever replaced. Readers
    take the highest pointer that can be read, so a write that fails at any point leaves the table as it
    was, and two writers can't both make the same next pointer. Readers keep the version they opened, so a
    table may be read and rewritten in one plan. With ``buckets`` the rows are spread by a hash of ``by``
    and a write may replace some buckets alone (see replace()).
    """

    KEPT = 3  # pointers that stay behind the newest

    def __init__(self, spark: SparkSession, root: str, by: list[str] | None = None, buckets: int = 1) -> None:
        self.spark, self.root, self.by, self.buckets = spark, root.rstrip("/"), list(by or []), buckets if by else 1

    def _path(self, name: str = ""):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("_pointers")
        if not fs.exists(folder):
            return []
        return sorted((int(n) for f in fs.listStatus(folder) if (n := f.getPath().getName()).isdigit()), reverse=True)

    def pointer(self) -> dict | None:
        """What the highest readable pointer says: ``number``, ``parts`` (bucket to folder), ``note``; None without any."""
        fs = self._fs()
        for number in self._numbers():
            try:
                text = "\n".join(r[0] for r in self.spark.read.text(f"{self.root}/_pointers/{number:012d}").collect())
                got = json.loads(text) | {"number": number}
                if all(fs.exists(self._path(p)) for p in got["parts"].values()):
                    return got
            except (ValueError, KeyError, AttributeError):
                continue
        return None

    def version(self) -> str | None:
        got = self.pointer()
        return None if got is None else str(got["number"])

    def bucket(self) -> Column:
        """The bucket of a row."""
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int") if self.by else F.lit(0)

    def read(self, only: list[int] | None = None) -> DataFrame | None:
        """The current version, or some of its buckets; None if there is none or no pointer can be read."""
        got = self.pointer()
        if got is None:
            return None
        parts = [p for b, p in sorted(got["parts"].items()) if only is None or int(b) in only]
        every = self.spark.read.parquet(*[f"{self.root}/{p}" for p in got["parts"].values()])
        return self.spark.read.schema(every.schema).parquet(*[f"{self.root}/{p}" for p in parts]) if parts else every.limit(0)

    def write(self, df: DataFrame, partition_by: list[str] = (), refuse_empty: bool = False, note: int | None = None) -> str:
        """Write a new version of all rows and point to it. With ``refuse_empty`` an empty table raises and changes nothing."""
        if refuse_empty and df.isEmpty():
            raise ValueError(f"{self.root}: refusing to replace the table by an empty one")
        return self._point(self._files(df, partition_by), note)

    def replace(self, df: DataFrame, touched: list[int], note: int | None = None) -> str:
        """Write ``df``, all rows of the buckets ``touched``, and point to it and the other buckets as they are."""
        old = self.pointer()
        kept = {b: p for b, p in (old["parts"] if old else {}).items() if int(b) not in touched}
        return self._point(kept | self._files(df), note)

    def _files(self, df: DataFrame, partition_by: list[str] = ()) -> dict[str, str]:
        v = f"v-{uuid.uuid4().hex}"
        if self.buckets == 1:
            df.write.partitionBy(*partition_by).parquet(f"{self.root}/{v}")
            return {"0": v}
        # Rows of a bucket stay spread over tasks; each task writes its part of it.
        df.withColumn("__bucket", self.bucket()).write.partitionBy("__bucket").parquet(f"{self.root}/{v}")
        names = [f.getPath().getName() for f in self._fs().listStatus(self._path(v))]
        return {n.split("=")[1]: f"{v}/{n}" for n in names if n.startswith("__bucket=")}

    def _point(self, parts: dict[str, str], note: int | None) -> str:
        fs, numbers = self._fs(), self._numbers()
        number = (numbers[0] if numbers else 0) + 1
        aside, place = self._path(f"_aside/{uuid.uuid4().hex}"), self._path(f"_pointers/{number:012d}")
        fs.mkdirs(self._path("_pointers"))
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps({"parts": parts, "note": note}).encode()))
        out.close()
        if fs.exists(place) or not fs.rename(aside, place):
            raise OSError(f"{self.root}: another writer took version {number}")
        for n in numbers[self.KEPT :]:
            fs.delete(self._path(f"_pointers/{n:012d}"), False)
        return str(number)


def append_report(df: DataFrame, path: str) -> None:
    """Append a run's report as JSON lines."""
    df.write.mode("append").json(path)


def latest_answers(answers: DataFrame, now: float | None = None, max_age: float | None = None) -> DataFrame:
    """The latest recorded answer of each ``digest`` (by ``fetched_at`` seconds), none older than ``max_age`` seconds."""
    if max_age is not None:
        answers = answers.where(F.col("fetched_at") >= F.lit(now) - F.lit(max_age))
    rest = [c for c in answers.columns if c not in ("digest", "fetched_at")]
    got = answers.groupBy("digest").agg(F.max(F.struct("fetched_at", *rest)).alias("a"))
    return got.select("digest", "a.*").select(*answers.columns)


def company_lines(lines: DataFrame) -> DataFrame:
    """Companies of text lines 'name,domain[,segment]': blank lines, comments (#) and lines with one field are skipped."""
    kept = lines.select(F.trim("value").alias("v")).where("v != '' AND NOT startswith(v, '#')")
    f = F.transform(F.split("v", ","), lambda x: F.trim(x))
    return kept.where(F.size(f) >= 2).select(f[0].alias("name"), f[1].alias("domain"), F.coalesce(F.nullif(F.get(f, F.lit(2)), F.lit("")), F.lit("unsorted")).alias("segment"))


def recorded(requests: DataFrame, answers: DataFrame, now: float, max_age: float | None = None, offline: bool = False) -> DataFrame:
    """Requests (``digest``) with the answer that is recorded for each: ``digest``, ``outcome``, ``status``, ``age``, ``text``, ``previous_hash``.

    ``answers``: digest, fetched_at (seconds), record (JSON of status and text). A record that can't be read is none.
    The latest counts. ``outcome`` is 'hit', 'stale' (older than ``max_age`` seconds) or 'miss'; nothing is stale
    ``offline``, and without ``max_age`` nothing is read unless offline, as recording is always done but
    reading must be asked for. ``previous_hash`` is the SHA-256 of the latest text, whatever its age.
    """
    body = F.from_json("record", "status int, text string")
    read = answers.select("digest", "fetched_at", body.alias("r")).where("r.text IS NOT NULL")
    last = read.groupBy("digest").agg(F.max(F.struct("fetched_at", "r")).alias("a"))
    got = requests.select("digest").join(last, "digest", "left")
    age = F.lit(now) - F.col("a.fetched_at")
    usable = F.lit(True) if offline else F.lit(False) if max_age is None else age <= max_age
    outcome = F.when(F.col("a").isNull(), "miss").when(usable, "hit").otherwise("stale" if max_age is not None else "miss")
    told = lambda c: F.when(outcome == "hit", c)
    return got.select("digest", outcome.alias("outcome"), told(F.col("a.r.status")).alias("status"), told(age).alias("age"), told(F.col("a.r.text")).alias("text"), F.sha2("a.r.text", 256).alias("previous_hash"))


def usage(answers: DataFrame, host: str, text: str) -> DataFrame:
    """Recorded answers and their bytes per host, and in all (null host)."""
    return answers.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("answers"), F.sum(F.octet_length(text)).cast("bigint").alias("bytes")).unionByName(
        answers.agg(F.lit(None).cast("string").alias("host"), F.count(F.lit(1)).alias("answers"), F.sum(F.octet_length(text)).cast("bigint").alias("bytes"))
    )


def registry_of(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(registry, page targets) that a resolution of companies leaves: boards that can be read, and the rest with an address.

    ``found``: company, segment, platform, token, readable, careers_url, mechanism, source, evidence. Both replace
    what was there, as a resolution is a current fact; order is that of mechanism, segment and company.
    """
    order = [F.col(c).asc_nulls_last() for c in ("mechanism", "segment", "company")]
    full = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    boards = found.where(full("platform") & full("token") & F.coalesce("readable", F.lit(False)))
    pages = found.where(F.col("mechanism").isin("page", "re_resolve", "unreachable"))
    return boards.orderBy(*order).select("platform", "token", "company", "segment", "source", "evidence"), pages.orderBy(*order)
