"""Queries of the operators for training data over the tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.boilerplate import boilerplate_lines
from tidemark.llm.capping import over_cap
from tidemark.llm.entities import match_entities
from tidemark.llm.language import detect
from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack
from tidemark.llm.places import match_places
from tidemark.llm.tokens import count_tokens
from tidemark.scale import cut, guarded_join, table


def employers(spark: SparkSession, d: str) -> DataFrame:
    """Each registered board's employer: the company of its row with the lowest ordinal, letters and digits only; null if none are left."""
    boards = table(spark, d, "registry").groupBy("platform", "token").agg(F.min_by("company", "ordinal").alias("company"))
    name = F.regexp_replace(F.lower("company"), r"[^\p{L}\p{Nd}]", "")
    return boards.select("platform", "token", F.when(name != "", name).alias("name"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Postings beyond their employer's allowance in their run."""
    rows = table(spark, d, "postings").select("run_id", "ordinal", "platform", "token", "quality").dropDuplicates(["run_id", "ordinal"])
    sizes = rows.groupBy("run_id").agg(F.greatest(F.lit(10), F.expr("count(1) * 3 div 100")).alias("cap"))
    rows = guarded_join(rows, employers(spark, d), ["platform", "token"], "left", "ordinal")
    rows = guarded_join(rows, sizes, ["run_id"], "left", "ordinal")
    board = F.concat_ws("\u0000", F.lit("board"), "platform", "token")
    rows = rows.select("run_id", "ordinal", "quality", "cap", F.coalesce(F.concat(F.lit("name\u0000"), "name"), board).alias("employer"))
    return over_cap(rows, ["run_id", "employer"], "cap", "quality", "ordinal").select("ordinal").distinct()


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Entries of places that each location names, -1 if none."""
    rows = table(spark, d, "postings").select("ordinal", F.trim("location").alias("text")).where("text != ''")
    matched = cut(match_places(rows, "text", table(spark, d, "places")))
    ids = matched.select("text", F.when(F.size("found") > 0, F.col("found")).otherwise(F.array(F.lit(-1))).alias("found"))
    rows = guarded_join(rows, ids, ["text"], "inner", "ordinal")
    return rows.select("ordinal", F.explode("found").alias("place_id")).distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines of descriptions that aren't the role's own text."""
    rows = table(spark, d, "postings").select("ordinal", "description")
    return boilerplate_lines(rows, "description", "ordinal").distinct()


NOTICE = r"(?:©|\(c\)|Copyright)\s*(?:\d{4}\s+)?(\p{Lu}[\p{L}\d&-]*(?: \p{Lu}[\p{L}\d&-]*){0,3})"


def boards(spark: SparkSession, d: str) -> DataFrame:
    """Boards of registry and postings with what is known of their employer: names, hosts, main place."""
    board = ["platform", "token"]
    known = table(spark, d, "registry").groupBy(*board).agg(F.collect_set("company").alias("names"), F.collect_set("evidence").alias("urls"), F.min_by("segment", F.struct(F.col("segment") == "unsorted", "ordinal")).alias("segment"))
    posts = table(spark, d, "postings").select(*board, F.trim("location").alias("text"), F.regexp_extract("description", NOTICE, 1).alias("notice"))
    posts = cut(posts.groupBy(*board, "text", "notice").count())
    notices = posts.where("notice != ''").groupBy(*board, "notice").agg(F.sum("count").alias("n")).groupBy(*board).agg(F.max_by("notice", F.struct("n", "notice")).alias("notice"))
    texts = posts.groupBy(*board, "text").agg(F.sum("count").alias("n"))
    cities = table(spark, d, "companies").select(F.trim("hq_city").alias("text")).union(texts.select("text"))
    placed = cut(match_places(cities, "text", table(spark, d, "places")).select("text", F.explode("found").alias("place")))
    main = guarded_join(texts, placed, ["text"], "inner", "token").groupBy(*board, "place").agg(F.sum("n").alias("n")).groupBy(*board).agg(F.max_by("place", F.struct("n", -F.col("place"))).alias("place"))
    every = posts.select(*board).union(known.select(*board)).distinct().dropna()
    out = every.join(known, board, "left").join(notices, board, "left").join(main, board, "left")
    sep = "\u0000"
    names = F.filter(F.concat(F.coalesce("names", F.array()), F.array("notice")), lambda n: n.isNotNull())
    side_b = out.select(F.lit("b").alias("side"), F.concat_ws(sep, *board).alias("id"), names.alias("names"), "token", "urls", F.col("place").cast("string"), F.col("platform").alias("system"), F.when(F.col("segment") != "unsorted", F.col("segment")).alias("segment"))
    firms = table(spark, d, "companies").withColumn("text", F.trim("hq_city")).join(placed.groupBy("text").agg(F.min("place").alias("place")), "text", "left")
    side_a = firms.select(F.lit("a").alias("side"), F.col("company_id").cast("string").alias("id"), F.array("name").alias("names"), F.lit(None).cast("string").alias("token"), F.array("domain").alias("urls"), F.col("place").cast("string"), F.col("ats").alias("system"), F.when(F.col("segment") != "unsorted", F.col("segment")).alias("segment"))
    return side_a.dropDuplicates(["id"]).unionByName(side_b)


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    """Companies and boards that are the same employer, with the confidence."""
    got = match_entities(boards(spark, d))
    part = F.split("id_b", "\u0000")
    return got.select(F.col("id_a").cast("bigint").alias("company_id"), part[0].alias("platform"), part[1].alias("token"), "confidence").distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Companies and boards that are the same employer."""
    return p6_matches(spark, d).select("company_id", "platform", "token").distinct()


CAPACITY = 2048


def sized(spark: SparkSession, d: str) -> DataFrame:
    """Documents with their sizes in tokens."""
    return count_tokens(table(spark, d, "documents").select("doc_id", "source", "text"), "text").drop("text")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each container's texts and fill: one row per piece of a text."""
    got = pack(sized(spark, d), "doc_id", "n_tokens", CAPACITY, known=True)
    return got.select("container", "doc_id", "piece", "start", F.col("size").alias("n_tokens"), "fill", "known")


def p8_mixed(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the mixture, once per copy."""
    records, _ = mix(sized(spark, d), "doc_id", "source", "n_tokens", table(spark, d, "mix_targets"))
    return records.withColumnRenamed("size", "n_tokens")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Shares that the mixture reaches, beside those wanted."""
    _, report = mix(sized(spark, d), "doc_id", "source", "n_tokens", table(spark, d, "mix_targets"))
    return report.withColumnRenamed("size", "tokens")


def p9_segments(spark: SparkSession, d: str) -> DataFrame:
    """Languages of documents (seg_no 0) and their paragraphs, with confidence."""
    return detect(table(spark, d, "documents").select("doc_id", "text", "lang"), "doc_id", "text", "lang")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose label is missing or wrong, and every paragraph of documents in several languages."""
    got = p9_segments(spark, d).where("lang IS NOT NULL")
    wrong = (F.col("seg_no") == 0) & (F.col("lang") != F.col("label"))
    return got.where(wrong | ((F.col("seg_no") > 0) & F.col("mixed"))).select("doc_id", "seg_no", "lang").distinct()


P4_SQL = r"""
WITH p AS (SELECT DISTINCT run_id, ordinal, platform, token, quality FROM postings),
r AS (SELECT platform, token, arg_min(coalesce(company, ''), ordinal) AS company FROM registry GROUP BY 1, 2),
e AS (SELECT p.*, coalesce('n' || nullif(regexp_replace(lower(company), '[^\p{L}\p{Nd}]', '', 'g'), ''), 'b' || platform || chr(1) || token) AS employer,
  greatest(10, (count(*) OVER (PARTITION BY run_id)) * 3 // 100) AS cap FROM p LEFT JOIN r USING (platform, token))
SELECT DISTINCT ordinal FROM (SELECT ordinal, cap, row_number() OVER (PARTITION BY run_id, employer ORDER BY quality DESC NULLS LAST, ordinal) AS k FROM e) WHERE k > cap
"""

QUERIES = {"p2_found": p2_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p6_matches": p6_matches,
    "p7_containers": p7_containers, "p8_mixed": p8_mixed, "p8_shares": p8_shares, "p9_found": p9_found, "p9_segments": p9_segments}
ORACLES = {"p4_found": P4_SQL}
