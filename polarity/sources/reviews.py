"""Review CSVs, submissions and ensemble member files."""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polarity.operators.joins import broadcast_if_small
from polarity.sources.files import exists

SUBMISSION_SCHEMA = "id LONG, sentiment STRING"
# Quoted fields may hold newlines and doubled quotes ("" inside "...").
# Blanks and line breaks at the ends of a quoted field are data: keep them.
# An empty field and a null differ; a row with too many or too few fields fails.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "emptyValue": "", "nullValue": "\\N", "mode": "FAILFAST"}
# names the index column goes by
ID_NAMES = ("id", "", "Unnamed: 0", "_c0")


def read_reviews(spark: SparkSession, path: str, labeled: bool = True) -> DataFrame:
    """(id, review, sentiment) - or (id, review) for a test file, whose
    sentiment column may be present but is ignored.

    Columns are found by header name, in any order; ``review`` (and, if
    ``labeled``, ``sentiment``) must be there, others are left out. The index
    column may be blank-named; without one (the two-column corpus) rows are
    numbered from 0 in file order. An id that is no whole number, or a
    malformed row, fails the job. A CSV file with quoted line breaks is read
    by one task: store the result once (``materialize_once``) before use.
    """
    raw = spark.read.options(**CSV_OPTIONS).csv(path)  # every column a string
    by_name = {c: c for c in raw.columns}
    wanted = ["review", "sentiment"] if labeled else ["review"]
    missing = [c for c in wanted if c not in by_name]
    if missing:
        raise ValueError(f"no column {missing} in {raw.columns}")
    own = next((c for c in ID_NAMES if c in by_name), None)
    cols = [F.col(f"`{c}`").alias(c) for c in wanted]
    if own is None:
        order = ["_f", "_o"]
        rows = raw.select(*cols, F.col("_metadata.file_path").alias("_f"),
                          F.monotonically_increasing_id().alias("_o"))
        from polarity.operators.ordering import ordered_rank
        return ordered_rank(rows, order, rank_col="id").select("id", *wanted)
    number = F.col(f"`{own}`").try_cast("long")
    bad = F.raise_error(F.concat(F.lit("not an id: "), F.coalesce(F.col(f"`{own}`"),
                                                                  F.lit("null"))))
    return raw.select(F.when(number.isNull(), bad).otherwise(number).alias("id"), *cols)


def write_reviews(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write (id, review, sentiment) in the same CSV dialect."""
    (df.select("id", "review", "sentiment").write.mode(mode).options(**CSV_OPTIONS)
     .csv(path))


def write_submission(df: DataFrame, path: str, key: str = "id",
                     mode: str = "errorifexists") -> None:
    """Header + (id, sentiment); a folder of part files. The id is kept
    in every row, so nothing depends on row order."""
    (df.select(F.col(key).alias("id"), "sentiment").write.mode(mode)
     .options(**CSV_OPTIONS).csv(path))


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUBMISSION_SCHEMA).options(**CSV_OPTIONS).csv(path)


def write_members(votes: DataFrame, root: str, key: str = "id", member: str = "member",
                  mode: str = "errorifexists") -> None:
    """Write every member's submission in one job: ``root/member=<name>/``
    part files of (id, sentiment). Partition folders let ``read_members``
    read only the weighted members (partition pruning)."""
    (votes.select(F.col(key).alias("id"), "sentiment", F.col(member).alias("member"))
     .write.mode(mode).partitionBy("member").options(**CSV_OPTIONS).csv(root))


def read_members(spark: SparkSession, root: str, weights: DataFrame,
                 file_name: str = "submission.csv", layout: str = "folders") -> DataFrame:
    """S8 + U1: every member's submission in one scan, tagged with the member
    and its weight: (id, sentiment, member, weight).

    ``folders``: the reference layout ``root/<member>/<file_name>`` (a file,
    or a folder of part files written by ``write_submission``); the member is
    the folder holding ``file_name``. ``partitioned``: ``root/member=<m>/``
    as written by ``write_members``; the member column comes from partition
    discovery and the filter on the weighted members prunes folders.

    Only members listed in ``weights`` are read, and each of them must be
    there: a weighted member without files raises. Member names are the
    driver's list of folders to open (one short string each).
    """
    members = [r["member"] for r in weights.select("member").collect()]
    reader = spark.read.schema(SUBMISSION_SCHEMA).options(**CSV_OPTIONS)
    if layout == "partitioned":
        folders = [f"{root.rstrip('/')}/member={_partition_name(m)}" for m in members]
        _check_members(spark, members, folders)
        df = (spark.read.schema(SUBMISSION_SCHEMA + ", member STRING").options(**CSV_OPTIONS)
              .csv(root).filter(F.col("member").isin(*members)))
    elif layout == "folders":
        paths = [f"{root.rstrip('/')}/{m}/{file_name}" for m in members]
        _check_members(spark, members, paths)
        # the folder right above file_name, whether file_name is the file
        # itself or a folder of part files; the path is URL-encoded
        member_of = F.regexp_extract(F.col("_metadata.file_path"),
                                     "([^/]+)/" + re.escape(quote(file_name)) + "(/[^/]*)?$", 1)
        member_of = F.url_decode(F.replace(member_of, F.lit("+"), F.lit("%2B")))
        # paths are taken as they are, not as patterns
        df = reader.csv([_glob_escape(p) for p in paths]).withColumn("member", member_of)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    return df.join(broadcast_if_small(weights), "member")


def _partition_name(value: str) -> str:
    """How Spark writes a value into a partition folder's name."""
    special = set('"#%\'*/:=?\\\x7f{[]^') | {chr(c) for c in range(1, 32)}
    return "".join(f"%{ord(c):02X}" if c in special else c for c in value)


def _glob_escape(path: str) -> str:
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", path)


def _check_members(spark: SparkSession, members: list[str], paths: list[str]) -> None:
    lost = [m for m, p in zip(members, paths) if not exists(spark, p)]
    if lost:
        raise FileNotFoundError(f"no submission of weighted members {lost}")
