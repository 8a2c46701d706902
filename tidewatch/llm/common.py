"""Tables, shared folders and files for the operators of this package."""

from __future__ import annotations

import os
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import work_dir

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, prefix: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs no more than the files it was about to write.
    """
    path = f"{work_dir(df.sparkSession, prefix)}/table"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, prefix: str) -> DataFrame:
    """As ``kept``; the shuffles behind the table go once it is written, as nothing reads them again."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return kept(df, prefix)
    finally:
        conf.set(CLEANUP, before)


HOT_GROUPS = 10_000


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Join every row with its group's row; ``size`` counts the rows of a group, ``total`` all rows.

    Groups of more than total / HOT_GROUPS rows are fewer than HOT_GROUPS, so they can be
    broadcast at any size of the table; in the join of the others no key is large.
    """
    hot = F.col(size) > total // HOT_GROUPS + 1
    large = F.broadcast(groups.where(hot))
    few = rows.join(large.select(*keys), keys, "left_anti").join(groups.where(~hot), keys)
    return rows.join(large, keys).unionByName(few)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias("text")


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder URI; a plain path is a local folder."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def write_whole(uri: str, name: str, chunks) -> int:
    """Write a file in a shared folder so that it appears whole or not at all.

    A task that runs twice replaces the file by the same bytes. Returns the byte count.
    """
    fs, folder = open_store(uri)
    fs.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    size = 0
    with fs.open_output_stream(draft) as out:
        for chunk in chunks:
            out.write(chunk)
            size += len(chunk)
    fs.move(draft, f"{folder}/{name}")
    return size


def open_file(uri: str, name: str):
    fs, folder = open_store(uri)
    return fs.open_input_file(f"{folder}/{name}")


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    """Number of tasks for a stage that is dealt out anew."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def single_threaded() -> None:
    """Tasks already use all cores; libraries inside them must not start threads."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
