"""Files as rows: markup corpora, key lists, digests."""

from __future__ import annotations

import itertools
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variants as V
from ..functions.text import from_code_point
from ..operators.ranking import full_rank
from ..session import work_path

# Lots that are read at a time.
LOTS_AT_ONCE = 4
# The folder of rows without a name, as Spark's own writer calls it.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def write_per_name(rows: DataFrame, path: str) -> None:
    """One text file for each ``name``, in the folder ``name=...`` below ``path``; ``value`` is its text.

    A file takes its time whatever its size, so rows are dealt by name over several times as many tasks as
    there are cores, also those of a table that is read as one piece. In a folder that all executors mount, a task
    writes its files itself: Hadoop's local file system starts a process or more for each folder and file.
    """
    spark = rows.sparkSession
    tasks = 4 * spark.sparkContext.defaultParallelism
    named = rows.select(F.col("name"), F.col("value")).repartition(tasks, "name")
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    scheme = there.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    if scheme != "file":
        named.write.partitionBy("name").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
        return
    folder = there.toUri().getPath()

    def put(batches):
        cells = (zip(b.column("name").to_pylist(), b.column("value").to_pylist()) for b in batches)
        written = 0
        for name, lines in itertools.groupby(itertools.chain.from_iterable(cells), key=lambda cell: cell[0]):
            place = os.path.join(folder, f"name={quote(name, safe='') if name else NO_NAME}")
            os.makedirs(place, exist_ok=True)
            # A second attempt of a task puts the same file in place of the first one's.
            with tempfile.NamedTemporaryFile(dir=place, prefix="_", delete=False) as file:
                for _, line in lines:
                    file.write((line or b"") + b"\n")
            os.chmod(file.name, 0o644)
            os.replace(file.name, os.path.join(place, "part-00000.txt"))
            written += 1
        yield pa.RecordBatch.from_pydict({"written": [written]})

    os.makedirs(folder, exist_ok=True)
    lines = named.withColumn("value", F.col("value").cast("binary")).sortWithinPartitions("name")
    lines.mapInArrow(put, "written bigint").agg(F.sum("written")).collect()


def markup_texts(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``name, svg`` of every file whose path matches; group 1 of the pattern is its name."""
    files = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    found = F.regexp_extract(F.col("_metadata.file_path"), name, 1)
    return files.select(found.alias("name"), F.col("value").alias("svg")).where("name <> ''")


def markup_corpus(spark: SparkSession, path: str, name: str = r"([0-9a-f]{5,6})\.svg$") -> DataFrame:
    """One markup text per key; group 1 of ``name`` is the key's hex code point in the path."""
    texts = markup_texts(spark, path, name)
    return texts.select(from_code_point(F.conv("name", 16, 10)).alias("key"), "svg")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``path, byte_count, sha256`` of every file below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        "path", F.col("length").alias("byte_count"), F.sha2("content", 256).alias("sha256")
    )


def read_listed(spark: SparkSession, names: DataFrame, target: str, at_once: int = 10_000) -> DataFrame:
    """``path, content, byte_count, sha256`` of the files that an inventory names in ``path``, however many there are.

    They are read in lots of ``at_once``, in the order of their paths, and each lot is written below ``target``
    with the digests of the very bytes read. So no folder is listed and the driver holds the names of
    ``LOTS_AT_ONCE`` lots, which are read at a time. A lot that is there already is not read again: a run that was
    lost goes on where it stopped.
    """
    lots = full_rank(names.select("path").distinct(), [], [F.asc("path")]).withColumn("lot", F.floor((F.col("ord") - 1) / at_once))
    # A folder for each lot, so that no lot reads the names of the others.
    listed = work_path(spark, "lots")
    lots.select("path", "lot").write.partitionBy("lot").parquet(listed)
    last = spark.read.schema("path string, lot bigint").parquet(listed).agg(F.max("lot")).first()[0]
    # Names are looked up by as many tasks as there are cores instead of by a task each.
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(spark.sparkContext.defaultParallelism))

    def read_lot(lot: int) -> None:
        if exists(spark, f"{target}/lot={lot}/_SUCCESS"):
            return
        paths = [r["path"] for r in reader.read.schema("path string").parquet(f"{listed}/lot={lot}").orderBy("path").collect()]
        read = reader.read.format("binaryFile").load(paths)
        read.select(
            "path", "content", F.col("length").alias("byte_count"), F.sha2("content", 256).alias("sha256"),
        ).write.mode("overwrite").parquet(f"{target}/lot={lot}")

    with ThreadPoolExecutor(LOTS_AT_ONCE) as pool:
        for _ in pool.map(inheritable_thread_target(spark)(read_lot), range(0 if last is None else last + 1)):
            pass
    kind = "path string, content binary, byte_count bigint, sha256 string"
    return spark.read.schema(kind).parquet(target).drop("lot") if exists(spark, target) else spark.createDataFrame([], kind)


def exists(spark: SparkSession, path: str) -> bool:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there)


def sizes(spark: SparkSession, path: str) -> DataFrame:
    """``path, byte_count`` without reading any content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("byte_count"))


def key_list(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``pos, key`` of JSON arrays of strings, one array per line.

    A document that is no array fails. Items that are no strings or empty drop out;
    ``strict`` fails on them.
    """
    docs = spark.read.text(path).where("value <> ''").select(F.try_parse_json("value").alias("v"))
    return key_items(docs, strict)


def key_items(docs: DataFrame, strict: bool = False) -> DataFrame:
    """As ``key_list``, for documents that are already VARIANTs in ``v``."""
    parsed = F.try_variant_get("v", "$", "array<variant>")
    lists = docs.select(F.coalesce(parsed, F.raise_error(F.lit("key list is not an array"))).alias("items"))
    items = lists.select(F.posexplode("items").alias("pos", "item")).select("pos", V.only_string("item").alias("key"))
    good = F.coalesce(F.col("key") != "", F.lit(False))
    if strict:
        refused = F.raise_error(F.lit("key list holds an item that is no key"))
        return items.select("pos", F.when(good, F.col("key")).otherwise(refused).alias("key"))
    return items.where(good)


def limit_keys(keys: DataFrame, n: int) -> DataFrame:
    """The first ``n`` keys in source order; a top-n, not a global sort."""
    return keys.orderBy("pos").limit(n)
