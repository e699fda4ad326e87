"""Event sources: message streams and announced hourly files."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from adstream.functions.jsontext import parse_events
from adstream.session import session_conf

# A message as files carry it: the payload and the time it arrived.
MESSAGE = StructType(
    [StructField("publish_ts", TimestampType()), StructField("value", StringType())]
)

# Plain and Hive-style hour folders: .../20240101/00/ and .../day=20240101/hour=00/
_HOUR_FOLDER = r"^(.*/(?:day=)?([0-9]{8})/(?:hour=)?([0-9]{2}))/[^/]"
# Spark writes local addresses with one slash or with three.
_LOCAL = "^file:/+"
_PARENT = r"^(.*)/[^/]*$"
_ADDRESS = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?(.*)$"


def read_message_stream(
    spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """An unbounded frame of ``publish_ts`` and ``value``, one message a row.

    ``kafka`` takes the broker's timestamp, ``text`` the time a file appeared,
    and the file formats that hold :data:`MESSAGE` rows (``json``, ``parquet``)
    the stored one. Event-time windows are over this arrival time.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load().select(
            F.col("timestamp").alias("publish_ts"), F.col("value").cast("string").alias("value")
        )
    if fmt == "text":
        arrived = F.col("_metadata.file_modification_time").alias("publish_ts")
        return reader.load(path).select(arrived, "value")
    return reader.schema(MESSAGE).load(path)


def hour_folder(df: DataFrame, path_column: str = "path") -> DataFrame:
    """Add the folder of a file, and its day and hour where the layout names them."""
    path = F.col(path_column)
    hourly = F.nullif(F.regexp_extract(path, _HOUR_FOLDER, 1), F.lit(""))
    return (
        df.withColumn("folder_path", F.coalesce(hourly, F.regexp_extract(path, _PARENT, 1)))
        .withColumn("day", F.nullif(F.regexp_extract(path, _HOUR_FOLDER, 2), F.lit("")))
        .withColumn("hour", F.nullif(F.regexp_extract(path, _HOUR_FOLDER, 3), F.lit("")))
    )


def read_event_lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Lines of event files with the folder, day and hour each came from.

    All paths go to one scan, so Spark packs small files together and splits
    large ones whatever the number of folders.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    return hour_folder(lines).drop("path")


def _place(address: str) -> tuple[str, str]:
    """The scheme and host of an address ("" for a bare path) and its path."""
    there, path = re.match(_ADDRESS, address).groups(default="")
    return there if "//" in there or not there else f"{there}//", "/" + path.strip("/")


def owners(files: Iterable[str], announced: Iterable[str]) -> Iterator[tuple[str, str]]:
    """Each file with every announced path that is the file itself or a folder above it.

    A path without a scheme is found under any. A file costs one lookup for each folder above it,
    however many paths are announced.
    """
    known: dict[tuple[str, str], list[str]] = {}
    for path in announced:
        known.setdefault(_place(path), []).append(path)
    hosts_of = {"": ("",)}
    for file in files:
        there, place = _place(unquote(file))
        hosts = hosts_of.setdefault(there, (there, ""))
        while place:
            for host in hosts:
                for path in known.get((host, place), ()):
                    yield file, path
            place = place.rpartition("/")[0]


def listed_sizes(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """``path``, ``files`` and ``bytes`` of announced files and folders, listed and added up in tasks.

    Paths of which nothing is stored are left out; a path that does not exist is an error.
    """
    paths = sorted(set(paths))
    with listing(spark):
        files = spark.read.format("binaryFile").load(paths).select("path", "length")
    rows = [(path, *_place(path)) for path in paths]
    known = spark.createDataFrame(rows, "announced string, host string, place string")
    there, place = F.regexp_extract("path", _ADDRESS, 1), F.regexp_extract("path", _ADDRESS, 2)
    steps = F.split(F.trim(place, F.lit("/")), "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(steps, F.lit(1), n), "/")),
    )
    folders = files.select(there.alias("there"), "length", F.explode(above).alias("place"))
    # "file:/x" and "file:///x" are one address.
    host = F.when(F.col("there").contains("//") | (F.col("there") == ""), F.col("there"))
    host = host.otherwise(F.concat("there", F.lit("//")))
    met = folders.withColumn("there", host).join(known, "place")
    met = met.where((F.col("host") == "") | (F.col("host") == F.col("there")))
    found = met.groupBy("announced").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    return found.withColumnRenamed("announced", "path")


@contextmanager
def listing(spark: SparkSession) -> Iterator[None]:
    """Lists many paths in a few tasks for each core, instead of a task for each path."""
    tasks = str(4 * spark.sparkContext.defaultParallelism)
    with session_conf(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": tasks}):
        yield


def read_announced_lines(
    spark: SparkSession, announced: Mapping[str, tuple], columns: str
) -> DataFrame:
    """Lines of announced files and folders, each with what its notice says.

    ``announced`` maps a path to the values of ``columns`` (a schema). Files are
    told apart by the path that announced them, whatever their layout. One scan
    reads them all; the driver holds their names, so give a bounded number.
    """
    with listing(spark):
        lines = spark.read.text(sorted(announced))
    found = owners(lines.inputFiles(), announced)
    # Both spellings of a name, so that no line's has to be changed.
    rows = [
        (name, *announced[path])
        for file, path in found
        for name in {file, re.sub(_LOCAL, "file:/", file), re.sub(_LOCAL, "file:///", file)}
    ]
    files = spark.createDataFrame(rows, f"_file string, {columns}")
    found = lines.select("value", F.col("_metadata.file_path").alias("_file"))
    # The names are the driver's, so few; lines are decoded in the tasks that read them.
    return found.join(F.broadcast(files), "_file").drop("_file")


def read_batch_events(spark: SparkSession, paths: str | Iterable[str], side: str) -> DataFrame:
    """Decoded events of one side from announced files (globs work too)."""
    return parse_events(read_event_lines(spark, paths), side)
