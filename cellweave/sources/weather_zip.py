"""Weather archives: zip files with Parquet members below ``year=/month=/day=``.

The work is spread by *member*, not by archive, in runs of about as many bytes each. Tasks
first read the tables of contents; then each member is unpacked once, in a stream, to the
Parquet file it is, and its footer is looked at in that file. What reads the archives reads
these files: Spark splits them, skips the days and row groups that a filter excludes, and
takes the columns a query wants. Neither an archive nor a member is ever held in memory.

Archives are opened with Arrow's file systems, so they may lie on a folder mounted on
every machine or in any store Arrow reaches (``s3``, ``gs``, ``abfss``, ``hdfs``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from cellweave.schemas import DATE_PARTS, WEATHER
from cellweave.session import qualified, shared_folder
from cellweave.sinks import to_be_removed, written
from cellweave.sources import layouts

TASK_BYTES = 128 * 1024 * 1024
_LISTING = "archive string, position int, name string, bytes long"
_COPIES = f"{layouts.LAYOUT}, rows long"
#: The folder text that stands for no key.
_NO_KEY = "__HIVE_DEFAULT_PARTITION__"

Batches = Iterator[pa.RecordBatch]


# Task code is built as closures that import what they need, so that executors can
# run it without this package installed.
def _zip_opener() -> Callable:
    """Opens an archive, given as a URI, until a stack of contexts ends."""

    def opened(archive, at_end):
        import zipfile

        import pyarrow as pa
        from pyarrow import fs

        class Stream:
            """Arrow's file with the error of other files for a place before its start: zipfile
            looks there for more in an archive of few bytes, as one without members is."""

            def __init__(self, file):
                self._file = file

            def __getattr__(self, name):
                return getattr(self._file, name)

            def seek(self, offset, whence=0):
                try:
                    return self._file.seek(offset, whence)
                except pa.ArrowInvalid as error:
                    raise OSError(str(error)) from error

        store, path = fs.FileSystem.from_uri(archive)
        raw = at_end.enter_context(store.open_input_file(path))
        return at_end.enter_context(zipfile.ZipFile(Stream(raw)))

    return opened


def _list_members() -> Callable[[Batches], Batches]:
    open_zip = _zip_opener()

    def run(batches: Batches) -> Batches:
        import contextlib
        import re
        from urllib.parse import quote

        import pyarrow as pa

        for batch in batches:
            for listed in batch.column("path").to_pylist():
                # Spark lists plain text, Arrow wants a URI and its own name for S3.
                archive = quote(re.sub(r"^s3[an]:", "s3:", listed), safe="/:@")
                with contextlib.ExitStack() as at_end:
                    opened = open_zip(archive, at_end)
                    members = [m for m in enumerate(opened.infolist()) if m[1].filename.endswith(".parquet")]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([archive] * len(members), pa.string()),
                            pa.array([position for position, _ in members], pa.int32()),
                            pa.array([info.filename for _, info in members], pa.string()),
                            pa.array([info.file_size for _, info in members], pa.int64()),
                        ],
                        names=["archive", "position", "name", "bytes"],
                    )

    return run


def _opener() -> Callable:
    """Gives (member's description, archive) for rows that come sorted by archive."""
    open_zip = _zip_opener()

    def members(batches):
        import contextlib

        opened = {}  # the archive at hand
        with contextlib.ExitStack() as at_end:
            for row in (row for batch in batches for row in batch.to_pylist()):
                if row["archive"] not in opened:
                    at_end.close()
                    opened = {row["archive"]: open_zip(row["archive"], at_end)}
                archive = opened[row["archive"]]
                yield row, archive, archive.infolist()[row["position"]]

    return members


def _copy_members(target: str) -> Callable[[Batches], Batches]:
    """Each member as it is, at its place below ``target``; its path, layout and rows."""
    members = _opener()

    def run(batches: Batches) -> Batches:
        import uuid

        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(target)
        for row, archive, info in members(batches):
            folder = f"{base}/{row['place']}"
            store.create_dir(folder, recursive=True)
            # Readers pass over names that begin with "_"; only a whole file gets its name.
            draft = f"{folder}/_{uuid.uuid4().hex}"
            try:
                with archive.open(info) as stream, store.open_output_stream(draft) as out:
                    while chunk := stream.read(1 << 20):
                        out.write(chunk)
                with store.open_input_file(draft) as file:
                    whole = pq.ParquetFile(file)
                    rows, columns = whole.metadata.num_rows, whole.schema_arrow
            except BaseException as error:
                store.delete_file(draft)
                if isinstance(error, pa.ArrowInvalid):
                    raise ValueError(f"{info.filename} in {row['archive']}: {error}") from error
                raise
            store.move(draft, f"{folder}/{row['file']}")
            layout = pa.schema([f.remove_metadata() for f in columns]).serialize().to_pybytes()
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [f"{target}/{row['place']}/{row['file']}"],
                    "layout": pa.array([layout], pa.binary()),
                    "rows": pa.array([rows], pa.int64()),
                }
            )

    return run


def members(spark: SparkSession, root: str) -> DataFrame:
    """One row per Parquet member to be read from the archives below ``root``.

    A member counts if its folder holds ``year=``; its place is the folder text after
    the last ``weather/``. Where several archives hold a member of the same name for the
    same place, the one from the last archive (by path) replaces the others.
    """
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    found = archives.mapInArrow(_list_members(), _LISTING)
    folder = F.regexp_extract("name", r"^(.*)/[^/]*$", 1)
    place = F.regexp_replace(folder, r"^.*weather/", "")
    keys = {
        part: F.nullif(F.regexp_extract("place", rf"(?:^|/){part}=([^/]*)", 1), F.lit("")) for part in DATE_PARTS
    }
    last = F.max(F.struct("archive", "position", "name", "bytes")).alias("last")
    return (
        found.filter(F.contains(folder, F.lit("year=")))
        .withColumns({"place": place, "file": F.regexp_extract("name", r"([^/]*)$", 1)})
        .groupBy("place", "file")
        .agg(last)
        .select("last.*", "place", "file")
        .withColumns(keys)
    )


def _dealt(listing: DataFrame, task_bytes: int) -> DataFrame:
    """Members in the order of the archives, cut into runs of about as many bytes, each a
    partition. A member is never split, and large ones do not share a run with many others."""
    spark = listing.sparkSession
    count, size = listing.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    runs = max(1, min(count, max(spark.sparkContext.defaultParallelism, math.ceil((size or 0) / task_bytes))))
    before = Window.orderBy("archive").rowsBetween(Window.unboundedPreceding, -1)
    # One row per archive; the members of each are summed up side by side.
    sizes = listing.groupBy("archive").agg(F.sum(F.col("bytes") + 1).alias("_all"))
    starts = sizes.select("archive", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("archive").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    # A member belongs where its middle lies.
    middle = F.col("_start") + F.sum(F.col("bytes") + 1).over(within) - (F.col("bytes") + 1) / 2
    total = max(1, (size or 0) + count)
    run = F.least(F.floor(middle * runs / total), F.lit(runs - 1)).cast("int")
    return (
        listing.join(starts, "archive")
        .withColumn("_run", run)
        .repartitionById(runs, "_run")
        .sortWithinPartitions("archive", "position")
        .drop("_run", "_start")
    )


def _copied(spark: SparkSession, listing: DataFrame, target: str, task_bytes: int) -> DataFrame:
    """(path, layout, rows) of the files that members are copied to, below ``target``."""
    dealt = _dealt(listing, task_bytes).select("archive", "position", "place", "file")
    return written(dealt.mapInArrow(_copy_members(qualified(spark, target)), _COPIES))


def weather_zip(
    spark: SparkSession,
    root: str,
    schema: StructType | None = None,
    key_type: str = "int",
    task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """All readings in the archives plus ``year``, ``month`` and ``day``.

    Without ``schema`` the columns are those of all members together, each in the widest of
    its types (whole numbers before fractions); a member lacking one has nulls there. Types
    with nothing in common are an error that names a member, and so is a value that does
    not fit into a given ``schema`` (it names the column). ``key_type="string"`` keeps the
    folder text (``01`` rather than 1).

    The members are unpacked to the shared folder when this is called. The files stay as long
    as the result may be read; within a job they go at its end.
    """
    listing = members(spark, root)
    # Members of one day and name from different places are different files.
    days = F.concat_ws("/", *(F.concat(F.lit(f"{part}="), F.coalesce(part, F.lit(_NO_KEY))) for part in DATE_PARTS))
    own = F.concat(F.regexp_replace("file", r"\.parquet$", ""), F.lit("-"), F.hex(F.xxhash64("place")), F.lit(".parquet"))
    listing = listing.withColumns({"file": F.when(F.col("place") == days, F.col("file")).otherwise(own), "place": days})
    spool = to_be_removed(qualified(spark, shared_folder(spark)))
    files = _copied(spark, written(listing), spool, task_bytes)
    keys = StructType([StructField(part, StringType()) for part in DATE_PARTS])
    if schema is None and files.isEmpty():
        schema = WEATHER
    readings = layouts.scan(spark, spool, files, keys, schema)
    if key_type == "string":
        return readings
    return readings.withColumns({part: F.col(part).try_cast(IntegerType()) for part in DATE_PARTS})


def copy_members(spark: SparkSession, root: str, target: str, task_bytes: int = TASK_BYTES) -> int:
    """Members as they are into their folders below ``target``; the number of rows in them.

    What is at the target stays, but for files of the same name in the same folder.
    """
    copied = _copied(spark, written(members(spark, root)), target, task_bytes)
    return copied.agg(F.sum("rows")).first()[0] or 0
