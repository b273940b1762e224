"""Daily integration driven by Structured Streaming (A04 over arriving dumps).

A dump may arrive as any number of part files over any time, so its parts say
nothing about whether it is whole. Its *done file* does: once a day's parts are
there, the sender writes ``dump-YYYY-MM-DD.done``. A file-source stream watches
the done files and integrates each day they name, once, from all its part files,
by :meth:`Store.integrate`; readers never see half a dump as mass deletions. The
stream carries file metadata only (the ``binaryFile`` source with its
``content`` column pruned). Which done files are dealt with is recorded under the
store root, i.e. on shared storage, so a restarted ingestion continues where it
stopped.

A further done file of the newest day (``dump-YYYY-MM-DD.2.done``) integrates it
anew, with whatever parts have arrived or been corrected since. One of an older
day is late: it is inserted between the days it belongs between, or corrects the
day that is there (``late="insert"``), or it stops the stream (``"error"``). No
done file is recorded before its day is read and stored. A done file with no day
in its name stops the stream, and so does a day without part files.
"""

from __future__ import annotations

import datetime as dt
import re
from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.keys import normalize_key
from ..sources.store import Store

# The date inside a file name, and the default file names.
DAY_IN_NAME = r"(\d{4}-\d{2}-\d{2})"
DUMP_FILES = "dump-*.csv"
DONE_FILES = "dump-*.done"
# The binaryFile source's own schema (a stream must state it).
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def done_files(spark: SparkSession, source_dir: str, done_glob: str = DONE_FILES) -> DataFrame:
    """A stream that has a batch whenever done files arrive (no content read)."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", done_glob)
    return files.load(source_dir).select("path")


def read_day(
    spark: SparkSession,
    source_dir: str,
    day: dt.date,
    schema: T.StructType,
    name_glob: str = DUMP_FILES,
    sep: str = ",",
) -> DataFrame:
    """Every dump file of ``day`` in ``source_dir`` as one frame."""
    pattern = f"{source_dir.rstrip('/')}/*{day.isoformat()}*"
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", name_glob)
        .csv(pattern)
    )


def ingest_dumps(
    spark: SparkSession,
    store: Store,
    source_dir: str,
    schema: T.StructType,
    key_aliases=("id",),
    checkpoint: str | None = None,
    available_now: bool = True,
    sep: str = ",",
    name_glob: str = DUMP_FILES,
    done_glob: str = DONE_FILES,
    late: str = "insert",
) -> StreamingQuery:
    """Start the ingestion; ``available_now`` processes what is there and stops."""
    if late not in ("insert", "error"):
        raise ValueError(f"late must be insert or error, not {late!r}")
    key = store.keys[0] if len(store.keys) == 1 else None

    def integrate_batch(batch: DataFrame, epoch_id: int) -> None:
        # Spark's readers leave out empty files, as done files mostly are: the
        # stream says that there are new ones, the folder's listing which.
        handled = set(store.ingested())
        names = [n for n in store.file_names(source_dir) if fnmatch(n, done_glob) and n not in handled]
        found = [(re.search(DAY_IN_NAME, n), n) for n in names]
        unnamed = [n for m, n in found if m is None]
        if unnamed:
            raise ValueError(f"no day (YYYY-MM-DD) in the name of {unnamed}")
        days: dict[dt.date, list[str]] = {}
        for m, n in found:
            days.setdefault(dt.date.fromisoformat(m[1]), []).append(n)
        for day in sorted(days):
            dump = read_day(spark, source_dir, day, schema, name_glob, sep)
            if key:
                dump = normalize_key(dump, key, key_aliases)
            store.integrate(dump, day, late=late)
            for n in days[day]:
                store.record_ingested(n)

    writer = (
        done_files(spark, source_dir, done_glob)
        .writeStream.foreachBatch(integrate_batch)
        .option("checkpointLocation", checkpoint or f"{store.root}/_ingest_checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
