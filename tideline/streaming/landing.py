"""Loading files as they arrive in a landing folder."""

from __future__ import annotations

import re
from contextlib import ExitStack
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.operators.naming import column
from tideline.plans.daily_load import DailyLoad
from tideline.sources.json_events import MALFORMED, SOURCE_FILE

UNITS = ("file", "folder")
# Fixed schema of the binaryFile source; only the path is asked for.
_FILES = "path string, modificationTime timestamp, length long, content binary"
_SEEN = "file string, day date, batch bigint"


def land_stream(
    spark: SparkSession,
    folder: str,
    load: DailyLoad,
    checkpoint: str,
    unit: str = "file",
    pattern: str = "*.json",
    max_files: int | None = 1000,
    continuous: str | None = None,
) -> StreamingQuery:
    """Start a stream that loads every new file, or the folder it arrived in.

    Loading replaces a day whole, so all of a day must be read together. With unit
    ``"file"`` files lie right in ``folder`` and may hold any days: which file holds which
    day is kept beside the checkpoint, and a day is read again from all of its files when
    a new one brings rows of it. That takes one more narrow pass over new files, and files must
    stay where they are. With ``"folder"`` there is a subfolder per day, which is read again as
    a whole whenever a file is added to it. Either way the table does not depend on
    ``max_files``, how many files a batch takes at most. Loads can be repeated, so a batch that
    is replayed after a failure does no harm. Without ``continuous`` (a trigger interval such
    as ``"5 minutes"``) the stream stops once everything there is loaded.

    The stream carries the names of new files only; their contents are read by the load.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    arrivals = (
        spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern)
    )
    if max_files is not None:
        arrivals = arrivals.option("maxFilesPerTrigger", max_files)
    source = folder.rstrip("/") + ("/*" if unit == "folder" else "")
    path = F.col("path") if unit == "file" else F.regexp_replace("path", "/[^/]*$", "")

    def load_new(batch: DataFrame, number: int) -> None:
        # At most max_files names
        units = sorted(r[0] for r in batch.select(path.alias("unit")).distinct().collect())
        if units and unit == "file":
            _load_days_of(load, units, f"{checkpoint.rstrip('/')}/days_of_files", number)
        elif units:
            load.run([_plain(u) for u in units])

    writer = (
        arrivals.load(source)
        .select("path")
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(load_new)
    )
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def _plain(path: str) -> str:
    """A path without meaning to file name patterns."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _load_days_of(load: DailyLoad, files: list[str], seen: str, number: int) -> None:
    """Load the days found in ``files`` from all files that hold rows of them."""
    spark, day = load.spark, column(load.config.day)
    new = load.read([_plain(f) for f in files], SOURCE_FILE)
    found = new.select(F.col(SOURCE_FILE).alias("file"), day.alias("day")).distinct()
    # Written again if the batch is replayed, and before its rows, which later batches rely on.
    found.write.mode("overwrite").parquet(f"{seen}/batch={number}")
    log = spark.read.schema(_SEEN).parquet(seen)
    days = [r.day for r in log.where(F.col("batch") == number).select("day").distinct().collect()]
    earlier = log.where((F.col("batch") < number) & F.col("day").isin([d for d in days if d]))
    # Spark gives the path of a row's file as a URI.
    again = [unquote(r.file) for r in earlier.select("file").distinct().collect()]
    rows = load.read([_plain(f) for f in sorted({*files, *again})])
    # Rows without a day are left in, for the load to refuse.
    taken = day.isin([d for d in days if d]) | day.isNull()
    if MALFORMED in rows.columns:
        # Those of earlier files were stored when these were new.
        fresh = column(SOURCE_FILE).isin([r.file for r in log.where(F.col("batch") == number).select("file").distinct().collect()])
        taken = taken & (column(MALFORMED).isNull() | fresh)
    with ExitStack() as stages:
        load.load(load._once(rows.where(taken), stages))
    if load.schemas:
        load.schemas.release()
