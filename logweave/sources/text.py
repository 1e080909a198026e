"""Text-line sources.

``read_lines`` gives every physical line of one or more text files a stable
1-based ``line_id`` per file, computed in a distributed way: rows are numbered
inside each input split with ``monotonically_increasing_id``, split sizes are
aggregated into a small table (one row per split), turned into running offsets
and joined back. No task ever sees more than its own split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOW_BITS = (1 << 33) - 1  # row index part of monotonically_increasing_id


def number_lines(raw: DataFrame, value_col: str = "value", across_files: bool = False) -> DataFrame:
    """Attach ``file_path`` and a per-file 1-based ``line_id`` to a text scan.

    ``raw`` must come straight from ``spark.read.text`` (the hidden
    ``_metadata`` column and split order are needed). Lines of one split are
    contiguous inside one task, so (split start, row index in split) orders
    lines within a file. With ``across_files`` the files form one log in path
    order (rotated or part files) and numbering continues across them.
    """
    tagged = raw.select(
        F.col(value_col).alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = (tagged.groupBy("file_path", "block_start")
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first_mid")))
    part = [] if across_files else ["file_path"]
    # one row per split, so even the global (across files) window is small
    w = Window.partitionBy(*part).orderBy("file_path", "block_start").rowsBetween(Window.unboundedPreceding, -1)
    # one row per input split: small and bounded by the number of splits
    offsets = splits.withColumn("_offset", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    offsets = offsets.select("file_path", "block_start", "_first_mid", "_offset")
    return (tagged.join(F.broadcast(offsets), ["file_path", "block_start"])
            .select("file_path",
                    (F.col("_offset") + (F.col("_mid") - F.col("_first_mid")) + 1).alias("line_id"),
                    "line"))


def read_lines(spark: SparkSession, paths, log_name: str | None = None, split: str | None = None,
               binary_safe: bool = True, across_files: bool = False, numbered: bool = True) -> DataFrame:
    """Read text logs into ``(log_name, split, file_path, line_id, line, utf8_ok)``.

    Line numbers take a second look at the files (a count per split); without
    ``numbered`` they are left out and ``line_id`` is null.

    With ``binary_safe`` the files are read as bytes per line so that a bad
    UTF-8 byte becomes a reject instead of a silently replaced character (S3).
    """
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.text(paths)
    if numbered:
        out = number_lines(raw, across_files=across_files)
    else:
        out = raw.select(F.col("_metadata.file_path").alias("file_path"), F.lit(None).cast("long").alias("line_id"),
                         F.col("value").alias("line"))
    # the text reader keeps raw bytes; a bad byte is detected, not replaced
    out = out.withColumn("utf8_ok", F.expr("is_valid_utf8(line)") if binary_safe else F.lit(True))
    return out.select(F.lit(log_name).cast("string").alias("log_name"),
                      F.lit(split).cast("string").alias("split"),
                      "file_path", "line_id", "line", "utf8_ok")


def concat_splits(*frames: DataFrame) -> DataFrame:
    """Train lines then test lines; order is carried by ``(split, line_id)``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
