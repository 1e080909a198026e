"""Shared helpers of the training-data operators.

Conventions used by every operator:

* the operator selects the columns it needs first, or carries the caller's whole
  row as one struct (``packed``), so extra columns, whatever their names, never
  clash with internal ones;
* Arrow batches are kept small (``BATCH_ROWS``) because a row may hold a very
  long text;
* intermediate tables are Parquet under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave import session
from logweave.session import ensure_checkpoint_dir
from logweave.sources.tables import table  # noqa: F401

BATCH_ROWS = 500
# Bytes handled at once by the vectorised byte kernels (about 60 bytes of work memory per byte).
BLOCK_BYTES = 1 << 21
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Small Arrow batches for the query being built; the next one gets the session's own setting back
    (``session.apply_defaults``, which every table access calls)."""
    session.override(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def packed(docs: DataFrame, *keys: Column) -> DataFrame:
    """The caller's rows as one struct ``row``, beside ``keys``; ``select("row.*")`` gives them back."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), *keys)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back (cuts the lineage).

    The shuffle files behind it are of no use any more; Spark deletes them when
    the driver's garbage is collected, which is asked for here, because a long
    job would otherwise keep all of them until its end.
    """
    out = session.materialize(df, name)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def drop_table(df: DataFrame) -> None:
    """Delete a table written by ``materialize`` once nothing reads it any more."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/").split(":")[-1].lstrip("/")
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        if base in f:
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bucket_is(col: str, modulus: int, value: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``, equals ``value``; false for a null id."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % modulus == value, F.lit(False))


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets, without a copy (null: empty)."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type) or pa.types.is_string_view(arr.type):
        arr = arr.cast(pa.string())
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    _, off, data = arr.buffers()
    if n == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(off, np.int32)[arr.offset:arr.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of consecutive texts of at most ``limit`` bytes together (one text at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift) over a uint64 array."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


_RNG = np.random.Generator(np.random.PCG64(20240611))
BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[65:91] = BYTE_CODE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    if n > 1:
        out[1] = np.uint64(base)
        k = 2
        with np.errstate(over="ignore"):
            while k < n:
                m = min(k, n - k)
                out[k:k + m] = out[:m] * np.uint64(pow(base, k, 1 << 64))
                k *= 2
    return out


_CACHE: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_CACHE.get("p", ())) < n:
        size = max(n, 1 << 16)
        _CACHE["p"], _CACHE["i"] = _powers(_BASE, size), _powers(_INV, size)
    return _CACHE["p"], _CACHE["i"]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes (mixed) of ``codes[start:end]`` for each pair; equal spans have equal hashes."""
    p, inv = _power_tables(len(codes) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * p[:len(codes)], out=acc[1:])
        return mix64((acc[ends] - acc[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


# Bits of the table that ``likely_rows`` broadcasts: 1 MB, whatever the input.
LIKELY_BITS = 1 << 23


def likely_rows(rows: DataFrame, key: str, wanted: DataFrame, every: bool = False) -> DataFrame:
    """The rows whose long ``key`` may be among ``wanted``'s values of the same column; with ``every``,
    all rows and a column ``likely``.

    A bitmap of fixed size (256 rows of 4 KB, so safe to broadcast) spares the
    shuffle of most rows that an exact join would drop anyway; that join must
    follow. With more wanted keys than bits nearly all rows pass.
    """
    slot = F.pmod(F.col(key), F.lit(LIKELY_BITS))
    bits = (wanted.select(slot.alias("_slot")).groupBy(F.expr("_slot div 32768").alias("_bucket"))
            .agg(F.expr("bitmap_construct_agg(_slot % 32768)").alias("_bitmap")))
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_slot % 32768 div 8 + 1 as int), 1)")), 16, 10).cast("int")
    found = (rows.withColumn("_slot", slot).withColumn("_bucket", F.expr("_slot div 32768"))
             .join(F.broadcast(bits), "_bucket", "left" if every else "inner").withColumn("_byte", F.coalesce(byte, F.lit(0)))
             .withColumn("likely", F.expr("shiftright(_byte, cast(_slot % 8 as int)) & 1") == 1)
             .drop("_slot", "_bucket", "_bitmap", "_byte"))
    return found if every else found.filter("likely").drop("likely")


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose long ``key`` is not in ``gone`` (a written table with that column); most rows need no shuffle."""
    marked = likely_rows(rows, key, gone, every=True)
    return (marked.filter("not likely").drop("likely")
            .unionByName(marked.filter("likely").drop("likely").join(gone, key, "left_anti")))
