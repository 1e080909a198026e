"""n-grams and padding (W2, W3, U6) in two forms.

* array form: a sequence held in one array column (short per-row sequences);
* row form: one row per item with a dense position, possibly one huge
  sequence; built from chunked lag windows, never collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.operators.order import DEFAULT_CHUNK, with_lags


def pad_array(arr: Column, n: int, pad_left: bool = False, pad_right: bool = False,
              left_pad_symbol=None, right_pad_symbol=None) -> Column:
    """``n-1`` pad symbols on either side of an array."""
    parts = []
    if pad_left and n > 1:
        parts.append(F.array_repeat(F.lit(left_pad_symbol).cast("string") if left_pad_symbol is not None
                                    else F.lit(None).cast("string"), n - 1))
    parts.append(arr.cast("array<string>"))
    if pad_right and n > 1:
        parts.append(F.array_repeat(F.lit(right_pad_symbol).cast("string") if right_pad_symbol is not None
                                    else F.lit(None).cast("string"), n - 1))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def array_ngrams(arr: Column, n: int, pad_left: bool = False, pad_right: bool = False,
                 left_pad_symbol=None, right_pad_symbol=None) -> Column:
    """W2 (array form): array of n-grams (each an array); empty when too short."""
    seq = pad_array(arr, n, pad_left, pad_right, left_pad_symbol, right_pad_symbol) \
        if (pad_left or pad_right) else arr
    count = F.greatest(F.size(seq) - n + 1, F.lit(1))
    # a too-short sequence yields one short slice, which the filter drops
    grams = F.transform(F.sequence(F.lit(1), count), lambda i: F.slice(seq, i, n))
    return F.filter(grams, lambda g: F.size(g) == n)


def row_ngrams(df: DataFrame, idx: str, item: str, n: int, groups=(), chunk: int = DEFAULT_CHUNK,
               prefix: str = "g") -> DataFrame:
    """W2 (row form): one row per complete n-gram ending at each position.

    Output keeps all input columns of the last item plus ``g1..gn`` (oldest
    first). Positions ``< n`` in a group have no full history and give none.
    """
    lagged = with_lags(df, idx, item, n - 1, groups=groups, chunk=chunk, suffix="_lag")
    cols = [F.col(f"{item}_lag{n - k}").alias(f"{prefix}{k}") for k in range(1, n)]
    out = lagged.select("*", *cols, F.col(item).alias(f"{prefix}{n}"))
    out = out.drop(*[f"{item}_lag{k}" for k in range(1, n)])
    return out.where(F.col(idx) >= n)


def distinct_ngrams(grams: DataFrame, idx: str, n: int, prefix: str = "g") -> DataFrame:
    """Distinct n-grams with their count and first position (first-seen order)."""
    keys = [f"{prefix}{k}" for k in range(1, n + 1)]
    return grams.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), F.min(idx).alias("first_seen"))


def row_pad(df: DataFrame, idx: str, item: str, n: int, groups=(), pad_left: bool = False,
            pad_right: bool = False, left_pad_symbol=None, right_pad_symbol=None) -> DataFrame:
    """W3 (row form): add ``n-1`` pad rows before / after each group's sequence.

    Returns ``(*groups, idx, item)`` with ``idx`` dense from 1 again. The
    group sizes are one aggregate row per group, joined back (no collect).
    """
    groups = list(groups)
    k = n - 1
    shift = k if pad_left else 0
    body = df.select(*groups, (F.col(idx) + shift).alias(idx), F.col(item).cast("string").alias(item))
    parts = [body]
    if k > 0 and (pad_left or pad_right):
        sizes = df.groupBy(*groups).agg(F.max(idx).alias("_last"))
        if pad_left:
            parts.append(sizes.select(*groups, F.explode(F.sequence(F.lit(1), F.lit(k)).cast("array<long>")).alias(idx),
                                      F.lit(left_pad_symbol).cast("string").alias(item)))
        if pad_right:
            parts.append(sizes.select(*groups, F.explode(F.sequence(F.col("_last") + shift + 1, F.col("_last") + shift + k)
                                                .cast("array<long>")).alias(idx),
                                      F.lit(right_pad_symbol).cast("string").alias(item)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
