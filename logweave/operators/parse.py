"""Parsing raw log lines into typed rows with explicit rejects.

One narrow projection (whole-stage codegen, no shuffle). Each input line ends
up either in the parsed table or in the rejects table with a reason, so
``parsed + rejects = input`` always holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions import parse as P

REJECT_BAD_UTF8 = "bad_utf8"
REJECT_BLANK = "blank"
REJECT_BAD_TIME = "bad_time"
REJECT_NO_SEPARATOR = "no_separator"


def parse_log(lines: DataFrame, line_col: str = "line", scrub_nul: bool = True,
              split_reason: bool = True) -> DataFrame:
    """Add ``ts, epoch, time_bucket, rest, reason, message, reject_reason``.

    ``lines`` keeps all its columns (``line_id``, ``log_name`` ...). With
    ``split_reason=False`` (mining form) the remainder is the message and no
    separator is required.
    """
    line = F.col(line_col)
    has_utf8 = "utf8_ok" in lines.columns
    tok = P.time_token(line)
    staged = lines.withColumn("_tok", tok)
    ts = P.parse_time(P.scrub_nul(F.col("_tok"), scrub_nul))
    staged = staged.withColumn("ts", ts).withColumn("rest", P.remainder(line, F.col("_tok")))
    reason, message, has_sep = P.split_reason_message(F.col("rest"))
    if not split_reason:
        reason, message, has_sep = F.lit(None).cast("string"), F.col("rest"), F.lit(True)
    reject = (F.when(~F.col("utf8_ok"), F.lit(REJECT_BAD_UTF8)) if has_utf8 else F.when(F.lit(False), F.lit("")))
    reject = (reject.when(line.isNull() | P.is_blank(line), F.lit(REJECT_BLANK))
              .when(F.col("ts").isNull(), F.lit(REJECT_BAD_TIME))
              .when(~has_sep, F.lit(REJECT_NO_SEPARATOR)))
    return (staged
            .withColumn("epoch", P.epoch_seconds(F.col("ts")))
            .withColumn("time_bucket", P.time_bucket(F.col("ts")))
            .withColumn("reason", reason)
            .withColumn("message", message)
            .withColumn("reject_reason", reject)
            .drop("_tok"))


def _filter_barrier(parsed: DataFrame) -> DataFrame:
    """Re-emit ``reject_reason`` through a one-element generator.

    Catalyst pushes filters through projections by inlining the projected
    expressions, which would evaluate the whole parse twice (once in the
    filter, once in the output) and below any repartition. A filter on a
    generator's output stays above it, so the parse runs once.
    """
    return parsed.withColumn("reject_reason", F.explode(F.array(F.col("reject_reason"))))


def parsed_rows(parsed: DataFrame) -> DataFrame:
    return _filter_barrier(parsed).where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_rows(parsed: DataFrame, keys=("line_id",), line_col: str = "line") -> DataFrame:
    return _filter_barrier(parsed).where(F.col("reject_reason").isNotNull()).select(*keys, line_col, "reject_reason")
