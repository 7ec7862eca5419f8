"""Publication statistics from log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The text each counter looks for. A line may count in several.
COUNTERS = {
    "sent": "Transaction successfully sent",
    "publishing": "Publishing route id",
    "with_error": "Error publishing route id",
    "minted": "Token already minted",
    "insufficient_funds": "insufficient funds for gas",
    "handler_crashed": "method handler crashed",
    "nonce_too_low": "nonce too low",
    "underpriced": "replacement transaction underpriced",
}
PARAMETERS = "Parameters:"
DATE_FIELD = 9

# Lines of one stream are read in blocks of this many line numbers.
BLOCK = 100_000


def cut_field(line: Column | str, number: int, delimiter: str = "|") -> Column:
    """One delimited field, or the whole line where there is no delimiter."""
    text = F.col(line) if isinstance(line, str) else line
    found = F.split_part(text, F.lit(delimiter), F.lit(number))
    return F.when(F.contains(text, F.lit(delimiter)), found).otherwise(text)


def word(line: Column | str, number: int) -> Column:
    """The n-th word, words being separated by blanks; empty when there are fewer."""
    words = F.split(F.trim(line), r"\s+")
    return F.coalesce(F.try_element_at(words, F.lit(number)), F.lit(""))


def _dated(lines: DataFrame, stream: str, order: str, line: str, block: Column | None) -> DataFrame:
    """Lines with the last date seen inside their own block; null before the block's first date.

    A block is a range of a stream's lines (the column ``block`` of lines that were read
    from files), so a stream of any length is spread over as many tasks as it has blocks.
    """
    if block is None:
        block = F.col("block") if "block" in lines.columns else F.expr(f"{order} div {BLOCK}")
    mark = F.when(F.contains(F.col(line), F.lit(PARAMETERS)), word(line, DATE_FIELD))
    so_far = Window.partitionBy(stream, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lines.withColumn("_block", block).withColumn("_date", F.last(mark, ignorenulls=True).over(so_far))


def _carry(spans: DataFrame, stream: str) -> DataFrame:
    """Add ``date`` to spans (stream, block, date in block, last line): the block's own date,
    else the one carried over from the spans before it, else empty."""
    earlier = Window.partitionBy(stream).orderBy("_block", "_last").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spans.withColumn("date", F.coalesce(F.last("_date", ignorenulls=True).over(earlier), F.lit("")))


def with_dates(lines: DataFrame, stream: str = "stream", order: str = "line_no", line: str = "line",
               block: Column | None = None) -> DataFrame:
    """Every line with the run date in force; empty before a stream's first one."""
    dated = _dated(lines, stream, order, line, block)
    spans = dated.groupBy(stream, "_block", "_date").agg(F.max(order).alias("_last"))
    starts = _carry(spans, stream).where("_date is null").select(stream, "_block", "date")
    return (
        dated.join(starts, [stream, "_block"], "left")
        .withColumn("date", F.coalesce("_date", "date", F.lit("")))
        .drop("_block", "_date"))


def publish_stats(lines: DataFrame, stream: str = "stream", order: str = "line_no", line: str = "line",
                  block: Column | None = None) -> DataFrame:
    """Counters per run date, for dates with a published route, by date.

    Lines are counted per block and date where they were windowed, without another
    shuffle; only those few counts are carried forward and summed.
    """
    spans = _dated(lines, stream, order, line, block).groupBy(stream, "_block", "_date").agg(
        F.max(order).alias("_last"),
        *[F.count_if(F.contains(F.col(line), F.lit(text))).alias(name) for name, text in COUNTERS.items()])
    total = {name: F.sum(name) for name in COUNTERS}
    return (
        _carry(spans, stream)
        .groupBy("date")
        .agg(
            (total["publishing"] + total["minted"]).alias("routes"),
            (total["sent"] + total["minted"]).alias("published"),
            total["with_error"].alias("with_error"),
            total["minted"].alias("already_minted"),
            total["insufficient_funds"].alias("insufficient_funds"),
            total["handler_crashed"].alias("handler_crashed"),
            total["nonce_too_low"].alias("nonce_too_low"),
            total["underpriced"].alias("underpriced"),
            total["publishing"].alias("_publishing"))
        .where("_publishing > 0").drop("_publishing")
        .orderBy("date"))
