"""Layouts that keep arriving: each micro-batch of whole documents goes through the same plan as a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..plans.engine import Engine, Layout, Result

#: A document as one row: its pages, lines and tables come with it, so a batch never holds half a document.
WHOLE = (
    "doc_id string, path string, source_file string, first_page_text string, pages array<struct<page: int, width: double, height: double>>, "
    f"lines array<struct<seq: int, page: int, text: string, bbox: {S.BBOX}, size: double, bold: boolean, gap_before: double>>, "
    f"detected array<struct<page: int, tbl_no: int, bbox: {S.BBOX}, grid: array<array<string>>, raw_text: string>>"
)


def layout(whole: DataFrame) -> Layout:
    def inner(column: str) -> DataFrame:
        return whole.select("doc_id", F.explode(column).alias("x")).select("doc_id", "x.*")

    return Layout(whole.select("doc_id", "path", "source_file", "first_page_text"), inner("pages"), inner("lines"), inner("detected"))


def parse_stream(spark: SparkSession, path: str, checkpoint: str, handle: Callable[[Result, int], None], profile: str = "cr", registry: DataFrame | None = None, format: str = "parquet") -> StreamingQuery:
    """Parse whole documents (see WHOLE) as files of them arrive in path; handle gets each batch's result and its number.

    A batch may be handled again after a failure; its number tells. Documents need no state from earlier batches.
    """
    stream = spark.readStream.format(format).schema(WHOLE).load(path)

    def batch(whole: DataFrame, number: int) -> None:
        try:
            handle(Engine(spark, profile).parse(layout(whole.persist()), registry), number)
        finally:
            whole.unpersist()

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
