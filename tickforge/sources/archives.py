"""Spark data source ``trades_archive``: zip and CSV archives as raw trades.

One partition per file (a zip stream cannot be split); rows come as Arrow
batches, each with its place in the file.
"""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tickforge.errors import CorruptedArchiveError
from tickforge.functions.scalar import raw_to_ns
from tickforge.schemas import TICKS
from tickforge.sources.layout import Head, open_csv

_NAMES = ["trade_id", "price", "qty", "quote_qty", "trade_time_raw", "is_buyer_maker"]
_TYPES = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.bool_()]


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, paths: list[str], block: int, most: int | None):
        self.paths, self.block, self.most = paths, block, most

    def partitions(self) -> list[InputPartition]:
        return [_File(p) for p in self.paths]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        path = Path(partition.path)
        with open_csv(path) as f:
            header = Head.of(f).checked(path.name).header
        options = pacsv.ConvertOptions(column_types=dict(zip(_NAMES, _TYPES, strict=True)), true_values=["true", "True", "TRUE", "1"], false_values=["false", "False", "FALSE", "0"], null_values=["", "nan", "NaN", "NAN"], strings_can_be_null=True)
        at = 0
        try:
            with open_csv(path) as f:
                batches = pacsv.open_csv(f, read_options=pacsv.ReadOptions(column_names=_NAMES, skip_rows=int(header), block_size=self.block, use_threads=False), convert_options=options)
                for b in batches:
                    for k in (0, 4, 5):
                        if b.column(k).null_count:
                            raise CorruptedArchiveError(f"{path.name}: a missing {_NAMES[k]}")
                    columns = [c.fill_null(float("nan")) if pa.types.is_floating(c.type) else c for c in b.columns]
                    row = pa.array(range(at, at + b.num_rows), pa.int64())
                    yield pa.RecordBatch.from_arrays([*columns, row, pa.array([path.name] * b.num_rows)], names=[*_NAMES, "source_row", "source_file"])
                    at += b.num_rows
                    if self.most is not None and at >= self.most:
                        return
        except pa.ArrowInvalid as e:
            raise CorruptedArchiveError(f"{path.name}: {e}") from e


class TradesArchive(DataSource):
    """Options: paths (newline-separated), block_bytes, max_rows (about; whole blocks)."""

    @classmethod
    def name(cls) -> str:
        return "trades_archive"

    def schema(self) -> str:
        return "trade_id long, price double, qty double, quote_qty double, trade_time_raw long, is_buyer_maker boolean, source_row long, source_file string"

    def reader(self, schema: StructType) -> DataSourceReader:
        most = self.options.get("max_rows")
        return _Reader([p for p in self.options["paths"].split("\n") if p], int(self.options.get("block_bytes", 16 << 20)), int(most) if most else None)


def read_archives(spark: SparkSession, paths: list[str], symbol: str, max_rows: int | None = None) -> DataFrame:
    """Ticks of archives, with source_row and source_file; nothing is filtered."""
    if not paths:
        raise ValueError("no archive given")
    spark.dataSource.register(TradesArchive)
    source = spark.read.format("trades_archive").option("paths", "\n".join(map(str, paths)))
    raw = (source.option("max_rows", max_rows) if max_rows else source).load()
    columns = {"symbol": F.lit(symbol), "trade_time_ns": raw_to_ns("trade_time_raw")}
    return raw.select(*[columns.get(c, F.col(c)).alias(c) for c in TICKS.names], "source_row", "source_file")
