"""Mapping tables from CSV and XLSX, the latter as a data source of its own."""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.mapping import cleaned, issues, missing_columns
from ..operators.ordering import numbered

#: Cells that mean nothing.
NOTHING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(path: str) -> Iterator[list[str | None]]:
    """Cells of a workbook's first sheet, row by row, as text."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        sheet = min(n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n))
        for row in ElementTree.fromstring(z.read(sheet)).iter(f"{{{_NS['m']}}}row"):
            cells: list[str | None] = []
            for c in row.findall("m:c", _NS):
                letters = re.match(r"[A-Z]+", c.get("r", "")) if c.get("r") else None
                at = 0
                for ch in letters[0] if letters else "":
                    at = at * 26 + ord(ch) - 64
                cells += [None] * (at - 1 - len(cells))
                v, kind = c.find("m:v", _NS), c.get("t")
                if kind == "inlineStr":
                    cells.append("".join(t.text or "" for t in c.iter(f"{{{_NS['m']}}}t")))
                elif v is None or v.text is None:
                    cells.append(None)
                else:
                    text = shared[int(v.text)] if kind == "s" else v.text
                    cells.append(text[:-2] if kind is None and re.fullmatch(r"-?\d+\.0", text) else text)
            yield cells


class _Reader(DataSourceReader):
    def __init__(self, options: dict, width: int):
        self.paths = sorted(p for pattern in options["path"].split(",") for p in ([pattern] if os.path.isfile(pattern) else glob.glob(os.path.join(pattern, "*.xlsx"))) if not os.path.basename(p).startswith("~$"))
        self.skip, self.width = int(options.get("skip", 1)), width

    def partitions(self) -> list[InputPartition]:
        return [InputPartition((i, p)) for i, p in enumerate(self.paths)] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value is None:
            return
        number, path = partition.value
        for k, cells in enumerate(sheet_rows(path)):
            if k >= self.skip:
                yield (number * 10_000_000 + k - self.skip, *(cells + [None] * self.width)[: self.width])


class XlsxSource(DataSource):
    """``spark.read.format("xlsx")``: the first sheet of each workbook, all cells as strings, with seq in file and row order.

    Options: path (a file, or a folder of workbooks), skip (rows, 1), columns
    (names separated by commas; else those of the first workbook's first row).
    """

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _columns(self) -> list[str]:
        if self.options.get("columns"):
            return self.options["columns"].split(",")
        first = _Reader(self.options, 0).paths[:1]
        head = next(sheet_rows(first[0]), []) if first else []
        return [c or f"_c{i}" for i, c in enumerate(head)]

    def schema(self) -> str:
        return ", ".join(["seq bigint", *(f"`{c}` string" for c in self._columns())])

    def reader(self, schema) -> _Reader:
        return _Reader(self.options, len(schema.fields) - 1)


def raw_mapping(spark: SparkSession, path: str) -> DataFrame:
    """A mapping file as it is, all strings, with seq from 0."""
    low = path.lower()
    if low.endswith(".xls"):
        raise ValueError(".xls workbooks are not supported; save them as .xlsx")
    if low.endswith(".xlsx"):
        spark.dataSource.register(XlsxSource)
        d = spark.read.format("xlsx").load(path)
    else:
        d = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
        d = numbered(d.withColumn("__at", F.monotonically_increasing_id()), ["__at"], "seq").withColumn("seq", F.col("seq") - 1).drop("__at")
    return d.select("seq", *[F.when(~F.col(f"`{c}`").isin(*NOTHING), F.col(f"`{c}`")).alias(c) for c in d.columns if c != "seq"])


def load_mapping(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows and issues of a mapping file; one that cannot be used has no rows and one issue."""
    nothing = spark.createDataFrame([], "seq long, supplier_sku string, store_article string, suffix string, category string")
    one = lambda message: spark.createDataFrame([(None, "image_read_error", message)], "seq long, flag string, message string")
    try:
        raw = raw_mapping(spark, path)
        lacking = missing_columns(raw.columns)
    except Exception as e:  # noqa: BLE001  whatever makes a file unreadable is an issue, not a failure
        return cleaned(nothing), one(f"Cannot read mapping file: {str(e).splitlines()[0]}")
    if lacking:
        return cleaned(nothing), one(f"Missing required columns: {', '.join(lacking)}")
    rows = cleaned(raw)
    return rows, issues(rows)


def load_masters(spark: SparkSession, folder: str) -> DataFrame:
    """``(sku, article, seq)`` of all master workbooks of a folder: the eighth and ninth column, without headings."""
    spark.dataSource.register(XlsxSource)
    columns = [f"c{i}" for i in range(9)]
    d = spark.read.format("xlsx").option("columns", ",".join(columns)).option("skip", "2").load(folder)
    d = d.select("seq", F.trim("c7").alias("article"), F.trim("c8").alias("sku")).where("article is not null and sku is not null and article <> '' and sku <> '' and article <> 'Artnr'")
    return d
