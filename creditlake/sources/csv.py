"""Raw credit-action CSV scan: split-safe, by header, with a report of odd rows.

Every field is read as text (no schema inference over the data), missing-value
tokens become NULL, and each row gets a ``seq`` that reproduces file order:
(file path, block start, row). Files are read in blocks, in parallel, also
where quoted fields hold line ends:

1. One pass counts, for each file, the lines with an odd number of quotes.
   Files without such lines go to Spark's CSV reader, one scan for each
   distinct header, each splittable.
2. For the other files the count is made for each block, and a running parity
   over a file's blocks tells whether a block begins inside a quoted field.
3. A block that begins outside quotes and has no such line holds whole records
   only. The lines of the remaining blocks get a running parity within their
   block, which says where records begin; the lines of a record, which may lie
   in several blocks, are put together again.

Columns are found by the header of the row's own file, so reordered, missing
or additional columns never shift values. A row with fewer or more fields than
its header keeps the fields that both have; ``CsvScan.report`` counts such rows.
Quotes follow RFC 4180: a field with a quote is quoted, and quotes in it are
doubled. A file whose quotes do not pair up as a whole is read line by line and
reported. Blank lines are skipped; line ends inside a field are read as ``\\n``.
"""

from __future__ import annotations

import csv as csv_format
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditlake.functions.text import null_na_tokens
from creditlake.plans.materialize import materialize
from creditlake.schemas import FACT_COLUMNS

READ_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}


@dataclass
class CsvScan:
    """``rows``: the contract's columns as text (+ ``seq``); ``counts``: records and odd rows, by file and scan."""

    rows: DataFrame
    counts: DataFrame

    def report(self) -> DataFrame:
        """Per file: records, short_rows, long_rows, and whether its quotes do not pair up."""
        sums = [F.sum(c).cast("long").alias(c) for c in ("records", "short_rows", "long_rows")]
        return self.counts.groupBy("file").agg(*sums, F.max("unbalanced").alias("unbalanced"))


def counted(lines: DataFrame, record: str, expected: int, headers: int) -> DataFrame:
    """Counts of the records of each file, of which ``headers`` are its header (as wide as expected)."""
    fields = field_count(F.col(record))
    return lines.where(F.length(F.trim(record)) > 0).groupBy("file").agg(
        (F.count(F.lit(1)) - headers).alias("records"),
        F.count_if(fields < expected).alias("short_rows"),
        F.count_if(fields > expected).alias("long_rows"),
        F.max("unbalanced").alias("unbalanced"),
    )


def field_count(record: Column) -> Column:
    """Fields of a record: separators outside quotes, and one."""
    bare = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"(?:[^"]|"")*"', "")).otherwise(record)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.text(files).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        (quotes % 2).alias("odd"),
    )


def block_layout(spark: SparkSession, files: list[str]) -> DataFrame:
    """Step 2, stored: (file, block, first_row, inside, messy, unbalanced), one row a block.

    ``inside``: the block begins inside a quoted field; ``messy``: it may hold
    parts of records that span lines. Blocks and row numbers are those of a scan
    of exactly these files.
    """
    blocks = _lines(spark, files).groupBy("file", "block").agg(
        F.sum("odd").alias("odd_lines"), F.min("row").alias("first_row")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    inside = F.coalesce(F.sum("odd_lines").over(before), F.lit(0)) % 2 == 1
    unbalanced = F.sum("odd_lines").over(whole) % 2 == 1
    placed = blocks.withColumns({"inside": inside, "unbalanced": unbalanced})
    messy = ~F.col("unbalanced") & (F.col("inside") | (F.col("odd_lines") > 0))
    return materialize(placed.select("file", "block", "first_row", "inside", messy.alias("messy"), "unbalanced"), "csv-blocks")


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """Step 3: (file, block, row, record, unbalanced) of files with line ends in fields; headers and blank lines are gone."""
    layout = block_layout(spark, files)
    lines = _lines(spark, files).join(layout, ["file", "block"])
    alone = lines.where(~F.col("messy")).select("file", "block", "row", F.col("value").alias("record"), "unbalanced")
    in_block = Window.partitionBy("file", "block").orderBy("row")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    running = F.col("inside").cast("int") + F.coalesce(F.sum("odd").over(before), F.lit(0))
    tangled = lines.where("messy").withColumn("begins", (running % 2 == 0).cast("long"))
    tangled = tangled.withColumn("nth", F.sum("begins").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    # Records are numbered through a file's blocks, so a block's first lines go to the record left open before it.
    begun = tangled.groupBy("file", "block").agg(F.sum("begins").alias("begun"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = begun.select("file", "block", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("base"))
    part = F.struct("block", "row", "value")
    whole = (
        tangled.join(materialize(numbered, "csv-records"), ["file", "block"])
        .groupBy("file", (F.col("base") + F.col("nth")).alias("number"))
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"),
            F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"),
            F.lit(False).alias("unbalanced"),
        )
    )
    headers = layout.where("block = 0").select("file", "block", F.col("first_row").alias("row"))
    found = alone.unionByName(whole).join(headers, ["file", "block", "row"], "left_anti")
    return found.where(F.length(F.trim("record")) > 0)


def _headers(spark: SparkSession, files: list[str]) -> dict[str, tuple[str, ...]]:
    """Each file's column names, from its first line; a file without lines has none."""

    def first_line(file: str) -> tuple[str, ...]:
        line = spark.read.text(file).limit(1).collect()
        return tuple(c.strip().lstrip("﻿") for c in next(csv_format.reader([line[0]["value"]]))) if line else ()

    with ThreadPoolExecutor(max_workers=16, thread_name_prefix="csv-header") as pool:
        return dict(zip(files, pool.map(first_line, files), strict=True))


def _schema(header: tuple[str, ...]) -> str:
    return ", ".join(f"c{i} string" for i in range(len(header)))


def _picked(header: tuple[str, ...], source: Mapping[int, Column], extra: list[Column]) -> list[Column]:
    """The contract's columns by the header's first occurrence of each name."""
    out = []
    for name in FACT_COLUMNS:
        column = null_na_tokens(source[header.index(name)]) if name in header else F.lit(None).cast("string")
        out.append(column.alias(name))
    return out + extra


def scan_actions(spark: SparkSession, path: str | list[str]) -> CsvScan:
    """All files under ``path`` as raw text rows, with the shapes of their rows."""
    files = sorted(spark.read.text(path).inputFiles())
    headers = {f: h for f, h in _headers(spark, files).items() if h}
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers.items():
        groups.setdefault(header, []).append(file)
    if not groups:
        none = spark.createDataFrame([], ", ".join(f"{c} string" for c in FACT_COLUMNS) + ", seq struct<file:string,block:bigint,row:bigint>")
        return CsvScan(none, spark.createDataFrame([], "file string, records long, short_rows long, long_rows long, unbalanced boolean"))
    with_odd = _lines(spark, list(headers)).where("odd = 1").select("file").distinct()
    odd_files = {_bare(r["file"]) for r in with_odd.collect()}
    rows, counts = [], []
    for header, members in groups.items():
        plain = [f for f in members if _bare(f) not in odd_files]
        tangled = [f for f in members if _bare(f) in odd_files]
        if plain:
            read = spark.read.schema(_schema(header)).options(header=True, enforceSchema=True, **READ_OPTIONS).csv(plain)
            place = F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            )
            rows.append(read.select(*_picked(header, {i: F.col(f"c{i}") for i in range(len(header))}, [place.alias("seq")])))
            lines = _lines(spark, plain).withColumn("unbalanced", F.lit(False))
            counts.append(counted(lines, "value", len(header), 1))
        if tangled:
            found = records(spark, tangled)
            parsed = found.withColumn("parsed", F.from_csv(F.col("record"), F.lit(_schema(header)), READ_OPTIONS))
            values = {i: F.col(f"parsed.c{i}") for i in range(len(header))}
            rows.append(parsed.select(*_picked(header, values, [F.struct("file", "block", "row").alias("seq")])))
            counts.append(counted(found, "record", len(header), 0))
    return CsvScan(reduce(DataFrame.unionByName, rows), reduce(DataFrame.unionByName, counts))


def _bare(path: str) -> str:
    """A path as listed (file:///x) and as ``_metadata`` gives it (file:/x), alike."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path


def read_raw_actions(spark: SparkSession, path: str | list[str], with_seq: bool = True) -> DataFrame:
    """Read action CSV file(s) into the raw text contract (+ ``seq``)."""
    rows = scan_actions(spark, path).rows
    return rows if with_seq else rows.drop("seq")
