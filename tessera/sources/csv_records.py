"""The records of CSV files in file order, read by as many tasks as the files have splits.

A cell may hold line ends, so a split that begins in the middle of a file does not know whether its first line begins a record or is
inside a quoted cell. Lines are therefore read twice. The first reading follows each split from both states, outside and inside a
cell, and tells where each ends and how many records end in it: one small row for each split. Put together in order, these rows give
every split its true state and the number of records before it, so the second reading numbers every record of all files; only records of
several lines are brought together by their number. No task reads more than its split.

Quotes open a cell at its beginning only; a doubled quote inside is a quote; what stands between a closing quote and the next comma belongs to
the cell. Lines end with \\n or \\r\\n. Lines that are empty outside a cell are no records. A quote that no other closes is an error.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.tables import cut

_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELLS = rf'(?:(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+),)*+'
#: Lines that begin outside a cell, or inside one, and end inside.
OPENS = re.compile(rf'{_CELLS}"{_INSIDE}\Z')
STAYS = re.compile(rf'{_INSIDE}(?:\Z|"[^,]*+,{_CELLS}"{_INSIDE}\Z)')


def ends_inside(line: str, inside: bool) -> bool:
    if '"' not in line:
        return inside
    return bool((STAYS if inside else OPENS).match(line))


def is_blank(line: str) -> bool:
    return line in ("", "\r")


class Reading:
    """A split's lines from one state on: the state, and how many records have ended."""

    def __init__(self, inside: bool, ended: int = 0):
        self.inside, self.ended = inside, ended

    def take(self, line: str) -> tuple[bool, bool]:
        """Whether the line is outside a record (blank), and whether it is a whole one."""
        before, self.inside = self.inside, ends_inside(line, self.inside)
        blank = not before and is_blank(line)
        self.ended += not self.inside and not blank
        return blank, not before and not self.inside


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, split (where it begins) and value of each line; lines of a split come in order."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def summaries(lines: DataFrame) -> list[tuple[str, int, bool, bool, int, int]]:
    """file, split, its state at the end and records ended, from either state at the beginning; one for each split (the driver lists these anyway)."""

    def apply(batches):
        place, readings = None, ()
        out: list[tuple] = []

        def rows():
            names = ["file", "split", "out_inside", "in_inside", "out_ended", "in_ended"]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names)

        def close():
            if place:
                out.append((*place, *(r.inside for r in readings), *(r.ended for r in readings)))

        for batch in batches:
            for file, split, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (file, split) != place:
                    close()
                    place, readings = (file, split), (Reading(False), Reading(True))
                for reading in readings:
                    reading.take(value)
        close()
        yield rows()

    found = lines.mapInArrow(apply, "file string, split long, out_inside boolean, in_inside boolean, out_ended long, in_ended long")
    return sorted(map(tuple, found.collect()))


def starts(found: list[tuple[str, int, bool, bool, int, int]]) -> dict[tuple[str, int], tuple[bool, int, int]]:
    """For each split its state, the records of its file ended before it, and those of all files before its file."""
    out, file, inside, ended, before = {}, None, False, 0, 0
    for name, split, out_inside, in_inside, out_ended, in_ended in [*found, (None, 0, False, False, 0, 0)]:
        if name != file:
            if inside:
                raise ValueError(f"{file}: a quoted cell is not closed")
            file, before, inside, ended = name, before + ended, False, 0
        out[name, split] = (inside, ended, before)
        ended += in_ended if inside else out_ended
        inside = in_inside if inside else out_inside
    return out


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, number (in the file, from 1), place (among all records, from 1) and record, the text of each record without its line end."""
    lines = lines_of(spark, path)
    begins = starts(summaries(lines))

    def apply(batches):
        place, reading, before = None, None, 0
        for batch in batches:
            rows: list[tuple] = []
            for file, split, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (file, split) != place:
                    place, at = (file, split), 0
                    inside, ended, before = begins[file, split]
                    reading = Reading(inside, ended)
                at += 1
                blank, whole = reading.take(value)
                if not blank:
                    number = reading.ended + reading.inside
                    rows.append((file, number, before + number, split, at, whole, value))
            names = ["file", "number", "place", "split", "line", "whole", "value"]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    # Splits follow from the session's settings: both readings are done here, under the same ones.
    numbered = cut(lines.mapInArrow(apply, "file string, number long, place long, split long, line long, whole boolean, value string"))
    record = F.regexp_replace("value", r"\r\z", "").alias("record")
    joined = numbered.where("NOT whole").groupBy("file", "number", "place").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "line", "value"))), lambda x: x["value"]), "\n").alias("value"))
    return numbered.where("whole").select("file", "number", "place", record).unionByName(joined.select("file", "number", "place", record))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of CSV files of one header: row_no, from 1 in order of file names and lines, and a text column for each name of the header.

    An empty cell is null, a quoted empty one an empty text; missing cells are null, cells without a name are dropped.
    """
    records = read_records(spark, path)
    heads = records.where("number = 1").select(F.regexp_replace("record", "^﻿", "").alias("record")).distinct().limit(2).collect()
    if len(heads) > 1:
        raise ValueError(f"{path}: the files have several headers")
    options = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "maxCharsPerColumn": "-1"}
    if not heads:
        return spark.createDataFrame([], "row_no long")
    width = heads[0]["record"].count(",") + 1
    wide = ", ".join(f"c{k} string" for k in range(width))
    names = [c for c in spark.createDataFrame(heads).select(F.from_csv("record", wide, options).alias("r")).first()["r"] if c is not None]
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    # Each file before has its header too.
    order = records.where("number = 1").select("file").distinct().collect()  # one for each file
    skipped = F.create_map(*(F.lit(x) for k, f in enumerate(sorted(r["file"] for r in order)) for x in (f, k + 1)))
    cells = records.where("number > 1").select((F.col("place") - skipped[F.col("file")]).alias("row_no"), F.from_csv("record", schema, options).alias("r"))
    return cells.select("row_no", *(F.col(f"r.c{k}").alias(name) for k, name in enumerate(names)))
