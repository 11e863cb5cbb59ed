"""Entity lists in; results and unresolved rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.urls import strip
from tessera.operators.entities import normalized_type
from tessera.schemas import NOT_PROCESSED, SUCCESS
from tessera.sources.csv_records import lines_of, read_csv


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """entity_id, name, entity_type and row_no of CSV files with a header (UTF-8, a byte-order mark allowed).

    Blank names are skipped but numbered. Large files are read by many tasks (csv_records); several files count in order of their names.
    """
    rows = read_csv(spark, path)
    names = {c.strip().lower(): c for c in rows.columns if c != "row_no"}
    if "name" not in names:
        raise ValueError(f"{path}: no column `name`")
    cell = lambda name: F.nullif(F.col(f"`{names[name]}`"), F.lit("")) if name in names else F.lit(None).cast("string")
    made = rows.select(
        strip(F.coalesce(cell("id"), cell("entity_id"), F.col("row_no").cast("string"))).alias("entity_id"),
        strip(F.coalesce(cell("name"), F.lit(""))).alias("name"),
        normalized_type(F.coalesce(cell("entity_type"), cell("type"))).alias("entity_type"),
        "row_no",
    )
    return made.where("name <> ''")


def entities_from(rows: DataFrame) -> DataFrame:
    """The same columns from any table with name, entity_type, entity_id and row_no."""
    name = strip(F.coalesce("name", F.lit("")))
    return rows.select(F.col("entity_id").cast("string").alias("entity_id"), name.alias("name"), normalized_type(F.col("entity_type")).alias("entity_type"), "row_no").where("name <> ''")


def output_rows(entities: DataFrame, stored: DataFrame) -> DataFrame:
    """A row for each selected input row, repeats kept: id, name, entity_type, status, attempts, error, result, row_no."""
    rows = entities.join(stored.select("cache_key", "status", "attempts", "last_error", "result"), "cache_key", "left")
    return rows.select(F.col("entity_id").alias("id"), "name", "entity_type", F.coalesce("status", F.lit(NOT_PROCESSED)).alias("status"), F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"), F.col("last_error").alias("error"), "result", "row_no")


def json_line(row: DataFrame) -> Column:
    """The line of a result row: nulls stay at the top and go inside result."""
    head = F.to_json(F.struct("id", "name", "entity_type", "status", "attempts", "error"), {"ignoreNullFields": "false"})
    result = F.coalesce(F.to_json("result"), F.lit("null"))
    return F.concat(F.expr("left(__head, length(__head) - 1)"), F.lit(',"result":'), result, F.lit("}")) if "__head" in row.columns else head


def json_lines(rows: DataFrame) -> DataFrame:
    """One text column, in order of row_no."""
    return rows.withColumn("__head", json_line(rows)).transform(lambda d: d.select("row_no", json_line(d).alias("value"))).orderBy("row_no").select("value")


def as_one_file(spark: SparkSession, parts: str, path: str, head: bytes = b"") -> None:
    """The part files of a folder as one file, head before them: copied part by part in order, none held in memory.

    The file takes the place of an earlier one by a single rename, so a stop at any step leaves the old file or the new one.
    """
    jvm = spark.sparkContext._jvm
    hadoop, conf = jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    target, whole = hadoop.Path(path), hadoop.Path(f"{path}.whole")
    fs = target.getFileSystem(conf)
    out = fs.create(whole, True)
    out.write(bytearray(head))
    for name in sorted(status.getPath().getName() for status in fs.globStatus(hadoop.Path(f"{parts}/part-*"))):
        part = fs.open(hadoop.Path(f"{parts}/{name}"))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 20, False)
        part.close()
    out.close()
    if fs.exists(target) and fs.getFileStatus(target).isDirectory():
        fs.delete(target, True)
    how = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    how[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(whole), fs.makeQualified(target), how)
    fs.delete(hadoop.Path(parts), True)


def write_results(rows: DataFrame, path: str) -> None:
    """One file of JSON lines, in order of row_no."""
    json_lines(rows).write.mode("overwrite").text(f"{path}.parts")
    as_one_file(rows.sparkSession, f"{path}.parts", path)


def unresolved(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("status") != SUCCESS).select("id", "name", "entity_type", "status", "attempts", F.coalesce("error", F.lit("")).alias("error"), "row_no")


def write_unresolved(rows: DataFrame, path: str) -> None:
    """One CSV file with a header, in order of row_no; it begins with a byte-order mark."""
    found = unresolved(rows).orderBy("row_no").drop("row_no")
    found.write.mode("overwrite").option("header", False).option("escape", '"').option("emptyValue", "").csv(f"{path}.parts")
    as_one_file(rows.sparkSession, f"{path}.parts", path, b"\xef\xbb\xbf" + (",".join(found.columns) + "\n").encode())


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result lines back; blank lines are skipped, a line that is no JSON object of results is an error that names it."""
    from tessera.schemas import RESULT

    schema = f"id string, name string, entity_type string, status string, attempts long, error string, result {RESULT}"
    lines = lines_of(spark, path).withColumn("at", F.monotonically_increasing_id()).where(F.regexp_replace("value", r"(?U)\s+", "") != "")
    read = lines.withColumn("r", F.from_json("value", f"{schema}, broken string", {"columnNameOfCorruptRecord": "broken"}))
    first = read.where("r.broken IS NOT NULL OR r IS NULL").orderBy("file", "split", "at").select("file", "split", "at").first()
    if first:
        before = (F.col("file") == first["file"]) & ((F.col("split") < first["split"]) | ((F.col("split") == first["split"]) & (F.col("at") < first["at"])))
        number = lines_of(spark, path).withColumn("at", F.monotonically_increasing_id()).where(before).count() + 1
        raise ValueError(f"{first['file']}: line {number} is no result")
    return read.select("r.*").drop("broken")


def link_lines(results: DataFrame) -> DataFrame:
    """`name: [urls]` of each row, with distinct non-blank URLs in order."""
    urls = F.array_distinct(F.filter(F.transform("result.links", lambda x: strip(x["url"])), lambda u: u != ""))
    urls = F.coalesce(urls, F.array().cast("array<string>"))
    return results.select(F.concat(F.regexp_replace("name", "[\r\n]+", " "), F.lit(": "), F.to_json(urls)).alias("value"))
