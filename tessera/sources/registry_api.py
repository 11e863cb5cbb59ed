"""The registry's paged interface as a Spark data source, and its replayed form.

The list can change while its pages are read, which shifts records over the ends of pages. Each page is therefore read with the record before
it: the two readings of that place must agree, and so must the sizes that all pages report; else the list is read again.
"""

from __future__ import annotations

import json
import time
import urllib.request

from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.operators.registry import RAW
from tessera.operators.search import RegistryError, with_retry
from tessera.operators.tables import cut

FIELDS = [x.split()[0] for x in RAW.split(", ")]


def http_page(options: dict, offset: int) -> dict:
    """One page by POST: offset, limit and the order by number."""
    body = json.dumps({"offset": offset, "limit": int(options.get("page_size", 200)), "search": "", "facets": {}, "sort": [{"property": "field_1_i", "direction": "desc"}]})
    request = urllib.request.Request(options["url"], body.encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=float(options.get("timeout", 30))) as answer:
        return json.loads(answer.read())


def replay_page(options: dict, offset: int) -> dict:
    """One page of recorded rows: option `rows` is a JSON list, `size` what the interface would report."""
    rows = json.loads(options["rows"])
    return {"size": json.loads(options.get("size", str(len(rows)))), "values": rows[offset : offset + int(options.get("page_size", 200))]}


def page(options: dict, offset: int) -> dict:
    read = replay_page if "rows" in options else http_page
    found = with_retry(lambda: read(options, offset), int(options.get("attempts", 1)), float(options.get("base_delay", 2)))
    if not isinstance(found, dict) or not isinstance(found.get("size"), int) or isinstance(found.get("size"), bool) or found["size"] < 0 or not isinstance(found.get("values"), list):
        raise RegistryError("a page of the registry cannot be read")
    return found


class _Range(InputPartition):
    def __init__(self, offset: int, end: int):
        super().__init__((offset, end))
        self.offset, self.end = offset, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)

    def partitions(self):
        """The first page tells the size; each task then reads a range of pages."""
        size, most = page(self.options, 0)["size"], int(self.options.get("max_records", 10_000))
        if size > most:
            raise RegistryError(f"the registry reports {size} records, more than {most}")
        step = int(self.options.get("page_size", 200)) * int(self.options.get("pages_per_task", 8))
        return [_Range(k, min(size, k + step)) for k in range(0, size, step)] or [_Range(0, 0)]

    def read(self, partition):
        offset = partition.offset
        while offset < partition.end:
            # The record before the page, too, if a page holds more than one.
            first = max(0, offset - 1) if int(self.options.get("page_size", 200)) > 1 else offset
            found = page(self.options, first)
            values = found["values"][: partition.end - first]
            if len(values) <= offset - first:
                raise RegistryError("an empty page before the end of the registry")
            for k, value in enumerate(values):
                sound = isinstance(value, dict) and str(value.get("id") or "").strip()
                yield (first + k, found["size"], *(None if not sound or value.get(f) is None else str(value.get(f)) for f in FIELDS))
            offset = first + len(values)
            time.sleep(float(self.options.get("delay", 0)))


class RegistrySource(DataSource):
    """spark.read.format("registry"): pos, the size reported and the raw fields; places that two pages hold come twice."""

    @classmethod
    def name(cls):
        return "registry"

    def schema(self):
        return f"pos long, size long, {RAW}"

    def reader(self, schema):
        return _Reader(self.options)


def shifted(rows) -> bool:
    """Whether the list changed while it was read: two records in one place, several sizes, or fewer places than the size."""
    places = rows.groupBy("pos").agg(F.count_distinct(F.coalesce("id", F.lit(""))).alias("records"), F.min("size").alias("least"), F.max("size").alias("most"))
    told = places.agg(F.max("records").alias("records"), F.min("least").alias("least"), F.max("most").alias("most"), F.count("*").alias("places")).first()
    return told["places"] > 0 and (told["records"] > 1 or not told["least"] == told["most"] == told["places"])


def download(spark, config, **options):
    """The raw rows of the whole registry, by id, read again while the list changes under the reading."""
    from tessera.operators.registry import dedupe_pages

    spark.dataSource.register(RegistrySource)
    read = spark.read.format("registry").option("page_size", str(config.registry_page_size)).option("max_records", str(config.registry_max_records)).option("delay", str(config.registry_page_delay))
    read = read.option("timeout", str(config.registry_timeout)).option("attempts", str(config.registry_attempts)).option("base_delay", str(config.registry_base_delay))
    for _ in range(max(1, config.registry_attempts)):
        rows = cut(read.options(**options).load())
        if not shifted(rows):
            return dedupe_pages(rows.drop("size").dropDuplicates(["pos"]))
    raise RegistryError("the registry changes while it is read")
