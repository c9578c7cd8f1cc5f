"""A paged source as a Spark data source: a partition for each page.

``transport`` names a function "module:function" that takes the options and a page number from 1 and returns
{"total": n, "items": [{...}]}; ``from_folder`` reads stored answers, so nothing here needs a network.
"""

from __future__ import annotations

import importlib
import json
import math
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

MOST = 200_000


def from_folder(options: dict, page: int) -> dict:
    path = Path(options["path"]) / f"page-{page:05d}.json"
    return json.loads(path.read_text()) if path.exists() else {"total": 0, "items": []}


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.size = int(options.get("pagesize", 100))
        module, _, name = options.get("transport", "leafmill.sources.paged:from_folder").partition(":")
        self.load = getattr(importlib.import_module(module), name)

    def partitions(self):
        total = int(self.load(self.options, 1)["total"])
        if total > int(self.options.get("most", MOST)):
            raise ValueError(f"{total} rows are implausible: at most {self.options.get('most', MOST)} are expected")
        pages = min(math.ceil(total / self.size), int(self.options.get("maxpages", 1 << 30)))
        return [InputPartition(p) for p in range(1, pages + 1)]

    def read(self, partition):
        for item in self.load(self.options, partition.value)["items"]:
            yield str(item.get("id")), json.dumps(item, sort_keys=True)


class PagedSource(DataSource):
    """Columns: id and the item as JSON."""

    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return "id string, item string"

    def reader(self, schema):
        return _Reader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)
