"""File sources: wrapped JSON pages, line lists, tables; and a paged source over any fetch function."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

VIDEO = (
    "data array<struct<id string, type string, links struct<thumbnail string>, relationships struct<show struct<links struct<related string>>, videoassets struct<links struct<related string>>>,"
    " attributes struct<video_id string, video_title string, video_featuring string, video_interviewer string, video_description string, video_topic_names array<string>, video_tag_names array<string>,"
    " video_asset_names array<string>, video_product_id string, video_is_published boolean, video_is_free boolean, video_likes_count bigint, video_dislikes_count bigint, video_duration bigint,"
    " video_filmed_on bigint, video_published_on bigint>>>"
)
PUBLICATION = (
    "data array<struct<id string, type string, links struct<thumbnail string>, attributes struct<issue_id string, issue_title string, issue_is_published boolean, issue_page_count bigint,"
    " issue_likes_count bigint, issue_dislikes_count bigint, issue_topic_names array<string>, issue_asset_names array<string>, issue_published_on bigint, issue_product_id string, issue_summary string>>>"
)
SHOW = "data array<struct<id string, attributes struct<show_name string, show_description string>>>"


def pages(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The items of {"data": [...]} files with the file that each came from."""
    return spark.read.schema(schema).json(path, multiLine=True).select(F.col("_metadata.file_path").alias("file"), F.inline("data"))


def project(items: DataFrame, fields: dict[str, tuple[str, object]]) -> DataFrame:
    """Flat records: name -> (path, default). A missing or falsy value becomes the default."""
    from ..functions.text import or_default

    return items.select(*(or_default(F.col(path), default).alias(name) for name, (path, default) in fields.items()))


#: Record field -> (path in an item, default).
VIDEO_FIELDS = {
    "id": ("id", ""), "type": ("type", ""), "title": ("attributes.video_title", ""), "featuring": ("attributes.video_featuring", ""), "interviewer": ("attributes.video_interviewer", ""),
    "description": ("attributes.video_description", ""), "product": ("attributes.video_product_id", ""), "thumbnail": ("links.thumbnail", ""),
    "show_url": ("relationships.show.links.related", ""), "assets_url": ("relationships.videoassets.links.related", ""), "topics": ("attributes.video_topic_names", ()),
    "tag_names": ("attributes.video_tag_names", ()), "assets": ("attributes.video_asset_names", ()), "is_published": ("attributes.video_is_published", False), "is_free": ("attributes.video_is_free", False),
    "likes": ("attributes.video_likes_count", 0), "dislikes": ("attributes.video_dislikes_count", 0), "duration": ("attributes.video_duration", 0),
    "filmed_on": ("attributes.video_filmed_on", 0), "published_on": ("attributes.video_published_on", 0), "inner_id": ("attributes.video_id", ""),
}
PUBLICATION_FIELDS = {
    "id": ("id", ""), "type": ("type", ""), "title": ("attributes.issue_title", ""), "summary": ("attributes.issue_summary", ""), "product": ("attributes.issue_product_id", ""), "thumbnail": ("links.thumbnail", ""),
    "topics": ("attributes.issue_topic_names", ()), "assets": ("attributes.issue_asset_names", ()), "is_published": ("attributes.issue_is_published", False), "pages": ("attributes.issue_page_count", 0),
    "likes": ("attributes.issue_likes_count", 0), "dislikes": ("attributes.issue_dislikes_count", 0), "published_on": ("attributes.issue_published_on", 0), "inner_id": ("attributes.issue_id", ""),
}


def line_list(spark: SparkSession, path: str) -> DataFrame:
    """(item): one trimmed line each; a missing file is an empty list."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "item string")
    return spark.read.text(path).select(F.trim("value").alias("item"))


def write_report(rows: DataFrame, path: str, *, fields: list[str] | None = None) -> None:
    """A CSV report with a header, of all columns or of some; lists are joined by ', '."""
    flat = [F.array_join(c, ", ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes if fields is None or c in fields]
    rows.select(*flat).write.mode("overwrite").csv(path, header=True)


def page_offsets(page_size: int, most: int) -> list[int]:
    """0, page_size, 2 page_size, ... up to most."""
    return list(range(0, most + 1, page_size))


def last_page(probe: Callable[[int], int], page_size: int, most: int = 20_000) -> int:
    """The offset of the last page that is not empty, by bisection; probe(offset) gives a page's number of items."""
    low, high = 0, most // page_size
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if probe(middle * page_size) else (low, middle - 1)
    return low * page_size


class _Page(InputPartition):
    def __init__(self, product: str | None, offset: int):
        self.product, self.offset = product, offset


class _Pages:
    """All pages of a plan, numbered in order: of each product those at 0, size, 2 size .. up to its last offset."""

    def __init__(self, options: dict):
        plan = json.loads(options["plan"]) if "plan" in options else [[None, int(options.get("page_size", 24)), int(options.get("most", 0))]]
        self.plan = [(product, int(size), int(last) // int(size) + 1) for product, size, last in plan]
        self.total = sum(n for _, _, n in self.plan)

    def page(self, number: int) -> _Page:
        for product, size, n in self.plan:
            if number < n:
                return _Page(product, number * size)
            number -= n
        raise IndexError(number)

    def place(self, number: int) -> dict:
        """The position in front of a page, as a stream's offset."""
        at = self.page(number) if number < self.total else _Page(None, 0)
        return {"pages": number, "product": at.product, "offset": at.offset}


def paged_source(name: str, schema: str | StructType, fetch: Callable[[int, dict], list[tuple]]) -> type[DataSource]:
    """A data source with one partition a page, for batches and streams: register it, then spark.read or spark.readStream with
    .format(name) and option("plan", json of [[product, page size, last offset], ..]), or ("page_size", ..) and ("most", ..) for one product.

    fetch(offset, options) returns a page's rows; it runs on the executors with the product among the options and raises to have
    the task tried again. A stream's offset is the number of pages read, with the product and offset of the next page; a batch reads up to
    pages_at_once (64) of them. Started again from its checkpoint it goes on at the page after the last batch."""

    class Rows:
        def __init__(self, options: dict):
            self.options, self.pages = dict(options), _Pages(options)

        def read(self, partition):
            yield from fetch(partition.offset, {**self.options, "product": partition.product})

    class Batch(Rows, DataSourceReader):
        def partitions(self):
            return [self.pages.page(k) for k in range(self.pages.total)]

    class Stream(Rows, DataSourceStreamReader):
        def __init__(self, options: dict):
            super().__init__(options)
            self.at, self.step = 0, int(options.get("pages_at_once", 64))

        def initialOffset(self):
            return self.pages.place(0)

        def latestOffset(self):
            return self.pages.place(min(self.pages.total, self.at + self.step))

        def partitions(self, start, end):
            self.at = max(self.at, int(end["pages"]))  # also called for where a restarted stream stands
            return [self.pages.page(k) for k in range(int(start["pages"]), int(end["pages"]))]

        def commit(self, end):
            self.at = max(self.at, int(end["pages"]))

    class Source(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return schema

        def reader(self, schema):
            return Batch(self.options)

        def streamReader(self, schema):
            return Stream(self.options)

    return Source


def read_pages(spark: SparkSession, name: str, folder: str, options: dict[str, str]) -> DataFrame:
    """Everything that a registered paged source has, read as a stream into folder, so that a read that broke off there goes on at the next
    page. The rows of pages that were read stay as they were then."""
    stream = spark.readStream.format(name).options(**options).load()
    query = stream.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/checkpoint").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")
