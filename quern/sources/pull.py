"""Pulls from paged interfaces: page sizes and last pages, whole pulls that appear at once, dimensions, snapshots of a table.

`Site` stands for the remote side. Engines outside give one that logs in and fetches over the network; `FolderSite` reads files of
the same form. Pages are fetched by tasks (the site is sent to them), so the driver knows the pages and sees none of their items. A
pull writes under a name of its own and becomes current when it is whole, so a failed one leaves the last; a resumed one goes on
at the page where it broke off."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.store import first_of
from ..operators.versions import Versions
from . import files


class Site(Protocol):
    """What a pull needs; every call may raise. A page is a list of items as they come."""

    def login(self) -> None: ...

    def logout(self) -> None: ...

    def page(self, kind: str, product: str, offset: int) -> list[dict]: ...

    def table(self, name: str, fields: list[str], part: int = 0, parts: int = 1) -> list[dict]:
        """The rows of a table in its order, or one of so many parts of them that together have each row once, first parts first."""

    def comments(self, key: str) -> list[dict]: ...

    def text(self, kind: str, key: str) -> dict: ...


class FolderSite:
    """A site of JSON files: <kind>/<product>.json holds all items of a product, tables/<name>.json the rows of a table,
    comments/<key>.json a record's comments, texts/<kind>/<key>.json its text as {"words": [[offset, word]], "pdf_text": ".."}."""

    def __init__(self, folder: str, page_size: int = 24):
        self.folder, self.page_size, self.logged_in = Path(folder), page_size, False

    def login(self) -> None:
        self.logged_in = True

    def logout(self) -> None:
        self.logged_in = False

    def page(self, kind: str, product: str, offset: int) -> list[dict]:
        path = self.folder / kind / f"{product}.json"
        items = json.loads(path.read_text()) if path.exists() else []
        return items[offset : offset + self.page_size] if kind != "publications" else (items if not offset else [])

    def table(self, name: str, fields: list[str], part: int = 0, parts: int = 1) -> list[dict]:
        rows = json.loads((self.folder / "tables" / f"{name}.json").read_text())
        rows = rows[len(rows) * part // parts : len(rows) * (part + 1) // parts]
        return [{"id": r["id"], "fields": {k: v for k, v in r["fields"].items() if k in fields}} for r in rows]

    def _optional(self, path: Path, default):
        return json.loads(path.read_text()) if path.exists() else default

    def comments(self, key: str) -> list[dict]:
        return self._optional(self.folder / "comments" / f"{key}.json", [])

    def text(self, kind: str, key: str) -> dict:
        return self._optional(self.folder / "texts" / kind / f"{key}.json", {})


PAGING = "product string, base_multiple long, max_multiple long"


def page_size(site: Site, kind: str, product: str) -> int:
    """The number of items of the first page; 0 is no page size but a failure to note."""
    return len(site.page(kind, product, 0))


def probe_paging(spark: SparkSession, site: Site, kind: str, products: list[str], *, most: int = 20_000) -> tuple[DataFrame, dict[str, str]]:
    """(product, base_multiple, max_multiple) of the products that could be probed, and what went wrong with the others."""
    rows, errors = [], {}
    for product in products:
        try:
            size = page_size(site, kind, product)
            if not size:
                errors[product] = "the first page is empty"
                continue
            last = files.last_page(lambda offset, p=product: len(site.page(kind, p, offset)), size, most)
            rows.append((product, size, last))
        except Exception as e:  # one product's failure is reported, the others go on
            errors[product] = repr(e)
    return spark.createDataFrame(rows, PAGING), errors


def paging_of(paging: DataFrame, product: str, column: str) -> int | None:
    """One number of the paging table; None for a product that it lacks."""
    row = paging.where(F.col("product") == product).select(column).first()
    return row[0] if row else None


def updated_paging(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """The paging table with the fresh products replaced and the others as they were."""
    return old.join(fresh.select("product"), "product", "left_anti").unionByName(fresh)


class Pulls:
    """Versioned pulls below a folder: raw items as JSON text with product and page, read into typed records."""

    def __init__(self, spark: SparkSession, folder: str, site: Site, *, pages_at_once: int = 64):
        self.spark, self.folder, self.site, self.pages_at_once = spark, folder.rstrip("/"), site, pages_at_once
        self.versions = Versions(spark, folder, 1)
        self.errors: dict[str, str] = {}

    def _source(self, kind: str) -> str:
        """The name of a registered source of the pages of a kind, as rows (product, file, item)."""
        site, name = self.site, f"quern_{kind}"

        def fetch(offset: int, options: dict):
            product = options["product"]
            for item in site.page(kind, product, offset):
                yield (product, f"{product}-{offset:06d}", json.dumps(item))

        self.spark.dataSource.register(files.paged_source(name, "product string, file string, item string", fetch))
        return name

    def pull(self, kind: str, paging: DataFrame | None, products: list[str], *, most: int | None = None, resume: str | None = None) -> bool:
        """Pull all pages of each product (up to offset `most`), or its one page where paging is None, by tasks. On any error nothing
        changes and the answer is False.

        resume: a name for this pull. What it has read is kept below drafts/<name>, and a pull of that name that broke off goes on there."""
        sizes = {p: (1, 0) for p in products}
        if paging is not None:
            rows = paging.where(F.col("product").isin(*products)).collect()  # a row a product
            sizes = {r["product"]: (r["base_multiple"], r["max_multiple"] if most is None else min(most, r["max_multiple"])) for r in rows}
        try:
            plan = json.dumps([[p, *sizes[p]] for p in products])
            options, name = {"plan": plan, "pages_at_once": str(self.pages_at_once)}, self._source(kind)
            draft = f"{self.folder}/drafts/{kind}-{resume}"
            items = files.read_pages(self.spark, name, draft, options) if resume else self.spark.read.format(name).options(**options).load()
            self.versions.commit({kind: (items, "file", None)}, facts={kind: {"products": products, "whole": most is None}})
        except Exception as e:  # the last pull stays current
            self.errors[kind] = repr(e)
            return False
        if resume:
            self.versions._fs.delete(self.versions._path(f"drafts/{kind}-{resume}"), True)
        return True

    def read(self, kind: str, schema: str, fields: dict) -> DataFrame:
        """The records of the current pull, typed, one an id (of repeated ids the one of the first file)."""
        if not self.versions.has(kind):
            raise FileNotFoundError(f"no pull of {kind}")
        one = schema.removeprefix("data array<").removesuffix(">")
        items = self.versions.read(kind).select("product", "file", F.from_json("item", one).alias("i"))
        return first_of(files.project(items.select("file", "i.*"), {**fields, "file": ("file", "")}), "id", "file").drop("file")

    def files(self, kind: str) -> DataFrame:
        """(product, file, n) of the current pull, for the check that it is whole."""
        return self.versions.read(kind).groupBy("product", "file").agg(F.count("*").alias("n"))

    def outer_ids(self, kind: str, inner: str) -> DataFrame:
        """(id, inner) of every item, repeated ones too, for the check of ids."""
        item = self.versions.read(kind).select("item")
        return item.select(F.get_json_object("item", "$.id").alias("id"), F.get_json_object("item", f"$.attributes.{inner}").alias("inner"))

    def shows(self) -> DataFrame:
        """(id, name, description) of the current pull of shows."""
        item = self.versions.read("shows").select("file", "item")
        part = lambda path: F.coalesce(F.get_json_object("item", path), F.lit(""))
        return first_of(item.select(part("$.id").alias("id"), part("$.attributes.show_name").alias("name"), part("$.attributes.show_description").alias("description"), "file"), "id", "file").drop("file")


def whole_publications(files_: DataFrame, products: list[str]) -> bool:
    """Whether there is exactly one file with items for each product."""
    got = {r["product"]: (r["files"], r["least"]) for r in files_.groupBy("product").agg(F.count("*").alias("files"), F.min("n").alias("least")).collect()}  # a row a product
    return all(got.get(p, (0, 0))[0] == 1 and got[p][1] > 0 for p in products)


# ---- snapshots of a remote table ----


def rekeyed(rows: DataFrame, key: str, fields: list[str], *, order: str = "position") -> DataFrame:
    """(key, fields...) of raw rows (position, id, fields map<string,string> of JSON values): the row of each key that came first.

    Text is trimmed, a missing field is '', rows without the key go; the field 'id' is the row's own id."""
    text = lambda c: F.trim(F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v"), c))
    value = lambda f: F.trim("id") if f == "id" else F.coalesce(text(F.col("fields")[f]), F.lit(""))
    keyed = rows.where(F.lit(key == "id") | F.col("fields")[key].isNotNull())
    return first_of(keyed.select(value(key).alias("key"), *(value(f).alias(f) for f in fields), order), "key", order).drop(order)


class Snapshots:
    """Pulls of a remote table by tasks, newest first; the raw rows of the last `keep` pulls stay."""

    def __init__(self, spark: SparkSession, folder: str, site: Site, table: str, fields: list[str], key: str, *, keep: int = 48, parts: int = 4):
        self.spark, self.site, self.table, self.fields, self.key, self.keep, self.parts = spark, site, table, fields, key, keep, parts
        self.versions = Versions(spark, f"{folder.rstrip('/')}/{table}", 1)

    def pull(self) -> None:
        site, table, parts, wanted = self.site, self.table, self.parts, [f for f in self.fields if f != "id"]

        def run(batches):
            import pyarrow as pa

            kind = pa.map_(pa.string(), pa.string())
            for batch in batches:
                for part in batch.column(0).to_pylist():
                    got = site.table(table, wanted, part, parts)
                    at = [(part << 40) + k for k in range(len(got))]
                    fields = [[(f, json.dumps(v)) for f, v in r["fields"].items()] for r in got]
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array([r["id"] for r in got], pa.string()), pa.array(fields, kind)], ["position", "id", "fields"])

        rows = self.spark.range(0, parts, 1, parts).mapInArrow(run, "position long, id string, fields map<string,string>")
        self.versions.commit({"raw": (rows, "id", None)})
        self.versions.retain(self.keep)

    def load(self, *, fresh: bool = False) -> DataFrame:
        """The newest snapshot, re-keyed; fresh: pulled just now."""
        if fresh or not self.versions.version():
            self.pull()
        return rekeyed(self.versions.read("raw"), self.key, self.fields)


# ---- fetches for each record, in the tasks ----


def _each(ids: DataFrame, key: str, fetch, columns: str) -> DataFrame:
    """(key, columns..., error): fetch(key) gives the rows of a record as tuples; an error is noted with its record."""
    import pyarrow as pa

    names = [f.name for f in StructType.fromDDL(columns).fields]

    def run(batches):
        for batch in batches:
            out = []
            for k in batch.column(0).to_pylist():
                try:
                    out.extend((k, json.dumps(row), None) for row in fetch(k))
                except Exception as e:  # the record has no rows and says why
                    out.append((k, None, str(e)[:500]))
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.string()) for j in range(3)], ["key", "row", "error"])

    rows = ids.select(F.col(key).cast("string")).mapInArrow(run, "key string, row string, error string")
    parsed = rows.withColumn("r", F.from_json("row", columns))
    return parsed.select(F.col("key").alias(key), *(F.col(f"r.{n}").alias(n) for n in names), "error")


def fetched_comments(ids: DataFrame, key: str, site: Site) -> DataFrame:
    """(key, likes, dislikes, reply_to, error): one row a comment."""
    # fixed values: the attributes of a comment
    fields = {"likes": "comment_likes_count", "dislikes": "comment_dislikes_count", "reply_to": "comment_reply_to_id"}
    return _each(ids, key, lambda k: [{n: c.get("attributes", {}).get(a) for n, a in fields.items()} for c in site.comments(k)], "likes long, dislikes long, reply_to string")


def fetched_texts(ids: DataFrame, key: str, kind: str, site: Site) -> DataFrame:
    """(key, words array<struct<offset, word>>, pdf_text, error): one row a record, null where a form is not there."""

    def one(k):
        got = site.text(kind, k)
        words = got.get("words")
        return [{"words": None if words is None else [{"offset": o, "word": w} for o, w in words], "pdf_text": got.get("pdf_text")}]

    return _each(ids, key, one, "words array<struct<offset:bigint,word:string>>, pdf_text string")
