"""Shards that all match the mixture: proportional stratified interleaving.

Rows are shuffled within their source by a keyed hash and ranked there. Row r of the n of a source gets the fractional rank
(r + phase) / n, phase being a keyed number in [0, 1) for the source, so small sources do not all land in the middle. Sorted by
fractional rank every stretch of the order holds each source in proportion; the order is cut into shards whose row counts differ by
one at most (law `rows`). A source has within two rows of its share in every shard when there are few sources.

Neither order is sorted in one place. Both keys are uniform by construction, so rows are counted by cell of the key (a few
thousand cells, or as many as make cells of 50,000 rows), a running sum over the cells gives each cell its first place, and rows
are numbered within their cells. A keyed hash that very many rows share (repeated rows) is numbered by the tasks that hold it.

Defined cases: the null source is a source of its own; a null id is hashed by its text; a null text has size 0 and is kept; rows
that repeat are dealt one by one, which of them goes where is not told apart; an empty table gives an empty result; columns of the
documents travel in the struct `row`, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stash
from .mixing import keyed_hash

CELLS = 4096
CELL_ROWS = 50_000  # cells are made smaller than this, whatever the number of rows
MOST_CELLS = 1 << 20
HOT_ROWS = 200_000  # a hash that more rows share, and more than a hundred-thousandth of all, is numbered by task


def _before(cells: DataFrame, within: list[str], order: list[str]) -> DataFrame:
    """The cells with the number of rows in the cells before them; cells has one row a cell and its count `held`."""
    running = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy(*order)
    return stash(cells.withColumn("start", F.sum("held").over(running) - F.col("held")), "shard-cells", files=1)


def _with_hot(rows: DataFrame, cells: DataFrame, total: int, hot_rows: int) -> tuple[DataFrame, bool]:
    """rows with `cut`: twice the number of hot hashes of their cell below their own, and one more if their own is hot. So a hot hash is a cell
    of its own, between those of the hashes below and above it. There are 100,000 hot hashes at most."""
    bar = max(hot_rows, total // 100_000)
    full = cells.where(F.col("held") > bar)
    if not full.take(1):
        return rows.withColumn("cut", F.lit(0)), False
    counted = rows.join(full.select("of", "cell"), ["of", "cell"]).groupBy("of", "cell", "h").agg(F.count("*").alias("held"))
    hot = stash(counted.where(F.col("held") > bar).groupBy("of", "cell").agg(F.collect_list("h").alias("hot")), "shard-hot", files=1)
    below = F.coalesce(F.size(F.filter("hot", lambda x: x < F.col("h"))), F.lit(0))
    upto = F.coalesce(F.size(F.filter("hot", lambda x: x <= F.col("h"))), F.lit(0))
    cut = F.when(F.col("hot").isNull(), 0).otherwise(below + upto)
    return rows.join(hot, ["of", "cell"], "left").withColumn("cut", cut).drop("hot"), True


def _ranked(rows: DataFrame, total: int, hot_rows: int) -> DataFrame:
    """rows (of, n, cell, h, id, crc, ..) with `rank`, from 0 within the source `of`, in the order of h, id, crc."""
    cell = ["of", "cell", "cut"]
    counted = stash(rows.groupBy("of", "cell").agg(F.count("*").alias("held")), "shard-counts", files=1)
    rows, some_hot = _with_hot(rows, counted, total, hot_rows)
    cells = rows.groupBy(*cell).agg(F.count("*").alias("held")) if some_hot else counted.withColumn("cut", F.lit(0))
    placed = rows.join(_before(cells, ["of"], ["cell", "cut"]).drop("held"), cell)
    inside = Window.partitionBy(*cell).orderBy("h", "id", "crc")
    cold = placed.where(F.col("cut") % 2 == 0).withColumn("rank", F.col("start") + F.row_number().over(inside) - 1)
    if not some_hot:
        return cold
    hot = stash(placed.where(F.col("cut") % 2 == 1).withColumn("at", F.monotonically_increasing_id()), "shard-hot-rows")
    hot = hot.withColumn("task", F.shiftright("at", 33))
    tasks = hot.groupBy(*cell, "task").agg(F.count("*").alias("held"))
    tasks = _before(tasks, cell, ["task"]).select(*cell, "task", F.col("start").alias("earlier"))
    here = Window.partitionBy(*cell, "task").orderBy("at")
    numbered = hot.join(tasks, [*cell, "task"]).withColumn("rank", F.col("start") + F.col("earlier") + F.row_number().over(here) - 1)
    return cold.unionByName(numbered.select(cold.columns))


def phase(of, seed: str) -> F.Column:
    """A number in [0, 1) for the source: 52 bits of md5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}-phase:"), of)), 1, 13), 16, 10).cast("long").cast("double") / F.lit(2.0**52)


def interleaved(docs: DataFrame, shards: int = 24, *, id_col="doc_id", text_col="text", source_col="source", seed: str = "shard", cells: int = CELLS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(row, source_rank, fraction, shard, slot): the documents as structs, their places in their source, and where they go.

    slot counts from 0 within the shard, in the order of fraction. Four reads of the documents, two of them of the id, the source
    and the text for null ids, and two shuffles of whole rows."""
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.coalesce(F.concat(F.lit("="), docs[source_col].cast("string")), F.lit("~")).alias("of"),
        keyed_hash(id_col, text_col, seed).alias("h"),
        docs[id_col].alias("id"),
        F.crc32(F.coalesce(docs[text_col], F.lit("")).cast("binary")).alias("crc"),
    )
    sizes = stash(rows.groupBy("of").agg(F.count("*").alias("n")), "shard-sizes", files=1)
    total = sizes.agg(F.sum("n")).first()[0] or 0
    per = min(max(1, total // cells), CELL_ROWS)
    sizes = sizes.withColumn("cells", F.least(F.lit(MOST_CELLS), F.ceil(F.col("n") / per)).cast("long"))
    rows = rows.join(sizes, "of").withColumn("cell", F.shiftright(F.shiftright("h", 20) * F.col("cells"), 40)).drop("cells")
    rows = _ranked(rows, total, hot_rows).withColumn("fraction", (F.col("rank").cast("double") + phase(F.col("of"), seed)) / F.col("n").cast("double"))
    stretches = min(MOST_CELLS, 1 << max(cells.bit_length() - 1, (total // CELL_ROWS).bit_length()))
    rows = rows.select("row", "of", F.col("rank").alias("source_rank"), "fraction", F.floor(F.col("fraction") * stretches).alias("stretch"))
    starts = _before(rows.groupBy("stretch").agg(F.count("*").alias("held")), [], ["stretch"]).drop("held")
    place = F.col("start") + F.row_number().over(Window.partitionBy("stretch").orderBy("fraction", "of")) - 1
    rows = rows.join(starts, "stretch").withColumn("place", place)
    out = rows.withColumn("shard", F.expr(f"place * {shards} div {max(1, total)}").cast("int"))
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return out.select("row", "source_rank", "fraction", "shard", (F.col("place") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 24, **options) -> None:
    """The rows below path/shard=k, with `slot`; files hold contiguous stretches of a shard, in order. One more shuffle of the rows."""
    out = interleaved(docs, shards, **options).select("row", "shard", "slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard as write_shards left them, in the columns of the documents, with `slot` kept in the struct's place order."""
    return spark.read.parquet(f"{path}/shard={shard}").orderBy("slot").select("row.*")
