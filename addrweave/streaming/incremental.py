"""Incremental address matching over geometry on Structured Streaming.

Map changes arrive as a stream; each micro-batch re-matches only the addresses that its changes can reach. All state lies in tables of row versions in
folders ``folder=F/batch=N`` (``BlockLog``). Map and register are blocked by municipality and square of ``BLOCK`` metres, an entity lying in every block
its box touches; what is looked up by an id has a second table blocked by a hash of that id. Blocks are many (a country has tens of thousands), so a folder
holds those of one hash, in order: a batch writes ``FOLDERS`` files a table at most, however large the map. A batch reads only the folders of
the blocks it touches and writes only its own ``batch=N`` folders, by dynamic partition overwrite: a batch that is replayed after a failure reads
what it read before and replaces what it had written.

Why a neighbourhood is enough: which address wins a map entity depends on that entity and the addresses within the radius of its shape, and an
address keeps its best among the entities it won. A changed entity thus only touches the addresses near its old or new shape, or holding
its old or new id. Their results need the entities near them, and those entities' winners need the addresses near those in turn.

What several steps of a batch read is stored once. Versions are ranked after the rows of other ids are gone, and after one shuffle by the id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from addrweave.functions import geometry as G
from addrweave.operators.cells import explode_box, shape_pairs
from addrweave.operators.ranking import keep_first
from addrweave.options import DEFAULTS, Options
from addrweave.plans.address import match_addresses
from addrweave.session import stored

MAP_COLUMNS = ["osm_id", "muni_id", "street", "house_no", "house_ref", "x", "y", "rings"]
BLOCK = 2000.0
BUCKETS = 64
FOLDERS = 64  # folders of a table and batch: tasks and files of a write
LISTED = 1000  # block names that are listed for pruning within folders; beyond it blocks are met by a join
SENT = 2_000_000  # names whose hashes (some 50 bytes each in a task's table) go to all tasks; beyond it a shuffle join is used


def bucket_of(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(BUCKETS)).cast("string")


def folder_of(block: Column | str) -> Column:
    return F.pmod(F.xxhash64(block), F.lit(FOLDERS)).cast("int")


def in_blocks(df: DataFrame, size: float, grow: float = 0.0, block: str = "block") -> DataFrame:
    """One row per block that the box of a row's shape (``rings``, else ``x``, ``y``), widened by ``grow``, touches."""
    x, y, b = F.col("x").cast("double"), F.col("y").cast("double"), G.bounds("rings")
    box = [F.coalesce(b[k], c) + s for k, c, s in (("xmin", x, -grow), ("ymin", y, -grow), ("xmax", x, grow), ("ymax", y, grow))]
    return explode_box(df, *box, size).withColumn(block, F.concat_ws("_", F.col("muni_id").cast("string"), "_cx", "_cy")).drop("_cx", "_cy")


def met(df: DataFrame, named: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is in ``named``, a stored table. Few names, which are counted, first sift ``df`` by their hashes, so that only what is left is shuffled."""
    named = named.select(on)
    if named.count() <= SENT:
        hashes = F.broadcast(named.select(F.xxhash64(on).alias("_h")).distinct())
        df = df.withColumn("_h", F.xxhash64(on)).join(hashes, "_h", "left_semi").drop("_h")
    return df.join(named, on, "left_semi")


class BlockLog:
    """Row versions in ``path/folder=F/batch=N``, F by a hash of the block; in a block the newest batch wins per key and ``deleted`` rows drop out.

    ``copies``: a row may lie in several blocks. ``once``: rows are written at the start only, each in one block, so there are no versions to rank.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | list[str], copies: bool = True, once: bool = False):
        self.spark, self.path, self.key, self.schema = spark, path, [key] if isinstance(key, str) else key, None
        self.copies, self.once = copies, once

    def append(self, df: DataFrame, batch_id: int) -> None:
        """Rows with ``block`` and ``deleted`` as batch ``batch_id``; the same batch written again replaces itself."""
        d = df.withColumns({"block": F.coalesce("block", F.lit("none")), "batch": F.lit(batch_id)})
        if self.schema is None:
            self.schema = StructType()
            for f in [f for f in d.schema if f.name not in ("block", "batch")]:
                self.schema.add(f.name, StructType.fromDDL(f"c {f.dataType.simpleString()}")[0].dataType)  # nullable all through
            self.schema.add("block", "string").add("folder", "integer").add("batch", "integer")
        d = d.withColumn("folder", folder_of("block")).select(*[F.col(f.name).cast(f.dataType) for f in self.schema])
        d = d.repartition(FOLDERS, "folder").sortWithinPartitions("folder", "batch", "block")
        d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder", "batch").parquet(self.path)

    def versions(self, blocks: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """All versions, those of the named ``blocks`` (a table with ``block``), or those older than a batch: only their folders are read."""
        d = self.spark.read.schema(self.schema).parquet(self.path)
        if before is not None:
            d = d.where(F.col("batch") < before)
        if blocks is None:
            return d.drop("folder")
        blocks = stored(blocks.select("block").distinct(), self.spark)
        named = blocks.withColumn("folder", folder_of("block")).limit(LISTED + 1).collect()
        if len(named) > LISTED:  # so many blocks lie in all folders
            return met(d.drop("folder"), blocks, "block")
        return d.where(F.col("folder").isin(sorted({r.folder for r in named})) & F.col("block").isin([r.block for r in named])).drop("folder")

    def current(self, blocks: DataFrame | None = None, before: int | None = None, named: DataFrame | None = None) -> DataFrame:
        """Newest rows, one per key (the copies of a row in several blocks are equal); with ``named``, a stored table with one key column, only its rows."""
        d = self.versions(blocks, before)
        d = d if named is None else met(d, named, named.columns[0])
        if self.once:
            return d.where("NOT deleted").drop("block", "batch", "deleted")
        newest = keep_first(d.repartition(*self.key), ["block", *self.key], [F.desc("batch")]).where("NOT deleted")
        return (keep_first(newest, self.key, [F.col("block")]) if self.copies else newest).drop("block", "batch", "deleted")

    def compact(self, into: str) -> BlockLog:
        """Newest rows of each block as batch -1 of a new log; the old folders stay for whoever still reads them."""
        new = BlockLog(self.spark, into, self.key, self.copies, self.once)
        new.append(keep_first(self.versions(), ["block", *self.key], [F.desc("batch")]).where("NOT deleted").drop("batch"), -1)
        return new


class IncrementalMatch:
    """Keeps the address analysis up to date with a stream of map changes.

    ``auth`` as for ``match_addresses``, each ``addr_id`` once. ``root``: folder of the state, shared by driver and executors.
    """

    def __init__(self, spark: SparkSession, auth: DataFrame, root: str, options: Options = DEFAULTS, block: float = BLOCK):
        self.spark, self.auth, self.options, self.block = spark, auth, options, block
        self.map, self.by_id = BlockLog(spark, f"{root}/map", "osm_id"), BlockLog(spark, f"{root}/map_by_id", "osm_id", copies=False)
        self.by_ref = BlockLog(spark, f"{root}/map_by_ref", ["house_ref", "osm_id"], copies=False)  # an entity that takes another id leaves a mark under the old one
        self.addresses, self.address_by_id = (BlockLog(spark, f"{root}/{n}", "addr_id", copies=False, once=True) for n in ("addresses", "addresses_by_id"))
        self.analysis = BlockLog(spark, f"{root}/analysis", "addr_id", copies=False)

    def _place(self, df: DataFrame, grow: float = 0.0) -> DataFrame:
        return in_blocks(df, self.block, grow)

    @staticmethod
    def _alive(df: DataFrame) -> DataFrame:
        return df.withColumn("deleted", F.lit(False))

    def _addresses_in(self, df: DataFrame) -> DataFrame:
        """Addresses with the block of their point."""
        return self._place(df.withColumn("rings", F.expr(f"CAST(NULL AS {G.PARTS})"))).drop("rings")

    def start(self, osm: DataFrame) -> None:
        """Full batch over the first map; becomes batch -1 of all tables."""
        self.by_id.append(self._alive(osm.select(*MAP_COLUMNS).withColumn("block", bucket_of("osm_id"))), -1)
        self.address_by_id.append(self._alive(self.auth.withColumn("block", bucket_of("addr_id"))), -1)
        first, auth = (log.versions(before=0).drop("block", "batch", "deleted") for log in (self.by_id, self.address_by_id))  # as written: all later steps read the same rows
        self.map.append(self._alive(self._place(first)), -1)
        self.by_ref.append(self._alive(first.where("house_ref IS NOT NULL").withColumn("block", bucket_of("house_ref"))), -1)
        self.addresses.append(self._alive(self._addresses_in(auth)), -1)
        self.analysis.append(self._alive(self._addresses_in(match_addresses(auth, first, self.options))), -1)

    def process(self, changes: DataFrame, batch_id: int) -> None:
        """One micro-batch of ``change_no, action`` and map columns; later changes of an entity win."""
        last = keep_first(changes, ["osm_id"], [F.desc("change_no")])
        last = self._stored(last.select(*MAP_COLUMNS, (F.col("action") == "delete").alias("deleted")))
        before = self._stored(self.by_id.current(last.select(bucket_of("osm_id").alias("block")), batch_id, last.select("osm_id")).select(*MAP_COLUMNS))
        after = last.where("NOT deleted").drop("deleted")
        self._write_map(last, before, after, batch_id)
        todo = self._stored(self._touched_addresses(before.unionByName(after)))
        entities = self._stored(self._near_entities(todo, batch_id + 1))
        rivals = self._near_addresses(entities).unionByName(todo)
        rivals = self._stored(keep_first(rivals, ["addr_id"], [F.col("muni_id")]))
        named = todo.select(F.col("addr_id").alias("house_ref"))
        carriers = self._stored(self.by_ref.current(todo.select(bucket_of("addr_id").alias("block")), batch_id + 1, named).select(*MAP_COLUMNS))
        part = match_addresses(rivals, entities.unionByName(carriers), self.options)  # carriers have an id, entities have none
        self.analysis.append(self._alive(self._addresses_in(part.join(todo.select("addr_id"), "addr_id", "left_semi"))), batch_id)

    def _stored(self, df: DataFrame) -> DataFrame:
        return stored(df, self.spark)

    def _write_map(self, last: DataFrame, before: DataFrame, after: DataFrame, batch_id: int) -> None:
        """New rows into their blocks, and a mark of deletion into blocks that an entity has left."""
        def versions(new: DataFrame, old: DataFrame, place: str = "block") -> DataFrame:
            left = old.join(new.select("osm_id", place), ["osm_id", place], "left_anti").withColumn("deleted", F.lit(True))
            return self._alive(new).unionByName(left)

        self.map.append(versions(self._place(after), self._place(before)), batch_id)
        self.by_id.append(last.withColumn("block", bucket_of("osm_id")), batch_id)
        with_ref = [d.where("house_ref IS NOT NULL").withColumn("block", bucket_of("house_ref")) for d in (after, before)]
        self.by_ref.append(versions(*with_ref, "house_ref"), batch_id)

    def _touched_addresses(self, touched: DataFrame) -> DataFrame:
        """Addresses near an old or new shape without id, or named by an old or new id."""
        refs = self._stored(touched.where("house_ref IS NOT NULL").select(F.col("house_ref").alias("addr_id")).distinct())
        named = self.address_by_id.current(refs.select(bucket_of("addr_id").alias("block")), named=refs)
        return keep_first(self._near_addresses(touched.where("house_ref IS NULL")).unionByName(named), ["addr_id"], [F.col("muni_id")])

    def _pairs(self, auth: DataFrame, entities: DataFrame) -> DataFrame:
        shapes = entities.select("osm_id", "muni_id", F.col("x").alias("mx"), F.col("y").alias("my"), "rings")
        return shape_pairs(auth.select("addr_id", "muni_id", "x", "y"), shapes, self.options.radius, ["muni_id"], self.options.rows_per_task)[0]

    def _near_addresses(self, entities: DataFrame) -> DataFrame:
        known = self.addresses.current(self._place(entities, self.options.radius).select("block"))
        return known.join(self._pairs(known, entities).select("addr_id").distinct(), "addr_id", "left_semi")

    def _near_entities(self, auth: DataFrame, before: int) -> DataFrame:
        around = self._place(auth.select("muni_id", "x", "y", F.expr(f"CAST(NULL AS {G.PARTS})").alias("rings")), self.options.radius)
        free = self._stored(self.map.current(around.select("block"), before).where("house_ref IS NULL"))
        return free.join(self._pairs(auth, free).select("osm_id").distinct(), "osm_id", "left_semi").select(*MAP_COLUMNS)

    def run(self, changes_path: str, schema: StructType, checkpoint: str, files_per_batch: int | None = 1) -> StreamingQuery:
        """Read all change files present, in micro-batches of so many files (``None``: in one), and stop; call again (or schedule) for later ones."""
        stream = self.spark.readStream.schema(schema)
        stream = (stream if files_per_batch is None else stream.option("maxFilesPerTrigger", files_per_batch)).parquet(changes_path)
        return (stream.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())

    def current(self) -> DataFrame:
        """The analysis as of the last batch."""
        return self.analysis.current()
