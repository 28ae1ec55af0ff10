"""Registers and map tables derived from the driver's parquet tables.

Every table exists twice: as a Spark DataFrame (``World``) and as a DuckDB CTE (``CTES``), so that each
registered query can be checked in an independent engine. All rows of the source tables take part and all
coordinates are whole metres in a made-up plane, so both engines agree exactly. Municipalities are suppliers,
streets are parts, authority addresses are customers, map entities are orders: work grows with the data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Street-name pool, in the authority's spelling and in the curated one.
RGZ_NAMES = [
    "МИЛАНА КАДЕВИЋА", "ДВАДЕСЕТ ПЕТЕ БРИГАДЕ", "ЗМАЈЕВАЧКА", "ЏЕМАЛА ЖИВКОВИЋА", "ТРЕЋЕГ МАРТА", "ДР АНЕ РАДИЋ",
    "ПУТ ЗА ЊЕГОВАЦ", "КРАЉА СТЕФАНА ДРУГОГ", "ОСМА", "7. АПРИЛА", "ЂУРЂА ЉУБИЧИЋА", "ЈАСЕНОВА",
]
PROPER_NAMES = [
    "Милана Кадевића", "Двадесет пете бригаде", "Змајевачка", "Џемала Живковића", "Трећег марта", "Др Ане Радић",
    "Пут за Његовац", "Краља Стефана Другог", "Осма", "7. априла", "Ђурђа Љубичића", "Јасенова",
]


def _pool(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (index % 12 + 1).cast("int"))


def _duck_pool(names: list[str], index: str) -> str:
    return "list_extract([" + ",".join(f"'{n}'" for n in names) + f"], cast(({index}) % 12 + 1 as int))"


def _idiv(col: Column | str, by: int) -> Column:
    return F.floor((F.col(col) if isinstance(col, str) else col) / by)


_KEPT: dict[tuple[str, str, str], DataFrame] = {}


def _kept(build):
    """Derived input table kept (memory, then disk) for the session: it stands for a stored table that many queries read."""
    name = build.__name__

    def get(self: World) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _KEPT:
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            _KEPT[key] = build(self).repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)
        return _KEPT[key]

    get.__name__, get.__doc__ = name, build.__doc__
    return property(get)


class World:
    """Derived tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def muni(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").alias("muni_id"), F.col("s_name").alias("muni_name"), F.col("s_nationkey").alias("district"),
            ((F.col("s_suppkey") % 40) * 3000).alias("ox"), (_idiv("s_suppkey", 40) * 3000).alias("oy"))

    @cached_property
    def muni_ring(self) -> DataFrame:
        corner = F.explode(F.array(*[
            F.struct(F.lit(p).alias("pos"), F.lit(x).cast("long").alias("cx"), F.lit(y).cast("long").alias("cy"))
            for p, x, y in ((1, -200, -200), (2, 1400, -200), (3, 1400, 1000), (4, 600, 1400), (5, -200, 1000))]))
        return self.muni.select("*", corner.alias("c")).select(
            "muni_id", "muni_name", F.col("c.pos").alias("pos"), (F.col("ox") + F.col("c.cx")).alias("x"),
            (F.col("oy") + F.col("c.cy")).alias("y"))

    @cached_property
    def muni_polygon(self) -> DataFrame:
        """One row per municipality with its closed ring, as ``rings array<array<struct<x,y>>>``."""
        def pt(x, y):
            return F.struct((F.col("ox") + x).cast("double").alias("x"), (F.col("oy") + y).cast("double").alias("y"))
        corners = [(-200, -200), (1400, -200), (1400, 1000), (600, 1400), (-200, 1000), (-200, -200)]
        return self.muni.select("muni_id", "muni_name", "district", F.array(F.array(*[pt(x, y) for x, y in corners])).alias("rings"))

    @cached_property
    def settl_polygon(self) -> DataFrame:
        """Three strips for each municipality: they overlap by 40 m and stick out of it in the south and east."""
        k = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")
        m = self.muni.select("muni_id", "ox", "oy", k).withColumns({"west": F.col("ox") - 200 + F.col("k") * 560, "south": F.col("oy") - 260})

        def pt(x, y):
            return F.struct((F.col("west") + x).cast("double").alias("x"), (F.col("south") + y).cast("double").alias("y"))
        ring = F.array(*[pt(x, y) for x, y in ((0, 0), (600, 0), (600, 1200), (0, 1200), (0, 0))])
        return m.select((F.col("muni_id") * 10 + F.col("k")).alias("settl_id"), "muni_id", F.array(ring).alias("rings"))

    @cached_property
    def street(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size")
        suffix = F.when(size % 2 == 0, F.concat(F.lit(" "), size.cast("string"))).otherwise(F.lit(""))
        muni = _idiv("p_partkey", 20)
        code = F.concat(F.lpad((muni % 1000000).cast("string"), 6, "0"),
                        F.when(F.col("p_type") == "SMALL", "2").otherwise("1"), F.lpad(k.cast("string"), 12, "0"))
        return self.table("part").select(
            k.alias("street_id"), code.alias("street_code"), muni.alias("muni_id"), (muni * 10 + k % 3).alias("settl_id"),
            F.concat(_pool(RGZ_NAMES, k), suffix).alias("street_name"),
            F.concat(_pool(PROPER_NAMES, k), suffix).alias("proper_name"), "p_type")

    @_kept
    def auth_address(self) -> DataFrame:
        k = F.col("c_custkey")
        muni = _idiv("c_custkey", 15)
        base = self.table("customer").select(
            k.alias("addr_key"), muni.alias("muni_key"), (muni * 20 + (k * 7) % 20).alias("street_key"),
            F.concat((1 + k % 30).cast("string"), F.when(k % 7 == 0, "a").otherwise("")).alias("house_no"),
            ((k * 7919) % 1201).alias("dx"), ((k * 10473) % 1201).alias("dy"), F.col("c_acctbal"), F.col("c_mktsegment"))
        return (base.join(self.street, F.col("street_key") == F.col("street_id"))
                .join(self.muni.select(F.col("muni_id").alias("m"), "muni_name", "ox", "oy"), F.col("muni_key") == F.col("m"))
                .select(F.col("addr_key").cast("string").alias("addr_id"), "addr_key", "muni_id", "muni_name", "settl_id", "street_id",
                        "street_code", "street_name", "proper_name", "house_no", (F.col("ox") + F.col("dx")).alias("x"),
                        (F.col("oy") + F.col("dy")).alias("y"), "c_acctbal", "c_mktsegment"))

    @_kept
    def map_entity(self) -> DataFrame:
        k, a = F.col("o_orderkey"), self.auth_address
        street = (F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, _pool(PROPER_NAMES, k)).otherwise(F.col("proper_name")))
        number = (F.when(k % 11 == 0, F.lit(None)).when(k % 6 == 0, F.concat("house_no", F.lit("b"))).otherwise(F.col("house_no")))
        kind = F.when(k % 3 == 0, "w").when(k % 50 == 1, "r").otherwise("n")
        return self.table("orders").join(a, F.col("o_custkey") == F.col("addr_key")).select(
            F.concat(kind, k.cast("string")).alias("osm_id"), k.alias("entity_key"), "muni_id", street.alias("street"), number.alias("house_no"),
            F.when(F.col("o_orderpriority") == "1-URGENT", F.col("addr_id")).alias("house_ref"),
            (F.col("x") + (k * 31) % 301 - 150 + F.when(F.col("muni_id") % 4 == 3, 1600).otherwise(0)).alias("x"),
            (F.col("y") + (k * 17) % 301 - 150).alias("y"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).withColumn("rings", self._building())

    @staticmethod
    def _building() -> Column:
        """A square of 24 m around ways, nothing for nodes and relations."""
        corner = lambda dx, dy: F.struct((F.col("x") + dx).cast("double").alias("x"), (F.col("y") + dy).cast("double").alias("y"))
        return F.when(F.col("entity_key") % 3 == 0, F.array(F.array(corner(-12, -12), corner(12, -12), corner(12, 12), corner(-12, 12), corner(-12, -12))))

    @cached_property
    def map_building(self) -> DataFrame:
        k = F.col("addr_key")
        return self.auth_address.select(
            F.concat(F.when(k % 41 == 0, "n").otherwise("w"), (k + 9000000000).cast("string")).alias("osm_id"), "addr_key", "muni_id",
            (F.col("x") - 15).alias("xmin"), (F.col("y") - 15).alias("ymin"), (F.col("x") + 15).alias("xmax"), (F.col("y") + 15).alias("ymax"),
            F.when(k % 3 == 0, F.col("proper_name")).alias("street"), F.when(k % 4 < 3, F.col("house_no")).alias("house_no_all"),
            F.when(k % 3 == 0, F.when(k % 4 < 3, F.col("house_no"))).alias("house_no"),
            F.when(k % 20 == 0, "apartments").otherwise("yes").alias("building"), (k % 28 == 0).alias("has_note")).drop("house_no_all")

    @_kept
    def building_polygon(self) -> DataFrame:
        def pt(x, y):
            return F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        ring = F.array(pt("xmin", "ymin"), pt("xmax", "ymin"), pt("xmax", "ymax"), pt("xmin", "ymax"), pt("xmin", "ymin"))
        return self.map_building.select("*", F.array(ring).alias("rings"))

    @_kept
    def map_node(self) -> DataFrame:
        k = F.col("o_orderkey")
        number = F.when(k % 9 == 0, F.concat("house_no", (k % 3).cast("string"))).when(k % 13 == 0, F.lit(None)).otherwise(F.col("house_no"))
        return self.table("orders").join(self.auth_address, F.col("o_custkey") == F.col("addr_key")).select(
            F.concat(F.lit("n"), (k + 8000000000).cast("string")).alias("osm_id"), k.alias("node_key"), "muni_id",
            F.when(k % 10 != 0, F.col("proper_name")).alias("street"), number.alias("house_no"),
            (F.col("o_orderstatus") == "F").alias("is_poi"), (F.col("o_orderstatus") != "F").alias("is_simple"),
            (k % 31 == 0).alias("has_note"),
            (F.col("x") + (k * 7) % 61 - 30).alias("x"), (F.col("y") + (k * 11) % 61 - 30).alias("y"))

    @cached_property
    def street_vertex(self) -> DataFrame:
        s = self.street.join(self.muni.select(F.col("muni_id").alias("m"), "ox", "oy"), F.col("muni_id") == F.col("m"))
        return s.select("*", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("pos")).select(
            "street_id", "street_code", "muni_id", "settl_id", "street_name", "proper_name", "pos",
            (F.col("ox") + F.col("pos") * 200).alias("x"),
            (F.col("oy") + (F.col("street_id") % 20) * 60 + (F.col("pos") * 37 * (F.col("street_id") + 1)) % 23).alias("y"))

    @_kept
    def street_line(self) -> DataFrame:
        """One row per authority street with ``lines array<array<struct<x,y>>>``; five fixed vertices per street."""
        s = self.street.join(self.muni.select(F.col("muni_id").alias("m"), "ox", "oy"), F.col("muni_id") == F.col("m"))
        pts = [F.struct((F.col("ox") + p * 200).cast("double").alias("x"),
                        (F.col("oy") + (F.col("street_id") % 20) * 60 + (p * 37 * (F.col("street_id") + 1)) % 23).cast("double").alias("y"))
               for p in range(1, 6)]
        return s.select("street_id", "street_code", "muni_id", "settl_id", "street_name", "proper_name", F.array(F.array(*pts)).alias("lines"))

    @cached_property
    def way_base(self) -> DataFrame:
        k = F.col("o_orderkey")
        ways = self.table("orders").select(k, F.floor(k * 2 / 15).alias("street_key"), "o_orderpriority", "o_orderstatus",
                                           (1 + k % 3).alias("p0"), ((k * 7) % 45).alias("shift"))
        j = ways.join(self.street, F.col("street_key") == F.col("street_id")).join(
            self.muni.select(F.col("muni_id").alias("m"), "ox", "oy"), F.col("muni_id") == F.col("m"))
        name = (F.when(k % 4 == 3, F.lit(None)).when(k % 9 == 0, F.col("street_name"))
                .when(k % 5 == 1, _pool(PROPER_NAMES, k)).otherwise(F.col("proper_name")))
        return j.select(
            F.concat(F.lit("w"), k.cast("string")).alias("osm_id"), k.alias("way_key"), "muni_id", "street_id", "proper_name", "street_name",
            name.alias("name"), F.when(F.col("o_orderpriority") == "1-URGENT", F.col("street_code")).alias("street_ref"),
            F.when(F.col("o_orderstatus") == "P", "footway").otherwise("residential").alias("highway"),
            F.when(k % 97 == 0, "square").alias("place"), F.when(k % 89 == 0, "yes").alias("bridge"), "p0", "shift", "ox", "oy")

    @staticmethod
    def _way_xy(pos: Column) -> tuple[Column, Column]:
        x = F.col("ox") + pos * 200 + 10
        y = F.col("oy") + (F.col("street_id") % 20) * 60 + (pos * 37 * (F.col("street_id") + 1)) % 23 + F.col("shift")
        return x, y

    @cached_property
    def way_vertex(self) -> DataFrame:
        w = self.way_base.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos"))
        x, y = self._way_xy(F.col("p0") + F.col("pos"))
        return w.select("osm_id", "way_key", "muni_id", "name", "street_ref", "highway", "place", "bridge", "pos", x.alias("x"), y.alias("y"))

    @_kept
    def way_line(self) -> DataFrame:
        pts = []
        for i in range(3):
            x, y = self._way_xy(F.col("p0") + i)
            pts.append(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
        return self.way_base.select("osm_id", "way_key", "muni_id", "name", "street_ref", "highway", "place", "bridge", "proper_name",
                                    "street_name", F.array(F.array(*pts)).alias("lines"))

    @cached_property
    def auth_old(self) -> DataFrame:
        return self.auth_address.where("c_acctbal >= -500")

    @cached_property
    def auth_new(self) -> DataFrame:
        k, a = F.col("addr_key"), self.auth_address.where("c_acctbal < 9000")
        reissued = F.col("c_mktsegment") == "MACHINERY"
        return a.withColumns({
            "addr_id": F.when(reissued, F.concat(F.lit("R"), "addr_id")).otherwise(F.col("addr_id")),
            "house_no": F.when((F.col("c_mktsegment") == "BUILDING") & (k % 2 == 0), F.concat("house_no", F.lit("c"))).otherwise(F.col("house_no")),
            "x": F.col("x") + F.when(reissued, (k % 7) * 20).when(F.col("c_mktsegment") == "FURNITURE", 3).otherwise(0)})

    @cached_property
    def housing(self) -> DataFrame:
        k = F.col("addr_key")
        return self.auth_address.select(k.alias("hc_id"), "muni_id", F.concat(F.lit("СЗ "), "addr_id").alias("hc_name"),
                                        F.when(k % 17 == 0, F.concat("proper_name", F.lit("."))).otherwise(F.col("proper_name")).alias("hc_street"),
                                        F.when(k % 45 == 0, "999").otherwise(F.col("house_no")).alias("hc_house_no"))

    @cached_property
    def way_node(self) -> DataFrame:
        return self.table("lineitem").select(F.col("l_orderkey").alias("way_id"), F.col("l_partkey").alias("node_id")).distinct()

    @cached_property
    def map_change(self) -> DataFrame:
        """Map rows as they are after each event: an event concerns one of seven entities of its user."""
        e = self.table("events").select("event_id", "user_id", "event_type", (F.col("user_id") * 100 + F.col("event_id") % 7).alias("entity_key"))
        kind, east = F.col("event_type"), F.when(F.col("event_type") == "signup", 45).otherwise(0)
        shifted = F.transform("rings", lambda r: F.transform(r, lambda p: F.struct((p["x"] + east).alias("x"), p["y"].alias("y"))))
        return e.join(self.map_entity, "entity_key").select(
            F.col("event_id").alias("change_no"), F.when(kind == "error", "delete").otherwise("modify").alias("action"), "osm_id", "muni_id", "street",
            F.when(kind == "click", (1 + F.col("event_id") % 30).cast("string")).otherwise(F.col("house_no")).alias("house_no"),
            F.when(kind == "purchase", F.col("user_id").cast("string")).when(kind != "view", F.col("house_ref")).alias("house_ref"),
            (F.col("x") + east).alias("x"), "y", shifted.alias("rings"))


# name -> (needed CTEs, SQL body) for DuckDB
CTES: dict[str, tuple[list[str], str]] = {
    "muni": ([], """
      SELECT s_suppkey AS muni_id, s_name AS muni_name, s_nationkey AS district, (s_suppkey % 40) * 3000 AS ox,
             cast(floor(s_suppkey / 40) AS bigint) * 3000 AS oy FROM supplier"""),
    "muni_ring": (["muni"], """
      SELECT muni_id, muni_name, c.pos, ox + c.cx AS x, oy + c.cy AS y FROM muni,
        (VALUES (1,-200,-200),(2,1400,-200),(3,1400,1000),(4,600,1400),(5,-200,1000)) AS c(pos,cx,cy)"""),
    "muni_edge": (["muni_ring"], """
      SELECT a.muni_id, a.muni_name, a.pos, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM muni_ring a JOIN muni_ring b ON a.muni_id = b.muni_id AND b.pos = a.pos % 5 + 1"""),
    "settl_box": (["muni"], """
      SELECT muni_id * 10 + k AS settl_id, muni_id, ox - 200 + k * 560 AS bx0, oy - 260 AS by0, ox + 400 + k * 560 AS bx1, oy + 940 AS by1 FROM muni, range(0, 3) AS r(k)"""),
    "street": ([], f"""
      SELECT p_partkey AS street_id,
        lpad(cast(cast(floor(p_partkey / 20) AS bigint) % 1000000 AS varchar), 6, '0') || CASE WHEN p_type = 'SMALL' THEN '2' ELSE '1' END
          || lpad(cast(p_partkey AS varchar), 12, '0') AS street_code,
        cast(floor(p_partkey / 20) AS bigint) AS muni_id, cast(floor(p_partkey / 20) AS bigint) * 10 + p_partkey % 3 AS settl_id,
        {_duck_pool(RGZ_NAMES, 'p_partkey')} || CASE WHEN p_size % 2 = 0 THEN ' ' || p_size ELSE '' END AS street_name,
        {_duck_pool(PROPER_NAMES, 'p_partkey')} || CASE WHEN p_size % 2 = 0 THEN ' ' || p_size ELSE '' END AS proper_name, p_type
      FROM part"""),
    "auth_address": (["street", "muni"], """
      SELECT cast(c_custkey AS varchar) AS addr_id, c_custkey AS addr_key, s.muni_id, m.muni_name, s.settl_id, s.street_id, s.street_code,
        s.street_name, s.proper_name, cast(1 + c_custkey % 30 AS varchar) || CASE WHEN c_custkey % 7 = 0 THEN 'a' ELSE '' END AS house_no,
        m.ox + (c_custkey * 7919) % 1201 AS x, m.oy + (c_custkey * 10473) % 1201 AS y, c_acctbal, c_mktsegment
      FROM customer JOIN street s ON s.street_id = cast(floor(c_custkey / 15) AS bigint) * 20 + (c_custkey * 7) % 20
      JOIN muni m ON m.muni_id = cast(floor(c_custkey / 15) AS bigint)"""),
    "map_entity": (["auth_address"], f"""
      SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'w' WHEN o_orderkey % 50 = 1 THEN 'r' ELSE 'n' END || o_orderkey AS osm_id,
        o_orderkey AS entity_key, muni_id,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN {_duck_pool(PROPER_NAMES, 'o_orderkey')} ELSE proper_name END AS street,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 6 = 0 THEN house_no || 'b' ELSE house_no END AS house_no,
        CASE WHEN o_orderpriority = '1-URGENT' THEN addr_id END AS house_ref,
        x + (o_orderkey * 31) % 301 - 150 + CASE WHEN muni_id % 4 = 3 THEN 1600 ELSE 0 END AS x, y + (o_orderkey * 17) % 301 - 150 AS y, o_orderstatus AS status, o_totalprice AS price,
        CASE WHEN o_orderkey % 3 = 0 THEN 12 ELSE 0 END AS half
      FROM orders JOIN auth_address ON addr_key = o_custkey"""),
    "map_building": (["auth_address"], """
      SELECT CASE WHEN addr_key % 41 = 0 THEN 'n' ELSE 'w' END || (addr_key + 9000000000) AS osm_id, addr_key, muni_id,
        x - 15 AS xmin, y - 15 AS ymin, x + 15 AS xmax, y + 15 AS ymax, CASE WHEN addr_key % 3 = 0 THEN proper_name END AS street,
        CASE WHEN addr_key % 3 = 0 AND addr_key % 4 < 3 THEN house_no END AS house_no,
        CASE WHEN addr_key % 20 = 0 THEN 'apartments' ELSE 'yes' END AS building, addr_key % 28 = 0 AS has_note FROM auth_address"""),
    "map_node": (["auth_address"], """
      SELECT 'n' || (o_orderkey + 8000000000) AS osm_id, o_orderkey AS node_key, muni_id,
        CASE WHEN o_orderkey % 10 <> 0 THEN proper_name END AS street,
        CASE WHEN o_orderkey % 9 = 0 THEN house_no || (o_orderkey % 3) WHEN o_orderkey % 13 = 0 THEN NULL ELSE house_no END AS house_no,
        o_orderstatus = 'F' AS is_poi, o_orderstatus <> 'F' AS is_simple, o_orderkey % 31 = 0 AS has_note,
        x + (o_orderkey * 7) % 61 - 30 AS x, y + (o_orderkey * 11) % 61 - 30 AS y
      FROM orders JOIN auth_address ON addr_key = o_custkey"""),
    "street_vertex": (["street", "muni"], """
      SELECT street_id, street_code, s.muni_id, settl_id, street_name, proper_name, pos, ox + pos * 200 AS x,
        oy + (street_id % 20) * 60 + (pos * 37 * (street_id + 1)) % 23 AS y
      FROM street s JOIN muni m ON m.muni_id = s.muni_id, range(1, 6) AS r(pos)"""),
    "street_segment": (["street_vertex"], """
      SELECT a.street_id, a.street_code, a.muni_id, a.pos AS seg, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM street_vertex a JOIN street_vertex b ON a.street_id = b.street_id AND b.pos = a.pos + 1"""),
    "way_base": (["street", "muni"], f"""
      SELECT 'w' || o_orderkey AS osm_id, o_orderkey AS way_key, s.muni_id, s.street_id, s.proper_name, s.street_name,
        CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 9 = 0 THEN s.street_name
             WHEN o_orderkey % 5 = 1 THEN {_duck_pool(PROPER_NAMES, 'o_orderkey')} ELSE s.proper_name END AS name,
        CASE WHEN o_orderpriority = '1-URGENT' THEN s.street_code END AS street_ref,
        CASE WHEN o_orderstatus = 'P' THEN 'footway' ELSE 'residential' END AS highway,
        CASE WHEN o_orderkey % 97 = 0 THEN 'square' END AS place, CASE WHEN o_orderkey % 89 = 0 THEN 'yes' END AS bridge,
        1 + o_orderkey % 3 AS p0, (o_orderkey * 7) % 45 AS shift, ox, oy
      FROM orders JOIN street s ON s.street_id = cast(floor(o_orderkey * 2 / 15) AS bigint) JOIN muni m ON m.muni_id = s.muni_id"""),
    "way_vertex": (["way_base"], """
      SELECT osm_id, way_key, muni_id, name, street_ref, highway, place, bridge, pos, ox + (p0 + pos) * 200 + 10 AS x,
        oy + (street_id % 20) * 60 + ((p0 + pos) * 37 * (street_id + 1)) % 23 + shift AS y
      FROM way_base, range(0, 3) AS r(pos)"""),
    "way_segment": (["way_vertex"], """
      SELECT a.osm_id, a.way_key, a.muni_id, a.name, a.street_ref, a.highway, a.pos AS seg, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
      FROM way_vertex a JOIN way_vertex b ON a.osm_id = b.osm_id AND b.pos = a.pos + 1"""),
    "auth_old": (["auth_address"], "SELECT * FROM auth_address WHERE c_acctbal >= -500"),
    "auth_new": (["auth_address"], """
      SELECT * REPLACE (CASE WHEN c_mktsegment = 'MACHINERY' THEN 'R' || addr_id ELSE addr_id END AS addr_id,
        CASE WHEN c_mktsegment = 'BUILDING' AND addr_key % 2 = 0 THEN house_no || 'c' ELSE house_no END AS house_no,
        x + CASE WHEN c_mktsegment = 'MACHINERY' THEN (addr_key % 7) * 20 WHEN c_mktsegment = 'FURNITURE' THEN 3 ELSE 0 END AS x)
      FROM auth_address WHERE c_acctbal < 9000"""),
    "housing": (["auth_address"], """
      SELECT addr_key AS hc_id, muni_id, 'СЗ ' || addr_id AS hc_name,
        CASE WHEN addr_key % 17 = 0 THEN proper_name || '.' ELSE proper_name END AS hc_street,
        CASE WHEN addr_key % 45 = 0 THEN '999' ELSE house_no END AS hc_house_no FROM auth_address"""),
    "way_node": ([], "SELECT DISTINCT l_orderkey AS way_id, l_partkey AS node_id FROM lineitem"),
    "map_change": (["map_entity"], """
      SELECT event_id, event_type, m.osm_id, m.muni_id, street, CASE WHEN event_type = 'click' THEN cast(1 + event_id % 30 AS varchar) ELSE house_no END AS house_no,
        CASE WHEN event_type = 'purchase' THEN cast(user_id AS varchar) WHEN event_type <> 'view' THEN house_ref END AS house_ref,
        x + CASE WHEN event_type = 'signup' THEN 45 ELSE 0 END AS x, y, half
      FROM events JOIN map_entity m ON entity_key = user_id * 100 + event_id % 7"""),
    "map_after": (["map_entity", "map_change"], """
      SELECT osm_id, muni_id, street, house_no, house_ref, x, y, half FROM map_entity WHERE osm_id NOT IN (SELECT osm_id FROM map_change)
      UNION ALL
      SELECT osm_id, muni_id, street, house_no, house_ref, x, y, half FROM (
        SELECT *, row_number() OVER (PARTITION BY osm_id ORDER BY event_id DESC) AS rn FROM map_change) WHERE rn = 1 AND event_type <> 'error'"""),
}


def duck(body: str, *needs: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """Put the needed CTEs, in dependency order, in front of ``body``."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(name: str) -> None:
        for d in known[name][0]:
            visit(d)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({known[n][1]})" for n in order) + "\n" + body.strip()
