"""Authority registers: CSV and INSPIRE loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from addrweave.functions import geometry as G
from addrweave.functions import projection as P
from addrweave.functions import text as T
from addrweave.options import DEFAULTS, Options


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


ADDRESS_CSV = strings("kucni_broj_id", "kucni_broj", "opstina_maticni_broj", "opstina_ime", "opstina_ime_lat", "naselje_maticni_broj", "naselje_ime",
                      "ulica_maticni_broj", "ulica_ime", "vrsta_stanja", "retired", "geometry")
STREET_CSV = strings("opstina_ime", "opstina_ime_lat", "naselje_maticni_broj", "naselje_ime", "ulica_maticni_broj", "ulica_ime", "geometry")
ACTIVE = "АКТИВАН"  # fixed value: state of a living address
# Names of three municipalities that share their plain name with another one.
NAME_OVERRIDES = {"5835": "Općina Privlaka", "3140": "Općina Otok", "4324": "Općina Sveta Nedelja"}
MUNICIPALITY_TYPE = "Jedinica lokalne samouprave"  # fixed value


def _read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    df = spark.read.schema(schema).csv(path, header=True, enforceSchema=False, multiLine=False)
    return df.withColumn("file_muni", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.csv", 1))


def load_addresses(spark: SparkSession, path: str, options: Options = DEFAULTS) -> DataFrame:
    """Active addresses of all municipality files as one table, points in degrees; rows with a bad point or of another municipality are dropped."""
    d = _read_csv(spark, path, ADDRESS_CSV)
    mx, my = G.parse_wkt_point("geometry")
    lon, lat = P.from_utm(F.col("mx"), F.col("my"), options.metric_crs)
    ok = (F.col("vrsta_stanja") == ACTIVE) & (F.coalesce("retired", F.lit("")) == "") & (T.norm("opstina_ime_lat") == F.url_decode("file_muni"))
    d = d.where(ok).withColumns({"mx": mx, "my": my}).where("mx IS NOT NULL AND my IS NOT NULL")
    return d.select(F.col("kucni_broj_id").alias("addr_id"), F.col("kucni_broj").alias("house_no"), F.col("opstina_maticni_broj").alias("muni_id"),
                    F.col("opstina_ime").alias("muni_name"), F.col("naselje_maticni_broj").alias("settl_id"), F.col("naselje_ime").alias("settl_name"),
                    F.col("ulica_maticni_broj").alias("street_code"), F.col("ulica_ime").alias("street_name"), F.col("mx").alias("x"), F.col("my").alias("y"),
                    lon.alias("lon"), lat.alias("lat"))


def load_streets(spark: SparkSession, path: str, options: Options = DEFAULTS) -> DataFrame:
    """Streets of all municipality files; a file with a house-number id column holds addresses and is refused."""
    heads = spark.read.text(path, wholetext=False).where(F.col("value").rlike(r'(^|,)"?kucni_broj_id"?(,|$)'))  # of any file of the folder
    wrong = heads.select(F.col("_metadata.file_name").alias("f")).limit(1).collect()
    if wrong:
        raise ValueError(f"{wrong[0].f} holds addresses, not streets")
    d = _read_csv(spark, path, STREET_CSV)
    parts = G.parse_wkt_parts("geometry")
    d = d.where(T.norm("opstina_ime_lat") == F.url_decode("file_muni")).withColumn("lines", parts).where("lines IS NOT NULL")
    return d.select(F.col("opstina_ime").alias("muni_name"), F.col("naselje_maticni_broj").alias("settl_id"), F.col("naselje_ime").alias("settl_name"),
                    F.col("ulica_maticni_broj").alias("street_code"), F.col("ulica_ime").alias("street_name"), "lines")


def split_by_muni(df: DataFrame, path: str, code: str = "muni_id", name: str = "muni_name") -> None:
    """One folder per municipality code; rows without code or name are left out."""
    df.where(F.col(code).isNotNull() & F.col(name).isNotNull()).write.mode("overwrite").partitionBy(code).parquet(path)


def consolidate_inspire(address: DataFrame, thoroughfare: DataFrame, postal: DataFrame, admin_unit: DataFrame, settlement: DataFrame, muni: DataFrame) -> DataFrame:
    """Star join of the INSPIRE parts; plain equi joins, so Spark broadcasts the parts that are small and shuffles the others."""
    a = address.alias("a")
    j = (a.join(thoroughfare.select(F.col("gml_id").alias("thoroughfare_name_id"), F.col("inspire_id").alias("street_code"), F.col("name").alias("street_name")), "thoroughfare_name_id")
         .join(postal.select(F.col("gml_id").alias("postal_descriptor_id"), "postcode"), "postal_descriptor_id")
         .join(admin_unit.select(F.col("gml_id").alias("admin_unit_1"), F.col("inspire_id").alias("settl_inspire_id"), F.col("name").alias("settl_name")), "admin_unit_1")
         .join(settlement.select(F.col("inspire_id").alias("settl_inspire_id"), "settl_id", "muni_inspire_id"), "settl_inspire_id")
         .join(muni.select(F.col("inspire_id").alias("muni_inspire_id"), "muni_id", "muni_name"), "muni_inspire_id"))
    return j.select(T.strip_id("inspire_id", r"^KB\.0*").alias("addr_id"), "muni_id", "muni_name", "settl_id", "settl_name", "settl_inspire_id", "street_code",
                    "street_name", F.col("designators").alias("house_no"), "postcode", "lon", "lat")


def consolidate_inspire_by_unit(address: DataFrame, thoroughfare: DataFrame, postal: DataFrame, admin_unit: DataFrame, muni: DataFrame) -> DataFrame:
    """The five-part variant: no settlement table, municipality joined on two stripped ids."""
    j = (address.withColumn("_unit", T.strip_id("admin_unit_2", r"^SI\.GURS\.RPE\."))
         .join(thoroughfare.select(F.col("gml_id").alias("thoroughfare_name_id"), F.col("inspire_id").alias("street_code"), F.col("name").alias("street_name")), "thoroughfare_name_id")
         .join(postal.select(F.col("gml_id").alias("postal_descriptor_id"), "postcode"), "postal_descriptor_id")
         .join(admin_unit.select(F.col("gml_id").alias("admin_unit_1"), F.col("inspire_id").alias("settl_id"), F.col("name").alias("settl_name")), "admin_unit_1")
         .join(muni.select(T.strip_id("inspire_id", r"^AU\.").alias("_unit"), "muni_id", "muni_name"), "_unit"))
    return j.select(T.strip_id("inspire_id", r"^HS\.").alias("addr_id"), "muni_id", "muni_name", "settl_id", "settl_name", F.col("settl_id").alias("settl_inspire_id"),
                    "street_code", "street_name", F.col("designators").alias("house_no"), "postcode", "lon", "lat")


def settlement_bounds(settlement: DataFrame, muni: DataFrame) -> DataFrame:
    """Settlement boundaries with their municipality."""
    return settlement.join(muni.select(F.col("inspire_id").alias("muni_inspire_id"), "muni_id", "muni_name"), "muni_inspire_id").drop("muni_inspire_id")


def munis_as_settlements(muni: DataFrame) -> DataFrame:
    """I8: a municipality stands in for its settlements."""
    return muni.select(F.col("muni_id").alias("settl_id"), F.col("muni_name").alias("settl_name"), F.lit("0").alias("settl_area"), "muni_id", "muni_name", "rings")


_POLYGON = "exterior STRUCT<LinearRing: STRUCT<posList: STRING>>"
_XML = """
  `_id` STRING, nationalCode STRING, inspireId STRUCT<Identifier: STRUCT<localId: STRING>>,
  nationalLevelName STRUCT<LocalisedCharacterString: ARRAY<STRING>>,
  name STRUCT<GeographicalName: STRUCT<spelling: STRUCT<SpellingOfName: STRUCT<text: STRING>>>>,
  upperLevelUnit STRUCT<`_href`: STRING, `_title`: STRING>,
  geometry STRUCT<MultiSurface: STRUCT<surfaceMember: ARRAY<STRUCT<Polygon: STRUCT<{p}>>>>, Polygon: STRUCT<{p}>>
""".format(p=_POLYGON)


def load_admin_units(spark: SparkSession, path: str, admin_type: str, id_from_gml: bool = False) -> DataFrame:
    """Administrative units of one type from GML, through Spark's XML source with a fixed schema (codes stay text).

    Exterior rings only; coordinates are stored latitude first and are swapped. Codes lose leading zeros; three names are overruled.
    """
    d = (spark.read.format("xml").option("rowTag", "AdministrativeUnit").option("ignoreNamespace", "true").option("attributePrefix", "_").schema(_XML).load(path))
    d = d.where(F.exists("nationalLevelName.LocalisedCharacterString", lambda t: t.contains(admin_type)))
    bare = F.regexp_replace(F.trim("nationalCode"), "^0+", "")
    code = F.when(F.coalesce("nationalCode", F.lit("")) == "", "").when(bare == "", "0").otherwise(bare)
    lists = F.filter(F.concat(F.coalesce(F.transform("geometry.MultiSurface.surfaceMember", lambda m: m["Polygon"]["exterior"]["LinearRing"]["posList"]), F.expr("CAST(array() AS array<string>)")),
                              F.array("geometry.Polygon.exterior.LinearRing.posList")), lambda s: s.isNotNull())

    def ring(pos: Column) -> Column:
        nums = F.transform(F.split(F.trim(pos), r"\s+"), lambda n: n.try_cast("double"))
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(nums) / 2).cast("int") - 1), lambda i: F.struct(
            F.element_at(nums, 2 * i + 2).alias("x"), F.element_at(nums, 2 * i + 1).alias("y")))
    name = F.trim("name.GeographicalName.spelling.SpellingOfName.text")
    parent = F.replace(F.coalesce("upperLevelUnit._href", F.lit("")), F.lit("#"), F.lit(""))
    overrides = F.create_map(*[F.lit(x) for kv in NAME_OVERRIDES.items() for x in kv])
    own = F.coalesce(F.try_element_at(overrides, code), name) if admin_type == MUNICIPALITY_TYPE else name
    inspire = F.col("_id") if id_from_gml else F.trim("inspireId.Identifier.localId")
    return d.select(code.alias("code"), F.coalesce(own, F.lit("")).alias("name"), F.coalesce(inspire, F.lit("")).alias("inspire_id"), parent.alias("parent_id"),
                    F.coalesce(F.try_element_at(overrides, parent), F.trim("upperLevelUnit._title"), F.lit("")).alias("parent_name"), F.transform(lists, ring).alias("rings"))


def load_curated(spark: SparkSession, path: str) -> DataFrame:
    """Curated names."""
    return spark.read.schema(strings("rgz_name", "name")).csv(path, header=True)


def reshape_sheet(sheet: DataFrame) -> DataFrame:
    """Crowd-edited sheet ``rgz, name, ispravka``: a fix wins over the name, ``-`` is no fix, blanks are left out, in name order."""
    fix = F.nullif(F.nullif("ispravka", F.lit("-")), F.lit(""))
    d = sheet.select(F.col("rgz").alias("rgz_name"), F.coalesce(fix, F.nullif("name", F.lit(""))).alias("name"))
    return d.where(F.col("name").isNotNull() & (F.coalesce("rgz_name", F.lit("")) != "")).orderBy("rgz_name")
