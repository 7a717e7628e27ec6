"""Raster fixtures as views over the driver's tables: the same derivations as in ``oracle``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.functions.masks import CLASSES
from rasterloom.functions.scaling import SOIL_DIVISORS
from rasterloom.model import Grid
from rasterloom.operators.scenes import date_list, windows_from

N_COLS = 50
#: Land-cover codes.
LC_CODES = [0, 20, 31, 32, 33, 40, 50, 80, 81, 100, 210, 220, 230]
YEARS = (1995, 2001)
LS = ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B6", "SR_B7"]
S2 = ["B1", "B2", "B3", "B4", "B5", "B6", "B7", "B8", "B8A", "B9", "B11", "B12"]
FINE = Grid(N_COLS, 0, 170616.1822, 6659532.4311, 30.0, -30.0, "EPSG:3400")


class Fixture:
    """Frames of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self.read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")

    def n_rows(self) -> int:
        return self.read("part").count() // N_COLS  # from the file's footer

    def grid(self) -> Grid:
        return Grid(N_COLS, self.n_rows())

    @staticmethod
    def at(key: str) -> list[Column]:
        return [(F.col(key) % N_COLS).cast("int").alias("col"), F.floor(F.col(key) / N_COLS).cast("int").alias("row")]

    def scenes(self) -> DataFrame:
        p, y = F.substring("o_orderpriority", 1, 1), F.year("o_orderdate")
        mixed = F.when(p == "1", "LT05").when(p == "2", "LC08").when(p == "3", "LC09").otherwise("LE07")
        sensor = (
            F.when(y == 1995, F.when(p.isin("1", "2", "3"), "LT05").otherwise("LE07"))
            .when(y == 1997, F.when(p.isin("1", "2"), "LC08").when(p == "3", "LC09").otherwise("LE07"))
            .when(y == 1999, F.when(p == "1", "LC09").otherwise("LE07")).when(y.isin(1996, 2000, 2001), mixed).otherwise("LE07")
        )
        return self.read("orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_orderdate").cast("timestamp").alias("time_start"), ((F.col("o_orderkey") * 37) % 100).cast("int").alias("cloud_pct"), sensor.alias("sensor"))

    def _lines(self) -> DataFrame:
        names = ["l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        first = self.read("lineitem").groupBy("l_orderkey", "l_partkey").agg(F.min(F.struct(*names)).alias("x"))
        return first.select("l_orderkey", "l_partkey", "x.*")

    @staticmethod
    def _reflectance() -> dict[str, Column]:
        d, t, q, p = F.col("l_discount"), F.col("l_tax"), F.col("l_quantity"), F.col("l_extendedprice")
        return {"b1": 0.02 + d, "b2": 0.03 + t, "b3": 0.02 + q / 500, "b4": 0.1 + p / 300000, "b5": 0.05 + d + t, "b6": 0.04 + 2 * t, "b7": 0.01 + q / 400}

    def pixels_ls(self) -> DataFrame:
        r = self._reflectance()
        dn = lambda c: F.round((c + 0.2) / 0.0000275).cast("bigint")
        bands = {f"SR_B{i}": dn(r[f"b{i}"]) for i in range(1, 8)}
        bands["SR_B1"] = F.when(F.col("l_suppkey") % 17 == 0, 6000).otherwise(bands["SR_B1"]).cast("bigint")
        return self._lines().select(
            F.col("l_orderkey").alias("image_id"), *self.at("l_partkey"), *[c.alias(n) for n, c in bands.items()], (40000 + F.col("l_quantity").cast("bigint") * 100).alias("ST_B6"),
            ((F.col("l_suppkey") * 7 + F.col("l_linenumber") * 13) % 64).cast("bigint").alias("QA_PIXEL"), F.when(F.col("l_linenumber") == 7, 512).otherwise(0).cast("bigint").alias("QA_RADSAT"),
        )

    def pixels_s2(self) -> DataFrame:
        r = self._reflectance()
        t, d, q = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity")
        src = {"B1": r["b1"], "B2": r["b1"], "B3": r["b2"], "B4": r["b3"], "B5": 0.05 + t, "B6": 0.1 + d, "B7": 0.12 + q / 400, "B8": r["b4"], "B8A": r["b4"], "B9": F.lit(0.05), "B11": r["b5"], "B12": r["b7"]}
        return self._lines().select(
            F.col("l_orderkey").alias("image_id"), *self.at("l_partkey"), *[F.round(c * 10000).cast("bigint").alias(n) for n, c in src.items()],
            ((F.col("l_linenumber") % 4) * 1024).cast("bigint").alias("QA60"), (F.col("l_suppkey") % 12).cast("bigint").alias("SCL"),
        )

    def dem(self) -> DataFrame:
        return self.read("part").select(*self.at("p_partkey"), F.col("p_retailprice").alias("elevation"))

    def dem_gaps(self) -> DataFrame:
        """The elevations with masked cells."""
        return self.dem().withColumn("elevation", F.when((F.col("col") * 7 + F.col("row") * 3) % 11 != 0, F.col("elevation")))

    def upslope(self) -> DataFrame:
        return self.read("part").select(*self.at("p_partkey"), ((F.col("p_size") + 1) / 100).alias("upa"))

    def _yearly(self) -> DataFrame:
        return self.read("part").withColumn("year", F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1]))))

    def landcover(self) -> DataFrame:
        code = F.element_at(F.array(*[F.lit(c) for c in LC_CODES]), ((F.col("p_size") + F.col("year")) % len(LC_CODES) + 1).cast("int"))
        return self._yearly().select("year", *self.at("p_partkey"), code.alias("b1"))

    def species(self) -> DataFrame:
        return self._yearly().select("year", *self.at("p_partkey"), ((F.col("p_size") + F.col("year")) % 38).cast("int").alias("species"))

    def forest_age(self) -> DataFrame:
        return self.read("part").select(*self.at("p_partkey"), (2 * F.col("p_size")).cast("int").alias("age"))

    def soil(self) -> DataFrame:
        return self.read("part").select(*self.at("p_partkey"), (F.col("p_size") * 10).alias("clay_0_5cm"), (F.col("p_partkey") * 7 % 10000).cast("int").alias("ksat"), (F.col("p_size") % 6 + 1).alias("stc"))

    def phenology(self) -> DataFrame:
        return self._yearly().where("year < 1997").select("year", *self.at("p_partkey"), (F.col("p_size") * 100).alias("EVI_Minimum_1"), (F.col("p_size") * 3 + F.col("year")).alias("EVI_Area_1"))

    def phenology_bands(self) -> DataFrame:
        """All six scaled bands and one that isn't."""
        made = {f"EVI_{n}_{i}": F.col("p_size") * k + F.col("year") * i for k, n in ((100, "Minimum"), (70, "Amplitude"), (3, "Area")) for i in (1, 2)}
        return self._yearly().where("year < 1997").select("year", *self.at("p_partkey"), *[c.alias(n) for n, c in made.items()], F.col("p_size").alias("Greenup_1"))

    def soil_layers(self) -> DataFrame:
        """A layer of every soil variable."""
        return self.read("part").select(*self.at("p_partkey"), *[(F.col("p_size") * (i + 3) + F.col("p_partkey") % 7).alias(f"{n}_5-15cm_mean") for i, n in enumerate(SOIL_DIVISORS)])

    def lonlat_polygons(self) -> DataFrame:
        """Large quadrangles in longitude and latitude."""
        k = F.col("n_nationkey")
        x, y, w, h = -120 + (k * 7) % 9 * 0.75, 49 + (k * 11) % 8 * 1.0, 3 + k % 4 * 1.5, 1 + k % 3 * 1.5
        p = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
        return self.read("nation").select(k.cast("bigint").alias("feature_id"), F.lit("Polygon").alias("geom_type"), F.array(F.array(p(x, y), p(x + w, y), p(x + w, y + h), p(x, y + h))).alias("rings"))

    def conic_grid(self) -> Grid:
        """The cells as a lattice that covers those polygons, in a conic projection."""
        n = self.n_rows()
        return Grid(N_COLS, n, -1_900_000.0, 1_800_000.0, 30_000.0, -1_800_000.0 / n, "EPSG:3978")

    def class_probs(self) -> DataFrame:
        made = [F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(CLASSES)]
        month = F.lpad((F.col("vec_id") % 12 + 1).cast("string"), 2, "0")
        time = F.to_timestamp(F.concat((F.col("vec_id") % 3 + 1996).cast("string"), F.lit("-"), month, F.lit("-15")))
        cell = F.col("vec_id") % 100
        return self.read("embeddings").select((cell % N_COLS).cast("int").alias("col"), F.floor(cell / N_COLS).cast("int").alias("row"), time.alias("time_start"), *made)

    def points(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.read("customer").select(k.alias("point_id"), F.when(k % 29 == 0, -5.0).otherwise((k * 7) % N_COLS + 0.5).alias("x"), ((k * 13) % self.n_rows() + 0.5).alias("y"), (k % 10 + 1).cast("int").alias("batch"))

    def polygons(self) -> DataFrame:
        k = F.col("n_nationkey")
        x, y, s = (k * 7) % 45 + 0.25, (k * 11) % 35 + 0.25, (3 + k % 4).cast("double")
        p = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
        ring = F.when(k % 5 == 0, F.array(p(x, y), p(x + s, y), p(x, y + s))).otherwise(F.array(p(x, y), p(x + s, y), p(x + s, y + s), p(x, y + s)))
        return self.read("nation").select(k.cast("bigint").alias("feature_id"), F.lit("Polygon").alias("geom_type"), F.array(ring).alias("rings"))

    def aoi(self) -> DataFrame:
        from rasterloom.operators.zonal import rectangle

        return self.spark.range(1).select(F.col("id").alias("feature_id"), F.lit("Polygon").alias("geom_type"), rectangle(5, 0, 45, self.n_rows()).alias("rings"))

    def windows(self) -> DataFrame:
        return windows_from(date_list(self.spark, date(1995, 6, 1), date(2001, 6, 1), 1, "year"), 121)
