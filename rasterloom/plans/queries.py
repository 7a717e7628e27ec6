"""Registered queries of the raster operators over the fixtures, each with its SQL."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import crs, expr, masks, scaling
from rasterloom.functions import indices as ix
from rasterloom.model import CELL, Grid, densify
from rasterloom.operators import bands as bd
from rasterloom.operators import composite as cp
from rasterloom.operators import focal as fo
from rasterloom.operators import interpolate, qa, resample
from rasterloom.operators import scenes as sc
from rasterloom.operators import zonal as zo
from rasterloom.plans import workflows as wf
from rasterloom.plans.fixtures import LC_CODES, LS, S2, YEARS, Fixture
from rasterloom.plans.oracle import sql
from rasterloom.sources import aligned, io, tiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def add(name: str, build: Callable[[Fixture], DataFrame], body: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Fixture(spark, sf_dir))
    if body is not None:
        ORACLE_SQL[name] = sql(body)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c, t in df.dtypes if t in ("double", "float")})


def rd(columns: Sequence[str] | str, digits: int = 6) -> str:
    names = columns.split() if isinstance(columns, str) else columns
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in names)


#: Engines differ in rounding exact ties, which ratios and means of short decimals hit; this step has none at them.
STEP, OFF_TIE = 10_000_000, 0.4871


def stepped(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.floor(F.col(c) * float(STEP) + OFF_TIE) / float(STEP) for c in columns})


def step(x: str) -> str:
    return f"floor(({x}) * {STEP}.0 + {OFF_TIE}) / {STEP}.0"


def when(test: str, columns: Sequence[str]) -> str:
    return ", ".join(f"CASE WHEN {test} THEN {c} END AS {c}" for c in columns)


KEY = ["image_id", *CELL]
KEYS = "image_id, col, row"
SR = masks.SR_BANDS


def sr(fx: Fixture) -> DataFrame:
    return scaling.scale_reflectance(fx.pixels_ls(), LS)


def s2(fx: Fixture) -> DataFrame:
    return masks.mask_s2_clouds(fx.pixels_s2(), S2)


# --- quality masks -----------------------------------------------------------------------------------------------
for _name, _fn, _test in (
    ("msk1_cloud_snow", masks.mask_cloud_snow, "QA_PIXEL & 56 = 0"),
    ("msk2_cloud", masks.mask_cloud, "QA_PIXEL & 24 = 0"),
    ("msk3_negative_sr", masks.mask_negative_sr, f"least({', '.join(SR)}) >= 7273"),
    ("msk4_qa9", masks.mask_qa9, "QA_RADSAT & 512 = 0"),
    ("msk5_fill", masks.mask_fill, "QA_PIXEL & 1 = 0"),
):
    if _name == "msk3_negative_sr":
        add(_name, lambda fx: rounded(masks.mask_negative_sr(sr(fx), SR).select(*KEY, *SR), 9), f"SELECT {KEYS}, {rd(SR, 9)} FROM (SELECT {KEYS}, {when(f'least({", ".join(SR)}) >= 0', SR)} FROM sr)")
    else:
        add(_name, lambda fx, fn=_fn: fn(fx.pixels_ls(), LS).select(*KEY, *LS), f"SELECT {KEYS}, {when(_test, LS)} FROM pixels_ls")
add("msk6_s2_clouds", lambda fx: rounded(s2(fx).select(*KEY, *S2), 9), f"SELECT {KEYS}, {rd(S2, 9)} FROM s2")
for _name, _fn, _test in (("msk7_s2_snow", masks.mask_s2_snow, "SCL <> 11"), ("msk8_s2_vegetation", masks.mask_s2_vegetation, "SCL = 4"), ("msk9_s2_water", masks.mask_s2_water, "SCL <> 6")):
    add(_name, lambda fx, fn=_fn: fn(fx.pixels_s2(), S2).select(*KEY, *S2), f"SELECT {KEYS}, {when(_test, S2)} FROM pixels_s2")
add("msk10_forest_age", lambda fx: masks.mask_by_forest_age(fx.pixels_ls(), fx.forest_age(), LS).select(*KEY, *LS), f"SELECT {KEYS}, {when('age > 60', LS)} FROM pixels_ls LEFT JOIN forest_age USING (col, row)")
add("msk11_landcover", lambda fx: masks.mask_by_landcover(fx.pixels_ls(), fx.landcover(), LS, year=1999).select(*KEY, *LS), f"SELECT {KEYS}, {when('b1 = 210', LS)} FROM pixels_ls LEFT JOIN (SELECT * FROM landcover WHERE year = 1999) USING (col, row)")
_C = masks.CLASSES
add(
    "msk12_dynamic_world",
    lambda fx: masks.mask_dynamic_world(fx.landcover(), fx.class_probs(), ["b1"]),
    f"""SELECT year, col, row, CASE WHEN label = 1 THEN b1 END AS b1 FROM landcover LEFT JOIN (
        SELECT year(time_start) AS year, col, row, list_position([{", ".join(f"avg({c})" for c in _C)}], greatest({", ".join(f"avg({c})" for c in _C)})) - 1 AS label
        FROM class_probs WHERE month(time_start) BETWEEN 6 AND 9 GROUP BY ALL) USING (year, col, row)""",
)
add("msk13_unmask", lambda fx: fx.dem_gaps().select(*CELL, expr.unmask(F.col("elevation"), 0.0).alias("filled"), expr.is_masked(F.col("elevation")).alias("missing")), "SELECT col, row, coalesce(elevation, 0) AS filled, CASE WHEN elevation IS NULL THEN 1 ELSE 0 END AS missing FROM dem_gaps")

# --- indices -----------------------------------------------------------------------------------------------------


def nd(a: str, b: str) -> str:
    return f"(({a}) - ({b})) / nullif(({a}) + ({b}), 0)"


def bound(x: str, lo: float, hi: float) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"


def index_sql(name: str, s: ix.Sensor) -> str:
    r = s.roles
    evi = lambda e: f"2.5 * (({r['nir']} - {r['red']}) / nullif({r['nir']} + 6 * {r['red']} - 7.5 * {r['blue']} + 1 + {e}, 0))"
    clip = bound if s.clamped else (lambda x, lo, hi: x)
    made = {
        "BSI": lambda: nd(f"{r['red']} + {r['swir1']}", f"{r['nir']} + {r['blue']}"), "DSWI": lambda: clip(f"({r['nir']} + {r['green']}) / nullif({r['swir1']} + {r['red']}, 0)", 0, 3),
        "DRS": lambda: f"sqrt({r['red']} * {r['red']} + {r['swir1']} * {r['swir1']})", "EVI": lambda: clip(evi("0.0"), -2, 2), "GNDVI": lambda: nd(r["nir"], r["green"]),
        "LAI": lambda: clip(f"3.618 * {evi('1e-10' if s.clamped else '0.0')} - 0.118", 0, 10), "NBR": lambda: nd(r["nir"], r["swir2"]), "NDMI": lambda: nd(r["nir"], r["swir1"]), "NDSI": lambda: nd(r["green"], r["swir1"]),
        "NDVI": lambda: nd(r["nir"], r["red"]), "NDWI": lambda: nd(r["green"], r["nir"]), "SAVI": lambda: f"({r['nir']} - {r['red']}) / nullif({r['nir']} + {r['red']} + 0.428, 0) * 1.428",
        "SI": lambda: f"(1 - {r['blue']}) * (1 - {r['green']}) * (1 - {r['red']})", "CRE": lambda: f"{r['re3']} / nullif({r['re1']}, 0) - 1", "NDRE1": lambda: nd(r["re2"], r["re1"]),
        "NDRE2": lambda: nd(r["re3"], r["re1"]), "NDRE3": lambda: nd(r["re4"], r["re3"]), "RDI": lambda: f"{r['swir2']} / nullif({r['re4']}, 0)",
    }
    return made[name]()


for _n in ix.LANDSAT.indices:
    add(f"ix_ls_{_n.lower()}", lambda fx, n=_n: stepped(ix.add_indices(sr(fx), ix.LANDSAT, [n]).select(*KEY, n), n), f"SELECT {KEYS}, {step(index_sql(_n, ix.LANDSAT))} AS {_n} FROM sr")
for _n in ix.SENTINEL2.indices:
    add(f"ix_s2_{_n.lower()}", lambda fx, n=_n: stepped(ix.add_indices(s2(fx), ix.SENTINEL2, [n]).select(*KEY, n), n), f"SELECT {KEYS}, {step(index_sql(_n, ix.SENTINEL2))} AS {_n} FROM s2")
add("ix19_snow_flag", lambda fx: ix.add_snow_flag(sr(fx)).select(*KEY, "snow"), f"SELECT {KEYS}, CAST({nd('SR_B2', 'SR_B5')} > 0.4 AS INT) AS snow FROM sr")


def _with_year(fx: Fixture) -> DataFrame:
    return ix.add_indices(sr(fx), ix.LANDSAT, ["DRS"]).select(*KEY, "DRS").join(fx.scenes().select("image_id", F.year("time_start").alias("year")), "image_id")


for _cls in ([210], [220], [210, 220, 230]):
    _name = ix.ndrs_name(_cls)
    add(
        f"ix20_{_name.lower()}",
        lambda fx, c=_cls, n=_name: rounded(ix.add_ndrs(_with_year(fx), fx.landcover(), c, last_year=1999).select(*KEY, n), 6),
        f"""SELECT image_id, col, row, round((least(greatest(DRS, lo), hi) - lo) / nullif(hi - lo, 0), 6) AS {_name}
        FROM (SELECT image_id, col, row, year(time_start) AS year, sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5) AS DRS FROM sr JOIN scenes USING (image_id)) LEFT JOIN (
            SELECT image_id, min(sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5)) AS lo, max(sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5)) AS hi FROM sr JOIN scenes USING (image_id)
            JOIN landcover ON landcover.year = least(year(time_start), 1999) AND landcover.col = sr.col AND landcover.row = sr.row
            WHERE b1 IN ({", ".join(map(str, _cls))}) GROUP BY image_id) USING (image_id)""",
    )
add("ix21_stressed", lambda fx: ix.add_ndrs_stressed(sr(fx).select(*KEY, F.col("SR_B4").alias("NDRS")), fx.landcover(), "NDRS", year=1999, above=0.2).select(*KEY, "NDRS_stressed"), f"SELECT {KEYS}, CAST(coalesce(CASE WHEN b1 = 210 THEN SR_B4 END, 0) > 0.2 AS INT) AS NDRS_stressed FROM sr LEFT JOIN (SELECT * FROM landcover WHERE year = 1999) USING (col, row)")

add(
    "ix21_stressed_chain",
    lambda fx: ix.add_ndrs_stressed(ix.add_ndrs(_with_year(fx), fx.landcover(), [210], last_year=1999), fx.landcover(), "NDRS_coni", year=1999, above=0.5).select(*KEY, "NDRS_coni_stressed"),
    """SELECT image_id, x.col, x.row, CAST(coalesce(CASE WHEN b1 = 210 THEN (least(greatest(DRS, lo), hi) - lo) / nullif(hi - lo, 0) END, 0) > 0.5 AS INT) AS NDRS_coni_stressed
        FROM (SELECT image_id, col, row, sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5) AS DRS FROM sr JOIN scenes USING (image_id)) x LEFT JOIN (
            SELECT image_id, min(sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5)) AS lo, max(sqrt(SR_B3 * SR_B3 + SR_B5 * SR_B5)) AS hi FROM sr JOIN scenes USING (image_id)
            JOIN landcover ON landcover.year = least(year(time_start), 1999) AND landcover.col = sr.col AND landcover.row = sr.row WHERE b1 = 210 GROUP BY image_id) USING (image_id)
        LEFT JOIN (SELECT col, row, b1 FROM landcover WHERE year = 1999) c ON c.col = x.col AND c.row = x.row""",
)
for _n, _sensor, _from in (("landsat", ix.LANDSAT, sr), ("sentinel2", ix.SENTINEL2, s2)):
    _all = list(_sensor.indices)
    add(f"ix22_registry_{_n}", lambda fx, s=_sensor, f=_from, a=_all: stepped(ix.add_indices(f(fx), s, a).select(*KEY, *a), *a), f"SELECT {KEYS}, {', '.join(f'{step(index_sql(x, _sensor))} AS {x}' for x in _all)} FROM {'sr' if _n == 'landsat' else 's2'}")

# --- scalings and scalar operators -------------------------------------------------------------------------------
add("sc1_scale_factors", lambda fx: rounded(scaling.apply_scale_factors(fx.pixels_ls(), SR).select(*KEY, *SR, "ST_B6"), 9), f"SELECT {KEYS}, {', '.join(f'round({b} * 0.0000275 + -0.2, 9) AS {b}' for b in SR)}, round(ST_B6 * 0.00341802 + 149.0, 9) AS ST_B6 FROM pixels_ls")
add("sc2_scale_reflectance", lambda fx: rounded(sr(fx).select(*KEY, *LS), 9), f"SELECT {KEYS}, {rd(LS, 9)} FROM sr")
add(
    "sc3_harmonize",
    lambda fx: rounded(scaling.harmonize_oli_to_etm(fx.pixels_ls()).select(*KEY, "QA_PIXEL", *SR), 6),
    f"SELECT {KEYS}, QA_PIXEL, " + ", ".join(f"round(({o} - ({i} * 10000.0)) / {s}, 6) AS {n}" for (o, n), s, i in zip(scaling.OLI_TO_ETM_BANDS.items(), scaling.OLI_SLOPES, scaling.OLI_INTERCEPTS)) + " FROM pixels_ls",
)
add("sc4_modis_phenology", lambda fx: rounded(scaling.scale_modis_phenology(fx.phenology()), 3), "SELECT year, col, row, round(EVI_Minimum_1 * 0.0001, 3) AS EVI_Minimum_1, round(EVI_Area_1 * 0.1, 3) AS EVI_Area_1 FROM phenology")
_EVI = [(f"EVI_{n}_{i}", f"(p_size * {k} + year * {i}) * {f}") for k, n, f in ((100, "Minimum", 0.0001), (70, "Amplitude", 0.0001), (3, "Area", 0.1)) for i in (1, 2)]
add("sc4_modis_all_bands", lambda fx: rounded(scaling.scale_modis_phenology(fx.phenology_bands()), 3), f"SELECT CAST(year AS INT) AS year, CAST(p_partkey % 50 AS INT) AS col, CAST(p_partkey // 50 AS INT) AS row, {', '.join(f'round(CAST(CAST({x} AS FLOAT) AS DOUBLE), 3) AS {n}' for n, x in _EVI)}, p_size AS Greenup_1 FROM part, (SELECT unnest(range(1995, 1997)) AS year)")
add("sc5_soil", lambda fx: rounded(scaling.scale_soil(fx.soil().select(*CELL, "clay_0_5cm")), 4), "SELECT col, row, round(clay_0_5cm / 10.0, 4) AS clay_0_5cm FROM soil")
_SOILS = {"bdod": 100, "cec": 10, "cfvo": 10, "clay": 10, "nitrogen": 100, "ocd": 10, "ocs": 10, "phh2o": 10, "sand": 10, "silt": 10, "soc": 10}
add("sc5_soil_all_variables", lambda fx: rounded(scaling.scale_soil(fx.soil_layers()), 4), "SELECT CAST(p_partkey % 50 AS INT) AS col, CAST(p_partkey // 50 AS INT) AS row, " + ", ".join(f'round(CAST(CAST((p_size * {i + 3} + p_partkey % 7) / {d}.0 AS FLOAT) AS DOUBLE), 4) AS "{n}_5-15cm_mean"' for i, (n, d) in enumerate(_SOILS.items())) + " FROM part")
add("sc6_hydrosoil", lambda fx: rounded(scaling.scale_hydrosoil(fx.soil(), ["ksat"], ["stc"]).select(*CELL, "ksat", F.col("stc").cast("int").alias("stc")), 4), "SELECT col, row, round(ksat * 0.0001, 4) AS ksat, stc FROM soil")
add("sc7_deg2rad", lambda fx: rounded(fx.dem().select(*CELL, F.radians("elevation").alias("rad")), 9), "SELECT col, row, round(radians(elevation), 9) AS rad FROM dem")
add("sc8_clamp", lambda fx: fx.dem_gaps().select(*CELL, expr.clamp(F.col("elevation"), 910.0, 980.0).alias("z"), expr.at_least(F.col("elevation"), 950.0).alias("floor")), "SELECT col, row, CASE WHEN elevation IS NOT NULL THEN least(greatest(elevation, 910.0), 980.0) END AS z, CASE WHEN elevation IS NOT NULL THEN greatest(elevation, 950.0) END AS floor FROM dem_gaps")
add(
    "sc9_band_math",
    lambda fx: rounded(fx.soil().select(
        *CELL, F.sqrt("ksat").alias("root"), F.ln(F.col("clay_0_5cm")).alias("log"), (F.cos(F.radians("ksat")) + 2).alias("cosine"),
        ((F.col("ksat") > 500) & (F.col("stc") != 3)).cast("int").alias("wet"), F.col("ksat").cast("bigint").bitwiseAND(F.lit(12)).alias("bits"),
    )),
    """SELECT col, row, round(sqrt(ksat), 6) AS root, round(ln(clay_0_5cm), 6) AS log, round(cos(radians(ksat)) + 2, 6) AS cosine,
        CAST(ksat > 500 AND stc <> 3 AS INT) AS wet, CAST(ksat AS BIGINT) & 12 AS bits FROM soil""",
)
add("sc10_expression", lambda fx: rounded(sr(fx).select(*KEY, expr.expression("2.5 * try_divide(nir - red, nir + red + 1)", {"nir": "SR_B4", "red": "SR_B3"}).alias("v")), 8), f"SELECT {KEYS}, round(2.5 * ((SR_B4 - SR_B3) / nullif(SR_B4 + SR_B3 + 1, 0)), 8) AS v FROM sr")
add("sc11_normalized_difference", lambda fx: rounded(s2(fx).select(*KEY, expr.normalized_difference(F.col("B8"), F.col("B4")).alias("nd")), 8), f"SELECT {KEYS}, round({nd('B8', 'B4')}, 8) AS nd FROM s2")
add("sc12_casts", lambda fx: fx.soil().select(*CELL, expr.to_int16(F.col("ksat") * 9).cast("int").alias("small"), F.col("ksat").cast("double").alias("wide")), "SELECT col, row, least(greatest(ksat * 9, -32768), 32767) AS small, CAST(ksat AS DOUBLE) AS wide FROM soil")
add("sc13_remap", lambda fx: fx.landcover().select("year", *CELL, expr.remap(F.col("b1"), [210, 220, 230], [1, 2, 3]).alias("known"), expr.remap(F.col("b1"), [210, 220, 230], [1, 2, 3], 0).alias("other0")), "SELECT year, col, row, CASE b1 WHEN 210 THEN 1 WHEN 220 THEN 2 WHEN 230 THEN 3 END AS known, CASE b1 WHEN 210 THEN 1 WHEN 220 THEN 2 WHEN 230 THEN 3 ELSE 0 END AS other0 FROM landcover")
add("sc14_constant", lambda fx: fx.dem().select(*CELL, F.lit(0.9785).alias("a"), F.lit(0.9542).alias("b")), "SELECT col, row, CAST(0.9785 AS DOUBLE) AS a, CAST(0.9542 AS DOUBLE) AS b FROM dem")
add("sc15_argmax", lambda fx: fx.class_probs().select("time_start", *CELL, F.round("water", 6).alias("water"), expr.argmax([F.col(c) for c in _C]).alias("label")), f"SELECT time_start, col, row, round(water, 6) AS water, list_position([{', '.join(_C)}], greatest({', '.join(_C)})) - 1 AS label FROM class_probs")
add("sc16_names", lambda fx: bd.suffixed(expr.renamed_by(fx.soil(), r"_0_5cm$", "_top"), "_mean", CELL).withColumn("name", F.concat(F.lit("cell_"), expr.padded(F.col("col"), 3))), "SELECT col, row, clay_0_5cm AS clay_top_mean, ksat AS ksat_mean, stc AS stc_mean, 'cell_' || lpad(CAST(col AS VARCHAR), 3, '0') AS name FROM soil")
add("sc17_dates", lambda fx: fx.scenes().select("image_id", F.year("time_start").alias("year"), F.month("time_start").alias("month"), F.date_format("time_start", "yyyy-MM-dd").alias("day"), F.date_add(F.to_date("time_start"), 121).alias("until")), "SELECT image_id, CAST(year(time_start) AS INT) AS year, CAST(month(time_start) AS INT) AS month, strftime(time_start, '%Y-%m-%d') AS day, CAST(time_start AS DATE) + 121 AS until FROM scenes")
_NAMED = lambda fx: fx.scenes().select("image_id", F.concat(F.lit("scene_"), F.col("image_id"), F.when(F.col("image_id") % 4 == 0, F.concat(F.lit("_"), F.date_format("time_start", "yyyyMMdd"), F.lit("_T1"))).when(F.col("image_id") % 4 == 1, F.concat(F.lit("/"), F.date_format("time_start", "yyyy-MM-dd"), F.lit(".tif"))).when(F.col("image_id") % 4 == 2, F.date_format("time_start", " yyyy/MM/dd")).otherwise("_19991350")).alias("name"))
add("sc17_parsed_dates", lambda fx: sc.parsed_dates(_NAMED(fx), "name", "day").select("image_id", "day"), "SELECT image_id, CASE WHEN image_id % 4 < 3 THEN CAST(time_start AS DATE) END AS day FROM scenes")
_FLOORED = "SELECT DISTINCT greatest(start_date, DATE '1996-08-01') AS start_date, CAST(greatest(start_date, DATE '1996-08-01') + 121 AS DATE) AS end_date FROM windows"
add("sc18_conditional", lambda fx: sc.join_windows(fx.scenes(), sc.floor_windows(fx.windows(), date(1996, 8, 1))).groupBy("start_date", "end_date").agg(F.count("*").alias("n")), f"SELECT f.start_date, f.end_date, count(*) AS n FROM ({_FLOORED}) f JOIN scenes ON time_start >= f.start_date AND time_start < f.end_date GROUP BY ALL")
_OUTSIDE = lambda fx: fx.windows().withColumns({c: F.add_months(c, 48) for c in ("start_date", "end_date")})
add(
    "sc18_empty_collection",
    lambda fx: rounded(sc.with_empty_windows(cp.composite(_ndvi(fx, _OUTSIDE(fx)), ["NDVI"], "mean"), _OUTSIDE(fx), fx.dem())),
    f"""SELECT start_date, col, row, round(avg(v), 6) AS NDVI FROM (SELECT a AS start_date, col, row, CASE WHEN QA_PIXEL & 56 = 0 THEN {nd('SR_B4', 'SR_B3')} END AS v
        FROM sr JOIN scenes USING (image_id) JOIN (SELECT make_date(y, 6, 1) AS a, make_date(y - 4, 6, 1) + 121 + to_years(4) AS b FROM (SELECT unnest(range(1999, 2006)) AS y)) ON time_start >= a AND time_start < b WHERE cloud_pct < 80) GROUP BY ALL
        UNION ALL SELECT make_date(y, 6, 1), col, row, NULL FROM dem, (SELECT unnest(range(1999, 2006)) AS y) WHERE NOT EXISTS (SELECT 1 FROM scenes WHERE cloud_pct < 80 AND time_start >= make_date(y, 6, 1) AND time_start < make_date(y - 4, 6, 1) + 121 + to_years(4))""",
)

# --- scenes ------------------------------------------------------------------------------------------------------
_SC = "SELECT image_id, time_start, cloud_pct, sensor FROM scenes"
add("flt1_date", lambda fx: sc.filter_date(fx.scenes(), "1996-06-01", "1997-06-01"), f"{_SC} WHERE time_start >= TIMESTAMP '1996-06-01' AND time_start < TIMESTAMP '1997-06-01'")


def _boxed(fx: Fixture) -> DataFrame:
    x, y = (F.col("image_id") * 7) % 50, (F.col("image_id") * 3) % 40
    return fx.scenes().withColumns({"min_x": x, "min_y": y, "max_x": x + 5, "max_y": y + 4})


add("flt2_bounds", lambda fx: sc.filter_bounds(_boxed(fx), 10, 10, 20, 20).select("image_id"), "SELECT image_id FROM scenes WHERE (image_id * 7) % 50 <= 20 AND (image_id * 7) % 50 + 5 >= 10 AND (image_id * 3) % 40 <= 20 AND (image_id * 3) % 40 + 4 >= 10")
add("flt2_bounds_exact", lambda fx: zo.filter_by_spans(fx.polygons(), zo.polygon_spans(fx.polygons(), fx.grid()), zo.polygon_spans(fx.aoi(), fx.grid())).select("feature_id"), "SELECT DISTINCT feature_id FROM poly_cells WHERE col BETWEEN 5 AND 44")
add("flt3_calendar", lambda fx: sc.filter_calendar(fx.scenes(), 6, 9), f"{_SC} WHERE month(time_start) BETWEEN 6 AND 9")
add("flt4_property", lambda fx: sc.filter_property(sc.filter_property(fx.scenes(), F.col("cloud_pct") < 20), F.col("sensor") == "LT05", F.col("sensor").isin("LC08", "LC09"), any_of=True), f"{_SC} WHERE cloud_pct < 20 AND (sensor = 'LT05' OR sensor IN ('LC08', 'LC09'))")
add("flt5_has_bands", lambda fx: sc.filter_has_bands(fx.scenes().withColumn("bands", F.when(F.col("image_id") % 3 == 0, F.array(F.lit("B7"))).otherwise(F.array(F.lit("B8A"), F.lit("B7")))), ["B8A", "B7"]).select("image_id"), "SELECT image_id FROM scenes WHERE image_id % 3 <> 0")
add("flt6_clip", lambda fx: zo.clip(fx.dem(), zo.polygon_spans(fx.polygons(), fx.grid())), "SELECT col, row, elevation FROM dem SEMI JOIN poly_cells USING (col, row)")
add("flt7_select_bands", lambda fx: bd.select_bands(fx.pixels_ls(), r"SR_B[2-4]", ["green", "red", "nir"]), f"SELECT {KEYS}, SR_B2 AS green, SR_B3 AS red, SR_B4 AS nir FROM pixels_ls")
add("flt8_select_requested", lambda fx: bd.select_requested(fx.soil(), ["clay_0_5cm", "stc"], ["clay", "stc"]), "SELECT col, row, clay_0_5cm, stc FROM soil")
add("flt9_first", lambda fx: sc.first_scene(sc.filter_date(fx.scenes(), "1998-01-01", "1999-01-01")), f"{_SC} WHERE time_start >= TIMESTAMP '1998-01-01' AND time_start < TIMESTAMP '1999-01-01' ORDER BY time_start, image_id LIMIT 1")
add("flt10_first_rows", lambda fx: sc.first_rows(fx.points().select("point_id", "x", "y"), 5, "point_id"), "SELECT point_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM points ORDER BY point_id LIMIT 5")
add("flt11_distinct", lambda fx: sc.distinct_values(fx.points(), "batch"), "SELECT DISTINCT batch FROM points")
_PERIOD = lambda fx: fx.scenes().agg(F.trunc(F.min("time_start"), "month").alias("start"), F.trunc(F.max("time_start"), "month").alias("end"))
for _u, _per in (("year", 12), ("month", 1)):
    add(
        f"gen1_date_list_{_u}",
        lambda fx, u=_u: sc.dates_within(_PERIOD(fx), 2, u),
        f"""SELECT CAST(a + to_months(CAST(i * {_per} AS INT)) AS DATE) AS start_date FROM (SELECT a, unnest(range(0, CAST(round(((year(b) - year(a)) * 12 + month(b) - month(a)) / {_per}.0) AS BIGINT) + 1, 2)) AS i
        FROM (SELECT date_trunc('month', min(time_start)) AS a, date_trunc('month', max(time_start)) AS b FROM scenes))""",
    )
_DAILY = lambda fx: sc.windows_from(sc.date_list(fx.spark, date(1995, 1, 1), date(2000, 12, 31), 1, "day"), 16)
add("jn4_daily_windows", lambda fx: sc.join_windows(fx.scenes(), _DAILY(fx)).groupBy("start_date", "end_date").agg(F.count("*").alias("n"), F.max("image_id").alias("latest_id")), "SELECT d AS start_date, d + 16 AS end_date, count(*) AS n, max(image_id) AS latest_id FROM (SELECT CAST(unnest(range(DATE '1995-01-01', DATE '2001-01-01', INTERVAL 1 DAY)) AS DATE) AS d) JOIN scenes ON time_start >= d AND time_start < d + 16 GROUP BY d")
add("jn4_windows", lambda fx: sc.join_windows(fx.scenes(), fx.windows()).select("image_id", "start_date", "end_date"), "SELECT image_id, start_date, end_date FROM placed")
add("jn5_sensor_priority", lambda fx: sc.sensor_priority(sc.join_windows(fx.scenes(), fx.windows())).select("image_id", "sensor", "start_date"), "SELECT image_id, sensor, start_date FROM used")
_BOX = "SELECT * FROM placed WHERE (image_id * 7) % 50 <= 14 AND (image_id * 7) % 50 + 5 >= 10 AND (image_id * 3) % 40 <= 14 AND (image_id * 3) % 40 + 4 >= 10"
add(
    "jn5_sensor_priority_in_area",
    lambda fx: sc.sensor_priority(sc.join_windows(sc.filter_bounds(_boxed(fx), 10, 10, 14, 14), fx.windows())).select("image_id", "sensor", "start_date"),
    f"""SELECT b.image_id, sensor, b.start_date FROM ({_BOX}) b JOIN (SELECT start_date, bool_or(sensor = 'LT05') AS old, bool_or(sensor IN ('LC08', 'LC09')) AS new FROM ({_BOX}) GROUP BY ALL) USING (start_date)
        WHERE (sensor = 'LT05' AND old) OR (sensor IN ('LC08', 'LC09') AND new) OR (sensor = 'LE07' AND NOT old AND NOT new)""",
)
add("agg19_window_counts", lambda fx: sc.join_windows(fx.scenes(), fx.windows()).groupBy("start_date", "sensor").agg(F.count("*").alias("n")), "SELECT start_date, sensor, count(*) AS n FROM placed GROUP BY ALL")

# --- composites and statistics -----------------------------------------------------------------------------------


def _ndvi(fx: Fixture, windows: DataFrame | None = None) -> DataFrame:
    use = sc.join_windows(sc.filter_property(fx.scenes(), F.col("cloud_pct") < 80), fx.windows() if windows is None else windows).select("image_id", "start_date")
    x = masks.mask_cloud_snow(fx.pixels_ls().select(*KEY, "SR_B3", "SR_B4", "QA_PIXEL").join(use, "image_id"), ["SR_B3", "SR_B4"])
    return ix.add_indices(scaling.scale_reflectance(x, ["SR_B3", "SR_B4"]), ix.LANDSAT, ["NDVI"])


_NDVI = f"(SELECT start_date, col, row, CASE WHEN QA_PIXEL & 56 = 0 THEN {nd('SR_B4', 'SR_B3')} END AS NDVI FROM sr JOIN placed USING (image_id) WHERE cloud_pct < 80)"
add("annual_ndvi_composite", lambda fx: rounded(cp.composite(_ndvi(fx), ["NDVI"], "mean")), f"SELECT start_date, col, row, round(avg(NDVI), 6) AS NDVI FROM {_NDVI} GROUP BY ALL")
for _s, _f in (("min", "min"), ("max", "max"), ("median", "median"), ("sum", "sum"), ("count", "count"), ("stdDev", "stddev_pop")):
    add(f"agg1_composite_{_s.lower()}", lambda fx, s=_s: rounded(cp.composite(_ndvi(fx), ["NDVI"], s)), f"SELECT start_date, col, row, {'count(NDVI)' if _s == 'count' else f'round({_f}(NDVI), 6)'} AS NDVI FROM {_NDVI} GROUP BY ALL")
add("agg2_median_composite", lambda fx: stepped(cp.median_composite(_ndvi(fx), ["SR_B4", "NDVI"]), "SR_B4", "NDVI"), f"SELECT start_date, col, row, {step('median(CASE WHEN QA_PIXEL & 56 = 0 THEN SR_B4 END)')} AS SR_B4, {step('median(CASE WHEN QA_PIXEL & 56 = 0 THEN ' + nd('SR_B4', 'SR_B3') + ' END)')} AS NDVI FROM sr JOIN placed USING (image_id) WHERE cloud_pct < 80 GROUP BY start_date, col, row")
_PARTS = lambda fx: cp.sketches(_ndvi(fx).join(fx.scenes().select("image_id", "sensor"), "image_id"), ["SR_B4", "NDVI"], ["start_date", "row", "sensor"])
add("agg2_median_of_sketches", lambda fx: stepped(cp.median_of_parts(_PARTS(fx), ["SR_B4", "NDVI"], ["start_date", "row"]), "SR_B4", "NDVI"), f"SELECT start_date, row, {step('quantile_disc(CASE WHEN QA_PIXEL & 56 = 0 THEN SR_B4 END, 0.5)')} AS SR_B4, {step('quantile_disc(CASE WHEN QA_PIXEL & 56 = 0 THEN ' + nd('SR_B4', 'SR_B3') + ' END, 0.5)')} AS NDVI FROM sr JOIN placed USING (image_id) WHERE cloud_pct < 80 GROUP BY start_date, row")
add("agg3_mean_over_time", lambda fx: rounded(masks.leading_class(fx.class_probs(), CELL)), f"SELECT col, row, {', '.join(f'round(avg({c}), 6) AS {c}' for c in _C)}, list_position([{', '.join(f'avg({c})' for c in _C)}], greatest({', '.join(f'avg({c})' for c in _C)})) - 1 AS label FROM class_probs GROUP BY col, row")
add("agg4_mosaic", lambda fx: cp.mosaic(masks.mask_cloud(fx.pixels_ls(), LS).join(fx.scenes().select("image_id", "time_start"), "image_id"), LS), "SELECT col, row, " + ", ".join(f"arg_max(CASE WHEN QA_PIXEL & 24 = 0 THEN {b} END, CASE WHEN QA_PIXEL & 24 = 0 THEN struct_pack(t := time_start, i := image_id) END) AS {b}" for b in LS) + " FROM pixels_ls JOIN scenes USING (image_id) GROUP BY col, row")
add("agg5_reduce_region", lambda fx: stepped(x := cp.reduce_region(sr(fx), ["SR_B4", "SR_B3"], ["minMax", "mean", "stdDev"]), *x.columns[1:]), "SELECT image_id, " + ", ".join(f"{step(f'{f}({b})')} AS {b}_{n}" for b in ("SR_B4", "SR_B3") for n, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("stdDev", "stddev_pop"))) + " FROM sr GROUP BY image_id")
add("agg6_collection_stats", lambda fx: rounded(cp.collection_stats(sr(fx), fx.scenes(), ["SR_B4"]), 9), "SELECT scenes.image_id, time_start, cloud_pct, sensor, round(min(SR_B4), 9) AS SR_B4_min, round(max(SR_B4), 9) AS SR_B4_max FROM scenes LEFT JOIN sr USING (image_id) GROUP BY ALL")
add("agg7_frequency_histogram", lambda fx: cp.frequency_histogram(fx.landcover(), "b1", ["year"]), "SELECT year, b1, count(*) AS n FROM landcover GROUP BY ALL")
add("agg8_normalize", lambda fx: rounded(cp.normalize_image(fx.dem_gaps(), ["elevation"])), "SELECT col, row, round((elevation - min(elevation) OVER ()) / nullif(max(elevation) OVER () - min(elevation) OVER (), 0), 6) AS elevation FROM dem_gaps")
add("agg9_pixel_min", lambda fx: fx.pixels_ls().select(*KEY, cp.pixel_min(SR).alias("least")), f"SELECT {KEYS}, least({', '.join(SR)}) AS least FROM pixels_ls")
add("agg10_mean", lambda fx: rounded(resample.reduce_resolution(fx.dem_gaps(), ["elevation"], 4)), "SELECT CAST(col // 4 AS INT) AS col, CAST(row // 4 AS INT) AS row, round(avg(elevation), 6) AS elevation FROM dem_gaps GROUP BY col // 4, row // 4")
add("agg10_mode", lambda fx: resample.reduce_resolution(fx.soil(), ["stc"], 4, "mode"), "SELECT col, row, stc FROM (SELECT CAST(col // 4 AS INT) AS col, CAST(row // 4 AS INT) AS row, stc, row_number() OVER (PARTITION BY col // 4, row // 4 ORDER BY count(*) DESC, stc) AS rn FROM soil GROUP BY col // 4, row // 4, stc) WHERE rn = 1")


def _coarse(fx: Fixture) -> tuple[Grid, Grid]:
    n = fx.n_rows()
    return Grid(50, n, 0, 0, 30, 30), Grid(math.ceil(50 * 30 / 100), math.ceil(n * 30 / 100), 0, 0, 100, 100)


_OVER = """(SELECT c.k AS col, r.k AS row, elevation, (least(cx1, (c.k + 1) * 100) - greatest(cx0, c.k * 100)) * (least(ry1, (r.k + 1) * 100) - greatest(ry0, r.k * 100)) AS w
    FROM (SELECT *, col * 30 AS cx0, (col + 1) * 30 AS cx1, row * 30 AS ry0, (row + 1) * 30 AS ry1 FROM dem_gaps) d
    JOIN (SELECT CAST(unnest(range(0, 16)) AS INT) AS k) c ON cx1 > c.k * 100 AND cx0 < (c.k + 1) * 100
    JOIN (SELECT CAST(unnest(range(0, (SELECT n_rows * 30 // 100 + 2 FROM g))) AS INT) AS k) r ON ry1 > r.k * 100 AND ry0 < (r.k + 1) * 100)"""
add("agg11_area_mean", lambda fx: rounded(resample.aggregate_to_grid(fx.dem_gaps(), ["elevation"], *_coarse(fx))), f"SELECT col, row, round(sum(w * elevation) / sum(CASE WHEN elevation IS NOT NULL THEN w END), 6) AS elevation FROM {_OVER} GROUP BY col, row")
add("agg12_class_bands", lambda fx: cp.class_bands(fx.landcover(), "b1", [210, 220, 230]).drop("b1"), "SELECT year, col, row, CAST(b1 = 210 AS INT) AS class_210, CAST(b1 = 220 AS INT) AS class_220, CAST(b1 = 230 AS INT) AS class_230 FROM landcover")
add("agg13_reduce_columns", lambda fx: rounded(cp.reduce_columns(fx.dem_gaps(), ["elevation"])), "SELECT round(avg(elevation), 6) AS elevation_mean, round(stddev_pop(elevation), 6) AS elevation_stdDev FROM dem_gaps")
add("agg14_pixel_stats", lambda fx: rounded(qa.pixel_stats(fx.dem_gaps().withColumn("raster", F.col("col") % 5), "elevation")), "SELECT col % 5 AS raster, count(*) AS n_total, count(*) - count(elevation) AS n_na, count(elevation) AS n_valid, round(min(elevation), 6) AS min, round(max(elevation), 6) AS max, round(avg(elevation), 6) AS mean, round(stddev_samp(elevation), 6) AS sd, round((count(*) - count(elevation)) * 100.0 / count(*), 6) AS pct_na FROM dem_gaps GROUP BY col % 5 HAVING count(elevation) > 0")
_HIST = "(SELECT raster, least(coalesce(CAST(floor((ksat - lo) * 50 / nullif(hi - lo, 0)) AS INT), 0), 49) + 1 AS bin FROM (SELECT col % 5 AS raster, CAST(ksat AS DOUBLE) AS ksat, min(CAST(ksat AS DOUBLE)) OVER (PARTITION BY col % 5) AS lo, max(CAST(ksat AS DOUBLE)) OVER (PARTITION BY col % 5) AS hi FROM soil))"
_ksat = lambda fx: fx.soil().select((F.col("col") % 5).alias("raster"), F.col("ksat").cast("double").alias("ksat"))
add("agg15_histogram", lambda fx: qa.histogram(_ksat(fx), "ksat"), f"SELECT raster, bin, count(*) AS n FROM {_HIST} GROUP BY ALL")
add("agg15_peak", lambda fx: qa.peak_count(qa.histogram(_ksat(fx), "ksat")), f"SELECT raster, max(n) AS peak FROM (SELECT raster, bin, count(*) AS n FROM {_HIST} GROUP BY ALL) GROUP BY raster")
add("agg16_stretch_of_sketches", lambda fx: rounded(qa.stretch_of_sketches(fx.soil().withColumn("raster", F.col("row")), "ksat", 0.05, 0.9)), "SELECT row AS raster, CAST(CASE WHEN a = b THEN lo ELSE a END AS DOUBLE) AS low, CAST(CASE WHEN a = b THEN hi ELSE b END AS DOUBLE) AS high FROM (SELECT row, quantile_disc(ksat, 0.05) AS a, quantile_disc(ksat, 0.9) AS b, min(ksat) AS lo, max(ksat) AS hi FROM soil GROUP BY row)")
add("agg16_stretch", lambda fx: rounded(qa.stretch(_ksat(fx), "ksat")), "SELECT raster, round(CASE WHEN a = b THEN lo ELSE a END, 6) AS low, round(CASE WHEN a = b THEN hi ELSE b END, 6) AS high FROM (SELECT col % 5 AS raster, quantile_cont(CAST(ksat AS DOUBLE), 0.02) AS a, quantile_cont(CAST(ksat AS DOUBLE), 0.98) AS b, CAST(min(ksat) AS DOUBLE) AS lo, CAST(max(ksat) AS DOUBLE) AS hi FROM soil GROUP BY col % 5)")
add("agg17_display_range", lambda fx: cp.reduce_region(fx.dem(), ["elevation"], ["minMax"], []), "SELECT min(elevation) AS elevation_min, max(elevation) AS elevation_max FROM dem")
add("agg18_sample", lambda fx: cp.sample(fx.dem(), 40), "SELECT col, row, elevation FROM dem ORDER BY (col * 7919 + row * 104729) % 1000003, col, row LIMIT 40")

add("agg18_sample_located", lambda fx: rounded(cp.sample(fx.dem(), 40, grid=Grid(50, fx.n_rows(), -120.0, 50.0, 0.1, 0.1, "EPSG:4326"))), "SELECT col, row, elevation, round(-120.0 + (col + 0.5) * 0.1, 6) AS longitude, round(50.0 + (row + 0.5) * 0.1, 6) AS latitude FROM dem ORDER BY (col * 7919 + row * 104729) % 1000003, col, row LIMIT 40")

# --- joins and regions -------------------------------------------------------------------------------------------
add("jn1_add_bands", lambda fx: bd.add_bands(fx.dem(), fx.upslope()), "SELECT col, row, elevation, CAST(upa AS DOUBLE) AS upa FROM dem FULL JOIN upslope USING (col, row)")
add("jn1_overwrite", lambda fx: bd.add_bands(fx.dem(), fx.dem_gaps(), overwrite=True), "SELECT col, row, elevation FROM dem_gaps")
add("jn2_combine_images", lambda fx: bd.combine_images([fx.dem(), fx.forest_age(), fx.dem_gaps()]), 'SELECT col, row, d.elevation AS "0_elevation", age AS "1_age", x.elevation AS "2_elevation" FROM dem d JOIN forest_age USING (col, row) JOIN dem_gaps x USING (col, row)')
add("jn3_to_bands", lambda fx: bd.to_bands(fx.landcover().withColumnRenamed("year", "image_id"), {1995: "y95", 2001: "y01"}, ["b1"]), "SELECT col, row, max(b1) FILTER (year = 1995) AS y95_b1, max(b1) FILTER (year = 2001) AS y01_b1 FROM landcover GROUP BY col, row")
_DEPTHS = {"ksat": ["0-5cm", "5-15cm"], "stc": ["0-5cm"], "wcsat": ["0-5cm", "5-15cm"]}
_HS = """SELECT col, row, max(CAST(ksat AS BIGINT)) AS k0, max(CAST(ksat + 1 AS BIGINT)) AS k5, max(CAST(stc AS BIGINT)) AS s0, max(CAST(clay_0_5cm AS BIGINT)) AS w0, max(CAST(clay_0_5cm + 7 AS BIGINT)) AS w5 FROM soil GROUP BY col, row"""


def _hydrosoil(fx: Fixture) -> DataFrame:
    """One image per asset and depth."""
    layers = {("ksat", "0-5cm"): F.col("ksat"), ("ksat", "5-15cm"): F.col("ksat") + 1, ("stc", "0-5cm"): F.col("stc"), ("wcsat", "0-5cm"): F.col("clay_0_5cm"), ("wcsat", "5-15cm"): F.col("clay_0_5cm") + 7}
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("asset"), F.lit(i).alias("image_id"), v.cast("bigint").alias("b1")) for (a, i), v in layers.items()]))
    return fx.soil().select(*CELL, each.alias("x")).select(*CELL, "x.*")


add("jn3_asset_image", lambda fx: bd.asset_image(_hydrosoil(fx), "ksat", _DEPTHS["ksat"]), f'SELECT col, row, k0 AS "ksat_0-5cm", k5 AS "ksat_5-15cm" FROM ({_HS})')
add("jn3_asset_image_chosen", lambda fx: bd.asset_image(_hydrosoil(fx), "wcsat", _DEPTHS["wcsat"], ["5-15cm"]), f'SELECT col, row, w5 AS "5-15cm" FROM ({_HS})')
add("jn6_aligned_mask", lambda fx: masks.mask_by_aligned(fx.dem(), fx.forest_age(), F.col("age") <= 40, ["elevation"]), "SELECT col, row, CASE WHEN age <= 40 THEN elevation END AS elevation FROM dem LEFT JOIN forest_age USING (col, row)")
add("zon1_spans", lambda fx: zo.span_cells(zo.polygon_spans(fx.polygons(), fx.grid())), "SELECT feature_id, row, col FROM poly_cells")
add("zon2_reduce_regions", lambda fx: rounded(zo.reduce_regions(fx.dem_gaps(), zo.polygon_spans(fx.polygons(), fx.grid()), fx.polygons(), ["elevation"], "mean")), "SELECT polys.feature_id, round(avg(elevation), 6) AS elevation FROM polys LEFT JOIN (poly_cells JOIN dem_gaps USING (col, row)) USING (feature_id) GROUP BY polys.feature_id")
add("zon2_prefix", lambda fx: stepped(zo.reduce_by_sums(fx.dem_gaps().join(fx.soil(), CELL), zo.polygon_spans(fx.polygons(), fx.grid()), ["elevation", "ksat"], "mean"), "elevation", "ksat"), f"SELECT feature_id, {step('avg(elevation)')} AS elevation, {step('avg(ksat)')} AS ksat FROM poly_cells JOIN dem_gaps USING (col, row) JOIN soil USING (col, row) GROUP BY feature_id")
add("zon5_prefix_by_image", lambda fx: stepped(zo.reduce_by_sums(sr(fx), zo.polygon_spans(fx.polygons(), fx.grid()), ["SR_B4"], "sum", ["image_id"]), "SR_B4"), f"SELECT feature_id, image_id, {step('sum(SR_B4)')} AS SR_B4 FROM poly_cells JOIN sr USING (col, row) GROUP BY feature_id, image_id")
add("zon3_image_to_points", lambda fx: rounded(zo.image_to_points(fx.dem_gaps(), fx.points(), fx.grid(), ["elevation"])), "SELECT point_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, batch, elevation AS elevation_mean_0 FROM point_cells LEFT JOIN dem_gaps USING (col, row)")
add(
    "zon3_image_to_points_buffer",
    lambda fx: rounded(zo.image_to_points(fx.dem_gaps(), fx.points(), fx.grid(), ["elevation"], buffer=3)),
    "SELECT p.point_id, any_value(CAST(x AS DOUBLE)) AS x, any_value(CAST(y AS DOUBLE)) AS y, any_value(batch) AS batch, round(avg(elevation), 6) AS elevation_mean_3 FROM points p LEFT JOIN dem_gaps d ON (d.col + 0.5 - x) * (d.col + 0.5 - x) + (d.row + 0.5 - y) * (d.row + 0.5 - y) <= 9 GROUP BY p.point_id",
)
add("zon4_collection_to_points", lambda fx: zo.collection_to_points(fx.pixels_ls(), fx.scenes(), fx.points(), fx.grid(), ["SR_B4"], properties=["sensor"]).select("point_id", "image_id", "sensor", "SR_B4_mean_0"), "SELECT point_id, image_id, sensor, SR_B4 AS SR_B4_mean_0 FROM point_cells JOIN pixels_ls USING (col, row) JOIN scenes USING (image_id)")
add("zon5_collection_to_features", lambda fx: rounded(zo.collection_to_features(sr(fx), fx.scenes(), zo.polygon_spans(fx.polygons(), fx.grid()), ["SR_B4"], properties=["sensor"]), 9), "SELECT image_id, feature_id, sensor, round(avg(SR_B4), 9) AS SR_B4_mean FROM poly_cells JOIN sr USING (col, row) JOIN scenes USING (image_id) GROUP BY ALL")
add("zon6_sample_regions", lambda fx: zo.sample_regions(fx.soil(), fx.points(), fx.grid(), ["point_id", "batch"]), "SELECT point_id, batch, clay_0_5cm, ksat, stc FROM point_cells JOIN soil USING (col, row)")
add("zon7_copy_properties", lambda fx: bd.copy_properties(cp.reduce_region(fx.pixels_ls(), ["SR_B4"], ["max"]), fx.scenes(), ["time_start", "sensor"]), "SELECT image_id, max(SR_B4) AS SR_B4_max, any_value(time_start) AS time_start, any_value(sensor) AS sensor FROM pixels_ls LEFT JOIN scenes USING (image_id) GROUP BY image_id")
add("zon8_bounds", lambda fx: zo.bounds(fx.polygons()), "SELECT feature_id, CAST(px AS DOUBLE) AS min_x, CAST(py AS DOUBLE) AS min_y, CAST(px + side AS DOUBLE) AS max_x, CAST(py + side AS DOUBLE) AS max_y FROM polys")
add("zon8_buffer", lambda fx: zo.span_cells(zo.dilated(zo.polygon_spans(fx.polygons(), fx.grid()), fx.grid(), 2.0)), "SELECT DISTINCT feature_id, d.col, d.row FROM poly_cells p JOIN dem d ON (d.col - p.col) * (d.col - p.col) + (d.row - p.row) * (d.row - p.row) <= 4")
add("zon8_buffer_67", lambda fx: zo.span_cells(zo.dilated(zo.polygon_spans(fx.polygons(), fx.grid()), fx.grid(), 67.0)), "SELECT DISTINCT feature_id, d.col, d.row FROM poly_cells p JOIN dem d ON (d.col - p.col) * (d.col - p.col) + (d.row - p.row) * (d.row - p.row) <= 4489")
add("zon8_distance_transform", lambda fx: rounded(zo.distance_transform(zo.polygon_spans(fx.polygons(), fx.grid()), fx.grid(), 12.5)), "SELECT feature_id, d.col, d.row, round(sqrt(min((d.col - p.col) * (d.col - p.col) + (d.row - p.row) * (d.row - p.row))), 6) AS distance FROM poly_cells p JOIN dem d ON (d.col - p.col) * (d.col - p.col) + (d.row - p.row) * (d.row - p.row) <= 156.25 GROUP BY ALL")
add("zon8_distance", lambda fx: rounded(fx.points().select("point_id", zo.distance(F.col("x"), F.col("y"), F.lit(10.0), F.lit(20.0)).alias("planar"), zo.haversine(F.col("x"), F.col("y"), F.lit(10.0), F.lit(20.0)).alias("sphere")), 3), "SELECT point_id, round(sqrt((x - 10) * (x - 10) + (y - 20) * (y - 20)), 3) AS planar, round(2 * 6371008.8 * asin(sqrt(least(pow(sin((radians(20) - radians(y)) / 2), 2) + cos(radians(y)) * cos(radians(20)) * pow(sin(radians(10 - x) / 2), 2), 1))), 3) AS sphere FROM points")

# --- moving windows ----------------------------------------------------------------------------------------------


def around(test: str, table: str = "dem_gaps") -> str:
    return f"(SELECT a.col, a.row, a.elevation AS z, b.elevation AS v FROM {table} a JOIN {table} b ON {test})"


def circle(r: int) -> str:
    return f"a.col - b.col BETWEEN -{r} AND {r} AND a.row - b.row BETWEEN -{r} AND {r} AND (a.col - b.col) * (a.col - b.col) + (a.row - b.row) * (a.row - b.row) <= {r * r}"


_STATS = ("mean", "sum", "count", "stdDev")
_FOCAL = "SELECT col, row, z AS elevation, round(avg(v), 6) AS elevation_mean, round(sum(v), 6) AS elevation_sum, count(v) AS elevation_count, round(stddev_pop(v), 5) AS elevation_stdDev FROM {x} GROUP BY col, row, z"


def _focal(fx: Fixture, k: fo.Kernel, tiled: bool | None = None) -> DataFrame:
    out = fo.focal(fx.dem_gaps(), ["elevation"], k, _STATS, tiled=tiled)
    return rounded(out.withColumn("elevation_stdDev", F.round("elevation_stdDev", 5)))


add("foc1_circle", lambda fx: _focal(fx, fo.Kernel(3)), _FOCAL.format(x=around(circle(3))))
add("foc1_circle_tiled", lambda fx: _focal(fx, fo.Kernel(5), True), _FOCAL.format(x=around(circle(5))))
add("foc1_square", lambda fx: _focal(fx, fo.Kernel(2, "square")), _FOCAL.format(x=around("a.col - b.col BETWEEN -2 AND 2 AND a.row - b.row BETWEEN -2 AND 2")))
add("foc2_focal_stats", lambda fx: rounded(fo.focal_stats(fx.dem_gaps(), ["elevation"], fo.Kernel(2), "150")), f"SELECT col, row, round(avg(v), 6) AS elevation_150 FROM {around(circle(2))} GROUP BY col, row")
add("foc3_zero_focal", lambda fx: fo.focal_stats(fx.dem_gaps(), ["elevation"], fo.Kernel(0), "0"), "SELECT col, row, elevation AS elevation_0 FROM dem_gaps")
add("foc4_gaussian_fill", lambda fx: rounded(fo.gaussian_fill(fx.dem_gaps(), ["elevation"])), "SELECT a.col, a.row, round(coalesce(any_value(a.elevation), sum(b.elevation * exp(-((a.col - b.col) * (a.col - b.col) + (a.row - b.row) * (a.row - b.row)) / 2.0)) / sum(CASE WHEN b.elevation IS NOT NULL THEN exp(-((a.col - b.col) * (a.col - b.col) + (a.row - b.row) * (a.row - b.row)) / 2.0) END)), 6) AS elevation FROM dem_gaps a JOIN dem_gaps b ON a.col - b.col BETWEEN -3 AND 3 AND a.row - b.row BETWEEN -3 AND 3 GROUP BY a.col, a.row")
add("foc5_tpi", lambda fx: rounded(fo.tpi(fx.dem_gaps(), "elevation", [4])), f"SELECT col, row, z AS elevation, round(z - avg(v), 6) AS tpi_4 FROM {around(circle(4))} GROUP BY col, row, z")
add("foc6_dev", lambda fx: rounded(fo.dev(fx.dem_gaps(), "elevation", [4]), 5), f"SELECT col, row, z AS elevation, round((z - avg(v)) / greatest(stddev_pop(v), 0.001), 5) AS dev_4 FROM {around(circle(4))} GROUP BY col, row, z")
for _r in (20, 33):
    add(f"foc6_dev_{_r}", lambda fx, r=_r: rounded(fo.dev(fx.dem_gaps(), "elevation", [r]), 5), f"SELECT col, row, z AS elevation, round((z - avg(v)) / greatest(stddev_pop(v), 0.001), 5) AS dev_{_r} FROM {around(circle(_r))} GROUP BY col, row, z")
add("foc5_tpi_67", lambda fx: rounded(fo.tpi(fx.dem_gaps(), "elevation", [67]), 5), f"SELECT col, row, z AS elevation, round(z - avg(v), 5) AS tpi_67 FROM {around(circle(67))} GROUP BY col, row, z")
_area = lambda fx: zo.polygon_spans(fx.aoi(), fx.grid())
_INSIDE, _CLIPPED = "col BETWEEN 5 AND 44", "(SELECT * FROM dem_gaps WHERE col BETWEEN 5 AND 44)"
_TRI3 = "a.col - b.col BETWEEN -1 AND 1 AND a.row - b.row BETWEEN -1 AND 1"
_tri = lambda table: f"SELECT col, row, z AS elevation, round(CASE WHEN z IS NOT NULL THEN sqrt(coalesce(sum((v - z) * (v - z)), 0)) END, 4) AS tri FROM {around(_TRI3, table)} GROUP BY col, row, z"
for _p, _t in (("padded", "dem_gaps"), ("clipped", _CLIPPED)):
    _x = _p == "padded"
    add(f"foc5_tpi_{_p}", lambda fx, x=_x: rounded(wf.terrain_in_area(fx.dem_gaps(), "tpi", [6], _area(fx), fx.grid(), pad=None if x else False)), f"SELECT col, row, z AS elevation, round(z - avg(v), 6) AS tpi_6 FROM {around(circle(6), _t)} WHERE {_INSIDE} GROUP BY col, row, z")
    add(f"foc6_dev_{_p}", lambda fx, x=_x: rounded(wf.terrain_in_area(fx.dem_gaps(), "dev", [4], _area(fx), fx.grid(), pad=True if x else None), 5), f"SELECT col, row, z AS elevation, round((z - avg(v)) / greatest(stddev_pop(v), 0.001), 5) AS dev_4 FROM {around(circle(4), _t)} WHERE {_INSIDE} GROUP BY col, row, z")
    add(f"foc7_tri_{_p}", lambda fx, x=_x: rounded(wf.terrain_in_area(fx.dem_gaps(), "tri", [], _area(fx), fx.grid(), pad=True if x else None), 4), f"SELECT * FROM ({_tri(_t)}) WHERE {_INSIDE}")
_FOC8 = [*range(0, 38, 2)]
add("foc8_species_proportions", lambda fx: rounded(fo.class_proportions(fx.species(), "species", _FOC8, 3, ["year"])), "SELECT a.year, a.col, a.row, " + ", ".join(f"round(count(*) FILTER (b.species = {k}) / count(b.species), 6) AS class_{k}_3" for k in _FOC8) + f" FROM species a JOIN species b ON a.year = b.year AND {circle(3)} GROUP BY a.year, a.col, a.row")
add("foc7_tri", lambda fx: rounded(fo.tri(fx.dem_gaps(), "elevation"), 4), f"SELECT col, row, z AS elevation, round(CASE WHEN z IS NOT NULL THEN sqrt(coalesce(sum((v - z) * (v - z)), 0)) END, 4) AS tri FROM {around('a.col - b.col BETWEEN -1 AND 1 AND a.row - b.row BETWEEN -1 AND 1')} GROUP BY col, row, z")
_K = [20, 210, 220]
add("foc8_class_proportions", lambda fx: rounded(fo.class_proportions(fx.landcover().where("year = 1998").select(*CELL, "b1"), "b1", _K, 3)), "SELECT a.col, a.row, " + ", ".join(f"round(count(*) FILTER (b.b1 = {k}) / count(b.b1), 6) AS class_{k}_3" for k in _K) + f" FROM (SELECT * FROM landcover WHERE year = 1998) a JOIN (SELECT * FROM landcover WHERE year = 1998) b ON {circle(3)} GROUP BY a.col, a.row")
_SLOPE = "(SELECT d.col, d.row, d.elevation, (e.elevation - w.elevation) / 60.0 AS gx, (n.elevation - s.elevation) / 60.0 AS gy FROM dem_gaps d LEFT JOIN dem_gaps e ON e.col = d.col + 1 AND e.row = d.row LEFT JOIN dem_gaps w ON w.col = d.col - 1 AND w.row = d.row LEFT JOIN dem_gaps n ON n.col = d.col AND n.row = d.row - 1 LEFT JOIN dem_gaps s ON s.col = d.col AND s.row = d.row + 1)"
_DEG = "CASE WHEN elevation IS NOT NULL THEN degrees(atan(sqrt(gx * gx + gy * gy))) END"
_ASP = "CASE WHEN elevation IS NOT NULL THEN (degrees(atan2(-gx, -gy)) + 360) % 360 END"
add("foc9_slope_aspect", lambda fx: rounded(fo.slope_aspect(fx.dem_gaps(), "elevation", 30.0)), f"SELECT col, row, elevation, round({_DEG}, 6) AS slope, round({_ASP}, 6) AS aspect FROM {_SLOPE}")

# --- grids -------------------------------------------------------------------------------------------------------
add(
    "grd1_tiles",
    lambda fx: resample.split_into_tiles(fx.spark, 0, 0, 50, fx.n_rows(), 16),
    """SELECT CAST(i AS INT) AS tile_x, CAST(j AS INT) AS tile_y, CAST(i * 16 AS DOUBLE) AS min_x, CAST(j * 16 AS DOUBLE) AS min_y, CAST(i * 16 + 16 AS DOUBLE) AS max_x, CAST(j * 16 + 16 AS DOUBLE) AS max_y
        FROM (SELECT unnest(range(0, 4)) AS i), (SELECT unnest(range(0, CAST(ceil(n_rows / 16) AS BIGINT))) AS j FROM g)""",
)
add(
    "grd1_tiles_of_areas",
    lambda fx: resample.tiles_of(zo.bounds(fx.polygons()), 2.0, ["feature_id"]),
    """SELECT feature_id, CAST(i AS INT) AS tile_x, CAST(j AS INT) AS tile_y, CAST(px + i * 2 AS DOUBLE) AS min_x, CAST(py + j * 2 AS DOUBLE) AS min_y, CAST(px + i * 2 + 2 AS DOUBLE) AS max_x, CAST(py + j * 2 + 2 AS DOUBLE) AS max_y
        FROM polys, (SELECT unnest(range(0, 3)) AS i), (SELECT unnest(range(0, 3)) AS j) WHERE i * 2 < side AND j * 2 < side""",
)
_TARGET = lambda fx: Grid(20, fx.n_rows() // 3, 1.0, 1.0, 2.0, 2.0)
_T = "(SELECT CAST(c AS INT) AS col, CAST(r AS INT) AS row, 1 + (c + 0.5) * 2 - 0.5 AS u, 1 + (r + 0.5) * 2 - 0.5 AS v FROM (SELECT unnest(range(0, 20)) AS c), (SELECT unnest(range(0, n_rows // 3)) AS r FROM g)) t"
_NEAREST = f"SELECT t.col, t.row, elevation FROM {_T} LEFT JOIN dem_gaps d ON d.col = floor(u + 0.5) AND d.row = floor(v + 0.5)"
add("grd2_nearest", lambda fx: resample.snap_to_grid(fx.dem_gaps(), ["elevation"], fx.grid(), _TARGET(fx)), _NEAREST)
add("grd2_bilinear", lambda fx: rounded(resample.snap_to_grid(fx.dem_gaps(), ["elevation"], fx.grid(), _TARGET(fx), "bilinear")), f"SELECT t.col, t.row, round(CASE WHEN count(elevation) = 4 THEN avg(elevation) END, 6) AS elevation FROM {_T} LEFT JOIN dem_gaps d ON d.col - floor(u) BETWEEN 0 AND 1 AND d.row - floor(v) BETWEEN 0 AND 1 GROUP BY t.col, t.row")
add("grd2_bicubic", lambda fx: rounded(resample.snap_to_grid(fx.dem_gaps(), ["elevation"], fx.grid(), _TARGET(fx), "bicubic")), f"SELECT t.col, t.row, round(CASE WHEN count(elevation) = 16 THEN sum(elevation * CASE WHEN abs(u - d.col) < 1 THEN 0.5625 ELSE -0.0625 END * CASE WHEN abs(v - d.row) < 1 THEN 0.5625 ELSE -0.0625 END) END, 6) AS elevation FROM {_T} LEFT JOIN dem_gaps d ON d.col - floor(u) BETWEEN -1 AND 2 AND d.row - floor(v) BETWEEN -1 AND 2 GROUP BY t.col, t.row")


def _round_trip(fx: Fixture) -> DataFrame:
    """Coordinates through every projection and back."""
    lon, lat = F.col("x") / 5 - 120.0, F.col("point_id") % 12 + 49.5
    out = {"lon": lon, "lat": lat}
    for name in ("EPSG:3400", "EPSG:3402", "EPSG:3978", "EPSG:3348"):
        x, y = crs.transform_crs(lon, lat, "EPSG:4326", name)
        a, b = crs.transform_crs(x, y, name, "EPSG:4326")
        out |= {f"lon_{name[5:]}": a, f"lat_{name[5:]}": b}
    return rounded(fx.points().select("point_id", *[c.alias(n) for n, c in out.items()]), 5)


add("grd3_round_trip", _round_trip, "SELECT point_id, " + ", ".join(f"round(x / 5 - 120.0, 5) AS lon{s}, round(point_id % 12 + 49.5, 5) AS lat{s}" for s in ("", "_3400", "_3402", "_3978", "_3348")) + " FROM points")


def _conic_sql(lon0: float, lat0: float, lat1: float, lat2: float, easting: float, northing: float) -> tuple[str, str]:
    """Forward coordinates of points (lon, lat) by the closed form, in SQL with the ellipsoid's constants in place."""
    e = "0.08181919104281579"
    m = lambda f: f"(cos({f}) / sqrt(1 - {e} * {e} * sin({f}) * sin({f})))"
    ts = lambda f: f"(tan(pi() / 4 - ({f}) / 2) / pow((1 - {e} * sin({f})) / (1 + {e} * sin({f})), {e} / 2))"
    r = lambda d: f"radians({d})"
    n = f"(ln({m(r(lat1))} / {m(r(lat2))}) / ln({ts(r(lat1))} / {ts(r(lat2))}))"
    rho = lambda f: f"(6378137.0 * {m(r(lat1))} / ({n} * pow({ts(r(lat1))}, {n})) * pow({ts(f)}, {n}))"
    theta = f"({n} * radians(lon - ({lon0})))"
    return f"{rho('radians(lat)')} * sin({theta}) + {easting}", f"{rho(r(lat0))} - {rho('radians(lat)')} * cos({theta}) + {northing}"


def _forward(fx: Fixture) -> DataFrame:
    lon, lat, out = F.col("x") / 5 - 120.0, F.col("point_id") % 12 + 49.5, {}
    for name in ("3978", "3348"):
        x, y = crs.transform_crs(lon, lat, "EPSG:4326", f"EPSG:{name}")
        out |= {f"x_{name}": x, f"y_{name}": y}
    return rounded(fx.points().select("point_id", *[c.alias(n) for n, c in out.items()]), 3)


_XY = {"3978": _conic_sql(-95.0, 49.0, 49.0, 77.0, 0.0, 0.0), "3348": _conic_sql(-91.86666666666666, 63.390675, 49.0, 77.0, 6200000.0, 3000000.0)}
add("grd3_forward", _forward, "SELECT point_id, " + ", ".join(f"round({v}, 3) AS {a}_{n}" for n, xy in _XY.items() for a, v in zip("xy", xy)) + " FROM (SELECT point_id, x / 5 - 120.0 AS lon, point_id % 12 + 49.5 AS lat FROM points)")
_CUTS = 600
_CONIC_CELLS = "(SELECT col, row, elevation, -1900000.0 + (col + 0.5) * 30000.0 AS cx, 1800000.0 - (row + 0.5) * 1800000.0 / n_rows AS cy FROM dem, g)"
_CONIC_EDGES = f"""(SELECT feature_id, e, i, {_XY["3978"][0]} AS x, {_XY["3978"][1]} AS y FROM (
    SELECT feature_id, e, i, CASE e WHEN 0 THEN x0 + w * i / {_CUTS}.0 WHEN 1 THEN x0 + w WHEN 2 THEN x0 + w - w * i / {_CUTS}.0 ELSE x0 END AS lon,
        CASE e WHEN 0 THEN y0 WHEN 1 THEN y0 + h * i / {_CUTS}.0 WHEN 2 THEN y0 + h ELSE y0 + h - h * i / {_CUTS}.0 END AS lat
    FROM (SELECT CAST(n_nationkey AS BIGINT) AS feature_id, -120 + (n_nationkey * 7) % 9 * 0.75 AS x0, 49 + (n_nationkey * 11) % 8 * 1.0 AS y0, 3 + n_nationkey % 4 * 1.5 AS w, 1 + n_nationkey % 3 * 1.5 AS h FROM nation),
        (SELECT unnest(range(0, 4)) AS e), (SELECT unnest(range(0, {_CUTS} + 1)) AS i)))"""
_CONIC_SEGMENTS = f"(SELECT feature_id, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM {_CONIC_EDGES} WINDOW w AS (PARTITION BY feature_id, e ORDER BY i))"
_CONIC_INSIDE = f"(SELECT feature_id, col, row, any_value(elevation) AS elevation FROM {_CONIC_SEGMENTS} JOIN {_CONIC_CELLS} ON (y > cy) <> (y2 > cy) AND cx < x + (cy - y) / (y2 - y) * (x2 - x) GROUP BY feature_id, col, row HAVING count(*) % 2 = 1)"
_conic_spans = lambda fx: zo.reprojected_spans(fx.lonlat_polygons(), "EPSG:4326", fx.conic_grid())
add("zon1_reprojected", lambda fx: zo.span_cells(_conic_spans(fx)), f"SELECT feature_id, col, row FROM {_CONIC_INSIDE}")
add("flt6_clip_reprojected", lambda fx: zo.clip(fx.dem(), _conic_spans(fx)), f"SELECT DISTINCT col, row, elevation FROM {_CONIC_INSIDE}")
add("grd3_bounds_reprojected", lambda fx: rounded(zo.bounds(zo.reprojected(fx.lonlat_polygons(), "EPSG:4326", "EPSG:3978", 0.05)), -2), f"SELECT feature_id, {', '.join(f'round({f}({c}), -2) AS {f}_{c}' for f in ('min', 'max') for c in 'xy')} FROM {_CONIC_EDGES} GROUP BY feature_id")
add("grd4_template", lambda fx: rounded(resample.reference_template(zo.bounds(fx.polygons()))), "SELECT round(bx + floor(round((x1 - bx) / s, 9)) * s, 6) AS x0, round(b_y + floor(round((y1 - b_y) / s, 9)) * s, 6) AS y0, CAST(s AS DOUBLE) AS dx, CAST(s AS DOUBLE) AS dy, CAST(ceil(round((x2 - bx) / s, 9)) - floor(round((x1 - bx) / s, 9)) AS INT) AS n_cols, CAST(ceil(round((y2 - b_y) / s, 9)) - floor(round((y1 - b_y) / s, 9)) AS INT) AS n_rows FROM (SELECT arg_min(px, feature_id) AS bx, arg_min(py, feature_id) AS b_y, any_value(side) AS s FROM polys WHERE side = (SELECT max(side) FROM polys)), (SELECT min(px) AS x1, min(py) AS y1, max(px + side) AS x2, max(py + side) AS y2 FROM polys)")

add("grd4_template_of_raster", lambda fx: resample.reference_template(_grids(fx).where("raster = 4")).withColumn("n_rows", F.col("n_rows").cast("int")), "SELECT CAST(n_nationkey % 3 * 15.0 AS DOUBLE) AS x0, CAST(n_nationkey % 2 * 30.0 AS DOUBLE) AS y0, CAST(30.0 AS DOUBLE) AS dx, CAST(30.0 AS DOUBLE) AS dy, CAST(98 AS INT) AS n_cols, CAST(n_nationkey % 4 + 97 AS INT) AS n_rows FROM nation WHERE n_nationkey = 4")

# --- interpolation -----------------------------------------------------------------------------------------------
_IDW = "SELECT c.col, c.row, round(coalesce({keep} max(s.z) FILTER (s.col = c.col AND s.row = c.row), sum(s.z / d2) FILTER (d2 > 0) / sum(1 / d2) FILTER (d2 > 0), any_value(m)), 6) AS elevation FROM dem_gaps c LEFT JOIN (SELECT s.*, c.col AS cc, c.row AS cr, CAST((s.col - c.col) * (s.col - c.col) + (s.row - c.row) * (s.row - c.row) AS DOUBLE) AS d2 FROM dem c JOIN (SELECT col, row, elevation AS z FROM dem_gaps WHERE elevation IS NOT NULL ORDER BY (col * 7919 + row * 104729) % 1000003, col, row LIMIT 60) s ON (s.col - c.col) * (s.col - c.col) + (s.row - c.row) * (s.row - c.row) <= 36) s ON cc = c.col AND cr = c.row, (SELECT avg(elevation) AS m FROM (SELECT elevation FROM dem_gaps WHERE elevation IS NOT NULL ORDER BY (col * 7919 + row * 104729) % 1000003, col, row LIMIT 60)) GROUP BY c.col, c.row"
add("wf1_idw", lambda fx: rounded(interpolate.idw(fx.dem_gaps(), ["elevation"], 6, 2, 60)), _IDW.format(keep=""))
add("wf1_idw_gaps", lambda fx: rounded(interpolate.idw(fx.dem_gaps(), ["elevation"], 6, 2, 60, gaps_only=True)), _IDW.format(keep="any_value(c.elevation),"))

_TWO = "(SELECT col, row, elevation, CASE WHEN (col + row) % 7 <> 0 THEN CAST(ksat AS DOUBLE) END AS ksat FROM dem_gaps JOIN soil USING (col, row))"


def _idw_sql(band: str) -> str:
    s = f"(SELECT col, row, {band} AS z FROM {_TWO} WHERE {band} IS NOT NULL ORDER BY (col * 7919 + row * 104729) % 1000003, col, row LIMIT 80)"
    near = f"(SELECT c.col, c.row, z, CAST((s.col - c.col) * (s.col - c.col) + (s.row - c.row) * (s.row - c.row) AS DOUBLE) AS d2 FROM dem c JOIN {s} s ON (s.col - c.col) * (s.col - c.col) + (s.row - c.row) * (s.row - c.row) <= 49)"
    return f"(SELECT c.col, c.row, coalesce(max(z) FILTER (d2 = 0), sum(z / d2) FILTER (d2 > 0) / sum(1 / d2) FILTER (d2 > 0), any_value(m)) AS {band}, any_value(m) AS {band}_mean, any_value(sd) AS {band}_stdDev FROM dem c LEFT JOIN {near} n ON n.col = c.col AND n.row = c.row, (SELECT avg(z) AS m, stddev_pop(z) AS sd FROM {s}) GROUP BY c.col, c.row)"


_IDW_BANDS = [f"{b}{x}" for b in ("elevation", "ksat") for x in ("", "_mean", "_stdDev")]
_two = lambda fx: fx.dem_gaps().join(fx.soil(), CELL).select(*CELL, "elevation", F.when((F.col("col") + F.col("row")) % 7 != 0, F.col("ksat").cast("double")).alias("ksat"))
add("wf1_idw_two_bands", lambda fx: stepped(interpolate.idw(_two(fx), ["elevation", "ksat"], 7, 2, 80, statistics=True), *_IDW_BANDS), f"SELECT col, row, {', '.join(f'{step(x)} AS {x}' for x in _IDW_BANDS)} FROM {_idw_sql('elevation')} JOIN {_idw_sql('ksat')} USING (col, row)")

# --- workflows ---------------------------------------------------------------------------------------------------
add("wf2_twi", lambda fx: rounded(wf.twi(fx.dem_gaps(), fx.upslope(), 30.0), 5), f"SELECT col, row, round({_DEG}, 5) AS slope, round(ln(upa * 1e6 / CASE WHEN {_DEG} IS NOT NULL THEN greatest(tan(radians({_DEG})), 0.001) END), 5) AS twi FROM {_SLOPE} JOIN upslope USING (col, row)")
add("wf3_hand", lambda fx: wf.hand(fx.dem(), "elevation", "hand", zo.polygon_spans(fx.aoi(), fx.grid())), "SELECT col, row, elevation AS hand FROM dem WHERE col BETWEEN 5 AND 44")
add("wf4_terrain_stack", lambda fx: rounded(wf.terrain_stack(fx.dem_gaps(), 30.0, eastness=True)), f"SELECT col, row, elevation, round({_DEG}, 6) AS slope, round({_ASP}, 6) AS aspect, round(cos(radians({_ASP})), 6) AS northness, round(sin(radians({_ASP})), 6) AS eastness FROM {_SLOPE}")
add("wf5_canopy", lambda fx: wf.canopy_stack(fx.dem().withColumnRenamed("elevation", "height"), fx.upslope().withColumnRenamed("upa", "sd")), "SELECT col, row, elevation AS height, CAST(upa AS DOUBLE) AS sd FROM dem JOIN upslope USING (col, row)")
add("wf6_land_cover", lambda fx: wf.land_cover_series(fx.landcover(), date(1996, 1, 1), date(2000, 1, 1), zo.polygon_spans(fx.aoi(), fx.grid())), "SELECT year, col, row, b1 AS forest_lc_class, make_date(year, 1, 1) AS start_date, make_date(year + 1, 1, 1) AS end_date FROM landcover WHERE year BETWEEN 1996 AND 1999 AND col BETWEEN 5 AND 44")
add("wf7_species", lambda fx: wf.species_series(fx.species(), date(1996, 1, 1), date(2000, 1, 1)), "SELECT year, col, row, species AS forest_species_class, make_date(year, 1, 1) AS start_date, make_date(year + 1, 1, 1) AS end_date FROM species WHERE year BETWEEN 1996 AND 1999")
_H = {n: f"(({o} - ({i} * 10000.0)) / {s})" for (o, n), s, i in zip(scaling.OLI_TO_ETM_BANDS.items(), scaling.OLI_SLOPES, scaling.OLI_INTERCEPTS)}
_LS1 = ", ".join(f"(CASE WHEN sensor IN ('LC08', 'LC09') THEN {_H[b]} ELSE {b} END) * 0.0000275 + -0.2 AS {b}" for b in SR)
_LS = f"(SELECT start_date, col, row, {when(f'ok AND least({", ".join(SR)}) >= 0', SR)} FROM (SELECT start_date, col, row, QA_PIXEL & 56 = 0 AS ok, {_LS1} FROM pixels_ls JOIN used USING (image_id)))"
_LSQ = f"SELECT start_date, col, row, {', '.join(step(f'avg({b})') + f' AS {b}' for b in SR)}, {step('avg(' + index_sql('NDVI', ix.LANDSAT) + ')')} AS NDVI, {step('avg(' + index_sql('EVI', ix.LANDSAT) + ')')} AS EVI, CAST(month(start_date) AS INT) AS month, CAST(year(start_date) AS INT) AS year FROM {_LS} GROUP BY start_date, col, row"
_series = lambda fx: wf.landsat_series(fx.scenes(), fx.pixels_ls(), fx.windows(), ["NDVI", "EVI"], fill_gaps=False, intercept_scale=10000.0)
add("wf8_landsat_series", lambda fx: stepped(_series(fx), *SR, "NDVI", "EVI"), _LSQ)
add("wf8_landsat_filled", lambda fx: rounded(wf.landsat_series(fx.scenes(), fx.pixels_ls(), fx.windows(), ["NDVI"], grid=fx.grid(), aoi=zo.polygon_spans(fx.aoi(), fx.grid())).select("start_date", *CELL, "NDVI"), 5), f"""SELECT start_date, a.col, a.row, round(coalesce(any_value(a.v), sum(b.v * exp(-((a.col - b.col) * (a.col - b.col) + (a.row - b.row) * (a.row - b.row)) / 2.0)) / sum(CASE WHEN b.v IS NOT NULL THEN exp(-((a.col - b.col) * (a.col - b.col) + (a.row - b.row) * (a.row - b.row)) / 2.0) END)), 5) AS NDVI
    FROM (SELECT start_date, dem.col, dem.row, v FROM (SELECT DISTINCT start_date FROM used) CROSS JOIN dem LEFT JOIN (SELECT start_date, col, row, avg({index_sql("NDVI", ix.LANDSAT)}) AS v FROM {_LS} GROUP BY ALL) USING (start_date, col, row)) a
    JOIN (SELECT start_date, col, row, avg({index_sql("NDVI", ix.LANDSAT)}) AS v FROM {_LS} GROUP BY ALL) b USING (start_date)
    WHERE a.col - b.col BETWEEN -3 AND 3 AND a.row - b.row BETWEEN -3 AND 3 AND a.col BETWEEN 5 AND 44 GROUP BY start_date, a.col, a.row""")
add("wf9_sentinel_series", lambda fx: rounded(wf.sentinel_series(fx.scenes(), fx.pixels_s2(), fx.windows(), ["NDVI", "RDI"], earliest=date(1996, 8, 1)).select("start_date", *CELL, "B8", "NDVI", "RDI", "month", "year")), f"SELECT start_date, col, row, round(median(B8), 6) AS B8, round(median({nd('B8', 'B4')}), 6) AS NDVI, round(median(B12 / nullif(B8A, 0)), 6) AS RDI, CAST(month(start_date) AS INT) AS month, CAST(year(start_date) AS INT) AS year FROM s2 JOIN (SELECT image_id, cloud_pct, f.start_date FROM scenes JOIN ({_FLOORED}) f ON time_start >= f.start_date AND time_start < f.end_date) USING (image_id) WHERE cloud_pct < 20 GROUP BY start_date, col, row")
add("wf10_soil_points", lambda fx: rounded(wf.soil_stack(fx.soil(), ["clay_0_5cm"], ["clay"], fx.points(), fx.grid())["points"], 3), "SELECT point_id, round(clay_0_5cm / 10.0, 3) AS clay_0_5cm FROM point_cells JOIN soil USING (col, row)")
add("wf10_soil_coarse", lambda fx: rounded(wf.soil_stack(fx.soil(), ["clay_0_5cm"], ["clay"])["coarse"], 4), "SELECT CAST(col // 4 AS INT) AS col, CAST(row // 4 AS INT) AS row, round(avg(clay_0_5cm / 10.0), 4) AS clay_0_5cm FROM soil GROUP BY col // 4, row // 4")
add("wf11_hydrosoil", lambda fx: rounded(wf.hydrosoil_stack(fx.soil(), ["ksat"], ["stc"]).withColumn("stc", F.col("stc").cast("int")), 6), "SELECT col, row, round(k, 6) AS ksat, stc FROM (SELECT CAST(col // 4 AS INT) AS col, CAST(row // 4 AS INT) AS row, stc, row_number() OVER (PARTITION BY col // 4, row // 4 ORDER BY count(*) DESC, stc) AS rn, sum(sum(CAST(CAST(ksat * 0.0001 AS FLOAT) AS DOUBLE))) OVER (PARTITION BY col // 4, row // 4) / sum(count(*)) OVER (PARTITION BY col // 4, row // 4) AS k FROM soil GROUP BY col // 4, row // 4, stc) WHERE rn = 1")
add(
    "wf11_hydrosoil_points",
    lambda fx: rounded(wf.hydrosoil_points(wf.hydrosoil_image(_hydrosoil(fx), _DEPTHS, ["ksat", "stc"], {"stc": ["0-5cm"]}), fx.points(), fx.grid(), ["ksat_0-5cm", "ksat_5-15cm"], ["0-5cm"]).withColumn("0-5cm", F.col("0-5cm").cast("int"))),
    f'SELECT point_id, batch, round(k0 * 0.0001, 6) AS "ksat_0-5cm", round(k5 * 0.0001, 6) AS "ksat_5-15cm", CAST(s0 AS INT) AS "0-5cm" FROM point_cells JOIN ({_HS}) USING (col, row)',
)
add("wf12_phenology", lambda fx: rounded(wf.phenology_series(fx.phenology(), ["EVI_Area_1"], {"0": 0, "150": 2}, fx.grid()), 6), f"SELECT a.year, a.col, a.row, round(CAST(CAST(any_value(a.EVI_Area_1) * 0.1 AS FLOAT) AS DOUBLE), 6) AS EVI_Area_1_0, round(avg(CAST(CAST(b.EVI_Area_1 * 0.1 AS FLOAT) AS DOUBLE)), 6) AS EVI_Area_1_150 FROM phenology a JOIN phenology b ON a.year = b.year AND {circle(2)} GROUP BY a.year, a.col, a.row")
add("wf13_polygon_summary", lambda fx: stepped(wf.polygon_summary(_series(fx), zo.polygon_spans(fx.polygons(), fx.grid()), ["NDVI"]), "NDVI_mean"), f"SELECT feature_id, start_date, {step('avg(v)')} AS NDVI_mean FROM (SELECT start_date, col, row, avg({index_sql('NDVI', ix.LANDSAT)}) AS v FROM {_LS} GROUP BY ALL) JOIN poly_cells USING (col, row) GROUP BY ALL")
_ALL13 = list(ix.LANDSAT.indices)
add(
    "wf13_all_indices",
    lambda fx: stepped(x := wf.polygon_summary(wf.landsat_series(fx.scenes(), fx.pixels_ls(), fx.windows(), _ALL13, fill_gaps=False, intercept_scale=10000.0), zo.polygon_spans(fx.polygons(), fx.grid()), _ALL13), *x.columns[2:]),
    f"SELECT feature_id, start_date, {', '.join(f'{step(f'avg({n})')} AS {n}_mean' for n in _ALL13)} FROM (SELECT start_date, col, row, {', '.join(f'avg({index_sql(n, ix.LANDSAT)}) AS {n}' for n in _ALL13)} FROM {_LS} GROUP BY ALL) JOIN poly_cells USING (col, row) GROUP BY ALL",
)
_TPI = f"(SELECT col, row, z - avg(v) AS elevation FROM {around(circle(3), 'dem')} GROUP BY col, row, z)"
add("e3_tpi_to_coarse", lambda fx: wf.tpi_to_coarse(fx.dem(), 3, *(Grid(50, fx.n_rows(), 0, 0, 30, 30), _coarse(fx)[1])).withColumn("tpi_3", F.col("tpi_3").cast("int")), f"SELECT col, row, CAST(round_even(sum(w * elevation) / sum(w), 0) AS INT) AS tpi_3 FROM {_OVER.replace('dem_gaps', _TPI)} GROUP BY col, row")

# --- checks ------------------------------------------------------------------------------------------------------


def _grids(fx: Fixture) -> DataFrame:
    k = F.col("n_nationkey")
    x0 = k % 3 * 15.0 + F.when(k % 4 == 3, 0.05).when(k % 4 == 2, 0.00004).otherwise(0.0)  # 0.05 m off is off, 0.00004 m is not
    return fx.read("nation").select(k.alias("raster"), F.when(k % 7 == 0, "EPSG:3978").otherwise("EPSG:3400").alias("crs"), x0.alias("x0"), (k % 2 * 30.0).alias("y0"), F.when(k % 5 == 0, 25.0).otherwise(30.0).alias("dx"), F.lit(30.0).alias("dy"), F.lit(98).alias("n_cols"), (k % 4 + 97).cast("int").alias("n_rows"))


def _fit(fx: Fixture) -> DataFrame:
    t = fx.spark.range(1).select(F.lit("EPSG:3400").alias("crs"), *[F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 0.0), ("dx", 30.0), ("dy", 30.0), ("n_cols", 100), ("n_rows", 100))])
    return rounded(qa.grid_fit(_grids(fx), t).select("raster", "offset_x", "offset_y", *[F.col(c).cast("int").alias(c) for c in ("crs_equal", "res_equal", "aligned", "same_extent", "stackable")]))


add(
    "qa1_grid_fit",
    _fit,
    """SELECT raster, round(ox, 6) AS offset_x, 0.0 AS offset_y, CAST(a AS INT) AS crs_equal, CAST(b AS INT) AS res_equal, CAST(a AND ox <= 0.0001 AS INT) AS aligned, 0 AS same_extent,
        CAST(a AND b AND ox <= 0.0001 AND x0 + dx * 98 <= 3000.0001 AND y0 + 30 * nr <= 3000.0001 AS INT) AS stackable
        FROM (SELECT *, least(x0 % 30, 30 - x0 % 30) AS ox FROM (SELECT n_nationkey AS raster, n_nationkey % 7 <> 0 AS a, n_nationkey % 5 <> 0 AS b, CASE WHEN n_nationkey % 5 = 0 THEN 25.0 ELSE 30.0 END AS dx, n_nationkey % 2 * 30.0 AS y0, n_nationkey % 4 + 97 AS nr,
            CAST(n_nationkey % 3 * 15.0 AS DOUBLE) + CASE n_nationkey % 4 WHEN 3 THEN 0.05 WHEN 2 THEN 0.00004 ELSE 0.0 END AS x0 FROM nation))""",
)
_EXTENTS = lambda fx: fx.read("nation").select(F.col("n_nationkey").alias("raster"), F.lit("EPSG:3400").alias("crs"), (F.col("n_nationkey") % 2 * 30.0).alias("x0"), (3000.0 - F.col("n_nationkey") % 3 * 7.5).alias("y0"), F.lit(30.0).alias("dx"), F.lit(-30.0).alias("dy"), (100 - F.col("n_nationkey") % 2).cast("int").alias("n_cols"), F.when(F.col("n_nationkey") % 5 == 1, 99).otherwise(100).alias("n_rows"))
_NORTH = lambda fx: fx.spark.range(1).select(F.lit("EPSG:3400").alias("crs"), *[F.lit(v).alias(n) for n, v in (("x0", 0.0), ("y0", 3000.0), ("dx", 30.0), ("dy", -30.0), ("n_cols", 100), ("n_rows", 100))])
add(
    "qa1_grid_extents",
    lambda fx: qa.grid_fit(_EXTENTS(fx), _NORTH(fx)).select("raster", "offset_x", "offset_y", *[F.col(c).cast("int").alias(c) for c in ("aligned", "same_extent", "stackable")]),
    """SELECT k AS raster, 0.0 * k AS offset_x, CASE k % 3 WHEN 1 THEN 7.5 WHEN 2 THEN 15.0 ELSE 0.0 END AS offset_y, CAST(k % 3 = 0 AS INT) AS aligned,
        CAST(k % 3 = 0 AND k % 2 = 0 AND k % 5 <> 1 AS INT) AS same_extent, CAST(k % 3 = 0 AS INT) AS stackable FROM (SELECT n_nationkey AS k FROM nation)""",
)
add("qa2_count_outside", lambda fx: qa.count_outside(fx.dem_gaps(), "elevation", zo.polygon_spans(fx.aoi(), fx.grid())), "SELECT count(elevation) AS n_outside, CAST(count(elevation) = 0 AS INT) AS in_boundary FROM dem_gaps WHERE col NOT BETWEEN 5 AND 44")
add("qa3_na_mask", lambda fx: qa.na_mask(densify(fx.dem_gaps().where("elevation is not null"), fx.grid()), "elevation"), "SELECT col, row, elevation, CASE WHEN elevation IS NULL THEN 1 ELSE 0 END AS na FROM dem_gaps")
add("qa4_checkerboard", lambda fx: qa.checkerboard(fx.spark, fx.grid(), zo.polygon_spans(fx.polygons(), fx.grid())), "SELECT DISTINCT col, row, (col + row) % 2 AS value FROM poly_cells")

# --- sources and sinks: written, then read again -----------------------------------------------------------------


def _folder(fx: Fixture, name: str) -> str:
    """A new folder in the shared one; on one machine where none is named, below the temporary folder."""
    import tempfile
    import uuid

    base = fx.spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not fx.spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="spark-rasterloom-")
    return f"{base.rstrip('/')}/rasterloom/{name}-{uuid.uuid4().hex}"


def _written(fx: Fixture, name: str, write: Callable[[str], object]) -> str:
    write(path := _folder(fx, name))
    return path


def _collection(fx: Fixture) -> DataFrame:
    rows = fx.read("part").count() * (YEARS[1] - YEARS[0] + 1)
    path = _written(fx, "collection", lambda p: io.write_collection(fx.landcover().withColumn("collection", F.lit("lc")), p, rows))
    return io.read_collection(fx.spark, path, "lc", [1996, 1997]).select("year", *CELL, "b1")


add("src1_collection", _collection, "SELECT year, col, row, b1 FROM landcover WHERE year IN (1996, 1997)")
add("src2_image", lambda fx: io.read_image(fx.spark, _written(fx, "image", lambda p: fx.soil().write.parquet(p)), ["ksat"]), "SELECT col, row, ksat FROM soil")
add("src3_features", lambda fx: io.read_features(fx.spark, _written(fx, "points", lambda p: io.write_table_csv(fx.points(), p)), "csv", "point_id long, x double, y double, batch int"), "SELECT point_id, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, batch FROM points")
_ROWS = [(1, [[(1.2, 1.2), (9.2, 1.2), (9.2, 6.2), (1.2, 6.2)], [(3.2, 2.2), (5.2, 2.2), (5.2, 4.2), (3.2, 4.2)]]), (2, [[(20.0, 3.0), (26.0, 3.0), (20.0, 9.0)]])]
add("src4_inline_features", lambda fx: rounded(zo.reduce_regions(fx.dem(), zo.polygon_spans(f := io.features_from_rows(fx.spark, _ROWS), fx.grid()), f, ["elevation"])), "SELECT CAST(k AS BIGINT) AS feature_id, round(avg(elevation), 6) AS elevation FROM (SELECT 1 AS k, elevation FROM dem WHERE col + 0.5 BETWEEN 1.2 AND 9.2 AND row + 0.5 BETWEEN 1.2 AND 6.2 AND NOT (col + 0.5 BETWEEN 3.2 AND 5.2 AND row + 0.5 BETWEEN 2.2 AND 4.2) UNION ALL SELECT 2, elevation FROM dem WHERE col >= 20 AND row >= 3 AND (col + 0.5 - 20) + (row + 0.5 - 3) < 6) GROUP BY k")


def _tiles(fx: Fixture, pattern: str = r"tile_\d\.d/.*\.parquet$") -> DataFrame:
    path = _folder(fx, "tiles")
    for i in range(3):
        fx.dem_gaps().where((F.col("row") % 3 == i) | (F.col("row") % 5 == 0)).withColumn("elevation", F.col("elevation") + i).coalesce(1).write.parquet(f"{path}/tile_{i}.d")
    return io.read_tiles(fx.spark, path, pattern).withColumn("order", F.regexp_extract("tile", r"tile_(\d)", 1))


def _one_tile(fx: Fixture) -> DataFrame:
    """A single file by its own path."""
    path = _written(fx, "tile", lambda p: fx.dem_gaps().coalesce(1).write.parquet(p))
    file = next(f for f in fx.spark.read.parquet(path).inputFiles())
    return io.read_tiles(fx.spark, file).select(*CELL, "elevation")


add("src5_tiles", lambda fx: _tiles(fx, r"^tile_1\.d/.*\.parquet$").select(*CELL, "elevation", F.col("order").cast("int").alias("tile")), "SELECT col, row, elevation + 1 AS elevation, 1 AS tile FROM dem_gaps WHERE row % 3 = 1 OR row % 5 = 0")
add("src5_single_file", _one_tile, "SELECT col, row, elevation FROM dem_gaps")


def _indexed(fx: Fixture) -> DataFrame:
    """The elevations in tiles of 8 rows and 25 columns, with their index."""
    path = _folder(fx, "indexed")
    tile = lambda c, n: F.floor(F.col(c) / n)
    fx.dem_gaps().withColumns({"down": tile("row", 8), "across": tile("col", 25)}).repartition("down", "across").write.partitionBy("down", "across").parquet(path)
    tiles.index_tiles(fx.spark, path)
    return tiles.open_tiles(fx.spark, path, cells=400)


add("src5_pruned", lambda fx: _indexed(fx).where(F.col("row").between(3, 20) & (F.col("col") >= 25) & F.col("tile").startswith("down=0/")).select(*CELL, "elevation"), "SELECT col, row, elevation FROM dem_gaps WHERE row BETWEEN 3 AND 7 AND col >= 25")
add("src6_mosaic_indexed", lambda fx: io.mosaic_tiles(_indexed(fx).where("row < 12"), "elevation"), "SELECT col, row, elevation FROM dem_gaps WHERE row < 12")
add("src6_mosaic_tiles", lambda fx: rounded(io.mosaic_tiles(_tiles(fx), "elevation", ["order"])), "SELECT col, row, round(elevation + CASE WHEN row % 5 = 0 THEN 2 ELSE row % 3 END, 6) AS elevation FROM dem_gaps")
add("src7_named_layers", lambda fx: io.read_named_layers(fx.spark, {n: _written(fx, n, lambda p, n=n: fx.soil().select(*CELL, F.col(n).cast("int").alias("b1")).write.parquet(p)) for n in ("ksat", "stc")}), "SELECT col, row, ksat, stc FROM soil")


def _back(fx: Fixture, write: Callable[[str], object], schema: str | None = None) -> DataFrame:
    path = _written(fx, "sink", write)
    return fx.spark.read.csv(path, header=True, schema=schema) if schema else fx.spark.read.parquet(path)


add("snk1_table_csv", lambda fx: _back(fx, lambda p: io.write_table_csv(fx.scenes().select("image_id", "cloud_pct", "sensor"), p), "image_id long, cloud_pct int, sensor string"), "SELECT image_id, cloud_pct, sensor FROM scenes")
add("snk2_stats_csv", lambda fx: _back(fx, lambda p: io.write_stats_csv(cp.reduce_region(fx.pixels_ls(), ["SR_B4"], ["minMax"]), p), "image_id long, SR_B4_min long, SR_B4_max long"), "SELECT image_id, min(SR_B4) AS SR_B4_min, max(SR_B4) AS SR_B4_max FROM pixels_ls GROUP BY image_id")
_NAME = lambda: F.when(F.col("year") != 1998, F.concat(F.lit("lc_"), F.col("year").cast("string")))
add("snk3_images", lambda fx: _back(fx, lambda p: io.write_images(fx.landcover(), p, _NAME())).select("year", *CELL, "b1", F.col("file_key").cast("string").alias("file_key")), "SELECT year, col, row, b1, 'lc_' || year AS file_key FROM landcover WHERE year <> 1998")
add("snk4_bands", lambda fx: _back(fx, lambda p: io.write_bands(fx.soil(), p, F.lit("soil"), ["ksat", "stc"])).select(*CELL, "band", "value"), "SELECT col, row, 'ksat' AS band, CAST(ksat AS DOUBLE) AS value FROM soil UNION ALL SELECT col, row, 'stc', CAST(stc AS DOUBLE) FROM soil")
add("snk5_on_grid", lambda fx: _back(fx, lambda p: io.write_on_grid(fx.dem_gaps(), p, ["elevation"], fx.grid(), _TARGET(fx))), _NEAREST)
add("snk5_at_scale", lambda fx: _back(fx, lambda p: io.write_on_grid(fx.dem_gaps(), p, ["elevation"], fx.grid(), scale=2.0)), "SELECT CAST(c AS INT) AS col, CAST(r AS INT) AS row, elevation FROM (SELECT unnest(range(0, 25)) AS c), (SELECT unnest(range(0, n_rows // 2)) AS r FROM g) LEFT JOIN dem_gaps d ON d.col = 2 * c + 1 AND d.row = 2 * r + 1")
add("snk6_batched", lambda fx: _back(fx, lambda p: io.write_batched(fx.points().select("point_id", "batch"), p), "point_id long, batch int, file_key string").select("point_id", "batch", "file_key"), "SELECT point_id, batch, 'points_batch' || lpad(CAST(batch AS VARCHAR), 2, '0') AS file_key FROM points")
add("snk7_round_and_cast", lambda fx: io.round_and_cast(fx.upslope().withColumn("upa", F.col("upa") * 50), ["upa"]).withColumn("upa", F.col("upa").cast("int")), "SELECT col, row, CAST(round_even(upa * 50, 0) AS INT) AS upa FROM upslope")

# --- aligned tables: bucketed by block, joined without a shuffle --------------------------------------------------


def _aligned(fx: Fixture, **rasters: DataFrame) -> list[DataFrame]:
    """The rasters as tables of 4 buckets or as many as the longest table they are made of needs, read again."""
    import uuid

    buckets = aligned.buckets_for(max(fx.read(t).count() for t in (["part", "lineitem"] if "pixels" in rasters else ["part"])))  # from the files' footers
    out = []
    for name, df in rasters.items():
        table = f"rasterloom_{name}_{uuid.uuid4().hex}"
        aligned.write_aligned(df, table, _folder(fx, "aligned"), buckets=buckets, side=8)
        out.append(aligned.read_aligned(fx.spark, table))
    return out


add("jn1_bucketed", lambda fx: aligned.join_aligned(*_aligned(fx, dem=fx.dem_gaps(), upslope=fx.upslope(), age=fx.forest_age())).drop("block"), "SELECT col, row, elevation, CAST(upa AS DOUBLE) AS upa, age FROM dem_gaps JOIN upslope USING (col, row) JOIN forest_age USING (col, row)")
add("jn6_bucketed_mask", lambda fx: aligned.mask_aligned(*_aligned(fx, pixels=fx.pixels_ls().select(*KEY, *LS), age=fx.forest_age()), F.col("age") > 60, LS).drop("block"), f"SELECT {KEYS}, {when('age > 60', LS)} FROM pixels_ls LEFT JOIN forest_age USING (col, row)")
