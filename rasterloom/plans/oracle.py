"""The fixtures and shared steps as SQL for DuckDB; ``sql`` puts those that a query names in front of it."""

from __future__ import annotations

import re

_REF = {"b1": "0.02 + l_discount", "b2": "0.03 + l_tax", "b3": "0.02 + l_quantity / 500", "b4": "0.1 + l_extendedprice / 300000", "b5": "0.05 + l_discount + l_tax", "b6": "0.04 + 2 * l_tax", "b7": "0.01 + l_quantity / 400"}
_DN = {f"SR_B{i}": f"CAST(round(({_REF[f'b{i}']} + 0.2) / 0.0000275) AS BIGINT)" for i in range(1, 8)}
_S2 = {"B1": _REF["b1"], "B2": _REF["b1"], "B3": _REF["b2"], "B4": _REF["b3"], "B5": "0.05 + l_tax", "B6": "0.1 + l_discount", "B7": "0.12 + l_quantity / 400", "B8": _REF["b4"], "B8A": _REF["b4"], "B9": "0.05", "B11": _REF["b5"], "B12": _REF["b7"]}
_CELL = "CAST({k} % 50 AS INT) AS col, CAST({k} // 50 AS INT) AS row"
_PART = _CELL.format(k="p_partkey")
_CLASSES = ["water", "trees", "grass", "flooded_vegetation", "crops", "shrub_and_scrub", "built", "bare", "snow_and_ice"]
_YEARLY = "part, (SELECT CAST(unnest(range(1995, 2002)) AS INT) AS year)"

CTES = {
    "g": "SELECT CAST(count(*) // 50 AS INT) AS n_rows FROM part",
    "scenes": """SELECT o_orderkey AS image_id, o_orderdate AS time_start, CAST((o_orderkey * 37) % 100 AS INT) AS cloud_pct,
        CASE year(o_orderdate) WHEN 1995 THEN CASE WHEN p IN ('1', '2', '3') THEN 'LT05' ELSE 'LE07' END
             WHEN 1997 THEN CASE WHEN p IN ('1', '2') THEN 'LC08' WHEN p = '3' THEN 'LC09' ELSE 'LE07' END
             WHEN 1998 THEN 'LE07' WHEN 1999 THEN CASE WHEN p = '1' THEN 'LC09' ELSE 'LE07' END
             ELSE CASE WHEN year(o_orderdate) IN (1996, 2000, 2001) AND p = '1' THEN 'LT05' WHEN year(o_orderdate) IN (1996, 2000, 2001) AND p = '2' THEN 'LC08'
                       WHEN year(o_orderdate) IN (1996, 2000, 2001) AND p = '3' THEN 'LC09' ELSE 'LE07' END END AS sensor
        FROM (SELECT *, substr(o_orderpriority, 1, 1) AS p FROM orders)""",
    "lines": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
        ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) AS rn FROM lineitem) WHERE rn = 1""",
    "pixels_ls": f"""SELECT l_orderkey AS image_id, {_CELL.format(k="l_partkey")}, CASE WHEN l_suppkey % 17 = 0 THEN 6000 ELSE {_DN["SR_B1"]} END AS SR_B1,
        {", ".join(f"{v} AS {k}" for k, v in _DN.items() if k != "SR_B1")}, 40000 + CAST(l_quantity AS BIGINT) * 100 AS ST_B6,
        (l_suppkey * 7 + l_linenumber * 13) % 64 AS QA_PIXEL, CASE WHEN l_linenumber = 7 THEN 512 ELSE 0 END AS QA_RADSAT FROM lines""",
    "pixels_s2": f"""SELECT l_orderkey AS image_id, {_CELL.format(k="l_partkey")}, {", ".join(f"CAST(round(({v}) * 10000) AS BIGINT) AS {k}" for k, v in _S2.items())},
        CAST((l_linenumber % 4) * 1024 AS BIGINT) AS QA60, l_suppkey % 12 AS SCL FROM lines""",
    "dem": f"SELECT {_PART}, p_retailprice AS elevation FROM part",
    "dem_gaps": "SELECT col, row, CASE WHEN (col * 7 + row * 3) % 11 <> 0 THEN elevation END AS elevation FROM dem",
    "upslope": f"SELECT {_PART}, (p_size + 1) / 100 AS upa FROM part",
    "landcover": f"SELECT year, {_PART}, [0, 20, 31, 32, 33, 40, 50, 80, 81, 100, 210, 220, 230][(p_size + year) % 13 + 1] AS b1 FROM {_YEARLY}",
    "species": f"SELECT year, {_PART}, CAST((p_size + year) % 38 AS INT) AS species FROM {_YEARLY}",
    "forest_age": f"SELECT {_PART}, 2 * p_size AS age FROM part",
    "soil": f"SELECT {_PART}, p_size * 10 AS clay_0_5cm, CAST(p_partkey * 7 % 10000 AS INT) AS ksat, p_size % 6 + 1 AS stc FROM part",
    "phenology": f"SELECT year, {_PART}, p_size * 100 AS EVI_Minimum_1, p_size * 3 + year AS EVI_Area_1 FROM {_YEARLY} WHERE year < 1997",
    "class_probs": f"""SELECT CAST(vec_id % 100 % 50 AS INT) AS col, CAST(vec_id % 100 // 50 AS INT) AS row, make_timestamp(vec_id % 3 + 1996, vec_id % 12 + 1, 15, 0, 0, 0) AS time_start,
        {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(_CLASSES))} FROM embeddings""",
    "points": """SELECT c_custkey AS point_id, CASE WHEN c_custkey % 29 = 0 THEN -5.0 ELSE (c_custkey * 7) % 50 + 0.5 END AS x, (c_custkey * 13) % n_rows + 0.5 AS y,
        CAST(c_custkey % 10 + 1 AS INT) AS batch FROM customer, g""",
    "point_cells": "SELECT *, CASE WHEN x >= 0 THEN CAST(floor(x) AS INT) END AS col, CASE WHEN x >= 0 THEN CAST(floor(y) AS INT) END AS row FROM points",
    "polys": "SELECT CAST(n_nationkey AS BIGINT) AS feature_id, (n_nationkey * 7) % 45 + 0.25 AS px, (n_nationkey * 11) % 35 + 0.25 AS py, 3 + n_nationkey % 4 AS side, n_nationkey % 5 = 0 AS tri FROM nation",
    "poly_cells": """SELECT feature_id, col, row FROM polys, dem WHERE col + 0.5 >= px AND row + 0.5 >= py
        AND CASE WHEN tri THEN (col + 0.5 - px) + (row + 0.5 - py) < side ELSE col + 0.5 < px + side AND row + 0.5 < py + side END""",
    "windows": "SELECT make_date(y, 6, 1) AS start_date, make_date(y, 6, 1) + 121 AS end_date FROM (SELECT unnest(range(1995, 2002)) AS y)",
    "placed": "SELECT * FROM scenes JOIN windows ON time_start >= start_date AND time_start < end_date",
    "has": "SELECT start_date AS d, bool_or(sensor = 'LT05') AS old, bool_or(sensor IN ('LC08', 'LC09')) AS new FROM placed GROUP BY start_date",
    "used": """SELECT placed.* FROM placed JOIN has ON start_date = d
        WHERE (sensor = 'LT05' AND old) OR (sensor IN ('LC08', 'LC09') AND new) OR (sensor = 'LE07' AND NOT old AND NOT new)""",
    "sr": f"""SELECT image_id, col, row, QA_PIXEL, QA_RADSAT, {", ".join(f"SR_B{i} * 0.0000275 + -0.2 AS SR_B{i}" for i in range(1, 8))} FROM pixels_ls""",
    "s2": f"""SELECT image_id, col, row, SCL, {", ".join(f"CASE WHEN QA60 & 3072 = 0 THEN {b} / 10000.0 END AS {b}" for b in _S2)} FROM pixels_s2""",
}


def sql(body: str) -> str:
    """``body`` after the definitions that it and they need, in the order of CTES."""
    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(CTES[name])
    if not need:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in need) + "\n" + body
