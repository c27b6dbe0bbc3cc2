"""A small complete dataset, and an empty one with the same schemas."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GEOM = "geometry array<struct<x:double,y:double>>"
_POINT = "geometry struct<x:double,y:double>"

#: Layers in the order they are written, with their columns.
SCHEMAS = {
    "hydroobject": f"code string, globalid string, objectid bigint, nen3610id string, naam string, ruwheidhoog double, ruwheidlaag double, typeruwheid string, lengte double, {_GEOM}",
    "duikersifonhevel": f"code string, globalid string, objectid bigint, nen3610id string, hoogtebinnenonderkantbov double, hoogtebinnenonderkantbene double, breedteopening double, {_GEOM}",
    "stuw": f"code string, globalid string, objectid bigint, nen3610id string, kruinbreedte double, laagstedoorstroomhoogte double, {_POINT}",
    "gemaal": f"code string, globalid string, objectid bigint, nen3610id string, functiegemaal string, maximalecapaciteit double, {_POINT}",
    "pomp": "code string, globalid string, objectid bigint, nen3610id string, gemaalid string, maximalecapaciteit double",
    "sturing": "code string, globalid string, objectid bigint, nen3610id string, pompid string, doelvariabele string, streefwaarde double",
    "regelmiddel": "code string, globalid string, objectid bigint, nen3610id string, stuwid string, overlaatonderlaat string, hoogteopening double",
    "crosssection_location": "branch_id string, definition string, chainage_fraction double, shift double",
    "storagenodes": f"code string, name string, {_POINT}",
}


def _guid(k: int) -> str:
    return f"{{00000000-0000-4000-8000-{k:012X}}}"


def _head(prefix: str, layer: str, k: int, seed: int) -> tuple:
    code = f"{prefix}_{k}"
    return code, _guid(seed * 1000 + k), k, f"NL.template.{layer}.{code}"


def sample(spark: SparkSession) -> dict[str, DataFrame]:
    """Three branches in a Y with a culvert, a weir, a pump with its control, sections and storage."""
    ends = {1: [(0.0, 0.0), (500.0, 0.0)], 2: [(500.0, 500.0), (500.0, 0.0)], 3: [(500.0, 0.0), (900.0, 0.0)]}
    line = lambda pts: [{"x": x, "y": y} for x, y in pts]
    length = lambda pts: abs(pts[0][0] - pts[1][0]) + abs(pts[0][1] - pts[1][1])
    rows = {
        "hydroobject": [(*_head("R", "hydroobject", k, 1), f"W_{k}", 30.0, 20.0, "StricklerKs", length(p), line(p)) for k, p in ends.items()],
        "duikersifonhevel": [(*_head("DU", "duikersifonhevel", 1, 2), 1.2, 1.1, 0.8, line([(200.0, 0.0), (220.0, 0.0)]))],
        "stuw": [(*_head("ST", "stuw", 1, 3), 3.0, 1.5, {"x": 700.0, "y": 0.0})],
        "gemaal": [(*_head("G", "gemaal", 1, 4), "Afvoergemaal", 20.0, {"x": 880.0, "y": 0.0})],
        "pomp": [(*_head("P_G", "pomp", 1, 5), _guid(4001), 20.0)],
        "sturing": [(*_head("S_G", "sturing", 1, 6), _guid(5001), "waterstand", 1.0)],
        "regelmiddel": [(*_head("R_ST", "regelmiddel", 1, 7), _guid(3001), "Overlaat", 0.5)],
        "crosssection_location": [(f"R_{k}", "trap_a", 0.5, 0.0) for k in ends],
        "storagenodes": [(f"M_{k}", f"M_{k}", {"x": p[0][0], "y": p[0][1]}) for k, p in ends.items()],
    }
    return {name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()}


def blank(spark: SparkSession) -> dict[str, DataFrame]:
    """The layers of the sample without rows."""
    return {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}


def numbered(df: DataFrame, layer: str, key: str) -> DataFrame:
    """df with objectid from 1 in key order, and the ids that follow from it."""
    from ..operators.cleaning import global_rank

    return global_rank(df, [key]).withColumn("objectid", F.col("rank")).drop("rank").withColumn("nen3610id", F.concat_ws(".", F.lit("NL.template"), F.lit(layer), F.col(key)))


def _rule(name: str, variable: str, message: str, function: dict) -> dict:
    return {"id": 0, "name": name, "type": "topologic", "validation_rule_set": "basic", "error_type": "critical", "result_variable": variable, "error_message": message, "active": True, "function": function}


#: The rules a validator of the data model reads; names and messages are what it shows.
VALIDATION_RULES = {
    "schema": "1.1",
    "hydamo_version": "2.2",
    "status_object": ["planvorming", "gerealiseerd"],
    "objects": [
        {"object": "profiellijn", "validation_rules": [_rule("Profiel moet intersecten met een waterlijn", "op_watergang", "niet op watergang", {"snaps_to_hydroobject": {"method": "overall"}})]},
        {"object": "duikersifonhevel", "validation_rules": [_rule("Duiker moet samenvallen met het hydroobject", "op_hydroobject", "niet op hydroobject", {"snaps_to_hydroobject": {"tolerance": 0.5, "method": "ends"}})]},
    ],
}


def write_rules(folder: str) -> str:
    """Writes ValidationRules.json into a folder; returns its path."""
    path = os.path.join(folder, "ValidationRules.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(VALIDATION_RULES, f, indent=2)
    return path
