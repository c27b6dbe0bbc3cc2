"""Text formats around models: INI with unknown keys kept, a YAML subset, component XML, and the kernels models read."""

from __future__ import annotations

import json
import re
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ini_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, line, section, key, value, comment, text of INI lines of a file or folder; within a file the section runs on from the last header."""
    text = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("line", "text"))
    head = F.nullif(F.regexp_extract("text", r"^\s*\[([^\]]+)\]", 1), F.lit(""))
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kv = r"^\s*([^=#\[\s][^=#]*?)\s*=\s*([^#]*?)\s*(?:#\s*(.*))?$"
    rows = text.withColumn("section", F.last(head, ignorenulls=True).over(w))
    return rows.select("file", "line", "section", *[F.nullif(F.regexp_extract("text", kv, k), F.lit("")).alias(n) for k, n in ((1, "key"), (2, "value"), (3, "comment"))], "text")


def edit_ini(text: str, changes: dict[tuple[str, str], str]) -> str:
    """INI text with values of (section, key) replaced, whatever their case; everything else byte for byte."""
    section, left, out = "", {(s.lower(), k.lower()): v for (s, k), v in changes.items()}, []
    for line in text.splitlines(keepends=True):
        if m := re.match(r"\s*\[([^\]]+)\]", line):
            section = m.group(1).lower()
        elif m := re.match(r"(\s*([^=#\s][^=#]*?)\s*=\s*)([^#\r\n]*?)(\s*(?:#[^\r\n]*)?[\r\n]*)$", line):
            v = left.pop((section, m.group(2).lower()), None)
            if v is not None:
                line = m.group(1) + v + m.group(4)
        out.append(line)
    if left:
        raise KeyError(f"not in the file: {sorted(left)}")
    return "".join(out)


def set_section(text: str, section: str, body: dict[str, str] | None) -> str:
    """INI text with a section replaced, added, or, with None, removed; the same twice is the same as once."""
    parts = re.split(r"(?m)^(?=\s*\[)", text)
    kept = [p for p in parts if not re.match(rf"\s*\[{re.escape(section)}\]", p, re.IGNORECASE)]
    out = "".join(kept)
    if body is None:
        return out
    if out and not out.endswith("\n"):
        out += "\n"
    return out + f"[{section}]\n" + "".join(f"{k} = {v}\n" for k, v in body.items())


def yaml_subset(text: str) -> Any:
    """Nested mappings, lists of scalars and scalars by indentation; comments and quotes; or JSON."""
    if text.lstrip()[:1] in "{[":
        return json.loads(text)
    lines = [(len(x) - len(x.lstrip()), x.strip()) for raw in text.splitlines() if (x := re.sub(r"(^|\s)#.*$", "", raw).rstrip())]

    def scalar(v: str) -> Any:
        if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'":
            return v[1:-1]
        if v in ("", "~", "null"):
            return None
        if v.lower() in ("true", "false"):
            return v.lower() == "true"
        if v[0] == "[" and v[-1] == "]":
            return [scalar(x.strip()) for x in v[1:-1].split(",") if x.strip()]
        for kind in (int, float):
            try:
                return kind(v)
            except ValueError:
                pass
        return v

    def block(at: int, indent: int) -> tuple[Any, int]:
        if lines[at][1].startswith("- "):
            items = []
            while at < len(lines) and lines[at][0] == indent and lines[at][1].startswith("- "):
                items.append(scalar(lines[at][1][2:].strip()))
                at += 1
            return items, at
        out: dict[str, Any] = {}
        while at < len(lines) and lines[at][0] == indent:
            key, _, rest = lines[at][1].partition(":")
            at += 1
            if rest.strip():
                out[key.strip()] = scalar(rest.strip())
            elif at < len(lines) and lines[at][0] > indent:
                out[key.strip()], at = block(at, lines[at][0])
            else:
                out[key.strip()] = None
        return out, at

    return block(0, lines[0][0])[0] if lines else {}


def components(spark: SparkSession, path: str, tag: str = "component") -> DataFrame:
    """name, workingDir, inputFile of the components of a coupling file."""
    return spark.read.format("xml").option("rowTag", tag).schema("_name string, workingDir string, inputFile string").load(path).select(F.col("_name").alias("name"), "workingDir", "inputFile")


# Kernels ------------------------------------------------------------------------------------------------------


def xyz_lines(points: DataFrame) -> DataFrame:
    return points.select(F.format_string("%.3f %.3f %.4f", "x", "y", "z").alias("value"))


def arl_lines(links: DataFrame) -> DataFrame:
    """Roughness by link: x, y, z, number and fraction."""
    return links.select(F.format_string("%.3f %.3f %.3f %d %.4f", "x", "y", F.lit(0.0), "number", "fraction").alias("value"))


def bc_blocks(series: DataFrame, quantity: str, unit: str) -> DataFrame:
    """One block of text for each name (name, minute, value) with its series in order."""
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("minute", "value"))), lambda r: F.format_string("%.1f %.4f", r["minute"], r["value"])), "\n")
    head = F.concat(F.lit("[forcing]\nName = "), F.col("name"), F.lit(f"\nFunction = timeseries\nQuantity = time\nUnit = minutes\nQuantity = {quantity}\nUnit = {unit}\n"))
    return series.groupBy("name").agg(rows.alias("rows")).select("name", F.concat(head, "rows", F.lit("\n")).alias("value"))


def pol_blocks(rings: DataFrame) -> DataFrame:
    """Polygon text: name, count and coordinates (name, geometry of one ring)."""
    rows = F.array_join(F.transform("geometry", lambda p: F.format_string("%.3f %.3f", p["x"], p["y"])), "\n")
    return rings.select("name", F.concat("name", F.lit("\n"), F.size("geometry").cast("string"), F.lit(" 2\n"), rows, F.lit("\n")).alias("value"))


def ext_text(quantity: str, filename: str, filetype: int = 7, method: int = 6, averaging: int = 1, reach: float = 1.01) -> str:
    """One block of an old-style external forcing file: samples averaged in space, overwriting."""
    pairs = {"QUANTITY": quantity, "FILENAME": filename, "FILETYPE": filetype, "METHOD": method, "OPERAND": "O", "AVERAGINGTYPE": averaging, "RELATIVESEARCHCELLSIZE": reach}
    return "".join(f"{k}={v}\n" for k, v in pairs.items())


def bui_text(stations: dict[str, list[float]], seconds: int, start: datetime, name: str = "DEFAULT.BUI") -> str:
    """Rainfall of stations in equal steps, a line of values for each step; stations with fewer steps are dry at the end."""
    steps = max((len(v) for v in stations.values()), default=0)
    days, rest = divmod(steps * seconds, 86_400)
    hours, rest = divmod(rest, 3600)
    minutes, secs = divmod(rest, 60)
    at = f"{start.year} {start.month} {start.day} {start.hour} {start.minute} {start.second}"
    head = [f"*Name of this file: {name}", "*Date and time of construction: template", "*Format flag", "1", "*Number of stations", str(len(stations)), "*Station name(s)", *[f"'{s}'" for s in stations], "*Number of events, seconds per timestep", f"1 {seconds}", "*Event start (yyyy mm dd hh mm ss) and length (dd hh mm ss)", f"{at} {days} {hours:02d} {minutes} {secs}"]
    rows = [" ".join(str(v[k]) if k < len(v) else "0.0" for v in stations.values()) for k in range(steps)]
    return "\n".join([*head, *rows]) + "\n"


def write_text(lines: DataFrame, path: str, by: list[str] | None = None) -> None:
    """Lines as one text file in order; for files a model reads, which are small."""
    (lines.orderBy(*by) if by else lines).select("value").coalesce(1).write.mode("overwrite").text(path)
