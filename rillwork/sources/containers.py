"""Containers of layers: GeoPackages and shapefiles as Spark data sources, and folders of Parquet layers.

`spark.dataSource.register(GpkgSource)` and then
`spark.read.format("gpkg").option("path", ...).option("layer", ...)`. A layer is
read in ranges of fid, one task each; a column list is taken from the schema
that is asked for, so unread columns never leave the file.
"""

from __future__ import annotations

import os
import sqlite3
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .wkb import decode

#: Storage classes of container columns.
_TYPES = {"INTEGER": T.LongType(), "INT": T.LongType(), "MEDIUMINT": T.LongType(), "SMALLINT": T.LongType(), "TINYINT": T.LongType(), "BOOLEAN": T.LongType(), "REAL": T.DoubleType(), "DOUBLE": T.DoubleType(), "FLOAT": T.DoubleType(), "BLOB": T.BinaryType()}
_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("z", T.DoubleType())])
PARTS = T.ArrayType(T.ArrayType(_POINT))


def gpkg_layers(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
        return [r[0] for r in con.execute("SELECT table_name FROM gpkg_contents ORDER BY table_name")]


def _found(path: str, layer: str) -> str:
    """A layer's name whatever its case; an error lists what there is."""
    names = gpkg_layers(path)
    hits = [n for n in names if n.lower() == layer.lower()]
    if not hits:
        raise ValueError(f"no layer {layer} in {path}; it has {', '.join(names)}")
    return layer if layer in hits else hits[0]


class _Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _GpkgReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.layer, self.parts = _found(options["path"], options["layer"]), int(options.get("partitions", "8"))
        self.bbox = [float(v) for v in options["bbox"].split(",")] if options.get("bbox") else None

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            low, high = con.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
        if low is None:
            return [_Range(0, -1)]
        step = -(-(high - low + 1) // self.parts)
        return [_Range(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, part: _Range) -> Iterator[tuple]:
        cols = [f.name for f in self.schema.fields]
        geometry = [k for k, f in enumerate(self.schema.fields) if f.dataType == PARTS]
        listed = ", ".join("rowid" if c == "fid" else f'"{c}"' for c in cols)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as con:
            for row in con.execute(f'SELECT {listed} FROM "{self.layer}" WHERE rowid BETWEEN ? AND ? ORDER BY rowid', (part.low, part.high)):
                row = list(row)
                keep = True
                for k in geometry:
                    got = decode(row[k])
                    row[k] = got[1] if got else None
                    if self.bbox:
                        x0, y0, x1, y1 = self.bbox
                        xs = [p[0] for r in row[k] or [] for p in r]
                        ys = [p[1] for r in row[k] or [] for p in r]
                        keep = bool(xs) and min(xs) <= x1 and max(xs) >= x0 and min(ys) <= y1 and max(ys) >= y0
                if keep:
                    yield tuple(row)


class GpkgSource(DataSource):
    """Options: path, layer, partitions (8), bbox 'x0,y0,x1,y1' (rows whose box meets it)."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> T.StructType:
        layer = _found(self.options["path"], self.options["layer"])
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as con:
            geometry = {r[0] for r in con.execute("SELECT column_name FROM gpkg_geometry_columns WHERE table_name = ?", (layer,))}
            info = con.execute(f'PRAGMA table_info("{layer}")').fetchall()
        fields = []
        for _, name, kind, _, _, pk in info:
            if pk:
                fields.append(T.StructField("fid", T.LongType()))
            elif name in geometry:
                fields.append(T.StructField(name, PARTS))
            else:
                fields.append(T.StructField(name, _TYPES.get(kind.upper().split("(")[0], T.StringType())))
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _GpkgReader(schema, dict(self.options))


# Shapefiles -----------------------------------------------------------------------------------------------


def _dbf_fields(f) -> tuple[int, int, int, list[tuple[str, str, int]]]:
    head = f.read(32)
    n, header, record = struct.unpack("<4xIHH", head[:12])
    fields = []
    while (b := f.read(1)) != b"\r":
        d = b + f.read(31)
        fields.append((d[:11].split(b"\0")[0].decode("latin-1"), chr(d[11]), d[16]))
    return n, header, record, fields


class _ShapeReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path, self.parts = schema, options["path"], int(options.get("partitions", "8"))

    def partitions(self) -> list[InputPartition]:
        with open(os.path.splitext(self.path)[0] + ".dbf", "rb") as f:
            n = _dbf_fields(f)[0]
        step = max(1, -(-n // self.parts))
        return [_Range(a, min(a + step, n) - 1) for a in range(0, max(n, 1), step)]

    def read(self, part: _Range) -> Iterator[tuple]:
        base = os.path.splitext(self.path)[0]
        with open(base + ".dbf", "rb") as dbf, open(base + ".shp", "rb") as shp, open(base + ".shx", "rb") as shx:
            _, header, record, fields = _dbf_fields(dbf)
            for k in range(part.low, part.high + 1):
                dbf.seek(header + k * record)
                raw = dbf.read(record)
                values, at = {}, 1
                for name, kind, width in fields:
                    text = raw[at : at + width].decode("latin-1").strip()
                    at += width
                    values[name] = (float(text) if text and set(text) - {"*"} else None) if kind in "NF" else text or None
                shx.seek(100 + 8 * k)
                offset, length = struct.unpack(">2i", shx.read(8))
                shp.seek(offset * 2 + 8)
                values["geometry"] = self._shape(shp.read(length * 2))
                values["fid"] = k
                yield tuple(values.get(f.name) for f in self.schema.fields)

    @staticmethod
    def _shape(b: bytes) -> list | None:
        if len(b) < 4:
            return None
        kind = struct.unpack_from("<i", b)[0] % 10
        if kind == 1:
            return [[(*struct.unpack_from("<2d", b, 4), None)]]
        if kind in (3, 5):
            n_parts, n_points = struct.unpack_from("<2i", b, 36)
            starts = [*struct.unpack_from(f"<{n_parts}i", b, 44), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", b, 44 + 4 * n_parts)
            return [[(flat[2 * i], flat[2 * i + 1], None) for i in range(a, e)] for a, e in zip(starts, starts[1:])]
        return None


class ShapefileSource(DataSource):
    """Options: path of the .shp, partitions (8). Numbers are double, all else text."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> T.StructType:
        with open(os.path.splitext(self.options["path"])[0] + ".dbf", "rb") as f:
            fields = _dbf_fields(f)[3]
        return T.StructType([T.StructField("fid", T.LongType())] + [T.StructField(n, T.DoubleType() if k in "NF" else T.StringType()) for n, k, _ in fields] + [T.StructField("geometry", PARTS)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ShapeReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GpkgSource)
    spark.dataSource.register(ShapefileSource)


# Folders of layers ------------------------------------------------------------------------------------------


def layer_path(spark: SparkSession, folder: str, layer: str) -> str | None:
    """Path of a Parquet layer in a folder on any file system, whatever its case; None if there is none."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = {}
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        names.setdefault(name.removesuffix(".parquet").lower(), st.getPath().toString())
    return names.get(layer.lower())


def layers(spark: SparkSession, folder: str) -> list[str]:
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName().removesuffix(".parquet") for st in fs.listStatus(root) if not st.getPath().getName().startswith(("_", ".")))


def in_box(df: DataFrame, x0: float, y0: float, x1: float, y1: float) -> DataFrame:
    """Rows whose stored box (minx..maxy) meets a window; these filters reach the Parquet scan."""
    return df.filter(f"minx <= {x1} and maxx >= {x0} and miny <= {y1} and maxy >= {y0}")


def csv_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with header, or no rows if there is no such file."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def layer_facts(spark: SparkSession, folder: str, layer: str) -> tuple[int, str | None]:
    """(rows, kind of the geometry column) from schema and footers, no data read."""
    path = layer_path(spark, folder, layer)
    if path is None:
        raise ValueError(f"no layer {layer} in {folder}; it has {', '.join(layers(spark, folder))}")
    df = spark.read.parquet(path)
    kind = {"struct": "point", "array": "line"}.get(dict((n, t.split("<")[0]) for n, t in df.dtypes).get("geometry", ""))
    if kind == "line" and dict(df.dtypes)["geometry"].startswith("array<array"):
        kind = "polygon"
    return df.count(), kind
