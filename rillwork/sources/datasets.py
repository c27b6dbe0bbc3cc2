"""Datasets of layers as versioned snapshots: dry runs, copies, overwrites, backups, marks and manifests.

A change is written to a new version folder; a small pointer file is replaced
last, so readers see either the old layers or all of the new ones. Layers that
didn't change are referred to, not copied.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import sanitised


class WriteMode(Enum):
    DRY_RUN = "dry run"
    COPY = "copy"
    OVERWRITE = "overwrite"


class _Files:
    """Small files on whatever file system holds the dataset."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def read(self, name: str) -> str | None:
        if not self.exists(name):
            return None
        s = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(s)).decode()
        finally:
            s.close()

    def write(self, name: str, text: str) -> None:
        new = self._path(name + ".new")
        out = self.fs.create(new, True)
        out.write(bytearray(text.encode()))
        out.close()
        self.fs.delete(self._path(name), False)
        if not self.fs.rename(new, self._path(name)):
            raise OSError(f"could not replace {name} in {self.root}")


@dataclass
class Dataset:
    """Layers under a root folder; `current.json` names the folder of each."""

    spark: SparkSession
    root: str
    order: list[str] = field(default_factory=list)

    def _manifest(self) -> dict:
        text = _Files(self.spark, self.root).read("current.json")
        return json.loads(text) if text else {"version": 0, "layers": {}, "counts": {}}

    def layers(self) -> list[str]:
        names = list(self._manifest()["layers"])
        return sorted(names, key=lambda n: (self.order.index(n) if n in self.order else len(self.order), n))

    def version(self) -> int:
        return self._manifest()["version"]

    def read(self, layer: str) -> DataFrame:
        at = {k.lower(): v for k, v in self._manifest()["layers"].items()}.get(layer.lower())
        if at is None:
            raise ValueError(f"no layer {layer}; there are {', '.join(self.layers())}")
        return self.spark.read.parquet(at)

    def commit(self, changes: dict[str, DataFrame], mode: WriteMode = WriteMode.OVERWRITE, dest: str | None = None, drop: list[str] = (), report: dict | None = None) -> Dataset:
        """Writes changed layers and flips the pointer. COPY leaves this dataset alone and refuses an existing copy; DRY_RUN only plans."""
        if mode is WriteMode.DRY_RUN:
            for df in changes.values():
                df.explain(mode="simple")
            return self
        old = self._manifest()
        target = self if mode is WriteMode.OVERWRITE else Dataset(self.spark, dest or self.root + "_cleaned", self.order)
        files = _Files(self.spark, target.root)
        if mode is WriteMode.COPY and files.exists("current.json"):
            raise FileExistsError(f"{target.root} is there already")
        version = old["version"] + 1
        layers, counts = {k: v for k, v in old["layers"].items() if k not in drop}, dict(old["counts"])
        for name, df in changes.items():
            at = f"{target.root}/v{version}/{name}"
            df.write.mode("overwrite").parquet(at)
            layers[name], counts[name] = at, self.spark.read.parquet(at).count()
        files.write("current.json", json.dumps({"version": version, "written": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()), "layers": layers, "counts": counts, "report": report or {}, "before": old["layers"]}, indent=1))
        return target

    def restored(self) -> Dataset:
        """Points back at the layers before the last commit."""
        m = self._manifest()
        _Files(self.spark, self.root).write("current.json", json.dumps({"version": m["version"] + 1, "layers": m.get("before", {}), "counts": {}, "before": m["layers"]}, indent=1))
        return self

    def mark(self, layer: str, marks: DataFrame, key: str) -> Dataset:
        """Adds to a layer of marks; earlier marks with the same key give way."""
        if layer in self.layers():
            marks = self.read(layer).join(marks.select(key).distinct(), key, "left_anti").unionByName(marks, allowMissingColumns=True)
        return self.commit({layer: marks})

    def stale(self, layer: str, of: str) -> bool:
        """Whether a layer of marks is older than the layer it marks."""
        at = self._manifest()["layers"]
        number = lambda p: int(p.rsplit("/v", 1)[1].split("/")[0])
        return number(at[layer]) < number(at[of])


def empty_layer(spark: SparkSession, columns: str, geometry: str = "line") -> DataFrame:
    """No rows of a layer with its typed geometry."""
    point = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    kind = {"point": point, "line": T.ArrayType(point), "polygon": T.ArrayType(T.ArrayType(point))}[geometry]
    base = spark.createDataFrame([], columns).schema
    return spark.createDataFrame([], T.StructType([*base.fields, T.StructField("geometry", kind)]))


def manifest(parts: dict[str, DataFrame], total: DataFrame) -> dict:
    """Counts of parts and whether they add up to the whole; raises if they don't."""
    counts = {n: df.count() for n, df in parts.items()}
    whole = total.count()
    if sum(counts.values()) != whole:
        raise ValueError(f"{counts} don't add up to {whole}")
    return {"total": whole, **counts}


def write_by_class(df: DataFrame, column: str, path: str) -> None:
    """One folder for each class value, with names fit for files."""
    df.withColumn("class", sanitised(F.col(column).cast("string"))).write.mode("overwrite").partitionBy("class").parquet(path)


def stale_files(names: list[str], base: str) -> list[str]:
    """Partition files <base>_0001_net.nc and the like among names; the network itself is no such file."""
    import re

    return sorted(n for n in names if re.fullmatch(rf"{re.escape(base)}_\d{{4}}(_\w+)?\.(nc|mdu|pol)", n))
