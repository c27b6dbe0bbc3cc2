"""Running external builds, one per submodel, with a log each and a status table."""

from __future__ import annotations

import os
import subprocess
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

STATUS = "name string, code int, seconds double, log string, status string"


def run_builds(spark: SparkSession, commands: dict[str, list[str]], log_dir: str, workers: int = 3) -> DataFrame:
    """name, code, seconds, log, status ('OK' or 'FAILED') of commands run on the driver's machine, `workers` at a time.

    Output and errors of each go to <log_dir>/<name>.log. A command that can't be
    started has code NULL and counts as failed; no commands give no rows.
    """
    os.makedirs(log_dir, exist_ok=True)

    def run(item: tuple[str, list[str]]) -> tuple:
        name, command = item
        path, began, code = os.path.join(log_dir, f"{name}.log"), time.monotonic(), None
        with open(path, "w", encoding="utf-8") as log:
            try:
                code = subprocess.run(command, stdout=log, stderr=subprocess.STDOUT, check=False).returncode
            except OSError as e:
                log.write(f"{e}\n")
        return name, code, time.monotonic() - began, path, "OK" if code == 0 else "FAILED"

    with ThreadPoolExecutor(max_workers=workers) as pool:
        rows = list(pool.map(run, commands.items()))
    return spark.createDataFrame(rows, STATUS)
