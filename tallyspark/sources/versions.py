"""Period tables whose loads are seen whole or not at all, and can be read as of an earlier load."""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOAD, PERIOD = "_load", "period_id"
_MANIFEST = re.compile(r"([0-9]{10})[.]json")


@dataclass(frozen=True)
class VersionedTable:
    """A table under a folder: files of each load in a folder of its own, and a manifest per load.

    A manifest says which load each period is read from. It is written beside its final name and renamed, which file
    systems do at once and refuse if the name is taken. So a reader that has listed one manifest sees exactly its files,
    a load that stops early changes nothing, and of two loads at the same time the later one fails and can be repeated.
    Manifests have one entry per period.
    """

    spark: SparkSession
    folder: str

    def load(self, df: DataFrame, period_id: int) -> int:
        """Replace one period, also by no rows; returns the rows written."""
        number, periods = self._newest()
        counter = Observation()
        folder = f"{number + 1}-{uuid.uuid4().hex}"  # of its own, also where two loads take the same number
        path = self._load_path(folder, period_id)
        df.drop(PERIOD).observe(counter, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        self._commit(number + 1, periods | {str(period_id): folder})
        return counter.get["rows"]

    def drop(self, period_id: int) -> None:
        """Leave a period out from now on; earlier loads still have it."""
        number, periods = self._newest()
        self._commit(number + 1, {one: load for one, load in periods.items() if one != str(period_id)})

    def read(self, as_of: int | None = None) -> DataFrame:
        """All periods, of the newest load or as they were after load ``as_of``, with their number as ``period_id``."""
        number, periods = self._newest() if as_of is None else (as_of, self._manifest(as_of))
        if not periods:
            raise ValueError(f"no load has left rows in {self.folder}")
        paths = [self._load_path(load, int(period)) for period, load in sorted(periods.items())]
        rows = self.spark.read.option("basePath", f"{self.folder}/data").parquet(*paths)
        return rows.drop(LOAD)

    def loads(self) -> list[int]:
        """Numbers of the loads that can be read."""
        return sorted(int(found.group(1)) for name in self._names("manifests") if (found := _MANIFEST.fullmatch(name)))

    def forget(self, before: int) -> None:
        """Remove the manifests of older loads and the files that no manifest left needs."""
        kept = [number for number in self.loads() if number >= before]
        if not kept:
            raise ValueError("the newest load stays")
        needed = {load for number in kept for load in self._manifest(number).values()}
        for number in self.loads():
            if number < before:
                self._files().delete(self._path(self._manifest_path(number)), False)
        newest = kept[-1]
        for name in self._names("data"):
            load = name.partition("=")[2]
            if load not in needed and int(load.partition("-")[0]) <= newest:
                self._files().delete(self._path(f"{self.folder}/data/{name}"), True)

    # ---- files

    def _load_path(self, load: str, period_id: int) -> str:
        return f"{self.folder}/data/{LOAD}={load}/{PERIOD}={period_id}"

    def _manifest_path(self, number: int) -> str:
        return f"{self.folder}/manifests/{number:010d}.json"

    def _newest(self) -> tuple[int, dict[str, str]]:
        loads = self.loads()
        return (loads[-1], self._manifest(loads[-1])) if loads else (0, {})

    def _manifest(self, number: int) -> dict[str, str]:
        stream = self._files().open(self._path(self._manifest_path(number)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, number: int, periods: dict[str, str]) -> None:
        files = self._files()
        beside = self._path(f"{self._manifest_path(number)}.{self.spark.sparkContext.applicationId}")
        stream = files.create(beside, True)
        stream.write(json.dumps(periods, sort_keys=True).encode())
        stream.close()
        if files.exists(self._path(self._manifest_path(number))) or not files.rename(
            beside, self._path(self._manifest_path(number))
        ):
            files.delete(beside, False)
            raise RuntimeError(f"load {number} of {self.folder} was taken by another; repeat this one")

    def _names(self, part: str) -> list[str]:
        folder = self._path(f"{self.folder}/{part}")
        files = self._files()
        return [one.getPath().getName() for one in files.listStatus(folder)] if files.exists(folder) else []

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())
