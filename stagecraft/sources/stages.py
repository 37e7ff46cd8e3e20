"""A run's materialised table, kept so that a run that was cut off goes on from it.

A named run writes its table to ``<folder>/<run id>/table``, and beside it a marker with the
run's parameters once the table is complete. A later attempt of the same run finds the marker and
reads the table instead of computing it; one with other parameters is refused. A table without a
marker is the rest of an attempt that was lost while writing, and is written again. The folder goes
when the run has succeeded.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import json
import re

from pyspark.sql import DataFrame, SparkSession

from stagecraft.sources import storage
from stagecraft.sources.params import ParameterError, StageParams

_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._=+-]*")


@dataclasses.dataclass
class RunStage:
    """The stage table of one run in a folder that driver and executors share."""

    spark: SparkSession
    folder: str
    run_id: str

    def __post_init__(self) -> None:
        if not _RUN_ID.fullmatch(self.run_id):
            raise ParameterError(f"a run id has letters, digits and ._=+- only, got {self.run_id!r}")
        self.home = f"{self.folder.rstrip('/')}/{self.run_id}"

    def marker(self) -> dict | None:
        """What the marker says; None without a complete table."""
        text = storage.read_file(self.spark, f"{self.home}/marker.json")
        return None if text is None else json.loads(text)

    def resumable(self, params: StageParams, options: dict) -> StageParams | None:
        """The parameters of the attempt to go on from (with its audit timestamp, so that all rows
        of a run bear the same); None if there is none."""
        told = self.marker()
        if told is None:
            return None
        mine = describe(params, options)
        different = [k for k in sorted({*told, *mine} - {"run_ts", "schema"}) if told.get(k) != mine.get(k)]
        if different:
            raise ParameterError(f"run {self.run_id} was begun with other parameters: {', '.join(different)}")
        return dataclasses.replace(params, run_ts=dt.datetime.fromisoformat(told["run_ts"]))

    def write(self, df: DataFrame, params: StageParams, options: dict) -> DataFrame:
        """``df`` written and read back, with its marker."""
        storage.delete_path(self.spark, self.home)
        df.write.parquet(f"{self.home}/table")
        storage.write_file(self.spark, f"{self.home}/marker.json", json.dumps(describe(params, options) | {"schema": df.schema.json()}))
        return self.read()

    def read(self) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(json.loads(self.marker()["schema"]))
        return self.spark.read.schema(schema).parquet(f"{self.home}/table")

    def drop(self) -> None:
        storage.delete_path(self.spark, self.home)


def describe(params: StageParams, options: dict) -> dict[str, str]:
    """Parameters of a run as text, as its marker holds them."""
    told = {f.name: getattr(params, f.name) for f in dataclasses.fields(params)}
    shown = {k: v.isoformat() if isinstance(v, dt.date) else str(v) for k, v in told.items()}
    return shown | {k: str(v) for k, v in options.items()}
