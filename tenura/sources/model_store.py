"""Saved models in versions that become visible as a whole."""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.operators.score import METADATA, PIPELINE, REPORT, AttritionModel
from tenura.sources.files import write_metadata, write_report

PUBLISHED, SCORED = "_PUBLISHED", "_SCORED"
#: Card with the means over folds, written beside the first one once they are known.
SCORED_CARD = "scored_metadata.json"
STORE_SETTING = "tenura.model.store"


def fingerprint(rows: DataFrame, settings: dict) -> str:
    """Name of a training: it follows the contents of the rows, in any order, and the settings."""
    total = F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")).cast("string")
    found = rows.agg(F.count("*").alias("n"), total.alias("total")).first()
    text = json.dumps([found["n"], found["total"], sorted(rows.dtypes), settings], sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


class ModelStore:
    """Folders ``root/name/fingerprint/run``; a run without its marker is not there for readers.

    A run is written under a name of its own and its marker is created last, so a writer that is lost leaves nothing
    that is read, and two writers of one training do not disturb each other. This needs no rename.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, place: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(place)

    def _files(self, place: str):
        return self._path(place).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, place: str) -> bool:
        return self._files(place).exists(self._path(place))

    def _mark(self, place: str) -> None:
        self._files(place).create(self._path(place), True).close()

    def _inside(self, place: str) -> list[str]:
        if not self._exists(place):
            return []
        return [s.getPath().getName() for s in self._files(place).listStatus(self._path(place)) if s.isDirectory()]

    def folder(self, name: str, version: str) -> str:
        return f"{self.root}/{name}/{version}"

    def publish(self, name: str, print_: str, pipeline: PipelineModel, card: dict) -> str:
        """Save a fitted pipeline and its card; gives the version."""
        version = f"{print_}/{uuid.uuid4().hex}"
        place = self.folder(name, version)
        pipeline.write().overwrite().save(f"{place}/{PIPELINE}")
        write_metadata(card, self.spark, f"{place}/{METADATA}")
        self._mark(f"{place}/{PUBLISHED}")
        return version

    def versions(self, name: str, print_: str | None = None) -> list[str]:
        """Published versions, the latest first; of one training only, if it is named."""
        prints = [print_] if print_ else self._inside(f"{self.root}/{name}")
        found = []
        for p in prints:
            for run in self._inside(f"{self.root}/{name}/{p}"):
                marker = f"{self.folder(name, f'{p}/{run}')}/{PUBLISHED}"
                if self._exists(marker):
                    found.append((self._files(marker).getFileStatus(self._path(marker)).getModificationTime(), f"{p}/{run}"))
        return [version for _, version in sorted(found, reverse=True)]

    def load(self, name: str, version: str | None = None) -> AttritionModel | None:
        """A published model, the latest if none is named; None if it is not there."""
        version = version or next(iter(self.versions(name)), None)
        if version is None or not self._exists(f"{self.folder(name, version)}/{PUBLISHED}"):
            return None
        place = self.folder(name, version)
        return AttritionModel.load(self.spark, place, SCORED_CARD if self.is_scored(name, version) else METADATA)

    def is_scored(self, name: str, version: str) -> bool:
        return self._exists(f"{self.folder(name, version)}/{SCORED}")

    def add_scores(self, name: str, version: str, card: dict, report: DataFrame) -> None:
        """The card with the means over folds, and the report; readers see them once both are written."""
        place = self.folder(name, version)
        write_metadata(card, self.spark, f"{place}/{SCORED_CARD}")
        write_report(report, f"{place}/{REPORT}")
        self._mark(f"{place}/{SCORED}")
