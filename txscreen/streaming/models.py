"""The model that a stream scores with: a saved version, loaded once, replaced when a newer one is there."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ScreenConfig
from ..functions.scalars import feature_table
from ..operators import rules as R
from ..operators import training as T

LOG = logging.getLogger(__name__)
#: The version of scores without a model.
NO_MODEL = "v0"


@dataclass(frozen=True)
class Snapshot:
    version: str
    model: PipelineModel
    names: list[str]
    threshold: float | None


class ModelSnapshots:
    """The newest version under `root`, read when it is first asked for. A version that can't be read is logged once and passed over."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self.seen: str | None = None
        self.held: Snapshot | None = None
        self.loads = 0

    def __call__(self) -> Snapshot | None:
        newest = T.latest_version(self.spark, self.root)
        if newest is not None and newest != self.seen:
            self.seen = newest
            try:
                self.loads += 1
                model, names, threshold = T.load_model(self.spark, f"{self.root}/{newest}")
                self.held = Snapshot(newest, model, names, threshold)
            except Exception:
                LOG.exception("the model %s can't be read", newest)
                self.held = None
        return self.held


def score_with(rows: DataFrame, snapshot: Snapshot | None, cfg: ScreenConfig = ScreenConfig()) -> tuple[DataFrame, str]:
    """Rows with history, scored by the rules and the model in one plan, persisted; and the version that scored them.

    Without a model, or with one that fails on these rows, the model's part is 0 and the rules decide.
    """
    if snapshot is not None:
        try:
            table, _ = feature_table(rows)
            scored = R.score(T.predict(snapshot.model, table), cfg, F.col("score"), snapshot.threshold)
            done = scored.select(*rows.columns, *RESULTS).persist()
            done.count()  # a model that fails does so here
            return done, snapshot.version
        except Exception:
            LOG.exception("the model %s failed, the batch is scored by the rules", snapshot.version)
    return R.score(rows, cfg).persist(), NO_MODEL


RESULTS = ("triggered_rules", "rule_score", "severity", "is_alert", "ml_score", "risk_score")
Models = Callable[[], Snapshot | None]
