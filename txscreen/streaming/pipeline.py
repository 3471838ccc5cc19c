"""The screening pipeline as Structured Streaming queries.

* integrate: three decoded feeds, one plan that joins and classifies each transaction, one sink that
  splits a batch into the integrated table and dead letters;
* orphans: states that no transaction asks for (they need the state side as the outer side), as dead letters;
* score: the integrated table as a stream; a batch is scored in one plan, by the rules and a model, over itself
  and the stored history that its windows reach (see state.py, models.py);
* publish_alerts: the alerts among the stored predictions, each once within a day;
* tumbling and sliding: window metrics of the integrated table.

Each batch writes into a folder of its own and replaces it when it is run again, and a ledger of
finished batches skips what a restart repeats (see ledger.py). A batch that ended before its mark was written is run again
and its folder gets new files, which the queries that stream from that folder read as new rows: the
score drops ids that the history of the last day has from other batches, and the windows drop ids that come twice
within the watermark, so results hold each row once.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ScreenConfig
from ..durable import exists
from ..operators import decode as D
from ..operators import history as H
from ..operators import integrate as J
from ..operators import metrics as M
from ..operators import rules as R
from ..sources import sinks
from ..sources.tables import FEEDS
from .ledger import Batches
from .models import Models, score_with
from .state import FAN, History, Pairs

ENVELOPE_DDL = "kafka_key STRING, raw_value STRING, kafka_timestamp TIMESTAMP, partition INT, offset LONG, source_topic STRING"
WATERMARK, TRIGGER = "10 minutes", "2 seconds"


def kafka_source(spark: SparkSession, servers: str, topic: str, per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select(F.col("key").cast("string").alias("kafka_key"), F.col("value").cast("string").alias("raw_value"), F.col("timestamp").alias("kafka_timestamp"), "partition", "offset", F.lit(topic).alias("source_topic"))


def file_source(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Envelopes in JSON files: the same columns as a topic."""
    reader = spark.readStream.schema(ENVELOPE_DDL)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.json(path)


def rule_changelog(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rule messages so far, for fold_rules()."""
    return spark.read.schema(schema).json(path)


class RuleSettings:
    """Settings for score(): the rules of the changelog, read again when `every` seconds have passed."""

    def __init__(self, changelog: Callable[[], DataFrame], every: float | None = None, cfg: ScreenConfig = ScreenConfig()) -> None:
        self.changelog, self.every, self.cfg = changelog, every, cfg
        self.held, self.read_at = cfg, None

    def __call__(self) -> ScreenConfig:
        now = time.monotonic()
        if self.read_at is None or (self.every is not None and now - self.read_at >= self.every):
            self.held, self.read_at = R.overlay(R.fold_rules(self.changelog(), self.cfg), self.cfg), now
        return self.held


def decoded(raw: DataFrame, feed: str) -> DataFrame:
    return D.decode(raw, FEEDS[feed], D.REQUIRED[feed], ("event_time", "producer_ts") if feed == "transactions" else ("event_time",))


def valid(rows: DataFrame, watermark: str = WATERMARK, once: bool = False) -> DataFrame:
    """The rows without an error; with once, an event id counts once within the watermark."""
    good = rows.where("error IS NULL").drop("error", *D.ENVELOPE).withWatermark("event_time", watermark)
    return good.dropDuplicatesWithinWatermark(["event_id"]) if once else good


def run_id(spark: SparkSession, root: str, reset: bool = False) -> str:
    """The run's id, kept beside its checkpoints."""
    if not reset and exists(spark, f"{root}/run"):
        row = spark.read.schema("run_id STRING").json(f"{root}/run").first()
        if row is not None:
            return row.run_id
    new = uuid.uuid4().hex
    spark.createDataFrame([(new,)], "run_id STRING").coalesce(1).write.mode("overwrite").json(f"{root}/run")
    return new


def start(rows: DataFrame, root: str, name: str, act: Callable[[DataFrame, int], None], trigger: dict | None = None) -> StreamingQuery:
    query = rows.writeStream.outputMode("append").foreachBatch(Batches(root, name).each(act)).option("checkpointLocation", f"{root}/checkpoints/{name}").queryName(name)
    return query.trigger(**(trigger or {"processingTime": TRIGGER})).start()


INTEGRATED_DDL = "event_id STRING, event_time TIMESTAMP, producer_ts TIMESTAMP, step INT, txn_type STRING, amount DOUBLE, name_orig STRING, oldbalance_org DOUBLE, newbalance_org DOUBLE, name_dest STRING, oldbalance_dest DOUBLE, newbalance_dest DOUBLE, is_fraud INT, schema_version INT"


def integrate(feeds: dict[str, DataFrame], root: str, trigger: dict | None = None) -> list[StreamingQuery]:
    """feeds: raw envelopes by name. Starts what fills `integrated` and `dead_letters` under root."""
    rows = {n: decoded(raw, n) for n, raw in feeds.items()}
    good = {n: valid(r) for n, r in rows.items()}

    def split(batch: DataFrame, n: int) -> None:
        batch = batch.persist()
        J.integrated(batch).write.mode("overwrite").parquet(f"{root}/integrated/batch={n}")
        letters = D.join_dead_letters(J.join_errors(batch))
        letters.write.mode("overwrite").json(f"{root}/dead_letters/query=integrate/batch={n}")
        batch.unpersist()

    def letters(name: str) -> Callable[[DataFrame, int], None]:
        return lambda batch, n: batch.write.mode("overwrite").json(f"{root}/dead_letters/query={name}/batch={n}")

    bad = D.dead_letters(rows["transactions"]).unionByName(D.dead_letters(rows["sender_state"])).unionByName(D.dead_letters(rows["receiver_state"]))
    joined = J.classified(good["transactions"], good["sender_state"], good["receiver_state"])
    orphans = [D.join_dead_letters(J.orphans(good[f"{r}_state"], good["transactions"], r, streaming=True)) for r in ("sender", "receiver")]
    return [
        start(bad, root, "decode", letters("decode"), trigger), start(joined, root, "integrate", split, trigger),
        start(orphans[0], root, "orphan_sender", letters("orphan_sender"), trigger), start(orphans[1], root, "orphan_receiver", letters("orphan_receiver"), trigger),
    ]


def keyed(rows: DataFrame) -> DataFrame:
    """Adds t and seq, by which history is ordered: a numeric id is its own seq, any other one is hashed."""
    return rows.withColumn("t", F.unix_seconds("event_time")).withColumn("seq", F.coalesce(F.col("event_id").try_cast("long"), F.xxhash64("event_id")))


def reach(cfg: ScreenConfig) -> int:
    return max(cfg.velocity_seconds, cfg.fan_out_seconds, cfg.fan_in_seconds, cfg.split_seconds, cfg.chain_seconds)


def batch_history(rows: DataFrame, past: DataFrame | None, pairs: DataFrame | None, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """rows with the history of what came before: past rows that a window reaches, and the known pairs."""
    rows = rows.withColumn("_new", F.lit(True))
    both = rows
    if past is not None:
        first = rows.agg(F.min("t")).first()[0]
        near = past.where(F.col("t") >= (first or 0) - reach(cfg))
        both = rows.unionByName(near.select([c for c in rows.columns if c != "_new"]).withColumn("_new", F.lit(False)))
    return H.with_history(both, cfg, pairs).where("_new").drop("_new")


def score_batch(rows: DataFrame, past: DataFrame | None, pairs: DataFrame | None, cfg: ScreenConfig = ScreenConfig()) -> DataFrame:
    """Scores rows by the rules, with what came before."""
    return R.score(batch_history(rows, past, pairs, cfg), cfg)


def unseen(rows: DataFrame, past: DataFrame | None) -> DataFrame:
    """The rows whose id the past hasn't; copies have one event time, so the past needs the times of the rows only."""
    one = rows.dropDuplicates(["event_id"])
    return one if past is None else one.join(past.select("event_id"), "event_id", "left_anti")


def score(spark: SparkSession, root: str, settings: Callable[[], ScreenConfig] = ScreenConfig, trigger: dict | None = None, models: Models | None = None, fan: int = FAN) -> StreamingQuery:
    """Scores the integrated table as it grows, with the rules and, if models() has one, with a model.

    settings() and models() are asked for each batch, so both can change while it runs. Rows of a benchmark run
    (`bench:<run>:...`) also leave when their batch was seen and when it was stored.
    """
    source = spark.readStream.schema(INTEGRATED_DDL).option("recursiveFileLookup", "true").parquet(f"{root}/integrated")
    pairs = Pairs(root, fan=fan)

    def act(batch: DataFrame, n: int) -> None:
        cfg, seen = settings(), datetime.now(UTC)
        came = keyed(batch).persist()
        low, high = came.agg(F.min("t"), F.max("t")).first()
        history = History(root, came.schema, reach(cfg), fan=fan)
        history.compact(spark, n, high)
        pairs.compact(spark, n, high)
        rows = unseen(came, history.since(spark, low, high, batch=n)).persist()
        known, anew = pairs.known(rows.select("name_orig", "name_dest", "t"), n)
        past = history.since(spark, low - reach(cfg), batch=n)
        done, version = score_with(batch_history(rows, past, known, cfg), models() if models else None, cfg)
        sinks.write_scored(done, root, str(n), version)
        timings = sinks.stage_timings(done, F.lit(seen), F.lit(datetime.now(UTC)))
        sinks.write_table(timings, root, "benchmark_stage_timings_by_run", str(n))
        anew = anew.persist()
        pairs.remember(rows, anew, n, low, high)
        history.add(rows, n, low, high)
        for held in (done, anew, rows, came):
            held.unpersist()

    return start(source, root, "score", act, trigger)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PREDICTIONS_DDL = "event_ts TIMESTAMP, event_id STRING, account_id STRING, name_dest STRING, txn_type STRING, amount DOUBLE, risk_score DOUBLE, severity STRING, ml_score DOUBLE, ml_model_version STRING, triggered_rules ARRAY<STRING>, is_alert BOOLEAN, alert_id STRING"


def publish_alerts(spark: SparkSession, root: str, run: str, publish: Callable[[DataFrame, str], None], trigger: dict | None = None, hours: int = 24, alerts: DataFrame | None = None) -> StreamingQuery:
    """Publishes the alerts of the stored predictions, an alert of a run once within `hours`.

    publish gets (key, value, topic) and the batch's name, under which a folder is replaced if the batch runs again: a broker gets
    such a batch twice. The time of an alert is when its prediction was stored (the file's time); alerts:
    another stream with the predictions' columns and stored_at. Keys are kept in RocksDB.
    """
    if alerts is None:
        stored = spark.readStream.schema(PREDICTIONS_DDL).option("recursiveFileLookup", "true").parquet(f"{root}/model_predictions_by_day")
        alerts = stored.withColumn("stored_at", F.col("_metadata.file_modification_time")).where("is_alert")
    once = sinks.once_within(alerts.where("is_alert").withColumn("run_id", F.lit(run)), "stored_at", hours)

    def act(batch: DataFrame, n: int) -> None:
        publish(D.alert_payloads(batch.drop("run_id", "stored_at")).withColumn("topic", F.lit("alerts")), str(n))

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKS)
    try:
        return start(once, root, f"publish_alerts_{run}" if run else "publish_alerts", act, trigger)
    finally:  # a started query keeps the setting
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)


def window_queries(spark: SparkSession, root: str, trigger: dict | None = None, publish: Callable[[DataFrame, str], None] | None = None) -> list[StreamingQuery]:
    """Windows are written once, when the watermark closes them; publish gets them as (key, value, topic), and the batch's name."""

    def act(kind: str) -> Callable[[DataFrame, int], None]:
        def run(batch: DataFrame, n: int) -> None:
            batch = batch.persist()
            sinks.write_metrics(batch, f"{root}/{kind}", str(n))
            if publish is not None:
                publish(M.payloads(batch).withColumn("topic", F.lit("metrics")), f"{kind}-{n}")
            batch.unpersist()

        return run

    source = spark.readStream.schema(INTEGRATED_DDL).option("recursiveFileLookup", "true").parquet(f"{root}/integrated").withWatermark("event_time", WATERMARK).dropDuplicatesWithinWatermark(["event_id"])
    kinds = {"tumbling": ("5 minutes", None), "sliding": ("10 minutes", "5 minutes")}
    return [start(M.window_metrics(source, k, size, slide), root, k, act(k), trigger) for k, (size, slide) in kinds.items()]
