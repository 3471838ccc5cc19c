"""The six controlled cases through file sources, a restart, scoring and windows."""

import json
import time

from pyspark.sql import functions as F

from txscreen.operators.integrate import expected_letters
from txscreen.streaming import cases
from txscreen.operators.rules import STATE_FIELDS as R_FIELDS
from txscreen.streaming import pipeline as P

ONCE = {"availableNow": True}


def run(queries):
    for q in queries:
        q.awaitTermination()


def feed(spark, root, run_id):
    for name, rows in cases.feeds(spark, run_id).items():
        rows.coalesce(1).write.mode("append").json(f"{root}/in/{name}")


def letters(spark, root):
    rows = spark.read.schema("key STRING, value STRING").option("recursiveFileLookup", "true").json(f"{root}/dead_letters")
    return rows.select(F.get_json_object("value", "$.source_key").alias("source_key"), F.get_json_object("value", "$.error").alias("error"))


def test_cases_scores_windows_and_restart(spark, tmp_path):
    root = str(tmp_path)
    feed(spark, root, "r1")
    start = lambda: P.integrate({n: P.file_source(spark, f"{root}/in/{n}") for n in ("transactions", "sender_state", "receiver_state")}, root, ONCE)
    run(start())
    seen = letters(spark, root)
    result = expected_letters(cases.expected(spark, "r1"), seen).collect()
    assert len(result) == 5 and all(r.ok for r in result), result
    assert seen.count() == 5
    done = spark.read.parquet(f"{root}/integrated")
    ids = [r.event_id for r in done.collect()]
    assert "r1-clean_integration" in ids and len(ids) == len(set(ids))

    run([P.score(spark, root, trigger=ONCE)])
    predictions = spark.read.parquet(f"{root}/model_predictions_by_day")
    assert predictions.count() == len(ids) and spark.read.parquet(f"{root}/account_state_by_account").count() == 2 * len(ids)
    run(P.window_queries(spark, root, ONCE))
    assert spark.read.parquet(f"{root}/tumbling/metrics_by_window").agg(F.sum("event_count")).first()[0] >= 1

    run(start())
    run([P.score(spark, root, trigger=ONCE)])
    assert letters(spark, root).count() == 5 and spark.read.parquet(f"{root}/model_predictions_by_day").count() == predictions.count()


def test_bad_messages_become_dead_letters(spark, tmp_path):
    root = str(tmp_path)
    body = {"event_id": "e1", "event_time": "2026-01-01T00:01:00+00:00", "producer_ts": "2026-01-01T00:01:00Z", "step": 1, "type": "TRANSFER", "amount": 1.0, "nameOrig": "C1", "nameDest": "C2", "isFraud": 0, "schema_version": 1}
    texts = ["{", json.dumps({**body, "nameOrig": None}), json.dumps({**body, "event_time": "soon"}), json.dumps({**body, "event_id": " "}), json.dumps({**body, "step": -1}), json.dumps(body)]
    rows = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "kafka_key STRING, raw_value STRING, offset LONG").withColumns({"kafka_timestamp": F.current_timestamp(), "partition": F.lit(0), "source_topic": F.lit("transactions")})
    rows.coalesce(1).write.json(f"{root}/in")
    got = P.decoded(P.file_source(spark, f"{root}/in"), "transactions").select("offset", "error")
    q = got.writeStream.format("memory").queryName("bad").trigger(**ONCE).start()
    q.awaitTermination()
    assert {r.offset: r.error for r in spark.table("bad").collect()} == {0: "json_parse_error", 1: "missing_required_fields", 2: "invalid_timestamp", 3: "data_quality_violation", 4: "data_quality_violation", 5: None}


def test_run_id_stays_until_reset(spark, tmp_path):
    a = P.run_id(spark, str(tmp_path))
    assert P.run_id(spark, str(tmp_path)) == a != P.run_id(spark, str(tmp_path), reset=True)


def test_batches_that_lost_their_marks_count_once(spark, tmp_path):
    """A crash before the mark and the commit: the batches run again and their folders get new files."""
    import shutil

    root, sent = str(tmp_path), []
    feed(spark, root, "r1")
    sources = lambda: {n: P.file_source(spark, f"{root}/in/{n}") for n in ("transactions", "sender_state", "receiver_state")}
    publish = lambda rows, batch: sent.extend(rows.collect())
    everything = lambda: (run(P.integrate(sources(), root, ONCE)), run([P.score(spark, root, trigger=ONCE)]), run([P.publish_alerts(spark, root, "r1", publish, ONCE)]), run(P.window_queries(spark, root, ONCE)))
    history = lambda: spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/history/data").count()
    counts = lambda: [spark.read.parquet(f"{root}/{n}").count() for n in ("model_predictions_by_day", "transactions_by_day", "account_state_by_account")] + [history()]
    everything()
    before, alerts = counts(), len(sent)
    # the integrate query forgets that it is done, and writes its batches again
    shutil.rmtree(f"{root}/processed_stream_batches")
    shutil.rmtree(f"{root}/checkpoints/integrate")
    everything()
    assert counts() == before and len(sent) == alerts
    ids = [r.event_id for r in spark.read.parquet(f"{root}/model_predictions_by_day").collect()]
    assert ids and len(ids) == len(set(ids))


def test_alerts_are_published_once_for_each_run(spark, tmp_path):
    from txscreen.operators import history as H
    from txscreen.operators import rules as R
    from txscreen.operators.decode import predictions
    from txscreen.sources import sinks
    from txscreen.sources.tables import ledger

    sent, root = [], str(tmp_path)
    scored = R.score(H.with_history(ledger(spark, "/root/testdata/sf0.001"))).where("event_id < 400").persist()
    n = scored.where("is_alert").count()
    publish = lambda rows, batch: sent.extend(r.key for r in rows.collect())
    for name, batch in (("a", "0"), ("a", "1"), ("b", "2")):
        sinks.write_table(predictions(scored), root, "model_predictions_by_day", batch)
        run([P.publish_alerts(spark, root, name, publish, ONCE)])
    assert n and len(sent) == 2 * n and len(set(sent)) == n
    for batch in ("x", "y", "y"):
        sinks.publish(scored.selectExpr("string(event_id) AS key", "'x' AS value", "'t' AS topic"), path=f"{root}/topic", batch=batch)
    assert spark.read.json(f"{root}/topic").count() == 2 * scored.count()


def test_the_same_alert_comes_again_after_a_day(spark, tmp_path):
    from txscreen.operators.decode import predictions

    sent, root, hour, day0 = [], str(tmp_path), 3600, 1_767_225_600
    row = "event_time TIMESTAMP, event_id STRING, name_orig STRING, name_dest STRING, txn_type STRING, amount DOUBLE, risk_score DOUBLE, severity STRING, ml_score DOUBLE, triggered_rules ARRAY<STRING>, is_alert BOOLEAN"
    publish = lambda rows, batch: sent.extend((int(batch), r.key) for r in rows.collect())

    def come(at, *ids):
        made = spark.createDataFrame([(None, i, "C1", "C2", "TRANSFER", 1.0, 0.5, "medium", 0.0, ["r"], True) for i in ids], row)
        predictions(made).withColumn("stored_at", F.timestamp_seconds(F.lit(day0 + at))).coalesce(1).write.mode("append").parquet(f"{root}/in")
        alerts = spark.readStream.schema(P.PREDICTIONS_DDL + ", stored_at TIMESTAMP").parquet(f"{root}/in")
        run([P.publish_alerts(spark, root, "r", publish, ONCE, alerts=alerts)])

    come(0, "a", "a", "b")
    come(12 * hour, "c")
    come(23 * hour, "a", "c")
    come(int(24.5 * hour), "d")
    come(25 * hour, "a", "c", "d")
    assert sorted(k for _, k in sent) == ["alert:a", "alert:a", "alert:b", "alert:c", "alert:d"]
    # what is kept is bounded by the alerts of a day: the first two are gone from the state
    import glob

    state = spark.read.format("statestore").load(f"{root}/checkpoints/publish_alerts_r")
    assert glob.glob(f"{root}/checkpoints/publish_alerts_r/state") and state.count() == 3


def made_rows(spark, n, at, seconds, accounts=40, salt=0):
    i, k = F.col("id"), F.col("id") + salt
    return spark.range(n).select(
        F.concat(F.lit("e"), k).alias("event_id"), F.timestamp_seconds(at + i * seconds / n).alias("event_time"), F.lit(None).cast("timestamp").alias("producer_ts"), F.lit(1).alias("step"), F.element_at(F.array(*map(F.lit, ("TRANSFER", "CASH_OUT", "CASH_IN"))), (k % 3 + 1).cast("int")).alias("txn_type"),
        (((k * 7919) % 90_000) + 1.0).alias("amount"), F.concat(F.lit("C"), k * 31 % accounts).alias("name_orig"), F.lit(60_000.0).alias("oldbalance_org"), F.lit(100.0).alias("newbalance_org"), F.concat(F.lit("C"), k * 17 % 7).alias("name_dest"),
        F.lit(0.0).alias("oldbalance_dest"), F.lit(0.0).alias("newbalance_dest"), (k % 5 == 0).cast("int").alias("is_fraud"), F.lit(1).alias("schema_version"),
    )


def test_state_tables_stay_bounded_and_whole(spark, tmp_path):
    import os

    from txscreen.streaming.state import History, Pairs

    root, reach, keep, rows_read, folders, files = str(tmp_path), 600, 7200, [], [], []
    sent = []
    for n in range(44):
        at = 1_000_000 + n * 300
        batch = P.keyed(made_rows(spark, 20, at, 300, salt=20 * n))
        history, pairs = History(root, batch.schema, reach, keep, fan=4), Pairs(root, fan=4, bucket_rows=50)
        history.compact(spark, n, at + 299)
        pairs.compact(spark, n, at + 299)
        seen = {r.event_id for r in history.since(spark, at - reach, batch=n).select("event_id").collect()}
        # all rows that a window reaches, none missing
        assert seen == {e for t, e in sent if t >= at - reach}
        folders.append(len(history.folders))
        rows_read.append(len(seen))
        mine = batch.select("name_orig", "name_dest", "t").persist()
        known, anew = pairs.known(mine, n)
        uses = lambda k: (f"C{k * 31 % 40}", f"C{k * 17 % 7}")
        senders = {uses(k)[0] for k in range(20 * n, 20 * n + 20)}
        assert {tuple(r) for r in known.collect()} == {uses(k) for k in range(20 * n) if uses(k)[0] in senders} and anew.count() == 0
        pairs.remember(mine, anew, n, at, at + 299)
        history.add(batch, n, at, at + 299)
        sent += [(r.t, r.event_id) for r in batch.select("t", "event_id").collect()]
        files.append(sum(len(f) for _, _, f in os.walk(f"{root}/history")))
        mine.unpersist()
    # the history keeps 24 batches: from there on nothing grows
    assert max(rows_read[24:]) == max(rows_read[4:16]) and max(folders[24:]) <= max(folders[:20]) + 2
    assert max(files[36:]) <= 1.6 * max(files[24:32])
    every = {tuple(r) for r in pairs.known(spark.createDataFrame([(f"C{i}", None, at + 300) for i in range(40)], "name_orig string, name_dest string, t long"), 99)[0].collect()}
    assert every == {(f"C{k * 31 % 40}", f"C{k * 17 % 7}") for k in range(44 * 20)}


def test_pairs_are_forgotten_with_an_idle_sender(spark, tmp_path):
    from txscreen.streaming.state import Pairs

    day, last, chain, uses = 86_400, {}, {}, {}
    moves = [(0, "A", "x"), (1, "B", "x"), (20, "A", "y"), (45, "A", "x"), (46, "B", "x"), (60, "A", "z"), (91, "A", "x"), (92, "A", "z"), (100, "B", "y"), (101, "B", "x"), (131, "B", "x"), (131, "A", "x"), (140, "A", "z")]
    pairs = Pairs(str(tmp_path), fan=2, bucket_rows=2)
    for n, (d, a, b) in enumerate(moves):
        t = d * day
        pairs.compact(spark, n, t)
        rows = spark.createDataFrame([(a, b, t)], "name_orig string, name_dest string, t long")
        known, anew = pairs.known(rows, n)
        # a sender's pairs live while it is never idle for more than 30 days
        if a in last and t - last[a] > 30 * day:
            chain[a] = t
        want = {(a, y) for (x, y), u in uses.items() if x == a and u >= chain.get(a, -1)}
        assert {tuple(r) for r in known.collect()} == want, (n, d, a, b)
        pairs.remember(rows, anew, n, t, t)
        last[a], uses[a, b] = t, t


def stream_rows(spark, root, rows, name):
    rows.coalesce(1).write.parquet(f"{root}/integrated/batch={name}")


def test_many_batches_score_as_one(spark, tmp_path):
    """With deltas merged every two batches, what the stream scores is what one run over all rows scores; a benchmark's rows are timed."""
    from txscreen.operators import history as H
    from txscreen.operators import rules as R
    from txscreen.streaming.progress import Progress

    root = str(tmp_path)
    at, parts = 1_767_225_600, []
    seen = Progress()
    spark.streams.addListener(seen)
    for n in range(5):
        part = made_rows(spark, 60, at + n * 700, 700, accounts=5, salt=60 * n).withColumn("event_id", F.concat(F.lit("bench:r9:"), F.col("event_id")))
        parts.append(part)
        stream_rows(spark, root, part, n)
        run([P.score(spark, root, trigger=ONCE, fan=2)])
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    want = R.score(H.with_history(P.keyed(whole)))
    pick = lambda rows: sorted(map(tuple, rows.select("event_id", "risk_score", "severity", F.array_join("triggered_rules", ",")).collect()))
    assert pick(spark.read.parquet(f"{root}/model_predictions_by_day")) == pick(want)
    for _ in range(100):  # the listener hears of a batch a little later
        if sum(r[0] == "score" and r[3] > 0 for r in seen.rows) == 5:
            break
        time.sleep(0.2)
    spark.streams.removeListener(seen)
    told = seen.table(spark).where("query = 'score' AND input_rows > 0").collect()
    assert sorted(r.batch for r in told) == [0, 1, 2, 3, 4] and all(r.total_ms >= r.add_batch_ms > 0 for r in told)
    timed = spark.read.parquet(f"{root}/benchmark_stage_timings_by_run")
    # latencies of an actual run: published a second before they were seen
    from txscreen.operators import reports

    sent = timed.select(F.col("benchmark_run_id").alias("run"), F.lit("smoke").alias("profile"), "event_id", (F.col("spark_seen_at") - F.make_interval(secs=F.lit(1))).alias("published_at"))
    stages = reports.stage_latencies(sent, timed.withColumnRenamed("benchmark_run_id", "run"))
    assert stages.where("to_spark_ms = 1000 AND to_store_ms > 0 AND total_ms = to_spark_ms + to_store_ms AND NOT timed_out").count() == 300
    assert reports.latency_summary(stages, "total_ms", "profile").first().min > 1000
    assert timed.count() == 300 and timed.where("persisted_at > spark_seen_at AND benchmark_run_id = 'r9'").count() == 300


def test_a_saved_model_scores_in_the_stream(spark, tmp_path):
    from txscreen.functions.scalars import feature_table
    from txscreen.operators import history as H
    from txscreen.operators import rules as R
    from txscreen.operators import training as T
    from txscreen.streaming.models import NO_MODEL, ModelSnapshots, score_with

    root, at = str(tmp_path), 1_767_225_600
    rows = made_rows(spark, 300, at, 3000, accounts=9)
    history = H.with_history(P.keyed(rows))
    table, names = feature_table(history)
    model = T.fit(T.class_weights(table), names, "logreg", maxIter=5)
    models = ModelSnapshots(spark, f"{root}/models")
    assert models() is None
    version = T.publish_model(model, f"{root}/models", names, 0.4)
    stream_rows(spark, root, rows, 0)
    run([P.score(spark, root, trigger=ONCE, models=models)])
    want = R.score(T.predict(model, table), ml=F.col("score"), ml_threshold=0.4)
    pick = lambda df: sorted(map(tuple, df.select("event_id", "ml_score", "risk_score", "severity", "is_alert").collect()))
    stored = spark.read.parquet(f"{root}/model_predictions_by_day")
    assert pick(stored) == pick(want) and stored.where("ml_score > 0").count() > 0
    assert {r[0] for r in stored.select("ml_model_version").distinct().collect()} == {version}
    assert models() is models() and models.loads == 1
    # a version that can't be read, then one that fails on the rows: the rules decide
    T.publish_model(model, f"{root}/models", names, 0.4)
    import shutil

    shutil.rmtree(f"{root}/models/v2/model")
    assert models() is None
    T.publish_model(T.fit(T.class_weights(table.withColumn("other", F.lit(1.0))), ["other"], "logreg", maxIter=1), f"{root}/models", ["other"], 0.4)
    scored, used = score_with(history, models())
    assert used == NO_MODEL and pick(scored) == pick(R.score(history)) and scored.where("ml_score <> 0").count() == 0


def test_rules_are_read_again_when_due(spark, tmp_path):
    from txscreen.config import ScreenConfig

    fields = sorted({f for x in R_FIELDS.values() for f in x})
    schema = "offset LONG, rule_type STRING, txn_type STRING, " + ", ".join(f"{f} STRING" for f in fields)
    log = lambda rows: spark.createDataFrame([(i, "fan_out_threshold", None, *[v if f == "window_seconds" else None for f in fields]) for i, v in enumerate(rows)], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/rules")
    log(["700"])
    read = lambda: P.rule_changelog(spark, f"{tmp_path}/rules", schema)
    held, live = P.RuleSettings(read), P.RuleSettings(read, every=0)
    assert held().fan_out_seconds == live().fan_out_seconds == 700
    log(["700", "800"])
    assert held().fan_out_seconds == 700 and live().fan_out_seconds == 800
    log(["x", "x", "many"])
    assert live() == ScreenConfig()


def test_exports_and_report_inputs(spark, tmp_path):
    from txscreen.operators import reports
    from txscreen.operators.decode import back_typed
    from txscreen.sources import sinks, tables

    tx = tables.ledger(spark, "/root/testdata/sf0.001")
    sinks.export_test_set(tx, f"{tmp_path}/test")
    back = tables.read_ledger_csv(spark, f"{tmp_path}/test")
    assert back.count() == tx.count() and all(r.amount.split(".")[1].__len__() == 2 for r in back.limit(50).collect())
    sinks.export_features(tx, ["event_id", "amount"], f"{tmp_path}/features", limit=7)
    assert spark.read.option("header", True).csv(f"{tmp_path}/features").count() == 7
    rows = spark.createDataFrame([("a1", "e1", "closed", "false_positive", "x", "", None)], tables.REVIEWS_DDL)
    rows.write.option("header", True).csv(f"{tmp_path}/reviews")
    assert tables.read_report_csv(spark, f"{tmp_path}/reviews", tables.REVIEWS_DDL).first().review_status == "closed"
    load = reports.load_rows(spark, 100)
    assert load.count() == 100 and load.select("event_id").distinct().count() == 100
    got = back_typed(tx.withColumn("producer_ts", F.lit(None).cast("timestamp")).withColumn("schema_version", F.lit(None).cast("int"))).first()
    assert got.producer_ts == got.event_time and got.schema_version == 1
    timed = sinks.stage_timings(tx.select(F.concat(F.lit("bench:r9:"), F.col("event_id")).alias("event_id")), F.current_timestamp(), F.current_timestamp())
    assert timed.count() == tx.count() and timed.first().benchmark_run_id == "r9"


def test_concurrent_marks_are_all_kept(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from txscreen.streaming.ledger import Batches

    root, n = str(tmp_path), 100
    books = [Batches(root, f"q{k}") for k in range(8)]
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda b: [b.mark(spark, i) for i in range(n)], books))
    assert all(all(m) for m in made)
    assert all(b.done(spark, i) for b in books for i in range(n)) and not any(b.done(spark, n) for b in books)
    # eight writers of one query
    one = Batches(root, "shared")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: one.mark(spark, i), range(8 * n)))
    assert all(made) and all(one.done(spark, i) for i in range(8 * n))
    # a batch is marked once
    assert not one.mark(spark, 8 * n - 1) and not one.mark(spark, 0)


def test_the_ledger_stays_small(spark, tmp_path):
    from txscreen.durable import names
    from txscreen.streaming.ledger import Batches

    book = Batches(str(tmp_path), "q")
    for i in range(1000):
        if i != 500:
            book.mark(spark, i)
    # what comes after a gap is kept by file until the gap is closed
    assert book.upto(spark) == 499 and book.done(spark, 999) and not book.done(spark, 500)
    book.mark(spark, 500)
    for i in range(1000, 1088):
        book.mark(spark, i)
    assert book.upto(spark) == 1087 and book.done(spark, 3) and not book.done(spark, 1088)
    assert len(names(spark, book.path)) + len(names(spark, f"{book.path}/_upto")) <= 4


def test_a_ledger_is_published_at_a_rate_up_to_a_number(spark, tmp_path):
    from txscreen.sources.tables import ledger
    from txscreen.streaming.publish import Publisher

    root, sent = str(tmp_path), []
    tx = ledger(spark, "/root/testdata/sf0.001")
    publish = lambda rows, batch: sent.append((time.monotonic(), sorted((r.topic, r.key) for r in rows.collect())))
    maker = Publisher(tx, root, publish, rate=20, most=90, every=1.0, block=64)
    assert maker.run(timeout=120) and maker.end == 90
    first = [r.event_id for r in tx.orderBy("t", "seq").limit(90).select(F.col("event_id").cast("string").alias("event_id")).collect()]
    assert [len(rows) // 3 for _, rows in sent] == [20, 20, 20, 20, 10]
    for topic in ("transactions", "sender_state", "receiver_state"):
        assert [k for _, rows in sent for t, k in sorted(rows, key=lambda r: first.index(r[1])) if t == topic] == first
    assert sent[-1][0] - sent[0][0] >= 3.0
    # started again, it goes on after what it has published
    sent.clear()
    more = Publisher(tx, root, publish, rate=50, most=180, every=0.5, block=64)
    assert more.run(timeout=120)
    later = {k for _, rows in sent for _, k in rows}
    assert later <= {r.event_id for r in tx.orderBy("t", "seq").limit(180).select(F.col("event_id").cast("string").alias("event_id")).collect()} and not later & set(first[:80])
