"""Each registered query against its SQL, and the contract of the entry point."""

import __spark_entry__ as entry
import pytest

from txscreen.plans.oracle import SQL
from txscreen.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, compare):
    n = compare(QUERIES[name], SQL[name])
    assert n > 0 or name == "structured_split"


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_model_scores_are_probabilities(spark, data):
    rows = QUERIES["model_scores"](spark, data).collect()
    assert rows and all(0 <= r.ml_score <= 1 and 0 <= r.risk_score <= 1 for r in rows)


def test_scores_are_held_and_their_features_go(spark, data):
    """History runs once: the result reads scored rows, not a plan with history's shuffles, and leaves no table of features."""
    from txscreen.durable import names, shared_dir

    rows = QUERIES["model_scores"](spark, data)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in names(spark, shared_dir(spark)) if n.startswith("features-")]
    split = QUERIES["stratified_split"](spark, data).where("split = 'test'")
    assert sorted(r.event_id for r in rows.collect()) == sorted(r.event_id for r in split.collect())


def test_split_bounds_give_the_ranked_split(spark):
    from pyspark.sql import functions as F

    from txscreen.operators import training as T

    label = F.when(F.col("id") == 7, None).when(F.col("id") % 9 == 0, 1).otherwise(0)  # a label of one row, and a null one
    rows = spark.range(5000).select(F.col("id").alias("event_id"), F.when(F.col("id") == 8, 2).otherwise(label).alias("is_fraud"))
    want = T.stratified_split(rows).select("event_id", "split")
    got = T.with_split(rows, T.split_bounds(rows)).select("event_id", "split")
    assert got.count() == 5000 and not got.exceptAll(want).count()


def test_oversampling_reaches_the_ratio_and_stays_in_the_hull(spark, data):
    rows = QUERIES["smote_rows"](spark, data).toPandas()
    few, many = (rows.is_fraud == 1).sum(), (rows.is_fraud == 0).sum()
    assert few == int(many * 0.1)
    plain = rows[rows.is_fraud == 1]
    from txscreen.sources.tables import ledger

    real = ledger(spark, data).where("is_fraud = 1").toPandas()
    for c in ("amount", "oldbalance_org"):
        assert plain[c].between(real[c].min() - 1e-6, real[c].max() + 1e-6).all()


def test_load_profile(spark, data):
    row = QUERIES["load_profile"](spark, data).first()
    assert row.events == 2000 and row.alerts > 0 and row.tumbling > 0 and row.sliding >= row.tumbling


def test_requests_of_zero_amounts_are_broken_too(spark, compare, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    i = range(300)
    pq.write_table(pa.table({"event_id": pa.array(i, pa.int64()), "event_type": ["purchase"] * 300, "user_id": pa.array(i, pa.int64()), "value": [0.0 if k % 82 == 0 else 300.0 for k in i]}), tmp_path / "events.parquet")
    assert type(compare)(spark, str(tmp_path))(QUERIES["request_errors"], SQL["request_errors"]) == 3


def test_models_are_compared_and_one_is_selected(spark, data):
    from txscreen.plans.queries import compared

    rows = compared(spark, data, {"logreg": {"maxIter": 20}, "rf": {"numTrees": 10, "maxDepth": 5}, "gbt": {"maxIter": 6, "maxDepth": 4}}).collect()
    assert [r.model for r in rows] == ["logreg", "rf", "gbt"] and sum(r.selected for r in rows) == 1
    best = min(rows, key=lambda r: (r.validation_cost, -r.validation_auc_pr))
    assert best.selected and all(r.tp + r.fn == rows[0].tp + rows[0].fn and r.evaluated_thresholds > 1 for r in rows)


def test_boosted_trees_stop_early(spark, data):
    from pyspark.sql import functions as F

    from txscreen.operators import training as T

    # a label that one split tells, and validation rows that nothing tells
    rows = spark.range(600).select((F.col("id") % 100).cast("double").alias("x"), F.lit(1.0).alias("weight"), ((F.col("id") % 100) > 60).cast("int").alias("is_fraud"))
    noise = spark.range(200).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("weight"), F.pmod(F.xxhash64("id"), F.lit(2)).cast("int").alias("is_fraud"))
    stopped, whole = T.fit(rows, ["x"], "gbt", noise, maxIter=12, maxDepth=2), T.fit(rows, ["x"], "gbt", maxIter=12, maxDepth=2)
    assert stopped.stages[-1].getNumTrees < whole.stages[-1].getNumTrees == 12
    scored = T.predict(whole, rows)
    assert scored.where("(score > 0.5) <> (is_fraud = 1)").count() <= 30  # a bin of the split


def test_features_are_scaled_by_the_population_deviation(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    from txscreen.operators import training as T

    rows = spark.createDataFrame([(float(x), int(x > 3), 1.0) for x in (1, 2, 3, 4, 10)], "x double, is_fraud int, weight double")
    model = T.fit(rows, ["x"], "logreg", maxIter=2)
    z = model.transform(rows).select(vector_to_array("features")[0].alias("z")).agg(F.avg("z").alias("m"), F.stddev_pop("z").alias("s")).first()
    assert abs(z.m) < 1e-12 and abs(z.s - 1) < 1e-12


def test_feature_importances(spark, data):
    rows = QUERIES["feature_importances"](spark, data).collect()
    assert rows and sum(r.importance for r in rows) <= 1 + 1e-9 and [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)


def test_training_rows_come_in_bounded_parts(spark, monkeypatch):
    from pyspark.sql import functions as F

    from txscreen.operators import training as T

    monkeypatch.setattr(T, "TRAIN_ROWS", 100)
    rows = spark.range(0, 3000, 1, 1).select(F.col("id").alias("event_id"), (F.col("id") * 2.0).alias("x"))
    held = T.dealt(rows)
    sizes = [r["count"] for r in held.groupBy(F.spark_partition_id()).count().collect()]
    assert held.columns == ["x"] and sum(sizes) == 3000 and len(sizes) == 30 and max(sizes) < 160
    assert held.agg(F.sum("x")).first()[0] == sum(range(3000)) * 2
    held.unpersist()


def test_training_parts_fill_the_cores():
    from txscreen.operators import training as T

    n = T.TRAIN_ROWS
    assert T.train_parts(10, 12) == 12 and T.train_parts(15 * n, 12) == 24  # not 15: 3 tasks of a second round
    assert T.train_parts(54 * n, 12) == 60 and T.train_parts(71 * n, 12) == 71
    for rows in range(1, 40 * n, n // 3):
        parts = T.train_parts(rows, 12)
        assert rows <= parts * n and -(-parts // 12) * 12 * (1 - T.IDLE_SHARE) <= parts


def test_models_are_fitted_two_at_a_time(spark, data, monkeypatch):
    import threading

    from txscreen.operators import training as T
    from txscreen.plans.queries import compared

    both, before = threading.Barrier(2), T.fit

    def fit(train, names, kind="logreg", *rest, **params):
        if kind != "logreg":
            both.wait(120)  # one after the other would never meet
        return before(train, names, kind, *rest, **params)

    monkeypatch.setattr(T, "fit", fit)
    rows = compared(spark, data, {"logreg": {"maxIter": 2}, "rf": {"numTrees": 2, "maxDepth": 2}, "gbt": {"maxIter": 2, "maxDepth": 2}}).collect()
    assert [r.model for r in rows] == ["logreg", "rf", "gbt"]


def test_a_part_of_the_features_is_read_alone(spark, data):
    from txscreen.plans.queries import modelled

    with modelled(spark, data) as ((_, validation, test), _names):
        plans = [rows._jdf.queryExecution().executedPlan().toString() for rows in (validation, test)]
        counts = [rows.count() for rows in (validation, test)]
    split = QUERIES["stratified_split"](spark, data)
    assert all("PartitionFilters: [isnotnull(split" in p for p in plans)
    assert counts == [split.where(f"split = '{part}'").count() for part in ("validation", "test")]


def test_features_in_the_plan_are_those_of_the_stages(spark):
    from pyspark.ml.functions import vector_to_array

    from txscreen.operators import training as T

    # a constant column, a null, a column of integers
    rows = spark.createDataFrame([(k, k / 7, 5.0, k % 3) for k in range(50)], "id long, x double, y double, z int")
    before = T.preparation(rows, ["x", "y", "z"])
    odd = rows.unionByName(spark.createDataFrame([(50, None, 4.0, 1), (51, float("nan"), 5.0, None), (52, float("inf"), -0.0, 2)], rows.schema))
    pick = lambda made: [tuple(map(repr, r.f)) for r in made.orderBy("id").select(vector_to_array("features").alias("f")).collect()]
    assert pick(T.prepared(odd, before)) == pick(before.transform(odd)) and len(pick(odd.transform(T.prepared, before))) == 53


def test_classes_are_counted_once_for_their_weights(spark):
    from pyspark.sql import functions as F

    from txscreen.operators import training as T

    rows = spark.range(100).select("id", (F.col("id") % 10 == 0).cast("int").alias("is_fraud"))
    weighted = T.class_weights(rows)
    assert "Aggregate" not in weighted._jdf.queryExecution().executedPlan().toString()
    assert sorted({(r.is_fraud, round(r.weight, 9)) for r in weighted.collect()}) == [(0, round(100 / 180, 9)), (1, 5.0)]


def test_compared_models_share_one_preparation(spark, data, monkeypatch):
    from txscreen.operators import training as T
    from txscreen.plans.queries import compared

    made, before = [], T.StandardScaler.fit

    def fit(self, rows, *rest):
        made.append(rows)
        return before(self, rows, *rest)

    monkeypatch.setattr(T.StandardScaler, "fit", fit)
    rows = compared(spark, data, {"logreg": {"maxIter": 2}, "rf": {"numTrees": 2, "maxDepth": 2}, "gbt": {"maxIter": 2, "maxDepth": 2}}).collect()
    assert [r.model for r in rows] == ["logreg", "rf", "gbt"] and len(made) == 1


def test_alike_rows_lie_together(spark, data):
    from pyspark.sql import functions as F

    from txscreen.operators import training as T
    from txscreen.plans.queries import ALIKE, modelled

    rows = spark.range(0, 4000, 1, 4).select(F.col("id").alias("event_id"), F.pmod(F.xxhash64("id"), F.lit(3)).alias("x"))
    held = T.dealt(rows, alike=("x",))
    each = held.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), "x").orderBy("i").collect()
    assert len(each) == 4000 and all(a.p != b.p or a.x <= b.x for a, b in zip(each, each[1:], strict=False))
    held.unpersist()
    with modelled(spark, data, alike=ALIKE) as ((_, validation, _test), names):
        kept = validation.select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"), F.input_file_name().alias("f"), *ALIKE).orderBy("i").collect()
    assert set(ALIKE) <= set(names) and kept
    assert all((a.p, a.f) != (b.p, b.f) or tuple(a)[3:] <= tuple(b)[3:] for a, b in zip(kept, kept[1:], strict=False))
