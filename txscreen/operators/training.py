"""Training data, threshold choice, metrics over scored rows, and models of Spark ML."""

from __future__ import annotations

import json
import math

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..durable import exists, settle, shared_dir
from ..durable import names as folder_names
from ..plans.running import running_totals
from .neighbours import nearest

ALARM_COST, SEED = 5.0, 42


def drawn(*key: str, seed: int = SEED) -> Column:
    """A pseudorandom number of a row in 0 .. 2^60 - 1 that engines agree on: from the md5 of seed and key."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def stratified_split(rows: DataFrame, label: str = "is_fraud", key: str = "event_id", shares: tuple[float, float] = (0.6, 0.2), seed: int = SEED) -> DataFrame:
    """Adds split: train, validation, test, in the given shares of each label.

    A row's rank among its label decides; a label with nearly all rows isn't sorted in one task.
    """
    placed = ranked(rows.withColumn("_d", drawn(key, seed=seed)), "_d", key, label)
    rank = F.col("_rank") / F.col("_total")
    split = F.when(rank < shares[0], "train").when(rank < shares[0] + shares[1], "validation").otherwise("test")
    return placed.withColumn("split", split).drop("_d", "_rank", "_total")


def split_bounds(rows: DataFrame, label: str = "is_fraud", key: str = "event_id", shares: tuple[float, float] = (0.6, 0.2), seed: int = SEED) -> DataFrame:
    """A row for each label: the last (drawn number, key) of its train rows and of its validation rows.

    Only label and key are ranked and shuffled, so wide rows need no ranks: see with_split().
    """
    placed = stratified_split(rows.select(label, key), label, key, shares, seed)
    last = lambda *parts: F.max(F.when(F.col("split").isin(*parts), F.struct(drawn(key, seed=seed).alias("d"), F.col(key).alias("k"))))
    return placed.groupBy(F.col(label).alias("_l")).agg(last("train").alias("_train"), last("train", "validation").alias("_validation"))


def with_split(rows: DataFrame, bounds: DataFrame, label: str = "is_fraud", key: str = "event_id", seed: int = SEED) -> DataFrame:
    """Adds the split that stratified_split() gives each row, by comparison with split_bounds(). Rows of one key and label come to one part."""
    place = F.struct(drawn(key, seed=seed).alias("d"), F.col(key).alias("k"))
    # a label has one row, and there are two
    joined = rows.join(F.broadcast(bounds), rows[label].eqNullSafe(F.col("_l")))
    split = F.when(place <= F.col("_train"), "train").when(place <= F.col("_validation"), "validation").otherwise("test")
    return joined.withColumn("split", split).drop("_l", "_train", "_validation")


#: Bits of a drawn number, and buckets for each shuffle partition.
DRAW_BITS, BUCKETS_PER_TASK = 60, 16


def bucket_bits(spark: SparkSession) -> int:
    """Bits of a drawn number that name its bucket: buckets are parts of a task's share, so their size is the session's to set."""
    return max(8, (BUCKETS_PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def ranked(rows: DataFrame, place: str, key: str, label: str) -> DataFrame:
    """Adds _rank from 0 by (place, key) among the rows of a label, and their number _total.

    place is a drawn number, so its high bits deal the rows evenly over buckets; a task ranks one
    bucket, and what the buckets before it hold comes from one row for each bucket.
    """
    rows = rows.withColumn("_b", F.shiftright(place, DRAW_BITS - bucket_bits(rows.sparkSession)))
    counts = rows.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(label).orderBy("_b")
    bases = counts.select(F.col(label).alias("_l"), F.col("_b").alias("_k"), F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.sum("_n").over(Window.partitionBy(label)).alias("_total"))
    placed = rows.withColumn("_r", F.row_number().over(Window.partitionBy(label, "_b").orderBy(place, key)))
    joined = placed.join(bases, placed[label].eqNullSafe(F.col("_l")) & (F.col("_b") == F.col("_k")))
    return joined.withColumn("_rank", F.col("_base") + F.col("_r") - 1).drop("_b", "_l", "_k", "_base", "_r")


def balanced_sample(rows: DataFrame, label: str = "is_fraud", key: str = "event_id", seed: int = SEED) -> DataFrame:
    """All frauds and as many other rows, in a drawn order (`place`)."""
    n = rows.agg(F.count_if(F.col(label) == 1)).first()[0]
    placed = ranked(rows.withColumn("place", drawn(key, seed=seed)), "place", key, label)
    return placed.where((F.col(label) == 1) | ((F.col(label) == 0) & (F.col("_rank") < n))).drop("_rank", "_total")


def by_score(rows: DataFrame, score: str = "score", label: str = "is_fraud", amount: str = "amount") -> DataFrame:
    """A row for each distinct score with what an alert at that score or above catches.

    (score, n, run_n, run_pos, run_neg, run_amount): ties are one row; no order over all rows is needed.
    """
    bad = F.col(label) == 1
    groups = rows.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("pos"), F.count_if(~bad).alias("neg"), F.coalesce(F.sum(F.when(bad, F.col(amount))), F.lit(0.0)).alias("amount"))
    return running_totals(groups, "score", ["n", "pos", "neg", "amount"], descending=True)


def cost_curve(sweep: DataFrame, unit: float = ALARM_COST) -> DataFrame:
    """(threshold, cost) for each score and for no alert at all (threshold null)."""
    total = sweep.agg(F.coalesce(F.sum("amount"), F.lit(0.0)).alias("_all"))
    rows = sweep.crossJoin(F.broadcast(total)).select(F.col("score").alias("threshold"), F.round(F.col("_all") - F.col("run_amount") + unit * F.col("run_neg"), 2).alias("cost"))  # one row
    return rows.unionByName(total.select(F.lit(None).cast("double").alias("threshold"), F.round("_all", 2).alias("cost")))


def cheapest_threshold(sweep: DataFrame, unit: float = ALARM_COST) -> DataFrame:
    """One row: the highest threshold of least cost (null: no alert), the cost, and how many were tried."""
    order = F.struct(F.col("cost"), F.when(F.col("threshold").isNull(), F.lit(float("-inf"))).otherwise(-F.col("threshold")))
    return cost_curve(sweep, unit).agg(F.min_by("threshold", order).alias("threshold"), F.min("cost").alias("cost"), F.count(F.lit(1)).alias("evaluated_thresholds"))


def f1_curve(sweep: DataFrame) -> DataFrame:
    total = sweep.agg(F.sum("pos").alias("_pos"))
    p, r = F.col("run_pos") / F.col("run_n"), F.try_divide("run_pos", "_pos")
    rows = sweep.crossJoin(F.broadcast(total))  # one row
    return rows.select(F.col("score").alias("threshold"), p.alias("precision"), r.alias("recall"), (2 * p * r / (p + r + 1e-8)).alias("f1"))


def best_f1(sweep: DataFrame) -> DataFrame:
    """One row: the lowest threshold of the largest F1, with its precision and recall."""
    best = F.max_by(F.struct("threshold", "f1", "precision", "recall"), F.struct(F.round("f1", 12), -F.col("threshold")))
    return f1_curve(sweep).agg(best.alias("b")).select("b.*")


def average_precision(sweep: DataFrame) -> DataFrame:
    """One row: the sum over scores of the gain in recall times the precision there, and the ROC area by ranks."""
    total = sweep.agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    rows = sweep.crossJoin(F.broadcast(total))  # one row
    ap = F.sum(F.try_divide("pos", "_pos") * F.col("run_pos") / F.col("run_n"))
    # positives above plus half of the ties, for each negative
    roc = F.sum(F.col("neg") * (F.col("run_pos") - F.col("pos") / 2))
    return rows.agg(ap.alias("average_precision"), (roc / F.max(F.col("_pos").cast("double") * F.col("_neg"))).alias("auc_roc"))


def curve_points(sweep: DataFrame) -> DataFrame:
    """(threshold, precision, recall, false_positive_rate): a point of both curves for each score."""
    total = sweep.agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    rows = sweep.crossJoin(F.broadcast(total))  # one row
    return rows.select(F.col("score").alias("threshold"), (F.col("run_pos") / F.col("run_n")).alias("precision"), F.try_divide("run_pos", "_pos").alias("recall"), F.try_divide("run_neg", "_neg").alias("false_positive_rate"))


def business_cost(rows: DataFrame, alert: Column, label: str = "is_fraud", amount: str = "amount", unit: float = ALARM_COST) -> DataFrame:
    """One row: what missed fraud and false alarms cost, against catching nothing."""
    bad = F.col(label) == 1
    base = rows.agg(F.coalesce(F.sum(F.when(bad & ~alert, F.col(amount))), F.lit(0.0)).alias("missed"), F.count_if(~bad & alert).alias("false_positives"), F.count_if(bad & ~alert).alias("false_negatives"), F.coalesce(F.sum(F.when(bad, F.col(amount))), F.lit(0.0)).alias("baseline"))
    cost = F.col("missed") + unit * F.col("false_positives")
    return base.select(F.round(cost, 2).alias("business_cost"), F.round("missed", 2).alias("missed_fraud_cost"), F.round(unit * F.col("false_positives"), 2).alias("false_alarm_total_cost"), F.round("baseline", 2).alias("no_model_baseline_cost"), F.round(F.col("baseline") - cost, 2).alias("net_cost_savings"), F.coalesce(F.round(F.try_divide(F.col("baseline") - cost, "baseline"), 4), F.lit(0.0)).alias("savings_rate"), "false_positives", "false_negatives")


def class_report(rows: DataFrame, alert: Column, label: str = "is_fraud") -> DataFrame:
    """(label, precision, recall, f1, support) for both classes and their macro and weighted averages."""
    p = alert.cast("int")
    each = rows.select(F.col(label).alias("y"), p.alias("p")).groupBy("y", "p").count()
    classes = each.sparkSession.range(2).select(F.col("id").cast("int").alias("label"))
    pairs = classes.crossJoin(F.broadcast(each))  # four rows
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0))
    same, told = F.col("y") == F.col("label"), F.col("p") == F.col("label")
    per = pairs.groupBy("label").agg(n(same & told).alias("tp"), n(told).alias("predicted"), n(same).alias("support"))
    prec, rec = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    per = per.select(F.col("label").cast("string").alias("label"), prec.alias("precision"), rec.alias("recall"), F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0)).alias("f1"), "support")
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(c).alias(c) for c in names], F.sum("support").alias("support")).select(F.lit("macro avg").alias("label"), *names, "support")
    weighted = per.agg(*[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names], F.sum("support").alias("support")).select(F.lit("weighted avg").alias("label"), *names, "support")
    return per.unionByName(macro).unionByName(weighted)


def profile_types(rows: DataFrame) -> DataFrame:
    return rows.groupBy("txn_type").agg(F.count(F.lit(1)).alias("events"), F.sum(F.col("is_fraud").cast("long")).alias("frauds"), F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), F.avg("amount").alias("mean_amount"))


def profile_classes(rows: DataFrame) -> DataFrame:
    """(is_fraud, events, share, imbalance, min, max and mean amount): share of all rows, imbalance in rows of the largest class for each of this one."""
    one = rows.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("events"), F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"), F.avg("amount").alias("mean_amount"))
    total = one.agg(F.sum("events").alias("_all"), F.max("events").alias("_most"))
    done = one.crossJoin(F.broadcast(total))  # one row
    return done.select("is_fraud", "events", (F.col("events") / F.col("_all")).alias("share"), (F.col("_most") / F.col("events")).alias("imbalance"), "min_amount", "max_amount", "mean_amount")


def step_profile(rows: DataFrame) -> DataFrame:
    return rows.groupBy("step").count().orderBy("step")


def fraud_rows(rows: DataFrame, order: str = "seq") -> DataFrame:
    return rows.where("is_fraud = 1").orderBy(order)


def amount_histogram(rows: DataFrame, bins: int = 50) -> DataFrame:
    """(is_fraud, bin, n): equal widths between a class's least and largest amount; empty bins are listed."""
    ends = rows.groupBy("is_fraud").agg(F.min("amount").alias("low"), F.max("amount").alias("high"))
    at = F.when(F.col("high") > F.col("low"), F.least(F.floor((F.col("amount") - F.col("low")) / (F.col("high") - F.col("low")) * bins) + 1, F.lit(bins))).otherwise(1)
    counts = rows.join(F.broadcast(ends), "is_fraud").groupBy("is_fraud", at.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))  # two classes
    every = ends.select("is_fraud", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return every.join(counts, ["is_fraud", "bin"], "left").select("is_fraud", "bin", F.coalesce("n", F.lit(0)).alias("n"))


def correlations(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(row, column, value): Pearson correlations of all pairs of columns, in one pass over the rows."""
    vectors = VectorAssembler(inputCols=columns, outputCol="v", handleInvalid="skip").transform(rows).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    # a matrix of columns by columns
    return rows.sparkSession.createDataFrame([(a, b, float(matrix[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)], "row string, column string, value double")


def class_weights(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Adds weight, total / (2 * rows of the class). The rows of the classes are counted here, once, not with each pass over the result."""
    counts = rows.groupBy(F.col(label).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_t"))
    counts = settle(counts.crossJoin(F.broadcast(total)))  # two classes
    return rows.join(F.broadcast(counts), rows[label] == F.col("_l")).withColumn("weight", F.col("_t") / (2 * F.col("_n"))).drop("_l", "_n", "_t")


#: Rows of a training task, about: what a learner keeps of a part for its passes doesn't grow with the rows.
#: Each part also sends its own sums for all nodes of a pass, so smaller parts cost a forest more.
TRAIN_ROWS = 400_000
#: The share of the cores' time that a last, partly filled round of tasks may leave idle.
IDLE_SHARE = 1 / 12


def train_parts(rows: int, cores: int) -> int:
    """Parts of TRAIN_ROWS at most (fewer where there are idle cores) that keep all cores busy: a learner waits for the last part in each of its passes."""
    parts = max(cores, -(-rows // TRAIN_ROWS))
    whole = -(-parts // cores) * cores
    return whole if whole - parts > IDLE_SHARE * whole else parts


def dealt(train: DataFrame, key: str = "event_id", alike: tuple[str, ...] = ()) -> DataFrame:
    """Training rows without their key, held in train_parts(), in the key's order. The caller unpersists them.

    alike: columns that order a part's rows before the key. Rows that are alike then follow each other and mostly meet the
    same nodes of a tree, whose sums are still in the processor's cache.
    """
    parts = train_parts(train.count(), train.sparkSession.sparkContext.defaultParallelism)
    return train.repartition(parts, key).sortWithinPartitions(*alike, key).drop(key).persist()


_COLUMNS = {"featuresCol": "features", "labelCol": "is_fraud", "weightCol": "weight"}
#: The settings of the compared models. The boosted trees stop when VALIDATION rows no longer gain.
ESTIMATORS = {
    "logreg": lambda: LogisticRegression(**_COLUMNS, maxIter=1000),
    "rf": lambda: RandomForestClassifier(**_COLUMNS, numTrees=100, maxDepth=15, minInstancesPerNode=5, maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=10, seed=SEED),
    "gbt": lambda: GBTClassifier(**_COLUMNS, maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8, validationTol=0.001, checkpointInterval=10, seed=SEED),
}
#: The models by the work that they take, most first.
LONGEST_FIRST = ("rf", "gbt", "logreg")
#: Marks the rows that boosting measures its loss on.
VALIDATION = "is_validation"


def preparation(train: DataFrame, names: list[str]) -> PipelineModel:
    """The stages that make features of the columns `names`, scaled by the train rows' mean and population deviation."""
    assemble = VectorAssembler(inputCols=names, outputCol="raw", handleInvalid="keep")
    scale = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True).fit(assemble.transform(train))
    # the scaler divides by the sample's deviation
    n = train.count()
    factor = ElementwiseProduct(inputCol="scaled", outputCol="features", scalingVec=Vectors.dense([math.sqrt(n / (n - 1)) if n > 1 else 1.0] * len(names)))
    return PipelineModel([assemble, scale, factor])


def prepared(rows: DataFrame, before: PipelineModel) -> DataFrame:
    """Adds the features that the stages of preparation() make, by the same arithmetic in the plan itself: three functions over vectors of many columns take longer than most models."""
    assemble, scale, factor = before.stages[:3]
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan")))
    each = zip(assemble.getInputCols(), scale.mean.toArray().tolist(), scale.std.toArray().tolist(), factor.getScalingVec().toArray().tolist(), strict=True)
    return rows.withColumn("features", array_to_vector(F.array(*[(number(c) - F.lit(mean)) * F.lit(1 / std if std else 0.0) * F.lit(more) for c, mean, std, more in each])))


def fit(train: DataFrame, names: list[str], kind: str = "logreg", validation: DataFrame | None = None, before: PipelineModel | None = None, **params) -> PipelineModel:
    """train: numeric columns `names`, is_fraud and weight. params: settings of the estimator by name. before: the preparation() of the train rows, if models share it.

    Features are scaled by the train rows' mean and population deviation. With validation rows (of the same columns) boosted
    trees stop at the first tree that lessens their loss by less than validationTol in proportion, and keep the best number of trees.
    """
    last = ESTIMATORS[kind]()
    last = last.copy({last.getParam(k): v for k, v in params.items()})
    before = before or preparation(train, names)
    rows = train
    if kind == "gbt" and validation is not None:
        shared_dir(train.sparkSession)
        rows = train.withColumn(VALIDATION, F.lit(False)).unionByName(validation.select(*train.columns).withColumn(VALIDATION, F.lit(True)))
        last = last.setValidationIndicatorCol(VALIDATION)
    return PipelineModel([*before.stages, last.fit(prepared(rows, before))])


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with score, the unrounded probability of fraud."""
    done = model.stages[-1].transform(prepared(rows, model)).withColumn("score", vector_to_array("probability")[1])
    return done.drop("features", "rawPrediction", "probability", "prediction")


def evaluate(rows: DataFrame, threshold: float) -> DataFrame:
    """One row: confusion counts, rates, areas and costs at a threshold."""
    alert, bad = F.col("score") >= threshold, F.col("is_fraud") == 1
    counts = rows.agg(F.count_if(alert & bad).alias("tp"), F.count_if(alert & ~bad).alias("fp"), F.count_if(~alert & ~bad).alias("tn"), F.count_if(~alert & bad).alias("fn"))
    p, r = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)), F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    counts = counts.select("*", F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"), F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 4).alias("f1_score"))
    return counts.crossJoin(F.broadcast(average_precision(by_score(rows)))).crossJoin(F.broadcast(business_cost(rows, alert)))  # one row each


def train_and_tune(train: DataFrame, validation: DataFrame, test: DataFrame, names: list[str], kind: str = "logreg", before: PipelineModel | None = None, **params) -> tuple[PipelineModel, DataFrame]:
    """Fits on train, takes the threshold of least cost on validation, measures on test.

    Train rows may have their weights already, and before is their preparation(), if models share them.
    The three are tables that are cheap to read, since each is read several times (see durable.keep()).
    The record is one row: model, threshold, evaluated_thresholds, validation_cost, validation_auc_pr, and evaluate() of the test rows.
    """
    weighted = (train if "weight" in train.columns else class_weights(train)).select(*names, "is_fraud", "weight")
    watched = class_weights(validation).select(*names, "is_fraud", "weight") if kind == "gbt" else None
    model = fit(weighted, names, kind, watched, before=before, **params)
    # both in one pass, for which the model is sent once; four columns of each scored row, read several times
    read = list(dict.fromkeys([*names, "is_fraud", "amount"]))
    both = validation.select(*read, F.lit(False).alias("_test")).unionByName(test.select(*read, F.lit(True).alias("_test")))
    scores = settle(predict(model, both).select("score", "is_fraud", "amount", "_test"))
    validation, test = scores.where(~F.col("_test")), scores.where("_test")
    sweep = by_score(validation)
    best = cheapest_threshold(sweep).first()
    limit = best.threshold if best.threshold is not None else 1.000001
    area = average_precision(sweep).select(F.col("average_precision").alias("validation_auc_pr"))
    head = area.select(F.lit(kind).alias("model"), F.lit(limit).alias("threshold"), F.lit(best.evaluated_thresholds).alias("evaluated_thresholds"), F.lit(best.cost).alias("validation_cost"), "validation_auc_pr")
    return model, head.crossJoin(F.broadcast(evaluate(test, limit)))  # one row each


def select_model(records: DataFrame) -> DataFrame:
    """The record of least validation cost, on a tie the one of larger precision-recall area."""
    return records.orderBy("validation_cost", F.desc("validation_auc_pr"), "model").limit(1)


def save_model(model: PipelineModel, path: str, names: list[str], threshold: float | None) -> None:
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(names), threshold)], "features string, threshold double").write.mode("overwrite").json(f"{path}/metadata")


def publish_model(model: PipelineModel, root: str, names: list[str], threshold: float | None) -> str:
    """Saves a model as the next version under root and returns its name. A version counts once its metadata is there, which is written last."""
    spark = SparkSession.active()
    version = f"v{max((int(n[1:]) for n in folder_names(spark, root) if n[1:].isdigit()), default=0) + 1}"
    save_model(model, f"{root}/{version}", names, threshold)
    return version


def latest_version(spark: SparkSession, root: str) -> str | None:
    """The newest finished version under root."""
    found = sorted((int(n[1:]) for n in folder_names(spark, root) if n[1:].isdigit()), reverse=True)
    return next((f"v{n}" for n in found if exists(spark, f"{root}/v{n}/metadata/_SUCCESS")), None)


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], float | None]:
    row = spark.read.schema("features string, threshold double").json(f"{path}/metadata").first()
    return PipelineModel.load(f"{path}/model"), json.loads(row.features), row.threshold


def top_importances(spark: SparkSession, model: PipelineModel, names: list[str], n: int = 25) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(a, float(v)) for a, v in zip(names, values, strict=True)], "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(n)


def oversample(rows: DataFrame, names: list[str], label: str = "is_fraud", key: str = "event_id", ratio: float = 0.1, k: int = 5, seed: int = SEED) -> DataFrame:
    """rows of `names` and label, with interpolated minority rows up to ratio x majority.

    Each new row lies on the line from a minority row to one of its k nearest others, by the distance of scaled
    columns (see neighbours.py). Nothing is added where the ratio holds or there are less than two rows.
    """
    base = rows.select(key, label, *[F.col(c).cast("double").alias(c) for c in names])
    counts = {r[0]: r[1] for r in base.groupBy(label).count().collect()}  # two classes
    few, many = counts.get(1, 0), counts.get(0, 0)
    need = int(many * ratio) - few
    plain = base.select(label, *names)
    if few < 2 or need <= 0:
        return plain
    minority = VectorAssembler(inputCols=names, outputCol="_v").transform(base.where(F.col(label) == 1))
    scaled = StandardScaler(inputCol="_v", outputCol="_s", withMean=True, withStd=True).fit(minority).transform(minority)
    scaled = settle(scaled.select(F.col(key).alias("a"), vector_to_array("_s").alias("s"), F.array(*names).alias("x")))
    pairs = nearest(scaled.select("a", "s"), k)
    there, here = scaled.select(F.col("a").alias("b"), F.col("x").alias("y")), scaled.select("a", "x")
    near = pairs.join(there, "b").groupBy("a").agg(F.sort_array(F.collect_list(F.struct("r", "y"))).alias("near"))  # k neighbours at most
    made = settle(here.join(near, "a"))
    per = -(-need // max(1, made.count()))
    made = made.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(per - 1))))
    pick = F.pmod(F.xxhash64(F.lit(seed), "a", "i"), F.size("near")).cast("int")
    step = F.pmod(F.xxhash64(F.lit(seed + 1), "a", "i"), F.lit(1 << 20)) / float(1 << 20)
    made = made.select(F.struct("a", "i").alias("id"), F.lit(1).alias(label), F.shiftrightunsigned(F.xxhash64(F.lit(seed + 2), "a", "i"), 64 - DRAW_BITS).alias("place"), F.zip_with("x", F.get("near", pick)["y"], lambda p, q: p + step * (q - p)).alias("n"))
    new = ranked(made, "place", "id", label).where(F.col("_rank") < need)
    return plain.unionByName(new.select(label, *[F.col("n")[j].alias(c) for j, c in enumerate(names)]))
