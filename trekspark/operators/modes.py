"""Transport modes: labels by speed, the trip data set, splits, the classifier, its metrics and calibration."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import mode_of_speed, speed_kmh
from ..sources.schema import pick
from .features import accel_by_trip, dwell_ratio, matched_by_trip, stop_density_by_trip
from .ranks import running_sums

# Names of the features.
CORE = ["avg_speed_kmh", "distance_km", "duration_min", "start_hour", "day_of_week"]
EXTENDED = ["dwell_ratio", "accel_std", "accel_iqr", "mean_stop_density", "lateral_offset_mean_m", "lateral_offset_max_m", "matched_confidence_mean", "matched_confidence_max", "curvature_heading_change_per_km"]
LABEL = "mode_heuristic"


def trip_speed(trips: DataFrame) -> Column:
    have = [F.col(c) for c in ("avg_speed_kmh", "speed_kmh") if c in trips.columns][:1]
    parts = have + ([speed_kmh(F.col("distance_m"), F.col("duration_s"))] if {"distance_m", "duration_s"} <= set(trips.columns) else [])
    return F.coalesce(*parts) if parts else F.lit(None).cast("double")


def label_modes(trips: DataFrame, missing: str | None = "") -> DataFrame:
    """trips with mode_heuristic by mean speed, `missing` where there's none."""
    return trips.withColumn(LABEL, mode_of_speed(trip_speed(trips), missing))


def rule_prediction(trips: DataFrame) -> DataFrame:
    return trips.withColumn("prediction", mode_of_speed(trip_speed(trips), "unknown"))


def core_features(trips: DataFrame) -> DataFrame:
    """The five core features, from whichever units the table has."""
    first = lambda names, default=None: next((F.col(c) * k for c, k in names if c in trips.columns), F.lit(default).cast("double"))
    km = first([("distance_km", 1.0), ("trip_distance_km", 1.0), ("distance_m", 0.001)])
    minutes = first([("duration_min", 1.0), ("duration_minutes", 1.0), ("duration_s", 1 / 60.0), ("duration_h", 60.0)])
    start = pick(trips, "start_time") or pick(trips, "timestamp")
    ts = F.col(start).cast("timestamp") if start else F.lit(None).cast("timestamp")
    return trips.withColumns({"avg_speed_kmh": trip_speed(trips), "distance_km": km, "duration_min": minutes, "start_hour": F.hour(ts).cast("double"), "day_of_week": F.weekday(ts).cast("double")})


def trip_dataset(trips: DataFrame, points: DataFrame | None = None, stays: DataFrame | None = None, matched: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """trip_id, start_time, the features and the label of trips with a label that isn't empty.

    Labels join on trip_id and never by position. Extended features are there for the tables that are given.
    """
    df = trips.join(labels.select("trip_id", LABEL), "trip_id", "left") if labels is not None else label_modes(trips, None)
    df = core_features(df)
    if stays is not None:
        df = dwell_ratio(df, stays)
    if points is not None:
        df = df.join(stop_density_by_trip(points, trips), "trip_id", "left").join(accel_by_trip(points), "trip_id", "left")
    if matched is not None:
        df = df.join(matched_by_trip(matched), "trip_id", "left")
    extra = [c for c in EXTENDED if c in df.columns]
    return df.filter(F.col(LABEL).isNotNull() & (F.col(LABEL) != "")).select("trip_id", "start_time", *CORE, *extra, LABEL)


def split_by_time(df: DataFrame, test: float = 0.2, val: float = 0.2) -> DataFrame:
    """df with `split`: the earliest trips train, then validation, then test; cut at exact shares of start_time and trip_id order.

    Ranks are running sums over ranges of time, so no task holds all rows.
    """
    ranked = running_sums(df.withColumn("_all", F.lit(1)), ["_all"], ["start_time", "trip_id"], {"_rank": F.lit(1)})
    total = F.lit(df.count())
    cut = lambda share: F.floor(total * share)
    where = F.when(F.col("_rank") <= total - cut(test) - cut(val), "train").when(F.col("_rank") <= total - cut(test), "val").otherwise("test")
    return ranked.withColumn("split", where).drop("_all", "_rank")


def split_stratified(df: DataFrame, test: float = 0.2, val: float = 0.2, seed: int = 42) -> DataFrame:
    """df with `split`: each label's rows in the order of a hash with the seed, the same shares of every label."""
    sizes = df.groupBy(LABEL).agg(F.count(F.lit(1)).alias("_size"))  # a row per label
    hashed = df.withColumn("_hash", F.md5(F.concat("trip_id", F.lit(f"-{seed}"))))
    ranked = running_sums(hashed, [LABEL], ["_hash", "trip_id"], {"_rank": F.lit(1)}).join(F.broadcast(sizes), LABEL)
    cut = lambda share: F.ceil(F.col("_size") * share)
    where = F.when(F.col("_rank") <= cut(test), "test").when(F.col("_rank") <= cut(test) + cut(val), "val").otherwise("train")
    return ranked.withColumn("split", where).select(*df.columns, "split")


def train_classifier(train: DataFrame, features: list[str] | None = None, reg: float = 0.01) -> tuple[PipelineModel, list[str]]:
    """A logistic regression on standardised features, nulls by the training median; columns that are null throughout are left out."""
    names = features or [c for c in CORE + EXTENDED if c in train.columns]
    counts = train.agg(*[F.count(c).alias(c) for c in names]).first()
    used = [c for c in names if counts[c]]
    filled = [f"{c}_f" for c in used]
    cast = train.withColumns({c: F.col(c).cast("double") for c in used})
    stages = [StringIndexer(inputCol=LABEL, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="keep"), Imputer(strategy="median", inputCols=used, outputCols=filled), VectorAssembler(inputCols=filled, outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True), LogisticRegression(featuresCol="_x", labelCol="_label", predictionCol="_pred", probabilityCol="_prob", maxIter=1000, regParam=reg)]
    return Pipeline(stages=stages).fit(cast), used


def importance(model: PipelineModel, used: list[str]) -> dict[str, float]:
    """Mean absolute coefficient of each feature over the classes."""
    matrix = model.stages[-1].coefficientMatrix.toArray()
    return {c: float(abs(matrix[:, i]).mean()) for i, c in enumerate(used)}


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """df with prediction (a label) and confidence."""
    labels = model.stages[0].labels
    names = F.array(*[F.lit(v) for v in labels])
    out = model.transform(df.withColumns({c: F.col(c).cast("double") for c in df.columns if c in CORE + EXTENDED}))
    return out.withColumns({"prediction": F.get(names, F.col("_pred").cast("int")), "confidence": F.array_max(vector_to_array("_prob"))}).select(*df.columns, "prediction", "confidence")


def confusion(predicted: DataFrame, label: str = LABEL) -> DataFrame:
    return predicted.groupBy(F.col(label).alias("label"), "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support of a confusion table."""
    rows = matrix.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    called = matrix.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("called"))
    both = rows.join(called, "label", "full").na.fill(0)
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    both = both.withColumns({"precision": ratio(F.col("hits"), F.col("called")), "recall": ratio(F.col("hits"), F.col("support"))})
    return both.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).select("label", "precision", "recall", "f1", "support")


def summary_metrics(matrix: DataFrame) -> DataFrame:
    """One row: accuracy, f1_macro, n."""
    total = matrix.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"), F.sum("n").alias("n"))
    return total.crossJoin(class_metrics(matrix).agg(F.avg("f1").alias("f1_macro"))).select("accuracy", "f1_macro", "n")


def calibration(predicted: DataFrame, label: str = LABEL, bins: int = 10) -> DataFrame:
    """bin, n, mean_confidence, accuracy of bins [lo, hi) of the confidence; a confidence of 1 is in none."""
    number = F.floor(F.col("confidence") * bins).cast("int")
    return predicted.filter((F.col("confidence") >= 0) & (F.col("confidence") < 1)).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"))


def calibration_error(bins: DataFrame) -> DataFrame:
    """ece: mean gap of accuracy and confidence, weighted by the bins' rows."""
    return bins.agg((F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("mean_confidence"))) / F.sum("n")).alias("ece"))


def reliability(scores: DataFrame, bins: int = 10) -> DataFrame:
    """bin, n, mean_probability, positive_share from y_prob and y_true."""
    number = F.least(F.floor(F.col("y_prob") * bins), F.lit(bins - 1)).cast("int")
    return scores.groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("y_prob").alias("mean_probability"), F.avg(F.col("y_true").cast("double")).alias("positive_share"))


def evaluation(predicted: DataFrame, label: str = LABEL) -> DataFrame:
    """metric, value of a table of labels, predictions and confidences: accuracy, f1_macro, ece, n."""
    row = summary_metrics(confusion(predicted, label)).crossJoin(calibration_error(calibration(predicted, label)))  # one row each
    return row.select(*[F.col(c).cast("double").alias(c) for c in ("accuracy", "f1_macro", "ece", "n")]).unpivot([], ["accuracy", "f1_macro", "ece", "n"], "metric", "value")


def evaluation_deltas(evaluated: DataFrame, baseline: DataFrame) -> DataFrame:
    """metric, value, baseline, delta (value less baseline) of two tables of evaluation()."""
    both = evaluated.join(baseline.select("metric", F.col("value").alias("baseline")), "metric", "left")
    return both.withColumn("delta", F.col("value") - F.col("baseline"))


def evaluate(model: PipelineModel, used: list[str], test: DataFrame) -> dict:
    """Accuracy, macro F1, per-class report, confusion, importance, calibration and ECE of the model, and the speed rule's accuracy beside them."""
    done = predict(model, test).cache()
    matrix = confusion(done).cache()
    rows = lambda df: [r.asDict() for r in df.collect()]  # noqa: E731  a few rows per class or bin
    values = {r["metric"]: r["value"] for r in evaluation(done).collect()}
    report = {k: values[k] for k in ("accuracy", "f1_macro", "n")} | {"classes": rows(class_metrics(matrix)), "confusion": rows(matrix), "importance": importance(model, used)}
    report |= {"calibration": {"bins": rows(calibration(done)), "ece": values["ece"]}, "rule": rows(summary_metrics(confusion(rule_prediction(test))))[0]}
    matrix.unpersist()
    done.unpersist()
    return report


def compare_reports(report: dict, baseline: dict | None) -> dict:
    """Metrics of a report and their differences from a baseline's."""
    names = ("accuracy", "f1_macro")
    out = {n: report.get(n) for n in names} | {"ece": report.get("calibration", {}).get("ece")}
    if baseline:
        base = {n: baseline.get(n) for n in names} | {"ece": baseline.get("calibration", {}).get("ece")}
        out |= {f"delta_{n}": out[n] - base[n] for n in out if out[n] is not None and base.get(n) is not None}
    return out
