"""Delay and price models (M1-M10): MLlib pipelines of StringIndexer,
VectorAssembler and GBTRegressor, a repeatable split, and metrics.

The trees are grown by :mod:`storelake.operators.boosting` (one Spark job per
tree level over packed rows); the fitted model is MLlib's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.config import GBT_MAX_DEPTH, GBT_MAX_ITER, SPLIT_SEED, SPLIT_WEIGHTS
from storelake.functions.numeric import ratio
from storelake.operators import boosting
from storelake.session import checkpoint_root


@dataclass(frozen=True)
class ModelSpec:
    label: str
    numeric: tuple
    categorical: tuple
    required: tuple


# Feature lists and the null checks of the two models.
DELAY = ModelSpec(
    label="delay_vs_estimate_days",
    numeric=("estimated_delivery_days", "purchase_month", "purchase_day", "purchase_weekday",
             "purchase_hour", "is_weekend_order", "product_weight_g", "product_length_cm",
             "product_width_cm", "product_height_cm", "product_volume", "product_photos_qty",
             "is_same_state", "price_per_item", "freight_per_item", "total_items_in_order",
             "max_installments", "total_payment", "total_order_value", "freight_price_ratio",
             "weight_per_item"),
    categorical=("customer_state", "seller_state"),
    required=("delay_vs_estimate_days", "estimated_delivery_days", "product_weight_g",
              "product_volume", "price_per_item", "freight_per_item", "total_order_value"),
)
PRICE = ModelSpec(
    label="price",
    numeric=("freight_value", "freight_ratio", "delivery_days", "estimated_vs_actual_delivery",
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
             "order_hour", "order_dayofweek"),
    categorical=("customer_state",),
    required=("price", "freight_value", "delivery_days", "product_weight_g",
              "product_length_cm", "product_width_cm", "product_height_cm"),
)


def features(spec: ModelSpec) -> list[str]:
    return list(spec.numeric) + [c + "_idx" for c in spec.categorical]


def model_input(df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Rows with the model's required columns present."""
    return df.na.drop(subset=list(spec.required))


def spread(df: DataFrame, key: str = "order_id") -> DataFrame:
    """``df`` over at least as many partitions as the cluster has cores. Trees are grown in hundreds of short passes over the
    rows; a small table comes out of its joins in a few partitions, and each pass would use as few cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, F.col(key)) if key in df.columns and df.rdd.getNumPartitions() < cores else df


def _split_column(key: str, seed: int) -> str:
    return f"_split_{key}_{seed}"


def _split_number(key: str, seed: int) -> Column:
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long") % 1000


def with_split_number(df: DataFrame, key: str, seed: int = SPLIT_SEED) -> DataFrame:
    """``df`` with the number by which :func:`split` divides it, for a table that is read several times."""
    return df.withColumn(_split_column(key, seed), _split_number(key, seed))


def split(df: DataFrame, key: str | None = None, weights=SPLIT_WEIGHTS,
          seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """Train/test split (M7).

    With ``key`` the split is by an MD5 of key and seed: repeatable under any
    partitioning and in any engine, and all rows of a key are on one side. Without
    it, ``randomSplit`` as in the reproduced job (depends on partitioning).
    """
    if key is None:
        train, test = df.randomSplit(list(weights), seed=seed)
        return train, test
    cut = int(round(weights[0] / sum(weights) * 1000))
    kept = _split_column(key, seed)
    bucket = F.col(kept) if kept in df.columns else _split_number(key, seed)
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def pipeline(spec: ModelSpec, max_iter: int = GBT_MAX_ITER, max_depth: int = GBT_MAX_DEPTH,
             seed: int = SPLIT_SEED, max_bins: int = 32) -> Pipeline:
    """StringIndexer(keep) per categorical column -> VectorAssembler(skip) -> GBT (M1, M5, M6)."""
    idx = [StringIndexer(inputCol=c, outputCol=c + "_idx", handleInvalid="keep")
           for c in spec.categorical]
    asm = VectorAssembler(inputCols=features(spec), outputCol="features", handleInvalid="skip")
    gbt = GBTRegressor(labelCol=spec.label, featuresCol="features", maxIter=max_iter,
                       maxDepth=max_depth, seed=seed, maxBins=max_bins, checkpointInterval=10)
    return Pipeline(stages=idx + [asm, gbt])


def fit(train: DataFrame, spec: ModelSpec, **kw) -> PipelineModel:
    """The fitted :func:`pipeline`; its last stage is fitted over packed rows instead of by MLlib's row objects."""
    checkpoint_root(train.sparkSession)
    *before, gbt = pipeline(spec, **kw).getStages()
    ready = Pipeline(stages=before).fit(train)
    return PipelineModel([*ready.stages, boosting.fit(gbt, ready.transform(train), features(spec))])


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """MAE, RMSE and R² in one pass (M8)."""
    e = F.col(prediction) - F.col(label)
    return pred.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.sum(e * e) / (F.count(label) * F.var_pop(label))).alias("r2"),
        F.count(F.lit(1)).alias("test_rows"))


def delay_predictions(pred: DataFrame) -> DataFrame:
    """Shipment delay output (M9)."""
    return pred.select("delay_vs_estimate_days", "prediction", "customer_state", "seller_state",
                       "total_order_value", "estimated_delivery_days")


def pricing_recommendations(pred: DataFrame) -> DataFrame:
    """Price output with the adjustment factor prediction / price."""
    return pred.select("product_id", "price", F.col("prediction").alias("predicted_price"),
                       ratio("prediction", "price", 4).alias("adjustment_factor"),
                       "customer_state", "delivery_days")


def save_model(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
