"""Gradient-boosted tree classifier: fit, score, importances, save/load.

The trees are a Spark ML model, grown from histograms (``operators.boosting``)
with Spark ML's loss and split candidates.

The model never leaves Spark. Categorical values become ordinal codes held in
a table (column, value, code) that is joined by value, so the number of
distinct values is not bounded by the driver, and the codes enter the trees
as numbers: the number of bins does not grow with them. An unseen value is
-1, a null is the value ``"missing"``. Scoring runs on executors; the
probability of class 1 is read with ``vector_to_array`` (JVM side, no Python).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch import schemas as S
from leakwatch.operators.cumulative import running_totals

if TYPE_CHECKING:
    from leakwatch.operators.boosting import Boosting

MISSING = "missing"
UNSEEN = -1
MAX_BROADCAST_CODES = 100_000


@dataclass(frozen=True)
class BoostParams:
    """Boosting settings; defaults follow the original job (100 trees,
    depth 3, learning rate 0.1, seed 42)."""

    max_iter: int = 100
    max_depth: int = 3
    step_size: float = 0.1
    seed: int = 42
    max_bins: int = 32


def index_suffix(col: str) -> str:
    return f"{col}_code"


def _text(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(MISSING))


@dataclass
class Encoder:
    """Codes of the values of ``columns``: 0, 1, ... in order of the value."""

    columns: list[str]
    table: DataFrame
    small: bool = field(init=False)
    kind = "categorical"

    def __post_init__(self):
        self.small = self.table.limit(MAX_BROADCAST_CODES + 1).count() <= MAX_BROADCAST_CODES

    def encode(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<column>_code`` for each column; unseen values get -1."""
        out = df
        for c in self.columns:
            codes = self.table.where(F.col("column") == c).select(F.col("value").alias("_en_v"), F.col("code").alias(index_suffix(c)))
            out = out.drop(index_suffix(c)).withColumn("_en_k", _text(c))
            out = out.join(F.broadcast(codes) if self.small else codes, F.col("_en_k") == F.col("_en_v"), "left").drop("_en_k", "_en_v")
            out = out.withColumn(index_suffix(c), F.coalesce(F.col(index_suffix(c)), F.lit(UNSEEN)).cast("int"))
        return out


def fit_encoder(df: DataFrame, categorical: list[str] = S.CATEGORICAL_COLS) -> Encoder:
    """Alphabetical codes per categorical column, counted by running totals
    over the distinct values."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in categorical])
    values = df.select(F.inline(pairs)).distinct().withColumn("one", F.lit(1).cast("long"))
    ranked = running_totals(values, ["column"], "value", ["one"], descending=False)
    table = ranked.select("column", "value", (F.col("cum_one") - 1).cast("int").alias("code")).checkpoint(eager=True)
    return Encoder(list(categorical), table)


def encode(df: DataFrame, encoder: Encoder) -> DataFrame:
    return encoder.encode(df)


@dataclass
class RiskModel:
    """Codes, input columns and boosted trees."""

    encoder: Encoder
    numeric: list[str]
    booster: GBTClassificationModel

    @property
    def inputs(self) -> list[str]:
        return model_inputs(self.encoder, self.numeric)

    def encode(self, df: DataFrame) -> DataFrame:
        return self.encoder.encode(df)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.booster.transform(assemble(self.encode(df), self.inputs))


def assemble(encoded: DataFrame, inputs: list[str]) -> DataFrame:
    """``features``: the inputs as one vector of numbers."""
    return VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep").transform(encoded)


def fit_classifier(
    train: DataFrame,
    params: BoostParams = BoostParams(),
    categorical: list[str] = S.CATEGORICAL_COLS,
    numeric: list[str] = S.NUMERIC_COLS,
    label: str = S.LABEL,
    encoder: Encoder | None = None,
    encoded: DataFrame | None = None,
    grown: Boosting | None = None,
) -> RiskModel:
    """Fit the codes (unless given) and the boosted trees on all of ``train``.

    ``encoded`` replaces ``train`` with codes of its own for the fit (ordered
    target statistics differ from the codes of rows to score). ``grown``
    (``start_fit`` on the same rows) is grown on to ``params.max_iter`` trees
    instead of starting over.
    """
    encoder = encoder or fit_encoder(train, categorical)
    fit = grown or start_fit(encoder.encode(train) if encoded is None else encoded, model_inputs(encoder, numeric), params, label)
    fit.grow(params.max_iter - len(fit.trees))
    return RiskModel(encoder, list(numeric), fit.booster(params.max_iter))


def model_inputs(encoder: Encoder, numeric: list[str]) -> list[str]:
    return [index_suffix(c) for c in encoder.columns] + list(numeric)


def start_fit(encoded: DataFrame, inputs: list[str], params: BoostParams = BoostParams(), label: str = S.LABEL) -> Boosting:
    """A fit without trees, its bins placed where Spark ML's trees may split."""
    from leakwatch.operators.boosting import Boosting, split_bounds

    known = F.coalesce(F.col(label).isin(0, 1), F.lit(False))
    n, bad = encoded.agg(F.count(F.lit(1)), F.count_if(~known)).first()
    if not n or bad:
        raise ValueError(f"training needs rows with labels 0 and 1; of {n} rows {bad} have another or none")
    return Boosting(encoded.withColumn("fits", F.lit(True)), inputs, label, params, split_bounds(encoded, inputs, params.max_bins))


def booster(model: RiskModel) -> GBTClassificationModel:
    return model.booster


def feature_names(model: RiskModel) -> list[str]:
    return model.inputs


def first_trees(model: RiskModel, k: int) -> RiskModel:
    """The model of the first ``k`` trees of the same fit."""
    sc = SparkContext._active_spark_context
    old = model.booster._java_obj
    trees = sc._gateway.new_array(sc._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, k)
    weights = sc._gateway.new_array(sc._jvm.double, k)
    for i in range(k):
        trees[i] = old.trees()[i]
        weights[i] = float(model.booster.treeWeights[i])
    new = sc._jvm.org.apache.spark.ml.classification.GBTClassificationModel(old.uid(), trees, weights, old.numFeatures(), old.numClasses())
    return RiskModel(model.encoder, model.numeric, GBTClassificationModel(new))


def predict(model: RiskModel, df: DataFrame, threshold: float = 0.5, digits: int = 4) -> DataFrame:
    """Add ``predicted`` (int), ``raw_prob`` (class-1 probability, for
    metrics) and ``predicted_prob`` (the same rounded half-even to ``digits``,
    for tables)."""
    scored = model.transform(df)
    p1 = vector_to_array(F.col("probability")).getItem(1)
    internal = [index_suffix(c) for c in model.encoder.columns] + ["features", "rawPrediction", "probability", "prediction"]
    return scored.withColumns(
        {
            "predicted": F.when(p1 > threshold, 1).otherwise(0).cast("int"),
            "raw_prob": p1,
            "predicted_prob": F.bround(p1, digits),
        }
    ).drop(*internal)


def feature_importance(model: RiskModel, names: list[str] | None = None) -> list[tuple[str, float]]:
    """(feature, importance) sorted by importance, normalised to sum to 1.

    The importance vector has one entry per model input (bounded by the
    feature count), so it is read on the driver.
    """
    names = names or [n.removesuffix("_code") for n in feature_names(model)]
    imp = booster(model).featureImportances.toArray()
    pairs = [(n, float(v)) for n, v in zip(names, imp)]
    return sorted(pairs, key=lambda p: (-p[1], p[0]))


def save_model(model: RiskModel, path: str) -> None:
    """Folders ``codes`` (Parquet), ``inputs`` and ``trees`` under ``path``."""
    spark = model.encoder.table.sparkSession
    model.encoder.table.write.mode("overwrite").parquet(f"{path}/codes")
    lists = [(model.encoder.kind, model.encoder.columns), ("numeric", model.numeric)]
    if model.encoder.kind == "statistic":
        lists.append(("prior", [repr(model.encoder.prior)]))
    inputs = [(i, kind, c) for kind, cs in lists for i, c in enumerate(cs)]
    spark.createDataFrame(inputs, "place int, kind string, name string").write.mode("overwrite").parquet(f"{path}/inputs")
    model.booster.write().overwrite().save(f"{path}/trees")


def load_model(path: str) -> RiskModel:
    spark = SparkSession.getActiveSession()
    inputs = sorted((r.kind, r.place, r.name) for r in spark.read.parquet(f"{path}/inputs").collect())
    names = lambda kind: [n for k, _, n in inputs if k == kind]
    codes = spark.read.parquet(f"{path}/codes")
    if names("statistic"):
        from leakwatch.operators.target_statistics import TargetEncoder

        encoder = TargetEncoder(names("statistic"), codes, float(names("prior")[0]))
    else:
        encoder = Encoder(names("categorical"), codes)
    return RiskModel(encoder, names("numeric"), GBTClassificationModel.load(f"{path}/trees"))
