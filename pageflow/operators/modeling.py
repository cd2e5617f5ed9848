"""Churn classifiers with Spark ML: preparation, boosted trees, search, evaluation, importance."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from pageflow.functions import expressions as E
from pageflow.functions.fixed_values import (
    ENTITY_KEYS,
    IMPORTANCE_REPEATS,
    SEARCH_DRAWS,
    SEARCH_FOLDS,
    SEARCH_SPACE,
    SEED,
)
from pageflow.functions.hashing import row_hash
from pageflow.operators.encoding import cross_fitted_rates
from pageflow.operators.metrics import classification_report, ranking_metrics

LABEL = "churn"
# Columns with a level for almost every entity. They are hashed at every size of the data.
HASHED_COLUMNS = ("page_title",)
# Spark's trees keep a number per feature and row in memory, zeros too, so this width is a cost per row.
HASHED_FEATURES = 256
# Rows that a task puts in order when values are permuted.
PIECE_ROWS = 100_000


def column_roles(df: DataFrame, label: str = LABEL) -> tuple[list[str], list[str]]:
    """Names of the categorical (text, boolean) and the numeric columns other than the label."""
    fields = [f for f in df.schema.fields if f.name != label]
    categorical = [f.name for f in fields if isinstance(f.dataType, (StringType, BooleanType))]
    numeric = [f.name for f in fields if isinstance(f.dataType, NumericType)]
    return categorical, numeric


def model_input(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Types Spark ML expects: texts for categories, doubles without NULLs for numbers."""
    categorical, numeric = column_roles(df, label)
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in categorical],
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric],
        *([F.col(label).cast("int").alias(label)] if label in df.columns else []),
    )


def build_preprocessor(
    categorical: Sequence[str],
    numeric: Sequence[str],
    hashed: Sequence[str] = (),
    hashed_features: int = HASHED_FEATURES,
) -> list:
    """Stages that turn categories into one-hot vectors and numbers into standard scores.

    An unknown level becomes the zero vector. Columns in ``hashed`` (page titles, say) go into a
    hashed vector of fixed width instead: a one-hot index keeps every level on the driver.
    """
    indexed = [c for c in categorical if c not in hashed]
    stages, parts = [], []
    if indexed:
        indices, vectors = [f"{c}_index" for c in indexed], [f"{c}_onehot" for c in indexed]
        stages += [
            StringIndexer(inputCols=indexed, outputCols=indices, handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indices, outputCols=vectors, dropLast=True),
        ]
        parts += vectors
    if hashed:
        stages.append(FeatureHasher(numFeatures=hashed_features, inputCols=list(hashed), outputCol="hashed_levels"))
        parts.append("hashed_levels")
    if numeric:
        stages += [
            VectorAssembler(inputCols=list(numeric), outputCol="numbers"),
            StandardScaler(withMean=True, withStd=True, inputCol="numbers", outputCol="scaled_numbers"),
        ]
        parts.append("scaled_numbers")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def build_pipeline(preprocessor: Sequence, label: str = LABEL, seed: int = SEED, **tree_params) -> Pipeline:
    """Preparation followed by boosted trees."""
    trees = GBTClassifier(featuresCol="features", labelCol=label, seed=seed, **tree_params)
    return Pipeline(stages=[*preprocessor, trees])


def pipeline_for(
    df: DataFrame, label: str = LABEL, hashed: Sequence[str] = HASHED_COLUMNS, **tree_params
) -> Pipeline:
    """Pipeline with roles of columns read off the schema; its stages do not depend on the rows.

    A category that has its rate next to it (``with_rates``) is left to the rate; of the others, those in ``hashed`` are hashed.
    """
    categorical, numeric = column_roles(df, label)
    categorical = [c for c in categorical if f"{c}_rate" not in df.columns]
    hashed = [c for c in hashed if c in categorical]
    return build_pipeline(build_preprocessor(categorical, numeric, hashed), label, **tree_params)


def with_rates(
    train: DataFrame,
    *others: DataFrame,
    columns: Sequence[str] = HASHED_COLUMNS,
    label: str = LABEL,
    key_cols: Sequence[str] = ENTITY_KEYS,
) -> list[DataFrame]:
    """The sets with a number ``<column>_rate`` for columns with very many levels: mean labels, out of fold in ``train``."""
    sets = [train, *others]
    for column in columns:
        sets = cross_fitted_rates(sets[0], column, label, key_cols, sets[1:])
    return sets


def draw_params(space: Mapping[str, Sequence] = SEARCH_SPACE, draws: int = SEARCH_DRAWS, seed: int = SEED) -> list[dict]:
    """Distinct seeded draws from the product of the space."""
    combinations = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(combinations, min(draws, len(combinations)))


def tree_settings(params: Mapping) -> dict:
    """Names of the search space in terms of Spark's trees (which have no L2 penalty and need a depth)."""
    depth = params.get("max_depth", 5)
    if depth is None:
        raise ValueError("Spark's trees need a depth")
    return {
        "maxDepth": depth,
        "stepSize": params.get("learning_rate", 0.1),
        "maxIter": params.get("max_iter", 100),
        "minInstancesPerNode": params.get("min_samples_leaf", 20),
    }


def hyperparameter_search(
    pipeline: Pipeline,
    train: DataFrame,
    key_cols: Sequence[str] = ENTITY_KEYS,
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    seed: int = SEED,
    parallelism: int = 2,
):
    """Random search by cross-validated ROC-AUC; the result's ``bestModel`` is the refitted winner.

    Folds come from row hashes, so they do not change with the partitioning.
    """
    trees = pipeline.getStages()[-1]
    grid = [
        {getattr(trees, name): value for name, value in tree_settings(p).items()}
        for p in draw_params(space, draws, seed)
    ]
    fold = F.conv(F.substring(row_hash(key_cols, f"fold{seed}"), 1, 8), 16, 10).cast("long") % folds
    search = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=BinaryClassificationEvaluator(labelCol=trees.getLabelCol(), metricName="areaUnderROC"),
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(train.withColumn("_fold", fold.cast("int")))


def search_results(spark: SparkSession, search) -> DataFrame:
    """One row per draw: its settings and mean ROC-AUC over the folds, best first."""
    rows = [
        {**{p.name: float(v) for p, v in params.items()}, "mean_roc_auc": float(score)}
        for params, score in zip(search.getEstimatorParamMaps(), search.avgMetrics)
    ]
    return spark.createDataFrame(rows).orderBy(F.desc("mean_roc_auc"))


def predict(model: PipelineModel, df: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds the churn probability as ``score`` and the class as ``prediction``."""
    scored = model.transform(df)
    return scored.select(
        *(df.columns if keep is None else keep),
        vector_to_array("probability")[1].alias("score"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate_model(model: PipelineModel, df: DataFrame, name: str = "Test", label: str = LABEL) -> dict[str, DataFrame]:
    """``"ranking"``: ROC-AUC and average precision, on the score and on the hard prediction;
    ``"report"``: the classification report."""
    scored = predict(model, df, [label])
    kinds = F.array(
        F.struct(F.lit("score").alias("ranked_by"), F.col("score").alias("value")),
        F.struct(F.lit("prediction").alias("ranked_by"), F.col("prediction").cast("double").alias("value")),
    )
    ranking = ranking_metrics(scored.select(label, F.inline(kinds)), label, "value", ["ranked_by"])
    report = classification_report(scored, label, "prediction")
    return {"ranking": ranking.withColumn("set_name", F.lit(name)), "report": report.withColumn("set_name", F.lit(name))}


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Standard scores with the population deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns], *[F.stddev_pop(c).alias(f"std_{c}") for c in columns]
        ).alias("stats")
    ).scalar()
    scores = {}
    for c in columns:
        centred = F.col(c) - stats[f"mean_{c}"]
        scores[c] = F.when(stats[f"std_{c}"] > 0, centred / stats[f"std_{c}"]).otherwise(centred)
    return df.withColumns(scores)


def permuted_copies(
    df: DataFrame, features: Sequence[str], key_cols: Sequence[str], repeats: int, seed: int, ranges: int
) -> DataFrame:
    """For each row, feature and repeat: the row with that feature's value from another row.

    In every repeat rows are put in a new hash order, in ``ranges`` even pieces, and each row takes
    the value of the next row of its piece (the last that of the first): a random permutation that
    needs one shuffle and no row numbers.
    """
    copies = df.withColumn("_repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    hashed = copies.withColumn(
        "_hash", row_hash(key_cols, F.concat(F.lit(f"{seed}#"), F.col("_repeat").cast("string")))
    ).withColumn("_piece", F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long") % ranges)
    piece = Window.partitionBy("_repeat", "_piece").orderBy("_hash", *key_cols)
    own = F.struct(*features)
    donor = F.coalesce(F.lead(own).over(piece), F.first(own).over(piece))
    paired = hashed.withColumn("_donor", donor).withColumn(
        "feature", F.explode(F.array(*[F.lit(f) for f in features]))
    )
    others = [c for c in df.columns if c not in features]
    return paired.select(
        "feature",
        F.col("_repeat").alias("repeat"),
        *others,
        *[F.when(F.col("feature") == f, F.col("_donor")[f]).otherwise(F.col(f)).alias(f) for f in features],
    )


def permutation_importance(
    model: PipelineModel,
    df: DataFrame,
    key_cols: Sequence[str] = ENTITY_KEYS,
    label: str = LABEL,
    repeats: int = IMPORTANCE_REPEATS,
    seed: int = SEED,
    top: int | None = None,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Mean drop in accuracy when a feature's values are permuted; the largest drops first.

    All features are returned (of a column with its rate, the rate) unless ``top`` is given. All features and repeats are scored in one job,
    after one that counts the rows: a task puts about ``piece_rows`` of them in order.
    """
    features = [c for c in df.columns if c != label and f"{c}_rate" not in df.columns]
    ranges = max(1, math.ceil(df.count() / piece_rows))
    base = _accuracy(predict(model, df, [label]), label).select("accuracy").scalar()
    permuted = permuted_copies(df, features, key_cols, repeats, seed, ranges)
    per_repeat = _accuracy(predict(model, permuted, ["feature", "repeat", label]), label, ["feature", "repeat"])
    drops = (
        per_repeat.withColumn("drop", base - F.col("accuracy"))
        .groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )
    return drops if top is None else drops.limit(top)


def _accuracy(scored: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    hits = F.count_if(F.col(label) == F.col("prediction"))
    return scored.groupBy(*by).agg(E.ratio(hits, F.count("*")).alias("accuracy"))
