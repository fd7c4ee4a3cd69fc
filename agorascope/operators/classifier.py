"""Text classifier: TF-IDF and multinomial logistic regression (M5, M6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    StringIndexerModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope import fixed
from agorascope.functions.scores import probability_map
from agorascope.functions.text import fallback_text
from agorascope.operators.features import term_totals, vocabulary

INPUT = "model_text"
VERSION = "tfidf_logreg_v1"


def _feature_stages(terms: Sequence[str], idf: Sequence[float], stop_words: Sequence[str]) -> list:
    """The same features as `features.weigher`, as stages that work row by row and can be saved."""
    return [
        RegexTokenizer(inputCol=INPUT, outputCol="_tokens", pattern=fixed.TOKEN_PATTERN, gaps=False),
        StopWordsRemover(
            inputCol="_tokens", outputCol="_words", stopWords=list(stop_words), caseSensitive=True
        ),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
        CountVectorizerModel.from_vocabulary(list(terms), inputCol="_terms", outputCol="_counts"),
        ElementwiseProduct(inputCol="_counts", outputCol="_weighted", scalingVec=Vectors.dense(idf)),
        Normalizer(inputCol="_weighted", outputCol="features", p=2.0),
    ]


def train(
    docs: DataFrame,
    text_col: str,
    label_col: str,
    stop_words: Sequence[str] = (),
    max_features: int = 50_000,
    min_df: int = 1,
    c: float = 1.0,
    max_iter: int = 200,
) -> PipelineModel:
    """M5: fit on (text, label). The penalty 1/(c n) is the usual L2 with strength c.

    The vocabulary (at most `max_features` terms) is part of the model and passes the driver.
    """
    rows = docs.select(F.col(text_col).alias(INPUT), F.col(label_col).alias("label")).dropna()
    n = rows.count()
    vocab = vocabulary(term_totals(rows, INPUT, stop_words), n, max_features, min_df).orderBy("term_id").collect()
    labels = [r["label"] for r in rows.select("label").distinct().orderBy("label").collect()]
    stages = _feature_stages([r["term"] for r in vocab], [r["idf"] for r in vocab], stop_words)
    prepared = PipelineModel(
        [*stages, StringIndexerModel.from_labels(labels, inputCol="label", outputCol="_label")]
    )
    regression = LogisticRegression(
        featuresCol="features", labelCol="_label", predictionCol="_prediction",
        probabilityCol="_probability", rawPredictionCol="_raw", family="multinomial",
        maxIter=max_iter, regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False,
    )
    fitted = regression.fit(prepared.transform(rows).select("features", "_label"))
    names = IndexToString(inputCol="_prediction", outputCol="prediction", labels=labels)
    return PipelineModel([*stages, fitted, names])


def class_labels(model: PipelineModel) -> list[str]:
    return model.stages[-1].getLabels()


def predict(
    records: DataFrame,
    model: PipelineModel,
    model_version: str = VERSION,
    predicted_at: Column | None = None,
    empty_label: str = "neu",
) -> DataFrame:
    """M6: records plus a `sentiment` struct. Empty text gets `empty_label` and a note instead.

    Row by row, so it runs unchanged inside a streaming query.
    """
    predicted_at = F.current_timestamp() if predicted_at is None else predicted_at
    labels = class_labels(model)
    scored = model.transform(records.withColumn(INPUT, fallback_text(records.columns)))
    empty = F.col(INPUT) == ""
    proba = vector_to_array("_probability")
    filled = {
        "label": F.when(empty, empty_label).otherwise(F.col("prediction")),
        "model_version": F.lit(model_version),
        "predicted_at": predicted_at,
        "text_len": F.when(~empty, F.length(INPUT)),
        "proba": F.when(~empty, probability_map(labels, proba)),
        "confidence": F.when(~empty, F.array_max(proba)),
        "note": F.when(empty, "empty_text"),
    }
    sentiment = F.struct(*[value.alias(name) for name, value in filled.items()])
    kept = [c for c in records.columns if c != "sentiment"]
    return scored.select(*kept, sentiment.alias("sentiment"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
