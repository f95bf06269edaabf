"""Text models: symptom labels and high-recall ideation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import IDEATION_THRESHOLD, SYMPTOM_THRESHOLD, SYMPTOMS
from screenwell.functions.text import words
from screenwell.operators.evaluation import positive_weight
from screenwell.operators.triage import threshold_symptoms
from screenwell.session import cut_lineage


def text_features(train: DataFrame, text: str = "text", size: int = 1 << 16) -> Model:
    """Hashed word counts weighted by inverse document frequency, fitted on ``train``."""
    return Pipeline(stages=[
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size),
        IDF(inputCol="_counts", outputCol="features", minDocFreq=2),
    ]).fit(train.withColumn("_words", words(F.col(text))))


def with_features(model: Model, df: DataFrame, text: str = "text") -> DataFrame:
    return model.transform(df.withColumn("_words", words(F.col(text)))).drop("_words", "_counts")


def positive_share(column: str) -> Column:
    return vector_to_array(column)[1]


@dataclass
class SymptomModel:
    """One logistic model per label over shared features."""

    features: Model
    models: list[Model]
    labels: list[str]

    def probabilities(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``symptom_prob``: one probability per label."""
        out = with_features(self.features, df, text)
        for i, model in enumerate(self.models):
            out = model.transform(out).withColumn(f"_p{i}", positive_share("probability")).drop(
                "probability", "rawPrediction", "prediction")
        names = [f"_p{i}" for i in range(len(self.models))]
        return out.withColumn("symptom_prob", F.array(*names)).drop("features", *names)


def train_symptoms(train: DataFrame, labels: list[str] = SYMPTOMS, text: str = "text",
                   iterations: int = 50, ridge: float = 0.01) -> SymptomModel:
    """``train`` carries ``labels``: a 0/1 array in label order. Its features are stored once; every
    label's model reads them, instead of making them anew."""
    features = text_features(train, text)
    rows = cut_lineage(with_features(features, train, text).select("features", "labels"))
    models = []
    for i in range(len(labels)):
        one = rows.withColumn("_y", F.col("labels")[i].cast("double"))
        models.append(LogisticRegression(labelCol="_y", maxIter=iterations, regParam=ridge).fit(one))
    return SymptomModel(features, models, labels)


@dataclass
class IdeationModel:
    features: Model
    model: Model

    def probabilities(self, df: DataFrame, text: str = "text") -> DataFrame:
        """Add ``ideation_prob``."""
        out = self.model.transform(with_features(self.features, df, text))
        return out.withColumn("ideation_prob", positive_share("probability")).drop(
            "features", "probability", "rawPrediction", "prediction")


def train_ideation(train: DataFrame, label: str = "si_label", text: str = "text",
                   iterations: int = 50, ridge: float = 0.01) -> IdeationModel:
    """Logistic model whose positives weigh twice the class ratio, at most 20."""
    features = text_features(train, text)
    weight = positive_weight(train, label).select("positive_weight").scalar()
    rows = with_features(features, train, text).withColumn("_w", weight).withColumns({
        "_y": F.col(label).cast("double"),
        "_w": F.when(F.col(label) == 1, F.col("_w")).otherwise(1.0)})
    rows = cut_lineage(rows.select("features", "_y", "_w"))
    return IdeationModel(features, LogisticRegression(
        labelCol="_y", weightCol="_w", maxIter=iterations, regParam=ridge).fit(rows))


def score_texts(df: DataFrame, symptoms: SymptomModel, ideation: IdeationModel,
                text: str = "text", symptom_at: float = SYMPTOM_THRESHOLD,
                ideation_at: float = IDEATION_THRESHOLD) -> DataFrame:
    """Probabilities, active labels and the ideation flag for a table of texts."""
    scored = ideation.probabilities(symptoms.probabilities(df, text), text)
    return threshold_symptoms(scored, labels=symptoms.labels, symptom_at=symptom_at,
                              ideation_at=ideation_at)
