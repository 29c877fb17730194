"""Text classification and similarity with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

FEATURES = 1 << 14


def _text_stages(text: str) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="__w", pattern=r"\W+", minTokenLength=2), NGram(n=2, inputCol="__w", outputCol="__w2"),
        SQLTransformer(statement="SELECT *, concat(__w, __w2) AS __all FROM __THIS__"), HashingTF(inputCol="__all", outputCol="__tf", numFeatures=FEATURES),
        IDF(inputCol="__tf", outputCol="__idf", minDocFreq=1), Normalizer(inputCol="__idf", outputCol="features", p=2.0),
    ]


def train_classifier(df: DataFrame, text: str, label: str) -> PipelineModel:
    """Words and pairs, weighted; logistic regression with balanced classes."""
    n = df.groupBy(label).agg(F.count("*").alias("__c"))
    k, total = n.count(), df.count()
    weighted = df.join(F.broadcast(n), label).withColumn("__weight", F.lit(total) / (F.lit(k) * F.col("__c")))  # one row a label
    lr = LogisticRegression(featuresCol="features", labelCol="__y", weightCol="__weight", maxIter=40, regParam=0.001)
    return Pipeline(stages=[StringIndexer(inputCol=label, outputCol="__y", handleInvalid="skip"), *_text_stages(text), lr]).fit(weighted)


def predict(model: PipelineModel, df: DataFrame, label: str, least: float = 0.0) -> DataFrame:
    """Adds ``predicted`` (null under ``least``) and ``confidence``."""
    names = model.stages[0].labels
    given = df if label in df.columns else df.withColumn(label, F.lit(names[0]))
    out = model.transform(given)
    p = vector_to_array("probability")
    best = F.array_max(p)
    name = F.element_at(F.array(*[F.lit(x) for x in names]), (F.array_position(p, best)).cast("int"))
    return out.withColumn("confidence", best).withColumn("predicted", F.when(best >= least, name)).drop("__w", "__w2", "__all", "__tf", "__idf", "features", "rawPrediction", "probability", "prediction", "__y")


def best_similarity(queries: DataFrame, corpus: DataFrame, key: str, other: str, text: str) -> DataFrame:
    """(key, other, similarity): the most similar corpus text of every query by TF-IDF cosine.

    The vectors are joined on their shared dimensions and summed, so only texts that share a word meet.
    """
    stages = Pipeline(stages=_text_stages("__text"))
    a, b = queries.select(F.col(key), F.col(text).alias("__text")), corpus.select(F.col(other), F.col(text).alias("__text"))
    model = stages.fit(b.select("__text"))
    terms = lambda df, k, v: model.transform(df.filter("__text IS NOT NULL")).select(F.col(k), F.posexplode(vector_to_array("features")).alias("__i", v)).filter(F.col(v) > 0)
    dots = terms(a, key, "__x").join(terms(b, other, "__z"), "__i").groupBy(key, other).agg(F.sum(F.col("__x") * F.col("__z")).alias("similarity"))
    return dots.groupBy(key).agg(F.max(F.struct("similarity", (-F.col(other)).alias("__o"))).alias("m")).select(key, (-F.col("m.__o")).alias(other), F.col("m.similarity").alias("similarity"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support) for every label."""
    both = df.select(F.col(actual).alias("a"), F.col(predicted).alias("p"))
    hit = both.groupBy(F.col("a").alias("label")).agg(F.count("*").alias("support"), F.count_if(F.col("a") == F.col("p")).alias("tp"))
    said = both.groupBy(F.col("p").alias("label")).agg(F.count("*").alias("said"))
    out = hit.join(said, "label", "left")
    precision, recall = F.col("tp") / F.col("said"), F.col("tp") / F.col("support")
    return out.select("label", precision.alias("precision"), recall.alias("recall"), F.when(F.col("tp") > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0).alias("f1"), "support")


def prediction_mix(df: DataFrame, by_rule: str, confidence: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(by_rule)).alias("by_rule"), F.count_if(~F.col(by_rule) & (F.col(confidence) >= 0.6)).alias("by_model"), F.count_if(~F.col(by_rule) & (F.col(confidence) < 0.6)).alias("low"),
        F.avg(confidence).alias("mean_confidence"), F.min(confidence).alias("least"), F.max(confidence).alias("most"),
    )
