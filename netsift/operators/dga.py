"""Generated-domain classifiers: feature Columns, training, metrics, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netsift.functions import text
from netsift.operators.dns import domain_counts


def domain_features(c: str = "domain") -> dict[str, Column]:
    """Thirteen measures of a name and its first label."""
    sub = text.first_label_trimmed(c)
    full = F.rtrim(F.col(c), F.lit("."))
    return {
        "domain_length": F.length(full), "subdomain_length": F.length(sub), "entropy": text.entropy(sub, lower=True),
        "cv_ratio": text.consonant_share(sub), "digit_ratio": text.digit_ratio(sub), "hex_ratio": text.hex_ratio(sub),
        "ngram_score": text.non_letter_bigram_share(sub), "char_freq_deviation": text.letter_deviation(sub),
        "dot_count": text.count_of(full, "."), "hyphen_count": text.count_of(full, "-"),
        "has_digits": text.has_digits(sub), "max_run_length": text.longest_run(sub),
        "unique_char_ratio": text.unique_ratio(sub),
    }


def label_features(c: str = "domain") -> dict[str, Column]:
    """Twelve measures of the lower-cased first label and the name, four digits."""
    label = F.lower(text.first_label(c))
    r = lambda x: F.round(x, 4)
    return {
        "length": F.length(label), "entropy": text.entropy(label, digits=4),
        "cv_ratio": text.consonants_per_vowel(label, 4), "bigram_score": text.english_bigram_mean(label, 4),
        "digit_ratio": r(text.digit_ratio(label)), "hyphen_ratio": r(text.hyphen_ratio(label)),
        "vowel_ratio": r(text.vowel_ratio(label)), "unique_char_ratio": r(text.unique_ratio(label)),
        "has_digits": text.has_digits(label), "has_hyphens": text.has_hyphens(label),
        "num_dots": text.count_of(c, "."), "tld_risk": text.tld_risk(c),
    }


FEATURES = {"domain": domain_features, "label": label_features}


def with_features(df: DataFrame, kind: str = "domain", c: str = "domain") -> DataFrame:
    named = FEATURES[kind](c)
    return df.select("*", *[v.alias(k) for k, v in named.items()])


def _split(df: DataFrame, share: float, seed: int, stratified: bool) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by hash, so that it does not depend on partitioning."""
    salt = ["label"] if stratified else []
    bucket = F.pmod(F.xxhash64(F.lit(seed), *salt, "domain"), F.lit(10_000))
    limit = int(share * 10_000)
    return df.where(bucket >= limit), df.where(bucket < limit)


def train(labelled: DataFrame, kind: str = "domain", trees: int | None = None, depth: int | None = None,
          min_leaf: int | None = None, test_share: float = 0.2, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    """Fit a random forest on (domain, label); returns the model and the held-out rows.

    Defaults: 100 trees of depth 10 for the domain features; 200 trees of depth 30 (the deepest
    Spark grows) with two rows per leaf and a per-class split for the label features.
    """
    second = kind == "label"
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", seed=seed, numTrees=trees or (200 if second else 100),
        maxDepth=depth or (30 if second else 10), minInstancesPerNode=min_leaf or (2 if second else 1))
    cols = list(FEATURES[kind]("domain"))
    rows = with_features(labelled.select(F.trim("domain").alias("domain"), F.col("label").cast("double")
                                         .alias("label")).where("domain <> ''"), kind)
    fit_rows, held = _split(rows, test_share, seed, second)
    model = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), forest]).fit(fit_rows)
    return model, held


def metrics(model: PipelineModel, held: DataFrame) -> DataFrame:
    """One row: precision, recall, F1, accuracy and AUC on held-out rows."""
    scored = model.transform(held)
    auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction").evaluate(scored)
    hit, said, true = (F.count_if((F.col("prediction") == 1) & (F.col("label") == 1)),
                       F.count_if(F.col("prediction") == 1), F.count_if(F.col("label") == 1))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(hit, said), ratio(hit, true)
    right = F.count_if(F.col("prediction") == F.col("label"))
    return scored.agg(
        F.round(p, 4).alias("precision"), F.round(r, 4).alias("recall"),
        F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 4).alias("f1_score"),
        F.round(ratio(right, F.count("*")), 4).alias("accuracy"), F.lit(round(auc, 4)).alias("auc_roc"),
        F.count("*").alias("test_size"))


def importances(model: PipelineModel, kind: str = "domain") -> list[tuple[str, float]]:
    """Feature importances, largest first."""
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(FEATURES[kind]("domain"), map(float, values)), key=lambda p: -p[1])


def probability(df: DataFrame, model: PipelineModel, kind: str) -> DataFrame:
    scored = model.transform(with_features(df, kind))
    return scored.withColumn("dga_probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction")


def detect(dns: DataFrame, model: PipelineModel, threshold: float = 0.65) -> DataFrame:
    """Names whose probability reaches the threshold, with their query counts, most likely first.

    Names are counted and deduplicated (lower case) before any feature is computed.
    """
    scored = probability(domain_counts(dns), model, "domain")
    return (scored.where(F.col("dga_probability") >= threshold).withColumn("is_dga", F.lit(True))
            .orderBy(F.desc("dga_probability"), "domain"))


def classify(domains: DataFrame, model: PipelineModel) -> DataFrame:
    """Verdict and confidence per name, most likely first."""
    p = F.col("dga_probability")
    return (probability(domains.select("domain"), model, "label")
            .select("domain", F.round(p, 4).alias("dga_prob"), F.when(p >= 0.5, "DGA").otherwise("BENIGN").alias("verdict"),
                    F.when(F.abs(p - 0.5) > 0.3, "HIGH").otherwise("LOW").alias("confidence"))
            .orderBy(F.desc("dga_prob"), "domain"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
