"""TF-IDF features, chi-square selection and their relational counterparts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (IDF, CountVectorizerModel, Normalizer, RegexTokenizer, StopWordsRemover,
                                StringIndexer, Tokenizer)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators.arrow_terms import applied
from lexisift.operators.selection import (ContingencySelector, ContingencySelectorModel, contingency_statistics,
                                          vector_entries, with_log_p)
from lexisift.operators.vectorize import RankedVectorizer
from lexisift.operators.vocabulary import document_frequencies, most_frequent, vocabulary_table  # noqa: F401
from lexisift.session import durable


@dataclass(frozen=True)
class FeatureSpec:
    """What the feature stages compute.

    ``tokenizer``: ``ml_regex`` (all whitespace), ``ml_regex_literal`` (blank and tab
    only) or ``whitespace``. ``normalize``: L2 ``after`` selection, ``before`` it or
    ``none``. ``stop_words`` None means Spark's English list, ``selected`` None no selection.
    """

    tokenizer: str = "ml_regex"
    stop_words: tuple[str, ...] | None = None
    vocabulary_size: int = K.VOCABULARY_SIZE
    min_df: float = K.MIN_DOCUMENT_FREQUENCY
    selected: int | None = K.SELECTED_FEATURES
    normalize: str = "after"


def tokenizer_stage(spec: FeatureSpec) -> Transformer:
    if spec.tokenizer == "whitespace":
        return Tokenizer(inputCol="text", outputCol="tokens")
    patterns = {"ml_regex": K.ML_PATTERN, "ml_regex_literal": K.ML_PATTERN_LITERAL}
    return RegexTokenizer(inputCol="text", outputCol="tokens", gaps=True, toLowercase=True,
                          pattern=patterns[spec.tokenizer])


def stop_word_stage(spec: FeatureSpec) -> StopWordsRemover:
    remover = StopWordsRemover(inputCol="tokens", outputCol="clean_tokens")
    return remover if spec.stop_words is None else remover.setStopWords(list(spec.stop_words))


def token_stages(spec: FeatureSpec) -> list:
    return [tokenizer_stage(spec), stop_word_stage(spec)]


def vectorizer_stage(spec: FeatureSpec) -> RankedVectorizer:
    return RankedVectorizer(inputCol="clean_tokens", outputCol="tf", minDF=spec.min_df, vocabSize=spec.vocabulary_size)


def selector_stage(selected: int, features: str = "tfidf", output: str = "selected",
                   label: str = "label") -> ContingencySelector:
    return ContingencySelector(numTopFeatures=selected, featuresCol=features, outputCol=output, labelCol=label)


def weight_stages(spec: FeatureSpec) -> list:
    stages = [IDF(inputCol="tf", outputCol="tfidf"),
              StringIndexer(inputCol="category", outputCol="label", stringOrderType="frequencyDesc")]
    if spec.normalize == "before":
        stages.append(Normalizer(inputCol="tfidf", outputCol="scaled", p=2.0))
    if spec.selected is None:
        return stages
    if spec.normalize == "before":
        return [*stages, selector_stage(spec.selected, features="scaled", output="features")]
    if spec.normalize == "after":
        return [*stages, selector_stage(spec.selected),
                Normalizer(inputCol="selected", outputCol="features", p=2.0)]
    return [*stages, selector_stage(spec.selected, output="features")]


def feature_stages(spec: FeatureSpec = FeatureSpec()) -> list:
    """All stages, for a pipeline that is fitted as a whole (for example inside folds)."""
    return [*token_stages(spec), vectorizer_stage(spec), *weight_stages(spec)]


@dataclass(frozen=True)
class Features:
    """Fitted stages, and the documents with their vectors."""

    model: PipelineModel
    frame: DataFrame

    @property
    def vocabulary(self) -> list[str]:
        return _stage(self.model, CountVectorizerModel).vocabulary

    @property
    def labels(self) -> list[str]:
        return next(list(s.labels) for s in self.model.stages if hasattr(s, "labels"))


def _stage(model: PipelineModel, kind: type):
    return next(s for s in model.stages if isinstance(s, kind))


def fit_features(documents: DataFrame, spec: FeatureSpec = FeatureSpec(),
                 keep: Sequence[str] = (), fit_on: Column | None = None) -> Features:
    """Fit all feature stages and transform ``(keep..., category, text)`` documents.

    The text is read and tokenized once. Its terms and their counts are written to the shared folder, the
    vocabulary and the sparse count vectors are made from those, and everything fitted later
    reads the vectors. ``fit_on`` limits fitting to some rows, such as a training split;
    without it the stages see all rows.
    """
    def fitting_rows(df: DataFrame) -> DataFrame:
        return df if fit_on is None else df.filter(fit_on)

    tokenizing = PipelineModel(token_stages(spec))
    tokens = durable(applied(tokenizing.stages, documents, counted=True).select(*keep, "category", "clean_tokens"), "tokens")
    vectorizing = vectorizer_stage(spec).fit(fitting_rows(tokens))
    counted = durable(applied([vectorizing], tokens).select(*keep, "category", "tf"), "tf")
    # Labels come from all rows: a category that the fitting rows lack is a label all the same.
    stages = [s.fit(counted) if isinstance(s, StringIndexer) else s for s in weight_stages(spec)]
    weighting = Pipeline(stages=stages).fit(fitting_rows(counted))
    return Features(PipelineModel([*tokenizing.stages, vectorizing, *weighting.stages]), weighting.transform(counted))


def training_frame(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns that fitting needs, as an evenly sized table of their own.

    Tuning scans its input hundreds of times, so it reads this instead of running the
    feature stages each time.
    """
    return durable(frame.select(*columns), "training", rebalance=True)


def reselect(features: Features, selected: int, output: str = "heavy_selected",
             fit_on: Column | None = None) -> DataFrame:
    """The same TF-IDF vectors reduced to another number of terms."""
    rows = features.frame if fit_on is None else features.frame.filter(fit_on)
    return selector_stage(selected, output=output).fit(rows).transform(features.frame)


def selected_terms(features: Features) -> DataFrame:
    """``(feature_index, term)`` of the selected features; bounded by the selector's count."""
    vocabulary = features.vocabulary
    indices = _stage(features.model, ContingencySelectorModel).selectedFeatures
    return _indexed_terms(features, indices, [vocabulary[i] for i in indices])


def vocabulary_frame(features: Features) -> DataFrame:
    """``(feature_index, term)`` of the fitted vocabulary; bounded by the vocabulary size."""
    return _indexed_terms(features, range(len(features.vocabulary)), features.vocabulary)


def _indexed_terms(features: Features, indices: Sequence[int], terms: Sequence[str]) -> DataFrame:
    """A local table, whose size the optimizer knows when it chooses a join."""
    return features.frame.sparkSession.createDataFrame(pa.table({
        "feature_index": pa.array(list(indices), pa.int32()), "term": pa.array(list(terms), pa.string())}))


def vector_terms(features: Features, vector: str, keep: Sequence[str]) -> DataFrame:
    """Sparse vectors over the whole vocabulary as ``(keep..., term, weight)`` rows.

    Terms are as skewed as language is; the vocabulary is broadcast if it is found to be
    small and joined with skew splitting otherwise.
    """
    entries = vector_entries(features.frame, vector, list(keep)).withColumnRenamed("value", "weight")
    return entries.join(vocabulary_frame(features), "feature_index").select(*keep, "term", "weight")


# Relational counterparts -------------------------------------------------------------


def idf_table(vocabulary: DataFrame, documents: DataFrame) -> DataFrame:
    """``ln((N + 1) / (df + 1))`` per term; ``documents`` gives N."""
    n = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    return vocabulary.select("term", "df", F.log(
        (n.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0)).alias("idf"))


def tfidf_table(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """Weighted ``(document, term)`` rows.

    Terms are as skewed as language is, so the join side is left to the optimizer: a
    vocabulary that fits is broadcast, a larger one is joined with skew splitting.
    """
    return (frequencies.join(idf.select("term", "idf"), "term")
            .withColumn("tfidf", F.col("n").cast("double") * F.col("idf")).drop("idf"))


def label_index_table(documents: DataFrame) -> DataFrame:
    """Categories by descending frequency, ties by name, numbered from 0.

    The window sees one row per category, which a label indexer holds on the driver.
    """
    order = Window.orderBy(F.col("documents").desc(), F.col("category").asc())
    counts = documents.groupBy("category").agg(F.count(F.lit(1)).alias("documents"))
    return counts.withColumn("label", (F.row_number().over(order) - 1).cast("double"))


def feature_statistics(frequencies: DataFrame, documents: DataFrame) -> DataFrame:
    """``(term, df, statistic, degrees)`` of each term's counts against the category.

    ``frequencies`` is ``(category, term, n)`` per document, ``documents`` has the categories.
    """
    return contingency_statistics(frequencies, documents, "term", "n")


def best_terms(statistics: DataFrame, vocabulary: DataFrame, selected: int = K.SELECTED_FEATURES) -> DataFrame:
    """``(term, log_p)`` of the ``selected`` terms with the smallest p-values.

    Ties go by the place in the vocabulary, ``(term, cf)``: more occurrences first, then by term.
    """
    order = [F.col("log_p"), F.col("cf").desc(), F.col("term")]
    return (with_log_p(statistics).join(vocabulary.select("term", "cf"), "term")
            .orderBy(*order).limit(selected).select("term", "log_p"))
