"""A count vectorizer whose vocabulary is ranked as a DataFrame."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.functions import constants as K
from lexisift.operators.arrow_terms import term_totals
from lexisift.operators.vocabulary import most_frequent
from lexisift.session import durable


class RankedVectorizer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Like ``CountVectorizer``, with ties settled by term and nothing but the vocabulary on the driver.

    ``CountVectorizer`` hands the best terms of *every* partition to the driver. Here the
    counts are written once and cut off at a frequency, so only the final list, at most
    ``vocabSize`` terms, gets there. The fitted stage is Spark's own ``CountVectorizerModel``.
    ``minDF`` below one is a share of the documents.
    """

    vocabSize = Param(Params._dummy(), "vocabSize", "terms of the vocabulary at most", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "documents that a term is in at least", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol: str = "tokens", outputCol: str = "tf", vocabSize: int = K.DEFAULT_VOCABULARY_SIZE,
                 minDF: float = K.DEFAULT_DOCUMENT_FREQUENCY):
        super().__init__()
        self._setDefault(inputCol="tokens", outputCol="tf", vocabSize=K.DEFAULT_VOCABULARY_SIZE,
                         minDF=K.DEFAULT_DOCUMENT_FREQUENCY)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        least = self.getOrDefault(self.minDF)
        least = least if least >= 1 else least * dataset.count()
        counted = durable(term_totals(dataset, self.getInputCol()).where(F.col("df") >= least), "vocabulary")
        ranked = most_frequent(counted, self.getOrDefault(self.vocabSize))
        terms = [row.term for row in sorted(ranked.collect(), key=lambda row: (-row.cf, row.term))]
        return vectorizer_model(dataset.sparkSession, terms, self.getInputCol(), self.getOutputCol())


def vectorizer_model(spark: SparkSession, terms: list[str], input_column: str, output: str) -> CountVectorizerModel:
    """``CountVectorizerModel.from_vocabulary``, which calls the JVM for every term, in one call."""
    joined = "".join(terms)
    mark = next((c for c in map(chr, range(32)) if c not in joined), None)
    if not terms or mark is None:
        return CountVectorizerModel.from_vocabulary(terms, inputCol=input_column, outputCol=output)
    pattern = spark.sparkContext._jvm.java.util.regex.Pattern
    model = CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", pattern.compile(mark, pattern.LITERAL).split(mark.join(terms), -1))
    return model.setInputCol(input_column).setOutputCol(output)._set(vocabSize=len(terms))
