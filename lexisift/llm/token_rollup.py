"""Token counts kept as additive rollups under signed changes.

A change is a document's key columns, a sign and a count of tokens: +1 for an insert, -1
for a delete, and both, of the old and the new text, for a revision. A batch of changes is
summed per source, language and tokenizer version and committed once under its name;
committing the same name again changes nothing. Totals are sums over committed batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisift.llm.bpe import default_vocabulary, encoder

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["documents", "tokens", "characters"]


def _counted(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_many
        for batch in batches:
            counts = np.concatenate([np.zeros(0, np.int64), *(
                np.diff(ends, prepend=0) for _, ends in encode(batch.column("text")))])
            kept = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"}
            yield pa.RecordBatch.from_pydict(kept | {"tokens": pa.array(counts, pa.int64())})
    return run


def changes(documents: DataFrame, sign: int, tokenizer: str, vocabulary: str | None = None) -> DataFrame:
    """Signed counts of documents: inserts with sign 1, deletes with sign -1.

    A revision is the old row with sign -1 and the new one with sign 1 in the same batch.
    Null texts have no tokens; null sources and languages are keys like any other.
    """
    rows = documents.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                            F.col("text").cast("string").alias("text"),
                            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("characters"))
    return rows.mapInArrow(_counted(vocabulary or default_vocabulary()),
                           "source string, lang string, characters long, tokens long").select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("documents"),
        (sign * F.col("tokens")).alias("tokens"), (sign * F.col("characters")).alias("characters"))


class Rollup:
    """A folder with one table of sums per committed batch.

    Spark's committer writes the ``_SUCCESS`` mark last: a batch with it is committed, one
    without it, left by a lost driver, is not read and is written again by a retry. One
    writer commits at a time.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def committed(self, batch: str) -> bool:
        return self._exists(f"{self.folder}/{batch}/_SUCCESS")

    def commit(self, batch: str, signed: DataFrame) -> bool:
        """Add a batch; False, and nothing done, if it is there already."""
        if self.committed(batch):
            return False
        sums = signed.groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        sums.write.mode("overwrite").parquet(f"{self.folder}/{batch}")
        return True

    def totals(self, batches: list[str]) -> DataFrame:
        """``source, lang, tokenizer, documents, tokens, characters`` over committed batches.

        Keys whose documents are all gone again are left out.
        """
        paths = [f"{self.folder}/{b}" for b in batches if self.committed(b)]
        if not paths:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, "
                                              "documents long, tokens long, characters long")
        return (self.spark.read.parquet(*paths).groupBy(*KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])
                .where("documents <> 0 or tokens <> 0 or characters <> 0"))
