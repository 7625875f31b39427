"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item's windows are sets of words that a document has to contain whole, so one word of
each window, its prefix, is enough to find every candidate; the rarest word of the window
in all documents is taken. Candidates whose window would reach past the document are
dropped by position and length, and the rest are compared word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisift.llm.tables import UPPER, text_of
from lexisift.session import durable

WINDOW = 10                 # words of a benchmark item that count as copied together
BROADCAST_ROWS = 50_000     # prefix rows (at most about 300 bytes each) that may be broadcast
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = ""                   # no word is empty, so this one can mark the end of each document


def words(column: str = "text") -> Column:
    """Words of a text: digits, ASCII letters lower-cased, and everything beyond ASCII."""
    lowered = F.translate(text_of(column), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, _SEPARATORS), "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, window)``: every run of ``window`` words; a shorter item is one window."""
    items = benchmark.select(F.col("item_id"), words().alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    return (items.select("item_id", "words", F.explode(starts).alias("start"))
            .select("item_id", F.slice("words", F.col("start"), window).alias("window")).distinct())


def _prefixes(documents: DataFrame, windows: DataFrame) -> DataFrame:
    """``(token, shift, length, window, window_id)``: the rarest word of each window, and where."""
    vocabulary = windows.select(F.explode("window").alias("token")).distinct()
    spread = documents.select(F.explode_outer("words").alias("token"))
    counts = spread.join(_sized(vocabulary), "token").groupBy("token").agg(F.count("*").alias("frequency"))
    placed = windows.select("window_id", "window", F.posexplode("window").alias("shift", "token"))
    ranked = placed.join(counts, "token", "left").groupBy("window_id").agg(
        F.min(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "token", "shift")).alias("rarest"),
        F.first("window").alias("window"))
    return ranked.where("rarest.frequency > 0").select(
        F.col("rarest.token").alias("token"), F.col("rarest.shift").alias("shift"),
        F.size("window").alias("length"), "window", "window_id")


def _sized(small: DataFrame) -> DataFrame:
    """Marked for broadcast if it is small enough, else left to a shuffle join."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def _occurrences(documents: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """``(doc_id, n_words, hash, start, length, window_id)`` of windows found in documents.

    Each document also gives one row with ``window_id`` null, so all of them stay.
    """
    end = documents.sparkSession.range(1).select(
        F.lit(_END).alias("token"), F.lit(0).alias("shift"), F.lit(0).alias("length"),
        F.array().cast("array<string>").alias("window"), F.lit(None).cast("long").alias("window_id"))
    wanted = prefixes.unionByName(end)
    whole = documents.select("doc_id", "hash", F.size("words").alias("n_words"), "words",
                             F.posexplode_outer(F.array_append("words", F.lit(_END))).alias("pos", "token"))
    start = F.col("pos") - F.col("shift")
    inside = (start >= 0) & (start + F.col("length") <= F.col("n_words"))
    if prefixes.count() <= BROADCAST_ROWS:
        # Probing and comparing run in one compiled stage: word arrays are never copied.
        hits = whole.join(F.broadcast(wanted), "token").where(
            inside & (F.slice("words", start + 1, F.col("length")) == F.col("window")))
    else:
        # Beyond the bound only the words around each position travel to the shuffle join.
        low = F.greatest(F.col("pos") - window + 1, F.lit(0))
        near = whole.select("doc_id", "hash", "n_words", "token", "pos", low.alias("low"),
                            F.slice("words", low + 1, 2 * window).alias("near"))
        hits = near.join(wanted, "token").where(
            inside & (F.slice("near", start - F.col("low") + 1, F.col("length")) == F.col("window")))
    return hits.select("doc_id", "n_words", "hash", start.alias("start"), "length", "window_id")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window of any item; ``n_items``
    the items with such windows. Null or wordless texts have no words and are never hit; null or
    wordless items have no windows; an empty benchmark hits nothing. Items without
    ``item_id`` hit words but are not listed. Repeated rows give a row each. Other
    columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), words().alias("words"),
                            F.xxhash64(text_of()).alias("hash"))
    owned = durable(item_windows(benchmark, window).withColumn("window_id", F.xxhash64("window")), "windows")
    distinct = owned.select("window_id", "window").distinct()
    prefixes = durable(_prefixes(docs, distinct), "prefixes")
    found = _occurrences(docs, prefixes, window)
    at = F.struct("start", "length")
    # What is gathered for a document is bounded by its own length.
    per_doc = found.groupBy("doc_id", "n_words", "hash").agg(
        F.count_if(F.col("window_id").isNull()).alias("copies"),
        F.collect_set(F.when(F.col("window_id").isNotNull(), at)).alias("places"),
        F.collect_set("window_id").alias("windows"))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p["start"], p["start"] + p["length"] - 1)))))
    per_doc = durable(per_doc.withColumn("n_hit", n_hit).drop("places"), "hits")
    items = (per_doc.select("doc_id", "n_words", "hash", F.explode("windows").alias("window_id"))
             .join(owned.select("window_id", F.col("item_id").cast("string").alias("item")), "window_id")
             .groupBy("doc_id", "n_words", "hash").agg(F.array_sort(F.collect_set("item")).alias("items")))
    keys = ["doc_id", "n_words", "hash"]
    p, i = per_doc.alias("p"), items.alias("i")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"i.{k}")) for k in keys]
    listed = F.coalesce(F.col("i.items"), F.array().cast("array<string>"))
    return p.join(i, same, "left").select(
        "p.doc_id", F.col("p.n_words").cast("long").alias("n_words"), F.col("p.n_hit").cast("long").alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        (F.col("p.n_hit") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(1), F.col("p.copies").cast("int"))).alias("copy")).drop("copy")
