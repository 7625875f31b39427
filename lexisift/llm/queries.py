"""Registered queries of the numbered operators and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lexisift.llm import sql
from lexisift.llm.capture_index import archive_pages, look_up, read_captures
from lexisift.llm.decontaminate import contamination
from lexisift.llm.language import identify
from lexisift.llm.license_scan import scan_licenses
from lexisift.llm.line_dedup import dedup_lines
from lexisift.llm.near_dedup import near_duplicates
from lexisift.llm.packing import pack
from lexisift.llm.periodic_runs import periodic_runs
from lexisift.llm.prefix_trie import prefix_nodes, sequences
from lexisift.llm.pii import scan_personal
from lexisift.llm.secret_scan import scan_secrets
from lexisift.llm.tables import table
from lexisift.llm.token_rollup import Rollup, changes
from lexisift.llm.topk import exact_top_k
from lexisift.session import durable, shared_folder


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle=4, percent=80)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines, those deleted, and a digest of what is kept."""
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_deleted", F.sha2("text", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


def op7_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return scan_personal(table(spark, folder, "documents"))


def op9_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after three batches over all documents, one of them sent twice.

    ``load`` inserts every document; ``copies`` deletes all but the first of equal texts;
    ``revise`` replaces texts of the rest that hold blank lines or padded line ends.
    """
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    digest = F.sha2(F.col("text"), 256)
    first = documents.where("text is not null").groupBy(digest.alias("digest")).agg(
        F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = documents.withColumn("digest", digest).join(first, "digest").where("doc_id <> first").drop("digest", "first", "n")
    clean = F.regexp_replace("text", r"[ \t]*\n\s*", "\n")
    revised = documents.where(clean != F.col("text")).join(copies.select("doc_id"), "doc_id", "left_anti")
    rollup, name = Rollup(spark, shared_folder(spark, "rollup")), "byte_bpe_50k"
    for batch, signed in (
            ("load", lambda: changes(documents, 1, name)),
            ("load", lambda: changes(documents, 1, name)),
            ("copies", lambda: changes(copies, -1, name)),
            ("revise", lambda: changes(revised, -1, name).unionByName(
                changes(revised.withColumn("text", clean), 1, name)))):
        rollup.commit(batch, signed())
    return rollup.totals(["load", "copies", "revise"])


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_capture_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every page, written to archives, looked up by URL and id, and read back by its range."""
    pages = table(spark, folder, "pages")
    index = archive_pages(pages, shared_folder(spark, "archives"))
    return read_captures(index, look_up(index, pages), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def _looped(documents: DataFrame) -> DataFrame:
    """Texts whose id hashes to a multiple of ten repeat a block of their words from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    chosen = documents.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), F.when(h % 10 == 0, words).alias("w"))
    placed = (chosen.withColumn("n", F.size("w").cast("long")).withColumn("a", F.expr("if(n > 0, g % n, 0)"))
              .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)")))
    text = F.expr("if(n > 0, array_join(transform(sequence(0, n - 1), i -> element_at(w, cast("
                  "1 + if(i < a, i, a + (i - a) % p) as int))), ' '), text)")
    return placed.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(_looped(table(spark, folder, "documents")))
    # Greatest length first; ties by smallest start, then period.
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr(r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period)), '\n') || if(size(runs) > 0, '\n', '')")
    return found.withColumn("b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("b.start")).alias("start"),
        F.col("b.length").alias("length"), (-F.col("b.period")).alias("period"),
        F.expr("1000 * b.length div -b.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _forked(paths: DataFrame) -> DataFrame:
    """Conversations whose first turns, none to three by a hash of the id, are those of a neighbour."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    leads = paths.where("conv_id % 20 = 0").select(F.col("conv_id").alias("lead_id"), F.slice("turns", 1, 3).alias("lead"))
    joined = paths.withColumn("lead_id", F.expr("conv_id - conv_id % 20")).join(leads, "lead_id", "left")
    lead = F.coalesce("lead", F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(F.slice(lead, F.lit(1), h), F.slice(
        "turns", h + 1, F.size("turns"))).alias("turns"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths = durable(sequences(table(spark, folder, "conversations")), "conversations")
    return prefix_nodes(_forked(paths)).drop("node")


QUERIES = {f.__name__: f for f in (
    op1_minhash_near_dedup, op2_secret_scan, op3_line_dedup, op4_license_scan, op5_packing, op6_language_id,
    op7_exact_top_k, op8_pii, op9_token_rollup, op10_decontamination, op11_capture_index,
    op12_periodic_runs, op13_prefix_trie)} | {"pipeline": corpus_pipeline.run}

SQL = {"op1_minhash_near_dedup": sql.NEAR_DEDUP, "op7_exact_top_k": sql.TOP_K, "op10_decontamination": sql.CONTAMINATION,
       "op11_capture_index": sql.CAPTURES, "op13_prefix_trie": sql.PREFIX_TRIE}
