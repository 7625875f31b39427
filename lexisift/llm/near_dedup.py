"""Near-duplicates by chosen-path set similarity join.

Every tree sends a document to the node named by one of its minwise shingles. Nodes that
hold unlinked documents and are still large branch again on further minwise shingles,
chosen by the node; small ones are compared exhaustively. There are as many independent trees
as it takes for a pair at the threshold to miss all leaves with a probability below
``MISSED``, its nodes being as deep as they get. All links are confirmed on the full
shingle sets.

Only what can change a component is compared. A first round tries to link each document
to a few pivots, those of its nodes' pivots that look most alike. Nodes whose documents are
then all in one component are done. In the others, pairs across components go on.
So a group of n near copies costs about n comparisons, not n squared, and no link between
two components is left out on purpose.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexisift.llm.components import connected_components
from lexisift.llm.hashing import fingerprint, minwise, shingle_set
from lexisift.session import durable

COORDINATES = 256  # minwise values per document; four bits of each form its sketch
LONGS = COORDINATES // 16
BRANCHED = 64      # of them, those that nodes branch on (at least one for each tree)
MISSED = 0.001     # a pair at the threshold shares no leaf with a probability below this
LOWEST = 50        # percent; below, trees would become too many
DEPTH = 5          # levels of branching; what is still large then is compared all the same
SMALL = 128        # documents in a node that are compared without branching further
PIVOTS = 4         # pivots of a first node
VOTES = 3          # first nodes shared with a pivot before it is looked at
TRIED = 3          # pivots that a document is compared with in full
SALTED = 1_000     # documents that meet one copy of a pivot's set
BLOCK = 128        # documents of a node that are compared in one block with as many others
NEEDED_MAPS = 1_024  # bitmaps of 32,768 bits that tell which texts a join needs: 4 MB
_BATCH = 400_000   # shingles hashed at a time


def trees_for(percent: int) -> int:
    """Trees for a pair whose sets are ``percent`` similar: 12 for 80."""
    alike, reached = percent / 100, 1.0
    for _ in range(DEPTH - 1):      # a node has one child, or two with a probability of a quarter
        reached = 0.75 * alike * reached + 0.25 * (1 - (1 - alike * reached) ** 2)
    miss = 1 - alike * reached
    return 1 if miss <= MISSED else math.ceil(math.log(MISSED) / math.log(miss))


def misses_for(percent: int) -> int:
    """Differing sketch values beyond which a pair is not tried: four standard deviations above the mean."""
    differ = (1 - percent / 100) * 15 / 16
    return math.ceil(COORDINATES * differ + 4 * math.sqrt(COORDINATES * differ * (1 - differ)))


def _sketch(values: np.ndarray) -> np.ndarray:
    """Four bits of each minwise value, sixteen to a long."""
    nibbles = (values >> np.uint64(7)) & np.uint64(15)
    shifts = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.stack([(nibbles[:, k * 16:(k + 1) * 16] << shifts).sum(axis=1, dtype=np.uint64)
                     for k in range(LONGS)], axis=1).view(np.int64)


def _signatures(shingle: int, branched: int):
    def rows(ids: dict[str, pa.Array], sets: list[np.ndarray]) -> pa.RecordBatch:
        full = [i for i, s in enumerate(sets) if len(s)]
        prints, tokens, sketches = [None] * len(sets), [None] * len(sets), np.zeros((len(sets), LONGS), np.int64)
        if full:
            values = minwise([sets[i] for i in full], COORDINATES)
            short = ((values[:, :branched] >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
            sketches[full] = _sketch(values)
            for row, i in enumerate(full):
                prints[i], tokens[i] = fingerprint(sets[i]), short[row]
        return pa.RecordBatch.from_pydict({
            **ids, "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "print": pa.array(prints, pa.binary()), "tokens": pa.array(tokens, pa.list_(pa.int32())),
            **{f"s{k}": pa.array(sketches[:, k], pa.int64()) for k in range(LONGS)}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, sets, held = 0, [], 0
            for at, text in enumerate(batch.column("text")):
                sets.append(shingle_set(text.as_py(), shingle))
                held += len(sets[-1])
                if held > _BATCH or at + 1 == batch.num_rows:
                    yield rows({c: batch.column(c).slice(start, len(sets)) for c in ("doc_id", "version")}, sets)
                    start, sets, held = at + 1, [], 0
    return run


def _sets(shingle: int):
    """Rows ``(node, i, j, owner, doc_id, hashes)`` for each place that a set is needed at."""
    names = ["node", "i", "j", "owner", "doc_id", "hashes"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, held = [], 0
            for doc_id, text, places in zip(batch["doc_id"], batch["text"], batch["places"], strict=True):
                hashes = shingle_set(text, shingle).view(np.int64)
                for place in places:
                    out.append((place["node"], place["i"], place["j"], place["owner"], doc_id, hashes))
                    held += len(hashes)
                    if held > _BATCH:
                        yield pd.DataFrame(out, columns=names)
                        out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)
    return run


def _needed(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``texts`` without most of those that ``ids`` lacks, so that a join moves fewer of them.

    Ids are hashed to the bits of a broadcast map of fixed size. A text whose bit another
    id has set stays as well; once the ids fill the map, all texts stay.
    """
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(NEEDED_MAPS * 32_768))
    maps = ids.select((spot / 32_768).cast("int").alias("map"), F.pmod(spot, F.lit(32_768)).alias("bit")).groupBy("map").agg(
        F.bitmap_construct_agg("bit").alias("bits"))
    bit = F.pmod(spot, F.lit(32_768)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), F.pmod(bit, F.lit(8)) + 1))
    return (texts.join(F.broadcast(maps), (spot / 32_768).cast("int") == F.col("map"))
            .where(marked != 0).select(*texts.columns))


def _placed(texts: DataFrame, places: DataFrame, shingle: int) -> DataFrame:
    """The sets of documents, dealt by ``(node, i, j)``; each is made once and copied from there."""
    at = places.groupBy("doc_id", F.pmod(F.xxhash64("node", "i"), F.lit(64)).alias("slot")).agg(
        F.collect_list(F.struct("node", "i", "j", "owner")).alias("places"))
    return _needed(texts, places).join(at, "doc_id").select("doc_id", "text", "places").mapInPandas(
        _sets(shingle), "node long, i int, j int, owner long, doc_id long, hashes array<long>").repartition("node", "i", "j")


def _confirm(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, pivot_set = None, None
        for batch in batches:
            links = []
            for pivot, part, _, owner, doc_id, hashes in batch.itertuples(index=False):
                if owner:
                    at, pivot_set = (pivot, part), np.asarray(hashes)
                elif at == (pivot, part):
                    values = np.asarray(hashes)
                    common = len(np.intersect1d(values, pivot_set, assume_unique=True))
                    if 100 * common >= percent * (len(values) + len(pivot_set) - common):
                        links.append((doc_id, pivot))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return run


def _confirmed(texts: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of document and pivot whose full sets are similar enough.

    A pivot with many partners is copied per ``SALTED`` of them, so no task holds more than
    a stream of sets and one pivot.
    """
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("parts"))
    asked = pairs.join(sizes, "b").select(
        F.col("a").alias("doc_id"), F.col("b").alias("node"),
        F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("i"), F.lit(0).alias("j"), F.lit(0).alias("owner"))
    pivots = sizes.select(F.col("b").alias("doc_id"), F.col("b").alias("node"),
                          F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.lit(0).alias("j"), F.lit(1).alias("owner"))
    return (_placed(texts, asked.unionByName(pivots), shingle).sortWithinPartitions("node", "i", F.desc("owner"))
            .mapInPandas(_confirm(percent), "a long, b long"))


def links_between(owners: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the components ``owners``, as few as connect what is linked."""
    sizes = np.array([len(s) for s in sets])
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    row, common = np.repeat(np.arange(len(sets)), sizes), np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, len(tokens), 8192):
        part = slice(*np.searchsorted(column, [low, low + 8192]))
        held = np.zeros((len(sets), 8192), np.float32)
        held[row[part], column[part] - low] = 1
        common += held @ held.T
    alike = (100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)) & (owners[:, None] < owners[None, :])
    parent = {o: o for o in owners.tolist()}
    out = []
    for a, b in zip(*np.nonzero(alike), strict=True):
        ends = []
        for end in (int(owners[a]), int(owners[b])):
            while parent[end] != end:
                parent[end] = end = parent[parent[end]]
            ends.append(end)
        if ends[0] != ends[1]:
            parent[max(ends)] = min(ends)
            out.append((int(owners[a]), int(owners[b])))
    return out


def _compare(percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, owners, sets = None, [], []
        for batch in batches:
            links = []
            for node, i, j, owner, _, hashes in batch.itertuples(index=False):
                if (node, i, j) != at:
                    if len(sets) > 1:
                        links += links_between(np.array(owners), sets, percent)
                    at, owners, sets = (node, i, j), [], []
                owners.append(owner)
                sets.append(np.array(hashes))
            yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
        if len(sets) > 1:
            yield pd.DataFrame(links_between(np.array(owners), sets, percent), columns=["a", "b"], dtype="int64")
    return run


def _compared(texts: DataFrame, leaves: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components, from exhaustive comparison within each leaf.

    A large leaf is cut into blocks, and every block meets every other one.
    """
    sizes = leaves.groupBy("node").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    dealt = leaves.join(sizes, "node").select(
        "node", F.col("doc").alias("doc_id"), F.col("component").alias("owner"), own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    places = dealt.select("node", "doc_id", "owner", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return (_placed(texts, places, shingle).sortWithinPartitions("node", "i", "j")
            .mapInPandas(_compare(percent), "a long, b long"))


_SKETCH = [f"s{k}" for k in range(LONGS)]


def _misses(left: str, right: str) -> Column:
    """In how many of their values two sketches differ."""
    def misses(k: int) -> Column:
        x = F.col(f"{left}.s{k}").bitwiseXOR(F.col(f"{right}.s{k}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return reduce(Column.__add__, map(misses, range(LONGS)))


def _leaves(nodes: DataFrame, signatures: DataFrame) -> DataFrame | None:
    """Branch nodes ``(node, doc, component)`` until those with several components are small."""
    found, current = None, nodes
    for level in range(DEPTH):
        mixed = current.groupBy("node").agg(
            F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        mixed = mixed.where("low <> high").select("node", "n")
        rows = durable(current.join(mixed, "node"), "nodes")
        last = level == DEPTH - 1
        leaf = rows.where(F.lit(True) if last else F.col("n") <= SMALL).select("node", "doc", "component")
        found = leaf if found is None else found.unionByName(leaf)
        large = rows.where(F.col("n") > SMALL)
        if last or large.isEmpty():
            break
        def child(salt: int) -> Column:
            at = F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(BRANCHED)).cast("int")
            return F.xxhash64("node", at, F.element_at("tokens", at + 1))
        children = F.when(F.pmod(F.xxhash64("node", F.lit(-1)), F.lit(4)) == 0,
                          F.array_distinct(F.array(child(level), child(level + 100)))).otherwise(F.array(child(level)))
        current = durable(large.join(signatures.select("doc", "tokens"), "doc").select(
            F.explode(children).alias("node"), "doc", "component"), "nodes")
    return found


def _identified(texts: DataFrame, made: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """``(print, doc, first)`` with a number and the smallest ``doc_id`` of each distinct set, the
    texts by that number, and links between the sets that share a ``doc_id``.

    The number is that ``doc_id``. Where rows repeat a ``doc_id`` with
    other words, one of its sets keeps it and the others get numbers above all ids.
    """
    named = made.where("print is not null and doc_id is not null").select("doc_id", "print", "version")
    copies = durable(named.groupBy("print").agg(F.min("doc_id").alias("doc")), "copies")
    several = durable(named.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b"))
                      .where("a <> b").select(F.col("doc_id").alias("again")), "several")
    if several.isEmpty():
        return copies.withColumn("first", F.col("doc")), texts, None
    shared = copies.join(several, F.col("doc") == F.col("again"), "left_semi")
    keeping = shared.groupBy("doc").agg(F.min("print").alias("print"))
    highest = copies.agg(F.max("doc")).first()[0]
    extra = durable(shared.join(keeping, "print", "left_anti").select(
        "print", (F.lit(highest) + 1 + F.monotonically_increasing_id()).alias("other")), "numbered")
    numbered = durable(copies.join(extra, "print", "left").select(
        "print", F.coalesce("other", "doc").alias("doc"), F.col("doc").alias("first")), "copies")
    spelled = durable(named.join(several, F.col("doc_id") == F.col("again")).drop("again").distinct()
                      .join(numbered, "print"), "spelled")
    own = spelled.where("doc_id = first").select(F.col("doc_id").alias("again"), "version", "doc")
    renamed = texts.join(own, (F.col("doc_id") == F.col("again")) & (F.xxhash64("text") == F.col("version"))).select(
        F.col("doc").alias("doc_id"), "text")
    rest = texts.join(several, F.col("doc_id") == F.col("again"), "left_anti")
    return numbered, rest.unionByName(renamed), spelled.select(F.col("doc").alias("a"), F.col("doc_id").alias("b"))


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when 100 * common shingles >= ``percent`` * all shingles of both;
    ``percent`` is from 50 to 100. ``component_id`` is the smallest ``doc_id`` that links lead
    to; ``kept`` says that it is the document's own. Null and empty texts have no shingles and
    link with nothing. Rows without ``doc_id`` link with nothing, have no component and are kept.
    Rows with words that repeat a ``doc_id``, whatever their texts, share a component. Other
    columns are ignored.
    """
    if not LOWEST <= percent <= 100:
        raise ValueError(f"percent must be from {LOWEST} to 100")
    trees, most = trees_for(percent), misses_for(percent)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = durable(texts.withColumn("version", F.xxhash64("text")).mapInArrow(
        _signatures(shingle, max(BRANCHED, trees)), "doc_id long, version long, n_shingles long, print binary, tokens array<int>, "
        + ", ".join(f"{c} long" for c in _SKETCH)), "signatures")
    copies, texts, repeats = _identified(texts, made)
    signatures = durable(copies.join(made, (copies["print"] == made["print"]) & (copies["first"] == made["doc_id"]))
                         .select("doc", "tokens", *_SKETCH), "distinct").dropDuplicates(["doc"])
    first = F.array(*[F.xxhash64(F.lit(t), F.element_at("tokens", t + 1)) for t in range(trees)])
    nodes = signatures.select(F.explode(first).alias("node"), "doc")
    pivots = F.array_distinct(F.array(*[F.min_by("doc", F.xxhash64("doc", F.lit(k))) for k in range(PIVOTS)]))
    shared = nodes.groupBy("node").agg(F.count("*").alias("n"), pivots.alias("pivots")).where("n > 1")
    nodes = durable(nodes.join(shared, "node").select("node", "doc", "pivots"), "nodes")
    voted = (nodes.select("doc", F.explode("pivots").alias("pivot")).where("doc <> pivot")
             .groupBy("doc", "pivot").agg(F.count("*").alias("votes")).where(F.col("votes") >= VOTES))
    looks = (voted.join(signatures.drop("tokens").alias("a"), "doc")
             .join(signatures.drop("tokens").withColumnRenamed("doc", "pivot").alias("b"), "pivot")
             .select("doc", "pivot", _misses("a", "b").alias("misses")).where(F.col("misses") <= most))
    closest = Window.partitionBy("doc").orderBy("misses", "pivot")
    tried = looks.withColumn("rank", F.row_number().over(closest)).where(F.col("rank") <= TRIED)
    links = _confirmed(texts, durable(tried.select(F.col("doc").alias("a"), F.col("pivot").alias("b")), "pairs"),
                       shingle, percent)
    links = links if repeats is None else links.unionByName(repeats)
    groups = durable(connected_components(links), "groups")
    owned = nodes.drop("pivots").join(groups.withColumnRenamed("id", "doc"), "doc", "left").select(
        "node", "doc", F.coalesce("component", "doc").alias("component"))
    leaves = _leaves(owned, signatures)
    homes = leaves.groupBy("doc").agg(F.collect_set("node").alias("homes"))   # a few per tree
    leaves = leaves.join(homes, "doc").join(signatures.drop("tokens"), "doc")
    a, b = leaves.alias("a"), leaves.alias("b")
    # Documents that look alike to one of another component in the same leaf. Two that
    # share several leaves are compared in the first of them only.
    first = F.array_min(F.array_intersect("a.homes", "b.homes")) == F.col("a.node")
    alike = durable(a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.component") != F.col("b.component"))
                           & (_misses("a", "b") <= most) & first, "left_semi").select("node", "doc", "component"), "leaves")
    merged = durable(connected_components(_compared(texts, alike, shingle, percent)), "groups")
    copied = made.select("doc_id", "n_shingles", "print").join(copies.drop("first"), "print", "left")
    label = (copied.join(groups.withColumnRenamed("id", "doc"), "doc", "left")
             .withColumn("group", F.coalesce("component", "doc", "doc_id")).drop("component")
             .join(merged.withColumnRenamed("id", "group"), "group", "left")
             .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "group"))))
    return label.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
