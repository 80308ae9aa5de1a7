"""Near-duplicate groups by SuperMinHash, banding, verification and union-find.

1. Every text becomes the set of its word shingles. Equal sets form a class, a node of the graph;
   only its least doc_id goes on. A SuperMinHash signature of the set gives as many band keys as ``bands`` says.
2. Classes that share a band key are a bucket. A class can be near another one only if
   most of its shingles occur in other bucketed classes, too; the count of those that do
   not settles classes without a partner, and bounds what two classes can share.
3. In every bucket the class that shares most is compared with the others on full sets, and
   links are united. Pairs inside a component need no comparison, so a large group of copies
   costs about one comparison a member.
4. What is left are classes of buckets that hold several components. Among them, exact prefix
   filtering finds all pairs of different components that can be similar: only those that
   share one of their rarest shingles, at places that let them share enough.

Banding misses a pair at the similarity asked for with a probability below ``MISS``, one in a million.

Rows that repeat a doc_id are judged each by its own text, so a doc_id with two texts may be in two
components and links nothing through itself; as a stage, a doc_id goes only if
none of its rows is kept. A row without doc_id links with nothing, has no component and stays. Texts that are null or without words have
an empty set and link with nothing. Extra columns are not touched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.components import components
from tidewater.llm.superminhash import signature, slot_keys
from tidewater.llm.tables import keep
from tidewater.llm.text import WordCodes, shingle_codes, small_batches, utf8

# Slots of a band, and the probability that a pair at the threshold shares no band.
BAND_SLOTS, MISS = 5, 1e-6


def bands(percent: int) -> int:
    """Bands that keep the probability of a miss at ``percent`` below ``MISS``: 24 at 85, 35 at 80."""
    shared = (percent / 100) ** BAND_SLOTS
    return 1 if shared >= 1 else math.floor(math.log(MISS) / math.log1p(-shared)) + 1


def _sets(batch: pa.RecordBatch, codes: WordCodes, width: int) -> list[np.ndarray]:
    return [np.unique(shingle_codes(codes.of(t), width)) for t in utf8(batch.column("text"))]


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """128-bit digests of sets as pairs of bigints."""
    halves = [[int.from_bytes(xxhash.xxh3_128_digest(s.tobytes())[i : i + 8]) for i in (0, 8)] for s in sets]
    return np.array(halves, np.uint64).reshape(-1, 2).view(np.int64)


def sketch(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``(doc_id, n, high, low, bands)``: set size, 128-bit digest of the set, band keys."""
    slots = bands(percent) * BAND_SLOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in small_batches(batches):
            sets = _sets(batch, codes, width)
            digests = _digests(sets)
            keys = [slot_keys(signature(s, slots), BAND_SLOTS) if len(s) else s.view(np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    *(pa.array(digests[:, i]) for i in (0, 1)),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "high", "low", "bands"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, high bigint, low bigint, bands array<bigint>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)``: the full set of every class, from the rows ``(node, high, low, text)`` of which some have its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in small_batches(batches):
            sets = _sets(batch, codes, width)
            digests, wanted = _digests(sets), zip(*(batch.column(c).to_pylist() for c in ("high", "low")))
            own = np.array([tuple(d) == w for d, w in zip(digests.tolist(), wanted)], bool)
            mine = pa.array([s.view(np.int64) for s, o in zip(sets, own) if o], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("node").filter(pa.array(own)), mine], ["node", "shingles"])

    return docs.select("node", "high", "low", "text").mapInArrow(run, "node bigint, shingles array<bigint>")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - shared
    return pairs.join(left, "a").join(right, "b").where(100 * shared >= percent * union).select("a", "b")


def _possible(shared_a, shared_b, n_a, n_b, percent: int):
    """Whether two sets can be similar, from their sizes and what others hold of them.

    With intersection s and union n_a + n_b - s, 100 s >= percent (n_a + n_b - s).
    """
    need = percent * (n_a + n_b)
    return (F.least(shared_a, shared_b) * (100 + percent) >= need) & (F.least(n_a, n_b) * 100 >= percent * F.greatest(n_a, n_b))


def _members(rows: DataFrame) -> DataFrame:
    """Rows ``(key, node, …)`` of keys that several classes share."""
    shared = keep(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"))
    return rows.join(shared, "key")


def link_classes(docs: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """``(node, root)`` of the classes ``(node, doc_id, high, low, n, bands)`` that are linked with others."""
    members = keep(_members(classes.select(F.explode("bands").alias("key"), "node", "n").distinct()))
    near = keep(members.select("node", "n").distinct())
    texts = classes.join(near.select("node"), "node", "left_semi").select("doc_id", "node", "high", "low").distinct()
    sets = keep(shingle_sets(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(texts, "doc_id"), width))
    alone = (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("holders"), F.min("node").alias("node"))
        .where("holders = 1")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )
    bounded = near.join(alone, "node", "left").withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
    bounded = keep(bounded.where(100 * F.col("shared") >= percent * F.col("n")).select("node", "shared"))
    members = keep(_members(members.join(bounded, "node").select("key", "node", "n", "shared")))

    # First the best shared class of every bucket against all others of it.
    hub = F.min(F.struct((F.col("n") - F.col("shared")).alias("alone"), "node", "n", "shared")).alias("hub")
    hubs = members.groupBy("key").agg(hub).select("key", "hub.*").toDF("key", "alone", "hub", "hub_n", "hub_shared")
    pairs = (
        members.join(keep(hubs.drop("alone")), "key")
        .where(F.col("node") != F.col("hub"))
        .where(_possible(F.col("shared"), F.col("hub_shared"), F.col("n"), F.col("hub_n"), percent))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )
    links = keep(_links(keep(pairs), sets, percent))
    roots = components(links)

    # Then what is left in buckets of several components.
    at = members.join(roots.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    split = keep(at.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key"))
    left = keep(at.join(split, "key").select("node", "n", "root").distinct())
    found = keep(_links(keep(_prefix_pairs(left, sets, percent)), sets, percent))
    return roots if found.isEmpty() else components(links.unionAll(found))


def _prefix_pairs(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs ``(a, b)`` of different roots that can be similar, by prefix filtering.

    The shingles of each class ``(node, n, root)`` are ordered from rare to frequent. Two
    similar sets share a shingle early in both orders, and before their first common one
    neither has any of the other's; so its places bound what they share.
    """
    tokens = sets.join(classes.select("node"), "node").select("node", F.explode("shingles").alias("shingle")).distinct()
    common = keep(tokens.groupBy("shingle").agg(F.count("*").alias("holders")).where("holders > 1"))
    held = tokens.join(common, "shingle")
    own = Window.partitionBy("node")
    placed = held.select(
        "node", "shingle", F.row_number().over(own.orderBy("holders", "shingle")).alias("rank"), F.count("*").over(own).alias("shared")
    )
    # Shingles that no other class holds come first.
    placed = placed.join(classes, "node").withColumn("rest", F.col("shared") - F.col("rank") + 1).drop("rank", "shared")
    prefix = keep(placed.where(100 * F.col("rest") >= percent * F.col("n")))
    one, two = (prefix.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "n", "root", "rest"))) for side in "ab")
    return (
        one.join(two, "shingle")
        .where("node_a < node_b and root_a <> root_b")
        .where(_possible(F.col("rest_a"), F.col("rest_b"), F.col("n_a"), F.col("n_b"), percent))
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
        .distinct()
    )


def _named(classes: DataFrame) -> DataFrame:
    """Add ``node``, different for every class: its least doc_id, or a negative number where several texts have that."""
    repeated = classes.groupBy("class_id").agg(F.count("*").alias("texts")).where("texts > 1")
    other = F.xxhash64("high", "low").bitwiseOR(F.lit(-(1 << 63)))
    node = F.when(F.col("texts").isNull(), F.col("class_id")).otherwise(other)
    return classes.join(repeated, "class_id", "left").withColumn("node", node).drop("texts")


def groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` of every row; one document of each group is kept."""
    rows = keep(sketch(docs, width, percent))
    usable = rows.where("doc_id is not null and n > 0")
    classes = keep(_named(keep(usable.groupBy("high", "low", "n").agg(F.min("doc_id").alias("class_id")))))
    firsts = usable.withColumnRenamed("doc_id", "class_id").join(classes, ["class_id", "high", "low", "n"])
    firsts = firsts.select("node", F.col("class_id").alias("doc_id"), "high", "low", "n", "bands")
    roots = keep(link_classes(docs, firsts, width, percent))
    # A root is a doc_id unless texts that share an id are in its component, which is rare.
    renamed = keep(roots.join(classes.where("node <> class_id").select("node"), "node", "left_semi").select("root").distinct())
    if not renamed.isEmpty():
        least = roots.join(renamed, "root").join(classes, "node").groupBy("root").agg(F.min("class_id").alias("least"))
        roots = roots.join(least, "root", "left").select("node", F.coalesce("least", "root").alias("root"))
    named = keep(classes.join(roots, "node", "left").select("high", "low", F.coalesce("root", "class_id").alias("component_id")))
    slim = rows.select("doc_id", "n", "high", "low")
    found = slim.where("doc_id is not null and n > 0").join(named, ["high", "low"])
    rest = slim.where("doc_id is null or n = 0").withColumn("component_id", F.col("doc_id"))
    out = found.select("doc_id", "n", "component_id").unionAll(rest.select("doc_id", "n", "component_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, less those whose document is not the first of its group."""
    rows = groups(docs, width, percent).where("doc_id is not null")
    gone = keep(rows.groupBy(F.col("doc_id").alias("_gone")).agg(F.max("kept").alias("kept")).where("not kept").select("_gone"))
    return docs.join(gone, docs["doc_id"].cast("bigint") == gone["_gone"], "left_anti")
