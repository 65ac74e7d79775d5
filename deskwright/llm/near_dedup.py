"""Near-duplicates by a chosen-path set similarity join.

A document's set are its distinct shingles of five words. Documents with equal sets are one class,
which enters once. Every tree branches the classes: a class goes to the child named by its smallest
shingle under the hash of tree and level, so that two classes share a child with a chance equal to
their similarity. Small nodes are compared exhaustively. Larger nodes are branched further, and
their members compared with pivots of the node. Compared pairs are confirmed on the full sets.

After the trees an exact join finishes what they left: every class enters by its rarest shingles,
as many as any similar class must share one of (its prefix), and all classes of different
components that share one are compared unless their sizes and the places of the shingle rule
similarity out. Rarity is the number of documents that repeat a shingle, counted in buckets over all
shingles of all documents; another order would cost more comparisons and lose no pair. Large nodes
are compared block by block, so that none is one task's work. A family of k texts that are alike but
rarely similar costs up to k**2 comparisons here.

Trees come in rounds. After a round, linked classes are components, and later rounds look only at
pairs of different components, so that a large group of near copies costs its size and not its
square. Pairs are confirmed on the full sets if their 48 tokens agree as similar sets' would, which
similar sets' fail to with a chance below 1e-6. Nothing else is left to chance: trees and pivots only
save comparisons in the exact join.

Hot nodes and hot classes are counted by partial aggregation, and rows meet their counts in joins
that adaptive execution may split. Sets are read again only for classes that are compared.

Defined results: null texts and texts without words have an empty set and no links; a text of fewer
words than a shingle has one shingle; components take the smallest id, a null id only where there
is no other; rows that share an id are documents of their own; an empty table gives an empty result;
``keep_one_of_each`` keeps other columns whatever their names.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskwright.llm.arrow import map_columns
from deskwright.llm.common import stored
from deskwright.llm.components import stars

SHINGLE_WORDS = 5
TREES = 12
ROUNDS = (4, 8)  # trees of each round
LEVELS = 4
OUTSIDE = 12  # classes outside the largest component of a node that is compared exhaustively
PIVOTS = 2  # the member linked to most pivots, and the pivot linked to most members
FREQUENCY_BITS = 20  # the logarithm of the number of buckets in which shingles are counted
BLOCK = 64  # about the classes of a block of a node of the exact join
FILTER_BITS = 26  # the logarithm of the number of bits that mark shared tokens of prefixes
SMALLEST_ID = -(1 << 63)

SAME = ["class", "root", "links", "pivot_links"]

_random = np.random.default_rng(20240229)
_BYTE_VALUES = _random.integers(0, 1 << 64, 256, dtype=np.uint64)
_MULTIPLIERS = _random.integers(0, 1 << 64, TREES * LEVELS, dtype=np.uint64) | np.uint64(1)
_ADDENDS = _random.integers(0, 1 << 64, TREES * LEVELS, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    found = np.ones(1, np.uint64)
    while len(found) < n:
        step = np.uint64(pow(base, len(found), 1 << 64))
        found = np.concatenate([found, found * step])
    return found[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Hashed shingle sets of texts; tables of powers grow as texts need."""

    def __init__(self):
        self.powers = self.inverse = np.ones(1, np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct hashes of the shingles."""
        words = (text or "").encode().lower().split()  # ASCII letters and white space only
        if not words:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(b" ".join(words), np.uint8)
        if len(data) > len(self.powers):
            size = 1 << (len(data) - 1).bit_length()
            self.powers, self.inverse = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.powers[: len(data)], out=prefix[1:])
        gaps = np.flatnonzero(data == 0x20)
        starts = np.concatenate([[0], gaps + 1])
        ends = np.append(gaps, len(data))
        if len(words) >= SHINGLE_WORDS:
            starts, ends = starts[: 1 - SHINGLE_WORDS], ends[SHINGLE_WORDS - 1 :]
        else:
            starts, ends = starts[:1], ends[-1:]
        return np.unique(_mixed((prefix[ends] - prefix[starts]) * self.inverse[starts]))


def class_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def smallest(shingles: np.ndarray) -> np.ndarray:
    """The smallest shingle under each hash of tree and level, as 32 bits."""
    found = np.full(TREES * LEVELS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048, None]
        found = np.minimum(found, ((part + _ADDENDS) * _MULTIPLIERS).min(axis=0))
    return (found >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def frequencies(spark: SparkSession, docs: DataFrame) -> np.ndarray:
    """About how many documents repeat the shingles of each bucket.

    All shingles are counted that several documents of a batch have; the others are rare. Counts
    only order shingles, and the array has the same size for every input.
    """

    def make():
        shingles_of = Shingles()

        def work(columns):
            sets = [shingles_of(text) for text in columns["text"]]
            shingles, times = np.unique(np.concatenate(sets), return_counts=True)
            often = times > 1
            buckets, at = np.unique(_bucket(shingles[often]), return_inverse=True)
            return {"bucket": buckets, "times": np.bincount(at, times[often], len(buckets))}

        return work

    found = map_columns(docs.select("text"), make, "bucket int, times double", rows=4096)
    summed = found.groupBy("bucket").agg(F.sum("times").cast("long").alias("times")).toArrow()
    counts = np.zeros(1 << FREQUENCY_BITS, np.int32)
    most = np.iinfo(np.int32).max
    counts[summed.column("bucket").to_numpy()] = np.minimum(summed.column("times").to_numpy(), most)
    return counts


def prefix(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles as 32 bits, rarest first: two similar sets share one of them.

    Similar sets share ``percent`` of either, so one of any more than the rest is shared.
    """
    n = len(shingles)
    size = n - (percent * n + 99) // 100 + 1 if n else 0
    rarest = shingles[np.argsort(counts[_bucket(shingles)], kind="stable")[:size]]
    return (rarest * _MULTIPLIERS[-1] >> np.uint64(32)).astype(np.uint32).view(np.int32)


def sketch(spark: SparkSession, docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, class (null for an empty set), n_shingles, tokens and prefix."""
    shared = spark.sparkContext.broadcast(frequencies(spark, docs))

    def make():
        shingles_of, counts = Shingles(), shared.value

        def work(columns):
            sets = [shingles_of(t) for t in columns["text"]]
            tokens = np.concatenate([smallest(s) for s in sets])
            width = TREES * LEVELS
            return {
                "doc_id": columns["doc_id"],
                "text_hash": columns["text_hash"],
                "class": [class_of(s) if len(s) else None for s in sets],
                "n_shingles": [len(s) for s in sets],
                "tokens": pa.ListArray.from_arrays(
                    np.arange(0, len(tokens) + 1, width, dtype=np.int32), tokens
                ),
                "prefix": [prefix(s, counts, percent) for s in sets],
            }

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", _text_hash().alias("text_hash")
    )
    schema = (
        "doc_id long, text_hash long, class binary, n_shingles long, tokens array<int>, "
        "prefix array<int>"
    )
    sketches = stored(spark, map_columns(rows, make, schema), "near-sketches")
    shared.destroy()
    return sketches


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _paths(classes: DataFrame, trees: range) -> DataFrame:
    """class, root, links, path, tree and the tokens of all levels, for the first nodes of each tree."""
    tree = F.explode(F.lit(list(trees))).alias("tree")
    rows = classes.select(*SAME, "tokens", tree)
    rows = rows.select(*SAME, "tree", F.slice("tokens", F.col("tree") * LEVELS + 1, LEVELS).alias("own"))
    alone, last = F.lit(True).alias("alone"), F.lit(False).alias("last")
    return rows.select(*SAME, _path(0, 0).alias("path"), alone, last, "tree", "own")


def _path(first: int, last: int) -> Column:
    """The node of the tokens of levels ``first`` to ``last`` of a tree."""
    path = F.xxhash64("tree", F.lit(first), F.get("own", F.lit(first)))
    for level in range(first + 1, last + 1):
        path = F.xxhash64(path, F.get("own", F.lit(level)))
    return path


def _further_paths(rows: DataFrame) -> DataFrame:
    """The same columns for all nodes of further levels: each run of tokens of a tree is one."""
    runs = [(i, j) for j in range(1, LEVELS) for i in range(j + 1)]
    nodes = [
        F.struct(_path(i, j).alias("path"), F.lit(i < j == LEVELS - 1).alias("last")) for i, j in runs
    ]
    rows = rows.select(*SAME, "tree", "own", F.explode(F.array(*nodes)).alias("node"))
    return rows.select(*SAME, "node.path", F.lit(False).alias("alone"), "node.last")


def _nodes(frame: DataFrame) -> DataFrame:
    """path, its largest component, the number of classes outside that, and pivots.

    Nodes within one component have nothing to compare and are left out.
    """

    def order(links: str, seed: str) -> Column:
        return F.struct(-F.col(links), F.xxhash64("path", "class", F.lit(seed)), "class", "root")

    return (
        frame.groupBy("path", "root")
        .agg(
            F.count("*").alias("n"),
            F.min(order("links", "a")).alias("pivot"),
            F.min(order("pivot_links", "b")).alias("hub"),
        )
        .groupBy("path")
        .agg(
            F.sum("n").alias("n"),
            F.max(F.struct("n", "root")).alias("top"),
            F.min("pivot").alias("pivot"),
            F.min("hub").alias("hub"),
        )
        .select(
            "path",
            F.col("top.root").alias("inside"),
            (F.col("n") - F.col("top.n")).alias("n_out"),
            F.array(
                *[
                    F.struct(F.col(f"{p}.class").alias("class"), F.col(f"{p}.root").alias("root"))
                    for p in ("pivot", "hub")
                ]
            ).alias("pivots"),
        )
        .where(F.col("n_out") > 0)
    )


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _pivot_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b and pivot for members of large nodes and the pivots they are probably similar to."""
    tokens = classes.select("class", "tokens")
    pivots = (
        members.groupBy("path")
        .agg(F.first("pivots").alias("pivots"))
        .select("path", F.explode("pivots").alias("p"))
        .select("path", "p.class", "p.root")
        .join(tokens, "class")
        .groupBy("path")
        .agg(F.collect_set(F.struct("class", "root", "tokens")).alias("pivots"))
    )
    near = F.filter(
        "pivots",
        lambda p: (p["root"] != F.col("root")) & _alike(p["tokens"], F.col("tokens"), percent),
    )
    met = members.drop("pivots").join(tokens, "class").join(pivots, "path")
    met = met.select("class", F.explode(F.transform(near, lambda p: p["class"])).alias("pivot"))
    return met.select(*_pair("class", "pivot"), "pivot")


def candidates(spark: SparkSession, classes: DataFrame, trees: range, percent: int) -> DataFrame:
    """a, b of classes of different components that meet in a node, each once; the pivot if any.

    ``classes(class, root, links, pivot_links, tokens)``; root is the component so far. In a node
    with few classes outside its largest component these are compared with all members; any two
    members of different components are among such pairs. The members of other nodes of the first
    level branch, to the nodes of all runs of their tree's tokens at once: a run that starts later
    leaves out a token that may come from a passage which many texts share. In the large ones of the
    first nodes and of those that end with a tree's last token members also meet pivots if their
    tokens agree as similar sets would: the member that was linked to most earlier pivots and the
    earlier pivot that was linked to most members, since the centre of a group of near copies is
    similar to many that are not to each other.
    """
    frame = _paths(classes, trees)
    met = stored(spark, frame.join(_nodes(frame), "path"), "near-nodes")
    frame = _further_paths(met.where(F.col("n_out") > OUTSIDE))
    further = stored(spark, frame.join(_nodes(frame), "path"), "near-nodes")
    # Only first nodes, of a token alone, keep their tree.
    met = met.drop("own").unionByName(further, allowMissingColumns=True)
    few = met.where(F.col("n_out") <= OUTSIDE)
    outside = (
        few.where(F.col("root") != F.col("inside"))
        .groupBy("path")
        .agg(F.collect_list(F.struct("class", "root")).alias("outside"))
    )
    met_outside = few.join(outside, "path").select(
        "class", "root", "inside", F.explode("outside").alias("other")
    )
    once = (F.col("root") == F.col("inside")) | (F.col("class") < F.col("other.class"))
    apart = met_outside.where(once & (F.col("other.root") != F.col("root")))
    found = apart.select(*_pair("class", "other.class"), F.lit(None).cast("binary").alias("pivot"))
    many = met.where((F.col("n_out") > OUTSIDE) & (F.col("alone") | F.col("last")))
    found = found.unionByName(_pivot_pairs(many, classes, percent))
    pairs = found.groupBy("a", "b").agg(F.max("pivot").alias("pivot"))
    return stored(spark, pairs, "near-pairs")


def _shared_tokens(spark: SparkSession, classes: DataFrame) -> np.ndarray:
    """Bits, some of them set by chance, of the tokens that prefixes of several components hold."""
    halves = [
        F.conv(F.hex(F.substring("root", at, 8)), 16, -10).cast("long").alias(name)
        for name, at in (("upper", 1), ("lower", 9))
    ]
    tokens = classes.select("prefix", *halves).select(F.explode("prefix").alias("token"), "upper", "lower")
    shared = tokens.groupBy("token").agg(
        (F.min("upper") < F.max("upper")).alias("upper"), (F.min("lower") < F.max("lower")).alias("lower")
    )
    bit = F.col("token").cast("long").bitwiseAND((1 << FILTER_BITS) - 1)
    words = (
        shared.where("upper OR lower")
        .select(F.shiftright(bit, 6).cast("int").alias("word"), (bit % 64).cast("int").alias("at"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
        .toArrow()
    )
    marks = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    marks[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return marks


def _prefix_members(spark: SparkSession, classes: DataFrame) -> DataFrame:
    """class, root, path, place and n of classes and the tokens of their prefixes that others hold."""
    shared = spark.sparkContext.broadcast(_shared_tokens(spark, classes))

    def make():
        marks, mask = shared.value, (1 << FILTER_BITS) - 1

        def work(columns):
            tokens = [np.asarray(t, np.int64) for t in columns["prefix"]]
            held = [
                np.flatnonzero(marks[(t & mask) >> 6] >> (t & 63).astype(np.uint64) & np.uint64(1))
                for t in tokens
            ]
            return {
                "class": columns["class"],
                "root": columns["root"],
                "n": columns["n"],
                "places": held,
                "paths": [t[h] for t, h in zip(tokens, held)],
            }

        return work

    schema = "class binary, root binary, n int, places array<int>, paths array<int>"
    rows = map_columns(classes.select("class", "root", "n", "prefix"), make, schema)
    entry = F.explode(F.arrays_zip("paths", "places")).alias("entry")
    rows = rows.select("class", "root", "n", entry).select(
        "class", "root", "n", F.col("entry.paths").alias("path"), F.col("entry.places").alias("place")
    )
    members = stored(spark, rows, "near-members")
    shared.destroy()
    return members


def joined(spark: SparkSession, classes: DataFrame, percent: int) -> DataFrame:
    """a, b and pivot (null) of all classes of different components that may be similar.

    ``classes(class, root, n, prefix)``. Similar classes share a token of their prefixes, and what
    follows the first shared one is enough of both. Classes outside the largest component of a node
    meet all its members; both are dealt out to blocks, and every pair of blocks is a key.
    """
    members = _prefix_members(spark, classes)
    nodes = (
        members.groupBy("path", "root")
        .agg(F.count("*").alias("n"))
        .groupBy("path")
        .agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("top"))
        .select(
            "path",
            F.col("top.root").alias("inside"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("n_columns"),
            F.ceil((F.col("n") - F.col("top.n")) / BLOCK).cast("int").alias("n_rows"),
        )
        .where("n_rows > 0")
    )
    met = stored(spark, members.join(nodes, "path"), "near-nodes")
    dealt = F.xxhash64("class", "path")
    entry = F.struct("class", "root", "n", "place")
    row, column = F.pmod(dealt, "n_rows").cast("int"), F.pmod(dealt, "n_columns").cast("int")
    outside = met.where("root != inside").select(
        "path", row.alias("i"), F.explode(F.expr("sequence(0, n_columns - 1)")).alias("j"), entry.alias("x")
    )
    others = met.select(
        "path", F.explode(F.expr("sequence(0, n_rows - 1)")).alias("i"), column.alias("j"),
        (F.col("root") == F.col("inside")).alias("within"), entry.alias("y"),
    )
    once = F.col("within") | (F.col("x.class") < F.col("y.class"))
    least = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    enough = (100 + percent) * least >= percent * (F.col("x.n") + F.col("y.n"))
    apart = F.col("x.root") != F.col("y.root")
    pairs = outside.join(others, ["path", "i", "j"]).where(once & apart & enough)
    pairs = pairs.select(*_pair("x.class", "y.class")).distinct()
    return stored(spark, pairs.withColumn("pivot", F.lit(None).cast("binary")), "near-pairs")


def _alike(a: Column, b: Column, percent: int) -> Column:
    """Whether so many tokens agree as similar sets would, but for a chance below 1e-6."""
    agreeing = F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return agreeing * 100 >= TREES * LEVELS * (percent - 30)


def confirmed(
    spark: SparkSession, docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int
) -> DataFrame:
    """The pairs whose full sets are similar."""
    tokens = classes.select("class", "tokens")
    likely = (
        pairs.join(tokens.toDF("a", "ta"), "a")
        .join(tokens.toDF("b", "tb"), "b")
        .where(_alike(F.col("ta"), F.col("tb"), percent))
        .select("a", "b", "pivot")
    )
    likely = stored(spark, likely, "near-likely")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    wanted = wanted.join(classes.select("class", "holder"), "class")
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(SMALLEST_ID))
    texts = docs.select(key.alias("key"), _text_hash().alias("text_hash"), "text").join(
        wanted.select(
            "class",
            F.coalesce("holder.doc_id", F.lit(SMALLEST_ID)).alias("key"),
            F.col("holder.text_hash").alias("text_hash"),
        ),
        ["key", "text_hash"],
    )

    def make():
        shingles_of = Shingles()

        def work(columns):
            sets = [shingles_of(t) for t in columns["text"]]
            return {
                "class": columns["class"],
                "own": [class_of(s) for s in sets],
                "shingles": [s.view(np.int64) for s in sets],
            }

        return work

    # Rows that repeat a class's holder have the same set; one of each class is wanted.
    sets = (
        map_columns(
            texts.select("class", "text"), make, "class binary, own binary, shingles array<long>"
        )
        .where("class = own")
        .select("class", "shingles")
        .dropDuplicates(["class"])
    )
    sets = stored(spark, sets, "near-sets")
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        likely.join(sets.toDF("a", "sa"), "a")
        .join(sets.toDF("b", "sb"), "b")
        .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
        .select("a", "b", "pivot")
    )


def document_components(spark: SparkSession, docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id of every document."""
    sketches = sketch(spark, docs, percent)
    classes = stored(
        spark,
        sketches.where(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("min_doc"),
            F.min(F.struct("doc_id", "text_hash")).alias("holder"),
            F.first("tokens").alias("tokens"),
            F.first("prefix").alias("prefix"),
            F.first("n_shingles").cast("int").alias("n"),
        ),
        "near-classes",
    )
    none = F.lit(0).cast("long")
    known = classes.withColumns({"root": F.col("class"), "links": none, "pivot_links": none})
    found, start = None, 0
    for trees in (*ROUNDS, 0):
        exact = trees == 0
        if exact:
            pairs = joined(spark, known, percent)
        else:
            pairs = candidates(spark, known, range(start, start + trees), percent)
        links = stored(spark, confirmed(spark, docs, classes, pairs, percent), "near-links")
        edges = links.select("a", "b")
        edges = edges if found is None else found.unionByName(edges)
        # Between rounds a few steps do: an unfinished component costs comparisons, not links.
        if exact or found is None or not links.isEmpty():
            found = stars(spark, edges, None if exact else 2)
        roots = classes.join(found.toDF("class", "root"), "class", "left").withColumn(
            "root", F.coalesce("root", "class")
        )
        start += trees
        if start == TREES and not exact:
            known = stored(spark, roots.select("class", "root", "n", "prefix"), "near-known")
        elif not exact:
            is_pivot = F.col("class").eqNullSafe(F.col("pivot"))
            ends = links.select(F.explode(F.array("a", "b")).alias("class"), "pivot")
            degree = ends.groupBy("class").agg(
                F.count_if(~is_pivot).alias("links"), F.count_if(is_pivot).alias("pivot_links")
            )
            known = roots.drop("n", "prefix").join(degree, "class", "left").na.fill(0, ["links", "pivot_links"])
            known = stored(spark, known, "near-known")
    placed = stored(spark, roots.select("class", "min_doc", "root"), "near-roots")
    least = placed.groupBy("root").agg(F.min("min_doc").alias("component_id"))
    placed = stored(spark, placed.join(least, "root").select("class", "component_id"), "near-found")
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return sketches.join(placed, "class", "left").select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"), "class"
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document of ``docs(doc_id, text)``."""
    return document_components(spark, docs, percent).select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def keep_one_of_each(spark: SparkSession, docs: DataFrame, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` that are the first of their component, with their columns.

    Of texts that share the component's smallest id, that of the smallest hash stays. Rows equal
    in id and text are one document and stay or go together. Documents without words stay.
    """
    found = document_components(spark, docs, percent).where(F.col("class").isNotNull())
    found = stored(spark, found.select("doc_id", "text_hash", "component_id"), "near-members")
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rivals = found.where(own).groupBy("component_id").agg(
        F.min("text_hash").alias("first"), F.max("text_hash").alias("last")
    )
    rivals = rivals.where("first != last").select("component_id", "first")
    beaten = found.where(own).join(rivals, "component_id").where("text_hash != first")
    lost = found.where(~own).select("doc_id", "text_hash").unionByName(
        beaten.select("doc_id", "text_hash")
    )
    lost = stored(spark, lost.distinct(), "near-lost").toDF("lost_id", "lost_hash")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        _text_hash().alias("own_hash"),
    )
    same = F.col("own_id").eqNullSafe(F.col("lost_id")) & (F.col("own_hash") == F.col("lost_hash"))
    kept = rows.join(lost, same, "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
