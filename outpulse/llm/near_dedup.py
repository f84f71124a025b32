"""Near duplicates by DartMinHash signatures, banded joining and an exact check of each link.

Texts are sets of five-word shingles.  Texts with equal words are one node, and
only nodes are compared, so copies are never paired with each other.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outpulse.llm.common import by_batch, by_task, saved, texts, words
from outpulse.llm.fingerprint import mixed

SHINGLE = 5
ALIKE = 0.8
BANDS, ROWS = 27, 7  # two texts at 0.8 share a band with odds of 0.998; at 0.6 with 0.53, at 0.4 with 0.04
COORDINATES = BANDS * ROWS
WORDS = 12  # 64-bit words of a set's parities
BLOCK, BLOCK_SHINGLES = 256, 1 << 18  # nodes, and shingles of their sets, that travel together
LEADERS = 4  # nodes of each bucket that its members are first linked to
TASK_ROWS = 20_000  # narrow rows that one task may well write
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: Chances of at most 0, 1, 2, ... darts in a region of measure one.
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 16)]))


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Shingler:
    """Distinct 64-bit hashes of a text's shingles; fewer words than SHINGLE are one shingle."""

    def __init__(self, entries: int = 400_000):
        self.entries, self.at, self.hashes = entries, {}, np.zeros(1 << 12, np.uint64)

    def set_of(self, found: list[str]) -> np.ndarray:
        if not found:
            return np.zeros(0, np.uint64)
        if len(self.at) > self.entries:
            self.__init__(self.entries)
        at = self.at
        for w in set(found):
            if w not in at:
                if len(at) == len(self.hashes):
                    self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
                self.hashes[len(at)] = xxhash.xxh64_intdigest(w)
                at[w] = len(at)
        w = self.hashes[np.array([at[x] for x in found], np.int64)]
        width = min(SHINGLE, len(w))
        n = len(w) - width + 1
        total = np.zeros(n, np.uint64)
        for j in range(width):
            total = mixed(total + w[j : j + n])
        return np.unique(total)


def signature(elements: np.ndarray, weights: np.ndarray | None = None, k: int = COORDINATES) -> np.ndarray:
    """The earliest dart of each coordinate, as its hash.

    Darts fall on (weight, time) with density one for every element.  The plane
    is cut into regions of measure one, a unit of weight by a unit of time, and
    a region's darts depend on element and region alone; so two weighted sets
    share the darts under both weights, and agree in a coordinate with the odds
    of their weighted Jaccard likeness.  About k ln k + 2k darts in all fill
    every coordinate; if one stays empty, twice the time is played.
    """
    if not len(elements):
        return np.zeros(k, np.uint64)
    w = np.ones(len(elements)) if weights is None else weights
    whole = np.ceil(w).astype(np.int64)
    column = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
    element, weight = np.repeat(elements, whole), np.repeat(w, whole)
    until = (k * np.log(max(k, 2)) + 2 * k) / w.sum()
    while True:
        times = int(np.ceil(until))
        region = mixed(np.repeat(mixed(element + column.astype(np.uint64) * A), times) + np.tile(np.arange(times, dtype=np.uint64), len(element)) * B)
        count = np.searchsorted(POISSON, unit(mixed(region ^ C)))
        dart = np.repeat(region, count)
        nth = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
        dart = mixed(dart + (nth + 1).astype(np.uint64) * C)
        time = np.repeat(np.tile(np.arange(times), len(element)), count) + unit(mixed(dart ^ A))
        hit = time <= until
        if weights is not None:
            hit &= np.repeat(np.repeat(column, times), count) + unit(mixed(dart ^ B)) < np.repeat(np.repeat(weight, times), count)
        dart, time = dart[hit], time[hit]
        at = (dart % np.uint64(k)).astype(np.int64)
        order = np.argsort(time)[::-1]
        out, filled = np.zeros(k, np.uint64), np.zeros(k, bool)
        out[at[order]], filled[at[order]] = dart[order], True  # the last to be put, the earliest, stays
        if filled.all():
            return out
        until *= 2


def bands(sig: np.ndarray) -> np.ndarray:
    out = np.arange(BANDS, dtype=np.uint64) * A
    for column in sig.reshape(BANDS, ROWS).T:
        out = mixed(out + column)
    return out


def short(elements: np.ndarray) -> np.ndarray:
    """The distinct 32-bit hashes that links are decided by."""
    return np.unique((elements >> np.uint64(32)).astype(np.uint32))


def parities(elements: np.ndarray) -> np.ndarray:
    """Parity of the number of elements in each of 64 * WORDS cells.

    Elements that two sets share cancel, so no more cells differ than elements do.
    """
    odd = np.bincount(elements % np.uint32(64 * WORDS), minlength=64 * WORDS).astype(np.uint8) & 1
    return np.packbits(odd).view(np.uint64)


_SHINGLER = Shingler()


def node_of(found: list[str]) -> int:
    """63 bits that stand for a text's words."""
    return xxhash.xxh3_64_intdigest(" ".join(found)) >> 1


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``node``, ``bands``, ``bits`` (parities and size of the set) of every whole text; a text without words has no bands."""

    def work(batch):
        out = {"node": [], "bands": [], "bits": []}
        for text in batch.column("text").to_pylist():
            found = words(text)
            elements = _SHINGLER.set_of(found)
            held = short(elements)
            out["node"].append(node_of(found))
            out["bands"].append(bands(signature(elements)).view(np.int64) if found else [])
            out["bits"].append(np.append(parities(held).view(np.int64), len(held)))
        return {"doc_id": batch.column("doc_id")} | out

    return by_batch(texts(docs), "doc_id long, node long, bands array<long>, bits array<long>", work)


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and its shingles (32 bits each) for the nodes and representative ids of ``wanted``."""
    chosen = texts(docs).join(wanted.select("node", F.col("rep").alias("doc_id")), "doc_id")

    def work(batch):
        out = {"node": [], "set": []}
        for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
            found = words(text)
            if node_of(found) == node:  # another row may have the same id
                out["node"].append(node)
                out["set"].append(short(_SHINGLER.set_of(found)).view(np.int32))
        return out

    return by_batch(chosen, "node long, set array<int>", work).dropDuplicates(["node"])


def saved_narrow(df: DataFrame, rows: int) -> DataFrame:
    """``saved`` in no more files than about ``rows`` narrow rows need; the next shuffle then has as few map tasks."""
    return saved(df.coalesce(max(1, -(-rows // TASK_ROWS))))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the least node it is connected with, for all nodes with an edge but the least ones.

    Large and small stars in turn until nothing changes: each round only joins
    edges with minima, so a node with a third of all edges is met by partial
    sums and split joins.  No round makes more edges than it was given, so their
    number says how many files they need.
    """
    e = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    told = None
    while True:
        state = e.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if state == told or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        told = state
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = saved_narrow(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), state[0])
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved_narrow(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), state[0])


def component_of(frame: DataFrame, comps: DataFrame, node: str, out: str) -> DataFrame:
    """``frame`` with the component ``out`` of its column ``node``; a node that ``comps`` lacks is its own."""
    found = comps.select(F.col("node").alias(node), F.col("comp").alias(out))
    return frame.join(found, node, "left").withColumn(out, F.coalesce(out, node))


def further_components(comps: DataFrame, linked: DataFrame) -> DataFrame:
    """``comps`` after the links (a, b) besides: only components are met, a component being its least node."""
    ends = component_of(component_of(linked, comps, "a", "p"), comps, "b", "q")
    more = components(ends.select(F.col("p").alias("a"), F.col("q").alias("b")))
    return component_of(comps, more, "comp", "now").select("node", F.col("now").alias("comp")).unionByName(more)


def close(x: str, y: str) -> Column:
    """Whether sets may have a likeness of ALIKE: a bound that no such pair fails.

    Sets at ALIKE differ in at most (1 - ALIKE) / (1 + ALIKE) of the sum of
    their sizes, and in at least as many elements as parities or sizes differ by.
    """
    at = lambda c, i: F.get(F.col(c), F.lit(i))
    differ = reduce(Column.__add__, [F.bit_count(at(x, i).bitwiseXOR(at(y, i))) for i in range(WORDS)])
    least = F.greatest(differ.cast("long"), F.abs(at(x, WORDS) - at(y, WORDS)))
    return (10 + int(10 * ALIKE)) * least <= (10 - int(10 * ALIKE)) * (at(x, WORDS) + at(y, WORDS))


def blocks_of(held: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``block``: nodes that share buckets, at most some BLOCK of them and BLOCK_SHINGLES shingles.

    Nodes take the least label of their buckets a few times, so that a family of
    texts has few labels; a label with many nodes is cut by a hash of the node,
    labels with few nodes share blocks.  Blocks only decide what travels
    together, never what is compared.
    """
    labels = held.groupBy("node").agg(F.min("first").alias("label"))
    for _ in range(2):
        least = held.select("node", "band").join(labels, "node").groupBy("band").agg(F.min("label").alias("label"))
        labels = held.select("node", "band").join(least, "band").groupBy("node").agg(F.min("label").alias("label"))
    labels = saved_narrow(labels.join(nodes.select("node", F.get("bits", F.lit(WORDS)).alias("size")), "node"), nodes.count())
    pool = max(1, labels.count() // BLOCK)
    parts = labels.groupBy("label").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).alias("parts"))
    cut = F.xxhash64("label", F.pmod(F.xxhash64("node"), F.col("parts")))
    return labels.join(parts, "label").select("node", F.when(F.col("parts") > 1, cut).otherwise(F.pmod(F.xxhash64("label"), F.lit(pool))).alias("block"))


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are alike by exact Jaccard; ``a_block`` and ``b_block`` say in which blocks they are.

    All pairs between two blocks are met in one place, to which every set they
    need is sent once: what travels follows nodes times blocks and not pairs.
    """
    pairs = pairs.select("a", "b", F.xxhash64(F.least("a_block", "b_block"), F.greatest("a_block", "b_block")).alias("place"))
    needed = pairs.select("place", F.explode(F.array("a", "b")).alias("node")).distinct().join(sets, "node")
    none = lambda kind: F.lit(None).cast(kind)
    rows = needed.select("place", F.lit(0).alias("kind"), F.col("node").alias("a"), none("long").alias("b"), "set")
    rows = rows.unionByName(pairs.select("place", F.lit(1).alias("kind"), "a", "b", none("array<int>").alias("set")))

    def alike(held: dict, wanted: list):
        """Numbers of shared shingles of one set with many at a time, by marks on the shingles of the place."""
        at = {node: i for i, node in enumerate(held)}
        size = np.array([len(x) for x in held.values()])
        ends = np.cumsum(size)
        codes = np.unique(np.concatenate(list(held.values())), return_inverse=True)[1] if held else np.zeros(0, np.int64)
        mark = np.zeros(codes.max(initial=-1) + 1, bool)
        by_first = {}
        for a, b in wanted:
            if a in at and b in at:  # a set may be missing where an id has several texts
                by_first.setdefault(at[a], []).append(at[b])
        names = list(held)
        for a, others in by_first.items():
            own = codes[ends[a] - size[a] : ends[a]]
            mark[own] = True
            shared = np.array([np.count_nonzero(mark[codes[ends[b] - size[b] : ends[b]]]) for b in others])
            mark[own] = False
            for i in np.flatnonzero(10 * shared >= int(10 * ALIKE) * (size[a] + size[others] - shared)):
                yield names[a], names[others[i]]

    def work(batches):
        place, held, wanted = None, {}, []

        def found():
            pairs = list(alike(held, wanted))
            return {"a": [a for a, _ in pairs], "b": [b for _, b in pairs]}

        for batch in batches:
            for p, kind, a, b, one in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "a", "b")), batch.column("set")):
                if p != place:
                    if wanted:
                        yield found()
                    place, held, wanted = p, {}, []
                if kind:
                    wanted.append((a, b))
                else:
                    held[a] = one.values.to_numpy(zero_copy_only=False)
        if wanted:
            yield found()

    return by_task(rows.repartition("place").sortWithinPartitions("place", "kind"), "a long, b long", work)


def node_classes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node`` and ``comp`` of the nodes linked to a lesser one.

    Each band's bucket links its members to a few of its nodes (the least, and
    the least by other orders), not to each other.  A member whose component is not that of the bucket's
    least node afterwards is compared with the whole bucket, other components
    only and in the first bucket that two nodes share; a large bucket is met in
    parts.  What is not compared exactly is ruled out by ``close``, which no link
    fails, so a link is lost only where two texts at ALIKE share no band.
    """
    rows = nodes.where("rep IS NOT NULL").select("node", F.posexplode("bands").alias("i", "band"))
    buckets = rows.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n"), F.array(*[F.min_by("node", F.xxhash64("node", F.lit(k))) for k in range(1, LEADERS)]).alias("others")).where("n > 1")
    held = saved(rows.join(buckets, "band"))
    count = nodes.count()
    near = saved_narrow(nodes.select("node", "bits").join(blocks_of(held, nodes), "node"), count)
    star = held.select("node", F.explode(F.array_distinct(F.concat(F.array("first"), "others"))).alias("leader")).where("node <> leader").groupBy("node", "leader").agg(F.count("*").alias("shared"))
    star = star.join(near.select("node", F.col("bits").alias("x"), F.col("block").alias("a_block")), "node")
    star = star.join(near.select(F.col("node").alias("leader"), F.col("bits").alias("y"), F.col("block").alias("b_block")), "leader")
    star = saved(star.where(close("x", "y")).select(F.col("node").alias("a"), F.col("leader").alias("b"), "shared", "a_block", "b_block"))
    wanted = held.select("node").distinct().join(nodes.select("node", "rep"), "node")
    sets = saved(shingle_sets(docs, wanted))

    best = star.groupBy("a").agg(F.max_by(F.struct("b", "a_block", "b_block"), F.struct("shared", "b")).alias("x")).select("a", "x.*")
    comps = components(links(best, sets))
    rest = component_of(component_of(star.join(best.select("a", "b"), ["a", "b"], "left_anti"), comps, "a", "p"), comps, "b", "q").where("p <> q")
    comps = saved_narrow(further_components(comps, links(rest, sets)), count)

    placed = saved(component_of(component_of(held.drop("others"), comps, "node", "comp"), comps, "first", "main").select("i", "band", "node", "comp", "n", (F.col("comp") != F.col("main")).alias("apart")))
    mixed_buckets = placed.where("apart").select("band").distinct()
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = placed.join(mixed_buckets, "band", "left_semi").join(near, "node").join(nodes.select("node", "bands"), "node").withColumn("parts", parts)
    r = placed.where("apart").select("band", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"), "i", F.col("node").alias("a"), F.col("comp").alias("p"), F.col("bits").alias("x"), F.col("bands").alias("xb"), F.col("block").alias("a_block"))
    t = placed.select(F.col("band").alias("band_"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part_"), F.col("node").alias("b"), F.col("comp").alias("q"), F.col("bits").alias("y"), F.col("bands").alias("yb"), F.col("apart").alias("also"), F.col("block").alias("b_block"))
    earliest = F.array_position(F.zip_with("xb", "yb", lambda m, n: m == n), True) == F.col("i") + 1
    same = (F.col("band") == F.col("band_")) & (F.col("part") == F.col("part_"))
    cross = r.join(t, same & (F.col("p") != F.col("q")) & (~F.col("also") | (F.col("a") < F.col("b"))) & close("x", "y") & earliest)
    return further_components(comps, links(cross.select("a", "b", "a_block", "b_block"), sets))


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``class_id`` (the least id of the class), ``class_size`` per row.

    A class is what links of likeness 0.8 or more connect.  Texts with equal
    words, empty and null ones among them, are one class.  A null id belongs to
    the class of equal words, and has no near links of its own; repeated rows
    each count; an empty table gives no row; other columns are ignored.
    """
    all_rows, of_node = classified(docs)
    return all_rows.join(of_node.select("node", "class_id", "class_size"), "node").select("doc_id", "class_id", "class_size")


def classified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``node`` of every row; and per node its least id ``rep``, ``comp``, ``class_id``, ``class_size``."""
    all_rows = saved(signed(docs))
    nodes = saved(all_rows.groupBy("node").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("bits").alias("bits"), F.count("*").alias("n")))
    comps = node_classes(docs, nodes)
    of_node = nodes.select("node", "rep", "n").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    totals = of_node.groupBy("comp").agg(F.min("rep").alias("class_id"), F.sum("n").alias("class_size"))
    return all_rows.select("doc_id", "node"), of_node.join(totals, "comp").select("node", "rep", "comp", "class_id", "class_size")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` of every class: of its least id, the least node and the least text.

    Classes of texts without id keep a row each, and different texts that share
    an id are decided by their own classes.
    """
    all_rows, of_node = classified(docs)
    best = of_node.where(F.col("rep").eqNullSafe(F.col("class_id"))).groupBy("comp").agg(F.min_by(F.struct("rep", "node"), "node").alias("k")).select("k.*")
    times = all_rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    kept = saved(best.join(times, F.col("rep").eqNullSafe(F.col("doc_id"))).select("rep", "node", "n"))
    doc_id = F.col("doc_id").cast("long")
    once = docs.join(kept.where("n = 1").select(F.col("rep").alias("_kept")), doc_id.eqNullSafe(F.col("_kept")), "left_semi")
    several = kept.where("n > 1").select("rep", "node")
    if not several.limit(1).count():
        return once

    def work(batch):
        return {"node": [node_of(words(t)) for t in batch.column("text").to_pylist()], "text": batch.column("text")}

    # texts of these ids with their nodes, then the least text of each wanted pair
    ids = several.select("rep").distinct()
    found = texts(docs).join(ids, F.col("doc_id").eqNullSafe(F.col("rep")), "left_semi").select("doc_id", "text").distinct()
    found = by_batch(found, "doc_id long, node long, text string", lambda b: {"doc_id": b.column("doc_id")} | work(b))
    found = found.join(several.withColumnRenamed("node", "_node"), F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("node") == F.col("_node")), "left_semi")
    least = found.groupBy("doc_id", "node").agg(F.min("text").alias("_text")).select(F.col("doc_id").alias("_id"), "_text")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    again = docs.join(least, doc_id.eqNullSafe(F.col("_id")) & (text == F.col("_text")), "left_semi")
    rows = again.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), doc_id.alias("_id"), text.alias("_text"))
    one = rows.groupBy("_id", "_text").agg(F.first("_row").alias("_row"))
    return once.union(one.select("_row.*"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``representatives``, of which those that share a given id leave one row, that of the least text."""
    rows = representatives(docs)
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    given = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min_by(whole, F.struct("text")).alias("_row"))
    return rows.where("doc_id IS NULL").union(given.select("_row.*"))
