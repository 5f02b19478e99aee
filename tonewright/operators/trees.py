"""Decision trees, forests and boosting on sparse documents.

A document is an array of ``(term, bin)``; a term that it doesn't have is in bin 0. A split is a term
and a bin: documents with the term in that bin or above go right, all others left. So trees need no
column numbers and no dense rows, and a tree is a few literals.

Trees grow level by level, all trees of a forest at once. A level is one aggregation: each document
walks the trees as far as they have grown, inside its row, and its entries are counted by tree, node,
term and bin. The sums to the right of a split are running sums over the bins from above; those to
the left, with the documents that lack the term, are what is left of the node's totals. The best
split of each node is the only thing that reaches the driver: at most ``2 ** depth`` rows for each
tree. The documents themselves are never shuffled, and nothing about them is stored between levels.

All sums are of whole numbers (copies of documents and labels, or residuals in millionths), so a
model doesn't depend on the order of addition. Splits that are equally good go by term and bin.
"""

from __future__ import annotations

import hashlib
import json
import pickle
from collections.abc import Callable
from dataclasses import dataclass, field
from math import ceil, exp, factorial, floor, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonewright.functions.binding import let
from tonewright.operators.term_table import BROADCAST_LIMIT
from tonewright.sources.parallelism import spread
from tonewright.sources.workspace import materialize

#: Bins of a term's weight, with the one for its absence.
BINS = 32
#: Hashes of terms are below this prime, which is that of the family of draws.
_PRIME = (1 << 31) - 1
#: Residuals are counted in these units.
_UNITS = 1_000_000
_NODE = "array<struct<term: string, bin: int, value: double>>"


def weight_bin(w: Column) -> Column:
    """Bin 1 to 31 of a weight: quarters of a halving, the smallest weights together.

    Weights lie between 0 and 1. The shift keeps the common weights (roots of one over a whole
    number) off the bounds.
    """
    below = F.floor(-4 * F.log2(w) + 0.137).cast("int")
    return BINS - 1 - F.least(F.lit(BINS - 2), F.greatest(F.lit(0), below))


def term_hash(term: Column) -> Column:
    """28 bits of a term, for the draw of terms at a node."""
    return F.conv(F.substring(F.md5(term.cast("binary")), 1, 7), 16, 10).cast("bigint")


@dataclass
class Node:
    """Totals of a node's documents, and its split if it has one."""

    n: int
    s: int
    term: str | None = None
    bin: int = 0


@dataclass
class Tree:
    """Nodes by number: the children of ``i`` are ``2 i + 1`` and ``2 i + 2``."""

    nodes: dict[int, Node] = field(default_factory=dict)

    def level(self, depth: int) -> dict[int, Node]:
        """Nodes of a level that a split could still divide."""
        first = 2**depth - 1
        return {i: x for i, x in self.nodes.items() if first <= i <= 2 * first and x.n > 1}

    def split(self, i: int, term: str, bin: int, n: int, s: int) -> None:
        """Divides a node; ``n`` and ``s`` are the totals that go right."""
        node = self.nodes[i]
        node.term, node.bin = term, bin
        self.nodes[2 * i + 1] = Node(node.n - n, node.s - s)
        self.nodes[2 * i + 2] = Node(n, s)


@dataclass
class TreeModel:
    """Trees, the value of each leaf, and what a sum of values must exceed for class 1."""

    trees: list[Tree]
    value: Callable[[int, Node], float]
    threshold: float

    def terms(self) -> list[str]:
        return sorted({x.term for t in self.trees for x in t.nodes.values() if x.term is not None})


def binned(weighted: DataFrame, hashes: bool = False) -> DataFrame:
    """Entries as ``(term, bin)``, and the hash of the term if it is asked for."""

    def entry(e: Column) -> Column:
        parts = [e["term"].alias("term"), weight_bin(e["w"]).alias("bin")]
        return F.struct(*parts, *([term_hash(e["term"]).alias("h")] if hashes else []))

    return weighted.withColumn("entries", F.transform("entries", entry))


def _stored(documents: DataFrame, name: str) -> DataFrame:
    """Written once and read for each level, so a table too small to have a split for each slot is
    written again in more files."""
    stored = materialize(documents, name)
    dealt = spread(stored, "doc_id" if "doc_id" in stored.columns else "place")
    return stored if dealt is stored else materialize(dealt, name)


def _literal(trees: list[Tree], value: Callable[[int, Node], float]) -> Column:
    """Trees as one array of arrays of nodes; an entry without a term is a leaf."""
    rows = []
    for t, tree in enumerate(trees):
        row: list[dict] = [{} for _ in range(max(tree.nodes, default=0) + 1)]
        for i, x in tree.nodes.items():
            row[i] = {"term": x.term, "bin": x.bin, "value": value(t, x)}
        rows.append(row)
    return F.from_json(F.lit(json.dumps(rows)), f"array<{_NODE}>")


def _walk(nodes: Column, bins: Column, depth: int) -> Column:
    """Number of the node that a document reaches."""

    def step(at: Column, _: Column) -> Column:
        here = F.get(nodes, at)
        right = F.coalesce(F.try_element_at(bins, here["term"]), F.lit(0)) >= here["bin"]
        return F.when(here["term"].isNull(), at).otherwise(2 * at + 1 + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def _bins(entries: Column, terms: list[str]) -> Column:
    """Bins of the terms that splits ask for. Looking up stays short, however long the document."""
    if not terms:
        return F.from_json(F.lit("{}"), "map<string, int>")
    asked = F.filter(entries, lambda e: e["term"].isin(terms))
    return F.map_from_entries(F.transform(asked, lambda e: F.struct(e["term"], e["bin"])))


def _best_splits(counted: DataFrame, trees: list[Tree], depth: int, scale: float) -> list:
    """The best split of each node of a level; ``counted`` has ``tree, node, term, bin, n, s``.

    A split is as good as the sum of squares it explains, which orders splits of a node as the Gini
    gain does for classes and as the variance does for residuals.
    """
    rows = [(t, i, x.n, x.s) for t, tree in enumerate(trees) for i, x in tree.level(depth).items()]
    totals = counted.sparkSession.createDataFrame(rows, "tree int, node int, all_n bigint, all_s bigint")
    above = Window.partitionBy("tree", "node", "term").orderBy(F.desc("bin"))
    above = above.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    right = counted.select(
        "tree", "node", "term", "bin", F.sum("n").over(above).alias("n"), F.sum("s").over(above).alias("s")
    )
    both = right.join(F.broadcast(totals), ["tree", "node"])

    def explained(s: Column, n: Column) -> Column:
        return (s / F.lit(scale)) * (s / F.lit(scale)) / n

    left_n, left_s = F.col("all_n") - F.col("n"), F.col("all_s") - F.col("s")
    gain = (
        explained(left_s, left_n)
        + explained(F.col("s"), F.col("n"))
        - explained(F.col("all_s"), F.col("all_n"))
    )
    key = F.floor(gain * 1e6)
    order = F.struct((-key).alias("key"), "term", "bin", "n", "s")
    best = both.where((left_n > 0) & (F.col("n") > 0)).groupBy("tree", "node").agg(F.min(order).alias("best"))
    return best.where("best.key < 0").select("tree", "node", "best.*").collect()


def _grow(trees: list[Tree], depth: int, scale: float, count: Callable[[int], DataFrame]) -> None:
    """Adds levels to trees that have a root; ``count`` gives the sums of a level."""
    for level in range(depth):
        if not any(tree.level(level) for tree in trees):
            return
        for r in _best_splits(count(level), trees, level, scale):
            trees[r["tree"]].split(r["node"], r["term"], r["bin"], r["n"], r["s"])


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("tree", "node", "term", "bin").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


# --- forest -------------------------------------------------------------------------------------

#: Entries of a block, about.
BLOCK_ROWS = 2_000_000


def _level_counts(splits: list[dict], draws: list[dict], limit: int) -> Callable:
    """What adds up the entries of blocks of documents by tree, open node, drawn term and bin.

    ``splits`` has the term and bin of each node that is split, by tree; ``draws`` the draw of each open
    node. In a block, entries lie in the order of term and bin, so that a draw is made once for a term and
    the entries of those that aren't drawn are never touched.
    """
    most, prime = BLOCK_ROWS, _PRIME
    asked = sorted({term for tree in splits for term, _ in tree.values()})

    def block(label: pa.Array, copies: np.ndarray, entries: pa.StructArray, lengths: np.ndarray):
        term, bins, hashes = entries.flatten()
        coded = term.dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy()
        bins = bins.to_numpy()
        order = np.lexsort((bins, codes))
        codes, bins = codes[order], bins[order]
        docs = np.repeat(np.arange(len(lengths)), lengths)[order]
        first = np.searchsorted(codes, np.arange(len(names) + 1))
        hashes = hashes.to_numpy()[order][first[:-1]]
        known = label.is_valid().to_numpy(zero_copy_only=False)
        label = label.fill_null(0).to_numpy()
        place = {}
        if asked:
            found = pc.index_in(pa.array(asked, names.type), value_set=names).to_pylist()
            place = {name: at for name, at in zip(asked, found, strict=True) if at is not None}
        out = [[] for _ in range(7)]
        for t, (tree, nodes) in enumerate(zip(splits, draws, strict=True)):
            if not nodes:
                continue
            at = np.zeros(len(lengths), np.int32)
            for i in sorted(tree):
                name, bin = tree[i]
                here = at == i
                at[here] = 2 * i + 1
                if name in place:
                    span = slice(first[place[name]], first[place[name] + 1])
                    right = docs[span][bins[span] >= bin]
                    at[right[here[right]]] = 2 * i + 2
            times = copies[:, t]
            for i, draw in nodes.items():
                taken = (at == i) & (times > 0)
                if not taken.any():
                    continue
                chosen = np.flatnonzero((draw["a"] * hashes + draw["b"]) % prime < limit)
                sizes = first[chosen + 1] - first[chosen]
                shift = np.repeat(first[chosen] - np.cumsum(sizes) + sizes, sizes)
                rows = np.arange(len(shift)) + shift
                rows = rows[taken[docs[rows]]]
                if not len(rows):
                    continue
                key = codes[rows].astype(np.int64) * 64 + bins[rows]
                start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                doc = docs[rows]
                n = np.add.reduceat(times[doc], start)
                s = np.add.reduceat(times[doc] * label[doc], start)
                none = np.add.reduceat(known[doc].astype(int), start) == 0
                both = (np.full(len(start), t), np.full(len(start), i))
                for to, x in zip(out, (*both, key[start] // 64, key[start] % 64, n, s, none), strict=True):
                    to.append(x)
        if out[0]:
            tree, node, code, bin, n, s, none = (np.concatenate(x) for x in out)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tree.astype(np.int32)),
                    pa.array(node.astype(np.int32)),
                    names.take(pa.array(code)),
                    pa.array(bin.astype(np.int32)),
                    pa.array(n),
                    pa.array(s, mask=none),
                ],
                ["tree", "node", "term", "bin", "n", "s"],
            )

    def joined(held: list):
        rows = [h["entries"] for h in held]
        entries = pa.concat_arrays([r.flatten() for r in rows])
        if not len(entries):
            return
        lengths = np.concatenate([r.value_lengths().fill_null(0).to_numpy() for r in rows])
        copies = np.concatenate([h["copies"].flatten().to_numpy() for h in held]).astype(np.int64)
        label = pa.concat_arrays([h["label"] for h in held])
        yield from block(label, copies.reshape(len(lengths), -1), entries, lengths)

    def counted(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch["entries"].flatten())
            if size >= most:
                yield from joined(held)
                held, size = [], 0
        if held:
            yield from joined(held)

    return counted


def copies(key: Column, tree: Column, seed: int) -> Column:
    """How often a document stands in the sample of a tree: a draw with replacement, from a hash."""
    text = F.concat_ws(":", F.lit(seed), tree, key.cast("string"))
    u = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    drawn = F.lit(0)
    for bound in poisson_bounds():
        drawn = drawn + (u >= bound).cast("int")
    return drawn


def poisson_bounds() -> list[int]:
    """Of 2**32 equally likely numbers, those below the k-th bound stand for fewer than k copies."""
    total, bounds = 0.0, []
    for k in range(8):
        total += exp(-1) / factorial(k)
        bounds.append(floor(total * 2**32))
    return bounds


def _draw(seed: int, tree: int, node: int) -> dict[str, int]:
    digest = hashlib.md5(f"{seed}:{tree}:{node}".encode()).hexdigest()
    return {"a": 1 + int(digest[:7], 16), "b": int(digest[7:14], 16)}


def fit_forest(
    weighted: DataFrame, features: int, trees: int = 3, depth: int = 4, seed: int = 2
) -> TreeModel:
    """Trees on samples of the documents; each node chooses among terms drawn for it.

    Each node draws about the square root of the number of terms (``features``), all of them if
    there is but one tree. Term and node decide the draw, so entries that aren't drawn are dropped
    in the row, before anything is counted.
    """
    documents = weighted.select("doc_id", "label", "entries")
    key = F.col("doc_id")
    numbers = F.sequence(F.lit(0), F.lit(trees - 1))
    drawn = F.transform(numbers, lambda t: copies(key, t, seed) if trees > 1 else F.lit(1))
    drawn = drawn.cast("array<tinyint>").alias("copies")
    sampled = binned(documents, hashes=True).select("doc_id", "label", "entries", drawn)
    stored = _stored(sampled, "forest-documents").drop("doc_id")
    label = F.col("label").cast("bigint")
    per_tree = stored.select(F.posexplode("copies").alias("tree", "n"), label.alias("label"))
    roots = per_tree.groupBy("tree").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("s"))
    grown = [Tree({0: Node(0, 0)}) for _ in range(trees)]
    for r in roots.collect():
        grown[r["tree"]].nodes[0] = Node(r["n"], r["s"])
    limit = _PRIME if trees == 1 or not features else _PRIME * ceil(sqrt(features)) // features
    rows = stored.withColumn("label", label)

    def count(level: int) -> DataFrame:
        draws = [{i: _draw(seed, t, i) for i in tree.level(level)} for t, tree in enumerate(grown)]
        splits = [
            {i: (x.term, x.bin) for i, x in tree.nodes.items() if x.term is not None} for tree in grown
        ]
        schema = "tree int, node int, term string, bin int, n bigint, s bigint"
        return _summed(rows.mapInArrow(_level_counts(splits, draws, limit), schema))

    _grow(grown, depth, 1.0, count)
    return TreeModel(grown, lambda t, x: float(2 * x.s > x.n), trees / 2)


# --- boosting -----------------------------------------------------------------------------------


def fit_boosting(
    weighted: DataFrame,
    iterations: int = 30,
    depth: int = 4,
    rate: float = 0.1,
    limit: int = BROADCAST_LIMIT,
) -> TreeModel:
    """Trees one after the other, each on what the log loss of those before it leaves.

    With labels of -1 and 1, the first tree is fitted to the labels and counts in full, the later ones
    to the negative gradient at the margin so far and by ``rate``.

    The entries are dealt out by term once, as packed lists of documents by term and bin
    (:func:`pack_postings`). All entries of a term are in one task, so sums by term, node and bin move
    nowhere. A level is one job: a node number for each document is broadcast, with its residual once for a
    tree, and each task gives its best split of each node, with a bit for each document of the node. If
    that takes more than ``limit`` bytes, documents are walked in their rows instead and the sums are
    exchanged.
    """
    documents = weighted.select("doc_id", "label", "entries")
    model = TreeModel([], lambda t, x: (1.0 if t == 0 else rate) * (x.s / _UNITS / max(x.n, 1)), 0.0)
    part = F.spark_partition_id().alias("part")
    place = F.monotonically_increasing_id().alias("place")
    stored = materialize(binned(documents).select("label", "entries", part, place), "boosting-documents")
    n = stored.count()
    if 10 * n > limit:
        return _boost_by_rows(_stored(stored.drop("part"), "boosting-rows"), model, iterations, depth)
    sizes = sorted(stored.groupBy("part").agg(F.count("*"), F.min("place")).collect())
    shift, total = {}, 0
    for r in sizes:
        shift[str(r[0])] = total - r[2]
        total += r[1]
    shifts = F.from_json(F.lit(json.dumps(shift)), "map<string, bigint>")
    number = (F.col("place") + F.try_element_at(shifts, F.col("part").cast("string"))).cast("int").alias("doc")
    told = stored.select(number, F.col("label").cast("double").alias("label")).toArrow()
    label = np.full(n, np.nan)
    label[told["doc"].to_numpy()] = told["label"].to_numpy()
    postings = pack_postings(stored.select(number, "entries"))
    try:
        _boost_by_terms(postings, label, model, iterations, depth)
    finally:
        postings.unpersist()
    return model


def pack_postings(documents: DataFrame) -> RDD:
    """Rows ``doc, entries`` as blocks of arrays, persisted; a term lies in one block.

    A block has its terms, the term and bin of each segment, and segment and document of each entry,
    all in the order of terms and from high bins to low ones.
    """
    slots = documents.sparkSession.sparkContext.defaultParallelism
    rows = documents.select("doc", F.explode_outer("entries").alias("e")).where("e IS NOT NULL")
    rows = rows.select(F.col("e.term").cast("binary").alias("term"), "e.bin", "doc")
    dealt = rows.repartition(slots, "term").sortWithinPartitions("term", F.desc("bin"))
    most = BLOCK_ROWS

    def table(held: list):
        rows = pa.Table.from_batches(held).combine_chunks()
        coded = pa.concat_arrays(rows["term"].chunks).dictionary_encode()
        return rows, coded.dictionary, coded.indices.to_numpy()

    def block(rows: pa.Table, names: pa.Array, codes: np.ndarray) -> pa.RecordBatch:
        bins = rows["bin"].to_numpy()
        new = (codes[1:] != codes[:-1]) | (bins[1:] != bins[:-1])
        starts = np.flatnonzero(np.concatenate([[True], new]))
        parts = {
            "names": names.slice(0, int(codes[-1]) + 1).to_pylist(),
            "term": codes[starts].astype(np.int32),
            "bin": bins[starts].astype(np.int8),
            "segment": np.cumsum(np.concatenate([[0], new])).astype(np.int32),
            "doc": rows["doc"].to_numpy(),
        }
        return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(parts, 5)], pa.binary())})

    def blocks(batches):
        held, size, enough = [], 0, most
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= enough:
                rows, names, codes = table(held)
                cut = int(np.searchsorted(codes, codes[-1]))
                if cut:
                    yield block(rows.slice(0, cut), names, codes[:cut])
                held, size = rows.slice(cut).to_batches(), size - cut
                enough = size + most
        if size:
            yield block(*table(held))

    packed = dealt.mapInArrow(blocks, "block binary")
    return packed.rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _boost_by_terms(
    postings: RDD, label: np.ndarray, model: TreeModel, iterations: int, depth: int
) -> None:
    """Adds the trees. A document without a label counts in its nodes and adds nothing to their sums."""
    context = postings.context
    sign, margin = 2 * label - 1, np.zeros(len(label))
    unknown = np.isnan(label)
    gaps = context.broadcast(unknown) if unknown.any() else None
    for k in range(iterations):
        with np.errstate(over="ignore"):
            residual = 4 * sign / (1 + np.exp(2 * sign * margin)) if k else sign
        units = np.where(unknown, 0.0, np.floor(residual * _UNITS + 0.5))
        tree = Tree({0: Node(len(label), int(units.sum()))})
        model.trees.append(tree)
        node = np.zeros(len(label), np.int32)
        sent = context.broadcast(units)
        for level in range(depth):
            open_nodes = sorted(tree.level(level))
            if not open_nodes:
                break
            slot = np.full(len(label), -1, np.int16)
            for j, i in enumerate(open_nodes):
                slot[node == i] = j
            slots = context.broadcast(slot)
            totals = [(tree.nodes[i].n, tree.nodes[i].s) for i in open_nodes]
            found = postings.mapPartitions(_best_of_terms(sent, slots, gaps, totals)).collect()
            slots.destroy()
            best: dict[int, tuple] = {}
            for j, order, right in found:
                if j not in best or order < best[j][0]:
                    best[j] = (order, right)
            for j, (order, right) in best.items():
                if not order:  # a sum that is NULL comes first, and is no split
                    continue
                _, name, bin, n, s = order
                docs = np.flatnonzero(slot == j)
                i = open_nodes[j]
                tree.split(i, name.decode(), bin, n, s)
                node[docs] = 2 * i + 1 + np.unpackbits(right, count=len(docs))
        sent.destroy()
        value = np.zeros(2 ** (depth + 1))
        for i, x in tree.nodes.items():
            value[i] = model.value(k, x)
        margin += value[node]


def _best_of_terms(sent, slots, gaps, totals: list[tuple[int, int]]) -> Callable:
    """What finds the best split of each open node among the terms of a partition, in the order of
    :func:`_best_splits`: ``slot, (-key, term, bin, n, s)`` and the documents of the node that go right."""
    scale = float(_UNITS)

    def explained(s, n):
        return (s / scale) * (s / scale) / n

    def splits(b: dict, rows: np.ndarray, units: np.ndarray, j: int):
        """Order of the best split, and its term's documents that go right."""
        segment, doc = b["segment"][rows], b["doc"][rows]
        start = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
        n = np.diff(start, append=len(rows))
        s = np.add.reduceat(units[doc], start)
        held = segment[start]
        term = b["term"][held]
        first = np.concatenate([[True], term[1:] != term[:-1]])

        def above(x: np.ndarray) -> np.ndarray:
            run = np.cumsum(x)
            begin = np.flatnonzero(first)
            return run - np.repeat((run - x)[begin], np.diff(begin, append=len(run)))

        n, s = above(n), above(s)
        all_n, all_s = totals[j]
        inner = n < all_n
        if gaps is not None:
            told = above(np.add.reduceat((~gaps.value[doc]).astype(int), start))
            if (inner & (told == 0)).any():
                return (), None
        place = np.flatnonzero(inner)
        if not len(place):
            return None
        n_, s_ = n[place], s[place]
        gain = explained(all_s - s_, all_n - n_) + explained(s_, n_) - explained(float(all_s), all_n)
        key = np.floor(gain * 1e6)
        top = key.max()
        if top < 1:
            return None
        at = place[key == top]
        at = at[term[at] == term[at[0]]][-1]  # the first term, its lowest bin
        order = (-int(top), b["names"][term[at]], int(b["bin"][held[at]]), int(n[at]), int(s[at]))
        begin = start[np.flatnonzero(first & (term == term[at]))[0]]
        end = start[at + 1] if at + 1 < len(start) else len(rows)
        return order, doc[begin:end]

    def best(blocks):
        units, slot = sent.value, slots.value
        found: dict[int, tuple] = {}
        for raw in blocks:
            b = pickle.loads(raw)
            where = slot[b["doc"]]
            for j in range(len(totals)):
                rows = np.flatnonzero(where == j)
                one = splits(b, rows, units, j) if len(rows) else None
                if one is not None and (j not in found or one[0] < found[j][0]):
                    found[j] = one
        for j, (order, docs) in found.items():
            right = np.zeros(len(slot), bool)
            if order:
                right[docs] = True
            yield j, order, np.packbits(right[slot == j])

    return best


def _boost_by_rows(stored: DataFrame, model: TreeModel, iterations: int, depth: int) -> TreeModel:
    """A document's margin and node are computed in its row from the trees, so nothing about a document is
    stored, joined or shuffled; a level is one aggregation of its entries."""
    sign = 2 * F.col("label") - 1
    for k in range(iterations):
        before = TreeModel(model.trees[:k], model.value, 0.0)
        residual = 4 * sign / (1 + F.exp(2 * sign * F.col("margin"))) if k else sign
        units = F.floor(residual * _UNITS + 0.5).cast("bigint")
        tree = Tree()
        model.trees.append(tree)

        def rows(level: int) -> DataFrame:
            """Documents with their residual and the node of the new tree that they are in."""
            asked = TreeModel(model.trees, model.value, 0.0).terms()

            def margin_and_node(bins: Column) -> Column:
                margin = _margin(before, bins, depth) if k else F.lit(0.0)
                grown = F.get(_literal([tree], lambda t, x: 0.0), F.lit(0))
                node = _walk(grown, bins, level) if level else F.lit(0)
                return F.struct(margin.alias("margin"), node.alias("node"))

            known = stored.withColumn("at", let(_bins(F.col("entries"), asked), margin_and_node))
            known = known.select("label", "entries", "at.margin", "at.node")
            return known.select("entries", "node", units.alias("s"))

        root = rows(0).agg(F.count("*").alias("n"), F.sum("s").alias("s")).first()
        tree.nodes[0] = Node(root["n"], root["s"] or 0)

        def count(level: int) -> DataFrame:
            open_nodes = rows(level).where(F.col("node").isin(list(tree.level(level))))
            exploded = open_nodes.select(F.explode("entries").alias("e"), "node", "s")
            one = F.lit(1).cast("bigint").alias("n")
            return _summed(exploded.select(F.lit(0).alias("tree"), "node", "e.term", "e.bin", one, "s"))

        _grow([tree], depth, float(_UNITS), count)
    return model


# --- prediction ---------------------------------------------------------------------------------


def _margin(model: TreeModel, bins: Column, depth: int) -> Column:
    """Sum of the values of the leaves that a document reaches."""

    def add(total: Column, nodes: Column) -> Column:
        return total + F.get(nodes, _walk(nodes, bins, depth))["value"]

    return F.aggregate(_literal(model.trees, model.value), F.lit(0.0), add)


def _depth(model: TreeModel) -> int:
    return max((i + 1).bit_length() for t in model.trees for i in [*t.nodes, 0])


def predict_trees(weighted: DataFrame, model: TreeModel, drop_empty: bool = False) -> DataFrame:
    """Sum of leaf values (votes for class 1, or the margin) and class of each document.

    Trees are literals that are walked inside the row; nothing is joined or shuffled.
    """
    kept = weighted.where("size(entries) > 0") if drop_empty else weighted
    entries = binned(kept).withColumn(
        "score", let(_bins(F.col("entries"), model.terms()), lambda b: _margin(model, b, _depth(model)))
    )
    return entries.drop("entries").withColumn(
        "prediction", (F.col("score") > model.threshold).cast("int")
    )


def tree_table(model: TreeModel, weighted: DataFrame) -> DataFrame:
    """``tree, node, term, bin, n, s`` of every node: the model as a table."""
    rows = [
        (t, i, x.term, x.bin if x.term is not None else None, x.n, x.s)
        for t, tree in enumerate(model.trees)
        for i, x in sorted(tree.nodes.items())
    ]
    schema = "tree int, node int, term string, bin int, n bigint, s bigint"
    return weighted.sparkSession.createDataFrame(rows, schema)
