"""Near duplicates by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct word shingles. The smallest ``RETAINED`` of them
are put into inverted lists, the smallest ``SKETCH`` estimate the overlap of two sets by the sketch
of their union, and whole texts decide. Documents with equal sets are one class.

*No link is lost.* Of two sets with a similarity of 0.75 or more, the smallest elements of the union
are in both with at least that chance each, so no shared value among 16 has a chance below 3e-10,
and an estimate below its bound (7.5 standard deviations) one below 1e-12. Sets smaller than a
sketch are compared exactly.

*No list is expanded into pairs.* A shared passage brings unrelated documents into one list. Sets
that share a retained value are therefore listed anew under their sketches, rarest values first, as
many as any linked pair must share one of: a passage then no longer brings documents together unless
it is about half of them. In each list all members meet two hubs, which the lists of a group of copies
have in common: the set with the fewest values of its own, and the one whose values are the most
common. Where members are still in different components, they meet another member of the list, drawn
for each list, and what is open after that is joined over whole sets: in the order of rarity, the
first seventh of the smaller set and the first quarter of the larger one must share an element.
Pairs of one component are left out, and so are those for which the elements that no other open set
has, or what the two share with a hub that both have met, leave no room for the similarity.

Defined results: null and empty texts have the empty set and are linked with nothing; texts of
fewer than five words are one shingle; repeated rows share their class; a null ``doc_id`` never
represents a component unless all of its ids are null, and then its rows are kept. Classes and texts
are known by 64 bits of a hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tonewright.llm import key_filter
from tonewright.llm.batches import give_back, parts
from tonewright.llm.components import components
from tonewright.sources.workspace import materialize, temporary

WORDS = 5
RETAINED = 16
SKETCH = 128
#: Orders in which members are drawn: lists of a group have few drawn members between them.
DRAWS = 16
_KNOWN: dict[bytes, int] = {}
_MOST = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit sums, a finalizer in common use."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct signed 64-bit hashes of the shingles of a text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, dtype=np.int64)
    known = _KNOWN
    try:
        values = [known[w] for w in words]
    except KeyError:
        if len(known) > _MOST:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        values = [known[w] for w in words]
    h = np.array(values, dtype=np.uint64)
    size = min(WORDS, len(words))
    out = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        out = out * _ODD + h[i : len(words) - size + 1 + i]
    return np.unique(_mixed(out).view(np.int64))


def node_of(hashes: np.ndarray) -> int:
    """The class of a set: 64 bits of a hash of the whole set."""
    return int(np.array(xxhash.xxh3_64_intdigest(hashes.tobytes()), dtype=np.uint64).view(np.int64))


def forgetting(function: Callable) -> Callable:
    """Words are remembered within a task only, and memory goes back at its end."""

    @wraps(function)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _KNOWN.clear()
            give_back()

    return run


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


@forgetting
def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in parts(whole, 2):
            sets = [shingle_hashes(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                    _lists([s[:SKETCH] for s in sets]),
                ],
                ["doc_id", "text_key", "n_shingles", "node", "sketch"],
            )


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``node, text`` for ``keys(node, text_key)``, one text for each: read again from the documents,
    filtered where they are read by a bitmap of bounded size, then exactly by a join."""
    bits = key_filter.bits_of(keys, "text_key")
    chosen = docs.select("text_key", "text").mapInArrow(
        partial(key_filter.chosen, bits=bits), "text_key bigint, text string"
    )
    # equal texts are common: a first aggregation where they are read keeps one of each
    one = chosen.groupBy("text_key").agg(F.first("text").alias("text"))
    return materialize(one.join(keys, "text_key").select("node", "text"), "texts")


@forgetting
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in parts(whole, 1):
            sets = [shingle_hashes(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], ["node", "whole"])


def least_overlap(n: Column) -> Column:
    """How many of the ``SKETCH`` smallest of the union a set of ``n`` shares with a linked one.

    Up to 96 elements both sketches are the whole sets. Above, the number is hypergeometric: the
    bound is 7.5 standard deviations below its mean for the largest possible union.
    """
    union = n / 0.75
    spread = F.greatest(F.lit(0.0), (union - SKETCH) / (union - 1))
    tail = SKETCH * 0.75 - 7.5 * F.sqrt(SKETCH * 0.75 * 0.25 * spread)
    exact = F.ceil(n * 0.75 - 1e-9)
    return F.when(n <= SKETCH * 0.75, exact).otherwise(
        F.least(exact, F.floor(tail))
    ).cast("int")


def rare_first(sketches: DataFrame) -> DataFrame:
    """Lists ``(value, node, hub, second)`` under the rarest values: any linked pair shares one of them.

    Of a sketch with at least ``c`` values in common with each linked one, all but ``c - 1`` are
    listed. The order is the same for all sketches: by number of sketches that hold the value, then
    by value. Values that only one sketch holds come first and need no list.
    """
    values = sketches.select("node", F.explode("sketch").alias("value"))
    counts = values.groupBy("value").count().where("count > 1")
    shared = materialize(values.join(counts, "value"), "shared-values")
    order = Window.partitionBy("node").orderBy("count", "value")
    every = Window.partitionBy("node")
    ranked = shared.select(
        "node",
        "value",
        F.row_number().over(order).alias("place"),
        F.count("*").over(every).alias("shared"),
        F.sum("count").over(every).alias("common"),
    ).join(sketches.select("node", "n", F.size("sketch").alias("size")), "node")
    own = F.col("size") - F.col("shared")
    listed = ranked.where(own + F.col("place") <= F.col("size") - least_overlap(F.col("n")) + 1)
    listed = listed.select("value", "node", own.alias("own"), (F.col("common") / F.col("size")).alias("mean"))
    listed = materialize(listed, "listed")
    heads = listed.groupBy("value").agg(
        F.min(F.struct("own", F.xxhash64("node"), "node"))["node"].alias("hub"),
        F.max(F.struct("mean", "node"))["node"].alias("second"),
        F.count("*").alias("size"),
    )
    return listed.join(heads.where("size > 1"), "value").select("value", "node", "hub", "second")


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def estimate(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The pairs that may reach the similarity by the sketch of their union."""
    left = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    met = pairs.join(left, "a").join(right, "b")
    met = met.where(100 * F.least("na", "nb") >= 75 * F.greatest("na", "nb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return met.where(common >= least_overlap(F.greatest("na", "nb"))).select("a", "b")


@forgetting
def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}

    def of(node: int, text: str) -> np.ndarray:
        found = known.get(node)
        if found is None:
            if len(known) > 2000:
                known.clear()
            found = known[node] = shingle_hashes(text)
        return found

    for batch in batches:
        keep = []
        for x, y, s, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            first, second = of(x, s), of(y, t)
            common = len(np.intersect1d(first, second, assume_unique=True))
            keep.append(100 * common >= 75 * (len(first) + len(second) - common))
        mask = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(mask)


def verify(docs: DataFrame, pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    texts = _texts(docs, materialize(keys.join(ends.distinct(), "node", "left_semi"), "ends"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    met = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return materialize(met.mapInArrow(_verified, "a bigint, b bigint"), "links")


def _reaches(n: str, own: str, other: str) -> Column:
    """Whether a set can be 0.75 similar to one of size ``other``: what they share is at most the
    rest of the set, and their union is at least the other and the set's own elements."""
    return 100 * (F.col(n) - F.col(own)) >= 75 * (F.col(other) + F.col(own))


@forgetting
def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, np.ndarray] = {}
    for batch in batches:
        shared = []
        for hub, x, y in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if hub not in known:
                if len(known) > 500:
                    known.clear()
                known[hub] = shingle_hashes(y)
            shared.append(len(np.intersect1d(shingle_hashes(x), known[hub], assume_unique=True)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(shared, pa.int64())], ["node", "hub", "shared"]
        )


def _met_hubs(texts: DataFrame, met: DataFrame) -> DataFrame:
    """``node, hubs``: how many elements a set shares with each hub that it has met, itself too."""
    left = texts.select("node", F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("hub"), F.col("text").alias("right"))
    pairs = met.join(left, "node").join(right, "hub").select("node", "hub", "left", "right")
    dealt = pairs.repartition("node").sortWithinPartitions("hub")
    shared = dealt.mapInArrow(_overlaps, "node bigint, hub bigint, shared bigint")
    return shared.groupBy("node").agg(F.collect_list(F.struct("hub", "shared")).alias("hubs"))


def _room_beside_hubs(x: str, y: str) -> Column:
    """Whether two sets can be similar, by each hub that both have met.

    What they share lies in the hub, where it is at most what either shares with the hub, or outside,
    where it is at most what either has there besides its own elements. It must be 3/7 of both
    sizes. A set that isn't similar to the hub of a group of copies is thereby kept apart from all
    copies that differ from the hub in elements of their own.
    """

    def outside(member: Column, side: str) -> Column:
        return F.col(f"n_{side}") - member["shared"] - F.col(f"own_{side}")

    def too_few(a: Column, b: Column) -> Column:
        most = F.least(a["shared"], b["shared"]) + F.least(outside(a, x), outside(b, y))
        return (a["hub"] == b["hub"]) & (7 * most < 3 * (F.col(f"n_{x}") + F.col(f"n_{y}")))

    return ~F.exists(f"hubs_{x}", lambda a: F.exists(f"hubs_{y}", lambda b: too_few(a, b)))


def _crossed(docs: DataFrame, open_: DataFrame, hubs: DataFrame, keys: DataFrame) -> DataFrame:
    """Pairs of different labels that may be similar, over whole sets of ``open_(node, label)``.

    ``hubs(node, hub)`` are those that the sets have met. Hubs count among the sets, so that an element
    which a set shares with one isn't its own.
    """
    met = hubs.join(open_.select("node"), "node", "left_semi")
    met = met.unionByName(met.select(F.col("hub").alias("node"), "hub"))
    met = met.unionByName(open_.select("node", F.col("node").alias("hub"))).distinct()
    met = materialize(met, "met")
    sets = met.select("node").distinct()
    texts = _texts(docs, materialize(keys.join(sets, "node", "left_semi"), "open-nodes"))
    met_hubs = materialize(_met_hubs(texts, met), "met-hubs")
    values = texts.mapInArrow(_sets, "node bigint, whole array<bigint>").select(
        "node", F.size("whole").alias("n"), F.explode("whole").alias("value")
    )
    values = materialize(values, "open-values")
    counts = values.groupBy("value").count().where("count > 1")
    order = Window.partitionBy("node").orderBy("count", "value")
    placed = values.join(counts, "value").select(
        "node",
        "n",
        "value",
        F.row_number().over(order).alias("place"),
        (F.col("n") - F.count("*").over(Window.partitionBy("node"))).alias("own"),
    )
    place = F.col("own") + F.col("place")
    longer = placed.where(place <= F.col("n") - F.ceil(F.col("n") * 3 / 4) + 1)
    longer = materialize(longer.join(open_, "node").join(met_hubs, "node"), "open-postings")
    shorter = longer.where(place <= F.col("n") - F.ceil(F.col("n") * 6 / 7) + 1)
    names = ("node", "n", "own", "label", "hubs")
    left = shorter.select("value", *(F.col(c).alias(f"{c}_x") for c in names))
    right = longer.select("value", *(F.col(c).alias(f"{c}_y") for c in names))
    sized = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y")))
    met = left.join(right, "value").where(
        (F.col("label_x") != F.col("label_y")) & sized & _reaches("n_x", "own_x", "n_y") & _reaches("n_y", "own_y", "n_x")
    ).where(_room_beside_hubs("x", "y"))
    return _pairs(met.select(F.col("node_x").alias("x"), F.col("node_y").alias("y")))


def _open_lists(lists: DataFrame, links: DataFrame) -> DataFrame:
    """Lists ``(value, node, label)`` whose members are in several components."""
    labelled = lists.join(components(links), "node", "left").select(
        "value", "node", F.coalesce("label", "node").alias("label")
    )
    labelled = materialize(labelled, "labelled")
    split = labelled.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_ = labelled.join(split.where("low <> high").select("value"), "value", "left_semi")
    return materialize(open_, "open")


def links_of(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between classes whose components are those of all links."""
    some = classes.where("node IS NOT NULL")
    postings = some.select("node", F.explode(F.slice("sketch", 1, RETAINED)).alias("value")).distinct()
    postings = materialize(postings, "postings")
    shared = postings.groupBy("value").count().where("count > 1")
    members = materialize(postings.join(shared, "value", "left_semi").select("node").distinct(), "members")
    sketches = some.join(members, "node", "left_semi").groupBy("node")
    sketches = sketches.agg(
        F.min("text_key").alias("text_key"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")
    )
    sketches = materialize(sketches, "sketches")
    keys = sketches.select("node", "text_key")
    lists = materialize(rare_first(sketches), "lists")
    hubs = lists.select(F.col("node").alias("x"), F.explode(F.array("hub", "second")).alias("y"))
    tried = materialize(estimate(_pairs(hubs.where("x <> y")), sketches), "star")
    links = verify(docs, tried, keys)

    open_ = _open_lists(lists, links)
    drawn = open_.groupBy("value").agg(
        F.min(F.struct(F.xxhash64("node", F.pmod("value", F.lit(DRAWS))), "node", "label")).alias("hub")
    )
    apart = open_.join(drawn, "value").where("label <> hub.label")
    more = _pairs(apart.select(F.col("node").alias("x"), F.col("hub.node").alias("y")))
    more = materialize(estimate(more.join(tried, ["a", "b"], "left_anti"), sketches), "drawn")
    links = links.unionByName(verify(docs, more, keys))

    open_ = _open_lists(open_.select("value", "node"), links)
    met_hubs = hubs.select(F.col("x").alias("node"), F.col("y").alias("hub")).where("node <> hub")
    rest = _crossed(docs, open_.select("node", "label").distinct(), met_hubs.distinct(), keys)
    rest = rest.join(tried.unionByName(more), ["a", "b"], "left_anti")
    return links.unionByName(verify(docs, materialize(estimate(rest, sketches), "rest"), keys))


def judged(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_shingles, node, label, component_id, kept`` of all documents.

    ``text_key`` is ``xxhash64`` of the text, ``node`` the class of its set and ``label`` tells
    components apart, also those without an id.
    """
    body = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(body).alias("text_key"), body.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key bigint, n_shingles bigint, node bigint, sketch array<bigint>"
    classes = materialize(rows.mapInArrow(_classes, schema), "classes")
    with temporary(docs.sparkSession):
        found = components(links_of(rows, classes))
        least = classes.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
        named = least.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
        by_label = named.groupBy("label").agg(F.min("least").alias("component"))
        owner = named.join(by_label, "label").select("node", "label", "component")
        owner = materialize(owner, "owners", lasting=True)
    out = classes.select("doc_id", "text_key", "n_shingles", "node").join(owner, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select(
        "doc_id", "text_key", "n_shingles", "node", "label", component.alias("component_id")
    ).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of all documents."""
    return judged(docs).select("doc_id", "n_shingles", "component_id", "kept")


def representatives(docs: DataFrame) -> DataFrame:
    """All columns of one row of each component, and of all rows with the empty set.

    It is a row with the smallest id (null only if there is no other), of these one with the smallest
    ``text_key``, and of rows with the same id and text the first by their other columns.
    """
    rows = materialize(judged(docs), "judged").where("node IS NOT NULL")
    key = ["doc_id", "text_key"]
    alike = rows.where("kept").groupBy("label", *key).agg(F.count("*").alias("rows"))
    first = alike.groupBy("label").agg(F.min(F.struct("text_key", "doc_id", "rows")).alias("first"))
    first = materialize(first.select("first.*"), "first-rows")

    def met(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = right.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
        on = left["doc_id"].eqNullSafe(right["__id"]) & (left["text_key"] == right["__key"])
        return left.join(right, on, how)

    gone = met(rows.select(key).distinct(), first, "left_anti")
    again = first.where("rows > 1").select(key)
    others = F.to_json(F.struct(F.lit(0).alias("0"), *(c for c in docs.columns if c not in ("doc_id", "text"))))
    own = docs.select(
        F.struct(*docs.columns).alias("row"), others.alias("others"), "doc_id",
        F.xxhash64(F.col("text").cast("string")).alias("text_key"),
    )
    single = met(own, gone.unionByName(again), "left_anti").select("row")
    one = met(own, again, "left_semi").groupBy(key).agg(F.min_by("row", "others").alias("row")).select("row")
    return single.unionByName(one).select("row.*")
