"""A committee of Gaussian Naive Bayes models, one for each training bucket.

Models are never built from the rows of a bucket gathered in one place. Counts, sums and sums of
squares by model, class and term hold all that training needs, they are added up on the way into
the shuffle, and a second training round is an addition. Zeros are implied throughout.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import log, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.functions.binding import let
from tonewright.operators.blocks import DealtCorpus, DocumentBlocks
from tonewright.operators.split import stable_bucket
from tonewright.operators.term_table import BROADCAST_LIMIT, TermTable
from tonewright.operators.tfidf import Vocabulary, explode_entries
from tonewright.sources.workspace import Buckets, forget, materialize, materialize_dealt, temporary

BUCKETS = 50
TRAIN_BUCKETS = 40
# Share of the largest variance of a model that is added to all its variances. A model of one
# document, or of copies of one, has no variance to take a share of and gets the value itself.
SMOOTHING = 1e-9
_NO_VARIANCE = 1e-12
_SUMS = "array<struct<s0: double, ss0: double, s1: double, ss1: double>>"
_MEMBERS = "array<struct<mu0: double, var0: double, mu1: double, var1: double>>"
# Part of the broadcast limit for the terms that most blocks of documents have.
COMMON_SHARE = 1.0


def with_bucket(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return rows.withColumn("bucket", stable_bucket(F.col("doc_id"), buckets))


@dataclass(frozen=True)
class Member:
    """What a model knows apart from its terms. ``n`` and ``base`` are by class.

    ``base`` is the log probability of a document without terms; a class without documents has
    none.
    """

    n: tuple[int, int]
    epsilon: float
    base: tuple[float | None, float | None]


@dataclass(frozen=True)
class Committee:
    """Members by model id, and ``table(term, df, members)`` of means and variances.

    The array of a term has a place for each member, in the order of their ids; it is NULL for a
    model that didn't see the term. ``laid`` is where the sums behind the table lie by term, in as
    many buckets as the corpus has blocks, and ``places`` makes the array of them.
    """

    members: dict[int, Member]
    table: TermTable
    laid: Buckets | None = None
    blocks: int = 0
    places: Column | None = None

    def close(self) -> None:
        """Takes the sums out of the catalog; their files stay until their scope ends."""
        if self.laid:
            forget(self.table.frame.sparkSession, self.laid)


def _models_of(bucket: Column, models: int, rounds: int) -> Column:
    """Models that train on a bucket: its own, and in round two the one before it."""
    own = bucket.cast("int")
    if rounds == 1:
        return F.array(own)
    return F.array(own, ((own + models - 1) % models).cast("int"))


def document_counts(bucketed: DataFrame, models: int, rounds: int) -> dict[int, tuple[int, int]]:
    """Training documents of each class for each model; at most ``models`` rows."""
    train = bucketed.where(F.col("bucket") < models)
    counted = (
        train.select("bucket", "label")
        .groupBy("bucket")
        .agg(*(F.count(F.when(F.col("label") == c, 1)).alias(f"n{c}") for c in (0, 1)))
        .collect()
    )
    own = {r["bucket"]: (r["n0"], r["n1"]) for r in counted}
    if rounds == 1:
        return own
    partner = {b: own.get((b + 1) % models, (0, 0)) for b in own}
    return {b: (own[b][0] + partner[b][0], own[b][1] + partner[b][1]) for b in own}


def term_statistics(
    bucketed: DataFrame, models: int, rounds: int, present: Iterable[int] | None = None
) -> DataFrame:
    """Sum and sum of squares by model and term, for class 0 and class 1.

    A bucket without documents has no model, not even by way of its partner: ``present`` names
    the models to keep.
    """
    train = explode_entries(bucketed.where(F.col("bucket") < models))
    rows = train.withColumn("model_id", F.explode(_models_of(F.col("bucket"), models, rounds)))
    if present is not None:
        rows = rows.where(F.col("model_id").isin(*present))
    w = F.col("w")
    sums = []
    for c in (0, 1):
        x = F.when(F.col("label") == c, w).otherwise(0.0)
        sums += [F.sum(x).alias(f"s{c}"), F.sum(x * x).alias(f"ss{c}")]
    return rows.groupBy("model_id", "term").agg(*sums)


def fit_committee(
    bucketed: DataFrame | DealtCorpus,
    vocabulary: Vocabulary,
    models: int = TRAIN_BUCKETS,
    rounds: int = 2,
) -> Committee:
    """Trains on a weighted corpus with ``label`` and ``bucket``; buckets from ``models`` on are
    held out.

    Rows are added up by their own bucket only; in round two a model adds the sums of two buckets.
    Sums of a corpus in blocks are written in as many buckets, where the blocks look them up.
    """
    blocks = 0
    if isinstance(bucketed, DealtCorpus):
        bucketed, blocks = bucketed.frame, bucketed.blocks
    n = document_counts(bucketed, models, rounds)
    own = term_statistics(bucketed, models, rounds=1)
    trained = {m: (m, (m + 1) % models) if rounds == 2 and models > 1 else (m,) for m in n}
    return committee_of_sums(own, n, vocabulary.size, trained, blocks)


def committee_of_sums(
    stats: DataFrame,
    n: dict[int, tuple[int, int]],
    vocabulary_size: int,
    trained: dict[int, tuple[int, ...]] | None = None,
    blocks: int = 0,
) -> Committee:
    """The committee with sums as of :func:`term_statistics` and ``n`` documents by model.

    ``trained`` names the one or two ``model_id`` of the sums that a model is made of; without it
    the sums are those of the models. They are read once and written packed by term. Parameters are
    derived from the packed sums wherever they are read.
    """
    ids = sorted(n)
    trained = trained or {m: (m,) for m in ids}
    buckets = sorted({b for m in ids for b in trained[m]})
    values = F.struct("s0", "ss0", "s1", "ss1")
    dealt = stats.repartition(blocks, "term") if blocks else stats
    packed = dealt.groupBy("term").agg(
        F.map_from_entries(F.collect_list(F.struct("model_id", values.alias("values")))).alias("of")
    )
    places = F.array(*(F.try_element_at("of", F.lit(b).cast("int")) for b in buckets))
    packed = packed.select("term", places.cast(_SUMS).alias("sums"))
    laid = materialize_dealt(packed, "committee-sums", "term", blocks) if blocks else None
    sums = stats.sparkSession.table(laid.name) if laid else materialize(packed, "committee-sums")

    known, members = {}, F.array()
    if ids:
        known, members = _fitted(sums, n, vocabulary_size, {m: [buckets.index(b) for b in trained[m]] for m in ids})
    members = members.cast(_MEMBERS)
    table = TermTable.of(_packed_table(sums, members), extra=_row_size())
    return Committee(known, table, laid, blocks, members)


def _packed_table(sums: DataFrame, members: Column) -> DataFrame:
    table = sums.select("term", members.alias("members"))
    df = F.size(F.filter("members", lambda v: v.isNotNull())).cast("bigint")
    return table.select("term", df.alias("df"), "members")


def _fitted(
    sums: DataFrame, n: dict[int, tuple[int, int]], vocabulary_size: int, places: dict[int, list[int]]
) -> tuple[dict[int, Member], Column]:
    """The members, and the array of their parameters as an expression of the packed ``sums``.

    ``places`` has where in the array the sums of each model are.
    """
    ids = sorted(n)

    def models(*facts: dict) -> Column:
        """What is known of each model, as one literal array: the places of its sums, then numbers."""
        rows = []
        for m in ids:
            at = [F.lit(place).cast("int") for place in (*places[m], None)]
            numbers = [F.lit(f[m]).cast("double").alias(f"x{i}") for i, f in enumerate(facts)]
            rows.append(F.struct(at[0].alias("own"), at[1].alias("other"), *numbers))
        return F.array(*rows)

    # Largest variance of a term over all rows of a model, zeros included.
    spread = _by_model(models({m: sum(n[m]) for m in ids}), _spread)
    widest = _unpacked(sums, ids, spread).groupBy("model_id").agg(F.max("of").alias("widest"))
    found = {r["model_id"]: r["widest"] for r in widest.collect()}
    epsilon = {m: _epsilon(found.get(m)) for m in ids}
    # A class without documents has NULL parameters.
    counts = [{m: n[m][c] or None for m in ids} for c in (0, 1)]
    members = _by_model(models(*counts, epsilon), _parameters)

    fixed = []
    for c in (0, 1):
        mu, var = F.col(f"of.mu{c}"), F.col(f"of.var{c}")
        fixed.append(F.sum(F.log(2 * pi * var) + mu * mu / var).alias(f"fixed{c}"))
    seen = _unpacked(sums, ids, members).groupBy("model_id").agg(*fixed, F.count("*").alias("seen"))
    totals = {r["model_id"]: r for r in seen.collect()}
    known = {
        m: Member(n[m], epsilon[m], _bases(n[m], epsilon[m], totals.get(m), vocabulary_size))
        for m in ids
    }
    return known, members


def _row_size() -> Column:
    """Bytes of the parameters in a row of a committee's table, which may have nothing but them."""
    return F.size("members") * 8 + F.size(F.filter("members", lambda v: v.isNotNull())) * 40


def _sums_size(models: int) -> Column:
    """As :func:`_row_size`, from packed sums; a bucket's sums make two models at most."""
    seen = F.size(F.filter("sums", lambda v: v.isNotNull()))
    return models * 8 + F.least(2 * seen, F.lit(models)) * 40


def _by_model(models: Column, made) -> Column:
    """An array with what ``made`` makes of the sums of each of ``models``, NULL for one that didn't
    see the term.

    The expression is as long for many models as for one.
    """

    def of(model: Column) -> Column:
        own, other = F.get("sums", model["own"]), F.get("sums", model["other"])
        both = F.struct(
            *(
                (F.coalesce(own[x], F.lit(0.0)) + F.coalesce(other[x], F.lit(0.0))).alias(x)
                for x in ("s0", "ss0", "s1", "ss1")
            )
        )
        seen = own.isNotNull() | other.isNotNull()
        return F.when(seen, let(both, lambda total: made(total, model)))

    return F.transform(models, of)


def _spread(total: Column, model: Column) -> Column:
    mean = (total["s0"] + total["s1"]) / model["x0"]
    return (total["ss0"] + total["ss1"]) / model["x0"] - mean * mean


def _parameters(total: Column, model: Column) -> Column:
    columns: list[Column] = []
    for c in (0, 1):
        mu = total[f"s{c}"] / model[f"x{c}"]
        var = total[f"ss{c}"] / model[f"x{c}"] - mu * mu
        columns += [mu.alias(f"mu{c}"), (F.greatest(var, F.lit(0.0)) + model["x2"]).alias(f"var{c}")]
    return F.struct(*columns)


def _unpacked(frame: DataFrame, ids: list[int], places: Column) -> DataFrame:
    """``(term, model_id, of)``: a row for each model that saw a term, in the order of ``ids``."""
    named = F.array(*(F.lit(m).cast("int") for m in ids))
    pairs = F.zip_with(named, places, lambda m, v: F.struct(m.alias("model_id"), v.alias("of")))
    rows = frame.select("term", F.explode(pairs).alias("place")).select("term", "place.*")
    return rows.where("of IS NOT NULL")


def parameters(committee: Committee) -> DataFrame:
    """``(model_id, term, mu0, var0, mu1, var1)``: the packed table, a row for each model and term."""
    rows = _unpacked(committee.table.frame, sorted(committee.members), F.col("members"))
    return rows.select("model_id", "term", "of.*")


def _epsilon(widest: float | None) -> float:
    return SMOOTHING * widest if widest and widest > _NO_VARIANCE else SMOOTHING


def _bases(counts, epsilon, sums, vocabulary_size) -> tuple[float | None, float | None]:
    both = counts[0] + counts[1]
    seen = sums["seen"] if sums else 0
    unseen = (vocabulary_size - seen) * log(2 * pi * epsilon)
    return tuple(
        log(counts[c] / both) - 0.5 * ((sums[f"fixed{c}"] if sums else 0.0) + unseen)
        if counts[c]
        else None
        for c in (0, 1)
    )


def member_scores(
    rows: DataFrame | DealtCorpus, committee: Committee, limit: int = BROADCAST_LIMIT
) -> DataFrame:
    """``scores``, an array of ``(model_id, score0, score1)``: each document's log probabilities by
    all models.

    The parameters of all models come with one join on the term, packed by model, and are summed in
    place: four sums for each model and document. So what leaves a task is one row for each
    document, whatever the number of models. A table of parameters within ``limit`` bytes is
    broadcast. Beyond it, blocks of documents get the parameters of their terms, and nothing is
    exchanged between the rows and the sums. Terms that most blocks have would be sent over and over:
    the most widespread ones, up to ``COMMON_SHARE`` of the limit, are broadcast all the same. Where
    the sums lie by term as the blocks need them, the sums are sent, which are shorter, and made
    parameters where they arrive.

    Rows that already lie in blocks (:func:`tonewright.operators.blocks.deal`) stay there. A term the
    model has not seen takes the same form for every model, so it is taken from what is missing of
    the document's squared length.
    """
    dealt = rows if isinstance(rows, DealtCorpus) else None
    frame = dealt.frame if dealt else rows
    keys = [c for c in frame.columns if c != "entries"]
    ids = sorted(committee.members)
    exploded = explode_entries(frame, outer=True)
    if committee.table.size <= limit:
        return _folded(committee.table.attach(exploded, limit=limit), keys, ids, committee).drop("block")
    with temporary(frame.sparkSession):
        if dealt:
            blocks = DocumentBlocks.over(dealt, lambda f: explode_entries(f, outer=True))
        else:
            total = frame.agg(F.sum(F.greatest(F.size("entries"), F.lit(1)))).first()[0] or 0
            blocks = DocumentBlocks(exploded, total)
            keys.append("block")
        try:
            common = int(limit * COMMON_SHARE)
            if committee.laid and committee.blocks == blocks.blocks:
                arrived = {"members": committee.places}
                known = blocks.send(
                    committee.laid, "sums", common=common, width=_sums_size(len(ids)), arrived=arrived
                )
            else:
                stored = blocks.store(committee.table.frame)
                known = blocks.send(stored, "members", common=common, width=_row_size())
            scored = _folded(known, keys, ids, committee).drop("block")
            return materialize(scored, "scores", lasting=True, reader=frame.sparkSession)
        finally:
            blocks.close()


def _folded(known: DataFrame, keys: list[str], ids: list[int], committee: Committee) -> DataFrame:
    """Sums of rows ``(keys, term, w, members)`` by document, as scores."""
    w = F.col("w")
    sums = [F.coalesce(F.sum(w * w), F.lit(0.0)).alias("square"), F.count(w).alias("n_terms")]
    for i in range(len(ids)):
        member = F.get("members", F.lit(i))
        for c in (0, 1):
            gain = w * (member[f"mu{c}"] - w / 2) / member[f"var{c}"]
            sums.append(F.coalesce(F.sum(gain), F.lit(0.0)).alias(f"gain{c}_{i}"))
        seen = F.when(member.isNotNull(), w)
        sums.append(F.coalesce(F.sum(seen * seen), F.lit(0.0)).alias(f"seen_{i}"))
        sums.append(F.count(seen).alias(f"n_seen_{i}"))
    totals = known.groupBy(*keys).agg(*sums)
    scores = []
    for i, m in enumerate(ids):
        member = committee.members[m]
        # Exactly nothing when all terms were seen: the difference would be rounding error, and it
        # is divided by a very small number.
        unseen = F.when(F.col(f"n_seen_{i}") == F.col("n_terms"), 0.0).otherwise(
            (F.col("square") - F.col(f"seen_{i}")) / (2 * member.epsilon)
        )
        parts = [F.lit(m).cast("int").alias("model_id")]
        for c in (0, 1):
            base = F.lit(member.base[c]).cast("double")
            parts.append((base + F.col(f"gain{c}_{i}") - unseen).alias(f"score{c}"))
        scores.append(F.struct(*parts))
    empty = "array<struct<model_id: int, score0: double, score1: double>>"
    return totals.select(*keys, F.array(*scores).cast(empty).alias("scores"))


def score_members(rows: DataFrame, committee: Committee, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """:func:`member_scores` with a row for each document and model."""
    packed = member_scores(rows, committee, limit)
    keys = [c for c in packed.columns if c != "scores"]
    return packed.select(*keys, F.inline("scores"))


def _probability(this: Column, other: Column) -> Column:
    """Softmax of two scores; a missing score is a probability of zero."""
    return (
        F.when(this.isNull(), 0.0)
        .when(other.isNull(), 1.0)
        .otherwise(1.0 / (1.0 + F.exp(other - this)))
    )


def _packed(scored: DataFrame) -> DataFrame:
    """Rows by document and model put together by document; packed ones as they are."""
    if "scores" in scored.columns:
        return scored
    keys = [c for c in scored.columns if c not in ("model_id", "score0", "score1")]
    return scored.groupBy(*keys).agg(
        F.collect_list(F.struct("model_id", "score0", "score1")).alias("scores")
    )


def _voted(scored: DataFrame, zero: Column, vote) -> DataFrame:
    """Votes are added up inside the row."""

    def count(c: int) -> Column:
        return F.aggregate("scores", zero, lambda total, m: total + vote(m, c)).alias(f"votes{c}")

    votes = [count(c) for c in (0, 1)]
    packed = _packed(scored)
    keys = [c for c in packed.columns if c != "scores"]
    return packed.select(*keys, *votes).withColumn("prediction", _winner())


def soft_vote(scored: DataFrame) -> DataFrame:
    """Sums the class probabilities of all models; class 0 wins a tie."""

    def chance(member: Column, c: int) -> Column:
        return _probability(member[f"score{c}"], member[f"score{1 - c}"])

    return _voted(scored, F.lit(0.0), chance)


def hard_vote(scored: DataFrame) -> DataFrame:
    """Counts the models that decide for each class; class 0 wins a tie, of models too."""

    def choice(member: Column, c: int) -> Column:
        for_one = F.when(member["score0"].isNull(), True).otherwise(
            F.coalesce(member["score1"] > member["score0"], F.lit(False))
        )
        return (for_one if c else ~for_one).cast("bigint")

    return _voted(scored, F.lit(0).cast("bigint"), choice)


def _winner() -> Column:
    return F.when(F.col("votes0") >= F.col("votes1"), 0.0).otherwise(1.0)
