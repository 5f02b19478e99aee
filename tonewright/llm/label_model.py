"""Reliability of labelers that vote or abstain, by expectation-maximisation on vote patterns."""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

ABSTAIN, NO, YES = "0", "-", "+"


@dataclass(frozen=True)
class LabelModel:
    """Prior of the positive class, and the accuracy of each labeler when it votes."""

    prior: float
    accuracy: tuple[float, ...]

    def posterior(self, votes: str) -> float:
        """Chance of the positive class for a pattern of ``+``, ``-`` and ``0``."""
        odds = log(self.prior / (1 - self.prior))
        for vote, a in zip(votes, self.accuracy, strict=True):
            if vote != ABSTAIN:
                odds += (1 if vote == YES else -1) * log(a / (1 - a))
        return 1 / (1 + exp(-max(-500.0, min(500.0, odds))))


def fit(
    patterns: dict[str, int],
    labelers: int,
    prior: float = 0.5,
    start: float = 0.8,
    least: float = 0.55,
    most: float = 0.999,
    rounds: int = 200,
) -> LabelModel:
    """Fits to counted vote patterns, whose number depends on the labelers and not on the rows.

    Labelers are taken to err independently, for either class alike, and to be right more often
    than wrong (``least``), which fixes the meaning of the classes. A labeler that never votes
    keeps ``start``. Without patterns the model is the starting point.
    """
    model = LabelModel(prior, (start,) * labelers)
    ordered = sorted(patterns.items())
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        yes = 0.0
        right, voted = [0.0] * labelers, [0.0] * labelers
        for votes, n in ordered:
            p = model.posterior(votes)
            yes += n * p
            for i, vote in enumerate(votes):
                if vote != ABSTAIN:
                    voted[i] += n
                    right[i] += n * (p if vote == YES else 1 - p)
        accuracy = tuple(
            min(most, max(least, (r + start) / (v + 1))) if v else start
            for r, v in zip(right, voted, strict=True)
        )
        new = LabelModel(min(0.999, max(0.001, (yes + prior) / (total + 1))), accuracy)
        moved = max(abs(a - b) for a, b in zip((new.prior, *new.accuracy), (model.prior, *model.accuracy), strict=True))
        model = new
        if moved < 1e-9:
            break
    return model


@dataclass(frozen=True)
class ConditionalModel:
    """Prior of the positive class, and how often each labeler casts each vote for either class."""

    prior: float
    rates: tuple[dict[str, tuple[float, float]], ...]

    def posterior(self, votes: str) -> float:
        odds = log(self.prior / (1 - self.prior))
        for vote, rate in zip(votes, self.rates, strict=True):
            yes, no = rate[vote]
            odds += log(yes / no)
        return 1 / (1 + exp(-max(-500.0, min(500.0, odds))))


def fit_conditional(
    patterns: dict[str, int],
    labelers: int,
    rounds: int = 300,
    belief: dict[str, tuple[float, float]] | None = None,
    weight: float = 0.1,
) -> ConditionalModel:
    """Fits vote rates by class, so that a labeler that says the same of nearly all tells little.

    Starts from the number of votes against, which fixes the meaning of the classes: none is
    nearly sure for, two or more are nearly sure against. Rates are smoothed by one pseudo-vote.
    Without patterns the model is indifferent.

    With ``belief``, the rates by class that each vote is expected to have, the start is what they
    say, and they count as ``weight`` of the votes more. Rates and prior are then the most probable
    ones instead of the likeliest, so a corpus in which one class is rare or missing doesn't split
    the other.
    """
    total = sum(patterns.values())
    ordered = sorted(patterns.items())
    held = weight * total + 1
    if belief:
        believed = ConditionalModel(0.5, (belief,) * labelers)
        chance = {v: believed.posterior(v) for v in patterns}
    else:
        chance = {v: {0: 0.98, 1: 0.6}.get(v.count(NO), 0.05) for v in patterns}
    model = ConditionalModel(0.5, ({v: (1.0, 1.0) for v in (NO, ABSTAIN, YES)},) * labelers)
    for _ in range(rounds if total else 0):
        yes = sum(n * chance[v] for v, n in ordered)
        rates = []
        for i in range(labelers):
            rate = {}
            for vote in (NO, ABSTAIN, YES):
                cast = [(n, chance[v]) for v, n in ordered if v[i] == vote]
                more, of = ([held * b for b in belief[vote]], held) if belief else ((1, 1), 3)
                rate[vote] = (
                    (sum(n * p for n, p in cast) + more[0]) / (yes + of),
                    (sum(n * (1 - p) for n, p in cast) + more[1]) / (total - yes + of),
                )
            rates.append(rate)
        share = (yes + held / 2) / (total + held) if belief else yes / total
        model = ConditionalModel(min(0.999, max(0.001, share)), tuple(rates))
        new = {v: model.posterior(v) for v in patterns}
        moved = max(abs(new[v] - chance[v]) for v in patterns)
        chance = new
        if moved < 1e-9:
            break
    return model
