"""A generative model of noisy voters, learnt without labels.

Each voter answers a candidate with one of a few levels.  A hidden state stands behind the answers; some
states are matches, the others are not.  Given the state, voters answer independently.  With several
states on either side the model also holds correlations among voters: a retouched headline agrees in
words, rare words and numbers at once, a retold one in links and dates only.  Expectation maximisation
learns each state's share and each voter's behaviour in it from the counts of the distinct answer
patterns, of which there are at most the product of the voters' levels, so all candidates count and the
model's cost does not depend on their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS = 200
#: Weight of the starting tables against the answers, in candidates per state.
START_WEIGHT = 25.0


@dataclass
class State:
    """A hidden state: whether it is a match, its first share, and each voter's first level distribution.

    A level that starts at 0 is impossible in the state and stays so.
    """

    match: bool
    share: float
    tables: list[list[float]]


class LabelModel:
    def __init__(self, states: list[State]) -> None:
        self.states = states
        self.shares = np.array([s.share for s in states]) / sum(s.share for s in states)
        self.start = [np.array([np.array(s.tables[v]) / sum(s.tables[v]) for s in states]) for v in range(len(states[0].tables))]
        self.tables = [t.copy() for t in self.start]

    def fit(self, patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
        """patterns: rows of levels; counts: how many candidates answered so."""
        before = np.zeros((len(patterns), len(self.states)))
        for _ in range(ROUNDS):
            weights = self._states(patterns)
            held = weights * counts[:, None]
            self.shares = (held.sum(0) + START_WEIGHT) / (counts.sum() + START_WEIGHT * len(self.states))
            for v, start in enumerate(self.start):
                seen = (start > 0) * np.stack([np.bincount(patterns[:, v], held[:, k], start.shape[1]) for k in range(len(self.states))])
                self.tables[v] = (seen + START_WEIGHT * start) / (seen.sum(1, keepdims=True) + START_WEIGHT)
            if np.abs(weights - before).max(initial=0) < 1e-6:
                break
            before = weights
        return self

    def _states(self, patterns: np.ndarray) -> np.ndarray:
        log = np.log(self.shares)[None, :] + sum(np.log(t[:, patterns[:, v]].T + 1e-30) for v, t in enumerate(self.tables))
        p = np.exp(log - log.max(axis=1, keepdims=True, initial=-1e9))
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(match | pattern)."""
        return self._states(patterns)[:, [s.match for s in self.states]].sum(axis=1)
