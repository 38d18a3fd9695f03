"""A semi-Markov conditional random field over short runs of text.

A run is cut into tokens (letters, digits, or one other character).  A candidate segment
is a stretch of tokens of at most ``LONGEST`` tokens; its features look at the whole span.  A segmentation labels segments with an entity kind, and each
token outside of them with ``O``.  Its score is the sum of its segments' scores and of
the transitions between labels; dynamic programming over segment ends sums or maximises
over all segmentations, so boundaries and kinds are chosen together.
"""

from __future__ import annotations

import re

import numpy as np

LABELS = ("O", "email", "ip", "card", "phone")
#: Tokens of an entity at most, characters of it at most.
LONGEST, WIDEST = 24, 96
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\Z")
_DIGITS = (6, 8, 10, 12, 14, 15, 16, 19)
#: Names of the features of a span; the last is the number of tokens.
FEATURES = (
    "bias", *[f"digits<={n}" for n in _DIGITS], "digits more", "luhn", "plus", "parentheses", "quads", "dots", "blanks", "hyphens", "letters",
    "at", "mail", "ends alike", "glued before", "glued after", "edge", "one token", "tokens",
)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def tokens(run: str) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(run)]


def features(run: str, start: int, end: int, n: int) -> list[float]:
    span = run[start:end]
    digits = "".join(c for c in span if "0" <= c <= "9")
    place = next((i for i, most in enumerate(_DIGITS) if len(digits) <= most), len(_DIGITS))
    quads = span.split(".")
    near = lambda c: c.isalnum() or c in "@_"
    return [
        1.0, *[float(i == place) for i in range(len(_DIGITS) + 1)],
        float(13 <= len(digits) <= 19 and luhn(digits)), float(span[0] == "+"), float("(" in span and ")" in span),
        float(len(quads) == 4 and all(q.isdecimal() and len(q) <= 3 and int(q) <= 255 for q in quads)),
        float("." in span), float(" " in span), float("-" in span), float(any(c.isalpha() for c in span)),
        float("@" in span), float(_MAIL.match(span) is not None), float(span[0].isalnum() and span[-1].isalnum()),
        float(start > 0 and near(run[start - 1]) and near(span[0])), float(end < len(run) and near(run[end]) and near(span[-1])),
        float(not (span[0].isalnum() or span[0] in "+(") or not (span[-1].isalnum() or span[-1] == ")")), float(n == 1), n / LONGEST,
    ]


def possible(span: str, n: int) -> tuple[bool, ...]:
    """Which labels a span of ``n`` tokens may have at all: ``O`` is for single tokens, and each kind has its bare minimum."""
    digits, letters = len([c for c in span if "0" <= c <= "9"]), any(c.isalpha() for c in span)
    quads = span.split(".")
    return (
        n == 1, span.count("@") == 1 and len(span) > 4, len(quads) == 4 and all(q.isdecimal() and int(q[-9:]) <= 255 for q in quads),
        not letters and 13 <= digits <= 19, not letters and "@" not in span and 7 <= digits <= 15,
    )


class Lattice:
    """The candidate segments of one run: ``O`` for every token, and every stretch that may be an entity."""

    def __init__(self, run: str):
        self.tokens = tokens(run)
        segments, rows = [], []
        for i, (start, _) in enumerate(self.tokens):
            for j in range(i, min(i + LONGEST, len(self.tokens))):
                end = self.tokens[j][1]
                if end - start > WIDEST or "\n" in run[start:end]:
                    break
                if j == i or run[start:end].count("@") == 1 or not any(c.isalpha() for c in run[start:end]):
                    segments.append((i, j + 1))
                    rows.append(features(run, start, end, j + 1 - i))
        self.segments = segments
        self.rows = np.array(rows).reshape(-1, len(FEATURES))
        self.allowed = np.array([possible(run[self.tokens[a][0] : self.tokens[b - 1][1]], b - a) for a, b in segments]).reshape(-1, len(LABELS))
        self.starts, self.ends = (np.array([seg[k] for seg in segments], np.int64) for k in (0, 1))
        n = len(self.tokens)
        self.ending = [np.flatnonzero(self.ends == b) for b in range(n + 1)]
        self.starting = [np.flatnonzero(self.starts == a) for a in range(n)]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """A row per segment, a column per label."""
        return np.where(self.allowed, self.rows @ weights, -np.inf)


def _sum(values: np.ndarray, axis: int = 0) -> np.ndarray:
    """The logarithm of the sum of exponentials."""
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return top.squeeze(axis) + np.log(np.exp(values - top).sum(axis=axis))


def forward(lattice: Lattice, scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Per boundary and last label the log sum over all segmentations that end there."""
    alpha = np.full((len(lattice.tokens) + 1, len(LABELS)), -np.inf)
    alpha[0, 0] = 0
    for b, own in enumerate(lattice.ending[1:], 1):
        alpha[b] = _sum(_sum(alpha[lattice.starts[own]][:, :, None] + moves, 1) + scores[own])
    return alpha


def best_path(lattice: Lattice, scores: np.ndarray, moves: np.ndarray) -> list[tuple[int, int]]:
    """Segment and label of the highest-scoring segmentation's entities."""
    n = len(lattice.tokens)
    alpha = np.full((n + 1, len(LABELS)), -np.inf)
    alpha[0, 0] = 0
    back = {}
    for b, own in enumerate(lattice.ending[1:], 1):
        into = alpha[lattice.starts[own]][:, :, None] + moves
        table = into.max(axis=1) + scores[own]
        which = table.argmax(axis=0)
        alpha[b] = table.max(axis=0)
        for label, w in enumerate(which):
            back[b, label] = int(own[w]), int(into[w, :, label].argmax())
    b, label, path = n, int(alpha[n].argmax()), []
    while b > 0:
        s, before = back[b, label]
        if label:
            path.append((s, label))
        b, label = int(lattice.starts[s]), before
    return path[::-1]


def backward(lattice: Lattice, scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    n = len(lattice.tokens)
    beta = np.full((n + 1, len(LABELS)), -np.inf)
    beta[n] = 0
    for a in range(n - 1, -1, -1):
        own = lattice.starting[a]
        beta[a] = _sum(_sum(moves[None] + (scores[own] + beta[lattice.ends[own]])[:, None, :], 2))
    return beta


class Model:
    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def decode(self, run: str, certain: float) -> list[tuple[str, int, int]]:
        """Entities of the best segmentation whose probability is ``certain`` or more."""
        lattice = Lattice(run)
        if not lattice.tokens:
            return []
        scores = lattice.scores(self.weights)
        path = best_path(lattice, scores, self.moves)
        if not path:
            return []
        alpha, beta = forward(lattice, scores, self.moves), backward(lattice, scores, self.moves)
        total, out = _sum(alpha[-1]), []
        for s, label in path:
            a, b = lattice.segments[s]
            p = np.exp(_sum(alpha[a] + self.moves[:, label]) + scores[s, label] + beta[b, label] - total)
            if p >= certain:
                out.append((LABELS[label], lattice.tokens[a][0], lattice.tokens[b - 1][1]))
        return out


def _gold(lattice: Lattice, entities: list[tuple[str, int, int]]) -> list[tuple[int, int, int]]:
    """Segment, label before, label.  Entities that do not end at tokens, or lie over each other, are left out."""
    begins, ends = ({t[k]: i for i, t in enumerate(lattice.tokens)} for k in (0, 1))
    index, known = {seg: i for i, seg in enumerate(lattice.segments)}, {}
    for kind, s, e in entities:
        if s in begins and e in ends:
            known.setdefault(begins[s], (ends[e] + 1, LABELS.index(kind)))
    at, before, gold = 0, 0, []
    while at < len(lattice.tokens):
        to, label = known.get(at, (at + 1, 0))
        if (at, to) not in index or not lattice.allowed[index[at, to], label]:
            to, label = at + 1, 0
        gold.append((index[at, to], before, label))
        at, before = to, label
    return gold


def train(
    runs: list[tuple[str, list[tuple[str, int, int]]]], rounds: int = 10, rate: float = 0.5, decay: float = 1e-4, hide: float = 0.2, seed: int = 7,
) -> Model:
    """Stochastic ascent of the likelihood of runs with their entities.

    At each step a share ``hide`` of the features is left out.
    """
    weights, moves = np.zeros((len(FEATURES), len(LABELS))), np.zeros((len(LABELS), len(LABELS)))
    data = [(lattice, _gold(lattice, entities)) for run, entities in runs if (lattice := Lattice(run)).tokens]
    if not data:
        weights[0, 0] = 10.0  # nothing learnt: all is O
    rng, square_w, square_m = np.random.default_rng(seed), np.full_like(weights, 1e-3), np.full_like(moves, 1e-3)
    for _ in range(rounds):
        for k in rng.permutation(len(data)):
            lattice, gold = data[k]
            shown = (rng.random(len(FEATURES)) >= hide).astype(float)
            shown[0] = 1 - hide
            scores = lattice.scores(weights * (shown / (1 - hide))[:, None])
            alpha, beta = forward(lattice, scores, moves), backward(lattice, scores, moves)
            # The probability of a segment with a label after each other label.
            p = np.exp(alpha[lattice.starts][:, :, None] + moves + (scores + beta[lattice.ends])[:, None, :] - _sum(alpha[-1]))
            grad_w, grad_m = -lattice.rows.T @ p.sum(axis=1), -p.sum(axis=0)
            for s, before, label in gold:
                grad_w[:, label] += lattice.rows[s]
                grad_m[before, label] += 1
            grad_w = grad_w * (shown / (1 - hide))[:, None] - decay * weights
            grad_m -= decay * moves
            square_w += grad_w**2
            square_m += grad_m**2
            weights += rate * grad_w / np.sqrt(square_w)
            moves += rate * grad_m / np.sqrt(square_m)
    return Model(weights, moves)
