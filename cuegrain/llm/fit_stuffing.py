"""Fits the two models of stuffing.py on a bounded sample of labelled pages.

A label is the share of a clause's visible characters that belong to a list. The first
model has coverage and form alone and decides which clauses teach; the second has the
learned weights besides.
"""

from __future__ import annotations

import numpy as np

from . import stuffing

#: Pages that the models are fitted on.
SAMPLE_PAGES = 2_000


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 2e-4) -> np.ndarray:
    """Coefficients by Newton's steps; y from 0 to 1."""
    out, total = np.zeros(x.shape[1]), weight.sum()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * total * out
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * total * np.eye(len(out))
        out += np.linalg.solve(curve, slope)
    return out


def balanced(clauses: stuffing.Clauses, y: np.ndarray) -> np.ndarray:
    """Weights by which every page counts once, and lists and sentences alike."""
    whole = np.maximum(np.bincount(clauses.page, clauses.shown, clauses.pages), 1)
    weight = clauses.shown / whole[clauses.page]
    return weight * (y / max((weight * y).sum(), 1e-9) + (1 - y) / max((weight * (1 - y)).sum(), 1e-9)) * len(y) / 2


def fit(texts: list[str], label) -> tuple[np.ndarray, np.ndarray]:
    """(FIRST, SECOND) of at most SAMPLE_PAGES pages; label: from the clauses of the texts to their labels."""
    if len(texts) > SAMPLE_PAGES:
        raise ValueError(f"at most {SAMPLE_PAGES} pages")
    clauses = stuffing.Clauses.of(texts)
    y = np.asarray(label(clauses), float)
    weight = balanced(clauses, y)
    first = logistic(clauses.features, y, weight)
    kept, stuffing.FIRST = stuffing.FIRST, first
    try:
        unit, a, b, sentences, lists = clauses.teach()
    finally:
        stuffing.FIRST = kept
    common = a + b >= stuffing.LEAST_SHARE * (sentences + lists)
    known = stuffing.Learned.from_counts(unit[common], a[common], b[common], sentences, lists)
    second = logistic(np.concatenate([clauses.features, stuffing.glue(clauses.page, clauses.unit_clause, clauses.unit, known)[:, :2]], 1), y, weight)
    return first, second
