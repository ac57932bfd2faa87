"""The minimum of the positive-unlabelled risk against the closed form and the rows themselves."""

import dataclasses

import numpy as np
import pytest

from strata.llm import quality_pu as Q


def rows(seed, positives):
    rng = np.random.default_rng(seed)
    label = rng.random(600) < 0.4
    phi = rng.normal(0, 0.5, (600, Q.SIZE)) + 0.6 * label[:, None] * (np.arange(Q.SIZE) % 3 == 0)
    phi[:, 0] = 1.0
    chosen = phi[label][:positives]
    return phi, chosen


def risk(phi, chosen, w, prior):
    """(positive part, negative part) as means over the rows."""
    score = lambda x: (x * w).sum(axis=1)
    plus, minus = lambda g: ((1 - g) ** 2 / 4).mean(), lambda g: ((1 + g) ** 2 / 4).mean()
    return prior * plus(score(chosen)), minus(score(phi)) - prior * minus(score(chosen))


@pytest.mark.parametrize("seed", [1, 2])
def test_weights_are_those_of_the_closed_form_where_the_risk_is_not_negative(seed):
    phi, chosen = rows(seed, 200)
    # A strong ridge keeps the scorer from fitting the rows so well that the negative part is below zero.
    prior, s = 0.4, dataclasses.replace(Q.Settings(), ridge=1.0)
    u, p = (phi.T[:, None] * phi.T[None]).sum(2), (chosen.T[:, None] * chosen.T[None]).sum(2)
    w = Q.minimise(u, p, prior, s)
    u, p = u / u[0, 0], p / p[0, 0]
    best = (Q._inverse(u + s.ridge * np.eye(Q.SIZE)) * (2 * prior * p[0] - u[0])).sum(axis=1)
    assert risk(phi, chosen, best, prior)[1] > 0
    assert np.abs(w - best).max() < 1e-3
    total = sum(risk(phi, chosen, w, prior))
    rng = np.random.default_rng(seed)
    for _ in range(50):
        other = w + rng.normal(0, 0.05, Q.SIZE)
        penalty = s.ridge * ((other**2).sum() - (w**2).sum()) / 4
        assert total <= sum(risk(phi, chosen, other, prior)) + penalty + 1e-9


def test_a_few_positives_far_out_do_not_make_the_steps_grow_without_end():
    phi, chosen = rows(3, 5)
    u, p = (phi.T[:, None] * phi.T[None]).sum(2), (chosen.T[:, None] * chosen.T[None]).sum(2)
    w = Q.minimise(u, p, 0.9, Q.Settings())
    assert np.isfinite(w).all()
    positive, negative = risk(phi, chosen, w, 0.9)
    assert positive + max(negative, 0) <= sum(risk(phi, chosen, np.zeros(Q.SIZE), 0.9))
    assert (w != 0).any()


def test_nothing_to_learn_from():
    none, some = np.zeros((Q.SIZE, Q.SIZE)), np.eye(Q.SIZE)
    for u, p in ((none, none), (some, none), (none, some)):
        assert (Q.minimise(u, p, 0.5, Q.Settings()) == 0).all()
