"""Message passing of the skip-chain field against sums over all labellings."""

import itertools
from types import SimpleNamespace

import numpy as np
import pytest

from panelcast.llm import entities


def exact(graph, field):
    """Marginals by adding up the weight of every labelling."""
    look, step, skip = field
    n = len(graph.label)
    links = [(k, k + 1, step) for k in graph.beside] + [(a, b, skip) for a, b in zip(graph.earlier, graph.later)] + [(a, b, skip) for a, b in zip(graph.teller, graph.told)]
    total = np.zeros((n, entities.LABELS))
    for labels in itertools.product(range(entities.LABELS), repeat=n):
        if any(own and own != said for own, said in zip(graph.label, labels)):
            continue
        weight = sum(look[graph.look[i], s] for i, s in enumerate(labels) if not graph.label[i])
        weight += sum(table[labels[a], labels[b]] for a, b, table in links)
        for i, s in enumerate(labels):
            total[i, s] += np.exp(weight)
    return total / total.sum(axis=1, keepdims=True)


def made(rng, n, cycle):
    """A tree of neighbours and mentions, with one more link if ``cycle``."""
    beside, skips, root = [], [], list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
    rng.shuffle(pairs)
    for a, b in pairs:
        if find(a) != find(b):
            root[find(a)] = find(b)
            (beside if b == a + 1 and rng.random() < 0.6 else skips).append((a, b))
    if cycle:
        free = [p for p in pairs if p not in skips and p not in beside]
        skips += [tuple(p) for p in free[:1]]
    told = skips[len(skips) // 2 :]
    skips = skips[: len(skips) // 2]
    column = lambda rows, k: np.array([r[k] for r in rows], np.int64)
    label = np.where(rng.random(n) < 0.3, rng.integers(1, entities.LABELS, n), 0)
    return SimpleNamespace(
        label=label, look=rng.integers(0, 3, n), beside=column(beside, 0), earlier=column(skips, 0), later=column(skips, 1),
        teller=column(told, 0), told=column(told, 1), doc=np.zeros(n, np.int64), rounds=64,
    )


def tables(rng, strength):
    pair = lambda: rng.normal(size=(entities.LABELS, entities.LABELS)) * strength
    step, skip = pair(), pair()
    return np.log(rng.dirichlet(np.ones(entities.LABELS), 3)), step, skip + skip.T


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_posteriors_of_trees_are_exact(n):
    rng = np.random.default_rng(n)
    for _ in range(6):
        graph, field = made(rng, n, False), tables(rng, 1.0)
        assert entities.beliefs(graph, field) == pytest.approx(exact(graph, field), abs=2e-3)


def test_posteriors_of_circles_are_near(n=5):
    """With a circle, message passing is an approximation; weak links keep it close."""
    rng = np.random.default_rng(11)
    for _ in range(6):
        graph, field = made(rng, n, True), tables(rng, 0.4)
        assert entities.beliefs(graph, field) == pytest.approx(exact(graph, field), abs=0.06)


def test_texts_do_not_mix():
    rng = np.random.default_rng(2)
    field = tables(rng, 1.0)
    parts = [made(rng, 4, False) for _ in range(3)]
    whole = SimpleNamespace(rounds=64)
    for name in ("label", "look"):
        setattr(whole, name, np.concatenate([getattr(g, name) for g in parts]))
    for name in ("beside", "earlier", "later", "teller", "told"):
        setattr(whole, name, np.concatenate([getattr(g, name) + 4 * i for i, g in enumerate(parts)]))
    whole.doc = np.repeat(np.arange(3), 4)
    alone = np.concatenate([entities.beliefs(g, field) for g in parts])
    assert entities.beliefs(whole, field) == pytest.approx(alone, abs=1e-3)
