"""A bidirectional LSTM over sequences of sparse vectors, trained and run with NumPy.

Each item has three bags of hashed names. A bag becomes the mean (words) or scaled sum (others) of its names'
vectors; the three together are the item's vector. One LSTM reads the sequence from the front, another from
the back, and a logistic unit sees both states and the vector itself.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BUCKETS, WIDTH, HIDDEN = 1 << 12, 12, 16
BAGS = 3
INPUT = BAGS * WIDTH


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Weights:
    """Vectors of the buckets; per direction input, state and bias of the gates; the output unit."""

    arrays: dict[str, np.ndarray]

    @classmethod
    def fresh(cls, seed: int) -> Weights:
        draw = np.random.default_rng(seed)
        arrays = {"names": draw.normal(0, 0.3, (BUCKETS, WIDTH)), "out": draw.normal(0, 0.1, 2 * HIDDEN + INPUT), "out_bias": np.zeros(1)}
        for way in ("front", "back"):
            arrays[f"{way}_in"] = draw.normal(0, INPUT**-0.5, (INPUT, 4 * HIDDEN))
            arrays[f"{way}_state"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
            arrays[f"{way}_bias"] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
        return cls({name: array.astype(np.float32) for name, array in arrays.items()})


def bag_sums(vectors: np.ndarray, buckets: np.ndarray, owners: np.ndarray, count: int, chunk: int = 1 << 18) -> np.ndarray:
    """Sum of the buckets' vectors per owner; ``owners`` must not fall. Gathers a bounded stretch at a time."""
    total = np.zeros((count, vectors.shape[1]), np.float32)
    for begin in range(0, len(buckets), chunk):
        owner = owners[begin : begin + chunk]
        starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sums = np.add.reduceat(vectors[buckets[begin : begin + chunk]], starts, axis=0)
        total[owner[starts]] += sums
    return total


def states(pre: np.ndarray, recurrent: np.ndarray, firsts: np.ndarray, lengths: np.ndarray, backwards: bool, keep: bool = False):
    """States after each item, and with ``keep`` what the way back needs.

    ``pre`` holds the gates' input part for all items of all sequences end to end. All sequences step
    together, longest first, so those that have ended drop off the end.
    """
    order = np.argsort(-lengths, kind="stable")
    firsts, lengths = firsts[order], lengths[order]
    hidden, cell = np.zeros((len(order), HIDDEN), np.float32), np.zeros((len(order), HIDDEN), np.float32)
    out, kept = np.zeros((len(pre), HIDDEN), np.float32), []
    active = len(order)
    for step in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= step:
            active -= 1
        at = firsts[:active] + (lengths[:active] - 1 - step if backwards else step)
        before, was = hidden[:active], cell[:active]
        gates = pre[at] + before @ recurrent
        gates[:, : 3 * HIDDEN] = sigmoid(gates[:, : 3 * HIDDEN])
        gates[:, 3 * HIDDEN :] = np.tanh(gates[:, 3 * HIDDEN :])
        enter, forget, leave, new = (gates[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(4))
        now = forget * was + enter * new
        bent = np.tanh(now)
        if keep:
            kept.append((at, before.copy(), was.copy(), gates, bent))
        hidden[:active], cell[:active] = leave * bent, now
        out[at] = hidden[:active]
    return out, kept


def _state_gradients(kept: list, recurrent: np.ndarray, wanted: np.ndarray, pre_gradient: np.ndarray) -> np.ndarray:
    """Gradient of the recurrent weights; fills the gradient of ``pre``."""
    gradient = np.zeros_like(recurrent)
    above = left = np.zeros((0, HIDDEN), np.float32)
    for at, before, was, gates, bent in reversed(kept):
        more = np.zeros((len(at) - len(above), HIDDEN), np.float32)
        up, cell = wanted[at] + np.vstack([above, more]), np.vstack([left, more])
        enter, forget, leave, new = (gates[:, i * HIDDEN : (i + 1) * HIDDEN] for i in range(4))
        cell = cell + up * leave * (1 - bent**2)
        change = np.hstack([
            cell * new * enter * (1 - enter), cell * was * forget * (1 - forget), up * bent * leave * (1 - leave), cell * enter * (1 - new**2),
        ])
        pre_gradient[at] = change
        gradient += before.T @ change
        above, left = change @ recurrent.T, cell * forget
    return gradient


def scores(weights: Weights, items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log-odds of every item, for sequences of the given lengths end to end."""
    w = weights.arrays
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)
    some = lengths > 0
    seen = [
        states(items @ w[f"{way}_in"] + w[f"{way}_bias"], w[f"{way}_state"], firsts[some], lengths[some], way == "back")[0]
        for way in ("front", "back")
    ]
    return np.hstack([*seen, items]) @ w["out"] + w["out_bias"]


@dataclass
class Example:
    """One sequence: per bag the buckets and the item each belongs to, and the items' labels."""

    bags: list[tuple[np.ndarray, np.ndarray]]
    labels: np.ndarray


def scale_of(bag: int, counts: np.ndarray) -> np.ndarray:
    """What a bag's sum is divided by: the last bag, words, has means, the others are scaled by roots."""
    counts = np.maximum(counts, 1).astype(np.float32)[:, None]
    return counts if bag == BAGS - 1 else np.sqrt(counts)


def train(examples: list[Example], seed: int, epochs: int, batch: int = 32, rate: float = 0.015, drop: float = 0.3) -> Weights:
    """Weights by Adam on the logistic loss. A share of the names is left out anew for each step."""
    draw, weights = np.random.default_rng(seed), Weights.fresh(seed)
    first = {name: np.zeros_like(array) for name, array in weights.arrays.items()}
    second = {name: np.zeros_like(array) for name, array in weights.arrays.items()}
    step = 0
    steps = epochs * -(-len(examples) // batch)
    for _ in range(epochs):
        order = draw.permutation(len(examples))
        for begin in range(0, len(order), batch):
            gradients = _gradients(weights, [examples[i] for i in order[begin : begin + batch]], draw, drop)
            step += 1
            pace = rate * (1 - step / steps) + rate / 50
            for name, gradient in gradients.items():
                first[name] = 0.9 * first[name] + 0.1 * gradient
                second[name] = 0.99 * second[name] + 0.01 * gradient**2
                hat, spread = first[name] / (1 - 0.9**step), second[name] / (1 - 0.99**step)
                weights.arrays[name] -= (pace * hat / (np.sqrt(spread) + 1e-8)).astype(np.float32)
    return weights


def _gradients(weights: Weights, examples: list[Example], draw: np.random.Generator, drop: float) -> dict[str, np.ndarray]:
    w = weights.arrays
    lengths = np.array([len(e.labels) for e in examples])
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    labels = np.concatenate([e.labels for e in examples])
    bags, parts = [], []
    for bag in range(BAGS):
        buckets = np.concatenate([e.bags[bag][0] for e in examples])
        owners = np.concatenate([e.bags[bag][1] + f for e, f in zip(examples, firsts)])
        stay = draw.random(len(buckets)) >= drop
        buckets, owners = buckets[stay], owners[stay]
        scale = scale_of(bag, np.bincount(owners, minlength=len(labels)))
        bags.append((buckets, owners, scale))
        parts.append(bag_sums(w["names"], buckets, owners, len(labels)) / scale)
    items = np.hstack(parts)
    runs = {
        way: states(items @ w[f"{way}_in"] + w[f"{way}_bias"], w[f"{way}_state"], firsts, lengths, way == "back", keep=True)
        for way in ("front", "back")
    }
    seen = np.hstack([runs["front"][0], runs["back"][0], items])
    error = ((sigmoid(seen @ w["out"] + w["out_bias"]) - labels) / len(labels)).astype(np.float32)
    gradients = {"out": seen.T @ error, "out_bias": np.array([error.sum()], np.float32)}
    wanted = np.outer(error, w["out"])
    item_gradient = wanted[:, 2 * HIDDEN :].copy()
    for i, way in enumerate(("front", "back")):
        pre = np.zeros((len(labels), 4 * HIDDEN), np.float32)
        gradients[f"{way}_state"] = _state_gradients(runs[way][1], w[f"{way}_state"], wanted[:, i * HIDDEN : (i + 1) * HIDDEN], pre)
        gradients[f"{way}_in"], gradients[f"{way}_bias"] = items.T @ pre, pre.sum(axis=0)
        item_gradient += pre @ w[f"{way}_in"].T
    names = np.zeros_like(w["names"])
    for bag, (buckets, owners, scale) in enumerate(bags):
        np.add.at(names, buckets, (item_gradient[:, bag * WIDTH : (bag + 1) * WIDTH] / scale)[owners])
    return gradients | {"names": names}
