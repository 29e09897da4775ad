"""A small bidirectional LSTM that labels sequences, in numpy."""

from __future__ import annotations

import numpy as np

HIDDEN, RATE, PASSES, TOGETHER = 20, 0.012, 12, 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_model(width: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Weights of both directions, and of the label, which also sees the input itself."""
    rng = np.random.default_rng(seed)
    model = {}
    for side in "fb":
        model[f"x{side}"] = rng.normal(0, 1 / np.sqrt(width), (width, 4 * HIDDEN)).astype(np.float32)
        model[f"h{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        model[f"b{side}"] = np.zeros(4 * HIDDEN, np.float32)
        model[f"b{side}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        model[f"w{side}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32)
    model["wx"], model["w1"] = np.zeros(width, np.float32), np.zeros(1, np.float32)
    return model


def _run(model: dict, side: str, x: np.ndarray, mask: np.ndarray, keep: bool):
    """States of one direction for x (time, sequence, input); with keep also what training needs."""
    steps, n, _ = x.shape
    given = (x.reshape(steps * n, -1) @ model[f"x{side}"]).reshape(steps, n, -1) + model[f"b{side}"]
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    states, kept = np.zeros((steps, n, HIDDEN), np.float32), []
    for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
        gates = given[t] + h @ model[f"h{side}"]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        on = mask[t][:, None]
        new = (f * c + i * g) * on
        squashed = np.tanh(new)
        if keep:
            kept.append((t, i, f, o, g, h, c, squashed))
        h, c = o * squashed * on, new
        states[t] = h
    return states, kept


def logits(model: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    forward, _ = _run(model, "f", x, mask, False)
    back, _ = _run(model, "b", x, mask, False)
    return forward @ model["wf"] + back @ model["wb"] + x @ model["wx"] + model["w1"]


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as (time, sequence, input) with a mask."""
    steps = max(len(s) for s in sequences)
    x = np.zeros((steps, len(sequences), sequences[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(sequences)), np.float32)
    for k, s in enumerate(sequences):
        x[: len(s), k], mask[: len(s), k] = s, 1
    return x, mask


def _gradients(model: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross entropy, back through time."""
    grads, flat = {}, x.reshape(-1, x.shape[2])
    runs = {side: _run(model, side, x, mask, True) for side in "fb"}
    score = runs["f"][0] @ model["wf"] + runs["b"][0] @ model["wb"] + x @ model["wx"] + model["w1"]
    error = ((_sigmoid(score) - y) * mask / mask.sum()).astype(np.float32)
    grads["wx"], grads["w1"] = flat.T @ error.ravel(), error.sum(keepdims=True).ravel()
    for side, name in (("f", "wf"), ("b", "wb")):
        states, kept = runs[side]
        grads[name] = states.reshape(-1, HIDDEN).T @ error.ravel()
        down = error[:, :, None] * model[name]
        inner = np.zeros((*error.shape, 4 * HIDDEN), np.float32)
        grads[f"h{side}"] = np.zeros_like(model[f"h{side}"])
        dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t, i, f, o, g, h, c, squashed in reversed(kept):
            on = mask[t][:, None]
            dh = (dh + down[t]) * on
            dc = (dc + dh * o * (1 - squashed**2)) * on
            inner[t] = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            grads[f"h{side}"] += h.T @ inner[t]
            dh, dc = inner[t] @ model[f"h{side}"].T, dc * f
        grads[f"x{side}"] = flat.T @ inner.reshape(-1, 4 * HIDDEN)
        grads[f"b{side}"] = inner.sum(axis=(0, 1))
    return grads


def fit(sequences: list[np.ndarray], labels: list[np.ndarray], seed: int = 7) -> dict[str, np.ndarray]:
    """Train by Adam on whole sequences, in batches of similar length."""
    model = new_model(sequences[0].shape[1], seed)
    rng = np.random.default_rng(seed)
    order = sorted(range(len(sequences)), key=lambda k: len(sequences[k]))
    groups = [order[at : at + TOGETHER] for at in range(0, len(order), TOGETHER)]
    batches = []
    for group in groups:
        x, mask = padded([sequences[k] for k in group])
        y, _ = padded([labels[k][:, None] for k in group])
        batches.append((x, mask, y[:, :, 0]))
    first, second = ({k: np.zeros_like(v) for k, v in model.items()} for _ in range(2))
    step = 0
    for turn in range(PASSES):
        rate = RATE * (1 - turn / PASSES) + 0.001
        for b in rng.permutation(len(batches)):
            step += 1
            for k, g in _gradients(model, *batches[b]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                fixed = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                model[k] = (model[k] - rate * fixed).astype(np.float32)
    return model
