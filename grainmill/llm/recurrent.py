"""A bidirectional LSTM that labels every element of a sequence, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Hash spaces and widths of path and word vectors, plain numbers of a block, width of a direction.
PATHS, PATH_WIDTH, WORDS, WORD_WIDTH, NUMBERS, HIDDEN = 1 << 12, 12, 1 << 12, 6, 7, 16
INPUT = PATH_WIDTH + WORD_WIDTH + NUMBERS


@dataclass
class Sequence:
    """The blocks of a page: hashed path and word features, flat with their numbers, and plain numbers."""

    paths: np.ndarray
    path_sizes: np.ndarray
    words: np.ndarray
    word_sizes: np.ndarray
    numbers: np.ndarray


def initial(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    weights = {"paths": rng.normal(0, 0.3, (PATHS, PATH_WIDTH)), "words": rng.normal(0, 0.1, (WORDS, WORD_WIDTH))}
    for way in ("ahead", "back"):
        weights[f"{way}_in"] = rng.normal(0, INPUT**-0.5, (INPUT, 4 * HIDDEN))
        weights[f"{way}_state"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        weights[f"{way}_bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
    weights["out"] = rng.normal(0, HIDDEN**-0.5, (2 * HIDDEN + INPUT, 1))
    weights["out_bias"] = np.zeros(1)
    return weights


def _means(vectors: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out, full = np.zeros((len(sizes), vectors.shape[1])), sizes > 0
    if full.any():
        out[full] = np.add.reduceat(vectors[flat], (np.cumsum(sizes) - sizes)[full], axis=0) / sizes[full, None]
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x: np.ndarray, mask: np.ndarray, weights: dict, way: str, keep: bool):
    """States of one direction over `x[time, sequence, input]`; places beyond a sequence's end keep the state."""
    steps = range(len(x)) if way == "ahead" else range(len(x) - 1, -1, -1)
    h = c = np.zeros((x.shape[1], HIDDEN))
    drive = x @ weights[f"{way}_in"] + weights[f"{way}_bias"]
    states, trace = np.zeros((*x.shape[:2], HIDDEN)), []
    for t in steps:
        gates = drive[t] + h @ weights[f"{way}_state"]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        new_c = f * c + i * g
        squashed = np.tanh(new_c)
        on = mask[t][:, None]
        if keep:
            trace.append((t, i, f, o, g, c, squashed, h, on))
        c = np.where(on, new_c, c)
        h = np.where(on, o * squashed, h)
        states[t] = h
    return states, trace


def _unroll(grads: np.ndarray, x: np.ndarray, trace: list, weights: dict, way: str):
    """Gradients of one direction's weights and of its input, from those of its states."""
    d_h = d_c = np.zeros(grads.shape[1:])
    d_drive = np.zeros((*x.shape[:2], 4 * HIDDEN))
    d_state = np.zeros_like(weights[f"{way}_state"])
    for t, i, f, o, g, c, squashed, h, on in reversed(trace):
        total = d_h + grads[t]
        inner = d_c + total * o * (1 - squashed**2)
        gates = np.concatenate((inner * g * i * (1 - i), inner * c * f * (1 - f), total * squashed * o * (1 - o), inner * i * (1 - g**2)), axis=1)
        gates = np.where(on, gates, 0)
        d_drive[t] = gates
        d_state += h.T @ gates
        d_h = np.where(on, gates @ weights[f"{way}_state"].T, total)
        d_c = np.where(on, inner * f, d_c)
    flat = d_drive.reshape(-1, 4 * HIDDEN)
    return {f"{way}_in": x.reshape(-1, INPUT).T @ flat, f"{way}_state": d_state, f"{way}_bias": flat.sum(axis=0)}, d_drive @ weights[f"{way}_in"].T


def _batch(pages: list[Sequence], weights: dict):
    """Inputs `[time, page, input]` with their mask, and the flat features behind them."""
    sizes = np.array([len(p.path_sizes) for p in pages])
    mask = np.arange(sizes.max())[:, None] < sizes
    paths, path_sizes = np.concatenate([p.paths for p in pages]), np.concatenate([p.path_sizes for p in pages])
    words, word_sizes = np.concatenate([p.words for p in pages]), np.concatenate([p.word_sizes for p in pages])
    rows = np.concatenate(
        (_means(weights["paths"], paths, path_sizes), _means(weights["words"], words, word_sizes), np.concatenate([p.numbers for p in pages])), axis=1
    )
    at = (np.concatenate([np.arange(n) for n in sizes]), np.repeat(np.arange(len(pages)), sizes))
    x = np.zeros((*mask.shape, INPUT))
    x[at] = rows
    return x, mask, at, (paths, path_sizes, words, word_sizes)


def _forward(pages, weights, keep=False):
    x, mask, at, flat = _batch(pages, weights)
    ahead, ahead_trace = _run(x, mask, weights, "ahead", keep)
    back, back_trace = _run(x, mask, weights, "back", keep)
    joined = np.concatenate((ahead, back, x), axis=2)
    logits = (joined @ weights["out"])[..., 0] + weights["out_bias"][0]
    return logits, x, mask, at, flat, joined, (ahead_trace, back_trace)


def label(pages: list[Sequence], weights: dict, room: int = 1 << 15) -> list[np.ndarray]:
    """The logit of every block. Pages of like lengths are worked on together, `room` blocks with padding at a time."""
    out: list = [np.zeros(0)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if len(p.path_sizes)), key=lambda i: len(pages[i].path_sizes))
    while order:
        longest = len(pages[order[-1]].path_sizes)
        n = max(1, min(len(order), room // longest))
        part, order = order[-n:], order[:-n]
        logits, *_ = _forward([pages[i] for i in part], weights)
        for k, i in enumerate(part):
            out[i] = logits[: len(pages[i].path_sizes), k]
    return out


def train(pages: list[Sequence], targets: list[np.ndarray], rounds: int = 8, rate: float = 0.01, batch: int = 32, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights that label the blocks of `pages` like `targets`, by Adam on the cross-entropy."""
    weights = initial(seed)
    moments = {n: (np.zeros_like(w), np.zeros_like(w)) for n, w in weights.items()}
    rng, step = np.random.default_rng(seed), 0
    for _ in range(rounds):
        order = sorted(range(len(pages)), key=lambda i: (len(pages[i].path_sizes), rng.random()))
        groups = [order[k : k + batch] for k in range(0, len(order), batch)]
        for group in (groups[i] for i in rng.permutation(len(groups))):
            logits, x, mask, at, flat, joined, traces = _forward([pages[i] for i in group], weights, keep=True)
            wanted = np.zeros_like(logits)
            wanted[at] = np.concatenate([targets[i] for i in group])
            rest = np.where(mask, _sigmoid(logits) - wanted, 0)[..., None] / max(1, int(mask.sum()))
            grads = {"out": joined.reshape(-1, joined.shape[2]).T @ rest.reshape(-1, 1), "out_bias": rest.sum(axis=(0, 1))}
            d_joined = rest @ weights["out"].T
            d_x = d_joined[..., 2 * HIDDEN :].copy()
            for way, trace, part in (("ahead", traces[0], slice(0, HIDDEN)), ("back", traces[1], slice(HIDDEN, 2 * HIDDEN))):
                own, through = _unroll(d_joined[..., part], x, trace, weights, way)
                grads |= own
                d_x += through
            d_rows = d_x[at]
            for name, ids, sizes, columns in (
                ("paths", flat[0], flat[1], slice(0, PATH_WIDTH)),
                ("words", flat[2], flat[3], slice(PATH_WIDTH, PATH_WIDTH + WORD_WIDTH)),
            ):
                grads[name] = np.zeros_like(weights[name])
                np.add.at(grads[name], ids, np.repeat(d_rows[:, columns] / np.maximum(sizes, 1)[:, None], sizes, axis=0))
            step += 1
            for name, gradient in grads.items():
                first, second = moments[name]
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                weights[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights
