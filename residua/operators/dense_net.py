"""A small dense autoencoder in NumPy: the per-batch arithmetic run inside Spark tasks, in the precision of its parameters.

Layout d-128-64-32-16-32-64-128-d. Encoder layers have no bias and are followed by batch normalisation and
ReLU (dropout after the first two while training); bottleneck and decoder use bias and ReLU; output is linear.

A wide one-hot block is never built, neither as input nor as output. Its weight rows are gathered on the way in; on the way out,
the squared error of a block is |o|^2 - 2 o[slot] + 1 for output o = h W + b, and |o|^2 = h W W' h' + 2 h W b' + |b|^2 needs only
the small matrix W W'. Gradients follow alike.
"""

from __future__ import annotations

import numpy as np

# Layer widths and training constants.
ENCODER_WIDTHS = (128, 64, 32)
BOTTLENECK = 16
DECODER_WIDTHS = (32, 64, 128)
DROPOUT = (0.2, 0.2, 0.0)
BN_MOMENTUM = 0.99
BN_EPSILON = 1e-3
LEARNING_RATE = 1e-3
ADAM_BETAS = (0.9, 0.999)
ADAM_EPSILON = 1e-7

Params = dict[str, np.ndarray]


def shapes(width: int) -> tuple[dict[str, tuple[int, ...]], dict[str, tuple[int, ...]]]:
    """Names and shapes of the trained parameters and of the batch-norm running statistics."""
    trained, running, fan_in = {}, {}, width
    for i, units in enumerate(ENCODER_WIDTHS):
        trained |= {f"enc{i}_w": (fan_in, units), f"enc{i}_gamma": (units,), f"enc{i}_beta": (units,)}
        running |= {f"enc{i}_mean": (units,), f"enc{i}_var": (units,)}
        fan_in = units
    for i, units in enumerate((BOTTLENECK, *DECODER_WIDTHS, width)):
        trained |= {f"dec{i}_w": (fan_in, units), f"dec{i}_b": (units,)}
        fan_in = units
    return trained, running


def initial(width: int, seed: int) -> tuple[Params, Params]:
    """Uniform Glorot weights, zero biases, unit batch-norm."""
    rng = np.random.default_rng(seed)
    trained_shapes, running_shapes = shapes(width)
    trained = {}
    for name, shape in trained_shapes.items():
        if name.endswith("_w"):
            limit = np.sqrt(6.0 / sum(shape))
            trained[name] = rng.uniform(-limit, limit, shape)
        else:
            trained[name] = np.full(shape, 1.0 if name.endswith("_gamma") else 0.0)
    running = {n: np.full(s, 1.0 if n.endswith("_var") else 0.0) for n, s in running_shapes.items()}
    return trained, running


def pack(groups: list[Params]) -> np.ndarray:
    return np.concatenate([a.ravel() for g in groups for a in g.values()])


def unpack(vector: np.ndarray, layouts: list[dict[str, tuple[int, ...]]]) -> list[Params]:
    groups, at = [], 0
    for layout in layouts:
        group = {}
        for name, shape in layout.items():
            size = int(np.prod(shape))
            group[name] = vector[at : at + size].reshape(shape).copy()
            at += size
        groups.append(group)
    return groups


def _first_layer(w: np.ndarray, z: np.ndarray, cat: np.ndarray | None) -> np.ndarray:
    """Scaled numbers times their weight rows plus one gathered weight row per seen category."""
    if cat is None:
        return z @ w
    h = z @ w[: z.shape[1]]
    for column in cat.T:
        seen = column >= 0
        h[seen] += w[column[seen]]
    return h


def forward(
    trained: Params, running: Params, z: np.ndarray, cat: np.ndarray | None, rng: np.random.Generator | None = None
) -> tuple[np.ndarray, list[dict]]:
    """Reconstruction and the tape for ``backward``; with ``rng`` in training mode, else inference.

    ``cat`` is ``None`` for rows that are already dense.
    """
    h, tape = hidden(trained, running, z, cat, rng)
    last = f"dec{len(DECODER_WIDTHS) + 1}"
    y = h @ trained[f"{last}_w"] + trained[f"{last}_b"]
    return y, [*tape, {"in": h, "gate": None}]


def hidden(
    trained: Params, running: Params, z: np.ndarray, cat: np.ndarray | None, rng: np.random.Generator | None = None
) -> tuple[np.ndarray, list[dict]]:
    """What the output layer reads, and the tape up to there."""
    tape, h = [], None
    for i, units in enumerate(ENCODER_WIDTHS):
        w = trained[f"enc{i}_w"]
        a = _first_layer(w, z, cat) if i == 0 else h @ w
        if rng is None:
            mean, var = running[f"enc{i}_mean"], running[f"enc{i}_var"]
            normal = a - mean
        else:
            mean = column_sums(a) / len(a)
            normal = a - mean
            var = np.einsum("ij,ij->j", normal, normal) / len(a)
            running[f"enc{i}_mean"] += (1 - BN_MOMENTUM) * (mean - running[f"enc{i}_mean"])
            running[f"enc{i}_var"] += (1 - BN_MOMENTUM) * (var - running[f"enc{i}_var"])
        inv = 1.0 / np.sqrt(var + BN_EPSILON)
        normal *= inv
        y = normal * trained[f"enc{i}_gamma"]
        y += trained[f"enc{i}_beta"]
        gate = y > 0
        if rng is not None and DROPOUT[i]:
            gate &= rng.random(y.shape, dtype=y.dtype.type) >= DROPOUT[i]
            gate = gate * y.dtype.type(1 / (1 - DROPOUT[i]))
        tape.append({"in": h, "normal": normal, "inv": inv, "gate": gate})
        h = y * gate
    for i in range(len(DECODER_WIDTHS) + 1):
        y = h @ trained[f"dec{i}_w"]
        y += trained[f"dec{i}_b"]
        gate = y > 0
        tape.append({"in": h, "gate": gate})
        h = np.maximum(y, 0, out=y)
    return h, tape


def backward(
    trained: Params, tape: list[dict], d_out: np.ndarray, training: bool
) -> tuple[Params, np.ndarray]:
    """Parameter gradients and the gradient at the first layer's pre-activation."""
    grads, d = {}, d_out
    n_enc = len(ENCODER_WIDTHS)
    for i in reversed(range(len(tape) - n_enc)):
        t = tape[n_enc + i]
        if t["gate"] is not None:
            d = d * t["gate"]
        grads[f"dec{i}_w"] = t["in"].T @ d
        grads[f"dec{i}_b"] = column_sums(d)
        d = d @ trained[f"dec{i}_w"].T
    for i in reversed(range(n_enc)):
        t = tape[i]
        d = d * t["gate"]
        gamma = trained[f"enc{i}_gamma"]
        along, total = np.einsum("ij,ij->j", d, t["normal"]), column_sums(d)
        grads[f"enc{i}_gamma"], grads[f"enc{i}_beta"] = along, total
        if training:  # what the mean and the variance take out of the gradient
            d = d - total / len(d)
            d -= t["normal"] * (along / len(d))
        d = d * (gamma * t["inv"])
        if i:
            grads[f"enc{i}_w"] = t["in"].T @ d
            d = d @ trained[f"enc{i}_w"].T
    return grads, d


def column_sums(a: np.ndarray) -> np.ndarray:
    """The sum of every column, as a product: several times faster than a reduction over short rows."""
    return np.ones(len(a), a.dtype) @ a


def residual(out: np.ndarray, z: np.ndarray, cat: np.ndarray) -> np.ndarray:
    """Reconstruction minus the one-hot encoded input, without building the input."""
    e = out.copy()
    e[:, : z.shape[1]] -= z
    for column in cat.T:
        seen = np.flatnonzero(column >= 0)
        e[seen, column[seen]] -= 1.0
    return e


def slot_sums(slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slots seen, ascending, and the sum of the rows of ``values`` of each; slots below 0 are none."""
    order = np.argsort(slots, kind="stable")
    order = order[slots[order] >= 0]
    seen, first = np.unique(slots[order], return_index=True)
    return seen, np.add.reduceat(values[order], first, axis=0) if len(seen) else values[:0]


def gradients(
    trained: Params, running: Params, z: np.ndarray, cat: np.ndarray, rng: np.random.Generator, dense: int = 2048
) -> tuple[float, Params]:
    """Batch loss and its parameter gradients in training mode; output layers wider than ``dense`` are not written out."""
    width = len(trained["enc0_w"])
    if width <= dense:
        out, tape = forward(trained, running, z, cat, rng)
        e = residual(out, z, cat)
        grads, d_first = backward(trained, tape, 2.0 * e / e.size, training=True)
        loss = float(np.mean(np.square(e)))
    else:
        h, tape = hidden(trained, running, z, cat, rng)
        squared, grads, d = block_output(trained, h, z, cat)
        scale = 1.0 / squared.size / width
        more, d_first = backward(trained, tape, d * (2.0 * scale), training=True)
        grads = {n: g * (2.0 * scale) for n, g in grads.items()} | more
        loss = float(squared.sum() * scale)
    g = np.zeros_like(trained["enc0_w"])
    g[: z.shape[1]] = z.T @ d_first
    for column in cat.T:
        seen, sums = slot_sums(column, d_first)
        g[seen] += sums
    grads["enc0_w"] = g
    return loss, grads


def output_layer(trained: Params) -> tuple[np.ndarray, np.ndarray]:
    last = f"dec{len(DECODER_WIDTHS) + 1}"
    return trained[f"{last}_w"], trained[f"{last}_b"]


def output_squares(trained: Params, n_num: int) -> tuple[np.ndarray, np.ndarray, float]:
    """W W', W b' and |b|^2 over the one-hot dimensions of the output layer."""
    w, b = output_layer(trained)
    w, b = w[:, n_num:], b[n_num:]
    return w @ w.T, w @ b, float(b @ b)


def block_errors(trained: Params, squares: tuple, h: np.ndarray, z: np.ndarray, cat: np.ndarray) -> np.ndarray:
    """Squared reconstruction error of every row, summed over all dimensions, without the one-hot part of the output."""
    w, b = output_layer(trained)
    n_num = z.shape[1]
    gram, wb, bb = squares
    out = np.square(h @ w[:, :n_num] + b[:n_num] - z).sum(axis=1) + ((h @ gram) * h).sum(axis=1) + 2.0 * (h @ wb) + bb
    for column in cat.T:
        seen = np.flatnonzero(column >= 0)
        slot = column[seen]
        out[seen] += 1.0 - 2.0 * ((h[seen] * w.T[slot]).sum(axis=1) + b[slot])
    return out


def block_output(trained: Params, h: np.ndarray, z: np.ndarray, cat: np.ndarray) -> tuple[np.ndarray, Params, np.ndarray]:
    """Squared errors of the rows, and half the gradients of their sum: of the output layer, and of ``h``."""
    w, b = output_layer(trained)
    n_num = z.shape[1]
    squares = output_squares(trained, n_num)
    gram, wb, _ = squares
    grad_w, grad_b = (h.T @ h) @ w + np.outer(h.sum(axis=0), b), h.sum(axis=0) @ w + len(h) * b
    e = h @ w[:, :n_num] + b[:n_num] - z
    grad_w[:, :n_num], grad_b[:n_num] = h.T @ e, e.sum(axis=0)
    d = e @ w[:, :n_num].T + h @ gram + wb
    for column in cat.T:
        seen, sums = slot_sums(column, h)
        grad_w[:, seen] -= sums.T
        grad_b[seen] -= np.bincount(np.searchsorted(seen, column[column >= 0]), minlength=len(seen)).astype(b.dtype)
        there = np.flatnonzero(column >= 0)
        d[there] -= w.T[column[there]]
    last = f"dec{len(DECODER_WIDTHS) + 1}"
    return block_errors(trained, squares, h, z, cat), {f"{last}_w": grad_w, f"{last}_b": grad_b}, d


def adam_step(trained: Params, first: Params, second: Params, grads: Params, step: int) -> None:
    b1, b2 = ADAM_BETAS
    rate = LEARNING_RATE * float(np.sqrt(1 - b2**step)) / (1 - b1**step)
    for name, g in grads.items():
        m, v = first[name], second[name]
        m *= b1
        m += (1 - b1) * g
        v *= b2
        g = g * g
        g *= 1 - b2
        v += g
        np.sqrt(v, out=g)
        g += ADAM_EPSILON
        np.divide(m, g, out=g)
        g *= rate
        trained[name] -= g


def mse_input_gradient(trained: Params, running: Params, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per-row reconstruction error of dense rows and its gradient with respect to the input."""
    out, tape = forward(trained, running, x, None)
    e = x - out
    _, d_first = backward(trained, tape, e, training=False)
    scale = 2.0 / x.shape[1]
    return np.mean(np.square(e), axis=1), scale * (e - d_first @ trained["enc0_w"].T)
