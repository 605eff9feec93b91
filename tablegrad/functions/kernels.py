"""Numpy forward / backward for a layer list, run inside ``mapInArrow`` tasks on one mini-batch or Arrow batch.

Per-sample weights carry the normalisation, so summing kernel outputs across tasks gives the exact gradient of
the global loss. Loss conventions (matching the operator plans):

* ``mse``: per element (pred - target)^2, averaged over elements.
* ``cross_entropy``: softmax of the logits, ``-t ln(p + 1e-12)`` per element, averaged over elements
  (``reduction='elements'``) or over rows (``'batch'``).
"""

from __future__ import annotations

import numpy as np

from tablegrad.operators.losses import LOG_EPS
from tablegrad.operators.nn import BatchNorm1d, CustomLayer, Linear, ReLU, Sigmoid, Softmax


def softmax_np(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def forward(x: np.ndarray, layers, params, training: bool = True, bn_running=None, stats: dict | None = None):
    """Returns the output and the tape (per-layer cached values) for ``backward``."""
    tape = []
    it = iter(params)
    out = x
    for k, layer in enumerate(layers):
        if isinstance(layer, Linear):
            w = next(it)
            b = next(it) if layer.bias else None
            tape.append(("linear", out, w, b is not None))
            out = out @ w + (b if b is not None else 0.0)
        elif isinstance(layer, ReLU):
            tape.append(("relu", out))
            out = np.where(out > 0, out, 0.0)
        elif isinstance(layer, Sigmoid):
            y = 1.0 / (1.0 + np.exp(-out))
            tape.append(("sigmoid", y))
            out = y
        elif isinstance(layer, Softmax):
            y = softmax_np(out)
            tape.append(("softmax", y))
            out = y
        elif isinstance(layer, BatchNorm1d):
            g, bt = (next(it), next(it)) if layer.affine else (np.ones(layer.num_features), np.zeros(layer.num_features))
            if training:
                mu = out.mean(axis=0)
                var = ((out - mu) ** 2).mean(axis=0)
                if stats is not None:
                    held = stats.setdefault(k, [np.zeros_like(mu), np.zeros_like(var), 0])
                    held[0], held[1], held[2] = held[0] + mu, held[1] + var, held[2] + 1
            else:
                mu, var = (bn_running or {}).get(k, (np.zeros(layer.num_features), np.ones(layer.num_features)))
            inv = 1.0 / np.sqrt(var + layer.eps)
            xhat = (out - mu) * inv
            tape.append(("bn", xhat, inv, g, layer.affine, training))
            out = xhat * g + bt
        elif isinstance(layer, CustomLayer):
            own = [next(it) for _ in layer.shapes]
            out, saved = layer.forward(out, *own)
            tape.append(("custom", layer, saved))
        else:
            raise ValueError(f"unknown layer {layer!r}")
    return out, tape


def loss_and_grad(out: np.ndarray, target: np.ndarray, loss, reduction: str = "elements",
                  inputs: str = "logits"):
    """Per-row loss sums (before normalisation) and d(sum of row losses)/d(out).

    ``loss`` is a name or a user's function ``(out, target) -> (row losses, gradient by out)``.
    """
    if callable(loss):
        return loss(out, target)
    if loss == "mse":
        diff = out - target
        return (diff * diff).sum(axis=1), 2.0 * diff
    if loss == "cross_entropy":
        z = softmax_np(out) if inputs == "probabilities" else out
        p = softmax_np(z)
        g = -target / (p + LOG_EPS)
        row = (-target * np.log(p + LOG_EPS)).sum(axis=1)
        dz = p * (g - (g * p).sum(axis=1, keepdims=True))
        if inputs == "probabilities":
            dz = out_softmax_backward(softmax_np(out), dz)
        return row, dz
    raise ValueError(f"unknown loss {loss}")


def out_softmax_backward(y: np.ndarray, g: np.ndarray) -> np.ndarray:
    return y * (g - (g * y).sum(axis=1, keepdims=True))


def backward(tape, grad_out: np.ndarray) -> list[np.ndarray]:
    """Gradients of every parameter, in registration order."""
    return backward_through(tape, grad_out)[0]


def backward_through(tape, grad_out: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradients of every parameter, in registration order, and of the input."""
    grads = []
    g = grad_out
    for entry in reversed(tape):
        kind = entry[0]
        if kind == "linear":
            _, x, w, has_b = entry
            if has_b:
                grads.append(g.sum(axis=0))
            grads.append(x.T @ g)
            g = g @ w.T
        elif kind == "relu":
            g = g * (entry[1] > 0)
        elif kind == "sigmoid":
            y = entry[1]
            g = g * y * (1.0 - y)
        elif kind == "softmax":
            g = out_softmax_backward(entry[1], g)
        elif kind == "custom":
            _, layer, saved = entry
            g, own = layer.backward(saved, g)
            grads.extend(reversed(list(own)))
        elif kind == "bn":
            _, xhat, inv, gamma, affine, training = entry
            if affine:
                grads.append((g).sum(axis=0))          # beta
                grads.append((g * xhat).sum(axis=0))   # gamma
            gx = g * gamma
            if training:
                m = xhat.shape[0]
                g = inv / m * (m * gx - gx.sum(axis=0) - xhat * (gx * xhat).sum(axis=0))
            else:
                g = gx * inv
    return grads[::-1], g


def batch_gradient(x, y, layers, params, loss: str, weights: np.ndarray, reduction: str = "elements",
                   inputs: str = "logits", training: bool = True, stats: dict | None = None):
    """Weighted gradient of ``sum_i weights_i * rowloss_i`` and the unweighted row losses."""
    out, tape = forward(x, layers, params, training=training, stats=stats)
    row_loss, dout = loss_and_grad(out, y, loss, reduction, inputs)
    grads = backward(tape, dout * weights[:, None])
    return grads, row_loss
