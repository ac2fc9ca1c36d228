"""A character-level bidirectional LSTM with a CRF on top, trained and run in numpy.

Arrays are time-major: (T, N, ...). All gradients are written out; the CRF's come from forward-backward
marginals. Training is deterministic for a seed.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def init(chars: int, emb: int, hidden: int, tags: int, seed: int = 0, dtype=np.float32) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(dtype)
    p = {"E": draw(chars, emb) * 2, "U": draw(2 * hidden, tags), "c": np.zeros(tags, dtype), "A": np.zeros((tags, tags), dtype), "s": np.zeros(tags, dtype)}
    for d in "fb":
        p |= {f"W{d}": draw(emb, 4 * hidden), f"R{d}": draw(hidden, 4 * hidden), f"b{d}": np.zeros(4 * hidden, dtype)}
        p[f"b{d}"][hidden : 2 * hidden] = 1  # remember at first
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _lstm(x: np.ndarray, w: np.ndarray, r: np.ndarray, b: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    steps, n, _ = x.shape
    hidden = r.shape[0]
    pre = x @ w + b
    h, c = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    out, saved = np.empty((steps, n, hidden), x.dtype), []
    for t in range(steps):
        z = pre[t] + h @ r
        gates = _sigmoid(z[:, : 3 * hidden])
        i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
        g = np.tanh(z[:, 3 * hidden :])
        before, c_before = h, c
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        out[t] = h
        if keep:
            saved.append((i, f, o, g, tc, before, c_before))
    return out, saved


def _lstm_back(dout: np.ndarray, x: np.ndarray, w: np.ndarray, r: np.ndarray, saved: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    steps, n, hidden = dout.shape
    dz_all = np.empty((steps, n, 4 * hidden), dout.dtype)
    dr = np.zeros_like(r)
    dh, dc = np.zeros((n, hidden), dout.dtype), np.zeros((n, hidden), dout.dtype)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, tc, before, c_before = saved[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = dz_all[t]
        dz[:, :hidden] = dc * g * i * (1 - i)
        dz[:, hidden : 2 * hidden] = dc * c_before * f * (1 - f)
        dz[:, 2 * hidden : 3 * hidden] = dh * tc * o * (1 - o)
        dz[:, 3 * hidden :] = dc * i * (1 - g * g)
        dr += before.T @ dz
        dh = dz @ r.T
        dc = dc * f
    flat = dz_all.reshape(-1, 4 * hidden)
    return (dz_all @ w.T), x.reshape(-1, x.shape[2]).T @ flat, dr, flat.sum(axis=0)


def emissions(p: Params, ids: np.ndarray) -> np.ndarray:
    """Tag scores (T, tags, N) of character ids (T, N).

    Features lie before sequences here, so that gates are contiguous; what a character adds to the gates is
    looked up, and the gates' sigmoids are taken as half a tanh, all in one call.
    """
    steps, n = ids.shape
    hidden = p["Rf"].shape[0]
    half = np.repeat(np.array([0.5, 1.0], p["E"].dtype), [3 * hidden, hidden])[:, None]
    out = np.empty((steps, len(p["c"]), n), p["E"].dtype)
    out[:] = p["c"][:, None]
    z, more = np.empty((4 * hidden, n), out.dtype), np.empty((4 * hidden, n), out.dtype)
    for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
        table = np.ascontiguousarray((p["E"] @ p[f"W{d}"] + p[f"b{d}"]).T * half)
        again = np.ascontiguousarray(p[f"R{d}"].T * half)
        top = np.ascontiguousarray((p["U"][:hidden] if d == "f" else p["U"][hidden:]).T)
        h, c = np.zeros((hidden, n), out.dtype), np.zeros((hidden, n), out.dtype)
        for t in order:
            np.take(table, ids[t], axis=1, out=z, mode="clip")
            np.matmul(again, h, out=more)
            z += more
            np.tanh(z, out=z)
            gates = z[: 3 * hidden]
            gates *= 0.5
            gates += 0.5
            c *= gates[hidden : 2 * hidden]
            gates[:hidden] *= z[3 * hidden :]
            c += gates[:hidden]
            np.tanh(c, out=h)
            h *= gates[2 * hidden :]
            out[t] += top @ h
    return out


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def loss(p: Params, ids: np.ndarray, tags: np.ndarray) -> tuple[float, Params]:
    """Mean negative log-likelihood a sequence, and its gradients."""
    steps, n = ids.shape
    x = p["E"][ids]
    ahead, kept_f = _lstm(x, p["Wf"], p["Rf"], p["bf"], True)
    back, kept_b = _lstm(x[::-1], p["Wb"], p["Rb"], p["bb"], True)
    h = np.concatenate([ahead, back[::-1]], axis=2)
    e = h @ p["U"] + p["c"]
    k = e.shape[2]
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = p["s"] + e[0]
    for t in range(1, steps):
        alpha[t] = e[t] + _logsumexp(alpha[t - 1][:, :, None] + p["A"], 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _logsumexp(p["A"] + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _logsumexp(alpha[-1], 1)
    at = np.arange(n)
    gold = p["s"][tags[0]] + e[0][at, tags[0]]
    for t in range(1, steps):
        gold = gold + p["A"][tags[t - 1], tags[t]] + e[t][at, tags[t]]
    de = np.exp(alpha + beta - z[:, None])
    hot = np.eye(k, dtype=e.dtype)[tags]
    g = {"s": (de[0] - hot[0]).sum(axis=0) / n, "A": np.zeros_like(p["A"])}
    for t in range(1, steps):
        pair = np.exp(alpha[t - 1][:, :, None] + p["A"] + (e[t] + beta[t])[:, None, :] - z[:, None, None])
        g["A"] += pair.sum(axis=0) - hot[t - 1].T @ hot[t]
    g["A"] /= n
    de = (de - hot) / n
    flat = de.reshape(-1, k)
    g["U"], g["c"] = h.reshape(-1, h.shape[2]).T @ flat, flat.sum(axis=0)
    dh, hidden = de @ p["U"].T, h.shape[2] // 2
    dx, g["Wf"], g["Rf"], g["bf"] = _lstm_back(dh[:, :, :hidden], x, p["Wf"], p["Rf"], kept_f)
    dxb, g["Wb"], g["Rb"], g["bb"] = _lstm_back(dh[::-1, :, hidden:], x[::-1], p["Wb"], p["Rb"], kept_b)
    g["E"] = np.zeros_like(p["E"])
    np.add.at(g["E"], ids, dx + dxb[::-1])
    return float((z - gold).mean()), g


def train(p: Params, ids: np.ndarray, tags: np.ndarray, rounds: int, batch: int, rate: float, seed: int = 0) -> Params:
    """Adam over random batches of sequences (T, N)."""
    rng = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        take = rng.choice(ids.shape[1], batch, replace=False)
        _, g = loss(p, ids[:, take], tags[:, take])
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        now = rate * min(1.0, 2.0 * (1 - step / (rounds + 1)))
        for k, x in g.items():
            x = x * min(1.0, 5.0 / (norm + 1e-9))
            m[k] += 0.1 * (x - m[k])
            v[k] += 0.001 * (x * x - v[k])
            p[k] = p[k] - (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(p[k].dtype)
    return p


def pays(e: np.ndarray, a: np.ndarray, bonus: float) -> np.ndarray:
    """Which sequences of emissions (T, tags, N) have a best path that isn't tag 0 throughout, were entering another tag worth `bonus` more."""
    steps = a - a[0, 0]
    steps[0, 1:] += bonus
    steps = np.ascontiguousarray(steps.astype(e.dtype))
    moves = np.empty((len(a), len(a), e.shape[2]), e.dtype)
    lead = e[0] - e[0, :1]
    best = steps[0][:, None] + lead  # beyond the path of tag 0, which is at nought
    for t in range(1, len(e)):
        np.add(best[:, None], steps[:, :, None], out=moves)
        np.maximum.reduce(moves, axis=0, out=best)
        np.subtract(e[t], e[t, :1], out=lead)
        best += lead
    return (best + steps[:, :1]).max(axis=0) > 1e-3


def viterbi(e: np.ndarray, sizes: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Best tags (T, N) of sequences of emissions (T, N, tags), of which the first `sizes` count; tag 0 stands before and after."""
    best = a[0] + e[0]
    came = np.zeros(e.shape, dtype=np.int8)
    for t in range(1, len(e)):
        moves = best[:, :, None] + a
        came[t] = moves.argmax(axis=1)
        on = t < sizes
        best = np.where(on[:, None], moves.max(axis=1) + e[t], best)
    tag = (best + a[:, 0]).argmax(axis=1)
    out, every = np.zeros(e.shape[:2], dtype=np.int8), np.arange(e.shape[1])
    for t in range(len(e) - 1, -1, -1):
        on = t < sizes
        out[t] = np.where(on, tag, 0)
        tag = np.where(on, came[t][every, tag], tag) if t else tag
    return out
