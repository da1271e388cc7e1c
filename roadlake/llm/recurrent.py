"""A gated recurrent language model in numpy.

The next word is predicted in two factors, its class and the word within the
class; classes are runs of words of similar frequency.  Documents are laid on
parallel lanes; a lane's state is carried from window to window, and starts anew
with each document, so that a document's likelihood is complete.  Training
truncates back-propagation at the window.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np

F4 = np.float32
Params = dict[str, np.ndarray]
#: Training cuts documents into pieces of so many words; scoring never does.
PIECE = 512
#: Words of a window in scoring, where ``width`` lanes do not fill it.
ROOM = 1 << 14
SMALL = 60


def class_starts(counts: np.ndarray, classes: int) -> np.ndarray:
    """First word of each class (and the end), of about equal sums of square-rooted counts."""
    mass = np.cumsum(np.sqrt(counts + 1.0))
    cut = np.searchsorted(mass, np.linspace(0, mass[-1], classes + 1)[1:-1])
    return np.unique(np.r_[0, cut, len(counts)])


def fresh(counts: np.ndarray, starts: np.ndarray, hidden: int, seed: int = 3) -> Params:
    """Small random weights; the output biases are the words' own frequencies."""
    rng = np.random.default_rng(seed)
    n, c = len(counts), len(starts) - 1
    by_class = np.add.reduceat(counts + 1.0, starts[:-1])
    normal = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(F4)
    return {
        "x": normal(n, 3 * hidden),
        "u": (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(F4),
        "c": np.zeros((c, hidden), F4),
        "cb": np.log(by_class / by_class.sum()).astype(F4),
        "w": np.zeros((n, hidden), F4),
        "wb": np.log((counts + 1.0) / np.repeat(by_class, np.diff(starts))).astype(F4),
    }


def flatten(p: Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unflatten(flat: np.ndarray, like: Params) -> Params:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = flat[at : at + n].reshape(like[k].shape).astype(F4)
        at += n
    return out


def lanes(docs: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Documents laid end to end on lanes, the longest lane first.

    Returns (words, document of each word, whether it begins one, starts and
    lengths of the lanes): the lanes one behind the other, as long as the
    documents together.
    """
    width = max(1, min(width, len(docs)))
    heap = [(0, k) for k in range(width)]
    placed: list[list[int]] = [[] for _ in range(width)]
    for d in sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        n, k = heapq.heappop(heap)
        placed[k].append(d)
        heapq.heappush(heap, (n + len(docs[d]), k))
    size = np.array([sum(len(docs[d]) for d in own) for own in placed])
    order = np.argsort(-size, kind="stable")
    row = [d for k in order.tolist() for d in placed[k]]
    sizes = np.array([len(docs[d]) for d in row])
    words = np.concatenate([docs[d] for d in row])
    first = np.zeros(len(words), bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    size = size[order]
    return words, np.repeat(np.array(row, np.int32), sizes), first, np.cumsum(size) - size, size


def _windows(docs, width, window, end_word, room: int = 0) -> Iterator[tuple]:
    """Windows of ``window`` steps, or of more where few lanes are left, up to ``room`` words."""
    words, doc, first, start, size = lanes(docs, width)
    before = np.r_[np.array([end_word], words.dtype), words[:-1]]
    before[first] = end_word
    at, longest = 0, int(size[0])
    while at < longest:
        k = int((size > at).sum())  # lanes that are still running
        steps = np.arange(at, min(at + max(window, room // k), longest))[:, None]
        at += len(steps)
        there = steps < size[:k]
        place = np.where(there, start[:k] + steps, start[:k])
        yield words[place], before[place], first[place] & there, there, doc[place], k


def _forward(p: Params, before: np.ndarray, first: np.ndarray, h: np.ndarray, keep: bool):
    """States after each step, and what back-propagation needs: states before, (z, r, a of n) and n of each step.

    A gate's values lie together; z and r are sigmoids, whose sums are worked out with the sign turned.
    """
    steps, (width, hidden) = len(before), h.shape
    signs = np.array([-1, -1, 1], F4)[:, None, None]
    by_gate = lambda m: np.ascontiguousarray(m.reshape(-1, 3, hidden).transpose(1, 0, 2)) * signs
    x, u = np.take(by_gate(p["x"]), before, axis=1), by_gate(p["u"])
    states = np.empty((steps, width, hidden), F4)
    sums = np.empty((steps if keep else 1, 3, width, hidden), F4)
    news = np.empty((steps if keep else 1, width, hidden), F4)
    starts = np.empty_like(states) if keep else None
    begins = first.any(axis=1).tolist()
    for t in range(steps):
        if begins[t]:
            h = np.where(first[t][:, None], F4(0), h)
        if keep:
            starts[t] = h
        a, n, new = sums[t if keep else 0], news[t if keep else 0], states[t]
        np.matmul(h, u, out=a)
        gates = a[:2]
        gates += x[:2, t]
        with np.errstate(over="ignore"):  # infinite: the gate is 0
            np.exp(gates, out=gates)
        gates += F4(1)
        np.reciprocal(gates, out=gates)
        np.multiply(gates[1], a[2], out=n)
        n += x[2, t]
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= gates[0]
        new += n
        h = new
    return states, h, (starts, sums, news)


def _by_word(words: np.ndarray, distinct: int) -> np.ndarray:
    """Order of the words by number; short numbers sort faster."""
    return np.argsort(words.astype(np.uint16) if distinct <= 1 << 16 else words, kind="stable")


def _with_ones(m: np.ndarray, ones: np.ndarray | None = None) -> np.ndarray:
    """The matrix with one more column, of ones or as given."""
    out = np.empty((len(m), m.shape[1] + 1), F4)
    out[:, :-1] = m
    out[:, -1] = 1 if ones is None else ones
    return out


def _exponentials(s: np.ndarray, weights: np.ndarray, small: bool) -> tuple[np.ndarray, np.ndarray | int]:
    """Exponentials of the logits by row, and by how much the logits were shifted.

    ``small`` logits need no shift to keep their exponentials finite.
    """
    logits, top = s @ weights.T, 0
    if not small:
        top = logits.max(axis=1)
        logits -= top[:, None]
    np.exp(logits, out=logits)
    return logits, top


class Model:
    def __init__(self, params: Params, starts: np.ndarray):
        self.p, self.starts = params, starts
        self.of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        self.hidden = params["u"].shape[0]

    def _output(self, s: np.ndarray, words: np.ndarray, update: Callable | None):
        """(log-probability of each word given its state, none), or (none, the states' gradient) with ``update``,
        which is called with the gradients of the classes and of their words once what depends on them is worked out.

        Words are taken in their order, in which those of a class lie together.  The last column of the
        states is one, that of the weights the bias; the exponentials times (weights, 1) are the
        unscaled gradient and the sum.
        """
        p, hidden = self.p, self.hidden
        c, w = _with_ones(p["c"], p["cb"]), _with_ones(p["w"], p["wb"])
        # states lie within -1 and 1, which bounds every logit
        small = max(float((np.abs(m) @ np.ones(hidden + 1, F4)).max()) for m in (c, w)) < SMALL
        order = _by_word(words, len(w))
        s, words = _with_ones(np.take(s, order, axis=0)), words[order]
        own = self.of[words]
        ones = [_with_ones(p[k]) if update else np.ones((len(p[k]), 1), F4) for k in ("c", "w")]
        e, top = _exponentials(s, c, small)
        into = e @ ones[0]
        if update:
            ds = into[:, :-1] / into[:, -1:] - np.take(p["c"], own, axis=0)
            dc = e.T @ (s / into[:, -1:])
            dw = np.zeros_like(w)
        else:
            logp = np.einsum("ij,ij->i", s, np.take(c, own, axis=0)) + np.einsum("ij,ij->i", s, np.take(w, words, axis=0))
            logp -= np.log(into[:, -1]) + top
        into = np.empty((len(s), ones[1].shape[1]), F4)
        cut = np.searchsorted(own, np.arange(len(self.starts)))
        for k in np.flatnonzero(np.diff(cut)).tolist():
            a, b, at = self.starts[k], self.starts[k + 1], slice(cut[k], cut[k + 1])
            if b - a == 1:  # certain, whatever the state
                into[at] = ones[1][a]
                if not update:
                    logp[at] -= s[at] @ w[a]
                continue
            e, top = _exponentials(s[at], w[a:b], small)
            part = np.matmul(e, ones[1][a:b], out=into[at])
            if update:
                np.matmul(e.T, s[at] / part[:, -1:], out=dw[a:b])
            elif not small:
                logp[at] -= top
        out = np.empty((len(s), hidden) if update else len(s), F4)
        if not update:
            logp -= np.log(into[:, -1])
            out[order] = logp
            return out, None
        ds += into[:, :-1] / into[:, -1:]
        ds -= np.take(p["w"], words, axis=0)
        out[order] = ds
        if len(words):
            first = np.flatnonzero(np.r_[True, np.diff(words) != 0])
            dw[words[first]] -= np.add.reduceat(s, first, axis=0)
            dw[self.starts[:-1][np.diff(self.starts) == 1]] = 0
            first = np.flatnonzero(np.r_[True, np.diff(own) != 0])
            dc[own[first]] -= np.add.reduceat(s, first, axis=0)
        for name, d in (("c", dc), ("w", dw)):
            update(name, slice(None), np.ascontiguousarray(d[:, :hidden]))
            update(name + "b", slice(None), d[:, hidden].copy())
        return None, out

    def log_likelihood(self, docs: list[np.ndarray], end_word: int, width: int = 512, window: int = 16) -> np.ndarray:
        """Natural-log probability of each document, all its words included."""
        out = np.zeros(len(docs))
        h = np.zeros((min(width, len(docs)), self.hidden), F4)
        for words, before, first, there, doc, k in _windows(docs, width, window, end_word, ROOM):
            states, h, _ = _forward(self.p, before, first, h[:k], False)
            logp, _ = self._output(states[there], words[there], None)
            out += np.bincount(doc[there], logp, len(docs))
        return out

    def learn(
        self, docs: list[np.ndarray], end_word: int, memory: Params, rate: float, width: int, window: int, piece: int = PIECE
    ) -> None:
        """One pass over the documents by truncated back-propagation; memory: Adagrad's sums of squares.

        Longer documents are learnt in pieces, so that the lanes end together; a
        piece starts with the word before it and no state.  Of the input words only
        those of a window are updated, which is what Adagrad does with zeros.
        """
        hidden, p = self.hidden, self.p
        begins = {}
        parts: list[np.ndarray] = []
        for d in docs:
            for at in range(0, len(d), piece):
                if at:
                    begins[len(parts)] = d[at - 1]
                parts.append(d[at : at + piece])
        if not parts:
            return
        lead = np.full(len(parts), end_word, np.int32)
        lead[list(begins)] = list(begins.values())
        h = np.zeros((min(width, len(parts)), hidden), F4)
        for words, before, first, there, part, k in _windows(parts, width, window, end_word):
            before = np.where(first, lead[part], before)
            share = F4(1 / max(1, int(there.sum())))

            def update(name: str, rows, g: np.ndarray, share=share) -> None:
                g *= share
                sums = g * g
                sums += memory[name][rows]
                memory[name][rows] = sums
                np.sqrt(sums, out=sums)
                sums += F4(1e-6)
                g *= F4(rate)
                g /= sums
                p[name][rows] -= g

            states, h, (h0, sums, n) = _forward(p, before, first, h[:k], True)
            _, ds = self._output(states[there], words[there], update)
            dstates = np.zeros_like(states)
            dstates[there] = ds
            z, r, an = sums[:, 0], sums[:, 1], sums[:, 2]
            rest = 1 - z
            dz = (h0 - n) * z * rest
            rest *= 1 - n * n
            dr = an * r * (1 - r)
            dx, dn = np.empty((len(words), k, 3 * hidden), F4), np.empty_like(states)
            dh = np.zeros((k, hidden), F4)
            back = np.ascontiguousarray(p["u"].T)
            begins = first.any(axis=1).tolist()
            for t in range(len(words) - 1, -1, -1):
                dh += dstates[t]
                d = dx[t]
                np.multiply(dh, rest[t], out=dn[t])
                np.multiply(dh, dz[t], out=d[:, :hidden])
                np.multiply(dn[t], dr[t], out=d[:, hidden : 2 * hidden])
                np.multiply(dn[t], r[t], out=d[:, 2 * hidden :])
                dh *= z[t]
                dh += d @ back
                if begins[t]:
                    dh[first[t]] = 0
            du = h0.reshape(-1, hidden).T @ dx.reshape(-1, 3 * hidden)
            dx[..., 2 * hidden :] = dn  # of the input: not through r
            update("u", slice(None), du)
            flat, rows = dx.reshape(-1, 3 * hidden), before.ravel()
            order = _by_word(rows, len(p["x"]))
            start = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0])
            update("x", rows[order][start], np.add.reduceat(np.take(flat, order, axis=0), start, axis=0))
