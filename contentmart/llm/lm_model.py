"""A small causal self-attention model over subword ids, trained and run in numpy.

One layer: embeddings and positions, one masked attention head, a hidden layer, and class logits that
also get a learned-from-counts row per input id (the direct path).  An id's probability is that of its
class given the window times that of the id in its class given the class of the id before, so a step
costs the number of classes and not of ids, and every id has a positive probability.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np

#: Inputs of a window, and how many of them only give context to the rest.
WINDOW, CONTEXT = 32, 8
DIM, HIDDEN, CLASSES = 16, 32, 128
NEW = WINDOW - CONTEXT
#: Counts that the prior of a conditional distribution weighs as much as.
PULL = 8.0


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    cls: np.ndarray  # class of each id
    inside: np.ndarray  # (ids, classes): natural log of an id's probability in its class after a class
    # (2, ids): log-odds that a new word begins after an id, and what an id adds to them that comes next
    gap: np.ndarray = field(default_factory=lambda: np.zeros((2, 0), np.float32))

    @property
    def end(self) -> int:
        return len(self.cls) - 1


def dumps(model: Model) -> bytes:
    """The model as bytes, all numbers as they are."""
    out = io.BytesIO()
    np.savez(out, cls=model.cls, inside=model.inside, gap=model.gap, **{f"w.{k}": v for k, v in model.weights.items()})
    return out.getvalue()


def loads(data: bytes) -> Model:
    with np.load(io.BytesIO(data)) as z:
        return Model({k[2:]: z[k] for k in z.files if k.startswith("w.")}, z["cls"], z["inside"], z["gap"])


def gap_log_prob(model: Model, ids: np.ndarray, begins: np.ndarray) -> float:
    """Natural log-probability of where words begin between ``ids``; even odds without counts."""
    odds = model.gap[0, ids[:-1]] + model.gap[1, ids[1:]] if model.gap.size else np.zeros(len(begins))
    return -float(np.logaddexp(0, np.where(begins, -odds, odds)).sum(dtype=np.float64))


def mask() -> np.ndarray:
    """Which inputs a scored position sees: itself and what is before it."""
    rows, cols = np.arange(CONTEXT, WINDOW)[:, None], np.arange(WINDOW)[None, :]
    return (cols <= rows).astype(np.float32)


_MASK = mask()
#: Exponents that are taken as they are; beyond them a row's largest is taken off first.
PLAIN = 60.0
#: Rows of logits that are worked on together: few enough for a core's cache.
ROWS = 384


def windows(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows of documents: (inputs, targets); each id is the target of one place.

    ``ids`` are the documents' ids one after another, each document with its end id last.  The inputs
    are the ids before, with end ids in front of a document; places past its end have target -1.
    """
    steps = -(-lengths // NEW)
    padded = CONTEXT + steps * NEW
    at = np.concatenate([[0], np.cumsum(padded)])
    flat = np.full(at[-1], end, np.int32)
    goal = np.full(at[-1], -1, np.int32)
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    place = np.arange(len(ids)) + np.repeat(at[:-1] + CONTEXT - first, lengths)
    goal[place] = ids
    inner = np.ones(len(ids), bool)
    inner[np.cumsum(lengths) - 1] = False  # the end id is nobody's input
    flat[place[inner] + 1] = ids[inner]
    starts = np.repeat(at[:-1], steps) + NEW * (np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps))
    return flat[starts[:, None] + np.arange(WINDOW)], goal[starts[:, None] + np.arange(CONTEXT, WINDOW)]


def _dot(u: np.ndarray, m: np.ndarray) -> np.ndarray:
    """``u @ m`` as one product of matrices."""
    return (u.reshape(-1, u.shape[-1]) @ m).reshape(*u.shape[:-1], m.shape[1])


def _flat(u: np.ndarray) -> np.ndarray:
    return u.reshape(-1, u.shape[-1])


def _exp(z: np.ndarray) -> None:
    """``z`` becomes its exponentials, up to a factor of each row where those would leave a float's range."""
    if z.size and not (z.max() < PLAIN and z.min() > -PLAIN):
        z -= z.max(axis=-1, keepdims=True)
    np.exp(z, out=z)


def _attended(w: dict[str, np.ndarray], x: np.ndarray) -> dict[str, np.ndarray]:
    """What a window's places hold before the class logits."""
    h = w["emb"].take(x, axis=0)
    h += w["pos"]
    new = np.ascontiguousarray(h[:, CONTEXT:])
    q, k, v = _dot(new, w["q"]), _dot(h, w["k"]), _dot(h, w["v"])
    a = q @ k.transpose(0, 2, 1)
    if a.size and not (a.max() < PLAIN and a.min() > -PLAIN):
        a += np.where(_MASK, 0, np.float32(-1e9))
    _exp(a)
    a *= _MASK
    a /= a @ np.ones((WINDOW, 1), a.dtype)
    o = a @ v
    r = new + _dot(o, w["o"])
    m = _dot(r, w["h1"])
    m += w["b1"]
    np.maximum(m, 0, out=m)
    r2 = r + _dot(m, w["h2"])
    return {"h": h, "new": new, "q": q, "k": k, "v": v, "a": a, "o": o, "r": r, "m": m, "r2": r2}


def _logits(w: dict[str, np.ndarray], r2: np.ndarray, before: np.ndarray) -> np.ndarray:
    z = r2 @ w["out"]
    z += w["direct"].take(before, axis=0)
    return z


def forward(w: dict[str, np.ndarray], x: np.ndarray) -> dict[str, np.ndarray]:
    f = _attended(w, x)
    f["logits"] = _logits(w, _flat(f["r2"]), x[:, CONTEXT:].ravel()).reshape(len(x), NEW, CLASSES)
    return f


def log_probs(model: Model, x: np.ndarray, y: np.ndarray, batch: int = 64) -> np.ndarray:
    """Natural log-probability of each target; 0 where it is -1."""
    out = np.empty(y.shape, np.float32)
    ones = np.ones((CLASSES, 1), np.float32)
    for i in range(0, len(x), batch):
        xs, t = x[i : i + batch], y[i : i + batch].ravel()
        before, seen = xs[:, CONTEXT:].ravel(), np.maximum(t, 0)
        want, r2 = model.cls[seen].astype(np.int64), _flat(_attended(model.weights, xs)["r2"])
        found = model.inside[seen, model.cls[before]]
        for j in range(0, len(t), ROWS):
            rows = slice(j, j + ROWS)
            z = _logits(model.weights, r2[rows], before[rows])
            _exp(z)
            with np.errstate(divide="ignore"):
                found[rows] += np.log(z[np.arange(len(z)), want[rows]] / (z @ ones)[:, 0])
        out[i : i + batch] = np.where(t >= 0, found, 0).reshape(len(xs), NEW)
    return out


def heads(counts: np.ndarray, n: int) -> np.ndarray:
    """The most frequent ids, whose share before an id is what ids are clustered by."""
    return np.argsort(-counts, kind="stable")[: 2 * n]


def classes(counts: np.ndarray, feat: np.ndarray, rng: np.random.Generator, n: int) -> np.ndarray:
    """A class for each id: the most frequent ids alone, the rest clustered by what stands before them.

    ``feat`` counts how often each of ``heads`` stands before each id: (ids, heads).
    """
    order = np.argsort(-counts, kind="stable")
    alone = min(n // 2, len(order))
    cls = np.full(len(counts), -1)
    cls[order[:alone]] = np.arange(alone)
    rest = order[alone:]
    total = feat.sum(axis=1)
    known = rest[total[rest] >= 3]
    f = np.sqrt(feat[known] / total[known, None])
    centre = f[rng.choice(len(f), min(n - alone, len(f)), replace=False, p=total[known] / total[known].sum())] if len(f) else f
    if len(f):
        for _ in range(10):
            near = (f @ centre.T).argmax(axis=1)
            for c in range(len(centre)):
                mine = near == c
                if mine.any():
                    mean = (f[mine] * total[known][mine, None]).sum(axis=0)
                    centre[c] = mean / max(np.sqrt((mean * mean).sum()), 1e-9)
        cls[known] = alone + (f @ centre.T).argmax(axis=1)
    cls[cls < 0] = n - 1
    return cls.astype(np.int16)


def train(
    sample: np.ndarray, lengths: np.ndarray, counts: np.ndarray, steps: int = 1200, batch: int = 64, rate: float = 4e-3, seed: int = 5
) -> Model:
    """Fit a model on documents that are all there is; ``counts`` are their ids' counts."""
    size, end = len(counts), len(counts) - 1
    x, y = windows(sample, lengths, end)
    got = y >= 0
    before, after = x[:, CONTEXT:][got], y[got]
    top = heads(counts, CLASSES)
    spot = np.full(size, -1)
    spot[top] = np.arange(len(top))
    feat = np.zeros((size, len(top)), np.float32)
    use = spot[before] >= 0
    np.add.at(feat, (after[use], spot[before[use]]), 1.0)
    cls = classes(counts, feat, np.random.default_rng(seed), CLASSES)
    follows, leads = np.zeros((2, size, CLASSES), np.float32)
    np.add.at(follows, (after, cls[before]), 1.0)
    np.add.at(leads, (before, cls[after]), 1.0)
    return fit(x, y, counts, cls, follows, leads, steps, batch, rate, seed)


def fit(
    x: np.ndarray,
    y: np.ndarray,
    counts: np.ndarray,
    cls: np.ndarray,
    follows: np.ndarray,
    leads: np.ndarray,
    steps: int = 1200,
    batch: int = 64,
    rate: float = 4e-3,
    seed: int = 5,
) -> Model:
    """A model from counts over all training documents and gradient steps over all their windows (x, y)."""
    model = tables(counts, cls, follows, leads, seed)
    fitting = Descent(model.weights, cls)
    fitting.run(x, y, np.random.default_rng(seed), steps, batch, lambda at: rate * (1 - at))
    model.weights.update(fitting.w)
    return model


def tables(counts: np.ndarray, cls: np.ndarray, follows: np.ndarray, leads: np.ndarray, seed: int = 5) -> Model:
    """A model before its gradient steps, from counts over all training documents.

    ``follows`` counts each id after each class and ``leads`` each class after each id: (ids, classes).
    """
    rng = np.random.default_rng(seed)
    size = len(counts)
    mass = counts + 0.5
    prior = np.bincount(cls, weights=mass, minlength=CLASSES)
    alone = mass / prior[cls]
    per_class = np.zeros((CLASSES, CLASSES))
    np.add.at(per_class, cls, follows)
    inside = np.empty(follows.shape, np.float32)
    direct = np.empty(leads.shape, np.float32)
    blocks = [slice(i, i + 4096) for i in range(0, size, 4096)]  # a part of the table in double precision at a time
    for b in blocks:
        inside[b] = np.log((follows[b] + PULL * alone[b, None]) / (per_class[cls[b]] + PULL))

    prior = np.maximum(prior / prior.sum(), 1e-12)  # a class without ids is never expected
    for b in blocks:
        direct[b] = np.log((leads[b] + PULL * prior) / (leads[b].sum(axis=1, keepdims=True, dtype=np.float64) + PULL))
    w = {
        "direct": direct,
        "emb": rng.normal(0, 0.3, (size, DIM)),
        "pos": rng.normal(0, 0.1, (WINDOW, DIM)),
        "q": rng.normal(0, DIM**-0.5, (DIM, DIM)) * DIM**-0.5,
        "k": rng.normal(0, DIM**-0.5, (DIM, DIM)),
        "v": rng.normal(0, DIM**-0.5, (DIM, DIM)),
        "o": rng.normal(0, DIM**-0.5, (DIM, DIM)),
        "h1": rng.normal(0, DIM**-0.5, (DIM, HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "h2": rng.normal(0, HIDDEN**-0.5, (HIDDEN, DIM)),
        "out": rng.normal(0, 0.01, (DIM, CLASSES)),
    }
    return Model({k: v.astype(np.float32) for k, v in w.items()}, cls, inside)


class Descent:
    """Gradient steps by Adam on the weights that move, all but the direct path; an id's embedding moves in
    the steps whose windows hold the id."""

    def __init__(self, weights: dict[str, np.ndarray], cls: np.ndarray):
        self.cls, self.steps, self.targets = cls, 0, 0
        self.moments = {k: np.zeros((2, *v.shape), np.float32) for k, v in weights.items() if k == "emb"}
        #: The weights that every step moves whole lie in one array, and so do their moments.
        self.whole = [k for k in weights if k not in ("direct", "emb")]
        self.flat = np.concatenate([weights[k].ravel() for k in self.whole])
        self.flat_moments = np.zeros((2, len(self.flat)), np.float32)
        self.w = dict(weights)
        at = 0
        for k in self.whole:
            part, shape = slice(at, at := at + weights[k].size), weights[k].shape
            self.w[k], self.moments[k] = self.flat[part].reshape(shape), self.flat_moments[:, part].reshape(2, *shape)
        #: Steps that moved each id's embedding.
        self.touched = np.zeros(len(weights["emb"]), np.int32)

    def run(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator, least: int, batch: int, rate) -> None:
        """Steps over all windows (x, y) in random order, again and again until there are ``least`` steps;
        ``rate`` gives the rate after a share of them."""
        per_pass = -(-len(x) // batch)
        passes = max(1, -(-least // per_pass)) if per_pass else 0
        for n in range(passes):
            order = rng.permutation(len(x))
            for k in range(per_pass):
                pick = order[k * batch : (k + 1) * batch]
                self.step(x[pick], y[pick], rate((n * per_pass + k) / (passes * per_pass)))

    def step(self, x: np.ndarray, y: np.ndarray, rate: float) -> None:
        self.steps += 1
        self.targets += int(np.count_nonzero(y >= 0))
        grads, dh = _gradients(self.w, x, y, self.cls)
        flat = x.ravel()
        order = np.argsort(flat.astype(np.uint16) if len(self.touched) <= 1 << 16 else flat, kind="stable")
        sorted_ids = flat[order]
        first = np.flatnonzero(np.diff(sorted_ids, prepend=-1))
        ids = sorted_ids[first]
        self.touched[ids] += 1
        rate *= min(1.0, self.steps / 50)
        m1, m2 = self.moments["emb"]
        one, two = m1.take(ids, axis=0), m2.take(ids, axis=0)
        self.w["emb"][ids] -= self._moved(one, two, np.add.reduceat(_flat(dh).take(order, axis=0), first, axis=0), rate)
        m1[ids], m2[ids] = one, two
        self.flat -= self._moved(*self.flat_moments, np.concatenate([grads[k].ravel() for k in self.whole]), rate)

    def _moved(self, m1: np.ndarray, m2: np.ndarray, g: np.ndarray, rate: float) -> np.ndarray:
        """What a step takes off weights of gradient ``g``, whose moments ``m1`` and ``m2`` follow it."""
        m1 += np.float32(0.1) * (g - m1)
        m2 += np.float32(0.01) * (g * g - m2)
        size = np.sqrt(m2 / np.float32(1 - 0.99**self.steps))
        size += np.float32(1e-6)
        return np.float32(rate / (1 - 0.9**self.steps)) * m1 / size


def gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, cls: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean class cross-entropy of a batch of windows."""
    g, dh = _gradients(w, x, y, cls)
    g["emb"] = np.zeros_like(w["emb"])
    np.add.at(g["emb"], x, dh)
    return g


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, cls: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """``gradients``, but instead of the embeddings' those of the windows' places."""
    f = _attended(w, x)
    r2, before, t = _flat(f["r2"]), x[:, CONTEXT:].ravel(), y.ravel()
    kind = r2.dtype
    got = t >= 0
    want, share = cls[np.maximum(t, 0)], got / kind.type(max(1, np.count_nonzero(got)))
    ones, back = np.ones((CLASSES, 1), kind), np.ascontiguousarray(w["out"].T)
    g = {"out": np.zeros_like(w["out"])}
    dr2 = np.empty_like(r2)
    for j in range(0, len(t), ROWS):
        rows = slice(j, j + ROWS)
        d = _logits(w, r2[rows], before[rows])
        _exp(d)
        total = d @ ones
        d[np.arange(len(d)), want[rows]] -= total[:, 0]
        scale = share[rows, None] / total  # of a row's probabilities, less 1 at its target
        g["out"] += (r2[rows] * scale).T @ d
        np.matmul(d, back, out=dr2[rows])
        dr2[rows] *= scale
    g["h2"] = _flat(f["m"]).T @ dr2
    dm = dr2 @ w["h2"].T
    dm *= _flat(f["m"]) > 0
    g["h1"], g["b1"] = _flat(f["r"]).T @ dm, np.ones(len(dm), kind) @ dm
    dr = dr2
    dr += dm @ w["h1"].T
    o = _flat(f["o"])
    g["o"] = o.T @ dr
    do = dr @ w["o"].T
    along = np.einsum("ij,ij->i", o, do).reshape(len(x), NEW, 1)
    do = do.reshape(len(x), NEW, DIM)
    ds = do @ f["v"].transpose(0, 2, 1)
    ds -= along
    ds *= f["a"]
    dv = _flat(f["a"].transpose(0, 2, 1) @ do)
    dq, dk = _flat(ds @ f["k"]), _flat(ds.transpose(0, 2, 1) @ f["q"])
    h = _flat(f["h"])
    g["q"], g["k"], g["v"] = _flat(f["new"]).T @ dq, h.T @ dk, h.T @ dv
    dh = dk @ w["k"].T
    dh += dv @ w["v"].T
    dh = dh.reshape(f["h"].shape)
    dr += dq @ w["q"].T
    dh[:, CONTEXT:] += dr.reshape(len(x), NEW, DIM)
    g["pos"] = dh.sum(axis=0)
    return g, dh
