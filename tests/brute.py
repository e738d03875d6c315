"""Dense, sequential re-derivations of the trainers for small inputs."""

import numpy as np


def svm(x, target, rate, lam, epochs):
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(epochs):
        for row, t in zip(x, target):
            satisfied = t * (row @ w - b) >= 1
            w = w - rate * 2 * lam * w
            if not satisfied:
                w = w + rate * t * row
                b -= rate * t
    return w, b


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def logreg_batches(x, target, lr, alpha, tolerance, iterations, size):
    n = len(x)
    w, b = np.zeros(x.shape[1]), 0.0
    for iteration in range(1, iterations + 1):
        dw_norms = db_norms = 0.0
        for lo in range(0, n, size):
            xs, ts = x[lo : lo + size], target[lo : lo + size]
            error = logistic(xs @ w + b) - ts
            dw = xs.T @ error / len(xs) + alpha / n * np.sign(w)
            db = error.mean()
            w, b = w - lr * dw, b - lr * db
            dw_norms += np.linalg.norm(dw)
            db_norms += abs(db)
        if dw_norms < tolerance and db_norms < tolerance:
            break
    return w, b, iteration


def logreg_draws(x, target, draws, lr, alpha, tolerance):
    w, b, norms = np.zeros(x.shape[1]), 0.0, []
    for i in draws:
        error = logistic(x[i] @ w + b) - target[i]
        dw = error * x[i] + alpha * np.sign(w)
        w, b = w - lr * dw, b - lr * error
        norms.append(np.linalg.norm(dw) + abs(error))
        if len(norms) >= 100 and np.mean(norms[-100:]) < tolerance:
            break
    return w, b, len(norms)


def best_split(x, g, h, lam, gamma):
    """(rounded gain, feature, threshold, gain) of the best split, lowest feature and threshold on ties."""
    best = None
    score = lambda gs, hs: gs * gs / (hs + lam)
    for f in range(x.shape[1]):
        for t in np.unique(x[:, f]):
            left = x[:, f] < t
            if not left.any():
                continue
            gain = 0.5 * (score(g[left].sum(), h[left].sum()) + score(g[~left].sum(), h[~left].sum()) - score(g.sum(), h.sum())) - gamma
            key = (-np.rint(gain * 1e9), f, t)
            if best is None or key < best[0]:
                best = (key, f, t, gain)
    return best


def tree(x, g, h, p, depth=0, node=0):
    """{node id: ('split', f, t) or ('leaf', value)}"""
    rows = np.arange(len(x))
    if depth < p.max_depth and len(rows) >= p.min_samples_split:
        found = best_split(x, g, h, p.reg_lambda, p.gamma)
        if found is not None and found[3] > p.min_impurity_decrease:
            _, f, t, _ = found
            left = x[:, f] < t
            out = {node: ("split", f, t)}
            out |= tree(x[left], g[left], h[left], p, depth + 1, 2 * node + 1)
            out |= tree(x[~left], g[~left], h[~left], p, depth + 1, 2 * node + 2)
            return out
    return {node: ("leaf", -g.sum() / (h.sum() + p.reg_lambda))}


def tree_value(nodes, row, node=0):
    kind, *rest = nodes[node]
    if kind == "leaf":
        return rest[0]
    f, t = rest
    return tree_value(nodes, row, 2 * node + (1 if row[f] < t else 2))


def boost(x, target, p):
    logit = np.full(len(x), p.init_logit)
    trees = []
    for _ in range(p.n_estimators):
        prob = 1 / (1 + np.exp(-logit))
        nodes = tree(x, prob - target, prob * (1 - prob), p)
        logit = logit + p.learning_rate * np.array([tree_value(nodes, row) for row in x])
        trees.append(nodes)
    return trees, logit


def mutual_information(values, labels):
    n, mi = len(values), 0.0
    for v in np.unique(values):
        for c in np.unique(labels):
            both = np.sum((values == v) & (labels == c)) / n
            if both > 0:
                mi += both * np.log(both / (np.mean(values == v) * np.mean(labels == c)))
    return max(mi, 0.0)


def metrics_matrix(true, guess):
    r4 = lambda v: float(np.rint(v * 1e4) / 1e4)
    div = lambda a, b: a / b if b > 0 else 0.0

    def prf(tp, fp, fn):
        p, r = div(tp, tp + fp), div(tp, tp + fn)
        return p, r, div(2 * p * r, p + r)

    classes = np.unique(true)
    cells = [(np.sum((true == c) & (guess == c)), np.sum((true != c) & (guess == c)), np.sum((true == c) & (guess != c))) for c in classes]
    rows = {f"Class {c}": tuple(r4(v) for v in prf(*cell)) for c, cell in zip(classes, cells)}
    rounded = np.array(list(rows.values()))
    rows["Micro-Average"] = tuple(r4(v) for v in prf(*np.sum(cells, axis=0)))
    rows["Macro-Average"] = tuple(r4(v) for v in rounded.mean(axis=0))
    return rows
