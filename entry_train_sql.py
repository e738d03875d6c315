"""SQL statements of the trainers, followed step by step: recursive tables for sequential training, unrolled rounds for trees."""

from __future__ import annotations

from entry_sql import FEATURES, GAMMA, LAMBDA, MIN_GAIN, MIN_ROWS, RATE, binary, cte, evaluation, features, statement, summary

# Of the counter-based draw, and of the training parameters of the registered queries.
PRIME, FACTOR, SHIFT = 2_147_483_647, 48_271, 1_013_904_223
LR, ALPHA, SEED, STOP_WINDOW = 0.01, 0.01, 7, 100
SVM_RATE, SVM_LAMBDA = 0.01, 0.01
# Iterations of the published logistic regression.
LR_RUN_STEPS = 300

ZEROS = f"list_transform(range({FEATURES}), lambda f: CAST(0 AS DOUBLE))"
DOT = "list_dot_product({0}, {1})"
P = "1.0 / (1.0 + exp(-greatest(least({0}, 700.0), -700.0)))"


def dense(level: str, rep: str) -> str:
    """Train rows of a level in row order with all features as a list: ``doc_id, y, pos, x``; and its classes and their number."""
    tag = f"{level}_{rep}"
    if f"dense_{tag}" not in _made:
        _made.add(f"dense_{tag}")
        if tag not in ("lang_bow", "toxic_bow", "source_tfidf"):
            features(level, rep)
        lab = f"lab_{level}"
        cte(f"known_{tag}", f"SELECT doc_id, split, y FROM {lab} WHERE y <> -1", lab)
        cte(f"order_{tag}", f"SELECT doc_id, y, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM known_{tag} WHERE split = 'train'", f"known_{tag}")
        cte(
            f"dense_{tag}",
            f"""SELECT o.doc_id, o.y, o.pos, list(coalesce(x.value, 0.0) ORDER BY f.f) AS x
            FROM order_{tag} o CROSS JOIN (SELECT unnest(range({FEATURES})) AS f) f LEFT JOIN x_{tag} x ON x.doc_id = o.doc_id AND x.feature_id = f.f
            GROUP BY o.doc_id, o.y, o.pos""",
            f"order_{tag}",
            f"x_{tag}",
        )
        cte(f"class_{tag}", f"SELECT DISTINCT y AS class FROM order_{tag}", f"order_{tag}")
        cte(f"size_{tag}", f"SELECT count(*) AS n FROM order_{tag}", f"order_{tag}")
    return tag


_made: set[str] = set()


def mixed(z: str) -> tuple[str, str]:
    """Two select lists, one after the other: the linear step, and its fifth power."""
    return f"(({z}) * {FACTOR} + {SHIFT}) % {PRIME} AS l", f"((l * l % {PRIME}) * (l * l % {PRIME}) % {PRIME}) * l % {PRIME} AS z"


def draws(tag: str, steps: int) -> str:
    """``class, step, pos``"""
    name = f"draws_{tag}_{steps}"
    sql = f"SELECT class, unnest(range({steps})) AS step, CAST(0 AS BIGINT) AS z FROM class_{tag}"
    for counter in (str(SEED), "class", "step"):
        linear, power = mixed(f"z + {counter}")
        sql = f"SELECT class, step, {power} FROM (SELECT class, step, {linear} FROM ({sql}))"
    linear, power = mixed("z")
    sql = f"SELECT class, step, high, {power} FROM (SELECT class, step, z AS high, {linear} FROM ({sql}))"
    cte(name, f"SELECT class, step, (high * {PRIME} + z) % n AS pos FROM ({sql}), size_{tag}", f"class_{tag}", f"size_{tag}")
    return name


def stochastic(tag: str, steps: int, tolerance: float) -> str:
    """Single-row steps of all classes: ``class, step, w, b, norms, done``."""
    name, drawn = f"sgd_{tag}_{steps}_{str(tolerance).replace('.', '_').replace('-', 'm')}", draws(tag, steps)
    cte(
        name,
        f"""SELECT class, 0 AS step, {ZEROS} AS w, CAST(0 AS DOUBLE) AS b, []::DOUBLE[] AS norms, false AS done FROM class_{tag}
        UNION ALL
        SELECT class, step + 1, list_transform(w, lambda v, i: v - {LR} * dw[i]), b - {LR} * e, norms,
            len(norms) >= {STOP_WINDOW} AND list_avg(norms[-{STOP_WINDOW}:]) < {tolerance}
        FROM (SELECT class, step, w, b, e, dw, list_append(norms, sqrt({DOT.format('dw', 'dw')}) + abs(e)) AS norms
              FROM (SELECT class, step, w, b, e, norms, list_transform(w, lambda v, i: e * x[i] + {ALPHA} * sign(v)) AS dw
                    FROM (SELECT r.class, r.step, r.w, r.b, r.norms, t.x, {P.format(DOT.format('r.w', 't.x') + ' + r.b')} - CAST(t.y = r.class AS DOUBLE) AS e
                          FROM {name} r JOIN {drawn} d ON d.class = r.class AND d.step = r.step JOIN dense_{tag} t ON t.pos = d.pos WHERE NOT r.done)))""",
        drawn,
        f"dense_{tag}",
        f"class_{tag}",
    )
    return name


def full_batch(tag: str, steps: int) -> str:
    """Steps over all rows: ``class, step, w, b``."""
    name = f"gd_{tag}_{steps}"
    cte(
        name,
        f"""SELECT class, 0 AS step, {ZEROS} AS w, CAST(0 AS DOUBLE) AS b FROM class_{tag}
        UNION ALL
        SELECT class, step + 1, list(v - {LR} * (g / n + {ALPHA} / n * sign(v)) ORDER BY f), any_value(b) - {LR} * any_value(gb) / any_value(n)
        FROM (SELECT class, step, f, any_value(w[f + 1]) AS v, any_value(b) AS b, sum(e * x[f + 1]) AS g, sum(e) AS gb, count(*) AS n
              FROM (SELECT r.class, r.step, r.w, r.b, t.x, {P.format(DOT.format('r.w', 't.x') + ' + r.b')} - CAST(t.y = r.class AS DOUBLE) AS e, unnest(range({FEATURES})) AS f
                    FROM {name} r CROSS JOIN dense_{tag} t WHERE r.step < {steps})
              GROUP BY class, step, f)
        GROUP BY class, step""",
        f"dense_{tag}",
        f"class_{tag}",
    )
    return name


def hinge(tag: str, epochs: int) -> str:
    """Row-by-row hinge steps with 0/1 targets: ``class, step, w, b``."""
    name, decay = f"hinge_{tag}_{epochs}", 1.0 - 2.0 * SVM_RATE * SVM_LAMBDA
    cte(
        name,
        f"""SELECT class, 0 AS step, {ZEROS} AS w, CAST(0 AS DOUBLE) AS b FROM class_{tag}
        UNION ALL
        SELECT class, step + 1, list_transform(w, lambda v, i: v * {decay} + move * x[i]), b - move
        FROM (SELECT r.class, r.step, r.w, r.b, t.x, CASE WHEN t.y = r.class AND {DOT.format('r.w', 't.x')} - r.b < 1.0 THEN {SVM_RATE} ELSE 0.0 END AS move
              FROM {name} r CROSS JOIN size_{tag} JOIN dense_{tag} t ON t.pos = r.step % n WHERE r.step < {epochs} * n)""",
        f"dense_{tag}",
        f"class_{tag}",
        f"size_{tag}",
    )
    return name


def last(name: str) -> str:
    cte(f"last_{name}", f"SELECT * FROM {name} QUALIFY row_number() OVER (PARTITION BY class ORDER BY step DESC) = 1", name)
    return f"last_{name}"


def model_rows(name: str, where: str = "true") -> str:
    """``class, feature_id, w`` with the bias under -1."""
    ended = last(name)
    return statement(
        f"""SELECT class, CAST(feature_id AS INTEGER) AS feature_id, round(w, 8) AS w
        FROM (SELECT class, generate_subscripts(w, 1) - 1 AS feature_id, unnest(w) AS w FROM {ended}) WHERE w <> 0 AND {where}
        UNION ALL SELECT class, -1, round(b, 8) FROM {ended} WHERE {where}""",
        ended,
    )


def scores(name: str, tag: str, sign: str) -> str:
    """``doc_id, split, y, class, z`` of all splits."""
    ended, out = last(name), f"score_{name}"
    cte(
        out,
        f"""SELECT k.doc_id, k.split, k.y, m.class, coalesce(sum(x.value * m.w[x.feature_id + 1]), 0.0) {sign} any_value(m.b) AS z
        FROM known_{tag} k CROSS JOIN {ended} m LEFT JOIN x_{tag} x ON x.doc_id = k.doc_id GROUP BY k.doc_id, k.split, k.y, m.class""",
        f"known_{tag}",
        ended,
        f"x_{tag}",
    )
    return out


def curve(name: str, tag: str, every: int) -> str:
    """Reports of all splits but test after each ``every`` steps."""
    points, scored = f"points_{name}", f"curve_{name}"
    cte(points, f"SELECT class, step AS iteration, w, b FROM {name} WHERE step > 0 AND step % {every} = 0", name)
    cte(
        scored,
        f"""SELECT m.class, m.iteration, k.split, CAST(k.y = m.class AS INTEGER) AS y,
            CAST({P.format('coalesce(sum(x.value * m.w[x.feature_id + 1]), 0.0) + any_value(m.b)')} > 0.5 AS INTEGER) AS prediction
        FROM known_{tag} k CROSS JOIN {points} m LEFT JOIN x_{tag} x ON x.doc_id = k.doc_id WHERE k.split <> 'test'
        GROUP BY k.doc_id, k.split, k.y, m.class, m.iteration""",
        f"known_{tag}",
        points,
        f"x_{tag}",
    )
    return statement(binary(f"SELECT * FROM {scored}", "class, iteration, split"), scored)


def run_summary(tag: str, model: str, kind: str, source: str, key: str) -> str:
    """The report of the predictions of one run."""
    where = f"_{kind}_{tag}"
    evaluation(
        where,
        f"SELECT split, y, prediction, count(*) AS n FROM (SELECT split, y, class AS prediction FROM {source} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {key} DESC, class) = 1) GROUP BY ALL",
        source,
    )
    return summary(where, model)


def level_summary(tag: str, model: str, kind: str, source: str, key: str) -> str:
    """The report of the predictions of one level."""
    level, rep = tag.rsplit("_", 1)
    body = run_summary(tag, model, kind, source, key)
    return f"SELECT '{level}' AS level, '{rep}' AS representation, * FROM ({body})"


# -- boosted trees ----------------------------------------------------------------------------------


def boosted(tag: str, rounds: int, depth: int, only: int | None = None) -> tuple[str, str]:
    """Unrolled rounds of trees: names of the table of nodes and of the logits after the last round. ``only`` keeps one class."""
    b = f"{tag}_{depth}" + ("" if only is None else f"_c{only}")
    x, classes = f"x_{tag}", f"class_{tag}"
    trees = []
    cte(f"lg{b}_0", f"SELECT doc_id, split, k.y, class, CAST(0 AS DOUBLE) AS logit FROM known_{tag} k CROSS JOIN {classes}" + ("" if only is None else f" WHERE class = {only}"), f"known_{tag}", classes)
    for r in range(rounds):
        n = lambda name, d="": f"{name}{b}_{r}_{d}"  # noqa: E731, B023
        cte(
            n("at", 0),
            f"""SELECT doc_id, split, class, p - CAST(y = class AS DOUBLE) AS g, p * (1.0 - p) AS h, 0 AS node
            FROM (SELECT *, 1.0 / (1.0 + exp(-logit)) AS p FROM lg{b}_{r})""",
            f"lg{b}_{r}",
        )
        for d in range(depth + 1):
            if d:
                cte(
                    n("at", d),
                    f"""SELECT a.doc_id, a.split, a.class, a.g, a.h, 2 * a.node + CASE WHEN coalesce(x.value, 0.0) < s.threshold THEN 1 ELSE 2 END AS node
                    FROM {n('at', d - 1)} a JOIN {n('split', d - 1)} s USING (class, node) LEFT JOIN {x} x ON x.doc_id = a.doc_id AND x.feature_id = s.feature_id""",
                    n("at", d - 1),
                    n("split", d - 1),
                    x,
                )
            cte(n("tot", d), f"SELECT class, node, sum(g) AS ga, sum(h) AS ha, count(*) AS na FROM {n('at', d)} WHERE split = 'train' GROUP BY class, node", n("at", d))
            if d == depth:
                break
            cte(
                n("fv", d),
                f"""SELECT class, node, feature_id, value, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {n('at', d)} a JOIN {x} x USING (doc_id)
                WHERE a.split = 'train' GROUP BY class, node, feature_id, value""",
                n("at", d),
                x,
            )
            cte(
                n("split", d),
                f"""SELECT * FROM (SELECT *, 0.5 * (gl * gl / (hl + {LAMBDA}) + (ga - gl) * (ga - gl) / (ha - hl + {LAMBDA}) - ga * ga / (ha + {LAMBDA})) - {GAMMA} AS gain
                    FROM (SELECT class, node, feature_id, value AS threshold, ga, ha, na, ga - sum(g) OVER w AS gl, ha - sum(h) OVER w AS hl, na - sum(n) OVER w AS nl
                          FROM {n('fv', d)} JOIN {n('tot', d)} USING (class, node)
                          WINDOW w AS (PARTITION BY class, node, feature_id ORDER BY value DESC ROWS UNBOUNDED PRECEDING))
                    WHERE nl > 0 QUALIFY row_number() OVER (PARTITION BY class, node ORDER BY round(gain, 9) DESC, feature_id, threshold) = 1)
                WHERE na >= {MIN_ROWS} AND gain > {MIN_GAIN}""",
                n("fv", d),
                n("tot", d),
            )
        splits = [f"SELECT class, {r} AS round, node, feature_id, threshold, CAST(NULL AS DOUBLE) AS value FROM {n('split', d)}" for d in range(depth)]
        leaves = [
            f"SELECT class, {r}, node, NULL, NULL, -ga / (ha + {LAMBDA}) FROM {n('tot', d)} t"
            + ("" if d == depth else f" WHERE NOT EXISTS (SELECT 1 FROM {n('split', d)} s WHERE s.class = t.class AND s.node = t.node)")
            for d in range(depth + 1)
        ]
        needs = [n("split", d) for d in range(depth)] + [n("tot", d) for d in range(depth + 1)]
        cte(n("tree"), " UNION ALL ".join(splits + leaves), *needs)
        trees.append(n("tree"))
        places = " UNION ALL ".join(f"SELECT doc_id, class, node FROM {n('at', d)}" for d in range(depth + 1))
        cte(
            f"lg{b}_{r + 1}",
            f"""SELECT l.doc_id, l.split, l.y, l.class, l.logit + {RATE} * t.value AS logit FROM lg{b}_{r} l
            JOIN (SELECT doc_id, class, max(node) AS node FROM ({places}) GROUP BY doc_id, class) m USING (doc_id, class)
            JOIN {n('tree')} t ON t.class = l.class AND t.node = m.node""",
            f"lg{b}_{r}",
            n("tree"),
            *[n("at", d) for d in range(depth + 1)],
        )
    cte(f"trees{b}", " UNION ALL ".join(f"SELECT * FROM {t}" for t in trees), *trees)
    return f"trees{b}", f"lg{b}_{rounds}"


def statements(levels: tuple[str, ...], steps: int, epochs: int, rounds: int, depth: int) -> dict[str, str]:
    """The trainers' queries; the arguments are the parameters of the registered queries."""
    out = {}
    lang, quality = dense("lang", "bow"), dense("quality", "bow")
    out["lr_fit_stochastic"] = model_rows(stochastic(lang, 300, 1e-6))
    out["lr_curve"] = curve(stochastic(lang, 200, 1e-6), lang, 100)
    stopped = last(stochastic(lang, 300, 5.0))
    out["lr_stop_window"] = statement(f"SELECT class, step AS iterations FROM {stopped}", stopped)
    scored = scores(full_batch(lang, LR_RUN_STEPS), lang, "+")
    cte(f"prob_run_{lang}", f"SELECT doc_id, split, y, class, {P.format('z')} AS p FROM {scored}", scored)
    out["lr_run"] = run_summary(lang, "logistic regression", "run", f"prob_run_{lang}", "p")
    out["svm_ovr_fit"] = model_rows(hinge(lang, epochs))
    out["svm_fit"] = model_rows(hinge(quality, epochs), "class = 1")
    nodes = "SELECT class, round, CAST(node AS INTEGER) AS node_id, feature_id, threshold, round(value, 6) AS value FROM "
    trees, _ = boosted(lang, rounds, depth)
    out["boost_ovr_fit"] = statement(nodes + trees, trees)
    trees, _ = boosted(quality, rounds, depth, only=1)
    out["boost_fit"] = statement(nodes + trees, trees)
    reports: dict[str, list[str]] = {"svm_levels": [], "lr_levels": [], "boost_levels": []}
    for level in levels:
        for rep in ("bow", "tfidf"):
            tag = dense(level, rep)
            reports["svm_levels"].append(level_summary(tag, "linear SVM", "svm", scores(hinge(tag, epochs), tag, "-"), "sign(z)"))
        tag = dense(level, "bow")
        fitted = full_batch(tag, steps) if level == "toxic" else stochastic(tag, steps, 1e-6)
        scored = scores(fitted, tag, "+")
        cte(f"prob_{tag}", f"SELECT doc_id, split, y, class, {P.format('z')} AS p FROM {scored}", scored)
        reports["lr_levels"].append(level_summary(tag, "logistic regression", "lr", f"prob_{tag}", "p"))
        _, logits = boosted(tag, rounds, depth)
        cte(f"share_{tag}", f"SELECT *, 1.0 / (1.0 + exp(-logit)) AS p FROM {logits}", logits)
        reports["boost_levels"].append(level_summary(tag, "boosted trees", "boost", f"share_{tag}", "round(p, 12)"))
    for name, parts in reports.items():
        out[name] = " UNION ALL ".join(f"({part})" for part in parts)
    return out
