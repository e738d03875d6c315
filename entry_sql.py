"""SQL statements with the results that the registered queries must give."""

from __future__ import annotations

TOP_WORDS, SKIP_TOP, SKIP_RARE = 2000, 30, 20
KEEP = TOP_WORDS - SKIP_RARE
TERMS = KEEP + SKIP_TOP
FEATURES = KEEP // 10

# Small trainings that SQL can follow: levels, steps, epochs, boosting rounds and tree depth.
RUN_LEVELS, RUN_STEPS, RUN_EPOCHS, RUN_ROUNDS, RUN_DEPTH = ("lang", "source", "toxic"), 120, 2, 2, 2

WORD = r"'[\p{L}\p{N}_]+'"
SPACE = r"'[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"

# Common table expressions in order; a statement takes those that it needs, with what they need.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def statement(body: str, *needs: str) -> str:
    wanted: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][1]:
            visit(need)
        if name not in wanted:
            wanted.append(name)

    for need in needs:
        visit(need)
    # What a recursive table reads again in every step is made once.
    kept = lambda name: " MATERIALIZED" if name.startswith(("dense_", "size_", "draws_", "class_")) else ""
    head = ",\n".join(f"{name} AS{kept(name)} ({CTES[name][0]})" for name in wanted)
    return f"WITH RECURSIVE {head}\n{body}" if head else body


cte(
    "docs",
    """SELECT doc_id, text, lang, source, n_chars, CAST(n_chars // 500 AS INTEGER) AS size,
        CASE WHEN (doc_id // 20) % 5 < 3 THEN 'train' WHEN (doc_id // 20) % 5 = 3 THEN 'validation' ELSE 'test' END AS split
    FROM documents""",
)
cte("ntrain", "SELECT count(*) AS n FROM docs WHERE split = 'train'", "docs")
cte("toks", f"SELECT doc_id, split, unnest(regexp_extract_all(lower(text), {WORD})) AS term FROM docs", "docs")
cte("cnt", "SELECT doc_id, split, term, count(*) AS tf FROM toks GROUP BY doc_id, split, term", "toks")
cte("tterms", "SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM cnt WHERE split = 'train' GROUP BY term", "cnt")
cte(
    "voc",
    f"""SELECT term, tf, df, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id,
        ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf
    FROM (SELECT * FROM tterms ORDER BY tf DESC, term LIMIT {TERMS}), ntrain""",
    "tterms",
    "ntrain",
)
cte("raw", "SELECT doc_id, split, term, term_id, cnt.tf, cnt.tf * idf AS v FROM cnt JOIN voc USING (term)", "cnt", "voc")
cte("weighted", "SELECT doc_id, split, term, term_id, v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)) AS value FROM raw", "raw")
cte("rank_bow", "SELECT term, term_id, CAST(tf AS DOUBLE) AS weight, CAST(row_number() OVER (ORDER BY tf DESC, term) AS INTEGER) AS rank FROM voc", "voc")
cte(
    "rank_tfidf",
    """SELECT term, term_id, weight, CAST(row_number() OVER (ORDER BY round(weight, 9) DESC, term) AS INTEGER) AS rank
    FROM (SELECT term, term_id, sum(value) AS weight FROM weighted WHERE split = 'train' GROUP BY term, term_id)""",
    "weighted",
)
KEPT = f"rank > {SKIP_TOP} AND rank <= {TERMS}"
cte("mat_bow", f"SELECT doc_id, split, term, term_id, CAST(tf AS DOUBLE) AS value FROM raw JOIN rank_bow USING (term, term_id) WHERE {KEPT}", "raw", "rank_bow")
cte("mat_tfidf", f"SELECT doc_id, split, term, term_id, value FROM weighted JOIN rank_tfidf USING (term, term_id) WHERE {KEPT}", "weighted", "rank_tfidf")

LEVELS = ("lang", "source", "size", "quality", "toxic")
MARKED = ("quality", "toxic")
for level in LEVELS:
    joined = "docs JOIN labels USING (doc_id)" if level in MARKED else "docs"
    cte(f"level_{level}", f"SELECT doc_id, split, n_chars, {level} AS label FROM {joined}", "docs")
    cte(
        f"index_{level}",
        f"""SELECT label, CAST(row_number() OVER (ORDER BY first_doc) - 1 AS INTEGER) AS y
        FROM (SELECT label, min(doc_id) AS first_doc FROM level_{level} WHERE split = 'train' GROUP BY label)""",
        f"level_{level}",
    )
    cte(
        f"lab_{level}",
        f"SELECT doc_id, split, n_chars, label, coalesce(y, -1) AS y FROM level_{level} LEFT JOIN index_{level} USING (label)",
        f"level_{level}",
        f"index_{level}",
    )


def features(level: str, rep: str) -> None:
    """Mutual information, selected features and projected rows of a level."""
    tag = f"{level}_{rep}"
    lab, mat = f"lab_{level}", f"mat_{rep}"
    cte(f"tr_{tag}", f"SELECT doc_id, y FROM {lab} WHERE split = 'train'", lab)
    cte(f"nj_{tag}", f"SELECT y, count(*) AS nj FROM tr_{tag} GROUP BY y", f"tr_{tag}")
    cte(
        f"nz_{tag}",
        f"SELECT term, term_id, round(value, 12) AS value, y, count(*) AS n FROM {mat} JOIN tr_{tag} USING (doc_id) GROUP BY 1, 2, 3, 4",
        mat,
        f"tr_{tag}",
    )
    cte(
        f"cells_{tag}",
        f"""SELECT term, term_id, value, y, n FROM nz_{tag}
        UNION ALL
        SELECT t.term, t.term_id, 0.0, j.y, j.nj - coalesce(s.n, 0)
        FROM (SELECT DISTINCT term, term_id FROM nz_{tag}) t CROSS JOIN nj_{tag} j
        LEFT JOIN (SELECT term_id, y, sum(n) AS n FROM nz_{tag} GROUP BY 1, 2) s ON s.term_id = t.term_id AND s.y = j.y
        WHERE j.nj - coalesce(s.n, 0) > 0""",
        f"nz_{tag}",
        f"nj_{tag}",
    )
    cte(
        f"mi_{tag}",
        f"""SELECT term, term_id, greatest(sum(n / total * ln(n * total / (ni * nj))), 0.0) AS mi
        FROM (SELECT c.term, c.term_id, CAST(c.n AS DOUBLE) AS n, CAST(sum(c.n) OVER (PARTITION BY c.term_id, c.value) AS DOUBLE) AS ni,
              CAST(j.nj AS DOUBLE) AS nj, CAST((SELECT sum(nj) FROM nj_{tag}) AS DOUBLE) AS total
              FROM cells_{tag} c JOIN nj_{tag} j USING (y))
        GROUP BY term, term_id""",
        f"cells_{tag}",
        f"nj_{tag}",
    )
    cte(
        f"feat_{tag}",
        f"""SELECT term, term_id, mi, CAST(row_number() OVER (ORDER BY round(mi, 9) DESC, term_id) - 1 AS INTEGER) AS feature_id
        FROM mi_{tag} ORDER BY feature_id LIMIT {FEATURES}""",
        f"mi_{tag}",
    )
    cte(
        f"x_{tag}",
        f"""SELECT m.doc_id, m.split, l.y, f.feature_id, m.value
        FROM {mat} m JOIN feat_{tag} f USING (term_id) JOIN (SELECT doc_id, y FROM {lab} WHERE y <> -1) l USING (doc_id)""",
        mat,
        f"feat_{tag}",
        lab,
    )


features("lang", "bow")
features("toxic", "bow")
features("source", "tfidf")

# Rows, classes and cells of the level that the models use.
def level_rows(level: str, t: str = "") -> None:
    cte(f"rows0{t}", f"SELECT doc_id, split, y FROM lab_{level} WHERE y <> -1", f"lab_{level}")
    cte(f"classes{t}", f"SELECT DISTINCT y AS class FROM rows0{t} WHERE split = 'train'", f"rows0{t}")
    cte(f"x{t}", f"SELECT * FROM x_{level}_bow", f"x_{level}_bow")
    cte(f"dc{t}", f"SELECT doc_id, split, y, class, CAST(y = class AS INTEGER) AS target FROM rows0{t}, classes{t}", f"rows0{t}", f"classes{t}")
    cte(f"ntrain_rows{t}", f"SELECT count(*) AS n FROM rows0{t} WHERE split = 'train'", f"rows0{t}")


def step(i: int, t: str = "") -> None:
    """One full-batch step of the L1 logistic regression: probabilities, then weights."""
    lr, alpha = 0.01, 0.01
    if i == 1:
        cte(f"p0{t}", f"SELECT doc_id, class, target, 0.5 AS p FROM dc{t} WHERE split = 'train'", f"dc{t}")
        before_w, before_b, needs = "0.0", "0.0", (f"p0{t}",)
    else:
        before_w, before_b, needs = "coalesce(o.w, 0.0)", "o.b", (f"p{i - 1}{t}", f"w{i - 1}{t}", f"b{i - 1}{t}")
    old_w = "" if i == 1 else f"LEFT JOIN w{i - 1}{t} o USING (class, feature_id)"
    old_b = "" if i == 1 else f"JOIN b{i - 1}{t} o USING (class)"
    cte(
        f"w{i}{t}",
        f"""SELECT class, feature_id, {before_w} - {lr} * (g / n + {alpha} / n * sign({before_w})) AS w
        FROM (SELECT class, feature_id, sum(value * (p - target)) AS g FROM p{i - 1}{t} JOIN x{t} USING (doc_id) GROUP BY class, feature_id)
        CROSS JOIN ntrain_rows{t} {old_w}""",
        *needs,
        f"x{t}",
        f"ntrain_rows{t}",
    )
    cte(
        f"b{i}{t}",
        f"SELECT class, {before_b} - {lr} * g AS b FROM (SELECT class, avg(p - target) AS g FROM p{i - 1}{t} GROUP BY class) {old_b}",
        *needs,
    )
    cte(
        f"z{i}{t}",
        f"""SELECT doc_id, split, y, dc{t}.class, target, coalesce(s.s, 0.0) + b.b AS z, coalesce(s.s, 0.0) - b.b AS margin
        FROM dc{t} JOIN b{i}{t} b USING (class)
        LEFT JOIN (SELECT doc_id, class, sum(value * w) AS s FROM x{t} JOIN w{i}{t} USING (feature_id) GROUP BY 1, 2) s USING (doc_id, class)""",
        f"dc{t}",
        f"x{t}",
        f"w{i}{t}",
        f"b{i}{t}",
    )
    cte(f"pp{i}{t}", f"SELECT doc_id, split, y, class, target, 1.0 / (1.0 + exp(-greatest(least(z, 700.0), -700.0))) AS p FROM z{i}{t}", f"z{i}{t}")
    cte(f"p{i}{t}", f"SELECT doc_id, class, target, p FROM pp{i}{t} WHERE split = 'train'", f"pp{i}{t}")


level_rows("lang")
level_rows("toxic", "_toxic")
step(1)
step(2)
for _i in (1, 2, 3):
    step(_i, "_toxic")

# First trees: p = 1/2, so a cell needs only its rows and its rows of the class.
LAMBDA, GAMMA, MIN_ROWS, MIN_GAIN, RATE = 1.0, 0.1, 5, 0.01, 0.1


def tree_level(depth: int) -> None:
    """Candidates and best splits of the nodes of one depth, from the rows assigned to them."""
    at = f"at{depth}"
    if depth == 0:
        cte(at, "SELECT doc_id, split, class, 0.5 - target AS g, 0.25 AS h, 0 AS node FROM dc", "dc")
    else:
        up = depth - 1
        cte(
            at,
            f"""SELECT a.doc_id, a.split, a.class, a.g, a.h,
                2 * a.node + CASE WHEN coalesce(x.value, 0.0) < s.threshold THEN 1 ELSE 2 END AS node
            FROM at{up} a JOIN split{up} s USING (class, node)
            LEFT JOIN x ON x.doc_id = a.doc_id AND x.feature_id = s.feature_id""",
            f"at{up}",
            f"split{up}",
            "x",
        )
    cte(
        f"tot{depth}",
        f"SELECT class, node, sum(g) AS ga, sum(h) AS ha, count(*) AS na FROM {at} WHERE split = 'train' GROUP BY class, node",
        at,
    )
    cte(
        f"fv{depth}",
        f"""SELECT class, node, feature_id, value, sum(g) AS g, sum(h) AS h, count(*) AS n
        FROM {at} a JOIN x USING (doc_id) WHERE a.split = 'train' GROUP BY class, node, feature_id, value""",
        at,
        "x",
    )
    cte(
        f"cand{depth}",
        f"""SELECT class, node, feature_id, value AS threshold, g_left, h_left, n_left, ga, ha, na,
            0.5 * (g_left * g_left / (h_left + {LAMBDA}) + (ga - g_left) * (ga - g_left) / (ha - h_left + {LAMBDA}) - ga * ga / (ha + {LAMBDA})) - {GAMMA} AS gain
        FROM (SELECT class, node, feature_id, value, ga, ha, na,
              ga - sum(g) OVER w AS g_left, ha - sum(h) OVER w AS h_left, na - sum(n) OVER w AS n_left
              FROM fv{depth} JOIN tot{depth} USING (class, node)
              WINDOW w AS (PARTITION BY class, node, feature_id ORDER BY value DESC ROWS UNBOUNDED PRECEDING))
        WHERE n_left > 0""",
        f"fv{depth}",
        f"tot{depth}",
    )
    cte(
        f"best{depth}",
        f"""SELECT * FROM cand{depth}
        QUALIFY row_number() OVER (PARTITION BY class, node ORDER BY round(gain, 9) DESC, feature_id, threshold) = 1""",
        f"cand{depth}",
    )
    cte(f"split{depth}", f"SELECT * FROM best{depth} WHERE na >= {MIN_ROWS} AND gain > {MIN_GAIN}", f"best{depth}")


for d in (0, 1):
    tree_level(d)
# Rows below the last tested level only need totals.
cte(
    "at2",
    """SELECT a.doc_id, a.split, a.class, a.g, a.h, 2 * a.node + CASE WHEN coalesce(x.value, 0.0) < s.threshold THEN 1 ELSE 2 END AS node
    FROM at1 a JOIN split1 s USING (class, node) LEFT JOIN x ON x.doc_id = a.doc_id AND x.feature_id = s.feature_id""",
    "at1",
    "split1",
    "x",
)
cte("tot2", "SELECT class, node, sum(g) AS ga, sum(h) AS ha, count(*) AS na FROM at2 WHERE split = 'train' GROUP BY class, node", "at2")
_leaf = f"-ga / (ha + {LAMBDA})"
cte(
    "tree",
    "\nUNION ALL ".join(
        [f"SELECT class, node, feature_id, threshold, NULL AS value FROM split{d}" for d in (0, 1)]
        + [f"SELECT class, node, NULL, NULL, {_leaf} FROM tot{d} t WHERE NOT EXISTS (SELECT 1 FROM split{d} s WHERE s.class = t.class AND s.node = t.node)" for d in (0, 1)]
        + [f"SELECT class, node, NULL, NULL, {_leaf} FROM tot2"]
    ),
    "split0",
    "split1",
    "tot0",
    "tot1",
    "tot2",
)
cte(
    "leaf_of",
    """SELECT r.doc_id, r.split, r.class, t.value
    FROM (SELECT doc_id, split, class, max(node) AS node
          FROM (SELECT doc_id, split, class, node FROM at0 UNION ALL SELECT doc_id, split, class, node FROM at1 UNION ALL SELECT doc_id, split, class, node FROM at2)
          GROUP BY doc_id, split, class) r
    JOIN tree t ON t.class = r.class AND t.node = r.node""",
    "at0",
    "at1",
    "at2",
    "tree",
)
cte("bp", f"SELECT doc_id, class, 1.0 / (1.0 + exp(-{RATE} * value)) AS p FROM leaf_of", "leaf_of")

def prf(tp: str, fp: str, fn: str) -> str:
    """Select list of precision, recall and f1, not rounded."""
    p = f"CASE WHEN {tp} + {fp} > 0 THEN {tp} / CAST({tp} + {fp} AS DOUBLE) ELSE 0.0 END"
    r = f"CASE WHEN {tp} + {fn} > 0 THEN {tp} / CAST({tp} + {fn} AS DOUBLE) ELSE 0.0 END"
    return f"{p} AS p, {r} AS r"


F1 = "CASE WHEN p + r > 0 THEN 2.0 * p * r / (p + r) ELSE 0.0 END"
ROUNDED = f"round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even({F1}, 4) AS f1"
def evaluation(tag: str, source: str, *needs: str) -> None:
    """Reports of a guess; ``source`` gives ``split, y, prediction, n``."""
    cte(f"guess{tag}", source, *needs)
    cte(
        f"counts{tag}",
        f"""SELECT t.split, t.class, t.tp, coalesce(f.n, 0) - t.tp AS fp, t.n - t.tp AS fn
        FROM (SELECT split, y AS class, CAST(sum(n) AS BIGINT) AS n, CAST(coalesce(sum(n) FILTER (y = prediction), 0) AS BIGINT) AS tp FROM guess{tag} GROUP BY split, y) t
        LEFT JOIN (SELECT split, prediction AS class, CAST(sum(n) AS BIGINT) AS n FROM guess{tag} GROUP BY split, prediction) f USING (split, class)""",
        f"guess{tag}",
    )
    counts = f"counts{tag}"
    cte(f"prf_class{tag}", f"SELECT split, class, {ROUNDED} FROM (SELECT split, class, {prf('tp', 'fp', 'fn')} FROM {counts})", counts)
    sums = f"SELECT split, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM {counts} GROUP BY split"
    cte(f"prf_micro{tag}", f"SELECT split, {ROUNDED} FROM (SELECT split, {prf('tp', 'fp', 'fn')} FROM ({sums}))", counts)
    means = ", ".join(f"round_even(sum(round({m} * 10000)) / count(*), 0) / 10000 AS {m}" for m in ("precision", "recall", "f1"))
    cte(f"prf_macro{tag}", f"SELECT split, {means} FROM prf_class{tag} GROUP BY split", f"prf_class{tag}")
    cte(f"acc{tag}", f"SELECT split, sum(n) FILTER (y = prediction) / CAST(sum(n) AS DOUBLE) AS accuracy FROM guess{tag} GROUP BY split", f"guess{tag}")


def summary(tag: str, model: str) -> str:
    averages = ", ".join(f"{t}.{m} AS {name}_{m}" for t, name in (("i", "micro"), ("a", "macro")) for m in ("precision", "recall", "f1"))
    return statement(
        f"""SELECT '{model}' AS model, split, round(accuracy, 6) AS accuracy, {averages}
        FROM acc{tag} JOIN prf_micro{tag} i USING (split) JOIN prf_macro{tag} a USING (split)""",
        f"acc{tag}",
        f"prf_micro{tag}",
        f"prf_macro{tag}",
    )


MATRIX = """SELECT split, 'Class ' || class AS category, precision, recall, f1 FROM prf_class
UNION ALL SELECT split, 'Micro-Average', precision, recall, f1 FROM prf_micro
UNION ALL SELECT split, 'Macro-Average', precision, recall, f1 FROM prf_macro"""
ARGMAX = "SELECT doc_id, class AS prediction FROM {rows} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {key} DESC, class) = 1"

# A fixed guess over five classes.
evaluation("", "SELECT split, y, CAST((doc_id * 7 + n_chars) % 5 AS INTEGER) AS prediction, count(*) AS n FROM lab_lang GROUP BY ALL", "lab_lang")


def binary(source: str, by: str) -> str:
    """Report of 0/1 predictions; ``source`` gives ``by, y, prediction``."""
    cells = ", ".join(
        f"count(*) FILTER (prediction = {p} AND y = {t}) AS {name}" for name, p, t in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0))
    )
    parts = {"class1": ("tp", "fp", "fn"), "class0": ("tn", "fn", "fp"), "micro": ("(tp + tn)", "(fp + fn)", "(fp + fn)")}
    inner = f"SELECT {by}, {cells} FROM ({source}) GROUP BY {by}"
    rates = []
    for name, (tp, fp, fn) in parts.items():
        rates += [c.replace(" AS p", f" AS p_{name}").replace(" AS r", f" AS r_{name}") for c in [prf(tp, fp, fn)]]
    second = f"SELECT *, {', '.join(rates)} FROM ({inner})"
    f1s = ", ".join(f"CASE WHEN p_{m} + r_{m} > 0 THEN 2.0 * p_{m} * r_{m} / (p_{m} + r_{m}) ELSE 0.0 END AS f_{m}" for m in parts)
    third = f"SELECT *, {f1s} FROM ({second})"
    named = {"precision": "p", "recall": "r", "f1": "f"}
    columns = [f"round_even({short}_{m}, 4) AS {m}_{long}" for m in parts for long, short in named.items()]
    columns += [f"round_even(({short}_class1 + {short}_class0) / 2, 4) AS macro_{long}" for long, short in named.items()]
    return f"SELECT {by}, tp + fp + fn + tn AS n, round((tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE), 6) AS accuracy, {', '.join(columns)} FROM ({third})"


def oracle_sql() -> dict[str, str]:
    both = lambda body: " UNION ALL ".join(body.replace("{rep}", r) for r in ("bow", "tfidf"))
    out = {
        "read_corpus": statement(
            """SELECT row_number() OVER (ORDER BY list_position(['train', 'validation', 'test'], split), doc_id) - 1 AS doc_id, split, lang AS label,
                CAST(length(text) AS INTEGER) AS chars FROM docs""",
            "docs",
        ),
        "select_level": statement(
            " UNION ALL ".join(f"SELECT '{v}' AS level, split, CAST(label AS VARCHAR) AS label, count(*) AS n_docs FROM level_{v} GROUP BY split, label" for v in LEVELS),
            *[f"level_{v}" for v in LEVELS],
        ),
        "report_sink": statement(MATRIX, "prf_class", "prf_micro", "prf_macro"),
        "word_tokens": f"""SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS at, unnest(t) AS token
            FROM (SELECT doc_id, regexp_extract_all(lower(text), {WORD}) AS t FROM documents)""",
        "ws_tokens": f"""SELECT doc_id, CAST(generate_subscripts(t, 1) - 1 AS INTEGER) AS at, unnest(t) AS token
            FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), {SPACE}), lambda piece: piece <> '') AS t FROM documents)""",
        "term_counts": statement("SELECT doc_id, term, tf FROM cnt", "cnt"),
        "fit_vocab": statement("SELECT term, term_id, tf FROM voc", "voc"),
        "doc_freq": statement("SELECT term, df FROM tterms", "tterms"),
        "corpus_vocabulary": statement("SELECT term, tf, df, round(ln((1.0 + n) / (1.0 + df)) + 1.0, 6) AS idf FROM tterms, ntrain", "tterms", "ntrain"),
        "smooth_idf": statement("SELECT term, df, round(idf, 6) AS idf FROM voc", "voc"),
        "tfidf_l2": statement("SELECT doc_id, split, term, round(value, 6) AS value FROM weighted", "weighted"),
        "transform_heldout": statement("SELECT doc_id, split, term, round(value, 6) AS value FROM weighted WHERE split <> 'train'", "weighted"),
        "term_weight_rank": statement(both("SELECT '{rep}' AS representation, term, round(weight, 6) AS weight, rank FROM rank_{rep}"), "rank_bow", "rank_tfidf"),
        "skip_top_words": statement(both(f"SELECT '{{rep}}' AS representation, term, rank, {KEPT} AS kept FROM rank_{{rep}}"), "rank_bow", "rank_tfidf"),
        "keep_columns": statement("SELECT doc_id, split, term, value FROM mat_bow", "mat_bow"),
        "vocabulary": statement("SELECT term, term_id FROM voc", "voc"),
        "label_index": statement(
            " UNION ALL ".join(f"SELECT '{v}' AS level, CAST(label AS VARCHAR) AS label, y FROM index_{v}" for v in LEVELS), *[f"index_{v}" for v in LEVELS]
        ),
        "encode_train": statement("SELECT doc_id, label, y FROM lab_source WHERE split = 'train'", "lab_source"),
        "encode_heldout": statement("SELECT doc_id, split, label, y FROM lab_size WHERE split <> 'train'", "lab_size"),
        "drop_unseen": statement("SELECT doc_id, split, label, y FROM lab_size WHERE y <> -1", "lab_size"),
        "distinct_classes": statement("SELECT DISTINCT y FROM lab_source WHERE split = 'train'", "lab_source"),
        "one_vs_rest_labels": statement("SELECT doc_id, class, target FROM dc", "dc"),
        "decode_signed": statement("SELECT doc_id, class, CASE WHEN sign(margin) = -1 THEN 0 ELSE 1 END AS decoded FROM z1", "z1"),
        "contingency": statement("SELECT term, value, y, CAST(n AS BIGINT) AS n FROM cells_lang_bow", "cells_lang_bow"),
        "mutual_information": statement("SELECT term, round(mi, 6) AS mi FROM mi_lang_bow", "mi_lang_bow"),
        "top_k_features": statement("SELECT term, feature_id, round(mi, 6) AS mi FROM feat_lang_bow", "feat_lang_bow"),
        "project_splits": statement("SELECT doc_id, split, feature_id, value FROM x_lang_bow", "x_lang_bow"),
        "preprocess": statement("SELECT doc_id, split, y, feature_id, round(value, 6) AS value FROM x_source_tfidf", "x_source_tfidf"),
        "svm_margin": statement("SELECT doc_id, class, round(margin, 6) AS score FROM z1", "z1"),
        "svm_sign": statement("SELECT doc_id, class, CAST(sign(margin) AS INTEGER) AS sign FROM z1", "z1"),
        "svm_ovr_predict": statement(ARGMAX.format(rows="z1", key="sign(margin)"), "z1"),
        "sigmoid_clipped": statement(
            """SELECT doc_id, class, round(1.0 / (1.0 + exp(-clipped)), 6) AS p, round(-ln(1.0 + exp(abs(clipped))), 6) AS log_of_smaller
            FROM (SELECT doc_id, class, greatest(least(5000.0 * z, 700.0), -700.0) AS clipped FROM z1)""",
            "z1",
        ),
        "linear_score": statement("SELECT doc_id, class, round(z, 6) AS score FROM z1", "z1"),
        "lr_fit_batch": statement(
            "SELECT class, feature_id, round(w, 8) AS w FROM w2 WHERE w <> 0 UNION ALL SELECT class, -1, round(b, 8) FROM b2", "w2", "b2"
        ),
        "lr_ovr_fit": statement(
            "SELECT class, feature_id, round(w, 8) AS w FROM w3_toxic WHERE w <> 0 UNION ALL SELECT class, -1, round(b, 8) FROM b3_toxic", "w3_toxic", "b3_toxic"
        ),
        "lr_proba": statement("SELECT doc_id, class, round(p, 6) AS p FROM pp1", "pp1"),
        "lr_predict": statement("SELECT doc_id, class, CASE WHEN p <= 0.5 THEN 0 ELSE 1 END AS prediction FROM pp1", "pp1"),
        "lr_ovr_predict": statement(ARGMAX.format(rows="pp1", key="p"), "pp1"),
        "lr_ovr_proba": statement("SELECT doc_id, class, round(p / sum(p) OVER (PARTITION BY doc_id), 6) AS p FROM pp1", "pp1"),
        "binary_metrics": statement(
            binary("SELECT split, label AS y, CAST(n_chars > 1500 AS INTEGER) AS prediction FROM level_quality", "split"), "level_quality"
        ),
        "init_logit": statement(
            """SELECT class, round(share, 6) AS share, round(ln(share / (1.0 - share)), 6) AS logit
            FROM (SELECT y AS class, count(*) / CAST((SELECT n FROM ntrain_rows) AS DOUBLE) AS share FROM rows0 WHERE split = 'train' GROUP BY y)""",
            "rows0",
            "ntrain_rows",
        ),
        "grad_hess": statement("SELECT doc_id, class, round(p - target, 6) AS g, round(p * (1.0 - p), 6) AS h FROM pp1", "pp1"),
        "split_gain": statement("SELECT class, feature_id, threshold, round(gain, 6) AS gain, CAST(n_left AS BIGINT) AS n_left FROM cand0", "cand0"),
        "best_split": statement("SELECT class, feature_id, threshold, round(gain, 6) AS gain FROM best0", "best0"),
        "best_split_dense": f"""WITH v AS (SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS feature_id,
                CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings),
            k AS (SELECT DISTINCT label AS class FROM embeddings),
            cells AS (SELECT class, feature_id, value, sum(0.5 - CAST(label = class AS INTEGER)) AS g, sum(0.25) AS h, count(*) AS n
                FROM v, k GROUP BY class, feature_id, value),
            run AS (SELECT class, feature_id, value AS threshold, sum(g) OVER w - g AS gl, sum(h) OVER w - h AS hl, sum(n) OVER w - n AS n_left,
                sum(g) OVER (PARTITION BY class, feature_id) AS ga, sum(h) OVER (PARTITION BY class, feature_id) AS ha
                FROM cells WINDOW w AS (PARTITION BY class, feature_id ORDER BY value ROWS UNBOUNDED PRECEDING)),
            cand AS (SELECT *, 0.5 * (gl * gl / (hl + {LAMBDA}) + (ga - gl) * (ga - gl) / (ha - hl + {LAMBDA}) - ga * ga / (ha + {LAMBDA})) - {GAMMA} AS gain
                FROM run WHERE n_left > 0)
            SELECT class, feature_id, round(threshold, 6) AS threshold, round(gain, 6) AS gain, CAST(n_left AS BIGINT) AS n_left FROM cand
            QUALIFY row_number() OVER (PARTITION BY class ORDER BY round(gain, 9) DESC, feature_id, threshold) = 1""",
        "leaf_value": statement(
            f"""SELECT class, feature_id, threshold, round(-g_left / (h_left + {LAMBDA}), 6) AS left_value,
                round(-(ga - g_left) / (ha - h_left + {LAMBDA}), 6) AS right_value FROM cand0""",
            "cand0",
        ),
        "build_tree": statement("SELECT class, CAST(node AS INTEGER) AS node_id, feature_id, threshold, round(value, 6) AS value FROM tree", "tree"),
        "apply_tree": statement("SELECT doc_id, class, round(value, 6) AS value FROM leaf_of", "leaf_of"),
        "boost_proba": statement("SELECT doc_id, class, round(p, 6) AS p FROM bp", "bp"),
        "boost_predict": statement("SELECT doc_id, class, CAST(p >= 0.5 AS INTEGER) AS prediction FROM bp", "bp"),
        "boost_ovr_proba": statement("SELECT doc_id, class, round(p / sum(p) OVER (PARTITION BY doc_id), 6) AS p FROM bp", "bp"),
        "boost_ovr_predict": statement(ARGMAX.format(rows="bp", key="round(p, 12)"), "bp"),
        "accuracy": statement("SELECT split, round(accuracy, 6) AS accuracy FROM acc", "acc"),
        "class_counts": statement("SELECT split, class, tp, fp, fn FROM counts", "counts"),
        "per_class_prf": statement("SELECT * FROM prf_class", "prf_class"),
        "micro_avg": statement("SELECT * FROM prf_micro", "prf_micro"),
        "macro_avg": statement("SELECT * FROM prf_macro", "prf_macro"),
        "metrics_matrix": statement(MATRIX, "prf_class", "prf_micro", "prf_macro"),
        "summary": summary("", "guess"),
        "lr_stop_batch": statement(
            """SELECT class, CASE WHEN sqrt(sum(w * w)) / 0.01 < 2.4 AND abs(any_value(b)) / 0.01 < 2.4 THEN 1 ELSE 2 END AS iterations
            FROM w1 JOIN b1 USING (class) GROUP BY class""",
            "w1",
            "b1",
        ),
        "fit_predict_splits": statement(f"SELECT doc_id, split, y, prediction FROM ({ARGMAX.format(rows='pp1', key='p')}) JOIN rows0 USING (doc_id)", "pp1", "rows0"),
    }
    # Sequences: vocabulary ids shifted by one, in text order.
    cte("pos", f"SELECT doc_id, split, lang, generate_subscripts(t, 1) AS place, unnest(t) AS term FROM (SELECT doc_id, split, lang, regexp_extract_all(lower(text), {WORD}) AS t FROM docs)", "docs")
    cte(
        "seqs",
        """SELECT d.doc_id, d.split, coalesce(i.y, -1) AS y, coalesce(s.seq, []) AS seq
        FROM docs d LEFT JOIN index_lang i ON i.label = d.lang
        LEFT JOIN (SELECT doc_id, list(CAST(term_id + 1 AS BIGINT) ORDER BY place) AS seq FROM pos JOIN voc USING (term) GROUP BY doc_id) s USING (doc_id)""",
        "docs",
        "index_lang",
        "pos",
        "voc",
    )
    cte("seqlen", "SELECT split, CAST(floor(avg(len(seq))) AS BIGINT) AS n FROM seqs GROUP BY GROUPING SETS ((split), ())", "seqs")
    padded = "array_to_string(list_resize(seq, n, CAST(0 AS BIGINT)), ' ') AS x"
    out["pad_length"] = statement(
        "SELECT 'average' AS padding, n AS length FROM seqlen WHERE split IS NULL UNION ALL SELECT 'longest', CAST(max(len(seq)) AS BIGINT) FROM seqs", "seqs", "seqlen"
    )
    out["pad_truncate"] = statement(f"SELECT doc_id, {padded} FROM seqs, seqlen WHERE seqlen.split IS NULL", "seqs", "seqlen")
    out["padded_dataset"] = statement(
        f"SELECT doc_id, split, {padded}, CAST(y AS BIGINT) AS y FROM seqs JOIN seqlen USING (split)", "seqs", "seqlen"
    )
    import entry_train_sql

    return out | entry_train_sql.statements(RUN_LEVELS, RUN_STEPS, RUN_EPOCHS, RUN_ROUNDS, RUN_DEPTH)
