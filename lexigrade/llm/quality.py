"""Quality by weak supervision, with DataFrame functions only.

Rules over counts of a text vote good or bad, or abstain. Documents are grouped by their votes, at most three to the
power of the rules, and expectation-maximisation on these counts estimates how often each rule votes what for good and
for bad documents. The posterior probability of good replaces an all-must-pass filter.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrade.session import write_stage

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
ROUNDS = 12

#: Rules: name, condition of a bad vote, condition of a good vote. SQL over the columns of ``counts``.
RULES = (
    ("length", "n_words < 60", "n_words >= 80"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 12 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
    ("symbols", "20 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    ("lines", "5 * n_dup_lines > n_lines", "n_dup_lines = 0"),
    ("repeats", "5 * n_repeat_words > n_words", "25 * n_repeat_words <= n_words"),
    ("capitals", "3 * n_capitals > word_chars", "10 * n_capitals <= word_chars"),
    ("ends", "20 * n_ends < n_words and 5 * n_symbols > n_words or 5 * n_ends > 2 * n_words", "n_ends > 0 and 4 * n_ends <= n_words"),
)


class QualityParams(NamedTuple):
    prior: float = 0.8
    right: float = 0.8
    """Where the rules start: the share of good documents, and of right votes among votes."""
    smoothing: float = 1.0


def counts(docs: DataFrame) -> DataFrame:
    """Counts per document row, all from its own text: no shuffle. A null text counts as an empty one."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(F.translate(text, WHITE, " " * len(WHITE)), " "), "")
    lines = F.transform(F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0), lambda x: F.xxhash64(x))
    base = docs.select("doc_id", text.alias("text"), words.alias("words"), lines.alias("lines"))
    n = F.size("words")
    window = F.transform(
        F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.element_at("words", i), F.element_at("words", i + 1), F.element_at("words", i + 2))
    )
    base = base.withColumn("windows", F.when(n >= 3, window).otherwise(F.array().cast("array<bigint>")))
    # Windows with their places, sorted; those equal to a neighbour are found twice or more.
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("sorted", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), placed))

    def twice(x: Column, k: Column) -> Column:
        before = F.when(k > 0, F.get("sorted", k - 1)["h"] == x["h"])
        after = F.get("sorted", k + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.transform(F.filter("sorted", twice), lambda x: x["i"])
    covered = F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))
    solid = F.translate(F.col("text"), WHITE, "")
    drop = lambda chars: F.length("text") - F.length(F.translate("text", chars, ""))
    return base.select(
        "doc_id", n.cast("long").alias("n_words"), F.length(solid).cast("long").alias("word_chars"), drop(SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("sorted").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), drop("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_capitals"), drop(".!?").cast("long").alias("n_ends"),
    )


def votes(table: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and one vote per rule: 1 good, -1 bad, 0 abstains."""
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return table.select(
        "*", failed.alias("base_failed"), *[F.expr(f"case when {bad} then -1 when {good} then 1 else 0 end").alias(f"v_{name}") for name, bad, good in RULES]
    )


class Rates(NamedTuple):
    """Share of good documents, and per rule the shares of bad, abstaining and good votes: (for good, for bad) documents."""

    good: float
    votes: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]


def posterior(rates: Rates) -> Column:
    """Probability that a document is good, from its votes."""
    odds = F.lit(math.log(rates.good / (1 - rates.good)))
    for (name, _, _), (good, bad) in zip(RULES, rates.votes):
        logs = [math.log(g / b) for g, b in zip(good, bad)]
        odds = odds + F.when(F.col(f"v_{name}") == -1, logs[0]).when(F.col(f"v_{name}") == 0, logs[1]).otherwise(logs[2])
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: DataFrame, params: QualityParams, rounds: int = ROUNDS) -> Rates:
    """Expectation-maximisation over rows (votes, n): one aggregation per round, one row to the driver."""
    names = [f"v_{name}" for name, _, _ in RULES]
    abstain = (1 - params.right) / 2
    start = ((1 - params.right) / 2, abstain, params.right)
    rates = Rates(params.prior, tuple((start, start[::-1]) for _ in names))
    s = params.smoothing
    for _ in range(rounds):
        weighed = patterns.select("n", *names, (posterior(rates) * F.col("n")).alias("g"))
        sums = [F.sum("n"), F.sum("g")]
        for v in names:
            for value in (-1, 0, 1):
                sums += [F.sum(F.when(F.col(v) == value, F.col("g")).otherwise(0.0)), F.sum(F.when(F.col(v) == value, F.col("n") - F.col("g")).otherwise(0.0))]
        total, good, *cells = weighed.agg(*sums).first()
        if not total:
            return rates
        bad = total - good
        found = []
        for k in range(len(names)):
            g, b = cells[6 * k : 6 * k + 6 : 2], cells[6 * k + 1 : 6 * k + 6 : 2]
            found.append((tuple((x + s) / (good + 3 * s) for x in g), tuple((x + s) / (bad + 3 * s) for x in b)))
        rates = Rates((good + s) / (total + 2 * s), tuple(found))
    return rates


def judge(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """One row per document row: doc_id, counts, base_failed, votes, quality (posterior), kept.

    ``kept`` is false where the base rule fails, else whether the posterior is at least one half. A null or wordless text has
    no words and fails; repeated rows are judged each; other columns are ignored; an empty table gives no rows.
    """
    voted = write_stage(votes(counts(docs)), "quality-votes")
    names = [f"v_{name}" for name, _, _ in RULES]
    patterns = write_stage(voted.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "quality-patterns")
    rates = estimate(patterns, params)
    quality = posterior(rates)
    return voted.select("*", quality.alias("quality"), (~F.col("base_failed") & (quality >= 0.5)).alias("kept"))


def oracle_sql(params: QualityParams = QualityParams(), rounds: int = ROUNDS) -> str:
    """The same rows in DuckDB's SQL, the rounds written out."""
    names = [f"v_{name}" for name, _, _ in RULES]
    white = r"[\x20\x09-\x0D]"
    case = ", ".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v_{name}" for name, bad, good in RULES)
    start, ab = params.right, (1 - params.right) / 2
    parts = [
        f"""texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (SELECT *, [x FOR x IN regexp_split_to_array(text, '{white}+') IF x <> ''] AS words,
        [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM texts),
    windows AS (SELECT r, i, words[i] || chr(1) || words[i + 1] || chr(1) || words[i + 2] AS w
        FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM windows) WHERE c > 1),
    covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    counts AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '{white}', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
        (length(text) - length(regexp_replace(text, '[.!?]', '', 'g')))::BIGINT AS n_ends FROM split LEFT JOIN covered USING (r)),
    voted AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {case} FROM counts),
    patterns AS (SELECT {', '.join(names)}, count(*)::DOUBLE AS n FROM voted GROUP BY ALL)""",
        "rates_0 AS (SELECT %r::DOUBLE AS p, %s)"
        % (params.prior, ", ".join(f"{ab!r}::DOUBLE AS g_{v}_b, {ab!r}::DOUBLE AS g_{v}_a, {start!r}::DOUBLE AS g_{v}_g, {start!r}::DOUBLE AS b_{v}_b, {ab!r}::DOUBLE AS b_{v}_a, {ab!r}::DOUBLE AS b_{v}_g" for v in names)),
    ]

    def post() -> str:
        odds = "ln(p / (1 - p)) + " + " + ".join(f"CASE {v} WHEN -1 THEN ln(g_{v}_b / b_{v}_b) WHEN 0 THEN ln(g_{v}_a / b_{v}_a) ELSE ln(g_{v}_g / b_{v}_g) END" for v in names)
        return f"1 / (1 + exp(-({odds})))"

    s = params.smoothing
    for i in range(rounds):
        cells = []
        for v in names:
            for value, tag in ((-1, "b"), (0, "a"), (1, "g")):
                cells.append(f"(sum(CASE WHEN {v} = {value} THEN g ELSE 0 END) + {s}) / (sum(g) + {3 * s}) AS g_{v}_{tag}")
                cells.append(f"(sum(CASE WHEN {v} = {value} THEN n - g ELSE 0 END) + {s}) / (sum(n - g) + {3 * s}) AS b_{v}_{tag}")
        parts.append(f"rates_{i + 1} AS (SELECT (sum(g) + {s}) / (sum(n) + {2 * s}) AS p, {', '.join(cells)} FROM (SELECT {', '.join(names)}, n, n * ({post()}) AS g FROM patterns, rates_{i}))")
    return (
        f"WITH {', '.join(parts)} SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, "
        f"NOT base_failed AND {post()} >= 0.5 AS kept, round({post()}, 6) AS quality FROM voted, rates_{rounds}"
    )
