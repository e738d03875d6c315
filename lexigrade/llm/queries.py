"""The registered queries of these operators, over whole tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrade.llm import decontaminate, html_extract, jaccard_join, line_runs, packing, prefix_trie, quality, repair, secret_scan, tool_chat, toxicity, url_filter, warc
from lexigrade.session import write_stage

#: Fixed values: the rules that decide first.
RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)
#: Globs for urls that no rule decides.
GLOBS = tuple(
    url_filter.Rule("block", host, path)
    for host, path in (("*spam*.*", ""), ("*cheap-pills*.*", ""), ("*casino*.*", ""), ("*porn*.*", ""), ("*", "/*/login"), ("*", "/*.exe"))
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, toxicity.learnable(labels.select("doc_id", F.col("toxic").alias("label"))))
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.scorer(docs, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.judge(table(spark, sf, "documents"))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(*names, F.round("quality", 6).alias("quality"))


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_runs.drop_common_lines(table(spark, sf, "documents"))
    digest = F.sha2(F.col("__lines.text").cast("binary"), 256)
    return kept.select(
        "doc_id", F.col("__lines.lines").alias("n_lines"), F.col("__lines.dropped").alias("n_dropped"), digest.alias("kept_sha256")
    )


def op4_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")  # noqa: E731
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: E731
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf, "pages"), RULES, GLOBS)


def op6_html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(table(spark, sf, "pages"))


def op7_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated_passages(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_tool_chat(spark: SparkSession, sf: str) -> DataFrame:
    return tool_chat.format_chats(table(spark, sf, "conversations"))


def op9_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.class_of_documents(table(spark, sf, "documents"))


def op10_best_fit_pack(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Every twentieth turn dropped (``copies`` 0), blanked, cut off, repeated (``copies`` 2) or given to the user, by its key's CRC."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), blank), F.coalesce(F.col("text"), blank)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(hit == 4, "user").otherwise(role).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies"),
    )


def op11_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.report(repair.repair(damaged(table(spark, sf, "conversations")), "copies"))


def op12_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf, "pages"))


#: Conversations that begin alike, and the most turns that they take from the first of them.
FAMILY, SHARED_TURNS = 20, 4


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of their family's first one, and the numbers of their turns.

    ``turns`` are those of ``prefix_trie.numbered``. Only the first three turns of a conversation are ever joined to others, so none is gathered.
    """
    take = F.coalesce(F.crc32(F.col("conv").cast("string").cast("binary")) % SHARED_TURNS, F.lit(0))
    sizes = write_stage(prefix_trie.members_of(turns), "families")
    first = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_turns"))
    families = sizes.withColumn("base", F.col("conv") - F.col("conv") % FAMILY).withColumn("take", take).join(first, "base", "left")
    families = families.withColumn("taken", F.least("take", F.coalesce("base_turns", F.lit(0))))
    families = families.withColumn("total", F.col("taken") + F.greatest(F.col("n") - F.col("take"), F.lit(0)))
    families = write_stage(families, "families")
    heads = turns.where(F.col("depth") < SHARED_TURNS).where(F.col("conv") % FAMILY == 0).withColumnRenamed("conv", "base")
    taken = families.where("taken > 0").select("conv", "base", "taken").join(heads, "base").where("depth <= taken").select(*turns.columns)
    # Own turns move up where the first conversation is too short or not there.
    moved = families.where("taken < take").select(F.col("conv").alias("c"), (F.col("take") - F.col("taken")).alias("up"))
    own = turns.where(F.col("depth") > take).join(moved, F.col("conv") == F.col("c"), "left")
    own = own.withColumn("depth", F.col("depth") - F.coalesce("up", F.lit(0))).select(*turns.columns)
    return own.unionByName(taken), families.select("conv", F.col("total").cast("long").alias("n"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = prefix_trie.numbered(table(spark, sf, "conversations"))
    return prefix_trie.build(*rebuilt(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_quality_rules, op3_line_dedup, op4_secret_scan, op5_url_filter, op6_html_extract, op7_decontaminate,
        op8_tool_chat, op9_jaccard_join, op10_best_fit_pack, op11_structure_repair, op12_warc, op13_prefix_trie,
    )
}  # fmt: skip

_STRIPPED = r"regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '')"

OP3_SQL = rf"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM rows),
keyed AS (SELECT r, doc_id, i, line, translate({_STRIPPED}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS last_id FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT r, keyed.doc_id, i, line, last_id IS NOT NULL AND last_id <> keyed.doc_id AS gone FROM keyed LEFT JOIN common USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r"""

OP5_SQL = r"""
WITH rest AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages),
parts AS (SELECT r, page_id, translate(regexp_extract(u, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules AS (SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(v, h, p)),
globs AS (SELECT * FROM (VALUES
    ('*spam*.*', '%.%spam%.%'), ('*cheap-pills*.*', '%.%cheap-pills%.%'), ('*casino*.*', '%.%casino%.%'), ('*porn*.*', '%.%porn%.%')) t(g, l)),
found AS (SELECT r, h || p AS rule, v FROM parts, rules WHERE ('.' || host) LIKE '%.' || h AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC) = 1),
own AS (SELECT r, g AS glob_rule, length(g) AS n, g AS o FROM parts, globs WHERE ('.' || host) LIKE l
    UNION ALL SELECT r, '*/*/login', 9, '*/' FROM parts WHERE regexp_matches(path, '^/.*/login')
    UNION ALL SELECT r, '*/*.exe', 7, '*/' FROM parts WHERE regexp_matches(path, '^/.*\.exe')),
best AS (SELECT r, glob_rule FROM own QUALIFY row_number() OVER (PARTITION BY r ORDER BY n DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, CASE WHEN glob_rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, CASE WHEN rule IS NULL THEN glob_rule END AS glob_rule
FROM parts LEFT JOIN found USING (r) LEFT JOIN best USING (r)"""

#: CRC-32 of the ASCII text ``{0}``, byte by byte and bit by bit.
CRC32 = """xor(list_reduce(flatten(list_transform(string_split({0}, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295::BIGINT)"""

_EDIT_ROWS = ", ".join(f"({code}, {s}, {to}, {cost}, '{letters}')" for code in range(9) for s in range(4) for to, (cost, letters) in repair.EDITS[code][s].items())

OP11_SQL = rf"""
WITH RECURSIVE given AS (SELECT conv_id AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations),
damaged AS (SELECT c, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE hit WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM given WHERE hit <> 0),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
faults AS (SELECT c, turn, role, text, i, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen, right(regexp_replace(text, '[ 	-
]+$', ''), 1) AS final FROM numbered),
coded AS (SELECT *, CASE WHEN final = '' THEN 'blank' WHEN seen THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM faults),
turns AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 0 ELSE
    CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 WHEN 'a' THEN 3 ELSE 4 END + CASE WHEN fault = 'truncated' THEN 4 ELSE 0 END END AS code FROM coded),
edits(code, s, t, price, letters) AS (VALUES {_EDIT_ROWS}),
dp AS (SELECT DISTINCT c, 0::BIGINT AS i, 0 AS s, {{'cost': 0, 'audit': ''}} AS best FROM turns
    UNION ALL
    SELECT dp.c, dp.i + 1, e.t, min({{'cost': (dp.best).cost + e.price, 'audit': (dp.best).audit || e.letters}})
    FROM dp JOIN turns r ON r.c IS NOT DISTINCT FROM dp.c AND r.i = dp.i + 1 JOIN edits e ON e.code = r.code AND e.s = dp.s GROUP BY dp.c, dp.i, e.t),
sums AS (SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY c),
chosen AS (SELECT sums.c, min({{'cost': (best).cost + CASE s WHEN 1 THEN 10 WHEN 2 THEN 5 ELSE 0 END, 'audit': (best).audit || CASE s WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}}) AS best
    FROM dp JOIN sums ON sums.c IS NOT DISTINCT FROM dp.c AND dp.i = sums.n GROUP BY sums.c),
letters AS (SELECT c, unnest(string_split((best).audit, '')) AS e, unnest(range(length((best).audit))) AS pos FROM chosen),
placed AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e IN ('K', 'R', 'I')) OVER w AS kept FROM letters WINDOW w AS (PARTITION BY c ORDER BY pos)),
first_kept AS (SELECT p.c, min(t.initial) FILTER (p.e = 'K' AND p.kept = 1) AS initial FROM placed p LEFT JOIN turns t ON t.c IS NOT DISTINCT FROM p.c AND t.i = p.i AND p.e = 'K' GROUP BY p.c),
lines AS (SELECT p.c, p.pos, CASE WHEN p.e = 'K' THEN t.role WHEN (p.kept + CASE WHEN f.initial = 's' THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || CASE WHEN p.e = 'I' THEN '' ELSE t.text END AS line
    FROM placed p JOIN first_kept f ON f.c IS NOT DISTINCT FROM p.c LEFT JOIN turns t ON t.c IS NOT DISTINCT FROM p.c AND t.i = p.i WHERE p.e <> 'D'),
bodies AS (SELECT c, string_agg(line, chr(10) ORDER BY pos) AS body FROM lines GROUP BY c)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce((best).cost, 0) AS cost, coalesce((best).audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN sums ON sums.c IS NOT DISTINCT FROM o.conv_id
LEFT JOIN chosen ON chosen.c IS NOT DISTINCT FROM o.conv_id LEFT JOIN bodies ON bodies.c IS NOT DISTINCT FROM o.conv_id"""

_BASE32 = "".join(chr(c) for c in [*range(ord("A"), ord("Z") + 1), *range(ord("2"), ord("7") + 1)])

OP12_SQL = f"""
WITH given AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha1 FROM pages),
same AS (SELECT sha1, max(page_id) AS largest FROM given GROUP BY sha1),
bits AS (SELECT sha1, flatten(list_transform(string_split(sha1, ''), lambda h: list_transform([8, 4, 2, 1], lambda b: CASE WHEN (instr('0123456789abcdef', h) - 1) & b > 0 THEN 1 ELSE 0 END))) AS b FROM same),
digests AS (SELECT sha1, array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}',
    CAST(16 * b[5 * i + 1] + 8 * b[5 * i + 2] + 4 * b[5 * i + 3] + 2 * b[5 * i + 4] + b[5 * i + 5] + 1 AS BIGINT), 1)), '') AS digest FROM bits)
SELECT page_id, strlen(html) AS payload_bytes, digest AS payload_digest, CASE WHEN largest IS NOT NULL AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM given JOIN same USING (sha1) JOIN digests USING (sha1)"""

OP13_SQL = rf"""
WITH turns AS (SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+')) AS words, turn, coalesce(role, '') AS role FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, id) AS i FROM turns),
families AS (SELECT DISTINCT c, c - c % {FAMILY} AS base, coalesce({CRC32.format("c::VARCHAR")} % {SHARED_TURNS}, 0) AS h FROM turns),
joined AS (SELECT f.c, 0 AS own, n.i, n.id, n.words FROM families f JOIN numbered n ON n.c = f.base AND n.i <= h
    UNION ALL SELECT f.c, 1, n.i, n.id, n.words FROM families f JOIN numbered n ON n.c IS NOT DISTINCT FROM f.c AND n.i > h),
depths AS (SELECT c, id, words, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d FROM joined),
sequences AS (SELECT f.c, list(id ORDER BY d) FILTER (d IS NOT NULL) AS ids, count(d) AS n FROM families f LEFT JOIN depths x ON x.c IS NOT DISTINCT FROM f.c GROUP BY f.c),
prefixes AS (SELECT c, 0::BIGINT AS d, []::VARCHAR[] AS p, 0 AS words, n FROM sequences
    UNION ALL SELECT x.c, x.d, ids[1:x.d], x.words, n FROM depths x JOIN sequences s ON s.c IS NOT DISTINCT FROM x.c),
nodes AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words, coalesce(string_agg(coalesce(c::VARCHAR, ''), ',' ORDER BY c NULLS FIRST) FILTER (n = d), '') AS ends
    FROM prefixes GROUP BY d, p),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (SELECT n.p[1:k] AS p, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n_convs - 1) * words) AS saved
    FROM (SELECT *, unnest(range(d + 1)) AS k FROM nodes) n LEFT JOIN children c ON c.p = n.p GROUP BY 1)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN sums s ON s.p = x.p LEFT JOIN children c ON c.p = x.p LEFT JOIN nodes u ON x.d > 0 AND u.p = x.p[1:x.d - 1]"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality.oracle_sql(), "op3_line_dedup": OP3_SQL, "op5_url_filter": OP5_SQL, "op11_structure_repair": OP11_SQL, "op12_warc": OP12_SQL, "op13_prefix_trie": OP13_SQL}
