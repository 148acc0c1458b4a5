"""Queries of run summaries, samples, text similarity and judge scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.functions import text as tx
from caseweave.functions.labels import label_path
from caseweave.operators import judge as jd
from caseweave.operators import sampling as sp
from caseweave.operators import similarity as sim
from caseweave.operators import summary as sm
from caseweave.plans.base import INCIDENTS, incidents, query, sql_path, sql_trueish, sql_usable, table
from caseweave.plans.comparison import rounded
from caseweave.plans.validation import TREE, _validated

FILLED = ["a_l1", "a_l4", "b_l4", "resolution"]


@query(f"WITH {INCIDENTS} " + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS filled, round(count({c}) * 100.0 / count(*), 6) AS pct FROM incidents" for c in FILLED) + " UNION ALL SELECT 'absent', NULL, NULL")
def fill_rates(spark, sf_dir):
    out = sm.fill_rates(incidents(spark, sf_dir), [*FILLED, "absent"])
    return out.withColumn("pct", F.round(F.col("pct").cast("double"), 6))


@query(f"""WITH {INCIDENTS}, c AS (SELECT a_l1 AS l1, a_l2 AS l2, count(*) AS n FROM incidents GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY l1) AS t, row_number() OVER (PARTITION BY l1 ORDER BY n DESC, l2 NULLS FIRST) AS rank FROM c)
SELECT l1, l2, n, CAST(t AS BIGINT) AS l1_n, round(n / t * 100, 6) AS pct, rank, round(t / (SELECT count(*) FROM incidents) * 100, 6) AS l1_pct FROM r WHERE rank <= 5""")
def category_distribution(spark, sf_dir):
    return rounded(sm.category_distribution(incidents(spark, sf_dir), "a_l1", "a_l2"), "pct", "l1_pct").withColumn("rank", F.col("rank").cast("long"))


RUNS = f"""{TREE}, x AS (SELECT v.*, 'run' || cast(in_id % 3 AS VARCHAR) AS run_id, CASE WHEN in_id % 4 = 0 THEN NULL WHEN in_id % 4 = 1 THEN 'Unclassified' ELSE 'fix' END AS l4, in_id % 5 = 0 AS actionable FROM validated v),
summary AS (SELECT run_id, final_l1, grouping(final_l1) AS whole_run, count(*) AS rows, count(*) FILTER (validation_status IN ('valid', 'valid_after_repair')) AS valid,
  count(*) FILTER (validation_status NOT IN ('valid', 'valid_after_repair')) AS invalid, count(*) FILTER (l4 = 'fix') AS l4_present, count(*) FILTER (l4 = 'Unclassified') AS l4_fallback,
  count(*) FILTER (l4 IS NULL) AS l4_missing, count(*) FILTER (actionable) AS actionable FROM x GROUP BY GROUPING SETS ((run_id, final_l1), (run_id)))"""


def _runs(spark, sf_dir):
    k = F.col("in_id")
    extra = {"run_id": F.concat(F.lit("run"), (k % 3).cast("string")), "l4": F.when(k % 4 == 1, "Unclassified").when(k % 4 > 1, "fix"), "actionable": k % 5 == 0}
    return _validated(spark, sf_dir).withColumns(extra)


def _summary(spark, sf_dir):
    return sm.run_summary(_runs(spark, sf_dir), "run_id", "final_l1", "validation_status", "l4", "actionable")


@query(f"WITH {RUNS} SELECT run_id, final_l1, CAST(whole_run AS INTEGER) AS whole_run, rows, valid, invalid, l4_present, l4_fallback, l4_missing, actionable FROM summary")
def run_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


@query(f"WITH {RUNS} SELECT run_id, rows, CASE WHEN valid * 100.0 / rows >= 40 AND l4_missing * 100.0 / rows <= 24.9 THEN 'ok' ELSE 'degraded' END AS state FROM summary WHERE whole_run = 1")
def coverage_contract(spark, sf_dir):
    return sm.coverage_contract(_summary(spark, sf_dir), 40, 24.9).select("run_id", "rows", "state")


VALID = "validation_status IN ('valid', 'valid_after_repair')"


@query(f"""WITH {RUNS}, n AS (SELECT count(*) AS n FROM x) SELECT 'valid' AS measure, round(avg(CAST({VALID} AS DOUBLE)) * 100, 6) AS pct FROM x
UNION ALL SELECT 'l4_fallback', round(avg(CAST(coalesce(l4 = 'Unclassified', false) AS DOUBLE)) * 100, 6) FROM x UNION ALL SELECT 'complete', round(avg(CAST({VALID} AND coalesce(l4 = 'fix', false) AS DOUBLE)) * 100, 6) FROM x
{" ".join(f"UNION ALL SELECT 'filled_{c}', round(avg(CAST({c} IS NOT NULL AS DOUBLE)) * 100, 6) FROM x" for c in ("original_l1", "original_l2", "original_l3", "l4"))}
UNION ALL SELECT 'status_' || validation_status, round(count(*) * 100.0 / (SELECT n FROM n), 6) FROM x GROUP BY validation_status""")
def validity_report(spark, sf_dir):
    out = sm.validity_report(_runs(spark, sf_dir), "validation_status", "l4", ("original_l1", "original_l2", "original_l3"))
    return out.withColumn("pct", F.round(F.col("pct").cast("double"), 6))


LEVEL_PAIRS = {"l1_l2": ("original_l1", "original_l2"), "l2_l3": ("original_l2", "original_l3")}


@query(f"WITH {RUNS} " + " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{name}' AS levels, {a} AS upper, {b} AS lower, count(*) AS n FROM x WHERE NOT ({VALID}) GROUP BY {a}, {b} ORDER BY n DESC, {a} NULLS FIRST, {b} NULLS FIRST LIMIT 10)"
    for name, (a, b) in LEVEL_PAIRS.items()
))
def worst_label_pairs(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    worst = [sm.worst_pairs(runs, "validation_status", a, b).select(F.lit(name).alias("levels"), F.col(a).alias("upper"), F.col(b).alias("lower"), "n") for name, (a, b) in LEVEL_PAIRS.items()]
    return worst[0].unionByName(worst[1])


@query(f"""WITH {INCIDENTS}, w AS (SELECT unit, CAST(CASE unit WHEN 'week' THEN date_trunc('week', opened_at) ELSE date_trunc('month', opened_at) END AS DATE) AS period, a_l3
  FROM incidents, (VALUES ('week'), ('month')) AS u(unit) WHERE {sql_usable("a_l3")}),
c AS (SELECT unit, period, a_l3, count(*) AS n FROM w GROUP BY ALL),
t AS (SELECT unit, period, n, n / sum(n) OVER (PARTITION BY unit, period) AS p FROM c)
SELECT unit, period, CAST(sum(n) AS BIGINT) AS rows, round(sum(-p * log2(p)), 6) AS entropy, round(max(p) * 100, 6) AS top_pct FROM t GROUP BY unit, period""")
def label_drift(spark, sf_dir):
    rows = incidents(spark, sf_dir)
    drift = [sm.label_drift(rows, "a_l3", "opened_at", unit).select(F.lit(unit).alias("unit"), "*") for unit in ("week", "month")]
    return rounded(drift[0].unionByName(drift[1]), "entropy", "top_pct")


@query(f"""WITH {RUNS}, b AS (SELECT CASE WHEN length(trim(coalesce(original_l3, ''))) >= 9 THEN 'rich' ELSE 'sparse' END AS text_kind FROM x WHERE NOT ({VALID}))
SELECT text_kind, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM b), 6) AS pct FROM b GROUP BY text_kind""")
def sparse_vs_rich_invalid(spark, sf_dir):
    out = sm.sparse_rich(_runs(spark, sf_dir), "validation_status", "original_l3", 9)
    return out.withColumn("pct", F.round(F.col("pct").cast("double"), 6))


@query(f"""WITH {INCIDENTS}, c AS (SELECT a_l2, a_l1, count(*) AS n FROM incidents WHERE a_l1 IS NOT NULL GROUP BY ALL)
SELECT a_l2, a_l1 AS category FROM c QUALIFY row_number() OVER (PARTITION BY a_l2 ORDER BY n DESC, a_l1) = 1""")
def subcategory_mode_category(spark, sf_dir):
    return sm.mode_category(incidents(spark, sf_dir), "a_l1", "a_l2")


@query(f"WITH {INCIDENTS} SELECT DISTINCT a_l1 FROM incidents WHERE a_l1 <> 'Uncategorized'")
def distinct_subcategories(spark, sf_dir):
    return sm.subcategories(incidents(spark, sf_dir), "a_l1")


def sql_seed(key: str, seed: int = 7) -> str:
    return f"md5('{seed}:' || CAST({key} AS VARCHAR))"


@query(f"""WITH {INCIDENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY a_l1, a_l2, a_l3, period ORDER BY {sql_seed("in_id")}, in_id) AS r FROM incidents
WHERE period IS NOT NULL AND {" AND ".join(f"coalesce(trim({c}) <> '' AND lower(trim({c})) <> 'none', false)" for c in ("a_l1", "a_l2", "a_l3"))})
SELECT in_id, a_l1, a_l2, a_l3 FROM r WHERE r <= 2 ORDER BY {sql_seed("in_id")}, in_id LIMIT 200""")
def stratified_sample(spark, sf_dir):
    return sp.stratified_sample(incidents(spark, sf_dir), ["a_l1", "a_l2", "a_l3"], "period", "in_id", n=200).select("in_id", "a_l1", "a_l2", "a_l3")


@query(f"WITH {INCIDENTS} SELECT in_id FROM incidents WHERE {sql_usable('a_l4')} AND {sql_usable('b_l4')} ORDER BY {sql_seed('in_id', 11)}, in_id LIMIT 100")
def seeded_sample(spark, sf_dir):
    return sp.seeded_sample(incidents(spark, sf_dir), "a_l4", "b_l4", "in_id", 100, 11).select("in_id")


@query(f"""WITH s AS (SELECT o_orderpriority, o_orderkey, count(*) OVER (PARTITION BY o_orderpriority) AS n, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {sql_seed("o_orderkey")}, o_orderkey) AS r FROM orders),
w AS (SELECT *, least(greatest(least(ceil(384.16 / (1 + 383.16 / n)), CASE WHEN n > 10000 THEN 200 ELSE 300 END), 50), n) AS wanted FROM s)
SELECT o_orderpriority, o_orderkey, n AS population, CAST(wanted AS BIGINT) AS wanted FROM w WHERE r <= wanted""")
def taxonomy_sample(spark, sf_dir):
    out = sp.taxonomy_sample(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderkey")
    return out.select("o_orderpriority", "o_orderkey", "population", F.col("wanted").cast("long").alias("wanted"))


@query("""WITH n AS (SELECT greatest(1, least(10, CAST(ceil(count(*) / 2000) AS BIGINT))) AS parts, count(*) AS n FROM orders),
s AS (SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) AS spot FROM orders)
SELECT o_orderkey, spot % parts AS worker, (spot // parts) % greatest(1, CAST(ceil(n / (parts * 1000)) AS BIGINT)) AS chunk FROM s, n""")
def balanced_batches(spark, sf_dir):
    return sp.balanced_batches(table(spark, sf_dir, "orders"), "o_orderkey", rows=2000).select("o_orderkey", "worker", "chunk")


TOKENS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}_]{{2,}}')"


@query(f"SELECT doc_id, len({TOKENS.format('text')}) AS n, {TOKENS.format('text')}[1] AS first FROM documents")
def tokenize(spark, sf_dir):
    found = tx.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(found).cast("long").alias("n"), F.get(found, 0).alias("first"))


TFIDF = f"""{INCIDENTS}, c AS (SELECT in_id, term, count(*) AS tf FROM (SELECT in_id, unnest({TOKENS.format("brief_description")}) AS term FROM incidents) GROUP BY ALL),
v AS (SELECT term, sum(tf) AS total, count(*) AS df FROM c GROUP BY term ORDER BY total DESC, term LIMIT 300),
n AS (SELECT count(*) AS n FROM incidents WHERE len({TOKENS.format("brief_description")}) > 0),
w AS (SELECT in_id, term, tf * (ln((n + 1) / (df + 1)) + 1) AS w FROM c JOIN v USING (term), n),
vectors AS (SELECT in_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY in_id)) AS weight FROM w)"""


@query(f"WITH {TFIDF} SELECT in_id, term, round(weight, 6) AS weight FROM vectors")
def tfidf_vectors(spark, sf_dir):
    return rounded(sim.tfidf(incidents(spark, sf_dir), "in_id", "brief_description"), "weight")


PAIRS = f"{TFIDF}, pairs AS (SELECT a.in_id AS i, b.in_id AS j, sum(a.weight * b.weight) AS cosine FROM vectors a JOIN vectors b USING (term) WHERE a.in_id < b.in_id GROUP BY ALL HAVING sum(a.weight * b.weight) >= 0.35 - 1e-12)"


def _vectors(spark, sf_dir):
    frame = incidents(spark, sf_dir)
    return sim.tfidf(frame, "in_id", "brief_description"), "in_id", frame, ["a_l1", "b_l1", "a_l4"]


@query(f"""WITH {PAIRS} SELECT i, j, round(cosine, 6) AS cosine, x.a_l1 IS NOT DISTINCT FROM y.a_l1 AS same_a_l1, x.b_l1 IS NOT DISTINCT FROM y.b_l1 AS same_b_l1,
x.a_l4 IS NOT DISTINCT FROM y.a_l4 AS same_a_l4 FROM pairs JOIN incidents x ON x.in_id = i JOIN incidents y ON y.in_id = j""")
def similar_pairs(spark, sf_dir):
    vectors, key, frame, columns = _vectors(spark, sf_dir)
    return rounded(sim.similar_pairs(vectors, key, frame=frame, columns=columns), "cosine")


@query(f"""WITH {PAIRS} SELECT count(*) AS pairs, round(avg(CAST(x.a_l1 IS NOT DISTINCT FROM y.a_l1 AS DOUBLE)) * 100, 6) AS same_a_l1_pct, round(avg(CAST(x.b_l1 IS NOT DISTINCT FROM y.b_l1 AS DOUBLE)) * 100, 6) AS same_b_l1_pct,
round(avg(CAST(x.a_l4 IS NOT DISTINCT FROM y.a_l4 AS DOUBLE)) * 100, 6) AS same_a_l4_pct FROM pairs JOIN incidents x ON x.in_id = i JOIN incidents y ON y.in_id = j""")
def pair_stability_summary(spark, sf_dir):
    return rounded(sim.stability_counts(*_vectors(spark, sf_dir)), "same_a_l1_pct", "same_b_l1_pct", "same_a_l4_pct")


def sql_cosine(a: str, b: str) -> str:
    """Over two token lists."""
    tf = lambda s, t: f"len(list_filter({s}, lambda z: z = {t}))"
    square = lambda s, o: f"list_sum(list_transform(list_distinct({s}), lambda t: pow({tf(s, 't')} * (CASE WHEN list_contains({o}, t) THEN 1.0::DOUBLE ELSE 1.4054651081081644 END), 2)))"
    dot = f"coalesce(list_sum(list_transform(list_intersect({a}, {b}), lambda t: CAST({tf(a, 't')} * {tf(b, 't')} AS DOUBLE))), 0)"
    return f"CASE WHEN len({a}) > 0 AND len({b}) > 0 THEN {dot} / sqrt({square(a, b)} * {square(b, a)}) END"


@query(f"""WITH {INCIDENTS}, t AS (SELECT in_id, {TOKENS.format("brief_description")} AS x, {TOKENS.format("resolution")} AS y FROM incidents)
SELECT in_id, round({sql_cosine("x", "y")}, 6) AS cosine FROM t""")
def pair_cosine(spark, sf_dir):
    return rounded(incidents(spark, sf_dir).select("in_id", tx.pair_cosine(F.col("brief_description"), F.col("resolution")).alias("cosine")), "cosine")


def sql_winner(a: str, b: str) -> str:
    return f"CASE WHEN {a} IS NULL OR {b} IS NULL THEN 'Tie' WHEN {a} - {b} > 0.05 THEN 'A' WHEN {b} - {a} > 0.05 THEN 'B' ELSE 'Tie' END"


_SIDES = {f"{m}_{part}": sql_path(*(f"{m}_l{k}" for k in levels)) for m in "ab" for part, levels in (("full", (1, 2, 3, 4)), ("short", (1, 2)))}
COHERENCE = f"""{INCIDENTS}, texts AS (SELECT in_id, resolution || ' len1 len2 fix_1' AS res, brief_description AS note, {", ".join(f"replace({v}, ' → ', ' ') AS p_{k}" for k, v in _SIDES.items())} FROM incidents),
tok AS (SELECT in_id, coalesce(trim(res) <> '', false) AS resolution_available, {TOKENS.format("res")} AS r, {TOKENS.format("note")} AS n, {", ".join(f"{TOKENS.format('p_' + k)} AS t_{k}" for k in _SIDES)} FROM texts),
coh AS (SELECT in_id, resolution_available, {", ".join(f"{sql_cosine('t_' + k, 'r')} AS {k}" for k in _SIDES)}, {", ".join(f"{sql_cosine(f't_{m}_full', 'n')} AS {m}_notes" for m in "ab")} FROM tok),
rows AS (SELECT *, {sql_winner("a_full", "b_full")} AS winner_full, {sql_winner("a_short", "b_short")} AS winner_short FROM coh)"""
NUMBERS = ["a_full", "a_short", "b_full", "b_short", "a_notes", "b_notes"]


def _coherence(spark, sf_dir):
    frame = incidents(spark, sf_dir).withColumn("res", F.concat("resolution", F.lit(" len1 len2 fix_1")))
    paths = {f"{m}_{part}": label_path(*(F.col(f"{m}_l{k}") for k in levels)) for m in "ab" for part, levels in (("full", (1, 2, 3, 4)), ("short", (1, 2)))}
    return sim.coherence(frame, paths, "res", "brief_description")


@query(f"WITH {COHERENCE} SELECT in_id, resolution_available, {', '.join(f'round({c}, 6) AS {c}' for c in NUMBERS)}, winner_full, winner_short FROM rows")
def resolution_coherence(spark, sf_dir):
    return rounded(_coherence(spark, sf_dir), *NUMBERS)


@query(f"WITH {COHERENCE} " + " UNION ALL ".join(f"""SELECT '{m.upper()}' AS model, count(*) AS rows, round(avg({m}_full), 6) AS mean_full, round(avg({m}_short), 6) AS mean_short, round(avg({m}_notes), 6) AS mean_notes,
round(avg(CAST(winner_full = '{m.upper()}' AS DOUBLE)) * 100, 6) AS won_full_pct, round(avg(CAST(winner_short = '{m.upper()}' AS DOUBLE)) * 100, 6) AS won_short_pct FROM rows WHERE resolution_available""" for m in "ab"))
def coherence_summary(spark, sf_dir):
    return rounded(sim.coherence_summary(_coherence(spark, sf_dir)), "mean_full", "mean_short", "mean_notes", "won_full_pct", "won_short_pct")


def _score(m: str, k: int) -> str:
    shift = k if m == "a" else 3 * k + 1
    return f"CASE WHEN (n_chars + {shift}) % 7 = 0 THEN 'N' ELSE cast((n_chars * {k} + doc_id + {shift}) % 5 AS string) END AS {m}_d{k}"


JUDGE_SQL = f"""SELECT in_id, doc_id, n_chars, a_l4_confidence, a_actionable, CASE WHEN doc_id % 19 = 0 THEN 'failed' END AS error, {", ".join(_score(m, k) for m in "ab" for k in range(1, 8))},
  CASE doc_id % 4 WHEN 0 THEN 'Labeler A' WHEN 1 THEN ' labeler b' WHEN 2 THEN 'tie' ELSE 'Equal' END AS verdict_overall, CASE WHEN n_chars % 3 = 0 THEN 'labeler a wins' ELSE 'EQUAL' END AS verdict_accuracy,
  'D' || cast(n_chars % 7 + 1 AS string) AS largest_gap FROM {{incidents}}"""
JUDGED = f"{INCIDENTS}, judged AS ({JUDGE_SQL.format(incidents='incidents')})"


def _judged(spark, sf_dir):
    return spark.sql(JUDGE_SQL, incidents=incidents(spark, sf_dir))


def sql_mean(m: str, ks) -> str:
    return f"list_avg(list_filter([{', '.join(f'TRY_CAST({m}_d{k} AS DOUBLE)' for k in ks)}], lambda z: z IS NOT NULL))"


RESCORED = f"""{JUDGED}, rescored AS (SELECT *, {", ".join(f"{sql_mean(m, range(1, 5))} AS {m}_section1, {sql_mean(m, range(5, 8))} AS {m}_section2, {sql_mean(m, range(1, 8))} AS {m}_overall" for m in "ab")} FROM judged)"""
VERDICT = "CASE WHEN abs(a_overall - b_overall) <= 0.25 THEN 'Tie' WHEN a_overall > b_overall THEN 'A' WHEN a_overall < b_overall THEN 'B' END"
AVERAGES = [f"{m}_{s}" for m in "ab" for s in ("section1", "section2", "overall")]


@query(f"WITH {RESCORED} SELECT in_id, {', '.join(f'round({c}, 6) AS {c}' for c in AVERAGES)}, {VERDICT} AS verdict FROM rescored")
def judge_rescore(spark, sf_dir):
    return rounded(jd.judge_rescore(_judged(spark, sf_dir)).select("in_id", *AVERAGES, "verdict"), *AVERAGES)


@query(f"WITH {JUDGED} SELECT in_id, {', '.join(f'{m}_d{k}' for m in 'ab' for k in range(1, 8))}, verdict_overall, error FROM judged")
def flatten_judge(spark, sf_dir):
    dims = lambda m: F.struct(*(F.struct(F.col(f"{m}_d{k}").alias("score")).alias(f"d{k}") for k in range(1, 8))).alias(m)
    nested = _judged(spark, sf_dir).select("in_id", "error", F.struct(dims("a"), dims("b"), F.col("verdict_overall").alias("verdict")).alias("judge"))
    return jd.flatten_judge(nested)


def sql_verdict(c: str) -> str:
    return f"CASE WHEN upper(trim({c})) = 'TIE' THEN 'Tie' WHEN contains(upper(trim({c})), 'LABELER A') THEN 'A' WHEN contains(upper(trim({c})), 'LABELER B') THEN 'B' ELSE upper(trim({c})) END"


@query(f"""WITH {RESCORED}, ok AS (SELECT * FROM rescored WHERE error IS NULL AND verdict_overall IS NOT NULL)
{" UNION ALL ".join(f"SELECT '{v}' AS metric, {sql_verdict(v)} AS item, round(count(*) * 100.0 / (SELECT count(*) FROM ok), 6) AS value FROM ok GROUP BY ALL" for v in ("verdict_overall", "verdict_accuracy"))}
{" ".join(f"UNION ALL SELECT 'mean', '{c}', round(avg({c}), 6) FROM ok" for c in AVERAGES)} UNION ALL SELECT 'mean', 'a_minus_b', round(avg(a_overall - b_overall), 6) FROM ok
UNION ALL SELECT 'largest_gap', largest_gap, round(n * 100.0 / (SELECT count(*) FROM ok), 6) FROM (SELECT largest_gap, count(*) AS n FROM ok GROUP BY ALL ORDER BY n DESC, largest_gap LIMIT 5)""")
def judge_summary(spark, sf_dir):
    rows = jd.judge_rescore(_judged(spark, sf_dir))
    out = jd.judge_summary(rows, ["verdict_overall", "verdict_accuracy"], AVERAGES, "largest_gap")
    return out.withColumn("value", F.round(F.col("value").cast("double"), 6))


PATHS_SQL = """SELECT in_id, CASE WHEN doc_id % 13 = 0 THEN 'x' END AS a_error, CASE WHEN doc_id % 17 = 0 THEN 'x' END AS b_error,
  n_chars % 4 AS a_l1l2, (n_chars + 1) % 4 AS a_l2l3, (n_chars + doc_id) % 4 AS a_l3l4, n_chars % 3 + 1 AS a_overall, 'l' || cast(n_chars % 3 AS string) AS a_weakest,
  doc_id % 4 AS b_l1l2, (doc_id + 1) % 4 AS b_l2l3, 3 AS b_l3l4, doc_id % 4 AS b_overall, CASE WHEN doc_id % 2 = 0 THEN 'l1' ELSE 'l2' END AS b_weakest,
  n_chars % 3 AS a_action, doc_id % 3 AS a_system, 1 AS a_routing, n_chars % 3 + doc_id % 3 + 1 AS a_composite,
  doc_id % 3 AS b_action, 2 AS b_system, n_chars % 3 AS b_routing, doc_id % 3 + 2 + n_chars % 3 AS b_composite FROM {incidents}"""
PATHS = f"{INCIDENTS}, ok AS (SELECT * FROM ({PATHS_SQL.format(incidents='incidents')}) WHERE a_error IS NULL AND b_error IS NULL)"


def _sql_paths(m: str) -> str:
    parts = [f"{m}_{c}" for c in ("l1l2", "l2l3", "l3l4", "overall")]
    zero = " OR ".join(f"{c} = 0" for c in parts)
    means = ", ".join(f"round(avg({c}), 6) AS mean_{c[2:]}" for c in parts)
    return f"""SELECT '{m.upper()}' AS model, {means}, round(avg(CAST({m}_overall = 3 AS DOUBLE)) * 100, 6) AS perfect_pct, round(avg(CAST({zero} AS DOUBLE)) * 100, 6) AS zero_pct,
(SELECT {m}_weakest FROM ok GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS weakest FROM ok"""


@query(f"WITH {PATHS} " + " UNION ALL ".join(map(_sql_paths, "ab")))
def path_score_summary(spark, sf_dir):
    out = jd.path_scores(spark.sql(PATHS_SQL, incidents=incidents(spark, sf_dir)))
    return rounded(out, *(c for c in out.columns if c.startswith("mean_") or c.endswith("_pct")))


def _sql_automation(m: str) -> str:
    c = f"{m}_composite"
    share = lambda t: f"round(avg(CAST({t} AS DOUBLE)) * 100, 6)"
    means = ", ".join(f"round(avg({m}_{x}), 6) AS mean_{x}" for x in ("composite", "action", "system", "routing"))
    return f"SELECT '{m.upper()}' AS model, {means}, {share(f'{c} >= 5')} AS high_pct, {share(f'{c} BETWEEN 3 AND 4')} AS medium_pct, {share(f'{c} <= 2')} AS low_pct FROM ok"


@query(f"WITH {PATHS} " + " UNION ALL ".join(map(_sql_automation, "ab")))
def automation_score_summary(spark, sf_dir):
    out = jd.automation_scores(spark.sql(PATHS_SQL, incidents=incidents(spark, sf_dir)))
    return rounded(out, *(c for c in out.columns if c.startswith("mean_") or c.endswith("_pct")))


CALIBRATED = f"{RESCORED}, j AS (SELECT in_id, a_l4_confidence AS confidence, a_overall + a_l4_confidence AS score, a_actionable FROM rescored WHERE error IS NULL AND a_overall IS NOT NULL AND a_l4_confidence IS NOT NULL)"


def _calibration(spark, sf_dir):
    judged = jd.judge_rescore(_judged(spark, sf_dir))
    shifted = judged.withColumn("a_overall", F.col("a_overall") + F.col("a_l4_confidence")).select("in_id", "a_overall", "error")
    return jd.calibration_join(incidents(spark, sf_dir), shifted, "a_l4_confidence")


@query(f"WITH {CALIBRATED} SELECT in_id, round(confidence, 6) AS confidence, round(score, 6) AS score FROM j")
def calibration_join(spark, sf_dir):
    return rounded(_calibration(spark, sf_dir).select("in_id", "confidence", "score"), "confidence", "score")


@query(f"""WITH {CALIBRATED} SELECT CASE WHEN confidence <= 0.5 THEN '<0.50' WHEN confidence <= 0.6 THEN '0.50-0.60' WHEN confidence <= 0.7 THEN '0.60-0.70' WHEN confidence <= 0.8 THEN '0.70-0.80'
WHEN confidence <= 0.9 THEN '0.80-0.90' ELSE '0.90-1.00' END AS bin, count(*) AS n, round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std FROM j GROUP BY ALL""")
def confidence_calibration_bins(spark, sf_dir):
    return rounded(jd.calibration_bins(_calibration(spark, sf_dir)), "mean", "std")


@query(f"""WITH {CALIBRATED} SELECT round(corr(confidence, score), 6) AS r, count(*) AS n, round(avg(score) FILTER ({sql_trueish("a_actionable")}), 6) AS mean_actionable,
round(avg(score) FILTER (NOT {sql_trueish("a_actionable")}), 6) AS mean_other, corr(confidence, score) > 0.3 AS calibrated,
abs(avg(score) FILTER ({sql_trueish("a_actionable")}) - avg(score) FILTER (NOT {sql_trueish("a_actionable")})) > 0.3 AS flag_valid FROM j""")
def confidence_calibration(spark, sf_dir):
    out = jd.calibration(_calibration(spark, sf_dir), "a_actionable").drop("p")  # the p-value has its own unit test
    return rounded(out, "r", "mean_actionable", "mean_other")


