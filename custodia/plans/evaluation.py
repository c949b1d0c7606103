"""Latency, hallucination, consistency, grounding and golden set analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.functions import sampling, text as tx, threats
from custodia.operators import golden, grounding, latency, quality, redaction
from custodia.operators.percentiles import exact_percentiles, join_groups
from custodia.plans import pii
from custodia.plans.registry import Inputs, fragment, query

BAD = "CASE WHEN grounding_score < 0.85e0 THEN 1 ELSE 0 END"
LANGS = ["de", "en", "es", "fr"]


def traces(inp: Inputs):
    return inp.view("traces")


def bad():
    return quality.hallucinated(F.col("grounding_score"))


def r6(c, name):
    return F.round(c, 6).alias(name)


@query("trace_scan", """SELECT request_id, CAST(ts AS VARCHAR) AS ts, model_id, task_type, ttft_ms, total_latency_ms, prompt_tokens, completion_tokens FROM #traces# t""")
def trace_scan(inp: Inputs):
    return traces(inp).select(
        "request_id", F.col("ts").cast("string").alias("ts"), "model_id", "task_type", "ttft_ms", "total_latency_ms", "prompt_tokens", "completion_tokens"
    )


@query("golden_scan", """SELECT item_id, reference_answer, concat(fact1, '|', fact2) AS required_facts, min_score FROM #golden# g""")
def golden_scan(inp: Inputs):
    return golden_set(inp).select("item_id", "reference_answer", F.array_join("required_facts", "|").alias("required_facts"), "min_score")


def golden_set(inp: Inputs):
    return inp.view("golden").withColumn("required_facts", F.array("fact1", "fact2"))


def evaluated(inp: Inputs):
    return golden.evaluate(inp.view("golden_runs"), golden_set(inp))


fragment("evaluated", """SELECT r.*, coalesce(contains(r.response, g.fact1) AND contains(r.response, g.fact2), FALSE) AS facts_ok,
  coalesce(contains(r.response, g.fact1) AND contains(r.response, g.fact2) AND r.score >= g.min_score, FALSE) AS passed FROM #golden_runs# r JOIN #golden# g USING (item_id)""")


@query("required_facts", "SELECT item_id, model_id, facts_ok FROM #evaluated# e")
def required_facts(inp: Inputs):
    return evaluated(inp).select("item_id", "model_id", "facts_ok")


@query("golden_eval_join", "SELECT item_id, model_id, score, passed FROM #evaluated# e")
def golden_eval_join(inp: Inputs):
    return evaluated(inp).select("item_id", "model_id", "score", "passed")


@query("model_ab_compare", """SELECT a.item_id, a.score AS score_a, b.score AS score_b, b.score - a.score AS delta
FROM #golden_runs# a JOIN #golden_runs# b ON a.item_id = b.item_id AND a.model_id = 'm0' AND b.model_id = 'm1'""")
def model_ab_compare(inp: Inputs):
    return golden.compare(inp.view("golden_runs"), "m0", "m1")


@query("golden_regression", """SELECT model_id, version, round(prev_score, 6) AS prev_score, round(score_drop, 6) AS score_drop, round(rate_rise, 6) AS rate_rise,
  coalesce(score_drop > 0.15, FALSE) OR coalesce(rate_rise > 0.15, FALSE) AS regressed FROM (
  SELECT model_id, version, prev_score, (prev_score - eval_score) / nullif(prev_score, 0) AS score_drop, (hallucination_rate - prev_rate) / nullif(prev_rate, 0) AS rate_rise FROM (
    SELECT *, lag(eval_score) OVER w AS prev_score, lag(hallucination_rate) OVER w AS prev_rate FROM #versions# v WINDOW w AS (PARTITION BY model_id ORDER BY deployed)) x) y""")
def golden_regression(inp: Inputs):
    return golden.regressions(inp.view("versions")).select(
        "model_id", "version", r6("prev_score", "prev_score"), r6("score_drop", "score_drop"), r6("rate_rise", "rate_rise"), "regressed"
    )


@query("smoke_eval", """SELECT count(*) AS items, bool_and(passed) AS passed FROM (SELECT passed FROM #evaluated# e WHERE model_id = 'm0' ORDER BY item_id LIMIT 5) x""")
def smoke_eval(inp: Inputs):
    return golden.smoke(evaluated(inp).where("model_id = 'm0'"))


fragment("p95_ttft", "SELECT model_id, quantile_cont(ttft_ms, 0.95) AS p95 FROM #traces# t GROUP BY model_id")


@query("eval_gate", f"""SELECT h.model_id, round(g.pass_rate, 6) AS pass_rate, round(h.rate, 6) AS hallucination_rate, round(p.p95, 6) AS ttft_p95,
  g.pass_rate = 1 AND h.rate <= 0.05 AND p.p95 <= 1200 AS promoted
FROM (SELECT model_id, avg({BAD}) AS rate FROM #traces# t GROUP BY model_id) h JOIN #p95_ttft# p USING (model_id)
JOIN (SELECT model_id, avg(CASE WHEN passed THEN 1 ELSE 0 END) AS pass_rate FROM #evaluated# e GROUP BY model_id) g USING (model_id)""")
def eval_gate(inp: Inputs):
    t = traces(inp)
    rate = t.groupBy("model_id").agg(F.avg(bad()).alias("rate"))
    p95 = exact_percentiles(t, ["model_id"], "ttft_ms", {"p95": 0.95})
    passes = evaluated(inp).groupBy("model_id").agg(F.avg(F.col("passed").cast("int")).alias("pass_rate"))
    j = join_groups(join_groups(rate, p95, ["model_id"]), passes, ["model_id"])
    ok = (F.col("pass_rate") == 1) & (F.col("rate") <= 0.05) & (F.col("p95") <= 1200)
    return j.select("model_id", r6("pass_rate", "pass_rate"), r6("rate", "hallucination_rate"), r6("p95", "ttft_p95"), ok.alias("promoted"))


@query("eval_set_profile", """SELECT s.dataset, s.n, s.n BETWEEN b.min_size AND b.max_size AS in_bounds FROM (
  SELECT 'golden' AS dataset, count(*) AS n FROM benchmark UNION ALL SELECT 'adversarial', count(*) FROM #q_role_escalation_flag# a
  UNION ALL SELECT 'production_sample', count(*) FROM documents WHERE substr(sha256(CAST(doc_id AS VARCHAR)), 1, 8) < '""" + sampling.hash_cut(0.02) + """') s LEFT JOIN %eval_set_bounds% b USING (dataset)""")
def eval_set_profile(inp: Inputs):
    docs = inp.table("documents")
    attacks = pii.attacked(inp).where(threats.escalation_attempt(F.col("text")))
    sizes = inp.table("benchmark").select(F.lit("golden").alias("dataset")).unionAll(
        attacks.select(F.lit("adversarial"))
    ).unionAll(docs.where(sampling.in_share(F.col("doc_id"), 0.02)).select(F.lit("production_sample"))).groupBy("dataset").agg(F.count("*").alias("n"))
    return sizes.join(inp.dim("eval_set_bounds"), "dataset", "left").select("dataset", "n", F.col("n").between(F.col("min_size"), F.col("max_size")).alias("in_bounds"))


@query("traffic_sample", f"""SELECT request_id FROM #redacted# r WHERE n = 0 AND substr(sha256(CAST(request_id AS VARCHAR)), 1, 8) < '{sampling.hash_cut(0.02)}'""")
def traffic_sample(inp: Inputs):
    # the hash is cheap and goes first; detection only runs on the sampled share
    share = inp.prompts().where(sampling.in_share(F.col("request_id"), 0.02))
    return redaction.detect(share, "prompt", "request_id").where(F.size("entities") == 0).select("request_id")


@query("canary_split", f"""SELECT request_id, CASE WHEN substr(sha256(CAST(request_id AS VARCHAR)), 1, 8) < '{sampling.hash_cut(0.10)}' THEN 'green' ELSE 'blue' END AS pool FROM #traces# t""")
def canary_split(inp: Inputs):
    return traces(inp).select("request_id", sampling.canary(F.col("request_id")).alias("pool"))


# --- latency -----------------------------------------------------------------
@query("latency_summary", """SELECT count(*) AS n, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.5), 6) AS median, round(max(CASE WHEN rn = CAST(floor(n_all * 0.99) AS BIGINT) + 1 THEN v END), 6) AS p99
FROM (SELECT security_overhead_ms AS v, row_number() OVER (ORDER BY security_overhead_ms) AS rn, count(*) OVER () AS n_all FROM #traces# t) x""")
def latency_summary(inp: Inputs):
    return latency.summary(traces(inp), "security_overhead_ms").select("n", r6("mean", "mean"), r6("median", "median"), r6("p99", "p99"))


_ROLE = "CASE user_id % 3 WHEN 0 THEN 'ANALYST' WHEN 1 THEN 'DEVELOPER' ELSE 'PLATFORM_ADMIN' END"


@query("latency_gate", f"""SELECT role, count(*) AS n, round(quantile_cont(v, 0.5), 6) AS median, round(max(CASE WHEN rn = CAST(floor(n_all * 0.99) AS BIGINT) + 1 THEN v END), 6) AS p99,
  quantile_cont(v, 0.5) <= 20 AS p50_ok, max(CASE WHEN rn = CAST(floor(n_all * 0.99) AS BIGINT) + 1 THEN v END) <= 120 AS p99_ok
FROM (SELECT role, v, row_number() OVER (PARTITION BY role ORDER BY v) AS rn, count(*) OVER (PARTITION BY role) AS n_all FROM (SELECT {_ROLE} AS role, security_overhead_ms AS v FROM #traces# t) a) x GROUP BY role""")
def latency_gate(inp: Inputs):
    s = latency.summary(traces(inp).withColumn("role", F.expr(_ROLE)), "security_overhead_ms", ["role"])
    return s.select("role", "n", r6("median", "median"), r6("p99", "p99"), (F.col("median") <= 20).alias("p50_ok"), (F.col("p99") <= 120).alias("p99_ok"))


@query("index_percentile", """SELECT model_id, n_all AS n, v AS p99 FROM (SELECT model_id, security_overhead_ms AS v, row_number() OVER (PARTITION BY model_id ORDER BY security_overhead_ms) AS rn,
  count(*) OVER (PARTITION BY model_id) AS n_all FROM #traces# t) x WHERE rn = CAST(floor(n_all * 0.99) AS BIGINT) + 1""")
def index_percentile(inp: Inputs):
    return exact_percentiles(traces(inp), ["model_id"], "security_overhead_ms", {"p99": 0.99}, "index")


@query("latency_percentiles", """SELECT model_id, count(*) AS n, round(quantile_cont(total_latency_ms, 0.5), 6) AS p50, round(quantile_cont(total_latency_ms, 0.95), 6) AS p95, round(quantile_cont(total_latency_ms, 0.99), 6) AS p99
FROM #traces# t GROUP BY model_id""")
def latency_percentiles(inp: Inputs):
    p = exact_percentiles(traces(inp), ["model_id"], "total_latency_ms", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return p.select("model_id", "n", *[r6(c, c) for c in ("p50", "p95", "p99")])


_SLO = "coalesce(s.ttft_p95_ms, 1200e0) AS ttft_slo_ms, coalesce(s.total_p95_ms, 8000e0) AS total_slo_ms"


@query("slo_join_default", f"""SELECT task_type, ttft_slo_ms, total_slo_ms, count(*) AS n, CAST(sum(CASE WHEN ttft_ms > ttft_slo_ms THEN 1 ELSE 0 END) AS BIGINT) AS over_ttft
FROM (SELECT t.task_type, t.ttft_ms, {_SLO} FROM #traces# t LEFT JOIN %latency_slos% s ON s.task_type = t.task_type) x GROUP BY 1, 2, 3""")
def slo_join_default(inp: Inputs):
    j = latency.with_slo(traces(inp), inp.dim("latency_slos"))
    return j.groupBy("task_type", "ttft_slo_ms", "total_slo_ms").agg(
        F.count("*").alias("n"), F.count_if(F.col("ttft_ms") > F.col("ttft_slo_ms")).alias("over_ttft")
    )


@query("latency_slo_check", f"""SELECT t.model_id, t.task_type, round(ttft, 6) AS ttft_p95, round(total, 6) AS total_p95, round(queue, 6) AS queue_p99, round(sec, 6) AS security_p99,
  ttft < coalesce(s.ttft_p95_ms, 1200e0) AS ttft_ok, total < coalesce(s.total_p95_ms, 8000e0) AS total_ok, queue < 500 AS queue_ok, sec < 120 AS security_ok, tps > 20 AS throughput_ok
FROM (SELECT model_id, task_type, quantile_cont(ttft_ms, 0.95) AS ttft, quantile_cont(total_latency_ms, 0.95) AS total, quantile_cont(queue_wait_ms, 0.99) AS queue,
  quantile_cont(security_overhead_ms, 0.99) AS sec, avg(completion_tokens * 1000 / nullif(total_latency_ms - ttft_ms, 0)) AS tps FROM #traces# a GROUP BY model_id, task_type) t
LEFT JOIN %latency_slos% s ON s.task_type = t.task_type""")
def latency_slo_check(inp: Inputs):
    t, keys = traces(inp), ["model_id", "task_type"]
    p = latency.metric_percentiles(t, keys, {
        "ttft_ms": {"ttft": 0.95}, "total_latency_ms": {"total": 0.95}, "queue_wait_ms": {"queue": 0.99}, "security_overhead_ms": {"sec": 0.99}})
    tps = t.groupBy(*keys).agg(F.avg(latency.tokens_per_second(F.col("completion_tokens"), F.col("total_latency_ms"), F.col("ttft_ms"))).alias("tps"))
    j = latency.with_slo(join_groups(p, tps, keys), inp.dim("latency_slos"))
    return j.select(
        *keys, r6("ttft", "ttft_p95"), r6("total", "total_p95"), r6("queue", "queue_p99"), r6("sec", "security_p99"),
        (F.col("ttft") < F.col("ttft_slo_ms")).alias("ttft_ok"), (F.col("total") < F.col("total_slo_ms")).alias("total_ok"),
        (F.col("queue") < 500).alias("queue_ok"), (F.col("sec") < 120).alias("security_ok"), (F.col("tps") > 20).alias("throughput_ok"),
    )


_TPS = "completion_tokens * 1000 / nullif(total_latency_ms - ttft_ms, 0)"


@query("throughput", f"""SELECT model_id, count(*) AS n, round(avg({_TPS}), 6) AS tokens_per_second, round(avg(CASE WHEN {_TPS} > 20 THEN 1 ELSE 0 END), 6) AS share_above_20 FROM #traces# t GROUP BY model_id""")
def throughput(inp: Inputs):
    tps = latency.tokens_per_second(F.col("completion_tokens"), F.col("total_latency_ms"), F.col("ttft_ms"))
    return traces(inp).groupBy("model_id").agg(
        F.count("*").alias("n"), r6(F.avg(tps), "tokens_per_second"), r6(F.avg(F.when(tps > 20, 1).otherwise(0)), "share_above_20")
    )


@query("baseline_scores", """SELECT model_id, task_type, count(*) AS n, round(avg(grounding_score), 6) AS grounding, round(quantile_cont(self_consistency_score, 0.5), 6) AS consistency_p50 FROM #traces# t GROUP BY model_id, task_type""")
def baseline_scores(inp: Inputs):
    keys = ["model_id", "task_type"]
    mid = exact_percentiles(traces(inp), keys, "self_consistency_score", {"p50": 0.5})
    mean = traces(inp).groupBy(*keys).agg(F.avg("grounding_score").alias("g"))
    return join_groups(mid, mean, keys).select(*keys, "n", r6("g", "grounding"), r6("p50", "consistency_p50"))


@query("load_profile_check", """WITH c AS (SELECT date_trunc('minute', ts) AS w, count(*) AS n FROM #load_requests# t GROUP BY 1 HAVING count(*) >= 100)
SELECT CAST(a.w AS VARCHAR) AS window_start, min(b.n) AS min_n FROM (SELECT DISTINCT w + i * INTERVAL 1 MINUTE AS w FROM c, unnest([0,1,2,3,4]) u(i)) a JOIN c b ON b.w BETWEEN a.w - INTERVAL 4 MINUTE AND a.w GROUP BY a.w HAVING count(*) = 5""")
def load_profile_check(inp: Inputs):
    return latency.sustained_load(inp.view("load_requests"), "1 minute", 100, 5).select(F.col("window_start").cast("string").alias("window_start"), "min_n")


@query("token_volume_by_user", "SELECT user_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS tokens FROM #traces# t GROUP BY 1, 2")
def token_volume_by_user(inp: Inputs):
    return latency.hourly_volume(traces(inp)).select("user_id", F.col("hour").cast("string").alias("hour"), "tokens")


@query("token_volume_anomaly", """SELECT user_id, CAST(hour AS VARCHAR) AS hour, tokens, round(baseline, 6) AS baseline FROM (
  SELECT *, avg(tokens) OVER (PARTITION BY user_id ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS baseline FROM (
    SELECT user_id, date_trunc('hour', ts) AS hour, CAST(sum(prompt_tokens + completion_tokens) AS BIGINT) AS tokens FROM #traces# t GROUP BY 1, 2) a) b WHERE tokens > 5 * baseline""")
def token_volume_anomaly(inp: Inputs):
    return latency.volume_anomalies(latency.hourly_volume(traces(inp))).select(
        "user_id", F.col("hour").cast("string").alias("hour"), "tokens", r6("baseline", "baseline")
    )


@query("ttft_regression", """SELECT model_id, CAST(day AS VARCHAR) AS day, round(p95, 6) AS p95, round(baseline, 6) AS baseline FROM (
  SELECT *, avg(p95) OVER (PARTITION BY model_id ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS baseline FROM (
    SELECT model_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, quantile_cont(ttft_ms, 0.95) AS p95 FROM #traces# t GROUP BY 1, 2) a) b WHERE p95 > 1.5 * baseline""")
def ttft_regression(inp: Inputs):
    return latency.ttft_regressions(traces(inp)).select("model_id", F.col("day").cast("string").alias("day"), r6("p95", "p95"), r6("baseline", "baseline"))


@query("error_rate", """SELECT model_id, CAST(CAST(date_trunc('day', ts) AS TIMESTAMP) AS VARCHAR) AS window_start, count(*) AS n, CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS bad, round(avg(CASE WHEN status = 'failed' THEN 1 ELSE 0 END), 6) AS rate FROM #traces# t GROUP BY 1, 2""")
def error_rate(inp: Inputs):
    rate = quality.rate_by_window(traces(inp), ["model_id"], "1 day", (F.col("status") == "failed").cast("int"))
    return rate.select("model_id", F.col("window_start").cast("string").alias("window_start"), "n", "bad", r6("rate", "rate"))


# --- hallucination and consistency -------------------------------------------
@query("hallucination_rate", f"""SELECT model_id, task_type, CAST(time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '1970-01-01') AS VARCHAR) AS window_start, count(*) AS n, CAST(sum({BAD}) AS BIGINT) AS bad, round(avg({BAD}), 6) AS rate
FROM #traces# t GROUP BY 1, 2, 3""")
def hallucination_rate(inp: Inputs):
    rate = quality.rate_by_window(traces(inp), ["model_id", "task_type"], "7 days", bad())
    return rate.select("model_id", "task_type", F.col("window_start").cast("string").alias("window_start"), "n", "bad", r6("rate", "rate"))


@query("hallucination_spike_1h", f"""SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS window_start, count(*) AS n, CAST(sum({BAD}) AS BIGINT) AS bad, round(avg({BAD}), 6) AS rate, 'HIGH' AS severity
FROM #traces# t GROUP BY 1 HAVING avg({BAD}) > 0.05""")
def hallucination_spike_1h(inp: Inputs):
    rate = quality.rate_by_window(traces(inp), [], "1 hour", bad()).where("rate > 0.05")
    return rate.select(F.col("window_start").cast("string").alias("window_start"), "n", "bad", r6("rate", "rate"), F.lit("HIGH").alias("severity"))


@query("rolling_hallucination_7d", f"""SELECT DISTINCT model_id, task_type, CAST(hour AS VARCHAR) AS hour, CAST(bad_total AS BIGINT) AS bad_total, n_total, round(bad_total / n_total, 6) AS rate FROM (
  SELECT model_id, task_type, hour, sum(b) OVER w AS bad_total, count(*) OVER w AS n_total FROM (SELECT model_id, task_type, date_trunc('hour', ts) AS hour, {BAD} AS b FROM #traces# t) x
  WINDOW w AS (PARTITION BY model_id, task_type ORDER BY hour RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)) y""")
def rolling_hallucination_7d(inp: Inputs):
    roll = quality.rolling_rate(traces(inp), ["model_id", "task_type"], bad())
    return roll.select("model_id", "task_type", F.col("hour").cast("string").alias("hour"), "bad_total", "n_total", r6("rate", "rate"))


@query("grounding_drop_dod", """SELECT model_id, CAST(CAST(day AS TIMESTAMP) AS VARCHAR) AS day, round(prev_score, 6) AS prev_score, round(score, 6) AS score, round((prev_score - score) / prev_score, 6) AS "drop" FROM (
  SELECT a.model_id, a.day, b.score AS prev_score, a.score FROM (SELECT model_id, date_trunc('day', ts) AS day, avg(grounding_score) AS score FROM #traces# t GROUP BY 1, 2) a
  JOIN (SELECT model_id, date_trunc('day', ts) AS day, avg(grounding_score) AS score FROM #traces# t GROUP BY 1, 2) b ON b.model_id = a.model_id AND b.day + INTERVAL 1 DAY = a.day) x WHERE (prev_score - score) / prev_score > 0.15""")
def grounding_drop_dod(inp: Inputs):
    d = quality.drop_day_over_day(traces(inp), ["model_id"], "grounding_score")
    return d.select("model_id", F.col("day").cast("string").alias("day"), r6("prev_score", "prev_score"), r6("score", "score"), r6("drop", "drop"))


@query("low_consistency_runs", """SELECT model_id, count(*) AS run_length, CAST(min(ts) AS VARCHAR) AS started, CAST(max(ts) AS VARCHAR) AS ended, round(min(s), 6) AS lowest FROM (
  SELECT model_id, ts, self_consistency_score AS s, row_number() OVER (PARTITION BY model_id ORDER BY ts, request_id) - row_number() OVER (PARTITION BY model_id, self_consistency_score < 0.7e0 ORDER BY ts, request_id) AS island, self_consistency_score < 0.7e0 AS low
  FROM #traces# t) x WHERE low GROUP BY model_id, island HAVING count(*) > 20""")
def low_consistency_runs(inp: Inputs):
    runs = quality.low_runs(traces(inp), "model_id", "self_consistency_score", ["ts", "request_id"])
    return runs.select("model_id", "run_length", F.col("started").cast("string").alias("started"), F.col("ended").cast("string").alias("ended"), r6("lowest", "lowest"))


@query("consistency_histogram", "SELECT CAST(floor(20 * (self_consistency_score - 0e0) / (1e0 - 0e0)) AS BIGINT) + 1 AS bucket, count(*) AS n FROM #traces# t GROUP BY 1")
def consistency_histogram(inp: Inputs):
    return quality.histogram(traces(inp), "self_consistency_score", 0.0, 1.0, 20)


@query("self_consistency", """SELECT a.label AS prompt_id, CAST(max(c.n) AS BIGINT) AS n, round(avg(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 6) AS score
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id < b.vec_id JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) c ON c.label = a.label GROUP BY a.label""")
def self_consistency(inp: Inputs):
    return quality.self_consistency(inp.view("responses_embedded"), "prompt_id", "embedding").select("prompt_id", "n", r6("score", "score"))


@query("pairwise_similarity", """SELECT a.label AS prompt_id, a.vec_id AS response_id, round(avg(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))), 6) AS mean_similarity
FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY a.label, a.vec_id""")
def pairwise_similarity(inp: Inputs):
    s = quality.similarity_to_others(inp.view("responses_embedded"), "prompt_id", "response_id", "embedding")
    return s.select("prompt_id", "response_id", r6("mean_similarity", "mean_similarity"))


_J = "CASE WHEN json_valid(judge_json) THEN CAST(json_extract(judge_json, '$.{0}') AS INTEGER) END"
_JUDGED = "(" + " AND ".join(f"coalesce({_J.format(d)} BETWEEN 1 AND 5, FALSE)" for d in quality.JUDGE_DIMENSIONS) + ")"


@query("judge_scores", "SELECT model_id, count(*) AS n, CAST(sum(CASE WHEN " + _JUDGED + " THEN 0 ELSE 1 END) AS BIGINT) AS malformed, "
       + ", ".join(f"round(avg(CASE WHEN {_JUDGED} THEN {_J.format(d)} END), 6) AS {d}" for d in quality.JUDGE_DIMENSIONS) + " FROM #judge# j GROUP BY model_id")
def judge_scores(inp: Inputs):
    j = quality.judge_averages(inp.view("judge"), "model_id", "judge_json")
    return j.select("model_id", "n", "malformed", *[r6(d, d) for d in quality.JUDGE_DIMENSIONS])


# answers in the three forms that are asked for: an object with the rubric's fields, a list, a text with markdown
fragment("answers", """SELECT model_id, request_id % 3 AS kind, CASE request_id % 3 WHEN 0 THEN judge_json WHEN 1 THEN CASE WHEN request_id % 5 = 0 THEN judge_json ELSE concat('[', judge_json, ']') END
  ELSE CASE WHEN request_id % 4 = 0 THEN judge_json ELSE concat('## Result', chr(10), '- ', judge_json) END END AS answer FROM #judge# j""")
_FIELDS = "(" + " AND ".join(f"coalesce(list_contains(json_keys(CASE WHEN json_valid(answer) THEN answer END), '{d}'), FALSE)" for d in quality.JUDGE_DIMENSIONS) + ")"
_FORM_OK = f"CASE kind WHEN 0 THEN json_valid(answer) AND {_FIELDS} WHEN 1 THEN json_valid(answer) AND regexp_matches(answer, '^\\s*[\\[{{]') ELSE regexp_matches(answer, '(?m)^(#{{1,6}} |[-*] )') END"


@query("format_compliance", f"""SELECT model_id, CASE kind WHEN 0 THEN 'schema' WHEN 1 THEN 'json' ELSE 'markdown' END AS form, count(*) AS n, CAST(sum(CASE WHEN {_FORM_OK} THEN 1 ELSE 0 END) AS BIGINT) AS valid,
  round(avg(CASE WHEN {_FORM_OK} THEN 1 ELSE 0 END), 6) AS share FROM #answers# a GROUP BY model_id, kind""")
def format_compliance(inp: Inputs):
    j, rid = F.col("judge_json"), F.col("request_id")
    listed = F.when(rid % 5 == 0, j).otherwise(F.concat(F.lit("["), j, F.lit("]")))
    marked = F.when(rid % 4 == 0, j).otherwise(F.concat(F.lit("## Result\n- "), j))
    answers = inp.view("judge").select("model_id", (rid % 3).alias("kind"), F.when(rid % 3 == 0, j).when(rid % 3 == 1, listed).otherwise(marked).alias("answer"))
    a, kind = F.col("answer"), F.col("kind")
    ok = F.when(kind == 0, quality.is_json(a, quality.JUDGE_DIMENSIONS)).when(kind == 1, quality.is_json(a)).otherwise(quality.is_markdown(a))
    form = F.when(kind == 0, "schema").when(kind == 1, "json").otherwise("markdown")
    return answers.groupBy("model_id", form.alias("form")).agg(F.count("*").alias("n"), F.count_if(ok).alias("valid"), r6(F.avg(ok.cast("int")), "share"))


@query("slo_burn_rate", """SELECT CAST(CAST(day AS TIMESTAMP) AS VARCHAR) AS day, slo, CAST(sum(bad) AS BIGINT) AS bad, count(*) AS total, round(sum(bad) / count(*) / 0.05e0, 6) AS burn, round(1 - sum(bad) / count(*) / 0.05e0, 6) AS remaining FROM (
  SELECT date_trunc('day', ts) AS day, 'hallucination' AS slo, """ + BAD + """ AS bad FROM #traces# t UNION ALL SELECT date_trunc('day', ts), 'ttft', CASE WHEN ttft_ms > 1200 THEN 1 ELSE 0 END FROM #traces# t2) x GROUP BY 1, 2""")
def slo_burn_rate(inp: Inputs):
    b = quality.burn_rates(traces(inp), {"hallucination": (bad(), 0.05), "ttft": (F.col("ttft_ms") > 1200, 0.05)})
    return b.select(F.col("day").cast("string").alias("day"), "slo", "bad", "total", r6("burn", "burn"), r6("remaining", "remaining"))


# --- grounding ---------------------------------------------------------------
fragment("sentence_claims", """SELECT doc_id, lang, source, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS ord, claim FROM (
  SELECT doc_id, lang, source, i, trim(replace(s[i], chr(10), ' '), ' ') AS claim FROM (SELECT doc_id, lang, source, s, unnest(range(1, len(s) + 1)) AS i FROM (
    SELECT doc_id, lang, source, regexp_extract_all(text, '[^.!?]+[.!?]*') AS s FROM documents) a) b) c WHERE regexp_matches(claim, '[^\\s.,;:!?]+')""")
_W = "regexp_extract_all(lower({0}), '[^\\s.,;:!?]+')"
_SH = """SELECT DISTINCT {k}, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+2], ' ') END AS s
FROM (SELECT {k}, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM (SELECT {k}, {w} AS w FROM {src}) a) b"""
fragment("claim_sh", _SH.format(k="claim", w=_W.format("claim"), src="(SELECT DISTINCT claim FROM #sentence_claims# c0) c1"))
fragment("chunk_sh", _SH.format(k="item_id", w=_W.format("text"), src="benchmark"))
fragment("grounded", """SELECT c.doc_id, c.lang, c.source, c.ord, g.claim IS NOT NULL AS supported FROM #sentence_claims# c LEFT JOIN (
  SELECT DISTINCT x.claim FROM (SELECT a.claim, b.item_id, count(*) AS shared FROM #claim_sh# a JOIN #chunk_sh# b ON a.s = b.s GROUP BY 1, 2) x
  JOIN (SELECT claim, count(*) AS m FROM #claim_sh# z GROUP BY 1) y ON y.claim = x.claim WHERE 10 * x.shared >= 6 * y.m) g ON g.claim = c.claim""")


def claim_rows(inp: Inputs):
    return grounding.claims(inp.texts("documents"), "doc_id", "text", ["lang", "source"])


def grounded(inp: Inputs):
    chunks = inp.table("benchmark").select(F.col("item_id").alias("chunk_id"), F.col("text").alias("chunk"))
    return grounding.ground(claim_rows(inp), chunks)


@query("claim_extract", "SELECT doc_id, ord, claim FROM #sentence_claims# c")
def claim_extract(inp: Inputs):
    return claim_rows(inp).select("doc_id", "ord", "claim")


@query("grounding_join", "SELECT doc_id, ord, supported FROM #grounded# g")
def grounding_join(inp: Inputs):
    return grounded(inp).select("doc_id", "ord", "supported")


@query("grounding_score", "SELECT doc_id, count(*) AS claims, CAST(sum(CASE WHEN supported THEN 1 ELSE 0 END) AS BIGINT) AS supported, round(avg(CASE WHEN supported THEN 1 ELSE 0 END), 6) AS score FROM #grounded# g GROUP BY doc_id")
def grounding_score(inp: Inputs):
    return grounding.scores(grounded(inp), ["doc_id"]).select("doc_id", "claims", "supported", r6("score", "score"))


@query("grounding_heatmap", "SELECT source, " + ", ".join(f"round(avg(CASE WHEN lang = '{x}' THEN CASE WHEN supported THEN 1 ELSE 0 END END), 6) AS {x}" for x in LANGS) + " FROM #grounded# g GROUP BY source")
def grounding_heatmap(inp: Inputs):
    return grounding.heatmap(grounded(inp), "source", "lang", LANGS).select("source", *[r6(x, x) for x in LANGS])


# --- rollback validation -----------------------------------------------------
@query("rollback_validation", f"""SELECT phase, count(*) AS n, round(quantile_cont(ttft_ms, 0.95), 6) AS ttft_p95, round(avg({BAD}), 6) AS hallucination_rate, round(avg(CASE WHEN status = 'failed' THEN 1 ELSE 0 END), 6) AS error_rate
FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'before' ELSE 'after' END AS phase FROM #traces# t) x GROUP BY phase""")
def rollback_validation(inp: Inputs):
    cut = F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")
    t = traces(inp).withColumn("phase", F.when(F.col("ts") < cut, "before").otherwise("after"))
    rates = t.groupBy("phase").agg(r6(F.avg(bad()), "hallucination_rate"), r6(F.avg((F.col("status") == "failed").cast("int")), "error_rate"))
    return exact_percentiles(t, ["phase"], "ttft_ms", {"p95": 0.95}).join(rates, "phase").select("phase", "n", r6("p95", "ttft_p95"), "hallucination_rate", "error_rate")
