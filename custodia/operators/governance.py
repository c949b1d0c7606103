"""Alerts, escalation triggers, rollback decisions and the control report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.functions import text as tx


def alert_rows(df: DataFrame, alert: str, key: Column, value: Column) -> DataFrame:
    """Bring the output of a rule into the common alert form."""
    return df.select(F.lit(alert).alias("alert"), key.cast("string").alias("key"), F.round(value.cast("double"), 6).alias("value"))


def alert_feed(parts: list[DataFrame], rules: DataFrame) -> DataFrame:
    """One feed of all alerts with severity and channel."""
    return reduce(DataFrame.unionByName, parts).join(rules, "alert").select("alert", "severity", "channel", "response", "key", "value")


def route(feed: DataFrame) -> DataFrame:
    return feed.groupBy("severity", "channel", "alert").agg(F.count("*").alias("n"))


def rollback_decision(feed: DataFrame, matrix: DataFrame, model: str) -> DataFrame:
    """The most severe alert of a model decides who approves and how fast; one HIGH is enough."""
    ranked = feed.join(matrix, "severity")
    return ranked.groupBy(model).agg(
        F.max_by(F.struct("severity", "approver", "target_minutes"), "severity_rank").alias("d"), F.count("*").alias("alerts")
    ).select(model, "d.severity", "d.approver", "d.target_minutes", "alerts", F.col("d.severity").isin("HIGH", "CRITICAL").alias("rollback"))


def version_rank(versions: DataFrame) -> DataFrame:
    """Versions from newest to oldest with their predecessor and the best score so far (registry: few rows per model)."""
    newest = W.partitionBy("model_id").orderBy(F.col("deployed").desc())
    upto = W.partitionBy("model_id").orderBy("deployed")
    return versions.withColumns(
        {"rank": F.row_number().over(newest), "previous": F.lead("version").over(newest), "best_so_far": F.max("eval_score").over(upto)}
    )


def rollback_target(versions: DataFrame, known_good: float) -> DataFrame:
    """Per model the running version and the latest earlier one whose score is known good."""
    current = versions.groupBy("model_id").agg(F.max_by("version", "deployed").alias("current_version"), F.max("deployed").alias("c_at"))
    earlier = versions.join(current, "model_id").where((F.col("deployed") < F.col("c_at")) & (F.col("eval_score") >= known_good))
    pick = earlier.groupBy("model_id").agg(F.max_by(F.struct("version", "eval_score"), "deployed").alias("t"))
    return current.join(pick, "model_id", "left").select(
        "model_id", "current_version", F.col("t.version").alias("target_version"), F.col("t.eval_score").alias("target_score")
    )


def escalations(triggers: dict[str, DataFrame], rules: DataFrame) -> DataFrame:
    """One row per chain and trigger, with the action to take."""
    parts = [df.select("trace_id", F.lit(name).alias("trigger")).distinct() for name, df in triggers.items()]
    return reduce(DataFrame.unionByName, parts).join(rules, "trigger").select("trace_id", "trigger", "action")


# --- controls ----------------------------------------------------------------
def evidence_checks(lines: DataFrame, keywords: DataFrame, run: str = "run_id", line: str = "line", same_line: bool = False) -> DataFrame:
    """Checks taken from the console output of validation runs: (run, control_id, evidence_group, passed, n_lines, first_line).

    A group passes if each of its words occurs somewhere in the run's output, whatever the case; with ``same_line`` all must
    stand in one line. ``n_lines`` counts the lines with all words, ``first_line`` is the smallest of them. Lines are reduced per run before
    the shuffle; the words of the few controls are a small table.
    """
    words = sorted({w for r in keywords.select("keywords").collect() for w in r[0]})
    texts = lines.select(run, F.lower(line).alias("__t"), F.col(line).alias("__l"))
    groups = [(r.control_id, r.evidence_group, list(r.keywords)) for r in keywords.collect()]
    whole = [tx.all_keywords(F.col("__t"), F.array(*[F.lit(w) for w in ws])) for _, _, ws in groups]
    aggs = [F.bool_or(F.contains("__t", F.lit(w.lower()))).alias(f"w{i}") for i, w in enumerate(words)]
    aggs += [F.count_if(c).alias(f"n{i}") for i, c in enumerate(whole)] + [F.min(F.when(c, F.col("__l"))).alias(f"l{i}") for i, c in enumerate(whole)]
    seen = texts.groupBy(run).agg(*aggs)

    def row(i: int, control: str, group: int, ws: list[str]) -> Column:
        anywhere = reduce(lambda a, b: a & b, [F.coalesce(f"w{words.index(w)}", F.lit(False)) for w in ws])
        passed = F.col(f"n{i}") > 0 if same_line else anywhere
        return F.struct(F.lit(control).alias("control_id"), F.lit(group).alias("evidence_group"), passed.alias("passed"), F.col(f"n{i}").alias("n_lines"), F.col(f"l{i}").alias("first_line"))

    return seen.select(run, F.inline(F.array(*[row(i, *g) for i, g in enumerate(groups)])))


def run_controls(runs: DataFrame, checks: DataFrame, controls: DataFrame, run: str = "run_id") -> DataFrame:
    """Control rows of every run: PASS if a group passed, else FAIL if the run ended with an error, else SKIPPED; ``evidence``
    names the command and its exit code, ``detail`` a line that speaks for a passed control."""
    per = checks.groupBy(run, "control_id").agg(F.bool_or("passed").alias("ok"), F.min(F.when(F.col("passed"), F.col("first_line"))).alias("detail"))
    j = runs.crossJoin(F.broadcast(controls)).join(per, [run, "control_id"], "left")  # a row per control
    status = F.when(F.col("ok"), "PASS").when(F.coalesce(F.col("exit_code") != 0, F.lit(True)), "FAIL").otherwise("SKIPPED")
    evidence = F.concat("command", F.lit(" (exit="), F.coalesce(F.col("exit_code").cast("string"), F.lit("unknown")), F.lit(")"))
    return j.select(run, "ord", "control_id", "description", status.alias("status"), evidence.alias("evidence"), "detail")


def check_evidence(checks: DataFrame, controls: DataFrame) -> DataFrame:
    """Evidence text of controls that come from recorded checks."""
    n = checks.groupBy("control_id").agg(F.count_if("passed").alias("p"), F.count_if(~F.col("passed")).alias("f"))
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    text = F.concat(F.lit("checks: "), number("p"), F.lit(" passed, "), number("f"), F.lit(" failed"))
    return controls.join(n, "control_id", "left").withColumn("evidence", text).drop("p", "f")


def control_status(checks: DataFrame, controls: DataFrame) -> DataFrame:
    """PASS if any evidence group passed, else FAIL if the run failed, else SKIPPED."""
    per = checks.groupBy("control_id", "evidence_group").agg(F.bool_or("passed").alias("ok")).groupBy("control_id").agg(F.bool_or("ok").alias("ok"))
    run = checks.agg(F.coalesce(F.bool_or(~F.col("passed")), F.lit(False)).alias("run_failed"))
    j = controls.join(per, "control_id", "left").crossJoin(F.broadcast(run))  # one row
    status = F.when(F.col("ok"), "PASS").when(F.col("run_failed"), "FAIL").otherwise("SKIPPED")
    return j.select("ord", "control_id", "description", status.alias("status"))


def overall(controls: DataFrame) -> DataFrame:
    """Verdict and note over the (few) control rows, in definition order."""
    failing = F.array_sort(F.collect_list(F.when(F.col("status") != "PASS", F.struct("ord", "control_id"))))
    ids = F.array_join(F.transform("f", lambda x: x["control_id"]), ", ")
    return controls.agg(F.count("*").alias("controls"), F.count_if(F.col("status") == "PASS").alias("passed"), failing.alias("f")).select(
        "controls", "passed", F.when(F.size("f") == 0, "APPROVED").otherwise("REVIEW_REQUIRED").alias("overall_status"),
        F.when(F.size("f") > 0, F.concat(F.lit("Failing controls: "), ids)).otherwise("").alias("note"),
    )


def report_json(controls: DataFrame, audit_records: DataFrame, generated_at: str, version: str = "1.0") -> DataFrame:
    """The whole report as one JSON text (six controls with their evidence, so one row is small)."""
    rows = controls.agg(F.array_sort(F.collect_list(F.struct("ord", "control_id", "description", "status", "evidence"))).alias("c"))
    one = overall(controls).crossJoin(F.broadcast(rows)).crossJoin(F.broadcast(audit_records.agg(F.count("*").alias("n"))))
    body = F.struct(
        F.lit(generated_at).alias("generated_at"), F.lit(version).alias("prd_version"), F.col("overall_status"),
        F.transform("c", lambda x: F.struct(x["control_id"].alias("control_id"), x["description"].alias("description"), x["status"].alias("status"), x["evidence"].alias("evidence"))).alias("controls"),
        F.col("n").alias("audit_record_count"), F.when(F.col("note") != "", F.array("note")).otherwise(F.expr("cast(array() as array<string>)")).alias("notes"),
    )
    return one.select(F.to_json(body).alias("report"))
