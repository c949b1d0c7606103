"""Analytics over agent messages and tool calls: permissions, order, expiry, escalation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions import text as tx
from custodia.operators.ordered import ordered_window, trailing_count
from custodia.operators.percentiles import exact_percentiles
from custodia.sources import dims


# --- permissions -------------------------------------------------------------
def forbidden_messages(messages: DataFrame, permissions: DataFrame) -> DataFrame:
    """Messages whose (sender, recipient, type) is not listed; blocked by default."""
    return messages.join(permissions, ["sender", "recipient", "message_type"], "left_anti")


def unregistered_calls(calls: DataFrame, registry: DataFrame) -> DataFrame:
    return calls.join(registry.select("tool"), "tool", "left_anti")


def registered_calls(calls: DataFrame, registry: DataFrame) -> DataFrame:
    return calls.join(registry.select("tool"), "tool", "left_semi")


def unauthorized_calls(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """Calls of a registered tool by an agent that is not allowed to use it."""
    allowed = registry.select("tool", F.explode("allowed_agents").alias("agent"))
    return registered_calls(calls, registry).join(allowed, ["tool", "agent"], "left_anti")


def trust_violations(messages: DataFrame, calls: DataFrame, trust: DataFrame) -> DataFrame:
    """L1 agents that trigger anything but a route to the orchestrator, and writes by agents without write access.

    An agent that the trust table lacks has the lowest level and may not write.
    """
    level, may_write = F.coalesce("level", F.lit(1)), F.coalesce("can_write", F.lit(False))
    routed = F.coalesce((F.col("message_type") == "route") & (F.col("recipient") == "ORCHESTRATOR"), F.lit(False))
    m = messages.join(trust.withColumnRenamed("agent", "sender"), "sender", "left").where((level == 1) & ~routed)
    searches = F.coalesce(F.col("tool").endswith("_search"), F.lit(False))
    c = calls.join(trust, "agent", "left").where(~may_write & ~searches)
    return m.select(F.lit("message").alias("kind"), F.concat_ws(":", "trace_id", "seq").alias("item"), F.col("sender").alias("agent")).unionAll(
        c.select(F.lit("tool"), F.col("call_id").cast("string"), "agent")
    )


def trust_changes(observed: DataFrame) -> DataFrame:
    """Agents seen with more than one trust level."""
    return observed.groupBy("agent").agg(F.countDistinct("level").alias("n_levels")).where("n_levels > 1")


def missing_params(calls: DataFrame, registry: DataFrame, params: str) -> DataFrame:
    """Calls that lack a required parameter of their tool."""
    j = calls.join(registry.select("tool", "required_params"), "tool")
    given = F.coalesce(F.map_keys(F.from_json(params, "map<string,string>")), F.expr("cast(array() as array<string>)"))
    return j.withColumn("missing", F.array_except("required_params", given)).where(F.size("missing") > 0).drop("required_params")


def approval(payload: Column) -> Column:
    """The orchestrator's approval as a message's payload states it: true only if it is the JSON value true."""
    return F.coalesce(F.from_json(payload, "orchestrator_approval boolean")["orchestrator_approval"], F.lit(False))


def unapproved(calls: DataFrame, registry: DataFrame, flag: str | Column) -> DataFrame:
    """Calls of execution tools that do not carry the orchestrator's approval: a column, or ``approval`` of the payload."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    execution = registry.where(F.array_contains("allowed_agents", "EXECUTION")).select("tool")
    return calls.join(execution, "tool", "left_semi").where(~F.coalesce(flag, F.lit(False)))


RATE_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}


def rate_limits(registry: DataFrame) -> DataFrame:
    parts = F.split("rate_limit", "/")
    return registry.select("tool", parts[0].cast("int").alias("per_window"), parts[1].alias("unit"))


def limited_cells(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """Registered calls per agent, tool and moment (``n``), with the tool's limit and the seconds it holds for.

    A limit in a unit that is not known fails the query instead of being skipped.
    """
    unit = F.col("unit")
    seconds = F.coalesce(*[F.when(unit == name, F.lit(n)) for name, n in RATE_UNITS.items()], F.raise_error(
        F.concat(F.lit("unknown rate limit unit: "), F.coalesce(unit, F.lit("none")))).cast("int"))
    limits = rate_limits(registry).select("tool", "per_window", seconds.alias("window_s"))
    known = registered_calls(calls, registry)
    return known.groupBy("agent", "tool", "ts").agg(F.count("*").alias("n")).join(limits, "tool")


def over_limit(cells: DataFrame) -> DataFrame:
    """Moments at which the trailing count of ``cells`` exceeds the limit; all units in one pass."""
    counted = trailing_count(cells, ["agent", "tool", "per_window", "window_s"], "ts", F.make_dt_interval(secs=F.col("window_s")), weight="n")
    return counted.where("n_trailing > per_window").select("agent", "tool", "ts", "n_trailing", F.col("per_window").alias("allowed"))


def over_rate_limit(calls: DataFrame, registry: DataFrame) -> DataFrame:
    """Moments at which an agent exceeds a tool's limit within the limit's own time unit."""
    return over_limit(limited_cells(calls, registry))


# --- chains ------------------------------------------------------------------
def consecutive_failures(calls: DataFrame, key: str = "trace_id") -> DataFrame:
    prev = ordered_window(calls.select(key, "ts", "call_id", "status"), [key], ["ts", "call_id"], lag={"prev": F.col("status")})
    return prev.where("status = 'failed' AND prev = 'failed'").drop("prev")


def expired(messages: DataFrame, as_of: Column) -> DataFrame:
    """Messages that had no successor in their chain when their time to live ran out, seen at ``as_of``.

    A message whose time is not over yet is not expired.
    """
    nxt = ordered_window(
        messages.select("trace_id", "seq", "created_at", "ttl_seconds"), ["trace_id"], ["seq"], lead={"next_at": F.col("created_at")}
    )
    deadline = F.col("created_at") + F.make_dt_interval(secs=F.col("ttl_seconds"))
    late = F.coalesce(F.col("next_at") > deadline, F.lit(True)) & (deadline < as_of)
    return nxt.where(late).withColumn("answered_late", F.coalesce(F.col("next_at") <= as_of, F.lit(False)))


def unapproved_actions(messages: DataFrame, acts: Column) -> DataFrame:
    """Actions not preceded in their chain by the orchestrator's execute message."""
    approval = (F.col("sender") == "ORCHESTRATOR") & (F.col("recipient") == "EXECUTION") & (F.col("message_type") == "execute")
    # only what the order needs: the rows may be written out when a chain is split
    narrow = messages.select("trace_id", "seq", acts.alias("__act"), approval.cast("int").alias("__approval"))
    run = ordered_window(narrow, ["trace_id"], ["seq"], running={"__ok": ("max", F.col("__approval"))})
    return run.where(F.col("__act") & (F.col("__ok") == 0)).select("trace_id", "seq")


def reentries(messages: DataFrame) -> DataFrame:
    """How often the chain has been clarified by a human up to each message."""
    hit = (F.col("message_type") == "human_response").cast("bigint")
    return ordered_window(messages.select("trace_id", "seq", "message_type"), ["trace_id"], ["seq"], running={"attempts": ("sum", hit)})


def assemble(messages: DataFrame, context: dict[str, Column]) -> DataFrame:
    """A chain in order, one row per message: its position and the context gathered so far.

    Each context key holds the latest non-NULL value. Rows, not one array per
    chain, so a chain of any length is fine.
    """
    running = {"position": ("sum", F.lit(1).cast("bigint"))}
    for name, value in context.items():
        running[f"__x_{name}"] = ("max", F.when(value.isNotNull(), F.struct(F.col("seq").alias("s"), value.alias("v"))))
    out = ordered_window(messages, ["trace_id"], ["seq"], running=running)
    return out.select(*messages.columns, "position", *[F.col(f"__x_{n}")["v"].alias(n) for n in context])


def durations(messages: DataFrame) -> DataFrame:
    per = messages.groupBy("trace_id").agg(F.min("created_at").alias("started"), F.max("created_at").alias("ended"), F.count("*").alias("messages"))
    return per.withColumn("seconds", F.unix_micros("ended").cast("double") / 1e6 - F.unix_micros("started").cast("double") / 1e6)


def peak_concurrency(chains: DataFrame) -> DataFrame:
    """Most chains open at one moment: +1 at the start, -1 at the end, highest running sum."""
    deltas = chains.select(
        F.inline(F.array(F.struct(F.col("started").alias("at"), F.lit(1).alias("d")), F.struct(F.col("ended").alias("at"), F.lit(-1).alias("d"))))
    ).groupBy("at").agg(F.sum("d").alias("d"))
    return ordered_window(deltas, [], ["at"], running={"open": ("sum", F.col("d"))}).agg(F.max("open").alias("peak"))


def routing_latency(messages: DataFrame) -> DataFrame:
    """Seconds from the first message of a chain to its first route message."""
    at = F.unix_micros("created_at").cast("double") / 1e6
    per = messages.groupBy("trace_id").agg(F.min(at).alias("asked"), F.min(F.when(F.col("message_type") == "route", at)).alias("routed"))
    return per.where(F.col("routed").isNotNull()).select("trace_id", (F.col("routed") - F.col("asked")).alias("seconds"))


# --- requests ----------------------------------------------------------------
def extract_intent(text: Column) -> Column:
    """Best matching keyword rule and its confidence: the share of its words that occur."""
    rules = F.array(*[
        F.struct(F.lit(name).alias("intent"), F.array(*[F.lit(k) for k in keywords]).alias("keywords"))
        for name, keywords in dims.DIMS["intent_rules"].rows
    ])
    found = tx.words(text)
    scored = F.transform(
        rules,
        lambda r: F.struct((F.size(F.array_intersect(r["keywords"], found)) / F.size(r["keywords"])).alias("confidence"), r["intent"].alias("intent")),
    )
    return F.array_max(scored)


def search(items: DataFrame, text: str, terms: list[str], order: list[Column], k: int) -> DataFrame:
    """Top-k items by number of term occurrences, then by ``order``."""
    wanted = F.array(*[F.lit(t) for t in terms])
    score = F.size(F.filter(tx.words(F.col(text)), lambda w: F.array_contains(wanted, w)))
    return items.withColumn("score", score).where("score > 0").orderBy(F.col("score").desc(), *order).limit(k)


def review_sample(tasks: DataFrame, task: str, n: int = 500) -> DataFrame:
    """Deterministic sample of ``n`` tasks for human review."""
    return tasks.orderBy(F.sha2(F.col(task).cast("string"), 256)).limit(n)


# --- context -----------------------------------------------------------------
def bundle_items(sections: dict[str, DataFrame]) -> DataFrame:
    """All results of all sections as rows (trace_id, section, item)."""
    out = None
    for name, df in sections.items():
        part = df.select("trace_id", F.lit(name).alias("section"), F.col("item").cast("bigint").alias("item"))
        out = part if out is None else out.unionAll(part)
    return out


def iso_timestamp(at: Column) -> Column:
    """A time as ISO-8601 text in UTC seconds."""
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def bundle_headers(traces: DataFrame, items: DataFrame, sections: list[str]) -> DataFrame:
    """Per chain: result counts, missing sections and the share of sections that found something.

    Other columns of ``traces``, such as the time of retrieval, are kept.
    """
    counts = items.groupBy("trace_id").agg(*[F.count_if(F.col("section") == s).alias(f"n_{s}") for s in sections])
    j = traces.join(counts, "trace_id", "left").na.fill(0, [f"n_{s}" for s in sections])
    gaps = F.array_compact(F.array(*[F.when(F.col(f"n_{s}") == 0, F.lit(s)) for s in sections]))
    return j.withColumn("gaps", gaps).withColumn("confidence", 1 - F.size("gaps") / float(len(sections)))


def bundle_lists(items: DataFrame, per_list: int = 500) -> DataFrame:
    """The results as ordered lists of bounded length; a long section has several parts."""
    numbered = ordered_window(items, ["trace_id", "section"], ["item"], running={"rn": ("sum", F.lit(1).cast("bigint"))})
    part = F.floor((F.col("rn") - 1) / per_list).cast("int")
    return numbered.groupBy("trace_id", "section", part.alias("part")).agg(F.array_sort(F.collect_list("item")).alias("items"))


def incomplete(headers: DataFrame, bound: float = dims.CONTEXT_CONFIDENCE_MIN) -> DataFrame:
    return headers.where((F.col("confidence") < bound) | (F.size("gaps") > 0))


def escalation_packages(messages: DataFrame, calls: DataFrame, registry: DataFrame, bundles: DataFrame, actions: DataFrame) -> DataFrame:
    """What a human needs to take over an escalated chain.

    ``bundles`` has gaps and confidence per chain, ``actions`` what each chain's triggers (a fixed set) ask for.

    The attempted tools are distinct registered ones, so the list is no longer than the registry.
    """
    per = messages.groupBy("trace_id").agg(
        F.min_by("text", "seq").alias("original_request"), F.count_if(F.col("message_type") == "escalate").alias("n_escalations"),
        F.min("intent_confidence").alias("confidence"),
    ).where("n_escalations > 0")
    used = registered_calls(calls, registry).groupBy("trace_id", "tool").agg(F.min(F.struct("ts", "call_id")).alias("first"))
    tools = used.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("first", "tool"))).alias("t"))
    urgency = F.when(F.col("confidence") < 0.3, "HIGH").when(F.col("confidence") < dims.INTENT_CONFIDENCE_MIN, "MEDIUM").otherwise("LOW")
    bundle = bundles.select("trace_id", F.struct(F.col("gaps"), F.col("confidence")).alias("context_bundle"))
    options = actions.groupBy("trace_id").agg(F.array_sort(F.collect_set("action")).alias("options"))
    understood = extract_intent(F.col("original_request"))["intent"]
    j = per.join(tools, "trace_id", "left").join(bundle, "trace_id", "left").join(options, "trace_id", "left")
    return j.select(
        "trace_id", "original_request", understood.alias("what_was_understood"),
        F.coalesce(F.transform("t", lambda x: x["tool"]), F.expr("cast(array() as array<string>)")).alias("what_was_attempted"),
        F.format_string("Intent confidence %.2f, %d escalation messages", "confidence", "n_escalations").alias("why_escalating"),
        F.coalesce("options", F.expr("cast(array() as array<string>)")).alias("suggested_actions"), "context_bundle",
        F.concat(F.lit("conv_"), F.col("trace_id")).alias("requester"), urgency.alias("urgency"),
    )


def weekly_status(issues: DataFrame, as_of: str) -> DataFrame:
    since = F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL 7 DAYS")
    recent = issues.where((F.col("updated_at") >= since) & (F.col("updated_at") <= F.expr(f"TIMESTAMP_NTZ '{as_of}'")))
    return recent.groupBy("project", "status").agg(F.count("*").alias("n"), F.countDistinct("assignee").alias("assignees"))


def changed_since(source: DataFrame, name: str, item: str, ts: str, as_of: str, days: int = 7) -> DataFrame:
    recent = source.where(F.col(ts) >= F.expr(f"TIMESTAMP_NTZ '{as_of}' - INTERVAL {int(days)} DAYS"))
    return recent.select(F.lit(name).alias("source"), F.col(item).cast("bigint").alias("item"))


def actor_share(updates: DataFrame, phase: Column) -> DataFrame:
    return updates.groupBy(phase.alias("phase")).agg(F.count("*").alias("n"), F.avg((F.col("actor_type") == "human").cast("int")).alias("human_share"))


def launch_kpis(messages: DataFrame, calls: DataFrame, registry: DataFrame, reviews: DataFrame, rating: str) -> DataFrame:
    """One row of launch criteria with their verdict."""
    chains = messages.groupBy("trace_id").agg(F.max((F.col("message_type") == "escalate").cast("int")).alias("esc"))
    rates = chains.agg((1 - F.avg("esc")).alias("completion_rate"), F.avg("esc").alias("escalation_rate"))
    p95 = exact_percentiles(durations(messages), [], "seconds", {"e2e_p95": 0.95}).drop("n")
    total = calls.agg(F.count("*").alias("calls"))
    bad = unauthorized_calls(calls, registry).agg(F.count("*").alias("unauthorized"))
    unknown = unregistered_calls(calls, registry).agg(F.count("*").alias("unregistered"))
    rated = reviews.agg(F.avg(rating).alias("satisfaction"))
    one = rates
    for part in (p95, total, bad, unknown, rated):
        one = one.crossJoin(F.broadcast(part))  # one row each
    accuracy = 1 - (F.col("unauthorized") + F.col("unregistered")) / F.nullif(F.col("calls"), F.lit(0))
    ready = (F.col("completion_rate") > 0.85) & (F.col("escalation_rate") < 0.15) & (F.col("e2e_p95") < 45) & (accuracy > 0.95) & (
        F.col("unauthorized") + F.col("unregistered") == 0) & (F.col("satisfaction") > 4.0)
    return one.withColumns({"tool_accuracy": accuracy, "ready": ready})
