"""Append-only audit log: first record per event wins, paged reads for admins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.operators.ordered import ordered_window
from custodia.session import pinned
from custodia.sources import dims

MANDATORY = ["event_id", "ts", "user_id", "user_role", "session_id"]
DEFAULTS = {"model_id": "", "completion_tokens": 0, "latency_ms": 0, "response_hash": ""}
LIST_DEFAULTS = ["tool_calls", "pii_tokens_present", "compliance_flags"]


def with_defaults(records: DataFrame) -> DataFrame:
    """Column defaults for absent values; only columns that exist are touched."""
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items() if c in records.columns}
    empty = F.expr("cast(array() as array<string>)")
    cols |= {c: F.coalesce(F.col(c), empty) for c in LIST_DEFAULTS if c in records.columns}
    return records.withColumns(cols)


def complete_rows(records: DataFrame) -> Column:
    ok = F.lit(True)
    for c in MANDATORY:
        if c in records.columns:
            ok = ok & F.col(c).isNotNull()
    return ok


def rejected(records: DataFrame) -> DataFrame:
    """Records dropped because a mandatory field is NULL, for a side output."""
    return records.where(~complete_rows(records))


def first_per_event(records: DataFrame, order: list[str]) -> DataFrame:
    """First complete record of each event; combines before the shuffle."""
    good = records.where(complete_rows(records))
    row = F.min_by(F.struct(*records.columns), F.struct(*order))
    return good.groupBy("event_id").agg(row.alias("r")).select("r.*")


def new_rows(existing: DataFrame, records: DataFrame, order: list[str]) -> DataFrame:
    """Rows to append: events not in the log yet, one record each."""
    fresh = records.join(existing.select("event_id"), "event_id", "left_anti").select(*records.columns)
    return first_per_event(fresh, order)


def with_sequence(log: DataFrame, order: list[str], start: int = 0) -> DataFrame:
    """Dense insertion number over the whole log, computed chunk by chunk."""
    return ordered_window(log, [], order, running={"id": ("sum", F.lit(1).cast("bigint"))}).withColumn("id", F.col("id") + start)


def check_reader(caller_role: str) -> None:
    if caller_role not in dims.AUDIT_READ_ROLES:
        raise PermissionError(f"audit reads need one of {dims.AUDIT_READ_ROLES}, caller has {caller_role!r}")


SORTED_PAGE = 10_000


def page(log: DataFrame, caller_role: str, order: list[str], limit: int = 100, offset: int = 0, after: tuple | None = None) -> DataFrame:
    """Newest-first page (the feature, not a cap); a negative limit reads to the end.

    Rows of equal ``order`` values follow each other by event id, so pages neither repeat nor skip any. ``after`` holds the
    ``order`` values and the event id of the last row seen: the page goes on behind it, and a deep page costs no more than the first one. A page that ends within ``SORTED_PAGE`` rows is a top-k; any other is cut by row numbers that are
    counted in parallel, so no task sorts what is skipped.
    """
    check_reader(caller_role)
    order = order if "event_id" in order else [*order, "event_id"]
    if after is not None and len(after) != len(order):
        raise ValueError(f"a page goes on after values of {order}")
    newest = [F.col(c).desc() for c in order]
    rows = log
    if after is not None:
        key = F.struct(*order)
        rows = rows.where(key < F.struct(*[F.lit(v).cast(log.schema[c].dataType).alias(c) for c, v in zip(order, after)]))
    if 0 <= limit and limit + offset <= SORTED_PAGE:
        top = rows.orderBy(*newest)
        return (top.offset(offset) if offset else top).limit(limit)
    if limit < 0 and not offset:
        return rows.orderBy(*newest)
    # the oldest row has number 1
    total = F.broadcast(rows.agg(F.count("*").alias("__all")))  # one row
    numbered = with_sequence(rows, order).crossJoin(total).withColumn("__n", F.col("__all") - F.col("id"))
    wanted = (F.col("__n") >= offset) & ((F.col("__n") < offset + limit) if limit >= 0 else F.lit(True))
    return numbered.where(wanted).orderBy(*newest).select(*log.columns)


def readers_only(callers: DataFrame, role: str) -> DataFrame:
    return callers.where(F.col(role).isin(*dims.AUDIT_READ_ROLES))


def visible_counts(callers: DataFrame, log: DataFrame, permissions: DataFrame) -> DataFrame:
    """How many audit rows each caller may see: all, the team's, own, or none.

    Rows are counted per user and per team first, so callers never meet the log row by row.
    """
    grants = permissions.where("capability = 'view_audit'").select(F.col("role").alias("caller_role"), "access")
    own = log.groupBy(F.col("user_id").alias("caller_id")).agg(F.count("*").alias("n_own"))
    team = log.groupBy(F.col("team").alias("caller_team")).agg(F.count("*").alias("n_team"))
    full = log.agg(F.count("*").alias("n_full"))
    j = (
        callers.join(grants, "caller_role", "left")
        .join(own, "caller_id", "left")
        .join(team, "caller_team", "left")
        .crossJoin(F.broadcast(full))  # one row
    )
    n = F.when(F.col("access") == "full", F.col("n_full")).when(F.col("access") == "team", F.col("n_team")).when(
        F.col("access") == "own", F.col("n_own"))
    return j.select("caller_id", "caller_role", "caller_team", F.coalesce(n, F.lit(0)).alias("visible_rows"))


def visible_to(log: DataFrame, access: str, user_id: str | None = None, team: str | None = None) -> DataFrame:
    """Rows one caller may see, as a plain filter."""
    if access == "full":
        return log
    if access == "team":
        return log.where(F.col("team") == team)
    if access == "own":
        return log.where(F.col("user_id") == user_id)
    return log.where(F.lit(False))


def retained(log: DataFrame, as_of: str, years: int = 2, ts: str = "ts") -> DataFrame:
    """Rows younger than the retention time. A log partitioned by ``dt`` is pruned by it."""
    start = F.expr(f"TIMESTAMP '{as_of}' - INTERVAL {int(years)} YEARS")
    kept = log.where(F.col(ts) >= start)
    return kept.where(F.col("dt") >= F.to_date(start)) if "dt" in log.columns else kept


def completeness(completions: DataFrame, log: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Completions without an audit row, and audit rows without user, role or time."""
    missing = completions.join(log.select(event_id), event_id, "left_anti").agg(F.count("*").alias("missing"))
    nulls = log.agg(
        F.count("*").alias("audit_rows"),
        F.count_if(F.col("user_id").isNull()).alias("null_user"),
        F.count_if(F.col("user_role").isNull()).alias("null_role"),
        F.count_if(F.col("ts").isNull()).alias("null_ts"),
    )
    j = nulls.crossJoin(F.broadcast(missing))  # one row each
    return j.withColumn("complete", (F.col("missing") + F.col("null_user") + F.col("null_role") + F.col("null_ts")) == 0)


#: Digests of a day; a changed row leads to one of them.
BUCKETS = 256


def _cell(key: str, ts: str, buckets: int) -> list[Column]:
    day = F.coalesce(F.to_date(ts).cast("string"), F.lit(""))
    return [day.alias("__day"), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("__bucket")]


def digests(snapshot: DataFrame, key: str = "event_id", ts: str = "ts", buckets: int = BUCKETS) -> DataFrame:
    """Leaves of a snapshot's hash tree: per day and bucket of keys the number of rows and a digest of them as a multiset.

    The digest adds up four parts of every row's sha256, so it does not depend on the order of rows and is combined before the shuffle;
    a day of any size leaves at most ``buckets`` rows. Stored beside a snapshot, it need not be read again.
    """
    fields = [F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in sorted(snapshot.columns)]
    rows = snapshot.select(*_cell(key, ts, buckets), F.sha2(F.concat(*fields), 256).alias("__h"))
    parts = [F.sum(F.conv(F.substring("__h", 16 * i + 1, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"d{i}") for i in range(4)]
    return rows.groupBy("__day", "__bucket").agg(F.count("*").alias("n"), *parts).withColumnsRenamed({"__day": "day", "__bucket": "bucket"})


def roots(leaves: DataFrame) -> DataFrame:
    """One digest per day over its buckets (bounded by their number)."""
    leaf = F.concat_ws(":", "bucket", "n", "d0", "d1", "d2", "d3")
    return leaves.groupBy("day").agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list(leaf)), ","), 256).alias("root"))


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """(day, bucket) in which two snapshots' digests differ: first the days by their roots, then the buckets of those days."""
    days = roots(old).select("day", F.col("root").alias("a")).join(roots(new).select("day", F.col("root").alias("b")), "day", "full")
    days = days.where(~F.col("a").eqNullSafe(F.col("b"))).select("day")
    names = ["n", "d0", "d1", "d2", "d3"]
    a = old.join(days, "day", "left_semi").select("day", "bucket", F.struct(*names).alias("a"))
    b = new.join(days, "day", "left_semi").select("day", "bucket", F.struct(*names).alias("b"))
    return a.join(b, ["day", "bucket"], "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("day", "bucket")


def suspects(snapshot: DataFrame, cells: DataFrame, key: str = "event_id", ts: str = "ts", buckets: int = BUCKETS) -> DataFrame:
    """Rows of the named (day, bucket) cells."""
    day, bucket = _cell(key, ts, buckets)
    marked = snapshot.withColumns({"__day": day, "__bucket": bucket})
    on = (F.col("__day") == F.col("day")) & (F.col("__bucket") == F.col("bucket"))
    return marked.join(cells, on, "left_semi").select(*snapshot.columns)


def altered_rows(old: DataFrame, new: DataFrame, key: str = "event_id", ts: str = "ts", old_digests: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows of an earlier snapshot that the later one no longer holds unchanged, as often as they are missing.

    Digests find the cells that differ, and only their rows are compared. ``old_digests`` are those stored with the earlier snapshot.
    """
    new = new.select(*old.columns)
    before = digests(old, key, ts, buckets) if old_digests is None else old_digests
    cells = pinned(differing(before, digests(new, key, ts, buckets)))
    return suspects(old, cells, key, ts, buckets).exceptAll(suspects(new, cells, key, ts, buckets))


def impact(requests: DataFrame, since: str, until: str, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Requests and users served between a deployment and its rollback."""
    hit = requests.where((F.col(ts) >= F.expr(f"TIMESTAMP_NTZ '{since}'")) & (F.col(ts) < F.expr(f"TIMESTAMP_NTZ '{until}'")))
    return hit.agg(F.count("*").alias("requests"), F.countDistinct(user).alias("users"))
