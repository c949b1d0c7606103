"""Token map: write-once records with a time to live, lookups, and restoring texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.functions import pii
from custodia.functions.text import unnest
from custodia.operators.ordered import ordered_window
from custodia.session import pinned
from custodia.sources import dims

FIELDS = ["token", "value", "type", "session_id", "created_at", "expires_at"]


def seconds(n: int | Column) -> Column:
    return F.make_dt_interval(secs=n if isinstance(n, Column) else F.lit(n))


def puts_of(entities: DataFrame, session: str, created_at: str, ttl: int = dims.TOKEN_TTL_SECONDS) -> DataFrame:
    """Map records for the entities of a batch of texts."""
    return entities.select(
        "token", "value", "type", F.col(session).alias("session_id"),
        F.col(created_at).alias("created_at"), (F.col(created_at) + seconds(ttl)).alias("expires_at"),
    )


def _first_per(puts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in FIELDS if c not in keys]
    # min_by combines before the shuffle, so a token put a billion times stays cheap
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return puts.groupBy(*keys).agg(first.alias("r")).select(*keys, *[f"r.{c}" for c in rest]).select(*FIELDS)


def write_once(existing: DataFrame | None, puts: DataFrame, same_session: bool = False) -> DataFrame:
    """Records to append: a put is ignored while an earlier record of the token is alive.

    The first put of a token is accepted; a put at or after the expiry of the record accepted before it re-issues the
    token. Of puts at one instant the first by session and value counts. A token whose puts all fall into the life of
    the first one needs one aggregation. For the others each put points to the first put at or after
    its own expiry, and the accepted ones are those on the path from the first (``_on_path``).
    """
    keys = ["session_id", "token"] if same_session else ["token"]
    open_puts = puts.select(*FIELDS)
    if existing is not None:
        live = existing.select(*keys, F.col("created_at").alias("l_from"), F.col("expires_at").alias("l_to"))
        blocked = [open_puts[k] == live[k] for k in keys] + [
            open_puts["created_at"] >= live["l_from"], open_puts["created_at"] < live["l_to"]
        ]
        open_puts = open_puts.join(live, blocked, "left_anti")
    instants = pinned(_first_per(open_puts, [*keys, "created_at"], [c for c in ("session_id", "value") if c not in keys]))
    span = instants.groupBy(*keys).agg(F.min_by("expires_at", "created_at").alias("f_to"), F.max("created_at").alias("l_at"))
    chains = span.where(F.col("l_at") >= F.col("f_to")).select(*keys)
    first = _first_per(instants, keys, ["created_at"])
    if chains.isEmpty():
        return first
    chained = instants.join(chains, keys, "left_semi")
    path = _on_path(chained, keys)
    again = chained.join(path, [*keys, "created_at"], "left_semi").select(*FIELDS)
    return first.join(chains, keys, "left_anti").unionByName(again)


def _on_path(puts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, created_at) of the puts on each key's path of re-issues, by pointer doubling.

    Puts are numbered in time, and the number of puts before a put's expiry is the number of its successor: both come from one
    running count over all points, so a hot key is spread. Then every round doubles the pointers and
    adds what the puts found so far point to. The rounds are the logarithm of the longest path, and each one is pinned, so neither plan
    nor lineage grows with the data.
    """
    at = F.explode(F.array(
        F.struct(F.col("created_at").alias("t"), F.lit(1).alias("kind"), F.lit(1).cast("bigint").alias("add")),
        # before the puts of its own instant, which may follow; a record without a life ends after itself
        F.struct(F.greatest("created_at", "expires_at").alias("t"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("add")),
    ))
    points = puts.select(*keys, "created_at", at.alias("p")).select(*keys, "created_at", "p.*")
    counted = ordered_window(points, keys, ["t", "kind"], running={"run": ("sum", F.col("add"))})
    number = F.max(F.when(F.col("kind") == 1, F.col("run"))) - 1
    before = F.coalesce(F.max(F.when(F.col("kind") == 0, F.col("run"))), F.lit(0))
    nodes = counted.groupBy(*keys, "created_at").agg(number.alias("number"), F.greatest(before, number + 1).alias("next"))
    nodes = pinned(nodes.withColumn("found", F.col("number") == 0))
    while True:
        found_next = nodes.where("found").select(*keys, F.col("next").alias("number"), F.lit(True).alias("__hit"))
        onward = nodes.select(*keys, F.col("number").alias("next"), F.col("next").alias("__next"))
        # a pointer past the last put finds no node and stays
        doubled = nodes.join(found_next, [*keys, "number"], "left").join(onward, [*keys, "next"], "left").select(
            *keys, "created_at", "number", F.coalesce("__next", "next").alias("next"),
            (F.col("found") | F.coalesce("__hit", F.lit(False))).alias("found"), (F.col("found") & F.col("__next").isNotNull()).alias("more"),
        )
        nodes = pinned(doubled)
        if nodes.where("more").isEmpty():
            return nodes.where("found").select(*keys, "created_at")
        nodes = nodes.drop("more")


def living(token_map: DataFrame, puts: DataFrame) -> DataFrame:
    """Records still alive at the first put, whatever their own time to live; in microseconds, free of time zones."""
    first = puts.agg(F.min(F.unix_micros("created_at"))).first()[0]
    return token_map if first is None else token_map.where(F.col("expires_at") > F.timestamp_micros(F.lit(first)))


def collisions(puts: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value; the later owner reads the first value."""
    return puts.groupBy("token").agg(F.countDistinct("value").alias("n_values")).where("n_values > 1")


def lookups(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per token occurrence, with its position in the text."""
    some = texts.where(F.contains(F.col(text), F.lit("<PII_TOKEN_")))
    return unnest(some, keep, pii.tokens_in(F.col(text)), "token", "pos")


def read(asked: DataFrame, token_map: DataFrame, at: str | None = None, session: str | None = None) -> DataFrame:
    """Left join of asked tokens with the map; with ``at``, only records alive then, else the latest record of each token.

    A token asked for in a third of all rows is left to the skew join of AQE:
    the right side holds one live record per token.
    """
    m = token_map.select(
        F.col("token").alias("m_token"), F.col("value").alias("value"), F.col("type").alias("type"),
        F.col("session_id").alias("m_session"), F.col("created_at").alias("m_from"), F.col("expires_at").alias("m_to"),
    )
    if at is None:
        keys = ["m_token"] + (["m_session"] if session is not None else [])
        rest = [c for c in m.columns if c not in keys]
        m = m.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("m_from", "m_session", "value")).alias("r")).select(*keys, "r.*")
    on = asked["token"] == m["m_token"]
    if at is not None:
        on = on & (asked[at] >= m["m_from"]) & (asked[at] < m["m_to"])
    if session is not None:
        on = on & (asked[session] == m["m_session"])
    return asked.join(m, on, "left").select(*[asked[c] for c in asked.columns], "value", "type", "m_session")


def may_see(role: Column) -> Column:
    return F.coalesce(role.isin(*dims.PII_ACCESS_ROLES), F.lit(False))


def detokenize(
    texts: DataFrame, token_map: DataFrame, doc_id: str, text: str, role: str,
    at: str | None = None, session: str | None = None,
) -> DataFrame:
    """Restore values for entitled roles; add ``restored`` and ``unresolved``.

    Only texts that hold a token and whose reader may see values are joined; all
    others pass by, so their text is never shuffled.
    """
    wanted = may_see(F.col(role)) & F.contains(F.col(text), F.lit("<PII_TOKEN_"))
    wanted = F.coalesce(wanted, F.lit(False))
    todo = texts.where(wanted).withColumn("__h", F.xxhash64(text))
    # a text is known by its id, itself and the moment of reading; repeated rows share one result
    keep = list(dict.fromkeys([doc_id, "__h"] + [c for c in (at, session) if c]))
    found = read(lookups(todo, text, keep), token_map, at, session)
    one = found.groupBy(*keep, "pos").agg(F.first("token").alias("token"), F.max("value").alias("value"))
    # as many entries as the text holds tokens
    per_doc = one.groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct("pos", "token", "value"))).alias("__t"))
    per_doc = per_doc.withColumnsRenamed({c: f"__k_{c}" for c in keep})
    fill = F.transform("__t", lambda t: F.coalesce(t["value"], t["token"]))
    gaps = F.split(F.col(text), F.lit(pii.TOKEN_REGEX), -1)
    restored = F.array_join(F.zip_with(gaps, fill, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    missing = F.transform(F.filter("__t", lambda t: t["value"].isNull()), lambda t: t["token"])
    joined = todo.join(per_doc, reduce(lambda a, b: a & b, [todo[c].eqNullSafe(per_doc[f"__k_{c}"]) for c in keep]), "left")
    done = joined.select(
        *[todo[c] for c in texts.columns],
        F.when(F.col("__t").isNull(), F.col(text)).otherwise(restored).alias("restored"),
        F.coalesce(missing, F.expr("cast(array() as array<string>)")).alias("unresolved"),
    )
    same = texts.where(~wanted).select(
        *texts.columns, F.col(text).alias("restored"), F.expr("cast(array() as array<string>)").alias("unresolved")
    )
    return done.unionByName(same)


def unresolved_counts(texts: DataFrame, token_map: DataFrame, doc_id: str, text: str, role: str, at: str) -> DataFrame:
    """(doc_id, n) of texts whose entitled reader finds tokens without a living record. Nothing is restored, so no text is joined."""
    todo = texts.where(F.coalesce(may_see(F.col(role)), F.lit(False)))
    found = read(lookups(todo, text, [doc_id, at]), token_map, at)
    per = found.groupBy(doc_id, "pos").agg(F.max("value").alias("value")).where("value IS NULL")
    return per.groupBy(doc_id).agg(F.count("*").alias("n"))


def compliance_flags(unresolved: Column) -> Column:
    return F.when(F.size(unresolved) > 0, F.array(F.lit("UNRESOLVED_PII_TOKENS"))).otherwise(
        F.expr("cast(array() as array<string>)")
    )


def without_sessions(token_map: DataFrame, ended: DataFrame) -> DataFrame:
    """Map without the records of ended sessions."""
    return token_map.join(ended.select("session_id").distinct(), "session_id", "left_anti")


def deleted_per_session(token_map: DataFrame, ended: DataFrame) -> DataFrame:
    """How many records the clean-up of each ended session removes."""
    counts = token_map.groupBy("session_id").agg(F.count("*").alias("n"))
    return ended.select("session_id").distinct().join(counts, "session_id", "left").select(
        "session_id", F.coalesce("n", F.lit(0)).alias("deleted")
    )
