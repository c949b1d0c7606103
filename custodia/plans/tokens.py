"""Token map and restoring of texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from custodia.operators import redaction, tokens
from custodia.plans.registry import Inputs, fragment, query
from custodia.session import pinned

fragment("token_map", """SELECT e.token, e.value, e.type, p.session_id, p.created_at, p.created_at + INTERVAL '3600' SECOND AS expires_at,
  e.request_id, e.ord FROM #entities# e JOIN #prompts# p USING (request_id)""")
# materialised sources: DuckDB's join over the inlined ones is not reliable
_SOURCES = "WITH l AS MATERIALIZED (SELECT * FROM #lookups# a), m AS MATERIALIZED (SELECT * FROM #token_map# b)"
_SUFFIX = "CASE WHEN request_id % 7 = 0 THEN ' <PII_TOKEN_DEADBEEF>' ELSE '' END"
fragment("responses", f"""SELECT request_id, user_id, user_role, session_id, concat(redacted, {_SUFFIX}) AS response, n, prompt,
  created_at + (request_id % 4) * INTERVAL '30' MINUTE AS read_at FROM #redacted# r""")
fragment("lookups", """SELECT request_id, read_at, user_role, CAST(i - 1 AS INTEGER) AS pos, t[i] AS token FROM (
  SELECT request_id, read_at, user_role, t, unnest(range(1, len(t) + 1)) AS i FROM (
    SELECT request_id, read_at, user_role, regexp_extract_all(response, '<PII_TOKEN_[0-9A-F]{8}>') AS t FROM #responses# r) a) b""")


def redacted(inp: Inputs):
    """The redacted prompts and their entities as a gateway would store them: detected once, read by all that follows."""
    r = redaction.redact(inp.prompts(), "prompt", "request_id").drop("prompt")
    return pinned(r)


def entities_of(stored):
    return redaction.entity_rows(stored, ["request_id", "session_id", "created_at"])


def map_of(stored):
    """Records of one batch; tokens are unique per (text, offset) up to collisions."""
    return tokens.write_once(None, tokens.puts_of(entities_of(stored), "session_id", "created_at"))


def token_map(inp: Inputs):
    found = redaction.detect(inp.prompts(), "prompt", "request_id")
    return map_of(found)


def responses_of(stored):
    suffix = F.when(F.col("request_id") % 7 == 0, " <PII_TOKEN_DEADBEEF>").otherwise("")
    late = tokens.seconds((F.col("request_id") % 4) * 1800)
    return stored.select(
        "request_id", "user_id", "user_role", "session_id", F.concat("redacted", suffix).alias("response"),
        F.size("entities").alias("n"), (F.col("created_at") + late).alias("read_at"),
    )


def asked(stored, *keep: str):
    return tokens.lookups(responses_of(stored), "response", ["request_id", *keep])


@query("token_map_write", """SELECT token, value, type, session_id, CAST(created_at AS VARCHAR) AS created_at, CAST(expires_at AS VARCHAR) AS expires_at FROM #token_map# m""")
def token_map_write(inp: Inputs):
    return token_map(inp).select(
        "token", "value", "type", "session_id", F.col("created_at").cast("string"), F.col("expires_at").cast("string")
    )


@query("token_scan", "SELECT request_id, pos, token FROM #lookups# l")
def token_scan(inp: Inputs):
    r = redaction.redact(inp.prompts(), "prompt", "request_id")
    return asked(r)


@query("token_lookup_join", f"""{_SOURCES} SELECT l.request_id, l.pos, l.token, m.value, m.value IS NOT NULL AS resolved
FROM l LEFT JOIN m ON m.token = l.token""")
def token_lookup_join(inp: Inputs):
    stored = redacted(inp)
    return tokens.read(asked(stored), map_of(stored)).select("request_id", "pos", "token", "value", F.col("value").isNotNull().alias("resolved"))


@query("token_asof_join", f"""{_SOURCES} SELECT l.request_id, l.pos, l.token, m.value
FROM l LEFT JOIN m ON m.token = l.token AND l.read_at >= m.created_at AND l.read_at < m.expires_at""")
def token_asof_join(inp: Inputs):
    stored = redacted(inp)
    return tokens.read(asked(stored, "read_at"), map_of(stored), at="read_at").select("request_id", "pos", "token", "value")


@query("token_map_read", f"""{_SOURCES} SELECT l.token, count(*) AS reads, CAST(sum(CASE WHEN m.token IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS hits, min(m.type) AS type, min(m.session_id) AS session_id
FROM l LEFT JOIN m ON m.token = l.token AND l.read_at >= m.created_at AND l.read_at < m.expires_at GROUP BY l.token""")
def token_map_read(inp: Inputs):
    stored = redacted(inp)
    return (
        tokens.read(asked(stored, "read_at"), map_of(stored), at="read_at")
        .groupBy("token")
        .agg(
            F.count("*").alias("reads"), F.count("value").alias("hits"),
            F.min("type").alias("type"), F.min("m_session").alias("session_id"),
        )
    )


@query("token_write_once", """SELECT token, value, 'late' AS session_id, CAST(put_at AS VARCHAR) AS created_at FROM (
  SELECT m.*, m.created_at + (m.request_id % 4) * INTERVAL '30' MINUTE AS put_at FROM #token_map# m) x WHERE NOT (put_at >= created_at AND put_at < expires_at)""")
def token_write_once(inp: Inputs):
    stored = redacted(inp)
    first = map_of(stored)
    again = entities_of(stored).withColumn("created_at", F.col("created_at") + tokens.seconds((F.col("request_id") % 4) * 1800))
    puts = tokens.puts_of(again.withColumn("session_id", F.lit("late")), "session_id", "created_at")
    return tokens.write_once(first, puts).select("token", "value", "session_id", F.col("created_at").cast("string"))


@query("session_cleanup", """SELECT s.session_id, count(m.token) AS deleted
FROM (SELECT DISTINCT source AS session_id FROM documents WHERE source LIKE 'src1%') s LEFT JOIN #token_map# m USING (session_id) GROUP BY s.session_id""")
def session_cleanup(inp: Inputs):
    ended = inp.table("documents").where(F.col("source").startswith("src1")).select(F.col("source").alias("session_id"))
    return tokens.deleted_per_session(token_map(inp), ended)


_ADMIN = "user_role IN ('PLATFORM_ADMIN', 'SUPER_ADMIN')"
# every token of a text is written at one time, so all of them are alive or none
fragment("detokenized", f"""SELECT request_id, user_role, session_id, n, response, read_at,
  CASE WHEN {_ADMIN} AND request_id % 4 < 2 THEN concat(prompt, {_SUFFIX}) ELSE response END AS restored,
  CASE WHEN NOT {_ADMIN} THEN [] WHEN request_id % 4 < 2 THEN (CASE WHEN request_id % 7 = 0 THEN ['<PII_TOKEN_DEADBEEF>'] ELSE [] END)
    ELSE regexp_extract_all(response, '<PII_TOKEN_[0-9A-F]{{8}}>') END AS unresolved FROM #responses# r""")


def detokenized(inp: Inputs):
    stored = redacted(inp)
    return tokens.detokenize(responses_of(stored), map_of(stored), "request_id", "response", "user_role", at="read_at")


def unresolved(inp: Inputs):
    stored = redacted(inp)
    return tokens.unresolved_counts(responses_of(stored), map_of(stored), "request_id", "response", "user_role", "read_at")


@query("detokenize", "SELECT request_id, user_role, restored, array_to_string(unresolved, ',') AS unresolved FROM #detokenized# d")
def detokenize(inp: Inputs):
    return detokenized(inp).select("request_id", "user_role", "restored", F.array_join("unresolved", ",").alias("unresolved"))


@query("unresolved_flag_agg", """SELECT user_role, count(*) AS requests, CAST(sum(CASE WHEN len(unresolved) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS flagged,
  CAST(sum(len(unresolved)) AS BIGINT) AS unresolved FROM #detokenized# d GROUP BY user_role""")
def unresolved_flag_agg(inp: Inputs):
    flagged = F.array_contains(tokens.compliance_flags(F.col("unresolved")), "UNRESOLVED_PII_TOKENS")
    return detokenized(inp).groupBy("user_role").agg(
        F.count("*").alias("requests"), F.sum(flagged.cast("bigint")).alias("flagged"),
        F.sum(F.size("unresolved")).alias("unresolved"),
    )


@query("pii_access_gate", f"""SELECT user_role, {_ADMIN} AS may_see, count(*) AS n, CAST(sum(CASE WHEN restored <> response THEN 1 ELSE 0 END) AS BIGINT) AS changed
FROM #detokenized# d GROUP BY user_role""")
def pii_access_gate(inp: Inputs):
    return detokenized(inp).groupBy("user_role").agg(
        F.first(tokens.may_see(F.col("user_role"))).alias("may_see"), F.count("*").alias("n"),
        F.sum((F.col("restored") != F.col("response")).cast("bigint")).alias("changed"),
    )


@query("response_project", """SELECT concat('ev', CAST(request_id AS VARCHAR)) AS audit_event_id, restored AS response, n > 0 AS pii_detected, CAST(n AS INTEGER) AS pii_token_count,
  array_to_string(unresolved, ',') AS unresolved_pii_tokens, CASE WHEN len(unresolved) > 0 THEN 'UNRESOLVED_PII_TOKENS' ELSE '' END AS compliance_flags FROM #detokenized# d""")
def response_project(inp: Inputs):
    return detokenized(inp).select(
        F.concat(F.lit("ev"), F.col("request_id")).alias("audit_event_id"), F.col("restored").alias("response"),
        (F.col("n") > 0).alias("pii_detected"), F.col("n").alias("pii_token_count"),
        F.array_join("unresolved", ",").alias("unresolved_pii_tokens"),
        F.array_join(tokens.compliance_flags(F.col("unresolved")), ",").alias("compliance_flags"),
    )


# a store that keeps two of the eight digits, so that tokens collide
fragment("short_puts", "SELECT concat(substr(token, 1, 13), '000000>') AS token, value FROM #token_map# m")


@query("token_collisions", "SELECT token, count(DISTINCT value) AS n_values FROM #short_puts# p GROUP BY token HAVING count(DISTINCT value) > 1")
def token_collisions(inp: Inputs):
    found = redaction.detect(inp.prompts(), "prompt", "request_id")
    puts = tokens.puts_of(entities_of(found), "session_id", "created_at")
    return tokens.collisions(puts.withColumn("token", F.concat(F.substring("token", 1, 13), F.lit("000000>"))))


# every token is put a second time a day later with another value; readers without a time see the later one
fragment("reissued", f"""SELECT request_id, user_role, n, CASE WHEN {_ADMIN} THEN string_split_regex(response, '<PII_TOKEN_[0-9A-F]{{8}}>') END AS gaps,
  regexp_extract_all(response, '<PII_TOKEN_[0-9A-F]{{8}}>') AS t, response FROM #responses# r""")


@query("detokenize_reissued", """SELECT request_id, user_role, CASE WHEN gaps IS NULL THEN response ELSE
  array_to_string(list_transform(range(1, len(gaps) + 1), lambda i: concat(gaps[i], CASE WHEN i > len(t) THEN '' WHEN t[i] = '<PII_TOKEN_DEADBEEF>' THEN t[i] ELSE concat('again ', t[i]) END)), '') END AS restored FROM #reissued# r""")
def detokenize_reissued(inp: Inputs):
    stored = redacted(inp)
    first = map_of(stored)
    day = F.expr("INTERVAL 1 DAY")
    again = first.withColumns({"value": F.concat(F.lit("again "), "token"), "created_at": F.col("created_at") + day, "expires_at": F.col("expires_at") + day})
    out = tokens.detokenize(responses_of(stored), first.unionByName(again), "request_id", "response", "user_role")
    return out.select("request_id", "user_role", "restored")
