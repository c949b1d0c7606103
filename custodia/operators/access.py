"""Role based access: claims, route decisions, capability and scope checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.sources import dims


def bearer_token(header: Column) -> Column:
    """Text after the exact prefix ``Bearer ``; NULL for any other header."""
    return F.when(header.startswith("Bearer "), F.substr(header, F.lit(len("Bearer ") + 1)))


def project_claims(claims: DataFrame, header_role: str, role: str, subject: str, session: str) -> DataFrame:
    """Role from the first non-empty claim; user and session default to empty text."""
    picked = F.when(F.coalesce(F.col(header_role), F.lit("")) != "", F.col(header_role)).otherwise(F.col(role))
    return claims.withColumns(
        {
            "user_role": picked,
            "user_id": F.coalesce(F.col(subject).cast("string"), F.lit("")),
            "session_id": F.coalesce(F.col(session), F.lit("")),
        }
    )


def valid_role(role: Column) -> Column:
    return F.coalesce(role.isin(*dims.VALID_ROLES), F.lit(False))


def decide(log: DataFrame, route_roles: DataFrame, path: str, header: str, token_valid: Column, role: str) -> DataFrame:
    """HTTP status and reason per request, checks in the order a gateway runs them.

    A route that ``route_roles`` names is open to its roles only. Whatever is unknown (token state, role, path) is refused.
    """
    gated = route_roles.select(F.col("route").alias("__gate")).distinct()
    allowed = route_roles.select(F.col("route").alias("__route"), F.col("role").alias("__role")).distinct()
    j = log.join(gated, F.col(path) == F.col("__gate"), "left")
    j = j.join(allowed, (F.col(path) == F.col("__route")) & (F.col(role) == F.col("__role")), "left")

    def outcome(status: int, reason: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))

    step = (
        F.when(F.col(path).isin(*dims.EXEMPT_PATHS), outcome(200, "exempt"))
        .when(bearer_token(F.col(header)).isNull(), outcome(401, "missing token"))
        .when(~F.coalesce(token_valid, F.lit(False)), outcome(401, "invalid token"))
        .when(~valid_role(F.col(role)), outcome(403, "unknown role"))
        .when(F.col(path).isNull(), outcome(403, "no path"))
        .when(F.col("__gate").isNull(), outcome(404, "unknown path"))
        .when(F.col("__route").isNull(), outcome(403, "role not allowed"))
        .otherwise(outcome(200, "ok"))
    )
    return j.withColumn("__d", step).select(*[log[c] for c in log.columns], F.col("__d.status").alias("status"), F.col("__d.reason").alias("reason"))


def require_role(log: DataFrame, route_roles: DataFrame, path: str, role: str) -> DataFrame:
    """Requests whose role the route admits."""
    r = route_roles.select(F.col("route").alias(path), F.col("role").alias(role))
    return log.join(r, [path, role], "left_semi")


def with_grants(df: DataFrame, permissions: DataFrame, role: str, capabilities: list[str]) -> DataFrame:
    """One column per capability with the grant of the row's role (``no`` if unknown)."""
    picked = [F.max(F.when(F.col("capability") == c, F.col("access"))).alias(c) for c in capabilities]
    per_role = permissions.groupBy(F.col("role").alias(role)).agg(*picked)
    joined = df.join(per_role, role, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("no")) for c in capabilities})


def listed(text: Column) -> Column:
    """Comma separated text as an array without empty items."""
    return F.filter(F.split(text, ","), lambda x: x != "")


def _no_items() -> Column:
    return F.expr("cast(array() as array<string>)")


def outside_datasets(role: Column, dataset: Column, approved: Column) -> Column:
    """Analysts may only use datasets approved for their session. A missing list approves nothing, a missing role is held to the rule."""
    listed_ = F.coalesce(F.array_contains(F.coalesce(approved, _no_items()), dataset), F.lit(False))
    return F.coalesce(role == "ANALYST", F.lit(True)) & ~listed_


def outside_tools(role: Column, calls: Column, approved: Column) -> Column:
    """Called tools that are not approved; analysts and callers without a role may call none."""
    asked = F.coalesce(calls, _no_items())
    none = F.coalesce(role == "ANALYST", F.lit(True))
    return F.when(none, F.array_distinct(asked)).otherwise(F.array_except(asked, F.coalesce(approved, _no_items())))


def with_template(df: DataFrame, templates: DataFrame, role: str) -> DataFrame:
    """Attach the role's template; a role without one fails the query."""
    own = templates.select(F.col("role").alias("__role"), "template")
    unknown = F.raise_error(F.concat(F.lit("Unknown role: "), F.coalesce(F.col(role), F.lit("none"))))
    joined = df.join(own, F.col(role) == F.col("__role"), "left")
    return joined.withColumn("template", F.coalesce("template", unknown)).drop("__role")


_PLACE = r"\{approved_(?:datasets|tools)\}"


def render_prompt(template: Column, datasets: Column, tools: Column) -> Column:
    """Fill the template's lists, each place once; an empty list reads ``(none)``. What is filled in is not looked at again."""

    def listing(items: Column) -> Column:
        return F.when(F.size(F.coalesce(items, _no_items())) > 0, F.array_join(items, ", ")).otherwise("(none)")

    gaps = F.split(template, _PLACE, -1)
    fill = F.transform(F.regexp_extract_all(template, F.lit(_PLACE), F.lit(0)), lambda p: F.when(p == "{approved_datasets}", listing(datasets)).otherwise(listing(tools)))
    return F.array_join(F.zip_with(gaps, fill, lambda g, f: F.concat(g, F.coalesce(f, F.lit("")))), "")


def role_rollup(counts: DataFrame, role: str, n: str) -> DataFrame:
    """Sum of ``n`` over each role and all roles below it in the hierarchy."""
    spark = counts.sparkSession
    closure = F.broadcast(spark.sql(f"""
        WITH RECURSIVE below(ancestor, role) AS (
          SELECT role, role FROM (SELECT parent AS role FROM {dims.values_sql('role_edges')} UNION SELECT child FROM {dims.values_sql('role_edges')})
          UNION ALL
          SELECT b.ancestor, e.child FROM below b JOIN {dims.values_sql('role_edges')} e ON e.parent = b.role)
        SELECT * FROM below"""))
    per_role = counts.groupBy(F.col(role).alias("role")).agg(F.sum(n).alias("__n"))
    return closure.join(per_role, "role", "left").groupBy("ancestor").agg(
        F.count("*").alias("n_roles"), F.coalesce(F.sum("__n"), F.lit(0)).alias(n)
    )
