"""Roles, routes, prompts: the rules of the gateway restated on small tables."""

import pytest
from pyspark.sql import functions as F

from custodia.operators import access
from custodia.sources import dims


def test_bearer(spark):
    df = spark.createDataFrame([("Bearer mytoken123",), (None,), ("Basic dXNlcjpwYXNz",), ("bearer x",), ("Bearer ",)], "h string")
    assert [r[0] for r in df.select(access.bearer_token(F.col("h"))).collect()] == ["mytoken123", None, None, None, ""]


def test_claims(spark):
    df = spark.createDataFrame([("ANALYST", "VIEWER", "u", "s"), ("", "VIEWER", None, None), (None, None, "u", "")], "a string, b string, sub string, sid string")
    got = [(r["user_role"], r["user_id"], r["session_id"]) for r in access.project_claims(df, "a", "b", "sub", "sid").collect()]
    assert got == [("ANALYST", "u", "s"), ("VIEWER", "", ""), (None, "u", "")]


def test_decisions(spark):
    rows = [
        ("/health", None, False, None, 200), ("/v1/prompt", None, True, "ANALYST", 401), ("/v1/prompt", "Basic x", True, "ANALYST", 401),
        ("/v1/prompt", "Bearer x", False, "ANALYST", 401), ("/v1/prompt", "Bearer x", True, "HACKER", 403), ("/v1/prompt", "Bearer x", True, None, 403),
        ("/v1/prompt", "Bearer x", True, "VIEWER", 403), ("/v1/prompt", "Bearer x", True, "ANALYST", 200), ("/v1/audit", "Bearer x", True, "DEVELOPER", 403),
        ("/v1/audit", "Bearer x", True, "PLATFORM_ADMIN", 200), ("/other", "Bearer x", True, "VIEWER", 404),  # a path that is no route is refused
    ]
    df = spark.createDataFrame(rows, "path string, h string, ok boolean, role string, want int")
    out = access.decide(df, dims.dim(spark, "route_roles"), "path", "h", F.col("ok"), "role").collect()
    assert [(r["path"], r["role"], r["status"]) for r in out] == [(r["path"], r["role"], r["want"]) for r in out]


@pytest.mark.parametrize("role", dims.VALID_ROLES)
def test_prompt_of_every_role(spark, role):
    df = spark.createDataFrame([(role, ["ds_financials"], ["search_tool"]), (role, [], [])], "role string, ds array<string>, tools array<string>")
    j = access.with_template(df, dims.dim(spark, "role_templates"), "role")
    full, empty = [r[0] for r in j.select(access.render_prompt(F.col("template"), F.col("ds"), F.col("tools"))).collect()]
    assert role in full and "{" not in full
    if role == "ANALYST":
        assert "ds_financials" in full and "(none)" in empty and "SUPER_ADMIN" not in full
    if role == "DEVELOPER":
        assert "search_tool" in full and "(none)" in empty


@pytest.mark.parametrize("role", ["HACKER", None])
def test_unknown_role_raises(spark, role):
    bad = access.with_template(spark.createDataFrame([(role,)], "role string"), dims.dim(spark, "role_templates"), "role")
    with pytest.raises(Exception, match="Unknown role"):
        bad.collect()


def test_filled_in_text_is_not_filled_again(spark):
    df = spark.createDataFrame([("a {approved_datasets} b {approved_tools}", ["{approved_tools}"], None)], "t string, d array<string>, x array<string>")
    assert df.select(access.render_prompt(F.col("t"), F.col("d"), F.col("x"))).first()[0] == "a {approved_tools} b (none)"


def test_unknown_is_refused(spark):
    routes = spark.createDataFrame([("/v2/new", "SUPER_ADMIN")], "route string, role string")
    rows = [("/v2/new", "Bearer x", None, "SUPER_ADMIN", 401), ("/v2/new", "Bearer x", True, "VIEWER", 403), ("/v2/new", "Bearer x", True, "SUPER_ADMIN", 200), (None, "Bearer x", True, "SUPER_ADMIN", 403)]
    df = spark.createDataFrame(rows, "path string, h string, ok boolean, role string, want int")
    out = access.decide(df, routes, "path", "h", F.col("ok"), "role").collect()
    assert all(r["status"] == r["want"] for r in out) and len(out) == 4
    df = spark.createDataFrame([("ANALYST", "d", None, None, None), (None, "d", ["d"], ["t"], ["t"]), ("ANALYST", "d", None, ["t"], None), ("DEVELOPER", None, None, ["t"], None)], "role string, d string, ad array<string>, calls array<string>, at array<string>")
    got = df.select(access.outside_datasets(F.col("role"), F.col("d"), F.col("ad")), access.outside_tools(F.col("role"), F.col("calls"), F.col("at"))).collect()
    assert [tuple(r) for r in got] == [(True, []), (False, ["t"]), (True, ["t"]), (False, ["t"])]


def test_scopes(spark):
    df = spark.createDataFrame(
        [("ANALYST", "d1", ["d1"], ["t"], ["t"]), ("ANALYST", "d2", ["d1"], [], ["t"]), ("DEVELOPER", "d2", ["d1"], ["t", "x"], ["t"])],
        "role string, d string, ad array<string>, calls array<string>, at array<string>",
    )
    got = df.select(access.outside_datasets(F.col("role"), F.col("d"), F.col("ad")), access.outside_tools(F.col("role"), F.col("calls"), F.col("at"))).collect()
    assert [tuple(r) for r in got] == [(False, ["t"]), (True, []), (False, ["x"])]


def test_role_rollup(spark):
    counts = spark.createDataFrame([("VIEWER", 1), ("ANALYST", 10), ("PLATFORM_ADMIN", 100)], "role string, n int")
    got = {r["ancestor"]: r["n"] for r in access.role_rollup(counts, "role", "n").collect()}
    assert got == {"SUPER_ADMIN": 111, "PLATFORM_ADMIN": 111, "ANALYST": 10, "DEVELOPER": 0, "VIEWER": 1}
