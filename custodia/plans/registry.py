"""Registered queries: name -> (job on the test tables, equivalent SQL)."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from custodia.sources import dims, views

Job = Callable[["Inputs"], DataFrame]


@dataclass(frozen=True)
class Inputs:
    """Access to the test tables and the views over them."""

    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return views.table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        return views.view(self.spark, self.sf_dir, name)

    def prompts(self) -> DataFrame:
        return views.spread(self.view("prompts"))

    def texts(self, name: str) -> DataFrame:
        """A table whose texts are about to be scanned."""
        return views.spread(self.table(name))

    def stream_view(self, name: str) -> DataFrame:
        return views.stream_view(self.spark, self.sf_dir, name)

    def dim(self, name: str) -> DataFrame:
        return dims.dim(self.spark, name)


QUERIES: dict[str, Job] = {}
ORACLES: dict[str, str] = {}
FRAGMENTS: dict[str, str] = {}


def fragment(name: str, text: str) -> None:
    """Named sub-query for oracle texts, used as ``#name#``."""
    if name in FRAGMENTS or name in views.VIEWS:
        raise ValueError(f"fragment {name!r} is defined twice")
    FRAGMENTS[name] = text


def expand(text: str) -> str:
    """``#view#`` and ``#fragment#`` become sub-queries, ``%dim%`` a VALUES list."""

    def sub(m: re.Match) -> str:
        name = m.group(1)
        if name.startswith("q_"):  # the text of another query
            return f"({expand(ORACLES[name[2:]])})"
        if name in FRAGMENTS:
            return f"({expand(FRAGMENTS[name])})"
        return f"({views.view_sql(name)})"

    text = re.sub(r"#(\w+)#", sub, text)
    return re.sub(r"%(\w+)%", lambda m: dims.values_sql(m.group(1), duck=True), text)


def query(name: str, sql: str | None = None):
    def register(job: Job) -> Job:
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return register
