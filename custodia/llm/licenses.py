"""License scan: ordered signature rules behind a keyword filter, overlaps resolved by priority and containment.

A text becomes its words (A-Z lowered, signs dropped) with single spaces between them. One pass of an Aho-Corasick automaton over it
finds which keywords occur; only the rules behind them run their expressions, over the whole text, from word to word. Detections are then
resolved in the order of the rules' kinds: one that lies within a detection of a stronger kind, or within a longer
one of its own kind, is suppressed (the earlier rule wins an exact tie); partial overlaps both stay. Base phrases are rules of a kind of
their own: all their places are reported, and their labels stay whether or not they are suppressed.

Odd inputs: a null or empty text has no words and no detections, its score is 0; repeated rows and null ids give a row each; an empty
table gives an empty result. Only the id and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from custodia.llm import license_rules
from custodia.llm.common import map_arrow, texts

#: Bytes of words: ASCII letters and digits, and every byte of a letter beyond ASCII; A-Z are lowered, all others become spaces.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_DETECTION = pa.struct(
    [("label", pa.string()), ("kind", pa.string()), ("rule", pa.int32()), ("first", pa.int64()), ("words", pa.int64()), ("kept", pa.bool_())]
)
DETECTIONS = "array<struct<label:string,kind:string,rule:int,first:bigint,words:bigint,kept:boolean>>"


@dataclass(frozen=True)
class Rule:
    label: str
    kind: str
    keyword: str
    expression: str


def table_of(text: str = license_rules.RULES, base: dict[str, str] = license_rules.BASE) -> list[Rule]:
    """The rules in their order, base phrases last."""
    rules = []
    for line in text.splitlines():
        if line.strip() and not line.startswith("#"):
            label, kind, keyword, expression = (part.strip() for part in line.split(" | "))
            rules.append(Rule(label, kind, keyword, expression))
    return rules + [Rule(label, "base", phrase, re.escape(phrase)) for phrase, label in base.items()]


def words_of(text: str | None) -> tuple[str, int]:
    """Words with single spaces, one character per byte, and their number."""
    if not text:
        return "", 0
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return b" ".join(words).decode("latin-1"), len(words)


@dataclass(slots=True)
class Hit:
    rule: int
    start: int  # characters
    end: int
    priority: int
    kept: bool = True


def suppress(hits: list[Hit]) -> None:
    """Unset ``kept`` of hits that lie within a stronger one, or within a longer one of equal priority."""
    starts: list[int] = []  # of all hits kept so far, ascending, with the furthest end up to each
    ends: list[int] = []
    kept: list[tuple[int, int]] = []
    for priority in sorted({h.priority for h in hits}):
        far = -1
        for h in sorted((h for h in hits if h.priority == priority), key=lambda h: (h.start, -h.end, h.rule)):
            i = bisect_right(starts, h.start)
            h.kept = far < h.end and not (i and ends[i - 1] >= h.end)
            if h.kept:
                far = max(far, h.end)
                kept.append((h.start, h.end))
        kept.sort()
        starts, ends, far = [], [], -1
        for start, end in kept:
            far = max(far, end)
            starts.append(start)
            ends.append(far)


class Scanner:
    """Compiled rules and the automaton over their keywords."""

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        order = list(license_rules.KINDS)
        self.priority = [order.index(r.kind) for r in rules]
        self.patterns = [re.compile(rf"(?<![^ ])(?:{r.expression})(?![^ ])") for r in rules]
        self.keywords = ahocorasick.Automaton()
        behind: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            behind.setdefault(r.keyword, []).append(i)
        for keyword, ids in behind.items():
            self.keywords.add_word(keyword, ids)
        if behind:
            self.keywords.make_automaton()

    def candidates(self, words: str) -> list[int]:
        """Rules whose keyword occurs, in their order."""
        if not self.rules:
            return []
        return sorted({i for ids in {id(v): v for _, v in self.keywords.iter(words)}.values() for i in ids})

    def hits(self, words: str) -> list[Hit]:
        found = [Hit(i, m.start(), m.end(), self.priority[i]) for i in self.candidates(words) for m in self.patterns[i].finditer(words)]
        suppress(found)
        return found

    def scan(self, text: str | None) -> tuple[int, list[dict]]:
        """Number of words, and the detections by their place."""
        words, n = words_of(text)
        out, at, before = [], 0, 0
        for h in sorted(self.hits(words), key=lambda h: (h.start, h.end, h.rule)):
            before += words.count(" ", at, h.start)
            at = h.start
            rule = self.rules[h.rule]
            out.append({"label": rule.label, "kind": rule.kind, "rule": h.rule, "first": before, "words": words.count(" ", h.start, h.end) + 1, "kept": h.kept})
        return n, out


def detections(df: DataFrame, id_col: str, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """(id, n_words, detections) of every row; a detection has its label, kind, rule number, first word, length in words, and
    whether it was kept."""
    rules = table_of() if rules is None else rules
    rows = df.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = StructType([StructField("id", rows.schema["id"].dataType), *StructType.fromDDL(f"n_words long, detections {DETECTIONS}").fields])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            ((some,),) = texts(iter([batch]), "text")
            done = [scanner.scan(t) for t in some]
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "n_words": pa.array([n for n, _ in done], pa.int64()), "detections": pa.array([d for _, d in done], pa.list_(_DETECTION))}
            )

    return map_arrow(rows, job, schema)


def base_of(found: str | Column) -> Column:
    return F.filter(found, lambda d: d["kind"] == "base")


def names(found: Column) -> Column:
    """Distinct labels, sorted and joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")


def labels(found: str | Column) -> Column:
    """Labels of kept detections and of all base places; hints name no license."""
    return names(F.filter(found, lambda d: (d["kept"] & (d["kind"] != "hint")) | (d["kind"] == "base")))


def score(found: str | Column) -> Column:
    """How sure it is that the text names a license: kept detections are taken as independent signs."""
    sure = F.create_map(*(F.lit(x) for kind in license_rules.KINDS.items() for x in kind))
    missed = F.aggregate(F.filter(found, lambda d: d["kept"]), F.lit(1.0), lambda left, d: left * (1.0 - sure[d["kind"]]))
    return 1.0 - missed
