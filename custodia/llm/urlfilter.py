"""URL filters: all glob rules run at once over each canonical URL as a bit-parallel automaton.

A rule is a host and a path prefix; it fits that host and its subdomains. A glob is matched
anywhere it says, with ``*`` for any run and ``?`` for one byte. Rules and globs become patterns
over the canonical form ``.host`` + separator + ``path``, packed bit by bit into 64-bit words
(a pattern may cross words). One Shift-And step per byte position advances every pattern of
every URL of a batch.

Results for odd input: a null URL or one without ``://`` has an empty host and path, fits no rule
and gets the verdict of the globs on the empty form (``allow`` unless a glob matches everything).
Repeated rows are judged one by one; an empty table gives an empty table; columns other than
id and url are not read, so their names cannot clash. Text of any length is scanned whole.
Of rules that fit, the longest (by the rule as written) wins, then ``block`` before ``allow``,
then the earlier one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import ascii_lower, map_arrow

#: Between host and path in the canonical form: a byte that no UTF-8 text holds.
SEPARATOR = 0xFF
ANY, STAR = -1, -2
#: URLs advanced together; bounds the state matrix.
BLOCK = 4096


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule_pattern(rule: Rule) -> list[int]:
    """``*.host`` + separator + ``path*``: the dot makes subdomains fit and nothing else."""
    return [STAR, *f".{rule.host.lower()}".encode(), SEPARATOR, *rule.path.encode(), STAR]


def glob_pattern(glob: str) -> list[int]:
    """A glob over host and path; ``/`` right after the host part needs no separator sign."""
    out: list[int] = []
    for ch in glob:
        out += [STAR] if ch == "*" else [ANY] if ch == "?" else list(ch.encode())
    return out


class Automaton:
    """Patterns packed into masks of 64-bit words.

    State i of a pattern says that its first i symbols are matched; a ``*`` is no symbol but
    lets the state before it stay on any byte.
    """

    def __init__(self, patterns: list[list[int]]):
        bits = sum(1 + sum(s != STAR for s in p) for p in patterns)
        words = max(1, -(-bits // 64))
        self.words = words
        self.start = np.zeros(words, np.uint64)
        self.stay = np.zeros(words, np.uint64)
        self.enter = np.zeros((256, words), np.uint64)
        self.final: list[tuple[int, np.uint64]] = []
        at = 0

        def put(mask: np.ndarray, bit: int) -> None:
            mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)

        for pattern in patterns:
            put(self.start, at)
            for symbol in pattern:
                if symbol == STAR:
                    put(self.stay, at)
                    continue
                at += 1
                for byte in range(256) if symbol == ANY else (symbol,):
                    put(self.enter[byte], at)
            self.final.append((at // 64, np.uint64(1) << np.uint64(at % 64)))
            at += 1

    def run(self, urls: list[bytes]) -> np.ndarray:
        """matched[url, pattern]. Longer URLs stay active longer; finished ones are not touched."""
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")
        buffer = np.frombuffer(b"".join(urls) + b"\0", np.uint8)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])) if len(urls) else lengths
        state = np.tile(self.start, (len(urls), 1))
        sorted_lengths, sorted_starts = lengths[order], starts[order]
        for i in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(-sorted_lengths, -i, side="left"))
            now = state[:active]
            moved = now << np.uint64(1)
            if self.words > 1:
                moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.enter[buffer[sorted_starts[:active] + i]]) | (now & self.stay)
        out = np.empty((len(urls), len(self.final)), bool)
        for p, (word, mask) in enumerate(self.final):
            out[order, p] = (state[:, word] & mask) != 0
        return out


def split_url(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """id, host and path by the rules of the module."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return pages.select(F.col(id_col), rest.alias("__rest")).select(
        id_col,
        ascii_lower(F.regexp_extract("__rest", r"^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("__rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
    )


def judge(pages: DataFrame, rules: list[Rule], globs: list[str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, the winning rule (or null), matched glob (or null) and verdict.

    Without a fitting rule the verdict is ``block`` if a glob matches, else ``allow``. Globs see
    host and path as one text.
    """
    split = split_url(pages, id_col, url_col)
    id_type = split.schema[0].dataType
    ranked = sorted(range(len(rules)), key=lambda i: (-len(rules[i].text), rules[i].verdict != "block", i))
    ordered = [rules[i] for i in ranked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rule = Automaton([rule_pattern(r) for r in ordered])
        by_glob = Automaton([glob_pattern(g) for g in globs])
        sep = bytes([SEPARATOR])
        for whole in batches:
            for begin in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(begin, BLOCK)
                hosts = [h.encode("utf-8", "surrogatepass") for h in batch.column(1).to_pylist()]
                paths = [p.encode("utf-8", "surrogatepass") for p in batch.column(2).to_pylist()]
                fits = by_rule.run([b"." + h + sep + p for h, p in zip(hosts, paths)])
                found = by_glob.run([h + p for h, p in zip(hosts, paths)])
                rule, glob, verdict = [], [], []
                for f, g in zip(fits, found):
                    best = ordered[int(f.argmax())] if f.any() else None
                    hit = globs[int(g.argmax())] if g.any() else None
                    rule.append(best.text if best else None)
                    glob.append(hit)
                    verdict.append(best.verdict if best else "block" if hit else "allow")
                columns = [*batch.columns, pa.array(rule, pa.string()), pa.array(glob, pa.string()), pa.array(verdict, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "host", "path", "rule", "glob", "verdict"])

    schema = f"`{id_col}` {id_type.simpleString()}, host string, path string, rule string, glob string, verdict string"
    return map_arrow(split, run, schema)
