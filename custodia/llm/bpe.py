"""Byte-level BPE: encoding and decoding as DuckDB queries inside each partition.

Texts are cut into words by the split pattern. The distinct words of a block become rows of (word, position,
token), one row per byte; a recursive query joins neighbouring tokens with the merge table, contracts each word's
leftmost pair of least rank and goes on until no pair can merge. The ids are put together per document, and the lists that are
given out are decoded by an ordered aggregation of their tokens' bytes.

The merge table holds, for every token, all its cuts into two tokens, so a pair merges exactly if its bytes are a token. A word
that is a token itself is that token, as the reference tokenizer library does it. Words of more than ``LONG`` bytes use a second recursive
query that contracts all occurrences of the least pair at once, where no merge with the new token can rank lower; there
the result is the same and long runs take few steps. The recursion is restarted every few steps, so its
intermediate rows stay bounded whatever the length of a word.

A worker keeps words it has encoded, up to a bound. Results for odd input: null text is the empty text: no tokens, empty bytes. Repeated
rows are encoded one by one, empty tables give empty tables, extra columns are not read. ``decode`` refuses ids that the
vocabulary lacks, takes null ids lists as empty.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from custodia.llm import common
from custodia.llm.common import map_arrow

_SPLIT = regex.compile(public_tokenizers.PATTERN)
#: A space at an end of the text or next to other white space.
_LOOSE = re.compile(r"(?:\A|\s) | (?:\s|\Z)")
_RARE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_RARE_WIDE = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters of text handled together, bytes of words per query, rows that one recursion may leave behind.
BLOCK_CHARS, QUERY_BYTES, STEP_ROWS = 2_000_000, 300_000, 4_000_000
#: Characters of joined ids that are decoded together.
DECODE_CHARS = 1_000_000
LONG = 64
#: Entries of a worker's memory of words before its older half is forgotten, by default.
MEMORY = 350_000

# one pair per word and step; q is the position of the word's next token, or -1
_FIRST = """
WITH RECURSIVE s(w, p, q, t, i, fixed) AS (
  SELECT w, p, q, t, 0, FALSE FROM state
  UNION ALL
  (WITH live AS MATERIALIZED (SELECT * FROM s WHERE NOT fixed AND i < $steps),
  pairs AS MATERIALIZED (
    SELECT a.w, a.p, b.p AS gone, b.q, m.rank, (m.rank::BIGINT << 32) | a.p AS o
    FROM live a JOIN live b ON a.q = b.p JOIN merges m ON m.pair = (a.t::BIGINT << 32 | b.t)),
  best AS MATERIALIZED (
    SELECT w, arg_min(p, o) AS p, arg_min(gone, o) AS gone, arg_min(q, o) AS q, min(rank) AS rank FROM pairs GROUP BY w)
  SELECT a.w, a.p, CASE WHEN a.p = b.p THEN b.q ELSE a.q END, CASE WHEN a.p = b.p THEN b.rank ELSE a.t END, a.i + 1, b.w IS NULL
  FROM live a LEFT JOIN best b ON a.w = b.w WHERE b.w IS NULL OR a.p <> b.gone)
)
SELECT w, p, q, t, fixed FROM s WHERE fixed OR i = $steps
"""

# all occurrences of the least pair, from the left without overlap, where the new token cannot merge lower
_EVERY = """
WITH RECURSIVE s(w, p, t, i) AS (
  SELECT w, p, t, 0 FROM state
  UNION ALL
  SELECT w, p, CASE WHEN chosen THEN rank ELSE t END, i + 1
  FROM (SELECT *, coalesce(lag(chosen) OVER (PARTITION BY w ORDER BY p), FALSE) AS gone FROM (
    SELECT *, hit AND (p = first OR safe AND row_number() OVER (PARTITION BY w, hit, island ORDER BY p) % 2 = 1) AS chosen FROM (
      SELECT *, row_number() OVER (PARTITION BY w ORDER BY p) - row_number() OVER (PARTITION BY w, hit ORDER BY p) AS island,
             min(CASE WHEN hit THEN p END) OVER (PARTITION BY w) AS first FROM (
        SELECT *, coalesce(rank = best, FALSE) AS hit FROM (
          SELECT n.*, m.rank, m.safe, min(m.rank) OVER (PARTITION BY n.w) AS best
          FROM (SELECT *, lead(t) OVER (PARTITION BY w ORDER BY p) AS nx FROM s WHERE i < $steps) n
          LEFT JOIN merges m ON m.pair = (n.t::BIGINT << 32 | n.nx))
        WHERE best IS NOT NULL))))
  WHERE NOT gone
)
SELECT w, p, q, t, i < $steps AS fixed FROM (SELECT *, p AS q, max(i) OVER (PARTITION BY w) AS last FROM s) WHERE i = last
"""

_RESULT = """
SELECT w, string_agg(text, ',' ORDER BY p)::BLOB AS ids FROM done JOIN vocabulary ON id = t GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT w, string_agg(v.chars, '' ORDER BY p) AS chars, count(*) - count(v.id) AS unknown
FROM tokens LEFT JOIN vocabulary v ON v.id = t GROUP BY w ORDER BY w
"""


def loose(text: str) -> bool:
    """Does ``_LOOSE`` match? Searches for single characters come first, being much faster."""
    if any(map(text.__contains__, _RARE)) or not text.isascii() and any(map(text.__contains__, _RARE_WIDE)):
        return _LOOSE.search(text) is not None
    return text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text


class Memory:
    """Text -> ids in two generations; what the younger one lacks comes back from the older one or is computed."""

    def __init__(self, entries: int):
        self.entries = entries
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self.new) > self.entries:
            self.new, self.old = {}, self.new

    def missing(self, wanted: set[str]) -> list[str]:
        fresh = wanted.difference(self.new)
        known = {x: self.old[x] for x in fresh if x in self.old}
        self.new.update(known)
        return list(fresh.difference(known))


class Tokenizer:
    """The vocabulary of a rank file in a DuckDB database of this worker."""

    def __init__(self, path: str, memory: int = MEMORY):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        left, right, rank = [], [], []
        for token, r in self.ranks.items():
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        left, right, rank = (np.array(x, np.int64) for x in (left, right, rank))
        # least rank that a merge with a token can have; below the token's own rank it is not safe
        least = np.full(max(self.ranks.values()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, left, rank)
        np.minimum.at(least, right, rank)
        merges = pa.table({"pair": left << 32 | right, "rank": rank.astype(np.int32), "safe": least[rank] > rank})  # noqa: F841
        vocabulary = pa.table({"id": pa.array(self.ranks.values(), pa.int32()), "text": list(map(str, self.ranks.values())), "chars": [t.decode("latin-1") for t in self.ranks]})  # noqa: F841
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "200MB", "temp_directory": ""})
        self.db.register("new_merges", merges)
        self.db.register("new_vocabulary", vocabulary)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM new_merges")
        self.db.execute("CREATE TABLE vocabulary AS SELECT * FROM new_vocabulary")
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.words, self.plain, self.spaced = Memory(memory), Memory(memory), Memory(memory)

    def _query(self, sql: str, **tables: pa.Table) -> pa.Table:
        for name, data in tables.items():
            self.db.register(name, data)
        return self.db.sql(sql).to_arrow_table()

    def contract(self, words: list[bytes]) -> pa.Table:
        """Rows (w, p, t): the tokens of each word; p is a position in all words, one after another."""
        n = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(n) - n
        flat = np.frombuffer(b"".join(words), np.uint8)
        p = np.arange(len(flat), dtype=np.int32)
        q = p + np.int32(1)
        q[(start + n - 1)[n > 0]] = -1
        state = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), n), "p": p, "q": q, "t": self.bytes[flat]})
        whole = [self.ranks.get(x) for x in words]
        at_once = np.array([x is not None for x in whole])
        done = [pa.table({"w": np.flatnonzero(at_once).astype(np.int32), "p": np.zeros(at_once.sum(), np.int32), "t": np.array([x for x in whole if x is not None], np.int32)})]
        state = state.filter(pa.array(~at_once[state["w"].to_numpy()]))
        sql = _EVERY if len(n) and n.max() > LONG else _FIRST
        while state.num_rows:
            steps = int(np.clip(STEP_ROWS // state.num_rows, 4, 1000))
            out = self._query(sql.replace("$steps", str(steps)), state=state)
            fixed, rows = out["fixed"], out.drop_columns("fixed").cast(state.schema)
            done.append(rows.filter(fixed).drop_columns("q"))
            state = rows.filter(pc.invert(fixed))
        return pa.concat_tables(done)

    def learn(self, words: list[str]) -> None:
        """Encode words that are not remembered."""
        encoded = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
        for part in (np.flatnonzero(sizes <= LONG), np.flatnonzero(sizes > LONG)):
            cuts = np.cumsum(sizes[part]) // QUERY_BYTES
            for own in np.split(part, np.flatnonzero(np.diff(cuts)) + 1) if len(part) else []:
                own = own.tolist()
                out = self._query(_RESULT, done=self.contract([encoded[i] for i in own]))
                self.words.new.update(zip([words[i] for i in own], out["ids"].to_pylist()))

    def remember(self, chunks: list[str], lead: str, known: Memory) -> None:
        # ASCII letters are one word, with or without a space before them
        whole = [c for c in chunks if c.isalpha() and c.isascii()]
        names = [lead + c for c in whole]
        others = [c for c in chunks if not (c.isalpha() and c.isascii())]
        split = [_SPLIT.findall(lead + c) for c in others]
        self.learn(self.words.missing(set(names).union(*split)))
        words, new = self.words.new, known.new
        new.update(zip(whole, map(words.__getitem__, names)))
        for chunk, pieces in zip(others, split):
            new[chunk] = words[pieces[0]] if len(pieces) == 1 else b",".join([words[w] for w in pieces])

    def run(self, texts: list[str | None]) -> Iterator[tuple[list[str], list[bytes]]]:
        """Ids as text and the bytes decoded from them, of each text, block by block.

        No word goes across a single space between other characters, so such texts are cut there first
        and repeated chunks need no second split.
        """
        at = 0
        while at < len(texts):
            block, size = [], 0
            while at < len(texts) and size < BLOCK_CHARS:
                text = texts[at] or ""
                size += len(text)
                at += 1
                if not text or loose(text):
                    block.append((_SPLIT.findall(text), []))
                else:
                    first, *rest = text.split(" ")
                    block.append(([first], rest))
            for memory in (self.words, self.plain, self.spaced):
                memory.age()
            self.remember(self.plain.missing(set().union(*[x for x, _ in block])), "", self.plain)
            self.remember(self.spaced.missing(set().union(*[x for _, x in block])), " ", self.spaced)
            plain, spaced = self.plain.new.__getitem__, self.spaced.new.__getitem__
            ids = [b",".join([*map(plain, a), *map(spaced, b)]).decode() for a, b in block]
            yield ids, self.decode_joined(ids)

    def decode_joined(self, lists: list[str]) -> list[bytes]:
        """Bytes of the ids that are given out, at most about ``DECODE_CHARS`` of them in a query."""
        out, cuts = [], np.cumsum([len(x) for x in lists]) // DECODE_CHARS
        for part in np.split(np.arange(len(lists)), np.flatnonzero(np.diff(cuts)) + 1):
            some = [lists[i] for i in part]
            n = np.array([x.count(",") + 1 if x else 0 for x in some])
            out += self._bytes(n, np.fromstring(",".join(filter(None, some)), np.int64, sep=","))
        return out

    def decode(self, lists: list[list[int] | None]) -> list[bytes]:
        n = np.array([len(x or ()) for x in lists])
        return self._bytes(n, np.fromiter((i for x in lists for i in x or ()), np.int64, int(n.sum())))

    def _bytes(self, n: np.ndarray, ids: np.ndarray) -> list[bytes]:
        """The ordered aggregation: bytes of lists of ``n`` ids, with one character for a byte inside the query."""
        narrow = np.int32 if len(ids) < 2**31 else np.int64
        tokens = pa.table({"w": np.repeat(np.arange(len(n), dtype=narrow), n), "p": np.arange(len(ids), dtype=narrow), "t": ids})
        out, data = self._query(_DECODE, tokens=tokens), [b""] * len(n)
        for w, text, unknown in zip(*(out[c].to_pylist() for c in ("w", "chars", "unknown"))):
            if unknown:
                raise ValueError(f"{unknown} ids are not in the vocabulary")
            data[w] = text.encode("latin-1")
        return data


@functools.cache
def tokenizer(path: str, memory: int = MEMORY) -> Tokenizer:
    return Tokenizer(path, memory)


def release() -> None:
    """Give back what this worker holds of vocabularies and words."""
    tokenizer.cache_clear()


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", memory: int = MEMORY) -> DataFrame:
    """Per row: id, n_tokens, ids (decimal, joined by commas) and the bytes decoded from them.

    ``memory`` trades a worker's memory (about 0.5 KB an entry) for encoding words again; results do not depend on it.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, memory)
        common.on_leave(release)
        for batch in batches:
            at = 0
            for ids, data in own.run(batch.column(1).to_pylist()):
                n = pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), n, pa.array(ids, pa.string()), pa.array(data, pa.binary())], [id_col, "n_tokens", "ids", "decoded"])
                at += len(ids)

    return map_arrow(docs.select(id_col, text_col), run, f"`{id_col}` {id_type}, n_tokens long, ids string, decoded binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the bytes of an array of ids."""
    id_type = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.decode(part.column(1).to_pylist()), pa.binary())], [id_col, "decoded"])

    return map_arrow(encoded.select(id_col, ids_col), run, f"`{id_col}` {id_type}, decoded binary")
