"""Edit-aware token counts.

A document is kept as its pre-tokens (lengths and token counts) in blocks, with a segment tree over
the blocks that holds sums of characters and tokens. An edit descends the tree to the first pre-token
whose match could have looked at the edited place, splits again from there until a boundary falls
on an old one behind the edit, encodes only those pre-tokens and updates the sums on the way to the
root. The rest of the text is neither split nor encoded again.

The split pattern looks at most two characters past the end of a match and never behind its start.
So a pre-token that ends two characters before an edit is safe, and once a boundary behind the
edit agrees with an old one all later ones do.

Results for odd input: null text is the empty text (no tokens); null or empty edits change nothing; a
start or length outside the text is cut to it; a null insertion is empty. Edits of a document apply in the
order of their list, each to the text that the earlier ones left. Repeated rows are counted one by
one; extra columns are not read.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from custodia.llm.common import Cache, map_arrow

#: Characters past its end that a match of the split pattern may depend on.
LOOK = 2
#: Pre-tokens per block; a block that grows past four times this makes the tree be laid out anew.
BLOCK = 64
_SPLIT = regex.compile(public_tokenizers.PATTERN)


@functools.cache
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def piece_counts(path: str) -> Cache:
    encode = encoding(path).encode_ordinary
    return Cache(lambda piece: len(encode(piece)))


class SegmentTree:
    """Blocks of pre-tokens under sums of (characters, tokens); node 1 is the root."""

    def __init__(self, lengths: np.ndarray, counts: np.ndarray):
        self.layout(lengths, counts)

    def layout(self, lengths: np.ndarray, counts: np.ndarray) -> None:
        n = max(1, -(-len(lengths) // BLOCK))
        self.lengths = [lengths[i * BLOCK : (i + 1) * BLOCK] for i in range(n)]
        self.counts = [counts[i * BLOCK : (i + 1) * BLOCK] for i in range(n)]
        self.leaves = 1 << (n - 1).bit_length()
        self.sums = np.zeros((2 * self.leaves, 2), np.int64)
        self.sums[self.leaves : self.leaves + n] = [(a.sum(), b.sum()) for a, b in zip(self.lengths, self.counts)]
        for i in range(self.leaves - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, at: int) -> tuple[int, int]:
        """Block that holds the character at ``at`` (the last one for the end) and where that block starts."""
        node, start = 1, 0
        while node < self.leaves:
            left = int(self.sums[2 * node, 0])
            if at < start + left or not self.sums[2 * node + 1, 0]:
                node *= 2
            else:
                node, start = 2 * node + 1, start + left
        return node - self.leaves, start

    def put(self, block: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        self.lengths[block], self.counts[block] = lengths, counts
        node = block + self.leaves
        self.sums[node] = (lengths.sum(), counts.sum())
        while node := node // 2:
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, text: str, start: int, deleted: int, inserted: str, count: Cache) -> tuple[str, int]:
        """Apply one edit; the new text and how many characters were encoded again."""
        start = min(max(start, 0), len(text))
        deleted = min(max(deleted, 0), len(text) - start)
        new = text[:start] + inserted + text[start + deleted :]
        shift, done = len(inserted) - deleted, start + len(inserted)
        block, at = self.find(max(0, start - LOOK))
        ends = at + np.cumsum(self.lengths[block])
        first = int(np.searchsorted(ends, start - LOOK, side="right"))  # ends at or before this are safe
        begin = int(ends[first - 1]) if first else at
        last, inside, old_end = block, first, begin
        lengths, counts = [], []
        pos = begin
        synced = pos >= done and old_end + shift == pos and old_end >= start + deleted
        matches = _SPLIT.finditer(new, begin)
        while not synced and pos < len(new):
            piece = next(matches).group()
            pos += len(piece)
            lengths.append(len(piece))
            counts.append(count[piece])
            while old_end + shift < pos or old_end < start + deleted:
                while inside >= len(self.lengths[last]) and last + 1 < len(self.lengths):
                    last, inside = last + 1, 0
                if inside >= len(self.lengths[last]):
                    break
                old_end += int(self.lengths[last][inside])
                inside += 1
            synced = pos >= done and old_end + shift == pos and old_end >= start + deleted
        if pos >= len(new):  # nothing behind: all that was old there is gone
            last, inside = len(self.lengths) - 1, len(self.lengths[-1])
        more = (np.array(lengths, np.int64), np.array(counts, np.int64))
        head = (self.lengths[block][:first], self.counts[block][:first])
        tail = (self.lengths[last][inside:], self.counts[last][inside:])
        whole = [np.concatenate(x) for x in zip(head, more, tail)]
        none = np.zeros(0, np.int64)
        for b in range(block + 1, last + 1):
            if len(self.lengths[b]):
                self.put(b, none, none)
        self.put(block, *whole)
        if len(whole[0]) > 4 * BLOCK:
            self.layout(np.concatenate(self.lengths), np.concatenate(self.counts))
        return new, int(sum(lengths))

    def pack(self) -> bytes:
        """Number of leaves and blocks, block sizes, lengths and counts as int32, then the sums as int64."""
        sizes = [len(x) for x in self.lengths]
        return np.concatenate(([self.leaves, len(sizes)], sizes, *self.lengths, *self.counts)).astype("<i4").tobytes() + self.sums.astype("<i8").tobytes()

    @classmethod
    def unpack(cls, data: bytes) -> SegmentTree:
        tree = cls.__new__(cls)
        tree.leaves, n = np.frombuffer(data, "<i4", 2).tolist()
        sizes = np.frombuffer(data, "<i4", n, 8)
        total, cuts = int(sizes.sum()), np.cumsum(sizes)[:-1]
        flat = np.frombuffer(data, "<i4", 2 * total, 8 + 4 * n).astype(np.int64)
        tree.lengths, tree.counts = np.split(flat[:total], cuts), np.split(flat[total:], cuts)
        tree.sums = np.frombuffer(data, "<i8", -1, 8 + 4 * n + 8 * total).reshape(-1, 2).copy()
        return tree


def tree_of(text: str, count: Cache) -> SegmentTree:
    pieces = _SPLIT.findall(text)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return SegmentTree(lengths, np.fromiter(map(count.__getitem__, pieces), np.int64, len(pieces)))


def build(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``__tree`` (packed) and ``__n_tokens``."""
    schema = StructType([*docs.schema.fields, StructField("__tree", BinaryType()), StructField("__n_tokens", LongType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = piece_counts(tokenizer)
        for batch in batches:
            trees = [tree_of(t or "", count) for t in batch.column(at).to_pylist()]
            columns = [*batch.columns, pa.array([t.pack() for t in trees], pa.binary()), pa.array([t.n_tokens for t in trees], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "__tree", "__n_tokens"])

    return map_arrow(docs, run, schema)


def apply_edits(trees: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits") -> DataFrame:
    """Per row of ``build``'s result with a column ``edits`` array<struct<start, deleted, inserted>>:
    id, new text, new packed tree, counts before and after, characters after and encoded again."""
    id_type = trees.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = piece_counts(tokenizer)
        for batch in batches:
            out = []
            for text, packed, edits in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                tree, text, again = SegmentTree.unpack(packed), text or "", 0
                before = tree.n_tokens
                for e in edits or []:
                    text, n = tree.edit(text, e["start"] or 0, e["deleted"] or 0, e["inserted"] or "", count)
                    again += n
                out.append((text, tree.pack(), before, tree.n_tokens, tree.n_chars, again))
            kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = [batch.column(0), *(pa.array([r[i] for r in out], k) for i, k in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "text", "tree", "n_tokens_before", "n_tokens", "n_chars", "reencoded_chars"])

    schema = f"`{id_col}` {id_type}, text string, tree binary, n_tokens_before long, n_tokens long, n_chars long, reencoded_chars long"
    edits = trees.schema[edits_col].dataType
    src = trees.select(id_col, text_col, "__tree", F.col(edits_col).cast(edits))
    return map_arrow(src, run, schema)
