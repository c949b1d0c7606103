"""Language-model scoring with a hierarchical Pitman-Yor model.

Tokens are words and an end sign. A token's context is the word before it; at the start of a text it is the end sign. Every context has a
Chinese restaurant. Contexts of one class (how the word ends, how long it is) share a parent restaurant, classes of one length share
the next, those share the root, and the root's base measure is uniform over the training vocabulary and one unknown word. A table of a
restaurant is a customer of its parent.

All words of the corpus are counted, in rows packed by (block of documents, bucket of word hashes):

1. A pass over the documents packs, per block and bucket, each word's contexts, training counts and documents. Buckets are
   added as the text grows, so a bucket fits a task; a word that holds a third of all rows is one entry per block.
2. Per bucket the counts of all blocks are added up. What one context has in all buckets is added up in the bucket of the
   context's own word, and sent back to the buckets that asked (``replies``).
3. Gibbs sweeps: given the parents' probabilities and the restaurants' totals of the sweep before, every dish of every
   restaurant is seated anew by the Chinese-restaurant rule, level by level from the leaves. Buckets are sampled side by side; only
   totals per class and above (a fixed number) meet on the driver between sweeps, those per word go from bucket to bucket. A dish with
   one customer has one table, so only pairs that occur twice are carried along. Past ``EXACT`` customers of a dish, new tables are
   drawn for stretches of a sixteenth of the customers present with the rate at the start of the stretch.
   What stands per bucket is written once, in a table that lies by bucket; passes over it read it where it is, and only questions and answers are shuffled.
4. Tables of the words' restaurants and predictive probabilities of the classes are averaged over the kept sweeps, and the probabilities
   that follow are sent back to the blocks as sums per document.

Perplexity is 10 ** (-score / n_tokens). Results for odd input: null and empty texts have one token, the end; an empty training set gives
every token the base measure's probability; null ids count as the empty text for the split and are returned; repeated rows count as often as they stand; empty tables give
empty tables; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import Cache, dropped, lower_words, map_arrow, stored, stored_by  # noqa: F401  (tests store through this module)

#: Low bits of a word's key that hold its class as a context.
CONTEXT_BITS = 9
CONTEXTS = 1 << CONTEXT_BITS
_LOW = np.uint64(CONTEXTS - 1)
END = xxhash.xxh64_intdigest(b"") & ~(CONTEXTS - 1)
#: Parents: start of text, after a sentence end, after other signs, and five classes of length.
PARENTS = 8
BURN_IN, SAMPLES, SEED = 2, 3, 23
STRENGTH = np.array([1.0, 1.0, 1.0])  # classes, parents, root
WORD_STRENGTH = 1.0
#: Customers of a dish seated one by one.
EXACT = 64
#: Tokens and documents of a block; bytes of text per bucket.
BLOCK_TOKENS, BLOCK_DOCS, BUCKET_BYTES, MIN_BUCKET_BITS = 2_000_000, 32_000, 32 << 20, 6
#: Bits of a document's number in its block; the next one marks the first document of a pair.
DOC_BITS = 15


def files_of(bits: int) -> int:
    """Parts of a table that lies by bucket; tasks times parts is its number of files, so they grow slower than the buckets."""
    return 1 << (bits + 4) // 2


def context_of(word: bytes) -> int:
    """Class of a word as a context; the class's parent is ``PARENT[class]``."""
    last = word[-1]
    if last in b".!?":
        return 1
    length = 3 + min(4, (len(word) - 1) // 2)
    if 97 <= last <= 122:
        return 8 + (length - 3) * 27 + last - 97
    return 8 + (length - 3) * 27 + 26 if last >= 128 else 2


PARENT = np.zeros(CONTEXTS, np.int64)
PARENT[:3] = (0, 1, 2)
PARENT[8 : 8 + 5 * 27] = 3 + np.arange(5 * 27) // 27


def key_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) & ~(CONTEXTS - 1) | context_of(word)


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(x)), bool), x[1:] != x[:-1])))


def pack(docs: DataFrame, bits: int) -> DataFrame:
    """Rows per block and bucket (words) and per document (bucket -1)."""
    id_type = docs.schema["id"].dataType.simpleString()

    def flush(batch_type: pa.DataType, part: int, number: int, ids: list, keys: list[np.ndarray], trained: list[bool]) -> Iterator[pa.RecordBatch]:
        block = (part << 24) + number
        sizes = np.array([len(k) for k in keys])
        n, none = len(ids), pa.nulls(len(ids), pa.binary())
        head = [pa.array(np.full(n, block)), pa.array(np.full(n, -1, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, batch_type), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays([*head, none, none, none, none, none], _NAMES)
        names, word = np.unique(np.concatenate(keys), return_inverse=True)
        # a text's last token is the end, so the token before a text's first one is the end too
        before = np.append(np.searchsorted(names, np.uint64(END)), word[:-1])
        doc = np.repeat(np.arange(n, dtype=np.uint64), sizes)
        width = np.uint64(len(names).bit_length())
        if 2 * width + DOC_BITS <= 64:
            both = np.sort(((word.astype(np.uint64) << width | before.astype(np.uint64)) << np.uint64(DOC_BITS)) | doc)
            doc, both = both & np.uint64((1 << DOC_BITS) - 1), both >> np.uint64(DOC_BITS)
            word, before = both >> width, both & ((np.uint64(1) << width) - np.uint64(1))
        else:
            order = np.lexsort((doc, before, word))
            word, before, doc = word[order], before[order], doc[order]
            both = word.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64)
        first = _starts(both)
        learnt = np.array(trained)[doc.astype(np.int64)].astype(np.uint32)
        count = np.add.reduceat(learnt, first).astype(np.uint32)
        doc = doc.astype(np.uint16)
        doc[first] |= np.uint16(1 << DOC_BITS)
        word, before = names[word[first].astype(np.int64)], names[before[first].astype(np.int64)]
        at_word = _starts(word)
        cuts = at_word[_starts(word[at_word] >> np.uint64(64 - bits))]
        for a, b in zip(cuts, np.append(cuts[1:], len(word))):
            own = at_word[np.searchsorted(at_word, a) : np.searchsorted(at_word, b)]
            fa, fb = first[a], first[b] if b < len(first) else len(doc)
            parts = (word[own], np.diff(np.append(own, b)).astype(np.uint32), before[a:b], count[a:b], doc[fa:fb])
            values = [pa.array([block]), pa.array([int(word[a]) >> (64 - bits)], pa.int32()), pa.nulls(1, pa.int32()), pa.nulls(1, batch_type), pa.nulls(1, pa.int64())]
            yield pa.RecordBatch.from_arrays([*values, *(pa.array([p.tobytes()], pa.binary()) for p in parts)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Cache(key_of)
        part, number, held, kind = TaskContext.get().partitionId(), 0, 0, None
        ids, keys, trained = [], [], []
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text, learn in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = lower_words(text)
                ids.append(doc)
                keys.append(np.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)), np.uint64(END)))
                trained.append(bool(learn))
                held += len(words) + 1
                if held >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield from flush(kind, part, number, ids, keys, trained)
                    number, held, ids, keys, trained = number + 1, 0, [], [], []
        if ids:
            yield from flush(kind, part, number, ids, keys, trained)

    return map_arrow(docs, run, f"block long, bucket int, idx int, id {id_type}, n_tokens long, word binary, own binary, prev binary, count binary, docs binary")


_NAMES = ["block", "bucket", "idx", "id", "n_tokens", "word", "own", "prev", "count", "docs"]


def _unpack(table: pa.Table | pa.RecordBatch, name: str, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]


@dataclass
class Pairs:
    """Pairs of a bucket, by word and context: ``word`` and ``prev`` are places in ``words`` and ``needs``."""

    words: np.ndarray
    needs: np.ndarray
    word: np.ndarray
    prev: np.ndarray
    count: np.ndarray  # in training
    of_row: np.ndarray  # pair of each entry of the packed rows

    @classmethod
    def of(cls, table: pa.Table) -> Pairs:
        word = np.concatenate([np.repeat(w, o) for w, o in zip(_unpack(table, "word", np.uint64), _unpack(table, "own", np.uint32))])
        words, word = np.unique(word, return_inverse=True)
        needs, prev = np.unique(np.concatenate(_unpack(table, "prev", np.uint64)), return_inverse=True)
        pair, of_row = np.unique(word * len(needs) + prev, return_inverse=True)
        count = np.bincount(of_row, np.concatenate(_unpack(table, "count", np.uint32)), len(pair)).astype(np.int64)
        return cls(words, needs, *np.divmod(pair, len(needs)), count, of_row)

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (word, class of context), as word * CONTEXTS + class, and that of each pair."""
        return np.unique(self.word * CONTEXTS + (self.needs & _LOW).astype(np.int64)[self.prev], return_inverse=True)


def _targets(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each run of sorted keys that belongs to one bucket."""
    at = keys >> np.uint64(64 - bits)
    cuts = _starts(at)
    return [(int(at[a]), int(a), int(b)) for a, b in zip(cuts, np.append(cuts[1:], len(keys)))]


def gather(packed: DataFrame, bits: int) -> DataFrame:
    """One row per bucket, its state; and one per bucket and bucket of contexts, what it asks of them (``target`` is not null)."""

    def run(table: pa.Table) -> pa.Table:
        bucket, pairs = int(table.column("bucket")[0].as_py()), Pairs.of(table)
        held, at = pairs.classes()
        word, context = np.divmod(held, CONTEXTS)
        known = np.bincount(pairs.word, pairs.count, len(pairs.words))
        many = pairs.count > 1
        needed, slot = np.unique(pairs.prev[many], return_inverse=True)
        fixed = np.bincount(at, pairs.count == 1, len(held)).astype(np.int64)
        leaves = Leaves(at[many], slot, pairs.count[many], np.ones(many.sum(), np.int64), np.zeros(many.sum(), np.int64), fixed, pairs.needs[needed], np.zeros(0, np.int64), np.zeros(0, np.int64))
        state = State(pairs.words, np.bincount(word, minlength=len(pairs.words)), context, leaves.above())
        sizes = {"vocabulary": int((known > 0).sum()), "tokens": int(known.sum()), "ones": int((pairs.count == 1).sum()), "twos": int((pairs.count == 2).sum())}
        first = pa.table(state.row(bucket) | leaves.row() | {k: [v] for k, v in sizes.items()})
        n = len(pairs.needs)
        customers, single, twice = (np.bincount(pairs.prev, x, n).astype(np.int64) for x in (pairs.count, pairs.count == 1, many))
        rows = [(b, pairs.needs[i:j], customers[i:j], single[i:j], twice[i:j]) for b, i, j in _targets(pairs.needs, bits)]
        asks = {"bucket": pa.array([bucket] * len(rows), pa.int32()), "target": pa.array([r[0] for r in rows], pa.int32())}
        asks |= {name: pa.array([r[k].tobytes() for r in rows], pa.binary()) for k, name in enumerate(("keys", "customers", "single", "twice"), 1)}
        whole = pa.concat_tables([first, pa.table(asks)], promote_options="default")
        return whole.select([f.split()[0] for f in (_STATE + _SIZES + _ASKS).split(", ")])

    src = packed.where("bucket >= 0").select("bucket", "word", "own", "prev", "count")
    return src.groupBy("bucket").applyInArrow(run, _STATE + _SIZES + _ASKS)


_LEAVES = "leaf_at binary, leaf_slot binary, leaf_count binary, leaf_tables binary, leaf_sum binary, fixed binary, slots binary, slot_customers binary, slot_single binary"
_STATE = f"bucket int, word binary, own binary, context binary, count binary, tables binary, upper binary, pair_sum binary, seats array<double>, {_LEAVES}"
_SIZES = ", vocabulary long, tokens long, ones long, twos long"
_ASKS = ", target int, keys binary, customers binary, single binary, twice binary"


@dataclass
class Leaves:
    """Restaurants of the words before: the pairs of a bucket with two customers or more; of the others, a number per class."""

    at: np.ndarray  # place of (word, class) in the state
    slot: np.ndarray  # place of the context in ``slots``
    count: np.ndarray
    tables: np.ndarray
    sum: np.ndarray  # tables of the kept sweeps
    fixed: np.ndarray  # per (word, class): pairs of one customer
    slots: np.ndarray  # keys of the contexts
    customers: np.ndarray  # per slot, in all buckets
    single: np.ndarray  # per slot, in all buckets: tables of dishes of one customer

    KINDS = {"at": np.int32, "slot": np.int32, "count": np.int64, "tables": np.int64, "sum": np.int64, "fixed": np.int64, "slots": np.uint64, "customers": np.int64, "single": np.int64}
    COLUMNS = dict(zip(KINDS, [f.split()[0] for f in _LEAVES.split(", ")]))

    def above(self) -> np.ndarray:
        """Customers of every (word, class)."""
        return self.fixed + np.bincount(self.at, self.tables, len(self.fixed)).astype(np.int64)

    def row(self) -> dict:
        return {c: pa.array([getattr(self, n).astype(self.KINDS[n]).tobytes()], pa.binary()) for n, c in self.COLUMNS.items()}

    @classmethod
    def of(cls, row: dict) -> Leaves:
        return cls(**{n: np.frombuffer(row[c], cls.KINDS[n]) for n, c in cls.COLUMNS.items()})


def word_probability(count, tables, customers, total, discount, above):
    """Predictive probability of a dish in a word's restaurant with ``customers`` at ``total`` tables."""
    own = np.maximum(count - discount * tables, 0)
    return (own + (WORD_STRENGTH + discount * total) * above) / (WORD_STRENGTH + customers)


def sent(states: DataFrame, column: str, bits: int) -> DataFrame:
    """(bucket, source, keys, tables): each bucket's tables (or their sums) per context, to the contexts' buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, slot, tables = (np.frombuffer(row[c], k) for c, k in (("slots", np.uint64), ("leaf_slot", np.int32), (column, np.int64)))
                total = np.bincount(slot, tables, len(keys)).astype(np.int64)
                rows = [(b, row["bucket"], keys[i:j].tobytes(), total[i:j].tobytes()) for b, i, j in _targets(keys, bits)]
                names = ["bucket", "source", "keys", "tables"]
                kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return map_arrow(states.select("bucket", "slots", "leaf_slot", column), run, "bucket int, source int, keys binary, tables binary")


def totals_by_key(table: pa.Table, *columns: str) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct keys of a table's rows, the sums of columns over them, and of each entry its key's place; rows' lengths."""
    keys = _unpack(table, "keys", np.uint64)
    u, place = np.unique(np.concatenate([*keys, np.zeros(0, np.uint64)]), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([*_unpack(table, c, np.int64), np.zeros(0, np.int64)]), len(u)).astype(np.int64) for c in columns]
    return u, place, sums, np.cumsum([len(k) for k in keys])[:-1]


def _answered(table: pa.Table, **columns: list[np.ndarray]) -> pa.Table:
    bucket = pa.array(table.column("source").to_pylist(), pa.int32())
    source = pa.array(table.column("bucket").to_pylist(), pa.int32())
    return pa.table({"bucket": bucket, "source": source} | {n: pa.array([x.astype(np.int64).tobytes() for x in c], pa.binary()) for n, c in columns.items()})


def first_replies(asks: DataFrame) -> DataFrame:
    """(bucket, source, customers, single, tables): totals of the contexts that a bucket has twice with one word, in the order of their keys.

    ``tables`` are those before the first sweep, one for each dish of two customers or more.
    """

    def run(table: pa.Table) -> pa.Table:
        _, place, (customers, single, tables), cuts = totals_by_key(table, "customers", "single", "twice")
        wanted = [x > 0 for x in _unpack(table, "twice", np.int64)]
        parts = [p[w] for p, w in zip(np.split(place, cuts), wanted)]
        return _answered(table, customers=[customers[p] for p in parts], single=[single[p] for p in parts], tables=[tables[p] for p in parts])

    return asks.groupBy("bucket").applyInArrow(run, "bucket int, source int, customers binary, single binary, tables binary")


def replies(messages: DataFrame) -> DataFrame:
    """(bucket, source, tables): the tables of all buckets for each context that a bucket sent."""

    def run(table: pa.Table) -> pa.Table:
        _, place, (tables,), cuts = totals_by_key(table, "tables")
        return _answered(table, tables=np.split(tables[place], cuts))

    return messages.groupBy("bucket").applyInArrow(run, "bucket int, source int, tables binary")


def last_replies(asks: DataFrame, sums: DataFrame, samples: int) -> DataFrame:
    """(bucket, source, customers, tables): of each context that a bucket asked for, customers and the sum of its tables over the kept sweeps."""

    def run(table: pa.Table, more: pa.Table) -> pa.Table:
        u, place, (customers, single), cuts = totals_by_key(table, "customers", "single")
        own, _, (tables,), _ = totals_by_key(more, "tables")
        total = single * samples
        total[np.searchsorted(u, own)] += tables
        return _answered(table, customers=np.split(customers[place], cuts), tables=np.split(total[place], cuts))

    return asks.groupBy("bucket").cogroup(sums.groupBy("bucket")).applyInArrow(run, "bucket int, source int, customers binary, tables binary")


def _joined(table: pa.Table, name: str) -> np.ndarray:
    """A reply's parts in the order of the contexts' keys."""
    return np.concatenate([*_unpack(table.sort_by("source"), name, np.int64), np.zeros(0, np.int64)])


@dataclass
class State:
    """Words of a bucket: per pair (word, context) customers and tables; per (word, parent) and word the tables above."""

    word: np.ndarray
    own: np.ndarray
    context: np.ndarray
    count: np.ndarray
    tables: np.ndarray | None = None  # per pair
    upper: np.ndarray | None = None  # (words, PARENTS + 1) tables of the parents' dishes, then of the root's
    pair_sum: np.ndarray | None = None  # summed predictive probability per pair
    seats: np.ndarray | None = None  # totals of customers and tables of all restaurants

    def __post_init__(self):
        if self.tables is None:
            self.tables = np.minimum(self.count, 1)
            parent = self.parent_customers()
            self.upper = np.concatenate((np.minimum(parent, 1), (parent.sum(axis=1, keepdims=True) > 0).astype(np.int64)), axis=1)
            self.pair_sum = np.zeros(len(self.count))
        self.seats = self.totals()

    @property
    def at(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.word)), self.own)

    def parent_customers(self) -> np.ndarray:
        return np.bincount(self.at * PARENTS + PARENT[self.context], self.tables, len(self.word) * PARENTS).reshape(-1, PARENTS).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Customers, tables, dishes of one and of two customers: of each context, each parent and the root."""
        parent, root = self.parent_customers(), self.upper[:, :-1].sum(axis=1)
        out = []
        for level in range(2):
            out += [np.bincount(self.context, (self.count, self.tables)[level], CONTEXTS), (parent, self.upper[:, :-1])[level].sum(axis=0), [(root, self.upper[:, -1])[level].sum()]]
        for n in (1, 2):
            out += [[(self.count == n).sum(), (parent == n).sum(), (root == n).sum()]]
        return np.concatenate(out).astype(float)

    def row(self, bucket: int) -> dict:
        data = (self.word.astype(np.uint64), self.own.astype(np.uint16), self.context.astype(np.uint16), self.count.astype(np.int64), self.tables.astype(np.int64), self.upper.astype(np.int64), self.pair_sum.astype(np.float64))
        names = ("word", "own", "context", "count", "tables", "upper", "pair_sum")
        packed = {n: pa.array([d.tobytes()], pa.binary()) for n, d in zip(names, data)}
        return {"bucket": pa.array([bucket], pa.int32())} | packed | {"seats": pa.array([self.seats], pa.list_(pa.float64()))}

    @classmethod
    def of(cls, row: dict) -> State:
        kinds = {"word": np.uint64, "own": np.uint16, "context": np.uint16, "count": np.int64, "tables": np.int64, "upper": np.int64, "pair_sum": np.float64}
        read = {n: np.frombuffer(row[n], k) for n, k in kinds.items()}
        read["own"], read["context"] = read["own"].astype(np.int64), read["context"].astype(np.int64)
        return cls(**(read | {"upper": read["upper"].reshape(-1, PARENTS + 1)}))


@dataclass(frozen=True)
class Seats:
    """Totals of all restaurants, with each level's discount, and the size of the base measure."""

    customers: tuple[np.ndarray, np.ndarray, np.ndarray]
    tables: tuple[np.ndarray, np.ndarray, np.ndarray]
    discount: np.ndarray
    base: float

    @classmethod
    def of(cls, flat: np.ndarray, vocabulary: int) -> Seats:
        cut = np.cumsum([CONTEXTS, PARENTS, 1, CONTEXTS, PARENTS, 1])
        c0, c1, c2, t0, t1, t2, rest = np.split(flat, cut)
        one, two = rest[:3], rest[3:]
        # the usual estimate from dishes of one and two customers
        discount = np.clip(one / np.maximum(one + 2 * two, 1), 0.05, 0.95)
        return cls((c0, c1, c2), (t0, t1, t2), discount, 1 / (vocabulary + 1))

    def back(self, level: int) -> np.ndarray:
        """Weight that each restaurant of a level gives to its parent."""
        s = STRENGTH[level]
        return (s + self.discount[level] * self.tables[level]) / (s + self.customers[level])

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        own = np.maximum(customers - self.discount[2] * tables, 0) / (STRENGTH[2] + self.customers[2])
        return own + self.back(2) * self.base

    def parents(self, customers: np.ndarray, tables: np.ndarray, root: np.ndarray) -> np.ndarray:
        own = np.maximum(customers - self.discount[1] * tables, 0) / (STRENGTH[1] + self.customers[1])
        return own + self.back(1) * root[:, None]

    def contexts(self, state: State, parents: np.ndarray) -> np.ndarray:
        u = state.context
        own = np.maximum(state.count - self.discount[0] * state.tables, 0) / (STRENGTH[0] + self.customers[0][u])
        return own + self.back(0)[u] * parents[state.at, PARENT[u]]

    def probabilities(self, state: State) -> np.ndarray:
        """Predictive probability of every pair."""
        root = self.root(state.upper[:, :-1].sum(axis=1), state.upper[:, -1])
        return self.contexts(state, self.parents(state.parent_customers(), state.upper[:, :-1], root))


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after all its customers sat down; ``fresh`` is the weight of a new table."""
    tables = np.minimum(customers, 1)
    rows = np.flatnonzero(customers > 1)
    n = 1
    while len(rows):
        stretch = 1 if n < EXACT else n // 16
        t = tables[rows]
        rate = fresh[rows] / (fresh[rows] + np.maximum(n - discount * t, 1e-12))
        if stretch == 1:
            tables[rows] = t + (rng.random(len(rows)) < rate)
        else:
            tables[rows] = np.minimum(t + rng.binomial(np.minimum(stretch, customers[rows] - n), rate), customers[rows])
        n += stretch
        rows = rows[customers[rows] > n]
    return tables


def sweep(state: State, seats: Seats, rng: np.random.Generator, keep: bool) -> State:
    """Seat every dish anew from the leaves to the root, given the state of the sweep before."""
    d, s = seats.discount, STRENGTH
    root = seats.root(state.upper[:, :-1].sum(axis=1), state.upper[:, -1])
    parents = seats.parents(state.parent_customers(), state.upper[:, :-1], root)
    u = state.context
    state.tables = seat(state.count, (s[0] + d[0] * seats.tables[0][u]) * parents[state.at, PARENT[u]], d[0], rng)
    customers = state.parent_customers()
    fresh = (s[1] + d[1] * seats.tables[1]) * root[:, None]
    upper = seat(customers.ravel(), fresh.ravel(), d[1], rng).reshape(customers.shape)
    top = seat(upper.sum(axis=1), np.full(len(upper), (s[2] + d[2] * seats.tables[2][0]) * seats.base), d[2], rng)
    state.upper = np.concatenate((upper, top[:, None]), axis=1)
    state.seats = state.totals()
    if keep:
        state.pair_sum = state.pair_sum + seats.probabilities(state)
    return state


def totals_of(states: DataFrame) -> np.ndarray:
    """Seats of all buckets, added up: a fixed number of values."""
    rows = states.select(F.posexplode("seats")).groupBy("pos").agg(F.sum("col").alias("v")).collect()
    out = np.zeros(2 * (CONTEXTS + PARENTS + 1) + 6)
    for r in rows:
        out[r["pos"]] = r["v"]
    return out


def sampled(states: DataFrame, asks: DataFrame, vocabulary: int, discount: float, bits: int, sweeps: int, burn_in: int) -> tuple[DataFrame, Seats]:
    """State after all sweeps; sums hold the tables of the kept ones, and the probabilities of all kept ones but the last."""
    seats = Seats.of(totals_of(states), vocabulary)
    for number in range(burn_in + sweeps):
        answers = replies(sent(states, "leaf_tables", bits)) if number else first_replies(asks)
        later = stored_by(swept(states, answers, seats, discount, number, burn_in), f"seats{number}", "bucket", files_of(bits))
        dropped(states)
        states, seats = later, Seats.of(totals_of(later), vocabulary)
    return states, seats


def swept(states: DataFrame, answers: DataFrame, seats: Seats, discount: float, number: int, burn_in: int) -> DataFrame:
    """State after one sweep; sweeps from ``burn_in`` on are kept. The first one's answers tell what the contexts hold in all buckets."""

    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        (row,) = state.to_pylist()
        own, leaves = State.of(row), Leaves.of(row)
        if not number:
            leaves.customers, leaves.single = _joined(answers, "customers"), _joined(answers, "single")
        rng = np.random.default_rng((SEED, number, row["bucket"]))
        p = seats.probabilities(own)
        if number > burn_in:
            own.pair_sum = own.pair_sum + p
        fresh = (WORD_STRENGTH + discount * (leaves.single + _joined(answers, "tables"))[leaves.slot]) * p[leaves.at]
        leaves.tables = seat(leaves.count, fresh, discount, rng)
        if number >= burn_in:
            leaves.sum = leaves.sum + leaves.tables
        own.count = leaves.above()
        return pa.table(sweep(own, seats, rng, False).row(row["bucket"]) | leaves.row())

    return states.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(run, _STATE)


def known_of(states: DataFrame, told: DataFrame, seats: Seats, samples: int) -> DataFrame:
    """What the answers need of a bucket: per (word, class) the mean probability above, per pair of two customers or more the sum of its tables, per context its totals."""

    def run(state: pa.Table, told: pa.Table) -> pa.Table:
        (row,) = state.to_pylist()
        own = State.of(row)
        above = (own.pair_sum + seats.probabilities(own)) / samples
        parts = (above, np.frombuffer(row["leaf_sum"], np.int64), _joined(told, "customers"), _joined(told, "tables"))
        return pa.table({"bucket": pa.array([row["bucket"]], pa.int32())} | {n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("above", "leaf_sum", "customers", "tables"), parts)})

    return states.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(run, "bucket int, above binary, leaf_sum binary, customers binary, tables binary")


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES, burn_in: int = BURN_IN) -> DataFrame:
    """Per row: id, n_tokens, n_known, train_tokens, base_score (add-one unigram) and score, both log10 of the whole text.

    ``training`` marks the rows that the model learns from.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    bits = max(MIN_BUCKET_BITS, int(np.ceil(np.log2(max(1, size / BUCKET_BYTES)))))
    packed = stored_by(pack(src, bits), "packed", "bucket", files_of(bits))
    counts = stored_by(gather(packed, bits), "counts", "bucket", files_of(bits))
    n, v, ones, twos = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "vocabulary", "ones", "twos"))).first()
    discount = float(np.clip(ones / max(ones + 2 * twos, 1), 0.05, 0.95))
    asked = counts.where("target is not null").select(F.col("target").alias("bucket"), F.col("bucket").alias("source"), "keys", "customers", "single", "twice")
    asks = stored_by(asked, "asks", "bucket", files_of(bits))
    first = counts.where("target is null").select([f.split()[0] for f in _STATE.split(", ")])
    states, seats = sampled(first, asks, v, discount, bits, samples, burn_in)
    told = last_replies(asks, sent(states, "leaf_sum", bits), samples)
    known = stored_by(known_of(states, told, seats, samples), "known", "bucket", files_of(bits))
    for scratch in (states, asks):
        dropped(scratch)
    unseen = 1.0 / (v + 1)

    def answer(table: pa.Table, own: pa.Table) -> pa.Table:
        (row,) = own.to_pylist()
        pairs = Pairs.of(table)
        above, leaf_sum, customers, total = (np.frombuffer(row[c], k) for c, k in (("above", np.float64), ("leaf_sum", np.int64), ("customers", np.int64), ("tables", np.int64)))
        tables = np.minimum(pairs.count, 1).astype(float)
        tables[pairs.count > 1] = leaf_sum / samples
        p = word_probability(pairs.count, tables, customers[pairs.prev], (total / samples)[pairs.prev], discount, above[pairs.classes()[1]])
        p = np.log10(np.maximum(p, 1e-300)) if n else np.full(len(p), np.log10(unseen))
        count = np.bincount(pairs.word, pairs.count, len(pairs.words))
        base = np.log10((count + 1) / (n + v + 1))
        out, at = [], 0
        for block, prev, doc in zip(table.column("block").to_pylist(), _unpack(table, "prev", np.uint64), _unpack(table, "docs", np.uint16)):
            entry = np.cumsum(doc >> np.uint16(DOC_BITS), dtype=np.int64) - 1 + at
            at += len(prev)
            pair = pairs.of_row[entry]
            word = pairs.word[pair]
            idx, inverse = np.unique(doc & np.uint16((1 << DOC_BITS) - 1), return_inverse=True)
            sums = [np.bincount(inverse, x, len(idx)) for x in (p[pair], base[word], count[word] > 0)]
            out.append((block, idx.astype(np.uint16).tobytes(), np.stack(sums).astype(np.float64).tobytes()))
        bucket = row["bucket"]
        return pa.table({"bucket": pa.array([bucket] * len(out), pa.int32()), "block": [b for b, _, _ in out], "docs": pa.array([d for _, d, _ in out], pa.binary()), "sums": pa.array([s for _, _, s in out], pa.binary())})

    words = packed.where("bucket >= 0").select("bucket", "block", "word", "own", "prev", "count", "docs")
    answers = words.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(answer, "bucket int, block long, docs binary, sums binary")
    rows = packed.where("bucket = -1").select("block", "idx", "id", "n_tokens")
    id_type = rows.schema["id"].dataType.simpleString()

    def add(mine: pa.Table, parts: pa.Table) -> pa.Table:
        total = np.zeros((3, BLOCK_DOCS + 1))
        parts = parts.sort_by("bucket")  # the same sum in every run
        for found, sums in zip(_unpack(parts, "docs", np.uint16), _unpack(parts, "sums", np.float64)):
            total[:, found] += sums.reshape(3, -1)
        at = mine.column("idx").to_numpy()
        return pa.table({"id": mine.column("id"), "n_tokens": mine.column("n_tokens"), "n_known": total[2, at].round().astype(np.int64), "base_score": total[1, at], "score": total[0, at]})

    done = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(add, f"id {id_type}, n_tokens long, n_known long, base_score double, score double")
    return done.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
