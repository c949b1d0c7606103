"""Vector code compression: product codes from integer k-means, with exact results and few rescans.

Vectors become integers and are cut into equal parts; every part position has its own codebook. Each round assigns every part to
the nearest entry and moves the entries. Most parts keep their entry, and bounds prove it without looking at the other entries: a
part remembers how far its own entry was at most, and how near any other entry was at least, together with the round in
which each of the two was measured. The codebooks of all rounds are retained, so a bound is brought up to date by the *net* displacement
of the entries between its round and now - the norm of the sum of all moves, never more than the sum of their norms. Only where the
bounds meet are distances computed: first to the own entry, and if that does not settle it, to all.

State lives in the rows of one stored table per round; the table before is deleted. A task adds one row with its sums per entry,
so what is shuffled and sent to the driver grows with the codebooks, not with the vectors.

Odd inputs: null vectors and those with a null, NaN or infinite component are dropped. The dimension is that of the row with the
smallest id (null ids last, then by vector); rows of another length are dropped too. If it is no multiple of the number of parts, vectors
are filled up with zeros. Fewer vectors than entries make a smaller codebook; repeated rows count each. Components of any finite size are exact:
where 64-bit floats could round, Python integers take over, without bounds. Errors beyond a long are given as the largest long. An empty table gives an
empty result. What is carried along stands in one struct, so no name can clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from custodia.llm.common import dropped, map_arrow, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LONGEST = 2**63 - 1
LIMB = 32

#: Own entry, upper bound and its round, lower bound and its round; one byte or float32 for each part.
_STATE = "own binary, upper binary, upper_round binary, lower binary, lower_round binary"
_SUMS = "sums array<struct<part:int,entry:int,at:int,limb:int,total:bigint>>"

Book = list[list[list[int]]]  # part, entry, position within the part


@dataclass(frozen=True)
class Codebooks:
    """Entries by part, entry and position within the part."""

    entries: Book
    dimension: int

    def digest(self) -> str:
        flat = (str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def limit(width: int) -> int:
    """Magnitude below which squared distances of parts are exact in 64-bit floats."""
    return math.isqrt(2**51 // max(width, 1))


def scaled(x: float, scale: int = SCALE) -> int:
    return int(x) * scale if abs(x) >= 2.0**53 else math.floor(scale * x)


def parts_of(vector: list[int], parts: int) -> list[list[int]]:
    width = -(-len(vector) // parts)
    full = vector + [0] * (width * parts - len(vector))
    return [full[p * width : (p + 1) * width] for p in range(parts)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of parts to entries."""
    if x.dtype == object or entries.dtype == object:
        apart = x.astype(object)[:, None, :] - entries.astype(object)[None]
        return (apart * apart).sum(axis=2) if x.shape[1] else np.zeros((len(x), len(entries)))
    x, e = x.astype(np.float64), entries.astype(np.float64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ e.T) + (e * e).sum(axis=1)


class Bounds:
    """Codebooks of all rounds so far and how far each entry is now from where it was."""

    def __init__(self, history: list[Book]):
        self.now = len(history) - 1
        books = [[np.array(part, dtype=object) for part in book] for book in history]
        self.entries = []
        self.wide = []
        self.moved, self.most = [], []  # by part: [round, entry]
        for p, part in enumerate(books[-1]):
            size = limit(part.shape[1])
            self.wide.append(any(abs(v) >= size for book in history for entry in book[p] for v in entry))
            if self.wide[p]:
                self.entries.append(part)
                away = np.full((len(history), len(part)), np.inf)
            else:
                self.entries.append(part.astype(np.int64))
                away = np.array([np.sqrt(((part - old[p]).astype(np.float64) ** 2).sum(axis=1)) for old in books]) * (1 + 1e-12)
            self.moved.append(away)
            others = np.zeros_like(away)
            for e in range(len(part)):
                rest = np.delete(away, e, axis=1)
                others[:, e] = rest.max(axis=1) if rest.shape[1] else 0.0
            self.most.append(others)


@dataclass
class State:
    """Arrays of (rows, parts)."""

    own: np.ndarray
    upper: np.ndarray
    upper_round: np.ndarray
    lower: np.ndarray
    lower_round: np.ndarray

    @classmethod
    def unknown(cls, n: int, parts: int) -> State:
        """Bounds that prove nothing."""
        zero = lambda: np.zeros((n, parts), np.uint8)
        return cls(zero(), np.full((n, parts), np.inf, np.float32), zero(), np.full((n, parts), -np.inf, np.float32), zero())


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def assign(x: np.ndarray, s: State, bounds: Bounds) -> int:
    """Bring every part to its nearest entry, ties to the lower index; the number of parts that were rescanned."""
    rescanned = 0
    for p in range(x.shape[1]):
        entries = bounds.entries[p]
        if bounds.wide[p] or x.dtype == object:
            s.own[:, p] = distances(x[:, p], entries).argmin(axis=1)
            s.upper[:, p], s.lower[:, p] = np.inf, -np.inf
            rescanned += len(x)
            continue
        own = s.own[:, p]
        lower = s.lower[:, p].astype(np.float64) - bounds.most[p][s.lower_round[:, p], own]
        upper = s.upper[:, p].astype(np.float64) + bounds.moved[p][s.upper_round[:, p], own]
        open_ = np.flatnonzero(~(upper * (1 + 1e-9) < lower))
        if not len(open_):
            continue
        # the distance to the own entry may settle it
        apart = x[open_, p].astype(np.float64) - entries[own[open_]]
        exact = _up(np.sqrt((apart * apart).sum(axis=1)))
        s.upper[open_, p], s.upper_round[open_, p] = exact, bounds.now
        rest = open_[~(exact.astype(np.float64) * (1 + 1e-9) < lower[open_])]
        if not len(rest):
            continue
        rescanned += len(rest)
        all_ = distances(x[rest, p], entries)
        nearest = all_.argmin(axis=1)
        rows = np.arange(len(rest))
        s.own[rest, p] = nearest
        s.upper[rest, p] = _up(np.sqrt(all_[rows, nearest]))
        all_[rows, nearest] = np.inf
        s.lower[rest, p] = _down(np.sqrt(all_.min(axis=1)))
        s.upper_round[rest, p] = s.lower_round[rest, p] = bounds.now
    return rescanned


def _limbs(v: int) -> Iterator[tuple[int, int]]:
    """Signed pieces of a whole number that add up to it and whose sums fit a long."""
    sign, v, i = (-1 if v < 0 else 1), abs(v), 0
    while v:
        yield i, sign * (v & (2**LIMB - 1))
        v >>= LIMB
        i += 1


class Sums:
    """Component sums and counts per part and entry of one task."""

    def __init__(self, parts: int, entries: int, width: int):
        self.totals = np.zeros((parts, entries, width), np.int64)
        self.counts = np.zeros((parts, entries), np.int64)
        self.large: dict[tuple[int, int, int, int], int] = {}

    def add(self, x: np.ndarray, own: np.ndarray) -> None:
        entries = self.counts.shape[1]
        for p in range(x.shape[1]):
            self.counts[p] += np.bincount(own[:, p], minlength=entries)
            if x.dtype == object:
                for row, e in zip(x[:, p], own[:, p]):
                    for at, v in enumerate(row):
                        for limb, piece in _limbs(int(v)):
                            key = (p, int(e), at, limb)
                            self.large[key] = self.large.get(key, 0) + piece
            else:
                one = (own[:, p][None] == np.arange(entries)[:, None]).astype(np.float64)
                self.totals[p] += (one @ x[:, p].astype(np.float64)).astype(np.int64)

    def rows(self) -> list[dict]:
        def row(part, entry, at, limb, total):
            return {"part": int(part), "entry": int(entry), "at": int(at), "limb": int(limb), "total": int(total)}

        out = [row(p, e, -1, 0, self.counts[p, e]) for p, e in zip(*np.nonzero(self.counts))]
        out += [row(p, e, at, 0, self.totals[p, e, at]) for p, e, at in zip(*np.nonzero(self.totals))]
        return out + [row(*key, total) for key, total in self.large.items()]


def _matrix(column: pa.Array, dtype, n: int) -> np.ndarray:
    """A binary column whose values have one length, as a matrix."""
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, dtype).reshape(n, -1).copy()


def _binary(m: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(m)], pa.binary())


class Worker:
    """One round over the rows of a task."""

    def __init__(self, bounds: Bounds, parts: int, width: int, dimension: int, scale: int):
        self.bounds, self.parts, self.width, self.dimension, self.scale = bounds, parts, width, dimension, scale

    def integers(self, batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
        """int32 matrix, and for rows with larger components the decimal digits of all of them."""
        n = batch.num_rows
        vectors = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, self.dimension)
        with np.errstate(over="ignore"):
            whole = np.floor(self.scale * vectors)
        full = np.zeros((n, self.parts * self.width))
        full[:, : self.dimension] = whole
        wide: list = [None] * n
        for i in np.flatnonzero((np.abs(full) >= limit(self.width)).any(axis=1)):
            row = [scaled(float(v), self.scale) for v in vectors[i]]
            wide[i] = [str(v) for v in row + [0] * (self.parts * self.width - self.dimension)]
            full[i] = 0
        return full.astype(np.int32), wide

    def start(self, batches: Iterator[pa.RecordBatch]):
        """Rows as they come from the table."""
        for batch in batches:
            if batch.num_rows:
                narrow, wide = self.integers(batch)
                yield batch, narrow, wide, State.unknown(batch.num_rows, self.parts)

    def resume(self, batches: Iterator[pa.RecordBatch]):
        """Rows with the state of the round before."""
        for batch in batches:
            n = batch.num_rows
            if n:
                narrow = _matrix(batch.column("ints"), np.int32, n).reshape(n, self.parts * self.width)
                kinds = (("own", np.uint8), ("upper", np.float32), ("upper_round", np.uint8), ("lower", np.float32), ("lower_round", np.uint8))
                yield batch, narrow, batch.column("wide").to_pylist(), State(*(_matrix(batch.column(c), t, n) for c, t in kinds))

    def groups(self, narrow: np.ndarray, wide: list):
        """(row numbers, parts as a cube): the usual rows and those of Python integers."""
        large = np.array([w is not None for w in wide], bool)
        usual = np.flatnonzero(~large)
        if len(usual):
            yield usual, narrow[usual].reshape(len(usual), self.parts, self.width)
        odd = np.flatnonzero(large)
        if len(odd):
            yield odd, np.array([[int(v) for v in wide[i]] for i in odd], dtype=object).reshape(len(odd), self.parts, self.width)

    def moved(self, narrow: np.ndarray, wide: list, state: State, sums: Sums | None) -> list[int]:
        """Assign all rows; squared distances if no sums are asked for."""
        errors = [0] * len(narrow)
        for rows, x in self.groups(narrow, wide):
            some = State(*(a[rows] for a in vars(state).values()))
            assign(x, some, self.bounds)
            for name, a in vars(some).items():
                getattr(state, name)[rows] = a
            if sums:
                sums.add(x, some.own)
                continue
            for p in range(self.parts):
                apart = x[:, p] - self.bounds.entries[p][some.own[:, p]]
                for i, e in zip(rows, (apart * apart).sum(axis=1) if self.width else [0] * len(rows)):
                    errors[i] += int(e)
        return errors

    def round(self, rows) -> Iterator[pa.RecordBatch]:
        sums = Sums(self.parts, len(self.bounds.entries[0]), self.width)
        sums_type = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("at", pa.int32()), ("limb", pa.int32()), ("total", pa.int64())]))
        kept = None
        for batch, narrow, wide, state in rows:
            self.moved(narrow, wide, state, sums)
            n = batch.num_rows
            kept = batch.schema
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "carried": batch.column("carried"), "ints": _binary(narrow), "wide": pa.array(wide, pa.list_(pa.string()))}
                | {name: _binary(a) for name, a in vars(state).items()}
                | {"sums": pa.nulls(n, sums_type)}
            )
        if kept is not None:
            nothing = {"id": pa.nulls(1, kept.field("id").type), "carried": pa.nulls(1, kept.field("carried").type), "ints": pa.nulls(1, pa.binary()), "wide": pa.nulls(1, pa.list_(pa.string()))}
            nothing |= {name: pa.nulls(1, pa.binary()) for name in State.__dataclass_fields__}
            yield pa.RecordBatch.from_pydict(nothing | {"sums": pa.array([sums.rows()], sums_type)})

    def last(self, rows) -> Iterator[pa.RecordBatch]:
        for batch, narrow, wide, state in rows:
            errors = self.moved(narrow, wide, state, None)
            yield pa.RecordBatch.from_pydict(
                {"id": batch.column("id"), "carried": batch.column("carried"), "code": _binary(state.own), "error": pa.array([min(e, LONGEST) for e in errors], pa.int64())}
            )


def _next(book: Book, table: DataFrame) -> Book:
    """Entries moved to the floors of their means; unused ones stay. The driver gets one number per component."""
    pieces = table.where("sums IS NOT NULL").select(F.explode("sums").alias("s")).select("s.*")
    total: dict[tuple[int, int, int], int] = {}
    for r in pieces.groupBy("part", "entry", "at", "limb").agg(F.sum("total").alias("total")).collect():
        key = (r.part, r.entry, r.at)
        total[key] = total.get(key, 0) + (r.total << (LIMB * r.limb))
    out = []
    for p, part in enumerate(book):
        out.append([])
        for e, entry in enumerate(part):
            n = total.get((p, e, -1), 0)
            out[p].append([total.get((p, e, at), 0) // n for at in range(len(entry))] if n else entry)
    return out


def fit_and_code(
    df: DataFrame, id_col: str, vector: str, carry: dict[str, Column] | None = None,
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, Codebooks]:
    """(id, carried, code, error) of every kept row, stored, and the codebooks.

    ``code`` holds one byte per part, ``error`` the sum of the squared distances.
    """
    numbers = F.col(vector).cast("array<double>")
    carried = F.struct(*(c.alias(name) for name, c in carry.items())) if carry else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).alias("id"), numbers.alias("vector"), carried.alias("carried"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & F.coalesce(sound, F.lit(False)))
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = rows.orderBy(*order).select("vector").first()
    kept = [StructField(c, rows.schema[c].dataType) for c in ("id", "carried")]
    result = StructType(kept + StructType.fromDDL("code binary, error long").fields)
    if first is None:
        return rows.sparkSession.createDataFrame([], result), Codebooks([], 0)
    dimension = len(first[0])
    rows = rows.where(F.size("vector") == dimension)
    seeds = rows.orderBy(*order).limit(entries).select("vector").collect()
    cut = [parts_of([scaled(x, scale) for x in r[0]], parts) for r in seeds]
    history: list[Book] = [[[vector[p] for vector in cut] for p in range(parts)]]
    width = -(-dimension // parts)

    between = StructType(kept + StructType.fromDDL(f"ints binary, wide array<string>, {_STATE}, {_SUMS}").fields)
    state = None
    for _ in range(rounds):
        if len(history) > 1 and history[-1] == history[-2]:
            break  # nothing moved: all further rounds would repeat this one
        worker = Worker(Bounds(history), parts, width, dimension, scale)
        done = stored(map_arrow(_pending(rows, state), _job(worker, "round", state is not None), between), "codes-round")
        if state is not None:
            dropped(state)
        state = done
        history.append(_next(history[-1], state))
    worker = Worker(Bounds(history), parts, width, dimension, scale)
    coded = stored(map_arrow(_pending(rows, state), _job(worker, "last", state is not None), result), "codes")
    if state is not None:
        dropped(state)
    return coded, Codebooks(history[-1], dimension)


def _pending(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    return rows if state is None else state.where("sums IS NULL").drop("sums")


def _job(worker: Worker, step: str, resumed: bool):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = worker.resume(batches) if resumed else worker.start(batches)
        yield from getattr(worker, step)(rows)

    return job


def hex_code(code: str | Column) -> Column:
    return F.lower(F.hex(code))


def with_group_error(coded: DataFrame, group: Column) -> DataFrame:
    """Add ``group_error``, the errors of all rows of a group; null is a group. Totals are combined before their shuffle."""
    keyed = coded.withColumn("__g", group)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    totals = keyed.groupBy("__g").agg(total.alias("group_error")).withColumnRenamed("__g", "__h")
    return keyed.join(totals, F.col("__g").eqNullSafe(F.col("__h"))).drop("__g", "__h")
