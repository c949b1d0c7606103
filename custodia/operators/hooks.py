"""Models of one's own - a recogniser, an embedder, a judge - called on Arrow batches of texts.

A model is a function from a list of texts to a list of results, as long as the list. It gets batches bounded by characters, so very long
texts do not fill a worker's memory. If a batch fails, its texts are tried one by one; a text that fails, or whose result does not
have the promised form, has a null result and its error in ``error``, and the others go on. Null texts are not given to the
model and have neither. No query of the library depends on a model; results join the rules as ``extra`` entities, embeddings or judgements.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from custodia.functions import pii

Model = Callable[[list[str]], list[Any]]

#: Texts and characters that a model gets at once.
MAX_TEXTS, MAX_CHARS = 256, 1_000_000
_ENTITIES = "array<struct<start:int,neg_conf:double,rank:int,end:int,type:string,value:string>>"


def _chunks(texts: list[str | None], max_texts: int, max_chars: int) -> Iterator[list[int]]:
    """Positions of the texts of one call."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if t is None:
            continue
        if held and (len(held) == max_texts or size + len(t) > max_chars):
            yield held
            held, size = [], 0
        held.append(i)
        size += len(t)
    if held:
        yield held


def _called(model: Model, texts: list[str], checked: Callable[[str, Any], Any]) -> list[tuple[Any, str | None]]:
    def whole(some: list[str]) -> list[Any]:
        out = list(model(some))
        if len(out) != len(some):
            raise ValueError(f"{len(out)} results for {len(some)} texts")
        return out

    def one(text: str, result: Any) -> tuple[Any, str | None]:
        try:
            return checked(text, result), None
        except Exception as e:  # noqa: BLE001 - a model may raise anything; it is counted, not lost
            return None, f"{type(e).__name__}: {e}"

    def alone(text: str) -> tuple[Any, str | None]:
        try:
            return one(text, whole([text])[0])
        except Exception as e:  # noqa: BLE001
            return None, f"{type(e).__name__}: {e}"

    try:
        results = whole(texts)
    except Exception:  # noqa: BLE001
        return [alone(t) for t in texts]
    return [one(t, r) for t, r in zip(texts, results)]


def apply(
    df: DataFrame, text: str, model: Model, out: str, kind: str | DataType, checked: Callable[[str, Any], Any] = lambda text, result: result,
    max_texts: int = MAX_TEXTS, max_chars: int = MAX_CHARS,
) -> DataFrame:
    """All columns of ``df``, the model's result ``out`` of type ``kind`` and ``error``. ``checked`` raises for a result that will not do."""
    if out in df.columns or "error" in df.columns:
        raise ValueError(f"a column {out} or error is there already")
    result = StructType.fromDDL(f"x {kind}")["x"].dataType if isinstance(kind, str) else kind
    schema = StructType([*df.schema.fields, StructField(out, result), StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(result)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            done: list[tuple[Any, str | None]] = [(None, None)] * len(texts)
            for chunk in _chunks(texts, max_texts, max_chars):
                for i, r in zip(chunk, _called(model, [texts[i] for i in chunk], checked)):
                    done[i] = r
            columns = [*batch.columns, pa.array([r for r, _ in done], arrow), pa.array([e for _, e in done], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, out, "error"])

    return df.mapInArrow(run, schema)


def recognise(df: DataFrame, text: str, model: Model, out: str = "extra", **options) -> DataFrame:
    """Entities of a recogniser, in the form that ``redaction.detect`` takes as ``extra``.

    The model gives (start, end, type, confidence) for every find, in characters. One that lies outside its text, or whose
    type has no rank, is an error of that text.
    """

    def checked(value: str, found: Any) -> list[dict]:
        rows = []
        for start, end, kind, confidence in found:
            if not 0 <= start < end <= len(value):
                raise ValueError(f"{start} to {end} lies outside a text of {len(value)}")
            if kind not in pii.RANK:
                raise ValueError(f"unknown type {kind}")
            rows.append({"start": start, "neg_conf": -float(confidence), "rank": pii.RANK[kind], "end": end, "type": kind, "value": value[start:end]})
        return rows

    return apply(df, text, model, out, _ENTITIES, checked, **options)


def embed(df: DataFrame, text: str, model: Model, dimension: int, out: str = "embedding", **options) -> DataFrame:
    """Vectors of ``dimension`` finite numbers."""

    def checked(value: str, vector: Any) -> list[float]:
        numbers = [float(x) for x in vector]
        if len(numbers) != dimension or any(x != x or x in (float("inf"), float("-inf")) for x in numbers):
            raise ValueError(f"not a vector of {dimension} finite numbers")
        return numbers

    return apply(df, text, model, out, "array<double>", checked, **options)


def judge(df: DataFrame, text: str, model: Model, out: str = "judge_json", **options) -> DataFrame:
    """Judgements as JSON text, for ``quality.judge_averages``, which counts those that break the rubric."""

    def checked(value: str, answer: Any) -> str:
        if not isinstance(answer, str):
            raise TypeError("a judgement is a JSON text")
        return answer

    return apply(df, text, model, out, "string", checked, **options)


def failures(done: DataFrame) -> DataFrame:
    """Rows and errors by kind, for the run's report."""
    kind = F.split_part("error", F.lit(":"), F.lit(1))
    return done.groupBy(F.coalesce(kind, F.lit("none")).alias("error")).agg(F.count("*").alias("n"))
