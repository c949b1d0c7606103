"""Detection and redaction over tables of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.functions import pii
from custodia.functions.text import unnest


def detect(
    df: DataFrame, text: str, doc_id: str, types: list[str] | None = None,
    salt: str = pii.DEFAULT_SALT, extra: Column | None = None, out: str = "entities", token_width: int = 8,
) -> DataFrame:
    """Add the array of entities found in ``text``; row-local, no shuffle."""
    found = df.withColumn("__found", pii.entities(F.col(text), types, extra))
    return found.withColumn(out, pii.with_tokens(F.col("__found"), F.col(doc_id), salt, token_width)).drop("__found")


def redact(df: DataFrame, text: str, doc_id: str, out: str = "redacted", **options) -> DataFrame:
    """Add ``entities`` and the text with each entity replaced by its token."""
    return detect(df, text, doc_id, **options).withColumn(out, pii.redact(F.col(text), F.col("entities")))


def entity_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per entity of ``entities``, with its 0-based position in the text."""
    return unnest(df, keep, F.col("entities"), "e", "ord").select(
        *keep, "ord", "e.type", "e.value", "e.start", "e.end", "e.confidence", "e.token"
    )


def hit_rows(df: DataFrame, text: str, keep: list[str], entity_type: str) -> DataFrame:
    """Raw hits of one pattern, before overlaps are removed."""
    return unnest(df, keep, pii.pattern_hits(F.col(text), entity_type), "h").select(
        *keep, "h.value", "h.start", "h.end"
    )


def candidate_rows(df: DataFrame, text: str, keep: list[str], types: list[str]) -> DataFrame:
    """All hits of all patterns, each marked whether overlap removal keeps it."""
    found = df.withColumn("__all", pii.candidates(F.col(text), types))
    return unnest(found, keep, pii.overlap_flags(F.col("__all")), "m").select(
        *keep, "m.e.type", "m.e.value", "m.e.start", "m.e.end", "m.kept"
    )


#: Pieces of a text or name: runs of letters, numbers and spaces, and single signs. Put together they are the text again.
NAME_PIECE = r"\p{L}+|\p{N}+|\s+|[^\p{L}\p{N}\s]"
#: Bits of a filter over the gazetteer, 64 KB; what is sent to every task does not grow with the gazetteer. With more than
#: some ten thousand names more texts are looked at twice, results stay the same.
FILTER_BITS = 1 << 19


def _filter(keys: DataFrame, key: str, bits: int) -> Column:
    """A Bloom filter of ``key``, two bits a value, as a constant array of longs.

    The driver gets its words, of which there are ``bits / 64`` at most. They go into the plan as one text that the optimizer folds
    into an array: a subquery is not allowed where the filter is used, and a joined column would be copied into every row.
    """
    places = keys.select(F.explode(_places(F.col(key), bits)).alias("place"))
    words = places.groupBy(F.shiftright("place", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, place & 63)")).alias("v"))
    cells = [0] * max(bits // 64, 1)
    for r in words.collect():
        cells[r.w] = r.v
    return F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")


def _places(value: Column, bits: int) -> Column:
    h = F.xxhash64(value)
    return F.array(h.bitwiseAND(F.lit(bits - 1)).cast("int"), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)).cast("int"))


def _may_hold(cells: Column, value: Column, bits: int) -> Column:
    def is_set(place: Column) -> Column:
        return F.getbit(F.get(cells, F.shiftright(place, 6)), place.bitwiseAND(F.lit(63))) == 1

    return F.forall(_places(value, bits), is_set)


def _name_pattern(name: Column) -> Column:
    """The name as it stands, not going on in a word or number.

    A hyphen or apostrophe between letters belongs to the word, except the one of a possessive ``'s``.
    """
    quoted = F.concat(F.lit(r"\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    before = F.when(name.rlike(r"^\p{L}"), r"(?<![\p{L}\p{N}])(?<!\p{L}['-])").otherwise(r"(?<![\p{L}\p{N}])")
    inside = F.when(name.rlike(r"\p{L}$"), r"(?!-\p{L})(?!'(?!s(?!\p{L}))\p{L})").when(name.rlike(r"\p{N}$"), r"(?!\p{N})").otherwise("")
    after = F.concat(F.lit(r"(?!\p{L})"), inside)
    return F.concat(before, quoted, after)


def person_hits(docs: DataFrame, text: str, doc_id: str, names: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Names found in texts, exactly as the gazetteer writes them, with offsets.

    Names may have any number of words, and any signs, digits and spaces; a blank name is none. Two filters over the gazetteer, of
    fixed size, go to every task: one over the names' first words, one over whole names. A name is put together only at a piece that
    may begin one, and offsets are looked for only if the whole may be a name. So row by row, without a shuffle, only
    hits leave the scan; an exact join with the gazetteer then drops what the filters let through by chance.
    Hits of one name in a text do not overlap; those of different names are left to the overlap rule.
    """
    known = names.select("name").where(F.col("name").rlike(r"\S")).distinct()
    cut = known.withColumn("p", F.regexp_extract_all("name", F.lit(NAME_PIECE), F.lit(0)))
    blank = r"^\s"
    # a name that begins with spaces is found by its first other piece; the gazetteer is read three times here
    lead = F.when(F.col("p")[0].rlike(blank), 1).otherwise(0)
    parts = cut.select("name", F.get("p", lead).alias("word"), F.struct(lead.alias("lead"), F.size("p").alias("n")).alias("shape"))
    firsts, wholes = _filter(parts, "word", bits), _filter(known, "name", bits)
    # as many as there are different numbers of pieces
    shapes = F.array(*[F.struct(F.lit(r.lead).alias("lead"), F.lit(r.n).alias("n")) for r in parts.select("shape.*").distinct().collect()]).cast("array<struct<lead:int,n:int>>")

    def bound(value: Column, use) -> Column:
        return F.transform(F.array(value), use)[0]

    def names_at(pieces: Column, i: Column, whole: Column, sizes: Column) -> Column:
        def name(s: Column) -> Column:
            return F.when(i >= s["lead"], F.array_join(F.slice(pieces, F.greatest(i - s["lead"], F.lit(0)) + 1, s["n"]), ""))

        return F.filter(F.transform(sizes, name), lambda n: F.when(n.isNull(), False).otherwise(_may_hold(whole, n, bits)))

    def names_in(cells: Column, whole: Column, sizes: Column) -> Column:
        def of(pieces: Column) -> Column:
            begins = F.filter(F.transform(pieces, lambda p, i: F.when((p != " ") & _may_hold(cells, p, bits), i)), lambda i: i.isNotNull())
            return F.array_distinct(F.flatten(F.transform(begins, lambda i: names_at(pieces, i, whole, sizes))))

        return bound(F.regexp_extract_all(F.col(text), F.lit(NAME_PIECE), F.lit(0)), of)

    here = names_in(firsts, wholes, shapes)
    spots = F.flatten(F.transform(here, lambda n: F.transform(pii.spans(F.col(text), _name_pattern(n)), lambda s: F.struct(n.alias("name"), s["start"].alias("start"), s["end"].alias("end")))))
    found = unnest(docs.where(F.col(text).isNotNull()), [doc_id], spots, "__h").select(doc_id, "__h.*")
    return found.join(known, "name").select(
        doc_id, F.col("name").alias("value"), "start", "end", F.lit(pii.CONFIDENCE["PERSON"]).alias("confidence")
    )


def detect_with_names(docs: DataFrame, text: str, doc_id: str, names: DataFrame, **options) -> DataFrame:
    """``detect`` with the gazetteer's names as further candidates of the overlap rule."""
    entity = F.struct(
        "start", (-F.col("confidence")).alias("neg_conf"), F.lit(pii.RANK["PERSON"]).alias("rank"), "end",
        F.lit("PERSON").alias("type"), "value",
    )
    # as many entries as the text holds names
    people = person_hits(docs, text, doc_id, names).groupBy(doc_id).agg(F.collect_list(entity).alias("__people"))
    return detect(docs.join(people, doc_id, "left"), text, doc_id, extra=F.col("__people"), **options).drop("__people")


def type_counts(entities: DataFrame) -> DataFrame:
    """Entities and distinct values per type; partial sums combine before the shuffle."""
    return entities.groupBy("type").agg(
        F.count("*").alias("n"), F.countDistinct("value").alias("n_values")
    )


def recall(expected: DataFrame, found: DataFrame, doc_id: str) -> DataFrame:
    """Share of labelled spans that overlap a detected span of the same document.

    Detected spans do not overlap each other, so starts and ends are sorted alike: a labelled span is hit if more spans
    start before its end than end at or before its start. Both are counted along one order of all points.
    """
    label = F.lit(1).alias("label")
    points = expected.select(doc_id, "start", "end", label).unionByName(found.select(doc_id, "start", "end", F.lit(0).alias("label")))
    # (position, kind, +starts, +ends, label): ends count before a start at the same place, starts after an end
    rows = points.select(doc_id, "label", "start", "end", F.inline(F.when(F.col("label") == 0, F.array(
        F.struct(F.col("start").alias("at"), F.lit(2).alias("kind"), F.lit(1).alias("starts"), F.lit(0).alias("ends")),
        F.struct(F.col("end").alias("at"), F.lit(0).alias("kind"), F.lit(0).alias("starts"), F.lit(1).alias("ends")),
    )).otherwise(F.array(
        F.struct(F.col("end").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("starts"), F.lit(0).alias("ends")),
        F.struct(F.col("start").alias("at"), F.lit(1).alias("kind"), F.lit(0).alias("starts"), F.lit(0).alias("ends")),
    ))))
    order = W.partitionBy(doc_id).orderBy("at", "kind")
    counted = rows.withColumns({"n_starts": F.sum("starts").over(order), "n_ends": F.sum("ends").over(order)}).where("label = 1")
    hit = counted.groupBy(doc_id, "start", "end").agg(
        (F.max(F.when(F.col("at") == F.col("end"), F.col("n_starts"))) > F.max(F.when(F.col("at") == F.col("start"), F.col("n_ends")))).cast("int").alias("hit")
    )
    return hit.agg(
        F.count("*").alias("labelled"),
        F.sum(F.coalesce("hit", F.lit(0))).alias("found"),
        F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall"),
        (F.avg(F.coalesce("hit", F.lit(0))) >= 0.99).alias("passed"),
    )
