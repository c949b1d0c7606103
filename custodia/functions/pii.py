"""Personal-data detection and redaction as column expressions.

Everything here stays inside the JVM: a cheap regex test skips texts without a
hit, and only texts with hits pay for the array folds that compute offsets.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: entity types in tie order, confidences, patterns ---------
PATTERNS: dict[str, str] = {
    "EMAIL": r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}",
    "SSN": r"\b\d{3}-\d{2}-\d{4}\b",
    "PHONE": r"(?:\+?1[\s\-.]?)?\(?\d{3}\)?[\s\-.]?\d{3}[\s\-.]?\d{4}\b",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "CREDIT_CARD": r"\b(?:\d[ \-]?){13,19}\b",
    "DATE_OF_BIRTH": r"\b(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4})\b",
}
CONFIDENCE = {
    "PERSON": 0.85, "EMAIL": 1.0, "SSN": 1.0, "PHONE": 0.95,
    "CREDIT_CARD": 1.0, "IP_ADDRESS": 1.0, "DATE_OF_BIRTH": 0.80,
}
RANK = {"EMAIL": 0, "SSN": 1, "PHONE": 2, "IP_ADDRESS": 3, "CREDIT_CARD": 4, "PERSON": 5, "DATE_OF_BIRTH": 6}
DEFAULT_TYPES = ["EMAIL", "SSN", "PHONE", "IP_ADDRESS", "CREDIT_CARD"]
TOKEN_REGEX = r"<PII_TOKEN_[0-9A-F]{8,32}>"
# --- end of fixed values ----------------------------------------------------

DEFAULT_SALT = "custodia"
# decimal digits of other scripts, which \d also matches
_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode)) if unicodedata.category(c) == "Nd")
_DIGIT_VALUES = "".join(str(unicodedata.digit(c)) for c in _OTHER_DIGITS)
_SPAN = "struct<start:int,end:int,value:string>"
_ENTITY = "struct<start:int,neg_conf:double,rank:int,end:int,type:string,value:string>"
_GROUP = 64
_BLOCK = 512


def _empty(array_type: str) -> Column:
    return F.expr(f"cast(array() as {array_type})")


def java_pattern(entity_type: str) -> str:
    """``(?U)`` makes \\d, \\s and \\b follow Unicode, as the detector's rules expect."""
    return "(?U)" + PATTERNS[entity_type]


def _scan(items: Column, state: Column, step, emitted: str) -> Column:
    """Walk an array in order with a state; ``step(state, item)`` gives the new state and one output.

    Appending to an array copies it, so outputs are gathered in groups and joined
    at the end: a text with very many hits takes linear, not quadratic, time.
    """
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _GROUP).cast("int")), lambda g: F.slice(items, g * _GROUP + 1, _GROUP)
    )

    def inner(acc: Column, item: Column) -> Column:
        new_state, out = step(acc["s"], item)
        return F.struct(new_state.alias("s"), F.concat(acc["out"], F.array(out)).alias("out"))

    def outer(acc: Column, group: Column) -> Column:
        walked = F.aggregate(group, F.struct(acc["s"].alias("s"), _empty(f"array<{emitted}>").alias("out")), inner)
        # bound once by the transform, used twice
        return F.transform(
            F.array(walked), lambda r: F.struct(r["s"].alias("s"), F.concat(acc["outs"], F.array(r["out"])).alias("outs"))
        )[0]

    start = F.struct(state.alias("s"), _empty(f"array<array<{emitted}>>").alias("outs"))
    scanned = F.aggregate(groups, start, outer, lambda acc: F.flatten(acc["outs"]))
    return F.when(F.size(items) > 0, scanned).otherwise(_empty(f"array<{emitted}>"))


def _located(gaps: Column, hits: Column) -> Column:
    """Offsets of ``hits``: they alternate with ``gaps``, so a running sum of lengths is enough."""
    pairs = F.filter(
        F.zip_with(gaps, hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("value"))),
        lambda p: p["value"].isNotNull(),
    )

    def step(pos: Column, p: Column) -> tuple[Column, Column]:
        start = pos + p["gap"]
        end = start + F.length(p["value"])
        return end, F.struct(start.alias("start"), end.alias("end"), p["value"].alias("value"))

    # the pairs are bound once: the scan refers to them for every group
    return F.transform(F.array(pairs), lambda x: _scan(x, F.lit(0), step, _SPAN))[0]


def _parts(text: Column, pat: Column) -> Column:
    """What a pattern leaves and what it finds; NULL for a text without a match."""
    return F.when(
        F.regexp(text, pat),
        F.struct(F.split(text, pat, -1).alias("gaps"), F.regexp_extract_all(text, pat, F.lit(0)).alias("hits")),
    )


def spans(text: Column, pattern: str | Column) -> Column:
    """All non-overlapping matches with 0-based code-point offsets."""
    pat = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.transform(F.array_compact(F.array(_parts(text, pat))), lambda p: _located(p["gaps"], p["hits"]))
    return F.flatten(found)


def digits_only(value: Column) -> Column:
    """ASCII digits of a card number, without its spaces and hyphens."""
    return F.translate(value, _OTHER_DIGITS + " -", _DIGIT_VALUES)


def luhn_valid(digits: Column) -> Column:
    """Luhn checksum of a digit string; every second digit from the right is doubled."""
    reversed_digits = F.split(F.reverse(digits), "")

    def weigh(ch: Column, i: Column) -> Column:
        d = ch.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2)

    weights = F.transform(F.filter(reversed_digits, lambda c: c != ""), weigh)
    return F.aggregate(weights, F.lit(0), lambda a, b: a + b) % 10 == 0


def is_card(value: Column) -> Column:
    digits = digits_only(value)
    # CASE keeps the order: the checksum only runs when the length fits.
    return F.when(F.length(digits).between(13, 19), luhn_valid(digits)).otherwise(F.lit(False))


def pattern_hits(text: Column, entity_type: str) -> Column:
    """Raw hits of one pattern; card numbers must also pass the checksum."""
    found = spans(text, java_pattern(entity_type))
    if entity_type == "CREDIT_CARD":
        found = F.filter(found, lambda e: is_card(e["value"]))
    return found


def candidates(text: Column, types: list[str] | None = None, extra: Column | None = None) -> Column:
    """Union of all pattern hits, plus ``extra`` entities found elsewhere (an NER hook)."""
    types = DEFAULT_TYPES if types is None else types
    none = F.lit(None)

    def parts(wanted: list[str], test: Column) -> Column:
        """Parts of the wanted patterns, if the cheap ``test`` holds."""
        found = [
            F.struct(
                F.lit(t).alias("type"), F.lit(-CONFIDENCE[t]).alias("neg_conf"), F.lit(RANK[t]).alias("rank"),
                _parts(text, F.lit(java_pattern(t))).alias("parts"),
            )
            for t in wanted
        ]
        return F.when(test, F.array(*found)).otherwise(none)

    tested = []
    if "EMAIL" in types:
        tested.append(parts(["EMAIL"], F.contains(text, F.lit("@"))))
    numeric = [t for t in types if t != "EMAIL"]
    if numeric:
        # most texts hold no digit at all: one test instead of one per pattern
        tested.append(parts(numeric, F.regexp(text, F.lit(r"\p{Nd}"))))
    hit = F.filter(F.flatten(F.array_compact(F.array(*tested))), lambda k: k["parts"].isNotNull())

    def entities_of(k: Column) -> Column:
        return F.transform(
            _located(k["parts"]["gaps"], k["parts"]["hits"]),
            lambda e: F.struct(
                e["start"].alias("start"), k["neg_conf"].alias("neg_conf"), k["rank"].alias("rank"),
                e["end"].alias("end"), k["type"].alias("type"), e["value"].alias("value"),
            ),
        )

    found = F.flatten(F.transform(hit, entities_of))
    if "CREDIT_CARD" in types:
        found = F.filter(found, lambda e: F.when(e["type"] == "CREDIT_CARD", is_card(e["value"])).otherwise(True))
    return found if extra is None else F.concat(found, F.coalesce(extra, _empty(f"array<{_ENTITY}>")))


def overlap_flags(entities: Column) -> Column:
    """Entities in text order, each with whether it is kept.

    Earliest start wins; confidence, then pattern order, break ties at one start.
    """

    def step(last: Column, e: Column) -> tuple[Column, Column]:
        keep = e["start"] >= last
        return F.when(keep, e["end"]).otherwise(last), F.struct(e.alias("e"), keep.alias("kept"))

    marked = f"struct<e:{_ENTITY},kept:boolean>"
    return F.transform(F.array(F.array_sort(entities)), lambda x: _scan(x, F.lit(-1), step, marked))[0]


def drop_overlaps(entities: Column) -> Column:
    return F.transform(F.filter(overlap_flags(entities), lambda m: m["kept"]), lambda m: m["e"])


def entities(text: Column, types: list[str] | None = None, extra: Column | None = None) -> Column:
    """Detected entities in text order, without overlaps."""
    found = candidates(text, types, extra)
    return F.transform(F.array(found), lambda c: F.when(F.size(c) > 1, drop_overlaps(c)).otherwise(c))[0]


def token_for(doc_id: Column, start: Column, salt: str = DEFAULT_SALT, width: int = 8) -> Column:
    """Opaque token per occurrence. Deterministic, so a re-run task writes the same text.

    ``width`` is its number of hex digits, 8 to 32: 8 is the form other systems know, but it can hold
    4 billion tokens only; large stores take 32.
    """
    if not 8 <= width <= 32:
        raise ValueError("a token has 8 to 32 hex digits")
    digest = F.sha2(F.concat_ws(":", F.lit(salt), doc_id.cast("string"), start.cast("string")), 256)
    return F.concat(F.lit("<PII_TOKEN_"), F.upper(F.substring(digest, 1, width)), F.lit(">"))


def with_tokens(ents: Column, doc_id: Column, salt: str = DEFAULT_SALT, width: int = 8) -> Column:
    return F.transform(
        ents,
        lambda e: F.struct(
            e["type"].alias("type"), e["value"].alias("value"), e["start"].alias("start"),
            e["end"].alias("end"), (-e["neg_conf"]).alias("confidence"),
            token_for(doc_id, e["start"], salt, width).alias("token"),
        ),
    )


def redact(text: Column, tokenised: Column) -> Column:
    """Text with every entity replaced by its token (entities ordered, not overlapping).

    Cutting out of a long text by offset walks it from its beginning, so the text
    is first split into blocks and pieces are cut out of those.
    """

    def rebuild(blocks: Column) -> Column:
        def cut(start: Column, stop: Column) -> Column:
            first, last = F.floor(start / _BLOCK).cast("int"), F.floor((stop - 1) / _BLOCK).cast("int")
            head = F.substring(F.get(blocks, first), start - first * _BLOCK + 1, stop - start)
            tail = F.substring(F.get(blocks, last), F.lit(1), stop - last * _BLOCK)
            between = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
            return F.when(stop <= start, "").when(first == last, head).otherwise(F.concat(head, between, tail))

        def piece(e: Column, i: Column) -> Column:
            prev = F.when(i == 0, F.lit(0)).otherwise(F.get(tokenised, i - 1)["end"])
            return F.concat(cut(prev, e["start"]), e["token"])

        last_end = F.element_at(tokenised, -1)["end"]
        return F.concat(F.array_join(F.transform(tokenised, piece), ""), cut(last_end, F.length(text)))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    replaced = F.transform(F.array(blocks), rebuild)[0]
    return F.when(F.size(tokenised) > 0, replaced).otherwise(text)


def tokens_in(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_REGEX), F.lit(0))
