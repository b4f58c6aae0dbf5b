"""Secret scan: known shapes, and candidates with a high sliding-window entropy.

Known shapes are patterns. Beyond these, candidate strings (long runs of one
character class) are read by a window whose Shannon entropy is kept up by
incremental counts: a character that enters or leaves changes one count, and the
entropy by one term. Overlapping windows at or above the class's threshold join
into one span. Candidates on the allow-list are left out. Plain DataFrame
functions throughout, row by row: no shuffle, no Python.

Positions are code points, counted from the lengths of the texts between matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import prefix_sums, table

# The known shapes.
ASSIGN = (r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24


@dataclass(frozen=True)
class CharacterClass:
    """Candidates are runs of ``members`` (part of a pattern's class) of ``least`` or more."""

    kind: str
    members: str
    least: int
    window: int
    bits: float


CLASSES = (
    CharacterClass("entropy_hex", "0-9a-fA-F", 24, 24, 3.0),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 24, 4.0),
)
#: A candidate that one of these finds is no secret: words, paths and names in words,
#: numbers, one repeated character, identifiers, digests that say so. No group is
#: repeated without bound: the engine would recurse once per repetition.
ALLOWED = (
    r"^[A-Za-z/_=-]+$",
    r"^[0-9]+$",
    r"^(.)\1+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^sha(?:1|256|384|512)-",
)
#: Parts of a span, between separators, that say they are examples. A span is left out
#: if its other parts together are shorter than a candidate.
SEPARATORS = r"[/_=-]+"
EXAMPLES = r"(?i)example|sample|placeholder|dummy"

_EMPTY = "array<struct<start:bigint,end:bigint>>"
# Codes '+' to 'z' hold every character of a candidate.
_FIRST, _LAST = ord("+"), ord("z")
_SCALE = 1 << 30


def _found(text: Column, pattern: str, keep=None, group: int | None = None) -> Column:
    """Spans (start, end) of all matches, left to right; ``keep`` tests a match or a group of it."""
    lengths = lambda a: F.transform(a, lambda x: F.length(x).cast("long"))
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = hits if group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    # Up to the end of match i: all gaps and all matches up to it.
    sizes = F.zip_with(lengths(F.slice(F.split(text, pattern), 1, F.greatest(F.size(hits), F.lit(0)))), lengths(hits),
                       lambda gap, hit: gap + hit)
    spans = F.zip_with(prefix_sums(sizes), F.arrays_zip(hits.alias("hit"), tested.alias("tested")),
                       lambda end, m: F.struct((end - F.length(m["hit"])).alias("start"), end.alias("end"),
                                               m["hit"].alias("hit"), m["tested"].alias("tested")))
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["tested"]))
    return spans


def _known(text: Column, pattern: str, least: int, group: int | None = None) -> Column:
    spans = F.transform(_found(text, pattern, lambda m: F.length(m) >= least, group),
                        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_EMPTY))


#: Positions of a candidate are read in blocks of this many; spans of earlier blocks aren't copied at every step.
_STEPS = 512


def _joined_to(spans: Column, first: Column, end: Column) -> Column:
    """Sorted spans and one more behind them, as one span where they touch."""
    last = F.try_element_at(spans, F.lit(-1))
    touches = F.coalesce(last["end"] >= first, F.lit(False))
    kept = F.when(touches, F.slice(spans, 1, F.size(spans) - 1)).otherwise(spans)
    return F.concat(kept, F.array(F.struct(F.when(touches, last["start"]).otherwise(first).alias("start"), end.alias("end"))))


def _dense(candidate: Column, offset: Column, cls: CharacterClass) -> Column:
    """Spans of the windows of a candidate whose entropy reaches the class's threshold, joined.

    State: a count per character code, several packed into a long; the sum of
    c*log2(c) over the counts as a scaled whole number (so that adding and taking
    away leave no error); spans. A character that enters or leaves is one shift and
    one addition.
    """
    w = cls.window
    bits = (w + 1).bit_length()
    each = 62 // bits
    term = F.array(*[F.lit(round(c * math.log2(c) * _SCALE) if c else 0) for c in range(w + 2)])
    most = int((math.log2(w) - cls.bits) * w * _SCALE)  # entropy >= bits, said of the sum
    n_longs = -(-(_LAST - _FIRST + 1) // each)
    n = F.length(candidate)

    def count(longs: Column, code: Column) -> Column:
        packed = F.get(longs, F.floor(code / each).cast("int"))
        return F.call_function("shiftright", packed, (code % each) * bits).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")

    def changed(longs: Column, enters: Column, leaves: Column) -> Column:
        def one(code: Column, k: Column) -> Column:
            return F.when(F.floor(code / each) == k, F.call_function("shiftleft", F.lit(1).cast("long"), (code % each) * bits)).otherwise(0)

        return F.transform(longs, lambda x, k: x + one(enters, k) - F.when(leaves >= 0, one(leaves, k)).otherwise(0))

    def step(codes: Column):
        def run(s: Column, i: Column) -> Column:
            enters, leaves = F.get(codes, i), F.when(i >= w, F.get(codes, i - w)).otherwise(-1)
            c_in, c_out = count(s["longs"], enters), count(s["longs"], leaves)
            change = F.when(enters == leaves, 0).otherwise(
                F.get(term, c_in + 1) - F.get(term, c_in)
                + F.when(leaves >= 0, F.get(term, c_out - 1) - F.get(term, c_out)).otherwise(0))
            total = s["sum"] + change
            longs = F.when(enters == leaves, s["longs"]).otherwise(changed(s["longs"], enters, leaves))
            spans = F.when((i >= w - 1) & (total <= most), _joined_to(s["spans"], offset + i - (w - 1), offset + i + 1))
            return F.struct(longs.alias("longs"), total.alias("sum"), F.coalesce(spans, s["spans"]).alias("spans"))
        return run

    def block(codes: Column):
        def run(s: Column, b: Column) -> Column:
            places = F.sequence(b * _STEPS, F.least(n, (b + 1) * _STEPS) - 1)
            own = F.struct(s["longs"].alias("longs"), s["sum"].alias("sum"), F.array().cast(_EMPTY).alias("spans"))
            done = F.aggregate(places, own, step(codes))
            # Bound to a name, as an expression used twice would run twice.
            return F.get(F.transform(F.array(done), lambda d: F.struct(
                d["longs"].alias("longs"), d["sum"].alias("sum"), F.when(F.size(d["spans"]) == 0, s["spans"]).otherwise(F.concat(
                    _joined_to(s["spans"], F.get(d["spans"], 0)["start"], F.get(d["spans"], 0)["end"]),
                    F.slice(d["spans"], 2, F.size(d["spans"])))).alias("spans"))), 0)
        return run

    start = F.struct(F.array_repeat(F.lit(0).cast("long"), n_longs).alias("longs"), F.lit(0).cast("long").alias("sum"),
                     F.array().cast(_EMPTY).alias("spans"))
    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c) - _FIRST)
    blocks = F.sequence(F.lit(0), F.floor((n - 1) / _STEPS).cast("int"))
    return F.get(F.transform(F.array(codes), lambda c: F.aggregate(blocks, start, block(c), lambda s: s["spans"])), 0)


def _no_example(span: Column, least: int, examples: str) -> Column:
    """Whether the parts of a span that don't say they are examples are as long as a candidate."""
    parts = F.filter(F.split(span, SEPARATORS), lambda p: ~p.rlike(examples))
    return ~span.rlike(examples) | (F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p)) >= least)


def _entropy(text: Column, cls: CharacterClass, allowed: tuple[str, ...], examples: str) -> Column:
    pattern = f"(?<![{cls.members}])[{cls.members}]{{{cls.least},}}"

    def keep(c: Column) -> Column:
        out = F.lit(True)
        for a in allowed:
            out = out & ~c.rlike(a)
        return out

    def dense(s: Column) -> Column:
        def own(x: Column) -> Column:
            return F.substr(s["hit"], (x["start"] - s["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int"))

        return F.filter(_dense(s["hit"], s["start"], cls), lambda x: _no_example(own(x), cls.least, examples))

    spans = F.flatten(F.transform(_found(text, pattern, keep), dense))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_EMPTY))


def scan_secrets(docs: DataFrame, classes: tuple[CharacterClass, ...] = CLASSES,
                 allowed: tuple[str, ...] = ALLOWED, examples: str = EXAMPLES) -> DataFrame:
    """The input rows with ``secret_spans``: array of (start, kind_order, end, kind), sorted by start.

    Kinds: assign, access, hex, then one per character class; the last ones add
    to the known shapes, which the allow-list never touches. ``allowed`` is tested on
    whole candidates, ``examples`` on the parts of a dense span. Null and empty texts
    have no spans; text and candidates of any length are scanned whole, in linear
    time. Spans of one kind
    don't overlap, those of two kinds may. A column of ``docs`` that is already
    called ``secret_spans`` is replaced. Rows are never merged or dropped.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    known = (("assign", _known(text, ASSIGN, ASSIGN_LEAST, 1)), ("access", _known(text, ACCESS, ACCESS_LEAST)),
             ("hex", _known(text, f"[0-9a-f]{{{HEX_LEAST},}}", HEX_LEAST)))
    kinds = [*known, *((c.kind, _entropy(text, c, allowed, examples)) for c in classes)]

    def tagged(spans: Column, order: int, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(order).alias("kind_order"), s["end"].alias("end"),
            F.lit(kind).alias("kind")))

    parts = [tagged(spans, i, kind) for i, (kind, spans) in enumerate(kinds)]
    return docs.withColumn("secret_spans", F.array_sort(F.concat(*parts)))


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` in ``text``, and ``n_chars`` brought up to date.

    Overlapping spans become one mark. Texts without spans, null ones included,
    stay as they are.
    """
    found = scan_secrets(docs.select(F.struct("*").alias("row"), "text"), **options)
    pieces = F.aggregate(
        "secret_spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(s["parts"], F.array(
                F.col("text").substr((s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark))))
            .otherwise(s["parts"]).alias("parts")))
    rest = F.expr("substring(text, cast(pieces.at + 1 as int))")
    any_ = F.col("pieces").isNotNull()
    masked = (found.withColumn("pieces", F.when(F.size("secret_spans") > 0, pieces))
              .select("row", "pieces", F.concat(F.array_join(F.col("pieces.parts"), ""), rest).alias("masked")))
    new = {"text": F.when(any_, F.col("masked")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(any_, F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))
    return masked.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")

    def count(i: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind_order"] == i)).cast("long")

    base = F.filter(spans, lambda s: s["kind_order"] < 3)
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))
