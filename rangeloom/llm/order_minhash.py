"""Order MinHash fingerprints, sensitive to edit distance; DataFrame functions only.

A text's tokens are its words; a run of over :data:`TOKEN_CHARS` characters without a space
is one token per character, so that an edit moves nothing but its own place. They make k-mers
of :data:`KMER` tokens, each numbered by its occurrences; k-mer and number are hashed. Each of
:data:`BINS` points of the hash range selects the :data:`PICKED` k-mers that come next, going
on at the start after the end, puts them back into text order and hashes that tuple. So every
point has a tuple with an order, however short the text. Two fingerprints are alike by the
share of points whose tuples are equal.

All steps are linear or a sort per text, over arrays within one row; no rows are exploded.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KMER = 3
BINS = 64
PICKED = 3
TOKEN_CHARS = 24
#: Bits of a hash given up for a k-mer's place; in a text of over 16 million tokens places repeat.
PLACE_BITS = 24
#: Rows of a range of doc_id in which documents find their neighbours, and ranges at most; the
#: bounds are the driver's, 8 bytes each. With more rows than that, ranges are larger.
RANGE_ROWS = 4_000
MOST_RANGES = 100_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _runs(items: Column, same: Callable[[Column], Column]) -> Column:
    """Slices of the array ``items`` where neighbours have equal ``same``."""

    def cut(starts: Column) -> Column:
        return F.transform(
            starts,
            lambda start, j: F.slice(items, start + 1, F.coalesce(F.get(starts, j + 1), F.size(items)) - start),
        )

    places = F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(F.array().cast("array<int>"))
    first = lambda i: (i == 0) | (same(F.get(items, i)) != same(F.get(items, i - 1)))
    return _let(F.filter(places, first), cut)


def _hash_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(-1 << PLACE_BITS))


def _packed(h: Column, place: Column) -> Column:
    """Hash and place as one long, which sorts by the hash first."""
    return _hash_of(h).bitwiseOR(place.cast("long").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))


def _bin(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, 64 - int(math.log2(BINS)))


def signature(text: Column) -> Column:
    """The tuples of a text (not null) as ``array<bigint>``, one per point; none without tokens."""
    tokens = F.regexp_extract_all(text, F.lit(rf"(?<!\S)\S{{1,{TOKEN_CHARS}}}(?!\S)|\S"), F.lit(0))
    place_of = lambda e: e.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

    def kmers(t: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(t) - KMER, F.lit(0)))
        # Past the end a token is null, which a hash passes over: a short text is one k-mer.
        hashed = F.transform(places, lambda i: _packed(F.xxhash64(*[F.get(t, i + k) for k in range(KMER)]), i))
        return F.when(F.size(t) > 0, F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>"))

    def numbered(items: Column) -> Column:
        """A first occurrence keeps its k-mer's hash, the others hash their number into it."""
        firsts = F.filter(items, lambda e, i: (i == 0) | (_hash_of(F.get(items, i - 1)) != _hash_of(e)))
        later = lambda e, o: _packed(F.xxhash64(_hash_of(e), o), place_of(e))

        def with_later(first: Column) -> Column:
            number = lambda again: F.transform(_runs(again, _hash_of), lambda run: F.transform(run, later))
            rest = _let(F.array_except(items, first), number)
            return F.when(F.size(first) == F.size(items), items).otherwise(F.sort_array(F.concat(first, F.flatten(rest))))

        return _let(firsts, with_later)

    def ordered(items: Column) -> Column:
        """Bins are of unsigned hashes: negative ones come last."""
        return F.concat(F.filter(items, lambda e: e >= 0), F.filter(items, lambda e: e < 0))

    def smallest(items: Column) -> Column:
        """All that a point can select: the first of each bin."""
        return F.filter(items, lambda e, i: (i < PICKED) | (_bin(F.get(items, i - PICKED)) != _bin(e)))

    def tuples(picked: Column) -> Column:
        n = F.size(picked)
        bin_of = lambda i: F.coalesce(_bin(F.get(picked, i)).cast("int"), F.lit(-1))
        # Where each point's first k-mer is: a k-mer serves the points after the one before it.
        firsts = F.flatten(F.transform(picked, lambda _, i: F.array_repeat(i, bin_of(i) - bin_of(i - 1))))
        starts = F.concat(firsts, F.array_repeat(F.lit(0), F.lit(BINS - 1) - bin_of(n - 1)))

        def one(start: Column) -> Column:
            chosen = [F.get(picked, (start + k) % n) for k in range(PICKED)]
            in_order = F.sort_array(F.array(*[F.struct(place_of(e).alias("at"), _hash_of(e).alias("h")) for e in chosen]))
            return F.xxhash64(F.transform(in_order, lambda e: e["h"]))

        return F.when(n > 0, F.transform(starts, one)).otherwise(F.array().cast("array<bigint>"))

    return _let(tokens, lambda t: _let(kmers(t), lambda k: _let(numbered(k), lambda h: _let(ordered(h), lambda o: _let(smallest(o), tuples)))))


def as_text(sig: Column) -> Column:
    """A signature as a string: sixteen hex digits for each point."""
    return F.array_join(F.transform(sig, lambda e: F.lpad(F.hex(e), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """How alike two signatures are, from 0 to 1; 1 if both are empty.

    The share of equal points is about the share of common k-mers to the power of
    :data:`PICKED`, less where their order differs, so the root of that is taken.
    """
    equal = F.size(F.filter(a, lambda e, i: e == F.get(b, i)))
    share = F.when(F.size(a) == F.size(b), equal / F.greatest(F.size(a), F.lit(1))).otherwise(0.0)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.pow(share, F.lit(1 / PICKED)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns) with ``fingerprint`` of ``text``; a null text is an empty one.

    Texts without tokens have the empty fingerprint. Equal texts have equal fingerprints.
    """
    return docs.withColumn("fingerprint", as_text(signature(F.coalesce(F.col("text"), F.lit("")))))


def _bounds_upto(cut: Column, n: int, less: bool) -> Column:
    """How many of the ``n`` sorted bounds are at most (or less than) doc_id, by halving."""
    key, steps = F.col("doc_id"), F.sequence(F.lit(1), F.lit(max(1, (n + 1).bit_length())))

    def half(s: Column, _: Column) -> Column:
        middle = F.floor((s["a"] + s["b"]) / 2).cast("long")
        at = F.get(cut, middle.cast("int"))
        right = at < key if less else at <= key
        moved = F.when(right, F.struct((middle + 1).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), middle.alias("b")))
        return F.when(s["a"] < s["b"], moved).otherwise(s)

    first = F.struct(F.lit(0).cast("long").alias("a"), F.lit(n).cast("long").alias("b"))
    return F.aggregate(steps, first, half, lambda s: s["a"])


def with_next(docs: DataFrame, derive: Callable[[DataFrame], DataFrame], carried: list[str]) -> DataFrame:
    """``derive(docs)`` with columns ``carried`` of the next row in descending doc_id as ``next_*``.

    The last row's next is the first. Rows of equal ids are ordered by the hash of their
    text; null ids come last. Rows are cut into ranges at quantiles of doc_id, and those of
    an id or of no id, if they are many, by that hash, so no task sorts all; a range's last
    row takes its neighbour from a table of the ranges' first rows.
    """
    size, n_null = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    ranges = min(MOST_RANGES, math.ceil((size - n_null) / RANGE_ROWS))
    bounds: list[int] = []
    if ranges > 1:
        shares = [k / ranges for k in range(1, ranges)]
        bounds = sorted(docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * ranges)).alias("b")).first()["b"])
    cut = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    # From 0 to 1 as the hash goes from the least to the greatest.
    spread = lambda of: F.floor((F.xxhash64("text").cast("double") / F.lit(2.0**64) + 0.5) * of)
    upto, below_it = _bounds_upto(cut, len(bounds), False), _bounds_upto(cut, len(bounds), True)
    own = upto - F.least(upto - below_it, spread(upto - below_it + 1))
    pieces = max(1, min(MOST_RANGES, math.ceil(n_null / RANGE_ROWS)))
    part = F.when(F.col("doc_id").isNull(), F.lit(-1) - F.least(F.lit(pieces - 1), spread(F.lit(pieces)))).otherwise(own).cast("long")
    within = Window.partitionBy("__part").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    placed = docs.withColumn("__part", part)
    led = derive(placed).withColumn("__next", F.lead(F.struct(*carried)).over(within))
    firsts = derive(placed.withColumn("__rank", F.row_number().over(within)).where("__rank = 1"))
    # One row per range: the range that comes after it, and that one's first row.
    below = Window.orderBy(F.col("__part").desc())
    after = placed.select("__part").distinct().select(
        F.col("__part").alias("__of"),
        F.coalesce(F.lead("__part").over(below), F.max("__part").over(Window.partitionBy())).alias("__after"),
    )
    heads = after.join(
        firsts.select(F.col("__part").alias("__after"), F.struct(*carried).alias("__head")), "__after"
    ).select("__of", "__head")
    last = (F.col("__part") == F.col("__of")) & F.col("__next").isNull()
    following = F.coalesce(F.col("__next"), F.col("__head"))
    return led.join(heads, last, "left").select(
        *[c for c in led.columns if not c.startswith("__")], *[following[c].alias(f"next_{c}") for c in carried]
    )


def edit_report(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has the last third of the characters (rounded down) replaced by the
    first as many of the next document in descending doc_id, after the last the first; a
    shorter next document gives all it has. Reads ``doc_id, text``; a null text is empty.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. A single row is its own next. An empty table gives no rows.
    """
    own = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - third), F.col("next_text").substr(F.lit(1), third))
    rows = with_next(own, lambda d: d.withColumn("sig", signature(F.col("text"))), ["text", "sig"]).select(
        "doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited")
    )
    rows = rows.withColumn("edited_sig", signature(F.col("edited")))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
