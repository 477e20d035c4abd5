"""SimHash fingerprints and the search for all that lie within a Hamming radius, in DataFrame
functions only.

A term is a word (between spaces and line breaks) with the word after it; it votes with its
weight, the length of the word (up to ``HEAVIEST``), on each of 128 bits by the bits of two 64-bit hashes. A bit is set
if more than half of the weight is for it. Two votes are summed in each 64-bit number, 32 bits
apart: a text has less than 2^31 bytes, so its weights cannot overflow.

Null text counts as empty; the empty text has one term, the empty word, of weight 1. Equal texts
have equal fingerprints. Rows with a null ``doc_id`` come last in descending order; rows of one id
are ordered by the hash of their text, and identical rows in either order. An empty table gives
an empty result; further columns are left out.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.shared import id_and_text, written

BITS = 128
HEAVIEST = 32
#: Documents that a slice of the order should hold, and slices at most.
SLICE, MOST_SLICES = 2_000, 4_096
#: Ids with the rows of several slices, at most: those with over this part of all rows.
MOST_CROWDED = 1_600
_LANES = 0x0000000100000001
_LOW = 0x00000000FFFFFFFF


def _votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of votes for every row of ``keys, text``."""
    words = F.split(F.translate("text", "\n\t\r", "   "), " ")
    terms = F.transform("words", lambda w, i: F.struct(
        F.xxhash64(w, F.get("words", i + 1)).alias("h"), F.xxhash64(F.lit(7), w, F.get("words", i + 1)).alias("g"),
        F.least(F.greatest(F.length(w), F.lit(1)), F.lit(HEAVIEST)).cast("long").alias("w"),
    ))
    rows = texts.withColumn("words", words).select(*keys, F.inline(terms))
    sums = [F.sum(F.shiftrightunsigned(c, k).bitwiseAND(F.lit(_LANES)) * F.col("w")).alias(f"{c}{k}") for c in ("h", "g") for k in range(32)]
    return rows.groupBy(*keys).agg(F.sum("w").alias("total"), *sums)


def _half(c: str) -> Column:
    """64 bits of a fingerprint from the sums of votes."""
    bits = []
    for k in range(32):
        for lane, at in ((F.col(f"{c}{k}").bitwiseAND(F.lit(_LOW)), k), (F.shiftrightunsigned(f"{c}{k}", 32), k + 32)):
            bits.append(F.shiftleft((lane * 2 > F.col("total")).cast("long"), at))
    while len(bits) > 1:  # a balanced tree
        bits = [bits[i].bitwiseOR(bits[i + 1]) if i + 1 < len(bits) else bits[i] for i in range(0, len(bits), 2)]
    return bits[0]


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, f1, f2``: both halves of the fingerprint of every row of ``keys, text``. The keys
    must tell rows apart; no shuffle is needed where rows are already dealt out by some of them."""
    return _votes(texts, keys).select(*keys, _half("h").alias("f1"), _half("g").alias("f2"))


def as_text(f1: str, f2: str) -> Column:
    return F.concat(F.lpad(F.lower(F.hex(f1)), 16, "0"), F.lpad(F.lower(F.hex(f2)), 16, "0"))


def distance(a1: str, a2: str, b1: str, b2: str) -> Column:
    return F.bit_count(F.col(a1).bitwiseXOR(F.col(b1))) + F.bit_count(F.col(a2).bitwiseXOR(F.col(b2)))


def _slice_of(bounds: list[int], value: Column) -> Column:
    """How many of the ascending bounds lie below the value, in two steps of few comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    every = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[step - 1 :: step]])
    passed = F.size(F.filter(coarse, lambda b: b < value)) * step
    return passed + F.size(F.filter(F.slice(every, passed + 1, F.lit(step)), lambda b: b < value))


def _within(bounds: list[int], least: int, most: int, own: Column, value: Column, parts: int) -> Column:
    """Which of ``parts`` even pieces of its slice a value lies in; ascending with it."""
    lows, highs = (F.array(*[F.lit(float(b)) for b in edges]) for edges in ([least, *bounds], [*bounds, most]))
    low, high = (F.get(edges, own.cast("int")) for edges in (lows, highs))
    share = F.when(high > low, (value.cast("double") - low) / (high - low)).otherwise(0.0)
    return F.least(F.lit(parts - 1), F.greatest(F.lit(0), F.floor(share * parts))).cast("long")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``slice, place, doc_id, text, next_text, guest, copies``: every document with the text of the next
    in descending order of ``doc_id``; after the last comes the first.

    The order is cut into slices at approximate quantiles of the ids, of which at most
    ``MOST_SLICES`` reach the driver; beyond, slices are cut evenly between them. An id with the rows of
    several slices (the driver gets at most ``MOST_CROWDED`` such) has slices of its own, by ranges of the hash of
    the text, and its equal rows are one with their number in ``copies``, whose next text is the last copy's. A slice's
    first document is also a guest, last in the slice before it. ``slice, place`` tell rows apart and the rows are
    dealt out by ``slice``."""
    base = id_and_text(docs, id_col, text_col)
    size = base.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).first()
    slices = min(MOST_SLICES, max(1, -(-size["n"] // SLICE)))
    parts = max(1, -(-size["n"] // (slices * SLICE)))
    cuts = [k / slices for k in range(1, slices)]
    found = base.agg(F.percentile_approx("doc_id", cuts, 50_000)).first()[0] if cuts else None
    crowd = max(2.5 * SLICE, size["n"] / MOST_CROWDED)
    hot = {r["doc_id"]: r["count"] for r in base.groupBy("doc_id").count().filter(F.col("count") > crowd).collect()}
    bounds = sorted({*(found or []), *(k for k in hot if k is not None)})  # a crowded id is the highest of its slice
    value, tie = F.col("doc_id"), F.xxhash64("text")
    own = F.coalesce(_slice_of(bounds, value), F.lit(0)) if bounds else F.lit(0)
    own = F.when(value.isNull(), F.lit(-1)).otherwise(own).cast("long")
    piece = _within(bounds, size["least"] or 0, size["most"] or 0, own, value, parts) if parts > 1 else F.lit(0).cast("long")
    rows = base.withColumn("copies", F.lit(1).cast("long"))
    if hot:
        is_hot = reduce(Column.__or__, [value.eqNullSafe(F.lit(k).cast("long")) for k in hot])
        repeated = base.filter(is_hot).groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))
        rows = rows.filter(~is_hot).unionByName(repeated)
        many = F.coalesce(*[F.when(value.eqNullSafe(F.lit(k).cast("long")), F.lit(-(-n // SLICE))) for k, n in hot.items()]).cast("long")
        # the upper half of the hash, in the order of the signed number
        upper = F.shiftrightunsigned(tie.bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 33)
        own, piece = own * 2 + is_hot.cast("long"), F.when(is_hot, F.shiftright(upper * many, 31)).otherwise(piece)
    rows = rows.withColumn("slice", F.shiftleft(own, 24) + piece).withColumn("tie", tie)
    tops = rows.groupBy("slice").agg(F.max(F.struct("doc_id", "tie")).alias("top"))
    before = F.lag("slice").over(Window.orderBy(F.col("slice").desc()))
    tops = written(tops.select("slice", "top.*", F.coalesce(before, F.min("slice").over(Window.partitionBy(F.lit(0)))).alias("host")), "tops", slices * parts)
    same = [rows["slice"] == tops["slice"], rows["doc_id"].eqNullSafe(tops["doc_id"]), rows["tie"] == tops["tie"]]
    guests = rows.join(tops, same).select(tops["host"].alias("slice"), rows["doc_id"], rows["text"], rows["tie"], F.lit(1).alias("guest"), rows["copies"])
    order = Window.partitionBy("slice").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    both = rows.select("slice", "doc_id", "text", "tie", F.lit(0).alias("guest"), "copies").unionByName(guests)
    return both.select("slice", F.row_number().over(order).alias("place"), "doc_id", "text", F.lead("text").over(order).alias("next_text"), "guest", "copies")


def edited(text: str, next_text: str) -> Column:
    """The text with its last third replaced by as much of the next text's beginning."""
    n = F.length(text)
    third = F.floor(n / 3).cast("int")
    return F.concat(F.substring(F.col(text), F.lit(1), n - third), F.substring(F.coalesce(F.col(next_text), F.lit("")), F.lit(1), third))


def compared(docs: DataFrame, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, how alike they are, how
    alike the next document's is, and ``n_near``, the other documents within ``radius``."""
    rows = with_next(docs, id_col, text_col)
    # the next text of a copy that is not the last is its own: such copies are a row beside the last one's
    last = F.struct(F.col("next_text").alias("next_text"), F.lit(1).cast("long").alias("weight"), F.lit(1).alias("last"))
    others = F.struct(F.col("text").alias("next_text"), (F.col("copies") - 1).alias("weight"), F.lit(0).alias("last"))
    rows = rows.withColumn("n", F.explode(F.when((F.col("copies") > 1) & (F.col("guest") == 0), F.array(others, last)).otherwise(F.array(last))))
    rows = rows.select("slice", "place", "doc_id", "text", "guest", "n.*").withColumn("edited", edited("text", "next_text"))
    facts = F.struct("doc_id", "guest", "weight", "last", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    texts = rows.select("slice", "place", facts.alias("facts"), F.explode(F.array(F.struct(F.lit(0).alias("variant"), F.col("text")), F.struct(F.lit(1).alias("variant"), F.col("edited").alias("text")))).alias("t"))
    votes = fingerprints(texts.select("slice", "place", "facts", "t.variant", "t.text"), ["slice", "place", "facts", "variant"])
    own = F.struct("f1", "f2")
    pairs = votes.groupBy("slice", "place", "facts").agg(F.max(F.when(F.col("variant") == 0, own)).alias("o"), F.max(F.when(F.col("variant") == 1, own)).alias("e"))
    after = F.lead("o").over(Window.partitionBy("slice").orderBy("place", "facts.last"))
    pairs = pairs.withColumn("x", after).filter("facts.guest = 0")
    facts = pairs.select("facts.doc_id", "facts.n_chars", "facts.edited_sha256", "facts.weight", "o", "e", "x")
    facts = facts.withColumn("some", F.explode(F.expr("sequence(0, weight - 1, 10000)")))  # copies, some thousand at a time
    facts = facts.withColumn("copy", F.explode(F.expr("array_repeat(1, cast(least(10000, weight - some) as int))")))
    found = written(facts.drop("weight", "some", "copy"), "fingerprints")

    def likeness(other: str) -> Column:
        return 1 - distance("o.f1", "o.f2", f"{other}.f1", f"{other}.f2") / F.lit(float(BITS))

    near = written(neighbours(found.select("o.f1", "o.f2"), radius), "neighbours")
    joined = found.withColumns({"f1": F.col("o.f1"), "f2": F.col("o.f2")}).join(near, ["f1", "f2"], "left")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text("o.f1", "o.f2").alias("fingerprint"), as_text("e.f1", "e.f2").alias("edited_fingerprint"),
        likeness("e").alias("near_edited"), likeness("x").alias("near_next"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def _met(distinct: DataFrame, radius: int, blocks: int) -> DataFrame:
    """``a1, a2, b1, b2`` and the further columns of both sides (``a_``, ``b_`` before their names) of all
    pairs of different fingerprints ``f1, f2`` within the radius, in both orders and once in each.

    The 128 bits are cut into blocks. Two fingerprints that differ in ``radius`` bits agree in all
    but ``radius`` blocks at least, so one table for each choice of ``blocks - radius`` blocks,
    keyed by those blocks' bits, brings every pair together. Three of six blocks are 64 bits, so
    unrelated fingerprints hardly ever meet. A pair counts in the table of the first blocks in which it
    agrees: there it differs in all blocks between them."""
    if not 0 <= radius < blocks <= 64:
        raise ValueError("radius must be below the number of blocks")
    cuts = [BITS * k // blocks for k in range(blocks + 1)]

    def halves(bits: int) -> tuple[Column, Column]:
        parts = (bits & (1 << 64) - 1, bits >> 64)
        return tuple(F.lit(x - (1 << 64) if x >> 63 else x).cast("long") for x in parts)

    block = [(1 << cuts[b + 1]) - (1 << cuts[b]) for b in range(blocks)]
    choices = list(combinations(range(blocks), blocks - radius))
    keys = []
    for t, chosen in enumerate(choices):
        m1, m2 = halves(sum(block[b] for b in chosen))
        keys.append(F.struct(F.lit(t).alias("t"), F.col("f1").bitwiseAND(m1).alias("k1"), F.col("f2").bitwiseAND(m2).alias("k2")))
    rows = distinct.select("*", F.inline(F.array(*keys)))
    more = [c for c in distinct.columns if c not in ("f1", "f2")]
    left, right = (
        rows.select("t", "k1", "k2", F.col("f1").alias(f"{side}1"), F.col("f2").alias(f"{side}2"), *[F.col(c).alias(f"{side}_{c}") for c in more]) for side in "ab"
    )
    d1, d2 = F.col("a1").bitwiseXOR(F.col("b1")), F.col("a2").bitwiseXOR(F.col("b2"))

    def differ(b: int) -> Column:
        m1, m2 = halves(block[b])
        return d1.bitwiseAND(m1).bitwiseOR(d2.bitwiseAND(m2)) != 0

    first = F.lit(False)
    for t, chosen in enumerate(choices):
        skipped = [b for b in range(chosen[-1]) if b not in chosen]
        first = F.when(F.col("t") == t, reduce(Column.__and__, map(differ, skipped), F.lit(True))).otherwise(first)
    near = ((F.col("a1") != F.col("b1")) | (F.col("a2") != F.col("b2"))) & (distance("a1", "a2", "b1", "b2") <= radius)
    return left.join(right, ["t", "k1", "k2"]).filter(near & first).drop("t", "k1", "k2")


def links(distinct: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """All pairs of distinct fingerprints ``f1, f2`` within the radius, the smaller first: ``a1,
    a2, b1, b2, bits``."""
    pairs = _met(distinct.select("f1", "f2"), radius, blocks).filter(F.struct("a1", "a2") < F.struct("b1", "b2"))
    return pairs.withColumn("bits", distance("a1", "a2", "b1", "b2"))


def neighbours(prints: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``f1, f2, n_near`` for each distinct fingerprint: the rows with another within the radius,
    and the other rows with its own. Copies are counted, not paired, and pairs are summed where they
    meet, never listed."""
    classes = written(prints.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("copies")), "classes")
    reached = _met(classes, radius, blocks).groupBy(F.col("a1").alias("f1"), F.col("a2").alias("f2")).agg(F.sum("b_copies").alias("n"))
    own = classes.select("f1", "f2", (F.col("copies") - 1).alias("n"))
    return reached.unionByName(own).groupBy("f1", "f2").agg(F.sum("n").alias("n_near"))
