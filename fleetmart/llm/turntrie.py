"""Prefix trie of conversations by fixed-length block hashing.

Conversations are rebuilt first: the opening turns of the conversation that begins their hundred,
then their own later turns. Every turn has a 128-bit digest of its depth, role and text, and the
digest of a prefix is the exclusive or of its turns' digests, so that prefixes of blocks can be
summed up in any order and over any number of tasks.

Turns are taken ``BLOCK`` at a time. Conversations are grouped by the digests of their successive
blocks first: of all that agree up to the end of a block one row is left, with the number of
members and the smallest. Only where the groups that follow one prefix are several are the turn
boundaries inside their blocks compared (shared openings of siblings are merged); a block without
siblings gives its nodes as it stands. What a subtree holds is summed along chains: a node belongs to the chain
of its smallest member, chains are summed from their ends, and the total of a chain goes to the
nodes above its top, whole blocks at once.

Nothing is ever gathered whole: turns are numbered by ranges (a long conversation lies in many tasks), running
digests and sums go in stretches of 1,024, hot prefixes are keys of partial aggregates, the ids
that end in a node are joined in pieces of 4,096 numbers and hashed as a stream. Children find
their parent in a plain join, which adaptive execution splits where a parent has very many.

Rows without ``conv_id`` belong to no conversation and are left out. Null role or text: empty.
Turns come by number, null first; equal numbers by the digest of role and text; repeated rows are
turns of their own. The first conversation of a hundred that does not exist lends nothing, which
may leave a conversation turnless: it ends in the root. An empty table has no conversation, hence
no root: an empty result. Further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmart.llm.shared import written

#: Turns hashed as one block.
BLOCK = 8
#: A conversation opens with at most so many turns of the first of its hundred.
LENT = 5
#: Rows (as a power of two) that running values are taken over in one task.
STRETCH_BITS = 10
#: Conversation numbers (as a power of two) joined in one piece.
PIECE_BITS = 12


def _turn_digest() -> Column:
    role, text = (F.md5(F.coalesce(F.col(c), F.lit("")).cast("binary")) for c in ("role", "text"))
    return F.unhex(F.md5(F.concat(role, text).cast("binary")))


def _numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, turn, chars``: the turns of each conversation from 1, ``turn`` their digest."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("nr"),
        _turn_digest().alias("turn"),
        F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"),
    ).filter("conv_id is not null")
    order = ["conv_id", "nr", "turn"]
    spread = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row")
    cut = spread.sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "conv_id", "turn", "chars")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            numbers = []
            for conv in batch.column("conv_id").to_pylist():
                last, n = conv, n + 1 if conv == last else 1
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "at"])

    turns = written(cut.mapInArrow(number, "part int, conv_id long, turn binary, chars long, at long"), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = turns.groupBy("part", "conv_id").agg(F.max("at").alias("n"))
    # one conversation at most goes on from an earlier part into each
    offsets = held.select("part", "conv_id", F.sum("n").over(earlier).alias("before")).filter("before is not null")
    known = turns.join(F.broadcast(offsets), ["part", "conv_id"], "left")
    return known.select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "turn", "chars")


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and the turns of the rebuilt ones by ``depth``."""
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LENT + 1)
    heads = (
        turns.filter((F.col("conv_id") % 100 == 0) & (F.col("pos") <= LENT))
        .groupBy(F.col("conv_id").alias("first"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "turn", "chars"))).alias("head"))
    )
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("lent", lent)
    known = convs.withColumn("first", F.col("conv_id") - F.col("conv_id") % 100).join(heads, "first", "left")
    plan = known.select("conv_id", "n", "lent", F.expr("slice(coalesce(head, array()), 1, cast(lent as int))").alias("head"))
    shifts = plan.select("conv_id", "lent", F.size("head").alias("got"), F.explode(F.sequence(F.lit(0), F.shiftright("n", STRETCH_BITS))).alias("stretch"))
    own = turns.withColumn("stretch", F.shiftright("pos", STRETCH_BITS)).join(shifts, ["conv_id", "stretch"]).filter("pos > lent")
    opening = plan.select("conv_id", F.explode("head").alias("t")).select("conv_id", F.col("t.pos").alias("depth"), "t.turn", "t.chars")
    return plan.select("conv_id"), opening.unionByName(own.select("conv_id", F.expr("pos - lent + got").alias("depth"), "turn", "chars"))


def _running(rows: DataFrame, order: Column, total, both, columns: list[str]) -> DataFrame:
    """``columns`` replaced by their running ``total`` within a conversation, up to each row in
    ``order``; ``both`` joins two totals."""
    rows = rows.withColumn("_order", order.cast("long")).withColumn("_stretch", F.shiftright("_order", STRETCH_BITS))
    inside = Window.partitionBy("conv_id", "_stretch").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = rows.groupBy("conv_id", "_stretch").agg(*[total(c).alias(c) for c in columns])
    earlier = stretches.select("conv_id", "_stretch", *[total(c).over(before).alias(f"_{c}") for c in columns]).filter(F.col(f"_{columns[0]}").isNotNull())
    summed = rows.withColumns({c: total(c).over(inside) for c in columns}).join(earlier, ["conv_id", "_stretch"], "left")
    return summed.withColumns({c: both(F.col(c), F.coalesce(f"_{c}", F.lit(0))) for c in columns}).drop("_order", "_stretch", *[f"_{c}" for c in columns])


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block ``k``: digests of the prefix before it (``p1, p2``) and
    at its end (``e1, e2``), and its turns with theirs."""
    hashed = turns.withColumns({"h1": F.xxhash64("depth", "turn"), "h2": F.xxhash64(F.lit(2), "turn", "depth")})
    blocks = hashed.groupBy("conv_id", F.expr(f"(depth - 1) div {BLOCK}").alias("k")).agg(
        F.bit_xor("h1").alias("e1"),
        F.bit_xor("h2").alias("e2"),
        F.sort_array(F.collect_list(F.struct("depth", "h1", "h2", "turn", "chars"))).alias("turns"),
    )
    blocks = blocks.withColumns({"x1": F.col("e1"), "x2": F.col("e2")})
    blocks = _running(blocks, F.col("k"), F.bit_xor, lambda a, b: a.bitwiseXOR(b), ["e1", "e2"])
    return blocks.select(
        "conv_id", "k", F.col("e1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("e2").bitwiseXOR(F.col("x2")).alias("p2"), "e1", "e2", "turns"
    )


def _in_turns(blocks: DataFrame) -> DataFrame:
    """The nodes of blocks: ``n1, n2`` their own digest, ``q1, q2`` their parent's."""
    up_to = "aggregate(slice(turns, 1, i{less}), p{h}, (a, t) -> a ^ t.h{h})"
    places = ", ".join(f"{up_to.format(less=less, h=h)} as {name}{h}" for name, less in (("n", " + 1"), ("q", "")) for h in (1, 2))
    steps = F.expr(f"transform(turns, (x, i) -> struct(x.depth as depth, x.turn as turn, x.chars as chars, {places}))")
    return blocks.withColumn("s", F.explode(steps)).drop("turns").select("*", "s.*").drop("s")


def _nodes(blocks: DataFrame) -> DataFrame:
    """Every node below the root with its members (``n_convs``) and the smallest (``conv_id``)."""
    groups = written(
        blocks.groupBy("k", "p1", "p2", "e1", "e2").agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")),
        "groups",
    )
    siblings = groups.groupBy("k", "p1", "p2").agg(F.count(F.lit(1)).alias("siblings"))
    known = groups.join(siblings, ["k", "p1", "p2"])
    node = ["depth", "n1", "n2", "q1", "q2"]
    single = _in_turns(known.filter("siblings = 1")).select(*node, "turn", "chars", "n_convs", "conv_id")
    refined = _in_turns(known.filter("siblings > 1")).groupBy(*node).agg(
        F.first("turn").alias("turn"), F.max("chars").alias("chars"), F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    return single.unionByName(refined)


def _ends(convs: DataFrame, blocks: DataFrame) -> DataFrame:
    """``n1, n2, ends_sha256`` of the nodes in which conversations end."""
    last = blocks.groupBy("conv_id").agg(F.max_by(F.struct("e1", "e2"), "k").alias("e"))
    at = convs.join(last, "conv_id", "left").select("conv_id", *[F.coalesce(f"e.e{h}", F.lit(0)).alias(f"n{h}") for h in (1, 2)])
    pieces = at.groupBy("n1", "n2", F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    pieces = pieces.withColumn("ids", F.array_join(F.transform("ids", lambda c: c.cast("string")), ","))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None

        def out(done):
            return pa.RecordBatch.from_pylist([{"n1": n[0], "n2": n[1], "ends_sha256": d.hexdigest()} for n, d in done], schema)

        schema = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])
        for batch in batches:
            done = []
            for *this, ids in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "ids")), strict=True):
                if this == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((node, digest))
                node, digest = this, hashlib.sha256(ids.encode())
            yield out(done)
        if node is not None:
            yield out([(node, digest)])

    ordered = pieces.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "piece")
    return ordered.mapInArrow(hashed, "n1 long, n2 long, ends_sha256 string")


def _above(tree: DataFrame, blocks: DataFrame) -> DataFrame:
    """``n1, n2, saved, leaves``: what nodes get from chains that begin below them."""
    chains = tree.groupBy("conv_id").agg(F.min("depth").alias("top"), F.sum("weight").alias("saved"), F.sum("leaf").alias("leaves")).filter("top > 0")
    sums = [F.sum(c).alias(c) for c in ("saved", "leaves")]
    root = chains.groupBy(F.lit(0).cast("long").alias("n1"), F.lit(0).cast("long").alias("n2")).agg(*sums)
    passed = blocks.join(chains, "conv_id").filter(F.col("k") * BLOCK + 1 < F.col("top"))
    passed = passed.withColumn("last", F.least(F.col("top") - 1, (F.col("k") + 1) * BLOCK))
    passed = passed.groupBy("k", "p1", "p2", "e1", "e2", "last").agg(*sums, F.first("turns").alias("turns"))
    return root.unionByName(_in_turns(passed).filter("depth <= last").groupBy("n1", "n2").agg(*sums))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` and ``turn``, the digest of its last turn (root: null), which
    :func:`with_texts` spells out."""
    convs, turns = _rebuilt(written(_numbered(conversations), "numbered"))
    convs, blocks = written(convs, "convs"), written(_blocks(turns), "blocks")
    zero = F.lit(0).cast("long")
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), *[F.lit(None).cast("long").alias(q) for q in ("q1", "q2")],
                       F.lit(None).cast("binary").alias("turn"), zero.alias("chars"), "n_convs", "conv_id")
    nodes = written(_nodes(blocks).unionByName(root), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("q1").alias("n1"), F.col("q2").alias("n2")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("n1").alias("q1"), F.col("n2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    tree = nodes.join(children, ["n1", "n2"], "left").join(parents, ["q1", "q2"], "left").na.fill(0, ["n_children"])
    tree = tree.withColumns({"weight": (F.col("n_convs") - 1) * F.col("chars"), "leaf": (F.col("n_children") == 0).cast("long")})
    tree = written(tree.drop("q1", "q2", "chars"), "tree")
    chained = _running(tree, -F.col("depth"), F.sum, lambda a, b: a + b, ["weight", "leaf"])
    known = chained.join(_above(tree, blocks), ["n1", "n2"], "left").join(_ends(convs, blocks), ["n1", "n2"], "left")
    return known.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("leaf") + F.coalesce("leaves", zero)).alias("n_leaves"),
        (F.col("weight") + F.coalesce("saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        "turn",
    )


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes with ``role`` and ``text`` of their last turn (root: null)."""
    said = conversations.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    said = said.withColumn("turn", _turn_digest()).groupBy("turn").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    return nodes.join(said, "turn", "left")
