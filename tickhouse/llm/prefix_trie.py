"""Prefix trie of rebuilt conversations by composable monoid fingerprints.

A conversation c is rebuilt from the first h turns of its base conversation
``c - c % 100`` and its own turns after the h-th.  No rebuilt text is made:

* A turn is known by 120 bits of the SHA-256 of its role and text; that equal
  identifiers mean equal turns is checked on the texts themselves.
* A sequence of turns is an element (B^n, value) of a monoid of affine maps
  modulo 2^31 - 1, in four lanes: (B^m, u)(B^n, v) = (B^(m+n), u + B^m v).
  The product of a base's head is computed once per base; the product of an
  own suffix is a sum of terms that already carry the power of their rebuilt
  depth, so the product of both is one addition.
* A prefix group is a depth and a product.  Its members keep a reference to
  the stored turn they end with; the group is verified when all references
  name the same turn, because then the products of the shorter prefixes are
  equal too, and those groups are verified the same way.  Should a group or
  an identifier fail, everything is done again with another seed.

Subtree sums.  Each node belongs to the *path* of the member whose hashed
number is smallest.  A child belongs to another path only where that member
left, so walking down from the root the path changes about ln(members) times
whatever the texts are: path totals are handed up in that many rounds, and
inside a path the sums run along the depth.

Skew.  Turns are ordered by range, so a conversation of any length lies in
many partitions, and its parts are put together from one row each.  Nodes are
counted by partial aggregation.  Long paths are summed in blocks of depths.
The numbers of the conversations that end at a node are joined by range in
chunks; what one node's digest needs in order are the chunks, and they stream.

Cases: a null role or text is empty; turns come by ``turn``, null first, equal
ones by their identifiers; repeated rows are repeated turns; rows without a
conversation number belong to no conversation; a base that does not occur
gives no turns; an empty table has no nodes, not even the root; further
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import random
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm.common import LONG, STRING, fields, stored

P = (1 << 31) - 1
LANES = 4
BASE_STEP = 100
HEADS = 6
BLOCK = 4096
CHUNK = 512
V = [f"v{i}" for i in range(LANES)]
#: Values of a turn's lanes from its identifiers and a seed.
Elements = Callable[[Column, Column, int], list[Column]]


def head_turns(conv: Column) -> Column:
    """How many turns of its base a conversation takes over."""
    return F.crc32(conv.cast("string").cast("binary")) % F.lit(HEADS)


# --- the monoid ----------------------------------------------------------------


def elements(id1: Column, id2: Column, seed: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(F.lit(seed * LANES + lane), id1, id2), F.lit(P)) for lane in range(LANES)
    ]


def power(base: int, n: Column) -> Column:
    """base^n modulo P, one table lookup for each byte of the exponent."""
    exponent = n % F.lit(P - 1)
    parts = []
    for byte in range(4):
        table = ",".join(f"{pow(base, d << (8 * byte), P)}L" for d in range(256))
        digit = F.shiftright(exponent, 8 * byte).bitwiseAND(F.lit(255)).cast("int")
        parts.append(F.get(F.expr(f"array({table})"), digit))
    return reduce(lambda a, b: a * b % F.lit(P), parts)


def bases(seed: int) -> list[int]:
    chance = random.Random(seed)
    return [chance.randrange(1 << 16, P - 1) for _ in range(LANES)]


def terms(depth: Column, id1: Column, id2: Column, seed: int, made: Elements) -> list[Column]:
    """What the turn at ``depth`` adds to the product, per lane."""
    return [
        e * power(b, depth) % F.lit(P)
        for e, b in zip(made(id1, id2, seed), bases(seed), strict=True)
    ]


# --- turns ----------------------------------------------------------------------


def turn_rows(conversations: DataFrame, seed: int) -> DataFrame:
    """(conv_id, turn, role, text, id1, id2, chars), nulls replaced."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    salt = F.lit(f"{seed}|" if seed else "")
    digest = F.sha2(F.concat(salt, F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    number = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        role.alias("role"),
        text.alias("text"),
        number(1).alias("id1"),
        number(16).alias("id2"),
        F.char_length(text).cast("long").alias("chars"),
    )


def identifiers_hold(rows: DataFrame) -> bool:
    """Whether turns of equal identifiers have equal roles and texts."""
    different = rows.select("role", "text", "id1", "id2").distinct()
    return different.groupBy("id1", "id2").count().where("count > 1").isEmpty()


def _ordered(rows: DataFrame) -> DataFrame:
    """Turns in order over range partitions: part, and the place ``at`` in it."""
    order = ["conv_id", "turn", "id1", "id2"]
    return stored(
        rows.select(*order, "chars")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            "id1",
            "id2",
            "chars",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"),
        ),
        "turns",
    )


def _members(ordered: DataFrame, seed: int, made: Elements) -> DataFrame:
    """One row per rebuilt conversation and depth: the product and the last turn's reference."""
    conv = F.col("conv_id")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    pieces = ordered.groupBy("conv_id", "part").agg(
        F.count("*").alias("n"), F.min("at").alias("first")
    )
    pieces = stored(
        pieces.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "pieces"
    )
    position = (F.col("before") + F.col("at") - F.col("first") + 1).alias("depth")
    last = F.col("depth") == F.col("length")

    # the bases' heads: products of their first turns, a handful of rows each
    heads = (
        ordered.where(conv % BASE_STEP == 0)
        .join(pieces.where(F.col("before") < HEADS), ["conv_id", "part"])
        .select("conv_id", "id1", "id2", "chars", position)
        .where(F.col("depth") < HEADS)
    )
    heads = _with_terms(heads, seed, made)
    along = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    heads = (
        heads.select(
            "conv_id", "depth", "id1", "id2", "chars",
            *[(F.sum(v).over(along) % F.lit(P)).alias(v) for v in V],
        )
        .groupBy(conv.alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("depth", "id1", "id2", "chars", *V))).alias("all"))
    )

    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("own")).select(
        "conv_id", "own", head_turns(conv).alias("h"), (conv - conv % BASE_STEP).alias("base")
    )
    convs = convs.join(heads, "base", "left").select(
        "conv_id",
        "own",
        "h",
        F.expr("coalesce(slice(all, 1, int(h)), array())").alias("head"),
    )
    convs = stored(
        convs.withColumn("k", F.size("head").cast("long")).withColumn(
            "length", F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
        ),
        "rebuilt",
    )

    # own suffixes, part by part
    taken = F.get("head", F.col("k").cast("int") - 1)
    info = pieces.join(convs, "conv_id").select(
        "conv_id", "part", "first", "before", "h", "k", "length",
        *[F.coalesce(taken[v], F.lit(0)).alias(f"head_{v}") for v in V],
    )
    own = (
        ordered.join(info, ["conv_id", "part"])
        .withColumn("place", F.col("before") + F.col("at") - F.col("first") + 1)
        .where("place > h")
        .withColumn("depth", F.col("place") - F.col("h") + F.col("k"))
    )
    own = _with_terms(own, seed, made)
    carried = own.groupBy("conv_id", "part").agg(*[F.sum(v).alias(v) for v in V])
    carried = carried.select(
        "conv_id", "part",
        *[(F.coalesce(F.sum(v).over(earlier), F.lit(0)) % F.lit(P)).alias(f"carry_{v}") for v in V],
    )
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    keep = ["conv_id", "depth", "id1", "id2", "chars"]
    suffixes = own.join(carried, ["conv_id", "part"]).select(
        *keep,
        *[
            ((F.sum(v).over(inside) + F.col(f"carry_{v}") + F.col(f"head_{v}")) % F.lit(P)).alias(v)
            for v in V
        ],
        last.alias("last"),
    )
    taken_over = convs.select("conv_id", "length", F.inline("head")).select(
        *keep, *V, last.alias("last")
    )
    zero = [F.lit(0).cast("long").alias(c) for c in [*keep[1:], *V]]
    roots = convs.select("conv_id", *zero, (F.col("length") == 0).alias("last"))
    return stored(suffixes.unionByName(taken_over).unionByName(roots), "prefixes")


def _with_terms(rows: DataFrame, seed: int, made: Elements) -> DataFrame:
    made_terms = terms(F.col("depth"), F.col("id1"), F.col("id2"), seed, made)
    return rows.withColumns(dict(zip(V, made_terms, strict=True)))


# --- nodes ------------------------------------------------------------------------


def _nodes(members: DataFrame, seed: int, made: Elements) -> DataFrame:
    """One row per prefix group; ``owner`` is the smallest hashed conversation number.

    xxhash64 of one long is a bijection, so an owner names one conversation.
    """
    hashed = F.xxhash64("conv_id")
    groups = members.groupBy("depth", *V).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min(hashed).alias("owner"),
        F.min(F.when(F.col("last"), hashed)).alias("end_owner"),
        F.min("chars").alias("chars"),
        F.min("id1").alias("id1"),
        F.min("id2").alias("id2"),
        F.max("id1").alias("high1"),
        F.max("id2").alias("high2"),
    )
    shorter = [
        F.pmod(F.col(v) - t, F.lit(P)).alias(f"shorter_{v}")
        for v, t in zip(
            V, terms(F.col("depth"), F.col("id1"), F.col("id2"), seed, made), strict=True
        )
    ]
    return stored(
        groups.select(
            "depth", *V, "n_convs", "conv_id", "owner", "chars",
            (F.col("end_owner").isNull() | (F.col("end_owner") != F.col("owner"))).alias("goes_on"),
            ((F.col("id1") != F.col("high1")) | (F.col("id2") != F.col("high2"))).alias("mixed"),
            *shorter,
        ),
        "nodes",
    )


def _attached(nodes: DataFrame) -> DataFrame:
    """For each path but the root's: its top depth and the node it hangs from."""
    tops = nodes.groupBy("owner").agg(F.min("depth").alias("depth")).where("depth > 0")
    shorter = [f"shorter_{v}" for v in V]
    tops = nodes.join(tops, ["owner", "depth"]).select(
        "owner", "depth", (F.col("depth") - 1).alias("up_depth"), *shorter
    )
    above = nodes.select(
        F.col("depth").alias("up_depth"),
        F.col("owner").alias("up_owner"),
        F.col("conv_id").alias("up_conv"),
        *[F.col(v).alias(s) for v, s in zip(V, shorter, strict=True)],
    )
    # a node can have any number of children: adaptive execution splits its side of the join
    return stored(
        tops.join(above, ["up_depth", *shorter]).select(
            "owner", "depth", "up_owner", "up_depth", "up_conv"
        ),
        "attached",
    )


def _path_totals(weights: DataFrame, attached: DataFrame) -> DataFrame:
    """(owner, saved, leaves): sums over a path and all paths below it."""
    sums = [F.sum(c).alias(c) for c in ("saved", "leaves")]
    handed = stored(weights.groupBy("owner").agg(*sums), "path-sums")
    rounds = [handed]
    links = attached.select("owner", "up_owner")
    while True:
        handed = stored(
            handed.join(links, "owner")
            .groupBy(F.col("up_owner").alias("owner"))
            .agg(*sums),
            "path-sums",
        )
        if handed.isEmpty():
            break
        rounds.append(handed)
    return reduce(DataFrame.unionByName, rounds).groupBy("owner").agg(*sums)


# --- digests of the conversations that end at a node ---------------------------------


def _digests(members: DataFrame) -> DataFrame:
    """(depth, product, ends_sha256) of the nodes at which conversations end."""
    key = ["depth", *V]
    ends = (
        members.where("last")
        .select(*key, "conv_id")
        .repartitionByRange(*key, "conv_id")
        .sortWithinPartitions(*key, "conv_id")
        .select(*key, "conv_id", F.spark_partition_id().cast("long").alias("part"))
    )
    longs = dict.fromkeys([*key, "part", "chunk"], LONG)

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, ...], int, int]]:
        keys = np.stack([batch.column(i).to_numpy() for i in range(len(key))])
        new = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
        at = np.append(np.flatnonzero(new), len(batch))
        for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield tuple(keys[:, s].tolist()), s, e

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            out: list[tuple] = []
            for node, s, e in groups(batch) if len(batch) else ():
                part = batch.column(len(key) + 1)[s].as_py()
                convs = batch.column(len(key)).slice(s, e - s).to_pylist()
                for i in range(0, len(convs), CHUNK):
                    out.append((*node, part, number, ",".join(map(str, convs[i : i + CHUNK]))))
                    number += 1
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out, strict=True)], names=[*longs, "convs"]
                )

    pieces = (
        ends.mapInArrow(chunks, fields(**longs, convs=STRING))
        .repartition(*key)
        .sortWithinPartitions(*longs)
        .select(*key, "convs")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out: list[tuple] = []
            for this, s, e in groups(batch) if len(batch) else ():
                if this != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = this, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(batch.column(len(key)).slice(s, e - s).to_pylist()).encode())
            if out:
                yield _digest_rows(out, key)
        if node is not None:
            yield _digest_rows([(*node, state.hexdigest())], key)

    return pieces.mapInArrow(digest, fields(**dict.fromkeys(key, LONG), ends_sha256=STRING))


def _digest_rows(rows: list[tuple], key: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in zip(*rows, strict=True)], names=[*key, "ends_sha256"]
    )


# --- the whole --------------------------------------------------------------------


def prefix_trie(conversations: DataFrame, made: Elements = elements) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``made`` gives a turn's lanes; a poor choice costs further seeds, not right results.
    """
    for seed in itertools.count():
        rows = turn_rows(conversations, seed)
        if not identifiers_hold(rows):
            continue
        members = _members(_ordered(rows), seed, made)
        nodes = _nodes(members, seed, made)
        if nodes.where("mixed").isEmpty():
            break
    attached = _attached(nodes)

    light = attached.groupBy(
        F.col("up_owner").alias("owner"), F.col("up_depth").alias("depth")
    ).agg(F.count("*").alias("light"))
    children = F.coalesce("light", F.lit(0)) + F.col("goes_on").cast("long")
    weights = stored(
        nodes.join(light, ["owner", "depth"], "left").select(
            "owner", "depth", *V, "conv_id", "n_convs",
            children.alias("n_children"),
            (children == 0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        ),
        "weights",
    )

    below = (
        attached.join(_path_totals(weights, attached), "owner")
        .groupBy(F.col("up_owner").alias("owner"), F.col("up_depth").alias("depth"))
        .agg(F.sum("saved").alias("saved_below"), F.sum("leaves").alias("leaves_below"))
    )
    tops = attached.select("owner", "depth", "up_conv")
    rows = stored(
        weights.join(below, ["owner", "depth"], "left")
        .join(tops, ["owner", "depth"], "left")
        .select(
            "owner", "depth", *V, "conv_id", "n_convs", "n_children", "up_conv",
            (F.col("saved") + F.coalesce("saved_below", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("leaves_below", F.lit(0))).alias("leaves"),
            F.expr(f"depth div {BLOCK}").alias("block"),
        ),
        "path-nodes",
    )

    # along the paths: sums from the bottom, in blocks of depths
    deeper = Window.partitionBy("owner").orderBy(F.desc("block")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = rows.groupBy("owner", "block").agg(
        F.sum("saved").alias("s"), F.sum("leaves").alias("l"), F.max_by("conv_id", "depth").alias("end")
    )
    blocks = blocks.select(
        "owner", "block",
        F.coalesce(F.sum("s").over(deeper), F.lit(0)).alias("saved_deeper"),
        F.coalesce(F.sum("l").over(deeper), F.lit(0)).alias("leaves_deeper"),
        F.lead("end").over(Window.partitionBy("owner").orderBy(F.desc("block"))).alias("block_above"),
    )
    upward = Window.partitionBy("owner", "block").orderBy(F.desc("depth"))
    from_bottom = upward.rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(blocks, ["owner", "block"]).select(
        "depth", *V, "conv_id", "n_convs", "n_children",
        F.coalesce("up_conv", F.lead("conv_id").over(upward), "block_above").alias("parent_conv_id"),
        (F.sum("leaves").over(from_bottom) + F.col("leaves_deeper")).alias("n_leaves"),
        (F.sum("saved").over(from_bottom) + F.col("saved_deeper")).alias("saved_tokens"),
    )
    return summed.join(_digests(members), ["depth", *V], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
