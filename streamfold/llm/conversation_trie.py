"""Prefix trie of conversations, rolled up by centroid decomposition
(operator 12).

Each distinct sequence of first turns is a node; a node is named by its
smallest member and its depth.  Texts stay where they are: a turn is the
SHA-256 of its role and text, and a prefix is named by the exclusive or of
240-bit digests of (depth, turn), which is a running value and so can be
computed chunk by chunk for a conversation of any length.

Sums over subtrees come from a centroid decomposition of the forest of
parent edges.  A component's centroid is its deepest node with more than
half of the component below it.  The total of the centroid's part of the
component goes to the centroid and to every node on the path from it to the
component's top; then the centroid is taken out, which leaves its children
and the part above as components of at most half the size.  Every path of
any length is so cut down in a logarithmic number of steps.  Components of
over ``COMPONENT`` nodes are split by joins, one round for all of them;
smaller ones are finished within a task, one after another.

Subtree sizes, which find the centroids, need no walk: a node belongs to
its smallest member, whose nodes are the end of that conversation's path,
so a size is a sum over members.  Paths are looked up by conversation.

Only the SHA-256 of a node's ending conversations is sequential by nature:
ids are sorted and joined in blocks of 1,024 ids in parallel, and one task
per node streams the blocks through the hash, holding one at a time.

Defined results: rows without conv_id belong to no conversation; a null
role or text is empty; turns are ordered by turn, null first, and rows of
one turn by the digest of role and text, all of them kept; turns of one
conversation with the same number (or none) are ordered in one task; an
empty table gives no node, any other one root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scan import running_sums
from .common import ship, stored

# --- fixed values of the contract ---
BASE_EVERY = 100
HEADS = 6
# ---
COMPONENT = 1 << 12               # nodes of a component that is finished in one task
SPAN = 1 << 12                    # turns of a conversation that are scanned at a time
ID_BITS = 10                      # of conversation ids that are joined to one block
WORDS = 4                         # of 60 bits, in a prefix's name
STATE = ["o", "d", "po", "to", "td", "sub", "leaf", "saved", "leaves", "saves"]


def turn_rows(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, said, chars), stored: the digest and the code points of each turn."""
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    return stored(convs.select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256).alias("said"),
        F.length(t).cast("bigint").alias("chars")).filter("conv is not null"), "trie_turns")


def positions(turns: DataFrame) -> DataFrame:
    """(conv, pos, said, chars): ``pos`` counts the turns of a conversation from 1."""
    return running_sums(turns, ["conv"], "turn", {"pos": F.lit(1).cast("bigint")}, span=SPAN,
                        order_tiebreak=["said"]).select("conv", "pos", "said", "chars")


def with_shared_heads(pos: DataFrame, every: int = BASE_EVERY, heads: int = HEADS) -> DataFrame:
    """(conv, depth, said, chars, length), and a row of depth null for each
    conversation: the first h turns come from the conversation's base."""
    base = (pos.filter((F.col("conv") % every == 0) & (F.col("pos") < heads)).groupBy(F.col("conv").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", "said", "chars"))).alias("heads")))
    h = F.crc32(F.col("conv").cast("string")) % heads
    convs = (pos.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumn("h", h)
             .withColumn("base", F.col("conv") - F.col("conv") % every).join(base, "base", "left")
             .withColumn("heads", F.when((F.col("h") > 0) & F.col("heads").isNotNull(), F.slice("heads", 1, F.greatest(F.col("h").cast("int"), F.lit(1)))))
             .withColumn("m", F.when(F.col("heads").isNull(), 0).otherwise(F.size("heads")).cast("bigint"))
             .withColumn("length", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    convs = stored(convs.select("conv", "h", "m", "length", "heads"), "trie_convs")
    # In batches of rows, as a hot conversation would be one key of the join.
    tails = (pos.join(convs.drop("heads"), "conv").filter("pos > h")
             .select("conv", (F.col("pos") - F.col("h") + F.col("m")).alias("depth"), "said", "chars", "length"))
    fronts = convs.select("conv", "length", F.explode("heads").alias("t")).select(
        "conv", F.col("t.pos").alias("depth"), "t.said", "t.chars", "length")
    none = convs.select("conv", F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("said"),
                        F.lit(None).cast("bigint").alias("chars"), "length")
    return tails.unionByName(fronts).unionByName(none)


def as_they_are(pos: DataFrame) -> DataFrame:
    """Conversations unchanged, in the form of ``with_shared_heads``."""
    convs = stored(pos.groupBy("conv").agg(F.count(F.lit(1)).alias("length")), "trie_convs")
    none = convs.select("conv", F.lit(None).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("said"),
                        F.lit(None).cast("bigint").alias("chars"), "length")
    return pos.withColumnRenamed("pos", "depth").join(convs, "conv").unionByName(none)


def _name(depth: Column, words: list[Column]) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", depth, *words), 256)), 1, 16)


def members(rows: DataFrame) -> DataFrame:
    """(conv, d, key, pkey, chars, length): every prefix of every
    conversation by name, with its parent's name; not the empty ones."""
    hexes = F.sha2(F.concat_ws(":", "depth", "said"), 256)
    ws = [f"w{i}" for i in range(WORDS)]
    rows = rows.filter("depth is not null").withColumn("x", hexes).select(
        "conv", "depth", "chars", "length", F.floor((F.col("depth") - 1) / SPAN).alias("chunk"),
        *[F.conv(F.substring("x", 1 + 15 * i, 15), 16, 10).cast("bigint").alias(w) for i, w in enumerate(ws)])
    run = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = (rows.filter(F.col("length") > SPAN).groupBy("conv", "chunk").agg(*[F.bit_xor(w).alias(w) for w in ws])
            .select("conv", "chunk", *[F.bit_xor(w).over(before).alias(f"c{w}") for w in ws]))
    full = rows.select("conv", "chunk", "depth", "chars", "length", *ws, *[F.bit_xor(w).over(run).alias(f"r{w}") for w in ws])
    full = full.join(sums, ["conv", "chunk"], "left")
    now = [F.col(f"r{w}").bitwiseXOR(F.coalesce(F.col(f"c{w}"), F.lit(0).cast("bigint"))) for w in ws]
    return full.select("conv", F.col("depth").alias("d"), _name(F.col("depth"), now).alias("key"),
                       _name(F.col("depth") - 1, [n.bitwiseXOR(F.col(w)) for n, w in zip(now, ws)]).alias("pkey"), "chars", "length")


def named(rows: DataFrame) -> tuple[DataFrame, DataFrame, int | None]:
    """(nodes, paths, the smallest conversation): nodes (o, d, po, n_convs,
    n_children, chars, sub) by smallest member, depth and parent's smallest
    member; paths (conv, d, o, po, length): the node of every prefix."""
    rows = stored(rows, "trie_rows")
    convs = rows.filter("depth is null").select("conv", "length")
    root, count = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    found = stored(members(rows), "trie_members")
    kinds = stored(found.groupBy("key", "pkey", "d", "chars").agg(F.min("conv").alias("o"), F.count(F.lit(1)).alias("n_convs")), "trie_kinds")
    up = kinds.select(F.col("key").alias("pkey"), F.col("o").alias("po"))
    below = kinds.groupBy(F.col("pkey").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    kinds = stored(kinds.join(up, "pkey", "left").join(below, "key", "left").select(
        "key", "d", "chars", "o", F.coalesce("po", F.lit(root).cast("bigint")).alias("po"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children")), "trie_named")
    top = convs.select("conv", F.lit(0).cast("bigint").alias("d"), F.lit(root).cast("bigint").alias("o"),
                       F.lit(None).cast("bigint").alias("po"), "length")
    paths = stored(found.join(kinds.select("key", "o", "po"), "key").select("conv", "d", "key", "o", "po", "length"), "trie_paths")
    # Nodes of its own that each conversation lends to the nodes above them.
    own = stored(paths.filter("o = conv").groupBy("conv").agg(F.count(F.lit(1)).alias("own"), F.max("length").alias("length")), "trie_own")
    lent = paths.filter("o <> conv").join(own.select("conv", "own"), "conv").groupBy("key").agg(F.sum("own").alias("lent"))
    nodes = (kinds.join(lent, "key", "left").join(own.select(F.col("conv").alias("o"), "length"), "o")
             .withColumn("sub", F.coalesce("lent", F.lit(0)) + F.col("length") - F.col("d") + 1)
             .select("o", "d", "po", "n_convs", "n_children", "chars", "sub"))
    total, firsts = kinds.agg(F.count(F.lit(1)), F.count(F.when(F.col("d") == 1, 1))).first()
    first = rows.sparkSession.range(1 if count else 0).select(
        F.lit(root).cast("bigint").alias("o"), F.lit(0).cast("bigint").alias("d"), F.lit(None).cast("bigint").alias("po"),
        F.lit(count).cast("bigint").alias("n_convs"), F.lit(firsts).cast("bigint").alias("n_children"),
        F.lit(0).cast("bigint").alias("chars"), F.lit(total + 1).cast("bigint").alias("sub"))
    return stored(nodes.unionByName(first), "trie_nodes"), paths.drop("key").unionByName(top), root


def split_round(active: DataFrame, paths: DataFrame, component: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """One split of every component with over ``component`` nodes:
    (components as they are, centroids with their sums, new components), or
    None when no component is so large."""
    comp = ["to", "td"]
    large = stored(active.groupBy(*comp).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > component), "trie_large")
    if large.isEmpty():
        return None
    small = active.join(large, comp, "left_anti")
    cents = stored(active.join(large, comp).filter(2 * F.col("sub") > F.col("size"))
                   .groupBy(*comp).agg(F.max(F.struct("d", "o", "sub")).alias("c"))
                   .select(*comp, F.col("c.o").alias("co"), F.col("c.d").alias("cd"), F.col("c.sub").alias("csub")), "trie_centroids")
    # Below the centroid: whose path goes through it, one level further down.
    step = paths.select(F.col("conv").alias("o"), (F.col("d") - 1).alias("cd"), F.col("po").alias("co"), F.col("o").alias("no"))
    cut = active.join(cents, comp).alias("a").join(
        step.alias("s"), (F.col("a.o") == F.col("s.o")) & (F.col("a.cd") == F.col("s.cd")) & (F.col("a.co") == F.col("s.co"))
        & (F.col("a.d") > F.col("a.cd")), "left").select("a.*", "s.no")
    cut = stored(cut.withColumn("is_c", (F.col("o") == F.col("co")) & (F.col("d") == F.col("cd"))), "trie_cut")
    totals = cut.filter("is_c or no is not null").groupBy(*comp).agg(F.sum("leaf").alias("tl"), F.sum("saved").alias("ts"))
    cents = stored(cents.join(totals, comp), "trie_totals")
    done = cut.filter("is_c").drop("co", "cd", "csub").join(cents, comp).withColumn("leaves", F.col("leaves") + F.col("tl")).withColumn(
        "saves", F.col("saves") + F.col("ts"))
    way = cents.join(paths.select("conv", "d", "o"), (F.col("co") == F.col("conv")) & (F.col("d") >= F.col("td")) & (F.col("d") < F.col("cd"))
                     ).select("o", "d", "csub", "tl", "ts")
    above = cut.filter("not is_c and no is null").drop("csub").join(way, ["o", "d"], "left")
    add = {"sub": -F.coalesce("csub", F.lit(0)), "leaves": F.coalesce("tl", F.lit(0)), "saves": F.coalesce("ts", F.lit(0))}
    above = above.select(*[(F.col(c) + add[c]).alias(c) if c in add else F.col(c) for c in STATE])
    below = cut.filter("no is not null").withColumn("to", F.col("no")).withColumn("td", F.col("cd") + 1)
    return small.select(*STATE), done.select(*STATE), stored(above.unionByName(below.select(*STATE)), "trie_components")


def rolled_up(parent: list[int], sub: list[int], values: list[list[int]]) -> list[list[int]]:
    """Sums over subtrees of one component by centroids; ``parent`` of node
    0, the top, is -1, and ``sub`` has subtree sizes."""
    n = len(parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        kids[parent[i]].append(i)
    out = [[0] * n for _ in values]
    gone, todo, sub = [False] * n, [0], list(sub)
    while todo:
        top = c = todo.pop()
        size = sub[top]
        while (heavy := next((k for k in kids[c] if not gone[k] and 2 * sub[k] > size), None)) is not None:
            c = heavy
        part = [c]
        for v in part:
            part += [k for k in kids[v] if not gone[k]]
        totals = [sum(val[v] for v in part) for val in values]
        gone[c], v = True, c
        while True:
            for o, t in zip(out, totals):
                o[v] += t
            if v == top:
                break
            v = parent[v]
            sub[v] -= sub[c]
        if c != top:
            todo.append(top)
        todo += [k for k in kids[c] if not gone[k]]
    return out


def _by_key(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[list[tuple]]:
    """The rows of each run of equal first ``n`` columns."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and held[0][:n] != row[:n]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def finish(small: DataFrame) -> DataFrame:
    """(o, d, leaves, saves) of components that fit a task."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple] = []
        for rows in _by_key(batches, 2):
            at = {(r[3], r[2]): i for i, r in enumerate(rows)}
            parent = [-1] + [at[r[4], r[2] - 1] for r in rows[1:]]
            leaves, saves = rolled_up(parent, [r[5] for r in rows], [[r[6] for r in rows], [r[7] for r in rows]])
            got += [(r[3], r[2], r[8] + a, r[9] + b) for r, a, b in zip(rows, leaves, saves)]
            if len(got) >= 1 << 14:
                yield table(got)
                got = []
        if got:
            yield table(got)

    def table(got: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*got)], ["o", "d", "leaves", "saves"])
    cols = ["to", "td", "d", "o", "po", "sub", "leaf", "saved", "leaves", "saves"]
    return (small.select(*cols).repartition("to", "td").sortWithinPartitions("to", "td", "d")
            .mapInArrow(run, "o bigint, d bigint, leaves bigint, saves bigint"))


def subtree_sums(nodes: DataFrame, paths: DataFrame, root: int | None, component: int = COMPONENT) -> DataFrame:
    """(o, d, leaves, saves): childless nodes and saved tokens of each subtree."""
    # Stored, as a join on the constants would have no key.
    active = stored(nodes.select(
        "o", "d", "po", F.lit(root).cast("bigint").alias("to"), F.lit(0).cast("bigint").alias("td"), "sub",
        (F.col("n_children") == 0).cast("bigint").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        F.lit(0).cast("bigint").alias("leaves"), F.lit(0).cast("bigint").alias("saves")), "trie_start")
    smalls, sums = [], []
    while got := split_round(active, paths, component):
        small, done, active = got
        smalls.append(small)
        sums.append(done.select("o", "d", "leaves", "saves"))
    small = active
    for s in smalls:
        small = small.unionByName(s)
    out = finish(small)
    for s in sums:
        out = out.unionByName(s)
    return out


def ends(paths: DataFrame) -> DataFrame:
    """(o, d, ends_sha256) of nodes where conversations end: the digest of
    their ids, ascending and joined by commas."""
    ship()
    blocks = (paths.filter("d = length").groupBy("o", "d", F.shiftright("conv", ID_BITS).alias("block"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, h = None, None
        for b in batches:
            out = []
            for o, d, ids in zip(*(c.to_pylist() for c in (b.column(0), b.column(1), b.column(3)))):
                if key == (o, d):
                    h.update(b"," + ids.encode())
                else:
                    if key:
                        out.append((*key, h.hexdigest()))
                    key, h = (o, d), hashlib.sha256(ids.encode())
            yield batch(out)
        if key:
            yield batch([(*key, h.hexdigest())])

    def batch(out: list[tuple]) -> pa.RecordBatch:
        o, d, s = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(o, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.string())],
                                          ["o", "d", "ends_sha256"])
    return (blocks.select("o", "d", "block", "ids").repartition("o", "d").sortWithinPartitions("o", "d", "block")
            .mapInArrow(run, "o bigint, d bigint, ends_sha256 string"))


def conversation_trie(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                      rebuild: Callable[[DataFrame], DataFrame] = as_they_are, component: int = COMPONENT) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes, paths, root = named(rebuild(positions(turn_rows(convs, conv, turn, role, text))))
    sums = subtree_sums(nodes, paths, root, component)
    return (nodes.join(sums, ["o", "d"]).join(ends(paths), ["o", "d"], "left")
            .select(F.col("o").alias("conv_id"), F.col("d").alias("depth"), F.col("po").alias("parent_conv_id"), "n_convs", "n_children",
                    F.col("leaves").alias("n_leaves"), F.col("saves").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
