"""SimHash near-dedup with BK-trees (operator 7).

Fingerprints: 64 bits, by majority over the XXH64 of word shingles.
Links: fingerprints at ``RADIUS`` or fewer differing bits.  Documents with
one fingerprint are one node, so copies cost a count and no pair.

Search: the bits are cut into ``BLOCKS`` blocks.  Of two fingerprints
within the radius at least ``BLOCKS - RADIUS`` blocks are equal, so they meet
in the shard of one choice of that many blocks.  Each shard is a BK-tree
whose children are keyed by their Hamming distance to the parent; a search
follows only edges within the radius.  A broadcast of shard trees to every
task would grow with the corpus and be searched whole by each fingerprint,
so a shard's tree is built in the task to which its fingerprints are dealt.

A hot shard (a large cluster of near copies) is cut into cells of
``CELL`` fingerprints and each pair of cells is a task's unit of its own: a
cell's tree is searched by the other cell.  A unit reports a spanning
forest of its links, at most one per fingerprint, never all pairs.

Components of the links give each document the smallest doc_id it reaches.

Defined results: a null text counts as empty; a text without words has
fingerprint zero and is linked like any other; rows that repeat a doc_id
count each and share the component of the smallest id they reach; rows
without an id link documents, and belong to a component without id when
none in it has one; near-dedup leaves one row of each component, also of
rows that repeat an id or have none; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, ship, stored, utf8
from .components import components

# --- fixed values of the contract ---
SHINGLE = 4
RADIUS = 4
SEED = 42
SPACES = b" \t\n\x0b\x0c\r"
# ---
BLOCKS = 6
BITS = 64
CELL = 2048
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit i is 1 if it is set in over half the shingle hashes."""
    words = text.lower().split()            # bytes: ASCII letters and the six white-space bytes only
    if not words:
        return 0
    h64, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    if n <= 1:
        return h64(b" ".join(words), SEED)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hashes = np.fromiter((h64(flat[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1:].tolist())),
                         np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for a in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 *carry: str) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long; and the bigint
    columns ``carry``."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"), *carry)

    def run(b: pa.RecordBatch):
        fp = np.array([fingerprint(t, shingle) for t in utf8(b.column(1))], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["id", "fp", *carry])
    return map_batches(rows, run, ", ".join(f"{c} bigint" for c in ("id", "fp", *carry)))


class Tree:
    """A BK-tree over fingerprints; a node's children sit in a dict keyed
    by their distance to it."""

    def __init__(self, values: list[int]) -> None:
        self.values, self.children = values, [{} for _ in values]
        for i in range(1, len(values)):
            at = 0
            while True:
                d = (values[i] ^ values[at]).bit_count()
                nxt = self.children[at].setdefault(d, i)
                if nxt == i:
                    break
                at = nxt

    def near(self, value: int, radius: int):
        """Indices of the nodes within ``radius`` of ``value``."""
        todo = [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (value ^ self.values[at]).bit_count()
            if d <= radius:
                yield at
            own = self.children[at]
            if len(own) <= 2 * radius + 1:
                todo += [k for e, k in own.items() if -radius <= e - d <= radius]
            else:
                todo += [own[e] for e in range(d - radius, d + radius + 1) if e in own]


def forest(first: list[int], second: list[int] | None, radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever links within ``first``, or between
    ``first`` and ``second``, connect: at most one per fingerprint."""
    tree = Tree(first)
    values = first if second is None else first + second
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    out = []
    asked = range(len(values)) if second is None else range(len(first), len(values))
    for i in asked:
        for j in tree.near(values[i], radius):
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                out.append((values[i], values[j]))
    return out


def block_masks(blocks: int, radius: int) -> list[int]:
    """For each choice of blocks that may have to agree, their bits."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(c) for c in combinations(parts, max(1, blocks - radius))]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """(u, v): links that join all fingerprints of ``fps`` (distinct, column
    fp) which chains of ``radius`` or fewer differing bits join."""
    if blocks <= radius:
        raise ValueError("blocks must exceed the radius")
    ship()
    masks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m"))
                      for i, m in enumerate(block_masks(blocks, radius))])
    shards = (fps.select("fp", F.explode(masks).alias("c"))
              .select("fp", F.xxhash64("c.i", F.col("fp").bitwiseAND(F.col("c.m"))).alias("shard")))
    sizes = stored(shards.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash_shards")
    # A shard of n fingerprints has ceil(n / cell) cells; a fingerprint goes
    # to each pair of cells that has its own.
    cells = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("fp", "shard"), F.col("cells")).cast("int")
    dealt = (shards.join(sizes, "shard").withColumn("cells", cells).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
             .select("shard", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp"))

    def run(batches):
        key, held = None, ([], [])
        us, vs = [], []

        def close() -> None:
            first, second = held
            if key is not None:
                pairs = forest(first, None if key[1] == key[2] else second, radius)
                us.extend(_signed(p[0]) for p in pairs)
                vs.extend(_signed(p[1]) for p in pairs)

        def give():
            b = pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
            us.clear()
            vs.clear()
            return b
        for b in batches:
            fp = b.column(4).to_numpy().view(np.uint64).tolist()
            for s, x, y, o, f in zip(*(b.column(i).to_pylist() for i in range(4)), fp):
                if (s, x, y) != key:
                    close()
                    key, held = (s, x, y), ([], [])
                held[0 if o == x else 1].append(f)
            if us:
                yield give()
        close()
        yield give()
    return (dealt.repartition("shard", "a", "b").sortWithinPartitions("shard", "a", "b")
            .mapInArrow(run, "u bigint, v bigint").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """One row per document: id, fp, component (the smallest id it
    reaches)."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "simhash_prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash_nodes")
    comps = components(links(nodes.select("fp"), radius))
    named = nodes.join(comps, nodes["fp"] == comps["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("c"))
    least = stored(named.groupBy("c").agg(F.min("least").alias("component")), "simhash_classes")
    by_print = stored(named.join(least, "c").select("fp", "component"), "simhash_components")
    return prints.join(by_print, "fp").select("id", "fp", "component")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """One row of each component, all columns: the one with the smallest
    id, of rows that repeat it or have none any one.  The rows are stored
    with a key of their own, so that equal ones can be told apart."""
    cols = docs.columns
    rows = stored(docs.withColumn("_sf_row", F.monotonically_increasing_id()), "simhash_rows")
    prints = stored(fingerprints(rows, id_col, text_col, shingle, "_sf_row"), "simhash_row_prints")
    nodes = stored(prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_sf_row")).alias("first")),
                   "simhash_row_nodes")
    comps = components(links(nodes.select("fp"), radius))
    kept = (nodes.join(comps, nodes["fp"] == comps["node"], "left").groupBy(F.coalesce("component", "fp").alias("c"))
            .agg(F.min("first").alias("first")).select(F.col("first._sf_row").alias("_sf_kept")))
    return rows.join(kept, F.col("_sf_row") == F.col("_sf_kept"), "left_semi").select(*[F.col(f"`{c}`") for c in cols])
