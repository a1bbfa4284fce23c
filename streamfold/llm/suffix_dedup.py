"""Suffix-array dedup by a depth-limited radix sort (operator 3).

Every byte of a document that lies in a ``WINDOW``-byte string which also
starts in a document with a smaller doc_id is removed.

The suffixes are sorted most-significant digit first, through ``WINDOW``
bytes and no deeper; equal groups after the last digit are exactly the
repeated windows.  Moving one record per suffix would move the corpus many
times, so the order of the digits inside a window is chosen to let
neighbouring suffixes travel together: the first digit of a window is its
smallest-hashing ``GRAM``-byte string (the leftmost of equals).  About 13
neighbouring windows share that anchor, and one record stands for them all.

Pass 1 moves only hashes of first digits and keeps anchors whose digit is
met in two documents or more.  Pass 2 moves those anchors with the bytes
their windows span, groups them by the digit, and refines each group byte
by byte, to the right and to the left of the anchor, with exact ranks;
windows are equal when both ranks are.  Each task first settles
what repeats among its own documents, so a passage that a third of the
corpus holds is one record per flush of a task, not one per document.
A digit with over ``HOT`` different contexts (a phrase with other
neighbours in each document) is not refined in one group: its contexts are
halved by the offset of the anchor, and the bytes that all windows of a
half have left or right of it become part of the grouping key; halves that
are still crowded are halved again, down to single windows.
Exact copies of a whole text are found by digest: all but the first go
whole, and take no part in pass 2.

The text is shuffled once, by document; both joins reuse that exchange.

Defined results: a null text counts as empty; texts under ``WINDOW`` bytes
stay whole; rows that repeat a doc_id are taken as one document and must
repeat its text; each row without an id is a document of its own, after
all that have one; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST, keyed, map_batches, nonnull_text, pieces, ship, stored, utf8

WINDOW = 50
GRAM = 26
SPAN = WINDOW - GRAM + 1          # first digits a window can begin with
SEGMENT = 1 << 20                 # bytes hashed at a time
FLUSH = 1 << 21                   # anchors settled at a time within a task
BUCKET_BYTES = 8 << 20            # pass-1 bytes aimed at per bucket
HOT = 1 << 17                     # contexts of one digit that are refined in one group
SAMPLE = 1 << 11                  # contexts of a sample by which a digit is found to be hot
DEPTH = 5                         # halvings of SPAN offsets to single ones
KEY48 = np.uint64((1 << 48) - 1)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                               0xFF51AFD7ED558CCD)]


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position."""
    def joined(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        h = x * _ODD[k] + (y ^ (y >> np.uint64(31)))
        return h ^ (h >> np.uint64(29))
    h1 = (b.astype(np.uint64) + np.uint64(1)) * _ODD[4]
    h2 = joined(h1[:-1], h1[1:], 0)
    h4 = joined(h2[:-2], h2[2:], 1)
    h8 = joined(h4[:-4], h4[4:], 2)
    h16 = joined(h8[:-8], h8[8:], 3)
    h24 = joined(h16[:-8], h8[16:], 0)
    h = joined(h24[:-2], h2[24:], 1) * _ODD[4]
    return h ^ (h >> np.uint64(32))


def anchors(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor, hash of its gram) of each run of
    windows of ``b`` that share an anchor."""
    if len(b) < WINDOW:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    h = gram_hashes(b)
    val, at, width = h, np.arange(len(h), dtype=np.int32), 1
    while width < SPAN:
        step = min(width, SPAN - width)
        left = val[:-step] <= val[step:]
        at = np.where(left, at[:-step], at[step:])
        val = np.where(left, val[:-step], val[step:])
        width += step
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    p = at[first].astype(np.int64)
    return first, last, p, h[p]


def text_anchors(text: bytes):
    """``anchors`` of a text of any length, segment by segment.  A run cut
    by a segment's end is two runs, which changes no window."""
    b = np.frombuffer(text, np.uint8)
    step = SEGMENT - WINDOW + 1
    for a in range(0, max(1, len(b) - WINDOW + 1), step):
        first, last, p, h = anchors(b[a:a + SEGMENT])
        yield first + a, last + a, p + a, h


def _grouped_anchors(docs: list[tuple[int, bytes]]):
    """(index of the document, first, last, anchor, hash) arrays for many
    documents; short ones are hashed side by side."""
    held, size = [], 0

    def side_by_side():
        b = np.frombuffer(b"".join(t for _, t in held), np.uint8)
        ends = np.cumsum([len(t) for _, t in held])
        starts = ends - [len(t) for _, t in held]
        first, last, p, h = anchors(b)
        if not len(first):
            return
        # Cut runs where windows would cross into the next document.
        d = np.searchsorted(ends, first, side="right")
        cut_last = np.minimum(last, ends[d] - WINDOW)
        ok = first <= cut_last
        own = [(d[ok], first[ok], cut_last[ok], p[ok], h[ok])]
        while True:                                      # the part of a run in a later document
            more = (d < len(ends) - 1) & (last >= ends[np.minimum(d, len(ends) - 1)])
            if not more.any():
                break
            first, last, p, h, d = first[more], last[more], p[more], h[more], d[more]
            first, d = ends[d], d + 1
            cut_last = np.minimum(last, ends[d] - WINDOW)
            ok = first <= cut_last
            own.append((d[ok], first[ok], cut_last[ok], p[ok], h[ok]))
        d, first, last, p, h = (np.concatenate(x) for x in zip(*own))
        names = np.array([i for i, _ in held])
        yield names[d], first - starts[d], last - starts[d], p - starts[d], h
    for i, t in docs:
        if len(t) < WINDOW:
            continue
        if len(t) > SEGMENT // 4:
            for first, last, p, h in text_anchors(t):
                yield np.full(len(first), i), first, last, p, h
            continue
        held.append((i, t))
        size += len(t)
        if size > SEGMENT:
            yield from side_by_side()
            held, size = [], 0
    if held:
        yield from side_by_side()


def _planes(x: np.ndarray, width: int) -> bytes:
    """Little-endian bytes by significance: planes that hardly change
    compress well in the shuffle."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(raw: bytes, width: int) -> np.ndarray:
    m = np.zeros((len(raw) // width, 8), np.uint8)
    m[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return m.view("<u8").ravel().astype(np.uint64)


def _bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """By the low 48 bits: an anchor's hash is the least of many, so its
    high bits are mostly zero."""
    return ((key >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


MESSAGE = "bucket int, doc bigint, keys binary, docs binary, many binary"


def settle_digits(d: np.ndarray, key: np.ndarray, buckets: int, salt: int):
    """Pass 1 of one flush: (bucket, doc, keys, docs, many) rows.  Each key
    goes to its bucket once, for the smallest document that has it, with a
    mark when others of this flush have it too; those others are known to
    share it and travel as answers (bucket < 0)."""
    order = np.lexsort((d, key))
    key, d = key[order], d[order]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (d[1:] != d[:-1])))
    key, d = key[new], d[new]
    head = np.concatenate(([True], key[1:] != key[:-1]))
    starts = np.flatnonzero(head)
    many = np.diff(np.concatenate((starts, [len(key)]))) > 1
    k1, d1 = key[head], d[head]
    b1 = _bucket_of(k1, buckets)
    edges = np.searchsorted(b1, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        s = slice(edges[b], edges[b + 1])
        uniq, at = np.unique(d1[s], return_inverse=True)
        yield (int(b), None, _planes(k1[s], 6), uniq.astype("<i8").tobytes() + at.astype("<u4").tobytes(),
               np.packbits(many[s]).tobytes())
    if not head.all():
        rest_d, rest_k = d[~head], key[~head]
        order = np.argsort(rest_d, kind="stable")
        rest_d, rest_k = rest_d[order], rest_k[order]
        cuts = np.flatnonzero(np.concatenate(([True], rest_d[1:] != rest_d[:-1])))
        for a, z in zip(cuts, [*cuts[1:], len(rest_d)]):
            yield -1 - (salt + int(a)) % buckets, int(rest_d[a]), _planes(rest_k[a:z], 6), None, None


def first_digits(docs: DataFrame, buckets: int) -> DataFrame:
    """Pass 1, map side.  ``docs``: doc, text."""
    ship()

    def run(batches):
        ds, ks, n, seen = [], [], 0, {}

        def flush():
            nonlocal n
            if not n:
                return
            rows = list(settle_digits(np.concatenate(ds), np.concatenate(ks), buckets, int(ks[0][0] % 1009)))
            ds.clear()
            ks.clear()
            seen.clear()
            n = 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                ["bucket", "doc", "keys", "docs", "many"])
        for batch in batches:
            for b in pieces(batch):
                mine = []
                for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                    # Of copies within a flush only the first is looked at.
                    digest = hashlib.blake2b(text, digest_size=16).digest()
                    if seen.get(digest, LAST + 1) > doc:
                        seen[digest] = doc
                        mine.append((doc, text))
                for d, _, _, _, h in _grouped_anchors(mine):
                    ds.append(d.astype(np.int64))
                    ks.append(h & KEY48)
                    n += len(d)
                if n >= FLUSH:
                    yield from flush()
        yield from flush()
    return docs.select("doc", "text").mapInArrow(run, MESSAGE)


def repeated_digits(messages: DataFrame) -> DataFrame:
    """Pass 1, reduce side: (doc, key) of digits met in two documents."""
    def run(t: pa.Table) -> pa.Table:
        if not t.num_rows or t.column("bucket")[0].as_py() < 0:
            known = [_from_planes(k, 6).view(np.int64) for k in t.column("keys").to_pylist()]
            doc = np.repeat(t.column("doc").to_numpy(), [len(k) for k in known])
            return pa.table({"doc": pa.array(doc, pa.int64()), "key": np.concatenate([np.zeros(0, np.int64), *known])})
        ks, ds, ms = [], [], []
        for k, d, m in zip(*(t.column(c).to_pylist() for c in ("keys", "docs", "many"))):
            key = _from_planes(k, 6)
            n = len(key)
            at = np.frombuffer(d[-4 * n:], "<u4")
            ks.append(key)
            ds.append(np.frombuffer(d[:-4 * n], "<i8")[at])
            ms.append(np.unpackbits(np.frombuffer(m, np.uint8), count=n).astype(bool))
        key, doc, many = np.concatenate(ks), np.concatenate(ds), np.concatenate(ms)
        order = np.argsort(key, kind="stable")
        key, doc, many = key[order], doc[order], many[order]
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        hit = (np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)) | np.logical_or.reduceat(many, starts)
        sel = np.repeat(hit, np.diff(np.concatenate((starts, [len(key)]))))
        return pa.table({"doc": pa.array(doc[sel], pa.int64()), "key": pa.array(key[sel].view(np.int64), pa.int64())})
    return messages.groupBy("bucket").applyInArrow(run, "doc bigint, key bigint")


CONTEXT = "bucket int, h bigint, omax int, ctx binary, doc bigint, at array<bigint>"


def contexts(marked: DataFrame, buckets: int) -> DataFrame:
    """Pass 2, map side.  ``marked``: doc, text, keys (list), copy, hot
    (list of digit + (halvings << 48)).  Rows with a context go to the
    bucket of their digit, those of a hot digit to that of the bytes which
    the windows of a part share; rows without one (bucket < 0) are spans
    already known to be covered: at = start, end."""
    edges = [[SPAN * i >> k for i in range((1 << k) + 1)] for k in range(DEPTH + 1)]
    ship()

    def run(batches):
        held: dict[tuple, list] = {}
        covered: dict[int, list] = {}

        def add(doc, text, keys, hot):
            found, levels = np.unique(np.array(keys, np.uint64)), {x & int(KEY48): x >> 48 for x in hot or ()}
            for first, last, p, h in text_anchors(text):
                k = h & KEY48
                j = np.searchsorted(found, k)
                j[j == len(found)] = 0
                for a, z, at, g in zip(*(x[found[j] == k].tolist() for x in (first, last, p, h))):
                    level = levels and levels.get(g & int(KEY48))
                    if not level:
                        hold(doc, at, (g, at - a, text[a:z + WINDOW], None))
                        continue
                    for lo, end in zip(edges[level], edges[level][1:]):
                        o, least = min(end - 1, at - a), max(lo, at - z)
                        if least <= o:
                            said = xxhash.xxh3_64_intdigest(text[at - lo:at - end + 1 + WINDOW], lo)
                            hold(doc, at, (g, o, text[at - o:at - least + WINDOW], said % buckets))

        def hold(doc, at, key):
            other = held.get(key)
            if other is None:
                held[key] = [doc, [at]]
            elif other[0] == doc:
                other[1].append(at)
            else:
                late, spots = (doc, [at]) if doc > other[0] else other
                if doc < other[0]:
                    held[key] = [doc, [at]]
                for s in spots:
                    covered.setdefault(late, []).append((s - key[1], s - key[1] + len(key[2])))

        def flush():
            g, o, c, own, d, at = [], [], [], [], [], []
            for (h, omax, ctx, b), (doc, spots) in held.items():
                g.append(h), o.append(omax), c.append(ctx), own.append(-1 if b is None else b), d.append(doc), at.append(spots)
            h, own = np.array(g, np.uint64), np.array(own, np.int64)
            bucket = np.where(own < 0, _bucket_of(h & KEY48, buckets), own).astype(np.int32)
            spans = [(doc, [x for s in merged(v) for x in s]) for doc, v in covered.items()]
            n = len(spans)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate((bucket, -1 - np.arange(n, dtype=np.int32) % buckets)).astype(np.int32)),
                pa.array(np.concatenate((h.view(np.int64), np.zeros(n, np.int64)))), pa.array(o + [0] * n, pa.int32()),
                pa.array(c + [None] * n, pa.binary()), pa.array(d + [s[0] for s in spans], pa.int64()),
                pa.array(at + [s[1] for s in spans], pa.list_(pa.int64()))], CONTEXT_NAMES)
            held.clear()
            covered.clear()
        for batch in batches:
            for b in pieces(batch):
                for doc, text, keys, copy, hot in zip(b.column(0).to_pylist(), utf8(b.column(1)),
                                                      *(b.column(i).to_pylist() for i in (2, 3, 4))):
                    if keys and not copy and len(text) >= WINDOW:
                        add(doc, text, keys, hot)
                        if len(held) > FLUSH // 16:
                            yield from flush()
        if held or covered:
            yield from flush()
    return marked.select("doc", "text", "keys", "copy", "hot").mapInArrow(run, CONTEXT)


CONTEXT_NAMES = ["bucket", "h", "omax", "ctx", "doc", "at"]


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def refine(group: np.ndarray, omax: np.ndarray, ctx: list[bytes], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Radix passes over the contexts of one bucket: for each, the largest
    and the smallest offset of a window that a smaller document has
    (-1 where none)."""
    n, side = len(ctx), SPAN - 1
    length = np.fromiter(map(len, ctx), np.int64, n)
    m = np.zeros((n, WINDOW + side), np.uint8)
    for i, (c, o) in enumerate(zip(ctx, omax.tolist())):
        m[i, side - o:side - o + len(c)] = np.frombuffer(c, np.uint8)
    omin = omax - (length - WINDOW)

    def ranks(*keys: np.ndarray) -> np.ndarray:
        out = keys[0].astype(np.int64)
        for k in keys[1:]:
            out = np.unique(out * 256 + k, return_inverse=True)[1]
        return out
    base = np.unique(group, return_inverse=True)[1].astype(np.int64)
    for j in range(GRAM):
        base = ranks(base, m[:, side + j])
    right, left = [base], [base]
    for j in range(side):
        right.append(ranks(right[-1], m[:, side + GRAM + j]))
        left.append(ranks(left[-1], m[:, side - 1 - j]))
    top, low = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    for o in range(SPAN):
        ok = np.flatnonzero((omin <= o) & (o <= omax))
        if len(ok) < 2:
            continue
        uniq, cls = np.unique(left[o][ok] * n + right[side - o][ok], return_inverse=True)
        least = np.full(len(uniq), LAST, np.int64)
        np.minimum.at(least, cls, doc[ok])
        hit = ok[doc[ok] > least[cls]]
        low[hit[low[hit] < 0]] = o
        top[hit] = o
    return top, low


def repeated_windows(messages: DataFrame) -> DataFrame:
    """Pass 2, reduce side: (doc, spans) of covered bytes, as start, end, ..."""
    def run(t: pa.Table) -> pa.Table:
        if not t.num_rows or t.column("bucket")[0].as_py() < 0:
            return t.select(["doc", "at"]).rename_columns(["doc", "spans"])
        docs, spans = [], []                  # a row for each covered context: they grow with the input alone
        first: dict[tuple, int] = {}          # one entry per distinct context, its smallest document
        rows = list(zip(*(t.column(c).to_pylist() for c in ("h", "omax", "ctx", "doc", "at"))))
        for i, (_, o, ctx, doc, _) in enumerate(rows):
            j = first.setdefault((o, ctx), i)
            if rows[j][3] > doc:
                first[(o, ctx)] = i
        for _, o, ctx, doc, at in rows:
            if rows[first[(o, ctx)]][3] < doc:
                docs.append(doc)
                spans.append([x for p in at for x in (p - o, p - o + len(ctx))])
        own = list(first.values())
        g = np.array([rows[i][0] for i in own], np.int64)
        _, cls, n = np.unique(g, return_inverse=True, return_counts=True)
        left = [i for i, many in zip(own, (n[cls] > 1).tolist()) if many]
        if left:
            top, low = refine(np.array([rows[i][0] for i in left], np.int64), np.array([rows[i][1] for i in left]),
                              [rows[i][2] for i in left], np.array([rows[i][3] for i in left], np.int64))
            for i, a, z in zip(left, top.tolist(), low.tolist()):
                if a >= 0:
                    docs.append(rows[i][3])
                    spans.append([x for p in rows[i][4] for x in (p - a, p - z + WINDOW)])
        return pa.table({"doc": pa.array(docs, pa.int64()), "spans": pa.array(spans, pa.list_(pa.int64()))})
    return messages.groupBy("bucket").applyInArrow(run, "doc bigint, spans array<bigint>")


def copies(docs: DataFrame) -> DataFrame:
    """(doc, copy): documents whose whole text an earlier one has."""
    rows = docs.select("doc", F.unhex(F.sha2("text", 256)).alias("d"))
    groups = stored(rows.groupBy("d").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                    .filter("least < most").select("d", "least"), "suffix_copies")
    return rows.join(groups, "d").filter("doc > least").groupBy("doc").agg(F.lit(True).alias("copy"))


def crowded(marked: DataFrame, buckets: int, hot: int) -> DataFrame:
    """(key,): digits with over about ``hot`` different contexts in a
    bucket, judged by a sample of documents; which these are changes no
    result."""
    share = max(1, hot // SAMPLE)
    some = contexts(marked.filter(F.pmod(F.xxhash64("doc"), F.lit(share)) == 0), buckets).filter("bucket >= 0")
    return stored(some.groupBy("bucket", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot // share)
                  .select(F.col("h").bitwiseAND(F.lit(int(KEY48))).alias("key")).distinct(), "suffix_crowded")


def with_hot(marked: DataFrame, shared: DataFrame, buckets: int, hot: int) -> DataFrame:
    """``marked`` with the hot digits of each document (null: none)."""
    out, levels = marked.withColumn("hot", F.lit(None).cast("array<bigint>")), None
    for _ in range(DEPTH):
        more = crowded(out, buckets, hot)
        if more.isEmpty():
            break
        more = more.withColumn("level", F.lit(1).cast("bigint"))
        levels = more if levels is None else stored(
            levels.unionAll(more).groupBy("key").agg(F.sum("level").alias("level")), "suffix_hot")
        own = (shared.select("doc", F.explode("keys").alias("key")).join(levels, "key")
               .groupBy("doc").agg(F.collect_set(F.col("key") + F.shiftleft("level", 48)).alias("hot")))
        out = marked.join(stored(own, "suffix_hot_docs"), "doc", "left")
    return out


def repeated_spans(marked: DataFrame, buckets: int) -> DataFrame:
    """(doc, spans): the covered bytes of each document."""
    return (repeated_windows(contexts(marked, buckets))
            .groupBy("doc").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def cut(text: bytes, spans: list[int] | None, copy: bool) -> tuple[bytes, list[tuple[int, int]]]:
    """(bytes left, removed runs)."""
    if copy and len(text) >= WINDOW:
        return b"", [(0, len(text))]
    runs = merged(list(zip(spans[::2], spans[1::2]))) if spans else []
    out, at = [], 0
    for a, z in runs:
        out.append(text[at:a])
        at = z
    return b"".join([*out, text[at:]]), runs


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
                     hot: int = HOT) -> DataFrame:
    """doc_id, kept (the remaining bytes) and spans (removed runs) per
    document; with ``digests`` n_bytes, n_removed, n_spans, kept_sha256."""
    rows, doc_id = keyed(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "suffix_loose")
    rows = rows.select(F.col("_sf_doc").alias("doc"), nonnull_text("text").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + int(n_bytes * 2 / (SPAN + 1) * 8) // BUCKET_BYTES
    digits = repeated_digits(first_digits(rows, buckets)).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    whole = stored(copies(rows), "suffix_copied")
    shared = stored(digits, "suffix_digits")
    marked = (rows.join(shared, "doc", "left").join(whole, "doc", "left")
              .select("doc", "text", "keys", F.coalesce("copy", F.lit(False)).alias("copy")))
    marked = with_hot(marked.filter("keys is not null and not copy"), shared, 2 * buckets, hot)
    spans = repeated_spans(marked, 2 * buckets)
    full = rows.join(spans, "doc", "left").join(whole, "doc", "left").withColumnRenamed("doc", "_sf_doc").select(
        doc_id.alias("doc_id"), "text", "spans", F.coalesce("copy", F.lit(False)).alias("copy"))

    def run(b: pa.RecordBatch):
        got, texts = [], utf8(b.column(1))
        for t, s, c in zip(texts, b.column(2).to_pylist(), b.column(3).to_pylist()):
            got.append(cut(t, s, c))
        if digests:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(map(len, texts)), pa.int64()),
                 pa.array([sum(z - a for a, z in g[1]) for g in got], pa.int64()),
                 pa.array([len(g[1]) for g in got], pa.int64()),
                 pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
        else:
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.binary()),
                 pa.array([[{"start": a, "end": z} for a, z in g[1]] for g in got], kind)], ["doc_id", "kept", "spans"])
    return map_batches(full, run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
                       if digests else "doc_id bigint, kept binary, spans array<struct<start: bigint, end: bigint>>")
