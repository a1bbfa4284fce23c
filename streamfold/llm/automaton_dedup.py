"""Substring dedup by suffix automata over words (operator 11).

Every word of a document that lies in a window of ``WINDOW`` words which
also starts in a document with a smaller doc_id is removed.

Reference shards hold passages, and a suffix automaton of a shard answers
for every window that streams through it which document has it first.
What may match at all is found beforehand, so that neither the reference
nor the stream is the corpus:

1. a window's anchor is its smallest-hashing run of ``GRAM`` words (the
   leftmost of equals); about five neighbouring windows share one.  Only
   hashes of anchors move, one per document, combined before the shuffle;
2. documents get back the anchors that two documents or more have, and cut
   a passage around each: the words of the windows that share it.  Equal
   passages fold to one row with the smallest doc_id, in any number;
3. passages are dealt to shards by their anchor, so equal windows meet in
   one shard.  Each shard builds the automaton of its distinct passages
   (words are compared, not hashes), whose states carry the smallest
   document of their occurrences, and streams the passages through it:
   where the matched length reaches ``WINDOW``, the state of that length
   names the first document;
4. the answer of a passage goes back to its occurrences, as one join on
   128 bits of digest that AQE can split for a passage half the corpus holds.

An anchor with over ``HOT`` occurrences (a phrase with other neighbours in
each document) would fill its shard: its windows are dealt one by one, by
the hash of the whole window, so that only equal windows must meet.  A
shard is bounded by ``SHARD_ROWS`` passages on average and one anchor.
Exact copies of a whole text are found by digest and go whole.

Defined results: a null text counts as empty; documents under ``WINDOW``
words stay whole; words are kept unchanged and joined by one space; rows
that repeat a doc_id are one document and must repeat its text; each row
without an id is a document of its own, after all that have one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LAST, SPACE_RUN, keyed, map_batches, nonnull_text, ship, stored, utf8
from .words import is_blank, word_bounds

WINDOW = 13
GRAM = 4
SPAN = WINDOW - GRAM + 1          # anchors a window can have
HOT = 1 << 15                     # occurrences of one anchor that are dealt together
SHARD_ROWS = 1 << 13              # passages of a shard, on average
CUT = 1 << 20                     # bytes hashed at a time
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)]


class Automaton:
    """Suffix automaton of many word sequences; each state knows the
    smallest document in which its sequences end."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [LAST]

    def _state(self, moves: dict, link: int, length: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.least.append(LAST)
        return len(self.link) - 1

    def _split(self, p: int, w, q: int) -> int:
        """A state for the sequences of ``q`` that are no longer than one more than ``p``'s."""
        r = self._state(self.next[q].copy(), self.link[q], self.length[p] + 1)
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = r
            p = self.link[p]
        self.link[q] = r
        return r

    def add(self, words: list, doc: int) -> None:
        at, moves, length, least = 0, self.next, self.length, self.least
        for w in words:
            q = moves[at].get(w)
            if q is not None:
                at = q if length[q] == length[at] + 1 else self._split(at, w, q)
            else:
                new, p = self._state({}, 0, length[at] + 1), at
                while p >= 0 and w not in moves[p]:
                    moves[p][w] = new
                    p = self.link[p]
                if p >= 0:
                    q = moves[p][w]
                    self.link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
                at = new
            if doc < least[at]:
                least[at] = doc

    def settle(self) -> None:
        """Smallest documents, from longer sequences to their suffixes."""
        least, link = self.least, self.link
        for s in np.argsort(-np.array(self.length), kind="stable").tolist():
            up = link[s]
            if up > 0 and least[s] < least[up]:
                least[up] = least[s]

    def firsts(self, words: list, k: int) -> list[int]:
        """For each window of ``k`` words the first document that has it
        (LAST: none), by matching statistics."""
        out, at, matched = [], 0, 0
        moves, link, length, least = self.next, self.link, self.length, self.least
        for w in words:
            to = moves[at].get(w)
            while to is None and at:
                at = link[at]
                matched = length[at]
                to = moves[at].get(w)
            if to is not None:
                at, matched = to, matched + 1
            while at and length[link[at]] >= k:           # the state of the last k words
                at = link[at]
                matched = length[at]
            out.append(least[at] if matched >= k else LAST)
        return out[k - 1:]


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    return (np.cumprod(np.full(n, base, np.uint64)), np.cumprod(np.full(n, pow(int(base), -1, 1 << 64), np.uint64)))


def mixed(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * _ODD[2]


def word_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray, cut: int = CUT, base: np.uint64 = _ODD[0]) -> np.ndarray:
    """64-bit hash of each word; equal words have equal hashes in any text."""
    out = np.zeros(len(starts), np.uint64)
    up, down = powers(base, min(cut, len(text)))
    i = 0
    while i < len(starts):
        a = starts[i]
        j = int(np.searchsorted(ends, a + cut, side="right"))
        if j <= i:                                        # one word of over ``cut`` bytes
            out[i] = xxhash.xxh64_intdigest(text[a:ends[i]], int(base))
            i += 1
            continue
        b = np.frombuffer(text, np.uint8, count=int(ends[j - 1] - a), offset=int(a))
        terms = (b.astype(np.uint64) + np.uint64(1)) * up[:len(b)]
        terms[is_blank(b)] = 0
        own = starts[i:j] - a
        out[i:j] = np.add.reduceat(terms, own) * down[own]
        i = j
    return mixed(out)


def sequence_hashes(words: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """64-bit hash of each sequence of words ``first`` to ``after``, whose
    word hashes are given."""
    up, down = powers(_ODD[0], len(words))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up)))
    return mixed((sums[after] - sums[first]) * down[first] + (after - first).astype(np.uint64)) if len(words) else np.zeros(0, np.uint64)


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the ``k`` words from each position."""
    n = max(0, len(words) - k + 1)
    h = words[:n] + np.uint64(k)
    for i in range(1, k):
        h = (h * _ODD[0]) ^ words[i:i + n]
        h ^= h >> np.uint64(31)
    h = h * _ODD[1]
    return h ^ (h >> np.uint64(32))


class Batch:
    """The words of some documents side by side, and their anchors."""

    def __init__(self, texts: list[bytes]) -> None:
        self.text = b"\n".join(texts)
        edge = np.cumsum([len(t) + 1 for t in texts])
        self.starts, self.ends = word_bounds(self.text)
        self.doc = np.searchsorted(edge, self.starts, side="right")
        self.base = np.searchsorted(self.starts, edge - [len(t) + 1 for t in texts])    # first word of each document
        self.words = word_hashes(self.text, self.starts, self.ends)

    def digests(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Two independent 64-bit hashes of each sequence of words."""
        other = word_hashes(self.text, self.starts, self.ends, base=_ODD[1])
        return np.column_stack([sequence_hashes(w, first, after).view(np.int64) for w in (self.words, other)])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, first window, last window, hash) of each run of
        windows that share an anchor; windows as numbers of their first word."""
        n = len(self.starts) - WINDOW + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0, np.uint64)
        h = run_hashes(self.words, GRAM)
        least, at, width = h, np.arange(len(h)), 1
        while width < SPAN:
            step = min(width, SPAN - width)
            left = least[:-step] <= least[step:]
            at = np.where(left, at[:-step], at[step:])
            least = np.where(left, least[:-step], least[step:])
            width += step
        win = np.flatnonzero(self.doc[:n] == self.doc[WINDOW - 1:])
        own, at = self.doc[win], at[win]
        turn = np.flatnonzero((at[1:] != at[:-1]) | (own[1:] != own[:-1]))
        first = np.concatenate(([0], turn + 1))[:len(win)]
        last = np.concatenate((turn, [len(win) - 1]))[:len(win)]
        return own[first], win[first], win[last], h[at[first]]

    def passage(self, a: int, z: int) -> bytes:
        """The words of the windows ``a`` to ``z``, joined by one space."""
        return b" ".join(self.text[self.starts[a]:self.ends[z + WINDOW - 1]].split())


def anchor_rows(rows: DataFrame) -> DataFrame:
    """(h, doc, n): the anchors of each document and how often it has them."""
    def run(b: pa.RecordBatch):
        docs = b.column(0).to_numpy(zero_copy_only=False)
        own, _, _, h = Batch(utf8(b.column(1))).anchors()
        order = np.lexsort((h, own))
        own, h = own[order], h[order]
        at = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (h[1:] != h[:-1])))[:len(own)])
        n = np.diff(np.append(at, len(own)))
        yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(docs[own[at]], pa.int64()), pa.array(n, pa.int64())],
                                         ["h", "doc", "n"])
    return map_batches(rows.select("doc", "text"), run, "h bigint, doc bigint, n bigint")


def repeated_anchors(rows: DataFrame, hot: int) -> DataFrame:
    """(doc, keys, hot): the anchors of each document that another one has,
    and those of them that are dealt window by window."""
    anchors = anchor_rows(rows)
    shared = stored(anchors.groupBy("h").agg(F.min("doc").alias("least"), F.max("doc").alias("most"), F.sum("n").alias("n"))
                    .filter("least < most").select("h", (F.col("n") > hot).alias("crowd")), "automaton_anchors")
    # A hash table of what repeats, not a sort of all anchors.
    return (anchors.join(shared.hint("shuffle_hash"), "h").groupBy("doc")
            .agg(F.collect_set("h").alias("keys"), F.collect_set(F.when(F.col("crowd"), F.col("h"))).alias("hot")))


def copies(rows: DataFrame) -> DataFrame:
    """(doc, copy): documents whose word sequence an earlier one has."""
    said = rows.select("doc", F.unhex(F.sha2(F.trim(F.regexp_replace("text", SPACE_RUN, " ")), 256)).alias("d"))
    groups = stored(said.groupBy("d").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
                    .filter("least < most").select("d", "least"), "automaton_copies")
    return said.join(groups, "d").filter("doc > least").groupBy("doc").agg(F.lit(True).alias("copy"))


def passages(marked: DataFrame, words: bool) -> DataFrame:
    """The passages of documents around anchors that repeat.  With ``words``
    route (the shard's key), seg (the words), their two digests, and the
    smallest and largest document, a row for each distinct one of some
    documents; else the digests, document and first word of every passage."""
    def run(b: pa.RecordBatch):
        docs = b.column(0).to_numpy(zero_copy_only=False)
        batch = Batch(utf8(b.column(1)))
        own, first, last, h = batch.anchors()

        def told(lists: list[list[int]]) -> np.ndarray:    # which anchors their documents list
            salt = np.arange(1, len(lists) + 1, dtype=np.uint64) * _ODD[1]
            listed = [np.array(k, np.int64).view(np.uint64) + salt[i:i + 1] for i, k in enumerate(lists)]
            return np.isin(h + salt[own], np.concatenate(listed))
        use = told(b.column(2).to_pylist())
        alone = told(b.column(3).to_pylist())[use]         # dealt window by window
        own, first, last, h = own[use], first[use], last[use], h[use]
        many = np.where(alone, last - first + 1, 1)
        at = np.repeat(np.arange(len(own)), many)          # the anchor of each passage
        step = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        a = first[at] + step
        z = np.where(alone[at], a, last[at])
        d = docs[own[at]]
        two = batch.digests(a, z + WINDOW)
        if not words:
            yield pa.RecordBatch.from_arrays([pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(d, pa.int64()),
                                              pa.array(a - batch.base[own[at]], pa.int64())], ["d1", "d2", "doc", "start"])
            return
        route = np.where(alone[at], run_hashes(batch.words, WINDOW)[a].view(np.int64) if len(a) else 0, h[at].view(np.int64))
        order = np.lexsort((d, two[:, 1], two[:, 0]))
        new = np.concatenate(([True], (two[order][1:] != two[order][:-1]).any(axis=1)))[:len(order)]
        i = order[new]                                     # the smallest document of each distinct passage
        j = order[np.append(np.flatnonzero(new)[1:] - 1, len(order) - 1)] if len(order) else order
        segs = [batch.passage(p, q) for p, q in zip(a[i].tolist(), z[i].tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(route[i], pa.int64()), pa.array(segs, pa.binary()), pa.array(two[i, 0]), pa.array(two[i, 1]),
             pa.array(d[i], pa.int64()), pa.array(d[j], pa.int64())], ["route", "seg", "d1", "d2", "least", "most"])
    return map_batches(marked.select("doc", "text", "keys", "hot"), run,
                       "route bigint, seg binary, d1 bigint, d2 bigint, least bigint, most bigint" if words
                       else "d1 bigint, d2 bigint, doc bigint, start bigint")


def first_documents(found: DataFrame, shards: int) -> DataFrame:
    """(d1, d2, firsts): the first document of each window of the distinct
    passages, from the automaton of their shard.  Passages whose windows no
    later document has are left out."""
    ship()
    # Dealt by shard once; equal passages fold behind that exchange, in Spark's
    # hash aggregate, so a shard's task holds distinct ones alone.
    refs = (found.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards))).repartition("shard")
            .groupBy("shard", "route", "seg", "d1", "d2").agg(F.min("least").alias("least"), F.max("most").alias("most")))

    def run(t: pa.Table) -> pa.Table:
        auto, words = Automaton(), [s.split(b" ") for s in t.column("seg").to_pylist()]
        for w, doc in zip(words, t.column("least").to_pylist()):
            auto.add(w, doc)
        auto.settle()
        got = [auto.firsts(w, WINDOW) for w in words]
        use = [i for i, (f, most) in enumerate(zip(got, t.column("most").to_pylist())) if min(f) < most]
        pick = t.select(["d1", "d2"]).take(pa.array(use, pa.int64()))
        return pick.append_column("firsts", pa.array([got[i] for i in use], pa.list_(pa.int64())))
    return refs.groupBy("shard").applyInArrow(run, "d1 bigint, d2 bigint, firsts array<bigint>")


def repeated_windows(marked: DataFrame, shards: int) -> DataFrame:
    """(doc, wins): the first words of the covered windows of each document."""
    firsts = first_documents(passages(marked, True), shards)
    told = passages(marked, False).join(firsts, ["d1", "d2"]).filter(F.array_min("firsts") < F.col("doc"))
    covered = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc"), F.col("start") + i)), lambda x: x.isNotNull())
    return told.select("doc", covered.alias("wins")).groupBy("doc").agg(F.flatten(F.collect_list("wins")).alias("wins"))


def cut(text: bytes, wins: list[int] | None, copy: bool) -> tuple[bytes, int, list[tuple[int, int]]]:
    """(words left, number of words, removed runs of words) when the windows
    that start at the words ``wins`` are covered."""
    words = text.split()
    if copy and len(words) >= WINDOW:
        return b"", len(words), [(0, len(words))]
    runs: list[list[int]] = []
    for a in sorted(wins or []):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = a + WINDOW
        else:
            runs.append([a, a + WINDOW])
    out, at = [], 0
    for a, z in runs:
        out += words[at:a]
        at = z
    return b" ".join(out + words[at:]), len(words), [(a, z) for a, z in runs]


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False,
                   hot: int = HOT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, kept (the remaining words joined by one space) and spans
    (removed runs, in words) per document; with ``digests`` n_words,
    n_removed and kept_sha256."""
    rows, doc_id = keyed(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "id", "automaton_loose")
    rows = rows.select(F.col("_sf_doc").alias("doc"), nonnull_text("text").alias("text"))
    shared = stored(repeated_anchors(rows, hot), "automaton_keys")
    whole = stored(copies(rows), "automaton_copied")
    shards = 1 + (shared.agg(F.sum(F.size("keys"))).first()[0] or 0) // shard_rows
    marked = rows.join(shared, "doc").join(whole, "doc", "left").filter("copy is null").select("doc", "text", "keys", "hot")
    full = rows.join(repeated_windows(marked, shards), "doc", "left").join(whole, "doc", "left").withColumnRenamed(
        "doc", "_sf_doc").select(doc_id.alias("doc_id"), "text", "wins", F.coalesce("copy", F.lit(False)).alias("copy"))

    def run(b: pa.RecordBatch):
        got = [cut(t, w, c) for t, w, c in zip(utf8(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist())]
        if digests:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[1] for g in got], pa.int64()),
                 pa.array([sum(z - a for a, z in g[2]) for g in got], pa.int64()),
                 pa.array([hashlib.sha256(g[0]).hexdigest() for g in got], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])
        else:
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.binary()).cast(pa.string()),
                 pa.array([[{"start": a, "end": z} for a, z in g[2]] for g in got], kind)], ["doc_id", "kept", "spans"])
    return map_batches(full, run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" if digests
                       else "doc_id bigint, kept string, spans array<struct<start: bigint, end: bigint>>")
