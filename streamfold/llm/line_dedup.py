"""Line dedup over overlapping three-line windows (operator 2).

A text is split at line feeds; lines that hold only white space are no
lines of a window and stay where they are, unless both neighbours go.
Each run of ``WINDOW`` consecutive lines (stripped) is hashed to 128 bits.  Windows
found in several documents are looked up globally; every occurrence but
the first, by doc_id and then by position, covers its lines; covered
positions are merged and removed.

Only (hash, doc_id) rows are shuffled to find repeats, one per distinct
window of a document and combined before the shuffle; a window that half
of the corpus shares is one row per task.  The repeats are then joined back
as a plain stored table, so that AQE can split a hot window.

Defined results: a null text counts as empty (and stays null when nothing
is removed); texts under three lines have no window and stay as they are;
rows that repeat a doc_id count as one document; rows without an id come
after all others, each as a document of its own; an empty table gives an
empty result; extra columns are carried unchanged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import keyed, map_batches, stored

WINDOW = 3
BLANK = " \t\r\x0b\x0c"


def windows(text: str | None) -> tuple[list[str], list[int], list[bytes]]:
    """(lines, positions of lines that are not blank, hash of the window
    that starts at each of these positions)."""
    lines = text.split("\n") if text else []
    full = [(i, s) for i, s in enumerate(x.strip(BLANK) for x in lines) if s]
    at, said = [i for i, _ in full], [s.encode("utf-8", "surrogatepass") for _, s in full]
    return lines, at, [xxhash.xxh3_128_digest(b"\n".join(said[i:i + WINDOW])) for i in range(len(said) - WINDOW + 1)]


def uncovered(text: str | None, elsewhere: set[bytes]) -> tuple[str | None, int, int, int]:
    """(text left, lines, lines removed, removed runs) when windows of
    ``elsewhere`` occur in an earlier document."""
    lines, at, hashes = windows(text)
    gone, seen = np.zeros(len(at), dtype=bool), set()
    for i, h in enumerate(hashes):
        if h in elsewhere or h in seen:
            gone[i:i + WINDOW] = True
        seen.add(h)
    if not gone.any():
        return text, len(lines), 0, 0
    drop = np.zeros(len(lines), dtype=bool)
    for i in np.flatnonzero(gone):
        drop[at[i]] = True
        if i + 1 < len(at) and gone[i + 1]:
            drop[at[i]:at[i + 1]] = True
    runs = int(drop[0]) + int(np.count_nonzero(drop[1:] & ~drop[:-1]))
    return "\n".join(s for s, d in zip(lines, drop) if not d), len(lines), int(drop.sum()), runs


def window_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """(h, doc): one row per distinct window of a document (of ``keyed``)."""
    rows = docs.select(F.col("_sf_doc").alias("doc"), F.col(f"`{text_col}`").alias("text"))

    def run(b: pa.RecordBatch):
        hs, ds = [], []
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = set(windows(t)[2])
            hs += own
            ds += [d] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(hs, pa.binary()), pa.array(ds, pa.int64())], ["h", "doc"])
    return map_batches(rows, run, "h binary, doc bigint")


def later_windows(docs: DataFrame, text_col: str) -> DataFrame:
    """(doc, hs): the windows of each document that an earlier one has."""
    rows = window_rows(docs, text_col)
    shared = stored(rows.groupBy("h").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                    .filter("first < last").select("h", "first"), "line_windows")
    return (rows.join(shared, "h").filter("doc > first")
            .groupBy("doc").agg(F.array_join(F.collect_list(F.hex("h")), "").alias("_sf_hs")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                report: bool = False) -> DataFrame:
    """All columns with the covered lines gone from the text; with
    ``report`` the columns _sf_lines, _sf_removed and _sf_runs as well."""
    cols = docs.columns
    rows, _ = keyed(docs, id_col, "line_loose")
    later = later_windows(rows, text_col).withColumnRenamed("doc", "_sf_later")
    both = rows.join(later, F.col("_sf_doc") == F.col("_sf_later"), "left").select(
        *[F.col(f"`{c}`") for c in cols], "_sf_hs")
    k = cols.index(text_col)
    fields = list(both.schema.fields[:-1])
    fields[k] = StructField(text_col, StringType())
    extra = [StructField(n, LongType()) for n in ("_sf_lines", "_sf_removed", "_sf_runs")]

    def run(b: pa.RecordBatch):
        got = []
        for t, hs in zip(b.column(k).to_pylist(), b.column(len(cols)).to_pylist()):
            raw = bytes.fromhex(hs or "")
            got.append(uncovered(t, {raw[i:i + 16] for i in range(0, len(raw), 16)}))
        out = list(b.columns[:-1])
        out[k] = pa.array([g[0] for g in got], pa.string())
        out += [pa.array([g[j] for g in got], pa.int64()) for j in (1, 2, 3)]
        yield pa.RecordBatch.from_arrays(out, [*cols, "_sf_lines", "_sf_removed", "_sf_runs"])
    full = map_batches(both, run, StructType(fields + extra))
    return full if report else full.select(*[F.col(f"`{c}`") for c in cols])
