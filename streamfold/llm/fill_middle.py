"""Fill-in-middle transformation on piece tables (operator 13).

A document is a list of descriptors (buffer, start, end) over immutable
buffers: its UTF-8 text and the three sentinels.  Cutting splits a
descriptor, arranging permutes descriptors, and the inverse permutation
restores the text; no text is copied until a result is asked for, and a
hash takes the descriptors' bytes as they stand.

The text is cut at two token ends drawn from the document's id; a token is
a word with the white space before it, and white space at the end is a
token of its own.  The form (plain, ``psm`` or ``spm``) is drawn as well.
A text that holds a sentinel stays plain: every sentinel of an output is
then a mark of its own, so ``restore`` finds the cuts in the output alone.
A sentinel can't arise where two parts meet, since sentinels are set
between them and no sentinel ends with the start of another.

Each row is transformed alone: nothing is shuffled, and a task holds one
text and its table at a time.

Defined results: a null text counts as empty and is plain; an empty text
is plain with no tokens; a null id draws as the empty string; rows that
repeat an id and a text are transformed alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, utf8
from .words import code_points, word_bounds

# --- fixed values of the contract ---
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = "42"
FIM_PERCENT = 50
SPM_PERCENT = 80
# ---
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Descriptors of a form, by name: what it is a permutation of.
LAYOUT = {PSM: (PREFIX, "prefix", SUFFIX, "suffix", MIDDLE, "middle"),
          SPM: (SUFFIX, "suffix", PREFIX, "prefix", MIDDLE, "middle")}
ORDER = ("prefix", "middle", "suffix")
SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
DIGEST_SCHEMA = SCHEMA.replace("output string", "output_sha256 string, restored_sha256 string")


@dataclass(frozen=True)
class PieceTable:
    """Descriptors over immutable buffers."""
    pieces: tuple[tuple[bytes, int, int], ...]

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls(((text, 0, len(text)),))

    def cut(self, *at: int) -> PieceTable:
        """Split at offsets (ascending) of the whole; n cuts of one
        descriptor give n + 1, empty ones among them."""
        out, pos, todo = [], 0, list(at)
        for buf, a, z in self.pieces:
            while todo and todo[0] <= pos + z - a:
                k = a + todo.pop(0) - pos
                out.append((buf, a, k))
                pos, a = pos + k - a, k
            out.append((buf, a, z))
            pos += z - a
        return PieceTable(tuple(out))

    def arrange(self, order: list[int]) -> PieceTable:
        return PieceTable(tuple(self.pieces[i] for i in order))

    def __add__(self, other: PieceTable) -> PieceTable:
        return PieceTable(self.pieces + other.pieces)

    def chunks(self):
        return (memoryview(buf)[a:z] for buf, a, z in self.pieces)

    def sha256(self) -> str:
        h = hashlib.sha256()
        for c in self.chunks():
            h.update(c)
        return h.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.chunks())


def draws(doc_id: int | None, seed: str = SEED) -> list[int]:
    """The four numbers of a document."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def token_ends(text: bytes) -> list[int]:
    """Where each token of ``text`` ends."""
    ends = word_bounds(text)[1].tolist()
    return ends if not text or (ends and ends[-1] == len(text)) else [*ends, len(text)]


def transform(text: bytes, h: list[int], fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> tuple[int, str, tuple[int, int], PieceTable]:
    """(tokens, form, offsets of the two cuts, the output)."""
    ends = [0, *token_ends(text)]
    n = len(ends) - 1
    table = PieceTable.of(text)
    if not text or h[2] % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, PLAIN, (0, 0), table
    form = SPM if h[3] % 100 < spm_percent else PSM
    at = tuple(ends[i] for i in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    parts = table.cut(*at) + PieceTable.of(PREFIX) + PieceTable.of(SUFFIX) + PieceTable.of(MIDDLE)
    place = dict(zip((*ORDER, PREFIX, SUFFIX, MIDDLE), range(6)))
    return n, form, at, parts.arrange([place[x] for x in LAYOUT[form]])


def restore(output: bytes, form: str) -> PieceTable:
    """The text of an output, found from its form and sentinels."""
    if form == PLAIN:
        return PieceTable.of(output)
    layout, cuts, at = LAYOUT[form], [], 0
    for mark in layout[::2]:
        at = output.index(mark, at)
        cuts += [at, at + len(mark)]
        at += len(mark)
    parts = PieceTable.of(output).cut(*cuts)           # the first is empty: an output starts with a mark
    return parts.arrange([1 + layout.index(x) for x in ORDER])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, digests: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output; with
    ``digests`` SHA-256 of the output and of the text restored from it."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(b: pa.RecordBatch):
        got = []
        for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
            n, form, (i, j), table = transform(text, draws(doc, seed), fim_percent, spm_percent)
            chars = (None, None) if form == PLAIN else (code_points(text[:i]), code_points(text[i:j]))
            out = table.bytes()
            tail = (table.sha256(), restore(out, form).sha256()) if digests else (out,)
            got.append((n, form, *chars, *tail))
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), *([pa.string()] * 2 if digests else [pa.binary()])]
        cols = [pa.array(c, k) for c, k in zip(zip(*got), kinds)]
        if not digests:
            cols[-1] = cols[-1].cast(pa.string())
        names = [c.split()[0] for c in (DIGEST_SCHEMA if digests else SCHEMA).split(", ")]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names)
    return map_batches(rows, run, DIGEST_SCHEMA if digests else SCHEMA)


def restored(outputs: DataFrame) -> DataFrame:
    """doc_id and text of a table with doc_id, form and output."""
    def run(b: pa.RecordBatch):
        texts = [restore(o, f).bytes() for f, o in zip(b.column(1).to_pylist(), utf8(b.column(2)))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])
    return map_batches(outputs.select("doc_id", "form", "output"), run, "doc_id bigint, text string")
