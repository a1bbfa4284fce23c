"""SentencePiece encoding and decoding by a distinct-chunk table (operator 10).

No piece of such a model holds a white-space marker after another
character, so no merge crosses the start of a marked word.  Every task
keeps a table of distinct marked words: their ids as text and, where that
is not the word itself, what they decode to behind another word.  A batch of documents is cut into marked
words, those that the table lacks are segmented by the library, all
together and each once, and documents are put together from the table by
position.  The table is emptied when it holds ``MAX_CHUNKS`` words, which
bounds its memory and changes no result.
(The table is kept per task: one for the corpus would shuffle a row for
each distinct word of each document, and its ids back; README has figures.)

A model whose pieces do cross markers, or whose normaliser does more than
mark spaces, is refused by ``chunkable``; ``encode`` then gives whole
texts to the library.

Defined results: a null text counts as empty and gives the end id alone;
rows that repeat are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
MAX_CHUNKS = 500_000
MAX_CHUNK_CHARS = 64          # longer words are segmented once a batch, without being kept
BEFORE = "a"                  # a word behind this one decodes as it does inside a text
SCHEMA = "doc_id bigint, ids array<int>, decoded string"
DIGEST_SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

_LOADED: dict[str, Codec] = {}


class Codec:
    """A model and its table of distinct marked words."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_chunk = chunkable(self.sp)
        self.ids: dict[str, str] = {}              # marked word to its ids as text
        self.odd: dict[str, str] = {}              # what a word decodes to inside a text, where that is not the word
        self.before = self.sp.encode(BEFORE)
        self.skip = len(self.sp.decode(self.before))

    def look_up(self, chunks: set[str]) -> None:
        """Have the table hold all of ``chunks``."""
        new = [c for c in chunks if c not in self.ids]
        if not new:
            return
        if len(self.ids) + len(new) > MAX_CHUNKS:
            self.forget()
            new = list(chunks)
        # The library marks the start of a text, but leaves an empty one empty.
        bare = [self.sp.piece_to_id(MARK)]
        got = [ids if len(c) > 1 else bare for c, ids in zip(new, self.sp.encode([c[1:] for c in new], num_threads=1))]
        self.ids.update(zip(new, [" ".join(map(str, ids)) for ids in got]))
        for c, t in zip(new, self.sp.decode([self.before + ids for ids in got], num_threads=1)):
            if t[self.skip:] != c.replace(MARK, " "):
                self.odd[c] = t[self.skip:]

    def drop_long(self, chunks: set[str]) -> None:
        for c in chunks:
            if len(c) > MAX_CHUNK_CHARS:
                del self.ids[c]
                self.odd.pop(c, None)

    def forget(self) -> None:
        self.ids.clear()
        self.odd.clear()

    def encoded(self, texts: list[str]) -> list[tuple[str, str]]:
        """(all ids as text, with the end id; the decoded text) of each text."""
        end = str(self.sp.eos_id())
        if not self.by_chunk:
            every = self.sp.encode(texts, num_threads=1)
            return [(" ".join(map(str, [*ids, end])), self.sp.decode(ids)) for ids in every]
        parts = [CHUNK.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        own = set().union(*parts)
        self.look_up(own)
        odd = {c: self.odd[c].replace(" ", MARK) for c in own & self.odd.keys()}
        out = []
        for chunks in parts:
            if chunks:
                said = " ".join(map(self.ids.__getitem__, chunks))
                first = self.sp.decode(list(map(int, self.ids[chunks[0]].split())))       # nothing stands before it
                rest = [odd.get(c, c) for c in chunks[1:]] if odd else chunks[1:]
                out.append((f"{said} {end}", first + "".join(rest).replace(MARK, " ")))
            else:
                out.append((end, ""))
        self.drop_long(own)
        return out


def load(path: str) -> Codec:
    """The codec of a model file, once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Codec(path)
    return _LOADED[path]


def chunkable(sp) -> bool:
    """Whether marked words can be segmented one by one."""
    crossing = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(len(sp)))
    probe = "  a ﬁÅ é\n\tb  "
    plain = sp.normalize(probe) == MARK + probe.replace(" ", MARK)
    return plain and not crossing and sp.piece_to_id(MARK) != sp.unk_id()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           digests: bool = False) -> DataFrame:
    """doc_id, ids and decoded text per document; with ``digests`` the
    number of ids and SHA-256 of both instead."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def run(b: pa.RecordBatch):
        texts = [t or "" for t in b.column(1).to_pylist()]
        got = load(model_path).encoded(texts)
        if digests:
            cols = [pa.array([said.count(" ") + 1 for said, _ in got], pa.int64()),
                    pa.array([hashlib.sha256(said.encode()).hexdigest() for said, _ in got], pa.string()),
                    pa.array([hashlib.sha256(back.encode()).hexdigest() for _, back in got], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        else:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([list(map(int, said.split())) for said, _ in got], pa.list_(pa.int32())),
                 pa.array([back for _, back in got], pa.string())], ["doc_id", "ids", "decoded"])
    return map_batches(rows, run, DIGEST_SCHEMA if digests else SCHEMA)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text of ``ids`` by the library's decode."""
    def run(b: pa.RecordBatch):
        sp = load(model_path).sp
        texts = [None if i is None else sp.decode(i) for i in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])
    return map_batches(encoded.select("doc_id", "ids"), run, "doc_id bigint, text string")
