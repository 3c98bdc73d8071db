"""SentencePiece encoding and decoding through a distinct-chunk table.

The vocabulary has no piece with a whitespace marker behind another character, so no merge
crosses the place before a marker: each marked word (markers and the characters up to the
next marker) is segmented alone.  A task keeps a table of the marked words it has met; each
distinct one is segmented once by the library, and a text's ids are joined back by position.
The table is emptied when it holds ``TABLE_CHARS`` characters, which bounds memory and
changes no result.

The library normalises and marks whole texts; the same normal form is built here (this
kind of model: identity normalisation, spaces become markers, one marker put in front), and
models with other rules or with pieces across markers are encoded text by text instead.
Decoding drops the marker in front of a text, so a text's decoded form is its marked words',
each decoded once by the library, joined by one space.

Defined results: a null text is encoded as the empty one (no ids); repeated rows give
repeated results; an empty table gives an empty one; extra columns are ignored by the query.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import arrow_map, column_of, docs_table, slices, texts

MODEL = "piece_bpe_32k.model"
TABLE_CHARS = 3_000_000
MARK = "▁"
_MARKED = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def model_file(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Encodes and decodes as the library does; one per task."""

    def __init__(self, path: str, table_chars: int = TABLE_CHARS):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.room = table_chars
        # marked word without its first marker -> (ids as int32 bytes, decimal ids, decoded)
        self.table: dict[str, tuple[bytes, bytes, str]] = {}
        self.held = 0
        self.alone = self._words_stand_alone()

    def _words_stand_alone(self) -> bool:
        """No piece crosses a marker, and texts are only marked, not changed otherwise."""
        sp = self.sp
        crossing = any(MARK in sp.id_to_piece(i).lstrip(MARK) for i in range(sp.get_piece_size()))
        probe = "  AÀ ﬁ \t\n x  y　Ａé "
        same = sp.decode(sp.encode(probe)) == probe and sp.encode(probe, out_type=str)[0].startswith(MARK)
        return same and not crossing

    def _entry(self, ids: list[int]) -> tuple[bytes, bytes, str]:
        return np.array(ids, dtype=np.int32).tobytes(), ",".join(map(str, ids)).encode(), self.sp.decode(ids)

    def _segment(self, chunks: list[str]) -> None:
        """Put chunks that are not in the table yet into it, each segmented once."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.table]
        # the library marks a text's start itself
        self.table.update(zip(new, map(self._entry, self.sp.encode(new, num_threads=1))))
        if "" in self.table:  # but no empty text's
            self.table[""] = self._entry([self.sp.piece_to_id(MARK)])
        self.held += sum(map(len, new))

    def parts(self, text: str | None) -> list[tuple[bytes, bytes, str]]:
        """The table's entries of a text's marked words, in order."""
        if not text:
            return []
        if not self.alone:
            return [self._entry(self.sp.encode(text))]
        if "  " in text or MARK in text or text[0] == " ":
            chunks = [c[1:] for c in _MARKED.findall(MARK + text.replace(" ", MARK))]
        else:
            chunks = text.split(" ")
        table = self.table
        try:
            return [table[c] for c in chunks]
        except KeyError:
            if self.held > self.room:
                table.clear()
                self.held = 0
            self._segment(chunks)
            return [table[c] for c in chunks]

    def encode(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join([p[0] for p in self.parts(text)]), dtype=np.int32)

    @staticmethod
    def joined(parts: list[tuple[bytes, bytes, str]]) -> str:
        """Decoded text: decoding drops the marker in front of each marked word."""
        return " ".join([p[2] for p in parts])


def _map_texts(docs: DataFrame, path: str | None, schema: str, build) -> DataFrame:
    """build(batch, parts of each text) -> columns, over doc_id and text."""
    path = path or model_file()
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        enc = Encoder(path)
        for batch in slices(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays(build(batch, [enc.parts(t) for t in texts(batch)]), names)
    pairs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(pairs, run, schema)


def tokenize(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids (array<int>) and the decoded text for every row."""
    def build(batch, parts):
        raw = [b"".join([x[0] for x in p]) for p in parts]
        n = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(np.frombuffer(b"".join(raw), dtype=np.int32)))
        return [column_of(batch, "doc_id"), pa.array(n), ids, pa.array([Encoder.joined(p) for p in parts], pa.string())]
    return _map_texts(docs, path, "doc_id long, n_tokens long, ids array<int>, decoded string", build)


def token_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row."""
    def build(batch, parts):
        sha = hashlib.sha256
        return [column_of(batch, "doc_id"), pa.array([sum([len(x[0]) for x in p]) // 4 for p in parts], pa.int64()),
                pa.array([sha(b",".join([x[1] for x in p])).hexdigest() for p in parts], pa.string()),
                pa.array([sha(Encoder.joined(p).encode("utf-8", "surrogatepass")).hexdigest() for p in parts], pa.string())]
    return _map_texts(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", build)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(docs_table(spark, sf_dir))


SQL: dict[str, str] = {}
QUERIES = {"op10_sentencepiece": op10_sentencepiece}
