"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last characters cuts each text into chunks, so texts
that share a passage share its chunks whatever stands before it.  The part of
a chunk between its first and last certain token start (a blank between two
non-blanks) is encoded once and remembered.  What is left at a chunk's ends
depends on its neighbours: at each join the end of one chunk and the start of
the next are encoded again, and the stretch grows over further chunks until
both its ends are certain token starts, where the ids on either side are
bound to agree with those of the whole text.

Chunks are remembered per Python worker, up to a stated number; a forgotten
chunk is encoded again, results do not depend on it.

Defined results: a null text is an empty text, with no ids; repeated rows are
each encoded; very long texts take memory in proportion to one text; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from footfall.llm.bpe import DEFAULT_VOCABULARY, PieceEncoder, encoder_for
from footfall.llm.common import id_text, table

WINDOW = 16                  # characters under the rolling hash, a power of two
MEAN_CHUNK = 512             # expected characters of a chunk, a power of two
MAX_CHUNKS = 20_000          # distinct chunks remembered by one worker

_SAFE = re.compile(r"(?<=\S) (?=\S)")


def chunk_cuts(text: str, mean: int = MEAN_CHUNK) -> np.ndarray:
    """Places where a chunk starts, from the hash of the WINDOW characters
    before; the hash of a window doubles from halves, so a few vector steps
    cover the text."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    if len(h) <= WINDOW:
        return np.empty(0, np.int64)
    width, factor = 1, np.uint32(0x9E3779B1)
    with np.errstate(over="ignore"):
        while width < WINDOW:
            h = h[width:] + h[:-width] * factor
            factor, width = factor * factor, 2 * width
        h *= np.uint32(0x85EBCA6B)
    shift = np.uint32(32 - mean.bit_length() + 1)
    return np.flatnonzero((h >> shift) == 0) + WINDOW


class ChunkEncoder:
    """``encode`` equals the tokenizer's ids of the whole text."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY, mean_chunk: int = MEAN_CHUNK):
        self.pieces: PieceEncoder = encoder_for(vocabulary)
        self.mean = mean_chunk
        self.chunks: dict[str, tuple[str, bytes, str] | None] = {}
        self.reused = 0

    def _chunk(self, chunk: str) -> tuple[str, bytes, str] | None:
        """(start, ids of the middle, end); None without a certain start."""
        if chunk in self.chunks:
            self.reused += 1
            return self.chunks[chunk]
        if len(self.chunks) >= MAX_CHUNKS:
            self.chunks.clear()
        first = _SAFE.search(chunk)
        parts = None
        if first:
            a, b = first.start(), chunk.rfind(" ")
            while not _SAFE.match(chunk, b):
                b = chunk.rfind(" ", 0, b)
            parts = chunk[:a], self.pieces.encode_bytes(chunk[a:b]), chunk[b:]
        self.chunks[chunk] = parts
        return parts

    def encode_bytes(self, text: str) -> bytes:
        if not self.pieces.by_piece:
            return self.pieces.encode_bytes(text)
        out, open_end, at = [], "", 0
        for cut in [*chunk_cuts(text, self.mean).tolist(), len(text)]:
            parts = self._chunk(text[at:cut])
            if parts is None:
                open_end += text[at:cut]            # the stretch grows
            else:
                start, middle, end = parts
                out += [self.pieces.encode_bytes(open_end + start), middle]
                open_end = end
            at = cut
        return b"".join([*out, self.pieces.encode_bytes(open_end)])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")


def round_trip(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (array) and the text
    decoded from them."""
    src = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(vocabulary)
        for batch in batches:
            ids = [encoder.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, ids)), pa.int64()),
                 pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())),
                 pa.array([encoder.pieces.decode(x) for x in ids], pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str = DEFAULT_VOCABULARY, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Like ``round_trip`` with hashes in place of ids and text, taken in the
    same task so that neither travels."""
    src = id_text(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(vocabulary)
        decimal = [str(i).encode() for i in range(len(encoder.pieces.token_bytes()))]
        with encoder.pieces:
            for batch in batches:
                n, ids_hash, text_hash = [], [], []
                for text in batch.column(1):
                    ids = encoder.encode(text.as_py())
                    n.append(len(ids))
                    ids_hash.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids.tolist()))).hexdigest())
                    text_hash.append(hashlib.sha256(encoder.pieces.decode(ids).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()),
                     pa.array(text_hash, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
