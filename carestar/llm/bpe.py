"""Byte-level BPE encoding and decoding over Arrow batches.

Texts are cut by the split pattern; each piece is encoded on its own by the
``tokenizers`` library, once per worker and piece (pieces repeat a lot).  Every
token is a run of bytes, so offsets follow from the byte table: byte offsets by
summing token lengths, character offsets through the text's byte-to-character
map.  Decoding looks the bytes up again; characters split over several tokens
come back whole once the bytes are joined.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestar.session import ship_package

# Pieces remembered by a worker, and the longest one remembered (characters)
MEMO_PIECES, MEMO_CHARS = 400_000, 64


def default_tokenizer() -> str:
    from public_tokenizers import path
    return path("byte_bpe_50k.json")


def default_pattern() -> str:
    from public_tokenizers import PATTERN
    return PATTERN


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Encoded:
    """The tokens of one text."""

    ids: np.ndarray          # uint32
    byte_start: np.ndarray   # int64, with the end of the last token appended
    char_start: np.ndarray   # int64: character that holds the token's first byte
    char_end: np.ndarray     # int64: one past the character that holds its last byte


class ByteBpe:
    """A byte-level BPE tokenizer file with a memo of encoded pieces."""

    def __init__(self, tokenizer_file: str, pattern: str):
        import regex
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        self.pieces = regex.compile(pattern).findall
        chars = _byte_chars()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in chars for c in token):
                self.bytes_of[i] = bytes(chars[c] for c in token)
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.memo: dict[str, bytes] = {}

    def _learn(self, pieces: list[str], into: dict[str, bytes]) -> None:
        for p, e in zip(pieces, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)):
            into[p] = np.array(e.ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The text's token ids as little-endian unsigned 32-bit integers."""
        pieces = self.pieces(text)
        memo = self.memo
        try:
            return b"".join([memo[p] for p in pieces])
        except KeyError:
            unknown = [p for p in dict.fromkeys(pieces) if p not in memo]
        if len(memo) > MEMO_PIECES:
            memo.clear()
            unknown = list(dict.fromkeys(pieces))
        own: dict[str, bytes] = {}
        self._learn(unknown, own)
        memo.update((p, i) for p, i in own.items() if len(p) <= MEMO_CHARS)
        return b"".join([own[p] if p in own else memo[p] for p in pieces])

    def encode(self, text: str) -> Encoded:
        ids = np.frombuffer(self.ids(text), "<u4")
        ends = np.cumsum(self.length_of[ids])
        start = np.concatenate([[0], ends]).astype(np.int64)
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
        return Encoded(ids, start, char_of[start[:-1]], char_of[start[1:] - 1] + 1)

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def byte_bpe(tokenizer_file: str, pattern: str) -> ByteBpe:
    """One tokenizer per worker process."""
    return ByteBpe(tokenizer_file, pattern)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _slices(batch: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``most`` bytes of text; a row is never cut."""
    sizes = np.cumsum(np.asarray(pc.binary_length(batch.column("text").cast(pa.large_string()))))
    at = 0
    while at < batch.num_rows:
        done = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def bpe_encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               tokenizer_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids, byte_start, char_start, char_end``: arrays with one entry per token.

    ``char_start`` / ``char_end`` span the characters a token touches; tokens that
    hold part of a character overlap in it.  Special tokens are ordinary text.

    Defined cases: a null text counts as empty and has no token; a text of any
    length is encoded whole; repeated rows are encoded each; an empty table
    gives an empty result; other input columns are ignored.
    """
    ship_package(docs.sparkSession)
    file, pat = tokenizer_file or default_tokenizer(), pattern or default_pattern()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(file, pat)
        for batch in batches:
            for part in _slices(batch):
                enc = [bpe.encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([e.ids.astype(np.int32) for e in enc], pa.list_(pa.int32())),
                     *[pa.array([getattr(e, k) for e in enc], pa.list_(pa.int64()))
                       for k in ("byte_start", "char_start", "char_end")]],
                    names=["doc_id", "ids", "byte_start", "char_start", "char_end"])

    rows = _texts(docs, id_col, text_col)
    return rows.mapInArrow(encode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>, "
                                   "byte_start array<bigint>, char_start array<bigint>, char_end array<bigint>")


def bpe_decode(tokens: DataFrame, *, tokenizer_file: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, text_bytes`` from ``doc_id, ids``; ids that end inside a character give its bytes so far.

    A null list counts as empty.
    """
    ship_package(tokens.sparkSession)
    file, pat = tokenizer_file or default_tokenizer(), pattern or default_pattern()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(file, pat)
        for batch in batches:
            out = [bpe.decode(np.array(i or [], np.int64)) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())],
                                             names=["doc_id", "text_bytes"])

    rows = tokens.select("doc_id", "ids")
    return rows.mapInArrow(decode, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_bytes binary")


def bpe_digests(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                tokenizer_file: str | None = None, pattern: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode and decode in one pass: ``doc_id, n_tokens, ids_sha256, decoded_sha256, n_split_chars``.

    The same as ``bpe_encode`` followed by ``bpe_decode`` and digests, without
    moving the token arrays out of the worker.  ``n_split_chars``: tokens that
    start inside a character.  ``with_ids`` adds ``ids``.  Defined cases as for ``bpe_encode``.
    """
    ship_package(docs.sparkSession)
    file, pat = tokenizer_file or default_tokenizer(), pattern or default_pattern()
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_split_chars"] + ["ids"] * with_ids

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(file, pat)
        for batch in batches:
            for part in _slices(batch):
                n, ids_hex, text_hex, split, flat = [], [], [], [], []
                for text in part.column("text").to_pylist():
                    ids = bpe.ids(text)
                    tokens = np.frombuffer(ids, "<u4")
                    back = bpe.decode(tokens)
                    starts = np.cumsum(bpe.length_of[tokens])[:-1]
                    raw = np.frombuffer(back, np.uint8)
                    n.append(len(tokens))
                    ids_hex.append(hashlib.sha256(ids).hexdigest())
                    text_hex.append(hashlib.sha256(back).hexdigest())
                    split.append(int(((raw[starts] & 0xC0) == 0x80).sum()))
                    if with_ids:
                        flat.append(tokens)
                columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hex), pa.array(text_hex),
                           pa.array(split, pa.int64())]
                if with_ids:
                    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(flat).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = _texts(docs, id_col, text_col)
    return rows.mapInArrow(digest, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
                                   "ids_sha256 string, decoded_sha256 string, n_split_chars bigint"
                           + ", ids array<int>" * with_ids)
