"""Removal of repeated byte strings by minimiser windows.

This is not prefix doubling: nothing is ranked or sorted by pairs of ranks, as
that would move many times the corpus in each round (an estimate, not measured).
Strings of fixed lengths are counted by hash in three rounds instead.  The first
counts at positions that the content itself chooses: in each window of ``length``
bytes, the start of the half-length string with the smallest hash.  Equal windows
choose at equal offsets, so nothing is missed.

* Round 1, ``length / 2`` bytes: chosen positions whose string is unique drop out
  with all windows that chose them.
* Round 2, all windows that chose a position, as one string: if that occurs twice
  at the same offset, all of these windows are repeated.
* Round 3, ``length`` bytes: what is still undecided lies next to the ends of
  repeated passages; there each window is counted by itself.

Documents lie in tiles of bounded size.  In each round a tile sends each distinct
key once, with its count, to the bucket that owns it, and gets totals back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from carestar.session import ship_package

from .bytewords import _BASE, _INVERSE, _VALUE, _power, buffers, mixed
from .common import text_of

_U = np.uint64
TILE_BYTES = 8 << 20
_PIECE = 1 << 19                       # positions handled at once
_INDEX_BITS = _U((1 << 20) - 1)        # room for a position inside a piece
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_CHECK = _VALUE[::-1].copy()           # an independent value per byte, for the check bits


class _Bytes:
    """A tile's documents as one buffer, in an order that does not depend on how rows arrived."""

    def __init__(self, docs: pa.Table):
        texts = docs.column("text").to_pylist()
        ids = docs.column("doc_id").to_pylist()
        mark = [xxhash.xxh3_128_digest(t.encode()) for t in texts]
        order = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] if ids[i] is not None else 0, mark[i]))
        self.ids = [ids[i] for i in order]
        self.raw, self.at = buffers(pa.array([texts[i] for i in order], pa.large_string()))

    def windows(self, length: int) -> np.ndarray:
        """Whether a window of ``length`` bytes that starts here ends in the same document."""
        left = np.repeat(self.at[1:], np.diff(self.at)) - np.arange(len(self.raw))
        return left >= length


def _sums(raw: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(values[raw] * _power(_BASE, len(raw))[:len(raw)], out=out[1:])
    return out


def _hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start])


def _chosen(tile: _Bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows that chose one position: first and last window, and round 1 and 2 keys with check bits."""
    half = length // 2
    span = length - half + 1              # strings of half the length in a window
    inside = tile.windows(length)
    out = []
    for at in range(0, len(tile.raw), _PIECE):
        ok = inside[at:at + _PIECE]
        if not ok.any():
            continue
        piece = tile.raw[at:at + len(ok) + length]
        sums, check = _sums(piece, _BYTE), _sums(piece, _CHECK)
        n = len(piece) - half + 1
        key = mixed((sums[half:half + n] - sums[:n]) * _power(_INVERSE, len(sums))[:n])
        # the smallest hash, leftmost among equals: the position rides in the low bits
        ranked = np.full(-(-(n + span) // span) * span, ~_U(0))
        ranked[:n] = (key & ~_INDEX_BITS) | np.arange(n, dtype=np.uint64)
        block = ranked.reshape(-1, span)
        upto = np.minimum.accumulate(block, axis=1).ravel()
        onward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
        w = min(len(ok), n)
        least = (np.minimum(onward[:w], upto[span - 1:span - 1 + w]) & _INDEX_BITS).astype(np.int64)
        ok = ok[:w]
        new = ok.copy()
        new[1:] &= ~ok[:-1] | (least[1:] != least[:-1])
        first = np.flatnonzero(new)
        last_of_run = ok.copy()
        last_of_run[:-1] &= ~ok[1:] | (least[1:] != least[:-1])
        last = np.flatnonzero(last_of_run)
        x = least[first]
        end = last + length
        shape = mixed(((x - first).astype(np.uint64) << _U(32)) + (last - first).astype(np.uint64))
        one, one_check = key[x], _hash(check, x, x + half)
        two = mixed(_hash(sums, first, end) + shape + one)
        two_check = mixed(_hash(check, first, end) + shape)
        out.append((first + at, last + at, one, one_check, two, two_check))
    if not out:
        empty = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), np.zeros(0, np.int64), empty, empty, empty, empty
    return tuple(np.concatenate(c) for c in zip(*out))


def _window_keys(tile: _Bytes, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Round 3: position, key and check bits of every window of the runs."""
    size = last - first + 1
    at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
    key, check = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
    i = 0
    while i < len(at):                    # runs are in order, so stretches of the buffer are too
        j = int(np.searchsorted(at, at[i] + _PIECE))
        piece = tile.raw[at[i]:at[j - 1] + length]
        a = at[i:j] - at[i]
        key[i:j] = _hash(_sums(piece, _BYTE), a, a + length)
        check[i:j] = _hash(_sums(piece, _CHECK), a, a + length)
        i = j
    return at, key, check


class _Ranks:
    """Distinct (key, check) pairs of a tile in order, with how often each occurs."""

    def __init__(self, key: np.ndarray, check: np.ndarray, extra: np.ndarray | None = None):
        check = (check & _U(0xFFFFFFFF)).astype(np.uint32)
        order = np.lexsort((check, key))
        k, c = key[order], check[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
        self.first = order[new]
        self.key, self.check = k[new], c[new]
        self.place = np.empty(len(k), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.count = np.bincount(self.place, minlength=len(self.key)).astype(np.uint32)
        self.extra = np.zeros(len(self.key), np.uint64)
        if extra is not None and len(k):
            # one value for all occurrences, or 0
            low = np.minimum.reduceat(extra[order], np.flatnonzero(new))
            high = np.maximum.reduceat(extra[order], np.flatnonzero(new))
            self.extra = np.where(low == high, high | _U(1), _U(0))

    def packets(self, buckets: int, tile: int, kind: int) -> list[tuple]:
        owner = (((self.key >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
        cuts = np.searchsorted(owner, np.arange(buckets + 1))
        return [(b, tile, kind, self.key[i:j].tobytes(), self.check[i:j].tobytes(), self.count[i:j].tobytes(),
                 self.extra[i:j].tobytes() if kind == 1 else None, None)
                for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if j > i]


_PACKET = "bucket bigint, tile bigint, kind int, keys binary, checks binary, counts binary, extras binary, own binary"
_PACKET_TYPES = [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 5]
_ANSWER = "tile bigint, kind int, bucket bigint, flags binary, own binary"
# Flags of a rank key: it occurs twice or more; all occurrences look alike in round 2; this tile is its first
_TWICE, _ALIKE, _FIRST = 1, 2, 4


def _packet_table(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * len(_PACKET_TYPES)
    return pa.table([pa.array(c, t) for c, t in zip(cols, _PACKET_TYPES)],
                    names=[c.split()[0] for c in _PACKET.split(", ")])


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one bucket, as flags for each key of each tile; a tile's own rows pass through."""
    bucket = table.column("bucket")[0].as_py()
    rows = table.to_pylist()
    out = [(r["tile"], r["kind"], bucket, None, r["own"]) for r in rows if r["own"] is not None]
    for kind in {r["kind"] for r in rows if r["keys"] is not None}:
        mine = [r for r in rows if r["kind"] == kind and r["keys"] is not None]
        key, check, count = (np.concatenate([np.frombuffer(r[c], t) for r in mine])
                             for c, t in (("keys", np.uint64), ("checks", np.uint32), ("counts", np.uint32)))
        extra = (np.concatenate([np.frombuffer(r["extras"], np.uint64) for r in mine]) if kind == 1
                 else np.zeros(len(key), np.uint64))
        sizes = [len(r["keys"]) // 8 for r in mine]
        tile = np.repeat([r["tile"] for r in mine], sizes)
        order = np.lexsort((tile, check, key))
        k, c = key[order], check[order]
        new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
        at, run = np.flatnonzero(new), np.cumsum(new) - 1
        total = np.add.reduceat(count[order].astype(np.int64), at)
        low, high = np.minimum.reduceat(extra[order], at), np.maximum.reduceat(extra[order], at)
        group = np.where(total >= 2, _TWICE, 0) | np.where((low == high) & (low > 0), _ALIKE, 0)
        flags = np.empty(len(key), np.uint8)
        flags[order] = group[run] | np.where(new, _FIRST, 0)
        ends = np.cumsum(sizes)
        out += [(r["tile"], kind, bucket, flags[e - s:e].tobytes(), None) for r, s, e in zip(mine, sizes, ends)]
    cols = list(zip(*out))
    return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()])],
                    names=["tile", "kind", "bucket", "flags", "own"])


def _flags(answers: pa.Table, kind: int) -> np.ndarray:
    got = sorted((r["bucket"], r["flags"]) for r in answers.to_pylist() if r["kind"] == kind and r["flags"] is not None)
    return np.concatenate([np.frombuffer(f, np.uint8) for _, f in got]) if got else np.zeros(0, np.uint8)


def _rounds_1_and_2(length: int, buckets: int):
    def send(docs: pa.Table) -> pa.Table:
        tile = docs.column("tile")[0].as_py()
        _, _, one, one_check, two, two_check = _chosen(_Bytes(docs), length)
        return _packet_table(_Ranks(one, one_check, two).packets(buckets, tile, 1)
                             + _Ranks(two, two_check).packets(buckets, tile, 2))
    return send


def _round_3(length: int, buckets: int):
    def send(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _packet_table([])
        number = docs.column("tile")[0].as_py()
        tile = _Bytes(docs)
        first, last, one, one_check, two, two_check = _chosen(tile, length)
        ranks = _Ranks(two, two_check)
        f1 = _flags(answers, 1)[_Ranks(one, one_check).place] if len(one) else np.zeros(0, np.uint8)
        f2 = _flags(answers, 2)[ranks.place] if len(one) else np.zeros(0, np.uint8)
        again, alike = f1 & _TWICE > 0, f1 & _ALIKE > 0
        repeated = f2 & _TWICE > 0
        open_ = again & ~alike & ~repeated
        # what an undecided window may equal: one of each repeated string of round 2
        stands = again & ~alike & repeated & (f2 & _FIRST > 0)
        one_each = np.zeros(len(two), bool)
        one_each[ranks.first] = True
        stands &= one_each
        asked = open_ | stands
        own = [np.stack([first[sel], last[sel]]).astype(np.int64) for sel in (again & repeated, open_, asked)]
        head = np.array([o.shape[1] for o in own], np.int64)
        payload = b"".join([head.tobytes(), *(o.tobytes() for o in own)])
        _, key, check = _window_keys(tile, first[asked], last[asked], length)
        return _packet_table([(number % buckets, number, 0, None, None, None, None, payload)]
                             + _Ranks(key, check).packets(buckets, number, 3))
    return send


def _remove(length: int, id_type: pa.DataType):
    def remove(docs: pa.Table, answers: pa.Table) -> pa.Table:
        tile = _Bytes(docs)
        cover = np.zeros(len(tile.raw) + 1, np.int32)
        for own in (x for x in answers.column("own").to_pylist() if x is not None):
            head = np.frombuffer(own, np.int64, 3)
            runs, at = [], 24
            for n in head.tolist():
                runs.append(np.frombuffer(own, np.int64, 2 * n, at).reshape(2, n))
                at += 16 * n
            np.add.at(cover, runs[0][0], 1)
            np.add.at(cover, runs[0][1] + length, -1)
            if head[2]:
                at, key, check = _window_keys(tile, *runs[2], length)
                twice = _flags(answers, 3)[_Ranks(key, check).place] & _TWICE > 0
                undecided = np.zeros(len(tile.raw) + 1, np.int32)
                np.add.at(undecided, runs[1][0], 1)
                np.add.at(undecided, runs[1][1] + 1, -1)
                twice &= np.cumsum(undecided)[at] > 0
                np.add.at(cover, at[twice], 1)
                np.add.at(cover, at[twice] + length, -1)
        gone = np.cumsum(cover[:-1]) > 0
        rows = []
        for i, a, b in zip(tile.ids, tile.at[:-1].tolist(), tile.at[1:].tolist()):
            g = gone[a:b]
            spans = int(g[:1].sum()) + int((g[1:] & ~g[:-1]).sum())
            rows.append((i, b - a, int(g.sum()), spans, hashlib.sha256(tile.raw[a:b][~g].tobytes()).hexdigest()))
        cols = list(zip(*rows)) or [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(cols, [id_type, pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return remove


def remove_repeats(docs: DataFrame, *, length: int = 400, id_col: str = "doc_id", text_col: str = "text",
                   tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256``, one row per input row.

    Removes each UTF-8 byte covered by a string of ``length`` bytes that also
    starts anywhere else, in the same document or another; strings overlap
    freely, never cross documents, and are judged on the input.  Strings are told
    apart by 96 hash bits.

    Defined cases: a null text is empty; a text shorter than ``length`` stays
    whole; rows that repeat count as repeats of each other; null ids are ids like
    others, and ids may be of any atomic type; an empty table gives an empty
    result; other input columns are ignored.  A task holds a tile, at least one
    whole document.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    tiles = max(4, -(-size // tile_bytes))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(tiles)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)

    by_tile = rows.groupBy("tile")
    told = by_tile.applyInArrow(_rounds_1_and_2(length, tiles), _PACKET).groupBy("bucket").applyInArrow(
        lambda t: _answer(t), _ANSWER)
    asked = by_tile.cogroup(told.groupBy("tile")).applyInArrow(_round_3(length, tiles), _PACKET)
    told = asked.groupBy("bucket").applyInArrow(lambda t: _answer(t), _ANSWER)
    return by_tile.cogroup(told.groupBy("tile")).applyInArrow(
        _remove(length, id_type), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
