"""N-gram Jaccard join by parity sketches.

A document's shingle set becomes a bit sketch: each shingle flips one bit.  The
Hamming distance of two sketches is at most the symmetric difference of the
sets, and a Jaccard similarity bounds that difference for sets of about the same
size.  For each band of sizes the sketch has more blocks than differences are
allowed, so two linked documents agree in at least one whole block (or, in
groups of ``GROUP`` blocks, in two blocks of one group): documents that share
such a key are candidates, and candidates are verified on their whole sets.

The blocks that make keys are 2^64 bits wide and nearly empty; each is held as
the XOR of the codes of its set bits, in which a bit flipped twice cancels too.
So wide blocks agree only where the shingles in them do, however many documents
there are.  The sketches compared by distance have blocks of one word.

Documents with equal sets are one node.  Everyone is compared with the centre of
its keys.  Nodes of one key that no link joins yet are then compared by their
sketches, pair by pair, where the key has few of them.  Candidates of a key that
many share are not paired all with all: two nodes around one centre can only be
linked if they share differences from it, and are found through their rarest ones.

A table of texts is not shuffled for the sake of a few: rows that a bitmap of the
wanted ids rules out stay where they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestar.session import ship_package

from .bpe import _slices
from .bytewords import mixed, shingle_sets
from .common import discard, quoted, text_of, written
from .graph import components
from .packing import pack, unpack

_U = np.uint64
GROUP = 4
# Empty blocks make keys where those of blocks with shingles alone would miss a link at
# the threshold with more than this probability (over the shingle hash); elsewhere
# further keys stand for the empty blocks (``Bands.keys``), and no link is missed
MISS = 1e-8
# Index entries a task gathers before it hands them on, and members of one key it packs
FLUSH, PACKED = 1_500_000, 4
# Bytes of text to a bucket of keys, at most
BUCKET_BYTES = 16 << 20
# Words of the smallest sketch, and of those compared inside a join
SMALL = 4
# Nodes beside the centre of a key up to which they are compared pair by pair
PAIRED = 8
# Bits of a bitmap of ids for each of them, and of the largest bitmap
BITS, MOST_BITS = 16, 1 << 26
# Rounds in which nodes are compared around their centres, at most
ROUNDS = 16


class Bands:
    """Size bands for one threshold num / den; band k pairs with itself and with k + 1."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            e = self.edges[-1]
            self.edges.append(max(e + 1, -(-e * den // num)))
        self.edges_array = np.array(self.edges, np.int64)

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.edges_array, size, "right")) - 1

    @lru_cache(maxsize=None)
    def plan(self, band: int) -> tuple[int, int, int]:
        """(most differences, blocks in a group, whether only blocks with shingles make keys) for pairs whose smaller set is in ``band``."""
        num, den = self.num, self.den
        a = self.edges[band + 1] - 1
        b = a * den // num
        most = (den - num) * (a + b) // (den + num)
        if most == 0:
            return 0, 1, 0
        low = self.edges[band]
        shared = max(1, low - most)     # shingles both have, at least about
        if low / (most + 1) >= 7:
            return most, 1, 0

        def dense(mean: float, m: int) -> float:
            return 1 - sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(m))

        blocks = most + 1
        if (1 - math.exp(-most / blocks) * dense(shared / blocks, 1)) ** blocks <= MISS:
            return most, 1, 1
        return most, GROUP, 0

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Index keys of a sorted set of shingle hashes.

        Where empty blocks make no keys, linked sets x and y may agree in empty blocks
        alone.  Let e > 0 blocks be empty in both.  The others all differ, in at most
        e - 1 shingles more than one each.  So at most e - 1 blocks differ in several
        shingles, and only these and blocks of one shingle can be empty in the other
        set.  Hence among the first e + (blocks of one shingle) non-empty blocks of
        each set is one, the same for both, where one set has a single shingle that the
        other lacks: the codes of these blocks less each shingle are keys too.  With
        fewer non-empty blocks than that (then in both sets), every shingle is a key.
        """
        if not len(shingles):
            return shingles
        own, out = self.of(len(shingles)), []
        for band in (own - 1, own):
            most, group, dense = self.plan(band) if band >= 0 else (0, 1, 0)
            if most == 0:
                continue
            groups = most + 1 if group == 1 else -(-(most + 1) // (group - 1))
            sketch, held = wide_blocks(shingles, groups * group)
            salt = _U(band + 1) << _U(40)
            at = np.arange(groups, dtype=np.uint64)
            if group == 1:
                sel = held >= dense
                out.append(mixed(mixed(sketch[sel]) + salt + at[sel]))
                empty, first = int((held == 0).sum()), int((held == 0).sum() + (held == 1).sum())
                if dense and empty:
                    rank = np.cumsum(held > 0)
                    block = _block(shingles, groups)
                    sel = (rank[block] <= first) & (held[block] > 1)
                    less = sketch[block[sel]] ^ mixed(shingles[sel] + _U(29))
                    out.append(mixed(mixed(less) + salt + at[block[sel]]))
                    if rank[-1] < first:
                        out.append(mixed(mixed(shingles + _U(31)) + salt + _U(1 << 39)))
            else:
                sketch = sketch.reshape(groups, group)
                for k, (i, j) in enumerate(combinations(range(group), 2)):
                    pair = mixed(sketch[:, i]) * _U(3) + mixed(sketch[:, j] + _U(1))
                    out.append(mixed(pair + salt + (_U(k + 1) << _U(32)) + at))
        return np.concatenate(out) if out else shingles[:0]


def parity_sketch(shingles: np.ndarray, blocks: int) -> np.ndarray:
    """``blocks`` words of 64 bits; each shingle flips one bit. ``shingles`` is sorted."""
    block = ((shingles >> _U(32)) * _U(blocks)) >> _U(32)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    sketch = np.zeros(blocks, np.uint64)
    sketch[block[first].astype(np.int64)] = np.bitwise_xor.reduceat(_U(1) << (shingles & _U(63)), first)
    return sketch


def _block(shingles: np.ndarray, blocks: int) -> np.ndarray:
    return (((shingles >> _U(32)) * _U(blocks)) >> _U(32)).astype(np.int64)


def wide_blocks(shingles: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``blocks`` wide blocks, and the shingles in each. ``shingles`` is sorted."""
    block = _block(shingles, blocks)
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    code = np.zeros(blocks, np.uint64)
    code[block[first]] = np.bitwise_xor.reduceat(mixed(shingles + _U(29)), first)
    return code, np.bincount(block, minlength=blocks)


def fingerprint(shingles: np.ndarray) -> int:
    """64-bit identity of a set, as a signed number."""
    if not len(shingles):
        return 0
    total = np.add.reduce(shingles, keepdims=True) * _U(5) + _U(len(shingles))
    x = mixed(np.bitwise_xor.reduce(mixed(shingles + _U(11)), keepdims=True) + total)
    return int(x.astype(np.int64)[0])


_bands: dict[tuple[int, int], Bands] = {}


def bands(num: int, den: int) -> Bands:
    if (num, den) not in _bands:
        _bands[num, den] = Bands(num, den)
    return _bands[num, den]


def _join(*parts: bytes) -> bytes:
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _split(blob: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(blob):
        n = int.from_bytes(blob[at:at + 4], "little")
        out.append(blob[at + 4:at + 4 + n])
        at += 4 + n
    return out


def _pack(keys: list[np.ndarray], nodes: list[int], buckets: int) -> Iterator[tuple]:
    """(kind, bucket, key, node, blob) rows: kind 0 packs a bucket's entries, kind 1 is a member of a key many share."""
    key = np.concatenate(keys)
    node = np.repeat(np.array(nodes, np.int64), [len(k) for k in keys])
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    # 32 + log2(buckets) bits of a key tell entries apart; more agreement only means more to verify
    bucket = (((key >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
    low = (key & _U(0xFFFFFFFF)).astype(np.uint32)
    first = np.concatenate([[True], key[1:] != key[:-1]])
    run = np.cumsum(first) - 1
    begins = np.flatnonzero(first)
    rank = np.arange(len(key)) - begins[run]
    many = np.bincount(run)[run] > PACKED
    for i in np.flatnonzero(many).tolist():
        yield 1, int(bucket[i]), int(bucket[i]) << 32 | int(low[i]), int(node[i]), None
    kept = rank < PACKED
    bucket, low, node = bucket[kept], low[kept], node[kept]
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in range(buckets):
        i, j = int(cuts[b]), int(cuts[b + 1])
        if j > i:
            own, at = np.unique(node[i:j], return_inverse=True)
            yield 0, b, 0, 0, _join(pack(low[i:j], ordered=True), own.tobytes(), pack(at.astype(np.uint32)))


def full_sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity sketch with more than a bit per shingle; its number of words is a power of two, at least SMALL."""
    return parity_sketch(shingles, max(SMALL, 1 << max(0, (len(shingles) // 32 - 1).bit_length()))).astype(np.int64)


_INDEX = "kind int, doc_id {kind}, n bigint, bucket bigint, key bigint, node bigint, blob binary, sketch array<bigint>"


def _index(rows: DataFrame, words: int, num: int, den: int, buckets: int) -> DataFrame:
    """Kind 2: one row per document, its mark as key; kinds 0 and 1: index entries."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        band = bands(num, den)
        keys, nodes, held = [], [], 0
        id_type = None

        def flush() -> Iterator[pa.RecordBatch]:
            found = list(_pack(keys, nodes, buckets)) if keys else []
            for at in range(0, len(found), 20_000):
                kind, bucket, key, node, blob = zip(*found[at:at + 20_000])
                yield out(kind, None, None, bucket, key, node, blob)

        def out(kind, doc, n, bucket, key, node, blob, sketch=None) -> pa.RecordBatch:
            size = len(kind)
            none = [None] * size
            return pa.RecordBatch.from_arrays([
                pa.array(kind, pa.int32()), doc if doc is not None else pa.nulls(size, id_type),
                pa.array(n or none, pa.int64()), pa.array(bucket or none, pa.int64()),
                pa.array(none if key is None else key, pa.int64()), pa.array(node, pa.int64()), pa.array(blob or none, pa.binary()),
                pa.array(sketch or none, pa.list_(pa.int64()))],
                names=["kind", "doc_id", "n", "bucket", "key", "node", "blob", "sketch"])

        for batch in batches:
            id_type = batch.column("doc_id").type
            for part in _slices(batch):
                sets = shingle_sets(part.column("text"), words)
                prints = [fingerprint(s) for s in sets]
                yield out([2] * len(sets), part.column("doc_id"), [len(s) for s in sets], None, part.column("mark"), prints, None,
                          [full_sketch(s) if len(s) else [] for s in sets])
                for s, f in zip(sets, prints):
                    k = band.keys(s)
                    if len(k):
                        keys.append(k)
                        nodes.append(f)
                        held += len(k)
                    if held >= FLUSH:
                        yield from flush()
                        keys, nodes, held = [], [], 0
        yield from flush()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(build, _INDEX.format(kind=kind))


def _shared_keys(table: pa.Table) -> pa.Table:
    """Entries of the keys of one bucket that several nodes hold."""
    bucket = table.column("bucket")[0].as_py() if table.num_rows else 0
    low, node = [], []
    for blob in table.column("blob").to_pylist():
        keys, own, at = _split(blob)
        low.append(unpack(keys, np.uint32, ordered=True))
        node.append(np.frombuffer(own, np.int64)[unpack(at, np.uint32)])
    low, node = np.concatenate(low), np.concatenate(node)
    order = np.argsort(low, kind="stable")
    low, node = low[order], node[order]
    same = low[1:] == low[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    low, node = low[several], node[several]
    if len(low):
        order = np.lexsort((node, low))
        low, node = low[order], node[order]
        new = np.concatenate([[True], (low[1:] != low[:-1]) | (node[1:] != node[:-1])])
        low, node = low[new], node[new]
        same = low[1:] == low[:-1]
        several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        low, node = low[several], node[several]
    return pa.table({"key": pa.array(low.astype(np.int64) | (bucket << 32), pa.int64()),
                     "node": pa.array(node, pa.int64())})


def _marked(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """``rows`` and ``_in``: false only where the row's hash ``_h`` is none of ``hashes``, judged by a bitmap.

    The bitmap is bounded; with more hashes than it has room for, more rows are taken for members.
    """
    size = 1 << 15
    while size < min(MOST_BITS, BITS * hashes.count()):
        size *= 2
    spot = F.pmod(F.col("_h"), F.lit(size))
    bits = (hashes.select(F.shiftright(spot, 15).alias("_b"), spot.bitwiseAND(F.lit((1 << 15) - 1)).alias("_p"))
            .groupBy("_b").agg(F.bitmap_construct_agg("_p").alias("_m")))
    at = spot.bitwiseAND(F.lit((1 << 15) - 1)).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("_m"), F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (rows.withColumn("_b", F.shiftright(spot, 15)).join(F.broadcast(bits), "_b", "left")
            .withColumn("_in", F.coalesce(F.getbit(byte, at.bitwiseAND(F.lit(7))) == 1, F.lit(False))).drop("_b", "_m"))


def _sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` for the wanted nodes, from one document of each, written."""
    wanted = written(wanted, "jaccard-wanted")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                node = part.column("node").to_pylist()
                sets = shingle_sets(part.column("text"), words)
                found = [(f, s.astype(np.int64)) for f, s in zip(node, sets) if fingerprint(s) == f]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in found], pa.int64()),
                     pa.array([s for _, s in found], pa.list_(pa.int64()))], names=["node", "shingles"])

    rows = rows.withColumn("_h", F.xxhash64("doc_id"))
    rows = _marked(rows, wanted.select(F.xxhash64("doc_id").alias("_h"))).filter("_in").drop("_h", "_in")
    joined = rows.join(wanted.select(F.col("doc_id").alias("_d"), "node"), F.col("doc_id").eqNullSafe(F.col("_d")))
    sets = written(joined.select("node", "text").mapInArrow(build, "node bigint, shingles array<bigint>"), "jaccard-sets")
    discard(wanted)
    return sets


def _centres(index: DataFrame) -> DataFrame:
    """``key, node, centre``.  The centre of a key is the node that shares most entries over all its keys, so that
    the keys of one group of near copies agree on few centres."""
    size = index.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    weight = index.join(size, "key").groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = index.join(weight, "node")
    centre = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).getField("node").alias("centre"))
    return written(index.join(centre, "key"), "jaccard-keyed")


def _hamming(a: str, b: str):
    """Hamming distance of two parity sketches; the longer one is folded to the shorter one's length."""
    def fold(x: str, y: str) -> str:
        step = f"CAST(size({x}) / greatest(least(size({x}), size({y})), 1) AS INT)"
        return (f"transform(sequence(0, least(size({x}), size({y})) - 1), i -> "
                f"aggregate(slice({x}, i * {step} + 1, {step}), 0L, (s, w) -> s ^ w))")
    return F.expr(f"aggregate(zip_with({fold(a, b)}, {fold(b, a)}, (x, y) -> bit_count(x ^ y)), 0, (s, n) -> s + n)")


def _folded(sketch: str):
    """A sketch folded to SMALL words."""
    step = f"CAST(size({sketch}) / {SMALL} AS INT)"
    return F.expr(f"transform(sequence(0, {SMALL - 1}), i -> "
                  f"aggregate(slice({sketch}, i * {step} + 1, {step}), 0L, (s, w) -> s ^ w))")


def _differences(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The columns of ``pairs``, ``nc, nn, differ``: sizes, and the shingles that only one of centre and node has."""
    centres = sets.join(pairs.select(F.col("centre").alias("node")).distinct(), "node", "left_semi")
    return (pairs.join(centres.select(F.col("node").alias("centre"), F.col("shingles").alias("sc")), "centre")
            .join(sets.select("node", F.col("shingles").alias("sn")), "node")
            .select(*pairs.columns, F.size("sc").cast("long").alias("nc"), F.size("sn").cast("long").alias("nn"),
                    F.concat(F.array_except("sn", "sc"), F.array_except("sc", "sn")).alias("differ")))


def _star(keyed: DataFrame, rows: DataFrame, one_each: DataFrame, words: int, num: int,
          den: int) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` of nodes with the centres of their keys, and the sets that were needed.

    The sketches decide first: a Hamming distance above the most a linked pair
    can have rules the pair out.  The rest is verified on the whole sets.
    """
    sketch = one_each.select("node", "n", "sketch")
    pairs = (keyed.filter("node <> centre").select("centre", "node").distinct()
             .join(sketch, "node")
             .join(sketch.select(F.col("node").alias("centre"), F.col("n").alias("nc"), F.col("sketch").alias("sc")),
                   "centre"))
    near = _linked(F.col("n"), F.col("nc"), _hamming("sketch", "sc"), num, den)
    pairs = written(pairs.filter(near).select("centre", "node"), "jaccard-pairs")
    sets = _sets(rows, _wanted(pairs, one_each), words)
    return _verified(pairs, sets, num, den), sets


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The links ``a, b`` among pairs ``centre, node``, by their whole sets."""
    links = _differences(pairs, sets).filter(_linked(F.col("nc"), F.col("nn"), F.size("differ"), num, den))
    return written(links.select(F.col("centre").alias("a"), F.col("node").alias("b")), "jaccard-links")


def _wanted(pairs: DataFrame, one_each: DataFrame) -> DataFrame:
    return (pairs.select("node").unionByName(pairs.select(F.col("centre").alias("node"))).distinct()
            .join(one_each.select("node", "doc_id"), "node"))


def _linked(na, nb, differ, num: int, den: int):
    """Similarity at least num / den, for sets of na and nb shingles with ``differ`` in only one of them."""
    return (na + nb - differ) * den >= (na + nb + differ) * num


def rounds_for(pairs: int, nodes: int) -> int:
    """Rounds for ``pairs`` of a node and a centre: each takes about ``nodes`` of them."""
    return min(ROUNDS, max(1, -(-pairs // max(1, nodes))))


def _tokens(around: DataFrame, have: DataFrame, one_each: DataFrame, num: int, den: int) -> DataFrame:
    """The first differences from their centre of nodes ``centre, node, c``, those that several components have."""
    small = one_each.select("node", _folded("sketch").alias("s"))
    r = F.lit(den - num) / F.lit(den + num)
    # the most by which a linked node of any size can differ
    most = F.floor(F.col("n") * (den - num) / num)
    wide = F.least("d", most + 1)
    narrow = F.least(F.col("d") - F.greatest(F.lit(1), F.ceil((F.lit(1) - r) * F.col("d") / 2 - 1e-9)) + 1,
                     F.floor(most / 2) + 1)
    members = (_differences(around.join(small, "node"), have)
               .select("centre", "node", "c", "s", F.col("nn").alias("n"), F.size("differ").cast("long").alias("d"), "differ")
               .select("centre", "node", "c", "s", "n", "d", narrow.alias("narrow"),
                       F.slice("differ", F.lit(1), wide.cast("int")).alias("first")))
    members = written(members, "jaccard-members")
    same = Window.partitionBy("centre", "token")
    tokens = (members.select("centre", "node", "c", "n", "d", "s", "narrow", F.posexplode("first").alias("at", "token"))
              .withColumn("_l", F.min("c").over(same)).withColumn("_h", F.max("c").over(same))
              .filter("_l <> _h").drop("_l", "_h"))
    tokens = written(tokens, "jaccard-tokens")
    discard(members)
    return tokens


def _paired(members: DataFrame) -> DataFrame:
    """Pairs ``x, y`` (x < y) of nodes of one key in different components, for keys with few members ``key, node, c``."""
    return (members.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "c"))).alias("m"))
            .select(F.explode(F.expr("flatten(transform(m, (a, i) -> transform(filter(slice(m, i + 2, size(m)), "
                                     "b -> b.c <> a.c), b -> struct(a.node AS x, b.node AS y))))")).alias("p"))
            .select("p.x", "p.y").distinct())


def _between(keyed: DataFrame, groups: DataFrame, sets: DataFrame, rows: DataFrame, one_each: DataFrame, words: int,
             num: int, den: int) -> DataFrame:
    """Links ``a, b`` between nodes of one key, beside its centre, that no link joins yet.

    Where a key has few of them (``PAIRED``), their sketches are compared pair by
    pair, and no set is moved for a pair that these rule out.  The nodes of the
    other keys are compared around their centres.  Let x and y differ from their centre in dx >= dy shingles, r = (1 - t) / (1 + t),
    and D the most by which linked sets of their sizes differ.  If they are
    linked, but not both linked with the centre, they share at least one of these
    differences, at least (1 - r) dy / 2, and at least (dx + dy - D) / 2 >= dx - D.
    So, in one order for all, one of y's first dy - that + 1 differences is among
    x's first D + 1.  Shingles the centre does not have come first: they are rare.
    Only these first differences are kept, and of them those that nodes of several
    components have.  Parity sketches rule most pairs out, folded ones inside the
    join and whole ones after it; what is left is verified on the whole sets.
    A node has many centres, and its set goes to each; so the centres take turns,
    some in each round (``rounds_for``).  ``keyed`` and ``sets`` are deleted.
    """
    label = groups.select("node", F.col("component").alias("c"))
    known = (keyed.filter("node <> centre").join(label, "node", "left")
             .select("key", "centre", "node", F.coalesce("c", "node").alias("c")))
    # only keys that hold more than one component beside the centre can link anything new
    open_keys = (known.groupBy("key").agg(F.min("c").alias("_l"), F.max("c").alias("_h"), F.count(F.lit(1)).alias("_n"))
                 .filter("_l <> _h").select("key", (F.col("_n") > PAIRED).alias("many")))
    open_ = written(known.join(open_keys, "key"), "jaccard-open")
    discard(keyed)
    few = written(_paired(open_.filter("NOT many")), "jaccard-few")
    around = written(open_.filter("many").select("centre", "node", "c").distinct(), "jaccard-around")
    discard(open_)
    missing = _wanted(around, one_each).join(sets.select("node"), "node", "left_anti")
    more = _sets(rows, missing, words)
    have = sets.unionByName(more)
    # a round moves the sets of at most half as many pairs as there are nodes at all
    rounds = rounds_for(around.count(), one_each.count() // 2)
    turn = F.pmod(F.xxhash64("centre"), F.lit(rounds))
    parts = [_tokens(around.filter(turn == k), have, one_each, num, den) for k in range(rounds)]
    discard(around)
    tokens = reduce(DataFrame.unionByName, parts)
    there = tokens.select("centre", "token", F.col("node").alias("x"), "c", "n", "d", "s")
    probe = tokens.filter("at < narrow").select(
        "centre", "token", F.col("node").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"),
        F.col("d").alias("dy"), F.col("s").alias("t"))
    apart = sum((F.bit_count(F.get("s", F.lit(k)).bitwiseXOR(F.get("t", F.lit(k)))) for k in range(SMALL)), F.lit(0))
    found = (there.join(probe, ["centre", "token"])
             .filter((F.col("c") != F.col("cy")) & F.expr("dy < d OR (dy = d AND y < x)")
                     & _linked(F.col("n"), F.col("ny"), F.col("d") - F.col("dy"), num, den)
                     & _linked(F.col("n"), F.col("ny"), apart, num, den))
             .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).unionByName(few).distinct())
    side = lambda n: one_each.select(F.col("node").alias(n), F.col("n").alias(f"n{n}"),
                                     F.col("sketch").alias(f"s{n}"))
    found = written(found.join(side("x"), "x").join(side("y"), "y")
                    .filter(_linked(F.col("nx"), F.col("ny"), _hamming("sx", "sy"), num, den))
                    .select(F.col("x").alias("centre"), F.col("y").alias("node")), "jaccard-found")
    for table in (*parts, few):
        discard(table)
    missing = _wanted(found, one_each).join(have.select("node"), "node", "left_anti")
    last = _sets(rows, missing, words)
    ends = found.select("node").unionByName(found.select(F.col("centre").alias("node")))
    asked = _marked(have.unionByName(last).withColumn("_h", F.xxhash64("node")), ends.select(F.xxhash64("node").alias("_h")))
    links = _verified(found, asked.filter("_in").drop("_h", "_in"), num, den)
    for table in (sets, more, last):
        discard(table)
    return links


def bucket_count(size: int, partitions: int) -> int:
    """Key buckets for ``size`` bytes of text: a task unpacks one whole bucket, so they grow with the text."""
    return max(8, partitions, -(-size // BUCKET_BYTES))


def _grouped(docs: DataFrame, words: int, threshold: tuple[int, int], id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, node, mark`` of every row (``mark``: a hash of the text), and ``node, component`` of linked nodes."""
    ship_package(docs.sparkSession)
    num, den = threshold
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = bucket_count(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = written(_index(rows.withColumn("mark", F.xxhash64("text")), words, num, den, buckets), "jaccard-index")
    nodes = written(table.filter("kind = 2").select("doc_id", "n", "node", F.col("key").alias("mark"), "sketch"), "jaccard-documents")
    packed = (table.filter("kind = 0").select("bucket", "blob").groupBy("bucket")
              .applyInArrow(_shared_keys, "key bigint, node bigint"))
    many = table.filter("kind = 1").select("key", "node").distinct()
    index = written(packed.unionByName(many).distinct(), "jaccard-keys")
    discard(table)

    one_each = written(nodes.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                                                                 F.first("sketch").alias("sketch")), "jaccard-nodes")
    nodes = nodes.drop("sketch")
    keyed = _centres(index)
    discard(index)
    linked, sets = _star(keyed, rows, one_each, words, num, den)
    more = _between(keyed, components(linked), sets, rows, one_each, words, num, den)
    discard(one_each)
    return nodes, components(linked.unionByName(more))


def jaccard_components(docs: DataFrame, *, words: int = 5, threshold: tuple[int, int] = (80, 100),
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Two documents link when the Jaccard similarity of their sets of ``words``-word
    shingles (A-Z lower-cased) is at least ``threshold``; the component is the
    smallest doc_id reachable over links.  Shingles and sets are told apart by
    64-bit hashes.

    Defined cases: a text with fewer words is one shingle, its whole sequence; an
    empty or null text has no shingle and links with nothing, so it is its own
    component; texts with equal sets link; a null id never is a component's name
    unless nothing else is in it; rows that repeat are each returned; an empty
    table gives an empty result; other input columns are ignored.
    """
    nodes, groups = _grouped(docs, words, threshold, id_col, text_col)

    # the smallest doc_id of each component, by node, then for every document
    by_node = nodes.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("_d"), F.count(F.lit(1)).alias("_n"))
    labelled = by_node.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node"))
    lead = labelled.groupBy("c").agg(F.min("_d").alias("component_id"))
    shared = labelled.join(lead, "c").filter("_n > 1 OR component IS NOT NULL").select("node", "component_id")
    return (nodes.join(shared, "node", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("component_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id")))


def drop_near_copies(docs: DataFrame, *, words: int = 5, threshold: tuple[int, int] = (80, 100),
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each group of linked rows, that of the smallest id, columns unchanged.

    Defined cases: ids may be null or repeat; a null id stays only where its group
    has no other; of rows with the same id and text any one stays, of different
    texts under one id the one with the smallest hash; rows without a word link
    with nothing and all stay.
    """
    nodes, groups = _grouped(docs, words, threshold, id_col, text_col)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    lead = (nodes.filter("n > 0").join(groups, "node", "left").groupBy(F.coalesce("component", "node").alias("c"))
            .agg(F.min(key).alias("k")).select(F.col("k.doc_id").alias("_lead"), F.col("k.mark").alias("_mark")))
    lead = written(lead, "jaccard-leads")
    same = (nodes.filter("n > 0").join(lead, F.col("doc_id").eqNullSafe(F.col("_lead")) & (F.col("mark") == F.col("_mark")))
            .groupBy("_lead", "_mark").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("_lead", "_mark"))
    same = written(same, "jaccard-repeated")
    mark = F.xxhash64(text_of(text_col))
    is_lead = lambda t: docs[id_col].eqNullSafe(t["_lead"]) & (mark == t["_mark"])
    empty = nodes.filter("n = 0").select(F.col("doc_id").alias("_lead"), F.col("mark").alias("_mark")).distinct()
    # a row that leads nothing, or repeats, may have to go; all others stay without a look at the leads
    alike = F.col("doc_id").eqNullSafe(F.col("_lead")) & (F.col("mark") == F.col("_mark"))
    goes = nodes.filter("n > 0").join(lead, alike, "left_anti").select("doc_id", "mark")
    goes = written(goes.unionByName(same.toDF("doc_id", "mark")).select(F.xxhash64("doc_id", "mark").alias("_h")).distinct(), "jaccard-goes")
    spread = _marked(docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("_row"),
                                 F.xxhash64(F.col(id_col), mark).alias("_h")), goes)
    sure = spread.filter("NOT _in").select("_row.*")
    docs = spread.filter("_in").select("_row.*")
    if not same.head(1):
        stay = lead.unionByName(empty)
        return sure.unionByName(docs.join(stay, is_lead(stay), "left_semi"))
    once = lead.alias("l").join(same.alias("r"), F.col("l._lead").eqNullSafe(F.col("r._lead"))
                                & (F.col("l._mark") == F.col("r._mark")), "left_anti").unionByName(empty)
    some = (docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("_d"), mark.alias("_m"))
            .join(same, F.col("_d").eqNullSafe(F.col("_lead")) & (F.col("_m") == F.col("_mark")), "left_semi")
            .groupBy("_d", "_m").agg(F.first("_row").alias("_row")).select("_row.*"))
    return sure.unionByName(docs.join(once, is_lead(once), "left_semi")).unionByName(some)
