"""Language-model scores by deleted interpolation.

The model mixes the maximum-likelihood estimates of the n-grams up to an order (3
unless asked otherwise) and the uniform distribution.  The mixture weights depend
on the longest context that was seen and on how often (buckets by powers of two) and are learned by expectation-maximisation:
counts from most training documents, likelihood of a deleted part of them.  The
scores then use the counts of all training documents.

Words are 64-bit hashes.  Documents lie in tiles of bounded size: the next rows of
a task's input, so that no document travels before it is counted.  A tile sends
each distinct n-gram once, with its counts, to the bucket that owns it; the
bucket adds up and answers with the totals in the same order.  So n-gram tables
are never joined token by token, and grow with the corpus in buckets only.  The
answers are written, which frees the requests; a second pass deals the documents
into the same tiles, and each tile checks that its answers are for its n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from carestar.session import ship_package

from .bytewords import combined, hash_words, mixed
from .common import text_of, written
from .packing import pack, unpack

_U = np.uint64
TILE_BYTES = 5 << 20
FOLDS = 7
# The end of a text, and what stands before its first word
_END, _START = _U(0x5851F42D4C957F2D), _U(0x14057B7EF767814F)
# Context buckets (0: never seen) and cells of one octave for the weights' likelihood
BUCKETS, FINE = 34, 8
# A cell's rounded log estimates, so many bits each; 0: never seen
_BITS, _ZERO = 12, 1 << 11
MAX_ORDER = 4
ROUNDS = 60


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 7; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


class _Tile:
    """Tokens of a tile's documents and its distinct n-grams, in key order."""

    def __init__(self, texts: pa.ChunkedArray, order: int):
        words, at = hash_words(pa.concat_arrays(texts.cast(pa.large_string()).chunks)
                               if texts.num_chunks else pa.array([], pa.large_string()))
        n_docs = len(at) - 1
        self.length = np.diff(at) + 1
        self.first = at[:-1] + np.arange(n_docs)
        last = self.first + self.length - 1
        self.doc = np.repeat(np.arange(n_docs), self.length)
        token = np.empty(len(words) + n_docs, np.uint64)
        is_word = np.ones(len(token), bool)
        is_word[last] = False
        token[is_word] = words
        token[last] = _END
        # the lowest bit tells unigrams (0) from longer n-grams (1)
        parts, keys = [token], [mixed(token) & ~_U(1)]
        for _ in range(1, order):
            before = np.empty_like(token)
            before[1:] = parts[0][:-1]
            before[self.first] = _START
            parts = [before, *parts]
            keys.append(combined(parts) | _U(1))
        every = np.concatenate(keys)
        by_key = np.argsort(every)
        ordered = every[by_key]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, bool)
        self.keys = ordered[new]
        place = np.empty(len(every), np.int64)
        place[by_key] = np.cumsum(new) - 1
        # by length: each token's n-gram, and the context of the next longer one
        self.grams = place.reshape(order, len(token))
        end = int(self.grams[0][last[0]]) if n_docs else 0
        self.contexts = np.empty_like(self.grams[:-1])
        self.contexts[:, 1:] = self.grams[:-1, :-1]
        self.contexts[:, self.first] = end   # a text starts as often as one ends

    def cuts(self, buckets: int) -> np.ndarray:
        owner = (((self.keys >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)
        return np.searchsorted(owner, np.arange(buckets + 1))


def _fold(tile: _Tile, table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("fold"))[tile.doc] if len(tile.doc) else np.zeros(0, np.int64)


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


_REQUEST = "bucket bigint, tile bigint, keys binary, kept binary, deleted binary"
_ANSWER = "tile bigint, bucket bigint, total binary, deleted binary, check bigint, stats binary"


def _tiles(batches: Iterator[pa.RecordBatch], tile_bytes: int) -> Iterator[tuple[int, pa.Table]]:
    """A task's rows in runs of about ``tile_bytes`` of text, numbered apart from those of other tasks."""
    from pyspark import TaskContext

    from .bpe import _slices

    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in batches:
        for part in _slices(batch, tile_bytes // 8):
            held.append(part)
            size += part.column("text").nbytes
            if size >= tile_bytes:
                yield number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held)


def _request(buckets: int, held_out: int, deleted: int, order: int, tile_bytes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, table in _tiles(batches, tile_bytes):
            tile = _Tile(table.column("text"), order)
            fold = _fold(tile, table)
            kept, gone = (np.bincount(tile.grams[:, sel].ravel(), minlength=len(tile.keys)).astype(np.uint32)
                          for sel in ((fold != held_out) & (fold != deleted), fold == deleted))
            cuts = tile.cuts(buckets)
            at = [(b, int(i), int(j)) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in at], pa.int64()), pa.array([number] * len(at), pa.int64()),
                 pa.array([pack(tile.keys[i:j], ordered=True) for _, i, j in at], pa.binary()),
                 pa.array([pack(kept[i:j]) for _, i, j in at], pa.binary()),
                 pa.array([pack(gone[i:j]) for _, i, j in at], pa.binary())],
                names=["bucket", "tile", "keys", "kept", "deleted"])
    return count


def _deal(tile_bytes: int):
    """The documents with the number of their tile."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile, table in _tiles(batches, tile_bytes):
            for part in table.to_batches():
                yield pa.RecordBatch.from_arrays([pa.array([tile] * part.num_rows, pa.int64()), *part.columns],
                                                 names=["tile", *part.schema.names])
    return number


# Plans that give the same rows to the same tasks each time they run
_STEADY = {"Project", "Filter", "LogicalRelation", "LocalRelation", "LogicalRDD", "Union", "Range"}


def _steady(df: DataFrame) -> bool:
    """True when a second pass over ``df`` deals its rows like the first: scans, projections and filters only."""
    nodes = [df._jdf.queryExecution().optimizedPlan()]
    while nodes:
        node = nodes.pop()
        if node.getClass().getSimpleName() not in _STEADY:
            return False
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return True


def _answer():
    """Add up a bucket and give each tile its totals; one row more (tile -1) has the bucket's statistics."""
    def add(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        parts = [[unpack(b, kind, c == "keys") for b in table.column(c).to_pylist()]
                 for c, kind in (("keys", np.uint64), ("kept", np.uint32), ("deleted", np.uint32))]
        keys, kept, gone = (np.concatenate(p) for p in parts)
        order = np.argsort(keys)
        ordered = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        run = np.empty(len(keys), np.int64)
        run[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        kept_sum = np.add.reduceat(kept[order].astype(np.int64), first)
        gone_sum = np.add.reduceat(gone[order].astype(np.int64), first)
        single = (ordered[first] & _U(1)) == 0
        total = kept_sum + gone_sum
        stats = np.array([total[single].sum(), (total[single] > 0).sum(), kept_sum[single].sum(),
                          (kept_sum[single] > 0).sum()], np.int64)
        ends = np.cumsum([len(p) for p in parts[0]])
        cut = list(zip([0, *ends[:-1].tolist()], ends.tolist()))
        n = len(cut)
        return pa.table([
            pa.array([*table.column("tile").to_pylist(), -1], pa.int64()),
            pa.array([bucket] * (n + 1), pa.int64()),
            pa.array([*(pack(total[run[i:j]].astype(np.uint64)) for i, j in cut), None], pa.binary()),
            pa.array([*(pack(gone_sum[run[i:j]].astype(np.uint64)) for i, j in cut), None], pa.binary()),
            pa.array([*(_check(keys[i:j]) for i, j in cut), 0], pa.int64()),
            pa.array([*[None] * n, _blob(stats)], pa.binary())],
            names=["tile", "bucket", "total", "deleted", "check", "stats"])
    return add


def _check(keys: np.ndarray) -> int:
    """A sum that tells whether totals are for these n-grams."""
    return int((keys * _U(0x9E3779B97F4A7C15) ^ keys >> _U(29)).sum(dtype=np.uint64).astype(np.int64))


def _totals(tile: _Tile, answers: pa.Table, column: str) -> np.ndarray:
    got = sorted((b, x, c) for b, x, c in zip(*(answers.column(n).to_pylist() for n in ("bucket", column, "check")))
                 if x is not None)
    out = np.concatenate([unpack(x, np.uint64) for _, x, _ in got]).astype(np.int64) if got else np.zeros(0, np.int64)
    # sums wrap around at 64 bits
    asked, told = _check(tile.keys), sum(c for _, _, c in got)
    if len(out) != len(tile.keys) or (asked - told) % (1 << 64):
        raise RuntimeError("the second pass met the documents in other tasks than the first; write the input before scoring")
    return out


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, then one bucket per power of two."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def _buckets(contexts: list[np.ndarray], size: int) -> np.ndarray:
    """Bucket of the longest context seen; those of each length follow on those of shorter ones."""
    b = np.zeros(size, np.int64)
    for k, context in enumerate(contexts):
        b = np.where(context > 0, k * BUCKETS + _bucket(context), b)
    return b


_CELLS = "b int, q bigint, mass bigint"


def _cells(deleted: int, order: int):
    """The deleted tokens by context bucket and rounded log estimates."""
    def gather(docs: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows:
            tile = _Tile(docs.column("text"), order)
            kept = _totals(tile, answers, "total") - _totals(tile, answers, "deleted")
            sel = _fold(tile, docs) == deleted
            seen, contexts = kept[tile.grams[:, sel]], kept[tile.contexts[:, sel]]
            b = _buckets(list(contexts), int(sel.sum()))
            if len(b):
                cell = b
                for k in range(order):
                    log = np.rint(FINE * np.log2(np.maximum(seen[k], 1) / (np.maximum(contexts[k - 1], 1) if k else 1)))
                    cell = (cell << _BITS) + np.where(seen[k] > 0, np.clip(log, 1 - _ZERO, _ZERO - 1).astype(np.int64) + _ZERO, 0)
                cell = np.sort(cell)
                first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
                low = (1 << _BITS * order) - 1
                rows += [(int(c >> _BITS * order), int(c & low), int(n))
                         for c, n in zip(cell[first], np.diff(np.append(first, len(cell))))]
        cols = list(zip(*rows)) or [()] * 3
        return pa.table([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                        names=["b", "q", "mass"])
    return gather


def _stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets' statistics as cells (b = -1)."""
    for batch in batches:
        rows = [(-1, i, int(x)) for s in batch.column("stats").to_pylist() for i, x in enumerate(np.frombuffer(s, np.int64))]
        cols = list(zip(*rows)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                         names=["b", "q", "mass"])


def learn_weights(b: np.ndarray, parts: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Mixture weights per context bucket, by expectation-maximisation.

    ``parts``: by cell, the estimates of the unigram, the bigram and so on, and the
    uniform one.  A bucket without held-out tokens gets the weights of all buckets
    together, without the n-grams whose context it has not seen.
    """
    order = parts.shape[1] - 1

    def fit(sel: np.ndarray, start: np.ndarray) -> np.ndarray:
        w, m, p = start, mass[sel], parts[sel]
        for _ in range(ROUNDS):
            share = p * w
            share /= share.sum(1, keepdims=True)
            # one more token for each part keeps every weight above zero
            w = (share * m[:, None]).sum(0) + np.where(start > 0, 1.0, 0.0)
            w /= w.sum()
        return w

    even = np.full(order + 1, 1 / (order + 1))
    every = fit(mass > 0, even) if (mass > 0).any() else even
    out = np.tile(every, (_bucket_total(order), 1))
    for k in range(len(out)):
        # in bucket 0 no context was seen, in those of a length none that is longer
        longest = 1 if k == 0 else 2 + (k - 1) // BUCKETS
        start = np.where((np.arange(order + 1) < longest) | (np.arange(order + 1) == order), every, 0.0)
        start /= start.sum()
        sel = (b == k) & (mass > 0)
        out[k] = fit(sel, start) if sel.any() else start
    return out


def _bucket_total(order: int) -> int:
    return (order - 1) * BUCKETS + 1


def _weights(table: pa.Table, order: int) -> pa.Table:
    b, q, mass = (np.asarray(table.column(c)).astype(np.int64) for c in ("b", "q", "mass"))
    stats = np.zeros(4, np.int64)
    np.add.at(stats, q[b == -1], mass[b == -1])
    seen = b >= 0
    b, q, mass = b[seen], q[seen], mass[seen].astype(float)
    parts = np.full((len(b), order + 1), 1 / (stats[3] + 1))
    for k in range(order):
        log = (q >> _BITS * (order - 1 - k)) & ((1 << _BITS) - 1)
        whole = 1 if k else max(1, stats[2])
        parts[:, k] = np.where(log > 0, np.exp2((np.minimum(log - _ZERO, 0) if k else log - _ZERO) / FINE) / whole, 0.0)
    weights = learn_weights(b, parts, mass)
    return pa.table({"model": pa.array([_blob(np.concatenate([stats[:2].astype(float), weights.ravel()]))], pa.binary())})


def _score(id_type: pa.DataType, held_out: int, order: int):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kinds = [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table([pa.array([], k) for k in kinds], names=names)
        model = next(np.frombuffer(m, np.float64) for m in answers.column("model").to_pylist() if m is not None)
        n, v, weights = model[0], model[1], model[2:].reshape(_bucket_total(order), order + 1)
        tile = _Tile(docs.column("text"), order)
        total = _totals(tile, answers, "total")
        word, contexts = total[tile.grams[0]], [total[c] for c in tile.contexts]
        w = weights[_buckets(contexts, len(word))]
        p = w[:, 0] * word / max(n, 1) + w[:, order] / (v + 1)
        for k, context in enumerate(contexts, 1):
            p += w[:, k] * total[tile.grams[k]] / np.maximum(context, 1)
        add = lambda x: np.add.reduceat(x, tile.first)
        size = docs.num_rows
        return pa.table([docs.column("doc_id"), pa.array(np.asarray(docs.column("fold")) == held_out),
                         pa.array(tile.length.astype(np.int64)), pa.array(add((word > 0).astype(np.int64))),
                         pa.array(np.full(size, int(n), np.int64)), pa.array(add(np.log10((word + 1) / (n + v + 1)))),
                         pa.array(add(np.log10(p)))], names=names)
    return score


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: int = 2,
              deleted: int = 3, order: int = 3, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row per input row.

    Training documents are those whose fold (crc32 of the id, modulo 7) is not
    ``held_out``; the fold ``deleted`` is the part of them on which the weights
    are learned.  ``order``: words of the longest n-grams, 1 to ``MAX_ORDER``.  ``score``: log10 probability of the text's words and its end;
    ``base_score``: the same under unigrams with add-one smoothing.

    Defined cases: a null text is empty and holds just its end; a null id is in
    the fold of the empty text; rows that repeat are scored, and count, each;
    without training documents both models are uniform; an empty table gives an
    empty result; other input columns are ignored.  A task holds a tile, at
    least one whole document.
    """
    if not 1 <= order <= MAX_ORDER:
        raise ValueError(f"order must be from 1 to {MAX_ORDER}: {order}")
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("fold", fold_of(F.col("doc_id")))
    if not _steady(rows):
        rows = written(rows, "lm-rows")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(4, -(-size // tile_bytes))
    id_type = rows.schema["doc_id"].dataType
    kind = id_type.simpleString()

    asked = rows.mapInArrow(_request(buckets, held_out, deleted, order, tile_bytes), _REQUEST)
    told = written(asked.groupBy("bucket").applyInArrow(_answer(), _ANSWER), "lm-answers")

    # written before the documents are dealt: the driver lets go of the requests' shuffle when a later job has ended
    stats = written(told.filter("tile < 0").select("stats").mapInArrow(_stat_rows, _CELLS), "lm-stats")
    by_tile = rows.mapInArrow(_deal(tile_bytes), f"tile bigint, doc_id {kind}, text string, fold int").groupBy("tile")
    answers = told.filter("tile >= 0")
    cells = by_tile.cogroup(answers.select("tile", "bucket", "total", "deleted", "check").groupBy("tile")).applyInArrow(
        _cells(deleted, order), _CELLS)
    # the cells lie on a fixed grid, so their number is bounded; a larger corpus fills more of it
    model = (cells.unionByName(stats).groupBy("b", "q").agg(F.sum("mass").alias("mass")).withColumn("all", F.lit(0))
             .groupBy("all").applyInArrow(lambda t: _weights(t, order), "model binary"))
    to_all = answers.select("tile").distinct().withColumn("model", model.scalar())
    full = (answers.select("tile", "bucket", "total", "check", F.lit(None).cast("binary").alias("model"))
            .unionByName(to_all.select("tile", F.lit(None).cast("bigint").alias("bucket"), F.lit(None).cast("binary").alias("total"),
                                       F.lit(None).cast("bigint").alias("check"), "model")))
    return by_tile.cogroup(full.groupBy("tile")).applyInArrow(
        _score(to_arrow_type(id_type), held_out, order), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "train_tokens bigint, base_score double, score double")
