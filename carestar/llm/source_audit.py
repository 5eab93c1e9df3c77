"""Divergence between the sources of a language, by chunk factorization.

A chunk is a run of non-space characters; terms never cross chunks.  Chunks are
counted within each document, every globally distinct chunk is split into terms
once, and its terms are joined back to its counts: rows are partitioned and
sorted by chunk, so that the join is a walk over neighbouring rows.  Occurrences
and distinct documents of terms are then sums and distinct counts.

What travels of a chunk is one row per language and map task: its occurrences by
group, and the numbers of its documents while these are fewer than ``min_docs``.
A chunk of more documents makes its terms frequent by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from carestar.session import ship_package

from .common import written

# Characters of terms: ASCII letters and everything beyond ASCII
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

SCALE = 1_000_000_000

# Chunks of documents that a task counts together before it sends them on
HELD_CHUNKS = 1_000_000
# Cells of the block of terms by sources that is compared at once
BLOCK_CELLS = 1_000_000

_PAIR = np.dtype([("g", "<i8"), ("n", "<i8")])


def _binaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of a contiguous array as binary values; the runs follow each other."""
    width = data.dtype.itemsize
    offsets = np.append(starts, ends[-1:] if len(ends) else [0]).astype(np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where a row of sorted keys differs from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _chunk_counts(min_docs: int):
    """Documents of a task -> rows of (lang, chunk, sources, n_docs, docs)."""

    def emit(held: list, base: int) -> Iterator[pa.RecordBatch]:
        chunks = pa.chunked_array([h[0] for h in held]).unify_dictionaries().combine_chunks()
        langs = pa.chunked_array([h[1] for h in held]).combine_chunks().dictionary_encode()
        lang_of, group_of = langs.indices.to_numpy(), np.concatenate([h[2] for h in held])
        # documents in the order of their groups, so that one sort of (chunk, place) brings groups together
        by_group = np.lexsort((group_of, lang_of))
        place = np.empty(len(by_group), np.int64)
        place[by_group] = np.arange(len(by_group))
        key = chunks.indices.to_numpy().astype(np.int64) * len(place) + place[np.concatenate([h[3] for h in held])]
        order = np.argsort(key)
        chunk, doc = np.divmod(key[order], len(place))
        doc, n = by_group[doc], np.concatenate([h[4] for h in held])[order]
        lang, group = lang_of[doc], group_of[doc]

        row = _first_of(chunk, lang)
        starts = np.flatnonzero(row)
        pair = _first_of(chunk, lang, group)
        at = np.flatnonzero(pair)
        pairs = np.empty(len(at), _PAIR)
        pairs["g"], pairs["n"] = group[at], np.add.reduceat(n, at)
        pair_starts = np.searchsorted(at, starts)
        n_docs = np.diff(np.append(starts, len(doc)))
        few = np.repeat(n_docs < min_docs, n_docs)
        few_ends = np.cumsum(np.where(n_docs < min_docs, n_docs, 0))
        few_starts = few_ends - np.where(n_docs < min_docs, n_docs, 0)
        out = pa.table([langs.dictionary.take(pa.array(lang[starts])), chunks.dictionary.take(pa.array(chunk[starts])),
                        _binaries(pairs, pair_starts, np.array([len(at)])),
                        pa.array(n_docs, pa.int64()),
                        _binaries(base + doc[few], few_starts, few_ends)],
                       names=["lang", "chunk", "sources", "n_docs", "docs"])
        out = out.set_column(2, "sources", out["sources"].cast(pa.binary()))
        out = out.set_column(4, "docs", out["docs"].cast(pa.binary()))
        yield from out.to_batches(20_000)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from .bpe import _slices

        base = TaskContext.get().partitionId() << 40
        held, size, docs = [], 0, 0
        for batch in batches:
            for part in _slices(batch):
                lists = pc.ascii_split_whitespace(part.column("text"))
                flat, doc = lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
                coded = flat.dictionary_encode()
                code = coded.indices.to_numpy().astype(np.int64)
                real = (pc.binary_length(coded.dictionary).to_numpy() > 0)[code] if len(code) else np.zeros(0, bool)
                key, n = np.unique(code[real] * part.num_rows + doc[real], return_counts=True)
                chunk, doc = np.divmod(key, part.num_rows)
                held.append((pa.DictionaryArray.from_arrays(pa.array(chunk.astype(np.int32)), coded.dictionary),
                             part.column("lang"), part.column("g").to_numpy(), doc + docs, n.astype(np.int64)))
                size += len(key)
                docs += part.num_rows
                if size >= HELD_CHUNKS:
                    yield from emit(held, base)
                    base, held, size, docs = base + docs, [], 0, 0
        if size:
            yield from emit(held, base)

    return count


def _join_terms(min_docs: int):
    """Rows sorted by chunk -> rows of its terms: (lang, term, g, n) and (lang, term, docs or null for enough)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, lower = re.compile(TERM).findall, bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
        last: tuple = (None, None)

        def terms_of(chunk: str) -> dict[str, int]:
            nonlocal last
            if last[0] != chunk:
                found: dict[str, int] = {}
                for t in find(chunk):
                    t = t.encode().translate(lower).decode()
                    found[t] = found.get(t, 0) + 1
                last = (chunk, found)
            return last[1]

        for batch in batches:
            chunks = batch.column("chunk").to_pylist()
            langs = batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy()
            names, term, times, row = {}, [], [], []
            for k, chunk in enumerate(chunks):
                for t, m in terms_of(chunk).items():
                    term.append(names.setdefault(t, len(names)))
                    times.append(m)
                    row.append(k)
            if not row:
                continue
            term, times, row = np.array(term), np.array(times, np.int64), np.array(row)
            words = pa.array(list(names), pa.string())

            # occurrences: every (group, n) of the row, times the term's share of the chunk
            per_row = _lengths(batch.column("sources")) // _PAIR.itemsize
            pairs, starts = np.frombuffer(_data(batch.column("sources")), _PAIR), np.cumsum(per_row) - per_row
            take = np.repeat(starts[row] - np.cumsum(per_row[row]) + per_row[row], per_row[row]) + np.arange(per_row[row].sum())
            t, l = np.repeat(term, per_row[row]), np.repeat(lang[row], per_row[row])
            g, n = pairs["g"][take], pairs["n"][take] * np.repeat(times, per_row[row])
            order = np.lexsort((g, l, t))
            t, l, g, n = (x[order] for x in (t, l, g, n))
            at = np.flatnonzero(_first_of(t, l, g))
            none = pa.nulls(len(at), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(l[at])), words.take(pa.array(t[at])), pa.array(g[at]),
                 pa.array(np.add.reduceat(n, at)), pa.nulls(len(at), pa.bool_()), none], names=_TERM_ROWS)

            # documents: distinct numbers of a (lang, term), or that there are enough of them
            many = (batch.column("n_docs").to_numpy() >= min_docs)[row]
            per_row = _lengths(batch.column("docs")) // 8
            numbers, starts = np.frombuffer(_data(batch.column("docs")), "<i8"), np.cumsum(per_row) - per_row
            take = np.repeat(starts[row] - np.cumsum(per_row[row]) + per_row[row], per_row[row]) + np.arange(per_row[row].sum())
            key = term * len(langs.dictionary) + lang[row]
            sure = np.unique(key[many])
            k, d = np.repeat(key, per_row[row]), numbers[take]
            order = np.lexsort((d, k))
            k, d = k[order], d[order]
            keep = _first_of(k, d)
            k, d = k[keep], d[keep]
            at = np.flatnonzero(_first_of(k))
            sizes = np.diff(np.append(at, len(k)))
            sure = np.union1d(sure, k[at][sizes >= min_docs])
            keep = ~np.isin(k, sure)
            k, d = k[keep], d[keep]
            at = np.flatnonzero(_first_of(k))
            keys = np.concatenate([sure, k[at]])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(
                [np.zeros(len(sure), np.int32), at, [len(d)]]).astype(np.int32)), pa.array(d))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(keys % len(langs.dictionary))),
                 words.take(pa.array(keys // len(langs.dictionary))), pa.nulls(len(keys), pa.int64()),
                 pa.nulls(len(keys), pa.int64()), pa.array(np.arange(len(keys)) < len(sure)), lists], names=_TERM_ROWS)

    return join


_TERM_ROWS = ["lang", "term", "g", "n", "enough", "docs"]


def _data(column: pa.Array) -> bytes:
    """All values of a binary column without nulls, one after the other."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return memoryview(column.buffers()[2] or b"")[offsets[0]:offsets[-1]]


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.binary_length(column).to_numpy().astype(np.int64)


def term_counts(docs: DataFrame, *, min_docs: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``groups(lang, source, g)``, ``counts(lang, g, term, n)`` and the kept ``terms(lang, term)`` of ``docs(lang, source, text)``.

    A term is kept when at least ``min_docs`` documents (rows) of its language hold it.
    """
    ship_package(docs.sparkSession)
    rows = docs.withColumn("g", F.xxhash64("lang", "source"))
    groups = written(rows.select("lang", "source", "g").distinct(), "audit-groups")
    if not groups.groupBy("g").count().filter("count > 1").isEmpty():
        raise ValueError("two groups share a hash")

    chunks = rows.select("lang", "g", "text").mapInArrow(
        _chunk_counts(min_docs), "lang string, chunk string, sources binary, n_docs bigint, docs binary")
    joined = chunks.repartition("chunk").sortWithinPartitions("chunk", "lang").mapInArrow(
        _join_terms(min_docs), "lang string, term string, g bigint, n bigint, enough boolean, docs array<bigint>")
    found = written(joined, "audit-terms")

    # documents of a chunk that fall under min_docs in every task can still add up, with those of other chunks too
    enough = found.filter("enough").select("lang", "term").distinct()
    few = (found.filter("NOT enough").select("lang", "term", F.explode("docs").alias("doc")).distinct()
           .groupBy("lang", "term").count().filter(F.col("count") >= min_docs).select("lang", "term"))
    terms = written(enough.unionByName(few).distinct(), "audit-kept")
    counts = (found.filter("g IS NOT NULL").groupBy("lang", "g", "term").agg(F.sum("n").alias("n"))
              .join(terms, ["lang", "term"]))
    return groups, written(counts, "audit-counts"), terms


def _share(n: Column, all_n: Column, v: Column) -> Column:
    """``1 + floor(SCALE * (n + 2) / (all_n + 2 v))`` in whole numbers; null without terms."""
    over = (all_n.cast("decimal(20,0)") + F.lit(2) * v.cast("decimal(18,0)")).cast("decimal(20,0)")
    top = (F.lit(SCALE).cast("decimal(10,0)") * (n + F.lit(2)).cast("decimal(20,0)")).cast("decimal(31,0)")
    return F.when(v > 0, F.lit(1).cast("long") + F.call_function("div", top, over))


def _divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms with their shares in all sources of the language -> sums of divergences for pairs of sources."""
    sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        code = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            mine = batch.filter(pa.array(code == k))
            gs = np.array(mine.column("gs")[0].as_py(), np.int64)
            base = np.array(mine.column("p0")[0].as_py(), np.int64)
            total = sums.setdefault(lang, (gs, np.zeros((len(gs), len(gs)), np.int64)))[1]
            step = max(1, BLOCK_CELLS // len(gs))
            for at in range(0, mine.num_rows, step):
                part = mine.slice(at, step)
                p = np.broadcast_to(base, (part.num_rows, len(gs))).copy()
                lists, here = part.column("here"), pc.list_parent_indices(part.column("here")).to_numpy()
                cells = lists.flatten()
                p[here, np.searchsorted(gs, cells.field("g").to_numpy())] = cells.field("p").to_numpy()
                for a in range(len(gs) - 1):
                    x, y = p[:, a:a + 1], p[:, a + 1:]
                    d = x - y
                    total[a, a + 1:] += (d * d // (x + y)).sum(axis=0)
    for lang, (gs, total) in sums.items():
        a, b = np.triu_indices(len(gs), 1)
        yield pa.RecordBatch.from_arrays([pa.array(gs[a]), pa.array(gs[b]), pa.array(total[a, b])],
                                         names=["g", "h", "value"])


def source_divergence(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: how the sources of a language differ in their use of terms.

    A term is a run of ASCII letters (lower-cased) and characters beyond ASCII;
    a language keeps those in at least ``min_docs`` of its documents.  With V
    kept terms, N their occurrences in a group (lang, source) and n those of one
    term, its share is ``p = 1 + floor(10^9 (n + 2) / (N + 2 V))``; shares p and
    q diverge by ``floor((p - q)^2 / (p + q))``.  Part ``pair`` sums that over
    all kept terms, for every other source of the language.  Part ``term`` has
    the ``top`` terms of a group that diverge most from the language's share,
    among those that occur there and are above it.  All arithmetic is on whole
    numbers; ranks follow value, then the item's UTF-8 bytes.

    Work and memory of the pairs grow with the square of one language's sources, as the result does.

    Defined cases: null text, language and source count as empty; every row is a
    document, also one that repeats an id or a text; a group without terms has
    its pairs, with shares of no occurrences; a language without kept terms has
    pairs of value 0; texts are read whole, whatever their length, and a chunk
    without spaces can be as long; an empty table gives an empty result; other
    columns are ignored, whatever their names.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    groups, counts, terms = term_counts(rows, min_docs=min_docs)

    size = groups.select("lang").distinct().join(terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v")), "lang", "left")
    size = size.select("lang", F.coalesce("v", F.lit(0)).alias("v"))
    group = (groups.join(counts.groupBy("g").agg(F.sum("n").alias("all_n")), "g", "left").join(size, "lang")
             .select("lang", "source", "g", "v", F.coalesce("all_n", F.lit(0)).alias("all_n"))
             .withColumn("p0", _share(F.lit(0).cast("long"), F.col("all_n"), F.col("v"))))
    group = written(group, "audit-shares")

    shares = counts.join(group.select("g", "v", "all_n"), "g").select(
        "lang", "g", "term", "n", _share(F.col("n"), F.col("all_n"), F.col("v")).alias("p"))
    langs = group.groupBy("lang").agg(F.sum("all_n").alias("all_n"), F.first("v").alias("v"))
    whole = (counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).join(langs, "lang")
             .select("lang", "term", _share(F.col("n"), F.col("all_n"), F.col("v")).alias("q")))

    ranked = Window.partitionBy("g").orderBy(F.desc("value"), F.asc("item"))
    by_term = (shares.join(whole, ["lang", "term"]).filter("p > q")
               .select("g", F.col("term").alias("item"), _divergence(F.col("p"), F.col("q")).alias("value"))
               .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
               .join(group.select("lang", "source", "g"), "g").withColumn("part", F.lit("term")))

    sources = group.filter("v > 0").groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("g", "p0"))).alias("s"))
    dense = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("g", "p")).alias("here"))
             .join(sources, "lang").select("lang", F.col("s.g").alias("gs"), F.col("s.p0").alias("p0"), "here"))
    sums = (dense.mapInArrow(_pair_sums, "g bigint, h bigint, value bigint")
            .groupBy(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).agg(F.sum("value").alias("value")))
    sums = sums.unionByName(sums.select(F.col("h").alias("g"), F.col("g").alias("h"), "value"))
    other = group.select("lang", F.col("source").alias("item"), F.col("g").alias("h"))
    pairs = (group.select("lang", "source", "g").join(other, "lang").filter("g <> h")
             .join(sums, ["g", "h"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
             .withColumn("rank", F.row_number().over(ranked)).withColumn("part", F.lit("pair")))

    cols = ["lang", "source", "part", "item", "value", F.col("rank").cast(IntegerType()).alias("rank")]
    return pairs.select(*cols).unionByName(by_term.select(*cols))
