"""Deleted interpolation against a plain model; tiles of any size, repeated rows, id types, large totals."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from carestar.llm import lm_scores as L
from carestar.llm.packing import pack, unpack

FINE = L.FINE


def brute(docs, order):
    tokens = [[w.lower() for w in t.split()] + ["</s>"] for _, t in docs]
    fold = [zlib.crc32(str(i).encode()) % 7 for i, _ in docs]

    def gram(ts, i, k):
        return tuple((["<s>"] * (k - 1) + ts)[i:i + k])
    kept, total = Counter(), Counter()
    for ts, f in zip(tokens, fold):
        if f == 2:
            continue
        got = Counter(gram(ts, i, k) for i in range(len(ts)) for k in range(1, order + 1))
        total.update(got)
        if f != 3:
            kept.update(got)

    def estimate(ts, i, n):
        seen = [n[gram(ts, i, k)] for k in range(1, order + 1)]
        context = [n[gram(ts, i - 1, k)] if i else n["</s>",] for k in range(1, order)]
        b = 0
        for k, c in enumerate(context):
            if c:
                b = k * L.BUCKETS + min(int(math.log2(c)) + 1, L.BUCKETS - 1)
        return seen, context, b
    n_kept, v_kept = (sum(c for g, c in kept.items() if len(g) == 1), sum(len(g) == 1 for g in kept))
    n, v = (sum(c for g, c in total.items() if len(g) == 1), sum(len(g) == 1 for g in total))
    bs, parts = [], []
    for ts, f in zip(tokens, fold):
        for i in range(len(ts)) if f == 3 else ():
            seen, context, b = estimate(ts, i, kept)
            p = [2 ** (round(FINE * math.log2(s / max(c, 1) if k else s)) / FINE) if s else 0
                 for k, (s, c) in enumerate(zip(seen, [1, *context]))]
            bs.append(b)
            parts.append([p[0] / max(1, n_kept), *(min(x, 1.0) for x in p[1:]), 1 / (v_kept + 1)])
    weights = L.learn_weights(np.array(bs, np.int64), np.array(parts).reshape(-1, order + 1), np.ones(len(bs)))
    out = {}
    for (i, _), ts in zip(docs, tokens):
        s = 0.0
        for k in range(len(ts)):
            seen, context, b = estimate(ts, k, total)
            p = [seen[0] / max(n, 1), *(x / max(c, 1) for x, c in zip(seen[1:], context)), 1 / (v + 1)]
            s += math.log10(sum(a * w for a, w in zip(p, weights[b])))
        out[i] = s
    return out, n


@pytest.mark.parametrize("order, tile_bytes", [(1, 1 << 20), (3, 1 << 20), (3, 400)])
def test_scores_equal_a_plain_model(spark, order, tile_bytes):
    rng = random.Random(order)
    docs = [(i, " ".join(rng.choice("abcdefgh") + rng.choice(["", "x", "Y"]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    want, n = brute(docs, order)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = L.lm_scores(df, order=order, tile_bytes=tile_bytes).collect()
    assert {r.doc_id for r in got} == set(want) and {r.train_tokens for r in got} == {n}
    assert max(abs(r.score - want[r.doc_id]) for r in got) < 1e-6


def test_repeated_rows_fill_several_tiles_and_any_id_type(spark):
    same = spark.createDataFrame([(5, "the same text")], "doc_id int, text string").selectExpr(
        "doc_id", "text", "explode(sequence(1, 4000)) as k").select("doc_id", "text")
    for kind in ("smallint", "decimal(12,0)", "string"):
        df = same.withColumn("doc_id", same.doc_id.cast(kind))
        got = L.lm_scores(df, tile_bytes=2000)
        assert got.schema["doc_id"].dataType == df.schema["doc_id"].dataType
        rows = got.collect()
        assert len(rows) == 4000 and len({r.score for r in rows}) == 1 and rows[0].train_tokens == 16_000
    plain = spark.createDataFrame([(i, "x y") for i in range(9)], "doc_id long, text string")
    assert L._steady(plain) and not L._steady(plain.distinct())


def test_totals_beyond_32_bits():
    big = np.array([1, 1 << 40, 3], np.uint64)
    assert unpack(pack(big), np.uint64).tolist() == big.tolist()
    keys = np.array([2, 8, 11], np.uint64)
    request = {"bucket": [0, 0], "tile": [0, 1], "keys": [pack(keys, ordered=True)] * 2,
               "kept": [pack(np.array([(1 << 32) - 1] * 3, np.uint32))] * 2, "deleted": [pack(np.zeros(3, np.uint32))] * 2}
    import pyarrow as pa
    got = L._answer()(pa.table(request))
    assert unpack(got["total"][0].as_py(), np.uint64).tolist() == [2 * ((1 << 32) - 1)] * 3
