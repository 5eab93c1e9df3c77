"""The training-data operators against SQL, brute force and exact round trips."""

import base64
import hashlib
import math
import os
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN, path
from pyspark.sql import functions as F

import corpus_pipeline
from carestar.llm import exact_dedup as exact_dedup_module
from carestar.llm import jaccard_join, sql
from carestar.llm.bpe import bpe_decode, bpe_digests, bpe_encode
from carestar.llm.chat import chat_digests, format_chats, read_back, render_incrementally, turn_template
from carestar.llm.common import written
from carestar.llm.exact_dedup import drop_exact_copies, exact_dedup
from carestar.llm.graph import components
from carestar.llm.jaccard_join import bands, drop_near_copies, jaccard_components
from carestar.llm.lm_scores import lm_scores
from carestar.llm.mixing import mix_sources, take_mix
from carestar.llm.pii import find_personal_data
from carestar.llm.quality_rules import ablations, filter_quality, passes, rule_ledger
from carestar.llm.prefix_doubling import remove_repeats_by_doubling
from carestar.llm.queries import ORACLE_SQL, QUERIES
from carestar.llm.suffix_dedup import remove_repeats
from carestar.llm.token_counts import count_tokens, document_token_counts

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "conversations", "embeddings")

# nulls, ties, repeated rows, clashing columns; null ids twice
EDGE = [(1, None, None), (2, "", "a"), (3, "A b", "a"), (3, "A b", "a"), (4, "a B", None), (None, "a b", "b"),
        (None, None, "b"), (5, "é\U0001F600 x@y.zz +1 (017) 555-7713", "c"), (6, "word " * 30_000, "c"), (7, "word " * 30_000, "c")]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, s, "_", 0, True) for i, t, s in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, _norm string, size long, kept boolean")


@pytest.fixture(scope="module")
def none(edge):
    return edge.filter("false")


@pytest.fixture(scope="module")
def enc():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def canon(v):
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


def lines(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(canon(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert lines([tuple(r) for r in df.collect()], df.columns) == lines(cur.fetchall(), cols)


@pytest.mark.parametrize("operator", [exact_dedup, bpe_digests, document_token_counts, rule_ledger, mix_sources,
                                      jaccard_components, lm_scores, find_personal_data, remove_repeats])
def test_edges_and_empty_tables(edge, none, operator):
    assert operator(none).count() == 0
    got = operator(edge).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _, _ in EDGE)


def test_exact_dedup_ties_and_hot_texts(spark, edge):
    got = exact_dedup(edge, keep="max").collect()
    by = {(r.keep_id, r.group_size) for r in got}
    assert (4, 4) in by and (2, 3) in by and (7, 2) in by       # "a b", empty, long
    assert sum(r.kept for r in got) == len(by)
    many = spark.createDataFrame([(i, "Same" if i % 3 else f"t{i}") for i in range(6000)], "doc_id long, text string")
    hot = exact_dedup(many, keep="min").filter("group_size > 1").collect()
    assert len(hot) == 4000 and {r.keep_id for r in hot} == {1} and sum(r.kept for r in hot) == 1
    assert drop_exact_copies(many).count() == 2001
    assert sorted(drop_exact_copies(edge).columns) == sorted(edge.columns) and drop_exact_copies(edge).count() == len(by)


def test_exact_dedup_of_texts_that_share_their_beginning(spark):
    lead = "The same Beginning of Many pages, longer than a splitter. "
    texts = {i: lead + "x" * (i % 7) + ("Tail" if i % 3 else "tail") for i in range(300)} | {300: lead, 301: lead[:20], 302: None}
    low = {i: (t or "").lower() for i, t in texts.items()}
    ids = {t: [i for i in low if low[i] == t] for t in low.values()}
    got = exact_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), keep="max").collect()
    assert ({(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} ==
            {(i, max(ids[t]), len(ids[t]), i == max(ids[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in low.items()})


def test_exact_dedup_splitters_hold_no_whole_text(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(exact_dedup_module, "written", lambda df, name: plans.append(df) or df)
    exact_dedup(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"))
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"rangepartitioning\((\w+?)#\d+ ASC NULLS FIRST, (\w+?)#\w+ ASC NULLS FIRST, (\w+?)#", plan) == [
        ("_lead", "_hash", "_piece")]
    assert "hashpartitioning(_norm" not in plan and "hashpartitioning(_lead" not in plan


def test_chat_round_trip_and_rewrites(spark):
    talks = [(1, 0, "user", "\\### x: </turn>"), (1, 1, "assistant", "\\\\</turn>\n### user: "), (1, 1, "assistant", None),
             (1, None, None, "n"), (None, 0, "a:b\\", ""), (2, 5, "assistant", "</turn")]
    df = spark.createDataFrame(talks, "conv_id long, turn long, role string, text string")
    out = format_chats(df)
    got = {r.conv_id: read_back(r.formatted) for r in out.collect()}
    assert got == {1: [("", "n"), ("user", "\\### x: </turn>"), ("assistant", ""), ("assistant", "\\\\</turn>\n### user: ")],
                   None: [("a:b\\", "")], 2: [("assistant", "</turn")]}
    d = {r.conv_id: r for r in chat_digests(out).collect()}
    assert d[1].loss_sha256 == hashlib.sha256(b"\\\\</turn>\n### user: ").hexdigest() and d[1].n_turns == 4
    assert format_chats(df.filter("false")).count() == 0

    def only_last(turns):  # drops the text of all turns but the last
        return "".join(turn_template([(r, t if k == len(turns) - 1 else "")]) for k, (r, t) in enumerate(turns))
    assert render_incrementally([("u", "x"), ("a", "y"), ("u", "z")], only_last).rewrites == [1, 2]
    assert render_incrementally([("u", "x"), ("a", "y")], turn_template).rewrites == []


def test_bpe_equals_reference_and_round_trips(spark, enc):
    docs = [r for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    hard = [(-1, "a  b\n\n c\t "), (-2, "\U0001F469‍\U0001F680 ﷽ x" * 50), (-3, "<|endoftext|>"), (-4, "z" * 20_000), (-5, None)]
    df = spark.createDataFrame([*map(tuple, docs), *hard], "doc_id long, text string")
    want = {i: enc.encode_ordinary(t or "") for i, t in [*map(tuple, docs), *hard]}
    got = {r.doc_id: r for r in bpe_digests(df, with_ids=True).collect()}
    for i, ids in want.items():
        assert got[i].ids == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    texts = {i: t or "" for i, t in [*map(tuple, docs), *hard]}
    tokens = bpe_encode(df)
    assert {r.doc_id: bytes(r.text_bytes).decode() for r in bpe_decode(tokens).collect()} == texts
    for r in tokens.filter("doc_id < 0").collect():
        raw = texts[r.doc_id].encode()
        for i, a, b, c, d in zip(r.ids, r.byte_start, r.byte_start[1:], r.char_start, r.char_end):
            assert raw[a:b] in texts[r.doc_id][c:d].encode() and enc.decode_single_token_bytes(i) == raw[a:b]


def test_token_counts_across_blocks(spark, enc, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: len(enc.encode_ordinary(r.text or "")) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in document_token_counts(docs).collect()} == want
    p = str(tmp_path / "t.bin")
    np.array([1, 2, 9, 9, 3, 9, 4, 4, 4, 4, 4], "<u2").tofile(p)
    open(str(tmp_path / "e.bin"), "w").close()
    paths = spark.createDataFrame([(p,), (p,), (None,), (str(tmp_path / "e.bin"),)], "path string")
    for block in (2, 4, 6, 100):
        got = count_tokens(paths, end_id=9, block_bytes=block).orderBy("ordinal").collect()
        assert [(r.ordinal, r.n_tokens) for r in got] == [(0, 2), (1, 0), (2, 1), (3, 5)]


def test_ablations(spark):
    ledger = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "fail_bits long")
    got = {r.rule: (r.failed, r.only_failed, r.kept_without) for r in ablations(ledger, "base-1").collect()}
    assert got == {"few_words": (3, 2, 4), "repeated_words": (1, 0, 2)}


def test_mix_comes_near_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mix_sources(docs).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] / 2 + 1 for r in got)
    assert take_mix(docs).count() == mix_sources(docs).agg({"copies": "sum"}).first()[0]


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(docs, n, num, den):
    sets, up = [shingles(t, n) for _, t in docs], list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [(d, len(sets[i]), docs[find(i)][0]) for i, (d, _) in enumerate(docs)]


def test_near_copies_equal_brute_force(spark):
    rnd, words, docs = random.Random(11), [f"w{i}" for i in range(200)], []
    for _ in range(8):
        base = [rnd.choice(words) for _ in range(rnd.choice([6, 25, 60, 200]))]
        for _ in range(rnd.choice([3, 30])):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) // 18))):
                t[rnd.randrange(len(t))] = rnd.choice(words[:15])
            docs.append((len(docs), " ".join(t)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for n, num in ((3, 90), (5, 80)):
        got = sorted(tuple(r) for r in jaccard_components(df, words=n, threshold=(num, 100)).collect())
        assert got == brute_components(docs, n, num, 100)


@pytest.mark.parametrize("size", [12, 40, 150, 600])
def test_linked_sets_share_a_key(size):
    """Also where they agree in empty blocks alone: each other block has one difference."""
    band, rnd, tried = bands(80, 100), random.Random(size), 0
    k = band.of(size)
    most, group, _ = band.plan(k)
    blocks = most + 1 if group == 1 else -(-(most + 1) // (group - 1)) * group

    def shingle(b):
        wide = (1 << 32) // blocks
        return ((b << 32) // blocks + wide // 4 + rnd.randrange(wide // 2) << 32) + rnd.getrandbits(32)
    for _ in range(60):
        few = rnd.choice([0, 0, most // 9])
        both = band.edges[k + 1] - 1 - few
        differ = min(most, both // 4)
        used = rnd.sample(range(blocks), rnd.randint(-(-differ * 9 // 10), differ))
        x = {shingle(rnd.choice(used)) for _ in range(both)}
        y = set(x)
        for i, b in enumerate([*used, *rnd.choices(used, k=differ - len(used))]):
            (x if i < few else y).add(shingle(b))
        assert 100 * len(x & y) >= 80 * len(x | y)
        if band.of(len(x)) == k and band.of(len(y)) in (k, k + 1):
            tried += 1
            assert np.intersect1d(*(band.keys(np.array(sorted(z), np.uint64)) for z in (x, y))).size
    assert tried > 10


def test_key_buckets_grow_with_the_text(spark, monkeypatch):
    assert jaccard_join.bucket_count(0, 4) == 8 and jaccard_join.bucket_count(0, 200) == 200
    assert jaccard_join.bucket_count(jaccard_join.BUCKET_BYTES * 1000 + 1, 4) == 1001
    asked, index = [], jaccard_join._index
    monkeypatch.setattr(jaccard_join, "_index", lambda *a: asked.append(a[-1]) or index(*a))
    monkeypatch.setattr(jaccard_join, "BUCKET_BYTES", 1000)
    docs = [(i, " ".join(f"w{i // 2}_{k}" for k in range(100))) for i in range(60)]
    got = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert asked == [-(-sum(len(t) for _, t in docs) // 1000)] and asked[0] > 30
    assert {r.doc_id: r.component_id for r in got} == {i: i // 2 * 2 for i in range(60)}


def test_nodes_around_their_centres_take_turns(spark, monkeypatch):
    """The centres are dealt into rounds, and links between nodes of one round are all found."""
    assert [jaccard_join.rounds_for(*x) for x in ((0, 0), (7, 7), (8, 7), (70, 7), (10**6, 7))] == [1, 1, 2, 10, jaccard_join.ROUNDS]
    asked, seen, tokens = [], [], jaccard_join._tokens
    monkeypatch.setattr(jaccard_join, "rounds_for", lambda *x: asked.append(x) or 3)
    monkeypatch.setattr(jaccard_join, "_tokens", lambda around, *a: seen.append(around.count()) or tokens(around, *a))
    rnd, docs = random.Random(5), []
    for g in range(12):
        base = [f"g{g}_{k}" for k in range(120)]
        for v in range(6):
            # halves of one text: far from the others of the group, near each other
            t = base[:60] + [f"g{g}_{v}_{k}" for k in range(60)]
            for _ in range(2):
                t[rnd.randrange(60, 120)] = rnd.choice("xyz")
                docs.append((len(docs), " ".join(t)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in jaccard_components(df, words=5, threshold=(80, 100)).collect())
    assert got == brute_components(docs, 5, 80, 100)
    assert len(seen) == 3 and sum(seen) == asked[0][0] > 0


def test_keys_of_few_nodes_are_compared_by_sketches(spark, monkeypatch):
    """No set goes round a centre for them, and the result is that of the other way."""
    seen, tokens = [], jaccard_join._tokens
    monkeypatch.setattr(jaccard_join, "_tokens", lambda around, *a: seen.append(around.count()) or tokens(around, *a))
    docs = []
    for g in range(6):
        for v in range(2):
            # halves of one text: far from the others of the group, near each other
            t = [f"g{g}_{k}" for k in range(60)] + [f"g{g}_{v}_{k}" for k in range(60)]
            docs += [(len(docs) + i, " ".join(t[:100 + i] + ["x"] + t[101 + i:])) for i in range(2)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = lambda: sorted(tuple(r) for r in jaccard_components(df, words=5, threshold=(80, 100)).collect())
    want = brute_components(docs, 5, 80, 100)
    assert got() == want and sum(seen) == 0
    monkeypatch.setattr(jaccard_join, "PAIRED", 0)
    assert got() == want and sum(seen) > 0


def test_a_bitmap_rules_out_rows_that_are_not_wanted(spark, monkeypatch):
    rows = spark.range(20_000).withColumn("_h", F.xxhash64("id"))
    wanted = rows.filter("id % 50 = 0").select("_h")
    inside = [r.id for r in jaccard_join._marked(rows, wanted).filter("_in").collect()]
    assert {i for i in inside if i % 50 == 0} == set(range(0, 20_000, 50)) and 400 <= len(inside) < 1000
    assert not jaccard_join._marked(rows, wanted.filter("false")).filter("_in").count()
    monkeypatch.setattr(jaccard_join, "MOST_BITS", 1 << 15)      # more members than bits: nobody is lost
    everyone = jaccard_join._marked(rows, rows.select("_h"))
    assert everyone.count() == everyone.filter("_in").count() == 20_000


def test_exact_dedup_moves_a_text_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(exact_dedup_module, "written", lambda df, name: plans.append(df) or df)
    drop_exact_copies(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string"))
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert re.search(r" _own#\d+[,\]]", plan[at + 1]) and not re.search(r" _norm#\d+[,\]]", plan[at + 1])


def test_a_finished_write_leaves_no_shuffle_files(spark):
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {n for d in dirs for _, _, names in os.walk(d) for n in names if n.startswith("shuffle_")}
    written(spark.range(3), "before")
    old = files()
    back = written(spark.range(1000).repartition(3), "shuffled")
    end = time.time() + 10
    while files() - old and time.time() < end:
        time.sleep(0.2)
    assert not files() - old
    assert back.count() == 1000


def test_exact_dedup_writes_only_rows_that_stay(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(exact_dedup_module, "written", lambda *a: tables.append(written(*a)) or tables[-1])
    docs = spark.createDataFrame([(i, f"text {i % 30}") for i in range(300)], "doc_id long, text string")
    assert sorted(r.doc_id for r in drop_exact_copies(docs).collect()) == list(range(30))
    assert [t.count() for t in tables] == [30]


def test_pipeline_deletes_what_no_stage_reads_any_more(spark, monkeypatch):
    tables = []
    monkeypatch.setattr(corpus_pipeline, "written", lambda *a: tables.append(written(*a)) or tables[-1])
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, lambda spark, docs, sf_dir: docs.filter("doc_id >= 0")) for n in "abc"])
    there = lambda t: os.path.exists(t.written_at.removeprefix("file:"))
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id >= 0").count() > 0
    assert [there(t) for t in tables] == [False, True]


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(100))
    other = " ".join(f"v{i}" for i in range(100))
    rows = [(1, text, "a"), (None, text + " x", "b"), (None, other, "c"), (None, other + " y", "d"), (2, "lone words", "e"),
            (3, "one more text", "f"), (3, "one more text", "g"), (4, "s " + text[5:], "h"), (None, "not linked", "i"),
            (5, None, "j"), (5, "", "k"), (6, "q " + text.upper().replace("W", "z"), "l"), (6, text.replace("w", "z"), "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = drop_near_copies(df)
    assert got.columns == df.columns
    stay = [r.source for r in got.collect()]
    groups = ["abh", "cd", "e", "fg", "i", "j", "k", "lm"]
    assert sorted(next(g for g in groups if s in g) for s in stay) == groups and "a" in stay
    alone = drop_near_copies(df.filter("source NOT IN ('f', 'g')")).collect()
    assert sorted(next(g for g in groups if r.source in g) for r in alone) == [g for g in groups if g != "fg"]


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 3), (5, 5), (7, 8), (None, 4)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {1: 1, 2: 1, 3: 1, 9: 1, 7: 7, 8: 7}


def test_lm_base_and_held_out_gain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in lm_scores(docs, tile_bytes=400_000).collect()}
    count, tokens = Counter(), {}
    for i, t in docs.collect():
        tokens[i] = [*(t or "").encode().lower().split(), 0]
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(tokens[i])
    n, v = sum(count.values()), len(count)
    for i, t in tokens.items():
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(t), sum(x in count for x in t), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in t))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_order(spark):
    # the word after "a" or "b" tells nothing; with the word before it is certain
    rnd, docs = random.Random(5), []
    for i in range(400):
        docs.append((i, " ".join(rnd.choice(["x a one", "y a two", "x b two", "y b one"]) for _ in range(20))))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    score = {k: {r.doc_id: r.score for r in (lm_scores(df, order=k) if k else lm_scores(df)).collect()} for k in (0, 1, 2, 3, 4)}
    total = {k: sum(v.values()) for k, v in score.items()}
    assert total[0] == pytest.approx(total[3]) and total[1] < total[2] < total[3]
    # about one bit less for each of 20 words
    assert (total[3] - total[2]) / 400 == pytest.approx(20 * math.log10(2), rel=0.1)
    assert total[4] == pytest.approx(total[3], rel=0.05)


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) * (2 - (k + 1) % 2) for k, c in enumerate(reversed(re.sub("[^0-9]", "", m[0])))]
        if 14 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in d) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_personal_data_base_and_bootstrap(spark):
    hard = ["a@b.c_d@e.f", "x" * 3000 + "@b.co", "a@b@c.d", "1.2.3.4.5.6.7.8", "01.002.3.4", "4111-1111-1111-1111 5",
            "1-2-" * 3000, "+1+1+1234567890", "\x01a@b.c\x04\x05", "a.b." * 3000 + "@x.y", None]
    hard += [f"call hotline: +44 20 7946 0{i:03d} now" for i in range(12)] + ["call hotline: 0044-2079/46"]
    docs = list(enumerate(hard)) + [(100 + i, r.text) for i, r in enumerate(
        spark.read.parquet(f"{SF}/documents.parquet").collect())]
    got = {r.doc_id: r for r in find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, t in docs:
        assert got[i].base_sha256 == hashlib.sha256(base_spans(t or "").encode()).hexdigest()
    assert got[len(hard) - 1].spans == "phone:14:26"


def test_personal_data_unknown_forms_of_each_kind(spark):
    luhn = [f"41111111111111{i:02d}" for i in range(100)]
    luhn = [c for c in luhn if sum(sum(divmod(int(x) * (2 - (k + 1) % 2), 10)) for k, x in enumerate(c[::-1])) % 10 == 0]
    seeds = [t for i in range(60) for t in (f"call hotline: +44 20 7946 0{i:03d} now", f"write contact: joe{i}@example.org today",
                                            f"the server: 10.0.0.{i} is up", f"paid card: {luhn[i % len(luhn)]} ok")]
    new = {"phone": ["hotline: [020 7946 0018] now", "hotline: [0044 2079 460018], now", "hotline: [(020) 7946-0018].",
                     "hotline: [020 7946 (0018)] x", "hotline: [911]!", "hotline: [7734] 10.0.0.1", "hotline:[020 - 7946] a"],
           "email": ["contact: [joe[at]example.org] now", "contact: [admin@localhost], now", "contact: <[admin@localhost]>",
                     "contact: [joe dot smith at example dot org].", "contact: [joe (at) example (dot) org] now",
                     "contact: [joe @ example . org]", "contact: [joe_at_example_dot_org]", "contact: [user1234] now"],
           "ip": ["server: [1.2.3] up", "server: [fe80::ab] up", "server: [10 dot 0 dot 0 dot 1] up", "server: [10[.]0[.]0[.]1] up"],
           "card": ["card: [4111 1111 1111 1112] ok", "card: [12-34] ok"]}
    docs, want = list(enumerate(seeds)), {}
    for kind, texts in new.items():
        for t in texts:
            start, end = t.index("["), t.rindex("]") - 1
            want[len(docs)] = f"{kind}:{start}:{end}"
            docs.append((len(docs), t[:start] + t[start + 1:end + 1] + t[end + 2:]))
    # of another kind than the pattern's, or after no confident pattern
    for t in ("hotline: admin@localhost", "contact: 911 now", "then 020 7946 0018"):
        want[len(docs)] = ""
        docs.append((len(docs), t))
    got = {r.doc_id: r.spans for r in find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i, spans in want.items():
        assert spans in got[i].split(",") if spans else got[i] == "", (docs[i], got[i])


def test_repeats_equal_brute_force(spark):
    rnd, docs, length = random.Random(3), [], 40
    parts = ["".join(rnd.choice("abcdefghé ") for _ in range(rnd.randint(30, 200))) for _ in range(6)]
    for i in range(80):
        t = "".join(rnd.choice([rnd.choice(parts), "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 90))),
                                "ab" * rnd.randint(0, 40)]) for _ in range(rnd.randint(0, 5)))
        docs.append((i, docs[-1][1] if i % 9 == 8 else t))
    docs += [(80, None), (81, "z" * 300), (None, "z" * 45), (82, "")]
    raw = [(i, (t or "").encode()) for i, t in docs]
    often = Counter(b[p:p + length] for _, b in raw for p in range(len(b) - length + 1))
    want = []
    for i, b in raw:
        gone = bytearray(len(b) + 1)
        for p in range(len(b) - length + 1):
            if often[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        want.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = remove_repeats(df, length=length, tile_bytes=4000).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    got = remove_repeats_by_doubling(df, length=length).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_doubling_edges_and_agreement(spark, edge, none):
    assert remove_repeats_by_doubling(none).collect() == []
    clash = edge.withColumn("pos", edge.size).withColumn("base", edge.size).withColumn("rank", edge.size)
    assert sorted(map(str, remove_repeats_by_doubling(clash).collect())) == sorted(map(str, remove_repeats(clash).collect()))


def test_pipeline_equals_brute_force(spark, enc):
    con = duckdb.connect()
    con.execute(f"CREATE TABLE documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.OP5}) WHERE kept").fetchall()}
    texts = {i: t for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall() if i in kept}
    first = {}
    for i in sorted(texts):
        first.setdefault(texts[i].encode().lower(), i)
    docs = sorted((i, texts[i]) for i in first.values())
    lead = {i for i, _, c in brute_components(docs, 5, 80, 100) if i == c}
    con.execute(f"DELETE FROM documents WHERE doc_id NOT IN ({','.join(map(str, lead))})")
    want = Counter()
    for i, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({sql.OP6})").fetchall():
        want[i, len(enc.encode_ordinary(texts[i]))] += taken // size
    got = Counter((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == +want


def test_filters_keep_columns_of_any_name(spark):
    names = ["doc_id", "text", "source", "_below", "base", "_copy", "row", "a.b", "source_size"]
    rows = [(1, "one two three", "x", 5, 6, False, "r", "d", 9), (2, None, None, 5, 6, False, "r", "d", 9),
            (None, "", "x", 5, 6, None, "r", "d", 9), (4, "word " * 5000, "y", 5, 6, False, None, None, 9)]
    schema = "doc_id long, text string, source string, _below long, base long, _copy boolean, row string, `a.b` string, source_size long"
    df = spark.createDataFrame(rows, schema)
    taken = {r["doc_id"]: r["copies"] for r in mix_sources(df).collect()}
    mixed = take_mix(df)
    assert mixed.columns == names
    want = Counter({r: taken[r[0]] for r in rows if taken[r[0]]})
    assert Counter(tuple(r) for r in mixed.collect()) == want
    assert take_mix(df.limit(0)).collect() == []
    for keep, left in ((drop_exact_copies, {1, 2, 4}), (filter_quality, set())):
        out = keep(df)
        assert out.columns == names
        assert {r["doc_id"] for r in out.collect()} == left


def test_filter_quality_keeps_what_the_ledger_passes(spark):
    good = " ".join(f"word{i} and text" for i in range(20))
    rows = [(1, good), (1, good), (None, good), (2, None), (3, ""), (4, "same " * 400), (5, "short text"), (6, good + " x" * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    passed = Counter(r["doc_id"] for r in rule_ledger(df).filter(passes("web-1")).collect())
    got = filter_quality(df)
    assert Counter(r["doc_id"] for r in got.collect()) == passed == Counter([1, 1, None, 6])
    assert filter_quality(df.limit(0)).collect() == []


def test_token_files_refuse_ids_they_cannot_hold(spark, enc):
    df = spark.createDataFrame([(1, "a word"), (2, None)], "doc_id long, text string")
    with pytest.raises(ValueError):
        document_token_counts(df, end_id=70000)
    ids = enc.encode_ordinary("a word")
    with pytest.raises(Exception, match="not the end id"):
        document_token_counts(df, end_id=ids[0]).collect()
    clash = df.selectExpr("*", "1 AS path", "2 AS ordinal", "3 AS n_tokens")
    assert {r["doc_id"]: r["n_tokens"] for r in document_token_counts(clash).collect()} == {1: len(ids), 2: 0}


@pytest.mark.parametrize("kind", ["smallint", "decimal(20,0)"])
def test_repeats_with_ids_of_any_type(spark, kind):
    passage = "".join(chr(97 + i * i % 26) for i in range(401))
    rows = [(1, "x" + passage), (2, "y" + passage + "z"), (None, "short"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"CAST(doc_id AS {kind}) AS doc_id", "text")
    got = {r["doc_id"] and int(r["doc_id"]): (r["n_bytes"], r["n_removed"]) for r in remove_repeats(df).collect()}
    brute = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    starts = Counter(t[k:k + 400] for _, t in texts for k in range(len(t) - 399))
    for i, t in texts:
        gone = {b for k in range(len(t) - 399) if starts[t[k:k + 400]] > 1 for b in range(k, k + 400)}
        brute[i] = (len(t), len(gone))
    assert got == brute and brute[1][1] > 400
