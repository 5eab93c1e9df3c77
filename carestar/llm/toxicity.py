"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

Texts are compared by their fragments (words, and runs of single letters joined).
The kernel of two fragments counts the three-letter subsequences they share; a
subsequence may have gaps and weighs less the more letters it skips, so an insult
with inserted characters still shares most of its weight.  Landmark fragments span
the feature space (Nyström); a support vector machine is trained there on labelled
sentences.  A toxic sentence needs one toxic fragment, a clean one has none: of a
toxic sentence the fragment that scores highest counts (chosen anew after each
fit), of a clean sentence all do.

Kernel, landmarks and weights collapse into one weight for each subsequence of a
landmark, so a distinct fragment is scored with a few look-ups per letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.session import ship_package

from .common import written

FOLDS, HELD_OUT = 5, 0

# Letters between the first and the last of a subsequence, and the weight of each one skipped
SPAN, DECAY = 6, 0.8
_STEPS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]
_WEIGHT = {j: DECAY ** (j - 2) for j in range(2, SPAN)}

# Longer fragments are compared in overlapping windows
WINDOW = 24
# A sentence without an end is cut after so many words
SENTENCE_WORDS = 40

# Bounds of what the classifier is fitted on: documents of each class, sentences of each class, landmarks
SAMPLE_DOCS, SAMPLE_SENTENCES, LANDMARKS = 3000, 6000, 320

# Log-likelihood ratio from which a fragment that no clean sentence holds is evidence of toxicity
EVIDENCE = 10.0

_EDGES = "^", "$"
_INNER = re.compile(r"[\W_]+")
_SENTENCES = re.compile(r"[^.!?\n]+[.!?\n]*")


def pieces(word: str) -> list[str]:
    """The fragments of one lower-cased word: its core, the core's letters alone, long ones in windows."""
    core = word.strip("\"'()[]{}<>.,;:!?*_-–—…«»„“”‚‘’")
    out = [core] if core else []
    letters = _INNER.sub("", core)
    if letters and letters != core:
        out.append(letters)
    return [x[at:at + WINDOW] for x in out for at in range(0, max(1, len(x) - WINDOW // 2), WINDOW // 2)]


def spelled(words: list[str]) -> list[str]:
    """Runs of single letters, written with spaces between, as one fragment each."""
    out, run = [], ""
    for w in [*words, ""]:
        core = _INNER.sub("", w)
        if len(core) == 1:
            run += core
            continue
        if len(run) > 1:
            out += pieces(run)
        run = ""
    return out


def fragments(words: list[str], left: str = "") -> dict[str, str]:
    """The fragments of a sentence's lower-cased words, with the word before each (of its first place)."""
    out: dict[str, str] = {}
    for before, w in zip([left, *words], words):
        for p in pieces(w):
            out.setdefault(p, before)
    for p in spelled(words):
        out.setdefault(p, left)
    return out


def sentences(text: str) -> list[list[str]]:
    """Lower-cased words by sentence, cut where one has more than ``SENTENCE_WORDS``."""
    out = []
    for s in _SENTENCES.findall(text.lower()):
        words = s.split()
        out += [words[at:at + SENTENCE_WORDS] for at in range(0, len(words), SENTENCE_WORDS)]
    return out


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the marked fragments, each followed by ``SPAN`` zeros, and their lengths."""
    pad = "\0" * SPAN
    marked = [f"{_EDGES[0]}{t}{_EDGES[1]}" for t in texts]
    points = np.frombuffer(pad.join([*marked, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    return points, np.array([len(m) for m in marked], np.int64)


def _norms(lengths: np.ndarray) -> np.ndarray:
    """Length of a fragment's feature vector, as if its subsequences were distinct."""
    total = sum(np.maximum(lengths - j, 0) * _WEIGHT[j] ** 2 for _, j in _STEPS)
    return np.sqrt(np.maximum(total, 1.0))


@dataclass
class Weights:
    """A weight for each subsequence: ``value[pair_row[letter a, letter b], letter c]``; row and letter 0 weigh nothing."""

    letters: str
    pair_row: np.ndarray
    value: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    _ids: np.ndarray | None = field(default=None, repr=False)

    def score(self, texts: list[str]) -> np.ndarray:
        """The decision value of every fragment."""
        if not texts:
            return np.zeros(0)
        if self._ids is None:
            self._ids = np.zeros(0x110000, np.int32)
            self._ids[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
        points, lengths = _flat(texts)
        c = self._ids[points]
        total = np.zeros(len(c), np.float32)
        tail = len(c) - SPAN
        for i in range(1, SPAN - 1):
            rows = self.pair_row[c[:tail], c[i:tail + i]]
            at = np.flatnonzero(rows)
            rows = rows[at]
            for j in range(i + 1, SPAN):
                total[at] += self.value[rows, c[at + j]] * np.float32(_WEIGHT[j])
        starts = np.cumsum(lengths + SPAN) - lengths - SPAN
        return np.add.reduceat(total.astype(np.float64), starts) / _norms(lengths) + self.bias

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -500, 500)))


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``owner, key, weight``: the normalised features; a key packs three code points."""
    points, lengths = _flat(texts)
    points = points.astype(np.uint64)
    owner_of = np.repeat(np.arange(len(texts)), lengths + SPAN)
    scale = 1 / _norms(lengths)
    owner, key, weight = [], [], []
    for i, j in _STEPS:
        a, b, c = points[:len(points) - j], points[i:len(points) - j + i], points[j:]
        at = np.flatnonzero((a > 0) & (b > 0) & (c > 0) & (owner_of[:len(a)] == owner_of[j:]))
        owner.append(owner_of[at])
        key.append((a[at] << 42) | (b[at] << 21) | c[at])
        weight.append(np.full(len(at), _WEIGHT[j]) * scale[owner_of[at]])
    return np.concatenate(owner), np.concatenate(key), np.concatenate(weight)


class _Landmarks:
    """Kernel of any fragments with the landmarks, by a dense table over the landmarks' subsequences."""

    def __init__(self, texts: list[str]):
        owner, key, weight = _features(texts)
        self.texts = texts
        self.keys, at = np.unique(key, return_inverse=True)
        self.table = np.zeros((len(self.keys) + 1, len(texts)))
        np.add.at(self.table, (at, owner), weight)
        own, vectors = np.linalg.eigh(self.kernel(texts))
        good = own > own[-1] * 1e-8
        self.root = vectors[:, good] / np.sqrt(own[good])

    def kernel(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.texts)))
        for start in range(0, len(texts), 2000):
            owner, key, weight = _features(texts[start:start + 2000])
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            owner, at, weight = owner[known] + start, at[known], weight[known]
            cell, where = np.unique(owner * len(self.keys) + at, return_inverse=True)
            values = np.bincount(where, weight, len(cell))
            rows, cols = np.divmod(cell, len(self.keys))
            first = np.flatnonzero(np.diff(rows, prepend=-1))
            for lo in range(0, len(first), 200):
                a, b = first[lo], first[lo + 200] if lo + 200 < len(first) else len(cell)
                part = np.add.reduceat(self.table[cols[a:b]] * values[a:b, None], first[lo:lo + 200] - a, axis=0)
                out[rows[first[lo:lo + 200]]] = part
        return out

    def map(self, texts: list[str]) -> np.ndarray:
        return self.kernel(texts) @ self.root

    def collapse(self, w: np.ndarray, bias: float) -> Weights:
        """One weight for each subsequence of a landmark."""
        value = self.table[:-1] @ (self.root @ w)
        a, b, c = ((self.keys >> np.uint64(s) & np.uint64(0x1FFFFF)).astype(np.int64) for s in (42, 21, 0))
        points = np.unique(np.concatenate([a, b, c]))
        a, b, c = (np.searchsorted(points, x) + 1 for x in (a, b, c))
        pairs, row = np.unique(a * (len(points) + 1) + b, return_inverse=True)
        pair_row = np.zeros((len(points) + 1, len(points) + 1), np.int32)
        pair_row[pairs // (len(points) + 1), pairs % (len(points) + 1)] = np.arange(1, len(pairs) + 1)
        table = np.zeros((len(pairs) + 1, len(points) + 1), np.float32)
        table[row + 1, c] = value
        return Weights("".join(map(chr, points)), pair_row, table, bias)


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        return float(v @ ridge @ v / 2 + (cost * np.maximum(1 - y * (x @ v), 0) ** 2).sum())
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xs, cs = x[on], cost[on]
        gradient = ridge @ w + 2 * xs.T @ (cs * (xs @ w - y[on]))
        step = np.linalg.solve(ridge + 2 * xs.T @ (xs * cs[:, None]), gradient)
        size, at = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > at:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def _sigmoid(f: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, fitted with smoothed targets."""
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.column_stack([f, np.ones(len(f))]), np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve(x.T @ (x * np.maximum(p * (1 - p), 1e-9)[:, None]) + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * w)
        w = w - step / max(1.0, float(np.abs(step).max()) / 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def _disguises(text: str) -> list[str]:
    """A fragment with one character inserted, doubled or starred out in any inner place."""
    inner = range(1, len(text))
    return [*(text[:k] + x + text[k:] for k in inner for x in "qx"), *(text[:k] + text[k - 1] + text[k:] for k in inner),
            *(text[:k] + "*" + text[k + 1:] for k in inner[:-1] if len(text) > 4)]


def fit(toxic: list[list[str]], evidence: dict[str, float], clean: list[list[str]],
        landmarks: int = LANDMARKS, rounds: int = 4) -> Weights:
    """The machine from toxic sentences, clean sentences (both as fragments) and the evidence of fragments.

    The first fit takes the fragments with evidence as toxic; after it, those of
    them that score above zero and the best one of every toxic sentence that has none.
    """
    negative = sorted({f for s in clean for f in s})
    clean_words = set(negative)
    chosen, hard = dict(evidence), []
    for _ in range(rounds):
        positive = sorted(chosen, key=lambda f: (-chosen[f], f))
        # landmarks: the positive fragments of most weight, the negative ones nearest to them, an even choice of others
        near = positive[:landmarks // 2]
        step = max(1, len(negative) // max(1, landmarks // 4))
        marks = _Landmarks(sorted({*near, *hard[:landmarks // 4], *negative[::step][:landmarks // 4]}))
        disguised = sorted({d for f in near for d in _disguises(f)} - clean_words)
        texts = positive + disguised + negative
        y = np.concatenate([np.ones(len(positive) + len(disguised)), -np.ones(len(negative))])
        cost = np.concatenate([np.full(len(positive), 10.0), np.full(len(disguised), 1.0), np.ones(len(negative))])
        weights = marks.collapse(*_svm(marks.map(texts), y, cost))
        at_negative = weights.score(negative)
        hard = [negative[k] for k in np.argsort(-at_negative, kind="stable")[:landmarks // 4] if at_negative[k] > -1]
        known = sorted({f for s in toxic for f in s} | set(evidence))
        value = dict(zip(known, weights.score(known)))
        again = {f: e for f, e in evidence.items() if value[f] > 0}
        for s in toxic:
            best = max(s, key=lambda f: (value[f], f))
            if best not in again and best not in clean_words and value[best] > -0.5:
                again[best] = 0.0
        if not again:
            break
        chosen = again
    return weights


def _token_scores(tokens: list[str], weights: Weights) -> np.ndarray:
    """The best fragment's value for each lower-cased word; words without a fragment get minus infinity."""
    parts = [pieces(t) for t in tokens]
    sizes = np.array([len(p) for p in parts], np.int64)
    out = np.full(len(tokens), -np.inf)
    flat = [x for p in parts for x in p]
    if flat:
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        out[sizes > 0] = np.maximum.reduceat(weights.score(flat), starts)
    return out


# Words whose values a worker keeps
HELD_WORDS = 400_000


def _score_batches(weights: Weights, keep: list[str]):
    """``keep`` columns and ``decision``: the highest value of a text's fragments, null without any."""
    weights = replace(weights, _ids=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .bpe import _slices

        held: dict[str, float] = {}
        for batch in batches:
            for part in _slices(batch):
                lists = pc.ascii_split_whitespace(pc.utf8_lower(part.column("text")))
                coded = lists.flatten().dictionary_encode()
                code, doc = coded.indices.to_numpy(), pc.list_parent_indices(lists).to_numpy()
                words = coded.dictionary.to_pylist()
                if len(held) > HELD_WORDS:
                    held = {}
                new = [w for w in words if w not in held]
                held.update(zip(new, _token_scores(new, weights).tolist()))
                best = np.full(part.num_rows, -np.inf)
                if len(code):
                    value = np.array([held[w] for w in words])[code]
                    starts = np.flatnonzero(np.diff(doc, prepend=-1))
                    best[doc[starts]] = np.maximum.reduceat(value, starts)
                    # letters written apart: runs of words with one letter
                    single = np.array([len(_INNER.sub("", w)) == 1 for w in words])[code]
                    at = np.flatnonzero(single)
                    joins = (np.diff(at) == 1) & (doc[at[1:]] == doc[at[:-1]]) if len(at) else np.zeros(0, bool)
                    for run_at in np.split(at, np.flatnonzero(~joins) + 1):
                        if len(run_at) > 1:
                            found = spelled([words[c] for c in code[run_at]])
                            best[doc[run_at[0]]] = max(best[doc[run_at[0]]], float(weights.score(found).max()))
                known = np.isfinite(best)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in keep], pa.array(np.where(known, best, 0.0), pa.float64(), mask=~known)],
                    names=[*keep, "decision"])

    return run


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")


def _sample(docs: DataFrame, labels: DataFrame, sample_docs: int) -> DataFrame:
    """``doc, toxic, part, text`` of at most ``sample_docs`` training documents of each class, by hash order of their ids."""
    known = (labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
             .filter(fold(F.col("doc_id")) != HELD_OUT)
             .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
             .withColumn("h", F.sha2(F.concat(F.lit("toxicity:"), F.col("doc_id").cast("string")), 256)))
    picked = [known.filter(F.col("toxic") == t).orderBy("h").limit(sample_docs) for t in (0, 1)]
    # at most 2 * sample_docs ids
    ids = F.broadcast(picked[0].unionByName(picked[1]).select("doc_id", "toxic", "h"))
    return written(docs.join(ids, "doc_id").select(
        "h", "toxic", (F.substring("h", 1, 1) < "b").alias("fits"), "text"), "toxicity-sample")


def _sentence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            parts, lefts, last = [], [], ""
            for words in sentences(r["text"]):
                found = fragments(words, last)
                last = words[-1]
                if found:
                    parts.append(list(found))
                    lefts.append(list(found.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["h"]] * len(parts), pa.string()), pa.array([r["toxic"]] * len(parts), pa.int32()),
                 pa.array(parts, pa.list_(pa.string())), pa.array(lefts, pa.list_(pa.string()))],
                names=["h", "toxic", "parts", "lefts"])


def _part_scores(weights: Weights):
    weights = replace(weights, _ids=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), pa.array(weights.score(batch.column("part").to_pylist()))], names=["part", "f"])

    return run


def train(docs: DataFrame, labels: DataFrame, *, sample_docs: int = SAMPLE_DOCS, sample_sentences: int = SAMPLE_SENTENCES,
          landmarks: int = LANDMARKS) -> Weights | None:
    """The classifier of ``docs(doc_id, text)`` with ``labels(doc_id, toxic)``; None if a class has no sentence.

    Fitted on bounded samples, by hash order: ``sample_docs`` documents of each
    class, ``sample_sentences`` sentences of each class, ``landmarks`` fragments.
    Of a toxic document the sentence counts whose best fragment speaks most for
    toxicity: it is in many different places of toxic texts and few clean ones.  About
    a third of the documents is left out of the fit and sets the probabilities.
    """
    ship_package(docs.sparkSession)
    sample = _sample(docs, labels, sample_docs)
    sents = written(sample.filter("fits").select("h", "toxic", "text")
                    .mapInArrow(_sentence_rows, "h string, toxic int, parts array<string>, lefts array<string>"),
                    "toxicity-sentences")
    # near copies of a document repeat its fragments after the same words: count different places
    places = (sents.select("toxic", F.explode(F.arrays_zip("parts", "lefts")).alias("p"))
              .groupBy(F.col("p.parts").alias("part"), F.col("p.lefts").alias("left")).agg(F.min("toxic").alias("toxic")))
    parts = written(places.groupBy("part").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")),
                    "toxicity-parts")
    share = parts.agg(F.try_divide(F.sum("t"), F.sum(F.col("t") + F.col("c")))).first()[0]
    if not share or share == 1:
        return None
    # try_divide: the filter below lets the planner put c = 0 in here before it has dropped the rows with t = 0
    ratio = F.try_divide(F.col("t"), (F.col("t") + F.col("c")) * F.lit(float(share)))
    evidence = parts.select("part", "c", (F.col("t") * F.when(ratio > 1, F.log(ratio)).otherwise(0)).alias("e"))
    strong = {r.part: r.e for r in evidence.filter((F.col("e") >= EVIDENCE) & (F.col("c") == 0))
              .orderBy(F.desc("e"), "part").limit(sample_sentences).collect()}
    best = (sents.filter("toxic = 1").select("h", "parts", F.explode("parts").alias("part")).join(evidence, "part")
            .groupBy("h").agg(F.max(F.struct("e", "part", "parts")).alias("b")).orderBy("h").limit(sample_sentences))
    toxic = [(r.b.part, r.b.e, sorted(r.b.parts)) for r in best.collect()]
    if not strong:
        strong = {part: e for part, e, _ in toxic}
    mixed = F.sha2(F.concat_ws(" ", "h", F.concat_ws(" ", "parts")), 256)
    clean = [sorted(r.parts) for r in sents.filter("toxic = 0").orderBy(mixed, "h").limit(sample_sentences)
             .select("parts").collect()]
    if not toxic or not clean:
        return None
    found = [p for _, _, p in toxic]
    weights = fit(found, strong, clean, landmarks)
    # the fragments of all clean sentences of the sample that come nearest are further negative examples
    near = (parts.filter("c > 0").select("part").mapInArrow(_part_scores(weights), "part string, f double")
            .filter("f > -1").orderBy(F.desc("f"), "part").limit(sample_sentences))
    weights = fit(found, strong, [*clean, [r.part for r in near.collect()]], landmarks)

    rest = sample.filter("NOT fits").select("h", "toxic", "text").mapInArrow(
        _score_batches(weights, ["h", "toxic"]), "h string, toxic int, decision double")
    # at most 2 * sample_docs numbers
    values = [(r.decision, r.toxic) for r in rest.filter("decision IS NOT NULL").orderBy("h", "decision").collect()]
    if len({t for _, t in values}) == 2:
        slope, offset = _sigmoid(np.array([d for d, _ in values]), np.array([t for _, t in values]))
        if slope > 0:
            weights.slope, weights.offset = slope, offset
    return weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    sample_docs: int = SAMPLE_DOCS, sample_sentences: int = SAMPLE_SENTENCES,
                    landmarks: int = LANDMARKS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row.

    ``score`` is the probability of label 1 by the document's most toxic
    fragment, over its whole text.  Labels (``doc_id, toxic``) are learned only
    from ids whose crc32 modulo 5 is not 0 (``held_out``); a score depends on
    the text alone.

    Defined cases: a null text counts as empty; a text without fragments scores
    as one far on the clean side (probability of a decision of -2); without
    labelled sentences of both classes all scores are 0; of several labels of an
    id the largest counts, null labels and null ids are not learned; rows that
    repeat an id are scored each; equal texts get equal scores; a fragment of
    more than 24 letters is compared in overlapping windows, so long texts and
    words are scored whole; an empty table gives an empty result; other columns
    are ignored, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    weights = train(rows, labels.select("doc_id", "toxic"), sample_docs=sample_docs,
                    sample_sentences=sample_sentences, landmarks=landmarks)
    held = (fold(F.col("doc_id")) == HELD_OUT).alias("held_out")
    if weights is None:
        return rows.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    decided = rows.mapInArrow(_score_batches(weights, ["doc_id"]), f"doc_id {kind}, decision double")
    z = F.lit(weights.slope) * F.coalesce("decision", F.lit(-2.0)) + F.lit(weights.offset)
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
    return (decided.select("doc_id", held, score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0)))
