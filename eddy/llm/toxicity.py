"""Toxicity by a subsequence string-kernel support vector machine with Nystroem
landmarks (operator 13).

Kernel
    A piece of a sentence is a string of letter classes (a-z, one for all other
    letters, one for the piece's start); what is no letter only takes room. Its
    features are the subsequences of three classes within ``SPAN`` places, each
    weighing ``DECAY`` to the number of places it covers, summed per subsequence.
    The kernel of two pieces is the product of their features, each divided by the
    root of the occurrences' squared weights (the cosine, where no subsequence occurs
    twice): an insult with gaps, fillers or an ending still shares most of its
    subsequences with the plain one.

Pieces of a sentence are its words (of one longer than ``PIECE`` characters: windows
that overlap by half), spelled-out runs (``i d i o t``), and pairs of short
neighbours that no learning row is full of (``id iot``); neither crosses the end of a
sentence.

Learning
    Labels are of documents, insults are in few of their sentences. So this is
    multiple-instance learning: each toxic document gives its most toxic piece (at
    first by the log odds of occurring in toxic and other documents, then by the
    machine itself) and whatever else the machine calls toxic in it, unless a clean
    document has it too; clean documents give pieces of all their sentences. Landmarks are pieces with
    high log odds and some ordinary ones. Nystroem features ``K(x, landmarks)
    K_mm^(-1/2)`` go into a linear machine with squared hinge loss, solved by Newton
    steps. Its decision is linear in the subsequences, so the landmarks are folded
    into one weight per subsequence, which scores a piece without loss. A document
    scores as its highest piece; a logistic curve, fitted on the margins that machines
    learned without a third of the rows give that third, turns that into a
    probability.

Scale: learning uses at most ``max_rows`` documents of each label, those with the
smallest hash of the text, whose pieces the driver reads; the machine's first version
scores half of up to ``more`` further clean documents, whose ``HARD`` highest pieces
are learned as well, next to ``CLEAN`` pieces of the clean rows of the sample; the
other half's margins go into the curve. Labels
meet the ids and hashes of the texts, no text is shuffled for it; the sample's ids
are broadcast to the scan and its texts stored. The model broadcast is one number a
subsequence (98 kB). Scoring is one pass over whole texts without a shuffle; a task
remembers the scores of at most ``CACHE`` pieces.

Edge cases: NULL, empty and letterless texts score as a text without any piece;
without labels of both kinds all score 0. A document with several labels is toxic
if one of them says so; NULL labels and NULL ids teach nothing. Copies and near copies
count once in learning. Ties are broken by the pieces' order. An empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_by_value, small_batches, stored
from .langid import class_table, held_out

#: learning rows of each label, further clean rows, landmarks, hard pieces of the latter
MAX_ROWS, MORE, LANDMARKS, HARD = 600, 6000, 128, 4000
#: characters of a piece, places that a subsequence covers at most, its decay a place
PIECE, SPAN, DECAY = 24, 7, 0.7
EDGES = ".,;:!?\"'()[]"
#: letter classes: a-z, other letters, the start, what is no letter
OTHER, START, NONE, CLASSES = 26, 27, 28, 29
SPACE = CLASSES ** 3
#: 1 for subsequences without the class of what is no letter
LETTERS = np.pad(np.ones((CLASSES - 1,) * 3, np.float32), (0, 1)).reshape(-1)
#: letters of the words of a pair, together; shares of clean rows above which a word is in no pair
SHORT, COMMON = 5, 0.02
ROUNDS, COST = 4, 1.0
#: clean pieces of the learning rows that are learned, cosine above which landmarks are alike
CLEAN, ALIKE = 10_000, 0.85
#: pieces of a toxic row that may be its toxic ones, log odds from which a piece is one if the machine says so
OFFERED, LIKELY = 40, 2.3
#: share of a row's rare pieces (in RARE rows at most) that makes it a copy
COPY, RARE = 0.5, 50
CURVE_FOLDS = 3
CACHE, SLICE = 300_000, 128


# ------------------------------------------------------------------ the features
def letter_classes() -> np.ndarray:
    """Class of every code point of a lower-cased text."""
    t = class_table().astype(np.int16)
    return np.where(t == 0, NONE, np.where(t > 26, OTHER, t - 1)).astype(np.uint8)


TABLE = letter_classes()


def coded(pieces: list) -> np.ndarray:
    """Classes of the pieces, one a row, filled up with ``NONE``."""
    width = max(map(len, pieces))
    text = "".join(p.ljust(width) for p in pieces).encode("utf-32-le", "surrogatepass")
    own = TABLE[np.frombuffer(text, "<u4")].reshape(len(pieces), width)
    return np.hstack([np.full((len(pieces), 1), START, np.int32), own.astype(np.int32)])


def occurrences(c: np.ndarray):
    """Per gap pattern: the subsequence that begins at each place, and its weight."""
    width = c.shape[1]
    for far in range(2, min(SPAN, width)):
        for near in range(1, far):
            yield (c[:, :width - far] * CLASSES + c[:, near:width - far + near]) * CLASSES + c[:, far:], DECAY ** (far + 1)


def lengths(c: np.ndarray) -> np.ndarray:
    """Length of every piece's features, counting each occurrence by itself."""
    square = np.zeros(len(c), np.float32)
    for sub, weight in occurrences(c):
        square += LETTERS[sub].sum(1) * np.float32(weight ** 2)
    return np.sqrt(np.maximum(square, 1e-12))


def linear(pieces: list, weights: np.ndarray) -> np.ndarray:
    """The pieces' features times ``weights`` (one or several columns)."""
    out = np.zeros((len(pieces), *weights.shape[1:]), np.float32)
    step = 4000 if weights.ndim == 1 else 250
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    for at in range(0, len(pieces), step):
        part = order[at:at + step]
        c = coded([pieces[i] for i in part])
        got = sum((weights[sub].sum(1) * np.float32(weight) for sub, weight in occurrences(c)), np.zeros((len(part), *weights.shape[1:]), np.float32))
        size = lengths(c)
        out[part] = got / (size if weights.ndim == 1 else size[:, None])
    return out


def features(piece: str) -> np.ndarray:
    """The features of a piece, one number a subsequence."""
    out, c = np.zeros(SPACE, np.float32), coded([piece])
    for sub, weight in occurrences(c):
        np.add.at(out, sub[0], np.float32(weight))
    return out * LETTERS / lengths(c)[0]


# -------------------------------------------------------------------- the pieces
def pieces_of(text: str | None, common: frozenset) -> set:
    words = (text or "").lower().split()
    out = {w.strip(EDGES) for w in set(words)}
    out.discard("")
    for w in [w for w in out if len(w) > PIECE]:
        out.discard(w)
        out.update(w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2))
    short = [i for i, w in enumerate(words) if len(w) <= SHORT and w not in common]
    out.update(f"{words[i]} {words[j]}" for i, j in zip(short, short[1:])
               if j == i + 1 and 4 <= len(words[i]) + len(words[j]) and words[i][-1] not in ".!?")
    single = [i for i, w in enumerate(words) if len(w) == 1 or len(w) == 2 and not w[1].isalpha()]
    run = []
    for i in [*single, -1]:
        if run and (i != run[-1] + 1 or words[run[-1]][-1] in "!?"):
            spelled = " ".join(words[k] for k in run) if len(run) > 2 else ""
            out.update(spelled[k:k + PIECE] for k in range(0, len(spelled) - 1, PIECE // 2))
            run = []
        run.append(i)
    return out


def bags(common):
    """``(h, label, pieces)`` of learning rows."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                p = b.slice(at, SLICE)
                found = [sorted(pieces_of(t, common)) for t in p.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([p.column("h"), p.column("toxic"), pa.array(found, pa.list_(pa.string()))], names=["h", "toxic", "pieces"])
    return run


# ------------------------------------------------------------------- the machine
def newton_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss; the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    reg = np.eye(x.shape[1])
    reg[-1, -1] = 1e-6
    loss = lambda w: 0.5 * w @ reg @ w + 0.5 * weight @ np.maximum(0, 1 - y * (x @ w)) ** 2
    now = loss(w)
    for _ in range(50):
        on = y * (x @ w) < 1
        xo, co = x[on], weight[on]
        step = np.linalg.solve(reg + (xo * co[:, None]).T @ xo, xo.T @ (co * y[on])) - w
        size, then = 1.0, loss(w + step)
        while then > now and size > 1e-4:
            size /= 2
            then = loss(w + size * step)
        if now - then <= 1e-9 * now:
            break
        w, now = w + size * step, then
    return w


def without_copies(bags_: list) -> list:
    """``bags_`` without those that share most of their rare pieces with an earlier
    one: many near copies of a row would make all of its words telling."""
    seen: dict = {}
    for _, _, ps in bags_:
        for p in ps:
            seen[p] = seen.get(p, 0) + 1
    kept, holds = [], {}
    for bag in bags_:
        rare = [p for p in bag[2] if seen[p] <= RARE]
        near: dict = {}
        for p in rare:
            for k in holds.get(p, ()):
                near[k] = near.get(k, 0) + 1
        if not near or max(near.values()) <= COPY * len(rare):
            for p in rare:
                holds.setdefault(p, []).append(len(kept))
            kept.append(bag)
    return kept


def odds(bags_: list) -> dict:
    """Log odds of the pieces of toxic rows, by the rows that hold them."""
    n = [sum(1 for b in bags_ if b[1] == k) for k in (0, 1)]
    seen: dict = {}
    for _, label, ps in bags_:
        for p in ps:
            seen.setdefault(p, [0, 0])[label] += 1
    return {p: (np.log((s[1] + 0.5) / (n[1] + 1)) - np.log((s[0] + 0.5) / (n[0] + 1)), s) for p, s in seen.items()}


def landmarks(found: dict, count: int) -> list:
    """Pieces with high odds, no two much alike, and a quarter ordinary ones."""
    ranked = sorted((p for p, (o, s) in found.items() if s[1] > 1 and o > 0 and len(p) > 2), key=lambda p: (-found[p][0], p))
    ordinary = sorted((p for p, (o, s) in found.items() if s[0] and len(p) > 2), key=by_hash)
    chosen: list = []
    dense = np.zeros((count, SPACE), np.float32)
    for most, offered in ((count - count // 4, ranked[:16 * count]), (count, ordinary[:4 * count])):
        for p in offered:
            if len(chosen) >= most:
                break
            own = features(p)
            if own.any() and not (dense[:len(chosen)] @ own > ALIKE).any():
                dense[len(chosen)] = own
                chosen.append(p)
    return chosen


def by_hash(piece: str):
    return blake2b(piece.encode("utf-8", "surrogatepass"), digest_size=8).digest(), piece


class Machine:
    """The support vector machine on Nystroem features of bags ``(h, label, pieces)``."""

    def __init__(self, bags_: list, count: int):
        self.found = odds(bags_)
        marks = landmarks(self.found, count)
        dense = np.array([features(p) for p in marks], np.float32).reshape(len(marks), SPACE).T
        val, vec = np.linalg.eigh((dense.T @ dense).astype(np.float64))
        self.to_features = (dense @ ((vec * np.maximum(val, 1e-3) ** -0.5) @ vec.T)).astype(np.float32)
        clean = {p for _, label, ps in bags_ if not label for p in ps}
        self.clean = sorted(clean, key=by_hash)[:CLEAN]
        self.x_clean = linear(self.clean, self.to_features)
        toxic = [sorted((p for p in ps if p not in clean), key=lambda p: (-self.found[p][0], by_hash(p)))[:OFFERED] for _, label, ps in bags_ if label]
        self.mine = sorted({p for ps in toxic for p in ps})
        self.x_mine = linear(self.mine, self.to_features)
        place = {p: i for i, p in enumerate(self.mine)}
        self.held = np.array([self.found[p][1][1] for p in self.mine], np.float64)
        self.likely = np.array([self.found[p][0] > LIKELY for p in self.mine])
        self.rows = [np.array([place[p] for p in ps]) for ps in toxic if ps]

    def solve(self, hard: list) -> tuple[np.ndarray, float]:
        """``(weight per subsequence, bias)``, with further clean pieces. A toxic
        bag's pieces are toxic where the machine says so, its highest one always."""
        x_clean = np.vstack([self.x_clean, linear(sorted(set(hard)), self.to_features)]) if hard else self.x_clean
        scores = np.array([self.found[p][0] for p in self.mine])
        best = np.unique([*(r[scores[r].argmax()] for r in self.rows), *np.flatnonzero(self.likely)])
        for _ in range(ROUNDS):
            x = np.vstack([self.x_mine[best], x_clean])
            y = np.concatenate([np.ones(len(best)), -np.ones(len(x_clean))])
            held = self.held[best]  # a piece weighs as the toxic rows that hold it
            weight = np.concatenate([COST * len(x_clean) / 4 * held / max(1, held.sum()), np.full(len(x_clean), COST)])
            w = newton_svm(x, y, weight)
            scores = self.x_mine @ w[:-1] + w[-1]
            best = np.unique([*(r[scores[r].argmax()] for r in self.rows), *np.flatnonzero((scores > 0) & self.likely)])
        return self.to_features @ w[:-1].astype(np.float32), float(w[-1])


def margins(found: list, model) -> np.ndarray:
    """Highest margin of each list of pieces; the bias for an empty one."""
    weights, bias = model
    every = sorted({p for ps in found for p in ps})
    own = dict(zip(every, linear(every, weights).tolist()))
    return np.array([max((own[p] for p in ps), default=0.0) + bias for ps in found])


def logistic(m: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of a margin (smoothed targets)."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    ab = np.zeros(2)
    x = np.column_stack([m, np.ones(len(m))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-3 * ab
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
        ab -= np.clip(step, -5, 5)
    return float(ab[0]), float(ab[1])


# ------------------------------------------------------------------ the operator
def sample(docs: DataFrame, labels: DataFrame, id_col, text_col, label_col, max_rows: int, more: int):
    """``(rows, n)``: ``h, toxic, first, text`` of the learning sample, stored, and
    the learning rows of each label. ``first`` marks the ``max_rows`` of a label with
    the smallest hashes; of clean rows up to ``more`` follow."""
    spark = docs.sparkSession
    own = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
    texts = docs.where(~held_out(id_col) & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    rows = stored(texts.select("id", "h").join(own, "id"), "toxic-rows")  # no text is shuffled
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    each = rows.groupBy("toxic", "h").agg(F.min("id").alias("id"))
    picked = [each.where(F.col("toxic") == k).orderBy("h").limit(n).collect() for k, n in ((1, max_rows), (0, max_rows + more))]
    picked = [(r["id"], r["h"], r["toxic"], i < max_rows) for part in picked for i, r in enumerate(part)]
    chosen = spark.createDataFrame(picked, f"id {docs.schema[id_col].dataType.simpleString()}, h long, toxic int, first boolean")
    found = texts.join(F.broadcast(chosen), ["id", "h"]).select("h", "toxic", "first", "text")  # 2 * max_rows + more numbers
    return stored(found.dropDuplicates(["h"]), "toxic-sample"), [counts.get(k, 0) for k in (0, 1)]


def word_share(bags_: list) -> frozenset:
    """Words of more than ``COMMON`` of the clean rows."""
    clean = [ps for _, label, ps in bags_ if not label]
    seen: dict = {}
    for ps in clean:
        for p in ps:
            if len(p) <= SHORT:
                seen[p] = seen.get(p, 0) + 1
    return frozenset(p for p, n in seen.items() if n > COMMON * len(clean))


def learn(docs: DataFrame, labels: DataFrame, id_col, text_col, label_col, max_rows: int, more: int, count: int):
    """``(weights, bias, slope, offset, common words)``, or None."""
    spark = docs.sparkSession
    rows, n = sample(docs, labels, id_col, text_col, label_col, max_rows, more)
    if 0 in n:
        return None
    once = rows.where("first").mapInArrow(bags(frozenset()), "h long, toxic int, pieces array<string>")
    got = sorted((r["h"], r["toxic"], r["pieces"]) for r in once.collect())
    common = word_share(got)
    got = [(h, t, [p for p in ps if " " not in p or len(p.split()) > 2 or not common.intersection(p.split())]) for h, t, ps in got]
    got = without_copies(got)
    machine = Machine(got, count)
    model = machine.solve([])
    shared = spark.sparkContext.broadcast((*model, common))
    hard = rows.where("not first and h % 2 = 0").select("text")
    hard = hard.mapInArrow(top_pieces(shared), "piece string, margin double").groupBy("piece").agg(F.max("margin").alias("margin"))
    hard = [r["piece"] for r in hard.orderBy(F.col("margin").desc(), "piece").limit(HARD).collect()]
    # margins of learning rows by machines that did not learn them, for the logistic curve
    m, y = np.zeros(len(got)), np.array([r[1] for r in got], np.float64)
    for k in range(CURVE_FOLDS):
        own = np.arange(len(got)) % CURVE_FOLDS == k
        rest = [r for r, o in zip(got, own) if not o]
        if {r[1] for r in rest} == {0, 1}:
            m[own] = margins([r[2] for r, o in zip(got, own) if o], Machine(rest, count).solve(hard))
    model = machine.solve(hard)
    fresh = rows.where("not first and h % 2 <> 0").select("text").mapInArrow(top_margins(spark.sparkContext.broadcast((*model, common))), "margin double")
    fresh = sorted(r["margin"] for r in fresh.collect())
    m, y = np.concatenate([m, fresh]), np.concatenate([y, np.zeros(len(fresh))])
    weight = np.where(y > 0, n[1] / max(1, y.sum()), n[0] / max(1, (1 - y).sum()))
    slope, offset = logistic(m, y, weight * len(y) / weight.sum())
    return (*model, max(slope, 1e-3), offset, common)


class Scorer:
    """Margins of texts; remembers those of pieces."""

    def __init__(self, weights, bias, common):
        self.weights, self.bias, self.common, self.seen = weights, bias, common, {}

    def pieces(self, texts: list) -> list:
        if len(self.seen) > CACHE:
            self.seen.clear()
        found = [pieces_of(t, self.common) for t in texts]
        new = sorted({p for ps in found for p in ps if p not in self.seen})
        self.seen.update(zip(new, linear(new, self.weights).tolist()))
        return found

    def margins(self, texts: list) -> list:
        seen = self.seen
        return [max((seen[p] for p in ps), default=0.0) + self.bias for ps in self.pieces(texts)]


def top_margins(shared):
    def run(batches):
        scorer = Scorer(*shared.value)
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                yield pa.RecordBatch.from_arrays([pa.array(scorer.margins(b.column("text").slice(at, SLICE).to_pylist()), pa.float64())], names=["margin"])
    return run


def top_pieces(shared):
    """The highest pieces of a task's texts, ``HARD`` at most."""
    def run(batches):
        weights, bias, common = shared.value
        scorer, best = Scorer(weights, bias, common), {}
        for b in batches:
            for at in range(0, b.num_rows, SLICE):
                for ps in scorer.pieces(b.column("text").slice(at, SLICE).to_pylist()):
                    best.update((p, scorer.seen[p]) for p in ps if scorer.seen[p] + bias > -0.9)
                if len(best) > 4 * HARD:
                    best = dict(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:HARD])
        got = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:HARD]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in got], pa.string()), pa.array([m for _, m in got], pa.float64())], names=["piece", "margin"])
    return run


def scored(shared):
    def run(batches):
        weights, bias, slope, offset, common = shared.value
        scorer = Scorer(weights, bias, common)
        for b in batches:
            m = [x for at in range(0, b.num_rows, SLICE) for x in scorer.margins(b.column("text").slice(at, SLICE).to_pylist())]
            p = 1 / (1 + np.exp(-np.clip(slope * np.array(m, np.float64) + offset, -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                                             names=["doc_id", "held_out", "score", "predicted"])
    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_col="toxic",
             max_rows: int = MAX_ROWS, more: int = MORE, count: int = LANDMARKS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    model = learn(docs, labels, id_col, text_col, label_col, max_rows, more, count)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scored(spark.sparkContext.broadcast(model)), f"doc_id {kind}, held_out boolean, score double, predicted int")


ship_by_value(__name__)
