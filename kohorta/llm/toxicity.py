"""Toxicity scores by a convolutional text classifier, trained by Spark tasks in numpy."""

from __future__ import annotations

import re
import uuid
import zlib
from array import array
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from kohorta.llm.common import WordCache, claim, durable, map_groups, map_rows, query, read_table, small_batches
from kohorta.session import shared_folder

THRESHOLD = 0.7


@dataclass(frozen=True)
class Settings:
    """What the classifier is made of and what it learns from.

    It is fitted to the whole texts of all labelled rows: to ``rows`` of them at a
    time in a task, from ``rounds`` slices one after another, the tasks' models
    averaged after each. As many rows as one task takes in all rounds stay
    together. Every row is learnt from once, or more often until all tasks have
    made ``steps`` steps.
    A share ``held`` of the rows is kept out to calibrate.
    """

    rows: int = 4096
    chars: int = 16_000_000  # no more rows than these characters, where rows are long
    rounds: int = 8
    held: float = 0.25
    buckets: int = 1 << 18
    least_texts: int = 4  # a hash bucket met in fewer texts has no embedding
    width: int = 8
    filters: int = 8
    spans: tuple[int, ...] = (1, 2, 3)
    prefixes: tuple[int, ...] = (3, 4, 5, 6, 7)
    steps: int = 1400
    batch: int = 32
    rate: float = 0.01
    seed: int = 11


_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_features(word: str, s: Settings) -> list[int]:
    """Hash buckets of a word and of its beginnings."""
    if word.isascii():
        data = word.encode("ascii")
        return [zlib.crc32(data + b"$") % s.buckets] + [zlib.crc32(data[:n]) % s.buckets for n in s.prefixes]
    parts = [word + "$"] + [word[:n] for n in s.prefixes]
    return [zlib.crc32(p.encode("utf-8")) % s.buckets for p in parts]


@dataclass
class Model:
    """Word embeddings are sums of hashed rows; filters of several widths run over
    them, each keeps its maximum over the text, and a logistic unit reads those."""

    settings: Settings
    row_of: np.ndarray  # per hash bucket its row in ``table``; row 0 is zero
    table: np.ndarray
    kernels: list[np.ndarray]  # per filter width: (width, embedding, filters)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)  # what workers keep for it

    @classmethod
    def start(cls, s: Settings, used: np.ndarray) -> Model:
        """``used`` are the hash buckets that get an embedding."""
        rng = np.random.default_rng(s.seed)
        n = s.filters * len(s.spans)
        row_of = np.zeros(s.buckets, np.int32)
        row_of[used] = np.arange(1, len(used) + 1)
        table = rng.normal(0, 0.1, (len(used) + 1, s.width)).astype(np.float32)
        table[0] = 0
        return cls(
            s,
            row_of,
            table,
            [rng.normal(0, 0.5, (w, s.width, s.filters)).astype(np.float32) for w in s.spans],
            np.zeros(n, np.float32),
            np.full(n, 0.5, np.float32),
            np.full(1, -1.0, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *self.kernels, self.bias, self.out, self.out_bias]

    def matrix(self) -> np.ndarray:
        """All parameters in one matrix: the table's rows, then the others', filled up with zeros."""
        flat = np.concatenate([p.ravel() for p in self.parameters()[1:]])
        rest = np.zeros((-(-len(flat) // self.settings.width), self.settings.width), np.float32)
        rest.ravel()[: len(flat)] = flat
        return np.concatenate([self.table, rest])

    def moved(self, places: np.ndarray, by: np.ndarray) -> Model:
        """The model with ``by`` added to the given rows of its matrix; a new name."""
        matrix = self.matrix()
        matrix[places] += by
        n, flat, out = len(self.table), matrix[len(self.table) :].ravel(), []
        for p in self.parameters()[1:]:
            out.append(flat[: p.size].reshape(p.shape))
            flat = flat[p.size :]
        k = len(self.kernels)
        return replace(
            self, table=matrix[:n], kernels=out[:k], bias=out[k], out=out[k + 1], out_bias=out[k + 2], name=uuid.uuid4().hex
        )

    def projected(self, features: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each place of the filter."""
        embedded = self.table[self.row_of[features]].sum(1)
        weights = np.concatenate([k[i] for k in self.kernels for i in range(len(k))], 1)
        return embedded @ weights

    def offsets(self) -> list[tuple[int, int, int]]:
        """(filter group, place in the filter, column in ``projected``)."""
        f, out, at = self.settings.filters, [], 0
        for g, k in enumerate(self.kernels):
            for i in range(len(k)):
                out.append((g, i, at))
                at += f
        return out

    def responses(self, projected: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """Filter responses at every place; ``ids`` index rows of ``projected``."""
        f, n = self.settings.filters, len(ids)
        maps = [np.zeros((n, f), np.float32) for _ in self.kernels]
        for g, i, at in self.offsets():
            maps[g][: n - i] += projected[ids[i:], at : at + f]
        return maps

    def pooled(self, maps: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
        """Largest response in each text; ``starts`` has the end as last entry.

        A filter may begin at the last word and reach into the padding, not at
        the padding's end, where it would reach into the next text.
        """
        cuts = np.stack([starts[:-1], starts[1:] - (max(self.settings.spans) - 1)], 1).ravel()
        return np.concatenate([np.maximum.reduceat(m, cuts)[::2] for m in maps], 1)

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        a, b = self.scale
        z = (pooled + self.bias).astype(np.float64) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(a * z + b, -300, 300)))


class Vocabulary:
    """Row numbers of distinct words; row 0 is the padding after each text.

    A worker renews it when it has grown to ``limit`` words.
    """

    def __init__(self, settings: Settings, limit: int = 150_000):
        self.settings, self.limit = settings, limit
        self.words = WordCache(self._add, 1 << 60)
        self.fresh = array("i")

    def _add(self, word: str) -> int:
        self.fresh.extend(word_features(word, self.settings))
        return len(self.words) + 1

    def take(self) -> np.ndarray:
        """Features of the words met since the last call, in the order of their numbers."""
        taken = np.array(self.fresh, np.int32).reshape(-1, 1 + len(self.settings.prefixes))
        self.fresh = array("i")
        return taken

    def full(self) -> bool:
        return len(self.words) > self.limit

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers of all words, each text padded, and where texts start."""
        pad = [0] * max(2, max(self.settings.spans))  # with one width, still one place to pool
        flat = array("i")
        starts = []
        for t in texts:
            starts.append(len(flat))
            flat.extend(map(self.words.__getitem__, words_of(t)))
            flat.extend(pad)
        return np.array(flat, np.int32), np.array(starts)


def constant(settings: Settings, toxic: bool) -> Model:
    """Where only one label is known, all scores are that label's side of a half."""
    model = Model.start(settings, np.zeros(0, np.int64))
    model.out[:] = 0
    model.out_bias[0] = 2.0 if toxic else -2.0
    return model


def learn(model: Model, texts: list[str], toxic: list[int], weights: tuple[float, float], steps: int, done: float, part: float, seed: int):
    """Adam steps of one task, from ``model``: the rows of ``matrix`` that they move, and by how much.

    Goes through all texts, and again until ``steps`` steps are made. ``done`` is the
    share of the training behind these steps, ``part`` their own share.
    """
    s = model.settings
    y = np.array(toxic, np.float32)
    weight = np.where(y > 0, weights[1], weights[0]).astype(np.float32)
    vocabulary = Vocabulary(s)
    coded = [vocabulary.encode([t])[0] for t in texts]
    features = model.row_of[vocabulary.take()]
    used = np.union1d(features, [0])
    features = np.concatenate([np.zeros((1, features.shape[1]), np.int64), np.searchsorted(used, features)])
    own = replace(
        model, table=model.table[used], kernels=[k.copy() for k in model.kernels],
        bias=model.bias.copy(), out=model.out.copy(), out_bias=model.out_bias.copy(),
    )
    rng = np.random.default_rng([s.seed, seed])
    order = rng.permutation(len(texts))
    steps = max(steps, -(-len(texts) // s.batch))
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in own.parameters()]
    step = 0
    while step < steps:
        rng.shuffle(order)
        for at in range(0, len(order), s.batch):
            rows = order[at : at + s.batch]
            rate = s.rate * max(0.0, 1 - done - part * step / steps)
            step += 1
            flat = np.concatenate([coded[r] for r in rows])
            starts = np.concatenate(([0], np.cumsum([len(coded[r]) for r in rows])))
            distinct, ids = np.unique(flat, return_inverse=True)
            gradients = _gradients(own, features, distinct, ids, starts, y[rows], weight[rows])
            for p, g, (m, v) in zip(own.parameters(), gradients, state):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
            if step == steps:  # all texts were met at least once
                break
    moved = own.matrix() - replace(own, table=model.table[used], kernels=model.kernels, bias=model.bias, out=model.out, out_bias=model.out_bias).matrix()
    places = np.concatenate([used, len(model.table) + np.arange(len(moved) - len(used))])
    changed = np.flatnonzero(moved.any(1))
    return places[changed], moved[changed]


# Responses are held of so many words at once.
PIECE = 200_000


def _peaks(model: Model, projected, ids, starts) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of every filter in each text, and its place; of a long text piece by piece."""
    s, n = model.settings, len(starts) - 1
    f, tail = s.filters, max(s.spans) - 1
    pooled = np.full((n, model.bias.size), -np.inf, np.float32)
    places = np.zeros((n, model.bias.size), np.int64)
    maps, base, end = [], 0, 0
    for d in range(n):
        for a in range(starts[d], starts[d + 1] - tail, PIECE):
            b = min(a + PIECE, starts[d + 1] - tail)
            if b + tail > end:  # the next texts that fit, or this piece
                last = max(np.searchsorted(starts, a + PIECE, "right") - 1, 0)
                base, end = a, max(b + tail, starts[last])
                maps = model.responses(projected, ids[base:end])
            for g, m in enumerate(maps):
                at, own = m[a - base : b - base].argmax(0), slice(g * f, (g + 1) * f)
                top = m[a - base + at, np.arange(f)]
                more = top > pooled[d, own]
                pooled[d, own] = np.where(more, top, pooled[d, own])
                places[d, own] = np.where(more, a + at, places[d, own])
    return pooled, places


def _gradients(model: Model, features, distinct, ids, starts, y, weight=1.0) -> list[np.ndarray]:
    s, n = model.settings, len(y)
    f = s.filters
    feats = features[distinct]
    embedded = model.table[feats].sum(1)
    weights = np.concatenate([k[i] for k in model.kernels for i in range(len(k))], 1)
    pooled, places = _peaks(model, embedded @ weights, ids, starts)
    hidden = pooled + model.bias
    p = 1 / (1 + np.exp(-np.clip(hidden @ model.out + model.out_bias[0], -30, 30)))
    error = weight * (p - y) / n
    back = np.outer(error, model.out)
    d_embedded = np.zeros_like(embedded)
    d_kernels = [np.zeros_like(k) for k in model.kernels]
    for g, k in enumerate(model.kernels):
        part, spot = back[:, g * f : (g + 1) * f], places[:, g * f : (g + 1) * f]
        for i in range(len(k)):
            row = ids[np.minimum(spot + i, len(ids) - 1)]
            d_kernels[g][i] = np.einsum("nfe,nf->ef", embedded[row], part)
            np.add.at(d_embedded, row.ravel(), (part[:, :, None] * k[i].T[None]).reshape(-1, s.width))
    d_table = np.zeros_like(model.table)
    np.add.at(d_table, feats.ravel(), np.repeat(d_embedded, feats.shape[1], 0))
    d_table[0] = 0
    return [d_table, *d_kernels, back.sum(0), hidden.T @ error, np.array([error.sum()], np.float32)]


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logit that fit the held-out labels best."""
    z = np.clip(z, -20, 20)
    w = np.array([1.0, 0.0])
    x = np.stack([z, np.ones_like(z)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-3 * (w - [1.0, 0.0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w -= move / max(1.0, np.abs(move).max())
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


# A language gets a threshold of its own with this many held-out toxic rows.
LEAST_POSITIVES = 20


def language_thresholds(held: DataFrame, scale: tuple[float, float]) -> dict[str, float]:
    """Per language the threshold of the best F1 on held-out rows (z, toxic, lang), at least a half.

    Among equally good thresholds the one nearest to the common threshold counts.
    """
    grid = sorted((round(0.5 + 0.05 * i, 2) for i in range(10)), key=lambda t: (round(abs(t - THRESHOLD), 2), t))
    scaled = 1 / (1 + F.exp(-(scale[0] * F.col("z") + scale[1])))
    hit = {i: scaled >= t for i, t in enumerate(grid)}
    counts = (
        held.filter(F.col("lang").isNotNull())
        .groupBy("lang")
        .agg(
            F.sum("toxic").alias("all"),
            *[F.count_if(h).alias(f"hit_{i}") for i, h in hit.items()],
            *[F.count_if(h & (F.col("toxic") > 0)).alias(f"right_{i}") for i, h in hit.items()],
        )
        .filter(F.col("all") >= LEAST_POSITIVES)
    )
    found = {}
    for row in counts.collect():
        best = -1.0
        for i, t in enumerate(grid):
            f1 = 2 * row[f"right_{i}"] / max(1e-9, row[f"hit_{i}"] + row["all"])
            if f1 > best + 1e-12:
                best, found[row["lang"]] = f1, t
    return found


def vocabulary_of(model: Model) -> Vocabulary:
    return Vocabulary(model.settings)


def score_rows(model: Model, vocabulary: Vocabulary, texts: list[str | None], cached: dict | None = None) -> np.ndarray:
    """Scores of texts; the projections of words already seen are kept in ``cached``."""
    ids, starts = vocabulary.encode(texts)
    cached = {} if cached is None else cached
    rows = cached.get("rows")
    if rows is None:
        columns = sum(len(k) for k in model.kernels) * model.settings.filters
        rows = cached["rows"] = np.zeros((1024, columns), np.float32)
        cached["n"] = 1
    new = vocabulary.take()
    if len(new):
        need = cached["n"] + len(new)
        if need > len(rows):
            rows = cached["rows"] = np.concatenate([rows, np.zeros((max(need, 2 * len(rows)) - len(rows), rows.shape[1]), np.float32)])
        rows[cached["n"] : need] = model.projected(new)
        cached["n"] = need
    pooled = np.empty((len(texts), model.bias.size), np.float32)
    starts = np.append(starts, len(ids))
    # A few texts at a time: responses of all their words are held at once.
    for a in range(0, len(texts), 32):
        b = min(a + 32, len(texts))
        maps = model.responses(rows, ids[starts[a] : starts[b]])
        pooled[a:b] = model.pooled(maps, starts[a : b + 1] - starts[a])
    return model.probability(pooled)


def fold(key) -> F.Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(key.cast("string")) % 3


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fits a model to all labelled rows outside fold 1.

    Of repeated labels of a document the toxic one counts, of its repeated rows
    the one with the smallest text; rows without id or label are left out. Tasks
    train on their shares of a slice side by side, and the driver gets sums of
    what they moved, never rows.
    """
    s = settings
    small_batches(docs.sparkSession)
    rows = _labelled(docs, labels, s)
    found = rows.groupBy("held", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    size = {(r["held"], r["toxic"]): r["n"] for r in found}
    totals = [size.get((0, k), 0) + size.get((1, k), 0) for k in (0, 1)]
    if not all(totals):
        return constant(s, totals[1] > 0)
    held, kept = rows.filter("held = 1"), rows.filter("held = 0")
    if not all(size.get(k) for k in ((0, 0), (0, 1), (1, 0), (1, 1))):
        held = kept = rows
    else:
        found = [r for r in found if r["held"] == 0]
    n, chars = sum(r["n"] for r in found), sum(r["chars"] for r in found)
    shards = max(-(-n // (s.rows * s.rounds)), -(-chars // (s.chars * s.rounds)), 1)
    rounds = s.rounds if shards > 1 else 1
    rare = float(np.clip(totals[0] / totals[1], 1 / 8, 8))
    weights = (1.0, rare) if rare > 1 else (1 / rare, 1.0)
    weights = tuple(w * sum(totals) / (totals[0] * weights[0] + totals[1] * weights[1]) for w in weights)
    tasks = max(-(-n // (2 * s.rows)), -(-chars // (2 * s.chars)))
    model = Model.start(s, _met(kept.coalesce(tasks), s))
    for r in range(rounds):
        part = kept.filter(F.col("slice") == r) if rounds > 1 else kept
        model = _averaged(part, model, shards, weights, -(-s.steps // (rounds * shards)), r / rounds, 1 / rounds)
    judged = durable(_logits(held.coalesce(tasks), model))
    # Every row counts, by its logit in thousandths.
    bins = judged.groupBy(F.round(F.col("z") * 1000).cast("int").alias("bin"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    bins = np.array(sorted(tuple(r) for r in bins), np.float64)
    model.scale = platt(bins[:, 0] / 1000, bins[:, 1], bins[:, 2])
    model.thresholds = language_thresholds(judged, model.scale)
    return model


def _labelled(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """doc_id, text, lang, toxic of the rows to learn from, written by ``held`` and ``slice``."""
    key = F.col("doc_id")
    known = (
        labels.select("doc_id", "toxic")
        .filter(F.col("toxic").isNotNull() & key.isNotNull() & (fold(key) != 1))
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    )
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.filter(fold(key) != 1).select("doc_id", F.struct(F.coalesce("text", F.lit("")).alias("text"), lang.alias("lang")).alias("row"))
    rows = (
        texts.join(known, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("row").alias("row"), F.max("toxic").alias("toxic"))
        .select(
            "doc_id",
            "row.text",
            "row.lang",
            "toxic",
            (F.pmod(F.xxhash64("doc_id", F.lit(s.seed)), F.lit(1000)) < 1000 * s.held).cast("int").alias("held"),
            F.pmod(F.xxhash64("doc_id", F.lit(s.seed + 1)), F.lit(s.rounds)).cast("int").alias("slice"),
        )
    )
    path = f"{shared_folder(docs.sparkSession)}/table-{uuid.uuid4().hex}"
    rows.write.partitionBy("held", "slice").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _met(rows: DataFrame, s: Settings) -> np.ndarray:
    """Hash buckets that ``least_texts`` or more of the texts meet."""

    def count(batches):
        claim("toxicity", _KEPT.clear)
        seen, vocabulary = np.zeros(s.buckets, np.int64), None
        for batch in batches:
            if vocabulary is None or vocabulary.full():
                vocabulary = Vocabulary(s)
                features = vocabulary.take()
            coded = [np.unique(vocabulary.encode([text])[0])[1:] for text in batch.column(0).to_pylist()]
            features = np.concatenate([features, vocabulary.take()])
            for words in coded:
                seen[np.unique(features[words - 1])] += 1
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(seen[met])], names=["bucket", "n"])

    counts = rows.select("text").mapInArrow(count, "bucket bigint, n bigint")
    used = counts.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= s.least_texts).select("bucket").toArrow()
    return np.sort(used.column(0).to_numpy())


# Steps of the sums in which tasks' moves are added: whole numbers, so that their order does not matter.
GRAIN = 1 << 32


def _averaged(rows: DataFrame, model: Model, shards: int, weights, steps: int, done: float, part: float) -> Model:
    """Trains a model per shard of the rows, each in a task, and moves ``model`` by their mean.

    A row of the embeddings moves by the mean of the shards that moved it.
    """
    s, sent = model.settings, rows.sparkSession.sparkContext.broadcast(model)
    columns = [f"d{i}" for i in range(s.width)]

    def run(key, ids, texts, toxic):
        claim("toxicity", _KEPT.clear)
        order = sorted(range(len(ids)), key=ids.__getitem__)
        places, by = learn(sent.value, [texts[i] for i in order], [toxic[i] for i in order], weights, steps, done, part, key[0])
        by = np.rint(np.clip(by.astype(np.float64), -1e3, 1e3) * GRAIN).astype(np.int64)
        return zip(places.tolist(), *by.T.tolist())

    shard = F.pmod(F.xxhash64("doc_id", F.lit(s.seed + 2)), F.lit(shards)).cast("bigint").alias("shard")
    dealt = rows.select(shard, "doc_id", "text", "toxic")
    moves = map_groups(dealt, ["shard"], run, "place bigint, " + ", ".join(f"{c} bigint" for c in columns))
    mean = moves.groupBy("place").agg(*[(F.sum(c) / F.count(F.lit(1)) / GRAIN).cast("float").alias(c) for c in columns])
    got = mean.toArrow()
    sent.unpersist()
    return model.moved(got.column("place").to_numpy(), np.stack([got.column(c).to_numpy() for c in columns], 1))


def _logits(rows: DataFrame, model: Model) -> DataFrame:
    """z (of the unscaled score), toxic, lang of every row."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(texts, toxic, langs):
        claim("toxicity", _KEPT.clear)
        vocabulary, cached = _kept(sent.value)
        scores = np.clip(score_rows(sent.value, vocabulary, texts, cached), 1e-9, 1 - 1e-9)
        yield from zip(np.clip(np.log(scores / (1 - scores)), -20, 20).tolist(), toxic, langs)

    return map_rows(rows, ["text", "toxic", "lang"], run, "z double, toxic int, lang string")


def score(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id", lang: str | None = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted, flagged of every row.

    The score looks at the text alone. ``predicted`` uses one threshold for all,
    ``flagged`` the threshold of the document's language (0.7 where it has none).
    A missing or empty text is scored as an empty one; a row without doc_id is
    not held out.
    """
    frame = docs.select(
        F.col(key).alias("doc_id"),
        F.col(text).alias("text"),
        (F.col(lang).cast("string") if lang and lang in docs.columns else F.lit(None).cast("string")).alias("lang"),
        F.coalesce(fold(F.col(key)) == 1, F.lit(False)).alias("held_out"),
    )

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def rows(keys, texts, langs, held):
        claim("toxicity", _KEPT.clear)
        own = sent.value
        vocabulary, cached = _kept(own)
        scores = score_rows(own, vocabulary, texts, cached).tolist()
        for k, h, s, lang in zip(keys, held, scores, langs):
            yield k, h, s, int(s >= THRESHOLD), s >= own.thresholds.get(lang, THRESHOLD)

    return map_rows(
        frame,
        ["doc_id", "text", "lang", "held_out"],
        rows,
        "doc_id bigint, held_out boolean, score double, predicted int, flagged boolean",
    )


_KEPT: dict[str, tuple] = {}


def _kept(model: Model) -> tuple[Vocabulary, dict]:
    """The worker's vocabulary and projections for a model; renewed when large."""
    if model.name not in _KEPT or _KEPT[model.name][0].full():
        _KEPT.clear()
        _KEPT[model.name] = (Vocabulary(model.settings), {})
    return _KEPT[model.name]


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not flagged, with all their columns, in one pass.

    Rows stream through the worker batch by batch; none waits for its verdict in
    the JVM.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    text, lang = docs.columns.index("text"), docs.columns.index("lang") if "lang" in docs.columns else None

    def run(batches):
        claim("toxicity", _KEPT.clear)
        own = sent.value
        for batch in batches:
            vocabulary, cached = _kept(own)
            scores = score_rows(own, vocabulary, batch.column(text).to_pylist(), cached)
            langs = batch.column(lang).to_pylist() if lang is not None else [None] * len(scores)
            limits = np.array([own.thresholds.get(x, THRESHOLD) for x in langs])
            yield batch.filter(pa.array(scores < limits))

    return docs.mapInArrow(run, docs.schema)


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels")))
