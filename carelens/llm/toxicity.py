"""A convolutional text classifier: every labelled row counts, moves the weights and sets the thresholds, in Spark tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelens.llm.common import Work, as_batch, flat, mix64, steps
from carelens.llm.words import LOWER, NOT_ALNUM, byte_hashes, spans

#: All labelled rows move the weights, so many times after EPOCHS of full pace, in up to REPLICAS models of REPLICA_ROWS rows or
#: more, averaged each time.
PASSES, REPLICAS, REPLICA_ROWS = 3, 64, 8192
#: Where a caller asks for a beginning by few rows (fit_rows), no text of it is longer.
FIT_BYTES = 1 << 16
#: Thresholds are told apart by so many steps to one of the logit.
BINS = 64
#: Rows of each hashed embedding table, numbers in an embedding, filters of each width.
BUCKETS, SIZE, FILTERS, WIDTHS = 1 << 15, 16, 16, (1, 2, 3)
#: A word's embedding is the sum of one for the word and one for each of its beginnings of so many bytes.
BEGINNINGS = (4, 5, 6)
EPOCHS, BATCH, SEED = 3, 64, 4
#: Scores from here on count as toxic where no language threshold is at hand.
THRESHOLD = 0.3
_PAD = max(WIDTHS)
_CHUNK = 1 << 18


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word, a column per table, and the number of the first word of each text."""
    start, end, first = spans(data, offsets, NOT_ALNUM)
    roll = byte_hashes(44)
    sums = roll.sums(LOWER[data])
    cut = [end, *[np.minimum(end, start + n) for n in BEGINNINGS]]
    out = np.empty((len(start), len(cut)), np.uint16)  # BUCKETS are no more than that
    for t, stop in enumerate(cut):
        out[:, t] = mix64(roll.of(sums, start, stop) + np.uint64(t)) >> np.uint64(64 - BUCKETS.bit_length() + 1)
    return out, first


@dataclass
class Model:
    tables: np.ndarray  # (tables, BUCKETS, SIZE)
    filters: list[np.ndarray]  # per width (width, SIZE, FILTERS)
    bias: list[np.ndarray]
    out: np.ndarray
    shift: float

    def rows(self) -> np.ndarray:
        """All weights as rows of SIZE numbers."""
        last = np.zeros((-(-len(self.out) // SIZE), SIZE), np.float32)
        last.ravel()[: len(self.out)] = self.out
        return np.concatenate([self.tables.reshape(-1, SIZE), *[f.reshape(-1, SIZE) for f in [*self.filters, *self.bias]], last])

    @staticmethod
    def of(rows: np.ndarray, shift: float = 0.0) -> Model:
        """The model whose weights are these rows."""
        flat_rows, at = rows.astype(np.float32).ravel(), 0

        def take(*shape: int) -> np.ndarray:
            nonlocal at
            part = flat_rows[at : at + int(np.prod(shape))].reshape(shape)
            at += part.size
            return part

        tables = take(1 + len(BEGINNINGS), BUCKETS, SIZE)
        filters = [take(w, SIZE, FILTERS) for w in WIDTHS]
        return Model(tables, filters, [take(FILTERS) for _ in WIDTHS], take(FILTERS * len(WIDTHS) + 1), shift)

    def embed(self, buckets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Embeddings of all words, each text followed by _PAD empty ones; and where each text's windows start and end.

        A text without words has one window, of empty places alone.
        """
        n = len(first) - 1
        at = first[:-1] + _PAD * np.arange(n)
        x = np.zeros((len(buckets) + _PAD * n, SIZE), np.float32)
        rows = np.arange(len(buckets)) + _PAD * np.repeat(np.arange(n), np.diff(first))
        total = self.tables[0][buckets[:, 0]]
        for t in range(1, len(self.tables)):
            total += self.tables[t][buckets[:, t]]
        x[rows] = total
        return x, np.stack([at, at + np.maximum(1, np.diff(first))], axis=1)

    def convolve(self, x: np.ndarray, k: int) -> np.ndarray:
        """Filter values of the windows that start at each place."""
        weights, n = self.filters[k], len(x)
        y = x @ weights[0]
        for j in range(1, len(weights)):
            y[: n - j] += x[j:] @ weights[j]
        return y + self.bias[k]

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        x, at = self.embed(buckets, first)
        pooled = [np.maximum(np.maximum.reduceat(self.convolve(x, k), at.ravel(), axis=0)[::2], 0) for k in range(len(WIDTHS))]
        return np.concatenate(pooled, axis=1) @ self.out[:-1] + self.out[-1]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """A number from 0 to 1 for each text, the likelier the toxic label the higher. Whole texts."""
        out = np.empty(len(offsets) - 1)
        for i, j in steps(offsets, _CHUNK):
            z = self.logits(*features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            out[i:j] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64) + self.shift, -40, 40)))
        return out


def _seen(buckets: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """In how many clean and toxic texts each bucket of each table is met: (tables, 2, BUCKETS)."""
    seen = np.zeros((1 + len(BEGINNINGS), 2, BUCKETS))
    for b, label in zip(buckets, y, strict=True):
        for t in range(len(seen)):
            seen[t, label, np.unique(b[:, t])] += 1
    return seen


def _start(seen: np.ndarray, texts: np.ndarray, rng: np.random.Generator) -> Model:
    """Random weights, but an embedding's first number says how much oftener the bucket is met in toxic texts.

    `texts` are the numbers of clean and of toxic texts in which `seen` was counted.
    """
    tables = rng.standard_normal((1 + len(BEGINNINGS), BUCKETS, SIZE), dtype=np.float32) * np.float32(0.05)
    for t in range(len(tables)):
        rate = (seen[t] + 5) / (texts[:, None] + 10)
        tables[t, :, 0] = np.where(seen[t].sum(axis=0) >= 3, np.log(rate[1] / rate[0]), 0) / len(tables)
    filters = [(rng.standard_normal((w, SIZE, FILTERS)) * 0.2).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[0, 0, : FILTERS // 2] = 1.0
    bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    return Model(tables, filters, bias, (rng.standard_normal(FILTERS * len(WIDTHS) + 1) * 0.1).astype(np.float32), 0.0)


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, {}, {}

    def step(self, name: object, value: np.ndarray, grad: np.ndarray) -> None:
        m = self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * grad
        v = self.v[name] = 0.999 * self.v.get(name, 0) + 0.001 * grad**2
        value -= self.rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)


class _Descent:
    """Logistic loss; gradients flow through each filter's highest place in a text."""

    def __init__(self, model: Model, pace: float = 1.0):
        self.model, self.pace, self.adam = model, pace, _Adam(0.01 * pace)
        self.squares = np.full(model.tables.shape[:2], 1e-6, np.float32)

    def step(self, buckets: list[np.ndarray], y: np.ndarray) -> None:
        """Move the weights by the gradient over some texts."""
        model, adam = self.model, self.adam
        first = np.concatenate([[0], np.cumsum([len(b) for b in buckets])])
        words = np.concatenate(buckets)
        x, at = model.embed(words, first)
        pooled, places = [], []
        for k in range(len(WIDTHS)):
            conv = model.convolve(x, k)
            place = np.stack([a + conv[a:b].argmax(axis=0) for a, b in at])
            places.append(place)
            pooled.append(np.maximum(np.take_along_axis(conv, place, axis=0), 0))
        h = np.concatenate(pooled, axis=1)
        p = 1 / (1 + np.exp(-np.clip(h @ model.out[:-1] + model.out[-1], -30, 30)))
        dz = ((p - y) / len(y)).astype(np.float32)
        adam.t += 1
        dh = np.outer(dz, model.out[:-1]) * (h > 0)
        adam.step("out", model.out, np.append(h.T @ dz, dz.sum()) + 1e-4 * model.out)
        row_of = np.full(len(x), -1)  # the word at each place, -1 for the empty ones
        row_of[np.arange(len(words)) + _PAD * np.repeat(np.arange(len(y)), np.diff(first))] = np.arange(len(words))
        hit, grads = [], []
        for k, w in enumerate(WIDTHS):
            d = dh[:, k * FILTERS : (k + 1) * FILTERS]
            weights = model.filters[k]
            change = np.empty_like(weights)
            for j in range(w):
                spot = np.minimum(places[k] + j, len(x) - 1)
                change[j] = np.einsum("df,dfs->sf", d, x[spot])
                hit.append(row_of[spot].ravel())
                grads.append((d[:, :, None] * weights[j].T[None]).reshape(-1, SIZE))
            adam.step(("bias", k), model.bias[k], d.sum(axis=0))
            adam.step(("filters", k), weights, change)
        hit, grad = np.concatenate(hit), np.concatenate(grads)
        used = (hit >= 0) & (grad != 0).any(axis=1)
        hit, back = np.unique(hit[used], return_inverse=True)
        total = np.zeros((len(hit), SIZE), np.float32)
        np.add.at(total, back, grad[used])
        for t in range(len(model.tables)):
            b, back = np.unique(words[hit, t], return_inverse=True)
            g = np.zeros((len(b), SIZE), np.float32)
            np.add.at(g, back, total)
            self.squares[t, b] += (g**2).mean(axis=1)
            model.tables[t, b] -= 0.02 * self.pace * g / np.sqrt(self.squares[t, b])[:, None]


def train(
    buckets: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED, seen: np.ndarray | None = None, texts: np.ndarray | None = None
) -> Model:
    """Descend from a start that `seen` in `texts` gives, or without it the rows themselves."""
    rng = np.random.default_rng(seed)
    if seen is None:
        seen, texts = _seen(buckets, y), np.bincount(y, minlength=2)
    model = _start(seen, texts, rng)
    descent = _Descent(model)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), BATCH):
            own = order[lo : lo + BATCH]
            descent.step([buckets[i] for i in own], y[own])
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Classifier:
    model: Model
    thresholds: dict[str | None, float]  # by language, each row scored by weights that it did not move
    threshold: float

    def score(self, text: Column) -> Column:
        """The score of a text; null counts as empty."""
        model = self.model

        @F.arrow_udf("double")
        def run(texts: pa.Array) -> pa.Array:
            return pa.array(model.scores(*flat(texts)))

        return run(F.coalesce(text, F.lit("")))

    def toxic(self, score: Column, lang: Column) -> Column:
        """Whether a score reaches its language's threshold."""
        limit = F.lit(self.threshold)
        for name, value in self.thresholds.items():
            limit = F.when(lang.eqNullSafe(F.lit(name)), F.lit(value)).otherwise(limit)
        return score >= limit


def _best(score: np.ndarray, y: np.ndarray, default: float, n: np.ndarray | None = None) -> float:
    """The threshold of the best F1; of equally good ones the default, else the middle of the nearest gap.

    Each score stands for `n` rows, or for one.
    """
    n = np.ones(len(y), np.int64) if n is None else n
    toxic = (n * y).sum()
    if toxic < 5 or n.sum() - toxic < 5:
        return default
    cuts = np.unique(score)
    cuts = np.unique(np.concatenate([(cuts[1:] + cuts[:-1]) / 2, [default]]))
    order = np.argsort(score, kind="stable")
    above = np.searchsorted(score[order], cuts, side="left")  # rows from here on reach the cut
    hits, predicted = (np.append(np.cumsum((n * w)[order][::-1])[::-1], 0)[above] for w in (y, np.ones_like(y)))
    f1 = 2 * hits / np.maximum(1, predicted + toxic)
    best = cuts[f1 >= f1.max() - 1e-12]
    return float(best[np.argmin(np.abs(best - default))])


#: What tasks send: of a model's row of weights, how many texts moved it and by how much, or what was counted.
_SENT = pa.schema([("model", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), *[(f"v{i}", pa.int64()) for i in range(SIZE)]])
_SENT_SQL = ", ".join(["model int", "key long", "n long", *[f"v{i} long" for i in range(SIZE)]])
#: Model 0 learns from all rows; models 1 and 2 leave out those of fold 0 and fold 1.
_MODELS = 3
_UNIT = 1 << 10  # changes are sent in whole units, so that their sums do not depend on the order


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """Buckets of each text, labels and folds, some texts at a time."""
    for batch in batches:
        data, at = flat(batch["text"])
        y, fold = batch["toxic"].to_numpy().astype(int), batch["fold"].to_numpy()
        for i, j in steps(at, _CHUNK):
            buckets, first = features(data[at[i] : at[j]], at[i : j + 1] - at[i])
            yield [buckets[a:b] for a, b in zip(first, first[1:], strict=False)], y[i:j], fold[i:j]


def _own(fold: np.ndarray, m: int) -> np.ndarray:
    """The rows that model m learns from."""
    return np.arange(len(fold)) if m == 0 else np.flatnonzero(fold != m - 1)


def _sent(m: int, keys: np.ndarray, n: int, values: np.ndarray) -> pa.RecordBatch:
    wide = np.zeros((len(keys), SIZE), np.int64)
    wide[:, : values.shape[1]] = values
    columns = {"model": np.full(len(keys), m, np.int32), "key": keys, "n": np.full(len(keys), n)}
    return as_batch(columns | {f"v{i}": np.ascontiguousarray(wide[:, i]) for i in range(SIZE)}, _SENT)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many clean and toxic texts buckets are met, by fold; the last key counts the texts."""
    met, texts = [np.zeros((1 + len(BEGINNINGS), 2, BUCKETS)) for _ in range(2)], np.zeros((2, 2), np.int64)
    for buckets, y, fold in _texts(batches):
        for f in (0, 1):
            own = np.flatnonzero(fold == f)
            met[f] += _seen([buckets[i] for i in own], y[own])
            texts[f] += np.bincount(y[own], minlength=2)
    for f in (0, 1):
        counts = np.append(met[f].swapaxes(1, 2).reshape(-1, 2), texts[f][None], axis=0)
        keys = np.flatnonzero(counts.any(axis=1))
        yield _sent(f, keys, 0, counts[keys].astype(np.int64))


def _descend(begin: np.ndarray, pace: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """How far the rows of a task move each model from where all tasks begin, half-precision weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        descents, n = [_Descent(Model.of(b), pace) for b in begin], [0] * _MODELS
        for buckets, y, fold in _texts(batches):
            for m, descent in enumerate(descents):
                own = _own(fold, m)
                n[m] += len(own)
                for lo in range(0, len(own), BATCH):
                    some = own[lo : lo + BATCH]
                    descent.step([buckets[i] for i in some], y[some])
        for m, descent in enumerate(descents):
            change = descent.model.rows().astype(np.float64) - begin[m].astype(np.float64)
            keys = np.flatnonzero(change.any(axis=1))
            yield _sent(m, keys, n[m], np.rint(change[keys] * n[m] * _UNIT).astype(np.int64))

    return run


def _summed(
    work: Work, rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], values: list[Column]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """What all tasks send, summed up by Spark: model, keys and values, one model at a time, which is all the driver holds."""
    sent = rows.mapInArrow(run, _SENT_SQL).groupBy("model", "key").agg(*[F.sum(c).alias(c) for c in _SENT.names[2:]])
    kept = work.keep(sent.select("model", "key", *[v.alias(f"v{i}") for i, v in enumerate(values)]), "sums")  # what was shuffled goes with the step
    for m in range(_MODELS):
        got = kept.where(F.col("model") == m).drop("model").toArrow()
        yield m, got["key"].to_numpy(), np.stack([got[f"v{i}"].to_numpy() for i in range(len(values))], axis=1)
    work.drop(kept)


def _labelled(work: Work, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All rows that labels are learned from (text, lang, toxic, fold), written once, dealt to files of mixed rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = work.keep(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "known")  # its size is known to the join
    parts = min(REPLICAS, max(1, -(-known.count() // REPLICA_ROWS)))
    own = F.xxhash64("doc_id")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang").join(known, "doc_id")
    rows = rows.select("text", "lang", "toxic", own.alias("place"), F.pmod(own, F.lit(2)).cast("int").alias("fold"))
    dealt = rows.repartition(parts, "place", "text").sortWithinPartitions("place", F.xxhash64("text"))
    return work.keep(dealt, "labelled")


def _beginning(rows: DataFrame, fit_rows: int, epochs: int, seed: int, met: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the models begin: from counts over all rows and, where fit_rows are asked for, a few rows gone through many times."""
    if not fit_rows:
        out = []
        for m in range(_MODELS):
            folds = [f for f in (0, 1) if f != m - 1]
            number = texts[folds].sum(axis=0)
            model = _start(met[folds].sum(axis=0), number, np.random.default_rng(seed))
            model.out[-1] += _logit(number[1] / max(1, number.sum()))
            out.append(model.rows())
        return np.stack(out)
    short = rows.where(F.octet_length("text") <= FIT_BYTES)
    drawn = [short.where(F.col("toxic") == c).orderBy("place", F.xxhash64("text")).limit(fit_rows // 2) for c in (0, 1)]
    got = drawn[0].unionByName(drawn[1]).select("text", "toxic", "fold", "place").toArrow().sort_by("place").combine_chunks().to_batches()
    some = list(_texts(iter(got)))
    per = [b for buckets, _, _ in some for b in buckets]
    y, fold = (np.concatenate([np.zeros(0, int), *[part[k] for part in some]]) for k in (1, 2))
    out = []
    for m in range(_MODELS):
        own = _own(fold, m)
        folds = [f for f in (0, 1) if f != m - 1]
        seen, number = met[folds].sum(axis=0), texts[folds].sum(axis=0)
        model = train([per[i] for i in own], y[own], epochs, seed, seen, number)
        # From the drawn rows' share of toxic ones to that of all.
        if len(own):
            model.out[-1] += _logit(number[1] / number.sum()) - _logit(y[own].mean())
        out.append(model.rows())
    return np.stack(out)


def _thresholds(work: Work, rows: DataFrame, weights: np.ndarray) -> tuple[dict[str | None, float], float]:
    """The best thresholds by language and of all, from every row's score by the model that left its fold out."""

    models: list[Model] = []  # made in the task: half as much to send

    @F.arrow_udf("double")
    def unseen(texts: pa.Array, folds: pa.Array) -> pa.Array:
        models.extend(Model.of(w) for w in weights[len(models) :])
        fold, out = folds.to_numpy(zero_copy_only=False), np.empty(len(folds))
        for f in (0, 1):
            own = np.flatnonzero(fold == f)
            out[own] = models[f].scores(*flat(texts.take(pa.array(own))))
        return pa.array(out)

    scored = rows.select("lang", "toxic", unseen("text", "fold").alias("score"))
    # Rows of nearly one score and of one label count together; the default threshold parts no such group.
    near = F.floor((F.ln("score") - F.log1p(-F.col("score"))) * BINS)
    groups = scored.groupBy("lang", "toxic", (F.col("score") >= THRESHOLD).alias("high"), near.alias("near"))
    groups = work.keep(groups.agg(F.avg("score").alias("score"), F.count("*").alias("n")), "scores")
    enough = [F.sum(F.when(F.col("toxic") == c, F.col("n"))).alias(f"n{c}") for c in (0, 1)]
    langs = groups.groupBy("lang").agg(*enough).where("n0 >= 5 and n1 >= 5").select("lang").toArrow()["lang"].to_pylist()
    of_all = groups.groupBy("toxic", "high", "near").agg((F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("score"), F.sum("n").alias("n"))

    def best(found: DataFrame, default: float) -> float:
        got = found.select("score", "toxic", "n").toArrow()
        return _best(got["score"].to_numpy(), got["toxic"].to_numpy().astype(int), default, got["n"].to_numpy())

    pooled = best(of_all, THRESHOLD)
    return {name: best(groups.where(F.col("lang").eqNullSafe(F.lit(name))), pooled) for name in langs}, pooled


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 0, epochs: int = EPOCHS, seed: int = SEED) -> Classifier:
    """Learn from all labelled rows of docs (doc_id, text, lang) that are not held out, whatever their length.

    How often words are met in toxic texts is counted over all of them, and the weights begin there. Then each task goes
    through all its rows and the tasks' weights are averaged, `epochs` times at full pace and PASSES times at a falling one.
    With fit_rows, the first `epochs` rounds go over at most so many rows, chosen by a hash, alone. Thresholds come from all rows, too: two more models leave out one half of the rows each, and
    every row is scored by the one that has not seen it. Null doc_ids and null labels are passed over; of several labels
    of one document the greatest counts. Without rows of both classes every score is the share of toxic labels, and no
    threshold is reached. Scores use texts alone; languages only choose among thresholds.
    """
    work = Work(docs.sparkSession, "toxicity")
    rows = _labelled(work, docs, labels)
    counts = np.zeros((_MODELS, (1 + len(BEGINNINGS)) * BUCKETS + 1, 2))
    for fold, key, values in _summed(work, rows, _count, [F.col("v0"), F.col("v1")]):
        counts[fold, key] = values
    counts = counts[:2]
    texts = counts[:, -1]
    met = counts[:, :-1].reshape(2, -1, BUCKETS, 2).swapaxes(2, 3)
    if not texts.sum(axis=0).all():
        share = texts[:, 1].sum() / max(1, texts.sum())
        return Classifier(Model.of(np.zeros_like(_start(met[0], texts[0], np.random.default_rng(seed)).rows()), _logit(share)), {}, 2.0)
    models = _beginning(rows, fit_rows, epochs, seed, met, texts)
    moved = [(F.col(f"v{i}") / (F.col("n") * _UNIT)).cast("float") for i in range(SIZE)]
    for turn in range(1 if fit_rows else 1 - epochs, 1 + PASSES):
        begin = models.astype(np.float16)
        models[:] = begin
        for m, key, values in _summed(work, rows, _descend(begin, 1 / max(1, turn)), moved):
            models[m, key] += values
    # With too few rows of a class a model that leaves out their fold would tell nothing.
    by, pooled = _thresholds(work, rows, models[1:].astype(np.float16)) if texts.min() >= 3 else ({}, THRESHOLD)
    work.drop(rows)
    return Classifier(Model.of(models[0]), by, pooled)


def _logit(p: float) -> float:
    p = min(max(p, 1e-3), 1 - 1e-3)
    return float(np.log(p / (1 - p)))
