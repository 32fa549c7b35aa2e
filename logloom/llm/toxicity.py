"""Toxicity by a convolutional classifier over hashed word embeddings.

A word's embedding is the sum of two hashed vectors, one of the whole word and one
of its first four letters. Filters of several widths run over the words of a text,
the maximum of each filter over all places goes into a logistic layer. Because the
filters are linear in the embeddings, a word's share in every filter is computed
once per task and then looked up, and whole texts of any length are scored in
slices. A second, additive output guesses the language from the same words; each
language has its own threshold, fitted on rows the filters have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.language import held_out

#: Score at which a text counts as toxic; each language's threshold is moved here.
CUT = 0.7
#: Words scored at once, and words whose filter shares a task keeps.
SLICE, MEMO = 1 << 16, 1 << 17
#: Largest logit told apart where thresholds are fitted, and steps per unit.
LOGITS, STEPS = 30, 100

_words = regex.compile(r"\w+").findall


@dataclass(frozen=True)
class Shape:
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    dim: int = 8
    word_buckets: int = 1 << 16
    start_buckets: int = 1 << 13

    @property
    def total(self) -> int:
        return self.filters * len(self.widths)


def words(text: str | None) -> list[str]:
    return _words(text.lower()) if text else []


def buckets(items: list[str], shape: Shape) -> np.ndarray:
    """Rows of the embedding table for each word: of the word and of its start. Row 0 is padding."""
    whole = np.fromiter((xxhash.xxh3_64_intdigest(w) % shape.word_buckets for w in items), np.int64, len(items))
    start = np.fromiter((xxhash.xxh3_64_intdigest("^" + w[:4]) % shape.start_buckets for w in items), np.int64, len(items))
    return np.stack([whole + 1, start + 1 + shape.word_buckets], axis=1)


@dataclass
class ToxicModel:
    shape: Shape
    embedding: np.ndarray
    taps: dict[int, np.ndarray]  # width -> (width, dim, filters)
    bias: np.ndarray
    weight: np.ndarray
    offset: float
    langs: list[str] = field(default_factory=list)
    lang_scores: np.ndarray | None = None  # word bucket x language
    shifts: np.ndarray | None = None  # per language, added to the logit

    def shares(self, rows: np.ndarray) -> np.ndarray:
        """Contribution of each word to every tap of every filter, and to every language."""
        vectors = self.embedding[rows[:, 0]] + self.embedding[rows[:, 1]]
        parts = [vectors @ self.taps[w][i] for w in self.shape.widths for i in range(w)]
        if self.langs:
            parts.append(self.lang_scores[rows[:, 0]])
        return np.concatenate(parts, axis=1).astype(np.float32)

    def pooled(self, shares: np.ndarray) -> np.ndarray:
        """Maximum of each filter over the places of a padded text, before the bias."""
        out, column, size = [], 0, self.shape.filters
        for width in self.shape.widths:
            count = len(shares) - width + 1
            places = shares[:count, column : column + size].copy()
            for i in range(1, width):
                places += shares[i : i + count, column + i * size : column + (i + 1) * size]
            out.append(places.max(axis=0))
            column += width * size
        return np.concatenate(out)

    def logit(self, pooled: np.ndarray) -> float:
        return float(np.maximum(pooled + self.bias, 0) @ self.weight + self.offset)


class Scorer:
    """Scores whole texts; keeps the shares of the words it has met, up to ``MEMO``."""

    def __init__(self, model: ToxicModel):
        self.model, self.pad = model, max(model.shape.widths) - 1
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.table = self.model.shares(np.zeros((1, 2), np.int64))
        if self.model.langs:
            self.table[0, -len(self.model.langs) :] = 0

    def _places(self, items: list[str]) -> np.ndarray:
        if len(self.place) > MEMO:
            self._reset()
        known = self.place
        new = [w for w in dict.fromkeys(items) if w not in known]
        if new:
            for w in new:
                known[w] = len(known) + 1
            self.table = self.table if len(self.table) > len(known) else np.concatenate(
                [self.table, np.zeros((max(len(known), len(self.table)), self.table.shape[1]), np.float32)]
            )
            self.table[len(known) - len(new) + 1 : len(known) + 1] = self.model.shares(buckets(new, self.model.shape))
        return np.fromiter(map(known.__getitem__, items), np.int64, len(items))

    def _parts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Pooled filters and language totals of a text, slice by slice."""
        items, pad, langs = words(text), self.pad, len(self.model.langs)
        best, totals = None, np.zeros(langs)
        for start in range(0, max(1, len(items)), SLICE):
            places = self._places(items[start : start + SLICE + pad])
            shares = self.table[np.concatenate([np.zeros(pad, np.int64), places, np.zeros(pad, np.int64)])]
            if start:
                shares = shares[pad:]
            if start + SLICE < len(items):
                shares = shares[:-pad] if pad else shares
            pooled = self.model.pooled(shares)
            best = pooled if best is None else np.maximum(best, pooled)
            if langs:
                inside = self.table[places[:SLICE], -langs:]
                totals += inside.sum(axis=0, dtype=np.float64)
        return best, totals

    def raw(self, text: str | None) -> tuple[float, int]:
        """Logit before calibration and index of the guessed language."""
        pooled, totals = self._parts(text)
        return self.model.logit(pooled), int(np.argmax(totals)) if len(totals) else 0

    def score(self, text: str | None) -> float:
        logit, lang = self.raw(text)
        if self.model.shifts is not None and len(self.model.shifts):
            logit += self.model.shifts[lang]
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def _train(texts: list[np.ndarray], labels: np.ndarray, shape: Shape, epochs: int, batch: int, rate: float) -> ToxicModel:
    """Fit by Adam; only the words under each filter's maximum get a gradient."""
    rng = np.random.default_rng(3)
    total = 1 + shape.word_buckets + shape.start_buckets
    params = {
        "E": rng.normal(0, 0.1, (total, shape.dim)).astype(np.float32),
        "b": np.zeros(shape.total, np.float32),
        "v": rng.normal(0, 0.3, shape.total).astype(np.float32),
        "c": np.full(1, -1.0, np.float32),
    }
    params["E"][0] = 0
    for w in shape.widths:
        params[f"W{w}"] = rng.normal(0, 0.5 / np.sqrt(w), (w, shape.dim, shape.filters)).astype(np.float32)
    first = {k: np.zeros_like(p) for k, p in params.items()}
    second = {k: np.zeros_like(p) for k, p in params.items()}
    pad, step = max(shape.widths) - 1, 0
    zeros = np.zeros((pad, 2), np.int64)
    weight = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    padded = [np.concatenate([zeros, t, zeros]) for t in texts]
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), batch):
            chosen, grads = order[start : start + batch], {k: np.zeros_like(p) for k, p in params.items() if k != "E"}
            touched, pulls = [], []
            for doc in chosen:
                rows = padded[doc]
                vectors = params["E"][rows[:, 0]] + params["E"][rows[:, 1]]
                tops, spots = [], []
                for w in shape.widths:
                    count = len(vectors) - w + 1
                    places = sum(vectors[i : i + count] @ params[f"W{w}"][i] for i in range(w))
                    at = places.argmax(axis=0)
                    spots.append(at)
                    tops.append(places[at, np.arange(shape.filters)])
                z = np.concatenate(tops) + params["b"]
                active = np.maximum(z, 0)
                logit = active @ params["v"] + params["c"][0]
                error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[doc]) * weight[doc] / len(chosen)
                grads["v"] += error * active
                grads["c"] += error
                dz = error * params["v"] * (z > 0)
                grads["b"] += dz
                for k, w in enumerate(shape.widths):
                    part = dz[k * shape.filters : (k + 1) * shape.filters]
                    for i in range(w):
                        under = spots[k] + i
                        grads[f"W{w}"][i] += vectors[under].T * part
                        pull = part[:, None] * params[f"W{w}"][i].T
                        for side in (0, 1):
                            touched.append(rows[under, side])
                            pulls.append(pull)
            step += 1
            rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            dense = np.zeros((len(rows), shape.dim), np.float32)
            np.add.at(dense, inverse, np.concatenate(pulls))
            dense[rows == 0] = 0
            for k, g in [*grads.items(), ("E", dense)]:
                at = rows if k == "E" else slice(None)
                first[k][at] = 0.9 * first[k][at] + 0.1 * g
                second[k][at] = 0.999 * second[k][at] + 0.001 * g * g
                scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                params[k][at] -= scale * first[k][at] / (np.sqrt(second[k][at]) + 1e-8)
    taps = {w: params[f"W{w}"] for w in shape.widths}
    return ToxicModel(shape, params["E"], taps, params["b"], params["v"], float(params["c"][0]))


def _threshold(logits: np.ndarray, clean: np.ndarray, toxic: np.ndarray) -> float:
    """Logit between the two classes with the fewest errors; the middle of the widest such gap.

    ``clean`` and ``toxic`` count the rows of either class at each of the distinct ``logits``.
    """
    order = np.argsort(logits)
    z, no, yes = logits[order], clean[order], toxic[order]
    errors = np.concatenate([[0], np.cumsum(yes)]) + (no.sum() - np.concatenate([[0], np.cumsum(no)]))
    edges = np.concatenate([[z[0] - 2], (z[1:] + z[:-1]) / 2, [z[-1] + 2]])
    gaps = np.concatenate([[0], np.diff(z), [0]])
    best = np.flatnonzero(errors == errors.min())
    return float(edges[best[np.argmax(gaps[best])]])


def _counted(docs: DataFrame, marks: DataFrame, model: ToxicModel) -> DataFrame:
    """``(lang, place, clean, toxic)``: rows of ``docs(doc_id, text)`` that ``marks(doc_id, toxic)`` knows, per language and logit.

    Texts are scored where they lie; only ids, languages and logits move to the labels.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.raw(text) for text in batch["text"]]
            places = [round(min(max(z, -LOGITS), LOGITS) * STEPS) for z, _ in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": [g for _, g in found], "place": places})

    kind = dict(docs.dtypes)["doc_id"]
    scored = docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, lang int, place int").join(marks, "doc_id")
    return scored.groupBy("lang", "place").agg(F.count_if(F.col("toxic") == 0).alias("clean"), F.count_if(F.col("toxic") == 1).alias("toxic"))


def _judged(rows: tuple[DataFrame, DataFrame], model: ToxicModel) -> pd.DataFrame:
    """Rows of either class per guessed language and logit, at most ``2 * LOGITS * STEPS`` logits each.

    Every labelled row of ``rows``, documents and marks as in ``_counted``, is scored and counted, in tasks.
    """
    return _counted(*rows, model).toPandas().sort_values(["lang", "place"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    shape: Shape = Shape(),
    rows_per_label: int = 2500,
    max_chars: int = 20_000,
    epochs: int = 6,
) -> ToxicModel | None:
    """Train on a bounded sample of the labelled rows that are not held out; thresholds from all others of these.

    At most ``rows_per_label`` ids of each label, chosen by a hash of the id, with
    their texts of up to ``max_chars`` characters: the bound holds at every size, and
    the same rows are taken on every run. A fifth of them is not trained on: with all
    labelled rows that were not taken it sets the thresholds per language, so these
    come from every row that is neither held out nor trained on. Null labels, ids and texts are passed over. None if a label is missing.
    """
    marks = labels.where("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    samples = [
        marks.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_label) for label in (0, 1)
    ]
    known = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", "text", "lang")
    # twice rows_per_label ids at most, so the texts need not move
    rows = sorted(known.join(F.broadcast(samples[0].union(samples[1])), "doc_id").collect(), key=lambda r: (xxhash.xxh3_64_intdigest(str(r.doc_id)), r.text))
    toxic = np.array([r.toxic for r in rows], float)
    if not len(rows) or toxic.min() == toxic.max():
        return None
    texts = [buckets(words(r.text), shape) for r in rows]
    spare = np.arange(len(rows)) % 5 == 0
    fitted, judged = np.flatnonzero(~spare), np.flatnonzero(spare)
    if toxic[fitted].min() == toxic[fitted].max():
        fitted = judged = np.arange(len(rows))
    model = _train([texts[i] for i in fitted], toxic[fitted], shape, epochs, 32, 0.01)

    model.langs = sorted({r.lang for r in rows if r.lang})
    counts = np.full((len(model.langs), model.embedding.shape[0]), 0.1)
    for row, text in zip(rows, texts):
        if row.lang and len(text):
            np.add.at(counts[model.langs.index(row.lang)], text[:, 0], 1)
    model.lang_scores = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)
    trained = {rows[i].doc_id for i in fitted} if len(judged) < len(rows) else set()
    learned = F.broadcast(docs.sparkSession.createDataFrame([(i,) for i in trained], marks.select("doc_id").schema))
    others = docs.where(F.col("text").isNotNull() & ~held_out("doc_id")).select("doc_id", "text")
    found = _judged((others.join(learned, "doc_id", "left_anti"), marks), model)
    whole = found.groupby("place", as_index=False)[["clean", "toxic"]].sum()

    def cut(counts: pd.DataFrame) -> float:
        return _threshold(counts["place"].to_numpy() / STEPS, counts["clean"].to_numpy(), counts["toxic"].to_numpy())

    overall = cut(whole) if len(whole) else 0.0
    shifts = []
    for lang in range(max(1, len(model.langs))):
        mine = found[found["lang"] == lang]
        enough = min(mine["clean"].sum(), mine["toxic"].sum()) >= 5
        shifts.append(np.log(CUT / (1 - CUT)) - (cut(mine) if enough else overall))
    model.shifts = np.array(shifts)
    return model


def classify(docs: DataFrame, model: ToxicModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)`` of every row, from its whole text alone.

    A null or empty text is scored as a text of no words. Without a model (no
    labels of both kinds) every score is 0. Repeated rows repeat the result, null
    ids are kept and not held out, no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value) if shared.value is not None else None
        for batch in batches:
            scores = np.array([scorer.score(text) if scorer else 0.0 for text in batch["text"]], float)
            yield pd.DataFrame(
                {"id": batch["id"], "held_out": batch["held_out"], "score": scores, "predicted": (scores >= CUT).astype("int32")}
            )

    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
