"""Toxicity by multiple-instance learning.

A document is toxic if any of its sentences is: sentence probabilities are combined by noisy-or and
fitted to document labels alone. Sentences are then scored by themselves, which locates the offending ones.
A sentence counts by what its features add to an empty one, so that length alone adds nothing; what is toxic
without any feature is one leak term per document.
"""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from formbook.llm.common import other_columns, quoted, row_columns, row_of, schema_after, staged
from formbook.llm.scan import slices

TRAIN_DOCS = 20_000  # distinct labelled texts used for fitting, chosen by hash
FEATURES = 4_000  # words and word beginnings in the model
MIN_DOCS = 4  # training documents a feature must occur in
STEMS = (4, 5, 6, 7)  # lengths of word beginnings
ROUNDS = 300
THRESHOLD = 0.7
RATE, PENALTY = 0.3, 0.05
LEAST_Z = 3.5  # standard errors by which a feature must be commoner in toxic documents
START = 0.5  # of a feature's log odds, where its weight starts
BIAS = -4.0  # logit of a sentence before its features are added; what it has there does not count

_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[str]:
    return [s.strip() for s in _SENTENCE.split(text) if s.strip()]


def features(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word + "$", *(word[:n] for n in STEMS if len(word) > n)]


@dataclass(frozen=True)
class NoisyOr:
    """Weights of features, and the leak of a document (a logit)."""

    weights: dict[str, float]
    leak: float

    def _sentence_hazards(self, text: str, memo: dict[str, tuple]) -> list[tuple[str, float]]:
        """Sentences and minus the log of their chance to be clean; 0 without features."""
        out, z = [], []
        for s in sentences(text):
            seen: set[str] = set()
            total = BIAS
            for w in _WORD.findall(s.lower()):
                known = memo.get(w)
                if known is None:
                    known = tuple(f for f in features(w) if f in self.weights)
                    if len(memo) > 200_000:
                        memo.clear()
                    memo[w] = known
                for f in known:
                    if f not in seen:
                        seen.add(f)
                        total += self.weights[f]
            out.append(s)
            z.append(total)
        return list(zip(out, hazard(np.array(z, np.float64))))

    def score(self, text: str, memo: dict[str, tuple]) -> float:
        """Noisy-or over the leak and the sentences."""
        total = np.logaddexp(0, self.leak) + np.sum([h for _, h in self._sentence_hazards(text, memo)])
        return float(-np.expm1(-total))

    def offending(self, text: str, memo: dict[str, tuple], least: float) -> list[str]:
        edge = -np.log1p(-least)
        return [s for s, h in self._sentence_hazards(text, memo) if h >= edge]


def hazard(z: np.ndarray) -> np.ndarray:
    return np.maximum(np.logaddexp(0, z) - np.logaddexp(0, BIAS), 0)


def _fit(rows: list[tuple[int, int, list[list[int]]]], names: list[str], start: np.ndarray) -> NoisyOr:
    """Adam on the noisy-or likelihood, from ``start``. ``rows`` has a label, a number of copies and the feature numbers of each sentence that has any."""
    y = np.array([r[0] for r in rows], np.float64)
    share = np.array([r[1] for r in rows], np.float64)
    total = share.sum()
    doc = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
    cells = [s for r in rows for s in r[2]]
    row = np.repeat(np.arange(len(cells)), list(map(len, cells)))
    column = np.array([f for s in cells for f in s], np.int64)
    w, leak = start.copy(), -4.0
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for t in range(1, ROUNDS + 1):
        z = BIAS + np.bincount(row, w[column], len(cells))
        p, leaking = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-leak))
        clean = np.exp(-np.logaddexp(0, leak) - np.bincount(doc, hazard(z), len(rows)))
        toxic = np.maximum(1 - clean, 1e-9)
        pull = np.where(y > 0, -clean / toxic, 1.0) * share / total
        g = pull[doc] * p * (z > BIAS)
        grad = np.append(np.bincount(column, g[row], len(names)) + PENALTY * w / total, pull.sum() * leaking)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, leak = w - step[:-1], leak - step[-1]
    return NoisyOr({n: float(x) for n, x in zip(names, w) if abs(x) > 1e-3}, float(leak))


def fit(labelled: DataFrame, text: str = "text", label: str = "label", train_docs: int = TRAIN_DOCS) -> NoisyOr:
    """Fit on ``text`` and ``label`` (0 or 1; null labels are left out), a row ``copies`` times if there is such a column.

    At most ``train_docs`` distinct texts with their label, those with the smallest text hash, are used, weighted by their copies; that
    and the number of features bound what the driver holds. Features are picked by how much oftener they occur in toxic documents.
    With one class only, the model gives every text the same score, 0 or 1.
    """
    copies = F.col("copies") if "copies" in labelled.columns else F.lit(1)
    rows = labelled.select(
        F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("y"), copies.cast("long").alias("copies")
    )
    rows = rows.filter(F.col("y").isNotNull()).groupBy("text", "y").agg(F.sum("copies").alias("copies"))
    rows = rows.orderBy(F.xxhash64("text"), "y", "text").limit(train_docs)
    rows = rows.repartition(max(1, train_docs // 500)).cache()
    totals = rows.agg(F.sum("copies").alias("n"), F.sum(F.col("y") * F.col("copies")).alias("toxic")).first()
    n, toxic = totals["n"], totals["toxic"] or 0
    if not n or toxic in (0, n):
        return NoisyOr({}, 30.0 if n and toxic == n else -30.0)

    def occurring(batches):
        for batch in slices(batches):
            for body, y, n in zip(*(c.to_pylist() for c in batch.columns)):
                found = {f for w in set(_WORD.findall(body.lower())) for f in features(w)}
                if found:
                    columns = [pa.array(list(found)), pa.array([y * n] * len(found), pa.int64()), pa.array([n] * len(found), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["f", "toxic", "n"])

    counts = rows.mapInArrow(occurring, "f string, toxic long, n long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    # Log odds against the base rate, in units of their standard error.
    odds = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5)) - float(np.log(toxic / (n - toxic)))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("n") - F.col("toxic") + 0.5))
    picked = counts.filter(F.col("n") >= MIN_DOCS).withColumn("z", odds / error).filter(F.col("z") > LEAST_Z)
    best = picked.withColumn("odds", odds).orderBy(F.desc("z"), "f").limit(FEATURES).select("f", "odds").collect()
    names = [r["f"] for r in best]
    index = {f: i for i, f in enumerate(names)}

    def sparse(batches):
        for batch in slices(batches):
            out = []
            for body in batch.column(0).to_pylist():
                found = [
                    sorted({index[f] for w in set(_WORD.findall(s.lower())) for f in features(w) if f in index})
                    for s in sentences(body)
                ]
                # Sentences without features add nothing.
                out.append([s for s in found if s])
            cells = pa.array(out, pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), cells], ["y", "copies", "cells"])

    held = rows.mapInArrow(sparse, "y int, copies long, cells array<array<long>>").collect()  # train_docs rows at most
    rows.unpersist()
    return _fit([(r["y"], r["copies"], r["cells"]) for r in held], names, START * np.array([r["odds"] for r in best]))


def scored(docs: DataFrame, model: NoisyOr, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, 0 to 1. Null and empty texts have the score of the leak alone.

    A column named ``score``, in any case, is replaced.
    """
    rest = other_columns(docs, ["score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights at most

    def score(batches):
        memo: dict[str, tuple] = {}
        for batch in slices(batches):
            out = [shared.value.score(t or "", memo) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(out, pa.float64())], ["_row", "score"])

    packed = docs.select(row_of(rest).alias("_row"), quoted(text).cast("string").alias("_text"))
    done = packed.mapInArrow(score, schema_after(packed, ["_row"], "score double"))
    return done.select(*row_columns(rest), "score")


def offending(docs: DataFrame, model: NoisyOr, id: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``id, sentences``: the sentences of each document whose own probability is at least ``least``."""
    frame = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def locate(batches):
        memo: dict[str, tuple] = {}
        for batch in slices(batches):
            out = [shared.value.offending(t or "", memo, least) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], ["id", "sentences"])

    kind = frame.schema["id"].dataType.simpleString()
    return frame.mapInArrow(locate, f"id {kind}, sentences array<string>").filter(F.size("sentences") > 0)


def held_out(id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS
) -> DataFrame:
    """``text, label, copies``: at most ``train_docs`` distinct labelled texts of documents that are not held out.

    Those of the smallest text hash, with the number of labelled documents that have them. An id labelled twice is
    toxic if any label says so. Texts are told apart by their 64-bit hash; only hashes meet the labels, and only the
    texts chosen are shuffled.
    """
    marks = labels.filter(~held_out(id)).groupBy(id).agg(F.max("toxic").alias("label"))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    hashed = docs.select(id, F.xxhash64(body).alias("h")).join(marks, id).filter(F.col("label").isNotNull())
    found = staged(hashed.groupBy("h", "label").agg(F.count(F.lit(1)).alias("copies")), "labelled_hashes")
    # The smallest hashes by their leading bits, of which there are 65 536, before anything is sorted.
    lead, held, least = F.shiftright("h", 48), 0, None
    for r in sorted(found.groupBy(lead.alias("lead")).count().collect()):
        held += r["count"]
        if held >= train_docs:
            least = r["lead"]
            break
    if least is not None:
        found = found.filter(lead <= least)
    chosen = found.orderBy("h", "label").limit(train_docs)
    wanted = F.broadcast(chosen.select("h").distinct())  # ``train_docs`` hashes at most
    texts = docs.select(body.alias("text")).withColumn("h", F.xxhash64("text")).join(wanted, "h")
    return texts.groupBy("h").agg(F.min("text").alias("text")).join(chosen, "h").select("text", "label", "copies")
