"""Quality classification by co-training of two views.

View A is the text's content: shares of letters, digits, signs and capitals, word lengths, repetition of words. View B is
the page's metadata: source, lang, n_chars and layout (lines, their lengths and repetition). Each view has a logistic
classifier fitted by Newton steps. First both learn from labelled documents. Then, in rounds, each view labels the
unlabelled documents that it is confident of (probability at least ``SURE``, or at most 1 - SURE) for the other view,
which learns from labels and these pseudo-labels, at weight ``PSEUDO``. At the end both views are calibrated on the
labelled documents (Platt scaling), and the calibrated log-odds are combined by a last logistic fit on these.

All labelled and all unlabelled documents take part in every round; nothing is sampled. The score is the probability
of good quality; a document is kept if it is at least 0.5.

Nulls: a null text is an empty one; null source, lang or n_chars are values of their own. A null label counts as
unlabelled; of repeated label rows the smallest counts. Without labels of both kinds every score is 0.5 and every
document is kept. An empty table gives no rows. Repeated rows are scored each.

Scale: texts are scanned twice, once for the features of both views (some 60 numbers per document, written) and once
for the scores; no text moves. A Newton step is a scan of the features with sums of products per task, added up in
Spark by entry, so the driver gets one row per matrix entry whatever the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import batches, sigmoid, table, written

SURE, PSEUDO, ROUNDS, STEPS, RIDGE = 0.97, 0.5, 2, 4, 1.0
SOURCES, LANGS = 16, 8
# Bytes by class. Signs are the ASCII punctuation marks that prose rarely uses.
UPPER, DIGIT, END, SIGN, OTHER = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = True
DIGIT[48:58] = True
END[[ord(c) for c in ".,;:?'\"()-"]] = True
SIGN[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = True
OTHER[128:] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True


def content(text: bytes) -> list[float]:
    """View A of one text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * A_SIZE
    of = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    total = len(text)
    letters = max(1, int(of[LETTER].sum()))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same = sum(a == b for a, b in zip(words, words[1:]))
    signs = of[SIGN].sum() / total
    marked = sum(w[-1] in b"!#$%&*|" for w in words) / n
    return [
        np.log1p(n) / 5, total / n / 10, np.log1p(len(counts)) / np.log1p(n), max(counts.values()) / n, same / n,
        of[UPPER].sum() / letters, of[DIGIT].sum() / total, of[END].sum() / total, signs, np.sqrt(signs),
        of[ord("!")] / total, np.sqrt(of[ord("|")] / total), of[OTHER].sum() / total, marked,
    ]


A_SIZE = 14


def metadata(text: bytes, source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """View B of one page."""
    lines = text.split(b"\n")
    filled = [x for x in lines if x.strip()]
    n = max(1, len(filled))
    chars = len(text) if n_chars is None else n_chars
    out = [
        float(n_chars is None), np.log1p(max(0, chars)) / 10, np.log1p(len(lines)) / 5, np.log1p(len(text) / n) / 10,
        len(set(filled)) / n, sum(len(x) < 40 for x in filled) / n, sum(x.count(b" | ") > 2 for x in filled) / n,
        np.log1p(max(map(len, lines))) / 10,
    ]
    for value, size in ((source, SOURCES), (lang, LANGS)):
        at = 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (size - 1)
        out += [float(i == at) for i in range(size)]
    return out


B_SIZE = 8 + SOURCES + LANGS


def features(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views of a batch (columns text, source, lang, n_chars)."""
    a, b = np.zeros((part.num_rows, A_SIZE)), np.zeros((part.num_rows, B_SIZE))
    rows = zip(*(part.column(c).to_pylist() for c in ("text", "source", "lang", "n_chars")))
    for i, (text, source, lang, n_chars) in enumerate(rows):
        raw = (text or "").encode()
        a[i], b[i] = content(raw), metadata(raw, source, lang, n_chars)
    return a, b


def with_bias(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


INPUTS = ["text", "source", "lang", "n_chars"]


def views(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(y, a, b): the label (null: none) and both views of each document, written."""
    types = dict(docs.dtypes)
    inputs = [F.col(c) if c in types else F.lit(None).cast("string" if c != "n_chars" else "long").alias(c) for c in INPUTS]
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.min("quality") > 0).cast("int").alias("y"))

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            a, b = features(part)
            packed = [pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary()) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *packed], ["doc_id", "a", "b"])

    x = docs.select("doc_id", *inputs).mapInArrow(of, "doc_id long, a binary, b binary")
    return written(x.join(known, "doc_id", "left").select("y", "a", "b"), "views")


def unpack(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), size).astype(np.float64)


def summed(df: DataFrame, of, size: int) -> np.ndarray:
    """The sum over all rows of the vector that ``of`` makes of each batch."""
    schema = pa.schema([("i", pa.int32()), ("v", pa.float64())])

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for part in parts:
            total += of(part)
        at = np.flatnonzero(total)
        yield from batches(({"i": int(i), "v": float(total[i])} for i in at), schema)

    out = np.zeros(size)
    for r in df.mapInArrow(sums, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():  # one row per entry
        out[r["i"]] = r["v"]
    return out


def newton(weights: list[np.ndarray], total: np.ndarray) -> list[np.ndarray]:
    """New weights of several classifiers from the sums of their curvatures and slopes."""
    out, at = [], 0
    for w in weights:
        d = len(w)
        h, g = total[at : at + d * d].reshape(d, d), total[at + d * d : at + d * d + d]
        at += d * d + d
        ridge = RIDGE * np.append(np.ones(d - 1), 1e-3)
        step = np.linalg.solve(h + np.diag(ridge + 1e-9), g - ridge * w)
        out.append(w + step * min(1.0, 4.0 / max(1e-9, np.abs(step).max())))
    return out


def parts_of(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> list[np.ndarray]:
    p = sigmoid(x @ w)
    return [((x * (weight * p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (weight * (y - p))]


class Model:
    """Weights of both views, their calibrations and the combination."""

    def __init__(self, a, b, platt, combined):
        self.a, self.b, self.platt, self.combined = a, b, platt, combined

    def log_odds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of each view: (rows, 2)."""
        raw = np.stack([with_bias(a) @ self.a, with_bias(b) @ self.b], axis=1)
        return raw * self.platt[:, 0] + self.platt[:, 1]

    def score(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return sigmoid(with_bias(self.log_odds(a, b)) @ self.combined)


def train(seen: DataFrame) -> Model | None:
    """Co-training on (y, a, b) rows; None without labels of both kinds."""
    counts = seen.agg(F.sum((F.col("y") == 1).cast("int")), F.sum((F.col("y") == 0).cast("int"))).head()
    if not counts[0] or not counts[1]:
        return None
    wa, wb = np.zeros(A_SIZE + 1), np.zeros(B_SIZE + 1)
    size = sum(len(w) * (len(w) + 1) for w in (wa, wb))
    for turn in range(ROUNDS + 1):
        teacher_a, teacher_b = wa, wb
        for _ in range(STEPS):

            def step(part: pa.RecordBatch, wa=wa, wb=wb, ta=teacher_a, tb=teacher_b, turn=turn) -> np.ndarray:
                xa, xb = with_bias(unpack(part.column("a"), A_SIZE)), with_bias(unpack(part.column("b"), B_SIZE))
                y = part.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
                known = ~np.isnan(y)
                out = []
                # Each view learns from the other's pseudo-labels.
                for x, w, says in ((xa, wa, sigmoid(xb @ tb)), (xb, wb, sigmoid(xa @ ta))):
                    sure = (says >= SURE) | (says <= 1 - SURE) if turn else np.zeros(len(y), bool)
                    weight = np.where(known, 1.0, np.where(sure, PSEUDO, 0.0))
                    out += parts_of(x, np.where(known, y, says >= 0.5), weight, w)
                return np.concatenate(out)

            wa, wb = newton([wa, wb], summed(seen, step, size))
    labelled = seen.where(F.col("y").isNotNull())
    platt = [np.array([1.0, 0.0]), np.array([1.0, 0.0])]
    for _ in range(STEPS):

        def calibrate(part: pa.RecordBatch, platt=platt) -> np.ndarray:
            y = part.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            out = []
            for name, size, w, c in (("a", A_SIZE, wa, platt[0]), ("b", B_SIZE, wb, platt[1])):
                raw = with_bias(unpack(part.column(name), size)) @ w
                out += parts_of(with_bias(raw[:, None]), y, np.ones(len(y)), c)
            return np.concatenate(out)

        platt = newton(platt, summed(labelled, calibrate, 12))
    model = Model(wa, wb, np.array(platt), np.array([1.0, 1.0, 0.0]))
    for _ in range(STEPS):

        def combine(part: pa.RecordBatch, model=model) -> np.ndarray:
            y = part.column("y").to_numpy(zero_copy_only=False).astype(np.float64)
            x = with_bias(model.log_odds(unpack(part.column("a"), A_SIZE), unpack(part.column("b"), B_SIZE)))
            return np.concatenate(parts_of(x, y, np.ones(len(y)), model.combined))

        model = Model(wa, wb, model.platt, newton([model.combined], summed(labelled, combine, 12))[0])
    return model


def fitted(docs: DataFrame, labels: DataFrame) -> Model | None:
    return train(views(docs, labels))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """The columns of ``docs`` under ``c0``, ``c1``, ... in order, then score_a, score_b (calibrated) and score."""
    types = dict(docs.dtypes)
    inputs = [F.col(c).alias(c) if c in types else F.lit(None).cast("string" if c != "n_chars" else "long").alias(c) for c in INPUTS]
    kept = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("row"), *inputs)

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if model is None:
                views = [np.full(part.num_rows, 0.5)] * 3
            else:
                a, b = features(part)
                odds = sigmoid(model.log_odds(a, b))
                views = [odds[:, 0], odds[:, 1], model.score(a, b)]
            yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(v) for v in views]], ["row", "score_a", "score_b", "score"])

    return kept.mapInArrow(of, f"row {kept.schema['row'].dataType.simpleString()}, score_a double, score_b double, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, score_a, score_b, score, kept."""
    s = scored(docs.select("doc_id", *[c for c in INPUTS if c in docs.columns]), fitted(docs, labels))
    return s.select(F.col("row.c0").alias("doc_id"), "score_a", "score_b", "score", (F.col("score") >= 0.5).alias("kept"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier keeps."""
    s = scored(docs, fitted(docs, table(spark, sf_dir, "labels"))).where("score >= 0.5")
    return s.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def query(spark, sf_dir: str) -> DataFrame:
    """op7: every document's quality score and whether it is kept."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
