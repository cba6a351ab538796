"""Toxicity by multiple-instance learning: documents carry labels, sentences get scores.

A sentence's probability of being toxic is logistic in the features it holds; a document is toxic if any sentence is
(noisy-or): P = 1 - prod(1 - p_sentence). Weights are fitted to document labels through the noisy-or by gradient
steps, so the labels find the offending sentences themselves. These are reported with each score.

Sentences end after a word ending in ``.``, ``!`` or ``?`` and at a line break. Features are hashes of words (A-Z
lower-cased) and of their first 4, 5 and 6 bytes, which also hold together a stem's endings and punctuation marks.
Only features whose share among toxic training documents stands out by ``Z`` standard errors are kept; the choice
and the fit see a bounded sample of at most about ``SAMPLE`` labelled documents, chosen by a hash of their ids.
Labels, lang, source and doc_id are no inputs of a score. Documents held out are never learned from.

Nulls: a null or empty text has no sentences and scores 0. A null label teaches nothing; of repeated label rows the
largest counts. Without any label every score is 0. An empty table gives no rows. Repeated rows are scored each.

Scale: the sample's ids and labels are broadcast (bounded by SAMPLE); documents are scanned once for learning and once
for scoring, without moving texts. The driver holds the sample's chosen features per sentence and the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import held_out, sigmoid, table
from telcolens.llm.tokens import BASE, BASE_INVERSE, LOWER, SPACE, STEP_BYTES, buffers, mix, powers

SAMPLE = 12_000
LEAST_DOCS, Z = 4, 5.0
PREFIXES = (4, 5, 6)
STEPS, RATE, RIDGE = 400, 0.1, 1e-4
# Before any evidence a sentence is taken to be toxic this rarely.
PRIOR = -7.0


def sentence_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, sentence of each, first sentence of each text and one more)."""
    raw, offsets = buffers(texts)
    n = len(offsets) - 1
    features, owner = [], []
    first = np.zeros(n + 1, np.int64)
    a = done = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + STEP_BYTES, "right")) - 1)
        part = np.full(int(offsets[b] - offsets[a]) + (b - a), 0x0A, np.uint8)  # a line break after each text
        starts = offsets[a : b + 1] - offsets[a] + np.arange(b - a + 1)
        keep = np.ones(len(part), bool)
        keep[starts[1:] - 1] = False
        part[keep] = raw[offsets[a] : offsets[b]]
        edge = np.diff(SPACE[part].astype(np.int8), prepend=1, append=1)
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((LOWER[part].astype(np.uint64) + np.uint64(1)) * powers(BASE, len(part) + 1)[: len(part)], dtype=np.uint64, out=total[1:])
        down = powers(BASE_INVERSE, len(part) + 1)[begin]
        length = end - begin
        lines = np.concatenate([[0], np.cumsum(part == 0x0A)])
        if len(begin):
            stops = np.isin(part[end - 1], np.frombuffer(b".!?", np.uint8))
            new = np.concatenate([[True], stops[:-1] | (lines[begin[1:]] != lines[begin[:-1]])])
            sentence = np.cumsum(new) - 1 + done
            word_text = np.searchsorted(starts, begin, "right") - 1
            per_text = np.bincount(word_text[new], minlength=b - a)
        else:
            sentence, per_text = np.zeros(0, np.int64), np.zeros(b - a, np.int64)
        first[a + 1 : b + 1] = done + np.cumsum(per_text)
        done = int(first[b])
        for size in (0, *PREFIXES):
            use = length >= size
            stop = end[use] if size == 0 else begin[use] + size
            features.append(mix((total[stop] - total[begin[use]]) * down[use] + np.uint64(1000 * size + 7)))
            owner.append(sentence[use])
        a = b
    cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return cat(features, np.uint64), cat(owner, np.int64), first


def unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[keep], b[keep]


def training_sample(labels: DataFrame, remainder: int, most: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic) of at most about ``most`` labelled documents that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", remainder))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    share = min(1.0, most / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(6)), F.lit(1 << 20)) < int(share * (1 << 20)))


def chosen_features(train: DataFrame) -> np.ndarray:
    """Features of toxic documents, by document counts in the sample."""
    schema = pa.schema([("feature", pa.int64()), ("bad", pa.int64()), ("good", pa.int64())])

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in parts:
            f, owner, first = sentence_features(part.column("text"))
            text = np.searchsorted(first, owner, "right") - 1
            f, text = unique_pairs(f, text)
            held.append((f, part.column("toxic").to_numpy()[text]))
        if held:
            f, bad = (np.concatenate(x) for x in zip(*held))
            names, inverse = np.unique(f, return_inverse=True)
            n_bad, n = np.bincount(inverse, bad), np.bincount(inverse)
            for i in range(0, len(names), 65536):
                s = slice(i, i + 65536)
                columns = [names[s].view(np.int64), n_bad[s].astype(np.int64), (n - n_bad)[s].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    totals = train.agg(F.sum("toxic"), F.count(F.lit(1))).head()
    n_bad, n = int(totals[0] or 0), int(totals[1])
    if not 0 < n_bad < n:
        return np.zeros(0, np.uint64)
    c = train.select("text", "toxic").mapInArrow(count, "feature long, bad long, good long").groupBy("feature")
    c = c.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where(F.col("bad") >= LEAST_DOCS)
    share, all_ = n_bad / n, F.col("bad") + F.col("good")
    stands_out = (F.col("bad") - share * all_) / F.sqrt(share * (1 - share) * all_)
    got = c.where(stands_out >= Z).select("feature").collect()  # bounded by the sample
    return np.sort(np.array([r[0] for r in got], np.int64).view(np.uint64))


def lookup(features: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Positions of features among the sorted known ones, or -1."""
    if not len(known):
        return np.full(len(features), -1)
    at = np.minimum(np.searchsorted(known, features), len(known) - 1)
    return np.where(known[at] == features, at, -1)


def fit(train: DataFrame, known: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of the known features and the bias, by gradient steps on the noisy-or likelihood (Adam)."""
    schema = "toxic int, sentences long, owner binary, feature binary"

    def reduce(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            f, owner, first = sentence_features(part.column("text"))
            at = lookup(f, known)
            s, at = unique_pairs(owner[at >= 0], at[at >= 0])
            cut = np.searchsorted(s, first)
            rows = [
                {"toxic": int(y), "sentences": int(first[i + 1] - first[i]), "owner": (s[cut[i] : cut[i + 1]] - first[i]).astype(np.int32).tobytes(), "feature": at[cut[i] : cut[i + 1]].astype(np.int32).tobytes()}
                for i, y in enumerate(part.column("toxic").to_pylist())
            ]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("toxic", pa.int32()), ("sentences", pa.int64()), ("owner", pa.binary()), ("feature", pa.binary())]))

    docs = train.select("text", "toxic").mapInArrow(reduce, schema).collect()  # the bounded sample
    y = np.array([d["toxic"] for d in docs], np.float64)
    of_doc, of_sentence, feature, plain = [], [], [], []
    base = 0
    for i, d in enumerate(docs):
        s, f = np.frombuffer(d["owner"], np.int32), np.frombuffer(d["feature"], np.int32)
        own, number = np.unique(s, return_inverse=True)
        of_doc.append(np.full(len(own), i))
        of_sentence.append(number + base)
        feature.append(f)
        plain.append(d["sentences"] - len(own))
        base += len(own)
    of_doc, of_sentence, feature = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (of_doc, of_sentence, feature))
    plain = np.array(plain, np.float64)
    w, m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    w[-1] = PRIOR
    balance = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum())) * len(y)
    for step in range(1, STEPS + 1):
        z = w[-1] + np.bincount(of_sentence, w[feature], minlength=base)
        p = sigmoid(z)
        p0 = sigmoid(w[-1])
        # log(1 - P): minus the softplus of each sentence.
        quiet = -(np.bincount(of_doc, np.logaddexp(0, z), minlength=len(y)) + plain * np.logaddexp(0, w[-1]))
        miss = np.exp(quiet)
        # d loss / d log(1 - P)
        slope = balance * np.where(y > 0, miss / np.maximum(1e-12, 1 - miss), -1.0)
        by_sentence = slope[of_doc] * -p
        grad = np.append(np.bincount(feature, by_sentence[of_sentence], minlength=len(known)), by_sentence.sum() + (slope * plain).sum() * -p0)
        grad = grad / max(1, len(y)) + RIDGE * np.append(w[:-1], 0.0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def score(docs: DataFrame, known: np.ndarray, weights: np.ndarray, bias: float, keep: list[str]) -> DataFrame:
    """``keep`` and score, n_sentences, offending (numbers of the sentences more likely toxic than not, from 0)."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            f, owner, first = sentence_features(part.column("text"))
            at = lookup(f, known)
            s, at = unique_pairs(owner[at >= 0], at[at >= 0])
            z = np.full(int(first[-1]), bias) + np.bincount(s, weights[at], minlength=int(first[-1]))
            quiet = np.concatenate([[0.0], np.cumsum(np.logaddexp(0, z))])
            p = np.clip(1 - np.exp(-(quiet[first[1:]] - quiet[first[:-1]])), 0.0, 1.0)
            if not len(known):
                p = np.zeros(len(p))
            hot = np.flatnonzero(z > 0) if len(known) else np.zeros(0, np.int64)
            cut = np.searchsorted(hot, first)
            offending = [(hot[cut[i] : cut[i + 1]] - first[i]).tolist() for i in range(len(p))]
            columns = [part.column(c) for c in keep] + [pa.array(p), pa.array(np.diff(first)), pa.array(offending, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "score", "n_sentences", "offending"])

    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(of, f"{types}, score double, n_sentences long, offending array<bigint>")


def toxicity(docs: DataFrame, labels: DataFrame, remainder: int = 0) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, n_sentences, offending."""
    sample = training_sample(labels, remainder)
    train = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # ids of the bounded sample
    known = chosen_features(train)
    weights, bias = fit(train, known) if len(known) else (np.zeros(0), PRIOR)
    out = score(docs, known, weights, bias, ["doc_id"])
    return out.select("doc_id", held_out("doc_id", remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")


def query(spark, sf_dir: str) -> DataFrame:
    """op6: every document's toxicity and offending sentences."""
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
