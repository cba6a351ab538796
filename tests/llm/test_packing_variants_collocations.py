"""Packing, spelling variants and collocations against brute force on small tables with nulls, empty and very long texts, ties,
repeated rows, empty tables and extra columns."""

from __future__ import annotations

import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from telcolens.llm import collocations, harmonic_packing, spelling_fm
from telcolens.llm.common import small_batches

# Names that the operators use inside are columns of the input, too.
DOCS = "doc_id long, text string, lang string, source string, word string, n long, key string, sequence_id string, block string, ids string"


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    rng = random.Random(11)
    syllables = ["an", "er", "Tho", "li", "né", "sta", "ÀB", "ion"]
    pool = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(60)]
    ends = [" ", " ", " ", " ", "\t", ", ", ". ", "\n", "! ", "'s ", "\x0b", "\xa0", " × "]

    def text(n):
        return "".join(rng.choice(pool) + rng.choice(ends) for _ in range(n))

    rows = [(i, text(rng.choice([0, 1, 3, 40, 200])), rng.choice(["en", "de", None]), "s", "w", 1, "k", "q", "b", "i") for i in range(80)]
    rows += [rows[5], rows[5], (None, text(50), "en", *rows[0][3:]), (None, text(50), "en", *rows[0][3:])]
    rows += [(200, None, None, *rows[0][3:]), (201, "", "und", *rows[0][3:]), (202, " \n\t ", "en", *rows[0][3:])]
    rows += [(303, "New York City. " * 15 + "new york! " * 40 + "a a a a a a a a a a a a a a ", "en", *rows[0][3:])]
    rows += [(300, text(6000), "de", *rows[0][3:]), (301, "x" * 30_000 + " <|endoftext|>Àb c d", "en", *rows[0][3:])]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


@pytest.mark.parametrize("capacity,slack", [(2048, 32), (16, 1), (50, 0)])
def test_pieces_hold_every_id_once(docs, capacity, slack):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(harmonic_packing.default_tokenizer())
    want = Counter()
    for r in docs.collect():
        ids = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        want[r["doc_id"], ids.tobytes()] += 1
    pieces = harmonic_packing.pack(docs, capacity=capacity, slack=slack).collect()
    assert all(zlib.crc32(p["ids"]) == p["ids_crc32"] and len(p["ids"]) == 4 * p["length"] for p in pieces)
    # Pieces of a document by their starts; repeated rows and null ids have several equal ones.
    own = defaultdict(list)
    for p in pieces:
        own[p["doc_id"], p["start"]].append(bytes(p["ids"]))
    for (doc_id, ids), times in want.items():
        at = 0
        while at < len(ids):
            there = [x for x in own[doc_id, at // 4] if ids[at : at + len(x)] == x]
            assert len(there) >= times
            at += len(there[0])
    assert sum(p["length"] for p in pieces) == sum(len(ids) // 4 * k for (_, ids), k in want.items())
    held = defaultdict(list)
    for p in pieces:
        held[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = 0
    for s in held.values():
        assert [o for o, _ in sorted(s)] == [sum(n for _, n in sorted(s)[:i]) for i in range(len(s))]
        total = sum(n for _, n in s)
        assert total <= capacity
        padding += 0 if total & (total - 1) == 0 else capacity - total
    total = sum(p["length"] for p in pieces)
    assert padding <= capacity + (slack + capacity**0.5) / capacity * total
    whole = {r["sequence_id"]: r for r in harmonic_packing.sequences(docs.sparkSession.createDataFrame(pieces), capacity, 7).collect()}
    assert whole.keys() == held.keys()
    for k, r in whole.items():
        got, n = np.frombuffer(r["ids"], "<u4"), r["n_tokens"]
        assert len(got) == (n if n & (n - 1) == 0 else capacity) and (got[n:] == 7).all() and r["n_pieces"] == len(held[k])
        assert got[:n].tobytes() == b"".join(p["ids"] for p in sorted((p for p in pieces if p["sequence_id"] == k), key=lambda p: p["offset"]))


def test_rounds_of_packing_shrink(docs, monkeypatch):
    monkeypatch.setattr(harmonic_packing, "FAN", 2)
    pieces = harmonic_packing.pack(docs.repartition(24), capacity=16, slack=0, keep_ids=False)
    sizes = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert "ids" not in pieces.columns and sizes.where("n > 16").isEmpty() and sizes.where("n < 14").count() <= 1
    assert pieces.selectExpr("shiftright(sequence_id, 56) AS step").distinct().count() > 2


def test_classes():
    for capacity, slack in [(2048, 32), (16, 1), (50, 0), (1, 0)]:
        for n in [*range(1, 200), 5000]:
            got = list(harmonic_packing.cuts(n, capacity, slack))
            assert [a for a, _ in got] == [sum(s for _, s in got[:i]) for i in range(len(got))] and sum(s for _, s in got) == n
            assert all((capacity // s) * s <= capacity for _, s in got)


def test_ids_are_the_librarys_wherever_pieces_are_cut():
    encoder = harmonic_packing.UnitEncoder(harmonic_packing.default_tokenizer())
    rng = random.Random(12)
    plain = ["'", "'s", "'T", "'re", "'VE", "'ll", "'d", "'m", " ", "\n", "\t", "\r", "a", "s", "l", "É", "ж", "ǅ", "Ⱥ", "Ⱦ", "1", "²", "½", "ª", "<", "!", "—", "\u0483"]
    rare = [*plain, "|", "<|endoftext|>", "İ", "中", "😀", "\u0301", "\x0b", "\xa0", "\u3000"]
    for some in [plain, rare]:
        for size in (0, 1, 60):
            texts = ["".join(rng.choices(some, k=rng.choice([0, 1, 2, 5, 30, 200]))) for _ in range(size)]
            assert encoder.encode(texts) == [encoder.library([t])[0] for t in texts]


def test_ids_stay_right_when_a_worker_forgets_pieces(monkeypatch):
    monkeypatch.setattr(harmonic_packing, "KNOWN", 5)
    monkeypatch.setattr(harmonic_packing, "LONGEST", 3)
    encoder = harmonic_packing.UnitEncoder(harmonic_packing.default_tokenizer())
    rng = random.Random(13)
    for _ in range(30):
        texts = [" ".join(rng.choices(["to", "be", "or", "not", "that", "question", "an", "it", "is", "1603"], k=3)) for _ in range(2)]
        assert encoder.encode(texts) == encoder.library(texts)
        assert all(len(x) <= 2 * 3 for x in [*encoder.words.now, *encoder.words.older]) and len(encoder.words.now) <= 5


def test_new_units_of_known_pieces_take_no_python_calls_each():
    encoder = harmonic_packing.UnitEncoder(harmonic_packing.default_tokenizer())
    words = ["alpha", "beta", "gamma", "delta", "omega", "theta", "kappa", "sigma", "lambda", "iota"]
    units = [f"{a},{b}.{c}!{d}" for a in words for b in words for c in words for d in words[:5]]
    calls = Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        ids = encoder.encode([" ".join(units)])
    finally:
        sys.setprofile(None)
    assert ids == encoder.library([" ".join(units)]) and calls["c_call"] < len(units) / 5


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_of(n):
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(others[w]), n[form[w]] if w in form else None))
    return out


def rows_of_variants(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_vocabulary_equals_brute_force(docs):
    n = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r["text"] or ""):
            w = spelling_fm.planted(r["doc_id"], run.encode().lower().decode())
            n[w] += len(w) >= 5
    want = {(w, k) for w, k in n.items() if k >= 3}
    assert {tuple(r) for r in spelling_fm.vocabulary(docs).collect()} == want and len(want) > 30
    assert any(len(spelling_fm.planted(i, "abcdef")) == 5 for i in range(400))


@pytest.mark.parametrize("block", [20_000, 7])
def test_variants_equal_brute_force(spark, block):
    rng = random.Random(5)
    words = {"".join(rng.choice("aabé") for _ in range(rng.randint(5, 8))) for _ in range(300)}
    words |= {"a" * k for k in range(5, 12)} | {"b" * 3000, "b" * 3001, "b" * 2999 + "c", "abab" * 5, "baba" * 5}
    n = {w: rng.choice([3, 3, 4, 6, 12, 24, 50, 100]) for w in sorted(words)}
    got = rows_of_variants(spelling_fm.variants(spark.createDataFrame([*n.items()], "word string, n long"), block=block))
    assert len(got) == len(n) and set(got) == variants_of(n)
    assert any(r[1] and r[1] != r[2] for r in got)  # a way of several forms


def test_variants_of_documents_and_empty_tables(docs, empty):
    words = spelling_fm.vocabulary(docs)
    n = {r["word"]: r["n"] for r in words.collect()}
    assert set(rows_of_variants(spelling_fm.variants(words))) == variants_of(n)
    assert rows_of_variants(spelling_fm.variants(spelling_fm.vocabulary(empty))) == []


def collocations_of(rows, least, top):
    f, total = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for r in rows:
        lang = "und" if r["lang"] is None else r["lang"]
        for piece in re.split("[.,;:!?\x0a-\x0d]", (r["text"] or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in found.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * found[q]}
        ranked = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return out


def rows_of_collocations(df, top=2000):
    return [tuple(r) for r in collocations.top(df, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]


@pytest.mark.parametrize("least,top,small", [(10, 2000, False), (3, 40, False), (3, 2000, True)])
def test_collocations_equal_brute_force(docs, monkeypatch, least, top, small):
    if small:  # many key ranges, bucket parts, tries and pieces; two digits a word
        for name, size in {"NUMBERS": 20, "PART": 500, "TRIE": 50}.items():
            monkeypatch.setattr(collocations, name, size)
    want = collocations_of(docs.collect(), least, top)
    got = rows_of_collocations(collocations.collocations(docs, least), top)
    assert len(got) == len(set(got)) and set(got) == want
    assert {r[0] for r in got} == {"en", "de", "und"} and any(r[2].count(" ") == 2 for r in got)


def test_collocations_of_empty_and_rare(empty, docs):
    assert rows_of_collocations(collocations.collocations(empty)) == []
    assert rows_of_collocations(collocations.collocations(docs.where("doc_id = 201"))) == []
    assert rows_of_collocations(collocations.collocations(docs.where("doc_id < 30"), 10**6)) == []


def test_packing_of_empty_table(empty):
    assert harmonic_packing.pack(empty).collect() == []


def test_double_array_follows_only_its_phrases():
    rng = np.random.default_rng(2)
    a, b, c = (rng.integers(1, 3000, 4000).astype(np.uint32) for _ in range(3))
    c[::2] = 0
    rows = collocations.distinct(*(np.concatenate([x, y]) for x, y in ((a, a), (b, b), (c, np.zeros_like(c)))))
    base, check = collocations.build_trie(*rows, 2)
    there = {tuple(r) for r in zip(*(x.tolist() for x in rows))}
    asked = [np.concatenate([x, rng.integers(1, 3000, 3000).astype(np.uint32)]) for x in rows]
    asked[2][asked[2] == 0] = 5
    place, state = np.arange(len(asked[0])), np.zeros(len(asked[0]), np.int64)
    for x in asked:
        place, state = collocations.advance(base, check, place, state, collocations.digits(x, 2))
    want = [i for i, r in enumerate(zip(*(x.tolist() for x in asked))) if r in there]
    assert sorted(place.tolist()) == want and len(base) < 3 * len(there) * 4


def test_tries_are_built_from_any_number_of_rows():
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for shard, n in enumerate([1, 63, 64, 65, 128, 192]):  # a shard may end with a full gathering of 64 rows
        own = []
        for _ in range(n):
            a, b = (rng.integers(1, 900, 5).astype(np.uint32) for _ in range(2))
            c = np.array([0, 0, 0, 7, 7], np.uint32)
            a[3:], b[3:] = a[1:3], b[1:3]  # the pair of each triple is there, too
            own.append((a, b, c))
            rows.append({"shard": shard, "a": a.tobytes(), "b": b.tobytes(), "c": c.tobytes()})
        want[shard] = collocations.build_trie(*(np.concatenate(x) for x in zip(*own)), 1)
    parts = (pa.RecordBatch.from_pylist(rows[i : i + 100], collocations.CANDIDATE_ROW) for i in range(0, len(rows), 100))
    got = [r for part in collocations._build(1, parts) for r in part.to_pylist()]
    assert [(r["shard"], r["n"]) for r in got] == [(k, len(check)) for k, (_, check) in want.items()]
    assert all(r["base"] == want[r["shard"]][0].tobytes() and r["check"] == want[r["shard"]][1].tobytes() for r in got)


@pytest.mark.parametrize("top", [1, 2, 900, 1 << 20, 1 << 31, 1 << 32])
def test_distinct_rows_of_any_width(top):
    rng = np.random.default_rng(4)
    for k in (1, 2, 3, 4):
        columns = [rng.integers(0, top, 300).astype(np.uint32)[rng.integers(0, 300, 500)] for _ in range(k)]
        columns[-1][::7] = 0
        got = collocations.distinct(*columns)
        assert [*zip(*(x.tolist() for x in got))] == sorted({*zip(*(x.tolist() for x in columns))}) and {x.dtype for x in got} == {np.dtype(np.uint32)}
        assert [len(x) for x in collocations.distinct(*(x[:0] for x in columns))] == [0] * k


def test_counts_grow_with_windows_not_with_tries():
    a = np.arange(1, 60_001, dtype=np.uint32)  # one trie of many more slots than the text has windows
    base, check = collocations.build_trie(a, a, np.zeros_like(a), 2)
    text = np.array([5, 5, 0, 700, 700, 0, 5, 5, 0, 59_000, 59_000, 0, 1, 2, 0], "<u4")
    part = pa.RecordBatch.from_pylist([{"ids": text.tobytes()}], pa.schema([("ids", pa.binary())]))
    got = [*collocations._count_phrases({0: (base, check)}, {0: len(check)}, 1, 2, iter([part]))]
    assert sum(x.nbytes for x in got) < 1000
    place, state = np.arange(len(a)), np.zeros(len(a), np.int64)
    for x in (a, a):
        place, state = collocations.advance(base, check, place, state, collocations.digits(x, 2))
    want = {int(state[w - 1]): n for w, n in ((5, 2), (700, 1), (59_000, 1))}
    rows = [r for part in got for r in part.to_pylist()]
    slots = [r["piece"] * collocations.PIECE + int(k) for r in rows for k in np.frombuffer(r["slots"], "<u2")]
    assert dict(zip(slots, (int(n) for r in rows for n in np.frombuffer(r["counts"], "<i8")))) == want
