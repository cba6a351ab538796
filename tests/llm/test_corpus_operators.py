"""The corpus operators against brute force on small tables with nulls, empty texts, ties, repeats and extra columns."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from telcolens.llm import (
    bitplanes,
    cotraining,
    host_reputation,
    mil_toxicity,
    pivotal_mix,
    prefix_forest,
    signature_tree,
    spaced_seeds,
    suffix_tree_lm,
    warc_index,
)
from telcolens.llm.common import small_batches
from telcolens.llm.tokens import hash_words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node string"


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(400)]
    rows, base = [], [rng.choice(pool) for _ in range(120)]
    for i in range(40):
        words = base[:] if i % 4 == 0 else [rng.choice(pool) for _ in range(rng.randint(1, 150))]
        if i % 8 == 0:
            words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), "en", f"s{i % 3}", 1, "x", "y"))
    rows += [(50, None, None, None, None, None, None), (51, "", "en", "s0", 0, "x", "y"), (52, " \n\t ", "en", "s1", 4, "x", "y")]
    rows += [(53, "Two  words", "en", "s1", 4, "x", "y"), (54, "two words", "en", "s1", 4, "x", "y"), (None, "no id here", "en", "s2", 1, "x", "y")]
    rows += [(55, " ".join(pool * 30), "en", "s2", 1, "x", "y"), (3, rows[3][1], "en", "s0", 1, "x", "y")]
    return spark.createDataFrame(rows, DOCS).repartition(5)


def plain(text):
    return (text or "").encode().lower().split()


def test_hashes_follow_words():
    texts = ["A bé\tA", None, "", "a\x0b\x0cB", "bÉ"]
    w = hash_words(pa.array(texts))
    assert w.counts.tolist() == [3, 0, 0, 2, 1]
    h = w.hashes
    assert h[0] == h[2] == h[3] and h[1] != h[5] and len(set(h.tolist())) == 4


@pytest.mark.parametrize("rule", [signature_tree.CONTRACT, signature_tree.COMMON])
def test_components_equal_brute_force(docs, rule):
    rows = docs.collect()
    sets = []
    for r in rows:
        w = plain(r["text"])
        sets.append({tuple(w[i : i + rule.n]) for i in range(len(w) - rule.n + 1)} if len(w) >= rule.n else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rule.den * len(sets[i] & sets[j]) >= rule.num * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    ids = {g: min((r["doc_id"] for r, k in zip(rows, group) if k == g and r["doc_id"] is not None), default=None) for g in group}
    want = Counter((r["doc_id"], len(s), ids[g] if s else r["doc_id"]) for r, s, g in zip(rows, sets, group))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in signature_tree.classes(docs, rule).collect())
    assert got == want


def test_language_model_base_and_sums(docs):
    rows = docs.collect()
    c = Counter(w for r in rows if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1 for w in [*plain(r["text"]), "</s>"])
    n, v = sum(c.values()), len(c)
    got = suffix_tree_lm.lm_scores(docs).collect()
    want = Counter((r["doc_id"], len(plain(r["text"])) + 1, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*plain(r["text"]), "</s>"]), 6)) for r in rows)
    assert Counter((r["doc_id"], r["n_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["train_tokens"] == n and -1e9 < r["score"] < 0 for r in got)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_forest_finds_neighbours_with_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:90] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0] * 7 + [float("nan")]), (304, [None] + [1.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = prefix_forest.search(df, df.where("vec_id % 50 = 0"), k=10).collect()
    hit = 0
    for q in range(0, 300, 50):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        near = np.lexsort((np.arange(300), d))[:10].tolist()
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(m[2] == d[m[1]] for m in mine)
        hit += len(set(near) & {m[1] for m in mine})
    assert hit >= 54 and [m["vec_id"] for m in sorted((r for r in got if r["query_id"] == 0), key=lambda r: r["rank"])] == list(range(50, 60))
    empty = df.where("vec_id < 0")
    assert prefix_forest.search(empty, empty).count() == 0


def test_token_files_round_trip(docs, spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bitplanes.default_tokenizer())
    odd = spark.createDataFrame([(70, "a  b\n \tc <|endoftext|> d中 x  ")], "doc_id long, text string")
    all_ = docs.select("doc_id", "text").unionByName(odd)
    want, start = [], 0
    for r in sorted(all_.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")):
        ids = np.array([*t.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in bitplanes.encode_and_read(all_).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert bitplanes.encode_and_read(all_.where("doc_id = -1")).count() == 0
    for bits in (1, 8):
        for ids in (np.arange(5000, dtype=np.uint32) * 3, np.zeros(7, np.uint32), np.zeros(0, np.uint32)):
            assert (bitplanes.from_planes(bitplanes.to_planes(ids, bits), len(ids), bits) == ids).all()


def test_mix_comes_near_its_targets(docs):
    got = pivotal_mix.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == Counter((r["doc_id"], r["size"], r["taken"]) for r in pivotal_mix.mix(docs.repartition(2)).collect())
    for s in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= max(1, max(r["size"] for r in mine))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got) and len(got) == docs.count()
    assert dict(pivotal_mix.targets([("a", 100), ("b", 1), (None, 0)])) == {"a": 98.0, "b": 3.0, None: 0.0}
    assert pivotal_mix.stage(None, docs, "").columns == docs.columns


def test_archives_round_trip(spark):
    rows = [(1, "http://A.b/x?y#z", "same"), (2, None, "same"), (3, "http://a.b/x?y", None), (4, "nothing", ""), (5, "http://a.b/\tt", "other"), (None, "http://a.b/", "same")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in warc_index.archive_and_read(df).collect()}
    assert len(got) == 6 and got[2]["record_type"] == "response" and got[1]["refers_to"] == 2 and got[None]["refers_to"] == 2
    assert got[3]["refers_to"] == 4 and got[3]["payload_bytes"] == 0 and got[1]["payload_bytes"] == 4
    assert all(r["payload_digest"] == warc_index.base32_sha1((dict((x[0], x[2]) for x in rows)[k] or "").encode()) for k, r in got.items())
    assert warc_index.archive_and_read(df.where("page_id = -1")).count() == 0


def test_seeds_tolerate_substitutions(spark):
    item = [f"b{i}" for i in range(20)]
    near = item[:]
    near[7] = "x"
    near[13] = "y"
    rows = [(1, "start " + " ".join(item).upper() + "!"), (2, " ".join(near)), (3, " ".join(item[:5] + ["q"] * 20)), (4, None), (None, " ".join(item))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(item)), (3, None), (4, "too short")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["matched"], r["first_word"]) for r in spaced_seeds.contaminated(df, bench).collect()}
    assert got == {(1, 1, 20, 1), (2, 1, 18, 0), (None, 1, 20, 0)}


def test_hosts_shrink_and_rules_win(spark):
    pages = [(i, f"http://bad.x.com/{i}") for i in range(40)] + [(100 + i, f"http://good.y.net/{i}") for i in range(40)]
    pages += [(200, None), (201, "no host"), (202, "http://a.example.org/es/1"), (203, "http://x.org/"), (204, "http://X.com/de/?a")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    out = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(200, None)], "page_id long, bad int")
    got = {r["page_id"]: r for r in host_reputation.judge(df, out).collect()}
    assert got[0]["verdict"] == "block" and got[100]["verdict"] == "allow" and len(got) == len(pages)
    assert (got[200]["host"], got[200]["path"], got[200]["rule"]) == ("", "", None)
    assert [got[i]["rule"] for i in (202, 203, 204)] == ["example.org/es/", "org/", "com/de/"]
    assert [got[i]["verdict"] for i in (202, 203, 204)] == ["block", "allow", "block"]


def labelled(spark, bad: str):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(200):
        words = [f"w{rng.randrange(300)}" for _ in range(60)]
        sentences = [words[k : k + 10] for k in range(0, 60, 10)]
        if i % 4 == 0:
            sentences[i % 6][3] = bad
        rows.append((i, ". ".join(" ".join(s) for s in sentences), "en", "s", 1))
        labels.append((i, 0 if i % 4 == 0 else 1, int(i % 4 == 0)))
    rows += [(300, None, None, None, None), (301, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([*labels, (300, None, None)], "doc_id long, quality int, toxic int")


def test_sentences_are_found(spark):
    docs, labels = labelled(spark, "vile")
    got = {r["doc_id"]: r for r in mil_toxicity.toxicity(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in range(200))
    assert all(got[i]["offending"] == [i % 6] for i in range(0, 200, 4))
    assert got[300]["score"] == got[301]["score"] == 0.0
    assert {r["score"] for r in mil_toxicity.toxicity(docs, labels.where("toxic = 0")).collect()} == {0.0}


def test_cotraining_keeps_and_rejects(spark):
    docs, labels = labelled(spark, "$$$ ### %%% !!! $$$ ### %%% !!! $$$ ### %%% !!!")
    got = {r["doc_id"]: r["kept"] for r in cotraining.quality(docs, labels.where("doc_id % 8 < 6")).collect()}
    assert sum(got[i] == (i % 4 != 0) for i in range(200)) >= 196
    assert all(r["kept"] for r in cotraining.quality(docs, labels.where("quality = 1")).collect())
    assert cotraining.quality(docs.where("doc_id < 0"), labels).count() == 0
