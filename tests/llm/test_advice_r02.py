
from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np

from telcolens.llm import prefix_forest, signature_tree, spaced_seeds, suffix_tree_lm
from telcolens.llm.common import small_batches


def test_equal_files_are_blocks_apart(spark, tmp_path):
    small_batches(spark)
    texts = [(i, f"same words begin {i} a b c a b {'d ' * i}") for i in range(12)]
    one = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    odd = spark.createDataFrame([(None, "same words begin"), (0, "same words begin")], "doc_id long, text string").repartition(2)
    docs = one.unionAll(one).unionAll(odd)
    blocks = [r["block"] for r in suffix_tree_lm.packed_blocks(docs, 1).collect()]
    assert len(blocks) >= 3 and len(set(blocks)) == len(blocks)
    rows = docs.collect()
    c = Counter(w for r in rows if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1 for w in [*r["text"].split(), "</s>"])
    n, v = sum(c.values()), len(c)
    want = Counter((r["doc_id"], round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*r["text"].split(), "</s>"]), 6)) for r in rows)
    got = suffix_tree_lm.lm_scores(docs).collect()
    assert Counter((r["doc_id"], round(r["base_score"], 6)) for r in got) == want and {r["train_tokens"] for r in got} == {n}


def test_one_row_of_each_group_stays(spark):
    small_batches(spark)
    base = [f"w{i}" for i in range(100)]
    near = " ".join([*base[:-1], "changed"])
    far = [" ".join(f"{x}{i}" for i in range(60)) for x in "abcd"]
    rows = [(1, " ".join(base)), (1, " ".join(base)), (2, near), (None, near), (2, far[0]), (None, far[1]), (None, far[1]), (None, far[2]), (5, far[2]), (6, far[3]), (7, None), (None, "")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, source string").repartition(3)
    kept = signature_tree.stage(spark, docs, "")
    assert kept.columns == docs.columns
    want = [(1, " ".join(base)), (2, far[0]), (None, far[1]), (5, far[2]), (6, far[3]), (7, None), (None, "")]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)


def test_short_and_unspaced_items_are_found(spark):
    chinese, changed = "敏捷的棕色狐狸跳过了那只懒狗", "敏捷的棕色狐狸跑过了那只懒狗"
    items = {1: "forty two", 2: "a b c d e", 3: "f g h i j k", 4: "l m n o p q r s t u", 5: chinese, 6: "unique", 7: "v w x y"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows, want = [(0, "forty one two a b c f g h l m n o"), (1, "start Forty two! end"), (2, f"這是{changed}。"), (3, "z unique"), (4, "x v w x y"), (5, "v w z y")], {(1, 1), (2, 5), (3, 6), (4, 7)}
    for item in (2, 3, 4):  # a substitution in any place
        words = items[item].split()
        for i in range(len(words)):
            doc = 100 * item + i
            rows.append((doc, " ".join(["and", *words[:i], "other", *words[i + 1 :], "so"])))
            want.add((doc, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in spaced_seeds.contaminated(docs, bench).collect()} == want


def test_forest_serves_queries_outside_clusters(spark):
    small_batches(spark)
    rng = np.random.default_rng(5)
    half = rng.normal(size=(20, 16)) * 4
    clusters = np.repeat(np.concatenate([half, -half]), 60, axis=0) + rng.normal(size=(2400, 16)) * 0.02
    cloud = rng.normal(size=(1500, 16)) * ([3] * 3 + [0.01] * 13)
    x = np.concatenate([clusters, cloud]).astype(np.float32)
    # One query in 76 lies in the middle of the cloud, its neighbours at wide angles around the mean.
    middle = (2400 + np.argsort((cloud**2).sum(axis=1))[:4]).tolist()
    asked = [*range(0, 2400, 8), *middle]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got: dict[int, set[int]] = {}
    for r in prefix_forest.search(df, df.where(df.vec_id.isin(asked)), k=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    recall = []
    for q in asked:
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        recall.append(len(set(np.argsort(d, kind="stable")[:10].tolist()) & got.get(q, set())) / 10)
    print("recall: clusters mean", np.mean(recall[:300]), "least", min(recall[:300]), "middle", recall[300:])
    assert min(recall) >= 0.8 and np.mean(recall[:300]) >= 0.97 and np.mean(recall[300:]) >= 0.97
