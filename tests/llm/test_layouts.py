"""Results that must not depend on how rows lie in tasks, columns that must survive, and rows without ids."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from telcolens.llm import bitplanes, pivotal_mix, signature_tree, spaced_seeds
from telcolens.llm.common import small_batches

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that stages use, or used, inside.
CLASH = ["_row", "_row_key", "_text", "row", "no", "copies", "unit_key", "row_key", "mark", "node", "root"]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    pool = [f"w{i}" for i in range(300)]
    out = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 60))), "en", f"s{i % 4}", i) for i in range(400)]
    out += [(None, "the same text every time of ten words or so", "en", "s0", 0)] * 200  # a third of all rows are equal
    out += [(None, None, None, None, None), (1, "", "en", None, 0), (7, out[7][1], "en", "s1", 0), (7, out[7][1] + " x", "en", "s3", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    small_batches(spark)
    return spark.createDataFrame(rows, COLUMNS)


def test_the_mix_is_the_same_on_any_layout(spark, docs):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    found = []
    try:
        for adaptive, partitions, batch, spread in [("true", 4, 512, 1), ("false", 13, 100, 5), ("true", 30, 7, 9)]:
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = pivotal_mix.mix(docs.repartition(spread, F.rand(3)))
            found.append(Counter(tuple(r) for r in got.select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found[0] == found[1] == found[2] and sum(found[0].values()) == docs.count()


def test_equal_rows_have_ranks_without_meeting(spark, docs):
    got = pivotal_mix.sized(docs.repartition(6)).collect()
    ranks = Counter((r["doc_id"], r["source"], r["size"], r["mark"]) for r in got)
    assert max(ranks.values()) == 200
    for key, n in ranks.items():
        assert sorted(r["rank"] for r in got if (r["doc_id"], r["source"], r["size"], r["mark"]) == key) == list(range(1, n + 1))


def test_the_stage_takes_what_the_mix_says(docs):
    copies = Counter()
    for r in pivotal_mix.mix(docs).collect():
        copies[r["doc_id"], r["source"], r["size"]] += r["copies"]
    staged = pivotal_mix.stage(None, docs.repartition(7), "")
    sizes = staged.withColumn("size", pivotal_mix.word_count(F.col("text")))
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in sizes.collect()) == +copies


def test_columns_of_any_name_survive(spark, docs):
    own = docs.limit(60)
    for i, c in enumerate(CLASH):
        own = own.withColumn(c, F.concat(F.lit(f"{i}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    own = spark.createDataFrame(own.collect(), own.schema)
    given = {tuple(r) for r in own.collect()}
    near = signature_tree.stage(spark, own, "")
    mixed = pivotal_mix.stage(spark, own, "")
    for got in (near, mixed):
        assert got.columns == own.columns and {tuple(r) for r in got.collect()} <= given
    assert near.count() > 0 and mixed.count() > 0


def test_decontamination_keeps_columns_of_any_name(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()
    spark.createDataFrame([(1, " ".join(words))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own = spark.createDataFrame([(1, "before " + " ".join(words) + " after", "kept 1", "a"), (2, "quite other words stand here", "kept 2", "b"), (None, None, "kept 3", None)], "doc_id long, text string, _row_key string, row string")
    got = spaced_seeds.stage(spark, own, str(tmp_path))
    assert got.columns == own.columns and {(r["doc_id"], r["_row_key"], r["row"]) for r in got.collect()} == {(2, "kept 2", "b"), (None, "kept 3", None)}


def test_rows_without_ids_meet_their_own_member_only(spark):
    rng = random.Random(1)
    base = [[f"v{rng.randrange(5000)}" for _ in range(30)] for _ in range(300)]
    rows = [(None, " ".join(w)) for w in base] + [(None, " ".join(w[:-1] + ["end"])) for w in base[:100]] + [(5, " ".join(base[0]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = signature_tree.classes(docs, signature_tree.CONTRACT).collect()
    assert len(got) == len(rows) and len({r["node"] for r in got}) == 400
    assert {r["component_id"] for r in got if r["doc_id"] == 5} == {5}
    assert sum(r["component_id"] == 5 for r in got) >= 2  # the copy without an id is in its group
    # The join that fetches members' texts: every row meets one member at most.
    members = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.lit(1).alias("node"), F.lit(1).alias("root"), F.lit(1).alias("total")).distinct()
    seen = []
    plain = signature_tree.written
    signature_tree.written = lambda df, name: seen.append(df) or df
    try:
        signature_tree.with_sets(docs, members, signature_tree.CONTRACT)
    finally:
        signature_tree.written = plain
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((key" in plan and "mark" in plan.split("Join Inner")[1].split("\n")[0]


def test_token_files_spread_rows_without_ids(spark, rows):
    small_batches(spark)
    some = spark.createDataFrame([(None, f"text {i}") for i in range(300)] + [(i, f"text {i}") for i in range(300)], "doc_id long, text string").repartition(6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        manifest = bitplanes.write_shards(some, bitplanes.shared_dir(spark, "tokens"), bitplanes.default_tokenizer())
        sizes = [r["docs"] for r in manifest.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 600 and len(sizes) >= 6 and max(sizes) < 150
    ids = [r["doc_id"] for r in sorted(bitplanes.read_shards(manifest).collect(), key=lambda r: r["start"])]
    assert ids == [None] * 300 + list(range(300))
