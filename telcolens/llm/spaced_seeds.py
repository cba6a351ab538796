"""Benchmark decontamination by spaced-seed hashing (DataFrame and SQL functions only).

Words are lower-cased and freed of all characters but letters and digits; where a script sets no spaces between words
(``UNSPACED``), each letter is a word. A fixed mask selects some of the words
of a window and ignores the others, so a substituted word in an ignored place doesn't hide a match. Hashes of the
selected words of every window, for every mask, of benchmark items and documents are joined. Each hit gives a
diagonal (document position minus item position); diagonals are made distinct, and on each the words of item and
document are compared place by place: the best stretch scores 1 for an equal word and -1 for another. A document is
contaminated by an item if a stretch scores ``LEAST`` or more, or if ``SHARE`` of the item's words are equal on the
diagonal, which short items reach with a substitution: 4 of 5 words, 8 of 10. (From 15 words on, that share always
scores LEAST.)

Items too short for the masks have ``SHORT`` ones of their own, which are used only if the benchmark has such items:
items of up to 4 words are found by all their words, those of 5 and 6 with a substitution in any place. The masks find
a substitution in any place of 7 words or more; two or more in an item of few words may leave no mask whole.

Items with equal words are one, under the smallest item_id. Nulls: a null text has no words and matches nothing; a null doc_id or item_id is kept. Repeated rows
of a document give one row. Empty tables give no rows. Other columns are not read.

Scale: documents are read where they lie; hashes are joined map-side against the benchmark's, which are broadcast
only after a count within ``FEW`` rows, else joined by shuffle (then every document hash moves). Hits are aggregated
to distinct diagonals before they move and are written; the texts of the hit documents are found by a second read,
with the hit keys broadcast after the same check, else by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolens.llm.common import table, written

# Selected places (1) and ignored ones (0) of the fixed masks.
MASKS = ("11011", "1101001", "1010011")
LEAST = 9
# Equal words of an item that are enough, as a fraction.
SHARE = (4, 5)
# Scripts without spaces between words.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
# Further masks for items of exactly so many words.
SHORT = {1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("1111", "10111", "11101"), 6: ("101111", "111101")}
# Rows that are broadcast, at most: some 50 bytes each.
FEW = 500_000


def words(text: Column) -> Column:
    """Lower-case words of letters and digits."""
    clean = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N} \t-\r]+", "")
    return F.filter(F.split(F.regexp_replace(clean, UNSPACED, " $0 "), r"[ \t-\r]+"), lambda w: w != "")


def row_key() -> Column:
    """Names a row by its id and text (null-safe)."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text"))


def seeds(df: DataFrame, keep: list[str], masks: dict[str, set[int]], whole: bool) -> DataFrame:
    """``keep``, pos (from 0) and seed of each window and mask of ``df`` (column h: word hashes). ``masks``: the numbers
    of words of the items that a mask is for (empty: all); ``whole``: the rows are items."""

    def windows(number: int, mask: str, sizes: set[int]) -> Column:
        places = [i for i, c in enumerate(mask) if c == "1"]
        starts = F.sequence(F.lit(0), F.size("h") - len(mask))
        hashes = F.transform(starts, lambda i: F.xxhash64(F.lit(number), *[F.get("h", i + p) for p in places]))
        used = F.size("h") >= len(mask)
        used = used & F.size("h").isin(sorted(sizes)) if whole and sizes else used
        return F.when(used, hashes).otherwise(F.array().cast("array<bigint>"))

    columns = [windows(i, mask, sizes) for i, (mask, sizes) in enumerate(masks.items())]
    # Windows of a shorter mask reach farther: places without a window are null and match nothing.
    return df.select(*keep, F.posexplode(F.arrays_zip(*[c.alias(f"s{i}") for i, c in enumerate(columns)])).alias("pos", "s")).select(
        *keep, "pos", F.explode(F.array(*[F.col("s")[f"s{i}"] for i in range(len(columns))])).alias("seed")
    )


def masks_for(items: DataFrame) -> dict[str, set[int]]:
    """The masks, and those of SHORT that ``items`` (column words) have a use for."""
    masks: dict[str, set[int]] = {mask: set() for mask in MASKS}
    sizes = items.select(F.size("words").alias("n")).where(F.col("n") <= max(SHORT)).distinct()
    for n in sorted(r["n"] for r in sizes.collect()):  # six rows at most
        for mask in SHORT[n]:
            masks.setdefault(mask, set()).add(n)
    return masks


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """``df`` (a written table), to be broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def hit_diagonals(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct (row_key, item, diagonal) of equal seeds, written."""
    hashes = F.transform("words", lambda w: F.xxhash64(w)).alias("h")
    masks = masks_for(items)
    theirs = seeds(items.select("item", hashes), ["item"], masks, True).where("seed is not null")
    theirs = written(theirs.select("seed", "item", F.col("pos").alias("item_pos")), "seeds")
    d = docs.select(row_key().alias("row_key"), words(F.col("text")).alias("words"))
    ours = seeds(d.select("row_key", hashes), ["row_key"], masks, False)
    hits = ours.join(few(theirs), "seed").select("row_key", "item", (F.col("pos") - F.col("item_pos")).alias("diagonal"))
    return written(hits.distinct(), "hits")


def best_stretch(equal: Column) -> tuple[Column, Column]:
    """(score, equal words) of the best stretch of an array of 1 (equal) and 0, the one of more equal words first."""
    state = F.struct(F.lit(0).alias("score"), F.lit(0).alias("same"))
    begin = F.struct(state.alias("now"), state.alias("best"))

    def step(s: Column, e: Column) -> Column:
        score = s["now"]["score"] + F.when(e == 1, 1).otherwise(-1)
        now = F.when(score < 0, state).otherwise(F.struct(score.alias("score"), (s["now"]["same"] + e).alias("same")))
        return F.struct(now.alias("now"), F.greatest(s["best"], now).alias("best"))

    best = F.aggregate(equal, begin, step, lambda s: s["best"])
    return best["score"], best["same"]


def contaminated(docs: DataFrame, benchmark: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per contaminated document and item: row_key, doc_id, item_id, score, matched (equal words of the
    best stretch), item_words, first_word (where the item's first word would be in the document, from 0)."""
    texts = benchmark.select("item_id", words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = texts.groupBy("words").agg(F.min("item_id").alias("item_id"))
    items = written(items.select(F.xxhash64("words").alias("item"), "item_id", "words"), "items")
    hits = hit_diagonals(docs, items)
    named = hits.join(few(items, FEW // 10), "item")
    # One row per document and item: a document's words are not copied for each diagonal.
    named = written(named.groupBy("row_key", "item").agg(F.first("item_id").alias("item_id"), F.first("words").alias("item_words"), F.collect_set("diagonal").alias("diagonals")), "named")
    d = docs.select(row_key().alias("row_key"), "doc_id", "text")
    found = d.join(few(named, FEW // 10), "row_key").withColumn("words", words(F.col("text")))
    compared = F.transform(
        "diagonals",
        lambda g: F.struct(
            F.transform(F.sequence(F.lit(0), F.size("item_words") - 1), lambda i: F.when((g + i >= 0) & (F.get("words", g + i) == F.get("item_words", i)), 1).otherwise(0)).alias("equal"),
            g.alias("diagonal"),
        ),
    )
    found = found.withColumn("equal", F.explode(compared))
    score, same = best_stretch(F.col("equal.equal"))
    equal = F.aggregate("equal.equal", F.lit(0), lambda n, e: n + e)
    scored = found.select("row_key", "doc_id", "item_id", F.size("item_words").alias("item_words"), F.col("equal.diagonal").alias("first_word"), score.alias("score"), same.alias("matched"), equal.alias("equal"))
    scored = scored.where((F.col("score") >= least) | (F.col("equal") * SHARE[1] >= F.col("item_words") * SHARE[0]))
    best = F.max(F.struct("score", "matched", (-F.col("first_word")).alias("before"))).alias("best")
    return scored.groupBy("row_key", "doc_id", "item_id", "item_words").agg(best).select(
        "row_key", "doc_id", "item_id", F.col("best.score").alias("score"), F.col("best.matched").alias("matched"), "item_words", (-F.col("best.before")).alias("first_word")
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without benchmark passages."""
    gone = written(contaminated(docs, table(spark, sf_dir, "benchmark")).select("row_key").distinct(), "contaminated")
    # Ids and texts say which rows: rows that repeat a contaminated one go as well.
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key().alias("row_key"))
    return rows.join(few(gone), "row_key", "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op2: the contaminated documents and the items found in them."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    # Rows that repeat a document are one.
    return found.drop("row_key").groupBy("doc_id", "item_id", "item_words").agg(
        F.max(F.struct("score", "matched", (-F.col("first_word")).alias("before"))).alias("b")
    ).select("doc_id", "item_id", F.col("b.score").alias("score"), F.col("b.matched").alias("matched"), "item_words", (-F.col("b.before")).alias("first_word"))


def sql() -> str:
    def split(text: str) -> str:
        return rf"list_filter(regexp_split_to_array(regexp_replace(lower(coalesce({text}, '')), '[^\p{{L}}\p{{N}} \t-\r]+', '', 'g'), '[ \t-\r]+'), lambda w: w <> '')"

    def seed(side: str, key: str) -> str:
        each = []
        for number, mask in enumerate(MASKS):
            places = " || ' ' || ".join(f"w[p + {i + 1}]" for i, c in enumerate(mask) if c == "1")
            each.append(f"SELECT {key}, p, '{number} ' || {places} AS seed FROM (SELECT {key}, w, unnest(range(len(w) - {len(mask) - 1})) AS p FROM {side})")
        return " UNION ALL ".join(each)

    return f"""
WITH items AS (SELECT w, min(item_id) AS item_id FROM (SELECT item_id, {split('text')} AS w FROM benchmark) WHERE len(w) > 0 GROUP BY w),
docs AS (SELECT DISTINCT doc_id, {split('text')} AS w FROM documents),
d AS (SELECT row_number() OVER () AS r, doc_id, w FROM docs),
a AS ({seed('d', 'r')}), b AS ({seed('items', 'item_id')}),
hits AS (SELECT DISTINCT a.r, b.item_id, a.p - b.p AS g FROM a JOIN b USING (seed)),
places AS (SELECT h.r, h.item_id, h.g, unnest(range(len(i.w))) AS k FROM hits h JOIN items i USING (item_id)),
e AS (SELECT p.r, p.item_id, p.g, k, CASE WHEN g + k >= 0 AND d.w[g + k + 1] = i.w[k + 1] THEN 1 ELSE 0 END AS same
  FROM places p JOIN d USING (r) JOIN items i USING (item_id)),
c AS (SELECT *, sum(same) OVER w AS m, sum(2 * same - 1) OVER w AS s, sum(same) OVER w - same AS m0, sum(2 * same - 1) OVER w - (2 * same - 1) AS s0
  FROM e WINDOW w AS (PARTITION BY r, item_id, g ORDER BY k)),
stretch AS (SELECT x.r, x.item_id, x.g, max({{'score': y.s - x.s0, 'matched': y.m - x.m0}}) AS best
  FROM c x JOIN c y ON x.r = y.r AND x.item_id = y.item_id AND x.g = y.g AND y.k >= x.k GROUP BY ALL),
bests AS (SELECT d.doc_id, i.item_id, len(i.w)::INT AS item_words, max({{'score': best.score, 'matched': best.matched, 'before': -g}}) AS b
  FROM stretch t JOIN d USING (r) JOIN items i USING (item_id) WHERE best.score >= least({LEAST}, len(i.w)) GROUP BY ALL)
SELECT doc_id, item_id, b.score::INT AS score, b.matched::INT AS matched, item_words, (-b.before)::INT AS first_word FROM bests"""
