"""Spelling variants of words by asymmetric q-chunks (DataFrame functions only).

Words are the runs of letters of all texts with their corpus-wide counts. Two
words are near when they differ by exactly one inserted, deleted or replaced
code point. Candidates: the shorter word of a pair (either, at equal length)
is cut into two disjoint chunks, its halves; the other one contributes its
grams of those lengths. One edit lies in at most one chunk, so the other chunk
is a gram of the longer word: one before the edit at its own place, one behind
it moved by the difference of the lengths, a shift of at most one. Grams at
any other place cannot meet a chunk and are not laid out. Chunks and grams
join on (length, chunk number, text) and every candidate is verified on the
whole words.

A chunk that many words share is not joined as it is: what remains of its
words beside the chunk is cut into two chunks again (one edit preserves one of
those too), until the group is small or one code point remains, so no group
yields all its pairs and none is cut off. Sizes of groups are counted, never
collected, and keys that only one side holds are dropped.

Cases: null or empty texts have no words; a null doc_id counts as the empty
string in the hash that decides on deletions; repeated rows count again; ties
between near words go to the smaller one in code-point order; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import reliable

RUN = "[A-Za-zÀ-ÿ]{%d,}+"
LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5
DELETE_EVERY = 199
CROWD = 256       # pairs of a chunk and a gram that one key may give before it is cut further
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def dictionary(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least LEAST_LETTERS code points and LEAST_COUNT
    occurrences. Shorter runs cannot become such words and are skipped."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all("text", F.lit(RUN % LEAST_LETTERS), F.lit(0))).alias("run"))
    runs = (runs.withColumn("run", F.translate("run", UPPER, LOWER))
            .withColumn("h", F.crc32(F.concat_ws(":", "id", "run"))))
    at = "cast(h % length(run) AS int)"
    word = (F.when(F.col("h") % DELETE_EVERY == 0, F.expr(f"concat(substring(run, 1, {at}), substring(run, {at} + 2))"))
            .otherwise(F.col("run")))
    return (runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LETTERS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _cut(rows: DataFrame) -> DataFrame:
    """Two rows a row: a chunk (or the gram it would have to meet) joins the
    key, the remainder of the word stays. ``d`` is how much longer the word is
    than the word it is to meet; null on the chunk side."""
    d = "coalesce(d, 0)"
    h = f"((length(rest) - {d}) DIV 2)"
    first = f"struct(xxhash64(key, 0, left(rest, {h})) AS key, substring(rest, {h} + 1) AS rest)"
    second = f"struct(xxhash64(key, 1, substring(rest, {h} + 1 + {d})) AS key, left(rest, {h} + {d}) AS rest)"
    return (rows.withColumn("part", F.expr(f"explode(array({first}, {second}))"))
            .select("word", "d", "part.key", "part.rest"))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b: every unordered pair of near words of ``words`` (column word) once."""
    level = words.select("word", F.explode(F.array(F.lit(None).cast("int"), F.lit(0), F.lit(1))).alias("d"))
    level = level.select("word", "d", (F.length("word") - F.coalesce("d", F.lit(0))).cast("long").alias("key"),
                         F.col("word").alias("rest"))
    found = None
    while True:
        level = reliable(_cut(level))
        sides = (level.groupBy("key").agg(F.count(F.when(F.col("d").isNull(), 1)).alias("chunks"), F.count("d").alias("grams"),
                                          F.max(F.length("rest") - F.coalesce("d", F.lit(0))).alias("left"))
                 .filter("chunks > 0 AND grams > 0"))
        sides = sides.select("key", ((F.col("chunks") * F.col("grams") > CROWD) & (F.col("left") > 1)).alias("crowded"))
        level = reliable(level.join(sides, "key"))
        ready = level.filter("NOT crowded")
        x = ready.filter("d IS NULL").select("key", F.col("word").alias("a"))
        y = ready.filter("d IS NOT NULL").select("key", F.col("word").alias("b"), "d")
        pairs = (x.join(y, "key").filter("(d = 1 OR a < b) AND levenshtein(a, b, 1) = 1").select("a", "b"))
        found = pairs if found is None else found.unionByName(pairs)
        level = level.filter("crowded").drop("crowded")
        if level.isEmpty():
            return found.distinct()


def roots(links: DataFrame) -> DataFrame:
    """word, root for each row word, form of ``links``: the last form of its
    chain. Counts grow fivefold along a chain, so a chain is short and each
    round doubles the steps taken."""
    state = links.select("word", F.col("form").alias("root"))
    while True:
        to = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = reliable(state.join(to, "root", "left")
                         .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if state.filter("moved").isEmpty():
            return state.drop("moved")
        state = state.drop("moved")


def group(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = reliable(dictionary(docs))
    pairs = reliable(near_pairs(words))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = (both.join(counts, "near").groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best")))
    fits = -F.col("best.k") >= TIMES * F.col("n")
    known = reliable(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.k")).alias("form_n")))
    last = roots(known.filter("form IS NOT NULL"))
    return (known.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
