"""Benchmark decontamination by template canonicalisation (DataFrame only).

Numbers, names (capitalised words inside a sentence, but not inside upper-case
text) and units become typed placeholders; case and punctuation go. Windows of
``WINDOW`` words of every document are hash-joined with those of the benchmark,
once by their words and, where they hold placeholders, once by their template.
At one alignment, the placeholders of the item must map consistently to values
of the document (same value in the item, same value in the document): a slot is
judged by the majority of the slots of its value, a tie has none, and a window
with an inconsistent slot does not count. The consistent windows and those with the very words must cover ``COVERAGE`` of the
item's, or those that are solid (below) ``COVERAGE`` of its solid ones. So a question with other numbers or names is still found, and a copy
in another case also.

An item shorter than a window is matched as one window of its own length; one
of under ``LEAST`` words only where it is the whole text. A null item, or one without words, matches nothing. A window is solid with ``SOLID``
plain words (or all its words, if fewer); others are found by their very words only. Null and empty texts match nothing. A document is a
row's id and text, so null or repeated ids neither share windows nor fates. Other columns are ignored.
A text is cut into blocks of ``BLOCK`` words, and a window carries its own words only, so
memory goes by the block and not by the text times its hits.
The benchmark's windows are broadcast up to ``BROADCAST_ROWS`` rows; above, both
sides are shuffled, the documents' windows only where their hash is one of the
benchmark's (up to ``BROADCAST_HASHES`` of them, else all). The result is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import reliable

WINDOW, LEAST, SOLID, COVERAGE = 8, 4, 4, 0.5
BLOCK = 1024
BROADCAST_ROWS, BROADCAST_HASHES = 200_000, 1_000_000
# Marks of slots, which stand before their word, and units.
NUM, NAME, UNIT = "\ue001", "\ue002", "\ue003"
MARKS, PAST = NUM + NAME + UNIT, "\ue004"
UNITS = ("km|kilometers?|kilometres?|cm|mm|meters?|metres?|miles?|feet|foot|inch|inches|kg|kilograms?|grams?|mg|pounds?|lbs?|ounces?|"
         "liters?|litres?|ml|gallons?|hours?|minutes?|seconds?|days?|weeks?|months?|years?|dollars?|euros?|cents?|percent|mph|kph")
NUMBER = r"\p{N}+(?:[.,]\p{N}+)*"
# After an upper-case word and a comma, a word all in upper case is running text.
NAMES = r"(?=\p{Lu})(?<=[\p{Ll},;] )(?!(?<=\p{Lu}[,;] )\p{Lu}+(?!\p{L}))"


def tokens(text):
    """Words and numbers without case; slots begin with their mark."""
    t = F.regexp_replace(F.translate(text, MARKS, "   "), NAMES, NAME)
    t = F.regexp_replace(t, rf"({NUMBER} ?)(?=(?i:{UNITS})(?!\p{{L}}))", f"$1{UNIT}")
    t = F.lower(F.upper(F.regexp_replace(t, NUMBER, f"{NUM}$0")))
    return F.regexp_extract_all(t, F.lit(rf"[{MARKS}]?(?:{NUMBER}|\p{{L}}+)"), F.lit(0))


def _slot(x):
    return (x >= NUM) & (x < PAST)


def _bare(x):
    return F.when(_slot(x), F.substring(x, 2, 1 << 30)).otherwise(x)


def _typed(x):
    return F.when(_slot(x), F.substring(x, 1, 1)).otherwise(x)


def _joined(left, right, ahead):
    """Element i of ``left`` hashed with element i + ``ahead`` of ``right``; as long as ``left``."""
    return F.zip_with(left, F.slice(right, F.lit(ahead + 1), F.greatest(F.size(right) - ahead, F.lit(0))), lambda x, y: F.xxhash64(x, y))


def _runs(h: str, lengths) -> dict:
    """Per length the hashes of all runs of so many words (of the array column
    ``h``) that begin in the block, by doubling: each is a hash of two shorter ones, whose columns
    ``h_2`` and ``h_4`` stand beside ``h``."""
    two, four = F.col(f"{h}_2"), F.col(f"{h}_4")
    made = {1: F.col(h), 2: two, 4: four}
    made[3] = _joined(two, F.col(h), 2)
    made[5], made[6] = _joined(four, F.col(h), 4), _joined(four, two, 4)
    made[7], made[8] = _joined(_joined(four, two, 4), F.col(h), 6), _joined(four, four, 4)
    return {n: F.slice(made[n], F.lit(1), _begun(F.size(h), n)) for n in lengths}


def _begun(size, n):
    """How many runs of ``n`` words begin in a block that holds ``size``."""
    return F.least(F.lit(BLOCK), F.greatest(size - n + 1, F.lit(0)))


def blocks(df: DataFrame) -> DataFrame:
    """A row for every ``BLOCK`` words of ``toks``, with the words that windows
    begun there may end in; start, the words before, and n_toks, those of all."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("toks") - 1, F.lit(0)), F.lit(BLOCK))
    df = df.select("*", F.size("toks").alias("n_toks"), F.transform(
        starts, lambda i: F.slice("toks", i + 1, F.lit(BLOCK + WINDOW - 1))).alias("blocks")).drop("toks")
    df = df.select("*", F.posexplode_outer("blocks").alias("block", "toks")).drop("blocks")
    return df.withColumn("start", F.col("block") * BLOCK).drop("block")


def windows(df: DataFrame, lengths, wanted) -> DataFrame:
    """len, wh, pos, plain, part: for each length whose condition ``wanted(n)``
    holds the hashes of all plain windows, and as many of the templates (but
    where equal, so only those with slots), with their place and their words.
    ``toks`` goes; ``wanted`` sees that of a block, ``n_toks`` is of the text.

    The words are a slice of the block: as that takes no lambda, it is made in
    the generated code of the explode, and for a join only where a window
    matches. With a lambda, rows would be copied before it, each with all words.

    The array is made in a projection of its own, below an outer explode: an
    expression in the explode itself would copy the words into every window's
    row, an inner one would add a filter that makes the array twice."""
    df = blocks(df)
    df = df.select("*", F.transform("toks", lambda x: F.xxhash64(_bare(x))).alias("hp"),
                   F.transform("toks", lambda x: F.xxhash64(_typed(x))).alias("ht"))
    df = df.select("*", *[_joined(h, F.col(h), 1).alias(f"{h}_2") for h in ("hp", "ht")])
    df = df.select("*", *[_joined(f"{h}_2", F.col(f"{h}_2"), 2).alias(f"{h}_4") for h in ("hp", "ht")])
    plain, typed = _runs("hp", lengths), _runs("ht", lengths)
    none = F.array().cast("array<bigint>")
    df = df.select("*", *[F.when(wanted(n), plain[n]).otherwise(none).alias(f"wp{n}") for n in lengths],
                   *[F.when(wanted(n), typed[n]).otherwise(none).alias(f"wt{n}") for n in lengths])
    parts = []
    for n in lengths:
        parts += [f"wp{n}", F.zip_with(f"wt{n}", f"wp{n}", lambda t, e: F.when(t != e, t))]
    drop = ["hp", "ht", "hp_2", "ht_2", "hp_4", "ht_4"] + [f"w{c}{n}" for c in "pt" for n in lengths]
    df = df.select("*", F.concat(*parts).alias("whs")).drop(*drop)
    df = df.select("*", F.posexplode_outer("whs").alias("at", "wh")).drop("whs").filter("wh is not null")
    # The place in the array gives the length and the place among its windows.
    size, start, length, k = F.size("toks"), F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int")
    for n in lengths:
        count = F.when(wanted(n), _begun(size, n)).otherwise(F.lit(0))
        here = (F.col("at") >= start) & (F.col("at") < start + 2 * count)
        length, k = F.when(here, F.lit(n)).otherwise(length), F.when(here, F.col("at") - start).otherwise(k)
        start = start + 2 * count
    df = df.withColumns({"len": length, "k": k}).drop("at")
    count, k, length = _begun(size, F.col("len")), F.col("k"), F.col("len")
    return df.withColumns({"pos": F.col("start") + k % count, "plain": k < count,
                           "part": F.slice("toks", k % count + 1, length)}).drop("toks", "k", "start", "n_toks")


def _solid(part, length):
    return F.size(F.filter(part, lambda x: ~_slot(x))) >= F.least(F.lit(SOLID), length)


def bench_windows(benchmark: DataFrame) -> DataFrame:
    """Per item one row for each plain window, and one for each solid window with slots."""
    b = (benchmark.select("item_id", tokens(F.col("text")).alias("toks")).filter(F.size("toks") > 0)
         .withColumn("own_len", F.least(F.lit(WINDOW), F.size("toks"))))
    b = b.withColumn("n_windows", F.size("toks") - F.col("own_len") + 1)
    b = b.withColumn("n_solid", F.size(F.filter(
        F.sequence(F.lit(1), F.col("n_windows")), lambda i: _solid(F.slice("toks", i, F.col("own_len")), F.col("own_len")))))
    b = windows(b, range(1, WINDOW + 1), lambda n: F.col("own_len") == n)
    b = b.withColumnsRenamed({"pos": "ipos", "plain": "exact"})
    b = b.withColumn("solid", _solid(F.col("part"), F.col("len")))
    slots = F.filter(F.transform("part", lambda x, i: F.when(_slot(x), F.struct(
        i.alias("at"), _bare(x).alias("i")))), lambda x: x.isNotNull())
    return reliable(b.filter(F.col("exact") | F.col("solid")).select(
        "item_id", "len", "n_windows", "n_solid", "ipos", "wh", "exact", "solid", F.when(~F.col("exact"), slots).alias("slots")))


def text_key(column: str):
    """128 bits that stand for a text."""
    return F.xxhash64(column).alias("k1"), F.xxhash64(F.lit(7), F.col(column)).alias("k2")


def _pairs(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """row (doc_id and text key), item_id, coverage."""
    bench = bench_windows(benchmark)
    lens = sorted(r["len"] for r in bench.select("len").distinct().collect())    # at most WINDOW values
    small = bench.count() <= BROADCAST_ROWS
    # A document is its id and text: null or repeated ids stay apart.
    d = docs.filter("text is not null").select(F.struct("doc_id", *text_key("text")).alias("row"), tokens(F.col("text")).alias("toks"))
    # A window of under LEAST words says little inside a text: there the whole text must be it.
    w = windows(d, lens or [WINDOW], lambda n: F.lit(True) if n >= LEAST else F.col("n_toks") == n)
    w = w.select("row", "wh", "len", "pos", F.when(~F.col("plain"), F.col("part")).alias("part"))
    if not small:       # most windows are in no item: those are not shuffled
        hashes = bench.select("wh").distinct()
        if hashes.count() <= BROADCAST_HASHES:
            w = w.join(F.broadcast(hashes), "wh", "left_semi")
    j = w.join(F.broadcast(bench) if small else bench, ["wh", "len"])
    hits = j.select("row", "item_id", "n_windows", "n_solid", "ipos", "solid", (F.col("pos") - F.col("ipos")).alias("diag"),
                    F.transform("slots", lambda s: F.struct((F.col("ipos") + s["at"]).alias("p"), s["i"].alias("i"), _bare(F.get("part", s["at"])).alias("d"))).alias("pairs"),
                    "exact")
    g = hits.groupBy("row", "item_id", "n_windows", "n_solid", "diag").agg(
        F.collect_set(F.struct("ipos", "solid", "exact", "pairs")).alias("seen"), F.flatten(F.collect_set("pairs")).alias("votes"))
    # A slot is consistent if most slots with its value in the item have its value in the document.
    g = g.withColumn("votes", F.array_distinct("votes")).withColumn("odd", F.filter("votes", lambda v: F.size(F.filter(
        "votes", lambda u: (u["i"] == v["i"]) & (u["d"] == v["d"]))) * 2 <= F.size(F.filter("votes", lambda u: u["i"] == v["i"]))))
    g = g.withColumn("seen", F.transform(F.filter("seen", lambda w: w["exact"] | ~F.arrays_overlap(w["pairs"], "odd")),
                                         lambda w: F.struct(w["ipos"].alias("ipos"), w["solid"].alias("solid"))))
    g = g.groupBy("row", "item_id", "n_windows", "n_solid").agg(F.array_distinct(F.flatten(F.collect_set("seen"))).alias("seen"))
    # Other values can only be found in solid windows, the very words in all.
    among = F.size(F.filter("seen", lambda x: x["solid"])) / F.nullif(F.col("n_solid"), F.lit(0))
    return (g.withColumn("coverage", F.greatest(F.size("seen") / F.col("n_windows"), among))
            .filter(F.col("coverage") >= COVERAGE).select("row", "item_id", "coverage"))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, coverage of every contaminated pair; rows equal in id
    and text give one."""
    return _pairs(docs, benchmark).select("row.doc_id", "item_id", "coverage")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose own text is in no contaminated pair, with all their
    columns. Other rows of the same or of no id stay."""
    bad = reliable(_pairs(docs, benchmark).select("row.k1", "row.k2").distinct())
    k1, k2 = text_key("text")
    return docs.join(bad, (k1 == bad["k1"]) & (k2 == bad["k2"]), "left_anti")
