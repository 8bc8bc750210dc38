"""N-gram Jaccard self-join by universe partitioning and the pigeonhole principle.

A document is the set of its distinct 5-word shingles; two link when
100 * intersection >= 75 * union. Then their symmetric difference is at most
H = floor((r + s) / 7) for sizes r >= s. Sets fall into size bands; a band
hashes all tokens into m segments. Equal subsets in a segment, or subsets
one deletion apart, make a candidate. The larger set (the prober) gives each
segment 0, 1 (equal subset) or 2 units (also one deletion apart, in the wide
segments) until they exceed H: a linked pair must then meet in one of them.
Cost: large subsets are rare, so the largest are taken first and small ones
left out; by measured sharing a prober then compares only in its rarest
segments. Every set is indexed in its band and also probes the band below
when partners may lie there.

Equal sets are one class, so copies are never paired. In each signature group
members are first verified against one pivot (a star, for each set the pivot it meets most
often); only groups that still span several components compare the rest, across components only.
Sets that meet in crowded groups are dealt to cells around a hub, the set
with the most company. Within a cell, sets are told apart by their symmetric
differences from the hub (of x and y tokens): two sets that do not both link
with the hub can link only if their differences share (x + y - H) / 2 tokens,
hence one among the first of each (prefix filter; tokens that the hub lacks
come first, the rarest before others), so a cell never compares
all of its sets pair by pair. Of each set a sketch of parity bits is kept: a token
flips the bit of its hash, so the bits in which two sketches differ are never
more than the tokens in which the sets differ, and a candidate with more than H
such bits is no link. The others are verified by intersecting the whole sets.

Null texts and texts without words have an empty set and no link. A null
doc_id never is a component's id unless all of its members are null. Empty
tables give empty results; other columns are ignored. Sets are compared by
64-bit shingle hashes, classes by 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.llm.textkit import U64, release, reliable, shingles, shuffle_parts, splitmix, utf8, written

SLACK, CHUNK, BUCKET_SHINGLES, SIG_BITS = 1.2, 1 << 22, 3_000_000, 48
CROWD = 1024               # comparisons in one group from which its sets are dealt to cells
MARKS = 1 << 15            # bits of bitmap_construct_agg
EMPTY_SEGMENTS = 80        # bands of up to so many segments also index empty subsets
STEP, SEG = U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)


def salt(b: int) -> np.uint64:
    return U64((b + 1) * int(STEP) % 2**64)


def band(n: int) -> int:
    return (n // 3).bit_length() - 1


def top(b: int) -> int:
    return 3 * 2 ** (b + 1) - 1


def segments(b: int) -> int:
    return int(np.ceil(SLACK * (top(b) // 3 + 1))) + 1


PROBE, EXACT, LOW = 1, 2, 4        # bits of an entry: probed, equal subset, of the band below


def dealt(tokens: np.ndarray, b: int, m: int):
    """Mixed tokens, their segments, segment sizes."""
    mixed = splitmix(tokens ^ salt(b))
    seg = (mixed >> U64(33)).view(np.int64) % m
    return mixed, seg, np.bincount(seg, minlength=m)


def layout(tokens: np.ndarray, b: int, limit: int, index: bool):
    """Of one set in band ``b``: mixed tokens, their segments, segment sizes,
    probed segments, used segments. ``limit`` is H."""
    m = segments(b)
    wide = max(1, m // 16)
    mixed, seg, size = dealt(tokens, b, m)
    rank = np.argsort(-size, kind="stable")
    unit = np.where((rank < wide) & (size[rank] >= 2), 2, 1)
    need = int(np.searchsorted(np.cumsum(unit), limit + 1)) + 1
    probe = np.zeros(m, bool)
    probe[rank[:need]] = True
    return mixed, seg, size, probe, probe | (size > 0) | (index and m <= EMPTY_SEGMENTS)


def used(tokens: np.ndarray, b: int, limit: int, index: bool) -> int:
    """How many segments ``layout`` uses. No segment needs more than a unit, so
    where more than H hold tokens, probing adds none."""
    m = segments(b)
    if index and m <= EMPTY_SEGMENTS:
        return m
    held = np.count_nonzero(dealt(tokens, b, m)[2])
    return int(held) if held > limit else int(layout(tokens, b, limit, index)[4].sum())


def spares(n: int, tokens: np.ndarray) -> list[int]:
    """Per band of the set: used segments beyond the H + 1 that a prober
    needs. So many shared equal subsets may stay unprobed."""
    return [used(tokens, *p) - p[1] - 1 for p in plans(n)]


def signatures(tokens: np.ndarray, b: int, limit: int, index: bool):
    """(signatures, bits) of one set in band ``b``."""
    mixed, seg, size, probe, use = layout(tokens, b, limit, index)
    m = len(size)
    order = np.argsort(seg, kind="stable")
    total = np.zeros(m, np.uint64)
    held = np.flatnonzero(size)
    starts = np.concatenate([[0], np.cumsum(size[held])[:-1]]).astype(np.int64)
    total[held] = np.add.reduceat(mixed[order], starts)
    key = np.arange(1, m + 1).astype(np.uint64) * SEG + salt(b)
    sig = [splitmix(total[use] + key[use])]
    bits = [probe[use] * np.uint8(PROBE) | np.uint8(EXACT)]
    near = (seg < max(1, m // 16)) & (size[seg] >= 2)
    if not index:
        near &= probe[seg]
    if near.any():
        sig.append(splitmix(total[seg[near]] - mixed[near] + key[seg[near]]))
        bits.append(probe[seg[near]] * np.uint8(PROBE))
    bits = np.concatenate(bits) | np.uint8(0 if index else LOW)
    return np.concatenate(sig), bits


def plans(n: int):
    """(band, H, is its own band) of the bands that a set of ``n`` tokens uses."""
    if n < 3:       # partners of one or two tokens are equal sets
        return []
    b = band(n)
    own = [(b, 2 * n // 7, True)]
    return own + [(b - 1, (n + top(b - 1)) // 7, False)] if b and 3 * n <= 4 * top(b - 1) else own


def entries(tokens: np.ndarray):
    parts = [signatures(tokens, *p) for p in plans(len(tokens))]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def set_signatures(tokens: np.ndarray):
    sig, bits = entries(tokens)
    return sig, (bits & PROBE).astype(bool)


def identity(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    a = splitmix(tokens)
    n = U64(len(tokens))
    x = splitmix(np.array([a.sum(dtype=np.uint64) + n, splitmix(a ^ STEP).sum(dtype=np.uint64) ^ n], dtype=np.uint64))
    c = x.view(np.int64)
    return int(c[0]), int(c[1])


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parity bits of a set, as longs: some 4.7 bits for each token that linked
    sets of its band may differ in. A band's sketch folds to that of the band below."""
    longs = max(1, 2 ** band(len(tokens)) // 8) if len(tokens) > 2 else 1
    bits = np.bincount((tokens & U64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def sketches(sets: list[np.ndarray]) -> pa.Array:
    """Lists of longs from several sketches."""
    ends = np.cumsum([0, *map(len, sets)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]), pa.int64()))


def near(sa="sa", sb="sb", na="na", nb="nb"):
    """Whether sizes and sketches of two sets allow a link."""
    def folded(s):      # sizes that allow a link are a band apart at most
        return f"if(size({s}) > {longs}, zip_with(slice({s}, 1, {longs}), slice({s}, {longs} + 1, {longs}), (x, y) -> x ^ y), {s})"
    longs = f"least(size({sa}), size({sb}))"
    differ = f"aggregate(zip_with({folded(sa)}, {folded(sb)}, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)"
    return F.expr(f"4 * least({na}, {nb}) >= 3 * greatest({na}, {nb}) and 7 * {differ} <= {na} + {nb}")


def text_key(text):
    """th, tk: 96 bits of a text. Rows are told apart by it, as ids may be null or repeated."""
    return F.xxhash64(text).alias("th"), F.hash(text).alias("tk")


def profile(docs: DataFrame) -> DataFrame:
    """doc_id, th, tk, n_shingles, c1, c2 (set identity), own, low (spare units in
    its own band and in the one below), sketch of every row."""
    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            out, bits = [], []
            for i in range(b.num_rows):
                s = shingles(data[off[i]:off[i + 1]])
                out.append((len(s), *identity(s), *[*spares(len(s), s), 0, 0][:2]))
                bits.append(sketch(s))
            cols = [pa.array([r[j] for r in out], pa.int64()) for j in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *cols, sketches(bits)],
                                             names=["doc_id", "th", "tk", "n_shingles", "c1", "c2", "own", "low", "sketch"])
    return docs.select("doc_id", "text", *text_key("text")).mapInArrow(
        run, "doc_id long, th long, tk int, n_shingles long, c1 long, c2 long, own long, low long, sketch array<long>")


def planes(x: np.ndarray) -> bytes:
    """The bytes of ``x`` by significance: the empty high ones compress away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(data: np.ndarray, n: int, kind) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, n).T).view(kind).ravel()


def _groups(docs: DataFrame, buckets: int) -> DataFrame:
    """sig, rec, bits, pivot of all members of signature groups of several
    sets. Signatures travel as ``SIG_BITS`` bits (a clash only adds a
    candidate), sorted and as differences, by bucket; a set's identity once
    per pack."""
    def emit(batches):
        held, size = [], 0
        for b in batches:
            data, off = utf8(b.column(0))
            for i in range(b.num_rows):
                s = shingles(data[off[i]:off[i + 1]])
                g, f = entries(s)
                if len(g):
                    held.append((g, f, identity(s)[0] & ~1))
                    size += len(g)
                if size >= CHUNK:
                    yield pack(held)
                    held, size = [], 0
        if held:
            yield pack(held)

    def pack(held):
        g = np.concatenate([x for x, _, _ in held]) >> U64(64 - SIG_BITS)
        recs, nth = np.unique(np.array([r for _, _, r in held], np.int64), return_inverse=True)
        code = (np.repeat(nth, [len(x) for x, _, _ in held]).astype(np.uint32) << np.uint32(3)) | np.concatenate([f for _, f, _ in held])
        where, low = g % U64(buckets), g // U64(buckets)
        key = where * U64((1 << SIG_BITS) // buckets + 1) + low
        order = np.lexsort((code, key))
        code, key, low, where = code[order], key[order], low[order], where[order].astype(np.int64)
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])      # copies of a set within the chunk
        code, low, where = code[fresh], low[fresh], where[fresh]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(where)) + 1, [len(where)]])
        out = []
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            names, at = np.unique(code[a:z] >> np.uint32(3), return_inverse=True)
            c = at.astype(np.uint32) << np.uint32(3) | code[a:z] & np.uint32(7)
            out.append(np.array([len(names), z - a], np.int64).tobytes() + recs[names].tobytes()
                       + planes(np.diff(low[a:z], prepend=U64(0))) + planes(c))
        return pa.RecordBatch.from_arrays([pa.array(where[cut[:-1]]), pa.array(out, pa.binary())], names=["bucket", "entries"])

    def unpack(data):
        raw = np.frombuffer(data, np.uint8)
        k, n = raw[:16].view(np.int64).tolist()
        at = 16 + 8 * k
        recs = raw[16:at].view(np.int64)
        low = np.cumsum(unplanes(raw[at:at + 8 * n], n, np.uint64))
        code = unplanes(raw[at + 8 * n:], n, np.uint32)
        return low, recs[code >> np.uint32(3)], (code & np.uint32(7)).astype(np.uint8)

    def meet(table):
        got = [unpack(x.as_buffer()) for x in table.column("entries")]
        low, rec, bits = (np.concatenate([g[j] for g in got]) for j in range(3))
        del got
        order = np.lexsort((bits, rec, low))
        low, rec, bits = low[order], rec[order], bits[order]
        start = np.concatenate([[0], np.flatnonzero(np.diff(low)) + 1])
        stop = np.append(start[1:], len(low))
        pick = np.repeat(rec[start] != rec[stop - 1], stop - start)     # sorted by set within a group
        pivot = np.repeat(rec[start], stop - start)
        fresh = np.ones(len(low), bool)
        fresh[1:] = (low[1:] != low[:-1]) | (rec[1:] != rec[:-1]) | (bits[1:] != bits[:-1])
        pick &= fresh
        sig = low[pick].view(np.int64) * buckets + table.column("bucket")[0].as_py()
        return pa.table({"sig": sig, "rec": rec[pick], "bits": bits[pick].astype(np.int8), "pivot": pivot[pick]})

    packed = docs.select("text").mapInArrow(emit, "bucket long, entries binary")
    return packed.groupBy("bucket").applyInArrow(meet, "sig long, rec long, bits byte, pivot long")


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """rec, n, sketch, z (compressed text) of the texts with the given keys. Texts
    are a third of the size of their shingle sets, so they travel instead, and once:
    copies in a batch stay behind, those of several batches meet where the keys are joined."""
    def run(batches):
        import zstandard
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            data, off = utf8(b.column(1))
            one = list(dict(zip(zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True), range(b.num_rows), strict=True)).values())
            z = [press.compress(data[off[i]:off[i + 1]].tobytes()) for i in one]
            at = pa.array(one, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(2).take(at), pa.array(z, pa.binary())], names=["th", "tk", "z"])
    th, tk = text_key("text")
    small = docs.select(th, "text", tk).mapInArrow(run, "th long, tk int, z binary")
    # A set has one key, so by key and set its rows are dealt out already.
    return small.join(keys, ["th", "tk"]).dropDuplicates(["th", "tk", "rec"]).select("rec", "n", "sketch", "z")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets link. Sketches leave few to be compared,
    so only the texts of those are moved."""
    def run(batches):
        import zstandard
        press = zstandard.ZstdDecompressor()
        last = (None, None)
        for b in batches:
            keep = []
            for i, x, y in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                if i != last[0]:
                    last = (i, shingles(np.frombuffer(press.decompress(y.as_buffer()), np.uint8)))
                s, t = shingles(np.frombuffer(press.decompress(x.as_buffer()), np.uint8)), last[1]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= 75 * (len(s) + len(t) - both))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("rec").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}")), side)
    pairs = written(pairs.filter(near()).select("a", "b"), "near")
    release(texts.sparkSession)         # before texts are moved

    def of(side, z):
        return (texts.select(F.col("rec").alias(side), F.col("z").alias(z))
                .join(pairs.select(side), side, "left_semi"))
    j = pairs.join(of("a", "s"), "a").join(of("b", "t"), "b").select("a", "b", "s", "t")
    return j.mapInArrow(run, "a long, b long")


def _cells(crowded: DataFrame) -> DataFrame:
    """rec, cell: each set of the given groups with the hub that it meets most.
    The hub of a group is its member with the most company over all groups."""
    company = crowded.groupBy("rec").agg(F.sum("held").alias("w"))
    hubs = crowded.join(company, "rec").groupBy("sig").agg(F.max(F.struct("w", "rec")).alias("top"))
    votes = (crowded.join(hubs, "sig").groupBy("rec", F.col("top.rec").alias("cell"))
             .agg(F.count(F.lit(1)).alias("met"), F.max("top.w").alias("w")))
    return votes.groupBy("rec").agg(F.max(F.struct("met", "w", "cell")).alias("top")).select("rec", "top.cell")


def _differences(cells: DataFrame, texts: DataFrame) -> DataFrame:
    """rec, cell, n, x (tokens in which a set and its hub differ), linked (with the hub), own, late, sketch.

    ``own`` are the tokens that the hub lacks, ``late`` those that only the hub
    has, in their order. A partner's difference has at least x - H tokens and H
    is at most n / 3, so a prefix is never longer than n / 3 + 1: of the late
    ones, which come after all own ones, only as many are kept as still fit."""
    def run(batches):
        import zstandard
        press = zstandard.ZstdDecompressor()
        last = (None, None)
        for b in batches:
            n, x, linked, own, late, bits = [], [], [], [], [], []
            for i, y, z in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                if i != last[0]:
                    last = (i, shingles(np.frombuffer(press.decompress(z.as_buffer()), np.uint8)))
                s = shingles(np.frombuffer(press.decompress(y.as_buffer()), np.uint8))
                d = np.setdiff1d(s, last[1], assume_unique=True).view(np.int64)
                e = np.sort(np.setdiff1d(last[1], s, assume_unique=True).view(np.int64))
                n.append(len(s))
                x.append(len(d) + len(e))
                linked.append(7 * x[-1] <= len(s) + len(last[1]))
                own.append(d)
                late.append(e[:max(0, len(s) // 3 + 1 - len(d))])
                bits.append(sketch(s))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(x, pa.int64()),
                                              pa.array(linked, pa.bool_()), pa.array(own, pa.list_(pa.int64())),
                                              pa.array(late, pa.list_(pa.int64())), sketches(bits)],
                                             names=["rec", "cell", "n", "x", "linked", "own", "late", "sketch"])
    j = (cells.join(texts.select("rec", F.col("z").alias("s")), "rec")
         .join(texts.select(F.col("rec").alias("cell"), F.col("z").alias("t")), "cell").select("rec", "cell", "s", "t"))
    return j.mapInArrow(run, "rec long, cell long, n long, x long, linked boolean, own array<long>, late array<long>, sketch array<long>")


def _within_cells(diffs: DataFrame) -> DataFrame:
    """The candidate pairs (a, b) of a cell, but for two sets that both link with the hub.

    One set of a pair is thus not linked with the hub. Of the linked sets only
    tokens that such a set of their cell may have become rows: a bitmap a cell
    tells which (a false hit only adds a row). Tokens left out are shared by no
    pair and the others only move forward in the order, so no pair is lost."""
    cols = ["rec", "cell", "n", "x", "linked"]
    bit = F.pmod(F.col("tok"), F.lit(MARKS)).cast("int")
    free = reliable(diffs.filter("not linked").select(
        *cols, F.posexplode(F.concat("own", "late")).alias("pos", "tok"), F.size("own").alias("m"))
        .select(*cols, "tok", (F.col("pos") >= F.col("m")).alias("late")))
    marks = free.groupBy(F.col("cell").alias("mc")).agg(F.bitmap_construct_agg(bit).alias("marks"))

    def marked(batches):
        for b in batches:
            held, toks, late = [], [], []
            for i, (t, e, m) in enumerate(zip(b.column(5), b.column(6), b.column(7), strict=True)):
                bits = np.unpackbits(np.frombuffer(m.as_buffer(), np.uint8), bitorder="little")
                for part in (t, e):
                    v = part.values.to_numpy(zero_copy_only=False)
                    v = v[bits[v % MARKS] > 0]
                    held.append(np.full(len(v), i))
                    toks.append(v)
                    late.append(np.full(len(v), part is e))
            if held:
                out = b.select(cols).take(pa.array(np.concatenate(held)))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(toks), pa.int64()), pa.array(np.concatenate(late), pa.bool_())],
                                                 names=[*cols, "tok", "late"])
    met = (diffs.filter("linked").join(marks, F.col("cell") == F.col("mc")).select(*cols, "own", "late", "marks")
           .mapInArrow(marked, free.schema))
    toks = reliable(free.unionByName(met))
    often = toks.groupBy("cell", "tok").agg(F.count(F.lit(1)).alias("df"))
    rare_first = Window.partitionBy("rec").orderBy("late", F.when(~F.col("late"), F.col("df")), "tok")
    at = (toks.join(often, ["cell", "tok"]).withColumn("at", F.row_number().over(rare_first))
          .filter("df > 1 and 3 * (at - 1) <= n").select("rec", "cell", "n", "x", "linked", "tok", "at"))
    at = reliable(at.join(diffs.select("rec", "sketch"), "rec"))
    a = at.filter("not linked").select("cell", "tok", F.col("rec").alias("a"), F.col("n").alias("na"), F.col("x").alias("xa"), F.col("at").alias("ia"), F.col("sketch").alias("sa"))
    b = at.select("cell", "tok", F.col("rec").alias("b"), F.col("n").alias("nb"), F.col("x").alias("xb"), F.col("at").alias("ib"), F.col("sketch").alias("sb"))
    share = F.expr("ceil((xa + xb - floor((na + nb) / 7)) / 2)")
    fits = ((F.col("a") != F.col("b")) & (F.col("ia") <= F.col("xa") - share + 1) & (F.col("ib") <= F.col("xb") - share + 1)
            & near())
    return a.join(b, ["cell", "tok"]).filter(fits).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """rec, comp (smallest rec reachable) of every end of an edge: smallest
    neighbour labels and pointer jumping until nothing changes."""
    both = reliable(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = reliable(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("comp")).withColumnRenamed("a", "rec"))
    while True:
        near = (both.join(label.withColumnRenamed("rec", "b"), "b").groupBy("a").agg(F.min("comp").alias("near")))
        nxt = label.join(near.withColumnRenamed("a", "rec"), "rec").select("rec", "comp", F.least("comp", "near").alias("low"))
        jump = label.select(F.col("rec").alias("low"), F.col("comp").alias("far"))
        nxt = reliable(nxt.join(jump, "low", "left").select("rec", F.col("comp").alias("old"), F.coalesce("far", "low").alias("comp")))
        label = nxt.select("rec", "comp")
        release(edges.sparkSession)
        if not nxt.filter("old <> comp").head(1):
            return label


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (rec, comp) after further links: the components of the
    components, so that only links between them count."""
    ends = links
    for side in ("a", "b"):
        at = label.select(F.col("rec").alias(side), F.col("comp").alias(f"c{side}"))
        ends = ends.join(at, side, "left").withColumn(f"c{side}", F.coalesce(f"c{side}", side))
    top = components(reliable(ends.filter("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()))
    up = top.select(F.col("rec").alias("comp"), F.col("comp").alias("up"))
    alone = top.join(label.select("rec"), "rec", "left_anti")       # sets that had no link so far
    return reliable(label.join(up, "comp", "left").select("rec", F.coalesce("up", "comp").alias("comp")).unionByName(alone))


def _sized(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The distinct pairs whose sizes allow a link, smaller identity first."""
    p = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in ("a", "b"):
        p = p.join(sizes.select(F.col("rec").alias(side), F.col("n").alias(f"n{side}")), side)
    return p.filter("4 * least(na, nb) >= 3 * greatest(na, nb)").select("a", "b")


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id, class_size of every row."""
    return _joined(docs).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                                F.coalesce("class_id", "doc_id").alias("class_id"),
                                F.coalesce("class_size", F.lit(1)).alias("class_size"))


def _joined(docs: DataFrame) -> DataFrame:
    """Every row with its text key, class and component (comp; null for an empty set)."""
    spark = docs.sparkSession
    rows = reliable(profile(docs))
    total = rows.agg(F.sum("n_shingles").alias("n")).collect()[0]["n"] or 0
    classes = reliable(rows.filter("n_shingles > 0").groupBy("c1", "c2").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.first("n_shingles").alias("n"),
        F.min(F.struct("th", "tk")).alias("key"), F.first(F.struct("own", "low", "sketch")).alias("set"))
        .withColumn("rec", F.col("c1").bitwiseAND(F.lit(~1))))
    sets = classes.select("rec", "n", "set.own", "set.low").dropDuplicates(["rec"])
    members = written(_groups(docs, max(2 * shuffle_parts(spark), -(-total // BUCKET_SHINGLES))), "members")
    release(spark)

    # Stars: each set against the pivot with which it shares most groups.
    votes = members.filter("rec <> pivot").groupBy("rec", "pivot").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("rec").agg(F.max(F.struct("n", "pivot")).alias("top"))
    star = reliable(_sized(best.select(F.col("rec").alias("a"), F.col("top.pivot").alias("b")), sets))
    keys = (classes.select("rec", "n", "key.th", "key.tk", "set.sketch").dropDuplicates(["rec"])
            .join(members.select("rec").distinct(), "rec"))
    release(spark)      # packs of signatures that the last call still found in use
    texts = written(_texts(docs, keys), "texts")
    edges = reliable(_links(star, texts))
    release(spark)
    label = components(edges)

    # Groups that still span components. A used segment that no other
    # component shares is a unit without a match, so of its shared segments a
    # prober takes only the rarest that fill up H + 1 units. (Where equal
    # subsets alone do not reach H + 1, it takes its first allocation.)
    comp = members.join(label, "rec", "left").select("sig", "rec", "bits", F.coalesce("comp", "rec").alias("comp"))
    spans = (comp.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("held"))
             .filter("lo <> hi").select("sig", "held"))
    rest = written(comp.join(spans, "sig").join(sets, "rec").select(
        "sig", "rec", "bits", "comp", "held", "n", F.col("bits").bitwiseAND(F.lit(LOW)).alias("side"),
        F.when(F.col("bits").bitwiseAND(F.lit(LOW)) == 0, F.col("own")).otherwise(F.col("low")).alias("spare")), "open")
    release(spark)
    exact = F.col("bits").bitwiseAND(F.lit(EXACT)) > 0
    common_first = Window.partitionBy("rec", "side").orderBy(F.desc("held"), "sig")
    probes = (rest.filter(exact & (F.col("spare") >= 0)).withColumn("at", F.row_number().over(common_first))
              .filter("at > spare").drop("at")
              .unionByName(rest.filter((F.col("bits").bitwiseAND(F.lit(PROBE)) > 0) & (F.col("spare") < 0))))
    probes = reliable(probes.select("sig", F.col("rec").alias("a"), F.col("comp").alias("x"), F.col("n").alias("na"), "held"))
    crowds = (probes.groupBy("sig").agg((F.count(F.lit(1)) * F.first("held")).alias("work"))
              .filter(F.col("work") > CROWD).select("sig"))
    crowded = reliable(rest.join(crowds, "sig").select("sig", "rec", "held"))
    cells = written(_cells(crowded), "cells")
    diffs = reliable(_differences(cells, texts))
    release(spark)

    # Groups inside one cell are done with; elsewhere only sets of different cells meet.
    whole = (crowded.join(cells, "rec").groupBy("sig").agg(F.min("cell").alias("lo"), F.max("cell").alias("hi"))
             .filter("lo = hi").select("sig"))
    index = (rest.filter("side = 0").join(cells, "rec", "left")
             .select("sig", F.col("rec").alias("b"), F.col("comp").alias("y"), F.col("n").alias("nb"), F.col("cell").alias("cb")))
    probes = probes.drop("held").join(whole, "sig", "left_anti").join(cells.select(F.col("rec").alias("a"), F.col("cell").alias("ca")), "a", "left")
    across = probes.join(index, "sig").filter("x <> y and nb <= na and 4 * nb >= 3 * na and (ca = cb) is not true").select("a", "b").distinct()
    # Both sides told the sizes apart; what sketches rule out goes in _links.
    pairs = across.unionByName(_within_cells(diffs)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = reliable(pairs.join(star, ["a", "b"], "left_anti"))
    release(spark)
    hubs = diffs.filter("linked and rec <> cell").select(F.col("rec").alias("a"), F.col("cell").alias("b"))
    label = merged(label, hubs.unionByName(reliable(_links(pairs, texts))))
    named = classes.join(label, "rec", "left").withColumn("comp", F.coalesce("comp", "rec"))
    low = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = reliable(named.join(low, "comp").select("c1", "c2", "class_id", "class_size", "comp", "component_id"))
    return rows.join(named, ["c1", "c2"], "left")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component the row with the smallest id (null last), then text
    key, with all columns. Rows equal in id and text stay or go together."""
    rows = _joined(docs).filter("comp is not null").select(
        "comp", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "tk").alias("row"))
    rows = reliable(rows.distinct())
    best = rows.groupBy("comp").agg(F.min("row").alias("best"))
    gone = reliable(rows.join(best, "comp").filter("row <> best").select(
        F.col("row.doc_id").alias("__gone"), F.col("row.th").alias("__th"), F.col("row.tk").alias("__tk")).distinct())
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]) & (F.xxhash64(docs["text"]) == gone["__th"])
                     & (F.hash(docs["text"]) == gone["__tk"]), "left_anti")
