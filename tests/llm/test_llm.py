"""The training-data operators against brute-force versions on small tables."""
import hashlib
import os
import re
import sys
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("riskspark.llm")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402
from riskspark.llm import (bpe_bytes, decontaminate, exact_dedup, language, licenses, ngram_join, pii,  # noqa: E402
                           quality, queries, textkit, token_files, toxicity)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, sig long"
LONG = "lorem ipsum dolor sit amet " * 8000


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, None), (2, ""), (3, "   \n"), (4, "one two"), (5, "ONE two"), (6, LONG), (7, LONG), (7, LONG),
            (None, "a b c d e f"), (None, None), (8, "a b c d e f g"), (9, "a\x0bb\tc d e f g"), (10, "1234 !!")]
    return spark.createDataFrame([(i, t, "en", "s", 0, 1.0, 5) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return textkit.read_table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return textkit.read_table(spark, SF, "labels")


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def shingle_set(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def near_table(spark, n=120, seed=1):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if i % 3 == 0 or not rows:
            t = list(rng.choice(vocab, rng.integers(1, 70)))
        else:
            t = rows[rng.integers(len(rows))][:]
            for _ in range(rng.integers(0, 3)):
                t[rng.integers(len(t))] = str(rng.choice(vocab))
            if rng.random() < .3:
                t += list(rng.choice(vocab, rng.integers(1, 6)))
        rows.append(t)
    return spark.createDataFrame([(i, " ".join(t), "en", "s", 0, 0.0, 0) for i, t in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_join_brute_force(spark, seed):
    df = near_table(spark, 240, seed)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect()), key=str)
    assert got == brute_components(pairs(df))


def test_join_crowded_group_brute_force(spark, monkeypatch):
    """Hundreds of copies of two related texts with zero to eight edits: the
    cells around hubs find the components of all pairs, with far fewer pairs."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(260):
        t = list(base) if i % 3 else base[:90] + [f"v{j}" for j in range(60)]
        for at in rng.integers(0, 150, i % 9):
            t[at] = f"x{rng.integers(0, 40 if i % 2 else 10**6)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = sorted(brute_components([(r["doc_id"], r["text"]) for r in df.collect()]), key=str)
    seen, inner = [], ngram_join._links

    def links(pairs, texts):
        seen.append(pairs.count())
        return inner(pairs, texts)

    monkeypatch.setattr(ngram_join, "_links", links)
    for crowd in (0, ngram_join.CROWD, 10**9):
        monkeypatch.setattr(ngram_join, "CROWD", crowd)
        got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect()), key=str)
        assert got == expected, crowd
    assert seen[1] < seen[5] / 2


def test_join_later_links_count_between_components_only(spark, monkeypatch):
    """Near copies that the first comparisons already join are not walked
    again as edges, and their pairs are not joined with the sizes again."""
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join([*base[:100], f"x{i}", *base[101:]])) for i in range(40)]
    seen, sized, inner, by_size = [], [], ngram_join.components, ngram_join._sized

    def components(edges):
        seen.append(edges.count())
        return inner(edges)

    def counted(pairs, sizes):
        sized.append(1)
        return by_size(pairs, sizes)
    monkeypatch.setattr(ngram_join, "components", components)
    monkeypatch.setattr(ngram_join, "_sized", counted)
    got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(i, 0) for i in range(40)]
    assert seen[0] >= 39 and seen[1] == 0 and len(sized) == 1


def test_join_null_and_repeated_ids(spark):
    """Near copies whose ids are null, or shared by texts that have nothing in common."""
    base = near_table(spark, 150, 4).select("doc_id", "text").collect()
    rows = [(None if i % 4 == 1 else r["doc_id"] % 40, r["text"]) for i, r in enumerate(base)]
    a = [f"a{i}" for i in range(60)]
    b = a[:58] + ["x", "y"]
    c = b[2:] + ["z", "q"]
    rows += [(1000, " ".join(a)), (None, " ".join(b)), (1002, " ".join(c))]         # linked through the null id
    df = spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in rows], SCHEMA)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect()), key=str)
    assert got == brute_components(rows)
    two = [(7, " ".join(a)), (7, "k l m n o p q r s"), (7, " ".join(b)), (8, " ".join(c)), (3, "k l m n o p q r s"), (None, " ".join(a) + " e"), (None, "")]
    kept = pairs(ngram_join.keep_one(spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in two], SCHEMA)))
    assert len(kept) == 3 and (3, two[4][1]) in kept and (None, "") in kept
    assert [x for x in kept if x[0] == 7] in ([two[0]], [two[2]])


def test_join_documents_and_odd(docs, odd, empty):
    for df in (docs, odd):
        got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect()), key=str)
        assert got == brute_components(pairs(df))
    assert ngram_join.join(empty).count() == 0


def test_join_compares_few_unlinked_near_copies(spark, monkeypatch):
    """Near copies with too many edits to link: sketches tell nearly all of the
    candidates apart before their texts are moved and compared."""
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 5000, 150)]
    rows = []
    for i in range(160):
        t = list(base)
        for at in rng.choice(150, 6 + i % 5, replace=False):
            t[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(t)))
    asked, compared, inner, kept = [], [], ngram_join._links, ngram_join.written

    def links(pairs, texts):
        asked.append(pairs.count())
        return inner(pairs, texts)

    def written(df, tag):
        out = kept(df, tag)
        if tag == "near":
            compared.append(out.count())
        return out
    monkeypatch.setattr(ngram_join, "_links", links)
    monkeypatch.setattr(ngram_join, "written", written)
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in
                  ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_components(rows)
    assert len(compared) == 2 and sum(compared) < sum(asked) / 4, (asked, compared)


def test_sketches_allow_every_linked_pair(spark):
    """Sketches differ in no more bits than the sets in tokens, across bands too."""
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(600):
        n = int(rng.integers(1, 800)) if rng.random() < .7 else int(rng.choice([24, 48, 96, 192, 384, 768])) + int(rng.integers(-4, 5))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        k, more = rng.integers(0, n // 3 + 2, 2) if rng.random() < .5 else (0, n // 3)
        b = np.unique(np.concatenate([a[int(k):], rng.integers(0, 2**63, int(more), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        rows.append((len(a), len(b), ngram_join.sketch(a).tolist(), ngram_join.sketch(b).tolist(), 100 * both >= 75 * (len(a) + len(b) - both)))
    df = spark.createDataFrame(rows, "na long, nb long, sa array<long>, sb array<long>, linked boolean")
    got = df.select("linked", ngram_join.near().alias("near"), (F.size("sa") != F.size("sb")).alias("bands")).collect()
    assert all(r["near"] for r in got if r["linked"])
    assert sum(r["linked"] and r["bands"] for r in got) > 10 and sum(not r["near"] for r in got) > 100


def test_join_moves_each_text_once(spark, monkeypatch):
    """Texts are dealt out by key and not again by set, without copies; what was
    shuffled for the groups is let go before."""
    rows = [(i, " ".join(f"w{i % 3}x{j}" for j in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    keys = docs.select(*ngram_join.text_key("text")).distinct().select(
        "th", "tk", F.col("th").alias("rec"), F.lit(26).alias("n"), F.array(F.lit(0)).alias("sketch"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = ngram_join._texts(docs, keys)
        moved = [x for x in texts._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning(" in x]
        assert moved and not any("hashpartitioning(rec" in x for x in moved), moved
        import zstandard
        got = sorted(zstandard.ZstdDecompressor().decompress(bytes(r["z"])).decode() for r in texts.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(t for _, t in rows[:3])
    steps = []
    for name in ("release", "written", "reliable"):
        def noted(*args, inner=getattr(ngram_join, name), name=name):
            steps.append((name, *args[1:]))
            return inner(*args)
        monkeypatch.setattr(ngram_join, name, noted)
    assert {r["component_id"] for r in ngram_join.join(docs).collect()} == {0, 1, 2}
    at = steps.index(("written", "texts"))
    assert steps[at - 2:at] == [("reliable",), ("release",)]
    at = steps.index(("written", "near"))
    assert steps[at + 1] == ("release",)


def test_spares_count_used_segments():
    rng = np.random.default_rng(4)
    for n in [*range(3, 60), 100, 190, 400, 767, 768, 2000]:
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        assert ngram_join.spares(n, a) == [int(ngram_join.layout(a, *p)[4].sum()) - p[1] - 1 for p in ngram_join.plans(n)]


def test_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(0)
    for _ in range(1500):
        n = int(rng.integers(3, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        k = int(rng.integers(0, n // 7 + 2))
        b = np.unique(np.concatenate([a[k:], rng.integers(0, 2**63, int(rng.integers(0, n // 7 + 2)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        (sa, fa), (sb, fb) = ngram_join.set_signatures(a), ngram_join.set_signatures(b)
        if len(a) == len(b) == both or min(len(a), len(b)) < 3:
            continue
        assert set(sa[fa].tolist()) & set(sb.tolist()) or set(sb[fb].tolist()) & set(sa.tolist())


def test_exact_dedup(docs, odd, empty):
    for df in (docs, odd):
        rows, groups = pairs(df), {}
        for d, t in rows:
            groups.setdefault(t, []).append(-1 if d is None else d)
        got = exact_dedup.mark(df).collect()
        assert len(got) == len(rows)
        assert sum(r["kept"] for r in got) == len(groups)
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): v for t, v in groups.items()}
        for r in got:
            v = by_sha[r["text_sha256"]]
            assert (-1 if r["keep_id"] is None else r["keep_id"]) == max(v) and r["group_size"] == len(v)
            assert not r["kept"] or r["doc_id"] == r["keep_id"]
        kept = exact_dedup.drop_copies(df)
        assert kept.columns == df.columns and sorted(t for _, t in pairs(kept)) == sorted(groups)
    assert exact_dedup.mark(empty).count() == 0


def test_byte_bpe(docs, odd, empty):
    path, pattern = queries.rank_path()
    enc, _ = bpe_bytes.encoder(path, pattern)
    for df in (docs, odd):
        want = sorted((str(d), hashlib.sha256(np.array(enc.encode_ordinary(t), "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(t.encode()).hexdigest()) for d, t in pairs(df))
        got = bpe_bytes.digest_documents(df, path, pattern).collect()
        assert sorted((str(r["doc_id"]), r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
        assert all(r["round_trip"] for r in got)
    assert bpe_bytes.digest_documents(empty, path, pattern).count() == 0


def test_token_files(spark, docs, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    named = docs.sparkSession.createDataFrame(
        [(1, "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|>\n<|endoftext|>"), (2, "É\u0301 <|endoftext|><|endoftext|>"),
         *[(None, f"w{i}") for i in range(300)], *[(5, f"v{i}") for i in range(300)]], "doc_id long, text string")
    assert 49407 in lib.encode("x <|endoftext|>", add_special_tokens=False).ids
    for df in (docs, named, odd):
        at, want = 0, []
        keyed = [(d, t, h) for (d, t), h in zip(pairs(df), [r[0] for r in df.select(
            F.xxhash64(F.coalesce("text", F.lit("")))).collect()], strict=True)]
        for d, t, _ in sorted(keyed, key=lambda x: (x[0] is not None, x[0] or 0, x[2], x[1])):
            ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
            want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
        manifest = token_files.write_documents(df, path, 2)
        got = [tuple(r) for r in token_files.read_documents(manifest).collect()]
        assert sorted(got, key=lambda r: r[1]) == want
    some = manifest.orderBy("shard").collect()[-1]["path"]
    (d, ids), = list(token_files.read_file(some, {10}))
    assert d == 10 and ids.endswith(b"\x02\x00\x00\x00")
    assert token_files.read_documents(token_files.write_documents(empty, path, 2)).count() == 0


def test_classifiers_run_on_odd_rows(docs, labels, odd, empty):
    m = toxicity.fit(docs, labels)
    s = toxicity.score(odd, m).collect()
    assert len(s) == odd.count() and all(0 <= r["score"] <= 1 for r in s)
    assert toxicity.fit(empty, labels.limit(0))["base"] == 0.0
    m = quality.fit(docs, labels)
    assert all(0 <= r["score"] <= 1 for r in quality.score(odd, m).collect())
    assert quality.score(empty, m).count() == 0
    m = language.fit(docs)
    got = language.predict(odd, m).collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 10)} == {"und"}
    assert language.fit(empty)["langs"] == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    d, lab = textkit.read_table(spark, sf, "documents"), textkit.read_table(spark, sf, "labels")
    g = queries.op1_language(spark, sf).join(d.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert g.filter("lang = lang_pred").count() >= 0.97 * g.count()
    q = queries.op10_quality(spark, sf).join(lab, "doc_id").filter("held_out")
    assert q.filter("quality = predicted").count() >= 0.95 * q.count()
    t = queries.op6_toxicity(spark, sf).join(lab, "doc_id").filter("held_out and toxic = 0")
    assert t.filter("predicted = 1").count() <= 0.03 * t.count()


def test_toxicity_folding_and_exceptions():
    assert toxicity.fold("You 1DI0T, trаsh") == " you idiot trash "
    m = {"lexicon": {" trash ": 3.0, " idio": 2.0}, "exceptions": [" trash can "]}
    auto = toxicity.automaton(m)
    assert not toxicity.hits(toxicity.fold("the trash can"), auto)
    assert [w for _, w, _ in toxicity.hits(toxicity.fold("trash idiot"), auto)] == [3.0, 2.0]


REF = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(t):
    out = []
    for k, p in REF.items():
        for m in re.finditer(p, t):
            v = m[0]
            d = re.sub("[^0-9]", "", v)
            luhn = sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, d[::-1])))
            ok = {"email": True, "ip": k == "ip" and all(int(x) <= 255 for x in v.split(".")),
                  "card": 16 <= len(d) <= 19 and luhn % 10 == 0, "phone": 8 <= len(d) <= 15}[k]
            if ok:
                out.append(f"{k}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii(spark, odd, docs, empty):
    texts = ["é mail a.b@c.d_x@e.f.g ip 1.2.3.4.5.6.7.8 and 256.1.1.1", "1.2.3.4", "", None, "call +1 (017) 555-7713.", "@@ a@b a@b.c.",
             "4111 1111 1111 1111 x", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "+49 30-1234 5678 😀 x@y.zz", "+12 3.4.5.6 7"]
    extra = spark.createDataFrame([(100 + i, t, "en", "s", 0, 0.0, 0) for i, t in enumerate(texts)], SCHEMA)
    for df in (extra, odd, docs):
        found = pii.find(df, textkit.reliable)
        got = sorted((str(r["doc_id"]), r["b"]) for r in found.select("doc_id", pii.text_of(F.col("base")).alias("b")).collect())
        assert got == sorted((str(d), base_spans(t)) for d, t in pairs(df))
    assert pii.find(empty, textkit.reliable).count() == 0


def test_pii_added_spans(spark):
    """The classifier adds what its labelers agree on and leaves bare look-alikes; no added span overlaps a base one."""
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = ([f'api token = "{key}"', "please mail jane.doe [at] web [dot] org now", "call (212) 555-0147 today"] * 40
             + [f"x{'ab' * 17}y", f"commit/{'a' * 33}/end", "room-(012) 555-01470"] * 40 + ["+1 (212) 555-0147", f"mail {key}@a.bc"])
    df = spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["a"] for r in pii.find(df, textkit.reliable).select("doc_id", pii.text_of(F.col("all")).alias("a")).collect()}
    want = {0: "secret:13:53", 1: "masked:12:39", 2: "number:5:19"}
    for i, t in enumerate(texts[:240]):
        assert got[i] == (want[i % 3] if i < 120 else ""), t
    assert got[240] == "phone:0:17" and got[241] == f"email:5:{5 + len(key) + 5}"


def test_pii_classifier_uses_more_than_votes():
    """Candidates of equal votes are told apart by what goes with the other candidates' votes."""
    k = pii.KINDS.index("secret")
    counts = {(k, 0b0001111): 900, (k, 0b0001011): 300, (k, 0b0000000): 900, (k, 0b1000000): 300, (k, 0b0000001): 20, (k, 0b0001001): 20}
    z = pii.classifier(counts)[k]
    assert z[0b0001111] > 0 > z[0] and z[0b0001001] > z[0b0000001]
    assert pii.classifier({}).shape == (len(pii.KINDS), 128)


def test_pii_many_matches(spark):
    """Blocks join at the right places, and matches in great number stay cheap."""
    text = "".join(f"call (212) 555-{i % 10000:04d} or u{i}@ex.org; " for i in range(16_000))
    start = time.time()
    (r,) = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"), textkit.reliable).collect()
    took = time.time() - start
    assert [(s["s"], s["e"]) for s in r["base"]] == [m.span() for m in re.finditer(r"u[0-9]+@ex\.org", text)]
    assert [(s["s"], s["e"]) for s in r["all"][16_000:]] == [m.span() for m in re.finditer(r"\(212\) 555-[0-9]{4}", text)]
    assert took < 60


def test_pii_long_runs(spark):
    card = "4111 1111 1111 1111"
    texts = ["1 " * 100_000 + "x " + card, "12-" * 50_000 + "3", "7" * 100_000, "+1 " + "2 " * 50_000, "a" * 100_000 + "@b" + ".c" * 50_000,
             "5 x " + card + ", 6"]
    df = spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r["base"] for r in pii.find(df, textkit.reliable).collect()}
    assert [(s["k"], s["s"], s["e"]) for s in got[0]] == [("card", 200_002, 200_021)]
    assert [(s["k"], s["s"], s["e"]) for s in got[5]] == [("card", 4, 23)]
    assert not got[1] and not got[2] and not got[3] and [s["k"] for s in got[4]] == ["email"]


def test_licenses(spark, odd):
    t = "é one two\nLicensed under the Apache License, Version 2.0. more words here"
    df = odd.unionByName(spark.createDataFrame([(50, t, "en", "s", 0, 0.0, 0)], SCHEMA))
    (r,) = licenses.scan(df).collect()
    assert (r["doc_id"], r["license"], r["coverage"]) == (50, "apache-2.0", 1.0) and t[r["start"]:r["end"]].startswith("Licensed under")


def test_license_texts(spark, empty):
    """Near relatives are told apart, whole texts and changed ones found, look-alikes left."""
    mit = licenses.TEMPLATES["mit"]
    body = mit[1].split()
    cut = " ".join(w if i % 5 else "other" for i, w in enumerate(body))
    want = [("Licensed under CC BY 4.0", ["cc-by-4.0"]), ("so licensed under CC BY-NC 4.0 now", ["cc-by-nc-4.0"]),
            ("Released under an MIT License", ["mit"]), ("# SPDX-License-Identifier: MIT", ["mit"]), (mit[1], ["mit"]), (cut, ["mit"]),
            ("x y " + licenses.TEMPLATES["apache-2.0"][1] + " z", ["apache-2.0"]), (licenses.TEMPLATES["gpl-2.0"][0], ["gpl-2.0"]),
            (mit[0] + " words between " + mit[0], ["mit", "mit"]), ("Permission is hereby granted to leave the software meeting", []),
            ("the license", []), ("", []), (None, [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {}
    for r in licenses.scan(df).collect():
        got.setdefault(r["doc_id"], []).append(r["license"])
    assert got == {i: w for i, (_, w) in enumerate(want) if w}
    assert licenses.scan(empty).count() == 0


def test_license_fingerprints_cover_every_match():
    """Brute force: whichever quarter of a short template's words is replaced, the index still finds it."""
    import itertools
    for n in range(4, 13):
        words = [f"w{i}" for i in range(n)]
        idx = licenses.index({"t": (" ".join(words),)})
        for gone in itertools.combinations(range(n), int(n * 0.25)):
            text = " ".join("a b c " .split() + [("x" if i in gone else w) for i, w in enumerate(words)] + ["d"])
            (hit,) = licenses.scan_text(np.frombuffer(text.encode(), np.uint8), idx)
            assert hit[1] == (n - len(gone)) / n


def test_decontamination(spark, odd, empty):
    q = "a train leaves the old station with 40 passengers and then 25 km later it stops and 40 people leave the train"
    bench = spark.createDataFrame([(1, q), (2, None), (3, "two words")], "item_id long, text string")
    rows = [(60, "intro words " + q.upper().lower() + " tail"), (61, q.replace("40", "77").replace("25", "3")),
            (62, q.replace("40", "77", 1)), (63, "nothing here at all of the kind that the item has in it")]
    df = odd.unionByName(spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in rows], SCHEMA))
    got = {r["doc_id"] for r in decontaminate.matches(df, bench).collect()}
    assert got == {60, 61}
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns and kept.count() == df.count() - 2
    assert decontaminate.matches(empty, bench).count() == 0 and decontaminate.matches(df, bench.limit(0)).count() == 0


def leaks(spark, texts, items):
    """{(doc, item)} of the matches; ids count from 0."""
    df = spark.createDataFrame([(i, t, "en", "s", 0, 0.0, 0) for i, t in enumerate(texts)], SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(df, bench).collect()}


def test_decontamination_without_broadcast(spark, monkeypatch):
    q = "a train leaves the old station with 40 passengers and then 25 km later it stops and 40 people leave the train"
    texts = [q, q.replace("40", "77"), q.replace("40", "77", 1), q[:50]]
    small = leaks(spark, texts, [q])
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert leaks(spark, texts, [q]) == small == {(0, 0), (1, 0)}


def test_decontamination_short_items(spark):
    """Items of one to three words match where they are the whole text, items of 4 to 8 anywhere, all from one cut."""
    items = ["Yes", "forty two", "Red green blue.", "one fine day outside", "a b c d e", "a1 bird in the old tree", "five six nine ten two three on", "Who wrote this big old red book?"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, "?!")], "item_id long, text string")
    rows = [(i, t.upper()) for i, t in enumerate(items)] + [(10 + i, f"before it comes {t} and more text goes on after that") for i, t in enumerate(items)]
    docs = spark.createDataFrame(rows + [(80, None), (81, ""), (82, "?!")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()}
    assert got == {(i, i) for i in range(8)} | {(10 + i, i) for i in range(3, 8)}
    plan = decontaminate.matches(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate posexplode") <= 2


def test_decontamination_by_blocks(spark, monkeypatch):
    """Windows that cross the edges of blocks count as those of one block; above the broadcast as well."""
    q = "a train leaves the old station with 40 passengers and then 25 km later it stops and 40 people leave the train"
    plain = "who wrote this big old red book that nobody in the whole town has ever read to its end"
    fill = [f"word{chr(97 + i)}" for i in range(26)]
    texts = [" ".join(fill[:n] + [t] + fill[n:]) for n in range(0, 20, 3) for t in (q, q.replace("40", "77"), q.replace("40", "77", 1), plain)]
    texts += ["", "Yes", "yes and no", " ".join(fill), " ".join([plain] * 4 + [q])]
    found = set()
    for block, rows, hashes in ((1 << 20, 1 << 20, 0), (8, 1 << 20, 0), (16, 0, 0)):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
        monkeypatch.setattr(decontaminate, "BROADCAST_HASHES", hashes)
        found.add(frozenset(leaks(spark, texts, [q, plain, "Yes", plain + " " + plain])))
    (same,) = found
    assert same >= {(4 * k + j, 0) for k in range(7) for j in (0, 1)} | {(4 * k + 3, 1) for k in range(7)} | {(29, 2), (32, 0), (32, 1), (32, 3)}
    assert not any((4 * k + 2, 0) in same for k in range(7))


def test_decontamination_windows_leave_the_text_behind(spark):
    """A text that holds an item hundreds of times: its hits do not each carry all its words (here 10 GB)."""
    from pyspark.sql import functions as F
    item = "a train leaves the old station with 40 passengers and then 25 km later it stops and 40 people leave the train"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, " ".join([item] * 800)), (2, "a clean text")], "doc_id long, text string")
    assert [tuple(r) for r in decontaminate.matches(docs, bench).collect()] == [(1, 1, 1.0)]
    toks = docs.select("doc_id", decontaminate.tokens(F.col("text")).alias("toks"))
    w = decontaminate.windows(toks, [8], lambda n: F.lit(True))
    assert "toks" not in w.columns and w.agg(F.max(F.size("part"))).first()[0] == 8
    size = toks.select(F.size("toks")).first()[0]
    assert [r["pos"] for r in w.filter("plain and doc_id = 1").select("pos").orderBy("pos").collect()] == list(range(size - 7))
    most, rows = decontaminate.blocks(toks).agg(F.max(F.size("toks")), F.count(F.lit(1))).first()
    assert most <= decontaminate.BLOCK + decontaminate.WINDOW - 1 and rows == -(-size // decontaminate.BLOCK) + 1


def test_decontamination_case(spark):
    q = "after the long trip Ann, Bob, Carl, Dora, Emil, Fritz and old Gustav sold the house, the garden, the boat and the car to Hans"
    texts = ["x " + q, q.upper(), q.lower(), q.title(), "Some words before, " + q.upper() + " and after", q.replace("Ann", "Zoe").replace("Hans", "Kim")]
    assert leaks(spark, texts, [q]) == {(i, 0) for i in range(6)}
    assert leaks(spark, texts, [q.upper()]) >= {(i, 0) for i in range(5)}


def test_decontamination_few_plain_words(spark):
    sums = "a clerk adds the following numbers to his long list 3 14 15 92 65 35 89 79 32 38 46 26 43 38 32 79 50 28"
    items = ["What is 7 times 8?", sums, "the people of \u0130zmir and of old Bursa walk home at dawn"]
    texts = ["so what is 7 times 8 then", "what is 9 times 8 then", sums, sums.replace("3", "4").replace("9", "1"),
             "1 14 15 92 65 35 89 79 32 and no more", items[2], items[2].upper()]
    assert leaks(spark, texts, items) == {(0, 0), (2, 1), (3, 1), (5, 2), (6, 2)}


def test_decontamination_one_changed_slot(spark):
    q = ("a train leaves the old station with 40 passengers and later it stops and 40 people leave the train while the driver "
         "of the other train waits at the bridge until the signal turns green and then goes on to the next town with 9 more")
    short = "the farmer sells 12 apples and the other farmer sells 12 pears while their son eats 12 plums and sells 12 figs"
    texts = [q, q.replace("40", "77", 1), q.replace("40", "77", 1).replace("9", "8"), q.replace("40", "77").replace("9", "8"),
             short.replace("12", "7"), short.replace("12", "7", 3).replace("figs", "dates"), short.replace("12", "7", 1).replace("12 pears", "8 pears").replace("12 plums", "9 plums")]
    assert leaks(spark, texts, [q, short]) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1)}


def test_pipeline_stages(spark, docs):
    d = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = textkit.written(stage(spark, d, SF), "t")
        assert out.columns == d.columns
        kept, before = {x for x, _ in pairs(out)}, pairs(d)
        if i == 1:
            best = {}
            for x, t in before:
                best[t] = max(best.get(t, x), x)
            assert kept == set(best.values())
        if i == 2:
            assert kept == {c for _, _, c in brute_components(before)}
        assert kept <= {x for x, _ in before}
        d = out
    assert corpus_pipeline.STAGES[-1][1](spark, d, SF).count() == d.count()
