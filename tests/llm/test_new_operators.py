"""Spelling variants, WARC archives and tokenizer alignment against brute force."""
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

pytest.importorskip("riskspark.llm")
import public_tokenizers  # noqa: E402
from riskspark.llm import alignment, queries, spelling, textkit, token_files, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- spelling
def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    variants = defaultdict(set)
    for w in n:
        for v in {w[:i] + "\0" + w[i + 1:] for i in range(len(w))} | {w[:i] + "\0" + w[i:] for i in range(len(w) + 1)}:
            variants[v].add(w)
    close = defaultdict(set)
    for group in variants.values():
        for x in group:
            close[x] |= {y for y in group if near(x, y)}
    form = {}
    for w in n:
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w] or "", root(w), k, len(close[w]), n[form[w]] if form[w] else 0) for w, k in n.items())


def as_rows(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in df.collect())


def spelling_rows():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    words += ["Straße", "ÀÉÎÕÜ×÷ÿ", "x" * 5000]
    rows = []
    for i in range(1500):
        picked = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(words[:8] if rng.random() < .4 else words)
            if rng.random() < .3:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", rng.choice("abcé"), w[k] + rng.choice("abcé")]) + w[k + 1:]
            picked.append(w.upper() if rng.random() < .1 else w)
        rows.append((None if i % 50 == 0 else i // 2, rng.choice([" ", "-", "1 "]).join(picked)))
    return rows + [(1, None), (2, ""), (3, "12 34")]


@pytest.mark.parametrize("crowd", [0, 4, spelling.CROWD, 10**9])
def test_spelling_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = spelling_rows()
    df = spark.createDataFrame([(i, t, "w", "r", 0) for i, t in rows], "doc_id long, text string, word string, root string, n int")
    expected = brute_spelling(rows)
    assert len(expected) > 150 and sum(bool(r[1]) for r in expected) > 20
    assert as_rows(spelling.group(df)) == expected


def test_spelling_query_on_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in textkit.read_table(spark, SF, "documents").collect()]
    assert as_rows(queries.op11_spelling(spark, SF)) == brute_spelling(rows)


def test_spelling_hash_hits(spark):
    """Every deletion the rule asks for, on a run that the hash hits."""
    hit = next(i for i in range(10_000) if zlib.crc32(f"{i}:letters".encode()) % 199 == 0)
    df = spark.createDataFrame([(hit, "Letters LETTERS letters letters letters")], "doc_id long, text string")
    assert as_rows(spelling.group(df)) == brute_spelling([(hit, "Letters LETTERS letters letters letters")])


def test_spelling_chain_of_forms(spark):
    text = " ".join(["abcdef"] * 3125 + ["abcdeg"] * 625 + ["abcdhg"] * 125 + ["abckhg"] * 25 + ["abmkhg"] * 5)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert as_rows(spelling.group(df)) == brute_spelling([(1, text)])


def test_spelling_empty(spark):
    for rows in ([], [(1, None), (2, "")]):
        assert spelling.group(spark.createDataFrame(rows, "doc_id long, text string")).collect() == []


def test_spelling_candidates_stay_few(spark):
    """A thousand words with one common half give few candidates a word."""
    rng = random.Random(1)
    words = {"prefix" + "".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(1500)}
    w = spark.createDataFrame([(x,) for x in words], "word string")
    got = {(r["a"], r["b"]) for r in spelling.near_pairs(w).collect()}
    expect = {tuple(sorted((x, y), key=lambda v: (len(v), v))) for x in words for y in words if x < y and near(x, y)}
    assert got == expect


# -------------------------------------------------------------------- WARC
def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "s", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, state string, segment int")


def brute_pages(rows, least=0):
    last = {}
    for i, _, h in rows:
        h = (h or "").encode()
        last[h] = max((x for x in (last.get(h), i) if x is not None), default=None)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        again = len(h) >= least and i != last[h]
        out.append((i, len(h), warc.digest32(h), "revisit" if again else "response", last[h] if again else None, "ok"))
    return sorted(out, key=str)


def page_rows(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["state"])
                   for r in df.collect()), key=str)


ROWS = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://x y\r\nWARC-Type: no", "é" * 30_000),
        (5, "u", None), (6, "u", ""), (7, "", "x" * 100_000), (None, "n", "x" * 100_000), (None, "n", "only null ids"),
        (None, "m", "only null ids"), (9, "r", "again"), (9, "r", "again"), (8, "r", "again"),
        (10, "c", "\r\n\r\n0\r\n\r\nWARC/1.1\r\n"), (11, "z", "z" * (16 << 10))]


@pytest.mark.parametrize(("segment", "size"), [(16 << 10, 64 << 20), (100, 64 << 20), (1000, 3000), (1, 64 << 20)])
def test_warc_round_trip(spark, tmp_path, segment, size):
    rows = ROWS if segment > 1 else [r for r in ROWS if len(r[2] or "") < 100]
    files = warc.write_pages(pages_of(spark, rows), f"file:{tmp_path}", segment_bytes=segment, file_bytes=size)
    assert page_rows(warc.read_pages(files)) == brute_pages(rows)
    if segment <= 1000:
        kinds = Counter(r["record_type"] for r in warc.read_records(files).collect())
        assert kinds["continuation"] > 100 or segment == 1
        whole = warc.reassemble(warc.read_records(files))
        got = sorted(r["payload"].decode() for r in whole.filter("record_type = 'response'").collect())
        response = {(b[0], b[2]) for b in brute_pages(rows) if b[3] == "response"}
        assert got == sorted(h or "" for i, _, h in rows if (i, warc.digest32((h or "").encode())) in response)


def test_warc_min_bytes_and_empty(spark):
    rows = [(1, "a", "ab"), (2, "b", "ab"), (3, "a", "abc"), (4, "b", "abc")]
    assert page_rows(warc.read_pages(warc.write_pages(pages_of(spark, rows), min_bytes=3))) == brute_pages(rows, 3)
    assert warc.read_pages(warc.write_pages(pages_of(spark, []))).collect() == []


def test_warc_faulty_segments():
    ok = [(2, None, b"cd"), (1, None, b"ab"), (3, 5, b"e")]
    assert warc.assembled(ok) == ("ok", b"abcde")
    assert warc.assembled([*ok, (2, None, b"cd")]) == ("ok", b"abcde")
    assert warc.assembled([*ok, (2, None, b"xx")])[0] == "conflict"
    assert warc.assembled(ok[1:])[0] == "incomplete"
    assert warc.assembled(ok[:2])[0] == "incomplete"
    assert warc.assembled([ok[0], ok[2]])[0] == "orphan"
    assert warc.assembled([ok[0], ok[1], (3, 9, b"e")])[0] == "length"
    assert warc.assembled([ok[0], ok[1], (3, 5, b"e"), (3, 6, b"e")])[0] == "length"


def test_warc_chunk_framing():
    for body in (b"", b"a", b"\r\n" * 5000, bytes(range(256)) * 100):
        for size in (1, 7, 4096):
            assert warc.unchunked(warc.chunked(body, size)) == body
    assert warc.unchunked(b"5;name=value\r\nhello\r\n0\r\nTrailer: x\r\n\r\n") == b"hello"
    for bad in (b"", b"5\r\nhel", b"zz\r\n", b"5\r\nhelloXX0\r\n\r\n", b"-1\r\n\r\n", b"5\r\nhello\r\n"):
        with pytest.raises(ValueError, match="chunk|trailer"):
            warc.unchunked(bad)


def test_warc_damage_is_reported(spark, tmp_path):
    """A missing segment, a flipped block and a missing response show as states."""
    rows = [(1, "a", "x" * 5000), (2, "b", "y" * 50), (3, "c", "y" * 50)]
    files = warc.write_pages(pages_of(spark, rows).coalesce(1), f"file:{tmp_path}/a", segment_bytes=1000)
    kept = []
    for path in [r["path"] for r in files.collect()]:
        system, at = token_files.file_system(path)
        with system.open_input_stream(at, compression=None) as f:
            kept += list(warc.members(f))
    changed = [r for r in kept if b"WARC-Segment-Number: 3" not in r and not (b"Page-ID: 3\r" in r and b"response" in r.split(b"\r\n")[1])]
    path = tmp_path / "bad.warc.gz"
    with open(path, "wb") as f:
        for r in changed:
            z = zlib.compressobj(1, zlib.DEFLATED, 31)
            f.write(z.compress(r) + z.flush())
    got = {r["page_id"]: r["state"] for r in warc.read_pages(spark.createDataFrame([(f"file:{path}",)], "path string")).collect()}
    assert got == {1: "incomplete", 2: "missing"}
    record = kept[0].replace(b"xxxx", b"xxzx", 1)
    fields, block = warc.parse(record)
    assert warc._row(fields, block, True)["state"] == "damaged"


def test_warc_query_and_sql(spark):
    got = page_rows(queries.op12_warc(spark, SF))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS FROM '{SF}/pages.parquet'")
    cols = "page_id, payload_bytes, payload_digest, record_type, refers_to, state"
    assert got == sorted(con.sql(f"SELECT {cols} FROM ({warc.SQL})").fetchall(), key=str)
    source = [(r["page_id"], r["url"], r["html"]) for r in textkit.read_table(spark, SF, "pages").collect()]
    assert got == brute_pages(source)


# --------------------------------------------------------------- alignment
def brute_alignment(rows):
    tok = alignment.loaded(A, B)
    docs, seen = [], Counter()

    def places(ids, names):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(names[i])))
            at += len(names[i])
        return out
    for i, t in rows:
        x = tok.a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = tok.b.encode(t) if t else []
        whole = b" " + (t or "").encode()
        if not t or b"".join(tok.a_bytes[k] for k in x) != whole or b"".join(tok.b_bytes[k] for k in y) != whole:
            docs.append((i, 0, 0, 0, Counter(), ""))
            continue
        x, y = places(x, tok.a_bytes), places(y, tok.b_bytes)
        groups, links, ga, gb = [], Counter(), [], []
        x, y = x + [(None, 1 << 60, 0)], y + [(None, 1 << 60, 0)]
        k = m = 0
        while x[k][0] is not None or y[m][0] is not None:
            if x[k][1] <= y[m][1]:
                ga.append(x[k])
                k += 1
            else:
                gb.append(y[m])
                m += 1
            if ga and gb and ga[-1][2] == gb[-1][2]:
                groups.append(",".join(str(v[0]) for v in ga) + "|" + ",".join(str(v[0]) for v in gb))
                links.update((u[0], v[0]) for u in ga for v in gb if u[1] < v[2] and v[1] < u[2])
                ga, gb = [], []
        x, y = x[:-1], y[:-1]
        assert not ga and not gb
        seen.update(links.keys())
        docs.append((i, len(x), len(y), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = Counter()
    for (k, _), n in seen.items():
        top[k] = max(top[k], n)
    return sorted(((i, a, b, g, sum(ln.values()), sum(n for p, n in ln.items() if seen[p] == top[p[0]]),
                    sum(n * seen[p] for p, n in ln.items()), h) for i, a, b, g, ln, h in docs), key=str)


def alignment_rows(df):
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def odd_texts():
    rng = random.Random(7)
    parts = ["a", " ", "  ", "\n", "é", "日", "'s", "12", "\t", "<s>", "\xa0", " the", "ing", "<|endoftext|>", "😀", "ﬁ", "\x00", "　"]
    rows = [(None, None), (1, ""), (2, " "), (3, "  a  b"), (3, "  a  b"), (4, "a▁b c d"), (5, "c a▁ b"), (6, "x" * 4000 + " " + "ab" * 900),
            (7, "<s> <|endoftext|> <unk> <0x0A>"), (None, "the end")]
    return rows + [(10 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(400)]


@pytest.mark.parametrize("size", [alignment.BLOCK_CHARS, 300])
def test_alignment_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", size)
    monkeypatch.setattr(alignment, "RUN_PIECES", 7 if size == 300 else 512)
    rows = odd_texts()
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id long, text string, n_a int, pairs string").repartition(3)
    assert alignment_rows(alignment.align(df, A, B)) == brute_alignment(rows)


def test_alignment_query_on_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in textkit.read_table(spark, SF, "documents").collect()]
    assert alignment_rows(queries.op13_alignment(spark, SF)) == brute_alignment(rows)


def test_alignment_empty(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
    got = alignment.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B)
    assert alignment_rows(got) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert got.filter(F.col("n_best").isNull()).count() == 0


# ------------------------------------------- rows, not ids, in older operators
def test_decontamination_goes_by_row(spark):
    """Null and repeated ids share neither windows nor fates."""
    from riskspark.llm import decontaminate
    words = "the quick brown fox jumps over a lazy dog while seven small birds watch quietly from their old".split()
    item = " ".join(words)
    rows = [(None, " ".join(words[:9]) + " and then it rained"), (None, " ".join(words[9:]) + " and then it rained"),
            (None, item), (7, f"see {item} here"), (7, "nothing to see in this clean row at all"), (8, "another clean row of text"),
            (None, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "k", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, k1 string, row int")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    half = decontaminate.matches(docs.filter("row < 2"), bench).collect()
    assert {r["doc_id"] for r in half} <= {None} and all(r["coverage"] < 1 for r in half)
    got = decontaminate.drop_contaminated(docs, bench)
    assert got.columns == docs.columns
    kept = {r["row"] for r in got.collect()}
    assert kept >= {4, 5, 6, 7} and not kept & {2, 3}
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows)


def test_two_clean_halves_do_not_add_up(spark):
    from riskspark.llm import decontaminate
    words = [f"word{chr(97 + i)}" for i in range(24)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    part = [" ".join(words[:12]), " ".join(words[8:20])]
    docs = spark.createDataFrame([(None, part[0]), (None, part[1]), (None, "a clean text of several plain words")], "doc_id long, text string")
    assert decontaminate.matches(docs, bench).collect() == []
    assert decontaminate.drop_contaminated(docs, bench).count() == 3


def test_drop_copies_keeps_columns_of_any_name(spark):
    from riskspark.llm import exact_dedup
    docs = spark.createDataFrame([(1, "x", "a", 5), (2, "x", "b", 6), (3, "y", "c", 7), (3, "y", "d", 8)],
                                 "doc_id long, text string, __sha256 string, sha256 int")
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    rows = {(r["doc_id"], r["__sha256"], r["sha256"]) for r in got.collect()}
    assert (2, "b", 6) in rows and len(rows) == 2 and rows <= {(2, "b", 6), (3, "c", 7), (3, "d", 8)}
    assert exact_dedup.drop_copies(docs.limit(0)).count() == 0


def test_labelled_sample_bounds_its_rows(spark):
    docs = spark.createDataFrame([(4, f"text {i}") for i in range(300)] + [(i, "t") for i in range(5, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(4, 1)], "doc_id long, quality int")
    sample, _ = textkit.labelled_sample(docs, labels, "quality", {0: 10, 1: 10})
    rows = sample.collect()
    assert len(rows) <= 20 and len({r["doc_id"] for r in rows}) == len(rows)


def test_word_hashes_have_no_structure():
    """Thue-Morse words and their complements, which powers of a factor hash alike, also over blocks of long words."""
    import numpy as np

    from riskspark.llm import textkit

    seen = set()
    for n in (6, 10, 12, 15, 16):
        bits = [bin(i).count("1") & 1 for i in range(1 << n)]
        for flip in (0, 1):
            data = np.array([97 + (b ^ flip) for b in bits], dtype=np.uint8)
            seen.add(int(textkit.word_hashes(data)[0]))
            spaced = np.concatenate([data, np.full(9000, 32, np.uint8), data, np.full(5, 10, np.uint8)])
            h = textkit.word_hashes(spaced)
            assert len(h) == 2 and h[0] == h[1] == textkit.word_hashes(data)[0]
    blocks = [np.concatenate([np.full(4096, 97 + b, np.uint8) for b in order]) for order in ((0, 1, 1, 0), (1, 0, 0, 1), (0, 0, 1, 1))]
    seen |= {int(textkit.word_hashes(b)[0]) for b in blocks}
    assert len(seen) == 13
