"""Cross-tokenizer alignment by interval coalescing.

Both tokenizers cut the same bytes (a space, then the text). Tokens of both
are byte intervals: all of them are sorted by start (lexsort), the running
maximum of their ends is kept, and a group breaks where a start reaches that
maximum, that is where tokens of both end. Inside a group every pair of an A
and a B token whose intervals overlap is a link.

Texts are first cut between a non-space character and a single space. No
token of either tokenizer crosses such a place (A's split pattern and B's
pieces are checked for it when they are loaded; otherwise texts stay whole),
so a text's tokens, groups and links are those of its pieces in order, and a
block of documents aligns each distinct piece once. A text for which a piece
does not give back its bytes is judged whole.

Counts: an id pair's count is the number of documents that hold it linked.
Each block of documents keeps its distinct pairs in a table of its own, and a
document refers to their places there. Block tables are summed per pair by
Spark, joined back per (block, pair), and the documents of a block meet them
in a cogroup, which is as large as a block and not as a pair or an id. Pair
counts grow with the corpus and are never collected or broadcast.

Cases: null and empty texts, and texts whose tokens of A or B do not give
back space+text, have zeros and the digest ''; texts hold names of special
tokens as plain text; null and repeated doc_ids stay rows of their own and
each row counts as a document; an empty table gives no rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.llm.textkit import reliable, written

CUT = re.compile(r"(?<=\S) ")
BLOCK_CHARS = 4 << 20       # a block closes once it holds this many characters
BLOCK_DOCS = 4096
BATCH = 1 << 14
RUN_PIECES = 512
DIGITS = 6
_loaded: dict = {}


class Pair:
    """The two tokenizers and the bytes of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the threads
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                                else piece.replace("▁", " ").encode())
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        inner = re.compile(r"\S ")
        self.cuttable = not any(inner.search(x.decode("utf-8", "replace")) for x in self.a_bytes + self.b_bytes)

    def encode(self, texts: list[str]) -> tuple[list, list]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return a, self.b.encode(texts, num_threads=1)

    def faithful(self, text: str, a, b) -> bool:
        whole = b" " + text.encode()
        return (b"".join(map(self.a_bytes.__getitem__, a)) == whole
                and b"".join(map(self.b_bytes.__getitem__, b)) == whole)


def byte_alphabet() -> dict[str, int]:
    """Character of byte-level vocabularies -> byte: printable Latin-1 stands
    for itself, the other bytes are numbered from U+0100 upwards."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def loaded(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _loaded:
        _loaded[a_path, b_path] = Pair(a_path, b_path)
    return _loaded[a_path, b_path]


def spans(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of tokens that lie one behind the other. Texts of which
    both tokenizers give back the bytes keep in step without offsets of their own."""
    end = np.cumsum(lens)
    return end - lens, end


def coalesce(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each A and each B token: intervals in order of start,
    a new group where a start reaches the running maximum of the ends."""
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((end, start))
    s, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(s), bool)
    fresh[1:] = s[1:] >= reach[:-1]
    number = np.empty(len(s), np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number[:len(a_start)], number[len(a_start):]


def overlaps(a_start, a_end, b_start, b_end) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of every pair of tokens that share a byte."""
    low = np.searchsorted(b_end, a_start, "right")
    n = np.searchsorted(b_start, a_end, "left") - low
    i = np.repeat(np.arange(len(a_start)), n)
    first = np.cumsum(n) - n
    return i, np.arange(len(i)) - np.repeat(first - low, n)


class Aligned:
    """Tokens, groups and links of a list of texts, text by text. With
    ``joined`` the texts are pieces of CUT and are encoded many at a time, as
    running text that CUT would cut so again; a run that does not give back its bytes
    is encoded piece by piece."""

    def __init__(self, tok: Pair, texts: list[str], joined: bool):
        run = RUN_PIECES if joined else 1
        ids_a, ids_b, cut_a, cut_b, good = [], [], [], [], []
        for lo in range(0, len(texts), BATCH):
            part = texts[lo:lo + BATCH]
            runs, open_run = [], False
            for t in part:      # a piece with an open end (a text's last) has nothing behind it
                if open_run and len(runs[-1]) < run:
                    runs[-1].append(t)
                else:
                    runs.append([t])
                open_run = bool(t) and not t[-1].isspace()
            for pieces, x, y in zip(runs, *tok.encode([" ".join(r) for r in runs]), strict=True):
                if tok.faithful(" ".join(pieces), x, y):
                    one = [(pieces, x, y, True)]
                elif len(pieces) == 1:
                    one = [(pieces, [], [], False)]
                else:
                    one = [([t], u, v, True) if tok.faithful(t, u, v) else ([t], [], [], False)
                           for t, u, v in zip(pieces, *tok.encode(pieces), strict=True)]
                for texts_of, x, y, ok in one:
                    ids_a.append(np.array(x, np.int64))
                    ids_b.append(np.array(y, np.int64))
                    size = np.cumsum([len(t.encode()) + 1 for t in texts_of]) if ok else np.zeros(len(texts_of), np.int64)
                    # No token crosses a piece, so a piece's tokens end where its bytes do.
                    cut_a.append(np.diff(np.searchsorted(np.cumsum(tok.a_len[ids_a[-1]]), size, "right"), prepend=0))
                    cut_b.append(np.diff(np.searchsorted(np.cumsum(tok.b_len[ids_b[-1]]), size, "right"), prepend=0))
                    good += [ok] * len(texts_of)
        self.good = np.array(good, bool)
        self.a, self.b = joint(ids_a), joint(ids_b)
        self.n_a, self.n_b = joint(cut_a), joint(cut_b)
        a_off, b_off = offsets(self.n_a), offsets(self.n_b)
        spans_a, spans_b = spans(tok.a_len[self.a]), spans(tok.b_len[self.b])
        group_a, group_b = coalesce(*spans_a, *spans_b)
        i, j = overlaps(*spans_a, *spans_b)
        self.pair = (self.a[i] << 32) | self.b[j]
        self.pair_off = np.searchsorted(i, a_off)
        self.n_links = np.diff(self.pair_off)
        size = int(group_a[-1]) + 1 if len(group_a) else 0
        self.n_groups = np.diff(np.append(group_a, size)[a_off])
        self._write(group_a, group_b, size, a_off, b_off)

    def _write(self, group_a, group_b, size, a_off, b_off):
        """``written``: each text's groups as ``a1,a2|b1;a3|b2,b3;``. A token
        is its decimal digits and the sign behind it; tokens are laid out
        group by group, A's before B's."""
        n = len(group_a) + len(group_b)
        at_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")
        ids, sign = np.empty(n, np.int64), np.empty(n, np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        last_a, last_b = np.diff(group_a, append=size) > 0, np.diff(group_b, append=size) > 0
        sign[at_a], sign[at_b] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
        width = 1 + sum((ids >= 10 ** k).astype(np.int64) for k in range(1, DIGITS))
        chars = np.empty((n, DIGITS + 1), np.uint8)
        for k in range(DIGITS):
            chars[:, k] = ids // 10 ** np.maximum(width - 1 - k, 0) % 10 + ord("0")
        chars[np.arange(n), width] = sign
        line = chars[np.arange(DIGITS + 1) <= width[:, None]].tobytes()
        edge = offsets(width + 1)[a_off + b_off].tolist()
        self.written = [line[x:y] for x, y in zip(edge, edge[1:])]


def joint(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def ragged(off: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all values of the lists ``which``, and the list (by its place
    in ``which``) that each belongs to."""
    n = (off[1:] - off[:-1])[which]
    owner = np.repeat(np.arange(len(which)), n)
    return np.arange(len(owner)) - np.repeat(np.cumsum(n) - n - off[:-1][which], n), owner


def align_block(tok: Pair, texts: list[str | None], groups: bool = True) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """(a record per text, with its ``groups`` in writing if asked for, the block's distinct pairs, their document counts).
    A record's ``places`` are its distinct pairs as places in the block's
    table and ``times`` how often it holds each linked."""
    pieces: list[str] = []
    size = []
    for t in texts:
        cut = [] if not t else CUT.split(t) if tok.cuttable else [t]
        size.append(len(cut))
        pieces += cut
    known = pa.array(pieces, pa.string()).dictionary_encode()
    del pieces
    code = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    al = Aligned(tok, known.dictionary.to_pylist(), tok.cuttable)
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    whole: list[int] = []
    doc = np.repeat(np.arange(len(texts)), size)
    if len(code) and not al.good.all():
        bad = np.unique(doc[~al.good[code]])
        whole = bad.tolist()
    if whole:        # judged on the whole text, each as one piece
        extra = Aligned(tok, [texts[i] for i in whole], False)
    else:
        extra = None
    pick = np.isin(doc, whole, invert=True) if whole else slice(None)
    used, owner = code[pick], doc[pick]
    # distinct (document, piece) with its number of occurrences, then pairs
    key, times = np.unique(owner * max(1, len(al.good)) + used, return_counts=True)
    at, of = ragged(al.pair_off, key % max(1, len(al.good)))
    link_doc, link_pair, link_n = key[of] // max(1, len(al.good)), al.pair[at], times[of]
    if extra is not None:
        at, of = ragged(extra.pair_off, np.arange(len(whole)))
        link_doc = np.concatenate([link_doc, np.array(whole)[of]])
        link_pair = np.concatenate([link_pair, extra.pair[at]])
        link_n = np.concatenate([link_n, np.ones(len(at), np.int64)])
    table, local = np.unique(link_pair, return_inverse=True)
    both, inverse = np.unique(link_doc * max(1, len(table)) + local, return_inverse=True)
    times = np.bincount(inverse, weights=link_n, minlength=len(both)).astype(np.uint32)
    place, who = (both % max(1, len(table))).astype(np.uint32), both // max(1, len(table))
    seen = np.bincount(place, minlength=len(table)).astype(np.int64)
    edge = np.searchsorted(who, np.arange(len(texts) + 1))
    total = {f: np.bincount(owner, weights=getattr(al, f)[used], minlength=len(texts)).astype(np.int64)
             for f in ("n_a", "n_b", "n_groups", "n_links")}
    nth = {d: k for k, d in enumerate(whole)}
    codes = code.tolist()
    out = []
    for d in range(len(texts)):
        k = nth.get(d)
        if k is None:
            rec = {f: int(v[d]) for f, v in total.items()}
            line = b"".join([al.written[c] for c in codes[off[d]:off[d + 1]]])
        else:
            rec = {f: int(getattr(extra, f)[k]) for f in total}
            line = extra.written[k]
        line = line[:-1]
        rec["groups_sha256"] = hashlib.sha256(line).hexdigest() if rec["n_a"] else ""
        if groups:
            rec["groups"] = line
        rec["places"], rec["times"] = place[edge[d]:edge[d + 1]], times[edge[d]:edge[d + 1]]
        out.append(rec)
    return out, table, seen


DOC = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
       "places binary, times binary, pairs binary, seen binary")


def _blocks(batches):
    """Lists of (doc_id, text) rows that make up a block each."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            t = t.as_py()
            ids.append(i)
            texts.append(t)
            size += len(t or "")
            if size >= BLOCK_CHARS or len(ids) >= BLOCK_DOCS:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per document with its alignment, and one row per block (doc row
    fields null) that holds the block's pairs; a table in the shared folder."""
    def run(batches):
        import zstandard
        from pyspark import TaskContext
        tok, pack = loaded(a_path, b_path), zstandard.ZstdCompressor(level=1).compress
        part, n = TaskContext.get().partitionId(), 0
        for ids, texts in _blocks(batches):
            recs, table, seen = align_block(tok, texts, groups=False)
            block = (part << 32) | n
            n += 1
            rows = [{"block": block, "doc_id": i} | {k: r[k] for k in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                    | {"places": pack(r["places"].astype("<u4").tobytes()), "times": pack(r["times"].astype("<u4").tobytes()),
                       "pairs": None, "seen": None}
                    for i, r in zip(ids, recs, strict=True)]
            rows.append(dict.fromkeys(rows[0]) | {"block": block, "pairs": pack(table.astype("<i8").tobytes()),
                                                  "seen": pack(seen.astype("<i8").tobytes())})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                (k, pa.string() if k == "groups_sha256" else pa.binary() if k in ("places", "times", "pairs", "seen") else pa.int64())
                for k in rows[0]]))

    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DOC), "align")


def block_pairs(aligned: DataFrame) -> DataFrame:
    """block, place, pair, seen: the distinct pairs of each block."""
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for block, pairs, seen in zip(*[c.to_pylist() for c in b.columns], strict=True):
                pairs = np.frombuffer(unpack(pairs), "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), block)), pa.array(np.arange(len(pairs), dtype=np.int64)),
                     pa.array(pairs), pa.array(np.frombuffer(unpack(seen), "<i8"))],
                    names=["block", "place", "pair", "seen"])

    return (aligned.filter("pairs IS NOT NULL").select("block", "pairs", "seen")
            .mapInArrow(run, "block long, place long, pair long, seen long"))


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, n (documents that hold it linked), best (n is its A id's highest)."""
    counts = pairs.groupBy("pair").agg(F.sum("seen").alias("n"))
    counts = counts.withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    aligned = tokens(docs, a_path, b_path)
    pairs = block_pairs(aligned)
    counts = reliable(pair_counts(pairs))
    known = pairs.join(counts, "pair").select("block", "place", "n", "best")

    def run(left, right):
        import zstandard
        unpack = zstandard.ZstdDecompressor().decompress
        place = right["place"].to_numpy()
        n = np.zeros(len(place), np.int64)
        best = np.zeros(len(place), np.int64)
        n[place] = right["n"].to_numpy()
        best[place] = right["best"].to_numpy(zero_copy_only=False)
        total, most = [], []
        for p, t in zip(left["places"], left["times"], strict=True):
            p, t = np.frombuffer(unpack(p.as_py()), "<u4"), np.frombuffer(unpack(t.as_py()), "<u4").astype(np.int64)
            total.append(int((n[p] * t).sum()))
            most.append(int((best[p] * t).sum()))
        keep = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        return pa.Table.from_arrays([*keep.columns, pa.array(most, pa.int64()), pa.array(total, pa.int64()), left["groups_sha256"]],
                                    names=[*keep.column_names, "n_best", "count_sum", "groups_sha256"])

    rows = aligned.filter("pairs IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
                                                  "places", "times")
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
