"""Token ids in files of independent zstandard frames with a seek table.

File: frames one after another, then a seek table, then a 20-byte footer
(table length u64, number of frames u32, magic 8 bytes). Each frame holds the
ids (little-endian u32) of consecutive documents and carries a checksum; the
table has, per frame, its offset, compressed length, CRC-32 of the compressed
bytes and its documents (doc_id, null flag, number of ids). A reader decompresses only
the frames of the documents it is asked for and checks both checksums.

Documents are range-partitioned and sorted by doc_id (null first; ties by a
hash of the text, then the text), one file a partition in the shared folder; a retried task writes a
file of its own and only the successful one is listed. Null text is empty; an
end id follows each document. A special token's name in a text is that token, as
the library has it by default. Words between spaces and line ends are encoded
once and kept (no token spans them), which gives the library's ids of the
whole text. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from riskspark.llm.textkit import reliable, shared_folder, shuffle_parts
from riskspark.session import checkpoint_dir, estimated_bytes

MAGIC = b"TOKFRAM1"
FRAME_IDS = 1 << 17
CACHE = 1 << 20
SPECIAL = "<|"      # how the names of special tokens begin
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")       # as long in UTF-8 after normalisation
MARKS = "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])"
RUN_WORDS = 512
STEP = 2000        # texts encoded at once
GROUP = 1024       # files whose ids are summed first
FILE_BYTES = 64 << 20
_tok: dict = {}


class Encoder:
    """The library's encoder with a bounded memory of words: their ids lie in
    one array, and a batch of texts is put together from it."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark's tasks are the threads
        self.lib = Tokenizer.from_file(path)
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():      # byte-level: a character a byte
            self.bytes[i] = len(token.removesuffix("</w>"))
        self.forget()

    def forget(self):
        self.place: dict[str, int] = {"": 0}
        self.ids, self.off = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def learn(self, words: list[str]):
        """Encode new words many at a time as running text. The bytes of a
        token are known, so a word's tokens end where its bytes do; words whose
        normalised bytes are not certain are encoded one by one."""
        plain = [w for w in words if PLAIN.fullmatch(w) and SPECIAL not in w]
        known = set(plain)
        odd = [w for w in words if w not in known]
        ids, sizes = [self.ids], [np.diff(self.off)]
        runs = [plain[i:i + RUN_WORDS] for i in range(0, len(plain), RUN_WORDS)]
        for lo in range(0, len(runs), 64):
            part = runs[lo:lo + 64]
            for run, e in zip(part, self.lib.encode_batch_fast([" ".join(r) for r in part], add_special_tokens=False), strict=True):
                got = np.array(e.ids, "<u4")
                size = np.cumsum([len(w.encode()) for w in run])
                end = np.cumsum(self.bytes[got])
                last = np.searchsorted(end, size)
                if end[-1] != size[-1] or (end[last] != size).any():
                    raise RuntimeError("the tokenizer does not keep the words apart")
                ids.append(got)
                sizes.append(np.diff(last, prepend=-1))
        for lo in range(0, len(odd), 20_000):
            for e in self.lib.encode_batch_fast(odd[lo:lo + 20_000], add_special_tokens=False):
                ids.append(np.array(e.ids, "<u4"))
                sizes.append(np.array([len(e.ids)]))
        self.place.update(zip(plain + odd, range(len(self.place), len(self.place) + len(words)), strict=True))
        self.ids = np.concatenate(ids)
        self.off = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets). Words stand between spaces and line
        ends, and a mark behind a letter begins a word: the tokenizer cuts
        there too. Case goes first unless a special token may be spelt out."""
        t = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        t = pc.if_else(pc.match_substring(t, SPECIAL), t, pc.ascii_lower(t))
        split = pc.split_pattern(pc.replace_substring_regex(t, pattern=MARKS, replacement=r"\1 \2"), " ")
        if isinstance(split, pa.ChunkedArray):
            split = split.combine_chunks()
        known = split.flatten().dictionary_encode()
        words = known.dictionary.to_pylist()
        if len(self.place) + len(words) > CACHE:
            self.forget()
        self.learn([w for w in words if w not in self.place])
        place = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        word = place[known.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        n = (self.off[1:] - self.off[:-1])[word]
        end = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.arange(end[-1]) - np.repeat(end[:-1] - self.off[word], n)]
        edge = split.offsets.to_numpy()
        return ids, end[edge - edge[0]]


def encoder(path: str) -> Encoder:
    if path not in _tok:
        _tok[path] = Encoder(path)
    return _tok[path]


def file_system(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri if "://" in uri else uri.replace("file:", "file://", 1))


class Writer:
    def __init__(self, out):
        import zstandard
        self.z = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
        self.out, self.at, self.table, self.frames = out, 0, [], 0
        self.docs: list = []
        self.buf: list[bytes] = []
        self.size = 0

    def add(self, doc_id, ids: bytes):
        self.docs.append((doc_id, len(ids) // 4))
        self.buf.append(ids)
        self.size += len(ids)
        if self.size >= 4 * FRAME_IDS:
            self.flush()

    def flush(self):
        if not self.docs:
            return
        frame = self.z.compress(b"".join(self.buf))
        self.out.write(frame)
        self.table.append(struct.pack("<QQII", self.at, len(frame), zlib.crc32(frame), len(self.docs))
                          + b"".join(struct.pack("<qBQ", d or 0, d is None, n) for d, n in self.docs))
        self.at += len(frame)
        self.frames += 1
        self.docs, self.buf, self.size = [], [], 0

    def close(self):
        self.flush()
        t = b"".join(self.table)
        self.out.write(t + struct.pack("<QI", len(t), self.frames) + MAGIC)


def seek_table(f) -> list[tuple[int, int, int, list]]:
    """(offset, length, crc, [(doc_id, n ids)]) of each frame of an open file."""
    size = f.size()
    length, frames = struct.unpack("<QI", f.read_at(12, size - 20))
    if f.read_at(8, size - 8) != MAGIC:
        raise ValueError("not a token file")
    t, at, out = f.read_at(length, size - 20 - length), 0, []
    for _ in range(frames):
        o, n, crc, k = struct.unpack_from("<QQII", t, at)
        at += 24
        docs = []
        for _ in range(k):
            d, null, m = struct.unpack_from("<qBQ", t, at)
            docs.append((None if null else d, m))
            at += 17
        out.append((o, n, crc, docs))
    return out


def read_file(uri: str, wanted=None):
    """(doc_id, ids as bytes) of a file's documents in order, or of ``wanted``
    ids only: frames without a wanted document are not read."""
    import zstandard
    system, path = file_system(uri)
    with system.open_input_file(path) as f:
        for o, n, crc, docs in seek_table(f):
            if wanted is not None and not any(d in wanted for d, _ in docs):
                continue
            frame = f.read_at(n, o)
            if zlib.crc32(frame) != crc:
                raise ValueError(f"frame at {o} of {uri} is damaged")
            raw, at = zstandard.ZstdDecompressor().decompress(frame), 0
            for d, m in docs:
                if wanted is None or d in wanted:
                    yield d, raw[at:at + 4 * m]
                at += 4 * m


def write_documents(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write all documents; returns the manifest: shard, path, n_docs, n_tokens."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    folder = folder or shared_folder(spark, "tokens")
    d = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))
    size = estimated_bytes(d) or 0
    # Inputs without an estimate (not files) report the largest long.
    parts = max(shuffle_parts(spark), -(-size // FILE_BYTES) if size < 1 << 60 else 0)
    # Rows of one id, or without one, are dealt by their texts.
    d = d.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "t").drop("h")
    end = struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext
        c = TaskContext.get()
        path = f"{folder}/{c.partitionId():06d}-{c.taskAttemptId()}.tok"
        enc, out, w, n_docs, n_ids = encoder(tokenizer_path), None, None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                system, at = file_system(path)
                system.create_dir(at.rpartition("/")[0], recursive=True)
                out = system.open_output_stream(at)
                w = Writer(out)
            for lo in range(0, b.num_rows, STEP):
                part = b.slice(lo, STEP)
                ids, edge = enc(part.column(1))
                for i, x, y in zip(part.column(0).to_pylist(), edge.tolist(), edge[1:].tolist(), strict=False):
                    w.add(i, ids[x:y].tobytes() + end)
                n_docs += part.num_rows
                n_ids += len(ids) + part.num_rows
        if out is not None:
            w.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([c.partitionId()], pa.int64()), "path": [path],
                                              "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_ids], pa.int64())})

    return reliable(d.mapInArrow(run, "shard long, path string, n_docs long, n_tokens long"))


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    # Ids before a file: those before its group of files and those before it
    # in the group; the windows see a row a group and GROUP rows.
    m = manifest.withColumn("g", F.floor(F.col("shard") / GROUP))
    before = F.coalesce(F.sum("n").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = m.groupBy("g").agg(F.sum("n_tokens").alias("n")).select("g", before.alias("first"))
    within = F.sum("n_tokens").over(Window.partitionBy("g").orderBy("shard")) - F.col("n_tokens")
    listed = (m.withColumn("within", within).join(groups, "g")
              .select("path", (F.col("first") + F.col("within")).alias("start")).repartition(max(1, manifest.count())))

    def run(batches):
        for b in batches:
            for path, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                for d, ids in read_file(path):
                    rows.append((d, at, len(ids) // 4, zlib.crc32(ids)))
                    at += len(ids) // 4
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _batch(rows):
    cols = list(zip(*rows, strict=True)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])
