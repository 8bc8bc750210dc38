"""Array kernels over UTF-8 bytes and small Spark helpers shared by the
operators of this subpackage.

The kernels work on whole Arrow columns (one value buffer plus offsets), so a
batch of documents costs a fixed number of numpy calls, not one per word.
Texts are never cut: a document longer than a block is walked block by block.
"""

from __future__ import annotations

import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskspark.session import checkpoint_dir, shared_path

U64 = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Word separators of the word-shingle operators: space and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
POW_LEN = 1 << 12

_rng = np.random.Generator(np.random.PCG64(20240607))


def _odd(n):
    return _rng.integers(0, 2**63, n, dtype=np.uint64) * U64(2) + U64(1)


# A word's hash sums one random number for each byte and place (tabulation), so
# no pattern of bytes cancels out, as it would with powers of one factor.
TABLE = _rng.integers(0, 2**64, (POW_LEN, 256), dtype=np.uint64)
TABLE[:, SPACE] = 0
TABLE = TABLE.reshape(-1)
SEQ = _odd(64)


def splitmix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of the public splitmix64 generator."""
    x = x + U64(0x9E3779B97F4A7C15)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = (np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
               if len(column) else np.zeros(1, np.int64))
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return values, offsets


def words(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each whitespace-separated word of ``data``."""
    if not len(data):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e
    a = LOWER[data] if lower else data
    gap = SPACE[a]
    x = np.empty(len(a) + 2, dtype=bool)
    x[0] = x[-1] = True
    x[1:-1] = gap
    edge = np.flatnonzero(x[1:] != x[:-1])
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    first = starts[0]
    spread = np.diff(np.append(starts, len(a)))
    pos = np.arange(first, len(a)) - np.repeat(starts, spread)
    if spread.max() <= POW_LEN:
        pos <<= 8
        pos |= a[first:]
        return splitmix(np.add.reduceat(TABLE[pos], starts - first)), starts, ends
    code = TABLE[((pos & (POW_LEN - 1)) << 8) | a[first:]]
    far = (pos >= POW_LEN) & ~gap[first:]
    if far.any():      # a word of over 4,096 bytes: each further block mixes the numbers anew (gaps stay 0)
        code[far] = splitmix(code[far] ^ splitmix((pos[far] >> 12).astype(np.uint64)))
    return splitmix(np.add.reduceat(code, starts - first)), starts, ends


BLOCK = 1 << 21


def word_hashes(data: np.ndarray, lower: bool = True) -> np.ndarray:
    """Word hashes of one text, walked in blocks that end at a separator."""
    if len(data) <= BLOCK:
        return words(data, lower)[0]
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data):
            gap = np.flatnonzero(SPACE[data[end:end + BLOCK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + BLOCK)
        out.append(words(data[at:end], lower)[0])
        at = end
    return np.concatenate(out)


def sequence_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = hashes[:n] * SEQ[0]
    for j in range(1, k):
        acc = acc + hashes[j:n + j] * SEQ[j]
    return splitmix(acc)


def shingles(data: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of one text; fewer
    than ``k`` words make one shingle of the whole sequence; none without words."""
    h = word_hashes(data)
    if not len(h):
        return h
    if len(h) < k:
        acc = (h * SEQ[8:8 + len(h)]).sum(dtype=np.uint64, keepdims=True)
        return splitmix(acc + np.array([len(h)], dtype=np.uint64) * SEQ[63])
    return np.unique(sequence_hashes(h, k))


# ---------------------------------------------------------------------------
# Spark helpers
# ---------------------------------------------------------------------------
def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage with an eager checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut lineage with a Parquet table in the shared folder."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    path = shared_path(spark, f"llm-{spark.sparkContext.applicationId}", f"{tag}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark, tag: str) -> str:
    """A new folder's full address in the shared folder. A path without a
    scheme is completed on the driver as Spark itself would, so that Python
    workers open it on the same file system."""
    checkpoint_dir(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, f"{tag}-{uuid.uuid4().hex[:12]}"))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark) -> None:
    """Let Spark's cleaner drop the shuffle files and checkpoints that no frame
    refers to any more; left alone, it waits for the driver's next full
    collection (``spark.cleaner.periodicGC.interval``, 30 minutes)."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def shuffle_parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def remainder(doc_id="doc_id"):
    """crc32 of doc_id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string")) % F.lit(4)


def held_out(doc_id="doc_id"):
    return F.coalesce(remainder(doc_id) == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: dict[int, int]):
    """(sample, class counts) to fit a binary classifier on.

    ``per_class`` bounds the sampled rows of each class: those with the
    smallest hash of their id, so the choice does not depend on the layout.
    Rows whose crc32(doc_id) mod 4 is 2, null labels and null ids are left
    out; of several labels of one id the largest counts, and of several rows of
    one id one text. The sample is at most ``sum(per_class)`` ids and rows; the
    ids are broadcast to the documents and only the sample's texts are shuffled. Returns columns ``doc_id, text, y`` (checkpointed) and the exact
    number of training labels per class."""
    lab = (labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
           .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & (remainder() != 2))
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    counts = {int(r["y"]): int(r["n"]) for r in lab.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = None
    for y, bound in per_class.items():
        part = (lab.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").limit(bound))
        ids = part if ids is None else ids.unionByName(part)
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # An id that stands on several rows is one of the sample: its least text by hash.
    found = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    return reliable(found.select("doc_id", F.col("t.text").alias("text"), "y")), counts


def logistic_fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps; the first column
    of ``x`` is the intercept and is not penalised (beyond 1e-6)."""
    beta = np.zeros(x.shape[1])
    pen = np.full(x.shape[1], ridge)
    pen[0] = 1e-6

    def loss(b):
        z = x @ b
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * (pen * b * b).sum())

    now = loss(beta)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        grad = x.T @ (weight * (y - p)) - pen * beta
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(pen)
        step = np.linalg.solve(hess, grad)
        size = 1.0
        while size > 1e-4 and loss(beta + size * step) > now:
            size /= 2
        beta = beta + size * step
        before, now = now, loss(beta)
        if before - now < 1e-9 * max(1.0, abs(before)):
            break
    return beta


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
