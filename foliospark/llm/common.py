"""Helpers that the operators of this subpackage share: scratch tables, byte words, dense sums."""

from __future__ import annotations

import atexit
import ctypes
import math
import re
import shutil
import tempfile
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# ---------------------------------------------------------------- tables and scratch space


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one where none is set and one machine does all."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="foliospark-")
        atexit.register(shutil.rmtree, root, True)
        root = f"file://{root}"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, tag: str, merge: bool = True) -> DataFrame:
    """Write a table to the shared scratch folder and read it again.

    This cuts the lineage: rows that were computed once are read, not recomputed, after an
    executor is lost.  Only narrow intermediate tables should come here.  With ``merge`` they are
    shuffled into files of the size that adaptive execution aims at, as a scan's tasks would else
    leave a small file each; what comes out of a shuffle is of that size already.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    (df.hint("rebalance") if merge else df).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read any more."""
    for t in tables:
        path = t.__dict__.get("_scratch_path")
        if path:
            context = t.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


#: Rows of two or three numbers that may be broadcast: some 50 MB.
BROADCAST_ROWS = 500_000


def short(x: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a materialised table is small enough to be broadcast; it is counted, no further than needed."""
    return x.limit(rows + 1).count() <= rows


def drop_rows(docs: DataFrame, lost: DataFrame, again: DataFrame, mark: Column, id_col: str = "doc_id", text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` without the rows whose id (null is a value too) and ``mark`` are in ``lost`` (id, mark; materialised).

    Of rows whose id and mark are in ``again``, the one with the longest text stays.  Both lists
    are counted first: short ones are broadcast, and ``mark`` is only taken of rows whose id
    is in a list; longer ones go through a shuffle.
    """
    own, key, value, rank = fresh(docs.columns, "__own", "__id", "__mark", "__rank")
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def listed(x: DataFrame, brief: bool) -> DataFrame:
        x = x.select(F.col("id").alias(key), F.col("mark").alias(value)).distinct()
        return F.broadcast(x) if brief else x

    def marked(x: DataFrame, brief: bool) -> DataFrame:
        if not brief:
            return docs.withColumn(own, mark)
        flag = x.select(F.col("id").alias(key)).distinct().withColumn(own, F.lit(True))
        known = docs.join(F.broadcast(flag), F.col(f"`{id_col}`").eqNullSafe(F.col(key)), "left")
        return known.select(*columns, F.when(F.col(own), mark).alias(own))

    same = F.col(f"`{id_col}`").eqNullSafe(F.col(key)) & (F.col(own) == F.col(value))
    gone = lost.unionByName(again)
    brief = short(gone, broadcast_rows)
    out = marked(gone, brief).join(listed(gone, brief), same, "left_anti").select(*columns)
    if not again.take(1):
        return out
    brief = short(again, broadcast_rows)
    order = W.partitionBy(key, value).orderBy(F.length(F.col(f"`{text_col}`")).desc_nulls_last())
    one = marked(again, brief).join(listed(again, brief), same).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return out.unionByName(one.select(*columns))


#: Bytes of an Arrow batch, where the session has it larger: batches of texts are held several times on their way.
BATCH_BYTES = 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """The same DataFrame, in a session whose Arrow batches are of ``BATCH_BYTES`` at most (a setting of the session)."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = df.sparkSession._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch()
    if not 0 < now <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def fresh(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, each made longer until no column of ``taken`` has it (case doesn't count)."""
    have, out = {c.lower() for c in taken}, []
    for w in wanted:
        while w.lower() in have:
            w += "_"
        have.add(w.lower())
        out.append(w)
    return out


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo m; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % m


def share(spark: SparkSession, x: object):
    """Broadcast an object's plain state: broadcasts are pickled by reference, so its class may be unknown on executors."""
    return spark.sparkContext.broadcast({k: v for k, v in vars(x).items()})


def revive(cls: type, state: dict):
    """The object of ``share`` again; it gets its own copy of the dictionary."""
    out = cls.__new__(cls)
    out.__dict__.update(state)
    return out


# ---------------------------------------------------------------- words of UTF-8 bytes

#: Byte maps.  LOWER lower-cases A-Z; SPACE marks [\x20\x09-\x0D]; ALNUM turns every ASCII
#: byte but letters and digits into a space and lower-cases A-Z.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACE = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)


def _splitmix_table(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the splitmix64 one)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = _splitmix_table(256, 77)
_BYTE_LOWER = _BYTE[np.frombuffer(LOWER, np.uint8)]
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW.get("p", ())) < n:
        size = max(n, 1 << 16)
        one = np.ones(1, np.uint64)
        _POW["p"] = np.cumprod(np.concatenate([one, np.full(size, _P, np.uint64)]), dtype=np.uint64)
        _POW["i"] = np.cumprod(np.concatenate([one, np.full(size, _PINV, np.uint64)]), dtype=np.uint64)
    return _POW["p"], _POW["i"]


def join_bytes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, a space after each, and where each begins."""
    buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    begin = np.zeros(len(texts), np.int64)
    if len(texts) > 1:
        begin[1:] = np.cumsum([len(t) + 1 for t in texts[:-1]])
    return buf, begin


def space_words(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word [^\\x20\\x09-\\x0D]+ in a buffer of join_bytes."""
    edge = np.diff(np.concatenate([[True], SPACE[buf], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased: a polynomial over random byte values, mixed."""
    p, inv = _powers(len(buf))
    c = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTE_LOWER[buf] * p[: len(buf)], out=c[1:])
        return mix((c[end] - c[begin]) * inv[begin] + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sub_batches(texts: list[bytes], limit: int = 3_000_000):
    """Runs of indexes whose texts together hold about ``limit`` bytes; one text at least."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield first, i
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        yield first, len(texts)


def tidy() -> None:
    """Give freed memory back: a worker that waits for its next task else keeps what its last one needed most."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidied(f):
    """A function over an iterator of batches that tidies up behind itself."""

    def run(batches):
        yield from f(batches)
        tidy()

    return run


def text_slices(text, limit: int = 1_500_000, rows: int = 256):
    """An Arrow column of texts as lists of bytes of about ``limit`` bytes, with each list's first row; null is empty.

    A column is never a list of strings as a whole, which keeps a worker's memory small.
    """
    for at in range(0, len(text), rows):
        texts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in text.slice(at, rows).to_pylist()]
        for first, last in sub_batches(texts, limit):
            yield at + first, texts[first:last]


# ---------------------------------------------------------------- sums of fixed-size arrays


def merge_dense(parts: DataFrame, n_parts: int, fan_in: int = 64) -> DataFrame:
    """Add uint32 arrays sent as rows (chunk int, part int, data binary) into one row a chunk.

    Arrays meet in a tree: a group holds at most ``fan_in`` arrays however many tasks sent one.
    """

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, np.uint32).astype(np.uint64) for d in pdf["data"])
        total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "part": [int(pdf["part"].iloc[0])], "data": [total.tobytes()]})

    for _ in range(max(1, math.ceil(math.log(max(2, n_parts), fan_in)))):
        parts = parts.select("chunk", F.floor(F.col("part") / fan_in).cast("int").alias("part"), "data").groupBy("chunk", "part").applyInPandas(add, "chunk int, part int, data binary")
    return parts
