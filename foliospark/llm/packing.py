"""Best-fit packing under conflicts.

Documents are cut into pieces of at most ``capacity`` tokens (words, and one end mark a
document).  Pieces go, largest first, into the open bin with the least free space that holds them
and agrees with them: no two pieces of a bin come from one source or from one cluster of
equal texts (the same text without blanks).  Bins are ordered by free space and carry bitmaps of
their sources and clusters.  A tree over free space keeps in each node the bits that all
its bins share; the successor search goes on from the tightest fitting bin upwards and
skips whole subtrees in which every bin conflicts, until a bin agrees; else a bin is opened.

The packing is done in blocks of about ``block`` pieces, dealt by a hash of (id, piece), so a
group of any size is spread evenly; a block is one task's bounded work, and its bins are its
own.  Only ids, sources, hashes and counts are shuffled, never texts.

Defined cases: null and empty texts are one token (the end mark); a null source conflicts
with none; texts without words don't conflict as copies; repeated rows are packed each (as
copies, apart from each other); very long texts become several pieces, which conflict like
copies; extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .exact_dedup import normal

CAPACITY = 2048
BLOCK = 16_384
SCHEMA = "doc_id {kind}, piece int, first_token long, n_tokens int, bin_id long, bin_offset int, bin_tokens int, source string, cluster long"


class Bins:
    """Open bins by free space, with a tree of the bits that all bins below share."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1 << capacity.bit_length()
        self.shared: list[int | None] = [None] * (2 * self.leaves)  # None: no bin below
        self.at: list[dict[int, list[int]]] = [{} for _ in range(self.leaves)]
        self.free: list[int] = []
        self.mask: list[int] = []

    def _update(self, r: int) -> None:
        s = None
        for m in self.at[r]:
            s = m if s is None else s & m
        i = self.leaves + r
        self.shared[i] = s
        while i > 1:
            i >>= 1
            a, b = self.shared[2 * i], self.shared[2 * i + 1]
            s = b if a is None else a if b is None else a & b
            if self.shared[i] == s:
                break
            self.shared[i] = s

    def _insert(self, b: int) -> None:
        r, m = self.free[b], self.mask[b]
        if r:
            new = m not in self.at[r]
            insort(self.at[r].setdefault(m, []), b)
            if new:
                self._update(r)

    def successor(self, size: int, mask: int) -> int | None:
        """The tightest open bin (of equally tight ones the first that was opened) with room for ``size`` whose mask has none of these bits."""
        stack = [(1, 0, self.leaves)]
        while stack:
            i, lo, n = stack.pop()
            s = self.shared[i]
            if s is None or s & mask or lo + n <= size:
                continue
            if n == 1:
                fits = [x for m, x in self.at[lo].items() if not m & mask]
                if fits:
                    return min(x[0] for x in fits)
                continue
            n >>= 1
            stack.append((2 * i + 1, lo + n, n))
            stack.append((2 * i, lo, n))
        return None

    def place(self, size: int, mask: int) -> tuple[int, int]:
        """Bin and offset."""
        b = self.successor(size, mask)
        if b is None:
            b = len(self.free)
            self.free.append(self.capacity)
            self.mask.append(0)
        else:
            r, m = self.free[b], self.mask[b]
            same = self.at[r][m]
            same.remove(b)
            if not same:
                del self.at[r][m]
                self._update(r)
        offset = self.capacity - self.free[b]
        self.free[b] -= size
        self.mask[b] |= mask
        self._insert(b)
        return b, offset


def pack_block(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int]]:
    """(bin, offset, tokens of the bin) of each piece; they come in order of placing."""
    seen: dict = {}
    for c in clusters:
        if c is not None:
            seen[c] = seen.get(c, 0) + 1
    bit: dict = {}
    mask_of = lambda kind, x: 1 << bit.setdefault((kind, x), len(bit))
    for s in sources:
        if s is not None:
            mask_of("source", s)
    bins = Bins(capacity)
    placed = []
    for size, s, c in zip(sizes, sources, clusters, strict=True):
        mask = (mask_of("source", s) if s is not None else 0) | (mask_of("cluster", c) if c is not None and seen[c] > 1 else 0)
        placed.append(bins.place(size, mask))
    return [(b, o, capacity - bins.free[b]) for b, o in placed]


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, source, cluster, piece, first_token, n_tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), (F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")) + 1).cast("long").alias("tokens"), F.when(normal(text) != "", F.xxhash64(normal(text))).alias("cluster"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {capacity}"))))
    first = F.col("piece") * capacity
    return rows.select("doc_id", "source", "cluster", F.col("piece").cast("int").alias("piece"), first.alias("first_token"), F.least(F.lit(capacity), F.col("tokens") - first).cast("int").alias("n_tokens"))


def pack(docs: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """A row a piece: doc_id, piece, first_token, n_tokens, bin_id, bin_offset, bin_tokens, source, cluster."""
    rows = materialize(pieces(docs, capacity), "packing-pieces")
    kind = dict(rows.dtypes)["doc_id"]
    blocks = max(1, -(-rows.count() // block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(blocks)).cast("int"))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        placed = pack_block(*(t.column(c).to_pylist() for c in ("n_tokens", "source", "cluster")), capacity)
        base = (t.column("block")[0].as_py() if len(t) else 0) << 32
        cols = {c: t.column(c) for c in ("doc_id", "piece", "first_token", "n_tokens")}
        cols |= {"bin_id": pa.array([base | b for b, _, _ in placed], pa.int64()), "bin_offset": pa.array([o for _, o, _ in placed], pa.int32()), "bin_tokens": pa.array([n for *_, n in placed], pa.int32())}
        return pa.table(cols | {c: t.column(c) for c in ("source", "cluster")})

    return rows.repartition(max(blocks, 1), "block").groupBy("block").applyInArrow(run, SCHEMA.format(kind=kind))
