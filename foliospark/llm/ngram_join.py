"""N-gram Jaccard join with adaptive multi-match prefixes, and its connected groups.

A document's set holds its distinct 5-word shingles (A-Z lower-cased words of
[^\\x20\\x09-\\x0D]+); with fewer words the whole sequence is one shingle; without words it is
empty and linked with nothing.  Two documents link when 100 * |A and B| >= 80 * |A or B|.

Order.  Shingles are ordered rarest first, by a count sketch of all documents (two rows of
``WIDTH`` counters, smaller one counts) and then by hash.  Any order is right; this one keeps
passages that many documents share out of the prefixes.  The more shingles, the more of them
meet in a counter by chance: the usual sum (the median) is taken off, and what doesn't stand out
from it by ``STANDS_OUT`` times the usual deviation counts as rare.  That deviation grows as the
square root of the corpus only, so a sketch of fixed size still finds the passages that matter:
among 10^13 shingles those of some 50 000 documents, which can't make lists longer than that.

Prefix.  With n shingles, a link needs a = ceil(80 n / 100) common ones.  So of the first n - a + l
shingles of either document at least l are shared, for any l up to a.  Each document chooses
its own l: it lengthens its prefix as long as that lowers the estimated cost, the
prefix's postings plus the candidates that may share l of them.  A pair has to share the
smaller of its two l.  So a document goes if its prefix meets other prefixes in fewer shingles
than the least l, its own or another's, in the posting lists where it does.

Pairs without squares.  Equal sets are one class, known by a hash of the set.  First each class is
paired only with one class of each posting list, the one with the least of its own; pairs that share enough are verified, and
verified links give components.  Then posting lists are joined again, but only for
classes of different components; lists inside one component, such as those of large groups
of near copies, make no pairs.  Components after the second round are exact, as a pair left
out was connected already.  ``links`` lists verified pairs of both rounds, ``all_links`` every one.

Verification compares whole sets.  Only documents that stand for a class in a candidate pair send
theirs: a Bloom filter of those ids, of a size that follows their number up to a fixed
limit, is broadcast, and the join drops what it lets through by chance.

Shingles and sets are known by 64-bit hashes.  Rows with equal ids but different texts are different
documents with one id: their classes link as their texts do, and component_id is by id.  Null
ids: such rows take part, and no component is named after them unless all its ids are
null.  Extra columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BooleanType

from .common import discard, drop_rows, join_bytes, materialize, merge_dense, mix, small_batches, space_words, text_slices, tidied, word_hashes

WORDS = 5
#: The threshold as a share of 100.
SHARE = 80
WIDTH = 1 << 18
CHUNKS = 8
STANDS_OUT = 6.0
#: Postings of a shingle that one task gets; those of a shingle in more documents are dealt by set.
HOT = 50_000
MAX_MATCHES = 6
BLOOM_BITS_MAX = 1 << 28
_Q = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document, shingle hash), distinct, sorted by document."""
    buf, begin = join_bytes(texts)
    a, b = space_words(buf)
    w = word_hashes(buf, a, b)
    doc = np.searchsorted(begin, a, "right") - 1
    n = np.bincount(doc, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    h, d = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(w) >= WORDS:
        m = len(w) - WORDS + 1
        h = np.zeros(m, np.uint64)
        for k in range(WORDS):
            h += mix(w[k : k + m] + _Q[k])
        whole = doc[:m] == doc[WORDS - 1 :]
        h, d = mix(h[whole]), doc[:m][whole]
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        s = np.array([_short(w[first[i] : first[i] + n[i]]) for i in short], np.uint64)
        h, d = np.concatenate([h, s]), np.concatenate([d, short])
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return d[new], h[new]


def _short(w: np.ndarray) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for k in range(len(w)):
        h += mix(w[k : k + 1] + _Q[k])
    return mix(h + np.uint64(len(w)))[0]


def set_ids(d: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit hash of each set (0 for empty ones)."""
    n = np.bincount(d, minlength=n_docs)
    c = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + _Q[0]), dtype=np.uint64)])
    ends = np.cumsum(n)
    return n, np.where(n > 0, mix(c[ends] - c[ends - n] + n.astype(np.uint64)), np.uint64(0))


def slots(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shingle's counters in the two rows of the sketch."""
    return (h & np.uint64(WIDTH - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(WIDTH - 1)).astype(np.int64) + WIDTH


def usual(sketch: np.ndarray) -> tuple[float, float]:
    """What a counter holds by chance, and the deviation from it above which a count tells something."""
    middle = float(np.median(sketch))
    return middle, max(2.0, STANDS_OUT * 1.4826 * float(np.median(np.abs(sketch - middle))))


_SCAN = "doc_id {kind}, n long, sid long, chunk int, part int, data binary"


def _scan(kind: pa.DataType):
    """Pass 1: a row a document, and the task's sketch in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names = [x.split()[0] for x in _SCAN.split(", ")]
        sketch, seen = np.zeros(2 * WIDTH, np.uint32), set()
        for b in batches:
            parts = []
            for _, texts in text_slices(b.column("text")):
                d, h = shingles(texts)
                n, sid = set_ids(d, h, len(texts))
                parts.append((n, sid))
                # Copies of a set within a task count once.
                fresh = np.zeros(len(texts), bool)
                for i, s in enumerate(sid.tolist()):
                    if s not in seen:
                        seen.add(s)
                        fresh[i] = True
                for x in slots(h[fresh[d]]):
                    sketch += np.bincount(x, minlength=2 * WIDTH).astype(np.uint32)
            n, sid = (np.concatenate([p[k] for p in parts] or [np.zeros(0, np.uint64)]) for k in range(2))
            none = pa.nulls(len(b), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(sid.view(np.int64)), none, none, pa.nulls(len(b), pa.binary())], names=names)
        size, part = 2 * WIDTH // CHUNKS, TaskContext.get().partitionId()
        for c in range(CHUNKS):
            none = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), none, none, pa.array([c], pa.int32()), pa.array([part], pa.int32()), pa.array([sketch[c * size : (c + 1) * size].tobytes()], pa.binary())], names=names)

    return run


def choose(counts: np.ndarray, n: int) -> int:
    """How many matches a document asks for: the least estimated cost.

    counts: estimated document counts of its shingles, rarest first.  With l matches, the
    prefix has n - a + l shingles and as many postings as their counts say; at most postings / l
    candidates can share l of them, each of which costs a comparison of n shingles in the worst
    case, a 64th of that as a rule.
    """
    need = -(-SHARE * n // 100)
    best, least = 1, None
    postings = np.cumsum(counts[: n - need + MAX_MATCHES])
    for m in range(1, min(MAX_MATCHES, need) + 1):
        length = n - need + m
        p = float(postings[length - 1])
        cost = 4 * length + p + p / m * max(1, n / 64)
        if least is None or cost < least:
            best, least = m, cost
    return best


def _prefixes(shared):
    """Pass 2: (token, salt, sid, meta) for the prefix of each set; a set once a task.

    meta packs the set's size (29 bits), the shingle's place in the prefix from 1 (30 bits) and l (4 bits).
    salt deals the postings of a shingle with more than ``HOT`` of them by set; it is -1 for the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.frombuffer(shared.value, np.uint32)
        noise, least = usual(sketch)
        seen: set[int] = set()
        for b in batches:
            for _, texts in text_slices(b.column("text")):
                d, h = shingles(texts)
                n, sid = set_ids(d, h, len(texts))
                x, y = slots(h)
                count = np.minimum(sketch[x], sketch[y]) - noise
                # Counts that chance explains say nothing: those shingles go by hash.
                rank = np.where(count <= least, 1, count).astype(np.int64)
                order = np.lexsort((h, rank, d))
                h, rank = h[order], rank[order]
                ends = np.cumsum(n)
                tok, own, meta, often = [], [], [], []
                for i in range(len(texts)):
                    s, k = int(sid[i]), int(n[i])
                    if not k or s in seen:
                        continue
                    seen.add(s)
                    at = ends[i] - k
                    m = choose(rank[at : at + k], k)
                    length = k - -(-SHARE * k // 100) + m
                    tok.append(h[at : at + length])
                    often.append(rank[at : at + length])
                    own.append(np.full(length, s, np.uint64))
                    meta.append((k << 34) | (np.arange(1, length + 1, dtype=np.int64) << 4) | m)
                if tok:
                    own, often = np.concatenate(own), np.concatenate(often)
                    salt = np.where(often > HOT, (mix(own) % (often // HOT + 1).astype(np.uint64)).astype(np.int64), -1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tok).view(np.int64)), pa.array(salt), pa.array(own.view(np.int64)), pa.array(np.concatenate(meta))], names=["token", "salt", "sid", "meta"])

    return run


# ---------------------------------------------------------------- verification


def _bloom_slots(h: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(h.view(np.uint64))
    return [(mix(h + q) % np.uint64(bits)).astype(np.int64) for q in _Q[:3]]


def _bloom(ids: DataFrame, n: int, spark: SparkSession):
    """A Bloom filter (bytes of 0 and 1 packed to bits) over a column ``key`` of longs; about 16 bits a key up to a limit."""
    bits = min(BLOOM_BITS_MAX, 1 << max(16, (16 * max(1, n)).bit_length()))
    chunks = max(1, bits // (1 << 20))
    size = bits // chunks

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, np.ndarray] = {}
        for b in batches:
            for s in _bloom_slots(b.column("key").to_numpy(), bits):
                for c in np.unique(s // size):
                    got.setdefault(int(c), np.zeros(size, bool))[s[s // size == c] % size] = True
        for c, x in got.items():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([np.packbits(x).tobytes()], pa.binary())], names=["chunk", "data"])

    def unite(t: pa.Table) -> pa.Table:
        out = np.zeros(size // 8, np.uint8)
        for d in t.column("data").to_pylist():
            out = out | np.frombuffer(d, np.uint8)
        return pa.table({"chunk": t.column("chunk").slice(0, 1), "data": pa.array([out.tobytes()], pa.binary())})

    parts = ids.select("key").coalesce(64).mapInArrow(fill, "chunk int, data binary")
    rows = parts.groupBy("chunk").applyInArrow(unite, "chunk int, data binary").collect()
    whole = np.zeros(bits // 8, np.uint8)
    for r in rows:
        whole[r["chunk"] * (size // 8) : (r["chunk"] + 1) * (size // 8)] = np.frombuffer(r["data"], np.uint8)
    return spark.sparkContext.broadcast((bits, whole.tobytes()))


def _sets(shared):
    """Pass 3: (sid, set) of the sets whose id passes the filter; a set once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, raw = shared.value
        have = np.frombuffer(raw, np.uint8)
        seen: set[int] = set()
        for b in batches:
            for _, texts in text_slices(b.column("text")):
                d, h = shingles(texts)
                n, sid = set_ids(d, h, len(texts))
                keep = n > 0
                for s in _bloom_slots(sid, bits):
                    keep &= (have[s >> 3] >> (7 - (s & 7)) & 1).astype(bool)
                ends = np.cumsum(n)
                own, data = [], []
                for i in np.flatnonzero(keep):
                    if int(sid[i]) not in seen:
                        seen.add(int(sid[i]))
                        own.append(sid[i])
                        data.append(h[ends[i] - n[i] : ends[i]].tobytes())
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array(np.array(own, np.uint64).view(np.int64)), pa.array(data, pa.binary())], names=["sid", "data"])

    return run


@F.pandas_udf(BooleanType())
def _linked(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if len(x) > len(y):
            x, y = y, x
        # Both are sorted.
        common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
        out.append(100 * common >= SHARE * (len(x) + len(y) - common))
    return pd.Series(out, dtype=bool)


def _verify(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of sids that link; pairs is materialised."""
    spark = docs.sparkSession
    keys = materialize(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), "jaccard-keys")
    n = keys.count()
    if not n:
        return spark.createDataFrame([], "a long, b long")
    sets = docs.select("text").mapInArrow(tidied(_sets(_bloom(keys, n, spark))), "sid long, data binary")
    # One copy of each set, as tasks may send copies.
    one = materialize(sets.groupBy("sid").agg(F.first("data").alias("data")), "jaccard-sets")
    left = one.select(F.col("sid").alias("a"), F.col("data").alias("set_a"))
    right = one.select(F.col("sid").alias("b"), F.col("data").alias("set_b"))
    met = pairs.select("a", "b").join(left, "a").join(right, "b")
    out = materialize(met.where(_linked("set_a", "set_b")).select("a", "b"), "jaccard-links")
    discard(one, keys)
    return out


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node that links reach, for every node of ``links`` (a, b); large and small stars in turn.

    Every round is one table in the scratch folder.  A star's centre may have any number of
    neighbours: they are never gathered, only their minimum is.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars", merge=False)
    while True:
        # Done when every node has one edge down, to a node without any.
        deep = edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi")
        if not deep.take(1) and not edges.groupBy("u").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x <> y").take(1):
            break
        before = edges
        # Large star: neighbours above a node go to the smallest of its neighbourhood.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: neighbours below a node, and itself, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(edges.distinct(), "stars", merge=False)
        discard(before)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(edges.select("v", "v").distinct().toDF("node", "comp"))


def joined_components(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components (node, comp) after more ``links`` (a, b): only the components that these touch are worked on."""
    a, b = comp.toDF("a", "ca"), comp.toDF("b", "cb")
    between = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    top = materialize(components(between), "jaccard-components", merge=False)
    moved = comp.join(top.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return moved.unionByName(top.join(comp, "node", "left_anti"))


# ---------------------------------------------------------------- the operator


def _read(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The classes' table, a row a document (doc_id, n, sid), and the sketch's parts."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType
    schema = _SCAN.format(kind=kind.simpleString())
    scanned = materialize(rows.mapInArrow(tidied(_scan(to_arrow_type(kind))), schema), "jaccard-scan")
    return scanned.where("chunk is null").select("doc_id", "n", "sid"), scanned.where("chunk is not null").select("chunk", "part", "data")


def _matched(met: DataFrame) -> DataFrame:
    """Pairs (a, b) out of shared postings (n, l, pos of a; m, l2, pos2 of b).

    A pair that links has ``need`` shingles in common, so of the first size - need + l of
    either, at least l are shared: for two sets of one size that is about half of the prefix that
    sets of any size call for.
    """
    need = F.ceil((F.col("n") + F.col("m")) * SHARE / (100 + SHARE))
    least = F.least("l", "l2")
    near = (F.col("pos") <= F.col("n") - need + least) & (F.col("pos2") <= F.col("m") - need + least)
    close = F.least("n", "m") * 100 >= F.greatest("n", "m") * SHARE
    return met.where(close & near).groupBy("a", "b").agg(F.count("*").alias("k"), F.first(least).alias("least")).where("k >= least").select("a", "b")


def _postings(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their classes, and the postings (token, sid, n, l, pos, k) of classes that may link."""
    spark = docs.sparkSession
    text = small_batches(docs).select(F.col(text_col).alias("text"))
    members, parts = _read(docs, id_col, text_col)
    n_parts = parts.agg(F.max("part")).first()[0]
    chunks = {r["chunk"]: r["data"] for r in merge_dense(parts, (n_parts or 0) + 1).collect()}
    empty = bytes(2 * WIDTH // CHUNKS * 4)
    sketch = spark.sparkContext.broadcast(b"".join(chunks.get(c, empty) for c in range(CHUNKS)))

    # Postings of shingles that two classes share at least, of classes that share enough of them for
    # the least l in their lists: a pair needs the smaller of its two, so a class's own l is too strict.
    # A copy of a set that two tasks sent has equal ids, so it doesn't make a shingle shared.
    # What a hot shingle's sets ask for isn't gathered: all its postings stay, and 1 counts as the least l.
    postings = text.mapInArrow(tidied(_prefixes(sketch)), "token long, salt int, sid long, meta long").repartition("token", "salt")
    whole = W.partitionBy("token", "salt")
    own_l = F.col("meta").bitwiseAND(15).cast("int")
    postings = postings.withColumn("lo", F.min("sid").over(whole)).withColumn("hi", F.max("sid").over(whole)).withColumn("low", F.min(own_l).over(whole)).where("salt >= 0 or lo <> hi")
    low = F.when(F.col("salt") >= 0, 1).otherwise(F.col("low")).alias("low")
    shared = postings.dropDuplicates(["token", "salt", "sid"]).select("token", "sid", F.shiftright("meta", 34).alias("n"), own_l.alias("l"), low, F.shiftright("meta", 4).bitwiseAND((1 << 30) - 1).alias("pos"))
    shared = materialize(shared, "jaccard-postings", merge=False)
    able = shared.groupBy("sid").agg(F.count("*").alias("k"), F.min("low").alias("low")).where("k >= low")
    postings, shared = shared, materialize(shared.drop("low").join(able.select("sid", "k"), "sid"), "jaccard-able", merge=False)
    discard(postings)
    return members, shared


def all_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents with their classes, and every link (a, b) between classes, a < b; equal sets are one class.

    All pairs of each posting list are met, so the work follows the number of candidates, not of components.
    """
    members, shared = _postings(docs, id_col, text_col)
    other = shared.select("token", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("l").alias("l2"), F.col("pos").alias("pos2"))
    pairs = materialize(_matched(shared.withColumnRenamed("sid", "a").join(other, "token").where("a < b")), "jaccard-pairs")
    return members, _verify(pairs, docs.select(F.col(text_col).alias("text")))


def link_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: doc_id, n_shingles, n_links (other documents it links with)."""
    members, found = all_links(docs, id_col, text_col)
    sizes = members.where("n > 0").groupBy("sid").agg(F.count("*").alias("size"))
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = both.join(sizes.withColumnRenamed("sid", "b"), "b").groupBy(F.col("a").alias("sid")).agg(F.sum("size").alias("far"))
    linked = sizes.join(far, "sid", "left").select("sid", (F.col("size") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    full = members.where("n > 0").join(linked, "sid").select("doc_id", F.col("n").alias("n_shingles"), "n_links")
    return full.unionByName(members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links")))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their classes, verified links that connect each component of classes (not all: see ``all_links``), and components."""
    text = docs.select(F.col(text_col).alias("text"))
    members, shared = _postings(docs, id_col, text_col)

    # Round 1: a star around one class of each list, the one that shares the most of its prefix.
    centre = F.struct((F.col("k") * 1000 / (F.col("n") - F.ceil(F.col("n") * SHARE / 100) + F.col("l"))).cast("long").alias("share"), "sid", "n", "l", "pos")
    stars = shared.groupBy("token").agg(F.max(centre).alias("c")).select("token", F.col("c.sid").alias("b"), F.col("c.n").alias("m"), F.col("c.l").alias("l2"), F.col("c.pos").alias("pos2"))
    star = materialize(_matched(shared.withColumnRenamed("sid", "a").join(stars, "token").where("a <> b")), "jaccard-pairs", merge=False)
    first = _verify(star, text)
    comp = materialize(components(first), "jaccard-components", merge=False)

    # Round 2: all pairs of a list that lie in different components.
    own = shared.join(comp.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    own = materialize(own, "jaccard-open", merge=False)
    mixed = own.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    opened, own = own, materialize(own.join(mixed, "token", "left_semi"), "jaccard-mixed", merge=False)
    discard(opened, shared)
    other = own.select("token", F.col("sid").alias("b"), F.col("n").alias("m"), F.col("l").alias("l2"), F.col("pos").alias("pos2"), F.col("comp").alias("comp_b"))
    pairs = _matched(own.withColumnRenamed("sid", "a").join(other, "token").where("comp < comp_b"))
    tried = star.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(star.select(F.col("b").alias("x"), F.col("a").alias("y")))
    pairs = pairs.join(tried, (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")), "left_anti")
    pairs = materialize(pairs, "jaccard-pairs", merge=False)
    discard(own, star)
    second = _verify(pairs, text)
    discard(pairs)
    if second.take(1):
        comp = materialize(joined_components(comp, second), "jaccard-components", merge=False)
    return members, first.unionByName(second), comp


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: doc_id, n_shingles, component_id."""
    members, _, comp = links(docs, id_col, text_col)
    full = members.where("n > 0")
    classes = full.groupBy("sid").agg(F.min("doc_id").alias("low"))
    named = classes.join(comp.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
    named = materialize(named, "jaccard-named", merge=False)
    lowest = named.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "comp").select("sid", "component_id")
    out = full.join(named, "sid").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = members.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(alone)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id (a null id comes last), in its own columns."""
    # Rows are known by id and text: an id may be null or stand for other texts as well.
    text = F.col(f"`{text_col}`")
    mark = F.xxhash64(F.coalesce(text, F.lit("")))
    key = F.struct(F.col(f"`{id_col}`").isNull().alias("no_id"), F.col(f"`{id_col}`").alias("id"), mark.alias("mark"))
    found = materialize(groups(docs.select(key.alias("key"), text.alias("text")), "key", "text"), "jaccard-groups", merge=False)
    rows = found.select(F.col("doc_id.id").alias("id"), F.col("doc_id.mark").alias("mark"), F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "n_shingles")
    again = rows.where("kept and n_shingles > 0").groupBy("id", "mark").count().where("count > 1").drop("count")
    again = materialize(again, "jaccard-repeated", merge=False)
    return drop_rows(docs, rows.where("not kept").select("id", "mark"), again, mark, id_col, text_col)
