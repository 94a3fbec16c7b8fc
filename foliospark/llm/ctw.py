"""LM scoring by context-tree weighting over binary-decomposed bytes.

Model.  A text is its UTF-8 bytes, A-Z lower-cased, followed by an end byte 0xFF (which UTF-8
never uses); ``DEPTH`` such bytes stand before it.  The next byte is eight binary choices, and
each of the 255 possible bit prefixes has a context tree of its own over the ``DEPTH`` bytes
before.  A node with counts (a, b) has the Krichevsky-Trofimov probability KT(a, b); its weighted
probability is Pw = KT at full depth and Pw = KT / 2 + prod Pw(children) / 2 above.  After learning,
the probability of a bit mixes the KT estimates of all depths along the context with the weights
that these recursions give; a node that was never seen says 1/2.

Everything about the corpus is a table of (DEPTH + 1)-grams of bytes with their counts in the
learning rows, which grows with the input.  Its groups by the ``TOP`` nearest context bytes hold
whole subtrees and are weighted apart.  A group has all that follows and precedes such a context, two
bytes and the symbol, whose variety is limited however often they occur.  What is above (depths 2
to 0: at most 65 536 * 255 nodes of 20 bytes, and some hundred thousand in texts of a few scripts) is summed
by node, comes to the driver packed and goes back as a broadcast that doesn't grow with the input.  The
result is again a table: gram -> log10 probability of its last byte.

Scoring.  Documents are dealt into blocks of about ``BLOCK_BYTES`` by a hash of id and text.  A block
asks for its distinct grams and words once, gets them by a shuffled join, and a text's score is
the sum over its bytes.  No model table is broadcast or collected, whatever its size.

Words are known by a 64-bit hash.  Defined cases: a null text is an empty one (one end byte, one
end token); with no learning rows every bit has probability 1/2 and every token 1; repeated
rows count each time; a null id counts as an empty text in crc32; extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, crc_mod, join_bytes, materialize, revive, share, small_batches, space_words, text_slices, tidied, tidy, word_hashes

DEPTH = 5
#: Context bytes of a group of grams.
TOP = 3
END = 0xFF
#: Text bytes of a scoring block.
BLOCK_BYTES = 24_000_000
#: Text bytes that are turned into arrays at once.
SUB_BYTES = 1_500_000
#: Grams in a group of the context table, on average.  A group holds all contexts that end in certain runs of ``TOP`` bytes.
GROUP_GRAMS = 100_000
GRAM, WORD, BYTES = 0, 1, 2
END_WORD = np.uint64(0x5DEECE66D1234567)
FOLDS, HELD_OUT = 7, 2


# ---------------------------------------------------------------- grams of bytes


def frame(text: bytes) -> bytes:
    return bytes([END]) * DEPTH + text.translate(LOWER) + bytes([END])


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All (DEPTH + 1)-grams of the framed texts, and where each text's begin."""
    buf = np.frombuffer(b"".join(frame(t) for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    g = np.zeros(len(buf) - DEPTH, np.int64)
    for k in range(DEPTH + 1):
        g <<= 8
        g |= buf[k : len(buf) - DEPTH + k]
    keep = np.ones(len(g), bool)
    inner = np.cumsum(sizes + DEPTH)[:-1]
    for k in range(DEPTH):
        keep[inner - DEPTH + k] = False  # grams across two texts
    return g[keep], np.concatenate([[0], np.cumsum(sizes)[:-1]])


def _distinct(keys: np.ndarray) -> np.ndarray:
    """Sorted distinct keys.  numpy's own unique is several times slower without counts."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys, kind="stable")  # runs that are sorted already merge fast
    keys, n = keys[order], np.concatenate([p[1] for p in parts])[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(keys) else n


class _Counts:
    """Distinct keys with counts, merged whenever half a million wait."""

    def __init__(self):
        self.parts, self.waiting = [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((keys, n))
        self.waiting += len(keys)
        if self.waiting > 500_000:
            self.parts = [_merge(self.parts)]
            self.waiting = 0

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        out = _merge(self.parts) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.parts, self.waiting = [], 0
        return out


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Signed hashes of all words, an end after each text's, and where each text's begin."""
    buf, begin = join_bytes(texts)
    a, b = space_words(buf)
    h = word_hashes(buf, a, b)
    doc = np.searchsorted(begin, a, "right") - 1
    per_doc = np.bincount(doc, minlength=len(texts))
    ends = np.cumsum(per_doc)
    out = np.insert(h, ends, END_WORD)
    return out.view(np.int64), np.concatenate([[0], np.cumsum(per_doc + 1)[:-1]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, key, n): distinct grams and words of a task, with counts in learning rows."""
    kinds, held = (_Counts(), _Counts()), 0

    def out(kind: int, keys: np.ndarray, n: np.ndarray):
        for i in range(0, len(keys), 100_000):
            k = keys[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(n[i : i + 100_000])], names=["kind", "key", "n"])

    for b in batches:
        learn = np.array(b.column("learn").to_pylist(), bool)
        for first, own in text_slices(b.column("text"), SUB_BYTES):
            held += sum(map(len, own))
            use = learn[first : first + len(own)]
            for kind, f in ((GRAM, grams), (WORD, _words)):
                # Sorting keys alone is several times faster than sorting with an index, so the two kinds of rows are counted apart.
                if some := [t for t, x in zip(own, use, strict=True) if x]:
                    kinds[kind].add(*np.unique(f(some)[0], return_counts=True))
                if kind == GRAM and (rest := [t for t, x in zip(own, use, strict=True) if not x]):
                    u = _distinct(f(rest)[0])
                    kinds[kind].add(u, np.zeros(len(u), np.int64))
        for kind in (GRAM, WORD):
            if sum(len(p[0]) for p in kinds[kind].parts) > 1_500_000:
                yield from out(kind, *kinds[kind].take())
    for kind in (GRAM, WORD):
        yield from out(kind, *kinds[kind].take())
    yield from out(BYTES, np.zeros(1, np.int64), np.array([held], np.int64))


# ---------------------------------------------------------------- weighting


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 1/2: Stirling's series at x + 8, and the product on the way there."""
    y = x + 8
    low = np.ones_like(x)
    for k in range(8):
        low *= x + k
    r = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / y - np.log(low)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return lgamma(a + 0.5) + lgamma(b + 0.5) - lgamma(a + b + 1) - math.log(math.pi)


_HALF = math.log(0.5)


def subtree(keys: np.ndarray, n: np.ndarray, top: int = TOP) -> tuple[np.ndarray, np.ndarray, dict]:
    """Weight all nodes of depths DEPTH..top below the given grams, whole contexts of depth ``top``.

    Gives the probability of each gram's eight bits at depth ``top`` (a row a gram), and for
    the nodes of that depth: {node (context << 8 | bit prefix): a, b, log Pw}, as arrays.
    """
    sym = keys & 255
    ctx = [(keys >> 8) & ((1 << 8 * d) - 1) for d in range(DEPTH + 1)]
    p_bits, tops = np.empty((len(keys), 8)), {"node": [], "a": [], "b": [], "log_pw": []}
    for k in range(8):
        prefix = (1 << k) | (sym >> (8 - k))
        one = ((sym >> (7 - k)) & 1).astype(bool)
        child, p = None, None
        levels = []
        for d in range(DEPTH, top - 1, -1):
            u, first, at = np.unique(ctx[d] << 8 | prefix, return_index=True, return_inverse=True)
            a, b = np.bincount(at, weights=n * ~one, minlength=len(u)), np.bincount(at, weights=n * one, minlength=len(u))
            kt = log_kt(a, b)
            if child is None:
                pw, share = kt, np.ones(len(u))
            else:
                below = np.bincount(at[child[1]], weights=child[0], minlength=len(u))
                pw = np.logaddexp(_HALF + kt, _HALF + below)
                share = np.exp(_HALF + kt - pw)
            levels.append((at, a, b, share))
            child = (pw, first)
        for at, a, b, share in levels:
            own = (np.where(one, b[at], a[at]) + 0.5) / (a[at] + b[at] + 1)
            p = own if p is None else share[at] * own + (1 - share[at]) * p
        p_bits[:, k] = p
        for name, x in (("node", u), ("a", a), ("b", b), ("log_pw", pw)):
            tops[name].append(x)
    return p_bits, sym, {name: np.concatenate(x) for name, x in tops.items()}


_ABOVE = (1 << 8 * TOP) - 1  # of a node at depth TOP: the node at the depth above it
_SUMS = ("a", "b", "log_pw")


def _weigh(t: pa.Table) -> pa.Table:
    """A group of grams -> grams with their bits' probabilities at depth TOP, and sums over the group's nodes of that depth by node above."""
    keys, n = t.column("key").to_numpy(), t.column("n").to_numpy().astype(float)
    p, _, tops = subtree(keys, n)
    u, at = np.unique(tops["node"] & _ABOVE, return_inverse=True)
    out = {"kind": pa.array(np.concatenate([np.zeros(len(keys), np.int32), np.ones(len(u), np.int32)])), "key": pa.array(np.concatenate([keys, u])), "data": pa.array([x.tobytes() for x in p] + [b""] * len(u), pa.binary())}
    for x in _SUMS:
        out[x] = pa.array(np.concatenate([np.zeros(len(keys)), np.bincount(at, weights=tops[x], minlength=len(u))]))
    return pa.table(out)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes with their sums as arrays of bytes."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.column(c).to_numpy().astype(t).tobytes()], pa.binary()) for c, t in (("key", np.int64), *((x, float) for x in _SUMS))], names=["key", *_SUMS])


class Roots:
    """Depths TOP - 1 to 0 of all trees: sorted nodes of each depth, shares of their own estimate, and the estimates for bit 1."""

    def __init__(self, node: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray):
        order = np.argsort(node)
        node, a, b, below = (x[order] for x in (node, a, b, below))
        self.levels = []
        for d in range(TOP - 1, -1, -1):
            kt = log_kt(a, b)
            pw = np.logaddexp(_HALF + kt, _HALF + below)
            self.levels.append((node.astype(np.int32), np.exp(_HALF + kt - pw), (b + 0.5) / (a + b + 1)))
            up, at = np.unique(node & ((1 << 8 * d) - 1), return_inverse=True)
            node, (a, b, below) = up, (np.bincount(at, weights=x, minlength=len(up)) for x in (a, b, pw))

    def log10(self, keys: np.ndarray, p_top: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte, from its bits' probabilities at depth TOP."""
        sym, out = keys & 255, np.zeros(len(keys))
        for k in range(8):
            prefix = (1 << k) | (sym >> (8 - k))
            one = ((sym >> (7 - k)) & 1).astype(bool)
            p = p_top[:, k]
            for d, (nodes, share, e) in zip(range(TOP - 1, -1, -1), self.levels, strict=True):
                node = ((keys >> 8) & ((1 << 8 * d) - 1)) << 8 | prefix
                at = np.searchsorted(nodes, node.astype(np.int32))
                p = share[at] * np.where(one, e[at], 1 - e[at]) + (1 - share[at]) * p
            out += np.log10(p)
        return out


# ---------------------------------------------------------------- the operator


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, group_grams: int = GROUP_GRAMS) -> DataFrame:
    """A row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte."""
    spark = docs.sparkSession
    held = crc_mod(id_col, FOLDS) == HELD_OUT
    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
    counts = rows.select("text", (~F.col("held_out")).alias("learn")).mapInArrow(tidied(_count), "kind int, key long, n long")
    counts = materialize(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "ctw-counts", merge=False)
    whole = counts.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == WORD, F.col("n"))), F.lit(0)).alias("n"),
        F.count(F.when(F.col("kind") == WORD, 1)).alias("v"),
        F.count(F.when(F.col("kind") == GRAM, 1)).alias("grams"),
        F.coalesce(F.sum(F.when(F.col("kind") == BYTES, F.col("n"))), F.lit(0)).alias("bytes"),
    ).first()

    # All contexts that end in the same TOP bytes fall into one group.
    groups = max(16, min(1 << 8 * TOP, whole["grams"] // group_grams))
    near = F.shiftright("key", 8).bitwiseAND(F.lit(_ABOVE))
    fields = "kind int, key long, data binary, " + ", ".join(f"{x} double" for x in _SUMS)
    weighed = counts.where(F.col("kind") == GRAM).select(F.pmod(F.hash(near), F.lit(groups)).alias("g"), "key", "n").groupBy("g").applyInArrow(_weigh, fields)
    weighed = materialize(weighed, "ctw-contexts", merge=False)
    below = weighed.where("kind = 1").groupBy("key").agg(*[F.sum(x).alias(x) for x in _SUMS]).mapInArrow(_packed, "key binary, " + ", ".join(f"{x} binary" for x in _SUMS)).collect()
    node, *sums = (np.concatenate([np.frombuffer(r[x], t) for r in below] or [np.zeros(0, t)]) for x, t in (("key", np.int64), *((x, float) for x in _SUMS)))
    values = _values(weighed, counts, share(spark, Roots(node, *sums)))

    blocks = max(1, math.ceil(whole["bytes"] / block_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    asked = dealt.mapInArrow(tidied(_ask), "block int, kind int, key long")
    got = asked.join(values, ["kind", "key"]).select("block", "kind", "key", "value")
    kind = dict(rows.dtypes)["doc_id"]
    total, vocabulary = whole["n"], whole["v"]
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double"
    return dealt.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(_scorer(total, vocabulary), schema)


def _values(weighed: DataFrame, counts: DataFrame, roots) -> DataFrame:
    def log10(key: pd.Series, data: pd.Series) -> pd.Series:
        p = np.frombuffer(b"".join(data), np.float64).reshape(-1, 8)
        return pd.Series(revive(Roots, roots.value).log10(key.to_numpy(), p))

    value = F.pandas_udf(log10, "double")
    seen = weighed.where("kind = 0").select(F.lit(GRAM).alias("kind"), "key", value("key", "data").alias("value"))
    return seen.unionByName(counts.where(F.col("kind") == WORD).select("kind", "key", F.col("n").cast("double").alias("value")))


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams and words of each block in a task.  A block with very many asks in parts; a key asked twice does no harm."""
    kept: dict = {}
    for b in batches:
        block = np.array(b.column("block").to_pylist(), np.int64)
        for x in np.unique(block):
            for _, own in text_slices(b.column("text").take(pa.array(np.flatnonzero(block == x))), SUB_BYTES):
                for kind, f in ((GRAM, grams), (WORD, _words)):
                    u = _distinct(f(own)[0])
                    kept[x, kind] = _distinct(np.concatenate([kept[x, kind], u])) if (x, kind) in kept else u
            for kind in (GRAM, WORD):
                if len(kept[x, kind]) > 4_000_000:
                    yield from _asked(x, kind, kept.pop((x, kind)))
    for (x, kind), keys in kept.items():
        yield from _asked(x, kind, keys)


def _asked(block: int, kind: int, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), 100_000):
        k = keys[i : i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), block, np.int32)), pa.array(np.full(len(k), kind, np.int32)), pa.array(k)], names=["block", "kind", "key"])


class _Lookup:
    """Values by key: a table of hashed slots answers most keys, binary search the others."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(10, (4 * max(1, len(keys))).bit_length()))
        self.slots = np.zeros(1 << int(64 - self.shift), np.int32)
        self.slots[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), default)
        at = self.slots[self._slot(keys)]
        out = self.values[at]
        lost = np.flatnonzero(self.keys[at] != keys)
        if len(lost):
            k = keys[lost]
            at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
            out[lost] = np.where(self.keys[at] == k, self.values[at], default)
        return out


def _scorer(total: int, vocabulary: int):
    def run(docs: pa.Table, got: pa.Table) -> pa.Table:
        kinds, keys, values = got.column("kind").to_numpy(), got.column("key").to_numpy(), got.column("value").to_numpy()
        tables = [_Lookup(keys[kinds == kind], values[kinds == kind]) for kind in (GRAM, WORD)]
        n = len(docs)
        columns = {c: np.zeros(n, t) for c, t in (("n_tokens", np.int64), ("n_known", np.int64), ("base_score", float), ("score", float), ("n_bytes", np.int64))}
        floor = math.log10(total + vocabulary + 1)
        for first, own in text_slices(docs.column("text"), SUB_BYTES):
            last = first + len(own)
            columns["n_bytes"][first:last] = [len(t) + 1 for t in own]
            g, begin = grams(own)
            columns["score"][first:last] = np.add.reduceat(tables[GRAM].get(g, math.nan), begin)
            w, begin = _words(own)
            c = tables[WORD].get(w, 0.0)
            columns["n_tokens"][first:last] = np.diff(np.append(begin, len(w)))
            columns["n_known"][first:last] = np.add.reduceat((c > 0).astype(np.int64), begin)
            columns["base_score"][first:last] = np.add.reduceat(np.log10(c + 1) - floor, begin)
        n_bytes = columns["n_bytes"]
        del tables, keys, values, kinds, g, w, c
        tidy()
        return pa.table({
            "doc_id": docs.column("doc_id"),
            "held_out": docs.column("held_out"),
            "n_tokens": columns["n_tokens"],
            "n_known": columns["n_known"],
            "train_tokens": np.full(n, total, np.int64),
            "base_score": columns["base_score"],
            "score": columns["score"],
            "n_bytes": n_bytes,
            "bits_per_byte": -columns["score"] / n_bytes * math.log2(10),
        })

    return run
