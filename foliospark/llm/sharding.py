"""Sharding by sampled splitters: shards of nearly equal bytes, cut from one order of the records.

The order is (md5 of the text, id), so equal texts are neighbours, and within a very large
group of them the id orders the rows; a row number that is written once orders equal rows.  A
size-weighted sample of keys gives quantile boundaries; records are range-partitioned by binary
search among them; ranges that turn out overfull get splitters of their own from a second sample.
Exact sums over the ranges and inside each of them then give every record its place in the whole
order, in bytes and rows, and shard borders are cut at exact byte quantiles.  So the sample only
decides how even the tasks are, never the result.

Equal texts stay in one shard if their group has at most ``together`` of a shard's bytes, which
is how far the law lets shards differ: a group across a border goes to the shard that holds its
middle.  Larger groups are cut; ``whole`` says whether all copies of a record's text are in its shard.

Size is the UTF-8 length plus 1; a null text has size 1 and the key of an empty one.  Rows with
equal (text, id) take neighbouring slots in any order.  Null ids come first.  Extra columns are
ignored.  An empty table gives an empty result.

Bounded on the driver and broadcast: about ``SAMPLE`` sampled keys; splitters, a row for each
range, at most about twice ``MAX_RANGES``; a row a shard; at most shards - 1 groups that lie across a border.
Records look their splitters up by the first digits of the md5, by a join with the lists of
splitters that begin alike, so no expression grows with their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import discard, materialize

SHARDS = 8
TOGETHER = 0.01
MAX_RANGES = 65_536
ROWS_PER_RANGE = 1_000_000
#: Sampled keys for each range, and in all.
OVERSAMPLE = 32
SAMPLE = 1 << 18
#: Hexadecimal digits of the md5 by which splitters are looked up.
DIGITS = 3


def _records(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("h"), F.monotonically_increasing_id().alias("nr"))


def _chance(seed: int) -> Column:
    """A number from 0 to 1 by hash, so that a rerun draws the same."""
    return F.pmod(F.xxhash64("h", "doc_id", "nr", F.lit(seed)), F.lit(1 << 32)) / F.lit(float(1 << 32))


def _order(key: tuple) -> tuple:
    h, doc_id, nr = key
    return h, doc_id is not None, doc_id if doc_id is not None else 0, nr


def _quantiles(sample: list[tuple[tuple, float]], n: int) -> list[tuple]:
    """The n - 1 keys that cut the weight of the sample (key, weight) in n parts; repeated keys once."""
    sample = sorted(sample, key=lambda s: _order(s[0]))
    total, run, cuts = sum(w for _, w in sample), 0.0, []
    for key, w in sample:
        if len(cuts) < n - 1 and run + w > total * (len(cuts) + 1) / n and (not cuts or cuts[-1] != key):
            cuts.append(key)
        run += w
    return cuts


def _with_range(rows: DataFrame, cuts: list[tuple], kind: str) -> DataFrame:
    """How many of the sorted cuts are at or before the row's key, as ``range``."""
    if not cuts:
        return rows.withColumn("range", F.lit(0))
    lists: dict[str, list] = {}
    for c in cuts:
        lists.setdefault(c[0][:DIGITS], []).append(c)
    longest, base, table = max(map(len, lists.values())), 0, []
    for k in range(16**DIGITS):
        own = lists.get(f"{k:0{DIGITS}x}", [])
        table.append((f"{k:0{DIGITS}x}", base, own))
        base += len(own)
    table = F.broadcast(rows.sparkSession.createDataFrame(table, f"digits string, base int, cuts array<struct<h:string,doc_id:{kind},nr:long>>"))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(longest.bit_length()))])
    key = F.struct("h", "doc_id", "nr")
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size("cuts")) & (F.get("cuts", at + step - 1) <= key), at + step).otherwise(at))
    return rows.withColumn("digits", F.substring("h", 1, DIGITS)).join(table, "digits").withColumn("range", F.col("base") + at).drop("digits", "base", "cuts")


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text", together: float = TOGETHER, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """A row a record: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: no law of keys), whole."""
    rows = materialize(_records(docs, id_col, text_col), "shard-records")
    kind = dict(rows.dtypes)["doc_id"]
    whole = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    law = F.lit("bytes").alias("law")
    none = F.lit(None).cast("int").alias("grown_shard")
    if not whole["n"]:
        return rows.select("doc_id", "size", "text_crc32", law, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), none, F.lit(True).alias("whole"))

    ranges = int(min(MAX_RANGES, max(8 * shards, whole["n"] // rows_per_range)))
    each = max(4, min(OVERSAMPLE, SAMPLE // ranges))
    p = F.least(F.lit(1.0), F.col("size") * (ranges * each / whole["bytes"]))
    drawn = rows.where(_chance(1) < p).select("h", "doc_id", "nr", (F.col("size") / p).alias("w")).collect()
    cuts = _quantiles([((r.h, r.doc_id, r.nr), r.w) for r in drawn], ranges)
    placed = materialize(_with_range(rows, cuts, kind), "shard-ranges")

    # Overfull ranges, in rows or bytes, are sampled again, in proportion to what they hold over the mean.
    held = {r["range"]: r for r in placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
    over = {k: max(r["n"] * len(held) / whole["n"], r["bytes"] * len(held) / whole["bytes"]) for k, r in held.items()}
    over = {k: x for k, x in over.items() if x > 2 and held[k]["n"] > 1}
    if over:
        chance = rows.sparkSession.createDataFrame([(k, min(1.0, v * each / held[k]["n"])) for k, v in over.items()], "range int, p double")
        found: dict[int, list] = {}
        for r in placed.join(F.broadcast(chance), "range").where(_chance(2) < F.col("p")).select("range", "h", "doc_id", "nr").collect():
            found.setdefault(r["range"], []).append(((r.h, r.doc_id, r.nr), 1.0))
        more = [c for k, x in over.items() for c in _quantiles(found.get(k, []), int(x) + 1)]
        cuts = sorted({*cuts, *more}, key=_order)
        first, placed = placed, materialize(_with_range(rows, cuts, kind), "shard-subranges")
        discard(first)
    discard(rows)

    # Exact bytes and rows before each range, then before each record.
    held = sorted(placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect(), key=lambda r: r["range"])
    before, n, b = [], 0, 0
    for r in held:
        before.append((r["range"], n, b))
        n, b = n + r["n"], b + r["bytes"]
    spark = docs.sparkSession
    before = F.broadcast(spark.createDataFrame(before, "range int, rows_before long, bytes_before long"))
    inside = W.partitionBy("range").orderBy("h", "doc_id", "nr")
    placed = placed.withColumn("row", F.row_number().over(inside)).withColumn("upto", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    placed = placed.join(before, "range").select("doc_id", "size", "text_crc32", "h", (F.col("rows_before") + F.col("row") - 1).alias("row"), (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("at"))
    own = F.least(F.lit(shards - 1), F.floor((F.col("at") + F.col("size") / 2) * shards / F.lit(float(whole["bytes"]))).cast("int"))
    placed = materialize(placed.withColumn("own", own), "shard-placed", merge=False)

    # Groups across a border: a group has one key, so it is a shard's last and a later shard's first.
    edge = placed.groupBy("own").agg(F.min("h").alias("first"), F.max("h").alias("last")).orderBy("own").collect()
    across = sorted({a["last"] for a, b in zip(edge, edge[1:], strict=False) if a["last"] == b["first"]})
    moved, cut = F.lit(None).cast("int"), []
    for g in placed.where(F.col("h").isin(across)).groupBy("h").agg(F.sum("size").alias("bytes"), F.min("at").alias("at")).collect() if across else []:
        if g["bytes"] <= together * whole["bytes"] / shards:
            to = min(shards - 1, int((g["at"] + g["bytes"] / 2) * shards / whole["bytes"]))
            moved = F.when(F.col("h") == g["h"], F.lit(to)).otherwise(moved)
        else:
            cut.append(g["h"])
    placed = placed.withColumn("shard", F.coalesce(moved, "own"))
    start, n = [], 0
    for r in sorted(placed.groupBy("shard").count().collect(), key=lambda r: r["shard"]):
        start.append((r["shard"], n))
        n += r["count"]
    start = F.broadcast(spark.createDataFrame(start, "shard int, first_row long"))
    return placed.join(start, "shard").select("doc_id", "size", "text_crc32", law, "shard", (F.col("row") - F.col("first_row")).alias("slot"), none, (~F.col("h").isin(cut) if cut else F.lit(True)).alias("whole"))
