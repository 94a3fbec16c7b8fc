"""Benchmark decontamination: one word-level Aho-Corasick automaton over the normalised test items.

A text is read once.  Words are runs of ASCII digits, lower-cased ASCII letters and any
non-ASCII characters; a pattern is a window of ``window`` consecutive words of an item (an
item with fewer words, but not none, is one window).  The automaton runs over word numbers,
so a match can only begin and end at word borders, and word positions lead back to character
offsets of the original text.

Defined cases: a null text has no words; an item without words has no window; items with a
null id are left out (they can't be named); equal windows of several items count for each of
them; extra columns are ignored or, in ``mark``, kept.  An empty table gives an empty result;
with an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, fresh, materialize, revive, share, small_batches, tidied, tidy

WINDOW = 8
#: Bytes of benchmark text in one automaton, which takes some 200 times that in each worker.  A larger
#: benchmark is matched block by block.
BLOCK_BYTES = 2_000_000
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_UPPER = {c: c + 32 for c in range(65, 91)}

RUNS = "n_words long, item_ids array<string>, runs array<struct<first:int,last:int,start:int,end:int>>, full_window boolean"
REPORT = "n_words long, n_hit long, item_ids array<string>, spans array<struct<start:int,end:int>>, full_window boolean"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(ALNUM).split() if text else []


def windows(item: list[bytes], window: int) -> list[tuple[bytes, ...]]:
    if not item:
        return []
    return [tuple(item[i : i + window]) for i in range(max(1, len(item) - window + 1))]


class Automaton:
    """The windows of a block of items, with the items of each window."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window, self.number, self.owners = window, {}, {}
        for item_id, text in items:
            for w in windows(words(text), window):
                key = tuple(self.number.setdefault(x, len(self.number) + 1) for x in w)
                self.owners.setdefault(key, set()).add(item_id)
        self.keys = list(self.owners)
        self.machine = None

    def ready(self) -> Automaton:
        """Built where it is used: the machine itself isn't sent."""
        if self.machine is None and self.keys:
            import ahocorasick

            self.machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for i, key in enumerate(self.keys):
                self.machine.add_word(key, i)
            self.machine.make_automaton()
        return self

    def scan(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str], bool]:
        """Hit word runs (first, last + 1) in order, items hit, and whether a full window was."""
        if not self.keys or not found:
            return [], set(), False
        get = self.number.get
        numbers = tuple([get(w, 0) for w in found])
        runs, items, full = [], set(), False
        for last, k in self.machine.iter(numbers) if any(numbers) else ():
            n = len(self.keys[k])
            first = last - n + 1
            items |= self.owners[self.keys[k]]
            full |= n >= self.window
            while runs and runs[-1][1] >= first:
                first = min(first, runs.pop()[0])
            runs.append((first, last + 1))
        return runs, items, full


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    block, held = [], 0
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    for r in rows.toLocalIterator():
        if block and held + len(r.t) > limit:
            yield block
            block, held = [], 0
        block.append((r.i, r.t))
        held += len(r.t)
    yield block


def mark(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``contamination`` (see REPORT), named longer if ``docs`` has one.

    A benchmark of one block is one automaton, broadcast, past which all documents stream; nothing is
    shuffled.  A larger one comes to the driver block by block: documents get row numbers, each
    block has a pass of its own that reports the documents it hits, and the reports on a document
    are united.  The result doesn't depend on the block size.
    """
    (name,) = fresh(docs.columns, "contamination")
    blocks = _blocks(benchmark, item_col, item_text_col, block_bytes)
    one, more = next(blocks), next(blocks, None)
    spark = small_batches(docs).sparkSession
    text = F.col(f"`{text_col}`")
    if more is None:
        return docs.withColumn(name, _reporter(share(spark, Automaton(one, window)))(text))
    (row,) = fresh([*docs.columns, name], "__row")
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "decontam-rows", merge=False)
    parts = []
    while one is not None:
        machine = share(spark, Automaton(one, window))
        found = keyed.select(F.col(row).alias("row"), text.alias("text")).mapInPandas(tidied(_pass(machine, not parts)), f"row long, {RUNS}")
        parts.append(materialize(found, "decontam-hits"))
        machine.destroy()
        one, more = more, next(blocks, None)
    whole = parts[0]
    for x in parts[1:]:
        whole = whole.unionByName(x)
    merged = whole.groupBy("row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), F.flatten(F.collect_list("runs")).alias("runs"), F.max("full_window").alias("full_window"))
    united = F.pandas_udf(_united, "n_hit long, spans array<struct<start:int,end:int>>")(F.col("runs"))
    merged = merged.withColumn("u", united).select(F.col("row").alias(row), F.struct("n_words", F.col("u.n_hit").alias("n_hit"), "item_ids", F.col("u.spans").alias("spans"), "full_window").alias(name))
    return keyed.join(merged, row).select(*[F.col(f"`{c}`") for c in docs.columns], name)


def _report(m: Automaton, t: str | None) -> tuple:
    """As RUNS: words, items, runs of hit words with their offsets, and whether a full window was hit."""
    found = words(t)
    runs, items, full = m.scan(found)
    at = [x.span() for x in _WORD.finditer(t.translate(_UPPER))] if runs else []
    return len(found), sorted(items), [(a, b, at[a][0], at[b - 1][1]) for a, b in runs], full


def _reporter(machine):
    def report(text: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = revive(Automaton, machine.value).ready()
        for batch in text:
            rows = []
            for t in batch:
                n, items, runs, full = _report(m, t)
                rows.append((n, sum(b - a for a, b, *_ in runs), items, [x[2:] for x in runs], full))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "item_ids", "spans", "full_window"])
        tidy()

    return F.pandas_udf(report, REPORT)


def _pass(machine, every: bool):
    """Rows of the documents that a block hits, or of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = revive(Automaton, machine.value).ready()
        for b in batches:
            rows = [(row, *_report(m, t)) for row, t in zip(b["row"], b["text"], strict=True)]
            yield pd.DataFrame([x for x in rows if every or x[3]], columns=["row", "n_words", "item_ids", "runs", "full_window"])

    return run


def _united(runs: pd.Series) -> pd.DataFrame:
    """Overlapping runs of hit words become one."""
    rows = []
    for found in runs:
        out = []
        for a, b, start, end in sorted((x["first"], x["last"], x["start"], x["end"]) for x in found):
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2], max(end, out[-1][3]))
            else:
                out.append((a, b, start, end))
        rows.append((sum(b - a for a, b, *_ in out), [x[2:] for x in out]))
    return pd.DataFrame(rows, columns=["n_hit", "spans"])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of op5, one row a document."""
    c = F.col("contamination")
    n = F.size(c["item_ids"]).cast("long")
    return mark(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        n.alias("n_items"),
        F.sha2(F.array_join(c["item_ids"], ","), 256).alias("items_sha256"),
        (n >= 2).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without a full benchmark window and with windows of one item at most."""
    marked = mark(docs, benchmark)
    c = F.col(marked.columns[-1])
    return marked.where(~(c["full_window"] | (F.size(c["item_ids"]) >= 2))).select(*[F.col(f"`{x}`") for x in docs.columns])


def brute_force(texts: dict, items: dict, window: int = WINDOW) -> dict:
    """For tests: every window against every word position."""
    out = {}
    for doc_id, text in texts.items():
        found, hit, named = _WORD.findall((text or "").translate(_UPPER)), set(), set()
        for item_id, item in items.items():
            own = _WORD.findall((item or "").translate(_UPPER))
            for k in range(max(1, len(own) - window + 1) if own else 0):
                w = own[k : k + window]
                for i in range(len(found) - len(w) + 1):
                    if found[i : i + len(w)] == w:
                        hit |= set(range(i, i + len(w)))
                        named.add(str(item_id))
        out[doc_id] = (len(found), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), len(named) >= 2)
    return out
