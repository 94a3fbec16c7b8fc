"""URL filters: all glob rules at once, as a bit-parallel wildcard automaton (Shift-And, several words).

A canonical URL is "." + host + path (host lower-cased).  A glob has literals, ``?`` (any one
character but ``/``), ``*`` (any run without ``/``) and ``**`` (any run).  Every rule takes one
bit for its start and one for each literal or ``?``; all rules lie side by side in 64-bit words.
A step shifts every word, lets through the bits whose item accepts the character, and keeps the
bits that wait at a wildcard.  The same step runs for all URLs of a batch, by position.

Host rules (host, path) become the glob ``*.host path**`` over that form, so they fit the
host and all subdomains when the URL's path starts with theirs; of those that fit, the longest
decides.  Where none fits, the general globs decide: block if any of them fits, else allow.

Defined cases: a null URL or one without ``://`` has an empty host and path, and no rule fits;
characters beyond ASCII fit only wildcards and equal literals; repeated rows are judged alike;
extra columns are ignored.  An empty table gives an empty result.  Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rules:
    host: tuple[tuple[str, str, str], ...] = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    globs: tuple[str, ...] = ("*casino*/**", "*.cheap-pills.*/**", "*free-bets*/**", "*.ads-track.*/**", "*.adserver.*/**", "**/wp-login.php**")
    default: str = field(default="allow")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def parse_glob(glob: str) -> list[tuple[str, str]]:
    """(kind, character): kind is lit, one, star (no slash) or any."""
    items, i = [], 0
    while i < len(glob):
        if glob[i] == "*":
            deep = glob[i : i + 2] == "**"
            items.append(("any" if deep else "star", ""))
            i += 2 if deep else 1
        else:
            items.append(("one", "") if glob[i] == "?" else ("lit", glob[i]))
            i += 1
    return items


class ShiftAnd:
    """Globs packed into masks.  Characters that no glob names share one class; '/' has its own."""

    def __init__(self, globs: list[str]):
        parsed = [parse_glob(g) for g in globs]
        self.chars = {c: k for k, c in enumerate(sorted({c for p in parsed for kind, c in p if kind == "lit"} | {"/"}), 1)}
        n = len(self.chars) + 1
        bits = sum(1 + sum(kind in ("lit", "one") for kind, _ in p) for p in parsed)
        self.words = max(1, -(-bits // 64))
        step, stay = np.zeros((n, bits or 1), bool), np.zeros((n, bits or 1), bool)
        first, self.last = np.zeros(bits or 1, bool), []
        slash, at = self.chars["/"], -1
        for p in parsed:
            at += 1
            first[at] = True
            for kind, c in p:
                if kind in ("star", "any"):
                    stay[np.arange(n) != slash, at] = True
                    stay[slash, at] |= kind == "any"
                    continue
                at += 1
                if kind == "lit":
                    step[self.chars[c], at] = True
                else:
                    step[:, at] = True
                    step[slash, at] = False
            self.last.append(at)
        self.step, self.stay, self.first = self._pack(step), self._pack(stay), self._pack(first[None])[0]

    def _pack(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((len(table), self.words), np.uint64)
        for bit in range(table.shape[1]):
            out[:, bit // 64] |= table[:, bit].astype(np.uint64) << np.uint64(bit % 64)
        return out

    def match(self, urls: list[str]) -> np.ndarray:
        """A row a URL, a column a glob."""
        n = len(urls)
        order = sorted(range(n), key=lambda i: -len(urls[i]))
        lengths = np.array([len(urls[i]) for i in order], np.int64)
        get = self.chars.get
        state = np.repeat(self.first[None], n, 0) if n else np.zeros((0, self.words), np.uint64)
        one, top = np.uint64(1), np.uint64(63)
        alive = n
        for j in range(int(lengths[0]) if n else 0):
            while alive and lengths[alive - 1] <= j:
                alive -= 1
            c = np.fromiter((get(urls[order[k]][j], 0) for k in range(alive)), np.int64, alive)
            s = state[:alive]
            moved = s << one
            moved[:, 1:] |= s[:, :-1] >> top
            state[:alive] = (moved & self.step[c]) | (s & self.stay[c])
        out = np.zeros((n, len(self.last)), bool)
        for k, bit in enumerate(self.last):
            out[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & one
        return out


def judge(urls: list[str | None], rules: Rules, machine: ShiftAnd | None = None) -> pd.DataFrame:
    machine = machine or compile_rules(rules)
    parts = [split_url(u) for u in urls]
    hit = machine.match(["." + h + p if h or p else "" for h, p in parts])
    out = []
    for (host, path), row in zip(parts, hit, strict=True):
        fits = [r for r, ok in zip(rules.host, row, strict=False) if ok]
        globs = [g for g, ok in zip(rules.globs, row[len(rules.host) :], strict=True) if ok]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        verdict = best[0] if best else "block" if globs else rules.default
        out.append((host, path, best and best[1] + best[2], verdict, globs))
    return pd.DataFrame(out, columns=["host", "path", "rule", "verdict", "globs"])


def compile_rules(rules: Rules) -> ShiftAnd:
    return ShiftAnd([f"*.{host}{path}**" for _, host, path in rules.host] + list(rules.globs))


def filter_urls(pages: DataFrame, rules: Rules = Rules(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """A row a page: page_id, host, path, rule, verdict, globs (general globs that fit)."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = compile_rules(rules)
        for urls in batches:
            yield judge([None if u is None or u != u else u for u in urls], rules, machine)

    verdict = F.pandas_udf(run, "host string, path string, rule string, verdict string, globs array<string>")
    return pages.select(F.col(id_col).alias("page_id"), verdict(F.col(url_col)).alias("v")).select("page_id", "v.*")
