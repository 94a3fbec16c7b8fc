"""Text expressions: a regex dialect that matches Unicode-aware patterns, slices, folds and counts.

All functions take and give Columns and stay inside the JVM.  Null texts count as empty
unless a function says otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode classes and case, and only \n as line end.
FLAGS = "iuUd"


def rx(pattern: str, extra: str = "") -> str:
    """A case-insensitive pattern; extra: ``s`` (dot takes newlines), ``m`` (^ and $ at lines)."""
    return f"(?{FLAGS}{extra})(?:{pattern})"


def sensitive(pattern: str) -> str:
    return f"(?uUd)(?:{pattern})"


def let(c: Column, body) -> Column:
    """body(c) with c evaluated once: an expression that uses its argument often would else grow with every level it is nested."""
    return F.get(F.transform(F.array(c), lambda x: body(x)), F.lit(0))


def text_of(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def matches(c: Column, pattern: str, extra: str = "") -> Column:
    return c.rlike(rx(pattern, extra))


# ---------------------------------------------------------------- what a pattern can't do without

#: Escapes that Python reads as Java does, and syntax that it doesn't or may not.
_KNOWN = re.compile(r"\\[sSdDwWbBnrtf]|\\[^A-Za-z0-9]")
_FOREIGN = re.compile(r"\\|&&|\[\^?\]|\[[^\]]*\[|\(\?(?!:|=|!|<=|<!)")
#: What lower case leaves of the characters beyond ASCII that a case-insensitive pattern takes for i and s (that of the
#: Kelvin sign is k).
_FOLDED = ("\u0131", "\u0307", "\u017f")
#: So many patterns in a row are tried together on a text that some pattern of the whole list may match.
_CHUNK = 6


def _sure(parsed) -> list[frozenset[str]]:
    """Sets of lower-case words of a parsed pattern: one word of each set stands in whatever it matches."""
    out, run = [], ""
    for op, arg in [*parsed, (None, None)]:
        if str(op) == "LITERAL" and arg < 128:
            run += chr(arg).lower()
            continue
        if run:
            out.append(frozenset([run]))
            run = ""
        if str(op) == "SUBPATTERN":
            out += _sure(arg[3])
        elif str(op) in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            out += _sure(arg[2])
        elif str(op) == "BRANCH":
            each = [max(_sure(a), key=_worth, default=None) for a in arg[1]]
            if None not in each:
                out.append(frozenset().union(*each))
    return out


def _worth(words: frozenset[str]) -> tuple[float, list[str]]:
    """Long words are rare, and each one costs a search."""
    return min(min(map(len, words)), 9) ** 2 / len(words), sorted(words)


@cache
def _words_of(pattern: str) -> tuple[frozenset[str], ...]:
    pattern = pattern.replace(r"\z", "$")
    if _FOREIGN.search(_KNOWN.sub("a", pattern)):
        return ()
    try:
        return tuple(_sure(re._parser.parse(pattern)))
    except (re.error, AttributeError, OverflowError):
        return ()


@cache
def needed(patterns: tuple[str, ...]) -> tuple[str, ...] | None:
    """Few lower-case words, one of which stands in every text that any of the patterns matches; null if that can't be said."""
    left = [_words_of(p) for p in patterns]
    if not all(left):
        return None
    chosen: set[str] = set()
    met = lambda sets, words: any(all(any(w in x for w in words) for x in s) for s in sets)
    while left := [sets for sets in left if not met(sets, chosen)]:
        chosen |= max({s for sets in left for s in sets}, key=lambda s: (sum(met(sets, s) for sets in left) * _worth(s)[0], sorted(s)))
    return tuple(sorted(w for w in chosen if not any(v != w and v in w for v in chosen)))


def possible(c: Column, patterns: Sequence[str]) -> Column:
    """False only where none of the patterns can match: a search for a few words costs far less than the patterns do."""
    words = needed(tuple(patterns))
    if words is None:
        return F.lit(True)
    return let(F.lower(c), lambda low: contains_any(low, [*words, *_FOLDED]))


def any_match(c: Column, patterns: Sequence[str], extra: str = "") -> Column:
    """Existence only, so one alternation is enough."""
    return c.rlike(rx("|".join(f"(?:{p})" for p in patterns), extra)) if patterns else F.lit(False)


def starts(c: Column, patterns: Sequence[str]) -> Column:
    """Any pattern matches at the beginning."""
    return matches(c, "^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")") if patterns else F.lit(False)


def count_matching(c: Column, patterns: Sequence[str], extra: str = "") -> Column:
    """How many of the patterns occur."""
    return reduce(lambda a, b: a + b, [matches(c, p, extra).cast("int") for p in patterns], F.lit(0))


def contains_any(c: Column, literals: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(x) for x in literals], F.lit(False))


#: Unicode white space, as a class of the regex dialect has it.
BLANK = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Unicode white space off both ends: looks at the ends only, where a regex would try every run of blanks."""
    return F.btrim(c, F.lit(BLANK))


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def words(c: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def remove_each(c: Column, patterns: Sequence[str], extra: str = "", by: str = "") -> Column:
    """Every occurrence of each pattern goes, pattern after pattern; the order matters."""
    each = lambda x, some: reduce(lambda t, p: F.regexp_replace(t, rx(p, extra), by), some, x)
    # Looking for words costs about as much as two patterns.
    if len(patterns) < 4 or needed(tuple(patterns)) is None:
        return each(c, patterns)
    return _removed_in_turn(c, list(patterns), each)


def _removed_in_turn(c: Column, patterns: list[str], each) -> Column:
    """Some patterns after the others, each few only on a text that has their words.

    One aggregate for all of them: with a ``let`` each, the analyzer would run out of iterations.  Its
    first turn looks for words of the whole list.
    """
    if len(patterns) <= _CHUNK:
        return let(c, lambda x: F.when(possible(x, patterns), each(x, patterns)).otherwise(x))
    chunks = [patterns[i : i + _CHUNK] for i in range(0, len(patterns), _CHUNK)]
    has = lambda low, some: contains_any(low, [*needed(tuple(some)), *_FOLDED])
    state = lambda text, go: F.struct(text.alias("text"), go.alias("go"))

    def turn(acc: Column, i: Column) -> Column:
        text = acc["text"]

        def chosen(low: Column) -> Column:
            out = acc
            for k, some in enumerate(chunks):
                out = F.when((i == k) & has(low, some), state(each(text, some), acc["go"])).otherwise(out)
            return F.when(i < 0, state(text, has(low, patterns))).otherwise(out)

        return let(F.when(acc["go"], F.lower(text)), chosen)

    turns = F.array(*[F.lit(i) for i in range(-1, len(chunks))])
    return F.aggregate(turns, state(c, F.lit(True)), turn, lambda acc: acc["text"])


def drop_literals(c: Column, literals: Sequence[str]) -> Column:
    return reduce(lambda t, x: F.replace(t, F.lit(x), F.lit("")), literals, c)


def before(c: Column, pattern: str, extra: str = "") -> Column:
    """What stands before the first match; all of it without one."""
    return F.get(F.split(c, rx(pattern, extra), 2), F.lit(0))


def after(c: Column, pattern: str, extra: str = "") -> Column:
    """What stands behind the first match; null without one."""
    return F.get(F.split(c, rx(pattern, extra), 2), F.lit(1))


def _rest(x: Column, pattern: str) -> Column:
    """``after``, but a split only where there is a match: it compiles its pattern anew for each text."""
    return F.when(matches(x, pattern), after(x, pattern))


def until_first_listed(c: Column, ends: Sequence[str]) -> Column:
    """Cut at the first end in the list that occurs at all, even if a later one stands nearer."""

    def cut(x: Column) -> Column:
        out = x
        for p in reversed(ends):
            out = F.when(matches(x, p), before(x, p)).otherwise(out)
        return F.when(possible(x, ends), out).otherwise(x)

    return let(c, cut)


def until_nearest(c: Column, ends: Sequence[str]) -> Column:
    """Cut at the nearest of all ends."""
    whole = "|".join(f"(?:{p})" for p in ends)
    return let(c, lambda x: F.when(possible(x, ends) & matches(x, whole), before(x, whole)).otherwise(x)) if ends else c


def after_last_listed(c: Column, starts: Sequence[str]) -> Column:
    """The shortest rest behind any of the patterns' first matches; null if none matches."""
    rests = let(c, lambda x: F.when(possible(x, starts), F.array_compact(F.array(*[_rest(x, p) for p in starts]))))
    return F.get(F.array_sort(rests, lambda a, b: F.length(a) - F.length(b)), F.lit(0))


def after_first_listed(c: Column, starts: Sequence[str]) -> Column:
    """The rest behind the first pattern in the list that matches; null if none does."""
    return let(c, lambda x: F.when(possible(x, starts), F.coalesce(*[_rest(x, p) for p in starts])))


def first_slice(c: Column, starts: Sequence[str], cut, clean, skip_empty: bool) -> Column:
    """Text between a start and an end: starts in order of priority, then ``cut``, then ``clean``.

    skip_empty: a start with nothing behind it passes on to the next one.
    """

    def slices(x: Column) -> Column:
        found = [clean(cut(_rest(x, p))) for p in starts]
        if skip_empty:
            found = [let(f, lambda y: F.nullif(y, F.lit(""))) for f in found]
        return F.when(possible(x, starts), F.coalesce(*found, F.lit(""))).otherwise("")

    return let(c, slices)


def ratio_of(c: Column, keep_out: str) -> Column:
    """Share of characters outside the class ``keep_out``; 0 for an empty text."""
    return let(c, lambda x: F.when(F.length(x) == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(x, keep_out, "")) / F.length(x)))


def title(s: str) -> str:
    """Words of a label in title case, for driver-side reports; '_' ends a word."""
    return "".join(ch.upper() if i == 0 or not s[i - 1].isalpha() else ch.lower() for i, ch in enumerate(s))
