r"""Several values packed in one field, split into one value per row with its position.

Two passes. The first collects the *dictionary*: whole values that hold a delimiter and whose bounds are beyond doubt
because they were enclosed in quotes or stood alone in their field (values without a delimiter need no protection).
The second builds a multi-pattern automaton of the dictionary on every worker, finds all known values in a field, and
lets dynamic programming pick the cheapest cover of the field by segments: a quoted segment, a known value, or an
unknown run up to the next delimiter. A delimiter inside a chosen segment is protected.

``protect='quoted'``: known values may cover a delimiter only where the notation leaves it open: after a quote that
opens an element and never closes. ``protect='known'``: also without quotes, for feeds that lost their quotes.

Inside ``{}`` or ``[]`` only the comma separates; elsewhere comma, semicolon, bar and tab do. Empty elements are
dropped and take no position; repeated values stay; null and empty fields give no row. A dictionary beyond what may be
sent to the workers is joined to the runs of elements that might be a value of it, with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.session import plain

DELIMITERS = ",;|\t"
#: The dictionary is sent to every worker only up to this many values, and this many characters altogether.
MOST_VALUES, MOST_CHARS = 100_000, 20_000_000
_SIMPLE = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def unwrap(field: str) -> tuple[str, bool]:
    """The text between the brackets of a field, and whether it had any."""
    s = field.strip()
    if s[:1] in ("{", "["):
        close = {"{": "}", "[": "]"}[s[0]]
        return (s[1:-1] if len(s) > 1 and s.endswith(close) else s[1:]), True
    return field, False


def quoted(s: str, i: int) -> int | None:
    """End of the quoted segment that opens at ``i`` (after its closing quote), or None if it never closes.

    A backslash escapes the next character and a doubled quote stands for one.
    """
    q, k, n = s[i], i + 1, len(s)
    while k < n:
        if s[k] == "\\":
            k += 2
        elif s[k] == q:
            if k + 1 < n and s[k + 1] == q:
                k += 2
            else:
                return k + 1
        else:
            k += 1
    return None


def unescape(s: str, q: str) -> str:
    """Backslash escapes (also ``\\uXXXX``) and doubled quotes undone."""
    out, i, n = [], 0, len(s)
    while i < n:
        c = s[i]
        if c == "\\" and i + 1 < n:
            d = s[i + 1]
            if d == "u" and len(h := s[i + 2 : i + 6]) == 4 and all(x in "0123456789abcdefABCDEF" for x in h):
                out.append(chr(int(h, 16)))
                i += 6
                continue
            out.append(_SIMPLE.get(d, d))
            i += 2
        elif c == q and s[i + 1 : i + 2] == q:
            out.append(q)
            i += 2
        else:
            out.append(c)
            i += 1
    return "".join(out)


def value_of(segment: str, quotes: str) -> str:
    """A segment as a value: outer white space and enclosing quotes off, escapes undone."""
    s = segment.strip()
    if len(s) > 1 and s[0] in quotes and quoted(s, 0) == len(s):
        return unescape(s[1:-1], s[0]).strip()
    return unescape(s, '"') if "\\" in s else s


def automaton(values: list[str]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for v in values:
        a.add_word(v, len(v))
    a.make_automaton()
    return a


def notation(field: str) -> tuple[str, str, str]:
    """The body of a field, its delimiters and its quotes."""
    body, inside = unwrap(field)
    return body, "," if inside else DELIMITERS, "\"'" if field.strip()[:1] == "[" else '"'


def places(body: str, known: ahocorasick.Automaton) -> list[tuple[int, int]]:
    """(begin, end) of all known values in a text."""
    return [(end + 1 - size, end + 1) for end, size in known.iter(body)] if len(known) else []


def runs(field: str, most: int) -> list[tuple[int, int, str]]:
    """(begin, end, text) of every run of two to ``most`` + 1 plain elements, outer white space off: what might be a known value."""
    body, delims, quotes = notation(field)
    cuts = [-1, *(i for i, c in enumerate(body) if c in delims), len(body)]
    out = []
    for i in range(len(cuts) - 1):
        for j in range(i + 2, min(i + most + 1, len(cuts) - 1) + 1):
            a, b = cuts[i] + 1, cuts[j]
            while a < b and (body[a].isspace() or body[a] in quotes):
                a += 1
            text = body[a:b].rstrip()
            if text:
                out.append((a, a + len(text), text))
    return out


def segments(field: str, known: list[tuple[int, int]] | None = None, protect: str = "quoted") -> list[tuple[str, bool]]:
    """(value, was quoted) of every element that is not empty, in order; ``known``: places of known values in its body."""
    body, delims, quotes = notation(field)
    n = len(body)
    hits: dict[int, list[int]] = {}
    for a, b in known or ():
        hits.setdefault(a, []).append(b)
    best: dict[int, tuple[float, int, bool]] = {0: (0.0, -1, False)}
    i = 0
    while i <= n:  # positions at which an element may begin, in order
        if i not in best:
            i += 1
            continue
        cost = best[i][0]
        a = i
        while a < n and body[a].isspace() and body[a] not in delims:
            a += 1
        ends: list[tuple[int, float, bool]] = []
        if a < n and body[a] in quotes and (e := quoted(body, a)) is not None:
            b = e
            while b < n and body[b].isspace() and body[b] not in delims:
                b += 1
            if b == n or body[b] in delims:
                ends.append((b, 0.01, True))
        if not ends:
            b = a
            while b < n and body[b] not in delims:
                if body[b] in '"' and b > a and (e := quoted(body, b)) is not None:
                    b = e
                else:
                    b += 1
            ends.append((b, 1.0, False))
            # After a quote that never closes a known value says where its element ends.
            torn = a < n and body[a] in quotes
            for e in hits.get(a + 1 if torn else a, ()):
                b = e
                while b < n and body[b].isspace() and body[b] not in delims:
                    b += 1
                if (b == n or body[b] in delims) and (torn or protect == "known"):
                    ends.append((b, 0.1, False))
        for b, c, q in ends:
            nxt = b + 1
            if nxt not in best or cost + c < best[nxt][0]:
                best[nxt] = (cost + c, i, q)
        i += 1
    out = []
    k = n + 1
    while k > 0:
        _, start, q = best[k]
        part = body[start : k - 1].strip()
        if not q and part[:1] and part[0] in quotes and any(start < a < k and b - a == len(part) - 1 for a, b in known or ()):
            part = part[1:]
        v = value_of(part, quotes)
        if v:
            out.append((v, q))
        k = start
    return out[::-1]


def dictionary(df: DataFrame, column: str, least: int = 2) -> DataFrame:
    """(value): values with a delimiter, seen at least ``least`` times in quotes or alone."""

    def sure(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            seen: dict[str, int] = {}
            for field in pdf["field"]:
                got = segments(field)
                for v, q in got:
                    if (q or len(got) == 1) and any(c in DELIMITERS for c in v):
                        seen[v] = seen.get(v, 0) + 1
            yield plain(pd.DataFrame({"value": list(seen), "n": list(seen.values())}))

    fields = df.select(F.col(column).cast("string").alias("field")).where("field is not null and trim(field) != ''")
    counted = fields.mapInPandas(sure, "value string, n bigint").groupBy("value").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least).select("value")


def split_packed(df: DataFrame, key: str, column: str, protect: str = "quoted", known: list[str] | None = None) -> DataFrame:
    """(key, pos, value) for every element of ``column``; other columns of ``df`` play no part."""
    if protect not in ("quoted", "known"):
        raise ValueError("protect is 'quoted' or 'known'")
    fields = df.select(F.col(key).alias("key"), F.col(column).cast("string").alias("field")).where(
        "field is not null and trim(field) != ''"
    )
    if known is None:
        words = dictionary(df, column)
        size = words.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.char_length("value")), F.lit(0)).alias("c")).first()
        held = [r["value"] for r in words.collect()] if size["n"] <= MOST_VALUES and size["c"] <= MOST_CHARS else None
    else:
        words, held = None, known
    schema = T.StructType(
        [T.StructField("key", fields.schema["key"].dataType), T.StructField("pos", T.LongType()), T.StructField("value", T.StringType())]
    )

    def rows(pdf: pd.DataFrame, found: Callable[[int, str], list[tuple[int, int]]]) -> pd.DataFrame:
        keys, pos, values = [], [], []
        for i, (k, field) in enumerate(zip(pdf["key"], pdf["field"], strict=True)):
            for p, (v, _) in enumerate(segments(field, found(i, field), protect), start=1):
                keys.append(k)
                pos.append(p)
                values.append(v)
        return pd.DataFrame({"key": pd.Series(keys, dtype=pdf["key"].dtype), "pos": pd.Series(pos, dtype="int64"), "value": pd.Series(values, dtype=object)})

    if held is not None:
        sent = df.sparkSession.sparkContext.broadcast(sorted(held))

        def split(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            a = automaton(sent.value)
            for pdf in it:
                yield rows(pdf, lambda i, field: places(notation(field)[0], a))

        return fields.mapInPandas(split, schema)

    most = words.agg(F.max(F.char_length("value") - F.char_length(F.translate("value", DELIMITERS, "")))).first()[0]
    kinds = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("value", T.StringType())]))

    @F.pandas_udf(kinds)
    def might(s: pd.Series) -> pd.Series:
        return s.map(lambda f: [{"a": a, "b": b, "value": t} for a, b, t in runs(f, most)])

    # Equal fields have equal hits, so they are joined once.
    texts = fields.select("field").distinct().select("field", F.inline(might("field")))
    hits = texts.join(words, "value").groupBy("field").agg(F.collect_list(F.struct("a", "b")).alias("hits"))

    def split_joined(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield rows(pdf, lambda i, field: [(h["a"], h["b"]) for h in (pdf["hits"].iloc[i] if pdf["hits"].iloc[i] is not None else ())])

    return fields.join(hits, "field", "left").select("key", "field", "hits").mapInPandas(split_joined, schema)
