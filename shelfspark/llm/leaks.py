r"""Evaluation texts leaking into training texts: spaced-seed hashing.

A mask like ``1101011`` looks at some words of a window and ignores the others, so one changed word leaves a hit
under some mask. The hashes of all windows of the evaluation items are joined with those of the documents; where
enough of an item is hit, the words round the hits are aligned and the item's words that the document repeats in
at most two stretches are counted.

With at most ``MOST_HASHES`` item hashes they are sent to the workers, which match, align and emit leaks in one
pass without a shuffle; beyond, the hashes are joined by shuffle and the candidate pairs verified after it.
An item shorter than the masks is sought by all its words at once. Null and empty texts leak nothing.
"""

from __future__ import annotations

import html
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.session import spread

MASKS = ("1110011", "1101011", "1011101")
MOST_HASHES = 2_000_000
# Tags of any length; a comment that only closes after 200 characters is taken for text, so that a stray opening swallows nothing.
_TAG = re.compile(r"</?[a-zA-Z][^<>]*>|<[^<>]{1,200}>")
_HYPHEN = re.compile(r"(?<=\w)[-‐]\r?\n[>\s]*(?=\w)")
_WORD = re.compile(r"[0-9a-z]+")
#: Words of any script; of scripts written without spaces every sign is a word.
_SIGNS = r"\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
_ANY_WORD = re.compile(rf"[{_SIGNS}]|[^\W_{_SIGNS}]+")
_MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) % 2**64 | 1 for i in range(16)], dtype=np.uint64)


def words(text: str) -> list[str]:
    """Words without markup, case and accents."""
    s = _HYPHEN.sub("", html.unescape(_TAG.sub(" ", text)).replace("\u00ad", "").lower())
    if not s.isascii():
        s = "".join(c for c in unicodedata.normalize("NFKD", s.replace("ß", "ss")) if not unicodedata.combining(c))
    return (_WORD if s.isascii() else _ANY_WORD).findall(s)


@lru_cache(maxsize=200_000)
def _code(word: str) -> int:
    b = word.encode()
    return (zlib.crc32(b) << 32) | zlib.adler32(b)


def masks_of(n_words: int, masks: tuple[str, ...] = MASKS) -> tuple[str, ...]:
    """The masks that an item is sought by: those given, or, for an item shorter than they are, all its words at once."""
    return masks if n_words >= max(map(len, masks)) else ("1" * n_words,) * (n_words > 0)


def seeds(toks: list[str], masks: tuple[str, ...] = MASKS) -> list[tuple[int, np.ndarray]]:
    """(mask number, hash of every window) of a text; the number of a mask without gaps is its length below zero."""
    w = np.fromiter(map(_code, toks), dtype=np.uint64, count=len(toks))
    out = []
    for m, mask in enumerate(masks):
        m = m if "0" in mask else -len(mask)
        n = len(w) - len(mask) + 1
        if n > 0:
            h = np.full(n, np.uint64((m + 1) % 2**64), dtype=np.uint64)
            for j in (j for j, b in enumerate(mask) if b == "1"):
                h = (h ^ w[j : j + n]) * _MULTIPLIERS[j]
                h ^= h >> np.uint64(29)
            out.append((m, h))
    return out


def repeated(item: list[str], doc: list[str], hits: list[tuple[int, int]], gap_cost: float = 1.5, apart: int = 40) -> tuple[int, int]:
    """(words of the item covered, words matched) in the two best stretches round the hits (item place, doc place).

    A stretch is a best-scoring run of matching blocks: a matching word counts 1, each word left out or put in
    between two blocks costs ``gap_cost``. So a few changes inside running text are passed over, while a text
    that shares only the frame of its sentences falls into short runs.
    """
    places = sorted({d for _, d in hits})
    groups: list[list[int]] = []
    for d in places:
        if groups and d - groups[-1][1] <= apart:
            groups[-1][1] = d
        else:
            groups.append([d, d])
    found: list[tuple[int, int, int]] = []
    for a, b in groups:
        lo, hi = max(0, a - len(item)), min(len(doc), b + len(item) + 8)
        blocks = [x for x in SequenceMatcher(None, item, doc[lo:hi], autojunk=False).get_matching_blocks() if x.size]
        gaps = [max(y.a - x.a - x.size, y.b - x.b - x.size) * gap_cost for x, y in zip(blocks, blocks[1:], strict=False)]
        found += _runs(blocks, gaps)
    # Of runs over the same words of the item only the best counts, so a passage that is quoted often hides no other.
    solid: list[tuple[int, int, int]] = []
    for f in sorted((f for f in found if f[2] >= min(6, len(item))), key=lambda f: -f[2]):
        if not any(g[0] <= f[0] and f[1] <= g[1] for g in solid):
            solid.append(f)
    best = (0, 0)
    for i, f in enumerate(solid):
        best = max(best, (f[1] - f[0], f[2]), key=lambda x: x[1])
        for g in solid[i + 1 :]:
            if f[2] + g[2] <= best[1]:  # the rest are shorter still
                break
            shared = max(0, min(f[1], g[1]) - max(f[0], g[0]))
            if shared * 2 < min(f[1] - f[0], g[1] - g[0]):
                best = max(best, (f[1] - f[0] + g[1] - g[0] - shared, f[2] + g[2] - shared), key=lambda x: x[1])
    return best


def _runs(blocks: list, gaps: list[float]) -> list[tuple[int, int, int]]:
    """(first item word, end, words matched) of the best-scoring run of blocks, then of the runs beside it."""
    if not blocks:
        return []
    best, top, start, score = (0, 0), 0.0, 0, 0.0
    for k, x in enumerate(blocks):
        if k and score - gaps[k - 1] > 0:
            score -= gaps[k - 1]
        else:
            start, score = k, 0.0
        score += x.size
        if score > top:
            best, top = (start, k), score
    i, j = best
    own = (blocks[i].a, blocks[j].a + blocks[j].size, sum(b.size for b in blocks[i : j + 1]))
    return [own, *_runs(blocks[:i], gaps[: max(0, i - 1)]), *_runs(blocks[j + 1 :], gaps[j + 1 :])]


class Items:
    """The evaluation side: words of every item, and its hashes in order."""

    def __init__(self, rows: list[tuple[int, str]], masks: tuple[str, ...] = MASKS):
        self.ids = [k for k, _ in rows]
        self.words = [words(t) for _, t in rows]
        hashes, owner, place, kind = [], [], [], []
        for i, toks in enumerate(self.words):
            for m, h in seeds(toks, masks_of(len(toks), masks)):
                hashes.append(h)
                owner.append(np.full(len(h), i))
                place.append(np.arange(len(h)))
                kind.append(np.full(len(h), m))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash, self.owner, self.place = h[order], cat(owner, int)[order], cat(place, int)[order]
        self.kind = cat(kind, int)[order]
        self.sought = tuple(masks) + tuple("1" * n for n in sorted({-m for m in self.kind.tolist() if m < 0}))
        self.masks = {m: np.array([j for j, b in enumerate(mask) if b == "1"]) for m, mask in enumerate(masks)} | {-len(x): np.arange(len(x)) for x in self.sought[len(masks) :]}

    def leaks(self, text: str, least_hit: float) -> list[tuple[int, int, int, int]]:
        """(item, its words, words covered, words matched) of every item that is hit enough."""
        if not len(self.hash):
            return []
        toks = words(text)
        hits: dict[int, list[tuple[int, int]]] = {}
        covered: dict[int, set[int]] = {}
        for m, h in seeds(toks, self.sought):
            at = np.searchsorted(self.hash, h)
            same = np.nonzero(self.hash[np.minimum(at, len(self.hash) - 1)] == h)[0]
            for d in same.tolist():
                k = int(at[d])
                while k < len(self.hash) and self.hash[k] == h[d]:
                    i = int(self.owner[k])
                    hits.setdefault(i, []).append((int(self.place[k]), d))
                    covered.setdefault(i, set()).update((self.masks[m] + self.place[k]).tolist())
                    k += 1
        out = []
        for i, got in hits.items():
            n = len(self.words[i])
            if len(covered[i]) >= least_hit * n:
                out.append((self.ids[i], n, *repeated(self.words[i], toks, got)))
        return out


def find_leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", least_hit: float = 0.15, share: float = 0.5, density: float = 0.85
) -> DataFrame:
    """(doc_id, item_id, n_words, covered, matched) of documents that repeat at least ``share`` of an item's words.

    Of the words that a stretch covers at least ``density`` must match: a text of the same frame with other words in
    every gap is no leak.
    """
    eval_rows = items.where(F.col(text).isNotNull()).select(F.col(item_id).alias("i"), F.col(text).alias("t"))
    size = eval_rows.select(F.sum(F.size(F.split("t", r"\s+")) * len(MASKS)).alias("n")).first()["n"] or 0
    src = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("d"), F.col(text).alias("t"))
    schema = f"{doc_id} bigint, {item_id} bigint, n_words bigint, covered bigint, matched bigint"
    if size <= MOST_HASHES:
        rows = [(r["i"], r["t"]) for r in eval_rows.orderBy("i").collect()]
        index = docs.sparkSession.sparkContext.broadcast(rows)

        def match(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known = Items(index.value)
            for pdf in it:
                out = [(d, *x) for d, t in zip(pdf["d"], pdf["t"], strict=True) for x in known.leaks(t, least_hit)]
                yield pd.DataFrame(out, columns=[doc_id, item_id, "n_words", "covered", "matched"]).astype("int64")

        got = spread(src).mapInPandas(match, schema)
    else:
        shortest = max(map(len, MASKS))
        lengths = [n for n in range(1, shortest) if not eval_rows.where(_word_count("t") == n).isEmpty()]
        doc_masks = MASKS + tuple("1" * n for n in lengths)
        pairs = _seed_rows(src.select(F.col("d").alias("k"), "t"), lambda n: doc_masks).join(
            _seed_rows(eval_rows.select(F.col("i").alias("k"), "t"), masks_of).withColumnRenamed("k", "i"), "h"
        ).select(F.col("k").alias("d"), "i").distinct()

        def verify(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known: dict[int, Items] = {}
            for pdf in it:
                out = []
                for d, i, t, e in zip(pdf["d"], pdf["i"], pdf["t"], pdf["e"], strict=True):
                    if i not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[i] = Items([(i, e)])
                    out += [(d, *x) for x in known[i].leaks(t, least_hit)]
                yield pd.DataFrame(out, columns=[doc_id, item_id, "n_words", "covered", "matched"]).astype("int64")

        got = pairs.join(eval_rows.withColumnRenamed("t", "e"), "i").join(src, "d").mapInPandas(verify, schema)
    return got.where((F.col("matched") >= share * F.col("n_words")) & (F.col("matched") >= density * F.col("covered")))


def _word_count(text: str):
    @F.pandas_udf("int")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda t: len(words(t)))

    return udf(F.col(text))


def _seed_rows(df: DataFrame, masks: Callable[[int], tuple[str, ...]]) -> DataFrame:
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for k, t in zip(pdf["k"], pdf["t"], strict=True):
                toks = words(t)
                parts = [a for _, a in seeds(toks, masks(len(toks)))]
                h = np.unique(np.concatenate(parts)).astype(np.int64) if parts else np.zeros(0, dtype=np.int64)
                yield pd.DataFrame({"k": np.full(len(h), k, dtype=np.int64), "h": h})

    return df.mapInPandas(run, "k bigint, h bigint")
