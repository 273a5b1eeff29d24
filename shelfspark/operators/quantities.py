"""Quantities written in many units and notations, brought to one amount per record.

A text is read into *readings*: every way in which its numbers, units and pack words can be combined into
``packs x content``. Two columns of a record are tied by physical identities: they state the same content
(``content_1 = content_2``), or one states the total of the other (``content_1 = packs * content_2``), or one
states a mass and the other a volume (``mass = density * volume``). The density is not given: it is solved for each
group of records as the median of mass over volume where both are stated beyond doubt (``densities``), and is 1 g/ml
where no record of the collection says.

Of all combinations of readings the one with the least sum of absolute log residuals of these identities is kept.
How usual a notation or the size of one container is decides only what the identities leave open. If another
combination with a different amount comes within ``tie`` of the best, the solution is flagged as not unique.

The work is local to a row: one Arrow-batched pass; the densities are a small grouped median before it.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import plain

# Units of the three base units.
UNIT_FACTORS = {
    "g": ("g", 1.0),
    "kg": ("g", 1000.0),
    "oz": ("g", 28.349523125),
    "lb": ("g", 453.59237),
    "ml": ("ml", 1.0),
    "cl": ("ml", 10.0),
    "dl": ("ml", 100.0),
    "l": ("ml", 1000.0),
    "floz": ("ml", 29.5735295625),
    "pint": ("ml", 473.176473),
    "quart": ("ml", 946.352946),
    "gallon": ("ml", 3785.411784),
    "count": ("count", 1.0),
    "dozen": ("count", 12.0),
}
UNIT_SPELLINGS = {
    "floz": r"fl(?:uid)?[.\s-]*(?:oz|ounces?)",
    "oz": r"oz|ounces?|onces?",
    "lb": r"lbs?|pounds?|\#",
    "kg": r"kgs?|kilos?|kilogram(?:me)?s?",
    "g": r"g|grs?|gms?|gram(?:me)?s?",
    "ml": r"mls?|millilit(?:er|re)s?",
    "cl": r"cls?|centilit(?:er|re)s?",
    "dl": r"dls?|decilit(?:er|re)s?",
    "l": r"l|lt|ltrs?|lit(?:er|re)s?",
    "pint": r"pints?|pts?",
    "quart": r"quarts?|qts?",
    "gallon": r"gallons?|gals?",
    "count": r"counts?|cts?|cnt|pcs?|pieces?|pces?",
    "dozen": r"dozens?|doz|dz",
}
NUMBER_WORDS = {
    w: i
    for i, w in enumerate("one two three four five six seven eight nine ten eleven twelve".split(), start=1)
} | {"fifteen": 15, "sixteen": 16, "eighteen": 18, "twenty": 20, "twenty-four": 24, "thirty": 30}
_UNIT = "|".join(f"(?P<{u}>{p})" for u, p in UNIT_SPELLINGS.items())
_PLAIN_UNIT = "|".join(UNIT_SPELLINGS.values())
_NUM = r"\d+[\s-]+\d+\s*/\s*\d+|\d+\s*/\s*\d+|\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+[.,]\d+|\d+|[.,]\d+"
_WORDS = "|".join(sorted(NUMBER_WORDS, key=len, reverse=True))
_QTY = re.compile(
    rf"(?<![\w.,/])(?P<num>{_NUM}|half|a\s+half)[\s-]*(?:{_UNIT})(?![^\W\d_])\.?", re.IGNORECASE
)
_JOINED = re.compile(r"\s*(?:and|&|,)?\s*$")
_TIMES_BEFORE = re.compile(r"(?<![\w.,/'\"])(\d{1,4})\s*[x×*]\s*$", re.IGNORECASE)
_SLASH_BEFORE = re.compile(r"(?<![\w.,/])(\d{1,4})\s*/\s*$")
_EACH_BEFORE = re.compile(rf"(?<![\w.,/])(\d{{1,4}}|{_WORDS})[\s-]*(?:ea|each|units?)\b\.?\s*[-–—:,]?\s*$", re.IGNORECASE)
_TIMES_AFTER = re.compile(rf"^\s*[x×*]\s*(\d{{1,4}})(?![\w.,/'\"])(?!\s*(?:{_PLAIN_UNIT})(?![^\W\d_]))", re.IGNORECASE)
_WORD_BEFORE = re.compile(rf"(?<![\w-])({_WORDS}|\d{{1,4}})\s+$", re.IGNORECASE)
_PACKS_AFTER = re.compile(
    r"^\s*(?:packs|packets|packages|bottles|cans|jars|boxes|bags|pouches|cartons|tubs|cups|tins|units)\b", re.IGNORECASE
)
_PACK = re.compile(
    rf"(?<![\w.,/])(\d{{1,4}}|{_WORDS}|twin|double|triple)[\s-]*(?:packs?|pks?|packets?|multi-?pack|cans|bottles|total)\b"
    rf"|\b(?:packs?|pks?|case|cases|multipack)\s+of\s+(\d{{1,4}}|{_WORDS})\b",
    re.IGNORECASE,
)
_HOLDS = re.compile(rf"\b(?:sets?|box|boxes|bags?|jar|tub|bottle|carton|tray|tin|pouch)\s+of\s+(\d{{1,5}}|{_WORDS}|dozen)\b", re.IGNORECASE)
_STRENGTH = re.compile(r"(?<![\w.,])\d+(?:[.,]\d+)?[\s-]*(?:mg|mcg|µg|μg|iu|%|proof)(?![^\W\d_])", re.IGNORECASE)
_SIZE_CELL = re.compile(r"""["']?size_user_friendly["']?\s*:\s*("(?:[^"\\]|\\.)*"?|'(?:[^'\\]|\\.)*'?|[^,}]*)""")
_UOM_CELL = re.compile(r"""["']?uom["']?\s*:\s*("(?:[^"\\]|\\.)*"?|'(?:[^'\\]|\\.)*'?|[^,}]*)""")
_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")

_GLUED = re.compile(r"(\d)\s*[x*]\s*(?=[\d.,])", re.IGNORECASE)
_BARE_DOZEN = re.compile(rf"(?<![\d/][\s-])(?<!\d)(?<!half )(?<!of )\bdozen\b(?!\s+of\b)", re.IGNORECASE)

Reading = tuple[str, float, int, float]  # base unit, content of one in base units, packs, prior cost


def clean(text: str) -> str:
    """Entities resolved, compatibility forms folded (½ becomes 1/2), white space collapsed."""
    s = html.unescape(html.unescape(text)).replace("½", " 1/2").replace("¼", " 1/4").replace("¾", " 3/4")
    s = unicodedata.normalize("NFKC", s).replace("⁄", "/").replace("✕", "x").replace("×", "x")
    s = _GLUED.sub(r"\1 x ", s)
    s = _BARE_DOZEN.sub("1 dozen", s)
    return re.sub(r"\s+", " ", s).strip()


def size_cell(cell: str | None) -> str:
    """The stated size of a JSON-like cell, read by its key, so that a cell that is no JSON still counts."""
    if not cell or not cell.strip():
        return ""

    def part(pattern: re.Pattern[str]) -> str:
        m = pattern.search(cell)
        v = (m.group(1).strip() if m else "").strip("'\"")
        return "" if v in ("null", "None") else _ESCAPE.sub(lambda x: chr(int(x[1], 16)), v).replace("\\/", "/").replace("\\", "")

    if "size_user_friendly" in cell:
        v, uom = part(_SIZE_CELL), part(_UOM_CELL)
        return f"{v} {uom}".strip() if v else ""
    return "" if cell.lstrip()[:1] in "{[" or cell.strip() in ("null", "None") else cell


def _count(word: str) -> int:
    w = word.lower()
    return NUMBER_WORDS.get(w) or {"twin": 2, "double": 2, "triple": 3, "dozen": 12}.get(w) or int(w)


def _numbers(num: str, unit: str) -> list[tuple[float, int, float]]:
    """(value, packs, cost): every reading of a number as written before a unit."""
    n = num.lower().strip()
    if "half" in n:
        return [(0.5, 1, 0.0)]
    if "/" in n:
        m = re.fullmatch(r"(?:(\d+)[\s-]+)?(\d+)\s*/\s*(\d+)", n)
        whole, p, q = int(m[1] or 0), int(m[2]), int(m[3])
        if not q or not p:
            return [(float(q or p), 1, 0.0)]
        out = []
        proper = p < q <= 16 and math.gcd(p, q) == 1
        fine = unit in ("lb", "kg", "l", "pint", "quart", "gallon", "dozen", "dl", "cl")
        if whole or proper:
            out.append((whole + p / q, 1, 0.0 if whole or fine else 3.0))
        if not whole:
            out.append((float(q), p, 1.0 if proper else 0.0))
        return out
    if re.fullmatch(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?", n) and not n.startswith("0"):
        out = [(float(n.replace(",", "")), 1, 0.0)]
        return out + ([(float(n.replace(",", ".")), 1, 1.0)] if n.count(",") == 1 and "." not in n else [])
    return [(float(n.replace(",", ".")), 1, 0.0)]


@lru_cache(maxsize=50_000)
def readings(text: str) -> tuple[Reading, ...]:
    """Every reading of the net content a text states; empty if it states none."""
    s = clean(text)
    if not s:
        return ()
    bare = _STRENGTH.sub(lambda m: " " * len(m[0]), s)
    found: list[tuple[int, int, str, str, list[tuple[float, int, float]]]] = []
    for m in _QTY.finditer(bare):
        unit = next(u for u in UNIT_FACTORS if m.group(u))
        found.append((m.start(), m.end(), unit, UNIT_FACTORS[unit][0], _numbers(m["num"], unit)))
    merged: list[tuple[int, int, str, list[tuple[float, int, float]]]] = []
    i = 0
    while i < len(found):
        start, end, unit, base, nums = found[i]
        values = [(v * UNIT_FACTORS[unit][1], p, c) for v, p, c in nums]
        if i + 1 < len(found) and (unit, found[i + 1][2]) in {("lb", "oz"), ("kg", "g"), ("l", "ml"), ("pint", "floz"), ("quart", "floz"), ("gallon", "floz")} and _JOINED.fullmatch(bare[end : found[i + 1][0]]):
            add = found[i + 1][4][0][0] * UNIT_FACTORS[found[i + 1][2]][1]
            values, end, i = [(v + add, p, c) for v, p, c in values], found[i + 1][1], i + 1
        merged.append((start, end, base, values))
        i += 1
    spans: list[tuple[int, int]] = []
    direct: list[int] = []
    for k, (start, end, _base, _values) in enumerate(merged):
        before, after = bare[:start], bare[end:]
        pack = 0
        if m := _TIMES_BEFORE.search(before) or _SLASH_BEFORE.search(before) or _EACH_BEFORE.search(before):
            pack = _count(m[1])
            spans.append((m.start(), start))
        elif m := _TIMES_AFTER.search(after):
            pack = int(m[1])
            spans.append((end, end + m.end()))
        elif (m := _WORD_BEFORE.search(before)) and (n := _PACKS_AFTER.search(after)):
            pack = _count(m[1])
            spans += [(m.start(), start), (end, end + n.end())]
        direct.append(pack)
        spans.append((start, end))
    rest = list(bare)
    for a, b in spans:
        rest[a:b] = " " * (b - a)
    rest_s = "".join(rest)
    packs = [p for m in _PACK.finditer(rest_s) if (p := _count(m[1] or m[2])) > 0]
    holds = [_count(m[1]) for m in _HOLDS.finditer(rest_s)]
    outer = 1
    for p in dict.fromkeys(packs):
        outer *= p
    bulk = [k for k, x in enumerate(merged) if x[2] != "count"]
    if not merged and holds:
        return tuple(("count", float(h), outer, 0.0) for h in holds if h > 0)
    if not merged:
        return ()
    out: list[Reading] = []
    counts = [k for k in range(len(merged)) if merged[k][2] == "count"]
    for k in bulk or counts:
        for value, p, cost in merged[k][3]:
            if value <= 0:
                continue
            inner = max(1, direct[k]) * p
            total = inner * outer if not (outer > 1 and inner > 1 and outer == inner) else inner
            out.append((merged[k][2], value, total, cost + 0.01 * k))
            if bulk and counts and total == 1:
                n = merged[counts[0]][3][0][0]
                if n > 1:
                    out.append((merged[k][2], value, int(n), cost + 2.5))
    return tuple(out)


def _prior(r: Reading) -> float:
    """Cost of an unlikely container: the log distance of its content beyond a wide usual range."""
    low, high = {"g": (20, 12000), "ml": (20, 12000), "count": (1, 1500)}[r[0]]
    return 0.3 * (max(0.0, math.log(low / r[1])) + max(0.0, math.log(r[1] / high))) + r[3]


#: Weight of what is usual once a second statement of the record speaks.
PRIOR_WEIGHT = 0.1


def _residual(x: Reading, y: Reading, density: float = 1.0) -> float:
    """Least absolute log residual of the identities that may tie two readings; a mass meets a volume by the density."""
    if (x[0] == "count") != (y[0] == "count"):
        return 0.5
    a, b = (r[1] * (density if r[0] == "ml" and x[0] != y[0] else 1.0) for r in (x, y))
    ties = [(a, b), (a * x[2], b), (a, b * y[2]), (a * x[2], b * y[2])]
    return min(2.0, min(abs(math.log(p / q)) for p, q in ties))


def solve(own: tuple[Reading, ...], other: tuple[Reading, ...], tie: float = 0.05, density: float = 1.0) -> tuple[Reading, float, bool] | None:
    """The reading of ``own`` with the least cost against ``other``; its residual; whether it is the only one."""
    if not own:
        return None
    weight = PRIOR_WEIGHT if other else 1.0
    costs = []
    for x in own:
        best = min(((_residual(x, y, density) + weight * _prior(y), _residual(x, y, density)) for y in other), default=(0.0, 0.0))
        costs.append((best[0] + weight * _prior(x), best[1], x))
    costs.sort(key=lambda c: c[0])
    cost, residual, x = costs[0]
    rivals = [c for c in costs[1:] if c[0] - cost <= tie and (c[2][0], round(c[2][1] * c[2][2])) != (x[0], round(x[1] * x[2]))]
    return x, residual, not rivals


SOLUTION = "base_unit string, content double, packs int, base_amount bigint, residual double, is_unique boolean"


def half_up(x: float) -> int:
    return math.floor(x + 0.5 + 1e-9)


def quantity(own: Column, other: Column, density: Column | None = None) -> Column:
    """Struct of the amount that ``own`` states, ``other`` being a second statement of the same record.

    ``density``: g/ml of what the record describes, 1 where null. Null, empty and unit-less texts give null. Amounts are packs times content of one, in g, ml or pieces.
    """

    @F.pandas_udf(SOLUTION)
    def udf(a: pd.Series, b: pd.Series, d: pd.Series) -> pd.DataFrame:
        rows = []
        for x, y, g in zip(a, b, d, strict=True):
            got = solve(readings(x), readings(y) if y else (), density=g if g and g > 0 else 1.0) if x else None
            if got is None:
                rows.append((None,) * 6)
            else:
                (base, content, packs, _), residual, only = got
                rows.append((base, content, packs, half_up(content * packs), residual, only))
        out = pd.DataFrame(rows, columns=["base_unit", "content", "packs", "base_amount", "residual", "is_unique"])
        return plain(out.astype({"packs": "Int32", "base_amount": "Int64", "is_unique": "boolean"}))

    return udf(own, other, F.lit(1.0) if density is None else density)


#: Texts that may state a mass or a volume; only these are read for the densities.
_MASS, _VOLUME = (r"(?i)\d[\s-]*(?:" + "|".join(UNIT_SPELLINGS[u] for u, (b, _) in UNIT_FACTORS.items() if b == base) + ")" for base in ("g", "ml"))


def densities(df: DataFrame, own: str, other: str, group: str, least: int = 5) -> DataFrame:
    """(group, density): g/ml of each group with ``least`` records that state a mass and a volume, each in one reading.

    Groups with fewer, and null, have no row.
    """

    @F.pandas_udf("double")
    def log_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            sides = {r[0]: r[1] * r[2] for t in (x, y) for r in readings(t)} if len(readings(x)) == 1 == len(readings(y)) else {}
            out.append(math.log(sides["g"] / sides["ml"]) if set(sides) == {"g", "ml"} else None)
        return pd.Series(out, dtype="float64")

    x, y = F.col(own), F.col(other)
    both = df.where((x.rlike(_MASS) & y.rlike(_VOLUME)) | (x.rlike(_VOLUME) & y.rlike(_MASS))).where(F.col(group).isNotNull())
    ratios = both.select(F.col(group).alias("group"), log_ratio(x, y).alias("r")).where("r is not null and not isnan(r)")
    return ratios.groupBy("group").agg(F.exp(F.percentile_approx("r", 0.5)).alias("density"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("group", "density")


def size_text(cell: Column) -> Column:
    """The stated size of a JSON-like cell as text ('' if none)."""

    @F.pandas_udf("string")
    def udf(cells: pd.Series) -> pd.Series:
        return cells.map(size_cell).astype(object)

    return udf(cell)


def with_quantity(df: DataFrame, own: str, other: str, out: str = "q", group: str | None = None) -> DataFrame:
    """Add the struct column ``out``; a clashing column of that name is replaced.

    ``group``: a column whose values share a density, solved from the records themselves. The densities are sent to the
    workers up to 200,000 groups and joined by shuffle beyond.
    """
    if group is None:
        return df.withColumn(out, quantity(F.col(own), F.col(other)))
    known = densities(df, own, other, group).select(F.col("group").alias("__group"), F.col("density").alias("__density"))
    rows = known.limit(200_001).collect()
    known = df.sparkSession.createDataFrame(rows, known.schema) if len(rows) <= 200_000 else known
    joined = df.join(F.broadcast(known) if len(rows) <= 200_000 else known, F.col(group) == F.col("__group"), "left")
    return joined.withColumn(out, quantity(F.col(own), F.col(other), F.col("__density"))).drop("__group", "__density")
