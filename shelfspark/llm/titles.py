r"""Titles of listings as canonical tokens.

A title is folded, its quantities are cut out, usual shortenings are written out, phrases that mean the same get
one token, remarks are dropped. What remains, in order, are the words that name a product or advertise it.
"""

from __future__ import annotations

import html
import json
import re

from shelfspark.llm.canonical import COMPANY_WORDS, fold
from shelfspark.operators import quantities

# Usual shortenings in retail titles.
SHORTENINGS = {
    "bbq": "barbecue", "bf": "beef", "bttr": "butter", "cffe": "coffee", "chkn": "chicken", "choc": "chocolate", "chs": "cheese",
    "ckies": "cookies", "cookie": "cookies", "fms": "farms", "frag": "fragrance", "frzn": "frozen", "grk": "greek", "jce": "juice",
    "ktchn": "kitchen", "liq": "liquid", "nats": "naturals", "nat": "natural", "org": "organic", "orgnc": "organic", "orig": "original",
    "pdr": "powder", "prov": "provisions", "pwdr": "powder", "rdcd": "reduced", "sce": "sauce", "shrd": "shredded", "shrdd": "shredded",
    "slcd": "sliced", "spklg": "sparkling", "sprkl": "sparkling", "strwb": "strawberry", "blubry": "blueberry", "unsc": "unscented",
    "van": "vanilla", "veg": "veggie", "whl": "whole", "wht": "white", "ygt": "yogurt", "yoghurt": "yogurt", "yogourt": "yogurt",
    "dtrgnt": "detergent", "garbanzos": "chickpeas", "garbanzo": "chickpeas", "flavour": "flavor", "flavoured": "flavored", "gf": "gluten free", "sf": "sugar free", "lf": "low fat",
}
# Phrases of one meaning (longest first when applied).
SAME_MEANING = {
    "free from gluten": "gluten-free", "gluten free": "gluten-free", "without gluten": "gluten-free", "no gluten": "gluten-free",
    "sugar free": "sugar-free", "no sugar": "sugar-free", "free from sugar": "sugar-free", "without sugar": "sugar-free", "zero sugar": "sugar-free",
    "low sodium": "low-sodium", "lower sodium": "low-sodium", "less sodium": "low-sodium", "reduced sodium": "low-sodium",
    "reduced fat": "reduced-fat", "less fat": "reduced-fat", "lower fat": "reduced-fat",
    "organically grown": "organic", "fragrance free": "unscented", "free from fragrance": "unscented", "scent free": "unscented",
}
_REMARKS = re.compile(
    r"contains \d+ or less of [a-z]+|ships in \d+ days?|rated \d+(?: \d+)? stars?|\d+ satisfaction|\d+ cotton|\bsku \d+|\bspf \d+|\bsize (?:xxl|xl|xs|s|m|l)\b"
    r"|\b\d+(?: \d+)?(?: ?x ?\d+(?: \d+)?)? ?(?:inch(?:es)?|in|ft|feet|cm|mm|w|watts?|days?|mg|mcg|iu)\b"
)
_REMARKS_RAW = re.compile(r"\d+(?:\.\d+)?\s*['\"″′](?:\s*x\s*\d+(?:\.\d+)?\s*['\"″′])?|\d+\s*%\s*(?:cotton|satisfaction)|rated\s+\d[\d.]*\s*stars?|contains\s+\d+\s*%[^,|]*", re.IGNORECASE)
_SAME = re.compile(r"\b(?:" + "|".join(sorted(SAME_MEANING, key=len, reverse=True)) + r")\b")
DROPPED = COMPANY_WORDS | frozenset("with or of in a an x each scent flavor flavored total packs pack pk amp quot size style frozen net wt approx".split())


def strip_quantities(text: str) -> str:
    """The title without its amounts, packs and strengths."""
    s = quantities.clean(text)
    s = _REMARKS_RAW.sub(" ", s)
    s = quantities._STRENGTH.sub(" ", s)
    s = re.sub(r"(?<![\w.,/])\d{1,4}\s*[x×/]\s*(?=\d|half|one|dozen)", " ", s, flags=re.IGNORECASE)
    s = re.sub(r"(?<![\w.,/])\d{1,4}\s*(?:ea|each)\s*-\s*(?=\d)", " ", s, flags=re.IGNORECASE)
    s = quantities._QTY.sub(" , ", s)
    s = quantities._PACK.sub(" , ", s)
    s = quantities._HOLDS.sub(lambda m: " , ", s)
    return re.sub(rf"\b(?:{'|'.join(quantities.NUMBER_WORDS)})\s*,\s*packs?\b", " ", s, flags=re.IGNORECASE)


def words(title: str) -> list[str]:
    """Folded words of a title without quantities, shortenings written out, in order."""
    return " ".join(SHORTENINGS.get(w, w) for w in fold(strip_quantities(title)).split()).split()


def canonical(ws: list[str]) -> list[str]:
    """Words as canonical tokens, in order: remarks dropped, one token per meaning."""
    s = _REMARKS.sub(" ", " ".join(ws))
    s = _SAME.sub(lambda m: SAME_MEANING[m[0]], s)
    return [w for w in s.split() if w not in DROPPED and not any(c.isdigit() for c in w) and len(w) > 1]


def tokens(title: str) -> list[str]:
    return canonical(words(title))


def attributes(item_info: str | None) -> tuple[list[str], str | None]:
    """Variety, form and diet that a JSON cell states, and its category path (null for none)."""
    got = None
    if item_info:
        try:
            got = json.loads(item_info)
        except ValueError:
            try:
                got = json.loads(item_info.replace("'", '"'))
            except ValueError:
                got = None
    if not isinstance(got, dict):
        return [], None
    out: list[str] = []
    for k in ("flavor", "color", "form", "storage_type"):
        if isinstance(got.get(k), str):
            out += tokens(html.unescape(got[k]))
    if str(got.get("is_organic")).lower() in ("true", "1", "yes"):
        out.append("organic")
    path = [str(got[k]).strip().lower() for k in ("category_0", "category_1", "category_2") if isinstance(got.get(k), str)]
    return out, "/".join(path) or None
