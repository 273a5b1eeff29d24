"""Operators of the llm subpackage against brute force, round trips and held-out accuracy, with the awkward inputs."""

import math
import random
import re
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.llm import canonical, distinctive, languages, leaks, matching, packing, products, queries, titles

# --- distinctive terms ---------------------------------------------------------------------------------------


def test_residuals_against_brute_force(spark):
    rng = random.Random(1)
    texts = {i: " ".join(rng.choice(["plum", "jam's", "ÉTÉ's", "oats", "berry", "tea"]) for _ in range(rng.randrange(9))) for i in range(50)}
    texts |= {50: None, 51: "", 52: "word " * 5000, 53: texts[0]}
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "k bigint, t string, term string")
    counts = {k: Counter(w for w in re.findall(r"[^\W\d_]+", (t or "").lower()) if len(w) >= 4) for k, t in texts.items()}
    n = sum(sum(c.values()) for c in counts.values())
    margin = Counter()
    for c in counts.values():
        margin.update(c)
    got = {(r["key"], r["term"]): r for r in distinctive.residuals(df, "k", "t").collect()}
    assert set(got) == {(k, w) for k, c in counts.items() for w in c}
    for (k, w), r in got.items():
        e = sum(counts[k].values()) * margin[w] / n
        want = (counts[k][w] - e) / math.sqrt(e * (1 - sum(counts[k].values()) / n) * (1 - margin[w] / n))
        assert r["residual"] == pytest.approx(want) and r["n_records"] == sum(w in c for c in counts.values())
    hot = {(r["key"], r["term"]): r["residual"] for r in distinctive.residuals(df, "k", "t", hot_share=1.0).collect()}
    assert hot == pytest.approx({k: r["residual"] for k, r in got.items()})
    assert distinctive.residuals(df.limit(0), "k", "t").count() == 0


def test_residual_decides_the_rare_terms(spark):
    """Against counting records; a long record is counted by a grouped sum with the same residuals."""
    rng = random.Random(2)
    texts = {i: " ".join(rng.choice(["plum", "jams", "oats", "berry", f"word{'abcdefghijklmnop'[rng.randrange(16)] * 4}"]) for _ in range(rng.randrange(9))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "k bigint, t string")
    held = Counter(w for t in texts.values() for w in set(re.findall(r"[a-z]{4,}", t)))
    got = {(r["key"], r["term"]): r["residual"] for r in distinctive.rare_terms(df, "k", "t").collect()}
    assert set(got) == {(k, w) for k, t in texts.items() for w in set(re.findall(r"[a-z]{4,}", t)) if held[w] <= 3} and min(got.values()) > 0
    longer = distinctive.term_counts(df, "k", "t", long=2)
    assert sorted(map(tuple, longer.collect())) == sorted(map(tuple, distinctive.term_counts(df, "k", "t").collect()))


def test_single_term_collection_has_no_residual(spark):
    df = spark.createDataFrame([(1, "plum plum")], "k bigint, t string")
    assert distinctive.residuals(df, "k", "t").first()["residual"] is None


# --- canonical list ------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("a", "b", "want"), [("abcd", "abdc", 1), ("abc", "abc", 0), ("", "ab", 2), ("plum", "plumm", 1), ("kitten", "sitting", 3)])
def test_swap_distance(a, b, want):
    assert canonical.swap_distance(a, b) == want == canonical.swap_distance(b, a)


def test_near_words_against_brute_force(spark):
    """No pair within the allowed edits is missed, however long the words, and no abbreviation."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(2, 16))) for _ in range(150)]

    def slip(w):
        w = list(w)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(w))
            w[i : i + rng.randrange(3)] = rng.choice(["", "a", "b"])
            w = w or ["a"]
        return "".join(w)

    tokens = sorted({slip(w) for w in words * 2} | {w[0] + w[-1] for w in words})
    got = {(r["token"], r["word"]) for r in canonical.repair_tokens(spark.createDataFrame([(t,) for t in tokens], "token string"), spark.createDataFrame([(w,) for w in words], "word string")).collect()}

    def short(t, w):
        it = iter(w)
        return 2 <= len(t) < len(w) and t[0] == w[0] and all(c in it for c in t)

    want = {(t, w) for t in tokens for w in words if canonical.swap_distance(t, w) <= canonical.edits_allowed(min(len(t), len(w))) or short(t, w)}
    assert got == want


def test_fold():
    assert canonical.fold("Crème-Brûlée™") == "creme brulee"
    assert canonical.fold("GоldenFarms") == "golden farms"  # a Cyrillic letter
    assert canonical.tokens_of("Brand: Acme Foods, Inc.")[0] == ["acme", "foods"]


def test_map_to_list(spark):
    names = ["Halverton Farms", "Halverton Mill", "Quillmark", "Old Brindle & Co", "Café Dunmore", "Halverton Farms"]
    listed = spark.createDataFrame([(i, n) for i, n in enumerate(names[:5], start=1)], "brand_id bigint, brand_name string")
    typed = {
        "HALVERTON FARMS": 1, "Halvetron Farms": 1, "Farms, Halverton": 1, "Halverton Fms": 1, "HalvertonMill": 2, "Quil1mark": 3, "from Quillmark LLC": 3, "brindle old": 4,
        "Cafe Dunmore (R)": 5, "n/a": None, "Zzyzx Works": None, "no brand": None,
    }
    df = spark.createDataFrame([(t, 7) for t in [*typed, *typed, None, " "]], "raw string, entry_id int")
    got = {r["value"]: r["entry_id"] for r in canonical.map_to_list(df, "raw", listed, "brand_id", "brand_name").collect()}
    assert got == typed
    assert canonical.map_to_list(df.limit(0), "raw", listed, "brand_id", "brand_name").count() == 0
    assert {r["entry_id"] for r in canonical.map_to_list(df, "raw", listed.limit(0), "brand_id", "brand_name").collect()} == {None}


# --- titles and products -------------------------------------------------------------------------------------


@pytest.mark.parametrize(("title", "want"), [
    ("(8 pack) Mirlow Lower Sodium Mint Cola, 500 mL", ["mirlow", "low-sodium", "mint", "cola"]), ("GF Oat Bar Best Value | Ships in 2 days", ["gluten-free", "oat", "bar", "best", "value"]),
    ("Rug 5' x 7', Contains 2% or less of spices", ["rug"]), ("Four 6 oz Packs Org Tea", ["organic", "tea"]), ("", []), ("12", []),
])
def test_tokens(title, want):
    assert titles.tokens(title) == want


LISTING = "row_ord bigint, name string, brand_raw string, sizing_comp string, item_info string, product string"


def listings(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], LISTING)


@pytest.fixture
def brands(spark):
    return spark.createDataFrame([(1, "Acme"), (2, "Zeta Farms")], "brand_id bigint, brand_name string")


A_ROWS = [
    (1, "Acme Plumly Mint Cola, 500 ml", None, None, None), (2, "acme mint plumly COLA 16.9 fl oz", "Acme", None, '{"flavor":"Mint"}'), (3, "Acme Plumly Mint Cola, 500 ml, 6 Pack", None, None, None),
    (4, "Plumly Cola, Best Value", "Acme Inc.", '{"size_user_friendly":"500 ml"}', '{"flavor":"mint"}'), (5, "Acme Plumly Lime Cola, 500 ml", None, None, None), (6, None, None, None, None), (7, "", "", "", ""),
    (8, "Zeta Farms Oat Bar 5 oz", None, None, None), (9, "Zeta Farms Oat Bar 5 oz", None, None, None), (10, "Acme Plumly Mint Cola, 750 ml", None, None, None),
]
B_ROWS = [(21, "Acme Plumly Cola, Mint", None, "{'size_user_friendly': '1/2 l'}", None), (22, "Zeta Farms Oat Bar", "Zeta Farms", '{"size_user_friendly":"142 g"}', None), (23, "Zeta Farms Rye Bar", None, '{"size_user_friendly":"5 oz"}', None)]


@pytest.mark.parametrize("most", [canonical.MOST_SENT, 0])
def test_products_and_matches(spark, brands, monkeypatch, most):
    monkeypatch.setattr(canonical, "MOST_SENT", most)  # beyond the bound the same by shuffle
    plain = [(100 + i, f"Acme {line} Mint Cola, 500 ml", None, None, None) for i, line in enumerate(["Brimly", "Dornly", "Quilly", "Fendly"])]
    loud = [(200 + i, f"Zeta Farms {x} Oat Bar 7 oz{ad}", None, None, None) for i, (x, ad) in enumerate([("Brimly", ""), ("Brimly", ", Best Value"), ("Dornly", ""), ("Dornly", " Best Value")])]
    more = [(300, "Dornly Cola, Best Value", "Acme", None, '{"flavor":"mint"}'), (301, "Oddly Tea, Best Value 1 kg", "Third Mill", None, None), (302, "Oddly Tea 1 kg", "Third Mill", None, None), (303, "Oddly Tea 1 kg", "Third Mill", None, None)]
    both = products.catalogue(listings(spark, A_ROWS), listings(spark, B_ROWS)).unionByName(products.catalogue(listings(spark, [*plain, *loud, *more]), listings(spark, [])))
    forms = products.readings(products.forms(both, brands))
    ids = products.product_ids(forms)
    groups = {}
    for r in ids.collect():
        groups.setdefault(r["product"], set()).add(r["row_ord"])
    assert sorted(map(sorted, (g for g in groups.values() if len(g) > 1))) == [[1, 2, 4, 21], [8, 9, 22], [200, 201], [202, 203], [301, 302, 303]]
    pairs = {(r["row_lo"], r["row_hi"]) for r in products.pairs_within(ids).collect()}
    assert len(pairs) == 6 + 3 + 1 + 1 + 3 and all(a < b for a, b in pairs)
    assert {(r["row_lo"], r["row_hi"]) for r in products.pairs_within(ids, salts=2).collect()} == pairs
    assert {r["row_ord"]: r["n_links"] for r in ids.collect() if r["n_links"]} == {x: len(g) - 1 for g in groups.values() if len(g) > 1 for x in g}
    got = {(r["row_lo"], r["row_hi"]): r["confidence"] for r in matching.match(forms).collect()}
    assert set(got) == {(1, 21), (2, 21), (4, 21), (8, 22), (9, 22)} and all(0.5 <= p <= 1 for p in got.values())


def test_many_copies_and_long_titles(spark, brands):
    rows = [(i, "Acme Plumly Mint Cola, 500 ml", None, None, None) for i in range(1, 60)] + [(100, "word " + " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)), None, None, None), (101, "x" * 5000, None, None, None)]
    ids = products.product_ids(products.readings(products.forms(products.catalogue(listings(spark, rows), listings(spark, [])), brands))).collect()
    assert {r["row_ord"]: r["product"] for r in ids} == {**{i: 1 for i in range(1, 60)}, 100: 100, 101: 101}


def test_empty_catalogues(spark, brands):
    none = listings(spark, []).limit(0)
    forms = products.readings(products.forms(products.catalogue(none, none), brands))
    assert products.product_ids(forms).count() == 0 and matching.match(forms).count() == 0


def test_word_repairs(spark):
    words = ["organic"] * 200 + ["orgnaic", "organci", "orgaic", "plum", "tea"] + ["oatmeal"] * 12 + ["oatmael"] + ["oatmea1"]
    got = {r["word"]: r["better"] for r in products.word_repairs(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {"orgnaic": "organic", "organci": "organic", "orgaic": "organic", "oatmael": "oatmeal", "oatmea1": "oatmeal"}


ROW = "row_ord bigint, source string, base string, content double, packs int, brand string, tokens array<string>, level string"


def test_best_combination_against_brute_force(spark):
    rng = random.Random(3)
    toks = [rng.sample("pqrstuvw", rng.randrange(1, 6)) for _ in range(60)]
    rows = spark.createDataFrame([(i, "A", None, None, 1, "b" if i % 2 else None, t, None) for i, t in enumerate([*toks, *toks[:9], [f"t{i}" for i in range(80)]])], ROW)
    forms = products.ballots(rows)
    got = {r["fid"]: r for r in products.elect(products.votes(forms)).collect()}
    held, freq, places = forms.collect(), Counter(), Counter()
    from itertools import combinations

    options = {}
    for r in held:
        n = len(r["tokens"])
        options[r["fid"]] = {p for k in (2, 3) for p in combinations(range(n), min(k, n))}
        for p in options[r["fid"]]:
            key = (r["brand"], frozenset(r["tokens"][i] for i in p))
            freq[key] += r["n"]
            places[key] += r["n"] * sum(p) / len(p)
    for r in held:
        def score(p, r=r):
            key = (r["brand"], frozenset(r["tokens"][i] for i in p))
            return math.log1p(freq[key]) * len(p) ** 2 / (1 + places[key] / freq[key])

        own = tuple(i for i in range(60) if got[r["fid"]]["mask"] >> i & 1)
        assert own in options[r["fid"]] and score(own) == pytest.approx(max(map(score, options[r["fid"]])), abs=1e-4)
    assert max(len(r["tokens"]) for r in held) == 60


def catalogue_of(spark, rows):
    return spark.createDataFrame([(i, s, "g" if c else None, c, 1, b, t.split(), None) for i, s, b, t, c in rows], ROW)


def groups_of(ids):
    out = {}
    for r in ids.collect():
        out.setdefault(r["product"], set()).add(r["row_ord"])
    return sorted(sorted(g) for g in out.values() if len(g) > 1)


def test_votes_decide_the_products(spark, monkeypatch):
    """Planted: advertising that only clusters reveal, a slip that a cluster vouches for, and two lines that look like slips."""
    lines = ["aldbrook", "benfield", "corwick"]
    rows, n = [], 0
    for b in "xyz":
        for line in lines:
            for text in (f"{line} plum jam", f"{line} plum jam now even better"):
                n += 1
                rows.append((n, "A", b, text, 100.0))
    rows += [(100 + i, "A", "x", "denmoor hand soap lavender", 50.0) for i in range(5)] + [(110, "A", "x", "denmoor hand soap lavnedr", 50.0)]
    rows += [(120 + i, "A", "x", "froapkl oat bar", 70.0) for i in range(4)] + [(130, "A", "x", "froavkn oat bar", 70.0)]
    want = [[k, k + 1] for k in range(1, 19, 2)] + [[100, 101, 102, 103, 104, 110], [120, 121, 122, 123]]
    df = catalogue_of(spark, rows)
    assert groups_of(products.product_ids(products.readings(df))) == want
    monkeypatch.setattr(products, "elect", lambda cast: cast.groupBy("fid").agg(F.max("mask").alias("mask")).select("fid", F.col("fid").alias("cid"), "mask"))
    apart = groups_of(products.product_ids(products.readings(df)))  # every form a cluster of its own
    assert [1, 2] not in apart and [100, 101, 102, 103, 104] in apart
    monkeypatch.setattr(products, "elect", lambda cast: cast.groupBy("fid").agg(F.max("mask").alias("mask")).select("fid", F.lit(0).cast("bigint").alias("cid"), "mask"))
    one = groups_of(products.product_ids(products.readings(df)))  # one cluster for all
    assert [120, 121, 122, 123, 130] in one


def test_messages_decide_the_matches(spark, monkeypatch):
    """Planted rivals: a row without a content beside the row that has it, and one that could be either of two."""
    rows = [(1, "A", "x", "aldbrook plum jam", 100.0), (2, "A", "x", "aldbrook plum jam", None), (11, "B", "x", "aldbrook plum jam", 100.0),
            (3, "A", "x", "benfield oat bar", None), (12, "B", "x", "benfield oat bar", 100.0), (13, "B", "x", "benfield oat bar", 200.0),
            (4, "A", "x", "corwick rye bar", None), (14, "B", "x", "corwick rye bar", 200.0)]
    rows += [(50 + i, "A", "y", f"other thing {'abcdefghij'[i]}{'abcdefghij'[i]}{'abcdefghij'[i]}", 10.0 + i) for i in range(10)]
    read = products.readings(catalogue_of(spark, rows))
    assert {(r["row_lo"], r["row_hi"]) for r in matching.match(read).collect()} == {(1, 11), (4, 14)}
    monkeypatch.setattr(matching, "propagate", lambda pairs: pairs.withColumn("p", F.col("w") / (1 + F.col("w"))))
    without = {(r["row_lo"], r["row_hi"]) for r in matching.match(read).collect()}
    assert {(2, 11), (3, 12), (3, 13)} <= without


def test_an_added_rare_word_and_an_unknown_content_can_match(spark):
    """A common added word names a variety; a rare one beside a rare line word does not, nor does a content that one side lacks."""
    many = [(100 + i, "A", "b", ["common", "mint", "".join(chr(97 + i // 26**k % 26) for k in range(4))], "g", 90.0, 1, None) for i in range(2000)]
    pairs = [("quill", ["quill"], ["quill", "zesty"], 5.0, 5.0), ("brim", ["brim"], ["brim", "mint"], 6.0, 6.0), ("dorn", ["dorn"], ["dorn"], None, 7.0), ("ferd", ["ferd"], ["ferd", "organic"], 8.0, 8.0)]
    rows = [(10 * k + j, "AB"[j], "b", [*toks, "common"], "g" if c else None, c, 1, None) for k, (_, x, y, cx, cy) in enumerate(pairs, start=1) for j, (toks, c) in enumerate([(x, cx), (y, cy)])]
    df = spark.createDataFrame([*many, *rows], "row_ord bigint, source string, brand string, tokens array<string>, base string, content double, packs int, level string")
    assert {(r["row_lo"], r["row_hi"]) for r in matching.match(products.readings(df)).collect()} == {(10, 11), (30, 31)}


def test_learnt_odds_follow_the_counts():
    n = len(matching.LEVELS)
    equal, common = (0,) * n, (0, 2, 0, 0, 0)
    few, many = matching.learn([(equal, 100), (common, 10)]), matching.learn([(equal, 5000), (common, 10)])
    assert few[equal] > 1 > few[common] and many[common] < few[common]
    assert matching.learn([]) == {}


def test_messages_that_do_not_settle_are_an_error(spark):
    df = spark.createDataFrame([(i, j, 20.0) for i in range(4) for j in range(4)], "a int, b int, w double")
    with pytest.raises(ValueError, match="still move"):
        matching.propagate(df, tolerance=1e-12, most_rounds=3)
    assert matching.propagate(df).count() == 16


def test_marginals_against_enumeration(spark):
    """Loopy propagation on a tree is exact: compare with all matchings of a small one."""
    w = {("a", "x"): 3.0, ("a", "y"): 1.0, ("b", "y"): 2.0}
    total, of = 0.0, Counter()
    for bits in range(8):
        chosen = [e for k, e in enumerate(w) if bits >> k & 1]
        if len({a for a, _ in chosen}) == len(chosen) == len({b for _, b in chosen}):
            weight = math.prod(w[e] for e in chosen)
            total += weight
            for e in chosen:
                of[e] += weight
    df = spark.createDataFrame([(a, b, x) for (a, b), x in w.items()], "a string, b string, w double")
    got = {(r["a"], r["b"]): r["p"] for r in matching.propagate(df, tolerance=1e-9).collect()}
    assert got == pytest.approx({e: of[e] / total for e in w}, abs=1e-6)


def bound_words(n, seed=0):
    return ["".join(chr(97 + (i + seed) // 26**k % 26) for k in range(3)) + "word" for i in range(n)]


def best_by_brute_force(forms, barred=()):
    """The best score of each form over all combinations of its tokens, without the barred places."""
    from itertools import combinations

    freq, places = Counter(), Counter()
    for r in forms:
        for k in (2, 3):
            for p in combinations(range(len(r["tokens"])), k):
                key = (r["brand"], frozenset(r["tokens"][i] for i in p))
                freq[key] += r["n"]
                places[key] += r["n"] * sum(p) / k
    out = {}
    for r in forms:
        left = [i for i in range(len(r["tokens"])) if i not in dict(barred).get(r["fid"], ())]
        scores = {}
        for k in (2, 3):
            for p in combinations(left, k):
                key = (r["brand"], frozenset(r["tokens"][i] for i in p))
                scores[p] = math.log1p(freq[key]) * k * k / (1 + places[key] / freq[key])
        out[r["fid"]] = scores
    return out


def test_long_titles_vote_with_all_their_tokens(spark):
    """The best combination of titles beyond 63 tokens, those shared with short and with long ones and those of one title alone."""
    rng = random.Random(5)
    words = bound_words(90)
    late = ["startone", "starttwo", "startthree"]  # at the end of a long title, at the start of many short ones
    toks = [[*words[:66], *late], [*words[3:70], "lone"], rng.sample(words, 70), rng.sample(words, 64), words[20:82]]
    short = [[*late, f"tail{c}"] for c in "abcdefgh"] + [rng.sample(words, 6) for _ in range(10)]
    rows = [("b" if i % 3 else None, t) for i, t in enumerate([*toks, *toks[:2], *short, *short])]
    forms = products.distinct_forms(spark.createDataFrame([(i, "A", None, None, 1, b, t, None) for i, (b, t) in enumerate(rows)], ROW))
    held = [r for r in forms.collect() if len(r["tokens"]) >= 2]
    assert max(len(r["tokens"]) for r in held) == 70
    long = [r["fid"] for r in held if len(r["tokens"]) > products.ALL_PROPOSED]
    barred = {f: [0, 1, 2, 5] for f in long[::2]}
    for places in ({}, barred):
        given = spark.createDataFrame(list(places.items()), "fid bigint, ad array<int>") if places else None
        cast = products.votes(forms, barred=given)
        at = F.transform("tokens", lambda t, i: products._holds("mask", i))
        if given is not None:
            cast = cast.join(given, "fid", "left").where(F.col("ad").isNull() | ~F.exists("ad", lambda i: products._holds("mask", i)))
        got = {r["fid"]: tuple(i for i, x in enumerate(r["own"]) if x) for r in products.elect(cast).join(forms, "fid").select("fid", at.alias("own")).collect()}
        scores = best_by_brute_force(held, places.items())
        assert set(got) == set(scores)
        for f, p in got.items():
            assert scores[f][p] == pytest.approx(max(scores[f].values()), abs=1e-5)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_promising_against_brute_force(k):
    from itertools import combinations

    rng = random.Random(k)
    for _ in range(40):
        m = rng.randrange(k, 12)
        f, lo = [rng.randrange(1, 40) for _ in range(m)], sorted(rng.randrange(0, 30) for _ in range(m))
        bound = {c: math.log1p(min(f[j] for j in c)) * k * k / (1 + sum(lo[j] for j in c) / k) for c in combinations(range(m), k)}
        least = rng.choice(sorted(bound.values())) - 1e-9
        assert set(products.promising(f, lo, k, least)) == {c for c, x in bound.items() if x >= least}


def test_words_beyond_the_sixtieth_and_long_advertising_decide_matches(spark):
    """Long titles that differ only in late rare words are no partners; advertising is left out of titles and in runs of any length."""
    line, loud = bound_words(64), "now even better than it ever was before"
    rows = [(1, "A", "x", " ".join([*line, "aldbrook", "benfield"]), 100.0), (11, "B", "x", " ".join([*line, "corwick", "denmoor"]), 100.0)]
    for i, b in enumerate("pqrs"):
        long = bound_words(63, 2000 + 100 * i)
        rows += [(20 + i, "A", b, " ".join(long), 50.0), (30 + i, "B", b, " ".join([*long, *loud.split()]), 50.0)]
        rows += [(40 + i, "A", b, f"oat bar {'abcd'[i] * 5}", 70.0), (50 + i, "B", b, f"oat bar {'abcd'[i] * 5} {loud}", 70.0)]
    got = {(r["row_lo"], r["row_hi"]) for r in matching.match(products.readings(catalogue_of(spark, rows))).collect()}
    assert got == {(20 + i, 30 + i) for i in range(4)} | {(40 + i, 50 + i) for i in range(4)}


# --- packing -------------------------------------------------------------------------------------------------


def test_fullest_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        counts = {rng.randrange(1, 15): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(1, 40)
        items = [k for k, n in counts.items() for _ in range(n)]
        best = max(sum(c) for n in range(len(items) + 1) for c in combinations_with_replacement(sorted(counts), n) if sum(c) <= room and all(c.count(k) <= counts[k] for k in counts))
        use = packing.fullest(counts, room)
        assert sum(k * n for k, n in use.items()) == best and all(n <= counts[k] for k, n in use.items())


def test_plan_uses_every_item_once():
    rng = random.Random(3)
    counts = Counter(min(100, int(rng.expovariate(1 / 20)) + 1) for _ in range(5000))
    used = Counter()
    bins = 0
    for times, use in packing.plan(counts, 100):
        assert sum(k * n for k, n in use.items()) <= 100
        bins += times
        for k, n in use.items():
            used[k] += n * times
    assert used == counts and bins <= math.ceil(sum(k * n for k, n in counts.items()) / 100) + 1
    with pytest.raises(ValueError):
        packing.plan({101: 1}, 100)
    assert packing.plan({}, 5) == []


def test_pack(spark):
    rows = [(i, n, 0) for i, n in enumerate([0, 5, 5, 5, 3, 7, 25, 10, None, 1] + [4] * 40)]
    df = spark.createDataFrame(rows, "key bigint, n_tokens bigint, n int")
    got = packing.pack(df, [(1, 10), (2, 1000)], salts=3).collect()
    for b, cap in ((1, 10), (2, 1000)):
        mine = [r for r in got if r["budget_id"] == b]
        fill = Counter()
        for r in mine:
            fill[r["container_id"]] += r["n_tokens"]
        assert max(fill.values()) <= cap and {r["key"] for r in mine} == {r[0] for r in rows}
        by = Counter()
        for r in mine:
            by[r["key"]] += r["n_tokens"]
        assert all(by[k] == (n or 0) for k, n, _ in rows)
        assert {r["key"] for r in mine if r["piece_no"] > 1} == ({6} if cap == 10 else set())
        assert len(fill) - 1 == (26 if cap == 10 else 1)  # the least possible: two fours leave room for nothing but the one
    assert packing.pack(df.limit(0), [(1, 10)]).count() == 0
    with pytest.raises(ValueError):
        packing.pack(df, [(1, 0)])


def test_token_counts(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.TOKENIZER)
    texts = ["plum jam", "", None, "<|endoftext|> " * 3, "word " * 30000]
    df = spark.createDataFrame(list(enumerate(texts)), "k bigint, t string")
    got = {r["key"]: r["n_tokens"] for r in packing.token_counts(df, "k", "t", queries.TOKENIZER).collect()}
    assert got[0] == len(t.encode("plum jam").ids) and got[1] == got[2] == 0 and got[3] > 3 and got[4] >= 30000


# --- leaks ---------------------------------------------------------------------------------------------------


def make_text(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n))


@pytest.mark.parametrize("most", [leaks.MOST_HASHES, 0])
def test_leaks(spark, monkeypatch, most):
    monkeypatch.setattr(leaks, "MOST_HASHES", most)
    rng = random.Random(6)
    items = {i: make_text(rng, 60) for i in range(5)}
    filler = lambda: make_text(rng, 80)
    w = items[1].split()
    edited = " ".join(x for i, x in enumerate(w) if i % 12 != 5)
    docs = {
        1: f"{filler()} {items[0].upper().replace(' ', ' <b>', 3)} {filler()}", 2: f"{filler()} {edited} {filler()}", 3: f"{filler()} {' '.join(w[:12])} {filler()}",
        4: f"{' '.join(w[:18])} {filler()} {' '.join(w[40:])} {filler()}", 5: filler(), 6: None, 7: "", 8: f"{items[2]} {items[3]}", 9: filler() * 300 + items[4],
    }
    got = leaks.find_leaks(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame([*items.items(), (8, None), (9, "")], "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 0), (2, 1), (4, 1), (8, 2), (8, 3), (9, 4)}


@pytest.mark.parametrize("most", [leaks.MOST_HASHES, 0])
def test_leaks_in_any_script_and_of_any_length(spark, monkeypatch, most):
    monkeypatch.setattr(leaks, "MOST_HASHES", most)
    rng = random.Random(8)
    items = {1: "Съешь же ещё этих мягких французских булок да выпей чаю сейчас", 2: "春眠不覚暁処処聞啼鳥夜来風雨声", 3: "plum jam tart", 4: make_text(rng, 60)}
    w = items[4].split()
    often = " . ".join(f"{' '.join(w[:24])} {make_text(rng, 60)}" for _ in range(9))
    docs = {1: f"Вот: {items[1]}!", 2: f"詩「{items[2]}」", 3: "a plum jam tart here", 4: "a plum jam", 5: f"{often} {' '.join(w[30:52])}", 6: "<a title='" + "x" * 300 + f"'>{items[4]}"}
    got = leaks.find_leaks(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(1, 1), (2, 2), (3, 3), (5, 4), (6, 4)}


def test_seeds_ignore_masked_words():
    a, b = "one two three four five six seven".split(), "one two three FOUR five six seven".split()
    hit = [m for (m, x), (_, y) in zip(leaks.seeds(a), leaks.seeds(b), strict=True) if x[0] == y[0]]
    assert hit == [m for m, mask in enumerate(leaks.MASKS) if mask[3] == "0"]


# --- languages -----------------------------------------------------------------------------------------------

SENTENCES = {
    "en": ["The box was open when it came.", "We would buy this again next week.", "There is not enough room for the other one.", "Our neighbours asked whether the shop would keep more of them.",
           "Nobody knows why the price went up without any warning.", "It should be stored away from the light and the heat.", "This was the first thing which worked for everyone in the house.",
           "The letters on the front are hard to read.", "They said that half of the bottles had been broken on the way.", "She thinks that the taste is better than before."],
    "de": ["Die Schachtel war offen, als sie kam.", "Wir würden das nächste Woche wieder kaufen.", "Es gibt nicht genug Platz für die andere.", "Unsere Nachbarn fragten, ob der Laden mehr davon behalten würde.",
           "Niemand weiß, warum der Preis ohne Warnung gestiegen ist.", "Man sollte es nicht im Licht und in der Wärme aufbewahren.", "Das war das erste, was bei allen im Haus funktioniert hat.",
           "Die Buchstaben auf der Vorderseite sind schwer zu lesen.", "Sie sagten, dass die Hälfte der Flaschen unterwegs zerbrochen ist.", "Sie findet den Geschmack besser als früher."],
    "es": ["La caja estaba abierta cuando llegó.", "Lo compraríamos otra vez la próxima semana.", "No hay bastante sitio para la otra.", "Nuestros vecinos preguntaron si la tienda guardaría más.",
           "Nadie sabe por qué el precio subió sin ningún aviso.", "Conviene guardarlo lejos de la luz y del calor.", "Fue lo primero que funcionó para todos en la casa.",
           "Las letras de la parte delantera son difíciles de leer.", "Dijeron que la mitad de las botellas se habían roto en el camino.", "Ella piensa que el sabor es mejor que antes."],
}


def test_languages_held_out(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choices(SENTENCES[x][:9], k=3)), x, 1) for i, x in enumerate(list(SENTENCES) * 10)]
    test = [
        (100, SENTENCES["en"][9], "nl", 1), (101, SENTENCES["de"][9], None, 1), (102, SENTENCES["es"][9], "ES", 1), (103, f"{SENTENCES['en'][9]} {SENTENCES['de'][9]}\n\n{SENTENCES['en'][0]}", "EN", 1),
        (104, None, "en", 1), (105, "", "en", 1), (106, "12345 !!", "en", 1), (107, f'Review 12\n{SENTENCES["de"][0]} „The great new box of tea and jam“ {SENTENCES["de"][1]}', "de", 1), (108, SENTENCES["es"][1] * 400, "es", 1),
    ]
    df = spark.createDataFrame(rows + test, "doc_id bigint, text string, lang string, seg_no int")
    got = {}
    for r in sorted(languages.identify(df, languages=("de", "en", "es")).collect(), key=lambda r: r["seg_no"]):
        got.setdefault(r["key"], []).append(r["lang"])
        assert 0 <= r["confidence"] <= 1
    assert [got.get(k) for k in range(100, 109)] == [["en"], ["de"], ["es"], ["en", "de", "en"], None, None, None, ["de"], ["es"]]
    wrong = {r["key"] for r in languages.relabelled(languages.identify(df, languages=("de", "en", "es"))).collect()}
    assert wrong == {100, 101, 102, 103}
    assert languages.identify(df.limit(0)).count() == 0


def test_text_in_unknown_letters_is_undetermined(spark):
    df = spark.createDataFrame([(1, "Съешь же ещё этих булок.", "en"), (2, "12 — 34", "en"), (3, "The jam is on the table.", "en")], "doc_id bigint, text string, lang string")
    got = {r["key"]: (r["lang"], r["confidence"]) for r in languages.identify(df, languages=("en",)).collect()}
    assert set(got) == {1, 3} and got[1] == (languages.UNKNOWN, 0.0) and got[3][0] == "en"


def test_table_equals_vectors():
    """The table of products is what binding and bundling letter vectors gives."""
    langs, table = languages.score_table(SENTENCES, dims=256, epochs=0)
    letters = languages.letter_vectors(256, 7)
    g = languages.trigrams("the box")
    bundle = sum(np.roll(letters[x // languages.SIZE**2], 2) * np.roll(letters[x // languages.SIZE % languages.SIZE], 1) * letters[x % languages.SIZE] for x in g)
    assert langs == ["de", "en", "es"] and table[g].sum(axis=0).shape == (3,)
    again = np.linalg.lstsq(np.stack([np.roll(letters[x // languages.SIZE**2], 2) * np.roll(letters[x // languages.SIZE % languages.SIZE], 1) * letters[x % languages.SIZE] for x in range(3000)]), table[:3000], rcond=None)[0]
    assert bundle @ again == pytest.approx(table[g].sum(axis=0), abs=0.05)


def test_lines_cut_by_a_break_are_joined():
    assert languages.sentences("A long line that has been bro-\nken in the middle of a\nsentence.\n\nNext one.")[0][0] == "A long line that has been broken in the middle of a sentence."
    assert languages.decode(np.array([[1.0, 0.0], [0.4, 0.5], [1.0, 0.0]]), 0.25).tolist() == [0, 0, 0]


def test_extra_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "plum jam and more plum jam", "en", "z", "z")], "doc_id bigint, text string, lang string, key string, n_tokens string")
    assert languages.identify(df, languages=("en",)).count() == 1
    assert packing.token_counts(df, "doc_id", "text", queries.TOKENIZER).count() == 1
    assert distinctive.residuals(df.withColumn("r", F.lit(1)), "doc_id", "text").count() == 2
