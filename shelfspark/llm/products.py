r"""Listings of the same product: title combination voting.

Reading a listing: the title's words are repaired against the more frequent words of the collection (an equi-join
on deletion variants), brands are taken from a canonical list, from spellings that many rows share, or from the
title; amounts come from the title or the size cell. What is left is a *form*: a set of tokens with a brand, a
content and a number of packs.

1. *Voting.* Every distinct form proposes the k-combinations of its tokens. A combination's score grows with its
   frequency over all titles and its length and falls with its average position; each form joins the cluster of its
   best combination.
2. *What says nothing* is learnt inside the clusters: a run of words whose removal turns a form into another form of
   the same cluster, packs and content, often and with several brands, is advertising. A form whose best combination
   holds advertising takes its next best.
3. *Verification* splits a cluster by packs, content (3 %) and remaining tokens. Inside a cluster, whose combination
   vouches for its members, a rare word that is near a more frequent one is its slip.
4. *Merging* joins clusters that a slip inside the combination drove apart: forms that agree in all but one word,
   that word rare and one edit away.

A listing with a null or empty title takes part with its attributes only; without any token it has no partner.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, islice

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm import canonical, titles
from shelfspark.operators import quantities
from shelfspark.session import cut_lineage, plain, spread, width

_small = canonical.small

#: Titles of up to so many different tokens propose all their combinations; longer ones those that can count (``_long_votes``).
ALL_PROPOSED = 60
#: A place of a token in a packed ``mask``.
_PLACE = (1 << 21) - 1


def _read(df: DataFrame) -> DataFrame:
    """row_ord, source, brand_raw and, of each listing, its words, attribute tokens and amount."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            rows = []
            for name, cell, info, src in zip(pdf["name"], pdf["sizing_comp"], pdf["item_info"], pdf["source"], strict=True):
                title = name or ""
                own, other = quantities.readings(title), quantities.readings(quantities.size_cell(cell))
                if src == "B":
                    own, other = other, own
                got = quantities.solve(own, other) or quantities.solve(other, ())
                base, content, packs = got[0][:3] if got else (None, None, 1)
                if got and packs == 1:  # a pack that the other statement alone has
                    packs = max([packs, *(r[2] for r in other if r[0] == base and abs(r[1] / content - 1) <= 0.03 and r[3] < 1)])
                rows.append((titles.words(title), *titles.attributes(info), base, content, packs))
            out = pd.DataFrame(rows, columns=["words", "attrs", "level", "base", "content", "packs"])
            yield plain(pd.concat([pdf[["row_ord", "source", "brand_raw"]].reset_index(drop=True), out], axis=1))

    schema = "row_ord bigint, source string, brand_raw string, words array<string>, attrs array<string>, level string, base string, content double, packs int"
    return spread(df.select("row_ord", "source", "brand_raw", "name", "sizing_comp", "item_info")).mapInPandas(run, schema)


def _variants(col: Column) -> Column:
    """Deletion variants of a word: one letter taken out, two if it has seven or more."""

    @F.pandas_udf("array<string>")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted(canonical.deletions(w, 2 if len(w) >= 7 else 1, prefix=16)))

    return udf(col)


def word_repairs(words: DataFrame, ratio: int = 10, far_ratio: int = 100, least: int = 5) -> DataFrame:
    """(word, better): for each slip of the pen the frequent word that is meant.

    ``words``: one row per occurrence, column ``word``. A word is repaired to one at least ``ratio`` times as
    frequent at distance 1, or ``far_ratio`` times at distance 2 (neighbour swaps count once).
    """
    counts = cut_lineage(words.where("length(word) >= 4").groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    spread_out = counts.repartition(width(words.sparkSession), "word")
    keyed = spread_out.select("word", "n", F.explode(_variants(F.col("word"))).alias("v"))
    rare = keyed.select(F.col("word").alias("a"), F.col("n").alias("na"), "v")
    good = keyed.where(F.col("n") >= max(ratio, least)).select(F.col("word").alias("b"), F.col("n").alias("nb"), "v")
    pairs = rare.join(good, "v").where(F.col("nb") >= ratio * F.col("na")).select("a", "na", "b", "nb").distinct()
    d = canonical._swaps("a", "b")
    near = pairs.withColumn("d", d).where((F.col("d") == 1) | ((F.col("d") == 2) & (F.col("nb") >= far_ratio * F.col("na")) & (F.length("a") >= 6)))
    return near.groupBy(F.col("a").alias("word")).agg(F.min_by("b", F.struct("d", (-F.col("nb")).alias("m"), "b")).alias("better"))


def _repaired(read: DataFrame) -> DataFrame:
    """``read`` with its words repaired; only rows that hold a word to repair are taken apart."""
    repairs = cut_lineage(word_repairs(read.select(F.explode("words").alias("word"))))
    each = read.select("row_ord", F.posexplode("words").alias("pos", "word")).join(_small(repairs, repairs.count()), "word")
    fixes = each.groupBy("row_ord").agg(F.map_from_entries(F.collect_list(F.struct("pos", "better"))).alias("fixes"))
    fixed = F.transform("words", lambda w, i: F.coalesce(F.try_element_at("fixes", i), w))
    return read.join(fixes, "row_ord", "left").withColumn("words", F.when(F.col("fixes").isNull(), F.col("words")).otherwise(fixed)).drop("fixes")


def _brand_keys(read: DataFrame, brands: DataFrame, support: int = 3) -> tuple[DataFrame, DataFrame]:
    """(brand_raw, brand_key) of typed brands, and (gram, brand) to look for in titles: listed brands and spellings of many rows."""
    values = read.select("brand_raw").where(F.col("brand_raw").rlike(r"(?U)\S"))
    mapped = canonical.map_to_list(values, "brand_raw", brands, "brand_id", "brand_name")
    typed = mapped.select(F.col("value").alias("brand_raw"), "entry_id", canonical._tokens(F.col("value")).alias("t")).select(
        "brand_raw", "entry_id", F.array_join("t.tokens", " ").alias("folded")
    )
    typed = cut_lineage(typed)
    filler = F.lower(F.trim("brand_raw")).isin(*sorted(canonical.FILLERS)) | (F.col("folded") == "")
    counts = values.groupBy("brand_raw").agg(F.count(F.lit(1)).alias("n"))
    own = typed.where(F.col("entry_id").isNull() & ~filler).join(counts, "brand_raw").groupBy("folded").agg(F.sum("n").alias("n"))
    own = own.where(F.col("n") >= support).select("folded")
    names = brands.where("brand_name is not null").select(F.col("brand_id").cast("string").alias("brand"), canonical._tokens(F.col("brand_name")).alias("t"))
    known = names.select(F.array_join("t.tokens", " ").alias("gram"), "brand").where("gram <> ''").groupBy("gram").agg(F.min("brand").alias("brand"))
    learnt = own.select(F.col("folded").alias("gram"), F.concat(F.lit("="), "folded").alias("brand")).join(known, "gram", "left_anti")
    book = cut_lineage(known.unionByName(learnt))
    key = F.when(F.col("entry_id").isNotNull(), F.col("entry_id").cast("string")).when(~filler, F.concat(F.lit("="), "folded"))
    return typed.select("brand_raw", key.alias("brand_key")).where("brand_key is not null"), book


def forms(df: DataFrame, brands: DataFrame) -> DataFrame:
    """(row_ord, source, level, brand, tokens, base, content, packs) of every listing; ``level`` is its category path.

    ``df``: row_ord (unique), source (A or B), name, brand_raw, sizing_comp, item_info; ``brands``: brand_id, brand_name.
    """
    read = cut_lineage(_read(df))
    typed, book = _brand_keys(read, brands)
    typed = cut_lineage(typed)
    # Rows without a typed brand match nothing; a key of their own each spares them a shared partition.
    key = F.coalesce(F.col("brand_raw"), F.concat(F.lit("\x00"), F.col("row_ord").cast("string")))
    rows = _repaired(read).withColumn("brand_raw", key).join(_small(typed, typed.count()), "brand_raw", "left")
    rows = rows.withColumn("toks", _canonical(F.col("words")))
    # The longest brand that stands in the title, the first of these: in the worker while the book may be sent, else by a join on word runs.
    if book.count() <= canonical.MOST_SENT:
        rows = rows.withColumn("hit", _find_brand(F.col("toks"), df.sparkSession.sparkContext.broadcast({r["gram"]: r["brand"] for r in book.collect()})))
    else:
        most = book.agg(F.max(F.size(F.split("gram", " ")))).first()[0]
        starts = F.sequence(F.lit(1), F.size("toks"))
        runs = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.size("toks"), F.lit(most))), lambda n: F.transform(starts, lambda i: F.struct(n.alias("n"), i.alias("i"), F.array_join(F.slice("toks", i, n), " ").alias("gram")))))
        each = rows.where("size(toks) > 0").select("row_ord", F.inline(runs)).where(F.size(F.split("gram", " ")) == F.col("n"))
        found = each.join(book, "gram").groupBy("row_ord").agg(F.max_by(F.struct("i", "n", "brand"), F.struct("n", -F.col("i"))).alias("hit"))
        rows = rows.join(found, "row_ord", "left")
    i, n = F.col("hit.i"), F.col("hit.n")
    rest = F.when(i.isNull(), F.col("toks")).otherwise(F.filter("toks", lambda t, k: (k + 1 < i) | (k + 1 >= i + n)))
    return cut_lineage(rows.select(
        "row_ord", "source", "level", "base", "content", "packs", F.coalesce("hit.brand", "brand_key").alias("brand"), F.array_distinct(F.concat(rest, "attrs")).alias("tokens")
    ))


def _canonical(words: Column) -> Column:
    @F.pandas_udf("array<string>")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda ws: titles.canonical(list(ws)))

    return udf(words)


def _find_brand(toks: Column, book: Broadcast) -> Column:
    """Struct of place (from 1), length and brand of the longest run of words that is a brand, the first of equals."""
    longest = max((k.count(" ") + 1 for k in book.value), default=0)

    @F.pandas_udf("i int, n int, brand string")
    def udf(s: pd.Series) -> pd.DataFrame:
        known, out = book.value, []
        for t in s:
            got = (None, None, None)
            for n in range(min(longest, len(t)), 0, -1):
                at = next((i for i in range(len(t) - n + 1) if " ".join(t[i : i + n]) in known), None)
                if at is not None:
                    got = (at + 1, n, known[" ".join(t[at : at + n])])
                    break
            out.append(got)
        return plain(pd.DataFrame(out, columns=["i", "n", "brand"]).astype({"i": "Int32", "n": "Int32"}))

    return udf(toks)


def _form(tokens: Column | str) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def distinct_forms(rows: DataFrame) -> DataFrame:
    """(brand, form, fid, n, tokens) of every distinct form, with all its tokens: what votes.

    A form is its sorted tokens as one string.
    """
    brand = F.coalesce("brand", F.lit("")).alias("brand")
    distinct = rows.where("size(tokens) > 0").groupBy(brand, _form("tokens").alias("form")).agg(F.count(F.lit(1)).alias("n"), F.min("tokens").alias("tokens"))
    return cut_lineage(distinct.withColumn("fid", F.xxhash64("brand", "form")).repartition(width(rows.sparkSession), "fid"))


def ballots(rows: DataFrame, most_tokens: int = 60) -> DataFrame:
    """``distinct_forms`` with at most ``most_tokens`` tokens each, those that most forms have: a shortened view, which no query reads."""
    distinct = distinct_forms(rows)
    long = distinct.where(F.size("tokens") > most_tokens)
    if long.isEmpty():
        return distinct
    df = distinct.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ranked = long.select("fid", F.posexplode("tokens").alias("pos", "word")).join(df, "word").groupBy("fid").agg(F.array_sort(F.collect_list(F.struct((-F.col("df")).alias("m"), "pos", "word"))).alias("t"))
    kept = ranked.select("fid", F.transform(F.array_sort(F.transform(F.slice("t", 1, most_tokens), lambda x: F.struct(x["pos"], x["word"]))), lambda x: x["word"]).alias("kept"))
    return cut_lineage(distinct.join(kept, "fid", "left").withColumn("tokens", F.coalesce("kept", "tokens")).drop("kept"))


_CAST = "fid bigint, cid bigint, n bigint, k bigint, places bigint, mask bigint"


def _cast(rows: Iterator[tuple], size: int = 100_000) -> Iterator[pd.DataFrame]:
    """Rows (brand, fid, n, words, places, packed) of combinations as frames of ``_CAST``, so many at a time that any title fits."""
    import xxhash

    while part := list(islice(rows, size)):
        out = []
        for b, f, n, words, p, packed in part:
            cid = xxhash.xxh64_intdigest("\x00".join([b, *sorted(words)])) - 2**63
            mask = ~sum((i + 1) << (21 * j) for j, i in enumerate(p)) if packed else sum(1 << i for i in p)
            out.append((f, cid, n, len(p), sum(p), mask))
        yield plain(pd.DataFrame(out, columns=["fid", "cid", "n", "k", "places", "mask"]))


def _holds(mask: str, i: Column) -> Column:
    """Whether a combination has the token at place ``i``.

    ``mask`` has a bit for each place; of a form of more than ``ALL_PROPOSED`` tokens it is the complement of up to three
    places (from 1) of 21 bits each.
    """
    packed = F.bitwise_not(mask)
    held = [F.shiftright(packed, 21 * j).bitwiseAND(F.lit(_PLACE)) == i + 1 for j in range(3)]
    return F.when(F.col(mask) >= 0, F.call_function("shiftright", F.col(mask), i).bitwiseAND(1) == 1).otherwise(held[0] | held[1] | held[2])


def promising(listings: list[int], first: list[int], k: int, least: float) -> Iterator[tuple[int, ...]]:
    """Every combination of ``k`` tokens, as their numbers, whose score could be ``least``.

    Token j stands in ``listings[j]`` titles, at place ``first[j]`` or later, ``first`` ascending. The score is at most
    ``log1p(least of listings) * k² / (1 + mean of first)``; a branch ends where this bound, which falls along it, is too low.
    """
    m, ahead = len(first), list(listings)
    for j in range(m - 2, -1, -1):
        ahead[j] = max(ahead[j], ahead[j + 1])

    def grow(chosen: tuple[int, ...], f: float, places: int) -> Iterator[tuple[int, ...]]:
        left = k - len(chosen)
        if not left:
            yield chosen
            return
        for j in range(chosen[-1] + 1 if chosen else 0, m - left + 1):
            under = 1 + (places + left * first[j]) / k
            if math.log1p(min(f, ahead[j])) * k * k < least * under:
                return
            if math.log1p(min(f, listings[j])) * k * k >= least * under:
                yield from grow((*chosen, j), min(f, listings[j]), places + first[j])

    return grow((), math.inf, 0)


def _long_votes(forms: DataFrame, ks: tuple[int, ...], barred: DataFrame | None) -> DataFrame:
    """``_CAST`` of the forms of more than ``ALL_PROPOSED`` tokens: the combinations that can count, for themselves or others.

    These are all that a shorter form of the brand proposes too, and of the others all that could be the best of some long
    form of the brand. Such a combination is in at most the listings of long forms that its rarest token has, its average
    position is at least that of the tokens' first places among them; and the best of a form scores at least what its
    tokens with the least last places must score. What is left out is therefore the best of no form. Both rules are the same
    for all forms of a brand, so whatever one proposes is proposed by all that hold it: its frequency is whole.
    """
    each = forms.select("brand", "fid", "n", (F.size("tokens") > ALL_PROPOSED).alias("long"), F.posexplode("tokens").alias("place", "word"))
    if not forms.where(F.size("tokens") >= _PLACE).isEmpty():
        raise ValueError(f"a title of {_PLACE} or more different words")
    held = cut_lineage(each.where("long").drop("long"))
    near = each.join(held.select("brand", "word").distinct(), ["brand", "word"], "left_semi")
    stats = near.groupBy("brand", "word").agg(F.sum(F.when(F.col("long"), F.col("n"))).alias("f"), F.min(F.when(F.col("long"), F.col("place"))).alias("lo"), F.max("place").alias("hi"))
    known = cut_lineage(held.join(stats, ["brand", "word"]))

    # Tokens that a long form shares with a shorter one.
    other = near.where("not long").select("brand", "word", F.col("fid").alias("short"))
    shared = known.join(other, ["brand", "word"]).groupBy("brand", "fid", "n", "short").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("t"))
    shared = shared.where(F.size("t") >= min(ks)).select("brand", "fid", "n", "t").distinct()

    # The score that the best of each form has at least, and the least of these in the brand.
    free = known if barred is None else known.join(barred, "fid", "left").where(F.col("ad").isNull() | ~F.expr("array_contains(ad, place)"))
    last = free.groupBy("brand", "fid", "n").agg(F.array_sort(F.collect_list("hi")).alias("h"))
    total = lambda k: F.aggregate(F.slice("h", 1, k), F.lit(0).cast("bigint"), lambda s, x: s + x)
    sure = F.array_max(F.array(*(F.when(F.size("h") >= k, F.log1p("n") * k * k / (1 + total(k) / k)) for k in ks)))
    least = last.withColumn("sure", sure).groupBy("brand").agg(F.min("sure").alias("least"))
    whole = known.groupBy("brand", "fid", "n").agg(F.array_sort(F.collect_list(F.struct("lo", "place", "word", "f"))).alias("t")).join(least.where("least is not null"), "brand")

    def of_shared(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
            for b, f, n, t in zip(pdf["brand"], pdf["fid"], pdf["n"], pdf["t"], strict=True):
                for k in ks:
                    for c in combinations(t, k):
                        yield b, f, n, [x["word"] for x in c], [x["place"] for x in c], True

        for pdf in it:
            yield from _cast(rows(pdf))

    def of_promising(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
            for b, f, n, t, lowest in zip(pdf["brand"], pdf["fid"], pdf["n"], pdf["t"], pdf["least"], strict=True):
                t = list(t)
                for k in ks:  # scores are compared after rounding to six places
                    for c in promising([x["f"] for x in t], [x["lo"] for x in t], k, lowest * (1 - 1e-9) - 2e-6):
                        chosen = sorted((t[j]["place"], t[j]["word"]) for j in c)
                        yield b, f, n, [w for _, w in chosen], [i for i, _ in chosen], True

        for pdf in it:
            yield from _cast(rows(pdf))

    wide = width(forms.sparkSession)
    got = shared.repartition(wide).mapInPandas(of_shared, _CAST).unionByName(whole.repartition(wide, "fid").mapInPandas(of_promising, _CAST))
    return got.dropDuplicates(["fid", "mask"])


def votes(forms: DataFrame, ks: tuple[int, ...] = (2, 3), barred: DataFrame | None = None) -> DataFrame:
    """(fid, cid, mask, score): the combinations that the forms propose, ``mask`` the places of their tokens (``_holds``).

    The score grows with the frequency over all titles and the length and falls with the average position. Of very long
    titles combinations that can be the best of no form are left out; ``barred`` (fid, ad) has the places that a form's
    best must do without.
    """
    if not ks or min(ks) < 1 or max(ks) > 3:
        raise ValueError("combinations have one to three tokens")

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows(pdf: pd.DataFrame) -> Iterator[tuple]:
            for b, f, n, toks in zip(pdf["brand"], pdf["fid"], pdf["n"], pdf["tokens"], strict=True):
                toks = list(toks)
                places = {tuple(range(len(toks))) if len(toks) <= k else p for k in ks for p in combinations(range(len(toks)), min(k, len(toks)))}
                for p in places:
                    yield b, f, n, [toks[i] for i in p], p, False

        for pdf in it:
            yield from _cast(rows(pdf))

    cast = forms.where(F.size("tokens") <= ALL_PROPOSED).select("brand", "fid", "n", "tokens").mapInPandas(run, _CAST)
    if not forms.where(F.size("tokens") > ALL_PROPOSED).isEmpty():
        cast = cast.unionByName(_long_votes(forms, ks, barred))
    # Numbers instead of words: this is the widest table of the operator. As one array they cross one exchange, by
    # combination, that serves both the tally and the join.
    cast = cast.select("cid", F.array("fid", "n", "k", "places", "mask").alias("v")).repartition("cid")
    fid, n, k, places, mask = (F.col("v")[i] for i in range(5))
    tally = cast.groupBy("cid").agg(F.sum(n).alias("f"), (F.sum(places / k * n) / F.sum(n)).alias("mean_pos"))
    score = F.round(F.log1p("f") * F.pow(k, F.lit(2)) / (1 + F.col("mean_pos")), 6)
    return cast.join(tally, "cid").select(fid.alias("fid"), "cid", mask.alias("mask"), score.alias("score"))


def elect(cast: DataFrame) -> DataFrame:
    """(fid, cid, mask): the best combination of every form."""
    return cast.groupBy("fid").agg(F.max_by(F.struct("cid", "mask"), F.struct("score", "cid")).alias("b")).select("fid", "b.cid", "b.mask")


def _bits(tokens: Column) -> Column:
    """An order-free number of a set of tokens; of a set less one token it follows by ``bitwiseXOR``."""
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda s, t: s.bitwiseXOR(F.xxhash64(t)))


def _step(content: Column | str, tolerance: float) -> Column:
    """Number of the content on a logarithmic scale of ``tolerance``; -1 for none."""
    return F.coalesce(F.round(F.log(content) / F.lit(math.log1p(tolerance))), F.lit(-1)).cast("bigint")


def _runs(tokens: str, lengths: Column) -> Column:
    """Runs of neighbouring tokens, none of them null, in each of ``lengths``: i (from 1), n, words."""
    starts = lambda n: F.sequence(F.lit(1), F.size(tokens) - n + 1)
    each = F.transform(F.filter(lengths, lambda n: n <= F.size(tokens)), lambda n: F.transform(starts(n), lambda i: F.struct(i.alias("i"), n.alias("n"), F.slice(tokens, i, n).alias("words"))))
    return F.filter(F.flatten(each), lambda x: ~F.exists(x["words"], lambda t: t.isNull()))


def _lengths(runs: DataFrame) -> Column:
    """The numbers of words that ``runs`` have."""
    got = sorted(r["n"] for r in runs.select(F.size(F.split("run", " ")).alias("n")).distinct().collect())
    return F.array(*map(F.lit, got)).cast("array<int>")


def advertising(rows: DataFrame, forms: DataFrame, elected: DataFrame, share: float = 0.1, brands: int = 3, tolerance: float = 0.01) -> DataFrame:
    """(run): runs of words, of any length, that say nothing of the product, learnt inside the clusters.

    A run outside a form's combination is tested in every cell (form, packs, content): does the form without it stand
    in the same cluster with the same packs and content? It is advertising if that holds for ``share`` of its cells,
    with at least ``brands`` brands. Only lengths by which another form there is shorter can hold; the cells of a run
    are then counted for the runs that held anywhere.
    """
    places = F.transform("tokens", lambda t, i: F.struct(t.alias("t"), _holds("mask", i).alias("own")))
    clusters = forms.join(elected, "fid").select("fid", "cid", F.transform(places, lambda x: F.when(~x["own"], x["t"])).alias("free"), _bits(F.col("tokens")).alias("bits"))
    cells = rows.where("size(tokens) > 0").select(F.coalesce("brand", F.lit("")).alias("brand"), F.xxhash64(F.coalesce("brand", F.lit("")), _form("tokens")).alias("fid"), F.coalesce("base", F.lit("-")).alias("base"), "packs", _step("content", tolerance).alias("step")).distinct()
    cells = cut_lineage(cells.join(clusters, "fid").withColumn("group", F.xxhash64("cid", "base", "packs", "step")))
    key = lambda bits: F.xxhash64("group", bits)
    sizes = cells.groupBy("group").agg(F.collect_set(F.size("free")).alias("sizes")).where("size(sizes) > 1")
    gaps = F.filter(F.transform("sizes", lambda x: F.size("free") - x), lambda x: x > 0)
    gaps = cells.join(sizes, "group").select("brand", "group", "bits", "free", F.explode(gaps).alias("gap"))
    tested = gaps.select("brand", "group", "bits", F.inline(_runs("free", F.array("gap")))).select("brand", F.array_join("words", " ").alias("run"), key(F.col("bits").bitwiseXOR(_bits(F.col("words")))).alias("key"))
    hits = tested.join(cells.select(key(F.col("bits")).alias("key")), "key", "left_semi").groupBy("run", "brand").agg(F.count(F.lit(1)).alias("hits"))
    held = cut_lineage(hits.groupBy("run").agg(F.sum("hits").alias("hits"), F.count(F.lit(1)).alias("brands")).where(F.col("brands") >= brands))
    all_runs = cells.select(F.inline(_runs("free", _lengths(held)))).select(F.array_join("words", " ").alias("run"))
    n = all_runs.join(_small(held, held.count()), "run").groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.first("hits").alias("hits"))
    return n.where(F.col("hits") >= share * F.col("n")).select("run")


def _without(forms: DataFrame, runs: DataFrame) -> DataFrame:
    """(fid, ad): the places (from 0) of advertising in the forms that have any."""
    each = forms.select("fid", F.inline(_runs("tokens", _lengths(runs)))).select("fid", "i", "n", F.array_join("words", " ").alias("run"))
    hits = each.join(_small(runs, runs.count()), "run")
    return hits.groupBy("fid").agg(F.array_distinct(F.flatten(F.collect_list(F.sequence(F.col("i") - 1, F.col("i") + F.col("n") - 2)))).alias("ad"))


def _slips(forms: DataFrame, rare: int = 3) -> DataFrame:
    """(brand, form, target): the form that each form with a slip stands for.

    ``forms``: brand, form, cid, n, distinct. The two agree in all words but one, which at most ``rare`` listings have
    and which is near the other's: as near as ``edits_allowed`` within a cluster, one edit (two from eight letters)
    between clusters. The more frequent form is the target.
    """
    each = forms.select("brand", "cid", "form", "n", _bits(F.split("form", " ")).alias("bits"), F.explode(F.split("form", " ")).alias("word")).where("form <> word")
    each = each.withColumn("rest", F.xxhash64("brand", F.col("bits").bitwiseXOR(F.xxhash64("word")))).drop("bits")
    df = each.groupBy("word").agg(F.sum("n").alias("df"))
    rare_words = df.where((F.col("df") <= rare) & (F.length("word") >= 5)).select("word")
    slips = cut_lineage(each.join(rare_words, "word").select("brand", "rest", F.col("cid").alias("ca"), F.col("form").alias("slip"), F.col("word").alias("a"), F.col("n").alias("na")))
    rests = slips.select("rest").distinct()
    others = each.where(F.length("word") >= 4).join(rests, "rest", "left_semi").select("rest", F.col("cid").alias("cb"), "form", F.col("word").alias("b"), F.col("n").alias("nb"))
    # Of a rest that many forms share only near words meet: the join is on the rest and a deletion variant.
    left = slips.withColumn("v", F.explode(canonical.variants(F.col("a"))))
    met = left.join(others.withColumn("v", F.explode(canonical.variants(F.col("b")))), ["rest", "v"]).drop("v", "rest").distinct()
    met = met.where((F.col("slip") != F.col("form")) & ((F.col("nb") > F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("form") < F.col("slip")))))
    inside = F.col("d") <= canonical.edits_allowed(F.least(F.length("a"), F.length("b")))
    across = (F.col("d") <= 1) | ((F.col("d") == 2) & (F.length("a") >= 8))
    near = met.withColumn("d", canonical._swaps("a", "b")).where(((F.col("ca") == F.col("cb")) & inside) | across)
    return near.groupBy("brand", F.col("slip").alias("form")).agg(F.min_by("form", F.struct("d", (-F.col("nb")).alias("m"), "form")).alias("target"))


def readings(rows: DataFrame) -> DataFrame:
    """(row_ord, source, level, brand, form, combination, base, content, packs): every listing with its verified form and its cluster.

    ``form``: the tokens without advertising, slips mended; ``combination``: the number of the cluster's combination.
    """
    base = rows.where("size(tokens) > 0").withColumn("brand", F.coalesce("brand", F.lit(""))).withColumn("fid", F.xxhash64("brand", _form("tokens")))
    forms = distinct_forms(rows)
    cast = cut_lineage(votes(forms))
    elected = cut_lineage(elect(cast))
    runs = cut_lineage(advertising(rows, forms, elected))
    ads = _without(forms, runs)
    marked = forms.join(ads, "fid", "left")
    kept = F.filter("tokens", lambda t, i: ~F.array_contains("ad", i))
    marked = marked.withColumn("kept", kept).withColumn("ad", F.when(F.size("kept") > 0, F.col("ad"))).withColumn("kept", F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("tokens")))
    marked = cut_lineage(marked)
    # A combination that holds advertising is dropped; the form takes its next best, or all that is left of it.
    spoilt = F.exists("ad", lambda i: _holds("mask", i))
    changed = marked.where("ad is not null").join(elected, "fid").where(spoilt).select("fid", "ad")
    if not forms.where(F.size("tokens") > ALL_PROPOSED).isEmpty():  # what was left out above can be their next best
        changed = cut_lineage(changed)
        cast = cut_lineage(votes(forms, barred=changed))
    again = elect(cast.join(_small(changed, changed.count()), "fid").where(~spoilt))
    lone = F.xxhash64("brand", _form("kept"))
    second = changed.join(again, "fid", "left").join(marked.select("fid", "brand", "kept"), "fid").select("fid", F.coalesce("cid", lone).alias("cid2"))
    final = marked.join(elected.select("fid", "cid"), "fid").join(second, "fid", "left").select(
        "fid", "brand", _form("kept").alias("form"), F.coalesce("cid2", "cid").alias("cid"), "n")
    final = cut_lineage(final)
    counted = final.groupBy("brand", "form").agg(F.sum("n").alias("n"), F.min("cid").alias("cid"))
    targets = cut_lineage(_slips(counted))
    mended = final.join(_small(targets, targets.count()), ["brand", "form"], "left").select("fid", F.coalesce("target", "form").alias("form"))
    cluster = counted.select(F.col("brand").alias("b2"), F.col("form").alias("f2"), F.col("cid").alias("combination"))
    out = base.join(mended, "fid").join(cluster, (F.col("brand") == F.col("b2")) & (F.col("form") == F.col("f2")))
    return cut_lineage(out.select("row_ord", "source", "level", "brand", "form", "combination", "base", "content", "packs"))


def product_ids(read: DataFrame, tolerance: float = 0.031, by_source: bool = False) -> DataFrame:
    """(row_ord, source, product, n_links): listings of the same product share ``product``, the least row_ord among them.

    ``read``: of ``readings``. ``by_source``: listings of different sources stay apart. ``n_links``: the other listings
    of the product.
    """
    # Copies are counted before any window, so a product that holds a third of all listings is a few rows there.
    key = [*(["source"] if by_source else []), "brand", "combination", "form", "base", "packs"]
    keyed = read.withColumns({"base": F.coalesce("base", F.lit("-")), "content": F.coalesce("content", F.lit(-1.0))})
    distinct = keyed.groupBy(*key, "content").agg(F.min("row_ord").alias("first"), F.count(F.lit(1)).alias("n"))
    steps = Window.partitionBy(*key).orderBy("content")
    jump = F.when(F.col("content") > F.lag("content").over(steps) * (1 + tolerance), 1).otherwise(0)
    chained = distinct.withColumn("jump", jump).withColumn("step", F.sum("jump").over(steps.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy(*key, "step")
    named = chained.select(*key, "content", F.min("first").over(whole).alias("product"), (F.sum("n").over(whole) - 1).alias("n_links"))
    return keyed.join(named, [*key, "content"]).select("row_ord", "source", "product", "n_links")


def pairs_within(products: DataFrame, salts: int = 16) -> DataFrame:
    """(row_lo, row_hi) of all listings of the same product: the pairs that a result is defined by.

    One side of each product is spread over ``salts`` parts, so that no product is one task.
    """
    many = products.where("n_links > 0")
    parts = F.when(F.col("n_links") < salts, F.array(F.lit(-1).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))
    b = many.select("product", F.col("row_ord").alias("row_hi"), F.explode(parts).alias("salt"))
    own = F.when(F.col("n_links") < salts, F.lit(-1).cast("bigint")).otherwise(F.pmod(F.xxhash64("row_ord"), F.lit(salts).cast("bigint")))
    a = many.select("product", F.col("row_ord").alias("row_lo"), own.alias("salt"))
    return a.join(b, ["product", "salt"]).where("row_lo < row_hi").select("row_lo", "row_hi")


def catalogue(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both catalogues as one table; the columns that the operators read, others left out."""
    cols = ["row_ord", "name", "brand_raw", "sizing_comp", "item_info"]
    return a.select(*cols, F.lit("A").alias("source")).unionByName(b.select(*cols, F.lit("B").alias("source")))
