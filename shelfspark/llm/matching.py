r"""Matching the entities of two sources without a shared key: loopy belief propagation.

Entities are the products within a source (copies are not expanded). Candidate pairs come from partial agreement, by
equi-joins: the same number of packs, and words equal, with brands equal or one unknown, or words equal but for one
that one side adds. Contents are within 3 % of each other, or unknown on either side.

Each pair agrees to some level in brand, words, amount, category and in how rare the shared words are. How often a
level stands among matches is learnt from the candidates by expectation maximisation, on the counts of the level
patterns; its ratio to how often it stands among other candidates gives the prior odds ``w`` of a pair. One-to-one factors on both sides then exchange messages along the pairs,

    a_ij = 1 / (1 + sum over k != j of w_ik b_ik),   b_ij = 1 / (1 + sum over k != i of w_kj a_kj),

damped, until no message moves by more than ``tolerance``; the marginal of a pair is ``w a b / (1 + w a b)``. Pairs
without any rival need no messages. Each round is two grouped sums; lineage is cut by reliable checkpoints.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import titles
from shelfspark.llm.products import _bits, product_ids
from shelfspark.session import cut_lineage

#: Levels of agreement of each attribute, best first; a level named unknown speaks neither for nor against a match.
LEVELS = {
    "brand": ("equal", "one or both missing"),
    "words": ("equal", "rare word added", "common word added"),
    "amount": ("agreed", "unknown"),
    "category": ("usual", "unusual", "unknown"),
    "rarity": ("rare", "common"),
}
#: Shares of the levels among matches, where learning starts and what it leans on where the candidates are few, and among
#: candidates that are no match, which stay as they are.
START_M = {"brand": (0.9, 0.1), "words": (0.93, 0.05, 0.02), "amount": (1.0,), "category": (0.9, 0.1), "rarity": (0.8, 0.2)}
OTHERS_U = {"brand": (0.7, 0.3), "words": (0.07, 0.03, 0.9), "amount": (0.3,), "category": (0.5, 0.5), "rarity": (0.3, 0.7)}


def entities(read: DataFrame, own: DataFrame) -> DataFrame:
    """(entity, source, brand, form, base, content, packs, level, n): the products of each source.

    ``read``: of ``products.readings``; ``own``: (row_ord, product) by source. ``level`` is the most usual category.
    """
    rows = read.join(own.select("row_ord", F.col("product").alias("entity")), "row_ord")
    return rows.groupBy("entity").agg(
        F.min("source").alias("source"), F.min("brand").alias("brand"), F.min("form").alias("form"), F.min("base").alias("base"), F.min("content").alias("content"),
        F.min("packs").alias("packs"), F.mode("level", deterministic=True).alias("level"), F.count(F.lit(1)).alias("n"),
    )


def candidates(ents: DataFrame, tolerance: float = 0.031) -> DataFrame:
    """(a, b, word_a, word_b, brand, words, amount): pairs with their levels of agreement as numbers.

    ``word_a`` and ``word_b`` are the words that differ, '' for none.
    """
    each = ents.withColumn("bits", _bits(F.split("form", " ")))
    one_out = each.withColumn("word", F.explode(F.split("form", " "))).where("form <> word").withColumn("rest", F.col("bits").bitwiseXOR(F.xxhash64("word")))
    whole = each.select("*", F.lit("").alias("word"), F.col("bits").alias("rest"))
    cols = lambda df, s, x: df.where(F.col("source") == s).select("rest", "packs", F.col("brand").alias(f"g{x}"), F.col("entity").alias(x), F.col("word").alias(f"word_{x}"), F.col("base").alias(f"base_{x}"), F.col("content").alias(f"c{x}"))

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        a, b = cols(left, "A", "a").withColumn("g", F.col("ga")), cols(right, "B", "b").withColumn("g", F.col("gb"))
        return a.join(b, ["rest", "packs", "g"])

    # Equal words also meet where one side has no brand; the rarity of the words then weighs in.
    a, b = cols(whole, "A", "a"), cols(whole, "B", "b")
    lone = [a.where("ga = ''").join(b.where("gb <> ''"), ["rest", "packs"]), a.where("ga <> ''").join(b.where("gb = ''"), ["rest", "packs"])]
    equal = met(whole, whole).drop("g").unionByName(lone[0]).unionByName(lone[1])
    added = met(whole, one_out).unionByName(met(one_out, whole)).where("g <> ''").drop("g")
    every = equal.withColumn("words", F.lit(0)).unionByName(added.withColumn("words", F.lit(1)))
    gap = F.abs(F.log(F.col("ca") / F.col("cb")))
    known = F.col("ca").isNotNull().cast("int") + F.col("cb").isNotNull().cast("int")
    amount = F.when(known < 2, 1).when((F.col("base_a") == F.col("base_b")) & (gap <= math.log1p(tolerance)), 0)
    brand = F.when(F.col("ga") == F.col("gb"), F.when(F.col("ga") == "", 1).otherwise(0)).otherwise(1)
    found = every.select("a", "b", "word_a", "word_b", brand.alias("brand"), "words", amount.alias("amount")).where("amount is not null")
    return found.groupBy("a", "b").agg(F.min_by(F.struct("word_a", "word_b", "brand", "words", "amount"), F.struct("words", "word_a", "word_b")).alias("x")).select("a", "b", "x.*")


def with_levels(pairs: DataFrame, ents: DataFrame, rare: float = 0.002) -> DataFrame:
    """Candidates with the levels of category and rarity added.

    A pair of categories is usual if candidates with equal words meet in it more often than by chance. Shared and added
    words are rare if they stand in at most ``rare`` of the entities; a diet that one side adds never counts as rare.
    """
    words = ents.select("entity", F.explode(F.split("form", " ")).alias("word"))
    total = max(1, ents.count())
    df = words.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    # Two rarest words of each entity: one of them is shared unless both differ.
    rarest = words.join(df, "word").groupBy("entity").agg(F.slice(F.array_sort(F.collect_list(F.struct("df", "word"))), 1, 2).alias("r"))
    a = ents.select(F.col("entity").alias("a"), F.col("level").alias("la")).join(rarest.withColumnRenamed("entity", "a"), "a", "left")
    b = ents.select(F.col("entity").alias("b"), F.col("level").alias("lb"))
    q = cut_lineage(pairs.join(a, "a").join(b, "b"))
    sure = q.where("words = 0 and la is not null and lb is not null")
    both = sure.groupBy("la", "lb").agg(F.count(F.lit(1)).alias("n"))
    na, nb = both.groupBy("la").agg(F.sum("n").alias("na")), both.groupBy("lb").agg(F.sum("n").alias("nb"))
    n = sure.count()
    usual = both.join(na, "la").join(nb, "lb").where(F.col("n") * n > F.col("na") * F.col("nb")).select("la", "lb", F.lit(1).alias("usual"))
    q = q.join(usual, ["la", "lb"], "left")
    extra = df.withColumnRenamed("word", "extra").withColumnRenamed("df", "df_extra")
    q = q.withColumn("extra", F.concat("word_a", "word_b")).join(extra, "extra", "left")
    bound = max(2.0, rare * total)
    category = F.when(F.col("la").isNull() | F.col("lb").isNull(), 2).when(F.col("usual") == 1, 0).otherwise(1)
    shared = F.filter("r", lambda x: x["word"] != F.col("word_a"))
    rarity = F.when(F.coalesce(F.try_element_at(shared, F.lit(1))["df"], F.lit(total)) <= bound, 0).otherwise(1)
    plain = (F.col("df_extra") <= bound) & ~F.col("extra").isin(*sorted(set(titles.SAME_MEANING.values())))
    words = F.when(F.col("words") == 0, 0).when(plain, 1).otherwise(2)
    return q.select("a", "b", "brand", words.alias("words"), "amount", category.alias("category"), rarity.alias("rarity"))


def learn(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, lean: float = 100.0) -> dict[tuple[int, ...], float]:
    """Odds of a match for each pattern of levels, by expectation maximisation.

    ``patterns``: (levels in the order of ``LEVELS``, pairs). The shares among matches start at ``START_M``, which counts
    as ``lean`` pairs. Levels are taken as independent, matches and others as equally likely beforehand.
    """
    names = list(LEVELS)
    m = {k: list(v) for k, v in START_M.items()}

    def ratio(p: tuple[int, ...]) -> float:
        return math.prod(m[k][x] / OTHERS_U[k][x] for k, x in zip(names, p, strict=True) if x < len(m[k]))

    for _ in range(rounds):
        before = {k: tuple(v) for k, v in m.items()}
        belief = [(p, n * ratio(p) / (1 + ratio(p))) for p, n in patterns]
        for i, k in enumerate(names):
            got = [lean * x for x in START_M[k]]
            for p, x in belief:
                if p[i] < len(got):
                    got[p[i]] += x
            m[k] = [x / sum(got) for x in got]
        if all(abs(x - y) < 1e-9 for k in names for x, y in zip(m[k], before[k], strict=True)):
            break
    return {p: ratio(p) for p, _ in patterns}


def prior_odds(pairs: DataFrame, ents: DataFrame) -> DataFrame:
    """(a, b, w): odds of each candidate pair before the one-to-one factors.

    The patterns of levels are few, whatever the input; only their counts come to the driver.
    """
    names = list(LEVELS)
    levels = cut_lineage(with_levels(pairs, ents))
    odds = learn([(tuple(r[k] for k in names), r["n"]) for r in levels.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()])
    table = F.create_map(*(x for p, w in odds.items() for x in (F.lit(",".join(map(str, p))), F.lit(w)))) if odds else F.create_map().cast("map<string,double>")
    return levels.select("a", "b", F.try_element_at(table, F.concat_ws(",", *names)).alias("w"))


def _round(state: DataFrame, damp: float) -> DataFrame:
    w, other = F.col("w"), 1.0 - damp
    a = state.join(state.groupBy("a").agg(F.sum(w * F.col("mb")).alias("sa")), "a")
    a = a.withColumn("na", other / (1 + F.greatest(F.col("sa") - w * F.col("mb"), F.lit(0.0))) + damp * F.col("ma")).drop("sa")
    b = a.join(a.groupBy("b").agg(F.sum(w * F.col("na")).alias("sb")), "b")
    b = b.withColumn("nb", other / (1 + F.greatest(F.col("sb") - w * F.col("na"), F.lit(0.0))) + damp * F.col("mb"))
    moved = F.greatest(F.abs(F.col("na") - F.col("ma")), F.abs(F.col("nb") - F.col("mb")))
    return b.select("a", "b", "w", F.col("na").alias("ma"), F.col("nb").alias("mb"), moved.alias("moved"))


def propagate(pairs: DataFrame, tolerance: float = 1e-3, every: int = 3, most_rounds: int = 300, damp: float = 0.2) -> DataFrame:
    """(a, b, w, p): marginal match probability of every pair (a, b, w).

    Rounds go on until no message moves by more than ``tolerance``; not to get there in ``most_rounds`` is an error. Pairs
    whose ends have no other pair get ``w / (1 + w)``, which is what the messages would give.
    """
    counted = pairs.select("a", "b", "w")
    ka, kb = (counted.groupBy(k).agg(F.count(F.lit(1)).alias(f"n{k}")) for k in "ab")
    counted = cut_lineage(counted.join(ka, "a").join(kb, "b"))
    lone = counted.where("na = 1 and nb = 1").select("a", "b", "w", (F.col("w") / (1 + F.col("w"))).alias("p"))
    state = cut_lineage(counted.where("na > 1 or nb > 1").select("a", "b", "w", F.lit(1.0).alias("ma"), F.lit(1.0).alias("mb")))
    done, moved = 0, 0.0 if state.isEmpty() else 1.0
    while moved > tolerance:
        if done >= most_rounds:
            raise ValueError(f"messages still move by {moved:.2g} after {done} rounds")
        for _ in range(every):
            state = _round(state.select("a", "b", "w", "ma", "mb"), damp)
        state, done = cut_lineage(state), done + every
        moved = state.agg(F.max("moved")).first()[0]
    odds = F.col("w") * F.col("ma") * F.col("mb")
    return lone.unionByName(state.select("a", "b", "w", (odds / (1 + odds)).alias("p")))


def match(read: DataFrame, least: float = 0.5) -> DataFrame:
    """(row_lo, row_hi, confidence): rows of A and B whose entities match with at least ``least``.

    ``read``: of ``products.readings``. One-to-one holds between the products of the two sources.
    """
    own = cut_lineage(product_ids(read, by_source=True).withColumnRenamed("product", "entity"))
    ents = cut_lineage(entities(read, own.withColumnRenamed("entity", "product")))
    kept = propagate(prior_odds(candidates(ents), ents)).where(F.col("p") >= least)
    return members(kept, own)


def members(kept: DataFrame, own: DataFrame) -> DataFrame:
    """(row_lo, row_hi, confidence): matched entities as the rows that stand for them."""
    rows = own.select("row_ord", "entity")
    lo = kept.join(rows.select(F.col("entity").alias("a"), F.col("row_ord").alias("row_lo")), "a")
    return lo.join(rows.select(F.col("entity").alias("b"), F.col("row_ord").alias("row_hi")), "b").select("row_lo", "row_hi", F.round("p", 6).alias("confidence"))
