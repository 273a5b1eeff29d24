r"""Free-typed values mapped to a canonical list by token repair and soft TF-IDF.

1. Values are folded (case, accents, look-alike letters, digits inside words) and cut into tokens; a value with
   its tokens run together or apart also counts as one long token.
2. Each *distinct* token meets the vocabulary of the list by equi-joins that lose nothing: near words share a
   deletion variant, an abbreviation and its word share first letter, second letter and last letter in order. Only
   what meets is measured.
3. The corrected tokens are combined per distinct value: each entry that could still reach the threshold by its rare
   words is scored by soft TF-IDF, the product of similarity and the weights of both sides, normalised by both lengths.

A list of any size is served: its tables are sent to the workers up to ``MOST_SENT`` rows and joined by shuffle
beyond, with the same rows. Values without an entry of at least ``threshold`` get null. Null and blank values give no row.
"""

from __future__ import annotations

import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.text import strip
from shelfspark.session import cut_lineage, plain, width

#: Most rows of a table that is sent to the workers.
MOST_SENT = 200_000

# Letters of other scripts that look like Latin ones, and digits typed for letters.
LOOKALIKES = str.maketrans("аеорсухіјѕԁһкмтвнαοερτικν", "aeopcyxijsdhkmtbhaoeptikv")
LEET = str.maketrans("015348", "olseab")
# Words round a name that are no part of it.
COMPANY_WORDS = frozenset("inc llc ltd co corp corporation company gmbh sa ag plc us usa uk tm r brand brands by from the and".split())
FILLERS = frozenset("n/a na none null unknown unbranded generic nobrand - -- ? tbd misc other various assorted".split()) | {
    "no brand", "see description", "not applicable", "store brand", "n a"
}


def fold(s: str) -> str:
    """Lower case without accents, trade marks and look-alikes; separators become blanks."""
    s = re.sub(r"(?<=[a-zà-öø-ÿ])(?=[A-Z][a-z])", " ", s)
    s = unicodedata.normalize("NFKD", s.replace("™", " ").replace("®", " ").replace("©", " ").lower().replace("ß", "ss"))
    s = "".join(c for c in s if not unicodedata.combining(c)).translate(LOOKALIKES)
    s = re.sub(r"(?<=[a-z])[015348]|[015348](?=[a-z])", lambda m: m[0].translate(LEET), s)
    s = re.sub(r"['’`´]", "", s)
    return re.sub(r"[^0-9a-z]+", " ", s).strip()


def tokens_of(value: str) -> tuple[list[str], str]:
    """(tokens that may belong to a name, all of it run together)."""
    t = fold(value).split()
    kept = [w for w in t if w not in COMPANY_WORDS] or t
    return kept, "".join(kept)


def _tokens(col: Column) -> Column:
    @F.pandas_udf("tokens array<string>, whole string")
    def udf(s: pd.Series) -> pd.DataFrame:
        got = [tokens_of(x) if x else ([], "") for x in s]
        return plain(pd.DataFrame({"tokens": [g[0] for g in got], "whole": [g[1] for g in got]}))

    return udf(col)


def small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_SENT else df


def edits_allowed(letters: Column | int):
    """Edits within which two words count as near, by the letters of the shorter."""
    if isinstance(letters, int):
        return 0 if letters < 3 else 1 if letters < 6 else 2 if letters < 9 else 3
    return F.when(letters < 3, 0).when(letters < 6, 1).when(letters < 9, 2).otherwise(3)


def deletions(word: str, edits: int, prefix: int = 10) -> set[str]:
    """The first letters of a word and what is left of them after taking out up to ``edits``.

    Two words within that swap distance share one of these, whatever stands behind the prefix.
    """
    out = last = {word[:prefix]}
    for _ in range(edits):
        last = {v[:i] + v[i + 1 :] for v in last for i in range(len(v))}
        out = out | last
    return out


def variants(col: Column) -> Column:
    """``deletions`` of a word within the edits that its own length allows."""

    @F.pandas_udf("array<string>")
    def udf(s: pd.Series) -> pd.Series:
        return s.map(lambda w: sorted(deletions(w, edits_allowed(len(w)))))

    return udf(col)


def _skeletons(word: Column) -> Column:
    """First letter, second letter and last letter of every abbreviation that the word may have."""

    @F.pandas_udf("array<string>")
    def udf(s: pd.Series) -> pd.Series:
        def of(w: str) -> list[str]:
            rest = w[1:]
            pairs = {x + y for i, x in enumerate(rest) for y in rest[i + 1 :]}
            return sorted({w[0] + p for p in pairs} | {w[0] + x + x for x in rest}) if w else []

        return s.map(of)

    return udf(word)


def _skeleton(short: Column) -> Column:
    """The same three letters of an abbreviation; of two letters the second counts twice."""
    return F.when(F.char_length(short) >= 2, F.concat(F.substring(short, 1, 2), F.right(short, F.lit(1))))


def _is_abbreviation(short: Column, word: Column) -> Column:
    """Same first letter, and the letters of ``short`` stand in ``word`` in that order."""
    pattern = F.concat(F.lit("^"), F.array_join(F.transform(F.split(short, ""), lambda c: F.concat(c, F.lit(".*"))), ""), F.lit("$"))
    return (F.char_length(short) >= 2) & (F.char_length(short) < F.char_length(word)) & F.rlike(word, pattern)


def swap_distance(a: str, b: str) -> int:
    """Edit distance in which swapping two neighbours counts once."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        new = [i]
        for j, y in enumerate(b, start=1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
    return row[-1]


def _swaps(a: Column | str, b: Column | str) -> Column:
    """``swap_distance`` of two columns; null where either is null."""

    @F.pandas_udf("int")
    def udf(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else swap_distance(p, q) for p, q in zip(x, y, strict=True)], dtype="Int32")

    return udf(*(F.col(c) if isinstance(c, str) else c for c in (a, b)))


def repair_tokens(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(token, word, sim): vocabulary words near each distinct token, or of which it is an abbreviation.

    ``tokens``: one column ``token``; ``vocabulary``: one column ``word``.
    """
    words = vocabulary.distinct()
    n = words.count()
    # Few bytes, much work: partitions by number, not by size.
    few = tokens.where("token <> ''").distinct().repartition(width(tokens.sparkSession), "token")
    near = few.select("token", F.explode(variants(F.col("token"))).alias("v")).join(small(words.select("word", F.explode(variants(F.col("word"))).alias("v")), 60 * n), "v")
    near = near.where(F.abs(F.char_length("token") - F.char_length("word")) <= edits_allowed(F.least(F.char_length("token"), F.char_length("word")))).select("token", "word")
    short = few.select("token", _skeleton(F.col("token")).alias("v")).join(small(words.select("word", F.explode(_skeletons(F.col("word"))).alias("v")), 40 * n), "v")
    short = short.where(_is_abbreviation(F.col("token"), F.col("word"))).select("token", "word")
    pairs = near.withColumn("short", F.lit(0)).unionByName(short.withColumn("short", F.lit(1))).groupBy("token", "word").agg(F.max("short").alias("short"))
    shorter, longer = (f(F.char_length("token"), F.char_length("word")) for f in (F.least, F.greatest))
    measured = pairs.withColumn("d", _swaps("token", "word"))
    sim = F.when(F.col("d") <= edits_allowed(shorter), 1 - F.col("d") / longer)
    return measured.withColumn("sim", F.greatest(sim, F.when(F.col("short") == 1, F.lit(0.8)))).where("sim is not null").select("token", "word", "sim")


def _entry_tables(entries: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entry, words, weights, whole, norm) of the list, (word) of its vocabulary, (word, entry) of the words that propose entries.

    Of an entry only its rarest words propose it: those without which the rest could not reach the threshold.
    """
    cut = entries.where("name is not null").select("entry", _tokens(F.col("name")).alias("t")).select("entry", "t.tokens", "t.whole").where("whole <> ''")
    n = F.lit(float(cut.count()))
    each = cut.select("entry", "whole", F.explode(F.array_distinct("tokens")).alias("word"))
    df = each.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weighed = each.join(df, "word").withColumn("idf", F.log(1 + n / F.col("df")))
    rows = weighed.groupBy("entry", "whole").agg(F.reverse(F.array_sort(F.collect_list(F.struct("idf", "word")))).alias("t")).select(
        "entry", "whole", F.col("t.word").alias("words"), F.col("t.idf").alias("weights"), F.sqrt(F.aggregate("t", F.lit(0.0), lambda s, x: s + x["idf"] * x["idf"])).alias("norm")
    )
    left = F.aggregate(F.slice("weights", F.col("pos") + 1, F.size("weights")), F.lit(0.0), lambda s, x: s + x * x)
    proposing = rows.select("entry", "weights", "norm", F.posexplode("words").alias("pos", "word")).where(F.sqrt(left) + 1e-9 >= F.col("norm") * threshold)
    proposing = proposing.select("word", "entry").unionByName(rows.select(F.col("whole").alias("word"), "entry")).distinct()
    vocabulary = df.select("word").unionByName(rows.select(F.col("whole").alias("word"))).distinct()
    return rows, vocabulary, proposing


def soft_tfidf(tokens: list[str], near: dict[str, dict[str, float]], words: list[str], weights: list[float], norm: float, top: float) -> float:
    """Similarity of a value's tokens to an entry: matched greedily, unmatched tokens weigh as the rarest word would (``top``)."""
    pairs = sorted(((near.get(t, {}).get(w, 0.0), a, b) for a, t in enumerate(tokens) for b, w in enumerate(words)), reverse=True)
    used, taken, weight, dot = set(), set(), [top] * len(tokens), 0.0
    for s, a, b in pairs:
        if s > 0 and a not in used and b not in taken:
            used.add(a)
            taken.add(b)
            weight[a] = weights[b]
            dot += s * weights[b] ** 2
    return dot / ((math.sqrt(sum(x * x for x in weight)) or 1.0) * (norm or 1.0))


def map_to_list(
    values: DataFrame, value: str, entries: DataFrame, entry_id: str, entry_name: str, threshold: float = 0.66, margin: float = 0.005
) -> DataFrame:
    """(value, entry_id or null, nearest_id, score, runner_up) for every distinct value that is not blank.

    ``entry_id`` is a BIGINT; of entries with equal scores the least id stands first.
    """
    wide = width(values.sparkSession)
    distinct = values.select(F.col(value).cast("string").alias("value")).where(F.col("value").rlike(r"(?U)\S")).distinct()
    cut = distinct.repartition(wide, "value").select("value", _tokens(F.col("value")).alias("t")).select("value", "t.tokens", "t.whole")
    cut = cut.withColumn("tokens", F.when(F.lower(strip(F.col("value"))).isin(*sorted(FILLERS)), F.array().cast("array<string>")).otherwise(F.col("tokens")))
    listed, vocabulary, proposing = _entry_tables(entries.select(F.col(entry_id).cast("bigint").alias("entry"), F.col(entry_name).alias("name")), threshold)
    listed, n_listed = listed.cache(), listed.count()
    asked = cut.where("size(tokens) > 0").select("value", "tokens", "whole", F.explode(F.array_distinct(F.concat("tokens", F.array("whole")))).alias("token"))
    near = cut_lineage(repair_tokens(asked.select("token"), vocabulary))
    repairs = near.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("word", "sim"))).alias("near"))
    proposed = near.select("token", "word").join(small(proposing, 8 * n_listed), "word").groupBy("token").agg(F.collect_set("entry").alias("entries"))
    per_token = repairs.join(proposed, "token", "left")
    held = asked.join(per_token, "token").repartition(wide, "value").groupBy("value").agg(
        F.first("tokens").alias("tokens"), F.first("whole").alias("whole"), F.map_from_entries(F.collect_list(F.struct("token", "near"))).alias("near"),
        F.array_distinct(F.flatten(F.collect_list(F.coalesce("entries", F.array().cast("array<bigint>"))))).alias("entries"),
    )
    pairs = held.select("*", F.explode("entries").alias("entry")).drop("entries").join(small(listed.withColumnRenamed("whole", "run"), n_listed), "entry")
    top = math.log(1 + max(1, n_listed))

    @F.pandas_udf("double")
    def score(tokens: pd.Series, whole: pd.Series, near: pd.Series, words: pd.Series, weights: pd.Series, run: pd.Series, norm: pd.Series) -> pd.Series:
        out = []
        for t, h, m, w, g, r, z in zip(tokens, whole, near, words, weights, run, norm, strict=True):
            known = {k: dict(v) for k, v in (m.items() if isinstance(m, dict) else m)}
            out.append(round(max(soft_tfidf(list(t), known, list(w), list(g), z, top), known.get(h, {}).get(r, 0.0)), 6))
        return pd.Series(out, dtype="float64")

    scored = pairs.select("value", "entry", score("tokens", "whole", "near", "words", "weights", "run", "norm").alias("s"))
    best = scored.groupBy("value").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("m"), "entry"))), 1, 2).alias("b"))
    first, second = -F.try_element_at("b", F.lit(1))["m"], -F.coalesce(F.try_element_at("b", F.lit(2))["m"], F.lit(0.0))
    sure = (first >= threshold) & ((first - second >= margin) | (first >= 0.999))
    nearest = F.try_element_at("b", F.lit(1))["entry"]
    return distinct.join(best, "value", "left").select(
        "value", F.when(sure, nearest).alias("entry_id"), nearest.alias("nearest_id"), F.coalesce(first, F.lit(0.0)).alias("score"), F.coalesce(second, F.lit(0.0)).alias("runner_up")
    )
