r"""Fixed-capacity containers filled by minimum bin slack.

The lengths of all items form a histogram with at most ``capacity`` entries, whatever the corpus. The planner
works on it alone: it opens a container with the longest item left, finds by a bitset subset-sum over the lengths
left (bit ``s`` is set if some combination sums to ``s``) the fullest feasible combination, and removes that
combination as many times as the histogram allows. Each step exhausts a length, so the plan has about as many
patterns as there are lengths and fits every worker.

Items then look up their container: the rank of an item among those of its length says which copy of which
pattern it fills. Ranks come from salted windows, so that a length held by a third of all items is no hot key.

An item longer than the capacity is cut into full containers and one remainder; no other is split. Items without
tokens (also null texts) take no space and go to container 0.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.session import cut_lineage, plain, spread

Pattern = tuple[int, dict[int, int]]  # times, copies of each length


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Copies of each length whose sum is the greatest that fits into ``room``; longer lengths first among equals."""
    reach, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int, int]] = []  # length, copies at once, reach before
    for length in sorted((x for x in counts if 0 < x <= room and counts[x] > 0), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    out: dict[int, int] = {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            out[length] = out.get(length, 0) + k
            total -= length * k
    return out


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use every item once; all lengths must lie within the capacity."""
    left = {k: n for k, n in counts.items() if k > 0 and n > 0}
    if any(k > capacity for k in left):
        raise ValueError("an item is longer than the capacity")
    out: list[Pattern] = []
    order = sorted(left, reverse=True)
    i = 0
    while i < len(order):
        top = order[i]
        if not left.get(top):
            i += 1
            continue
        left[top] -= 1
        use = fullest(left, capacity - top)
        left[top] += 1
        use[top] = use.get(top, 0) + 1
        times = min(left[k] // n for k, n in use.items())
        for k, n in use.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((times, use))
    return out


def token_counts(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """(key, n_tokens) of every row, by a public tokenizer read from the file ``tokenizer`` on the workers."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        for pdf in it:
            texts = pdf["t"].fillna("")
            n = []
            for i in range(0, len(texts), 64):
                n += [len(e.ids) for e in t.encode_batch_fast(list(texts.iloc[i : i + 64]), add_special_tokens=False)]
            yield plain(pd.DataFrame({"key": pdf["key"], "n_tokens": pd.Series(n, dtype="int64")}))

    src = df.select(F.col(key).alias("key"), F.col(text).alias("t"))
    return spread(src).mapInPandas(run, f"key {src.schema['key'].dataType.simpleString()}, n_tokens bigint")


def _slots(patterns: list[Pattern], first: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: rank at which each pattern begins, its first container, its copies per container."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    bin_no = first
    for times, use in patterns:
        for k, n in use.items():
            out.setdefault(k, []).append((used.get(k, 0), bin_no, n))
            used[k] = used.get(k, 0) + n * times
        bin_no += times
    return {k: tuple(np.array(x) for x in zip(*v, strict=True)) for k, v in out.items()}


def pack(lengths: DataFrame, budgets: list[tuple[int, int]], salts: int | None = None) -> DataFrame:
    """(budget_id, container_id, key, piece_no, n_tokens) of every item in every budget.

    ``lengths``: (key, n_tokens), keys unique; ``budgets``: (id, capacity). Container ids count from 1 in each budget.
    ``salts``: parts of each length that are ranked apart; by default one per half million items, 64 at least.
    """
    salts = salts or max(64, lengths.count() // 500_000)
    if any(c <= 0 for _, c in budgets):
        raise ValueError("a capacity must be positive")
    spark = lengths.sparkSession
    sizes = F.array(*(F.struct(F.lit(b).cast("bigint").alias("budget_id"), F.lit(c).cast("bigint").alias("capacity")) for b, c in budgets))
    each = lengths.where("n_tokens > 0").select("key", "n_tokens", F.inline(sizes))
    whole = F.floor((F.col("n_tokens") - 1) / F.col("capacity")).cast("int")
    pieces = each.select("key", "n_tokens", "budget_id", "capacity", F.explode(F.sequence(F.lit(0), whole)).alias("p")).select(
        "budget_id", "key", (F.col("p") + 1).cast("bigint").alias("piece_no"),
        F.least("capacity", F.col("n_tokens") - F.col("p") * F.col("capacity")).cast("bigint").alias("n"),
    ).withColumn("salt", F.pmod(F.xxhash64("key", "piece_no"), F.lit(salts)).cast("int"))
    pieces = cut_lineage(pieces)
    cells = cut_lineage(pieces.groupBy("budget_id", "n", "salt").agg(F.count(F.lit(1)).alias("c")))
    histogram = cells.groupBy("budget_id", "n").agg(F.sum("c").alias("c")).collect()  # at most the sum of the capacities
    slots: dict[int, dict] = {}
    for b, c in budgets:
        slots[b] = _slots(plan({r["n"]: r["c"] for r in histogram if r["budget_id"] == b}, c), 1)
    before = Window.partitionBy("budget_id", "n").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("offset", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    local = F.row_number().over(Window.partitionBy("budget_id", "n", "salt").orderBy("key", "piece_no"))
    ranked = pieces.withColumn("r", local - 1).join(offsets, ["budget_id", "n", "salt"]).withColumn("r", F.col("r") + F.col("offset"))
    shared = spark.sparkContext.broadcast(slots)  # about as many entries as there are lengths

    def assign(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for pdf in it:
            bins = np.zeros(len(pdf), dtype=np.int64)
            for (b, n), at in pdf.groupby(["budget_id", "n"]).indices.items():
                start, first, copies = known[b][n]
                r = pdf["r"].to_numpy()[at]
                k = np.searchsorted(start, r, side="right") - 1
                bins[at] = first[k] + (r - start[k]) // copies[k]
            yield plain(pd.DataFrame({"budget_id": pdf["budget_id"], "container_id": bins, "key": pdf["key"], "piece_no": pdf["piece_no"], "n_tokens": pdf["n"]}))

    kind = lengths.schema["key"].dataType.simpleString()
    schema = f"budget_id bigint, container_id bigint, key {kind}, piece_no bigint, n_tokens bigint"
    packed = ranked.select("budget_id", "n", "r", "key", "piece_no").mapInPandas(assign, schema)
    empty = lengths.where("coalesce(n_tokens, 0) <= 0").select("key", F.inline(sizes)).select(
        "budget_id", F.lit(0).cast("bigint").alias("container_id"), "key", F.lit(1).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("n_tokens")
    )
    return packed.unionByName(empty)


def fill_report(packed: DataFrame, budgets: DataFrame) -> DataFrame:
    """By budget: containers, tokens, the least containers that any packing needs, and the share left unused."""
    per = packed.where("container_id > 0").groupBy("budget_id").agg(F.max("container_id").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    caps = budgets.select("budget_id", "capacity_tokens")
    return per.join(F.broadcast(caps), "budget_id").select(
        "budget_id", "n_containers", "n_tokens", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"),
        F.round(1 - F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6).alias("unused_share"),
    )
