"""Frequent itemsets and association rules.

An itemset is a sorted array of strings: canonical, so it can be a join key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.columns import col
from tabforge.functions.measures import MEASURES, rule_measures
from tabforge.session import materialize

#: Different baskets, and items in them, of a shard.
SHARD_BASKETS, SHARD_ITEMS = 1 << 16, 1 << 22


def baskets_from_rows(df: DataFrame, tid: str = "tid", item: str = "item", min_support: float = 0.0) -> DataFrame:
    """(items) per transaction from long (tid, item) rows.

    With ``min_support``, items in a smaller share of the transactions are left out before a basket is
    put together, which then is no longer than there are frequent items; a basket may become empty.
    """
    rows = df.select(col(tid).alias("tid"), col(item).alias("item"))
    if min_support <= 0:
        return rows.groupBy("tid").agg(F.sort_array(F.collect_set("item")).alias("items")).select("items")
    pairs = materialize(rows.distinct(), "pairs")
    tids = pairs.select("tid").distinct()
    least = tids.count() * min_support
    frequent = pairs.filter("item is not null").groupBy("item").count().filter(F.col("count") >= least)
    kept = pairs.join(frequent, "item", "left_semi").groupBy("tid").agg(F.sort_array(F.collect_list("item")).alias("items"))
    none = F.array().cast("array<string>")
    return tids.join(kept.withColumnRenamed("tid", "_tid"), F.col("tid").eqNullSafe(F.col("_tid")), "left").select(F.coalesce("items", none).alias("items"))


def baskets_from_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(items) per row of a wide 0/1 table: a projection, no shuffle. An all-zero row is an empty basket."""
    return df.select(F.array_compact(F.array(*[F.when(col(c) > 0, F.lit(c)) for c in sorted(columns)])).alias("items"))


# --- itemsets ----------------------------------------------------------------------------------------

class Shard:
    """Baskets of a shard as one bit row an item, and their weights as binary digits."""

    def __init__(self, table: pa.Table, wanted: np.ndarray | None = None, least: float = 0.0):
        items, weights = table.column("items").combine_chunks(), np.asarray(table.column("w").combine_chunks(), np.int64)
        self.weight = int(weights.sum())
        encoded = pc.dictionary_encode(items.flatten())
        names, codes = np.array(encoded.dictionary.to_pylist(), object), np.asarray(encoded.indices, np.int64)
        rows = np.asarray(pc.list_parent_indices(items), np.int64)
        counts = np.bincount(codes, weights[rows], len(names))
        keep = np.flatnonzero(counts >= least) if wanted is None else np.flatnonzero(np.isin(names, wanted))
        keep = keep[np.argsort(names[keep], kind="stable")] if len(keep) else keep
        self.names, self.counts = names[keep], counts[keep].astype(np.int64)
        place = np.full(len(names), -1)
        place[keep] = np.arange(len(keep))
        self.bits = np.zeros((len(keep), -(-len(weights) // 64)), np.uint64)
        for start in range(0, len(codes), 1 << 20):
            at, row = place[codes[start : start + (1 << 20)]], rows[start : start + (1 << 20)]
            at, row = at[at >= 0], row[at >= 0]
            np.bitwise_or.at(self.bits, (at, row // 64), np.uint64(1) << (row % 64).astype(np.uint64))
        digits = range(int(weights.max(initial=0)).bit_length())
        self.planes = [(1 << d, self._mask((weights >> d) & 1)) for d in digits if ((weights >> d) & 1).any()]

    @staticmethod
    def _mask(flags: np.ndarray) -> np.ndarray:
        padded = np.zeros(-(-len(flags) // 64) * 64, np.uint8)
        padded[: len(flags)] = flags
        return np.packbits(padded, bitorder="little").view(np.uint64)

    def count(self, bits: np.ndarray) -> np.ndarray:
        """Weight of the baskets in each bit row."""
        return sum(value * np.bitwise_count(bits & mask).sum(axis=-1, dtype=np.int64) for value, mask in self.planes)

    def frequent(self, least: float, max_len: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Sets of items, as places in ``names``, of at least that weight: each set is extended by later items that were
        frequent beside its last."""
        everything = np.arange(len(self.names))
        todo = [((), None, everything[self.counts >= least], self.counts[self.counts >= least])]
        while todo:
            prefix, bits, last, counts = todo.pop()
            for i, (item, n) in enumerate(zip(last.tolist(), counts.tolist())):
                found = (*prefix, item)
                yield found, n
                later = last[i + 1 :]
                if len(found) == max_len or not len(later):
                    continue
                own = self.bits[item] if bits is None else bits & self.bits[item]
                more = np.concatenate([self.count(self.bits[later[at : at + 256]] & own) for at in range(0, len(later), 256)])
                ok = more >= least
                if ok.any():
                    todo.append((found, own, later[ok], more[ok]))


_LOCAL = "items array<string>, shard long, n long"


def _local_table(found: list[tuple[list[str], int]], shard: int) -> pa.Table:
    return pa.table([pa.array([f for f, _ in found], pa.list_(pa.string())), pa.array([shard] * len(found), pa.int64()), pa.array([n for _, n in found], pa.int64())],
                    names=["items", "shard", "n"])


def frequent_itemsets(baskets: DataFrame, min_support: float, max_len: int = 4, shard_baskets: int = SHARD_BASKETS, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(items, size, n, support) of every itemset with support >= ``min_support`` and size <= ``max_len``.

    Equal baskets are one row with a weight. They are dealt into shards of bounded size, and a set that is
    frequent is frequent in some shard at least. So each shard mines its own baskets, as bit rows of its
    frequent items, and then counts the sets that only other shards found. No basket is unfolded into
    pairs, and no list of items passes through the driver. Support is over all baskets, the empty ones
    included; a null item counts as none.
    """
    if max_len < 1:
        raise ValueError("max_len must be at least 1")
    items = F.sort_array(F.array_distinct(F.array_compact("items"))).alias("items")
    folded = materialize(baskets.select(F.coalesce(items, F.array().cast("array<string>")).alias("items")).groupBy("items").agg(F.count("*").alias("w")), "baskets")
    total, rows, held = folded.agg(F.sum("w"), F.count("*"), F.sum(F.size("items").cast("long"))).first()
    if not total:
        return baskets.sparkSession.createDataFrame([], "items array<string>, size int, n bigint, support double")
    n_shards = max(1, -(-rows // shard_baskets), -(-held // shard_items))
    sharded = folded.withColumn("shard", F.pmod(F.xxhash64("items"), F.lit(n_shards)))
    # The comparison by division is that of the result; a shard's own bound leaves room for rounding.
    share = min_support * (1 - 1e-9)

    def mine(table: pa.Table) -> pa.Table:
        least = share * sum(table.column("w").to_pylist())
        shard = Shard(table, least=least)
        found = [([shard.names[i] for i in places], n) for places, n in shard.frequent(max(least, 1), max_len)]
        return _local_table(found, table.column("shard")[0].as_py())

    local = sharded.groupBy("shard").applyInArrow(mine, _LOCAL)
    if n_shards > 1:
        local = materialize(local, "local-sets")
        shards = F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))
        missing = local.groupBy("items").agg(F.collect_list("shard").alias("seen")).select("items", F.explode(F.array_except(shards, "seen")).alias("at"))

        def recount(l: pa.Table, r: pa.Table) -> pa.Table:
            if not l.num_rows or not r.num_rows:
                return _local_table([], 0)
            sets = r.column("sets").to_pylist()
            shard = Shard(l, wanted=np.array(sorted({x for s in sets for x in s}), object))
            place = {name: i for i, name in enumerate(shard.names)}
            found = []
            for s in sets:
                if all(x in place for x in s):
                    found.append((s, int(shard.count(np.bitwise_and.reduce(shard.bits[[place[x] for x in s]], axis=0)))))
            return _local_table(found, 0)

        rest = missing.select(F.col("items").alias("sets"), "at")
        local = local.unionByName(sharded.groupBy("shard").cogroup(rest.groupBy("at")).applyInArrow(recount, _LOCAL))
    counts = local.groupBy("items").agg(F.sum("n").alias("n"))
    support = F.col("n") / F.lit(total)
    return materialize(counts.select("items", F.size("items").alias("size"), "n", support.alias("support")).filter(F.col("support") >= min_support), "itemsets")


# --- rules -------------------------------------------------------------------------------------------

def association_rules(itemsets: DataFrame, min_confidence: float = 0.0, min_lift: float = 0.0) -> DataFrame:
    """Every split of every itemset of size >= 2 into antecedents and consequents, with its 12 measures.

    Each proper subset is looked up by an equi join on the sorted array. Subsets of a frequent set are
    frequent, so no lookup can miss.
    """
    splits = (
        itemsets.filter("size >= 2").select("items", "support", F.explode(F.expr("sequence(1, shiftleft(1, size) - 2)")).alias("mask"))
        .select(
            "support",
            F.expr("filter(items, (x, i) -> bit_get(mask, i) = 1)").alias("antecedents"),
            F.expr("filter(items, (x, i) -> bit_get(mask, i) = 0)").alias("consequents"),
        )
    )
    a = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("_a"))
    c = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("_c"))
    measured = splits.join(a, "antecedents").join(c, "consequents").select(
        "antecedents", "consequents", *[m.alias(n) for n, m in rule_measures(F.col("_a"), F.col("_c"), F.col("support")).items()]
    )
    return measured.filter((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))


def set_text(c: Column) -> Column:
    """A set as text, in sorted order so that it is stable."""
    return F.array_join(F.array_sort(c), ", ")


def top_rules(rules: DataFrame, n: int, by: str = "lift") -> DataFrame:
    return rules.orderBy(F.desc(by), set_text(F.col("antecedents")), set_text(F.col("consequents"))).limit(n)


def rules_about(rules: DataFrame, item: str, side: str = "consequents") -> DataFrame:
    """Rules with the item on the given side."""
    return rules.filter(F.array_contains(side, item))


def rules_as_text(rules: DataFrame) -> DataFrame:
    """Output form: the two sets as text, ready for a CSV sink."""
    return rules.select(set_text(F.col("antecedents")).alias("antecedents"), set_text(F.col("consequents")).alias("consequents"), *MEASURES)


def top_itemsets(itemsets: DataFrame, n: int = 15) -> DataFrame:
    return itemsets.select(set_text(F.col("items")).alias("items"), "size", "n", "support").orderBy(F.desc("support"), "items").limit(n)


def itemset_lengths(itemsets: DataFrame) -> DataFrame:
    return itemsets.groupBy("size").agg(F.count("*").alias("n_itemsets"))


def measure_ranges(rules: DataFrame, measures: Sequence[str] = ("support", "confidence", "lift")) -> DataFrame:
    wide = rules.agg(*[F.struct(F.min(m).alias("min"), F.avg(m).alias("mean"), F.max(m).alias("max")).alias(m) for m in measures])
    return wide.unpivot([], list(measures), "measure", "s").select("measure", "s.*")


def support_sweep(itemsets: DataFrame, thresholds: Sequence[float], min_confidence: float = 0.5) -> DataFrame:
    """(min_support, n_itemsets, n_rules) per threshold from one mining at the smallest threshold.

    Exact, because support never grows with the set: what is frequent at a higher threshold is the part
    of the table at or above it.
    """
    grid = F.array(*[F.lit(float(t)) for t in thresholds])
    def counted(df: DataFrame, name: str) -> DataFrame:
        hit = df.select(F.explode(F.filter(grid, lambda t: t <= F.col("support"))).alias("min_support"))
        return hit.groupBy("min_support").agg(F.count("*").alias(name))
    dim = itemsets.sparkSession.createDataFrame([(float(t),) for t in thresholds], "min_support double")
    rules = association_rules(itemsets, min_confidence)
    return (
        dim.join(counted(itemsets, "n_itemsets"), "min_support", "left").join(counted(rules, "n_rules"), "min_support", "left")
        .na.fill(0, ["n_itemsets", "n_rules"])
    )


def lift_pivot(rules: DataFrame, consequents: Sequence[str] | None = None, n: int = 30) -> DataFrame:
    """Antecedents by consequents, highest lift in the cell, from the top ``n`` rules."""
    top = rules_as_text(top_rules(rules, n))
    return top.groupBy("antecedents").pivot("consequents", list(consequents) if consequents else None).agg(F.max("lift"))
