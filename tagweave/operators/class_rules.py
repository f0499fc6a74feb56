"""Rules that conclude a label, mined label by label.

A prediction needs only the minimal antecedents of a label: token sets that reach
support and confidence while none of their subsets does, because a basket that holds
any valid set holds a minimal one. So a valid set is never extended, nor is a set
that holds in the same posts as a subset of it, which is what makes the many
subsets of near copies collapse. Tokens that are valid alone, by far the most, come
from one aggregate. The posts are then projected, per label, to the tokens that are
frequent with the label but not valid; equal projections are counted once.

Each projection is dealt to the conditional base of every token it has: the more
frequent tokens that follow it. Bases of bounded size are searched depth first, one
at a time in a task; larger ones are cut again by their next token.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.arrow import sorted_groups
from tagweave.operators.lookup import heavy_by_count, lookup
from tagweave.operators.mining import Mined
from tagweave.operators.ordering import ordered_index
from tagweave.operators.rows import explode_rows
from tagweave.operators.rule_tree import build_tree, match_rules
from tagweave.operators.skew import skew_join
from tagweave.operators.split import training_rows
from tagweave.options import Options
from tagweave.sources.tables import materialize

# Cells, distinct projections by tokens that may follow, of a base that one task searches.
LARGEST_BASE = 4_000_000
# Cells that are turned to numbers at a time.
_BLOCK = 1_000_000
_BASE = ["label", "prefix"]
_FOUND = "label string, codes array<int>, freq long, n long"


def least_support(n_posts: int, opts: Options) -> int:
    return opts.support_count if opts.min_support is None else max(1, ceil(opts.min_support * n_posts))


def _valid(opts: Options) -> Column:
    return F.col("freq") / F.col("n") >= opts.min_confidence


def _pair_sums(counts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every two tokens the sums of both counts, by blocks of rows, so that no copy of ``held`` as numbers is made whole."""
    step = max(1, _BLOCK // max(held.shape[1], 1))
    total = [np.zeros((held.shape[1], held.shape[1])) for _ in counts]
    for at in range(0, len(held), step):
        some = held[at : at + step].astype(np.float64)
        for sums, c in zip(total, counts, strict=True):
            sums += some.T @ (some * c[at : at + step, None])
    return total[0], total[1]


def _merged(held: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sums of their counts."""
    packed = np.ascontiguousarray(np.packbits(held, axis=1))
    _, at, of = np.unique(packed.view(f"V{packed.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return held[at], np.stack([np.bincount(of, c, len(at)) for c in counts])


def _may_hold(counts: np.ndarray, support: int, confidence: float) -> bool:
    """Whether any choice of whole rows, and parts of one, reaches support and confidence.

    A longer set holds in some of the rows. What they can reach at best is to take
    all rows that are confident by themselves and, short of support, those that
    cost the least confidence for each post with the label.
    """
    freq, n = counts
    gain = freq - confidence * n
    sure = gain >= 0
    missing, left = support - freq[sure].sum(), gain[sure].sum()
    if missing <= 0:
        return True
    some = np.flatnonzero(~sure & (freq > 0))
    cost = gain[some] / freq[some]
    some, cost = some[np.argsort(-cost)], np.sort(cost)[::-1]
    before = np.cumsum(freq[some]) - freq[some]
    taken = np.clip(missing - before, 0, freq[some])
    return taken.sum() >= missing and left + (taken * cost).sum() >= -1e-9 * n.sum()


def _search(
    codes: np.ndarray, lengths: np.ndarray, freq: np.ndarray, n: np.ndarray, prefix: list[int], support: int, opts: Options
) -> Iterator[tuple[list[int], int, int]]:
    """Valid sets that extend ``prefix``, with their counts with the label and in all.

    ``codes`` are those of all rows, one row after the other, ``lengths`` how many
    each has. A set gets the counts of its extensions by any two tokens at once.
    Tokens that cannot be part of a longer valid set leave the rows on the way
    down, rows that become equal are merged, those with fewer than two tokens go,
    and a set whose rows can nowhere reach confidence is not extended.
    """
    codes, flat = np.unique(codes, return_inverse=True)
    held = np.zeros((len(lengths), len(codes)), bool)
    held[np.repeat(np.arange(len(lengths)), lengths), flat] = True
    counts = np.stack([freq, n]).astype(np.float64)  # exact below 2 ** 53
    with_label, in_all = (np.bincount(flat, np.repeat(c, lengths), len(codes)) for c in counts)
    most = len(prefix) + len(codes) if opts.max_antecedent is None else opts.max_antecedent

    def judged(with_label: np.ndarray, in_all: np.ndarray, of_subset: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        enough = with_label >= max(support, 1)
        good = enough & (with_label / np.maximum(in_all, 1) >= opts.min_confidence)
        return good, enough & ~good & (in_all < of_subset)

    good, grows = judged(with_label, in_all, counts[1].sum())
    for j in np.flatnonzero(good).tolist():
        yield [*prefix, int(codes[j])], int(with_label[j]), int(in_all[j])
    todo = [(prefix, held, codes, counts, None, np.flatnonzero(grows), in_all[grows])]
    while todo:
        items, held, codes, counts, k, some, alone = todo.pop()
        if len(items) + 2 > most:
            continue
        if k is not None:  # cut here, so that only the sets on the way down hold rows
            items, held, counts = [*items, int(codes[k])], held[held[:, k]], counts[:, held[:, k]]
        held, codes = held[:, some], codes[some]
        several = held.sum(axis=1) > 1
        if not several.any():
            continue
        held, counts = _merged(held[several], counts[:, several])
        if not _may_hold(counts, support, opts.min_confidence):
            continue
        with_label, in_all = _pair_sums(counts, held)
        good, grows = judged(with_label, in_all, np.minimum(alone[:, None], alone))
        for j, other in np.argwhere(np.triu(good, 1)).tolist():
            yield [*items, int(codes[j]), int(codes[other])], int(with_label[j, other]), int(in_all[j, other])
        grows = np.triu(grows, 1)
        for j in np.flatnonzero(grows.sum(axis=1) > 1).tolist():
            after = np.flatnonzero(grows[j])
            todo.append((items, held, codes, counts, j, after, in_all[j, after]))


def _search_bases(bases: DataFrame, support: int, opts: Options) -> DataFrame:
    """Search whole bases; the rows of one stand together in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("label", pa.string()), ("codes", pa.list_(pa.int32())), ("freq", pa.int64()), ("n", pa.int64())])
        found: list[tuple] = []
        for group in sorted_groups(batches, ("label", "key")):
            label, prefix = group.column("label")[0].as_py(), group.column("prefix")[0].as_py()
            freq, n = group.column("freq").to_numpy(), group.column("n").to_numpy()
            rest = group.column("rest").combine_chunks()
            codes, lengths = rest.flatten().to_numpy(), rest.value_lengths().to_numpy()
            for one in _search(codes, lengths, freq, n, prefix, support, opts):
                found.append((label, *one))
                if len(found) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)
                    found = []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    key = F.array_join(F.col("prefix").cast("array<string>"), " ")
    dealt = bases.select("label", key.alias("key"), "prefix", "rest", "freq", "n")
    dealt = dealt.repartition("label", "key").sortWithinPartitions("label", "key")
    return dealt.mapInArrow(run, _FOUND)


def _cut(bases: DataFrame) -> DataFrame:
    """Each row to the bases of its tokens, with the tokens that follow; equal rows are one."""
    pieces = F.transform(
        F.sequence(F.lit(1), F.size("rest") - 1),
        lambda i: F.struct(F.element_at("rest", i).alias("code"), F.slice("rest", i + 1, F.size("rest")).alias("rest")),
    )
    some = bases.where(F.size("rest") > 1).select("label", "prefix", "freq", "n", F.explode(pieces).alias("piece"))
    longer = F.concat("prefix", F.array("piece.code")).alias("prefix")
    return some.select("label", longer, F.col("piece.rest").alias("rest"), "freq", "n").groupBy(*_BASE, "rest").agg(
        F.sum("freq").alias("freq"), F.sum("n").alias("n")
    )


def _extensions(bases: DataFrame, support: int) -> DataFrame:
    """``label, prefix, code`` with counts, of every frequent extension of a base by one token."""
    long = bases.select(*_BASE, F.explode("rest").alias("code"), "freq", "n")
    return long.groupBy(*_BASE, "code").agg(F.sum("freq").alias("freq"), F.sum("n").alias("n")).where(F.col("freq") >= support)


def _search_all(bases: DataFrame, widths: DataFrame, support: int, opts: Options, largest: int) -> DataFrame:
    """All valid sets of two tokens or more, not yet minimal. ``bases`` have prefixes of one token."""
    found = []
    bases = materialize(bases, "label-bases")
    level = 1
    while True:
        sizes = bases.groupBy(*_BASE).agg(F.count("*").alias("rows")).join(widths, "label")
        large = materialize(sizes.where(F.col("rows") * F.col("width") > largest).select(*_BASE), "large-bases")
        n_large = large.count()
        if not n_large:
            found.append(materialize(_search_bases(bases, support, opts), "label-sets"))
            break
        marked = skew_join(bases, large.withColumn("large", F.lit(True)), _BASE, "left")
        marked = materialize(marked, "marked-bases")
        found.append(materialize(_search_bases(marked.where("large IS NULL"), support, opts), "label-sets"))
        rest = marked.where("large").drop("large")
        totals = rest.groupBy(*_BASE).agg(F.sum("n").alias("of_base"))
        grown = skew_join(_extensions(rest, support), totals, _BASE, right_unique=True)
        grown = materialize(grown, "grown-sets")
        whole = F.concat("prefix", F.array("code"))
        found.append(grown.where(_valid(opts)).select("label", whole.alias("codes"), "freq", "n"))
        level += 1
        if opts.max_antecedent is not None and level >= opts.max_antecedent:
            break
        kept = grown.where(~_valid(opts) & (F.col("n") < F.col("of_base"))).select("label", whole.alias("prefix"))
        # Tokens that cannot follow stay in the rows: they are only counted again.
        bases = materialize(skew_join(_cut(rest), kept, _BASE, right_unique=True), "label-bases")
    sets = found[0]
    for more in found[1:]:
        sets = sets.unionByName(more)
    return sets


def _minimal(sets: DataFrame, names: DataFrame) -> DataFrame:
    """The sets of a label of which no other is a subset; pairs always are, as no token of them is valid alone."""
    numbered = materialize(sets.withColumn("rule", F.monotonically_increasing_id()), "numbered-sets")
    # The label is an item as well, so sets of other labels are not met.
    items = F.concat(F.array(F.concat(F.lit("label "), "label")), F.col("codes").cast("array<string>"))
    tree = build_tree(numbered.select("rule", items.alias("antecedent")), names.select(F.col("code").cast("string").alias("item"), "freq"))
    longer = numbered.where(F.size("codes") > 2).select("rule", items.alias("items"))
    met = match_rules(longer.withColumnRenamed("rule", "row"), tree, "row", "items")
    beaten = materialize(met.where(F.col("row") != F.col("rule")).select(F.col("row").alias("rule")).distinct(), "beaten-sets")
    return numbered.join(beaten, "rule", "left_anti")


def fit_label_rules(baskets: DataFrame, opts: Options, largest_base: int = LARGEST_BASE) -> Mined:
    """All minimal rules from tokens to a label, learned from the training baskets.

    ``baskets`` have ``tokens, labels, set``; repeats within a basket count once,
    and null tokens or labels as none. The result's rules have ``antecedent,
    consequent, confidence, freq`` and its itemsets are the single tokens, so it
    serves :func:`tagweave.operators.mining.predict`, which then predicts the same
    labels as with every rule of that support and confidence. Nothing passes through
    the driver. The search takes as long as there are frequent sets that are not
    valid; ``max_antecedent`` bounds them.
    """
    empty = F.array().cast("array<string>")
    training = training_rows(baskets).select(
        F.array_distinct(F.coalesce("tokens", empty)).alias("tokens"), F.array_distinct(F.coalesce("labels", empty)).alias("labels")
    )
    training = materialize(training.withColumn("post", F.monotonically_increasing_id()), "training-baskets")
    support = least_support(training.count(), opts)

    # Single tokens, and pairs of a token and a label: one aggregate each, combined before it shuffles.
    long = explode_rows(training, ["labels"], "tokens", "item")
    singles = long.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= support)
    singles = materialize(singles, "single-tokens")
    pairs = explode_rows(long, ["item"], "labels", "label").groupBy("item", "label").agg(F.count("*").alias("freq"))
    pairs = materialize(pairs.where(F.col("freq") >= support).join(singles, "item"), "token-labels")
    alone = pairs.where(_valid(opts)).select("label", F.array("item").alias("antecedent"), "freq", "n")

    open_pairs = pairs.where(~_valid(opts))
    tokens = open_pairs.groupBy("item").agg(F.max("n").alias("freq"), F.collect_set("label").alias("open"))
    names = materialize(ordered_index(tokens, [F.asc("freq"), F.asc("item")], "code"), "open-tokens")
    mined = Mined(singles.select(F.array("item").alias("items"), F.col("n").alias("freq")), _as_rules(alone))
    if opts.max_antecedent == 1 or names.isEmpty():
        return Mined(mined.itemsets, materialize(mined.rules, "label-rules"))

    # Per post and label, the tokens that are open for it. The labels of a token lie in its row.
    found = lookup(explode_rows(training, ["post", "labels"], "tokens", "item"), names, ["item"], heavy_by_count(names, "freq"), "post")
    open_labels = found.where(F.col("code").isNotNull()).select("post", "labels", "code", F.explode("open").alias("label"))
    projected = open_labels.groupBy("post", "label").agg(
        F.sort_array(F.collect_list("code")).alias("rest"), F.max(F.array_contains("labels", F.col("label")).cast("long")).alias("freq")
    )
    root = F.array().cast("array<int>").alias("prefix")
    projected = projected.where(F.size("rest") > 1).groupBy("label", "rest").agg(F.sum("freq").alias("freq"), F.count("*").alias("n"))
    widths = materialize(open_pairs.groupBy("label").agg(F.count("*").alias("width")), "label-widths")
    sets = _search_all(_cut(projected.select("label", root, "rest", "freq", "n")), widths, support, opts, largest_base)
    minimal = materialize(_minimal(sets, names), "minimal-sets")
    spelling = names.select("code", "item", F.col("freq").alias("uses"))
    spelled = explode_rows(minimal, ["rule", "label", "freq", "n"], "codes", "code")
    spelled = lookup(spelled, spelling, ["code"], heavy_by_count(spelling, "uses"), "rule")
    spelled = spelled.groupBy("rule", "label", "freq", "n").agg(F.sort_array(F.collect_list("item")).alias("antecedent"))
    rules = mined.rules.unionByName(_as_rules(spelled))
    return Mined(mined.itemsets, materialize(rules, "label-rules"))


def _as_rules(found: DataFrame) -> DataFrame:
    return found.select("antecedent", F.array("label").alias("consequent"), (F.col("freq") / F.col("n")).alias("confidence"), "freq")
