"""Mixing sources to target weights by hierarchical budgeting.

Documents are the leaves' content of a tree (domain, language, source).  A token budget flows from the root down: each
node divides its own among its children by their weights, but none gets more than its subtree holds (``max_epochs`` times
its tokens).  What a child cannot take goes to its siblings, by weight, and only what a whole family cannot take reaches
the family above; so shortages are filled by siblings before ancestors.

A leaf reads its documents in epochs, each in an order of its own that the seed gives, and takes the longest prefix of
that sequence whose tokens stay within its budget: whole epochs, then documents of one more until the next would exceed.

Everything is DataFrame operations.  What is sorted as a whole is the tree's nodes; the documents of a leaf are summed by
leading bits of their place in the order, and only those of the one bit pattern where the budget ends are sorted, so a leaf
with a third of all documents is spread over all tasks.  Cuts are joined to documents by leaf.

Defined results: a null in a level is a child of its own; a null or empty text has no tokens and is taken if its place comes
before the cut, or its leaf has no tokens at all; a null doc_id has its own place; rows that share a doc_id are taken together; weights of 0 get nothing,
values without a weight have ``default_weight``; an empty table gives an empty result; other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tilescan.llm.common import cut

BUCKET_BITS = 12
# fixed values: shares of the languages for the registered queries
LANGUAGE_WEIGHTS = {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}


def word_count(text: Column) -> Column:
    """Words between ASCII white space, of a null none."""
    trimmed = F.trim(F.translate(text, "\t\n\r\x0b\x0c", "     "))
    return F.when(text.isNull() | (trimmed == ""), F.lit(0)).otherwise(F.size(F.split(trimmed, " +"))).cast("long")


def domain_of(source: Column) -> Column:
    """The domain of a source of the test tables: its number modulo 4."""
    return F.concat(F.lit("domain"), F.pmod(F.regexp_extract(F.coalesce(source, F.lit("")), r"(\d+)$", 1).try_cast("long"), F.lit(4)).cast("string"))


def _place(seed: int, epoch: Column) -> Column:
    """The place of a document in an epoch's order: 62 bits, a pure function of seed, epoch and doc_id."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), epoch.cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1).cast("long")), F.col("doc_id").isNull()), 2)


def fair_total(totals: DataFrame, weights: dict[str, dict[str, float]], max_epochs: int) -> float:
    """The largest total of which the values with given weights can have their shares, from all that the corpus holds of them."""
    out = float(totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]) * max_epochs
    for level, given in weights.items():
        held = {r[0]: r[1] for r in totals.where(F.col(level).isin(list(given))).groupBy(level).agg(F.sum("tokens")).collect()}  # as many as weights
        share = {v: w for v, w in given.items() if w > 0 and held.get(v)}
        out = min([out, *(held[v] * max_epochs * sum(share.values()) / w for v, w in share.items())])
    return out


def budgets(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], total: float | Column, default_weight: float = 1.0) -> DataFrame:
    """Each row of ``leaves`` (levels, ``capacity``) with its ``budget``.  ``total`` is the root's budget."""
    nodes = leaves
    sums = {0: leaves.agg(F.sum("capacity").alias("capacity"))}
    for k in range(1, len(levels) + 1):
        sums[k] = leaves.groupBy(*levels[:k]).agg(F.sum("capacity").alias("capacity"))
    above = sums[0].select(F.least(F.lit(float(total)), F.col("capacity").cast("double")).alias("given"))
    for k, level in enumerate(levels, 1):
        given = weights.get(level, {})
        weight = F.lit(float(default_weight))
        for value, w in given.items():
            weight = F.when(F.col(level) == value, F.lit(float(w))).otherwise(weight)
        nodes = sums[k].withColumn("weight", weight)
        if k == 1:
            nodes = nodes.crossJoin(F.broadcast(above))  # one row
        else:
            up = above.select(*(F.col(c).alias(f"up_{c}") for c in levels[: k - 1]), "given")
            nodes = nodes.join(up, [nodes[c].eqNullSafe(up[f"up_{c}"]) for c in levels[: k - 1]]).drop(*(f"up_{c}" for c in levels[: k - 1]))
        family = levels[: k - 1] or [F.lit(1)]
        # children in the order in which a rising level of budget per weight fills them
        order = W.partitionBy(*family).orderBy(F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight")).asc_nulls_last(), F.col(level).asc_nulls_first())
        nodes = (
            nodes.withColumn("filled", F.coalesce(F.sum(F.col("capacity").cast("double")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
            .withColumn("left", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
            .withColumn("full", (F.col("weight") > 0) & (F.col("capacity") * F.col("left") <= (F.col("given") - F.col("filled")) * F.col("weight") * (1 + 1e-12)))
            .withColumn("rest", F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("capacity").cast("double"))).over(W.partitionBy(*family)), F.lit(0.0)))
            .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(W.partitionBy(*family)))
            .withColumn("share", F.when(F.col("full"), F.col("capacity").cast("double")).when(F.col("open") > 0, F.greatest(F.lit(0.0), F.col("rest")) * F.col("weight") / F.col("open")).otherwise(0.0))
        )
        above = nodes.select(*levels[:k], F.col("share").alias("given"))
    up = above.select(*(F.col(c).alias(f"up_{c}") for c in levels), F.col("given").alias("budget"))
    return leaves.join(up, [leaves[c].eqNullSafe(up[f"up_{c}"]) for c in levels]).drop(*(f"up_{c}" for c in levels))


def cuts(narrow: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], fraction: float | None, max_epochs: int, seed: int, default_weight: float = 1.0) -> DataFrame:
    """By leaf: ``epochs`` taken whole, and the ``last_place`` taken of one more (-1: none), of ``narrow`` (doc_id, levels, tokens).

    Documents of one place (rows that share a doc_id, or a null one) are taken or left together.
    """
    totals = cut(narrow.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), (F.sum("tokens") * max_epochs).alias("capacity")))
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    given = budgets(totals, levels, weights, fair_total(totals, weights, max_epochs) if fraction is None else fraction * whole, default_weight)
    # a billionth of a token of slack for what rounding takes
    leaf = cut(
        given.withColumn("epochs", F.when(F.col("tokens") > 0, F.floor((F.col("budget") + 1e-6) / F.col("tokens"))).otherwise(0).cast("long"))
        .withColumn("room", F.floor(F.col("budget") + 1e-6).cast("long") - F.col("epochs") * F.col("tokens"))
        .select(*levels, "epochs", "room", "budget", "tokens")
        .withColumn("leaf", F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in levels), *(F.col(c).isNull() for c in levels)))
    )
    marked = narrow.withColumn("leaf", F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in levels), *(F.col(c).isNull() for c in levels)))
    placed = marked.join(leaf.select("leaf", "epochs", "room"), "leaf").withColumn("place", _place(seed, F.col("epochs"))).withColumn("bucket", F.shiftright("place", 62 - BUCKET_BITS))
    sums = placed.groupBy("leaf", "bucket").agg(F.sum("tokens").alias("t"), F.first("room").alias("room"))
    running = sums.withColumn("upto", F.sum("t").over(W.partitionBy("leaf").orderBy("bucket")))
    edge = running.where("upto > room").groupBy("leaf").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("t")).alias("before")), "bucket").alias("e")).select("leaf", F.col("e.bucket").alias("bucket"), F.col("e.before").alias("before"))
    inside = placed.join(edge, ["leaf", "bucket"]).groupBy("leaf", "place").agg(F.sum("tokens").alias("t"), F.first("room").alias("room"), F.first("before").alias("before"))
    within = inside.withColumn("upto", F.col("before") + F.sum("t").over(W.partitionBy("leaf").orderBy("place"))).where("upto <= room").groupBy("leaf").agg(F.max("place").alias("last"))
    return leaf.join(edge, "leaf", "left").join(within, "leaf", "left").select(
        *levels,
        "epochs",
        # all of the edge's bucket before its last place; only a leaf without tokens has no edge, and all of it fits
        F.when(F.col("bucket").isNull(), F.lit((1 << 62) - 1))
        .otherwise(F.coalesce("last", F.shiftleft(F.col("bucket"), 62 - BUCKET_BITS) - 1))
        .alias("last_place"),
        "budget",
        F.col("tokens").alias("leaf_tokens"),
    )


def mixed(docs: DataFrame, fraction: float | None = 1.0, max_epochs: int = 2, seed: int = 17, weights: dict[str, dict[str, float]] | None = None, max_leaves: int = 50_000, prefix: str = "", tokens: str | None = None) -> DataFrame:
    """``docs`` with ``domain``, ``n_words`` (the tokens that budgets count), ``n_copies`` (how often a row is taken) and the
    leaf's ``budget``, their names after ``prefix``; columns of ``docs`` with these names are replaced.

    Tokens are those between white space, or what the column ``tokens`` says (null: none), as of a tokenizer.  The budget is
    ``fraction`` of all tokens; None: the largest one of which every value with a given weight can have its share.

    The leaves' cuts are broadcast if there are at most ``max_leaves`` (counted first), and joined by shuffle otherwise.
    """
    weights = {"lang": LANGUAGE_WEIGHTS} if weights is None else weights
    weights = {f"{prefix}domain" if k == "domain" else k: v for k, v in weights.items()}
    domain, words = f"{prefix}domain", f"{prefix}n_words"
    levels = [domain, "lang", "source"]
    named = docs.withColumn(domain, domain_of(F.col("source"))).withColumn(words, word_count(F.col("text").cast("string")) if tokens is None else F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long")))
    narrow = cut(named.select(F.col("doc_id").cast("long").alias("doc_id"), *levels, F.col(words).alias("tokens")))
    found = cut(cuts(narrow, levels, weights, fraction, max_epochs, seed))
    side = found.select(*(F.col(c).alias(f"__cut_{c}") for c in levels), F.col("epochs").alias("__cut_epochs"), F.col("last_place").alias("__cut_last"), F.col("budget").alias("__cut_budget"))
    if found.count() <= max_leaves:
        side = F.broadcast(side)
    joined = named.join(side, [F.col(c).eqNullSafe(F.col(f"__cut_{c}")) for c in levels])
    copies = F.least(F.lit(max_epochs).cast("long"), F.col("__cut_epochs") + (_place(seed, F.col("__cut_epochs")) <= F.col("__cut_last")).cast("long"))
    return joined.withColumn(f"{prefix}n_copies", copies).withColumn(f"{prefix}budget", F.col("__cut_budget")).drop(*(f"__cut_{c}" for c in [*levels, "epochs", "last", "budget"]))


def selected(docs: DataFrame, fraction: float | None = None, max_epochs: int = 1, seed: int = 17, weights: dict[str, dict[str, float]] | None = None, tokens: str | None = None) -> DataFrame:
    """The rows of ``docs`` in the mixture, as often as they are taken, with the columns of ``docs``."""
    rows = mixed(docs, fraction, max_epochs, seed, weights, prefix="__", tokens=tokens).where("__n_copies > 0")
    if max_epochs > 1:
        rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n_copies"))))
    return rows.select(*docs.columns)
