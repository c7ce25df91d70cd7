"""Source mixing: weights flow down a domain-language-source tree, shortages go to siblings first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bounded import Settled
from .common import staged, text_or_empty, unclash

TREE = ("domain", "lang", "source")
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}
DOMAIN_WEIGHTS = {"d0": 40, "d1": 30, "d2": 20, "d3": 10}
BUCKETS, LEVELS = 512, 2
HASH_SPAN = 1 << 60


def token_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def domain_of(source: Column) -> Column:
    """The table has no domain: sources are dealt to four domains by the number in their name."""
    number = F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS BIGINT)"), F.lit(0))
    return F.concat(F.lit("d"), (number % 4).cast("string"))


def weight_of(column: Column, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for value, weight in weights.items():
        out = F.when(column == value, weight).otherwise(out)
    return out.cast("long")


def order_hash(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A document's place in an epoch: 60 bits of md5."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def share_out(nodes: DataFrame, parent: list[str], child: str, budget: str = "budget") -> DataFrame:
    """Adds `given`: the parent's budget by weight, no child above its capacity, excess to the siblings.

    Children fill up in order of capacity / weight. After the k smallest are full, the rest share what is left
    in proportion to their weights; k is the first number for which none of the rest would overflow.
    """
    w = Window.partitionBy(*parent).orderBy((F.col("cap") / F.col("weight")).asc(), child)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(0, Window.unboundedFollowing)
    n = (nodes.withColumn("_left", F.col(budget) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("_open", F.sum("weight").over(after))
         .withColumn("_full", F.col("cap") * F.col("_open") <= F.col("_left") * F.col("weight"))
         # A child is full only if all before it are.
         .withColumn("_full", F.min(F.col("_full").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 1))
    whole = Window.partitionBy(*parent)
    left = F.col(budget) - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(whole), F.lit(0))
    open_ = F.sum(F.when(~F.col("_full"), F.col("weight"))).over(whole)
    return (n.withColumn("_l", left).withColumn("_o", open_)
            .withColumn("given", F.when(F.col("_full"), F.col("cap")).otherwise(F.expr("(weight * _l) div _o")).cast("long"))
            .drop("_left", "_open", "_full", "_l", "_o"))


def budgets(stats: DataFrame, target: Column | int, max_epochs: int, leaf_weight: int = 1) -> DataFrame:
    """Leaf budgets. `stats` has one row per leaf: the tree columns and `tokens`."""
    top = stats.where("tokens > 0").withColumn("cap", F.col("tokens") * max_epochs)
    domains = (top.groupBy("domain").agg(F.sum("cap").alias("cap"))
               .withColumn("weight", weight_of(F.col("domain"), DOMAIN_WEIGHTS, 10)))
    target = target if isinstance(target, Column) else F.lit(target)
    total = F.sum("cap").over(Window.partitionBy("_all"))
    root = domains.withColumn("_all", F.lit(0)).withColumn("budget", F.least(total, target.cast("long")))
    d = share_out(root, ["_all"], "domain").select("domain", F.col("given").alias("budget"))
    langs = (top.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
             .withColumn("weight", weight_of(F.col("lang"), LANG_WEIGHTS, 10)).join(d, "domain"))
    l = share_out(langs, ["domain"], "lang").select("domain", "lang", F.col("given").alias("budget"))
    leaves = top.withColumn("weight", F.lit(leaf_weight).cast("long")).join(l, ["domain", "lang"])
    return share_out(leaves, ["domain", "lang"], "source").select(*TREE, "tokens", F.col("given").alias("budget"))


def _leaf() -> list[Column]:
    lang, source = F.coalesce("lang", F.lit("?")), F.coalesce("source", F.lit("?"))
    return [domain_of(source).alias("domain"), lang.alias("lang"), source.alias("source")]


def plan_mix(documents: DataFrame, share: float, max_epochs: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(slim, cuts): doc_id, leaf and tokens of every document with tokens; whole epochs and cut of every leaf."""
    slim = staged(documents.select("doc_id", *_leaf(), token_count(text_or_empty()).alias("tokens")).where("tokens > 0"), "mix")
    stats = slim.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"))
    total = slim.agg(F.sum("tokens")).first()[0] or 0
    leaves = staged(budgets(stats, int(total * share), max_epochs).withColumn("epochs", F.expr("budget div tokens").cast("int"))
                    .withColumn("rest", F.expr("budget % tokens")).withColumnRenamed("tokens", "leaf_tokens"), "leaves")
    return slim, staged(_cuts(slim, leaves, seed), "cut")


def times_taken(doc_id: Column, epochs: Column, cut: Column, seed: int) -> Column:
    return epochs + F.when(order_hash(seed, epochs, doc_id) <= cut, 1).otherwise(0)


def mix_sources(documents: DataFrame, share: float = 0.5, max_epochs: int = 3, seed: int = 7) -> DataFrame:
    """doc_id, the tree columns, tokens and epoch: a row per document and epoch in which it is taken.

    The target is `share` of all tokens. A leaf's budget buys whole epochs first, then the documents of the next
    epoch in seeded order while their running sum of tokens stays within the rest. Null lang or source is the
    leaf '?'. Documents without tokens have no weight in a mix and are left out. Rows that repeat a doc_id share
    its place: all of them are taken or none. An empty table gives no rows.
    """
    slim, cuts = plan_mix(documents, share, max_epochs, seed)
    times = times_taken(F.col("doc_id"), F.col("epochs"), F.col("cut"), seed)
    return (slim.join(Settled(cuts).side(), list(TREE)).withColumn("_times", times).where("_times > 0")
            .select("doc_id", *TREE, "tokens", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)).alias("epoch")))


def mix_documents(documents: DataFrame, share: float = 0.9, seed: int = 7) -> DataFrame:
    """The documents that one epoch of the mix takes, with all their columns; texts are filtered where they are read."""
    _, cuts = plan_mix(documents, share, 1, seed)
    leaf, cut = unclash(documents, name="_leaf"), unclash(documents, name="_cut")
    side = Settled(cuts.select(F.struct(*TREE).alias(leaf), F.struct("epochs", "cut").alias(cut))).side()
    taken = times_taken(F.col("doc_id"), F.col(f"{cut}.epochs"), F.col(f"{cut}.cut"), seed) > 0
    return (documents.withColumn(leaf, F.struct(*_leaf())).join(side, leaf).where(taken & (F.octet_length("text") > 0))
            .select(*[documents[c] for c in documents.columns]))


def _cuts(slim: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Per leaf the last order hash whose running token sum stays within `rest` (-1: none).

    The place where the budget ends is found by descent: sums per leaf and hash bucket, combined before they are
    shuffled, name the bucket that holds it, and only that bucket is divided again, then read row by row.
    """
    state, span = leaves.withColumn("low", F.lit(0).cast("long")).withColumn("used", F.lit(0).cast("long")), HASH_SPAN
    for _ in range(LEVELS):
        step = span // BUCKETS
        sums = (_between(slim, state, span, seed).withColumn("bucket", F.expr(f"(h - low) div {step}"))
                .groupBy(*TREE, "bucket").agg(F.sum("tokens").alias("n"), *[F.first(c).alias(c) for c in ("rest", "low", "used")])
                .withColumn("upto", F.col("used") + F.sum("n").over(Window.partitionBy(*TREE).orderBy("bucket"))))
        edge = (sums.where("upto > rest").groupBy(*TREE)
                .agg(F.min_by(F.struct((F.col("low") + F.col("bucket") * step).alias("low"), (F.col("upto") - F.col("n")).alias("used")),
                              "bucket").alias("e")))
        state = staged(leaves.join(edge, list(TREE)).select(*TREE, "epochs", "rest", "e.low", "e.used"), "cuts")
        span = step
    inside = (_between(slim, state, span, seed).groupBy(*TREE, "h")
              .agg(F.sum("tokens").alias("n"), F.first("rest").alias("rest"), F.first("used").alias("used"))
              .withColumn("upto", F.col("used") + F.sum("n").over(Window.partitionBy(*TREE).orderBy("h"))))
    last = inside.where("upto <= rest").groupBy(*TREE).agg(F.max("h").alias("last"))
    return state.join(last, list(TREE), "left").select(*TREE, "epochs", F.coalesce("last", F.col("low") - 1).alias("cut"))


def _between(slim: DataFrame, state: DataFrame, span: int, seed: int) -> DataFrame:
    h = order_hash(seed, F.col("epochs"), F.col("doc_id"))
    side = Settled(state.select(*TREE, "epochs", "rest", "low", "used")).side()
    return slim.join(side, list(TREE)).withColumn("h", h).where(F.col("h").between(F.col("low"), F.col("low") + (span - 1)))
