"""Market basket: V9 product pairs, V11 association rules, B11, B12.

Baskets are the distinct (order, product) rows of completed orders, so a
product bought twice in one order counts once (COUNT DISTINCT order).  Pairs
are made inside a basket's row (``operators.pairs``) and product names are
joined after the threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillscope.functions.common import exact_int, round_ratio
from tillscope.operators.pairs import pair_counts
from tillscope.operators.topk import top_k
from tillscope.plans.shared import per_star
from tillscope.sources.star import Star

MIN_ORDERS = 5


def _lines(star: Star, item: str = "product_id") -> DataFrame:
    """(order_id, item) of the lines of completed orders, repeats included."""
    done = star.completed_orders().select("order_id")
    return star.items.select("order_id", item).join(done, "order_id", "left_semi")


def baskets(star: Star, item: str = "product_id") -> DataFrame:
    """Distinct (order_id, item) over lines of completed orders."""
    return _lines(star, item).distinct()


def _names(df: DataFrame, star: Star) -> DataFrame:
    p = star.product.select("product_id", "product_name")
    p1 = p.select(F.col("product_id").alias("product_id_1"), F.col("product_name").alias("product_name_1"))
    p2 = p.select(F.col("product_id").alias("product_id_2"), F.col("product_name").alias("product_name_2"))
    return df.join(p1, "product_id_1").join(p2, "product_id_2")


def pair_table(star: Star, min_orders: int = MIN_ORDERS, item_counts: bool = True) -> DataFrame:
    """Frequent product pairs with their counts: a lazy plan, kept only by a sharing star (``plans.shared``)."""
    if star.shared is not None:  # one table serves the pairs and the rules
        item_counts = True
    return per_star(star, ("pairs", min_orders),
                    lambda: pair_counts(_lines(star), "order_id", "product_id", min_orders, item_counts=item_counts))


def _pairs(star: Star, min_orders: int) -> DataFrame:
    pc = pair_table(star, min_orders, item_counts=False)
    return pc.select(F.col("item_1").alias("product_id_1"), F.col("item_2").alias("product_id_2"),
                     F.col("n").alias("cooccurrence_orders"))


def product_pairs(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    """V9: product pairs (id_1 < id_2) bought together in at least ``min_orders`` completed orders."""
    return _names(_pairs(star, min_orders), star).select(
        "product_id_1", "product_name_1", "product_id_2", "product_name_2", "cooccurrence_orders")


def _rules(star: Star, min_orders: int) -> DataFrame:
    pc = pair_table(star, min_orders).select(
        F.col("item_1").alias("product_id_1"), F.col("item_2").alias("product_id_2"),
        F.col("n").alias("cooccurrence_orders"), F.col("n_1").alias("_p1"), F.col("n_2").alias("_p2"))
    # denominator: completed orders with or without lines, a scalar subquery
    total = star.completed_orders().agg(F.count("order_id")).scalar()
    return _names(pc.withColumn("_t", total), star)


def association_rules(star: Star, min_orders: int = MIN_ORDERS) -> DataFrame:
    """Support, both confidences and lift of each frequent pair.

    Ratios are exact counts cast to double once, then divided:
    support = n/t, confidence = n/p, lift = (n·t)/(p₁·p₂).
    """
    r = _rules(star, min_orders)
    n, t, p1, p2 = (F.col(c).cast("double") for c in ("cooccurrence_orders", "_t", "_p1", "_p2"))
    return r.select(
        "product_id_1", "product_name_1", "product_id_2", "product_name_2", "cooccurrence_orders",
        (n / t).alias("support"),
        (n / p1).alias("confidence_1_to_2"),
        (n / p2).alias("confidence_2_to_1"),
        ((n * t) / (p1 * p2)).alias("lift"),
    )


def top_pairs(star: Star, k: int = 20, min_orders: int = MIN_ORDERS) -> DataFrame:
    """The k most frequent pairs of V9 with an 'a & b' label."""
    best = top_k(product_pairs(star, min_orders), [F.col("cooccurrence_orders").desc()], k,
                 tie=[F.col("product_id_1").asc(), F.col("product_id_2").asc()])
    return best.select("product_name_1", "product_name_2", "cooccurrence_orders",
                        F.concat("product_name_1", F.lit(" & "), "product_name_2").alias("pair_label"))


def top_rules(star: Star, k: int = 20, min_orders: int = MIN_ORDERS) -> DataFrame:
    """The k rules of V11 with the highest lift (rounded to 4, as sorted), with an 'a → b' label."""
    r = _rules(star, min_orders)
    n, t = F.col("cooccurrence_orders"), F.col("_t")
    p1, p2 = F.col("_p1"), F.col("_p2")
    lift4 = round_ratio(exact_int(n) * exact_int(t), exact_int(p1) * exact_int(p2), 4)
    ranked = r.withColumn("lift", lift4)
    best = top_k(ranked, [F.col("lift").desc()], k, tie=[F.col("product_id_1").asc(), F.col("product_id_2").asc()])
    return best.select(
        "product_name_1", "product_name_2", "cooccurrence_orders",
        round_ratio(n, t, 4).alias("support"),
        round_ratio(n, p1, 4).alias("confidence_1_to_2"),
        "lift",
        F.concat("product_name_1", F.lit(" → "), "product_name_2").alias("rule_label"),
    )
