"""W22 trade report: totals, per-civilization data, import dependencies,
export effectiveness and a quarterly timeline.

Each section is its own DataFrame (a few rows per group value);
``operators.nested.section_facts`` stacks them as one report.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import signed_sum, weighted_sum
from ..operators.factor import cross_moments, repeat_factor
from ..operators.nested import id_lists

Tables = Mapping[str, DataFrame]
MONEY = "decimal(38,2)"      # totals keep the width of the sum

# Fixed values used by the report text.
POSITIVE, NEGATIVE = "positive", "negative"
IMPORT_WEIGHTS = {"Exotic Metals": 0.5, "Lumber": 0.3}
IMPORT_DEFAULT_WEIGHT = 0.1


def _signed(value: str = "value") -> Column:
    d = F.col("balance_direction")
    return F.when(d == POSITIVE, F.col(value)).when(d == NEGATIVE, -F.col(value)).otherwise(F.lit(0))


def _label(balance: Column) -> Column:
    return (F.when(balance > 0, "Favorable").when(balance < 0, "Unfavorable").otherwise("Neutral"))


def _caravan_tx(t: Tables) -> DataFrame:
    c = t["CARAVANS"].select("caravan_id", "civilization_type")
    return t["TRADE_TRANSACTIONS"].join(c, "caravan_id")


def trade_totals(t: Tables) -> DataFrame:
    tx = _caravan_tx(t)
    return tx.agg(F.count_distinct("civilization_type").alias("total_trading_partners"),
                  F.sum("value").cast(MONEY).alias("all_time_trade_value"),
                  signed_sum("value", "balance_direction", POSITIVE, NEGATIVE).cast(MONEY)
                  .alias("all_time_trade_balance"))


def civilization_data(t: Tables) -> DataFrame:
    """Per civilization, over transactions LEFT JOIN diplomatic events on
    the caravan: every transaction is repeated once per event of its
    caravan, so value, balance and the correlation are event-weighted (as
    the text computes).  Computed from per-caravan moments
    (``cross_moments``), never materialising the product.  The caravan id
    list of the text repeats each caravan n_tx * max(n_events, 1) times;
    it is available in long form from ``civilization_caravans``.
    """
    tx = _caravan_tx(t).select("caravan_id", "civilization_type", "value",
                               _signed().alias("_signed"))
    de = t["DIPLOMATIC_EVENTS"].select("caravan_id", "relationship_change")
    m = cross_moments(tx, de, "caravan_id", "civilization_type", "value", "relationship_change",
                      extra_x={"trade_balance": F.col("_signed")}, out_corr="diplomatic_correlation")
    caravans = tx.groupBy("civilization_type").agg(F.count_distinct("caravan_id").alias("total_caravans"))
    return m.join(caravans, "civilization_type").select(
        "civilization_type", "total_caravans",
        F.col("x_sum").cast(MONEY).alias("total_trade_value"),
        F.col("trade_balance").cast(MONEY).alias("trade_balance"),
        _label(F.col("trade_balance")).alias("trade_relationship"),
        "diplomatic_correlation")


def civilization_caravans(t: Tables) -> DataFrame:
    """Long form of ``caravan_ids``: (civilization, caravan, occurrences)."""
    tx = _caravan_tx(t).groupBy("caravan_id", "civilization_type").agg(F.count(F.lit(1)).alias("_n"))
    ev = t["DIPLOMATIC_EVENTS"].groupBy("caravan_id").agg(F.count(F.lit(1)).alias("_m"))
    return (tx.join(ev, "caravan_id", "left")
            .select("civilization_type", "caravan_id",
                    (F.col("_n") * repeat_factor(F.col("_m"))).alias("occurrences")))


def import_dependencies(t: Tables) -> DataFrame:
    g = t["CARAVAN_GOODS"].join(t["CARAVANS"].select("caravan_id"), "caravan_id")
    agg = g.groupBy("material_type").agg(
        weighted_sum("quantity", "material_type", IMPORT_WEIGHTS, IMPORT_DEFAULT_WEIGHT).alias("dependency_score"),
        F.sum("quantity").alias("total_imported"),
        F.count_distinct("caravan_id").alias("import_diversity"))
    # resource ids per material type, one array per type as in the text
    ids = id_lists(g, "material_type", "material_id", "resource_ids")
    ids = ids.withColumnRenamed("material_type", "_mt")
    return agg.join(ids, agg["material_type"].eqNullSafe(ids["_mt"]), "left").drop("_mt")


def _product_fanout(t: Tables) -> DataFrame:
    """Per product: how the text's LEFT JOINs to caravan goods and their
    transactions repeat each of its workshop-product rows.

    fan      = sum over its goods of max(n_tx(caravan), 1), 1 without goods
    tx_value = sum of transaction values reached through its goods
    tx_n     = number of (goods, transaction) pairs with a value
    """
    txc = t["TRADE_TRANSACTIONS"].groupBy("caravan_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("value").alias("_nv"),
        F.sum(F.col("value").cast("double")).alias("_sv"))
    g = (t["CARAVAN_GOODS"].where(F.col("original_product_id").isNotNull())
         .select(F.col("original_product_id").alias("product_id"), "caravan_id")
         .join(txc, "caravan_id", "left"))
    return g.groupBy("product_id").agg(
        F.sum(repeat_factor(F.col("_rows"))).alias("fan"),
        F.sum(F.coalesce("_sv", F.lit(0.0))).alias("tx_value"),
        F.sum(F.coalesce("_nv", F.lit(0))).alias("tx_n"))


def export_effectiveness(t: Tables) -> DataFrame:
    """Per (workshop type, product type).  ``export_ratio`` divides two
    distinct counts of the same workshops (the join is inner), so it is
    100 or NULL when the count is 1.  ``avg_markup`` averages transaction
    value / product value over the fanned rows, zero-valued products
    skipped.  Quantities are weighted by the fan-out like the text's SUMs.
    """
    wp = t["WORKSHOP_PRODUCTS"].select("workshop_id", "product_id", "quantity")
    p = t["PRODUCTS"].select("product_id", F.col("type").alias("product_type"), F.col("value").alias("p_value"))
    w = t["WORKSHOPS"].select("workshop_id", F.col("type").alias("workshop_type"))
    rows = wp.join(p, "product_id").join(w, "workshop_id").join(_product_fanout(t), "product_id", "left")
    fan = F.coalesce("fan", F.lit(1))
    pv = F.col("p_value").cast("double")
    nz = pv != 0
    g = rows.groupBy("workshop_type", "product_type").agg(
        F.count_distinct("workshop_id").alias("workshop_count"),
        F.sum(F.col("quantity") * fan).alias("total_exported"),
        F.sum(F.col("quantity") * F.col("p_value") * fan).cast(MONEY).alias("total_export_value"),
        F.sum(F.when(nz, F.coalesce("tx_value", F.lit(0.0)) / pv)).alias("_markup_sum"),
        F.sum(F.when(nz, F.coalesce("tx_n", F.lit(0)))).alias("_markup_n"))
    return g.select(
        "workshop_type", "product_type", "workshop_count", "total_exported", "total_export_value",
        (F.try_divide(F.col("workshop_count").cast("double"),
                      F.nullif(F.col("workshop_count").cast("double"), F.lit(1.0))) * 100).alias("export_ratio"),
        F.try_divide(F.col("_markup_sum"), F.nullif(F.col("_markup_n").cast("double"), F.lit(0.0)))
        .alias("avg_markup"))


def export_workshops(t: Tables) -> DataFrame:
    """Long form of ``workshop_ids``: (workshop type, product type,
    workshop, occurrences in the fanned rows)."""
    wp = t["WORKSHOP_PRODUCTS"].select("workshop_id", "product_id")
    p = t["PRODUCTS"].select("product_id", F.col("type").alias("product_type"))
    w = t["WORKSHOPS"].select("workshop_id", F.col("type").alias("workshop_type"))
    rows = wp.join(p, "product_id").join(w, "workshop_id").join(_product_fanout(t), "product_id", "left")
    return rows.groupBy("workshop_type", "product_type", "workshop_id").agg(
        F.sum(F.coalesce("fan", F.lit(1))).alias("occurrences"))


def trade_timeline(t: Tables) -> DataFrame:
    tx = _caravan_tx(t)
    return tx.groupBy(F.year("date").alias("year"), F.quarter("date").alias("quarter")).agg(
        F.sum("value").cast(MONEY).alias("quarterly_value"),
        signed_sum("value", "balance_direction", POSITIVE, NEGATIVE).cast(MONEY).alias("quarterly_balance"),
        F.count_distinct("civilization_type").alias("trade_diversity")).orderBy("year", "quarter")
