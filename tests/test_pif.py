from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from perilframe.operators.pif import fold_products, number_in_group, sample_per_group

DDL = ("policy_term_id bigint, business_unit_cd string, product_id bigint, product_cd string, "
       "product_desc string, mod_period string")


def _pif(frame):
    """One business unit and product hold most rows; unit and text may be NULL."""
    rng = random.Random(7)
    rows = set()
    for term in range(400):
        unit = rng.choice(["HOT", "HOT", "HOT", "B", None])
        for product in rng.sample(range(4), rng.randint(1, 3)):
            desc = None if product == 3 else f"P{product // 2}"
            rows.add((term, unit, product, f"C{product}", desc, "2020-06-30"))
    return frame(sorted(rows, key=str), DDL)


def _plain(pif):
    window = Window.partitionBy("business_unit_cd", "product_desc").orderBy(
        F.desc("policy_term_id"), F.asc("product_id")
    )
    return pif.withColumn("bu_product_row_number", F.row_number().over(window).cast("bigint"))


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_numbering_in_buckets_equals_one_window(frame):
    pif = _pif(frame)
    assert _rows(number_in_group(pif, rows_per_range=13)) == _rows(_plain(pif))


def test_samples(frame):
    pif = _pif(frame)
    numbered = _plain(pif)
    top = numbered.filter("bu_product_row_number <= 5")
    assert _rows(sample_per_group(pif)) == _rows(top)
    kept = numbered.filter("bu_product_row_number <= 5 or policy_term_id in (3, 4)")
    assert _rows(sample_per_group(pif, keep_ids=(3, 4))) == _rows(kept)


def test_fold_products_orders_by_id(frame):
    rows = [(1, "A", 10, "X", None, "d"), (1, "A", 9, "Y", "y", "d"), (2, "A", 1, "Z", "z", "d")]
    folded = {r.policy_term_id: r for r in fold_products(frame(rows, DDL)).collect()}
    assert (folded[1].product_id, folded[1].product_cd) == ("9___10", "Y___X")
    assert folded[1].product_desc == "y"
    assert folded[2].product_cd == "Z"
