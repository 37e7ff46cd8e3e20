"""Tiny hand-made portfolios for single-operator tests."""

import datetime as dt

from stagecraft.sources.params import StageParams
from stagecraft.sources.tables import StageInputs

MONTHS = [dt.date(2019, 1, 31), dt.date(2019, 2, 28), dt.date(2019, 3, 31), dt.date(2019, 4, 30), dt.date(2019, 5, 31)]
COB = dt.date(2019, 6, 30)  # reporting date 2019-05-31
PARAMS = StageParams(min_factor_date=MONTHS[0], segmentation_date=COB, cure_months=12)


def inputs(spark, dpd_rows, loans, pools=None, rsd=None):
    """``dpd_rows``: (deal, month index, value); ``loans``: deal ids (originated 2018-12-15)."""
    pools = pools or {}
    rsd = rsd or {}
    pop = [(d, COB, dt.date(2018, 12, 15), pools.get(d, 1), rsd.get(d)) for d in loans]
    return StageInputs(
        entity=spark.createDataFrame([(COB,)], "cob_date date"),
        config=spark.createDataFrame([(7002, "12")], "config_id int, config_value string"),
        population=spark.createDataFrame(
            pop,
            "deal_tfi_id string, reporting_date date, value_date date, segment_pool_id int, restructure_start_date date",
        ),
        dpd=spark.createDataFrame(
            [(d, MONTHS[m], v) for d, m, v in dpd_rows], "deal_id string, factor_date date, factor_value int"
        ),
    )
