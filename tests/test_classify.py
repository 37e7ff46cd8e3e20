"""Decision-table arms no fixture reaches (A-else, B10, C14, C18), on hand-made milestone rows."""

import datetime as dt

from portfolio import PARAMS
from stagecraft.operators.classify import classify

D = dt.date
COLS = (
    "deal_id string, restructure_start_date date, npl_date date, c_has_rep_row int, transferred int, "
    "a_zero3_start date, a_zero3_end date, a_zero9_date date, a_stage2_first date, a_stage2_last date, "
    "a_zero_before_last2 date, a_stage2_after_zero date, "
    "b_stage2_first date, b_stage2_last date, b_zero3_first date, b_zero3_last date, "
    "b_zero_before_last2 date, b_stage2_after_zero date, "
    "c_dpd_t int, c_last_cure_date date, c_streak int"
)
N = None


def _row(deal, rsd=N, npl=N, rep=N, transferred=N, a=(N,) * 7, b=(N,) * 6, c=(N, N, N)):
    return (deal, rsd, npl, rep, transferred, *a, *b, *c)


def test_unreached_arms(spark):
    m = [D(2018, k, 28) for k in range(1, 13)]
    rows = [
        # A-else: zero3_end equals stage2_last (neither before nor after it)
        _row("A_else", rsd=m[0], npl=m[0], a=(m[1], m[5], m[2], m[3], m[5], N, N)),
        # B10: last zero event before the last stage-2 point, none before that point
        _row("B10", rsd=m[0], b=(m[2], m[8], m[3], m[4], N, N)),
        _row("C14", rep=1, c=(120, N, N)),
        _row("C18", npl=m[1], rep=1, c=(120, m[9], N)),
    ]
    df = spark.createDataFrame(rows, COLS)
    got = {
        r.deal_id: (r.branch, r.condition_no, r.calculated_stage, r.stg3_flag, r.m_stg2, r.cure_flag)
        for r in classify(df, PARAMS).collect()
    }
    assert got["A_else"] == ("A", None, None, None, None, None)
    assert got["B10"] == ("B", 10, 2, "N", 8, None)  # 2018-09-28 -> 2019-05-31, before publishing
    assert got["C14"] == ("C", 14, 3, "Y", 0, None)
    assert got["C18"] == ("C", 18, 3, "Y", 0, 1)
