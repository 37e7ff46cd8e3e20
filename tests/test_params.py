import datetime as dt

import pytest

from stagecraft.sources.params import ParameterError, StageParams, resolve_params


def _entity(spark, dates):
    return spark.createDataFrame([(d,) for d in dates], "cob_date date")


def _config(spark, x):
    return spark.createDataFrame([(7002, x), (1, "99")], "config_id int, config_value string")


def test_resolves_reporting_date_and_x(spark):
    p = resolve_params(_entity(spark, [dt.date(2019, 3, 31)]), _config(spark, "12"), dt.date(2017, 4, 30))
    assert p.reporting_date == dt.date(2019, 2, 28)
    assert p.x == 12


@pytest.mark.parametrize("dates", [[], [dt.date(2019, 3, 31), dt.date(2019, 4, 30)], [None]])
def test_bad_entity_fails_before_any_write(spark, dates):
    with pytest.raises(ParameterError):
        resolve_params(_entity(spark, dates), _config(spark, "12"), dt.date(2017, 4, 30))


@pytest.mark.parametrize("x", ["0", None])
def test_bad_cure_length_fails(spark, x):
    with pytest.raises(ParameterError):
        resolve_params(_entity(spark, [dt.date(2019, 3, 31)]), _config(spark, x), dt.date(2017, 4, 30))


def test_window_must_precede_reporting_date():
    with pytest.raises(ParameterError):
        StageParams(min_factor_date=dt.date(2020, 1, 31), segmentation_date=dt.date(2019, 3, 31), cure_months=12)
