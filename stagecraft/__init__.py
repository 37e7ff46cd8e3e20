"""stagecraft - loan impairment staging on Spark DataFrames.

From month-end days-past-due histories and a loan population it builds an
observed-date timeline per loan, fills gaps, derives rolling delinquency
events, finds stage-2 runs and milestone dates, and classifies every loan into
an impairment stage with its stage path, months in stage 2 and cure flag.
"""

from stagecraft.plans.staging import StagePlan
from stagecraft.sources.params import ParameterError, StageParams, resolve_params
from stagecraft.sources.tables import StageInputs, read_inputs

__all__ = ["ParameterError", "StageInputs", "StageParams", "StagePlan", "read_inputs", "resolve_params"]
