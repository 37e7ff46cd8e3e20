"""Inputs (parameters, table scans, derived fixtures) and sinks of the staging job."""

from stagecraft.sources.params import ParameterError, StageParams, resolve_params
from stagecraft.sources.tables import StageInputs, read_inputs

__all__ = ["ParameterError", "StageInputs", "StageParams", "read_inputs", "resolve_params"]
