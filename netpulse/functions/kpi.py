"""KPI expressions over aggregated columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from netpulse import domain
from netpulse.functions.numeric import percent, round_half_up


def health_score(cpu: Column, memory: Column, temperature: Column) -> Column:
    """100 minus weighted load, never below 0; missing readings score 0. Not capped at 100."""
    heat = (temperature - domain.TEMP_BASE_C) / domain.TEMP_RANGE_C * domain.TEMP_WEIGHT
    load = cpu * domain.CPU_WEIGHT + memory * domain.MEMORY_WEIGHT + heat
    return F.greatest(F.lit(0.0), round_half_up(100 - load, 1))


def incident_rate_pct(incidents: Column, events: Column) -> Column:
    return percent(incidents, events, 2)


def availability_pct(incident_rate: Column) -> Column:
    return round_half_up(100 - incident_rate, 2)


def sla_met(availability: Column) -> Column:
    return availability >= domain.SLA_TARGET_PCT


def sla_gap_pct(availability: Column) -> Column:
    return round_half_up(domain.SLA_TARGET_PCT - availability, 3)


def change_pct(current: Column, previous: Column) -> Column:
    """Relative change in percent, one digit; null without a non-zero previous value."""
    return percent(current - previous, previous, 1)
