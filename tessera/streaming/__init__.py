"""Structured Streaming form of the traffic totals (a growing log folder)."""

from tessera.streaming.traffic import current_totals, start_traffic_totals

__all__ = ["current_totals", "start_traffic_totals"]
