"""Compositions of the operators: the hotel master from drop to export."""

from masterloom.plans.hotel import HotelRun, HotelTables, RunSummary, gold_batch, silver_batch

__all__ = ["HotelRun", "HotelTables", "RunSummary", "gold_batch", "silver_batch"]
