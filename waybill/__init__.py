"""Waybill: commerce, fulfilment and accounting analytics as Spark DataFrames."""
