"""Offer-campaign propensity analytics on Spark DataFrames."""
