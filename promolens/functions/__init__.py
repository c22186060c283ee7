from promolens.functions.columns import (
    age_band,
    bands,
    clean_gender,
    ratio,
    to_days,
    to_micros,
    yyyymmdd,
)
from promolens.functions.domains import AGE_BANDS, CHANNELS, GENDERS, OFFER_TYPES

__all__ = [
    "AGE_BANDS",
    "CHANNELS",
    "GENDERS",
    "OFFER_TYPES",
    "age_band",
    "bands",
    "clean_gender",
    "ratio",
    "to_days",
    "to_micros",
    "yyyymmdd",
]
