"""Schemas of the three raw inputs as DDL (fixed names and types, every field nullable)."""

OFFER_SCHEMA = (
    "id string, offer_type string, min_value bigint, duration double, "
    "discount_value bigint, channels array<string>"
)

PROFILE_SCHEMA = (
    "age bigint, credit_card_limit double, gender string, id string, registered_on string"
)

EVENT_SCHEMA = (
    "account_id string, event string, time_since_test_start double, "
    "value struct<amount: double, `offer id`: string, offer_id: string, reward: double>"
)
