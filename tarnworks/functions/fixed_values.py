"""Fixed values that results depend on."""

from __future__ import annotations

# Source tags written into the lineage column.
RELATIONAL_SOURCE = "greenplum"
STREAM_SOURCE = "kafka"

# A sale is valid when AMOUNT_LOW < amount <= AMOUNT_HIGH.
AMOUNT_LOW = 0
AMOUNT_HIGH = 1000

# Two money totals agree when they differ by less than this.
TOLERANCE = "0.01"

# Value domains of generated rows.
SALES_REGIONS = ["EMEA", "APAC", "AMER", "LATAM"]
EVENT_REGIONS = ["north", "south", "east", "west"]
PRODUCTS = ["widget", "gadget", "gizmo", "doohickey"]
SALES_FIRST_DAY = "2025-01-01"
SALES_DAYS = 180

# Raw landing objects hold at most this many records; a batch waits for the minimum or the delay.
RAW_MAX_RECORDS = 1000
RAW_MIN_RECORDS = 100
RAW_MAX_DELAY = "30s"

# Files younger than this are never treated as orphans.
ORPHAN_AGE_DAYS = 3
