"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRM = "name string, domain string, feed_url string, press_url string, hq string, sectors array<string>, source_category string"
ARTICLE = "title string, url string, summary string, published timestamp, firm_name string"
ALERT = ARTICLE + ", is_carveout boolean, deal_type string, stage string, target_company string, seller string, buyer string, reasoning string, confidence int"
SCORES = "fit int, separation_complexity int, pe_buyer int, size int, sector int, geography int"
QUALIFIED = ALERT + ", " + SCORES + ", pe_firm string, recommended_action string"
FETCH_LOG = "url string, firm_name string, status int, body string, error_type string, used_render boolean, tls_fallback boolean, fetched_at timestamp"
SEEN = "url string, hash string, first_seen string"
SEEN_DEALS = "target string, seller string, stage string, first_seen string"
FIRM_ERRORS = "firm_name string, last_error string, last_error_date string, consecutive_404s int, needs_url_update boolean, prefer_render boolean"
VERDICT = "page_id string, title string, verdict string, action string, deal_type string, target string, seller string, buyer string, pe_firm string, score string, url string"


def alert_valid(confidence: Column = None) -> Column:
    """An alert's confidence must be from 0 to 100."""
    c = F.col("confidence") if confidence is None else confidence
    return c.isNotNull() & c.between(0, 100)


def qualified_valid() -> Column:
    """Sub-scores are free; fit and confidence are bounded."""
    return alert_valid() & F.col("fit").isNotNull() & F.col("fit").between(0, 100)
