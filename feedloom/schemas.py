"""Explicit schemas of the tables that flow between the operators, as DDL."""

ITEM = (
    "title STRING, link STRING, published TIMESTAMP, summary STRING, source_feed STRING, "
    "id STRING, feed_rank INT, entry_pos BIGINT"
)

HISTORY = "url STRING, ts TIMESTAMP"

# What a model answers for one item; the score may arrive as number or text.
SCORED_FIELDS = (
    "url: STRING, title: STRING, source: STRING, relevance_score: STRING, justification: STRING, "
    "content_type: STRING, keywords: ARRAY<STRING>"
)

DIGEST = "profile STRING, run_date DATE, created_at TIMESTAMP, digest_html STRING"
