"""Declared schemas of the JSON records that are parsed; nothing is inferred."""

from __future__ import annotations

CHAT_MESSAGE = "role string, timestamp string, content string"
WHALE = "name string, length double, weight double, ocean string, description string"
SUPPORT_RESULT = "support_advice string, block_card boolean, risk int"
SQL_ANSWER = "kind string, sql_query string, explanation string, error_message string"
WEB_SEARCH_QUERY = "query string, aspect string, rationale string"
REFLECTION = "knowledge_gaps array<string>, covered_topics array<string>"
FINAL_SUMMARY = "summary string"
