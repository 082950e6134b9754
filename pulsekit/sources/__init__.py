from pulsekit.sources.events import (
    feed_actions,
    message_actions,
    fixture_feed_actions,
    fixture_message_actions,
    load_fixture_tables,
)
from pulsekit.sources.mart_table import write_mart, read_mart, create_mart_table

__all__ = [
    "feed_actions",
    "message_actions",
    "fixture_feed_actions",
    "fixture_message_actions",
    "load_fixture_tables",
    "write_mart",
    "read_mart",
    "create_mart_table",
]
