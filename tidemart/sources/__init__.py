from tidemart.sources.feeds import Feed, feed_letters, feed_rows
from tidemart.sources.parsing import parse_cdc, parse_records, parse_rows
from tidemart.sources.tables import read_routing, table
from tidemart.sources.topics import read_topic, replay_files, topic_view

__all__ = [
    "Feed", "feed_letters", "feed_rows", "parse_cdc", "parse_records", "parse_rows", "read_routing", "read_topic",
    "replay_files", "table", "topic_view",
]
