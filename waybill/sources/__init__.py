"""Sources: landed JSON pages and tab-separated reports, and the feeds read from them."""

from waybill.sources.feeds import FEEDS, Feed, read_feed

__all__ = ["FEEDS", "Feed", "read_feed"]
