from tallybook.streaming.feed import current, cursors, read_feed, start_feed

__all__ = ["current", "cursors", "read_feed", "start_feed"]
