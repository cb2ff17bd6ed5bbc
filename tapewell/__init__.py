"""tapewell: a market-microstructure lakehouse written as Spark jobs.

Raw exchange messages become one typed event table plus a quarantine, events
become cleaned silver tables, silver becomes per-symbol windowed gold, and gold
is kept as snapshots that can be queried as of any of them.
"""

from tapewell.config import FeedConfig, Venue, default_feed
from tapewell.session import ensure_session, stage, work_dir

__all__ = ["FeedConfig", "Venue", "default_feed", "ensure_session", "stage", "work_dir"]
