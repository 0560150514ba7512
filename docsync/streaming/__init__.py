from docsync.streaming.capture import (changed_parent_ids, follow_changes,
                                       parents_of_changed_teams)
from docsync.streaming.feed import distinct_feed, write_feed
from docsync.streaming.history import RunHistory, fold_history, read_history, run_summary
from docsync.streaming.late import FeedReport, LateRows, follow_feed, load_batch, readmit
from docsync.streaming.ticks import follow, follow_all, register_ticks, status_frame

__all__ = ["FeedReport", "LateRows", "RunHistory", "changed_parent_ids", "distinct_feed",
           "fold_history", "follow", "follow_all", "follow_changes", "follow_feed", "load_batch",
           "parents_of_changed_teams", "read_history", "readmit", "register_ticks",
           "run_summary", "status_frame", "write_feed"]
