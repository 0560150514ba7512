"""Keep document sets in step with relational tables, with Spark."""

from docsync.spec import Specs, SyncSpec

__all__ = ["Specs", "SyncSpec"]
