from docsync.plans.flows import (Home, Report, delete_once, documents, expected, fix, init,
                                 repair_differences, repair_missing, report_frame, run_all, sync_once,
                                 verify)

__all__ = ["Home", "Report", "delete_once", "documents", "expected", "fix", "init",
           "repair_differences", "repair_missing", "report_frame", "run_all", "sync_once", "verify"]
