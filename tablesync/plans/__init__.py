from .manifest import load_manifest, manifest_rows
from .sqljob import bind_query, run_script, run_sql, sql_template
from .sync import load_audit, plan_manifest, sync_manifest, sync_report

__all__ = [
    "bind_query", "load_audit", "load_manifest", "manifest_rows", "plan_manifest", "run_script",
    "run_sql", "sql_template", "sync_manifest", "sync_report",
]
