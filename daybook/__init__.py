"""daybook: daily full dumps → change log → any past day, on Spark.

Public API (all functions take and return DataFrames; only ``sources`` and
``store`` touch paths):

* diff:    ``first_load``, ``snapshot_diff``, ``classify``, ``flatten_changes``
* replay:  ``apply_changes``, ``build_change_log``, ``as_of``, ``undo_to``
* compare: ``compare``, ``compare_summary``, ``compare_samples``
* report:  ``total_rows``, ``top_n``, ``group_count``, ``sample_rows``,
           ``schema_of``, ``change_counts``, ``changelog_stats``
* schema:  ``align_columns``, ``common_columns``, ``content_columns``,
           ``normalize_key``, ``key_problems``, ``require_valid_key``
* store:   ``Store`` (versioned snapshots + day-partitioned change log)
"""

from .functions.dates import day_lit, to_day
from .functions.equality import content_hash, same_content
from .operators.compare import compare, compare_rows, compare_samples, compare_summary
from .operators.diff import DELETE, INSERT, UPDATE, change_log_schema, classify, first_load, flatten_changes, snapshot_diff
from .operators.keys import KeyContractError, key_problems, normalize_key, require_valid_key
from .operators.replay import apply_changes, as_of, build_change_log, first_change, last_change, stack_dumps, undo_to
from .operators.report import change_counts, changelog_stats, group_count, sample_rows, top_n, total_rows
from .operators.schema import align_columns, common_columns, content_columns, require_columns, schema_of

__all__ = [n for n in dir() if not n.startswith("_")]
