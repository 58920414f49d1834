"""DataFrame -> DataFrame operators. None reads a path, a table name or a setting."""

from quarterdeck.operators.clean import clean_facts, dedupe_by_key, reference_years, typed_clean
from quarterdeck.operators.compare import differing_rows, only_in, two_way_difference
from quarterdeck.operators.enrich import (
    Lookup,
    broadcast_if_small,
    frequent_codes,
    label_facts,
    left_lookup,
    lookup_resolution,
    salted_lookup,
    unique_codes,
)
from quarterdeck.operators.gaps import coverage_gaps, coverage_gaps_by_key, with_previous
from quarterdeck.operators.history import append_runs, drifted, out_of_bounds, run_numbers
from quarterdeck.operators.incremental import best_of_totals, merged_totals, partial_totals
from quarterdeck.operators.landing import (
    EmptyListing,
    FailedItems,
    landing_summary,
    latest_snapshot,
    listing_links,
    manifest,
    merge_manifest,
    raise_on_failures,
    reconcile,
    reconcile_sides,
    require_listing,
    run_summary,
    unpublished,
)
from quarterdeck.operators.quality import (
    Rule,
    RuleViolation,
    check,
    enforce,
    keep_valid,
    observed,
    observed_metrics,
    rule_metrics,
    schema_drift,
    stale_sources,
    violations,
    volume_freshness,
)
from quarterdeck.operators.reports import (
    best_table,
    highest,
    result_profile,
    title_totals,
    top_k,
    trend,
)
from quarterdeck.operators.series import (
    ANNUAL,
    QUARTERS,
    best_year,
    best_year_single,
    keyed_value_with_reference,
    period_rule_audit,
    period_totals,
    range_stats,
)

__all__ = [
    "ANNUAL",
    "EmptyListing",
    "FailedItems",
    "Lookup",
    "QUARTERS",
    "Rule",
    "RuleViolation",
    "append_runs",
    "best_of_totals",
    "best_table",
    "best_year",
    "best_year_single",
    "broadcast_if_small",
    "check",
    "clean_facts",
    "coverage_gaps",
    "coverage_gaps_by_key",
    "dedupe_by_key",
    "differing_rows",
    "drifted",
    "enforce",
    "frequent_codes",
    "highest",
    "keep_valid",
    "keyed_value_with_reference",
    "label_facts",
    "landing_summary",
    "latest_snapshot",
    "left_lookup",
    "listing_links",
    "lookup_resolution",
    "manifest",
    "merge_manifest",
    "merged_totals",
    "observed",
    "observed_metrics",
    "only_in",
    "out_of_bounds",
    "partial_totals",
    "period_rule_audit",
    "period_totals",
    "raise_on_failures",
    "range_stats",
    "reconcile",
    "reconcile_sides",
    "reference_years",
    "require_listing",
    "result_profile",
    "rule_metrics",
    "run_numbers",
    "run_summary",
    "salted_lookup",
    "schema_drift",
    "stale_sources",
    "title_totals",
    "top_k",
    "trend",
    "two_way_difference",
    "typed_clean",
    "unique_codes",
    "unpublished",
    "violations",
    "volume_freshness",
    "with_previous",
]
