from .asof import asof_join  # noqa: F401
from .cdc import current_state, scd2, version_changes  # noqa: F401
from .completeness import coverage_grid, issue_list, manifest_recon, missing_cells, volume_vs_mean  # noqa: F401
from .dedupe import keep_first, latest_per_key  # noqa: F401
from .events import (  # noqa: F401
    cycle_summary,
    event_vs_target,
    first_event_cycle,
    key_rollup,
    value_by_source,
)
from .medians import exact_median, median_small_domain, with_exact_median  # noqa: F401
from .recon import series_recon  # noqa: F401
from .units import clock_offset, to_eaches, unit_agreement  # noqa: F401
