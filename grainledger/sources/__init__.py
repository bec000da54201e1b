from .feeds import FEEDS, REFERENCES, read_manifest, read_reference, scan_feed, scan_files  # noqa: F401
from .inventory import affected_partitions, column_drift, file_inventory, list_files, probe_footers  # noqa: F401
