"""Sources and sinks: file scans, fixture views over the driver tables."""

from footfall.sources.files import (
    read_csv_headered, read_csv_named, read_station_files, write_csv,
    write_submission_csv, write_snapshots, read_snapshots,
)
from footfall.sources import fixtures

__all__ = [
    "read_csv_headered", "read_csv_named", "read_station_files", "write_csv",
    "write_submission_csv", "write_snapshots", "read_snapshots", "fixtures",
]
