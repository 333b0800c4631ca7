from .files import (  # noqa: F401
    bad_lines_by_file, load_promotions, normalize_columns, read_csv_with_quarantine, read_parquet, read_typed_csv, register_bucketed,
    scratch_folder, write_bucketed, write_csv, write_parquet, write_stats,
)
from .tables import Tables  # noqa: F401
