from .files import read_parts, read_partitioned, release_scratch, scratch_path, spread_rows, stage, write_csv, write_parquet  # noqa: F401
from .weekly import read_weekly_csv, weekly_cells  # noqa: F401
