"""Readers, writers, shared-storage tables, views and previews."""
from gridlore.sources.files import (
    PEOPLE_SCHEMA,
    STATUS_SCHEMA,
    as_books,
    as_reviews,
    read_books,
    read_people,
    read_quoted_csv,
    read_reviews,
    write_parquet,
    write_quoted_csv,
)
from gridlore.sources.records import read_split_csv
from gridlore.sources.shared import (
    materialize,
    scratch_path,
    settled,
    ship_library,
    spread,
    written_tables,
)
from gridlore.sources.views import preview, register_views, row_count, sample_rows

__all__ = [
    "PEOPLE_SCHEMA", "STATUS_SCHEMA", "as_books", "as_reviews", "read_books",
    "read_people", "read_quoted_csv", "read_reviews", "read_split_csv", "write_parquet",
    "write_quoted_csv", "materialize", "scratch_path", "settled", "ship_library", "spread", "written_tables",
    "preview", "register_views", "row_count", "sample_rows",
]
