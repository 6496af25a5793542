from marquee.sources.api import (api_id_candidates, flatten_pages, parse_detail, read_api_pages,
                                read_api_responses, valid_ids_numeric)
from marquee.sources.curated import model_columns, read_curated
from marquee.sources.fixtures import Fixtures
from marquee.sources.restrictions import read_restrictions_csv
from marquee.sources.staging import read_staging, read_staging_jdbc, select_staging, staging_count
from marquee.sources.tables import Tables

__all__ = [
    "api_id_candidates", "flatten_pages", "parse_detail", "read_api_pages", "read_api_responses",
    "valid_ids_numeric", "model_columns", "read_curated", "Fixtures", "read_restrictions_csv",
    "read_staging", "read_staging_jdbc", "select_staging", "staging_count", "Tables",
]
