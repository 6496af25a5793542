from marquee.sinks.curated import (LoadValidationError, load_curated, read_current, validate_before_load,
                                  write_curated, write_curated_jdbc)
from marquee.sinks.models import write_classifier, write_segmentation
from marquee.sinks.staging import replace_staging
from marquee.sinks.versions import CommitConflict, current_version, leased_version
from marquee.sinks.files import write_csv, write_jsonl, write_text

__all__ = [
    "CommitConflict", "LoadValidationError", "current_version", "leased_version", "load_curated", "read_current",
    "validate_before_load", "write_curated", "write_curated_jdbc",
    "write_csv", "write_jsonl", "write_text", "write_classifier", "write_segmentation", "replace_staging",
]
