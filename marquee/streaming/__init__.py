from marquee.streaming.current import compact, fetched_ids, keep_current, read_current_records
from marquee.streaming.landing import current_api_records, ingest_api_responses, response_stream

__all__ = ["compact", "fetched_ids", "keep_current", "read_current_records", "current_api_records", "ingest_api_responses", "response_stream"]
