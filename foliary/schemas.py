"""Explicit schemas of the engine's tables. JSON text of the source systems is kept as text where it feeds a hash or equality."""

TABLES = {
    "documents": "sha256 string, size_bytes long, media_type string, raw_path string, created_at timestamp",
    "sources": "document_sha256 string, source_uri string, original_name string, acquired_at timestamp, metadata_json string",
    "runs": "id long, document_sha256 string, status string, config_json string, started_at timestamp, finished_at timestamp, error string",
    "pages": "run_id long, page_number int, route string, route_reasons array<string>, engine string, text string, markdown string, text_chars int, mean_confidence double, validation_status string, flags array<string>",
    "adjudications": "id long, run_id long, page_number int, provider string, model string, request_sha256 string, text string, prompt_tokens long, completion_tokens long, total_tokens long, reported_cost decimal(18,8), created_at timestamp, image_pixels long, image_dark_pixels long, image_dark_pixel_cutoff int, visually_blank boolean",
    "census_runs": "id long, source string, status string, started_at timestamp, finished_at timestamp",
    "census_scopes": "run_id long, house string, parliament_number string, session string, status string",
    "census_records": (
        "record_id string, source_type string, house string, parliament_number string, session string, document_number string, document_subtype string, document_date string, title string, ministry string, members array<string>, language string, "
        "source_url string, official_page_url string, api_url string, api_params map<string,string>, raw string, discovered_at timestamp, acquisition_status string, document_sha256 string, last_error string"
    ),
    "outcomes": "record_id string, document_sha256 string, acquisition_status string, last_error string, n long",
    "attachments": "record_id string, bitstream_id string, position int, name string, source_url string, document_sha256 string, acquired_at timestamp",
}
#: What identifies a row of each table.
KEYS = {
    "documents": ["sha256"], "sources": ["document_sha256", "source_uri"], "runs": ["id"], "pages": ["run_id", "page_number"], "adjudications": ["id"], "census_runs": ["id"],
    "census_scopes": ["run_id", "house", "parliament_number", "session"], "census_records": ["record_id"], "outcomes": ["record_id", "n"], "attachments": ["record_id", "bitstream_id"],
}
#: Columns of a census record that a new census doesn't touch.
SURVIVING = ["acquisition_status", "document_sha256", "last_error"]
