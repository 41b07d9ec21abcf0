"""Declared schemas of the eight tables; times are ISO strings."""


SCHEMAS = {
    "directory_snapshots": "snapshot_date string, name string, city string, state string, country string, created string, updated string, checked string, url string",
    "people": "person_id string, name string, url string, city string, state string, country string, valid_from string, valid_to string",
    "fetches": "run_id string, url string, fetched_at string, status bigint, final_url string, etag string, last_modified string, content_hash string, bytes bigint, error string, raw_object_key string",
    "versions": "version_id string, person_id string, url string, first_seen string, last_seen string, source string, archive_url string, stated_date string, text_md string, language string, richness double, content_hash string, text_hash string, needs_js boolean",
    "extractions": "version_id string, model string, prompt_version string, schema_version string, json string, created_at string",
    "focuses": "focus_id string, version_id string, domain string, summary string, tags array<string>, status string, sensitive boolean",
    "embeddings": "id string, kind string, model string, model_revision string, vector array<float>",
    "layouts": "run_id string, id string, x double, y double, cluster_id bigint, cluster_label string",
}
