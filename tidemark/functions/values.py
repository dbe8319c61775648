"""Fixed values that results depend on."""

from __future__ import annotations

# MIME type of each file extension.
MIME = {
    ".pdf": "application/pdf",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".doc": "application/msword",
    ".pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    ".ppt": "application/vnd.ms-powerpoint",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xls": "application/vnd.ms-excel",
    ".txt": "text/plain",
    ".md": "text/markdown",
    ".csv": "text/csv",
    ".html": "text/html",
    ".htm": "text/html",
    ".xml": "application/xml",
    ".json": "application/json",
}
OCTETS = "application/octet-stream"
# Which loader takes which MIME type.
LOADER_OF_MIME = {"text/plain": "text", "text/markdown": "text", "text/csv": "text", MIME[".xlsx"]: "xlsx", MIME[".pptx"]: "pptx", MIME[".docx"]: "docx", MIME[".pdf"]: "pdf"}
# Words that say nothing in an identity prefix.
NOISE_WORDS = ("unknown", "general", "default", "none", "null", "n/a", "na", "other", "misc", "miscellaneous", "true", "false")
# Metadata keys that are never part of an identity prefix.
SYSTEM_KEYS = (
    "tenant_id", "repo_id", "job_id", "chunk_index", "chunk_total", "file_name", "file_extension", "mime_type", "source_id", "content_hash", "full_path", "source_url",
    "last_modified_at_source", "ingested_at", "sharepoint_item_id", "sharepoint_drive_id", "h1", "h2", "h3", "h4",
)
# Filterable fields that are for access only.
ACCESS_FIELDS = ("access_group", "is_general", "source_id")
# Fields left out by the alternate formatter, sheets left out of workbooks, hidden file prefixes.
SKIP_FIELDS = ("_id", "__v", "created_at", "updated_at", "deleted_at", "password", "password_hash", "refresh_token", "access_token")
SKIP_SHEETS = ("sheet1", "sheet2", "sheet3", "toc", "table of contents", "contents", "index", "readme", "instructions", "cover", "coversheet", "changelog", "revision history", "change log")
HIDDEN = ("~$", ".~", "._", "$")
MAX_FILE_BYTES = 50 * 1024 * 1024
