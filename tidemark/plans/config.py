"""Tenant, repository and retrieval settings, and how overrides merge."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any

#: Defaults of an ingestion.
DEFAULTS: dict[str, Any] = {"chunk_size": 1024, "chunk_overlap": 150, "document_concurrency": 10, "embedding_batch_size": 512, "embedding_concurrency": 5, "contextual_concurrency": 3, "embedding_model": "text-embedding-3-small"}


@dataclass(frozen=True)
class IngestionSettings:
    chunk_size: int
    chunk_overlap: int
    document_concurrency: int
    embedding_batch_size: int
    embedding_concurrency: int
    contextual_concurrency: int
    embedding_model: str
    contextual: bool = False
    contextual_mode: str = "all_chunks"


def merge_settings(overrides: dict[str, Any] | None, tenant: dict[str, Any] | None, llm_model: str | None = None) -> IngestionSettings:
    """Repository over tenant over defaults. A falsy value falls through (so an overlap of 0 does); contextual enrichment goes by None alone and needs a model."""
    over, base = overrides or {}, tenant or {}
    merged = {k: over.get(k) or base.get(k) or v for k, v in DEFAULTS.items()}
    on = over.get("contextual_enrichment_enabled")
    on = base.get("contextual_enrichment_enabled", False) if on is None else on
    return IngestionSettings(**merged, contextual=bool(on and llm_model), contextual_mode=over.get("contextual_enrichment_mode") or base.get("contextual_enrichment_mode") or "all_chunks")


@dataclass(frozen=True)
class ApiConfig:
    api_key: str | None = None
    base_url: str | None = None
    llm_model: str | None = None

    def over(self, rest: ApiConfig) -> ApiConfig:
        return ApiConfig(*(getattr(self, f.name) or getattr(rest, f.name) for f in fields(self)))


def resolve_api(tenant: ApiConfig, defaults: ApiConfig, overall: ApiConfig) -> tuple[ApiConfig, bool]:
    """The settings to use, and whether any differs from the overall ones (a provider of its own is needed then)."""
    got = tenant.over(defaults).over(overall)
    return got, got != overall


@dataclass(frozen=True)
class MetadataField:
    """source: path_segment, file_name, static, path_segment_equals or computed."""

    field_name: str | None
    source: str | None
    segment: int = 0
    default: str = "unknown"
    equals: str = ""
    formula: str | None = None
    true_value: str = "true"
    false_value: str = "false"


def resolve_schema(repo: list[MetadataField] | None, tenant: list[MetadataField] | None) -> list[MetadataField]:
    """The repository's fields, else the tenant's, else none."""
    return repo or tenant or []


@dataclass(frozen=True)
class RetrievalConfig:
    filterable_fields: tuple[str, ...] = ()
    extractable_fields: tuple[str, ...] = ()
    general_flag_field: str | None = None
    general_flag_value: str = "true"
    hybrid_enabled: bool = False
    hybrid_alpha: float = 0.7


@dataclass(frozen=True)
class FilterRequest:
    must: dict[str, list[str]] = field(default_factory=dict)
    should: dict[str, list[str]] = field(default_factory=dict)
    auto_extract: bool = False
