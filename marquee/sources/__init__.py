"""Readers. Every one has an explicit schema."""

from marquee.sources.pages import page_files, read_pages
from marquee.sources.services import (
    read_service_catalogue,
    read_service_selection,
    service_names,
    services_by_code,
)
from marquee.sources.staging import read_concatenated_json, read_staging

__all__ = [
    "page_files",
    "read_concatenated_json",
    "read_pages",
    "read_service_catalogue",
    "read_service_selection",
    "read_staging",
    "service_names",
    "services_by_code",
]
