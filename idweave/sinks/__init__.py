"""Sinks: catalog tables, previews and request exports."""

from .tables import FILE_FORMATS, export_request_batches, export_requests, preview, publish, write_preview

__all__ = ["FILE_FORMATS", "publish", "preview", "write_preview", "export_requests", "export_request_batches"]
