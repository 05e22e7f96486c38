"""Spark ingest and analytics for delimited company-registry releases.

Every operator is a plain function over DataFrames (or a Column expression),
so the same code serves batch jobs and Structured Streaming micro-batches.
"""

from regline.layout import EMPRESAS, Field, Layout, code_table_layout
from regline.session import get_session, shared_dir

__all__ = ["EMPRESAS", "Field", "Layout", "code_table_layout", "get_session", "shared_dir"]
