from .sinks import drain, stream_append, stream_console
from .sources import rate_source, table_stream

__all__ = ["rate_source", "table_stream", "stream_append", "stream_console", "drain"]
