"""Writers: key/value text lines and text compaction."""

from tessera.sinks.text import compact_text, write_key_values

__all__ = ["compact_text", "write_key_values"]
