"""Column-expression helpers; all built from Spark's own functions."""

from tessera.functions.parse import not_blank, split_fields, strict_int, utf8_bytes, utf8_text
from tessera.functions.paths import (base_name, is_under, parent_path, parent_chain,
                                     rebase_path, strip_slash)

__all__ = ["not_blank", "split_fields", "strict_int", "utf8_bytes", "utf8_text", "base_name", "is_under",
           "parent_path", "parent_chain", "rebase_path", "strip_slash"]
