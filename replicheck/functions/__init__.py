"""Column expressions: row text, checksums, time values."""

from replicheck.functions.text import canonical, crc_hex, row_text, text_crc, typed_hash
from replicheck.functions.times import bad_time, time_value

__all__ = ["bad_time", "canonical", "crc_hex", "row_text", "text_crc", "time_value", "typed_hash"]
