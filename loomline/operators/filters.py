"""Row filters and the funnel report. All are narrow and run inside the scan stage."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions import fixed_values as fv

# --- fixed values: path fragments that mark build products ---------------------
SKIPPED_PATH_PARTS = ("__pycache__", ".egg-info")

# A character cut at the end of a byte range: a start of a longer sequence that an
# incremental UTF-8 decoder waits on (it notices a surrogate only when complete).
_CUT_CHARACTER = (
    "^(?:..)*?("
    "(?:C[2-9A-F]|D.|E.|F[0-4])"
    "|(?:E0[AB].|E[1-9A-F][89AB].|F0[9AB].|F[1-3][89AB].|F48.)"
    "|(?:F0[9AB].|F[1-3][89AB].|F48.)[89AB]."
    ")$"
)


def path_is_source(path: Column, skipped=SKIPPED_PATH_PARTS) -> Column:
    keep = F.lit(True)
    for part in skipped:
        keep = keep & ~F.contains(path, F.lit(part))
    return keep


def filter_paths(df: DataFrame, path_col: str = "path", skipped=SKIPPED_PATH_PARTS) -> DataFrame:
    """Drop build products. Test files stay."""
    return df.where(path_is_source(F.col(path_col), skipped))


def byte_size_ok(size: Column, low=fv.MIN_FILE_BYTES, high=fv.MAX_FILE_BYTES) -> Column:
    return size.between(low, high)


def filter_byte_size(df: DataFrame, text_col="text", low=fv.MIN_FILE_BYTES,
                     high=fv.MAX_FILE_BYTES) -> DataFrame:
    """Keep texts of ``low`` to ``high`` UTF-8 bytes, both ends included."""
    return df.where(byte_size_ok(F.octet_length(text_col), low, high))


def char_length_ok(text: Column, low=fv.MIN_SAMPLE_CHARS, high=fv.MAX_SAMPLE_CHARS) -> Column:
    return (F.char_length(text) > low) & (F.char_length(text) < high)


def filter_char_length(df: DataFrame, text_col="text", low=fv.MIN_SAMPLE_CHARS,
                       high=fv.MAX_SAMPLE_CHARS) -> DataFrame:
    """Keep texts of more than ``low`` and fewer than ``high`` characters."""
    return df.where(char_length_ok(F.col(text_col), low, high))


def not_blank(text: Column) -> Column:
    """True if some character is neither Unicode white space nor \\x1c-\\x1f."""
    return F.coalesce(F.rlike(text, F.lit(r"(?U)[^\s\x1c-\x1f]")), F.lit(False))


def filter_blank(df: DataFrame, text_col="text") -> DataFrame:
    """Drop NULL, empty and whitespace-only texts."""
    return df.where(not_blank(F.col(text_col)))


def utf8_head_ok(content: Column, probe: int = fv.UTF8_PROBE_BYTES, enough: int = 100) -> Column:
    """True if the first ``probe`` bytes are valid UTF-8.

    A character cut at the end of the probe is not an error, unless the file
    ends there too and holds fewer than ``enough`` characters, so that a reader
    asking for ``enough`` characters would have to look at the cut one.
    """
    head = F.substring(content, 1, probe)
    tail = F.hex(F.substring(head, F.greatest(F.octet_length(head) - 2, F.lit(1)), F.lit(3)))
    cut_length = F.octet_length(
        F.unhex(F.regexp_extract(tail, _CUT_CHARACTER, 1))
    )
    whole = F.substring(head, F.lit(1), F.octet_length(head) - cut_length)
    whole_ok = F.is_valid_utf8(whole.cast("string"))
    reads_to_end = (F.octet_length(content) <= probe) & (
        F.char_length(whole.cast("string")) < enough
    )
    return whole_ok & ((cut_length == 0) | ~reads_to_end)


def filter_utf8(df: DataFrame, content_col="content") -> DataFrame:
    """Drop files whose start is not valid UTF-8. Bad bytes further on are no reason to drop."""
    return df.where(utf8_head_ok(F.col(content_col)))


def lossy_text(content: Column) -> Column:
    """Decode bytes the way a text file is read: bad bytes vanish, line ends become ``\\n``.

    Valid rows are cast inside the JVM. Only the invalid ones travel to Python.
    """
    @F.arrow_udf("string")
    def drop_bad_bytes(raw: pa.Array) -> pa.Array:
        return pa.array(
            [None if b is None else b.decode("utf-8", errors="ignore") for b in raw.to_pylist()],
            pa.string(),
        )

    as_text = content.cast("string")
    valid = F.is_valid_utf8(as_text)
    repaired = drop_bad_bytes(F.when(~valid, content))
    return F.regexp_replace(F.when(valid, as_text).otherwise(repaired), r"\r\n?", "\n")


def filter_funnel(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows left after each stage, stages applied in order. One pass, one row per stage."""
    alive = F.lit(True)
    counts = [F.count("*").alias("_0")]
    for number, condition in enumerate(stages.values(), start=1):
        alive = alive & F.coalesce(condition, F.lit(False))
        counts.append(F.count_if(alive).alias(f"_{number}"))
    names = ["input", *stages]
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"_{i}").alias("rows_left")
        )
        for i, name in enumerate(names)
    ])
    return df.agg(*counts).select(F.inline(rows))
