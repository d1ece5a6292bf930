"""Tokenizers: the pluggable part of every corpus job.

A tokenizer turns a string column into a column of token ids and can give back
the bytes of ids inside a Python worker. ``ByteTokenizer`` needs no files;
``BpeTokenizer`` runs a byte-pair vocabulary through ``tiktoken``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline.functions.fixed_values import FIRST_SPECIAL

TOKENS = T.ArrayType(T.IntegerType(), containsNull=False)


def utf8_code_units(texts: pa.Array) -> pa.Array:
    """UTF-8 bytes of each string as a list of integers, without a Python loop."""
    raw = texts.cast(pa.large_binary())
    _, offset_buffer, data_buffer = raw.buffers()
    count = len(raw)
    offsets = np.frombuffer(offset_buffer, np.int64)[raw.offset:raw.offset + count + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    values = data[offsets[0]:offsets[-1]].astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array((offsets - offsets[0]).astype(np.int32)),
        pa.array(values),
        mask=raw.is_null() if raw.null_count else None,
    )


@dataclass(frozen=True)
class ByteTokenizer:
    """One token per UTF-8 byte, ids 0-255."""

    name: str = "bytes"

    def encode(self, text: Column) -> Column:
        tokenizer = self

        @F.arrow_udf(TOKENS)
        def byte_tokens(texts: pa.Array) -> pa.Array:
            return tokenizer.encode_batch(texts)

        return byte_tokens(text)

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        return utf8_code_units(texts)

    def count(self, text: Column) -> Column:
        """Number of tokens, without encoding."""
        return F.octet_length(text)

    def encode_one(self, text: str) -> list[int]:
        return list(text.encode("utf-8"))

    def to_bytes(self, ids) -> bytes:
        return bytes(ids)


@lru_cache(maxsize=4)
def _load_bpe(name: str, ranks_path: str | None, pattern: str | None):
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    if ranks_path is None:
        return tiktoken.get_encoding(name)
    ranks = load_tiktoken_bpe(ranks_path)
    if max(ranks.values()) >= FIRST_SPECIAL:
        raise ValueError(f"vocabulary ids must stay below {FIRST_SPECIAL}")
    return tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class BpeTokenizer:
    """Byte-pair vocabulary: a published name, or a ranks file every worker can read.

    The encoder is built once per Python worker. Text that looks like a special
    token is encoded as plain text. A ranks file needs the pattern it was made with.
    """

    name: str = "gpt2"
    ranks_path: str | None = None
    pattern: str | None = None

    def __post_init__(self):
        if self.ranks_path is not None and self.pattern is None:
            raise ValueError("a ranks file needs its pattern")

    def _encoder(self):
        return _load_bpe(self.name, self.ranks_path, self.pattern)

    def encode(self, text: Column) -> Column:
        tokenizer = self

        @F.arrow_udf(TOKENS)
        def bpe_tokens(texts: pa.Array) -> pa.Array:
            return tokenizer.encode_batch(texts)

        return bpe_tokens(text)

    def encode_batch(self, texts: pa.Array) -> pa.Array:
        encoder = self._encoder()
        return pa.array(
            [None if t is None else encoder.encode_ordinary(t) for t in texts.to_pylist()],
            pa.list_(pa.int32()),
        )

    def count(self, text: Column) -> Column:
        return F.size(self.encode(text))

    def encode_one(self, text: str) -> list[int]:
        return self._encoder().encode_ordinary(text)

    def to_bytes(self, ids) -> bytes:
        return self._encoder().decode_bytes([int(i) for i in ids])


BYTES = ByteTokenizer()


def words(text: Column | str) -> Column:
    """Lower-cased runs of letters, digits and underscores, for the statistics."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
