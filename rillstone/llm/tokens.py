"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary file is; a parameter of each operator that counts tokens.
VOCABULARY = os.environ.get("RILLSTONE_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the pattern by which that vocabulary's tokenizer splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict = {}


def encoder(path: str = VOCABULARY):
    """The tokenizer, once for each worker process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def with_sizes(docs: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """keep, item, n_tokens: one row per non-empty text, whole texts counted. item numbers the rows: unique within a
    run of the plan, so write the table before it is used twice. Texts do not travel on."""
    schema = docs.select(*keep).schema

    def run(batches):
        encode = encoder(path).encode_ordinary
        for b in batches:
            n = pa.array([len(encode(t)) for t in b[text].to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b[c] for c in keep), b["item"], n], [*keep, "item", "n_tokens"])

    from pyspark.sql.types import LongType, StructType

    out = StructType([*schema.fields]).add("item", LongType()).add("n_tokens", LongType())
    full = docs.where(F.length(text) > 0).select(*keep, F.monotonically_increasing_id().alias("item"), text)
    return full.mapInArrow(run, out)
